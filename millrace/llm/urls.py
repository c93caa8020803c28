"""URL filters: allow and block rules first, gradient-boosted trees on lexical features for the rest.

The trees are trained on the URLs that the rules label. Histograms over quantile bins, logistic loss, small trees:
the fit needs a bounded sample only; every URL is then scored where it lies.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, smallest_hashes

#: (host and path prefix, verdict): the production rules (fixed by the contract).
RULES: tuple[tuple[str, str], ...] = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


@dataclass(frozen=True)
class GbtParams:
    #: The trees are fitted on at most this many different labelled URLs, those of the smallest hashes.
    fit_rows: int = 20_000
    trees: int = 40
    depth: int = 4
    rate: float = 0.2
    bins: int = 32
    least: int = 10
    l2: float = 1.0


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path; both are '' for a null URL or one without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rest = F.expr("substring(__after, length(__host) + 1)")
    out = df.withColumn("__after", F.coalesce(after, F.lit(""))).withColumn("__host", F.coalesce(host, F.lit("")))
    out = out.withColumn("host", F.coalesce(lowered, F.lit(""))).withColumn("path", F.regexp_extract(rest, r"^[^?#]*", 0))
    return out.drop("__after", "__host")


def rule_column(rules: tuple[tuple[str, str], ...] = RULES) -> F.Column:
    """The longest rule that fits host and path; null if none does."""
    found = None
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        found = F.when(fits, F.lit(rule)) if found is None else found.when(fits, F.lit(rule))
    return found if found is not None else F.lit(None).cast("string")


#: Features of one URL, in this order; suffix statistics follow.
FEATURES = ("length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "query_length", "dots", "hyphens", "longest_digits", "fragment", "https", "extension")

DIGITS = re.compile(r"[0-9]+")


def lexical(url: str, host: str, path: str) -> list[float]:
    n = len(url)
    digits = sum(map(url.count, "0123456789"))
    entropy = 0.0
    for c in set(url):
        p = url.count(c) / n
        entropy -= p * math.log2(p)
    query = url.partition("#")[0].partition("?")[2]
    longest = max(map(len, DIGITS.findall(url)), default=0)
    depth = sum(1 for x in path.split("/") if x)
    return [n, len(host), len(path), depth, digits / max(n, 1), entropy, query.count("=") + query.count("&") if query else 0, len(query), host.count("."), url.count("-"), longest, "#" in url, url[:8].lower() == "https://", "." in path.rpartition("/")[2]]


def suffixes(host: str, path: str) -> tuple[str, str, str]:
    """What block rates are kept for: the last label, the last label with the first path segment, the first label."""
    last = host.rpartition(".")[2]
    segment = path[1:].partition("/")[0]
    return last, f"{last}/{segment}" if "/" in path[1:] else f"{last}/", host.partition(".")[0]


def suffix_rates(rows: list[tuple[str, str, int]]) -> list[dict[str, tuple[float, float]]]:
    """(blocked, all) by suffix, for each kind."""
    tables: list[dict[str, tuple[float, float]]] = [{}, {}, {}]
    for host, path, y in rows:
        for held, key in zip(tables, suffixes(host, path), strict=True):
            a, b = held.get(key, (0.0, 0.0))
            held[key] = (a + y, b + 1)
    return tables


def vector(url: str, host: str, path: str, tables, prior: float) -> list[float]:
    found = lexical(url, host, path)
    for held, key in zip(tables, suffixes(host, path), strict=True):
        a, b = held.get(key, (0.0, 0.0))
        found += [(a + 5 * prior) / (b + 5), math.log1p(b)]
    return found


class Trees:
    """Boosted trees as arrays: node i of a tree has children 2i+1 and 2i+2."""

    def __init__(self, params: GbtParams):
        self.params, self.start, self.rate = params, 0.0, params.rate
        self.edges: list[np.ndarray] = []
        self.features = self.cuts = self.values = None

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        p = self.params
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        self.start = math.log(share / (1 - share))
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, p.bins + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(x.shape[1])]
        nodes, inner = 2 ** (p.depth + 1) - 1, 2**p.depth - 1
        n_trees = p.trees if len(y) and 0 < y.mean() < 1 else 0
        self.features = np.full((n_trees, nodes), -1)
        self.cuts = np.zeros((n_trees, nodes), dtype=np.int64)
        self.values = np.zeros((n_trees, nodes))
        b, wide = self.binned(x), p.bins + 1
        z = np.full(len(y), self.start)
        for t in range(n_trees):
            q = 1 / (1 + np.exp(-z))
            g, h = y - q, q * (1 - q)
            at = np.zeros(len(y), dtype=np.int64)
            for depth in range(p.depth + 1):
                first, count = 2**depth - 1, 2**depth
                gs = np.bincount(at - first, g, count) if depth == 0 else np.bincount(np.where(at >= first, at - first, count), g, count + 1)[:count]
                hs = np.bincount(np.where(at >= first, at - first, count), h, count + 1)[:count]
                self.values[t, first : first + count] = gs / (hs + p.l2)
                if first >= inner:
                    break
                best = np.full(count, 1e-6)
                live = np.flatnonzero(at >= first)
                for k in range(x.shape[1]):
                    cell = (at[live] - first) * wide + b[live, k]
                    gl = np.bincount(cell, g[live], count * wide).reshape(count, wide).cumsum(1)[:, :-1]
                    hl = np.bincount(cell, h[live], count * wide).reshape(count, wide).cumsum(1)[:, :-1]
                    nl = np.bincount(cell, minlength=count * wide).reshape(count, wide).cumsum(1)
                    gain = gl**2 / (hl + p.l2) + (gs[:, None] - gl) ** 2 / (hs[:, None] - hl + p.l2) - (gs**2 / (hs + p.l2))[:, None]
                    gain[(nl[:, :-1] < p.least) | (nl[:, -1:] - nl[:, :-1] < p.least)] = -1
                    cut = gain.argmax(1)
                    better = gain[np.arange(count), cut] > best
                    best = np.where(better, gain[np.arange(count), cut], best)
                    self.features[t, first : first + count][better] = k
                    self.cuts[t, first : first + count][better] = cut[better]
                at = self.descend(t, at, b, first)
            z = z + self.rate * self.values[t, at]
        return self

    def descend(self, t: int, at: np.ndarray, b: np.ndarray, first: int) -> np.ndarray:
        feature = self.features[t, at]
        split = (feature >= 0) & (at >= first)
        right = b[np.arange(len(b)), np.maximum(feature, 0)] > self.cuts[t, at]
        return np.where(split, 2 * at + 1 + right, at)

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        z = np.full(len(x), self.start)
        for t in range(len(self.values)):
            at = np.zeros(len(x), dtype=np.int64)
            for depth in range(self.params.depth):
                at = self.descend(t, at, b, 2**depth - 1)
            z = z + self.rate * self.values[t, at]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: Parts of the labelled URLs, by hash: each part's suffix statistics for the fit come from the others.
FOLDS = 5


def learn(labelled: list[tuple[str, str, str, int]], params: GbtParams = GbtParams()):
    """labelled: (url, host, path, 1 if blocked). Gives the trees, the suffix statistics and the share blocked.

    A URL's own label must not show in its statistics: leaving out just that label would tell it, as the rate of its suffix
    then falls where it is blocked. So the trees see statistics of whole other folds.
    """
    y = np.array([r[3] for r in labelled], dtype=float)
    prior = float(y.mean()) if len(y) else 0.0
    fold = [zlib.crc32(r[0].encode()) % FOLDS for r in labelled]
    others = [suffix_rates([(h, p, v) for (_, h, p, v), k in zip(labelled, fold, strict=True) if k != own]) for own in range(FOLDS)]
    x = np.array([vector(u, h, p, others[k], prior) for (u, h, p, _), k in zip(labelled, fold, strict=True)], dtype=float).reshape(len(labelled), len(FEATURES) + 6)
    return Trees(params).fit(x, y), suffix_rates([(h, p, v) for _, h, p, v in labelled]), prior


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, params: GbtParams = GbtParams(), url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Columns ``keep``, host, path, rule, verdict and block_score (the trees') for every row.

    A null URL has empty host and path, fits no rule and is judged by the trees like an empty one. Without any
    labelled URL the trees allow everything. Repeated rows get equal verdicts, and copies of a URL count once in the fit;
    other columns aren't read.
    """
    bounded_batches(pages.sparkSession)
    parts = with_parts(pages.select(*(pages[c] for c in keep), pages[url].alias("__url")), "__url").withColumn("rule", rule_column(rules))
    blocked = [r for r, v in rules if v == "block"]
    labelled = parts.where(F.col("rule").isNotNull()).select(F.col("__url"), "host", "path", F.col("rule").isin(blocked).cast("int").alias("y"))
    different = labelled.agg(F.approx_count_distinct("__url", 0.02)).first()[0]
    sample = smallest_hashes(labelled, "__url", different, params.fit_rows, distinct=True)
    model = learn([tuple(r) for r in sample.collect()], params)
    fields = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "host string, path string, rule string, verdict string, block_score double"])
    verdicts = dict(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, tables, prior = model
        for batch in batches:
            urls, hosts, paths, fits = (batch.column(c).to_pylist() for c in ("__url", "host", "path", "rule"))
            x = np.array([vector(u or "", h, p, tables, prior) for u, h, p in zip(urls, hosts, paths, strict=True)], dtype=float).reshape(len(urls), len(FEATURES) + 6)
            scores = trees.predict(x)
            said = [verdicts[r] if r else "block" if s >= 0.5 else "allow" for r, s in zip(fits, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), batch.column("host"), batch.column("path"), batch.column("rule"), pa.array(said, pa.string()), pa.array(scores)],
                [*keep, "host", "path", "rule", "verdict", "block_score"],
            )

    return parts.mapInArrow(lean(run), schema)
