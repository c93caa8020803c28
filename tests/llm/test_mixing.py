import hashlib
import math
from collections import Counter

from millrace.llm.mixing import MAX_RATE, distribution, mix_sources, rates

from .helpers import NASTY, nasty, none


def brute_counts(rows, rate_of, seed="mix-1"):
    out = Counter()
    for doc, source in rows:
        digest = hashlib.md5(f"{seed}-{'' if doc is None else doc}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 2**52
        rate, k, total = rate_of[source or ""], 0, 0.0
        p = math.exp(-rate)
        while True:
            total += p
            if total >= u:
                break
            k += 1
            p *= rate / k
        out[doc] += k
    return out


def test_counts_match_brute_force(spark):
    rows = [(i, f"text {i}", "big" if i % 3 else f"s{i % 7}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rate_of = {r["__source"]: r["rate"] for r in rates(df).collect()}
    sizes = Counter(s for *_, s in rows)
    share = sum(n**0.5 for n in sizes.values())
    assert all(math.isclose(rate_of[s], 3_000 * n**0.5 / share / n) for s, n in sizes.items())
    out = mix_sources(df).collect()
    wanted = brute_counts([(d, s) for d, _, s in rows], rate_of)
    assert Counter(r["doc_id"] for r in out) == Counter({k: v for k, v in wanted.items() if v})
    assert all(r["mix_copy"] < wanted[r["doc_id"]] for r in out)
    assert len({(r["doc_id"], r["mix_copy"]) for r in out}) == len(out)


def test_weights_and_total(spark):
    df = spark.createDataFrame([(i, "t", "a" if i < 1_900 else "b") for i in range(2_000)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("absent", 5.0)], "source string, weight double")
    out = Counter(r["source"] for r in mix_sources(df, weights, total=1_000).select("source").collect())
    assert abs(out["a"] - 500) < 90 and abs(out["b"] - 500) < 90
    only = mix_sources(df, spark.createDataFrame([("b", 1.0), ("a", 0.0)], "source string, weight double"))
    assert {r["source"] for r in only.select("source").distinct().collect()} == {"b"}


def test_output_is_sorted_by_a_uniform_key(spark):
    df = spark.createDataFrame([(i, "t", "a") for i in range(2_000)], "doc_id long, text string, source string")
    keys = [r["mix_key"] for r in mix_sources(df).select("mix_key").collect()]
    assert keys == sorted(keys)
    assert mix_sources(df).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_many_sources_go_by_salted_join(spark, monkeypatch):
    rows = [(i, "t", f"s{i % 40}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = lambda x: sorted((r["doc_id"], r["mix_copy"]) for r in x.collect())
    wanted = order(mix_sources(df))
    monkeypatch.setattr("millrace.llm.mixing.BROADCAST_SOURCES", 3)
    assert order(mix_sources(df)) == wanted


def test_nasty_rows(spark):
    df = nasty(spark)
    out = mix_sources(df)
    assert set(out.columns) == {*df.columns, "mix_key", "mix_copy"}
    counts = Counter(r["doc_id"] for r in out.collect())
    rate_of = {r["__source"]: r["rate"] for r in rates(df).collect()}
    assert counts == Counter({k: v for k, v in brute_counts([(r[0], r[3]) for r in NASTY], rate_of).items() if v})
    assert mix_sources(none(spark)).collect() == []


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "t", "a")], "doc_id long, text string, source string")
    plan = mix_sources(df)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_distribution_reaches_one(spark):
    from pyspark.sql import functions as F

    for rate in (0.01, 1.0, 30.0, MAX_RATE):
        cdf = spark.range(1).select(distribution(F.lit(rate)).alias("c")).first()["c"]
        assert abs(cdf[-1] - 1) < 1e-9 and cdf == sorted(cdf)


def test_large_rates_are_drawn_whole(spark):
    rows = [(i, "t", "small" if i < 4 else "big") for i in range(2_404)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("small", 1.0), ("big", 1.0)], "source string, weight double")
    # one quantile as long as exp(-rate) is a double: 600 and 1
    out = mix_sources(df, weights, total=4_800).select("doc_id").collect()
    wanted = brute_counts([(d, s) for d, _, s in rows], {"small": 600.0, "big": 1.0})
    assert Counter(r["doc_id"] for r in out) == Counter({k: v for k, v in wanted.items() if v})
    # several beyond it: 2,500 is drawn as four of 625
    out = mix_sources(df.where("source = 'small'"), weights, total=10_000).select("doc_id", "mix_copy").collect()
    got = Counter(r["doc_id"] for r in out)
    assert abs(sum(got.values()) - 10_000) < 500 and all(abs(n - 2_500) < 250 for n in got.values())
    assert {(r["doc_id"], r["mix_copy"]) for r in out} == {(d, k) for d, n in got.items() for k in range(n)}
    wanted = brute_counts([(d, "small") for d in range(4)], {"small": 625.0})
    for k in (1, 2, 3):
        wanted += Counter({int(d.split("-")[1]): n for d, n in brute_counts([(f"{k}-{d}", "small") for d in range(4)], {"small": 625.0}, "mix-1-draw").items()})
    assert got == wanted
