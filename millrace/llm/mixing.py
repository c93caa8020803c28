"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate (target rows / rows it has). A document's number of copies is the Poisson
quantile of a uniform number hashed from a seed and its id, so the same seed always gives the same mixture and a
document's copies don't depend on other partitions. Means beyond a double's exp() are drawn as a sum of several such
quantiles, which is Poisson again. Copies are spread by a hashed key over the whole output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sources up to this number are joined by broadcast: each costs a table of at most some 1,050 doubles.
BROADCAST_SOURCES = 1_000
#: The largest mean of one quantile: exp(-mean) is a normal double up to 708. A larger rate is drawn in equal parts.
MAX_RATE = 700.0


def uniform(seed: str, *keys) -> F.Column:
    """A number in (0, 1) from the first 52 bits of an md5, the same in any SQL engine."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(seed), *keys)), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: DataFrame | None = None, alpha: float = 0.5, total: float | None = None, source: str = "source") -> DataFrame:
    """(__source, rate): the mean number of copies of a document of each source.

    ``weights``: (source, weight), weights of 0 or more with any sum; sources without one get 0. Without a table the
    weight is rows ** alpha. ``total``: rows of the mixture on average, by default as many as ``docs`` has.
    A null source is a source like any other, named ''.
    """
    sizes = docs.groupBy(F.coalesce(F.col(source), F.lit("")).alias("__source")).agg(F.count(F.lit(1)).cast("double").alias("__n"))
    if weights is None:
        sizes = sizes.withColumn("__w", F.pow(F.col("__n"), F.lit(alpha)))
    else:
        given = weights.select(F.coalesce(F.col(source), F.lit("")).alias("__source"), F.greatest(F.col("weight").cast("double"), F.lit(0.0)).alias("__w"))
        sizes = sizes.join(given, "__source", "left").fillna(0.0, ["__w"])
    # one row of totals against one row for each source: bounded by the number of sources, not of documents
    sums = sizes.agg(F.sum("__w").alias("__sw"), F.sum("__n").alias("__sn"))
    target = F.col("__sn") if total is None else F.lit(float(total))
    rate = F.coalesce(F.try_divide(target * F.col("__w"), F.col("__sw") * F.col("__n")), F.lit(0.0))
    return sizes.join(F.broadcast(sums)).select("__source", rate.alias("rate"))


def distribution(rate) -> F.Column:
    """P(X <= k) for k = 0, 1, ... until it is 1 for a double, X Poisson with this mean."""
    last = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(30.0)).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def step(held, k):
        p = held["p"] * rate / k.cast("double")
        return F.struct(p.alias("p"), (held["sum"] + p).alias("sum"), F.concat(held["all"], F.array(held["sum"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["all"]


def copies(name: F.Column, seed: str) -> F.Column:
    """The Poisson count of a row with the columns __mix_cdf and __mix_draws: the sum of as many quantiles as draws."""

    def quantile(u):
        return F.size(F.filter("__mix_cdf", lambda c: c < u))

    further = F.sequence(F.lit(1), F.col("__mix_draws") - 1)
    more = F.aggregate(further, F.lit(0), lambda n, k: n + quantile(uniform(f"{seed}-draw", k.cast("string"), name)))
    return quantile(F.col("__mix_u")) + F.when(F.col("__mix_draws") > 1, more).otherwise(F.lit(0))


def partitions_of(docs: DataFrame) -> int:
    """As many as the input has, which grow with its bytes, or as spark.sql.shuffle.partitions if these are more."""
    used = docs.select(F.spark_partition_id().alias("p")).agg(F.count_distinct("p")).first()[0]
    return max(1, used, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    seed: str = "mix-1",
    alpha: float = 0.5,
    total: float | None = None,
    source: str = "source",
    id_column: str = "doc_id",
) -> DataFrame:
    """Columns of ``docs``, each row as often as its Poisson count says, and ``mix_copy`` and ``mix_key``.

    ``mix_copy`` counts a row's copies from 0; ``mix_key`` is the hashed key of the global shuffle: the result is
    range-partitioned and sorted by it, and by id where keys are equal. Rows with equal ids get equal counts. A null id hashes as ''. An empty table
    gives an empty one. Columns of ``docs`` named ``mix_copy`` or ``mix_key`` are replaced.
    """
    docs = docs.drop("mix_copy", "mix_key")
    parts = partitions_of(docs)
    table = rates(docs, weights, alpha, total, source)
    draws = F.ceil(F.col("rate") / F.lit(MAX_RATE)).cast("int")
    table = table.where(F.col("rate") > 0).select(F.col("__source").alias("__mix_source"), draws.alias("__mix_draws"), distribution(F.col("rate") / draws).alias("__mix_cdf"))
    few = docs.select(source).distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    own = F.coalesce(F.col(source), F.lit(""))
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    if few:
        joined = docs.withColumn("__mix_source", own).join(F.broadcast(table), "__mix_source")
    else:  # beyond the bound: a hot source is salted over many partitions
        salts = parts
        spread = table.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = docs.withColumns({"__mix_source": own, "__mix_salt": F.pmod(F.xxhash64(name), F.lit(salts)).cast("int")})
        joined = salted.join(spread, ["__mix_source", "__mix_salt"]).drop("__mix_salt")
    drawn = joined.withColumn("__mix_u", uniform(seed, name))
    counted = drawn.withColumn("__mix_n", copies(name, seed)).where("__mix_n > 0")
    copied = counted.drop("__mix_source", "__mix_draws", "__mix_cdf", "__mix_u").withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("__mix_n") - 1))).drop("__mix_n")
    keyed = copied.withColumn("mix_key", F.md5(F.concat_ws("-", F.lit(f"{seed}-order"), name, F.col("mix_copy").cast("string"))))
    # the key is uniform, so its first bits are an even range partitioning that needs no sampling pass over the texts
    place = F.floor(F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("double") * F.lit(parts / 2.0**32)).cast("int")
    return keyed.repartitionById(parts, place).sortWithinPartitions("mix_key", *(c for c in docs.columns if c == id_column))
