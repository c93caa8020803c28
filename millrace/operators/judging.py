"""Pairwise judging of systems: comparisons, juries, ratings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import coin

START, STEP = 1500.0, 32.0


def pairs(df: DataFrame, key: str, columns: list[str], limit: int = 2_500, seed: int | str = 42) -> DataFrame:
    """(key, model_a, model_b, text_a, text_b, swapped): all unordered pairs of a row's outputs, in hashed A/B order.

    Texts are cut to ``limit`` signs; pairs with an empty side are left out.
    """
    made = []
    for i, a in enumerate(columns):
        for b in columns[i + 1 :]:
            made.append(F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.left(F.trim(F.coalesce(a, F.lit(""))), F.lit(limit)).alias("x"), F.left(F.trim(F.coalesce(b, F.lit(""))), F.lit(limit)).alias("y")))
    rows = df.select(F.col(key), F.explode(F.array(*made)).alias("p")).select(key, "p.*").where("x <> '' and y <> ''")
    rows = rows.withColumn("swapped", coin(F.col(key).cast("string"), F.col("model_a"), F.col("model_b"), seed=seed) == 1)
    return rows.select(key, "model_a", "model_b", F.when(F.col("swapped"), F.col("y")).otherwise(F.col("x")).alias("text_a"), F.when(F.col("swapped"), F.col("x")).otherwise(F.col("y")).alias("text_b"), "swapped")


def jury(votes: DataFrame) -> DataFrame:
    """(sample_idx, model_a, model_b, swapped, winner, agreement): the majority; of equal numbers the vote first cast."""
    by = ["sample_idx", "model_a", "model_b", "swapped"]
    counted = votes.groupBy(*by, "vote").agg(F.count(F.lit(1)).alias("n"), F.min("judge").alias("first"))
    best = counted.groupBy(*by).agg(F.min_by(F.struct("vote", "n"), F.struct(-F.col("n"), F.col("first"))).alias("best"), F.sum("n").alias("total"))
    return best.select(*by, F.col("best.vote").alias("winner"), F.concat_ws("/", F.col("best.n").cast("string"), F.col("total").cast("string")).alias("agreement"))


def unswapped(results: DataFrame) -> DataFrame:
    """The winner in terms of model_a and model_b."""
    other = F.when(F.col("winner") == "A", "B").when(F.col("winner") == "B", "A").otherwise(F.col("winner"))
    return results.withColumn("winner", F.when(F.col("swapped"), other).otherwise(F.col("winner")))


def leaderboard(results: DataFrame) -> DataFrame:
    """(model, wins, losses, ties, win_pct, place) from unswapped results."""
    points = lambda model, win, loss: F.struct(F.col(model).alias("model"), (F.col("winner") == win).cast("int").alias("w"), (F.col("winner") == loss).cast("int").alias("l"))
    sides = results.select(F.explode(F.array(points("model_a", "A", "B"), points("model_b", "B", "A"))).alias("s")).select("s.*")
    out = sides.groupBy("model").agg(F.sum("w").alias("wins"), F.sum("l").alias("losses"), F.count_if((F.col("w") == 0) & (F.col("l") == 0)).alias("ties"))
    out = out.withColumn("win_pct", F.round(F.try_divide(100.0 * F.col("wins"), F.col("wins") + F.col("losses") + F.col("ties")), 1))
    from pyspark.sql import Window

    return out.withColumn("place", F.row_number().over(Window.orderBy(F.col("win_pct").desc(), "model")))  # one row for each model


def elo(results: DataFrame, order: tuple[str, ...] = ("sample_idx", "model_a", "model_b"), start: float = START, step: float = STEP) -> DataFrame:
    """(model, elo, games): ratings after all comparisons in the given order.

    Each rating depends on all games before it, so one task folds the sorted stream; it holds one number for each
    model, never the games.
    """
    ordered = results.select(*order, "winner").repartition(1).sortWithinPartitions(*order)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rating: dict[str, float] = {}
        games: dict[str, int] = {}
        for batch in batches:
            for a, b, winner in zip(batch["model_a"], batch["model_b"], batch["winner"], strict=True):
                x, y = rating.get(a, start), rating.get(b, start)
                expected = 1 / (1 + 10 ** ((y - x) / 400))
                change = step * ({"A": 1.0, "B": 0.0}.get(winner, 0.5) - expected)
                rating[a], rating[b] = x + change, y - change
                games[a], games[b] = games.get(a, 0) + 1, games.get(b, 0) + 1
        yield pd.DataFrame({"model": list(rating), "elo": [round(v, 6) for v in rating.values()], "games": [games[m] for m in rating]})

    return ordered.mapInPandas(fold, "model string, elo double, games long")
