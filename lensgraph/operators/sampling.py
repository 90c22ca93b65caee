"""Deterministic stratified samples, set-based: seats are rows that are ranked, not dealt in a loop.

The k-th seat of a stratum of n photos beyond its floor q has priority
(n - q - k) / sqrt(n), which falls with k.  Dealing one seat at a time to the
stratum of highest priority is therefore the same as taking the first seats in order of
priority, and dealing one seat per stratum and pass is the order (k, priority).

Only strata counts are exploded to seats, never photos, and no stratum gives more
seats than the sample has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def strata(photos: DataFrame, keys: list[str], floor_least: int, order: str = "path_rel") -> DataFrame:
    """(keys..., n, floor, first_seen) of each stratum; the floor is max(floor_least, round(2 sqrt n)), at most n."""
    grouped = photos.groupBy(*keys).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    return grouped.withColumn("floor", F.least("n", F.greatest(F.lit(floor_least), F.round(2 * F.sqrt("n")))).cast("long"))


def quotas(groups: DataFrame, target: int, method: str) -> DataFrame:
    """``groups`` with quota.  ``greedy`` raises if the floors exceed ``target`` or the strata are exhausted; ``round_robin`` accepts both."""
    floors, total = groups.agg(F.coalesce(F.sum("floor"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rest = target - floors
    if method == "greedy":
        if rest < 0:
            raise ValueError("the floors of the strata exceed the sample size")
        if total < target:
            raise ValueError("the strata hold fewer photos than the sample size")
    elif method != "round_robin":
        raise ValueError(f"unknown method {method}")
    if rest <= 0:
        return groups.withColumn("quota", F.col("floor"))
    seats = groups.where("n > floor").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("n") - F.col("floor"), F.lit(rest).cast("long")) - 1)))
    priority = (F.col("n") - F.col("floor") - F.col("k")) / F.sqrt("n")
    order = [F.desc("priority"), F.asc("first_seen")] if method == "greedy" else [F.asc("k"), F.desc("priority"), F.asc("first_seen")]
    # One ordered limit over seats; its result has ``rest`` rows.
    dealt = seats.withColumn("priority", priority).orderBy(*order).limit(rest).groupBy("first_seen").agg(F.count("*").alias("extra"))
    return groups.join(dealt, "first_seen", "left").withColumn("quota", F.col("floor") + F.coalesce("extra", F.lit(0))).drop("extra")


def pick(photos: DataFrame, keys: list[str], quota: Column | DataFrame, path: str = "path_rel") -> DataFrame:
    """The first photos of each stratum in order of the SHA-256 of their path, up to its quota (a constant or a table of strata)."""
    joined = photos.join(quota.select(*keys, "quota"), keys) if isinstance(quota, DataFrame) else photos.withColumn("quota", quota)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.sha2(path, 256), path))
    return joined.withColumn("place", place).where("place <= quota").drop("quota")


def stratified(photos: DataFrame, keys: list[str], target: int, method: str = "greedy", floor_least: int | None = None) -> DataFrame:
    least = floor_least if floor_least is not None else {"greedy": 4, "round_robin": 8}[method]
    return pick(photos, keys, quotas(strata(photos, keys, least), target, method))


def seeded_sample(photos: DataFrame, n: int, seed: int, key: str = "path_rel") -> DataFrame:
    """n rows in order of a seeded hash: the deterministic stand-in for a random sample."""
    return photos.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key)), 256), key).limit(n)
