"""Profiles and calibration slices: counts, exact quantiles, descriptions, extremes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lensgraph.operators.graph import cut_lineage

QUANTILES = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]
SLICE = 25


@dataclass(frozen=True)
class Slice:
    """Photos that meet ``where`` (of metrics and quantiles): the extremes of ``metric``, or a sample by ``seed``.

    A condition is (metric, low, high); a bound is a value or ("q", quantile of the metric), and None is open.
    """

    name: str
    metric: str | None = None
    largest: bool = False
    seed: int | None = None
    where: tuple = ()


# The fifteen calibration slices, in order.
SLICES = [
    Slice("edge_low", "edge_mean"),
    Slice("edge_low_close", "edge_mean", where=(("dark_ratio", ("q", 0.65), None),)),
    Slice("bright_high", "clip_terang", largest=True),
    Slice("dark_high", "clip_gelap", largest=True),
    Slice("candidate_low", "comp_long"),
    Slice("candidate_small", seed=11, where=(("comp_long", 1, ("q", 0.15)),)),
    Slice("candidate_mid", seed=12, where=(("comp_long", ("q", 0.45), ("q", 0.55)),)),
    Slice("candidate_large", "comp_long", largest=True),
    Slice("touch_large", seed=13, where=(("comp_touch", 1, 1), ("comp_long", ("q", 0.65), None))),
    Slice("vegetation_high", "vegetasi_ratio", largest=True),
    Slice("no_candidate_dark", "dark_ratio", largest=True, where=(("comp_long", None, 8), ("dark_ratio", 0.08, None))),
    Slice("chroma_high", "chroma_std", largest=True),
    Slice("green_small", seed=14, where=(("green_long", 1, ("q", 0.20)),)),
    Slice("green_mid", seed=15, where=(("green_long", ("q", 0.45), ("q", 0.55)),)),
    Slice("green_large", "green_long", largest=True),
]
# End of the fixed values.


def _bounds() -> list[tuple[str, float]]:
    return sorted({(m, b[1]) for s in SLICES for m, *ends in s.where for b in ends if isinstance(b, tuple)})


def calibration_slices(photos: DataFrame) -> DataFrame:
    """(slice, path_rel): fifteen slices of SLICE photos, in one pass after the quantiles.

    A photo goes once into each slice that it qualifies for, with its place in that
    slice's order; a ranked limit a slice keeps SLICE rows of each task before the shuffle.
    """
    needed = _bounds()
    table = exact_quantiles(photos, {m: sorted({q for n, q in needed if n == m}) for m, _ in needed})
    known = {(r["metric"], r["q"]): r["value"] for r in table.collect()}

    def holds(s: Slice) -> Column:
        out = F.col(s.metric).isNotNull() if s.metric else F.lit(True)
        for metric, low, high in s.where:
            value = lambda b: known.get((metric, b[1])) if isinstance(b, tuple) else b  # noqa: B023,E731
            if low is not None:
                out = out & (F.col(metric) >= F.lit(value(low)).cast("double"))
            if high is not None:
                out = out & (F.col(metric) <= F.lit(value(high)).cast("double"))
        return out

    def entry(s: Slice) -> Column:
        place = F.col(s.metric).cast("double") * (-1 if s.largest else 1) if s.metric else F.lit(0.0)
        drawn = F.lit("") if s.metric else F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("path_rel")), 256)
        return F.when(F.coalesce(holds(s), F.lit(False)), F.struct(F.lit(s.name).alias("slice"), place.alias("place"), drawn.alias("drawn"), F.col("path_rel").alias("path_rel")))

    entries = photos.select(F.explode(F.filter(F.array(*map(entry, SLICES)), lambda x: x.isNotNull())).alias("e")).select("e.*")
    ranked = entries.withColumn("rank", F.row_number().over(Window.partitionBy("slice").orderBy("place", "drawn", "path_rel")))
    return ranked.where(F.col("rank") <= SLICE).select("slice", "path_rel")


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> DataFrame:
    """(metric, q, value): exact quantiles with linear interpolation; nulls do not count.

    Values are counted by metric and value, so what is sorted is distinct values,
    and ranks come from range partitions: a running count within each partition
    on top of the partitions' totals.  No task holds a whole column.
    """
    names = list(wanted)
    counted = df.unpivot([], [F.col(c).cast("double").alias(c) for c in names], "metric", "x").where("x IS NOT NULL").groupBy("metric", "x").agg(F.count("*").alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = counted.repartitionByRange(parts, "metric", "x").withColumn("part", F.spark_partition_id())
    laid = cut_lineage(laid)
    before = Window.partitionBy("metric").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy("metric", "part").agg(F.sum("n").alias("held")).withColumns({"offset": F.coalesce(F.sum("held").over(before), F.lit(0)), "total": F.sum("held").over(Window.partitionBy("metric"))})
    asked = totals.select("metric", "part", "offset", "held", "total", F.explode(F.create_map(*(x for m in names for x in (F.lit(m), F.array(*map(F.lit, wanted[m]))))).getItem(F.col("metric"))).alias("q"))
    at = F.col("q") * (F.col("total") - 1)
    ranks = asked.select("metric", "part", "offset", "held", "q", (at - F.floor(at)).alias("share"), F.explode(F.array(F.floor(at), F.ceil(at))).alias("rank"), F.floor(at).alias("low")).where("rank >= offset AND rank < offset + held")
    run = laid.withColumn("upto", F.sum("n").over(Window.partitionBy("metric", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = ranks.alias("r").join(run.alias("v"), F.expr("r.metric = v.metric AND r.part = v.part AND r.rank >= r.offset + v.upto - v.n AND r.rank < r.offset + v.upto"))
    ends = found.groupBy("r.metric", "q", "share").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    return ends.select("metric", "q", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("value"))


def quantiles(df: DataFrame, columns: list[str], at: list[float]) -> DataFrame:
    """(metric, q, value): exact quantiles with linear interpolation, six decimals, all columns in one pass."""
    return exact_quantiles(df, {c: at for c in columns}).select("metric", "q", F.round("value", 6).alias("value"))


def quantile_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS metric, {q}::DOUBLE AS q, round(quantile_cont({c}, {q})::DOUBLE, 6) AS value FROM {table}" for c in columns for q in QUANTILES)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, n, mean, std, min, q25, q50, q75, max), six decimals."""
    flat = df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "metric", "x")
    r = lambda x, name: F.round(x, 6).alias(name)
    moments = flat.groupBy("metric").agg(F.count("x").alias("n"), r(F.avg("x"), "mean"), r(F.stddev_samp("x"), "std"), r(F.min("x"), "min"), r(F.max("x"), "max"))
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    ranks = exact_quantiles(df, {c: list(names) for c in columns}).groupBy("metric").agg(*(r(F.max(F.when(F.col("q") == q, F.col("value"))), n) for q, n in names.items()))
    return moments.join(ranks, "metric", "left").select("metric", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS metric, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM {table}"
        for c in columns
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) of every column, in one pass."""
    one = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return one.unpivot([], df.columns, "column", "nulls")


def crosstab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts by two columns, with a zero where nothing occurs; the second one's values are given, so one pass will do."""
    return df.groupBy(rows).pivot(columns, values).count().na.fill(0, values)


def feature_code_matrix(long: DataFrame, codes: list[str]) -> DataFrame:
    """(ciri, nilai, one column a code): counts with explicit zeros."""
    return long.groupBy("ciri", "nilai").pivot("kode", codes).count().na.fill(0, codes)
