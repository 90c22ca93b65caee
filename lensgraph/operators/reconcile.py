"""Joins of photos with registers and with earlier versions of themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., n) of the keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that fails if a key repeats on either side."""
    for name, side in (("left", left), ("right", right)):
        if not duplicate_keys(side, keys).isEmpty():
            raise ValueError(f"keys {keys} repeat on the {name} side")
    return left.join(right, keys, "left")


def lookup(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides with equal keys; strategy and broadcast are the planner's."""
    return left.join(right, keys)


def complete_lookup(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``lookup`` that fails if a row of the left side finds nothing."""
    if not unmatched(left, right, keys).isEmpty():
        raise ValueError("rows without a partner")
    return lookup(left, right, keys)


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")


def match_profile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(side, n): pairs of rows that match, and rows of one side alone."""
    a = left.select(*keys, F.lit(True).alias("__l"))
    b = right.select(*keys, F.lit(True).alias("__r"))
    side = F.when(F.col("__l").isNull(), "right_only").when(F.col("__r").isNull(), "left_only").otherwise("both")
    return a.join(b, keys, "full").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def in_scope(df: DataFrame, column: str = "in_scope") -> DataFrame:
    """Rows that are in scope for certain; unknown is out."""
    return df.where(F.col(column).eqNullSafe(F.lit(True)))


def mapped(df: DataFrame, column: str, values: dict[str, str], default: str) -> DataFrame:
    """A column ``mapped`` through a small dictionary, with a default."""
    table = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return df.withColumn("mapped", F.coalesce(F.try_element_at(table, F.col(column)), F.lit(default)))


def optional_join(left: DataFrame, right: DataFrame | None, keys: list[str], defaults: dict[str, int]) -> DataFrame:
    """Left join with a table that need not exist; what is missing takes its default."""
    if right is None:
        return left.withColumns({c: F.lit(v) for c, v in defaults.items()})
    joined = left.join(right.select(*keys, *defaults), keys, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def edits(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys..., field, before, after) of every value that differs, null-safe, between rows of equal key."""
    joined = before.alias("b").join(after.alias("a"), keys)
    found = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"b.{f}").cast("string").alias("before"), F.col(f"a.{f}").cast("string").alias("after"), (~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}"))).alias("differs")) for f in fields))
    some = reduce(lambda x, y: x | y, (~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")) for f in fields))
    return joined.where(some).select(*keys, F.explode(F.filter(found, lambda x: x["differs"])).alias("x")).select(*keys, "x.field", "x.before", "x.after")


def public_columns(df: DataFrame, private: set[str]) -> DataFrame:
    """``df`` without its private columns."""
    out = df.select(*(c for c in df.columns if c not in private))
    if private & set(out.columns):
        raise ValueError("a private column is left")
    return out


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, with repeats."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
