"""Data-quality expectations: each is one row (check_name, violations), computed as an aggregate."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgraph.functions.scalars import dot


def _row(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def unique(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return _row(f"unique: {name}", df.groupBy(*keys).count().where("count > 1"))


def references(name: str, child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    return _row(f"references: {name}", child.join(parent, keys, "left_anti"))


def domain(name: str, df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return _row(f"domain: {name}", df.where(F.col(column).isNull() | ~F.col(column).isin(values)))


def within(name: str, df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return _row(f"within: {name}", df.where(F.col(column).isNull() | ~F.col(column).between(low, high)))


def filled(name: str, df: DataFrame, column: str) -> DataFrame:
    return _row(f"filled: {name}", df.where(F.col(column).isNull()))


def row_count(name: str, df: DataFrame, expected: int) -> DataFrame:
    return df.agg(F.abs(F.count("*") - F.lit(expected)).alias("violations")).select(F.lit(f"row count: {name}").alias("check_name"), "violations")


def ordered_pair(name: str, df: DataFrame, a: str = "image_a", b: str = "image_b") -> DataFrame:
    return _row(f"ordered pair: {name}", df.where(F.col(a).isNull() | F.col(b).isNull() | (F.col(a) >= F.col(b))))


def unit_norm(name: str, df: DataFrame, column: str, dimension: int, tolerance: float = 1e-3) -> DataFrame:
    bad = F.col(column).isNull() | F.exists(column, lambda x: x.isNull() | F.isnan(x)) | (F.size(column) != dimension) | (F.abs(F.sqrt(dot(F.col(column), F.col(column))) - 1) > tolerance)
    return _row(f"unit norm: {name}", df.where(bad))


def declared_size(name: str, parents: DataFrame, children: DataFrame, key: str, declared: str) -> DataFrame:
    actual = children.groupBy(key).agg(F.count("*").alias("__n"))
    return _row(f"declared size: {name}", parents.join(actual, key, "full").where(~F.col(declared).eqNullSafe(F.col("__n"))))


def least_size(name: str, df: DataFrame, declared: str, least: int = 2) -> DataFrame:
    """Groups have ``least`` members at least."""
    return _row(f"least size: {name}", df.where(F.col(declared).isNull() | (F.col(declared) < least)))


def totals(name: str, counts: DataFrame, by: list[str], n: str, expected: int) -> DataFrame:
    """The counts of a contingency table add up to ``expected`` for each of ``by``."""
    return _row(f"totals: {name}", counts.groupBy(*by).agg(F.sum(n).alias("__n")).where(~F.col("__n").eqNullSafe(F.lit(expected))))


def unchanged(name: str, before: DataFrame, after: DataFrame, keys: list[str], digest: str = "sha256") -> DataFrame:
    """Every key of either side is on both, with the same digest; keys are unique and not null."""
    a = before.select(*keys, F.col(digest).alias("__a"))
    b = after.select(*keys, F.col(digest).alias("__b"))
    return _row(f"unchanged: {name}", a.join(b, keys, "full").where(F.col("__a").isNull() | F.col("__b").isNull() | (F.col("__a") != F.col("__b"))))


def manifest_count(name: str, df: DataFrame, document: str) -> DataFrame:
    """``df`` has as many rows as its manifest says."""
    return row_count(f"manifest: {name}", df, json.loads(document)["rows"])


def required_columns(df: DataFrame, columns: set[str]) -> None:
    missing = columns - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")


def run(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def enforce(checks: DataFrame) -> None:
    """Raises if any expectation is violated; the table has one row a check."""
    bad = checks.where("violations > 0").collect()
    if bad:
        raise ValueError("; ".join(f"{r['check_name']}: {r['violations']}" for r in bad))
