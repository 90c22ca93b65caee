"""Scalar functions as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """The last part of a path with either kind of slash."""
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def path_part(path: Column, from_end: int) -> Column:
    """A part of a path counted from its end; null where it has fewer parts."""
    return F.try_element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), F.lit(-from_end))


def hex_to_long(value: Column) -> Column:
    """16 hexadecimal digits as a signed 64-bit number."""
    return F.conv(value, 16, -10).cast("long")


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes in hexadecimal; null if either is missing."""
    return F.bit_count(hex_to_long(a).bitwiseXOR(hex_to_long(b)))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def dot(a: Column, b: Column) -> Column:
    """Sum of products in array order, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def l2_normalised(v: Column) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.when(norm > 0, F.transform(v, lambda x: (x.cast("double") / norm).cast("float"))).otherwise(v)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def step_score(x: Column, same: float, near: float, near_score: float = 0.6) -> Column:
    """1 up to ``same``, ``near_score`` up to ``near``, else 0; null stays null."""
    value = x.cast("double")
    return F.when(~finite(value), F.lit(None).cast("double")).when(value <= same, F.lit(1.0)).when(value <= near, F.lit(near_score)).otherwise(F.lit(0.0))


def weighted_mean(parts: list[tuple[Column, float]]) -> Column:
    """Mean over the parts that are present; sums run in the order given."""
    zero = F.lit(0.0)
    total = reduce(lambda acc, p: acc + F.when(p[0].isNull(), zero).otherwise(p[0] * F.lit(p[1])), parts, zero)
    weight = reduce(lambda acc, p: acc + F.when(p[0].isNull(), zero).otherwise(F.lit(p[1])), parts, zero)
    return total / F.when(weight == 0, F.lit(1.0)).otherwise(weight)


def banded(x: Column, bands: list[tuple[float, str]], default: str, missing: str | None = None) -> Column:
    chain = F.when(x.isNull(), F.lit(missing)) if missing is not None else F.when(F.lit(False), F.lit(default))
    for least, label in bands:
        chain = chain.when(x >= least, F.lit(label))
    return chain.otherwise(F.lit(default))


def sorted_distinct_join(x: Column, separator: str = "; ") -> Column:
    """An aggregate: the distinct values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(x)), separator)


def script_safe_json(x: Column) -> Column:
    """JSON that may stand inside an HTML script element."""
    return F.replace(F.to_json(x), F.lit("<"), F.lit("\\u003c"))


def iso_seconds(x: Column) -> Column:
    """A date or time as ISO text, to the second."""
    return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss")


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres, to three decimals."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.round(2 * 6371000.0 * F.asin(F.sqrt(F.least(F.lit(1.0), a))), 3)


def quality_score(code: Column, file_size: Column) -> Column:
    """Rank of a photo within its cluster."""
    by_code = F.when(code == "S", 100.0).when(code == "B", -30.0).when(code == "P", -25.0).when(code.isin("J", "H"), -20.0).otherwise(0.0)
    return F.round(by_code + F.least(F.lit(20.0), F.coalesce(file_size, F.lit(0)).cast("double") / 100000), 3)
