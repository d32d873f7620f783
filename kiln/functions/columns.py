"""Scalar column helpers (X1-X7). All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise otherwise)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def pct(a, b, digits: int = 4) -> Column:
    return F.round(safe_div(col(a) * 100.0, b), digits)


def blank_to_null(c) -> Column:
    """Trimmed text, NULL when empty."""
    t = F.trim(col(c))
    return F.when(t == "", F.lit(None)).otherwise(t)


def to_number(c) -> Column:
    """String to double; malformed text becomes NULL instead of raising."""
    return blank_to_null(c).try_cast("double")


def parse_date(c, fmt: str = "MM/dd/yyyy") -> Column:
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("date")


def parse_hour(c, fmt: str = "HH:mm") -> Column:
    """Hour of a time-of-day text; parsing by pattern, not a bare cast that
    would depend on the current day."""
    return F.hour(F.try_to_timestamp(col(c), F.lit(fmt)))


def sq_dist(x, y, cx: float, cy: float) -> Column:
    dx = col(x) - F.lit(float(cx))
    dy = col(y) - F.lit(float(cy))
    return dx * dx + dy * dy


def dot(a, b) -> Column:
    """Dot product of two equal-length array<double> columns."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda u, v: u * v), F.lit(0.0), lambda acc, x: acc + x)


def norm2(a) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x * x))


def argmax(a) -> Column:
    """1-based position of the largest element; the first one on ties."""
    return F.array_position(col(a), F.array_max(col(a)))


def hash_code(c, buckets: int | None = None) -> Column:
    """Stable hash of a value as a feature code (X6): 60 bits of its MD5.
    Python's ``hash`` of a string differs between processes."""
    h = F.conv(F.substring(F.md5(col(c).cast("string")), 1, 15), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets)) if buckets else h
