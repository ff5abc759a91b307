"""Scalar building blocks, all JVM-side Column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(x, digits: int) -> Column:
    """``Math.round(x * 10^d) / 10^d`` on a double: floor(x*10^d + 0.5) / 10^d.

    Not ``round(x, d)``, which rounds the decimal form and can differ.
    """
    scale = float(10 ** digits)
    return F.floor(col(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def percent(num, den, digits: int) -> Column:
    """``num/den`` in percent, half-up to ``digits`` decimals; 0/0 gives 0.0.

    The reference divides doubles (0/0 = NaN, and ``Math.round(NaN)`` = 0);
    Spark's ANSI division raises instead, so ``try_divide`` + ``coalesce``.
    """
    ratio = F.coalesce(F.try_divide(col(num), col(den)), F.lit(0.0))
    scale = float(10 ** (digits + 2))
    return F.floor(ratio * F.lit(scale) + F.lit(0.5)) / F.lit(float(10 ** digits))


def split_ids(c) -> Column:
    """Comma list -> array of non-empty parts (Java's split drops empty tails)."""
    return F.filter(F.split(col(c), ","), lambda s: s != F.lit(""))


def fmt_ts(c, fmt: str = TS_FORMAT) -> Column:
    return F.date_format(col(c), fmt)


def seconds_between(start, end) -> Column:
    """Whole seconds from start to end (times carry second precision)."""
    return F.timestamp_diff("SECOND", col(start), col(end))


def ordered_join(value, *order, sep: str = ",", none_if_empty: bool = False) -> Column:
    """Values of a group joined in the given order; nulls skipped, no value -> '' (or null).

    ``collect_list`` of (order..., value) structs aggregates partially on the
    map side; the sort happens once per group at the end.
    """
    v = col(value)
    items = F.collect_list(F.when(v.isNotNull(), F.struct(*[col(o) for o in order], v.cast("string").alias("__v"))))
    text = F.array_join(F.transform(F.array_sort(items), lambda s: s["__v"]), sep)
    return F.when(F.size(items) > 0, text) if none_if_empty else text


def json_pairs(pairs_sorted: Column) -> Column:
    """array<struct<k,v>> -> ``[{"k1":v1},{"k2":v2}]`` (one-field objects, json4s style)."""
    return F.to_json(F.transform(pairs_sorted, lambda p: F.create_map(p["k"], p["v"])))


def double_text(c) -> Column:
    """Double as the JVM prints it (``50.0``, ``33.3``) for shares in [0, 100]."""
    return col(c).cast("double").cast("string")
