"""Scalar column functions (all JVM-side built-ins, inside whole-stage codegen).

Functions that depend on a column's type take the DataFrame's schema so that
text columns are parsed (``try_*``: bad text becomes null, never an error)
and typed columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def parse_date(df: DataFrame, name: str, fmt: str = "yyyy-MM-dd") -> Column:
    """fn_parse_date: ``yyyy-MM-dd`` text -> date; bad text -> null."""
    t = _dtype(df, name)
    if isinstance(t, T.StringType):
        return F.try_to_date(F.col(name), fmt)
    return F.col(name).cast("date")


def parse_ts(df: DataFrame, name: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """fn_parse_ts: ``yyyy-MM-dd HH:mm:ss`` text -> timestamp; bad text -> null."""
    t = _dtype(df, name)
    if isinstance(t, T.StringType):
        return F.try_to_timestamp(F.col(name), F.lit(fmt))
    return F.col(name)


def date_parts(ts: Column) -> dict[str, Column]:
    """fn_date_parts: hour, day of week (1 = Sunday) and month."""
    return {"hour": F.hour(ts), "day_of_week": F.dayofweek(ts), "month": F.month(ts)}


def days_between(end: Column, start: Column) -> Column:
    """fn_datediff: whole days from ``start`` to ``end``."""
    return F.datediff(end, start)


def clip_upper(c: Column, hi: float) -> Column:
    """ETL clip: ``least(x, hi)`` (a null x gives hi, as Spark's least skips nulls)."""
    return F.least(c, F.lit(hi))


def clip_rating(c: Column, lo: float = 0.0, hi: float = 5.0, null_as: float = 1.0,
                dtype: str | None = None) -> Column:
    """CF clip: clip into [lo, hi] first, then null -> ``null_as``.

    The null guard comes first because least/greatest skip nulls. ``dtype``
    keeps the literals in the input's type (an exact decimal stays exact).
    """
    def lit(v):
        return F.lit(v).cast(dtype) if dtype else F.lit(v)
    return F.when(c.isNull(), lit(null_as)).otherwise(F.least(F.greatest(c, lit(lo)), lit(hi)))


def flag(c: Column) -> Column:
    """fn_case: boolean -> 0/1 integer (null -> 0)."""
    return F.when(c, 1).otherwise(0)


def contains_flag(text: Column, word: str, exact_token: bool = False, sep: str = ",") -> Column:
    """fn_contains_flags: 1 when ``word`` occurs in ``text``.

    Default is substring search (can over-match, e.g. "guide" in "guided");
    ``exact_token`` splits on ``sep`` and compares whole trimmed tokens.
    """
    if exact_token:
        tokens = F.transform(F.split(text, sep), lambda s: F.trim(s))
        return flag(F.array_contains(tokens, word))
    return flag(text.contains(word))


def round4(c: Column) -> Column:
    return F.round(c, 4)


def truncate(c: Column, n: int) -> Column:
    """fn_truncate: first ``n`` characters."""
    return F.substring(c, 1, n)


def format_money(c: Column, decimals: int = 0) -> Column:
    """fn_format_money: thousands separators (1234567 -> 1,234,567); whole
    amounts with no decimals, fractional amounts with ``decimals``."""
    return F.format_number(c.cast("double"), decimals)


def key_concat(*parts: Column, sep: str = "-") -> Column:
    """fn_key_concat: ``user-epochsecond`` style keys."""
    return F.concat_ws(sep, *[p.cast("string") for p in parts])


def exact_avg(c: Column) -> Column:
    """Average as ``double(sum) / count``.

    For decimal inputs the sum is exact, so the result is bit-identical in any
    order and on any engine; for doubles it is the ordinary mean.
    """
    return F.sum(c).cast("double") / F.count(c)


def first_present(df: DataFrame, candidates: list[str]) -> str | None:
    """The first of ``candidates`` that is a column of ``df`` (score-column probe)."""
    return next((c for c in candidates if c in df.columns), None)
