"""Cleaning operators (role tables in, cleaned role tables out).

Order matters and follows the source system: de-duplicate on the id first,
then apply validity filters. A duplicate id whose surviving copy is invalid
therefore drops the id entirely; moving the filters before the dedup would
change the answer, so Catalyst may push only the key-not-null filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank import schemas
from wanderrank.functions import scalar as S


def dedup_by_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """dedup_by_key: one row per key; the survivor is the smallest row by all
    remaining columns (ascending, nulls first), so the result is deterministic.

    ``row_number() ... = 1`` is planned with a partial WindowGroupLimit before
    the shuffle, so a hot key is cut to one row per map task before it moves.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_first() for c in rest] or [F.lit(1)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def filter_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive range; null drops."""
    return df.filter(F.col(col).between(lo, hi))


_OPS = {">": Column.__gt__, ">=": Column.__ge__, "<": Column.__lt__, "<=": Column.__le__,
        "==": Column.__eq__, "!=": Column.__ne__}


def filter_compare(df: DataFrame, col: str, op: str, value) -> DataFrame:
    return df.filter(_OPS[op](F.col(col), F.lit(value)))


def filter_isin(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """fillna restricted to columns the frame has (source tables vary)."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(present) if present else df


def cast_cols(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """cast present columns; text input is cast with ``try_cast`` semantics."""
    out = df
    for c, t in types.items():
        if c not in out.columns:
            continue
        if out.schema[c].dataType.typeName() == "string":
            out = out.withColumn(c, F.expr(f"try_cast(`{c}` AS {t})"))
        else:
            out = out.withColumn(c, F.col(c).cast(t))
    return out


# ---------------------------------------------------------------- compositions

def clean_users(users: DataFrame, as_of: str | None = None,
                age_range: tuple[int, int] = (12, 80)) -> DataFrame:
    """clean_users: dedup, key not null, age in range, budget > 0, casts,
    join date parsed, days since join (to ``as_of``, default today),
    ``is_active`` null -> true. Checks on absent columns are skipped."""
    df = dedup_by_key(users, "user_id")
    df = filter_not_null(df, "user_id")
    if "age" in df.columns:
        df = filter_between(df, "age", *age_range)
    df = filter_compare(df, "budget", ">", 0)
    df = cast_cols(df, {"budget": "bigint", "trip_count": "int"})
    if "member_since" in df.columns:
        df = df.withColumn("member_since", S.parse_date(df, "member_since"))
        ref = F.to_date(F.lit(as_of)) if as_of else F.current_date()
        df = df.withColumn("days_since_join", S.days_between(ref, F.col("member_since")))
    return fill_defaults(df, {"is_active": True})


def clean_items(items: DataFrame, rating_range: tuple[float, float] = (1.0, 5.0)) -> DataFrame:
    """clean_items: dedup, key not null, rating in range, price >= 0, fills."""
    df = dedup_by_key(items, "item_id")
    df = filter_not_null(df, "item_id")
    if "rating" in df.columns:
        df = filter_between(df, "rating", *rating_range)
    df = filter_compare(df, "price", ">=", 0)
    return fill_defaults(df, {"facilities": schemas.DEFAULT_FACILITIES, "available": True,
                              "annual_visitors": 0})


def clean_interactions(interactions: DataFrame, score_range=(0.0, 1.0)) -> DataFrame:
    """clean_interactions: dedup, user/item not null, score in range,
    timestamp parsed, hour / day of week / month."""
    df = dedup_by_key(interactions, "interaction_id")
    df = filter_not_null(df, "user_id", "item_id")
    df = filter_between(df, "score", *score_range)
    df = df.withColumn("ts", S.parse_ts(df, "ts"))
    for name, c in S.date_parts(F.col("ts")).items():
        df = df.withColumn(name, c)
    return df


def clean_transactions(transactions: DataFrame, key: str | list[str] = "txn_id",
                       valid_statuses: list[str] | None = None,
                       completed: str = schemas.COMPLETED) -> DataFrame:
    """clean_transactions: dedup on the id, user not null, paid > 0, status in
    the valid set, dates parsed, nights of stay, completed flag."""
    df = dedup_by_key(transactions, key)
    df = filter_not_null(df, "user_id")
    df = filter_compare(df, "paid", ">", 0)
    df = filter_isin(df, "status", valid_statuses or schemas.VALID_STATUSES)
    df = df.withColumn("txn_date", S.parse_date(df, "txn_date"))
    df = df.withColumn("check_in", S.parse_date(df, "check_in"))
    df = df.withColumn("stay_nights",
                       S.days_between(S.parse_date(df, "check_out"), F.col("check_in")))
    return df.withColumn("is_completed", (F.col("status") == completed).cast("int"))
