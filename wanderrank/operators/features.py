"""User and item feature tables, group min-max, category encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.functions import scalar as S
from wanderrank.functions import scores
from wanderrank.operators import aggregate as A
from wanderrank.operators.indexing import index_by
from wanderrank.session import saved

USER_FILLS = {
    "total_interactions": 0, "avg_score": 0.0, "total_book": 0, "total_review": 0,
    "total_like": 0, "unique_items": 0, "total_transactions": 0, "avg_spend": 0.0,
    "completed_transactions": 0,
}
ITEM_FILLS = {
    "total_views": 0, "unique_visitors": 0, "total_bookings": 0,
    "total_revenue": 0, "avg_transaction_value": 0,
}


def user_features(users: DataFrame, interactions: DataFrame, transactions: DataFrame,
                  txn_id: str = "txn_id") -> DataFrame:
    """Cleaned users + interaction and transaction aggregates (left joins on
    user_id), fills, log budget and engagement score. ``last_interaction``,
    ``max_spend``, ``avg_rating_given`` and ``avg_stay`` stay null.

    All three inputs are hash-partitioned on user_id by their own dedup /
    aggregate, so the two joins add no exchange of their own.
    """
    ui = A.agg_user_interactions(interactions)
    ut = A.agg_user_transactions(transactions, txn_id)
    df = users.join(ui, "user_id", "left").join(ut, "user_id", "left").fillna(USER_FILLS)
    df = df.withColumn("budget_log", F.log1p(F.col("budget")))
    return df.withColumn("engagement_score", scores.engagement_score(
        F.col("total_book"), F.col("total_review"), F.col("total_like"),
        F.col("completed_transactions")))


def facility_flags(df: DataFrame, facilities: list[str], col: str = "facilities",
                   exact_token: bool = False, sep: str = ",") -> DataFrame:
    """``has_<word>`` 0/1 columns, one per facility word."""
    return df.withColumns({f"has_{w}": S.contains_flag(F.col(col), w, exact_token, sep)
                           for w in facilities})


# Largest statistics or label table that is broadcast; its rows are counted first.
SMALL_ROWS = 100_000


def _join_small(df: DataFrame, table: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a per-label table to a wide one. The table is written and counted;
    up to ``SMALL_ROWS`` labels it is broadcast and the wide side is not
    exchanged. With more labels both sides are shuffled, and AQE splits the
    partitions of hot labels."""
    table = table.transform(saved)
    small = table.count() <= SMALL_ROWS
    return df.join(F.broadcast(table) if small else table, on, how)


def label_classes(items: DataFrame, price: str = "price") -> DataFrame:
    """One row per (category, province): lowest and highest price, item count.
    Written once; statistics and label counts of either column are sums of it."""
    return items.groupBy("category", "province").agg(
        F.min(price).alias("lo"), F.max(price).alias("hi"), F.count(F.lit(1)).alias("n")).transform(saved)


def group_minmax(df: DataFrame, by: str, col: str, out: str, stats: DataFrame | None = None) -> DataFrame:
    """window_minmax_price: (x - min) / (max - min + 1) inside each group.

    Planned as a grouped aggregate joined back rather than a window over
    ``by``: a window would put each whole group (a category can be a sixth of
    the table) into one task, while the aggregate is partial before the
    shuffle and comes back as a counted broadcast. ``stats`` (by, _lo, _hi)
    gives the statistics when they are known already."""
    if stats is None:
        stats = df.groupBy(by).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    stats = stats.withColumnRenamed(by, "_by")
    joined = _join_small(df, stats, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    return joined.withColumn(out, (F.col(col) - F.col("_lo")) /
                             (F.col("_hi") - F.col("_lo") + F.lit(1))).drop("_lo", "_hi")


def window_minmax(df: DataFrame, by: str, col: str, out: str) -> DataFrame:
    """The same rule as one WindowExec (three window functions, one spec);
    kept for small frames where a group fits one task."""
    w = Window.partitionBy(by)
    return df.withColumn(out, (F.col(col) - F.min(col).over(w)) /
                         (F.max(col).over(w) - F.min(col).over(w) + F.lit(1)))


def _label_table(counts: DataFrame, order: str) -> DataFrame:
    """(_label, _n) -> (_label, _idx). The labels are counted: up to ``SMALL_ROWS`` one
    task numbers them, beyond that a distributed sort does."""
    counts = counts.withColumn("_null", F.col("_label").isNull()).transform(saved)
    by = [F.col("_null"), *([F.col("_n").desc()] if order == "frequencyDesc" else []), F.col("_label").asc()]
    if counts.count() <= SMALL_ROWS:
        ranked = counts.withColumn("_pos", F.row_number().over(Window.orderBy(*by)))
    else:
        ranked = index_by(counts, *by, out="_pos")
    return ranked.select("_label", (F.col("_pos") - 1).cast("double").alias("_idx"))


def index_category(df: DataFrame, col: str, out: str, order: str = "frequencyDesc",
                   default: str | None = None, counts: DataFrame | None = None) -> DataFrame:
    """index_category / label_encode.

    ``frequencyDesc``: most frequent label -> 0, ties alphabetical, null -> the
    extra bucket (= number of labels), like StringIndexer(handleInvalid="keep").
    ``alphabetAsc`` with a ``default``: alphabetical index after replacing null
    by ``default`` (label encoder). ``counts`` (_label, _n) when known already.
    """
    key = F.coalesce(F.col(col), F.lit(default)) if default is not None else F.col(col)
    if counts is None:
        counts = df.select(key.alias("_label")).groupBy("_label").agg(F.count(F.lit(1)).alias("_n"))
    joined = _join_small(df, _label_table(counts, order), key.eqNullSafe(F.col("_label")))
    return joined.withColumnRenamed("_idx", out).drop("_label")


def label_encode(df: DataFrame, col: str, out: str, default: str) -> DataFrame:
    return index_category(df, col, out, order="alphabetAsc", default=default)


def item_features(items: DataFrame, interactions: DataFrame, transactions: DataFrame,
                  facilities: list[str], txn_id: str = "txn_id",
                  exact_token: bool = False) -> DataFrame:
    """Cleaned items + popularity and revenue aggregates, facility flags,
    popularity score, price normalised inside the category, frequency
    indexes of category and province. ``avg_interaction_score``,
    ``avg_user_rating`` and ``total_completed_bookings`` stay null.

    The group statistics come from one narrow aggregate of the cleaned items
    (``label_classes``: left joins on unique keys do not change them), so the
    wide table is neither read again for them nor exchanged on a label."""
    classes = label_classes(items)
    pop = A.agg_item_popularity(interactions)
    rev = A.agg_item_revenue(transactions, txn_id)
    df = items.join(pop, "item_id", "left").join(rev, "item_id", "left").fillna(ITEM_FILLS)
    df = facility_flags(df, facilities, exact_token=exact_token)
    df = df.withColumn("popularity_score", scores.popularity_score(
        F.col("total_views"), F.col("unique_visitors"), F.col("total_bookings")))
    df = group_minmax(df, "category", "price", "price_normalized",
                      classes.groupBy("category").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi")))
    for col in ("category", "province"):
        counts = classes.groupBy(F.col(col).alias("_label")).agg(F.sum("n").alias("_n"))
        df = index_category(df, col, f"{col}_idx", counts=counts)
    return df
