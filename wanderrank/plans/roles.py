"""Role adapters: map concrete tables onto the role columns the operators use.

Two sources play the same roles:

* the travel catalogue (raw CSV/Parquet with the source column names), and
* the driver's TPC-H-like tables (customer, part, events, orders, lineitem,
  conversations, embeddings).

Each adapter is a projection (plus, for transactions, one equi-join), so
column pruning and filter pushdown reach the Parquet scan. The SQL twins in
``ORACLE_ROLES`` define the same roles for DuckDB; the oracle queries of
``__spark_entry__`` are written on top of them.

Money and scores of the driver tables are exact decimals: sums are then exact
and identical in any order, on any engine, which keeps the oracle check honest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderrank import schemas

# Event type of the driver stream -> interaction kind of the catalogue.
EVENT_KIND = {"purchase": "book", "click": "like", "signup": "review", "error": "share", "view": "view"}
# Order status of the driver orders -> booking state.
ORDER_STATUS = {"F": "completed", "O": "in_progress", "P": "cancelled"}
# Words of p_name used as "facilities" of a part (the nouns of the generator).
PART_FACILITIES = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]

SCORE_TYPE = "decimal(12,4)"
MONEY_TYPE = "decimal(18,4)"


@dataclass
class Roles:
    users: DataFrame
    items: DataFrame
    interactions: DataFrame
    transactions: DataFrame
    facilities: list[str]
    txn_key: list[str]
    turns: DataFrame | None = None
    vectors: DataFrame | None = None


def _map(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(F.lit(None).cast("string"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- driver tables

def driver_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("city"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("budget"),
    )


def driver_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("province"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("visit_hours"),
        F.col("p_name").alias("facilities"),
    )


def driver_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("interaction_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        _map(F.col("event_type"), EVENT_KIND).alias("kind"),
        (F.col("value").cast("decimal(12,2)") * F.lit(0.01).cast("decimal(2,2)"))
        .cast(SCORE_TYPE).alias("score"),
        F.col("ts").alias("ts"),
        F.lit(None).cast("double").alias("rating_given"),
    )


def driver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    paid = (F.col("l_extendedprice").cast("decimal(12,2)")
            * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY_TYPE)
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        paid.alias("paid"),
        _map(F.col("o_orderstatus"), ORDER_STATUS).alias("status"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        F.col("o_orderdate").cast("date").alias("check_in"),
        F.col("l_shipdate").cast("date").alias("check_out"),
        F.lit(None).cast("double").alias("rating_after"),
    )


def driver_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").alias("session_id"),
        F.col("conv_id").alias("user_id"),
        F.col("turn"),
        F.col("role"),
        F.col("text").alias("content"),
    )


def driver_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("item_id"),
                    F.col("embedding").cast("array<double>").alias("features"),
                    F.col("label"))


def driver_roles(spark: SparkSession, sf_dir: str) -> Roles:
    # the driver tables hold wall-clock (timestamp_ntz) values: read in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    from wanderrank.session import ship_package
    ship_package(spark)  # block tasks run this package's code in Python workers
    return Roles(
        users=driver_users(spark, sf_dir),
        items=driver_items(spark, sf_dir),
        interactions=driver_interactions(spark, sf_dir),
        transactions=driver_transactions(spark, sf_dir),
        facilities=PART_FACILITIES,
        txn_key=["order_key", "line_number"],
        turns=driver_turns(spark, sf_dir),
        vectors=driver_vectors(spark, sf_dir),
    )


# ---------------------------------------------------------------- travel tables

def travel_roles(users: DataFrame, items: DataFrame, interactions: DataFrame,
                 transactions: DataFrame) -> Roles:
    """Rename the raw travel tables (source column names) onto the roles. Every
    raw column goes through: those without a role keep their source name (with
    a ``raw_`` prefix where a role has it). The pipe list of preferred
    categories also becomes an array."""
    def onto(df: DataFrame, names: dict[str, str]) -> DataFrame:
        roles = set(names.values())
        return df.select(*[F.col(c).alias(names.get(c, f"raw_{c}" if c in roles else c)) for c in df.columns])

    u = onto(users, {"nama": "name", "usia": "age", "kota_asal": "city", "segmen": "segment",
                     "preferensi_kategori": "preferred_categories", "budget_per_trip": "budget",
                     "jumlah_trip": "trip_count", "member_sejak": "member_since"})
    if "preferred_categories" in u.columns:
        u = u.withColumn("preferred_list", F.filter(F.transform(
            F.split("preferred_categories", r"\|"), lambda x: F.trim(x)), lambda x: x != ""))
    i = onto(items, {"destination_id": "item_id", "nama_destinasi": "name", "kategori": "category",
                     "provinsi": "province", "rating_rata_rata": "rating", "harga_tiket_dewasa": "price",
                     "durasi_kunjungan_jam": "visit_hours", "fasilitas": "facilities", "tersedia": "available",
                     "total_pengunjung_tahunan": "annual_visitors"})
    x = onto(interactions, {"destination_id": "item_id", "tipe_interaksi": "kind", "skor_interaksi": "score",
                            "timestamp": "ts", "rating_diberikan": "rating_given"})
    t = onto(transactions, {"transaction_id": "txn_id", "destination_id": "item_id", "total_bayar": "paid",
                            "status_booking": "status", "tanggal_transaksi": "txn_date",
                            "tanggal_check_in": "check_in", "tanggal_check_out": "check_out",
                            "rating_pasca_kunjungan": "rating_after"})
    t = t.withColumn("status", _map(F.col("status"), schemas.TRAVEL_STATUSES))
    return Roles(users=u, items=i, interactions=x, transactions=t,
                 facilities=schemas.TRAVEL_FACILITIES, txn_key=["txn_id"])


# ---------------------------------------------------------------- DuckDB twins

def _case(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} END"


ORACLE_ROLES = {
    "r_users": """SELECT c_custkey AS user_id, c_name AS name, c_nationkey AS city,
        c_mktsegment AS segment, c_acctbal AS budget FROM customer""",
    "r_items": """SELECT p_partkey AS item_id, p_name AS name, p_type AS category,
        p_brand AS province, p_retailprice AS price, p_size AS visit_hours,
        p_name AS facilities FROM part""",
    "r_inter": f"""SELECT event_id AS interaction_id, user_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
        {_case('event_type', EVENT_KIND)} AS kind,
        CAST(CAST(value AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,4)) AS score,
        ts, CAST(NULL AS DOUBLE) AS rating_given FROM events""",
    "r_txn": f"""SELECT l_orderkey AS order_key, l_linenumber AS line_number,
        o_custkey AS user_id, l_partkey AS item_id,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
             AS DECIMAL(18,4)) AS paid,
        {_case('o_orderstatus', ORDER_STATUS)} AS status,
        CAST(o_orderdate AS DATE) AS txn_date, CAST(o_orderdate AS DATE) AS check_in,
        CAST(l_shipdate AS DATE) AS check_out, CAST(NULL AS DOUBLE) AS rating_after
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "r_turns": """SELECT conv_id AS session_id, conv_id AS user_id, turn, role,
        text AS content FROM conversations""",
}
