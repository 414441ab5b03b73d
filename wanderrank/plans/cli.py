"""Command-line jobs over the travel tables (source column names).

    python -m wanderrank.plans.cli etl --raw RAW --out OUT [--as-of "2024-02-01 00:00:00"]
    python -m wanderrank.plans.cli train --raw RAW --processed OUT --out MODEL
    python -m wanderrank.plans.cli recommend --raw RAW --model MODEL --requests REQ.json --out RECS

RAW holds ``user_profiles``, ``destination_catalog``, ``user_interactions``
and ``transaction_history`` as CSV files (with header) or Parquet folders.
Requests are JSON lines: ``{"user_id": ..., "top_n": ..., "preferences":
{"kategori": [...], "max_budget": ..., "provinsi": ..., "favorit_destinasi": [...]}}``.
The session (master, memory, ``spark.checkpoint.dir``) comes from
``spark-submit``; nothing here picks a machine-local folder on a cluster.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderrank import schemas
from wanderrank.operators import clean as C
from wanderrank.operators import collaborative as CF
from wanderrank.operators import ranking as R
from wanderrank.plans import etl as ETL
from wanderrank.plans.roles import Roles, travel_roles
from wanderrank.session import CORE_CONF, ensure_checkpoint_dir
from wanderrank.sources import files as IO
from wanderrank.sources import sinks as OUT


def load_raw(spark: SparkSession, raw: str) -> Roles:
    tables = {}
    for name, schema in schemas.RAW_TRAVEL.items():
        csv = os.path.join(raw, f"{name}.csv")
        tables[name] = IO.scan_csv_fallback(spark, os.path.join(raw, name), csv, schema)
    return travel_roles(tables["user_profiles"], tables["destination_catalog"],
                        tables["user_interactions"], tables["transaction_history"])


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    schema = ("user_id string, top_n int, preferences struct<kategori: array<string>, "
              "max_budget: double, provinsi: string, favorit_destinasi: array<string>>")
    df = spark.read.schema(schema).json(path)
    return df.select("user_id", "top_n",
                     F.col("preferences.favorit_destinasi").alias("favorites"),
                     F.col("preferences.kategori").alias("categories"),
                     F.col("preferences.max_budget").alias("max_budget"),
                     F.col("preferences.provinsi").alias("province"))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="wanderrank")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    e.add_argument("--raw", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--as-of")
    t = sub.add_parser("train")
    t.add_argument("--raw", required=True)
    t.add_argument("--processed", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--factorize", action="store_true")
    r = sub.add_parser("recommend")
    r.add_argument("--raw", required=True)
    r.add_argument("--model", required=True)
    r.add_argument("--requests", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--factorized", action="store_true", help="use the factor model that train --factorize kept")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName(f"wanderrank-{args.cmd}")
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    roles = load_raw(spark, args.raw)

    if args.cmd == "etl":
        counts = ETL.run_etl(spark, roles, args.out, args.as_of)
        print(counts)
    elif args.cmd == "train":
        items = spark.read.parquet(os.path.join(args.processed, "destination_features"))
        inter = C.clean_interactions(roles.interactions)
        users = spark.read.parquet(os.path.join(args.processed, "user_features"))
        print(ETL.run_training(spark, args.out, items, inter, n_users=users.count(),
                               factorize=args.factorize))
    else:
        nb = spark.read.parquet(os.path.join(args.model, "neighbours"))
        items = C.clean_items(roles.items)
        req, inter = read_requests(spark, args.requests), C.clean_interactions(roles.interactions)
        if args.factorized:
            parts = CF.load_model(spark, os.path.join(args.model, "factors"))
            recs = R.recommend_batch_factorized(req, inter, items, parts, nb)
        else:
            recs = R.recommend_batch(req, inter, items, nb)
        OUT.sink_parquet(recs, args.out)


if __name__ == "__main__":
    main()
