"""Incremental states, the bucketed session table, drifting CSV folders."""

import contextlib
import io
import os
import random
import tempfile
import uuid

import pytest

from wanderrank.operators import aggregate as A
from wanderrank.operators import chat as CH
from wanderrank.plans import incremental as INC
from wanderrank.sources import drift as DR
from wanderrank.sources import keyvalue as KV
from wanderrank.sources import sessions as SES

INTER = "interaction_id long, user_id long, item_id long, kind string, score decimal(12,4), ts timestamp, rating_given int"
TXN = "txn_id long, user_id long, item_id long, paid decimal(12,2), status string, rating_after int, stay_nights int, is_completed int"


def raw(seed, n, first):
    rnd = random.Random(seed)
    i = [(first + k, rnd.randrange(20), rnd.randrange(30), rnd.choice(["book", "review", "like", "view"]),
          round(rnd.random(), 4), None, rnd.choice([None, 1, 5])) for k in range(n)]
    t = [(first + k, rnd.randrange(20), rnd.randrange(30), round(rnd.random() * 100, 2), rnd.choice(["completed", "cancelled"]),
          rnd.choice([None, 2, 4]), rnd.choice([None, 1, 3]), rnd.randrange(2)) for k in range(n // 2)]
    return i, t


def frames(spark, rows):
    from decimal import Decimal as D
    i = [(*r[:4], None if r[4] is None else D(str(r[4])), *r[5:]) for r in rows[0]]
    t = [(*r[:3], D(str(r[3])), *r[4:]) for r in rows[1]]
    return spark.createDataFrame(i, INTER), spark.createDataFrame(t, TXN)


def full(i, t):
    return {"agg_user_interactions": A.agg_user_interactions(i), "agg_item_popularity": A.agg_item_popularity(i),
            "agg_user_transactions": A.agg_user_transactions(t), "agg_item_revenue": A.agg_item_revenue(t),
            "interaction_matrix": A.interaction_matrix(A.union_all_signals(i, t))}


def same(a, b):
    assert a.columns == b.columns and [x[1] for x in a.dtypes] == [x[1] for x in b.dtypes]
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_runs_folded_one_by_one_equal_one_run(spark):
    path = tempfile.mkdtemp(prefix="wr-inc-")
    weeks = [raw(k, 150, 1_000 * k) for k in range(3)]
    weeks[2] = (weeks[2][0] + weeks[1][0], weeks[2][1] + weeks[0][1])  # ids of earlier runs again
    for run, rows in enumerate(weeks):
        states = INC.run_increment(spark, path, run, *frames(spark, rows), ["txn_id"])
    rows = ([x for w in (raw(k, 150, 1_000 * k) for k in range(3)) for x in w[0]],
            [x for w in (raw(k, 150, 1_000 * k) for k in range(3)) for x in w[1]])
    want = full(*frames(spark, rows))
    for name, table in INC.finish(states).items():
        same(table, want[name])
    again = INC.run_increment(spark, path, 2, *frames(spark, weeks[2]), ["txn_id"])  # the last run done twice
    same(INC.finish(again)["agg_user_interactions"], want["agg_user_interactions"])


def test_a_run_reads_no_old_raw_rows(spark):
    path = tempfile.mkdtemp(prefix="wr-incp-")
    dirs = []
    for run in range(2):
        i, t = frames(spark, raw(run, 60, 1_000 * run))
        dirs.append(os.path.join(path, f"raw{run}"))
        i.write.parquet(dirs[run] + "/i")
        t.write.parquet(dirs[run] + "/t")
    old = INC.partial_states(spark.read.parquet(dirs[0] + "/i"), spark.read.parquet(dirs[0] + "/t"))
    for name, df in old.items():
        df.write.parquet(os.path.join(path, "state", name))
    stored = {name: spark.read.parquet(os.path.join(path, "state", name)) for name in INC.KEYS}
    new = INC.partial_states(spark.read.parquet(dirs[1] + "/i"), spark.read.parquet(dirs[1] + "/t"))
    for name, df in INC.finish(INC.fold(stored, new)).items():
        read = df.inputFiles()
        assert any("/raw1/" in f for f in read) and any("/state/" in f for f in read), name
        assert not any("/raw0/" in f for f in read)


@pytest.fixture
def turns(spark):
    rnd = random.Random(2)
    rows = [(s, t, "user" if t % 2 else "assistant", f"s{s}t{t}" * rnd.randrange(1, 5)) for s in range(60) for t in range(rnd.randrange(1, 30))]
    return spark.createDataFrame(rows, "session_id long, turn int, role string, content string")


def test_sessions_are_read_by_bucket(spark, turns):
    spark.sql("CREATE DATABASE IF NOT EXISTS wr_test_sessions")
    table = f"wr_test_sessions.t{uuid.uuid4().hex[:8]}"
    SES.write_sessions(turns, table, buckets=16)
    one = SES.one_session(spark, table, 7)
    with contextlib.redirect_stdout(io.StringIO()) as said:
        SES.session_range(spark, table, 4).where("session_id = 7").explain("formatted")
    assert "SelectedBucketsCount: 1 out of 16" in said.getvalue() and "Exchange" not in said.getvalue()
    assert one.count() == turns.where("session_id = 7").count()
    got = SES.session_range(spark, table, 4, ascending=False)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    same(got, KV.range_by_key(turns, "session_id", ["turn"], 4, False))
    same(CH.chat_history(spark.table(table)), CH.chat_history(turns))
    spark.sql(f"DROP TABLE {table}")


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_drifting_files_are_widened(spark):
    d = tempfile.mkdtemp(prefix="wr-drift-")
    write(d + "/w1", "a.csv", 'id,price,code,day\n1,10,7,2024-01-01\n2,,8,\n')
    write(d + "/w1", "b.csv", 'id,price,code,day\n5,11,7,2024-01-02\n')
    write(d + "/w2", "a.csv", 'price,id,extra,code,day\n1.5,3,true,9,2024-01-03 10:00:00\n')
    write(d + "/w3", "a.csv", 'id,code,"odd, name"\n9999999999,x1,"a, b"\n')
    df = DR.scan_drifting(spark, d)
    assert dict(df.dtypes) == {"id": "bigint", "price": "double", "code": "string", "day": "timestamp", "extra": "boolean", "odd, name": "string"}
    rows = {r.id: r for r in df.collect()}
    assert len(rows) == 5 and rows[1].price == 10.0 and rows[3].price == 1.5 and rows[2].price is None
    assert rows[3].extra is True and rows[1].extra is None and rows[9999999999].code == "x1" and rows[9999999999]["odd, name"] == "a, b"
    assert str(rows[1].day) == "2024-01-01 00:00:00" and rows[1].code == "7"


def test_a_crawl_widens_what_the_catalog_has(spark):
    d, table = tempfile.mkdtemp(prefix="wr-crawl-"), f"t{uuid.uuid4().hex[:8]}"
    write(d, "a.csv", "id,v\n1,2\n")
    assert dict(DR.crawl(spark, d, "wr_test_drift", table).dtypes) == {"id": "int", "v": "int"}
    write(d, "b.csv", "id,v,w\n2,2.5,x\n")
    out = DR.crawl(spark, d, "wr_test_drift", table)
    assert out.dtypes == [("id", "int"), ("v", "double"), ("w", "string")] and out.count() == 2
    os.remove(os.path.join(d, "b.csv"))
    assert dict(DR.crawl(spark, d, "wr_test_drift", table).dtypes)["v"] == "double"  # never narrowed
    spark.sql(f"DROP TABLE wr_test_drift.{table}")


@pytest.mark.parametrize("a,b,c", [("int", "int", "int"), ("int", "double", "double"), ("bigint", "int", "bigint"), (None, "date", "date"),
                                   ("date", "timestamp", "timestamp"), ("boolean", "int", "string"), ("string", "int", "string"), (None, None, None)])
def test_widening(a, b, c):
    assert DR.widen(a, b) == DR.widen(b, a) == c


def test_empty_folder(spark):
    d = tempfile.mkdtemp(prefix="wr-none-")
    write(d, "a.csv", "id,v\n")
    df = DR.scan_drifting(spark, d)
    assert df.columns == ["id", "v"] and df.count() == 0
