import zlib

from pyspark.sql import functions as F

from wanderrank.llm.sharding import byte_shards, shard_documents, write_shards


def brute(rows, n):
    sized = sorted(((i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows))
    total, before, out, count = sum(r[2] for r in sized), 0, [], {}
    for has, i, size, crc in sized:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        out.append((i if has else None, size, crc, "bytes", shard, count.get(shard, 0), None))
        count[shard] = count.get(shard, 0) + 1
        before += size
    return out


def key(r):
    return tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in r)


def test_matches_brute_force(docs, odd_texts):
    rows = [(i * 3 % 101, t, "s") for i, t in enumerate(odd_texts * 5)] + [(None, "gone", "s"), (None, None, "s"), (4, "again", "s"), (4, "again", "s")]
    got = shard_documents(docs(rows), 24).collect()
    want = brute([(r[0], r[1]) for r in rows], 24)
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, want))


def test_equal_sizes_are_balanced_and_slots_gapless(docs):
    got = shard_documents(docs(["same text"] * 240), 24).toPandas()
    assert (got.groupby("shard").size() == 10).all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert got.sort_values("doc_id").shard.is_monotonic_increasing


def test_empty_table_and_clashing_names(spark, docs):
    assert shard_documents(docs([]).limit(0)).count() == 0
    df = docs(["a", "bb", "ccc"], {"shard": 7, "slot": "x"}).withColumn("size", F.length("text"))
    out = byte_shards(df, 2, "size", ["doc_id"])
    assert out.columns.count("shard") == 1 and {r.shard for r in out.collect()} <= {0, 1}


def test_written_shards_read_back(spark, docs, tmp_path):
    df = docs(["a" * k for k in range(50)]).withColumn("size", F.length("text"))
    out = byte_shards(df, 4, "size", ["doc_id"])
    write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(tuple, back.select("doc_id", "shard", "slot").collect())) == \
        sorted(map(tuple, out.select("doc_id", "shard", "slot").collect()))
