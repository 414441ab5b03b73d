"""End to end on the travel tables with their source column names:
ETL -> training -> recommendations, the way the source system is used."""

import json
import os
import tempfile

import pytest

from wanderrank.plans import cli

CATALOGUE = ("destination_id,nama_destinasi,provinsi,kategori,rating_rata_rata,harga_tiket_dewasa,"
             "durasi_kunjungan_jam,fasilitas,deskripsi,koordinat_lat,koordinat_lng,tersedia,musim_terbaik,"
             "min_umur,total_pengunjung_tahunan\n") + "".join(
    f"DST{i:04d},Place {i},Prov {i % 3},{'Pantai' if i % 2 else 'Alam'},{3 + i % 3 / 2},{i * 1000},{i % 5 + 1},"
    f"\"wifi,toilet\",text {i},{i}.5,1{i}.25,true,Kemarau,{i % 10},{i * 100}\n" for i in range(1, 25))

USERS = """user_id,nama,usia,jenis_kelamin,kota_asal,segmen,preferensi_kategori,budget_per_trip,tipe_akomodasi,jumlah_trip,member_sejak,rating_rata_rata,is_active
USR00001,A,30,L,Jakarta,Keluarga,Pantai|Alam,500000,Hotel,3,2023-01-01,4.5,true
USR00002,B,11,P,Bandung,Solo,Budaya,300000,Hostel,1,2023-05-01,4.0,
USR00003,C,45,P,Medan,Pasangan,Bahari,0,Resort,2,2022-02-02,3.5,false
USR00004,D,25,L,Surabaya,Solo,Kuliner,200000,Hostel,1,bad-date,4.1,true
"""
INTER = """interaction_id,user_id,destination_id,tipe_interaksi,skor_interaksi,timestamp,durasi_detik,platform,rating_diberikan,session_id
INT0000001,USR00001,DST0001,view,0.2,2024-01-07 10:00:00,30,Web,,S1
INT0000002,USR00001,DST0003,review,0.8,2024-01-07 11:00:00,,Web,4.0,S1
INT0000003,USR00001,DST0003,book,1.0,2024-01-08 09:00:00,,App,,S2
INT0000004,USR00004,DST0010,like,0.5,2024-01-09 09:00:00,,App,,S3
INT0000004,USR00004,DST0010,like,0.5,2024-01-09 09:00:00,,App,,S3
INT0000005,USR00004,DST0011,view,1.5,2024-01-09 10:00:00,5,App,,S3
"""
TXN = """transaction_id,user_id,destination_id,nama_destinasi,jumlah_orang,harga_per_orang,subtotal,diskon_persen,diskon_nominal,total_bayar,metode_pembayaran,tanggal_transaksi,tanggal_check_in,tanggal_check_out,status_booking,tipe_akomodasi,rating_pasca_kunjungan,ulasan
TRX0000001,USR00001,DST0003,X,2,100000,200000,10,20000,180000,Card,2024-01-01,2024-01-10,2024-01-12,Selesai,Hotel,4.5,ok
TRX0000002,USR00004,DST0010,Y,1,50000,50000,0,0,50000,Cash,2024-01-02,2024-01-11,2024-01-12,Dibatalkan,Hostel,,
TRX0000003,USR00001,DST0002,Z,1,0,0,0,0,0,Cash,2024-01-03,2024-01-13,2024-01-14,Selesai,Hotel,,
"""


def test_travel_etl_train_recommend(spark):
    raw = tempfile.mkdtemp(prefix="wr-raw-")
    for name, text in [("user_profiles", USERS), ("user_interactions", INTER),
                       ("transaction_history", TXN)]:
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write(text)
    with open(os.path.join(raw, "destination_catalog.csv"), "w") as f:
        f.write(CATALOGUE)
    out, model, recs = (tempfile.mkdtemp(prefix=p) for p in ("wr-proc-", "wr-model-", "wr-recs-"))

    cli.main(["etl", "--raw", raw, "--out", out, "--as-of", "2024-02-01 00:00:00"])
    users = {r.user_id: r for r in spark.read.parquet(os.path.join(out, "user_features")).collect()}
    assert sorted(users) == ["USR00001", "USR00004"]           # age 11 and budget 0 dropped
    assert users["USR00001"].total_interactions == 3 and users["USR00001"].completed_transactions == 1
    assert users["USR00004"].total_interactions == 1           # duplicate id and score 1.5 dropped
    items = spark.read.parquet(os.path.join(out, "destination_features"))
    assert items.count() == 24
    assert {"deskripsi", "koordinat_lat", "musim_terbaik", "min_umur"} <= set(items.columns)
    m = {(r.user_id, r.item_id): r for r in spark.read.parquet(os.path.join(out, "interaction_matrix")).collect()}
    assert m[("USR00001", "DST0003")].total_score == pytest.approx(2.8)   # 0.8 + 1.0 + completed 1.0
    assert ("USR00001", "DST0002") not in m                      # free booking: paid 0 dropped

    cli.main(["train", "--raw", raw, "--processed", out, "--out", model, "--factorize"])
    meta = json.loads(spark.read.text(os.path.join(model, "model_metadata")).first().value)
    assert meta["metrics"]["precision_at_5"] == 0.0 and meta["n_destinations"] == 24

    req = os.path.join(raw, "requests.json")
    with open(req, "w") as f:
        f.write(json.dumps({"user_id": "USR00001", "top_n": 5,
                            "preferences": {"kategori": ["Pantai"], "favorit_destinasi": ["DST0001"]}}) + "\n")
        f.write(json.dumps({"user_id": "USR09999", "top_n": 25}) + "\n")
    cli.main(["recommend", "--raw", raw, "--model", model, "--requests", req, "--out", recs])
    got = spark.read.parquet(recs).collect()
    u1 = [r for r in got if r.user_id == "USR00001"]
    assert len(u1) == 5 and all(r.category == "Pantai" for r in u1)
    assert len([r for r in got if r.user_id == "USR09999"]) == 20   # clamped to 20
    cli.main(["recommend", "--raw", raw, "--model", model, "--requests", req, "--out", recs + "-f", "--factorized"])
    assert spark.read.parquet(recs + "-f").count() == len(got)
    kept = spark.read.parquet(os.path.join(out, "user_features"))
    assert {"jenis_kelamin", "tipe_akomodasi", "rating_rata_rata"} <= set(kept.columns)
    assert {r.user_id: r.preferred_list for r in kept.collect()}["USR00001"] == ["Pantai", "Alam"]
    txn = spark.read.parquet(os.path.join(out, "transactions_clean"))
    assert {"nama_destinasi", "jumlah_orang", "diskon_persen", "metode_pembayaran", "ulasan"} <= set(txn.columns)
