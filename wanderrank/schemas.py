"""Declared schemas.

Two layers:

* the raw travel-catalogue tables as they arrive (CSV or Parquet, source
  column names kept so existing files load unchanged), and
* the *role* columns every operator works on (English names). Adapters in
  ``wanderrank.plans.roles`` project either the travel tables or the driver's
  TPC-H-like tables onto these roles; the projection is a plain ``select``, so
  Catalyst still prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- raw travel tables (column names of the source files) -----------------

USER_PROFILES = _schema(
    ("user_id", S), ("nama", S), ("usia", I), ("jenis_kelamin", S), ("kota_asal", S),
    ("segmen", S), ("preferensi_kategori", S), ("budget_per_trip", L), ("tipe_akomodasi", S),
    ("jumlah_trip", I), ("member_sejak", S), ("rating_rata_rata", D), ("is_active", B),
)

DESTINATION_CATALOG = _schema(
    ("destination_id", S), ("nama_destinasi", S), ("provinsi", S), ("kategori", S),
    ("rating_rata_rata", D), ("harga_tiket_dewasa", L), ("durasi_kunjungan_jam", I),
    ("fasilitas", S), ("deskripsi", S), ("koordinat_lat", D), ("koordinat_lng", D),
    ("tersedia", B), ("musim_terbaik", S), ("min_umur", I), ("total_pengunjung_tahunan", L),
)

USER_INTERACTIONS = _schema(
    ("interaction_id", S), ("user_id", S), ("destination_id", S), ("tipe_interaksi", S),
    ("skor_interaksi", D), ("timestamp", S), ("durasi_detik", I), ("platform", S),
    ("rating_diberikan", D), ("session_id", S),
)

TRANSACTION_HISTORY = _schema(
    ("transaction_id", S), ("user_id", S), ("destination_id", S), ("nama_destinasi", S),
    ("jumlah_orang", I), ("harga_per_orang", L), ("subtotal", L), ("diskon_persen", I),
    ("diskon_nominal", L), ("total_bayar", L), ("metode_pembayaran", S),
    ("tanggal_transaksi", S), ("tanggal_check_in", S), ("tanggal_check_out", S),
    ("status_booking", S), ("tipe_akomodasi", S), ("rating_pasca_kunjungan", D), ("ulasan", S),
)

RAW_TRAVEL = {
    "user_profiles": USER_PROFILES,
    "destination_catalog": DESTINATION_CATALOG,
    "user_interactions": USER_INTERACTIONS,
    "transaction_history": TRANSACTION_HISTORY,
}

# ---- key-value / event tables ---------------------------------------------

TRACKED = _schema(
    ("user_id", S), ("timestamp", S), ("destination_id", S), ("tipe_interaksi", S),
    ("skor_interaksi", S), ("platform", S), ("ttl", L),
)

TURNS = _schema(
    ("session_id", S), ("timestamp", S), ("user_id", S), ("role", S), ("content", S), ("ttl", L),
)

METRICS = T.StructType([
    T.StructField("name", S, True), T.StructField("ts", T.TimestampType(), True),
    T.StructField("invocations", L, True), T.StructField("errors", L, True),
    T.StructField("duration_ms", D, True),
])

# ---- fixed values that must equal the source system's ----------------------
# Interaction kinds, booking states and facility words of the travel catalogue.
INTERACTION_KINDS = ["view", "like", "bookmark", "share", "review", "book"]
TRAVEL_STATUSES = {"Selesai": "completed", "Dibatalkan": "cancelled", "Dalam Proses": "in_progress"}
TRAVEL_FACILITIES = ["wifi", "parkir", "toilet", "restoran", "guide", "perahu", "diving"]
# Fill value for a missing facility list in the catalogue.
DEFAULT_FACILITIES = "toilet"
# Label-encoder defaults for a missing category / province.
DEFAULT_CATEGORY = "Alam"
DEFAULT_PROVINCE = "Bali"

# ---- role statuses (English) ------------------------------------------------
COMPLETED = "completed"
VALID_STATUSES = ["completed", "cancelled", "in_progress"]
