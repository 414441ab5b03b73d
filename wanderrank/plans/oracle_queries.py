"""Oracle SQL per registered query (DuckDB dialect, driver views)."""

from __future__ import annotations

from wanderrank.plans.oracle import avg, with_ctes
from wanderrank.plans.roles import PART_FACILITIES

D = "CAST({} AS DOUBLE)"


def _label_cte(src: str, col: str, order: str, default: str | None = None):
    key = f"coalesce({col}, '{default}')" if default else col
    if order == "freq":
        o = "(_label IS NULL), _n DESC, _label ASC"
    else:
        o = "(_label IS NULL), _label ASC"
    return ([src], f"""SELECT _label, CAST(row_number() OVER (ORDER BY {o}) - 1 AS DOUBLE) AS _idx
        FROM (SELECT {key} AS _label, count(*) AS _n FROM {src} GROUP BY 1)""")


FLAGS = ",\n".join(f"CASE WHEN contains(facilities, '{w}') THEN 1 ELSE 0 END AS has_{w}"
                   for w in PART_FACILITIES)

ITEM_FEATURES_CTES = {
    "if_base": (["c_items", "ip_agg", "ir_agg"], f"""SELECT i.*,
        coalesce(p.total_views, 0) AS total_views, p.avg_interaction_score,
        coalesce(p.unique_visitors, 0) AS unique_visitors,
        coalesce(p.total_bookings, 0) AS total_bookings, p.avg_user_rating,
        coalesce(r.total_revenue, 0) AS total_revenue, r.total_completed_bookings,
        coalesce(r.avg_transaction_value, 0) AS avg_transaction_value
        FROM c_items i LEFT JOIN ip_agg p USING (item_id) LEFT JOIN ir_agg r USING (item_id)"""),
    "cat_labels": _label_cte("if_base", "category", "freq"),
    "prov_labels": _label_cte("if_base", "province", "freq"),
    "cat_stats": (["if_base"], """SELECT category, min(price) AS _lo, max(price) AS _hi
        FROM if_base GROUP BY category"""),
}

ITEM_FEATURES = with_ctes(["if_base", "cat_labels", "prov_labels", "cat_stats"], f"""
SELECT b.*, {FLAGS},
  b.total_views * CAST(0.3 AS DOUBLE) + b.unique_visitors * CAST(0.4 AS DOUBLE)
    + b.total_bookings * CAST(0.3 AS DOUBLE) AS popularity_score,
  (b.price - s._lo) / (s._hi - s._lo + 1) AS price_normalized,
  c._idx AS category_idx, p._idx AS province_idx
FROM if_base b
LEFT JOIN cat_stats s ON b.category IS NOT DISTINCT FROM s.category
LEFT JOIN cat_labels c ON b.category IS NOT DISTINCT FROM c._label
LEFT JOIN prov_labels p ON b.province IS NOT DISTINCT FROM p._label""", ITEM_FEATURES_CTES)

USER_FEATURES = with_ctes(["c_users", "ui_agg", "ut_agg"], """
SELECT u.*,
  coalesce(a.total_interactions, 0) AS total_interactions, coalesce(a.avg_score, 0.0) AS avg_score,
  coalesce(a.total_book, 0) AS total_book, coalesce(a.total_review, 0) AS total_review,
  coalesce(a.total_like, 0) AS total_like, coalesce(a.unique_items, 0) AS unique_items,
  a.last_interaction,
  coalesce(t.total_transactions, 0) AS total_transactions, coalesce(t.avg_spend, 0.0) AS avg_spend,
  t.max_spend, t.avg_rating_given, t.avg_stay,
  coalesce(t.completed_transactions, 0) AS completed_transactions,
  round(ln(1 + CAST(u.budget AS DOUBLE)), 10) AS budget_log,
  (coalesce(a.total_book, 0) * 5 + coalesce(a.total_review, 0) * 3 + coalesce(a.total_like, 0)
   + coalesce(t.completed_transactions, 0) * 4) / CAST(13.0 AS DOUBLE) AS engagement_score
FROM c_users u LEFT JOIN ui_agg a USING (user_id) LEFT JOIN ut_agg t USING (user_id)""")

ORACLES: dict[str, str] = {
    "clean_users": with_ctes(["c_users"], "SELECT * FROM c_users"),
    "clean_items": with_ctes(["c_items"], "SELECT * FROM c_items"),
    "clean_interactions": with_ctes(["c_inter"], """SELECT interaction_id, user_id, item_id, kind,
        CAST(score AS DECIMAL(12,4)) AS score, ts, rating_given, hour, day_of_week, month
        FROM c_inter"""),
    "clean_transactions": with_ctes(["c_txn"], "SELECT * FROM c_txn"),
    "union_all_signals": with_ctes(["signals"], """SELECT user_id, item_id,
        CAST(score AS DOUBLE) AS score FROM signals"""),
    "interaction_matrix": with_ctes(["matrix"], "SELECT * FROM matrix"),
    "agg_user_interactions": with_ctes(["ui_agg"], "SELECT * FROM ui_agg"),
    "agg_user_transactions": with_ctes(["ut_agg"], "SELECT * FROM ut_agg"),
    "agg_item_popularity": with_ctes(["ip_agg"], "SELECT * FROM ip_agg"),
    "agg_item_revenue": with_ctes(["ir_agg"], "SELECT * FROM ir_agg"),
    "agg_user_counts": with_ctes(["c_inter"], """SELECT user_id, count(*) AS n_interactions
        FROM c_inter GROUP BY user_id"""),
    "user_features": USER_FEATURES,
    "item_features": ITEM_FEATURES,
    "window_minmax_price": with_ctes(["c_items"], """SELECT item_id, category, price,
        (price - min(price) OVER (PARTITION BY category)) /
        (max(price) OVER (PARTITION BY category) - min(price) OVER (PARTITION BY category) + 1)
        AS price_normalized FROM c_items"""),
    "index_category": with_ctes(["c_items", "cat_labels", "prov_labels"], """
        SELECT i.item_id, i.category, c._idx AS category_idx, i.province, p._idx AS province_idx
        FROM c_items i
        LEFT JOIN cat_labels c ON i.category IS NOT DISTINCT FROM c._label
        LEFT JOIN prov_labels p ON i.province IS NOT DISTINCT FROM p._label""",
        {"cat_labels": _label_cte("c_items", "category", "freq"),
         "prov_labels": _label_cte("c_items", "province", "freq")}),
    "label_encode": with_ctes(["c_items", "cat_alpha", "prov_alpha"], """
        SELECT i.item_id, c._idx AS category_code, p._idx AS province_code FROM c_items i
        LEFT JOIN cat_alpha c ON coalesce(i.category, 'ECONOMY') = c._label
        LEFT JOIN prov_alpha p ON coalesce(i.province, 'Brand#1') = p._label""",
        {"cat_alpha": _label_cte("c_items", "category", "alpha", "ECONOMY"),
         "prov_alpha": _label_cte("c_items", "province", "alpha", "Brand#1")}),
}


# ---------------------------------------------------------------- vectors, neighbours

ITEM_FEATURES_CTES["ifeat"] = (["if_base", "cat_labels", "prov_labels", "cat_stats"],
                               ITEM_FEATURES[ITEM_FEATURES.index("\nSELECT b.*"):])
VEC_COLS = (["price", "visit_hours"] + [f"has_{w}" for w in PART_FACILITIES]
            + ["category_idx", "province_idx"])


def _vector_ctes() -> dict:
    raw = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS f{i}" for i, c in enumerate(VEC_COLS))
    stats = ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(len(VEC_COLS)))
    scaled = ", ".join(f"CASE WHEN hi{i} - lo{i} = 0 THEN 0.0 ELSE (f{i} - lo{i}) / (hi{i} - lo{i}) END"
                       for i in range(len(VEC_COLS)))
    d = dict(ITEM_FEATURES_CTES)
    d.update({
        "vraw": (["ifeat"], f"SELECT item_id, {raw} FROM ifeat"),
        "vstats": (["vraw"], f"SELECT {stats} FROM vraw"),
        "vec": (["vraw", "vstats"], f"SELECT item_id, [{scaled}] AS features FROM vraw, vstats"),
    })
    return d


def _neighbour_ctes(vec: str, k: int, name: str = "nbr") -> dict:
    return {
        f"{name}_norm": ([vec], f"""SELECT item_id, features,
            list_dot_product(features, features) AS nn FROM {vec}"""),
        f"{name}_pairs": ([f"{name}_norm"], f"""SELECT a.item_id AS src, b.item_id AS dst,
            CASE WHEN a.nn = 0 OR b.nn = 0 THEN 0.0
                 ELSE list_dot_product(a.features, b.features) / (sqrt(a.nn) * sqrt(b.nn)) END AS s
            FROM {name}_norm a JOIN {name}_norm b ON a.item_id <> b.item_id"""),
        name: ([f"{name}_pairs"], f"""SELECT src, dst, s, row_number() OVER (PARTITION BY src
            ORDER BY round(s, 12) DESC, dst ASC) AS rk FROM {name}_pairs QUALIFY rk <= {k}"""),
    }


VEC = _vector_ctes()
EMB = {"evec": ([], "SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings")}

ORACLES["build_item_vectors"] = with_ctes(["vec"], """SELECT item_id,
    CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS dim, unnest(features) AS value
    FROM vec""", VEC)
ORACLES["cosine_topk"] = with_ctes(["nbr"], """SELECT src, dst, round(s, 4) AS score,
    CAST(rk AS INTEGER) AS rank FROM nbr""", {**VEC, **_neighbour_ctes("vec", 5)})
ORACLES["cosine_topk_embeddings"] = with_ctes(["nbr"], """SELECT src, dst, round(s, 4) AS score,
    CAST(rk AS INTEGER) AS rank FROM nbr""", {**EMB, **_neighbour_ctes("evec", 5)})

# ---------------------------------------------------------------- collaborative + hybrid

CF_CTES = {
    "rated": (["c_inter"], """SELECT user_id, item_id, CASE WHEN score IS NULL THEN 1.0
        ELSE least(greatest(score, 0), 5) END AS rating FROM c_inter"""),
    "nu": (["rated"], f"""SELECT user_id, count(*) AS n_rows, {avg('rating')} AS user_mean
        FROM rated GROUP BY user_id"""),
    "seen": (["rated", "c_items"], """SELECT DISTINCT user_id, item_id FROM rated
        WHERE item_id IN (SELECT item_id FROM c_items)"""),
}

WEIGHTS = """CAST(CASE WHEN {n} < 5 THEN 0.2 WHEN {n} < 20 THEN 0.5 ELSE 0.7 END AS DOUBLE) AS w_cf,
    CAST(CASE WHEN {n} < 5 THEN 0.8 WHEN {n} < 20 THEN 0.5 ELSE 0.3 END AS DOUBLE) AS w_cb"""

HALF_UP4 = "((2 * CAST({s} * 10000 AS BIGINT) + {n}) // (2 * {n})) / 10000.0"
ORACLES["cf_user_mean"] = with_ctes(["c_users", "rated"], f"""SELECT u.user_id,
    CAST(CASE WHEN a.n > 0 THEN {HALF_UP4.format(s='a.s', n='a.n')}
         ELSE {HALF_UP4.format(s='g.s', n='g.n')} END AS DOUBLE) AS cf_score
    FROM c_users u
    LEFT JOIN (SELECT user_id, sum(rating) AS s, count(rating) AS n FROM rated GROUP BY 1) a USING (user_id),
    (SELECT sum(rating) AS s, count(rating) AS n FROM rated) g""", CF_CTES)
ORACLES["adaptive_weights"] = with_ctes(["c_users", "nu"], f"""SELECT u.user_id,
    coalesce(nu.n_rows, 0) AS n_interactions, {WEIGHTS.format(n='coalesce(nu.n_rows, 0)')}
    FROM c_users u LEFT JOIN nu USING (user_id)""", CF_CTES)


def recommend_sql(req_cte: dict, with_cb: bool) -> str:
    """Brute-force definition: every (user, catalogue item) pair minus seen,
    union the cb keys, filter with fallback, rank, enrich."""
    ctes = dict(CF_CTES)
    ctes.update(req_cte)
    ctes["ru"] = (["req", "nu", "seen", "c_items"], f"""SELECT r.*, {WEIGHTS.format(n='coalesce(nu.n_rows, 0)')},
        (SELECT count(*) FROM c_items) - coalesce(s.n_seen, 0) > 0 AS cf_nonempty,
        (len(coalesce(r.categories, [])) > 0 OR r.max_budget IS NOT NULL OR r.province IS NOT NULL)
          AS has_filter
        FROM req r LEFT JOIN nu USING (user_id)
        LEFT JOIN (SELECT user_id, count(*) AS n_seen FROM seen GROUP BY 1) s USING (user_id)""")
    ctes["cfk"] = (["ru", "c_items", "seen"], """SELECT ru.user_id, i.item_id FROM ru, c_items i
        WHERE ru.cf_nonempty AND NOT EXISTS (SELECT 1 FROM seen s
          WHERE s.user_id = ru.user_id AND s.item_id = i.item_id)""")
    if with_cb:
        ctes.update(_neighbour_ctes("vec", 20, "nbr20"))
        ctes.update(VEC)
        ctes["fav"] = (["req"], "SELECT user_id, unnest(favorites) AS src FROM req")
        ctes["cbraw"] = (["fav", "nbr20"], """SELECT f.user_id, n.dst AS item_id,
            greatest(max(round(n.s, 4)), 0.0) AS cb FROM fav f JOIN nbr20 n ON f.src = n.src
            GROUP BY 1, 2""")
        ctes["cbk"] = (["cbraw"], """SELECT user_id, item_id, CASE
            WHEN max(cb) OVER w = min(cb) OVER w THEN 0.5
            ELSE (cb - min(cb) OVER w) / (max(cb) OVER w - min(cb) OVER w) END AS cb_norm
            FROM cbraw WINDOW w AS (PARTITION BY user_id)""")
    else:
        ctes["cbk"] = ([], "SELECT NULL AS user_id, NULL AS item_id, CAST(NULL AS DOUBLE) AS cb_norm WHERE FALSE")
    ctes["keys"] = (["cfk", "cbk"], """SELECT coalesce(a.user_id, b.user_id) AS user_id,
        coalesce(a.item_id, b.item_id) AS item_id,
        CASE WHEN a.item_id IS NOT NULL THEN 0.5 ELSE 0.0 END AS cf_norm,
        coalesce(b.cb_norm, 0.0) AS cb_norm
        FROM cfk a FULL OUTER JOIN cbk b ON a.user_id = b.user_id AND a.item_id = b.item_id""")
    ctes["kp"] = (["keys", "ru", "c_items"], """SELECT k.*, ru.top_n, ru.w_cf, ru.w_cb, ru.has_filter,
        CASE WHEN i.item_id IS NULL THEN TRUE ELSE
          (len(coalesce(ru.categories, [])) = 0 OR coalesce(list_contains(ru.categories, i.category), FALSE))
          AND (ru.max_budget IS NULL OR NOT coalesce(i.price > ru.max_budget, FALSE))
          AND (ru.province IS NULL OR coalesce(i.province = ru.province, FALSE)) END AS passes
        FROM keys k JOIN ru USING (user_id) LEFT JOIN c_items i USING (item_id)""")
    ctes["kf"] = (["kp"], """SELECT *, w_cf * cf_norm + w_cb * cb_norm AS score FROM kp
        QUALIFY NOT (has_filter AND bool_or(passes) OVER (PARTITION BY user_id)) OR passes""")
    ctes["top"] = (["kf"], """SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY score DESC, item_id ASC) AS rk FROM kf QUALIFY rk <= top_n""")
    return with_ctes(["top", "c_items"], """SELECT t.user_id, CAST(t.rk AS INTEGER) AS rank, t.item_id,
        coalesce(i.name, '') AS name, coalesce(i.category, '') AS category,
        coalesce(i.province, '') AS province, 0.0 AS rating, coalesce(i.price, 0.0) AS price,
        round(t.score, 4) AS hybrid_score, round(t.cf_norm, 4) AS cf_score,
        round(t.cb_norm, 4) AS cb_score, t.w_cf, t.w_cb
        FROM top t LEFT JOIN c_items i USING (item_id)""", ctes)


REQ_PLAIN = {"req": (["c_users"], """SELECT user_id, 10 AS top_n, CAST([] AS BIGINT[]) AS favorites,
    CAST(NULL AS VARCHAR[]) AS categories, CAST(NULL AS DOUBLE) AS max_budget,
    CAST(NULL AS VARCHAR) AS province FROM c_users""")}
REQ_FAV = {
    "fbest": (["matrix", "c_items"], """SELECT m.user_id, m.item_id, i.category,
        row_number() OVER (PARTITION BY m.user_id ORDER BY m.final_score DESC, m.item_id ASC) AS r
        FROM matrix m LEFT JOIN c_items i USING (item_id) QUALIFY r <= 2"""),
    "ffav": (["fbest"], """SELECT user_id, list(item_id ORDER BY r) AS favorites,
        arg_min(category, r) AS top_category FROM fbest GROUP BY user_id"""),
    "req": (["c_users", "ffav"], """SELECT u.user_id, 10 AS top_n,
        coalesce(f.favorites, CAST([] AS BIGINT[])) AS favorites,
        CASE WHEN f.top_category IS NOT NULL THEN [f.top_category] ELSE CAST([] AS VARCHAR[]) END
          AS categories,
        CAST(u.budget AS DOUBLE) AS max_budget, CAST(NULL AS VARCHAR) AS province
        FROM c_users u LEFT JOIN ffav f USING (user_id)"""),
}
ORACLES["recommend_batch"] = recommend_sql(REQ_PLAIN, with_cb=False)
ORACLES["recommend_prefs"] = recommend_sql(REQ_FAV, with_cb=True)


# ---------------------------------------------------------------- evaluation

REQ_SAMPLE = {"req": (["c_inter"], """SELECT user_id, 5 AS top_n, CAST([] AS BIGINT[]) AS favorites,
    CAST(NULL AS VARCHAR[]) AS categories, CAST(NULL AS DOUBLE) AS max_budget,
    CAST(NULL AS VARCHAR) AS province FROM (SELECT DISTINCT user_id FROM c_inter)
    ORDER BY md5(CAST(user_id AS VARCHAR) || ':42'), user_id LIMIT 50""")}


def _eval_sql() -> str:
    rec = recommend_sql(REQ_SAMPLE, with_cb=False)
    # reuse the recommend query as a CTE: strip its WITH and wrap the select
    body = rec[len("WITH "):]
    ctes_part, final_select = body.rsplit("\nSELECT t.user_id", 1)
    final_select = "SELECT t.user_id" + final_select
    return f"""WITH {ctes_part},
recs AS ({final_select}),
truth AS (SELECT DISTINCT user_id, item_id FROM (
    SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id ASC) AS r
    FROM c_inter WHERE user_id IN (SELECT user_id FROM req)) WHERE r <= 5),
hits AS (SELECT user_id, count(*) AS hits FROM (SELECT DISTINCT user_id, item_id FROM recs)
    JOIN truth USING (user_id, item_id) GROUP BY user_id)
SELECT round(coalesce(avg(coalesce(h.hits, 0) / 5.0), 0.0), 4) AS precision_at_5,
  round((SELECT count(DISTINCT item_id) FROM recs) / greatest((SELECT count(*) FROM c_items), 1), 4)
    AS coverage,
  count(*) AS users_evaluated
FROM req r LEFT JOIN hits h USING (user_id)"""


ORACLES["eval_precision_coverage"] = _eval_sql()
ORACLES["nlargest_true"] = with_ctes(["c_inter"], """SELECT DISTINCT user_id, item_id FROM (
    SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id ASC) AS r
    FROM c_inter) WHERE r <= 5""")
ORACLES["similar_items"] = with_ctes(["nbr", "c_inter", "c_items"], """SELECT src, dst, round(s, 4) AS score,
    CAST(rk AS INTEGER) AS rank, i.name, i.category, CAST(NULL AS DOUBLE) AS rating
    FROM nbr LEFT JOIN c_items i ON i.item_id = dst WHERE src IN (SELECT item_id FROM c_inter)""",
    {**VEC, **_neighbour_ctes("vec", 5)})

_CB = dict(CF_CTES)
_CB.update(REQ_FAV)
_CB.update(VEC)
_CB.update(_neighbour_ctes("vec", 20, "nbr20"))
_CB["fav"] = (["req"], "SELECT user_id, unnest(favorites) AS src FROM req")
_CB["cbraw"] = (["fav", "nbr20"], """SELECT f.user_id, n.dst AS item_id,
    greatest(max(round(n.s, 4)), 0.0) AS cb FROM fav f JOIN nbr20 n ON f.src = n.src GROUP BY 1, 2""")
_CB["cbk"] = (["cbraw"], """SELECT user_id, item_id, cb, CASE
    WHEN max(cb) OVER w = min(cb) OVER w THEN 0.5
    ELSE (cb - min(cb) OVER w) / (max(cb) OVER w - min(cb) OVER w) END AS cb_norm
    FROM cbraw WINDOW w AS (PARTITION BY user_id)""")
ORACLES["agg_best_similarity"] = with_ctes(["cbk"], "SELECT user_id, item_id, cb, cb_norm FROM cbk", _CB)
ORACLES["join_anti_seen"] = with_ctes(["cbk", "c_inter"], """SELECT user_id, item_id FROM cbk k
    WHERE NOT EXISTS (SELECT 1 FROM c_inter x WHERE x.user_id = k.user_id AND x.item_id = k.item_id)""", _CB)


# ---------------------------------------------------------------- key-value tables, chat

def with_recs(req: dict, select: str, extra_ctes: str = "") -> str:
    """``WITH <recommend CTEs>, recs AS (<brute-force recommend>)[, extra] <select>``."""
    rec = recommend_sql(req, with_cb=False)
    body = rec[len("WITH "):]
    ctes_part, final_select = body.rsplit("\nSELECT t.user_id", 1)
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {ctes_part},\nrecs AS (SELECT t.user_id{final_select}){extra}\n{select}"


AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
LABEL = "CASE WHEN role = 'user' THEN 'Pengguna' ELSE 'Asisten' END"


def _history_sql(src: str) -> str:
    return f"""SELECT session_id, string_agg({LABEL} || ': ' || substring(content, 1, 200) || chr(10), ''
        ORDER BY turn) AS history FROM (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn) AS _c
                         FROM {src}) WHERE _c <= 20
          QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) <= 4)
        GROUP BY session_id"""


ORACLES["upsert_by_key"] = with_ctes(["r_inter"], """SELECT interaction_id, user_id, item_id, kind,
    score, ts, rating_given FROM r_inter QUALIFY row_number() OVER (PARTITION BY user_id, item_id
    ORDER BY ts DESC NULLS LAST, interaction_id DESC NULLS LAST) = 1""")
ORACLES["expire_ttl"] = with_ctes(["r_inter"], """SELECT interaction_id, user_id, item_id, ts FROM r_inter
    WHERE ts + INTERVAL 30 DAY >= TIMESTAMP '2024-02-15 00:00:00'""")
ORACLES["range_by_key"] = with_ctes(["c_inter"], """SELECT interaction_id, user_id, item_id, ts,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, interaction_id) AS INTEGER) AS pos
    FROM c_inter QUALIFY pos <= 20""")
ORACLES["catalogue_list"] = with_ctes(["c_items"], """SELECT item_id, coalesce(name, '') AS name,
    coalesce(category, '') AS category, coalesce(province, '') AS province, price, visit_hours
    FROM c_items""")
ORACLES["prediction_log"] = with_recs(REQ_PLAIN, f"""SELECT
    CAST(user_id AS VARCHAR) || '-' || CAST(epoch({AS_OF}) AS BIGINT) AS prediction_id, user_id,
    to_json(list({{'rank': rank, 'item_id': item_id, 'name': name, 'category': category,
                   'province': province, 'rating': rating, 'price': price, 'hybrid_score': hybrid_score,
                   'cf_score': cf_score, 'cb_score': cb_score, 'weights': {{'cf': w_cf, 'cb': w_cb}}}}
                  ORDER BY rank)) AS recommendations,
    '2024-02-01 00:00:00' AS timestamp, CAST(NULL AS VARCHAR) AS latency_ms, CAST(epoch({AS_OF}) AS BIGINT) + 86400 AS ttl
    FROM recs WHERE rank <= 5 GROUP BY user_id""")
ORACLES["chat_history"] = with_ctes(["r_turns"], _history_sql("r_turns"))

_MSG = """msg AS (SELECT session_id, user_id, turn AS mturn, content AS message FROM r_turns
    WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) = 1),
earlier AS (SELECT t.* FROM r_turns t JOIN msg m USING (session_id) WHERE t.turn < m.mturn),
hist AS ({hist}),
rtext AS (SELECT user_id, chr(10) || chr(10) || 'Rekomendasi destinasi wisata untuk user ini:' || chr(10)
    || string_agg(CAST(rank AS VARCHAR) || '. ' || name || ' (' || category || ', ' || province
       || ') - Rating: ' || CAST(rating AS VARCHAR) || ' - Harga: Rp' || format('{{:,.2f}}', price)
       || chr(10), '' ORDER BY rank) AS rec_text
    FROM recs WHERE rank <= 5 GROUP BY user_id)""".format(hist=_history_sql("earlier"))
_REQ_CHAT = {"req": (["r_turns"], """SELECT DISTINCT user_id, 5 AS top_n, CAST([] AS BIGINT[]) AS favorites,
    CAST(NULL AS VARCHAR[]) AS categories, CAST(NULL AS DOUBLE) AS max_budget,
    CAST(NULL AS VARCHAR) AS province FROM r_turns WHERE role = 'user'""")}
_INTRO = ("You are a friendly, well-informed travel guide. Answer warmly and "
          "helpfully in the user's language.")
ORACLES["chat_context"] = with_recs(_REQ_CHAT, f"""SELECT m.session_id, m.user_id,
    '{_INTRO.replace("'", "''")}' || chr(10) || coalesce(r.rec_text, '') || chr(10) || 'Riwayat percakapan:' || chr(10)
    || coalesce(h.history, '') || chr(10) || 'Pengguna: ' || m.message || chr(10) || 'Asisten:' AS prompt
    FROM msg m LEFT JOIN hist h USING (session_id) LEFT JOIN rtext r USING (user_id)""", _MSG)
ORACLES["chat_append"] = with_ctes(["r_turns"], f"""SELECT session_id, turn, role,
    CASE WHEN _r <= 2 THEN substring(content, 1, 2000) ELSE content END AS content,
    CAST(epoch({AS_OF}) AS BIGINT) + 7 * 86400 AS ttl
    FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS _r FROM r_turns)""")


# ---------------------------------------------------------------- streaming and metrics

ORACLES["track_ingest"] = with_ctes(["r_inter"], """SELECT user_id, item_id, coalesce(kind, 'view') AS kind,
    TRY_CAST(coalesce(CAST(score AS VARCHAR), '0.2') AS DOUBLE) AS score, ts, 'WebApp' AS platform,
    epoch_us(ts) // 1000000 + 30 * 86400 AS ttl
    FROM r_inter WHERE user_id IS NOT NULL AND item_id IS NOT NULL
      AND trim(CAST(user_id AS VARCHAR)) <> '' AND trim(CAST(item_id AS VARCHAR)) <> ''""")
ORACLES["stream_user_counts"] = with_ctes(["c_inter"], """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
    time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, user_id,
    count(*) AS n_interactions, count(DISTINCT item_id) AS n_items
    FROM c_inter GROUP BY 1, 2, 3""")

_LOG = {"mlog": ([], """SELECT event_type AS name, ts, CAST(1 AS BIGINT) AS invocations,
    CAST(value > 100 AS BIGINT) AS errors, CAST(value AS DECIMAL(12,2)) AS duration_ms FROM events"""),
        "mwin": (["mlog"], f"""SELECT name, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
    CAST(sum(invocations) AS BIGINT) AS invocations, CAST(sum(errors) AS BIGINT) AS errors,
    {avg('duration_ms')} AS avg_duration_ms,
    round(quantile_cont(CAST(duration_ms AS DOUBLE), 0.99), 6) AS p99_duration_ms
    FROM mlog GROUP BY 1, 2""")}
ORACLES["metric_sketch_rollup"] = with_ctes(["mlog"], """SELECT name, date_trunc('hour', ts) AS hour, count(*) AS n,
    CAST(sum(errors) AS BIGINT) AS errors, TRUE AS within FROM mlog GROUP BY 1, 2""", _LOG)
ORACLES["metric_windows"] = with_ctes(["mwin"], "SELECT * FROM mwin", _LOG)


def _alarm_sql(alarm: str, src: str, thr: float, n: int) -> str:
    return f"""SELECT '{alarm}' AS alarm, g.name, g.window_start, CAST(s.value AS DOUBLE) AS value,
        coalesce(s.value > {thr}, FALSE) AS breaching,
        CASE WHEN sum(CAST(coalesce(s.value > {thr}, FALSE) AS INTEGER)) OVER (PARTITION BY g.name
             ORDER BY g.window_start ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n}
             THEN 'ALARM' ELSE 'OK' END AS state
        FROM (SELECT name, unnest(generate_series(min(window_start), max(window_start), INTERVAL 5 MINUTE))
              AS window_start FROM ({src}) GROUP BY name) g
        LEFT JOIN ({src}) s ON g.name = s.name AND g.window_start = s.window_start"""


ORACLES["alarm_eval"] = with_ctes(["mwin"], "\nUNION ALL\n".join([
    _alarm_sql("errors", "SELECT name, window_start, errors AS value FROM mwin", 5, 2),
    _alarm_sql("server_errors", "SELECT 'all' AS name, window_start, sum(errors) AS value FROM mwin GROUP BY 2",
               10, 1),
    _alarm_sql("latency_p99", "SELECT name, window_start, p99_duration_ms AS value FROM mwin", 25000, 2),
]), _LOG)
ORACLES["quota_usage"] = with_ctes(["r_inter"], """SELECT user_id, date_trunc('month', ts) AS month,
    count(*) AS calls, greatest(10000 - count(*), 0) AS remaining, count(*) > 10000 AS over_quota
    FROM r_inter GROUP BY 1, 2""")


# ---------------------------------------------------------------- sources and summary

ORACLES["scan_catalog"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count({k}) AS row_count, CAST(sum({k}) AS BIGINT) AS key_sum FROM {t}"
    for t, k in [("customer", "c_custkey"), ("part", "p_partkey"), ("events", "event_id"),
                 ("orders", "o_orderkey"), ("lineitem", "l_orderkey")])
ORACLES["etl_summary"] = with_ctes(["c_users", "c_items", "matrix", "c_txn"], """
SELECT 'total_users' AS metric, CAST(count(*) AS VARCHAR) AS value FROM c_users
UNION ALL SELECT 'total_destinations', CAST(count(*) AS VARCHAR) FROM c_items
UNION ALL SELECT 'total_interactions', CAST(count(*) AS VARCHAR) FROM matrix
UNION ALL SELECT 'total_transactions', CAST(count(*) AS VARCHAR) FROM c_txn
UNION ALL SELECT 'etl_timestamp', '2024-02-01 00:00:00'
UNION ALL SELECT 'etl_job', 'wanderrank-etl'""")


# ---------------------------------------------------------------- single-rule views

from wanderrank.plans.oracle import dedup_sql  # noqa: E402

ORACLES["dedup_by_key"] = with_ctes(["r_txn"], dedup_sql("r_txn", ["order_key", "line_number"]))
ORACLES["distinct_items"] = with_recs(REQ_PLAIN, "SELECT DISTINCT item_id FROM recs")


# ---------------------------------------------------------------- rules that the plain queries do not reach

# Requests keyed by request_id: the brute-force recommender runs with the
# request as its "user"; counts and seen items come from the request's owner.
REQ_MULTI = {k: v for k, v in REQ_FAV.items() if k != "req"}
REQ_MULTI["base"] = (REQ_FAV["req"][0], REQ_FAV["req"][1])
REQ_MULTI["owner"] = (["base"], """SELECT user_id * 2 + k AS request_id, user_id AS owner_id
    FROM base, (VALUES (0), (1)) AS t(k)""")
REQ_MULTI["req"] = (["base"], """SELECT user_id * 2 AS user_id, 3 AS top_n, favorites, categories,
    CAST(NULL AS DOUBLE) AS max_budget,
    CASE WHEN user_id % 3 = 0 THEN 'Brand#' || CAST(user_id % 25 + 1 AS VARCHAR) END AS province FROM base
    UNION ALL SELECT user_id * 2 + 1, 5, CAST([] AS BIGINT[]), CAST([] AS VARCHAR[]),
    CASE WHEN user_id % 2 = 0 THEN max_budget END, CAST(NULL AS VARCHAR) FROM base""")
REQ_MULTI["nu"] = (["rated", "owner"], """SELECT request_id AS user_id, count(*) AS n_rows
    FROM rated JOIN owner ON owner_id = user_id GROUP BY 1""")
REQ_MULTI["seen"] = (["rated", "owner", "c_items"], """SELECT DISTINCT request_id AS user_id, item_id
    FROM rated JOIN owner ON owner_id = rated.user_id WHERE item_id IN (SELECT item_id FROM c_items)""")


def _multi_sql() -> str:
    body = recommend_sql(REQ_MULTI, with_cb=True)[len("WITH "):]
    ctes_part, final = body.rsplit("\nSELECT t.user_id", 1)
    return f"""WITH {ctes_part},
owners AS (SELECT user_id * 2 + k AS request_id, user_id AS owner_id FROM c_users, (VALUES (0), (1)) AS t(k)),
recs AS (SELECT t.user_id{final})
SELECT r.user_id AS request_id, o.owner_id AS user_id, r.* EXCLUDE (user_id)
FROM recs r JOIN owners o ON o.request_id = r.user_id"""


ORACLES["recommend_multi"] = _multi_sql()
ORACLES["eval_all_users"] = _eval_sql().replace(
    "ORDER BY md5(CAST(user_id AS VARCHAR) || ':42'), user_id LIMIT 50", "")
ORACLES["adaptive_weights_recent"] = with_ctes(["c_users", "c_inter"], f"""SELECT u.user_id,
    coalesce(n.k, 0) AS n_interactions, {WEIGHTS.format(n='coalesce(n.k, 0)')}
    FROM c_users u LEFT JOIN (SELECT user_id, count(*) AS k FROM c_inter
      WHERE ts > (SELECT max(ts) FROM c_inter) - INTERVAL 3 DAY GROUP BY 1) n USING (user_id)""")
ORACLES["matrix_cap"] = with_ctes(["matrix"], """SELECT user_id, item_id, total_score, interaction_count,
    least(total_score, 1.0) AS final_score FROM matrix""")
ORACLES["quota_usage_low"] = ORACLES["quota_usage"].replace("10000", "60")
ORACLES["alarm_eval_low"] = with_ctes(["mwin"], "\nUNION ALL\n".join([
    _alarm_sql("errors", "SELECT name, window_start, errors AS value FROM mwin", 0, 2),
    _alarm_sql("server_errors", "SELECT 'all' AS name, window_start, sum(errors) AS value FROM mwin GROUP BY 2", 1, 1),
    _alarm_sql("latency_p99", "SELECT name, window_start, p99_duration_ms AS value FROM mwin", 60, 2),
]), _LOG)
ORACLES["dedup_events"] = with_ctes(["r_dup"], dedup_sql("r_inter", ["interaction_id"]).replace("FROM r_inter", "FROM r_dup"), {
    "r_dup": (["r_inter"], """SELECT * FROM r_inter UNION ALL SELECT * REPLACE (CAST(round(CAST(score AS DECIMAL(16,5)) * 0.5, 4)
        AS DECIMAL(12,4)) AS score) FROM r_inter WHERE interaction_id % 5 = 0""")})
ORACLES["clean_dirty"] = with_ctes(["r_inter"], """SELECT interaction_id, user_id, item_id, kind, score, t AS ts, rating_given,
    CAST(hour(t) AS INTEGER) AS hour, CAST(dayofweek(t) + 1 AS INTEGER) AS day_of_week, CAST(month(t) AS INTEGER) AS month
    FROM (SELECT * EXCLUDE (user_id, score, ts), CASE WHEN interaction_id % 7 <> 0 THEN user_id END AS user_id,
      CASE WHEN interaction_id % 11 = 0 THEN -score ELSE score END AS score,
      CASE WHEN interaction_id % 13 <> 0 THEN date_trunc('second', ts) END AS t FROM r_inter)
    WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND score BETWEEN 0.0 AND 1.0""")
ORACLES["clean_transactions_dirty"] = with_ctes(["r_txn"], f"""SELECT order_key, line_number, status, paid, txn_date, check_in,
    CAST(date_diff('day', check_in, check_out) AS INTEGER) AS stay_nights, CAST(status = 'completed' AS INTEGER) AS is_completed
    FROM (SELECT order_key, line_number, CASE WHEN order_key % 6 > 1 THEN status END AS status,
        CASE WHEN order_key % 10 = 3 THEN 0 ELSE paid END AS paid, CASE WHEN order_key % 7 > 1 THEN txn_date END AS txn_date,
        CASE WHEN order_key % 11 > 1 THEN check_in END AS check_in, CASE WHEN order_key % 13 > 1 THEN check_out END AS check_out
      FROM ({dedup_sql('r_txn', ['order_key', 'line_number'])}))
    WHERE paid > 0 AND status IN ('completed', 'cancelled', 'in_progress')""")
ORACLES["label_encode_nulls"] = with_ctes(["n_items", "f", "a"], """SELECT i.item_id, f._idx AS category_idx, a._idx AS category_code
    FROM n_items i LEFT JOIN f ON i.category IS NOT DISTINCT FROM f._label
    LEFT JOIN a ON coalesce(i.category, 'LARGE') = a._label""", {
    "n_items": (["c_items"], "SELECT item_id, CASE WHEN item_id % 4 <> 0 THEN category END AS category FROM c_items"),
    "f": _label_cte("n_items", "category", "freq"), "a": _label_cte("n_items", "category", "alpha", "LARGE")})
ORACLES["track_ingest_dirty"] = with_ctes(["dirty"], """SELECT user_id, item_id, coalesce(kind, 'view') AS kind,
    TRY_CAST(coalesce(score, '0.2') AS DOUBLE) AS score, ts, CAST(NULL AS VARCHAR) AS reason FROM dirty WHERE u AND i
    UNION ALL SELECT user_id, item_id, kind, NULL, ts, CASE WHEN NOT u THEN 'missing user_id' ELSE 'missing item_id' END
    FROM dirty WHERE NOT (u AND i)""", {"dirty": (["r_inter"], """SELECT *, user_id IS NOT NULL AND trim(user_id) <> '' AS u,
        item_id IS NOT NULL AND trim(item_id) <> '' AS i FROM (SELECT
        CASE interaction_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE CAST(user_id AS VARCHAR) END AS user_id,
        CASE WHEN interaction_id % 11 = 0 THEN '' ELSE CAST(item_id AS VARCHAR) END AS item_id,
        CASE WHEN interaction_id % 3 <> 0 THEN kind END AS kind,
        CASE interaction_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'much' ELSE CAST(score AS VARCHAR) END AS score, ts FROM r_inter)""")})
ORACLES["chat_append_ttl"] = with_ctes(["r_turns"], f"""SELECT session_id, turn, role,
    CASE WHEN _r = 1 THEN substring(content, 1, 50) ELSE content END AS content, ttl
    FROM (SELECT *, CAST(epoch({AS_OF}) AS BIGINT) + CASE WHEN _r = 1 THEN 7 * 86400 ELSE (turn - 2) * 3600 END AS ttl
      FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS _r FROM r_turns))
    WHERE ttl >= epoch({AS_OF})""")
ORACLES["chat_context_short"] = with_recs(_REQ_CHAT, f"""SELECT m.session_id,
    CASE WHEN m.user_id % 5 <> 0 THEN m.user_id END AS user_id,
    '{_INTRO.replace("'", "''")}' || coalesce(CASE WHEN m.user_id % 5 <> 0 THEN r.rec_text END, '') || chr(10) || chr(10)
    || 'Pengguna: ' || m.message || chr(10) || 'Asisten:' AS prompt
    FROM msg m LEFT JOIN rtext r USING (user_id)""", """msg AS (SELECT session_id, user_id, content AS message FROM r_turns
    WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) = 1),
rtext AS (SELECT user_id, chr(10) || chr(10) || 'Rekomendasi untuk user ini:' || chr(10)
    || string_agg(CAST(rank AS VARCHAR) || '. ' || name || ' (' || category || ')' || chr(10), '' ORDER BY rank) AS rec_text
    FROM recs WHERE rank <= 3 GROUP BY user_id)""")
ORACLES["stream_item_counts"] = with_ctes(["c_inter"], """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
    time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, item_id,
    count(*) AS n_interactions, count(DISTINCT user_id) AS n_users FROM c_inter GROUP BY 1, 2, 3""")

_BIAS = {
    "halves": (["c_inter"], """SELECT user_id, item_id, CASE WHEN score IS NULL THEN 1.0 ELSE least(greatest(score, 0), 5) END AS rating,
        left(md5(CAST(user_id AS VARCHAR) || ':' || CAST(item_id AS VARCHAR) || ':' || CAST(interaction_id AS VARCHAR)
                 || ':split'), 2) < '33' AS test FROM c_inter"""),
    "g": (["halves"], f"SELECT {avg('rating')} AS g FROM halves WHERE NOT test"),
    "bu": (["halves", "g"], """SELECT user_id, sum(CAST(rating AS DOUBLE) - g) / (count(*) + 10.0) AS b_u
        FROM halves, g WHERE NOT test GROUP BY 1"""),
    "bi": (["halves", "g", "bu"], """SELECT item_id, sum(CAST(rating AS DOUBLE) - g - b_u) / (count(*) + 10.0) AS b_i
        FROM halves JOIN bu USING (user_id), g WHERE NOT test GROUP BY 1"""),
}
ORACLES["eval_rmse"] = with_ctes(["halves", "g", "bu", "bi"], """SELECT round(sqrt(avg((r - p) * (r - p))), 6) AS rmse,
    round(sqrt(avg((r - g) * (r - g))), 6) AS rmse_global_mean, count(*) AS n_test
    FROM (SELECT CAST(rating AS DOUBLE) AS r, g, least(greatest(g + coalesce(b_u, 0.0) + coalesce(b_i, 0.0), 0.0), 5.0) AS p
      FROM halves LEFT JOIN bu USING (user_id) LEFT JOIN bi USING (item_id), g WHERE test)""", _BIAS)
ORACLES["cf_bias_recommend"] = with_ctes(["c_users", "c_items", "c_inter", "g", "bu", "bi"], """SELECT user_id,
    CAST(rk AS INTEGER) AS rank, item_id, round(least(greatest(g + coalesce(b_u, 0.0) + o, 0.0), 5.0), 4) AS cf_score
    FROM (SELECT u.user_id, i.item_id, b_u, g, round(coalesce(b_i, 0.0), 9) AS o,
        row_number() OVER (PARTITION BY u.user_id ORDER BY round(coalesce(b_i, 0.0), 9) DESC, i.item_id) AS rk
      FROM c_users u CROSS JOIN c_items i CROSS JOIN g LEFT JOIN bu ON bu.user_id = u.user_id LEFT JOIN bi ON bi.item_id = i.item_id
      WHERE NOT EXISTS (SELECT 1 FROM c_inter x WHERE x.user_id = u.user_id AND x.item_id = i.item_id))
    WHERE rk <= 10""", _BIAS)
ORACLES["cf_recommend_fixed"] = with_ctes(["c_users", "c_items", "c_inter"], """SELECT user_id, CAST(rk AS INTEGER) AS rank, item_id,
    round(p, 4) AS cf_score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, item_id) AS rk FROM (
      SELECT u.user_id, i.item_id, least(greatest(CASE WHEN u.user_id % 11 = 0 THEN 2.5 ELSE 2.5 + (u.user_id % 9 - 4) / 8.0 END
        + CASE WHEN i.item_id % 13 = 0 THEN 0.0 ELSE (i.item_id % 17 - 8) / 64.0 + CASE WHEN u.user_id % 11 = 0 THEN 0.0 ELSE
          ((u.user_id * 7 % 11 - 5) / 8.0 * ((i.item_id * 5 % 19 - 9) / 16.0) + (u.user_id * 3 % 13 - 6) / 8.0 * ((i.item_id * 11 % 23 - 11) / 16.0))
          / power(2.0, least(i.item_id // 128, 4)) END END, 0.0), 5.0) AS p
      FROM c_users u CROSS JOIN c_items i
      WHERE NOT EXISTS (SELECT 1 FROM c_inter x WHERE x.user_id = u.user_id AND x.item_id = i.item_id))) WHERE rk <= 10""")
_INVARIANT = with_ctes(["c_users", "c_items", "c_inter"], """SELECT u.user_id, least(10, n) AS n_rows, least(10, n) AS last_rank,
    least(10, n) AS n_items, CAST(0 AS BIGINT) AS n_seen, TRUE AS in_range
    FROM (SELECT u.user_id, (SELECT count(*) FROM c_items) - coalesce(s.k, 0) AS n FROM c_users u LEFT JOIN (
      SELECT user_id, count(DISTINCT item_id) AS k FROM c_inter WHERE item_id IN (SELECT item_id FROM c_items) GROUP BY 1) s
      USING (user_id)) u WHERE n > 0""")
ORACLES["cf_recommend_invariants"] = _INVARIANT
ORACLES["recommend_factorized_invariants"] = _INVARIANT
ORACLES["sink_scan_parquet"] = with_ctes(["c_items"], "SELECT item_id, price, category FROM c_items")
ORACLES["scan_inferred"] = with_ctes(["c_items"], "SELECT item_id, name, price, visit_hours FROM c_items")
ORACLES["scan_csv_fallback"] = with_ctes(["c_users"], """SELECT CASE WHEN user_id % 2 = 0 THEN 'csv' ELSE 'parquet' END AS origin,
    user_id, segment, budget FROM c_users""")
ORACLES["row_counts"] = with_ctes(["c_users", "c_items", "c_inter", "c_txn"], "\nUNION ALL ".join(
    f"SELECT '{n}' AS metric, CAST(count(*) AS VARCHAR) AS value FROM {t}"
    for n, t in [("users", "c_users"), ("items", "c_items"), ("interactions", "c_inter"), ("transactions", "c_txn")]))
ORACLES["sink_metadata"] = with_ctes(["c_users", "c_items"], """SELECT '1.0.0' AS version,
    (SELECT count(*) FROM c_users) AS n_users, (SELECT count(*) FROM c_items) AS n_items""")


# ---------------------------------------------------------------- repeated runs

for _name, _full in (("matrix", "interaction_matrix"), ("user_interactions", "agg_user_interactions"),
                     ("user_transactions", "agg_user_transactions"), ("item_popularity", "agg_item_popularity"),
                     ("item_revenue", "agg_item_revenue")):
    ORACLES[f"incremental_{_name}"] = ORACLES[_full]  # runs folded one by one equal one run over all
ORACLES["chat_history_store"] = ORACLES["chat_history"]
ORACLES["session_range"] = with_ctes(["r_turns"], """SELECT session_id, turn, role, CAST(pos AS INTEGER) AS pos FROM (SELECT *,
    row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS pos FROM r_turns) WHERE pos <= 5""")
ORACLES["scan_drift"] = with_ctes(["c_items"], """SELECT item_id, CASE WHEN item_id % 3 = 0 THEN floor(CAST(price AS DOUBLE))
    ELSE CAST(price AS DOUBLE) END AS price, CASE WHEN item_id % 3 = 2 THEN 'x' ELSE '' END || CAST(item_id % 10 AS VARCHAR) AS code,
    CASE WHEN item_id % 3 = 1 THEN province END AS province, 'code:string,price:double,province:string' AS types FROM c_items""")
_FINAL = {**_LOG, "mfin": (["mwin"], """SELECT * FROM mwin WHERE window_start + INTERVAL 5 MINUTE
    <= (SELECT max(ts) FROM mlog) - INTERVAL 10 MINUTE""")}
ORACLES["alarm_stream"] = with_ctes(["mfin"], "\nUNION ALL\n".join([
    _alarm_sql("errors", "SELECT name, window_start, errors AS value FROM mfin", 0, 2),
    _alarm_sql("server_errors", "SELECT 'all' AS name, window_start, sum(errors) AS value FROM mfin GROUP BY 2", 1, 1),
]), _FINAL)
ORACLES["sink_metadata_all"] = f"""SELECT '1.0.0' AS version, '2024-02-01' AS trained_at, 'Hybrid CF+CB' AS algorithm,
    'UserAverage' AS cf_algorithm, 'Cosine Similarity' AS cb_algorithm, n.n_users, n.n_destinations, n.n_interactions,
    e.precision_at_5, e.coverage, CAST(e.users_evaluated AS BIGINT) AS users_evaluated
    FROM ({ORACLES["eval_all_users"]}) e, ({with_ctes(["c_users", "c_items", "c_inter"], """SELECT (SELECT count(*) FROM c_users) AS n_users,
      (SELECT count(*) FROM c_items) AS n_destinations, (SELECT count(*) FROM c_inter) AS n_interactions""")}) n"""
