"""Hybrid ranking for every request at once.

Per request (user, top_n, favourites, preferences) the reference ranks:

    final(i) = w_cf * norm(cf)(i) + w_cb * norm(cb)(i)      over cf keys U cb keys

* cf keys: catalogue items the user has not seen; with the user-mean model
  every cf score of a user is the same constant, so ``norm(cf) = 0.5`` for all
  of them (an empty set when the user has seen everything);
* cb keys: neighbours (top 20) of the favourites, best similarity per item,
  min-max normalised per user (0.5 when all equal);
* a preference filter (category in list, price <= budget, same province;
  items missing from the catalogue pass) keeps only passing keys, unless
  none passes, in which case the filter is dropped;
* top_n by score desc, item id asc; enriched with catalogue columns.

Because every non-cb unseen item has the same score, the answer only needs
the cb items plus the first ``top_n`` non-excluded items in id order. Those
are found without pairing users with the whole catalogue
(``operators.filtered``): a request with ``e`` excluded items (seen + cb) reads
``top_n + e`` ids from packed rows of the id order, or, with a filter (a
budget-only filter at or above the top price passes everything and counts as
none), that many of each dyadic block of its classes' price orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.functions.scalar import round4
from wanderrank.functions.scores import adaptive_weights
from wanderrank.operators import collaborative as CF
from wanderrank.operators import innerproduct as IP
from wanderrank.operators.filtered import LIST, first_by_id, first_ids, passing_candidates, passing_lists
from wanderrank.session import materialise, release, ship_package

TOP_N_DEFAULT = 10
TOP_N_MAX = 20
CB_NEIGHBOURS = 20
OUTPUT_COLUMNS = ["user_id", "rank", "item_id", "name", "category", "province", "rating",
                  "price", "hybrid_score", "cf_score", "cb_score", "w_cf", "w_cb"]


def normalize_requests(requests: DataFrame, mode: str = "clamp",
                       max_top_n: int | None = TOP_N_MAX) -> DataFrame:
    """Request table -> (user_id, top_n, favorites, categories, max_budget,
    province, clamped, has_filter).

    ``mode="clamp"``: top_n defaults to 10 and is capped at ``max_top_n`` (the
    source system's 20; None: no cap), which ``clamped`` tells; values below 1
    give no rows. ``mode="reject"``: requests outside 1..max_top_n are dropped.
    A null preference field means "not given"; an empty category list is no
    category filter.
    """
    def opt(name: str, default: Column) -> Column:
        return F.col(name) if name in requests.columns else default

    top_n = F.coalesce(opt("top_n", F.lit(None)).cast("int"), F.lit(TOP_N_DEFAULT))
    df = requests.select(
        F.col("user_id"), *[c for c in ("owner",) if c in requests.columns],
        top_n.alias("top_n"),
        opt("favorites", F.lit(None).cast("array<string>")).alias("favorites"),
        opt("categories", F.lit(None).cast("array<string>")).alias("categories"),
        opt("max_budget", F.lit(None)).cast("double").alias("max_budget"),
        opt("province", F.lit(None)).cast("string").alias("province"),
    )
    above = F.lit(False) if max_top_n is None else F.col("top_n") > max_top_n
    if mode == "reject":
        df = df.filter((F.col("top_n") >= 1) & ~above).withColumn("clamped", F.lit(False))
    else:
        df = df.withColumn("clamped", above)
        if max_top_n is not None:
            df = df.withColumn("top_n", F.least(F.col("top_n"), F.lit(max_top_n)))
        df = df.withColumn("top_n", F.greatest(F.col("top_n"), F.lit(0)))
    has_filter = ((F.coalesce(F.size("categories"), F.lit(0)) > 0) | F.col("max_budget").isNotNull()
                  | F.col("province").isNotNull())
    return df.withColumn("has_filter", has_filter)


def passes(category: Column, price: Column, province: Column,
           categories: Column, max_budget: Column, pref_province: Column) -> Column:
    """filter_prefs predicate for a catalogue item (never null)."""
    cat_ok = (F.coalesce(F.size(categories), F.lit(0)) == 0) | F.coalesce(
        F.array_contains(categories, category), F.lit(False))
    budget_ok = max_budget.isNull() | ~F.coalesce(price > max_budget, F.lit(False))
    prov_ok = pref_province.isNull() | F.coalesce(province == pref_province, F.lit(False))
    return cat_ok & budget_ok & prov_ok


def cb_scores(requests: DataFrame, neighbours: DataFrame, k: int = CB_NEIGHBOURS) -> DataFrame:
    """agg_best_similarity + minmax_per_user: (user_id, item_id, cb_norm).

    Similarity per favourite is the rounded (4) score of its top-k
    neighbours; the best per candidate (floored at 0) is min-max normalised
    inside the user's candidate set (0.5 when all are equal).
    """
    fav = requests.select("user_id", F.explode("favorites").alias("src"))
    nb = neighbours.filter(F.col("rank") <= k).select("src", F.col("dst").alias("item_id"),
                                                     round4(F.col("score")).alias("sim"))
    best = (fav.join(nb, "src").groupBy("user_id", "item_id")
            .agg(F.greatest(F.max("sim"), F.lit(0.0)).alias("cb")))
    return minmax_per_user(best, "cb", "cb_norm")


def minmax_per_user(df: DataFrame, col: str, out: str, key: str = "user_id") -> DataFrame:
    """(x - lo) / (hi - lo) inside each user's set; 0.5 when hi == lo.

    The window holds one user's candidate set, bounded by the request size
    (favourites x neighbours)."""
    w = Window.partitionBy(key)
    lo, hi = F.min(col).over(w), F.max(col).over(w)
    return df.withColumn(out, F.when(hi == lo, F.lit(0.5)).otherwise((F.col(col) - lo) / (hi - lo)))


def _by_request(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give every request a key of its own, so several requests of one user do
    not mix. Returns (requests keyed in ``user_id``, with the user in ``owner``;
    owners: key -> user [and request_id])."""
    given = "request_id" in requests.columns
    key = F.col("request_id") if given else F.monotonically_increasing_id()
    keyed = materialise(requests.withColumn("_req", key), "requests")
    owners = keyed.select("_req", F.col("user_id").alias("_owner"))
    return (keyed.drop("request_id").withColumnRenamed("user_id", "owner").withColumnRenamed("_req", "user_id"), owners)


def _to_users(recs: DataFrame, owners: DataFrame, with_request: bool) -> DataFrame:
    out = recs.withColumnRenamed("user_id", "_req").join(owners, "_req").withColumn("user_id", F.col("_owner"))
    head = [F.col("_req").alias("request_id")] if with_request else []
    return out.select(*head, *OUTPUT_COLUMNS)


def recommend_batch(requests: DataFrame, train: DataFrame, items: DataFrame,
                    neighbours: DataFrame | None = None, mode: str = "clamp",
                    k: int = CB_NEIGHBOURS, max_top_n: int | None = TOP_N_MAX) -> DataFrame:
    """Top-N hybrid recommendations for every request (user-mean CF).

    ``requests``: (user_id, top_n[, request_id, favorites, categories,
    max_budget, province]); a user may send several. With a ``request_id``
    (unique) the result carries it as its first column.

    ``train``: (user_id, item_id, score...) interactions the CF and weights use;
    ``items``: catalogue (item_id, name, category, province, price[, rating]);
    ``neighbours``: cosine_topk output (src, dst, score, rank), may be None;
    ``k``: neighbours used per favourite. Output columns: ``OUTPUT_COLUMNS``.
    """
    keyed, owners = _by_request(requests)
    recs = _recommend(keyed, train, items, neighbours, mode, k, max_top_n)
    return _to_users(recs, owners, "request_id" in requests.columns)


def _unseen(found: DataFrame, users: DataFrame, seen: DataFrame, cb: DataFrame) -> DataFrame:
    """The first ``top_n`` ids that are neither seen nor cb candidates."""
    mine = found.join(users.select("user_id", "owner"), "user_id").join(seen, ["owner", "item_id"], "left_anti")
    return first_by_id(mine.join(cb.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
                       .select("user_id", "item_id"), users)


def _unseen_passing(asks: DataFrame, items: DataFrame, users: DataFrame, seen: DataFrame, cb: DataFrame) -> DataFrame:
    """``_unseen`` among the items that pass the filter of a request. Requests that leave out few
    ids read lists and drop theirs in place; the others meet their candidates row by row."""
    few, columns = F.col("limit") <= LIST, ["user_id", "limit", "categories", "max_budget", "province"]
    lists = passing_lists(asks.where(few).select(*columns), items)
    mine = asks.where(few).select("user_id", "owner", "top_n")
    own = (seen.join(mine.select("owner").distinct(), "owner", "left_semi")
           .groupBy("owner").agg(F.collect_list("item_id").alias("_seen")))  # fewer than ``LIST``
    near = cb.groupBy("user_id").agg(F.collect_list("item_id").alias("_cb"))

    def free(x: Column) -> Column:
        return ~F.coalesce(F.array_contains("_seen", x), F.lit(False)) & ~F.coalesce(F.array_contains("_cb", x), F.lit(False))

    found = (lists.join(mine.join(own, "owner", "left").join(near, "user_id", "left"), "user_id")
             .select("user_id", F.explode(F.slice(F.filter("ids", free), F.lit(1), F.col("top_n"))).alias("item_id")))
    rest = passing_candidates(asks.where(~few).select(*columns), items)
    return first_by_id(found, users).unionByName(_unseen(rest, users, seen, cb))


def _flagged(cb: DataFrame, users: DataFrame, cat: DataFrame, seen: DataFrame) -> DataFrame:
    """cb plus ``known`` (in the catalogue), ``passes`` (the request's filter) and
    ``seen`` (true or null)."""
    prefs = users.select("user_id", "owner", "categories", "max_budget", "province")
    j = (cb.join(prefs, "user_id")
         .join(cat.select("item_id", F.col("category").alias("_c"),
                          F.col("province").alias("_p"), F.col("price").alias("_pr"),
                          F.lit(True).alias("_known")), "item_id", "left"))
    ok = passes(F.col("_c"), F.col("_pr"), F.col("_p"), F.col("categories"),
                F.col("max_budget"), F.col("province"))
    flagged = (j.withColumn("known", F.col("_known").isNotNull())
               .withColumn("passes", F.when(~F.col("known"), True).otherwise(ok))
               .drop("categories", "max_budget", "province", "_c", "_p", "_pr", "_known"))
    return flagged.join(seen.withColumn("seen", F.lit(True)), ["owner", "item_id"], "left").drop("owner")


def _recommend(requests: DataFrame, train: DataFrame, items: DataFrame, neighbours: DataFrame | None,
               mode: str, k: int, max_top_n: int | None) -> DataFrame:
    """recommend_batch with one row per ``user_id`` (a request key); ``owner`` is
    the user whose interactions count."""
    req = normalize_requests(requests, mode, max_top_n)
    cat = items.select("item_id", *[c for c in ("name", "category", "province", "rating", "price")
                                    if c in items.columns])
    for c, t in (("name", "string"), ("category", "string"), ("province", "string"),
                 ("rating", "double"), ("price", "double")):
        if c not in cat.columns:
            cat = cat.withColumn(c, F.lit(None).cast(t))
    rated = CF.ratings(train).select(F.col("user_id").alias("owner"), "item_id")
    n_u = rated.groupBy("owner").agg(F.count(F.lit(1)).alias("n_rows"))
    # seen pairs are kept per user, not per request; they, the request table and
    # the cb scores are each read by several branches: written once
    seen = materialise(rated.distinct().join(cat.select("item_id"), "item_id", "left_semi").select("owner", "item_id"), "seen")
    n_cat = cat.select(F.count(F.lit(1))).scalar()

    w_cf, w_cb = adaptive_weights(F.col("n_rows"))
    # a budget-only filter at or above the highest price passes every item:
    # it changes nothing, so such a request takes the unfiltered path
    max_price = cat.select(F.max("price")).scalar()
    passes_all = ((F.coalesce(F.size("categories"), F.lit(0)) == 0) & F.col("province").isNull()
                  & (F.col("max_budget").isNull() | (F.col("max_budget") >= max_price)))
    if neighbours is not None:
        cb = materialise(cb_scores(req, neighbours, k).select("user_id", "item_id", "cb_norm"), "cb")
    else:
        cb = req.select("user_id", F.lit(None).cast(cat.schema["item_id"].dataType).alias("item_id"),
                        F.lit(None).cast("double").alias("cb_norm")).where(F.lit(False))
    n_cb = cb.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_cb"))
    users = materialise(
        req.join(n_u, "owner", "left")
        .join(seen.groupBy("owner").agg(F.count(F.lit(1)).alias("n_seen")), "owner", "left")
        .join(n_cb, "user_id", "left")
        .withColumn("has_filter", F.col("has_filter") & ~F.coalesce(passes_all, F.lit(False)))
        .withColumn("w_cf", w_cf).withColumn("w_cb", w_cb)
        .withColumn("cf_nonempty", n_cat - F.coalesce(F.col("n_seen"), F.lit(0)) > 0)
        .withColumn("limit", F.col("top_n") + F.coalesce("n_seen", F.lit(0)) + F.coalesce("n_cb", F.lit(0))), "users")
    asks = users.where(F.col("cf_nonempty") & (F.col("top_n") >= 1))

    # ---- filler with filter
    filler_pass = materialise(_unseen_passing(asks.where("has_filter"), cat, users, seen, cb), "passing")

    cb_flagged = _flagged(cb, users, cat, seen)
    # a passing key exists when a cb key passes or an unseen, non-cb item was found
    some = filler_pass.select("user_id").unionByName(cb_flagged.where("passes").select("user_id")).distinct()
    flags = materialise(
        users.join(some.withColumn("_some", F.lit(True)), "user_id", "left")
        .withColumn("use_filter", F.col("has_filter") & F.col("_some").isNotNull())
        .select("user_id", "use_filter", "top_n", "w_cf", "w_cb", "cf_nonempty"), "flags")

    # ---- filler without filter, for requests that have none or whose filter passes nothing
    plain = asks.join(flags.where(~F.col("use_filter")), "user_id", "left_semi").select("user_id", "limit")
    filler_any = _unseen(first_ids(plain, cat), users, seen, cb)

    cb_part = (cb_flagged.join(flags, "user_id")
               .filter(~F.col("use_filter") | F.col("passes"))
               .select("user_id", "item_id", "cb_norm",
                       (F.col("known") & F.col("seen").isNull()).alias("unseen")))
    fill_part = (filler_any.unionByName(filler_pass.join(flags.where("use_filter"), "user_id", "left_semi"))
                 .select("user_id", "item_id", F.lit(None).cast("double").alias("cb_norm"),
                         F.lit(True).alias("unseen")))
    cands = (cb_part.unionByName(fill_part).join(flags, "user_id")
             .withColumn("cf_norm", F.when(F.col("unseen") & F.col("cf_nonempty"), 0.5)
                         .otherwise(0.0))
             .withColumn("cb_norm", F.coalesce("cb_norm", F.lit(0.0)))
             .withColumn("score", F.col("w_cf") * F.col("cf_norm") + F.col("w_cb") * F.col("cb_norm")))
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    top = cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.col("top_n"))
    return join_enrich(top, cat)


def join_enrich(top: DataFrame, cat: DataFrame) -> DataFrame:
    """Attach catalogue attributes; unknown item -> "" for text, 0 for numbers."""
    j = top.join(cat, "item_id", "left")
    return j.select(
        "user_id", "rank", "item_id",
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("category", F.lit("")).alias("category"),
        F.coalesce("province", F.lit("")).alias("province"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        round4(F.col("score")).alias("hybrid_score"),
        round4(F.col("cf_norm")).alias("cf_score"),
        round4(F.col("cb_norm")).alias("cb_score"),
        "w_cf", "w_cb")


# ---------------------------------------------------------------- factor-model CF

LOW, TOP, PLACES = 0.0, 5.0, 4


def _factor_block(key, u, it):
    """One user block x one item block of the factor model: per request the best
    ``top_n`` unseen items outside its cb candidates by rounded score (kind 0), the
    same among passing items (kind 1, requests with a filter), and the highest and
    the lowest score of its unseen items (kinds 2 and 3, item null)."""
    import numpy as np
    import pandas as pd

    from wanderrank.operators.topk import topk_rows

    cols = {"user_id": [], "item_id": [], "s": [], "kind": []}
    if u.empty or it.empty:
        return pd.DataFrame({"user_id": u["user_id"].iloc[:0], "item_id": it["i_id"].iloc[:0],
                             "s": pd.Series([], dtype="float64"), "kind": pd.Series([], dtype="int32")})
    iid = it["i_id"].to_numpy()
    uid = u["user_id"].to_numpy()
    s = np.round(np.clip(np.stack(u["vec"].to_numpy()) @ np.stack(it["i_vec"].to_numpy()).T, LOW, TOP), PLACES)
    # preference mask (same rules as ``passes``): labels as integer codes, each
    # distinct category list and province evaluated once per block
    cat_names, cat = np.unique(it["i_category"].fillna("\0").to_numpy(dtype=str), return_inverse=True)
    prov_names, prov = np.unique(it["i_province"].fillna("\0").to_numpy(dtype=str), return_inverse=True)
    price = it["i_price"].to_numpy(dtype="float64")
    ok = np.ones(s.shape, dtype=bool)
    bud = u["max_budget"].to_numpy(dtype="float64")
    hb = ~np.isnan(bud)
    ok[hb] &= ~(price[None, :] > bud[hb, None])
    lists = [() if c is None else tuple(sorted(x for x in c if x is not None)) if len(c) else ()
             for c in u["categories"]]
    some = np.array([c is not None and len(c) > 0 for c in u["categories"]], dtype=bool)
    provs = u["province"].where(u["province"].notna(), None)
    for wanted in {c for c, has in zip(lists, some) if has}:
        rows = np.flatnonzero(some & np.array([c == wanted for c in lists], dtype=bool))
        ok[rows] &= np.isin(cat, np.flatnonzero(np.isin(cat_names, np.array(wanted, dtype=str))))
    for wanted in {p for p in provs if p is not None}:
        rows = np.flatnonzero((provs == wanted).to_numpy(dtype=bool))
        ok[rows] &= np.isin(prov, np.flatnonzero(prov_names == wanted))
    order = np.argsort(iid)

    def places(column):
        """(rows, columns) of the listed items in this block."""
        sizes = np.array([0 if x is None else len(x) for x in column], dtype=np.int64)
        rr = np.repeat(np.arange(len(u)), sizes)
        flat = np.concatenate([np.asarray(x) for x in column if x is not None and len(x)]) if len(rr) else iid[:0]
        at = np.minimum(np.searchsorted(iid[order], flat), len(iid) - 1)
        here = iid[order][at] == flat
        return rr[here], order[at][here]

    def emit(r, c, kind):
        cols["user_id"].append(uid[r])
        cols["item_id"].append(iid[c].astype(object))
        cols["s"].append(s[r, c])
        cols["kind"].append(np.full(len(r), kind, dtype="int32"))

    rank = s.copy()
    rank[places(u["seen"])] = -np.inf
    hi = rank.max(axis=1)
    any_ = np.flatnonzero(np.isfinite(hi))
    lo = np.where(np.isfinite(rank), rank, np.inf).min(axis=1)
    for kind, x in ((2, hi), (3, lo)):
        cols["user_id"].append(uid[any_])
        cols["item_id"].append(np.full(len(any_), None, dtype=object))
        cols["s"].append(x[any_])
        cols["kind"].append(np.full(len(any_), kind, dtype="int32"))
    rank[places(u["cb"])] = -np.inf
    top_n = u["top_n"].to_numpy(dtype="int64")
    emit(*topk_rows(s, iid, top_n, rank), 0)
    emit(*topk_rows(s, iid, np.where(u["has_filter"].to_numpy(dtype=bool), top_n, 0), np.where(ok, rank, -np.inf)), 1)
    return pd.DataFrame({k: np.concatenate(v) for k, v in cols.items()})


def _further_blocks(users: DataFrame, blocks: DataFrame, found: DataFrame) -> DataFrame:
    """users plus ``block``: the blocks after the first that may hold one of a request's
    ``top_n`` items, one of its passing ones, or a lower unseen score than ``found``."""
    kind, top_n = F.col("kind"), F.col("top_n")
    floors = found.groupBy("user_id").agg(
        F.count_if(kind == 0).alias("_n0"), IP.last_find(found, "s", kind == 0).alias("_l0"),
        F.count_if(kind == 1).alias("_n1"), IP.last_find(found, "s", kind == 1).alias("_l1"),
        F.min(F.when(kind == 3, F.col("s"))).alias("_low"))
    u = users.join(floors, "user_id", "left")
    for k in "01":
        last = F.when(F.col(f"_n{k}") >= top_n, F.col(f"_l{k}"))
        u = u.withColumn(f"_f{k}", -last["p"]).withColumn(f"_i{k}", last["i"]).drop(f"_n{k}", f"_l{k}")

    def reaches(vec, batch):
        floor = [IP.numbers(batch.column(f"_f{k}"), float("-inf")) for k in "01"]
        ids = [batch.column(f"_i{k}").fill_null(IP.LATE).to_numpy() for k in "01"]
        least = IP.numbers(batch.column("_low"), float("inf"))
        budget = IP.numbers(batch.column("max_budget"), float("inf"))
        filtered = batch.column("has_filter").to_numpy(zero_copy_only=False).astype(bool)

        def test(nodes, rows, at):
            best = IP.upper_bounds(vec[rows], nodes, at, LOW, TOP, PLACES)
            worst = -IP.upper_bounds(-vec[rows], nodes, at, -TOP, -LOW, PLACES)
            above = [(best > f[rows]) | ((best == f[rows]) & (nodes["id"][at] < i[rows])) for f, i in zip(floor, ids)]
            may_pass = filtered[rows] & (nodes["price"][at] <= budget[rows])
            return above[0] | (above[1] & may_pass) | (worst < least[rows])
        return test

    return IP.route(u, IP.bound_tree(blocks), reaches).drop("_f0", "_i0", "_f1", "_i1", "_low")


def _known_scores(users: DataFrame, known: DataFrame, seen: DataFrame, cb: DataFrame, block_rows: int) -> DataFrame:
    """Rows of ``_factor_block`` for the items ``known`` (item_id, vec, category,
    province, price): every request meets the block of the largest norms, then
    those that its finds there do not rule out."""
    blocks = materialise(IP.item_blocks(known, block_rows), "item-blocks")
    where = blocks.select("item_id", "block")
    mine = materialise(seen.join(where, "item_id").groupBy("owner", "block").agg(F.collect_list("item_id").alias("seen")), "seen-blocks")
    near = materialise(cb.join(where, "item_id").groupBy("user_id", "block").agg(F.collect_list("item_id").alias("cb")), "cb-blocks")
    uid, iid = users.schema["user_id"].dataType.simpleString(), known.schema["item_id"].dataType.simpleString()

    def scores(routes):
        lists = routes.join(mine, ["owner", "block"], "left").join(near, ["user_id", "block"], "left").drop("owner")
        return IP.meet_blocks(lists, blocks, block_rows, _factor_block, f"user_id {uid}, item_id {iid}, s double, kind int")

    first = materialise(scores(users.withColumn("block", F.lit(0).cast("long"))), "first-block")
    routes = materialise(_further_blocks(users, blocks, first), "routes")
    scored = materialise(first.unionByName(scores(routes)), "scored")
    release(blocks, mine, near, first, routes)
    return scored


def _score(x: Column) -> Column:
    """Clipped and rounded like the block scores (half to even)."""
    return F.rint(F.least(F.greatest(x, F.lit(LOW)), F.lit(TOP)) * 10.0 ** PLACES) / 10.0 ** PLACES


def recommend_batch_factorized(requests: DataFrame, train: DataFrame, items: DataFrame,
                               parts: dict, neighbours: DataFrame | None = None,
                               mode: str = "clamp", block_rows: int = 2048,
                               k: int = CB_NEIGHBOURS, max_top_n: int | None = TOP_N_MAX) -> DataFrame:
    """recommend_batch with the factor model as CF (scores vary per item).

    CF scores are ``round(clip(prediction, 0, 5), 4)`` for unseen catalogue
    items, min-max normalised over all of a user's unseen items. Items without a
    vector score alike for a request, so its best of them are its first ids and are
    found as in ``recommend_batch``. Items with a vector lie in norm blocks, of which
    a request meets the first and those whose bounds reach its finds
    (``operators.innerproduct``). A block returns only the per-request lists
    described in ``_factor_block``; everything else is relational.
    """
    spark = requests.sparkSession
    ship_package(spark)
    with_request = "request_id" in requests.columns
    requests, owners = _by_request(requests)
    req = normalize_requests(requests, mode, max_top_n)
    cat = items.select("item_id", *[c for c in ("name", "category", "province", "rating", "price")
                                    if c in items.columns])
    for c, t in (("name", "string"), ("category", "string"), ("province", "string"),
                 ("rating", "double"), ("price", "double")):
        if c not in cat.columns:
            cat = cat.withColumn(c, F.lit(None).cast(t))
    uvec, ivec = CF._augmented(parts)
    plain_cat = cat.select("item_id", "category", "province", F.col("price").cast("double").alias("price"))
    known = materialise(plain_cat.join(ivec.where("vec is not null").select("item_id", "vec"), "item_id"), "known")
    alike = materialise(plain_cat.join(known.select("item_id"), "item_id", "left_anti"), "alike")
    n_alike = alike.count()

    rated = CF.ratings(train).select(F.col("user_id").alias("owner"), "item_id")
    n_u = rated.groupBy("owner").agg(F.count(F.lit(1)).alias("n_rows"))
    seen = materialise(rated.distinct().join(cat.select("item_id"), "item_id", "left_semi").select("owner", "item_id"), "seen")
    n_seen = seen.join(alike.select("item_id", F.lit(1).alias("_a")), "item_id", "left").groupBy("owner").agg(
        F.count(F.lit(1)).alias("n_seen"), F.count("_a").alias("n_seen_alike"))
    n_cat = cat.select(F.count(F.lit(1))).scalar()
    if neighbours is not None:
        cb = materialise(cb_scores(req, neighbours, k).select("user_id", "item_id", "cb_norm"), "cb")
    else:
        cb = req.select("user_id", F.lit(None).cast(cat.schema["item_id"].dataType).alias("item_id"),
                        F.lit(None).cast("double").alias("cb_norm")).where(F.lit(False))
    n_cb = cb.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_cb"))
    w_cf, w_cb = adaptive_weights(F.col("n_rows"))
    zero = F.lit(0)
    cold = F.concat(F.array(F.lit(parts["global"]).cast("double"), F.lit(1.0)), F.array_repeat(F.lit(0.0), parts["rank"]))
    users = materialise(
        req.join(n_u, "owner", "left").join(n_seen, "owner", "left").join(n_cb, "user_id", "left")
        .join(uvec.select(F.col("user_id").alias("owner"), "vec"), "owner", "left")
        .withColumn("vec", F.coalesce("vec", cold))
        .withColumn("s_alike", _score(F.col("vec")[0]))
        .withColumn("w_cf", w_cf).withColumn("w_cb", w_cb)
        .withColumn("any_alike", n_alike - F.coalesce("n_seen_alike", zero) > 0)
        .withColumn("cf_nonempty", n_cat - F.coalesce("n_seen", zero) > 0)
        .withColumn("limit", F.col("top_n") + F.coalesce("n_seen", zero) + F.coalesce("n_cb", zero)), "users")
    asks = users.where(F.col("cf_nonempty") & (F.col("top_n") >= 1))

    scored = _known_scores(asks.select("user_id", "owner", "vec", "top_n", "has_filter", "categories", "max_budget", "province"),
                           known, seen, cb, block_rows)
    alike_pass = materialise(_unseen_passing(asks.where("has_filter"), alike, users, seen, cb), "passing")
    cb_flagged = materialise(_flagged(cb, users, cat, seen), "cb-flagged")
    # a passing key exists when a cb key passes or an unseen, non-cb item was found
    some = (scored.where("kind = 1").select("user_id").unionByName(alike_pass.select("user_id"))
            .unionByName(cb_flagged.where("passes").select("user_id")).distinct())
    bounds = scored.where("kind >= 2").groupBy("user_id").agg(
        F.max(F.when(F.col("kind") == 2, F.col("s"))).alias("hi"), F.min(F.when(F.col("kind") == 3, F.col("s"))).alias("lo"))
    own = F.when(F.col("any_alike"), F.col("s_alike"))
    flags = materialise(
        users.join(some.withColumn("_some", F.lit(True)), "user_id", "left").join(bounds, "user_id", "left")
        .withColumn("use_filter", F.col("has_filter") & F.col("_some").isNotNull())
        .withColumn("hi", F.greatest("hi", own)).withColumn("lo", F.least("lo", own))  # nulls are passed over
        .select("user_id", "top_n", "w_cf", "w_cb", "use_filter", "hi", "lo", "s_alike"), "flags")

    plain = asks.join(flags.where(~F.col("use_filter")), "user_id", "left_semi").select("user_id", "limit")
    alike_any = _unseen(first_ids(plain, alike), users, seen, cb)
    alike_fill = (alike_any.unionByName(alike_pass.join(flags.where("use_filter"), "user_id", "left_semi"))
                  .join(flags.select("user_id", "top_n", F.col("s_alike").alias("s")), "user_id"))
    known_fill = (scored.where("kind <= 1").join(flags.select("user_id", "top_n", "use_filter"), "user_id")
                  .where(F.col("kind") == F.col("use_filter").cast("int")))
    wf = Window.partitionBy("user_id").orderBy(F.col("s").desc(), F.col("item_id").asc())
    fill = (known_fill.select("user_id", "item_id", "s", "top_n").unionByName(alike_fill.select("user_id", "item_id", "s", "top_n"))
            .withColumn("_r", F.row_number().over(wf)).where(F.col("_r") <= F.col("top_n"))
            .select("user_id", "item_id", "s", F.lit(None).cast("double").alias("cb_norm")))
    # written step by step: one plan of all that follows is planned anew after each of its
    # stages, and took more of the driver's memory than its tables do
    fill = materialise(fill, "fill")
    release(scored, alike_pass)
    # cb items: scored pair by pair where the item has a vector
    dot = F.aggregate(F.zip_with("vec", "_v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    keys = cb_flagged.where(F.col("known") & F.col("seen").isNull()).select("user_id", "item_id")
    pairs = (keys.join(known.select("item_id", F.col("vec").alias("_v")), "item_id")
             .join(users.select("user_id", "vec"), "user_id").select("user_id", "item_id", _score(dot).alias("_s")))
    cb_part = (cb_flagged.join(flags.select("user_id", "use_filter", "s_alike"), "user_id")
               .where(~F.col("use_filter") | F.col("passes"))
               .join(pairs, ["user_id", "item_id"], "left")
               .select("user_id", "item_id", F.when(F.col("known") & F.col("seen").isNull(), F.coalesce("_s", "s_alike")).alias("s"),
                       "cb_norm"))
    cb_part = materialise(cb_part, "cb-part")
    release(cb_flagged, known, alike, seen)
    cands = (fill.unionByName(cb_part).join(flags.drop("use_filter", "s_alike"), "user_id")
             .withColumn("cf_norm", F.when(F.col("s").isNull(), F.lit(0.0))
                         .when(F.col("hi") == F.col("lo"), F.lit(0.5))
                         .otherwise((F.col("s") - F.col("lo")) / (F.col("hi") - F.col("lo"))))
             .withColumn("cb_norm", F.coalesce("cb_norm", F.lit(0.0)))
             .withColumn("score", F.col("w_cf") * F.col("cf_norm") + F.col("w_cb") * F.col("cb_norm")))
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    top = cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.col("top_n"))
    top = materialise(top.select("user_id", "rank", "item_id", "score", "cf_norm", "cb_norm", "w_cf", "w_cb"), "top")
    release(fill, cb_part, flags, users)
    return _to_users(join_enrich(top, cat), owners, with_request)
