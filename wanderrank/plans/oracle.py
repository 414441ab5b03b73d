"""DuckDB twins of the registered queries (the correctness oracle).

Each oracle is ``WITH <role and cleaning CTEs> <select>``; CTEs are declared
once here with their dependencies and pulled in as needed. Type rules that
keep both engines' answers identical:

* DuckDB ``CAST(double AS BIGINT)`` rounds, Spark truncates -> ``trunc`` first;
* DuckDB ``dayofweek`` counts Sunday as 0, Spark as 1 -> ``+ 1``;
* integer sums are HUGEINT in DuckDB -> ``CAST(... AS BIGINT)``;
* averages are ``CAST(sum AS DOUBLE) / count`` on both sides;
* ``row_number``/``hour``/date differences are INTEGER in Spark.
"""

from __future__ import annotations

from wanderrank.plans.roles import ORACLE_ROLES

ROLE_COLS = {
    "r_users": ["user_id", "name", "city", "segment", "budget"],
    "r_items": ["item_id", "name", "category", "province", "price", "visit_hours", "facilities"],
    "r_inter": ["interaction_id", "user_id", "item_id", "kind", "score", "ts", "rating_given"],
    "r_txn": ["order_key", "line_number", "user_id", "item_id", "paid", "status", "txn_date",
              "check_in", "check_out", "rating_after"],
    "r_turns": ["session_id", "user_id", "turn", "role", "content"],
}


def dedup_sql(src: str, keys: list[str]) -> str:
    rest = [c for c in ROLE_COLS[src] if c not in keys]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    cols = ", ".join(ROLE_COLS[src])
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1")


AVG = "CAST(sum({x}) AS DOUBLE) / count({x})"


def avg(x: str) -> str:
    return AVG.format(x=x)


CTES: dict[str, tuple[list[str], str]] = {k: ([], v) for k, v in ORACLE_ROLES.items()}

CTES.update({
    "c_users": (["r_users"], f"""SELECT user_id, name, city, segment,
        CAST(trunc(budget) AS BIGINT) AS budget
        FROM ({dedup_sql('r_users', ['user_id'])}) WHERE user_id IS NOT NULL AND budget > 0"""),
    "c_items": (["r_items"], f"""SELECT item_id, name, category, province, price, visit_hours,
        coalesce(facilities, 'toilet') AS facilities
        FROM ({dedup_sql('r_items', ['item_id'])}) WHERE item_id IS NOT NULL AND price >= 0"""),
    "c_inter": (["r_inter"], f"""SELECT *, CAST(hour(ts) AS INTEGER) AS hour,
        CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month
        FROM ({dedup_sql('r_inter', ['interaction_id'])})
        WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND score BETWEEN 0.0 AND 1.0"""),
    "c_txn": (["r_txn"], f"""SELECT *, CAST(date_diff('day', check_in, check_out) AS INTEGER)
        AS stay_nights, CAST(status = 'completed' AS INTEGER) AS is_completed
        FROM ({dedup_sql('r_txn', ['order_key', 'line_number'])})
        WHERE user_id IS NOT NULL AND paid > 0
          AND status IN ('completed', 'cancelled', 'in_progress')"""),
    "signals": (["c_inter", "c_txn"], """SELECT user_id, item_id, score FROM c_inter
        UNION ALL SELECT user_id, item_id, CAST(1.0 AS DECIMAL(12,4)) FROM c_txn
        WHERE status = 'completed'"""),
    "matrix": (["signals"], """SELECT user_id, item_id, CAST(sum(score) AS DOUBLE) AS total_score,
        count(*) AS interaction_count, least(CAST(sum(score) AS DOUBLE), 5.0) AS final_score
        FROM signals GROUP BY user_id, item_id"""),
    "ui_agg": (["c_inter"], f"""SELECT user_id, count(interaction_id) AS total_interactions,
        {avg('score')} AS avg_score,
        CAST(sum(CASE WHEN kind = 'book' THEN 1 ELSE 0 END) AS BIGINT) AS total_book,
        CAST(sum(CASE WHEN kind = 'review' THEN 1 ELSE 0 END) AS BIGINT) AS total_review,
        CAST(sum(CASE WHEN kind = 'like' THEN 1 ELSE 0 END) AS BIGINT) AS total_like,
        count(DISTINCT item_id) AS unique_items, max(ts) AS last_interaction
        FROM c_inter GROUP BY user_id"""),
    "ut_agg": (["c_txn"], f"""SELECT user_id, count(order_key) AS total_transactions,
        {avg('paid')} AS avg_spend, CAST(max(paid) AS DOUBLE) AS max_spend,
        {avg('rating_after')} AS avg_rating_given, {avg('stay_nights')} AS avg_stay,
        CAST(sum(is_completed) AS BIGINT) AS completed_transactions
        FROM c_txn GROUP BY user_id"""),
    "ip_agg": (["c_inter"], f"""SELECT item_id, count(interaction_id) AS total_views,
        {avg('score')} AS avg_interaction_score, count(DISTINCT user_id) AS unique_visitors,
        CAST(sum(CASE WHEN kind = 'book' THEN 1 ELSE 0 END) AS BIGINT) AS total_bookings,
        {avg("CASE WHEN kind = 'review' THEN rating_given END")} AS avg_user_rating
        FROM c_inter GROUP BY item_id"""),
    "ir_agg": (["c_txn"], f"""SELECT item_id, CAST(sum(paid) AS DOUBLE) AS total_revenue,
        count(order_key) AS total_completed_bookings, {avg('paid')} AS avg_transaction_value
        FROM c_txn WHERE status = 'completed' GROUP BY item_id"""),
})


def with_ctes(names: list[str], select: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, in order."""
    table = dict(CTES)
    if extra:
        table.update(extra)
    done: list[str] = []

    def visit(n: str):
        if n in done:
            return
        for d in table[n][0]:
            visit(d)
        done.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} AS ({table[n][1]})" for n in done)
    return f"WITH {body}\n{select}"
