"""Conversation context built as a batch over a turns table.

For every session at once: a capped, truncated history; the user's first
recommendations as numbered lines; one prompt string per session. Per-row
work is built-in string functions; every collected list is bounded (history
cap, recommendation count), never a whole session or table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.functions.scalar import format_money, truncate
from wanderrank.sources.keyvalue import TTL_TURNS_DAYS, expire_ttl

# ---- fixed values of the prompt format --------------------------------------
USER_LABEL = "Pengguna"
ASSISTANT_LABEL = "Asisten"
RECS_HEADER = "Rekomendasi destinasi wisata untuk user ini:"
RECS_HEADER_SHORT = "Rekomendasi untuk user ini:"
HISTORY_HEADER = "Riwayat percakapan:"
RATING_LABEL = "Rating"
PRICE_LABEL = "Harga"
CURRENCY = "Rp"
HISTORY_CAP = 20       # turns read per session
HISTORY_LAST = 4       # turns shown
HISTORY_CHARS = 200    # characters per shown turn
TURN_CHARS = 2000      # characters stored per turn
PROMPT_RECS = 5
PROMPT_RECS_SHORT = 3
ANONYMOUS = "anonymous"

DEFAULT_INTRO = ("You are a friendly, well-informed travel guide. Answer warmly and "
                 "helpfully in the user's language.")


def _label(role: Column) -> Column:
    return F.when(role == "user", F.lit(USER_LABEL)).otherwise(F.lit(ASSISTANT_LABEL))


def _join_lines(order: Column, line: Column) -> Column:
    """Aggregate: lines of one group in ``order``, concatenated."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"),
                                                                          line.alias("l")))),
                                    lambda s: s["l"]), "")


def chat_history(turns: DataFrame, session: str = "session_id", order: str = "turn",
                 cap: int = HISTORY_CAP, last: int = HISTORY_LAST, chars: int = HISTORY_CHARS,
                 cap_mode: str = "oldest") -> DataFrame:
    """(session, history): of the ``cap`` oldest (or newest) turns, the last
    ``last``, each ``"<label>: <first chars>\\n"`` in turn order."""
    first = F.col(order).asc() if cap_mode == "oldest" else F.col(order).desc()
    w_cap = Window.partitionBy(session).orderBy(first)
    capped = turns.withColumn("_c", F.row_number().over(w_cap)).filter(F.col("_c") <= cap)
    w_last = Window.partitionBy(session).orderBy(F.col(order).desc())
    shown = capped.withColumn("_l", F.row_number().over(w_last)).filter(F.col("_l") <= last)
    line = F.concat(_label(F.col("role")), F.lit(": "), truncate(F.col("content"), chars), F.lit("\n"))
    return shown.groupBy(session).agg(_join_lines(F.col(order), line).alias("history"))


def rec_lines(recs: DataFrame, k: int = PROMPT_RECS, short: bool = False) -> DataFrame:
    """(user_id, rec_text): the first k recommendations as numbered lines."""
    first = recs.filter(F.col("rank") <= k)
    integral = recs.schema["price"].dataType.typeName() in ("integer", "long", "short", "byte")
    if short:
        line = F.concat(F.col("rank").cast("string"), F.lit(". "), F.col("name"), F.lit(" ("),
                        F.col("category"), F.lit(")\n"))
        header = RECS_HEADER_SHORT
    else:
        line = F.concat(F.col("rank").cast("string"), F.lit(". "), F.col("name"), F.lit(" ("),
                        F.col("category"), F.lit(", "), F.col("province"), F.lit(") - "),
                        F.lit(RATING_LABEL + ": "), F.col("rating").cast("string"),
                        F.lit(f" - {PRICE_LABEL}: {CURRENCY}"), format_money(F.col("price"), 0 if integral else 2),
                        F.lit("\n"))
        header = RECS_HEADER
    lines = first.groupBy("user_id").agg(_join_lines(F.col("rank"), line).alias("_lines"))
    return lines.select("user_id", F.concat(F.lit(f"\n\n{header}\n"), F.col("_lines")).alias("rec_text"))


def chat_context(sessions: DataFrame, recs: DataFrame, history: DataFrame,
                 intro: str = DEFAULT_INTRO, short: bool = False) -> DataFrame:
    """One prompt per session: intro, recommendation lines (none for an
    anonymous user), history, the message and the assistant cue.

    ``sessions``: (session_id, user_id, message); ``recs``: recommend_batch
    output; ``history``: chat_history output.
    """
    lines = rec_lines(recs, PROMPT_RECS_SHORT if short else PROMPT_RECS, short)
    anon = F.col("user_id").isNull() | (F.col("user_id").cast("string") == ANONYMOUS)
    j = sessions.join(history, "session_id", "left").join(lines, "user_id", "left")
    rec_text = F.when(anon, F.lit("")).otherwise(F.coalesce("rec_text", F.lit("")))
    if short:
        prompt = F.concat(F.lit(intro), rec_text, F.lit(f"\n\n{USER_LABEL}: "), F.col("message"),
                          F.lit(f"\n{ASSISTANT_LABEL}:"))
    else:
        prompt = F.concat(F.lit(intro + "\n"), rec_text, F.lit(f"\n{HISTORY_HEADER}\n"),
                          F.coalesce("history", F.lit("")), F.lit(f"\n{USER_LABEL}: "),
                          F.col("message"), F.lit(f"\n{ASSISTANT_LABEL}:"))
    return j.select("session_id", "user_id", prompt.alias("prompt"))


def chat_append(store: DataFrame, new_turns: DataFrame, as_of: str,
                ttl_days: int = TTL_TURNS_DAYS, chars: int = TURN_CHARS) -> DataFrame:
    """Append turns (content cut to ``chars``, ttl = as_of + ttl_days) and
    drop expired rows. Both frames: (session_id, turn, role, content[, ttl, ts]).
    A stored row without a ttl gets one counted from its own ``ts``, so it
    expires in its turn; without either it is kept as fresh."""
    epoch = F.unix_timestamp(F.to_timestamp(F.lit(as_of)))
    new = new_turns.select("session_id", "turn", "role", truncate(F.col("content"), chars).alias("content"),
                           (epoch + F.lit(ttl_days * 86400)).alias("ttl"))
    own = F.unix_timestamp(F.col("ts").cast("timestamp")) + F.lit(ttl_days * 86400) \
        if "ts" in store.columns else F.lit(None)
    ttl = F.col("ttl") if "ttl" in store.columns else F.lit(None)
    old = store.select("session_id", "turn", "role", "content",
                       F.coalesce(ttl.cast("long"), own.cast("long"), epoch + F.lit(ttl_days * 86400)).alias("ttl"))
    return expire_ttl(old.unionByName(new), as_of, ttl_col="ttl")
