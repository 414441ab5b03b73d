"""Secret scan: fixed patterns plus character Markov models (native).

Two first-order character models are trained from labelled samples: one on
random strings, one on ordinary identifiers. A candidate token is a secret if
its log-likelihood ratio (random over ordinary) is high enough, in total and
per character; or else the runs inside it are that reach the same bounds: maximal
sums of the ratio less ``MIN_RATIO_PER_CHAR``, so random parts of a path or an
assignment are found among ordinary ones. A run is widened to the separators
(``/ = - _``) around it; these and a character after itself count as neither
random nor ordinary in a run. Tokens of letters alone are judged by runs only.
Counting, scoring and span arithmetic are SQL functions.

``fit`` takes any DataFrame (value, random). The query labels its own samples:
values of pattern matches and base64 digests are random; letter-only tokens of
at least ``MIN_SAMPLE`` characters, pairs of them and numbered ones are
ordinary. At most ``SAMPLES`` matched values and tokens, chosen by hash, go in
(documented bound); every text is scanned.

Spans are code-point offsets, end exclusive, over the whole match (for
``assign`` the keyword is part of the match, its value is group 2). Pattern
kinds are leftmost and non-overlapping each; ``markov`` spans are added where
no pattern span overlaps.

Defined results: a null text is empty; an empty text has no spans and the
digest of the empty string; repeated rows give repeated results; with no
samples of a label the models are uniform and add nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderrank.llm.common import materialise, span_text

# Fixed patterns (ASCII letters of the keyword in either case).
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"  # the maximal runs of [0-9a-f]+ that are long enough
KINDS = ("assign", "access", "hex", "markov")

MIN_LENGTH = 16           # shortest token that the models judge
SAMPLES = 5_000           # values per label that a fit uses
ALPHABET = 66             # characters of a token
MIN_RATIO = 12.0          # log-likelihood ratio of the whole token
MIN_RATIO_PER_CHAR = 0.6
TOKEN = "[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH
SEPARATORS = "/=_-"
MIN_SAMPLE = 8            # shortest value that a fit uses
ORDINARY = "[A-Za-z]{%d,}" % MIN_SAMPLE

_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def find_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, value>>;
    ``value`` is the text of ``group``. The pieces between matches (split) and
    the matches themselves alternate, so running lengths are the offsets."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), values.alias("value"))
    walked = F.aggregate(
        zipped,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["gap"]) + F.coalesce(F.char_length(x["hit"]), F.lit(0)))
            .cast("bigint").alias("at"),
            F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.char_length(x["gap"])).cast("bigint").alias("start"),
                (acc["at"] + F.char_length(x["gap"]) + F.char_length(x["hit"])).cast("bigint").alias("end"),
                x["value"].alias("value"))))).alias("out")))["out"]
    return F.when(F.regexp_like(text, F.lit(pattern)), walked).otherwise(F.array().cast(_SPANS))


def _longer(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.char_length(s["value"]) >= least)


def pattern_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus ``_assign``, ``_access``, ``_hex``."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (df.withColumn("_assign", _longer(find_spans(t, ASSIGN, 2), 6))
            .withColumn("_access", _longer(find_spans(t, ACCESS), 20))
            .withColumn("_hex", find_spans(t, HEX)))


# ----------------------------------------------------------------- the models
def labelled_samples(documents: DataFrame, text: str = "text", limit: int = SAMPLES) -> DataFrame:
    """(value, random): values of pattern matches against letter-only tokens."""
    t = F.coalesce(F.col(text), F.lit(""))

    def some(df: DataFrame, label: int) -> DataFrame:
        return (df.where(F.char_length("value") >= MIN_SAMPLE)
                .select(F.left("value", F.lit(256)).alias("value"), F.xxhash64("value", "_row").alias("_o"))
                .orderBy("_o", "value").limit(limit)
                .select("value", F.lit(label).alias("random")))

    either = f"(?:{ASSIGN})|(?:{ACCESS})|(?:{HEX})"
    rows = documents.select(text, F.xxhash64(text).alias("_row"))
    found = pattern_spans(rows.where(F.regexp_like(t, F.lit(either))), text)
    random = found.select(F.explode(F.concat("_assign", "_access", "_hex")).alias("s"), "_row").select("s.value", "_row")
    plain = rows.select(F.explode(F.regexp_extract_all(t, F.lit(ORDINARY), F.lit(0))).alias("value"), "_row")
    ordinary = materialise(some(plain, 0), "ordinary-samples")
    made = F.left(F.base64(F.unhex(F.sha2("value", 256))), F.lit(40))
    joined = F.concat_ws("_", F.lower(F.left("value", F.lit(6))), F.lower("value"))
    numbered = F.concat("value", F.pmod(F.xxhash64("value"), F.lit(100)).cast("string"))
    return some(random, 1).unionAll(ordinary.select(F.explode(F.array(
        F.struct("value", "random"),
        F.struct(joined.alias("value"), "random"),
        F.struct(numbered.alias("value"), "random"),
        F.struct(made.alias("value"), F.lit(1).alias("random")))).alias("s")).select("s.*"))


def fit(samples: DataFrame) -> list[float]:
    """128 x 128 log-likelihood ratios of a character after another, add-one
    smoothed; row 0 holds the ratios of the first character. At most 2 * 128^2
    counts reach the driver."""
    chars = samples.where(F.col("value").isNotNull() & F.col("random").isNotNull()) \
        .select("random", F.filter(F.split("value", ""), lambda c: c != "").alias("c"))
    pairs = chars.select("random", F.explode(F.zip_with(
        F.concat(F.array(F.lit("\u0000")), F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0)))), "c",
        lambda a, b: F.struct(F.ascii(a).alias("a"), F.ascii(b).alias("b")))).alias("p"))
    counts = {(r["random"], r["a"], r["b"]): r["count"] for r in
              pairs.select("random", "p.a", "p.b").where("a < 128 and b < 128")
              .groupBy("random", "a", "b").count().collect()}
    after: dict = {}
    for (label, a, _), n in counts.items():
        after[label, a] = after.get((label, a), 0) + n
    log_p = lambda label, a, b: math.log(
        (counts.get((label, a, b), 0) + 1) / (after.get((label, a), 0) + ALPHABET))
    return [round(log_p(1, a, b) - log_p(0, a, b), 6) for a in range(128) for b in range(128)]


def log_ratio(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of an ASCII token, one pass over its characters."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    return F.aggregate(
        F.filter(F.split(value, ""), lambda c: c != ""),
        F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(
            F.ascii(c).alias("a"),
            (acc["sum"] + F.element_at(table, acc["a"] * 128 + F.ascii(c) + 1)).alias("sum")))["sum"]


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def random_runs(token: Column, model: list[float]) -> Column:
    """The runs of a token (struct start, end, value) that are random by
    themselves. One pass: a run ends where its sum is used up, or has lost
    ``MIN_RATIO`` since its best; its best part is taken, then widened."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    text = token["value"]
    zero = F.lit(0.0)

    def step(acc: Column, c: Column) -> Column:
        apart = c.isin(*SEPARATORS)
        gain = F.when(apart | (F.ascii(c) == acc["a"]), zero).otherwise(
            F.element_at(table, acc["a"] * 128 + F.ascii(c) + 1)) - F.lit(MIN_RATIO_PER_CHAR)
        added = F.struct(
            F.when(apart, F.lit(0)).otherwise(F.ascii(c)).alias("a"), (acc["i"] + 1).alias("i"),
            (F.greatest(acc["sum"], zero) + gain).alias("sum"),
            F.when(acc["sum"] > 0, acc["lo"]).otherwise(acc["i"]).alias("lo"))
        return _let(added, lambda n: _let(F.when(n["sum"] > acc["best"], F.struct(
            n["sum"].alias("best"), n["lo"].alias("from"), n["i"].alias("to"))).otherwise(F.struct(
                acc["best"].alias("best"), acc["from"].alias("from"), acc["to"].alias("to"))),
            lambda m: closed(acc, n, m, (n["sum"] <= 0) | (m["best"] - n["sum"] >= MIN_RATIO))))

    def closed(acc: Column, n: Column, m: Column, ends: Column) -> Column:
        return F.struct(
            n["a"].alias("a"), n["i"].alias("i"), F.when(ends, zero).otherwise(n["sum"]).alias("sum"),
            n["lo"].alias("lo"), F.when(ends, zero).otherwise(m["best"]).alias("best"),
            m["from"].alias("from"), m["to"].alias("to"),
            F.when(ends, with_run(acc["out"], m)).otherwise(acc["out"]).alias("out"))

    def with_run(out: Column, m: Column) -> Column:
        enough = (m["best"] > 0) & (m["best"] + MIN_RATIO_PER_CHAR * (m["to"] - m["from"]) >= MIN_RATIO)
        return F.when(enough, F.concat(out, F.array(F.struct(
            m["from"].alias("from"), m["to"].alias("to"))))).otherwise(out)

    start = F.struct(F.lit(0).alias("a"), F.lit(0).alias("i"), zero.alias("sum"), F.lit(0).alias("lo"),
                     zero.alias("best"), F.lit(0).alias("from"), F.lit(0).alias("to"),
                     F.array().cast("array<struct<from:int,to:int>>").alias("out"))
    found = F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, step,
                        lambda acc: with_run(acc["out"], acc))
    part = f"^[^{SEPARATORS}]*"

    def widened(r: Column) -> Column:
        before = F.reverse(F.substring(text, F.lit(1), r["from"]))
        after = F.substring(text, r["to"] + 1, F.char_length(text))
        return F.struct(
            (r["from"] - F.char_length(F.regexp_extract(before, part, 0))).alias("from"),
            (r["to"] + F.char_length(F.regexp_extract(after, part, 0))).alias("to"))

    def joined(out: Column, r: Column) -> Column:
        last = F.element_at(out, -1)
        return F.when((F.size(out) > 0) & (F.get(out, F.size(out) - 1)["to"] > r["from"]), F.concat(
            F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["from"].alias("from"), r["to"].alias("to"))))) \
            .otherwise(F.concat(out, F.array(r)))

    whole = F.aggregate(F.transform(found, widened), F.array().cast("array<struct<from:int,to:int>>"), joined)
    runs = F.transform(whole, lambda r: F.struct(
        (token["start"] + r["from"]).cast("bigint").alias("start"), (token["start"] + r["to"]).cast("bigint").alias("end"),
        F.substring(text, r["from"] + 1, r["to"] - r["from"]).alias("value")))
    return F.filter(runs, lambda r: (F.char_length(r["value"]) >= MIN_LENGTH)
                    & F.regexp_like(r["value"], F.lit("[A-Za-z]"))).cast(_SPANS)


# ------------------------------------------------------------------- the scan
def scan(df: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """``df`` plus ``secret_spans``: array<struct<start, k, end, kind>> in order
    of start, then kind. Columns ``_assign .. _markov`` are reserved."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = pattern_spans(df, text).withColumn("_tokens", F.filter(
        find_spans(t, TOKEN), lambda c: F.regexp_like(c["value"], F.lit("[A-Za-z]"))))
    base = F.concat("_assign", "_access", "_hex")

    def apart(c: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    def judged(c: Column) -> Column:
        whole = apart(c) & F.regexp_like(c["value"], F.lit("[0-9]")) & _let(log_ratio(c["value"], model), lambda ratio: (ratio >= MIN_RATIO) & (
            ratio >= MIN_RATIO_PER_CHAR * F.char_length(c["value"])))
        return F.when(whole, F.array(F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value")))) \
            .otherwise(F.filter(random_runs(c, model), apart))

    df = df.withColumn("_markov", F.when(F.size("_tokens") > 0, F.flatten(F.transform("_tokens", judged)))
                       .otherwise(F.array().cast(_SPANS)))

    def named(i: int, kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("k"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    return df.withColumn("secret_spans", F.array_sort(F.concat(*[named(i, k) for i, k in enumerate(KINDS)])))


def scan_documents(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op1_secrets``."""
    model = fit(labelled_samples(documents.select("text")))
    out = scan(documents.select("doc_id", "text"), model)
    base = F.filter("secret_spans", lambda s: s["k"] < len(KINDS) - 1)
    return out.select(
        "doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("secret_spans")).alias("spans"))
