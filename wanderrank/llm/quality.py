"""Quality rules with host verdicts.

Text rules are measured per document. A host (here: the ``source``) is judged
by the rules that its documents fail: failures are summed per host, the rates
are shrunk by a beta prior fitted to all hosts (empirical Bayes, method of
moments), and the host verdict is joined back to its documents. In a strict
host (shrunk rate above ``STRICT_RATE``) documents that fail any rule are
rejected; elsewhere only the base rules reject. That is ``op4_quality``, as its
SQL twin has it. ``keep_good`` (the pipeline) judges a host rule by rule, each
with a prior of its own: a document that fails any rule is rejected, unless the
rule is a soft one that nearly all documents of its host fail (shrunk rate above
``NORMAL_RATE``: the host's normal form, as symbols in a host of code). A small
host cannot be judged on a few documents: its rates stay near the prior's.

Per-document counts are made where the row is (Arrow batches, no shuffle);
host sums combine before their shuffle; the host table joins back by broadcast
if its counted rows are few, else by a shuffle that splits hot hosts.

Defined results: a null or empty text has no words and fails; a null host is
a host of its own; host columns are null-safe; repeated rows are judged alike;
an empty table gives no rows; other columns are carried through.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderrank.llm.common import broadcast_if_small, materialise, trim_memory, with_package

SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# soft rules, as ratios of the base counts
MIN_WORD_CHARS, MAX_WORD_CHARS = 3.0, 10.0
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINES_PER_WORD = 0.02
STRICT_RATE = 0.5
NORMAL_RATE = 0.9     # a rule that more of a host's documents fail is its form
SOFT = ("word_length", "symbols", "dup_lines")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_BLANK = " \t\n\v\f\r"


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The five counts of a text. ``bytes.split()`` splits at exactly the six
    separators of the word pattern."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8").split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _BLANK)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    repeated = 0
    if n > WINDOW:
        grams = list(zip(words, words[1:], words[2:]))
        if len(set(grams)) < len(grams):
            seen = Counter(grams)
            covered = bytearray(n)
            for i, g in enumerate(grams):
                if seen[g] > 1:
                    covered[i] = covered[i + 1] = covered[i + 2] = 1
            repeated = sum(covered)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def with_counts(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` plus the five counts (long); without ``text`` if not kept."""
    with_package(df.sparkSession)
    names = [c for c in df.columns if keep_text or c != text]
    fields = [df.schema[c] for c in names]
    schema = T.StructType(fields + [T.StructField(f"_q_{c}", T.LongType()) for c in COUNTS])

    def count(batches):
        for b in batches:
            got = [text_counts(x.as_py()) for x in b.column(text)]
            cols = [b.column(c) for c in names]
            cols += [pa.array([g[i] for g in got], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *(f"_q_{c}" for c in COUNTS)])
            trim_memory()

    return df.mapInArrow(count, schema)


def base_failed() -> Column:
    return (F.col("_q_n_words") < MIN_WORDS) | \
        (100 * F.col("_q_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_q_n_words"))


def rule_failures() -> dict[str, Column]:
    """The rules that a host is judged by; exact integer comparisons."""
    words = F.col("_q_n_words")
    return {
        "base": base_failed(),
        "word_length": (F.col("_q_word_chars") < MIN_WORD_CHARS * words)
        | (F.col("_q_word_chars") > MAX_WORD_CHARS * words),
        "symbols": F.col("_q_n_symbols") > MAX_SYMBOLS_PER_WORD * words,
        "dup_lines": F.col("_q_n_dup_lines") > MAX_DUP_LINES_PER_WORD * words,
    }


def host_verdicts(counted: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: documents, failures per rule and of any rule, shrunk
    rate, verdict ('ok', 'strict'), and for every soft rule if it is the host's
    normal form (``normal_*``, by the shrunk rate of that rule alone).

    The prior Beta(a, b) matches the mean and variance of the hosts' rates
    (document-weighted mean, variance less the binomial part). Without spread
    between hosts the prior is as strong as all documents together."""
    rules = rule_failures()
    failed = None
    for rule in rules.values():
        failed = rule if failed is None else failed | rule
    hosts = counted.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(failed.cast("long")).alias("any"),
        *[F.sum(c.cast("long")).alias(f"f_{k}") for k, c in rules.items()])
    hosts = materialise(hosts, "hosts")
    judged = ("any", *(f"f_{k}" for k in SOFT))
    s = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n"),
                  *[F.sum(k).alias(k) for k in judged],
                  *[F.sum(F.col("n") * (F.col(k) / F.col("n")) * (F.col(k) / F.col("n"))).alias(f"nrr_{k}")
                    for k in judged]).first()  # one row

    def shrunk(k: str) -> Column:
        a, b = beta_prior(s["hosts"], s["n"] or 0, s[k] or 0, s[f"nrr_{k}"] or 0.0)
        return (F.col(k) + F.lit(a)) / (F.col("n") + F.lit(a + b))

    return (hosts.withColumn("rate", shrunk("any"))
            .withColumn("verdict", F.when(F.col("rate") > STRICT_RATE, "strict").otherwise("ok"))
            .withColumns({f"normal_{k}": shrunk(f"f_{k}") > NORMAL_RATE for k in SOFT}))


def beta_prior(hosts: int, n: int, failures: int, nrr: float) -> tuple[float, float]:
    """(a, b) by moments: ``nrr`` is the sum of n_i * rate_i^2 over hosts. The
    expected weighted variance of rates is m(1-m)(1/(a+b+1))(1-h/n) + m(1-m)h/n
    for h hosts of n documents in all."""
    if not n:
        return 1.0, 1.0
    m = failures / n
    spread = m * (1 - m)
    if spread <= 0:
        return m * n + 1.0, (1 - m) * n + 1.0
    noise = min(1.0, hosts / n)
    inside = max(0.0, nrr / n - m * m)
    rho = (inside / spread - noise) / (1 - noise) if noise < 1 else 1.0
    strength = min(float(n), max(1.0, 1 / rho - 1)) if rho > 0 else float(n)
    return m * strength, (1 - m) * strength


def with_hosts(counted: DataFrame, host: str = "source") -> DataFrame:
    """``counted`` (already written: it is read twice) plus ``_q_base_failed``,
    ``_q_host`` (verdict) and ``_q_normal_*``."""
    verdicts = host_verdicts(counted, host)
    n = verdicts.count()
    v = broadcast_if_small(verdicts.select(
        F.col("host").alias("_q_h"), F.col("verdict").alias("_q_host"),
        *[F.col(f"normal_{k}").alias(f"_q_normal_{k}") for k in SOFT]), n)
    return (counted.join(v, counted[host].eqNullSafe(F.col("_q_h"))).drop("_q_h")
            .withColumn("_q_base_failed", base_failed()))


def judge(counted: DataFrame, host: str = "source") -> DataFrame:
    """``with_hosts`` plus ``_q_kept`` by the verdict on any rule. Names
    starting with ``_q_`` are reserved."""
    out = with_hosts(counted, host)
    failed = None
    for rule in rule_failures().values():
        failed = rule if failed is None else failed | rule
    rejected = F.col("_q_base_failed") | ((F.col("_q_host") == "strict") & failed)
    return out.withColumn("_q_kept", ~rejected)


def judge_by_rule(counted: DataFrame, host: str = "source") -> DataFrame:
    """``with_hosts`` plus ``_q_kept`` rule by rule: a failed rule rejects unless
    it is soft and the host's normal form."""
    rules = rule_failures()
    rejected = F.col("_q_base_failed")
    for k in SOFT:
        rejected = rejected | (rules[k] & ~F.col(f"_q_normal_{k}"))
    return with_hosts(counted, host).withColumn("_q_kept", ~rejected)


def quality_documents(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op4_quality``."""
    counted = materialise(with_counts(documents.select("doc_id", "source", "text"), keep_text=False), "quality")
    out = judge(counted)
    return out.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in COUNTS],
                      F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept"),
                      F.col("_q_host").alias("host_verdict"))


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, judged by rule and host."""
    cols = documents.columns
    counted = materialise(with_counts(documents), "quality-docs")
    return judge_by_rule(counted).where("_q_kept").select(*cols)
