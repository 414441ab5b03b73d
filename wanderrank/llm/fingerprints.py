"""Merkle fingerprints of documents (native).

Tree: the text is cut into sections (a line with its newline), a section into
paragraphs (a sentence with its closing marks, or ``PIECE`` characters of a
longer one). A paragraph node is the MD5 of its text, a section node the
SHA-256 of its paragraph nodes, the root the SHA-256 of its section nodes with
their lengths. Equal texts have equal roots; where roots differ, comparing
section nodes and then paragraph nodes finds the differing branches.

The fingerprint string is ``root|section:leaf.leaf,section:leaf...`` with
section and leaf nodes cut to 8 hex digits: enough to locate edits in a pair,
while equality is decided by the whole root.

Defined results: a null text is an empty text; the empty text has a root and
no sections; two empty texts have likeness 1, an empty and a non-empty one 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.llm.common import shuffle_partitions

PIECE = 160
SHORT = 8
_LEAF = r"[^.!?\n]{1,%d}[.!?\n]*+|[.!?\n]++" % PIECE


def paragraph_nodes(text: Column) -> Column:
    """array<array<md5>>: the paragraph nodes of each section."""
    sections = F.filter(F.split(F.coalesce(text, F.lit("")), r"(?<=\n)", -1), lambda s: s != "")
    return F.transform(sections, lambda s: F.transform(
        F.regexp_extract_all(s, F.lit(_LEAF), F.lit(0)), lambda p: F.md5(p)))


def section_nodes(paragraphs: Column) -> Column:
    return F.transform(paragraphs, lambda ps: F.sha2(F.array_join(ps, ""), 256))


def root_node(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, ","), 256)


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus ``out`` (the fingerprint string) and ``out_leaves`` (its
    distinct short leaves). Columns ``_fp_*`` are reserved."""
    df = df.withColumn("_fp_p", paragraph_nodes(F.col(text)))
    df = df.withColumn("_fp_s", section_nodes(F.col("_fp_p")))
    body = F.array_join(F.zip_with("_fp_s", "_fp_p", lambda s, ps: F.concat(
        F.left(s, F.lit(SHORT)), F.lit(":"),
        F.array_join(F.transform(ps, lambda p: F.left(p, F.lit(SHORT))), "."))), ",")
    return (df.withColumn(out, F.concat(root_node(F.col("_fp_s")), F.lit("|"), body))
            .withColumn(f"{out}_leaves", leaves(F.col("_fp_p")))
            .drop("_fp_p", "_fp_s"))


def leaves(paragraphs: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(
        paragraphs, lambda ps: F.transform(ps, lambda p: F.left(p, F.lit(SHORT))))))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two sets of distinct leaves (0 to 1)."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(
        2.0 * F.size(F.array_intersect(a, b)) / total.cast("double"))


def differing_sections(a: Column, b: Column) -> Column:
    """0-based positions of the sections of ``a`` whose node is not in ``b``
    (both as given by ``section_nodes``): the branches that an edit touched."""
    return F.filter(F.transform(a, lambda s, i: F.when(~F.array_contains(b, s), i)),
                    lambda x: x.isNotNull())


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Number of sorted ``cuts`` that are <= key, by binary search."""
    width = 1
    while width <= len(cuts):
        width *= 2
    top = (1 << 63) - 1
    table = F.split(F.lit(",".join(map(str, cuts + [top] * (width - len(cuts))))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(width.bit_length() - 1))]) if width > 1 \
        else F.array().cast("array<int>")
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.element_at(table, at + step) <= key, at + step).otherwise(at))
    return F.least(found, F.lit(len(cuts)))


def with_next(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``df[key, value]`` plus ``out``: ``value`` of the next row by ascending
    ``key`` (null keys first, ties by value; after the last row, the first).

    The rows are dealt to key ranges cut at approximate percentiles, so the
    values cross one shuffle. The first row of each range is also sent to the
    range before it, the first row of all to the last range."""
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    n = max(2, 2 * shuffle_partitions(spark))
    # at most n values, whatever the table's size
    head = rows.agg(F.percentile_approx("_k", [i / n for i in range(1, n)], 100 * n).alias("cuts"),
                    F.min("_k").alias("low"), F.count(F.lit(1)).alias("rows"),
                    F.count("_k").alias("keys")).first()
    cuts = sorted(set(head["cuts"] or []) - {head["low"]})
    part = F.when(F.col("_k").isNull(), F.lit(0)).otherwise(_range_of(F.col("_k"), cuts))
    first = F.col("_k").isNull() if head["rows"] > head["keys"] else \
        F.col("_k") == F.lit(head["low"]).cast("long")
    edge = (F.col("_part") > 0) & (F.element_at(
        F.split(F.lit(",".join(map(str, cuts or [0]))), ",").cast("array<bigint>"),
        F.greatest(F.col("_part"), F.lit(1))) == F.col("_k"))
    nothing = F.array().cast("array<struct<part:int,turn:int>>")
    place = lambda p, turn: F.array(F.struct(p.cast("int").alias("part"), F.lit(turn).alias("turn")))
    dealt = (rows.withColumn("_part", part)
             .withColumn("_at", F.explode(F.concat(
                 place(F.col("_part"), 0),
                 F.when(F.coalesce(edge, F.lit(False)), place(F.col("_part") - 1, 1)).otherwise(nothing),
                 F.when(F.coalesce(first, F.lit(False)), place(F.lit(len(cuts)), 2)).otherwise(nothing))))
             .select("_k", "_v", F.col("_at.part").alias("_part"), F.col("_at.turn").alias("_turn")))
    w = Window.partitionBy("_part").orderBy(
        F.col("_turn") == 2, F.col("_k").asc_nulls_first(), F.col("_v").asc_nulls_first())
    return (dealt.withColumn("_n", F.lead("_v").over(w)).where("_turn = 0")
            .select(F.col("_k").alias(key), F.col("_v").alias(value), F.col("_n").alias(out)))


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op10_merkle``."""
    rows = with_next(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
                     "doc_id", "text", "next")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2)
    rows = rows.withColumn("edited", F.concat(
        F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"),
        F.when(half > 0, F.expr("substring(next, 1, cast(floor(n_chars / 2) as int))")).otherwise(F.lit(""))))
    for column, out in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next", "next_fingerprint")):
        rows = fingerprint(rows, column, out)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint_leaves"), F.col("edited_fingerprint_leaves")).alias("near_edited"),
        likeness(F.col("fingerprint_leaves"), F.col("next_fingerprint_leaves")).alias("near_next"))
