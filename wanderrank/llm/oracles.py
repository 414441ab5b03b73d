"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from wanderrank.llm import quality as Q

_WORD = r"[^\x20\x09-\x0D]+"

# Counts of every text: words, and the words in repeated three-word windows.
QUALITY_COUNTS = rf"""
d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM {{documents}}),
w AS (SELECT rid, doc_id, source, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS k FROM g) WHERE k > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
ln AS (SELECT rid, count(*) - count(DISTINCT l) AS n
       FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
c AS (SELECT w.rid, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(ln.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep ON rep.rid = w.rid LEFT JOIN ln ON ln.rid = w.rid),
f AS (SELECT *, (n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM c),
a AS (SELECT *, base_failed OR word_chars < {Q.MIN_WORD_CHARS} * n_words OR word_chars > {Q.MAX_WORD_CHARS} * n_words
             OR n_symbols > CAST({Q.MAX_SYMBOLS_PER_WORD} AS DOUBLE) * n_words
             OR n_dup_lines > CAST({Q.MAX_DUP_LINES_PER_WORD} AS DOUBLE) * n_words AS any_failed FROM f),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(any_failed AS INT)) AS DOUBLE) AS k FROM a GROUP BY source),
s AS (SELECT count(*) AS hosts, sum(n) AS n, sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) AS q FROM h),
p0 AS (SELECT n, m, m * (1 - m) AS spread, least(1.0, hosts / n) AS noise, greatest(0.0, q - m * m) AS inside FROM s),
p1 AS (SELECT n, m, spread, CASE WHEN spread <= 0 THEN NULL WHEN noise < 1 THEN (inside / spread - noise) / (1 - noise)
                                 ELSE 1.0 END AS rho FROM p0),
p AS (SELECT n, m, spread, CASE WHEN rho > 0 THEN least(n, greatest(1.0, 1 / rho - 1)) ELSE n END AS strength FROM p1),
v AS (SELECT h.source, (k + CASE WHEN spread <= 0 THEN m * p.n + 1 ELSE m * strength END)
             / (h.n + CASE WHEN spread <= 0 THEN p.n + 2 ELSE strength END) AS rate FROM h, p),
j AS (SELECT a.*, CASE WHEN rate > {Q.STRICT_RATE} THEN 'strict' ELSE 'ok' END
             AS host_verdict FROM a JOIN v ON a.source IS NOT DISTINCT FROM v.source),
judged AS (SELECT *, NOT (base_failed OR (host_verdict = 'strict' AND any_failed)) AS kept FROM j)
"""

QUALITY = f"""
WITH {QUALITY_COUNTS.format(documents='documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host_verdict FROM judged
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _near(width: int, percent: int, more: str = "") -> str:
    """Components of the texts linked by the Jaccard similarity of word shingles."""
    return rf"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
g AS (SELECT DISTINCT rid, array_to_string(CASE WHEN len(ws) < {width} THEN ws ELSE ws[i:i + {width - 1}] END, ' ') AS g
      FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - {width - 1}, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
o AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.rid <> y.rid GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reach(a, b) AS (SELECT rid, rid FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id{more}
FROM d LEFT JOIN n ON n.rid = d.rid
JOIN (SELECT reach.a, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.rid = reach.b GROUP BY reach.a) m ON m.a = d.rid
"""


NEAR = _near(5, 75)
MINHASH = _near(3, 85, ", d.doc_id IS NOT DISTINCT FROM m.component_id AS kept")

# CRC-32 of a list of bytes by the usual table, which follows from its rule.
_CRC = """
cr(i, c, k) AS (SELECT i, i, 0 FROM range(256) t(i) UNION ALL
     SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM cr WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM cr WHERE k = 8)
"""


def _crc(bytes_: str) -> str:
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), "
            f"lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)")


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_PAIRS = "list_transform(range(0, len(ds), 2), lambda i: sha256(ds[i + 1] || coalesce(ds[i + 2], '')))"

MANIFEST = f"""
WITH RECURSIVE {_CRC},
d AS (SELECT row_number() OVER () AS rid, doc_id, lang, {_leaf('n_chars')} AS leaf,
             CASE WHEN {_crc("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 7 = 0
                  THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS changed
      FROM documents, tab),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM d),
up(tree, l, ds) AS (SELECT tree, 0, list(leaf ORDER BY pos) FROM o GROUP BY tree UNION ALL
     SELECT tree, l + 1, {_PAIRS} FROM up WHERE len(ds) > 1),
sub AS (SELECT tree, ds[1] AS subroot, l AS depth FROM up WHERE len(ds) = 1),
top(l, ds) AS (SELECT 0, list(subroot ORDER BY tree) FROM sub UNION ALL SELECT l + 1, {_PAIRS} FROM top WHERE len(ds) > 1),
p1 AS (SELECT rid, string_agg(coalesce(ds[xor(pos >> l, 1) + 1], ''), '' ORDER BY l) AS s
       FROM o JOIN up ON up.tree = o.tree AND len(ds) > 1 GROUP BY rid),
p2 AS (SELECT tree, string_agg(coalesce(ds[xor(tree >> l, 1) + 1], ''), '' ORDER BY l) AS s
       FROM sub, top WHERE len(ds) > 1 GROUP BY tree),
f1(rid, tree, ix, l, h) AS (SELECT rid, tree, pos, 0, changed FROM o UNION ALL
     SELECT rid, f1.tree, ix >> 1, f1.l + 1,
            sha256(CASE WHEN ix % 2 = 1 THEN ds[ix] || h ELSE h || coalesce(ds[ix + 2], '') END)
     FROM f1 JOIN up ON up.tree = f1.tree AND up.l = f1.l AND len(ds) > 1),
f2(rid, ix, l, h) AS (SELECT rid, f1.tree, 0, h FROM f1 JOIN sub ON sub.tree = f1.tree AND sub.depth = f1.l UNION ALL
     SELECT rid, ix >> 1, f2.l + 1, sha256(CASE WHEN ix % 2 = 1 THEN ds[ix] || h ELSE h || coalesce(ds[ix + 2], '') END)
     FROM f2 JOIN top ON top.l = f2.l AND len(ds) > 1),
r AS (SELECT l, ds[1] AS root FROM top WHERE len(ds) = 1)
SELECT o.doc_id, o.leaf, sub.subroot, r.root, sha256(coalesce(p1.s, '') || coalesce(p2.s, '')) AS proof_sha256,
       f2.h AS folded_root, f2.h = r.root AS verified
FROM o JOIN sub ON sub.tree = o.tree JOIN r ON true JOIN f2 ON f2.rid = o.rid AND f2.l = r.l
LEFT JOIN p1 ON p1.rid = o.rid LEFT JOIN p2 ON p2.tree = o.tree
"""

_BYTES = ("flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 "
          "THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) - 64 AS BIGINT)] END))")

SPELLING = rf"""
WITH RECURSIVE {_CRC},
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS k, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed FROM r GROUP BY ALL),
h AS (SELECT run, k, {_crc(_BYTES.format('keyed'))} AS h FROM c, tab),
e AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM e WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
p AS (SELECT word, unnest(range(0, length(word))) AS i FROM w),
g AS (SELECT word, substr(word, 1, i) || '_' || substr(word, i + 2) AS hole, substr(word, 1, i) || substr(word, i + 2) AS less FROM p),
near AS (SELECT x.word AS a, y.word AS b FROM g x JOIN g y ON x.hole = y.hole AND x.word <> y.word
         UNION SELECT word, less FROM g JOIN w USING (word) WHERE less IN (SELECT word FROM w)
         UNION SELECT less, word FROM g WHERE less IN (SELECT word FROM w)),
b AS (SELECT a AS word, b AS form, count(*) OVER (PARTITION BY a) AS n_near, w.n AS form_n,
             row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS rk FROM near JOIN w ON w.word = near.b),
f AS (SELECT w.word, w.n, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
             CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n FROM w LEFT JOIN b ON b.word = w.word AND rk = 1),
t(word, last) AS (SELECT word, word FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, t.last AS root, f.n, f.n_near, f.form_n
FROM f JOIN t ON t.word = f.word JOIN f z ON z.word = t.last AND z.form IS NULL
"""

SHARDS = f"""
WITH RECURSIVE {_CRC},
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT rid, doc_id, CAST(strlen(t) + 8 AS BIGINT) AS size,
             list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bs FROM d),
c AS (SELECT rid, doc_id, size, CAST({_crc('bs')} AS BIGINT) AS text_crc32 FROM b, tab),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32, rid ROWS UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST(least(23, ((2 * upto - size) * 24) // greatest(2 * total, 1)) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

ORACLES: dict[str, str] = {
    "op4_quality": QUALITY,
    "op6_byte_shards": SHARDS,
    "op9_ngram_jaccard": NEAR,
    "op11_minhash": MINHASH,
    "op12_merkle_manifest": MANIFEST,
    "op13_spelling_variants": SPELLING,
}
