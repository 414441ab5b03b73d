"""License scan by patience alignment of texts with license templates.

A text and a template are compared as word sequences (ASCII letters, digits and
inner dots, lower case). Words that occur once in both are anchors; the longest
increasing subsequence of their positions is kept; the gaps between kept
anchors are aligned the same way, after their common ends are matched. The
share of template words aligned is the coverage.

Whole texts are read. A template is tried only where it can reach the least
coverage (aligned words are at most the template words present: a sound test,
first on the text, then on windows of twice the template's length, half
overlapping). Where a required word is repeated in such a window, so that copies
back to back have no unique words, windows of one template's length are tried
too, laid where that word would put a copy.

Versions are compared without a leading v and a closing .0 (v2, 2.0 and 2 are one
word). Where hits of two templates overlap by half of the shorter, the one with
more aligned words is reported: a GPL notice inside an LGPL notice is not.

Defined results: a null or word-free text has no license; overlapping hits of
one template keep the best, then the first; templates are a parameter (their
count and length bound the work per window); other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wanderrank.llm.common import with_package

MIN_COVERAGE = 0.75
_WORDS = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

_VERSION = re.compile(r"v?(\d+(?:\.[1-9]\d*)?)(?:\.0)?")


def _gnu(kind: str, version: str, word: tuple[str, ...]) -> dict[str, tuple[str, tuple[str, ...]]]:
    must = ("gnu", "general", version, *word)
    title = " ".join(["GNU", *word, "General Public License"])
    name = f"{kind}-{version if '.' in version else version + '.0'}"
    return {name: (f"licensed under the {title}, version {version}", must), f"{name}-notice": (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) "
        "any later version", must)}


_GNU = {**_gnu("GPL", "2", ()), **_gnu("LGPL", "2.1", ("lesser",)), **_gnu("LGPL", "3", ("lesser",)),
        **_gnu("AGPL", "3", ("affero",))}

# Public license notices, and the words that must be aligned.
TEMPLATES: dict[str, tuple[str, tuple[str, ...]]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0", ("apache", "2.0")),
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.", ("apache",)),
    "MIT": ("Released under the MIT License", ("mit", "license")),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions", ("permission", "granted")),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met", ("redistribution", "binary")),
    "GPL-3.0": ("licensed under the GNU General Public License, version 3", ("gnu", "general", "public", "3")),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version", ("gnu", "general", "3")),
    **_GNU,
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla",)),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", ("cc", "by", "4.0")),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", ("cc", "by-nc", "4.0")),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", ("cc", "by-sa", "4.0")),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("permission", "fee", "granted")),
    "ISC": ("Released under the ISC License", ("isc", "license")),
    "EPL-1.0": (
        "made available under the terms of the Eclipse Public License v1.0", ("eclipse", "public", "1.0")),
    "EPL-2.0": (
        "made available under the terms of the Eclipse Public License v2.0", ("eclipse", "public", "2.0")),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain", ("unencumbered",)),
}


def words(text: str) -> list[str]:
    found = _WORDS.findall(text.lower())
    return [_VERSION.sub(r"\1", w) if w[-1] in "0123456789" and _VERSION.fullmatch(w) else w for w in found]


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience piles)."""
    tops: list[int] = []
    top_at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before[i] = top_at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = v, i
    out = []
    i = top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned (position in a, position in b), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_a = {w: i for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and in_b.get(w) == 1}
        anchors = [(at_a[w], j) for j, w in enumerate(b[b0:b1], b0) if w in at_a and in_b[w] == 1]
        kept = [anchors[k] for k in increasing([i for i, _ in anchors])]
        if not kept:
            continue
        out += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(x[0] + 1, y[0], x[1] + 1, y[1]) for x, y in zip(edges, edges[1:])]
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, tuple[str, ...]]], least: float = MIN_COVERAGE):
        self.least = least
        self.templates = []
        for name, (text, must) in templates.items():
            w = words(text)
            self.templates.append((name, w, Counter(w), frozenset(x for m in must for x in words(m))))

    def _possible(self, have: Counter, want: Counter, total: int) -> bool:
        return sum(min(n, have[w]) for w, n in want.items() if w in have) >= self.least * total

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """[(name, coverage, first word, last word)] by first word, then name."""
        if not text:
            return []
        seq = words(text)
        if not seq:
            return []
        seen = set(seq)
        out = []
        have = None
        for name, w, want, must in self.templates:
            if not must <= seen:
                continue
            if sum(x in seen for x in want) < self.least * len(want) - (len(w) - len(want)):
                continue
            have = have or Counter(seq)
            if not self._possible(have, want, len(w)):
                continue
            span = 2 * len(w)
            hits = []
            single: set[int] = set()
            mark = min(must, key=lambda m: (want[m] or len(w), m)) if must else ""

            def look(at: int, span: int) -> bool:
                part = seq[at:at + span]
                if not must <= set(part) or not self._possible(Counter(part), want, len(w)):
                    return False
                got = align(part, w)
                if len(got) >= self.least * len(w) and must <= {w[j] for _, j in got}:
                    hits.append((len(got) / len(w), at + got[0][0], at + got[-1][0]))
                return True

            for at in range(0, max(1, len(seq) - len(w)), len(w)):
                if look(at, span) and mark and seq[at:at + span].count(mark) > want[mark]:
                    single |= {i - j for i in range(at, min(at + span, len(seq))) if seq[i] == mark
                               for j in range(len(w)) if w[j] == mark}
            for at in sorted(single):
                look(max(0, at), len(w) + min(0, at))
            taken: list = []  # in order and apart: a hit meets its neighbours only
            for cover, s, e in sorted(hits, key=lambda h: (-h[0], h[2] - h[1], h[1])):
                k = bisect_left(taken, (s,))
                if (k == len(taken) or taken[k][0] > e) and (k == 0 or taken[k - 1][1] < s):
                    taken.insert(k, (s, e, cover))
            out += [(name, cover, s, e, round(cover * len(w))) for s, e, cover in taken]
        return sorted(self._best(out), key=lambda h: (h[2], h[0]))

    @staticmethod
    def _best(hits: list) -> list[tuple[str, float, int, int]]:
        """Of hits that share half of the shorter one, the one with more words."""
        by_start = sorted(hits, key=lambda h: h[2])
        against: dict[int, list[int]] = {}
        for i, a in enumerate(by_start):
            for k in range(i + 1, len(by_start)):
                b = by_start[k]
                if b[2] > a[3]:
                    break
                if 2 * (min(a[3], b[3]) - b[2] + 1) >= min(a[3] - a[2], b[3] - b[2]) + 1:
                    against.setdefault(i, []).append(k)
                    against.setdefault(k, []).append(i)
        kept: set[int] = set()
        for i in sorted(range(len(by_start)), key=lambda i: (-by_start[i][4], -by_start[i][1], by_start[i][0], i)):
            if not kept.intersection(against.get(i, ())):
                kept.add(i)
        return [by_start[i][:4] for i in kept]


def scan_documents(documents: DataFrame, templates: dict | None = None, least: float = MIN_COVERAGE) -> DataFrame:
    """Rows of ``op3_licenses``: doc_id, n_licenses, licenses (distinct names),
    hits ('name:coverage:first word:last word'), best coverage (0: none)."""
    with_package(documents.sparkSession)
    rows = documents.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_licenses", T.LongType()),
                           T.StructField("licenses", T.StringType()), T.StructField("hits", T.StringType()),
                           T.StructField("coverage", T.DoubleType())])
    chosen = TEMPLATES if templates is None else templates

    def run(batches):
        scanner = Scanner(chosen, least)
        for b in batches:
            found = [scanner.scan(x.as_py()) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(f) for f in found], pa.int64()),
                pa.array([",".join(sorted({h[0] for h in f})) for f in found], pa.string()),
                pa.array([",".join(f"{n}:{c:.4f}:{s}:{e}" for n, c, s, e in f) for f in found], pa.string()),
                pa.array([max((h[1] for h in f), default=0.0) for f in found], pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
