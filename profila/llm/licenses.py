"""Operator 2 — license scans by patience alignment.

A template is found in a text where an alignment covers at least ``coverage``
(0.9) of its words.  The alignment anchors on words that occur exactly once in
both the passage and the template, keeps the longest increasing subsequence of
the anchors' places, and aligns the gaps between them in the same way; a gap
without an anchor matches its common first and last words.

Passages are the stretches of the whole text that hold enough of a template's
words within its length and a quarter more (a find may have no more foreign words
than that), and a long text costs no more than its words.  After a find
the search goes on behind it.  Where finds of two templates overlap, the one
that covers more words stays (so the more specific of two notices, and a whole
text before its first sentence), then the one with the larger share, then the
first template by name.  A text is compared only with templates of whose
different words it holds enough for the coverage, which loses nothing.

The templates given (``TEMPLATES``) are lines, notices and short texts of common
licenses (``license_texts``); the long licenses are known by their notices, not by
their whole texts, and licenses that are not named there are not found.

Words are lower-cased runs of letters and digits.  Texts are scanned where they
are read; nothing is shuffled, and only the templates are sent to the tasks: a
parameter, refused beyond ``MAX_TEMPLATE_WORDS`` words.  Null and empty texts
hold no license.  Repeated rows each give their finds; templates without words
take no part; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from . import license_texts
from .common import prepare, read

COVERAGE = 0.9
MAX_TEMPLATE_WORDS = 2_000_000
_WORD = re.compile(r"[^\W_]+")
#: Short lines under names of their own, and the set of ``license_texts``.
_LINES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "BSD notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files, to deal in the Software without restriction",
    "Proprietary": "All rights reserved",
}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _named(own: Mapping[str, str], more: Mapping[str, str]) -> dict[str, str]:
    """All templates; of equal words the name that ``own`` gives."""
    out, seen = dict(own), {tuple(words_of(t)) for t in own.values()}
    for name, text in more.items():
        if tuple(words_of(text)) not in seen:
            seen.add(tuple(words_of(text)))
            out[f"{name} work" if name in out else name] = text
    return out


_KIND = "array<struct<license:string,coverage:double,start:int,end:int>>"
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))


TEMPLATES = _named(_LINES, license_texts.templates())


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence."""
    tails, at, back = [], [], []
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        back.append(at[k - 1] if k else -1)
        tails[k:k + 1], at[k:k + 1] = [p], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text, template) places by patience alignment."""
    out, work = [], [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        there, mine = Counter(template[c:d]), Counter(text[a:b])
        place = {w: j for j, w in enumerate(template[c:d], c) if there[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(text[a:b], a) if mine[w] == 1 and w in place]
        anchors = [pairs[k] for k in increasing([j for _, j in pairs])]
        if not anchors:
            continue
        out.extend(anchors)
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        work.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]))
    return sorted(out)


class Scanner:
    def __init__(self, templates: Mapping[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = [(name, words_of(text)) for name, text in sorted(templates.items())]
        self.templates = [(name, words) for name, words in self.templates if words]
        if sum(len(w) for _, w in self.templates) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words; scan them in several runs")
        self.number: dict[str, int] = {}
        self.own = [np.unique([self.number.setdefault(w, len(self.number) + 1) for w in words]) for _, words in self.templates]
        # which words each template has, and how many different ones coverage calls for
        self.holds = np.zeros((len(self.number) + 1, len(self.own)), np.int32)
        for t, own in enumerate(self.own):
            self.holds[own, t] = 1
        self.least = np.array([len(own) - (len(words) - int(np.ceil(len(words) * coverage - 1e-9)))
                               for own, (_, words) in zip(self.own, self.templates)], int)

    def finds(self, text: list[str], ids: np.ndarray, known: np.ndarray) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, end word) in one text; known: its
        places with some template's word."""
        found = []
        enough = self.holds[np.unique(ids[known])].sum(axis=0) >= self.least
        for t in np.flatnonzero(enough).tolist():
            (name, template), own = self.templates[t], self.own[t]
            n = len(template)
            span, need = n + n // 4 + 1, int(np.ceil(n * self.coverage - 1e-9))
            at = known[np.isin(ids[known], own)]
            if len(at) < need:
                continue
            end = np.searchsorted(at, at + span)
            behind = 0
            for p in at[end - np.arange(len(at)) >= need].tolist():
                if p < behind:
                    continue
                pairs = align(text[p:p + span], template)
                if len(pairs) >= need:
                    a, b = p + pairs[0][0], p + pairs[-1][0] + 1
                    found.append((name, len(pairs) / n, a, b, len(pairs)))
                    behind = b
        found.sort(key=lambda f: (-f[4], -f[1], f[0], f[2]))
        kept: list = []  # by place; none overlap, so only the neighbours matter
        for f in found:
            i = bisect_left(kept, (f[2], f[3]), key=lambda k: k[2:4])
            if (i == 0 or kept[i - 1][3] <= f[2]) and (i == len(kept) or kept[i][2] >= f[3]):
                kept.insert(i, f)
        return [f[:4] for f in kept]

    def scan(self, texts: list[str | None]) -> list[list[dict]]:
        get, out = self.number.get, []
        for text in texts:
            words = words_of(text)
            ids = np.array([get(w, 0) for w in words], np.int64)
            found = self.finds(words, ids, np.flatnonzero(ids))
            at = [m.span() for m in _WORD.finditer(text.lower())] if found else []
            out.append([{"license": n, "coverage": c, "start": at[a][0], "end": at[b - 1][1]} for n, c, a, b in found])
        return out


def licenses(text: Column, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> Column:
    """array of (license, coverage, start, end) of a text column; code points."""
    scanner = Scanner(templates, coverage)

    @arrow_udf(_KIND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(scanner.scan(batch.to_pylist()), _ARROW)
    return run(text)


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row for each find: doc_id, license, coverage, start, end."""
    prepare(docs.sparkSession)
    return (docs.select("doc_id", F.explode(licenses(F.col("text"), templates, coverage)).alias("f"))
            .select("doc_id", "f.license", "f.coverage", "f.start", "f.end"))


def query(spark, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
