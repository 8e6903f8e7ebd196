import random

import numpy as np
import xxhash
from data import corpus, docs, words

from profila.llm import substrings as B


def plain_chunks(data: bytes):
    """Byte by byte, with the rolling hash as it is defined."""
    out, h, last = [], 0, 0
    for i, b in enumerate(data):
        h = ((h << 1) + int(B.GEAR[b])) & 0xFFFF
        whole = i + 1 == len(data) or data[i + 1] & 0xC0 != 0x80
        if h >> 12 == 0 and whole and i + 1 >= B.WINDOW and i + 1 - last >= B.LOW:
            out.append((last, i + 1))
            last = i + 1
    if last < len(data):
        out.append((last, len(data)))
    parts = []
    for s, e in out:
        while e - s > B.HIGH:
            m = s + B.HIGH
            while data[m] & 0xC0 == 0x80:
                m -= 1
            parts.append((s, m))
            s = m
        parts.append((s, e))
    return parts


def test_chunks_against_definition():
    rng = random.Random(1)
    for text in ["", "a", "é" * 700, "a" * 1000, " ".join(words(rng, 900)), "".join(rng.choice("aé😀 b\n") for _ in range(5000))]:
        data = text.encode()
        got = B.chunks(data)
        assert got == plain_chunks(data)
        assert b"".join(data[s:e] for s, e in got) == data
        assert all(data[s:e].decode() for s, e in got) and all(e - s <= B.HIGH for s, e in got)


def test_insertion_moves_few_chunks():
    data = " ".join(words(random.Random(2), 3000)).encode()
    a = {data[s:e] for s, e in B.chunks(data)}
    moved = data[:5000] + b"INSERTED" + data[5000:]
    b = {moved[s:e] for s, e in B.chunks(moved)}
    assert len(b - a) <= 6


def plain_rid(i, t):
    h = 42
    for part in (None if i is None else i.to_bytes(8, "little", signed=True), None if t is None else t.encode()):
        h = h if part is None else xxhash.xxh64_intdigest(part, h)
    return h - (1 << 64) * (h >> 63)


def plain_occurrences(rows):
    """chunk → its occurrences (key, rid, start byte) over different rows."""
    of = {}
    for i, t in {(i, t) for i, t, _ in rows}:
        data = (t or "").encode()
        key = i if i is not None else (1 << 62) | (xxhash.xxh64_intdigest(data, 42) & ((1 << 62) - 1))
        for s, e in plain_chunks(data):
            of.setdefault(data[s:e], []).append((key, plain_rid(i, t), s))
    return of


def plain_repeats(rows, min_words):
    """Repeated runs by the definition: (id, start, end, words, whole of it stays)."""
    of, out = plain_occurrences(rows), set()
    first = {c: min(x) for c, x in of.items()}
    for i, t in {(i, t) for i, t, _ in rows}:
        data, run = (t or "").encode(), []
        for c in [*plain_chunks(data), None]:
            if c and len(of[data[c[0]:c[1]]]) > 1:
                run.append(c)
                continue
            if run:
                a, b = run[0][0], run[-1][1]
                n = sum(1 for p in range(a, b) if not data[p:p + 1].isspace() and (p == 0 or data[p - 1:p].isspace()))
                if n >= min_words:
                    stays = all(first[data[s:e]][1:] == (plain_rid(i, t), s) for s, e in run)
                    out.add((i, len(data[:a].decode()), len(data[:b].decode()), n, stays))
            run = []
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    passages = [" ".join(words(rng, 60, 3000)) for _ in range(5)]
    rows = corpus(11, 50)
    for i in range(40):
        rows.append((500 + i, "\n".join([" ".join(words(rng, rng.randrange(80), 3000)), passages[i % 5] + " é😀", " ".join(words(rng, 30, 3000))]), "s"))
    for i in range(40):
        rows.append((600 + i, " ".join(words(rng, 200, 100_000)), "s"))
    for i in range(10):  # inside one document, and in rows of one id
        rows.append((700 + i, "\n".join([" ".join(words(rng, 40, 100_000)), passages[0]] * 3), "s"))
        rows.append((800, "\n".join([f"row {i}", " ".join(words(rng, 30, 100_000)), passages[i % 2]]), "s"))
    rows += rows[-7:]
    got = {(r.doc_id, r.start, r.end, r.words, r.kept) for r in B.repeated(docs(spark, rows)).collect()}
    assert got == plain_repeats(rows, B.MIN_WORDS)
    ids = {g[0] for g in got}
    assert set(range(500, 540)) | set(range(700, 710)) | {800} <= ids and not ids & set(range(600, 640))


def test_shared_short_line_is_no_passage(spark):
    rng = random.Random(4)
    rows = [(i, "All rights reserved by the people of the town.\n" + " ".join(words(rng, 100, 100_000)), "s") for i in range(30)]
    assert B.repeated(docs(spark, rows)).count() == 0


def test_nulls_and_empty_table(spark):
    assert B.repeated(docs(spark, [])).count() == 0
    text = " ".join(words(random.Random(5), 100))
    df = docs(spark, [(None, text, None), (None, None, "a"), (1, "", "a"), (4, text, "a"), (4, text, "a"), (2, None, "b")])
    got = sorted((str(r.doc_id), r.kept, r.first_doc) for r in B.repeated(df).collect())
    assert got == [("4", True, 4), ("None", False, 4)]


def test_every_chunk_is_kept_in_one_document(spark):
    rng = random.Random(6)
    passage = " ".join(words(rng, 60, 100_000))
    whole = "\n".join([" ".join(words(rng, 80, 100_000)), passage, " ".join(words(rng, 80, 100_000))])
    rows = [(1, " ".join(words(rng, 40, 100_000)) + "\n" + passage, "s"), (2, whole, "s"), (3, whole, "s")]
    texts, kept, seen = {i: t for i, t, _ in rows}, {}, {}
    for r in B.parts(docs(spark, rows)).collect():
        part = (len(texts[r.doc_id][:r.start].encode()), len(texts[r.doc_id][:r.end].encode()))
        data = texts[r.doc_id].encode()
        for s, e in plain_chunks(data):
            if part[0] <= s and e <= part[1]:
                seen.setdefault(data[s:e], set()).add(r.doc_id)
                if r.kept:
                    kept.setdefault(data[s:e], set()).add(r.doc_id)
    assert {2, 3} <= set().union(*seen.values())
    assert all(kept.get(c) == {min(i for i in texts if c in [texts[i].encode()[s:e] for s, e in plain_chunks(texts[i].encode())])} for c in seen)


def test_repeats_inside_one_document(spark):
    passage = " ".join(words(random.Random(7), 80, 100_000)) + "\n"
    got = B.parts(docs(spark, [(1, passage * 5, "s"), (2, " ".join(words(random.Random(8), 200, 100_000)), "s")])).collect()
    kept = sorted((r.start, r.end) for r in got if r.kept)
    assert {r.doc_id for r in got} == {1} and {r.first_doc for r in got} == {1}
    assert kept[0][0] < len(passage) and sum(b - a for a, b in kept) <= len(passage) + 2 * B.HIGH
    assert sum(r.words for r in got if not r.kept) >= 4 * 80 - 20


def test_recurring_digests_are_told_and_dealt():
    rng, told, seen, home = random.Random(9), np.empty(0, np.int64), {}, {}
    for _ in range(20):
        digest = np.array([rng.randrange(50) for _ in range(30)] + [7] * 100, np.int64)
        mark, told = B._known(digest, told)
        for d, m in zip(digest.tolist(), mark.tolist()):
            seen[d] = seen.get(d, 0) + 1
            if m != B._KNOWN:
                home.setdefault(d, []).append(m)
    assert home[7] == [B._TELLS]  # one row of it in its partition
    for d, n in seen.items():
        assert n == 1 or B._TELLS in home[d] or len(home[d]) == n


def test_hot_digest_fills_no_task(spark):
    rng = random.Random(10)
    line = " ".join(words(rng, 60, 100_000)) + "\n"
    rows = [(i, line + " ".join(words(rng, 20, 100_000)), "s") for i in range(3000)]
    df = docs(spark, rows).repartition(6)
    marks = {r.known: r["count"] for r in B.chunked(df).groupBy("known").count().collect()}
    assert marks[B._TELLS] < marks[B._KNOWN] / 20
    got = B.parts(df).collect()
    assert len({r.doc_id for r in got}) == 3000
    # a chunk across the line's end may recur in a few documents and stay in the first of them
    assert {r.doc_id for r in got if r.kept and r.chunks > 3} == {0}
