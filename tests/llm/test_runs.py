"""Operator 11 against brute force over all starts and periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from profila.llm import runs as R
from tests.llm.data import corpus, docs


def brute(w, least=12):
    """Longest stretches for every period; smallest periods alone."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                s = w[i:i + length]
                if not any(s[:-p] == s[p:] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1 if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("block", [2, 1024])
def test_runs_equal_brute_force(block, monkeypatch):
    monkeypatch.setattr(R.Places, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        n, k = rng.randrange(0, 70), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(k) for _ in range(n)]
        if n > 5 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        for least in (2, 7, 12):
            got = [tuple(r) for r in R.runs_of(np.array(w, np.int64), least).tolist()]
            assert got == brute(w, least)


def test_filter_loses_no_text():
    rng = random.Random(5)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(0, 40))] for _ in range(300)]
    flat = np.array([x for t in texts for x in t], np.int64)
    hit = R.repeating(flat, np.cumsum([len(t) for t in texts]), 6)
    assert [bool(h) for h in hit] == [
        any(t[i:i + 6] == t[j:j + 6] for j in range(len(t) - 5) for i in range(j)) for t in texts]


def test_long_periodic_texts():
    n = 100_000
    assert R.runs_of(np.zeros(n, np.int64)).tolist() == [[0, n, 1]]
    assert R.runs_of(np.arange(n) % 777).tolist() == [[0, n, 777]]


def test_operator_over_odd_rows(spark):
    rows = corpus(3, 20)
    rows += [(900, "a b c " * 40, "s"), (901, "x\ty\nx y\x0bx y x y x y x y", None), (902, "é é " * 30, "s"), (902, "é é " * 30, "s")]
    out = R.periodic_runs(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    want = []
    for i, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute(w) if len(w) < 1000 else []
        want.append((i, len(w), runs, collapsed(w, runs)))
    got = [(r.doc_id, r.n_words, list(zip(r.starts, r.lengths, r.periods)), r.collapsed) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_digests(spark, tmp_path):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(corpus(8, 30)) if len(t or "") < 5000]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in R.query(spark, str(tmp_path)).collect()}
    changed = 0
    for i, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
            changed += 1
        runs = brute(w)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[i]
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (top or (None,) * 3)
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert changed


def test_empty_table(spark):
    assert R.periodic_runs(docs(spark, [])).count() == 0
