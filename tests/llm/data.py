"""Small tables for the operators' tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: columns that operators use as names of their own
CLASH = ["fp", "root", "mark", "key", "size", "shard", "line", "tile", "score", "target", "n", "i", "m", "s", "copies", "keep_id", "mix_source"]


def docs(spark, rows, clash=True):
    """rows of (doc_id, text, source) as a documents table, with clashing columns."""
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    df = spark.createDataFrame(full, DOCS)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *(F.lit(k).alias(k) for k in CLASH))
    return df


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def corpus(seed=1, n=60):
    """Random texts with exact copies, near copies, shared lines, null and
    empty texts, null and repeated ids."""
    rng, out = random.Random(seed), []
    for i in range(n):
        text = "\n".join(" ".join(words(rng, rng.randrange(5, 60))) for _ in range(rng.randrange(1, 6)))
        out.append((i, text, f"src{rng.randrange(5)}"))
    for i in range(n, n + 15):
        out.append((i, out[i % 7][1], "src0"))
    for i in range(n + 15, n + 30):
        w = out[i % 9][1].split(" ")
        w[rng.randrange(len(w))] = "edited"
        out.append((i, " ".join(w), None))
    long = " ".join(words(rng, 30_000, 5_000))
    out += [(n + 30, None, "src1"), (n + 31, "", None), (n + 32, " \t\n ", "src2"), (n + 33, "one", "src3"), (n + 34, long, "src4"),
            (None, out[3][1], "src0"), (None, None, None), (5, out[5][1], out[5][2]), (5, out[5][1], out[5][2])]
    return out
