"""Operator 7 — benchmark decontamination by CGK embeddings and bit-sampling LSH.

An item leaks into a document if some passage of it is within ``k`` word edits
of the item, k = 20 % of the item's words (similarity 0.8); words are
lower-cased runs of letters, digits and underscores.

* The CGK random walk embeds a word sequence so that edit distance turns into
  Hamming distance: at step j the walk writes the word it stands on and moves
  on or stays by a random bit of (j, word).
* Item-sized windows of the texts and the items are embedded by the same walks;
  a table samples some steps of a walk and puts windows with equal samples
  together.  Every length of item gets walks of its own number, added until
  ``TRIALS`` (200) copies at least, edited at random by the full k, reach
  ``recall`` (0.99).  Where ``MAX_WALKS`` (24) walks fall short of it, the windows
  of that length are verified without sampling, for every item that the condition
  below leaves.
* Before the walk a necessary condition drops windows that cannot reach the
  distance: by the q-gram lemma, k edits leave at least L − 2 − 3k of an item's
  L − 2 word triples, so a window with fewer triples of items of that length is
  no window.  It loses no match.
* Candidates are verified by the exact edit distance of the item to any
  passage of the window's surroundings.

Texts are searched whole, where they are read; nothing of them is shuffled.
Items go to the tasks in blocks of ``block_items``, so what is sent is bounded
whatever the benchmark's size; more items mean more passes.  Items of fewer
than six words must occur exactly, items of fewer than three words, null and
empty items take no part.  Null and empty texts hold no leak.  Repeated
documents each give their rows, repeated items too; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import prepare, read

SIMILARITY = 0.8
RECALL = 0.99
BLOCK_ITEMS = 10_000
TRIALS = 200
TABLES_A_WALK = 8
SAMPLED = 3
MAX_WALKS = 24
_TOKEN = re.compile(r"\w+")
_KIND = "array<struct<item_id:long,edits:int,start:int,end:int>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def budget(length: int, similarity: float = SIMILARITY) -> int:
    """Edits an item of so many words may have."""
    return int(length * (1 - similarity) + 1e-9) if length >= 6 else 0


def closest(item: list, text: list) -> tuple[int, int, int]:
    """(edits, start, end) of the passage of ``text`` nearest to ``item``;
    the first end, then the first start, of equally near ones."""
    n = len(item)
    cost, came = list(range(n + 1)), [0] * (n + 1)
    best = (n, 0, 0)
    for j, word in enumerate(text, 1):
        last_cost, last_came, cost[0], came[0] = 0, j - 1, 0, j
        for i in range(1, n + 1):
            over, over_came = cost[i], came[i]
            c, s = last_cost + (item[i - 1] != word), last_came
            if over + 1 < c:
                c, s = over + 1, over_came
            if cost[i - 1] + 1 < c:
                c, s = cost[i - 1] + 1, came[i - 1]
            cost[i], came[i] = c, s
            last_cost, last_came = over, over_came
        if cost[n] < best[0]:
            best = (cost[n], came[n], j)
    return best


class Index:
    """The embedded items of one block."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, recall: float = RECALL, seed: int = 7):
        self.number: dict[str, int] = {}
        self.ids, self.words, self.coded = [], [], []
        for item_id, text in items:
            words = tokens(text)
            if len(words) >= 3:
                self.ids.append(item_id)
                self.words.append(words)
                self.coded.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in words]))
        self.similarity = similarity
        self.by_length: dict[int, list[int]] = {}
        for k, w in enumerate(self.words):
            self.by_length.setdefault(len(w), []).append(k)
        self._triples()
        rng = np.random.default_rng(seed)
        self.walks: list = []
        self.tables: dict[int, list] = {n: [] for n in self.by_length}
        copies = {n: -(-TRIALS // len(of)) for n, of in self.by_length.items()}
        edited = {n: np.stack([self._edit(self.coded[k], n, f"{seed} {k} {c}") for c in range(copies[n]) for k in of])
                  for n, of in self.by_length.items()}
        found = {n: np.zeros(len(e), bool) for n, e in edited.items()}
        short = set(self.by_length)  # lengths still below the target
        while short and len(self.walks) < MAX_WALKS:
            self._add_walk(rng, short)
            for n in list(short):
                for keys, own in zip(self._keys(edited[n], len(self.walks) - 1), self.tables[n][-TABLES_A_WALK:]):
                    found[n] |= np.tile(own[2], copies[n]) == keys
                if found[n].mean() >= recall:
                    short.discard(n)
        #: lengths whose windows are verified without sampling, by the triples of their items
        self.exact = {n: {k: np.unique(self._code(w[:-2], w[1:-1], w[2:])) for k in self.by_length[n] for w in [self.coded[k]]}
                      for n in short}
        self.tables = {n: [t[:2] for t in tables] for n, tables in self.tables.items()}  # as sent to the tasks

    def _edit(self, item: np.ndarray, n: int, seed: str) -> np.ndarray:
        """The item's window after its whole budget of random edits."""
        rng, out = random.Random(seed), list(item)
        for _ in range(budget(n, self.similarity)):
            at, how = rng.randrange(len(out)), rng.randrange(3)
            out[at:at + (how != 0)] = [0] if how < 2 else []
        return np.array((out + [-1] * n)[:n])

    def _triples(self) -> None:
        grams, lengths = [], []
        for w in self.coded:
            code = self._code(w[:-2], w[1:-1], w[2:])
            grams.append(code)
            lengths.append(np.full(len(code), len(w)))
        both = np.unique(np.stack([np.concatenate(grams), np.concatenate(lengths)]), axis=1) if grams else np.empty((2, 0), int)
        self.grams, self.first = np.unique(both[0], return_index=True)
        self.lengths = both[1]
        self.first = np.append(self.first, both.shape[1])

    def _code(self, a, b, c):
        base = len(self.number) + 1
        return (a * base + b) * base + c if base < 2_000_000 else hash_mix(a, b, c)

    def _add_walk(self, rng, lengths) -> None:
        longest = max(self.by_length)
        odd = rng.integers(0, 1 << 63, 2 * longest, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        spots = rng.random((TABLES_A_WALK, SAMPLED))
        mix = rng.integers(0, 1 << 63, SAMPLED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.walks.append((odd, spots, mix))
        for n in lengths:
            of = self.by_length[n]
            for keys in self._keys(np.stack([self.coded[k] for k in of]), len(self.walks) - 1):
                order = np.argsort(keys, kind="stable")
                self.tables[n].append((keys[order], np.array(of)[order], keys))

    def _keys(self, windows: np.ndarray, walk: int):
        """Sampled steps of one walk over windows of one length, per table."""
        odd, spots, mix = self.walks[walk]
        count, n = windows.shape
        padded = np.concatenate([windows, np.full((count, 1), -1)], axis=1)
        at, row, steps = np.zeros(count, np.int64), np.arange(count), []
        for j in range(2 * n):
            word = padded[row, at]
            steps.append(word)
            bit = ((word + 2).astype(np.uint64) * odd[j] ^ (odd[j] >> np.uint64(7))) * odd[j] >> np.uint64(63)
            at = np.minimum(at + bit.astype(np.int64), n)
        for spot in spots:
            key = np.zeros(count, np.uint64)
            for s, m in zip(spot, mix):
                key = (key ^ (steps[int(s * 2 * n)] + 2).astype(np.uint64)) * m
                key ^= key >> np.uint64(29)
            yield key

    def windows(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(length, starts) of the windows with enough triples of items of
        that length in a sequence of word numbers (0: no item's word)."""
        if len(ids) < 3 or not len(self.grams):
            return
        full = np.flatnonzero((ids[:-2] > 0) & (ids[1:-1] > 0) & (ids[2:] > 0))
        code = self._code(ids[full], ids[full + 1], ids[full + 2])
        gram = np.minimum(np.searchsorted(self.grams, code), len(self.grams) - 1)
        hit = self.grams[gram] == code
        full, gram = full[hit], gram[hit]
        many = self.first[gram + 1] - self.first[gram]
        spot = np.repeat(full, many)
        which = np.arange(len(spot)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[gram], many)
        length = self.lengths[which]
        for n in np.unique(length):
            p, k = spot[length == n], budget(int(n), self.similarity)
            need = max(1, int(n) - 2 - 3 * k)
            if len(p) < need:
                continue
            low, high = p[need - 1:] + 3 - (n + k), p[:len(p) - need + 1]
            ok = low <= high
            low, high = np.maximum(low[ok], 0), high[ok]
            if not len(low):
                continue
            mark = np.zeros(len(ids) + 1, np.int64)
            np.add.at(mark, low, 1)
            np.add.at(mark, high + 1, -1)
            yield int(n), np.flatnonzero(np.cumsum(mark)[:-1] > 0)

    def candidates(self, ids: np.ndarray) -> set[tuple[int, int]]:
        """(item, start) of windows that share a sample with the item, or hold
        enough of its triples where samples fall short."""
        found = set()
        for n, starts in self.windows(ids):
            if n in self.exact:
                found.update(self._every(ids, n, starts))
                continue
            padded = np.concatenate([ids, np.full(n, -1)])
            for part in np.array_split(starts, len(starts) // 50_000 + 1):
                view = padded[part[:, None] + np.arange(n)]
                for walk in range(len(self.tables[n]) // TABLES_A_WALK):
                    for t, keys in enumerate(self._keys(view, walk)):
                        known, of = self.tables[n][walk * TABLES_A_WALK + t]
                        left, right = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
                        for w in np.flatnonzero(right > left):
                            found.update((int(k), int(part[w])) for k in of[left[w]:right[w]])
        return found

    def _every(self, ids: np.ndarray, n: int, starts: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, start) of the windows with enough triples of the item itself."""
        k = budget(n, self.similarity)
        need = max(1, n - 2 - 3 * k)
        for own in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            a, b = int(own[0]), min(int(own[-1]) + n + k, len(ids))
            part = ids[a:b]
            if len(part) < 3:
                continue
            code = np.where((part[:-2] > 0) & (part[1:-1] > 0) & (part[2:] > 0), self._code(part[:-2], part[1:-1], part[2:]), -1)
            for item, grams in self.exact[n].items():
                if np.isin(code, grams).sum() >= need:
                    yield from ((item, int(s)) for s in own)

    def verify(self, words: list[str], found) -> dict[int, tuple[int, int, int]]:
        """item → (edits, first word, end word) of its nearest passage, for
        items within their budget."""
        out: dict[int, tuple[int, int, int]] = {}
        runs: list[list[int]] = []
        for k, s in sorted(found):
            n = len(self.words[k])
            if runs and runs[-1][0] == k and s <= runs[-1][2] + n:
                runs[-1][2] = s
            else:
                runs.append([k, s, s])
        for k, a, b in runs:
            item = self.words[k]
            most = budget(len(item), self.similarity)
            a = max(0, a - most)
            edits, start, end = closest(item, words[a:b + len(item) + most])
            if edits <= most and (k not in out or edits < out[k][0]):
                out[k] = (edits, a + start, a + end)
        return out

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """Leaks of each text of a batch."""
        get, gap = self.number.get, max(self.by_length, default=0) * 2 + 3
        words = [tokens(t) for t in texts]
        flat, starts = [], []
        for w in words:
            starts.append(len(flat))
            flat.extend([get(x, 0) for x in w])
            flat.extend([0] * gap)
        ids, begin = np.array(flat, np.int64), np.array(starts)
        mine: dict[int, list] = {}
        for k, s in self.candidates(ids):
            d = int(np.searchsorted(begin, s, "right")) - 1
            mine.setdefault(d, []).append((k, s - starts[d]))
        out: list[list[dict]] = [[] for _ in texts]
        for d, found in mine.items():
            leaks = self.verify(words[d], found)
            if leaks:
                at = [m.span() for m in _TOKEN.finditer(texts[d].lower())]
                out[d] = [{"item_id": self.ids[k], "edits": e, "start": at[a][0], "end": at[b - 1][1]}
                          for k, (e, a, b) in sorted(leaks.items())]
        return out


def hash_mix(a, b, c):
    """One number for three word numbers of a very large block."""
    x = np.asarray(a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.asarray(b).astype(np.uint64)
    x = x * np.uint64(0xBF58476D1CE4E5B9) ^ np.asarray(c).astype(np.uint64)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def leaks(text: Column, index: Index) -> Column:
    """array of (item_id, edits, start, end) of a text column; code points."""
    @arrow_udf(_KIND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(index.search(batch.to_pylist()), _ARROW)
    return run(text)


def indexes(benchmark: DataFrame, block_items: int = BLOCK_ITEMS, **how) -> Iterator[Index]:
    """The benchmark (item_id, text) as indexes of about block_items items."""
    n = max(1, -(-benchmark.count() // block_items))
    for b in range(n):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield Index([(r[0], r[1]) for r in part.select("item_id", "text").orderBy("item_id", "text").collect()], **how)


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row for each document and item that leaks into it: doc_id,
    item_id, edits, start, end (code points, end exclusive)."""
    prepare(docs.sparkSession)
    out = None
    for index in indexes(benchmark, **how):
        rows = (docs.select("doc_id", F.explode(leaks(F.col("text"), index)).alias("leak"))
                .select("doc_id", "leak.item_id", "leak.edits", "leak.start", "leak.end"))
        out = rows if out is None else out.unionAll(rows)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents into which no item leaks, columns as they are."""
    prepare(docs.sparkSession)
    for index in indexes(benchmark, **how):
        docs = docs.where(F.size(leaks(F.col("text"), index)) == 0)
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
