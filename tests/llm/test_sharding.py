import math
import zlib
from collections import Counter

import xxhash
from data import corpus, docs

from profila.llm import sharding


def test_law_slots_and_digests(spark):
    rows = corpus(7, 300)
    got = sharding.assign(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, of = {}, {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert of.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 16) and r.law == "key" and 0 <= r.shard < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def plain_shard(i, weights):
    """The shard of the smallest draw, each computed by itself."""
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            h = 42 if i is None else xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42)
            u = ((xxhash.xxh64_intdigest(f"shard {shard}".encode(), h) >> 11) + 0.5) / 2 ** 53
            draws.append((-math.log(u) / weight, shard))
    return min(draws)[1]


def test_shards_are_the_smallest_draws(spark):
    rows = [(i, "x", "s") for i in [*range(-300, 900), 2 ** 62 + 5, -2 ** 63, None]]
    for weights in ((1.0,) * 16, (1, 2, 0, 0.5)):
        got = sharding.assign(docs(spark, rows), weights=weights, added=1.5).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.shard, r.grown_shard) == (plain_shard(r.doc_id, weights), plain_shard(r.doc_id, [*weights, 1.5]))


def test_weights_and_moves(spark):
    df = docs(spark, [(i, "x", "s") for i in range(6000)], clash=False)
    got = sharding.assign(df, weights=(1, 2, 0, 1), added=1).collect()
    n = Counter(r.shard for r in got)
    assert n[2] == 0 and abs(n[1] - 3000) < 200 and abs(n[0] - 1500) < 200
    moved = [r for r in got if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {4} and abs(len(moved) - 1200) < 200


def test_many_repeated_rows_and_empty_table(spark):
    df = docs(spark, [(1, "x", "s")], clash=False)
    many = df.crossJoin(spark.range(sharding._CHUNK + 10)).drop("id")
    got = sharding.assign(many)
    assert got.agg({"slot": "max"}).first()[0] == sharding._CHUNK + 9 and got.select("slot").distinct().count() == sharding._CHUNK + 10
    assert sharding.assign(docs(spark, [])).count() == 0


def test_write(spark, tmp_path):
    df = docs(spark, corpus(8, 40))
    sharding.write(df, str(tmp_path / "out"), weights=(1.0,) * 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count() and set(df.columns) < set(back.columns)
