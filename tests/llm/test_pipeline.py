import random

import corpus_pipeline as P
from data import corpus

from profila.llm import decontaminate, mixing, simhash, toxicity
from profila.llm.common import read


def folder(spark, path):
    rng = random.Random(3)
    rows = corpus(12, 80)
    rows += [(200 + i, "you vile person " + " ".join(f"w{rng.randrange(90)}" for _ in range(20)) + ".", "src0") for i in range(40)]
    item = "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 q12"
    rows += [(300 + i, f"w{i} n{i} m{i} " * (i + 2) + item, "src1") for i in range(6)]
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, int(200 <= i < 300)) for i, _, _ in rows if i is not None and i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_against_their_operators(spark, tmp_path):
    sf = folder(spark, tmp_path)
    docs = read(spark, sf, "documents")
    columns, stage = docs.columns, dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]

    clean = stage["toxicity"](spark, docs, sf)
    assert clean.columns == columns
    left = {r.doc_id for r in clean.collect()}
    assert not left & set(range(200, 240)) and {i for i in range(80)} <= left and clean.count() == docs.count() - 40

    once = stage["simhash_near_dedup"](spark, clean, sf)
    assert once.columns == columns
    fps = [simhash.simhash((r.text or "").encode()) for r in clean.collect()]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    assert once.count() == len({find(i) for i in range(len(fps))})

    without = stage["benchmark_decontamination"](spark, once, sf)
    assert without.columns == columns
    assert {r.doc_id for r in without.collect()} == {r.doc_id for r in once.collect()} - set(range(300, 306))

    mix = stage["mixing"](spark, without, sf)
    assert mix.columns == columns
    want = {r.doc_id: r.copies for r in mixing.mix(without).collect()}
    got = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in want.items() if n}

    shards = stage["sharding"](spark, mix, sf).collect()
    assert len(shards) == mix.count()
    assert sorted(map(str, shards)) == sorted(map(str, P.run(spark, sf).collect()))


def test_empty_tables(spark, tmp_path):
    for name, kind in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                       ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_operators_used():
    assert toxicity.THRESHOLD == 0.7 and simhash.MAX_BITS == 4 and decontaminate.SIMILARITY == 0.8
