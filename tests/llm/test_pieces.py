"""Operator 12 against the library: ids, decoded texts and spans."""

import hashlib
import random

import pytest
import sentencepiece as S
from sentencepiece import sentencepiece_model_pb2 as proto

from profila.llm import pieces as P
from tests.llm.data import corpus, docs

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = "aé①ﬁ Ａ　́̀e\tｶﾞ가각¨x▁​\U0001F9FF½㌀"


def model():
    with open(public_tokenizers.path(P.MODEL), "rb") as f:
        return f.read()


def odd_texts(n=600):
    rng = random.Random(1)
    return ["", " ", "  ", "a ", "  a  b  ", "▁x ▁▁", *("".join(rng.choice(ODD) for _ in range(rng.randrange(30))) for _ in range(n))]


def variants():
    """The model as it is, with a compiled map and each white space rule, and
    without byte pieces but with a user-defined one."""
    yield model()
    rules = proto.ModelProto()
    rules.ParseFromString(S.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    for dummy, collapse, suffix in ((True, True, False), (True, False, False), (False, True, False), (True, True, True)):
        m = proto.ModelProto()
        m.ParseFromString(model())
        m.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
        m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = dummy, collapse
        m.trainer_spec.treat_whitespace_as_suffix = suffix
        yield m.SerializeToString()
    m = proto.ModelProto()
    m.ParseFromString(model())
    m.trainer_spec.byte_fallback = False
    for p in m.pieces:
        p.type = 1 if p.type == 6 else p.type
    m.pieces[300].type = 4
    yield m.SerializeToString()


def test_ids_and_spans_equal_the_library():
    for blob in variants():
        codec, library = P.Codec(blob), S.SentencePieceProcessor(model_proto=blob)
        texts = odd_texts()
        ids, begins, ends = codec.encode([t.encode() for t in texts])
        for i, t in enumerate(texts):
            want = library.encode(t, return_type="proto").pieces
            assert ids[i].tolist() == [p.id for p in want]
            for p, b, e in zip(want, begins[i], ends[i]):
                if p.piece.startswith("<0x"):  # a byte of its own here, the last of its character there
                    assert e - b == 1 and (p.begin == p.end or e == p.end) or codec.map
                else:
                    assert (p.begin, p.end) == (b, e)


def test_spans_cover_the_text():
    codec = P.Codec(model())
    texts = [t.encode() for t in odd_texts()]
    for text, begins, ends in zip(texts, *codec.encode(texts)[1:]):
        if text:
            assert begins[0] == 0 and ends[-1] == len(text) and (begins[1:] == ends[:-1]).all()


def test_longest_prefix_wins():
    spec = proto.ModelProto()
    spec.ParseFromString(S.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    table = P.CharacterMap(spec.normalizer_spec.precompiled_charsmap)
    assert table.longest("ｶﾞx".encode(), 0) == (6, "ガ".encode())
    assert table.longest("ｶx".encode(), 0) == (3, "カ".encode())
    assert table.longest(b"ab", 0) is None


def test_round_trip_over_odd_rows(spark):
    rows = corpus(4, 20) + [(800 + i, t, None) for i, t in enumerate(odd_texts(100))]
    library = S.SentencePieceProcessor(model_proto=model())
    got = P.decode(P.encode(docs(spark, rows), keep=("doc_id", "key"))).collect()
    want = [(i, "key", library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _ in rows]
    assert sorted([(r.doc_id, r.key, r.ids, r.decoded) for r in got], key=repr) == sorted(want, key=repr)
    assert P.decode(P.encode(docs(spark, []))).count() == 0


def test_query(spark, tmp_path):
    rows = corpus(6, 10)
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    library = S.SentencePieceProcessor(model_proto=model())
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = [tuple(r)[:4] for r in P.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
