import random

import numpy as np
import pytest
import sentencepiece

from sojourn.llm import pieces as P


@pytest.fixture(scope="module")
def native():
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


def unigram_model(tmp_path):
    """The same pieces and scores read as a unigram vocabulary."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(P.MODEL, "rb").read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    for p in model.pieces:
        p.score = p.score / 1000 if p.score > -1e6 else -40.0
    path = str(tmp_path / "unigram.model")
    open(path, "wb").write(model.SerializeToString())
    return path


def chunked(v, text, size):
    text = v.normal(text)
    n = -(-len(text) // size)
    parts, chain = [], []
    for k in range(n):
        a, z = k * size, min(len(text), (k + 1) * size)
        lo = max(0, a - v.longest)
        parts.append((text[lo: z + v.longest], a - lo, z - lo))
        chain.append(P.transfer(v, *parts[-1], k == n - 1))
    if not n:
        return []
    states = P.between(chain, 0, None)
    total = chain[0]
    for m in chain[1:]:
        total = P.times(total, m)
    assert max(w for (s, _), w in total.items() if s == 0) > P.NONE
    return np.frombuffer(b"".join(P.backtrace(v, *p, s, t) for p, s, t in zip(parts, states, states[1:])), "<i4").tolist()


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b", "e", "th", "in", "er", " ", "  ", "é", "ß", "中", "😀", "\n", "1", "0", "=", "the", "tion", "   ", "xxxxx", "\x00"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    out += ["a" * 300, " " * 200, "ab" * 150, "the" * 100, "0" * 333, "=-" * 99, "中" * 100, "internationalization" * 20, " x" * 80, "x "]
    return out + ["".join(rng.choice("aeinrst") for _ in range(rng.randint(20, 200))) for _ in range(60)]


def test_chunked_ids_are_the_librarys(native):
    v = P.vocabulary(P.MODEL)
    rng = random.Random(1)
    for t in texts(7, 250):
        assert chunked(v, t, rng.choice((16, 17, 20, 33))) == native.encode(t), repr(t)
        assert v.decode(np.array(native.encode(t), np.int64)).decode() == t


def test_unigram_paths_are_viterbi(tmp_path):
    path = unigram_model(tmp_path)
    v, native = P.Vocabulary(path), sentencepiece.SentencePieceProcessor(model_file=path)
    weight = lambda ids: sum(v.scores[i] for i in ids)  # noqa: E731  ties may be cut in another place
    for t in texts(8, 120):
        if all(len(c.encode()) == 1 and c not in "\x00\n" for c in t):
            got = chunked(v, t, 16)
            assert abs(weight(got) - weight(native.encode(t))) < 1e-2 and v.decode(np.array(got)).decode() == t


def test_scan_in_spark_equals_the_library(spark, native, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 3)
    rows = [(i, t, "x") for i, t in enumerate([t for t in texts(9, 30) if "\x00" not in t][:40])] + [(0, "again " * 30, "y"), (None, "none " * 20, "z"), (50, None, "n"), (51, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = sorted((repr(r.doc_id), list(r.ids)) for r in P.encode(docs, size=24).collect())
    assert got == sorted((repr(i), native.encode(t or "")) for i, t, _ in rows)
    back = P.decode(P.encode(docs, size=24))
    assert sorted((repr(r.doc_id), r.text) for r in back.collect()) == sorted((repr(i), t or "") for i, t, _ in rows)
    assert P.encode(docs.limit(0)).count() == 0


def test_query(spark, native):
    import hashlib

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in P.op8_sentencepiece(spark, sf).collect()}
    for r in P.read_table(spark, sf, "documents").collect():
        ids = native.encode(r.text)
        assert got[r.doc_id].round_trip and got[r.doc_id].n_pieces == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
