"""Encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from marketloom.llm import piecebpe
from tests.llm.test_ops import awkward, documents, nothing

PATH = f"{piecebpe.TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piecebpe.load_model(PATH)


def test_encode_of_random_texts(library, model):
    """Few symbols, so that pairs overlap and tie; runs of blanks, foreign characters, bytes, NUL."""
    rng, symbols = random.Random(3), ["a", "b", "ab", "e", "th", " ", "  ", "▁", "\n", "é", "́", "中", "国", "🙂", "x", "0", "=", "-", "\0", "ſ", "　", "的", "er", "in", "</s>", "<0x41>"]
    texts = []
    for n in range(3000):
        some = rng.sample(symbols, rng.choice([1, 2, 3, 8]))
        texts.append("".join(rng.choice(some) for _ in range(rng.choice([1, 3, 10, 40, 200]))))
    together = piecebpe.Encoder(model).encode_all(texts)
    for text, ids in zip(texts, together):
        assert ids.tolist() == library.encode(text), text
        assert piecebpe.decode(model, ids) == library.decode(ids.tolist()), text


def test_encode_of_long_words(library, model):
    rng = random.Random(5)
    for text in (" " * 5000, "a" * 30_001, "-=" * 9000, "".join(rng.choice("abcdefghijklmnop0123456789+/") for _ in range(20_000)), "中国的" * 5000):
        assert piecebpe.Encoder(model).encode(text).tolist() == library.encode(text)


def test_merges_of_a_round_one_by_one(model):
    """A pair that a merge makes, of equal or better rank than the merge, goes before the next merge of the round: here (ab, a) before the second (a, b)."""
    a, b, ab, aba = (0, 1, 2, 3)
    of_char = np.arange(0x110000, dtype=np.int64) + piecebpe.FOREIGN
    of_char[[97, 98]] = a, b
    pairs = np.array([a << piecebpe.SHIFT | b, ab << piecebpe.SHIFT | a])
    small = piecebpe.PieceModel(of_char, pairs, np.array([ab, aba]), np.array([5, 1]), model.byte_id, model.surface, model.begins, model.sizes, model.kind, 2)
    for text, wanted in (("abab", [aba, b]), ("ababab", [aba, b, ab]), ("abb", [ab, b]), ("abababa", [aba, b, aba])):
        assert piecebpe.Encoder(small).merged([text])[0].tolist() == wanted, text


def test_words_are_kept_for_a_while_only(library, model, monkeypatch):
    monkeypatch.setattr(piecebpe, "STEP", 7)
    monkeypatch.setattr(piecebpe, "KEPT_WORDS", 20)
    encoder, rng = piecebpe.Encoder(model), random.Random(1)
    for _ in range(40):
        texts = [" ".join(str(rng.randrange(99)) for _ in range(rng.randrange(30))) for _ in range(4)]
        assert [x.tolist() for x in encoder.encode_all(texts)] == [library.encode(t) for t in texts]
        assert len(encoder.kept) <= 20 + 7 + 1


def test_decode_of_any_ids(library, model):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32_000), rng.randrange(1, 3), 0, 28_705]) for _ in range(rng.randrange(9))]
        assert piecebpe.decode(model, np.array(ids, np.int64)) == library.decode(ids), ids


def test_coding_report(spark, library, model):
    docs = documents(spark)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = piecebpe.coding_report(docs, model).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_coding_awkward(spark, library, model):
    rows = awkward(spark).withColumnRenamed("fp", "ids").withColumnRenamed("score", "_text")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256) for r in piecebpe.coding_report(rows, model).collect())
    want = []
    for r in rows.collect():
        ids = library.encode(r.text or "", add_eos=True)
        want.append((str(r.doc_id), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert got == sorted(want)
    assert piecebpe.coding_report(nothing(spark), model).count() == 0
    assert piecebpe.encode_texts(rows, model, add_end=False).filter("doc_id = 1").first().ids == []
    assert piecebpe.decode_ids(spark.createDataFrame([(1, None, "t")], "doc_id long, ids array<int>, text string"), model).first().text == ""
