"""Ids and texts against the library, over whole tables, odd texts and drawn ones."""

import hashlib
import pickle
import random

import numpy as np
import pytest

from mensario.llm import pieces, queries
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD

spm = pytest.importorskip("sentencepiece")
PATH = queries.vocabulary_file(queries.PIECES_32K)


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.vocabulary(PATH)


def test_texts_of_any_characters_are_encoded_as_the_library_does(library, model):
    rng, encoder = random.Random(5), pieces.Encoder(model)
    pools = [
        ["a", "b", "c"], list("etaoin "), list("abcdefghijklmnopqrstuvwxyz"), ["▁", " ", "a", "\n", "\t", "\r", ";", "\x00"], [chr(i) for i in range(0x20, 0x3000)],
        model.piece[259:1500], model.piece[259:], ["漢", "字", "あ", " ", "😀", "<s>", "</s>", "<0x41>", "<unk>", " ", "é"],
    ]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(30))) for _ in range(500)]
    for pool in pools:
        texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 120))) for _ in range(300)]
    assert [e.tolist() for e in encoder.encode(texts)] == library.encode(texts)


def test_very_long_words(library, model):
    rng = random.Random(6)
    for text in ("=-" * 50_000, "a" * 100_000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000)), "漢字" * 30_000):
        assert pieces.Encoder(model).encode([text])[0].tolist() == library.encode(text)


def test_occurrences_whose_merging_opens_an_earlier_pair_merge_one_at_a_time(library, model):
    """Words made of the pieces that must not be merged all at once."""
    careful = [model.piece[i] for i in np.flatnonzero(model.careful[: model.size])]
    assert len(careful) > 100
    rng = random.Random(7)
    words = [rng.choice(careful) * rng.randrange(1, 5) + rng.choice(careful) for _ in range(4000)]
    assert [e.tolist() for e in pieces.Encoder(model).encode(words)] == library.encode(words)


def test_any_ids_are_decoded_as_the_library_does(library, model):
    rng = random.Random(8)
    draw = [lambda: rng.randrange(259), lambda: rng.randrange(model.size), lambda: rng.choice([259, 260, 28705, 2, 0]), lambda: 3 + rng.choice([0xC3, 0xA9, 0xE2, 0x96, 0x81, 0xF0, 0x41])]
    ids = [[rng.choice(draw)() for _ in range(rng.randrange(12))] for _ in range(4000)]
    flat = np.array([i for one in ids for i in one], np.int64)
    assert model.decode(flat, np.array(list(map(len, ids)))) == [library.decode(one) for one in ids]


def test_the_store_of_words_is_bounded(library, model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 50)
    encoder, rng = pieces.Encoder(model), random.Random(9)
    for _ in range(30):
        texts = [" ".join(str(rng.randrange(200)) + rng.choice("ab") * rng.randrange(60) for _ in range(20)) for _ in range(3)]
        assert [e.tolist() for e in encoder.encode(texts)] == library.encode(texts)
        assert len(encoder.known) <= 50


def test_the_vocabulary_is_shipped_small(model):
    assert len(pickle.dumps(model)) < 5_000_000


def test_the_query_over_the_whole_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for doc_id, text in texts.items():
        ids = library.encode(text, add_eos=True)
        want[doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    found = queries.op12_pieces(spark, TESTDATA)
    assert found.dtypes[1] == ("n_tokens", "bigint")
    assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == want


def test_odd_rows(spark, odd, docs, library):
    found = pieces.decode(pieces.encode(odd, PATH), PATH).collect()
    want = [(i, library.encode(text or "", add_eos=True)) for i, text in ODD]
    assert sorted(((r.doc_id, r.ids) for r in found), key=str) == sorted(want, key=str)
    assert all(r.text == library.decode(r.ids) for r in found)
    assert pieces.decode(pieces.encode(docs([(1, "x")]).limit(0), PATH), PATH).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in pieces.decode(nothing, PATH).collect()] == ["", ""]


def test_models_of_another_kind_are_refused(tmp_path):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    said = proto.ModelProto.FromString(open(PATH, "rb").read())
    said.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(said.SerializeToString())
    with pytest.raises(ValueError, match="no normalisation"):
        pieces.vocabulary(str(tmp_path / "other.model"))
