import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from helioframe.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = st.lists(st.sampled_from([*"abAZ'sd09.,! \n\té日😀ß\x1c\x85²\x00", " ", "  ", "    ", "▁", "<s>", "</s>", "<unk>", "<0x0A>", " the", "\r\n", "tion"]), max_size=30).map("".join)


@pytest.fixture(scope="module")
def both():
    return sp.PieceTokenizer(PATH), SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(max_size=40), PIECES, st.text("ab ", max_size=200), st.text(" ", max_size=60)))
def test_same_ids_and_text_as_the_library(both, text):
    own, library = both
    want = library.encode(text)
    got = own.encode(text)
    assert got.tolist() == want
    assert own.decode(got) == library.decode(want).encode()


@settings(max_examples=400, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(0, 31_999), st.sampled_from([259, 28705])), max_size=12))
def test_any_ids_decode_as_by_the_library(both, ids):
    own, library = both
    assert own.decode(np.array(ids, np.int64)) == library.decode(ids).encode()


@settings(max_examples=100, deadline=None)
@given(text=PIECES)
def test_words_change_nothing(both, text):
    own, _ = both
    whole = own.agenda(sp.SPACE + text.replace(" ", sp.SPACE)) if text else b""
    assert own.encode(text).tobytes() == whole


def test_a_wrong_unit_is_noticed():
    own = sp.PieceTokenizer(PATH)
    own.encode("one two")
    own.fresh["two"] = b"1234"
    own.compare()
    assert own.wrong == {"two"} and not own.fresh
    assert own.agrees("one") and not own.agrees("one two")


def test_long_runs(both):
    own, library = both
    for text in ("a" * 200_000, " " * 30_000 + "x", "ab" * 50_000, "=" * 30_000, "日" * 30_000, "the quick " * 20_000):
        assert own.encode(text).tolist() == library.encode(text)


def test_table(spark, both):
    _, library = both
    rows = [(1, "Hello  world\n", "x"), (2, None, "y"), (3, "", None), (1, "Hello  world\n", "x"), (None, " <s> a▁b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sp.encoded(docs, PATH).collect()
    assert len(out) == 5 and all(r["agrees"] for r in out)
    for r in out:
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    by = {r["doc_id"]: r for r in out}
    assert by[2]["n_tokens"] == by[3]["n_tokens"] == 0 and by[1]["ids"] == library.encode("Hello  world\n")
    assert by[None]["decoded_sha256"] == hashlib.sha256(library.decode(library.encode(" <s> a▁b")).encode()).hexdigest()
    assert sp.encoded(docs.limit(0), PATH).count() == 0
    assert {r["agrees"] for r in sp.encoded(docs, PATH, ids=False, check=False).collect()} == {None}
