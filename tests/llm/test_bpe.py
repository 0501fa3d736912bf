import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helioframe.llm import bpe, packing

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = st.lists(st.sampled_from([*"abAZ'sd09.,! \n\té日😀ß\x1c\x85²", "  ", "<|endoftext|>", "'ll", " the", "\r\n", "tion"]), max_size=30).map("".join)


@pytest.fixture(scope="module")
def both():
    return bpe.ByteLevelTokenizer(BYTE), Tokenizer.from_file(BYTE)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=40), PIECES, st.text("ab", max_size=200)))
def test_same_ids_and_text_as_the_library(both, text):
    own, library = both
    want = library.encode(text, add_special_tokens=False).ids
    got = own.encode(text)
    assert got.tolist() == want
    assert own.decode(got) == library.decode(want, skip_special_tokens=False).encode()


def test_long_runs_are_linear_and_exact(both):
    own, library = both
    for text in ("a" * 200_000, " " * 50_000 + "x", "ab" * 50_000, "=" * 30_000):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=40), PIECES))
def test_word_vocabulary(text):
    own = packing.encoder(WORD)
    want = own.tokenizer.encode(text, add_special_tokens=False).ids
    raw = own.encode(text)
    assert [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)] == want


def test_old_words_survive_a_full_generation():
    made = []
    words = bpe.WordIds(lambda w: made.append(w) or w.encode(), 4, longest=3)
    for w in ("a", "b", "c", "a", "long"):
        assert words[w] == w.encode()
    assert made == ["a", "b", "c", "long"] and "long" not in words


def test_table(spark, both):
    rows = [(1, "Hello world", "x"), (2, None, "y"), (3, "", None), (1, "Hello world", "x"), (None, "<|endoftext|> a  b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encoded(docs, BYTE).collect()
    assert len(out) == 5
    for r in out:
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    by = {r["doc_id"]: r for r in out}
    assert by[2]["n_tokens"] == by[3]["n_tokens"] == 0
    assert by[None]["decoded_sha256"] == hashlib.sha256(b"<|endoftext|> a  b").hexdigest()
    assert bpe.encoded(docs.limit(0), BYTE).count() == 0
