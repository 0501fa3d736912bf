import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helioframe.llm import suffix_dedup as sd
from helioframe.llm.suffix_array import suffix_array


@settings(max_examples=500, deadline=None)
@given(symbols=st.one_of(*[st.lists(st.integers(0, n), max_size=60) for n in (0, 1, 3, 100)]))
def test_suffix_array(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@settings(max_examples=200, deadline=None)
@given(seed=st.integers(0, 10**6), length=st.sampled_from([3, 20, 70]))
def test_repeated_windows(seed, length):
    rng = random.Random(seed)
    letters = rng.choice([b"ab ", b"abcdefg .\n", b"xyzq"])
    base = [bytes(rng.choices(letters, k=rng.randint(0, 120))) for _ in range(3)]
    parts = [rng.choice(base) + rng.choice(base)[rng.randint(0, 40):] for _ in range(rng.randint(1, 5))]
    seen = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
    for part, got in zip(parts, sd.repeated_windows(parts, length), strict=True):
        assert got.tolist() == [seen[part[i:i + length]] > 1 for i in range(len(part) - length + 1)]


def expected(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        yield len(t), int(gone.sum()), len(sd.runs_of(gone)[0]), hashlib.sha256(kept).hexdigest()


def fixture_texts():
    rng = random.Random(11)

    def words(n):
        return " ".join("".join(rng.choices("abcdeéß", k=rng.randint(1, 9))) for _ in range(n))

    passage, line = words(70), words(40) + "\n"
    texts = [None, "", "short", "a" * 199, "a" * 200, "ab" * 400, "b" * 700, line * 9, "日本語" * 150]
    texts += [words(rng.randint(5, 200)) + " " + passage + " " + words(rng.randint(5, 100)) for _ in range(25)]
    texts += [line + words(60) for _ in range(10)]
    copy = words(150)
    texts += [copy] * 6 + [copy[:400] + "#" + copy[400:]] + [words(120) for _ in range(10)]
    texts.append("".join(rng.choices("xyz", k=3000)))
    return texts


@pytest.mark.parametrize("kinds", [sd.MOST_KINDS, 3])
def test_repeated_spans(spark, monkeypatch, kinds):
    monkeypatch.setattr(sd, "MOST_KINDS", kinds)  # 3: windows of common minimizers are counted by hash
    texts = fixture_texts()
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, start int, ref string")
    out = {r["doc_id"]: tuple(r)[1:] for r in sd.repeated_spans(docs).collect()}
    assert [out[i] for i in range(len(texts))] == list(expected(texts, sd.LENGTH))


def test_without_repeats(spark):
    texts = fixture_texts()
    docs = spark.createDataFrame([(i, t, 0, "x", "y", "z") for i, t in enumerate(texts)],
                                 "doc_id long, text string, start int, ref string, key string, kept string")
    out = sd.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert {tuple(r)[2:] for r in rows} == {(0, "x", "y", "z")}  # columns of such names are left alone
    by = {r["doc_id"]: r["text"] for r in rows}
    assert by[0] is None and by[2] == "short" and by[4] == texts[4] and by[7] == ""
    assert sd.repeated_spans(docs.limit(0)).count() == 0


def test_nulls_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "z" * 100 + "y" * 150)] * 2 + [(None, None)], "doc_id long, text string")
    assert sorted((r["n_bytes"], r["n_removed"]) for r in sd.repeated_spans(docs).collect()) == [(0, 0), (250, 250), (250, 250)]


def test_very_long_texts(spark):
    rng = random.Random(5)
    word = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(20_000)]
    long = " ".join(rng.choices(word, k=60_000))  # 420,000 bytes
    texts = [long, long[200_000:200_700] + "!", " ".join(rng.choices(word, k=200))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: tuple(r)[1:4] for r in sd.repeated_spans(docs).collect()}
    assert out == {0: (len(long), 700, 1), 1: (701, 700, 1), 2: (len(texts[2]), 0, 0)}
