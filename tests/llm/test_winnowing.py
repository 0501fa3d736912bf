import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from helioframe.llm import winnowing as w


@settings(max_examples=200, deadline=None)
@given(text=st.text(st.sampled_from("abñ😀 "), max_size=120), k=st.integers(1, 9), window=st.integers(1, 12))
def test_winnow_equals_its_definition(text, k, window):
    hashes, positions = w.winnow(w.code_points(text), k, window)
    if not text:
        assert not len(hashes)
        return
    k = min(k, len(text))
    grams = w.gram_hashes(w.code_points(text), k).tolist()
    assert all((grams[i] == grams[j]) == (text[i:i + k] == text[j:j + k]) for i in range(len(grams)) for j in range(len(grams)))
    window = min(window, len(grams))
    want = set()
    for i in range(len(grams) - window + 1):
        part = grams[i:i + window]
        want.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    assert positions.tolist() == sorted(want) and hashes.tolist() == [grams[p] for p in sorted(want)]


def test_blocks_and_shared_passages():
    rng = random.Random(1)
    text = "".join(rng.choices("abcdef", k=100_000)) + "a" * 70_000
    hashes, positions = w.winnow(w.code_points(text))
    assert (np.diff(positions) > 0).all() and np.diff(positions).max() <= w.WINDOW
    passage = "".join(rng.choices("uvwxyz", k=w.K + w.WINDOW - 1))
    one, other = (set(w.winnow(w.code_points(x + passage + y))[0].tolist()) for x, y in (("q" * 50, "r" * 90), ("s" * 77, "")))
    assert one & other


def test_edited_and_next(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("abcdefgh ", k=rng.choice([0, 1, 5, 300, 3000])))) for i in rng.sample(range(10_000), 300)]
    rows += [(10_001, None), (10_002, "x")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, range int")
    out = {r["doc_id"]: r for r in w.edited_likeness(docs).collect()}
    rows.sort()
    assert sorted(out) == [i for i, _ in rows]
    for (i, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        text, after = text or "", after or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        r = out[i]
        marks = [w.winnow(w.code_points(t)) for t in (text, edited, after)]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == w.written(*marks[0]) and r["edited_fingerprint"] == w.written(*marks[1])
        assert r["near_edited"] == w.likeness(marks[0][0], marks[1][0]) and r["near_next"] == w.likeness(marks[0][0], marks[2][0])


def test_small_tables_and_ties(spark):
    one = spark.createDataFrame([(7, "only one")], "doc_id long, text string")
    assert w.edited_likeness(one).first()["near_next"] == 1.0
    assert w.edited_likeness(one.limit(0)).count() == 0
    ties = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other"), (None, "a"), (None, None), (2, "b")], "doc_id long, text string")
    assert w.edited_likeness(ties).count() == 6
    assert w.fingerprints(ties).count() == 6
