import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helioframe.llm.packing import least_slack, pack, pack_lengths

WORD = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(items=st.lists(st.integers(1, 12), max_size=9), room=st.integers(0, 30))
def test_least_slack_is_the_best_subset(items, room):
    counts = {n: items.count(n) for n in items}
    used = least_slack(counts, room)
    assert all(k <= counts[n] for n, k in used.items())
    best = max((sum(c) for r in range(len(items) + 1) for c in combinations(items, r) if sum(c) <= room), default=0)
    assert sum(n * k for n, k in used.items()) == best


@settings(max_examples=200, deadline=None)
@given(histogram=st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=20))
def test_patterns_use_every_piece_once(histogram):
    used = defaultdict(int)
    for times, pattern in pack_lengths(histogram, 64):
        assert times > 0 and sum(n * k for n, k in pattern.items()) <= 64
        for n, k in pattern.items():
            used[n] += times * k
    assert used == histogram


def packed(spark, rows, capacity):
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, rank int")
    out = pack(docs, WORD, capacity=capacity).collect()
    at = defaultdict(list)
    for r in out:
        at[r["sequence_id"]].append(r)
    for pieces in at.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= capacity
    return out, len(at)


def test_every_id_lies_in_one_piece(spark):
    texts = [None, "", "a", "the cat sat. " * 30, "x " * 15, "x " * 16, "long " * 200, *[f"word number {i} here" for i in range(60)]]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    out, sequences = packed(spark, rows, 16)
    library = Tokenizer.from_file(WORD)
    by = defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
    total = 0
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        end = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == end and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[end:end + r["length"]], "<u4").tobytes())
            end += r["length"]
        assert end == len(ids)
    assert sequences <= 1.2 * total / 16


def test_repeated_rows_null_ids_and_no_rows(spark):
    out, _ = packed(spark, [(1, "same text here", None, None)] * 50 + [(None, "x", None, None)] * 3, 16)
    assert len(out) == 53
    assert packed(spark, [], 16) == ([], 0)
