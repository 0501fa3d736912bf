import random
import re

import numpy as np
import pytest

from helioframe.llm import setsketch as ss


def brute(rows, words, percent):
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=str)


def fixture_rows():
    rng = random.Random(4)

    def words(n):
        return ["".join(rng.choices("abcdefghü", k=rng.randint(1, 7))) for _ in range(n)]

    rows = [(None, "null id alone in the world"), (9000, None), (9001, ""), (9002, " \t\n "), (9003, "One"), (9004, "one"), (9005, "one two"),
            (906, "a b c d É"), (907, "a b c d é")]
    for g in range(12):
        base = words(rng.choice([6, 30, 200, 600]))
        for k in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, len(w) // 50, len(w) // 20])):
                w[rng.randrange(len(w))] = "changed"
            rows.append((g * 100 + k, " ".join(w).upper() if k % 3 == 0 and "ü" not in "".join(w) else " ".join(w)))
    chain = words(200)
    rows += [(5000 + k, " ".join(chain[6 * k:6 * k + 100])) for k in range(15)]
    return rows + rows[-3:] + [(None, rows[20][1])]


@pytest.mark.parametrize("block", [ss.BLOCK_CLASSES, 2])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ss, "BLOCK_CLASSES", block)  # 2: groups are dealt to cells of two blocks
    rows = fixture_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, cid int")
    for words in (4, 5):
        out = ss.near_duplicates(docs, words=words).collect()
        assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str) == brute(rows, words, 80)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_deduplicated_and_empty(spark):
    rows = fixture_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = ss.deduplicated(docs, words=5)
    kept = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert kept == sorted({c for _, _, c in brute(rows, 5, 80) if c is not None})
    assert ss.near_duplicates(docs.limit(0)).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for n, shift in ((40, 4), (400, 40), (2000, 500)):
        a, b = np.unique(pool[:n]), np.unique(pool[shift:n + shift])
        marks = ss.sketches([a, b, np.union1d(a, b)])
        assert (np.maximum(marks[0], marks[1]) == marks[2]).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        up, down = (marks[0] > marks[1]).sum(), (marks[0] < marks[1]).sum()
        got = ss.estimate(*(np.array([float(x)]) for x in (up, down, len(a), len(b))))[0]
        assert abs(got - true) < ss.MARGIN


def test_sketches_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 3, 50, 4000)]
    together = ss.sketches(sets)
    assert all((ss.sketches([s])[0] == m).all() for s, m in zip(sets, together, strict=True))


@pytest.mark.parametrize("words", [4, 5])
def test_few_words_in_all(words):
    for n in range(1, 6):
        text = " ".join("abcde"[:n])
        assert [len(v) for v in ss.shingle_sets([text.encode()], words)] == [max(1, n - words + 1)]
        one = ss.shingle_sets([text.encode(), b"a b c d e f g"], words)[0]
        assert np.array_equal(ss.shingle_sets([text.encode()], words)[0], one)
