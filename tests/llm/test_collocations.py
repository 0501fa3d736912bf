import re
from collections import Counter

import numpy as np
import pytest

from helioframe.llm import collocations as co
from helioframe.llm.common import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)) if (w := re.findall(r"[^\x20\x09]+", p))]


def counted(docs, longest=4):
    """Every phrase's count, and the words of each language."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang or "und", tuple(w[i:i + size])] += 1
    return f, n


def brute(docs, least=30, longest=4, top=2000):
    f, n = counted(docs, longest)
    some = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    left, right = Counter((g, w[1:]) for g, w in some), Counter((g, w[:-1]) for g, w in some)
    covered = set()
    for (lang, w), a in some.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                part = (lang, w[i:i + size])
                if 100 * a >= 80 * f[part]:
                    covered.add(part)
    out = []
    for lang in sorted(n):
        rows = []
        for (own, w), a in some.items():
            if own != lang or (own, w) in covered:
                continue
            score, _, l, r = min((2000000 * a // (f[own, w[:k]] + f[own, w[k:]]), k, f[own, w[:k]], f[own, w[k:]]) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w).encode(), l, r, left[own, w], right[own, w]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s, x, y) for rank, (s, a, p, l, r, x, y) in enumerate(sorted(rows)[:top], 1)]
    return out


def random_docs(seed, texts=200):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "C", "dd", "É", "日本", "x\x00y", "of", "the", "New", "York", "\x85"]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " \r\n ", "!?"]
    made = []
    for _ in range(texts):
        size = int(rng.integers(0, 30))
        text = "".join(w + g for w, g in zip(rng.choice(words, size), rng.choice(gaps, size), strict=True))
        made.append((text + "new york city " * int(rng.integers(0, 2)), ["en", "de", None][int(rng.integers(0, 3))]))
    return made + [made[0], ("in spite of the", "en")] * 40 + [(None, "en"), ("", None), (" . ", "xx")]


def collect(df):
    return [tuple(r) for r in df.orderBy("lang", "rank").collect()]


@pytest.mark.parametrize(("seed", "words"), [(1, 1 << 20), (2, 50)])
def test_brute_force(spark, monkeypatch, seed, words):
    monkeypatch.setattr(co, "SHARD_WORDS", words)
    docs = random_docs(seed)
    got = co.collocations(spark.createDataFrame(docs, "text string, lang string").repartition(3))
    assert got.dtypes[:8] == [(c, "string" if c in ("lang", "phrase") else "bigint") for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    assert collect(got) == brute(docs)


def test_other_limits(spark):
    docs = random_docs(5)
    df = spark.createDataFrame(docs, "text string, lang string")
    assert collect(co.collocations(df, least=3, longest=5, top=7)) == brute(docs, 3, 5, 7)
    assert collect(co.collocations(df, least=5, longest=2, top=9)) == brute(docs, 5, 2, 9)


def test_index_counts_every_phrase():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 7, 3000)
    index = co.ShardIndex(text, 7, 4)
    want = Counter(tuple(text[i:i + k]) for k in range(1, 5) for i in range(len(text) - k + 1) if (text[i:i + k] >= co.WORDS).all())
    for sides in ((False,) * 4, (True,) * 4, (False, True, False, True), (True, False, False, True)):
        some, got = index.words(), {}
        for left in sides:
            got |= {tuple(s): c for s, c in zip(some.symbols.tolist(), some.count.tolist(), strict=True)}
            some = index.longer(some, left)
        assert got == {tuple(map(int, k)): v for k, v in want.items()}


def test_shared_bits_only_let_more_through(spark, monkeypatch):
    monkeypatch.setattr(co, "SLOT_BITS", 6)
    docs = random_docs(8)
    assert collect(co.collocations(spark.createDataFrame(docs, "text string, lang string"))) == brute(docs)


def test_shards_hold_all_words(spark, monkeypatch):
    monkeypatch.setattr(co, "SHARD_WORDS", 20)
    docs = random_docs(6) + [("word " * 500, "en"), ("w, " * 100, f"l{1}")] + [("q", f"l{k}") for k in range(60)]
    rows = co._shards(spark.createDataFrame(docs, "text string, lang string").coalesce(1)).collect()
    assert len({r["shard"] for r in rows}) == len(rows)
    n = counted(docs)[1]
    assert Counter({lang: sum(r["n"] for r in rows if r["lang"] == lang) for lang in n}) == n


def test_odd_tables(spark):
    schema = "text string, lang string, phrase string, shard long"
    assert co.collocations(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, "x", 1)] * 3 + [("", "en", "x", 1), (" .\n", "en", None, None)]
    assert co.collocations(spark.createDataFrame(rows, schema)).count() == 0
    rows = [("The  end.", "en", "x", 1)] * 31 + [("the end " * 20_000, None, "x", 1)]
    got = collect(co.collocations(spark.createDataFrame(rows, schema)))
    assert got == brute([r[:2] for r in rows]) and len(got) > 1


def test_frequent_words_are_there(spark):
    frequent, total = co.frequent_phrases(spark.createDataFrame([("a b", "en")] * 30, "text string, lang string"),
                                          Scratch(spark))
    assert sorted((r["phrase"], r["a"]) for r in frequent.collect()) == [("a", 30), ("a b", 30), ("b", 30)]
    assert total.collect()[0]["n"] == 60
