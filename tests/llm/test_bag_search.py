import math
import re
from collections import Counter

import numpy as np
import pytest

from helioframe.llm import bag_search as bs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """By the definition, document by document."""
    words = [split(t) for _, t in docs]
    held = [Counter(w) for w in words]
    n, total = sum(bool(w) for w in words), sum(map(len, words))
    df = Counter(t for h in held for t in h)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), w, h in zip(docs, words, held, strict=True):
            if not w:
                continue
            m = 25 + 75 * len(w) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * h[t] // (1000 * h[t] + 8 * m))
                        for t in split(text) if t in h)
            if score > 0:
                scored.append((-score, (doc is not None, doc), doc))
        scored.sort(key=lambda s: s[:2])
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def random_tables(seed, texts=120, vocabulary=25):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "日本", "A1"]
    made = [" ".join(rng.choice(words, rng.integers(0, 12))) for _ in range(texts)]
    # Groups of copies, one with a third of all rows, and bags with the words in another order.
    made += [made[3]] * texts + [" ".join(reversed(made[4].split())) for _ in range(15)] + [made[5].upper()] * 12
    docs = list(zip(rng.permutation(len(made)).tolist(), made, strict=True))
    items = [(k, " ".join(rng.choice(words, rng.integers(0, 9)))) for k in range(30)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    docs, items = random_tables(seed)
    got = bs.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                    spark.createDataFrame(items, "item_id long, text string"))
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows(got) == brute(docs, items)


def test_blocks_and_top(spark, monkeypatch):
    docs, items = random_tables(3)
    monkeypatch.setattr(bs, "BLOCK_BYTES", 200)
    monkeypatch.setattr(bs, "PRODUCTS", 7)
    got = bs.ranked(spark.createDataFrame(docs, "doc_id long, text string"),
                    spark.createDataFrame(items, "item_id long, text string"), top=3)
    assert rows(got) == brute(docs, items, 3)


def test_large_sums_stay_exact():
    block = bs.Block(["a " * 300_000 + "b"])
    weight = np.array([40_000, 30_000])
    vectors = [np.array([[0, 2_000_000_000], [1, 1]], np.uint32), np.array([[1, 3]], np.uint32)]
    got = block.scores(vectors, np.array([30, 26]), weight)
    part = [w * (10**9 * tf // (1000 * tf + 8 * m)) for w, tf, m in ((40_000, 2 * 10**9, 30), (30_000, 1, 30), (30_000, 3, 26))]
    assert got.ravel().tolist() == [300_000 * part[0] + part[1], part[2]]


def test_odd_rows(spark):
    docs = [(1, None, "x"), (2, "", "x"), (3, "... !", "x"), (4, "The the  cat", None), (4, "The the  cat", None),
            (None, "cat the THE", "x"), (5, "dog " * 50_000, "x"), (6, "Ünï", "x")]
    items = [(1, None), (2, ""), (3, "cat the the"), (3, "cat the the"), (None, "dog DOG unseen"), (5, "Ünï ünï")]
    docs_df = spark.createDataFrame(docs, "doc_id int, text string, item_id string")
    items_df = spark.createDataFrame([(*i, "y") for i in items], "item_id int, text string, rank string")
    assert rows(bs.ranked(docs_df, items_df)) == brute([d[:2] for d in docs], items)
    text_ids = docs_df.withColumn("doc_id", docs_df["doc_id"].cast("string"))
    assert [r[3] for r in rows(bs.ranked(text_ids, items_df))] == [r[3] for r in brute([d[:2] for d in docs], items)]
    assert bs.ranked(docs_df.limit(0), items_df).count() == 0
    assert bs.ranked(docs_df, items_df.limit(0)).count() == 0
