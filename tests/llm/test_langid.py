from itertools import product

import numpy as np
import pytest

from helioframe.llm import langid


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 3, 5, 4])
    emissions, transitions = rng.normal(size=(13, 2)) * 2, rng.normal(size=(2, 2))
    got = langid.posteriors(emissions, lengths, transitions, block=2)
    at = 0
    for n in lengths:
        total = np.zeros((n, 2))
        for path in product(range(2), repeat=int(n)):
            # The first word is entered from a uniform message.
            w = np.exp(emissions[at, path[0]]) * np.exp(transitions[:, path[0]]).sum()
            for t in range(1, n):
                w *= np.exp(transitions[path[t - 1], path[t]] + emissions[at + t, path[t]])
            for t in range(n):
                # The last word is left to a uniform message.
                total[t, path[t]] += w
        assert np.allclose(got[at:at + n], total / total.sum(axis=1, keepdims=True))
        at += n


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def field(docs):
    return langid.trained(docs)


def test_held_out_accuracy(docs, field):
    out = langid.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_code_switched_text(docs, field):
    rows = docs.where("n_chars between 300 and 900 and lang in ('en', 'de')").select("lang", "text").collect()
    en, de = (next(r["text"] for r in rows if r["lang"] == lang) for lang in ("en", "de"))
    spans = langid.Labeller(field).spans(en + " " + de)
    size = {lang: sum(b - a for a, b, x in spans if x == lang) for lang in ("en", "de")}
    assert size["en"] > 0.8 * len(en) * 0.8 and size["de"] > 0.8 * len(de) * 0.8


def test_odd_rows(spark, docs, field):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 -- ²½ __", "x"), (None, rows_text(docs), None), (4, "the " * 50_000, "y"), (4, "the " * 50_000, "y")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = langid.identified(odd.drop("score"), field).collect()
    assert [(r["lang_pred"], r["score"]) for r in out[:3]] == [("und", 0.0)] * 3
    assert out[3]["lang_pred"] != "und" and out[4]["lang_pred"] == out[5]["lang_pred"] == "en"
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
    nothing = langid.predicted(odd.withColumn("lang", odd["score"].cast("string")).where("false"))
    assert nothing.count() == 0
    unlabelled = langid.predicted(odd.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def rows_text(docs):
    return docs.where("lang = 'fr' and n_chars > 200").first()["text"]


def test_long_runs_and_kinds_of_features():
    word = "ab" * 21 + "cdxyz"
    other = word[:41] + "qq" + word[43:]
    assert "".join(langid.words_of(word)) == word and langid.words_of(word) != langid.words_of(other)
    # A prefix is no n-gram: only equal hashes could meet, and these do not.
    assert langid.features("pa")[0] != langid.zlib.crc32(b"pp") % langid.BUCKETS
    assert len(set(langid.features("anna"))) == len(langid.features("anna"))
