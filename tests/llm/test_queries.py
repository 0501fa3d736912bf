import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from helioframe.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE_SQL[name]).select(*got.columns).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_registered():
    names = __spark_entry__.queries()
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES) and "pipeline" in names
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, len(queries.QUERIES) + 1))
    assert "pipeline" not in __spark_entry__.oracle_sql()


def test_pipeline_stages_pass_rows_on(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        now = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
        assert now <= ids and (name in ("language_id", "near_dedup") or now == ids)
        docs, ids = out, now
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()} == ids


def test_pipeline_stages_equal_brute_force(spark):
    import numpy as np
    import public_tokenizers
    from test_setsketch import brute
    from test_suffix import expected
    from tokenizers import Tokenizer

    from helioframe.llm import secrets, suffix_dedup

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").cache()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    kept = stages["near_dedup"](spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows, 5, 80)})

    cut = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["suffix_dedup"](spark, docs, SF).collect()}
    for (doc, text), (_, removed, _, _) in zip(rows, expected([t for _, t in rows], suffix_dedup.LENGTH), strict=True):
        assert cut[doc][0] == text if not removed else len(cut[doc][0].encode()) <= len(text.encode()) - removed
        assert cut[doc][1] == len(cut[doc][0])

    redacted = {r["doc_id"]: r["text"] for r in stages["secret_scan"](spark, docs, SF).collect()}
    for doc, text in rows:
        spans = secrets.Scanner().spans(text)
        assert (redacted[doc] == text) == (not spans)
        assert all(text[a:b] not in redacted[doc] for kind, a, b in spans if kind in secrets.BASE_KINDS)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = stages["packing"](spark, docs, SF).toPandas()
    tokens = pieces.groupby("doc_id").length.sum()
    assert all(tokens[doc] == len(library.encode(text, add_special_tokens=False).ids) + 1 for doc, text in rows)
    filled = pieces.groupby("sequence_id").length.sum()
    assert filled.max() <= 4096 and len(filled) <= np.ceil(tokens.sum() / 4096) + 1


def test_pipeline_on_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_pipeline_keeps_columns_of_any_name(spark):
    names = ["ref", "kept", "kept_id", "score", "lang_pred", "_lang_pred", "_lang_share", "spans", "rank", "a b"]
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = [F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names]
    odd = [(-1, None, None), (-2, "", "en"), (-1, None, None)]
    docs = base.unionByName(spark.createDataFrame([(i, t, g, "s", None) for i, t, g in odd], base.schema)).select("*", *extra).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        for r in out.collect():
            assert all(r[n] == f"{n}-{r['doc_id']}" for n in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("doc_id = -2").count() == 1
