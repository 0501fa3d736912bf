"""Row index, split, folds, head/tail/row-at, slices, metrics, tag sheet."""
import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from helioframe.operators.metrics import regression_metrics
from helioframe.operators.report import compare_long, day_panels, series_mean, to_wide
from helioframe.operators.rows import (chrono_split, fold_of, head, kfold, row_at, tail,
                                       time_slice, with_row_index)
from helioframe.operators.tagmeta import (count_present, drop_columns, lookup,
                                          normalised_tags, null_counts, rows_with_any_null,
                                          shape, tag_overlap)

D = dt.datetime
SF = "/root/testdata/sf0.01"


def _series(spark, n):
    return spark.createDataFrame([(i, D(2024, 1, 1) + dt.timedelta(hours=i), float(i))
                                  for i in range(n)], "id int, time timestamp_ntz, y double")


def test_split_11_rows(spark):
    out, n, k = chrono_split(_series(spark, 11), ["time"])
    assert (n, k) == (11, 8)
    train = sorted(r.id for r in out.where("split = 'train'").collect())
    assert train == list(range(8))


def test_five_folds_12_rows(spark):
    out = kfold(_series(spark, 12), ["time"], k=5)
    sizes = [r["count"] for r in out.groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [3, 3, 2, 2, 2]
    folds = [r.fold for r in out.orderBy("time").collect()]
    assert folds == sorted(folds)


def test_row_index_matches_duckdb_on_whole_table(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    ind = with_row_index(e, ["ts", "event_id"])
    got = sorted((r.event_id, r.idx) for r in ind.df.select("event_id", "idx").collect())
    want = duckdb.sql(f"SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 "
                      f"FROM '{SF}/events.parquet'").fetchall()
    assert ind.n == 10000 and got == sorted(want)


def test_fold_arithmetic_equals_ntile():
    for n in range(1, 40):
        for k in (2, 5, 7):
            q, r = divmod(n, k)
            expect = []
            for f in range(k):
                expect += [f] * (q + (1 if f < r else 0))
            got = []
            for i in range(n):
                big = r * (q + 1)
                got.append(i // (q + 1) if i < big else r + (i - big) // q)
            assert got == expect


def test_head_tail_row_at(spark):
    s = _series(spark, 20)
    assert [r.id for r in head(s, ["time"], 3).collect()] == [0, 1, 2]
    assert [r.id for r in tail(s, ["time"], 5).collect()] == [15, 16, 17, 18, 19]
    assert row_at(s, ["time"], 7).first().id == 7
    assert row_at(s, ["time"], 25).count() == 0


def test_inclusive_slice(spark):
    s = spark.createDataFrame([(D(2017, 8, 8, 12),), (D(2017, 8, 9, 12),), (D(2017, 8, 9, 12, 1),)],
                              "time timestamp_ntz")
    assert time_slice(s, "time", D(2017, 8, 8, 12), 1).count() == 2


def test_metrics_identities(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "y double") \
        .withColumn("perfect", F.col("y")).withColumn("mean", F.lit(7.0 / 3))
    m = {r.model: r for r in regression_metrics(df, "y", {"perfect": "perfect",
                                                          "mean": "mean"}).collect()}
    assert m["perfect"].rmse == 0 and m["perfect"].r2 == 1.0
    assert abs(m["mean"].r2) < 1e-12
    assert abs(m["mean"].mse - (((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3)) < 1e-12


def test_tag_normalisation(spark):
    sheet = spark.createDataFrame([("K0", "a::b/c::d", "h"), ("K1", None, None)],
                                  "`KKS` string, `KKS COMPLETE` string, `HIERACHY` string")
    got = [r.tag for r in normalised_tags(sheet).collect()]
    assert got == ["b_c", "K1"]
    assert count_present(sheet, "HIERACHY").first().asDict() == {"n_rows": 2, "n_present": 1}


def test_sheet_profiles(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 3.0), (3, "z", 1.0)],
                               "a int, b string, c double")
    assert null_counts(df).first().asDict() == {"a": 0, "b": 1, "c": 1}
    assert sorted(r.a for r in rows_with_any_null(df).collect()) == [1, 2]
    assert shape(df).first().asDict() == {"n_rows": 3, "n_cols": 3}
    with pytest.raises(KeyError):
        drop_columns(df, ["nope"])
    assert drop_columns(df, ["b"]).columns == ["a", "c"]


def test_tag_overlap_counts(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "kks string")
    b = spark.createDataFrame([("x",), ("z",)], "kks string")
    assert tag_overlap(a, b).first().asDict() == {"n_table": 2, "n_sheet": 3, "n_both": 1}
    assert lookup(b, kks="z").count() == 1


def test_compare_frames_and_wide(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1.0, 2.0), (D(2024, 1, 1), 3.0, 2.0),
                                (D(2024, 1, 9), 5.0, 5.0)], "time timestamp_ntz, y double, p double")
    long = compare_long(df, "time", ["y", "p"], D(2024, 1, 1), 7)
    assert long.count() == 4
    means = {(r.series): r.value for r in series_mean(long).collect()}
    assert means == {"y": 2.0, "p": 2.0}
    panels = day_panels(df, "time", ["y"], D(2024, 1, 1), D(2024, 1, 9))
    assert sorted(r.panel for r in panels.collect()) == ["train", "train", "validation"]
    lg = spark.createDataFrame([(D(2024, 1, 1), "a", 1.0), (D(2024, 1, 1), "b", 2.0)],
                               "time timestamp_ntz, kks string, value double")
    w = to_wide(lg, ["a", "b"]).first()
    assert (w.a, w.b) == (1.0, 2.0)


def test_sheet_scan_and_day_filter(spark, workdir):
    from conftest import write_files
    from helioframe.operators.ingest import rows_of_day
    from helioframe.sources.tables import read_sheet
    write_files(workdir, {"sheet.csv": "KKS,KKS COMPLETE,HIERACHY\nK0,a::b/c,h\nK1,,\n"})
    sheet = read_sheet(spark, workdir + "/sheet.csv")
    assert sheet.columns == ["KKS", "KKS COMPLETE", "HIERACHY"]
    assert [r.tag for r in normalised_tags(sheet).collect()] == ["b_c", "K1"]
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "date date")
    assert rows_of_day(df, "2024-01-02").count() == 1


def test_row_at_is_the_same_at_every_position(spark):
    import helioframe.operators.rows as rows
    s = _series(spark, 20)
    assert [rows.row_at(s, ["time"], i).first().id for i in (0, 19)] == [0, 19]
    assert rows.row_at(s, ["time"], 7).first().id == 7
    assert rows.row_at(s, ["time"], 25).count() == 0
