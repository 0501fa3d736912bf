"""CSV scan, per-file outcome, dedup, tags, upsert and manifests."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import write_files
from helioframe.functions.text import basename, tag_from_path
from helioframe.operators.ingest import dedup_first, files_to_load, load_summary
from helioframe.plans.ingest_job import ingest, parse_files
from helioframe.sources.measurement_csv import list_files, scan_text, typed
from helioframe.sources.sinks import read_manifests, read_partitioned, write_manifest

PAD = "\n" + "01/01/2017 00:00:00;0\n" * 5   # makes a file exceed 100 bytes


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_comma_decimal_day_first(spark, workdir):
    write_files(workdir, {"tagA.csv": "26/03/2017 01:02:03;1,5\n"})
    df = typed(scan_text(spark, [os.path.join(workdir, "tagA.csv")]))
    r = df.select("time", "value", "bad").first()
    assert r.time == dt.datetime(2017, 3, 26, 1, 2, 3)
    assert r.value == 1.5 and r.bad is False


def test_dedup_first_non_null(spark, workdir):
    body = ("26/03/2017 01:02:03;1,5\n26/03/2017 01:02:03;2,5\n"
            "26/03/2017 01:02:04;\n26/03/2017 01:02:04;7,25\n"
            "26/03/2017 01:02:05;\n")
    write_files(workdir, {"tagA.csv": body})
    out = parse_files(spark, [os.path.join(workdir, "tagA.csv")])
    got = {r.time.second: r.value for r in out.collect()}
    assert got == {3: 1.5, 4: 7.25, 5: None}       # all-empty second kept as null


def test_dedup_first_uses_order_not_value(spark):
    df = spark.createDataFrame([(1, 1, 9.0), (1, 2, None), (1, 0, None), (2, 5, None)],
                               "k int, o int, v double")
    got = dict((r.k, r.v) for r in dedup_first(df, ["k"], "v", "o").collect())
    assert got == {1: 9.0, 2: None}


def test_bad_file_rejected_small_file_skipped(spark, workdir):
    good = "26/03/2017 01:02:03;1,5\n" + "26/03/2017 01:02:04;2\n" * 5
    bad = "26/03/2017 01:02:03;1,5\nbad;3\n" + "26/03/2017 01:02:04;2\n" * 5
    write_files(workdir + "/in", {"good.csv": good, "bad.csv": bad,
                                  "s99.csv": "x" * 99, "s100.csv": "26/03/2017 01:02:03;4" + " " * 79})
    assert os.path.getsize(workdir + "/in/s99.csv") == 99
    assert os.path.getsize(workdir + "/in/s100.csv") == 100
    res = ingest(spark, workdir + "/in", workdir + "/raw")
    status = {os.path.basename(r.path): r.status for r in res.outcomes.collect()}
    assert status == {"good.csv": "loaded", "bad.csv": "rejected",
                      "s99.csv": "skipped_small", "s100.csv": "loaded"}
    tags = {r.kks for r in read_partitioned(spark, workdir + "/raw").select("kks").distinct().collect()}
    assert tags == {"good", "s100"}
    summary = {r.status: r.files for r in load_summary(res.outcomes).collect()}
    assert summary == {"loaded": 2, "rejected": 1, "skipped_small": 1, "offered": 4}


def test_null_tokens_are_missing_values(spark, workdir):
    body = "26/03/2017 01:02:03;NaN\n26/03/2017 01:02:03;7,25\n26/03/2017 01:02:04;NA\n26/03/2017 01:02:05;#N/A\n" + PAD
    write_files(workdir + "/in", {"tagA.csv": body})
    res = ingest(spark, workdir + "/in", workdir + "/raw")
    assert res.outcomes.first().status == "loaded"
    got = {r.time.second: r.value for r in read_partitioned(spark, workdir + "/raw").where("value is null or value > 0").collect()}
    assert got == {3: 7.25, 4: None, 5: None}


def test_every_offered_file_has_an_outcome(spark, workdir):
    write_files(workdir + "/in", {"a[1].csv": "26/03/2017 01:02:03;1" + PAD, "empty.csv": "", "b?.csv": "26/03/2017 01:02:03;2" + PAD,
                                  "sub/c.csv": "26/03/2017 01:02:03;3" + PAD, "sub/a[1].csv": "26/03/2017 01:02:03;4" + PAD})
    res = ingest(spark, workdir + "/in", workdir + "/raw")
    assert {os.path.basename(r.path): r.status for r in res.outcomes.collect()} == {
        "a[1].csv": "loaded", "b?.csv": "loaded", "empty.csv": "skipped_small"}
    res = ingest(spark, workdir + "/in", workdir + "/raw2", names=["a[1].csv", "sub\\c.csv", "gone.csv"])
    got = {r.path.split("/in/")[1]: (r.status, r.length is None) for r in res.outcomes.collect()}
    assert got == {"a[1].csv": ("loaded", False), "sub/c.csv": ("loaded", False), "gone.csv": ("missing", True)}
    assert {r.kks for r in read_partitioned(spark, workdir + "/raw2").select("kks").distinct().collect()} == {"a[1]", "c"}
    summary = {r.status: r.files for r in load_summary(res.outcomes).collect()}
    assert summary == {"loaded": 2, "missing": 1, "offered": 3}


def test_last_file_wins_by_time_then_path(spark, workdir):
    write_files(workdir + "/in", {"x.csv": "26/03/2017 01:02:03;1\n26/03/2017 01:02:04;1" + PAD,
                                  "a.csv": "26/03/2017 01:02:03;\n26/03/2017 01:02:04;2" + PAD,
                                  "b.csv": "26/03/2017 01:02:03;3" + PAD})
    for name, when in (("x.csv", 1000), ("b.csv", 2000), ("a.csv", 3000)):
        os.utime(f"{workdir}/in/{name}", (when, when))
    ingest(spark, workdir + "/in", workdir + "/raw", kks="T")
    got = {r.time.second: r.value for r in read_partitioned(spark, workdir + "/raw").where("second(time) > 0").collect()}
    assert got == {3: None, 4: 2.0}                # the last file's null replaces, too
    os.utime(f"{workdir}/in/b.csv", (3000, 3000))  # equal times: by path
    ingest(spark, workdir + "/in", workdir + "/raw2", kks="T")
    got = {r.time.second: r.value for r in read_partitioned(spark, workdir + "/raw2").where("second(time) > 0").collect()}
    assert got == {3: 3.0, 4: 2.0}


def test_tag_with_hash_and_space(spark, workdir):
    write_files(workdir + "/in", {"11CXA01 x#Value.csv": "26/03/2017 01:02:03;1,5" + PAD})
    ingest(spark, workdir + "/in", workdir + "/raw")
    tags = [r.kks for r in read_partitioned(spark, workdir + "/raw").select("kks").distinct().collect()]
    assert tags == ["11CXA01 x#Value"]


def test_windows_path_tag_and_basename(spark):
    df = spark.createDataFrame([("C:\\d\\tagA.csv",), ("/x/y/tagB.csv",)], "p string")
    got = [(r[0], r[1]) for r in df.select(basename("p"), tag_from_path("p")).collect()]
    assert got == [("tagA.csv", "tagA"), ("tagB.csv", "tagB")]
    assert df.select(tag_from_path("p", kks="K9")).first()[0] == "K9"


def test_load_twice_is_idempotent(spark, workdir):
    write_files(workdir + "/in", {"tagA.csv": "26/03/2017 01:02:03;1,5" + PAD,
                                  "tagB.csv": "27/03/2017 01:02:03;2,5" + PAD})
    ingest(spark, workdir + "/in", workdir + "/raw")
    first = _rows(read_partitioned(spark, workdir + "/raw").select("kks", "date", "time", "value"))
    ingest(spark, workdir + "/in", workdir + "/raw")
    second = _rows(read_partitioned(spark, workdir + "/raw").select("kks", "date", "time", "value"))
    assert first == second and len(first) == 4


def test_upsert_latest_wins(spark, workdir):
    write_files(workdir + "/a", {"tagA.csv": "26/03/2017 01:02:03;1,5" + PAD})
    ingest(spark, workdir + "/a", workdir + "/raw")
    write_files(workdir + "/b", {"tagA.csv": "26/03/2017 01:02:03;9,5" + PAD})
    ingest(spark, workdir + "/b", workdir + "/raw")
    vals = {r.time: r.value for r in read_partitioned(spark, workdir + "/raw").collect()}
    assert vals[dt.datetime(2017, 3, 26, 1, 2, 3)] == 9.5
    assert len(vals) == 2


def test_list_file_precedence_and_manifest(spark, workdir):
    write_files(workdir + "/in", {"tagA.csv": "26/03/2017 01:02:03;1" + PAD,
                                  "tagB.csv": "26/03/2017 01:02:03;2" + PAD})
    write_files(workdir, {"wanted.csv": "tagB.csv\n"})
    res = ingest(spark, workdir + "/in", workdir + "/raw", list_csv=workdir + "/wanted.csv",
                 names=["tagA.csv"], manifest_root=workdir + "/man", day=dt.date(2024, 1, 2))
    assert [os.path.basename(r.path) for r in res.outcomes.collect()] == ["tagB.csv"]
    loaded = [os.path.basename(r.path) for r in read_manifests(spark, workdir + "/man/*").collect()]
    assert loaded == ["tagB.csv"]
    assert os.path.isdir(workdir + "/man/load_date=2024-01-02")


def test_manifest_difference(spark, workdir):
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "file string")
    write_manifest(spark.createDataFrame([("C:\\x\\b",), (None,)], "path string"), workdir)
    loaded = read_manifests(spark, workdir + "/*")
    assert sorted(r.file for r in files_to_load(wanted, loaded).collect()) == ["a", "c"]


def test_listing_reports_sizes(spark, workdir):
    write_files(workdir, {"a.csv": "x" * 10})
    r = list_files(spark, workdir).first()
    assert r.length == 10 and r.path.endswith("a.csv")


def test_upsert_keeps_rows_the_batch_does_not_touch(spark, workdir):
    from helioframe.sources.sinks import upsert

    def batch(secs, off):
        return spark.createDataFrame(
            [("tagA", dt.date(2017, 2, 1), dt.datetime(2017, 2, 1, 0, 0, s), float(s + off))
             for s in secs], "kks string, date date, time timestamp_ntz, value double")
    upsert(batch(range(0, 40), 0), workdir + "/t")
    upsert(batch(range(20, 60), 100), workdir + "/t")
    vals = {r.time.second: r.value for r in read_partitioned(spark, workdir + "/t").collect()}
    assert len(vals) == 60
    assert vals[5] == 5.0 and vals[25] == 125.0 and vals[55] == 155.0


def _wide(spark, days, off, tags=3):
    return (spark.range(days).crossJoin(spark.range(tags).withColumnRenamed("id", "t"))
            .selectExpr("concat('tag', t) as kks", "date_add(date'2017-01-01', cast(id as int)) as date",
                        "cast(date_add(date'2017-01-01', cast(id as int)) as timestamp_ntz) as time", f"cast(id + {off} as double) as value"))


def test_upsert_over_many_days_loses_nothing(spark, workdir):
    from helioframe.sources.sinks import upsert
    upsert(_wide(spark, 40, 0), workdir + "/t", buckets=4)
    upsert(_wide(spark, 40, 1000, tags=1).where("day(date) % 2 = 0"), workdir + "/t")
    rows = read_partitioned(spark, workdir + "/t").collect()
    assert len(rows) == 120 and len({(r.kks, r.date) for r in rows}) == 120
    assert all((r.value >= 1000) == (r.kks == "tag0" and r.date.day % 2 == 0) for r in rows)
    assert {r.kks_bucket for r in rows} <= set(range(4))
    assert not os.path.exists(workdir + "/t.staged")


def test_interrupted_replacement_is_finished_by_the_next_upsert(spark, workdir):
    import shutil

    from helioframe.sources import sinks
    sinks.upsert(_wide(spark, 6, 0), workdir + "/t", buckets=2)
    before = _rows(read_partitioned(spark, workdir + "/t"))
    # A driver that died while replacing: the merge is staged, some old folders are gone already.
    sinks._stage(read_partitioned(spark, workdir + "/t").where("day(date) <= 3"), workdir + "/t")
    for day in (1, 2):
        shutil.rmtree(f"{workdir}/t/date=2017-01-0{day}")
    assert read_partitioned(spark, workdir + "/t").count() < len(before)
    sinks.upsert(_wide(spark, 1, 0, tags=1), workdir + "/t")
    assert _rows(read_partitioned(spark, workdir + "/t")) == before
    # One that died while staging: the table was not touched.
    sinks._stage(_wide(spark, 6, 500).selectExpr("*", "0 as kks_bucket"), workdir + "/t")
    os.remove(workdir + "/t.staged/_SUCCESS")
    assert sinks.recover(spark, workdir + "/t") is False
    assert _rows(read_partitioned(spark, workdir + "/t")) == before


def test_listed_files_alone_are_read(spark, workdir):
    """1 of 20 files: neither the scan nor the discovery touches the others."""
    from helioframe.plans import ingest_job
    from helioframe.sources.measurement_csv import list_inputs, scan_text
    body = "".join(f"01/02/2024 00:{m:02d}:00;{m},5\n" for m in range(30))
    write_files(workdir, {f"in/t{k}.csv": body for k in range(20)} | {"in/sub/t[1].csv": body})
    files = list_inputs(spark, workdir + "/in", names=["t7.csv", "sub/t[1].csv", "none.csv", "../in/t8.csv", "sub"])
    rows = {r["name"]: r for r in files.collect()}
    assert [n for n in sorted(rows) if not rows[n]["missing"]] == ["t7.csv", "t[1].csv"] and len(rows) == 5
    paths = [rows["t7.csv"]["path"]]
    assert len(scan_text(spark, paths).inputFiles()) == 1
    seen = []
    scan = ingest_job.scan_text
    ingest_job.scan_text = lambda s, p, *a: seen.append(p) or scan(s, p, *a)
    try:
        for size in (10_000, 1):
            ingest_job.SCAN_GROUP = size
            table = workdir + f"/raw{size}"
            res = ingest_job.ingest(spark, workdir + "/in", table, names=["t7.csv", "sub/t[1].csv", "none.csv"])
            assert sorted(r["status"] for r in res.outcomes.collect()) == ["loaded", "loaded", "missing"]
            assert read_partitioned(spark, table).count() == 60
    finally:
        ingest_job.scan_text, ingest_job.SCAN_GROUP = scan, 10_000
    assert [len(p) for p in seen] == [2, 1, 1] and all("/t7.csv" in q or "t[1].csv" in q for p in seen for q in p)
