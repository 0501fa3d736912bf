"""Incremental ingest: each file is loaded once; bad files are rejected whole."""
import os

from conftest import write_files
from helioframe.plans.ingest_job import ingest
from helioframe.sources.sinks import read_partitioned
from helioframe.streaming import start_ingest

PAD = "\n" + "01/01/2017 00:00:00;0\n" * 5


def test_incremental_ingest(spark, workdir):
    src, raw, ck, man = (workdir + "/src", workdir + "/raw", workdir + "/ck", workdir + "/man")
    write_files(src, {"tagA.csv": "26/03/2017 01:02:03;1,5\n26/03/2017 01:02:03;2,5" + PAD,
                      "bad.csv": "bad;3" + PAD})
    q = start_ingest(spark, src, raw, ck, man)
    q.awaitTermination(120)
    t = read_partitioned(spark, raw)
    assert {r.kks for r in t.select("kks").distinct().collect()} == {"tagA"}
    assert t.where("kks = 'tagA' AND second(time) = 3").first().value == 1.5
    write_files(src, {"tagB.csv": "27/03/2017 01:02:03;7" + PAD})
    q = start_ingest(spark, src, raw, ck, man)
    q.awaitTermination(120)
    t = read_partitioned(spark, raw)
    assert {r.kks for r in t.select("kks").distinct().collect()} == {"tagA", "tagB"}
    st = {os.path.basename(r.path): r.status for r in spark.read.parquet(man).collect()}
    assert st == {"tagA.csv": "loaded", "bad.csv": "rejected", "tagB.csv": "loaded"}


def test_one_file_per_micro_batch_keeps_one_row_per_key(spark, workdir):
    src, raw, ck = workdir + "/src", workdir + "/raw", workdir + "/ck"
    rows_a = "".join(f"01/02/2017 00:00:{s:02d};{s},5\n" for s in range(0, 40))
    rows_b = "".join(f"01/02/2017 00:00:{s:02d};{s + 100},5\n" for s in range(20, 60))
    write_files(src, {"tagA_part1.csv": rows_a})
    os.makedirs(src + "/b", exist_ok=True)
    write_files(src + "/b", {"tagA_part1.csv": rows_b})     # same tag, overlapping seconds
    for when, name in ((1000, "/tagA_part1.csv"), (2000, "/b/tagA_part1.csv")):
        os.utime(src + name, (when, when))
    q = start_ingest(spark, src, raw, ck, max_files=1, kks="tagA")
    q.awaitTermination(180)
    assert len(q.recentProgress) >= 2                         # two micro-batches ran
    t = read_partitioned(spark, raw)
    assert t.count() == 60 and t.select("time").distinct().count() == 60
    overlap = {r.value for r in t.where("second(time) BETWEEN 20 AND 39").collect()}
    assert overlap == {float(s) + 100.5 for s in range(20, 40)}    # the later file wins


def test_files_in_a_batch_do_not_change_the_table(spark, workdir):
    src = workdir + "/src"
    write_files(src, {f"f{i}.csv": "".join(f"01/02/2017 00:00:{s:02d};{i},{s}\n" for s in range(5 * i, 5 * i + 20)) for i in range(4)})
    for i, when in enumerate((4000, 2000, 3000, 1000)):
        os.utime(f"{src}/f{i}.csv", (when, when))
    tables = []
    for n in (1, 3, 10):
        raw = f"{workdir}/raw{n}"
        start_ingest(spark, src, raw, f"{workdir}/ck{n}", kks="T", max_files=n).awaitTermination(180)
        tables.append(sorted((r.time, r.value) for r in read_partitioned(spark, raw).collect()))
    ingest(spark, src, workdir + "/batch", kks="T")
    tables.append(sorted((r.time, r.value) for r in read_partitioned(spark, workdir + "/batch").collect()))
    assert all(t == tables[0] for t in tables) and len(tables[0]) == 35


def test_a_replayed_batch_replaces_its_manifest_rows(spark, workdir):
    src, man = workdir + "/src", workdir + "/man"
    write_files(src, {"tagA.csv": "26/03/2017 01:02:03;1,5" + PAD})
    for ck in ("/ck1", "/ck2"):                             # a lost checkpoint replays batch 0
        start_ingest(spark, src, workdir + "/raw", workdir + ck, man).awaitTermination(120)
    assert spark.read.parquet(man).count() == 1
