"""Registered queries over the driver tables and their DuckDB oracles.

Each query reads whole tables from ``sf_dir`` and runs a library operator;
the matching SQL states the same result independently. Stand-in mapping
(see FIXTURES.md): ``events`` is the raw measurement table (``event_type``
-> kks, ``ts`` -> time), ``part`` the tag sheet and tag table,
``documents LEFT JOIN labels`` a table with nulls, ``pages.url`` the file
lists, ``lineitem`` a numeric feature table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions import timefns as T
from helioframe.operators import windowing as W
from helioframe.sources import tables as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _raw(spark, sf):
    return S.medidas_from_events(S.testdata(spark, sf, "events"))


# --------------------------------------------------------------- windows (A1)

def _window_avg(duration):
    def q(spark, sf):
        agg = W.window_mean(_raw(spark, sf), duration)
        return W.window_start(agg).select("kks", "time", r6("value").alias("value"))
    return q


for _name, _dur in (("window_avg_1m", "1 minute"), ("window_avg_1h", "1 hour"),
                    ("window_avg_1d", "1 day")):
    register(_name, f"""
        SELECT event_type AS kks, time_bucket(INTERVAL '{_dur}', ts) AS "time",
               round(avg(value), 6) AS value
        FROM events GROUP BY 1, 2""")(_window_avg(_dur))

_LOCAL_SQL = """
    SELECT kks,
           timezone('Europe/Madrid', timezone('UTC', time_bucket(INTERVAL '{d}', t_utc))) AS "time",
           round(avg(value), 6) AS value
    FROM (SELECT event_type AS kks,
                 timezone('UTC', timezone('Europe/Madrid', ts)) AS t_utc, value
          FROM events)
    GROUP BY kks, time_bucket(INTERVAL '{d}', t_utc)"""


def _window_avg_local(duration):
    def q(spark, sf):
        out = W.local_window_mean(_raw(spark, sf), duration)
        return out.select("kks", "time", r6("value").alias("value"))
    return q


window_avg_local = register("window_avg_local", _LOCAL_SQL.format(d="1 minute"))(
    _window_avg_local("1 minute"))
register("window_avg_local_1h", _LOCAL_SQL.format(d="1 hour"))(_window_avg_local("1 hour"))


# ------------------------------------------------------------ zone shifts

@register("to_utc", """
    SELECT event_id, event_type AS kks,
           timezone('UTC', timezone('Europe/Madrid', ts)) AS "time"
    FROM events""")
def to_utc_q(spark, sf):
    e = S.testdata(spark, sf, "events")
    return e.select("event_id", F.col("event_type").alias("kks"),
                    T.to_utc("ts").alias("time"))


@register("from_utc", """
    SELECT event_id, event_type AS kks,
           timezone('Europe/Madrid', timezone('UTC', ts)) AS "time"
    FROM events""")
def from_utc_q(spark, sf):
    e = S.testdata(spark, sf, "events")
    return e.select("event_id", F.col("event_type").alias("kks"),
                    T.from_utc("ts").alias("time"))


# ----------------------------------------------- day lists, key frames, keyed reads

def _day_bounds(events: DataFrame):
    """First and last day of the events (a one-row aggregate)."""
    lo, hi = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return str(lo), str(hi)


_BOUNDS_SQL = """(SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS lo,
                         CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) AS hi FROM events)"""


@register("date_grid", f"""
    SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM {_BOUNDS_SQL}""")
def date_grid(spark, sf):
    from helioframe.operators.keyed import date_frame
    lo, hi = _day_bounds(S.testdata(spark, sf, "events"))
    return date_frame(spark, lo, hi)


@register("key_grid", f"""
    SELECT k, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
    FROM (SELECT DISTINCT event_type AS k FROM events), {_BOUNDS_SQL}""")
def key_grid(spark, sf):
    from helioframe.operators.keyed import key_frame
    e = S.testdata(spark, sf, "events")
    lo, hi = _day_bounds(e)
    tags = e.select(F.col("event_type").alias("kks")).distinct()
    return key_frame(tags, lo, hi)


@register("keyed_read", """
    SELECT event_type AS kks, CAST(ts AS DATE) AS date,
           timezone('UTC', timezone('Europe/Madrid', ts)) AS "time", value
    FROM events""")
def keyed_read(spark, sf):
    from helioframe.operators.keyed import read_by_keys
    keys = key_grid(spark, sf)
    return read_by_keys(_raw(spark, sf), keys)


# -------------------------------------------------------------- time slices

def _slice(t0: str, days: float):
    def q(spark, sf):
        from helioframe.operators.rows import time_slice
        e = S.testdata(spark, sf, "events")
        start = T.parse_instant(t0)
        return time_slice(e, "ts", start, days).select("event_id", "ts", "value")
    return q


register("range_slice_day", """
    SELECT event_id, ts, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-08 12:00:00'
                 AND TIMESTAMP '2024-01-08 12:00:00' + INTERVAL 1 DAY""")(
    _slice("2024-01-08 12:00", 1))
register("range_slice_week", """
    SELECT event_id, ts, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-15 00:00:00'
                 AND TIMESTAMP '2024-01-15 00:00:00' + INTERVAL 7 DAY""")(
    _slice("2024-01-15 00:00", 7))


# ---------------------------------------------------------- dedup and day keys (A2, A3)

@register("dedup_first", """
    SELECT user_id, CAST(ts AS DATE) AS date, arg_min(value, event_id) AS value
    FROM events GROUP BY 1, 2""")
def dedup_first_q(spark, sf):
    from helioframe.operators.ingest import dedup_first
    e = S.testdata(spark, sf, "events").withColumn("date", F.to_date("ts"))
    return dedup_first(e, ["user_id", "date"], "value", "event_id")


@register("distinct_days", """
    SELECT DISTINCT event_type AS kks, CAST(ts AS DATE) AS date FROM events""")
def distinct_days_q(spark, sf):
    from helioframe.operators.ingest import distinct_days
    return distinct_days(_raw(spark, sf), "time", by=["kks"])


# ------------------------------------------------- CSV files -> raw table (S1..S5, P1..P8)

def _round_trip(spark, sf):
    """Write events as plant CSV files (one folder per tag) and ingest them."""
    from helioframe.plans.ingest_job import ingest
    from helioframe.session import scratch_path
    from helioframe.sources.measurement_csv import write_plant_csv
    e = S.testdata(spark, sf, "events")
    src = e.select(F.col("event_type").alias("kks"), F.col("ts").alias("time"),
                   "value", "event_id")
    csv_dir = scratch_path(spark, "plant-csv")
    write_plant_csv(src, csv_dir, order=("time", "event_id"))
    table = scratch_path(spark, "raw-table")
    res = ingest(spark, csv_dir, table, tag_from="folder")
    return res, table


@register("csv_round_trip", """
    SELECT event_type AS kks, CAST(date_trunc('second', ts) AS DATE) AS date,
           date_trunc('second', ts) AS "time",
           round(first(value ORDER BY ts, event_id), 6) AS value
    FROM events GROUP BY 1, 2, 3""")
def csv_round_trip(spark, sf):
    from helioframe.sources.sinks import read_partitioned
    _, table = _round_trip(spark, sf)
    out = read_partitioned(spark, table)
    return out.select("kks", "date", "time", r6("value").alias("value"))


@register("ingest_summary", """
    SELECT event_type AS kks, count(*) AS lines,
           count(DISTINCT date_trunc('second', ts)) AS loaded_rows
    FROM events GROUP BY 1""")
def ingest_summary(spark, sf):
    from helioframe.sources.sinks import read_partitioned
    res, table = _round_trip(spark, sf)
    lines = res.outcomes.groupBy("kks").agg(F.sum("rows").alias("lines"))
    loaded = read_partitioned(spark, table).groupBy("kks") \
        .agg(F.count(F.lit(1)).alias("loaded_rows"))
    return lines.join(loaded, "kks", "full").select("kks", "lines", "loaded_rows")


def _named_file(spark, lines: DataFrame, path: str) -> None:
    """Write a column of lines as one file of the given name (small inputs of a query)."""
    tmp = path + ".parts"
    lines.coalesce(1).write.mode("overwrite").text(tmp)
    jvm = spark.sparkContext._jvm
    target, folder = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(tmp)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    for st in fs.listStatus(folder):
        if st.getPath().getName().startswith("part-"):
            fs.rename(st.getPath(), target)
    fs.delete(folder, True)


_FEW = 20
_VIEWS = "count(*) FILTER (WHERE event_type = 'view')"


def _odd_files(spark, sf) -> str:
    """A plant's folder: all events in eight files, the views again in four files of a sub-folder, and files of
    a few rows with all that can go wrong: a name that is a glob, a bad line, a small one, an empty one."""
    from helioframe.session import scratch_path
    root = scratch_path(spark, "odd-files")
    e = S.testdata(spark, sf, "events")
    line = F.concat_ws(";", F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")))

    def spread(rows, path, files):
        rows.repartitionByRange(files, "ts", "event_id").sortWithinPartitions("ts", "event_id").select(line.alias("value")).write.text(path)

    spread(e, root, 8)
    spread(e.where("event_type = 'view'"), f"{root}/sub", 4)
    few = e.orderBy("ts", "event_id").limit(_FEW).select(line.alias("value"))
    _named_file(spark, few, f"{root}/a[1].csv")
    _named_file(spark, few.union(spark.sql("select 'not a date;1'")), f"{root}/bad.csv")
    _named_file(spark, few.limit(1), f"{root}/small.csv")
    _named_file(spark, few.limit(0), f"{root}/empty.csv")
    return root


def _summary_sql(rows: list[tuple[str, int, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{status}' AS status, {files} AS files, CAST({lines} AS BIGINT) AS rows FROM events"
                              for status, files, lines in rows)


def _summary(res):
    from helioframe.operators.ingest import load_summary
    return load_summary(res.outcomes).select("status", F.col("files").cast("int").alias("files"), F.col("rows").cast("long").alias("rows"))


@register("ingest_folder", _summary_sql([("loaded", 9, f"count(*) + {_FEW}"), ("rejected", 1, f"any_value({_FEW}) + 1"),
                                         ("skipped_small", 2, "any_value(0)"), ("offered", 12, f"count(*) + {2 * _FEW + 1}")]))
def ingest_folder(spark, sf):
    """Every file of a folder (not of its sub-folders) has an outcome."""
    from helioframe.plans.ingest_job import ingest
    from helioframe.session import scratch_path
    return _summary(ingest(spark, _odd_files(spark, sf), scratch_path(spark, "odd-raw")))


_BY_NAME = _summary_sql([("loaded", 5, f"{_VIEWS} + {_FEW}"), ("missing", 1, "any_value(0)"), ("skipped_small", 1, "any_value(0)"),
                         ("offered", 7, f"{_VIEWS} + {_FEW}")])


def _wanted(spark, root: str) -> list[str]:
    """The files of the sub-folder and three others by name, one of them absent."""
    from helioframe.functions.text import basename
    from helioframe.sources.measurement_csv import list_files
    parts = [r[0] for r in list_files(spark, f"{root}/sub").select(basename("path")).collect()]
    return [*(f"sub\\{p}" for p in parts), "a[1].csv", "gone.csv", "empty.csv"]


@register("ingest_names", _BY_NAME)
def ingest_names(spark, sf):
    """Files by an explicit list of names, one of them absent."""
    from helioframe.plans.ingest_job import ingest
    from helioframe.session import scratch_path
    root = _odd_files(spark, sf)
    return _summary(ingest(spark, root, scratch_path(spark, "odd-raw"), names=_wanted(spark, root)))


@register("ingest_list", _BY_NAME)
def ingest_list(spark, sf):
    """Files by a list file; it takes precedence over names."""
    from helioframe.plans.ingest_job import ingest
    from helioframe.session import scratch_path
    root = _odd_files(spark, sf)
    wanted = scratch_path(spark, "wanted")
    _named_file(spark, spark.createDataFrame([(n,) for n in _wanted(spark, root)], "value string"), wanted)
    return _summary(ingest(spark, root, scratch_path(spark, "odd-raw"), list_csv=wanted, names=["bad.csv"]))


_OVERLAP_SQL = """
    WITH e AS (SELECT event_type AS kks, date_trunc('second', ts) AS "time", value, ts, event_id FROM events),
         f AS (SELECT kks, "time", 1 AS file, first(value ORDER BY ts, event_id) AS value FROM e GROUP BY 1, 2
               UNION ALL
               SELECT kks, "time", 2, first(value * 2 ORDER BY ts, event_id) FROM e WHERE value > 100 GROUP BY 1, 2)
    SELECT kks, CAST("time" AS DATE) AS date, "time", round(arg_max(value, file), 6) AS value FROM f GROUP BY 1, 3"""


def _overlap_files(spark, sf) -> str:
    """All events, and later the ones above 100 doubled, as files of the same tags."""
    from helioframe.session import scratch_path
    from helioframe.sources.measurement_csv import write_plant_csv
    root = scratch_path(spark, "overlap-csv")
    src = S.testdata(spark, sf, "events").select(F.col("event_type").alias("kks"), F.col("ts").alias("time"), "value", "event_id")
    write_plant_csv(src, f"{root}/first", order=("time", "event_id"))
    doubled = src.where("value > 100").withColumn("value", F.col("value") * 2)
    write_plant_csv(doubled, f"{root}/second", order=("time", "event_id"))
    _made_later(spark, f"{root}/second", 60)
    return root


def _made_later(spark, folder: str, seconds: int) -> None:
    """Move the modification times of a folder's files (some stores keep whole seconds)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listFiles(p, True)
    while files.hasNext():
        st = files.next()
        fs.setTimes(st.getPath(), st.getModificationTime() + 1000 * seconds, -1)


def _table_rows(spark, table):
    from helioframe.sources.sinks import read_partitioned
    return read_partitioned(spark, table).select("kks", "date", "time", r6("value").alias("value"))


@register("ingest_overlap", _OVERLAP_SQL)
def ingest_overlap(spark, sf):
    """Two files of each tag with the same seconds, in one batch: the later file wins."""
    from helioframe.plans.ingest_job import ingest
    from helioframe.session import scratch_path
    table = scratch_path(spark, "overlap-table")
    ingest(spark, _overlap_files(spark, sf), table, tag_from="folder")
    return _table_rows(spark, table)


def _stream_overlap(max_files):
    def q(spark, sf):
        from helioframe.session import scratch_path
        from helioframe.streaming import start_ingest
        table, ck = scratch_path(spark, "overlap-table"), scratch_path(spark, "overlap-ck")
        start_ingest(spark, _overlap_files(spark, sf), table, ck, tag_from="folder", max_files=max_files).awaitTermination()
        return _table_rows(spark, table)
    return q


register("stream_overlap", _OVERLAP_SQL)(_stream_overlap(1000))
register("stream_overlap_3", _OVERLAP_SQL)(_stream_overlap(3))


# --------------------------------------------------- file lists and manifests

def _basename_sql(c):
    return f"regexp_extract({c}, '[^/\\\\]*$', 0)"


@register("basename", f"""
    SELECT page_id, {_basename_sql('url')} AS name FROM pages""")
def basename_q(spark, sf):
    from helioframe.functions.text import basename
    p = S.testdata(spark, sf, "pages")
    return p.select("page_id", basename("url").alias("name"))


@register("tag_from_path", f"""
    SELECT page_id,
           left({_basename_sql('url')}, greatest(length({_basename_sql('url')}) - 4, 0)) AS kks
    FROM pages""")
def tag_from_path_q(spark, sf):
    from helioframe.functions.text import tag_from_path
    p = S.testdata(spark, sf, "pages")
    return p.select("page_id", tag_from_path("url").alias("kks"))


@register("files_to_load", f"""
    SELECT DISTINCT coalesce(nullif({_basename_sql('url')}, ''), 'index') AS file FROM pages
    EXCEPT
    SELECT coalesce(nullif({_basename_sql('url')}, ''), 'index') FROM pages WHERE url LIKE 'https%'""")
def files_to_load_q(spark, sf):
    """Wanted list = every page name (``index`` for a folder); two manifests =
    the https pages of even and of odd ids."""
    from helioframe.functions.text import basename
    from helioframe.operators.ingest import files_to_load
    from helioframe.session import scratch_path
    from helioframe.sources.measurement_csv import read_file_list
    from helioframe.sources.sinks import read_manifests, write_manifest
    p = S.testdata(spark, sf, "pages")
    wanted_csv = scratch_path(spark, "wanted")
    page = p.select("page_id", "url", F.when(F.col("url").endswith("/"), F.concat("url", F.lit("index")))
                    .otherwise(F.col("url")).alias("path"))
    (page.select(basename("path").alias("file"))
      .write.mode("overwrite").option("header", False).csv(wanted_csv))
    manifests = scratch_path(spark, "manifests")
    for odd in (0, 1):
        write_manifest(page.where(F.col("url").startswith("https") & (F.col("page_id") % 2 == odd)).select("path"),
                       manifests, dt.date(2024, 1, 1 + odd))
    return files_to_load(read_file_list(spark, wanted_csv), read_manifests(spark, manifests + "/*"))


# ------------------------------------------------------------------ upsert sink

@register("upsert_latest", """
    WITH e AS (SELECT event_type AS kks, CAST(ts AS DATE) AS date, ts AS "time", value
               FROM events)
    SELECT kks, date, "time",
           round(CASE WHEN kks = 'purchase' THEN value * 2 ELSE value END, 6) AS value
    FROM e
    UNION ALL
    SELECT 'purchase_2', date, "time", round(value, 6) FROM e WHERE kks = 'purchase'""")
def upsert_latest(spark, sf):
    """Table = events; batch = purchase rows doubled (updates) and copied to a
    new tag (inserts); the batch is applied twice (the second is a no-op)."""
    from helioframe.session import scratch_path
    from helioframe.sources.sinks import read_partitioned, upsert
    raw = _raw(spark, sf)
    table = scratch_path(spark, "upsert-table")
    upsert(raw, table)
    purchases = raw.where(F.col("kks") == "purchase")
    batch = purchases.withColumn("value", F.col("value") * 2).unionByName(
        purchases.withColumn("kks", F.lit("purchase_2")))
    upsert(batch, table)
    upsert(batch, table)
    out = read_partitioned(spark, table)
    return out.select("kks", "date", "time", r6("value").alias("value"))


# ------------------------------------------------------ full aggregation stage (plan 3.2)

@register("aggregate_job", """
    SELECT kks, CAST(t AS DATE) AS date, t AS "time", value FROM (
      SELECT event_type AS kks,
             timezone('Europe/Madrid', timezone('UTC',
               time_bucket(INTERVAL '1 minute', timezone('UTC', timezone('Europe/Madrid', ts))))) AS t,
             round(avg(value), 6) AS value
      FROM events GROUP BY 1, 2)""")
def aggregate_job_q(spark, sf):
    """events -> raw table (kks, date partitions) -> all tags x all days ->
    1-minute means in plant time -> aggregate table."""
    from helioframe.plans import aggregate_job
    from helioframe.session import scratch_path
    from helioframe.sources.sinks import upsert
    e = S.testdata(spark, sf, "events")
    raw_table, agg_table = scratch_path(spark, "raw"), scratch_path(spark, "agg")
    upsert(_raw(spark, sf), raw_table)
    lo, hi = _day_bounds(e)
    tags = e.select(F.col("event_type").alias("kks")).distinct()
    out = aggregate_job.run(spark, raw_table, agg_table, tags, lo, hi, "1 minute")
    return out.select("kks", "date", "time", r6("value").alias("value"))


# ----------------------------------------------------------- tag sheet

_SHEET_TAG_SQL = """CASE WHEN p_type <> 'SMALL'
        THEN replace(split_part(p_type || '::' || p_brand || '/' || p_name, '::', 2), '/', '_')
        ELSE p_name END"""
_DOCS = "documents LEFT JOIN labels USING (doc_id)"
_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def _docs(spark, sf):
    d = S.testdata(spark, sf, "documents")
    return d.join(S.testdata(spark, sf, "labels"), "doc_id", "left").select(*_DOC_COLS)


def _sheet_tags(spark, sf):
    from helioframe.operators.tagmeta import normalised_tags
    sheet = normalised_tags(S.sheet_from_part(S.testdata(spark, sf, "part")))
    return sheet.select(F.col("KKS").alias("plain_tag"), F.col("tag").alias("kks"))


def _table_tags(spark, sf):
    return S.tag_table_from_part(S.testdata(spark, sf, "part"))


@register("tag_normalise", f"""
    SELECT p_name AS plain_tag, {_SHEET_TAG_SQL} AS kks FROM part""")
def tag_normalise(spark, sf):
    return _sheet_tags(spark, sf)


@register("null_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _DOC_COLS) + f" FROM {_DOCS}")
def null_counts_q(spark, sf):
    from helioframe.operators.tagmeta import null_counts
    return null_counts(_docs(spark, sf))


@register("null_counts_long", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {_DOCS}"
    for c in _DOC_COLS))
def null_counts_long_q(spark, sf):
    from helioframe.operators.tagmeta import null_counts_long
    return null_counts_long(_docs(spark, sf))


@register("rows_any_null", f"""
    SELECT doc_id, lang, n_chars, quality, toxic FROM {_DOCS}
    WHERE doc_id IS NULL OR lang IS NULL OR n_chars IS NULL OR quality IS NULL
       OR toxic IS NULL""")
def rows_any_null_q(spark, sf):
    from helioframe.operators.tagmeta import drop_columns, rows_with_any_null
    return rows_with_any_null(drop_columns(_docs(spark, sf), ["text", "source"]))


@register("shape", f"SELECT count(*) AS n_rows, 7 AS n_cols FROM {_DOCS}")
def shape_q(spark, sf):
    from helioframe.operators.tagmeta import shape
    return shape(_docs(spark, sf))


@register("hier_count", """
    SELECT count(*) AS n_rows, count(CASE WHEN p_type <> 'SMALL' THEN 1 END) AS n_present
    FROM part""")
def hier_count(spark, sf):
    from helioframe.operators.tagmeta import count_present
    return count_present(S.sheet_from_part(S.testdata(spark, sf, "part")), "KKS COMPLETE")


_TAGS_CTE = f"""WITH s AS (SELECT {_SHEET_TAG_SQL} AS t FROM part),
         tt AS (SELECT p_brand || '_' || p_name AS t FROM part)"""


@register("tag_overlap", f"""
    {_TAGS_CTE}
    SELECT (SELECT count(*) FROM tt) AS n_table, (SELECT count(*) FROM s) AS n_sheet,
           (SELECT count(*) FROM (SELECT t FROM s INTERSECT SELECT t FROM tt)) AS n_both""")
def tag_overlap_q(spark, sf):
    from helioframe.operators.tagmeta import tag_overlap
    return tag_overlap(_sheet_tags(spark, sf), _table_tags(spark, sf))


@register("tag_intersection", f"""
    {_TAGS_CTE}
    SELECT t AS kks FROM s INTERSECT SELECT t FROM tt""")
def tag_intersection_q(spark, sf):
    from helioframe.operators.tagmeta import tag_intersection
    return tag_intersection(_sheet_tags(spark, sf), _table_tags(spark, sf))


@register("tags_unmatched", f"""
    {_TAGS_CTE}
    SELECT t AS kks, 'sheet' AS side FROM (SELECT t FROM s EXCEPT SELECT t FROM tt)
    UNION ALL
    SELECT t, 'table' FROM (SELECT t FROM tt EXCEPT SELECT t FROM s)""")
def tags_unmatched_q(spark, sf):
    from helioframe.operators.tagmeta import tags_unmatched
    return tags_unmatched(_sheet_tags(spark, sf), _table_tags(spark, sf))


@register("tag_lookup", """
    SELECT p_brand || '_' || p_name AS kks, p_type AS plant, p_partkey AS id FROM part
    WHERE p_brand || '_' || p_name = 'Brand#2_small ring' AND p_type = 'ECONOMY'""")
def tag_lookup_q(spark, sf):
    from helioframe.operators.tagmeta import lookup
    return lookup(_table_tags(spark, sf), kks="Brand#2_small ring", plant="ECONOMY")


# ------------------------------------------------------------- positions

_EV_ORDER = ["ts", "event_id"]
_EV_IDX = "row_number() OVER (ORDER BY ts, event_id) - 1"


@register("chrono_split", f"""
    SELECT event_id, idx, CASE WHEN idx < floor(n * 0.8) THEN 'train' ELSE 'validation' END AS split
    FROM (SELECT event_id, {_EV_IDX} AS idx, count(*) OVER () AS n FROM events)""")
def chrono_split_q(spark, sf):
    from helioframe.operators.rows import chrono_split
    out, _, _ = chrono_split(S.testdata(spark, sf, "events"), _EV_ORDER)
    return out.select("event_id", "idx", "split")


@register("kfold", f"""
    SELECT event_id, ntile(5) OVER (ORDER BY idx) - 1 AS fold
    FROM (SELECT event_id, {_EV_IDX} AS idx, count(*) OVER () AS n FROM events)
    WHERE idx < floor(n * 0.8)""")
def kfold_q(spark, sf):
    from helioframe.operators.rows import chrono_split, fold_of
    out, _, k = chrono_split(S.testdata(spark, sf, "events"), _EV_ORDER)
    return out.where("split = 'train'").select("event_id", fold_of("idx", k, 5).alias("fold"))


@register("kfold_7", """
    SELECT event_id, ntile(7) OVER (ORDER BY ts, event_id) - 1 AS fold FROM events""")
def kfold_7(spark, sf):
    from helioframe.operators.rows import kfold
    return kfold(S.testdata(spark, sf, "events"), _EV_ORDER, k=7).select("event_id", "fold")


@register("head_n", """
    SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 10""")
def head_n(spark, sf):
    from helioframe.operators.rows import head
    return head(S.testdata(spark, sf, "events"), _EV_ORDER, 10).select("event_id", "ts", "value")


@register("tail_n", """
    SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5""")
def tail_n(spark, sf):
    from helioframe.operators.rows import tail
    return tail(S.testdata(spark, sf, "events"), _EV_ORDER, 5).select("event_id", "ts", "value")


@register("row_at", """
    SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 250""")
def row_at_q(spark, sf):
    from helioframe.operators.rows import row_at
    return row_at(S.testdata(spark, sf, "events"), _EV_ORDER, 250).select("event_id", "ts", "value")


# ------------------------------------------------- baseline, OLS and metrics

@register("mean_baseline", f"""
    WITH r AS (SELECT value, {_EV_IDX} AS idx, count(*) OVER () AS n FROM events),
         m AS (SELECT avg(value) AS mu FROM r WHERE idx < floor(n * 0.8))
    SELECT 'media' AS model, round(mu, 6) AS mean,
           round(avg(pow(value - mu, 2)), 6) AS mse,
           round(sqrt(avg(pow(value - mu, 2))), 6) AS rmse,
           round(1 - sum(pow(value - mu, 2)) / (count(*) * var_pop(value)), 6) AS r2
    FROM r, m WHERE idx >= floor(n * 0.8) GROUP BY mu""")
def mean_baseline(spark, sf):
    from helioframe.models.simple import fit_mean, predict_mean
    from helioframe.operators.metrics import regression_metrics
    from helioframe.operators.rows import chrono_split
    out, _, _ = chrono_split(S.testdata(spark, sf, "events"), _EV_ORDER)
    mu = fit_mean(out.where("split = 'train'"), "value")
    pred = predict_mean(out, mu, "value_media")
    m = regression_metrics(pred.where("split = 'validation'"), "value", {"media": "value_media"})
    return m.select("model", F.round(F.lit(mu), 6).alias("mean"), r6("mse").alias("mse"),
                    r6("rmse").alias("rmse"), r6("r2").alias("r2"))


_LI_ORDER_REST = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_LI_IDX = ("row_number() OVER (ORDER BY l_shipdate, " + ", ".join(_LI_ORDER_REST) + ") - 1")
_LI_FIT_CTE = f"""
    WITH r AS (SELECT *, l_shipdate AS "time", {_LI_IDX} AS idx, count(*) OVER () AS n
               FROM lineitem),
         fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b1,
                        regr_intercept(l_extendedprice, l_quantity) AS b0,
                        avg(l_extendedprice) AS mu
                 FROM r WHERE idx < floor(n * 0.8)),
         p AS (SELECT r.*, mu AS p_media, b0 + b1 * l_quantity AS p_rl,
                      idx < floor(n * 0.8) AS is_train FROM r, fit)"""


def _lineitem_fit(spark, sf):
    from helioframe.plans.training_job import train_all
    li = S.testdata(spark, sf, "lineitem")
    return train_all(li, "l_extendedprice", time="l_shipdate", features=["l_quantity"],
                     models=("media", "rl"), order_extra=tuple(_LI_ORDER_REST))


@register("metrics_rmse_r2", f"""
    {_LI_FIT_CTE}
    SELECT 'media' AS model, round(sqrt(avg(pow(l_extendedprice - p_media, 2))), 3) AS rmse,
           round(1 - sum(pow(l_extendedprice - p_media, 2))
                     / (count(*) * var_pop(l_extendedprice)), 8) AS r2
    FROM p WHERE NOT is_train
    UNION ALL
    SELECT 'rl', round(sqrt(avg(pow(l_extendedprice - p_rl, 2))), 3),
           round(1 - sum(pow(l_extendedprice - p_rl, 2))
                     / (count(*) * var_pop(l_extendedprice)), 8)
    FROM p WHERE NOT is_train""")
def metrics_rmse_r2(spark, sf):
    res = _lineitem_fit(spark, sf)
    return res.metrics.select("model", F.round("rmse", 3).alias("rmse"),
                              F.round("r2", 8).alias("r2"))


@register("linreg_predict", f"""
    {_LI_FIT_CTE}
    SELECT l_orderkey, l_linenumber, idx, round(p_rl, 4) AS prediction FROM p""")
def linreg_predict(spark, sf):
    res = _lineitem_fit(spark, sf)
    return res.predictions.select("l_orderkey", "l_linenumber", "idx",
                                  F.round("l_extendedprice_rl", 4).alias("prediction"))


# -------------------------------------------------------- comparison frames

@register("compare_unpivot", f"""
    {_LI_FIT_CTE}
    SELECT "time", series, round(avg(value), 4) AS value FROM (
        SELECT "time", 'l_extendedprice' AS series, l_extendedprice AS value FROM p
        UNION ALL SELECT "time", 'l_extendedprice_media', p_media FROM p
        UNION ALL SELECT "time", 'l_extendedprice_rl', p_rl FROM p)
    WHERE "time" BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-08'
    GROUP BY 1, 2""")
def compare_unpivot(spark, sf):
    from helioframe.operators.report import compare_long, series_mean
    res = _lineitem_fit(spark, sf)
    preds = res.predictions.withColumnRenamed("l_shipdate", "time")
    long = compare_long(preds, "time", ["l_extendedprice", "l_extendedprice_media",
                                        "l_extendedprice_rl"], "1998-03-01 00:00:00", 7)
    return series_mean(long).select("time", "series", F.round("value", 4).alias("value"))


@register("day_panels", f"""
    {_LI_FIT_CTE}
    SELECT panel, "time", series, round(avg(value), 4) AS value FROM (
        SELECT CASE WHEN "time" < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'validation' END
                   AS panel, "time", series, value FROM (
            SELECT "time", 'l_extendedprice' AS series, l_extendedprice AS value FROM p
            UNION ALL SELECT "time", 'l_extendedprice_rl', p_rl FROM p)
        WHERE "time" BETWEEN TIMESTAMP '1996-08-08 12:00' AND TIMESTAMP '1996-08-09 12:00'
           OR "time" BETWEEN TIMESTAMP '2001-08-09 12:00' AND TIMESTAMP '2001-08-10 12:00')
    GROUP BY 1, 2, 3""")
def day_panels_q(spark, sf):
    from helioframe.operators.report import day_panels
    res = _lineitem_fit(spark, sf)
    preds = res.predictions.withColumnRenamed("l_shipdate", "time")
    long = day_panels(preds, "time", ["l_extendedprice", "l_extendedprice_rl"],
                      "1996-08-08 12:00:00", "2001-08-09 12:00:00")
    return long.groupBy("panel", "time", "series").agg(F.round(F.avg("value"), 4).alias("value"))


# ------------------------------------------------- model operators (M3-M12, S12): rows only

_LI_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_LI_LABEL = "l_extendedprice"


def _li_prepared(spark, sf):
    from helioframe.plans.training_job import prepare
    li = S.testdata(spark, sf, "lineitem")
    data, _, _ = prepare(li, _LI_LABEL, "l_shipdate", order_extra=tuple(_LI_ORDER_REST))
    return data


def _fit_predict(estimator):
    def q(spark, sf):
        from helioframe.models.base import add_prediction, pipeline
        data = _li_prepared(spark, sf)
        model = pipeline(_LI_FEATURES, estimator()).fit(data.where("split = 'train'"))
        out = add_prediction(model, data, "prediction")
        return out.select("l_orderkey", "l_linenumber", "idx", "split", "prediction")
    return q


def _rf():
    from helioframe.models.simple import random_forest
    return random_forest(_LI_LABEL, n_estimators=20, max_depth=10, max_features="sqrt",
                         min_samples_leaf=2, bootstrap=True, seed=1)


def _tree():
    from helioframe.models.simple import decision_tree
    return decision_tree(_LI_LABEL, max_depth=8, min_samples_leaf=2, seed=1)


def _ada():
    from helioframe.models.adaboost import AdaBoostR2
    return AdaBoostR2(labelCol=_LI_LABEL, nEstimators=5, learningRate=0.1, maxDepth=3, seed=0)


def _bag():
    from helioframe.models.bagging import BaggingRegressor
    return BaggingRegressor(labelCol=_LI_LABEL, nEstimators=10, maxSamples=1.0,
                            baseMaxDepth=8, seed=42)


def _bag_subspace():
    from helioframe.models.bagging import BaggingRegressor
    return BaggingRegressor(labelCol=_LI_LABEL, nEstimators=4, maxSamples=0.5,
                            maxFeatures=0.5, bootstrap=True, bootstrapFeatures=True,
                            baseMaxDepth=6, seed=42)


def _svr(kernel):
    def make():
        from helioframe.models.svr import EpsilonSVR
        return EpsilonSVR(labelCol=_LI_LABEL, kernel=kernel, C=1.0, gamma="scale",
                          epsilon=0.1, nComponents=50, seed=0)
    return make


register("rf")(_fit_predict(_rf))
register("decision_tree")(_fit_predict(_tree))
register("adaboost")(_fit_predict(_ada))
register("bagging")(_fit_predict(_bag))
register("bagging_subspace")(_fit_predict(_bag_subspace))
register("svr_linear")(_fit_predict(_svr("linear")))
register("svr_poly")(_fit_predict(_svr("poly")))
register("svr_rbf")(_fit_predict(_svr("rbf")))


@register("pca")
def pca_q(spark, sf):
    from helioframe.models.simple import fit_pca, pca_columns
    li = S.testdata(spark, sf, "lineitem")
    model = fit_pca(li, _LI_FEATURES, 2)
    return pca_columns(model, li.select("l_orderkey", "l_linenumber", _LI_LABEL, *_LI_FEATURES), _LI_FEATURES, 2)


@register("pca_two", """
    WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                      stddev_samp(l_extendedprice) AS sp,
                      sign(corr(l_quantity, l_extendedprice)) AS g FROM lineitem)
    SELECT l_orderkey, l_linenumber,
           round(abs((l_quantity - mq) / sq + g * (l_extendedprice - mp) / sp) / sqrt(2), 5) AS pc1,
           round(abs((l_quantity - mq) / sq - g * (l_extendedprice - mp) / sp) / sqrt(2), 5) AS pc2
    FROM lineitem, s""")
def pca_two(spark, sf):
    """Two correlated features: the components are their sum and difference (up to sign)."""
    from helioframe.models.simple import fit_pca, pca_columns
    li = S.testdata(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice"]
    out = pca_columns(fit_pca(li, cols, 2), li.select("l_orderkey", "l_linenumber", *cols), cols, 2)
    return out.select("l_orderkey", "l_linenumber", *[F.round(F.abs(F.col(c)), 5).alias(c) for c in ("pc1", "pc2")])


# A tree of depth 1 on l_discount (11 values, fewer than the split candidates) is exact in SQL.
def _stump_cte(name: str, rows: str, weight: str = "1.0", by: str = "") -> str:
    """Threshold ``d`` (the greatest value on the left) and means of the best split of ``rows``."""
    key, join = (f"{by}, ", f"a.{by} = b.{by} AND ") if by else ("", "")
    group = f"a.{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
    {name}_v AS (SELECT {key}l_discount AS d, sum({weight}) AS w, sum({weight} * l_extendedprice) AS s FROM {rows} GROUP BY {key}l_discount),
    {name}_t AS (SELECT {group}a.d, sum(CASE WHEN b.d <= a.d THEN b.w ELSE 0 END) AS wl, sum(CASE WHEN b.d <= a.d THEN b.s ELSE 0 END) AS sl,
                        sum(b.w) AS w, sum(b.s) AS s FROM {name}_v a JOIN {name}_v b ON {join}true GROUP BY {group}a.d),
    {name} AS (SELECT * FROM (SELECT {key}d, sl / wl AS lo, (s - sl) / (w - wl) AS hi,
                      row_number() OVER ({part} ORDER BY sl * sl / wl + (s - sl) * (s - sl) / (w - wl) DESC) AS k FROM {name}_t WHERE w > wl) WHERE k = 1)"""


_STUMP_SQL = f"""
    WITH {_stump_cte("st", "lineitem")}
    SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount <= d THEN lo ELSE hi END, 4) AS prediction FROM lineitem, st"""


def _stump(estimator):
    def q(spark, sf):
        from helioframe.models.base import add_prediction, pipeline
        li = S.testdata(spark, sf, "lineitem")
        model = pipeline(["l_discount"], estimator()).fit(li)
        return add_prediction(model, li, "p").select("l_orderkey", "l_linenumber", F.round("p", 4).alias("prediction"))
    return q


def _one_tree():
    from helioframe.models.simple import decision_tree
    return decision_tree(_LI_LABEL, max_depth=1)


def _one_tree_forest():
    from helioframe.models.simple import random_forest
    return random_forest(_LI_LABEL, n_estimators=1, max_depth=1, bootstrap=False)


def _whole_bag():
    from helioframe.models.bagging import BaggingRegressor
    return BaggingRegressor(labelCol=_LI_LABEL, nEstimators=3, bootstrap=False, baseMaxDepth=1)


def _whole_bag_of_forests():
    from helioframe.models.bagging import BaggingRegressor
    return BaggingRegressor(labelCol=_LI_LABEL, nEstimators=2, bootstrap=False, bootstrapFeatures=True, baseMaxDepth=1)


def _stumps(n):
    def make():
        from helioframe.models.adaboost import AdaBoostR2
        return AdaBoostR2(labelCol=_LI_LABEL, nEstimators=n, maxDepth=1)
    return make


register("tree_stump", _STUMP_SQL)(_stump(_one_tree))
register("forest_stump", _STUMP_SQL)(_stump(_one_tree_forest))
register("bagging_stumps", _STUMP_SQL)(_stump(_whole_bag))
register("bagging_drawn_stumps", _STUMP_SQL)(_stump(_whole_bag_of_forests))
register("ada_one_stump", _STUMP_SQL)(_stump(_stumps(1)))
register("ada_two_stumps", f"""
    WITH {_stump_cte("a", "lineitem")},
    ea AS (SELECT lineitem.*, CASE WHEN l_discount <= d THEN lo ELSE hi END AS pa FROM lineitem, a),
    la AS (SELECT max(abs(l_extendedprice - pa)) AS e, avg(abs(l_extendedprice - pa)) / max(abs(l_extendedprice - pa)) AS loss FROM ea),
    wa AS (SELECT ea.*, pow(loss / (1 - loss), 1 - abs(l_extendedprice - pa) / e) AS wt, loss FROM ea, la),
    {_stump_cte("b", "wa", "wt")},
    eb AS (SELECT wa.*, CASE WHEN l_discount <= d THEN lo ELSE hi END AS pb FROM wa, b),
    lb AS (SELECT sum(wt * abs(l_extendedprice - pb)) / sum(wt) / max(abs(l_extendedprice - pb)) AS loss2 FROM eb),
    f AS (SELECT l_orderkey, l_linenumber, pa, pb, ln((1 - loss) / loss) AS aa,
                 CASE WHEN loss2 >= 0.5 THEN 0 ELSE ln((1 - loss2) / loss2) END AS ab FROM eb, lb)
    SELECT l_orderkey, l_linenumber,
           round(CASE WHEN CASE WHEN pa <= pb THEN aa ELSE ab END >= (aa + ab) / 2 THEN CASE WHEN ab > 0 THEN least(pa, pb) ELSE pa END
                      ELSE CASE WHEN ab > 0 THEN greatest(pa, pb) ELSE pa END END, 4) AS prediction FROM f""")(_stump(_stumps(2)))


_FOLDS = f"""
    r AS (SELECT *, {_LI_IDX} AS idx, count(*) OVER () AS n FROM lineitem),
    tr AS (SELECT *, ntile(5) OVER (ORDER BY idx) - 1 AS fold FROM r WHERE idx < floor(n * 0.8)),
    others AS (SELECT f.fold AS held, tr.* FROM tr JOIN (SELECT DISTINCT fold FROM tr) f ON tr.fold <> f.fold)"""
_SEARCH_SQL = f"""
    WITH {_FOLDS},
    {_stump_cte("st", "others", by="held")},
    mu AS (SELECT held, avg(l_extendedprice) AS m FROM others GROUP BY 1),
    p AS (SELECT tr.fold, l_extendedprice AS y, m, CASE WHEN l_discount <= d THEN lo ELSE hi END AS q
          FROM tr JOIN st ON st.held = tr.fold JOIN mu ON mu.held = tr.fold),
    s AS (SELECT fold, 1 - sum(pow(y - m, 2)) / (count(*) * var_pop(y)) AS r0, 1 - sum(pow(y - q, 2)) / (count(*) * var_pop(y)) AS r1
          FROM p GROUP BY 1)
    SELECT 0 AS max_depth, round(avg(r0), 8) AS mean_r2 FROM s UNION ALL SELECT 1, round(avg(r1), 8) FROM s"""


def _stump_search(candidates):
    def q(spark, sf):
        from helioframe.models.search import cross_validate
        from helioframe.models.simple import decision_tree
        data = _li_prepared(spark, sf)
        cands = candidates()
        _, best, scores = cross_validate(data.where("split = 'train'"), ["l_discount"], _LI_LABEL, decision_tree(_LI_LABEL), cands,
                                         lambda est, c: {est.maxDepth: c["max_depth"]})
        assert best["effective"] == {"maxDepth": best["max_depth"]}
        rows = {c["max_depth"]: float(s) for c, s in zip(cands, scores)}
        return spark.createDataFrame(sorted(rows.items()), "max_depth int, mean_r2 double") \
            .select("max_depth", F.round("mean_r2", 8).alias("mean_r2"))
    return q


def _grid_candidates():
    from helioframe.models.search import expand_grid
    return expand_grid({"max_depth": [0, 1]})


def _drawn_candidates():
    from helioframe.models.search import randint, sample_candidates
    return sample_candidates({"max_depth": randint(0, 2)}, 12, seed=3)


register("grid_search_stump", _SEARCH_SQL)(_stump_search(_grid_candidates))
register("random_search_stump", _SEARCH_SQL)(_stump_search(_drawn_candidates))


@register("random_search")
def random_search_q(spark, sf):
    """Random search over a forest space (3 candidates, 5 contiguous folds)."""
    from helioframe.models.search import cross_validate, sample_candidates
    from helioframe.models.simple import forest_params, random_forest
    data = _li_prepared(spark, sf)
    space = {"bootstrap": [True, False], "max_depth": [5, 10, None],
             "max_features": ["auto", "sqrt"], "min_samples_leaf": [2, 4],
             "n_estimators": [10, 20]}
    cands = sample_candidates(space, 3, seed=1)
    model, best, scores = cross_validate(data.where("split = 'train'"), _LI_FEATURES, _LI_LABEL,
                                         random_forest(_LI_LABEL, seed=1), cands, forest_params)
    return _search_report(spark, cands, scores)


@register("grid_search")
def grid_search_q(spark, sf):
    """Grid search of AdaBoost.R2 (4 grid points, 5 contiguous folds)."""
    from helioframe.models.adaboost import AdaBoostR2
    from helioframe.models.search import cross_validate, expand_grid
    from helioframe.plans.training_job import ada_params
    data = _li_prepared(spark, sf)
    cands = expand_grid({"n_estimators": [2, 4], "learning_rate": [0.1, 1.0]})
    model, best, scores = cross_validate(data.where("split = 'train'"), _LI_FEATURES, _LI_LABEL,
                                         AdaBoostR2(labelCol=_LI_LABEL), cands, ada_params)
    return _search_report(spark, cands, scores)


def _search_report(spark, cands, scores):
    rows = [(i, str(sorted(c.items())), float(s)) for i, (c, s) in enumerate(zip(cands, scores))]
    return spark.createDataFrame(rows, "candidate int, params string, mean_r2 double")


@register("train_all")
def train_all_q(spark, sf):
    """The training stage with all six models: every search has a choice."""
    from helioframe.models.search import randint
    from helioframe.plans.training_job import SearchConfig, train_all
    li = S.testdata(spark, sf, "lineitem").select("l_shipdate", *_LI_ORDER_REST[:2], _LI_LABEL, *_LI_FEATURES)
    cfg = SearchConfig(
        forest_space={"n_estimators": [5, 10], "max_depth": [10, None], "max_features": ["sqrt"],
                      "min_samples_leaf": [2], "min_samples_split": [2, 10], "bootstrap": [True]},
        forest_iter=4,
        svr_grid={"kernel": ["rbf"], "C": [1.0, 10.0], "gamma": ["scale"], "epsilon": [0.1]},
        ada_grid={"n_estimators": [3], "learning_rate": [0.1, 1.0]},
        bagging_space={"base_estimator": ["tree", "extra"], "n_estimators": randint(3, 8), "bootstrap": [True],
                       "max_samples": [0.5, 1.0], "base_max_depth": randint(3, 8), "base_min_samples_split": randint(2, 20),
                       "base_min_samples_leaf": [2], "base_trees": [3]},
        bagging_iter=2, folds=5)
    got = train_all(li, _LI_LABEL, time="l_shipdate", config=cfg, order_extra=tuple(_LI_ORDER_REST[:2]))
    solver = spark.createDataFrame([("svr", got.best["svr"]["converged"], got.best["svr"]["passes"])],
                                   "model string, converged boolean, passes int")
    return got.metrics.join(solver, "model", "left")


@register("train_on_components")
def train_on_components(spark, sf):
    """Mean, OLS and a searched boosting on two principal components of the features."""
    from helioframe.plans.training_job import SearchConfig, train_all
    cfg = SearchConfig.principal_components()
    cfg.ada_grid = {"n_estimators": [2], "learning_rate": [0.1, 1.0]}
    return train_all(S.testdata(spark, sf, "lineitem"), _LI_LABEL, time="l_shipdate", features=_LI_FEATURES,
                     models=("media", "rl", "ada"), config=cfg, order_extra=tuple(_LI_ORDER_REST), components=2).metrics


@register("feature_split", """
    SELECT round(regr_r2(l_extendedprice, l_quantity), 8) AS r2, 'l_quantity' AS features FROM lineitem""")
def feature_split(spark, sf):
    """The features are the columns that are neither label nor time; OLS on them."""
    from helioframe.models.base import add_prediction, feature_columns
    from helioframe.models.simple import fit_linear
    from helioframe.operators.metrics import regression_metrics
    li = S.testdata(spark, sf, "lineitem").select("l_shipdate", "l_quantity", _LI_LABEL)
    features = feature_columns(li, _LI_LABEL, exclude=("l_shipdate",))
    pred = add_prediction(fit_linear(li, features, _LI_LABEL), li, "p")
    return regression_metrics(pred, _LI_LABEL, {"rl": "p"}).select(F.round("r2", 8).alias("r2"), F.lit(",".join(features)).alias("features"))


@register("model_persist", f"""
    {_LI_FIT_CTE}
    SELECT l_orderkey, l_linenumber, idx, round(p_rl, 4) AS prediction FROM p""")
def model_persist_q(spark, sf):
    """Fit OLS, save it to the shared folder, load it back and predict."""
    from helioframe.models.base import add_prediction
    from helioframe.models.simple import fit_linear, load_model, save_model
    from helioframe.session import scratch_path
    data = _li_prepared(spark, sf)
    path = scratch_path(spark, "model")
    save_model(fit_linear(data.where("split = 'train'"), ["l_quantity"], _LI_LABEL), path)
    out = add_prediction(load_model(path), data, "p")
    return out.select("l_orderkey", "l_linenumber", "idx", F.round("p", 4).alias("prediction"))


def _svr_small():
    from helioframe.models.svr import EpsilonSVR
    return EpsilonSVR(labelCol=_LI_LABEL, kernel="rbf", nComponents=10, maxIter=10)


@register("persist_own_models", " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS n_rows, 0 AS n_different FROM lineitem" for m in ("bagging", "bagging_subspace", "adaboost", "svr")))
def persist_own_models(spark, sf):
    """Each model of the library saved in a pipeline, read back and compared row by row."""
    from functools import reduce

    from helioframe.models.base import add_prediction, pipeline
    from helioframe.models.simple import load_model, save_model
    from helioframe.session import scratch_path
    li = S.testdata(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", _LI_LABEL, *_LI_FEATURES)
    parts = []
    for name, make in (("bagging", _bag), ("bagging_subspace", _bag_subspace), ("adaboost", _ada), ("svr", _svr_small)):
        model = pipeline(_LI_FEATURES, make()).fit(li)
        path = scratch_path(spark, "model")
        save_model(model, path)
        both = add_prediction(load_model(path), add_prediction(model, li, "p"), "q")
        parts.append(both.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"),
                              F.count_if(~F.col("p").eqNullSafe(F.col("q"))).cast("int").alias("n_different")))
    return reduce(DataFrame.unionByName, parts)


# -------------------------------------------- window states, interval of the mean

@register("window_state_merge", """
    WITH e AS (SELECT event_type AS kks, ts, max(value) AS value FROM events GROUP BY 1, 2)
    SELECT kks, time_bucket(INTERVAL '1 minute', ts) AS "time", round(avg(value), 6) AS value FROM e GROUP BY 1, 2""")
def window_state_merge(spark, sf):
    """Minute means from states: two overlapping loads, the first of them with values that are corrected by the second."""
    from helioframe.operators.window_state import load, means, read_states
    from helioframe.session import scratch_path
    e = (S.testdata(spark, sf, "events").groupBy(F.col("event_type").alias("kks"), F.col("ts").cast("timestamp_ntz").alias("time"))
         .agg(F.max("value").alias("value")).withColumn("date", F.to_date("time"))
         .withColumn("part", F.pmod(F.xxhash64("kks", "time"), F.lit(4))))
    raw, states = scratch_path(spark, "state-raw"), scratch_path(spark, "states")
    for batch in (e.where("part < 2").withColumn("value", F.when(F.col("part") == 1, F.col("value") + 1).otherwise(F.col("value"))),
                  e.where("part >= 1")):
        load(batch, raw, states)
    return means(read_states(spark, states)).select("kks", "time", r6("value").alias("value"))


@register("series_band", """
    SELECT event_id, event_type AS series, CAST(1 AS BIGINT) AS n, round(value, 6) AS value, round(value, 6) AS low, round(value, 6) AS high
    FROM events""")
def series_band_q(spark, sf):
    """On an index without repeats the interval of the mean is the value itself."""
    from helioframe.operators.band import series_band
    e = S.testdata(spark, sf, "events").select("event_id", F.col("event_type").alias("series"), "value")
    out = series_band(e, ["event_id"], time="event_id", replicates=50)
    return out.select("event_id", "series", "n", *[r6(c).alias(c) for c in ("value", "low", "high")])


@register("series_band_hourly")
def series_band_hourly(spark, sf):
    """The 95 % interval of each series' mean by hour, 200 replicates."""
    from helioframe.operators.band import series_band
    e = S.testdata(spark, sf, "events").select("event_id", F.date_trunc("hour", "ts").alias("time"), F.col("event_type").alias("series"), "value")
    return series_band(e, ["event_id"], replicates=200)


# ------------------------------------------------------- models grown and solved in shared passes

_TWO_LEVELS = f"""
    WITH {_stump_cte("r", "lineitem")},
    sides AS (SELECT lineitem.*, l_discount <= (SELECT d FROM r) AS side FROM lineitem),
    {_stump_cte("c", "sides", by="side")}
    SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount <= d THEN lo ELSE hi END, 4) AS prediction
    FROM sides JOIN c ON sides.side = c.side"""


def _grown(plan, seed=0):
    def make():
        from helioframe.models.forest import GrownForest
        return GrownForest(plan(), labelCol=_LI_LABEL, seed=seed)
    return make


def _one_grown(**more):
    def plan():
        from helioframe.models.forest import ForestPlan
        return ForestPlan(n_estimators=1, bootstrap=False, **more)
    return plan


register("tree_two_levels", _TWO_LEVELS)(_stump(_grown(_one_grown(max_depth=2))))


def _extra_sql() -> str:
    """Two levels of cuts drawn between the least and greatest discount of a node; the draws are those of the grower."""
    from helioframe.models.draws import mixed, uniform
    root = int(mixed(int(mixed(0, 0))))
    draw = [float(uniform(mixed(k, 4096))) for k in (root, mixed(root, 1), mixed(root, 2))]
    return f"""
    WITH a AS (SELECT lineitem.*, min(l_discount) OVER () + {draw[0]!r} * (max(l_discount) OVER () - min(l_discount) OVER ()) AS t FROM lineitem),
    b AS (SELECT *, l_discount <= t AS side FROM a),
    c AS (SELECT *, min(l_discount) OVER (PARTITION BY side) + CASE WHEN side THEN {draw[1]!r} ELSE {draw[2]!r} END
                 * (max(l_discount) OVER (PARTITION BY side) - min(l_discount) OVER (PARTITION BY side)) AS u FROM b)
    SELECT l_orderkey, l_linenumber, round(avg(l_extendedprice) OVER (PARTITION BY side, l_discount <= u), 4) AS prediction FROM c"""


register("extra_tree_given_draws", _extra_sql())(_stump(_grown(_one_grown(max_depth=2, extra=True))))


@register("forest_search_stump", _SEARCH_SQL)
def forest_search_stump(spark, sf):
    """The shared search over trees without and with one split, five contiguous folds."""
    from helioframe.models.forest import forest_plan, search_forests
    data = _li_prepared(spark, sf)
    cands = [{"n_estimators": 1, "bootstrap": False, "max_depth": d} for d in (0, 1)]
    _, _, scores = search_forests(data.where("split = 'train'"), ["l_discount"], _LI_LABEL, cands, forest_plan, order=["idx"])
    return (spark.createDataFrame([(c["max_depth"], s) for c, s in zip(cands, scores)], "max_depth int, mean_r2 double")
            .select("max_depth", F.round("mean_r2", 8).alias("mean_r2")))


@register("exact_samples", " UNION ALL ".join(
    f"SELECT '{name}' AS sample, count(*) AS n, CAST(floor({share} * count(*)) AS BIGINT) AS drawn FROM lineitem"
    for name, share in (("half", 0.5), ("half again", 0.5), ("all again", 1.0), ("forest in a bag", 0.5))))
def exact_samples(spark, sf):
    """Rows drawn with and without replacement, and a bootstrap of a sample: exact numbers at any partitioning."""
    import pyarrow as pa

    from helioframe.models.draws import Sample
    from helioframe.operators.rows import with_row_index
    ind = with_row_index(S.testdata(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
    n, half = ind.n, ind.n // 2
    first = Sample(n, half, False, 1)
    samples = {"half": first, "half again": Sample(n, half, True, 2), "all again": Sample(n, n, True, 3),
               "forest in a bag": Sample(half, half, True, 4, first)}

    def run(batches):
        for batch in batches:
            idx = batch.column("idx").to_numpy(zero_copy_only=False)
            drawn = [int(s.counts(idx).sum()) for s in samples.values()]
            yield pa.RecordBatch.from_pydict({"sample": list(samples), "n": [len(idx)] * len(samples), "drawn": drawn})

    return (ind.df.select("idx").mapInArrow(run, "sample string, n long, drawn long").groupBy("sample")
            .agg(F.sum("n").alias("n"), F.sum("drawn").alias("drawn")))


@register("kernel_residual", """
    WITH m AS (SELECT min(l_discount) AS a, max(l_discount) AS b FROM lineitem),
    k AS (SELECT exp(-100 * pow(l_discount - a, 2)) AS ka, exp(-100 * pow(l_discount - b, 2)) AS kb, exp(-100 * pow(a - b, 2)) AS c FROM lineitem, m)
    SELECT count(*) AS n, round(avg(1 - (ka * ka + kb * kb - 2 * ka * kb * c) / (1 - c * c)), 8) AS residual FROM k""")
def kernel_residual_q(spark, sf):
    """What a Nyström map with the least and greatest discount as landmarks loses of the kernel."""
    import numpy as np

    from helioframe.models.base import FEATURES, assembler
    from helioframe.models.kernel_svr import kernel_residual
    li = S.testdata(spark, sf, "lineitem").select(F.col("l_discount").cast("double").alias("l_discount"))
    ends = li.agg(F.min("l_discount"), F.max("l_discount")).first()
    out = kernel_residual(assembler(["l_discount"]).transform(li), FEATURES, 100.0, np.array(ends, float)[:, None])
    return out.select("n", F.round("residual", 8).alias("residual"))


@register("min_norm_ols", """
    WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
    SELECT 'l_quantity' AS term, round(b / 2, 6) AS weight FROM f UNION ALL SELECT 'again', round(b / 2, 6) FROM f
    UNION ALL SELECT 'constant', 0.0 UNION ALL SELECT 'intercept', round(a, 4) FROM f""")
def min_norm_ols(spark, sf):
    """A feature that stands twice shares its weight, a constant one has none."""
    from helioframe.models.base import pipeline
    from helioframe.models.least_squares import MinimumNormOLS
    li = S.testdata(spark, sf, "lineitem").withColumn("again", F.col("l_quantity")).withColumn("constant", F.lit(3.0))
    names = ["l_quantity", "again", "constant"]
    model = pipeline(names, MinimumNormOLS(labelCol=_LI_LABEL)).fit(li).stages[-1]
    rows = [(c, round(w, 6) + 0.0) for c, w in zip(names, model.coefficients)] + [("intercept", round(model.intercept, 4))]
    return spark.createDataFrame(rows, "term string, weight double")


# ------------------------------------------------------- streaming ingest (S1-S5 incremental)

@register("stream_ingest", ORACLE_SQL["csv_round_trip"])
def stream_ingest(spark, sf):
    """events -> plant CSV files -> Structured Streaming ingest (availableNow) -> raw table."""
    from helioframe.session import scratch_path
    from helioframe.sources.measurement_csv import write_plant_csv
    from helioframe.sources.sinks import read_partitioned
    from helioframe.streaming import start_ingest
    e = S.testdata(spark, sf, "events")
    src = e.select(F.col("event_type").alias("kks"), F.col("ts").alias("time"),
                   "value", "event_id")
    csv_dir = scratch_path(spark, "plant-csv")
    write_plant_csv(src, csv_dir, order=("time", "event_id"))
    table, ck = scratch_path(spark, "raw-table"), scratch_path(spark, "stream-ck")
    start_ingest(spark, csv_dir, table, ck, tag_from="folder").awaitTermination()
    out = read_partitioned(spark, table)
    return out.select("kks", "date", "time", r6("value").alias("value"))


# ---------------------------------------------- day filter, display order, wide glue

@register("day_filter", """
    SELECT event_type AS kks, CAST(ts AS DATE) AS date, ts AS "time", value FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-10'""")
def day_filter(spark, sf):
    from helioframe.operators.ingest import rows_of_day
    return rows_of_day(_raw(spark, sf), "2024-01-10")


@register("window_sorted", """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS "time", event_type AS kks,
           round(avg(value), 6) AS value
    FROM events GROUP BY 1, 2 ORDER BY 1, 2""")
def window_sorted(spark, sf):
    agg = W.window_mean(_raw(spark, sf), "1 hour")
    return W.sort_by_window(agg).select(F.col("window.start").alias("time"), "kks",
                                        r6("value").alias("value"))


@register("pivot_wide", """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS "time",
           round(avg(value) FILTER (WHERE event_type = 'click'), 6) AS click,
           round(avg(value) FILTER (WHERE event_type = 'error'), 6) AS error,
           round(avg(value) FILTER (WHERE event_type = 'purchase'), 6) AS purchase,
           round(avg(value) FILTER (WHERE event_type = 'signup'), 6) AS signup,
           round(avg(value) FILTER (WHERE event_type = 'view'), 6) AS "view"
    FROM events GROUP BY 1""")
def pivot_wide(spark, sf):
    """Hourly means, one column per tag (tag list read from the data)."""
    from helioframe.operators.report import to_wide
    agg = W.window_start(W.window_mean(_raw(spark, sf), "1 hour"))
    tags = sorted(r[0] for r in agg.select("kks").distinct().collect())
    wide = to_wide(agg, tags)
    return wide.select("time", *[r6(t).alias(t) for t in tags])


# ------------------------------------------------ names used by the survey's query list

@register("keyed_join", """
    SELECT event_type AS kks, CAST(ts AS DATE) AS date, ts AS "time", value FROM events""")
def keyed_join(spark, sf):
    """The (kks, date) key join of all tags x all days, without the zone shift."""
    from helioframe.operators.keyed import read_by_keys
    return read_by_keys(_raw(spark, sf), key_grid(spark, sf), tz=None)


@register("svr", """
    SELECT count(*) AS n_rows, true AS converged, true AS objective_as_stated, true AS below_ols FROM lineitem""")
def svr_objective(spark, sf):
    """Linear SVR: the solver ended by itself, its objective is the stated one
    at its weights, and no greater than at the least-squares line."""
    from helioframe.models.base import assembler
    from helioframe.models.svr import EpsilonSVR
    li = S.testdata(spark, sf, "lineitem").select("l_quantity", _LI_LABEL)
    c, eps = 1e-3, 1000.0
    m = EpsilonSVR(labelCol=_LI_LABEL, kernel="linear", C=c, epsilon=eps).fit(assembler(["l_quantity"]).transform(li))
    slope, cut, n = li.agg(F.regr_slope(_LI_LABEL, "l_quantity"), F.regr_intercept(_LI_LABEL, "l_quantity"), F.count(F.lit(1))).first()

    def objective(w, b):
        over = F.greatest(F.abs(F.col(_LI_LABEL) - w * F.col("l_quantity") - b) - eps, F.lit(0.0))
        return F.avg(over) + F.lit(w * w / (2 * c * n))

    own, ols = objective(float(m.weights[0]), float(m.intercept)), objective(float(slope), float(cut))
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(m.converged).alias("converged"),
                  (F.abs(own - m.objective) <= 1e-6 * m.objective).alias("objective_as_stated"), (F.lit(m.objective) <= ols).alias("below_ols"))


@register("upsert_partial", """
    SELECT event_type AS kks, CAST(ts AS DATE) AS date, ts AS "time",
           round(CASE WHEN value > 250 THEN value * 2 ELSE value END, 6) AS value
    FROM events""")
def upsert_partial(spark, sf):
    """Table = events; batch = the rows above 250, doubled. The batch touches
    every (day, bucket) folder but only some rows in each: the untouched rows
    must survive the merge. Applied twice (the second is a no-op)."""
    from helioframe.session import scratch_path
    from helioframe.sources.sinks import read_partitioned, upsert
    raw = _raw(spark, sf)
    table = scratch_path(spark, "upsert-partial")
    upsert(raw, table)
    batch = raw.where(F.col("value") > 250).withColumn("value", F.col("value") * 2)
    upsert(batch, table)
    upsert(batch, table)
    out = read_partitioned(spark, table)
    return out.select("kks", "date", "time", r6("value").alias("value"))


@register("upsert_wide", """
    SELECT event_type || '_' || (user_id % 40) AS kks, CAST(ts AS DATE) AS date, ts AS "time",
           round(max(CASE WHEN user_id % 2 = 0 THEN value * 2 ELSE value END), 6) AS value
    FROM events GROUP BY 1, 2, 3""")
def upsert_wide(spark, sf):
    """A table of many tags, so of many (day, bucket) folders; the batch touches
    every day and half of the tags. The rows of the other half must survive."""
    from helioframe.session import scratch_path
    from helioframe.sources.sinks import upsert
    e = S.testdata(spark, sf, "events")
    raw = (e.withColumn("kks", F.concat_ws("_", "event_type", F.col("user_id") % 40))
           .groupBy("kks", "user_id", F.to_date("ts").alias("date"), F.col("ts").alias("time")).agg(F.max("value").alias("value")))
    raw = raw.groupBy("kks", "date", "time").agg(F.max("value").alias("value"), F.max(F.col("user_id") % 2).alias("odd"))
    table = scratch_path(spark, "upsert-wide")
    upsert(raw, table, buckets=16)
    upsert(raw.where("odd = 0").withColumn("value", F.col("value") * 2), table)
    return _table_rows(spark, table)


@register("sheet_scan", f"SELECT p_name AS plain_tag, {_SHEET_TAG_SQL} AS kks FROM part")
def sheet_scan(spark, sf):
    """The tag sheet written as CSV with a header, scanned as strings, tags normalised."""
    from helioframe.operators.tagmeta import normalised_tags
    from helioframe.session import scratch_path
    path = scratch_path(spark, "sheet")
    S.sheet_from_part(S.testdata(spark, sf, "part")).write.option("header", True).csv(path)
    sheet = normalised_tags(S.read_sheet(spark, path))
    return sheet.select(F.col("KKS").alias("plain_tag"), F.col("tag").alias("kks"))
