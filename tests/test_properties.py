"""Properties: window counts, fold sizes, split boundaries (few examples each,
since every example runs Spark jobs)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helioframe.operators.rows import chrono_split, kfold
from helioframe.operators.windowing import window_mean

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, secs):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=s), float(i)) for i, s in enumerate(secs)]
    return spark.createDataFrame(rows, "id int, time timestamp_ntz, value double")


@SETTINGS
@given(st.lists(st.integers(0, 4 * 3600), min_size=1, max_size=60, unique=True),
       st.sampled_from(["1 minute", "10 minutes", "1 hour"]))
def test_window_counts_sum_to_rows(spark, secs, duration):
    df = _frame(spark, secs)
    counted = (df.groupBy(F.window("time", duration)).count().agg(F.sum("count")).first()[0])
    assert counted == len(secs)
    assert window_mean(df, duration, key="id").count() == len(secs)


@SETTINGS
@given(st.integers(1, 40), st.integers(2, 7))
def test_folds_differ_by_at_most_one(spark, n, k):
    out = kfold(_frame(spark, list(range(n))), ["time"], k=k)
    sizes = [r["count"] for r in out.groupBy("fold").count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    order = [r.fold for r in out.orderBy("time").collect()]
    assert order == sorted(order)


@SETTINGS
@given(st.lists(st.integers(0, 10_000), min_size=2, max_size=60, unique=True))
def test_split_is_a_time_cut(spark, secs):
    out, n, k = chrono_split(_frame(spark, secs), ["time"])
    assert n == len(secs) and k == int(n * 0.8)
    tr = out.where("split = 'train'").agg(F.max("time"), F.count(F.lit(1))).first()
    va = out.where("split = 'validation'").agg(F.min("time"), F.count(F.lit(1))).first()
    assert tr[1] + va[1] == n
    if tr[1] and va[1]:
        assert tr[0] <= va[0]
