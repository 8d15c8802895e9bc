import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark import Aggregation, QueryConfig, WindowSpec
from tidemark.operators import retention, tables
from tidemark.sources import history


def stream(spark, *rows):
    return spark.createDataFrame(rows, "pk string, ts int")


def test_time_windows_keep_both_ends(spark):
    rows = stream(spark, *((f"p{t}", t) for t in range(11)))
    for kind in ("Sliding", "Tumbling"):
        kept = retention.retained(rows, WindowSpec(kind, 5, "seconds"), "pk")
        assert sorted(r["ts"] for r in kept.collect()) == [5, 6, 7, 8, 9, 10]


def test_row_windows_break_ties_by_key(spark):
    rows = stream(spark, *((f"p{i:02d}", 1 if i < 4 else 2) for i in range(12)))
    kept = retention.retained(rows, WindowSpec("Sliding", 10, "packets"), "pk")
    assert {r["pk"] for r in kept.collect()} == {f"p{i:02d}" for i in range(2, 12)}


@pytest.mark.parametrize("size", [1, 9, 10, 11, 25, 40, 41, 100])
def test_cut_off_equals_top_n(spark, size):
    rows = stream(spark, *((f"p{i:03d}", i % 4 if i < 30 else 9) for i in range(40)))
    small = rows.orderBy(F.col("ts").desc(), F.col("pk").desc()).limit(size)
    assert rows_of(retention.newest_rows(rows, size, "pk"), "pk") == rows_of(small, "pk")


def test_everything_stays_without_a_known_window(spark):
    rows = stream(spark, ("a", 1), ("b", 99))
    for window in (WindowSpec(), WindowSpec("Sliding", 5, ""), WindowSpec("Other", 5, "seconds")):
        assert retention.retained(rows, window, "pk").count() == 2
        assert retention.evicted(rows, window, "pk").count() == 0


def test_aligned_windows(spark):
    rows = stream(spark, *((f"p{t}", t) for t in range(12)))
    config = QueryConfig("Q", "s", (Aggregation("c", "count", "*"), Aggregation("x", "max", "ts")))
    tumbling = retention.aligned(rows, config, WindowSpec("Tumbling", 5, "seconds"))
    assert rows_of(tumbling, "window_start", "c", "x") == [(0, 5, 4), (10, 2, 11), (5, 5, 9)]
    gaps = retention.aligned(rows, config, WindowSpec("Sliding", 2, "seconds", slide=5))
    assert rows_of(gaps, "window_start", "c") == [(0, 2), (10, 2), (5, 2)]
    sliding = retention.aligned(rows, config, WindowSpec("Sliding", 4, "seconds", slide=2))
    assert rows_of(sliding, "window_start", "c") == [(-2, 2), (0, 4), (10, 2), (2, 4), (4, 4), (6, 4), (8, 4)]
    counted = retention.aligned(rows, config, WindowSpec("Tumbling", 5, "events"), "pk")
    assert rows_of(counted, "window_start", "c") == [(0, 5), (10, 2), (5, 5)]


def test_series_slice(spark):
    points = spark.createDataFrame([(1, 1.0), (40, 2.0), (100, 3.0)], "ts int, value double")
    assert rows_of(retention.newest_ticks(points, 60), "ts") == [(100,), (40,)]
    assert retention.newest_ticks(points.where("ts > 1000"), 60).count() == 0


def test_first_arrival_wins_even_for_a_hot_key(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (20_000 - F.col("id")).alias("at"),
    )
    kept = tables.first_wins(rows, ["k"], ["at"])
    assert kept.where("k = 'hot'").collect()[0]["at"] == 20_000 - 19_998
    assert kept.count() == rows.select("k").distinct().count()
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_upsert_takes_the_newest_version(spark):
    shape = "k string, value double, tick int"
    old = spark.createDataFrame([("a", 1.0, 5), ("b", 2.0, 5)], shape)
    new = spark.createDataFrame([("a", 9.0, 6), ("b", 7.0, 5), ("c", 3.0, 1)], shape)
    assert rows_of(tables.upsert(old, new, ["k"], "tick"), "k", "value", "tick") == [
        ("a", 9.0, 6), ("b", 7.0, 5), ("c", 3.0, 1)]


def test_upsert_that_keeps_what_is_there(spark):
    old = spark.createDataFrame([("a", "old", None), ("b", "old", "cfg")], "k string, d string, c string")
    new = spark.createDataFrame([("a", "new", "x"), ("b", "new", "y"), ("z", "new", "z")], "k string, d string, c string")
    assert rows_of(tables.fill_missing(old, new, ["k"], ["c"]), "k", "d", "c") == [
        ("a", "new", "x"), ("b", "new", "cfg"), ("z", "new", "z")]


def test_audits(spark):
    empty = spark.createDataFrame([], "pk string, ts int")
    full = stream(spark, ("a", 3))
    assert tables.reset_audit({"x": empty, "y": empty}, empty).first().asDict() == {
        "x_count": 0, "y_count": 0, "current_tick": 0, "all_cleared": True}
    assert tables.reset_audit({"x": empty, "y": full}, full).first().asDict() == {
        "x_count": 0, "y_count": 1, "current_tick": 3, "all_cleared": False}


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([("a", "p1"), ("b", "p2"), ("c", None)], "id string, p string")
    parent = spark.createDataFrame([("p1",)], "p string")
    assert rows_of(tables.orphans(child, parent, ["p"]), "id") == [("b",)]


def test_invalidation_removes_history_and_summaries(spark):
    kept = tables.invalidated(
        spark.createDataFrame([("Q1", 1), ("Q2", 1)], "query_id string, ts int"),
        spark.createDataFrame([("s1", 1.0), ("s2", 2.0)], "stream_name string, value double"),
        spark.createDataFrame([("Q1", "s1")], "query_id string, source string"),
    )
    assert rows_of(kept[0], "query_id") == [("Q2",)]
    assert rows_of(kept[1], "stream_name") == [("s2",)]


def test_stored_stream_reads_only_its_window(spark, tmp_path):
    rows = stream(spark, *((f"p{t}", t) for t in range(200)))
    history.write_stream_table(rows, str(tmp_path / "s"), ticks_per_folder=16)
    window = history.read_stream_table(spark, str(tmp_path / "s"), 10, ticks_per_folder=16)
    assert sorted(r["ts"] for r in window.collect()) == list(range(189, 200))
    assert "tick_bucket" in window._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]
    assert history.read_stream_table(spark, str(tmp_path / "s")).count() == 200
