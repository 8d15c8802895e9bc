"""Logical time, running scans and ranges against brute force."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import clock, intervals
from tidemark.operators.intervals import aggregate_over, repeat_over, sliding_over
from tidemark.operators.positions import positioned
from tidemark.operators.scan import running


def frame(spark, ticks):
    return spark.createDataFrame([(t,) for t in ticks], "ts long")


def greedy(ticks, frequency):
    due = []
    for t in sorted(set(ticks)):
        if not due or t - due[-1] >= frequency:
            due.append(t)
    return due


def test_due_ticks_with_gaps(spark):
    ticks = frame(spark, [1, 2, 3, 7, 8, 9, 10, 14, 15])
    assert [r[0] for r in clock.due_ticks(ticks, 3).orderBy("ts").collect()] == [1, 7, 10, 14]


@pytest.mark.parametrize("frequency", [2, 7, 30, 5000])
def test_due_ticks_over_many_blocks(spark, frequency):
    rng = random.Random(frequency)
    ticks = set()
    for start in (0, 60_000, 65_500, 131_000, 1_000_000, 2_000_000_000):
        ticks |= {start + rng.randint(0, 400) for _ in range(150)}
    found = clock.due_ticks(frame(spark, ticks), frequency).orderBy("ts").collect()
    assert [r[0] for r in found] == greedy(ticks, frequency)


def test_due_ticks_when_dense(spark):
    ticks = frame(spark, range(70_000))
    found = clock.due_ticks(ticks, 3)
    assert found.count() == len(range(0, 70_000, 3))
    assert found.where(F.col("ts") % 3 != 0).count() == 0


@pytest.mark.parametrize("frequency", [3, 65_536, 100_000, 1_000_000])
def test_due_ticks_far_apart(spark, frequency):
    rng = random.Random(frequency)
    ticks = set(rng.sample(range(20_000_000), 9_000)) | set(range(5_000_000, 5_000_400)) | {-70_000, -3, 2**31}
    found = clock.due_ticks(frame(spark, ticks), frequency).orderBy("ts").collect()
    assert [r[0] for r in found] == greedy(ticks, frequency)


def test_due_ticks_of_nothing(spark):
    assert clock.due_ticks(frame(spark, []), 3).collect() == []
    assert [r[0] for r in clock.due_ticks(frame(spark, [0]), 3, skip_tick_zero=True).collect()] == []


def test_next_due_tick(spark):
    ticks = clock.numbered(frame(spark, [5, 70_000, 9, 200_000]))
    points = spark.createDataFrame([(4,), (5,), (10,), (70_001,), (300_000,)], "point long")
    found = {r["point"]: (r["ord"], r["ord_at"]) for r in clock.next_due(points, ticks).collect()}
    assert [found[p] for p in (4, 5, 10, 70_001, 300_000)] == [(1, 5), (1, 5), (3, 70_000), (4, 200_000), (None, None)]


@pytest.mark.parametrize(("width", "block"), [(1, 1 << 16), (6, 1 << 16), (40, 1 << 16), (500, 1 << 16), (40, 4)])
def test_sliding_windows_equal_brute_force(spark, monkeypatch, width, block):
    """Rows at random positions, due ticks at every third or so; a small block stands for a very long window."""
    monkeypatch.setattr(intervals, "BLOCK", block)
    rng = random.Random(width)
    due = sorted(rng.sample(range(-20, 400), 130))
    rows = [(rng.choice(["a", "b", None]), rng.randrange(-30, 390), i) for i in range(120)]
    ordinal = {t: i + 1 for i, t in enumerate(due)}

    def later(x):
        found = [t for t in due if t >= x]
        return (ordinal[found[0]], found[0]) if found else (None, None)

    placed = [(k, p, *later(p), *later(p + width), v, v, v) for k, p, v in rows]
    placed = [r for r in placed if r[2] is not None and (r[4] is None or r[2] < r[4])]
    kinds = "k string, __at long, __in long, __in_at long, __out long, __out_at long, s long, lo long, hi long"
    ticks = spark.createDataFrame([(o, t) for t, o in ordinal.items()], "ord long, ts long")
    merges = {"s": "sum", "lo": "min", "hi": "max"}
    got = sliding_over(spark.createDataFrame(placed, kinds), ["k"], merges, width, ticks, len(due)).collect()
    want = {}
    for t in due:
        for k, p, v in rows:
            if p <= t < p + width:
                s, lo, hi = want.get((t, k), (0, v, v))
                want[t, k] = (s + v, min(lo, v), max(hi, v))
    assert len(got) == len(want)
    assert {(r["ts"], r["k"]): (r["s"], r["lo"], r["hi"]) for r in got} == want


def test_numbers_and_counts(spark):
    ticks = clock.numbered(frame(spark, [5, 70_000, 9, 200_000]))
    assert rows_of(ticks, "ts", "ord") == [(200_000, 4), (5, 1), (70_000, 3), (9, 2)]
    points = spark.createDataFrame([(4,), (5,), (69_999,), (70_000,), (300_000,)], "point long")
    counted = {r["point"]: r["upto"] for r in clock.due_up_to(points, ticks).collect()}
    assert [counted[p] for p in (4, 5, 69_999, 70_000, 300_000)] == [0, 1, 2, 3, 4]


def test_clock_moves_only_with_new_rows(spark):
    rows = spark.createDataFrame(
        [("f1", 3, True), ("f1", 5, False), ("f2", 9, False), ("f3", 2, True)], "f string, ts int, fresh boolean"
    )
    assert rows_of(clock.clock_after_batches(rows, "f", "fresh"), "f", "tick") == [("f1", 5), ("f3", 2)]


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_running_values_do_not_depend_on_the_block(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice(["a", "b", None]), p, rng.choice([None, rng.randint(0, 50)])) for p in range(80)]
    df = spark.createDataFrame(rows, "k string, p long, v long").withColumns({"lo": F.col("v"), "hi": F.col("v")})
    got = running(df, ["k"], "p", {"v": "sum", "lo": "min", "hi": "max"}, next_position="after", block=block)
    for r in got.collect():
        before = [v for k, p, v in rows if k == r["k"] and p <= r["p"] and v is not None]
        later = [p for k, p, _ in rows if k == r["k"] and p > r["p"]]
        assert r["v"] == (sum(before) if before else None)
        assert r["lo"] == (min(before) if before else None)
        assert r["hi"] == (max(before) if before else None)
        assert r["after"] == (min(later) if later else None)


@pytest.mark.parametrize("longest", [1, 6, 200])
def test_ranges_equal_brute_force(spark, longest):
    rng = random.Random(longest)
    ranges = []
    for i in range(60):
        first = rng.randint(1, 90)
        ranges.append((rng.choice("ab"), first, min(90, first + rng.randint(0, longest - 1)), i))
    df = spark.createDataFrame(ranges, "k string, first long, last long, v long").withColumns(
        {"lo": F.col("v"), "n": F.lit(1)}
    )
    ticks = spark.createDataFrame([(i, i * 10) for i in range(1, 91)], "ord long, ts long")
    got = aggregate_over(df, ["k"], "first", "last", {"v": "sum", "lo": "min", "n": "sum"}, ticks, longest)
    want = {}
    for k, first, last, v in ranges:
        for o in range(first, last + 1):
            s, lo, n = want.get((o * 10, k), (0, v, 0))
            want[o * 10, k] = (s + v, min(lo, v), n + 1)
    assert {(r["ts"], r["k"]): (r["v"], r["lo"], r["n"]) for r in got.collect()} == want


def test_long_ranges_are_opened_in_steps(spark):
    ticks = spark.range(1, 140_001).select(F.col("id").alias("ord"), (F.col("id") * 2).alias("ts"))
    df = spark.createDataFrame([("a", 1, 140_000), ("b", 5, 4)], "k string, first long, last long")
    got = repeat_over(df, "first", "last", ticks)
    assert got.agg(F.count("*"), F.min("ts"), F.max("ts"), F.count_distinct("ts")).first()[:] == (
        140_000, 2, 280_000, 140_000)


def test_positions_number_a_total_order(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3 == 0).cast("int").alias("ts"), F.hash("id").alias("pk"), "id")
    got = positioned(df, ["ts", "pk", "id"], "pos").toPandas().sort_values("pos")
    assert got["pos"].tolist() == list(range(1, 5001))
    ordered = got.sort_values(["ts", "pk", "id"])
    assert ordered["pos"].tolist() == list(range(1, 5001))
