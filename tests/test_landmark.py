"""Beginning-to-now results against hand-computed cases and a plain Python fold."""

import random

import pytest
from conftest import rows_of

from tidemark import Aggregation, Filter, QueryConfig, SummaryUpdate, WindowSpec, run_query, run_tick
from tidemark.operators import evaluate
from tidemark.config import CURRENT_TICK, DerivedMetric
from tidemark.operators.clock import ticks_of
from tidemark.operators.landmark import merge_snapshots

NOW = Filter("ts", "=", CURRENT_TICK)
ALL = (
    Aggregation("s", "sum", "avg_speed"),
    Aggregation("c", "count", "*"),
    Aggregation("a", "avg", "avg_speed"),
    Aggregation("n", "min", "avg_speed"),
    Aggregation("x", "max", "avg_speed"),
    Aggregation("v", "none", "avg_speed"),
)
NAMES = [a.name for a in ALL]


def config(*aggregations, by=("road_id",), filters=(NOW,), **extra):
    return QueryConfig("Q", "sensor_stream", aggregations or ALL, by, filters, **extra)


def test_count_so_far_grows_by_the_new_event(spark):
    rows = spark.createDataFrame(
        [("e1", "Emergency", 1), ("e2", "Emergency", 1), ("e3", "Emergency", 2)],
        "event_id string, event_type string, ts int",
    )
    query = QueryConfig("Q", "event_stream", (Aggregation("c", "count", "*"),), ("event_type",), (NOW,))
    assert rows_of(run_query(rows, query, "changed"), "ts", "c") == [(1, 2), (2, 3)]


def test_every_operation_merges(sensor):
    rows = sensor(("A", 1, 10.0), ("A", 1, 20.0), ("A", 2, 60.0))
    for mode in ("snapshot", "changed", "history"):
        found = rows_of(run_query(rows, config(), mode), *NAMES)
        assert (90.0, 3, 30.0, 10.0, 60.0, 60.0) in found


def test_latest_value_replaces_a_larger_one(sensor):
    rows = sensor(("A", 1, 9.0), ("A", 2, 5.0), ("A", 2, 4.0))
    assert rows_of(run_query(rows, config()), "x", "v") == [(9.0, 5.0)]


def test_groups_are_carried_forward(sensor):
    rows = sensor(("A", 1, 1.0), ("B", 2, 2.0), ("A", 3, 4.0))
    dense = run_query(rows, config(), "history")
    assert rows_of(dense, "ts", "road_id", "s") == [
        (1, "A", 1.0), (2, "A", 1.0), (2, "B", 2.0), (3, "A", 5.0), (3, "B", 2.0),
    ]
    sparse = run_query(rows, config(), "changed")
    assert rows_of(sparse, "ts", "road_id", "s") == [(1, "A", 1.0), (2, "B", 2.0), (3, "A", 5.0)]


def test_a_tick_without_rows_repeats_the_snapshot(spark, sensor):
    rows = sensor(("A", 1, 1.0), ("A", 4, 2.0))
    ticks = spark.createDataFrame([(0,), (1,), (2,), (4,), (5,)], "ts int")
    dense = run_query(rows, config(), "history", clock=ticks)
    assert rows_of(dense, "ts", "s") == [(1, 1.0), (2, 1.0), (4, 3.0), (5, 3.0)]


def test_a_query_without_keys_has_a_row_at_every_tick(spark, sensor):
    rows = sensor(("A", 3, 1.0), ("A", 4, 2.0))
    ticks = spark.createDataFrame([(1,), (3,), (4,), (6,)], "ts int")
    dense = run_query(rows, config(by=()), "history", clock=ticks)
    assert rows_of(dense, "ts", "s", "c", "a", "n") == [
        (1, 0.0, 0, 0.0, None), (3, 1.0, 1, 1.0, 1.0), (4, 3.0, 2, 1.5, 1.0), (6, 3.0, 2, 1.5, 1.0),
    ]


def test_only_rows_at_due_ticks_count(sensor):
    rows = sensor(*(("A", t, 1.0) for t in (1, 2, 3, 7, 8, 9, 10, 14, 15)))
    found = run_query(rows, config(), "changed", frequency=3)
    assert rows_of(found, "ts", "c") == [(1, 1), (10, 3), (14, 4), (7, 2)]
    assert rows_of(run_query(rows, config(), frequency=3), "c") == [(4,)]


def test_tick_zero_can_be_left_out(sensor):
    rows = sensor(("A", 0, 1.0), ("A", 1, 2.0))
    assert rows_of(run_query(rows, config()), "s") == [(3.0,)]
    assert rows_of(run_query(rows, config(), skip_tick_zero=True), "s") == [(2.0,)]


def test_nulls_are_ignored(sensor):
    rows = sensor(("A", 1, None), ("A", 2, None), ("B", 1, None), ("B", 2, 5.0))
    found = rows_of(run_query(rows, config()), "road_id", "s", "a", "n", "x", "v", "c")
    assert found == [("A", 0.0, 0.0, None, None, None, 2), ("B", 5.0, 5.0, 5.0, 5.0, 5.0, 2)]


def test_null_group_keys_are_a_group(sensor):
    rows = sensor((None, 1, 1.0), (None, 2, 2.0), ("A", 1, 3.0))
    found = rows_of(run_query(rows, config(), "history"), "ts", "road_id", "s")
    assert found == [(1, "A", 3.0), (1, None, 1.0), (2, "A", 3.0), (2, None, 3.0)]


def test_summary_updates_and_derived_metrics(sensor):
    rows = sensor(("A", 1, 10.0), ("A", 1, 20.0), ("A", 2, 6.0), ("B", 2, 0.0, 0))
    query = config(
        Aggregation("s", "sum", "avg_speed"), Aggregation("c", "count", "*"),
        Aggregation("veh", "sum", "vehicle_count"),
        summary_updates=(
            SummaryUpdate("total", "s", "increment"),
            SummaryUpdate("best_tick", "s", "max"),
            SummaryUpdate("last_tick", "s", "replace"),
        ),
        derived_metrics=(DerivedMetric("mean", "total / c"), DerivedMetric("per_vehicle", "s / veh")),
    )
    for mode in ("snapshot", "history"):
        found = rows_of(
            run_query(rows, query, mode), "road_id", "total", "best_tick", "last_tick", "mean", "per_vehicle"
        )
        assert ("A", 36.0, 30.0, 6.0, 12.0, 12.0) in found
        assert ("B", 0.0, 0.0, 0.0, 0.0, None) in found


def test_companions_supply_shared_targets(sensor):
    rows = sensor(("A", 1, 10.0), ("A", 2, 20.0))
    speed = config(Aggregation("c_pkt", "count", "*"), summary_updates=(SummaryUpdate("pkts", "c_pkt", "increment"),))
    occ = config(Aggregation("s_occ", "sum", "occupancy"), derived_metrics=(DerivedMetric("mean", "s_occ / pkts"),))
    found = run_query(rows, occ, companions=[speed])
    assert found.columns == ["road_id", "s_occ", "mean"]
    assert rows_of(found, "mean") == [(1.0,)]


def test_grouping_by_the_tick_column(sensor):
    rows = sensor(("A", 1, 1.0), ("B", 2, 2.0))
    found = run_query(rows, config(Aggregation("s", "sum", "avg_speed"), by=("ts",)), "history")
    assert rows_of(found, "ts", "ts_key", "s") == [(1, 1, 1.0), (2, 1, 1.0), (2, 2, 2.0)]


# --- against a plain fold -----------------------------------------------------------------------

def fold(rows, due):
    """The running result tick by tick, as a dictionary per (tick, group)."""
    state, out = {}, {}
    for tick in due:
        for group in {r[0] for r in rows if r[1] == tick}:
            values = [r[2] for r in rows if r[0] == group and r[1] == tick]
            old = state.get(group, (0, 0, None, None, None))
            state[group] = (
                old[0] + sum(values), old[1] + len(values),
                min(values) if old[2] is None else min(old[2], *values),
                max(values) if old[3] is None else max(old[3], *values),
                max(values),
            )
        for group, (s, c, n, x, v) in state.items():
            out[tick, group] = (s, c, s / c, n, x, v)
    return out


def greedy(ticks, frequency):
    due = []
    for t in sorted(ticks):
        if not due or t - due[-1] >= frequency:
            due.append(t)
    return due


@pytest.mark.parametrize("seed,frequency", [(1, 1), (2, 1), (3, 4)])
def test_history_equals_a_fold(sensor, seed, frequency):
    rng = random.Random(seed)
    rows = [(rng.choice("ABCD"), rng.randint(0, 200000), float(rng.randint(1, 99))) for _ in range(120)]
    rows += [(rng.choice("AB"), rng.randint(0, 40), float(rng.randint(1, 99))) for _ in range(60)]
    want = fold(rows, greedy({r[1] for r in rows}, frequency))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    found = run_query(sensor(*shuffled), config(), "history", frequency=frequency).collect()
    got = {(r["ts"], r["road_id"]): tuple(r[n] for n in NAMES) for r in found}
    assert got.keys() == want.keys()
    for at, (s, c, a, n, x, v) in want.items():
        assert got[at] == pytest.approx((s, c, a, n, x, v))


@pytest.mark.parametrize("unit,size", [("seconds", 3), ("seconds", 50), ("packets", 4), ("events", 25), ("packets", 40)])
@pytest.mark.parametrize("merge", [False, True])
def test_retained_windows_equal_brute_force(sensor, unit, size, merge, monkeypatch):
    monkeypatch.setattr(evaluate, "PRUNED", 30)
    rng = random.Random(size)
    rows = [(rng.choice("ABC"), rng.randint(0, 60), float(rng.randint(1, 99))) for _ in range(90)]
    query = config(ALL[0], ALL[1], ALL[3], ALL[4], filters=())
    found = run_query(
        sensor(*rows), query, "history", window=WindowSpec("Sliding", size, unit), merge=merge, key="pkt_id"
    ).collect()
    ordered = [r[1:] for r in sorted((r[1], f"p{i:04d}", r[0], r[2]) for i, r in enumerate(rows))]
    ticks = sorted({r[1] for r in rows})
    ticked = sorted((r[1], f"p{i:04d}", r[0], r[2]) for i, r in enumerate(rows))
    want, state = {}, {}
    for t in ticks:
        seen = [r for r in ticked if r[0] <= t]
        kept = [r for r in seen if r[0] >= t - size] if unit == "seconds" else seen[-size:]
        now = {}
        for _, _, road, speed in kept:
            now.setdefault(road, []).append(speed)
        for road, values in now.items():
            one = (sum(values), len(values), min(values), max(values))
            old = state.get(road)
            state[road] = one if old is None else (
                old[0] + one[0], old[1] + one[1], min(old[2], one[2]), max(old[3], one[3])
            )
            if not merge:
                want[t, road] = one
        if merge:
            want |= {(t, road): value for road, value in state.items()}
    assert len(ordered) == len(rows)
    got = {(r["ts"], r["road_id"]): (r["s"], r["c"], r["n"], r["x"]) for r in found}
    assert got == want


def test_window_results_with_and_without_merge(sensor):
    rows = sensor(*(("A", t, 1.0) for t in (1, 2, 3, 4)))
    query = config(Aggregation("s", "sum", "avg_speed"), filters=())
    window = WindowSpec("Sliding", 2, "seconds")
    assert rows_of(run_query(rows, query, "history", window=window, merge=False), "ts", "s") == [
        (1, 1.0), (2, 2.0), (3, 3.0), (4, 3.0)]
    assert rows_of(run_query(rows, query, "history", window=window), "ts", "s") == [
        (1, 1.0), (2, 3.0), (3, 6.0), (4, 9.0)]


@pytest.mark.parametrize("operator", ["=", "<", "<=", ">", ">=", "!=", "<>"])
@pytest.mark.parametrize("field", ["ts", "vehicle_count"])
def test_filters_on_the_current_tick_equal_brute_force(sensor, operator, field):
    import operator as op

    compare = {"=": op.eq, "<": op.lt, "<=": op.le, ">": op.gt, ">=": op.ge, "!=": op.ne, "<>": op.ne}[operator]
    rng = random.Random(7)
    rows = [(rng.choice("AB"), rng.randint(0, 30), 1.0, rng.randint(0, 40)) for _ in range(60)]
    query = config(Aggregation("c", "count", "*"), filters=(Filter(field, operator, CURRENT_TICK),))
    frame = sensor(*rows)
    found = run_query(frame, query, "history", merge=False)
    want = {}
    for t in {r[1] for r in rows}:
        for road, ts, _, count in rows:
            if ts <= t and compare(ts if field == "ts" else count, t):
                want[t, road] = want.get((t, road), 0) + 1
    assert {(r["ts"], r["road_id"]): r["c"] for r in found.collect()} == want
    assert ticks_of(frame).count() == len({r[1] for r in rows})


def test_folding_ticks_one_by_one_gives_the_snapshot(sensor):
    rows = sensor(("A", 1, 10.0), ("A", 1, 20.0), ("B", 2, 3.0), ("A", 3, 60.0), ("C", 3, None))
    state = run_tick(rows, config(), 1)
    for tick in (2, 3):
        state = merge_snapshots(state, run_tick(rows, config(), tick), config())
    want = run_query(rows, config())
    assert rows_of(state, "road_id", *NAMES) == rows_of(want, "road_id", *NAMES)
    assert rows_of(state, "__count_a") == [(0,), (1,), (3,)]


def test_merge_keeps_other_columns_of_the_older_side(spark):
    query = config(Aggregation("c", "count", "*"), Aggregation("v", "none", "avg_speed"))
    old = spark.createDataFrame([("A", 2, 1.0, "old"), ("B", 1, 1.0, None)], "road_id string, c int, v double, note string")
    new = spark.createDataFrame([("A", 1, None, "new"), ("B", 1, 5.0, "new"), ("C", 4, 2.0, "new")],
                                "road_id string, c int, v double, note string")
    assert rows_of(merge_snapshots(old, new, query), "road_id", "c", "v", "note") == [
        ("A", 3, None, "old"), ("B", 2, 5.0, "new"), ("C", 4, 2.0, "new")]


def test_one_tick_sees_what_the_stream_holds(sensor):
    rows = sensor(*(("A", t, float(t)) for t in range(1, 9)))
    query = config(Aggregation("s", "sum", "avg_speed"), filters=())
    assert rows_of(run_tick(rows, query, 6, window=WindowSpec("Sliding", 2, "seconds")), "s") == [(15.0,)]
    assert rows_of(run_tick(rows, query, 6, window=WindowSpec("Sliding", 2, "events"), key="pkt_id"), "s") == [(11.0,)]
    assert rows_of(run_tick(rows, config(ALL[0]), 6), "s") == [(6.0,)]
    assert rows_of(run_tick(rows, config(ALL[0], ALL[1], by=()), 99), "s", "c") == [(0.0, 0)]


def test_a_row_window_outlasts_many_empty_ticks(spark, sensor):
    rows = sensor(("A", 1, 1.0), ("A", 2, 2.0), ("A", 50, 4.0))
    ticks = spark.createDataFrame([(t,) for t in range(1, 61)], "ts int")
    query = config(Aggregation("s", "sum", "avg_speed"), filters=())
    found = run_query(rows, query, "history", window=WindowSpec("Sliding", 2, "packets"), merge=False,
                      key="pkt_id", clock=ticks)
    want = {t: 1.0 if t == 1 else 3.0 if t < 50 else 6.0 for t in range(1, 61)}
    assert {r["ts"]: r["s"] for r in found.collect()} == want
