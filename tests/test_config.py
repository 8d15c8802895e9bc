import pytest
from pyspark.sql.types import StructType

from tidemark import ConfigError, QueryConfig, WindowSpec
from tidemark.plans.seeds import METRICS, OCCUPANCY_EXAMPLE, SEEDS
from tidemark.sources.schemas import STREAMS

SCHEMA: StructType = STREAMS["sensor_stream"].schema


def raw(**changes):
    return {
        "query_id": "Q",
        "source": "sensor_stream",
        "filter": {"field": "ts", "operator": "=", "value": "{CURRENT_TICK}"},
        "group_by": ["road_id"],
        "aggregations": [{"name": "s", "operation": "sum", "field": "avg_speed"}],
        **changes,
    }


def one(**changes):
    return [{"name": "s", "operation": "sum", "field": "avg_speed", **changes}]


@pytest.mark.parametrize(
    "config",
    [
        "[]",
        "7",
        raw(group_by="road_id"),
        raw(group_by=["nowhere"]),
        raw(group_by=["road_id; drop"]),
        raw(aggregations=[]),
        raw(aggregations={}),
        raw(aggregations=["sum"]),
        raw(aggregations=one(name="1st")),
        raw(aggregations=one(name=None)),
        raw(aggregations=one(operation="median")),
        raw(aggregations=one(operation="none", field="*")),
        raw(aggregations=one(field="*")),
        raw(aggregations=one(field="nowhere")),
        raw(aggregations=one(field="road_id")),
        raw(aggregations=one(operation="avg", field="road_id")),
        raw(aggregations=one(operation="avg", count_field="nothing")),
        raw(filter="ts = 1"),
        raw(filter=[5]),
        raw(filter={"field": "nowhere", "value": 1}),
        raw(filter={"field": "ts", "operator": "like", "value": 1}),
        raw(summary_updates=[{"target": "t", "source": "s", "operation": "add"}]),
        raw(summary_updates=[{"target": "t", "source": "z", "operation": "max"}]),
        raw(dimension_fields=["nowhere"]),
    ],
)
def test_bad_configs_are_refused(config):
    with pytest.raises(ConfigError):
        QueryConfig.from_dict(config).check(SCHEMA)


def test_all_faults_are_reported_together():
    with pytest.raises(ConfigError) as found:
        QueryConfig.from_dict(raw(group_by="road_id", filter=[5], aggregations=["sum"]))
    assert all(word in str(found.value) for word in ("group_by", "filters", "aggregations"))


def test_wrong_source_is_refused():
    with pytest.raises(ConfigError):
        QueryConfig.from_dict(raw(source="elsewhere")).check(SCHEMA, "sensor_stream")


def test_good_configs_pass():
    for config in (*SEEDS.values(), *METRICS.values()):
        config.check(STREAMS[config.source].schema, config.source)
    QueryConfig.from_dict(OCCUPANCY_EXAMPLE).check(SCHEMA)
    bare = QueryConfig.from_dict({"aggregations": [{"name": "c", "operation": "COUNT"}]}).check(SCHEMA)
    assert bare.group_by == () and bare.filters == () and bare.aggregations[0].field == "*"


def test_one_filter_object_is_a_list_of_one():
    assert len(QueryConfig.from_dict(raw()).filters) == 1
    assert QueryConfig.from_dict(raw(filter={"field": "ts", "value": 3})).filters[0].operator == "="


def test_standard_names():
    config = QueryConfig.from_dict(
        raw(aggregations=[
            {"name": "a", "operation": "avg", "field": "speed"},
            {"name": "b", "operation": "count", "field": "*"},
        ])
    ).with_standard_names()
    assert [(a.name, a.field) for a in config.aggregations] == [("avg_speed_avg", "avg_speed"), ("all_count", "*")]


@pytest.mark.parametrize("bad", [("Hopping", 5, "seconds"), ("Sliding", 0, "seconds"), ("Sliding", 5, "weeks"),
                                 ("Sliding", 5, "seconds", 0)])
def test_window_checks(bad):
    with pytest.raises(ConfigError):
        WindowSpec.checked(*bad)
    assert WindowSpec.checked("Landmark").size == 0
