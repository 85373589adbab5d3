"""Checks, measures and column tests on small tables."""

import pytest
from pyspark.sql import functions as F

from velolake.operators import quality


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame([("a", 1), ("a", -2), (None, None), ("b", 3)], "k string, v int")


def test_null_keys_count_as_duplicates(keyed):
    row = quality.measure(keyed, n=quality.rows(), d=quality.duplicates("k"), pairs=quality.duplicates("k", "v")).first()
    assert tuple(row) == (4, 2, 1)


def test_repeated_keys_ignore_null(spark, keyed):
    both = keyed.unionByName(spark.createDataFrame([(None, 1)], keyed.schema))
    assert [tuple(row) for row in quality.repeated_keys(both, "k").collect()] == [("a", 2)]


def test_tally_gives_duplicates_and_repeated_keys(spark):
    for ids, expected in (([None, None, "a", "b", "b", "b", "c", "c"], (8, 3, 2)), ([None], (1, 0, 0)), ([], (0, 0, 0))):
        trips = spark.createDataFrame([(i,) for i in ids], "ride_id string")
        tally = quality.key_tally(trips, "ride_id")
        assert tuple(tally.first()) == expected
        assert quality.check_staged_trips(trips, tally=tally).collect() == quality.check_staged_trips(trips).collect()
        tested, tallied = quality.schema_tests({"stg_trips": trips}), quality.schema_tests({"stg_trips": trips}, tallies={("stg_trips", "ride_id"): tally})
        assert tested.collect() == tallied.collect()


def test_merged_measures_are_one_row(keyed):
    merged = quality.merge_measures(
        quality.measure(keyed, rows=quality.rows()), quality.measure(keyed, total=F.sum("v"), negative=quality.count_where(F.col("v") < 0)),
        quality.measure(keyed.where("false"), nothing=F.sum("v")),
    )
    assert [tuple(row) for row in merged.collect()] == [(4, 2, 1, None)]
    assert merged.columns == ["rows", "total", "negative", "nothing"]


def test_undecided_check_fails(keyed):
    measures = quality.measure(keyed.where("false"), total=F.sum("v"), n=quality.rows())
    checks = [quality.equals("t", "sum", "total", "n"), quality.has_rows("t", "n"), quality.is_zero("t", "zero", "n")]
    rows = quality.results("L", measures, checks).collect()
    assert [(r.check_name, r.actual_value, r.expected_value, r.status, r.message) for r in rows] == [
        ("sum", "None", "0", "FAIL", "sum: None"), ("row_count", "0", "> 0", "FAIL", "row_count: 0"), ("zero", "0", "0", "PASS", "zero: 0"),
    ]


def test_column_tests(spark, keyed):
    assert [tuple(r) for r in quality.not_null_violations(keyed, "t", ["k", "v"]).collect()] == [("t", "k", 1), ("t", "v", 1)]
    accepted = quality.accepted_value_violations(keyed, "t", {"k": ("a",)})
    assert [tuple(r) for r in accepted.collect()] == [("t", "k", 1)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert [tuple(r) for r in quality.orphan_rows(keyed, "k", parent, "id").collect()] == [("b", 1)]


def test_gate_without_audit_table(keyed):
    good = quality.results("L", quality.measure(keyed, n=quality.rows()), [quality.has_rows("t", "n")])
    assert [row.status for row in quality.finish_gate("L", good)] == ["PASS"]
    bad = quality.results("L", quality.measure(keyed, n=quality.rows()), [quality.is_zero("t", "none", "n")])
    with pytest.raises(quality.QualityGateError, match="L quality gate FAILED: t.none"):
        quality.finish_gate("L", bad)


def test_dimension_check(keyed):
    rows = quality.check_dimension(keyed, "dim", "k").collect()
    assert [(r.check_name, r.status) for r in rows] == [("row_count", "PASS"), ("k_not_null", "FAIL"), ("k_unique", "FAIL")]


def test_negative_metrics(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, -0.1, 1.0), (0, None, None)], "total_rides long, avg_ride_duration_minutes double, avg_trip_distance_km double")
    assert quality.negative_metrics(df).count() == 1
