"""The typed result table."""

import json

import pytest
from pyspark.sql import functions as F

from bandloom import Metadata, benchmark_table
from bandloom import operators as op
from bandloom.operators.result import RESULT_SCHEMA, arrays_to_text

from .helpers import rows

METADATA = Metadata([0, 0.5, 1], {"tenure": -1, "f": 0}, {"f": [0, 10, 20, 30]})
REQUEST = {
    "PSI": ["score", "total_population"],
    "DRIFT_IN_MB": ["ca/fa"],
    "CSI": "f",
    "FEATURE_RANGE_DRIFT": "f",
    "NULL_RATE": "f",
    "DISTINCT_RATE": "f",
    "SEGMENT_DISTRIBUTION": "tenure",
    "INVALID_SCORE": None,
}


def people(spark):
    return spark.createDataFrame(
        [
            ("A", "N", 1, 0.7, "FINAL_APPROVED", 5.0, 25.0),
            ("A", "N", 2, 0.6, "COND_APPROVED", 9.0, 25.0),
            ("A", "N", 3, None, "COND_APPROVED", 9.0, None),
        ],
        "platform string, user_type string, id long, output_value double, status string, tenure double, f double",
    )


def table(spark, **attributes):
    attributes = {"created_at": "2024-01-02 03:04:05", **attributes}
    return benchmark_table(people(spark), REQUEST, METADATA, "model_x", **attributes)


def test_columns_and_types(spark):
    assert [(f.name, f.dataType) for f in table(spark).schema] == [
        (f.name, f.dataType) for f in RESULT_SCHEMA
    ]


def test_bands_are_in_order_and_empty_ones_are_zero(spark):
    got = {
        (row.metric_name, row.value_name): (
            row.cutpoints,
            row.bin_counts,
            row.categories,
            row.category_count,
            row.total_count,
        )
        for row in table(spark).collect()
    }
    assert got == {
        ("PSI", "score"): ([0, 0.5, 1], [33.333, 0.0, 66.667], None, None, 3.0),
        ("PSI", "total_population"): (None, None, [None, "1", "2"], [1.0, 0.0, 2.0], 3.0),
        ("DRIFT_IN_MB", "ca/fa"): (None, None, [None, "1", "2"], [0.0, 0.0, 1.0], 1.0),
        ("CSI", "f"): ([0, 10, 20, 30], [0.0, 33.3333, 0.0, 66.6667], None, None, 100.0),
        ("FEATURE_RANGE_DRIFT", "f"): (
            [0, 10, 20, 30],
            None,
            [None, "(-inf, 10.0]", "(10.0, 20.0]", "(20.0, inf)"],
            [0.0, 1.0, 0.0, 2.0],
            3.0,
        ),
        ("NULL_RATE", "f"): (None, [1.0], None, None, 3.0),
        ("DISTINCT_RATE", "f"): (None, [1.0], None, None, 3.0),
        ("SEGMENT_DISTRIBUTION", "tenure"): (None, None, ["<6", ">8"], [1.0, 2.0], 3.0),
        ("INVALID_SCORE", "total_population"): (
            None,
            None,
            ["<0", "=0", "0-1", ">=1", "NULL"],
            [0.0, 0.0, 2.0, 0.0, 1.0],
            3.0,
        ),
    }


@pytest.mark.parametrize(
    "edges, labels",
    [
        ([1.0, 2.0], [None, "(-inf, 2.0]", "(2.0, inf)"]),
        ([3.0, 3.0], [None, "(-inf, 3.0]", "(3.0, inf)"]),
        (None, [None, "(-inf, inf)"]),
        ([-1.0, 0.0, 5.0], [None, "(-inf, 0.0]", "(0.0, inf)"]),
    ],
)
def test_ranges_stand_beside_their_counts(spark, edges, labels):
    df = spark.sql("SELECT 'A' AS platform, 'N' AS user_type, double(id) AS f FROM range(4)")
    row = op.to_table(op.feature_shares(df, {"FEATURE_RANGE_DRIFT": ["f"]}, {"f": edges})).first()
    assert row.categories == labels and len(row.category_count) == len(labels) and sum(row.category_count) == 4


def test_run_attributes(spark):
    row = table(
        spark, benchmark_name="b1", start_time="s", end_time="e", tracking_type="WEEKLY", end_date="z"
    ).first()
    assert (row.model_name, row.benchmark_name, row.tracking_type) == ("MODEL_X", "b1", "WEEKLY")
    assert (row.benchmark_start_time, row.benchmark_end_time) == ("s", "e")
    assert (row.start_date, row.end_date, row.is_active) == (None, "z", True)
    assert row.benchmark_created_at == "2024-01-02 03:04:05"
    assert json.loads(row.meta_data)["feature_cuts"] == {"f": [0, 10, 20, 30]}


def test_creation_time_defaults_to_now(spark):
    stamp = table(spark, created_at=None).first().benchmark_created_at
    assert len(stamp) == 19 and stamp[4] == stamp[7] == "-" and stamp[13] == ":"


def test_ids_do_not_hang_on_the_clock_and_keep_odd_keys_apart(spark):
    ids = [rows(table(spark, created_at=x).select("benchmark_id")) for x in (None, "2024-01-02 03:04:05")]
    assert ids[0] == ids[1]
    keys = [("A", None), (None, "A"), ("A|B", None), ("A", "B"), (None, None), ("", None)]
    df = spark.createDataFrame(keys, "a string, b string")
    assert df.select(op.benchmark_id("a", "b")).distinct().count() == len(keys)


def test_ids_are_unique_and_stay_the_same_on_a_rerun(spark):
    first, second = (rows(table(spark).select("benchmark_id")) for _ in range(2))
    assert first == second
    assert len({row[0] for row in first}) == len(REQUEST) + 1
    assert rows(table(spark, benchmark_name="other").select("benchmark_id")) != first


def test_fullest_row_of_a_key_is_kept(spark):
    df = spark.createDataFrame(
        [("a", None, None), ("a", 1, None), ("b", None, 3), ("b", 2, None), (None, 1, 1), (None, None, None)],
        "k string, x int, y int",
    )
    assert rows(op.keep_fullest(df, "k", tie_break="x")) == sorted(
        [("a", 1, None), ("b", 2, None), (None, 1, 1)], key=repr
    )


def test_arrays_as_text(spark):
    df = spark.range(1).select(
        F.array(F.lit(None), F.lit("1")).alias("a"), F.create_map(F.lit("k"), F.lit(2)).alias("m"), "id"
    )
    assert rows(arrays_to_text(df)) == [('[null,"1"]', '{"k":2}', 0)]
