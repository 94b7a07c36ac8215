"""Band edges, degenerate edge lists, NaN, null and bad text."""

import math
from bisect import bisect_left, bisect_right

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from bandloom.functions.bands import (
    feature_band,
    feature_band_count,
    feature_edges,
    invalid_score_label,
    score_band,
)
from bandloom.functions.sql import number
from bandloom.functions.segments import segment_label, segment_value

from .helpers import one_column

NAN, INF = math.nan, math.inf


def doubles(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")


def apply(spark, values, make):
    df = doubles(spark, values).withColumn("out", make(F.col("v")))
    return one_column(df.orderBy("i").select("out"))


def test_score_bands_are_closed_on_the_left(spark):
    values = [-0.1, 0.0, 0.25, 0.5, 0.999, 1.0, 1.5, NAN, None, INF, -INF]
    got = apply(spark, values, lambda v: score_band("v", [0, 0.5, 1]))
    assert got == [None, 1, 1, 2, 2, None, None, None, None, None, None]


def test_score_equal_to_the_last_cut_can_be_included(spark):
    values = [0.5, 1.0, 1.1, NAN, None]
    got = apply(spark, values, lambda v: score_band("v", [0, 0.5, 1], include_last=True))
    assert got == [2, 2, None, None, None]


def test_repeated_score_cut_leaves_its_band_empty(spark):
    assert apply(spark, [0.0, 0.5], lambda v: score_band("v", [0, 0, 1])) == [2, 2]


@pytest.mark.parametrize("cuts", [[], [0.5], [1, 0], [0, NAN]])
def test_bad_score_cuts_are_errors(cuts):
    with pytest.raises(ValueError):
        score_band("v", cuts)


@pytest.mark.parametrize(
    "edges, values, bands",
    [
        ([0, 10, 20, 30], [-5, 10, 10.5, 20, 25, 99, NAN, None], [1, 1, 2, 2, 3, 3, 3, None]),
        ([30, 0, 20, 10, 10, None], [-5, 10, 10.5, 20, 25], [1, 1, 2, 2, 3]),
        ([0, 10, 20], [10, 10.1, NAN], [1, 2, 2]),
        ([0, 10], [-1, 0, 5, 10, 11, None], [1, 1, 1, 1, 2, None]),
        ([5, 5], [4, 5, 6, NAN], [1, 1, 2, 2]),
        ([5, None], [5, 6], [1, 2]),
        ([5], [4, 6, NAN, None], [1, 1, 1, None]),
        ([], [4, None], [1, None]),
        (None, [4, None], [1, None]),
        ([-INF, 0, INF], [-1, 0, 1], [1, 1, 2]),
    ],
)
def test_feature_bands(spark, edges, values, bands):
    got = apply(spark, [None if v is None else float(v) for v in values], lambda v: feature_band("v", edges))
    assert got == bands
    assert max((band for band in bands if band), default=1) <= feature_band_count(edges)


def test_edges_that_are_all_null_are_an_error():
    with pytest.raises(ValueError, match="all feature edges are null"):
        feature_edges([None, None])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    edges=st.lists(st.floats(-100, 100), min_size=3, max_size=40, unique=True),
    values=st.lists(st.floats(-120, 120), min_size=1, max_size=30),
)
def test_bands_equal_a_search_in_the_sorted_edges(spark, edges, values):
    edges = sorted(edges)
    values = values + edges
    scores = apply(spark, values, lambda v: score_band("v", edges))
    inside = range(1, len(edges))
    assert scores == [b if (b := bisect_right(edges, v)) in inside else None for v in values]
    features = apply(spark, values, lambda v: feature_band("v", edges))
    assert features == [bisect_left(edges[1:-1], v) + 1 for v in values]
    in_order = [band for _, band in sorted(zip(values, features))]
    assert in_order == sorted(in_order)


def test_every_score_has_one_validity_label(spark):
    values = [None, -0.1, 0.0, -0.0, 0.5, 1.0, 2.0, NAN]
    got = apply(spark, values, lambda v: invalid_score_label("v"))
    assert got == ["NULL", "<0", "=0", "=0", "0-1", ">=1", ">=1", ">=1"]


def test_bad_text_is_no_number(spark):
    df = spark.createDataFrame([("abc",), ("1.5",), (None,)], "v string")
    assert one_column(df.selectExpr(number("v"))) == [None, 1.5, None]


@pytest.mark.parametrize(
    "name, values, labels",
    [
        ("employment_type", [None, " ", "none", "", "salaried"], ["NA", "NA", "NA", "", "salaried"]),
        ("bureau_score", ["719.9", "720", "749", "750", "n/a", "NaN"], ["<720", "[720,750)", "[720,750)", "750+", "NA", "750+"]),
        ("tenure", ["5", "6", "8", "8.5", None], ["<6", "6-8", "6-8", ">8", "NA"]),
        ("bureau_vintage", ["11", "12", "60", "61"], ["<12", "12-60", "12-60", ">60"]),
        ("no_of_cc_loan_entries", ["0", "1", "2", "0.5", "-1"], ["No CC", "1CC", "1+CC", "NA", "NA"]),
        ("active_cc_count", ["0", "1", "x"], ["<1", "1 or 1+", "NA"]),
        ("active_pl_count", ["0", "1", "5", "6"], ["<1", "1-5", "1-5", ">5"]),
        ("unsecured_enquiries_in_last_1_mon", ["0", "1", "10", "11"], ["<1", "1-10", "1-10", "10+"]),
        ("months_since_last_90_dpd", ["0", "1", "12", "13"], ["<1", "1-12", "1-12", "12+"]),
    ],
)
def test_segment_labels(spark, name, values, labels):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, {name} string")
    values = df.orderBy("i").selectExpr(f"{segment_value(name)} AS {name}")
    assert one_column(values.select(segment_label(name))) == labels


def test_segment_name_ignores_case_and_unknown_names_are_errors(spark):
    df = spark.createDataFrame([(7.0,)], "Tenure double")
    assert one_column(df.select(segment_label("Tenure"))) == ["6-8"]
    with pytest.raises(ValueError, match="no segment rule"):
        segment_label("shoe_size")
