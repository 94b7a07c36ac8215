"""Metrics on small populations, counted by hand or by brute force."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bandloom import Metadata, benchmark_long
from bandloom import operators as op
from bandloom.functions.bands import feature_band, score_band
from bandloom.functions.columns import equals_fill
from bandloom.plans.request import expand_metrics, normalise_metrics

from .helpers import rows

NAN = math.nan
CUTS = [0.0, 0.5, 1.0]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            ("A", "N", 1, 0.1, "FINAL_APPROVED"),
            ("A", "N", 2, 0.2, "COND_APPROVED"),
            ("A", "N", 3, 0.7, "DENIED_1"),
            ("A", "N", 4, 1.0, "DENIED_2"),
            ("A", "N", None, None, "final_approved"),
            ("B", "R", 6, NAN, None),
            ("B", "R", 7, 0.6, "FINAL_APPROVED"),
        ],
        "platform string, user_type string, id long, output_value double, status string",
    )


def pick(df, *columns):
    return rows(df.select(*columns))


def test_shares_counts_and_totals(people):
    long = op.score_metrics(people, CUTS, {"PSI": ["score", "total_population"]})
    got = pick(long, "platform", "value_name", "band_no", "cnt", "metric_value", "total")
    assert got == sorted(
        [
            ("A", "score", None, 1, 25.0, 4.0),
            ("A", "score", 1, 2, 50.0, 4.0),
            ("A", "score", 2, 1, 25.0, 4.0),
            ("A", "total_population", None, 1, 1.0, 4.0),
            ("A", "total_population", 1, 2, 2.0, 4.0),
            ("A", "total_population", 2, 1, 1.0, 4.0),
            ("B", "score", None, 1, 50.0, 2.0),
            ("B", "score", 2, 1, 50.0, 2.0),
            ("B", "total_population", None, 1, 1.0, 2.0),
            ("B", "total_population", 2, 1, 1.0, 2.0),
        ],
        key=repr,
    )


def test_status_counts_compare_with_case_and_ratios_guard_zero(people):
    long = op.score_metrics(people, CUTS, {"DRIFT_IN_MB": ["fa", "ca/fa", "d1/fa"]})
    a = pick(long.filter("platform = 'A'"), "value_name", "band_no", "metric_value", "total")
    assert a == sorted(
        [
            ("fa", None, 0.0, 1.0),
            ("fa", 1, 1.0, 1.0),
            ("fa", 2, 0.0, 1.0),
            ("ca/fa", None, 0.0, 1.0),
            ("ca/fa", 1, 1.0, 1.0),
            ("ca/fa", 2, 0.0, 1.0),
            ("d1/fa", None, 0.0, 0.0),
            ("d1/fa", 1, 0.0, 0.0),
            ("d1/fa", 2, 0.0, 0.0),
        ],
        key=repr,
    )


def test_shares_need_no_status_column(people):
    assert op.score_metrics(people.drop("status"), CUTS, {"PSI": ["score"]}).count() == 5
    with pytest.raises(ValueError, match="status"):
        op.score_metrics(people.drop("status"), CUTS, {"PSI": ["fa"]})


def test_a_population_without_ids_has_no_shares(spark):
    df = spark.createDataFrame(
        [("A", "N", None, 0.1)], "platform string, user_type string, id long, output_value double"
    )
    long = op.score_metrics(df, CUTS, {"PSI": ["score"]})
    assert pick(long, "band_no", "cnt", "metric_value") == [(1, 0, None)]


def test_unknown_score_value_is_an_error(people):
    with pytest.raises(ValueError, match="unknown score values"):
        op.score_metrics(people, CUTS, {"PSI": ["fraud"]})


def test_scores_given_as_text(spark):
    df = spark.createDataFrame(
        [("A", "N", 1, "0.1"), ("A", "N", 2, "oops")],
        "platform string, user_type string, id long, output_value string",
    )
    assert pick(op.score_metrics(df, CUTS, {"PSI": ["score"]}), "band_no", "cnt") == [(1, 1), (None, 1)]
    labels = {row[0]: row[1] for row in pick(op.invalid_scores(df), "band_label", "cnt")}
    assert labels == {"<0": 0, "=0": 0, "0-1": 1, ">=1": 0, "NULL": 1}


def test_every_validity_label_appears(people):
    got = pick(op.invalid_scores(people), "platform", "band_no", "band_label", "cnt", "total")
    assert [row for row in got if row[0] == "B"] == [
        ("B", 1, "<0", 0, 2.0),
        ("B", 2, "=0", 0, 2.0),
        ("B", 3, "0-1", 1, 2.0),
        ("B", 4, ">=1", 1, 2.0),
        ("B", 5, "NULL", 0, 2.0),
    ]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(
        [
            ("A", "N", 1, 1.5, "x", 2**53 + 1, True),
            ("A", "N", 1, NAN, "x", 2**53, None),
            ("A", "N", None, -0.0, "7", 2**53, False),
            ("A", "N", -1, 0.0, None, None, False),
        ],
        "platform string, user_type string, whole int, real double, txt string, big long, flag boolean",
    )


def test_feature_bands_of_mixed_types_with_fills(mixed):
    cuts = {"whole": [0, 1], "real": [0, 1, 2], "txt": [0, 5, 10], "flag": None}
    fills = {"whole": -1.5, "real": 9.0}
    counts = op.feature_shares(mixed, {"FEATURE_RANGE_DRIFT": list(cuts)}, cuts, fills)
    assert pick(counts, "value_name", "band_no", "cnt", "n_bands") == sorted(
        [
            ("whole", 1, 4, 2),
            ("real", 1, 2, 2),
            ("real", 2, 2, 2),
            ("txt", 2, 1, 2),
            ("txt", None, 3, 2),
            ("flag", 1, 3, 1),
            ("flag", None, 1, 1),
        ],
        key=repr,
    )


def test_only_asked_metrics_and_features_are_returned(mixed):
    cuts = {"whole": [0, 1], "real": [0, 1, 2]}
    long = op.feature_shares(mixed, {"CSI": ["real"], "FEATURE_RANGE_DRIFT": ["whole"]}, cuts)
    got = pick(long, "metric_name", "value_name", "band_no", "metric_value", "total")
    assert got == sorted(
        [
            ("CSI", "real", 1, 50.0, 100.0),
            ("CSI", "real", 2, 50.0, 100.0),
            ("FEATURE_RANGE_DRIFT", "whole", None, 1.0, 4.0),
            ("FEATURE_RANGE_DRIFT", "whole", 1, 3.0, 4.0),
        ],
        key=repr,
    )


def test_null_rate_counts_nulls_and_fills_of_every_type(mixed):
    fills = {"whole": 1, "real": NAN, "txt": "x", "big": 2**53, "flag": 1.0}
    got = pick(op.null_rates(mixed, list(fills), fills), "value_name", "cnt", "total")
    assert got == [
        ("big", 3, 4.0),
        ("flag", 2, 4.0),
        ("real", 1, 4.0),
        ("txt", 3, 4.0),
        ("whole", 3, 4.0),
    ]


def test_a_number_fill_is_found_in_text(mixed):
    assert mixed.filter(equals_fill(mixed, "txt", 7)).count() == 1


def test_distinct_counts_keep_types_apart(mixed):
    names = ["whole", "real", "txt", "big", "flag"]
    got = pick(op.distinct_rates(mixed, names), "value_name", "cnt", "total")
    assert got == [
        ("big", 2, 4.0),
        ("flag", 2, 4.0),
        ("real", 3, 4.0),
        ("txt", 2, 4.0),
        ("whole", 2, 4.0),
    ]


def test_many_features_at_once(spark):
    names = [f"f{i}" for i in range(20)]
    df = spark.range(50).select(
        F.lit("A").alias("platform"),
        F.lit("N").alias("user_type"),
        *[((F.col("id") + i) % 10).cast("double").alias(name) for i, name in enumerate(names)],
    )
    cuts = {name: [0.0, 4.0, 9.0] for name in names}
    counts = op.feature_shares(df, {"FEATURE_RANGE_DRIFT": names}, cuts)
    assert pick(counts, "value_name", "band_no", "cnt") == sorted(
        [row for name in names for row in ((name, 1, 25), (name, 2, 25))], key=repr
    )
    assert op.null_rates(df, names, dict.fromkeys(names, 3)).filter("cnt = 5").count() == 20
    assert op.distinct_rates(df, names).filter("cnt = 10").count() == 20


def test_edges_as_data_give_the_bands_of_the_single_column_functions(spark):
    """A thousand edges, edges that repeat, infinite ones, NaN and null, on both sides of every edge."""
    many = [round(i / 7, 6) for i in range(1000)]
    values = [None, NAN, math.inf, -math.inf, -0.0, *many[::37], *(x + 1e-7 for x in many[::41]), 142.8, 1e9]
    df = spark.createDataFrame(
        [("A", "N", i, x, x) for i, x in enumerate(values)],
        "platform string, user_type string, id long, f double, output_value double",
    )
    for edges in (many, [0.0, 1.0], [3.0, None, 3.0], [5.0, 1.0, 1.0, 2.0, math.inf, -math.inf], None):
        want = df.groupBy(feature_band("f", edges).alias("b")).count()
        got = op.feature_shares(df, {"FEATURE_RANGE_DRIFT": ["f"]}, {"f": edges})
        assert pick(got, "band_no", "cnt") == pick(want, "b", "count")
    for cuts in (many, [0.0, 0.0, 1.0], [-math.inf, 0.0, math.inf]):
        for last in (False, True):
            want = df.groupBy(score_band("f", cuts, last).alias("b")).count()
            got = op.score_metrics(df, cuts, {"PSI": ["total_population"]}, include_last=last)
            assert pick(got, "band_no", "cnt") == pick(want, "b", "count")


def test_one_population_and_one_value_may_hold_most_rows(spark):
    """Brute force over a population where a third of the rows share key, band and label."""
    random.seed(7)
    data = []
    for i in range(6000):
        hot = i % 3 == 0
        data.append(
            (
                "A" if hot else random.choice("ABC"),
                "N" if hot else random.choice("NR"),
                i,
                0.25 if hot else random.uniform(-0.5, 1.5),
                "FINAL_APPROVED" if hot else random.choice(["COND_APPROVED", "DENIED_1", "x"]),
                7.0 if hot else random.choice([None, random.uniform(0, 12)]),
            )
        )
    df = spark.createDataFrame(
        data,
        "platform string, user_type string, id long, output_value double, status string, tenure double",
    )
    metadata = Metadata([0, 0.25, 0.5, 1], {"tenure": -1}, {"tenure": [0, 3, 6, 9, 12]})
    request = {
        "PSI": ["total_population"],
        "DRIFT_IN_MB": ["fa"],
        "FEATURE_RANGE_DRIFT": ["tenure"],
        "SEGMENT_DISTRIBUTION": ["tenure"],
        "DISTINCT_RATE": ["tenure"],
        "NULL_RATE": ["tenure"],
    }
    expected = defaultdict(Counter)
    distinct = defaultdict(set)
    for platform, user, _, score, status, tenure in data:
        where = (platform, user)
        band = next((b for b, (lo, hi) in enumerate([(0, 0.25), (0.25, 0.5), (0.5, 1)], 1) if lo <= score < hi), None)
        expected["PSI"][(*where, band and str(band))] += 1
        expected["DRIFT_IN_MB"][(*where, band and str(band))] += status == "FINAL_APPROVED"
        filled = -1 if tenure is None else tenure
        feature_band = 1 + sum(filled > edge for edge in (3, 6, 9))
        expected["FEATURE_RANGE_DRIFT"][(*where, str(feature_band))] += 1
        label = "NA" if tenure is None else "<6" if tenure < 6 else "6-8" if tenure <= 8 else ">8"
        expected["SEGMENT_DISTRIBUTION"][(*where, label)] += 1
        expected["NULL_RATE"][(*where, None)] += tenure is None
        distinct[where].update([] if tenure is None else [tenure])
    for where, values in distinct.items():
        expected["DISTINCT_RATE"][(*where, None)] = len(values)
    got = defaultdict(dict)
    long = benchmark_long(df, request, metadata)
    for row in long.collect():
        got[row.metric_name][(row.platform, row.user_type, row.band_label)] = row.cnt
    assert got == {metric: dict(counts) for metric, counts in expected.items()}


def test_wanted_populations_only_and_empty_ones_give_nothing(people):
    metadata = Metadata(CUTS)
    long = benchmark_long(people, {"INVALID_SCORE": None}, metadata, platforms="B", user_types=["R", "N"])
    assert {tuple(row) for row in long.select("platform", "user_type").collect()} == {("B", "R")}
    none = benchmark_long(people, {"PSI": "score"}, metadata, platforms="C")
    assert none.collect() == []


def test_requests_are_normalised():
    metadata = Metadata([0, 1], {"F1": 0, "F2": 0}, {"F1": [1, 2]})
    assert normalise_metrics("PSI", "score") == {"PSI": ["score"]}
    assert normalise_metrics("PSI", "score", {"CSI": ["f1"]}) == {"CSI": ["f1"]}
    for word in ("all_features", ["all_features"]):
        assert expand_metrics({"null_rate": word}, metadata) == {"NULL_RATE": ["f1", "f2"]}
    assert expand_metrics({"CSI": "all_features"}, metadata) == {"CSI": ["f1"]}
    assert expand_metrics({"CSI": ["F1", "f1"]}, metadata) == {"CSI": ["f1"]}
    assert expand_metrics({"INVALID_SCORE": "anything"}, metadata) == {"INVALID_SCORE": ["total_population"]}
    assert expand_metrics({"SEGMENT_DISTRIBUTION": "Tenure"}, metadata) == {"SEGMENT_DISTRIBUTION": ["Tenure"]}


@pytest.mark.parametrize(
    "request_", [{"KPI": "x"}, {"PSI": "fraud"}, {"CSI": "f2"}, {"SEGMENT_DISTRIBUTION": "shoe"}, {"PSI": []}]
)
def test_names_without_a_rule_raise_or_are_skipped(request_):
    metadata = Metadata([0, 1], {"f1": 0}, {"f1": [1, 2]})
    with pytest.raises(ValueError):
        expand_metrics(request_, metadata)
    if "KPI" not in request_:
        assert expand_metrics(request_, metadata, "skip") == {}


def test_metadata_names_must_stay_apart():
    with pytest.raises(ValueError, match="twice"):
        Metadata(fills={"a": 1, "A": 2})
