"""What Spark is asked to do: scans, shuffles, and nothing on the driver."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import queries as named
from bandloom import Metadata, SourceTables, benchmark_long, build_population
from bandloom import operators as op
from bandloom.plans.request import required_columns
from checks.standin import METADATA

from .conftest import ROOT
from .helpers import plan_of

QUERIES = named.queries()


@pytest.fixture
def shuffled(spark):
    """Joins as they are on large tables: no side is broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def population(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "population")
    spark.range(100).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("platform"),
        F.lit("N").alias("user_type"),
        "id",
        (F.col("id") / 100).alias("output_value"),
        F.lit("FINAL_APPROVED").alias("status"),
        *[(F.col("id") % n).cast("double").alias(f"f{n}") for n in range(2, 30)],
    ).write.parquet(path)
    return spark.read.parquet(path)


def scans(plan: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def scans_run(df):
    """How many times tables are scanned when the query runs, reused results counted once."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    final = plan.toString()
    assert "isFinalPlan=true" in final
    final = final[: final.index("== Initial Plan ==")] if "== Initial Plan ==" in final else final
    return final.count("FileScan")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_has_a_cross_join_or_a_python_step(name, spark, data):
    plan = plan_of(QUERIES[name](spark, data))
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ExistingRDD"):
        assert step not in plan


def test_only_requested_features_are_read(population):
    metadata = Metadata(fills={"f2": 0, "f3": 0, "f4": 0}, feature_cuts={"f2": [0, 1], "f5": [0, 1]})
    for request, features in [
        ({"CSI": "f2"}, {"f2"}),
        ({"NULL_RATE": ["f3", "f4"]}, {"f3", "f4"}),
        ({"DISTINCT_RATE": "f4"}, {"f4"}),
    ]:
        plan = plan_of(benchmark_long(population, request, metadata))
        assert all(read == {"platform", "user_type", *features} for read in scans(plan))


def test_shares_read_no_status(population):
    plan = plan_of(benchmark_long(population, {"PSI": "score"}, METADATA))
    assert all(read == {"platform", "user_type", "id", "output_value"} for read in scans(plan))


def test_population_filter_reaches_the_scan(population):
    long = benchmark_long(population, {"PSI": "score"}, METADATA, platforms=["A", "C"], user_types="N")
    plan = plan_of(long)
    assert "In(platform, [A,C])" in plan and "EqualTo(user_type,N)" in plan


def test_metrics_of_one_kind_share_a_scan(population):
    metadata = Metadata([0, 0.5, 1], {}, {"f2": [0, 1], "f3": [0, 1]})
    request = {
        "PSI": ["score", "total_population"],
        "DRIFT_IN_MB": ["fa", "ca", "d1", "d2", "ca/fa", "d1/fa"],
        "CSI": ["f2", "f3"],
        "FEATURE_RANGE_DRIFT": ["f2", "f3"],
    }
    assert scans_run(benchmark_long(population, request, metadata)) == 1


def everything_of(names, edges):
    metadata = Metadata([0, 0.25, 0.5, 1], dict.fromkeys(names, 3.0), {name: edges for name in names})
    request = {
        "PSI": ["score", "total_population"],
        "DRIFT_IN_MB": ["fa", "ca", "d1", "d2", "ca/fa", "d1/fa"],
        **dict.fromkeys(["CSI", "FEATURE_RANGE_DRIFT", "NULL_RATE", "DISTINCT_RATE"], names),
        "INVALID_SCORE": None,
    }
    return request, metadata


def test_all_metrics_of_many_features_take_two_scans(population, spark, tmp_path):
    names = [f"f{n}" for n in range(2, 26)]
    request, metadata = everything_of(names, [float(i) for i in range(20)])
    assert scans_run(benchmark_long(population, request, metadata)) == 2
    names = [f"f{n}" for n in range(400)]
    columns = [f"double((id + {n}) % 10) AS {name}" for n, name in enumerate(names)]
    path = str(tmp_path / "wide")
    spark.range(50).selectExpr(
        "'A' AS platform", "'N' AS user_type", "id", "id / 50 AS output_value", "'x' AS status", *columns
    ).write.parquet(path)
    request, metadata = everything_of(names, [0, 4, 9])
    assert scans_run(benchmark_long(spark.read.parquet(path), request, metadata)) == 2


def test_the_plan_does_not_grow_with_the_edges(population):
    sizes = []
    for count in (1000, 1020):
        metadata = Metadata([], {}, {"f2": [float(i) for i in range(count)]})
        sizes.append(len(re.sub(r"#\d+L?|\d+", "", plan_of(benchmark_long(population, {"CSI": "f2"}, metadata)))))
    few = Metadata([], {}, {"f2": [float(i) for i in range(20)]})
    assert sizes[0] == sizes[1] < 2 * len(plan_of(benchmark_long(population, {"CSI": "f2"}, few)))


def test_more_than_a_hundred_features_share_a_scan(spark, tmp_path):
    names = [f"f{n}" for n in range(130)]
    columns = [f"double((id + {n}) % 10) AS {name}" for n, name in enumerate(names)]
    spark.range(50).selectExpr("'A' AS platform", "'N' AS user_type", *columns).write.parquet(str(tmp_path / "w"))
    population = spark.read.parquet(str(tmp_path / "w"))
    metadata = Metadata([], dict.fromkeys(names, 3), {name: [0, 4, 9] for name in names})
    request = {"CSI": names, "NULL_RATE": names, "FEATURE_RANGE_DRIFT": names}
    long = benchmark_long(population, request, metadata)
    assert scans_run(long) == 1
    counts = long.groupBy("metric_name", "band_no", "cnt").count().collect()
    assert sorted((tuple(row) for row in counts), key=repr) == sorted(
        [
            ("CSI", 1, 25, 130),
            ("CSI", 2, 25, 130),
            ("FEATURE_RANGE_DRIFT", 1, 25, 130),
            ("FEATURE_RANGE_DRIFT", 2, 25, 130),
            ("NULL_RATE", None, 5, 130),
        ],
        key=repr,
    )
    distinct = op.distinct_rates(population, names)
    assert distinct.filter("cnt = 10").count() == 130


def test_counts_are_reduced_before_the_shuffle(population):
    plan = plan_of(op.distinct_rates(population, ["f2"]))
    first = plan.rindex("Exchange hashpartitioning")
    assert re.search(r"m#.*l#.*d#.*s#", plan[first : plan.index("\n", first)])  # on the value too
    assert "HashAggregate" in plan[first:]


def test_segment_totals_gather_no_labels(spark, shuffled):
    df = spark.range(60).selectExpr(
        "if(id % 3 = 0, NULL, 'A') AS platform", "'N' AS user_type", "concat('job ', id) AS employment_type",
        "id AS tenure",
    )
    counts = op.segment_counts(df, ["employment_type", "tenure"])
    for window in re.findall(r"Window \[[^\n]*", plan_of(counts)):
        assert "label#" in window  # each label is a window of its own
    totals = counts.groupBy("platform", "value_name").agg(F.sum("cnt"), F.min("total"), F.max("total"))
    assert {tuple(row) for row in totals.collect()} == {
        (platform, name, n, float(n), float(n))
        for platform, n in ((None, 20), ("A", 40))
        for name in ("employment_type", "tenure")
    }


def test_latest_row_is_chosen_before_the_shuffle(spark, data):
    plan = plan_of(QUERIES["latest_per_key"](spark, data))
    assert plan.count("Exchange") == 1
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit[^\n]*Partial", plan)


def test_population_is_shuffled_once_per_table(shuffled, tmp_path):
    folder = str(tmp_path)
    shuffled.range(9).select("id", F.lit(1).alias("f"), F.lit("x").alias("model_text")).write.parquet(f"{folder}/f")
    shuffled.range(9).select("id", F.lit(0.5).alias("v30_pred_prob")).write.parquet(f"{folder}/o")
    shuffled.range(9).select(
        F.col("id").alias("bureau_reference_number"),
        F.lit(1).alias("created_at"),
        F.lit("{}").alias("new_bureau_variables"),
        F.lit("long text").alias("INPUT_VALUE"),
        F.lit("OLD").alias("PLATFORM"),
    ).write.parquet(f"{folder}/p")
    sources = [
        SourceTables(
            f"{folder}/f",
            f"{folder}/o",
            f"{folder}/p",
            platform=name,
            drop_from_production=["input_value", "platform"],
            drop_prefixes=["model"],
        )
        for name in ("A", "B")
    ]
    population = build_population(shuffled, sources)
    plan = plan_of(population)
    assert plan.count("Exchange") == 3 * len(sources)
    assert not {"INPUT_VALUE", "PLATFORM", "model_text"} & set().union(*scans(plan))
    assert {tuple(row) for row in population.select("platform", "id", "bureau_reference_number").collect()} == {
        ("A", i, i) for i in range(9)
    }


def test_a_population_reads_what_the_request_needs(spark, data):
    for request, read, unread in [
        ({"INVALID_SCORE": None}, {"o_totalprice", "c_mktsegment"}, {"c_acctbal", "o_orderstatus", "props"}),
        ({"NULL_RATE": "acctbal"}, {"c_acctbal"}, {"o_totalprice", "o_orderstatus", "props"}),
        ({"PSI": "fa"}, {"o_orderstatus", "o_totalprice"}, {"c_acctbal", "props"}),
        ({"SEGMENT_DISTRIBUTION": "active_cc_count"}, {"props"}, {"c_acctbal", "o_totalprice"}),
    ]:
        columns = required_columns(request, METADATA)
        population = build_population(
            spark, named.source_tables(spark, data), tie_break="Event_ID", columns=columns
        )
        assert set(population.columns) == {"id", *columns}
        found = set().union(*scans(plan_of(population)))
        assert read <= found and not unread & found


def test_creating_a_benchmark_takes_two_writes(spark, population, tmp_path):
    from bandloom import benchmark_table
    from bandloom.plans.population import materialise

    metadata = Metadata([0, 0.5, 1], {"f2": 0}, {"f2": [0, 1]})
    request = {"PSI": "score", "DRIFT_IN_MB": "fa", "CSI": "f2", "NULL_RATE": "f2", "INVALID_SCORE": None}
    started = []
    listener = spark.sparkContext._jsc.sc().statusStore()
    before = listener.jobsList(None).size()
    with materialise(population, str(tmp_path / "p")) as rows:
        written = listener.jobsList(None).size() - before
        table = benchmark_table(rows, request, metadata, "m")
        started.append(listener.jobsList(None).size() - before - written)
        table.write.parquet(str(tmp_path / "t"))
    assert started == [0]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2 * 5


def test_the_library_collects_control_data_only():
    found = []
    for path in sorted(Path(ROOT, "bandloom").rglob("*.py")):
        if "llm" in path.parts:  # a package of its own, with tests of its own
            continue
        for line in path.read_text().splitlines():
            if re.search(r"\.(collect|toPandas|toLocalIterator|first|take|head|localCheckpoint|crossJoin|rdd)\(|broadcast\(", line):
                found.append((path.name, line.strip()))
    assert found == [
        ("upsert.py", 'twice = df.filter("is_active").groupBy(*keys).count().filter("count > 1").head()'),
        ("metadata.py", "rows = df.limit(MAX_ENTRIES + 1).collect()"),
        ("store.py", "models = [row[0] for row in incoming.select(model).distinct().collect()]"),
        ("store.py", 'emptied = placed.groupBy("model").agg(F.max("is_active").alias("left")).filter("NOT left").collect()'),
    ]
