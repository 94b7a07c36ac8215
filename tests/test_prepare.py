"""Joining sources, latest rows, merging, and the population pipeline."""

import pytest
from pyspark.sql import functions as F

from bandloom import SourceTables, build_population
from bandloom import operators as op
from bandloom.functions.columns import lower_columns
from bandloom.operators.prepare import drop_columns
from bandloom.plans.population import materialise

from .helpers import one_column, rows


def test_latest_row_with_ties_nulls_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m"), (None, 5, "p"), (None, 4, "q")],
        "k string, created_at int, v string",
    )
    assert rows(op.latest_per_key(df, "k", tie_break="v")) == sorted(
        [("a", 2, "z"), ("b", 0, "m"), (None, 5, "p")], key=repr
    )


def test_ties_are_broken_the_same_way_however_rows_are_split(spark):
    df = spark.range(2000).select(
        (F.col("id") % 50).alias("k"),
        F.lit(1).alias("created_at"),
        F.col("id").alias("v"),
        F.create_map(F.lit("m"), F.col("id")).alias("m"),
    )
    first = rows(op.latest_per_key(df.repartition(7), "k").select("k", "v"))
    second = rows(op.latest_per_key(df.repartition(3, "v"), "k").select("k", "v"))
    assert first == second and len(first) == 50


def test_duplicate_count_agrees_with_what_is_removed(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, 2), (2, 1)], "id int, created_at int")
    kept = op.latest_per_key(df, "id").count()
    assert rows(op.duplicate_count(df)) == [(5, 5 - kept)] == [(5, 2)]
    assert rows(op.duplicate_count(df.filter("id is not null"))) == [(3, 1)]
    assert rows(op.duplicate_count(df.filter("false"))) == [(0, 0)]


def test_platform_from_channel(spark):
    df = spark.createDataFrame([("APP",), ("web",), (None,)], "channel string")
    platform = op.platform_from_channel(F.col("channel"), {"APP": "A"}, "OTHER")
    assert one_column(df.select(platform)) == ["A", "OTHER", "OTHER"]


def test_columns_are_lowered_and_dropped(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "ID int, Model_A int, MODULE int, keep int")
    assert lower_columns(df).columns == ["id", "model_a", "module", "keep"]
    assert drop_columns(df, ["module", "absent"], ["model"]).columns == ["ID", "keep"]
    with pytest.raises(ValueError, match="not unique"):
        lower_columns(df.withColumnRenamed("ID", "x").toDF("a", "A", "c", "d"))


def test_json_keys(spark):
    texts = ['{"a": 3, "b": "4"}', "bad", None, "[1]", '{"b": null}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    got = op.json_keys(df, "j", ["a", "b"]).orderBy("i").select("a", "b").collect()
    assert [tuple(row) for row in got] == [("3", "4"), (None, None), (None, None), (None, None), (None, None)]


def test_prefixed_key_join(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "ref int, v string")
    right = spark.createDataFrame([("#1", 10), ("2", 20)], "reference_no string, w int")
    assert rows(op.join_on_prefixed_key(left, right, "ref", "reference_no", "#").select("v", "w")) == [("x", 10)]
    plain = op.join_on_prefixed_key(left, left.withColumnRenamed("v", "w"), "ref", "ref")
    assert rows(plain.select("w")) == [("x",), ("y",)]


def test_sources_must_have_the_same_columns(spark):
    one = spark.createDataFrame([(1, 2)], "id int, score int")
    other = spark.createDataFrame([(3, 4)], "SCORE int, ID int")
    merged = op.merge_sources([one, other], json_column=None)
    assert merged.columns == ["id", "bureau_score"] and rows(merged) == [(1, 2), (4, 3)]
    with pytest.raises(Exception, match="Cannot resolve column"):
        op.merge_sources([one, other.drop("SCORE")], json_column=None).collect()


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """Two sources with repeated ids everywhere; production logs lie in many part files."""
    folder = tmp_path_factory.mktemp("sources")

    def save(name, data, schema, files=1):
        path = str(folder / f"{name}.parquet")
        spark.createDataFrame(data, schema).repartition(files).write.parquet(path)
        return path

    result = []
    for source, first in (("one", 0), ("two", 5)):
        ids = list(range(first, first + 10))
        features = save(
            f"{source}_features", [(i, float(i)) for i in ids] + [(ids[0], float(ids[0]))], "id long, f double"
        )
        outputs = save(
            f"{source}_outputs",
            [(i, i / 20, "NEW", 700 + i, 6, "FINAL_APPROVED", "{\"active_cc_count\": 1}") for i in ids] * 2,
            "id long, v30_pred_prob double, USER_TYPE_FINAL string, score int, instalment_no_months int, "
            "status string, NEW_BUREAU_VARIABLES string",
        )
        log = [(i, t + first, "APP" if t % 2 else "SITE", "m", 0.5) for i in ids for t in range(4)]
        extra = "model_version string" if source == "one" else "model_name string"
        production = save(
            f"{source}_production",
            log,
            f"BUREAU_REFERENCE_NUMBER long, created_at int, channel string, {extra}, OUTPUT_VALUE double",
            files=4,
        )
        result.append((features, outputs, production))
    return [
        SourceTables(
            *result[0],
            platform="APP_A",
            drop_from_production=["output_value", "model_version"],
            drop=["channel"],
        ),
        SourceTables(
            result[1][0],
            result[1][1],
            result[1][2] + "/*.snappy.parquet",
            platform="WEB_AGG",
            channels={"APP": "APP_B"},
            drop_from_production=["output_value"],
            drop=["channel", "loan_amount"],
            drop_prefixes=["model"],
        ),
    ]


def test_population_has_the_latest_row_of_every_id(spark, sources):
    population = build_population(spark, sources)
    got = rows(population.select("id", "platform", "created_at", "output_value", "f", "tenure", "active_cc_count"))
    expected = [(i, "APP_A", 3, i / 20, float(i), 6, "1") for i in range(5)]
    expected += [(i, "APP_B", 8, i / 20, float(i), 6, "1") for i in range(5, 15)]
    assert got == sorted(expected, key=repr)
    assert {"user_type", "bureau_score", "status"} <= set(population.columns)
    assert not {"channel", "model_name", "model_version"} & set(population.columns)


def test_reducing_before_the_join_gives_the_same_rows(spark, sources):
    def plain(source):
        return op.prepare_source(
            spark.read.parquet(source.features),
            spark.read.parquet(source.outputs),
            spark.read.parquet(source.production),
            source.platform_column(),
            drop_from_production=source.drop_from_production,
            drop=source.drop,
            drop_prefixes=source.drop_prefixes,
        )

    merged = op.merge_sources([plain(source) for source in sources])
    assert merged.count() == 2 * (2 * 10 + 2)
    late = op.latest_per_key(merged, "id").drop("new_bureau_variables")
    early = build_population(spark, sources).drop("new_bureau_variables")
    assert rows(late) == rows(early.select(*late.columns))


@pytest.mark.parametrize("reduced", [False, True])
def test_columns_dropped_from_production_stay_in_the_other_tables(spark, reduced):
    outputs = spark.createDataFrame([(1, 30, 0.5)], "id int, bureau_vintage int, output_value double")
    features = spark.createDataFrame([(1, 2.0, "m")], "id int, f double, model_x string")
    production = spark.createDataFrame(
        [(1, 5, 99, "OLD", "a", 9.0), (1, 5, 98, "OLD", "b", 8.0)],
        "BUREAU_REFERENCE_NUMBER int, created_at int, BUREAU_VINTAGE int, PLATFORM string, seq string, OUTPUT_VALUE double",
    )
    got = op.prepare_source(
        features,
        outputs,
        production,
        F.lit("A"),
        tie_break="seq",
        drop_from_production=["BUREAU_VINTAGE", "PLATFORM", "output_value", "seq"],
        drop_prefixes=["model"],
        one_row_per_id=reduced,
    )
    assert set(got.columns) == {
        "id", "bureau_vintage", "output_value", "f", "bureau_reference_number", "created_at", "platform",
    }
    assert rows(got.select("bureau_vintage", "output_value", "platform")) == [(30, 0.5, "A")]


def test_a_repeated_id_does_not_multiply(spark, tmp_path):
    """One id on a third of the rows of all three tables: the plain join would give 400^3 rows."""
    ids = [0] * 400 + list(range(1, 801))
    schema = "id long, n long"
    frame = spark.createDataFrame(list(zip(ids, range(len(ids)))), schema)
    frame.withColumnRenamed("n", "f").write.parquet(str(tmp_path / "f"))
    frame.withColumnRenamed("n", "o").write.parquet(str(tmp_path / "o"))
    frame.toDF("bureau_reference_number", "created_at").write.parquet(str(tmp_path / "p"))
    source = SourceTables(str(tmp_path / "f"), str(tmp_path / "o"), str(tmp_path / "p"), platform="A")
    population = build_population(spark, [source], json_column=None)
    got = population.agg(F.count("*"), F.count_distinct("id"), F.max("created_at")).first()
    assert tuple(got) == (801, 801, 1199)
    assert population.filter("id = 0").first().created_at == 399


def test_materialised_table_is_removed_unless_it_has_a_path(spark, tmp_path):
    with materialise(spark.range(3)) as kept:
        path = kept.inputFiles()[0].removeprefix("file://")
        assert kept.count() == 3
    with pytest.raises(OSError):
        open(path)
    with materialise(spark.range(3), str(tmp_path / "p.parquet")):
        pass
    assert spark.read.parquet(str(tmp_path / "p.parquet")).count() == 3


@pytest.mark.parametrize("how", ["files", "frame", "order"])
def test_the_kept_copy_does_not_depend_on_the_request(spark, tmp_path, how):
    """Copies of an id that differ in every column: whatever is asked for comes from one and the same copy."""
    folder = str(tmp_path)
    copies = [(i, i * 10 + k, f"{i}-{k}", k) for k in range(3) for i in range(20)]
    features = spark.createDataFrame(copies, "id long, f long, g string, k int")
    features.repartition(4).write.parquet(f"{folder}/f")
    spark.range(20).selectExpr("id", "0.5 AS v30_pred_prob").write.parquet(f"{folder}/o")
    spark.range(20).selectExpr("id AS bureau_reference_number", "1 AS created_at").write.parquet(f"{folder}/p")
    source = SourceTables(
        features if how == "frame" else f"{folder}/f", f"{folder}/o", f"{folder}/p", platform="A",
        features_order="k" if how == "order" else None,
    )

    def kept(*columns):
        rows = build_population(spark, [source], json_column=None, columns=columns).select("id", *columns).collect()
        return {row.id: row for row in rows}

    whole, f_only, g_only = kept("f", "g"), kept("f"), kept("g")
    assert len(whole) == 20
    for i, row in whole.items():
        assert row.g == f"{i}-{row.f - 10 * i}"
        assert f_only[i].f == row.f and g_only[i].g == row.g
        if how == "order":
            assert row.f == 10 * i + 2
