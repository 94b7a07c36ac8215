"""Metadata files, extracts, readers."""

import json

import pytest

from bandloom import operators as op

from bandloom import load_metadata
from bandloom.sources import metadata as metadata_module
from bandloom.sources.extract import export_query
from bandloom.sources.files import read_rows, read_table, scratch_folder

from .helpers import one_column, rows


def test_metadata_from_json(spark, tmp_path):
    parts = {
        "score_cuts": [0, 0.5, 1],
        "fills": {"F1": -1, "f2": "none"},
        "feature_cuts": {"F1": [0, None, 2.5]},
        "feature_types": {"F1": "num"},
    }
    paths = {}
    for name, value in parts.items():
        paths[name] = str(tmp_path / f"{name}.json")
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=1))
    got = load_metadata(spark, **paths)
    assert (got.score_cuts, got.fills) == ([0, 0.5, 1], {"f1": -1, "f2": "none"})
    assert (got.feature_cuts, got.feature_types) == ({"f1": [0, None, 2.5]}, {"f1": "num"})
    assert json.loads(got.to_json())["fillna_dict"] == {"f1": -1, "f2": "none"}


def test_metadata_from_parquet(spark, tmp_path):
    cuts, edges = str(tmp_path / "cuts"), str(tmp_path / "edges")
    spark.createDataFrame([(1.0,), (0.0,), (0.5,)], "cut double").write.parquet(cuts)
    spark.createDataFrame([("F1", [0.0, 1.0])], "feature string, edges array<double>").write.parquet(edges)
    got = load_metadata(spark, score_cuts=cuts, feature_cuts=edges)
    assert (got.score_cuts, got.feature_cuts, got.fills) == ([0.0, 0.5, 1.0], {"f1": [0.0, 1.0]}, {})


def test_a_data_table_is_not_metadata(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "big")
    spark.range(20).write.parquet(path)
    monkeypatch.setattr(metadata_module, "MAX_ENTRIES", 10)
    with pytest.raises(ValueError, match="not metadata"):
        load_metadata(spark, score_cuts=path)
    spark.range(2).selectExpr("id", "id AS a", "id AS b").write.parquet(path + "3")
    with pytest.raises(ValueError, match="one or two columns"):
        load_metadata(spark, fills=path + "3")


def test_extract_and_glob(spark, data, tmp_path):
    spark.read.parquet(f"{data}/customer.parquet").createOrReplaceTempView("customer")
    query = "SELECT c_custkey, ';' AS mark FROM customer;\n"
    first = export_query(spark, query, str(tmp_path), "app", "jan")
    export_query(spark, query, f"{tmp_path}/", "app", "feb")
    assert first == f"{tmp_path}/app_base_jan"
    n = spark.table("customer").count()
    assert spark.read.parquet(first).filter("mark = ';'").count() == n
    assert read_table(spark, f"{tmp_path}/app_base_*").count() == 2 * n
    assert read_table(spark, f"{first}/*.snappy.parquet", ["c_custkey"]).columns == ["c_custkey"]


def test_rows_from_any_reader(spark, tmp_path):
    spark.range(3).write.json(str(tmp_path / "j"))
    spark.range(3).write.parquet(str(tmp_path / "p"))
    spark.range(3).createOrReplaceTempView("three")
    json_rows = read_rows(spark, source="json", options={"path": str(tmp_path / "j")})
    assert rows(json_rows) == rows(read_rows(spark, path=str(tmp_path / "p")))
    assert sorted(one_column(read_rows(spark, table="three"))) == [0, 1, 2]
    with pytest.raises(ValueError, match="exactly one"):
        read_rows(spark, table="three", path="x")


def test_scratch_folder_is_in_the_shared_checkpoint_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first.startswith(shared + "/") and first != second


def test_metadata_of_several_files_is_merged_and_repeated_keys_are_errors(spark, tmp_path):
    folder = tmp_path / "fills.json"
    folder.mkdir()
    (folder / "1.json").write_text('{"a": 1}')
    (folder / "2.json").write_text('{"b": null}')
    assert load_metadata(spark, fills=str(folder)).fills == {"a": 1, "b": None}
    (folder / "3.json").write_text('{"a": 2}')
    with pytest.raises(ValueError, match="given twice"):
        load_metadata(spark, fills=str(folder))
    spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="given twice"):
        load_metadata(spark, fills=str(tmp_path / "t"))


def test_a_null_fill_counts_nulls_only(spark):
    df = spark.createDataFrame([("A", "N", None), ("A", "N", 1.0)], "platform string, user_type string, f double")
    (row,) = op.null_rates(df, ["f"], {"f": None}).collect()
    assert (row.cnt, row.total) == (1, 2.0)
