"""Upsert, versions, views, snapshots."""

import re
import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from bandloom import BenchmarkStore
from bandloom import operators as op
from bandloom.operators.result import RESULT_SCHEMA
from bandloom.sources.files import replace_table
from bandloom.sources.store import snapshot_path, view

from .helpers import plan_of, rows

KEY = ["model_name", "platform", "user_type", "metric_name", "value_name", "benchmark_name"]


def results(spark, *entries, **values):
    """Result rows for (platform, value_name, total) entries."""
    base = {"model_name": "M", "user_type": "N", "metric_name": "PSI", "is_active": True, **values}
    data = []
    for platform, value, total in entries:
        row = {**base, "platform": platform, "value_name": value, "total_count": total}
        data.append(tuple(row.get(f.name) for f in RESULT_SCHEMA))
    return spark.createDataFrame(data, RESULT_SCHEMA)


def state(df):
    return rows(df.select("platform", "value_name", "total_count", "is_active"))


@pytest.fixture
def store(spark, tmp_path):
    return BenchmarkStore(spark, f"store_{uuid.uuid4().hex}", path=str(tmp_path / "store"))


def test_first_upload_creates_the_store(spark, store):
    assert not store.exists()
    assert store.rows().collect() == []
    store.upload(results(spark, ("A", "score", 1.0)))
    assert store.exists() and state(store.rows()) == [("A", "score", 1.0, True)]


def test_matching_rows_become_inactive_also_with_null_keys(spark, store):
    store.upload(results(spark, ("A", "score", 1.0), ("B", "score", 2.0), (None, "score", 3.0)))
    store.upload(results(spark, ("A", "score", 10.0), (None, "score", 30.0)))
    store.upload(results(spark, ("A", "score", 100.0)))
    assert state(store.active()) == sorted(
        [("A", "score", 100.0, True), ("B", "score", 2.0, True), (None, "score", 30.0, True)], key=repr
    )
    assert state(store.rows().filter("not is_active")) == sorted(
        [("A", "score", 1.0, False), ("A", "score", 10.0, False), (None, "score", 3.0, False)], key=repr
    )


def test_texts_that_join_to_the_same_key_stay_apart(spark, store):
    store.upload(results(spark, ("A||x", "y", 1.0), ("None", "z", 2.0)))
    store.upload(results(spark, ("A", "x||y", 3.0), (None, "z", 4.0)))
    assert store.active().count() == 4


def test_inactive_incoming_rows_are_history(spark, store):
    store.upload(results(spark, ("A", "score", 1.0)))
    store.upload(results(spark, ("A", "score", 2.0), is_active=False))
    assert state(store.rows()) == [("A", "score", 1.0, False), ("A", "score", 2.0, False)]
    assert store.active().count() == 0


def test_missing_flag_means_active_and_missing_keys_are_an_error(spark, store):
    store.upload(results(spark, ("A", "score", 1.0)).drop("is_active", "meta_data"))
    assert state(store.rows()) == [("A", "score", 1.0, True)]
    with pytest.raises(ValueError, match="benchmark_name"):
        store.upload(results(spark, ("A", "score", 1.0)).drop("benchmark_name"))


def test_a_failed_upload_changes_nothing(spark, store):
    store.upload(results(spark, ("A", "score", 1.0)))
    broken = results(spark, ("A", "score", 2.0)).withColumn(
        "total_count", F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).cast("double")
    )
    with pytest.raises(Exception, match="lost"):
        store.upload(broken)
    assert state(store.rows()) == [("A", "score", 1.0, True)]
    store.upload(results(spark, ("A", "score", 3.0)))
    assert state(store.rows()) == [("A", "score", 1.0, False), ("A", "score", 3.0, True)]


def test_a_writer_that_dies_leaves_a_usable_store(spark, store):
    """Files that a dead driver has staged are no rows, and the next upload works."""
    store.upload(results(spark, ("A", "score", 1.0)))
    left = f"{store.path}/.spark-staging-0/model=M/state=active/upload=current"
    results(spark, ("B", "score", 2.0)).drop("model").write.parquet(left)
    results(spark, ("B", "score", 2.0)).write.parquet(f"{store.path}/_temporary/0")
    assert state(store.rows()) == [("A", "score", 1.0, True)]
    store.upload(results(spark, ("C", "score", 3.0)))
    assert state(store.rows()) == [("A", "score", 1.0, True), ("C", "score", 3.0, True)]


def test_a_store_is_found_again_by_its_files(spark, store):
    store.upload(results(spark, ("A", "score", 1.0)))
    store.upload(results(spark, ("A", "score", 2.0)))
    again = BenchmarkStore(spark, f"{store.table}_again", path=store.path)
    assert state(again.rows()) == state(store.rows()) == [("A", "score", 1.0, False), ("A", "score", 2.0, True)]


def test_a_store_in_the_warehouse(spark):
    store = BenchmarkStore(spark, f"store_{uuid.uuid4().hex}")
    assert store.active().collect() == []
    store.upload(results(spark, ("A", "score", 1.0), model_name=None))
    store.upload(results(spark, ("A", "score", 2.0), model_name=None, is_active=False))
    assert state(store.rows()) == [("A", "score", 1.0, False), ("A", "score", 2.0, False)]
    spark.sql(f"DROP TABLE {store.table}")


def test_other_models_and_history_are_not_read(spark, store):
    for model in ("M", "OTHER"):
        for total in (1.0, 2.0):
            store.upload(results(spark, ("A", "score", total), model_name=model))
    plan = plan_of(store.view(model_name="other", active_only=True))
    assert re.search(r"PartitionFilters: \[[^\]]*model[^\]]*OTHER[^\]]*state[^\]]*active", plan)
    found = store.fetch(model_name="other")[0]
    read = found._jdf.queryExecution().executedPlan()
    found.collect()
    assert "OTHER" in read.toString() and state(found) == [("A", "score", 1.0, False), ("A", "score", 2.0, True)]


def test_a_snapshot_may_replace_what_it_is_read_from(spark, store, tmp_path):
    path = str(tmp_path / "s.parquet")
    store.upload(results(spark, ("A", "score", 1.0), ("B", "score", 2.0)))
    store.fetch(path)
    broken = spark.read.parquet(path).withColumn("total_count", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, path)
    assert spark.read.parquet(path).count() == 2
    replace_table(spark.read.parquet(path).filter("platform = 'A'"), path)
    assert state(spark.read.parquet(path)) == [("A", "score", 1.0, True)]
    assert [p.name for p in tmp_path.iterdir() if "s.parquet" in p.name and p.name != "s.parquet"] == []


def test_repeated_keys_and_null_flags(spark, store):
    with pytest.raises(ValueError, match="more than one active row"):
        store.upload(results(spark, ("A", "score", 1.0), ("A", "score", 2.0)))
    store.upload(results(spark, ("A", "score", 1.0)).withColumn("is_active", F.lit(None).cast("boolean")))
    assert state(store.rows()) == [("A", "score", 1.0, True)]


def test_verification_counts(spark, store):
    store.upload(results(spark, ("A", "score", 1.0)))
    counts = store.upload(results(spark, ("A", "score", 2.0)), verify=True)
    assert rows(counts.select("platform", "is_active", "row_count")) == [("A", False, 1), ("A", True, 1)]
    assert store.upload(results(spark, ("A", "score", 3.0))) is None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    uploads=st.lists(
        st.sets(st.tuples(st.sampled_from([None, "A", "B"]), st.sampled_from(["x", "y"])), min_size=1),
        min_size=1,
        max_size=4,
    )
)
def test_one_active_row_per_key_whatever_is_uploaded(spark, uploads):
    stored, expected = None, {}
    for number, keys in enumerate(uploads):
        new = results(spark, *[(p, v, float(number)) for p, v in sorted(keys, key=repr)])
        stored = new if stored is None else op.upsert(stored, new)
        expected |= {key: float(number) for key in keys}
    active = stored.filter("is_active").select("platform", "value_name", "total_count")
    assert rows(active) == sorted([(*key, total) for key, total in expected.items()], key=repr)
    assert stored.count() == sum(map(len, uploads))


def test_view_filters_and_limit(spark):
    stored = results(spark, ("A", "y", 1.0), ("A", "x", 2.0), ("B", "x", 3.0)).withColumn(
        "is_active", F.col("value_name") == "x"
    )
    assert state(view(stored, platform="A", value_name="x")) == [("A", "x", 2.0, True)]
    assert state(view(stored, model_name="m", limit=2)) == [("A", "x", 2.0, True), ("A", "y", 1.0, False)]
    assert state(view(stored, active_only=True)) == [("A", "x", 2.0, True), ("B", "x", 3.0, True)]
    assert view(stored, platform="").count() == 0
    assert view(stored, limit=0).count() == 0
    assert view(stored, platform=None).count() == 3
    assert view(stored, created_at="2024").count() == 0
    assert view(stored, platform="A' OR '1'='1").count() == 0
    with pytest.raises(ValueError, match="unknown filters"):
        view(stored, colour="red")


def test_snapshots(spark, store, tmp_path):
    store.upload(results(spark, ("A", "score", 1.0)))
    store.upload(results(spark, ("A", "score", 2.0), model_name="OTHER"))
    (tmp_path / "folder").mkdir()
    folder = str(tmp_path / "folder")
    for given_path, written in [
        (folder, f"{folder}/benchmark_table.parquet"),
        (f"{folder}/", f"{folder}/benchmark_table.parquet"),
        (f"{folder}/new/", f"{folder}/new/benchmark_table.parquet"),
        (f"{folder}/x", f"{folder}/x.parquet"),
        (f"{folder}/x.parquet", f"{folder}/x.parquet"),
    ]:
        frame, path = store.fetch(given_path, model_name="other")
        assert path == written == snapshot_path(spark, given_path)
        assert state(spark.read.parquet(path)) == state(frame) == [("A", "score", 2.0, True)]
    frame, path = store.fetch()
    assert path is None and frame.count() == 2


def test_retiring_keeps_column_order_and_other_columns(spark):
    stored = results(spark, ("A", "score", 1.0))
    after = op.upsert(stored, results(spark, ("A", "score", 2.0)).drop("is_active"))
    assert after.columns == stored.columns
