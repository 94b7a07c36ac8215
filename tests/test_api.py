"""The whole path: sources on disk, result table, store, view, snapshot."""

import uuid

import pytest

from bandloom import Benchmark, Metadata, ModelConfig, SourceTables

from .helpers import rows


@pytest.fixture(scope="module")
def bench(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("model")

    def save(name, data, schema):
        path = str(folder / name)
        spark.createDataFrame(data, schema).write.parquet(path)
        return path

    ids = range(40)
    source = SourceTables(
        features=save("f", [(i, float(i % 7)) for i in ids], "id long, f1 double"),
        outputs=save(
            "o",
            [(i, i / 40, "NEW" if i % 2 else "OLD", "FINAL_APPROVED", "{}") for i in ids],
            "id long, v30_pred_prob double, user_type_final string, status string, new_bureau_variables string",
        ),
        production=save("p", [(i, i, "APP") for i in ids], "bureau_reference_number long, created_at int, channel string"),
        platform="WEB",
        channels={"APP": "A"},
    )
    metadata = Metadata([0, 0.5, 1], {"F1": 0.0}, {"F1": [0, 2, 4, 6]})
    models = {"v1": ModelConfig([source], metadata, ["A", "WEB"], ["NEW", "OLD"], tie_break="channel")}
    return Benchmark(spark, models, f"store_{uuid.uuid4().hex}", str(folder / "bench"), str(folder / "store"))


REQUEST = {"PSI": ["score", "total_population", "fa"], "CSI": "f1", "NULL_RATE": "all_features", "INVALID_SCORE": None}


def test_create_upload_view_get(spark, bench, tmp_path):
    result = bench.create_benchmark(model_name="v1", benchmark_name="b", metric_dict=REQUEST)
    assert result.count() == 2 * 6
    assert bench.row_counts["population"] == 40
    assert bench.row_counts["rows"] - bench.row_counts["duplicates"] == 40
    assert spark.read.parquet(f"{bench.bench_path}/bench_input.parquet").count() == 40
    again = bench.create_benchmark("A", "NEW", "CSI", "all_features", "v1", "b", bench_path=str(tmp_path / "again"))
    assert rows(again.select("model_name", "platform", "user_type", "total_count")) == [("V1", "A", "NEW", 100.0)]

    bench.upload_benchmark(f"{bench.bench_path}/bench_output.parquet")
    counts = bench.upload_benchmark(str(tmp_path / "again/bench_output.parquet"), verify_upload=True)
    assert sum(row.row_count for row in counts.collect()) == 13
    shares = bench.view_benchmark(metric_name="CSI", user_type="NEW")
    assert rows(shares.select("is_active")) == [(False,), (True,)]
    assert bench.view_benchmark(model_name="v1", active_only=True).count() == 12
    assert bench.view_benchmark(platform="A", limit=3).count() == 3
    frame, path = bench.get_benchmark("v1", str(tmp_path / "out"))
    assert path.endswith("out.parquet") and spark.read.parquet(path).count() == frame.count() == 13


def test_population_can_be_left_out(spark, bench, tmp_path):
    folder = tmp_path / "lean"
    result = bench.create_benchmark(
        "A", ["NEW"], "PSI", "score", "v1", bench_path=str(folder), save_intermediate=False, tracking_type="ONCE"
    )
    assert [entry.name for entry in folder.iterdir()] == ["bench_output.parquet"]
    assert rows(result.select("tracking_type", "total_count")) == [("ONCE", 20.0)]


def test_bad_calls(bench):
    with pytest.raises(KeyError, match="available"):
        bench.create_benchmark("A", "NEW", "PSI", "score", "v9")
    with pytest.raises(ValueError, match="metric"):
        bench.create_benchmark("A", "NEW", model_name="v1")
    with pytest.raises(ValueError, match="no rule"):
        bench.create_benchmark("A", "NEW", "CSI", "f9", "v1", save_intermediate=False)
