"""Writers at one time: ledger entries, publishers of versions, and readers beside a running stage."""

import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from plumbline.operators.encode import ColumnTransformer
from plumbline.plans import stages
from plumbline.plans.stages import Settings, read_metrics, result_path, run_stage
from plumbline.shared import scratch_path
from plumbline.sources import files, ledger, registry


def test_one_of_several_writers_wins(spark):
    folder = scratch_path(spark, "ledger")
    assert ledger.entries(spark, folder) == []
    barrier = threading.Barrier(8)

    def write(i):
        barrier.wait()
        return [ledger.put_if_absent(spark, f"{folder}/{name}", str(i)) for name in "abc"]

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(write, range(8)))
    assert [sum(column) for column in zip(*won)] == [1, 1, 1]
    assert ledger.entries(spark, folder) == [str(next(i for i, row in enumerate(won) if row[k])) for k in range(3)]


def test_appended_entries_are_numbered_without_gaps(spark):
    folder = scratch_path(spark, "ledger")
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda i: ledger.append(spark, folder, lambda before: json.dumps([i, len(before)])), range(18)))
    assert sorted(numbers) == list(range(1, 19))
    found = [json.loads(text) for text in ledger.entries(spark, folder)]
    assert [n for _, n in found] == list(range(18)) and sorted(i for i, _ in found) == list(range(18))


@pytest.fixture
def served(spark, insured):
    from pyspark.ml import PipelineModel

    return PipelineModel(stages=[ColumnTransformer(numeric=["age"], categorical=["smoker"]).fit(insured)])


def test_publishers_at_one_time_get_positions_and_folders_of_their_own(spark, served):
    base = scratch_path(spark, "registry")
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda i: registry.publish(spark, base, served, 0.5 + i / 100, 1.0, 1.0, version=f"v{i}"), range(5)))
    rows = registry.versions(spark, base).collect()
    assert sorted(r.position for r in rows) == [1, 2, 3, 4, 5] and len({r.path for r in rows}) == 5
    assert registry.current(spark, base).first().version == max(rows, key=lambda r: r.position).version
    for r in rows:
        files.load_model(r.path)


def test_of_two_publishers_of_one_version_one_fails(spark, served):
    base = scratch_path(spark, "registry")
    barrier = threading.Barrier(2)

    def publish(i):
        barrier.wait()
        try:
            return registry.publish(spark, base, served, 0.5 + i, 1.0, 1.0, version="same")
        except ValueError:
            return None

    with ThreadPoolExecutor(2) as pool:
        assert sorted(map(str, pool.map(publish, range(2)))) == ["None", "same"]
    assert registry.versions(spark, base).count() == 1


def settings(spark, given):
    base = scratch_path(spark, "runs")
    return Settings(base=base, run_id="r", registry=f"{base}/registry", source=lambda s: given[0], exact_split=False)


def test_a_reader_beside_a_second_attempt_sees_the_first_whole(spark, insured, monkeypatch):
    given = [insured.filter("id % 2 = 0")]
    run = settings(spark, given)
    run_stage(spark, "ingest", run)
    before = read_metrics(spark, run, "ingest")
    path = result_path(spark, run, "samples")
    rows = spark.read.parquet(path).count()
    given[0], seen, write = insured, [], stages.write_sides

    def watched(*args):
        write(*args)
        seen.append((result_path(spark, run, "samples"), spark.read.parquet(path).count(), read_metrics(spark, run, "ingest")))

    monkeypatch.setattr(stages, "write_sides", watched)
    run_stage(spark, "ingest", run)
    assert seen == [(path, rows, before)]
    assert spark.read.parquet(result_path(spark, run, "samples")).count() == insured.count() > rows
    assert stages.release_attempts(spark, run) == 1 and spark.read.parquet(result_path(spark, run, "samples")).count() == insured.count()


def test_stages_read_one_attempt_throughout(spark, insured, monkeypatch):
    """New samples that are finished while the features are built do not mix into them."""
    given = [insured.filter("id % 2 = 0")]
    run = settings(spark, given)
    run_stage(spark, "validate", run)
    build, done = stages.build_matrices, []

    def interrupted(*args):
        if not done:
            done.append(1)
            given[0] = insured
            run_stage(spark, "ingest", run)
        return build(*args)

    monkeypatch.setattr(stages, "build_matrices", interrupted)
    run_stage(spark, "transform", run)
    found = read_metrics(spark, run, "transform")
    assert found["train_rows"] + found["test_rows"] == insured.filter("id % 2 = 0").count()
    assert not stages._is_done(spark, run, "transform")


def test_a_result_that_nobody_made_is_an_error(spark, insured):
    run = settings(spark, [insured])
    with pytest.raises(FileNotFoundError):
        result_path(spark, run, "samples")
    assert read_metrics(spark, run, "ingest") == {} and stages.release_attempts(spark, run) == 0


def test_a_snapshot_that_dies_leaves_the_one_before(spark, insured):
    base = scratch_path(spark, "store")
    files.snapshot(insured, base, "one")
    broken = insured.withColumn("age", F.when(F.col("id") >= 0, F.raise_error(F.lit("lost")).cast("bigint")))
    with pytest.raises(Exception, match="lost"):
        files.snapshot(broken, base, "one")
    assert files.read_snapshot(spark, base, "one").count() == insured.count()


def test_a_run_does_not_start_with_wrong_settings(spark, insured):
    from dataclasses import replace

    run = settings(spark, [insured])
    assert stages.check_settings(spark, run) == []
    assert stages.check_settings(spark, replace(run, grid="huge")) == ["grid: 'huge'"]
    assert stages.check_settings(spark, replace(run, key="age")) == ["contract: the key 'age' is one of its columns"]
    far = stages.check_settings(spark, replace(run, registry="nofs://there/models"))
    assert len(far) == 1 and far[0].startswith("registry: ")
    with pytest.raises(ValueError, match="the run cannot start: grid"):
        stages.run_full(spark, replace(run, grid={"random_forest": {"noParam": [1]}}))
    assert read_metrics(spark, run, "ingest") == {}


def test_a_stage_whose_results_are_gone_is_run_again(spark, insured):
    run = settings(spark, [insured])
    run_stage(spark, "validate", run)
    attempt = stages._finished_attempt(spark, run, "ingest")
    ledger.delete_folder(spark, run.folder("ingest", attempt))
    assert not stages._is_done(spark, run, "validate")
    run_stage(spark, "validate", run, force=False)
    assert stages._is_done(spark, run, "validate") and stages._finished_attempt(spark, run, "ingest") != attempt
