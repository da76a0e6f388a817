"""Layers in versions."""

import os

import pytest
from pyspark.sql import functions as F

import run_job
from test_medallion import BIO_COLUMNS, BIOS, RESULT_ROWS, write_csv
from tiermill.plans import medallion
from tiermill.plans.athletes import BIO, REPORT, RESULT_FIELDS, RESULTS
from tiermill.plans.medallion import layer, read_tier, run_medallion
from tiermill.sources import files
from tiermill.sources.layers import current_version, next_version, read_layer, record_version, remove_old_versions, replace_layer, versions


def ids(df):
    return sorted(r.id for r in df.collect())


def failing(df):
    """``df`` with a row that cannot be computed, after others that can."""
    broken = F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return df.withColumn("id", broken.cast("bigint"))


def test_a_failing_write_leaves_the_old_version_readable(spark, tmp_path):
    path = str(tmp_path / "layer")
    with pytest.raises(Exception, match="lost"):
        replace_layer(failing(spark.range(4)), path)
    assert current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_layer(spark, path)
    replace_layer(spark.range(3), path)
    with pytest.raises(Exception, match="lost"):
        replace_layer(failing(spark.range(0, 4, 1, 4)), path)
    assert ids(read_layer(spark, path)) == [0, 1, 2]
    assert [v.number for v in versions(spark, path)] == [0]
    replace_layer(spark.range(5, 7), path, note="second")
    assert ids(read_layer(spark, path)) == [5, 6]
    assert current_version(spark, path).note == "second" and current_version(spark, path).number == 1


def test_a_job_that_dies_before_the_record_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "layer")
    replace_layer(spark.range(3), path)
    unfinished = next_version(spark, path)
    spark.range(9).write.parquet(f"{path}/{unfinished.folder}")
    assert ids(read_layer(spark, path)) == [0, 1, 2]
    assert replace_layer(spark.range(1), path).number == unfinished.number
    assert ids(read_layer(spark, path)) == [0]


def test_a_layer_may_be_made_from_itself_and_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "layer")
    replace_layer(spark.range(3), path)
    before = read_layer(spark, path)
    replace_layer(read_layer(spark, path).withColumn("id", F.col("id") + 10), path)
    assert ids(before) == [0, 1, 2] and ids(read_layer(spark, path)) == [10, 11, 12]


def test_old_versions_are_removed(spark, tmp_path):
    path = str(tmp_path / "layer")
    for n in range(4):
        replace_layer(spark.range(n), path)
    spark.range(1).write.parquet(f"{path}/{next_version(spark, path).folder}")  # never finished
    assert remove_old_versions(spark, path, keep=2) == 3
    assert sum(name.startswith("version-") for name in os.listdir(path)) == 2
    assert ids(read_layer(spark, path)) == [0, 1, 2]
    noted = next_version(spark, path)
    spark.range(1).write.parquet(f"{path}/{noted.folder}")
    record_version(spark, path, noted, note=f"also {versions(spark, path)[1].folder}")
    assert remove_old_versions(spark, path, keep=1) == 1
    with pytest.raises(ValueError):
        remove_old_versions(spark, path, keep=0)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    write_csv(folder / f"{BIO}.csv", BIO_COLUMNS, BIOS)
    write_csv(folder / f"{RESULTS}.csv", RESULT_FIELDS, RESULT_ROWS)
    return str(folder)


def rows(df):
    return sorted(map(tuple, df.drop("timestamp").collect()), key=repr)


def test_versioned_pipeline_equals_the_plain_one_and_can_run_again(spark, landing, tmp_path):
    plain = rows(run_medallion(spark, landing, str(tmp_path / "plain"), REPORT))
    for run in range(2):
        assert rows(run_medallion(spark, landing, str(tmp_path / "lake"), REPORT, versioned=True)) == plain
        assert current_version(spark, layer(str(tmp_path / "lake"), "gold", REPORT.name)).number == run


def test_a_gold_job_that_dies_leaves_the_old_gold(spark, landing, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    before = rows(run_medallion(spark, landing, lake, REPORT, versioned=True))
    summarise = medallion.summarise

    def broken(*args):
        return summarise(*args).withColumn("avg_height", F.raise_error(F.lit("lost")).cast("double"))

    monkeypatch.setattr(medallion, "summarise", broken)
    with pytest.raises(Exception, match="lost"):
        run_medallion(spark, landing, lake, REPORT, versioned=True)
    assert rows(read_tier(spark, lake, "gold", REPORT.name, versioned=True)) == before


def test_the_command_line_writes_versions(spark, landing, tmp_path):
    lake = str(tmp_path / "lake")
    for job in ("bronze", "silver", "gold"):
        source = ["--landing", landing] if job == "bronze" else []
        run_job.main([job, *source, "--lake", lake, "--versions"])
    assert read_tier(spark, lake, "gold", REPORT.name, versioned=True).count() == 3


def test_working_files_are_removed_on_demand(spark, monkeypatch):
    made = []
    monkeypatch.setattr(files, "_MADE", made)
    held = files.written(spark.range(5), "kept")
    files.working_folder(spark, "never-written")
    folder = made[0].removeprefix("file://")
    assert held.count() == 5 and len(made) == 2 and os.path.isdir(folder)
    assert files.remove_working_files(spark) == 1 and not os.path.exists(folder)
    assert files.remove_working_files(spark) == 0
