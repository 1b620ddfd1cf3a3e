"""Readers, writers and the scratch folder."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from niimble.plans.metrics import extract
from niimble.sources import tables
from niimble.sources.schemas import schema_of, table_names
from tests import golden


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(golden.METRIC_ROWS, schema_of("metric_input"))


@pytest.mark.parametrize("fmt", ["parquet", "csv", "CSV"])
def test_path_roundtrip(spark, rows, tmp_path, fmt):
    path = str(tmp_path / "t")
    tables.write_path(rows, path, fmt)
    tables.write_path(rows, path, fmt)
    back = tables.read_path(spark, path, fmt, rows.schema)
    assert sorted(back.collect()) == sorted(rows.collect())
    tables.write_path(rows, path, fmt, mode="append")
    assert tables.read_path(spark, path, fmt, rows.schema).count() == 2 * len(golden.METRIC_ROWS)


def test_dotted_paths_and_plain_names_are_what_they_are_called(spark, rows, tmp_path):
    tables.write_path(rows, str(tmp_path / "data.parquet"))
    assert tables.read_path(spark, str(tmp_path / "data.parquet")).count() == 4


def test_csv_without_schema_is_text(spark, rows, tmp_path):
    tables.write_path(rows, str(tmp_path / "t"), "csv")
    assert {t for _, t in tables.read_path(spark, str(tmp_path / "t"), "csv").dtypes} == {"string"}


def test_unsupported_format(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="format must be one of"):
        tables.write_path(rows, str(tmp_path / "t"), "orc2")
    with pytest.raises(ValueError, match="format must be one of"):
        tables.read_path(spark, str(tmp_path / "t"), "xls")
    with pytest.raises(ValueError, match="format must be one of"):
        tables.write_catalog(rows, "some.table", "xls")


def test_catalog_roundtrip(spark, rows):
    tables.write_catalog(rows, "staging.metric_rows")
    assert sorted(tables.read_catalog(spark, "staging.metric_rows").collect()) == sorted(rows.collect())
    tables.write_catalog(rows.select("key"), "staging.metric_rows")
    assert tables.read_catalog(spark, "staging.metric_rows").columns == ["key"]
    tables.write_catalog(rows, "one_part_name")
    assert tables.read_catalog(spark, "one_part_name").count() == 4


def test_typed_csv_finds_columns_by_name(spark, tmp_path):
    text = spark.createDataFrame([("1.5", "A", "x"), ("none", "B", "2")], "value string, key string, weight string")
    tables.write_path(text, str(tmp_path / "t"), "csv")
    assert sorted(extract(spark, str(tmp_path / "t")).collect(), key=str) == [("A", 1.5, None), ("B", None, 2.0)]


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(PySparkException):
        extract(spark, str(tmp_path / "nowhere")).collect()


def test_partition_overwrite_replaces_one_run(spark, rows, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    first = store.put("t", rows.withColumn("run_id", F.lit("2026")), "2026")
    assert first.schema["run_id"].dataType.typeName() == "string"
    store.put("t", rows.withColumn("run_id", F.lit("r2")), "r2")
    again = store.put("t", rows.where("key = 'A'").withColumn("run_id", F.lit("2026")), "2026")
    assert again.count() == 2
    assert store.get("t", first.schema, "r2").count() == 4


def test_an_empty_result_clears_the_run(spark, rows, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    first = store.put("t", rows.withColumn("run_id", F.lit("r1")), "r1")
    store.put("t", rows.withColumn("run_id", F.lit("r2")), "r2")
    assert store.put("t", first.where("1 = 0"), "r1").count() == 0
    assert store.get("t", first.schema, "r1").count() == 0
    assert store.get("t", first.schema, "r2").count() == 4


@pytest.mark.parametrize("other", ["r2", None])
def test_rows_of_another_run_are_not_written(spark, rows, tmp_path, other):
    store = tables.TableStore(spark, str(tmp_path))
    first = store.put("t", rows.withColumn("run_id", F.lit("r1")), "r1")
    mixed = rows.withColumn("run_id", F.when(F.col("key") == "A", F.lit(other)).otherwise("r1"))
    with pytest.raises(tables.ForeignRun, match="of run"):
        store.put("t", mixed, "r1")
    assert store.get("t", first.schema, "r1").count() == 4


def failing(rows):
    """Rows of which the last to be written ends its task with an error."""
    broken = F.when(F.col("key") == "B", F.raise_error(F.lit("disk lost")).cast("double")).otherwise(F.col("value"))
    return rows.withColumn("value", broken).repartition(3, "key")


def test_a_write_that_dies_leaves_the_old_rows(spark, rows, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    tagged = rows.withColumn("run_id", F.lit("r1"))
    store.put("t", tagged, "r1")
    with pytest.raises(PySparkException, match="disk lost"):
        store.put("t", failing(tagged), "r1", checked=True)
    assert sorted(store.get("t", tagged.schema, "r1").collect()) == sorted(tagged.collect())
    assert store.clean_up("t", "r1") == []  # it might still be running
    assert len(store.clean_up("t", "r1", older_than=0)) <= 1
    assert store.clean_up("t", "r1", older_than=0) == []
    assert store.get("t", tagged.schema, "r1").count() == 4


@pytest.mark.parametrize("dies", ["_publish", "_retire"])
def test_a_driver_killed_beside_the_swap(spark, rows, tmp_path, monkeypatch, dies):
    """Before the swap the old rows stay, after it the new ones; a part is never read."""
    store = tables.TableStore(spark, str(tmp_path))
    tagged = rows.withColumn("run_id", F.lit("r1"))
    store.put("t", tagged, "r1")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables if dies == "_publish" else tables.TableStore, dies, killed)
        with pytest.raises(KeyboardInterrupt):
            store.put("t", tagged.where("key = 'A'"), "r1")
    left = store.clean_up("t", "r1", older_than=0)
    assert store.get("t", tagged.schema, "r1").count() == (4 if dies == "_publish" else 2)
    assert len(left) == (1 if dies == "_publish" else 0)


def test_readers_that_began_before_a_swap_can_end(spark, rows, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    tagged = rows.withColumn("run_id", F.lit("r1"))
    before = store.put("t", tagged, "r1")
    after = store.put("t", before.where("key = 'A'"), "r1")  # replaced by what is computed from its own rows
    assert (before.count(), after.count(), store.get("t", tagged.schema, "r1").count()) == (4, 2, 2)
    for _ in range(4):
        store.put("t", store.get("t", tagged.schema, "r1"), "r1")
    held = [p.name for p in (tmp_path / "t" / "run_id=r1").iterdir() if not p.name.startswith(".")]
    assert sorted(n.rpartition("-")[0] for n in held) == ["_manifest", "_manifest", "attempt", "attempt"]
    assert store.get("t", tagged.schema, "r1").count() == 2


def test_of_two_writers_the_last_to_commit_stays(spark, rows, tmp_path, monkeypatch):
    store = tables.TableStore(spark, str(tmp_path), keep=5)
    tagged = rows.withColumn("run_id", F.lit("r1"))
    store.put("t", tagged, "r1")
    stale = store._manifests(store.run_path("t", "r1"))
    store.put("t", tagged.where("key = 'A'"), "r1")
    real = tables.TableStore._manifests
    answers = [stale]  # the second writer listed the folder before the first had committed
    monkeypatch.setattr(tables.TableStore, "_manifests", lambda self, folder: answers.pop() if answers else real(self, folder))
    store.put("t", tagged.where("1 = 0"), "r1")
    assert store.get("t", tagged.schema, "r1").count() == 0
    assert sorted(real(store, store.run_path("t", "r1"))) == [1, 2, 3]


def test_runs_of_a_table(spark, rows, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    assert store.runs("t") == []
    with pytest.raises(tables.NoSuchRun, match="no rows of run 'a/b'"):
        store.get("t", rows.schema, "a/b")
    for run in ("r 2", "a/b"):
        store.put("t", rows.withColumn("run_id", F.lit(run)), run)
    assert store.runs("t") == ["a/b", "r 2"]
    store.put("t", rows.where("key = 'A'").withColumn("run_id", F.lit("a/b")), "a/b")
    every = store.everything("t", rows.withColumn("run_id", F.lit("")).schema)
    assert {r[0]: r[1] for r in every.groupBy("run_id").count().collect()} == {"a/b": 2, "r 2": 4}
    assert store.everything("none", every.schema).collect() == []


def test_scratch_tables_are_removed_at_the_end_of_their_block(spark, rows):
    from pathlib import Path

    with tables.scratch(spark):
        kept = tables.materialize(rows, "rows")
        folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
        assert folder.exists()
    assert not folder.exists()
    outside = tables.materialize(rows, "rows")
    assert outside.count() == 4


def test_materialized_rows_are_read_from_the_shared_folder(spark, rows):
    kept = tables.materialize(rows, "rows")
    assert sorted(kept.collect()) == sorted(rows.collect()) and kept.schema == rows.schema
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in kept.inputFiles())


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = tables.scratch_path(spark, "a"), tables.scratch_path(spark, "a")
    assert one != two and one.startswith(shared)


def test_every_schema_parses():
    assert len(table_names()) == 30
    assert all(len(schema_of(n).fields) >= 3 for n in table_names())
    with pytest.raises(ValueError, match="no such table"):
        schema_of("unknown")
