"""Small helpers shared by the operators: Arrow stages, hashes of ids, scratch tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path
from zipfile import ZipFile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import niimble
from niimble.sources.tables import materialize, scratch_path

__all__ = ["arrow_stage", "fields", "fold", "hash_draw", "hash_sample", "labelled_sample", "materialize", "read_table", "scratch_path", "text_session"]


# Arrow batches of texts are kept small: a task holds one, and what numpy makes of it.
TEXT_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's Python files to the executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(niimble.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="niimble-")) / "niimble_package.zip"
    with ZipFile(archive, "w") as files:
        for file in sorted(package.rglob("*.py")):
            files.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def text_session(spark: SparkSession) -> SparkSession:
    """The session, set for tables of texts, its executors able to import this package."""
    ship_package(spark)
    for key, value in TEXT_CONF.items():
        spark.conf.set(key, value)
    return spark


def read_table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fields(rows: DataFrame, *names: str) -> list[StructField]:
    return [rows.schema[n] for n in names]


def arrow_stage(
    rows: DataFrame,
    work: Callable[[pa.RecordBatch], Iterator[dict[str, pa.Array]]],
    schema: StructType,
) -> DataFrame:
    """``work`` on each Arrow batch of the rows; it yields columns by name, batch for batch."""
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return rows.mapInArrow(run, schema)


def fold(id_column: str | Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; fold 0 is held out. A NULL id counts as the empty text."""
    c = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds


def hash_draw(*by: str) -> Column:
    """A number from 0 to 1 that depends on the columns ``by`` alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *by), 11) / F.lit(float(1 << 53))


def hash_sample(rows: DataFrame, about: int, *by: str) -> DataFrame:
    """About ``about`` of the rows, those whose columns ``by`` have the smallest hashes; all if there are fewer.

    Rows are counted once; the choice depends on the rows alone, so a retried task repeats it.
    """
    return rows.where(hash_draw(*by) < F.lit(min(1.0, about / max(1, rows.count()))))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, about: int, rule: Callable[[str], Column]
) -> DataFrame:
    """``text, label`` of about ``about`` labelled ids, one row each, chosen by hash.

    ``rule`` settles several labels of an id (such as F.max); of its different texts that of the smallest hash
    counts. So neither an id with very many labels nor one with very many texts makes the sample larger.
    """
    known = one_label(labels, id_column, label_column, rule)
    sample = F.broadcast(hash_sample(known, about, "id"))  # about ``about`` rows, as ids are distinct
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = texts.join(sample, "id").groupBy("id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("label").alias("label")
    )
    return found.select("text", "label")


def one_label(labels: DataFrame, id_column: str, label_column: str, rule: Callable[[str], Column]) -> DataFrame:
    """``id, label``: each labelled id once. Rows without id or label are left out."""
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    known = known.select(F.col(id_column).alias("id"), F.col(label_column).cast("double").alias("label"))
    return known.groupBy("id").agg(rule("label").alias("label"))
