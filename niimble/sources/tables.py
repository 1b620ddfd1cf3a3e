"""Readers and writers. Paths and catalog names have functions of their own; nothing is guessed."""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = ("parquet", "csv", "delta")
RUN_COLUMN = "run_id"

# Paths given out within each open ``scratch`` block.
_open_scratch: list[list[str]] = []


def _checked(fmt: str) -> str:
    if fmt.lower() not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    return fmt.lower()


def read_path(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Files under a path. CSV has a header and, without a schema, only text columns.

    With a schema the CSV header must name its columns in that order; if not, the read fails.
    """
    reader = spark.read.format(_checked(fmt))
    if fmt.lower() == "csv":
        reader = reader.options(header=True, enforceSchema=False)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_path(
    rows: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Files under a path. With ``partition_by``, overwriting replaces only the partitions written."""
    writer = rows.write.format(_checked(fmt)).mode(mode)
    if fmt.lower() == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def write_catalog(
    rows: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite", location: str | None = None
) -> None:
    """A catalog table; its namespace is created if need be and its schema may change.

    With ``location`` the files lie there, not in the warehouse folder.
    """
    namespace, _, _ = name.rpartition(".")
    if namespace:
        rows.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    writer = rows.write.format(_checked(fmt)).mode(mode)
    if fmt.lower() == "delta":
        writer = writer.option("overwriteSchema", True)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def read_typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV columns found by header name, each cast to its type; text that does not fit is NULL.

    A missing path or column is an error: there is no stand-in data.
    """
    text = read_path(spark, path, "csv")
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for ``name`` in the shared folder of ``spark.checkpoint.dir``.

    A local folder serves only a local session that has none set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="niimble-")
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in _open_scratch:
        made.append(path)
    return path


def materialize(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a scratch table and read back: for a costly frame used several times.

    The written files also tell Spark the true size of the rows, which it cannot know of a plan.
    """
    path = scratch_path(rows.sparkSession, name)
    write_path(rows, path)
    return read_path(rows.sparkSession, path, schema=rows.schema)


class ForeignRun(ValueError):
    """Rows of another run than the one they were to be written for."""


def check_run(rows: DataFrame, run_id: str, name: str) -> None:
    """An error if any row carries another run id, or none."""
    foreign = rows.where(~F.col(RUN_COLUMN).eqNullSafe(F.lit(run_id))).select(RUN_COLUMN).limit(1).collect()
    if foreign:
        raise ForeignRun(f"{name} has rows of run {foreign[0][0]!r}, not of {run_id!r}")


class NoSuchRun(LookupError):
    """A table of a run that was never committed."""


MANIFEST, ATTEMPT = "_manifest-", "attempt-"


@dataclass(frozen=True)
class TableStore:
    """Tables under one root, a folder per run: a run replaces its own rows, also by none, and no others.

    Every write goes to an attempt folder of its own. It counts from the moment its manifest, a small file
    with the next number, has been renamed into place; readers take the attempt that the highest manifest
    names. So a write that dies leaves the rows that were there, readers see the old rows or the new ones
    and never a part, and a run may be replaced by what is computed from its own rows. Of two writers at
    once the one that commits last stays. The last ``keep`` attempts remain, so that readers that began
    before a swap can end; ``clean_up`` removes what dead writes left.
    """

    spark: SparkSession
    root: str
    keep: int = 2

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def run_path(self, name: str, run_id: str) -> str:
        return f"{self.path(name)}/{RUN_COLUMN}={quote(run_id, safe='-_. ')}"

    def put(self, name: str, rows: DataFrame, run_id: str, checked: bool = False) -> DataFrame:
        """Write the rows of a run and return them as read back, which cuts their lineage.

        Rows of another run are an error, and nothing is written. ``checked``: the caller has seen to that.
        """
        if not checked:
            check_run(rows, run_id, name)
        folder = self.run_path(name, run_id)
        attempt = f"{ATTEMPT}{uuid.uuid4().hex}"
        write_path(rows.drop(RUN_COLUMN), f"{folder}/{attempt}")
        number = self._commit(folder, attempt)
        self._retire(folder, number - self.keep)
        return self._rows(f"{folder}/{attempt}", rows.schema, run_id)

    def get(self, name: str, schema: StructType, run_id: str) -> DataFrame:
        """The rows of one run as last committed; other runs' folders are not read."""
        return self._rows(f"{self.run_path(name, run_id)}/{self.attempt(name, run_id)}", schema, run_id)

    def everything(self, name: str, schema: StructType) -> DataFrame:
        """The committed rows of all runs, pruned by run id when filtered by it."""
        paths = [f"{self.run_path(name, run)}/{self.attempt(name, run)}" for run in self.runs(name)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*paths).select(*schema.names)

    def attempt(self, name: str, run_id: str) -> str:
        """The folder of the committed write."""
        folder = self.run_path(name, run_id)
        manifests = self._manifests(folder)
        if not manifests:
            raise NoSuchRun(f"{name} holds no rows of run {run_id!r}")
        return self._named(folder, manifests[max(manifests)])

    def runs(self, name: str) -> list[str]:
        """Run ids of which the table has committed rows."""
        prefix = f"{RUN_COLUMN}="
        folders = [n for n, _ in _children(self.spark, self.path(name)) if n.startswith(prefix)]
        return sorted(unquote(n.removeprefix(prefix)) for n in folders if self._manifests(f"{self.path(name)}/{n}"))

    def clean_up(self, name: str, run_id: str, older_than: float = 86_400.0) -> list[str]:
        """Remove what no manifest names and nobody has touched for so many seconds; returns the names.

        A write that takes longer than that between its files would lose them: give the longest one time.
        """
        folder = self.run_path(name, run_id)
        named = {self._named(folder, m) for m in self._manifests(folder).values()}
        left = []
        for child, changed in _children(self.spark, folder):
            own = child.startswith((ATTEMPT, "_writing-")) and child not in named
            if own and time.time() - max([changed, *_changes(self.spark, f"{folder}/{child}")]) >= older_than:
                remove_path(self.spark, f"{folder}/{child}")
                left.append(child)
        return sorted(left)

    def _rows(self, path: str, schema: StructType, run_id: str) -> DataFrame:
        stored = StructType([f for f in schema if f.name != RUN_COLUMN])
        rows = read_path(self.spark, path, schema=stored)
        return rows.withColumn(RUN_COLUMN, F.lit(run_id)).select(*schema.names)

    def _manifests(self, folder: str) -> dict[int, str]:
        names = [n for n, _ in _children(self.spark, folder) if n.startswith(MANIFEST)]
        return {int(n.removeprefix(MANIFEST)): n for n in names}

    def _named(self, folder: str, manifest: str) -> str:
        return json.loads(_read_text(self.spark, f"{folder}/{manifest}"))["attempt"]

    def _commit(self, folder: str, attempt: str) -> int:
        """Rename a manifest to the next number; one that another writer takes meanwhile is passed over."""
        number = max(self._manifests(folder), default=0) + 1
        while not _publish(self.spark, json.dumps({"attempt": attempt}), folder, f"{MANIFEST}{number:012d}"):
            number += 1
        return number

    def _retire(self, folder: str, last: int) -> None:
        """Remove manifests up to a number, and then their attempts."""
        for number, manifest in self._manifests(folder).items():
            if number <= last:
                attempt = self._named(folder, manifest)
                remove_path(self.spark, f"{folder}/{manifest}")
                remove_path(self.spark, f"{folder}/{attempt}")


def _located(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """Names in a folder and when they were changed, in seconds; none where there is no folder."""
    files, target = _located(spark, folder)
    if not files.exists(target):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in files.listStatus(target)]


def _changes(spark: SparkSession, folder: str) -> list[float]:
    """When the files below a folder were changed, in seconds."""
    files, target = _located(spark, folder)
    found, listed = [], files.listFiles(target, True)
    while listed.hasNext():
        found.append(listed.next().getModificationTime() / 1000)
    return found


def _read_text(spark: SparkSession, path: str) -> str:
    files, target = _located(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _publish(spark: SparkSession, text: str, folder: str, name: str) -> bool:
    """Write a small file under another name and rename it; False if there is one of that name already."""
    jvm = spark._jvm
    files, target = _located(spark, f"{folder}/{name}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/_writing-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), no_options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end: what is to stay must have been written by then."""
    made: list[str] = []
    _open_scratch.append(made)
    try:
        yield
    finally:
        _open_scratch.remove(made)
        for path in made:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is."""
    files, target = _located(spark, path)
    files.delete(target, True)
