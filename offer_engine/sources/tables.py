"""JSON input, catalog tables and stored intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from offer_engine.config import TableNames


_made: ContextVar[list | None] = ContextVar("made", default=None)


class Scratch:
    """What jobs leave in the shared folder: folders and databases, removed together.

    A job that has stored or collected its result needs none of them any more."""

    def __init__(self) -> None:
        self._undo: list[Callable[[], object]] = []

    @contextmanager
    def collecting(self) -> Iterator[None]:
        """Folders and databases made inside belong to this scratch, not to one around it."""
        token = _made.set(self._undo)
        try:
            yield
        finally:
            _made.reset(token)

    def clear(self) -> None:
        while self._undo:
            self._undo.pop()()


@contextmanager
def scratch() -> Iterator[None]:
    """Removes at its end what was made inside: store results elsewhere, or collect them."""
    own = Scratch()
    try:
        with own.collecting():
            yield
    finally:
        own.clear()


def _remember(undo: Callable[[], object]) -> None:
    made = _made.get()
    if made is not None:
        made.append(undo)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def temporary_names(spark: SparkSession) -> TableNames:
    """A database of its own in a new shared folder."""
    folder = shared_folder(spark)
    names = TableNames(schema=folder.rsplit("/", 1)[-1].replace("-", "_"))
    create_namespace(spark, names, folder)
    _remember(lambda: spark.sql(f"DROP DATABASE IF EXISTS {names.namespace} CASCADE"))
    return names


def read_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON lines or one JSON array per line. Without a schema Spark reads the input to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def create_namespace(spark: SparkSession, names: TableNames, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {names.namespace}{where}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    format: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write a catalog table and return it, so later jobs read the files and not the plan.

    Partitioned tables are rebalanced first: without it every task would write a file per
    partition, and one heavy partition would be written by one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if format:
        writer = writer.format(format)
    if format == "delta":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that every executor can reach.

    It lies in the folder named by spark.checkpoint.dir. Where that is unset, a temporary folder
    serves a local session only. Inside `scratch` it is removed at the end.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.gettempdir()
    folder = f"{root.rstrip('/')}/offer_engine-{uuid.uuid4().hex}"
    _remember(lambda: remove_folder(spark, folder))
    return folder


def store(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write df once and read it back: short lineage, pruned columns, no second evaluation."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("overwrite")
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
