"""Session settings and the shared scratch folder every multi-pass job writes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # call sites of every column expression are only worth their cost while debugging
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "creditloom", **conf: str) -> SparkSession:
    """A session with the settings above; cluster sizing is left to the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a folder
    would be lost with its machine, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    path = (
        spark.conf.get("spark.checkpoint.dir", None)
        or sc.getConf().get("spark.checkpoint.dir")
        or sc.getCheckpointDir()
    )
    if path:
        return path
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="creditloom-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/creditloom/{label}-{uuid.uuid4().hex}"


@dataclass
class Scratch:
    """Paths that a block has written below the shared folder: those that go at its end, and those that outlive it."""

    made: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)

    def keep_last(self) -> None:
        """The copy written last outlives the block."""
        self.kept.append(self.made.pop())


_SCRATCH: ContextVar[Scratch | None] = ContextVar("scratch", default=None)
#: Whether Spark deletes the shuffle files of a query as soon as the query is over, not when the driver's JVM next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """At the end of the block, also after an error, the copies go that ``materialise`` wrote in it and was not told to keep.

    For jobs whose result is written by then. Kept copies belong to the block around this one, if there is one.
    """
    outer, scope = _SCRATCH.get(), Scratch()
    token = _SCRATCH.set(scope)
    try:
        yield scope
    finally:
        _SCRATCH.reset(token)
        if outer is not None:
            outer.made.extend(scope.kept)
        for path in scope.made:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialise(df: DataFrame, label: str = "stage", keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several passes must see the same rows: the lineage is cut, the copy outlives
    lost executors, and later passes read only the columns they need. ``keep`` lets it outlive
    the ``scratch_scope`` it is written in. The shuffle files of the writing go with its end, as nothing else reads them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (scope := _SCRATCH.get()) is not None:
        (scope.kept if keep else scope.made).append(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A table of fixed small size (one row per column, group or range) held in the plan itself.

    Going through Arrow gives Spark a local relation whose size it knows, without a job.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)
