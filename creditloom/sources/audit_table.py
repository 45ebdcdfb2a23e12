"""The audit table: loads that appear and disappear as a whole, and pages that open only the files they need.

Data files lie below ``data`` by date, source and load, each load under a name of its own, and are never changed. What is part of the table
says its newest *snapshot*, a small Parquet table below ``_snapshots`` with one row per live file: where it is, how many rows of each tier it holds, and
its first and last row in page order (newest first, equal times by id). A change writes its files, then the next snapshot beside the others, and renames that
into place. The rename is the one moment at which readers see the change; it fails if another writer was first, and is then tried again on
top of that writer's snapshot. Files of jobs that failed on the way are in no snapshot and are never read.

Every load is sorted in page order over all its files, so files of a load do not overlap, and the rank of a page says from the counts alone which
files can hold it.
"""

from __future__ import annotations

import time
import uuid
from bisect import bisect_left, bisect_right
from itertools import accumulate

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.scalars import TIERS
from creditloom.sources.schemas import AUDIT_SCHEMA

ROWS_PER_FILE = 1_000_000
#: Snapshots that stay readable; files that only older ones name are deleted.
KEPT_SNAPSHOTS = 2
COMMIT_ATTEMPTS = 20
PARTITIONS = ("predicted_date", "source", "load")
_EDGE = T.StructType([T.StructField("back", T.LongType()), T.StructField("id", T.StringType())])
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("predicted_date", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("load", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("added", T.LongType()),
        T.StructField("n", T.LongType()),
        *[T.StructField(f"n_{tier.lower()}", T.LongType()) for tier in TIERS],
        T.StructField("newest", T.TimestampType()),
        T.StructField("first", _EDGE),
        T.StructField("last", _EDGE),
    ]
)


def page_edge(time_column: str = "predicted_at", key: str = "id") -> Column:
    """A row's place in page order as a comparable pair: microseconds back in time, then the id."""
    return F.struct((-F.unix_micros(time_column)).alias("back"), F.col(key).alias("id"))


class AuditTable:
    """One audit table, wherever its folder lies."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._paths = jvm.org.apache.hadoop.fs.Path
        self._fs = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ snapshots

    def versions(self) -> list[int]:
        """Numbers of the committed snapshots, oldest first."""
        found = self._fs.globStatus(self._paths(f"{self.path}/_snapshots/v=*")) or []
        return sorted(int(f.getPath().getName()[2:]) for f in found)

    def files(self, version: int | None = None) -> DataFrame:
        """One row per live file of a snapshot, the newest by default."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], SNAPSHOT_SCHEMA)
        return self.spark.read.schema(SNAPSHOT_SCHEMA).parquet(self._snapshot(known[-1] if version is None else version))

    def _snapshot(self, version: int) -> str:
        return f"{self.path}/_snapshots/v={version:012d}"

    def _switch(self, draft: str, version: int) -> bool:
        """Rename a finished snapshot into place; False if that version exists already."""
        jvm = self.spark._jvm
        source, target = (self._fs.makeQualified(self._paths(p)) for p in (draft, self._snapshot(version)))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        no_overwriting = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(source, target, no_overwriting)
        except Py4JJavaError as refused:
            if "FileAlreadyExistsException" in str(refused.java_exception):
                return False
            raise
        return True

    def _commit(self, gone: Column, new: list[Row]) -> None:
        """The next snapshot: files of the newest one without those ``gone``, and the ``new`` ones."""
        for attempt in range(COMMIT_ATTEMPTS):
            version = max(self.versions(), default=0) + 1
            added = self.spark.createDataFrame([Row(**{**r.asDict(), "added": version}) for r in new], SNAPSHOT_SCHEMA)
            draft = f"{self.path}/_snapshots/_draft-{uuid.uuid4().hex}"
            kept = self.files().where(~F.coalesce(gone, F.lit(False)))
            kept.unionByName(added).coalesce(1).write.parquet(draft)
            if self._switch(draft, version):
                self._expire()
                return
            self._fs.delete(self._paths(draft), True)
            time.sleep(0.05 * (attempt + 1))
        raise RuntimeError(f"{self.path}: other writers were first {COMMIT_ATTEMPTS} times")

    def _expire(self) -> None:
        """Delete old snapshots and the files that only they name. What fails here is tried again after the next change."""
        known = self.versions()
        old, kept = known[:-KEPT_SNAPSHOTS], known[-KEPT_SNAPSHOTS:]
        if not old:
            return
        live = {r.file for v in kept for r in self.files(v).select("file").collect()}
        for version in old:
            for r in self.files(version).select("file").collect():
                if r.file not in live:
                    self._fs.delete(self._paths(f"{self.path}/data/{r.file}"), False)
            self._fs.delete(self._paths(self._snapshot(version)), True)

    # ------------------------------------------------------------ changes

    def _write(self, rows: DataFrame, source: str, load: str) -> list[Row]:
        """Write rows as files of a load of their own; returns their snapshot rows."""
        name = f"{load}-{uuid.uuid4().hex}"
        timed = F.when(F.col("predicted_at").isNull(), F.raise_error(F.lit("a score has no time"))).otherwise(F.col("predicted_at"))
        # the partition columns come first, as the writer would else sort by them once more and lose the order inside
        order = [*PARTITIONS, F.unix_micros("predicted_at").desc(), "id"]
        # the rows may be dear to compute, and cutting them into ranges reads them twice
        staged = f"{self.path}/_staging/{name}"
        rows.withColumns({"predicted_at": timed, "source": F.lit(source), "load": F.lit(name)}).write.parquet(staged)
        placed = self.spark.read.schema(AUDIT_SCHEMA).parquet(staged)
        # Spark makes few files of a small load: the number of ranges is adaptive
        ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
        data = f"{self.path}/data"
        writer = ordered.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "snappy")
        writer.partitionBy(*PARTITIONS).parquet(data)
        self._fs.delete(self._paths(staged), True)
        dates = [f.getPath().toString() for f in self._fs.globStatus(self._paths(f"{data}/predicted_date=*/source={source}/load={name}")) or []]
        if not dates:
            return []
        written = self.spark.read.schema(AUDIT_SCHEMA).option("basePath", data).parquet(*dates)
        whole = F.regexp_extract(F.col("_metadata.file_path"), "/data/(predicted_date=[^/]*/.*)$", 1)
        by_file = written.groupBy(whole.alias("file"), "predicted_date", "source").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col("risk_tier") == tier).alias(f"n_{tier.lower()}") for tier in TIERS],
            F.max("predicted_at").alias("newest"), F.min(page_edge()).alias("first"), F.max(page_edge()).alias("last"),
        )
        found = by_file.withColumns({"load": F.lit(load), "name": F.lit(name), "added": F.lit(0).cast("long")})
        return found.select(SNAPSHOT_SCHEMA.names).collect()

    def append(self, rows: DataFrame, source: str, load: str) -> None:
        """Add one load; a load of that source and name is replaced, so a retry does not double it."""
        self._commit((F.col("source") == source) & (F.col("load") == load), self._write(rows, source, load))

    def replace(self, rows: DataFrame, source: str) -> None:
        """Put rows in the place of everything a source has loaded, and of nothing else."""
        self._commit(F.col("source") == source, self._write(rows, source, "bulk"))

    def compact(self, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Merge the files of a source that are less than a quarter full; returns how many there were.

        The newest load of each source stays as it is: a stream may send that one again.
        """
        live = self.files()
        newest = live.groupBy("source").agg(F.max("added").alias("latest"))
        small = live.join(F.broadcast(newest), "source").where((F.col("added") < F.col("latest")) & (F.col("n") * 4 < rows_per_file))
        merged = 0
        for source, group in _by_source(small.select("source", "file").collect()).items():
            if len(group) < 2:
                continue
            rows = self.read_files(group)
            self._commit(F.col("file").isin(group), self._write(rows, source, f"merged-{uuid.uuid4().hex}"))
            merged += len(group)
        return merged

    # ------------------------------------------------------------ reading

    def read_files(self, files: list[str]) -> DataFrame:
        data = f"{self.path}/data"
        if not files:
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).option("basePath", data).parquet(*[f"{data}/{f}" for f in files])

    def read(self, since: Column | None = None) -> DataFrame:
        """All rows, or those from ``since`` on; files that end before it are not even listed."""
        live = self.files()
        if since is None:
            return self.read_files([r.file for r in live.select("file").collect()])
        wanted = live.where((F.col("predicted_date") >= since.cast("date")) & (F.col("newest") >= since))
        return self.read_files([r.file for r in wanted.select("file").collect()]).where(F.col("predicted_at") >= since)

    def page(self, limit: int, offset: int, since: Column | None = None, tier: str | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit``, newest first and equal times by id, out of the files that can hold them.

        A row's rank is at least the number of rows in files that end before its file begins, and less than the number in files that
        begin before its file ends. Files whose ranks all lie before the page are skipped by their counts. What Spark still skips is less than the opened files hold.
        ``since`` only cuts off the end of the order, so it does not move any rank.
        """
        if not 1 <= limit <= 1000:
            raise ValueError("limit must be between 1 and 1000")
        if offset < 0:
            raise ValueError("offset must not be negative")
        if tier is not None and tier not in TIERS:
            raise ValueError(f"tier must be one of {TIERS}")
        count = "n" if tier is None else f"n_{tier.lower()}"
        zones = self.files().where(F.col(count) > 0).select("file", F.col(count).alias("n"), "first", "last").collect()
        opened, skipped = files_of_page([(r.file, r.n, tuple(r.first), tuple(r.last)) for r in zones], limit, offset)
        rows = self.read_files(opened)
        if tier is not None:
            rows = rows.where(F.col("risk_tier") == tier)
        if since is not None:
            rows = rows.where(F.col("predicted_at") >= since)
        return rows.orderBy(F.col("predicted_at").desc(), "id").offset(offset - skipped).limit(limit)

    def total(self, since: Column | None = None, tier: str | None = None) -> DataFrame:
        """Rows of a period and tier, from the counts; only files that the period cuts are read."""
        count = F.col("n" if tier is None else f"n_{tier.lower()}")
        if since is None:
            return self.files().agg(F.coalesce(F.sum(count), F.lit(0)).alias("total"))
        start = -F.unix_micros(since.cast("timestamp"))
        begun = self.files().where(F.col("newest") >= since)
        whole = begun.where(F.col("last.back") <= start).agg(F.sum(count).alias("n"))
        cut = self.read_files([r.file for r in begun.where(F.col("last.back") > start).select("file").collect()])
        inside = cut.where((F.col("predicted_at") >= since) & (F.lit(tier is None) | (F.col("risk_tier") == F.lit(tier))))
        return whole.unionByName(inside.agg(F.count(F.lit(1)).alias("n"))).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


def _by_source(rows: list[Row]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.source, []).append(r.file)
    return out


def files_of_page(zones: list[tuple], limit: int, offset: int) -> tuple[list[str], int]:
    """Files (name, rows, first, last) that can hold ranks ``offset`` to ``offset + limit``, and how many rows lie in files before them all."""
    by_last = sorted(zones, key=lambda z: z[3])
    by_first = sorted(zones, key=lambda z: z[2])
    lasts, firsts = [z[3] for z in by_last], [z[2] for z in by_first]
    ended, begun = ([0, *accumulate(z[1] for z in order)] for order in (by_last, by_first))
    opened, skipped = [], 0
    for name, n, first, last in zones:
        if begun[bisect_right(firsts, last)] <= offset:
            skipped += n
        elif ended[bisect_left(lasts, first)] < offset + limit:
            opened.append(name)
    return opened, skipped
