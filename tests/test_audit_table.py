"""Snapshots, pages and compaction of the audit table."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from creditloom.sources import audit_table, writers
from creditloom.sources.audit_table import AuditTable, files_of_page


def scores(spark, rows, source="api"):
    """Audit rows of (applicant, probability, time)."""
    df = spark.createDataFrame(rows, "k long, p double, at timestamp")
    return writers.audit_rows(df, "k", F.col("p"), F.lit("0123456789"), F.col("at"), source)


AT = datetime(2024, 1, 2)


def seen(spark, path):
    return sorted((r.source, r.application_id) for r in AuditTable(spark, path).read().collect())


OLD, NEW = [("api", 1), ("batch_ingest", 1), ("batch_ingest", 2)], [("api", 1), ("batch_ingest", 7)]


@pytest.fixture
def written(spark, tmp_path):
    path = str(tmp_path / "audit")
    AuditTable(spark, path).append(scores(spark, [(1, 0.1, AT)]), "api", "stream-0")
    AuditTable(spark, path).replace(scores(spark, [(1, 0.1, AT), (2, 0.5, AT)], "batch_ingest"), "batch_ingest")
    assert seen(spark, path) == OLD
    return path


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step,wanted", [("_write", OLD), ("files written", OLD), ("draft written", OLD), ("renamed", NEW), ("_expire", NEW)])
def test_a_writer_stopped_at_any_step(spark, written, monkeypatch, step, wanted):
    """A reader between two steps sees all of the old load or all of the new one."""
    table = AuditTable(spark, written)
    write, switch = table._write, table._switch

    def stop(*_, **__):
        raise Stopped

    def after(run):
        def both(*args):
            run(*args)
            raise Stopped
        return both

    patches = {"_write": ("_write", stop), "files written": ("_write", after(write)), "draft written": ("_switch", stop),
               "renamed": ("_switch", after(switch)), "_expire": ("_expire", stop)}
    monkeypatch.setattr(table, *patches[step])
    with pytest.raises(Stopped):
        table.replace(scores(spark, [(7, 0.9, AT)], "batch_ingest"), "batch_ingest")
    assert seen(spark, written) == wanted
    monkeypatch.undo()
    # the same change, tried again, leaves no trace of the first try
    AuditTable(spark, written).replace(scores(spark, [(7, 0.9, AT)], "batch_ingest"), "batch_ingest")
    assert seen(spark, written) == NEW


def test_a_reader_keeps_its_snapshot(spark, written):
    before = AuditTable(spark, written).read()
    AuditTable(spark, written).replace(scores(spark, [(7, 0.9, AT)], "batch_ingest"), "batch_ingest")
    assert before.count() == 3 and seen(spark, written) == NEW
    for i in range(3):
        AuditTable(spark, written).append(scores(spark, [(i, 0.9, AT)]), "api", "stream-1")
    table = AuditTable(spark, written)
    assert len(table.versions()) == audit_table.KEPT_SNAPSHOTS
    on_disk = {os.path.join(d, f).split("/data/")[1] for d, _, names in os.walk(f"{written}/data") for f in names if f.endswith(".parquet")}
    assert on_disk == {r.file for v in table.versions() for r in table.files(v).collect()}


def test_two_writers_at_once(spark, written, monkeypatch):
    """The slower writer finds its version taken and builds on the faster one's."""
    slow, switch, tries = AuditTable(spark, written), AuditTable(spark, written)._switch, []

    def overtaken(draft, version):
        if not tries:
            AuditTable(spark, written).append(scores(spark, [(5, 0.2, AT)]), "api", "stream-5")
        tries.append(version)
        return switch(draft, version)

    monkeypatch.setattr(slow, "_switch", overtaken)
    slow.append(scores(spark, [(6, 0.2, AT)]), "api", "stream-6")
    assert len(tries) == 2 and seen(spark, written) == sorted([*OLD, ("api", 5), ("api", 6)])
    monkeypatch.setattr(slow, "_switch", lambda draft, version: False)
    monkeypatch.setattr(audit_table, "COMMIT_ATTEMPTS", 2)
    with pytest.raises(RuntimeError, match="other writers"):
        slow.append(scores(spark, [(8, 0.2, AT)]), "api", "stream-8")


def test_empty_loads_and_missing_times(spark, tmp_path):
    table = AuditTable(spark, str(tmp_path / "audit"))
    assert table.read().count() == 0 and table.page(10, 0).collect() == [] and table.total().first().total == 0
    table.append(scores(spark, []), "api", "stream-0")
    assert table.read().count() == 0
    with pytest.raises(Exception, match="no time"):
        table.append(scores(spark, [(1, 0.5, None)]), "api", "stream-1")
    for bad in ({"limit": 0, "offset": 0}, {"limit": 1001, "offset": 0}, {"limit": 1, "offset": -1}, {"limit": 1, "offset": 0, "tier": "NONE"}):
        with pytest.raises(ValueError):
            table.page(**bad)


@pytest.fixture(scope="module")
def paged(spark, tmp_path_factory):
    """Loads that overlap in time, one of them all at one moment, in files of 40 rows; and the rows in page order."""
    random.seed(6)
    path, start = str(tmp_path_factory.mktemp("paged") / "audit"), datetime(2024, 1, 1)
    loads = {f"stream-{k}": [(1000 * k + i, random.random(), start + timedelta(hours=20 * k + random.random() * 30)) for i in range(150)] for k in range(4)}
    bulk = [(10_000 + i, random.random(), start + timedelta(hours=50)) for i in range(300)]
    default, audit_table.ROWS_PER_FILE = audit_table.ROWS_PER_FILE, 40
    for name, rows in loads.items():
        AuditTable(spark, path).append(scores(spark, rows), "api", name)
    AuditTable(spark, path).replace(scores(spark, bulk, "batch_ingest"), "batch_ingest")
    audit_table.ROWS_PER_FILE = default
    return path, AuditTable(spark, path).read().collect()


@pytest.mark.parametrize("tier", [None, "HIGH"])
@pytest.mark.parametrize("days", [None, 2])
def test_pages_are_those_of_the_whole_order(spark, paged, tier, days):
    path, rows = paged
    since = None if days is None else datetime(2024, 1, 5) - timedelta(days=days)
    order = sorted(((-r.predicted_at.timestamp(), r.id) for r in rows if tier in (None, r.risk_tier) and (since is None or r.predicted_at >= since)))
    table = AuditTable(spark, path)
    limit_from = None if since is None else F.lit(since)
    assert table.total(limit_from, tier).first().total == len(order)
    for offset in (0, 30, 299, 317, 500, len(order) - 5, len(order), 5000):
        got = [(-r.predicted_at.timestamp(), r.id) for r in table.page(50, max(0, offset), limit_from, tier).collect()]
        assert got == order[max(0, offset) : max(0, offset) + 50]


def test_a_page_opens_few_files(spark, paged):
    path, rows = paged
    table = AuditTable(spark, path)
    n_files = table.files().count()
    assert n_files >= 20
    for offset in (0, 320, 700):
        assert len(table.page(20, offset).inputFiles()) <= 6
    since = table.read(F.lit(datetime(2024, 1, 4)))
    assert 0 < len(since.inputFiles()) < n_files / 3


def test_files_of_a_page_by_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        files = [sorted(rng.randrange(60) * 1000 + k for k in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 12))]
        files = [[row * 100 + n for row in rows] for n, rows in enumerate(files)]
        zones = [(n, len(rows), rows[0], rows[-1]) for n, rows in enumerate(files)]
        order = sorted(row for rows in files for row in rows)
        limit, offset = rng.randint(1, 6), rng.randrange(len(order) + 3)
        opened, skipped = files_of_page(zones, limit, offset)
        left = sorted(row for n in opened for row in files[n])
        assert left[offset - skipped : offset - skipped + limit] == order[offset : offset + limit]


def test_compaction_keeps_rows_and_the_newest_load(spark, tmp_path):
    path = str(tmp_path / "audit")
    for k in range(5):
        AuditTable(spark, path).append(scores(spark, [(k, 0.1 * k, AT + timedelta(minutes=k))]), "api", f"stream-{k}")
    rows, table = seen(spark, path), AuditTable(spark, path)
    assert table.compact() == 4 and seen(spark, path) == rows and table.files().count() == 2
    # the stream sends its newest batch again
    table.append(scores(spark, [(4, 0.4, AT + timedelta(minutes=4))]), "api", "stream-4")
    assert seen(spark, path) == rows and table.compact() == 0
    assert [r.application_id for r in table.page(3, 1).collect()] == [3, 2, 1]
