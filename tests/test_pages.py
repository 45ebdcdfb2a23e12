"""Pages over audit tables as they are written, and runs by their full id."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from creditloom.operators import governance
from creditloom.operators import ordering as O


@pytest.mark.parametrize("skipped", [1, 10_000])
def test_pages_by_text_ids(spark, skipped, tmp_path):
    ids = [f"scores-load-{i * 7919 % 10007:x}-{'é' if i % 5 else 'z'}" for i in range(400)] + ["scores-load", "scores-load-", "", "scores-load-\x00", "scores-load-\x00\x00"]
    rows = [(x, None if i % 50 == 3 else 1000 if i % 4 else i) for i, x in enumerate(ids)]
    rows += [rows[1]] * 3 + [(None, 1000), (None, 1000)]
    path = str(tmp_path / "audit")
    spark.createDataFrame(rows, "id string, s long").select("id", F.timestamp_seconds("s").alias("ts")).write.parquet(path)
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0] is not None, (r[0] or "").encode()))
    for offset in (1, 150, 290, len(rows) - 3, len(rows)):
        got = O.seek_page(spark.read.parquet(path), "ts", "id", 20, offset, skipped).collect()
        assert [r.id for r in got] == [r[0] for r in order[offset : offset + 20]]


def test_ranks_are_narrowed_down(spark):
    """Numbers with heavy ties at both ends and gaps between; a few aggregations, and few rows from the value to the rank."""
    values = sorted([0] * 400 + [10**15] * 400 + [i * i for i in range(300)] + [7] * 50)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long").repartition(5)
    for rank in (0, 5, 399, 400, 455, 600, 748, 749, 1000, 1149):
        low, before = O.narrowed(df, "v", rank, 20)
        assert before == sum(v < low for v in values) and low <= values[rank]
        assert rank - before < 20 or values[rank] == low
    assert O.narrowed(df, "v", len(values)) is None and O.narrowed(df.limit(0), "v", 0) is None
    halves = spark.range(1000).selectExpr("cast(id as double) / 7 AS v")
    low, before = O.narrowed(halves, "v", 777, 5)
    assert 777 - before < 5 and low == pytest.approx(before / 7)


def test_small_offsets_do_not_skip_rows_in_one_task(spark):
    df = spark.range(30_000).select("id", F.timestamp_seconds("id").alias("ts"))
    plan = O.seek_page(df, "ts", "id", 10, 20_000, 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "Offset 20000" not in plan and "limit=20010" not in plan


def test_run_by_full_id_or_newest_prefix(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 2, 1)
    runs = spark.createDataFrame([("abcdefgh-1", new), ("abcdefgh-2", old), ("abcdefgh", old), ("abcx", None)], "run_id string, created_at timestamp")
    found = {wanted: [r.run_id for r in governance.find_run(runs, wanted).collect()] for wanted in ("abcdefgh-2", "abcdefgh", "abcdefgh-", "abc", "abcx")}
    assert found == {"abcdefgh-2": ["abcdefgh-2"], "abcdefgh": ["abcdefgh"], "abcdefgh-": ["abcdefgh-1"], "abc": ["abcdefgh-1"], "abcx": ["abcx"]}
    for unknown in ("abcdefgh-3", "zz"):
        with pytest.raises(FileNotFoundError):
            governance.find_run(runs, unknown)
