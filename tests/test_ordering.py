import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from creditloom import runtime as R
from creditloom.operators import ordering as O

random.seed(7)
N = 4001
ROWS = [
    # a third of all rows share one value
    (i, 5.0 if i % 3 == 0 else random.choice([None, random.gauss(0, 10)]), random.random(), "ab"[i % 2])
    for i in range(N)
]
random.shuffle(ROWS)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id long, hot double, u double, g string").repartition(5).cache()


@pytest.mark.parametrize("rows_per_range", [1_000_000, 300])
def test_medians_match_brute_force(df, rows_per_range):
    got = O.exact_medians(df, ["hot", "u"], rows_per_range)
    assert got["hot"] == pytest.approx(statistics.median([r[1] for r in ROWS if r[1] is not None]))
    assert got["u"] == pytest.approx(statistics.median([r[2] for r in ROWS]))


def test_median_of_nothing_is_null(spark):
    assert O.exact_medians(spark.createDataFrame([], "x double"), ["x"]) == {"x": None}


@pytest.mark.parametrize("rows_per_range", [1_000_000, 200])
def test_order_statistics_per_group(df, rows_per_range):
    wanted = [0, 1, 700, 1999]
    got = O.order_statistics(df, "u", lambda g, n: wanted, "g", rows_per_range)
    for g in "ab":
        values = sorted(r[2] for r in ROWS if r[3] == g)
        assert got[g] == {k: values[k] for k in wanted}


def test_missed_bracket_is_still_exact(df, monkeypatch):
    real = O.quantile_grids
    # a sketch that points far away from every rank asked for
    monkeypatch.setattr(O, "quantile_grids", lambda *a: {g: (n, [1e9] * len(grid)) for g, (n, grid) in real(*a).items()})
    values = sorted(r[2] for r in ROWS)
    assert O.order_statistics(df, "u", lambda g, n: [1234, 2000], None, 300)[0] == {1234: values[1234], 2000: values[2000]}


# one range; one level of ranges; three levels
LEVELS = [(1_000_000, 256), (100, 256), (20, 8)]


@pytest.mark.parametrize("rows_per_range,fan", LEVELS)
def test_running_totals(df, rows_per_range, fan):
    per_value = df.groupBy("g", "hot").agg(F.count(F.lit(1)).alias("n"))
    got = O.running_totals(per_value, "hot", ["n"], "g", rows_per_range, fan)
    rows = {(r.g, r.hot): r.cum_n for r in got.rows.collect()}
    for g in "ab":
        mine = [r[1] for r in ROWS if r[3] == g]
        assert got.totals[g]["n"] == len(mine)
        for v in set(mine):
            below = sum(1 for x in mine if x is None or (v is not None and x <= v))
            assert rows[(g, v)] == below


@pytest.mark.parametrize("rows_per_range,fan", LEVELS)
def test_row_index(df, rows_per_range, fan):
    got = O.row_index(df.select((F.col("id") * 3 - 5).alias("id")), "id", rows_per_range=rows_per_range, fan=fan)
    assert sorted((r.id, r.row_index) for r in got.collect()) == [(i * 3 - 5, i) for i in range(N)]


def test_levels_of_ranges_stay_even_and_in_order(df):
    far = df.select((F.pow(F.col("u"), 9) * 1e9).alias("v")).unionByName(df.select(F.lit(None).cast("double").alias("v")).limit(3))
    got = O.with_ranges(far, "v", 200, 8).groupBy("range_no").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    ranges = sorted(got.collect(), key=lambda r: r.range_no)
    assert (ranges[0].range_no, ranges[0].n) == (-1, 3)
    assert all(a.high < b.low for a, b in zip(ranges[1:], ranges[2:]))
    assert len(ranges) > 150 and max(r.n for r in ranges) < 10 * N / 200


def test_starts_of_ranges_add_up_block_by_block(spark):
    rows = [(g, r, r * r % 7 + 1) for g in ("a", "b", None) for r in range(-1, 600) if r % 11]
    starts = O.range_starts(spark.createDataFrame(rows, "g string, range_no long, n long"), ["n"], ["g"], 5)
    want = {(g, r): sum(n for h, q, n in rows if h == g and q < r) for g, r, _ in rows}
    assert {(r.g, r.range_no): r._before_n for r in starts.collect()} == want


def test_text_index_is_byte_order(spark):
    texts = ["", "a", "b\u00e9", "b", "B", "\uffee", "\U0001f600"] + [f"same-long-start-{i:05d}" for i in range(2000)]
    df = spark.createDataFrame([(t,) for t in [*texts, *texts[:50], None]], "t string")
    got = {r.t: r.position for r in O.text_index(df, "t", rows_per_range=30, fan=4).collect()}
    assert got == {t: i for i, t in enumerate(sorted(set(texts), key=str.encode))}
    assert O.text_index(df.limit(0), "t").count() == 0


def test_split_and_folds(df):
    train = O.temporal_split(df, "id").where("split = 'train'")
    assert (train.count(), train.agg(F.max("id")).first()[0]) == (int(N * 0.8), int(N * 0.8) - 1)
    size = N // 6
    folds = {r.fold: (r.n, r.low) for r in O.time_folds(df, "id").groupBy("fold").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()}
    assert folds == {0: (N - 5 * size, 0), **{i: (size, N - (6 - i) * size) for i in range(1, 6)}}


def test_deep_pages_with_one_shared_time(spark):
    rows = [(i, 1000 if i % 3 else i) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, s long").select("id", F.timestamp_seconds("s").alias("ts"))
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for offset in (0, 13, 599, 600, 601, 890, 899, 900, 5000):
        wanted = [r[0] for r in order[offset : offset + 20]]
        assert [r.id for r in O.seek_page(df, "ts", "id", 20, offset).collect()] == wanted
        assert [r.id for r in O.seek_page(df, "ts", "id", 20, offset, skipped=3).collect()] == wanted
    with pytest.raises(ValueError):
        O.seek_page(df, "ts", "id", 1001, 0)
    with pytest.raises(ValueError):
        O.seek_page(df, "ts", "id", 10, -1)


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 10, 20)] + [(None,), (float("nan"),)], "x double")
    assert O.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0])["x"] == [1.0, 1.75, 6.0, 20.0]
    assert math.isclose(O.exact_quantiles(df, ["x"], [0.9])["x"][0], 17.0)


def test_scratch_goes_with_its_block(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "shared_dir", lambda _: str(tmp_path))

    def listed():
        return sorted(f.name.split("-")[0] for f in (tmp_path / "creditloom").iterdir() if not f.name.startswith("."))

    with R.scratch_scope(spark):
        with R.scratch_scope(spark):
            inner = R.materialise(spark.range(5), "inner")
            told = R.materialise(inner.selectExpr("id * 2 AS id"), "told", keep=True)
        assert listed() == ["told"] and told.count() == 5
    assert listed() == []
    with pytest.raises(RuntimeError), R.scratch_scope(spark):
        R.materialise(spark.range(5), "failed")
        raise RuntimeError
    assert listed() == []
    R.materialise(spark.range(5), "outside")
    assert listed() == ["outside"]


def test_rows_and_levels_are_worked_out_once(spark):
    """Passes over the rows read stored copies: the input once, and each level of ranges from the level before."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(3000).mapInPandas(counted, "id long")
    got = O.row_index(rows, "id", rows_per_range=10, fan=8)
    assert [r.row_index for r in got.orderBy("id").collect()] == list(range(3000))
    assert seen.value == 3000
    assert "BroadcastHashJoin" not in O.with_ranges(spark.range(3000), "id", 100, 8)._jdf.queryExecution().executedPlan().toString()
