import math
import random

import pytest
from pyspark.sql import functions as F

from creditloom.functions.scalars import age_bucket, psi_status, risk_tier, within_period
from creditloom.operators import evaluation as E

random.seed(3)
ROWS = [(i, int(random.random() < 0.2), round(random.random(), 2) if i % 3 else 0.5, -random.randint(6000, 30000)) for i in range(1500)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id long, y int, score double, days_birth int").cache()


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_range,fan", [(1_000_000, 256), (20, 256), (20, 4)])
def test_rank_metrics(df, rows_per_range, fan):
    r = E.rank_metrics(df, rows_per_range=rows_per_range, fan=fan).first()
    pairs = [(y, s) for _, y, s, _ in ROWS]
    assert r.auc_roc == pytest.approx(brute_auc(pairs))
    assert r.gini == pytest.approx(2 * r.auc_roc - 1)
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    ks = max(abs(sum(p <= t for p in pos) / len(pos) - sum(n <= t for n in neg) / len(neg)) for t in set(pos + neg))
    assert r.ks_stat == pytest.approx(ks)
    flipped = E.rank_metrics(df.withColumn("score", -F.col("score"))).first()
    assert flipped.auc_roc == pytest.approx(1 - r.auc_roc)


def test_one_class_only(spark):
    r = E.rank_metrics(spark.createDataFrame([(1, 0.5)], "y int, score double")).first()
    assert (r.auc_roc, r.gini) == (None, None)


def test_youden(df, spark):
    pos = sum(y for _, y, _, _ in ROWS)
    neg = len(ROWS) - pos
    best = max(
        (sum(y for _, y, s, _ in ROWS if s >= t) / pos - sum(1 - y for _, y, s, _ in ROWS if s >= t) / neg, t)
        for t in {s for _, _, s, _ in ROWS}
    )
    r = E.youden(df).first()
    assert (r.j, r.threshold) == (pytest.approx(best[0]), best[1])
    assert r.selection_rate == pytest.approx(sum(s >= best[1] for _, _, s, _ in ROWS) / len(ROWS))
    useless = E.youden(spark.createDataFrame([(1, 0.1), (0, 0.9)], "y int, score double")).first()
    assert useless.threshold == math.inf and useless.selection_rate == 0.0


def test_reweighing_balances(df):
    weighted = E.reweigh(df)
    assert weighted.count() == len(ROWS)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(len(ROWS))
    rates = weighted.groupBy(E.mature_group(F.col("days_birth"))).agg((F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).alias("r")).collect()
    assert rates[0].r == pytest.approx(rates[1].r)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 50])
def test_group_thresholds(df, rows_per_range):
    got = {r.bucket: r.threshold for r in E.group_thresholds(df, 0.1, rows_per_range=rows_per_range).collect()}
    groups = {}
    for _, _, s, d in ROWS:
        a = -d / 365.25
        g = "young_lt35" if 0 < a <= 35 else "middle_35_55" if a <= 55 else "senior_gt55"
        groups.setdefault(g, []).append(s)
    for g, scores in groups.items():
        k = min(max(1, round(0.1 * len(scores))), len(scores))
        assert got[g] == sorted(scores, reverse=True)[k - 1]


def test_thresholds_outside_groups(spark):
    df = spark.createDataFrame([(1, 0.9, 1000), (2, 0.9, -8000), (3, 0.55, -15000)], "id int, score double, days_birth int")
    table = spark.createDataFrame([("young_lt35", 0.95)], "bucket string, threshold double")
    got = {r.id: r.y_pred for r in E.apply_group_thresholds(df, table, age_bucket(F.col("days_birth"))).collect()}
    assert got == {1: 0, 2: 0, 3: 1}  # no group; below its own cut; group without a cut uses 0.5


def test_edges_of_bins(spark):
    df = spark.createDataFrame([(35.0,), (35.001,), (55.0,), (150.0,), (151.0,), (0.0,)], "age double")
    got = [r.b for r in df.select(age_bucket(-F.col("age") * 365.25).alias("b")).collect()]
    assert got == ["young_lt35", "middle_35_55", "middle_35_55", "senior_gt55", None, None]
    tiers = spark.createDataFrame([(0.2999,), (0.3,), (0.6,), (0.6001,), (float("nan"),), (None,)], "p double")
    assert [r.t for r in tiers.select(risk_tier(F.col("p")).alias("t")).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", None, None]
    psi = spark.createDataFrame([(0.0999,), (0.1,), (0.2,), (0.21,)], "p double")
    assert [r.t for r in psi.select(psi_status(F.col("p")).alias("t")).collect()] == ["Stable", "Warning", "Warning", "Alert"]
    with pytest.raises(ValueError):
        within_period(F.col("p"), "2y", F.current_timestamp())


def test_comparison_verdict(spark):
    a = spark.createDataFrame([(0.7, 0.9)], "auc_roc double, disparate_impact_ratio double")
    b = spark.createDataFrame([(0.75, None)], "auc_roc double, disparate_impact_ratio double")
    got = {r.metric: (r.delta, r.verdict) for r in E.compare_models(a, b).collect()}
    assert got["auc_roc"] == (pytest.approx(0.05), None) and got["disparate_impact_ratio"] == (None, "NOT PROMOTABLE")
