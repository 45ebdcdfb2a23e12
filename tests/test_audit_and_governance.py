from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from creditloom.operators import drift, governance, portfolio
from creditloom.sources import readers, writers


def rows(spark, ids, p=0.5, at=datetime(2024, 1, 2), source="batch_ingest"):
    df = spark.createDataFrame([(i, p) for i in ids], "k long, p double")
    return writers.audit_rows(df, "k", F.col("p"), F.lit("0123456789"), F.lit(at), source)


def test_replacing_a_source_leaves_others(spark, tmp_path):
    path = str(tmp_path / "audit")
    writers.append_audit(rows(spark, [1, 2], source="api"), path, "api", "stream-0")
    writers.replace_source(rows(spark, [1, 2, 3], at=datetime(2024, 1, 1)), path)
    writers.replace_source(rows(spark, [4], 0.7), path)
    # a retried load writes the same folder again
    writers.append_audit(rows(spark, [1, 2], source="api"), path, "api", "stream-0")
    got = sorted((r.source, r.application_id, r.risk_tier) for r in readers.read_audit(spark, path).collect())
    assert got == [("api", 1, "MEDIUM"), ("api", 2, "MEDIUM"), ("batch_ingest", 4, "HIGH")]
    assert readers.read_audit(spark, path, F.lit(datetime(2024, 1, 3))).count() == 0


def test_a_failed_replacement_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "audit")
    writers.replace_source(rows(spark, [1, 2]), path)
    with pytest.raises(Exception, match="NaN"):
        writers.replace_source(rows(spark, [3], float("nan")), path)
    assert sorted(r.application_id for r in readers.read_audit(spark, path).collect()) == [1, 2]


def test_nan_scores_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="NaN"):
        rows(spark, [1], float("nan")).collect()


def test_gate_and_stages(spark, tmp_path):
    runs = spark.createDataFrame(
        [("a1", "staging", None), ("b2", "production", datetime(2023, 1, 1)), ("c3", "staging", None), ("d4", "archived", None), ("e5", "staging", None)],
        "run_id string, stage string, promoted_at timestamp",
    ).withColumn("created_at", F.lit(datetime(2023, 1, 1)))
    metrics = spark.createDataFrame(
        [("a1", "auc_roc", 0.8), ("a1", "disparate_impact_ratio", 0.9), ("c3", "auc_roc", 0.8),
         ("c3", "disparate_impact_ratio", float("nan")), ("d4", "auc_roc", 0.7), ("d4", "disparate_impact_ratio", 0.85)],
        "run_id string, metric string, value double",
    )
    gate = {r.run_id: (r.decision, r.reason) for r in governance.promotion_gate(runs, metrics).collect()}
    assert gate["a1"] == ("promote", "all gates passed") and gate["b2"][0] == "none"
    assert gate["c3"] == ("block", "disparate impact below 0.80") and gate["e5"] == ("block", "no evaluation metrics")
    assert gate["d4"] == ("promote", "stage was not staging")
    floor = {r.run_id: r.decision for r in governance.promotion_gate(runs, metrics, auc_floor=0.74).collect()}
    assert floor["d4"] == "block"
    forced = {r.run_id: r.decision for r in governance.promotion_gate(runs, metrics, True).collect()}
    assert forced["c3"] == forced["e5"] == "promote" and forced["b2"] == "none"
    path = str(tmp_path / "runs")
    governance.write_runs(runs, path)
    governance.write_runs(governance.change_stage(runs, "a1", F.lit(datetime(2024, 1, 1))), path)
    now = governance.read_runs(spark, path)
    assert {r.run_id: r.stage for r in now.collect()} == {"a1": "production", "b2": "archived", "c3": "staging", "d4": "archived", "e5": "staging"}
    assert governance.production_run(now).first().run_id == "a1"
    assert governance.find_run(now, "c3").count() == 1
    with pytest.raises(FileNotFoundError):
        governance.find_run(now, "zz")


def test_drift_of_a_table_with_itself_is_zero(spark):
    df = spark.range(500).selectExpr("cast(id % 97 as double) AS x", "cast(id as double) AS y")
    got = {r.feature: r for r in drift.drift_report(df, df, ["x", "y"], date(2024, 1, 1)).collect()}
    assert all(abs(r.psi) < 1e-12 and r.ks == 0 and not r.drifted and r.status == "Stable" for r in got.values())
    moved = drift.drift_report(df, df.selectExpr("x + 1000 AS x", "y"), ["x", "y"], date(2024, 1, 1))
    assert {r.feature: r.status for r in moved.collect()} == {"x": "Alert", "y": "Stable"}
    assert moved.where("feature = 'x'").first().ks == 1.0
    assert drift.drift_report(df, df.limit(9), ["x"], date(2024, 1, 1)) is None


def test_corrupt_reports_are_skipped(spark, tmp_path):
    path = str(tmp_path / "reports")
    report = drift.drift_report(
        spark.range(50).selectExpr("cast(id as double) AS x"), spark.range(50).selectExpr("cast(id * 2 as double) AS x"), ["x"], date(2024, 1, 1)
    )
    writers.write_drift_report(report, path)
    writers.write_drift_report(report.withColumn("report_date", F.lit(date(2024, 1, 8))), path)
    (tmp_path / "reports" / "report_date=2024-01-08" / "part-broken.json").write_text("{not json\n")
    reports = readers.read_drift_reports(spark, path)
    assert reports.count() == 2
    assert readers.latest_report(reports).first().report_date == date(2024, 1, 8)
    assert [r.change for r in drift.trend(reports).orderBy("report_date").collect()] == [None, 0.0]


def test_lookup_order_and_missing(spark):
    a = spark.createDataFrame([(1, float("nan"))], "SK_ID_CURR long, x double")
    b = spark.createDataFrame([(1, 5.0), (2, 6.0)], "SK_ID_CURR long, x double")
    assert portfolio.lookup_applicant(1, [a, b]).first().x is None
    assert portfolio.lookup_applicant(2, [a, b]).first().x == 6.0
    with pytest.raises(KeyError):
        portfolio.lookup_applicant(3, [a, b])


def test_empty_period(spark):
    scores = spark.createDataFrame([], "risk_tier string, default_probability double, predicted_at timestamp")
    r = portfolio.portfolio_summary(scores, "6m", datetime(2024, 1, 1)).first()
    assert (r.total_predictions, r.tier_breakdown, r.high_risk_count, r.avg_default_probability) == (0, [], 0, 0.0)


def test_an_applicant_scored_again_and_again(spark):
    """One applicant holds a third of the scores: it is one row of the join, and the report equals that of a row per score."""
    master = spark.range(400).selectExpr("id AS SK_ID_CURR", "cast(id % 89 as double) AS x", "CASE WHEN id % 3 > 0 THEN cast(id as double) END AS y")
    recent = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id * id % 300 END AS application_id")
    weighted = drift.current_features(recent, master, "SK_ID_CURR", ["x", "y"])
    assert weighted.count() == recent.distinct().count() and weighted.agg(F.sum(drift.WEIGHT)).first()[0] == 3000
    rows = recent.join(master, recent.application_id == master.SK_ID_CURR).select("x", "y")
    got, wanted = (sorted(tuple(r) for r in drift.drift_report(master, current, ["x", "y", "gone"], date(2024, 1, 1)).collect()) for current in (weighted, rows))
    assert got == [tuple(pytest.approx(v) if isinstance(v, float) else v for v in r) for r in wanted]
    assert [(r[0], r[1], r[2], r[3], r[4], r[6]) for r in got if r[0] == "gone"] == [("gone", 0.0, None, False, "Stable", 0)]
    assert drift.drift_report(master, weighted.limit(0), ["x"], date(2024, 1, 1)) is None
    assert drift.enough_rows(weighted.where("n_scores > 900")) and not drift.enough_rows(spark.range(9))
