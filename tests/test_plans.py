"""Whole jobs on small CSV folders, and the shape of the physical plans."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from creditloom.functions.registry import feature_names
from creditloom.operators import features, quality
from creditloom.plans import catalog, feature_build, lifecycle
from creditloom.plans.catalog import ORACLES, QUERIES
from creditloom.plans.roles import role
from creditloom.sources.readers import list_csv, read_audit, read_csv, read_drift_reports
from creditloom.sources.schemas import RAW_TABLES, raw_schema

HEAVY = {"gbt_train_score", "gbt_early_stopping", "tree_attribution_topk", "logreg_cv", "random_search"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLES))
def test_query_matches_sql(spark, small_sf, name):
    assert differences(QUERIES[name](spark, small_sf), duck(small_sf), ORACLES[name]) == ""


def test_every_query_is_checked_or_heavy():
    assert set(QUERIES) - set(ORACLES) == HEAVY


def test_a_hot_key_changes_nothing(spark):
    """A third of all statements belong to one applicant; results equal a plain walk over the rows."""
    random.seed(4)
    rows = [(0 if i % 3 == 0 else random.randrange(1, 40), i, -random.randrange(30), random.choice([None, float(i)])) for i in range(6000)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE int, x double").repartition(9)
    pos = df.select("SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE", F.col("x").alias("CNT_INSTALMENT_FUTURE"),
                    F.lit(2.0).alias("CNT_INSTALMENT"), F.lit(1).alias("SK_DPD"), F.lit(0).alias("SK_DPD_DEF"))
    got = {r.SK_ID_CURR: (r.pos_month_tracked, r.pos_current_remaining_installments) for r in features.pos_features(pos).collect()}
    wanted = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        wanted[key] = (len(mine), max(mine, key=lambda r: (r[2], r[1]))[3])
    assert got == wanted


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


HISTORIES = {
    "bureau_balance": features.loan_month_features,
    "installments": features.installment_features,
    "credit_card": features.credit_card_features,
    "pos": features.pos_features,
    "previous": features.previous_application_features,
}


@pytest.mark.parametrize("name", HISTORIES)
def test_histories_use_hash_aggregates_with_partials(spark, small_sf, name):
    p = plan(HISTORIES[name](role(spark, small_sf, name)))
    assert "SortAggregate" not in p and "partial_count" in p and "SinglePartition" not in p


def test_scans_read_only_needed_columns(spark, small_sf):
    p = plan(features.loan_month_features(role(spark, small_sf, "bureau_balance")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p


@pytest.mark.parametrize("name", ["temporal_split", "time_series_folds", "row_index", "roc_curve", "master_table", "reweigh"])
def test_no_whole_table_in_one_task(spark, small_sf, name):
    p = plan(QUERIES[name](spark, small_sf))
    assert "SinglePartition" not in p and "CartesianProduct" not in p and "NestedLoop" not in p


def test_star_join_moves_only_the_applications(spark, small_sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = [f(role(spark, small_sf, n)) for n, f in HISTORIES.items() if n != "bureau_balance"]
        p = plan(features.star_join(role(spark, small_sf, "application"), *sides))
        # one exchange per history aggregate, one for the applications, two for the lineitem-orders join
        assert p.count("Exchange hashpartitioning") == len(sides) + 1 + 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---------------------------------------------------------------- CSV to production


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    random.seed(11)
    folder = tmp_path_factory.mktemp("raw")

    def write(name, names, rows):
        lines = [",".join(names)] + [",".join("" if v is None else str(v) for v in r) for r in rows]
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")

    app = raw_schema("application_train")
    def applicant(i, label):
        out = []
        for f in app.fields:
            if f.name == "SK_ID_CURR":
                out.append(i)
            elif f.name == "TARGET":
                out.append(label)
            elif f.name.startswith("FLAG_OWN"):
                out.append(random.choice("YN"))
            elif f.dataType.typeName() == "string":
                out.append(random.choice(["a", "b", None]))
            elif f.name == "DAYS_BIRTH":
                out.append(-random.randint(7500, 24000))
            elif f.name == "EXT_SOURCE_2":
                out.append(round(random.random() - 0.4 * label, 4))
            else:
                out.append(None if random.random() < 0.2 else round(random.random(), 4))
        return out

    n = 300
    write("application_train", app.names, [applicant(i, int(random.random() < 0.25)) for i in range(n)])
    test = [applicant(i, 0) for i in range(n, n + 60)]
    t = app.names.index("TARGET")
    write("application_test", [c for c in app.names if c != "TARGET"], [r[:t] + r[t + 1 :] for r in test])
    for table in RAW_TABLES:
        schema = raw_schema(table)
        rows = []
        for i in range(500):
            row = []
            for f in schema.fields:
                if f.name == "SK_ID_CURR":
                    row.append(random.randrange(n + 30))
                elif f.name.startswith("SK_ID"):
                    row.append(i if table != "bureau_balance" else i % 200)
                elif f.name == "STATUS":
                    row.append(random.choice(["C", "X", "0", "3"]))
                elif f.name == "NAME_CONTRACT_STATUS":
                    row.append(random.choice(["Approved", "Refused", "Canceled", "Unused offer"]))
                elif f.dataType.typeName() == "string":
                    row.append(random.choice(["Active", "Closed"]))
                elif f.dataType.typeName() == "long":
                    row.append(-random.randrange(40))
                else:
                    row.append(round(random.random() * 100, 2))
            rows.append(row)
        # columns in another order than the schema: types are matched by name
        names = schema.names[::-1]
        write(table, names, [r[::-1] for r in rows])
    (folder / "sample_submission.csv").write_text("a\n1\n")
    (folder / "any_columns_description.csv").write_bytes(b"Table,Row\nx,caf\xe9\n")
    return str(folder)


def test_csv_reading(spark, raw):
    assert len(list_csv(spark, raw)) == 8
    lossy = read_csv(spark, f"{raw}/any_columns_description.csv")
    assert lossy.first().Row == "caf�"
    assert {r.file: r.cols for r in feature_build.inventory(spark, raw).collect()}["bureau_balance.csv"] == 3
    report = feature_build.profile_raw_tables(spark, raw, raw + "_report")
    assert report.where("table = 'bureau.csv'").count() == 17
    with pytest.raises(FileNotFoundError):
        feature_build.read_raw_table(spark, raw, "bureau_none")


def test_from_csv_to_production(spark, raw, tmp_path):
    out, registry, audit, reports = (str(tmp_path / p) for p in ("features", "registry", "audit", "reports"))
    feature_build.build_features(spark, raw, out)
    train_path, test_path = (feature_build.feature_path(out, n) for n in ("train_complete", "test_complete"))
    train, test = spark.read.parquet(train_path), spark.read.parquet(test_path)
    assert train.where("TARGET IS NULL").count() == 0 and test.where("TARGET IS NOT NULL").count() == 0
    assert (train.count(), test.count()) == (300, 60)
    dropped = set(feature_names()) - set(train.columns)
    assert all(n.split("_")[0] in ("COMMONAREA", "NONLIVINGAPARTMENTS", "NONLIVINGAREA", "FONDKAPREMONT", "LIVINGAPARTMENTS") for n in dropped)
    assert quality.residual_nulls(train).first().null_cells == 0
    loans = spark.read.option("header", True).csv(f"{raw}/bureau.csv").groupBy("SK_ID_CURR").count().collect()
    wanted = {int(r.SK_ID_CURR): r["count"] for r in loans if int(r.SK_ID_CURR) < 300}
    assert {r.SK_ID_CURR: r.bureau_loan_count for r in train.where("HAS_BUREAU_RECORD = 1").collect()} == wanted
    if not dropped:
        quality.validate_registry(train)

    numeric = ["EXT_SOURCE_1", "EXT_SOURCE_2", "AMT_CREDIT", "bureau_loan_count", "prev_rejection_rate", "NOT_THERE"]
    table = train.withColumn("NOT_THERE", F.lit(0.0))
    settings = {"maxIter": 4, "minInstancesPerNode": 2}
    now = datetime(2024, 5, 1)
    profile = feature_build.stored_imputer(spark, out)
    assert set(profile.scores) == {"EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"}
    first = lifecycle.train(table, registry, numeric, ["CODE_GENDER"], settings, now=now)
    with pytest.raises(ValueError, match="without its imputer"):
        lifecycle.Explainer(*lifecycle.load_run(spark, registry, first)).imputer  # noqa: B018
    assert lifecycle.promote(spark, registry, first)["reason"] == "no evaluation metrics"
    metrics = lifecycle.evaluate(train, registry, first).first()
    assert metrics.auc_roc > 0.6
    lifecycle.promote(spark, registry, first, force=True, now=now)
    fair = lifecycle.train(table, registry, numeric, ["CODE_GENDER"], settings, fair=True, now=now, imputer=profile)
    assert lifecycle.Explainer(*lifecycle.load_run(spark, registry, fair)).imputer == profile
    lifecycle.evaluate(train, registry, fair[:8])
    assert lifecycle.promote(spark, registry, fair, force=True, now=datetime(2024, 5, 2))["decision"] == "promote"
    run, _ = lifecycle.load_run(spark, registry)
    assert run["run_id"] == fair and set(run["group_thresholds"]) <= {"young_lt35", "middle_35_55", "senior_gt55"}

    tables = [train_path, f"{out}/absent", test_path]
    lifecycle.score_everyone(spark, tables, registry, audit, datetime(2024, 5, 3))
    lifecycle.score_everyone(spark, tables, registry, audit, datetime(2024, 5, 4))
    scores = read_audit(spark, audit)
    assert scores.count() == 360 and scores.select("model_version").distinct().first()[0] == fair[:8]
    reasons = json.loads(scores.where("application_id = 7").first().top_shap_features)
    assert {c["feature_name"] for c in reasons} == {*numeric, "CODE_GENDER"} and all(set(c) == {"feature_name", "shap_value", "feature_value", "description"} for c in reasons)
    assert [abs(c["shap_value"]) for c in reasons] == sorted((abs(c["shap_value"]) for c in reasons), reverse=True)

    report = lifecycle.watch_drift(spark, train_path, audit, registry, reports, datetime(2024, 5, 5))
    assert report.count() == 7 and read_drift_reports(spark, reports).count() == 7
    names = {r.metric for r in lifecycle.read_metrics(spark, registry).collect()}
    assert {"auc_roc", "disparate_impact_ratio", "drift_max_psi"} <= names
    late = lifecycle.watch_drift(spark, train_path, audit, registry, reports, datetime(2024, 9, 1))
    assert late is None


def test_time_folds_train_on_the_past(spark, small_sf):
    scores = QUERIES["logreg_cv"](spark, small_sf).collect()
    assert [r.fold for r in scores] == ["1", "2", "3", "4", "5", "mean", "std"]
    assert all(r.auc is None or 0 <= r.auc <= 1 for r in scores)


@pytest.mark.parametrize("name", ["gbt_train_score", "random_search"])
def test_models_run(spark, small_sf, name):
    assert QUERIES[name](spark, small_sf).count() > 0
    assert catalog.AS_OF.year == 2024
