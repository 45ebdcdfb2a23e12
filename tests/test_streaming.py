import json
import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from creditloom.operators.impute import ImputeProfile
from creditloom.operators.quality import conforming_requests
from creditloom.plans import catalog
from creditloom.sources.readers import read_audit, records_to_table
from creditloom.sources.schemas import raw_schema, request_schema
from creditloom.streaming import online
from creditloom.streaming.answer_cache import answered_places, rows_to_answer


def walked(rows, valid=3600):
    """Ids that need an answer, by a walk over the rows in order of time."""
    last, wanted = {}, set()
    for i, k, t in sorted(rows, key=lambda r: (r[2], r[0])):
        s = int(t.timestamp())
        if k not in last or s >= last[k] + valid:
            last[k] = s
            wanted.add(i)
    return wanted


def stream_of(spark, folder, parts, schema):
    """A stream that meets the parts one by one."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return online.read_table_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)


def test_answers_of_a_stream_match_a_walk(spark, tmp_path):
    """Three batches, a third of all rows under one key, rows of a batch in any order, an answer that holds over the border of batches."""
    random.seed(2)
    start = datetime(2024, 1, 1)
    rows = [(i, "hot" if i % 3 else f"k{i % 7}", start + timedelta(seconds=random.randint(0, 90000), milliseconds=random.randint(0, 999))) for i in range(3000)]
    cuts = [start, start + timedelta(seconds=28000), start + timedelta(seconds=61000), start + timedelta(days=9)]
    parts = [[r for r in rows if a <= r[2] < b] for a, b in zip(cuts, cuts[1:])]
    stream = stream_of(spark, str(tmp_path / "in"), parts, "id long, key string, ts timestamp")
    got = [r.id for r in online.drain(rows_to_answer(stream, "key", "ts", "id", 3600)).collect()]
    assert len(got) == len(set(got)) and set(got) == walked(rows)


def test_late_null_and_expired_rows(spark, tmp_path):
    start = datetime(2024, 1, 1)
    at = lambda hours: start + timedelta(hours=hours)
    parts = [
        [(1, "a", at(0)), (2, "b", at(30)), (3, None, at(1)), (4, "c", None)],
        [(5, "a", at(30.5)), (6, "b", at(30.5)), (7, "a", at(60))],
        [(8, "z", at(2)), (9, "b", at(60.5)), (10, "a", at(60.9))],  # 8 comes a day behind the watermark
    ]
    stream = stream_of(spark, str(tmp_path / "in"), parts, "id long, key string, ts timestamp")
    got = {r.id for r in online.drain(rows_to_answer(stream, "key", "ts", "id", 3600)).collect()}
    assert got == {1, 2, 5, 7, 9}


def test_places_to_answer():
    seconds = np.array([0, 5, 10, 11, 25])
    assert answered_places(seconds, None, 10) == [0, 2, 4] and answered_places(seconds, 0, 10) == [2, 4]
    assert answered_places(seconds, 24, 10) == [] and answered_places(seconds[:0], None, 10) == []


def request(i, **extra):
    return {
        "application": {"SK_ID_CURR": i, "EXT_SOURCE_1": None, "AMT_INCOME_TOTAL": 10.0 * i, "FLAG_OWN_CAR": None, "UNKNOWN": 1},
        "bureau": [{"SK_ID_BUREAU": 5, "CREDIT_ACTIVE": "Active", "AMT_CREDIT_SUM": 100.0, "AMT_CREDIT_SUM_DEBT": 50.0}],
        "bureau_balance": [{"SK_ID_BUREAU": 5, "MONTHS_BALANCE": -1, "STATUS": "3"}],
        "pos_cash": [], **extra,
    }


def test_request_documents(spark):
    texts = [json.dumps(request(1)), "{broken", json.dumps({"application": {"AMT_CREDIT": 1}}), json.dumps({"application": {"SK_ID_CURR": 2}})]
    good, bad = conforming_requests(spark.createDataFrame([(t,) for t in texts], "text string"), "text", request_schema(), "application.SK_ID_CURR")
    assert sorted(r.request.application.SK_ID_CURR for r in good.collect()) == [1, 2] and bad.count() == 2
    children = records_to_table(good, "bureau", raw_schema("bureau"))
    assert [(r.SK_ID_CURR, r.SK_ID_BUREAU) for r in children.collect()] == [(1, 5)]
    assert records_to_table(good, "pos_cash", raw_schema("POS_CASH_balance")).schema == raw_schema("POS_CASH_balance")


def test_scoring_stream_end_to_end(spark, tmp_path):
    inbox, audit = tmp_path / "in", str(tmp_path / "audit")
    inbox.mkdir()
    lines = [json.dumps(request(1)), json.dumps(request(1)), json.dumps(request(1, pos_cash=[{"SK_ID_PREV": 1, "CNT_INSTALMENT": 4.0}])), json.dumps(request(2)), "{broken"]
    (inbox / "a.json").write_text("\n".join(lines) + "\n")
    profile = ImputeProfile(scores={"EXT_SOURCE_1": 0.4}, numbers={"AMT_INCOME_TOTAL": 7.0})

    def score(df):
        # uses features of the application, of a child list, and of a grandchild list
        return df.withColumn("score", (F.col("EXT_SOURCE_1") + F.col("debt_to_credit_ratio") + F.col("bureau_global_worst_status")) / 10)

    stream = online.fresh_requests(online.read_request_stream(spark, str(inbox)))
    checkpoint = str(tmp_path / "cp")
    handle = lambda b, i: online.answer_batch(b, i, audit, online.RequestFeatures(profile), score, "run1234567")
    online.run_to_end(stream, handle, checkpoint)
    rows = read_audit(spark, audit).collect()
    assert sorted(r.application_id for r in rows) == [1, 1, 2]  # the repeat is answered from the cache
    assert all(abs(r.default_probability - 0.39) < 1e-6 and r.risk_tier == "MEDIUM" and r.model_version == "run12345" for r in rows)
    # the same document again within the hour, after a restart: not logged a second time
    (inbox / "b.json").write_text(json.dumps(request(2)) + "\n" + json.dumps(request(3)) + "\n")
    online.run_to_end(stream, handle, checkpoint)
    assert sorted(r.application_id for r in read_audit(spark, audit).collect()) == [1, 1, 2, 3]


def test_features_of_a_request_need_no_shuffle(spark):
    batch = spark.createDataFrame([(json.dumps(request(1)), datetime(2024, 1, 1)), (json.dumps({"application": {"SK_ID_CURR": 2}}), None)], "text string, received_at timestamp")
    profile = ImputeProfile(scores={"EXT_SOURCE_1": 0.4}, numbers={"AMT_INCOME_TOTAL": 7.0})
    good, _ = conforming_requests(batch, "text", request_schema(), "application.SK_ID_CURR")
    features = online.RequestFeatures(profile)(good)
    assert "Exchange" not in features._jdf.queryExecution().executedPlan().toString()
    one, two = sorted(features.collect(), key=lambda r: r.SK_ID_CURR)
    assert (one.bureau_loan_count, one.bureau_global_worst_status, one.bureau_active_debt, one.HAS_BUREAU_RECORD) == (1, 3, 50.0, 1)
    assert (two.bureau_loan_count, two.bureau_avg_credit, two.HAS_BUREAU_RECORD, two.prev_rejection_rate, two.EXT_SOURCE_1) == (0, -1.0, 0, -1.0, 0.4)


def test_replayed_batch_keeps_its_rows(spark, tmp_path):
    audit = str(tmp_path / "audit")
    text = [json.dumps(request(1)), json.dumps(request(1, pos_cash=[{"SK_ID_PREV": 1, "CNT_INSTALMENT": 4.0}])), json.dumps(request(2))]
    batch = spark.createDataFrame([(t,) for t in text], "text string").withColumn("received_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    profile = ImputeProfile(scores={"EXT_SOURCE_1": 0.4}, numbers={"AMT_INCOME_TOTAL": 7.0})
    for _ in range(3):
        online.answer_batch(batch, 0, audit, online.RequestFeatures(profile), lambda df: df.withColumn("score", F.lit(0.5)), "run1234567")
        rows = read_audit(spark, audit).collect()
        assert sorted(r.application_id for r in rows) == [1, 1, 2] and len({r.id for r in rows}) == 3


def test_closed_days_only(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=h), h / 100) for h in range(60)]
    schema = "predicted_at timestamp, default_probability double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "s"))
    stream = online.read_table_stream(spark, str(tmp_path / "s"), spark.createDataFrame([], schema).schema)
    got = {str(r.date): r.n for r in online.drain(online.daily_means(stream)).collect()}
    assert got == {"2024-01-01": 24, "2024-01-02": 24}


def test_state_is_one_table_a_bucket(spark, tmp_path):
    """Many keys share the state of few buckets, and every key is still answered on its own."""
    start = datetime(2024, 1, 1)
    random.seed(4)
    rows = [(i, f"k{random.randint(0, 400)}", start + timedelta(seconds=random.randint(0, 20000))) for i in range(2500)]
    cuts = [start, start + timedelta(seconds=7000), start + timedelta(seconds=13000), start + timedelta(days=1)]
    parts = [[r for r in rows if a <= r[2] < b] for a, b in zip(cuts, cuts[1:])]
    stream = stream_of(spark, str(tmp_path / "in"), parts, "id long, key string, ts timestamp")
    out = str(tmp_path / "out")
    query = online.run_to_end(rows_to_answer(stream, "key", "ts", "id", 3600, buckets=6), lambda b, _: b.write.mode("append").parquet(out))
    got = [r.id for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) == walked(rows)
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) == 6


def test_many_files_make_the_same_batches(spark, tmp_path, monkeypatch):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=i), i % 7, "view", 1.0, None) for i in range(900)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(catalog, "EVENTS_PER_FILE", 20)
    seen = {}

    def handle(batch, number):
        if found := [r.event_id for r in batch.collect()]:
            seen[number] = sorted(found), batch.rdd.getNumPartitions()

    stream = catalog.arriving_events(spark, str(tmp_path))
    online.run_to_end(stream, handle)
    assert [ids for ids, _ in seen.values()] == [[*range(300)], [*range(300, 600)], [*range(600, 900)]]
