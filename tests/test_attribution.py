import itertools
import json
import math
import random
import time

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditloom.operators import attribution as X
from creditloom.operators import models


@pytest.fixture(scope="module")
def fitted(spark):
    random.seed(5)
    rows = []
    for i in range(400):
        a, b, c = random.random(), random.random(), random.choice("pqr")
        rows.append((i, a, b, c, int(a + (0.5 if c == "q" else 0) + 0.2 * random.random() > 0.8)))
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, y int")
    model = models.train_boosted(df, ["a", "b"], ["c"], "y", {"maxIter": 4, "minInstancesPerNode": 5, "featureSubsetStrategy": "all"})
    return df, model


def passes(step, value):
    return step.low < value <= step.high and all((value in members) == inside for members, inside in step.sets)


def value_of(leaves, x, known):
    """Expected margin when only the features in ``known`` are given."""
    total = 0.0
    for leaf in leaves:
        p = leaf.value
        for f, step in leaf.steps.items():
            p *= float(passes(step, x[f])) if f in known else step.share
        total += p
    return total


def slow_shapley(leaves, x):
    n, out = len(x), []
    for f in range(n):
        others, total = [o for o in range(n) if o != f], 0.0
        for size in range(n):
            w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for s in itertools.combinations(others, size):
                total += w * (value_of(leaves, x, {*s, f}) - value_of(leaves, x, set(s)))
        out.append(total)
    return out


def test_shapley_values_are_exact(spark, fitted):
    df, model = fitted
    leaves = X.tree_leaves(model.stages[-1])
    rows = np.array([[0.1, 0.9, 0.0], [0.7, 0.2, 1.0], [0.95, 0.5, 2.0]])
    for x, phi in zip(rows, X.shapley(rows, X.leaf_blocks(leaves))):
        assert phi == pytest.approx(slow_shapley(leaves, x))
        assert phi.sum() == pytest.approx(value_of(leaves, x, {0, 1, 2}) - X.base_margin(leaves))


def random_leaves(rng, features, depth, count):
    """Paths with intervals, category sets, and shares of 0 and 1."""
    out = []
    for _ in range(count):
        steps = {}
        for f in rng.sample(range(features), rng.randint(0, depth)):
            share = rng.choice([0.0, 1.0, rng.random(), rng.random()])
            if f % 2:
                sets = tuple((tuple(float(v) for v in rng.sample(range(5), 2)), rng.random() < 0.5) for _ in range(rng.randint(1, 2)))
                steps[f] = X.Step(-np.inf, np.inf, sets, share)
            else:
                low = rng.uniform(-1, 3)
                steps[f] = X.Step(low, rng.choice([low + 2, np.inf]), (), share)
        out.append(X.Leaf(rng.uniform(-2, 2), steps))
    return out


def test_polynomials_against_all_subsets(monkeypatch):
    monkeypatch.setattr(X, "LEAVES_AT_ONCE", 5)
    rng = random.Random(8)
    leaves = random_leaves(rng, 8, 7, 40)
    rows = np.array([[float(rng.randint(0, 4)) for _ in range(8)] for _ in range(6)])
    for x, phi in zip(rows, X.shapley(rows, X.leaf_blocks(leaves))):
        assert phi == pytest.approx(slow_shapley(leaves, x), abs=1e-9)
    assert X.shapley(rows, X.leaf_blocks([X.Leaf(3.0, {})])).sum() == 0.0 and X.base_margin([X.Leaf(3.0, {})]) == 3.0


def test_cost_grows_with_the_square_of_the_depth():
    """30 steps a path would be 2^29 subsets a feature and leaf."""
    rng = random.Random(9)
    steps = {f: X.Step(rng.random(), 2.0, (), 0.5 + rng.random() / 2) for f in range(30)}
    leaves, rows = [X.Leaf(1.0, steps)] * 20, np.random.default_rng(1).random((50, 30)) * 2
    start = time.perf_counter()
    phi = X.shapley(rows, X.leaf_blocks(leaves))
    assert time.perf_counter() - start < 5
    margin = 20 * ((rows > [s.low for s in steps.values()]) & (rows <= 2.0)).all(axis=1)
    assert phi.sum(axis=1) == pytest.approx(margin - X.base_margin(leaves), abs=1e-9)


def test_category_splits_of_a_fitted_model(spark):
    """A nominal column makes Spark split on sets of categories."""
    rng = random.Random(4)
    rows = [(i, float(rng.randrange(6)), rng.random()) for i in range(600)]
    df = spark.createDataFrame([(i, c, v, int((c in (1.0, 4.0)) != (v > 0.7))) for i, c, v in rows], "id long, c double, v double, y int")
    attribute = {"ml_attr": {"type": "nominal", "vals": [str(k) for k in range(6)], "name": "c"}}
    marked = VectorAssembler(inputCols=["c", "v"], outputCol="features").transform(df.withColumn("c", F.col("c").alias("c", metadata=attribute)))
    model = models.gbt({"maxIter": 3, "minInstancesPerNode": 5, "featureSubsetStrategy": "all"}, labelCol="y").fit(marked)
    leaves = X.tree_leaves(model)
    assert any(step.sets for leaf in leaves for step in leaf.steps.values())
    scored = model.transform(marked).withColumn("margin", vector_to_array("rawPrediction")[1])
    for r in X.tree_attribution(scored, leaves, ["c", "v"], ["c", "v", "margin"], 1).collect():
        assert r.base + r.rest + r.top[0].shap_value == pytest.approx(r.margin)
        assert [r.top[0].shap_value, r.rest] == pytest.approx(sorted(slow_shapley(leaves, [r.c, r.v]), key=lambda p: -abs(p)))


def test_attributions_add_up_to_the_score(spark, fitted):
    df, model = fitted
    prepared = models.run_stages(df, model.stages[:-1])
    top = X.tree_attribution(prepared, model.stages[-1], ["a", "b", "c"], ["id"], 3)
    sums = {r.id: r.s for r in top.select("id", F.aggregate("top", F.lit(0.0), lambda s, t: s + t["shap_value"]).alias("s")).collect()}
    base = value_of(X.tree_leaves(model.stages[-1]), [0, 0, 0], set())
    scores = {r.id: r.score for r in models.score_table(df, model, ["id"]).collect()}
    assert len(sums) == 400
    for i, s in sums.items():
        assert 1 / (1 + math.exp(-2 * (base + s))) == pytest.approx(scores[i], abs=1e-9)


def test_attribution_text_holds_descriptions(spark, fitted):
    df, model = fitted
    prepared = models.run_stages(df, model.stages[:-1])
    names = ["AMT_CREDIT", "b", "c"]
    top = X.tree_attribution(prepared, model.stages[-1], names, ["id"], 2)
    for r in top.select("top", X.attribution_text(F.col("top"), names).alias("text")).limit(20).collect():
        cells = json.loads(r.text)
        assert [(c["feature_name"], c["shap_value"], c["feature_value"]) for c in cells] == [(c.feature_name, c.shap_value, c.feature_value) for c in r.top]
        assert all(c["description"] == ("Credit amount of the loan" if c["feature_name"] == "AMT_CREDIT" else "") for c in cells)


def test_linear_top_and_ties(spark):
    df = spark.createDataFrame([(1, 2.0, -2.0, 0.5)], "id int, AMT_CREDIT double, x double, z double")
    top = X.linear_attribution(df, {"AMT_CREDIT": 1.0, "x": 1.0, "z": 1.0}, dict.fromkeys(["AMT_CREDIT", "x", "z"], 0.0), ["id"], 2)
    rows = sorted((r["rank"], r.feature_name, r.shap_value, r.description) for r in X.describe_top(top, ["id"]).collect())
    assert rows == [(1, "AMT_CREDIT", 2.0, "Credit amount of the loan"), (2, "x", -2.0, "")]


def test_unseen_categories_get_minus_one(spark):
    seen = spark.createDataFrame([("b",), ("a",), ("c",)], "c string")
    new = spark.createDataFrame([("a",), ("c",), ("zz",), (None,)], "c string")
    assert [r.c_code for r in models.ordinal_encode(new, ["c"], seen).collect()] == [0.0, 2.0, -1.0, -1.0]


def test_a_category_with_a_million_values(spark):
    """A third of the rows share a value, others are null or unseen; the dictionary is too large to broadcast."""
    n = 1_000_000
    seen = spark.range(n, numPartitions=8).select(F.format_string("shop-%07d", "id").alias("c"))
    value = F.when(F.col("id") % 3 == 0, F.lit("shop-0000007")).when(F.col("id") % 10 == 1, F.lit(None)).when(F.col("id") % 10 == 2, F.lit("zz"))
    new = spark.range(300_000, numPartitions=8).withColumn("c", value.otherwise(F.format_string("shop-%07d", (F.col("id") * 7) % n)))
    want = F.when(F.col("c").startswith("shop-"), F.substring("c", 6, 7).cast("double")).otherwise(-1.0)
    got = models.ordinal_encode(new, ["c"], seen, broadcast_bytes=1 << 20, rows_per_range=200_000)
    row = got.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_if(F.col("c_code") != want).alias("wrong")).first()
    assert (got.columns, row.n, row.ids, row.wrong) == (["id", "c", "c_code"], 300_000, 300_000, 0)


def test_search_over_rungs(spark):
    """All trials see the first fold, half of them the next, and so on; a trial that saw all folds has the mean of its own AUCs."""
    rows = [(i, int((i * 37 % 100) + (i % 5) * 8 > 80), float(i * 37 % 100), "pq"[i % 2]) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, y int, a double, c string")
    fixed = {"maxIter": 3, "maxDepth": 2, "minInfoGain": 0.0, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "seed": 1}
    found = models.random_search(
        df, ["a"], ["c"], "id", "y", trials=4, folds=3, ranges=models.SECOND_RANGES, fixed=fixed, stop_early=True, kept_share=0.5
    ).collect()
    assert [r.folds for r in found] == [3, 2, 1, 1] and {r.trial for r in found} == {0, 1, 2, 3}
    assert all(1.0 <= json.loads(r.settings)["positiveWeight"] <= 10.0 for r in found)
    stored = models.fold_vectors(df, ["a"], ["c"], "id", "y", 3)
    best = {**json.loads(found[0].settings), **fixed}
    assert found[0].mean_auc == pytest.approx(sum(models.fold_auc(t, "y", best, True) for t in stored) / 3) and found[0].mean_auc > 0.8


def test_search_settings_are_repeatable():
    assert models.draw_settings(1, 3) == models.draw_settings(1, 3) != models.draw_settings(2, 3)
    assert all(3 <= s["maxDepth"] <= 7 for s in models.draw_settings(1, 30))
