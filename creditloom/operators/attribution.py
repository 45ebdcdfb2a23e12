"""Why a score is what it is: per-row feature attributions and the ten largest of them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.functions.registry import feature_rows, feature_table
from creditloom.runtime import scratch_path

# fixed value: attributions reported per row
TOP = 10
#: Rows and leaves that are worked on together; their polynomials take rows x leaves x (depth + 1) numbers.
ROWS_AT_ONCE, LEAVES_AT_ONCE = 512, 1024


def top_by_size(cells: Column, k: int = TOP) -> Column:
    """Largest cells by absolute ``shap_value``; ties keep feature order (``position``)."""

    def before(a: Column, b: Column) -> Column:
        x, y = F.abs(a["shap_value"]), F.abs(b["shap_value"])
        return (
            F.when(x > y, -1).when(x < y, 1)
            .when(a["position"] < b["position"], -1).when(a["position"] > b["position"], 1)
            .otherwise(0)
        )

    return F.slice(F.array_sort(cells, before), 1, k)


def linear_attribution(
    df: DataFrame, coefficients: dict[str, float], means: dict[str, float], keep: list[str], k: int = TOP
) -> DataFrame:
    """Coefficient times distance from the mean, per feature, as column arithmetic."""
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("feature_name"),
                (F.lit(float(w)) * (F.col(f"`{name}`").cast("double") - F.lit(float(means[name])))).alias("shap_value"),
                F.col(f"`{name}`").cast("double").alias("feature_value"),
            )
            for i, (name, w) in enumerate(coefficients.items())
        ]
    )
    return df.select(*keep, top_by_size(cells, k).alias("top"))


def describe_top(top: DataFrame, keep: list[str]) -> DataFrame:
    """One row per reported feature with its description, "" if it is not registered."""
    rows = top.select(*keep, F.posexplode("top").alias("rank", "cell"))
    names = F.broadcast(
        feature_table(top.sparkSession).select(F.col("name").alias("feature_name"), "description")
    )
    flat = rows.select(
        *keep, (F.col("rank") + 1).alias("rank"), "cell.feature_name", "cell.shap_value", "cell.feature_value"
    )
    return flat.join(names, "feature_name", "left").select(
        *keep, "rank", "feature_name", "shap_value", "feature_value",
        F.coalesce("description", F.lit("")).alias("description"),
    )


class Step(NamedTuple):
    """What a path asks of one feature: an interval (low, high], category sets it must or must not lie in, and a share.

    The share of training rows that went the path's way at the splits on this feature stands for an unknown value.
    """

    low: float
    high: float
    sets: tuple[tuple[tuple[float, ...], bool], ...]
    share: float


class Leaf(NamedTuple):
    """A leaf as its value, weighted by its tree, and the step of every feature on the way to it."""

    value: float
    steps: dict[int, Step]


def tree_leaves(model: GBTClassificationModel) -> list[Leaf]:
    """Leaves of all trees, from the node table Spark ML stores with a model."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    nodes = nodes.select("treeID", "nodeData.*") if "nodeData" in nodes.columns else nodes
    trees: dict[int, dict[int, object]] = defaultdict(dict)
    for row in nodes.collect():
        trees[row["treeID"]][row["id"]] = row
    leaves: list[Leaf] = []
    for number, weight in enumerate(model.treeWeights):
        nodes_of = trees[number]
        # (node, features met so far)
        open_nodes: list[tuple[int, dict[int, Step]]] = [(0, {})]
        while open_nodes:
            at, steps = open_nodes.pop()
            node = nodes_of[at]
            if node["leftChild"] < 0:
                leaves.append(Leaf(weight * node["prediction"], steps))
                continue
            split = node["split"]
            feature = split["featureIndex"]
            known = steps.get(feature, Step(-np.inf, np.inf, (), 1.0))
            for child, is_left in ((node["leftChild"], True), (node["rightChild"], False)):
                share = known.share * nodes_of[child]["rawCount"] / node["rawCount"]
                if split["numCategories"] >= 0:
                    # a category goes left if the split lists it, else right, unseen ones too
                    step = known._replace(sets=(*known.sets, (tuple(split["leftCategoriesOrThreshold"]), is_left)), share=share)
                elif is_left:
                    step = known._replace(high=min(known.high, split["leftCategoriesOrThreshold"][0]), share=share)
                else:
                    step = known._replace(low=max(known.low, split["leftCategoriesOrThreshold"][0]), share=share)
                open_nodes.append((child, {**steps, feature: step}))
    return leaves


class LeafBlock:
    """Leaves with the same number of features on their paths, as arrays (leaf, place on the path)."""

    def __init__(self, leaves: list[Leaf]) -> None:
        steps = [list(leaf.steps.items()) for leaf in leaves]
        self.value = np.array([leaf.value for leaf in leaves])
        self.feature = np.array([[f for f, _ in path] for path in steps])
        self.low, self.high, self.share = (np.array([[getattr(s, name) for _, s in path] for path in steps]) for name in ("low", "high", "share"))
        self.sets = [(i, j, s.sets) for i, path in enumerate(steps) for j, (_, s) in enumerate(path) if s.sets]

    def met(self, x: np.ndarray) -> np.ndarray:
        """Whether each row (first axis) passes each step (leaf, place)."""
        seen = x[:, self.feature]
        passed = (seen > self.low) & (seen <= self.high)
        for leaf, place, sets in self.sets:
            values = x[:, self.feature[leaf, place]]
            for members, inside in sets:
                passed[:, leaf, place] &= np.isin(values, members) == inside
        return passed


def leaf_blocks(leaves: list[Leaf]) -> list[LeafBlock]:
    """Leaves by the length of their paths, in blocks of bounded size; leaves that ask nothing explain nothing."""
    by_length: dict[int, list[Leaf]] = defaultdict(list)
    for leaf in leaves:
        if leaf.steps:
            by_length[len(leaf.steps)].append(leaf)
    return [LeafBlock(part[i : i + LEAVES_AT_ONCE]) for part in by_length.values() for i in range(0, len(part), LEAVES_AT_ONCE)]


def base_margin(leaves: list[Leaf]) -> float:
    """The margin expected when no feature is known."""
    return float(sum(leaf.value * np.prod([s.share for s in leaf.steps.values()]) for leaf in leaves))


def shapley(x: np.ndarray, blocks: list[LeafBlock]) -> np.ndarray:
    """Exact Shapley values of a tree ensemble's margin for a block of rows, one column per feature.

    A leaf counts with the product over its path of: 1 or 0 for a known feature that passes its step or not, the step's share for an
    unknown one. The polynomial with one factor (share + t * passed) per feature on the path holds, at t^k, the sum of these products over
    all sets of k known features. It is extended factor by factor along the path; dividing one factor out again gives
    the sums over the sets without that feature, which the Shapley weights of their sizes add up. So a leaf costs the square of its path's length.
    """
    out = np.zeros(x.shape)
    for block in blocks:
        length = block.feature.shape[1]
        weights = [factorial(k) * factorial(length - k - 1) / factorial(length) for k in range(length)]
        passed = block.met(x)
        sums = np.zeros((length + 1, *passed.shape[:2]))
        sums[0] = 1.0
        for j in range(length):
            for k in range(j + 1, 0, -1):
                sums[k] = sums[k] * block.share[:, j] + sums[k - 1] * passed[:, :, j]
            sums[0] *= block.share[:, j]
        for j in range(length):
            share, known = block.share[:, j], passed[:, :, j]
            # with the factor (share + t), from the highest power down; with the factor share alone, by division
            rest = sums[length]
            with_t = weights[length - 1] * rest
            without_t = weights[0] * sums[0]
            for k in range(length - 1, 0, -1):
                rest = sums[k] - share * rest
                with_t = with_t + weights[k - 1] * rest
                without_t = without_t + weights[k] * sums[k]
            total = np.where(known, with_t, without_t / np.where(share > 0, share, 1.0))
            gain = block.value * total * (known - share)
            owner = np.zeros((len(share), x.shape[1]))
            owner[np.arange(len(share)), block.feature[:, j]] = 1.0
            out += gain @ owner
    return out


def _cells(phi: np.ndarray, x: np.ndarray, names: list[str], k: int) -> pa.ListArray:
    """The ``k`` largest values of every row as an Arrow list of cells."""
    order = np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :k]
    width, flat = order.shape[1], order.ravel()
    fields = {
        "position": pa.array(flat, pa.int32()),
        "feature_name": pa.array(names, pa.string()).take(pa.array(flat)),
        "shap_value": pa.array(np.take_along_axis(phi, order, 1).ravel()),
        "feature_value": pa.array(np.take_along_axis(x, order, 1).ravel()),
    }
    cells = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(phi) + 1) * width, pa.int32()), cells)


def tree_attribution(
    df: DataFrame, model: GBTClassificationModel | list[Leaf], names: list[str], keep: list[str], k: int = TOP,
    features: str = "features",
) -> DataFrame:
    """Shapley values of the boosted margin for every row: the ``k`` largest (``top``), the sum of the others (``rest``), and ``base``.

    ``base`` is the margin expected without any feature, so base + top + rest is the row's margin. Rows stay in their partitions; each
    Arrow batch is worked on in blocks of rows. The leaves travel with the function and number at most trees times 2^depth; a job
    with many batches reads them once with ``tree_leaves`` and hands them in.
    """
    leaves = model if isinstance(model, list) else tree_leaves(model)
    blocks, base = leaf_blocks(leaves), base_margin(leaves)
    cell = "struct<position:int,feature_name:string,shap_value:double,feature_value:double>"
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    target = T.StructType.fromDDL(f"{fields}{', ' if keep else ''}top array<{cell}>, rest double, base double")
    arrow = to_arrow_schema(target)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                x = part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                phi = shapley(x, blocks)
                top = _cells(phi, x, names, k)
                named = top.flatten().field("shap_value").to_numpy().reshape(part.num_rows, -1).sum(axis=1)
                columns = [*part.columns[:-1], top, pa.array(phi.sum(axis=1) - named), pa.array(np.full(part.num_rows, base))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.select(*keep, vector_to_array(features).alias("_x")).mapInArrow(explain, target)


def attribution_text(top: Column, names: list[str]) -> Column:
    """The cells of a row as the JSON text of the audit table, each with its feature's description ("" if it is not registered)."""
    words = {f.name: f.description for f in feature_rows()}
    known = F.array(*[F.lit(words.get(n, "")) for n in names])
    cells = F.transform(
        top,
        lambda c: F.struct(
            *[c[n].alias(n) for n in ("feature_name", "shap_value", "feature_value")], F.get(known, c["position"]).alias("description")
        ),
    )
    return F.to_json(cells, {"ignoreNullFields": "false"})
