"""Exact attribution of tree models to features, for every row.

Shapley values of the path-dependent kind: where a feature is not known, a tree is
followed down both sides in proportion to the training rows that went there. The
model is turned into a table of leaf paths: per leaf and feature on its path the
interval that leads there and the share of rows that the feature's splits let
through. With shares z and o = 1 if the row lies in the interval, feature i gets from a leaf of value v

    v (o_i - z_i) * integral over t in (0, 1) of the product over j != i of (z_j (1 - t) + o_j t),

a polynomial that Gauss-Legendre nodes integrate exactly. Work grows with rows times
leaves; rows stay where they are, and the leaf table is shipped in parts of bounded size.

Rows with null vectors are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.runtime import new_path, remove

# Bytes of leaf paths that one pass over the rows carries.
PART_BYTES = 64 << 20
_CELLS = 1 << 19  # cells (row, leaf, path feature, node) worked on at a time


@dataclass
class LeafPaths:
    """The leaves of one tree; unused places of a path have share 1 and hold for every row."""

    feature: np.ndarray  # (leaves, longest path)
    low: np.ndarray      # open
    high: np.ndarray     # closed
    share: np.ndarray
    value: np.ndarray    # (leaves,), times the tree's weight

    def size(self) -> int:
        return 4 * self.low.nbytes

    def base(self) -> float:
        return float((self.value * self.share.prod(axis=1)).sum())


def leaf_paths(model: Model, spark) -> list[LeafPaths]:
    """One table per tree of a forest or boosted model, read from its saved nodes."""
    path = new_path(spark, "trees")
    model.save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()
    remove(spark, path)
    weights = model.treeWeights if hasattr(model, "treeWeights") else [1.0] * len(rows["treeID"].unique())
    if "RandomForest" in type(model).__name__:
        weights = [w / sum(weights) for w in weights]
    return [_paths_of(part.set_index("id"), weights[tree]) for tree, part in rows.groupby("treeID")]


def _paths_of(nodes, weight: float) -> LeafPaths:
    left, right, count = nodes["leftChild"].to_dict(), nodes["rightChild"].to_dict(), nodes["rawCount"].to_dict()
    split, value = nodes["split"].to_dict(), nodes["prediction"].to_dict()
    leaves, open_nodes = [], [(0, {})]
    while open_nodes:
        node, path = open_nodes.pop()
        if left[node] < 0:
            leaves.append((path, value[node] * weight))
            continue
        feature, bound = split[node]["featureIndex"], float(split[node]["leftCategoriesOrThreshold"][0])
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, interval in ((left[node], (low, min(high, bound))), (right[node], (max(low, bound), high))):
            part = max(count[child] / max(count[node], 1), 1e-12)
            open_nodes.append((child, {**path, feature: (*interval, share * part)}))
    width = max(max(len(path) for path, _ in leaves), 1)
    shape = (len(leaves), width)
    table = LeafPaths(np.zeros(shape, np.int64), np.full(shape, -np.inf), np.full(shape, np.inf), np.ones(shape),
                      np.array([v for _, v in leaves]))
    for i, (path, _) in enumerate(leaves):
        for k, (feature, (low, high, share)) in enumerate(sorted(path.items())):
            table.feature[i, k], table.low[i, k], table.high[i, k], table.share[i, k] = feature, low, high, share
    return table


def shapley(x: np.ndarray, trees: list[LeafPaths]) -> np.ndarray:
    """Values of all features for the rows of ``x``."""
    phi = np.zeros(x.shape)
    for tree in trees:
        leaves, width = tree.feature.shape
        nodes = (width + 1) // 2
        t, w = np.polynomial.legendre.leggauss(nodes)
        t, w = (t + 1) / 2, w / 2
        out = tree.share[:, :, None] * (1 - t)   # the row lies outside the interval
        inside = out + t
        target = np.zeros((leaves * width, x.shape[1]))
        target[np.arange(leaves * width), tree.feature.ravel()] = 1.0
        step = max(1, _CELLS // (leaves * width * nodes))
        for at in range(0, len(x), step):
            part = x[at : at + step][:, tree.feature]
            holds = (part > tree.low) & (part <= tree.high)
            factor = np.where(holds[..., None], inside, out)
            weighed = factor.prod(axis=2) * w
            rest = np.einsum("nlq,nlmq->nlm", weighed, 1.0 / factor)
            value = (holds - tree.share) * rest * tree.value[:, None]
            phi[at : at + step] += value.reshape(len(part), -1) @ target
    return phi


def _explained(batches: Iterator[pa.RecordBatch], trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x = np.asarray(batch.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
        before = batch.column("phi")
        phi = shapley(x, trees.value)
        if before.null_count == 0:
            phi = phi + np.asarray(before.flatten().to_numpy(zero_copy_only=False)).reshape(n, -1)
        lists = pa.ListArray.from_arrays(np.arange(0, phi.size + 1, phi.shape[1], dtype=np.int32), phi.ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("x"), lists], names=batch.schema.names)


def tree_attribution(
    assembled: DataFrame, model: Model, features: list[str], id_col: str = S.ID, part_bytes: int = PART_BYTES
) -> tuple[DataFrame, DataFrame]:
    """``(id, feature, value, phi)`` of all rows and the one-row ``base_value``.

    For every row the values and the base add up to the model's prediction.
    """
    spark = assembled.sparkSession
    trees = leaf_paths(model, spark)
    base = sum(tree.base() for tree in trees)
    rows = assembled.where(F.col("features").isNotNull()).select(
        id_col, vector_to_array("features").alias("x"), F.lit(None).cast("array<double>").alias("phi")
    )
    parts, size = [[]], 0
    for tree in trees:
        if size + tree.size() > part_bytes and parts[-1]:
            parts.append([])
            size = 0
        parts[-1].append(tree)
        size += tree.size()
    for part in parts:
        rows = _with_part(rows, spark.sparkContext.broadcast(part))
    names = F.array(*map(F.lit, features))
    cells = F.inline(F.arrays_zip(names.alias("feature"), F.col("x").alias("value"), F.col("phi").alias("phi")))
    return rows.select(id_col, cells), spark.createDataFrame([(float(base),)], "base_value double")


def _with_part(rows: DataFrame, trees) -> DataFrame:
    return rows.mapInArrow(lambda batches: _explained(batches, trees), rows.schema)
