"""Path-dependent TreeSHAP for Spark GBT models, run on executors (M13 for trees).

The tree ensemble (at most ``maxIter * (2^(maxDepth+1) - 1)`` nodes, bounded by
the model's parameters, not the data) is read from the saved model, turned into
leaf tables and broadcast. ``mapInPandas`` then explains each Arrow batch.

A leaf's part in the attributions of a row depends only on which features of its
path the row satisfies: a feature that splits the path more than once is
satisfied if all its splits are. So each leaf has a table with the attributions
of its d features for each of the 2^d subsets (Shapley values of the game "a
known feature follows the row, an unknown one its share of the training rows",
after Lundberg, Erion & Lee 2018), and a row's subset is a bit mask gathered on
the way down the tree. Rows cost one comparison a node and one lookup a leaf and
feature, for a whole batch at a time.
Attributions are in margin space; ``expected_value + sum(phi) = margin``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from retention.explain_names import shap_name


@dataclass
class Tree:
    left: np.ndarray      # child index or -1
    right: np.ndarray
    feature: np.ndarray   # split feature or -1 for leaves
    threshold: np.ndarray
    value: np.ndarray     # node prediction
    cover: np.ndarray     # training weight reaching the node
    weight: float         # tree weight in the ensemble


def load_trees(spark: SparkSession, gbt_model, scratch: str) -> list[Tree]:
    """Save the GBT stage and read its node table back (bounded by model size)."""
    path = f"{scratch}/gbt"
    gbt_model.write().overwrite().save(path)
    rows = (spark.read.parquet(f"{path}/data")
            .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
                    "nodeData.rawCount", "nodeData.leftChild", "nodeData.rightChild",
                    "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold",
                    "nodeData.split.numCategories")
            .collect())
    weights = list(gbt_model.treeWeights)
    trees: list[Tree] = []
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r.treeID, []).append(r)
    for tid in sorted(by_tree):
        nodes = sorted(by_tree[tid], key=lambda r: r.id)
        n = len(nodes)
        t = Tree(np.full(n, -1), np.full(n, -1), np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n),
                 float(weights[tid]))
        for r in nodes:
            i = r.id
            t.value[i] = r.prediction
            stats = r.impurityStats or []
            t.cover[i] = float(stats[0]) if stats else float(r.rawCount)
            if r.leftChild is not None and r.leftChild >= 0:
                if r.numCategories is not None and r.numCategories >= 0:
                    raise ValueError("categorical splits are not supported")
                t.left[i], t.right[i] = r.leftChild, r.rightChild
                t.feature[i] = r.featureIndex
                t.threshold[i] = r.leftCategoriesOrThreshold[0]
        trees.append(t)
    return trees


def expected_value(trees: list[Tree]) -> float:
    """Mean margin over the training distribution implied by the covers."""
    total = 0.0
    for t in trees:
        leaves = t.feature < 0
        total += t.weight * float(np.sum(t.value[leaves] * t.cover[leaves]) / t.cover[0])
    return total


#: Distinct features on one path; a leaf's table has 2^d rows.
MAX_PATH = 16


@dataclass
class LeafTables:
    """A tree with, at each leaf, the features of its path and their attributions by subset (d x 2^d)."""

    tree: Tree
    features: dict[int, list[int]]
    tables: dict[int, np.ndarray]


def _subset_attributions(z: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaves, d, 2^d): Shapley values of each feature of each leaf for each set of satisfied features.

    ``z`` (leaves x d) has the shares of training rows that follow the path at each feature, ``value`` what
    the leaves add. The sum over coalitions is a polynomial in the coalition's size: a satisfied feature is
    in it (one up) or left out (its share); one that isn't satisfied must be left out."""
    leaves, d = z.shape
    on = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
    orders = np.array([math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)])
    out = np.empty((leaves, d, 1 << d))
    for j in range(d):
        by_size = np.zeros((leaves, 1 << d, d))
        by_size[..., 0] = 1.0
        for k in range(d):
            if k != j:
                joined = np.zeros_like(by_size)
                joined[..., 1:] = by_size[..., :-1] * on[None, :, k, None]
                by_size = joined + by_size * z[:, None, None, k]
        out[:, j] = value[:, None] * (on[None, :, j] - z[:, None, j]) * (by_size @ orders)
    return out


def leaf_tables(t: Tree) -> LeafTables:
    """The paths of a tree's leaves, features in the order in which they first come, and their tables."""
    found = LeafTables(t, {}, {})
    by_length: dict[int, list[tuple[int, list[float]]]] = {}
    stack = [(0, [], [])]
    while stack:
        node, features, shares = stack.pop()
        f = int(t.feature[node])
        if f < 0:
            found.features[node] = features
            by_length.setdefault(len(features), []).append((node, shares))
            continue
        for child in (int(t.left[node]), int(t.right[node])):
            share = t.cover[child] / t.cover[node]
            if f in features:
                at = features.index(f)
                stack.append((child, features, [s * share if i == at else s for i, s in enumerate(shares)]))
            else:
                stack.append((child, [*features, f], [*shares, share]))
    for d, leaves in by_length.items():
        if d > MAX_PATH:
            raise ValueError(f"a path of {d} features; at most {MAX_PATH} are supported")
        if d:
            nodes = [n for n, _ in leaves]
            tables = _subset_attributions(np.array([s for _, s in leaves]), t.weight * t.value[nodes])
            found.tables.update(zip(nodes, tables))
    return found


def add_attributions(leaves: LeafTables, X: np.ndarray, phi: np.ndarray) -> None:
    """Add a tree's attributions of all rows. ``X`` and ``phi`` have a row a feature."""
    t = leaves.tree
    stack = [(0, [], np.zeros(X.shape[1], np.uint16))]
    while stack:
        node, features, mask = stack.pop()
        f = int(t.feature[node])
        if f < 0:
            for feature, by_subset in zip(features, leaves.tables.get(node, ())):
                phi[feature] += by_subset[mask]
            continue
        goes_left = X[f] <= t.threshold[node]
        for child, goes in ((int(t.left[node]), goes_left), (int(t.right[node]), ~goes_left)):
            if f in features:
                bit = np.uint16(1 << features.index(f))
                stack.append((child, features, mask & (goes * bit | ~bit)))
            else:
                stack.append((child, [*features, f], mask | goes * np.uint16(1 << len(features))))


def attributions(tables: list[LeafTables], X: np.ndarray) -> np.ndarray:
    """SHAP values of the rows of ``X`` under the sum of all trees."""
    columns = np.ascontiguousarray(X.T)
    phi = np.zeros_like(columns)
    for leaves in tables:
        add_attributions(leaves, columns, phi)
    return phi.T


def shap_values(trees: list[Tree], X: np.ndarray) -> np.ndarray:
    return attributions([leaf_tables(t) for t in trees], X)


def margin(trees: list[Tree], X: np.ndarray) -> np.ndarray:
    out = np.zeros(X.shape[0])
    for t in trees:
        node = np.zeros(X.shape[0], dtype=int)
        while (inner := t.feature[node] >= 0).any():
            f = np.where(inner, t.feature[node], 0)
            go_left = X[np.arange(X.shape[0]), f] <= t.threshold[node]
            node = np.where(inner, np.where(go_left, t.left[node], t.right[node]), node)
        out += t.weight * t.value[node]
    return out


def explain_rows(spark: SparkSession, trees: list[Tree], rows: DataFrame, columns: list[str],
                 keys: tuple[str, ...] = ("customer_id", "snapshot_date")) -> DataFrame:
    """M13 + M14 for trees over ``columns``: ``keys, expected_value, shap_<feature>...`` for every row.

    The work is in Python and heavy for its bytes, so rows are dealt to as many partitions as the session
    shuffles to (or has cores), not by their size."""
    from retention.session import ship_package
    ship_package(spark)
    ev = expected_value(trees)
    bc = spark.sparkContext.broadcast([leaf_tables(t) for t in trees])
    key_fields = [rows.schema[k] for k in keys]
    out_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields]
                           + ["expected_value double"] + [f"`{shap_name(c)}` double" for c in columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            phi = attributions(tables, pdf[columns].to_numpy(dtype=float))
            res = pd.DataFrame(phi, columns=[shap_name(c) for c in columns])
            res.insert(0, "expected_value", ev)
            for i, k in enumerate(keys):
                res.insert(i, k, pdf[k].to_numpy())
            yield res

    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.select(*keys, *columns).repartition(parts).mapInPandas(run, out_schema)


def explain(spark: SparkSession, model, sample: DataFrame, scratch: str,
            keys: tuple[str, ...] = ("customer_id", "snapshot_date")) -> DataFrame:
    """M13 + M14 for the fitted ``PipelineModel`` (assembler + GBT)."""
    from retention.operators.model import model_columns, prepare
    columns = model_columns(model)
    return explain_rows(spark, load_trees(spark, model.stages[-1], scratch), prepare(sample, columns), columns, keys)
