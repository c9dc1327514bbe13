"""Boosted trees by gradient and Hessian histograms (M1 as the reference sets it).

Features are cut at quantiles once. A tree grows level by level: each task adds up, for its rows, the
gradients and Hessians of the logistic loss by (node, feature, bin); one shuffle keyed by (node,
feature) sums these histograms and finds each feature's best cut; a row a node and feature goes to the
driver, which holds the model only. Leaf weights are regularised, rows are sampled per tree by a hash
of their keys, columns per tree by the seed.

Gradients are added as whole numbers of 2^-26, so sums don't depend on the order and the model is the
same under any partitioning. Rows carry the margin of the trees up to the last checkpoint and compute
that of later trees as they are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.operators.model import prepare
from retention.operators.treeshap import Tree
from retention.session import materialize, ship_package


@dataclass(frozen=True)
class BoostParams:
    # The reference's boosting settings.
    rounds: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    row_sample: float = 0.8
    column_sample: float = 0.8
    seed: int = 42
    # Defaults of the settings that the reference leaves open.
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    base_score: float = 0.5
    max_bins: int = 256
    # Execution only: trees between two checkpoints of the margins.
    checkpoint_interval: int = 10


#: Gradients and Hessians are whole numbers of 2^-SCALE_BITS: sums of 2^36 rows fit in 64 bits.
SCALE_BITS = 26
#: A cut's rank is off by one in so many bins at most.
RANKS_A_BIN = 10
ROWS = "key bigint, label double, bins binary, margin double"


@dataclass
class BoostedModel:
    """Trees over ``columns``; a row's margin is ``base`` and its leaves' weighted values."""

    columns: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)
    bin_cuts: list[np.ndarray] = field(default_factory=list)  # per tree: the bin that each node is cut after


def quantile_cuts(df: DataFrame, columns: list[str], max_bins: int) -> list[list[float]]:
    """For each column its candidate thresholds: values at quantiles, ascending, without the largest. One
    aggregate; at most ``max_bins`` numbers a column reach the driver."""
    at = ", ".join(f"{i / max_bins!r}D" for i in range(1, max_bins + 1))
    r = df.agg(*(F.expr(f"percentile_approx(`{c}`, array({at}), {RANKS_A_BIN * max_bins})").alias(c) for c in columns)).first()
    return [sorted(set(r[c] or []))[:-1] for c in columns]


def binned(df: DataFrame, columns: list[str], label: str, keys: tuple[str, ...], cuts: list[list[float]], base: float, seed: int) -> DataFrame:
    """(key, label, bins, margin): a byte a feature, the number of its cuts below the value; null is 0."""
    ship_package(df.sparkSession)
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes = np.empty((len(pdf), len(columns)), np.uint8)
            for j, c in enumerate(columns):
                codes[:, j] = np.searchsorted(edges[j], pdf[c].to_numpy(dtype=float), side="left")
            yield pd.DataFrame({"key": pdf["_key"], "label": pdf["_label"], "bins": [row.tobytes() for row in codes], "margin": base})

    ready = prepare(df, columns).select(F.xxhash64(F.lit(seed), *keys).alias("_key"), F.col(label).cast("double").alias("_label"), *columns)
    return ready.where("_label is not null").mapInPandas(run, ROWS)


def _uniform(key: np.ndarray, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row key and tree."""
    x = key.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (tree + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53


def leaf_of(t: Tree, cut_after: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The node that each row of binned features has come to."""
    node = np.zeros(len(codes), np.int64)
    rows = np.arange(len(codes))
    while len(rows):
        rows = rows[t.feature[node[rows]] >= 0]
        at = node[rows]
        left = codes[rows, t.feature[at]] <= cut_after[at]
        node[rows] = np.where(left, t.left[at], t.right[at])
    return node


def _codes(pdf: pd.DataFrame, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), width)


def _margins(pdf: pd.DataFrame, codes: np.ndarray, trees) -> np.ndarray:
    margin = pdf["margin"].to_numpy(dtype=float).copy()
    for t, cut_after in trees:
        margin += t.weight * t.value[leaf_of(t, cut_after, codes)]
    return margin


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the logistic loss by the margin, as whole numbers."""
    p = 1.0 / (1.0 + np.exp(-margin))
    one = float(1 << SCALE_BITS)
    return np.rint((p - label) * one).astype(np.int64), np.rint(p * (1.0 - p) * one).astype(np.int64)


HISTOGRAMS = "node int, feature int, sums binary"
BEST = "node int, feature int, gain double, cut int, g bigint, h bigint, g_left bigint, h_left bigint"


def _histograms(width: int, bins: int, p: BoostParams, number: int, used: list[int], done, growing, open_nodes: list[int]):
    """Sums of gradients and Hessians by (node, feature, bin) of a task's rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {n: i for i, n in enumerate(open_nodes)}
        sums = np.zeros((len(open_nodes), len(used), bins, 2), np.int64)
        seen = False
        for pdf in batches:
            pdf = pdf[_uniform(pdf["key"].to_numpy(dtype=np.int64), number) < p.row_sample]
            if pdf.empty:
                continue
            codes = _codes(pdf, width)
            node = leaf_of(*growing, codes)
            slot = np.array([place.get(n, -1) for n in range(len(growing[0].left))])[node]
            here = slot >= 0
            if not here.any():
                continue
            seen = True
            g, h = gradients(_margins(pdf, codes, done)[here], pdf["label"].to_numpy(dtype=float)[here])
            slot, codes = slot[here], codes[here]
            for i, f in enumerate(used):
                at = (slot * len(used) + i) * bins + codes[:, f]
                flat = sums.reshape(-1, 2)
                np.add.at(flat[:, 0], at, g)
                np.add.at(flat[:, 1], at, h)
        if seen:
            yield pd.DataFrame({"node": np.repeat(open_nodes, len(used)), "feature": used * len(open_nodes),
                                "sums": [sums[i, j].tobytes() for i in range(len(open_nodes)) for j in range(len(used))]})

    return run


def best_cut(sums: np.ndarray, cuts: int, p: BoostParams) -> tuple[float, int, int, int, int, int]:
    """(gain, cut, G, H, G left, H left) of the best of a feature's cuts, the first of equal ones; gain 0
    and cut -1 if none gains."""
    one = float(1 << SCALE_BITS)
    total = sums.sum(axis=0)
    left = np.cumsum(sums, axis=0)[:cuts]
    right = total - left

    def score(s):
        return (s[..., 0] / one) ** 2 / (s[..., 1] / one + p.reg_lambda)

    gain = score(left) + score(right) - score(total)
    allowed = (left[:, 1] >= p.min_child_weight * one) & (right[:, 1] >= p.min_child_weight * one)
    gain = np.where(allowed, gain, 0.0)
    at = int(np.argmax(gain)) if cuts else -1
    if at < 0 or gain[at] <= 1e-12:
        return 0.0, -1, int(total[0]), int(total[1]), 0, 0
    return float(gain[at]), at, int(total[0]), int(total[1]), int(left[at, 0]), int(left[at, 1])


def _best_cuts(bins: int, cut_counts: list[int], p: BoostParams):
    """Sums the histograms of each (node, feature) and finds its best cut; holds those of its partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for pdf in batches:
            for n, f, data in zip(pdf["node"], pdf["feature"], pdf["sums"]):
                part = np.frombuffer(data, np.int64).reshape(bins, 2)
                sums[n, f] = sums[n, f] + part if (n, f) in sums else part
        if sums:
            yield pd.DataFrame([(n, f, *best_cut(s, cut_counts[f], p)) for (n, f), s in sums.items()],
                               columns=[c.split()[0] for c in BEST.split(", ")])

    return run


class _Growing:
    """A tree under construction, as lists."""

    def __init__(self):
        self.left, self.right, self.feature, self.threshold = [-1], [-1], [-1], [0.0]
        self.cut, self.value, self.cover = [-1], [0.0], [0.0]

    def split(self, node: int, feature: int, cut: int, threshold: float) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.threshold[node] = feature, cut, threshold
        self.left[node], self.right[node] = len(self.left), len(self.left) + 1
        for column, value in ((self.left, -1), (self.right, -1), (self.feature, -1), (self.threshold, 0.0), (self.cut, -1), (self.value, 0.0), (self.cover, 0.0)):
            column += [value, value]
        return self.left[node], self.right[node]

    def weigh(self, node: int, g: int, h: int, p: BoostParams) -> None:
        one = float(1 << SCALE_BITS)
        self.value[node], self.cover[node] = -(g / one) / (h / one + p.reg_lambda), h / one

    def tree(self, rate: float) -> tuple[Tree, np.ndarray]:
        t = Tree(np.array(self.left), np.array(self.right), np.array(self.feature), np.array(self.threshold), np.array(self.value), np.array(self.cover), rate)
        return t, np.array(self.cut)


def tree_columns(p: BoostParams, number: int, width: int) -> list[int]:
    """The columns that a tree may use: drawn by the seed and the tree's number, at least one."""
    n = max(1, int(p.column_sample * width))
    return sorted(int(i) for i in np.random.default_rng((p.seed, number)).choice(width, n, replace=False))


def grow_tree(rows: DataFrame, model: BoostedModel, done: list, number: int, p: BoostParams) -> tuple[Tree, np.ndarray]:
    """One tree: a job a level, until no node gains or the depth is reached."""
    width, bins = len(model.columns), max(map(len, model.cuts)) + 1
    used = tree_columns(p, number, width)
    growing, open_nodes = _Growing(), [0]
    for _ in range(p.max_depth):
        parts = rows.mapInPandas(_histograms(width, bins, p, number, used, done, growing.tree(p.learning_rate), open_nodes), HISTOGRAMS)
        found = parts.repartition("node", "feature").mapInPandas(_best_cuts(bins, list(map(len, model.cuts)), p), BEST).collect()  # a row a node and feature
        best: dict[int, object] = {}
        for r in sorted(found, key=lambda r: (r.node, -r.gain, r.feature)):
            best.setdefault(r.node, r)
        open_nodes = []
        for node, r in best.items():
            growing.weigh(node, r.g, r.h, p)
            if r.cut >= 0:
                left, right = growing.split(node, r.feature, r.cut, model.cuts[r.feature][r.cut])
                growing.weigh(left, r.g_left, r.h_left, p)
                growing.weigh(right, r.g - r.g_left, r.h - r.h_left, p)
                open_nodes += [left, right]
        if not open_nodes:
            break
    return growing.tree(p.learning_rate)


def fit(train: DataFrame, columns: list[str], label: str = "churn_label", keys: tuple[str, ...] = ("customer_id", "snapshot_date"),
        p: BoostParams = BoostParams(), cuts: list[list[float]] | None = None) -> BoostedModel:
    """M1. ``cuts`` gives the candidate thresholds of each column instead of quantiles. Rows without a label
    are left out; an empty table gives a model of the base score only."""
    if cuts is None:
        cuts = quantile_cuts(prepare(train, columns).where(F.col(label).isNotNull()), columns, p.max_bins)
    if max(map(len, cuts)) > 255:
        raise ValueError("at most 255 cuts a column: a bin is a byte")
    model = BoostedModel(list(columns), cuts, math.log(p.base_score / (1.0 - p.base_score)))
    width = len(columns)
    spark = train.sparkSession
    # a pass is Python work, heavy for its bytes: dealt to as many partitions as the session shuffles to
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = materialize(binned(train, columns, label, keys, cuts, model.base, p.seed).repartition(parts))
    since: list = []
    for number in range(p.rounds):
        tree, cut_after = grow_tree(rows, model, since, number, p)
        if len(tree.left) == 1 and tree.cover[0] == 0.0:
            break  # no rows
        model.trees.append(tree)
        model.bin_cuts.append(cut_after)
        since.append((tree, cut_after))
        if len(since) == p.checkpoint_interval and number + 1 < p.rounds:
            rows, since = materialize(rows.mapInPandas(_moved_on(width, since), ROWS)), []
    return model


def _moved_on(width: int, trees):
    """The rows with the margin after ``trees``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not pdf.empty:
                yield pdf.assign(margin=_margins(pdf, _codes(pdf, width), trees))

    return run


def with_margin(model: BoostedModel, df: DataFrame, name: str = "margin") -> DataFrame:
    """``df`` with the model's margin of each row; its columns are read as ``prepare`` makes them."""
    from pyspark.sql.functions import pandas_udf

    from retention.operators.treeshap import margin as tree_margin
    ship_package(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast((model.trees, model.base))

    @pandas_udf("double")
    def margin_of(features: pd.DataFrame) -> pd.Series:
        trees, base = held.value
        return pd.Series(base + tree_margin(trees, features.to_numpy(dtype=float)))

    inputs = F.struct(*(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0)).alias(c) for c in model.columns))
    return df.withColumn(name, margin_of(inputs))


def predict(model: BoostedModel, features: DataFrame, run_date: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """M4: probability of class 1 and the 0/1 class, ids kept in the row."""
    from retention.functions.timewin import date_lit
    scored = with_margin(model, features, "_margin").withColumn("churn_probability", 1.0 / (1.0 + F.exp(-F.col("_margin"))))
    return scored.select("customer_id", "snapshot_date", *keep, "churn_probability",
                         (F.col("churn_probability") > 0.5).cast("int").alias("churn_prediction"), date_lit(run_date).alias("prediction_date"))


NODES = "tree int, node int, left int, right int, feature int, threshold double, value double, cover double, weight double"


def node_table(spark: SparkSession, model: BoostedModel) -> DataFrame:
    """The model as rows: a row a node."""
    return spark.createDataFrame(
        [(i, n, int(t.left[n]), int(t.right[n]), int(t.feature[n]), float(t.threshold[n]), float(t.value[n]), float(t.cover[n]), t.weight)
         for i, t in enumerate(model.trees) for n in range(len(t.left))], NODES)


def save(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """Node table and column names as Parquet."""
    node_table(spark, model).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(model.columns, model.base)], "columns array<string>, base double").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load(spark: SparkSession, path: str) -> BoostedModel:
    head = spark.read.parquet(f"{path}/model").first()
    model = BoostedModel(list(head["columns"]), [], head["base"])
    by_tree: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
        by_tree.setdefault(r.tree, []).append(r)
    for rows in by_tree.values():
        model.trees.append(Tree(*(np.array([r[c] for r in rows]) for c in ("left", "right", "feature", "threshold", "value", "cover")), rows[0].weight))
    return model
