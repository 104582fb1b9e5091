"""Boosted trees as a table of nodes: a model that any engine can read, and a scorer of it.

One row per node: ``tree``, ``weight`` (of the tree), ``node`` (0 is the root), ``feature`` (NULL
on a leaf), ``threshold`` (go left up to it) or ``categories`` (go left if among them), ``left``,
``right`` and ``value``. The margin of a row is the weighted sum of the values of its leaves.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlog.sources.tables import delete, new_table

#: Nodes of a model that goes to the tasks: 10 000 trees of 500 nodes, some 200 MB.
MOST_NODES = 5_000_000
_CHUNK = 2_048  # rows that walk down the trees together


def save(model: MLWritable, spark: SparkSession, path: str) -> None:
    """Write the node table of a boosted model, from what Spark's own writer stores."""
    native = new_table(spark, "native-model")
    model.write().save(native)
    trees = spark.read.parquet(f"{native}/treesMetadata").toDF("tree", "metadata", "weight")
    stored = spark.read.parquet(f"{native}/data").selectExpr("treeID as tree", "nodeData.*")
    inner = "split.featureIndex >= 0"
    table = stored.join(trees.drop("metadata"), "tree").selectExpr(
        "tree",
        "double(weight) as weight",
        "id as node",
        f"if({inner}, split.featureIndex, null) as feature",
        f"if({inner} and split.numCategories < 0, split.leftCategoriesOrThreshold[0], null) as threshold",
        f"if({inner} and split.numCategories >= 0, split.leftCategoriesOrThreshold, null) as categories",
        f"if({inner}, leftChild, null) as left",
        f"if({inner}, rightChild, null) as right",
        "prediction as value",
    )
    table.write.mode("overwrite").parquet(path)
    delete(spark, native)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class Forest:
    """The node table as arrays over all nodes of all trees."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r["tree"], r["node"]))
        at = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
        here = np.arange(len(rows), dtype=np.int32)
        self.roots = np.array([i for (_, node), i in at.items() if node == 0], np.int32)
        self.weights = np.array([rows[i]["weight"] for i in self.roots])
        self.value = np.array([r["value"] for r in rows])
        # A leaf compares any feature and stays where it is.
        self.feature = np.array([-1 if r["feature"] is None else r["feature"] for r in rows], np.int32)
        self.threshold = np.array([np.inf if r["threshold"] is None else r["threshold"] for r in rows])
        self.left, self.right = here.copy(), here.copy()
        self.first = np.full(len(rows), -1, np.int64)  # where a node's categories begin in `goes`
        goes = []
        for i, r in enumerate(rows):
            if r["feature"] is None:
                continue
            self.left[i], self.right[i] = at[r["tree"], r["left"]], at[r["tree"], r["right"]]
            if r["categories"] is not None:
                most = int(max(r["categories"], default=-1))
                self.first[i] = len(goes)
                goes += [float(c) in set(r["categories"]) for c in range(most + 1)] + [False]
        self.goes = np.array(goes, bool)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Each row's leaf in each tree."""
        now = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        by_row = np.arange(len(x))[:, None]
        while True:
            feature = self.feature[now]
            if (feature < 0).all():
                return now
            value = x[by_row, np.maximum(feature, 0)]
            left = value <= self.threshold[now]
            first = self.first[now]
            if (chosen := first >= 0).any():
                left[chosen] = self._among(now[chosen], value[chosen].astype(np.int64))
            now = np.where(left, self.left[now], self.right[now])

    def _among(self, nodes: np.ndarray, category: np.ndarray) -> np.ndarray:
        ends = np.append(self.first[self.first >= 0][1:], len(self.goes)) - 1
        end = ends[np.searchsorted(self.first[self.first >= 0], self.first[nodes])]
        # A category beyond the largest that goes left meets the False at the end.
        return self.goes[np.minimum(self.first[nodes] + category, end)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        parts = [
            self.value[self.leaves(x[a : a + _CHUNK])] @ self.weights
            for a in range(0, len(x), _CHUNK)
        ]
        return np.concatenate(parts) if parts else np.empty(0)


def score(rows: DataFrame, nodes: DataFrame, features: str = "features") -> DataFrame:
    """``rows`` without ``features``, with ``margin`` and ``score``, the probability of class 1.

    ``features`` is a vector or an array of doubles. The nodes go to every task; a table
    of more than ``MOST_NODES`` is refused.
    """
    found = nodes.limit(MOST_NODES + 1).collect()
    if len(found) > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    forest = rows.sparkSession.sparkContext.broadcast(Forest([r.asDict() for r in found]))
    kept = [c for c in rows.columns if c != features]
    if dict(rows.dtypes)[features] == "vector":
        rows = rows.withColumn(features, vector_to_array(features))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            margins = forest.value.margins(x) if len(batch) else np.empty(0)
            arrays = [*batch.columns[: len(kept)], pa.array(margins)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "margin"])

    schema = rows.select(*kept).withColumn("margin", F.lit(0.0)).schema
    scored = rows.select(*kept, features).mapInArrow(run, schema)
    return scored.withColumn("score", F.expr("1 / (1 + exp(-2 * margin))"))
