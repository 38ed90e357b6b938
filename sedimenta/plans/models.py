"""Churn classifier and anomaly detector.

Fitting and scoring run on the executors.  The anomaly detector follows the
published isolation forest (Liu, Ting, Zhou 2008).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.percentiles import exact_percentiles
from sedimenta.operators.windows import top_n_per_group
from sedimenta.plans.features import stratified_split
from sedimenta.scale import durable

CHURN_FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value", "active_days", "categories_purchased"]
# Fixed values of the models.
FOREST_TREES, FOREST_DEPTH, SEED, TEST_SHARE = 100, 10, 42, 0.2
ISOLATION_TREES, SAMPLE_ROWS, CONTAMINATION = 100, 256, 0.05

NODE = "tree int, node int, feature int, threshold double, left int, right int, path double"


def balanced(rows: DataFrame, label: str) -> DataFrame:
    """Add ``weight``: rows / (classes x rows of the class)."""
    counts = rows.groupBy(label).count().collect()  # one row per class
    total = sum(r["count"] for r in counts)
    weight = F.lit(None).cast("double")
    for r in counts:
        weight = F.when(F.col(label) == r[label], total / (len(counts) * r["count"])).otherwise(weight)
    return rows.withColumn("weight", weight)


def fit_churn(features: DataFrame, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH):
    """Fitted model and the scored test rows.  A customer's rows of all cutoffs
    are on one side of the split."""
    split = stratified_split(features.na.drop(subset=CHURN_FEATURES), "customer_id", TEST_SHARE)
    split = durable(split.withColumn("label", F.col("churned").cast("double")), "churn")
    train = balanced(split.filter(~F.col("is_test")), "label")
    # Each level of the trees is a pass over all rows, so that its tasks should be of one size.  Sorted, as the
    # draws go by partition and position.
    tasks = 2 * split.sparkSession.sparkContext.defaultParallelism
    train = train.repartition(tasks, "customer_id").sortWithinPartitions(*[c for c in split.columns if c != "is_test"])
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED,
        # Statistics of more nodes per pass: fewer passes over the rows.
        maxMemoryInMB=1024,
        # A pass goes on from the node a row reached, not from the root; the trees are the same.  What is lost is
        # computed again, no checkpoint is written.
        cacheNodeIds=True, checkpointInterval=-1,
    )
    # A copy has no training summary.  The summary holds the session, which is sent with the model's functions
    # and cannot be once anything in the session was observed.
    model = Pipeline(stages=[VectorAssembler(inputCols=CHURN_FEATURES, outputCol="features"), forest]).fit(train).copy()
    scored = model.transform(split.filter("is_test")).withColumn(
        "churn_probability", vector_to_array("probability")[1]
    )
    return model, scored


def churn_report(scored: DataFrame) -> DataFrame:
    scored = durable(scored.select("label", "prediction", "probability"), "scored")
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability").evaluate(scored)
    from sedimenta.plans.features import confusion

    return confusion(scored, "label", "prediction").withColumn("roc_auc", F.lit(float(auc)))


def churn_importance(model, spark) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(CHURN_FEATURES, map(float, values)), key=lambda r: -r[1])
    return spark.createDataFrame(rows, "feature string, importance double")


# --- isolation forest -------------------------------------------------------


def average_path(n):
    """Mean depth of an unsuccessful search in a tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def grow_tree(tree: int, x: np.ndarray, seed: int) -> list[tuple]:
    """Nodes of one tree over a sample; ``path`` is set in the leaves."""
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes, todo = [], [(0, np.arange(len(x)), 0)]
    free = 1
    while todo:
        node, rows, depth = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append((tree, node, -1, 0.0, -1, -1, depth + float(average_path(len(rows)))))
            continue
        f = int(rng.choice(usable))
        # Above the lowest value, so that both sides have rows.
        cut = float(max(rng.uniform(low[f], high[f]), np.nextafter(low[f], high[f])))
        below = x[rows, f] < cut
        nodes.append((tree, node, f, cut, free, free + 1, 0.0))
        todo += [(free, rows[below], depth + 1), (free + 1, rows[~below], depth + 1)]
        free += 2
    return nodes


def draw_samples(rows: DataFrame, key: str, columns: list[str], trees: int, size: int) -> DataFrame:
    """About ``size`` rows for every tree, chosen by the hash of the key.

    One hash per row picks a pool that holds enough rows for all trees; only
    the pool is compared with the trees.
    """
    n = rows.count()
    pool = rows.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    wanted = 4 * trees * size
    pool_rows = min(n, wanted)
    if n > wanted:
        pool = pool.filter(F.pmod(F.xxhash64(F.col(key), F.lit("pool")), F.lit(n)) < wanted)
    # Aim a fifth above the size and keep ``size`` rows per tree.  The limit
    # applies before the shuffle, so copies of a row cannot fill a task.
    take = int(size * 1.2)
    picked = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.pmod(F.xxhash64(F.col(key), t), F.lit(max(pool_rows, 1))) < take,
    )
    drawn = pool.withColumn("tree", F.explode(picked))
    return top_n_per_group(drawn, ["tree"], [F.xxhash64(key, "tree"), F.col(key)], size, "_r").drop("_r")


def fit_isolation_forest(
    rows: DataFrame, key: str, columns: list[str], trees: int = ISOLATION_TREES, size: int = SAMPLE_ROWS, seed: int = SEED
) -> pd.DataFrame:
    """Nodes of all trees.  Trees grow in parallel, each from its own sample;
    at most ``trees * 2 * size`` nodes reach the driver."""

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([key, *columns])
        nodes = grow_tree(int(part["tree"].iloc[0]), part[columns].to_numpy(), seed)
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])

    sample = draw_samples(rows, key, columns, trees, size)
    return sample.groupBy("tree").applyInPandas(grow, NODE).toPandas()


def _stacked(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """Trees as rows of arrays indexed by node number."""
    ids = sorted(nodes["tree"].unique())
    width = int(nodes["node"].max()) + 1
    out = {}
    for c in ("feature", "threshold", "left", "right", "path"):
        table = np.zeros((len(ids), width), dtype=float if c in ("threshold", "path") else np.int64)
        for i, t in enumerate(ids):
            part = nodes[nodes["tree"] == t]
            table[i, part["node"].to_numpy()] = part[c].to_numpy()
        out[c] = table
    return out


def isolation_score(nodes: pd.DataFrame, columns: list[str], size: int = SAMPLE_ROWS):
    """A vectorised column function: the higher, the more unusual the row."""
    forest = _stacked(nodes)
    norm = float(average_path(max(size, 2)))

    @F.pandas_udf("double")
    def score(*values: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(dtype=float) for v in values])
        row = np.arange(len(x))
        total = np.zeros(len(x))
        for t in range(len(forest["feature"])):
            feature, threshold = forest["feature"][t], forest["threshold"][t]
            left, right = forest["left"][t], forest["right"][t]
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                down = x[row, np.maximum(f, 0)] < threshold[at]
                at = np.where(inner, np.where(down, left[at], right[at]), at)
            total += forest["path"][t][at]
        return pd.Series(np.exp2(-(total / len(forest["feature"])) / norm))

    return score(*[F.col(c).cast("double") for c in columns])


def detect_anomalies(
    rows: DataFrame, key: str, columns: list[str], contamination: float = CONTAMINATION,
    trees: int = ISOLATION_TREES, size: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add ``anomaly_score`` and ``predicted_fraud``.

    The score is negative for the ``contamination`` share of most unusual
    rows; those are flagged.  Scores are written once and the percentile that
    separates the rows is taken from them.
    """
    rows = durable(rows, "features")
    nodes = fit_isolation_forest(rows, key, columns, trees, size)
    # A tree over fewer rows than its sample asks for is as deep as those rows make it.
    grown = min(size, rows.count())
    scored = durable(rows.withColumn("_s", -isolation_score(nodes, columns, grown)), "scores")
    offset = exact_percentiles(scored, [], "_s", {"cut": contamination}).first()["cut"]
    return scored.withColumn("anomaly_score", F.col("_s") - F.lit(offset)).withColumn(
        "predicted_fraud", (F.col("anomaly_score") < 0).cast("int")
    ).drop("_s")
