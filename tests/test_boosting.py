"""Boosted trees over packed rows (findings on time): the same trees as Spark ML's, in one pass for each level."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from storefront.operators import boosting, models


def _rows(spark, n=3000):
    df = spark.range(n).selectExpr("id AS order_id", "CAST(id % 7 AS double) AS a", "CAST(id * 31 % 11 AS double) AS b",
                                   "CAST(id * 17 % 23 AS int) AS c", "1.0D AS d", "id % 10 = 3 AS is_val")
    noise = F.pmod(F.xxhash64("order_id"), F.lit(1000)) / 250.0
    return df.withColumn("y", F.col("a") * F.col("b") + F.when(F.col("c") > 9, 20.0).otherwise(F.col("c")) + noise)


def _fitted(kind, df, **params):
    data = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    model = kind(labelCol="y", seed=42, stepSize=0.1, **params).fit(data)
    return model, np.array([r[0] for r in model.transform(data).orderBy("order_id").select("prediction").collect()])


@pytest.mark.parametrize("validate", [False, True])
def test_same_trees_as_spark_ml(spark, monkeypatch, validate):
    """All values have bins of their own and all rows are sampled, so nothing is left to chance."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 400)
    params = dict(maxIter=9, maxDepth=5, validationTol=1e-4, checkpointInterval=3)
    if validate:
        params |= dict(validationIndicatorCol="is_val", maxIter=40, maxDepth=3, validationTol=0.02)
    df = _rows(spark).repartition(3).cache()
    theirs, a = _fitted(GBTRegressor, df, **params)
    ours, b = _fitted(boosting.BoostedTrees, df, **params)
    assert ours.getNumTrees == theirs.getNumTrees and ours.treeWeights == theirs.treeWeights
    assert b == pytest.approx(a, abs=1e-6)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-6)
    assert not validate or 1 < ours.getNumTrees < 40
    node, other = ours.trees[1]._java_obj.rootNode(), theirs.trees[1]._java_obj.rootNode()
    assert node.impurity() == pytest.approx(other.impurity(), rel=1e-6)
    assert list(node.impurityStats().stats()) == pytest.approx(list(other.impurityStats().stats()), rel=1e-6, abs=1e-6)


def test_every_tree_samples_its_own_rows(spark):
    model, _ = _fitted(boosting.BoostedTrees, _rows(spark).repartition(3), maxIter=4, maxDepth=2, subsamplingRate=0.9)
    rows = [t._java_obj.rootNode().impurityStats().count() for t in model.trees]
    assert all(2600 < n < 2800 for n in rows) and len(set(rows)) > 1


def test_cuts_are_even_by_rank_over_all_rows(spark, monkeypatch):
    """Every row counts, whatever task and block it is in."""
    monkeypatch.setattr(boosting, "SUMMARY", 400)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 1000)
    n = 20_000
    rows = spark.range(n).repartition(3).selectExpr("array(id * id / 7.0D, CAST(id % 5 AS double)) AS x", "1.0D AS y", "false AS val")
    cuts = boosting.find_cuts(rows, 32)
    ranks = np.searchsorted(np.arange(n) ** 2 / 7.0, cuts[0])
    assert len(cuts[0]) == 31 and np.abs(ranks - n * np.arange(1, 32) / 32).max() < n * 0.03
    assert cuts[1].tolist() == [0.5, 1.5, 2.5, 3.5]


def test_many_rows_are_fitted_as_packed_rows(spark, monkeypatch):
    made = []
    monkeypatch.setattr(models, "BOOSTED_ROWS", 500)
    monkeypatch.setattr(models, "BoostedTrees", lambda **k: made.append(k) or boosting.BoostedTrees(**k))
    df = _rows(spark)
    model, test = models.fit_sales_model(df, ["a", "b", "c", "d"], "y", params=dict(maxIter=12, maxDepth=4, subsamplingRate=0.9))
    assert made and model.stages[-1].getNumTrees == 12
    assert models.regression_metrics(model.transform(test), "y", "prediction").first().r2 > 0.6
    with pytest.raises(Exception, match="labels and features must be numbers"):
        models._fit_boosted(df.withColumn("a", F.when(F.col("order_id") != 7, F.col("a"))), ["a", "b"], "y", dict(maxIter=2))
