"""Models and their metrics.

* Splits are hash-based per key: stable under repartitioning and re-execution
  (``randomSplit`` is not), and the same hash is recomputable in SQL.
* The regressor (GBT) and classifier (random forest) are Spark ML estimators;
  training is distributed by Spark ML.  Tree models do not need scaling; the
  scaler operator (population sigma, like the reference) is still provided.
* Metrics are plain aggregates: regression metrics from exact means, confusion counts with ``count_if``, ROC-AUC as a rank sum with
  mid-ranks computed from per-score counts and distributed prefix sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.functions.numeric import exact_avg
from storefront.operators.boosting import BoostedTrees
from storefront.operators.kpis import model_status
from storefront.operators.rows import prefix_sum
from storefront.session import stored

# Model sizes and split parameters of the reference.
SEED = 42
TEST_PCT = 20
VALIDATION_PCT = 10
SALES_FEATURES = ["quantity", "discount_pct", "base_price", "rating", "delivery_delay",
                  "hour_of_day", "day_of_week", "month", "profit_margin"]
CHURN_FEATURES = ["lifetime_value", "total_orders", "avg_order_value", "recency",
                  "total_spent", "avg_rating_given", "return_rate", "customer_age_days"]
GBT_PARAMS = dict(maxIter=200, stepSize=0.1, maxDepth=5, subsamplingRate=0.9, validationTol=1e-4)
RF_PARAMS = dict(numTrees=200, maxDepth=10)
#: Trees between two checkpoints of the boosted errors.  Each writes a record for every row, so
#: they are few; without any, the lineage of the last tree would be as long as the ensemble.
CHECKPOINT_TREES = 50
#: Rows that are worth a task of their own in a fit of boosted trees or of a forest (all of whose trees
#: look at a row in one pass), and the most rows of one task.
BOOSTED_ROWS, FOREST_ROWS, MOST_ROWS = 100_000, 2_000, 4_000_000


def hash_bucket(key, seed: int = SEED, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the key (md5, SQL-recomputable)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(F.concat(k.cast("string"), F.lit(f"#{seed}"))), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def split_train(df: DataFrame, key: str, test_pct: int = TEST_PCT, seed: int = SEED) -> DataFrame:
    """M1: adds ``is_test`` (about test_pct % of keys); ``split_stratified`` splits classes exactly."""
    return df.withColumn("is_test", hash_bucket(key, seed) < test_pct)


def split_stratified(df: DataFrame, label: str, key: str, test_pct: int = TEST_PCT, seed: int = SEED,
                     buckets: int = 1024) -> DataFrame:
    """M2: adds ``is_test`` for exactly ``test_pct`` % of each class's rows (rounded half up).

    Rows are ordered by a hash of the key within their class.  Counts per class and
    hash bucket tell the bucket in which the cut falls; only that bucket's rows are
    ranked, so no class ever meets in one task.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"#{seed}"))))
    hashed = hashed.withColumn("_b", hash_bucket(key, seed, buckets)).fillna({"_b": 0})
    counts = hashed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label)
    placed = counts.select(
        F.col(label).alias("_label"), F.col("_b").alias("_bucket"),
        (F.sum("_n").over(w.orderBy("_b")) - F.col("_n")).alias("_before"),
        F.floor(F.sum("_n").over(w) * test_pct / 100 + 0.5).alias("_wanted"), "_n")
    joined = hashed.join(placed, hashed[label].eqNullSafe(placed["_label"]) & (hashed["_b"] == placed["_bucket"]))
    cut = (F.col("_before") < F.col("_wanted")) & (F.col("_before") + F.col("_n") > F.col("_wanted"))
    spread = F.when(cut, F.col("_b")).otherwise(-1 - F.pmod(F.xxhash64(key), F.lit(buckets)))
    rank = F.row_number().over(Window.partitionBy("_label", spread).orderBy("_h", key))
    test = F.when(cut, F.col("_before") + rank <= F.col("_wanted")).otherwise(F.col("_before") < F.col("_wanted"))
    return joined.withColumn("is_test", test).select(*df.columns, "is_test")


def split_counts(split: DataFrame, label: str) -> DataFrame:
    """Per class: rows in train and test (the stratification check)."""
    return (split.groupBy(label)
            .agg(F.count_if(~F.col("is_test")).alias("train_rows"),
                 F.count_if(F.col("is_test")).alias("test_rows")))


def standard_scale(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None,
                   suffix: str = "_scaled") -> DataFrame:
    """M3: (x - mean) / population sigma fitted on ``fit``; sigma 0 -> divisor 1."""
    fit = df if fit is None else fit
    stats = fit.select(F.struct(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                                *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)])).scalar()
    out = {}
    for i, c in enumerate(cols):
        m = stats.getField(f"m_{i}")
        s = stats.getField(f"s_{i}")
        out[c + suffix] = (F.col(c) - m) / F.when((s == 0) | s.isNull(), F.lit(1.0)).otherwise(s)
    return df.withColumns(out)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M9: balanced weights n / (k * n_class), joined back as a weight column."""
    nk = df.select(F.struct(F.count(F.lit(1)).alias("n"), F.countDistinct(label).alias("k"))).scalar()
    n, k = nk.getField("n"), nk.getField("k")
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    return (df.join(per, label)      # one row per class; adaptive execution decides how
            .withColumn(out, n.cast("double") / (k * F.col("_nc")))
            .drop("_nc"))


# ----------------------------------------------------------------- fitting ---
def spread(rows: DataFrame, worth: int) -> DataFrame:
    """The rows dealt evenly to the cluster's cores, ``worth`` rows to a task at least; few rows stay as they are.

    Each level of each tree is a pass that takes as long as its largest task, and stored rows
    come back in as many parts as they have files, of any size: small ones in a single part.
    """
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(n // worth, cores * math.ceil(n / (cores * MOST_ROWS)))
    return rows.repartition(tasks) if tasks > 1 else rows


def _fit_boosted(rows: DataFrame, features: Sequence[str], label: str, params: dict | None, **more) -> PipelineModel:
    """The boosted trees of the rows: few rows are fitted by Spark ML itself, others by ``BoostedTrees``."""
    dealt = spread(rows, BOOSTED_ROWS)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    gbt = (GBTRegressor if dealt is rows else BoostedTrees)(
        featuresCol="features", labelCol=label, seed=SEED, checkpointInterval=CHECKPOINT_TREES, **more, **(params or GBT_PARAMS))
    if dealt is not rows:
        gbt.inputs, gbt.undealt = list(features), rows
    return Pipeline(stages=[assembler, gbt]).fit(dealt)


def fit_sales_model(orders: DataFrame, features: Sequence[str] = SALES_FEATURES,
                    label: str = "order_value", key: str = "order_id",
                    params: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """M4: GBT regressor on the train split; returns (model, test rows).

    The rows are stored once with their split: the fit, the metrics and whoever scores the test rows read them.
    """
    rows = split_train(orders.where(F.col(label).isNotNull()), key).withColumn(
        "is_val", hash_bucket(key, SEED + 1) < VALIDATION_PCT)
    data = _sanitised(stored(rows, "sales-rows"), features)
    train = data.where(~F.col("is_test")).select(label, *features, "is_val")
    model = _fit_boosted(train, features, label, params, validationIndicatorCol="is_val")
    return model, data.where(F.col("is_test"))


def fit_churn_model(features_df: DataFrame, features: Sequence[str] = CHURN_FEATURES,
                    label: str = "churned", key: str = "customer_id",
                    params: dict | None = None) -> tuple[PipelineModel | None, DataFrame, float | None]:
    """Balanced random forest; with a single class no model is fitted and
    the constant class is returned instead (probability 1 or 0)."""
    data = stored(split_stratified(_sanitised(stored(features_df, "churn-rows"), features), label, key), "churn-split")
    train = data.where(~F.col("is_test"))
    classes = [r[0] for r in train.select(label).distinct().limit(2).collect()]
    if len(classes) < 2:
        const = float(classes[0]) if classes else 0.0
        return None, data.where(F.col("is_test")), const
    weighted = spread(class_weights(train, label).select(label, *features, "weight"), FOREST_ROWS)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=SEED,
                                **(params or RF_PARAMS))
    model = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), rf]).fit(weighted)
    return model, data.where(F.col("is_test")), None


def cross_val_r2(orders: DataFrame, features: Sequence[str] = SALES_FEATURES, label: str = "order_value",
                 key: str = "order_id", folds: int = 5, params: dict | None = None) -> DataFrame:
    """M6: k-fold R^2 of the regressor on the train split: (fold, r2) rows plus
    the mean and population standard deviation on every row.

    Folds are hash buckets of the key (stable under re-execution); each fold is
    one distributed GBT fit on the other folds.
    """
    rows = orders.where(F.col(label).isNotNull()).select(*dict.fromkeys([key, label, *features]))
    rows = split_train(rows, key).withColumn("_fold", hash_bucket(key, SEED + 2, folds))
    train = _sanitised(stored(rows, "fold-rows"), features).where(~F.col("is_test"))
    spark = orders.sparkSession
    rows = []
    for f in range(folds):
        model = _fit_boosted(train.where(F.col("_fold") != f).select(label, *features), features, label, params)
        m = regression_metrics(model.transform(train.where(F.col("_fold") == f)), label, "prediction")
        rows.append((f, m.select("r2").first()[0]))
    out = spark.createDataFrame(rows, "fold int, r2 double")
    stats = out.select(F.struct(F.avg("r2").alias("m"), F.stddev_pop("r2").alias("s"))).scalar()
    return out.select("fold", "r2", stats.getField("m").alias("mean_r2"), stats.getField("s").alias("std_r2"))


def _sanitised(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """F7 in plain expressions: inf/NaN -> NULL -> column median (approx-free exact) -> 0."""
    from storefront.operators.churn import impute_features
    return impute_features(df, features)


def score(model: PipelineModel | None, df: DataFrame, constant: float | None = None,
          out: str = "churn_probability") -> DataFrame:
    """Positive-class probability for every row (constant model -> 1 or 0)."""
    if model is None:
        return df.withColumn(out, F.lit(float(constant or 0.0))).withColumn("prediction", F.lit(float(constant or 0)))
    pred = model.transform(df)
    cols = [c for c in df.columns] + ["prediction"]
    if "probability" in pred.columns:
        return pred.select(*cols, vector_to_array("probability")[1].alias(out))
    return pred.select(*cols)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M7: (feature, importance) sorted descending."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double") \
                .orderBy(F.col("importance").desc(), F.col("feature").asc())


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ----------------------------------------------------------------- metrics ---
def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M5: MAE, RMSE, R^2 and the status grade from R^2 (M13); all NULL without rows."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    agg = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), exact_avg(F.abs(y - p)).alias("mae"),
        exact_avg((y - p) * (y - p)).alias("_mse"), F.var_pop(y).alias("_var"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_mse"), F.col("_var"))
    return agg.select("n", "mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"), model_status(r2).alias("status"))


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, precision, recall, F1 for class 1 (0 when undefined)."""
    y, p = F.col(label), F.col(pred)
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn")),
                    F.lit(0.0))
    return agg.select("n", "tp", "fp", "fn", "tn",
                      F.try_divide((F.col("tp") + F.col("tn")).cast("double"), F.col("n")).alias("accuracy"),
                      prec.alias("precision"), rec.alias("recall"), f1.alias("f1_score"))


def roc_auc(df: DataFrame, label: str, score_col: str) -> DataFrame:
    """ROC-AUC by the rank-sum formula with mid-ranks; NULL with one class.

    AUC = sum over scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N).
    Rows are first counted per distinct score (a hot score is one row), then the
    negatives below each score come from a distributed prefix sum.
    """
    per = (df.where(F.col(score_col).isNotNull())
           .groupBy(F.col(score_col).cast("double").alias("s"))
           .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    cum = prefix_sum(per, ["s"], "neg", "neg_below")
    agg = cum.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                  F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))).alias("_u"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_u") / (F.col("P") * F.col("N")))
    return agg.select(F.col("P").alias("positives"), F.col("N").alias("negatives"), auc.alias("roc_auc"),
                      model_status(auc).alias("status"))
