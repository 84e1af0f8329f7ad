"""Registered queries for splits, scaling, metrics and the models (M1-M13),
the insight document (I6, I19, I20), the dashboard cards (D8) and the KPI
document (K2-K4).

Metrics are oracle-checked on deterministic scores computed from the data
(``order_value`` vs list value, a recency score for churn), so the SQL and Spark
sides compute the same thing; the fitted models (GBT, random forest) are
checked on row counts only, since tree ensembles are not bit-equal across
libraries.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from storefront.operators import churn, clean, insights, kpis, models, reports, rollup
from storefront.operators.clean import np_round
from storefront.plans.catalog import (_FEATURES, _KPIS, _LABELS, CUT30, CUT90, IAVG, NPROUND, REF, XSUM, _features, _kpis, _r,
                                      register)
from storefront.plans.derived import kept
from storefront.plans.views import with_views
from storefront.session import ensure_checkpoint_dir, stored
from storefront.sources import testdata as td


_FIT_TABLES = ("lineitem", "orders", "part", "customer", "nation")


def HASH_SQL(key: str, seed: int = 42, buckets: int = 100) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '#{seed}'), 1, 8))::BIGINT % {buckets})"


def _o(spark, d):
    return td.orders(spark, d)


def _feature_rows(spark, d):
    """The customers' features, stored once for the given files: for queries that read them more than once."""
    return kept("features", spark, d, _FIT_TABLES, lambda: stored(_features(spark, d), "features"), lambda f: f.inputFiles()[0].rsplit("/", 1)[0])


# Deterministic churn score used to check the selection logic against SQL.
def _recency_score(df):
    return df.withColumn("churn_probability", F.least(F.lit(1.0), F.col("recency") / F.lit(360.0)))


SCORE_SQL = "LEAST(1e0, recency / 360e0)"

# ------------------------------------------------------------------ splits ---
register("split_train", with_views(
    f"SELECT customer_id, churned, {HASH_SQL('customer_id')} < 20 AS is_test FROM features", _FEATURES))(
    lambda spark, d: models.split_train(_features(spark, d).select("customer_id", "churned"), "customer_id"))

register("split_stratified", with_views(
    "SELECT churned, COUNT(*) - CAST(floor(COUNT(*) * 20 / 100e0 + 0.5e0) AS BIGINT) AS train_rows, "
    "CAST(floor(COUNT(*) * 20 / 100e0 + 0.5e0) AS BIGINT) AS test_rows FROM features GROUP BY churned", _FEATURES))(
    lambda spark, d: models.split_counts(models.split_stratified(_feature_rows(spark, d), "churned", "customer_id"), "churned"))

_SCALE = ("tr AS (SELECT * FROM features WHERE NOT ({h} < 20)), "
          "st AS (SELECT avg(total_spent) AS m1, stddev_pop(total_spent) AS s1, "
          "avg(recency) AS m2, stddev_pop(recency) AS s2 FROM tr)").format(h=HASH_SQL("customer_id"))


@register("standard_scale", with_views(
    f"SELECT customer_id, {NPROUND('(total_spent - m1) / CASE WHEN s1 = 0 OR s1 IS NULL THEN 1e0 ELSE s1 END', 6)}"
    f" AS total_spent_scaled, {NPROUND('(recency - m2) / CASE WHEN s2 = 0 OR s2 IS NULL THEN 1e0 ELSE s2 END', 6)}"
    " AS recency_scaled FROM features, st", _FEATURES + ", " + _SCALE))
def _standard_scale(spark, d):
    f = models.split_train(_feature_rows(spark, d), "customer_id")
    out = models.standard_scale(f, ["total_spent", "recency"], fit=f.where(~F.col("is_test")))
    return out.select("customer_id", np_round(F.col("total_spent_scaled"), 6).alias("total_spent_scaled"),
                      np_round(F.col("recency_scaled"), 6).alias("recency_scaled"))


register("class_weights", with_views(
    "SELECT customer_id, churned, CAST((SELECT COUNT(*) FROM features) AS DOUBLE) / "
    "((SELECT COUNT(DISTINCT churned) FROM features) * COUNT(*) OVER (PARTITION BY churned)) AS weight "
    "FROM features", _FEATURES))(
    lambda spark, d: models.class_weights(_feature_rows(spark, d).select("customer_id", "churned"), "churned"))

# ----------------------------------------------------------------- metrics ---
_REG = ("ra AS (SELECT COUNT(*) AS n, fsum(abs(order_value - base_price * quantity)) AS sae, "
        "fsum(pow(order_value - base_price * quantity, 2)) AS sse, var_pop(order_value) * COUNT(*) AS sst "
        "FROM orders_c WHERE order_value IS NOT NULL AND base_price * quantity IS NOT NULL)")


def _grade(x: str) -> str:
    return f"CASE WHEN {x} > 0.85 THEN 'Excellent' WHEN {x} > 0.70 THEN 'Good' ELSE 'Fair' END"


_R2 = "(1e0 - sse / sst)"

register("regression_metrics", with_views(
    f"SELECT n, {NPROUND('sae / n', 6)} AS mae, {NPROUND('sqrt(sse / n)', 6)} AS rmse, {NPROUND(_R2, 9)} AS r2, "
    f"{_grade(_R2)} AS status FROM ra", _REG))(
    lambda spark, d: _REG_METRICS(spark, d).select(
        "n", *[np_round(F.col(c), n).alias(c) for c, n in (("mae", 6), ("rmse", 6), ("r2", 9))], "status"))

_CLS = (_FEATURES + ", cls AS (SELECT churned AS y, CASE WHEN " + SCORE_SQL + " > 0.5 THEN 1 ELSE 0 END AS p, "
        + SCORE_SQL + " AS s FROM features)")


@register("classification_metrics", with_views(
    "SELECT n, tp, fp, fn, tn, CAST(tp + tn AS DOUBLE) / n AS accuracy, "
    "COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0e0) AS precision, "
    "COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0e0) AS recall, "
    "COALESCE(2e0 * tp / NULLIF(2 * tp + fp + fn, 0), 0e0) AS f1_score FROM ("
    "SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE y = 0 AND p = 1) "
    "AS fp, COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS fn, COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM cls) t",
    _CLS))
def _classification_metrics(spark, d):
    s = _recency_score(_features(spark, d))
    s = s.withColumn("pred", F.when(F.col("churn_probability") > 0.5, 1).otherwise(0))
    return models.classification_metrics(s, "churned", "pred")


_AUC = (_CLS + ", per AS (SELECT s, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y = 0) AS neg "
        "FROM cls WHERE s IS NOT NULL GROUP BY s), cum AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM per), "
        "au AS (SELECT SUM(pos) AS P, SUM(neg) AS N, SUM(pos * (neg_below + neg / 2e0)) AS u FROM cum)")
_AUC_X = "CASE WHEN P > 0 AND N > 0 THEN u / (P * N) END"


@register("roc_auc", with_views(
    f"SELECT CAST(P AS BIGINT) AS positives, CAST(N AS BIGINT) AS negatives, {_AUC_X} AS roc_auc, "
    f"{_grade(_AUC_X)} AS status FROM au", _AUC))
def _roc_auc(spark, d):
    return models.roc_auc(_recency_score(_feature_rows(spark, d)), "churned", "churn_probability")


@register("model_status", with_views(
    f"SELECT {_grade(_R2)} AS sales_status, (SELECT {_grade(_AUC_X)} FROM au) AS churn_status FROM ra",
    _REG + ", " + _AUC.replace("WITH ", "")))
def _model_status(spark, d):
    reg = _REG_METRICS(spark, d)
    auc = _roc_auc(spark, d)
    return reg.select(F.col("status").alias("sales_status"), auc.select("status").scalar().alias("churn_status"))


def _REG_METRICS(spark, d):
    return models.regression_metrics(
        _o(spark, d).withColumn("list_value", F.col("base_price") * F.col("quantity")), "order_value", "list_value")


# ------------------------------------------------- insights on the scores ----
register("high_risk", with_views(
    f"SELECT customer_id, total_orders, total_spent, {SCORE_SQL} AS churn_probability FROM features "
    f"WHERE {SCORE_SQL} > 0.7 AND total_orders > 0 ORDER BY total_spent DESC, customer_id LIMIT 10", _FEATURES))(
    lambda spark, d: insights.high_risk(_recency_score(_features(spark, d))).select(
        "customer_id", "total_orders", "total_spent", "churn_probability"))

register("high_risk_summary", with_views(
    f"SELECT COUNT(*) AS at_risk_customers, COALESCE({XSUM('total_spent')}, 0e0) AS at_risk_value, "
    f"COALESCE({XSUM('total_spent')}, 0e0) * 0.3e0 AS estimated_save FROM (SELECT * FROM features "
    f"WHERE {SCORE_SQL} > 0.7 AND total_orders > 0 ORDER BY total_spent DESC, customer_id LIMIT 10) t", _FEATURES))(
    lambda spark, d: insights.high_risk_summary(_recency_score(_features(spark, d))))

register("churn_alert", with_views(
    f"SELECT {NPROUND(f'avg({SCORE_SQL})', 9)} AS avg_churn_probability, 'High' AS severity FROM features "
    f"HAVING avg({SCORE_SQL}) > 0.3", _FEATURES))(
    lambda spark, d: insights.churn_alert(_recency_score(_features(spark, d))).select(
        np_round(F.col("avg_churn_probability"), 9).alias("avg_churn_probability"), "severity"))


# ------------------------------------------------------------ fitted models --
def _sales_rows(spark, d):
    rows = clean.date_parts(clean.profit_margin(_o(spark, d), td.products(spark, d)))
    return rows.select("order_id", "order_value", *models.SALES_FEATURES)


def _sales_fit(spark, d):
    return kept("sales", spark, d, _FIT_TABLES, lambda: models.fit_sales_model(_sales_rows(spark, d)))


def _churn_fit(spark, d):
    return kept("churn", spark, d, _FIT_TABLES, lambda: models.fit_churn_model(_feature_rows(spark, d)))


@register("sales_model")
def _sales_model(spark, d):
    model, test = _sales_fit(spark, d)
    pred = model.transform(test)
    return models.regression_metrics(pred, "order_value", "prediction")


@register("feature_importance")
def _feature_importance(spark, d):
    model, _ = _sales_fit(spark, d)
    return models.feature_importance(model, models.SALES_FEATURES)


@register("churn_model")
def _churn_model(spark, d):
    model, test, const = _churn_fit(spark, d)
    scored = models.score(model, test, const)
    m = models.classification_metrics(scored, "churned", "prediction")
    auc = models.roc_auc(scored, "churned", "churn_probability")
    return m.select("*", auc.select("roc_auc").scalar().alias("roc_auc"))


@register("score_customers")
def _score_customers(spark, d):
    return _scored(spark, d).select("customer_id", "churned", "churn_probability", "prediction")


_TEST_ROWS = "SUM(floor(n * 20 / 100e0 + 0.5e0))"
_FACTS = {
    "sales_test_rows": f"(SELECT COUNT(*) FROM orders_c WHERE order_value IS NOT NULL AND {HASH_SQL('order_id')} < 20)",
    "churn_test_rows": f"(SELECT {_TEST_ROWS} FROM (SELECT COUNT(*) AS n FROM features GROUP BY churned) t)",
    "scored_customers": "(SELECT COUNT(*) FROM features)",
    "one_class_test_rows": f"(SELECT {_TEST_ROWS} FROM (SELECT COUNT(*) AS n FROM features) t)",
    "sales_features": len(models.SALES_FEATURES), "churn_features": len(models.CHURN_FEATURES),
    "sales_importance_sum": 1, "churn_importance_sum": 1, "probabilities_outside_0_1": 0, "scores_changed_by_reload": 0,
    "one_class_scores_other_than_1": 0, "folds": 2, "folds_without_r2": 0, "sales_r2_not_above_0": 0}


@register("model_facts", with_views(" UNION ALL ".join(
    f"SELECT '{name}' AS fact, CAST({value} AS DOUBLE) AS value" for name, value in _FACTS.items()), _FEATURES))
def _model_facts(spark, d):
    """Numbers that follow from the tables or must hold of the fitted models, whatever the library."""
    sales, test = _sales_fit(spark, d)
    churn_model, churn_test, const = _churn_fit(spark, d)
    feats = models._sanitised(_feature_rows(spark, d), models.CHURN_FEATURES)
    scored = models.score(churn_model, feats, const)
    path = f"{ensure_checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    models.save_model(churn_model, path)
    again = models.score(models.load_model(path), feats, const)
    none, rest, constant = models.fit_churn_model(feats.withColumn("churned", F.lit(1)))
    one = models.score(none, rest, constant)
    folds = models.cross_val_r2(_sales_rows(spark, d), folds=2, params=dict(maxIter=3, maxDepth=3))
    r2 = models.regression_metrics(sales.transform(test), "order_value", "prediction")
    changed = scored.select("customer_id", "churn_probability").exceptAll(again.select("customer_id", "churn_probability"))
    rows = F.count(F.lit(1))
    probability = F.col("churn_probability")

    def importance(model, names, kind):
        imp = models.feature_importance(model, names)
        return imp.agg(rows.alias(f"{kind}_features"), F.round(F.sum("importance"), 6).alias(f"{kind}_importance_sum"))

    parts = [r2.select(F.col("n").alias("sales_test_rows"), F.when(F.col("r2") > 0, 0).otherwise(1).alias("sales_r2_not_above_0")),
             churn_test.agg(rows.alias("churn_test_rows")),
             scored.agg(F.count(probability).alias("scored_customers"),
                        F.count_if(~probability.between(0, 1)).alias("probabilities_outside_0_1")),
             changed.agg(rows.alias("scores_changed_by_reload")),
             one.agg(rows.alias("one_class_test_rows"), F.count_if(probability != 1.0).alias("one_class_scores_other_than_1")),
             importance(sales, models.SALES_FEATURES, "sales"), importance(churn_model, models.CHURN_FEATURES, "churn"),
             folds.agg(rows.alias("folds"), F.count_if(F.col("r2").isNull()).alias("folds_without_r2"))]
    long = [p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("fact"), F.col(c).cast("double").alias("value")) for c in p.columns])).alias("f"))
            .select("f.*") for p in parts]
    return reduce(lambda x, y: x.unionByName(y), long)


@register("feature_importance_churn")
def _feature_importance_churn(spark, d):
    return models.feature_importance(_churn_fit(spark, d)[0], models.CHURN_FEATURES)


# -------------------------------------------------------------- documents ----
# importances that both sides of ``kpi_document`` know: that key checks the document's shape and its
# business and metric blocks on stand-in scores; the other documents show the fitted models
_GIVEN = {"sales": [("base_price", 0.5), ("quantity", 0.25), ("month", 0.125), ("rating", 0.0625), ("discount_pct", 0.046875),
                    ("delivery_delay", 0.015625)],
          "churn": [("recency", 0.625), ("total_orders", 0.25), ("total_spent", 0.125)]}


def _given(spark, kind):
    return spark.createDataFrame(_GIVEN[kind], "feature string, importance double")


def _scored(spark, d):
    """All customers with the fitted model's churn probability, stored once."""
    def make():
        model, _, const = _churn_fit(spark, d)
        return stored(models.score(model, models._sanitised(_feature_rows(spark, d), models.CHURN_FEATURES), const), "scored")
    return kept("scored", spark, d, _FIT_TABLES, make)


def _insights_doc(spark, d):
    """The insight document with the fitted models' churn probabilities and most important features, stored once."""
    def make():
        ensure_checkpoint_dir(spark)
        o, p, c = _o(spark, d), td.products(spark, d), td.customers(spark, d)
        return insights.insights(o, p, _scored(spark, d), c, REF, _feature_importance(spark, d),
                                 rollup.insight_facts(_r(spark, d), REF, _o(spark, d))).checkpoint()
    return kept("insights", spark, d, _FIT_TABLES, make)


@register("insights")
def _insights(spark, d):
    return _insights_doc(spark, d)


@register("insight_cards")
def _insight_cards(spark, d):
    return reports.insight_cards(_insights_doc(spark, d))


@register("kpi_json")
def _kpi_json(spark, d):
    """The KPI document of the fitted models: metrics on their test rows and their importances."""
    doc = kpis.kpi_document(_kpis(spark, d), _sales_model(spark, d), _churn_model(spark, d), _feature_importance(spark, d),
                            _feature_importance_churn(spark, d), with_timestamp=False)
    return doc.select(F.to_json(F.struct(*doc.columns)).alias("kpi_json"))


def _kpi_doc(spark, d):
    scored = _recency_score(_feature_rows(spark, d)).withColumn("p", (F.col("churn_probability") > 0.5).cast("int"))
    auc = models.roc_auc(scored, "churned", "churn_probability").select("roc_auc").scalar()
    clf = models.classification_metrics(scored, "churned", "p").withColumn("roc_auc", auc)
    return kpis.kpi_document(_kpis(spark, d), _REG_METRICS(spark, d), clf, _given(spark, "sales"), _given(spark, "churn"),
                             with_timestamp=False)


def _features_text(kind: str, n: int = kpis.TOP_FEATURES) -> str:
    return "'" + ", ".join(f"{f}={v!r}" for f, v in _GIVEN[kind][:n]) + "'"


@register("kpi_document", with_views(
    f"SELECT total_orders, {NPROUND('total_revenue', 5)} AS total_revenue, total_customers, "
    f"{NPROUND('customer_churn_rate', 9)} AS churn_rate, {NPROUND('sae / n', 6)} AS mae, {NPROUND('sqrt(sse / n)', 6)} AS rmse, "
    f"{NPROUND(_R2, 9)} AS r2_score, {_grade(_R2)} AS sales_status, {NPROUND('accuracy', 9)} AS accuracy, "
    f"{NPROUND('auc', 9)} AS roc_auc, {_grade('auc')} AS churn_status, {_features_text('sales')} AS top_sales, "
    f"{_features_text('churn')} AS top_churn FROM kpis, ra, "
    "(SELECT CAST(COUNT(*) FILTER (WHERE y = p) AS DOUBLE) / COUNT(*) AS accuracy FROM cls) a, "
    "(SELECT (SUM(CASE WHEN y = 1 THEN r END) - SUM(y) * (SUM(y) + 1) / 2e0) / (SUM(y) * (COUNT(*) - SUM(y))) AS auc FROM "
    "(SELECT y, rank() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2e0 AS r FROM cls) q) u",
    _CLS + _KPIS.replace(_LABELS, "") + ", " + _REG))
def _kpi_document(spark, d):
    doc = _kpi_doc(spark, d)
    sales, churned = F.col("model_performance.sales_prediction"), F.col("model_performance.churn_prediction")

    def text(c):
        return F.array_join(F.transform(c, lambda x: F.concat(x["feature"], F.lit("="), x["importance"].cast("string"))), ", ")

    return doc.select(
        "business_kpis.total_orders", np_round(F.col("business_kpis.total_revenue"), 5).alias("total_revenue"),
        "business_kpis.total_customers", np_round(F.col("business_kpis.customer_churn_rate"), 9).alias("churn_rate"),
        np_round(sales["mae"], 6).alias("mae"), np_round(sales["rmse"], 6).alias("rmse"),
        np_round(sales["r2_score"], 9).alias("r2_score"), sales["status"].alias("sales_status"),
        np_round(churned["accuracy"], 9).alias("accuracy"), np_round(churned["roc_auc"], 9).alias("roc_auc"),
        churned["status"].alias("churn_status"), text(F.col("top_features_sales")).alias("top_sales"),
        text(F.col("top_features_churn")).alias("top_churn"))


@register("report_sections")
def _report_sections(spark, d):
    return reports.insight_cards(_insights_doc(spark, d), reports.REPORT_LIMITS)


@register("top_features")
def _top_features(spark, d):
    model, _ = _sales_fit(spark, d)
    imp = models.feature_importance(model, models.SALES_FEATURES)
    return imp.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(kpis.TOP_FEATURES)


_IMPUTE_COLS = ["lifetime_value", "total_orders", "avg_order_value", "recency", "total_spent",
                "avg_rating_given", "return_rate", "customer_age_days"]


@register("impute_features", with_views(
    "SELECT customer_id, " + ", ".join(
        f"{NPROUND(f'COALESCE(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM features), 0e0)', 9)} AS {c}"
        for c in _IMPUTE_COLS) + " FROM features", _FEATURES))
def _impute_features(spark, d):
    f = churn.impute_features(_feature_rows(spark, d), _IMPUTE_COLS)
    return f.select("customer_id", *[np_round(F.col(c), 9).alias(c) for c in _IMPUTE_COLS])


@register("fill_order_nulls", with_views(
    "SELECT order_id, line_no, product_id, COALESCE(quantity, 1e0) AS quantity, "
    "COALESCE(discount_pct, 0e0) AS discount_pct FROM orders_c"))
def _fill_order_nulls(spark, d):
    o = _o(spark, d).select("order_id", "line_no", "product_id", "quantity", "discount_pct")
    return clean.fill_order_nulls(o)


_LATE = "delivery_delay > 2"
_FAIL = "failed_payment_attempts > 0"
_R90 = f"order_date >= {CUT90}"
_R30 = f"order_date >= {CUT30}"


@register("insight_facts", with_views(
    "SELECT COALESCE(category, CAST(discount_pct AS VARCHAR), CAST(product_id AS VARCHAR)) AS key, "
    f"COUNT(*) FILTER (WHERE {_R90}) AS orders_90, "
    f"COALESCE({XSUM(f'CASE WHEN {_R90} THEN order_value END')}, 0e0) AS revenue_90, "
    f"COUNT(*) FILTER (WHERE {_R30}) AS orders_30, "
    f"COALESCE({XSUM(f'CASE WHEN {_R30} THEN order_value END')}, 0e0) AS revenue_30, "
    f"COALESCE(SUM(CASE WHEN {_R90} THEN quantity END), 0e0) AS units_90, "
    f"COALESCE({XSUM(f'CASE WHEN {_R90} THEN rating END')}, 0e0) AS _rating_sum_90, "
    f"COUNT(CASE WHEN {_R90} THEN rating END) AS _rating_n_90, COUNT(*) AS orders, "
    "CAST(COALESCE(SUM(is_returned), 0) AS BIGINT) AS _ret_sum, COUNT(is_returned) AS _ret_n, "
    "CAST(COALESCE(SUM(delivery_time_days), 0) AS BIGINT) AS _del_sum, COUNT(delivery_time_days) AS _del_n, "
    f"COUNT(*) FILTER (WHERE {_LATE}) AS delayed_orders, "
    f"CAST(COALESCE(SUM(CASE WHEN {_LATE} THEN delivery_delay END), 0) AS BIGINT) AS _late_delay_sum, "
    f"COUNT(CASE WHEN {_LATE} THEN delivery_delay END) AS _late_delay_n, "
    f"CAST(COALESCE(SUM(CASE WHEN {_LATE} THEN is_returned END), 0) AS BIGINT) AS _late_ret_sum, "
    f"COUNT(CASE WHEN {_LATE} THEN is_returned END) AS _late_ret_n, "
    f"COUNT(*) FILTER (WHERE {_FAIL}) AS failed_orders, "
    f"COALESCE({XSUM(f'CASE WHEN {_FAIL} THEN order_value END')}, 0e0) AS value_at_stake, "
    "CASE GROUPING(category, discount_pct, product_id) WHEN 3 THEN 'category' WHEN 5 THEN 'discount_pct' "
    "WHEN 6 THEN 'product_id' ELSE 'all' END AS level FROM orders_c "
    "GROUP BY GROUPING SETS ((category), (discount_pct), (product_id), ())"))
def _insight_facts(spark, d):
    f = rollup.insight_facts(_r(spark, d), REF, _o(spark, d))
    key = F.coalesce(F.col("category"), F.col("discount_pct").cast("string"), F.col("product_id").cast("string"))
    return f.select("level", key.alias("key"), *[c for c in f.columns
                                                 if c not in ("level", "category", "discount_pct", "product_id")])
