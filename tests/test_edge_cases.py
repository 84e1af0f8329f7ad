"""Hand-made edge fixtures (FIXTURES.md section 3) for the reference's branches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from storefront.functions.dates import floor_days
from storefront.functions.numeric import clean_money
from storefront.operators import churn, clean, insights, mapping, models, quality, recommend, reports, split
from storefront.operators.rows import first_non_null

REF = "2024-12-01"


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_money_strings(spark):
    df = spark.createDataFrame([("₹1,299.50",), ("1-2",), ("",), (None,), ("$ 20",)], "s string")
    got = [r[0] for r in df.select(clean_money("s")).collect()]
    assert got == [1299.5, None, None, None, 20.0]


def test_discount_from_two_prices(spark):
    df = spark.createDataFrame([(0.0, 5.0), (None, 5.0), (10.0, 10.0), (10.0, None), (200.0, 150.0)],
                               "base_price double, price_after_discount double")
    got = [r.discount_pct for r in clean.discount_from_prices(df).collect()]
    assert got == [0.0, 0.0, 0.0, 0.0, 25.0]


@pytest.mark.parametrize("values,expected", [([0.8, 0.1], [80.0, 10.0]), ([1.0, 0.5], [1.0, 0.5]),
                                             ([20.0, 5.0], [20.0, 5.0])])
def test_discount_unit_detection(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "discount double")
    got = [r.discount_pct for r in clean.discount_rescale(df, "discount").collect()]
    assert got == pytest.approx(expected)


def test_all_prices_null_imputes_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "product_id string, base_price string")
    got = [r.base_price for r in clean.impute_price(df).collect()]
    assert got == [0.0, 0.0]


def test_price_median_impute(spark):
    df = spark.createDataFrame([("a", "₹10"), ("b", None), ("c", "30"), ("d", "20")],
                               "product_id string, base_price string")
    got = {r.product_id: r.base_price for r in clean.impute_price(df).collect()}
    assert got == {"a": 10.0, "b": 20.0, "c": 30.0, "d": 20.0}


def test_floor_days_semantics(spark):
    df = spark.createDataFrame([(_ts("2024-11-30 13:00:00"),), (_ts("2024-12-01 13:00:00"),),
                                (_ts("2024-06-04 00:00:00"),)], "ts timestamp")
    got = [r[0] for r in df.select(floor_days(REF, "ts")).collect()]
    assert got == [0, -1, 180]


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_date timestamp, "
                                       "order_value double, customer_rating int, is_returned int, "
                                       "discount_pct double")


def test_churn_threshold_and_no_orders(spark):
    cust = spark.createDataFrame([("c180", _ts("2020-01-01")), ("c181", _ts("2020-01-01")),
                                  ("none", _ts("2024-01-01"))], "customer_id string, signup_date timestamp")
    orders = _orders(spark, [("o1", "c180", _ts("2024-06-04"), 10.0, 5, 0, 0.0),
                             ("o2", "c181", _ts("2024-06-03"), 20.0, 3, 1, 10.0)])
    lab = {r.customer_id: r for r in churn.churn_labels(cust, orders, REF).collect()}
    assert lab["c180"].days_since_last_order == 180 and lab["c180"].churned == 0
    assert lab["c181"].days_since_last_order == 181 and lab["c181"].churned == 1
    assert lab["none"].days_since_last_order == 9999 and lab["none"].churned == 1
    feats = {r.customer_id: r for r in churn.customer_features(
        churn.churn_labels(cust, orders, REF), orders, REF).collect()}
    assert feats["none"].total_orders == 0 and feats["none"].total_spent == 0.0
    assert feats["none"].avg_rating_given == 0.0 and feats["none"].recency == 9999
    one_pass = churn.labelled_features(cust, orders, REF)
    assert {r.customer_id: {c: r[c] for c in feats["none"].asDict()} for r in one_pass.collect()} == {k: r.asDict() for k, r in feats.items()}


def test_zero_price_margin_is_null(spark):
    df = spark.createDataFrame([("p", 0.0, 10.0), ("p", 50.0, 10.0)],
                               "product_id string, price_after_discount double, base_price double")
    got = [r.profit_margin for r in clean.profit_margin(df).orderBy("price_after_discount").collect()]
    assert got[0] is None and got[1] == pytest.approx(88.0)


def test_single_class_guard(spark):
    df = spark.createDataFrame([(f"c{i}", 1, float(i)) for i in range(30)],
                               "customer_id string, churned int, lifetime_value double")
    model, test, const = models.fit_churn_model(df, ["lifetime_value"], params=dict(numTrees=3, maxDepth=2))
    assert model is None and const == 1.0
    scored = models.score(model, test, const)
    assert {r.churn_probability for r in scored.collect()} <= {1.0}
    auc = models.roc_auc(scored, "churned", "churn_probability").collect()[0]
    assert auc.roc_auc is None


def test_no_predicted_positive_precision_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "y int, p int")
    m = models.classification_metrics(df, "y", "p").collect()[0]
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1_score == 0.0
    assert m.accuracy == pytest.approx(1 / 3)


def test_roc_auc_with_ties_matches_brute_force(spark):
    import itertools
    data = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.2), (0, 0.5), (1, 0.7), (0, 0.1), (1, 0.2)]
    df = spark.createDataFrame(data, "y int, s double")
    got = models.roc_auc(df, "y", "s").collect()[0].roc_auc
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)) / (
        len(pos) * len(neg))
    assert got == pytest.approx(want)


def test_no_recent_orders_drops_revenue_insights(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "p1", _ts("2020-01-01"), 1.0, 10.0, 0.0, 3, 1, 0, 0, 4, "X", 4.0)],
        "order_id string, customer_id string, product_id string, order_date timestamp, quantity double, "
        "order_value double, discount_pct double, delivery_time_days int, delivery_delay int, "
        "failed_payment_attempts int, is_returned int, customer_rating int, category string, rating double")
    rev = insights.revenue_90_30(orders, REF).collect()[0]
    assert rev.orders_90 == 0 and rev.revenue_90 == 0.0
    assert insights.optimal_discount(orders, REF).count() == 0
    assert insights.payment_failures(orders).collect()[0].failed_orders == 0


def test_optimal_discount_tie_takes_lower(spark):
    orders = _orders(spark, [("o1", "c", _ts("2024-11-30"), 50.0, 5, 0, 10.0),
                             ("o2", "c", _ts("2024-11-30"), 50.0, 5, 0, 5.0)])
    assert insights.optimal_discount(orders, REF).collect()[0].discount_pct == 5.0


def test_modal_city_tie_smaller_name(spark):
    c = spark.createDataFrame([("1", "Pune", 1.0), ("2", "Agra", 3.0), ("3", "Pune", 2.0), ("4", "Agra", 2.0)],
                              "customer_id string, city string, lifetime_value double")
    r = insights.acquisition(c).collect()[0]
    assert r.top_city == "Agra" and r.avg_ltv == 2.0


def test_first_non_null_in_order(spark):
    df = spark.createDataFrame([("p", 1, None), ("p", 2, "B"), ("p", 3, "C")], "k string, o int, v string")
    assert df.groupBy("k").agg(first_non_null("v", "o").alias("f")).collect()[0].f == "B"


def test_orphans_count_null_keys(spark):
    orders = spark.createDataFrame([("c1",), ("c9",), (None,), ("c9",)], "customer_id string")
    cust = spark.createDataFrame([("c1",), (None,)], "customer_id string")
    r = quality.orphan_summary(orders, cust, "customer_id").collect()[0]
    assert r.orphans == 2 and r.orphan_ids == "c9"


def test_quality_ranges_and_nulls(spark):
    orders = spark.createDataFrame(
        [("o1", "c", "p", _ts("2024-01-01"), 0.0, -5.0)] + [("o", "c", "p", _ts("2024-01-02"), 1.0, 1.0)] * 8
        + [(None, None, "p", None, 2.0, 3.0)],
        "order_id string, customer_id string, product_id string, order_date timestamp, quantity double, "
        "order_value double")
    o = quality.dq_orders(orders).collect()[0]
    assert o.quantity_below_1 == 1 and o.negative_value == 1 and o.total_revenue == 6.0
    nulls = {r.column_name: r for r in quality.dq_nulls(orders, "orders").collect()}
    assert nulls["order_id"].nulls == 1 and not nulls["order_id"].high_nulls      # exactly 10 % is not > 10 %
    prods = spark.createDataFrame([("p", "x", 1.0, 0.0), ("q", "x", 2.0, 6.0), ("r", "x", 3.0, 5.0)],
                                  "product_id string, category string, base_price double, rating double")
    assert quality.dq_products(prods).collect()[0].rating_out_of_range == 2
    rep = quality.dq_report(orders, None, None)
    assert quality.dq_verdict(rep).collect()[0].valid is False


def test_recommend_unknown_and_identical_vectors(spark):
    p = spark.createDataFrame([(1, None, 100.0, 4.0), (2, None, 100.0, 4.0), (3, "A", 100.0, 4.0),
                               (4, "A", 5000.0, 2.0)],
                              "product_id int, category string, base_price double, rating double")
    assert recommend.recommend_similar(p, 99).count() == 0
    got = recommend.recommend_similar(p, 1, top_n=2).collect()
    assert got[0].product_id == 2 and got[0].similarity == pytest.approx(1.0)   # null category == null category
    assert all(r.product_id != 1 for r in got)


def test_recommend_matches_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    rows = [(i, ["A", "B", "C"][i % 3], float(rng.uniform(100, 2000)), float(rng.uniform(1, 5)))
            for i in range(60)]
    p = spark.createDataFrame(rows, "product_id int, category string, base_price double, rating double")
    cats = sorted({r[1] for r in rows})
    X = np.array([[np.log1p(r[2]), r[3]] + [1.0 if r[1] == c else 0.0 for c in cats] for r in rows])
    Xn = X / np.linalg.norm(X, axis=1, keepdims=True)
    sims = Xn @ Xn.T
    for src in (0, 7, 31):
        order = [j for j in np.argsort(-sims[src], kind="stable") if j != src][:5]
        got = [r.product_id for r in recommend.recommend_similar(p, src).orderBy("rank").collect()]
        assert got == order
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or "/tmp/storefront-test-checkpoints")
    batch = recommend.knn_products(p).persist()
    for src in range(60):
        order = [j for j in np.argsort(-sims[src], kind="stable") if j != src][:5]
        got = [r.product_id for r in batch.where(F.col("source_id") == src).orderBy("rank").collect()]
        assert got == order


@pytest.mark.parametrize("label,expected", [("x" * 40, "x" * 40), ("y" * 41, "y" * 37 + "...")])
def test_label_truncation(spark, label, expected):
    df = spark.createDataFrame([(label,)], "c string")
    assert reports.truncate_labels(df, "c").collect()[0].label == expected


def test_header_mapping():
    cols = ["Row ID", "ID", "", "Qty", "Ship Date", "Order Date", "Order ID", "Customer Name"]
    hits = mapping.resolve_columns(cols, mapping.ORDERS_ALIASES)
    assert hits["quantity"] == "Qty"
    assert hits["order_date"] == "Order Date"        # exact alias beats the earlier 'Ship Date'
    assert hits["ship_date"] == "Ship Date"
    assert hits["order_id"] == "Order ID"
    assert "" not in hits.values() and "ID" not in hits.values()
    hits2 = mapping.resolve_columns(["order_id", "Order ID"], mapping.ORDERS_ALIASES)
    assert hits2["order_id"] == "order_id"           # already standard: kept


def test_wide_split_first_non_null_and_defaults(spark):
    rows = [(1, "O1", "2024-01-01", "2024-01-04", "C1", "P1", None, 100.0, 0.1, "Pune"),
            (2, "O2", "2024-01-02", None, "C1", "P1", "Tech", 50.0, 0.2, "Agra"),
            (3, "O3", "2024-01-05", "2024-01-06", "C2", "P2", "Home", 30.0, 0.0, None)]
    df = spark.createDataFrame(rows, "`Row.ID` int, `Order ID` string, `Order Date` string, `Ship Date` string, "
                                     "`Customer ID` string, `Product ID` string, Category string, Sales double, "
                                     "Discount double, City string")
    o = {r.order_id: r for r in split.split_orders(df).collect()}
    assert o["O1"].delivery_time_days == 3 and o["O1"].delivery_delay == 1
    assert o["O2"].delivery_time_days == 3 and o["O1"].discount_pct == pytest.approx(10.0)
    p = {r.product_id: r for r in split.split_products(df, "Row.ID").collect()}
    assert p["P1"].category == "Tech" and p["P1"].base_price == 100.0 and p["P1"].rating == 4.0
    assert p["P1"].stock_quantity == 100 and p["P1"].manufacturing_cost == 50.0
    c = {r.customer_id: r for r in split.split_customers(df, "Row.ID").collect()}
    assert c["C1"].city == "Pune" and c["C1"].lifetime_value == 150.0
    assert c["C1"].signup_date == _ts("2024-01-01") and c["C2"].age_group == "Unknown"


def test_review_export_detection_and_enrichment(spark):
    from storefront.operators import reviews
    assert reviews.is_review_export(["product_id", "user_id", "rating"])
    assert not reviews.is_review_export(["order_id", "order_date", "user_id"])
    assert not reviews.is_review_export(["product_id", "category"])
    raw = spark.createDataFrame(
        [(1, "P1", "Lamp", "Home", "₹1,000", "₹800", "4.5", "U1", "Asha"),
         (2, "P1", "Lamp", "Home", "₹1,000", "₹900", "bad", "U2", "Ravi"),
         (3, "P2", "Pen", None, "₹0", "₹0", None, "U1", "Asha")],
        "ord int, product_id string, product_name string, category string, actual_price string, "
        "discounted_price string, rating string, user_id string, user_name string")
    orders = {r.order_id: r for r in reviews.reviews_to_orders(raw, "ord", REF).collect()}
    assert sorted(orders) == ["AMZ_O100000", "AMZ_O100001", "AMZ_O100002"]
    o0 = orders["AMZ_O100000"]
    assert o0.discount_pct == pytest.approx(20.0) and o0.customer_rating == 4.5 and o0.quantity == 1
    assert orders["AMZ_O100001"].customer_rating == 4.0          # unparseable rating -> 4
    assert orders["AMZ_O100002"].discount_pct == 0.0             # zero base price -> 0
    prods = reviews.reviews_products(raw, "ord")
    enriched = {r.order_id: r for r in reviews.enrich_review_orders(
        reviews.reviews_to_orders(raw, "ord", REF), prods).collect()}
    assert enriched["AMZ_O100000"].rating == 4.5 and enriched["AMZ_O100000"].category == "Home"
    assert enriched["AMZ_O100002"].rating == 4.0 and enriched["AMZ_O100002"].category is None
    cust = {r.customer_id: r for r in reviews.reviews_customers(raw, "ord", REF).collect()}
    assert set(cust) == {"U1", "U2"} and cust["U1"].user_name == "Asha" and cust["U1"].lifetime_value == 0.0
    lo, hi = _ts("2022-06-14"), _ts("2024-11-01")           # ref - [30, 900) days
    assert all(lo <= c.signup_date <= hi for c in cust.values())


def test_high_value_flag_is_strictly_above_quantile(spark):
    df = spark.createDataFrame([(str(i), float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 10])],
                               "customer_id string, lifetime_value double")
    flags = {r.customer_id: r.is_high_value for r in clean.high_value_flag(df).collect()}
    # 0.85 quantile of 1..10 = 8.65: only the values 9 and 10 (ids "8", "9") are above it
    assert sorted(k for k, v in flags.items() if v == 1) == ["8", "9"]


def test_observed_checks_leave_the_session_usable(spark):
    """The key that observes an ingest pass must not spoil the scoring of forests in the same session."""
    from storefront.plans import registry
    assert registry.queries()["dq_report_absent"](spark, "/root/testdata/sf0.001").count() == 22
    df = spark.range(40).selectExpr("CAST(id % 2 AS INT) AS churned", "CAST(id AS DOUBLE) AS x", "concat('c', id) AS customer_id")
    model, _, const = models.fit_churn_model(df, ["x"], params=dict(numTrees=2, maxDepth=2))
    assert models.score(model, df, const).where("churn_probability between 0 and 1").count() == 40
