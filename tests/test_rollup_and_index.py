"""The rollup against the direct operators, and the vector index against exact search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from storefront.functions.numeric import exact_sum
from storefront.operators import churn, insights, kpis, reports, rollup, vector_index
from storefront.session import ensure_checkpoint_dir
from storefront.sources import testdata as td

SF = "/root/testdata/sf0.001"
REF = td.REF_DATE


def rows(df):
    cols = sorted(df.columns)

    def plain(v):
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted((tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def odd_orders(spark):
    """Order lines with nulls in every column, NaN values and repeated rows."""
    o = td.orders(spark, SF)
    h = F.pmod(F.xxhash64("order_id", "line_no"), F.lit(23))
    for i, c in enumerate(["order_date", "category", "discount_pct", "product_id", "delivery_delay", "is_returned", "customer_rating",
                           "delivery_time_days", "failed_payment_attempts", "rating", "quantity"]):
        o = o.withColumn(c, F.when(h == i, F.lit(None)).otherwise(F.col(c)))
    o = o.withColumn("order_value", F.when(h == 12, F.lit(float("nan"))).when(h == 13, F.lit(None)).otherwise(F.col("order_value")))
    return o.unionByName(o.where(h == 20)).checkpoint()


@pytest.fixture(scope="module")
def rolled(spark, odd_orders):
    return rollup.build(odd_orders)


def pairs(spark, o, r):
    p = td.products(spark, SF)
    labeled = churn.churn_labels(td.customers(spark, SF), o, REF)
    return {
        "revenue_90_30": (insights.revenue_90_30(o, REF), rollup.revenue_90_30(r, REF)),
        "top_category": (insights.top_category(o, REF), rollup.top_category(r, REF)),
        "discount_impact": (insights.discount_impact(o, REF), rollup.discount_impact(r, REF)),
        "optimal_discount": (insights.optimal_discount(o, REF), rollup.optimal_discount(r, REF)),
        "product_sales": (insights.product_sales(o, p, REF), rollup.product_sales(r, p, REF)),
        "top_products": (insights.top_products(o, p, REF), rollup.top_products(r, p, REF)),
        "worst_products": (insights.worst_products(o, p, REF), rollup.worst_products(r, p, REF)),
        "delivery_insight": (insights.delivery_insight(o), rollup.delivery_insight(r)),
        "delay_impact": (insights.delay_impact(o), rollup.delay_impact(r)),
        "payment_failures": (insights.payment_failures(o), rollup.payment_failures(r)),
        "return_rate": (insights.return_rate(o), rollup.return_rate(r)),
        "return_by_category": (insights.return_by_category(o), rollup.return_by_category(r)),
        "revenue_by_category": (reports.revenue_by_category(o), rollup.revenue_by_category(r)),
        "orders_by_weekday": (reports.orders_by_weekday(o), rollup.orders_by_weekday(r)),
        "daily_revenue": (reports.daily_revenue(o), rollup.daily_revenue(r)),
        "business_kpis": (kpis.business_kpis(o, labeled), rollup.business_kpis(r, labeled)),
        "insight_facts": (insights.insight_facts(o, REF), rollup.insight_facts(r, REF)),
    }


def test_rollup_gives_what_the_lines_give(spark, odd_orders, rolled):
    for name, (direct, rolled_up) in pairs(spark, odd_orders, rolled).items():
        assert sorted(direct.columns) == sorted(rolled_up.columns), name
        assert rows(direct) == rows(rolled_up), name


def test_windows_read_few_months(rolled):
    plan = rollup.recent(rolled.days, REF, 90)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("]")[0]
    with pytest.raises(ValueError):
        rollup.recent(rolled.days, "2001-08-02 13:00:00", 90)


def test_refresh_replaces_its_months_only(spark):
    o = td.orders(spark, SF).select("*", F.date_format("order_date", "yyyyMM").alias("m"))
    r = rollup.build(o.drop("m"))
    before = {x.month: x.s for x in r.days.groupBy("month").agg(F.sum("lines").alias("s")).collect()}
    changed = o.where("m = '199605'").drop("m")
    rollup.refresh(changed.unionByName(changed), r.path)
    again = rollup.open_rollup(spark, r.path)
    for table in (again.days, again.cells):
        after = {x.month: x.s for x in table.groupBy("month").agg(F.sum("lines").alias("s")).collect()}
        assert after == {m: s * (2 if m == 199605 else 1) for m, s in before.items()}
    assert math.isclose(again.days.agg(rollup.total("value").alias("v")).first().v,
                        o.agg(exact_sum("order_value").alias("v")).first().v + changed.agg(exact_sum("order_value").alias("v")).first().v)


def test_empty_rollup(spark):
    o = td.orders(spark, SF).where("order_id < 0")
    r = rollup.build(o)
    assert rows(rollup.return_rate(r)) == rows(insights.return_rate(o)) and rollup.daily_revenue(r).count() == 0
    assert rows(rollup.insight_facts(r, REF)) == rows(insights.insight_facts(o, REF))


# --- vectors -----------------------------------------------------------------------------------

def table(spark, pairs_):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in pairs_], "vec_id long, embedding array<double>, id string, cell int")


def plain_neighbours(pairs_, asked, k):
    width = max(len(v) for _, v in pairs_ if v)
    m = np.zeros((len(pairs_), width))
    for i, (_, v) in enumerate(pairs_):
        if v and np.isfinite(v).all():
            m[i, :len(v)] = v
    size = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.divide(m, size, out=np.zeros_like(m), where=size > 0)
    out = []
    for q, v in asked:
        at = next(i for i, p in enumerate(pairs_) if p == (q, v))
        sim = np.round(m @ m[at], 12)
        best = sorted((-s, p[0]) for s, p in zip(sim, pairs_, strict=True) if p[0] != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def answers(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.similarity) for r in df.collect())


@pytest.fixture(scope="module")
def hot_vectors():
    """A third of all rows are copies of one vector; some are null, zero, short or not finite."""
    rng = np.random.default_rng(4)
    out = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    out += [(1000 + i, [1.0] * 8) for i in range(150)]
    return out + [(2000, None), (2001, [0.0] * 8), (2002, [1.0, 2.0]), (2003, [float("inf")] * 8)]


def test_exact_neighbours(spark, hot_vectors, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK_ROWS", 37)
    monkeypatch.setattr(vector_index, "BLOCK_QUERIES", 11)
    df = table(spark, hot_vectors)
    got = answers(vector_index.exact_neighbours(df, "vec_id", "embedding", df.where("vec_id % 20 = 0"), 5))
    want = plain_neighbours(hot_vectors, [p for p in hot_vectors if p[0] % 20 == 0], 5)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-11)
    assert vector_index.exact_neighbours(df.where("vec_id < 0"), "vec_id", "embedding", df).count() == 0


def test_index_with_all_cells_is_exact_and_parts_are_small(spark, hot_vectors, monkeypatch):
    ensure_checkpoint_dir(spark)
    monkeypatch.setattr(vector_index, "PART_ROWS", 20)
    df = table(spark, hot_vectors)
    index = vector_index.build_index(df, "vec_id", "embedding", cells=9)
    assert index.parts.max() > 1
    assert index.blocks.agg(F.sum(F.size("ids"))).first()[0] == len(hot_vectors)  # every row is indexed
    assert index.blocks.groupBy("cell", "part").agg(F.sum(F.size("ids")).alias("n")).agg(F.max("n")).first()[0] < 45
    asked = df.where("vec_id % 20 = 0")
    whole = vector_index.search(index, asked, "vec_id", "embedding", probes=9)
    exact = vector_index.exact_neighbours(df, "vec_id", "embedding", asked).checkpoint()
    assert answers(whole) == answers(exact)
    some = vector_index.search(index, asked, "vec_id", "embedding")
    assert vector_index.recall_of(some, exact, "vec_id").first().recall >= 0.9


def test_odd_indexes(spark):
    ensure_checkpoint_dir(spark)
    one = table(spark, [(1, [1.0, 0.0]), (None, [1.0, 1.0])])
    index = vector_index.build_index(one, "vec_id", "embedding")
    assert vector_index.search(index, one, "vec_id", "embedding").count() == 0
    none = vector_index.build_index(one.where("vec_id > 5"), "vec_id", "embedding")
    assert vector_index.search(none, one, "vec_id", "embedding").count() == 0
    zero = table(spark, [(i, [0.0, 0.0]) for i in range(5)])
    assert vector_index.search(vector_index.build_index(zero, "vec_id", "embedding"), zero, "vec_id", "embedding", 2).count() == 10
