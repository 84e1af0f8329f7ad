"""Registered queries for the recommender.

Similarities are compared rounded to 9 decimals: Spark's ``log1p`` and the SQL
engine's ``ln(1 + x)`` may differ in the last bit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from storefront.operators import recommend, vector_index
from storefront.operators.clean import np_round
from storefront.plans.catalog import NPROUND, register
from storefront.plans.derived import kept
from storefront.plans.views import with_views
from storefront.session import ensure_checkpoint_dir
from storefront.sources import testdata as td

_VEC = ("vec AS (SELECT product_id, category, base_price, rating, ln(1e0 + base_price) AS pl, "
        "COALESCE(rating, 4e0) AS rf, sqrt(ln(1e0 + base_price) * ln(1e0 + base_price) + "
        "COALESCE(rating, 4e0) * COALESCE(rating, 4e0) + 1e0) AS nm FROM products_c)")
_SIM = ("(s.pl * v.pl + s.rf * v.rf + CASE WHEN s.category IS NOT DISTINCT FROM v.category THEN 1e0 ELSE 0e0 END)"
        " / (s.nm * v.nm)")


@register("product_price", with_views(
    "SELECT p.product_id, p.category, "
    f"COALESCE({NPROUND('m.med', 6)}, 0e0) AS base_price FROM products_c p LEFT JOIN "
    "(SELECT product_id, median(base_price) AS med FROM orders_c WHERE product_id IS NOT NULL "
    "AND base_price IS NOT NULL GROUP BY product_id) m ON p.product_id = m.product_id"))
def _product_price(spark, d):
    bare = td.products(spark, d).select("product_id", "category")
    out = recommend.product_price(bare, td.orders(spark, d))
    return out.select("product_id", "category",
                      F.coalesce(np_round(F.nullif(F.col("base_price"), F.lit(0.0)), 6), F.lit(0.0))
                      .alias("base_price"))


@register("product_vectors", with_views(
    f"SELECT product_id, category, {NPROUND('pl', 9)} AS price_log, rf AS rating_f, {NPROUND('nm', 9)} AS norm "
    "FROM vec", _VEC))
def _product_vectors(spark, d):
    v = recommend.product_vectors(td.products(spark, d))
    return v.select("product_id", "category", np_round(F.col("price_log"), 9).alias("price_log"), "rating_f",
                    np_round(F.col("norm"), 9).alias("norm"))


@register("recommend_similar", with_views(
    f"SELECT product_id, category, base_price, rating, {NPROUND('sim', 9)} AS similarity, "
    "CAST(row_number() OVER (ORDER BY sim DESC, product_id) AS INTEGER) AS rank FROM ("
    f"SELECT v.*, {_SIM} AS sim FROM vec v, (SELECT * FROM vec WHERE product_id = "
    "(SELECT MIN(product_id) FROM products_c)) s WHERE v.product_id <> s.product_id "
    "ORDER BY sim DESC, v.product_id LIMIT 5) t", _VEC))
def _recommend_similar(spark, d):
    p = td.products(spark, d)
    first = p.select(F.min("product_id")).scalar()
    r = recommend.recommend_similar(p, first)
    return r.withColumn("similarity", np_round(F.col("similarity"), 9))


@register("knn_products", with_views(
    "SELECT source_id, CAST(rank AS INTEGER) AS rank, product_id, category, base_price, rating, "
    f"{NPROUND('sim', 9)} AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY sim DESC, "
    "product_id) AS rank FROM (SELECT s.product_id AS source_id, v.product_id, v.category, v.base_price, v.rating, "
    f"round({_SIM}, 12) AS sim FROM vec v JOIN vec s ON v.product_id <> s.product_id) p) t WHERE rank <= 5", _VEC))
def _knn_products(spark, d):
    ensure_checkpoint_dir(spark)
    r = recommend.knn_products(td.products(spark, d))
    return r.withColumn("similarity", np_round(F.col("similarity"), 9)).withColumn("rank", F.col("rank").cast("int"))


# a search takes as queries every row whose id is divisible by 20, against all rows
@register("knn_embeddings",
          "SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round_even(sim * 1e9, 0) / 1e9 AS similarity FROM ("
          "SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM ("
          "SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), "
          "CAST(q.embedding AS DOUBLE[])), 12) AS sim FROM embeddings e JOIN embeddings q ON e.vec_id <> q.vec_id "
          "AND q.vec_id % 20 = 0) p) t WHERE rank <= 5")
def _knn_embeddings(spark, d):
    e = td.table(spark, d, "embeddings")
    r = vector_index.exact_neighbours(e, "vec_id", "embedding", e.where(F.col("vec_id") % 20 == 0))
    return r.withColumn("similarity", np_round(F.col("similarity"), 9)).withColumn("rank", F.col("rank").cast("int"))


def _indexed(spark, d):
    ensure_checkpoint_dir(spark)
    e = td.table(spark, d, "embeddings").select("vec_id", "embedding")
    index = kept("vector_index", spark, d, ("embeddings",), lambda: vector_index.build_index(e, "vec_id", "embedding"))
    return e, vector_index.search(index, e.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding")


# the index's answers depend on the fitted cells: SQL states how many queries and neighbours there
# are and that the index reaches the wanted share of the exact ones
@register("knn_index")
def _knn_index(spark, d):
    return _indexed(spark, d)[1].withColumn("rank", F.col("rank").cast("int"))


@register("knn_index_recall",
          "SELECT COUNT(*) AS queries, CAST(SUM(LEAST(5, (SELECT COUNT(*) FROM embeddings) - 1)) AS BIGINT) AS neighbours, "
          "TRUE AS recall_is_090 FROM embeddings WHERE vec_id % 20 = 0")
def _knn_index_recall(spark, d):
    e, found = _indexed(spark, d)
    exact = vector_index.exact_neighbours(e, "vec_id", "embedding", e.where(F.col("vec_id") % 20 == 0))
    r = vector_index.recall_of(found, exact, "vec_id")
    return r.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("recall_is_090"))
