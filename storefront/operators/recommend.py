"""Similar-product recommendations.

The product vector is [log1p(price), rating, one-hot(category)].  Its cosine
similarity has a closed form, so no vector column or UDF is needed:

    dot(a, b) = pa*pb + ra*rb + [cat_a <=> cat_b]      |a|^2 = pa^2 + ra^2 + 1

``recommend_similar`` answers one product in one pass over the catalog.
``knn_products`` answers every product of the catalog (R3, R5): unit vectors are
dealt to square cells of their first two coordinates, products meet only those of
their own and the eight cells around it, and an answer stands when its last
neighbour is nearer than a cell is wide, since all products outside are farther.
So are all products of other categories while cells are narrow; until then only
one category's products meet.  The first cells are wide enough to hold some points
each; what is still open goes on to cells twice as wide.  Products with equal
vectors are one point, so a popular vector is not compared with itself.
Embedding vectors are searched by ``vector_index``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.functions.numeric import clean_money
from storefront.operators.stats import group_median

# Neighbourhood size of the reference and the default rating.
TOP_N = 5
DEFAULT_RATING = 4.0
# Similarities are rounded to 12 decimals: what differs by less than this is no reason to stop,
# and cells so narrow that they differ by no more tell nothing.
SLACK = 1e-11
LEAST_WIDTH = 1e-5


def product_price(products: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """base_price, else cleaned actual_price, else cleaned discounted_price,
    else the median base_price of the product's order lines, else 0."""
    cols = products.columns
    if "base_price" in cols:
        price = F.col("base_price").cast("double")
        out = products
    elif "actual_price" in cols:
        price, out = clean_money("actual_price"), products
    elif "discounted_price" in cols:
        price, out = clean_money("discounted_price"), products
    elif orders is not None and "base_price" in orders.columns:
        med = group_median(orders.where(F.col("product_id").isNotNull()), "product_id", "base_price", "_med")
        out = products.join(med, "product_id", "left")
        price = F.col("_med")
    else:
        price, out = F.lit(None).cast("double"), products
    res = out.withColumn("base_price", F.coalesce(price, F.lit(0.0)))
    return res.drop("_med") if "_med" in res.columns else res


def product_vectors(products: DataFrame) -> DataFrame:
    """R2: the vector parts: price_log, rating (NULL -> 4), category, and |v|."""
    pl = F.coalesce(F.log1p(F.col("base_price").cast("double")), F.lit(0.0))
    r = F.coalesce(F.col("rating").cast("double"), F.lit(DEFAULT_RATING))
    return (products.withColumn("price_log", pl).withColumn("rating_f", r)
            .withColumn("norm", F.sqrt(F.col("price_log") ** 2 + F.col("rating_f") ** 2 + F.lit(1.0))))


def cosine(src_p: Column, src_r: Column, src_c: Column, src_n: Column,
           p: Column, r: Column, c: Column, n: Column) -> Column:
    same = F.when(src_c.eqNullSafe(c), F.lit(1.0)).otherwise(F.lit(0.0))
    return (src_p * p + src_r * r + same) / (src_n * n)


def recommend_similar(products: DataFrame, product_id, top_n: int = TOP_N) -> DataFrame:
    """The top_n most similar products to one product (self excluded).

    The source's vector parts are scalar subqueries; every product is scored in
    one pass and a bounded top-k (``TakeOrderedAndProject``) keeps n rows.  An
    unknown product id gives an empty result.
    """
    vec = product_vectors(product_price(products))
    src = vec.where(F.col("product_id") == F.lit(product_id))
    one = src.select(F.struct(F.count(F.lit(1)).alias("k"), *[F.first(c).alias(c) for c in
                                                            ("price_log", "rating_f", "category", "norm")])).scalar()
    sp, sr, sc, sn = (one.getField(c) for c in ("price_log", "rating_f", "category", "norm"))
    known = one.getField("k") > 0
    sim = cosine(sp, sr, sc, sn, F.col("price_log"), F.col("rating_f"), F.col("category"), F.col("norm"))
    scored = (vec.where(known & (F.col("product_id") != F.lit(product_id)))
              .withColumn("similarity", sim))
    top = scored.orderBy(F.col("similarity").desc(), F.col("product_id").asc()).limit(top_n)
    return top.select("product_id", "category", "base_price", "rating", "similarity",
                      F.row_number().over(Window.orderBy(F.col("similarity").desc(), F.col("product_id").asc()))
                      .alias("rank"))


def knn_products(products: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """The top_n most similar products of every product (itself excluded), exactly.

    Equal similarities are ordered by product id.  Similarities are rounded to 12
    decimals before they are ordered, so that the last bits of equal vectors don't
    decide.
    """
    vec = product_vectors(product_price(products)).where(F.col("product_id").isNotNull())
    key = [F.col(c) for c in ("price_log", "rating_f", "category")]
    named = vec.withColumn("_vector", F.xxhash64(*key))
    nth = F.row_number().over(Window.partitionBy("_vector").orderBy("product_id"))
    members = (named.withColumn("_nth", nth).where(F.col("_nth") <= top_n + 1)
               .groupBy("_vector", *key, "norm")
               .agg(F.sort_array(F.collect_list(F.struct("product_id", "base_price", "rating"))).alias("members")))
    points = members.select("_vector", *key, "norm", "members", F.xxhash64("category").alias("_kind"),
                            (F.col("price_log") / F.col("norm")).alias("_x"),
                            (F.col("rating_f") / F.col("norm")).alias("_y")).checkpoint()
    n, most = points.agg(F.count(F.lit(1)), F.max("norm")).first()
    answers: DataFrame | None = None
    open_ = points.select("_vector", "price_log", "rating_f", "_kind", "norm", "_x", "_y")
    width = max(4.0 / max(n, 2), LEAST_WIDTH)
    while width < 2.0 and _neighbours(points, width) < top_n / 2.0:
        width *= 2.0
    while True:
        last = width >= 2.0        # unit vectors are never farther apart: every point is met
        # points of two categories are at least sqrt(2) / norm apart
        apart = not last and n > 0 and width * most < 1.4
        found = _nearest(open_, points, width, top_n + 1, apart).checkpoint()
        # a point that was not met is farther than ``width``, so less similar than this
        sure = (F.size("near") > top_n) & (F.element_at("near", -1).getField("s") > F.lit(1.0 - width * width / 2.0 + SLACK))
        done = found if last else found.where(sure)
        answers = done if answers is None else answers.unionByName(done)
        if last:
            break
        open_ = open_.join(answers.select("_vector"), "_vector", "left_anti").checkpoint()
        if open_.isEmpty():
            break
        width *= 2.0
    near = named.select(F.col("product_id").alias("source_id"), "_vector").join(answers, "_vector")
    others = F.slice(F.filter("near", lambda x: x["product_id"] != F.col("source_id")), 1, top_n)
    return (near.select("source_id", F.posexplode(others).alias("rank", "p"))
            .select("source_id", (F.col("rank") + 1).alias("rank"), "p.product_id", "p.category", "p.base_price",
                    "p.rating", F.col("p.s").alias("similarity")))


def _cell(c: str, width: float) -> Column:
    return F.floor(F.col(c) / F.lit(width))


def _neighbours(points: DataFrame, width: float) -> float:
    """How many points of its category a point has in its cell, itself included, on average."""
    cells = points.groupBy("_kind", _cell("_x", width), _cell("_y", width)).agg(F.count(F.lit(1)).cast("double").alias("c"))
    mean = cells.agg(F.try_divide(F.sum(F.col("c") * F.col("c")), F.sum("c"))).first()[0]
    return float("inf") if mean is None else mean


def _nearest(queries: DataFrame, points: DataFrame, width: float, k: int, apart: bool) -> DataFrame:
    """``_vector, near``: the k most similar products among the cells around each query point (``apart``: of its category)."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    q = (queries.withColumn("_step", F.explode(steps))
         .select(F.col("_vector").alias("_q"), F.col("price_log").alias("_p"), F.col("rating_f").alias("_r"),
                 F.col("_kind").alias("_c"), F.col("norm").alias("_n"),
                 (_cell("_x", width) + F.col("_step.i")).alias("_qi"), (_cell("_y", width) + F.col("_step.j")).alias("_qj")))
    # the products of a point are many times its size: only the nearest points get theirs
    p = points.select("_vector", "price_log", "rating_f", "_kind", "norm", _cell("_x", width).alias("_i"),
                      _cell("_y", width).alias("_j"), F.element_at("members", 1).getField("product_id").alias("_least"))
    sim = F.round(cosine(F.col("_p"), F.col("_r"), F.col("_c"), F.col("_n"), F.col("price_log"), F.col("rating_f"),
                         F.col("_kind"), F.col("norm")), 12)
    same = (F.col("_qi") == F.col("_i")) & (F.col("_qj") == F.col("_j"))
    met = (q.join(p, same & (F.col("_c") == F.col("_kind")) if apart else same)
           .select("_q", sim.alias("s"), "_least", "_vector"))
    # of equally similar points all k + 1 least ids are candidates: first the points, then their products
    w = Window.partitionBy("_q").orderBy(F.col("s").desc(), "_least")
    few = met.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).select("_q", "s", "_vector")
    each = (few.join(points.select("_vector", "category", "members"), "_vector")
            .select("_q", "s", "category", F.explode("members").alias("m")))
    item = F.struct((-F.col("s")).alias("o"), F.col("m.product_id").alias("product_id"), F.col("category"),
                    F.col("m.base_price").alias("base_price"), F.col("m.rating").alias("rating"), F.col("s"))
    return each.groupBy(F.col("_q").alias("_vector")).agg(F.slice(F.sort_array(F.collect_list(item)), 1, k).alias("near"))
