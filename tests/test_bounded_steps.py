"""Steps whose memory must not follow the size of the input."""

from __future__ import annotations

import tracemalloc
from pathlib import Path

import numpy as np

from storefront.operators import vector_index
from storefront.sources import ingest


def test_ingest_writes_rows_without_sorting_them(spark, tmp_path):
    """Folders for good and bad rows would have each task hold and sort all its rows."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,2.5\n2,x\n3,4.5\n")
    got = ingest.ingest_csv(spark, f"{tmp_path}/in", f"{tmp_path}/staging", schema="id bigint, qty double", header=False)
    assert sorted(map(tuple, got.rows.collect())) == [(1, 2.5), (3, 4.5)]
    assert [(r.line, r.file.rsplit("/", 1)[1]) for r in got.quarantine.collect()] == [("2,x", "a.csv")]
    assert not [f for f in Path(f"{tmp_path}/staging").iterdir() if f.is_dir()]


def test_nearest_cells_hold_few_rows_at_once():
    rng = np.random.default_rng(0)
    x, centres = rng.normal(size=(20_000, 4)), rng.normal(size=(1_000, 4))
    tracemalloc.start()
    near = vector_index._nearest_cells(x, centres, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # all rows and centres: 160 MB, and as much for their order
    some = x[::997]
    far = ((some[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (near[::997] == np.argsort(far, axis=1, kind="stable")[:, :3]).all()


def test_products_meet_few_others_of_their_category(spark, monkeypatch):
    """Products with vectors of their own: most are answered by the first cells, which hold one category each, and exactly."""
    import math

    from storefront.operators import recommend

    rows = [(i, ["a", "b", None][i % 3], 900.0 + (i * 7919 % 1201) * 0.91, None if i % 11 == 0 else 2.5 + i % 50 / 20) for i in range(900)]
    rounds, near = [], recommend._nearest

    def seen(queries, points, width, k, *apart):
        rounds.append((queries.count(), *apart))
        return near(queries, points, width, k, *apart)

    monkeypatch.setattr(recommend, "_nearest", seen)
    products = spark.createDataFrame(rows, "product_id int, category string, base_price double, rating double")
    got = {}
    for r in recommend.knn_products(products).orderBy("source_id", "rank").collect():
        got.setdefault(r.source_id, []).append((r.product_id, round(r.similarity, 9)))
    vectors = [(i, c, math.log1p(p), 4.0 if r is None else r) for i, c, p, r in rows]
    norms = [math.sqrt(p * p + r * r + 1) for _, _, p, r in vectors]
    for i, c, p, r in vectors:
        best = sorted((-round((p * q + r * s + (c == d)) / (norms[i] * norms[j]), 12), j) for j, d, q, s in vectors if j != i)[:5]
        assert got[i] == [(j, round(-o, 9)) for o, j in best]
    assert rounds[0] == (900, True) and sum(n for n, *_ in rounds) < 3 * 900


def test_neighbours_of_no_and_of_one_product(spark):
    from storefront.operators import recommend

    none = spark.createDataFrame([], "product_id int, category string, base_price double, rating double")
    one = spark.createDataFrame([(1, None, None, None)], none.schema)
    assert recommend.knn_products(none).count() == 0 and recommend.knn_products(one).count() == 0
