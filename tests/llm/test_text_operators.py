"""Operators 1, 2, 3, 5, 7, 8, 9 and 10 on awkward rows and against plain versions."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from storefront.llm import (decontaminate, imatch, licenses, oracles, packing, quality_gam, queries, sharding, token_count,
                            toxicity)

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, "it's we'll they've'd don't 'sa ''s  x\n\n y \n z'"), (2, None), (3, ""), (4, "  \t\n"), (5, "日本語 テスト  　x"),
       (6, "é" * 500), (6, "é" * 500), (None, "no id"), (7, "<|endoftext|> ab12  34ß!!"), (8, "word " * 3000)]


def bpe():
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


# --- 2 -----------------------------------------------------------------------------------------

def test_pack_round_trip(make_docs):
    rows = packing.pack(make_docs(ODD), BPE).collect()
    tok = bpe()
    for key, text in {k: t or "" for k, t in ODD if k not in (6, None)}.items():
        want = tok.encode(text, add_special_tokens=False).ids + [1]
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        got = [int(x) for r in own for x in np.frombuffer(bytes(r.ids), dtype="<u4")]
        assert got == want and all(r.doc_tokens == len(want) for r in own)
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]]))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0] + [n for _, n in pieces[:-1]]))
        total = sum(n for _, n in pieces)
        assert total == 2048 or total & (total - 1) == 0
    assert sum(r.length for r in rows if r.doc_id == 6) == 2 * (len(tok.encode("é" * 500, add_special_tokens=False).ids) + 1)
    assert packing.pack(make_docs(ODD).filter("doc_id > 100"), BPE).count() == 0


@pytest.mark.parametrize("limits", [packing.Limits(64, 3, 64), packing.Limits(64, 100, 20), packing.Limits(128, 2, 50)])
def test_pack_keeps_all_limits(spark, limits):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["tok"] * int(rng.integers(1, 90))), " ".join(["ask"] * int(rng.integers(0, 60)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt string")
    got = packing.pack(df, BPE, limits, prompt_col="prompt").collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        assert sum(p.length for p in pieces) <= limits.tokens
        assert len(pieces) <= limits.segments
        assert sum(p.loss_tokens for p in pieces) <= limits.loss_tokens
    for i, text, prompt in rows:
        own = [r for r in got if r.doc_id == i]
        assert sum(r.length for r in own) == own[0].doc_tokens
        assert sum(r.loss_tokens for r in own) == len(bpe().encode(text, add_special_tokens=False).ids) + 1


def test_pack_whole_table(spark, sf, sf_docs):
    rows = queries.op2_packing(spark, sf).collect()
    tok = bpe()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for key, text in sf_docs[:80]:
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [1], dtype="<u4")
        for r in pieces[key]:
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert sum(r.length for r in pieces[key]) == len(ids)
    assert len(pieces) == len(sf_docs)


# --- 3 -----------------------------------------------------------------------------------------

ITEM = "The train leaves Paris at 9 am and travels 120 km with Anna on board before it stops for lunch at noon near the river"


def found(make_docs, spark, texts, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(texts), bench).collect()), key=repr)


def test_leaks_by_template(make_docs, spark):
    renamed = ITEM.replace("Paris", "Rome").replace("120", "350").replace("Anna", "Bert").replace("9 am", "7 am")
    texts = [(1, "x y z. " + ITEM + " and so on"), (2, ITEM.upper()), (3, "Intro text here. " + renamed), (4, "nothing of it " * 20),
             (5, None), (6, ""), (None, ITEM), (7, " ".join(ITEM.split()[:9])), (1, ITEM)]
    got = found(make_docs, spark, texts, [(10, ITEM), (11, None), (12, ""), (13, "a"), (10, ITEM)])
    # upper case has no names and units, so its template may differ; nine words of the item are too few
    assert [g for g in got if g[0] != 2] == [(1, 10), (1, 10), (3, 10), (None, 10)]


def test_inconsistent_slots_are_no_leak(make_docs, spark):
    item = ("From Oslo we walked on and on until Oslo was far away then we took the road back to Oslo and slept there and "
            "dreamt of Oslo all night and saw Oslo in the morning")
    same = item.replace("Oslo", "Bern")
    mixed = item
    for city in ("Bern", "Lyon", "Kiel", "Genf", "Ulm"):
        mixed = mixed.replace("Oslo", city, 1)
    got = found(make_docs, spark, [(1, "Intro. " + same), (2, "Intro. " + mixed)], [(5, item)])
    assert got == [(1, 5)]


def test_each_occurrence_counts_alone(make_docs, spark):
    template = ("A shop near the river sells {a} baskets for {b} dollars each on monday and the owner keeps {c} of them "
                "back for friends so how many baskets are left to sell")
    one, two, three = (template.format(a=a, b=b, c=c) for a, b, c in ((5, 7, 2), (6, 9, 3), (8, 11, 4)))
    items = [(1, one), (2, two)]
    filler = " and some other words stand here that no item has at all " * 3
    rows = [(1, one + filler + two), (2, three + filler + two.replace("6", "10")), (3, f"{one} {one} {two}"),
            (4, one + filler + "sells 9 baskets for 9 dollars each on monday and the owner"), (5, filler)]
    assert found(make_docs, spark, rows, items) == [(d, i) for d in (1, 2, 3, 4) for i in (1, 2)]


def test_items_dense_in_numbers_are_met(make_docs, spark):
    items = [(1, "Compute 3 km plus 7 km minus 2 km plus 9 km"), (2, "12 + 45 = 57 ; 8 * 7 = 56"), (3, "4 8 15 16 23 42 108 7 9 1"),
             (4, "91 17 33"), (5, "Add 1 2 3 4 5 6 7 8 and 10 11 12 13 14 15 16 17")]
    filler = "some words that no item has stand here"
    rows = [(i, f"{filler} {t} {filler}") for i, t in items]
    rows += [(11, f"{filler}. Compute 5 km plus 8 km minus 1 km plus 6 km"), (12, f"{filler} 3 + 4 = 7 ; 5 * 6 = 30"),
             (13, "4 8 15 16 23 42 108 7 9 2"), (14, "Compute 3 km plus 3 km minus 3 km plus 3 km"), (15, filler),
             (16, f"{filler} Bob 3 km plus 7 km minus 2 km plus 9 km")]
    assert found(make_docs, spark, rows, items) == [(1, 1), (11, 1), (12, 2), (2, 2), (3, 3), (4, 4), (5, 5)]


VARIANTS = [  # item, and the same question with other numbers, units and names
    ("The old train leaves the station with 240 passengers and travels 5km before Anna joins the long route home",
     "The old train leaves the station with 317 passengers and travels 12m before Älva joins the long route home"),
    ("In a small shop a farmer called Ömer sells twenty baskets of fresh red apples for €15 each and keeps the rest",
     "In a small shop a farmer called Zoë sells forty baskets of fresh red apples for £22 each and keeps the rest"),
    ("how many bottles of water must be filled when every bottle holds 250ml and the large tank holds seven litres",
     "how many bottles of water must be filled when every bottle holds 500ml and the large tank holds nine litres"),
    ("the long river flows past Иван and his house where 3 boats carry 40kg of grain down to the market every day",
     "the long river flows past Олег and his house where 8 boats carry 95kg of grain down to the market every day"),
]


def test_canonical_words():
    text = "They paid €5 or £7 and 12km then twenty kilos with Élan, Straße Ωmega 5kmx km5 v2 one day 3 km".encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends, *_, kind = decontaminate.canonical(data, np.array([0, len(data)]))
    got = {text[a:b].decode(): int(k) for a, b, k in zip(starts, ends, kind, strict=True)}
    n, u, name, m = decontaminate.NUMBER, decontaminate.UNIT, decontaminate.NAME, decontaminate.MEASURE
    want = {"€5": n, "£7": n, "12km": m, "twenty": n, "Élan,": name, "Straße": name, "Ωmega": name, "3": n, "km": u}
    assert {w: k for w, k in got.items() if k} == want


def test_recall_on_other_numbers_units_and_names(make_docs, spark):
    rng = random.Random(3)
    filler = [f"w{i}" for i in range(400)]
    items, docs, pairs = [], [], VARIANTS
    for i, (item, other) in enumerate(pairs):
        items.append((i, item))
        for text in (item, other):
            docs.append((len(docs), " ".join(rng.choices(filler, k=60)) + " " + text + " " + " ".join(rng.choices(filler, k=60))))
    # re-parameterised at random: every number word, number and name replaced one for one
    names, numbers = ["Åsa", "Bruno", "Çelik", "Dora", "Žofie"], ["three", "eleven", "sixty"]
    for i in range(60):
        k = i % len(pairs)
        words = []
        for w in pairs[k][0].split():
            if w[0].isdigit():
                digits = "".join(c for c in w if c.isdigit())
                w = str(rng.randrange(2, 900)) + w[len(digits):]
            elif w.startswith("€"):
                w = rng.choice("€£¥") + str(rng.randrange(2, 90))
            elif w in decontaminate.NUMBER_WORDS:
                w = rng.choice(numbers)
            elif w[0].isupper() and w not in ("The", "In"):
                w = rng.choice(names)
            words.append(w)
        docs.append((len(docs), " ".join(words)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(docs), bench).collect()}
    want = {(2 * k + v, k) for k in range(len(pairs)) for v in (0, 1)} | {(2 * len(pairs) + i, i % len(pairs)) for i in range(60)}
    assert len(found & want) >= 0.9 * len(want) and not found - want


def test_leaks_match_plain_search(spark, sf):
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{sf}/benchmark.parquet'").fetchall()
    want = sorted((d, i) for d, t in docs for i, x in items if x in t)
    assert sorted((r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, sf).collect()) == want


def test_leaks_in_blocks_and_empty(make_docs, spark):
    bench = spark.createDataFrame([(i, ITEM.replace("train", f"train{i}")) for i in range(6)], "item_id long, text string")
    docs = make_docs([(i, "Intro. " + ITEM.replace("train", f"train{i}")) for i in range(6)])
    rule = decontaminate.Rule(block_words=30, windows=100, share=1.0)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench, rule).collect()) == [(i, i) for i in range(6)]
    assert decontaminate.leaks(docs.filter("doc_id > 9"), bench).count() == 0
    assert decontaminate.leaks(docs, bench.filter("item_id > 9")).count() == 0


# --- 1 -----------------------------------------------------------------------------------------

def test_licences_match_sql(spark, sf):
    from pyspark.sql import functions as F
    got = {tuple(r) for r in queries.op1_licenses(spark, sf).withColumn("cosine", F.round("cosine", 5)).collect()}
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    cols = "doc_id, path, licence, origin, round(cosine, 5), origin_dir"
    assert got == set(con.sql(f"select {cols} from ({oracles.OP1})").fetchall())


def test_licence_bound_loses_no_unit():
    """The shortest count of terms that can reach the bound: one term fewer never does."""
    known = licenses.weights([t for _, t in licenses.TEMPLATES], 0.65)
    for v in known.vectors:
        n = licenses._least(v, 0.4)
        assert sum(sorted((w * w for w in v.values()), reverse=True)[:n - 1]) < 0.4 + 1e-6


def test_licence_inheritance(spark):
    from pyspark.sql import functions as F
    rows = [(1, "a/LICENSE", "Released under the MIT License.\n" + "more words here " * 30), (2, "a/b/x.txt", "plain"),
            (3, "a/b/c/LICENSE", "Licensed under the Apache License, Version 2.0."), (4, "a/b/c/d/y.txt", "plain"),
            (5, "z/q.txt", None), (6, None, ""), (7, "a/b/own.txt", "words " * 40 + "\nLicensed under CC BY-NC 4.0."),
            (7, "a/b/own.txt", "words " * 40 + "\nLicensed under CC BY-NC 4.0."), (8, "z/odd.txt", "a licence to dream " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, p string, text string")
    got = sorted((r.doc_id, r.licence, r.origin, r.origin_dir) for r in licenses.scan(df, F.col("p")).collect())
    assert got == [(1, "MIT", "own", "a"), (2, "MIT", "inherited", "a"), (3, "Apache-2.0", "own", "a/b/c"),
                   (4, "Apache-2.0", "inherited", "a/b/c"), (5, None, "none", None), (6, None, "none", None),
                   (7, "CC-BY-NC-4.0", "own", "a/b"), (7, "CC-BY-NC-4.0", "own", "a/b"), (8, None, "none", None)]
    assert licenses.scan(df.filter("doc_id > 99"), F.col("p")).count() == 0


GPL3 = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def wrapped(text, width, mark=""):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(mark + line)
            line = ""
        line += w + " "
    return "\n".join([*out, mark + line])


def test_licence_texts_that_wrap_over_lines(spark, make_docs):
    from pyspark.sql import functions as F
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and "WARRANTY" in t)
    code = "\n\nimport os\n" + "value = compute(value)\n" * 40
    grant = licenses.TEMPLATES[2][1]
    texts = {"LICENSE": (grant, "MIT"), "COPYING": ("MIT License\n\nCopyright (c) 2001 Someone\n\n" + wrapped(mit, 70), "MIT"),
             "a.py": (GPL3 + code, "GPL-3.0"), "b.py": (GPL3.replace("version 3", "version 2").replace("software:", "software;") + code, "GPL-2.0"),
             "c.py": (GPL3.replace("General", "Affero General") + code, "AGPL-3.0"), "d.py": ("int x;" + code, None),
             "long.txt": ("filler words of no licence " * 60_000 + "\n\n" + wrapped(mit, 60, "// "), "MIT"),
             "prose.txt": ("The terms of use of the work, without warranty, are in this file. " * 20, None)}
    df = make_docs([(i, t) for i, (t, _) in enumerate(texts.values())])
    names = F.element_at(F.lit([f"x{i}/{n}" for i, n in enumerate(texts)]), F.col("doc_id").cast("int") + 1)
    got = {r.doc_id: r.licence for r in licenses.scan(df, names).collect()}
    assert got == {i: want for i, (_, want) in enumerate(texts.values())}


def test_bounds_lose_no_unit():
    """A unit's cosine is under the threshold wherever it holds no telling term."""
    known = licenses.weights([t for _, t in licenses.TEMPLATES], 0.65)
    for v in known.vectors:
        assert sum(w * w for t, w in v.items() if t not in known.telling) < 0.65 ** 2


# --- 7 -----------------------------------------------------------------------------------------

def plain_minimax(sizes, shards):
    """The least possible largest shard, over all contiguous partitions."""
    least = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        least = [min(max(least[a], sum(sizes[a:b])) for a in range(b + 1)) for b in range(len(sizes) + 1)]
    return least[-1]


def in_memory(groups):
    """Measures like the operator's, of (md5, size) pairs."""
    def measure(digits, within):
        found = {}
        for name, size in groups:
            if within is None or name[:digits - sharding.MORE_DIGITS] in within:
                found.setdefault(name[:digits], []).append(size)
        return [(k, sum(v), len(v) == 1) for k, v in found.items()]
    return measure


@pytest.mark.parametrize("digits", [1, 4])
def test_minimax_over_groups_against_all_partitions(digits, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    rng = np.random.default_rng(7)
    for trial in range(40):
        n, shards = int(rng.integers(1, 26)), int(rng.integers(1, 8))
        sizes = rng.integers(1, 50, n).tolist()
        if trial % 3 == 0:
            sizes[int(rng.integers(0, n))] = 400  # one hot group
        groups = sorted((hashlib.md5(f"{trial}-{i}".encode()).hexdigest(), s) for i, s in enumerate(sizes))
        capacity, firsts = sharding.minimax_cuts(in_memory(groups), shards)
        assert capacity == plain_minimax([s for _, s in groups], shards)
        loads = [0] * shards
        for name, size in groups:
            loads[sum(f is not None and name >= f for f in firsts)] += size
        assert max(loads) == capacity or max(loads) <= capacity and len(firsts) == shards - 1


def test_a_hot_group_leaves_no_shard_empty():
    groups = sorted((hashlib.md5(f"h{i}".encode()).hexdigest(), 1000 if i == 0 else 1) for i in range(2001))
    capacity, firsts = sharding.minimax_cuts(in_memory(groups), 24)
    loads = [0] * 24
    for name, size in groups:
        loads[sum(f is not None and name >= f for f in firsts)] += size
    assert capacity == 1000 == max(loads)
    rest = sorted(loads)[:-1]
    assert min(rest) >= 40 and max(rest) <= 200


def test_shards(make_docs, spark, sf):
    rows = sharding.shard(make_docs([*ODD, *[(100 + i, f"text {i % 40}") for i in range(400)]]), 5).collect()
    assert len(rows) == len(ODD) + 400
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    place = {}
    for r in rows:
        assert place.setdefault(r.text_crc32, r.shard) == r.shard
    assert {r.size for r in rows if r.doc_id in (2, 3)} == {8}
    assert sharding.shard(make_docs(ODD).filter("doc_id > 99")).count() == 0
    whole = queries.op7_sharding(spark, sf).collect()
    loads = np.bincount([r.shard for r in whole], [r.size for r in whole], 24)
    sizes = {}
    for (t,) in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect():
        raw = (t or "").encode()
        sizes[hashlib.md5(raw).hexdigest()] = sizes.get(hashlib.md5(raw).hexdigest(), 0) + len(raw) + 8
    capacity, _ = sharding.minimax_cuts(in_memory(sorted(sizes.items())), 24)
    assert loads.max() <= capacity and loads.min() >= 0.3 * loads.sum() / 24


# --- 5 and 8 -----------------------------------------------------------------------------------

def auc(y, s):
    import pandas as pd
    rank = pd.Series(s).rank().to_numpy()
    n1, n0 = y.sum(), len(y) - y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize("name,label,mod,rest,least", [("op8_quality", "quality", 4, 2, 0.97), ("op5_toxicity", "toxic", 3, 1, 0.9)])
def test_held_out(spark, name, label, mod, rest, least):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, d).toPandas()
    labels = duckdb.sql(f"select doc_id, {label} as y from '{d}/labels.parquet'").df()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % mod == rest for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.y.to_numpy(), held.score.to_numpy()) >= least


def test_scores_of_odd_rows(make_docs, spark):
    docs = make_docs([*ODD, *[(100 + i, ("bad!! " if i % 2 else "good words here. ") * 20) for i in range(60)]])
    labels = spark.createDataFrame([(100 + i, 1 - i % 2, i % 2) for i in range(60)] + [(1, None, None), (None, 1, 1), (2, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for rows in (quality_gam.classify(docs, labels).collect(),
                 toxicity.score(docs, toxicity.learn_lexicon(docs, labels)).collect()):
        assert len(rows) == len(ODD) + 60 and all(0 <= r.score <= 1 for r in rows)
        assert [r.held_out for r in rows if r.doc_id is None] == [False]
    none = labels.filter("doc_id > 1000")
    assert {r.score for r in quality_gam.classify(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.filter("doc_id > 1000"), toxicity.Lexicon({})).count() == 0
    assert quality_gam.classify(docs.filter("doc_id > 1000"), labels).count() == 0


def test_folding_and_exceptions(make_docs):
    lexicon = toxicity.Lexicon({"idiot": 5.0, "clow": 3.0}, ["clown fish"], (-3.0, 1.0, 1.0))
    texts = ["you id1ot", "you IDIOT", "іdіоt", "ｉｄｉｏｔ", "i­di​ot", "the clown fish swims", "the clown swims", "kind words",
             "clown", None]
    got = {r.doc_id: r.score for r in toxicity.score(make_docs(list(enumerate(texts))), lexicon).collect()}
    assert min(got[i] for i in (0, 1, 2, 3, 4, 6, 8)) > got[7] and got[5] == got[7] == got[9]
    longer = toxicity.score(make_docs([(0, "idiot " + "x " * 10), (1, "idiot " + "x " * 1000)]), lexicon).collect()
    assert longer[0].score != longer[1].score


def test_boosting_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality_gam.fit_gam(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


# --- 9 -----------------------------------------------------------------------------------------

def test_fingerprints(make_docs, spark, sf, sf_docs):
    got = {r.doc_id: r for r in queries.op9_imatch(spark, sf).collect()}
    docs = sorted(sf_docs, reverse=True)
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
    by_text = {}
    for i, text in docs:
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint
    near = np.array([[r.near_edited, r.near_next] for r in got.values()])
    assert ((near >= 0) & (near <= 1)).all() and near[:, 0].mean() > near[:, 1].mean() + 0.2


def test_fingerprints_of_odd_rows(make_docs):
    rows = imatch.fingerprints(make_docs(ODD)).collect()
    assert len(rows) == len(ODD)
    assert len({r.fingerprint for r in rows if r.doc_id in (2, 3, 4)}) == 1
    one = imatch.fingerprints(make_docs([(5, "only one text here")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert imatch.fingerprints(make_docs(ODD).filter("doc_id > 99")).count() == 0


def test_next_document_over_many_ranges(make_docs, spark):
    docs = make_docs([(i * 3, f"t{i}") for i in range(50)]).selectExpr("doc_id", "text", "array(0) as sig")
    got = {r.doc_id: r.next_text for r in imatch.with_next(docs, rows_in_bucket=4).collect()}
    assert got == {i * 3: f"t{(i - 1) % 50}" for i in range(50)}


# --- 10 ----------------------------------------------------------------------------------------

def test_counts_match_the_library(make_docs, spark, sf, sf_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    tok = Tokenizer(models.Unigram([("<unk>", 0.0), *token_count.vocabulary(path)], unk_id=0, byte_fallback=False))
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(
        replacement="▁", prepend_scheme="always", split=False)])
    got = {r.doc_id: r.n_tokens for r in queries.op10_token_count(spark, sf).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in sf_docs}
    odd = token_count.count_tokens(make_docs(ODD), path).collect()
    want = [len(tok.encode(t or "", add_special_tokens=False).ids) for _, t in ODD]
    assert sorted(r.n_tokens for r in odd) == sorted(want)
    assert token_count.count_tokens(make_docs(ODD).filter("doc_id > 99"), path).count() == 0


def test_ties_are_the_tokenizers_own():
    rng = np.random.default_rng(1)
    pieces = [("▁", -1.0), ("a", -1.0), ("b", -2.0), ("ab", -3.0), ("ba", -3.0), ("aba", -4.0), ("▁a", -2.0), ("bb", -4.0)]
    tok = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    solver = token_count.CountViterbi(pieces)
    for _ in range(500):
        word = "".join(rng.choice(list("abcb"), int(rng.integers(1, 12))))
        assert solver.solve(word)[0] == len(tok.encode(word, add_special_tokens=False).ids)
