"""Operators 4 and 6 against brute force, on the small table and on awkward rows."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from storefront.llm import jaccard_join, queries, suffix_dedup
from storefront.llm.components import connected


def shingles(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = [x for x in re.split("[\x20\x09-\x0d]+", lowered) if x]
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(pairs):
    sets = [(k, shingles(t)) for k, t in pairs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(sets):
        least[find(i)].append(k)
    return sorted((k, len(s), min((x for x in least[find(i)] if x is not None), default=None))
                  for i, (k, s) in enumerate(sets) if k is not None)


def repeats(pairs, length=200):
    texts = [(k, (t or "").encode()) for k, t in pairs]
    seen = defaultdict(int)
    for _, t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p:p + length]] += 1
    out = []
    for k, t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = True
        runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((k, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def near_copies(seed=3):
    """A family of near copies, a shared passage in otherwise different texts, and odd rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    base = [word() for _ in range(120)]
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(25):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(word() for _ in range(40)) + " " + passage + " " + " ".join(word() for _ in range(30)))
             for i in range(30)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "a b"), (204, "A  B"), (205, "one two three four five six"),
             (206, "one two three four five six"), (206, "one two three four five six"), (None, "one two three four five six"),
             (207, "é" * 300), (208, "x" * 1000), (209, "y " * 4000)]
    return rows


def test_jaccard_matches_brute_force(make_docs):
    rows = near_copies()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar(make_docs(rows)).collect()
                 if r.doc_id is not None)
    assert got == components(rows)


def test_jaccard_without_frequent_list_and_small_buckets(make_docs):
    rows = near_copies(5)
    rule = jaccard_join.Rule(frequent=50, bucket_postings=3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar(make_docs(rows), rule).collect()
                 if r.doc_id is not None)
    assert got == components(rows)


def frequent_families(seed=11):
    """A text with many exact copies, near copies of it, and near copies of each other that share its shingles only."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    base = [word() for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(400)]
    for i in range(40):
        w = list(base)
        w[5 + i * 2] = f"own{i}"
        rows.append((1000 + i, " ".join(w)))
    for i in range(40):  # a fifth of the words replaced: like some of the others at most
        w = list(base)
        w[(i % 8) * 12:(i % 8) * 12 + 18] = [word() for _ in range(18)]
        rows.append((2000 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("partitions", [4, 64])
def test_jaccard_of_a_list_dealt_to_many_buckets(spark, make_docs, partitions):
    rows = frequent_families()
    rule = jaccard_join.Rule(bucket_postings=8, pivots=2)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions))
    try:
        docs = make_docs(rows)
        source = docs.select("doc_id", docs.text.cast("binary").alias("_text"))
        assert len(jaccard_join.frequent_shingles(source, rule)[0])
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar(docs, rule).collect())
    finally:
        spark.conf.set(name, before)
    assert got == components(rows)


def test_jaccard_on_table(spark, sf, sf_docs):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in queries.op6_jaccard(spark, sf).collect())
    assert got == components(sf_docs)


def test_representatives_keep_one_of_each(make_docs):
    rows = near_copies()
    kept = jaccard_join.representatives(make_docs(rows))
    assert "k" in kept.columns and "score" in kept.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    want = sorted({c for k, n, c in components(rows) if n} | {k for k, n, _ in components(rows) if not n})
    assert ids == want


def test_empty_tables(make_docs):
    none = make_docs([(1, "x")]).filter("doc_id > 1")
    assert jaccard_join.similar(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("rule", [suffix_dedup.Rule(), suffix_dedup.Rule(block_segments=2), suffix_dedup.Rule(block_bytes=2000)])
def test_repeats_match_brute_force(make_docs, rule):
    rows = [r for r in near_copies() if r[0] is not None]
    got = suffix_dedup.remove_repeats(make_docs(rows), rule).collect()
    have = sorted(((r.doc_id, r._n_bytes, r._n_removed, r._n_spans, hashlib.sha256(bytes(r._kept)).hexdigest()) for r in got), key=repr)
    assert have == repeats(rows)
    assert all(r.k == 7 and r.score == 0.5 for r in got)


def test_repeats_on_table(spark, sf, sf_docs):
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in queries.op4_suffix_dedup(spark, sf).collect()), key=repr)
    assert got == repeats(sf_docs)


def test_very_long_text_is_cut_into_chunks(make_docs):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghij") for _ in range(2_300_000))
    rows = [(1, long), (2, "zz" + long[1_048_300:1_048_900] + "yy")]
    got = {r.doc_id: (r._n_removed, r._n_spans) for r in suffix_dedup.remove_repeats(make_docs(rows)).collect()}
    assert got == {1: (600, 1), 2: (600, 1)}


def test_whole_characters_stay_whole(make_docs):
    shared = "ü" * 50 + "abcdefghij" * 12
    rows = [(1, "ä" + shared + "ö"), (2, "ï" + shared + "ë")]
    for r in suffix_dedup.remove_repeats(make_docs(rows), whole_characters=True).collect():
        bytes(r._kept).decode("utf-8")


def test_interval_tree_lists_maximal_repeats():
    text = np.frombuffer(b"xabcdabcdyabcd\xff", dtype=np.uint8)
    order, lcp = suffix_dedup.suffix_array(text, 16)
    assert [bytes(text[i:]) for i in order] == sorted(bytes(text[i:]) for i in range(len(text)))
    left = np.where(order == 0, 300, text[order - 1].astype(np.int64))
    found = {(n, tuple(sorted(order[a:b + 1].tolist()))) for n, a, b in suffix_dedup.maximal_repeats(order, lcp, left, 2)}
    # "abcd" at 1, 5 and 10 with left bytes x, d and y; "bcd" and "cd" always follow the same byte
    assert found == {(4, (1, 5, 10))}


def test_components_name_the_least_node(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_sets_agree_with_words():
    from storefront.llm import textvec as tv
    texts = [t or "" for _, t in near_copies()]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    cuts = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    assert [len(s) for s in tv.shingle_sets(data, cuts)] == [len(shingles(t)) for t in texts]


def test_segments_met_before_are_told_at_once(monkeypatch):
    """Of equal segments the first goes on, all are spans; a table that fills up only sends more on."""
    rng = np.random.default_rng(8)
    kinds = rng.integers(1, 1 << 60, 40).astype(np.uint64)
    for places in (16, 64, 1 << 12):
        monkeypatch.setattr(suffix_dedup, "SEEN_PLACES", places)
        seen, sent, told, met = suffix_dedup.SeenSegments(), [], set(), []
        for chunk in range(12):
            which = rng.integers(0, 40, rng.integers(0, 9))
            k, start, length = np.full(len(which), chunk), np.arange(len(which)) * 300, np.full(len(which), 210)
            on, again, late_k, late_start, late_end = seen.meet(k, start, length, kinds[which] + np.uint64(1), kinds[which])
            met += list(zip(which.tolist(), k.tolist(), start.tolist(), strict=True))
            sent += [(w, a, b) for w, a, b, o in zip(which.tolist(), k.tolist(), start.tolist(), on, strict=True) if o]
            told |= {(a, b) for a, b, t in zip(k.tolist(), start.tolist(), again, strict=True) if t}
            told |= set(zip(late_k.tolist(), late_start.tolist(), strict=True))
            assert ((late_end - late_start) == 210).all()
        for kind in range(40):
            own = {(a, b) for w, a, b in met if w == kind}
            first = {(a, b) for w, a, b in sent if w == kind}
            assert len(first) >= bool(own) and own - first <= told  # what does not go on is told
            assert len(first) > 1 or len(own) < 2 or own <= told  # alone downstream: told here if repeated
            assert len(own) > 1 or not own & told  # what occurs once is never told
            if places == 1 << 12:
                assert len(first) <= 1
