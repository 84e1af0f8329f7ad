"""Operators 11, 12 and 13 against plain versions and on awkward rows."""

import hashlib
import heapq
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storefront.llm import conversations as cv
from storefront.llm import huffman, queries, whitening

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, "it's we'll # \"!  x\n\n y"), (2, None), (3, ""), (4, "  \t\n"), (5, "日本語 テスト"), (6, "é" * 500), (6, "é" * 500),
       (None, "no id"), (None, None), (7, "<|endoftext|> ab12 34ß!!"), (8, "word and more " * 20000), (-3, "least")]


# --- 11 ----------------------------------------------------------------------------------------

def plain_huffman_cost(counts):
    heap, total = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@lru_cache(maxsize=None)
def best_limited(counts, slots, depth):
    """Least total length of codes for descending counts, with ``slots`` open nodes at ``depth`` left levels."""
    if not counts:
        return 0
    if slots == 0 or len(counts) > slots << depth:
        return float("inf")
    here = [best_limited(counts[k:], (slots - k) * 2, depth - 1) + sum(counts[k:]) for k in range(min(slots, len(counts)) + 1)
            if depth or k == len(counts)]
    return min(here)


@pytest.mark.parametrize("n", [2, 3, 7, 50, 700])
def test_code_is_optimal(n):
    rng = np.random.default_rng(n)
    counts = rng.zipf(1.4, n).clip(max=10 ** 9)
    bits = huffman.code_lengths(counts, 40)
    assert (bits * counts).sum() == plain_huffman_cost(counts) and (2.0 ** -bits).sum() == 1.0
    least = max(1, (n - 1).bit_length())
    limited = huffman.code_lengths(counts, least)
    assert limited.max() <= least and (2.0 ** -limited).sum() <= 1.0


@pytest.mark.parametrize("limit", [3, 4, 5])
def test_limited_code_is_optimal(limit):
    rng = np.random.default_rng(limit)
    for _ in range(10):
        counts = np.sort(rng.zipf(1.3, rng.integers(2, 9)).clip(max=1000))[::-1]
        bits = huffman.code_lengths(counts, limit)
        assert bits.max() <= limit
        # one root: its children are the first open nodes
        want = best_limited(tuple(int(c) for c in counts), 2, limit - 1) + counts.sum()
        assert (bits * counts).sum() == want


def test_blocks_decode_alone():
    rng = np.random.default_rng(3)
    form = huffman.Format(block_ids=16)
    codec = huffman.Codec(np.arange(0, 600, 3), huffman.code_lengths(rng.zipf(1.2, 200).clip(max=10 ** 6), 12), form)
    segments = [rng.integers(0, 200, n) * 3 for n in (0, 1, 15, 16, 17, 1000, 33)]
    bodies = [codec.encode(s) for s in segments]
    for got, want in zip(codec.decode(bodies), segments, strict=True):
        assert got.tolist() == want.tolist()
    # one block by its checkpoint, from a body cut down to it
    head = np.frombuffer(bodies[5], huffman.HEAD, 1)[0]
    marks = np.frombuffer(bodies[5], "<u8", int(head["blocks"]), huffman.HEAD.itemsize)
    one = np.array([(huffman.MAGIC, 16, 1, 16)], huffman.HEAD).tobytes() + marks[7:8].tobytes() + bodies[5][huffman.HEAD.itemsize + 8 * len(marks):]
    assert codec.decode([one])[0].tolist() == segments[5][112:128].tolist()
    with pytest.raises(ValueError):
        codec.decode([b"XXXX" + bodies[5][4:]])


def plain_ids(pairs):
    tok = Tokenizer.from_file(BPE)
    tok.encode_special_tokens = True
    return [(k, tok.encode(t or "", add_special_tokens=False).ids + [2]) for k, t in pairs]


def test_round_trip(spark, make_docs):
    folder = huffman.scratch_folder(spark)
    huffman.write(make_docs(ODD), BPE, folder, huffman.Format(block_ids=64, segment_ids=1000))
    rows = sorted(huffman.read(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((k for k, _ in ODD), key=lambda k: (k is not None, k))
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows[:-1]]))
    got = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert got == sorted((str(k), ids) for k, ids in plain_ids(ODD))
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.n_tokens * 4 == len(r.ids) for r in rows)
    # folders hold the segments in order, each part in one file
    segments = spark.read.parquet(f"{folder}/segments").withColumn("file", F.col("_metadata.file_path")).collect()
    firsts = [r["first"] for r in sorted(segments, key=lambda r: (r.part, r["first"]))]
    assert firsts == sorted(firsts) and len({(r.part, r.file) for r in segments}) == len({r.part for r in segments}) > 1
    empty = huffman.scratch_folder(spark)
    huffman.write(make_docs(ODD).filter("doc_id > 100"), BPE, empty)
    assert huffman.read(spark, empty).count() == 0


def test_huffman_query(spark, sf, sf_docs):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op11_huffman(spark, sf).collect()}
    start, want = 0, {}
    for k, ids in plain_ids(sf_docs):
        want[k] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want


# --- 12 ----------------------------------------------------------------------------------------

def plain_repair(rows):
    """Least (cost, audit) over all edit strings, and what they write."""
    faults, seen = [], set()
    for _, role, text in rows:
        tail = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)
        faults.append(1 if not tail else 2 if (role, text) in seen else 3 if tail[-1] not in ".!?" else 0)
        seen.add((role, text))
    go = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 4:
            for c in "ua":
                if c in go[state]:
                    cost, audit, out = best(i, c, inserted + 1)
                    ways.append((cost + 3, "I" + audit, (({"u": "user", "a": "assistant"}[c], ""), *out)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, out = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit, out))
            if faults[i] not in (1, 2):
                cut = 3 * (faults[i] == 3)
                if role[:1] in go[state]:
                    cost, audit, out = best(i + 1, role[:1], 0)
                    ways.append((cost + cut, "K" + audit, ((role, text), *out)))
                for c in "ua":
                    if c in go[state]:
                        cost, audit, out = best(i + 1, c, 0)
                        ways.append((cost + 3 + cut, "R" + audit, (({"u": "user", "a": "assistant"}[c], text), *out)))
        return min(ways, default=(10 ** 9, "", ()))

    for i in range(len(rows), 0, -1):  # keeps the recursion flat
        for state in go:
            best(i, state, 0)
    cost, audit, out = best(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (1, 2, 3)),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(key.encode()) % 20
        own = out.setdefault(conv, [])
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        if fate:
            own += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0])) for c, r in out.items()}


def as_digests(df):
    got = {}
    for r in df.collect():
        assert r[0] not in got
        got[r[0]] = tuple(r)[1:]
    return got


ROLES = ["user", "assistant", "system", "assistant", "user", "tool", "", None]
TEXTS = ["Yes.", "No!", "Why?", "cut off", " \t\n", "", None, "ok.  \n", "long " * 50 + ".", "Ünï.", "x"]


def random_rows(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for c, n in enumerate(sizes):
        turns = rng.sample(range(-2, 3 * n + 2), n)
        conv = None if c == 3 else c * 7 - 5
        rows += [(conv, None if rng.random() < 0.02 and i == 0 else t, rng.choice(ROLES), rng.choice(TEXTS)) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, name string, part int")


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_against_brute_force(spark, seed):
    rows = random_rows(seed, [1, 2, 3, 5, 8, 13, 40, 0, *[4, 6] * 20])
    got = as_digests(cv.digests(cv.damage(conversations(spark, rows))))
    assert got == {c: plain_repair(tuple(r)) for c, r in plain_damage(rows).items()}


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    rows = random_rows(9, [3, 400, 5, 2, 150])
    monkeypatch.setattr(cv, "HELD_ROWS", 16)
    got = as_digests(cv.digests(cv.damage(conversations(spark, rows))))
    assert got == {c: plain_repair(tuple(r)) for c, r in plain_damage(rows).items()}


def test_edits_write_what_the_digest_says(spark):
    rows = random_rows(4, [3, 30, 7, 2, 9, 1])
    damaged = cv.damage(conversations(spark, rows)).cache()
    by = {}
    for r in sorted(cv.repair(damaged).collect(), key=lambda r: (r.part, r.pos, r.nth)):
        by.setdefault(r.conv, []).append(r)
    for conv, digest in as_digests(cv.digests(damaged)).items():
        own = by.get(conv, [])
        assert "".join(r.edit for r in own) == digest[6]
        lines = [f"{r.new_role}:{r.new_text}" for r in own if r.new_role is not None]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == digest[7]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.new_role[0] for r in own if r.new_role is not None))


def test_hirschberg_is_least_among_all():
    rng = random.Random(7)
    for _ in range(300):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "cut", "", "d.", "e."])) for i in range(rng.randrange(0, 9))]
        seen, kinds, faults = set(), [], []
        for _, role, text in rows:
            f = cv.BLANK if not text else cv.DUPLICATE if (role, text) in seen else cv.CUT if text[-1] != "." else cv.NO_FAULT
            seen.add((role, text))
            faults.append(f)
            kinds.append(cv.kind_of(role, f))
        edits, _ = cv.solve(kinds, cv.NOTHING, None)
        assert "".join(edits) == plain_repair(tuple(rows))[6]


def test_odd_conversations(spark):
    empty = cv.damage(conversations(spark, []))
    assert cv.digests(empty).count() == 0 and cv.repair(empty).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, dropped, "user", "gone."), (None, None, None, None), (8, None, "user", "a."), (8, None, "user", "a."), (9, 1, "user", "y" * 300_000 + ".")]
    got = as_digests(cv.digests(cv.damage(conversations(spark, rows))))
    assert got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: plain_repair(tuple(r)) for c, r in plain_damage(rows).items()}


def test_conversation_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_digests(queries.op12_conversations(spark, sf)) == {c: plain_repair(tuple(r)) for c, r in plain_damage(rows).items()}


# --- 13 ----------------------------------------------------------------------------------------

def vectors(spark, pairs):
    return spark.createDataFrame([(i, v, 3, "x") for i, v in pairs], "vec_id long, embedding array<double>, n int, q string")


def against_eigh(rows, pairs, components=32):
    kept = [(i, v) for i, v in pairs if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.floor(64 * np.array([v for _, v in kept])).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = (x * n - s) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    assert len(rows) == n * k
    want = centred @ q[:, :k] / np.sqrt(e[:k])
    got = np.array([[r.whitened for r in sorted((r for r in rows if r.vec_id == i), key=lambda r: r.component)] for i, _ in kept])
    np.testing.assert_allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-8)
    assert {(r.vec_id, r.n, r.deviation) for r in rows} == {(i, n, int(d)) for (i, _), d in zip(kept, ((x * n - s) ** 2).sum(axis=1))}
    for r in rows:
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-10 and r.identity_error < 1e-9


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(2)
    mixed = rng.standard_normal((300, 12)) * np.linspace(4, 0.5, 12) @ rng.standard_normal((12, 12))
    pairs = list(enumerate(mixed.tolist()))
    pairs[5], pairs[9] = (5, None), (9, [1.0] * 11 + [None])
    pairs += [(400, [1.0] * 11 + [float("nan")]), (401, [1.0] * 11 + [float("-inf")])]
    df = vectors(spark, pairs).repartition(5)
    against_eigh(whitening.whiten(df).collect(), pairs)
    against_eigh(whitening.whiten(df, plan=whitening.Plan(components=4)).collect(), pairs, 4)


def test_fewer_directions_than_dimensions(spark):
    rng = np.random.default_rng(5)
    low = rng.standard_normal((120, 3)) @ (8 * rng.integers(-2, 3, (3, 10)))
    pairs = list(enumerate((np.floor(low * 64) / 64).tolist()))
    rows = whitening.whiten(vectors(spark, pairs)).collect()
    assert max(r.component for r in rows) <= 10 and rows[0].identity_error < 1e-6


def test_equal_deviations_are_all_found(spark):
    # the covariance is a multiple of the identity: one Lanczos run sees a single direction
    pairs = [(2 * j + s, [float(64 * (2 * s - 1)) if i == j else 0.0 for i in range(6)]) for j in range(6) for s in (0, 1)]
    rows = whitening.whiten(vectors(spark, pairs)).collect()
    assert {r.component for r in rows} == set(range(1, 7))
    assert all(abs(r.explained - 1 / 6) < 1e-12 and r.identity_error < 1e-12 for r in rows)


def test_odd_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None)])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [])])).count() == 0
    rows = whitening.whiten(vectors(spark, [(None, [1.0, 2.0]), (4, [3.0]), (4, [3.0]), (7, [1e300, 0.0])])).collect()
    assert len(rows) == 4 * max(r.component for r in rows) and sum(r.vec_id is None for r in rows) == max(r.component for r in rows)
    x = [64 + 10 ** 6, 192 + 10 ** 6, 192 + 10 ** 6, (1 << 52) + 10 ** 6], [128 + 10 ** 6, 10 ** 6, 10 ** 6, 10 ** 6]
    own = [sum((4 * c[i] - sum(c)) ** 2 for c in x) for i in range(4)]
    assert {r.deviation for r in rows} == {o if o < 1 << 63 else None for o in own}


def test_whitening_query(spark, sf):
    rows = queries.op13_whitening(spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    against_eigh(rows, [(r.vec_id, [float(x) for x in r.embedding]) for r in table])
