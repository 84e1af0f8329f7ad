"""Operator 9 [native]: I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a chosen
band.  Its size is bounded: terms that occur in at least a share ``s`` of all
documents number at most (mean distinct terms of a document) / s.  A document
keeps its distinct lexicon terms in sorted order, and every subset of the lexicon
gives one hash of the terms that lie in it.

Subsets are drawn at several rates: at the first, every lexicon term lies in one
of ``per_scale`` subsets; each further rate keeps half of the terms.  Sparse
subsets stay equal under large edits of long documents, dense ones tell short
documents apart.  The likeness of two fingerprints is, at the rate where it is
largest, the share of equal hashes among the subsets that hold a term of either
document.

Everything is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 20021


@dataclass(frozen=True)
class Band:
    """The band of document shares (idf = -ln share) and the subsets."""

    least_share: float = 0.015
    most_share: float = 0.15
    scales: int = 4
    per_scale: int = 32
    #: With fewer lexicon terms than this, all terms of the text are used.
    least_terms: int = 8
    #: A rate counts where at least so many subsets are in use.
    least_used: int = 4


def term_hashes(text: Column) -> Column:
    """Distinct terms of a text (lower case, cut at white space and punctuation), hashed."""
    parts = F.filter(F.split(F.lower(text), r"[\s\p{Punct}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(parts, lambda t: F.xxhash64(t, F.lit(SEED))))


def lexicon(docs: DataFrame, band: Band, text_col: str = "text") -> list[int]:
    """Hashes of the terms in the band, counted over all documents."""
    n = docs.count()
    low, high = math.ceil(n * band.least_share), n * band.most_share
    terms = docs.select(F.explode(term_hashes(F.coalesce(F.col(text_col), F.lit("")))).alias("t"))
    kept = terms.groupBy("t").agg(F.count("*").alias("df")).filter(F.col("df").between(low, high))
    return sorted(r.t for r in kept.select("t").collect())  # bounded: see the module's docstring


def _bits(shift: int, modulus: int, rest: int):
    """Test of a hash's bits from ``shift`` on."""
    return lambda h: F.pmod(F.shiftrightunsigned(h, shift), F.lit(modulus)) == rest


def signatures(df: DataFrame, text: Column, lex: Column, band: Band, out: str) -> DataFrame:
    """Add column ``out``: one hash for each subset, null where it holds no term of the text."""
    kept = [c for c in df.columns]
    df = df.withColumn("_all", term_hashes(text))
    df = df.withColumn("_lex", F.array_intersect("_all", lex))
    df = df.select(*kept, F.array_sort(F.when(F.size("_lex") >= band.least_terms, F.col("_lex"))
                                       .otherwise(F.col("_all"))).alias("_s0"))
    for s in range(1, band.scales):  # each scale keeps half of the one before
        df = df.withColumn(f"_s{s}", F.filter(F.col(f"_s{s - 1}"), _bits(40 + s, 2, 0)))
    subsets = []
    for s in range(band.scales):
        for j in range(band.per_scale):
            subsets.append(F.filter(F.col(f"_s{s}"), _bits(8, band.per_scale, j)))
    df = df.select(*kept, F.array(*subsets).alias("_sets"))
    return df.select(*kept, F.transform("_sets", lambda x: F.when(F.size(x) > 0, F.hash(x))).alias(out))


def likeness(a: Column, b: Column, band: Band) -> Column:
    """Largest share of equal hashes among the used subsets of one rate; 1 if neither uses any."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y)))

    def share(flags: Column, least: int) -> Column:
        used = F.size(F.filter(flags, lambda x: x.isNotNull()))
        return F.when(used >= least, F.size(F.filter(flags, lambda x: x)) / used)

    rates = [share(F.slice(same, k * band.per_scale + 1, band.per_scale), band.least_used) for k in range(band.scales)]
    return F.coalesce(F.greatest(*rates), share(same, 1), F.lit(1.0))


def fingerprint(sig: Column) -> Column:
    """The signature as text: six hexadecimal digits for each subset, dashes if unused."""
    digits = F.transform(sig, lambda x: F.when(x.isNull(), "------").otherwise(
        F.lower(F.lpad(F.hex(F.pmod(x.cast("long"), F.lit(1 << 24))), 6, "0"))))
    return F.concat_ws("", digits)


def bucket_of(value: Column, bounds: list[int]) -> Column:
    """Number of bounds that are not above the value, by a binary search; null: 0."""
    levels = max(1, len(bounds).bit_length())
    padded = F.lit([*bounds, *[(1 << 63) - 1] * ((1 << levels) - 1 - len(bounds))])
    steps = F.lit([1 << k for k in reversed(range(levels))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.element_at(padded, at + step) <= value, at + step).otherwise(at))
    return F.when(value.isNull(), F.lit(0)).otherwise(found)


def with_next(docs: DataFrame, rows_in_bucket: int = 500, most_buckets: int = 1 << 14) -> DataFrame:
    """Give each row the next one's text and signature, by descending id; after the last: the first.

    Ids are cut into ranges of about equal counts and each range is one window.
    The head of the next range stands in as a row after a range's last one.
    Needs columns ``doc_id, text, sig``; adds ``next_text, next_sig``.
    """
    n = docs.count()
    cuts = min(most_buckets, -(-n // rows_in_bucket))
    bounds: list[int] = []
    if cuts > 1:
        shares = [k / cuts for k in range(1, cuts)]
        found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * cuts)).alias("q")).first().q
        bounds = sorted(set(found or []))
    docs = docs.withColumn("_b", bucket_of(F.col("doc_id"), bounds))
    heads = {r["_b"]: r["id"] for r in docs.groupBy("_b").agg(F.max("doc_id").alias("id")).collect()}
    order = sorted(heads, reverse=True)  # at most ``most_buckets`` ranges
    goes_to = {heads[b]: order[k - 1] for k, b in enumerate(order)}  # the first head goes after the last range
    ids = [i for i in goes_to if i is not None]
    ghost = docs.filter(F.col("doc_id").isin(ids) if ids else F.col("doc_id").isNull())
    if None in goes_to and ids:
        ghost = ghost.unionByName(docs.filter(F.col("doc_id").isNull()))
    places = F.create_map(*[F.lit(x) for i in ids for x in (i, goes_to[i])]) if ids else None
    target = F.coalesce(places[F.col("doc_id")], F.lit(goes_to.get(None, 0))) if ids else F.lit(goes_to.get(None, 0))
    both = docs.withColumn("_ghost", F.lit(0)).unionByName(
        ghost.withColumn("_b", target.cast("int")).withColumn("_ghost", F.lit(1)))
    w = Window.partitionBy("_b").orderBy("_ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    both = both.withColumn("next_text", F.lead("text").over(w)).withColumn("next_sig", F.lead("sig").over(w))
    return both.filter(F.col("_ghost") == 0).drop("_b", "_ghost")


def fingerprints(docs: DataFrame, band: Band = Band(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text, and the text whose last third is taken from the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.  A null text is the empty one, whose fingerprint
    has no subset in use.  Equal texts have equal fingerprints.  Repeated ids are
    ordered by a hash of their texts, null ids come last, a lone document is
    followed by itself, an empty table gives an empty result, and other columns
    are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lex = F.lit(lexicon(rows, band, "text") or [0])
    chained = with_next(signatures(rows, F.col("text"), lex, band, "sig"))
    chained = chained.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    chained = chained.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), cut)))
    chained = chained.select("doc_id", "n_chars", "sig", "next_sig", "edited")
    out = signatures(chained, F.col("edited"), lex, band, "edited_sig")
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      fingerprint(F.col("sig")).alias("fingerprint"),
                      fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
                      likeness(F.col("sig"), F.col("edited_sig"), band).alias("near_edited"),
                      likeness(F.col("sig"), F.col("next_sig"), band).alias("near_next"))
