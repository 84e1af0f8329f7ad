"""Operator 11: token ids in files of canonical length-limited Huffman codes.

``write`` tokenises documents in ascending id order, counts all ids, derives one code
from the global counts (package-merge under ``Format.most_bits``, canonical by
length and id) and writes segments of consecutive documents.  ``read`` decodes them
with one look-up of ``most_bits`` bits for each id.

The folder of a data set has two tables in Parquet containers, so every store that
Spark reads and writes will do:

``code``      one row: ``ids`` and ``bits``, the code length of each id that occurs, and
              the columns of ``segments``.  Canonical codes follow from the lengths alone.
``segments``  ``first`` (number of the first id in the data set), ``documents``,
              ``sizes`` (their ids) and ``body``.  One folder ``part=...`` for each range
              of documents; folders, and rows by ``first``, are in document order.

A segment's body is binary, little-endian:

    4 bytes   ``HUF1``
    uint32    ids of a block, uint32 blocks, uint64 ids
    uint64    for each block the bit at which it begins, counted from the bit stream's start
    bytes     the bit stream, most significant bit first, and 4 zero bytes

A block holds the codes of a fixed number of ids and can be decoded alone from its
checkpoint; ``decode`` takes the blocks of many segments in step, one id of each at
a time.  A document is never cut, so a segment is as long as one long text at most
beyond ``Format.segment_ids``.

Texts are range-partitioned by id and then by a hash, so rows with one id, null ones
too, are spread over tasks.  The number of ids before a task's first document is
a sum over one row for each task.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .bpe import slice_encoder
from .corpus_io import shared_dir, small_batches, written

MAGIC = b"HUF1"
HEAD = np.dtype([("magic", "S4"), ("block", "<u4"), ("blocks", "<u4"), ("ids", "<u8")])


@dataclass(frozen=True)
class Format:
    """Longest code, ids of a block, ids after which a segment ends, and the id that ends a document."""

    most_bits: int = 18
    block_ids: int = 256
    segment_ids: int = 1 << 14
    end_id: int = 2


# --- the code -------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, most_bits: int) -> np.ndarray:
    """Lengths of an optimal prefix code with at most ``most_bits`` bits, by package-merge; counts are positive.

    Of equal weights, ids come before packages and lesser places before greater ones.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << most_bits:
        raise ValueError(f"{n} ids do not fit into codes of {most_bits} bits")
    order = np.argsort(counts, kind="stable")
    own = counts[order].astype(np.float64)
    level, is_own = own, [np.ones(n, bool)]
    for _ in range(most_bits - 1):
        packages = level[0:len(level) // 2 * 2:2] + level[1:len(level) // 2 * 2:2]
        both = np.concatenate((own, packages))
        sort = np.argsort(both, kind="stable")
        level = both[sort]
        is_own.append(sort < n)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for flags in reversed(is_own):
        mine = int(flags[:take].sum())
        lengths[order[:mine]] += 1
        take = 2 * (take - mine)
    return lengths


def canonical(ids: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids by (length, id), their lengths and their codes: each code is the one before it plus 1, shifted."""
    order = np.lexsort((ids, bits))
    ids, bits = ids[order], bits[order].astype(np.int64)
    if len(ids) == 0:
        return ids, bits, np.zeros(0, np.int64)
    longest = int(bits[-1])
    share = np.int64(1) << (longest - bits)
    return ids, bits, (np.cumsum(share) - share) >> (longest - bits)


class Codec:
    """Encoder and decoder of one code."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray, form: Format):
        self.form = form
        ids, bits, codes = canonical(np.asarray(ids, np.int64), np.asarray(bits, np.int64))
        top = int(ids.max()) + 1 if len(ids) else 0
        self.bits = np.zeros(top, np.int64)
        self.code = np.zeros(top, np.uint64)
        self.bits[ids], self.code[ids] = bits, codes
        # every sequence of ``width`` bits begins with one code
        self.width = int(bits.max()) if len(bits) else 1
        share = np.int64(1) << (self.width - bits)
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.taken = np.ones(1 << self.width, np.uint8)
        self.symbol[:int(share.sum())] = np.repeat(ids, share)
        self.taken[:int(share.sum())] = np.repeat(bits, share)

    def encode(self, ids: np.ndarray) -> bytes:
        """The body of a segment."""
        size = self.bits[ids]
        end = np.cumsum(size)
        begin = end - size
        blocks = -(-len(ids) // self.form.block_ids)
        head = np.array([(MAGIC, self.form.block_ids, blocks, len(ids))], HEAD)
        stream = np.zeros((int(end[-1]) + 7 >> 3 if len(ids) else 0) + 4, np.uint8)
        # a code lies in at most four bytes; codes share bytes, never bits, so their parts add up
        word = (self.code[ids] << (32 - size - (begin & 7)).astype(np.uint64)).astype(np.uint64)
        for k in range(4):
            part = (word >> np.uint64(24 - 8 * k)) & np.uint64(255)
            some = np.flatnonzero(part)
            stream += np.bincount((begin[some] >> 3) + k, part[some].astype(np.float64), len(stream)).astype(np.uint8)
        return head.tobytes() + begin[::self.form.block_ids].astype("<u8").tobytes() + stream.tobytes()

    def decode(self, bodies: list[bytes]) -> list[np.ndarray]:
        """The ids of each segment; the blocks of all of them advance in step."""
        streams, at, left, sizes, base = [], [], [], [], 0
        for body in bodies:
            head = np.frombuffer(body, HEAD, 1)[0]
            if head["magic"] != MAGIC:
                raise ValueError("not a segment of Huffman codes")
            block, blocks, n = int(head["block"]), int(head["blocks"]), int(head["ids"])
            marks = np.frombuffer(body, "<u8", blocks, HEAD.itemsize).astype(np.int64)
            streams.append(np.frombuffer(body, np.uint8, offset=HEAD.itemsize + 8 * blocks))
            at.append(marks + 8 * base)
            left.append(np.minimum(block, n - block * np.arange(blocks)))
            sizes.append(n)
            base += len(streams[-1])
        if not sum(sizes):
            return [np.zeros(0, np.uint32) for _ in sizes]
        raw = np.concatenate(streams).astype(np.uint32)
        window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        place, todo = np.concatenate(at), np.concatenate(left)
        longest = int(todo.max())
        out = np.zeros((len(todo), longest), np.uint32)
        shift = np.uint32(32 - self.width)
        order = np.argsort(-todo, kind="stable")  # blocks that end early leave from the back
        place, running = place[order], len(order)
        ends = todo[order]
        for step in range(longest):
            while ends[running - 1] <= step:
                running -= 1
            now = place[:running]
            seen = (window[now >> 3] << (now & 7).astype(np.uint32)) >> shift
            out[order[:running], step] = self.symbol[seen]
            now += self.taken[seen]
        ids = out[np.arange(longest) < todo[:, None]]
        return np.split(ids, np.cumsum(sizes)[:-1])


# --- writing --------------------------------------------------------------------------------------

def tokenised(docs: DataFrame, path: str, form: Format, id_col: str, text_col: str) -> DataFrame:
    """Runs of consecutive documents: ``part, nth, before`` (ids of the part before them), ``documents, sizes, ids``.

    ``ids`` has 16 bits for each id where they are enough, else 32.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc"), text.alias("_text"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.withColumn("h", F.xxhash64("_text")).withColumn("row", F.monotonically_increasing_id())
            .repartitionByRange(tasks, "doc", "h", "row").sortWithinPartitions("doc", "h", "row"))
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("nth", T.IntegerType()),
                           T.StructField("before", T.LongType()), T.StructField("documents", T.ArrayType(rows.schema["doc"].dataType)),
                           T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = slice_encoder(path)
        part, nth, before = TaskContext.get().partitionId(), 0, 0
        keys: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            documents, size, ids = pa.concat_arrays(keys), np.concatenate(sizes), np.concatenate(held)
            one = pa.array([0, len(size)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([before], pa.int64()),
                 pa.ListArray.from_arrays(one, documents), pa.ListArray.from_arrays(one, pa.array(size)),
                 pa.array([ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()], pa.binary())], names=schema.names)

        for batch in batches:
            for piece in tv.text_slices(batch, "_text"):
                data, offsets = tv.binary_view(piece.column("_text"))
                ids, size = encoder.encode(data, offsets)
                ids = np.insert(ids, np.cumsum(size), form.end_id)
                keys.append(piece.column("doc"))
                sizes.append(size + 1)
                held.append(ids)
                total += len(ids)
                if total >= form.segment_ids:
                    yield flush()
                    nth, before, total = nth + 1, before + total, 0
                    keys, sizes, held = [], [], []
        if held:
            yield flush()

    return rows.select("doc", "_text").mapInArrow(run, schema)


def _ids_of(body: pa.Scalar, size: pa.Scalar) -> np.ndarray:
    """The ids of a run."""
    raw = body.as_buffer()
    return np.frombuffer(raw, "<u2" if raw.size == 2 * int(size.values.to_numpy().sum()) else "<u4")


def id_counts(runs: DataFrame) -> DataFrame:
    """``id, n`` over all documents; at most one row for each id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for body, size in zip(batch.column("ids"), batch.column("sizes"), strict=True):
                more = np.bincount(_ids_of(body, size), minlength=len(total))
                more[:len(total)] += total
                total = more
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    return runs.select("sizes", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, tokenizer: str, folder: str, form: Format = Format(), id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Encode ``docs`` into ``folder`` (see the module's docstring).

    Documents are in ascending order of ``id_col``, null ids first; rows with one id
    are ordered by a hash of their texts.  A null text counts as the empty one, which
    has the end id alone.  Repeated rows are all kept.  An empty table gives a data
    set without segments.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    runs = written(tokenised(docs, tokenizer, form, id_col, text_col), "huffman-ids")
    counts = id_counts(runs).toPandas().sort_values("id")  # bounded by the vocabulary
    # a vocabulary with more ids than the longest code tells apart takes longer ones
    bits = code_lengths(counts["n"].to_numpy(), max(form.most_bits, (len(counts) - 1).bit_length()))
    layout = T.StructType([T.StructField("first", T.LongType()), T.StructField("documents", runs.schema["documents"].dataType),
                           T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("body", T.BinaryType())])
    codes = [(counts["id"].tolist(), bits.tolist(), layout.json())]
    spark.createDataFrame(codes, "ids array<long>, bits array<long>, layout string").coalesce(1).write.parquet(f"{folder}/code")
    ids = counts["id"].to_numpy()
    doc_type = runs.schema["documents"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("nth", T.IntegerType()),
                           T.StructField("before", T.LongType()), T.StructField("documents", doc_type),
                           T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("body", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ids, bits, form)
        for batch in batches:
            body = [codec.encode(_ids_of(b, n)) for b, n in zip(batch.column("ids"), batch.column("sizes"), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-1]), pa.array(body, pa.binary())],
                                             names=schema.names)

    # ids before each part; one row for each part, so for each task of the first pass
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = runs.select("part", size.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = runs.mapInArrow(run, schema).join(F.broadcast(parts), "part").select(
        "part", (F.col("base") + F.col("before")).alias("first"), "documents", "sizes", "body")
    # a part's runs lie in one file, so nothing is shuffled to keep documents in order
    placed.sortWithinPartitions("part", "first").write.partitionBy("part").parquet(f"{folder}/segments")


# --- reading --------------------------------------------------------------------------------------

def read(spark: SparkSession, folder: str, form: Format = Format(), with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, with ``with_ids``, ``ids`` (little-endian 32-bit) of each document."""
    small_batches(spark)
    code = spark.read.parquet(f"{folder}/code").first()
    symbols, bits = np.array(code.ids, np.int64), np.array(code.bits, np.int64)
    # the folders' names are not read as a column: an empty data set has none
    body = T.StructType.fromJson(json.loads(code.layout))
    segments = spark.read.schema(body).parquet(f"{folder}/segments").select("first", "documents", "sizes", "body")
    fields = [T.StructField("doc_id", body["documents"].dataType.elementType), T.StructField("start", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(symbols, bits, form)
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                some = batch.slice(at, 16)
                decoded = codec.decode([b.as_buffer() for b in some.column("body")])
                for i, ids in enumerate(decoded):
                    size = some.column("sizes")[i].values.to_numpy()
                    documents = some.column("documents")[i].values
                    cut = np.cumsum(size) - size
                    raw = ids.astype("<u4").tobytes()
                    own = [raw[4 * a:4 * (a + b)] for a, b in zip(cut.tolist(), size.tolist(), strict=True)]
                    columns = [documents, pa.array(cut + some.column("first")[i].as_py()), pa.array(size),
                               pa.array([zlib.crc32(o) for o in own], pa.int64())]
                    if with_ids:
                        columns.append(pa.array(own, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return segments.mapInArrow(run, schema)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for a data set that is removed when the application ends."""
    folder = f"{shared_dir(spark)}/corpus/huffman-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return folder
