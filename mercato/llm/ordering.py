"""Token ids in training order, as fixed-stride binary shards.

Texts become token ids, cut into sequences of LENGTH (the last one of a text padded).  The
sequences are numbered by (doc_id, MD5 of the text, place in the text), which no split of the
input can change, and a keyed Feistel permutation, walked along its cycles until it falls into
range, gives each number a slot in 0 .. N-1: a random order that needs no shuffle buffer, has
no ties and is known from key and N alone.  A shard is a range of PER_SHARD slots; a task gets
a range of whole shards (WAVES jobs one after the other, each a range of tasks), sorts their
records by slot and writes them by Spark's text writer as records of one size (the separator is the record's last byte), so slot s is at byte
(s mod PER_SHARD) * stride of shard s div PER_SHARD.  A reader can start or resume at any slot
and read on in order.

Texts are tokenised once, into a scratch table of token bytes, bucketed by the task that wrote
a row, so that tokens are not shuffled to be numbered: only (doc_id, MD5, sequences) are put
in order, the first numbers of a task's texts come back as one array a task, and the join with
the table finds its side in place.  The table is removed after the shards are written.  Slots
that would be missing or double are found when reading (gapless slots, checksums).

Record: doc_id, int64 (the least int64: none) | number of the sequence in its text, uint32 |
tokens in it, uint32 | crc32 of the id bytes, uint32 | LENGTH ids, uint16 | newline.

Defined results: null and empty texts have no sequences; repeated rows have sequences of
their own (the order among equal rows makes no difference); rows without an id come first; a
very long text has as many sequences as it needs, and is encoded and cut in one task; an empty
table writes no shards and reads as no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import global_cumsum
from ..session import ensure_checkpoint_dir, remove_path, ship_package
from .tables import folder, tidy, written
from .tokens import END, load, pieces_of
from .words import mix, pieces, text_bytes

LENGTH = 512
PER_SHARD = 4096
KEY = 20240501
ROUNDS = 6
#: Bytes of records that a writing task gets, about.
TASK_BYTES = 64 << 20
#: The shards are written in so many jobs, each a range of them, so that this part of the records
#: is in the shuffle at once; tokens, finished shards and that part are all there is on disk.
WAVES = 6
#: Buckets of the token table at most (Spark's own limit); beyond it a bucket holds several tasks' rows.
MAX_BUCKETS = 100_000
_NONE = -(1 << 63)
_HEAD = np.dtype([("doc_id", "<i8"), ("number", "<u4"), ("n", "<u4"), ("crc", "<u4")])


def record_type(length: int) -> np.dtype:
    return np.dtype([*((x, _HEAD[x]) for x in _HEAD.names), ("ids", "<u2", (length,)), ("end", "u1")])


def permute(index: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """Slots of the numbers ``index`` in a keyed permutation of 0 .. total-1."""
    half = max(1, (max(2, total) - 1).bit_length() + 1 >> 1)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = np.array(index, np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        x = left << shift | right
        out[todo] = x
        todo = todo[x >= np.uint64(total)]
    return out.astype(np.int64)


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: bytes, length: int) -> Iterator[pa.RecordBatch]:
    """Texts with tokens, as token bytes: the task, the row in it from 1, id, MD5, sequences, tokens."""
    coder, part, at = pieces_of(vocabulary), TaskContext.get().partitionId(), 0
    for batch in batches:
        for row, texts in pieces(batch.column(2)):
            tokens = [coder.encode(text) if text else b"" for text in texts.to_pylist()]
            n = -(-np.array([len(x) // 2 for x in tokens], np.int64) // length)
            some = pa.array(n > 0)
            made = pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(texts)), batch.column(1).slice(row, len(texts)), pa.array(n), pa.array(tokens, pa.binary())],
                ["id", "hash", "n", "tokens"]).filter(some)
            count = len(made)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(count, part, np.int32)), pa.array(at + np.arange(1, count + 1, dtype=np.int64)),
                                              *made.columns], ["part", "row", *made.schema.names])
            at += count


def _records(batches: Iterator[pa.RecordBatch], length: int, total: int, key: int, per_shard: int,
             low: int = 0, high: int | None = None) -> Iterator[pa.RecordBatch]:
    """The records of the slots low .. high-1 (all, if not given)."""
    kind = record_type(length)
    size, high = kind.itemsize, total if high is None else high
    for batch in batches:
        # rows in groups of about 1 MB of tokens, so that a task's memory is bounded
        for row, group in pieces(batch.column(2)):
            starts = batch.column(0).slice(row, len(group)).to_numpy(zero_copy_only=False)
            ids = batch.column(1).slice(row, len(group)).fill_null(_NONE).to_numpy()
            raw, at = text_bytes(group)
            tokens, at = np.frombuffer(raw.tobytes(), "<u2"), at >> 1
            counts = -(-np.diff(at) // length)
            owner = np.repeat(np.arange(len(group)), counts)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            slots = permute(starts[owner] + number, total, key)
            pick = np.flatnonzero((slots >= low) & (slots < high))
            if not len(pick):
                continue
            owner, number, slots = owner[pick], number[pick], slots[pick]
            out = np.zeros(len(pick), kind)
            out["ids"] = END
            out["doc_id"] = ids[owner]
            out["number"] = number
            first = at[owner] + number * length
            out["n"] = np.minimum(length, at[owner + 1] - first)
            for x, a, n in zip(out["ids"], first.tolist(), out["n"].tolist()):
                x[:n] = tokens[a: a + n]
            out["crc"] = [zlib.crc32(x) for x in out["ids"]]
            raw = out.view(np.uint8).reshape(len(out), size)[:, :-1].tobytes()  # the writer adds the last byte
            bounds = np.arange(len(out) + 1, dtype=np.int32) * (size - 1)
            lines = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([pa.array(slots // per_shard), pa.array(slots), lines], ["shard", "slot", "record"])


def buckets(spark: SparkSession, tasks: int) -> int:
    """Buckets for a table written by so many tasks: not fewer than a shuffle has partitions, as
    a join would then rather shuffle both sides than keep the table's buckets."""
    shuffled = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions")
    return min(MAX_BUCKETS, max(tasks, int(shuffled)))


def numbered(coded: DataFrame) -> DataFrame:
    """Per task of the token table the first sequence number of each of its rows, as an array
    in the order of the rows (a task's rows are bounded by its split of the input)."""
    narrow = coded.select("part", "row", "id", "hash", "n")
    upto = global_cumsum(narrow, [F.col(c).asc_nulls_first() for c in ("id", "hash", "part", "row")], F.col("n"), "upto")
    first = F.struct("row", (F.col("upto") - F.col("n")).alias("start"))
    return upto.groupBy("part").agg(F.sort_array(F.collect_list(first)).getField("start").alias("starts"))


@tidy
def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 per_shard: int = PER_SHARD, key: int = KEY, vocabulary: bytes | None = None) -> int:
    """Write the shards below ``path`` (one file in each ``shard=K``); the number of sequences."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    vocabulary = vocabulary or load()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(F.col(text_col).cast("string"))).alias("hash"),
                        F.col(text_col).cast("string").alias("text"))
    name, place = f"tokens_{uuid.uuid4().hex}", folder(spark, "tokens")
    coded = texts.mapInArrow(functools.partial(_encode, vocabulary=vocabulary, length=length),
                             "part int, row long, id long, hash binary, n long, tokens binary")
    # all rows of a task go to one bucket, so this write shuffles nothing and makes one file a task
    (coded.write.bucketBy(buckets(spark, texts.rdd.getNumPartitions()), "part").option("path", place)
     .option("compression", "zstd").format("parquet").saveAsTable(name))
    try:
        coded = spark.table(name)
        total = coded.agg(F.sum("n")).first()[0] or 0
        if total:
            starts = written(numbered(coded), "starts")
            # the arrays are the side to build a table of, so that token rows stream past it unsorted
            rows = coded.join(starts.hint("shuffle_hash"), "part").select(F.element_at("starts", F.col("row").cast("int")).alias("start"), "id", "tokens")
            shards = -(-total // per_shard)
            wave = -(-shards // WAVES)  # shards a job
            each = max(1, TASK_BYTES // (per_shard * record_type(length).itemsize))  # shards a task, fewer where cores would idle
            each = max(1, min(each, wave // spark.sparkContext.defaultParallelism))
            for first in range(0, shards, wave):
                last = min(shards, first + wave)
                records = rows.mapInArrow(functools.partial(_records, length=length, total=total, key=key, per_shard=per_shard,
                                                            low=first * per_shard, high=last * per_shard),
                                          "shard long, slot long, record binary")
                ranges = records.repartitionById(-(-(last - first) // each), F.expr(f"(shard - {first}) div {each}").cast("int"))
                (ranges.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("record"))
                 .write.mode("append").partitionBy("shard").option("lineSep", "\n").text(path))
    finally:
        spark.sql(f"DROP TABLE {name}")
        remove_path(spark, place)
    return total


SCHEMA = "slot long, doc_id long, number long, n long, crc long, ids array<int>"


def _parse(batches: Iterator[pa.RecordBatch], length: int, per_shard: int, start: int, stop: int, tokens: bool) -> Iterator[pa.RecordBatch]:
    kind = record_type(length)
    for batch in batches:
        for i in range(len(batch)):
            first = batch.column(0)[i].as_py() * per_shard
            data = batch.column(1)[i].as_buffer()
            n = len(data) // kind.itemsize
            if n * kind.itemsize != len(data):
                raise ValueError(f"the shard of slot {first} has a broken record")
            low, high = max(0, start - first), min(n, stop - first)
            if high <= low:
                continue
            rows = np.frombuffer(data, kind, high - low, low * kind.itemsize)
            if (rows["end"] != 10).any() or any(zlib.crc32(x.tobytes()) != c for x, c in zip(rows["ids"], rows["crc"].tolist())):
                raise ValueError(f"the shard of slot {first} has a broken record")
            ids = rows["doc_id"]
            flat = pa.array(rows["ids"].ravel().astype(np.int32)) if tokens else pa.array([], pa.int32())
            at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (length if tokens else 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(first + low, first + high)), pa.array(ids, mask=ids == _NONE), pa.array(rows["number"].astype(np.int64)),
                 pa.array(rows["n"].astype(np.int64)), pa.array(rows["crc"].astype(np.int64)), pa.ListArray.from_arrays(at, flat)],
                [x.split()[0] for x in SCHEMA.split(", ")])


def read_shards(spark: SparkSession, path: str, total: int, start: int = 0, stop: int | None = None, length: int = LENGTH,
                per_shard: int = PER_SHARD, tokens: bool = True) -> DataFrame:
    """Records of the slots start .. stop-1, in shard files; only the shards they lie in are read."""
    if total == 0:
        return spark.createDataFrame([], SCHEMA)
    stop = total if stop is None else stop
    files = spark.read.format("binaryFile").option("basePath", path).load(f"{path}/shard=*")
    inside = files.where((F.col("shard") >= start // per_shard) & (F.col("shard") <= (stop - 1) // per_shard))
    return inside.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(
        functools.partial(_parse, length=length, per_shard=per_shard, start=start, stop=stop, tokens=tokens), SCHEMA)
