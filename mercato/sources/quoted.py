"""Quoted CSV read by many tasks, line breaks inside quotes included.

Spark reads CSV with quoted line breaks one file a task, because a task that starts inside a
file can't know whether it starts inside quotes.  Here it can: Spark splits the file into lines
by blocks of bytes, a first pass counts the quotes of each block, and the running sum over a
file's blocks says whether a block starts inside quotes (odd).  With that, each task puts the
lines of its block together to records.  A record that a block's end cuts leaves a tail in its
block and a head in the next one (or several, in a field longer than a block); these pieces, two
a block at most, are put together afterwards.

Quotes inside quoted fields are doubled, so each record holds an even number of them.  A file
whose quotes don't add up, or that is one block anyway, is left to Spark's own reader.  So are
files where each line holds an even number of quotes, line by line and split into blocks: no
line break is inside quotes there, and each line is a record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

WHOLE, HEAD, TAIL = 0, 1, 2
_PIECE = "file string, start long, kind int, first boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))


def block_quotes(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, inside, balanced, plain): of each block of lines, whether it starts inside
    quotes, whether the quotes of its whole file are even in number, and whether Spark's reader by
    lines has the same records: even quotes in each line, no carriage return, no line of blanks
    only (which that reader skips).  One row a block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    plain = (F.col("quotes") % 2 == 0) & ~F.contains("value", F.lit("\r")) & ((F.length("value") == 0) | F.col("value").rlike("[^\\x00-\\x20]"))
    blocks = (_lines(spark, path).withColumn("quotes", quotes).groupBy("file", "start")
              .agg(F.sum("quotes").alias("quotes"), F.min(plain).alias("plain")))
    file = Window.partitionBy("file")
    before = F.sum("quotes").over(file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select("file", "start", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"),
                         (F.sum("quotes").over(file) % 2 == 0).alias("balanced"), "plain")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in file order -> whole records, and the heads and tails that block ends cut off."""
    block, inside, first, held = None, False, False, []

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
                                          [x.split()[0] for x in _PIECE.split(", ")])

    def rest() -> list[tuple]:
        return [(*block, HEAD if inside else TAIL, first, "\n".join(held))] if held else []

    for batch in batches:
        files, starts, within = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_pylist()
        codes = np.unique(np.array(files.to_pylist(), object), return_inverse=True)[1] if len(batch) else np.empty(0, int)
        cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
        rows: list[tuple] = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)] if len(batch) else []):
            now = (files[a].as_py(), int(starts[a]))
            if now != block:
                rows += rest()
                if within[a] is None:
                    raise RuntimeError(f"{now[0]} was split anew between two passes; read it again")
                block, inside, first, held = now, within[a], now[1] == 0, []
            lines = batch.column(3).slice(a, b - a)
            odd = pc.count_substring(lines, '"').to_numpy() % 2
            closed = np.cumsum(np.concatenate(([sum(x.count('"') for x in held) + inside], odd)))[1:] % 2 == 0
            at = 0
            texts = lines.to_pylist()
            for end in (np.flatnonzero(closed) + 1).tolist():
                text = texts[at] if end - at == 1 and not held else "\n".join([*held, *texts[at:end]])
                if text.strip("\r") or inside:
                    rows.append((*block, HEAD if inside else WHOLE, first, text))
                    first = False
                at, held, inside = end, [], False
            held += texts[at:]
        yield out(rows)
    if block is not None:
        yield out(rest())


def records(spark: SparkSession, path: str, blocks: DataFrame) -> DataFrame:
    """(text, first): every record's text, and whether it is its file's first."""
    ship_package(spark)
    # one row for each split of the input, which the driver lists anyway; the lines keep their order
    placed = _lines(spark, path).join(F.broadcast(blocks), ["file", "start"], "left").select("file", "start", "inside", "value")
    pieces = placed.mapInArrow(_pieces, _PIECE)
    whole = pieces.where(F.col("kind") == WHOLE).select("text", "first")
    # a tail opens a record, the heads after it go on with it
    order = Window.partitionBy("file").orderBy("start", "kind")
    cut = (pieces.where(F.col("kind") != WHOLE)
           .withColumn("record", F.count_if(F.col("kind") == TAIL).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
           .groupBy("file", "record")
           .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "text"))).alias("parts"), F.max("first").alias("first"))
           .select(F.array_join("parts.text", "\n").alias("text"), "first"))
    return whole.unionByName(cut)


def read(spark: SparkSession, path: str, schema: str, options: dict[str, str]) -> DataFrame:
    """A CSV file or folder with a header line in each file, by ``schema`` (all text)."""
    ensure_checkpoint_dir(spark)
    _fix_splits(spark)
    blocks = block_quotes(spark, path).checkpoint()
    shape = blocks.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("balanced").alias("balanced"), F.min("plain").alias("plain")).agg(
        F.max("n").alias("most"), F.min("balanced").alias("balanced"), F.min("plain").alias("plain")).first()
    if (shape["most"] or 0) <= 1 or not shape["balanced"]:
        return spark.read.schema(schema).options(header="true", multiLine="true", mode="PERMISSIVE", **options).csv(path)
    if shape["plain"]:
        return spark.read.schema(schema).options(header="true", lineSep="\n", mode="PERMISSIVE", **options).csv(path)
    text = F.regexp_replace("text", "\r$", "")
    return (records(spark, path, blocks).where(~F.col("first"))
            .select(F.from_csv(text, schema, options).alias("r")).select("r.*"))


def _fix_splits(spark: SparkSession) -> None:
    """Keep the cut of files into blocks from changing with the number of live executors."""
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(max(1, spark.sparkContext.defaultParallelism)))
