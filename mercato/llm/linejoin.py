"""Line dedup by an exact set-similarity join.

A line is the set of its words (white-space separated, A-Z lowered).  Lines of equal sets are
one class.  Words are put in one global order, rare ones first; a class posts only its
first n - ceil(0.8 n) + 1 words, which two sets of Jaccard similarity 0.8 must share one
of.  The postings of a word are its list.  Lists are compared inside tasks, in WAVES jobs, under
the length filter and the positional filter (what is left behind the shared word must be able to
reach the needed overlap) and the bit filter (each word sets one of 128 bits of its line: two sets
differ in at least as many words as their bits do, so the words themselves are only moved for
sets that can be similar to another).  Nothing is estimated.

Two ways lead on from there, so that a group of near copies never becomes a row for each pair.
A list with few candidates gives them as pairs (at most DENSE a member), which are verified on
the full sets.  Any other list gives the members that have a candidate, a row each; they meet
again with their words, and the task counts each one's links by a product of their word tables.
A list of more than BLOCK_ROWS members is dealt into cells of two blocks.  Of the dense words that
two similar sets share, only the least counts the pair, and a pair that shares one is not
counted among the sparse ones.

Word frequencies come from a count table of fixed size (2^TABLE counters by hash), summed in
the cluster: equal counters and collisions only make the order less rare, and any order that
all tasks share gives the same result.

A line is removed if an earlier line (by document id, then line number) has similarity 0.8 or
more with it; whether that line stays itself makes no difference.

Defined results: null texts have no lines; a line without words is no line to join and stays;
lines of equal sets match, whatever their size; documents without an id come last; documents
of one id are ordered arbitrarily among themselves.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove_path, ship_package
from . import bitmap
from .tables import folder, fresh, lookup, tidy, written
from .words import NOT_SPACE, find_words, mix, pieces, signed

#: Similarity at least 4/5.
NUM, DEN = 4, 5
TABLE = 21
#: Counters (2^BLOCK) that one row brings to the driver.
BLOCK = 16
#: Postings are compared, and pairs verified, in so many jobs one after the other, each with the words
#: (the first lines) of one remainder of their hash: that part of the rows is in the shuffle at once.
WAVES = 4
#: Members of a list that one task compares with each other; longer ones are cut into blocks.
BLOCK_ROWS = 1024
#: A list with more candidate pairs than so many a member is dense.
DENSE = 8
#: Words of a dense list that are laid out as a table at once.
_WIDE = 1024
PLACE = "struct<no_id: boolean, id: long, u: long, line: int>"
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)


def _lines(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Pieces of lines: each line's text (place), number in it, and the lines."""
    split = pc.split_pattern(texts, "\n")
    counts = pc.list_value_length(split).fill_null(0).to_numpy()
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = split.flatten()
    for at, piece in pieces(flat):
        yield owner[at: at + len(piece)], number[at: at + len(piece)], piece


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.Array]]:
    yield from pieces(batch.column(column))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << TABLE, np.int64)
    for batch in batches:
        for _, texts in _texts(batch, 0):
            h = find_words(texts, NOT_SPACE).hashes()
            total += np.bincount((h & np.uint64((1 << TABLE) - 1)).astype(np.int64), minlength=1 << TABLE)
    some = np.flatnonzero(total)
    for at in range(0, len(some), 1 << 16):
        part = some[at: at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["at", "n"])


def _block(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A block of the count table (at most 2^BLOCK rows) as one row."""
    counts = np.zeros(1 << BLOCK, "<i4")
    at = rows.column("at").to_numpy() & ((1 << BLOCK) - 1)
    counts[at] = np.minimum(rows.column("n").to_numpy(), np.iinfo(np.int32).max)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "counts": pa.array([counts.tobytes()], pa.binary())})


class _Sets:
    """The word sets of a piece of lines: ``place`` the lines that have words, ``words`` each set's
    words once, as hashes in the global order, ``starts`` and ``n`` where they lie."""

    def __init__(self, lines: pa.Array, counts: np.ndarray):
        found = find_words(lines, NOT_SPACE)
        h = found.hashes()
        order = np.argsort(h)
        new = np.ones(len(h), bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        each = h[order[new]]  # ascending
        by_rarity = np.argsort(counts[(each & np.uint64((1 << TABLE) - 1)).astype(np.int64)], kind="stable")
        rank = np.empty(len(each), np.int64)
        rank[by_rarity] = np.arange(len(each))
        at = np.empty(len(h), np.int64)
        at[order] = rank[np.cumsum(new) - 1]
        # (line, rank of the word) as one number: sorted and each once it is all sets of the piece
        both = np.sort(found.doc * max(1, len(each)) + at)
        both = both[np.concatenate(([True], both[1:] != both[:-1]))] if len(both) else both
        line, at = np.divmod(both, max(1, len(each)))
        self.words = each[by_rarity][at]
        self.starts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(line) else line
        self.place = line[self.starts]
        self.n = np.diff(np.append(self.starts, len(line)))
        self._often = counts[(self.words & np.uint64((1 << TABLE) - 1)).astype(np.int64)]

    def _merged(self, merge: np.ufunc, values: np.ndarray) -> pa.Array:
        return pa.array((merge.reduceat(values, self.starts) if len(values) else values).view(np.int64))

    def classes(self) -> list[pa.Array]:
        """Two sums of mixed hashes for each set, the same for equal sets."""
        return [self._merged(np.add, mix(self.words ^ x)) for x in _SEEDS]

    def bits(self) -> list[pa.Array]:
        """128 bits, in two longs, of which each word sets one."""
        bit = np.uint64(1) << (self.words >> np.uint64(57) & np.uint64(63))
        high = self.words >> np.uint64(63) == 1
        return [self._merged(np.bitwise_or, np.where(high == x, bit, np.uint64(0))) for x in (False, True)]

    def first(self, k: np.ndarray, over: int = -1) -> pa.Array:
        """The first k words of each set, those counted more often than ``over``."""
        inside = np.arange(len(self.words)) - np.repeat(self.starts, self.n) < np.repeat(k, self.n)
        inside &= self._often > over
        upto = np.append(0, np.cumsum(inside))[np.append(self.starts, len(inside))]
        return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(signed(self.words[inside])))


def _keys(lines: pa.Array) -> np.ndarray:
    """A hash of each line's bytes (empty: 0)."""
    found = find_words(lines, np.ones(256, bool), lower=False)
    keys = np.zeros(len(lines), np.uint64)
    keys[found.doc] = found.hashes()
    return keys


def _post(batches: Iterator[pa.RecordBatch], counts, long: int) -> Iterator[pa.RecordBatch]:
    """A row per line with words, and one per text (line null, n its number of lines)."""
    u = TaskContext.get().partitionId() << 40
    v = u
    names = ["u", "id", "line", "v", "c1", "c2", "n", "prefix", "common", "bits1", "bits2", "key"]
    for batch in batches:
        for at, texts in _texts(batch, 1):
            ids = batch.column(0).slice(at, len(texts))
            lengths = np.zeros(len(texts), np.int64)
            for owner, number, lines in _lines(texts):
                np.add.at(lengths, owner, 1)
                sets = _Sets(lines, counts.value)
                n = sets.n
                own = owner[sets.place]
                prefix = n - (-(-NUM * n // DEN)) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u + own), ids.take(pa.array(own)), pa.array(number[sets.place].astype(np.int32)), pa.array(v + np.arange(len(n))),
                     *sets.classes(), pa.array(n.astype(np.int32)), sets.first(prefix), sets.first(prefix, long), *sets.bits(),
                     pa.array(signed(_keys(lines)[sets.place]))], names)
                v += len(n)
            none = pa.nulls(len(texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(u, u + len(texts)), pa.int64()), ids, none.cast(pa.int32()), *[none.cast(pa.int64())] * 3,
                 pa.array(lengths, pa.int32()), *[none.cast(pa.list_(pa.int64()))] * 2, *[none.cast(pa.int64())] * 3], names)
            u += len(texts)


def _full(batches: Iterator[pa.RecordBatch], counts, wanted: bytes) -> Iterator[pa.RecordBatch]:
    """Whole sets of the lines whose key passes the bit table."""
    for batch in batches:
        for _, texts in _texts(batch, 0):
            for _, _, lines in _lines(texts):
                lines = lines.filter(pa.array(bitmap.test(wanted, _keys(lines))))
                sets = _Sets(lines, counts.value)
                yield pa.RecordBatch.from_arrays([*sets.classes(), sets.first(sets.n)], ["c1", "c2", "words"])


def _candidates(at: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one list (rows by list, then n) that pass the filters."""
    word, i, j, side, n, pos = (at.column(c).to_numpy() for c in ("word", "i", "j", "side", "n", "pos"))
    bits = [at.column(c).to_numpy().view(np.uint64) for c in ("bits1", "bits2")]
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    new = np.flatnonzero((word[1:] != word[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    ends = np.append(new, len(word))
    end = np.repeat(ends, np.diff(np.append(0, ends)))
    found, x, step = [], np.arange(len(word)), 0
    while len(x):
        step += 1
        x = x[x + step < end[x]]
        x = x[n[x] * DEN >= n[x + step] * NUM]  # n ascends: no later row passes where this one doesn't
        y = x + step
        need = -(-(n[x] + n[y]) * NUM // (NUM + DEN))
        ok = np.minimum(pos[x], pos[y]) + np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need
        ok &= (i[x] == j[x]) | (side[x] != side[y])
        a, b = x[ok], y[ok]
        apart = sum(np.bitwise_count(w[a] ^ w[b]).astype(np.int64) for w in bits)
        ok = apart <= n[a] + n[b] - 2 * need[ok]
        found.append((a[ok].astype(np.int32), b[ok].astype(np.int32)))
    return tuple(np.concatenate([p[k] for p in found]) if found else np.empty(0, np.int32) for k in (0, 1))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by list (word, i, j) and n: the pairs of sparse lists (word null), and of
    dense ones the members (a) that have a candidate."""
    names = ["word", "i", "j", "side", "a", "b"]
    rest = None
    for batch in itertools.chain(batches, [None]):
        here = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if here is None or not len(here):
            continue
        if batch is not None:  # the last list may go on
            key = [here.column(c).to_numpy() for c in names[:3]]
            other = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key]))
            cut = int(other[-1]) + 1 if len(other) else 0
            here, rest = here.slice(0, cut), here.slice(cut)
        if not len(here):
            continue
        x, y = _candidates(here)
        word, i, j, v = (here.column(c).to_numpy() for c in (*names[:3], "v"))
        lists = np.cumsum(np.concatenate(([False], (word[1:] != word[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        dense = np.bincount(lists[x], minlength=lists[-1] + 1) > DENSE * np.bincount(lists)
        dense[lists[here.column("cut").to_numpy(zero_copy_only=False)]] = True
        few = ~dense[lists[x]]
        none = pa.nulls(int(few.sum()))
        yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), *[none.cast(pa.int32())] * 3, pa.array(v[x[few]]), pa.array(v[y[few]])], names)
        some = np.unique(np.concatenate((x[~few], y[~few])))
        yield pa.RecordBatch.from_arrays([*(pa.array(here.column(c).to_numpy()[some]) for c in names[:4]), pa.array(v[some]),
                                          pa.nulls(len(some)).cast(pa.int64())], names)


def _shared(lists: pa.Array) -> np.ndarray:
    """How many values each two of the lists have in common."""
    total = np.zeros((len(lists), len(lists)), np.float32)
    _, at, count = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    number = np.cumsum(count > 1) - 1  # values of one list only are left out
    keep = count[at] > 1
    owner, at = owner[keep], number[at[keep]]
    for low in range(0, int(at.max()) + 1 if len(at) else 0, _WIDE):
        part = (at >= low) & (at < low + _WIDE)
        table = np.zeros((len(lists), _WIDE), np.float32)
        table[owner[part], at[part] - low] = 1
        total += table @ table.T
    return total


def _count_links(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Of each member of a cell of a dense list: how many others there it is similar to, and the
    first place of those; pairs that share a smaller dense word are left to that one's list."""
    word, i, j = (x.as_py() for x in key)
    rows = rows.combine_chunks()
    column = lambda c: rows.column(c).combine_chunks() if len(rows) else rows.column(c)
    n = column("n").to_numpy().astype(np.int64)
    both = _shared(column("words"))
    linked = both * DEN >= (n[:, None] + n[None, :] - both) * NUM
    dense = column("dense")
    owner = np.repeat(np.arange(len(rows)), dense.value_lengths().to_numpy())
    flat = dense.flatten().to_numpy()
    less = flat < word
    at = np.append(0, np.cumsum(np.bincount(owner[less], minlength=len(rows)))).astype(np.int32)
    linked &= _shared(pa.ListArray.from_arrays(pa.array(at), pa.array(flat[less]))) == 0
    np.fill_diagonal(linked, False)
    if i != j:
        side = column("side").to_numpy()
        linked &= side[:, None] != side[None, :]
    place = column("at")
    order = pc.sort_indices(pa.Table.from_arrays(place.flatten(), ["no_id", "id", "u", "line"]),
                            sort_keys=[(c, "ascending") for c in ("no_id", "id", "u", "line")]).to_numpy()
    some = np.flatnonzero(linked.any(axis=1))
    first = order[linked[some][:, order].argmax(axis=1)] if len(some) else some
    return pa.table({"v": column("v").take(pa.array(some)), "other": place.take(pa.array(first)), "links": pa.array(linked.sum(axis=1)[some].astype(np.int64))})


@tidy
def line_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: u (the row's number), id, n_lines, removed (numbers, from 0,
    of the lines that go), n_links (other line sets similar to the row's lines, added up)."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = (texts.select("text").mapInArrow(_count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
             .groupBy(F.shiftright("at", BLOCK).alias("block")).applyInArrow(_block, "block long, counts binary").collect())
    table = np.zeros(1 << TABLE, np.int32)  # fixed size, collected as 2^(TABLE - BLOCK) packed rows
    for row in found:
        table[row["block"] << BLOCK: (row["block"] + 1) << BLOCK] = np.frombuffer(row["counts"], "<i4")
    counts = spark.sparkContext.broadcast(table)
    made = texts.mapInArrow(functools.partial(_post, counts=counts, long=BLOCK_ROWS),
                            "u long, id long, line int, v long, c1 long, c2 long, n int, prefix array<long>, common array<long>, "
                            "bits1 long, bits2 long, key long")
    wide = folder(spark, "wide-lines")  # only until the classes are made
    made.write.option("compression", "zstd").parquet(wide)
    made = spark.read.schema(made.schema).parquet(wide)
    place = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("u").alias("u"), F.col("line").alias("line"))
    classes = (made.where("line IS NOT NULL").groupBy("c1", "c2")
               .agg(F.min("v").alias("v"), F.min(place).alias("at"), F.first("n").alias("n"),
                    F.first(F.struct("prefix", "common", "bits1", "bits2", "key")).alias("words"))
               .select("c1", "c2", "v", "at", "n", "words.*"))
    classes = written(classes, "classes")
    rows = written(made.select("u", "id", "line", "c1", "c2", "n"), "lines")
    remove_path(spark, wide)
    lines = rows.where("line IS NOT NULL")
    posts = classes.select("v", "n", "bits1", "bits2", F.posexplode("prefix").alias("pos", "word"))
    long = classes.select(F.explode("common").alias("word")).groupBy("word").count().where(F.col("count") > BLOCK_ROWS).select("word", F.ceil(F.col("count") / BLOCK_ROWS).alias("blocks"))
    long = lookup(written(long, "long-lists"))
    mine = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    found = []
    for wave in range(WAVES):
        dealt = (posts.where(F.pmod(F.xxhash64("word"), F.lit(WAVES)) == wave).join(long, "word", "left")
                 .select("word", "v", "n", "pos", "bits1", "bits2", F.col("blocks").isNotNull().alias("cut"),
                         F.coalesce(mine, F.lit(0)).alias("side"), other.alias("other"))
                 .select("word", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "v", "n", "pos", "bits1", "bits2", "cut"))
        found.append(written(dealt.repartition("word", "i", "j").sortWithinPartitions("word", "i", "j", "n")
                             .mapInArrow(_compare, "word long, i int, j int, side int, a long, b long"), "found"))
    found = functools.reduce(DataFrame.unionByName, found)
    pairs = found.where("word IS NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    members = found.where("word IS NOT NULL").select("word", "i", "j", "side", F.col("a").alias("v"))
    dense = members.groupBy("v").agg(F.collect_set("word").alias("dense"))
    ends = (pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(dense, "v", "full")
            .select("v", F.coalesce("dense", F.array().cast("array<long>")).alias("dense")))
    cand = written(classes.join(ends, "v").select("v", "c1", "c2", "n", "at", "dense", "key"), "candidates")
    wanted = bitmap.build(cand, "key")
    sets = (texts.select("text").mapInArrow(functools.partial(_full, counts=counts, wanted=wanted), "c1 long, c2 long, words array<long>")
            .groupBy("c1", "c2").agg(F.first("words").alias("words")).join(cand, ["c1", "c2"]).select("v", "n", "words", "at", "dense"))
    sets = written(sets, "sets")
    end = lambda x: sets.select(*(F.col(c).alias(n) for c, n in (("v", x), *((c, f"{c}_{x}") for c in ("words", "at", "dense")))))
    both = F.size(F.array_intersect("words_a", "words_b"))
    links = [pairs.where(F.pmod(F.xxhash64("a"), F.lit(WAVES)) == wave).join(end("a"), "a").join(end("b"), "b")
             .where(~F.arrays_overlap("dense_a", "dense_b"))
             .where(both * DEN >= (F.size("words_a") + F.size("words_b") - both) * NUM).select("a", "b", "at_a", "at_b").checkpoint()
             for wave in range(WAVES)]
    links = functools.reduce(DataFrame.unionByName, links)
    in_lists = members.join(sets, "v").groupBy("word", "i", "j").applyInArrow(_count_links, f"v long, other {PLACE}, links long")
    one = F.lit(1).cast("long").alias("links")
    linked = (links.select(F.col("a").alias("v"), F.col("at_b").alias("other"), one)
              .unionByName(links.select(F.col("b").alias("v"), F.col("at_a").alias("other"), one)).unionByName(in_lists)
              .groupBy("v").agg(F.min("other").alias("other"), F.sum("links").alias("links")))
    known = (classes.select("v", "c1", "c2", "at").join(linked, "v", "left")
             .select("c1", "c2", F.least("at", "other").alias("first"), F.coalesce("links", F.lit(0)).alias("links")).checkpoint())
    judged = (lines.select("u", "line", "c1", "c2", place.alias("here")).join(known, ["c1", "c2"])
              .groupBy("u").agg(F.sort_array(F.collect_list(F.when(F.col("here") > F.col("first"), F.col("line")))).alias("removed"),
                                F.sum("links").alias("n_links")))
    return (rows.where("line IS NULL").select("u", "id", F.col("n").cast("long").alias("n_lines")).join(judged, "u", "left")
            .select("u", "id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines taken out of their texts.  Rows are told apart by a
    number of their own, so repeated ids are no matter."""
    ordered = docs.orderBy(F.col(id_col).asc_nulls_last())  # so that row numbers follow the ids
    row, out = fresh(docs, "row_number"), fresh(docs, "removed")
    table = written(ordered.withColumn(row, F.monotonically_increasing_id()), "line-docs")
    gone = line_matches(table, row, text_col).where(F.size("removed") > 0).select(F.col("id").alias(row), F.col("removed").alias(out))
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains(out, i))
    return (table.join(gone, row, "left")
            .withColumn(text_col, F.when(F.col(out).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
