"""MinHash near-dedup: signature-coordinate inverted join.

Every distinct shingle set is posted under each of its M (coordinate, minimum) pairs.  Two
sets that collide in at least T coordinates are candidates, and candidates are confirmed by
the exact Jaccard similarity of their full shingle sets.  Collisions are counted by prefix
and skip merging: a set's values are ordered by how many sets post them (rarest first), its
T - 1 most frequent lists are skipped, and only the other M - T + 1, the prefix, are merged;
two sets with T collisions share a prefix value.  A value that only one set posts merges
with nothing, so a set with fewer than T shared values never leaves the first count.

Bounds on what is missed: a pair at similarity s collides in Binomial(M, s) coordinates.
With M = 32 and T = 16 a pair at exactly 0.85 has fewer than T collisions with probability
below 1e-6 (tests/llm compute it); pairs above it less.  The similarity and T are parameters
that belong together: 0.8 has the same bound with T = 13.

Groups: equal shingle sets are one class, counted and labelled once.  Within a list, sets
are first compared to one leader each (no list makes more rows than it has members): the one
whose shingles most other sets have too, which of a text's near copies is the text itself, or
the one nearest to it.  Sets found in one component are not compared again.  Only then, the
exact rest: in lists that still hold several components, all pairs across components that
collide T times and whose rare shingles agree as often as those of similar sets must.

Defined results: a null or wordless text has an empty set (n_shingles 0) and is linked with
nothing; a text of fewer words than a shingle has its whole word sequence as its one
shingle; repeated rows are copies; a null id takes part and is never a group's smallest id;
``near_dedup`` keeps one row of each group, with its least id, and all rows without words.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from . import bitmap
from .components import connected_components
from .tables import fresh, tidy, written
from .words import mix, pieces, shingles, signed

WORDS = 5
COORDINATES = 32
MATCHES = 16
#: Similarity at least SIMILAR[0] / SIMILAR[1] unless a caller states another.
SIMILAR = (85, 100)
#: A character of a word: texts without one have an empty set.
WORD = r"[^\x20\x09-\x0D]"
_BLOCK = 1 << 15


@functools.cache
def _coordinates(m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    draw = lambda: rng.integers(0, 1 << 63, m, np.uint64) * np.uint64(2) + np.uint64(1)
    return draw()[:, None], draw()[:, None], draw()


def signature(values: np.ndarray, m: int) -> np.ndarray:
    """The m minima of a set of hashes, each mixed with its coordinate's number."""
    add, times, tag = _coordinates(m)
    least = np.full(m, np.iinfo(np.uint64).max)
    for at in range(0, len(values), _BLOCK):
        np.minimum(least, ((values[None, at: at + _BLOCK] ^ add) * times).min(axis=1), out=least)
    return mix(least ^ tag)


def _digest(values: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.md5(values.tobytes(), usedforsecurity=False).digest(), np.int64).tolist())


def _sign(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    for batch in batches:
        for at, texts in pieces(batch.column(1)):
            n, d1, d2, sigs = [], [], [], []
            for values in shingles(texts, k)[0]:
                n.append(len(values))
                a, b = _digest(values) if len(values) else (None, None)
                d1.append(a)
                d2.append(b)
                sigs.append(signed(signature(values, m)) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(uid, uid + len(n)), pa.int64()), batch.column(0).slice(at, len(n)), pa.array(n, pa.int64()),
                 pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sigs, pa.list_(pa.int64())),
                 *(c.slice(at, len(n)) for c in batch.columns[2:])],
                ["uid", "id", "n", "d1", "d2", "sig", *batch.schema.names[2:]])
            uid += len(n)


def _sets(batches: Iterator[pa.RecordBatch], k: int, wanted: bytes) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the texts whose id's hash passes the bit table."""
    for batch in batches:
        pick = bitmap.test(wanted, batch.column(2).to_numpy().view(np.uint64))
        texts = batch.column(1).filter(pa.array(pick))
        for _, piece in pieces(texts):
            found = [x for x in shingles(piece, k)[0] if len(x)]
            if found:
                d = [_digest(x) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in d], pa.int64()), pa.array([x for _, x in d], pa.int64()),
                     pa.array([signed(x) for x in found], pa.list_(pa.int64()))], ["d1", "d2", "values"])


def _similar(a: str, b: str, both, similar: tuple[int, int]) -> F.Column:
    num, den = similar
    return both * den >= (F.col(a) + F.col(b) - both) * num


def _collide(a: str, b: str, least: int) -> F.Column:
    return F.size(F.array_intersect(F.col(a), F.col(b))) >= least


class CoordinateJoin:
    """One run over a frame of texts; the tables it keeps are written to the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                 m: int = COORDINATES, t: int = MATCHES, similar: tuple[int, int] = SIMILAR, keyed: bool = False):
        self.spark, self.k, self.m, self.t, self.similar = docs.sparkSession, k, m, t, similar
        ensure_checkpoint_dir(self.spark)
        ship_package(self.spark)
        self.texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        key = [text_key("text").alias("text_key")] if keyed else []
        self.rows = written(self.texts.select("*", *key).mapInArrow(
            functools.partial(_sign, k=k, m=m),
            "uid long, id long, n long, d1 long, d2 long, sig array<long>" + ", text_key binary" * keyed), "signatures")
        #: A class for each distinct shingle set: v (its number), least id, size, signature.
        self.classes = written(self.rows.where("n > 0").groupBy("d1", "d2")
                               .agg(F.min("uid").alias("v"), F.min("id").alias("least_id"), F.first("n").alias("n"),
                                    F.first("sig").alias("sig")), "set-classes")

    def candidates(self) -> DataFrame:
        """(v, least_id, n, d1, d2, sig, prefix, top) of the sets with at least t shared values; top
        is the value that most other sets post."""
        posts = self.classes.select("v", F.explode("sig").alias("key"))
        lists = written(posts.groupBy("key").count().where("count > 1"), "lists")
        ordered = (posts.join(lists, "key").groupBy("v")
                   .agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("shared"))
                   .where(F.size("shared") >= self.t))
        prefix = ordered.select("v", F.slice(F.col("shared.key"), F.lit(1), F.size("shared") - (self.t - 1)).alias("prefix"),
                                F.element_at("shared.key", -1).alias("top"))
        return written(self.classes.join(prefix, "v"), "near-candidates")

    def _leaders(self, posts: DataFrame) -> DataFrame:
        """(a, b): each member of a list with the list's leader, where their roots differ and their
        sizes allow the similarity."""
        num, den = self.similar
        lead = posts.groupBy("key").agg(F.min(F.struct("alone", "v", "root", "n")).alias("l"),
                                        F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
        lead = written(lead.select("key", F.col("l.v").alias("lv"), F.col("l.root").alias("lroot"), F.col("l.n").alias("ln")), "leaders")
        return (posts.join(lead, "key").where("root <> lroot")
                .where(f"least(n, ln) * {den} >= greatest(n, ln) * {num}")
                .select(F.least("v", "lv").alias("a"), F.greatest("v", "lv").alias("b")))

    def _rare(self, sets: DataFrame) -> DataFrame:
        """(v, rare, alone).  rare: of a set's n shingles, ordered by how many of ``sets`` have them,
        the first n - ceil(s n) + 1 that others have too.  Two sets of the asked similarity s share
        one of them; a set without any is similar to no other and has no row.  alone: the mean of
        1 / count over its shingles, 1 where no other set has any."""
        num, den = self.similar
        each = sets.select("v", F.explode("values").alias("x"))
        ranked = (each.join(each.groupBy("x").count(), "x").groupBy("v")
                  .agg(F.sort_array(F.collect_list(F.struct("count", "x"))).alias("all")))
        first = F.slice("all", F.lit(1), F.size("all") - F.ceil(F.size("all") * F.lit(num) / F.lit(den)).cast("int") + 1)
        alone = F.aggregate("all", F.lit(0.0), lambda total, s: total + 1 / s["count"]) / F.size("all")
        return (ranked.select("v", F.transform(F.filter(first, lambda s: s["count"] > 1), lambda s: s["x"]).alias("rare"),
                              alone.alias("alone")).where(F.size("rare") > 0))

    def _rest(self, posts: DataFrame, cand: DataFrame) -> DataFrame:
        """All pairs of different components in one list whose rare shingles agree in so many that
        the sets can be similar, each made at its first common prefix value."""
        several = posts.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
        left = written(posts.join(several.select("key"), "key").select("key", "v", "root")
                       .join(cand.select("v", "n", "prefix", "rare"), "v"), "several")
        side = lambda x: left.select("key", *(F.col(c).alias(c + x) for c in ("v", "root", "n", "prefix", "rare")))
        num, den = self.similar
        need = F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(num) / F.lit(num + den))
        rest = F.ceil(F.greatest("n_a", "n_b") * F.lit(num) / F.lit(den)) - 1  # at most so many behind the rare ones
        return (side("_a").join(side("_b"), "key")
                .where("v_a < v_b AND root_a <> root_b")
                .where(f"least(n_a, n_b) * {den} >= greatest(n_a, n_b) * {num}")
                .where(F.array_intersect("prefix_a", "prefix_b")[0] == F.col("key"))
                .where(F.size(F.array_intersect("rare_a", "rare_b")) + rest >= need)
                .select(F.col("v_a").alias("a"), F.col("v_b").alias("b")))

    def _confirm(self, pairs: DataFrame, cand: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs that collide t times and are similar by their full sets."""
        num, den = self.similar
        side = lambda frame, key, *cols: frame.select(F.col("v").alias(key), *(F.col(c).alias(f"{c}_{key}") for c in cols))
        close = written(pairs.distinct()
                        .join(side(cand, "a", "n", "sig"), "a").join(side(cand, "b", "n", "sig"), "b")
                        .where(f"least(n_a, n_b) * {den} >= greatest(n_a, n_b) * {num}")
                        .where(_collide("sig_a", "sig_b", self.t))
                        .select("a", "b", "n_a", "n_b"), "close")
        return written(close.join(side(sets, "a", "values"), "a").join(side(sets, "b", "values"), "b")
                       .where(_similar("n_a", "n_b", F.size(F.array_intersect("values_a", "values_b")), self.similar))
                       .select("a", "b"), "near-links")

    def links(self) -> DataFrame:
        """Links (a, b) between classes that hold every component together."""
        cand = self.candidates()
        wanted = bitmap.build(cand.select(F.xxhash64("least_id").alias("h")), "h")
        sets = written(self.texts.select("id", "text", F.xxhash64("id").alias("h"))
                       .mapInArrow(functools.partial(_sets, k=self.k, wanted=wanted), "d1 long, d2 long, values array<long>")
                       .join(cand.select("d1", "d2", "v"), ["d1", "d2"]).select("v", "values")
                       .groupBy("v").agg(F.first("values").alias("values")), "near-sets")
        cand = written(cand.select("v", "n", "sig", "prefix", "top").join(self._rare(sets), "v"), "near-candidates")
        alone = cand.select("v", F.col("v").alias("root"))
        # the lists that most sets of a group share: two pairs a set at most
        wide = F.array_distinct(F.array("top", F.element_at("prefix", -1)))
        found = self._confirm(self._leaders(cand.select("v", "n", "alone", F.explode(wide).alias("key"), F.col("v").alias("root"))),
                              cand, sets)
        for last in (False, True):
            roots = self._roots(alone, found)
            posts = written(cand.select("v", "n", "alone", F.explode("prefix").alias("key")).join(roots, "v"), "posts")
            pairs = self._rest(posts, cand) if last else self._leaders(posts)
            found = found.unionByName(self._confirm(pairs, cand, sets))
        return found

    def _roots(self, alone: DataFrame, found: DataFrame) -> DataFrame:
        """(v, root) of all candidates under the links so far."""
        return (alone.join(connected_components(found).withColumnRenamed("root", "joined"), "v", "left")
                .select("v", F.coalesce("joined", "root").alias("root")))

    def components(self) -> DataFrame:
        """One row per input row: id, n (size of its set), component_id (smallest id of its
        group, its own id where it is linked with nothing) and kept (id = component_id)."""
        roots = connected_components(self.links())
        classes = (self.classes.select("v", "d1", "d2", "least_id").join(roots, "v", "left")
                   .select("d1", "d2", "least_id", "root"))
        groups = classes.where("root IS NOT NULL").groupBy("root").agg(F.min("least_id").alias("group_id"))
        classes = written(classes.join(written(groups, "groups"), "root", "left")
                          .select("d1", "d2", F.coalesce("group_id", "least_id").alias("component_id")), "near-classes")
        return (self.rows.select("id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left")
                .select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
                .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))


    def kept_texts(self) -> DataFrame:
        """One row per group: the (id, text_key) that stays (least id, nulls last, then least key) and
        how many of the group's rows have both."""
        roots = connected_components(self.links())
        group = (self.classes.select("v", "d1", "d2").join(roots, "v", "left")
                 .select("d1", "d2", F.coalesce("root", "v").alias("group")))
        same = (self.rows.where("n > 0").select("id", "text_key", "d1", "d2").join(group, ["d1", "d2"])
                .groupBy("group", "id", "text_key").agg(F.count(F.lit(1)).alias("times")))
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "times"))
        return written(same.groupBy("group").agg(first.alias("l")).select("l.id", "l.text_key", "l.times"), "kept")


def text_key(text: str) -> F.Column:
    """MD5 of a text's bytes (null: null)."""
    return F.unhex(F.md5(F.col(text).cast("string").cast("binary")))


@tidy
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    t: int = MATCHES, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row (see the module's rules)."""
    return (CoordinateJoin(docs, id_col, text_col, t=t, similar=similar).components()
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "kept"))


@tidy
def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               t: int = MATCHES, similar: tuple[int, int] = SIMILAR, repeat_ids: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    Rows are found again by id and text, so that neither null nor repeated ids bring back or
    take along another text.  With ``repeat_ids`` that is all; without it an id is a key of the
    result: of kept groups with the same id one row stays.
    """
    own, key, mark = (fresh(docs, c) for c in ("kept_id", "kept_key", "text_key"))
    kept = CoordinateJoin(docs, id_col, text_col, t=t, similar=similar, keyed=True).kept_texts()
    if not repeat_ids:
        each = kept.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("text_key", "times")).alias("l"))
        kept = kept.where("id IS NULL").unionByName(each.select("id", "l.text_key", "l.times"))
    kept = kept.select(F.col("id").alias(own), F.col("text_key").alias(key), "times")
    worded = F.coalesce(F.col(text_col).cast("string").rlike(WORD), F.lit(False))
    rows = docs.where(worded).withColumn(mark, text_key(text_col))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own)) & (F.col(mark) == F.col(key))
    once = rows.join(kept.where("times = 1").select(own, key), same, "left_semi")
    more = rows.join(kept.where("times > 1").select(own, key), same, "left_semi").dropDuplicates([id_col, mark])
    return once.unionByName(more).drop(mark).unionByName(docs.where(~worded))
