"""Mixing sources to target weights.

Tokens are added up per source; each source's share of all tokens follows its weight, up to
``MOST`` repetitions of the source, and what a full source can't take goes to the others by
weight until none is above its limit.  A document of a source with repetition rate r is
emitted floor(r) times, plus once more when a hash of its id, seeded, falls below the
fraction: a Bernoulli copy that reruns repeat.

Rates reach the documents by a join on the source.  Its other side has one row a source; it
is broadcast while it is measured to be small, else AQE splits a hot source.

Sources are ranked and levelled without gathering them: ranks by range partitions, the level
by a few rounds of sums over the sources that still have room.

Defined results: null and wordless texts have size 0 and are emitted like the rest of their
source; a source whose texts are all empty has target 0 and takes nothing; null is a source
of its own, ranked last; repeated rows and rows without an id are decided by id (and text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import global_rank
from ..session import ensure_checkpoint_dir
from .tables import fresh, lookup

#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: No document is emitted more often than this.
MOST = 3
SEED = "mix-1"
TOKEN = r"[^\x20\x09-\x0D]+"


def tokens(text: str) -> Column:
    """Number of white-space separated words (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long")


def draw(id_col: str, text_col: str | None = None, seed: str = SEED) -> Column:
    """A number in [0, 1) from a hash of the seed and the id (the text where there is no id)."""
    key = F.col(id_col).cast("string")
    if text_col:
        key = F.coalesce(key, F.concat(F.lit("-"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key, F.lit("-")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sized: DataFrame, source_col: str = "source", size_col: str = "size",
            weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows with a source and a size."""
    ensure_checkpoint_dir(sized.sparkSession)
    totals = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size")).checkpoint()
    ranked = global_rank(totals.withColumn("last", F.col("source").isNull()), [F.col("last"), F.col("source")], "place")
    place = F.pmod(F.col("place") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (place + 1).cast("int")).cast("long")
    shares = ranked.select("source", "source_size", weight.alias("w")).checkpoint()
    total, room, taken = None, None, 0
    full = F.lit(False)
    while True:  # ends when a round fills no more sources: at most one round a source
        row = shares.agg(F.sum("source_size").alias("t"), F.sum(F.when(full, 0).otherwise(F.col("w"))).alias("w"),
                         F.sum(F.when(full, F.col("source_size") * most).otherwise(0)).alias("taken"),
                         F.count_if(full).alias("n")).first()
        if total == (row["t"], row["w"], row["taken"], row["n"]) or not row["w"]:
            break
        total, room, taken = (row["t"], row["w"], row["taken"], row["n"]), row["w"], row["taken"]
        # above its limit at the present level: most * size < w * (t - taken) / room
        full = full | (F.col("source_size").cast("decimal(38,0)") * (most * room) < F.col("w").cast("decimal(38,0)") * (row["t"] - taken))
    if total is None or not room:
        level = F.lit(0.0)
    else:
        level = (F.col("w") * F.lit(total[0] - taken)).cast("double") / F.lit(float(room))
    limit = (F.col("source_size") * most).cast("double")
    return shares.select("source", "source_size", F.when(full, limit).otherwise(level).alias("target"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies."""
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), tokens(text_col).alias("size"),
                        draw(id_col, text_col, seed).alias("draw")).checkpoint()
    goal = targets(sized, weights=weights, most=most).checkpoint()
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    with_goal = sized.join(lookup(goal.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of")))
    whole = F.floor("rate")
    return (with_goal.withColumn("rate", rate)
            .select("doc_id", "source", "size", "source_size", "target", "rate",
                    (whole + F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)).cast("int").alias("copies")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each row of ``docs``, with all its columns, as often as it is to be
    taken.  Rates go to the documents by source, so texts are read once more and never shuffled
    by id; the join's other side has one row a source."""
    goal = targets(docs.select(F.col(source_col).alias("source"), tokens(text_col).alias("size")),
                   weights=weights, most=most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    of, at, copy = (fresh(docs, c) for c in ("mix_source", "mix_rate", "mix_copy"))
    goal = goal.select(F.col("source").alias(of), rate.alias(at)).checkpoint()
    whole = F.floor(at)
    times = (whole + F.when(draw(id_col, text_col, seed) < F.col(at) - whole, 1).otherwise(0)).cast("int")
    return (docs.join(lookup(goal), F.col(source_col).eqNullSafe(F.col(of)))
            .withColumn(at, times).where(F.col(at) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(at))))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
