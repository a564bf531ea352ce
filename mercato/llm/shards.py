"""Sharding: balanced label propagation under capacity quotas (DataFrame operations only).

Every linked row starts in a shard dealt by a hash.  In each round rows that share a link (by
default: rows of equal text) are tallied per link and shard; a row wants to move to the
shard that holds most of what it is linked with, among the shards with room (where none of
these is better than its own, among the full ones, for an exchange).  Wishes from
shard a to b are granted, largest gain first, up to what b's rows want to send to a plus
a's part of b's free room, by what is asked: quotas that keep sizes even while links close up.
Room is an even share of all bytes less the linked rows there: unlinked rows are dealt
last, into what is left.  After that the
remaining unevenness goes by moving the ends of the shards, where unlinked rows stand, so
that shard sizes differ by about a row.

A link of any size is a set of member rows, tallied with map-side sums; links are never
expanded into pairs, and a link that holds a third of all rows is split over as few shards as
its size allows.  Quotas live in frames of at most shards^2 x 64 rows.

Defined results: a null text has size 1 (no bytes plus 1) and no link; empty texts are equal
texts; repeated rows are linked rows like others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .tables import fresh, tidy, written

SHARDS = 8
ROUNDS = 8
#: Room above an even share of the linked rows that propagation may use at least.
SLACK = 0.1
#: A shard with less room than this part of an even share counts as full.
FULL = 0.01


def text_size(text: str) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def _unit(*keys) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(rows: DataFrame, members: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """rows (v, size), members (v, link) -> (v, size, shard); v unique, null links ignored."""
    state = rows.select("v", "size", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"))
    members = members.where("link IS NOT NULL").select("v", "link").distinct()
    lists = written(members.groupBy("link").count().where("count > 1").select("link"), "lists")
    members = written(members.join(lists, "link"), "members")
    if members.isEmpty():
        return state
    linked = members.select("v").distinct()
    moving = written(state.join(linked, "v", "left_semi"), "moving")
    total, bound = state.agg(F.sum("size")).first()[0], moving.agg(F.sum("size")).first()[0]
    share = total / shards
    roof = max(share * (1 - FULL), bound / shards * (1 + SLACK))
    every = rows.sparkSession.range(0, shards, 1, 1).select(F.col("id").cast("int").alias("shard"))
    for turn in range(rounds):
        # shards rows; these and asked (<= shards^2 x 63 rows) are worked on in one partition, without shuffles
        load = written(moving.groupBy("shard").agg(F.sum("size").alias("load")), "load").coalesce(1)
        load = (every.join(load, "shard", "left")
                .select(F.col("shard").alias("to"), F.greatest(F.lit(0.0), F.lit(roof) - F.coalesce("load", F.lit(0))).alias("room"))
                .withColumn("open", F.col("room") > share * FULL))
        placed = members.join(moving, "v")
        # what each link holds in each shard; a part below 1/2 orders equal counts alike for all its members
        tally = written(placed.groupBy("link", "shard").count()
                        .select("link", F.col("shard").alias("to"), (F.col("count") + _unit("link", "shard") / 2).alias("n"))
                        .join(F.broadcast(load.select("to", "open")), "to").select("link", "to", "n", "open"), "tally")
        score = placed.join(tally, "link").groupBy("v", "size", "shard", "to", "open").agg(F.sum("n").alias("n"))
        wish = written(
            score.groupBy("v", "size", "shard")
            .agg(F.max(F.struct("n", "to")).alias("any"), F.max(F.when(F.col("open"), F.struct("n", "to"))).alias("free"),
                 F.max(F.when(F.col("to") == F.col("shard"), F.col("n"))).alias("own"))
            .withColumn("best", F.when(F.col("free.n") > F.col("own"), F.col("free")).otherwise(F.col("any")))
            .where(F.col("best.n") > F.col("own"))
            .select("v", "size", "shard", F.col("best.to").alias("to"),
                    F.greatest(F.lit(0), F.least(F.lit(62), F.floor(F.log2(F.col("best.n") - F.col("own") + 1)))).cast("int").alias("gain")), "wish")
        if wish.isEmpty():  # nor will any later round have a wish
            break
        asked = written(wish.groupBy("shard", "to", "gain").agg(F.sum("size").alias("bytes")), "asked").coalesce(1)
        flow = asked.groupBy("shard", "to").agg(F.sum("bytes").alias("flow"))
        back = flow.select(F.col("to").alias("shard"), F.col("shard").alias("to"), F.col("flow").alias("back"))
        inflow = flow.groupBy("to").agg(F.sum("flow").alias("inflow"))
        larger = Window.partitionBy("shard", "to").orderBy(F.desc("gain")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        grant = (asked.withColumn("until", F.sum("bytes").over(larger))
                 .join(flow, ["shard", "to"]).join(back, ["shard", "to"], "left").join(inflow, "to").join(load, "to")
                 .select("shard", "to", "gain", ((F.coalesce("back", F.lit(0)) + F.col("room") * F.col("flow") / F.col("inflow")
                                                  - (F.col("until") - F.col("bytes"))) / F.col("bytes")).alias("part"))
                 .where("part > 0"))
        moved = (wish.join(F.broadcast(grant), ["shard", "to", "gain"])
                 .where(_unit("v", F.lit(turn)) < F.col("part")).select("v", "to"))
        moving = written(moving.join(moved, "v", "left")
                         .select("v", "size", F.coalesce("to", "shard").alias("shard")), "moving")
    held = {r["shard"]: r["load"] for r in moving.groupBy("shard").agg(F.sum("size").alias("load")).collect()}  # a number a shard
    fixed = rows.select("v", "size").join(linked, "v", "left_anti")
    free = [max(0.0, share - held.get(shard, 0)) for shard in range(shards)]
    fixed = level(fixed, [F.xxhash64("v"), F.col("v")], shards, free) if sum(free) else state.join(linked, "v", "left_anti")
    return fixed.select("v", "size", "shard").unionByName(moving)


def level(rows: DataFrame, order: list[Column], shards: int = SHARDS, parts_of: list[float] | None = None) -> DataFrame:
    """Cut ``rows`` (with a column size), in the given unique order, into runs of equal size, or
    of sizes in proportion to ``parts_of`` (a number a shard); adds shard and slot (place in the shard, from 0).  Range partitions are summed, then
    each partition adds up its own rows: no task sees them all."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = rows.columns
    frozen = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    sums = frozen.groupBy("_pid").agg(F.sum("size").alias("_bytes"))  # one row a partition
    running = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sums.select("_pid", (F.sum("_bytes").over(running) - F.col("_bytes")).alias("_before"),
                          F.sum("_bytes").over(Window.partitionBy()).alias("_total"))
    inside = Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_before") + F.sum("size").over(inside) - F.col("size") / 2
    if parts_of is None:
        shard = F.least(F.lit(shards - 1), F.floor(F.col("_middle") * shards / F.col("_total")))
    else:  # behind how many of the inner cuts the row's middle stands
        last = max(i for i, x in enumerate(parts_of) if x)
        cuts = F.array(*(F.lit(sum(parts_of[:i + 1]) / sum(parts_of)) for i in range(last)), F.lit(2.0))
        place = F.col("_middle") / F.col("_total")
        shard = F.size(F.filter(cuts, lambda c: c <= place))
    cut = written(frozen.join(F.broadcast(offsets), "_pid").withColumn("_middle", middle)
                  .withColumn("shard", shard.cast("int")).drop("_middle"), "cut")
    counts = cut.groupBy("_pid", "shard").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("shard").orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("_pid", "shard", (F.sum("_n").over(earlier) - F.col("_n") - F.col("_first")).alias("_shift"))
    return (cut.join(F.broadcast(starts), ["_pid", "shard"])
            .select(*(c for c in cols if c not in ("shard", "slot")), "shard", (F.col("_at") + F.col("_shift")).alias("slot")))


def assign(rows: DataFrame, links: DataFrame | None = None, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """rows (v, size, link), v unique -> the same with shard and slot.  ``links`` (v, link) may
    give rows several links; without it the column link is the one there is."""
    ensure_checkpoint_dir(rows.sparkSession)
    if links is None:
        links = rows.select("v", "link")
    placed = (rows.join(propagate(rows.select("v", "size"), links, shards, rounds).select("v", "shard"), "v"))
    # unlinked rows stand at both ends of a shard, so that levelling moves them first
    several = links.where("link IS NOT NULL").groupBy("link").count().where("count > 1").select("link")
    bound = links.join(several, "link").groupBy("v").agg(F.min("link").alias("bound"))
    ends = F.when(F.col("bound").isNotNull(), 1).otherwise(F.pmod(F.xxhash64("v", F.lit("end")), F.lit(2)) * 2)
    ordered = placed.join(bound, "v", "left").withColumn("_end", ends)
    return level(ordered, [F.col(c) for c in ("shard", "_end", "bound", "v")], shards).drop("_end", "bound")


@tidy
def equal_text_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot; linked: equal texts."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("v"), F.col(id_col).alias("doc_id"), text_size(text_col).alias("size"),
        F.crc32(F.encode(F.col(text_col), "UTF-8")).alias("text_crc32"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("link")), "shard-rows")
    return assign(rows, shards=shards).select("doc_id", "size", "text_crc32", "shard", "slot")


@tidy
def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """``docs`` with the columns shard and slot (columns of these names are replaced)."""
    kept = docs.drop("shard", "slot")
    own = fresh(docs, "row_number")
    table = written(kept.withColumn(own, F.monotonically_increasing_id()), "shard-rows")
    rows = written(table.select(F.col(own).alias("v"), text_size(text_col).alias("size"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("link")), "shard-sizes")
    places = written(assign(rows, shards=shards).select(F.col("v").alias(own), "shard", "slot"), "places")
    return table.join(places, own).drop(own)
