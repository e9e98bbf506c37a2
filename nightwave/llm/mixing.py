"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Each source is cut into blocks of documents. A source's target weight is an integer share s of a round of Q = sum(s)
slots, so it owes s blocks a round: without given shares it is `slots` times the source's weight (documents ** `power`,
as a part of all), rounded, and at least 1. `slots` grows with the number of sources, `SLOTS` or `PER_SOURCE` each, so
that rounding moves a weight by at most half of 1 / slots; "less than one block" holds to the rounded weight. In a round of c blocks of a source and Q in all, block k (from 1) is released at
floor((k - 1) * Q / c) and due at ceil(k * Q / c); earliest-deadline-first over released blocks fills each slot and
keeps every source less than one block from its target at every slot, and exactly on it at the end of every round.
A source with no block left leaves; the others keep their proportions, so no document is dropped or repeated.

Rounds in which the same sources have the same number of blocks have the same schedule. There are at most two such
runs of rounds for each source, whatever the number of documents: only those are simulated (an `aggregate` over the
slots of one round, a row a run), and every block finds its slot by an equi-join. A document's place within its source
comes from a row number within (source, hash range) plus the sum of the ranges before, so that a source with a third
of all rows is spread over `2 ** range_bits` keys.

Bounds: the work of the schedule is runs * Q * sources, independent of the documents; Q is `slots` plus at most one
slot a source. It is meant for named corpora, some hundreds at most, not for every host as a source of its own. The
schedule meets the blocks in a plain equi-join; one row of run starts and a row a source are broadcast where Spark finds them small. Defined cases: a null source is a source of its own (the empty name is another); documents go by
(hash of doc_id, doc_id), repeated rows in any order; an empty table gives an empty result; unknown sources in
`shares` are ignored, sources without a share get one slot a round; shares below one are an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightwave.llm.common import written

BLOCK_DOCS, SLOTS, PER_SOURCE, POWER, RANGE_BITS = 16, 400, 8, 0.5, 10


def _with_shares(sizes: DataFrame, shares: Mapping[str | None, int] | None, slots: int | None, power: float) -> DataFrame:
    """sizes with an integer `share`: the given one, or in proportion to (documents of the source) ** power."""
    if shares is not None:
        if any(int(v) != v or v < 1 for v in shares.values()):
            raise ValueError("a share is a whole number of blocks a round, at least 1")
        share = F.lit(1).cast("long")
        for name, v in shares.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(int(v)).cast("long")).otherwise(share)
        return sizes.withColumn("share", share)
    every = Window.partitionBy()  # a row a source
    whole = F.sum(F.pow(F.col("n_docs"), F.lit(power))).over(every)
    slots = F.greatest(F.lit(SLOTS), PER_SOURCE * F.count(F.lit(1)).over(every)) if slots is None else F.lit(slots)
    return sizes.withColumn("share", F.greatest(F.lit(1), F.round(slots * F.pow(F.col("n_docs"), F.lit(power)) / whole, 0)).cast("long"))


def _runs(sources: DataFrame) -> DataFrame:
    """A row a run of equal rounds: first_round, base (slots before it), round_slots, quota = array of (source_no, blocks a round)."""
    edges = sources.select(F.explode(F.array(F.lit(0).cast("long"), F.expr("n_blocks div share"), F.expr("(n_blocks + share - 1) div share"))).alias("first_round")).distinct()
    each = edges.crossJoin(sources).withColumn(  # both sides: a few rows a source
        "left_blocks", F.greatest(F.lit(0), F.col("n_blocks") - F.col("first_round") * F.col("share")))
    return (each.groupBy("first_round").agg(
        F.sum(F.least("n_blocks", F.col("first_round") * F.col("share"))).alias("base"),
        F.sum(F.least("share", "left_blocks")).alias("round_slots"),
        F.array_sort(F.collect_list(F.when(F.col("left_blocks") > 0, F.struct("source_no", F.least("share", "left_blocks").alias("blocks"))))).alias("quota"))
        .filter(F.col("round_slots") > 0))


def round_schedule(runs: DataFrame) -> DataFrame:
    """first_round, source_no, k, round_slot, released, due: earliest-deadline-first over one round of each run."""
    done = runs.withColumn("n", F.col("round_slots")).select("*", F.expr("""
        aggregate(
          sequence(cast(0 as bigint), n - 1),
          named_struct('had', transform(quota, q -> cast(0 as bigint)), 'slots', cast(array() as array<struct<i:int,k:bigint,released:bigint,due:bigint>>)),
          (state, t) -> transform(array(array_min(filter(
              transform(quota, (q, i) -> named_struct('due', ((state.had[i] + 1) * n + q.blocks - 1) div q.blocks, 'i', i, 'k', state.had[i] + 1, 'released', state.had[i] * n div q.blocks, 'more', state.had[i] < q.blocks)),
              x -> x.more and x.released <= t))),
            pick -> named_struct('had', transform(state.had, (h, i) -> h + if(i = pick.i, cast(1 as bigint), cast(0 as bigint))),
                                 'slots', concat(state.slots, array(named_struct('i', pick.i, 'k', pick.k, 'released', pick.released, 'due', pick.due)))))[0]
        ).slots AS schedule"""))
    return done.select("first_round", "base", "round_slots", "quota", F.posexplode("schedule").alias("round_slot", "x")).select(
        "first_round", "base", "round_slots", F.expr("quota[x.i].source_no").alias("source_no"), F.col("x.k").alias("k"), "round_slot",
        F.col("x.released").alias("released"), F.col("x.due").alias("due"))


def mix_sources(docs: DataFrame, shares: Mapping[str | None, int] | None = None, block_docs: int = BLOCK_DOCS, slots: int | None = None, power: float = POWER, range_bits: int = RANGE_BITS) -> DataFrame:
    """doc_id, source, source_rank, block, released, due, slot, in_block of every row of docs.

    Reading documents by (slot, in_block) is the mixture. released <= slot < due, in slots from the start of the mixture.
    """
    keyed = docs.select("doc_id", "source", F.xxhash64("doc_id").alias("h")).withColumn("range", F.shiftright("h", 64 - range_bits))
    counts = written(keyed.groupBy("source", "range").count(), "ranges")
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    sizes = _with_shares(counts.groupBy("source").agg(F.sum("count").alias("n_docs")), shares, slots, power)
    sources = written(sizes.withColumn("n_blocks", F.expr(f"(n_docs + {block_docs} - 1) div {block_docs}"))
                      .withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_first()))), "sources")  # a row a source
    runs = _runs(sources)
    edges = runs.agg(F.array_sort(F.collect_list("first_round")).alias("edges"))  # two numbers a source at most
    schedule = round_schedule(runs.repartition("first_round"))

    o = offsets.select(F.col("source").alias("o_source"), F.col("range").alias("o_range"), "offset")
    s = sources.select(F.col("source").alias("s_source"), "source_no", "share")
    ranked = keyed.withColumn("place", F.row_number().over(Window.partitionBy("source", "range").orderBy("h", "doc_id")))
    ranked = ranked.join(o, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("range") == F.col("o_range"))).withColumn("source_rank", F.col("place") + F.col("offset"))
    blocks = (ranked.join(s, F.col("source").eqNullSafe(F.col("s_source"))).crossJoin(F.broadcast(edges))
              .withColumn("block", F.expr(f"(source_rank - 1) div {block_docs} + 1"))
              .withColumn("in_block", F.expr(f"(source_rank - 1) % {block_docs}"))
              .withColumn("round", F.expr("(block - 1) div share"))
              .withColumn("k", F.expr("(block - 1) % share + 1"))
              .withColumn("first_round", F.expr("array_max(filter(edges, e -> e <= round))")))
    from_start = F.col("base") + (F.col("round") - F.col("first_round")) * F.col("round_slots")
    return blocks.join(schedule, ["first_round", "source_no", "k"]).select(
        "doc_id", "source", "source_rank", "block", (from_start + F.col("released")).alias("released"),
        (from_start + F.col("due")).alias("due"), (from_start + F.col("round_slot")).alias("slot"), "in_block")


def placed(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, source, slot, in_block, a row a (doc_id, source): rows that repeat both share the first of their places."""
    return (mix_sources(docs, **settings).groupBy("doc_id", "source").agg(F.min(F.struct("slot", "in_block")).alias("at"))
            .select("doc_id", "source", "at.slot", "at.in_block"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows and columns of docs, in the order of the mixture across the files that are written from them.

    Spark does not read files back in that order: who needs it after a write takes `placed` of the rows, which does not depend on files.
    """
    order = placed(docs, **settings).toDF("mix_id", "mix_source", "slot", "in_block")
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    placed_rows = renamed.join(order, renamed[at["doc_id"]].eqNullSafe(order["mix_id"]) & renamed[at["source"]].eqNullSafe(order["mix_source"]))
    return placed_rows.repartitionByRange("slot", "in_block").sortWithinPartitions("slot", "in_block").select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])
