"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The mix takes as many words as the corpus has. Each source's target is its weight's share of them,
at most ``max_repeats`` times its own size; what is cut off goes to the other sources by weight.
The mix is dealt in blocks of ``block`` words, of fewer where some source's target is not many
blocks (down to single words), so small sources get their share too: first the blocks are apportioned to the sources,
then each source's blocks to its shards, both by highest quotients ``votes / (2 * seats + 1)``, so
every (source, shard) gets an integer quota. Within a shard the documents lie in a seeded order
and are cut into blocks; a quota of ``a`` full rounds and ``r`` blocks takes every block ``a``
times and a seeded run of ``r`` neighbouring blocks (neighbours in the seeded order, so a random
choice of documents) once more.

DataFrame functions only: sizes, quotas and runs are arithmetic on columns; the per-document part
needs one shuffle of (id, source, size), never of texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import block_offsets, materialise, ranked_blocks

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Words of a block at most, and words of a shard (a shard's documents meet in one task).
BLOCK = 64
SHARD_WORDS = 500_000
#: Blocks that the smallest positive target has at least, as far as words can be cut.
LEAST_BLOCKS = 64
SEED = 29
#: Seats around its rounded-down share that a party competes for at first.
MARGIN = 3
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text="text"):
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``, a row per source.

    Sources are ordered by code point, null last; their weights repeat along that order.
    """
    ranked = ranked_blocks(sizes, ["source"], "mix-sources")
    order = (F.col("_before") + F.col("_at") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order + 1).cast("int"))
    # One row per block of sources: at most as many rows as shuffle partitions.
    placed = ranked.join(F.broadcast(block_offsets(ranked)), "_block")
    table = materialise(placed.select("source", "source_size", weight.alias("weight"),
                                      (F.col("source_size") * float(max_repeats)).alias("_cap")),
                        "mix-targets")
    total = table.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    # The level is the words per unit of weight of the sources below their cap. Each pass caps the
    # sources whose share is above it; none above: settled.
    level, capped = 0.0, None
    while True:
        over = F.col("_cap") <= F.col("weight") * F.lit(level) if capped is not None else F.lit(False)
        got = table.agg(F.sum(F.when(over, F.col("_cap")).otherwise(0.0)).alias("fixed"),
                        F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free"),
                        F.sum(over.cast("long")).alias("n")).first()
        if not got["free"] or got["n"] == capped:
            break
        capped = got["n"]
        level = (total - got["fixed"]) / got["free"]
    target = F.least(F.col("_cap"), F.col("weight") * F.lit(float(level)))
    return table.select("source", "source_size", "weight", target.alias("target"))


def _attach(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null equal to null; the keys of ``left`` stay."""
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_r_{k}" for k in keys])


def _ranked(offered: DataFrame, keys: list[str], within: list[str]) -> DataFrame:
    """``offered`` with ``_rank``, its place by falling ``_quotient`` (ties by key) in its group
    ``within``. All offers are range-partitioned in one order, so that a group with very many of them
    lies in many blocks; a row's rank is its place in its block and the group's rows in earlier ones."""
    order = [*within, "_down", *[k for k in keys if k not in within], "_s"]
    blocks = ranked_blocks(offered.withColumn("_down", -F.col("_quotient")), order, "mix-offers")
    group = ["_block", *within]
    placed = blocks.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy("_at")))
    # A row per block and group: a group has at most as many as there are blocks.
    sizes = blocks.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_block") if within else Window.orderBy("_block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    return (_attach(placed, before, group).withColumn("_rank", F.col("_place") + F.col("_earlier"))
            .drop("_down", "_block", "_at", "_place", "_earlier"))


def _seats(parties: DataFrame, keys: list[str], within: list[str], purpose: str,
           margin: int = MARGIN) -> DataFrame:
    """Sainte-Lague: ``seats`` for each party (``keys``, ``votes``, ``_house``): the ``_house``
    seats of each group ``within`` (none: one group) go to the highest quotients
    ``votes / (2 s + 1)``, ties by key. Groups whose parties hold no votes get no seats.

    Only the ``margin`` seats on either side of a party's rounded-down share are ranked. If some
    party won all of those or lost all, its seats may lie outside: the margin is widened."""
    if within:
        parties = _attach(parties, parties.groupBy(*within).agg(F.sum("votes").alias("_all")), within)
    else:
        total = F.lit(float(parties.agg(F.sum("votes")).first()[0] or 0))
        parties = parties.withColumn("_all", total)
    based = parties.withColumn(
        "_q", F.when(F.col("_all") > 0, F.col("votes") * F.col("_house") / F.col("_all"))
        .otherwise(0.0))
    based = materialise(based.withColumn("_base", F.greatest(F.lit(0), F.floor("_q") - margin)),
                        purpose)
    offered = based.select("*", F.explode(F.sequence(F.lit(0), F.lit(2 * margin))).alias("_s"))
    offered = offered.withColumn(
        "_quotient", F.col("votes") / (2 * (F.col("_base") + F.col("_s")) + 1))
    ranked = _ranked(offered, keys, within)
    if within:
        left = based.groupBy(*within).agg(
            F.max("_house").alias("_h"), F.sum("_base").alias("_b"))
        won = _attach(ranked, left, within).filter(F.col("_rank") <= F.col("_h") - F.col("_b"))
    else:
        whole = based.agg(F.max("_house").alias("h"), F.sum("_base").alias("b")).first()
        free = int((whole["h"] or 0) - (whole["b"] or 0))
        won = ranked.filter(F.col("_rank") <= free)
    extra = won.filter("votes > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("_extra"))
    joined = materialise(_attach(based, extra, keys, "left").na.fill({"_extra": 0}), purpose)
    at_edge = (F.col("_extra") > 2 * margin) | ((F.col("_extra") == 0) & (F.col("_base") > 0))
    if joined.filter(at_edge & (F.col("votes") > 0)).limit(1).count():
        return _seats(parties.drop("_all"), keys, within, purpose, 4 * margin)
    return joined.withColumn("seats", F.col("_base") + F.col("_extra")).drop(
        "_all", "_q", "_base", "_extra")


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, block: int = BLOCK,
        shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)``: a row per row of ``docs``.

    ``size`` counts the words of the whole text (null: 0); ``taken`` is the number of words the mix
    takes of the row, repeats counted, at most ``max_repeats`` times its size. A null source is a
    source of its own, the last; a null ``doc_id`` and repeated rows are rows like any other (rows
    that repeat in id and size are interchangeable). A text without words is taken 0 times. An
    empty table gives no rows. Reruns give the same rows.
    """
    sized = materialise(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    aims = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                   weights, max_repeats)
    sums = aims.agg(F.sum("target").alias("t"), F.min(F.when(F.col("target") > 0, F.col("target"))).alias("m")).first()
    block = max(1, min(block, int((sums["m"] or 0.0) // LEAST_BLOCKS)))
    blocks = F.ceil(F.col("source_size") / F.lit(block))
    votes = aims.select("*", F.col("target").alias("votes"),
                        F.lit(0).cast("long").alias("_house"))
    house = int(round((sums["t"] or 0.0) / block))
    votes = votes.withColumn("_house", F.lit(house).cast("long"))
    of_source = _seats(votes, ["source"], [], "mix-quota").select(
        "source", "source_size", "target", F.least("seats", blocks * max_repeats).alias("_quota"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(shard_words))).alias("_shards"))
    of_source = materialise(of_source, "mix-source-quota")

    dealt = _attach(sized, of_source, ["source"]).withColumn(
        "_shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("_shards")))
    dealt = materialise(dealt.drop("_shards"), "mix-shards")
    shards = dealt.groupBy("source", "_shard").agg(
        F.sum("size").alias("votes"), F.max("_quota").alias("_house"))
    quotas = _seats(shards, ["source", "_shard"], ["source"], "mix-shard-quota").select(
        "source", "_shard", F.col("votes").alias("_words"), F.col("seats").alias("_seats"))

    line = Window.partitionBy("source", "_shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("doc_id").asc_nulls_last(), "size")
    before = F.coalesce(F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    placed = _attach(dealt.withColumn("_from", before), quotas, ["source", "_shard"])
    # In blocks: the shard has n of them; the quota makes `rounds` full rounds and a run.
    n = F.ceil(F.col("_words") / F.lit(block))
    seats = F.least(F.col("_seats"), n * max_repeats)
    placed = (placed.withColumn("_n", n)
              .withColumn("_rounds", F.when(n > 0, F.floor(seats / n)).otherwise(0))
              .withColumn("_run", F.when(n > 0, seats % n).otherwise(0))
              .withColumn("_start", F.when(n > 0, F.pmod(F.xxhash64(
                  F.lit(seed + 2), "source", "_shard"), n)).otherwise(0)))
    # Words of the row inside the run [start, start + run) of blocks, which may wrap around.
    first, last = F.col("_start") * block, F.least(F.col("_words"), (F.col("_start") + F.col("_run")) * block)
    wrapped = F.greatest(F.lit(0), F.col("_start") + F.col("_run") - F.col("_n")) * block

    def inside(low, high):
        return F.greatest(F.lit(0), F.least(F.col("_from") + F.col("size"), high)
                          - F.greatest(F.col("_from"), low))

    taken = (F.col("_rounds") * F.col("size") + inside(first, last) + inside(F.lit(0), wrapped))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row repeated as often as its words are taken, rounded
    to whole documents; a row without words is kept once. The columns are those of ``docs``."""
    amounts = mix(docs.select("doc_id", "source", "text"), **options)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.round(F.col("taken") / F.col("size")).cast("int"))
    # Rows that share an id take the same share: their words over their sizes.
    times = (amounts.groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
             .select(F.col("doc_id").alias("_id"), copies.alias("_copies")).filter("_copies > 0"))
    rows = docs.select(F.col("doc_id").alias("_of"), F.struct(*docs.columns).alias("_row"))
    out = rows.join(times, rows["_of"].eqNullSafe(times["_id"]))
    return (out.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select("_row.*"))
