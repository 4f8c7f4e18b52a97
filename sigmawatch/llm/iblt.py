"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A text is cut into paragraphs (at line breaks and behind sentence ends). The set of pairs
(paragraph, times it occurs) is hashed to 64-bit digests. Each digest falls into one cell of each
of three subtables; a cell holds a count, the XOR of its digests and the XOR of their check
hashes. The fingerprint is the smallest sketch, written cell by cell.

Two versions are compared by subtracting their sketches cell by cell. What both hold cancels; the
rest is peeled: a cell with count +1 or -1 whose check hash fits holds exactly one digest, which is
recovered and taken out of its three cells, which opens others. Each round looks at one subtable, in
which a digest has one cell, so none is recovered twice. A sketch that does not peel empty is made
again eight times larger with another salt. The numbers of digests only one version holds give the
likeness exactly: ``|A and B| / |A or B|`` of the two sets.

DataFrame and SQL functions only. The texts are shuffled once by ``doc_id`` and the part of each
that the document before it needs once more; the digests lie in a table bucketed by the id, so
building and peeling sketches shuffles nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialise, ranked_blocks, shuffle_partitions

#: Cells of each of the three subtables of the fingerprint; each retry has eight times as many.
CELLS = 4
GROWTH = 8
#: Peeling rounds of a try (a round for each subtable in turn).
ROUNDS = 12
MAX_TRIES = 16
_BREAK = r"\n+|(?<=[.!?])[ \t]+"
_TABLES = 3


def paragraphs(text: Column) -> Column:
    """Paragraphs of a text, without empty ones."""
    return F.filter(F.split(text, _BREAK), lambda p: p != "")


def _hashes(text: Column) -> Column:
    return F.transform(paragraphs(text), lambda p: F.xxhash64(p))


def _successors(docs: DataFrame) -> DataFrame:
    """``(doc_id, next_id)`` of the distinct ids in ascending order, null last; the last one's
    next is the first."""
    blocks = ranked_blocks(docs.select("doc_id").distinct(), ["doc_id"], "iblt-order")
    inside = Window.partitionBy("_block").orderBy("_at")
    size = F.count(F.lit(1)).over(Window.partitionBy("_block"))
    follow = blocks.select("doc_id", "_block", F.lead("doc_id").over(inside).alias("_next"),
                           (F.col("_at") == size).alias("_ends"))
    # The first id of each block: one row per block, at most as many as shuffle partitions.
    firsts = blocks.filter("_at = 1").select("_block", F.col("doc_id").alias("_first"))
    order = Window.orderBy("_block")
    firsts = firsts.select("_block", F.lead("_first").over(order).alias("_then"),
                           F.lead("_block").over(order).isNull().alias("_last"),
                           F.first("_first").over(order).alias("_head"))
    joined = follow.join(F.broadcast(firsts), "_block")
    after = F.when(~F.col("_ends"), F.col("_next")).when(F.col("_last"), F.col("_head")).otherwise(
        F.col("_then"))
    return joined.select("doc_id", after.alias("next_id"))


def _only(flag: str, other: str) -> Column:
    """Two columns are equal, said so that the join's key stays ``_key`` alone and neither side is
    dealt anew."""
    return (F.col(flag).cast("int") - F.col(other).cast("int")) == 0


def _versions(docs: DataFrame) -> DataFrame:
    """A row per document: its key, id, length, the edited text's hash and the paragraph hashes of
    its own text, the edited text and the next document's text. ``(_key, _copy)`` is unique."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = F.char_length("text").cast("long")
    parts = shuffle_partitions(docs.sparkSession)
    key, none = F.coalesce(F.col("doc_id"), F.lit(0)), F.col("doc_id").isNull()
    row = Window.partitionBy("_key").orderBy(F.col("doc_id").asc_nulls_last(), "text")
    same = Window.partitionBy("_key", "doc_id").orderBy("text")
    # Both uses of the texts share this exchange. Of rows that repeat an id the first by text
    # stands for it.
    keyed = (base.withColumn("_key", key).repartition(parts, "_key")
             .withColumn("_copy", F.row_number().over(row))
             .withColumn("_place", F.row_number().over(same)))
    order = materialise(_successors(base), "iblt-next")
    lengths = base.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.floor(n / 2)).alias("_half"))
    # The longest part of the next text that a document with this id may need.
    wanted = (order.join(lengths, F.col("doc_id").eqNullSafe(F.col("_id")))
              .select(key.alias("_for"), none.alias("_for_none"), "_half",
                      F.coalesce("next_id", F.lit(0)).alias("_nkey"),
                      F.col("next_id").isNull().alias("_nnone")))
    wanted = materialise(wanted, "iblt-wanted")
    given = (keyed.filter("_place = 1").withColumn("_none", none)
             .join(wanted, (F.col("_key") == F.col("_nkey")) & _only("_none", "_nnone"))
             .select("_for", "_for_none",
                     F.expr("substring(text, 1, cast(_half as int))").alias("_head"),
                     _hashes(F.col("text")).alias("_next")))
    half = F.floor(n / 2)
    edited = F.concat(F.expr("substring(text, 1, cast(char_length(text) - floor(char_length(text) / 2) as int))"),
                      F.substring(F.col("_head"), F.lit(1), half.cast("int")))
    joined = keyed.withColumn("_none", none).join(
        given, (F.col("_key") == F.col("_for")) & _only("_none", "_for_none"), "left")
    return joined.select("_key", "_copy", "doc_id", n.alias("n_chars"),
                         F.sha2(edited, 256).alias("edited_sha256"),
                         _hashes(F.col("text")).alias("own"), _hashes(edited).alias("edited"),
                         F.col("_next").alias("next"))


def _bucketed(df: DataFrame) -> DataFrame:
    """``df`` in the shared folder, bucketed by ``_key``. The catalog forgets the table's name at once;
    its files stay."""
    spark = df.sparkSession
    name = f"iblt_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(shuffle_partitions(spark), "_key")
     .option("path", scratch_path(spark, "iblt-versions")).saveAsTable(name))
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return written


def _cells(digest: Column, salt: int, width: int) -> list[Column]:
    """The digest's cell in each subtable, numbered through."""
    return [F.pmod(F.xxhash64(F.lit(salt * _TABLES + t), digest), F.lit(width)).cast("int")
            + t * width for t in range(_TABLES)]


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit(-1), digest)


def _spread(rows: DataFrame, keys: list[str], sign: Column, digest: Column, salt: int,
            width: int) -> DataFrame:
    """The three cell entries of each digest."""
    made = rows.select(*keys, sign.alias("_s"), digest.alias("_d"))
    made = made.select(*keys, "_s", "_d", _check(F.col("_d")).alias("_c"),
                       F.explode(F.array(*_cells(F.col("_d"), salt, width))).alias("cell"))
    return made.select(*keys, "cell", F.col("_s").alias("n"), F.col("_d").alias("d"),
                       F.col("_c").alias("c"))


def _combine(entries: DataFrame, keys: list[str]) -> DataFrame:
    summed = entries.groupBy(*keys, "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("d").alias("d"), F.bit_xor("c").alias("c"))
    return summed.filter("n <> 0 or d <> 0 or c <> 0")


def digests(versions: DataFrame, need: Column | None = None) -> DataFrame:
    """``(_key, _copy, version, digest)``: a row per distinct (paragraph, times) of a version (0:
    own, 1: edited, 2: next). ``need``: bits of the pairs (1, 2) that are wanted, else both."""
    rows = versions.select("_key", "_copy", (F.lit(3) if need is None else need).alias("_need"),
                           F.explode(F.array(*[
                               F.struct(F.lit(i).alias("version"), F.col(c).alias("list"))
                               for i, c in enumerate(("own", "edited", "next"))])).alias("_v"))
    rows = rows.filter((F.col("_v.version") == 0)
                       | (F.col("_need").bitwiseAND(F.col("_v.version")) != 0))
    rows = rows.select("_key", "_copy", "_need", "_v.version", F.explode("_v.list").alias("_h"))
    counted = rows.groupBy("_key", "_copy", "_need", "version", "_h").agg(F.count(F.lit(1)).alias("_n"))
    return counted.select("_key", "_copy", "_need", "version", F.xxhash64("_h", "_n").alias("digest"))


_PAIR = ["_key", "_copy", "pair"]


def _differences(versions: DataFrame, salt: int, width: int) -> DataFrame:
    """Subtracted sketches of the pairs own/edited (1) and own/next (2), peeled: a row per pair
    and kind of what is left (cells: pair failed) or recovered (cells -1 and -2)."""
    sides = digests(versions, F.col("_need"))
    signed = sides.select("_key", "_copy", "_need", "digest", F.explode(
        F.when(F.col("version") == 0, F.array(
            F.struct(F.lit(1).alias("pair"), F.lit(1).alias("s")),
            F.struct(F.lit(2).alias("pair"), F.lit(1).alias("s"))))
        .otherwise(F.array(F.struct(F.col("version").alias("pair"), F.lit(-1).alias("s"))))
    ).alias("_p")).filter(F.col("_need").bitwiseAND(F.col("_p.pair")) != 0)
    signed = signed.select("_key", "_copy", "_p.pair", F.col("_p.s").alias("s"), "digest")
    # The sketch of each version is linear in its digests, so the subtraction of the two sketches
    # is the sum over the signed digests of both.
    state = _combine(_spread(signed, _PAIR, F.col("s"), F.col("digest"), salt, width), _PAIR)
    zero = F.lit(0).cast("long")
    for r in range(ROUNDS):
        table = r % _TABLES
        pure = ((F.abs(F.col("n")) == 1) & (F.col("cell") >= table * width)
                & (F.col("cell") < (table + 1) * width) & (F.col("c") == _check(F.col("d"))))
        out = [F.struct(cell.alias("cell"), (-F.col("n")).alias("n"), F.col("d").alias("d"),
                        F.col("c").alias("c")) for cell in _cells(F.col("d"), salt, width)]
        # Cell -1 counts what only the own text holds, cell -2 what only the other holds.
        out.append(F.struct(F.when(F.col("n") > 0, -1).otherwise(-2).alias("cell"),
                            F.lit(1).cast("long").alias("n"), zero.alias("d"), zero.alias("c")))
        itself = F.struct(F.col("cell"), F.col("n").cast("long").alias("n"), F.col("d"), F.col("c"))
        opened = F.when(pure, F.array(itself, *out)).otherwise(F.array(itself))
        state = _combine(state.select(*_PAIR, F.explode(opened).alias("_e")).select(*_PAIR, "_e.*"),
                         _PAIR)
    return state.groupBy(*_PAIR).agg(
        F.sum(F.when(F.col("cell") >= 0, 1).otherwise(0)).alias("left"),
        F.sum(F.when(F.col("cell") == -1, F.col("n")).otherwise(0)).alias("only_own"),
        F.sum(F.when(F.col("cell") == -2, F.col("n")).otherwise(0)).alias("only_other"))


def _fingerprints(versions: DataFrame, width: int) -> DataFrame:
    """``(_key, _copy, own_n, edited_n, next_n, fingerprint, edited_fingerprint)``."""
    sides = digests(versions)
    totals = sides.groupBy("_key", "_copy").agg(*[
        F.sum((F.col("version") == i).cast("long")).alias(f"{c}_n")
        for i, c in enumerate(("own", "edited", "next"))])
    keys = ["_key", "_copy", "version"]
    cells = _combine(_spread(sides.filter("version < 2"), keys, F.lit(1), F.col("digest"), 0, width), keys)
    shown = F.concat_ws(":", F.lower(F.hex("cell")), F.lower(F.hex("n")), F.lower(F.hex("d")),
                        F.lower(F.hex("c")))
    listed = cells.groupBy("_key", "_copy").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("version") == i, F.struct("cell", shown.alias("s")))))
        .alias(f"_f{i}") for i in range(2)])
    text = [F.array_join(F.transform(f"_f{i}", lambda x: x["s"]), ",") for i in range(2)]
    listed = listed.select("_key", "_copy", text[0].alias("fingerprint"),
                           text[1].alias("edited_fingerprint"))
    return _on_id(totals, listed)


def _on_id(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    named = right.withColumnRenamed("_key", "_rkey").withColumnRenamed("_copy", "_rcopy")
    return left.join(named, (F.col("_key") == F.col("_rkey")) & _only("_copy", "_rcopy"),
                     how).drop("_rkey", "_rcopy")


def fingerprints(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``:
    a row per row of ``docs`` (``doc_id``, ``text``).

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by the first as many
    (or all) of the next document in ascending ``doc_id``; after the last comes the first, so a
    lone document follows itself. A null text counts as empty. A null ``doc_id`` comes last in the
    order. Rows that repeat an id share one place in the order, where the smallest text stands for
    them. Texts without paragraphs have an empty fingerprint; two empty sets are alike (1).
    An empty table gives no rows; other columns are left out.
    """
    versions = _bucketed(_versions(docs))
    base = _fingerprints(versions, cells)
    todo, tries, solved = versions.withColumn("_need", F.lit(3)), 0, None
    width = cells
    while True:
        got = materialise(_differences(todo, tries, width), f"iblt-try{tries}")
        done = got.filter("left = 0").select(*_PAIR, "only_own", "only_other")
        solved = done if solved is None else solved.unionByName(done)
        failed = got.filter("left > 0").groupBy("_key", "_copy").agg(F.bit_or("pair").alias("_need"))
        if not failed.limit(1).count():
            break
        tries, width = tries + 1, width * GROWTH
        if tries == MAX_TRIES:
            raise RuntimeError("sketches do not peel")
        todo = _on_id(versions, failed, "inner")
    by_pair = solved.groupBy("_key", "_copy").agg(*[
        F.max(F.when(F.col("pair") == p, F.col(c))).alias(f"_{c}{p}")
        for p in (1, 2) for c in ("only_own", "only_other")])
    out = _on_id(_on_id(versions.select("_key", "_copy", "doc_id", "n_chars", "edited_sha256"), base), by_pair)
    own = F.coalesce(F.col("own_n"), F.lit(0))

    def likeness(pair: int) -> Column:
        # No row: the two sets are equal and nothing was left to recover.
        only_own = F.coalesce(F.col(f"_only_own{pair}"), F.lit(0))
        only_other = F.coalesce(F.col(f"_only_other{pair}"), F.lit(0))
        either = own + only_other
        return F.when(either == 0, 1.0).otherwise((own - only_own) / either)

    return out.select("doc_id", "n_chars", "edited_sha256",
                      F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
                      F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
                      likeness(1).alias("near_edited"), likeness(2).alias("near_next"))
