"""URL filter as a sort-merge range join.

A host's labels in reverse order, each ended by a zero character, are its canonical key, so a host
and all its subdomains are one interval of keys (``com.example.`` up to just behind it). Any two such
intervals are nested or apart. URLs are range-partitioned by key; every block gets the rules whose
interval meets the block's own interval, in key order; a sorted sweep over both keeps a stack of the
rules that are open at the current key. The rule with the longest match among the open ones whose
path begins the URL's path decides.

A block holds about ``block_rows`` rows, however often one host occurs: the partitioning goes on by
path and by a hash of the row. Rules are never broadcast whole: apart from the few that span several
blocks, each goes to one block.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Rows of a block, and blocks whose bounds the driver holds at most (larger blocks beyond).
BLOCK_ROWS = 50_000
MAX_BLOCKS = 100_000
DEFAULT = "allow"

#: The rules of the registered query (action, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\x00"


def split_url(url="url"):
    """``(host, path)`` columns of a URL: the host lies behind the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, with A-Z lower-cased; the path goes on up to ``?``, ``#`` or the end. Both are
    empty for null and for a URL without ``://``."""
    rest = F.substring(F.col(url), F.instr(F.col(url), "://") + 3, F.lit(2147483647))
    known = F.coalesce(F.instr(F.col(url), "://") > 0, F.lit(False))
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return (F.when(known, F.translate(host, _UPPER, _LOWER)).otherwise(""),
            F.when(known, path).otherwise(""))


def host_key(host):
    """Reversed labels, each ended by the lowest character; empty for an empty host."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.when(host == "", "").otherwise(F.concat(F.array_join(labels, _END), F.lit(_END)))


def _code_points(column):
    """Binary form, whose byte order Spark, Arrow and Python agree on."""
    return F.encode(column, "UTF-8")


def sweep(urls: list[tuple[bytes, bytes]], rules: list[tuple[bytes, bytes, str, str]]):
    """For each of the sorted ``(key, path)`` the winning ``(rule, action)`` or None.

    ``rules``: ``(key, path, rule, action)`` sorted by key. The stack holds the rules whose key
    begins the current URL's key; nested intervals make that a stack.
    """
    stack: list[tuple[bytes, list[tuple[bytes, str, str]]]] = []
    at = 0
    seen_key: bytes | None = None
    for key, path in urls:
        if key != seen_key:
            while at < len(rules) and rules[at][0] <= key:
                opened = rules[at][0]
                while stack and not opened.startswith(stack[-1][0]):
                    stack.pop()
                if not stack or stack[-1][0] != opened:
                    stack.append((opened, []))
                stack[-1][1].append(rules[at][1:])
                at += 1
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            seen_key = key
        best, size = None, (-1, -1)
        for opened, entries in stack:
            for prefix, rule, action in entries:
                length = (len(opened) + len(prefix), len(opened))
                if length > size and path.startswith(prefix):
                    best, size = (rule, action), length
        yield best


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``: one row per row of ``pages``.

    ``rules``: ``action`` (``allow`` or ``block``), ``host``, ``path``. A rule fits its host and
    all subdomains if the URL's path starts with its path; an empty rule host fits every host. The
    longest rule wins (host and path together, then the longer host; of rules for the same host and
    path ``block``). A rule with a null is no rule; repeated rules count once. A URL that no rule
    fits, a null URL included, gets ``default`` and a null rule. Null and repeated ``page_id`` are
    kept as they are; an empty table gives no rows; other columns are left out.
    """
    host, path = split_url("url")
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.select("*", host_key(F.col("host")).alias("_key"))
    rows = urls.count()
    n = max(1, min(MAX_BLOCKS, -(-rows // block_rows)))
    salt = F.xxhash64("page_id", "path")
    placed = urls.repartitionByRange(n, _code_points(F.col("_key")), _code_points(F.col("path")), salt)
    placed = materialise(placed.withColumn("_block", F.spark_partition_id()), "url-blocks")
    # Lowest and highest key of each block: one row per block, at most MAX_BLOCKS.
    key = _code_points(F.col("_key"))
    bounds = sorted((r["lo"], r["hi"], r["_block"]) for r in
                    placed.groupBy("_block").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
                    .collect())
    bounds = [(bytes(lo), bytes(hi), b) for lo, hi, b in bounds]

    rule_key = host_key(F.translate(F.col("host"), _UPPER, _LOWER))
    canon = (rules.select("action", "host", "path").dropna()
             .select(F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), "path", "action",
                     _code_points(rule_key).alias("_key"))
             .groupBy("host", "path", "_key").agg(F.max("action").alias("action")))

    def to_blocks(batches):
        lows, highs = [b[0] for b in bounds], [b[1] for b in bounds]
        from bisect import bisect_left
        for batch in batches:
            names = batch.schema.names
            take, blocks = [], []
            for i, k in enumerate(batch.column("_key").to_pylist()):
                # Blocks are ordered: those that end at the key or later, while they begin in it.
                j = bisect_left(highs, k)
                while j < len(bounds) and (lows[j] <= k or lows[j].startswith(k)):
                    take.append(i)
                    blocks.append(bounds[j][2])
                    j += 1
            picked = batch.take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(blocks, pa.int32())],
                                             [*names, "_block"])

    dealt = canon.mapInArrow(
        to_blocks, "host string, path string, _key binary, action string, _block int")

    def meet(urls: pa.Table, rules: pa.Table) -> pa.Table:
        by_key = sorted(zip(rules.column("_key").to_pylist(),
                            [p.encode() for p in rules.column("path").to_pylist()],
                            [h + p for h, p in zip(rules.column("host").to_pylist(),
                                                   rules.column("path").to_pylist(), strict=True)],
                            rules.column("action").to_pylist(), strict=True))
        keys = [k.encode() for k in urls.column("_key").to_pylist()]
        paths = [p.encode() for p in urls.column("path").to_pylist()]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        won: list = [None] * len(keys)
        for i, best in zip(order, sweep([(keys[i], paths[i]) for i in order], by_key), strict=True):
            won[i] = best
        return pa.table({"page_id": urls.column("page_id"), "host": urls.column("host"),
                         "path": urls.column("path"),
                         "rule": pa.array([w and w[0] for w in won], pa.string()),
                         "verdict": pa.array([w[1] if w else default for w in won], pa.string())})

    id_type = pages.schema["page_id"].dataType.simpleString()
    return (placed.groupBy("_block").cogroup(dealt.groupBy("_block"))
            .applyInArrow(meet, f"page_id {id_type}, host string, path string, rule string, "
                                "verdict string"))


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "action string, host string, path string")
