"""Exact duplicates by an extendible-hash index on shared files.

Every text has a 64-bit key. The index has a directory with ``2 ** depth``
slots, one for each prefix of that many bits of the key. It starts with one
bucket and doubles as long as a bucket holds more keys than its capacity: such a
bucket is split by one more bit, while slots that need not be told apart go on
sharing a bucket. Keys are hashes, so buckets fill evenly: six levels beyond the
average depth hold a 64th of the capacity each, and no more are counted.

Texts go to the owners of the directory's slots: an owner task takes a range of
slots, and with it a range of keys. Texts that meet there under one key are
compared by their bytes: equal ones are merged, different ones are chained.
The owners write their part of the index to the shared folder, one entry for
each text with how many rows have it and which of them stays. Rows look their
entry up by slot and key, and by digest within the chain.

Before texts move, copies within each of two halves of the rows are merged, so a
text that a third of all rows share reaches its owner as two rows at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm.rows import ROW, with_row_name
from tiersmith.session import stage

#: Entries a bucket holds before it is split.
BUCKET_ENTRIES = 4096
#: Levels counted beyond the depth at which buckets are full on average.
SPARE_LEVELS = 6
#: Parts of the rows within which copies are merged before they go to an owner.
HALVES = 2


def _prefix(bits: Column, length: int, depth: Column | int) -> Column:
    """The first ``depth`` of the ``length`` bits in ``bits``."""
    return F.call_function("shiftright", bits, (F.lit(length) - depth).cast("int"))


def directory(entries: DataFrame, capacity: int = BUCKET_ENTRIES) -> tuple[DataFrame, int]:
    """The directory over ``entries`` (one row per distinct ``key``), and its depth.

    One row per slot: ``slot``, and the bucket it points to: ``bucket_depth``,
    ``bucket`` (the prefix that all its keys share) and its ``first_slot``. A bucket of more than
    ``capacity`` entries is split until its halves fit, or at the last level
    counted, beyond which only equal keys would still be together.
    """
    total = entries.count()
    levels = max(0, math.ceil(math.log2(max(1, total) / capacity))) + SPARE_LEVELS
    cells = entries.groupBy(F.shiftrightunsigned("key", 64 - levels).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    sizes = (
        cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("depth"))
        .groupBy("depth", _prefix(F.col("cell"), levels, F.col("depth")).alias("prefix"))
        .agg(F.sum("n").alias("n"))
    )
    sizes = stage(sizes, "bucket-sizes")
    overfull = sizes.where((F.col("n") > capacity) & (F.col("depth") < levels)).select("depth", "prefix")
    # A bucket is what splitting its parent made and needs no split itself.
    split_off = overfull.select(
        (F.col("depth") + 1).alias("depth"),
        F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"),
    ).unionByName(entries.sparkSession.range(1).selectExpr("0 AS depth", "0L AS prefix"))
    buckets = stage(split_off.join(overfull, ["depth", "prefix"], "left_anti"), "buckets")
    depth = buckets.agg(F.max("depth")).first()[0]
    width = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(depth) - F.col("depth")).cast("int"))
    first = F.col("prefix") * width
    slots = buckets.select(
        F.explode(F.sequence(first, first + width - 1)).alias("slot"),
        first.alias("first_slot"),
        F.col("depth").alias("bucket_depth"),
        F.col("prefix").alias("bucket"),
    )
    return slots, depth


def _slot(depth: int) -> Column:
    # Java shifts by the count's last six bits, so a shift by 64 would be none.
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def exact_duplicates(docs: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """Which rows are copies of the same text, and which one of them stays.

    Returns one row per row of ``docs``: ``doc_id``, ``__row`` (see ``rows``),
    ``keep_id`` (the largest ``doc_id`` with this text), ``group_size``,
    ``kept``, ``text_sha256``, and the text's place in the index: ``bucket``,
    ``bucket_depth`` and ``chain`` (its number among texts with equal keys).
    A NULL text counts as empty. Of several rows with the largest ``doc_id``
    the one latest in the files stays, and so where every ``doc_id`` is NULL.
    Other columns of ``docs`` are ignored.
    """
    rows = docs if ROW in docs.columns else with_row_name(docs)
    text = F.coalesce("text", F.lit(""))
    keyed = rows.select("doc_id", ROW, text.alias("text")).withColumn("key", F.xxhash64("text"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    postings = stage(keyed.select("doc_id", ROW, "key", digest.alias("text_sha256")), "postings")
    slots, depth = directory(stage(postings.select("key").distinct(), "keys"), capacity)

    last = F.max(F.struct("doc_id", ROW)).alias("last")
    half = F.pmod(F.xxhash64(ROW), F.lit(HALVES)).alias("half")
    merged = keyed.groupBy(half, "key", "text").agg(F.count(F.lit(1)).alias("rows"), last)
    # The owner of a slot has all texts of its keys: both steps here compare what lies there.
    owned = merged.withColumn("slot", _slot(depth)).repartitionByRange("slot")
    texts = owned.groupBy("slot", "key", "text").agg(F.sum("rows").alias("group_size"), F.max("last").alias("last"))
    chain = F.row_number().over(Window.partitionBy("slot", "key").orderBy("text")).alias("chain")
    index = stage(texts.select("slot", "key", chain, digest.alias("text_sha256"), "group_size", "last"), "index")
    found = postings.withColumn("slot", _slot(depth)).join(index, ["slot", "key", "text_sha256"])
    return found.join(slots, "slot").select(
        "doc_id",
        ROW,
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col(f"last.{ROW}")).alias("kept"),
        "text_sha256",
        "bucket",
        "bucket_depth",
        "chain",
    )


def without_duplicates(docs: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = with_row_name(docs)
    dropped = exact_duplicates(rows, capacity).where(~F.col("kept")).select(ROW)
    return rows.join(stage(dropped, "dropped"), ROW, "left_anti").select(*[rows[c] for c in docs.columns])
