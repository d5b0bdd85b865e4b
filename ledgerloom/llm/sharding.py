"""Shards by jump consistent hashing (Lamping and Veach, 2014), with gapless slots inside each shard."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.columns import quoted, scattered, text_or_empty
from ledgerloom.llm.prefix import prefix_sums

# Fixed value: the multiplier of the published generator, in two halves of 32 bits.
MULTIPLIER = 2862933555777941757
HIGH, LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
MASK = 0xFFFFFFFF


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """``state * MULTIPLIER + 1`` modulo 2**64, as two halves. Products stay below 2**63."""
    first = low.bitwiseAND(F.lit(0xFFFF)) * LOW
    second = F.shiftrightunsigned(low, 16) * LOW
    below = first + F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    carried = F.shiftrightunsigned(below, 32) + F.shiftrightunsigned(second, 16)
    cross = (low * HIGH).bitwiseAND(F.lit(MASK))
    high_part = (high.bitwiseAND(F.lit(0xFFFF)) * LOW).bitwiseAND(F.lit(MASK))
    high_rest = F.shiftleft((F.shiftrightunsigned(high, 16) * LOW).bitwiseAND(F.lit(0xFFFF)), 16)
    return (carried + cross + high_part + high_rest).bitwiseAND(F.lit(MASK)), below.bitwiseAND(F.lit(MASK))


def _jumps(key: Column, shards: int, steps: int) -> Column:
    """State after so many jumps: ``bucket``, ``next`` (the next bucket, at least ``shards`` once done), generator."""
    start = F.struct(
        F.lit(-1).cast("long").alias("bucket"),
        F.lit(0).cast("long").alias("next"),
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(MASK)).alias("low"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        drawn = F.shiftrightunsigned(high, 1) + 1  # the state's upper 31 bits, plus one
        following = F.floor((state["next"] + 1) * (F.lit(float(1 << 31)) / drawn)).cast("long")
        moved = F.struct(state["next"].alias("bucket"), following.alias("next"), high.alias("high"), low.alias("low"))
        return F.when(state["next"] >= shards, state).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, jump)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard of a long key, 0 to ``shards`` - 1. With one shard more, keys move only into the new shard.

    The number of jumps is about the logarithm of ``shards``; the few keys that need more than the usual number are
    computed again with as many steps as there are shards, which always suffices.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    usual = min(shards, 8 + 2 * math.ceil(math.log(shards) + 1))
    state = _jumps(key, shards, usual)
    if usual == shards:
        return state["bucket"].cast("int")
    whole = _jumps(key, shards, shards)
    return F.when(state["next"] >= shards, state["bucket"]).otherwise(whole["bucket"]).cast("int")


def shard_documents(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``size`` (bytes + 16), ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Law ``key``: the id and the number of shards alone decide, so equal texts may sit in different shards and rows
    that repeat an id share one; a group of equal texts is read off ``size`` and ``text_crc32``. A null id counts as 0, a null text as empty. ``slot`` numbers the rows of a shard
    from 0 without gaps, in a scattered order of their ids; numbers come from counts per shard and slice of the
    ids, so no task sorts a whole shard. An empty table gives no rows.
    """
    value = text_or_empty(text)
    key = F.coalesce(quoted(doc_id).cast("long"), F.lit(0))
    rows = docs.select(
        quoted(doc_id).alias("doc_id"),
        (F.octet_length(value) + 16).cast("long").alias("size"),
        F.crc32(value).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"),
        scattered(quoted(doc_id), instead=value).alias("scatter"),
    ).withColumn("slice", F.substring("scatter", 1, 2))
    numbered = prefix_sums(rows, ["shard"], ["slice"], ["scatter", "doc_id", "text_crc32"], name="slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
