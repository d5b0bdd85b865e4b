"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.bit_filter import bit_filter, may_hold
from ledgerloom.llm.columns import quoted, text_or_empty, whole_row
from ledgerloom.llm.storage import checkpointed

PREFIX = 64


def _candidates(docs: DataFrame, text: str) -> Column:
    """Condition on a row of ``docs``: its length and prefix may occur in another row too."""
    value = text_or_empty(text)
    length_hash = F.xxhash64(F.length(value))
    prefix_hash = F.xxhash64(F.length(value), F.substring(value, 1, PREFIX))
    shared_lengths = docs.groupBy(length_hash.alias("hash")).count().where("count > 1").select("hash")
    long_enough = may_hold(bit_filter(shared_lengths), length_hash)
    shared_prefixes = docs.where(long_enough).groupBy(prefix_hash.alias("hash")).count().where("count > 1").select("hash")
    return long_enough & may_hold(bit_filter(shared_prefixes), prefix_hash)


def _groups(candidates: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Texts held by several rows: ``key`` (hash of the text), ``keep_id`` and ``group_size``."""
    return (
        candidates.groupBy(_key(text).alias("key"))
        .agg(F.max(quoted(doc_id)).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def _key(text: str) -> Column:
    return F.sha2(text_or_empty(text), 256)


def copy_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, and the columns named in ``carry``.

    Of equal texts the largest id stays. A null text counts as empty. A null id is smaller than any other; rows that
    repeat the id that stays are that document once more and are all marked as kept. An empty table gives no rows.

    Each refinement is a scan and an aggregation that starts before the shuffle, so a text held by a third of all
    rows leaves each task as one row. A level reads only rows whose group survived the level above, known from a
    filter of fixed size; the whole text is hashed only for survivors of both. Spark splits the final join where a
    key is hot.
    """
    candidate = _candidates(docs, text)
    # A stored side lets Spark split the other one where a key is hot.
    groups = checkpointed(_groups(docs.where(candidate), doc_id, text))
    alone = F.concat(F.lit("alone:"), F.coalesce(quoted(doc_id).cast("string"), F.lit("null")))
    slim = docs.select(
        quoted(doc_id).alias("doc_id"),
        *[quoted(c).alias(f"carried_{i}") for i, c in enumerate(carry)],
        F.when(candidate, _key(text)).otherwise(alone).alias("key"),
    )
    joined = slim.join(groups, "key", "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        *[F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)],
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest id.

    Only rows that may have a copy are shuffled; all others pass straight through.
    """
    candidate = _candidates(docs, text)
    candidates = docs.where(candidate)
    groups = checkpointed(_groups(candidates, doc_id, text))
    joined = candidates.select(whole_row(docs), _key(text).alias("key"), quoted(doc_id).alias("own_id")).join(groups, "key", "left")
    unique = joined.where(F.col("group_size").isNull()).select("row.*")
    # Rows that repeat the id that stays are equal in id and text: any of them is the document.
    first = joined.where(F.col("group_size").isNotNull() & F.col("own_id").eqNullSafe(F.col("keep_id"))).dropDuplicates(["key"])
    return docs.where(~candidate).unionByName(unique).unionByName(first.select("row.*"))
