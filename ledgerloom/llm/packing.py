"""Best-fit packing of token sequences by exact complements of lengths."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.batches import groups_of_rows
from ledgerloom.llm.columns import quoted
from ledgerloom.llm.encoding import encoder
from ledgerloom.llm.prefix import prefix_sums
from ledgerloom.llm.storage import checkpointed

SEQUENCE = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, scatter long"


def cut(total: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: only the first may be shorter than ``size``."""
    first = total % size or size
    return [(0, first)] + [(s, size) for s in range(first, total, size)]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: place in its document, length and checksum of its ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *[(c, pa.int64()) for c in ("start", "length", "ids_crc32", "scatter")]])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for first, texts in groups_of_rows(batch):
                names = batch.column("doc_id").slice(first, len(texts)).to_pylist()
                rows = []
                for name, ids in zip(names, encode(texts)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(ids), size)):
                        crc = zlib.crc32(ids[start : start + length].tobytes())
                        scatter = zlib.crc32(f"{name}/{k}".encode(), crc)
                        rows.append((name, k, start, length, crc, scatter))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    slim = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    return slim.mapInArrow(encoded, PIECES)


class Supply:
    """How many pieces of each length are left, and which lengths fill a gap exactly."""

    def __init__(self, counts: dict[int, int], size: int):
        self.left = np.zeros(size + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def pair(self, gap: int) -> tuple[int, int] | None:
        """The pair of lengths with sum ``gap`` that holds the longest piece."""
        longer = np.arange(gap - 1, (gap - 1) // 2, -1)
        if not len(longer):
            return None
        needed = np.where(longer * 2 == gap, 2, 1)
        found = np.flatnonzero((self.left[longer] >= needed) & (self.left[gap - longer] >= needed))
        return (int(longer[found[0]]), gap - int(longer[found[0]])) if len(found) else None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths with sum ``gap``, all on hand."""
        if self.left[gap]:
            return (gap,)
        if two := self.pair(gap):
            return two
        for longest in np.flatnonzero(self.left[: gap - 1])[::-1].tolist():
            if longest * 3 < gap:
                return None
            self.left[longest] -= 1
            two = self.pair(gap - longest)
            self.left[longest] += 1
            if two and two[0] <= longest:
                return (longest, *two)
        return None

    def best(self, gap: int) -> int | None:
        """The longest length that fits."""
        fitting = np.flatnonzero(self.left[: gap + 1])
        return int(fitting[-1]) if len(fitting) else None


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Slots for all pieces: (length, first rank, end rank, pieces a sequence, first sequence, offset).

    ``counts`` is the number of pieces of each length from 1 to ``size``. The longest piece opens a sequence. If one,
    two or three lengths on hand fill its gap exactly, they do; else the longest that fits goes in and the rest of
    the gap is tried again. What one sequence holds is repeated as often as all its lengths are on hand, so each
    round uses up a length: at most ``size`` rounds, and a table whose size does not depend on the number of pieces.
    """
    supply = Supply(counts, size)
    taken: Counter = Counter()
    slots, sequence = [], 0
    while (longest := supply.best(size)) is not None:
        held = [longest]
        supply.left[longest] -= 1
        gap = size - longest
        while gap:
            if exact := supply.exact(gap):
                more: tuple[int, ...] = exact
            elif (fitting := supply.best(gap)) is not None:
                more = (fitting,)
            else:
                break
            for length in more:
                supply.left[length] -= 1
            held += more
            gap -= sum(more)
        each = Counter(held)
        times = 1 + min(int(supply.left[length]) // n for length, n in each.items())
        offset = 0
        for length, n in each.items():
            supply.left[length] -= n * (times - 1)
            slots.append((length, taken[length], taken[length] + n * times, n, sequence, offset))
            taken[length] += n * times
            offset += n * length
        sequence += times
    return slots


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SEQUENCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is the ids of its text and ``end_id``; a null text is empty. Documents of up to ``size`` ids stay
    whole, longer ones are cut into pieces of ``size``, the first of which may be shorter. Rows that repeat an id
    are documents of their own; a null id stays null. An empty table gives no rows.

    Texts are encoded once and only the pieces' lengths go on. The driver sees the number of pieces of each length,
    ``size`` numbers at most, and makes the table of slots from them. Each piece gets a rank among the pieces of its
    length, by prefix sums over 256 slices of a hash, and finds its slot by binary search.
    """
    spark = docs.sparkSession
    cut_up = checkpointed(pieces(docs, tokenizer, end_id, size, doc_id, text))
    counts = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = np.array(sorted(plan(counts, size)), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(slots)
    sliced = cut_up.withColumn("slice", F.pmod(F.col("scatter"), F.lit(256)))
    ranked = prefix_sums(sliced, ["length"], ["slice"], ["scatter", "doc_id", "piece", "ids_crc32"], name="rank")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, n, sequence, offset = shared.value.T
        starts = (length << 44) + first
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "rank"))
            slot = np.searchsorted(starts, (lengths << 44) + ranks, "right") - 1
            within = ranks - first[slot]
            found = [pa.array(sequence[slot] + within // n[slot]), pa.array(offset[slot] + within % n[slot] * length[slot])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *found], [*batch.schema.names[:5], "sequence_id", "offset"])

    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
