"""Removal of repeated passages by relative Lempel-Ziv parsing against indexed blocks of the corpus.

The corpus is its own reference. Documents are parsed block by block: a block is as many documents as fit a buffer,
and its index lists where each run of ``window`` words occurs first. The parse is greedy: a factor goes on as long
as the next run of words is found where the reference goes on, and at each factor boundary the next run is looked
up anew, so runs that lie across a boundary are checked too. Factors shorter than a window are literals. What a
block does not find in its own index is then looked up in the indexes of all other blocks, which meet in one
shuffle by the hash of the run.

Only runs that can occur twice are parsed. Each run names an anchor, the least hash among its shorter runs of
``gram`` words, and equal runs name equal anchors; a run whose anchor occurs once in the corpus is unique. The
repeated anchors are passed to all tasks as a bit map of fixed size: when it is full, more runs are looked up, and
the result is the same.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.batches import ids_of, names_of
from ledgerloom.llm.columns import WORD, exact_id, quoted
from ledgerloom.llm.hashing import BASE, mixed, run_hashes, sliding, word_hashes

WINDOW, GRAM = 20, 4
FILTER_BITS = 1 << 27
BUFFER = 800_000
WORDS = re.compile(WORD)
RUN = "run long, doc_id long, tie long, packed long"


def anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run's anchor, and the hash at each anchor's place (once per place)."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = run_hashes(words, gram)
    width = window - gram + 1
    least = sliding(grams, width, np.minimum)
    # A place is an anchor if some run that holds it has no smaller hash.
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return least, grams[sliding(around, width, np.maximum) == grams]


def repeated_anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Hashes of anchors that have two places or more in the corpus, as ``hash``."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = [anchors(word_hashes(t), window, gram)[1] for t in batch["text"]]
            found, n = np.unique(np.concatenate(places), return_counts=True) if places else (np.zeros(0, np.uint64), [])
            yield pd.DataFrame({"hash": found.view(np.int64), "n": n})

    rows = docs.select("text").mapInPandas(counted, "hash long, n long")
    return rows.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash")


def bit_map(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bit per hash modulo ``bits``; built in parts by the tasks, ``bits`` / 8 bytes in all."""
    place = F.pmod(F.col("hash"), F.lit(bits)) + 1  # Spark numbers buckets from 1: values 1 to 32768 are bucket 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.toLocalIterator():  # 4 KiB each
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = (row["bucket"] - 1) * len(part)
        out[at : at + len(part)] |= part
    return out


def factors(order: np.ndarray, reference: np.ndarray) -> list[tuple[int, int]]:
    """Greedy parse of found runs: first index and number of runs of each factor.

    ``order`` numbers the runs of the block with a gap between documents; ``reference`` is where each was found.
    """
    if not len(order):
        return []
    goes_on = (np.diff(order) == 1) & (np.diff(reference) == 1)
    start = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    return list(zip(start.tolist(), np.diff(np.concatenate([start, [len(order)]])).tolist()))


class Block:
    """Documents of one block: their runs, as columns."""

    def __init__(self) -> None:
        self.runs: list[np.ndarray] = []
        self.checks: list[np.ndarray] = []
        self.names: list[tuple[int | None, int]] = []
        self.starts: list[np.ndarray] = []
        self.held = 0

    def add(self, name: tuple[int | None, int], start: np.ndarray, run: np.ndarray, check: np.ndarray) -> None:
        self.names.append(name)
        self.starts.append(start)
        self.runs.append(run)
        self.checks.append((check >> np.uint64(33)).astype(np.int32))
        self.held += len(start)

    def parsed(self) -> pd.DataFrame:
        """Runs that are first in the block, and factors of those that are not, with a random ``run`` of their own.

        ``packed`` is 31 bits of a second hash, to another base, and the start, or, below zero, a factor's number of runs and its start.
        """
        sequence = sorted(range(len(self.names)), key=lambda k: (self.names[k][0] is not None, *((self.names[k][0] or 0), self.names[k][1])))
        lengths = np.array([len(self.starts[k]) for k in sequence])
        # Documents equal in id and text are one document to the order: none is earlier than the other.
        rank, ranks = 0, []
        for at, k in enumerate(sequence):
            rank += at > 0 and self.names[k] != self.names[sequence[at - 1]]
            ranks.append(rank)
        owner = np.repeat(np.arange(len(sequence)), lengths)
        document = np.repeat(np.array(ranks), lengths)
        start = np.concatenate([self.starts[k] for k in sequence]).astype(np.int64)
        run = np.concatenate([self.runs[k] for k in sequence])
        check = np.concatenate([self.checks[k] for k in sequence])
        place = (document << 32) + start  # order of the corpus within the block
        sort = np.lexsort((place, check, run))
        fresh = np.concatenate([[True], (run[sort][1:] != run[sort][:-1]) | (check[sort][1:] != check[sort][:-1])])
        first = np.empty(len(run), np.int64)
        first[sort] = place[sort][fresh][np.cumsum(fresh) - 1]
        later = first < place
        found = np.flatnonzero(later)
        spans = factors((owner[found] << 32) + start[found], first[found])
        at = found[[s for s, _ in spans]] if spans else np.zeros(0, np.int64)
        new = np.flatnonzero(~later)
        pick = np.concatenate([new, at])
        hashed = run[pick].view(np.int64).copy()
        hashed[len(new) :] = mixed(run[at] ^ place[at].astype(np.uint64) ^ np.uint64(BASE)).view(np.int64)
        names = [self.names[sequence[o]] for o in owner[pick].tolist()]
        return pd.DataFrame(
            {
                "run": hashed,
                "doc_id": pd.array([n for n, _ in names], dtype="Int64"),
                "tie": [t for _, t in names],
                "packed": np.concatenate([(check[new].astype(np.int64) << 32) + start[new], -1 - (np.array([n for _, n in spans], np.int64) << 32) - start[at]]),
            }
        )


def tie(text: Column) -> Column:
    """Tells rows apart that share an id."""
    return F.crc32(F.coalesce(text, F.lit("")))


def found_runs(docs: DataFrame, window: int, gram: int, bits: int) -> DataFrame:
    """Runs that occur earlier: ``doc_id``, ``tie``, ``start`` and ``runs`` (that many in a row)."""
    filled = docs.sparkSession.sparkContext.broadcast(bit_map(repeated_anchors(docs, window, gram), bits))

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bit, block = filled.value, Block()
        for batch in batches:
            for name, text in zip(names_of(batch), batch["text"]):
                words = word_hashes(text)
                anchor, _ = anchors(words, window, gram)
                place = (anchor.view(np.int64) % bits).astype(np.int64)
                start = np.flatnonzero((bit[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
                if len(start):
                    both = run_hashes(words, window)[start], run_hashes(words, window, again=True)[start]
                    block.add((name, zlib.crc32(text.encode("utf-8", "surrogatepass"))), start, *both)
                if block.held >= BUFFER:
                    yield block.parsed()
                    block = Block()
        if block.held:
            yield block.parsed()

    rows = docs.select(*exact_id("doc_id"), "text").mapInPandas(parsed, RUN)
    factor = F.col("packed") < 0
    whole = F.when(factor, -1 - F.col("packed")).otherwise(F.col("packed"))
    met = rows.repartition("run").select(
        "run", "doc_id", "tie", factor.alias("factor"), F.shiftright(whole, 32).alias("upper"), whole.bitwiseAND(F.lit(0xFFFFFFFF)).alias("start")
    )
    here = F.struct("doc_id", "tie", "start")
    earliest = F.min(here).over(Window.partitionBy("run", "upper"))
    earlier = met.withColumn("earlier", F.col("factor") | (earliest < here)).where("earlier")
    return earlier.select("doc_id", "tie", "start", F.when(F.col("factor"), F.col("upper")).otherwise(F.lit(1)).alias("runs"))


def cover(n_words: int, spans: np.ndarray, window: int) -> np.ndarray:
    """Per word whether a repeated run covers it. A span is its start times 2**32 plus its number of runs."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, spans >> 32, 1)
    np.add.at(change, (spans >> 32) + (spans & 0xFFFFFFFF) + window - 1, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int = FILTER_BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256``, and ``kept`` itself.

    A word is removed if a run of ``window`` words that covers it also starts earlier in the corpus: in a document
    with a smaller id, or earlier in the same one; runs are judged on the input. A null id is smaller than any
    other; rows that share an id are ordered by a checksum of their texts, and rows equal in both are one document
    to the order, so neither loses words to the other. A null text has no words. An empty table gives no rows.

    Two passes over the texts find the repeated runs; runs are shuffled once, as hashes, each at most once per
    block. The texts are shuffled once to meet their spans.
    """
    slim = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    span = F.shiftleft(F.col("start"), 32) + F.col("runs")
    spans = found_runs(slim, window, gram, bits).groupBy("doc_id", "tie").agg(F.collect_list(span).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("span_id"), F.col("tie").alias("span_tie"), "spans")
    known = slim.withColumn("tie", tie(F.col("text")))
    joined = known.join(spans, known["doc_id"].eqNullSafe(spans["span_id"]) & (known["tie"] == spans["span_tie"]), "left")

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch["text"], batch["spans"]):
                words = WORDS.findall(text or "")
                n = len(words)
                if spans is not None and len(spans):
                    gone = cover(n, np.asarray(spans, np.int64), window)
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                left = " ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(left.encode("utf-8", "surrogatepass")).hexdigest(), left))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept"])
            out.insert(0, "doc_id", ids_of(batch).array)
            yield out

    return joined.select(*exact_id("doc_id"), "text", "spans").mapInPandas(kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
