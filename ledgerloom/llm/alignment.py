"""Alignment of two tokenizers' tokens by bytes, with counts of aligned id pairs over the whole corpus.

Both tokenizers encode the whole text. Where tokens of both end at the same byte and both next tokens begin with a
space, the text is cut: the checked places are anchors, the token ids between two of them a window. A window's alignment depends
on its ids alone, and windows repeat as words do, so each alignment is remembered by the two tuples of ids.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.llm.batches import groups_of_rows
from ledgerloom.llm.columns import quoted
from ledgerloom.llm.encoding import encoder
from ledgerloom.llm.hashing import mixed
from ledgerloom.llm.storage import checkpointed, new_folder

FREQUENT = 1 << 18  # id pairs whose counts are sent to every task
REMEMBERED = 2 << 20  # links in remembered windows
HELD_PAIRS = 1 << 20
LONGER = re.compile("[^\x00-\u07ff]")  # characters of three bytes and more
ID_BITS = 32  # an id pair is one number: first id, second id in the lower bits


class Pieces:
    """A sentence-piece model: ids of texts, and the bytes of each id.

    Texts of characters of one and two bytes go through a native merger that takes the model's pieces as byte strings:
    characters of two bytes are put together first, then pieces by their score. No piece has a space after another
    character, so words are merged one by one. Bytes that are left over are byte pieces, as in the model. Other texts
    go through the model.
    """

    def __init__(self, path: str):
        import sentencepiece
        import tiktoken

        model = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.spelled = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        usual = [i for i in range(len(pieces)) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        by_byte = {self.spelled[i]: i for i in range(len(pieces)) if model.is_byte(i)}
        by_byte |= {self.spelled[i]: i for i in usual if len(self.spelled[i]) == 1}
        if len(by_byte) != 256 or any(re.search("[^▁]▁", pieces[i]) for i in usual):
            raise ValueError(f"{path}: not a model with pieces for all bytes and spaces in front")
        characters = [i for i in usual if len(pieces[i]) == 1 and len(self.spelled[i]) == 2]
        merged = sorted((i for i in usual if len(pieces[i]) > 1), key=lambda i: (-model.get_score(i), i))
        self.ids = np.array([*[by_byte[bytes([b])] for b in range(256)], *characters, *merged], np.uint32)
        ranks = {bytes([b]): b for b in range(256)} | {self.spelled[i]: 256 + k for k, i in enumerate([*characters, *merged])}
        self.merger = tiktoken.Encoding(path, pat_str=" *[^ ]+| +", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if text and LONGER.search(text):
            return np.array(self.model.encode(text), np.uint32)
        return self.ids[self.merger.encode_to_numpy(" " + text, disallowed_special=())] if text else self.ids[:0]


class Vocabulary:
    """What alignment needs of a tokenizer's ids: number of bytes, the id as text, whether it begins with a space."""

    def __init__(self, spelled: Sequence[bytes]):
        self.sizes = np.array([len(t) for t in spelled], np.int64)
        self.text = [str(i) for i in range(len(spelled))]
        self.spaced = np.array([t.startswith(b" ") for t in spelled])


class Windows(dict):
    """Number of each remembered window by its two tuples of ids (as bytes), and the alignments by number."""

    def __init__(self, first: Vocabulary, second: Vocabulary):
        self.first, self.second = first, second
        self.links, self.start = array("Q"), array("q", [0])
        self.text: list[str] = []
        self.groups = array("q")

    def learn(self, keys: Sequence[tuple[bytes, bytes]]) -> None:
        """Align new windows, all in one go: end to end, as both tuples of a window spell the same bytes.

        No token is empty. A link begins at every end of a token of either side; a group, at every end that both share.
        """
        if not keys:
            return
        tuples = list(zip(*keys))
        (a, a_ends), (b, b_ends) = (
            (ids := np.frombuffer(b"".join(t), "<u4"), np.cumsum(v.sizes[ids])) for t, v in zip(tuples, (self.first, self.second))
        )
        window_ends = a_ends[np.cumsum([len(t) // 4 for t in tuples[0]]) - 1]
        ends = np.union1d(a_ends, b_ends)
        links = a[np.searchsorted(a_ends, ends)].astype(np.uint64) << np.uint64(ID_BITS) | b[np.searchsorted(b_ends, ends)]
        near = np.searchsorted(b_ends, a_ends)
        shared = np.flatnonzero(b_ends[near] == a_ends)
        a_text, b_text = ([v.text[i] for i in ids.tolist()] for ids, v in ((a, self.first), (b, self.second)))
        a_stops, b_stops = [0, *(shared + 1).tolist()], [0, *(near[shared] + 1).tolist()]
        groups = [
            ",".join(a_text[i:j]) + "|" + ",".join(b_text[k:m]) for i, j, k, m in zip(a_stops, a_stops[1:], b_stops, b_stops[1:])
        ]
        stops = [0, *np.searchsorted(a_ends[shared], window_ends, "right").tolist()]
        self.text += [";".join(groups[i:j]) for i, j in zip(stops, stops[1:])]
        self.groups.extend(np.diff(stops).tolist())
        self.start.extend((len(self.links) + np.searchsorted(ends, window_ends, "right")).tolist())
        self.links.frombytes(links.tobytes())
        self.update(zip(keys, range(len(self), len(self) + len(keys))))


class Aligner:
    """Both tokenizers, their tables of token bytes, and the remembered windows of this Python process."""

    def __init__(self, byte_file: str, piece_file: str, remembered: int = REMEMBERED):
        self.first, self.second, self.remembered = encoder(byte_file), Pieces(piece_file), remembered
        self.vocabularies = Vocabulary(self.first.spelled), Vocabulary(self.second.spelled)
        self.windows = Windows(*self.vocabularies)

    def cut(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First tokens of the windows: they begin at shared ends after which both go on with a space."""
        if not len(a):
            return (np.zeros(0, np.int64),) * 2
        ends, places = [], []
        for ids, vocabulary in zip((a, b), self.vocabularies):
            before_space = np.flatnonzero(vocabulary.spaced[ids[1:]])
            ends.append(np.cumsum(vocabulary.sizes[ids])[before_space])
            places.append(before_space + 1)
        near = np.searchsorted(ends[1], ends[0])
        shared = near < len(ends[1])
        shared[shared] = ends[1][near[shared]] == ends[0][shared]
        return np.append(0, places[0][shared]), np.append(0, places[1][near[shared]])

    def number(self, a: np.ndarray, b: np.ndarray, a_starts: np.ndarray, b_starts: np.ndarray) -> np.ndarray:
        """The number of each window among the remembered ones; new ones are aligned first.

        Equal windows of the group are found by a hash and compared token by token, so each is looked up once.
        """
        sides = []
        for ids, starts in ((a, a_starts), (b, b_starts)):
            lengths = np.diff(starts, append=len(ids))
            first = np.repeat(starts, lengths)
            within = np.arange(len(ids)) - first
            hashed = mixed(ids.astype(np.uint64) + (within.astype(np.uint64) << np.uint64(32)))
            total = np.add.reduceat(hashed, starts) if len(starts) else np.zeros(0, np.uint64)
            sides.append((ids, starts, lengths, within, total))
        both = mixed(sides[0][4]) + sides[1][4]
        _, example, same_as = np.unique(both, return_index=True, return_inverse=True)
        differs = np.zeros(len(both), bool)
        for ids, starts, lengths, within, _ in sides:
            other = example[same_as]
            unlike = lengths != lengths[other]
            if not unlike.any() and len(ids):
                token_differs = ids[np.repeat(starts[other], lengths) + within] != ids
                unlike = np.add.reduceat(token_differs, starts, dtype=np.int64) > 0
            differs |= unlike
        if differs.any():  # another window with the same hash stands for itself
            same_as[differs] = len(example) + np.arange(int(differs.sum()))
            example = np.append(example, np.flatnonzero(differs))
        parts = []
        for ids, starts, lengths, _, _ in sides:
            data, first = ids.tobytes(), starts[example] * 4
            parts.append([data[s:e] for s, e in zip(first.tolist(), (first + lengths[example] * 4).tolist())])
        keys, known = list(zip(*parts)), self.windows
        found = list(map(known.get, keys))
        known.learn(list(dict.fromkeys([key for key, n in zip(keys, found) if n is None])))
        numbers = np.array([known[key] if n is None else n for key, n in zip(keys, found)], np.int64)
        return numbers[same_as]

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers for each text; none where a tokenizer's tokens do not spell the text."""
        none = np.zeros(0, "<u4")
        for text in texts:
            spelled = b" " + (text or "").encode()
            [a], b = self.first.encode([" " + (text or "")], plain=True), self.second.encode(text or "")
            # Merging bytes keeps them, which the lengths confirm; what the piece model itself says is spelled out.
            whole = text and all(int(v.sizes[ids].sum()) == len(spelled) for v, ids in zip(self.vocabularies, (a, b)))
            if whole and LONGER.search(text):
                whole = b"".join([self.second.spelled[i] for i in b.tolist()]) == spelled
            yield (a.astype("<u4"), b.astype("<u4")) if whole else (none, none)

    def align(self, texts: Sequence[str | None]) -> Iterator[tuple]:
        """For each text: numbers of tokens, groups and links, digest of the groups, distinct links and how often.

        The texts of a group are laid end to end. Each begins with a space, so windows never reach over a text's end.
        """
        if len(self.windows.links) > self.remembered:
            self.windows = Windows(*self.vocabularies)
        encoded = list(self.encode(texts))
        a, b = (np.concatenate([np.zeros(0, "<u4"), *[pair[side] for pair in encoded]]) for side in (0, 1))
        a_starts, b_starts = self.cut(a, b)
        numbers = self.number(a, b, a_starts, b_starts)
        known = self.windows
        starts, all_links, groups = (np.frombuffer(x, kind) for x, kind in ((known.start, "i8"), (known.links, "u8"), (known.groups, "i8")))
        lengths = starts[numbers + 1] - starts[numbers]
        link_ends = np.cumsum(lengths)
        links = all_links[np.repeat(starts[numbers] - (link_ends - lengths), lengths) + np.arange(lengths.sum())]
        group_ends, link_ends = np.cumsum(np.append(0, groups[numbers])), np.append(0, link_ends)
        del starts, all_links, groups
        written = [known.text[n] for n in numbers.tolist()]
        text_ends = np.cumsum([0, *[len(x) for x, _ in encoded]])
        windows = np.searchsorted(a_starts, text_ends)
        for (x, y), first, last in zip(encoded, windows[:-1].tolist(), windows[1:].tolist()):
            if not len(x):
                yield 0, 0, 0, 0, "", np.zeros(0, np.uint64), np.zeros(0, np.int64)
                continue
            own = links[link_ends[first] : link_ends[last]]
            pairs, times = np.unique(own, return_counts=True)
            digest = hashlib.sha256(";".join(written[first:last]).encode()).hexdigest()
            yield len(x), len(y), int(group_ends[last] - group_ends[first]), len(own), digest, pairs, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_file: str, piece_file: str) -> Aligner:
    if (byte_file, piece_file) not in _ALIGNERS:
        _ALIGNERS[byte_file, piece_file] = Aligner(byte_file, piece_file)
    return _ALIGNERS[byte_file, piece_file]


def planes(numbers: np.ndarray) -> bytes:
    """Whole numbers as bytes, all first bytes before all second ones: small numbers then compress well."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


LINKED = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]


def linked(docs: DataFrame, byte_file: str, piece_file: str, carry: Sequence[str], text: str) -> DataFrame:
    """Every document with its own figures and its distinct links, sorted, as differences in ``pairs``."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_file, piece_file)
        for batch in batches:
            for first, texts in groups_of_rows(batch):
                columns: list[list] = [[] for _ in LINKED]
                for *figures, pairs, times in tool.align(texts):
                    packed = planes(np.diff(pairs, prepend=np.uint64(0))), planes(times)
                    for column, value in zip(columns, (*figures, *packed)):
                        column.append(value)
                arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, LINKED)]
                row = batch.column("row").slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([row, *arrays], ["row", *[n for n, _ in LINKED]])

    slim = docs.select(F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(text).alias("text"))
    kinds = {pa.int64(): T.LongType(), pa.string(): T.StringType(), pa.binary(): T.BinaryType()}
    result = T.StructType([T.StructField("row", slim.schema["row"].dataType), *[T.StructField(n, kinds[k]) for n, k in LINKED]])
    return slim.mapInArrow(aligned, result)


def pair_counts(stored: DataFrame) -> DataFrame:
    """``pair``, ``n`` (documents that hold it) and ``best`` (no pair of the same first id is held by more).

    Every task adds up its pairs before the shuffle. A first id has at most as many pairs as the second vocabulary.
    """
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(pairs), 1 << 16):
            yield pa.record_batch([pa.array(pairs[at : at + (1 << 16)].view(np.int64)), pa.array(n[at : at + (1 << 16)])], schema)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [np.zeros(0, np.uint64)], 0
        for batch in batches:
            for value in batch.column("pairs"):
                pairs = np.cumsum(from_planes(value.as_py()), dtype=np.uint64)
                held.append(pairs)
                size += len(pairs)
                if size > HELD_PAIRS:
                    yield from counted(held)
                    held, size = held[:1], 0
        yield from counted(held)

    counts = stored.select("pairs").mapInArrow(added, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    same_first = Window.partitionBy(F.shiftright("pair", ID_BITS))
    return checkpointed(counts.withColumn("best", F.col("n") == F.max("n").over(same_first)))


def frequent_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs with the highest counts, ``most`` at most, sorted: pair, count, best."""
    level = F.floor(F.log2(F.col("n")) * 8).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    total, least = 0, 1 << 30
    for r in sorted(levels, key=lambda r: -r.level):
        total += r.pairs
        if total > most:
            break
        least = r.level
    chosen = counts.where(level >= least).toPandas().sort_values("pair")
    return chosen["pair"].to_numpy(np.int64), chosen["n"].to_numpy(np.int64), chosen["best"].to_numpy(bool)


def looked_up(stored: DataFrame, frequent: tuple[np.ndarray, np.ndarray, np.ndarray], kept: Sequence[str]) -> DataFrame:
    """``n_best`` and ``count_sum`` over a document's frequent links, and its other links as arrays."""
    shared = stored.sparkSession.sparkContext.broadcast(frequent)
    extra = [("n_best", pa.int64()), ("count_sum", pa.int64()), ("rare", pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())])))]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        known, n, best = np.append(known, -1), np.append(n, 0), np.append(best, False)  # so that there is a last one
        for batch in batches:
            columns: list[list] = [[], [], []]
            for p, t in zip(batch.column("pairs"), batch.column("times")):
                pairs = np.cumsum(from_planes(p.as_py()), dtype=np.uint64).view(np.int64)
                times = from_planes(t.as_py()).astype(np.int64)
                at = np.searchsorted(known[:-1], pairs)
                found = known[at] == pairs
                columns[0].append(int(times[found & best[at]].sum()))
                columns[1].append(int((times * n[at])[found].sum()))
                columns[2].append([{"pair": x, "times": y} for x, y in zip(pairs[~found].tolist(), times[~found].tolist())])
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, extra)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *arrays], [*kept, *[name for name, _ in extra]])

    link = T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())])
    result = T.StructType([stored.schema[c] for c in kept])
    result.add("n_best", T.LongType()).add("count_sum", T.LongType()).add("rare", T.ArrayType(link))
    return stored.select(*kept, "pairs", "times").mapInArrow(added, result)


def align_tokens(
    docs: DataFrame, byte_file: str, piece_file: str, carry: Sequence[str] | None = None, text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """One row per document: ``row`` (the carried columns, all by default), ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    The first tokenizer (byte-level) encodes a space and the text, the second (pieces) the text, to which it adds a space. A
    text that is null or empty, or that one of them does not spell back byte by byte, has no tokens: zeros and an
    empty digest. Groups lie between bytes where tokens of both end; links are all pairs of tokens with bytes in
    common. A pair of ids counts the documents that hold it linked; ``count_sum`` adds that up over a document's
    links, ``n_best`` counts the links whose pair has the highest count of its first id, ties included. Repeated rows
    are documents of their own; an empty table gives no rows.

    Texts are encoded once; links are kept in the shared folder, distinct per document. The counts of the ``frequent``
    most common pairs go to every task; the links whose pairs are none of these are joined, and none of them is hot.
    """
    spark = docs.sparkSession
    names = list(carry if carry is not None else docs.columns)
    folder = new_folder(spark, "alignment")
    numbered = linked(docs, byte_file, piece_file, names, text).withColumn("number", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(numbered.schema).parquet(folder)
    counts = pair_counts(stored)
    figures = ["row", "number", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    partly = checkpointed(looked_up(stored, frequent_pairs(counts, frequent), figures))
    rest = partly.select("number", F.explode("rare").alias("link")).select("number", "link.pair", "link.times")
    sums = rest.join(counts, "pair").groupBy("number").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_sum")
    )

    def both(common: str, rare: str) -> Column:
        return (F.col(common) + F.coalesce(rare, F.lit(0))).alias(common)

    joined = partly.drop("rare").join(sums, "number", "left")
    return joined.select("row", "n_a", "n_b", "n_groups", "n_links", both("n_best", "rare_best"), both("count_sum", "rare_sum"), "groups_sha256")
