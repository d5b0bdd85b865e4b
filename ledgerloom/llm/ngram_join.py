"""Similarity join of documents by the Jaccard index of their word shingles, as a blocked sparse matrix product.

Two sets with 100 * intersection >= threshold * union differ in few shingles, by a bound that follows from their
sizes. If the shingles are dealt to one part more than they may differ in, at least one part is the same in both.
So sets that share a part are candidates, and candidates are gathered into blocks; within a block the product of
the document by shingle incidence with its transpose gives all overlaps, and pairs below the bound that their
sizes set are discarded.

Sets that share a part by a common passage would gather in groups that grow much faster than the table. So each set
has a sketch, the numbers of its shingles in 128 buckets: two sets differ in at least as many shingles as their
sketches do, and sets whose sketches differ too much are not candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.batches import ids_of
from ledgerloom.llm.bit_filter import bit_filter, may_hold
from ledgerloom.llm.columns import exact_id, quoted, whole_row
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.hashing import BASE, mixed, shingle_set, word_hashes
from ledgerloom.llm.storage import checkpointed, release_shuffles

WORDS = 3
PERCENT = 90
BLOCK = 512  # sets in a block of the product
NEEDED_PER_SPARE = 3  # one part more than needed for so many, so that the weakest parts need no signature
BUFFER = 1_000_000
BUCKETS = 128  # numbers in a sketch
HOT = 64  # sets of a buffer that share a signature, from which on like ones leave it as one row
LEADERS = 64  # rows at most that such sets are joined to
SMALL = 64  # sets that are compared by their sketches at once
COMPARED = 1 << 26  # pairs of sketches compared in a group at most
DENSE = 16  # a shingle in more sets of a block than this is a column of a dense product
COLUMNS = 4096


@dataclass(frozen=True)
class Bounds:
    """What set sizes say about linked pairs: 100 * intersection >= percent * union."""

    percent: int

    def classes(self, largest: int) -> np.ndarray:
        """First sizes of size classes such that linked sets are in the same class or in neighbouring ones."""
        first = [1, 2]
        while first[-1] <= largest:
            first.append(max(first[-1] + 1, (first[-1] - 1) * 100 // self.percent + 1))
        return np.array(first)

    def differing(self, smaller: int) -> int:
        """In how many shingles a set of this size and a linked one, at least as large, can differ."""
        larger = smaller * 100 // self.percent
        return (smaller + larger) * (100 - self.percent) // (100 + self.percent)

    def linked(self, overlap: np.ndarray, total: np.ndarray) -> np.ndarray:
        """``total`` is the sum of both sizes."""
        return (overlap > 0) & ((100 + self.percent) * overlap >= self.percent * total)

    def close(self, apart: np.ndarray, size: np.ndarray, other: np.ndarray, times: int = 1) -> np.ndarray:
        """Whether sets of these sizes that differ in ``apart`` shingles or more can be linked; the same for ``times`` as many."""
        alike = np.minimum(size, other) * 100 >= np.maximum(size, other) * self.percent
        return alike & (times * apart * (100 + self.percent) <= (size + other) * (100 - self.percent))


def set_hash(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a whole set."""
    summed = mixed(mixed(shingles) + np.uint64(BASE)).sum(dtype=np.uint64)
    return int(mixed(np.array([summed + np.uint64(len(shingles))]))[0].astype(np.int64))


def part_signatures(shingles: np.ndarray, size_class: int, first: np.ndarray, bounds: Bounds) -> np.ndarray:
    """Signatures of a set's parts, as signed 64-bit numbers.

    Scheme c compares sets whose smaller one is in class c, so a set takes part in the schemes of its own class and
    of the class below. With n spare parts, linked sets agree in n + 1 parts or more. Every set leaves out its n
    weakest parts, by number of shingles and then by signature, which are the same in agreeing parts: the strongest
    agreeing part has n agreeing parts below it, so neither set leaves it out. Parts of no or one shingle, which
    sets that are not alike often share, are thus rarely named.
    """
    out = []
    chosen, content = mixed(shingles ^ np.uint64(BASE)), mixed(shingles)
    low, high = (content & np.uint64(0xFFFFFFFF)).astype(np.float64), (content >> np.uint64(32)).astype(np.float64)
    for scheme in (size_class - 1, size_class):
        if scheme < 0:
            continue
        needed = bounds.differing(int(first[scheme + 1]) - 1) + 1
        spare = needed // NEEDED_PER_SPARE
        parts = needed + spare
        part = (chosen % np.uint64(parts)).astype(np.int64)
        held = np.bincount(part, minlength=parts)
        # Sums of fewer than 2**21 numbers of 32 bits are exact in doubles.
        lows, highs = np.bincount(part, low, parts).astype(np.uint64), np.bincount(part, high, parts).astype(np.uint64)
        name = np.arange(parts, dtype=np.uint64) + np.uint64((scheme + 1) << 32)
        signature = mixed(mixed(mixed(name) + lows) + mixed(highs + np.uint64(1)) + held.astype(np.uint64))
        out.append(signature[np.lexsort((signature, held))[spare:]])
    return np.concatenate(out).view(np.int64)


def shingles_of(text: str | None, words: int) -> np.ndarray:
    return shingle_set(word_hashes(text, lower=True), words)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """How many shingles are in each bucket, 255 at most, which brings two sketches nearer to each other but never apart."""
    held = np.bincount((shingles >> np.uint64(57)).astype(np.int64), minlength=BUCKETS)
    return np.minimum(held, 255).astype(np.uint8)


def apart(sketches: np.ndarray, other: np.ndarray) -> np.ndarray:
    """By how much sketches differ: a metric, and no more than the number of shingles in which the sets differ."""
    return (np.maximum(sketches, other) - np.minimum(sketches, other)).sum(axis=-1, dtype=np.uint16).astype(np.int64)


def described(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` (hash of the set) and ``sketch`` per row of ``docs`` (``doc_id``, ``text``)."""

    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles_of(t, words) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": ids_of(batch),
                    "n_shingles": [len(s) for s in sets],
                    "node": [set_hash(s) for s in sets],
                    "sketch": [sketch(s).tobytes() for s in sets],
                }
            )

    return docs.select(*exact_id("doc_id"), "text").mapInPandas(sized, "doc_id long, n_shingles long, node long, sketch binary")


def led(size: np.ndarray, sketches: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Per set its leader, and per leader how far away the sketches of its sets are at most.

    A set's leader is itself or one whose sketch is half as far from its own as a linked set's may be.
    """
    leader, reach, left = np.arange(len(size)), np.zeros(len(size), np.int64), np.arange(len(size))
    for _ in range(LEADERS):
        if len(left) < 2:
            break
        first, others = left[0], left[1:]
        away = apart(sketches[others], sketches[first])
        like = bounds.close(away, size[others], size[first], times=2)
        leader[others[like]] = first
        reach[first] = away[like].max(initial=0)
        left = others[~like]
    return leader, reach


def tied(size: np.ndarray, reach: np.ndarray, sketches: np.ndarray, bounds: Bounds) -> np.ndarray:
    """Label the sets of one signature: all that may be linked, or lead sets that may be, have the same label.

    The label is the least index. Sets that have a label in common already are not compared again. A group in which
    more than ``COMPARED`` pairs would have to be is given one label from there on: that gathers more sets than need be.
    """

    def may_be_linked(i, others) -> np.ndarray:
        away = apart(sketches[others], sketches[i])
        # What two leaders stand for is in neighbouring size classes, as they are.
        largest = np.minimum(size[others], size[i]) * 100 // bounds.percent
        through = away <= bounds.differing(largest) + reach[others] + reach[i]
        return np.where(reach[others] + reach[i] > 0, through, bounds.close(away, size[others], size[i]))

    n = len(size)
    every = np.arange(n)
    if n <= SMALL:
        return roots(may_be_linked(every[:, None], every[None]))
    label, compared = every.copy(), 0
    for i in range(n - 1):
        others = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        compared += len(others)
        if compared > COMPARED:
            return np.zeros(n, np.int64)
        if not len(others):
            if (label == label[0]).all():
                break
            continue
        found = np.unique(label[others[may_be_linked(i, others)]])
        if len(found):
            label[np.isin(label, found)] = label[i]
    least = np.full(n, n)
    np.minimum.at(least, label, every)
    return least[label]


def candidate_edges(docs: DataFrame, sketches: DataFrame, words: int, bounds: Bounds) -> DataFrame:
    """Edges ``u``, ``v`` between nodes such that all sets that share a part, and may be linked by their sketches, are connected.

    ``sketches`` has ``node``, ``n`` (its size) and ``sketch``. Where many sets of a task share a signature, like ones
    leave it as one row per buffer, with their leader's ``reach``. A signature of a single set goes no further, of
    signatures that the same sets share one does, and the sketches join what is left. Each group of sets that share a
    signature is then compared by its sketches, and only the links of a spanning forest leave a task.
    """

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = bounds.classes(1 << 20)
        nodes, sizes, counts, signatures, held = [], [], [], [], 0

        def flush() -> pd.DataFrame:
            of = np.repeat(np.arange(len(nodes)), [len(s) for s in signatures])
            signature, own = np.concatenate(signatures), np.array(nodes)
            order = np.lexsort((own[of], signature))
            signature, of = signature[order], of[order]
            fresh = np.concatenate([[True], (signature[1:] != signature[:-1]) | (own[of[1:]] != own[of[:-1]])])
            signature, of = signature[fresh], of[fresh]
            reach, alone, behind = np.zeros(len(of), np.int64), np.ones(len(of), bool), []
            start = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]]))
            length = np.diff(np.concatenate([start, [len(signature)]]))
            size, sketched = np.array(sizes), np.array(counts)
            for at, n in zip(start[length >= HOT], length[length >= HOT]):
                some = of[at : at + n]
                leader, reach[at : at + n] = led(size[some], sketched[some], bounds)
                hidden = leader != np.arange(n)
                alone[at : at + n] = ~hidden
                behind.append(np.stack([own[some[hidden]], own[some[leader[hidden]]]], axis=1))
            node = own[of]
            if behind:
                # A set and its leader share a signature of their own.
                pairs = np.unique(np.concatenate(behind), axis=0)
                mixture = mixed(mixed(pairs[:, 0].astype(np.uint64)) + pairs[:, 1].astype(np.uint64)).view(np.int64)
                signature = np.concatenate([signature[alone], mixture, mixture])
                node = np.concatenate([node[alone], pairs[:, 0], pairs[:, 1]])
                reach = np.concatenate([reach[alone], np.zeros(2 * len(pairs), np.int64)])
            # Most rows lead nothing, and a null takes less room in the shuffle.
            return pd.DataFrame({"signature": signature, "node": node, "reach": pd.arrays.IntegerArray(reach, reach == 0)})

        for batch in batches:
            for text in batch["text"]:
                shingles = shingles_of(text, words)
                if not len(shingles):
                    continue
                if len(shingles) >= first[-1]:
                    first = bounds.classes(2 * len(shingles))
                size_class = int(np.searchsorted(first, len(shingles), "right")) - 1
                signatures.append(part_signatures(shingles, size_class, first, bounds))
                nodes.append(set_hash(shingles))
                sizes.append(len(shingles))
                counts.append(sketch(shingles))
                held += len(signatures[-1])
                if held >= BUFFER:
                    yield flush()
                    nodes, sizes, counts, signatures, held = [], [], [], [], 0
        if held:
            yield flush()

    def spanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []

        def done() -> tuple[np.ndarray, np.ndarray]:
            node, size, reach, counts = (np.concatenate(v) if len(held) > 1 else v[0] for v in zip(*held))
            label = tied(size, reach, counts, bounds)
            to = np.flatnonzero(label != np.arange(len(label)))
            return node[to], node[label[to]]

        def edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
            return pd.DataFrame({"u": np.concatenate([u for u, _ in found]), "v": np.concatenate([v for _, v in found])})

        for batch in batches:
            if not len(batch):
                continue
            found, keys = [], batch["members"].to_numpy()
            counts = np.frombuffer(b"".join(batch["sketch"]), np.uint8).reshape(-1, BUCKETS)
            values = [*(batch[c].to_numpy().astype(np.int64) for c in ("node", "n", "reach")), counts]
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            for a, b in zip(start, [*start[1:], len(keys)]):
                if held and keys[a] != key:
                    found.append(done())
                    held = []
                key = keys[a]
                held.append([v[a:b] for v in values])
            if found:
                yield edges(found)
        if held:
            yield edges([done()])

    rows = docs.select("text").mapInPandas(signed, "signature long, node long, reach long")
    same = Window.partitionBy("signature")
    several = rows.select(
        "node",
        "reach",
        F.min("node").over(same).alias("least"),
        F.max("node").over(same).alias("most"),
        F.count(F.lit(1)).over(same).alias("rows"),
        F.bit_xor("node").over(same).alias("mixture"),
    ).where("least <> most")
    members = F.xxhash64("least", "most", "rows", "mixture").alias("members")
    groups = several.select(members, "node", "reach").groupBy("members", "node").agg(F.coalesce(F.max("reach"), F.lit(0)).alias("reach"))
    gathered = groups.join(sketches, "node").repartition("members").sortWithinPartitions("members", "node")
    return gathered.select("members", "node", "n", "reach", "sketch").mapInPandas(spanned, "u long, v long").distinct()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that each two of the sets share: the incidence matrix times its transpose.

    Shingles of one set only add nothing. Rare ones add their pairs, common ones are columns of dense blocks.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shingle = np.concatenate(sets)
    order = np.argsort(shingle, kind="stable")
    owner, shingle = owner[order], shingle[order]
    start = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    count = np.diff(np.concatenate([start, [len(shingle)]]))
    total = np.zeros(n * n, np.float64)
    for d in range(2, DENSE + 1):
        rows = owner[start[count == d][:, None] + np.arange(d)]
        for i in range(d):
            for j in range(i):
                total += np.bincount(rows[:, i] * n + rows[:, j], minlength=n * n)
    total = total.reshape(n, n)
    total = total + total.T
    common = np.flatnonzero(count > DENSE)
    for at in range(0, len(common), COLUMNS):
        some = common[at : at + COLUMNS]
        block = np.zeros((n, len(some)), np.float32)
        column = np.repeat(np.arange(len(some)), count[some])
        entry = np.repeat(start[some] - (np.cumsum(count[some]) - count[some]), count[some]) + np.arange(count[some].sum())
        block[owner[entry], column] = 1
        total += block @ block.T
    return total


def roots(linked: np.ndarray) -> np.ndarray:
    """The least index of each row's component in a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None], len(label)).min(axis=1, initial=len(label))
        following = np.minimum(label, least)
        following = following[following]
        if (following == label).all():
            return label
        label = following


def blocks(sets: DataFrame) -> DataFrame:
    """Deal sets to the blocks in which they are compared: adds ``low``, ``high`` (block pair) and ``side``.

    A small group is one block. The sets of a large one are split by size class and hash; two blocks are compared
    if their classes are equal or neighbours, so every pair that sizes allow meets exactly once.
    """
    sizes = sets.groupBy("component", "size_class").agg(F.count(F.lit(1)).alias("n"))
    shape = sizes.groupBy("component").agg(
        F.sum("n").alias("sets"), F.collect_list(F.struct("size_class", F.ceil(F.col("n") / BLOCK).alias("salts"))).alias("classes")
    )
    known = sets.join(shape, "component").where("sets > 1")
    own_salts = F.filter("classes", lambda c: c["size_class"] == F.col("size_class"))[0]["salts"]
    code = 1 << 32
    own = F.col("size_class") * code + F.pmod(F.col("node"), own_salts)
    near = F.filter("classes", lambda c: F.abs(c["size_class"] - F.col("size_class")) <= 1)
    others = F.flatten(F.transform(near, lambda c: F.transform(F.sequence(F.lit(0).cast("long"), c["salts"] - 1), lambda s: c["size_class"] * code + s)))
    split = F.col("sets") > BLOCK
    met = known.withColumn("own", F.when(split, own).otherwise(F.lit(0).cast("long")))
    met = met.withColumn("other", F.explode(F.when(split, others).otherwise(F.array(F.lit(0).cast("long")))))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return met.select("component", low.alias("low"), high.alias("high"), side.alias("side"), "node", "copies", "shingles")


def compare(rows: pd.DataFrame, bounds: Bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one block: nodes, the least linked node that reaches each, and the number of documents linked to each."""
    sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    node, copies, side = (rows[c].to_numpy() for c in ("node", "copies", "side"))
    size = np.array([len(s) for s in sets])
    linked = bounds.linked(overlaps(sets), size[:, None] + size[None])
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None]
    order = np.argsort(node, kind="stable")  # so that the least index is the least node
    label = roots(linked[np.ix_(order, order)])
    root = np.empty_like(node)
    root[order] = node[order][label]
    return node, root, linked @ copies


def links(dealt: DataFrame, bounds: Bounds) -> DataFrame:
    """``node``, ``root`` and ``links`` per set and block; blocks are whole within a task, one at a time."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []

        def done() -> pd.DataFrame:
            node, root, linked = compare(pd.concat(held), bounds)
            return pd.DataFrame({"node": node, "root": root, "links": linked.astype(np.int64)})

        for batch in batches:
            for name, rows in batch.groupby(["component", "low", "high"], sort=True):
                if name != key and held:
                    yield done()
                    held = []
                key = name
                held.append(rows)
        if held:
            yield done()

    keys = ["component", "low", "high"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInPandas(compared, "node long, root long, links long")


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``n_links``.

    A document's set is its distinct shingles of ``words`` words in lower case (A-Z only); a shorter text is one
    shingle, a null or blank one has none and is linked to nothing. ``component_id`` is the smallest id that links
    reach, ``n_links`` the number of other documents linked directly. A null id is smaller than any other. Rows that
    repeat an id and text are documents of their own with equal sets. An empty table gives no rows.

    Documents with equal sets are one node from the start, so thousands of copies cost one comparison. Sets that
    share a part, and whose sketches do not say that they differ too much, are gathered by connected components; their texts are read once more and only their sets are
    shuffled. Components beyond one block are compared block by block. A set is known by a 64-bit hash.
    """
    bounds = Bounds(percent)
    slim = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    described_once = checkpointed(described(slim, words))
    known = described_once.drop("sketch")
    nodes = known.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("some_id"), F.min("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"), F.count("doc_id").alias("named")
    )
    sketched = described_once.where("n_shingles > 0").groupBy("node").agg(F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch"))
    candidates = checkpointed(candidate_edges(slim, sketched, words, bounds))
    gathered = connected_components(candidates)
    wanted = checkpointed(nodes.join(gathered, "node"))
    release_shuffles(docs.sparkSession)
    first = bounds.classes(1 << 24).tolist()

    def with_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles_of(t, words) for t in batch["text"]]
            size_class = np.searchsorted(first, [len(s) for s in sets], "right") - 1
            batch = batch.assign(shingles=[s.tobytes() for s in sets], size_class=size_class, own=[set_hash(s) for s in sets])
            yield batch.loc[batch["own"] == batch["node"], ["component", "node", "copies", "size_class", "shingles"]]

    named = F.xxhash64("doc_id")
    reader = wanted.select(F.col("some_id").alias("doc_id"), "node", "copies", "component")
    texts = slim.where(may_hold(bit_filter(reader.select(named.alias("hash"))), named))
    read = texts.join(reader, texts["doc_id"].eqNullSafe(reader["doc_id"])).select("text", "component", "node", "copies")
    sets = read.mapInPandas(with_sets, "component long, node long, copies long, size_class long, shingles binary")
    sets = checkpointed(sets.dropDuplicates(["node"]))
    found = checkpointed(links(blocks(sets), bounds))
    release_shuffles(docs.sparkSession)
    joined = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    others = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.join(joined, "node", "left").join(others, "node", "left")
    component = F.coalesce("component", "node")
    # A null id is smaller than any other.
    without_name = F.max(F.when(F.col("named") < F.col("copies"), 1).otherwise(0))
    least = placed.groupBy(component.alias("component")).agg(F.when(without_name == 0, F.min("first_id")).alias("component_id"))
    answer = placed.select("node", component.alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")).join(least, "component")
    lookup = answer.select("node", "component_id", "n_links", F.lit(True).alias("linkable"))
    # Empty sets share a node but are linked to nothing.
    key = F.when(F.col("n_shingles") > 0, F.col("node")).otherwise(F.xxhash64("doc_id"))
    spread = known.withColumn("node", key)
    whole = spread.join(lookup, "node", "left")
    linkable = F.col("linkable") & (F.col("n_shingles") > 0)
    return whole.select(
        "doc_id",
        "n_shingles",
        F.when(linkable, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linkable, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the group's smallest id.

    Rows that repeat that id stay too if their texts are in the group; remove exact copies before. Only documents
    that may have to go are shuffled.
    """
    groups = similar_groups(docs, words, percent, doc_id, text)
    dropped = checkpointed(groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("dropped_id")).distinct())
    hashed = F.xxhash64(quoted(doc_id).cast("long"))
    maybe = may_hold(bit_filter(dropped.select(F.xxhash64("dropped_id").alias("hash"))), hashed)
    rows = docs.where(maybe).select(whole_row(docs), quoted(doc_id).cast("long").alias("own_id"))
    kept = rows.join(dropped, rows["own_id"].eqNullSafe(dropped["dropped_id"]), "left_anti").select("row.*")
    return docs.where(~maybe).unionByName(kept)
