"""Exact dedup, sharding and mixing against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerloom.llm import bit_filter, exact_dedup, mixing, sharding
from ledgerloom.llm.prefix import prefix_sums

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_exact_dedup_groups(make_docs, hard_rows):
    found = exact_dedup.copy_groups(make_docs(hard_rows)).collect()
    groups = defaultdict(list)
    for doc_id, text, _ in hard_rows:
        groups[text or ""].append(doc_id)
    expected = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        expected.update((i, keep, len(ids), i == keep) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found) == expected


def test_exact_dedup_keeps_one_row_of_each_text_and_all_columns(make_docs, hard_rows):
    docs = make_docs(hard_rows)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({t or "" for _, t, _ in hard_rows}) == len({r.text or "" for r in rows})
    assert {r.doc_id for r in rows if r.text == "alpha beta gamma"} == {4}


def test_exact_dedup_full_filter_changes_nothing(spark, make_docs, monkeypatch):
    asked = []

    def full(hashes, bits=0):
        asked.append(hashes)
        return bit_filter.bit_filter(spark.range(32768), 32768)

    monkeypatch.setattr(exact_dedup, "bit_filter", full)
    monkeypatch.setattr(exact_dedup, "may_hold", lambda value, hashed: bit_filter.may_hold(value, hashed, 32768))
    docs = make_docs([(i, f"{i % 300} text") for i in range(900)] + [(1000 + i, f"single {i}") for i in range(50)])
    rows = exact_dedup.copy_groups(docs).collect()
    assert len(asked) == 2 and {r.group_size for r in rows if r.doc_id < 900} == {3} and {r.group_size for r in rows if r.doc_id >= 1000} == {1}


def jump(key: int, shards: int) -> int:
    b, j = -1, 0
    key &= (1 << 64) - 1
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 40, 1000])
def test_jump_hash_is_the_published_one(spark, shards):
    from pyspark.sql import functions as F

    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), 123456789] + [k * 7919 for k in range(300)]
    found = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), shards).alias("s"))
    assert {r.k: r.s for r in found.collect()} == {k: jump(k, shards) for k in keys}


def test_shards(make_docs, hard_rows):
    rows = sharding.shard_documents(make_docs(hard_rows), shards=3).collect()
    assert len(rows) == len(hard_rows)
    for row in rows:
        assert row.shard == jump(row.doc_id or 0, 3) and row.grown_shard in (row.shard, 3)
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in hard_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == sizes


def targets(sizes: dict, share=1.5, most=2.0) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left = {s: w for s, w in weight.items() if s not in fixed}
        rest = total - sum(fixed.values())
        given = {s: rest * w / sum(left.values()) for s, w in left.items()}
        above = {s: most * sizes[s] for s, g in given.items() if g > most * sizes[s]}
        if not above:
            return fixed | given
        fixed |= above


def test_mix(make_docs, hard_rows):
    docs = make_docs(hard_rows)
    rows = mixing.mix_plan(docs).collect()
    assert len(rows) == len(hard_rows)
    sizes = Counter()
    for _, text, source in hard_rows:
        sizes[source] += len(WORD.findall(text or ""))
    expected = targets(sizes)
    by_target = defaultdict(int)
    for row in rows:
        assert row.taken == row.copies * row.size and 0 <= row.copies <= 2
        by_target[round(row.target, 6), row.source_size] += row.taken
    assert set(by_target) == {(round(expected[s], 6), sizes[s]) for s in sizes}
    longest = 30_000
    assert all(abs(taken - target) <= min(longest, size) for (target, size), taken in by_target.items())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)


def test_mix_comes_near_its_targets(make_docs):
    docs = make_docs([(i, "w " * (i % 50 + 1), f"s{i % 2}") for i in range(2000)])
    rows = mixing.mix_plan(docs).collect()
    assert rows == sorted(mixing.mix_plan(docs).collect(), key=rows.index)
    for target in {r.target for r in rows}:
        assert abs(sum(r.taken for r in rows if r.target == target) - target) <= 50


def test_prefix_sums(spark):
    import random

    random.seed(1)
    rows = [(random.choice("ab"), random.randrange(4), random.randrange(3), k, random.randrange(9)) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, one int, two int, k int, v long")
    found = {r.k: r.total for r in prefix_sums(df, ["g"], ["one", "two"], ["k"], value="v", name="total").collect()}
    ordered = sorted(rows)
    for g, one, two, k, _ in rows:
        assert found[k] == sum(r[4] for r in ordered if r[0] == g and r[:4] < (g, one, two, k))


def test_empty_tables(empty_docs):
    assert exact_dedup.copy_groups(empty_docs).count() == exact_dedup.drop_copies(empty_docs).count() == 0
    assert sharding.shard_documents(empty_docs).count() == mixing.mix_plan(empty_docs).count() == mixing.mix(empty_docs).count() == 0


def test_digest(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(1, "ü"), (2, None)]).withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = {r.doc_id: r.digest for r in exact_dedup.copy_groups(docs, carry=("digest",)).collect()}
    assert found == {1: hashlib.sha256("ü".encode()).hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
