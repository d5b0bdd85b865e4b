"""Substring dedup and the n-gram join against plain versions."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from ledgerloom.llm import components, hashing, ngram_join, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_removal(rows, window=20):
    """Rows equal in id and text are one document to the order."""
    order = lambda r: (r[0] is not None, r[0] or 0, substring_dedup.zlib.crc32((r[1] or "").encode()))
    first, out = {}, []
    for row in sorted(rows, key=order):
        words = WORD.findall(row[1] or "")
        gone = set()
        for s in range(len(words) - window + 1):
            at = (*order(row), s)
            if first.setdefault(tuple(words[s : s + window]), at) < at:
                gone.update(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((row[0], len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def removal(docs, **more):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs, **more).collect())


def test_removal_of_hard_rows(make_docs, hard_rows):
    assert removal(make_docs(hard_rows)) == plain_removal(hard_rows)


@pytest.mark.parametrize("seed", range(3))
def test_removal_of_random_texts(make_docs, seed, monkeypatch):
    draw = random.Random(seed)
    passages = [[draw.choice("abcdefgh") * draw.randint(1, 2) for _ in range(draw.randint(15, 60))] for _ in range(6)]
    rows = []
    for k in range(60):
        words = [draw.choice("ab") for _ in range(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 3)):
            passage = draw.choice(passages)
            a = draw.randint(0, len(passage) - 1)
            words += passage[a:] + [draw.choice("xyz") for _ in range(draw.randint(0, 25))]
        rows.append((draw.randint(0, 70), " ".join(words)))
    monkeypatch.setattr(substring_dedup, "BUFFER", 200)
    assert removal(make_docs(rows), bits=1 << 16) == plain_removal(rows)
    # A full filter costs time only.
    monkeypatch.setattr(substring_dedup, "bit_map", lambda hashes, bits: np.full(bits // 8, 255, np.uint8))
    assert removal(make_docs(rows), bits=1 << 16) == plain_removal(rows)


def test_factors_end_where_the_reference_does_not_go_on():
    assert substring_dedup.factors(np.array([5, 6, 7, 8, 20]), np.array([1, 2, 9, 10, 11])) == [(0, 2), (2, 2), (4, 1)]
    assert substring_dedup.factors(np.array([]), np.array([])) == []


def shingles(text, words):
    found = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    n = min(words, len(found))
    return {tuple(found[k : k + n]) for k in range(len(found) - n + 1)} if found else set()


def plain_groups(rows, words, percent):
    sets = [shingles(t, words) for _, t, *_ in rows]
    label, linked = list(range(len(rows))), [0] * len(rows)
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            linked[i] += 1
            linked[j] += 1
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    order = lambda i: (i is not None, i or 0)
    return Counter((r[0], len(sets[k]), min((rows[m][0] for m in range(len(rows)) if label[m] == label[k]), key=order), linked[k]) for k, r in enumerate(rows))


def groups(docs, words, percent):
    found = ngram_join.similar_groups(docs, words, percent).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found)


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_groups_of_hard_rows(make_docs, hard_rows, words, percent):
    assert groups(make_docs(hard_rows), words, percent) == plain_groups(hard_rows, words, percent)


@pytest.mark.parametrize("seed, block", [(0, 512), (1, 16), (2, 5)])
def test_groups_of_random_texts(make_docs, seed, block, monkeypatch):
    draw = random.Random(seed)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    bases = [[f"{b}w{draw.randrange(400)}" for _ in range(draw.choice([4, 9, 12, 30, 100, 260]))] for b in range(8)]
    rows = []
    for k in range(150):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
            words[draw.randrange(len(words))] = f"c{draw.randrange(5)}"
        rows.append((k, " ".join(words[: len(words) - draw.choice([0, 0, 1, 5])])))
    for words, percent in ((3, 90), (5, 80)):
        assert groups(make_docs(rows), words, percent) == plain_groups(rows, words, percent)


@pytest.mark.parametrize("dense", [1, 3, 16, 100])
def test_overlaps_by_pairs_and_by_dense_columns(monkeypatch, dense):
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    draw = np.random.default_rng(dense)
    sets = [np.unique(draw.integers(0, 60, draw.integers(0, 40)).astype(np.uint64)) for _ in range(30)]
    found = ngram_join.overlaps(sets)
    assert all(found[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)


@pytest.mark.parametrize("percent, loss", [(90, 5), (80, 3)])
def test_linked_sets_share_a_signature(percent, loss):
    draw = random.Random(4)
    bounds = ngram_join.Bounds(percent)
    first = bounds.classes(5000)
    signed = lambda s: set(ngram_join.part_signatures(np.array(sorted(s), np.uint64), int(np.searchsorted(first, len(s), "right")) - 1, first, bounds).tolist())
    for _ in range(300):
        n = draw.choice([1, 2, 5, 9, 10, 11, 19, 20, 100, 1000])
        one = {draw.getrandbits(64) for _ in range(n)}
        two = set(one)
        for _ in range(draw.randint(0, n // loss + 1)):
            if draw.random() < 0.5:
                two.add(draw.getrandbits(64))
            elif len(two) > 1:
                two.remove(draw.choice(sorted(two)))
        if 100 * len(one & two) >= percent * len(one | two):
            assert signed(one) & signed(two)


def test_sets_with_a_common_passage_are_not_gathered(make_docs, monkeypatch):
    draw, dealt, blocks = random.Random(5), [], ngram_join.blocks
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "blocks", lambda sets: dealt.append(blocks(sets).count()) or blocks(sets))
    passage = " ".join(f"p{k}" for k in range(9))
    rows = [(k, f"{passage} " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(8))) for k in range(240)]
    rows += [(1000 + k, f"{rows[k][1]} {'more' * (k % 2)}") for k in range(3)]
    assert groups(make_docs(rows), 5, 80) == plain_groups(rows, 5, 80)
    assert dealt[0] < 40


def test_linked_sets_are_tied_through_their_leaders():
    draw = np.random.default_rng(6)
    bounds = ngram_join.Bounds(80)
    bases = [draw.integers(0, 2**64, 200, dtype=np.uint64) for _ in range(3)]
    sets = []
    for k in range(240):
        changed = bases[k % 3].copy()
        some = draw.choice(200, draw.integers(0, 40), replace=False)
        changed[some] = draw.integers(0, 2**64, len(some), dtype=np.uint64)
        sets.append(np.unique(changed))
    size, sketches = np.array([len(s) for s in sets]), np.array([ngram_join.sketch(s) for s in sets])
    leader, reach = ngram_join.led(size, sketches, bounds)
    left = np.flatnonzero(leader == np.arange(len(sets)))
    assert 3 <= len(left) < len(sets)
    for rows in (left, np.arange(len(sets)), np.arange(50)):
        label = ngram_join.tied(size[rows], (reach if rows is left else reach * 0)[rows], sketches[rows], bounds)
        assert (label <= np.arange(len(rows))).all() and (rows[label] % 3 == rows % 3).all()
        place = {r: k for k, r in enumerate(rows.tolist())}
        for i, j in combinations(range(len(sets) if rows is left else len(rows)), 2):
            overlap = np.array(len(np.intersect1d(sets[i], sets[j])))
            if bounds.linked(overlap, size[i] + size[j]):
                a, b = (place[leader[k] if rows is left else k] for k in (i, j))
                assert label[a] == label[b]


def test_one_of_each_group(make_docs, hard_rows):
    docs = make_docs(hard_rows)
    kept = ngram_join.one_of_each_group(docs, 5, 80)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert 10 in ids and 11 not in ids and 12 not in ids and ids[5] == 2 and ids[3] == ids[6] == 1


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7)]
    label = {n: n for e in edges for n in e}
    for a, b in edges:
        x, y = label[a], label[b]
        label = {n: min(x, y) if v in (x, y) else v for n, v in label.items()}
    found = components.connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {r.node: r.component for r in found.collect()} == label


def test_hashes():
    a, b = hashing.word_hashes("Ab é ab"), hashing.word_hashes("  ab\tÉ\nAb ", lower=True)
    assert len(a) == len(b) == 3 and a[0] != a[2] and b[0] == b[2] == a[2] and a[1] != b[1]
    words = hashing.word_hashes("a b c a b c")
    assert len(set(hashing.run_hashes(words, 3).tolist())) == 3 and len(hashing.run_hashes(words, 7)) == 0
    values = np.array([5, 1, 4, 2, 8, 3], np.uint64)
    assert hashing.sliding(values, 3, np.minimum).tolist() == [1, 1, 2, 2]


def test_empty_tables(empty_docs):
    assert substring_dedup.remove_repeats(empty_docs).count() == 0
    assert ngram_join.similar_groups(empty_docs).count() == ngram_join.one_of_each_group(empty_docs).count() == 0
