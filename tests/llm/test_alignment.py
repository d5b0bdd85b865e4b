"""Token alignment against a plain version that knows nothing of windows, anchors or counts per task."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import alignment
from ledgerloom.llm.encoding import tokenizer_path
from ledgerloom.llm.queries import QUERIES

FILES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"
EMPTY = (0, 0, 0, 0, 0, 0, "")


def byte_of_letter():
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {}
    for c in map(chr, [*range(0x80), *range(0x80, 0x110000, 61)]):
        if not 0xD800 <= ord(c) < 0xE000:
            letters.update(zip(split.pre_tokenize_str(c)[0][0], c.encode()))
    assert len(letters) >= 240
    return letters


def plain(texts):
    """The figures of each text, from the bytes one by one."""
    first, second = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    first.encode_special_tokens = True
    with open(FILES[0], encoding="utf-8") as file:
        spelled = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
    letters = byte_of_letter()

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    per_text = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a, b = first.encode(" " + (text or ""), add_special_tokens=False).ids, second.encode(text or "")
        a_bytes, b_bytes = [bytes(letters[c] for c in spelled[i]) for i in a], [piece(i) for i in b]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            per_text.append(None)
            continue
        owners = [[k for k, t in enumerate(tokens) for _ in t] for tokens in (a_bytes, b_bytes)]
        links = sorted(set(zip(*owners)))
        ends = [set(np.cumsum([len(t) for t in tokens]).tolist()) for tokens in (a_bytes, b_bytes)]
        groups, seen = [], 0
        for end in sorted(ends[0] & ends[1]):
            groups.append(tuple(",".join(map(str, [ids[k] for k in sorted(set(owner[seen:end]))])) for ids, owner in zip((a, b), owners)))
            seen = end
        per_text.append((len(a), len(b), len(groups), [(a[i], b[j]) for i, j in links], ";".join("|".join(g) for g in groups)))
    counts = Counter(pair for t in per_text if t for pair in set(t[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        EMPTY if t is None else (*t[:3], len(t[3]), sum(counts[p] == best[p[0]] for p in t[3]), sum(counts[p] for p in t[3]), hashlib.sha256(t[4].encode()).hexdigest())
        for t in per_text
    ]


def found(df, key):
    return Counter((r[key], r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


HARD = ["a  b", " lead", "trail ", "x▁y", "▁", "é́ ﬁ ①", "<s> </s><unk> <0x41> <|endoftext|>", "日本語 🙂 漢字", "a\x00b\tc\n\nd", "﻿x", "​q", "\n", " ", "don't 12345 A.B.C", "a" * 300, "z" * 2 + " " * 300 + "y"]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 20, 0])
def test_alignment_equals_the_plain_version(make_docs, hard_rows, frequent):
    rows = [*hard_rows, *[(100 + k, t, "a") for k, t in enumerate(HARD)], (2**53 + 1, HARD[0], "a"), (2**53 + 3, HARD[0], "a")]
    df = alignment.align_tokens(make_docs(rows), *FILES, frequent=frequent)
    expected = Counter((r[0], *figures) for r, figures in zip(rows, plain([r[1] for r in rows])))
    assert found(df.select(F.col("row.doc_id"), *df.columns[1:]), "doc_id") == expected
    assert df.select("row.text", "row.size").count() == len(rows)


def test_query_equals_the_plain_version(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    result = QUERIES["op11_token_alignment"](spark, FOLDER)
    assert result.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert found(result, "doc_id") == Counter((r.doc_id, *figures) for r, figures in zip(rows, plain([r.text for r in rows])))


def test_pieces_equal_the_model():
    draw, tool = random.Random(2), alignment.Pieces(FILES[1])
    letters = "abcdeé \n\t  .,ñßüЖяשم0123<>_ABC\x00\x7f\x80\u07ff" + "the and ing  "
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(3000)]
    texts += [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}x" for c in range(0x800)] + ["a" * 5000, " " * 5000, "日本 é", "it’s “so”", "<0x41><s>"]
    for text in texts:
        assert tool.encode(text).tolist() == tool.model.encode(text), ascii(text)
    assert tool.encode("").tolist() == []


def test_empty_table(empty_docs):
    assert alignment.align_tokens(empty_docs, *FILES).count() == 0


def test_windows_are_forgotten_without_effect():
    tool, texts = alignment.Aligner(*FILES, remembered=3), ["one two three", "two three four", "one two three"]
    alone = [next(iter(tool.align([t]))) for t in texts]
    together = list(alignment.Aligner(*FILES).align(texts))
    assert [t[:5] for t in alone] == [t[:5] for t in together] and (together[0][5] == together[2][5]).all()
    assert len(tool.windows) == 3 and tool.windows.learn([]) is None


def test_windows_with_equal_hashes_stand_for_themselves(monkeypatch):
    texts = ["one two three two", None, "three one don't", "x▁y", "two  two"]
    want = [t[:5] for t in alignment.Aligner(*FILES).align(texts)]
    monkeypatch.setattr(alignment, "mixed", lambda x: x & np.uint64(1))
    assert [t[:5] for t in alignment.Aligner(*FILES).align(texts)] == want


def test_learnt_windows_share_bytes():
    a, b = alignment.Vocabulary([b"xx", b"x", b"xxxx", b"xxx"]), alignment.Vocabulary([b"xxx", b"xxxx", b"xx"])
    known = alignment.Windows(a, b)
    known.learn([tuple(np.array(ids, "<u4").tobytes() for ids in w) for w in (([0, 1, 2], [0, 1]), ([3, 3], [2, 2, 2]))])
    assert known.text == ["0,1|0;2|1", "3,3|2,2,2"] and known.groups.tolist() == [2, 1] and known.start.tolist() == [0, 3, 7]
    links = [(x >> 32, x & 0xFFFFFFFF) for x in known.links]
    assert links == [(0, 0), (1, 0), (2, 1), (3, 2), (3, 2), (3, 2), (3, 2)] and len(known) == 2


def test_planes_keep_numbers():
    numbers = np.array([0, 1, 255, 256, 2**40, 2**63], np.uint64)
    assert alignment.from_planes(alignment.planes(numbers)).tolist() == numbers.tolist()
    assert alignment.from_planes(alignment.planes(numbers[:0])).tolist() == []
