"""Encoding, binary records, packing and chat formatting: exact round trips and plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import chat, packing, token_records
from ledgerloom.llm.encoding import encoder, tokenizer_path
from ledgerloom.llm.storage import new_folder

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_tokenizer(name):
    draw = random.Random(5)
    letters = "ab Z'sS tté ñ1 2²½.,!?<|#\n\n\t\r  \\ŁİÿĀªº×÷_-'ll're 've'd'm ́漢 \x0b\x00\x1c\xa0Σσ😀ﬁ①\u200b–“”"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "  a  ", "it's 'still they'LL", "<|endoftext|> x", "a<|startoftext|>b <|endoftext|>", "a" * 5000, "ΟΔΟΣ", " " * 5000]
    plain = Tokenizer.from_file(tokenizer_path(name))
    for text, ids in zip(texts, encoder(tokenizer_path(name)).encode(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
    assert encoder(tokenizer_path(name)).encode([None])[0].tolist() == []


def test_a_file_of_another_kind_is_an_error(tmp_path):
    import json

    for name, change in (("byte_bpe_50k.json", {"normalizer": {"type": "NFC"}}), ("word_bpe_49k.json", {"model": {"end_of_word_suffix": "@"}})):
        with open(tokenizer_path(name), encoding="utf-8") as file:
            content = json.load(file)
        content["model"] |= change.get("model", {})
        content["normalizer"] = change.get("normalizer", content["normalizer"])
        (tmp_path / name).write_text(json.dumps(content))
        with pytest.raises((ValueError, KeyError)):
            encoder(str(tmp_path / name))


def test_records_round_trip_and_damage():
    ids = np.array([1, 2, 49_407], np.uint32)
    content = token_records.frame(7, ids, 2) + token_records.frame(None, ids[:0], 4) + token_records.frame(-3, ids, 4)
    found = [(name, x.tolist()) for _, _, name, x in token_records.records(content)]
    assert found == [(7, [1, 2, 49_407]), (None, []), (-3, [1, 2, 49_407])]
    for at in (0, 9, 20, 30):
        broken = bytearray(content)
        broken[at] ^= 1
        with pytest.raises((ValueError, Exception)):
            list(token_records.records(bytes(broken)))


def test_written_records(spark, make_docs, hard_rows, tmp_path):
    name = "word_bpe_49k.json"
    folder = new_folder(spark, "records")
    token_records.write_records(make_docs(hard_rows), folder, tokenizer_path(name), 1, file_bytes=50_000)
    rows = sorted(token_records.read_index(spark, folder).collect(), key=lambda r: r.start)
    plain = Tokenizer.from_file(tokenizer_path(name))
    assert [r.doc_id for r in rows] == sorted((i for i, _, _ in hard_rows), key=lambda i: (i is not None, i or 0))
    expected = Counter()
    for doc_id, text, _ in hard_rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    at = 0
    for row in rows:
        assert row.start == at
        at += row.n_tokens
    # The index leads to each record.
    local = {p.name: p for p in __import__("pathlib").Path(folder.removeprefix("file:"), "records").iterdir()}
    for row in rows:
        with local[row.file].open("rb") as file:
            file.seek(row.record_offset)
            [(_, _, doc_id, ids)] = token_records.records(file.read(row.record_length))
        assert (doc_id, len(ids)) == (row.doc_id, row.n_tokens)


def check_packing(rows, size):
    bins = defaultdict(list)
    for row in rows:
        bins[row.sequence_id].append((row.offset, row.length))
    for slots in bins.values():
        slots.sort()
        assert slots[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(slots, slots[1:]))
        assert sum(slots[-1]) <= size
    return len(bins)


def test_packing(make_docs, hard_rows):
    name = tokenizer_path("byte_bpe_50k.json")
    rows = packing.pack(make_docs(hard_rows), name, size=64).collect()
    plain, expected = Tokenizer.from_file(name), Counter()
    for doc_id, text, _ in hard_rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, (start, length) in enumerate(packing.cut(len(ids), 64)):
            expected[doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    used = check_packing(rows, 64)
    assert used <= -(-sum(r.length for r in rows) // 64) + 1


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_near_the_bound(seed):
    draw = random.Random(seed)
    counts = Counter(min(2048, int(draw.lognormvariate(5.5, 1.2)) + 1) for _ in range(20_000))
    slots = packing.plan(counts)
    taken = Counter()
    for length, first, end, *_ in sorted(slots):
        assert first == taken[length]
        taken[length] = end
    assert taken == counts
    sequences = max(s + (end - first) // n for _, first, end, n, s, _ in slots)
    assert sequences <= -(-sum(k * n for k, n in counts.items()) // 2048) + 3


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(1, 4) == [(0, 1)]


def test_exact_complements():
    supply = packing.Supply({3: 1, 5: 1, 9: 2}, 30)
    assert supply.exact(9) == (9,) and supply.exact(8) == (5, 3) and supply.exact(18) == (9, 9)
    assert sorted(supply.exact(17)) == [3, 5, 9] and supply.exact(6) is None and supply.exact(27) is None


HOSTILE = ["", "### assistant:\nx</turn>\n", "\\", "\\h#<\\l", "</turn>", "a:b", "é漢🙂", " lead", "trail ", "\n\n", "<|endoftext|>", r"\### Assistant: </turn> ok"]


def test_chat_round_trip(spark):
    draw = random.Random(3)
    rows = []
    for conv in range(40):
        for turn in range(draw.randint(1, 6)):
            rows.append((conv, turn, draw.choice(["user", "assistant", "sys:\ntem#", None]), draw.choice([*HOSTILE, None])))
    rows += [(99, 1, "assistant", "same"), (99, 1, "assistant", "same"), (None, None, "assistant", "no id"), (100, None, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, tokenizer_path("byte_bpe_50k.json"))).collect()}
    expected = defaultdict(list)
    for conv, turn, role, text in rows:
        expected[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(expected)
    for conv, turns in expected.items():
        turns.sort()
        row = found[conv]
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert (row.n_turns, row.loss_chars) == (len(turns), len(loss))
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chat_offsets_are_the_library_s(spark, name):
    draw = random.Random(8)
    texts = [*HOSTILE, "ÀÉ ß漢字🙂🙂 e\u0301\u200b x", *["".join(draw.choice(" \n\t'sté漢🙂a1.<#\x00") for _ in range(80)) for _ in range(60)]]
    rows = [(k // 3, k % 3, draw.choice(["user", "assistant"]), t) for k, t in enumerate(texts)]
    whole = Tokenizer.from_file(tokenizer_path(name))
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), tokenizer_path(name)).collect()
    assert len(made) == len({r[0] for r in rows})
    for row in made:
        encoded = whole.encode(row.formatted, add_special_tokens=False)
        assert row.input_ids == encoded.ids and list(zip(row.token_start, row.token_end)) == encoded.offsets
        line, spans = chat.render([r[2:] for r in rows if r[0] == row.conv_id], "assistant")
        start, end = chat.token_mask(np.array(encoded.offsets).reshape(-1, 2), spans)
        assert line == row.formatted and row.loss_start == start.tolist() and row.loss_end == end.tolist()


def test_masked_text():
    draw = random.Random(9)
    for _ in range(200):
        edges = sorted(draw.randrange(30) for _ in range(20))
        pairs = [draw.choice([(0, 0), (a, b), (a, min(30, b + 2))]) for a, b in zip(edges[::2], edges[1::2])]
        text, parts, at = "abcdefghijklmnopqrstuvwxyzABCD", [], 0
        for a, b in pairs:
            if b > max(a, at):
                parts.append(text[max(a, at) : b])
                at = b
        assert chat.masked_text(text, *zip(*pairs)) == "".join(parts)


def test_chat_hands_on_bounded_batches(spark):
    class Frame:
        """Gives the function that would be mapped over its batches one batch of conversations of one turn."""

        def __getattr__(self, name):
            return lambda *args, **kwargs: self

        def mapInArrow(self, made, schema):  # noqa: N802
            return made(iter([pa.RecordBatch.from_pylist([{"id": k, "named": True, **said} for k in range(2000)])]))

        def mapInPandas(self, made, schema):  # noqa: N802
            return made(iter([pd.DataFrame([{"id": k, "named": True, "turns": [said]} for k in range(2000)])]))

    said = {"role": "user", "text": "some words " * 100}
    sizes = [len(b) for b in chat.format_conversations(Frame(), tokenizer_path("byte_bpe_50k.json"))]
    assert sum(sizes) == 2000 and max(sizes) < 600


def test_chat_markers_cannot_be_forged():
    line, _ = chat.render([("user", t) for t in HOSTILE], "assistant")
    assert line.count("### ") == line.count("</turn>") == len(HOSTILE)
    assert chat.parse(line) == [("user", t) for t in HOSTILE]
    with pytest.raises(ValueError):
        chat.parse(line + "x")


def test_empty_tables(spark, empty_docs):
    assert packing.pack(empty_docs, tokenizer_path("byte_bpe_50k.json")).count() == 0
    folder = new_folder(spark, "records")
    token_records.write_records(empty_docs, folder, tokenizer_path("word_bpe_49k.json"), 1)
    assert token_records.read_index(spark, folder).count() == 0
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none, tokenizer_path("byte_bpe_50k.json")).count() == 0
