"""Chat formatting with a loss mask aligned to token offsets."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.columns import exact_id, quoted
from ledgerloom.llm.encoding import encoder_with_offsets

# The template. Escaped text holds neither "#" nor "<", so no text can look like a marker.
HEAD, REST = "### {role}:\n", "</turn>\n"
PARSED = re.compile(r"### ([^:]*):\n([^<]*)</turn>\n")
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l"}
ROLE_ESCAPES = ESCAPES | {":": "\\c", "\n": "\\n"}
UNESCAPED = {v: k for k, v in ROLE_ESCAPES.items()}
TO_ESCAPED, ROLE_TO_ESCAPED = str.maketrans(ESCAPES), str.maketrans(ROLE_ESCAPES)
SCHEMA = "conv_id long, formatted string, input_ids array<int>, token_start array<int>, token_end array<int>, loss_start array<int>, loss_end array<int>"
CHARS = 500_000  # characters of conversations, about, that leave a task as one batch
ROWS = 500  # turns that are taken out of a batch at once


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: UNESCAPED[m[0]], text)


def render(turns: Sequence[tuple[str, str]], trained: str) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans, in it, of the texts of the role that is trained."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, rest = HEAD.format(role=role.translate(ROLE_TO_ESCAPED)), REST
        body = text.translate(TO_ESCAPED)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, rest]
        at += len(head) + len(body) + len(rest)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = PARSED.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def token_mask(offsets: np.ndarray, spans: Sequence[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Per token the part inside a span, as start and end; (0, 0) outside. ``offsets`` and ``spans`` are in order.

    A token that reaches over the edge of a span counts with the part inside, a character that is cut into several
    tokens with each of them.
    """
    start, end = np.zeros(len(offsets), np.int32), np.zeros(len(offsets), np.int32)
    for a, b in spans:
        low = np.searchsorted(offsets[:, 1], a, "right")
        high = np.searchsorted(offsets[:, 0], b, "left")
        if low < high:
            start[low:high] = np.maximum(offsets[low:high, 0], a)
            end[low:high] = np.minimum(offsets[low:high, 1], b)
    return start, end


def masked_text(formatted: str, start: Sequence[int], end: Sequence[int]) -> str:
    """All text under the mask, each character once, unescaped."""
    start, end = np.asarray(start, np.int64), np.asarray(end, np.int64)
    held = end > start
    start, end = start[held], end[held]
    if not len(start):
        return ""
    until = np.maximum.accumulate(end)
    seen = np.concatenate([[0], until[:-1]])
    start, fresh = np.maximum(start, seen), end > seen
    start, end = start[fresh], end[fresh]
    apart = np.flatnonzero(start[1:] != end[:-1])
    spans = zip(start[[0, *(apart + 1)]].tolist(), end[[*apart, -1]].tolist())
    return unescape("".join(formatted[a:b] for a, b in spans))


def names_and_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Each conversation's id and turns, from turns that are sorted by conversation."""
    key, turns = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS).to_pydict()
            for own, role, text in zip(zip(some["named"], some["id"]), some["role"], some["text"]):
                if own != key and turns:
                    yield key[1] if key[0] else None, turns
                    turns = []
                key = own
                turns.append((role, text))
    if turns:
        yield key[1] if key[0] else None, turns


def format_conversations(rows: DataFrame, tokenizer: str, trained: str = "assistant", conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: formatted text, token ids and offsets, and the loss mask as character spans.

    Turns are in the order of ``turn``, null first; ties are ordered by role and text, repeated rows are repeated
    turns. A null role or text is empty. Rows without a conversation id form one conversation with a null id. An
    empty table gives no rows. A conversation is tokenized as a whole, so it is the unit of work of a task; long
    texts within it need no special case. A task holds one conversation and about ``CHARS`` characters of finished
    ones, however many it has.
    """
    turns = rows.select(
        *exact_id(conv_id),
        quoted(turn).alias("turn"),
        F.coalesce(quoted(role), F.lit("")).alias("role"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    kinds = (pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 5)
    names = ("conv_id", "formatted", "input_ids", "token_start", "token_end", "loss_start", "loss_end")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_with_offsets(tokenizer)
        out, held = [], 0

        def done() -> pa.RecordBatch:
            ids, lines, *arrays = zip(*out)
            ends = np.cumsum([0, *map(len, arrays[0])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, np.concatenate(a).astype(np.int32)) for a in arrays]
            columns = [pa.array(ids, kinds[0]), pa.array(lines, kinds[1]), *lists]
            return pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(zip(names, (c.type for c in columns)))))

        for name, turns in names_and_turns(batches):
            line, spans = render(turns, trained)
            ids, offsets = encode(line)
            out.append((name, line, ids, offsets[:, 0], offsets[:, 1], *token_mask(offsets, spans)))
            held += len(line)
            if held >= CHARS:
                yield done()
                out, held = [], 0
        if out:
            yield done()

    # Sorted rows are read one after the other, and Spark sorts on disk what does not fit.
    together = turns.repartition("named", "id").sortWithinPartitions("named", "id", "turn", "role", "text")
    return together.select("id", "named", "role", "text").mapInArrow(formatted, SCHEMA)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted output says: turns, loss text, and digests of both."""
    kinds = (("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            out = []
            lists = [batch.column(c) for c in ("loss_start", "loss_end")]
            (start, first), (end, _) = ((a.values.to_numpy(zero_copy_only=False), a.offsets.to_numpy()) for a in lists)
            for k, line in enumerate(batch.column("formatted")):
                line, own = line.as_py(), slice(first[k], first[k + 1])
                turns, loss = parse(line), masked_text(line, start[own], end[own])
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                name = batch.column("id")[k].as_py() if batch.column("named")[k].as_py() else None
                out.append(
                    (
                        name, len(turns), hashlib.sha256(said.encode()).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(line),
                    )
                )
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(zip(*out), kinds)], schema=pa.schema(kinds))

    columns = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select(*exact_id("conv_id"), "formatted", "loss_start", "loss_end").mapInArrow(digests, columns)
