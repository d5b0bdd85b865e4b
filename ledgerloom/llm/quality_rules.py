"""Quality rules as a short-circuit cascade: the rules that reject most for their cost come first."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm.columns import quoted

SAMPLE = 2000
WINDOW = 5
WHITE = bytes([0x20, *range(0x09, 0x0E)])
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that go on with a character
LETTERLESS = re.compile(rb"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0DA-Za-z\x80-\xFF]+(?![^\x20\x09-\x0D])")


class Text:
    """A text in UTF-8 whose measures are taken when a rule first asks for them."""

    def __init__(self, data: bytes):
        self.data = data

    def _count(self, among: bytes) -> int:
        return len(self.data) - len(self.data.translate(None, among))

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # white space of bytes is exactly the six characters

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.data) - self._count(WHITE + FOLLOWING)

    @cached_property
    def n_symbols(self) -> int:
        return self._count(SYMBOLS)

    @cached_property
    def n_capitals(self) -> int:
        return self._count(CAPITALS)

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_letterless(self) -> int:
        return len(LETTERLESS.findall(self.data))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows that occur twice or more. Windows are numbered exactly: as pairs, pairs of pairs, and so on."""
        known: dict[bytes, int] = {}
        numbers = np.array([known.setdefault(w, len(known)) for w in self.words], np.int64)
        n = len(numbers)
        if n <= WINDOW or len(known) == n:
            return 0
        runs, width = numbers, 1
        while width < WINDOW:
            step = min(width, WINDOW - width)
            pairs = runs[:-step] * n + runs[step:]  # overlapping runs cover `width + step` words
            runs = np.unique(pairs, return_inverse=True)[1]
            width += step
        again = np.bincount(runs)[runs] > 1
        edges = np.zeros(n + 1, np.int64)
        starts = np.flatnonzero(again)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        return int((np.cumsum(edges[:-1]) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


RULES = (
    Rule("few words", lambda t: t.n_words < 10),
    Rule("repeated words", lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
    Rule("symbols", lambda t: 100 * t.n_symbols > 5 * t.word_chars),
    Rule("capitals", lambda t: 100 * t.n_capitals > 30 * t.word_chars),
    Rule("repeated lines", lambda t: 100 * t.n_dup_lines > 50 * t.n_lines),
    Rule("word length", lambda t: t.word_chars < 2 * t.n_words or t.word_chars > 15 * t.n_words),
    Rule("words without letters", lambda t: 100 * t.n_letterless > 40 * t.n_words),
)
BASE = ("few words", "repeated words")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def texts_of(batch: pa.RecordBatch) -> Iterator[Text]:
    for value in batch.column("text"):
        yield Text(value.as_py() or b"")


def estimate(docs: DataFrame, rules: Sequence[Rule], text: str, sample: int) -> tuple[list[int], np.ndarray]:
    """For about ``sample`` rows: which rules reject (a bit for each), and the mean nanoseconds of each rule."""
    n = docs.count()
    drawn = docs.sample(fraction=min(1.0, sample / max(n, 1)), seed=1).limit(2 * sample)
    schema = pa.schema([("rejects", pa.int64()), ("cost", pa.list_(pa.int64()))])

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, costs = [], []
            for t in texts_of(batch):
                cost, mask = [], 0
                for k, rule in enumerate(rules):
                    began = time.perf_counter_ns()
                    mask |= rule.rejects(Text(t.data)) << k
                    cost.append(time.perf_counter_ns() - began)
                masks.append(mask)
                costs.append(cost)
            yield pa.record_batch([pa.array(masks, pa.int64()), pa.array(costs, pa.list_(pa.int64()))], schema)

    rows = drawn.select(quoted(text).cast("binary").alias("text")).mapInArrow(tried, "rejects long, cost array<long>").collect()
    costs = np.array([r.cost for r in rows], float).reshape(len(rows), len(rules))
    return [r.rejects for r in rows], costs.mean(axis=0) if rows else np.ones(len(rules))


def ordered(masks: Sequence[int], costs: Sequence[float]) -> list[int]:
    """Places of the rules, the best first: most rejections per cost among what the rules before it let through."""
    left, order = list(masks), []
    while len(order) < len(costs):
        rest = [k for k in range(len(costs)) if k not in order]
        gain = {k: sum(m >> k & 1 for m in left) / max(costs[k], 1.0) for k in rest}
        best = max(rest, key=lambda k: (gain[k], -costs[k], -k))
        order.append(best)
        left = [m for m in left if not m >> best & 1]
    return order


def cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, measures: Sequence[str] = (), base: Sequence[str] = BASE, carry: Sequence[str] | None = None, text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """``row`` (the carried columns, all by default) and ``quality``: ``kept``, ``rejected_by``, ``base_failed`` and
    the asked ``measures``.

    A row is kept if no rule rejects it. The rules run in the order of their rejections per cost, both estimated on
    about ``sample`` rows (2,000), and stop at the first that rejects; the order changes the time and which rule is
    named in ``rejected_by``, never ``kept``. ``base_failed`` says whether a rule of ``base`` rejects; it is null
    unless asked for among the measures. A null text counts as empty, and is rejected for its few words. Repeated
    rows are judged one by one; an empty table gives no rows. Texts are read whole.
    """
    masks, costs = estimate(docs, rules, text, sample)
    order = ordered(masks, costs)
    places = {r.name: k for k, r in enumerate(rules)}
    wanted = [m for m in measures if m != "base_failed"]
    with_base = "base_failed" in measures
    fields = [("kept", pa.bool_()), ("rejected_by", pa.string()), ("base_failed", pa.bool_()), *[(m, pa.int64()) for m in wanted]]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in fields]
            for t in texts_of(batch):
                rejecting = next((k for k in order if rules[k].rejects(t)), None)
                failed = any(rules[places[b]].rejects(t) for b in base) if with_base else None
                name = None if rejecting is None else rules[rejecting].name
                for column, value in zip(out, (rejecting is None, name, failed, *[getattr(t, m) for m in wanted])):
                    column.append(value)
            quality = pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(out, fields)], [n for n, _ in fields])
            yield pa.RecordBatch.from_arrays([batch.column("row"), quality], ["row", "quality"])

    row = F.struct(*[quoted(c) for c in (carry if carry is not None else docs.columns)]).alias("row")
    slim = docs.select(row, quoted(text).cast("binary").alias("text"))
    result = T.StructType([T.StructField("row", slim.schema["row"].dataType)])
    kinds = {pa.bool_(): T.BooleanType(), pa.string(): T.StringType(), pa.int64(): T.LongType()}
    result.add("quality", T.StructType([T.StructField(n, kinds[kind]) for n, kind in fields]))
    return slim.mapInArrow(judged, result)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with their own columns."""
    return cascade(docs, rules, text=text).where("quality.kept").select("row.*")
