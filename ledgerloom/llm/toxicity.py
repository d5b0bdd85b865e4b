"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.columns import quoted, whole_row
from ledgerloom.llm.storage import checkpointed

SAMPLE = 20_000  # labelled rows that the model is fitted on, at most
LEXICON = 20_000  # entries of the lexicon, at most
LEAST_ODDS = 2.0  # an entry is so much likelier in toxic documents: log odds, shrunk by support
STEM = 5
NEAR = 4
FOLDS = 5
FIT_PARTS = 8

# Second person pronouns, and characters that stand for letters.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes".split())
STANDS_FOR = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "*": "", "-": "", "_": ""})

TOKEN = re.compile(r"\S+")
EDGES = ".,;:!?\"'()[]{}«»…"
CAPITAL, LETTER = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[^\W\d_]")
PUNCTUATION = re.compile(r"[!?]|\.\.+")
HIDDEN = re.compile(r"[^\W\d_][0-9@$*_\-]+[^\W\d_]")

FEATURES = (
    "word_density", "word_hits", "strongest", "stem_density", "stem_hits", "hidden_hits",
    "near_second_person", "capitals", "punctuation", "obfuscation", "length",
)


Lexicon = tuple[dict[str, float], dict[str, float]]  # words, and beginnings of words, with their odds


@dataclass(frozen=True)
class Model:
    """``constant`` is the score of every text where nothing could be learnt."""

    lexicon: Lexicon = ({}, {})
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    constant: float = 0.0


def fold(doc_id: Column) -> Column:
    """Remainder of the checksum of the id as text; 0 is held out. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)).cast("int")


def tokens(text: str) -> list[str]:
    stripped = (t.strip(EDGES) for t in text.lower().split())
    return [t for t in stripped if t]


def features(text: str | None, words: dict[str, float], stems: dict[str, float]) -> tuple[float, ...]:
    """The features of one whole text, in the order of ``FEATURES``. Null and empty texts give zeros."""
    text = text or ""
    found = tokens(text)
    n = max(1, len(found))
    hits = [(k, words[t]) for k, t in enumerate(found) if t in words]
    stem_hits = [k for k, t in enumerate(found) if t[:STEM] in stems]
    hidden = HIDDEN.findall(text)
    hidden_hits = 0
    if hidden:
        plain = (t.translate(STANDS_FOR) for t in found if HIDDEN.search(t))
        hidden_hits = sum(t in words or t[:STEM] in stems for t in plain)
    near = 0
    places = {k for k, _ in hits} | set(stem_hits)
    for k in places:
        near += any(t in SECOND_PERSON for t in found[max(0, k - NEAR) : k + NEAR + 1])
    letters = max(1, len(text))
    return (
        len(hits) / n,
        math.log1p(len(hits)),
        max((w for _, w in hits), default=0.0),
        len(stem_hits) / n,
        math.log1p(len(stem_hits)),
        math.log1p(hidden_hits),
        near / max(1, len(places)),
        len(CAPITAL.findall(text)) / letters,
        len(PUNCTUATION.findall(text)) / letters,
        len(hidden) / n,
        math.log1p(len(found)),
    )


def with_features(rows: DataFrame, lexicons: dict[int, Lexicon], which: Column) -> DataFrame:
    """Add ``features`` to ``rows``, which has a column ``text``; the text itself goes no further.

    ``which`` says whose lexicon is used. Only the text is sent to Python, the other columns stay where they are. The
    function is called non-deterministic, so that no filter on a score takes it into a second evaluation.
    """
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)

    @F.pandas_udf("array<double>")
    def computed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = shared.value
        for texts, numbers in batches:
            yield pd.Series([features(t, *known[n]) for t, n in zip(texts, numbers.tolist())], dtype=object)

    measured = array_to_vector(computed.asNondeterministic()(F.col("text"), which))
    return rows.withColumn("features", measured).drop("text")


def training_rows(docs: DataFrame, labels: DataFrame, sample: int, doc_id: str, text: str, label: str) -> DataFrame:
    """``text``, ``label`` and ``fold`` of at most ``sample`` labelled documents, none of them held out.

    The sample is the start of a scattered order of the ids. It has a fixed size, so its ids may go to all tasks and
    the texts need no shuffle.
    """
    usable = labels.where(quoted(doc_id).isNotNull() & quoted(label).isNotNull() & (fold(quoted(doc_id)) != 0))
    chosen = (
        usable.groupBy(quoted(doc_id).alias("labelled_id"))
        .agg(F.max(quoted(label).cast("double")).alias("label"))
        .orderBy(F.md5(F.col("labelled_id").cast("string")), "labelled_id")
        .limit(sample)
    )
    texts = docs.select(quoted(doc_id).alias("own_id"), quoted(text).alias("text"))
    joined = texts.join(F.broadcast(chosen), F.col("own_id") == F.col("labelled_id"))
    return joined.select("text", "label", fold(F.col("own_id")).alias("fold"))


def learn_lexicons(rows: DataFrame, entries: int = LEXICON) -> dict[int, Lexicon]:
    """Words and word beginnings that mark toxic documents: by fold, learnt without that fold; at 0, from all rows.

    Terms are counted once per fold. An entry's value is its log odds times t / (t + 1), t being the toxic documents
    that hold it: rare terms count for less, and none is left out for being rare alone. ``entries`` of each kind at
    most.
    """

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, label, fold in zip(batch["text"], batch["label"], batch["fold"]):
                found = set(tokens(text or ""))
                kinds = [("word", t) for t in found] + [("stem", t) for t in {t[:STEM] for t in found if len(t) >= STEM}]
                yield pd.DataFrame({"kind": [k for k, _ in kinds], "term": [t for _, t in kinds], "label": label, "fold": fold})

    def elsewhere(k: int, value: Column) -> Column:
        return F.sum(F.when(F.col("fold") != k, value).otherwise(0.0))

    folds, label = range(FOLDS), F.col("label")
    by_label = [(name, value) for name, value in (("toxic", label), ("clean", 1 - label))]
    sums = [elsewhere(k, value).alias(f"{name}_{k}") for k in folds for name, value in by_label]
    totals = rows.agg(*sums).first()
    counted = rows.select("text", "label", "fold").mapInPandas(terms, "kind string, term string, label double, fold int")
    counted = counted.groupBy("kind", "term").agg(*sums)
    found: dict[int, Lexicon] = {}
    for k in folds:
        toxic, clean = F.col(f"toxic_{k}"), F.col(f"clean_{k}")
        odds = F.log((toxic + 0.5) / F.lit(totals[f"toxic_{k}"] + 1.0)) - F.log((clean + 0.5) / F.lit(totals[f"clean_{k}"] + 1.0))
        counted = counted.withColumn(f"odds_{k}", odds * toxic / (toxic + 1))
    marking = checkpointed(counted.where(F.greatest(*[f"odds_{k}" for k in folds]) >= LEAST_ODDS))
    for k in folds:
        kinds = {}
        for kind in ("word", "stem"):
            best = marking.where((F.col("kind") == kind) & (F.col(f"odds_{k}") >= LEAST_ODDS)).orderBy(F.desc(f"odds_{k}"), "term").limit(entries)
            kinds[kind] = {r["term"]: r["odds"] for r in best.select("term", F.col(f"odds_{k}").alias("odds")).collect()}
        found[k] = kinds["word"], kinds["stem"]
    return found


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Lexicon, trees and calibration from the folds that are not held out.

    No row is measured by a lexicon that knows its label, and no value that the calibration sees comes from trees
    that do: each half of the folds is scored by trees of the other half. The trees that score documents are then
    fitted on all rows. Without labelled documents in both halves nothing is learnt; the score is the share of toxic
    ones, 0 without any.
    """
    rows = checkpointed(training_rows(docs, labels, sample, doc_id, text, label).repartition(FIT_PARTS, "fold", F.xxhash64("text")))
    half = F.col("fold") <= FOLDS // 2
    seen = rows.agg(F.avg("label").alias("share"), F.countDistinct("label").alias("classes"), F.countDistinct(half).alias("halves")).first()
    if seen["classes"] < 2 or seen["halves"] < 2:
        return Model(constant=seen["share"] or 0.0)
    lexicons = learn_lexicons(rows)
    # A bounded sample: few partitions, as every step of every tree shuffles once per partition.
    measured = checkpointed(with_features(rows.select("text", "label", "fold"), lexicons, F.col("fold"))).coalesce(FIT_PARTS)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.2, minInstancesPerNode=2, seed=7)
    apart = [_raw_score(trees.fit(measured.where(~side)), measured.where(side)) for side in (half, ~half)]
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(apart[0].unionByName(apart[1]))
    return Model(lexicons[0], trees.fit(measured), calibration)


def _raw_score(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
    return scored.drop("rawPrediction", "probability", "prediction")


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with a column ``text``) with a ``score`` from 0 to 1 instead of the text: the calibrated value."""
    if model.trees is None:
        return rows.withColumn("score", F.lit(float(model.constant))).drop("text")
    raw = _raw_score(model.trees, with_features(rows, {0: model.lexicon}, F.lit(0)))
    calibrated = model.calibration.transform(raw)
    return calibrated.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "prediction"))).drop("raw", "prediction", "features")


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` and ``predicted``.

    The model is fitted on at most ``sample`` labelled documents that are not held out. Only the text is an input.
    Null and empty texts get the score of a text without any sign, repeated rows the same score each. A null id is
    held out if the checksum of the empty text says so. Labels that are null or belong to no document are not
    used. With labels of one class only, or none, every score is the share of toxic labels (0 without any). An empty
    table of documents gives no rows.
    """
    model = fit(docs, labels, sample, doc_id, text, label)
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored(rows, model).select("doc_id", held_out, "score", predicted)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``."""
    model = fit(docs, labels, sample, doc_id, text, label)
    rows = docs.select(whole_row(docs), quoted(text).alias("text"))
    return scored(rows, model).where(F.col("score") < threshold).select("row.*")
