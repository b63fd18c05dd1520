"""Toxicity by multiple-instance learning: documents are labelled, sentences are found.

A document is a bag of sentences. A sentence's score is logistic in the evidence words that
it holds; a document's score is the noisy-or of its sentences, 1 - prod(1 - p). Only the
documents' labels are learned from, yet the sentences that make a document toxic get the
high scores and are returned with their place.

Evidence is words, and stems of words, that are clearly more frequent in toxic training
documents, as counted by Spark; a sentence without any scores zero, so a document's length
alone never makes it suspect.
The fit takes at most TRAIN_DOCS labelled documents, drawn by a hash of the doc_id, and at
most VOCABULARY features, and only these features' places reach the driver. Scoring is one narrow
pass over whole texts with the words' weights, a bounded table, in each task.

Defined results: a null, empty or blank text scores 0; equal rows get equal scores; labels of
null doc_ids or without a value are not used, a doc_id with several labels counts for each;
without both labels in training every score is 0; a null doc_id isn't held out; an empty
table gives an empty result; other columns are ignored or, in ``keep_clean``, carried along.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quittance.llm.common import narrow_batches, rows, slices

#: Labelled documents and words that a fit takes at most.
TRAIN_DOCS, VOCABULARY = 20_000, 4_000
#: Evidence: documents with the word, how much more often in toxic ones, standard errors.
LEAST_DOCS, LIFT, ERRORS = 3, 3.0, 2.5
THRESHOLD = 0.7

#: Beginnings of words that count as features of their own, since words are inflected.
STEMS = (4, 5)
#: Features that the fit leaves with less weight say nothing and are dropped.
LEAST_WEIGHT = 0.3
#: Weight of the squared weights beside one document's loss.
RIDGE = 0.005
#: The log-odds that a sentence is toxic before its evidence. Not learned: where only toxic
#: documents have any evidence, a learned one would take all that the words should say.
BIAS = -4.0

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(text: str) -> set[str]:
    """The words of a lower-case text and their stems, which end in a dash."""
    words = set(_WORD.findall(text))
    return words.union(*({f"{w[:n]}-" for w in words if len(w) > n} for n in STEMS))


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float

    def sentence_score(self, words: list[str]) -> float:
        """The score of a sentence with this evidence."""
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(self.weights[w] for w in words)))))

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """Start, end and score of the sentences that hold evidence."""
        lowered = text.lower()
        if len(lowered) != len(text):  # a few letters grow; their places must not
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        found = []
        evidence = self.weights.keys() & features(lowered)
        if not evidence:
            return found
        for match in _SENTENCE.finditer(lowered):
            own = evidence & features(match.group())
            if own:
                found.append((match.start(), match.end(), self.sentence_score(sorted(own))))
        return found


def noisy_or(scores: list[float]) -> float:
    return 1 - math.prod(1 - s for s in scores)


# ---- fitting -----------------------------------------------------------------------------


def _training(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Texts and labels of at most about ``most`` labelled documents that aren't held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    share = min(1.0, most / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most TRAIN_DOCS narrow rows
    return texts.join(F.broadcast(drawn), "doc_id").select("text", "toxic")


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int32())])
    for batch in slices(batches, "text"):
        pairs = zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True)
        found = [(w, y) for text, y in pairs for w in features((text or "").lower())]
        yield rows(schema, [w for w, _ in found], [y for _, y in found])


def evidence(train: DataFrame, most: int = VOCABULARY) -> dict[str, float]:
    """Words with the logarithm of their odds ratio, the clearest ones first."""
    totals = train.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    toxic, clean = totals["t"], totals["c"]
    if not toxic or not clean:
        return {}
    counts = (
        train.mapInArrow(_word_rows, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum("toxic").alias("a"), (F.count("*") - F.sum("toxic")).alias("b"))
        .where(F.col("a") >= LEAST_DOCS)
        .where((F.col("a") + 0.5) / toxic >= LIFT * (F.col("b") + 0.5) / clean)
    )
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    not_a, not_b = toxic - F.col("a") + 0.5, clean - F.col("b") + 0.5
    ratio = F.log(a / not_a) - F.log(b / not_b)
    scored = counts.select("word", ratio.alias("ratio"), (ratio / F.sqrt(1 / a + 1 / not_a + 1 / b + 1 / not_b)).alias("z"))
    best = scored.where(F.col("z") >= ERRORS).orderBy(F.desc("z"), "word").limit(most)
    return {r["word"]: r["ratio"] for r in best.collect()}


def _bags(words: dict[str, int]):
    schema = pa.schema([("toxic", pa.int32()), ("sentences", pa.list_(pa.list_(pa.int32())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = []
            for text in batch.column("text").to_pylist():
                each = ({words[w] for w in features(s) if w in words} for s in _SENTENCE.findall((text or "").lower()))
                found.append([sorted(s) for s in each if s])
            yield rows(schema, batch.column("toxic"), found)

    return run


def descend(
    labels: np.ndarray, bags: np.ndarray, sentences: np.ndarray, words: np.ndarray, start: np.ndarray, steps: int = 600
) -> np.ndarray:
    """Weights that make the noisy-or of sentences fit the bags' labels.

    ``bags`` names each sentence's bag; ``sentences`` and ``words`` name the sentence and the
    word of each place. Plain gradient steps with Adam's scaling, from ``start``.
    """
    values = start.copy()
    first, second = np.zeros_like(values), np.zeros_like(values)
    n, n_sentences = len(labels), len(bags)
    for step in range(1, steps + 1):
        z = BIAS + np.bincount(sentences, values[words], n_sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        evidence = np.bincount(bags, np.logaddexp(0, z), n)  # minus the logarithm of no sentence being toxic
        slope = (1 - labels) - labels / np.expm1(np.clip(evidence, 1e-9, 50))
        gradient = (np.bincount(words, (slope[bags] * p)[sentences], len(start)) + RIDGE * values) / n
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        values -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return values


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, vocabulary: int = VOCABULARY) -> Model:
    """A model of ``labels`` (``doc_id``, ``toxic`` 0 or 1) on the texts of ``docs``."""
    narrow_batches(docs)
    train = _training(docs, labels, train_docs)
    ratios = evidence(train, vocabulary)
    if not ratios:
        return Model({}, BIAS)
    places = {w: i for i, w in enumerate(ratios)}
    found = train.mapInArrow(_bags(places), "toxic int, sentences array<array<int>>").toArrow().to_pydict()
    with_words = [(y, s) for y, s in zip(found["toxic"], found["sentences"], strict=True) if s]
    labels_, bags, sentences, words = [], [], [], []
    for y, own in with_words:
        for sentence in own:
            sentences += [len(bags)] * len(sentence)
            words += sentence
            bags.append(len(labels_))
        labels_.append(y)
    as_int = lambda x: np.array(x, np.int64)
    start = np.array(list(ratios.values()))
    weights = descend(np.array(labels_, float), as_int(bags), as_int(sentences), as_int(words), start)
    return Model({w: x for w, x in zip(places, weights.tolist(), strict=True) if x >= LEAST_WEIGHT}, BIAS)


# ---- scoring -----------------------------------------------------------------------------


def _scorer(model: Model):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("score", pa.float64()),
            ("sentences", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [model.sentences(t or "") for t in batch.column("text").to_pylist()]
            scores = [noisy_or([s for _, _, s in f]) for f in found]
            places = [[dict(zip(("start", "end", "score"), s, strict=True)) for s in f] for f in found]
            yield rows(schema, batch.column("doc_id"), scores, places)

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and the ``sentences`` with evidence: start, end, score."""
    narrow_batches(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = "doc_id long, score double, sentences array<struct<start:int, end:int, score:double>>"
    return docs.mapInArrow(_scorer(model), fields)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores and predictions of all documents, which of them the fit didn't see, and the sentences
    with evidence: their place in the text and their own score."""
    scored = score(docs, fit(docs, labels))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "sentences"
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with their columns."""
    narrow_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            clean = [noisy_or([s for _, _, s in model.sentences(t or "")]) < threshold for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
