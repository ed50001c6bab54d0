"""Toxicity by multiple-instance learning.

Only documents are labelled. A sentence, or a window of a long one, has a logistic score over its
different words and word beginnings; a document is toxic unless all its sentences are clean, so its score
is the noisy-or of theirs and of one chance that every document has once. What a sentence without known
features would add is taken off, and of sentences with slight evidence alone only the strongest counts, so
that length alone makes no text toxic. The weights are fitted to the documents' labels through the same
noisy-or, and the sentence scores then show where in a document the offence is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import remainder, slices, table
from tillhouse.staging import pin

#: Labelled documents to learn from at most (those whose id has the least hash), their characters, and features kept.
SAMPLE, SAMPLE_CHARS, FEATURES = 20_000, 100_000_000, 4096
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
#: Lengths of the character runs that stand for words in scripts without spaces.
GRAMS = (2, 3, 4)
#: Log-odds of a sentence without known features, and those below which sentences do not add up.
BASE, SLIGHT = -6.0, math.log(0.05 / 0.95)
#: Words of one instance at most, and those from one instance of a longer sentence to the next.
WINDOW, STEP = 60, 30
_REMEMBERED = 150_000
_SENTENCE = re.compile(r"[^.!?\n。！？．｡]+")
#: Thai, Lao, Myanmar, Khmer, kana, Chinese characters.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    if not word.isascii() and _UNSPACED.search(word):
        return [word, *(f"*{word[i : i + size]}*" for size in GRAMS for i in range(len(word) - size + 1))]
    return [word, *(f"{word[:size]}*" for size in PREFIXES if len(word) >= size)]


@dataclass(frozen=True)
class Model:
    """Log-odds of a document without known features, and what each feature's words add to a sentence that has them."""

    leak: float
    weights: dict[str, float]


def _windows(count: int) -> list[tuple[int, int]]:
    """Overlapping windows over ``count`` words; a word stands in two at most."""
    if count <= WINDOW:
        return [(0, count)]
    return [(begin, min(begin + WINDOW, count)) for begin in range(0, count - WINDOW + STEP, STEP)]


def instances(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Place and different words of every sentence with words, or of the windows of a long one."""
    for match in _SENTENCE.finditer(text):
        words = _WORD.findall(match[0].lower())
        if len(words) > WINDOW:
            places = [m.span() for m in _WORD.finditer(text, *match.span())]
            words = [text[a:b].lower() for a, b in places]
            for begin, past in _windows(len(words)):
                yield places[begin][0], places[past - 1][1], list(dict.fromkeys(words[begin:past]))
        elif words:
            yield *match.span(), list(dict.fromkeys(words))


class Scorer:
    """Scores texts; what a word adds is remembered up to a bound."""

    def __init__(self, model: Model):
        self.leak, weights = model.leak, model.weights

        class Added(dict):
            def __missing__(self, word: str) -> float:
                if len(self) >= _REMEMBERED:
                    self.clear()
                added = self[word] = sum(weights.get(feature, 0.0) for feature in features_of(word))
                return added

        self.added = Added().__getitem__

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Where the sentences are, and the log-odds of each; a text without any is one empty sentence."""
        spans, odds = [], []
        for begin, past, words in instances(text):
            spans.append((begin, past))
            odds.append(sum(map(self.added, words), BASE))
        return spans or [(0, 0)], np.array(odds or [BASE])

    def chance(self, odds: np.ndarray) -> float:
        """Noisy-or of a text's sentences and what every document has once."""
        clean, _ = log_clean(odds, np.zeros(len(odds), np.int64), 1, self.leak)
        return float(-np.expm1(clean[0]))


def log_clean(odds: np.ndarray, owner: np.ndarray, documents: int, leak: float) -> tuple[np.ndarray, np.ndarray]:
    """Log of the chance that a document is clean, from its sentences' log-odds; and which sentences count.

    Those with more than slight evidence do, and of a document without any the strongest.
    """
    most = np.full(documents, -np.inf)
    np.maximum.at(most, owner, odds)
    telling = odds >= SLIGHT
    counts = telling | (odds >= most[owner]) & (most[owner] < SLIGHT)
    none = np.logaddexp(0, BASE)
    slight = np.where(most < SLIGHT, np.maximum(np.logaddexp(0, most) - none, 0), 0)
    added = slight + np.bincount(owner[telling], np.logaddexp(0, odds[telling]) - none, documents)
    return -added - np.logaddexp(0, leak), counts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature the documents and the toxic documents that have it, summed as far as memory allows."""
    found: dict[str, list[int]] = {}

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_pydict({
            "feature": pa.array(found, pa.string()),
            "docs": pa.array([v[0] for v in found.values()], pa.int64()),
            "toxic_docs": pa.array([v[1] for v in found.values()], pa.int64()),
        })
        found.clear()
        return rows

    for batch in slices(batches):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for feature in set(chain.from_iterable(map(features_of, set(_WORD.findall(text.lower()))))):
                seen = found.setdefault(feature, [0, 0])
                seen[0] += 1
                seen[1] += toxic
            if len(found) > 150_000:
                yield flush()
    yield flush()


def _instances(index: dict[str, int]):
    """Per document the features of each sentence that holds any."""

    class Known(dict):
        def __missing__(self, word: str) -> list[int]:
            if len(self) >= _REMEMBERED:
                self.clear()
            found = self[word] = [index[f] for f in features_of(word) if f in index]
            return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in slices(batches):
            marked = []
            for text in batch.column("text").to_pylist():
                sentences = (list(chain.from_iterable(map(known.__getitem__, words))) for _, _, words in instances(text))
                marked.append([s for s in sentences if s])
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic"), "marked": pa.array(marked, pa.list_(pa.list_(pa.int32()))),
            })

    return run


def _fit(rows: list, features: list[str], steps: int = 400) -> Model:
    """Weights of least log loss of the noisy-or of ``log_clean``, by Adam with a small quadratic penalty."""
    labels = np.array([row["toxic"] for row in rows], float)
    if not features or not 0 < labels.sum() < len(labels):
        return Model(math.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)), {})
    marked = [sentence for row in rows for sentence in row["marked"]]
    owner = np.repeat(np.arange(len(rows)), [len(row["marked"]) for row in rows])
    sizes = np.array([len(sentence) for sentence in marked])
    ids = np.fromiter(chain.from_iterable(marked), np.int64, sizes.sum())
    sentence = np.repeat(np.arange(len(marked)), sizes)

    theta = np.zeros(len(features) + 1)
    theta[-1] = -6.0  # the leak
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        odds = BASE + np.bincount(sentence, theta[ids], len(marked))
        clean, counts = log_clean(odds, owner, len(rows), theta[-1])
        clean = np.minimum(clean, -1e-9)  # log of the chance that all sentences are clean
        slope = np.where(labels == 1, 1 / np.expm1(-clean), -1.0)
        by_sentence = -slope[owner] / (1 + np.exp(-odds)) * (counts & (odds >= BASE))
        gradient = np.bincount(ids, by_sentence[sentence], len(features) + 1)
        gradient[-1] = -slope.sum() / (1 + np.exp(-theta[-1]))
        gradient = gradient / len(rows) + 1e-5 * np.append(theta[:-1], 0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(float(theta[-1]), dict(zip(features, theta[:-1].tolist(), strict=True)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """Learns from at most ``sample`` labelled documents, and SAMPLE_CHARS characters, that are not held out.

    Labels are doc_id and toxic (0 or 1); rows with a null in either are ignored, a repeated id is
    toxic if any of its rows says so. Of rows of ``docs`` that share an id the one whose text has the least hash
    is read. The sample's ids are broadcast: their number is bounded. Of the words and word beginnings the ``features`` most telling of toxic documents are kept.
    """
    usable = labels.where("doc_id is not null and toxic is not null").where(remainder("doc_id", 3) != 1)
    one = usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
    in_order = Window.orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)  # over the sample
    sizes = found.select("doc_id", F.xxhash64("doc_id").alias("key"), F.length("text").alias("size"))
    fitting = sizes.withColumn("before", F.coalesce(F.sum("size").over(in_order), F.lit(0))).where(F.col("before") + F.col("size") <= SAMPLE_CHARS)
    rows = pin(found.join(F.broadcast(fitting.select("doc_id")), "doc_id", "left_semi").select("toxic", "text"))
    total, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = rows.mapInArrow(_counts, "feature string, docs long, toxic_docs long").groupBy("feature").agg(F.sum("docs").alias("d"), F.sum("toxic_docs").alias("t"))
    share = toxic / total if total else 0.0
    expected = F.col("d") * share
    gain = F.col("t") * F.log((F.col("t") + 0.1) / (expected + 0.1)) + (F.col("d") - F.col("t")) * F.log(
        (F.col("d") - F.col("t") + 0.1) / (F.col("d") - expected + 0.1)
    )
    telling = counts.where((F.col("t") >= 3) & (F.col("t") > 1.5 * expected)).orderBy(gain.desc(), "feature").limit(features)
    names = [row["feature"] for row in telling.select("feature").collect()]
    index = {name: i for i, name in enumerate(names)}
    found = rows.mapInArrow(_instances(index), "toxic long, marked array<array<int>>")
    return _fit(found.collect() if total else [], names)


def _score(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        limit = math.log(threshold / (1 - threshold))
        for batch in slices(batches):
            scores, offending = [], []
            for text in batch.column("text").to_pylist():
                spans, odds = scorer.sentences(text or "")
                scores.append(scorer.chance(odds))
                offending.append([{"first": spans[i][0], "past": spans[i][1]} for i in np.flatnonzero(odds >= limit).tolist()])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "toxicity_score": pa.array(scores, pa.float64()),
                "offending": pa.array(offending, pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
            })

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, toxicity_score and offending, the places of sentences that alone reach ``threshold``.

    A null or empty text counts as one sentence without words. Repeated rows and null ids stay, other
    columns are ignored.
    """
    added = "toxicity_score double, offending array<struct<first:int,past:int>>"
    return docs.select("doc_id", "text").mapInArrow(_score(model, threshold), f"doc_id long, {added}")


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score less than ``threshold``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([scorer.chance(scorer.sentences(text or "")[1]) < threshold for text in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


QUERIES = {"op4_toxicity": op4_toxicity}
