"""Toxic documents, and the sentences that make them so.

Labels are known for documents only.  Every sentence gets a logistic score from
its words and their beginnings; a document is toxic if any sentence is, so the
scores are combined by noisy-or, and the weights are learned through that
combination from the document labels.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import add_from_text, table
from tidemark.llm.registry import query
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage

#: Features chosen by their association with the label in all training rows.
FEATURES = 3_000
#: A feature counts only if this many training documents hold it.
MIN_DOCS = 5
#: Labelled documents that the weights are fitted on, at most (those with the smallest hashes of their ids).
SAMPLE_DOCS = 20_000
#: Lengths of word beginnings that are features besides whole words.
PREFIXES = (4, 5)

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")


@dataclass(frozen=True)
class Model:
    """``leak`` is the chance of a document without any evidence, ``bias`` that of a sentence in log odds."""

    weights: dict[str, float]
    bias: float
    leak: float


def features_of(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) >= n]]


def _document_features(text: Column) -> Column:
    """Distinct features of a text, as ``features_of`` makes them."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)")))

    def begins(n: int) -> Column:
        long = F.filter(words, lambda w: F.char_length(w) >= n)
        return F.array_distinct(F.transform(long, lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))))

    return F.concat(words, *map(begins, PREFIXES))


def select_features(train: DataFrame, size: int = FEATURES, min_docs: int = MIN_DOCS) -> list[str]:
    """The features most associated with the label (chi-square), counted over all training rows."""
    labelled = F.sum(F.lit(1)), F.sum("toxic")
    n, positive = train.agg(*labelled).first()
    if not n or not positive or positive == n:
        return []
    held = train.select("toxic", F.explode(_document_features(F.col("text"))).alias("feature"))
    counts = held.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("p")).where(F.col("n") >= min_docs)
    expected = F.col("n") * F.lit(positive / n)
    rest = F.lit(float(n)) - F.col("n")
    gain = (F.col("p") - expected) ** 2 / expected / (rest + 1)
    return [r[0] for r in counts.orderBy(F.desc(gain), "feature").limit(size).select("feature").collect()]


def _fit(bags: list, labels: list[int], features: list[str], steps: int = 300, rate: float = 0.1, l2: float = 2e-5) -> Model:
    """Weights by Adam on the log loss of the noisy-or of each document's sentences."""
    import numpy as np

    y = np.array(labels, float)
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    flat = [s for b in bags for s in b]
    sizes = np.array([len(s) for s in flat], int)
    sentence = np.repeat(np.arange(len(flat)), sizes)
    column = np.array([f for s in flat for f in s], int)
    theta = np.zeros(len(features) + 2)  # weights, bias, log odds of the leak
    theta[-2:] = -3.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-2] + np.bincount(sentence, theta[column], len(flat))
        p = 1 / (1 + np.exp(-z))
        leak = 1 / (1 + np.exp(-theta[-1]))
        clean = np.minimum(np.log1p(-leak) - np.bincount(doc, np.logaddexp(0, z), len(bags)), -1e-9)
        toxic = -np.expm1(clean)
        pull = np.where(y == 1, -np.exp(clean) / toxic, 1.0) / max(1, len(bags))  # loss by log chance of being clean, negated
        by_sentence = pull[doc] * p if len(flat) else np.zeros(0)
        grad = np.concatenate([np.bincount(column, by_sentence[sentence], len(features)),
                               [by_sentence.sum(), (pull * leak).sum()]]) + l2 * theta * np.r_[np.ones(len(features)), 0, 0]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        theta -= rate * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights = {f: float(w) for f, w in zip(features, theta) if abs(w) > 1e-4}
    return Model(weights, float(theta[-2]), float(1 / (1 + np.exp(-theta[-1]))))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, size: int = FEATURES) -> Model:
    """A model from the texts in ``docs`` and the document labels ``labels`` (doc_id, toxic).

    Features are chosen by counts over all labelled rows.  The weights are
    fitted on at most ``sample_docs`` of these documents, and what the driver
    gets of each is its distinct sets of chosen features per sentence, not its
    text.  Rows without a label count for nothing; without labels of both kinds
    every document gets the share of toxic labels (0 without labels) as score.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = stage(join_checked(docs.select("doc_id", "text"), known, ["doc_id"]), "toxicity-train")
    features = select_features(rows, size)
    if not features:
        share = rows.agg(F.avg("toxic")).first()[0] or 0.0
        return Model({}, -30.0, float(share))
    number = {f: k for k, f in enumerate(features)}

    def start():
        of_word = _Memo(lambda w: tuple(number[f] for f in features_of(w) if f in number))

        def work(texts):
            return [[[sorted(s) for s in {frozenset(f) for f in _sentences(t, of_word) if f}] for t in texts]]

        return work

    # Only hashes are sorted; the texts of the sample stay in their tasks.
    place = F.xxhash64("doc_id")
    last = rows.select(place.alias("place")).orderBy("place").limit(sample_docs).agg(F.max("place")).first()[0]
    sample = rows.where(place <= last)
    bags = add_from_text(sample, "bags array<array<int>>", start).select("toxic", "bags").toArrow()
    return _fit(bags["bags"].to_pylist(), bags["toxic"].to_pylist(), features)


class _Memo(dict):
    """Values by word, at most 100,000 at a time."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) > 100_000:
            self.clear()
        value = self[word] = self.make(word)
        return value


def _sentences(text: str | None, of_word: _Memo):
    """The set of features of each sentence."""
    for sentence in SENTENCE.split((text or "").lower()):
        yield {f for found in map(of_word.__getitem__, WORD.findall(sentence)) if found for f in found}


ADDED = "score double, n_sentences bigint, offending array<struct<sentence: bigint, score: double, text: string>>"


def score_documents(docs: DataFrame, model: Model, sentence_score: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``n_sentences`` and ``offending`` sentences.

    Sentences end at ``.``, ``!``, ``?`` or a line end and are numbered from 0;
    those scored ``sentence_score`` or more are returned with their text.  A null
    or empty text has one empty sentence and the score of no evidence.  Only the
    text is read.  Columns named as the results are replaced.
    """

    def start():
        from math import exp, log1p

        of_word = _Memo(lambda w: tuple(f for f in features_of(w) if f in model.weights))

        def one(text):
            clean, found, count = log1p(-min(model.leak, 1 - 1e-12)), [], 0
            pieces = SENTENCE.split(text or "")
            for count, (sentence, features) in enumerate(zip(pieces, _sentences(text, of_word))):
                if features:
                    z = model.bias + sum(map(model.weights.__getitem__, features))
                    p = 1 / (1 + exp(-max(-30.0, min(30.0, z))))
                    clean += log1p(-p)
                    if p >= sentence_score:
                        found.append({"sentence": count, "score": p, "text": sentence.strip()})
            return 1 - exp(clean), count + 1, found

        return lambda texts: list(zip(*map(one, texts)))

    return add_from_text(docs, ADDED, start)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trained_on(spark: SparkSession, sf_dir: str) -> Model:
    """The model from the labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    return train(table(spark, sf_dir, "documents"), labels)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their toxicity and where it is."""
    scored = score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), trained_on(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences",
                         F.size("offending").cast("bigint").alias("n_offending"),
                         F.get("offending.sentence", F.lit(0)).alias("first_offending"))
