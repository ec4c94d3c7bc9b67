"""Toxicity by maximum-scoring segments of token log-odds.

1. Token units (a word and its prefixes, so that inflected forms share
   evidence) get log-odds between toxic and clean labelled documents under an
   informative Dirichlet prior; units that are not significant (``MIN_Z``), or
   whose log-odds stay below ``MIN_SCORE``, count as neutral.
2. A text becomes a sequence of scores: the log-odds of toxic words, minus a
   drift for every other word, ``DRIFT`` and twice what words of clean text gain
   by chance, so that clean text always loses. One linear scan (Ruzzo and Tompa)
   finds all maximal-scoring segments: the toxic passages.
3. Segment scores are calibrated by the extreme-value law of such maxima:
   in ``n`` words of clean text, ``E = n K exp(-lambda S)`` segments of score ``S``
   or more are expected, with ``lambda`` from the scores of all words of clean training texts. A
   document adds up ``-ln E`` over its significant segments; a one-variable
   logistic fit turns the sum into a probability.

The classifier is fitted on at most ``sample`` labelled documents (those of
smallest hashed id; a documented parameter, so the joins of training rows can
be broadcast). Scoring covers every document in whole, by one pass without a
shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.common import map_batches, released, sliced, texts_of
from notemill.session import saved

WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
SAMPLE = 20_000       # labelled documents the classifier is fitted on, at most
MIN_TOXIC_SHARE = 1 / 500  # a unit in fewer toxic documents is not looked at: bounds the vocabulary
MIN_TOXIC_DOCS = 3
MIN_Z = 3.0
MIN_SCORE = 1.0       # log-odds below which a unit counts as neutral, however significant: e to one
PRIOR_DOCS = 10.0       # weight of the prior, in documents
DRIFT = 0.1           # least cost of a neutral word inside a passage
KEPT_WORDS = 100_000  # cached word scores in a worker


def units(word: str) -> list[str]:
    """The word, and its prefixes marked as such."""
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) >= n]]


@dataclass(frozen=True)
class Segment:
    """Words ``start`` to ``end`` (excluded) of a text with the sum of their scores."""

    start: int
    end: int
    score: float


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[Segment]:
    """All maximal-scoring segments of a sequence with ``hits`` (index, score > 0) and ``-drift`` elsewhere.

    One scan over the hits. Every candidate holds the sums before and after it;
    ``link`` names the nearest earlier candidate that starts lower.
    """
    kept: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, first, last, link
    total, next_at = 0.0, 0
    for at, score in hits:
        total -= drift * (at - next_at)
        before, first, next_at = total, at, at + 1
        total += score
        look = len(kept) - 1
        while True:
            while look >= 0 and kept[look][0] >= before:
                look = kept[look][4]
            if look < 0 or kept[look][1] >= total:
                break
            before, first = kept[look][0], kept[look][2]
            del kept[look:]
            look -= 1
        kept.append((before, total, first, at, look))
    return [Segment(first, last + 1, after - before) for before, after, first, last, _ in kept]


@dataclass
class Model:
    """Unit scores, the extreme-value constants and the calibration. A few hundred KB at most (see :func:`fit`)."""

    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0       # lambda of the extreme-value law
    scale: float = 0.1      # K of the extreme-value law
    offset: float = -3.0    # logistic calibration of the evidence
    slope: float = 1.0
    drift: float = DRIFT

    def word_score(self, word: str) -> float:
        return max([self.scores.get(u, 0.0) for u in units(word)])

    def segments(self, text: str, cache: dict[str, float]) -> tuple[list[Segment], int]:
        """Maximal segments of a text and its number of words."""
        words = WORD.findall(text.lower())
        if len(cache) > KEPT_WORDS:
            cache.clear()
        for word in set(words).difference(cache):
            cache[word] = self.word_score(word)
        hits = [(i, s) for i, s in enumerate(map(cache.__getitem__, words)) if s]
        return maximal_segments(hits, self.drift), len(words)

    def significance(self, score: float, words: int) -> float:
        """``-ln E`` of a segment: over 0 if clean text of that length has less than one like it."""
        return self.rate * score - math.log(self.scale * max(words, 1))

    def evidence(self, found: list[Segment], words: int) -> float:
        """Square root of the summed significance: a bounded range for the logistic fit."""
        return math.sqrt(sum(max(0.0, self.significance(s.score, words)) for s in found))

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.offset + self.slope * evidence))))


def _unit_counts(train: DataFrame) -> DataFrame:
    """(unit, toxic, clean): documents of each class that hold a unit; summed up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}

        def flush() -> pa.RecordBatch:
            every = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_pydict({
                "unit": every, "toxic": pa.array([seen[1][u] for u in every], pa.int64()),
                "clean": pa.array([seen[0][u] for u in every], pa.int64()),
            })
            seen[0].clear()
            seen[1].clear()
            return out

        for batch in batches:
            for text, toxic in zip(texts_of(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({u for w in set(WORD.findall(text.lower())) for u in units(w)})
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield flush()
        yield flush()

    counted = train.select("text", "toxic").mapInArrow(released(run), "unit string, toxic bigint, clean bigint")
    return counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _clean_scores(train: DataFrame, model: Model) -> dict[float, int]:
    """How many words of the clean training texts have which score (to two digits); 0 stands for neutral words."""

    def run(batch: pa.RecordBatch) -> dict:
        seen, cache = Counter(), {}
        for text in texts_of(batch, "text"):
            for word, n in Counter(WORD.findall(text.lower())).items():
                if len(cache) > KEPT_WORDS:
                    cache.clear()
                if word not in cache:
                    cache[word] = round(model.word_score(word), 2)
                seen[cache[word]] += n
        return {"score": pa.array(seen.keys(), pa.float64()), "words": pa.array(seen.values(), pa.int64())}

    counted = map_batches(train.filter("toxic = 0").select("text"), run, "score double, words bigint")
    return {r[0]: r[1] for r in counted.groupBy("score").agg(F.sum("words")).collect()}


def _rate(scores: dict[float, int], drift: float) -> float:
    """The positive root of ``sum p exp(x s) = 1`` over scores of clean words and their counts, neutral ones at ``-drift``."""
    total = max(1, sum(scores.values()))
    value = lambda x: sum(n / total * math.exp(min(600.0, x * (s or -drift))) for s, n in scores.items()) - 1
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return low


def _logistic(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a weak ridge, so that separable data end too."""
    x = np.stack([np.ones_like(evidence), evidence])
    beta = np.array([-2.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        pull = x @ (toxic - p) - 0.1 * (beta - [-2.0, 1.0])
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 0.1 * np.eye(2), pull)
        beta = beta + np.clip(step, -2, 2)
    return float(beta[0]), max(float(beta[1]), 0.0)


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, sample: int) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents; ``usable`` says which ids may be learned from.

    Copies count once: a text that repeats a thousand times is one piece of evidence.
    """
    marked = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # At most ``sample`` rows of two numbers: this side may always be broadcast.
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marked), "doc_id")
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> Model:
    """Learn unit scores and calibration from labelled documents.

    The driver gets units found in at least ``MIN_TOXIC_SHARE`` of the toxic
    training documents, so at most 500 times the distinct units of a document,
    a count for each score of two digits, and the segment scores of the training
    documents (at most ``sample`` of them). With no toxic or no clean
    document the model finds nothing and scores every text alike.
    """
    train = saved(training_rows(docs, labels, usable, sample), "toxic-train")
    size = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Model(offset=math.log((n1 + 0.5) / (n0 + 0.5)) if n1 + n0 else -3.0, slope=0.0)
    least = max(MIN_TOXIC_DOCS, math.ceil(n1 * MIN_TOXIC_SHARE))
    counted = _unit_counts(train).filter(F.col("toxic") >= least).collect()
    model = Model()
    for unit, y1, y0 in counted:
        # The prior spreads PRIOR_DOCS documents as the pooled frequency of the unit does.
        prior = PRIOR_DOCS * (y1 + y0) / (n1 + n0)
        odds = [math.log((y + prior) / (max(n + PRIOR_DOCS - y - prior, 0.5))) for y, n in ((y1, n1), (y0, n0))]
        z = (odds[0] - odds[1]) / math.sqrt(1 / (y1 + prior) + 1 / (y0 + prior))
        if z >= MIN_Z and odds[0] - odds[1] >= MIN_SCORE:
            model.scores[unit] = odds[0] - odds[1]
    # Clean text must lose score on average, or its maxima have no extreme-value law: neutral words
    # cost twice what all words of clean text gain by chance, and ``DRIFT`` more.
    calm_words = _clean_scores(train, model)
    words = max(1, sum(calm_words.values()))
    gained = sum(s * n for s, n in calm_words.items())
    model.drift = DRIFT + 2 * gained / max(1, calm_words.get(0.0, 0))

    def profile(batch: pa.RecordBatch) -> dict:
        cache: dict[str, float] = {}
        found = [model.segments(t, cache) for t in texts_of(batch, "text")]
        return {
            "toxic": batch.column("toxic").cast(pa.int32()), "words": pa.array([n for _, n in found], pa.int64()),
            "top": pa.array([max([s.score for s in f], default=0.0) for f, _ in found], pa.float64()),
            "scores": pa.array([[s.score for s in f] for f, _ in found], pa.list_(pa.float64())),
        }

    rows = map_batches(train.select("text", "toxic"), profile, "toxic int, words bigint, top double, scores array<double>").collect()
    model.rate = _rate(calm_words, model.drift) if model.scores else 1.0
    # K so that over the clean training texts as many segments reach their median score as the law expects.
    calm = sorted(s for r in rows if not r["toxic"] for s in r["scores"])
    middle = calm[len(calm) // 2] if calm else 0.0
    reached = sum(s >= middle for s in calm)
    model.scale = max(1e-9, (reached + 0.5) / words * math.exp(min(500.0, model.rate * middle)))
    evidence = np.array([
        model.evidence([Segment(0, 1, s) for s in r["scores"]], r["words"]) for r in rows
    ])
    model.offset, model.slope = _logistic(evidence, np.array([r["toxic"] for r in rows], float))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted, passages) of every row of ``docs``.

    ``passages`` lists the significant segments: first word, end, score, ``-ln E``.
    NULL and empty texts have no words and get the score of no evidence; rows
    may repeat, ids may be NULL; an empty table gives an empty table.
    """
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("significance", pa.float64())])
    cache: dict[str, float] = {}

    def run(batch: pa.RecordBatch) -> dict:
        chance, spans = [], []
        for text in texts_of(batch, "text"):
            found, words = model.segments(text, cache)
            chance.append(model.probability(model.evidence(found, words)))
            spans.append([
                {"start": s.start, "stop": s.end, "score": s.score, "significance": e}
                for s in found if (e := model.significance(s.score, words)) > 0
            ])
        return {
            "doc_id": batch.column(0), "score": pa.array(chance, pa.float64()),
            "predicted": pa.array([int(c >= threshold) for c in chance], pa.int32()), "passages": pa.array(spans, pa.list_(span)),
        }

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return map_batches(
        source, run, "doc_id bigint, score double, predicted int, "
        "passages array<struct<start: int, stop: int, score: double, significance: double>>",
    )


def clean_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns, in one pass without a shuffle."""
    cache: dict[str, float] = {}
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [model.segments(t or "", cache) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([model.probability(model.evidence(*f)) < threshold for f in found], pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether ``crc32`` of the id as text leaves 2 when divided by 4; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
