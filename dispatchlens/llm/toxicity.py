"""Toxic passages and document scores from maximum-scoring segments.

Learning: log-odds of tokens between toxic and clean texts with an informative Dirichlet prior (its
mass is spread like the tokens of all sampled texts).  A token's weight is the lower bound of its
log-odds.  Words come first; then beginnings of words, which tell of forms too rare to be
learned themselves, are counted over the words that aren't known well by themselves.  A word
weighs as much as the best of its tokens, and a little less than nothing if it has none.

Scoring: a scan in linear time finds every segment of a text whose weights add up to a maximum.
By extreme-value theory clean texts of ``n`` words hold ``K n exp(-lambda S)`` segments of score ``S``
or more; the surprise of a segment is minus the logarithm of that number, the surprises of a
text's significant segments add up, and a logistic curve turns the sum into a probability.

What is learned comes from a bounded sample of labelled documents; scores look at whole texts.
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
from pyspark.sql import types as T

from dispatchlens.llm import words, worker
from dispatchlens.llm.frames import stored, tidy

MADE = ("score", "segments")
STEMS = (4, 5, 6, 8)
_WORD = re.compile(r"[^\W\d_]+")
_WEIGHT_LIMIT = 400_000


def stems_of(word: str) -> list[str]:
    """The beginnings of a lower-case word, marked as such."""
    return [word[:k] + "*" for k in STEMS if len(word) >= k]


@dataclass
class Weights:
    """Positive weights of tokens; ``drift`` is taken off for every other word."""

    tokens: dict[str, float]
    drift: float = 0.5
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def of_words(self, found: list[str]) -> np.ndarray:
        known, get = self.known, self.tokens.get
        if len(known) > _WEIGHT_LIMIT:
            known.clear()
        for new in {*found}.difference(known):
            known[new] = max(get(t, 0.0) for t in [new, *stems_of(new)]) or -self.drift
        return np.fromiter(map(known.__getitem__, found), np.float64, len(found))


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments with a positive sum: (first, end, score), in order.

    One pass over the positive weights; candidates wait on a stack, each with the sums before
    and after it, and join when a later one rises above them.
    """
    at = np.flatnonzero(weights > 0)
    if not len(at):
        return []
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    waiting: list[tuple[int, int, float, float, int]] = []  # first, end, before, after, lower one
    for i in at.tolist():
        first, end, before, after = i, i + 1, float(sums[i]), float(sums[i + 1])
        while True:
            # the nearest candidate that begins lower than this one
            j = len(waiting) - 1
            while j >= 0 and waiting[j][2] >= before:
                j = waiting[j][4]
            if j < 0 or waiting[j][3] >= after:
                waiting.append((first, end, before, after, j))
                break
            first, before = waiting[j][0], waiting[j][2]
            del waiting[j:]
    return [(a, b, after - before) for a, b, before, after, _ in waiting]


@dataclass
class Model:
    weights: Weights
    rate: float  # lambda
    share: float  # K
    base: float  # of the logistic curve
    slope: float

    def surprise(self, score: float, n: int) -> float:
        """Minus the logarithm of the number of such segments by chance, 0 if one is expected."""
        return max(0.0, self.rate * score - math.log(self.share * n))

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        return math.log1p(sum(self.surprise(s, n) for _, _, s in found))

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.base + self.slope * evidence))))


def chance(positive: Counter, n: int, drift: float, top: float) -> tuple[float, float]:
    """lambda and K of clean words: ``positive`` counts the positive weights among ``n`` words.

    One word more of the highest weight ``top`` is assumed, as none may have been seen.
    """
    shares = {s: c / (n + 1) for s, c in (positive + Counter({top: 1})).items()}
    rest = 1.0 - sum(shares.values())
    moment = lambda r: rest * math.exp(-r * drift) + sum(
        p * math.exp(min(700.0, r * s)) for s, p in shares.items()
    )
    low, high = 1e-6, 50.0
    if moment(low) >= 1.0:
        return low, 1.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if moment(middle) < 1.0 else (low, middle)
    return low, max(1e-12, 1.0 - rest * math.exp(-low * drift))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, by Newton's method; the slope is held back."""
    a, b = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([(y - p).sum(), ((y - p) * x).sum() - ridge * b])
        curve = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + ridge]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _without_near_copies(texts: DataFrame) -> DataFrame:
    """One text of those with the same label that share the lowest hash of five words, by either of
    two hashes.

    Near copies would each count as evidence for the words they share.  Texts of similarity s are
    taken as near copies with a chance of about 1 - (1 - s)**2, so texts that have only a passage in
    common may be as well; texts of different labels never are, whatever they share.
    """

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                found = words.split(piece["text"])
                marks = []
                for variant in (0, 1):
                    runs = np.minimum(5, found.room())
                    hashes = found.sequences(5, variant)
                    values = np.where(runs == 5, np.resize(hashes, len(runs)), ~np.uint64(0))
                    marks.append(
                        [
                            int(values[a:b].min().astype(np.int64)) if b > a else 0
                            for a, b in zip(found.bounds, found.bounds[1:])
                        ]
                        if len(hashes)
                        else [0] * len(piece)
                    )
                made = {f"mark{i}": pa.array(m, pa.int64()) for i, m in enumerate(marks)}
                yield pa.RecordBatch.from_pydict({c: piece[c] for c in piece.schema.names} | made)

    schema = T.StructType(
        [*texts.schema.fields, *T.StructType.fromDDL("mark0 long, mark1 long").fields]
    )
    marked, columns = texts.mapInArrow(lowest, schema), texts.columns
    # texts of under five words have no such hash and stay
    for mark in ("mark0", "mark1"):
        key = F.when(F.col(mark).isin(0, -1), F.xxhash64("text")).otherwise(F.col(mark))
        rest = [c for c in marked.columns]
        row = F.struct("text", *(c for c in rest if c != "text"))
        marked = marked.groupBy("toxic", key.alias("key")).agg(F.min(row).alias("row")).select("row.*")
    return marked.select(*columns)


def _token_counts(sample: DataFrame, explained: list[set[str]] | None = None) -> DataFrame:
    """How many toxic and clean texts of each half of the sample hold each word.

    With ``explained``, by half the words that are known well: the beginnings of all other words
    instead.
    """
    shared = sample.sparkSession.sparkContext.broadcast(explained)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.give_back()
        done = shared.value
        for batch in batches:
            counts = [Counter() for _ in range(4)]
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                held = {*_words(text)}
                if done is not None:
                    held = {t for w in held - done[half] for t in stems_of(w)}
                counts[2 * half + toxic].update(held)
            tokens = list(set().union(*counts))
            columns = [pa.array([c[t] for t in tokens], pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.string()), *columns], ["token", "c0", "t0", "c1", "t1"]
            )

    schema = "token string, c0 long, t0 long, c1 long, t1 long"
    parts = sample.select("text", "toxic", "half").mapInArrow(count, schema)
    return parts.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")))


def _best(
    counts: DataFrame, halves: tuple[int, ...], sizes: Counter, prior: float, least: float, most: int
) -> dict[str, float]:
    """The ``most`` highest weights of at least ``least``, of tokens counted in ``halves``.

    The weight is the log-odds of a token between toxic and clean texts, less 1.5 deviations.  The
    prior counts as ``prior`` times the texts there are, with every token as frequent as in all.
    """
    n_clean, n_toxic = (sum(sizes[kind, h] for h in halves) for kind in (0, 1))
    if not n_clean or not n_toxic:
        return {}
    clean, toxic = (sum(F.col(f"{kind}{h}") for h in halves) for kind in "ct")
    mass, own = prior * (n_toxic + n_clean), prior * (toxic + clean)
    a, b = toxic + own, clean + own
    odds = F.log(a / (n_toxic + mass - a)) - F.log(b / (n_clean + mass - b))
    low = odds - 1.5 * F.sqrt(1.0 / a + 1.0 / b)
    found = counts.where(toxic > 1).select("token", low.alias("w")).where(F.col("w") >= least)
    return dict(found.orderBy(F.desc("w"), "token").limit(most).collect())


def _evidence(sample: DataFrame, models: list[Weights]) -> DataFrame:
    """Positive words and segments of sampled texts, by the weights of the other half."""
    shared = sample.sparkSession.sparkContext.broadcast([(m.tokens, m.drift) for m in models])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Weights(*x) for x in shared.value]
        for batch in batches:
            rows = []
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                weights = own[1 - half].of_words(_words(text))
                positive = [] if toxic else weights[weights > 0].tolist()
                scores = [s for *_, s in segments(weights)]
                rows.append((toxic, len(weights), positive, scores))
            names = ["toxic", "n", "positive", "scores"]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names
            )

    schema = "toxic int, n long, positive array<double>, scores array<double>"
    return sample.select("text", "toxic", "half").mapInArrow(scan, schema)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    sample: int = 20_000,
    prior: float = 0.05,
    least: float = 1.0,
    certain: float = 2.5,
    most_tokens: int = 20_000,
) -> Model:
    """The model of at most ``sample`` labelled documents, chosen by a hash of the id.

    ``usable``: condition on the id of documents that may be learned from.  Of equal texts one
    counts, as toxic if any is labelled so, and of near copies with one label one.  Documents without text or label teach nothing; without a label of each kind
    every text gets the same low score.  The two halves of the sample get weights from each other
    to fit the curve, so that it is not fitted to words that the weights were learned from.

    ``prior``: weight of the prior against the texts.  ``least``: lowest weight that is kept.
    ``certain``: weight from which a word is known well.  ``most_tokens``: how many words, and how
    many beginnings of words, are kept at most.
    """
    marked = tidy(labels, [doc_id, toxic]).select(
        F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic")
    )
    marked = marked.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1))
    if usable is not None:
        marked = marked.withColumnRenamed("id", doc_id).where(usable)
        marked = marked.withColumnRenamed(doc_id, "id")
    order = F.xxhash64(F.col("id").cast("string"), F.lit("sample"))
    chosen = marked.orderBy(order, "toxic").limit(sample)
    texts = tidy(docs, [doc_id, text]).select(
        F.col(doc_id).alias("id"), F.col(text).alias("text")
    )
    half = F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int").alias("half")
    # the sample is bounded, so that its ids are
    texts = texts.where(F.col("text").isNotNull()).join(F.broadcast(chosen), "id")
    texts = _without_near_copies(texts.groupBy("text").agg(F.max("toxic").alias("toxic")))
    texts = stored(texts.select("text", "toxic", half), "toxicity-sample")
    sizes = Counter()
    for row in texts.groupBy("toxic", "half").count().collect():
        sizes[row["toxic"], row["half"]] = row["count"]

    best = lambda counts, halves: _best(
        counts, halves, sizes, prior, least, most_tokens
    )
    counts = stored(_token_counts(texts), "toxicity-words")
    found = [best(counts, halves) for halves in ((0,), (1,), (0, 1))]
    well = [{t for t, w in f.items() if w >= certain} for f in found]
    stems = stored(_token_counts(texts, well[:2]), "toxicity-stems")
    halves = [Weights(found[h] | best(stems, (h,))) for h in (0, 1)]
    weights = Weights(found[2] | best(_token_counts(texts, well[2:] * 2), (0, 1)))
    n_clean, n_toxic = (sizes[kind, 0] + sizes[kind, 1] for kind in (0, 1))

    rows = _evidence(texts, halves).collect() if n_clean and n_toxic else []
    positive, n = Counter(), 0
    for row in rows:
        if not row.toxic:
            positive.update(round(x, 1) or 0.1 for x in row.positive)
            n += row.n
    top = max([1.0, *weights.tokens.values()])
    rate, share = chance(positive, n, weights.drift, top)
    model = Model(weights, rate, share, -4.0, 0.0)
    if rows:
        x = np.array([model.evidence([(0, 0, s) for s in r.scores], max(1, r.n)) for r in rows])
        model.base, model.slope = logistic(x, np.array([float(r.toxic) for r in rows]))
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``score`` double, from 0 to 1, and ``segments``: the significant passages of the text,
    an array of (start, end, surprise) with places in words.

    Words are runs of letters, in lower case.  Null, empty and wordless texts have no segments and
    the lowest score.  Equal texts score alike.  An empty table gives an empty result.  Input
    columns named like the added ones are replaced.
    """
    docs = tidy(docs, [text], MADE)
    plain = (model.weights.tokens, model.weights.drift)
    numbers = (model.rate, model.share, model.base, model.slope)
    shared = docs.sparkSession.sparkContext.broadcast((plain, numbers))
    added = "score double, segments array<struct<start:int,end:int,surprise:double>>"
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(added).fields)
    span = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("surprise", pa.float64())])
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.give_back()
        plain, numbers = shared.value
        own = Model(Weights(*plain), *numbers)
        for batch in batches:
            for piece in words.pieces(batch, text):
                scores, spans = [], []
                for value in piece[text].to_pylist():
                    weights = own.weights.of_words(_words(value))
                    n, found = max(1, len(weights)), segments(weights)
                    scores.append(own.probability(own.evidence(found, n)))
                    told = ((a, b, own.surprise(s, n)) for a, b, s in found)
                    spans.append(
                        [{"start": a, "end": b, "surprise": s} for a, b, s in told if s > 0]
                    )
                made = {
                    "score": pa.array(scores, pa.float64()),
                    "segments": pa.array(spans, span),
                }
                yield pa.RecordBatch.from_pydict({c: piece[c] for c in piece.schema.names} | made)

    return docs.mapInArrow(scan, schema)
