"""Quality scores from Bradley-Terry pairwise ranking.

A preference pair is a document labelled good against one labelled bad. The score is linear in
features of the text, fitted by logistic loss on feature differences (Newton steps, ridge). The cut
is the quantile of the training scores at which the share of bad labels lies, and the score given out is
the logistic function of the distance to it.

Only rows whose crc32(doc_id as text) mod 3 is not 1 are ever learnt from, and all of them are. They meet in
tournaments: the label with more rows is dealt by a hash into parts of some PART rows, the other one likewise, and each
part of the former meets a part of the latter, all pairs of the two. With fewer than 2 * PART rows of either
label these are all pairs there are. A Newton step sums over all tournaments, and the cut is an exact
order statistic of all training scores; only sums of the size of the features come to the driver.

Defined cases: null and empty texts have the features of an empty text and a score like others;
without training labels of both kinds every score is 0.5; labels that are null or neither 0 nor 1
are not learnt from; rows without a doc_id are scored, not learnt from, and not held out; repeated
rows each give a row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import Batches, one_label, text_bytes, written
from stratamart.llm.lines import repeated_words, word_ids

PART = 512
_BINS, _FEW = 1_000, 10_000
_UPPER, _DIGITS, _ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?"
_CLASSES = (b"#*$%&<>", b"|", b"!", _UPPER, _DIGITS, _ENDS, b"\"'()[]{}/\\=_~^@+-")


def features(text: bytes) -> list[float]:
    """Shares and logarithms that describe a text; all are finite for any text."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    ids = word_ids(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    per_word = [(len(text) - len(text.translate(None, x))) / max(1, n) for x in _CLASSES]
    return [
        *np.tanh(per_word).tolist(),
        sum(x > 0.2 for x in per_word[:3]) > 0,
        float(repeated_words(ids).mean()) if n else 0.0,
        len(np.unique(ids)) / max(1, n) ** 0.8 / 3,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n)),
        n < 10,
        size / max(1, n) / 10 if n else 0.0,
        float(np.log1p(n / max(1, len(lines)))),
        text.isupper(),
    ]


N_FEATURES = len(features(b""))


@dataclass(frozen=True)
class Ranking:
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - np.array(self.mean)) / np.array(self.scale) * np.array(self.weights)).sum(1)  # alike in any batch

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut, -30, 30)))


UNTRAINED = Ranking((0.0,) * N_FEATURES, (1.0,) * N_FEATURES, (0.0,) * N_FEATURES, 0.0)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([features(x) for x in texts], float).reshape(len(texts), N_FEATURES)


def trained(docs: DataFrame, labels: DataFrame) -> Ranking:
    """The ranking learnt from the rows that are not held out; contradictory labels are left out."""

    def run(batches: Batches):
        for batch in batches:
            rows = pa.array(_matrix(text_bytes(batch)).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), rows], ["doc_id", "x"])

    seen = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out()).mapInArrow(run, "doc_id long, x array<double>")
    rows = seen.join(one_label(labels), "doc_id").groupBy("doc_id", "quality", "x").agg(F.count("*").alias("times"))
    return fitted(written(rows, "quality-rows"))


def _tournaments(rows: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """One row for each tournament: features and number of times of its good and of its bad rows."""
    few, many = sorted((n_good, n_bad))
    parts = max(1, few // PART)
    copies = max(1, many // (PART * parts))
    dealt = F.xxhash64("doc_id", "x")
    copied = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    rare = F.col("quality") == int(n_good <= n_bad)
    twice = rows.where(rare).withColumn("turn", copied).withColumn("tournament", F.pmod(dealt, F.lit(parts)) + F.col("turn") * parts)
    once = rows.where(~rare).withColumn("turn", F.lit(0)).withColumn("tournament", F.pmod(dealt, F.lit(parts * copies)))

    def gather(found: pa.Table) -> pa.Table:
        x = np.array(found.column("x").to_pylist()).reshape(-1, N_FEATURES)
        good, times, ids = (found.column(c).to_numpy() for c in ("quality", "times", "doc_id"))
        order = np.lexsort([*x.T, ids])
        sides = [order[good[order] == side] for side in (1, 0)]
        values = [y for side in sides for y in (x[side].tobytes(), times[side].astype(float).tobytes())]
        return pa.table([pa.array([y], pa.binary()) for y in values], _SIDES)

    both = once.unionByName(twice).select("tournament", "quality", "doc_id", "x", "times")
    return written(both.groupBy("tournament").applyInArrow(gather, ", ".join(f"{c} binary" for c in _SIDES)), "quality-tournaments")


_SIDES = ["good", "good_times", "bad", "bad_times"]


def _sums(tournaments: DataFrame, measure: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum of what `measure` makes of each tournament, in decimal digits: the order of rows says nothing."""

    def run(batches: Batches):
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _SIDES), strict=True):
                good, good_times, bad, bad_times = (np.frombuffer(y) for y in row)
                found = measure(good.reshape(-1, N_FEATURES), good_times, bad.reshape(-1, N_FEATURES), bad_times)
                yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(found)], ["at", "value"])

    summed = tournaments.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,10)")).alias("value"))
    return np.array([float(r["value"]) for r in sorted(summed.collect())])


def _step(weights: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Callable[..., np.ndarray]:
    """Gradient and curvature of the pairs of one tournament, whose differences are never spelt out."""

    def measure(good, good_times, bad, bad_times):
        good, bad = (good - mean) / scale, (bad - mean) / scale
        times = good_times[:, None] * bad_times
        p = 1 / (1 + np.exp(-np.clip((good * weights).sum(1)[:, None] - (bad * weights).sum(1), -30, 30)))
        short, bent = times * (1 - p), times * p * (1 - p)  # every pair says that its difference is preferred to none
        gradient = short.sum(1) @ good - short.sum(0) @ bad
        across = good.T @ bent @ bad
        curvature = (good.T * bent.sum(1)) @ good + (bad.T * bent.sum(0)) @ bad - across - across.T
        return np.concatenate([gradient, curvature.ravel()])

    return measure


def _spread(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature."""
    values = rows.select("times", F.posexplode("x").alias("at", "value"))

    def mean_of(value: Column) -> np.ndarray:
        summed = values.groupBy("at").agg(F.sum((value * F.col("times")).cast("decimal(38,18)")).alias("value"))
        return np.array([float(r["value"]) / n for r in sorted(summed.collect())])

    mean = mean_of(F.col("value"))
    away = F.col("value") - F.element_at(F.array(*map(F.lit, mean.tolist())), F.col("at") + 1)
    return mean, np.sqrt(mean_of(away * away))


def _ranked(scores: DataFrame, rank: int) -> float:
    """The score of this rank, from 0, by ever narrower bins; scores are distinct and stand with the number of times they occur."""
    here = scores
    while True:
        low, high, n = here.agg(F.min("score"), F.max("score"), F.count("*")).first()
        if n <= _FEW:
            for score, times in sorted(map(tuple, here.collect())):
                rank -= times
                if rank < 0:
                    break
            return score
        width = (high - low) / _BINS
        place = F.least(F.floor((F.col("score") - low) / width), F.lit(_BINS - 1))
        for _, times, low, high in here.groupBy(place.alias("bin")).agg(F.sum("times"), F.min("score"), F.max("score")).orderBy("bin").collect():
            if rank < times:
                break
            rank -= times
        here = scores.where(F.col("score").between(low, high))


def _quantile(rows: DataFrame, ranking: Ranking, share: float, n: int) -> float:
    """The quantile of the raw scores of all rows, between the two next to it in proportion."""

    def run(batches: Batches):
        for batch in batches:
            raw = ranking.raw(np.array(batch.column("x").to_pylist(), float).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("times")], ["score", "times"])

    found = rows.select("x", "times").mapInArrow(run, "score double, times long")
    scores = written(found.groupBy("score").agg(F.sum("times").alias("times")), "quality-scores")
    place = share * (n - 1)
    low = _ranked(scores, int(place))
    high = _ranked(scores, min(int(place) + 1, n - 1))
    return low + (high - low) * (place - int(place))


def fitted(rows: DataFrame, ridge: float = 1.0) -> Ranking:
    """The ranking of training rows (doc_id, quality, x, times); all of them count."""
    found = {r["quality"]: r for r in rows.groupBy("quality").agg(F.count("*").alias("rows"), F.sum("times").alias("times")).collect()}
    if len(found) < 2:
        return UNTRAINED
    n = sum(r["times"] for r in found.values())
    mean, scale = _spread(rows, n)
    scale[scale < 1e-9] = 1.0
    tournaments = _tournaments(rows, found[1]["rows"], found[0]["rows"])
    weights, eye = np.zeros(N_FEATURES), np.eye(N_FEATURES)
    for _ in range(30):
        sums = _sums(tournaments, _step(weights, mean, scale))
        gradient, curvature = sums[:N_FEATURES], sums[N_FEATURES:].reshape(N_FEATURES, N_FEATURES)
        step = np.linalg.solve(curvature + ridge * eye, gradient - ridge * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    ranking = Ranking(tuple(mean.tolist()), tuple(scale.tolist()), tuple(weights.tolist()), 0.0)
    return replace(ranking, cut=_quantile(rows, ranking, found[0]["times"] / n, n))


def scored(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The score of each document, and whether it is at least 0.5."""

    def run(batches: Batches):
        for batch in batches:
            scores = ranking.scores(_matrix(text_bytes(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
