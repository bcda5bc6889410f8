"""Quality rules: base rules, then a linear-chain conditional random field over the lines.

Each line with a word is seen as a pattern of eight signs. The field has a weight for each sign, a
bias and a weight for each pair of neighbouring labels. It is trained piecewise on a bounded sample
of labelled documents: the sign weights by logistic regression, the pair weights from label pairs;
lines of bad documents that decode as content become content for the next round, as only the
document is labelled. Viterbi decoding then marks every line as content or boilerplate, and a
document stays if content lines hold at least half of its word characters.

Defined cases: null and empty texts have no words and fail the base rules; without labels of both
kinds the stated default weights are used; repeated rows are judged one by one; other columns pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.llm.common import Batches, one_label, text_bytes
from stratamart.llm.lines import count_symbols, repeated_words, word_ids

SIGNS = 8
CONTENT, BOILERPLATE = 0, 1
MAX_TRAINING_DOCUMENTS = 2_000
MIN_CONTENT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(x, T.LongType()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType())]
)
_PATTERNS = ((np.arange(1 << SIGNS)[:, None] >> np.arange(SIGNS)) & 1).astype(float)


@dataclass(frozen=True)
class LineField:
    """Log potentials: of boilerplate against content by pattern, and of pairs of labels."""

    emission: tuple[float, ...]
    pairs: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, patterns: bytes) -> list[int]:
        """The likeliest labels of the lines (Viterbi)."""
        if not patterns:
            return []
        emission, ((cc, cb), (bc, bb)) = self.emission, self.pairs
        content, boiler, back = 0.0, emission[patterns[0]], []
        for pattern in patterns[1:]:
            to_c, to_b = content + cc >= boiler + bc, content + cb > boiler + bb
            back.append((CONTENT if to_c else BOILERPLATE, CONTENT if to_b else BOILERPLATE))
            content, boiler = (content + cc if to_c else boiler + bc), (content + cb if to_b else boiler + bb) + emission[pattern]
        labels = [BOILERPLATE if boiler > content else CONTENT]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


def _field(weights: np.ndarray, pairs: np.ndarray) -> LineField:
    return LineField(tuple(weights[0] + _PATTERNS @ weights[1:]), tuple(map(tuple, pairs.tolist())))


#: Used where no labels of both kinds are at hand.
DEFAULT_FIELD = _field(np.array([-3.0, 2.0, 3.0, 4.0, 4.0, 2.0, 1.0, 2.0, 0.0]), np.log([[0.9, 0.1], [0.2, 0.8]]))


def line_pattern(line: bytes, n_words: int, repeated: bool, n_window_words: int) -> int:
    pipes = line.count(b"|")
    symbols = count_symbols(line) - pipes
    return (
        (10 * symbols >= n_words)
        | (2 * symbols >= n_words) << 1
        | (3 * pipes >= n_words) << 2
        | (3 * line.count(b"!") >= n_words) << 3
        | line.isupper() << 4
        | repeated << 5
        | (2 * n_window_words >= n_words) << 6
        | (n_words < 4) << 7
    )


def measure(text: bytes) -> tuple[list[int], bytes, list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; patterns and word bytes of the lines."""
    lines = [(line, words) for line in text.split(b"\n") if (words := line.split())]
    words = [w for _, own in lines for w in own]
    marks = repeated_words(word_ids(words))
    ends = np.cumsum([len(own) for _, own in lines], dtype=np.int64)
    in_windows = np.diff(np.concatenate([[0], np.cumsum(marks)])[np.concatenate([[0], ends])]) if lines else []
    seen: set[bytes] = set()
    patterns, sizes, n_dup = bytearray(), [], 0
    for (line, own), n_window in zip(lines, in_windows, strict=True):
        repeated = line in seen
        n_dup += repeated
        seen.add(line)
        patterns.append(line_pattern(line, len(own), repeated, int(n_window)))
        sizes.append(sum(map(len, own)))
    chars = len(b"".join(words).decode())
    return [len(words), chars, count_symbols(text), n_dup, int(marks.sum())], bytes(patterns), sizes


def judge(text: bytes, field: LineField) -> tuple:
    counts, patterns, sizes = measure(text)
    n_words, _, _, _, n_repeat = counts
    failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    content = sum(size for size, label in zip(sizes, field.decode(patterns), strict=True) if label == CONTENT)
    share = content / sum(sizes) if sizes else 0.0
    return (*counts, failed, share, not failed and share >= MIN_CONTENT_SHARE)


def judged(docs: DataFrame, field: LineField = DEFAULT_FIELD) -> DataFrame:
    """Counts and verdict of each document."""

    def run(batches: Batches):
        for batch in batches:
            rows = [judge(text, field) for text in text_bytes(batch)]
            columns = list(zip(*rows, strict=True)) or [()] * (len(SCHEMA) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *map(_array, columns, _TYPES)], SCHEMA.names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]


def _array(values, kind) -> pa.Array:
    return pa.array(values, kind)


def retained(docs: DataFrame, field: LineField = DEFAULT_FIELD) -> DataFrame:
    """The documents that stay, with all their columns."""

    def run(batches: Batches):
        for batch in batches:
            yield batch.filter(pa.array([judge(text, field)[-1] for text in text_bytes(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def trained(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_DOCUMENTS) -> LineField:
    """A field fitted on at most `most` labelled documents, chosen by a hash of their ids; contradictory labels are left out."""
    chosen = one_label(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches: Batches):
        for batch in batches:
            patterns = [measure(text)[1] for text in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("quality").cast(pa.int32()), pa.array(patterns, pa.binary())], ["quality", "patterns"])

    seen = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    rows = seen.mapInArrow(run, "quality int, patterns binary").collect()  # a byte for each line of the sample
    return fitted([(r.quality, bytes(r.patterns)) for r in rows if r.patterns])


def fitted(sample: list[tuple[int, bytes]], rounds: int = 3) -> LineField:
    if len({quality for quality, _ in sample}) < 2:
        return DEFAULT_FIELD
    sample = sorted(sample)
    labels = [[BOILERPLATE if quality == 0 else CONTENT] * len(patterns) for quality, patterns in sample]
    field = DEFAULT_FIELD
    for _ in range(rounds):
        field = _field(_logistic(sample, labels), _pair_weights(labels))
        labels = [field.decode(patterns) if quality == 0 else own for (quality, patterns), own in zip(sample, labels, strict=True)]
        if not any(map(any, labels)):
            break
    return field


def _logistic(sample: list[tuple[int, bytes]], labels: list[list[int]], ridge: float = 1.0) -> np.ndarray:
    """Sign weights by Newton steps over the counts of patterns and labels."""
    counts = np.zeros((1 << SIGNS, 2))
    for (_, patterns), own in zip(sample, labels, strict=True):
        np.add.at(counts, (np.frombuffer(patterns, np.uint8), own), 1)
    x, n = np.hstack([np.ones((1 << SIGNS, 1)), _PATTERNS]), counts.sum(1)
    weights, penalty = np.zeros(SIGNS + 1), ridge * np.eye(SIGNS + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + penalty, x.T @ (counts[:, 1] - n * p) - ridge * weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _pair_weights(labels: list[list[int]]) -> np.ndarray:
    """Log shares of the next label, each label's share of all lines taken off, as the signs carry it."""
    pairs, single = np.ones((2, 2)), np.ones(2)
    for own in labels:
        np.add.at(pairs, (own[:-1], own[1:]), 1)
        np.add.at(single, own, 1)
    return np.log(pairs / pairs.sum(1, keepdims=True)) - np.log(single / single.sum())
