"""Personal data: base patterns, and a skip-chain conditional random field that adds to them.

Base spans come from the four patterns. They and look-alikes (numbers of seven digits or more in any
grouping, addresses written with "at") are the nodes of one field for each document. Neighbours in
the text share a chain potential; nodes with the same or similar characters, however far apart,
share a skip potential (equal but for signs, or numbers with the same last seven digits). Base spans are observed. Loopy belief propagation settles the rest, and a
look-alike whose likeliest label is a kind of personal data becomes a span: a number that stands
with its country code in one place is found without it in another. Potentials are log shares counted
over the base spans of all documents.

A long document is no danger: nodes are only base spans and look-alikes, a node asks for at most
two skip edges, to the first observed node of each group of similar ones, and the number of message
rounds is fixed.

Defined cases: null is the empty text, with no spans; without documents to learn from the stated
default potentials are used; repeated rows each give a row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import Batches

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
ROUNDS = 8
SIMILAR_DIGITS = 7
PRIOR_NONE = 20.0
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
_AT, _DOT = r"(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20|\x20@\x20)", r"(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20|\.)"
_SPELT = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
Span = tuple[int, int, int]  # start, kind, end


def emails(text: str) -> list[Span]:
    """Leftmost matches of the address pattern, found from their at signs, in linear time."""
    out, taken, at = [], 0, text.find("@")
    while at >= 0:
        head = text[taken:at]
        start = at - (len(head) - len(head.rstrip(_LOCAL)))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
        taken = domain.end() if domain else at + 1
        at = text.find("@", taken)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind; matches that fail their test are dropped."""
    out = emails(text)
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and _luhn(d)]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def look_alikes(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Other stretches that may be personal data, none of which touches a base span."""
    found = [m.span() for m in _NUMBER.finditer(text) if len(_digits(m[0])) >= SIMILAR_DIGITS]
    if any(kind == 0 for _, kind, _ in base):
        found += [m.span() for m in _SPELT.finditer(text)]
    taken = sorted((start, end) for start, _, end in base)
    out: list[tuple[int, int]] = []
    i = 0
    for start, end in sorted(found):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if (i == len(taken) or taken[i][0] >= end) and (not out or out[-1][1] <= start):
            out.append((start, end))
    return out


def _signs(text: str) -> int:
    """Kind of look: an address, one that is spelt out, or a number by its digits, groups and points."""
    if re.search("[A-Za-z]", text):
        return 0 if re.fullmatch(r"[^\s()\[\]]+", text) else N_SIGNS - 1
    n = len(_digits(text))
    return 1 + (n >= 9) + (n >= 12) + (n >= 16) + 4 * (text.count(".") == 3) + 8 * ("(" in text)


N_SIGNS = 17


def _keys(text: str) -> list[str]:
    """Nodes that share a key are the same or similar: equal but for signs, or numbers with equal last digits."""
    if re.search(r"[A-Za-z]", text):
        plain = re.sub(r"[\s()\[\]]", "", re.sub(r"\bdot\b", ".", re.sub(r"\bat\b", "@", text.lower())))
        return ["a" + plain]
    digits = _digits(text)
    return ["d" + digits, "e" + digits[-SIMILAR_DIGITS:]]


@dataclass(frozen=True)
class SkipChain:
    """Log potentials: of labels by signs, of neighbouring labels, and of equal labels over a skip edge."""

    unary: tuple[tuple[float, ...], ...]
    chain: tuple[tuple[float, ...], ...]
    skip: float

    def labels(self, signs: list[int], observed: list[int | None], skips: set[tuple[int, int]]) -> list[int]:
        """The likeliest label of each node, by belief propagation over chain and skip edges."""
        n, k = len(signs), NONE + 1
        own = np.array([self.unary[s] for s in signs])
        for i, label in enumerate(observed):
            if label is not None:
                own[i] = -1e3
                own[i, label] = 0.0
        chain, skip = np.array(self.chain), np.eye(k) * self.skip
        pairs = [(i, i + 1, chain) for i in range(n - 1)] + [(i, j, skip) for i, j in sorted(skips)]
        if not pairs:
            return own.argmax(1).tolist()
        source = np.array([x for i, j, _ in pairs for x in (i, j)])
        target = np.array([x for i, j, _ in pairs for x in (j, i)])
        potential = np.stack([p for _, _, q in pairs for p in (q, q.T)])
        back = np.arange(len(source)) ^ 1
        message = np.zeros((len(source), k))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, message)
            outgoing = belief[source] - message[back]
            sent = np.logaddexp.reduce(outgoing[:, :, None] + potential, axis=1)
            message = 0.5 * message + 0.5 * (sent - sent.max(1, keepdims=True))
        belief = own.copy()
        np.add.at(belief, target, message)
        return belief.argmax(1).tolist()


def _skips(keys: list[list[str]], observed: list[int | None]) -> set[tuple[int, int]]:
    """For each node and key, an edge to the first observed node with that key, else to the last node with it."""
    hub: dict[str, int] = {}
    for i, own in enumerate(keys):
        if observed[i] is not None:
            for key in own:
                hub.setdefault(key, i)
    last: dict[str, int] = {}
    out = set()
    for i, own in enumerate(keys):
        for key in own:
            j = hub.get(key, last.get(key, i))
            if i != j:
                out.add((min(i, j), max(i, j)))
            last[key] = i
    return out


def spans(text: str, field: SkipChain, base: list[Span] | None = None) -> list[Span]:
    """The base spans and those that the field adds, by start, then kind."""
    base = base_spans(text) if base is None else base
    others = look_alikes(text, base) if base else []  # without an observed kind no label can spread
    if not others:
        return base
    nodes = sorted([(start, end, kind) for start, kind, end in base] + [(start, end, None) for start, end in others], key=lambda x: x[:2])
    parts = [text[start:end] for start, end, _ in nodes]
    observed = [kind for *_, kind in nodes]
    found = field.labels([_signs(x) for x in parts], observed, _skips([_keys(x) for x in parts], observed))
    added = [(start, label, end) for (start, end, kind), label in zip(nodes, found, strict=True) if kind is None and label != NONE]
    return sorted(base + added)


def _counted(unary: np.ndarray, chain: np.ndarray, equal: int, other: int) -> SkipChain:
    unary = unary + np.array([0.5] * NONE + [PRIOR_NONE])  # without other signs a look-alike is no personal data
    shares = np.log(unary / unary.sum(1, keepdims=True))
    pairs = np.log((chain + 1) / (chain + 1).sum(1, keepdims=True))
    # a chain of unrelated nodes says little, so neighbours count half
    return SkipChain(tuple(map(tuple, shares.tolist())), tuple(map(tuple, (pairs / 2).tolist())), float(np.log((equal + 100) / (other + 0.1))))


DEFAULT_FIELD = _counted(np.zeros((N_SIGNS, NONE + 1)), np.zeros((NONE + 1, NONE + 1)), 0, 0)


def evidence(text: str) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Counts of one text: labels by signs, neighbouring labels, similar nodes with equal and other labels.

    A look-alike similar to a base span is left out, as its label is what the field is to find."""
    unary, chain, equal, other = np.zeros((N_SIGNS, NONE + 1)), np.zeros((NONE + 1, NONE + 1)), 0, 0
    base = base_spans(text)
    nodes = sorted([(s, e, k) for s, k, e in base] + [(s, e, NONE) for s, e in look_alikes(text, base)])
    keys = [_keys(text[s:e]) for s, e, _ in nodes]
    known = {key for own, node in zip(keys, nodes, strict=True) if node[2] != NONE for key in own}
    kept = [(node, own) for node, own in zip(nodes, keys, strict=True) if node[2] != NONE or known.isdisjoint(own)]
    for (s, e, kind), _ in kept:
        unary[_signs(text[s:e]), kind] += 1
    for (a, _), (b, _) in zip(kept, kept[1:]):
        chain[a[2], b[2]] += 1
    for i, j in _skips([own for _, own in kept], [None if node[2] == NONE else node[2] for node, _ in kept]):
        same = kept[i][0][2] == kept[j][0][2]
        equal, other = equal + same, other + (not same)
    return unary, chain, equal, other


def trained(docs: DataFrame) -> SkipChain:
    """A field counted on all documents."""
    width = N_SIGNS * (NONE + 1) + (NONE + 1) ** 2 + 2

    def run(batches: Batches):
        total = np.zeros(width)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                unary, chain, equal, other = evidence(text or "")
                total += np.concatenate([unary.ravel(), chain.ravel(), [equal, other]])
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], ["at", "n"])

    sums = {r.at: r.n for r in docs.select("text").mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    total = np.array([sums.get(i, 0.0) for i in range(width)])
    if not total.any():
        return DEFAULT_FIELD
    cut = N_SIGNS * (NONE + 1)
    return _counted(total[:cut].reshape(N_SIGNS, -1), total[cut:-2].reshape(NONE + 1, -1), int(total[-2]), int(total[-1]))


def written_out(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def personal_data(docs: DataFrame, field: SkipChain = DEFAULT_FIELD) -> DataFrame:
    """Base spans by kind and their digest, and all spans, for each document."""

    def run(batches: Batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                found = spans(text or "", field, base)
                counts = [sum(kind == k for _, kind, _ in base) for k in range(NONE)]
                digest = hashlib.sha256(written_out(base).encode()).hexdigest()
                rows.append((*counts, digest, written_out(found), len(found) - len(base)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def masked_text(text: str, found: list[Span]) -> str:
    """The text with each stretch of personal data replaced by the name of its (first) kind."""
    out, at, last = [], 0, -1
    for start, kind, end in found:
        if start >= last:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = last = max(last, end)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, field: SkipChain = DEFAULT_FIELD) -> DataFrame:
    """The documents with their personal data masked, n_chars set anew where there is such a column; null texts stay."""

    def run(batches: Batches):
        for batch in batches:
            texts = [x and masked_text(x, spans(x, field)) for x in batch.column("text").to_pylist()]
            new = {"text": texts, "n_chars": [n if x is None else len(x) for x, n in zip(texts, batch.column("n_chars").to_pylist())] if "n_chars" in batch.schema.names else None}
            columns = [pa.array(new[f.name], f.type) if new.get(f.name) is not None else batch.column(f.name) for f in batch.schema]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
