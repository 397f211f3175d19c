"""Personal data by fixed patterns and a skip-chain conditional random field (operator 6).

The patterns give the base spans. A random field over the number-like and
address-like units of a document then looks for what they miss: neighbours share
transition potentials, repeated or similar units anywhere in the document share
skip potentials, and loopy message passing makes their labels agree. Its unit weights and
transitions are trained here, from units that the patterns have labelled; the skip potential and the prior are constants.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import map_by_id

KINDS = ("email", "ip", "card", "phone")
O = len(KINDS)  # noqa: E741 - the label of a unit that is none of the kinds
Span = tuple[int, int, int]  # kind, start, end (code points, end exclusive)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Possessive runs that begin at a run's first digit: the same matches, found in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: The last choice passes over a run that holds no unit in one step, so a long one is not searched again from each of its characters.
_UNIT = re.compile(r"\+?\(?[0-9][0-9()\x20.-]*[0-9](?![A-Za-z0-9@_])|[A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]*"
                   r"|(?<![A-Za-z0-9._%+-])[A-Za-z._%+-]*+[0-9][A-Za-z0-9._%+-]*"
                   r"|(?P<none>[A-Za-z._%+-]++(?![@0-9])(?:(?<!\+)|(?!\()))")

#: No kind has more digits.
MOST_DIGITS = 19

#: The field is trained on so many units at most, those with the smallest hash of their document's id.
SAMPLE_UNITS = 20_000
#: A hash sample of about so many documents is searched for them.
SAMPLE_DOCS = 40_000
FEATURES, STEPS, RATE, DECAY = 1 << 12, 150, 1.0, 1e-3
#: Least log odds for "none" of a unit that no pattern labels; of a pattern's label; of sharing a kind over a skip edge; most of a chain edge.
PRIOR, CLAMP, SKIP, CHAIN = 3.0, 8.0, 4.5, 1.0
NEAR, BELIEF = 40, 0.6
#: Messages are passed until none moves by ``REST``; loops that never rest are left after so many rounds.
ROUNDS, REST = 500, 1e-3


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from each @ backwards: a local part ends at its @, so runs are looked at once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind, then start."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def units(text: str, base: list[Span]) -> list[tuple[int, int, int]]:
    """(start, end, label) in order: the base spans, and number-like or address-like runs that touch none (label O)."""
    taken = sorted((a, b, k) for k, a, b in base)
    merged, end = [], -1
    for a, b, k in taken:
        if a >= end:
            merged.append((a, b, k))
            end = b
    out, i = list(merged), 0
    busy = sorted((a, b) for a, b, _ in taken)
    high = np.maximum.accumulate([b for _, b in busy]) if busy else np.zeros(0, int)
    lows = np.array([a for a, _ in busy])
    for m in _UNIT.finditer(text):
        if m.lastgroup:
            continue
        i = int(np.searchsorted(lows, m.end())) if len(lows) else 0
        if i and high[i - 1] > m.start():
            continue
        if sum(c.isdigit() for c in m.group()) > MOST_DIGITS:  # numbers side by side are units of their own
            out += [(m.start() + w.start(), m.start() + w.end(), O) for w in re.finditer(r"\S+", m.group())]
        else:
            out.append((m.start(), m.end(), O))
    return sorted(out)


def _features(text: str, start: int, end: int) -> list[int]:
    """Hashed features of a unit that its pattern does not depend on alone: shape, size and neighbouring words."""
    body = text[start:min(end, start + 64)]
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", body))
    digits = sum(c.isdigit() for c in body)
    before = text[max(0, start - NEAR):start].split()
    after = text[end:end + NEAR].split()
    names = (f"s={shape}", f"d={digits}", f"n={min(end - start, 40)}", f"@={'@' in body}",
             f"b={before[-1].lower() if before else ''}", f"a={after[0].lower() if after else ''}", "1")
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _skip_keys(body: str) -> list[str]:
    """What makes two units repeated or similar: the same digits in any format, or the same name before an @."""
    digits = re.sub("[^0-9]", "", body[:256])
    keys = [f"d{digits}", f"e{digits[-9:]}"] if len(digits) >= 9 else []
    name = body[:256].partition("@")[0].strip(".-_%+ ()").lower()
    return keys + ([f"w{name}"] if len(name) >= 4 else [])


@dataclass(frozen=True)
class Field:
    """Unit weights (features x labels) and log transition potentials between near units (labels x labels)."""

    weights: np.ndarray
    transition: np.ndarray


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def train(examples: list[tuple[list[int], int, int]]) -> Field:
    """A field from (features, label, label of the near unit before or -1), by gradient ascent on the unit likelihood."""
    labels = O + 1
    weights = np.zeros((FEATURES, labels))
    pairs = np.ones((labels, labels))
    for _, label, before in examples:
        if before >= 0:
            pairs[before, label] += 1
    joint = pairs / pairs.sum()
    transition = np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)))
    if examples:
        x = np.array([f for f, _, _ in examples])
        y = np.eye(labels)[[k for _, k, _ in examples]]
        for _ in range(STEPS):
            miss = (y - np.exp(_log_softmax(weights[x].sum(axis=1)))) / len(x)
            grad = np.zeros_like(weights)
            np.add.at(grad, x.ravel(), np.repeat(miss, x.shape[1], axis=0))
            weights += RATE * (grad * 20 - DECAY * weights)
    return Field(weights, np.clip(transition, -CHAIN, CHAIN))


def skip_edges(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Pairs of units that share a key: each with the one before it, and with the first of the key that a pattern labels.

    So edges grow with the units, and a label is one hop away from every unit of its key. Units from which
    these edges reach no labelled one have nothing to agree with; their edges are left out.
    """
    keys = [_skip_keys(text[a:b]) for a, b, _ in found]
    labelled: dict[str, int] = {}
    for i, (_, _, k) in enumerate(found):
        if k != O:
            for key in keys[i]:
                labelled.setdefault(key, i)
    edges: dict[tuple[int, int], None] = {}
    parent = list(range(len(found)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    last: dict[str, int] = {}
    for i in range(len(found)):
        for key in keys[i]:
            for j in (last.get(key, i), labelled.get(key, i)):
                if j != i:
                    edges[min(i, j), max(i, j)] = None
                    parent[root(i)] = root(j)
            last[key] = i
    known = {root(i) for i, (_, _, k) in enumerate(found) if k != O}
    return [e for e in edges if root(e[0]) in known]


def potentials_of(text: str, found: list[tuple[int, int, int]],
                  field: Field) -> tuple[np.ndarray, list[tuple[int, int]], list[np.ndarray]]:
    """Log potentials of the units, the edges and the log potentials of the edges.

    Chain edges join neighbours at most ``NEAR`` characters apart; skip edges are those of :func:`skip_edges`.
    """
    unary = np.zeros((len(found), O + 1))
    for i, (a, b, k) in enumerate(found):
        unary[i] = _log_softmax(field.weights[_features(text, a, b)].sum(axis=0))
        if k != O:
            unary[i, k] += CLAMP
        else:  # shape and context alone never overrule the patterns, they only grade the kinds: links have to
            unary[i, :O] = np.minimum(unary[i, :O], unary[i, O] - PRIOR)
    agree = SKIP * np.diag([1.0] * O + [0.0])  # being none is no evidence against a similar unit
    chain = [(i - 1, i) for i in range(1, len(found)) if found[i][0] - found[i - 1][1] <= NEAR]
    skip = skip_edges(text, found)
    return unary, chain + skip, [field.transition] * len(chain) + [agree] * len(skip)


def beliefs(text: str, found: list[tuple[int, int, int]], field: Field) -> np.ndarray:
    """Marginals of the units (units x labels) by loopy sum-product message passing, until the messages rest."""
    unary, edges, potentials = potentials_of(text, found, field)
    labels = O + 1
    if not edges:
        return np.exp(_log_softmax(unary))
    e, psi = np.array(edges), np.stack(potentials)
    forth, back = np.zeros((len(e), labels)), np.zeros((len(e), labels))
    for _ in range(ROUNDS):
        total = unary.copy()
        np.add.at(total, e[:, 1], forth)
        np.add.at(total, e[:, 0], back)
        new_forth = _log_softmax(np.logaddexp.reduce((total[e[:, 0]] - back)[:, :, None] + psi, axis=1))
        new_back = _log_softmax(np.logaddexp.reduce((total[e[:, 1]] - forth)[:, None, :] + psi, axis=2))
        moved = max(np.abs(new_forth - forth).max(), np.abs(new_back - back).max())
        forth, back = 0.5 * (forth + new_forth), 0.5 * (back + new_back)
        if moved < REST:
            break
    total = unary.copy()
    np.add.at(total, e[:, 1], forth)
    np.add.at(total, e[:, 0], back)
    return np.exp(_log_softmax(total))


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Units that no pattern labels and the field believes to be of a kind.

    Without a base span no unit has a skip edge, and chain edges alone (``CHAIN`` at most) never make up for ``PRIOR``: the
    field then adds nothing, so it need not be run.
    """
    if not base:
        return []
    found = units(text, base)
    if all(k != O for _, _, k in found):
        return []
    belief = beliefs(text, found, field)
    best = belief.argmax(axis=1)
    return [(int(k), a, b) for (a, b, was), k, p in zip(found, best, belief.max(axis=1), strict=True)
            if was == O and k != O and p >= BELIEF]


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_units: int = SAMPLE_UNITS) -> Field:
    """The field of a bounded hash sample of (doc_id, text); at most ``sample_units`` feature rows reach the driver."""
    n = docs.count()
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    sample = docs.where(spread < int(1e6 * min(1.0, sample_docs / max(1, n)))).select(
        F.col("doc_id").cast("string").alias("doc_id"), "text")

    def examples(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                if not text or not (_DIGIT.search(text) or "@" in text):
                    continue
                found = units(text, base_spans(text))
                for i, (a, b, k) in enumerate(found):
                    near = i and a - found[i - 1][1] <= NEAR
                    rows.append((zlib.crc32(f"{doc}:{i}".encode()), _features(text, a, b), k, found[i - 1][2] if near else -1))
            yield pd.DataFrame(rows, columns=["h", "features", "label", "before"])

    got = sample.mapInPandas(examples, "h bigint, features array<int>, label int, before int").orderBy(
        "h", "features", "label", "before").limit(sample_units).collect()
    return train([(r["features"], r["label"], r["before"]) for r in got])


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and ``base_sha256`` are of the base spans; ``spans`` also holds what the
    field adds, never overlapping a base span. A null text counts as empty: no
    spans, the digest of the empty string. Repeated rows and ids each get their own row; an empty table gives an
    empty result; other columns are not read. Whole texts; no shuffle.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                spans = base_spans(text)
                more = added_spans(text, spans, field)
                n = [sum(k == i for k, _, _ in spans) for i in range(O)]
                rows.append((*n, hashlib.sha256(named(spans).encode()).hexdigest(), named(spans + more), len(more)))
            out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])
            out.insert(0, "doc_id", pdf["doc_id"].values)
            yield out

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_by_id(base, run, f"{counts}, base_sha256 string, spans string, n_added bigint")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``find`` with a field fitted on a bounded sample of the same documents."""
    return find(docs, fit(docs))
