"""Periodic runs of words by seeds and extension along diagonals (operator 11).

A run is a stretch of words with smallest period q that is at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` long and that neither neighbour extends.
Along the diagonal of lag q it matches itself in its length less q words, so
every k-gram with k no longer than that overlap is a seed: it occurs again q
words on. Lags up to ``SEED``, the least overlap that any period guarantees, are
found from ``SEED``-grams; each octave of longer lags from k-grams of its upper
end, which its runs' overlap (twice the lag at least) still guarantees.

Of the occurrence pairs of a k-gram only neighbours count: where a k-gram that is
no shorter than the lag occurs next after d words, d is the smallest period of
the stretch, and a run of period d shows d as the distance of neighbours. So pairs
grow with the words, not with the square of a k-gram's occurrences, and no pair is lost.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import map_by_id

MIN_LENGTH, MIN_EXPONENT = 24, 3

Run = tuple[int, int, int]  # start, length, period


def guaranteed_overlap(min_length: int, min_exponent: int) -> int:
    """The least number of words in which a run of any period matches itself one period on."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def code_words(words: list[bytes]) -> np.ndarray:
    """Equal words, and only these, get equal numbers."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


class _Grams:
    """Names of the k-grams that occur more than once, for growing k: equal names mean equal words, without hashing."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.width = 1
        often = np.bincount(codes, minlength=1)[codes] > 1
        self.at = np.flatnonzero(often)  # where a repeated k-gram starts
        self.name = np.where(often, codes, -1)

    def widen(self, width: int) -> None:
        """From k to ``width``, at most 2k: a gram is the pair of its first and its last k words."""
        shift = width - self.width
        at = self.at[self.at + width <= self.n]
        at = at[self.name[at + shift] >= 0]
        pair = self.name[at] * (self.n + 1) + self.name[at + shift]
        _, named, times = np.unique(pair, return_inverse=True, return_counts=True)
        again = times[named] > 1
        self.at = at[again]
        self.name = np.full(self.n, -1, np.int64)
        self.name[self.at] = named[again]
        self.width = width

    def neighbours(self, above: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag) of neighbouring occurrences with above < lag <= k, by lag, then place."""
        order = self.at[np.argsort(self.name[self.at], kind="stable")]
        lag = np.diff(order)
        near = (self.name[order[1:]] == self.name[order[:-1]]) & (lag > above) & (lag <= self.width)
        place, lag = order[:-1][near], lag[near]
        by = np.lexsort((place, lag))
        return place[by], lag[by]


def _matched_to(codes: np.ndarray, at: int, lag: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``lag`` further, or has none."""
    end, step = len(codes) - lag, 64
    while at < end:
        stop = min(end, at + step)
        differs = codes[at:stop] != codes[at + lag:stop + lag]
        first = int(differs.argmax())
        if differs[first]:
            return at + first
        at, step = stop, step * 2
    return end


def _matched_from(codes: np.ndarray, at: int, lag: int) -> int:
    """The first place of the matches along the diagonal that reach ``at`` without a break."""
    step = 64
    while at > 0:
        start = max(0, at - step)
        differs = (codes[start:at] != codes[start + lag:at + lag])[::-1]
        first = int(differs.argmax())
        if differs[first]:
            return at - first
        at, step = start, step * 2
    return 0


def find_runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """All runs of a sequence of non-negative numbers below its length, by start, then period."""
    if min_exponent < 3 or min_length < 2:
        raise ValueError("runs of fewer than three periods are not guaranteed a seed")
    runs: list[Run] = []
    n = len(codes)
    grams = _Grams(codes)
    width, above = guaranteed_overlap(min_length, min_exponent), 0
    while (above + 1) * min_exponent <= n:
        while grams.width < width:
            grams.widen(min(width, 2 * grams.width))
        if not len(grams.at):  # no longer gram is repeated either
            break
        place, lag = grams.neighbours(above)
        covered: dict[int, int] = {}  # per lag, how far its diagonal has been followed
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(lag) != 0) | (np.diff(place) != 1)  # seeds side by side are on one stretch
        for i, d in zip(place[new].tolist(), lag[new].tolist(), strict=True):
            if i < covered.get(d, 0):
                continue
            end = covered[d] = _matched_to(codes, i + width, d)
            start = _matched_from(codes, i, d)
            if end - start + d >= max(min_length, min_exponent * d):
                runs.append((start, end - start + d, d))
        above, width = width, width * 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length/period; ties: smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def repeated_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


def looped_index(doc_id: str, n: int) -> np.ndarray:
    """The word that stands at each of n places once the id's share of texts has been made periodic."""
    at = np.arange(n)
    h = zlib.crc32(doc_id.encode())
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", looped: bool = False) -> DataFrame:
    """One row per input row: doc_id, runs (array of start, length, period), n_words, collapsed (the words kept).

    Words are runs of other characters than ASCII white space. ``looped`` first makes the
    texts of every tenth id periodic (a repeatable fixture). Whole texts, one document in a
    task's memory at a time; no shuffle. A null text has no words; a null id is
    handed on and never looped; repeated rows each get their row; an empty table gives none; other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("decimal"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for decimal, text in zip(pdf["decimal"], pdf["text"], strict=True):
                words = text.encode().split()  # bytes split at ASCII white space alone
                codes = code_words(words)
                if looped and decimal is not None:
                    at = looped_index(decimal, len(words))
                    codes, words = codes[at], [words[i] for i in at.tolist()]
                runs = find_runs(codes)
                if runs:
                    words = [words[i] for i in np.flatnonzero(~repeated_words(len(words), runs)).tolist()]
                out.append(([{"start": s, "length": n, "period": q} for s, n, q in runs], len(codes), b" ".join(words).decode()))
            got = pd.DataFrame(out, columns=["runs", "n_words", "collapsed"])
            got.insert(0, "doc_id", pdf["doc_id"].values)
            yield got

    return map_by_id(base, run, "runs array<struct<start:bigint,length:bigint,period:bigint>>, n_words bigint, collapsed string")


def summarise(found: DataFrame) -> DataFrame:
    """Per document of ``periodic_runs``: n_runs, the strongest run, digests of all runs and of the kept words.

    Exponents are compared exactly, as the products of one's length and the other's period.
    """
    stronger = (
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (a, r) -> "
        "CASE WHEN a IS NULL OR cast(r.length as decimal(19,0)) * a.period > cast(a.length as decimal(19,0)) * r.period "
        "THEN r ELSE a END)")
    listed = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))"
    best = F.col("best")
    return found.withColumn("best", F.expr(stronger)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.expr(listed).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
