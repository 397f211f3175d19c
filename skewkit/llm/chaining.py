"""Fuzzy passages that repeat across documents, by collinear chaining of shared seeds (operator 2).

Seeds are word k-mers picked by their hash in every window. A document is compared
with two fixed documents of each seed it shares, the ones with the smallest and the largest
id, so the work grows with the seeds and never with their pairs. Seeds that stand in more
places get longer keys, each again with its two documents: first the seed with the
next one, then, where that is not enough, every whole window of the least
passage's words. The shared
seeds of two documents are chained in order by a Fenwick tree that charges for
gaps; chains are aligned word by word and extended past their ends. A part
of a chain that is not alike enough as a whole is cut to the pieces that are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import U64, RollingHash, mix64, sliding_min, step, text_batches, word_hashes
from skewkit.session import discard, materialize

#: Words of a seed, and neighbouring seeds of which the least is picked: equal runs of 27 words share a seed.
SEED, WINDOW = 8, 20
#: A passage has so many words at least on both sides, of which this share is equal in the alignment.
MIN_WORDS, IDENTITY = 50, 0.8
#: What a seed is worth in a chain, and the charge for every word skipped on either side.
WORTH, GAP = 8.0, 0.1
#: Extension goes on after a break if so many of the next words agree, with at most SHIFT words skipped on a side.
AGAIN, SHIFT = 4, 3
_SHIFTS = sorted(((p, q) for p in range(SHIFT + 1) for q in range(SHIFT + 1) if p or q), key=lambda s: (max(s), sum(s)))
#: Stretches of up to so many words between seeds are aligned in full; longer ones end a passage.
STRETCH = 128
BATCH = 1 << 21
#: Pairs of one partner that share a copy of its words; a partner of more pairs is sent once a slice of them.
SLICE = 256
_CONTEXTS = RollingHash(11, 0xC2B2AE3D27D4EB4F)
#: Low bits of a ranked hash that hold its index within a batch.
_INDEX = U64((1 << 28) - 1)


def seeds(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Picked k-mers of many texts: (text index, hash, place), the first least of every ``WINDOW`` neighbours in a text.

    A text with fewer k-mers has its least one. All texts are worked on at once; windows over two texts are left out.
    """
    doc, words, at = word_hashes(texts)
    n = np.bincount(doc, minlength=len(texts))
    inside = np.flatnonzero(n[doc] - at >= SEED)
    if not len(inside):
        return doc[:0], words[:0], at[:0]
    h = np.zeros(len(inside), dtype=U64)
    for i in range(SEED):
        h = mix64(h + words[inside + i] + step(i + 1))
    doc, at = doc[inside], at[inside]
    ranked = (h & ~_INDEX) | np.arange(len(h), dtype=U64)
    picked = np.zeros(len(h), dtype=bool)
    if len(h) >= WINDOW:
        least = (sliding_min(ranked, WINDOW) & _INDEX).astype(np.int64)
        picked[least[doc[:len(least)] == doc[WINDOW - 1:]]] = True
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    short = np.diff(np.concatenate((first, [len(h)]))) < WINDOW
    picked[(np.minimum.reduceat(ranked, first) & _INDEX).astype(np.int64)[short]] = True
    return doc[picked], h[picked], at[picked]


def _seed_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Seeds, each with the hash of itself, the next seed of its text and the way to it (``pair``; the last has 0 words to go)."""
    for pdf in frames:
        texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy()
        for lo, hi in text_batches(texts, BATCH):
            doc, h, at = seeds(texts[lo:hi])
            on = np.zeros(len(doc), dtype=np.int64)
            on[:-1] = np.where(doc[1:] == doc[:-1], at[1:] - at[:-1], 0)
            pair = mix64(mix64(h + step(1)) + np.roll(h, -1) + on.astype(U64) * step(2))
            yield pd.DataFrame({"key": h.view(np.int64), "doc": ids[lo:hi][doc], "at": at.astype(np.int32),
                                "pair": pair.view(np.int64), "on": on.astype(np.int32)})


def _word_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of a text as 32-bit hashes: enough to compare words at aligned places."""
    for pdf in frames:
        texts = pdf["text"].tolist()
        for lo, hi in text_batches(texts, BATCH):
            doc, h, _ = word_hashes(texts[lo:hi])
            ends = np.searchsorted(doc, np.arange(hi - lo + 1))
            yield pd.DataFrame({"doc": pdf["doc_id"].values[lo:hi], "words": [
                (h[i:j] >> U64(32)).astype("<u4").tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]})


class MaxFenwick:
    """Prefix maxima over 0..n-1: the best (value, index) among keys up to a bound."""

    def __init__(self, n: int):
        self.best = [(-np.inf, -1)] * (n + 1)

    def put(self, key: int, value: float, index: int) -> None:
        key += 1
        while key < len(self.best):
            if value > self.best[key][0]:
                self.best[key] = (value, index)
            key += key & -key

    def upto(self, key: int) -> tuple[float, int]:
        key, top = key + 1, (-np.inf, -1)
        while key > 0:
            top = max(top, self.best[key])
            key -= key & -key
        return top


def chains(a: np.ndarray, b: np.ndarray) -> list[list[tuple[int, int]]]:
    """Chains of the matches (a[i], b[i]) that rise on both sides, best first; a match is in one chain.

    A match is worth ``WORTH``, and following another costs ``GAP`` per word between
    them on either side. With the cost split into one part for each match, the best
    predecessor is a prefix maximum over the second place.
    """
    order = np.lexsort((-b, a))  # matches at one first place: the later second place first, so none follows another
    a, b = a[order], b[order]
    da, db = np.diff(a), np.diff(b)
    if (da > 0).all() and (db > 0).all() and (GAP * (da + db) < WORTH).all():
        # one rising run without a gap that costs more than a seed: costs add up along it, so it is the chain
        return [list(zip(a.tolist(), b.tolist(), strict=True))]
    a, b = a.tolist(), b.tolist()
    keys = {v: i for i, v in enumerate(sorted(set(b)))}
    tree = MaxFenwick(len(keys))
    score, before = [0.0] * len(a), [-1] * len(a)
    for i in range(len(a)):
        value, j = tree.upto(keys[b[i]] - 1)
        gain = value - GAP * (a[i] + b[i])
        score[i] = WORTH + max(0.0, gain)
        before[i] = j if gain > 0 else -1
        tree.put(keys[b[i]], score[i] + GAP * (a[i] + b[i]), i)
    used, out = [False] * len(a), []
    for i in sorted(range(len(a)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append((a[i], b[i]))
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def _equal_between(x: np.ndarray, y: np.ndarray) -> int:
    """Most words that an in-order alignment of two short stretches can pair (longest common subsequence)."""
    if len(x) == len(y):
        same = int((x == y).sum())
        if same >= len(x) - 2:
            return same
    # bit i of ``open_`` is 0 where the length of the best pairing grows at x[i], for the words of y so far
    places: dict[int, int] = {}
    for i, w in enumerate(x.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    whole = open_ = (1 << len(x)) - 1
    for v in y.tolist():
        met = open_ & places.get(v, 0)
        open_ = ((open_ + met) | (open_ - met)) & whole
    return len(x) - open_.bit_count()


def _equal_in_chain(x: np.ndarray, y: np.ndarray, part: list[tuple[int, int]]) -> int:
    """Equal words of the alignment that a chain fixes, from its first seed to the end of its last.

    Seeds on one diagonal are compared in one go; only stretches that differ in
    more than two words, or change the diagonal, are aligned by themselves.
    """
    total = SEED
    if len(part) == 1:
        return total
    p, q = np.array(part).T
    turns = np.flatnonzero(np.diff(p) != np.diff(q))
    for lo, hi in zip([0, *(turns + 1).tolist()], [*turns.tolist(), len(p) - 1], strict=True):
        if lo:  # the stretch that changes the diagonal; seeds may overlap
            end_i, end_j = p[lo - 1] + SEED, q[lo - 1] + SEED
            skip = max(0, end_i - p[lo], end_j - q[lo])
            total += _equal_between(x[end_i:p[lo] + skip], y[end_j:q[lo] + skip]) + SEED - skip
        if hi == lo:
            continue
        equal = np.concatenate(([0], np.cumsum(x[p[lo]:p[hi] + SEED] == y[q[lo]:q[hi] + SEED])))
        ends, nexts = p[lo:hi] + SEED - p[lo], p[lo + 1:hi + 1] - p[lo]
        gap = np.maximum(nexts, ends)
        lost = (gap - ends) - (equal[gap] - equal[ends])
        total += int(equal[-1] - SEED)
        for k in np.flatnonzero(lost > 2).tolist():
            u, v = ends[k], gap[k]
            total += _equal_between(x[p[lo] + u:p[lo] + v], y[q[lo] + u:q[lo] + v]) - int(equal[v] - equal[u])
    return total


def _run(x: np.ndarray, y: np.ndarray) -> int:
    """Equal words at the starts of two arrays of one length; a long array is only read as far as it is equal, or some times that."""
    at, ahead = 0, 32
    while at < len(x):
        differ = x[at:ahead] != y[at:ahead]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, ahead = min(ahead, len(x)), ahead * 4
    return len(x)


def _alike(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """The equal runs (place, other place, words) over which two texts go on alike from their starts."""
    i = j = 0
    runs = []
    while True:
        n = min(len(x) - i, len(y) - j)
        if n <= 0:
            return runs
        run = _run(x[i:i + n], y[j:j + n])
        if run:
            runs.append((i, j, run))
        i, j = i + run, j + run
        u, v = x[i:i + SHIFT + AGAIN].tolist(), y[j:j + SHIFT + AGAIN].tolist()
        best = None
        for di, dj in _SHIFTS:
            p = u[di:di + AGAIN]
            if len(p) == AGAIN and p == v[dj:dj + AGAIN]:
                best = di, dj
                break
        if best is None:
            return runs
        i, j = i + best[0], j + best[1]


def _extend(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """How far two texts go on alike from their starts: words taken of each, and equal words."""
    runs = _alike(x, y)
    if not runs:
        return 0, 0, 0
    i, j, n = runs[-1]
    return i + n, j + n, sum(run[2] for run in runs)


def _equal_runs(x: np.ndarray, y: np.ndarray, part: list[tuple[int, int]]) -> np.ndarray:
    """Equal runs (place, other place, words, equal words in the stretch before) along a chain, into its gaps and past its ends."""
    (i, j), runs = part[0], []
    for p, q, n in reversed(_alike(x[:i][::-1], y[:j][::-1])):
        runs.append((i - p - n, j - q - n, n, 0))
    end_i, end_j = i, j
    for i, j in part:
        skip = max(0, end_i - i, end_j - j)  # seeds may overlap
        i, j, n = i + skip, j + skip, SEED - skip
        inner = 0
        if i > end_i or j > end_j:
            on = _alike(x[end_i:i], y[end_j:j])
            runs += [(end_i + p, end_j + q, m, 0) for p, q, m in on]
            if on:
                end_i, end_j = end_i + on[-1][0] + on[-1][2], end_j + on[-1][1] + on[-1][2]
            back = [(i - p - m, j - q - m, m) for p, q, m in reversed(_alike(x[end_i:i][::-1], y[end_j:j][::-1]))]
            stop_i, stop_j = back[0][:2] if back else (i, j)
            inner = _equal_between(x[end_i:stop_i], y[end_j:stop_j])
            for p, q, m in back:
                runs.append((p, q, m, inner))
                inner = 0
        runs.append((i, j, n, inner))
        end_i, end_j = i + n, j + n
    runs += [(end_i + p, end_j + q, n, 0) for p, q, n in _alike(x[end_i:], y[end_j:])]
    return np.array(runs, dtype=np.int64)


def _pieces(x: np.ndarray, y: np.ndarray, part: list[tuple[int, int]], min_words: int,
            identity: float) -> list[tuple[int, int, int, int, float]]:
    """What is alike enough in a part of a chain that is not so as a whole.

    From every equal run on, the longest stretch to the end of another run that
    has the words and the share. Such stretches that overlap are one
    piece, with the best share.
    """
    i, j, n, more = _equal_runs(x, y, part).T
    end_i, end_j, upto = i + n, j + n, np.cumsum(n + more)
    # a stretch from run k to run m has the share if its equal words outweigh both sides: at its end not less than at its start
    slack = 1e-9
    begins = [upto - n - identity * i - slack, upto - n - identity * j - slack]
    ends = [upto - identity * end_i, upto - identity * end_j]
    falling = [-np.maximum.accumulate(e[::-1])[::-1] for e in ends]
    furthest = np.minimum(*(np.searchsorted(f, -b, side="right") - 1 for f, b in zip(falling, begins, strict=True)))
    out: list[tuple[int, int, int, int, float]] = []
    reached, last = -1, -1
    for k in np.flatnonzero(furthest >= np.arange(len(n))).tolist():
        ahead = slice(reached + 1, int(furthest[k]) + 1)
        enough = np.flatnonzero((ends[0][ahead] >= begins[0][k]) & (ends[1][ahead] >= begins[1][k]))
        if not len(enough):
            continue
        reached = m = reached + 1 + int(enough[-1])
        long = max(end_i[m] - i[k], end_j[m] - j[k])
        if min(end_i[m] - i[k], end_j[m] - j[k]) < min_words:
            continue
        share = min(1.0, float((upto[m] - upto[k] + n[k]) / long))
        piece = (int(i[k]), int(end_i[m]), int(j[k]), int(end_j[m]), share)
        if k <= last:
            piece = (out[-1][0], piece[1], out[-1][2], piece[3], max(out.pop()[4], share))
        out.append(piece)
        last = m
    return out


def passages(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, min_words: int = MIN_WORDS,
             identity: float = IDENTITY) -> list[tuple[int, int, int, int, float]]:
    """(start, end, other start, other end, identity) of the fuzzy passages of two texts (arrays of words) with seed matches (a, b)."""
    out: list[tuple[int, int, int, int, float]] = []
    for chain in chains(a, b):
        if any(s <= chain[0][0] and chain[-1][0] + SEED <= e and t <= chain[0][1] and chain[-1][1] + SEED <= u
               for s, e, t, u, _ in out):
            continue  # an extension has covered it
        parts, begin = [], 0
        for k in range(1, len(chain)):
            if max(chain[k][0] - chain[k - 1][0], chain[k][1] - chain[k - 1][1]) - SEED > STRETCH:
                parts.append(chain[begin:k])
                begin = k
        for part in [*parts, chain[begin:]]:
            (i, j), (end_i, end_j) = part[0], part[-1]
            same = _equal_in_chain(x, y, part)
            end_i, end_j = end_i + SEED, end_j + SEED
            back_i, back_j, more = _extend(x[:i][::-1], y[:j][::-1])
            on_i, on_j, rest = _extend(x[end_i:], y[end_j:])
            i, j, end_i, end_j, same = i - back_i, j - back_j, end_i + on_i, end_j + on_j, same + more + rest
            if min(end_i - i, end_j - j) < min_words:
                continue
            share = same / max(end_i - i, end_j - j)
            if share >= identity:
                out.append((i, end_i, j, end_j, min(1.0, share)))
            else:
                out += _pieces(x, y, part, min_words, identity)
    return out


def _find(min_words: int, identity: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("doc", "partner", "start", "end", "other_start", "other_end", "identity")
        for pdf in frames:
            rows = []
            for doc, partner, matches, x, y in zip(pdf["doc"], pdf["partner"], pdf["matches"], pdf["words"], pdf["other"], strict=True):
                m = np.asarray(matches, dtype=np.int64)
                for p in passages(np.frombuffer(x, dtype="<u4"), np.frombuffer(y, dtype="<u4"),
                                  m >> 32, m & 0xFFFFFFFF, min_words, identity):
                    rows.append((doc, partner, *p))
            yield pd.DataFrame(rows, columns=names)

    return run


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Overlapping or touching ranges joined, of rows sorted by (doc, part, start); the smallest partner and the best identity stay."""
    names = ["doc", "part", "start", "end", "partner", "identity"]
    held: list | None = None
    for pdf in frames:
        done = []
        for row in pdf[names].itertuples(index=False):
            if held and row.doc == held[0] and row.part == held[1] and row.start <= held[3]:
                held[3:] = max(held[3], row.end), min(held[4], row.partner), max(held[5], row.identity)
            else:
                if held:
                    done.append(held)
                held = list(row)
        yield pd.DataFrame(done, columns=names)
    if held:
        yield pd.DataFrame([held], columns=names)


def _matches(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(places of shared keys with their documents low and high and their number n; doc, partner, match of every place).

    ``rows`` are (key, doc, at, ..). A key is compared with its first place in
    the partner: the extension finds the rest of what repeats there. Of rows
    with a column ``found``, keys whose places are all found are left out.
    """
    wanted = "low != high" + (" AND NOT done" if "found" in rows.columns else "")
    done = F.min("found") if "found" in rows.columns else F.lit(False)
    shared = materialize(rows.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"),
                                                 done.alias("done")).where(wanted).drop("done"), f"{name}-shared")
    met = materialize(rows.join(shared.hint("merge"), "key"), f"{name}-places")
    there = materialize(met.where("doc = low OR doc = high").groupBy("key", F.col("doc").alias("partner")).agg(
        F.min("at").alias("there")), f"{name}-partner-places")
    sides = met.select("key", "doc", "at", F.explode(F.array("low", "high")).alias("partner")).where("doc != partner")
    found = materialize(sides.join(there.hint("merge"), ["key", "partner"]).select(
        "doc", "partner", (F.shiftleft(F.col("at").cast("bigint"), 32) + F.col("there")).alias("match")), f"{name}-matches")
    discard(shared, there)
    return met, found


def _inside(low: np.ndarray, high: np.ndarray, ranges: list | None) -> np.ndarray:
    """Whether each [low, high) lies in one of the ranges, which don't overlap."""
    begin, end = np.array(sorted([(-1, -1), *((r["start"], r["end"]) for r in ([] if ranges is None else ranges))]), dtype=np.int64).T
    return end[np.searchsorted(begin, low, side="right") - 1] >= high


def _open_keys(min_words: int):
    """Keys with a place around which a window of ``min_words`` lies in no range found."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = [np.zeros(0, dtype=np.int64)]
            for n, keys, ats, ends, ranges in zip(pdf["n_words"], pdf["keys"], pdf["ats"], pdf["ends"], pdf["ranges"], strict=True):
                low = np.maximum(np.asarray(ends, dtype=np.int64) - min_words, 0)
                high = np.minimum(np.asarray(ats, dtype=np.int64) + min_words, n)
                # ranges that overlap are one, so all windows are found if they are so together
                out.append(np.unique(np.asarray(keys, dtype=np.int64)[(high - low >= min_words) & ~_inside(low, high, ranges)]))
            yield pd.DataFrame({"key": np.unique(np.concatenate(out))})

    return run


def _window_rows(min_words: int):
    """Hashes of all windows of ``min_words`` around the given places of a document, and whether each lies in a range found."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for doc, words, ats, ends, ranges in zip(pdf["doc"], pdf["words"], pdf["ats"], pdf["ends"], pdf["ranges"], strict=True):
                w = np.frombuffer(words, dtype="<u4").astype(U64)
                low = np.maximum(np.asarray(ends, dtype=np.int64) - min_words, 0)
                high = np.minimum(np.asarray(ats, dtype=np.int64), len(w) - min_words) + 1
                low, high = low[low < high], high[low < high]
                wanted = np.zeros(len(w) + 2, dtype=np.int64)
                np.add.at(wanted, low, 1)
                np.add.at(wanted, high, -1)
                at = np.flatnonzero(np.cumsum(wanted) > 0)
                h = mix64(_CONTEXTS.windows(_CONTEXTS.prefix_of(mix64(w + step(3))), min_words)[at])
                out.append((np.full(len(at), doc), h.view(np.int64), at, _inside(at, at + min_words, ranges)))
            if out:
                doc, key, at, found = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pd.DataFrame({"key": key, "doc": doc, "at": at.astype(np.int32), "found": found})

    return run


_FOUND = "doc bigint, partner bigint, start bigint, end bigint, other_start bigint, other_end bigint, identity double"


def _compare(matches: DataFrame, words: DataFrame, min_words: int, identity: float, name: str) -> DataFrame:
    """Passages of every (doc, partner) by its matches. A partner of many pairs is sent once a slice of them, to several tasks."""
    pairs = materialize(matches.groupBy("doc", "partner").agg(F.collect_set("match").alias("matches")), f"{name}-pairs")
    slices = materialize(pairs.groupBy("partner").agg(F.ceil(F.count("*") / F.lit(SLICE)).cast("int").alias("slices")), f"{name}-slices")
    many = slices.where("slices > 1")
    split = pairs.join(many, "partner", "left").withColumn(
        "slice", F.pmod(F.xxhash64("doc"), F.coalesce("slices", F.lit(1))).cast("int")).drop("slices")
    others = words.join(slices.withColumnRenamed("partner", "doc").hint("merge"), "doc").select(
        F.col("doc").alias("partner"), F.col("words").alias("other"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    both = (split.join(words.hint("merge"), "doc").join(others.hint("merge"), ["partner", "slice"])
            .select("doc", "partner", "matches", "words", "other"))
    found = materialize(both.mapInPandas(_find(min_words, identity), _FOUND), f"{name}-passages")
    discard(pairs, slices)
    return found


def _ranges(found: DataFrame) -> DataFrame:
    """The ranges (doc, start, end, partner, identity) of both sides, those that overlap as one."""
    both = found.select("doc", "start", "end", "partner", "identity").unionByName(found.select(
        F.col("partner").alias("doc"), F.col("other_start").alias("start"), F.col("other_end").alias("end"),
        F.col("doc").alias("partner"), "identity"))
    # a document that many others repeat has many equal ranges: these meet in the partial aggregate, the rest in salted parts
    ranges = both.groupBy("doc", "start", "end").agg(F.min("partner").alias("partner"), F.max("identity").alias("identity"))
    schema = "doc bigint, part int, start bigint, end bigint, partner bigint, identity double"
    for part in (F.pmod(F.xxhash64("start", "end"), F.lit(64)).cast("int"), F.lit(0)):
        ranges = (ranges.select("doc", part.alias("part"), "start", "end", "partner", "identity").repartition("doc", "part")
                  .sortWithinPartitions("doc", "part", "start", "end").mapInPandas(_merge, schema))
    return ranges


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, identity: float = IDENTITY,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage of a document that repeats, exactly or nearly, in another document.

    Columns: doc_id, start_word, end_word (exclusive), n_words, partner_id (the smallest
    document it was found in), identity (share of equal words, best partner), is_first
    (no partner has a smaller id). Both sides of a match are reported, so copies of a
    document appear with one passage each. Ranges that overlap are one
    passage. Documents without one have no row; nulls, empty texts and texts
    shorter than a passage have none. Rows that share an id are one document, the
    longest text of which is read; rows without an id are left out, as no result could name them.

    Every run of ``min_words`` equal words is in a passage if it has 47 words at least (two
    picked seeds in a row), however many documents hold its seeds: a seed, or two in a row, that
    stand in two places only name the pair; where they stand in more and a
    window around them is in no passage yet, the window itself is the key.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    rows = base.mapInPandas(_seed_rows, "key bigint, doc bigint, at int, pair bigint, on int")
    met, by_seed = _matches(rows, "seeds")
    contexts, by_context = _matches(met.where("n > 2 AND on > 0").select(
        F.col("pair").alias("key"), "doc", "at", (F.col("at") + F.col("on") + SEED).alias("end")), "contexts")

    ids = met.select("doc").distinct().hint("merge")
    wanted = base.join(ids, base["doc_id"] == ids["doc"], "left_semi")
    texts = materialize(wanted.mapInPandas(_word_rows, "doc bigint, words binary"), "words")
    words = materialize(texts.groupBy("doc").agg(F.max_by("words", F.length("words")).alias("words")), "document-words")
    discard(met, texts)
    first = _compare(by_seed.unionByName(by_context), words, min_words, identity, "first")
    discard(by_seed, by_context)

    # contexts of more than two places with a window in no passage: the windows around all their places are compared
    places = contexts.where("n > 2").select("key", "doc", "at", "end")
    covered = materialize(_ranges(first).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "covered")
    listed = places.groupBy("doc").agg(F.collect_list(F.struct("key", "at", "end")).alias("places")).select(
        "doc", F.col("places.key").alias("keys"), F.col("places.at").alias("ats"), F.col("places.end").alias("ends"))
    sizes = words.select("doc", (F.length("words") / 4).cast("bigint").alias("n_words"))
    open_keys = materialize(listed.join(sizes.hint("merge"), "doc").join(covered, "doc", "left").select(
        "n_words", "keys", "ats", "ends", "ranges").mapInPandas(_open_keys(min_words), "key bigint"), "open-contexts")
    again = places.join(open_keys.distinct(), "key", "left_semi").groupBy("doc").agg(
        F.collect_list(F.struct("at", "end")).alias("places")).select("doc", F.col("places.at").alias("ats"), F.col("places.end").alias("ends"))
    windows = materialize(again.join(words.hint("merge"), "doc").join(covered, "doc", "left").select(
        "doc", "words", "ats", "ends", "ranges").mapInPandas(
            _window_rows(min_words), "key bigint, doc bigint, at int, found boolean"), "windows")
    window_places, by_window = _matches(windows, "windows")
    rest = _compare(by_window, words, min_words, identity, "rest")
    discard(contexts, open_keys, covered, windows, window_places, by_window, words)

    return _ranges(first.unionByName(rest)).select(
        F.col("doc").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"), F.col("partner").alias("partner_id"), "identity",
        (F.col("doc") < F.col("partner")).alias("is_first"))
