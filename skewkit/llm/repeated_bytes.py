"""Removal of long repeated byte strings by distributed suffix arrays (operator 4).

Every string of ``WIDTH`` bytes picks an anchor by its content alone: the first
least hash among the ``SEED``-byte strings in it. Equal strings pick equal anchors
at equal places, so strings are only compared where anchors repeat:

1. Strings that pick the same anchor form a run. Runs of one anchor with equal
   whole contexts are repeats throughout; counting them settles all copies.
2. Other runs of a repeated anchor are cut into pieces of ``PIECE`` neighbouring strings.
   What these have in common, their core, becomes one symbol, with the bytes
   on either side as symbols; suffix arrays by linear grouping construction
   over the pieces of many cores show which strings occur twice.
3. A core met too often for one task is settled string by string, by counting.

Hashes of 128 bits stand for strings (two 64-bit hashes under different bases).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import U64, RollingHash, map_by_id, mix64, sliding_min, step
from skewkit.llm.suffix_groups import suffix_array
from skewkit.session import materialize

WIDTH, SEED = 400, 160
PIECE = 16
#: Symbols that one suffix array is built over, about.
ARRAY_SYMBOLS = 1 << 17
#: A core met in more pieces than this is counted string by string.
HOT_CORE = 256
#: Anchors of a long text are found in slices of so many strings.
SLICE = 1 << 22
_INDEX = U64((1 << 24) - 1)
_A = RollingHash(41, 0xD1342543DE82EF95)
_B = RollingHash(42, 0xA0761D6478BD642F)


def anchor_runs(data: bytes, width: int = WIDTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: (anchor hash, context hash, first start, last start, anchor position)."""
    n = len(data)
    if n < width:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    buf = np.frombuffer(data, dtype=np.uint8)
    prefix = _A.prefix(buf)
    h = mix64(_A.windows(prefix, seed))
    span, strings = width - seed + 1, n - width + 1
    picked = np.empty(strings, dtype=np.int64)
    for lo in range(0, strings, SLICE):
        hi = min(strings, lo + SLICE)
        part = h[lo:hi + span - 1]
        least = sliding_min((part & ~_INDEX) | np.arange(len(part), dtype=U64), span)
        picked[lo:hi] = lo + (least & _INDEX).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], picked[1:] != picked[:-1])))
    last = np.concatenate((first[1:], [strings])) - 1
    anchor = picked[first]
    other = _B.prefix(buf)
    where = mix64((anchor - first).astype(U64) * step(1) + (last - first).astype(U64))
    context = mix64(_B.spans(other, first, last + width) ^ where)
    return h[anchor].view(np.int64), context.view(np.int64), first, last, anchor


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        rows: list[tuple[np.ndarray, ...]] = []
        size = 0
        for row, text in zip(pdf["row"], pdf["text"], strict=True):
            got = anchor_runs(text.encode())
            rows.append((np.full(len(got[0]), row), *got))
            size += len(got[0])
            if size > 200_000:
                yield _run_frame(rows)
                rows, size = [], 0
        yield _run_frame(rows)


def _run_frame(rows: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
    names = ("row", "anchor", "context", "first", "last", "at")
    return pd.DataFrame({c: np.concatenate([r[i] for r in rows]) if rows else [] for i, c in enumerate(names)})


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of the open runs of each text: 128-bit core, strings [lo, hi] of the piece, and the bytes on both sides."""
    for pdf in frames:
        out = []
        for row, text, runs in zip(pdf["row"], pdf["text"], pdf["runs"], strict=True):
            data = text.encode()
            buf = np.frombuffer(data, dtype=np.uint8)
            pa, pb = _A.prefix(buf), _B.prefix(buf)
            first, last, at = (np.array([r[c] for r in runs], dtype=np.int64) for c in ("first", "last", "at"))
            low, high = (at - last) // PIECE, (at - first) // PIECE
            many = high - low + 1
            own = np.repeat(np.arange(len(runs)), many)
            m = low[own] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            top = at[own] - PIECE * m  # the last string a piece could hold; the first is PIECE - 1 before
            lo = np.maximum(top - PIECE + 1, first[own])
            hi = np.minimum(top, last[own])
            core_end = top - PIECE + 1 + WIDTH
            place = m.astype(U64) * step(3)
            ca = mix64(_A.spans(pa, top, core_end) + place).view(np.int64)
            cb = mix64(_B.spans(pb, top, core_end) ^ place).view(np.int64)
            left = [data[a:b] for a, b in zip(lo.tolist(), top.tolist(), strict=True)]
            right = [data[a:b] for a, b in zip(core_end.tolist(), (hi + WIDTH).tolist(), strict=True)]
            out.append(pd.DataFrame({"core_a": ca, "core_b": cb, "row": row, "lo": lo, "hi": hi, "left": left, "right": right}))
        if out:
            yield pd.concat(out)


def _spans_of(starts: np.ndarray, rows: np.ndarray) -> pd.DataFrame:
    """Merged byte ranges of repeated strings that begin at ``starts`` (sorted within ``rows``)."""
    new = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (starts[1:] > starts[:-1] + WIDTH)))) \
        if len(starts) else np.zeros(0, np.int64)
    stop = np.concatenate((new[1:], [len(starts)])).astype(np.int64) - 1
    return pd.DataFrame({"row": rows[new], "start": starts[new], "end": starts[stop] + WIDTH})


def repeated_in_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
    """Byte ranges of the strings that occur twice among the pieces, which hold every piece of their cores, by one suffix array.

    A piece reads: bytes left of the core, the core as one symbol, bytes right of it, an end
    mark. A string is ``PIECE`` symbols long there, and strings of one anchor place are equal just if
    these are.
    """
    cores, code = np.unique(pdf[["core_a", "core_b"]].to_records(index=False), return_inverse=True)
    pdf = pdf[np.bincount(code, minlength=len(cores))[code] > 1]
    if not len(pdf):
        return pd.DataFrame({"row": [], "start": [], "end": []}).astype(np.int64)
    code = np.unique(pdf[["core_a", "core_b"]].to_records(index=False), return_inverse=True)[1]
    symbols, start, begin = [], [], 0
    for c, left, right in zip(code.tolist(), pdf["left"], pdf["right"], strict=True):
        start.append(begin)
        piece = [*(x + 1 for x in left), 257 + c, *(x + 1 for x in right), 0]
        symbols += piece
        begin += len(piece)
    text = np.array(symbols + [0] * PIECE, dtype=np.int64)
    order = suffix_array(text[:begin])
    view = np.lib.stride_tricks.sliding_window_view(text, PIECE)
    same = (view[order[1:]] == view[order[:-1]]).all(axis=1)
    twice = np.zeros(begin, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    many = (pdf["hi"] - pdf["lo"] + 1).to_numpy()
    own = np.repeat(np.arange(len(pdf)), many)
    shift = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    hit = twice[np.array(start)[own] + shift]
    rows, starts = pdf["row"].to_numpy()[own][hit], (pdf["lo"].to_numpy()[own] + shift)[hit]
    by = np.lexsort((starts, rows))
    return _spans_of(starts[by], rows[by])


def _piece_arrays(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffix arrays over consecutive cores of a partition that is sorted by core; a core is never split between two."""
    kept: list[pd.DataFrame] = []
    size = 0
    for pdf in frames:
        kept.append(pdf)
        size += len(pdf)
        if size * 2 * PIECE < ARRAY_SYMBOLS:
            continue
        rows = pd.concat(kept, ignore_index=True)
        tail = (rows["core_a"] == rows["core_a"].iloc[-1]) & (rows["core_b"] == rows["core_b"].iloc[-1])
        cut = int((~tail).to_numpy().nonzero()[0][-1]) + 1 if not tail.all() else 0
        yield from _arrays(rows.iloc[:cut])
        kept, size = [rows.iloc[cut:]], len(rows) - cut
    if kept:
        yield from _arrays(pd.concat(kept, ignore_index=True))


def _arrays(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Sorted rows in stretches of whole cores, of about ``ARRAY_SYMBOLS`` symbols each."""
    a, b = rows["core_a"].to_numpy(), rows["core_b"].to_numpy()
    if not len(rows):
        return
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    limit = ARRAY_SYMBOLS // (2 * PIECE)
    begin = 0
    for stop in [*new[1:].tolist(), len(rows)]:
        if stop - begin >= limit or stop == len(rows):
            yield repeated_in_pieces(rows.iloc[begin:stop])
            begin = stop


def _strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string of a piece by a 128-bit hash of its core and the bytes around."""
    for pdf in frames:
        rows = []
        for ca, cb, row, lo, hi, left, right in pdf[["core_a", "core_b", "row", "lo", "hi", "left", "right"]].itertuples(index=False):
            top = lo + len(left)
            for i in range(lo, hi + 1):
                d = hashlib.blake2b(left[i - lo:] + b"|" + right[:PIECE - 1 - (top - i)], digest_size=16,
                                    key=int(ca).to_bytes(8, "little", signed=True) + int(cb).to_bytes(8, "little", signed=True))
                rows.append((d.digest(), row, i))
        yield pd.DataFrame(rows, columns=["string", "row", "start"])


def _cut(frames: Iterator[pd.DataFrame], keep_bytes: bool) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        rows = []
        for text, ranges in zip(pdf["text"], pdf["ranges"], strict=True):
            data = text.encode()
            kept, at, runs = [], 0, []
            for a, b in sorted((r["start"], r["end"]) for r in ranges) if ranges is not None else ():
                if b <= at:
                    continue
                if a > at or not runs:  # touching ranges are one run
                    kept.append(data[at:a])
                    runs.append([a, b])
                runs[-1][1] = at = b
            kept.append(data[at:])
            rest = b"".join(kept)
            row = (len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(rest).hexdigest(),
                   ",".join(f"{a}:{b}" for a, b in runs))
            rows.append((*row, rest) if keep_bytes else row)
        out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * keep_bytes)
        out.insert(0, "doc_id", pdf["doc_id"].values)
        yield out


def repeated_ranges(rows: DataFrame, hot_core: int = HOT_CORE) -> DataFrame:
    """(row, start, end): byte ranges of (row, text) that are covered by strings which start at two places; they may overlap."""
    runs = materialize(rows.mapInPandas(
        _runs, "row bigint, anchor bigint, context bigint, first bigint, last bigint, at bigint"), "anchor-runs")
    repeated = materialize(
        runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
        .where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("open")), "repeated-anchors")
    met = materialize(runs.join(repeated.hint("merge"), "anchor"), "repeated-runs")
    contexts = materialize(met.where("open").groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "first", "last", "at")).alias("one")), "contexts")
    twice = met.where("NOT open").select("row", "first", "last").unionByName(
        met.where("open").join(contexts.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
        .select("row", "first", "last"))
    settled = twice.select("row", F.col("first").alias("start"), (F.col("last") + WIDTH).alias("end"))

    # one run of each context speaks for it
    todo = contexts.groupBy("one.row").agg(F.collect_list(F.struct("one.first", "one.last", "one.at")).alias("runs"))
    texts = rows.join(todo.hint("merge"), "row")
    pieces = materialize(texts.select("row", "text", "runs").mapInPandas(
        _pieces, "core_a bigint, core_b bigint, row bigint, lo bigint, hi bigint, left binary, right binary"), "pieces")
    core = ["core_a", "core_b"]
    counts = materialize(pieces.groupBy(*core).agg(F.count("*").alias("n")).where("n > 1"), "cores")
    shared = pieces.join(counts.hint("merge"), core)
    cool = shared.where(F.col("n") <= hot_core).drop("n").repartition(*core).sortWithinPartitions(*core)
    by_array = cool.mapInPandas(_piece_arrays, "row bigint, start bigint, end bigint")
    hot = shared.where(F.col("n") > hot_core).select(*core, "row", "lo", "hi", "left", "right")
    strings = materialize(hot.mapInPandas(_strings, "string binary, row bigint, start bigint"), "hot-strings")
    often = materialize(strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string"), "hot-repeats")
    by_count = strings.join(often.hint("merge"), "string").select("row", "start", (F.col("start") + WIDTH).alias("end"))
    return settled.unionByName(by_array).unionByName(by_count)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True,
                   hot_core: int = HOT_CORE) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (the removed runs as start:end in bytes,
    end exclusive, comma-joined), and kept (the remaining bytes) on request.

    Each byte of a string of ``WIDTH`` bytes that also starts anywhere else in any text, the same one included,
    goes; strings are judged on the input. A null text counts as empty; texts shorter
    than a string keep all bytes. Rows that repeat an id, or have none, are texts of their own.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    unclear = base.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if id_type in ("tinyint", "smallint", "int", "bigint") and unclear.isEmpty():
        keyed = base.withColumn("row", F.col("doc_id").cast("bigint"))
    else:  # ids that don't tell rows apart: number them once, in a table, so that every read agrees
        keyed = materialize(base.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
    ranges = repeated_ranges(keyed.select("row", "text"), hot_core)
    merged = ranges.distinct().groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    whole = keyed.join(merged.hint("merge"), "row", "left").select("doc_id", "text", "ranges")
    added = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans string"
    return map_by_id(whole, lambda frames: _cut(frames, keep_bytes), added + ", kept binary" * keep_bytes)
