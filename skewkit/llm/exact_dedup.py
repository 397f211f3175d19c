"""Exact dedup by content-defined chunk recipes (operator 9).

Each text is cut where a rolling hash of its last 64 bytes meets a mask, so equal
texts get equal cuts. A document becomes a recipe, the ordered list of its
chunk identifiers; the bytes of a chunk travel once, to prove that its
identifier stands for one content. Documents are then compared by recipe only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import byte_table, map_by_id
from skewkit.session import materialize

#: Cuts where the lowest bits of the rolling hash's upper half are zero: 4 KiB on average, within these bounds.
MEAN_BITS, MIN_CHUNK, MAX_CHUNK = 12, 512, 32768
_GEAR = byte_table(9)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of shifted table values of the 64 bytes up to it (doubling, no loop over bytes)."""
    g, span = _GEAR[data], 1
    while span < 64 and span < len(g):
        g[span:] += g[:-span] << np.uint64(span)
        span *= 2
    return g


def chunk_bounds(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data``; a function of the bytes alone."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n]
    h = gear_hash(np.frombuffer(data, dtype=np.uint8).copy())
    cuts = np.flatnonzero((h >> np.uint64(52 - MEAN_BITS)) & np.uint64((1 << MEAN_BITS) - 1) == 0) + 1
    out, start = [], 0
    for c in cuts.tolist():
        while c - start > MAX_CHUNK:
            start += MAX_CHUNK
            out.append(start)
        if c - start >= MIN_CHUNK:
            out.append(c)
            start = c
    while n - start > MAX_CHUNK:
        start += MAX_CHUNK
        out.append(start)
    if start < n or not out:
        out.append(n)
    return out


def _chunks(data: bytes) -> list[bytes]:
    ends = chunk_bounds(data)
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _recipes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        recipe, sha = [], []
        for text in pdf["text"]:
            data = text.encode()
            recipe.append(b"".join(hashlib.sha256(c).digest() for c in _chunks(data)))
            sha.append(hashlib.sha256(data).hexdigest())
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "recipe": recipe, "text_sha256": sha})


def _contents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        seen: dict[bytes, bytes] = {}
        rest: list[tuple[bytes, bytes]] = []
        for text in pdf["text"]:
            for c in _chunks(text.encode()):
                d = hashlib.sha256(c).digest()
                if seen.setdefault(d, c) != c:
                    rest.append((d, c))
        yield pd.DataFrame([*seen.items(), *rest], columns=["chunk_id", "content"])


def colliding_chunks(texts: DataFrame) -> DataFrame:
    """Chunk identifiers that stand for more than one content, proved on the bytes.

    A content is part of the grouping key, so equality is of bytes and a content
    met anywhere is kept once; copies within a batch are dropped before the shuffle.
    """
    distinct = texts.select("text").withColumn("doc_id", F.lit(0)).mapInPandas(
        _contents, "chunk_id binary, content binary").groupBy("chunk_id", "content").agg(F.lit(1).alias("one"))
    return distinct.groupBy("chunk_id").agg(F.count("*").alias("n")).where("n > 1").select("chunk_id")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and all empty texts are equal. Of equal texts the
    largest id stays; null ids sort below every other. Rows that repeat an id
    and its text count in group_size and share the decision. An empty table
    gives an empty result. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    recipes = materialize(map_by_id(base, _recipes, "recipe binary, text_sha256 string"), "recipes")
    bad = materialize(colliding_chunks(base), "chunk-collisions")
    if not bad.isEmpty():  # an identifier was given to two contents: these recipes are told apart by whole texts
        raise ArithmeticError("two different chunks share a SHA-256 digest; recipes cannot identify texts")
    groups = materialize(
        recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1"), "recipe-groups")
    out = recipes.join(groups, "recipe", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
