"""Near-duplicate documents by ProbMinHash signatures, banding and verification (operator 10).

A document is a weighted set of five-word shingles. Each shingle of weight w
sends the points of a Poisson process of rate w to random registers; a register
keeps its first arrival. Two documents agree in a register with their
probability Jaccard similarity. Equal bands name candidates, and
the similarity of every candidate pair is then computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import GOLDEN, MIX1, U64, map_by_id, mix64, step, text_batches, word_hashes
from skewkit.llm.components import components
from skewkit.session import materialize

WORDS, SIMILARITY = 5, 0.8
#: 16 bands of 5 registers: a pair at the threshold shares a band with probability 0.998.
BANDS, ROWS = 16, 5
REGISTERS = BANDS * ROWS
#: What a centre leaves in several classes is compared block against block: so many members, or bytes of their sets, a block.
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Shared shingles that one matrix product takes at a time.
COLUMNS = 4096
#: Signatures are made for about this many bytes of text at a time.
BATCH_BYTES = 1 << 21


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of many texts: (text index, 64-bit shingle, count), and a hash of each text's words (0: none).

    A text of fewer than five words has one shingle, all of them.
    """
    doc, h, at = word_hashes(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    whole = np.zeros(len(texts), dtype=U64)
    np.add.at(whole, doc, mix64(h ^ (at.astype(U64) * MIX1)))
    s = np.zeros(len(h), dtype=U64)
    left = n_words[doc] - at
    for i in range(WORDS):
        inside = i < left
        nxt = np.zeros(len(h), dtype=U64)
        nxt[:max(0, len(h) - i)] = h[i:]
        s = np.where(inside, mix64(s + nxt + step(i + 1)), s)
    valid = (left >= WORDS) | (at == 0)
    s, doc = s[valid], doc[valid]
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = np.concatenate(([True], (s[1:] != s[:-1]) | (doc[1:] != doc[:-1]))) if len(s) else np.zeros(0, bool)
    pos = np.flatnonzero(new)
    return doc[pos], s[pos], np.diff(np.concatenate((pos, [len(s)]))), whole


def weights(counts: np.ndarray) -> np.ndarray:
    """A shingle's weight grows with the log of its count, so a line repeated at length does not outweigh the text."""
    return 1.0 + np.log(counts)


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """ProbMinHash signatures of many documents at once (n_docs x REGISTERS; rows without shingles stay 0).

    Every round draws the next point of each process still alive. A process
    ends when its next point comes after the last register's first
    arrival of its document, since no later one could enter.
    """
    first = np.full(n_docs * REGISTERS, np.inf)
    owner = np.zeros(n_docs * REGISTERS, dtype=U64)
    time = np.zeros(len(doc))
    i = 0
    while len(doc):
        i += 1
        r = mix64(shingle + step(i))
        time = time - np.log(((r >> U64(11)).astype(float) + 0.5) / float(1 << 53)) / weight
        at = doc * REGISTERS + (mix64(r) % U64(REGISTERS)).astype(np.int64)
        near = np.flatnonzero(time < first[at])
        np.minimum.at(first, at[near], time[near])
        won = near[time[near] == first[at[near]]]
        owner[at[won]] = shingle[won]
        alive = time < first.reshape(n_docs, REGISTERS).max(axis=1)[doc]
        doc, shingle, weight, time = doc[alive], shingle[alive], weight[alive], time[alive]
    return owner.reshape(n_docs, REGISTERS)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard of two weighted sets given by sorted distinct keys: for weights of one, plain Jaccard."""
    if not len(a) or not len(b):
        return 0.0
    keys = np.union1d(a, b)
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a)] = wa
    y[np.searchsorted(keys, b)] = wb
    common = (x > 0) & (y > 0)
    if not common.any():
        return 0.0
    ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    below_y = np.concatenate(([0], np.cumsum(y[order])))
    above_x = x.sum() - np.concatenate(([0], np.cumsum(x[order])))
    t = ratio[common]
    at = np.searchsorted(ratio[order], t, side="left")
    return float((x[common] / (above_x[at] + t * below_y[at])).sum())


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        texts = pdf["text"].tolist()
        for lo, hi in text_batches(texts, BATCH_BYTES):
            doc, s, n, whole = shingles(texts[lo:hi])
            sig = signatures(doc, s, weights(n), hi - lo)
            keys = np.zeros((hi - lo, BANDS), dtype=U64)
            for k in range(BANDS):
                for j in range(ROWS):
                    keys[:, k] = mix64(keys[:, k] * GOLDEN + sig[:, k * ROWS + j])
            yield pd.DataFrame({"doc_id": pdf["doc_id"].values[lo:hi], "words": whole.view(np.int64),
                                "bands": list(keys.view(np.int64))})


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sets for the exact comparison: sorted shingles (32 bits are enough within a pair) and capped counts."""
    for pdf in frames:
        texts = pdf["text"].tolist()
        for lo, hi in text_batches(texts, BATCH_BYTES):
            doc, s, n, _ = shingles(texts[lo:hi])
            ends = np.searchsorted(doc, np.arange(hi - lo + 1))
            out = []
            for i, j in zip(ends[:-1], ends[1:], strict=True):
                key, at = np.unique((s[i:j] >> U64(32)).astype("<u4"), return_index=True)
                out.append(key.tobytes() + n[i:j][at].astype("<u4").tobytes())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].values[lo:hi], "shingles": out})


def _weighted(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(raw, dtype="<u4")
    return v[:len(v) // 2], weights(v[len(v) // 2:])


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        sim = [similarity(*_weighted(x), *_weighted(c)) for x, c in zip(pdf["sx"], pdf["sc"], strict=True)]
        yield pd.DataFrame({"x": pdf["x"], "c": pdf["c"], "similarity": sim})


def _matrix(sets: list[tuple[np.ndarray, np.ndarray]], columns: np.ndarray) -> np.ndarray:
    """Weights of the sets (rows) on the given sorted shingles (columns)."""
    out = np.zeros((len(sets), len(columns)), dtype=np.float32)
    for row, (keys, weight) in zip(out, sets, strict=True):
        at = np.searchsorted(columns, keys)
        at[at == len(columns)] = 0
        here = columns[at] == keys
        row[at[here]] = weight[here]
    return out


def most_alike(left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """An upper bound of the similarity of every left with every right set, exact for weights of one.

    With shares p and q of their weights that two sets have in common, it is pq / (p + q - pq) at most: the sum over the
    common shingles of f(x, y) = xy / (y + (1 - q) x), which is concave and homogeneous, is at most f of the sums.
    """
    ours, theirs = (np.unique(np.concatenate([k for k, _ in side])) for side in (left, right))
    shared = np.intersect1d(ours, theirs, assume_unique=True)
    p, q = np.zeros((len(left), len(right))), np.zeros((len(left), len(right)))
    for start in range(0, len(shared), COLUMNS):
        columns = shared[start:start + COLUMNS]
        a, b = _matrix(left, columns), _matrix(right, columns)
        p += a @ (b > 0).T.astype(np.float32)
        q += (a > 0).astype(np.float32) @ b.T
    p /= np.array([w.sum() for _, w in left])[:, None]
    q /= np.array([w.sum() for _, w in right])[None, :]
    return np.divide(p * q, p + q - p * q, out=np.zeros_like(p), where=p > 0)


def _cell_links(cell: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Verified links between the two blocks of a cell: a spanning forest of the classes that alike pairs join."""
    cell = cell.sort_values("x", ignore_index=True)
    sets = [_weighted(raw) for raw in cell["shingles"]]
    ids, cls = cell["x"].to_numpy(), cell["cls"].to_numpy()
    i, j = cell["i"].iat[0], cell["j"].iat[0]
    left, right = np.flatnonzero(cell["block"] == i), np.flatnonzero(cell["block"] == j)
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        bound = most_alike([sets[k] for k in left], [sets[k] for k in right])
        bound[cls[left][:, None] == cls[right][None, :]] = 0
        if i == j:
            bound = np.triu(bound, 1)
        parent = {c: c for c in cls.tolist()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        u, v = np.nonzero(bound >= threshold - 1e-4)  # products in single precision; the comparison below is exact
        for k in np.argsort(-bound[u, v], kind="stable").tolist():
            x, y = int(left[u[k]]), int(right[v[k]])
            one, two = root(int(cls[x])), root(int(cls[y]))
            if one != two and similarity(*sets[x], *sets[y]) >= threshold - 1e-9:
                parent[one] = two
                out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _ordered(pairs: DataFrame, one: str, two: str) -> DataFrame:
    return pairs.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()


def _links(buckets: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Verified links (a, b): every alike pair of a bucket is linked or in one class by other links.

    ``buckets`` holds (band, key, x). Each member is compared with its bucket's centre, the member met by most
    others. Members of one centre that this leaves in different classes are dealt to blocks, and each cell of two blocks is
    one task's: matrix products bound all its pairs at once, pairs above the threshold and in
    different classes are verified, and only links that join classes leave the cell. So rows grow with the
    members (times the blocks of their centre), never with their pairs.
    """
    keys = ["band", "key"]
    met = buckets.join(buckets.groupBy(*keys).agg(F.count("*").alias("n")), keys).groupBy("x").agg(F.sum("n").alias("met"))
    centres = materialize(buckets.join(met, "x").groupBy(*keys).agg(
        F.max(F.struct("met", (-F.col("x")).alias("minus"))).alias("top")).select(*keys, (-F.col("top.minus")).alias("c")), "centres")
    star = materialize(buckets.join(centres, keys).where("x != c").select("x", "c").distinct(), "star-pairs")
    both = (star.join(sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("sx")), "x")
            .join(sets.select(F.col("doc_id").alias("c"), F.col("shingles").alias("sc")), "c"))
    seen = materialize(both.select("x", "c", "sx", "sc").mapInPandas(_compare, "x bigint, c bigint, similarity double"), "star-compared")
    links = materialize(_ordered(seen.where(F.col("similarity") >= threshold - 1e-9), "x", "c"), "star-links")

    classes = materialize(components(links).select(F.col("node").alias("x"), F.col("component").alias("cls")), "star-classes")
    placed = materialize(star.join(classes, "x", "left").withColumn("cls", F.coalesce("cls", "x")), "placed-members")
    apart = placed.groupBy("c").agg(F.count("*").alias("n"), F.min("cls").alias("low"), F.max("cls").alias("high")).where("low != high")
    sized = placed.join(apart.select("c"), "c").join(sets.select(F.col("doc_id").alias("x"), F.length("shingles").alias("size")), "x")
    blocks = sized.groupBy("c").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("bigint").alias("blocks"))
    member = sized.join(blocks, "c").withColumn("block", F.pmod(F.xxhash64("x", "c"), F.col("blocks")))
    cells = member.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).select(
        "c", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "x", "cls")
    cells = materialize(cells, "cell-members").join(sets.withColumnRenamed("doc_id", "x"), "x")
    more = cells.groupBy("c", "i", "j").applyInPandas(lambda cell: _cell_links(cell, threshold), "a bigint, b bigint")
    return materialize(links.unionByName(materialize(more, "cell-links")).distinct(), "links")


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, class_id (smallest id of its class), class_size, n_links, kept.

    Texts with the same words are one node, so copies are never expanded to
    pairs. Every alike pair that shares a band is in one class, or compared (:func:`_links`), without
    the pairs of a bucket whose members only share a template. Links are verified exactly; classes
    are their connected components; n_links counts verified links of the node.
    A text without a word (null, empty) is alone in its class. Rows that share an
    id are one document, compared by its greatest text. Null ids get a row of their own without a class. An empty
    table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = materialize(map_by_id(base, _sketch, "words bigint, bands array<bigint>"), "sketches")
    named = sketch.where("doc_id IS NOT NULL AND words != 0")
    # one node per word sequence: the band keys are part of the key, so two hashes would have to collide at once
    nodes = materialize(named.groupBy("words", "bands").agg(F.min("doc_id").alias("node")), "nodes")
    member_of = materialize(named.join(nodes, ["words", "bands"]).groupBy("doc_id").agg(F.min("node").alias("node")), "node-members")

    entries = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = entries.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = materialize(entries.join(shared, ["band", "key"]).withColumnRenamed("node", "x"), "bucket-members")
    # a sort-merge join at any size, so that small and large inputs run by one plan
    candidates = buckets.select(F.col("x").alias("doc_id")).distinct().hint("merge")
    wanted = base.where("doc_id IS NOT NULL").join(candidates, "doc_id", "left_semi")
    sets = materialize(wanted.groupBy("doc_id").agg(F.max("text").alias("text")).mapInPandas(_sets, "doc_id bigint, shingles binary"), "shingle-sets")
    links = _links(buckets, sets, threshold)

    classes = materialize(components(links), "classes").withColumnRenamed("component", "cls")
    degree = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).groupBy("node").agg(
        F.count("*").alias("n_links"))
    nodes_out = nodes.select("node").distinct().join(classes, "node", "left").join(degree, "node", "left").select(
        "node", F.coalesce("cls", "node").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    placed = materialize(member_of.join(nodes_out, "node").select("doc_id", "class_id", "n_links"), "placed")
    placed = placed.join(materialize(placed.groupBy("class_id").agg(F.count("*").alias("class_size")), "class-sizes"), "class_id")
    out = sketch.select("doc_id").join(placed, "doc_id", "left")
    cls = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", cls.alias("class_id"), F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"),
                      F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                      F.coalesce(F.col("doc_id") == cls, F.lit(True)).alias("kept"))
