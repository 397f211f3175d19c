"""Near-duplicate embeddings by sorted projection passes (operator 8).

Each pass gives every vector a key of 64 random-hyperplane bits and orders the vectors
of a label by it. The neighbour window of a vector is the stretch of that order that shares
its leading bits; their number follows from the label's size, so that a window holds
about ``WINDOW`` vectors where keys are spread evenly. Where they are not, a window is longer:
it is cut into blocks, and every two blocks of it meet as one cell. A cell compares its vectors by
matrix products in double precision and hands on counts and a forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import global_rank
from skewkit.llm.components import components
from skewkit.session import materialize

COSINE = 0.93
#: Vectors that share their leading bits by the label's size; rows of a block, the unit of work; rows of one matrix product.
WINDOW, BLOCK_ROWS, TILE = 2048, 2048, 256
#: A pair at the threshold is missed with this probability at most; it sets the number of passes.
MISS = 1e-9
KEY_BITS = 64
#: Vectors and hyperplanes are rounded to these steps, so that projections are exact sums of integers and repeat in every task.
VECTOR_STEPS, PLANE_STEPS = 2.0**22, 2.0**10
SEED = 8


def agreement(cosine: float) -> float:
    """Probability that a random hyperplane does not separate two vectors of this cosine."""
    return 1.0 - math.acos(cosine) / math.pi


def window_bits(size: int, window: int = WINDOW) -> int:
    """Leading bits that cut ``size`` evenly spread vectors to windows: none where the label itself is one."""
    return max(0, math.ceil(math.log2(max(1.0, size / window))))


def passes_needed(bits: int, cosine: float = COSINE, miss: float = MISS) -> int:
    """Passes until a pair at the threshold shares its leading bits in one of them, but for the chance ``miss``."""
    if not bits:
        return 1
    together = agreement(cosine) ** bits
    return math.ceil(math.log(miss) / math.log1p(-together)) if together < 1 else 1


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, first by their largest component so that squares stay in range."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


@lru_cache(maxsize=512)
def _planes(dim: int, seed: int) -> np.ndarray:
    return np.rint(np.random.default_rng([SEED, seed, dim]).standard_normal((dim, KEY_BITS)) * PLANE_STEPS)


def _sides(unit: np.ndarray, seed: int, bits: int) -> np.ndarray:
    """Sides of the first ``bits`` hyperplanes of a pass, by sums that no order of addition changes."""
    return np.rint(unit * VECTOR_STEPS) @ _planes(unit.shape[1], seed)[:, :bits] >= 0


def prefixes(unit: np.ndarray, seed: int, bits: int) -> np.ndarray:
    """Leading bits of the keys of a pass as integers."""
    return _sides(unit, seed, bits) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _usable(v: list | np.ndarray | None) -> bool:
    if v is None or len(v) == 0:
        return False
    a = np.array([np.nan if x is None else x for x in v], dtype=float)
    return bool(np.isfinite(a).all() and a.any())


def _clean(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        ok = pdf["label"].notna() & pdf["embedding"].map(_usable)
        yield pdf[ok]


def _packed(v: np.ndarray) -> list[bytes]:
    """Rows as bytes, in single precision where that is exact."""
    with np.errstate(over="ignore"):
        single = v.astype("<f4")
    exact = (single == v).all(axis=1)
    return [s.tobytes() if e else d.tobytes() for s, d, e in zip(single, v.astype("<f8"), exact, strict=True)]


def _unpacked(raw: pd.Series, dim: int) -> np.ndarray:
    return np.array([np.frombuffer(r, dtype="<f4" if len(r) == 4 * dim else "<f8") for r in raw], dtype=float)


def _keys(threshold: float, window: int, passes: int | None):
    """Rows of every pass: the key in signed order, and its leading bits."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for (dim, size), rows in pdf.groupby(["dim", "size"]):
                unit, bits = unit_rows(_unpacked(rows["vector"], dim)), window_bits(size, window)
                for p in range(1, (passes or passes_needed(bits, threshold)) + 1):
                    key = np.packbits(_sides(unit, p, KEY_BITS), axis=1).view(">u8").astype(np.uint64)[:, 0]
                    lead = key >> np.uint64(KEY_BITS - bits) if bits else np.zeros(len(key), np.uint64)
                    # flipping the top bit makes signed order the order of the unsigned keys
                    yield pd.DataFrame({"pass": p, "label": rows["label"].values, "dim": dim, "bits": bits,
                                        "key": (key ^ np.uint64(1 << 63)).view(np.int64), "lead": lead.view(np.int64),
                                        "node": rows["node"].values})

    return run


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest row that the links reach, for every row."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, x, root[y])
        np.minimum.at(low, y, root[x])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _meet(rows: pd.DataFrame, left: np.ndarray, right: np.ndarray, threshold: float):
    """Links between rows ``left`` and ``right`` of one window that no earlier pass has met, as (x, y) row numbers, tile by tile."""
    p, dim, bits = (int(rows[c].iat[0]) for c in ("pass", "dim", "bits"))
    unit = unit_rows(_unpacked(rows["vector"], dim))
    earlier = [prefixes(unit, q, bits) for q in range(1, p)]
    same = left is right
    for at in range(0, len(left), TILE):
        u, v = np.nonzero(unit[left[at:at + TILE]] @ unit[right].T >= threshold)
        if same:
            later = v > u + at
            u, v = u[later], v[later]
        x, y = left[at + u], right[v]
        for lead in earlier:
            new = lead[x] != lead[y]
            x, y = x[new], y[new]
        yield x, y


def _cell(threshold: float):
    """Per cell and window: (a, null, n) counts the new links of a by the copies they reach; (a, b, 0) join what is linked."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        a, b, n = [], [], []
        for _, rows in pdf.groupby(["pass", "label", "dim", "lead"], sort=False):
            left = np.flatnonzero(rows["block"] == i)
            right = left if i == j else np.flatnonzero(rows["block"] == j)
            if len(left) == 0 or len(right) == 0 or len(rows) < 2:
                continue
            node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
            count, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
            for x, y in _meet(rows, left, right, threshold):
                np.add.at(count, x, copies[y])
                np.add.at(count, y, copies[x])
                rx, ry = root[x], root[y]
                other = rx != ry
                root = _roots(len(rows), rx[other], ry[other])[root]
            linked, joined = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(rows)))
            a += [node[linked], node[joined]]
            b += [np.full(len(linked), -1), node[root[joined]]]
            n += [count[linked], np.zeros(len(joined), np.int64)]
        a, b, n = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b, n))
        return pd.DataFrame({"a": a, "b": b, "n": n})

    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = COSINE, id_col: str = "vec_id",
                           vector_col: str = "embedding", label_col: str = "label",
                           passes: int | None = None, window: int = WINDOW, block: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and not null and their cosine in
    double precision reaches ``threshold``. Equal vectors of a label are one node
    that counts its copies, so they are never expanded to pairs. A label of at most ``window`` different vectors is
    compared whole, exactly; in a larger one a pair is missed with probability ``MISS`` at most. Null, empty, zero or
    non-finite vectors, null labels, null ids and vectors of different lengths link with nothing; such a row
    is its own component. Rows that repeat an id stay rows of their own: with equal vectors they are copies, with
    different ones each gets the links of its vector. Other columns are not read; an empty table gives an empty result.
    """
    base = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("embedding"),
                          F.col(label_col).cast("string").alias("label"))
    good = base.where("vec_id IS NOT NULL").mapInPandas(_clean, base.schema)
    # the written table fixes the node numbers
    nodes = materialize(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
                        .withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "vector-nodes")
    group = ["label", "dim"]
    sizes = nodes.groupBy(*group).agg(F.count("*").alias("size"))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            raw = pd.Series(index=pdf.index, dtype=object)
            for _, rows in pdf.groupby("dim"):
                raw[rows.index] = _packed(np.array(rows["embedding"].tolist(), dtype=float))
            yield pdf.assign(vector=raw)[["node", "label", "dim", "copies", "vector"]]

    packed = materialize(nodes.select("node", *group, "copies", "embedding").mapInPandas(
        pack, "node bigint, label string, dim int, copies bigint, vector binary"), "packed-vectors")
    order = ["pass", *group, "key", "node"]
    keyed = packed.join(sizes.where("size > 1"), group).select("node", *group, "size", "vector").mapInPandas(
        _keys(threshold, window, passes), "pass int, label string, dim int, bits int, key bigint, lead bigint, node bigint")
    ranked = global_rank(keyed, order, "pass-order").withColumn("block", F.floor(F.col("rank") / block).cast("bigint"))

    # a row meets every block of its window; both rows of a pair lie in exactly one cell of a pass
    stretch = ["pass", *group, "lead"]
    windows = materialize(ranked.groupBy(*stretch).agg(
        F.min("block").alias("first"), F.max("block").alias("last"), F.count("*").alias("n")).where("n > 1"), "windows")
    cells = ranked.join(windows, stretch).withColumn("other", F.explode(F.sequence("first", "last"))).select(
        *stretch, "bits", "node", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    met = materialize(cells.join(packed.select("node", "copies", "vector"), "node").groupBy("i", "j").applyInPandas(
        _cell(threshold), "a bigint, b bigint, n bigint"), "cell-links")

    linked = met.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    classes = components(met.where("b >= 0"))
    placed = materialize(nodes.join(linked, "node", "left").join(classes, "node", "left").select(
        "label", "embedding", "low", F.coalesce("component", "node").alias("class"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "placed-vectors")
    least = placed.groupBy("class").agg(F.min("low").alias("component_id"))
    named = materialize(placed.join(least, "class").drop("class", "low"), "vector-classes")
    out = base.join(named, ["label", "embedding"], "left")
    mine = F.col("vec_id").isNotNull()
    component = F.when(mine, F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.when(mine, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
