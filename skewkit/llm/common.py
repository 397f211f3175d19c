"""Helpers the operators of this subpackage share: table reads, vectorised byte hashing, distributed ranks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.session import materialize

U64 = np.uint64
#: Odd multipliers (fixed values of the splitmix64 finaliser and the golden ratio).
MIX1, MIX2, GOLDEN = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Spark's own file server hands out the archive; a package that is installed
    on the executors is not disturbed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_by_id(base: DataFrame, run: Callable, added: str) -> DataFrame:
    """``mapInPandas`` over rows with a doc_id, which ``run`` hands on beside the columns ``added``.

    A bigint id travels as a string: pandas turns integers next to a null into
    doubles, which round above 2**53.
    """
    id_type = base.schema["doc_id"].dataType.simpleString()
    if id_type != "bigint":
        return base.mapInPandas(run, f"doc_id {id_type}, {added}")
    out = base.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, f"doc_id string, {added}")
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers (splitmix64's finaliser)."""
    x = (x ^ (x >> U64(30))) * MIX1
    x = (x ^ (x >> U64(27))) * MIX2
    return x ^ (x >> U64(31))


def step(i: int) -> np.uint64:
    """The i-th multiple of the golden ratio, modulo 2**64."""
    return U64(i * int(GOLDEN) % (1 << 64))


def byte_table(seed: int) -> np.ndarray:
    """256 random 64-bit values, one per byte; ``seed`` picks the table."""
    return mix64(np.arange(1, 257, dtype=U64) * GOLDEN + U64(seed))


class RollingHash:
    """Polynomial hashes modulo 2**64 of any span of a byte array in O(1) per span.

    ``prefix`` holds the weighted prefix sums, so the hash of [i, j) is
    (prefix[j] - prefix[i]) * base**-i: all spans come from one cumulative sum.
    """

    def __init__(self, seed: int, base: int):
        self.table = byte_table(seed)
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = self._down = np.ones(1, dtype=U64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            size = 1 << max(12, int(n - 1).bit_length())
            up, down = np.full(size, self.base, dtype=U64), np.full(size, self.inverse, dtype=U64)
            up[0] = down[0] = 1
            self._up, self._down = np.cumprod(up), np.cumprod(down)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        return self.prefix_of(self.table[data])

    def prefix_of(self, values: np.ndarray) -> np.ndarray:
        """The prefix sums of 64-bit values in place of bytes."""
        n = len(values)
        self._powers(n + 1)
        out = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * self._up[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self._down[start]

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        n = len(prefix) - 1 - width + 1
        return (prefix[width:] - prefix[:n]) * self._down[:n] if n > 0 else np.zeros(0, dtype=U64)


_WORDS = RollingHash(10, 0x9E6F1C5B7A3D2E4F)
_WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of many texts in order: (text index, 64-bit hash, place in its text).

    Words are runs of lower-cased ASCII letters, digits and non-ASCII characters.
    """
    data = [(t or "").lower().encode() + b"\n" for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    buf = np.frombuffer(b"".join(data), dtype=np.uint8)
    edge = np.diff(np.concatenate(([0], _WORD_BYTE[buf].view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(np.cumsum(sizes), start, side="right")
    h = mix64(_WORDS.spans(_WORDS.prefix(buf), start, end) ^ ((end - start).astype(U64) * GOLDEN))
    first = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(data)))))[:-1]
    return doc, h, np.arange(len(h)) - first[doc]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, in a fixed number of passes (prefix and suffix minima of blocks)."""
    n = len(v) - width + 1
    pad = -len(v) % width
    blocks = np.concatenate((v, np.full(pad, np.iinfo(np.uint64).max, dtype=U64))).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def text_batches(texts: list[str | None], size: int) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``size`` characters, so that what is made from a batch stays small."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def global_rank(df: DataFrame, order: list[str], name: str, rank: str = "rank") -> DataFrame:
    """``df`` with its 0-based position under ``order``, by a range-partitioned sort.

    Only one number per partition reaches the driver (the partition's row
    count); no task sees more than its range. Give a unique last column, so a
    repeated key spreads over several ranges.
    """
    s = (df.repartitionByRange(*order).sortWithinPartitions(*order)
         .withColumn("_p", F.spark_partition_id())
         .withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    s = materialize(s, name)
    at, offsets = 0, []
    for p, n in sorted((r["_p"], r["count"]) for r in s.groupBy("_p").count().collect()):
        offsets.append((p, at))
        at += n
    spark = df.sparkSession
    off = spark.createDataFrame(offsets or [(0, 0)], "_p int, _o bigint")
    return s.join(F.broadcast(off), "_p").withColumn(rank, F.col("_o") + F.col("_i")).drop("_p", "_i", "_o")
