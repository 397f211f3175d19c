"""Language identification by multilingual mixture inference (operator 1).

A document is a mixture of languages. Expectation-maximisation estimates the
proportions from character n-gram likelihoods; the set of languages is the one
whose likelihood, less a penalty per language, is best.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skewkit.llm.common import mix64

#: n-grams of these lengths are hashed to so many buckets.
ORDERS, BUCKETS = (1, 2, 3), 1 << 15
#: The model is fitted on about this many documents of each language at most.
SAMPLE_DOCS = 3000
#: Penalty of one more language, in units of the log of the number of n-grams; n-grams overlap, so it is above one half.
PENALTY = 3.0
SMOOTHING, EM_STEPS, TOLERANCE = 0.5, 40, 1e-4
UNDETERMINED = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, itself if a letter, else 0."""
    points = np.arange(0x110000, dtype=np.uint32)
    return points * np.fromiter((not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of the lower-cased letters; runs of others are one blank. None without a letter."""
    if not text:
        return None
    c = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    if not c.any():
        return None
    c = np.concatenate(([0], c, [0])).astype(np.uint64)
    c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for n in ORDERS:
        if len(c) < n:
            continue
        m = len(c) - n + 1
        key = np.full(m, n, dtype=np.uint64)
        for i in range(n):
            key = key << np.uint64(21) | c[i:i + m]
        if n == 1:
            key = key[c != 0]
        counts += np.bincount((mix64(key) >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class Model:
    """Languages in order, and the probability of each bucket under each (buckets x languages)."""

    languages: tuple[str, ...]
    probability: np.ndarray


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """The n-gram model of (doc_id, text, lang) rows, from a hash sample of about ``sample_docs`` rows per language.

    What reaches the driver is the model: at most ``BUCKETS`` counts per language.
    """
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    n_docs = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(n_docs))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(1e6 * min(1.0, sample_docs / n_docs[lang])))])
    sample = labelled.where(spread < share[F.col("lang")]).select("lang", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for pdf in frames:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                if (c := ngram_counts(text)) is not None:
                    totals[lang] = totals.get(lang, 0) + c
        for lang, c in totals.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": c[at]})

    rows = sample.mapInPandas(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).collect()
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    at = {lang: i for i, lang in enumerate(languages)}
    for lang, bucket, n in rows:
        table[bucket, at[lang]] += n
    return Model(languages, table / table.sum(axis=0))


def mixture(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions by EM and their log-likelihood. p: probability of each n-gram by language; n: its count."""
    total, pi = n.sum(), np.full(p.shape[1], 1.0 / p.shape[1])
    for _ in range(EM_STEPS):
        new = pi * (p.T @ (n / (p @ pi))) / total
        moved, pi = np.abs(new - pi).max(), new
        if moved < TOLERANCE:
            break
    return pi, float(n @ np.log(p @ pi))


def infer(counts: np.ndarray, model: Model) -> np.ndarray:
    """The document's proportions over all languages; 0 for those outside the selected set.

    Backward selection: the smallest language goes while the penalised
    likelihood does not fall. No set can beat the best single language if even
    the likelihood of all of them lacks the price of a second one.
    """
    at = np.flatnonzero(counts)
    n, p = counts[at].astype(float), model.probability[at]
    price = PENALTY * np.log(n.sum() + 1)
    single = n @ np.log(p)
    best = np.zeros(p.shape[1])
    best[int(single.argmax())] = 1.0
    chosen = np.arange(p.shape[1])
    if len(chosen) < 2:
        return best
    pi, fit_all = mixture(p, n)
    value, top = fit_all - price * len(chosen), single.max() - price
    if fit_all - 2 * price <= top:
        return best
    while len(chosen) > 2:
        keep = np.delete(np.arange(len(chosen)), pi.argmin())
        fewer, fit_fewer = mixture(p[:, chosen[keep]], n)
        if fit_fewer - price * len(keep) < value:
            break
        chosen, pi, value = chosen[keep], fewer, fit_fewer - price * len(keep)
    if value > top:
        best[:] = 0.0
        best[chosen] = pi / pi.sum()
    return best


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every input row with lang_pred, score and proportions added (input columns of these names are replaced).

    ``lang_pred`` is the language with the largest proportion (ties: the first
    by name) and ``score`` that proportion. A null text, one without a letter,
    or a model without languages gives ``und`` with score 0. Whole texts are read;
    nothing but the text decides; no shuffle. Other columns pass through as they are,
    in Arrow batches, so that large integers beside nulls keep their values.
    """
    base = docs.drop("lang_pred", "score", "proportions")
    added = "lang_pred string, score double, proportions map<string,double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, shares = [], [], []
            for text in batch.column(text_col):
                counts = ngram_counts(text.as_py()) if model.languages else None
                pi = infer(counts, model) if counts is not None else np.zeros(0)
                best = int(pi.argmax()) if len(pi) else None
                langs.append(UNDETERMINED if best is None else model.languages[best])
                scores.append(0.0 if best is None else min(1.0, float(pi[best])))
                shares.append([(model.languages[i], float(pi[i])) for i in np.flatnonzero(pi)])
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                   pa.array(shares, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "lang_pred", "score", "proportions"])

    return base.mapInArrow(run, StructType([*base.schema.fields, *StructType.fromDDL(added).fields]))


def fit_documents(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of the rows of ``docs`` that are not held out and have a language."""
    return fit(docs.where(~held_out()).select("doc_id", "text", "lang"), sample_docs)


def identify_documents(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, proportions of every row, by a model fitted on the rows not held out."""
    return identify(docs.select("doc_id", "text"), fit_documents(docs, sample_docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "proportions")
