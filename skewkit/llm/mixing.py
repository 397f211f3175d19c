"""Mixing sources to target weights by Pareto order sampling (operator 5).

Every source gets a word target. Its documents first get their certain whole
copies; the rest of the target is a fixed-size sample without replacement:
documents are ranked by the odds of a repeatable random number over the odds of
their inclusion, and the first ones that fill the remaining words are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skewkit.llm.common import global_rank
from skewkit.session import materialize

#: Code points other than space, tab and line breaks make words.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, BUDGET, MAX_COPIES = (5, 2, 1), 1.5, 2
#: After the boundary, the gap is filled this often with the next documents in order that still fit; then the first one
#: in order that ends nearer to the target than the gap leaves it is taken too.
FILLS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(id_col: str, seed: str) -> Column:
    """A repeatable number in (0, 1) from the id: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, n_docs, target: one row per source (null is a source, last in order).

    Targets are weight shares of ``budget`` times all words; what a source can't
    hold (``max_copies`` times its size) is reshared by weight among the others
    until none is above. Each round reads two sums of the table of sources.
    """
    t = materialize(sizes.groupBy("source").agg(
        F.sum("size").cast("bigint").alias("source_size"), F.count("*").alias("n_docs")), "source-sizes")
    t = global_rank(t.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "source-rank").drop("_last")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = t.withColumn("weight", w)
    cap = F.col("source_size") * F.lit(float(max_copies))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        before = level
        full = cap <= F.col("weight") * F.lit(level)
        capped, open_weight = t.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if open_weight:
            level = (budget * total - (capped or 0.0)) / open_weight
    return t.select("source", "source_size", "n_docs",
                    F.least(cap, F.col("weight") * F.lit(level)).cast("double").alias("target"))


def _prefix(df: DataFrame, order: list[str]) -> DataFrame:
    w = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cum", F.sum("size").over(w))


def mix(docs: DataFrame, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weight: Column | None = None, weights: tuple[float, ...] = WEIGHTS,
        budget: float = BUDGET, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies, taken.

    ``weight`` makes inclusion unequal inside a source (expected copies are in
    proportion to it); without it they are the source's target over its size.
    A source passes its target by less than half of the one boundary text that ends nearer to it so. A null or blank text has size 0 and takes 0 words; a null source is a source.
    Ties in the order (repeated ids) are broken by size. Reruns agree, since the
    random numbers are digests of the ids. An empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"),
                       (F.lit(1.0) if weight is None else weight.cast("double")).alias("w"))
    base = materialize(base.withColumn("u", uniform("doc_id", seed))
                       .withColumn("row", F.monotonically_increasing_id()), "sizes")
    targets = source_targets(base, weights, budget, max_copies)
    if weight is None:
        scale = targets.withColumn("rate_unit", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")))
    else:
        spread = base.groupBy("source").agg(F.sum(F.col("w") * F.col("size")).alias("ws"))
        scale = targets.join(spread, targets["source"].eqNullSafe(spread["source"])).drop(spread["source"]) \
            .withColumn("rate_unit", F.when(F.col("ws") > 0, F.col("target") / F.col("ws")))
    scale = materialize(scale, "targets")
    d = base.join(scale.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rate = F.when(F.col("size") > 0, F.least(F.col("w") * F.col("rate_unit"), F.lit(float(max_copies)))).otherwise(0.0)
    d = (d.withColumn("rate", F.coalesce(rate, F.lit(0.0))).withColumn("whole", F.floor("rate").cast("bigint"))
         .withColumn("p", F.col("rate") - F.col("whole"))
         .withColumn("q", F.when((F.col("p") > 0) & (F.col("size") > 0),
                                 (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))))
    # sqrt(n) bins follow the order of q, so neither the bins of a source nor the rows of its boundary bin are many;
    # q scaled by the odds of the source's own rate is uniform where rates are equal
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    share = share - F.floor(share)
    odds = F.col("q") * F.when((share > 0) & (share < 1), share / (1 - share)).otherwise(1.0)
    d = d.withColumn("bin", F.floor(odds / (1 + odds) * F.ceil(F.sqrt("n_docs"))).cast("bigint"))
    d = materialize(d, "ranked")

    certain = d.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    left = materialize(targets.select("source", "target").withColumnRenamed("source", "_s").join(
        certain, F.col("_s").eqNullSafe(F.col("source"))).select("source", (F.col("target") - F.col("certain")).alias("left")),
        "left")

    def gaps(todo: DataFrame, step: str) -> DataFrame:
        """Per source: the first bin not taken whole, and the words that were left before it."""
        bins = materialize(todo.groupBy("source", "bin").agg(F.sum("size").alias("size")), f"bins-{step}")
        cum = _prefix(bins, ["bin"]).join(left.withColumnRenamed("source", "_s"),
                                          F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
        return materialize(cum.where(F.col("cum") > F.col("left")).groupBy("source", "left").agg(
            F.min(F.struct("bin", (F.col("cum") - F.col("size")).alias("before"))).alias("at"))
            .select("source", F.col("at.bin").alias("edge"), (F.col("left") - F.col("at.before")).alias("room"), "left"),
            f"edge-{step}")

    open_rows = d.where(F.col("q").isNotNull()).select("source", "bin", "q", "doc_id", "size", "row")
    picked: list[DataFrame] = []
    for step in range(FILLS + 1):
        edge = gaps(open_rows, str(step))
        e = edge.withColumnRenamed("source", "_s")
        on = F.col("source").eqNullSafe(F.col("_s"))
        at_edge = open_rows.join(e, on & (F.col("bin") == F.col("edge")))
        cut = _prefix(at_edge, ["q", "doc_id", "size", "row"]).where(F.col("cum") <= F.col("room"))
        edge_rows = materialize(cut.select("source", "bin", "q", "doc_id", "size", "row"), f"edge-rows-{step}")
        # a source without an edge is taken whole; else the bins before it, and the rows of the edge that fit
        before = open_rows.join(e, on, "left").where(F.col("edge").isNull() | (F.col("bin") < F.col("edge")))
        took = before.select("source", "size", "row").unionByName(edge_rows.select("source", "size", "row"))
        took = materialize(took, f"took-{step}")
        picked.append(took)
        used = took.groupBy("source").agg(F.sum("size").alias("used"))
        left = materialize(left.withColumnRenamed("source", "_s").join(used, on, "left").select(
            F.col("_s").alias("source"), (F.col("left") - F.coalesce("used", F.lit(0))).alias("left")), f"left-{step}")
        if step == FILLS:
            break
        gap = left.withColumnRenamed("source", "_s")
        open_rows = materialize(
            open_rows.join(gap, on).where(F.col("size") <= F.col("left")).drop("_s", "left")
            .join(took.select("row"), "row", "left_anti"), f"open-{step}")
    extra = picked[0]
    for p in picked[1:]:
        extra = extra.unionByName(p)
    gap = left.withColumnRenamed("source", "_s")
    over = (d.where(F.col("q").isNotNull()).select("source", "q", "doc_id", "size", "row")
            .join(gap, F.col("source").eqNullSafe(F.col("_s"))).where(F.col("size") < 2 * F.col("left"))
            .join(extra.select("row"), "row", "left_anti"))
    nearer = over.groupBy("source").agg(F.min(F.struct("q", "doc_id", "size", "row")).alias("at"))
    extra = extra.unionByName(nearer.select("source", "at.size", "at.row"))
    out = d.join(extra.select("row", F.lit(1).alias("one_more")), "row", "left")
    copies = F.col("whole") + F.coalesce("one_more", F.lit(0))
    return out.select("doc_id", "size", "source_size", "target", copies.cast("bigint").alias("copies"),
                      (copies * F.col("size")).cast("bigint").alias("taken"))
