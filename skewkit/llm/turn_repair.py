"""Conversation repair by Knuth's lightest derivations (operator 13).

Rows of a conversation are in order of turn, role and text (nulls first). Repairs are derivations of a weighted
hypergraph: the item (i, state) says that the first i rows have been repaired to a
prefix of ``(s?(ua)+)?`` that ends in ``state``; a hyperedge combines it with row i's
facts (keep, rerole, delete) or with nothing (insert). Weights are (cost, audit),
compared in this order; an edge adds to the cost and appends to the audit, which is
monotone and superior, so an agenda that pops the lightest item first finalises
each item with its cheapest edits, of equally cheap ones the ASCII-least.
Two audits of one item never are prefixes of each other at equal cost: both edit the
same rows, so the longer one has more inserts.

How it is spread: everything about rows (damage, order, first occurrences, faults)
is grouped and sorted by Spark with no task per conversation; the agenda runs over
pieces of at most ``PIECE`` rows, from each state a piece can be entered in;
a conversation then only chains its pieces' few weights, and its
texts stream once through the digest.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import global_rank
from skewkit.session import materialize

#: Rows that one agenda sees.
PIECE = 256
#: States: nothing yet, after a leading system row, after a user row, after an assistant row.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
#: The only role initial that may be written in a state, and the state after an initial.
WRITES = ("u", "u", "a", "u")
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What a state still has to insert at the end.
CLOSING = ("", "ua", "a", "")
#: White space and ends of sentences (fixed values).
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"

Weight = tuple[int, str]  # cost, audit
Fact = tuple[str, str, int]  # role initial, state of the first row ("." fine, "t" truncated, "d" to be deleted), equal rows


def edges(state: int, fact: Fact) -> Iterator[tuple[int, int, str]]:
    """(next state, cost, letters) of each edit of equal rows side by side; all but the first are duplicates."""
    initial, fault, n = fact
    yield state, DELETE * n, "D" * n
    if fault == "d":
        return
    kept = TRUNCATED * (fault == "t") + DELETE * (n - 1)
    rest = "D" * (n - 1)
    role = WRITES[state]
    if initial == role or initial == "s" and state == START:
        yield AFTER[initial], kept, "K" + rest
    yield AFTER[role], REROLE + kept, "R" + rest


def lightest(facts: list[Fact], entered: int) -> dict[int, Weight]:
    """The lightest weight of each state after all rows, from one state before them.

    Inserts stand before a row of the piece; those after its last row are the next piece's.
    """
    n = len(facts)
    done: dict[tuple[int, int], Weight] = {}
    goals: dict[int, Weight] = {}
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, entered)]
    while agenda and len(goals) < len(STATES):
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in done:
            continue
        done[i, state] = cost, audit
        if i == n:
            goals[state] = cost, audit
            continue
        for after, more, letters in edges(state, facts[i]):
            if (i + 1, after) not in done:
                heapq.heappush(agenda, (cost + more, audit + letters, i + 1, after))
        after = AFTER[WRITES[state]]
        if (i, after) not in done:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, after))
    return goals


def chain(pieces: list[dict[int, dict[int, Weight]]]) -> list[tuple[int, str]]:
    """Per piece the state it is entered in and its audit, for the lightest derivation of the whole.

    What the rest costs is known from behind; so forwards, among the ends of a piece
    that keep the total least, its audit alone decides: audits from one state are of the
    same rows and end with a row's edit, so none is a prefix of another.
    """
    rest = [{q: INSERT * len(CLOSING[q]) for q in STATES}]
    for piece in reversed(pieces):
        after = rest[-1]
        rest.append({q: min(cost + after[end] for end, (cost, _) in piece[q].items()) for q in STATES})
    state, out = START, []
    for piece, after, least in zip(pieces, reversed(rest[:-1]), reversed(rest[1:]), strict=True):
        audit, end = min((audit, end) for end, (cost, audit) in piece[state].items() if cost + after[end] == least[state])
        out.append((state, audit))
        state = end
    out.append((state, "I" * len(CLOSING[state])))
    return out


def replay(facts: list[Fact], state: int, audit: str) -> list[tuple[str, str]]:
    """Per row the initials inserted before it, and its own new initial ("" if it goes, "=" if it is kept as it is)."""
    out, at = [], 0
    for _, _, n in facts:
        before = ""
        while audit[at] == "I":
            before += WRITES[state]
            state = AFTER[WRITES[state]]
            at += 1
        edit = audit[at]
        at += n
        if edit == "D":
            out.append((before, ""))
            continue
        own = facts[len(out)][0] if edit == "K" else WRITES[state]
        out.append((before, "=" if edit == "K" else own))
        state = AFTER[own]
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of the rows that are left after a fixture's damage, by crc32 of `conv_id:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user. Nulls read as one space.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def ordered_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows in order (conv_id, turn, role, text, n, rank) and their facts (conv_id, turn, n, rank, fault, initial).

    Equal rows are one row with its number n. ``rank`` is the place among all rows by conversation, turn, role and
    text (nulls first). The first of equal rows is a duplicate if an earlier turn has its role and text, which
    is a join on unique keys: with the least turn of each role and text.
    """
    merged = materialize(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n")), "turns")
    ranked = global_rank(merged, ["conv_id", "turn", "role", "text"], "turns-ranked")
    digest = F.sha2(F.col("text").cast("binary"), 256)
    first = merged.groupBy("conv_id", "role", digest.alias("digest")).agg(
        F.min(F.struct(F.col("turn").alias("turn"))).alias("at")).select(
        F.col("conv_id").alias("_conv"), F.col("at.turn").alias("_turn"), F.col("role").alias("_role"),
        F.col("digest").alias("_digest"), F.lit(True).alias("_first"))
    key = ranked.select("conv_id", "turn", "role", "n", "rank", digest.alias("digest"),
                        F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1)).alias("last"))
    fault = (F.when(F.col("last") == "", "blank").when(F.col("_first").isNull(), "duplicate")
             .when(~F.col("last").isin(*ENDS), "truncated").otherwise(""))
    facts = key.join(first, key["conv_id"].eqNullSafe(first["_conv"]) & key["turn"].eqNullSafe(first["_turn"])
                     & (key["role"] == first["_role"]) & (key["digest"] == first["_digest"]), "left").select(
        "conv_id", "turn", "n", "rank", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"))
    return ranked, materialize(facts, "turn-facts")


def _as_text(df: DataFrame) -> DataFrame:
    """The conversation's id as a string: pandas turns integers beside a null into doubles."""
    return df.withColumn("conv_id", F.col("conv_id").cast("string"))


def _pieces(facts: DataFrame, piece: int) -> DataFrame:
    """conv_id, piece, rows (rank, initial, fault letter, n; in order) and the lightest weights from and to each state.

    A piece holds rows of one conversation whose ranks fall into one block, so at most ``piece``.
    """
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    fault = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", "t").otherwise(".")
    held = facts.groupBy("conv_id", F.expr(f"rank div {piece}").alias("piece")).agg(F.sort_array(F.collect_list(
        F.struct("rank", initial.alias("initial"), fault.alias("fault"), "n"))).alias("rows"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = []
            for rows in pdf["rows"]:
                facts = [(r["initial"], r["fault"], int(r["n"])) for r in rows]
                found.append([{"entered": q, "left": end, "cost": cost, "audit": audit}
                              for q in STATES for end, (cost, audit) in lightest(facts, q).items()])
            yield pdf.assign(weights=found)

    row = "array<struct<rank:bigint,initial:string,fault:string,n:bigint>>"
    weights = "array<struct<entered:int,left:int,cost:bigint,audit:string>>"
    return materialize(_as_text(held).mapInPandas(run, f"conv_id string, piece bigint, rows {row}, weights {weights}"), "turn-pieces")


def _by_conversation(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, Iterator]]:
    """Rows of one conversation after the other, across batches; the input is sorted by conversation."""
    rows = (r for pdf in frames for r in pdf.itertuples(index=False))
    return groupby(rows, key=lambda r: None if pd.isna(r.conv_id) else r.conv_id)


def _frames(rows: Iterable[tuple], columns: list[str], size: int = 2048) -> Iterator[pd.DataFrame]:
    rows = iter(rows)
    while held := list(islice(rows, size)):
        yield pd.DataFrame(held, columns=columns, dtype=object)


def _derive(conv: str | None, pieces: list) -> Iterator[tuple]:
    """Rows of ``_derivations`` of one conversation."""
    tables, facts = [], []
    for piece in pieces:
        table: dict[int, dict[int, Weight]] = {q: {} for q in STATES}
        for w in piece.weights:
            table[w["entered"]][w["left"]] = int(w["cost"]), w["audit"]
        tables.append(table)
        facts.append([(x["initial"], x["fault"], int(x["n"])) for x in piece.rows])
    steps = chain(tables)
    closing = CLOSING[steps[-1][0]]
    cost, illegal, last = INSERT * len(closing), 0, ""
    for i, (piece, held, (state, audit)) in enumerate(zip(pieces, facts, steps[:-1], strict=True)):
        cost += tables[i][state][steps[i + 1][0]][0]
        edits = replay(held, state, audit)
        for j, (x, (initial, _, n), (before, own)) in enumerate(zip(piece.rows, held, edits, strict=True)):
            illegal += n - 1 + (last != "" and last + initial not in ("su", "ua", "au"))
            last = initial
            after = closing if i == len(pieces) - 1 and j == len(held) - 1 else ""
            if before or own or after:
                yield conv, int(x["rank"]), before, own, after, None, None, None
    yield conv, None, None, None, None, cost, illegal, "".join(audit for _, audit in steps)


def _derivations(pieces: DataFrame) -> DataFrame:
    """Per conversation its cost, illegal neighbours and audit (rank null); per row that stays or has inserts beside it, its edits.

    A conversation's pieces pass one task: some twenty bytes a row, a few times its audit, which is one value of the result.
    """
    columns = ["conv_id", "rank", "before", "own", "after", "cost", "illegal", "audit"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _frames((out for conv, rows in _by_conversation(frames) for out in _derive(conv, list(rows))), columns)

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return materialize(ordered.mapInPandas(run, "conv_id string, rank bigint, before string, own string, after string, "
                                                "cost bigint, illegal bigint, audit string"), "turn-derivations")


def _turns(ranked: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, rank, turns: what each row contributes to the repaired conversation, as role and text."""
    def inserted(initials: str):
        return F.transform(F.filter(F.split(initials, ""), lambda x: x != ""), lambda x: F.struct(
            F.when(x == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))

    role = F.when(F.col("own") == "=", F.col("role")).when(F.col("own") == "u", "user").otherwise("assistant")
    own = F.filter(F.array(F.struct(role.alias("role"), F.col("text").alias("text"))), lambda _: F.col("own") != "")
    texts = ranked.select("conv_id", "rank", "role", "text")
    return texts.join(edits.select("rank", "before", "own", "after"), "rank").select(
        "conv_id", "rank", F.concat(inserted("before"), own, inserted("after")).alias("turns"))


def digests(turns: DataFrame) -> DataFrame:
    """conv_id (string), repaired_sha256: the digest of `role:text` joined by newlines; texts stream through in order."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def hashed():
            for conv, rows in _by_conversation(frames):
                digest, first = hashlib.sha256(), True
                for r in rows:
                    digest.update(r.lines.encode() if first else b"\n" + r.lines.encode())
                    first = False
                yield conv, digest.hexdigest()
        return _frames(hashed(), ["conv_id", "repaired_sha256"])

    lines = F.array_join(F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["text"])), "\n")
    ordered = _as_text(turns.select("conv_id", "rank", lines.alias("lines"))).repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "rank").select("conv_id", "lines").mapInPandas(
        run, "conv_id string, repaired_sha256 string")


@dataclass(frozen=True)
class Repair:
    """``summary``: per conversation its faults, cost, audit and digest; ``turns``: conv_id, rank, turns (role, text) in order of rank."""

    summary: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, conversations: DataFrame | None = None, piece: int = PIECE) -> Repair:
    """The cheapest repair of each conversation of ``rows`` (conv_id, turn, role, text, copies; role and text not null).

    ``conversations`` lists further conv_ids, which have no rows: zeros, an empty audit, the digest of an empty string. A null
    conv_id is a conversation of its own; null turns come first and count for no gap; an empty table gives an
    empty result; other columns are ignored.
    """
    ranked, facts = ordered_rows(rows)
    found = _derivations(_pieces(facts, piece))
    turns = _turns(ranked, found.where("rank IS NOT NULL"))
    n, fault = F.col("n"), F.col("fault")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    counts = facts.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        total(F.when(fault == "blank", n)).alias("blank"),
        total(F.when(fault == "duplicate", n).when(fault != "blank", n - 1)).alias("duplicate"),
        total(F.when(fault == "truncated", 1)).alias("truncated"))
    ids = rows.select("conv_id") if conversations is None else conversations.select("conv_id").unionAll(rows.select("conv_id"))
    parts = [_as_text(counts), found.where("rank IS NULL").select("conv_id", "illegal", "cost", "audit"), digests(turns)]
    out = ids.distinct().withColumn("_id", F.col("conv_id").cast("string"))
    for i, part in enumerate(parts):
        part = part.withColumnRenamed("conv_id", f"_id{i}")
        out = out.join(part, out["_id"].eqNullSafe(part[f"_id{i}"]), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return Repair(out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                             F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")), turns)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The summary of repairing ``conversations`` after the fixture's damage, one row per original conv_id."""
    return repair(damage(conversations), conversations).summary
