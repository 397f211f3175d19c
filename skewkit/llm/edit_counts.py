"""Edit-aware token counts with a segment tree of pre-tokens per document (operator 7).

The leaves of a document's tree are runs of whole pre-tokens, cut where the
pre-splitting pattern always ends a match; inner nodes sum characters and
tokens. An edit re-encodes the leaves it touches and one neighbour on either side,
so that no cut stands next to changed text, and updates the sums above them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewkit.llm.bpe import encode, encoding, segments
from skewkit.llm.common import map_by_id

#: Characters of a leaf, about; a leaf of more than SPLIT times as many is cut again.
LEAF, SPLIT = 512, 4
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


class TokenTree:
    """Token counts of a text under edits; ``total`` always equals the count of the whole current text."""

    def __init__(self, text: str, enc: tiktoken.Encoding):
        self.enc = enc
        self.encoded = 0
        self._build(list(segments(text, LEAF)))

    def _count(self, piece: str) -> int:
        self.encoded += 1
        return len(encode(piece, self.enc)) if piece else 0

    def _build(self, leaves: list[str], counts: list[int] | None = None) -> None:
        self.leaves = leaves
        self.size = 1 << max(0, (len(leaves) - 1).bit_length())
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, piece in enumerate(leaves):
            self.chars[self.size + i] = len(piece)
            self.tokens[self.size + i] = counts[i] if counts else self._count(piece)
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def __len__(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last filled one for the end) and its place inside."""
        node = 1
        while node < self.size:
            node *= 2
            if at >= self.chars[node] and self.chars[node + 1]:
                at -= self.chars[node]
                node += 1
        return node - self.size, at

    def _neighbour(self, leaf: int, step: int) -> int:
        """The next leaf that way with text enough to keep its own cut; the end of the text otherwise."""
        i = leaf + step
        while 0 <= i < len(self.leaves) and len(self.leaves[i]) < 2:
            i += step
        return min(max(i, 0), len(self.leaves) - 1)

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace the characters [start, end) by ``text``; positions past the end count as the end."""
        start = min(max(start, 0), len(self))
        end = min(max(end, start), len(self))
        first, a = self._find(start)
        last, b = self._find(end)
        lo, hi = self._neighbour(first, -1), self._neighbour(last, 1)
        head = "".join(self.leaves[lo:first]) + self.leaves[first][:a]
        region = head + text + self.leaves[last][b:] + "".join(self.leaves[last + 1:hi + 1])
        pieces, slots = list(segments(region, LEAF)), hi - lo + 1
        if len(pieces) > slots and (len(pieces) - slots > slots * SPLIT or len(region) > slots * SPLIT * LEAF):
            counts = [self.tokens[self.size + i] for i in range(len(self.leaves))]
            new = [self._count(p) for p in pieces]
            self._build(self.leaves[:lo] + pieces + self.leaves[hi + 1:], counts[:lo] + new + counts[hi + 1:])
            return
        pieces = pieces[:slots - 1] + ["".join(pieces[slots - 1:])] + [""] * (slots - len(pieces))
        for i, piece in zip(range(lo, hi + 1), pieces, strict=False):
            if piece != self.leaves[i]:
                self.leaves[i] = piece
                self.chars[self.size + i], self.tokens[self.size + i] = len(piece), self._count(piece)
                node = (self.size + i) // 2
                while node:
                    self._sum(node)
                    node //= 2


def count_edited(docs: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_edits, n_tokens_edited, n_chars_edited, n_leaves, n_reencoded.

    ``edits`` is an array of (start, end, text) in code points, applied in order, each to
    the text that the one before has left; positions past the end count as the end,
    null replacements as empty. A null text counts as empty, null edits as none.
    Whole texts; no shuffle; repeated rows give repeated rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       edits.cast(EDITS).alias("edits"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding()
        for pdf in frames:
            rows = []
            for text, todo in zip(pdf["text"], pdf["edits"], strict=True):
                tree = TokenTree(text, enc)
                before, leaves, built, done = tree.total, len(tree.leaves), tree.encoded, 0
                for e in todo if todo is not None else ():
                    if e is not None:
                        tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                        done += 1
                rows.append((before, done, tree.total, len(tree), leaves, tree.encoded - built))
            out = pd.DataFrame(rows, columns=["n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "n_leaves", "n_reencoded"])
            out.insert(0, "doc_id", pdf["doc_id"].values)
            yield out

    return map_by_id(base, run, "n_tokens bigint, n_edits bigint, n_tokens_edited bigint, "
                                "n_chars_edited bigint, n_leaves bigint, n_reencoded bigint")


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with the edits of each document, from rows (doc_id, seq, start, end, text), as one array in order of seq."""
    per_doc = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(
        "seq", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "text"))).alias("_e"))
    per_doc = per_doc.select("doc_id", F.transform("_e", lambda e: F.struct(e["start"], e["end"], e["text"])).cast(EDITS).alias("edits"))
    return docs.drop("edits").join(per_doc, "doc_id", "left")


def own_edits() -> Column:
    """Edits that follow from a row alone: a replacement, a deletion, an insertion and an append, at places its id and length give."""
    size = F.char_length(F.coalesce("text", F.lit("")))

    def place(i: int) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(i)), size + 1).cast("bigint")

    def edit(start: Column, width: int, text: Column) -> Column:
        return F.struct(start.alias("start"), (start + width).alias("end"), F.coalesce(text, F.lit("")).alias("text"))

    return F.array(
        edit(place(1), 9, F.substring("text", 3, 14)), edit(place(2), 40, F.lit("")),
        edit(place(3), 0, F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit("\n"))),
        edit(size.cast("bigint"), 0, F.substring("text", 1, 25)))
