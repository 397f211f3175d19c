"""Byte-level BPE encoding and decoding with a local rank file (operator 3).

Long texts are encoded in segments cut only where the pre-splitting pattern
always ends a match, so the ids equal those of the whole text. Decoding joins
raw bytes, since one token may hold part of a character.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import map_by_id

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Texts above this many characters are encoded in segments of about this size.
SEGMENT = 1 << 16
#: A single space between two visible characters: every match ends before it and one begins at it, whatever stands around.
_SAFE = regex.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=4)
def encoding(ranks_file: str = RANKS, pattern: str | None = None) -> tiktoken.Encoding:
    """The tokenizer of a rank file (base64 token, space, rank per line); one per Python worker."""
    with open(public_tokenizers.path(ranks_file), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding(ranks_file, pat_str=pattern or public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """``text`` in pieces cut at safe boundaries; a stretch without one stays whole."""
    start = 0
    while len(text) - start > size:
        m = _SAFE.search(text, start + size)
        if not m:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def _by_match(enc: tiktoken.Encoding, text: str) -> list[int]:
    """Each match of the pattern by itself, for stretches on which the library's own splitter gives up."""
    return [i for m in regex.finditer(public_tokenizers.PATTERN, text)
            for i in enc._encode_single_piece(m.group().encode())]


def encode(text: str, enc: tiktoken.Encoding | None = None) -> list[int]:
    """Token ids of the whole text, without special tokens."""
    enc = enc or encoding()
    ids: list[int] = []
    for part in segments(text):
        try:
            ids += enc.encode_ordinary(part)
        except BaseException as e:  # the splitter's stack or backtracking limit surfaces as a Rust panic
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            ids += _by_match(enc, part)
    return ids


def decode(ids: list[int], enc: tiktoken.Encoding | None = None) -> bytes:
    """The raw bytes of the ids."""
    return (enc or encoding()).decode_bytes(ids)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids on request).

    A null text counts as empty: 0 tokens. No shuffle; repeated rows give repeated rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding()
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                ids = encode(text, enc)
                row = [len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                       hashlib.sha256(decode(ids, enc)).hexdigest()]
                rows.append([*row, ids] if keep_ids else row)
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)
            out.insert(0, "doc_id", pdf["doc_id"].values)
            yield out

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_by_id(base, run, added + (", ids array<int>" if keep_ids else ""))
