"""Secrets by fixed patterns and by dictionary-primed zstandard novelty (operator 12).

The patterns give the base spans. A further string is a secret if it stands in a
sensitive context and zstandard cannot express it by what surrounds it: its
marginal compressed bytes are measured with a raw dictionary of the identifiers
that documents share and of the text on both sides, so names, paths and words
that the code around it uses cost next to nothing and a random string its length.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import map_by_id

KINDS = ("assign", "access", "hex")
NOVEL = len(KINDS)  # the kind of what the method adds
NAMES = (*KINDS, "novel")
Span = tuple[int, int, int]  # start, kind, end (code points, end exclusive)

# fixed values: the base patterns and their least lengths
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")  # of lowered text
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: A text without so long a run needs no list of its short ones.
_LONG_HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST_HEX}}}")

#: What makes the words before a candidate a sensitive context (fixed values).
_SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase)|pwd|secret|token|api[\x20_-]?key|access[\x20_-]?key|private[\x20_-]?key|credential|"
    r"auth|bearer|signature|signing|session|cookie|salt|-----begin")  # of lowered text
#: A text without any of these has no sensitive word.
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "sign", "session", "cookie", "salt", "-----begin")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=~-]+")
#: A candidate has so many characters, a letter and a digit, and a sensitive word at most so many characters before it.
LEAST, REACH = 12, 64
#: Text on each side that primes the dictionary.
AROUND = 2048
#: Compressed bytes a byte that make a candidate novel: strings without a known part take about 1, long hexadecimal ones 0.75.
NOVELTY = 0.7
#: Size of the identifier dictionary, a parameter of the method as any zstandard dictionary's.
DICTIONARY_BYTES = 32 * 1024
#: Parts of identifiers: words of a camelCase or snake_case name. Random strings rarely hold one that documents share.
_PART = re.compile(r"[A-Z]?[a-z]{3,15}|[A-Z]{4,16}")
#: The slow levels find matches of three bytes. A raw dictionary has eight bytes at least.
LEVEL, LEAST_PRIMER, LEAD = 19, 8, 64


def lowered(text: str) -> str:
    """Lower case at the same places; the two letters whose lower case would change places or become ASCII are blotted out."""
    for odd in ("\u0130", "\u212a"):
        if odd in text:
            text = text.replace(odd, "\ufffd")
    return text.lower()


def base_spans(text: str, low: str | None = None) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind; ``low`` is the text ``lowered``, if at hand."""
    out: list[Span] = []
    low = lowered(text) if low is None else low
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(low) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if _LONG_HEX.search(text):
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(out)


def named(spans: list[Span]) -> str:
    return ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in sorted(spans))


def parts(text: str) -> list[str]:
    """The parts of identifiers and words in a text, in lower case."""
    return [p.lower() for p in _PART.findall(text)]


def marginal_bytes(candidate: bytes, primer: bytes) -> int:
    """Bytes that ``candidate`` adds to the zstandard frame of the primer's end, whose raw dictionary is ``primer``.

    The end alone compresses to a reference; with it in front the frame is always
    a compressed one, so each part of the candidate that the primer knows shows in its size.
    """
    given = {}
    if len(primer) >= LEAST_PRIMER:
        given["dict_data"] = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False, **given)
    lead = primer[-LEAD:]
    return len(packer.compress(lead + candidate)) - len(packer.compress(lead))


def candidates(text: str, base: list[Span], low: str | None = None) -> Iterator[tuple[int, int]]:
    """Strings of a letter and a digit at least that touch no base span, after a sensitive word in reach."""
    low = lowered(text) if low is None else low
    if not any(hint in low for hint in _HINTS):
        return
    taken = sorted((a, b) for a, _, b in base)
    reach, at = -1, 0
    for word in _SENSITIVE.finditer(low):
        end = word.end() + REACH
        for m in _CANDIDATE.finditer(text, max(reach, word.start())):
            if m.start() > end:
                break
            reach = m.end()
            body = m.group()
            # a key may be glued to its word by = or :, the string is what follows
            start = m.start() + (body.rstrip("=").rfind("=") + 1)
            body = body[start - m.start():]
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at < len(taken) and taken[at][0] < m.end():
                continue
            if "@" in (text[start - 1:start], text[m.end():m.end() + 1]):  # an address
                continue
            if start >= word.end() and len(body) >= LEAST and re.search("[0-9]", body) and re.search("[A-Za-z]", body):
                yield start, m.end()


def novelty(text: str, start: int, end: int, identifiers: bytes) -> float:
    """Marginal compressed bytes a byte of text[start:end] against the identifiers and the text on both sides, without case."""
    body = text[start:end].lower().encode()
    around = (text[max(0, start - AROUND):start] + "\n" + text[end:end + AROUND]).lower().encode()
    return marginal_bytes(body, identifiers + around.replace(body, b" ")) / len(body)  # a string used twice is no less novel


def novel_spans(text: str, base: list[Span], identifiers: bytes, low: str | None = None) -> list[Span]:
    return [(a, NOVEL, b) for a, b in candidates(text, base, low) if novelty(text, a, b, identifiers) >= NOVELTY]


def identifier_dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_BYTES) -> bytes:
    """The parts of identifiers that most documents use, the most used last (nearest to what is compressed).

    Document frequencies are counted over all documents and whole texts, each batch's
    counts summed before the shuffle; only ``size`` bytes of the most used, met in two
    documents at least, reach the driver: they are the dictionary. Ties go by the part itself.
    """
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            met = Counter()
            for text in pdf["text"]:
                met.update(set(parts(text)))
            yield pd.DataFrame(met.items(), columns=["part", "n"])

    texts = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    counts = texts.mapInPandas(count, "part string, n bigint").groupBy("part").agg(F.sum("n").alias("n")).where("n > 1")
    # no part has fewer than three letters and a space, so no more can fit
    top = counts.orderBy(F.desc("n"), "part").limit(size // 4).collect()
    held, used = [], 0
    for r in top:
        used += len(r["part"]) + 1
        if used > size:
            break
        held.append(r["part"])
    return " ".join(reversed(held)).encode()


def find(docs: DataFrame, identifiers: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel.

    Counts and ``base_sha256`` are of the base spans; ``spans`` also holds the novel ones,
    which never overlap a base span. Whole texts; no shuffle. A null text counts as empty: no spans,
    the digest of the empty string. A null id is handed on, repeated rows each get
    their row, an empty table gives none; other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                low = lowered(text)
                spans = base_spans(text, low)
                more = novel_spans(text, spans, identifiers, low)
                n = [sum(k == i for _, k, _ in spans) for i in range(NOVEL)]
                rows.append((*n, hashlib.sha256(named(spans).encode()).hexdigest(), named(spans + more), len(more)))
            out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_novel"])
            out.insert(0, "doc_id", pdf["doc_id"].values)
            yield out

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_by_id(base, run, f"{counts}, base_sha256 string, spans string, n_novel bigint")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``find`` with the identifier dictionary of the same documents."""
    return find(docs, identifier_dictionary(docs))
