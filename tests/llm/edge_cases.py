import pytest

from skewkit.llm.common import ship

#: Names that operators use inside; as extra columns they must not disturb anything.
CLASHING = ("row", "size", "node", "key", "band", "score", "lang_pred", "kept", "text_sha256", "copies", "taken", "words",
            "rank", "label", "matches", "spans", "n_tokens", "class_id")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and blank texts, a very long text, repeated rows, copies, near copies, clashing columns."""
    words = [f"w{i * 7919 % 997}x" for i in range(30_000)]
    base = " ".join(words[:300])
    near = " ".join([*words[:150], "changed", *words[151:300]])
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, " ".join(words), "en", None),
        (5, None, "en", "a"), (6, "", None, "b"), (7, " \n\t ", "de", "b"), (8, "12 34 !!", "de", "c"),
        (9, "eins zwei", "de", "c"), (10, "eins zwei", "de", "c"), (11, "the one and only über text", None, None),
        (11, "the one and only über text", None, None), (None, "kein id hier", "de", "a"), (None, None, None, None),
        (12, "x" * 50_000, "en", "d"), (13, "ab " * 5_000, "en", "d"),
    ]
    full = [(*r, None if r[1] is None else len(r[1]), *["clash"] * len(CLASHING)) for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
