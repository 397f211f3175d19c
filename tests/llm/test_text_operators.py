"""Operators that work on one text at a time, against brute force and on edge cases."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from edge_cases import edge_docs, no_docs, shipped  # noqa: F401
from skewkit.llm import bpe, edit_counts, langid, mixing, personal_data
from skewkit.llm.common import documents

RAW = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def _base_by_patterns(text):
    out = []
    for k, p in enumerate(RAW):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (k == 1 and any(int(x) > 255 for x in m.group().split(".")) or k == 3 and not 8 <= len(digits) <= 15
                    or k == 2 and not (16 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0)):
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_language_mixture_is_accurate_on_held_out_documents(spark):
    d = documents(spark, SF_ORACLE)
    got = langid.identify_documents(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97
    assert got.where("score < 0 OR score > 1").count() == 0


def test_mixture_finds_both_languages():
    rng = np.random.default_rng(0)
    p = np.zeros((langid.BUCKETS, 3))
    for k in range(3):
        p[:, k] = rng.random(langid.BUCKETS) ** 6
    p /= p.sum(axis=0)
    counts = np.bincount(np.concatenate([rng.choice(langid.BUCKETS, 4000, p=p[:, 0]), rng.choice(langid.BUCKETS, 2000, p=p[:, 2])]),
                         minlength=langid.BUCKETS)
    pi = langid.infer(counts, langid.Model(("a", "b", "c"), p))
    assert pi[1] == 0 and abs(pi[0] - 2 / 3) < 0.05 and abs(pi.sum() - 1) < 1e-9


def test_language_edge_cases(edge_docs, no_docs):
    got = {r["doc_id"]: r for r in langid.identify_documents(edge_docs).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (5, 6, 7, 8))
    assert got[1]["lang_pred"] in ("en", "de")
    assert langid.identify_documents(edge_docs).count() == edge_docs.count()
    assert langid.identify_documents(no_docs).count() == 0


def test_bpe_equals_library_and_round_trips(spark, edge_docs, no_docs):
    enc = bpe.encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in edge_docs.collect()}
    rows = bpe.encode_documents(edge_docs).collect()
    assert len(rows) == edge_docs.count() and bpe.encode_documents(no_docs).count() == 0
    for r in rows:
        if r["doc_id"] is None:
            continue
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_segments_do_not_change_the_ids():
    random.seed(3)
    enc = bpe.encoding()
    for _ in range(300):
        text = "".join(random.choice(" ab\n\t'sé1,.中🙂 ") for _ in range(random.randint(0, 400)))
        parts = list(bpe.segments(text, 20))
        assert "".join(parts) == text
        ids = [i for p in parts for i in enc.encode_ordinary(p)]
        assert ids == enc.encode_ordinary(text) == bpe._by_match(enc, text)
        assert bpe.decode(ids, enc) == text.encode()


def test_token_tree_equals_full_count_after_every_edit():
    random.seed(1)
    enc, letters = bpe.encoding(), "ab cd  \n\n'sé12,.! the"
    for _ in range(60):
        text = "".join(random.choice(letters) for _ in range(random.choice([0, 1, 5, 100, 3000, 9000])))
        tree = edit_counts.TokenTree(text, enc)
        for _ in range(10):
            a = random.randint(0, len(text) + 2)
            b = a + random.choice([0, 1, 5, 50, 2000])
            new = "".join(random.choice(letters) for _ in range(random.choice([0, 1, 2, 30, 3000])))
            tree.edit(a, b, new)
            a, b = min(a, len(text)), min(max(b, a), len(text))
            text = text[:a] + new + text[max(a, b):]
            assert tree.text() == text and tree.total == len(enc.encode_ordinary(text))


def test_edit_counts_edge_cases(spark, edge_docs, no_docs):
    got = edit_counts.count_edited(edge_docs, edit_counts.own_edits())
    assert got.count() == edge_docs.count() and edit_counts.count_edited(no_docs, edit_counts.own_edits()).count() == 0
    long = got.where("doc_id = 4").first()
    assert long["n_edits"] == 4 and long["n_reencoded"] < long["n_leaves"] / 4
    edits = spark.createDataFrame([(9, 2, 0, 4, "drei"), (9, 1, 4, 4, " und")], "doc_id bigint, seq int, start int, end int, text string")
    with_edits = edit_counts.attach_edits(edge_docs.select("doc_id", "text"), edits)
    r = edit_counts.count_edited(with_edits, F.col("edits")).where("doc_id = 9").first()
    assert r["n_tokens_edited"] == len(bpe.encode("drei und zwei")) and r["n_chars_edited"] == 13
    assert edit_counts.count_edited(with_edits, F.col("edits")).where("doc_id = 10").first()["n_edits"] == 0


def test_base_spans_equal_the_patterns(spark):
    random.seed(5)
    for _ in range(4000):
        text = "".join(random.choice("0123456789.@+- ()aZ_,555é") for _ in range(random.randint(1, 60)))
        assert personal_data.base_spans(text) == _base_by_patterns(text), text
    for r in documents(spark, SF_ORACLE).select("text").collect():
        assert personal_data.base_spans(r["text"]) == _base_by_patterns(r["text"])
    assert personal_data.base_spans("9" * 200_000 + "@" + "a" * 200_000) == []  # in linear time


def test_units_equal_a_search_from_every_character_and_take_linear_time():
    plain = re.compile(r"\+?\(?[0-9][0-9()\x20.-]*[0-9](?![A-Za-z0-9@_])|[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]*"
                       r"|(?<![A-Za-z0-9._%+-])[A-Za-z._%+-]*[0-9][A-Za-z0-9._%+-]*")
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choice("ab1 2+(.@%-)\n") for _ in range(rng.randint(0, 30)))
        want = [m.span() for m in plain.finditer(text)]
        assert [(a, b) for a, b, _ in personal_data.units(text, [])] == want, text
    for unit in ("x", "a+", "-", "1 ", "x1"):
        text = "mail a@b.com " + unit * (2_000_000 // len(unit)) + " end"
        begin = time.monotonic()
        personal_data.units(text, personal_data.base_spans(text))
        assert time.monotonic() - begin < 30


def test_field_carries_labels_over_skip_edges_only():
    field = personal_data.Field(np.zeros((personal_data.FEATURES, 5)), np.zeros((5, 5)))
    text = ("call +1 (583) 555-8469, later 1.583.555.8469; card 4012429011158754, not 9777946427004852 nor 9777946427004852, "
            "7536784127813050 4012429011158754")
    base = personal_data.base_spans(text)
    added = [(personal_data.KINDS[k], text[a:b]) for k, a, b in personal_data.added_spans(text, base, field)]
    assert ("phone", "1.583.555.8469") in added and ("card", "4012429011158754") in added
    assert not any("9777946427004852" in s or "7536784127813050" in s for _, s in added)
    assert personal_data.added_spans("plain 1234567890123456 text", [], field) == []


def test_every_mention_is_one_hop_from_a_labelled_one():
    field = personal_data.Field(np.zeros((personal_data.FEATURES, 5)), np.zeros((5, 5)))
    for times in (5, 20, 40, 400):
        for text in (" and ".join(["+1 (583) 555-8469"] + ["1.583.555.8469"] * times), " and ".join(["1.583.555.8469"] * times + ["+1 (583) 555-8469"])):
            base = personal_data.base_spans(text)
            assert len(base) == 1 and len(personal_data.added_spans(text, base, field)) == times
    text = "+1 (583) 555-8469 " + " or ".join(["9777946427004852"] * 40)  # repeated, but nothing labelled to agree with
    assert personal_data.added_spans(text, personal_data.base_spans(text), field) == []


def test_beliefs_equal_enumerated_marginals():
    """Exact on documents whose edges have no loop; the same decisions on small ones with loops."""
    rng = np.random.default_rng(6)
    phones = ["+1 (583) 555-8469", "1.583.555.8469", "583 555 8469", "anna.berg@mail.org", "anna.berg@", "7536784127813050", "10.0.0.1"]
    loops = trees = 0
    for _ in range(60):
        weights = rng.normal(0, 0.7, (personal_data.FEATURES, 5))
        weights[:, 4] += 0.5
        field = personal_data.Field(weights, np.clip(rng.normal(0, 0.5, (5, 5)), -1, 1))
        text = rng.choice([" see ", " " + "x" * 50 + " "]).join(rng.choice(phones, rng.integers(2, 6)))
        found = personal_data.units(text, personal_data.base_spans(text))
        unary, edges, potentials = personal_data.potentials_of(text, found, field)
        n = len(found)
        if not n:
            continue
        weight = {}
        for labels in itertools.product(range(5), repeat=n):
            score = sum(unary[i, k] for i, k in enumerate(labels))
            weight[labels] = np.exp(score + sum(psi[labels[i], labels[j]] for (i, j), psi in zip(edges, potentials, strict=True)))
        exact = np.array([[sum(w for ls, w in weight.items() if ls[i] == k) for k in range(5)] for i in range(n)]) / sum(weight.values())
        got = personal_data.beliefs(text, found, field)
        joined = list(range(n))
        tree = True
        for i, j in edges:
            a, b = joined[i], joined[j]
            tree &= a != b
            joined = [a if x == b else x for x in joined]
        trees, loops = trees + tree, loops + (not tree)
        if tree:
            assert np.abs(got - exact).max() < 5e-3
        sure = exact.max(axis=1) > 0.75
        assert (got.argmax(axis=1) == exact.argmax(axis=1))[sure].all()
    assert trees > 5 and loops > 5


def test_personal_data_edge_cases(edge_docs, no_docs):
    got = personal_data.find_personal_data(edge_docs)
    assert got.count() == edge_docs.count() and personal_data.find_personal_data(no_docs).count() == 0
    r = got.where("doc_id = 5").first()
    assert r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["n_email"] == 0


def test_mix_reaches_targets_and_agrees(edge_docs, no_docs, spark):
    once, again = (sorted(map(tuple, mixing.mix(documents(spark, SF_ORACLE)).collect()), key=str) for _ in range(2))
    assert once == again
    rows = mixing.mix(documents(spark, SF_ORACLE)).join(documents(spark, SF_ORACLE).select("doc_id", "source"), "doc_id")
    for r in rows.groupBy("source").agg(F.sum("taken").alias("k"), F.first("target").alias("t"), F.first("source_size").alias("s")).collect():
        assert abs(r["k"] - r["t"]) <= 0.05 * r["t"] and r["t"] <= 2 * r["s"]
    assert rows.where("taken > 2 * size").count() == 0
    assert mixing.mix(edge_docs).count() == edge_docs.count() and mixing.mix(no_docs).count() == 0
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix(edge_docs).collect()}
    assert sizes[5] == sizes[6] == sizes[7] == 0 and sizes[13] == 5000


def test_boundary_text_is_taken_when_it_ends_nearer(spark):
    """Sources of one or few long texts: independent of the SQL, the taken words end near the target."""
    rows = [(1, "w " * 1000, "a"), (2, "w " * 100, "b"), (3, "w " * 800, "b"), (4, "w " * 3000, "c"), (5, None, None)]
    rows += [(10 + i, "w " * (37 + i % 50), "d") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for budget in (0.7, 1.5):
        got = mixing.mix(docs, budget=budget).join(docs.select("doc_id", "source"), "doc_id").collect()
        for source in "abcd":
            mine = [r for r in got if r["source"] == source]
            taken, target = sum(r["taken"] for r in mine), mine[0]["target"]
            spare = [r["size"] for r in mine if r["copies"] <= target / r["source_size"]]  # no further copy drawn
            assert all(r["taken"] <= 2 * r["size"] for r in mine)
            assert taken - target <= max(r["size"] for r in mine) / 2
            assert taken >= target or not spare or target - taken <= min(spare) / 2 or source == "d" and target - taken <= 0.05 * target
    one = spark.createDataFrame([(1, "w " * 1000, "a")], "doc_id bigint, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(one, budget=0.95).collect()] == [(950.0, 1000)]
    assert [(r["target"], r["taken"]) for r in mixing.mix(one, budget=0.4).collect()] == [(400.0, 0)]


def test_word_size_counts_what_the_pattern_matches(spark):
    text = "a b c\x0bd\x0ce\r\nf g\x1fh  "
    df = spark.createDataFrame([(text,)], "text string").select(mixing.word_count(F.col("text")))
    assert df.first()[0] == len(regex.findall(r"[^\x20\x09-\x0D]+", text))


@pytest.mark.parametrize("weight", ["1.0", "1.0 + doc_id % 3"])
def test_unequal_weights_keep_the_targets(spark, weight):
    d = documents(spark, SF_ORACLE)
    rows = mixing.mix(d, weight=F.expr(weight)).join(d.select("doc_id", "source"), "doc_id")
    totals = rows.groupBy("source").agg(F.sum("taken").alias("k"), F.first("target").alias("t"), F.max("size").alias("longest"))
    for r in totals.collect():  # a boundary text may pass the target by less than half of its size
        assert r["k"] <= r["t"] + r["longest"] / 2 and r["k"] >= 0.8 * r["t"]
