"""Operators that compare rows with each other, and the pipeline, against brute force and on edge cases."""

import collections
import hashlib
import random
import time

import numpy as np
import pytest

import corpus_pipeline
from conftest import SF_ORACLE, SF_SMALL
from edge_cases import edge_docs, no_docs, shipped  # noqa: F401
from skewkit.llm import (
    bpe, chaining, edit_counts, exact_dedup, langid, minhash, mixing, personal_data, queries, repeated_bytes, sorted_passes,
)
from skewkit.llm.common import documents, word_hashes
from skewkit.llm.components import components
from skewkit.llm.suffix_groups import suffix_array


def _texts(spark, base):
    return {r["doc_id"]: r["text"] for r in documents(spark, base).collect()}


def _roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_null_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    want = _roots({x for a, b in links if a is not None and a != b for x in (a, b)}, [(a, b) for a, b in links if a is not None])
    assert {r["node"]: r["component"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def test_suffix_array_equals_sorting():
    random.seed(2)
    for _ in range(2000):
        s = [random.randint(0, random.choice([0, 1, 3, 20])) for _ in range(random.randint(0, 40))]
        assert suffix_array(np.array(s, dtype=np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("hot_core", [1, repeated_bytes.HOT_CORE])
def test_repeated_bytes_equal_brute_force(spark, hot_core):
    texts = {k: t.encode() for k, t in _texts(spark, SF_SMALL).items()}
    seen = collections.Counter(b[i:i + 400] for b in texts.values() for i in range(len(b) - 399))
    got = {r["doc_id"]: r for r in repeated_bytes.remove_repeats(documents(spark, SF_SMALL), hot_core=hot_core).collect()}
    for k, b in texts.items():
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(g and not before for g, before in zip(gone, b"\0" + bytes(gone)))
        r = got[k]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), sum(gone), runs)
        listed = [tuple(map(int, x.split(":"))) for x in r["spans"].split(",") if x]
        assert {i for start, end in listed for i in range(start, end)} == {i for i, g in enumerate(gone) if g}
        assert len(listed) == runs and listed == sorted(listed)
        assert bytes(r["kept"]) == kept and r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_repeated_bytes_edge_cases(edge_docs, no_docs):
    got = repeated_bytes.remove_repeats(edge_docs).collect()
    assert len(got) == edge_docs.count() and repeated_bytes.remove_repeats(no_docs).count() == 0
    by = {r["doc_id"]: r for r in got}
    assert by[12]["n_removed"] == 50_000 and by[5]["n_bytes"] == 0  # a run of one letter repeats itself
    assert by[1]["n_removed"] == by[1]["n_bytes"] and by[9]["n_removed"] == 0


def test_passages_cover_every_repeated_run_of_fifty_words(spark):
    words = {k: word_hashes([t])[1] for k, t in _texts(spark, SF_ORACLE).items()}
    where = collections.defaultdict(set)
    for k, h in words.items():
        for i in range(len(h) - 49):
            where[h[i:i + 50].tobytes()].add(k)
    ranges = collections.defaultdict(list)
    for r in chaining.repeated_passages(documents(spark, SF_ORACLE)).collect():
        assert r["n_words"] >= 50 and r["identity"] >= chaining.IDENTITY and r["partner_id"] != r["doc_id"]
        ranges[r["doc_id"]].append((r["start_word"], r["end_word"]))
    for k, h in words.items():
        for i in range(len(h) - 49):
            if len(where[h[i:i + 50].tobytes()]) > 1:
                assert any(a <= i and i + 50 <= b for a, b in ranges[k]), (k, i)


def test_passages_of_frequent_lines_between_middle_documents(spark):
    """Every seed and line stands in many documents; only the order of five lines is shared by two of them."""
    rng = np.random.default_rng(7)
    lines = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(30)]
    texts = [[lines[k] for k in rng.integers(30, size=20)] for _ in range(400)]
    for _ in range(40):
        a, b = rng.choice(np.arange(50, 350), size=2, replace=False)
        i, j = rng.integers(16, size=2)
        texts[b][j:j + 5] = texts[a][i:i + 5]
    words = [" ".join(t).split() for t in texts]
    rows = [(d, " ".join(w)) for d, w in enumerate(words)]
    holders: dict = {}
    for d, w in enumerate(words):
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i:i + 50]), set()).add(d)
    covered: dict = {}
    for r in chaining.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect():
        covered.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    repeated = [(d, i) for d, w in enumerate(words) for i in range(len(w) - 49) if len(holders[tuple(w[i:i + 50])]) > 1]
    assert len(repeated) > 500
    assert [(d, i) for d, i in repeated if not any(s <= i and i + 50 <= e for s, e in covered.get(d, []))] == []


def test_chains_are_the_best_by_dynamic_programming():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = rng.integers(1, 14)
        a, b = rng.integers(0, 60, n) * 3, rng.integers(0, 60, n) * 3
        score = {}
        for x, y in sorted(set(zip(a.tolist(), b.tolist(), strict=True))):
            score[x, y] = chaining.WORTH + max([0.0] + [s - chaining.GAP * (x - p + y - q) for (p, q), s in score.items() if p < x and q < y])
        best = chaining.chains(a, b)[0]
        got = chaining.WORTH * len(best) - chaining.GAP * (best[-1][0] - best[0][0] + best[-1][1] - best[0][1])
        assert abs(got - max(score.values())) < 1e-9


def test_fuzzy_passage_in_other_texts(spark, edge_docs, no_docs):
    rng = random.Random(6)
    noise = [[f"n{k}q{rng.randrange(10**6)}" for _ in range(200)] for k in range(2)]
    shared = [f"s{rng.randrange(10**6)}" for _ in range(80)]
    changed = shared[:30] + ["odd"] + shared[31:55] + shared[56:]
    rows = [(1, " ".join(noise[0][:100] + shared + noise[0][100:])), (2, " ".join(noise[1][:40] + changed + noise[1][40:])),
            (3, " ".join(noise[1][:20])), (4, None)]
    got = {r["doc_id"]: r for r in chaining.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["start_word"], got[1]["end_word"]) == (100, 180) and (got[2]["start_word"], got[2]["end_word"]) == (40, 119)
    assert got[1]["is_first"] and not got[2]["is_first"]
    assert {r["doc_id"] for r in chaining.repeated_passages(edge_docs).collect()} >= {1, 2, 3, 4}
    assert chaining.repeated_passages(no_docs).count() == 0


def test_two_passages_around_other_words(spark):
    rng = random.Random(9)

    def some(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    first, second = some(60), some(60)
    rows = [(k, " ".join(some(90) + first + some(70) + second + some(30))) for k in (1, 2)]
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"], r["identity"]) for r in got} == {
        (k, *at, 1.0) for k in (1, 2) for at in ((90, 150), (220, 280))}


def test_pieces_of_a_chain_cover_all_equal_windows():
    rng = np.random.default_rng(12)
    for _ in range(400):
        common = rng.integers(0, 40, 500)  # chance matches in the gaps
        x, y = [], []
        for _ in range(int(rng.integers(2, 6))):
            same = rng.integers(10**3, 10**9, int(rng.integers(20, 90)))
            x += [rng.choice(common, int(rng.integers(0, 111))), same]
            y += [rng.choice(common, int(rng.integers(0, 111))), same]
        x, y = np.concatenate(x).astype("<u4"), np.concatenate(y).astype("<u4")
        _, hx, px = chaining.seeds([" ".join(map(str, x.tolist()))])
        _, hy, py = chaining.seeds([" ".join(map(str, y.tolist()))])
        at = {h: p for h, p in zip(hy.tolist(), py.tolist(), strict=True)}
        met = [(p, at[h]) for h, p in zip(hx.tolist(), px.tolist(), strict=True) if h in at]
        found = chaining.passages(x, y, *np.array(met, dtype=np.int64).reshape(-1, 2).T)
        assert all(min(e - s, u - t) >= 50 and share >= chaining.IDENTITY for s, e, t, u, share in found)
        windows = {y[j:j + 50].tobytes(): j for j in range(len(y) - 49)}
        for i in range(len(x) - 49):
            j = windows.get(x[i:i + 50].tobytes())
            assert j is None or any(s <= i and i + 50 <= e and t <= j and j + 50 <= u for s, e, t, u, _ in found), i


def test_near_duplicates_equal_brute_force(spark):
    texts = _texts(spark, SF_ORACLE)
    sets = {}
    for k, t in texts.items():
        _, s, n, _ = minhash.shingles([t])
        sets[k] = s, minhash.weights(n)
    having = collections.defaultdict(list)
    for k, (s, _) in sets.items():
        for x in s.tolist():
            having[x].append(k)
    pairs = {(a, b) for ks in having.values() for i, a in enumerate(ks) for b in ks[i + 1:]}
    near = [(a, b) for a, b in pairs if minhash.similarity(*sets[a], *sets[b]) >= 0.8]
    want = _roots(sets, near)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(spark, SF_ORACLE)).collect()}
    assert got == want


def test_near_duplicates_in_buckets_of_one_template(spark):
    rng = random.Random(3)
    template = [f"t{k}" for k in range(200)]

    def changed(words, n):
        out = list(words)
        for k in rng.sample(range(200), n):
            out[k] = f"c{rng.randrange(10**9)}"
        return out

    texts = {}
    for k in range(0, 400, 2):  # alike at about 0.74 with the others, and a partner a bit above 0.8
        words = changed(template, 3)
        texts[k], texts[k + 1] = " ".join(words), " ".join(changed(words, 4))
    doc, s, n, _ = minhash.shingles(list(texts.values()))
    sig = minhash.signatures(doc, s, minhash.weights(n), len(texts)).reshape(len(texts), minhash.BANDS, minhash.ROWS)
    sets = {k: (s[doc == k], minhash.weights(n[doc == k])) for k in texts}
    met = ((a, b) for a in texts for b in range(a + 1, len(texts)) if (sig[a] == sig[b]).all(axis=1).any())
    want = _roots(texts, [(a, b) for a, b in met if minhash.similarity(*sets[a], *sets[b]) >= 0.8])
    got = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == want


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    x = rng.integers(1, 2**63, 400, dtype=np.uint64)
    a, b = np.sort(x[:300]), np.sort(x[100:])
    wa, wb = rng.uniform(1, 4, 300), rng.uniform(1, 4, 300)
    exact = minhash.similarity(a, wa, b, wb)
    doc = np.repeat(np.arange(2), 300)
    hits = []
    for i in range(60):
        shift = minhash.mix64(np.concatenate((a, b)) + minhash.step(i + 1))
        s = minhash.signatures(doc, shift, np.concatenate((wa, wb)), 2)
        hits.append((s[0] == s[1]).mean())
    assert abs(np.mean(hits) - exact) < 0.03
    assert minhash.similarity(a, np.ones(300), b, np.ones(300)) == pytest.approx(200 / 400)


def test_near_duplicates_of_a_hub_and_edge_cases(spark, edge_docs, no_docs):
    rng = random.Random(9)
    hub = [f"h{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(0, " ".join(hub))]
    for i in range(1, 120):  # each copy differs from the original in its own words, so copies are further from each other
        w = list(hub)
        for j in rng.sample(range(400), 8):
            w[j] = f"e{i}x{j}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got.select("class_id").distinct().count() == 1 and got.where("kept").count() == 1
    edge = minhash.near_duplicates(edge_docs).collect()
    assert len(edge) == edge_docs.count() and minhash.near_duplicates(no_docs).count() == 0
    cls = {r["doc_id"]: r["class_id"] for r in edge}
    assert cls[1] == cls[2] == cls[3] == 1 and cls[9] == cls[10] == 9 and cls[5] == 5 and cls[6] == 6 and cls[None] is None


def test_exact_duplicates_edge_cases(edge_docs, no_docs):
    rows = exact_dedup.exact_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count() and exact_dedup.exact_duplicates(no_docs).count() == 0
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["keep_id"] == 2 and not by[1]["kept"] and by[2]["kept"] and by[2]["group_size"] == 2
    assert by[5]["keep_id"] == 6 and by[6]["group_size"] == 3  # two null texts and an empty one
    assert by[11]["group_size"] == 2 and by[5]["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_chunks_rebuild_the_text_and_follow_the_content():
    data = random.Random(3).randbytes(200_000)
    ends = exact_dedup.chunk_bounds(data)
    assert b"".join(exact_dedup._chunks(data)) == data and ends[-1] == len(data)
    shifted = exact_dedup.chunk_bounds(b"prefix" + data)
    assert len({e + 6 for e in ends} & set(shifted)) > len(ends) // 2
    assert exact_dedup.chunk_bounds(b"") == [0] and max(np.diff([0, *exact_dedup.chunk_bounds(bytes(100_000))])) <= exact_dedup.MAX_CHUNK


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((150, 16))
    rows, vid = [], 0
    for c in centres:
        for _ in range(rng.integers(1, 5)):
            rows.append((vid, (c + rng.standard_normal(16) * rng.choice([0, 0.1, 0.25])).tolist(), int(rng.integers(0, 3))))
            vid += 1
    for v in (None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0] * 8, [1e-300] * 16):
        rows.append((vid, v, 1))
        vid += 1
    rows += [(vid, rows[0][1], None), (vid + 1, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    usable = [r for r in rows if sorted_passes._usable(r[1]) and r[2] is not None]
    unit = {r[0]: sorted_passes.unit_rows(np.array([r[1]], dtype=float))[0] for r in usable}
    pairs = [(a[0], b[0]) for i, a in enumerate(usable) for b in usable[i + 1:]
             if a[2] == b[2] and len(a[1]) == len(b[1]) and float((unit[a[0]] * unit[b[0]]).sum()) >= 0.93]
    want, degree = _roots([r[0] for r in rows], pairs), collections.Counter(x for p in pairs for x in p)
    got = sorted_passes.near_duplicate_vectors(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["component_id"], r["n_links"], r["kept"]) == (want[r["vec_id"]], degree[r["vec_id"]], r["vec_id"] == want[r["vec_id"]])
    assert sorted_passes.near_duplicate_vectors(df.limit(0)).count() == 0


def _all_pairs(rows, threshold=0.93):
    """(links, smallest reachable id) per row number of (vec_id, vector, label), by one whole matrix per label."""
    links, parent = [0] * len(rows), list(range(len(rows)))
    for label in {r[2] for r in rows}:
        at = np.array([i for i, r in enumerate(rows) if r[2] == label])
        unit = sorted_passes.unit_rows(np.array([rows[i][1] for i in at], dtype=float))
        near = unit @ unit.T >= threshold
        np.fill_diagonal(near, False)
        todo = np.ones(len(at), bool)
        for i in range(len(at)):
            links[at[i]] = int(near[i].sum())
            if todo[i]:
                front = reached = np.arange(len(at)) == i
                while front.any():
                    front = near[front].any(axis=0) & ~reached
                    reached = reached | front
                todo &= ~reached
                low = min(rows[at[k]][0] for k in np.flatnonzero(reached))
                for k in np.flatnonzero(reached):
                    parent[at[k]] = low
    return list(zip(links, parent, strict=True))


@pytest.mark.parametrize(("size", "window", "block"), [(3000, 256, 512), (6000, sorted_passes.WINDOW, sorted_passes.BLOCK_ROWS)])
def test_dense_labels_lose_no_link(spark, size, window, block):
    """One label of distinct close vectors, most of them linked with most others, beside one of far vectors."""
    rng = np.random.default_rng(size)
    centre = rng.standard_normal(32)
    dense = centre + rng.standard_normal((size, 32)) * 0.25
    rows = [(i, v.tolist(), "dense") for i, v in enumerate(dense)]
    rows += [(size + i, rng.standard_normal(32).tolist(), "far") for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string")
    rows = [(r[0], np.array(r[1], dtype=np.float32).astype(float), r[2]) for r in rows]
    want = _all_pairs(rows)
    assert 0.2 < sum(n for n, _ in want) / size**2 < 1
    got = {r["vec_id"]: (r["n_links"], r["component_id"])
           for r in sorted_passes.near_duplicate_vectors(df, window=window, block=block).collect()}
    assert got == {r[0]: w for r, w in zip(rows, want, strict=True)}


def test_repeated_null_and_clashing_columns_of_vectors(spark):
    a, b, far = [1.0, 0.0], [1.0, 0.1], [0.0, 1.0]
    rows = [(5, a, "x", 1, 1), (5, b, "x", 2, 1), (5, far, "x", 3, 1), (5, far, "x", 3, 1), (None, a, "x", 4, 1), (2, b, "y", 5, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string, n_links int, node int")
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"])
                 for r in sorted_passes.near_duplicate_vectors(df).collect())
    assert got == [(-1, 0, None, True), (2, 0, 2, True), *[(5, 1, 5, True)] * 4]


def test_projections_repeat_in_any_batch():
    v = sorted_passes.unit_rows(np.random.default_rng(1).standard_normal((500, 48)))
    whole = sorted_passes.prefixes(v, 3, 9)
    assert [int(sorted_passes.prefixes(v[i:i + 1], 3, 9)[0]) for i in range(500)] == whole.tolist()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_matches(spark, name):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    want = con.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("operator", [
    langid.identify_documents, bpe.encode_documents, repeated_bytes.remove_repeats, mixing.mix, personal_data.find_personal_data,
    lambda d: edit_counts.count_edited(d, edit_counts.own_edits()), exact_dedup.exact_duplicates, minhash.near_duplicates,
    lambda d: corpus_pipeline.keep_languages(d.sparkSession, d, SF_SMALL)],
    ids=["language", "bpe", "bytes", "mix", "personal", "edits", "exact", "minhash", "stage"])
def test_large_ids_beside_null_ids_keep_every_bit(spark, operator):
    top = 2**62
    rows = [(i, f"einige worte {i}", "de", None, top + 1) for i in (top + 1, None, top + 2, -top - 3)]
    docs = spark.createDataFrame([*rows, (None, "mehr", "de", "a", None)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)
    got = operator(docs)
    assert sorted(r["doc_id"] or 0 for r in got.select("doc_id").collect()) == [-top - 3, 0, 0, top + 1, top + 2]
    if "n_chars" in got.columns:
        assert {r["n_chars"] for r in got.select("n_chars").collect()} == {None, top + 1}


def test_pipeline_equals_brute_force(spark):
    """Stages of brute force: letters, last of equal texts, first of similar ones, the mix of what is left, library ids."""
    docs = documents(spark, SF_SMALL)
    texts = {k: t for k, t in _texts(spark, SF_SMALL).items() if any(c.isalpha() for c in t or "")}
    last = {t: k for k, t in sorted(texts.items())}
    kept = {k: t for t, k in last.items()}
    sets = {k: (s, minhash.weights(n)) for k, t in kept.items() for _, s, n, _ in [minhash.shingles([t])]}
    ids = sorted(kept)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
            if np.intersect1d(sets[a][0], sets[b][0]).size and minhash.similarity(*sets[a], *sets[b]) >= 0.8]
    roots = _roots(ids, near)
    left = [k for k in ids if roots[k] == k]
    mixed = mixing.mix(docs.where(docs["doc_id"].isin(left))).collect()
    want = sorted((r["doc_id"], len(bpe.encode(kept[r["doc_id"]])), hashlib.sha256(kept[r["doc_id"]].encode()).hexdigest())
                  for r in mixed for _ in range(r["copies"]))
    got = sorted((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == want


def test_pipeline_stages_on_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF_SMALL)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns and out.schema == docs.schema
            docs = corpus_pipeline.materialize(out, "stage")
    first = corpus_pipeline.keep_languages(spark, edge_docs, SF_SMALL)
    assert first.where("text IS NULL OR doc_id = 8").count() == 0 and {r["score"] for r in first.collect()} == {"clash"}


def test_stretches_are_aligned_and_extended_without_a_step_for_every_pair_of_words():
    def plain(x, y):
        row = [0] * (len(y) + 1)
        for w in x:
            last = 0
            for j, v in enumerate(y, 1):
                last, row[j] = row[j], last + 1 if w == v else max(row[j], row[j - 1])
        return row[-1]

    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 9, 60, 128):
        for words in (2, 7, 300):
            x, y = (rng.integers(0, words, n, dtype=np.uint32) for n in (size, int(rng.integers(0, 129))))
            assert chaining._equal_between(x, y) == plain(x.tolist(), y.tolist())
    x, y = np.arange(3000, dtype=np.uint32), rng.permutation(3000).astype(np.uint32)
    begin = time.process_time()
    assert chaining._equal_between(x, x[1:]) == 2999 and chaining._equal_between(x, y) >= 1
    assert time.process_time() - begin < 1  # 18 million steps otherwise
    x = rng.integers(0, 1 << 30, 5000, dtype=np.uint32)
    for breaks in ([], [0], [31], [32], [33, 2000], [127, 128, 160, 161, 4999]):
        y = x.copy()
        y[breaks] += 1
        runs = chaining._alike(x, y)
        assert sum(n for _, _, n in runs) == 5000 - len(breaks)
        assert all((x[i:i + n] == y[j:j + n]).all() for i, j, n in runs)
    assert chaining._alike(x, np.concatenate((x[:100], x[102:]))) == [(0, 0, 100), (102, 100, 4898)]
    assert chaining._alike(x[:3], x[:3]) == [(0, 0, 3)] and chaining._alike(x[:0], x) == []
