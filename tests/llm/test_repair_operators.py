"""Periodic runs, secrets and conversation repair against brute force and on edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from edge_cases import edge_docs, no_docs, shipped  # noqa: F401
from skewkit.llm import periodic_runs as runs
from skewkit.llm import queries, turn_repair
from skewkit.llm import secret_novelty as secrets
from skewkit.llm.common import documents


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# --- periodic runs ---

def all_runs(words):
    """Every lag, every maximal stretch along its diagonal, smallest periods by trial."""
    n, out = len(words), []
    codes = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // 3 + 1):
        same = np.concatenate(([0], (codes[q:] == codes[:-q]).astype(int), [0]))
        for i, j in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1), strict=True):
            length = int(j - i + q)
            if length >= max(24, 3 * q):
                w = codes[i:i + length]
                if not any((w[p:] == w[:-p]).all() for p in range(1, q)):
                    out.append((int(i), length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_all_lags():
    random.seed(5)
    seen = 0
    for _ in range(250):
        k, n, a = random.choice([1, 2, 3, 6]), random.randint(0, 260), []
        while len(a) < n:
            unit = [random.randrange(k) for _ in range(random.choice([1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 40]))]
            a += (unit * 6)[:random.randint(1, 5 * len(unit) + 10)] if random.random() < 0.6 else unit
        words = [f"w{x}" for x in a[:n]]
        expected = all_runs(words)
        seen += len(expected)
        assert runs.find_runs(runs.code_words([w.encode() for w in words])) == expected
    assert seen > 150


@pytest.mark.parametrize("minimum,exponent", [(9, 3), (24, 4), (30, 3)])
def test_runs_with_other_limits(minimum, exponent):
    random.seed(6)
    for _ in range(60):
        a = [random.randrange(2) for _ in range(150)]
        a[40:40] = ([random.randrange(9) for _ in range(random.randint(1, 20))] * 6)[:90]
        got = runs.find_runs(runs.code_words([b"%d" % x for x in a]), minimum, exponent)
        n, codes, want = len(a), np.array(a), []
        for q in range(1, n // exponent + 1):
            i = 0
            while i + q < n:
                j = i
                while j + q < n and codes[j] == codes[j + q]:
                    j += 1
                w = codes[i:j + q]
                if j > i and len(w) >= max(minimum, exponent * q) and not any((w[p:] == w[:-p]).all() for p in range(1, q)):
                    want.append((i, len(w), q))
                i = max(j, i + 1)
        assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_one_word_repeated_and_long_texts_take_linear_pairs():
    codes = np.zeros(400_000, np.int64)
    assert runs.find_runs(codes) == [(0, 400_000, 1)]
    unit = np.arange(60_000) % 59_999
    codes = np.tile(unit, 4)
    assert (0, 240_000, 60_000) in runs.find_runs(codes)


def test_fewer_periods_than_three_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(5, np.int64), 24, 2)


def expected_run_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = all_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return (len(found), *(best[:1] + best[1:] + (1000 * best[1] // best[2],) if best else (None,) * 4),
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


RUN_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_run_query_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r[c] for c in RUN_COLUMNS) for r in queries.op11_periodic_runs(spark, SF_ORACLE).collect()}
    docs = documents(spark, SF_ORACLE).select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = [r for r in docs if len(r["text"] or "") < 12_000]
    assert len(some) > 900 and sum(v[0] > 0 for v in got.values()) > 50
    for r in some:
        assert got[r["doc_id"]] == expected_run_row(r["doc_id"], r["text"]), r["doc_id"]


def test_run_edge_cases(edge_docs, no_docs):
    rows = runs.summarise(runs.periodic_runs(edge_docs, looped=True)).collect()
    assert len(rows) == edge_docs.count() and runs.summarise(runs.periodic_runs(no_docs)).count() == 0
    texts = defaultdict(list)
    for r in edge_docs.collect():
        texts[r["doc_id"]].append(r["text"])
    for r in rows:
        if r["doc_id"] == 4:  # thousands of words in a cycle: 30,000 words of period 997
            continue
        assert tuple(r[c] for c in RUN_COLUMNS) in [expected_run_row(r["doc_id"], t) for t in texts[r["doc_id"]]]
    plain = {r["doc_id"]: r for r in runs.periodic_runs(edge_docs).collect()}
    assert plain[4]["runs"] == [(0, 30_000, 997)] and len(plain[4]["collapsed"].split()) == 997
    assert plain[13]["collapsed"] == "ab"


def test_ids_of_other_types_are_read_as_decimals(spark):
    text = " ".join(f"w{i}" for i in range(300))
    looped = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = spark.createDataFrame([(looped, text), (None, text)], "doc_id int, text string")
    got = {r["doc_id"]: r["n_runs"] for r in runs.summarise(runs.periodic_runs(docs, looped=True)).collect()}
    assert got[looped] == expected_run_row(looped, text)[0] and got[None] == 0


# --- secrets ---

RAW_SECRETS = ((re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 8),
               (re.compile(r"AKIA[A-Z0-9]+"), 16), (re.compile(r"[0-9a-f]+"), 32))


def raw_spans(text):
    return sorted((m.start(), k, m.end()) for k, (p, least) in enumerate(RAW_SECRETS) for m in p.finditer(text)
                  if len(m.group(2) if k == 0 else m.group()) >= least)


def test_base_secrets_equal_the_patterns():
    random.seed(7)
    bits = ["password", "PassWd", "toKen", "toKen", "İ", "api_key", "apikey", "secret", ":", "=", "  ", '"', "'", "AKIA",
            "ABCDEFGH1234", "deadbeef01234567", "a", "é", "x.y-z", " ", "\n"]
    for _ in range(20_000):
        text = "".join(random.choice(bits) for _ in range(random.randint(1, 14)))
        assert secrets.base_spans(text) == raw_spans(text), text


def test_secret_query_base_equals_the_patterns(spark):
    got = {r["doc_id"]: r for r in queries.op12_secret_novelty(spark, SF_ORACLE).collect()}
    docs = documents(spark, SF_ORACLE).select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        base, r = raw_spans(d["text"] or ""), got[d["doc_id"]]
        names = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == sha(",".join(names))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("novel")] == names


def test_identifier_dictionary_equals_plain_counts(spark):
    docs = documents(spark, SF_ORACLE)
    met = Counter()
    for r in docs.select("text").collect():
        met.update({p.lower() for p in re.findall(r"[A-Z]?[a-z]{3,15}|[A-Z]{4,16}", r["text"] or "")})
    order = [p for p, n in sorted(met.items(), key=lambda x: (-x[1], x[0])) if n > 1]
    got = secrets.identifier_dictionary(docs, size=2000).decode().split()
    assert got == order[:len(got)][::-1] and 1900 < len(" ".join(got)) <= 2000


def test_random_strings_are_novel_and_known_names_are_not():
    random.seed(8)
    known = " ".join("session token database request handler connection server client value version config return".split()).encode()
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    for size, made in itertools.product((14, 20, 32, 48), range(30)):
        secret = "".join(random.choice(letters) for _ in range(size)) + "7f"
        text = f"the bearer value {secret} goes to connection.request_handler2 and sessionTokenDatabase1"
        spans = secrets.novel_spans(text, secrets.base_spans(text), known)
        assert [text[a:b] for a, _, b in spans] == [secret], (text, made)


def test_novelty_is_the_marginal_size_of_the_frame():
    text = "signing " + "Q7w9Zk31LmX0pTrs" + " then x"
    a, b = 8, 24
    primer = b"signing then words " + "signing \n then x".encode()
    packer = zstandard.ZstdCompressor(level=19, dict_data=zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                      write_checksum=False, write_content_size=False, write_dict_id=False)
    alone, lead = text[a:b].lower().encode(), primer[-64:]
    expected = (len(packer.compress(lead + alone)) - len(packer.compress(lead))) / 16
    assert secrets.novelty(text, a, b, b"signing then words ") == expected > 0.7


def test_novel_spans_need_context_and_avoid_base_spans():
    body = "Q7w9Zk31LmX0pTrs44"
    assert secrets.novel_spans(f"the word {body} here", [], b"") == []
    for text in (f"token = {body}", f"see token {body} twice {body}"):
        base = secrets.base_spans(text)
        novel = secrets.novel_spans(text, base, b"")
        assert all(x[2] <= y[0] or y[2] <= x[0] for x in base for y in novel)
    assert len(secrets.novel_spans(f"see token {body} twice {body}", [], b"")) == 2
    assert secrets.novel_spans("auth by mail4.example77.com@x and joe12345678901@mail.com", [], b"") == []


def test_secret_edge_cases(edge_docs, no_docs):
    rows = secrets.find_secrets(edge_docs).collect()
    assert len(rows) == edge_docs.count() and secrets.find_secrets(no_docs).count() == 0
    empty = [r for r in rows if r["doc_id"] in (5, 6)]
    assert all(r["base_sha256"] == sha("") and r["spans"] == "" and r["n_assign"] == 0 for r in empty)
    long = "token " * 40_000 + "password" * 20_000 + " " * 50_000 + "AKIA" * 30_000 + "ab" * 60_000
    assert secrets.base_spans(long) == raw_spans(long)
    assert secrets.novel_spans(long, secrets.base_spans(long), b"") == []


# --- conversation repair ---

def damaged_rows(rows):
    """By conversation: (turn, role, text) in order, after damage."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]  # noqa: B018 - the conversation is there even without rows
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def expected_repair(held):
    """A plain dynamic program over (rows, state) that keeps whole audits and whole repaired conversations."""
    seen, facts, faults = set(), [], Counter()
    for _, role, text in held:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        facts.append(fault)
    best = {"": (0, "", ())}  # role initials of the shape reached: "", "s", "u", "a"

    def insert(table):
        for _ in range(4):
            for q, (cost, audit, done) in list(table.items()):
                r = "a" if q == "u" else "u"
                new = (cost + 3, audit + "I", (*done, {"u": "user:", "a": "assistant:"}[r]))
                if r not in table or new[:2] < table[r][:2]:
                    table[r] = new
        return table

    for (_, role, text), fault in zip(held, facts, strict=True):
        insert(best)
        after = {}
        for q, (cost, audit, done) in best.items():
            choices = [(q, cost + 4, audit + "D", done)]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                want = "a" if q == "u" else "u"
                if role[:1] == want or role[:1] == "s" and q == "":
                    choices.append((role[:1], cost + more, audit + "K", (*done, f"{role}:{text}")))
                choices.append((want, cost + 3 + more, audit + "R", (*done, {"u": "user", "a": "assistant"}[want] + f":{text}")))
            for q2, *new in choices:
                if q2 not in after or tuple(new[:2]) < after[q2][:2]:
                    after[q2] = tuple(new)
        best = after
    insert(best)
    cost, audit, done = min(v for q, v in best.items() if q in ("", "a"))
    turns = {t for t, _, _ in held if t is not None}
    initials = [r[:1] for _, r, _ in held]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, sha("\n".join(done)))


REPAIR_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def same_repairs(df, rows):
    got = {r["conv_id"]: tuple(r[c] for c in REPAIR_COLUMNS) for r in df.collect()}
    want = {c: expected_repair(h) for c, h in damaged_rows(rows).items()}
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c
    return want


def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = same_repairs(queries.op13_turn_repair(spark, SF_ORACLE), rows)
    assert {"I", "D", "R", "K"} <= set("".join(w[6] for w in want.values()))


@pytest.mark.parametrize("piece", [1, 3, 256])
def test_lightest_derivations_equal_a_plain_program(piece):
    random.seed(9)
    for _ in range(400):
        facts = [(random.choice("suax"), random.choice("..td"), random.choice([1, 1, 1, 2, 3])) for _ in range(random.randint(0, 9))]
        tables = [{q: turn_repair.lightest(facts[i:i + piece], q) for q in turn_repair.STATES} for i in range(0, len(facts), piece)]
        steps = turn_repair.chain(tables)
        audit = "".join(a for _, a in steps)
        cost = sum(t[q][steps[i + 1][0]][0] for i, (t, (q, _)) in enumerate(zip(tables, steps[:-1], strict=True)))
        cost += 3 * len(turn_repair.CLOSING[steps[-1][0]])
        held, k = [], 0
        for initial, fault, n in facts:  # equal rows after the first are duplicates; texts tell the rest apart
            k += 1
            text = "" if fault == "d" else f"t{k}" + "." * (fault == ".")
            held += [(k, {"s": "system", "u": "user", "a": "assistant", "x": "tool"}[initial], text)] * n
        assert (cost, audit) == expected_repair(held)[5:7], facts


def test_repair_edge_cases(spark):
    long = " ".join(["word"] * 60_000) + "."
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, 0, "system", "Be."), (1, None, "tool", "x!"),
            (1, 5, "assistant", "A."), (1, 5, "assistant", "B?"), (1, 9, "user", long), (2, None, None, " "), (3, 1, "", "Empty role."),
            (4, 2, "user", "no end"), (4, 2, "user", "no end"), (4, 3, "user", "no end"), (5, 1, "system", "only."), (5, 1, "systemx", "é."),
            (2**60 + 1, 2**40, "assistant", " "), (2**60 + 1, None, "assistant", " ")]
    frame = spark.createDataFrame([(*r, "clash", 3) for r in rows], "conv_id bigint, turn bigint, role string, text string, rank string, n int")
    same_repairs(turn_repair.repair_damaged(frame), rows)
    assert turn_repair.repair_damaged(frame.limit(0)).count() == 0


def test_one_conversation_over_many_pieces_and_tasks(spark):
    random.seed(10)
    rows = [(7, random.randint(0, 3000), random.choice(["user", "assistant", "system", "tool"]),
             random.choice(["Yes.", "No", "", "Same text!", f"T{i}."])) for i in range(1500)]
    rows += [(8, 4, "user", "Equal.")] * 900 + [(9, i, "user", "Equal again.") for i in range(700)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    same_repairs(turn_repair.repair_damaged(frame), rows)
    fixed = turn_repair.repair(turn_repair.damage(frame)).turns.where("conv_id = 7").orderBy("rank").select(F.explode("turns").alias("t"))
    roles = "".join(r["t"]["role"][0] for r in fixed.collect())
    assert re.fullmatch("(s?(ua)+)?", roles) and len(roles) > 100
