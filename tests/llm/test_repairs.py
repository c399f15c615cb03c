"""Hard negatives, secret scans and repaired conversations, against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction
from math import floor, inf, isfinite, nan

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.llm import negatives, secret_scan, turns

# --- hard negatives


def mined(rows, every=10, positives=5, negatives=3):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), from all scores."""
    whole = [(i, v, label, [floor(256 * Fraction(float(np.float32(x)))) for x in vec]) for i, (v, vec, label) in enumerate(rows) if v is not None and label is not None and vec is not None and all(x is not None and isfinite(x) for x in vec)]
    whole = [r for r in whole if sum(x * x for x in r[3]) < 2**62]
    out = []
    for i, v, label, vec in whole:
        if v % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vec, w, strict=False)), u, k) for j, u, k, w in whole if j != i)
        for top, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(-s, u) for s, u, k in scored if k != label and 50 * -top <= 100 * -s <= 95 * -top]
            out += [(v, p, n + 1, u, -top, s) for n, (s, u) in enumerate(fit[:negatives])]
    return sorted(out)


def vectors(seed, n, dims=6, labels=3, groups=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return [(int(i), [float(np.float32(x)) for x in centres[i % groups] + rng.normal(size=dims) * 0.3], int(rng.integers(labels))) for i in range(n)]


ODD_VECTORS = [
    (None, [1.0] * 6, 1), (1000, None, 1), (1010, [1.0] * 6, None), (1020, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (1030, [nan] + [1.0] * 5, 1),
    (1040, [inf] + [1.0] * 5, 1), (1050, [], 1), (1060, [1.0, 2.0], 1), (1070, [1.0] * 9, 2), (1080, [0.0] * 6, 0), (1090, [1.0] * 6, 1), (1090, [1.0] * 6, 1),
    (1090, [1.0] * 6, 2), (1100, [-1.0] * 6, 0), (1110, [1e30] * 6, 0), (-20, [0.7] * 6, 2),
]
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("tile,block", [(2048, 32 << 20), (16, 3000)])
def test_mined_negatives_are_those_of_all_scores(spark, monkeypatch, tile, block):
    monkeypatch.setattr(negatives, "TILE", tile)
    rows = vectors(3, 200) + ODD_VECTORS
    frame = spark.createDataFrame(rows, VECTORS).withColumns({"rid": F.lit("x"), "score": F.lit(None), "d": F.lit(1)}).repartition(3)
    got = negatives.mine_negatives(frame, F.col("vec_id") % 10 == 0, block_bytes=block)
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice((-1, 1)) * (float(2**20) + rng.randrange(2**10)) for _ in range(6)], i % 2) for i in range(80)]
    got = negatives.mine_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0)
    want = mined(rows)
    assert max(r[4] for r in want) > 2**53 and sorted(map(tuple, got.collect())) == want


def test_nothing_to_mine(spark):
    for rows in ([], [(1, [1.0], 1)], [(10, [1.0], 1)]):
        assert negatives.mine_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0).collect() == []


def test_the_triangle_inequality_rules_rows_out():
    """Of clustered vectors most pairs need no exact score, and the brackets hold."""
    rng = np.random.default_rng(6)
    x = np.floor(256 * (rng.normal(size=(20, 16))[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 16)) * 0.05))
    norm2 = (x**2).sum(axis=1)
    top = norm2.max()
    last = negatives.lift(norm2, top)
    chosen = negatives.far_apart(x, last, 8)
    d = negatives.distances(x, last, x[chosen], last[chosen])
    anchors = negatives.Anchors(pa.table({"rid": np.arange(50), "label": np.zeros(50, int), "norm2": norm2[:50], "x": pa.array(list(x[:50]))}), x[chosen], last[chosen])
    low, high = negatives.brackets(anchors, np.arange(50), d, top)
    score = x[:50] @ x.T
    assert (low <= score).all() and (score <= high).all()
    fifth = np.partition(score, -5, axis=1)[:, -5]
    assert (high >= fifth[:, None]).mean() < 0.6
    assert (negatives.tile_reach(anchors, np.arange(50), d, top) >= high.max(axis=1) - 1e-3).all()


# --- secrets


def plain_spans(text, rules):
    found = []
    for n, rule in enumerate(rules):
        for m in rule.compiled().finditer(text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), n, m.end(), rule.kind))
    return [(k, a, b) for a, _, b, k in sorted(found)]


RULES = secret_scan.BASE + secret_scan.ADDED
SECRETS = [
    "password = hunter22", "PassWD:'abc123'", 'API_KEY="k/9+x_.="', "apikey: short", "token:token:abcdef", "secret == abcdefg", "ſecret=abcdefgh", "toKen=abcdefgh",
    "AKIA" + "A1" * 8, "AKIA" + "Z" * 15, "akia" + "A1" * 8, "é" * 3 + "deadbeef" * 3, "a" * 23, "0123456789abcdef" * 4, "ghp_" + "a" * 36, "ghq_" + "a" * 36, "xoxb-123456789012-abc",
    "AIza" + "x" * 35, "sk_live_" + "4" * 24, "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abcdefghijkl", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PUBLIC KEY-----", "passwor", "pa", "", None, "🙂token=🙂 token=abcdef🙂",
]


def test_spans_are_those_of_the_plain_rules(spark, rows):
    rng = random.Random(8)
    texts = [t for _, t, *_ in rows] + SECRETS + [" ".join(rng.choice([s or "" for s in SECRETS]) for _ in range(rng.randint(2, 30))) for _ in range(60)]
    frame = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    got = secret_scan.scan_secrets(frame).collect()
    assert sorted(((r.doc_id is None, r.doc_id, r.text), [tuple(s) for s in r.spans]) for r in got if r.doc_id) == sorted(((i % 9 == 0, i, t), plain_spans(t, RULES)) for i, t in enumerate(texts) if i % 9)
    assert len(got) == len(texts) and sum(len(r.spans) for r in got) == sum(len(plain_spans(t, RULES)) for t in texts)
    assert secret_scan.scan_secrets(frame.limit(0)).collect() == []


def test_the_query_has_the_base_spans(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(SECRETS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in secret_scan.op12_secret_scans(spark, str(tmp_path)).collect()}
    for i, text in rows:
        spans, all_ = plain_spans(text, secret_scan.BASE), plain_spans(text, RULES)
        written = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == kind for k, *_ in spans) for kind in ("assign", "access", "hex")]
        assert got[i].base_sha256 == hashlib.sha256(written(spans).encode()).hexdigest() and got[i].spans == written(all_)
    assert written(plain_spans("token:token:abcdef", RULES)) == "" and got[SECRETS.index("token:token:abcdef")].spans == ""
    assert got[SECRETS.index("ſecret=abcdefgh")].n_assign == 0 and got[SECRETS.index("é" * 3 + "deadbeef" * 3)].spans == "hex:3:27"


def test_queries_of_trigrams():
    rule = lambda p, **k: secret_scan.derive(secret_scan.Rule("x", p, **k))
    assert rule("abcd").grams() == {b"abc", b"bcd"} and rule("ABcd", ignore_case=True).grams() == {b"abc", b"bcd"}
    assert rule("[0-9a-f]+") is None and rule("ab") is None and rule("abc|de") is None and rule("(abc)?") is None and rule("(abc)*x") is None
    assert rule("abc|bcd").how == "any" and rule("ab?cde").grams() == {b"abc", b"bcd", b"acd", b"cde"}
    assert rule("(ab)+cde").grams() == {b"cde"} and rule("(abc)+").grams() == {b"abc"} and rule("a{3}").grams() == {b"aaa"} and rule("^abc$").grams() == {b"abc"}
    assert rule("é=x").grams() == {b"\xc3\xa9=", b"\xa9=x"}
    assert rule("[a-z]{2}abc[^x]def").of == frozenset({b"abc", b"def"}) or rule("[a-z]{2}abc[^x]def").grams() == {b"abc", b"def"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["abc", "a", "b?", "c+", "[ab]", "(abc|bca)", "(ab|c)?", "[^a]", "(a|bc){2}", "."]), min_size=1, max_size=5), st.text("abcABC ", max_size=30))
def test_no_match_is_without_its_trigrams(parts, text):
    rule = secret_scan.Rule("x", "".join(parts), ignore_case=True)
    raw = text.encode()
    bits = secret_scan.Scan([rule]).spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), [text])[0]
    assert [(a, b) for a, _, b in bits] == [m.span() for m in rule.compiled().finditer(text)]


def test_an_index_that_is_kept_finds_all_documents(spark, rows, tmp_path):
    texts = [t or "" for _, t, *_ in rows] + [s for s in SECRETS if s]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    secret_scan.index_grams(frame).write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    for rule in RULES:
        asked = secret_scan.candidates(index, rule)
        if rule.kind == "hex":
            assert asked is None
            continue
        found = {r.doc_id for r in asked.collect()}
        true = {i for i, t in enumerate(texts) if rule.compiled().search(t)}
        assert true <= found and len(found) < 20
        assert found == {i for i, t in enumerate(texts) if rule_holds(rule, t)}


def rule_holds(rule, text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode()
    holds = lambda n: (n in low) if isinstance(n, bytes) else (all if n.how == "all" else any)(holds(x) for x in n.of)
    return holds(secret_scan.derive(rule))


def test_texts_of_several_megabytes(spark):
    text = "token " * 300_000 + "eyJ" * 300_000 + " secret=abcdefgh" + "-----BEGIN " * 50_000 + "f" * 500_000
    got = secret_scan.scan_secrets(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(s) for s in got[0].spans] == plain_spans(text, RULES) and got[1].spans == []


# --- conversations

COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += []
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def plain_repair(rows):
    """By all paths through (row, role initials' state), whole strings compared."""
    faults, seen = [], set()
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {(len(rows), q): (0, "", ()) for q in ("", "a")}
    for i in range(len(rows), -1, -1):
        for _ in range(4):
            for q in step:
                ways = [best[i, q]] if (i, q) in best else []
                for c, to in step[q].items():
                    if c != "s" and (i, to) in best:
                        cost, audit, kept = best[i, to]
                        ways.append((cost + 3, "I" + audit, ({"u": "user", "a": "assistant"}[c] + ":", *kept)))
                if i < len(rows):
                    _, role, text = rows[i]
                    if (i + 1, q) in best:
                        cost, audit, kept = best[i + 1, q]
                        ways.append((cost + 4, "D" + audit, kept))
                    if faults[i] in ("", "truncated"):
                        more = 3 * (faults[i] == "truncated")
                        for c, to in step[q].items():
                            if (i + 1, to) in best:
                                cost, audit, kept = best[i + 1, to]
                                if role[:1] == c:
                                    ways.append((cost + more, "K" + audit, (f"{role}:{text}", *kept)))
                                if c != "s":
                                    ways.append((cost + more + 3, "R" + audit, (f"{ {'u': 'user', 'a': 'assistant'}[c]}:{text}", *kept)))
                if ways:
                    best[i, q] = min(ways)
    cost, audit, kept = best[0, ""]
    ts = [t for t, *_ in rows if t is not None]
    legal = ("su", "ua", "au")
    illegal = sum(a[1][:1] + b[1][:1] not in legal for a, b in zip(rows, rows[1:], strict=False))
    return (max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def talk(seed, conversations, longest=14):
    rng = random.Random(seed)
    said = ["Yes.", "No!", "Why", "", " \t\n", None, "So it is. ", "So it is. ", "ß?", "a\nb.", "\u00a0", "x" * 300 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "System", "a", "s"]
    out = []
    for c in range(conversations):
        usual = rng.random() < 0.6
        for t in range(rng.randint(1, longest)):
            role = ("user", "assistant")[t % 2] if usual and rng.random() < 0.9 else rng.choice(roles)
            out.append((c if c else None, rng.choice((None, t, t, t, t + 3, 2)) if not usual else t, role, rng.choice(said) if rng.random() < 0.4 else f"Text {rng.randint(0, 10**9)}."))
    rng.shuffle(out)
    return out


TALK = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("tasks,rows_of_a_piece", [(3, 4096), (40, 4096), (5, 1), (7, 3)])
def test_repairs_are_those_of_whole_paths(spark, monkeypatch, tasks, rows_of_a_piece):
    monkeypatch.setattr(turns, "PIECE_ROWS", rows_of_a_piece)
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [*talk(9, 150), (gone, 0, "user", "Dropped.")]
    frame = spark.createDataFrame(rows, TALK).withColumns({"piece": F.lit(1), "here": F.lit(False), "fault": F.lit("x"), "audit": F.lit(0)}).repartition(4)
    whole, parts = turns.repair(turns.damage(frame), tasks)
    got = {r[0]: tuple(r)[1:] for r in turns.report(whole, parts).collect()}
    want = {c: plain_repair(r) for c, r in damaged(rows).items()}
    assert got == want and want[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and parts.count()
    rows = turns.repaired_turns(whole, parts).orderBy("conv_id", "piece", "place").collect()
    texts = defaultdict(list)
    for r in rows:
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(texts[c]).encode()).hexdigest() == w[7] for c, w in want.items())


def test_a_long_conversation_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(turns, "PIECE_ROWS", 100)
    rng = random.Random(2)
    rows = [(7, t, rng.choice(("user", "assistant", "user", "assistant", "tool")), rng.choice(("Yes.", "No", "", f"{t}!", f"{t}?"))) for t in range(3000)] + [(t % 50, t, "user", "Hm.") for t in range(1000)]
    whole, parts = turns.repair(turns.damage(spark.createDataFrame(rows, TALK).repartition(4)), 12)
    assert max(r["count"] for r in parts.groupBy(F.shiftright("piece", 40)).count().collect()) < 15
    got = {r[0]: tuple(r)[1:] for r in turns.report(whole, parts).collect()}
    assert got == {c: plain_repair(r) for c, r in damaged(rows).items()}


def test_no_conversations(spark):
    assert turns.report(*turns.repair(turns.damage(spark.createDataFrame([], TALK)))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua?"), st.sampled_from([turns.FINE, turns.CUT, turns.GONE])), max_size=9), st.integers(0, 9))
def test_matrices_multiply_to_the_shortest_path(rows, at):
    """Cutting a conversation anywhere changes neither the cost nor the edits."""
    after, tails = turns.last_weights()
    cost, audit, state = turns.shortest(rows, after)[turns.START]
    audit += tails[state]
    first, second = turns.times(rows[:at]), turns.times(rows[at:])
    ends = [(turns.INSERT * len(t), t) for t in tails]
    ways = [(x[0] + y[0] + ends[b][0], x[1] + y[1] + ends[b][1]) for a, x in enumerate(first[turns.START]) if x for b, y in enumerate(second[a]) if y]
    assert min(ways) == (cost, audit)
