"""Language network, importance resampling and conversation repair against
brute-force versions, on tables with nulls, empty and long texts, ties,
repeated rows and clashing names, and on empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import conversations, langnet, resample
from basketry.llm.common import ship
from tests.llm.test_operators import SCHEMA, got, low, rows, want

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


# --- importance resampling -------------------------------------------------------

def test_crcs_of_runs_follow_from_prefixes():
    words = ["a", "bc", "déf", "x" * 700, "q" * 64, "z" * 63, "é" * 5000, "a"]
    found = resample.run_crcs(pa.array(words), 4, resample.Shifts())
    for k, crcs in enumerate(found, 1):
        assert crcs.tolist() == [zlib.crc32(" ".join(words[i:i + k]).encode()) for i in range(len(words) - k + 1)]
    assert [len(c) for c in resample.run_crcs(pa.array(["one"]), 3, resample.Shifts())] == [1, 0, 0]


def runs_of(text):
    w = WORDS.findall(low(text or ""))
    return w, w + [" ".join(p) for p in zip(w, w[1:])]


def brute_resample(data, target, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = collections.Counter(), collections.Counter()
    for _, text in data:
        s.update(map(bucket, runs_of(text)[1]))
    for text in target:
        t.update(map(bucket, runs_of(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (S + 10_000)) / ((s[b] + 1) * (T + 10_000))))
    out = []
    for i, text in data:
        w, f = runs_of(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(able[:len(able) * percent // 100], 1):
        r[5] = k
    return [tuple(r) for r in out]


def test_resample_against_brute_force(spark, docs, none):
    columns = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    target = ["The lazy dog, the brown fox", None, "w1x1 w2x2"]
    frame = spark.createDataFrame([(k, x, 1) for k, x in enumerate(target)], "item_id long, text string, score long")
    data = [(r[0], r[1]) for r in rows()]
    for percent, least in ((25, 20), (60, 1), (100, 0)):
        expected = brute_resample(data, target, percent, least)
        assert got(resample.resample(docs, frame, percent, least), *columns) == want(expected)
    assert resample.resample(none, frame).count() == 0
    # without target texts the corpus' frequent runs weigh least
    assert got(resample.resample(docs, none, 50, 1), *columns) == want(brute_resample(data, [], 50, 1))
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert got(resample.resample(empty, none, 100, 0), "weight", "rank") == want([(0, r["rank"]) for r in
                                                                                  resample.resample(empty, none, 100, 0).collect()])


# --- language network -----------------------------------------------------------

def test_gradients_are_those_of_the_loss():
    net = langnet.Net(["a", "b", "c"], seed=3)
    for k, w in enumerate(net.weights()):
        w[...] = np.random.default_rng(k).normal(0, 0.5, w.shape)
    for t in net.taps:
        t[:, langnet.PAD] = 0
    rnd = np.random.default_rng(5)
    x, y = rnd.integers(0, 256, (6, langnet.WINDOW)).astype(np.uint16), np.array([0, 1, 2, 0, 1, 2])
    x[2, 40:] = langnet.PAD

    def loss():
        net.pairs = []
        return -float(net.score(x).astype(np.float64)[np.arange(6), y].mean())

    for w, g in zip(net.weights(), net.gradients(x, y)):
        flat, slope = w.reshape(-1), g.reshape(-1)
        for at in np.argsort(-np.abs(slope))[:3]:
            was, h = flat[at], 2e-2
            flat[at] = was + h
            up = loss()
            flat[at] = was - h
            down = loss()
            flat[at] = was
            assert (up - down) / (2 * h) == pytest.approx(slope[at], rel=0.15, abs=2e-3)


def slow_score(net, text):
    """Mean log-probability by definition: one window, place and filter at a time."""
    b, stride, total = text.encode(), langnet.WINDOW - 3, np.zeros(len(net.languages))
    at = 0
    while True:
        own = list(b[at:at + langnet.WINDOW])
        held = len(own)
        own += [langnet.PAD] * (langnet.WINDOW - held)
        h = []
        for taps, bias in zip(net.taps, net.bias):
            for f in range(langnet.FILTERS):
                best = max(sum(float(taps[k, own[p + k], f]) for k in range(len(taps))) for p in range(langnet.WINDOW - len(taps) + 1))
                h.append(max(best + float(bias[f]), 0.0))
        z = np.array(h) @ net.out.astype(np.float64) + net.base
        total += held * (z - np.log(np.exp(z - z.max()).sum()) - z.max())
        at += stride
        if at + 3 >= len(b):
            return total / len(b) if len(b) <= langnet.WINDOW else total


def made_up(n, seed=1):
    rnd = random.Random(seed)
    parts = {"en": "the ing tion and er ou th wh ly ed".split(), "fr": "le que eau ère é ç ment oui aux les".split(),
             "fi": "kk ää yy talo inen ssa lla ö jä uu".split()}
    out = []
    for i in range(n):
        lang = ("en", "en", "fr", "fi")[i % 4]
        words = ["".join(rnd.choices(parts[lang], k=rnd.randint(1, 3))) for _ in range(rnd.randint(3, 120))]
        out.append((i, " ".join(words), lang))
    return out


def test_language_network(spark, docs, none):
    ship(spark)
    data = made_up(400)
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3)
    out = {r["doc_id"]: r for r in langnet.identify(frame, sample_windows=600).collect()}
    assert len(out) == 400
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out)
    held = [i for i in out if out[i]["held_out"]]
    assert sum(out[i]["lang_pred"] == data[i][2] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.values())
    # prediction reads neither lang, nor ids, nor other rows
    hidden = [(1000 + i, text, None) for i, text, _ in data]
    both = spark.createDataFrame(data + hidden, "doc_id long, text string, lang string")
    again = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langnet.identify(both, sample_windows=600).collect()}
    assert all(again[i] == again[1000 + i] for i in range(400))


def test_scores_by_definition(spark):
    net = langnet.Net(["a", "b"], seed=2)
    for k, w in enumerate(net.weights()):
        w[...] = np.random.default_rng(k).normal(0, 0.4, w.shape)
    for t in net.taps:
        t[:, langnet.PAD] = 0
    texts = ["x", "short é", "y" * 128, "abc " * 32 + "d", "longer text, " * 40]
    data = pa.array(texts)
    from basketry.llm.common import raw_bytes
    x, ends, held = langnet.windows(*raw_bytes(data))
    each = net.score(x) * held[:, None]
    for k, text in enumerate(texts):
        total = each[ends[k]:ends[k + 1]].sum(axis=0)
        expected = slow_score(net, text)
        if len(text.encode()) <= langnet.WINDOW:
            total = total / len(text.encode())
        assert total == pytest.approx(expected, rel=1e-3, abs=1e-3)
        # every byte stands in a window, with the bytes that any filter sees beside it
        assert held[ends[k]:ends[k + 1]].sum() - 3 * (ends[k + 1] - ends[k] - 1) == len(text.encode())


def test_language_edge_cases(spark, docs, none):
    assert langnet.identify(none).count() == 0
    out = langnet.identify(docs, sample_windows=100).collect()
    assert len(out) == len(rows())
    assert {(r["lang_pred"], r["score"]) for r in out if r["doc_id"] == 2} == {("und", 0.0)}     # null text
    data = [(1, None, "en"), (2, "", "en"), (3, " 12 - !? 34 ", "fr"), (4, "a", None), (None, "é", None)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    # nothing to learn from: no labelled text has a letter
    assert {(r["lang_pred"], r["score"]) for r in langnet.identify(frame).collect()} == {("und", 0.0)}
    ids = [i for i in range(5, 20) if zlib.crc32(str(i).encode()) % 4 != 2]
    learned = spark.createDataFrame(data + [(ids[0], "some words", "en"), (ids[1], "quelques mots", "fr")],
                                    "doc_id long, text string, lang string")
    pred = {r["doc_id"]: r["lang_pred"] for r in langnet.identify(learned).collect()}
    assert [pred[k] for k in (1, 2, 3)] == ["und"] * 3 and pred[4] in ("en", "fr") and pred[None] in ("en", "fr")


# --- conversation repair ----------------------------------------------------------

FOLLOW = (2, 2, 3, 2)


def brute_audit(codes):
    """Least (cost, audit) by dynamic programming over whole strings."""
    ahead = None
    for i in range(len(codes), -1, -1):
        found = [[] for _ in range(4)]
        for s in range(4):
            if i == len(codes):
                found[s] += [(0, "")] if s in (0, 3) else []
                continue
            ways = [(3, "D", s)]
            if codes[i] < 8:
                late = codes[i] // 4
                ways.append((2 + late, "R", FOLLOW[s]))
                ways += [(late, "K", to) for a, r, to in ((0, 0, 1), (0, 1, 2), (1, 1, 2), (2, 2, 3), (3, 1, 2))
                         if a == s and codes[i] % 4 == r]
            found[s] += [(ahead[to][0] + c, e + ahead[to][1]) for c, e, to in ways if ahead[to]]
        best = [min(f) if f else None for f in found]
        for _ in range(4):
            for s in range(4):
                to = best[FOLLOW[s]]
                if to and (best[s] is None or (to[0] + 2, "I" + to[1]) < best[s]):
                    best[s] = (to[0] + 2, "I" + to[1])
        ahead = best
    return ahead[0]


def test_auction_against_dynamic_programming():
    rnd = random.Random(4)
    sequences = [bytes(rnd.choice((0, 1, 2, 3, 4, 5, 6, 7, 8, 1, 2, 1, 2)) for _ in range(n))
                 for n in [*range(10), 31, 32, 33, 64, 65, 100, 150] for _ in range(12)]
    sequences += [bytes([1, 2] * 40), bytes([1] * 90), bytes([2] * 70), bytes([8] * 100), bytes([0] * 40), bytes([3] * 66),
                  bytes([1, 1, 2, 2] * 20), bytes([8] * 40 + [1, 2] * 20)]
    assert conversations.solve(sequences) == [brute_audit(s) for s in sequences]
    assert [conversations.solve([s])[0] for s in sequences[::9]] == [brute_audit(s) for s in sequences[::9]]
    assert conversations.solve([]) == []


def brute_repairs(data):
    by = collections.defaultdict(list)
    show = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in data:
        d = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        by[conv] += [] if d == 0 else [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = []
    for conv in {r[0] for r in data}:
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
        own = sorted(by[conv], key=key)
        seen, codes, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            if not last:
                fault = 0
            elif (role, text) in seen:
                fault = 1
            else:
                fault = 2 if last[0] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            codes.append(8 if fault in (0, 1) else {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (4 if fault == 2 else 0))
        cost, audit = brute_audit(codes)
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in own]
        illegal = sum((a + b) not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        lines, state, at = [], 0, iter(own)
        for e in audit:
            if e == "I":
                state = FOLLOW[state]
                lines.append(("", "", "user", "assistant")[state] + ":")
                continue
            _, role, text = next(at)
            if e == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            elif e == "R":
                state = FOLLOW[state]
                role = ("", "", "user", "assistant")[state]
            if e != "D":
                lines.append(f"{role}:{text}")
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


CONV = ("conv_id long, turn long, role string, text string, copies long, key string, kind int, place long, audit string")
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversation_data():
    rnd = random.Random(6)
    out = []
    for conv in [*range(120), None]:
        n = rnd.choice((1, 2, 3, 4, 5, 8, 12)) if conv != 7 else 400
        for turn in range(n):
            role = rnd.choice(("user", "assistant", "assistant", "user", "system", "tool", "", None)) if rnd.random() < 0.3 else (
                "user", "assistant")[turn % 2]
            text = rnd.choice(("Yes.", "No!", "ok", "", " \n", None, "Well?\n", "Long " * 300 + ".", "é.\x0b", f"own {conv} {turn}."))
            out.append((conv, None if rnd.random() < 0.05 else turn + (turn > 3), role, text, 5, "k", 1, 2, "x"))
    out += [out[3], out[3], out[50]]                         # rows twice and more
    return out


def test_repairs_against_brute_force(spark):
    ship(spark)
    data = conversation_data()
    frame = spark.createDataFrame(data, CONV).repartition(3)
    expected = brute_repairs([r[:4] for r in data])
    assert got(conversations.damaged_repairs(frame), *COLUMNS) == want(expected)
    assert conversations.damaged_repairs(spark.createDataFrame([], CONV)).count() == 0
    # a conversation id may be a text
    words = spark.createDataFrame([(str(r[0]), *r[1:4]) for r in data], "conv_id string, turn long, role string, text string")
    assert got(conversations.damaged_repairs(words), *COLUMNS) == want(brute_repairs([(str(r[0]), *r[1:4]) for r in data]))


def test_repair_gives_rows(spark):
    ship(spark)
    data = [(1, 0, "user", "Hi."), (1, 1, "user", "You there?"), (2, 0, "assistant", "A."), (2, 1, "user", "B."), (3, 0, "tool", ""),
            (4, 0, "system", "S."), (4, 1, "user", "Q?"), (4, 2, "assistant", "and")]
    found, repaired = conversations.repair(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    assert got(found, "conv_id", "cost", "audit") == [(1, 2, "KR"), (2, 4, "IKKI"), (3, 3, "D"), (4, 1, "KKK")]
    assert got(repaired, "conv_id", "place", "edit", "turn", "role", "text") == want([
        (1, 0, "K", 0, "user", "Hi."), (1, 1, "R", 1, "assistant", "You there?"),
        (2, 0, "I", None, "user", ""), (2, 1, "K", 0, "assistant", "A."), (2, 2, "K", 1, "user", "B."), (2, 3, "I", None, "assistant", ""),
        (4, 0, "K", 0, "system", "S."), (4, 1, "K", 1, "user", "Q?"), (4, 2, "K", 2, "assistant", "and")])
