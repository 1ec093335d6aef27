"""Each operator against a brute-force version on a small table that holds
nulls, empty texts, repeated rows, ties and extra columns with clashing names,
and on an empty table."""

import collections
import hashlib
import math
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import bpe, charmodel, dac, decontaminate, licenses, line_spread, quality, repeats, sharding, simhash, suffix_tree
from basketry.llm.common import mix, scratch, ship, tokenizer_path

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, h long, t long, word string, row int, "
          "fp string, block string, grp string")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(6000))
BOILER = "All rights reserved. Read the full terms and conditions on our page."
PROSE = ("The quick brown fox jumps over the lazy dog near the river bank while the sun sets slowly behind the old hills "
         "and nobody cares about the noise of the distant train that passes by every single evening")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def rows():
    texts = [PROSE, PROSE + " again", None, "", "  \n\t ", "one two", PROSE, LONG, f"start\n{BOILER}\nend of one",
             f"other text\n{BOILER}\nsecond", f"{BOILER}\nthird here", f"{BOILER}\nfourth", f"{BOILER}\nfifth place {PROSE}",
             "Released under the MIT License.\n\nThis is CC BY-NC work, see the Apache License", "a a a a a a a a a a a a",
             "é́ ΑΣ İ don't <|endoftext|>x 12.5\x85y   z" + "q" * 300, "abab" * 200, "abab" * 210]
    out = [(k, x, ("en", "fr", None)[k % 3], f"s{k % 7}", 0, 7, 8, "w", 1, "f", "b", "g") for k, x in enumerate(texts)]
    out.append(out[0])                                      # a row twice
    out.append((3, "same id, other text", *out[3][2:]))      # an id twice
    out.append((None, "no id at all", *out[3][2:]))
    out.append((None, "no id at all, again", *out[3][2:]))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def want(items):
    return sorted(items, key=repr)


def test_bpe_equals_library(docs, none):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    expected = []
    for r in rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest(), ids, text))
    out = bpe.encode_decode(docs, keep_ids=True, keep_decoded=True)
    assert got(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded") == want(expected)
    assert bpe.encode_decode(none).count() == 0


def test_bpe_random_text_equals_library():
    tokenizers = pytest.importorskip("tokenizers")
    import random
    library, merges = tokenizers.Tokenizer.from_file(tokenizer_path()), bpe.Merges.load(tokenizer_path())
    rnd = random.Random(3)
    alphabet = "aabbcdeéthingeron  '.,!?sS$%123٣½ǅİßΣς́가힣中文🙂\n\t\x0b \x85\x1c\x1d<|>"
    for k in range(3000):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        if k % 7 == 0:
            s += "<|endoftext|>" + s[:5] + "<|STARTOFTEXT|>don't'LL"
        assert merges.encode(s) == library.encode(s, add_special_tokens=False).ids, s


def test_dac_files(spark, docs, none):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    folder = scratch(spark, "dac-test")
    dac.write_tokens(docs, folder, segment_tokens=500)
    out = sorted(dac.read_tokens(spark, folder, keep_ids=True).collect(), key=lambda r: r["start"])
    start = 0
    for r in out:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    assert [r["doc_id"] for r in out] == sorted((x[0] for x in rows()), key=lambda i: (i is not None, i))
    expected = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows()]
    assert want((r["doc_id"], list(r["ids"])) for r in out) == want(expected)
    flat = [i for r in out for i in r["ids"]]
    asked = [0, 1, 777, len(flat) - 1, len(flat)]
    found = dac.tokens_at(spark, folder, spark.createDataFrame([(p,) for p in asked], "position long"))
    assert got(found, "position", "token") == want((p, flat[p]) for p in asked if p < len(flat))
    empty = scratch(spark, "dac-empty")
    dac.write_tokens(none, empty)
    assert dac.read_tokens(spark, empty).count() == 0


def test_dac_levels_random_access():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 1 << k, 3000) for k in (4, 9, 17, 25, 32)]).astype(np.uint32)
    rng.shuffle(ids)
    d = dac.Dac.unpack(dac.Dac.build(ids).pack())
    at = rng.integers(0, len(ids), 500)
    assert (d.access(at) == ids[at]).all() and (d.access(at[:3]) == ids[at[:3]]).all() and (d.all() == ids).all()
    assert len(dac.Dac.build(ids[:0]).all()) == 0


def test_simhash_components(docs, none):
    xxhash = pytest.importorskip("xxhash")
    prints = []
    for r in rows():
        w = WORDS.findall(low(r[1] or ""))
        shingles = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
        counts = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s, 42)
            for b in range(64):
                counts[b] += h >> b & 1
        prints.append((r[0], sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))))
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4 and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for (i, _), c in zip(prints, label):
        least[c] = min(i if i is not None else math.inf, least.get(c, math.inf))
    expected = [(i, f"{f:016x}", None if least[c] == math.inf else least[c]) for (i, f), c in zip(prints, label)]
    assert got(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want(expected)
    assert simhash.near_duplicates(none).count() == 0


def test_covering_masks_meet_every_close_pair():
    import random
    rnd = random.Random(5)
    for free in ((1 << 64) - 1, (1 << 33) - 1, 0xF0F0F0F0, 0xFFF):
        masks = simhash.covering_masks(free, 4)
        bits = [i for i in range(64) if free >> i & 1]
        assert len(masks) == 31
        for _ in range(300):
            differ = sum(1 << b for b in rnd.sample(bits, 4))
            assert any(differ & m == 0 for m in masks)


def test_crowded_buckets_are_cut_again(spark):
    import random
    ship(spark)
    rnd = random.Random(9)
    centre = rnd.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rnd.sample(range(20), rnd.randint(0, 9))) for _ in range(400)}
    values |= {rnd.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.near_edges(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, bucket_rows=20)
    label = {v: v for v in signed}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for e in edges.distinct().collect():
        assert ((e["u"] ^ e["v"]) & ((1 << 64) - 1)).bit_count() >= 1
        a, b = root(e["u"]), root(e["v"])
        label[max(a, b)] = min(a, b)
    mine = {v: root(v) for v in signed}
    brute = {v: v for v in signed}
    changed = True
    while changed:
        changed = False
        for a in signed:
            for b in signed:
                if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 and brute[a] > brute[b]:
                    brute[a], changed = brute[b], True
    assert mine == brute


def test_quality_counts(docs, none):
    expected = []
    for r in rows():
        text = r[1] or ""
        w = WORDS.findall(text)
        windows = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {k + i for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for i in range(5)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        expected.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                         len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)))
    out = quality.judge(docs)
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want(expected)
    assert out.where("base_failed AND kept").count() == 0
    assert quality.judge(none).count() == 0


def test_quality_rejects_noise_and_keeps_prose(spark):
    import random
    ship(spark)
    rnd = random.Random(2)
    vocabulary = ["the", "river", "house", "mountain", "and", "little", "bread", "winter", "walking", "a", "of", "garden"]
    prose = [(k, " ".join(rnd.choice(vocabulary) + rnd.choice(["", "", "", "s", "."]) for _ in range(120)), "en") for k in range(200)]
    noise = [(1000 + k, " ".join("".join(rnd.choice("qxzjkv#$%") for _ in range(7)) for _ in range(120)), "en") for k in range(10)]
    frame = spark.createDataFrame(prose + noise, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.judge(frame).where("kept").collect()}
    assert not any(k >= 1000 for k in kept) and len(kept) >= 195
    joined = {r["doc_id"] for r in quality.judge(frame, max_model_bytes=0).where("kept").collect()}
    assert joined == kept


def test_kneser_ney_sums_to_one(spark, docs):
    own = docs.select("text", "lang")
    grams, contexts = quality.kneser_ney(quality.count_grams(own, 2), 2)
    g = [r.asDict() for r in grams.collect()]
    c = {(r["grp"], r["ctx"]): r["logw"] for r in contexts.collect()}
    seen = collections.defaultdict(dict)
    for r in g:
        seen[r["grp"], r["ctx"]][r["sym"]] = 10 ** r["logp"]

    def p(grp, ctx, sym):
        if (grp, ctx) not in c:
            return p(grp, ctx[1:], sym)
        if sym in seen[grp, ctx]:
            return seen[grp, ctx][sym]
        return 10 ** c[grp, ctx] * (p(grp, ctx[1:], sym) if ctx else 1 / charmodel.CODE_POINTS)

    for (grp, ctx) in list(c)[:60]:
        symbols = set(seen[grp, ""])
        unseen = charmodel.CODE_POINTS - len(symbols)
        total = sum(p(grp, ctx, s) for s in symbols) + unseen * p(grp, ctx, "\U0010fffe")
        assert abs(total - 1) < 1e-6


def test_suffix_tree_contract_columns(docs, none):
    data = rows()
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in data]
    counts, ends = collections.Counter(), 0
    for r, h in zip(data, held):
        if not h:
            counts.update(WORDS.findall(low(r[1] or "")))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    expected = []
    for r, h in zip(data, held):
        w = WORDS.findall(low(r[1] or ""))
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) + math.log10((ends + 0.1) / (n + 0.1 * (v + 1)))
        expected.append((r[0], h, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n, round(base, 6)))
    out = suffix_tree.score_texts(docs).collect()
    assert want((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                for r in out) == want(expected)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    assert suffix_tree.score_texts(none).count() == 0


def brute_tree_scores(data, depth, min_count, min_divergence):
    """Scores of (doc_id, text) by a suffix tree grown context by context."""
    runs, learns = [], []
    for i, text in data:
        runs.append("\x02" + " ".join(WORDS.findall(low(text or ""))) + "\x03")
        learns.append(zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0)
    counts = collections.defaultdict(collections.Counter)
    for run, own in zip(runs, learns):
        for k in range(1, len(run) if own else 0):
            for n in range(min(depth, k) + 1):
                counts[run[k - n:k]][run[k]] += 1
    kept = {""}
    for ctx in counts:
        n, parent = sum(counts[ctx].values()), counts[ctx[1:]]
        gain = sum(c * math.log(c / n / (parent[s] / sum(parent.values()))) for s, c in counts[ctx].items()) if ctx else 0
        if ctx and n >= min_count and gain >= min_divergence:
            kept |= {ctx[k:] for k in range(len(ctx))}

    def p(ctx, s):
        below = p(ctx[1:], s) if ctx else 1 / charmodel.CODE_POINTS
        kinds, n = len(counts[ctx]), sum(counts[ctx].values())
        return (counts[ctx][s] + kinds * below) / (n + kinds) if n else below

    return [sum(math.log10(p(next(run[k - n:k] for n in range(min(depth, k), -1, -1) if run[k - n:k] in kept), run[k]))
                for k in range(1, len(run))) for run in runs]


@pytest.mark.parametrize("piece", [1 << 21, 50])
def test_suffix_tree_against_brute_force(spark, docs, monkeypatch, piece):
    monkeypatch.setattr(suffix_tree, "_PIECE", piece)
    data = [(r[0], r[1]) for r in rows()]
    expected = [(i, round(s, 2)) for (i, _), s in zip(data, brute_tree_scores(data, 4, 3, 1.0))]
    for size in (64 << 20, 0):                            # broadcast arrays, joins
        out = suffix_tree.score_texts(docs, depth=4, min_count=3, min_divergence=1.0, max_model_bytes=size).collect()
        assert want((r["doc_id"], round(r["score"], 2)) for r in out) == want(expected)


def test_running_grams_against_brute_force():
    import random
    rnd = random.Random(3)
    # so many symbols that packed grams must be made dense on the way
    words = [["".join(chr(rnd.randrange(0x4E00, 0x4E00 + size)) for _ in range(200))] for size in (4, 20000)] + [[], ["\x00\x00a"]]
    runs = ["\x02" + " ".join(w) + "\x03" for w in words]
    points = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    expected = collections.Counter(r[max(k - 6, 0):k + 1] for r in runs for k in range(1, len(r)))
    found = collections.Counter()
    for grams, counts in suffix_tree.running_grams(points, offsets, 6):
        found.update(dict(zip(grams, counts.tolist())))
    assert found == expected
    for apart in (False, True):
        found = collections.Counter()
        for _, grams, counts in charmodel.running_grams(points, offsets, 6, apart):
            found.update(dict(zip(grams, counts.tolist())))
        assert found == expected


@pytest.mark.parametrize("numbers", [1 << 19, 12])
def test_grams_keep_their_integers_from_piece_to_piece(monkeypatch, numbers):
    monkeypatch.setattr(suffix_tree, "_PIECE", 64)
    monkeypatch.setattr(suffix_tree, "_NUMBERS", numbers)
    texts = ["\x02" + " ".join(x) + "\x03" for x in (["abé", "\U0010ffff漢", "abé"] * 60, [], ["\x00a"] * 90, ["abé", "漢\x00"] * 9)]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    for depth in range(9):
        expected = collections.Counter(x[max(k - depth, 0):k + 1] for x in texts for k in range(1, len(x)))
        grams, parts, found, cleared = suffix_tree.Grams(depth), [], collections.Counter(), 0
        for _, key in grams.pieces(points, offsets):
            parts.append(suffix_tree._counted(key))
            if grams.full():
                kinds, counts = suffix_tree._merged(parts)
                found.update(dict(zip(grams.texts(kinds).to_pylist(), counts.tolist())))
                grams.clear()
                parts, cleared = [], cleared + 1
        if parts:
            kinds, counts = suffix_tree._merged(parts)
            assert len(set(kinds.tolist())) == len(kinds)
            found.update(dict(zip(grams.texts(kinds).to_pylist(), counts.tolist())))
        assert found == expected
        assert cleared or numbers > 12 or depth < 2


def test_a_gram_met_in_an_earlier_piece_is_not_looked_up_again(monkeypatch):
    class Model:
        depth = 5

        def __init__(self):
            self.asked = collections.Counter()

        def look_up(self, points, at, reach):
            for x, n in zip(at.tolist(), reach.tolist()):
                self.asked["".join(map(chr, points[x - n:x + 1]))] += 1
            return -(at - at + points[at] + reach / 8)

    monkeypatch.setattr(suffix_tree, "_PIECE", 64)
    texts = ["\x02" + " ".join(["abé", "漢", "abc"] * n) + "\x03" for n in (60, 0, 1, 40)]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    for hold in (1 << 20, 10):
        monkeypatch.setattr(suffix_tree, "_HOLD", hold)
        model = Model()
        score = suffix_tree.RunningScores(model)
        for _ in range(2):                                # the second time from memory
            assert score(points, offsets).tolist() == [
                -sum(ord(x[k]) + min(k, 5) / 8 for k in range(1, len(x))) for x in texts]
        grams = {x[max(k - 5, 0):k + 1] for x in texts for k in range(1, len(x))}
        assert set(model.asked) == grams and (hold == 10 or set(model.asked.values()) == {1})


def test_suffix_tree_hears_the_order_of_words(spark):
    import random
    ship(spark)
    rnd = random.Random(4)
    follows = {w: [w + "ka", "to" + w[:2]] for w in ["mi", "ra", "ne", "lu"]}
    data = []
    for k in range(400):
        first = [rnd.choice(list(follows)) for _ in range(40)]
        data.append((k, " ".join(f"{w} {rnd.choice(follows[w])}" for w in first)))
    held = [k for k, _ in data if zlib.crc32(str(k).encode()) % 10 == 0]
    for k in held:                                        # the same words in another order, held out too
        words = data[k][1].split()
        rnd.shuffle(words)
        data.append((next(n for n in range(1000 + 100 * k, 10 ** 6) if zlib.crc32(str(n).encode()) % 10 == 0), " ".join(words)))
    out = {r["doc_id"]: r for r in suffix_tree.score_texts(spark.createDataFrame(data, "doc_id long, text string"))
           .where("held_out").collect()}
    shuffled = [i for i, _ in data[400:]]
    assert len(held) > 20 and all(abs(out[a]["base_score"] - out[b]["base_score"]) < 1e-6 and out[a]["score"] > out[b]["score"] + 1
                                  for a, b in zip(held, shuffled))
    assert all(out[a]["score"] > out[a]["base_score"] for a in held)


def test_suffix_tree_beats_the_base_on_held_out_text(spark):
    import random
    ship(spark)
    rnd = random.Random(4)
    parts = {"x": ["ka", "to", "mi", "ra", "ne"], "y": ["sch", "un", "ge", "ber", "lich"]}
    data = []
    for k in range(400):
        g = rnd.choice("xy")
        data.append((k, " ".join("".join(rnd.choice(parts[g]) for _ in range(rnd.randint(1, 4))) for _ in range(60)), g))
    out = suffix_tree.score_texts(spark.createDataFrame(data, "doc_id long, text string, lang string")).where("held_out")
    r = out.selectExpr("sum(base_score) b", "sum(score) s", "count(*) n").first()
    assert r["n"] > 20 and r["s"] > r["b"]


def brute_repeats(items, length):
    seen, out = set(), []
    for i, text in items:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                gone[k:k + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_against_brute_force(spark, docs, none):
    import random
    rnd = random.Random(8)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(900))
    texts = [base, base[100:450] + "xyz" + base[500:], "zz" + base[:99], "q" + base[:100], "a" * 500, "b" + "a" * 350, "ab" * 300,
             base[:300] * 3, None, "", "short", base, "é" * 200, "xx" + "é" * 180, base[10:400].upper(), LONG, LONG[37:2000]]
    data = list(enumerate(texts))
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    expected = brute_repeats(data, 100)
    assert got(repeats.remove_repeats(frame), *columns) == want(expected)
    # buckets dealt again by further hashes give the same rows
    assert got(repeats.remove_repeats(frame, bucket_bytes=300), *columns) == want(expected)
    assert repeats.remove_repeats(none).count() == 0
    # equal rows are one document; ids null or repeated do no harm
    assert repeats.remove_repeats(docs).count() == len(rows())
    again = spark.createDataFrame([(1, base), (1, base), (2, base)], "doc_id long, text string")
    assert got(repeats.remove_repeats(again), "doc_id", "n_removed") == [(1, 0), (1, 0), (2, 900)]


def plain_licenses(text):
    """The digest columns of one text, every block and every run tried."""
    text = text or ""
    w = licenses.words_of(text)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    base, score = set(labels), 1.0 if labels else 0.0
    paragraphs = [licenses.words_of(b) for b in re.split(r"\n(?:[^0-9A-Za-z\x80-\U0010ffff]*\n)+", text)]
    for label, notice, signs in licenses.TEMPLATES:
        own = list(dict.fromkeys(licenses.words_of(notice)))
        signs = [" " + " ".join(licenses.words_of(x)) + " " for x in signs]
        short = len(own) <= licenses.RUN_WORDS
        size = licenses.reach(len(licenses.words_of(notice)))
        for p in paragraphs:
            blocks = [p[i:i + n] for i in range(len(p)) if p[i] in own for n in range(1, size + 1)] if short else [p]
            for b in blocks:
                first = [b.index(x) for x in own if x in b]
                if (not short or first == sorted(first)) and all(x in f" {' '.join(b)} " for x in signs):
                    if len(first) / len(own) >= 0.8 - 1e-9:
                        labels.add(label)
                        score = max(score, len(first) / len(own))
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(
        sorted(labels)), score


DIGEST = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_licenses_against_brute_force(docs, none):
    expected = [(r[0], *plain_licenses(r[1])) for r in rows()]
    assert got(licenses.scan(docs), *DIGEST) == want(expected)
    assert licenses.scan(none).count() == 0


def license_texts():
    """Every notice whole, wrapped, with words lost, added and swapped, and beside others."""
    rng = np.random.default_rng(5)
    out = []
    for _, notice, _ in licenses.TEMPLATES:
        w = notice.split()
        out += [notice, "\n".join(w), "Some words before it.\n" + " ".join(w[:len(w) // 2]) + "\n# " + " ".join(w[len(w) // 2:])]
        for _ in range(3):
            x = list(w)
            del x[int(rng.integers(len(x)))]
            x.insert(int(rng.integers(len(x) + 1)), "really")
            a, b = rng.integers(len(x), size=2)
            out.append(" ".join(x) + " the end")
            x[a], x[b] = x[b], x[a]
            out.append(" ".join(x))
        out.append("\n\n".join([notice, *(licenses.TEMPLATES[int(k)][1] for k in rng.integers(len(licenses.TEMPLATES), size=2))]))
        out.append(" ".join([notice, licenses.TEMPLATES[int(rng.integers(len(licenses.TEMPLATES)))][1]]))
    return out


def test_licenses_in_many_forms(spark):
    ship(spark)
    data = list(enumerate(license_texts()))
    expected = [(k, *plain_licenses(x)) for k, x in data]
    table = spark.createDataFrame(data, "doc_id long, text string")
    found = got(licenses.scan(table), *DIGEST)
    assert found == want(expected)
    own = duckdb.connect()
    own.register("documents", pa.table({"doc_id": [k for k, _ in data], "text": [x for _, x in data]}))
    columns = ", ".join(DIGEST)
    assert want(own.execute(f"SELECT {columns} FROM ({licenses.license_sql()})").fetchall()) == found


def test_licenses_tell_versions_and_variants_apart(spark):
    ship(spark)
    texts = {
        "Licensed under CC BY 4.0.": "cc-by,cc-by-4.0", "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa-4.0",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0", "Licensed under CC BY-NC 2.5.": "cc-by",
        "This work is licensed under the GNU General Public License, version 2.": "gpl,gpl-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "lgpl-3.0",
        "Released under the BSD License.": "bsd", "Released under the MIT License.": "mit,mit-notice",
        "Creative Commons Attribution-ShareAlike 4.0 International": "",
        "The work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "cc-by-sa-4.0",
        "All the rights of the tenants were reserved by the city.": "", "Reserved rights for all.": "",
        "Licensed under the Apache License, Version 1.1.": "apache", "SPDX-License-Identifier: LGPL-2.1-only": "lgpl-2.1",
    }
    data = list(enumerate(texts))
    out = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert {x: out[k] for k, x in data} == texts
    # a notice gets the labels of no other version or variant of its family
    notices = [(k, label, notice) for k, (label, notice, _) in enumerate(licenses.TEMPLATES)]
    out = licenses.scan(spark.createDataFrame([(k, n) for k, _, n in notices], "doc_id long, text string")).collect()
    found = {r["doc_id"]: set(r["labels"].split(",")) - set(licenses.PHRASES.values()) for r in out}
    assert all(found[k] == {label} for k, label, _ in notices)


def test_line_spread_against_brute_force(docs, none):
    data = rows()
    sites = collections.defaultdict(set)
    for r in data:
        for line in (r[1] or "").split("\n"):
            if line.strip(" \t\r\x0b\x0c"):
                sites[line.strip(" \t\r\x0b\x0c")].add(r[3])
    many = {x for x, s in sites.items() if len(s) >= 3}
    assert BOILER in many
    out = line_spread.remove_boilerplate(docs, min_sites=3).collect()
    assert len(out) == len(data)
    kept = sum((r["text"] or "").split("\n").count(BOILER) for r in out)
    assert kept == 1                                     # the first place stays
    first = min(r[0] for r in data if r[0] is not None and BOILER in (r[1] or ""))
    assert any(r["doc_id"] == first and BOILER in r["text"] for r in out)
    gone = line_spread.remove_boilerplate(docs, min_sites=3, keep_first=False).collect()
    assert not any(BOILER in (r["text"] or "").split("\n") for r in gone)
    assert {r["doc_id"]: r["text"] for r in out}[2] is None
    assert line_spread.remove_boilerplate(none).count() == 0


def test_line_spread_near_threshold_is_exact(spark):
    ship(spark)
    data = [(k, f"line {s}", f"site{k}") for s in range(40, 60) for k in range(s)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = line_spread.remove_boilerplate(frame, min_sites=50, keep_first=False)
    gone = {r["text"] for r in frame.collect()} - {r["text"] for r in out.collect()}
    assert gone == {f"line {s}" for s in range(50, 60)}


def test_shards_against_brute_force(spark, docs, none):
    limit = 3000
    out = [r.asDict() for r in sharding.extendible_shards(docs, limit_bytes=limit, round_bits=2).collect()]
    data = rows()
    assert want((r["doc_id"], r["n_bytes"]) for r in out) == want((r[0], len((r[1] or "").encode())) for r in data)
    hashes = [(int(hashlib.md5(f"{'' if r[0] is None else r[0]}|{hashlib.md5((r[1] or '').encode()).hexdigest()}".encode())
                   .hexdigest()[:15], 16), len((r[1] or "").encode()), r[0]) for r in data]
    expected = []
    for h, size, i in hashes:
        for depth in range(61):
            own = [x for x in hashes if x[0] >> (60 - depth) == h >> (60 - depth)]
            if sum(x[1] for x in own) <= limit or len({x[0] for x in own}) == 1:
                expected.append((i, f"{h:060b}"[:depth], depth, size, sum(x[1] for x in own)))
                break
    assert want((r["doc_id"], r["shard"], r["depth"], r["n_bytes"], r["shard_bytes"]) for r in out) == want(expected)
    assert sharding.extendible_shards(none).count() == 0
    # a bucket of equal rows cannot split: it is cut into pages that fit
    same = spark.createDataFrame([(1, "x" * 100)] * 25 + [(2, "y")], "doc_id long, text string")
    pages = collections.Counter()
    for r in sharding.extendible_shards(same, limit_bytes=1000).collect():
        pages[r["shard"], r["page"]] += r["n_bytes"]
    assert sum(pages.values()) == 2501 and max(pages.values()) <= 1000


ITEM = ("Alice has 5 apples and buys 12 more apples from Bob at the market. How many apples does Alice have after she gives 3 kg "
        "of them to Carol in Paris yesterday evening and feeds 5 cats?")


def test_leaks_exact_and_reparameterised(spark, docs, none):
    ship(spark)
    items = spark.createDataFrame([(1, ITEM), (2, PROSE), (3, None), (4, ""), (5, "only four words here")],
                                  "item_id long, text string")
    changed = ITEM.replace("Alice", "Dora").replace("Bob", "Emil").replace("5", "7").replace("12", "30").replace("3 kg", "9 kg")
    torn = changed.replace("7 cats", "8 cats")            # one item value, two document values
    data = [(10, f"Before it. {ITEM} After it."), (11, f"Intro words here. {changed} The end."), (12, "unrelated " * 50), (13, None),
            (14, ""), (15, ITEM.upper()), (16, "x only four words here y"), (17, " ".join(ITEM.split()[:9]))]
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(
        spark.createDataFrame(data, "doc_id long, text string"), items).collect()}
    assert {(10, 1), (11, 1), (15, 1), (16, 5)} == set(found)
    assert found[10, 1]["exact"] and not found[11, 1]["exact"] and found[11, 1]["n_slots"] > 0
    part = decontaminate.leaks(spark.createDataFrame([(1, f"Intro words here. {torn} The end.")], "doc_id long, text string"), items)
    whole = found[11, 1]["n_tokens"]
    assert all(r["n_tokens"] < whole for r in part.collect())
    by_join = decontaminate.leaks(docs, items, max_windows=1000).select("doc_id", "item_id", "n_tokens")
    assert want(map(tuple, by_join.collect())) == want(
        map(tuple, decontaminate.leaks(docs, items).select("doc_id", "item_id", "n_tokens").collect()))
    assert {r["doc_id"] for r in by_join.collect()} == {0, 1, 6, 12}
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_no_tokenizer_file_in_the_repository():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert not [f for _, _, files in os.walk(root) for f in files if f.endswith((".tiktoken", "_49k.json", ".model"))]


def sentences(rnd, n):
    """Words of 60, each of which only three others follow."""
    order = [a + b for a in ("ri", "hou", "mo", "an", "lit", "bre") for b in ("ver", "se", "tain", "d", "tle", "ad", "win", "ter", "k", "gar")]
    k, out = rnd.randrange(60), []
    for _ in range(n):
        out.append(order[k])
        k = (7 * k + rnd.choice([1, 18, 41])) % 60
    return out


def test_quality_rejects_words_in_random_order(spark):
    import random
    ship(spark)
    rnd = random.Random(6)
    fluent = [(k, " ".join(sentences(rnd, 120)), "en") for k in range(200)]
    salad = []
    for k in range(10):
        w = fluent[k][1].split()
        rnd.shuffle(w)
        salad.append((1000 + k, " ".join(w), "en"))
    frame = spark.createDataFrame(fluent + salad, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in quality.judge(frame).collect()}
    assert all(out[1000 + k]["perplexity"] > 1.2 * out[k]["perplexity"] for k in range(10))
    plain = [out[k] for k in range(200) if not out[k]["base_failed"]]
    assert not any(out[1000 + k]["kept"] for k in range(10))
    assert len(plain) > 150 and sum(r["kept"] for r in plain) >= 0.97 * len(plain)
    joined = {r["doc_id"]: r for r in quality.judge(frame, max_model_bytes=0).collect()}
    assert all(abs(out[k]["perplexity"] - joined[k]["perplexity"]) < 1e-3 and out[k]["kept"] == joined[k]["kept"] for k in out)


def test_running_ranges_equal_one_range(monkeypatch):
    words = pa.array("a bb é the 🙂🙂 end x y z".split())
    points, ends = charmodel.running(words, np.array([0, 3, 3, 7, 9]), np.array([0, 2, 3]))
    total = collections.Counter()
    for _, grams, counts in charmodel.running_grams(points, ends, 4):
        total.update(dict(zip(grams, counts.tolist())))
    brute = collections.Counter()
    for s in ("\x02a bb é\x03", "\x02the 🙂🙂 end x\x03", "\x02y z\x03"):
        brute.update(s[max(0, i - 4):i + 1] for i in range(1, len(s)))
    assert total == brute
    monkeypatch.setattr(charmodel, "_RANGE", 5)
    pieces = collections.Counter()
    for _, grams, counts in charmodel.running_grams(points, ends, 4):
        for g, c in zip(grams, counts.tolist()):
            pieces[g] += c
    assert pieces == brute


def test_quality_copies_do_not_reject_clean_texts(spark):
    import random
    ship(spark)
    rnd = random.Random(12)
    easy = ["mountain", "walking", "winter", "garden", "little", "house", "bread", "river"]
    clean = [[rnd.choice(easy if k < 96 else "abcdefghijklmnopqrst") for _ in range(150)] for k in range(160)]
    data = [(k, " ".join(w), "en") for k, w in enumerate(clean)]
    # one text in a third of all rows, 55 % of its language
    same = " ".join(rnd.choice(easy + list("abcdefgh")) for _ in range(150))
    data += [(1000 + k, same, "en") for k in range(200)]
    data += [(2000 + k, " ".join(rnd.choice(["lune", "soleil", "maison", "et", "pain", "le"]) + str(rnd.randrange(9)) for _ in range(150)), "fr")
             for k in range(240)]
    out = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert not any(out[k]["base_failed"] for k in range(160))
    assert all(out[k]["kept"] for k in range(160))
    assert all(out[1000 + k]["kept"] for k in range(200))


def test_quality_copied_prose_stays(spark):
    import random
    ship(spark)
    rnd = random.Random(13)
    vocabulary = ["the", "river", "house", "mountain", "and", "little", "bread", "winter", "walking", "a", "of", "garden"]
    clean = [" ".join(rnd.choice(vocabulary) + rnd.choice(["", "", "", "s", "."]) for _ in range(150)) for _ in range(161)]
    data = [(k, x, "en") for k, x in enumerate(clean)] + [(1000 + k, clean[160], "en") for k in range(200)]
    out = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert sum(out[k] for k in range(161)) >= 157 and all(out[1000 + k] for k in range(200))


def leaked(spark, items, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(frame, bench).collect()}


def test_leaks_need_literal_words(spark):
    ship(spark)
    table = " ".join(str(7 * k + 3) for k in range(20))
    items = [f"Values {table} end.", "42", "Is 17 prime?", ITEM, "row 1 row 2 row 3 row 4 row 5 row 6 row 7 row 8"]
    texts = [" ".join(str(11 * k + 500) for k in range(60)),          # another number table
             f"see {table} here", "the answer is 42 of course", "we paid 43 of it", "is 19 prime?", "is 17 prime?",
             "row 21 row 22 row 23 row 24 row 25 row 26 row 27 row 28", ITEM.replace("12", "31")]
    assert leaked(spark, items, texts) == {(1, 0), (2, 1), (5, 2), (7, 3)}


def test_leaks_glued_units_and_names_of_several_words(spark):
    ship(spark)
    item = ("A shop raised prices by 15% when John Smith bought 6kg of rice for £3 and met McDonald at NASA after twenty five days "
            "at 20°c near a 5-year bond that paid $7.50 to O'Brien yesterday.")
    swaps = [("15%", "20 %"), ("John Smith", "Maria"), ("6kg", "12 kg"), ("£3", "€9"), ("McDonald", "Anna Lee"), ("NASA", "Berlin"),
             ("twenty five", "30"), ("20°c", "31 °c"), ("5-year", "2 month"), ("$7.50", "8 dollars"), ("O'Brien", "IBM")]
    changed = item
    for a, b in swaps:
        assert a in changed
        changed = changed.replace(a, b)
    texts = [f"Intro words here. {item.replace(a, b)} The end." for a, b in swaps] + [f"Intro words here. {changed} The end.", item.upper()]
    assert leaked(spark, [item], texts) == {(k, 0) for k in range(len(texts))}
    assert decontaminate._parts("(5-year-old),") == ["(5", "year", "old),"] and decontaminate._parts("3d") == ["3d"]
    found = decontaminate.leaks(spark.createDataFrame([(0, texts[-2]), (1, texts[0])], "doc_id long, text string"),
                                spark.createDataFrame([(0, item)], "item_id long, text string")).collect()
    tokens = {r["doc_id"]: (r["n_tokens"], r["item_tokens"]) for r in found}
    assert all(a == b for a, b in tokens.values()) and len(tokens) == 2


def test_licenses_broken_over_lines(spark):
    ship(spark)
    texts = ["Intro here.\nLicensed under the Apache License,\nVersion 2.0.\nmore", "x\nThis work is licensed under the Creative Commons\nAttribution "
             "4.0\nInternational License. y", "all\nrights\nreserved", "all\n\nrights reserved", "All rights reserved.\nAll rights reserved.",
             "all of us have\nno rights here and so\nnothing was left that is reserved"]
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [out[k]["labels"] for k in range(6)] == ["apache,apache-2.0", "cc-by-4.0", "rights-reserved", "", "rights-reserved", ""]
    assert abs(out[1]["score"] - 12 / 13) < 1e-9 and out[2]["score"] == 1.0
    assert [(m["first_word"], m["words"]) for m in out[4]["matches"]] == [(0, 3), (3, 3)]
    assert [(m["first_word"], m["words"]) for m in out[0]["matches"]] == [(2, 8)]


def test_dac_access_reads_only_the_blocks_asked_for(monkeypatch):
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 1 << 17, 400_000).astype(np.uint32)
    d = dac.Dac.unpack(dac.Dac.build(ids).pack())
    ones, looked = dac._ONES, []

    class Counted:
        def __getitem__(self, at):
            looked.append(np.size(at))
            return ones[at]

    monkeypatch.setattr(dac, "_ONES", Counted())
    at = rng.integers(0, len(ids), 100)
    assert (d.access(at) == ids[at]).all()
    assert sum(looked) <= len(d.levels) * 100 * (dac.BLOCK_BITS // 8 + 1) < len(ids) // 8
    every = np.arange(len(ids))
    assert (d.access(every) == ids).all() and (d.access(every[::-1]) == ids[::-1]).all()


def test_licenses_list_runs_that_overlap(spark):
    ship(spark)
    rng = np.random.default_rng(11)
    notice = "This work is licensed under a Creative Commons Attribution 4.0 International License."
    texts = [f"This work is licensed {notice}", f"{notice} License. {notice}", " ".join([notice] * 40)]
    own = {k: licenses.words_of(n) for k, (_, n, _) in enumerate(licenses.TEMPLATES) if len(set(licenses.words_of(n))) <= licenses.RUN_WORDS}
    for k in own:
        w = own[k] + own[k][:int(rng.integers(1, len(own[k]) + 1))] + own[k]
        del w[int(rng.integers(len(w)))]
        texts.append(" ".join(w))

    def every(text):
        """The longest run from each start, without those inside another."""
        w, out = licenses.words_of(text), set()
        for k, words in own.items():
            distinct, size, found = list(dict.fromkeys(words)), licenses.reach(len(words)), []
            signs = [" " + " ".join(licenses.words_of(x)) + " " for x in licenses.TEMPLATES[k][2]]
            for a in (a for a in range(len(w)) if w[a] in words):
                best = None
                for z in range(a + 1, min(a + size, len(w)) + 1):
                    first = [w[a:z].index(x) for x in distinct if x in w[a:z]]
                    if first == sorted(first) and len(first) >= 0.8 * len(distinct) - 1e-9 and all(x in f" {' '.join(w[a:z])} " for x in signs):
                        if best is None or len(first) > best[2] or not all(x in f" {' '.join(w[a:best[1]])} " for x in signs):
                            best = (a, z, len(first))
                if best:
                    found.append(best)
            out |= {(k, a, z - a, n / len(distinct)) for a, z, n in found
                    if not any((x, y) != (a, z) and x <= a and z <= y for x, y, _ in found)}
        return out

    out = {r["doc_id"]: r["matches"] for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    listed = {k: {(m["template"], m["first_word"], m["words"], m["containment"]) for m in ms if m["template"] in own} for k, ms in out.items()}
    assert {(m["first_word"], m["words"], m["containment"]) for m in out[0] if m["label"] == "cc-by-4.0"} == {(0, 16, 12 / 13), (4, 13, 1.0)}
    assert [listed[k] for k in range(len(texts))] == [every(x) for x in texts]


def test_model_keys_are_found_by_their_leading_bits():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        keys = np.unique(np.concatenate([rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2), np.arange(n, dtype=np.uint64),
                                         np.uint64((1 << 64) - 1) - np.arange(n, dtype=np.uint64)]))
        wanted = np.concatenate([keys, keys + np.uint64(1), keys ^ np.uint64(1 << 40), np.array([0, 7, (1 << 64) - 1], np.uint64)])
        at, known = charmodel.Keys(keys).find(wanted)
        assert (known == np.isin(wanted, keys)).all() and (keys[at[known]] == wanted[known]).all()


def test_symbol_hashes_of_all_planes():
    points = np.array([0, 2, 97, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF], np.uint32)
    assert (charmodel._hash_symbols(points) == mix(points.astype(np.uint64) + np.uint64(1))).all()


def test_suffix_tree_keeps_little_on_disk(spark):
    """Copies ask for their grams once a block, and tables of the learning are gone when the texts are scored."""
    from pathlib import Path

    from basketry.session import ensure_checkpoint_dir

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    rng = np.random.default_rng(5)
    text = " ".join("".join(chr(97 + x) for x in rng.integers(26, size=5)) for _ in range(4000))
    ids = [k for k in range(200) if not suffix_tree.held_out(k)]

    def kept(copies):
        old = {p.name for p in folder.iterdir()} if folder.is_dir() else set()
        docs = spark.createDataFrame([(k, text) for k in ids[:copies]], "doc_id long, text string").coalesce(1)
        out = suffix_tree.score_texts(docs, depth=2, max_model_bytes=0).collect()
        assert len({(round(r["score"], 4), r["held_out"]) for r in out}) == 1 and len(out) == copies
        new = [p for p in folder.iterdir() if p.name not in old]
        return {p.name.rsplit("-", 1)[0] for p in new}, sum(f.stat().st_size for p in new for f in p.rglob("*.parquet"))

    (names, one), (_, many) = kept(1), kept(60)
    assert not names & {"counts", "level", "states", "probabilities"}
    assert many < 3 * one


def test_licenses_list_blocks_without_their_phrase(spark):
    """Blocks at the threshold that lack a telling phrase get no label, but are found."""
    isc = next(n for label, n, _ in licenses.TEMPLATES if label == "isc")
    notice = "This work is licensed under a Creative Commons Attribution 4.0 International License."
    texts = [isc.replace("without fee", "without charge"), "Intro.\n\n" + notice.replace("4.0", "5.0"), isc, notice, "nothing here"]
    data = list(enumerate(texts))
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    of = lambda k, column: {(m["label"], m["first_word"], m["words"], round(m["containment"], 9)) for m in out[k][column]}
    w = len(set(licenses.words_of(isc)))
    assert of(0, "near") == {("isc", 0, len(licenses.words_of(isc)), round((w - 1) / w, 9))}
    assert ("cc-by-4.0", 1, 13, round(12 / 13, 9)) in of(1, "near")
    assert all(not out[k]["matches"] and out[k]["labels"] == "" and out[k]["score"] == 0 for k in (0, 1, 4))
    assert {x[0] for x in of(2, "matches")} == {"isc"} and not of(2, "near")
    assert "cc-by-4.0" in {x[0] for x in of(3, "matches")} and "cc-by-4.0" not in {x[0] for x in of(3, "near")}
    assert not out[4]["near"]
