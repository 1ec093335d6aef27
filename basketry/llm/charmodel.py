"""Character models: gram counts, sorted hash arrays, scoring.

A string is read as a start mark, its characters and an end mark; a character's
context never reaches beyond the start mark.  The strings are words (a word's
probability does not depend on its neighbours, and each distinct word is counted
and scored once) or running texts (``running``: words joined by single spaces,
contexts run across them, and each position is counted and scored).
A model is two tables: ``grams`` (grp, ctx, sym, logp) with interpolated log10
probabilities and ``contexts`` (grp, ctx, logw) with the log10 weight a context
leaves to its next shorter one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import batches, mix, spread

START, END = "\x02", "\x03"
#: any character a model has not seen shares its unseen mass with this many others
CODE_POINTS = 1_114_112
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: positions of running texts counted and scored at once, to bound the arrays
_RANGE, _SCORED = 1 << 19, 1 << 18
_POWERS = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(65)]


def symbols(words: list[str], marks: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words (with marks) and each word's offsets."""
    if marks:
        joined = "".join([f"{START}{w}{END}" for w in words])
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    else:
        joined = "".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(lengths)])


#: hashes of the code points below 2^16
_HASHES = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def _hash_symbols(points: np.ndarray) -> np.ndarray:
    out = _HASHES[points & 0xFFFF]
    high = np.flatnonzero(points >> 16)
    if len(high):
        out[high] = mix(points[high].astype(np.uint64) + np.uint64(1))
    return out


def context_hashes(words: list[str], group: int) -> np.ndarray:
    """Keys of whole strings read as contexts (last character nearest)."""
    points, offsets = symbols(words, marks=False)
    h, length = _hash_symbols(points), np.diff(offsets)
    out = np.zeros(len(words), np.uint64)
    for k in range(int(length.max(initial=0))):
        has = length > k
        out[has] += h[offsets[1:][has] - 1 - k] * _POWERS[k]
    return _context_key(out, length.astype(np.uint64), group)


def _context_key(h: np.ndarray, length, group: int) -> np.ndarray:
    length = np.asarray(length, np.int64)
    kinds = mix(np.arange(int(length.max(initial=0)) + 1, dtype=np.uint64) + np.uint64(group << 8))
    return mix(h ^ kinds[length])


def _gram_key(context: np.ndarray, symbol_hash: np.ndarray) -> np.ndarray:
    return mix(context + symbol_hash * _BASE)


def gram_counts(words: list[str], weights: np.ndarray, depth: int) -> tuple[list[str], np.ndarray]:
    """Weighted counts of the longest gram at each position: up to ``depth``
    context characters (from the start mark on) and the character itself."""
    points, offsets = symbols(words)
    lengths = np.diff(offsets) - 1
    at = spread(offsets[:-1] + 1, lengths)
    begin = np.maximum(np.repeat(offsets[:-1], lengths), at - depth)
    h = _hash_symbols(points)
    key = np.zeros(len(at), np.uint64)
    for k in range(depth + 1):
        has = at - k >= begin
        key[has] += h[at[has] - k] * _POWERS[k]
    key = mix(key ^ (at - begin).astype(np.uint64))
    _, first, own = np.unique(key, return_index=True, return_inverse=True)
    counts = np.bincount(own, weights=np.repeat(weights, lengths).astype(np.float64)).astype(np.int64)
    text = points.tobytes().decode("utf-32-le", "surrogatepass")
    return [text[a:b + 1] for a, b in zip(begin[first].tolist(), at[first].tolist())], counts


def running(words: pa.Array, offsets: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points (with marks) and offsets of the texts ``some``, their words joined by spaces."""
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words)
    return symbols(pc.binary_join(lists.take(pa.array(some)), " ").to_pylist())


def _histories(points: np.ndarray, offsets: np.ndarray, a: int, b: int, depth: int):
    """Positions ``a`` to ``b`` but for start marks: text, place in the symbol
    hashes, length and hash of the history, and those symbol hashes."""
    low = max(a - depth, 0)
    h = np.concatenate([np.zeros(depth - (a - low), np.uint64), _hash_symbols(points[low:b])])
    t, z = int(np.searchsorted(offsets, a, side="right")) - 1, int(np.searchsorted(offsets, b))
    text = np.repeat(np.arange(t, z), np.diff(np.clip(offsets[t:z + 1], a, b)))
    reach = np.minimum(np.arange(a, b) - offsets[text], depth)
    history = np.zeros(b - a, np.uint64)
    for k in range(depth):
        history += h[depth - 1 - k:depth - 1 - k + b - a] * _POWERS[k]
    near = np.flatnonzero(reach < depth)        # histories that a start mark cuts
    history[near] = 0
    for k in range(depth):
        history[near] += h[near + (depth - 1 - k)] * _POWERS[k] * (reach[near] > k)
    at = np.flatnonzero(reach)
    return text[at], at + depth, reach[at], history[at], h


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the keys, and the first place of each code."""
    codes, kinds = pd.factorize(key)
    first = np.empty(len(kinds), np.int64)
    first[codes[::-1]] = np.arange(len(key) - 1, -1, -1)
    return codes, first


def running_grams(points: np.ndarray, offsets: np.ndarray, depth: int,
                  apart: bool = False) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """(text, gram, count) of the longest grams of running texts, in pieces that
    may repeat a gram; ``apart`` counts each text by itself, else text means nothing."""
    for a in range(0, len(points), _RANGE):
        b = min(a + _RANGE, len(points))
        text, at, reach, history, h = _histories(points, offsets, a, b, depth)
        key = mix(_gram_key(mix(history), h[at]) ^ reach.astype(np.uint64))
        codes, first = distinct(mix(key + text.astype(np.uint64) * _BASE) if apart else key)
        low = max(a - depth, 0)
        chars = points[low:b].tobytes().decode("utf-32-le", "surrogatepass")
        end = at[first] - depth + a - low
        yield text[first], [chars[x:y] for x, y in zip((end - reach[first]).tolist(), (end + 1).tolist())], np.bincount(
            codes, minlength=len(first))


def level_counts(grams: DataFrame, depth: int, continuation: bool,
                 keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[DataFrame]:
    """Counts per context length 0..depth as (grp, gram, c), from the longest grams.

    With ``continuation`` a shorter gram counts its distinct left neighbours
    (Kneser-Ney), else its occurrences; grams from the start mark on have no
    left neighbour and count occurrences in either case.  ``keep`` may write a
    level before the next one is made from it.
    """
    levels = {depth: grams.where(F.length("gram") == depth + 1)}
    for k in range(depth - 1, -1, -1):
        longer = levels[k + 1].select("grp", F.expr("substring(gram, 2)").alias("gram"),
                                      (F.lit(1).cast("long") if continuation else F.col("c")).alias("c"))
        levels[k] = keep(longer.unionByName(grams.where(F.length("gram") == k + 1)).groupBy("grp", "gram").agg(
            F.sum("c").alias("c")))
    return [levels[k] for k in range(depth + 1)]


def split_gram(level: DataFrame) -> DataFrame:
    return level.select("grp", F.expr("substring(gram, 1, length(gram) - 1)").alias("ctx"),
                        F.expr("right(gram, 1)").alias("sym"), "c")


class Keys:
    """Sorted hashes, with the place where each value of their leading bits
    begins: a look-up goes there at once and tries the few keys behind it."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.full((1 << bits) + 1, len(keys), np.int32)
        for a in range(0, 1 << bits, 1 << 16):      # in pieces, to bound the arrays
            b = min(a + (1 << 16), 1 << bits)
            self.first[a:b] = np.searchsorted(keys, np.arange(a, b, dtype=np.uint64) << self.shift)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the wanted keys, and which of them are there."""
        lead = (wanted >> self.shift).astype(np.int64)
        at, stop = self.first[lead], self.first[lead + 1]
        known = np.zeros(len(wanted), bool)
        left = np.flatnonzero(at < stop)
        while len(left):
            same = self.keys[at[left]] == wanted[left]
            known[left[same]] = True
            left = left[~same]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return at, known


class HashModel:
    """The two tables of a model in sorted hash arrays."""

    def __init__(self, grams: tuple[np.ndarray, np.ndarray], contexts: tuple[np.ndarray, np.ndarray],
                 groups: list[str], depth: int):
        self.depth = depth
        self.groups = {g: k for k, g in enumerate(groups)}
        self.keys, self.logp = grams
        self.ckeys, self.logw = contexts

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_index"}

    def _find(self) -> tuple[Keys, Keys]:
        """Grams and contexts, indexed once in each process."""
        if "_index" not in self.__dict__:
            self._index = Keys(self.keys), Keys(self.ckeys)
        return self._index

    def score(self, words: list[str], group: str) -> np.ndarray:
        """log10 probability of each word (an unknown group scores nan)."""
        if group not in self.groups:
            return np.full(len(words), np.nan)
        out = np.empty(len(words))
        size, a = 0, 0
        for k, w in enumerate(words):  # pieces of about a million characters bound the arrays
            size += len(w) + 2
            if size > 1 << 20 or k == len(words) - 1:
                out[a:k + 1] = self._score(words[a:k + 1], self.groups[group])
                a, size = k + 1, 0
        return out

    def _score(self, words: list[str], group: int) -> np.ndarray:
        points, offsets = symbols(words)
        lengths = np.diff(offsets) - 1
        h = _hash_symbols(points)
        at = spread(offsets[:-1] + 1, lengths)
        reach = np.minimum(at - np.repeat(offsets[:-1], lengths), self.depth)
        longest = np.zeros(len(at), np.uint64)
        for k in range(self.depth):
            has = reach > k
            longest[has] += h[at[has] - 1 - k] * _POWERS[k]
        # positions with the same history and symbol are looked up once
        key = _gram_key(_context_key(longest, reach.astype(np.uint64), group), h[at])
        _, first, own = np.unique(key, return_index=True, return_inverse=True)
        logp = self._lookup(h, at[first], reach[first], group)[own]
        total = np.concatenate([[0.0], np.cumsum(logp)])
        ends = np.cumsum(lengths)
        return total[ends] - total[ends - lengths]

    def score_running(self, points: np.ndarray, offsets: np.ndarray, group: str) -> np.ndarray:
        """log10 probability of each running text (an unknown group scores nan)."""
        out = np.full(len(offsets) - 1, 0.0 if group in self.groups else np.nan)
        for a in range(0, len(points) if group in self.groups else 0, _SCORED):
            text, at, reach, history, h = _histories(points, offsets, a, min(a + _SCORED, len(points)), self.depth)
            codes, first = distinct(_gram_key(_context_key(history, reach.astype(np.uint64), self.groups[group]), h[at]))
            logp = self._lookup(h, at[first], reach[first], self.groups[group])[codes]
            if len(text):
                out[text[0]:text[-1] + 1] += np.bincount(text - text[0], weights=logp)
        return out

    def look_up(self, points: np.ndarray, at: np.ndarray, reach: np.ndarray, group: str = "") -> np.ndarray:
        """log10 probability of ``points[at]``, each after the ``reach`` symbols before it."""
        if not len(at):
            return np.zeros(0)
        low = max(int(at.min()) - self.depth, 0)
        return self._lookup(_hash_symbols(points[low:int(at.max()) + 1]), at - low, reach, self.groups[group])

    def _lookup(self, h: np.ndarray, at: np.ndarray, reach: np.ndarray, group: int) -> np.ndarray:
        """log10 probability of the symbol at each position, from the longest context known."""
        context = [np.zeros(len(at), np.uint64)]
        for k in range(self.depth):
            step = context[-1].copy()
            has = np.flatnonzero(reach > k)
            step[has] += h[at[has] - 1 - k] * _POWERS[k]
            context.append(step)
        grams, contexts = self._find()
        symbol = h[at] * _BASE
        logp, open_ = np.zeros(len(at)), np.arange(len(at))
        for k in range(self.depth, -1, -1):
            here = open_ if k == 0 else open_[reach[open_] >= k]
            key = _context_key(context[k][here], np.uint64(k), group)
            # a known gram has a known context
            place, found = grams.find(mix(key + symbol[here]))
            logp[here[found]] += self.logp[place[found]]
            place, known = contexts.find(key[~found])
            logp[here[~found][known]] += self.logw[place[known]]
            done = np.zeros(len(at), bool)
            done[here[found]] = True
            open_ = open_[~done[open_]]
        logp[open_] -= np.log10(CODE_POINTS)
        return logp


def _hashed(rows: DataFrame, groups: list[str], value: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys (sorted) and values of a table, hashed on the executors."""
    grams = "sym" in rows.columns
    index = {g: k for k, g in enumerate(groups)}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            group, ctx = np.array([index[g] for g in batch.column(0).to_pylist()]), batch.column(1).to_pylist()
            key = np.zeros(len(ctx), np.uint64)
            for g in np.unique(group).tolist():
                some = np.flatnonzero(group == g)
                key[some] = context_hashes([ctx[k] for k in some.tolist()], g)
            if grams:
                points, _ = symbols(batch.column(3).to_pylist(), marks=False)
                key = _gram_key(key, _hash_symbols(points))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(2).cast(pa.float32())], ["key", "value"])

    picked = rows.select("grp", "ctx", value, *(["sym"] if grams else []))
    out = picked.mapInArrow(run, "key long, value float").toArrow()
    key, values = out["key"].to_numpy().view(np.uint64), out["value"].to_numpy()
    order = np.argsort(key)
    return key[order], values[order]


def collect_model(grams: DataFrame, contexts: DataFrame, depth: int, max_bytes: int) -> HashModel | None:
    """The model in sorted hash arrays, or None if it has more than ``max_bytes``
    (12 bytes per entry); nothing above that size reaches the driver."""
    if 12 * (grams.count() + contexts.count()) > max_bytes:
        return None
    groups = sorted(r["grp"] for r in contexts.select("grp").distinct().collect())
    return HashModel(_hashed(grams, groups, "logp"), _hashed(contexts, groups, "logw"), groups, depth)


def score_words(words: DataFrame, grams: DataFrame, contexts: DataFrame, depth: int,
                max_bytes: int = 256 << 20) -> DataFrame:
    """(grp, word) -> (grp, word, logp): by the broadcast hash arrays if they fit
    ``max_bytes``, else by joins with the two tables; both give the same values."""
    model = collect_model(grams, contexts, depth, max_bytes)
    if model is None:
        return score_by_join(words, grams, contexts, depth)
    held = words.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            groups, words_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = np.empty(len(words_))
            for g in set(groups):
                some = [k for k, x in enumerate(groups) if x == g]
                out[some] = held.value.score([words_[k] for k in some], g)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["grp", "word", "logp"])

    return words.select("grp", "word").mapInArrow(run, "grp string, word string, logp double")


def score_by_join(words: DataFrame, grams: DataFrame, contexts: DataFrame, depth: int) -> DataFrame:
    """The scores of ``HashModel`` by hash joins, for models of any size."""
    known = grams.select("grp").distinct()
    marked = words.select("grp", "word", F.concat(F.lit(START), "word", F.lit(END)).alias("s"))
    at = marked.select("*", F.explode(F.expr("sequence(1, length(s) - 1)")).alias("i"))
    tries = at.select("grp", "word", "i", F.explode(F.expr(f"sequence(0, least(i, {depth}))")).alias("k"), "s").select(
        "grp", "word", "i", "k", F.expr("substring(s, i - k + 1, k)").alias("ctx"), F.expr("substring(s, i + 1, 1)").alias("sym"))
    steps = _tried(tries, ["grp", "word", "i"], grams, contexts)
    scored = steps.groupBy("grp", "word").agg(F.sum("logp").alias("logp"))
    return words.select("grp", "word").join(scored, ["grp", "word"]).join(known.withColumn("known", F.lit(True)), "grp", "left").select(
        "grp", "word", F.when(F.col("known"), F.col("logp")).otherwise(F.lit(float("nan"))).alias("logp"))


def grams_by_join(asked: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(grp, gram, logp) of the last symbol of each (grp, gram) after the others, by hash joins."""
    tries = asked.select("grp", "gram", F.explode(F.expr("sequence(0, length(gram) - 1)")).alias("k")).select(
        "grp", "gram", "k", F.expr("substring(gram, length(gram) - k, k)").alias("ctx"), F.expr("right(gram, 1)").alias("sym"))
    return _tried(tries, ["grp", "gram"], grams, contexts)


def _tried(tries: DataFrame, key: list[str], grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(key, logp) from the contexts (ctx of length k, sym) tried for each key."""
    # a known gram has a known context
    looked = (tries.join(contexts.select("grp", "ctx", "logw", F.lit(True).alias("held")), ["grp", "ctx"], "left").where("held OR k = 0")
              .join(grams.select("grp", "ctx", "sym", "logp"), ["grp", "ctx", "sym"], "left"))
    hit = F.max(F.when(F.col("logp").isNotNull(), F.col("k")))
    steps = looked.groupBy(*key).agg(
        hit.alias("hit"), F.max_by("logp", F.when(F.col("logp").isNotNull(), F.col("k"))).alias("logp"),
        F.collect_list(F.when(F.col("logw").isNotNull(), F.struct("k", "logw"))).alias("w"))
    passed = F.aggregate(F.filter("w", lambda x: x["k"] > F.coalesce(F.col("hit"), F.lit(-1))), F.lit(0.0),
                         lambda a, x: a + x["logw"])
    return steps.select(*key, (passed + F.coalesce("logp", F.lit(-float(np.log10(CODE_POINTS))))).alias("logp"))
