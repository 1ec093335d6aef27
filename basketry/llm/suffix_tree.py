"""Probabilistic suffix tree for texts: characters of running text, contexts by divergence.

A text is read as a start mark, its lower-case words joined by single spaces and
an end mark; a symbol is a character.  Contexts are the up to ``depth``
characters before it, across word ends, so a token is scored from the words
before it.  All counts are occurrences in the whole training text.  A context is
retained if it is frequent and its next-symbol counts diverge from those of its
suffix (count-weighted Kullback-Leibler divergence); with it go all its
suffixes, so the longest retained suffix of a history is found by walking down.
States are smoothed with their parent (Witten-Bell), the root with a uniform
distribution over all code points.  A text's score is the log10 probability of
all its characters and its end.

The base counts whole words.  Each Arrow batch of documents is a block, packed
in one row: its texts as codes of its distinct words.  The words are requests
that meet where they are summed and come back to the block, so no vocabulary is
broadcast.  The grams of a block ask likewise if the tree is not broadcast: once
each, and the block's texts are made from its words again when the answers come.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import charmodel
from basketry.llm.common import (batches, discard, encode, give_back, materialise, owners, per_text, pick, split_words,
                                 string_array, texts)

BLOCK_BYTES = 16 << 20
#: positions counted and scored at once: more repeat each other more, and bound the arrays
_PIECE = 1 << 20
#: distinct grams held by a counting task before it passes them on, or by a scoring task
_HOLD = 1 << 20
#: numbers of windows held by a task before it begins anew
_NUMBERS = 1 << 19
#: words of the texts turned into code points at once, or one longer text
_WORDS = 1 << 19
#: requests of a block in an Arrow batch
_ASKED = 1 << 17
#: a block's row is large: files are cut by size after each
_LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size": str(32 << 20)}
#: of a block a row each for its texts, words and grams
BLOCKS = "block long, kind string, n_train long, ends long, docs binary, codes binary, asked binary"


def held_out(doc_id) -> bool:
    """Every tenth document by the CRC-32 of its id's text (a null id: of the empty text)."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def _packed(**columns) -> bytes:
    """Columns of one length, compressed."""
    rows = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(raw).read_next_batch()


def _packed_codes(codes: np.ndarray) -> bytes:
    """Codes (below 2^24: a block has fewer words) as two planes: the low 16 bits
    and the mostly empty high 8 bits, which compress away."""
    return _packed(low=(codes & 0xFFFF).astype(np.uint16), high=(codes >> 16).astype(np.uint8))


def _unpacked_codes(raw: bytes) -> np.ndarray:
    rows = _unpacked(raw)
    return rows["low"].to_numpy().astype(np.int64) | rows["high"].to_numpy().astype(np.int64) << 16


def _requests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, packed) -> a row for each request: block, code (its number in the block) and the packed columns."""
    for batch in batches(rows):
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            asked = _unpacked(raw.as_py())
            for a in range(0, asked.num_rows, _ASKED):
                some = asked.slice(a, _ASKED)
                code = np.arange(a, a + some.num_rows, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), block)), pa.array(code), *some.columns],
                                                 ["block", "code", *some.schema.names])


def _packed_answers(hold: int = 200_000):
    """(block, code, value, first) -> rows of n answers to one block, by code and compressed, and how many are the first of their kind."""
    squeezed = lambda x: pa.compress(np.ascontiguousarray(x), codec="zstd", asbytes=True)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            block, code, value, first = (t[k].to_numpy() for k in ("block", "code", "value", "first"))
            order = np.lexsort((code, block))
            block = block[order]
            cut = _changes(block).tolist() + [len(block)]
            parts = [order[a:b] for a, b in zip(cut, cut[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(block[cut[:-1]]), pa.array([len(p) for p in parts], pa.int32()),
                 pa.array([squeezed(np.diff(code[p].astype("<i4"), prepend=np.int32(0))) for p in parts], pa.binary()),
                 pa.array([squeezed(value[p]) for p in parts], pa.binary()), pa.array([int(first[p].sum()) for p in parts])],
                ["asker", "n", "code", "value", "kinds"])

        size = 0
        for batch in batches(rows):
            held.append(batch)
            size += batch.num_rows
            if size >= hold:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


class _Numbers:
    """Numbers of values, kept from call to call; the value 0 has the number 0."""

    def __init__(self):
        self.values = np.zeros(1, np.int64)             # by number
        self.sorted, self.numbers = self.values, self.values

    def __call__(self, values: np.ndarray) -> np.ndarray:
        codes, kinds = pd.factorize(values)
        at = np.searchsorted(self.sorted, kinds)
        new = np.sort(kinds[self.sorted[np.minimum(at, len(self.sorted) - 1)] != kinds])
        if len(new):
            at = np.searchsorted(self.sorted, new)
            self.numbers = np.insert(self.numbers, at, np.arange(len(self.values), len(self.values) + len(new)))
            self.sorted = np.insert(self.sorted, at, new)
            self.values = np.concatenate([self.values, new])
        return self.numbers[np.searchsorted(self.sorted, kinds)][codes]


class Grams:
    """The longest grams of running texts as integers, equal in all pieces if the grams are.

    A gram is cut from its end into windows of three symbols (a code point plus 1,
    or 0 before the text), which have numbers; beyond two windows, pairs of numbers
    have numbers too.  ``full`` tells when to ``clear`` them, which makes integers
    new: a piece adds less than 2^20 + 2^4 numbers, so numbers stay below 2^21.
    """

    def __init__(self, depth: int):
        self.depth = depth
        self.sizes = [depth % 3 + 1] + [3] * (depth // 3)       # oldest window first
        self.clear()

    def clear(self) -> None:
        self.windows = {size: _Numbers() for size in self.sizes}
        self.pairs = [_Numbers() for _ in self.sizes[2:]]

    def full(self) -> bool:
        return any(len(x.values) > _NUMBERS for x in (*self.windows.values(), *self.pairs))

    def pieces(self, points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first position, integers of the grams that end at it and after it); a start mark has 0."""
        for a in range(0, len(points), _PIECE):
            b = min(a + _PIECE, len(points))
            low, n = max(a - self.depth, 0), b - a
            symbol = np.concatenate([np.zeros(self.depth - (a - low), np.int64), points[low:b].astype(np.int64) + 1])
            begin = offsets[np.searchsorted(offsets, low):np.searchsorted(offsets, b)]
            reach = np.tile(np.arange(self.depth + 1), len(begin))
            near = begin.repeat(self.depth + 1) + reach         # places that few symbols of their text precede
            near, reach = near[near < b] - a, reach[near < b]
            numbers: dict[int, tuple[np.ndarray, int]] = {}
            key = None
            for k, size in enumerate(self.sizes):
                back = 3 * (len(self.sizes) - 1 - k)            # symbols between the window and the gram's end
                if size not in numbers:
                    window = symbol[self.depth - back:].copy()
                    for j in range(1, size):
                        older = symbol[self.depth - back - j:len(symbol) - j].copy()
                        cut = near[reach < j] + back
                        older[cut[cut >= 0]] = 0
                        window |= older << (21 * j)
                    numbers[size] = self.windows[size](window), back
                own, first = numbers[size]
                own = own[first - back:first - back + n]
                if back:
                    own = own.copy()
                    cut = near[reach < back]
                    own[cut[cut >= 0]] = 0
                if k > 1:
                    key = self.pairs[k - 2](key)
                key = own if key is None else key << 21 | own
            key = key.copy()
            key[near[(reach == 0) & (near >= 0)]] = 0
            yield a, key

    def texts(self, keys: np.ndarray) -> pa.Array:
        """The grams of the integers."""
        points = np.zeros((len(keys), self.depth + 1), np.int64)
        end = self.depth + 1
        for k in range(len(self.sizes) - 1, -1, -1):
            window = self.windows[self.sizes[k]].values[keys & 0x1FFFFF if k else keys]
            for j in range(self.sizes[k]):
                points[:, end - 1 - j] = window >> (21 * j) & 0x1FFFFF
            end -= self.sizes[k]
            if k:
                keys = keys >> 21
            if k > 1:
                keys = self.pairs[k - 2].values[keys]
        real = points > 0
        points -= 1
        width = (real * (1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))).sum(axis=1)
        data = points[real].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        return string_array(np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(width)]))


def _by_code(answers: pa.Table, kind: str) -> np.ndarray:
    """The values of a block's packed answers, in the order of their codes."""
    n = answers["n"].to_pylist()
    out = np.empty(sum(n), kind)
    for size, code, value in zip(n, answers["code"].to_pylist(), answers["value"].to_pylist()):
        code = np.cumsum(np.frombuffer(pa.decompress(code, 4 * size, "zstd"), "<i4"))
        out[code] = np.frombuffer(pa.decompress(value, 8 * size, "zstd"), kind)
    return out


def _changes(ordered: np.ndarray) -> np.ndarray:
    """Where equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]]))


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers of a piece in their order, and how often each occurs."""
    key = np.sort(key)
    key = key[np.searchsorted(key, 1):]                 # without start marks
    cut = _changes(key)
    return key[cut], np.diff(np.append(cut, len(key)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    key, count = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key)
    key, count = key[order], count[order]
    cut = _changes(key)
    return key[cut], np.add.reduceat(count, cut) if len(cut) else count


def running_grams(points: np.ndarray, offsets: np.ndarray, depth: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """(grams, counts) of the longest grams, in pieces that may repeat a gram."""
    grams = Grams(depth)
    for _, key in grams.pieces(points, offsets):
        kinds, counts = _counted(key)
        yield grams.texts(kinds).to_pylist(), counts
        if grams.full():
            grams.clear()


class RunningScores:
    """log10 probabilities of running texts; a gram met before is not looked up again."""

    def __init__(self, model: charmodel.HashModel):
        self.model, self.grams = model, Grams(model.depth)
        self.clear()

    def clear(self) -> None:
        self.grams.clear()
        self.known, self.logp = np.zeros(1, np.int64), np.zeros(1)      # start marks cost nothing

    def __call__(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros(len(offsets) - 1)
        for a, key in self.grams.pieces(points, offsets):
            n, bits = len(key), len(key).bit_length()
            both = np.sort(key << bits | np.arange(n))
            at, key = both & ((1 << bits) - 1), both >> bits
            cut = _changes(key)
            kinds = key[cut]
            place = np.searchsorted(self.known, kinds)
            new = self.known[np.minimum(place, len(self.known) - 1)] != kinds
            if new.any():
                first = at[cut[new]] + a
                reach = np.minimum(first - offsets[np.searchsorted(offsets, first, side="right") - 1], self.model.depth)
                self.logp = np.insert(self.logp, place[new], self.model.look_up(points, first, reach))
                self.known = np.insert(self.known, place[new], kinds[new])
                place += np.cumsum(new) - new
            logp = np.empty(n)
            logp[at] = np.repeat(self.logp[place], np.diff(np.append(cut, n)))
            t, z = int(np.searchsorted(offsets, a, side="right")) - 1, int(np.searchsorted(offsets, a + n))
            out[t:z] += np.add.reduceat(logp, np.maximum(offsets[t:z], a) - a)
            if self.grams.full() or len(self.known) > _HOLD:
                self.clear()
        return out


class _Asked:
    """In place of a model: notes the grams that are looked up."""

    def __init__(self, depth: int):
        self.depth, self.grams = depth, []

    def look_up(self, points: np.ndarray, at: np.ndarray, reach: np.ndarray) -> np.ndarray:
        low = max(int(at.min()) - self.depth, 0)
        chars = points[low:int(at.max()) + 1].tobytes().decode("utf-32-le", "surrogatepass")
        self.grams.append(pa.array([chars[a:b] for a, b in zip((at - reach - low).tolist(), (at + 1 - low).tolist())], pa.string()))
        return np.zeros(len(at))


class _Answered:
    """In place of a model: the answers to the grams noted, which are looked up in the same order."""

    def __init__(self, depth: int, logp: np.ndarray):
        self.depth, self.logp, self.used = depth, logp, 0

    def look_up(self, points: np.ndarray, at: np.ndarray, reach: np.ndarray) -> np.ndarray:
        self.used += len(at)
        return self.logp[self.used - len(at):self.used]


def _words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    return split_words(pc.ascii_lower(texts(batch.column(1))))


def _runs(words: pa.Array, offsets: np.ndarray, some: np.ndarray):
    """Runs of the texts ``some``, each with its code points and offsets."""
    run = np.cumsum(np.diff(offsets)[some]) // _WORDS
    for part in np.split(some, np.flatnonzero(np.diff(run)) + 1):
        yield part, *charmodel.running(words, offsets, part)
        give_back()


def _held(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([held_out(i) for i in batch.column(0).to_pylist()], bool)


def blocks(docs: DataFrame, model, depth: int) -> DataFrame:
    """Documents (doc_id, text) in blocks.  A block has a row for its texts (ids, sizes,
    scores, words as codes, and how many words and texts are not held out) and one
    for its distinct words with their occurrences in documents that are not held
    out.  Without a broadcast model its distinct grams follow instead of scores."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def row(**columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([columns.get(c)], kind) for c, kind in zip(names, kinds)], names)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        running_scores = None if model is None else RunningScores(model.value)
        for k, batch in enumerate(batches(rows, text=1, max_bytes=BLOCK_BYTES)):
            words, offsets = _words(batch)
            held, n = _held(batch), batch.num_rows
            asked = None if model is not None else _Asked(depth)
            scores = RunningScores(asked) if running_scores is None else running_scores
            score = np.zeros(n)
            for some, points, starts in _runs(words, offsets, np.arange(n)):
                score[some] = scores(points, starts)
            codes, vocabulary = encode(words)
            # the most frequent words get the smallest codes
            order = np.argsort(-np.bincount(codes, minlength=len(vocabulary)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            codes, vocabulary = rank[codes], vocabulary.take(pa.array(order))
            seen = np.bincount(codes[~held[owners(offsets)]], minlength=len(vocabulary)).astype(np.int64)
            block = (part << 32) + k
            yield row(block=block, kind="texts", n_train=int(seen.sum()), ends=int((~held).sum()), codes=_packed_codes(codes), docs=_packed(
                doc_id=batch.column(0).cast(pa.int64()), held_out=held, n_words=np.diff(offsets), score=score))
            yield row(block=block, kind="words", asked=_packed(word=vocabulary, seen=seen))
            if asked is not None:
                yield row(block=block, kind="grams", asked=_packed(gram=pa.chunked_array(asked.grams, pa.string()).combine_chunks()))

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def count_grams(docs: DataFrame, depth: int) -> DataFrame:
    """(grp, gram, c): occurrences of the longest grams in the texts of (doc_id,
    text) that are not held out, pre-summed in each task; ``grp`` is empty."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[tuple[np.ndarray, np.ndarray]] = []
        held = Grams(depth)

        def out() -> Iterator[pa.RecordBatch]:
            kinds, counts = _merged(own)
            for a in range(0, len(kinds), 1 << 17):
                some = held.texts(kinds[a:a + (1 << 17)])
                yield pa.RecordBatch.from_arrays([some, pa.array(counts[a:a + (1 << 17)])], ["gram", "c"])

        for batch in batches(rows, text=1, max_bytes=BLOCK_BYTES):
            words, offsets = _words(batch)
            for _, points, starts in _runs(words, offsets, np.flatnonzero(~_held(batch))):
                for _, key in held.pieces(points, starts):
                    own.append(_counted(key))
                    if sum(len(kinds) for kinds, _ in own[1:]) > _HOLD:
                        own = [_merged(own)]
                    if len(own[0][0]) > _HOLD or held.full():
                        yield from out()
                        own = []
                    if held.full():
                        held.clear()
        if own:
            yield from out()

    # a task has summed its grams: they are dealt as they are, and summed once more where they meet
    return docs.select("doc_id", "text").mapInArrow(run, "gram string, c long").repartition("gram").groupBy("gram").agg(
        F.sum("c").alias("c")).select(F.lit("").alias("grp"), "gram", "c")


def learn(docs: DataFrame, depth: int, min_count: int, min_divergence: float) -> tuple[DataFrame, DataFrame]:
    """The tree over the texts of (doc_id, text) that are not held out, as the
    tables (grams, contexts) of ``charmodel``.

    ``min_divergence`` is in nats, weighted by the context's count.  The logarithms
    are floats, as in the hash arrays, so joins with the tables score alike.
    """
    scratch: list[str] = []
    keep = lambda rows, name: materialise(rows, name, free=True, paths=scratch)
    counts = keep(count_grams(docs, depth), "counts")
    levels = [charmodel.split_gram(x) for x in charmodel.level_counts(
        counts, depth, continuation=False, keep=lambda rows: keep(rows, "level"))]
    stats = [x.groupBy("ctx").agg(F.sum("c").alias("n"), F.count("*").alias("kinds")) for x in levels]
    kept: list[DataFrame | None] = [None] * (depth + 1)
    for k in range(depth, 0, -1):
        frequent = stats[k].where(F.col("n") >= min_count)
        own = levels[k].join(frequent, "ctx").withColumn("short", F.expr("substring(ctx, 2)"))
        parent = levels[k - 1].select(F.col("ctx").alias("short"), "sym", F.col("c").alias("pc")).join(
            stats[k - 1].select(F.col("ctx").alias("short"), F.col("n").alias("pn")), "short")
        gain = F.sum(F.col("c") * F.log((F.col("c") / F.col("n")) / (F.col("pc") / F.col("pn"))))
        passed = own.join(parent, ["short", "sym"]).groupBy("ctx").agg(gain.alias("gain")).where(
            F.col("gain") >= min_divergence).select("ctx")
        if k < depth:
            passed = passed.union(kept[k + 1].select(F.expr("substring(ctx, 2)").alias("ctx"))).distinct()
        kept[k] = keep(passed, "states")
        del frequent, own, parent, passed       # their shuffles are freed by the next step
    below, grams, contexts = None, None, None
    for k in range(depth + 1):
        own = levels[k].join(stats[k], "ctx")
        if k == 0:
            own = own.withColumn("p", F.lit(1.0 / charmodel.CODE_POINTS))
        else:
            own = own.join(kept[k], "ctx", "left_semi").withColumn("short", F.expr("substring(ctx, 2)")).join(
                below.select(F.col("ctx").alias("short"), "sym", "p"), ["short", "sym"])
        p = (F.col("c") + F.col("kinds") * F.col("p")) / (F.col("n") + F.col("kinds"))
        below = keep(own.select("ctx", "sym", p.alias("p"), "n", "kinds"), "probabilities")
        del own
        one = below.select(F.lit("").alias("grp"), "ctx", "sym", F.log10("p").cast("float").alias("logp"))
        two = below.select(F.lit("").alias("grp"), "ctx", F.log10(
            F.col("kinds") / (F.col("n") + F.col("kinds"))).cast("float").alias("logw")).distinct()
        grams = one if grams is None else grams.union(one)
        contexts = two if contexts is None else contexts.union(two)
    out = materialise(grams, "grams"), materialise(contexts, "contexts", free=True)
    discard(docs.sparkSession, scratch)
    return out


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 5, min_count: int = 8,
                min_divergence: float = 6.0, max_model_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Learns from the rows that are not held out.  Null texts are empty (one
    token, the end); a null id counts as the empty id text.  Repeated rows are
    counted and scored each; without training rows the base is uniform and the
    tree knows no symbol.  An empty table gives no rows.  The tree is broadcast
    up to ``max_model_bytes``; beyond it the same scores come from joins.
    """
    spark = docs.sparkSession
    own = pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string")
    grams, contexts = learn(own, depth, min_count, min_divergence)
    model = charmodel.collect_model(grams, contexts, depth, max_model_bytes)
    if model is not None:
        model.groups.setdefault("", 0)      # without training rows: every symbol is new
        model = spark.sparkContext.broadcast(model)
    at: list[str] = []
    parts = materialise(blocks(own, model, depth), "blocks", codec="uncompressed", paths=at, by="kind", options=_LARGE_ROWS)
    by_join = model is None
    if not by_join:
        model.destroy()
    texts_ = parts.where("kind = 'texts'")
    n_train, ends = texts_.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.coalesce(F.sum("ends"), F.lit(0))).first()

    def asked(kind: str, columns: str) -> DataFrame:
        return parts.where(F.col("kind") == kind).select("block", "asked").mapInArrow(_requests, f"block long, code int, {columns}")

    def answered(rows: DataFrame, kind: str) -> DataFrame:
        # many answers to one block travel in one row
        return materialise(rows.mapInArrow(_packed_answers(), "asker long, n int, code binary, value binary, kinds long"),
                           "answers", free=True).withColumn("kind", F.lit(kind))

    word = Window.partitionBy("word")       # a block asks for a word once: the first of them counts it
    answers = answered(asked("words", "word string, seen long").select(
        "block", "code", F.sum("seen").over(word).alias("value"), F.min("block").over(word).alias("least")).select(
        "block", "code", "value", F.expr("value > 0 AND block = least").alias("first")), "words")
    kinds = answers.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    if by_join:
        distinct = materialise(asked("grams", "gram string").select(F.lit("").alias("grp"), "gram").distinct(), "asked", free=True)
        logp = materialise(charmodel.grams_by_join(distinct, grams, contexts).select("gram", "logp"), "logp", free=True)
        answers = answers.union(answered(asked("grams", "gram string").join(logp, "gram").select(
            "block", "code", F.col("logp").alias("value"), F.lit(False).alias("first")), "grams"))
    discard(spark, [f"{at[0]}/kind={'grams' if by_join else 'words'}"])
    n_train, v = n_train + ends, kinds + (ends > 0)

    def run(block: pa.Table, answers_: pa.Table) -> pa.Table:
        of = lambda kind, values: _by_code(answers_.filter(pc.equal(answers_["kind"], kind)), values)
        block = {x["kind"]: x for x in block.to_pylist()}
        docs_, codes = _unpacked(block["texts"]["docs"]), _unpacked_codes(block["texts"]["codes"])
        offsets = np.concatenate([[0], np.cumsum(docs_["n_words"].to_numpy())])
        score = docs_["score"]
        if by_join:     # the texts again, whose grams come in the same order
            words = _unpacked(block["words"]["asked"])["word"].take(pa.array(codes))
            scores, score = RunningScores(_Answered(depth, of("grams", "<f8"))), np.zeros(len(offsets) - 1)
            for some, points, starts in _runs(words, offsets, np.arange(len(score))):
                score[some] = scores(points, starts)
        c = of("words", "<i8")
        base = np.log10((np.append(c, ends) + 0.1) / (n_train + 0.1 * (v + 1)))
        return pa.table({
            "doc_id": docs_["doc_id"], "held_out": docs_["held_out"], "n_tokens": np.diff(offsets) + 1,
            "n_known": per_text((c > 0).astype(np.int64)[codes], offsets) + int(ends > 0),
            "train_tokens": np.full(len(offsets) - 1, n_train, np.int64),
            "base_score": per_text(base[:-1][codes], offsets) + base[-1], "score": score})

    rows = parts.where("kind != 'grams'") if by_join else texts_
    return rows.select("block", "kind", "docs", "codes", "asked").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
