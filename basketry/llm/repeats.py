"""Exact removal of byte strings that start earlier in the corpus.

Every window of ``length`` bytes goes to the bucket of its least k-gram hash,
which depends on the window's bytes alone, so equal windows meet whatever
documents hold them.  Neighbouring windows of one bucket form a run; equal runs
collapse to their first place at once, the other places repeat it whole.  Where
a bucket holds different runs, their text is sorted into a k-order suffix array
and its Burrows-Wheeler transform.  From the transform the common-prefix values
are derived by increasing value: each new boundary extends backward by every
character that follows it (first occurrence per character, through the
LF-mapping) to the boundaries of the next value, breadth first.  The expansion
stops at ``length``; suffixes that still share an interval start equal windows,
and all but the first place are removed.

Places are (doc_id, hash of the text, position).  A bucket above
``bucket_bytes`` is dealt again by another hash of its windows' k-grams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import batches, materialise, mix, pick, raw_bytes, spread

GRAM = 20
_CHUNK = 1 << 16
_BASE = 0x9E3779B97F4A7C15

def _fold(x: np.ndarray, size: int, join) -> np.ndarray:
    """``join`` over every ``size`` neighbours, by doubling; join(left, right, length of left)."""
    out, done, level, width = None, 0, x, 1
    while True:
        if size & width:
            if out is None:
                out, done = level, width
            else:
                m = len(x) - done - width + 1
                out = join(out[:m], level[done:done + m], done)
                done += width
        if width * 2 > size:
            return out
        m = len(level) - width
        level = join(level[:m], level[width:width + m], width)
        width *= 2


def _poly(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    return left + right * np.uint64(pow(_BASE, size, 1 << 64))


def _least(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while width * 2 <= size:
        x = np.minimum(x[:len(x) - width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def find_runs(data: np.ndarray, offsets: np.ndarray, length: int, seed: int = 0):
    """Runs of windows inside the texts: text, position, windows, bucket, run hash,
    and whether the run may hold one window twice.

    A run has at most as many windows as a window has k-grams, so its first and
    last window cover it and their hashes name it.
    """
    reach = length - GRAM + 1
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    ends = offsets[1:]
    for a in range(0, max(len(data) - length + 1, 0), _CHUNK):
        part = data[a:a + _CHUNK + length - 1]
        if len(part) < length:
            break
        h = mix(part.astype(np.uint64) + np.uint64(1 + 1000 * seed))
        grams = mix(_fold(h, GRAM, _poly))
        least = _least(grams, reach)
        whole = _fold(h, length, _poly)
        at = np.arange(a, a + len(least))
        text = np.searchsorted(ends, at, side="right")
        ok = at + length <= ends[text]
        start = np.ones(len(at), bool)
        start[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
        first = np.flatnonzero(start)
        # cut runs longer than ``reach`` windows
        size = np.diff(np.append(first, len(at)))
        pieces = (size + reach - 1) // reach
        first = np.repeat(first, pieces) + spread(np.zeros(len(pieces), np.int64), pieces) * reach
        size = np.diff(np.append(first, len(at)))
        keep = ok[first]
        first, size = first[keep], size[keep]
        size -= np.maximum(0, at[first] + size - 1 + length - ends[text[first]])
        spans = size + reach - 1
        place = spread(first, spans)
        same = (grams[place] == np.repeat(least[first], spans)).astype(np.int64)
        cum = np.concatenate([[0], np.cumsum(same)])
        edge = np.cumsum(spans)
        often = cum[edge] - cum[edge - spans] > 1
        name = mix(whole[first] ^ mix(whole[first + size - 1] + size.astype(np.uint64)))
        for held, x in zip(out, (text[first], at[first] - offsets[text[first]], size, least[first], name, often)):
            held.append(x)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def _ranked(ids: pa.Array, t: np.ndarray) -> np.ndarray:
    """Rank of each (doc_id, t), null ids first; equal places share a rank."""
    null = pc.is_null(ids).to_numpy(zero_copy_only=False)
    values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    order = np.lexsort((t, values, ~null))
    fresh = np.ones(len(order), np.int64)
    if len(order):
        a, b = order[1:], order[:-1]
        fresh[0] = 0
        fresh[1:] = (null[a] != null[b]) | (values[a] != values[b]) | (t[a] != t[b])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh)
    return rank


def _deal(length: int, seed: int = 0, with_text: bool = False):
    """(doc_id, t, text, at) -> run rows; ``at`` is the text's place in its document.

    Equal runs of a batch are returned once; their other places become spans.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=2):
            column = pc.fill_null(batch.column(2), b"")
            data, offsets = raw_bytes(column)
            text, pos, n, h, s, often = find_runs(data, offsets, length, seed)
            if not len(text):
                continue
            t = batch.column(1).to_numpy(zero_copy_only=False)
            pos = pos + batch.column(3).to_numpy(zero_copy_only=False)[text]
            rank = _ranked(batch.column(0), t)[text]
            order = np.lexsort((pos, rank, s, h))
            same = np.zeros(len(order), bool)
            a, b = order[1:], order[:-1]
            same[1:] = (h[a] == h[b]) & (s[a] == s[b])
            first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            repeat = same & ((rank[order] != rank[first]) | (pos[order] != pos[first]))
            take = np.concatenate([order[~same], order[repeat]])
            span = np.arange(len(take)) >= len(take) - int(repeat.sum())
            key = np.where(span, mix(t[text[take]].astype(np.int64).view(np.uint64)), h[take]).view(np.int64)
            places = pa.array(text[take])
            out = [pa.array(key), pa.array(s[take].view(np.int64)), batch.column(0).take(places).cast(pa.int64()),
                   batch.column(1).take(places), pa.array(pos[take]),
                   pa.array(np.where(span, n[take] + length - 1, n[take])), pa.array(often[take]), pa.array(span)]
            names = ["h", "s", "doc_id", "t", "pos", "n", "often", "span"]
            if with_text:
                raw, low = data.tobytes(), offsets[text] + pos - batch.column(3).to_numpy(zero_copy_only=False)[text]
                out.append(pa.array([b"" if x else raw[i:i + m + length - 1] for x, i, m in zip(
                    span.tolist(), low[take].tolist(), n[take].tolist())], pa.binary()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(out, names)

    return run


RUNS = "h long, s long, doc_id long, t long, pos long, n long, often boolean, span boolean"
PLACE = ["doc_id", "t", "pos"]


def _classes(runs: DataFrame, length: int) -> DataFrame:
    """Adds to runs: ``span`` for places that repeat a run, ``asks`` for the first
    place of a run whose bucket holds another run (or which may repeat itself)."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("t"), F.col("pos")]
    place = F.struct(*PLACE)
    own = Window.partitionBy("h", "s", "span").orderBy(*order)
    bucket = Window.partitionBy("h")
    real = F.when(~F.col("span"), F.col("s"))
    seen = (runs.repartition("h").withColumn("first", F.first(place).over(own)).withColumn("row", F.row_number().over(own))
            .withColumn("low", F.min(real).over(bucket)).withColumn("high", F.max(real).over(bucket)))
    repeat = ~F.col("span") & ~place.eqNullSafe(F.col("first"))
    asks = ~F.col("span") & (F.col("row") == 1) & ((F.col("low") != F.col("high")) | F.col("often"))
    marked = seen.withColumn("repeat", repeat).withColumn("asks", asks).where("span OR repeat OR asks")
    return marked.withColumn("n", F.when(F.col("repeat"), F.col("n") + length - 1).otherwise(F.col("n"))).withColumn(
        "span", F.col("span") | F.col("repeat")).drop("first", "row", "low", "high", "repeat", "s", "often")


def _cut(length: int):
    """(doc_id, t, text, runs) -> the text of each run."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=2):
            data, offsets = raw_bytes(batch.column(2))
            raw, lists = data.tobytes(), batch.column(3)
            each = lists.flatten()
            own = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            h, pos, n = (each.field(k) for k in range(3))
            begin = offsets[own] + pos.to_numpy()
            stop = begin + n.to_numpy() + length - 1
            places = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [h, batch.column(0).take(places), batch.column(1).take(places), pos,
                 pa.array([raw[i:j] for i, j in zip(begin.tolist(), stop.tolist())], pa.binary())],
                ["h", "doc_id", "t", "pos", "text"])

    return run


SEGMENTS = "h long, doc_id long, t long, pos long, text binary"


def k_order(symbol: np.ndarray, k: int) -> np.ndarray:
    """Suffix array by the first ``k`` (or more) symbols; symbols below 512."""
    n = len(symbol)
    key = np.zeros(n, np.int64)
    wide = symbol.astype(np.int64)
    for i in range(7):
        key[:n - i] |= wide[i:] << (9 * (6 - i))
    size = 7
    order = np.argsort(key)
    while True:
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (ranked[1:] != ranked[:-1]).astype(np.int64)]))
        if size >= k or rank[order[-1]] == n:
            return order
        key = rank << 32
        key[:n - size] |= rank[size:]
        order = np.argsort(key)
        size *= 2


def repeated_windows(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``length`` bytes that occur more than once in the segments:
    class, segment and offset of each occurrence."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments)) + 1
    starts = np.cumsum(sizes) - sizes
    symbol = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.uint16) + 1
    symbol[starts + sizes - 1] = 0
    n = len(symbol)
    order = k_order(symbol, length)
    bwt = symbol[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)
    before = np.full(n, -1, np.int64)
    left, right = by_symbol[:-1], by_symbol[1:]
    same = bwt[left] == bwt[right]
    before[right[same]] = left[same]
    bound = np.zeros(n + 1, bool)
    ends = len(segments)
    bound[:ends] = True                       # every end mark is a symbol of its own
    bound[n] = True
    counts = np.bincount(symbol, minlength=257)
    bound[np.cumsum(counts)[:-1][counts[1:] > 0]] = True
    bound[0] = True
    new = np.flatnonzero(bound[:n])           # boundaries of value 0
    for _ in range(length - 1):
        if not len(new):
            break
        stops = np.flatnonzero(bound)
        stop = stops[np.searchsorted(stops, new, side="right")]
        wide = stop - new
        at = spread(new, wide)
        ahead = (before[at] < np.repeat(new, wide)) & (bwt[at] != 0)
        found = lf[at[ahead]]
        found = found[~bound[found]]
        bound[found] = True
        new = np.sort(found)
    group = np.cumsum(bound[:n]) - 1
    many = np.bincount(group)[group] > 1
    place = order[many]
    own = np.searchsorted(starts, place, side="right") - 1
    return group[many], own, place - starts[own]


def _expand(length: int, hold: int = 1 << 18):
    """Segments sorted by bucket -> spans of windows with an earlier equal window."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        t = rows.column("t").to_numpy()
        group, own, offset = repeated_windows(rows.column("text").to_pylist(), length)
        if not len(group):
            return None
        rank = _ranked(rows.column("doc_id"), t)
        place = rows.column("pos").to_numpy()[own] + offset
        order = np.lexsort((place, rank[own], group))
        group, own, offset, place = group[order], own[order], offset[order], place[order]
        head = np.ones(len(group), bool)
        head[1:] = group[1:] != group[:-1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(group)), 0))
        late = (rank[own] != rank[own[first]]) | (place != place[first])
        own, offset = own[late], offset[late]
        order = np.lexsort((offset, own))
        own, offset = own[order], offset[order]
        start = np.ones(len(own), bool)
        start[1:] = (own[1:] != own[:-1]) | (offset[1:] != offset[:-1] + 1)
        begin = np.flatnonzero(start)
        size = np.diff(np.append(begin, len(own))) + length - 1
        places = pa.array(own[begin])
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(places), rows.column("t").take(places),
             pa.array(rows.column("pos").to_numpy()[own[begin]] + offset[begin]), pa.array(size)],
            ["doc_id", "t", "pos", "n"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches(rows):
            h = batch.column("h").to_numpy()
            length_of = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
            at = 0
            while at < len(h):
                if size >= hold and h[at] != last:
                    done = solve(held)
                    if done is not None and done.num_rows:
                        yield done
                    held, size = [], 0
                # take rows up to the first bucket border past ``hold``
                used = int(length_of[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(length_of, used + max(hold - size, 0), side="right")))
                stop = min(stop, len(h))
                while stop < len(h) and h[stop] == h[stop - 1]:
                    stop += 1
                held.append(batch.slice(at, stop - at))
                size += int(length_of[stop - 1]) - used
                last, at = h[stop - 1], stop
        if held:
            done = solve(held)
            if done is not None and done.num_rows:
                yield done

    return run


SPANS = "doc_id long, t long, pos long, n long"


def _finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) -> the digest columns and the bytes kept."""
    for batch in batches(rows, text=1):
        data, offsets = raw_bytes(pc.fill_null(batch.column(1), b""))
        lists = batch.column(2)
        count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        own, each = np.repeat(np.arange(batch.num_rows), count), lists.flatten()
        edge = np.zeros(len(data) + 1, np.int32)
        begin = offsets[own] + each.field(0).to_numpy(zero_copy_only=False)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + each.field(1).to_numpy(zero_copy_only=False), -1)
        gone = np.cumsum(edge[:-1]) > 0
        starts = gone.copy()
        starts[1:] &= ~gone[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        starts[inner] |= gone[inner]
        cum, runs = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, starts))
        left = data[~gone].tobytes()
        ends = (offsets - cum[offsets]).tolist()
        kept = [left[a:b] for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(np.diff(cum[offsets])), pa.array(np.diff(runs[offsets])),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    Removes every byte covered by a ``length``-byte string that also starts
    earlier: in a smaller doc_id (nulls first; texts of one id by their hash) or
    earlier in the same text.  Strings are judged on the input; ``kept`` are the
    remaining bytes, which need not be valid UTF-8.  Rows equal in id and text
    are one document read twice and are treated alike.  Null texts are empty;
    texts shorter than ``length`` lose nothing.  Empty table: no rows.
    """
    own = pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string").withColumn("t", F.xxhash64("text")).select(
        "doc_id", "t", F.col("text").cast("binary").alias("text"))
    runs = own.withColumn("at", F.lit(0).cast("long")).mapInArrow(_deal(length), RUNS)
    marked = materialise(_classes(runs, length), "runs", free=True)
    spans = marked.where("span").select("doc_id", "t", "pos", "n")
    asked = marked.where("asks").groupBy("doc_id", "t").agg(F.collect_list(F.struct("h", "pos", "n")).alias("runs"))
    renamed = asked.select(F.col("doc_id").alias("d"), F.col("t").alias("u"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u"))
    segments = materialise(own.join(renamed, same).select("doc_id", "t", "text", "runs").mapInArrow(
        _cut(length), SEGMENTS), "segments", free=True)
    seed = 0
    while True:
        sizes = segments.groupBy("h").agg(F.sum(F.octet_length("text")).alias("b"))
        crowded = materialise(sizes.where(F.col("b") > bucket_bytes).select("h"), "crowded")
        last = seed >= 8 or crowded.isEmpty()
        calm = segments if last else segments.join(crowded, "h", "left_anti")
        found = materialise(calm.repartition("h").sortWithinPartitions("h").mapInArrow(_expand(length), SPANS), "spans", free=True)
        spans = spans.union(found)
        if last:
            break
        seed += 1
        hot = segments.join(crowded, "h", "left_semi").select("doc_id", "t", "text", F.col("pos").alias("at"))
        again = materialise(_classes(hot.mapInArrow(_deal(length, seed, True), f"{RUNS}, text binary"), length), "runs")
        spans = spans.union(again.where("span").select("doc_id", "t", "pos", "n"))
        segments = again.where("asks").select("h", "doc_id", "t", "pos", "text")
    gathered = spans.groupBy("doc_id", "t").agg(F.collect_list(F.struct("pos", "n")).alias("spans")).select(
        F.col("doc_id").alias("d"), F.col("t").alias("u"), "spans")
    return own.join(gathered, same, "left").select("doc_id", "text", "spans").mapInArrow(
        _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
