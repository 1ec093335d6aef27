"""SimHash near-duplicates with covering locality-sensitive hashing.

Each of the 64 bit positions gets a vector over GF(2) with radius + 1
coordinates; the table of a non-zero vector v keeps the bits whose vector has
an odd product with v.  For any ``radius`` positions some v is orthogonal to
all of them, so every pair within the radius agrees on that table's bits and
meets there: recall is 1 by construction, not by chance.

Only distinct fingerprints are hashed.  A bucket above ``bucket_rows`` is cut
again by the same construction on the bits it does not share yet, until its
members can differ in so few bits that it must be small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import batches, materialise, per_text, pick, raw_bytes, texts
from basketry.llm.components import components

_CHUNK = 1 << 16
_FULL = (1 << 64) - 1


def fingerprints(text: pa.Array, shingle: int) -> np.ndarray:
    """Unsigned fingerprints: bit set if set in over half the shingles' XXH64 (seed 42)."""
    from xxhash import xxh64_intdigest
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    length = pc.binary_length(lists.flatten()).to_numpy().astype(np.int64)
    # the splitter leaves an empty word at a text's leading or trailing space; those are stepped over below
    if (length == 0).any():
        full = length > 0
        own = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[full]
        words = lists.flatten().filter(pa.array(full))
        offsets = np.searchsorted(own, np.arange(len(offsets)))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words)
        length = length[full]
    joined, ends = raw_bytes(pc.binary_join(lists, " "))
    data = joined.tobytes()
    counts = np.diff(offsets)
    cum = np.concatenate([[0], np.cumsum(length + 1)])
    base = ends[:-1] - cum[offsets[:-1]]
    n = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
    bits = np.zeros((len(counts), 64), np.int64)
    total = np.concatenate([[0], np.cumsum(n)])
    for a in range(0, int(total[-1]), _CHUNK):
        b = min(a + _CHUNK, int(total[-1]))
        row = np.searchsorted(total, np.arange(a, b), side="right") - 1
        first = offsets[row] + np.arange(a, b) - total[row]
        last = np.minimum(first + shingle, offsets[row + 1]) - 1
        begin = (base[row] + cum[first]).tolist()
        stop = (base[row] + cum[last] + length[last]).tolist()
        h = np.fromiter((xxh64_intdigest(data[i:j], 42) for i, j in zip(begin, stop)), np.uint64, b - a)
        unpacked = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        bits[row[cuts]] += np.add.reduceat(unpacked, cuts, axis=0, dtype=np.int64)
    over = (2 * bits > n[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprint_table(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t, fp) per row: t the text's hash, fp the fingerprint's bits as a
    signed long; null text: empty, fp 0."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=1):
            fp = fingerprints(texts(batch.column(1)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp)], ["doc_id", "t", "fp"])

    own = pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string").withColumn("t", F.xxhash64("text"))
    return own.mapInArrow(run, "doc_id long, t long, fp long")


def covering_masks(free: int, radius: int) -> list[int]:
    """The bits each table keeps, among the set bits of ``free``."""
    positions = [i for i in range(64) if free >> i & 1]
    span, m = (1 << radius + 1) - 1, len(positions)
    vectors = [1 + (k % span if m > span else k * span // max(m, 1)) for k in range(m)]
    return [sum(1 << p for p, w in zip(positions, vectors) if bin(w & v).count("1") & 1) for v in range(1, span + 1)]


def _tables(radius: int):
    """(fp, path, free) -> a row per table: (fp, path, key, free)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks: dict[int, list[int]] = {}
        for batch in batches(rows):
            fp, path, free = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
            for f in np.unique(free):
                some = free == f
                whole = int(f) & _FULL
                if whole not in masks:
                    masks[whole] = covering_masks(whole, radius)
                own, at = fp[some].view(np.uint64), path[some]
                for v, kept in enumerate(masks[whole], 1):
                    rest = whole & ~kept
                    key = own & np.uint64(_FULL ^ rest)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.view(np.int64)), pa.array(at * ((2 << radius)) + v), pa.array(key.view(np.int64)),
                         pa.array(np.full(len(own), rest, np.uint64).view(np.int64))], ["fp", "path", "key", "free"])

    return run


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= radius


def _group_edges(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, least node) of the components inside one bucket."""
    n = len(fp)
    label = np.arange(n)
    unseen = np.ones(n, bool)
    for k in range(n):
        if not unseen[k]:
            continue
        unseen[k] = False
        front = [k]
        while front:
            rest = np.flatnonzero(unseen)
            if not len(rest):
                break
            hit = rest[_near(fp[rest], fp[front.pop()], radius)]
            unseen[hit] = False
            label[hit] = k
            front.extend(hit.tolist())
    own = label != np.arange(n)
    return fp[own], fp[label[own]]


def _bucket_edges(radius: int):
    """Sorted rows (path, key, fp) -> edges (u, v) between members within the radius.

    A bucket may run over batch borders, so its tail is carried on; buckets are
    bounded before this step.
    """

    def edges(path: np.ndarray, key: np.ndarray, fp: np.ndarray):
        cut = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (key[1:] != key[:-1])]))
        size = np.diff(np.concatenate([cut, [len(fp)]]))
        pairs = cut[size == 2]
        hit = _near(fp[pairs], fp[pairs + 1], radius) if len(pairs) else np.zeros(0, bool)
        us, vs = [fp[pairs + 1][hit]], [fp[pairs][hit]]
        for a, n in zip(cut[size > 2], size[size > 2]):
            u, v = _group_edges(fp[a:a + n], radius)
            us.append(u)
            vs.append(v)
        u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
        both = np.unique(np.stack([u, v], 1), axis=0) if len(u) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)]
        for batch in batches(rows):
            new = [batch.column(k).to_numpy().astype(np.int64) for k in range(3)]
            held = [np.concatenate([h, x]) for h, x in zip(held, [new[0], new[1], new[2].view(np.uint64)])]
            change = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))
            if len(change):
                end = int(change[-1]) + 1
                yield edges(*(h[:end] for h in held))
                held = [h[end:] for h in held]
        if len(held[0]):
            yield edges(*held)

    return run


def near_edges(fps: DataFrame, radius: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """Edges (u, v) that connect the distinct values of ``fps`` (fp: long) as all
    links of at most ``radius`` differing bits do.  Within a bucket only a star
    per component is returned, never all pairs."""
    rows = fps.select("fp", F.lit(0).cast("long").alias("path"), F.lit(-1).cast("long").alias("free"))
    found = None
    bounded = 64
    while True:
        tabled = materialise(rows.mapInArrow(_tables(radius), "fp long, path long, key long, free long"), "tables")
        sizes = tabled.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
        crowded = materialise(sizes.where(F.col("n") > bucket_rows), "crowded")
        sized = tabled.join(sizes.where(F.col("n") <= bucket_rows).select("path", "key"), ["path", "key"], "left_semi")
        here = (sized.select("path", "key", "fp").repartition("path", "key").sortWithinPartitions("path", "key", "fp")
                .mapInArrow(_bucket_edges(radius), "u long, v long"))
        found = here if found is None else found.union(here)
        bounded -= 1
        if not bounded or crowded.isEmpty():
            return found
        rows = tabled.join(crowded.select("path", "key"), ["path", "key"], "left_semi").select("fp", "path", "free")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", bucket_rows: int = 4096) -> DataFrame:
    """One row per input row: doc_id, t (hash of the text), fingerprint (16 hex
    digits), component_id, stays (one document of each component: least id,
    nulls last, then least t).

    Rows link at ``radius`` or fewer differing bits; the component's id is its
    least doc_id (nulls count only where a component has no other id).  Texts
    without words have fingerprint zero and link like any other; null texts
    count as empty.  Repeated rows share a fingerprint.  Empty table: no rows.
    """
    fps = materialise(fingerprint_table(docs, shingle, id_col, text_col), "fingerprints")
    nodes = materialise(fps.groupBy("fp").agg(F.min(_place()).alias("first")), "nodes")
    labels = components(near_edges(nodes.select("fp"), radius, bucket_rows))
    roots = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("least"))
    named = roots.select("fp", "root").join(least, "root").select("fp", "least")
    return fps.join(named, "fp").select(
        "doc_id", "t", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"), _place().eqNullSafe(F.col("least")).alias("stays"))


def _place():
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
