"""Token-ID files as directly addressable codes (DAC).

An id is cut into 8-bit chunks, lowest first.  Level k holds the k-th chunk of
every id that has one, a continuation bitmap (1: the id goes on in level k+1)
and a rank directory (ones before each 512-bit block of the bitmap).  The
position in the next level is the number of ones before it, so any token is
read by at most four chunk reads and no block is decoded.

Files are Parquet tables of segments in ascending document order; a segment
holds whole documents (``segment_tokens`` ids or one longer document), its
document directory and its levels.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.bpe import Merges, byte_chars
from basketry.llm.common import batches, encode, pick, split_words, spread, texts, tokenizer_path

BLOCK_BITS = 512
_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)

LEVEL = pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())])
SEGMENT = ("part int, segment int, start long, n_tokens long, doc_ids array<long>, doc_starts array<long>, "
           "levels array<struct<chunks:binary,bitmap:binary,ranks:binary>>")


class Dac:
    """One sequence of unsigned 32-bit ids in chunk levels."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def build(cls, ids: np.ndarray) -> "Dac":
        left, levels = ids.astype(np.uint32), []
        while len(left) or not levels:
            more = left > 0xFF
            bitmap = np.packbits(more, bitorder="little")
            blocks = np.add.reduceat(_ONES[bitmap], np.arange(0, len(bitmap), BLOCK_BITS // 8)) if len(bitmap) else (
                np.zeros(0, np.int64))
            ranks = (np.cumsum(blocks) - blocks).astype(np.uint32)
            levels.append(((left & 0xFF).astype(np.uint8), bitmap, ranks))
            left = left[more] >> 8
        return cls(levels)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at the given positions, in any order."""
        at = np.asarray(at, np.int64)
        out, live = np.zeros(len(at), np.uint32), np.arange(len(at))
        for k, (chunks, bitmap, ranks) in enumerate(self.levels):
            out[live] |= chunks[at].astype(np.uint32) << np.uint32(8 * k)
            on = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            live, at = live[on], self._rank(bitmap, ranks, at[on])
            if not len(live):
                break
        return out

    def all(self) -> np.ndarray:
        """Every id in order: each level fills in the ids that go on."""
        out, live = np.zeros(len(self.levels[0][0]), np.uint32), None
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            part = chunks.astype(np.uint32) << np.uint32(8 * k)
            if live is None:
                out, live = part, np.arange(len(part))
            else:
                out[live] |= part
            live = live[np.unpackbits(bitmap, bitorder="little")[:len(live)] == 1]
        return out

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each position: the block's count, then whole bytes, then bits."""
        if len(at) == 0:
            return at
        size, byte = BLOCK_BITS // 8, at >> 3
        block, own = np.unique(at // BLOCK_BITS, return_inverse=True)
        part = _ONES[bitmap[byte] & ((1 << (at & 7)) - 1).astype(np.uint8)]
        inside = np.zeros(len(at), np.int64)
        for a in range(0, len(block), 1 << 14):  # only the blocks that are asked for
            some = np.flatnonzero((own >= a) & (own < a + (1 << 14)))
            places = block[a:a + (1 << 14), None] * size + np.arange(size)
            ones = np.cumsum(_ONES[bitmap[np.minimum(places, len(bitmap) - 1)]], axis=1, dtype=np.int64)
            k = byte[some] % size
            inside[some] = np.where(k > 0, ones[own[some] - a, k - 1], 0)
        block = block[own]
        return ranks[block].astype(np.int64) + inside + part

    def pack(self) -> list[dict]:
        return [{"chunks": c.tobytes(), "bitmap": b.tobytes(), "ranks": r.astype("<u4").tobytes()}
                for c, b, r in self.levels]

    @classmethod
    def unpack(cls, levels: list[dict]) -> "Dac":
        return cls([(np.frombuffer(x["chunks"], np.uint8), np.frombuffer(x["bitmap"], np.uint8),
                     np.frombuffer(x["ranks"], "<u4")) for x in levels])


_LIBRARY: dict = {}
_BYTES = dict(enumerate(byte_chars()))


def library_ids(path: str, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids the tokenizers library gives white-space-free chunks, and their offsets.

    The library's BPE model encodes each distinct pre-token once, as byte
    characters; special tokens have their ids.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _LIBRARY:
        from tokenizers import Tokenizer
        _LIBRARY[path] = Tokenizer.from_file(path)
    tokenizer = _LIBRARY[path]
    merges = Merges.load(path)
    pieces, per_chunk = merges.pretokens(chunks)
    codes: dict[str, int] = {}
    which = np.fromiter((codes.setdefault(p, len(codes)) for p in pieces), np.int64, len(pieces))
    words, model = list(codes), tokenizer.model
    own = [[t.id for t in model.tokenize(w.encode().decode("latin-1").translate(_BYTES))] if w[0] != "\x0b"
           else [int(w[1:-1])] for w in words]
    counts = np.fromiter(map(len, own), np.int64, len(own))
    ids = np.fromiter((i for x in own for i in x), np.int64, int(counts.sum()))
    at = np.cumsum(counts) - counts
    out = ids[spread(at[which], counts[which])] if len(which) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(counts[which])]) if len(which) else np.zeros(1, np.int64)
    return out, ends[np.concatenate([[0], np.cumsum(per_chunk)])]


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = 1 << 21) -> None:
    """Encode every row's whole text, append ``end_id``, write DAC files to ``folder``.

    Rows are written in ascending (id, hash of the text) order, null ids first;
    repeated rows are written each.  A null or empty text has the end id alone.
    Rows are dealt by range, so equal ids with different texts still spread.
    """
    path = path or tokenizer_path()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        segment, start = 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        sizes: list[int] = []
        total = 0

        def close() -> pa.RecordBatch:
            nonlocal segment, start, total, doc_ids, held, sizes
            ids = np.concatenate(held)
            ends = np.cumsum(np.array(sizes, np.int64))
            levels = pa.array([Dac.build(ids).pack()], pa.list_(LEVEL))
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([start]), pa.array([len(ids)]),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([(ends - sizes).tolist()], pa.list_(pa.int64())),
                levels], ["part", "segment", "start", "n_tokens", "doc_ids", "doc_starts", "levels"])
            segment, start, total, doc_ids, held, sizes = segment + 1, start + len(ids), 0, [], [], []
            return out

        for batch in batches(rows, text=1):
            words, offsets = split_words(texts(batch.column(1)))
            codes, vocabulary = encode(words)
            ids, at = library_ids(path, vocabulary.to_pylist()) if len(vocabulary) else (
                np.zeros(0, np.int64), np.zeros(1, np.int64))
            n = np.diff(at)
            for doc, a, b in zip(batch.column(0).to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                c = codes[a:b]
                flat = ids[spread(at[c], n[c])] if b > a else ids[:0]
                held.append(np.append(flat, end_id).astype(np.uint32))
                sizes.append(len(flat) + 1)
                doc_ids.append(doc)
                total += len(flat) + 1
                if total >= segment_tokens:
                    yield close()
        if held:
            yield close()

    narrow = pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (narrow.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(run, SEGMENT).write.option("compression", "zstd").parquet(folder))


def open_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The segments with ``first``: ids in all files before each segment.

    Totals are summed per part and only those are put in order; they are as many
    rows as the writer had partitions, which bounds their broadcast.
    """
    segments = spark.read.schema(SEGMENT).parquet(folder)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return segments.join(F.broadcast(before), "part").withColumn("first", F.col("before") + F.col("start")).drop("before")


def read_tokens(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32
    (and ``ids`` with ``keep_ids``).  Empty files give no rows."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            for row in range(batch.num_rows):
                first, size, docs, starts, levels = (batch.column(k)[row].as_py() for k in range(5))
                dac, ends = Dac.unpack(levels), [*starts[1:], size]
                ids = dac.all().astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                own = np.array(starts, np.int64)
                out = [pa.array(docs, pa.int64()), pa.array(own + first), pa.array(np.array(ends, np.int64) - own),
                       pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    out.append(pa.ListArray.from_arrays(pa.array([*starts, size], pa.int32()),
                                                        pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    segments = open_tokens(spark, folder).select("first", "n_tokens", "doc_ids", "doc_starts", "levels")
    return segments.mapInArrow(run, schema)


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """Random access: the id at each ``position`` (long, counted over all files).

    A position meets its segment by an equi-join on the block of
    ``segment_tokens`` positions it lies in; only the chunks on its path are
    read.  Positions outside the files are left out.
    """
    grain = 1 << 21
    segments = open_tokens(spark, folder)
    cells = segments.select("part", "segment", "first", "n_tokens", F.explode(F.sequence(
        F.floor(F.col("first") / grain), F.floor((F.col("first") + F.col("n_tokens") - 1) / grain))).alias("cell"))
    wanted = positions.select("position").withColumn("cell", F.floor(F.col("position") / grain))
    found = wanted.join(cells, "cell").where(
        (F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("n_tokens")))
    found = found.select("part", "segment", "position", (F.col("position") - F.col("first")).alias("at"))

    def run(asked, held):
        import pandas as pd
        if not len(asked):
            return pd.DataFrame({"position": [], "token": []})
        dac = Dac.unpack(held["levels"].iloc[0])
        return pd.DataFrame({"position": asked["position"], "token": dac.access(asked["at"].to_numpy()).astype(np.int64)})

    payload = open_tokens(spark, folder).select(F.col("part").alias("p"), F.col("segment").alias("s"), "levels")
    return found.groupBy("part", "segment").cogroup(payload.groupBy("p", "s")).applyInPandas(
        run, "position long, token long")
