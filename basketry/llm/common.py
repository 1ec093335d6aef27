"""Helpers shared by the operators: scratch tables, word splitting, segments.

Texts reach the operators as Arrow batches.  A batch is split on ASCII white
space by Arrow and dictionary-encoded, so that per-word work (tokenizing,
hashing, scoring) is done once per distinct word of the batch and the rest is
array arithmetic on word codes.  A batch holds at most
``spark.sql.execution.arrow.maxRecordsPerBatch`` rows and
``...maxBytesPerBatch`` bytes, which bounds a task's memory.
"""

from __future__ import annotations

import ctypes
import gc
import io
import os
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018  (absent outside glibc)
except (OSError, AttributeError):
    _LIBC = None


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, deleted when the JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(hadoop)
    return path


def materialise(df: DataFrame, name: str, codec: str = "zstd", free: bool = False, paths: list[str] | None = None,
                by: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return it read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    each later reader sees the same rows.  ``free`` is for steps with a large
    shuffle: its files serve nothing once the table is written, and Spark drops
    them as soon as the driver has collected their handles (a first collection
    lets go of what holds others).  ``paths`` gets the table's folder, for
    ``discard``; ``by`` is a column whose values have folders of their own.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch(spark, name)
    if paths is not None:
        paths.append(path)
    df.write.options(**(options or {})).option("compression", codec).parquet(path, partitionBy=by)
    del df      # the caller's own handle, if any, still holds the files
    for _ in range(2 if free else 0):
        gc.collect()
        spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that no later step reads."""
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per context).

    The sources go as a zip to the shared folder and from there to the executors
    by ``addPyFile``; a cluster that installs the package needs no call.
    """
    sc = spark.sparkContext
    if getattr(sc, "_basketry_shipped", False):
        return
    root, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(source.relative_to(root.parent)))
    path = f"{scratch(spark, 'package')}/basketry.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(path)
    sc._basketry_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` reduced to the given columns under the given names.

    Operators read only what they need, so extra columns and clashing names of
    the input never reach their plans.  A missing column counts as null.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for name, spec in columns.items():
        source, _, kind = spec.partition(":")
        col = df[f"`{have[source.lower()]}`"] if source.lower() in have else F.lit(None)
        out.append((col.cast(kind) if kind else col).alias(name))
    return df.select(*out)


def texts(column: pa.Array) -> pa.Array:
    """Nulls as empty texts, one contiguous ``string`` array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.string()) if column.type != pa.string() else column
    return pc.fill_null(column, "") if column.null_count else column


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts, and each text's offsets."""
    lists = pc.ascii_split_whitespace(text)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten()
    offsets -= offsets[0]
    full = pc.greater(pc.binary_length(words), 0)
    if not pc.all(full, min_count=0).as_py():
        seen = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        offsets, words = seen[offsets], words.filter(full)
    return words, offsets


def encode(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words and the distinct words the codes stand for."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each text (0 for a text without values)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + length)``."""
    total = int(lengths.sum())
    out = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return out + np.repeat(starts, lengths)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and each value's offsets into them."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[offsets[0]:offsets[-1]], offsets - offsets[0]


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over given bytes (which must be UTF-8)."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                       pa.py_buffer(np.ascontiguousarray(data).tobytes()))


_WORD = np.full(256, 0x20, np.uint8)
_WORD[0x80:] = np.arange(0x80, 0x100)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B)):
    _WORD[_low:_high] = np.arange(_low, _high)
_WORD[0x41:0x5B] = np.arange(0x61, 0x7B)


def bare_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    data, offsets = raw_bytes(text)
    return split_words(string_array(_WORD[data], offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (uint64 in, uint64 out)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on between tasks,
    and what it keeps is missing to the executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def batches(rows: Iterator[pa.RecordBatch], text: int | None = None,
            max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches that have rows; with ``text`` (a column's number) cut into runs
    of rows with at most ``max_bytes`` of it, or one longer text."""
    for batch in rows:
        if text is None and batch.num_rows:
            yield batch
            continue
        if text is None or not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(at, stop - at)
            give_back()
            at = stop
    give_back()


def tokenizer_path(name: str = "word_bpe_49k.json", folder: str | None = None) -> str:
    """Place of a public tokenizer file; ``folder`` or $TOKENIZER_DIR overrides the installed one."""
    folder = folder or os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    try:
        import public_tokenizers
        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)
