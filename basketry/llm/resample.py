"""Target-distribution importance resampling over hashed word n-grams.

Texts are scored by how much likelier their n-grams are in the target texts
than in the corpus, n-grams being hashed to a fixed number of buckets by the
CRC-32 of their bytes.  A document's words, joined by one space, are scanned
once: the running CRC after each word is kept, and the CRC of any run of words
follows from two of these prefixes, since CRC is linear over GF(2):

    crc(B) = crc(AB) xor shift(crc(A), bytes of B)

where ``shift`` appends zero bytes, a 32 x 32 bit matrix held as byte tables.
No n-gram is ever built as a string.  What reaches the driver are the two
histograms (``buckets`` numbers each).  The draw is a Gumbel top-k: scores are
integers, so the documents above each score are counted in one small
aggregate and no task ranks the whole table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import bare_words, batches, materialise, owners, per_text, pick, texts

NEAR = 64   # shifts by fewer bytes than this have a table of their own


def _byte_steps() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> 1) ^ np.where(c & 1, np.uint32(0xEDB88320), np.uint32(0))
    return c


STEPS = _byte_steps()


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map, given as tables of its four bytes, on every value."""
    return table[0][c & 255] ^ table[1][(c >> 8) & 255] ^ table[2][(c >> 16) & 255] ^ table[3][c >> 24]


def _zero_byte() -> np.ndarray:
    """Tables of the map that appends one zero byte to what a CRC has seen."""
    v = np.arange(256, dtype=np.uint32)
    values = np.stack([v << (8 * k) for k in range(4)])
    return STEPS[values & 255] ^ (values >> 8)


class Shifts:
    """Appending any number of zero bytes: one table lookup below ``NEAR``
    bytes, else one more for each set bit of the rest."""

    def __init__(self) -> None:
        one = _zero_byte()
        v = np.arange(256, dtype=np.uint32)
        near = [np.stack([v << (8 * k) for k in range(4)])]
        for _ in range(NEAR):
            near.append(_apply(one, near[-1]))
        self.near = np.ascontiguousarray(np.stack(near[:NEAR])).reshape(-1)
        self.far = [near[NEAR]]     # NEAR, 2 NEAR, 4 NEAR, ... bytes

    def __call__(self, c: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = (length & (NEAR - 1)).astype(np.int64) * 1024
        out = (self.near[at + (c & 255)] ^ self.near[at + 256 + ((c >> 8) & 255)]
               ^ self.near[at + 512 + ((c >> 16) & 255)] ^ self.near[at + 768 + (c >> 24)])
        rest, k = length // NEAR, 0
        while rest.any():
            if k == len(self.far):
                self.far.append(_apply(self.far[-1], self.far[-1]))
            odd = np.flatnonzero(rest & 1)
            out[odd] = _apply(self.far[k], out[odd])
            rest, k = rest >> 1, k + 1
        return out


def run_crcs(words: pa.Array, n: int, shifts: Shifts) -> list[np.ndarray]:
    """CRC-32 of every run of 1..n consecutive words joined by one space;
    element k - 1 holds the run of k words that starts at each word.  The
    words are scanned once, as one text."""
    crc, c, ends = zlib.crc32, 0, [0]
    for piece in pc.binary_join_element_wise(pa.scalar("", pa.string()), words, " ").cast(pa.binary()).to_pylist():
        c = crc(piece, c)
        ends.append(c)
    ends = np.array(ends, np.uint32)
    # the prefix before each word: what stands before it, and one space
    before = ~ends[:-1]
    moved = ~(STEPS[(before ^ np.uint32(32)) & 255] ^ (before >> 8))
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    out = []
    for k in range(1, n + 1):
        starts = max(len(size) - k + 1, 0)
        # moved[i] is now shifted over words i .. i + k - 1 and the spaces between them
        moved = shifts(moved[:starts], size[k - 1:k - 1 + starts] + (k > 1))
        out.append(ends[k:k + starts] ^ moved)
    return out


def features(text: pa.Array, n: int, buckets: int, shifts: Shifts) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text, and for each run length the buckets of its runs and
    the text each run belongs to."""
    words, offsets = bare_words(text)
    owner = owners(offsets)
    found, belongs = [], []
    for k, crcs in enumerate(run_crcs(words, n, shifts), 1):
        own = owner[:len(crcs)]
        whole = own == owner[k - 1:k - 1 + len(crcs)]
        found.append((crcs[whole] % np.uint32(buckets)).astype(np.int64))
        belongs.append(own[whole])
    return np.diff(offsets), found, belongs


def bucket_counts(df: DataFrame, n: int, buckets: int, text_col: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts: every task adds up its own
    texts before the shuffle, so frequent n-grams make no hot key."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, total = Shifts(), np.zeros(buckets, np.int64)
        for batch in batches(rows, text=0, max_bytes=4 << 20):
            for found in features(texts(batch.column(0)), n, buckets, shifts)[1]:
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "c"])

    out = np.zeros(buckets, np.int64)
    counted = pick(df, text=f"{text_col}:string").mapInArrow(run, "bucket long, c long").groupBy("bucket").agg(F.sum("c").alias("c"))
    for bucket, c in counted.collect():     # at most ``buckets`` rows
        out[bucket] = c
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and corpus shares."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + len(s))) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of a document's runs
    of 1..n words (no run: 0).  One row per row of ``docs``; its other columns
    are not read.  A null text has no words; an empty corpus or target counts
    zero everywhere.  Very long texts are one row of a batch of their own."""
    gain = gains(bucket_counts(docs, n, buckets, text_col), bucket_counts(target, n, buckets, text_col))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for batch in batches(rows, text=1, max_bytes=4 << 20):
            words, found, belongs = features(texts(batch.column(1)), n, buckets, shifts)
            count, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            for b, own in zip(found, belongs):
                ends = np.searchsorted(own, np.arange(len(words) + 1))
                count += np.diff(ends)
                total += per_text(gain[b], ends)
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(count), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])

    return pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, n: int = 2,
             buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Draw ``percent`` % of the documents with at least ``min_words`` words
    without replacement, with odds exp(weight / 1000): the highest sums of
    weight and Gumbel noise, which is a hash of ``seed`` and the id.

    One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank (1 for
    the highest score, ties to the smaller id, null ids last; null if not
    drawn).  Rows that repeat an id share its noise; equal rows get successive
    ranks.  Empty tables give no row.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = materialise(weigh(docs, target, n, buckets, id_col, text_col)
                         .withColumn("score", F.col("weight") + noise), "weights")
    able = scored.where(F.col("n_words") >= min_words)
    # scores are integers between the least and the largest gain plus noise: the
    # window that runs over them in one task has some 10^5 rows whatever the input
    per = able.groupBy("score").agg(F.count(F.lit(1)).alias("c"))
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.select("score", F.coalesce(F.sum("c").over(higher), F.lit(0)).alias("above"),
                     F.floor(F.sum("c").over(everything) * percent / 100).alias("wanted"))
    inside = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    place = F.col("above") + F.row_number().over(inside)
    ranked = able.join(per, "score").withColumn("rank", F.when(place <= F.col("wanted"), place))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(
        scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")).select(*columns))


def resample_sql(percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = 10_000) -> str:
    """The same rows (runs of 1 to 2 words) in DuckDB SQL; CRCs are taken bit by bit of each different run."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    runs = "list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])"
    return f"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
docs AS (SELECT doc_id, w, {runs} AS f, row_number() OVER () AS r FROM (SELECT doc_id, {words} AS w FROM documents)),
target AS (SELECT {runs} AS f FROM (SELECT {words} AS w FROM benchmark)),
counted AS (
  SELECT f, SUM(s) AS s, SUM(t) AS t FROM (
    SELECT f, COUNT(*) AS s, 0 AS t FROM (SELECT unnest(f) AS f FROM docs) GROUP BY f
    UNION ALL SELECT f, 0, COUNT(*) FROM (SELECT unnest(f) AS f FROM target) GROUP BY f) GROUP BY f),
bytes AS (
  SELECT f, s, t, list_concat([4294967295], [CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) FOR i IN range(len(x) // 2)]) AS b
  FROM (SELECT *, hex(encode(f)) AS x FROM counted)),
crcs AS (
  SELECT f, s, t, xor(list_reduce(b, lambda c, y: xor(c // 256, tab[xor(c, y) % 256 + 1])), 4294967295) % {buckets} AS k
  FROM bytes, steps),
per AS (SELECT k, SUM(s) AS s, SUM(t) AS t FROM crcs GROUP BY k),
sums AS (SELECT CAST(SUM(s) AS DOUBLE) AS s, CAST(SUM(t) AS DOUBLE) AS t FROM per),
gain AS (
  SELECT k, floor(1000 * ln(((per.t + 1) * (sums.s + {buckets})) / ((per.s + 1) * (sums.t + {buckets})))) AS g FROM per, sums),
own AS (
  SELECT r, COUNT(*) AS n, floor(SUM(g) / COUNT(*)) AS weight
  FROM (SELECT r, unnest(f) AS f FROM docs) JOIN crcs USING (f) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT doc_id, r, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
         CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
           AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN own USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, COUNT(*) OVER () AS total
           FROM scored WHERE n_words >= {min_words})
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN rank <= {percent} * total // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)"""
