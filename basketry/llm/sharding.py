"""Byte-limited shards by extendible hashing, in DataFrame operations only.

A row's key hash (60 bits of MD5) is read from the top bit down.  A bucket that
exceeds the byte limit splits on its next bit, one that fits stops, so shards
have different depths and the directory maps hash prefixes to shards.  One
round looks ``round_bits`` bits further, only below buckets that are still too
large: it sums the bytes of each prefix and derives every level's sums from
those.  Only prefix totals are shuffled, with map-side sums, so a hot key is
one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialise, pick

HASH_BITS = 60


def key_hash(key: Column, text: Column) -> Column:
    """60 hash bits of the key; the text's digest separates rows of one key."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def extendible_shards(docs: DataFrame, limit_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text",
                      round_bits: int = 8) -> DataFrame:
    """One row per input row: doc_id, shard (the hash prefix as bits, '' if all
    fits one shard), depth, page, n_bytes, shard_bytes.

    Every (shard, page) holds at most ``limit_bytes`` of text, but for a single
    row above the limit, which has a page of its own.  Rows equal in id and text
    cannot be told apart by any hash bit: a bucket of only such rows is cut into
    pages (page 0 elsewhere).  Null ids hash like an empty id, null texts have
    0 bytes; an empty table gives no rows.  Other columns are not read.
    """
    rows = materialise(
        pick(docs, doc_id=id_col, text=f"{text_col}:string").select(
            "doc_id", key_hash(F.col("doc_id"), F.col("text")).alias("h"),
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")), "keys")
    left, depth, done = rows, 0, []
    while True:
        deep = min(depth + round_bits, HASH_BITS)
        cell = F.shiftright("h", HASH_BITS - deep)
        cells = left.groupBy(cell.alias("cell")).agg(
            F.sum("n_bytes").alias("b"), F.min("h").alias("low"), F.max("h").alias("high"))
        levels = cells.select("*", F.explode(F.sequence(F.lit(depth), F.lit(deep))).alias("depth")).withColumn(
            "prefix", F.call_function("shiftright", F.col("cell"), F.lit(deep) - F.col("depth")))
        buckets = levels.groupBy("depth", "prefix").agg(
            F.sum("b").alias("shard_bytes"), (F.min("low") == F.max("high")).alias("alone"))
        fitting = buckets.where((F.col("shard_bytes") <= limit_bytes) | F.col("alone"))
        directory = materialise(
            levels.select("cell", "depth", "prefix").join(fitting, ["depth", "prefix"]).groupBy("cell").agg(
                F.min_by(F.struct("depth", "prefix", "shard_bytes", "alone"), "depth").alias("at")).select("cell", "at.*"),
            "directory")
        keyed = left.withColumn("cell", cell)
        done.append(keyed.join(directory, "cell").drop("cell"))
        open_cells = cells.join(directory, "cell", "left_anti").select("cell")
        if deep == HASH_BITS or open_cells.isEmpty():
            break
        left, depth = keyed.join(open_cells, "cell", "left_semi").drop("cell"), deep
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    paged = F.col("alone") & (F.col("shard_bytes") > limit_bytes)
    plain = found.where(~paged).withColumn("page", F.lit(0).cast("long"))
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit_bytes) / F.greatest("n_bytes", F.lit(1))))
    block = 1 << 16
    same = [c for c in found.columns]
    copies = (found.where(paged).groupBy(*same).agg(F.count("*").alias("n"))
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block)))))
    spread = copies.repartition(F.col("h"), F.col("block")).withColumn("i", F.explode(F.sequence(
        F.col("block") * block, F.least(F.col("n"), (F.col("block") + 1) * block) - 1)))
    pages = spread.withColumn("page", F.floor(F.col("i") / each)).select(*same, "page")
    bits = F.substring(F.lpad(F.bin("h"), HASH_BITS, "0"), F.lit(1), F.col("depth"))
    return plain.unionByName(pages).select(
        "doc_id", bits.alias("shard"), F.col("depth").cast("int").alias("depth"), "page", "n_bytes", "shard_bytes")


def shard_sql(limit_bytes: int = 64 << 20) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
levels AS (SELECT CAST(range AS INTEGER) AS depth FROM range(0, 61)),
buckets AS (
  SELECT depth, h >> (60 - depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, min(h) = max(h) AS alone
  FROM d, levels GROUP BY ALL),
leaf AS (
  SELECT h, min(depth) AS depth FROM (SELECT DISTINCT h FROM d), buckets
  WHERE h >> (60 - depth) = prefix AND (shard_bytes <= {limit_bytes} OR alone) GROUP BY h),
placed AS (
  SELECT d.*, b.depth, b.shard_bytes, b.alone,
         row_number() OVER (PARTITION BY d.doc_id, d.h ORDER BY d.n_bytes) - 1 AS i
  FROM d JOIN leaf USING (h) JOIN buckets b ON b.depth = leaf.depth AND b.prefix = d.h >> (60 - b.depth))
SELECT doc_id, CAST(substr(lpad(bin(h), 60, '0'), 1, depth) AS VARCHAR) AS shard, depth,
       CASE WHEN alone AND shard_bytes > {limit_bytes}
            THEN i // greatest(1, {limit_bytes} // greatest(n_bytes, 1)) ELSE 0 END AS page,
       n_bytes, shard_bytes
FROM placed"""
