"""Cross-site boilerplate lines by distinct-site spread.

Each line hash aggregates a HyperLogLog sketch of the sites it stands on;
sketches merge in the (partial) aggregation.  Estimates clearly above or below
the threshold decide at once; lines in the sketch's error band around it get an
exact distinct count.  The occurrences of a boilerplate line are then removed
from all documents but the first, so no content is lost from the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialise, pick

BLANKS = " \t\r\x0b\x0c"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, t, pos, line hash, site) of every line with a word; t names the text."""
    each = docs.select("doc_id", "t", "site", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    line = F.btrim(F.col("raw"), F.lit(BLANKS))
    return each.where(line != "").select("doc_id", "t", "pos", F.unhex(F.md5(line)).alias("line"), "site")


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = 8, sigmas: float = 5.0) -> DataFrame:
    """Hashes of the lines on ``min_sites`` or more distinct sites."""
    margin = sigmas * 1.04 / 2 ** (lg_k / 2)
    low, high = min_sites * (1 - margin) - 1, min_sites * (1 + margin) + 1
    spread = materialise(lines.groupBy("line").agg(F.count("*").alias("n"), F.hll_sketch_agg("site", F.lit(lg_k)).alias("s"))
                         .where(F.col("n") >= min_sites)
                         .select("line", F.hll_sketch_estimate("s").alias("sites")).where(F.col("sites") >= low), "spread")
    sure = spread.where(F.col("sites") > high).select("line")
    near = spread.where(F.col("sites") <= high).select("line")
    exact = (lines.join(near, "line", "left_semi").where(F.col("site").isNotNull()).select("line", "site").distinct()
             .groupBy("line").count().where(F.col("count") >= min_sites).select("line"))
    return sure.union(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = 5, id_col: str = "doc_id", text_col: str = "text",
                       site_col: str = "source", keep_first: bool = True, carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, text (without boilerplate lines), n_lines,
    n_removed; ``carry`` adds the input row as the struct ``row``.

    A line counts without leading and trailing blanks; lines without a word are
    neither counted nor removed.  The first occurrence of a boilerplate line (by
    id, nulls first, then text hash and position) stays, unless ``keep_first``
    is false.  A null site is no site; a null text stays null with no lines.
    Repeated rows are treated alike.  Empty table: no rows.
    """
    free = "_" * (1 + max(map(len, docs.columns), default=0))
    source = docs.select("*", F.struct("*").alias(free)) if carry else docs
    named = {"row": free} if carry else {}
    own = pick(source, doc_id=id_col, text=f"{text_col}:string", site=f"{site_col}:string", **named).withColumn(
        "t", F.xxhash64("text"))
    lines = materialise(_lines(own), "lines")
    marked = lines.join(boilerplate(lines, min_sites), "line").select("doc_id", "t", "pos", "line")
    if keep_first:
        place = F.struct("doc_id", "t", "pos")
        first = marked.groupBy("line").agg(F.min(place).alias("first"))
        marked = marked.join(first, "line").where(~place.eqNullSafe(F.col("first")))
    gone = marked.groupBy("doc_id", "t").agg(F.collect_set("pos").alias("gone")).select(
        F.col("doc_id").alias("g"), F.col("t").alias("u"), "gone")
    joined = own.join(gone, F.col("doc_id").eqNullSafe(F.col("g")) & (F.col("t") == F.col("u")), "left")
    parts = F.split("text", "\n")
    kept = F.filter(parts, lambda x, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    n_lines = F.size(F.filter(parts, lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    return joined.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.greatest(F.coalesce(n_lines, F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), *named)


def line_sql(min_sites: int = 5) -> str:
    blanks = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"
    return f"""
WITH parts AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS p FROM documents),
lines AS (
  SELECT doc_id, source, unnest(p) AS raw, unnest(range(1, len(p) + 1)) AS pos FROM parts),
counted AS (SELECT *, trim(raw, {blanks}) AS line FROM lines),
boiler AS (
  SELECT line, min((doc_id, pos)) AS first FROM counted WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {min_sites}),
judged AS (
  SELECT c.*, b.line IS NOT NULL AND (c.doc_id, c.pos) <> b.first AS gone
  FROM counted c LEFT JOIN boiler b ON c.line = b.line)
SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
