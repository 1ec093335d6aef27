"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark
decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``: rejected, near
duplicate and contaminated documents go, boilerplate lines are cut out of the
text (``n_chars`` follows).  Rows are matched by id and hash of the text, so
null and repeated ids do no harm; a missing column counts as null, extra
columns of any name are kept, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import bpe, decontaminate, line_spread, quality, simhash
from basketry.llm.common import materialise, ship, table

#: SQL for run()'s rows: the perplexity model, SimHash and BPE cannot be said in it
ORACLE_SQL = None


def _free(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    return "_" * (1 + max(map(len, docs.columns), default=0))


def _key(docs: DataFrame, name: str) -> F.Column:
    """A key as the operators have it (a missing column counts as null)."""
    have = {c.lower(): c for c in docs.columns}
    source = {"t": "text"}.get(name, name)
    col = docs[f"`{have[source]}`"] if source in have else F.lit(None)
    return {"t": F.xxhash64(col.cast("string")), "lang": F.coalesce(col.cast("string"), F.lit(""))}.get(name, col)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose keys (of doc_id, text hash t, lang) are in ``gone``."""
    free = _free(docs)
    marked = gone.select(*(F.col(c).alias(f"{free}{c}") for c in gone.columns)).distinct()
    same = F.lit(True)
    for c in gone.columns:
        same = same & _key(docs, c).eqNullSafe(marked[f"{free}{c}"])
    return docs.join(marked, same, "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    verdict = quality.judge(docs)
    return _without(docs, verdict.where("NOT kept").select("doc_id", "t", "lang"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sites (first places stay)."""
    ship(spark)
    cleaned = line_spread.remove_boilerplate(docs, carry=True)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind))
                            .otherwise(F.col("row.n_chars")))
    return cleaned.select(row.alias("row")).select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    ship(spark)
    marks = materialise(simhash.near_duplicates(docs, shingle=4, radius=4), "components")
    left = _without(docs, marks.where("NOT stays").select("doc_id", "t"))
    twice = marks.where("stays").groupBy("doc_id", "t").count().where("count > 1")
    if twice.isEmpty():
        return left
    # rows equal in id and text: one of them stays
    i, t = _free(docs), f"{_free(docs)}t"
    return left.withColumns({i: _key(left, "doc_id"), t: _key(left, "t")}).dropDuplicates([i, t]).drop(i, t)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select("doc_id", "t"))


def bpe_encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with the digests of ids and decoded text."""
    ship(spark)
    return bpe.encode_decode(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontaminated),
    ("bpe_encoding", bpe_encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
