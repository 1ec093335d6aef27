import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from basketry.llm import decontaminate, line_spread, quality, simhash
from conftest import SF_SMALL
from tests.llm.test_operators import PROSE, rows


def test_registered():
    names = set(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert set(E.oracle_sql()) <= names


def _normal(rows):
    return sorted((tuple(sorted(r.items())) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["op1_extendible_shards", "op3_line_spread", "op6_license_scan", "op12_crc_resample"])
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    mine = _normal(r.asDict() for r in E.queries()[name](spark, SF_SMALL).collect())
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert mine == _normal(dict(zip(names, r)) for r in res.fetchall())


def test_stages_keep_columns_and_act(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("extra", docs_extra())
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        before_ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        after_ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert after_ids <= before_ids
        if name == "quality_rules":
            assert after_ids == {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
        elif name == "line_dedup":
            assert after_ids == before_ids
            texts = {r["doc_id"]: r["text"] for r in line_spread.remove_boilerplate(docs).collect()}
            assert {r["doc_id"]: r["text"] for r in after.collect()} == texts
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        elif name == "simhash_dedup":
            groups = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
            assert after_ids == groups and after.count() == len(groups)
        elif name == "decontamination":
            bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            assert before_ids - after_ids == {r["doc_id"] for r in decontaminate.leaks(docs, bench).collect()}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        docs = after
    assert docs.count() == docs.where("n_tokens = size(ids)").count() > 0


def docs_extra():
    from pyspark.sql import functions as F
    return F.lit("x")


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert len({r["doc_id"] for r in out}) == len(out) > 0


CLASH = ("doc_id long, text string, lang string, source string, n_chars long, row int, t long, stays string, __t int, _ int, "
         "g int, u int, gone string, logp double, component_id long")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_hard_rows(spark, tmp_path, name):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing
    names, missing columns and an empty table: no stage fails or loses a row it should keep."""
    stage = dict(corpus_pipeline.STAGES)[name]
    last = name == corpus_pipeline.STAGES[-1][0]
    data = [(*r[:5], 1, 2, "x", 3, 4, 5, 6, "g", 0.5, 7) for r in rows()]
    data += [(None,) * 15, (400, PROSE.upper(), None, None, None, *[None] * 10)]
    frame = spark.createDataFrame(data, CLASH).repartition(3)
    out = stage(spark, frame, SF_SMALL)
    kept = out.collect()
    if last:
        assert len(kept) == len(data)
    else:
        assert out.columns == frame.columns
        texts = {r[1] for r in data}
        assert name == "line_dedup" or {r["text"] for r in kept} <= texts
        assert all(r["row"] in (1, None) and r["__t"] in (3, None) for r in kept)
    if name == "line_dedup":
        assert len(kept) == len(data)
    if name == "simhash_dedup":
        # one row of each text stays, near copies go with it, other texts stay
        assert len(kept) == len({r["text"] for r in kept}) and "one two" in {r["text"] for r in kept}
    if name == "decontamination":
        assert len(kept) == len(data)
    bare = frame.select("doc_id", "text")
    left = stage(spark, bare, SF_SMALL)
    assert last or left.columns == bare.columns
    assert left.count() == len(kept) or name in ("quality_rules", "line_dedup")
    assert stage(spark, frame.where("false"), SF_SMALL).count() == 0
