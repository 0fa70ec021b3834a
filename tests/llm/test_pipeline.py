"""The pipeline against its stages' brute force, and its registration."""

from collections import Counter

from pyspark.sql import functions as F
from test_shingles import brute_components

import __spark_entry__
import corpus_pipeline
from waymill.llm import quality, registry


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(names)


def test_stages_follow_each_other(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    ids = {r.doc_id for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
        rows = docs.collect()
        if k == 0:
            kept = {r.doc_id for r in quality.quality_report(before).where("kept").collect()}
            assert {r.doc_id for r in rows} == kept < ids
        elif k == 1:
            given = sorted((r.doc_id, r.text) for r in before.collect())
            assert sorted(r.doc_id for r in rows) == sorted({given[k][0] for k in brute_components([t for _, t in given])[0]})
        elif k == 2:
            assert len(rows) == before.count() and all(r.n_chars == len(r.text) for r in rows)
        elif k == 3:
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before.collect()}
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


def test_odd_rows_go_through_all_stages(spark, sf_dir):
    """Nulls in any column, empty and repeated rows, ties and columns of clashing names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40")
    text = docs.where("length(text) > 400").select("text").first().text
    odd = [(None, None, None, None, None), (None, text, "en", None, 3), (901, "", "en", "s", 0), (902, text, None, "s", 1), (902, text, None, "s", 1), (903, None, "en", "s", None), (904, "x" * 200_000, "en", None, 200_000), (905, f"password=abcdef123 {text}", "xx", "t", 1)]
    df = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns({"fp": F.lit("clash"), "size": F.lit(1), "row": F.lit(2.0), "kept": F.lit(None).cast("string"), "id": F.lit("clash")})
    rows = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.cut_lineage(stage(spark, rows, sf_dir))
        assert rows.columns == df.columns, name
        assert rows.where("fp <> 'clash' OR id <> 'clash' OR row <> 2").count() == 0
    kept = rows.select("doc_id", "text").collect()
    assert 0 < len(kept) and not {901, 903} & {r.doc_id for r in kept}
    last = corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in kept)
    empty = df.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
