import corpus_pipeline
from fixtures import awkward, no_docs


def test_stages_keep_the_columns(spark, sf):
    docs = awkward(spark)
    for _, function in corpus_pipeline.STAGES[:-1]:
        result = function(spark, docs, sf)
        assert result.dtypes == docs.dtypes
        assert function(spark, no_docs(spark), sf).count() == 0


def test_run_equals_the_operators_one_by_one(spark, sf):
    """The same decisions, taken row by row from the operators' own reports."""
    from test_similarity import brute

    from flowlens.llm import line_dedup, quality_rules, toxicity

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = {r.doc_id for r in toxicity.scores(docs, labels).collect() if not r.predicted}
    left = docs.filter(docs.doc_id.isin(*clean))
    good = {r.doc_id for r in quality_rules.judge(left, labels).collect() if r.kept}
    left = line_dedup.drop_repeated_lines(left.filter(left.doc_id.isin(*good)))
    rows = [(r.doc_id, r.text) for r in left.collect()]
    wanted = {i for i, c, _ in brute(rows) if i == c}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()} == wanted
