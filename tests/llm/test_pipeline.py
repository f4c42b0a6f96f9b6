import corpus_pipeline
from tests.conftest import DATA
from tests.llm.test_dedup import plain_components
from tidewatch.llm import queries, tiling
from tidewatch.llm.words import WordIds, tidy_ids
from tidewatch.sources.tables import stored


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bench, words = tiling.Benchmark(items), WordIds()
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, DATA), f"test-{name}")
        rows = out.collect()
        if name == "packing":
            lengths = {}
            for r in rows:
                lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
                assert lengths[r.doc_id] <= r.doc_tokens
            assert set(lengths) == set(before)
            break
        assert out.columns == columns
        kept = {r.doc_id: r.text for r in rows}
        assert len(kept) == len(rows) and kept.items() <= before.items()
        if name == "toxicity":
            scorer = queries.toxicity_scorer(docs, queries.labels(spark, DATA))
            want = {i for i, t in before.items() if scorer.scores([t])[0] < queries.TOXIC_FROM}
        elif name == "exact_dedup":
            want = {max(i for i, t in before.items() if t == text) for text in set(before.values())}
        elif name == "jaccard_join":
            want = {i for i, (_, c) in plain_components(before.items()).items() if i == c}
        else:
            want = {i for i, t in before.items() if bench.check(tidy_ids(t, words))[0] < tiling.COVERAGE}
        assert set(kept) == want
        docs, before = out, kept


def test_run_returns_the_last_stage(spark):
    pieces = corpus_pipeline.run(spark, DATA)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and pieces.count() > 0


def test_stages_take_empty_and_odd_documents(spark, corpus, edges):
    from pyspark.sql import functions as F

    for rows in ([], edges):
        docs = corpus(rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, DATA), f"odd-{name}")
            assert name == "packing" or "bucket" in docs.columns
    assert docs.agg(F.sum("length")).first()[0] > 0
