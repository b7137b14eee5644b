"""The pipeline, stage by stage, against the brute-force versions."""

import collections

from pyspark.sql import functions as F

import corpus_pipeline as cp

from .test_llm import WORD, brute_lines, brute_near, check_packing, texts_of


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
    kept = cp.quality(spark, docs, sf).cache()
    bad = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 0").select("doc_id")
    good = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id")
    assert kept.join(bad, "doc_id").count() <= 0.1 * bad.count() and kept.join(good, "doc_id").count() >= 0.98 * good.count()

    lined = cp.lines(spark, kept, sf).cache()
    assert texts_of(lined) == {k: v[2] for k, v in brute_lines(texts_of(kept)).items()}
    assert lined.filter("n_chars <> length(text)").isEmpty()

    single = cp.near(spark, lined, sf).cache()
    assert texts_of(single).keys() == {k for k, v in brute_near(texts_of(lined)).items() if v[2]}

    mixed = cp.mixing(spark, single, sf).cache()
    times = collections.Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 3 and texts_of(mixed).items() <= texts_of(single).items()
    total = sum(len(WORD.findall(t)) for t in texts_of(single).values())
    assert abs(sum(len(WORD.findall(r.text)) for r in mixed.collect()) - total) < 0.1 * total

    for df in (kept, lined, single, mixed):
        assert df.columns == cp.COLUMNS
    once = mixed.dropDuplicates(["doc_id"])
    check_packing(cp.packing(spark, once, sf).collect(), texts_of(once))
    assert cp.packing(spark, mixed, sf).filter("start = 0").count() == mixed.count()


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.isEmpty()


def test_odd_documents(spark, sf):
    """Null texts and ids, repeated rows, a very long text and clashing columns go through every stage."""
    real = spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "x") for r in real]
    good = max((r for r in real), key=lambda r: r.n_chars).text
    rows += [(None, good + " one", "en", "s", None, "x"), (None, good + " one", "en", "s", None, "x"), (rows[0][0], rows[0][1], *rows[0][2:]), (10**9, None, None, None, None, "x"), (10**9 + 1, "", None, None, 0, "x"), (10**9 + 2, good * 40, "en", None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string")
    assert cp.quality(spark, docs, sf).columns == cp.COLUMNS
    lined = cp.lines(spark, docs, sf)
    assert lined.count() == len(rows)
    single = cp.near(spark, docs, sf)
    assert single.filter("doc_id IS NULL").count() == 2 and single.filter(F.col("doc_id") == rows[0][0]).count() == 2
    assert single.filter("doc_id >= 1000000000 AND coalesce(text, '') = ''").count() == 2
    mixed = cp.mixing(spark, docs, sf).cache()
    assert mixed.columns == cp.COLUMNS
    size = F.sum(F.regexp_count("text", F.lit("[^ ]+")))
    assert 0.5 < mixed.agg(size).first()[0] / docs.agg(size).first()[0] < 2
    most = mixed.groupBy("doc_id", F.xxhash64("text").alias("h")).count().join(docs.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.count("*").alias("rows")), ["doc_id", "h"])
    assert most.filter("count > 3 * rows").isEmpty()
    packed = cp.packing(spark, docs, sf).filter("start = 0")
    assert packed.count() == len(rows)
