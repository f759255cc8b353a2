"""Every stage against brute force on what its predecessor has kept."""

import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from citegraph.llm import common, near_dups, quality, secrets
from test_llm_queries import _components

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        kept[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = kept[name][1]
        assert name == "packing" or docs.columns == COLUMNS
    texts = {n: [(r.doc_id, r.text) for r in after.collect()] for n, (_, after) in kept.items() if n != "packing"}
    before = {n: [(r.doc_id, r.text) for r in first.collect()] for n, (first, _) in kept.items()}

    lost = set(before["language"]) - set(texts["language"])
    assert set(texts["language"]) <= set(before["language"]) and len(lost) <= 0.02 * len(before["language"])
    assert all(any(c.isalpha() for c in t) for _, t in texts["language"])

    good = quality.quality_scores(kept["quality"][0]).where("kept").select("doc_id", "text").collect()
    assert Counter(map(tuple, good)) == Counter(texts["quality"])

    groups = _components(before["near_duplicates"], 5)
    assert sorted(i for i, _ in texts["near_duplicates"]) == sorted({c for _, _, c in groups})

    plain = dict(before["secrets"])
    for i, text in texts["secrets"]:
        found = secrets.scan(plain[i])
        assert (text == plain[i]) == (not found)
        assert not re.search("[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}", text)
    assert all(r.n_chars == len(r.text) for r in kept["secrets"][1].collect())

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = kept["packing"][1].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t")).collect()
    sizes = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts["secrets"]}
    assert {r.doc_id: (r.n, r.t) for r in pieces} == {i: (n, n) for i, n in sizes.items()}


def test_columns_of_clashing_names_are_returned_untouched(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["rows", "_id", "_text", "kept", "quality", "_p", "_lines", "component", "n_words", "found", "text_key"]
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in names})
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == COLUMNS + names
        wrong = F.lit(False)
        for c in names:
            wrong = wrong | (F.col(c) != F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")))
        assert docs.where(wrong).isEmpty() and not docs.isEmpty()


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "secrets", "packing"]
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_stages_exchange_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    names = [f"spark.sql.execution.arrow.{n}" for n in common.BATCH_LIMITS]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.unset(n)
        docs = spark.range(0, 3000, 1, 1).select(
            F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(3).cast("bigint").alias("n_chars")
        )
        corpus_pipeline.quality_rules(spark, docs, SF)
        rows = docs.select("doc_id").mapInArrow(sizes, "n bigint")
        assert rows.agg(F.max("n"), F.sum("n")).first() == (500, 3000)
        spark.conf.set(names[0], "100")
        common.small_batches(spark)
        assert spark.conf.get(names[0]) == "100"
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_a_task_remembers_few_words():
    words = near_dups._WordHashes()
    text = " ".join(f"w{i}" for i in range(3 * near_dups.REMEMBERED_WORDS))
    found = near_dups.shingles(text, words, 4)
    assert len(found) == 3 * near_dups.REMEMBERED_WORDS - 3 and len(words) <= near_dups.REMEMBERED_WORDS <= 50_000
    assert (near_dups.shingles(text, near_dups._WordHashes(), 4) == found).all()


def test_a_task_redacts_with_one_python_process(spark):
    rows = [(1, "password = abcdef123; token=abcdefgh", "en", "s", 3), (2, None, None, None, 0), (3, "plain", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = corpus_pipeline.secret_scans(spark, docs, SF)
    assert {r.doc_id: (r.text, r.n_chars) for r in found.collect()} == {1: ("[assign]; [assign]", 18), 2: (None, 0), 3: ("plain", 5)}
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
