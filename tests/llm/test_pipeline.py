"""The pipeline against plain versions of its stages, and with rows that are hard to handle."""

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from candlewick import session
from candlewick.llm import toxicity
from tests.llm import test_bpe, test_decontaminate, test_line_dedup, test_simhash
from tests.llm.helpers import ODD

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain(docs, items, toxic):
    docs = [(i, t) for i, t in docs if i not in toxic]
    docs = [(i, t) for i, _, _, t in test_line_dedup.plain(docs)]
    docs = [(i, t) for i, t in docs if i is None or i in {c for _, _, c in test_simhash.plain(docs)}]
    bad = {i for i, n, hit, _ in test_decontaminate.plain(docs, items) if hit and 20 * hit >= n}
    out = []
    for i, t in docs:
        if i is None or i not in bad:
            n, ids, decoded = test_bpe.expected(t)
            out.append((i, n, *(hashlib.sha256(x.encode()).hexdigest() for x in (ids, decoded))))
    return sorted(out, key=str)


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = toxicity.learnable(spark.read.parquet(f"{sf}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, labels).where("score >= 0.5").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()], items, toxic) and len(got) > 100


def table(spark, rows):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], schema)


def test_odd_rows(spark, tmp_path):
    rows = [r for r in ODD if r != ODD[5]] + [(50 + i, "one line that is repeated in a lot of documents\nand a tail " + str(i) * 30) for i in range(6)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, "Hello World it s 2024"), (2, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, str(tmp_path))
        assert out.columns == COLUMNS and out.schema == docs.schema, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    got = sorted(map(tuple, last.collect()), key=str)
    assert got == plain(rows, items, set())


def test_clashing_columns(spark, tmp_path):
    """Columns that have the names of the operators' results and keys pass through as they are."""
    own = ["score", "evidence", "n_lines", "n_dropped", "n_hit", "n_words", "spans", "items", "fp", "component_id", "kept_key", "key", "column_1", "k0"]
    rows = [(i, f"document number {i} says something of its own, {i * 37}", None, "s", 1) for i in range(12)] + [(3, None, None, "s", 0)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in own})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "document number 5 says something")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = session.stage(function(spark, docs, str(tmp_path)), "clash")
        assert docs.columns == [*COLUMNS, *own], name
        assert all(r[c] == f"{c}{r.doc_id}" for r in docs.collect() for c in own), name
    kept = {r.doc_id for r in docs.collect()}
    assert 5 not in kept and {0, 1, 11} <= kept


def test_near_duplicates_of_null_and_repeated_ids(spark):
    texts = [" ".join(f"{w}{i}" for w in "one two three four five six seven eight nine ten".split()) for i in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1]), (None, texts[0]), (None, texts[2]), (None, texts[2]), (None, texts[2])]
    got = corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), "")
    assert got.columns == COLUMNS
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == [(1, texts[0]), (1, texts[1]), (None, texts[2])]


def test_empty_tables(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
