"""From raw documents to training tokens: toxic documents out, repeated lines out, one document per group of near
copies, contaminated documents out, then token ids.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the docs of
the next one. All but the last return the columns of their docs. A stage judges what its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from candlewick.session import stage


def by_place(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The docs under neutral column names, which no operator's results share, and each name's neutral one."""
    names = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of one half or more go; labels of the held-out fold are not learned from.

    Each row is judged by its own text. Null and empty texts score as no evidence and stay.
    """
    plain, names = by_place(docs)
    labels = toxicity.learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    labels = labels.select(F.col("doc_id").alias(names["doc_id"]), "toxic")
    scored = toxicity.score_toxicity(plain, labels, names["text"], names["doc_id"], passages=False, keep=plain.columns)
    return scored.where("score < 0.5").select(*plain.columns).toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five or more documents hold stay in the one with the largest id; n_chars follows the new text.

    All rows stay; a text that loses all lines becomes empty, as a null one does.
    """
    plain, names = by_place(docs)
    kept = line_dedup.dedup_lines(plain, names["text"], names["doc_id"])
    if "n_chars" in docs.columns:
        kept = kept.withColumn(names["n_chars"], F.length(names["text"]).cast(docs.schema["n_chars"].dataType))
    return kept.select(*plain.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the least id; rows without an id come after those with one.

    Repeated ids are no copies: rows of one id with unlike texts stay.
    """
    plain, names = by_place(docs)
    return simhash.keep_one(plain, names["text"], names["doc_id"]).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words inside benchmark windows go.

    Each row is judged by its own text. Texts without words stay.
    """
    plain, names = by_place(docs)
    found = decontaminate.find_passages(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), names["text"], plain.columns)
    return found.where(~decontaminate.contaminated()).select(*plain.columns).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token number, ids and decoded text of every document left, as digests."""
    return bpe.encode(docs, digest=bpe.sha)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: SQL can't express a fitted classifier, XXH64 fingerprints or BPE; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
