"""A corpus from documents to packed sequences, in five stages.

Each stage works on all that the one before kept. The table between two stages is written as Parquet to the shared folder, so a
lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm.exact_dedup import distinct_documents
from corvane.llm.mixing import mixed_documents
from corvane.llm.packing import pack_documents
from corvane.llm.quality import good_documents
from corvane.llm.simhash_dedup import representative_documents
from corvane.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score under 0.3) go.

    Null and empty texts are judged like any other, by the score of an empty text. Null identifiers are judged; repeated rows share
    their fate. Other columns pass unchanged, whatever their names. An empty table stays empty.
    """
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id stays.

    Null text equals empty text. A null identifier stays only where no other row has the text. Of rows that repeat an identifier and
    its text one stays. Other columns pass unchanged, whatever their names. An empty table stays empty.
    """
    return distinct_documents(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest doc_id stays.

    Texts without words, null ones too, link with each other. Rows with a null identifier go where a document with one is in their
    group, else they stay. Rows that repeat the kept identifier and fingerprint stay. Other columns pass unchanged, whatever their
    names. An empty table stays empty.
    """
    return representative_documents(docs, words=3, radius=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: documents are left out or repeated, whole.

    Null and empty texts have no words: they're taken as often as their source is as a whole. Null sources are one source. Null
    identifiers rank alike, repeated rows side by side. Other columns pass unchanged, whatever their names. An empty table stays empty.
    """
    return mixed_documents(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are tokenised and packed into sequences of at most 4096 tokens: one row a piece.

    Null and empty texts are one end token. Repeated rows are packed each; null identifiers stay null. Other columns are left behind,
    whatever their names. An empty table gives no rows.
    """
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, 1)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("packing", packing)]
ORACLE_SQL = None  # classifier, fingerprints and tokenizer aren't expressible; tests/llm/test_pipeline.py has brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
