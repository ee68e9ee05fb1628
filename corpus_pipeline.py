"""From raw documents to token ids: five stages, each of which reads what the one before it wrote.

1. quality: documents that the classifier scores below one half go.
2. near_duplicates: of each group of documents with alike word shingles one stays, that with the
   smallest doc_id, or if a doc_id has several texts the one with the smallest hash; rows without doc_id
   come last. Rows that repeat both doc_id and text are one; rows without doc_id and words stay.
3. decontaminate: documents that hold a benchmark item go.
4. pii: spans of personal data become their kind in brackets, and n_chars counts anew.
5. bpe: the documents' token ids.

A stage takes ``(spark, docs, sf_dir)``. A NULL text counts as empty. Extra columns stay until the last
stage, nulls in them too; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm import op2_jaccard_join, op6_bpe_automaton, op8_quality, op9_decontaminate, op10_pii
from strataframe.llm.tables import cut_lineage, table, text_hash, unused, vocabulary

KEPT_SCORE = 0.5
SHINGLE_WORDS = 5
SIMILARITY = (4, 5)  # 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op8_quality.fit(docs, table(spark, sf_dir, "labels"))
    name = unused(docs.columns, "_score")
    return op8_quality.score(docs, model, name).where(F.col(name) >= KEPT_SCORE).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = op2_jaccard_join.near_copies(docs, SHINGLE_WORDS, *SIMILARITY)
    # Keys without nulls, so that repeats meet where the join puts them.
    names = [unused(docs.columns, n) for n in ("_none", "_id", "_hash")]

    def keyed(rows: DataFrame, hashed: Column) -> DataFrame:
        keys = (F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), hashed)
        return rows.withColumns(dict(zip(names, keys)))

    lone = F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    once = keyed(docs.where(~lone), text_hash()).dropDuplicates(names)
    kept = once.join(keyed(gone, F.col("text_hash")).select(*names), names, "left_anti")
    return kept.select(*docs.columns).unionByName(docs.where(lone))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = op10_pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = op6_bpe_automaton.encode_decode(docs.select("doc_id", "lang", "source", "text"), vocabulary(), decode=False)
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("bpe", bpe),
]

# The classifier, the joins on fingerprints and the encoder cannot be said in SQL; tests compare them with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut_lineage(docs)
    return docs
