"""From documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. ``run`` writes every stage's result as Parquet to the shared folder and
reads it again, so a lost executor repeats at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldtide.llm import jaccard, langid, linededup, packing, quality
from coldtide.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Predictions below this score are rejected.
LEAST_SCORE = 0.5
#: Five words and 80 percent, for shingles of near duplicates.
NEAR = jaccard.Similarity(words=5, percent=80)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject by base rules and by lost boilerplate; remove boilerplate lines."""
    return _counted(quality.apply(docs))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts of no language or of a doubtful one; fill in missing lang."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predicted(docs, model, keep=COLUMNS).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove equal and near lines but the earliest; emptied documents go."""
    return _counted(linededup.apply(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the least id of each group of near duplicates."""
    return jaccard.apply(docs, NEAR).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack into sequences of 4096 tokens."""
    import public_tokenizers

    return packing.packed(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("n-gram jaccard join", near_duplicates),
    ("best-fit packing", pack),
]

#: Tokenizing and connected components are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
