"""A corpus pipeline of the llm operators: language ID, near and exact duplicates, mixing and packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of documents; further columns of docs are left out, whatever their names. Of an empty table near duplicates and
repeated passages return none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.llm import langid, mixing, packing, repeats, setsketch
from arbora.llm.workspace import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know, with lang set to the identified one; rejected ones go.

    Texts that are null or have no letters are rejected.
    """
    model = langid.train(docs)
    found = langid.identify(docs, model, COLUMNS)
    return found.where("not rejected").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id. Five words a shingle, similarity 0.8.

    Rows of one id are one document and stay or go together, those without words too. Rows without an id stay.
    """
    gone = setsketch.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of their long repeated passages; those of which nothing is left go.

    Null, empty and short texts, and rows without an id, stay as they are where they repeat nothing.
    """
    cut = repeats.deduplicate(docs, keep=("doc_id", "lang", "source", "n_chars")).where("n_removed = 0 or n_removed < n_bytes")
    n_chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order and as often as the curriculum takes them: see mixing.curriculum for nulls, ties and repeats."""
    return mixing.curriculum(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens. A null text is empty and has its end token only."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", identify_languages),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models, sketches and packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
