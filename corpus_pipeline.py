"""A training-corpus pipeline of five operators, from documents to shuffled shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, to be written as
Parquet and read again as the next one's docs; all but the last return the columns
of documents. A stage reads all that its predecessor kept:

1. language    documents whose language cannot be told (no text, no letter) go; the
               predicted language and its score decide nothing;
2. dedup       one document of each group of near-duplicates stays (5-word
               shingles, similarity 0.8 or more; the smallest doc_id);
3. benchmark   documents that hold a benchmark window of 10 words go;
4. mix         sources are brought to their target weights; a document comes as
               often as it is taken;
5. shard       records are shuffled into 16 shards and get shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfarer.llm import common as C
from wayfarer.llm import decontaminate, language, minhash, mixing, sharding


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose predicted language isn't ``und``."""
    model = language.train(docs.where(~language.held_out()))
    found = (language.identify(docs, model).where(f"lang_pred <> '{language.UNKNOWN}'")
             .select("doc_id", "doc_key").distinct().toDF("_lang_id", "_lang_key"))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_lang_id"])
                     & (C.text_key(docs["text"]) == found["_lang_key"]), "left_semi")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, C.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.materialise(docs)


def shuffle_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shuffle(docs, shards=16)


STAGES = [
    ("language", identify_language),
    ("dedup", drop_near_duplicates),
    ("benchmark", drop_contaminated),
    ("mix", mix_sources),
    ("shard", shuffle_into_shards),
]

# Language prediction and shuffling have no SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result stored for the next."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
