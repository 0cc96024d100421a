"""A corpus pipeline: toxic documents go, one of each group of near copies stays, benchmark
passages are cut out, sources are mixed to target weights, and documents are dealt to shards.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on; ``run`` writes
each result as Parquet to the shared folder and reads it back for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.llm import decontamination, jaccard, mixing, sharding, toxicity
from partledger.llm.common import keep_batches_small, new_folder, read_table, store
from partledger.llm.registered import SHARDS, learn_lexicon

#: Words in a shingle, and the similarity of near copies in percent, of the stage; the query op7 has its own.
NEAR_WIDTH = 5
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; learned from the labels that are not held out.

    NULL and empty texts are not toxic and stay; repeated rows have one fate; no rows, none.
    """
    # The stage's last job runs when its result is written.
    keep_batches_small(spark)
    lexicon = learn_lexicon(spark, docs, sf_dir)
    return docs.filter(toxicity.score_udf(lexicon)("text") < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similar ones link, by the stage's own width and percent.

    Rows without words stay; NULL and repeated ids are told by their texts; no rows, none.
    """
    keep_batches_small(spark)
    return jaccard.keep_one(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with benchmark items.

    NULL and empty texts stay as they are, repeated rows are cut alike; no rows, none.
    """
    keep_batches_small(spark)
    return decontamination.remove_contamination(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the shard of their virtual slot."""
    slot_map = sharding.next_map(spark, sharding.slot_loads(docs), SHARDS, new_folder(spark, "slot-map"), 1)
    return sharding.assign_shards(docs, slot_map).withColumn("size", sharding.record_size(F.col("text")))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: Learned weights and hashes are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
