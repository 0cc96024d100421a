"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII whitespace characters.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all machines of a cluster share.

    Where the setting is absent, a local session gets a temporary folder and a cluster
    an error: each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it.

    Inside higher-order functions a plain reuse of an expression would evaluate it again
    for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for NULL."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(flat, " "), lambda w: w != "")


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def hash_share(seed: int, key: Column, share: Column | float) -> Column:
    """Whether a row belongs to the given share of all keys, by their hash: no sort, no limit, the same in every run."""
    share = F.lit(share) if isinstance(share, (int, float)) else share
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 31)) < share * float(1 << 31)


def batch_settings(rows: int, size: str) -> dict[str, str]:
    return {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": size,
    }


def keep_batches_small(spark: SparkSession, rows: int = 1000, size: str = "2m") -> None:
    """Small Arrow batches from now on, for results that are only computed after a function returns."""
    for key, value in batch_settings(rows, size).items():
        spark.conf.set(key, value)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "2m") -> Iterator[None]:
    """Arrow batches of fewer rows and bytes for the jobs that run inside, so that workers stay small."""
    wanted = batch_settings(rows, size)
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
