"""Retroactive provenance: selection, certification and budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partledger.functions import names, rules
from partledger.functions.digests import multipart_tag
from partledger.functions.times import iso_millis
from partledger.operators.listing import archived_files
from partledger.spec import (
    ABSENT,
    CURRENT,
    KEY,
    LEGACY,
    MIN_SOURCE_AGE_HOURS,
    SIA_PA,
    SKIP_MTIME,
    SKIP_NO_STATE,
    SKIP_NOT_LISTED,
    SKIP_REWRITTEN,
    SKIP_ROW_COUNT,
    SKIP_SIZE,
    UNREADABLE,
    DatasetSpec,
)


def published_partitions(objects: DataFrame, documents: DataFrame, dataset: str) -> DataFrame:
    """Published data objects with their provenance: ``listed`` and ``text`` are separate facts.

    ``objects``: ``key, size, etag, last_modified``; ``documents``: ``key, text``.
    """
    parsed = objects.withColumn("_p", names.parse_partition_key(F.col("key"), dataset))
    parsed = parsed.filter(F.col("_p").isNotNull())
    data = parsed.filter(F.col("_p.kind") == "parquet").select(
        *[F.col(f"_p.{c}").alias(c) for c in KEY],
        F.struct("key", "size", "etag", "last_modified").alias("parquet"),
        names.provenance_key(
            F.lit(dataset), F.col("_p.ano"), F.col("_p.uf"), F.col("_p.mes")
        ).alias("_document"),
    )
    listed = parsed.filter(F.col("_p.kind") == "provenance").select(
        F.col("key").alias("_document"), F.lit(True).alias("_listed")
    )
    texts = documents.select(F.col("key").alias("_document"), "text")
    out = data.join(listed, "_document", "left").join(texts, "_document", "left")
    return out.select(
        *KEY,
        "parquet",
        F.coalesce("_listed", F.lit(False)).alias("listed"),
        F.when(F.col("_listed"), F.col("text")).alias("text"),
    )


def select_candidates(partitions: DataFrame, pending: DataFrame) -> DataFrame:
    """Adds ``selection`` (pending, candidate, current, unreadable), ``reason`` and ``previous``."""
    busy = pending.select(*KEY).distinct().withColumn("_pending", F.lit(True))
    situation = F.when(~F.col("listed"), F.lit(ABSENT)).otherwise(
        rules.classify_provenance(F.col("text"))
    )
    out = partitions.join(busy, KEY, "left").withColumn("_situation", situation)
    selection = (
        F.when(F.col("_pending"), F.lit("pending"))
        .when(F.col("_situation") == CURRENT, F.lit("current"))
        .when(F.col("_situation") == UNREADABLE, F.lit("unreadable"))
        .otherwise(F.lit("candidate"))
    )
    chosen = F.col("selection") == "candidate"
    return (
        out.withColumn("selection", selection)
        .withColumn("reason", F.when(chosen, F.col("_situation")))
        .withColumn(
            "previous",
            F.when(chosen & (F.col("_situation") == LEGACY), rules.previous_provenance(F.col("text"))),
        )
        .drop("_pending", "_situation")
    )


def sort_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.orderBy("ano", "mes", "uf")


def certify_sources(
    candidates: DataFrame, groups: DataFrame, state: DataFrame, spec: DatasetSpec = SIA_PA
) -> DataFrame:
    """Whether today's sources are those the published data was made from.

    ``candidates``: ``KEY, last_modified``; ``groups``: grouped listing; ``state``:
    ``uf, period, size``. ``skip_reason`` is NULL when certified; the rules are tried in
    order and the first file that breaks one, in variant order, is named in ``skip_file``.
    """
    listed = groups.select(
        *KEY,
        F.col("size").alias("_size"),
        F.col("mtime").alias("ftp_newest_mtime"),
        F.col("variants").alias("_variants"),
    )
    known = state.select("uf", "period", F.col("size").alias("state_size"), F.lit(True).alias("_known"))
    df = (
        candidates.withColumn("period", names.period(F.col("ano"), F.col("mes")))
        .join(listed, KEY, "left")
        .join(known, ["uf", "period"], "left")
        .withColumn("files", archived_files(F.col("_variants"), F.col("uf"), F.col("ano"), F.col("mes"), spec))
    )
    published = F.col("last_modified")

    def breaks_age(v: Column) -> Column:
        fine = rules.old_enough(v["mtime"], published, MIN_SOURCE_AGE_HOURS)
        return ~F.coalesce(fine, F.lit(False))

    first_bad = F.try_element_at(F.filter("_variants", breaks_age), F.lit(1))
    reason = (
        F.when(F.col("_variants").isNull(), F.lit(SKIP_NOT_LISTED))
        .when(F.col("_known").isNull(), F.lit(SKIP_NO_STATE))
        .when(
            first_bad.isNotNull(),
            F.when(first_bad["mtime"].isNull(), F.lit(SKIP_MTIME)).otherwise(F.lit(SKIP_REWRITTEN)),
        )
        .when(~F.col("_size").eqNullSafe(F.col("state_size")), F.lit(SKIP_SIZE))
        .when(F.size("files") == 0, F.lit(SKIP_NOT_LISTED))
    )
    return (
        df.withColumn("skip_reason", reason)
        .withColumn(
            "skip_file",
            F.when(F.col("skip_reason").isin(SKIP_MTIME, SKIP_REWRITTEN), first_bad["name"]),
        )
        .withColumn("files", F.when(F.col("skip_reason").isNull(), F.col("files")))
        .drop("_known", "_variants", "_size", "period")
    )


def download_need(certified: DataFrame, cache: DataFrame) -> DataFrame:
    """Bytes each certified partition would fetch: files not cached at their listed size."""
    files = certified.select(*KEY, F.explode("files").alias("_f")).select(*KEY, "_f.name", "_f.size")
    held = cache.select("name", F.col("bytes").alias("_held"))
    fetch = F.when(F.col("_held") == F.col("size"), F.lit(0)).otherwise(F.col("size"))
    return files.join(held, "name", "left").groupBy(*KEY).agg(F.sum(fetch).alias("need"))


def budget_prefix_cut(items: DataFrame, budget: int) -> DataFrame:
    """Oldest-first prefix of ``items(uf, ano, mes, need)`` that fits ``budget`` bytes.

    ``decision`` is ``selected``, ``blocked`` (the first that does not fit) or
    ``remaining``; a small item after the blocked one is not taken. The running sum has
    two levels: within a month (at most 676 two-letter units) and over month totals,
    of which there are twelve per year, so no task sees the items as a whole.
    """
    inside = Window.partitionBy("ano", "mes").orderBy("uf").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("ano", "mes").rowsBetween(Window.unboundedPreceding, -1)
    months = (
        items.groupBy("ano", "mes")
        .agg(F.sum("need").alias("_month"))
        .withColumn("_before", F.coalesce(F.sum("_month").over(earlier), F.lit(0)))
        .drop("_month")
    )
    spent = F.col("_before") + F.sum("need").over(inside)
    decision = (
        F.when(F.col("spent") <= budget, F.lit("selected"))
        .when(F.col("spent") - F.col("need") <= budget, F.lit("blocked"))
        .otherwise(F.lit("remaining"))
    )
    return (
        items.join(months, ["ano", "mes"])
        .withColumn("spent", spent)
        .withColumn("decision", decision)
        .drop("_before")
    )


def source_faults(files: DataFrame, fetched: DataFrame) -> DataFrame:
    """``KEY, problem``: partitions with a source that cannot be described, with the first reason.

    ``files``: ``KEY, position, name, size`` as listed; ``fetched``: ``name, bytes, mtime, sha256``
    as read.
    """
    read = fetched.select("name", F.col("bytes").alias("_bytes"), F.col("mtime").alias("_mtime"), F.col("sha256").alias("_sha"))
    problem = rules.source_problem(F.col("_bytes"), F.col("size"), F.col("_sha"), F.col("_mtime"))
    return (
        files.join(read, "name", "left")
        .withColumn("problem", problem)
        .filter(F.col("problem").isNotNull())
        .groupBy(*KEY)
        .agg(F.min_by("problem", "position").alias("problem"))
    )


def run_outcomes(
    certification: DataFrame, budgeted: DataFrame, counts: DataFrame, faults: DataFrame | None = None
) -> DataFrame:
    """One outcome per candidate of a run: skipped (with reason), written, failed or remaining.

    ``counts`` is the record-count check of the selected partitions (``KEY, problem``); one
    whose data could not be counted has failed, as has one in ``faults`` (see
    ``source_faults``), whose reason is its problem. A failure does not stop the others.
    """
    skipped = certification.filter(F.col("skip_reason").isNotNull()).select(
        *KEY, F.lit("skipped").alias("outcome"), F.col("skip_reason").alias("reason")
    )
    done = budgeted.join(counts.select(*KEY, "problem", F.lit(True).alias("_counted")), KEY, "left")
    if faults is None:
        done = done.withColumn("_fault", F.lit(None).cast("string"))
    else:
        done = done.join(faults.select(*KEY, F.col("problem").alias("_fault")), KEY, "left")
    bad = F.col("problem").isNotNull()
    outcome = (
        F.when(F.col("decision") != "selected", F.lit("remaining"))
        .when(F.col("_counted").isNull() | F.col("_fault").isNotNull(), F.lit("failed"))
        .when(bad, F.lit("skipped"))
        .otherwise(F.lit("written"))
    )
    processed = done.select(
        *KEY,
        outcome.alias("outcome"),
        F.when(outcome == "skipped", F.lit(SKIP_ROW_COUNT)).when(outcome == "failed", F.col("_fault")).alias("reason"),
    )
    return skipped.unionByName(processed)


def outcome_counts(outcomes: DataFrame, column: str = "outcome") -> DataFrame:
    return outcomes.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def add_reconstruction(documents: DataFrame, notes: str) -> DataFrame:
    """Extends ``body`` with how the document was reconstructed, as its last field.

    Needs ``rows, ftp_newest_mtime, last_modified, state_size, previous, reason``.
    """
    extra = F.struct(
        F.struct(
            F.col("rows").alias("dbcRecordCount"),
            iso_millis(F.col("ftp_newest_mtime")).alias("ftpNewestMtime"),
            F.lit(MIN_SOURCE_AGE_HOURS).alias("minAgeHours"),
            iso_millis(F.col("last_modified")).alias("parquetLastModified"),
            F.col("state_size").alias("stateSourceSize"),
        ).alias("certification"),
        F.lit(notes).alias("notes"),
        F.col("previous").alias("previous"),
        F.col("reason").alias("reason"),
    )
    return documents.withColumn("body", F.col("body").withField("reconstructed", extra))


def reusable_local_objects(objects: DataFrame, local: DataFrame) -> DataFrame:
    """Published objects whose local copy is the same: equal size and matching tag.

    ``local`` has ``key, size, content``.
    """
    # Tags are made where the content is read; a join would move it.
    tags = local.select(
        "key", "size", F.md5("content").alias("_plain"), multipart_tag(F.col("content")).alias("_parts")
    )
    both = objects.select("key", F.col("size").alias("_published"), "etag").join(tags, "key")
    clean = F.replace("etag", F.lit('"'), F.lit(""))
    same = (F.col("_published") == F.col("size")) & ((clean == F.col("_plain")) | (clean == F.col("_parts")))
    return both.filter(same).select("key", "size", "etag")
