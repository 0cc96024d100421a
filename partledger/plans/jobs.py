"""The archive's jobs. Each composes operators over DataFrames; the control tables that
link them are DataFrames too, so a whole cycle can run in one program.

A table that several outputs of a job share is stored once in the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.functions import names
from partledger.operators import (
    catalog,
    catchup,
    delta,
    fingerprint,
    lineage,
    listing,
    unchanged,
    verification,
)
from partledger.session import store
from partledger.sinks import archive as archive_sink
from partledger.spec import DEFAULT_BUDGET_BYTES, KEY, SIA_PA, WRITTEN, DatasetSpec


@dataclass(frozen=True)
class Detection:
    pending: DataFrame
    reasons: DataFrame
    latest_pending: DataFrame
    previous_newest: DataFrame


def detect_new(
    source_listing: DataFrame,
    state: DataFrame,
    spec: DatasetSpec = SIA_PA,
    window_months: int = 0,
    legacy_since: datetime | None = None,
) -> Detection:
    """Group the listing, compare it with the state, and list what is pending."""
    groups = listing.group_listing(source_listing, spec)
    pending = store(delta.select_pending(groups, state, window_months, legacy_since), "pending")
    return Detection(
        pending=pending,
        reasons=delta.reason_counts(pending),
        latest_pending=delta.newest_period(pending),
        previous_newest=delta.newest_period(state),
    )


def archive(
    targets: DataFrame,
    existing: DataFrame,
    status: DataFrame,
    source_listing: DataFrame,
    records: DataFrame,
    cache: DataFrame,
    data_root: str,
    lineage_root: str,
    spec: DatasetSpec = SIA_PA,
) -> DataFrame:
    """Archive the targets that are not there yet; returns their status.

    ``records`` are decoded records of all targets with ``KEY`` and ``source_name``;
    only those from the files the archive chooses, at their listed size in the cache,
    are written. A target without files or with a file of another size fails as a whole, so
    versions never mix.
    """
    todo = archive_sink.skip_existing(targets, existing, status)
    groups = listing.group_listing(source_listing, spec)
    files = listing.resolve_partition_files(groups.join(todo, KEY, "left_semi"), spec)
    held = cache.select(
        "name", F.col("bytes").alias("_held"), F.col("mtime").alias("cache_mtime")
    )
    checked = files.join(held, "name", "left")
    whole = checked.groupBy(*KEY).agg(
        F.bool_and(F.coalesce(F.col("_held") == F.col("size"), F.lit(False))).alias("_whole")
    )
    record = lineage.build_sources_record(checked, spec)
    texts = (
        todo.select(*KEY)
        .join(record, KEY, "left")
        .join(whole, KEY, "left")
        .select(
            *KEY,
            F.when(F.col("_whole"), lineage.sources_record_text(F.col("record"))).alias("record_text"),
        )
    )
    chosen = files.select(F.col("name").alias("source_name"))
    data = records.join(chosen, "source_name", "left_semi").drop("source_name")
    return archive_sink.write_lineage_then_data(
        store(texts, "lineage"), data, lineage_root, data_root, spec
    )


def verify(
    pending: DataFrame, staged: DataFrame, headers: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All pending partitions with status, the approved, and the rejected."""
    counts = verification.partition_row_counts(staged)
    result = store(verification.verify_partitions(pending, counts, headers), "verification")
    return (result, *verification.split_verified(result))


def skip_unchanged(
    verified: DataFrame, staged: DataFrame, documents: DataFrame, previous_newest: Column
) -> tuple[DataFrame, DataFrame]:
    """Outcome per verified partition, and the release period of the run."""
    to_hash = staged.join(verified.select(*KEY).distinct(), KEY, "left_semi")
    local = fingerprint.content_fingerprint(to_hash, KEY, fingerprint.archived_payload(staged))
    published = unchanged.published_fingerprints(documents)
    outcomes = store(unchanged.skip_unchanged(verified, local, published), "unchanged")
    return outcomes, unchanged.release_of_run(outcomes, previous_newest)


def mark_processed(
    state: DataFrame, pending: DataFrame, status: DataFrame, verified: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """New state, and the outcome of every pending partition."""
    outcomes = store(
        delta.mark_processed(pending, delta.archived_status(status), verified), "processed"
    )
    merged = outcomes.filter(F.col("outcome") == "merged").select(
        "uf", names.period(F.col("ano"), F.col("mes")).alias("period"), "size", "mtime"
    )
    return delta.upsert_state(state, merged), outcomes


def emit_provenance(
    staged: DataFrame,
    partitions: DataFrame,
    cache: DataFrame,
    dataset: str,
    generated_at: Column,
    pipeline: dict[str, str],
    spec: DatasetSpec = SIA_PA,
    allow_cache_fallback: bool = False,
    described: DataFrame | None = None,
    prints: DataFrame | None = None,
) -> DataFrame:
    """Outcome of each partition, with the document ``text`` of those written.

    ``partitions``: ``KEY, record_text, kept_text, parquet_sha``. ``described`` (``KEY, schema``,
    as ``publish.describe_published`` gives it) and ``prints`` (as ``fingerprint_by_schema``
    does) say what each partition was written with; without them ``staged`` has one schema.
    """
    chosen = lineage.choose_sources(partitions, cache, spec, allow_cache_fallback)
    outcomes = lineage.emission_outcomes(chosen, allow_cache_fallback)
    described = lineage.describe_output(staged) if described is None else described
    if prints is None:
        prints = fingerprint.content_fingerprint(staged, KEY, fingerprint.archived_payload(staged))
    full = (
        outcomes.join(described.select(*KEY, "schema"), KEY, "left")
        .join(prints, KEY, "left")
        .withColumn("sha256", F.col("parquet_sha"))
    )
    body = lineage.provenance_body(full, dataset, generated_at, pipeline)
    text = F.when(F.col("kind") == WRITTEN, lineage.provenance_text(F.col("body")))
    return body.select(*KEY, "kind", "legacy", "from_cache", "problem", "drop_document", text.alias("text"))


def build_manifest(
    partitions: DataFrame, published: DataFrame | None = None
) -> DataFrame:
    """Catalog rows; guarded against losing partitions when the published one is given."""
    manifest = catalog.summarize_manifest(partitions)
    return manifest if published is None else catalog.guard_manifest(manifest, published)


def audit(
    source_listing: DataFrame, headers: DataFrame, published: DataFrame, spec: DatasetSpec = SIA_PA
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Problems in report order, keys only in the published tree, and the summary."""
    counts = verification.partition_row_counts(published)
    result = store(verification.audit_partitions(source_listing, headers, counts, spec), "audit")
    return (
        verification.audit_problems(result),
        verification.only_in_published(result),
        verification.audit_summary(result),
    )


@dataclass(frozen=True)
class Catchup:
    selection: DataFrame
    certification: DataFrame
    budgeted: DataFrame
    outcomes: DataFrame
    documents: DataFrame


def provenance_catchup(
    objects: DataFrame,
    documents: DataFrame,
    pending: DataFrame,
    source_listing: DataFrame,
    state: DataFrame,
    cache: DataFrame,
    headers: DataFrame,
    described: Callable[[DataFrame], DataFrame],
    dataset: str,
    generated_at: Column,
    pipeline: dict[str, str],
    notes: str,
    spec: DatasetSpec = SIA_PA,
    budget: int = DEFAULT_BUDGET_BYTES,
    fetched: DataFrame | None = None,
) -> Catchup:
    """Retroactive provenance. Cheap table joins decide which partitions qualify before any
    data is scanned: ``described`` is called with the selected keys only and returns
    ``KEY, rows, fingerprint, schema, sha256``. ``cache`` says what need not be downloaded,
    ``fetched`` (by default the cache) which sources were then read, with size, time and hash.
    A partition with a source that is missing or unlike its listing fails and gets no document.
    """
    partitions = catchup.published_partitions(objects, documents, dataset)
    selection = store(catchup.select_candidates(partitions, pending), "selection")
    candidates = selection.filter(F.col("selection") == "candidate").withColumn(
        "last_modified", F.col("parquet.last_modified")
    )
    groups = listing.group_listing(source_listing, spec)
    certification = store(
        catchup.certify_sources(candidates, groups, state, spec), "certification"
    )
    certified = certification.filter(F.col("skip_reason").isNull())
    need = catchup.download_need(certified, cache)
    budgeted = store(catchup.budget_prefix_cut(need, budget), "budget")
    chosen = certified.join(
        budgeted.filter(F.col("decision") == "selected").select(*KEY), KEY, "left_semi"
    )
    outputs = store(described(chosen.select(*KEY)), "outputs")
    files = chosen.select(*KEY, F.posexplode("files").alias("position", "_f")).select(
        *KEY, "position", "_f.name", "_f.size", "_f.path"
    )
    per_file = files.join(headers.select("name", "records"), "name", "left")
    counts = store(
        verification.check_record_count(
            outputs.select(*KEY, "rows"), per_file.select(*KEY, "records"), KEY
        ),
        "counts",
    )
    fetched = cache if fetched is None else fetched
    faults = store(catchup.source_faults(files, fetched), "source-faults")
    source = F.struct(
        F.col("size").alias("bytes"),
        F.col("name").alias("file"),
        F.col("path").alias("ftpPath"),
        F.col("_c.mtime").alias("mtime"),
        F.col("_c.sha256").alias("sha256"),
    )
    held = fetched.select("name", F.struct("mtime", "sha256").alias("_c"))
    sources = (
        files.join(held, "name", "left")
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("position", source.alias("s")))).alias("_s"))
        .select(*KEY, F.transform("_s", lambda e: e["s"]).alias("sources"))
    )
    good = counts.filter(F.col("problem").isNull()).select(*KEY).join(faults, KEY, "left_anti")
    full = (
        chosen.join(good, KEY, "left_semi").join(outputs, KEY).join(sources, KEY)
    )
    body = catchup.add_reconstruction(
        lineage.provenance_body(full, dataset, generated_at, pipeline), notes
    )
    return Catchup(
        selection=selection,
        certification=certification,
        budgeted=budgeted,
        outcomes=catchup.run_outcomes(certification, budgeted, counts, faults),
        documents=body.select(*KEY, lineage.provenance_text(F.col("body"), True).alias("text")),
    )
