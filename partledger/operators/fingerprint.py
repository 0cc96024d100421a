"""Order-independent content fingerprints of partitions, and multiset differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partledger.functions import jsontext
from partledger.functions.digests import hex_word, limb_sum_hex, limbs, swap_bytes
from partledger.functions.names import two_digits
from partledger.session import store
from partledger.spec import FINGERPRINT_VERSION, KEY


def format_fingerprint(rows: Column, total: Column, xor: Column) -> Column:
    """``v1:<rows>:<sum>:<xor>``; an empty partition has empty sum and xor."""
    return F.concat_ws(
        ":",
        F.lit(FINGERPRINT_VERSION),
        rows.cast("string"),
        F.coalesce(F.upper(total), F.lit("")),
        F.coalesce(F.upper(xor), F.lit("")),
    )


def row_payload(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """JSON text of each row that the fingerprint hashes."""
    names = list(columns) if columns is not None else df.columns
    return jsontext.row_json([(c, F.col(f"`{c}`"), df.schema[c].dataType) for c in names])


def archived_payload(df: DataFrame) -> Column:
    """Payload of a row read from the archive: the data columns, then ``ano`` as a
    number, ``mes`` as two digits and ``uf``, as the path exposes them."""
    fields = [
        (f.name, F.col(f"`{f.name}`"), f.dataType)
        for f in df.schema.fields
        if f.name not in ("ano", "mes", "uf")
    ]
    fields += [
        ("ano", F.col("ano").cast("bigint"), T.LongType()),
        ("mes", two_digits(F.col("mes")), T.StringType()),
        ("uf", F.col("uf").cast("string"), T.StringType()),
    ]
    return jsontext.row_json(fields)


#: What a fingerprint is made of: counts and sums add up over any split of a group's rows.
PARTS = "rows bigint, low bigint, middle bigint, high bigint, xor bigint"


def fingerprint_parts(df: DataFrame, by: Sequence[str], payload: Column | None = None) -> DataFrame:
    """The :data:`PARTS` of each group of ``by``, to be merged with those of further rows."""
    payload = row_payload(df) if payload is None else payload
    hashed = df.select(*by, F.md5(payload.cast("binary")).alias("_digest")).select(
        *by,
        hex_word(F.col("_digest"), 1).alias("_upper"),
        swap_bytes(hex_word(F.col("_digest"), 17)).alias("_lower"),
    )
    low, middle, high = limbs(F.col("_lower"))
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(low).alias("low"),
        F.sum(middle).alias("middle"),
        F.sum(high).alias("high"),
        F.bit_xor("_upper").alias("xor"),
    )


def merge_parts(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row of parts per group, as if all its rows had been read at once."""
    sums = [F.sum(c).alias(c) for c in ("rows", "low", "middle", "high")]
    return parts.groupBy(*by).agg(*sums, F.bit_xor("xor").alias("xor"))


def finish_parts(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, rows, fingerprint`` of merged parts."""
    total = limb_sum_hex(F.col("low"), F.col("middle"), F.col("high"))
    xor = F.hex(swap_bytes(F.col("xor")))
    return parts.select(*by, "rows", format_fingerprint(F.col("rows"), total, xor).alias("fingerprint"))


def content_fingerprint(
    df: DataFrame, by: Sequence[str], payload: Column | None = None
) -> DataFrame:
    """Row count and multiset fingerprint per group of ``by``.

    Each row is hashed where it is read; counts, limb sums and xor are combined
    before the shuffle, so only one record per (task, group) moves and a hot
    group costs no more than a cold one. Duplicates count: a sum does not cancel.
    With no grouping columns an empty input still yields one row.
    """
    return finish_parts(fingerprint_parts(df, by, payload), by)


def compare_fingerprints(current: DataFrame, published: DataFrame, by: Sequence[str]) -> DataFrame:
    """``new``/``changed``/``unchanged`` per group of ``current`` against ``published``."""
    before = published.select(
        *by,
        F.col("rows").alias("published_rows"),
        F.col("fingerprint").alias("published_fingerprint"),
    )
    outcome = (
        F.when(F.col("published_fingerprint").isNull(), F.lit("new"))
        .when(F.col("fingerprint") == F.col("published_fingerprint"), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return current.join(before, list(by), "left").withColumn("outcome", outcome)


def changed_partitions(data: DataFrame, outcomes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the partitions whose fingerprint is new or different.

    The values each column takes among their keys become constant predicates before the semi
    join, so files of other partitions are not opened, whatever sizes are estimated; there are
    as many values as units, years and months.
    """
    keys = store(outcomes.filter(F.col("outcome") != "unchanged").select(*by), "changed-keys")
    seen = keys.agg(*[F.collect_set(c).alias(c) for c in by]).first()
    near = data
    for c in by:
        near = near.filter(F.col(c).isin(sorted(seen[c])))
    return near.join(keys, list(by), "left_semi")


def row_digests(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row. Which columns are NULL is hashed too, for a hash passes over
    NULL; -0.0 and NaN count as grouping counts them."""
    values = []
    for name in names:
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            value = F.when(value == 0, F.lit(0.0).cast(df.schema[name].dataType)).otherwise(value)
        values += [value.isNull(), value]
    return [F.xxhash64(F.lit(seed), *values).alias(name) for seed, name in ((1, "_first"), (2, "_second"))]


def differing_groups(old: DataFrame, new: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The groups of ``by`` whose rows, as multisets over ``names``, are not the same in both versions.

    Counts and exact sums of both row hashes are combined before the shuffle, as for a fingerprint,
    so one record per task and group moves. ``by`` need not be among ``names``.
    """
    united = None
    for df, sign in ((new, 1), (old, -1)):
        hashed = df.select(*by, *row_digests(df, names))
        pieces = [F.lit(1).cast("bigint"), *limbs(F.col("_first")), *limbs(F.col("_second"))]
        part = hashed.select(*by, *[(p * sign).alias(f"_sum{i}") for i, p in enumerate(pieces)])
        united = part if united is None else united.unionByName(part)
    sums = [c for c in united.columns if c not in by]
    differs = F.lit(False)
    for c in sums:
        differs = differs | (F.col(c) != 0)
    return united.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums]).filter(differs).select(*by)


def revision_diff(
    old: DataFrame, new: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] | None = None
) -> DataFrame:
    """Multiset difference between two versions: each differing row once, with ``copies``.

    ``change`` is ``added`` or ``removed``. Rows meet as 128-bit digests with their net copies,
    added up before the shuffle; only the rows whose digests differ are then taken from the
    version that has more of them. NULLs compare equal.

    ``by`` names columns of both versions, such as those of the partitions: groups of theirs that
    hold the same rows in both are found by sums and add nothing to a difference, so none of their
    rows are moved. The result is the same, at the price of reading both versions once more.
    """
    if by:
        names = list(columns) if columns is not None else new.columns
        keys = store(differing_groups(old, new, names, by).select(*[F.col(c).alias(f"_by_{c}") for c in by]), "differing-groups")
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
        return revision_diff(old.join(keys, same, "left_semi"), new.join(keys, same, "left_semi"), names)
    names = list(columns) if columns is not None else new.columns
    signed = [
        df.select(*row_digests(df, names), F.lit(sign).cast("bigint").alias("_sign")) for df, sign in ((new, 1), (old, -1))
    ]
    keys = ["_first", "_second"]
    net = signed[0].unionByName(signed[1]).groupBy(*keys).agg(F.sum("_sign").alias("_net")).filter(F.col("_net") != 0)
    # Stored, its size is known: a small difference is sent to the rows, not the rows to it.
    net = store(net, "revision-net")

    def rows(df: DataFrame, wanted: Column, change: str) -> DataFrame:
        hashed = df.select(*names, *row_digests(df, names))
        found = hashed.join(net.filter(wanted), keys).groupBy(*keys)
        once = found.agg(*[F.first(f"`{c}`").alias(c) for c in names], F.first("_net").alias("_net"))
        return once.select(*names, F.lit(change).alias("change"), F.abs("_net").alias("copies"))

    return rows(new, F.col("_net") > 0, "added").unionByName(rows(old, F.col("_net") < 0, "removed"))


def diff_changed_partitions(
    old: DataFrame,
    new: DataFrame,
    outcomes: DataFrame,
    by: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Multiset difference that only reads partitions whose fingerprints differ.

    ``outcomes`` is :func:`compare_fingerprints` output; with the old fingerprints taken from
    published documents, the bulk of an archive is neither shuffled nor read twice.
    """
    return revision_diff(
        changed_partitions(old, outcomes, by), changed_partitions(new, outcomes, by), columns
    )


def revision_summary(diff: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows added and removed per group, and whether the revision only appended."""
    added = F.sum(F.when(F.col("change") == "added", F.col("copies")).otherwise(0))
    removed = F.sum(F.when(F.col("change") == "removed", F.col("copies")).otherwise(0))
    out = diff.groupBy(*by).agg(added.alias("added"), removed.alias("removed"))
    return out.withColumn("pure_append", F.col("removed") == 0)


def new_entities(old: DataFrame, new: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Entities (e.g. establishments) of the new version that the old one lacks.

    Both sides are reduced to distinct entities before they meet.
    """
    names = list(entity)
    return new.select(*names).distinct().join(old.select(*names).distinct(), names, "left_anti")


def fingerprint_by_schema(groups: Sequence[tuple[T.StructType, DataFrame]], by: Sequence[str] = KEY) -> DataFrame:
    """Fingerprints of partitions of several schemas, each over the columns it was written with."""
    parts = [content_fingerprint(data, by, archived_payload(data)) for _, data in groups]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united
