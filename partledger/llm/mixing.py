"""Mixing sources to target weights by Sainte-Laguë apportionment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partledger.llm.common import WORD, store

#: Sources weigh 1, 2, 3, 1, 2, 3 ... in the order of their names.
WEIGHTS = (1, 2, 3)
#: No document is taken more often than this.
MOST_REPEATS = 3
#: Words in a block, the unit of the apportionment.
BLOCK_WORDS = 256
#: Output shards that each get integer quotas of blocks.
SHARDS = 16
#: The line of a source is summed in so many pieces, so that a hot source is no single task's.
LINE_PIECES = 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(
    totals: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """Adds ``target`` to ``source, source_size``.

    The sources share the sum of all sizes by weight. A target stops at ``most`` times its
    source's size; what is left over is shared by weight among the rest, until none is
    above. Only sums over sources reach the driver, one row per round.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    factors = F.array(*[F.lit(w) for w in weights])
    weighed = store(
        totals.withColumn("weight", F.get(factors, (place % len(weights)).cast("int")).cast("long"))
        .withColumn("most", F.col("source_size") * most),
        "mix-sources",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    unit, capped_before = 0.0, -1
    while True:
        capped = F.col("most") < F.col("weight") * F.lit(unit)
        full, n, free = weighed.agg(
            F.coalesce(F.sum(F.when(capped, F.col("most"))), F.lit(0)),
            F.count(F.when(capped, 1)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
        ).first()
        if n == capped_before or not free:
            break
        unit, capped_before = (total - full) / free, n
    return weighed.withColumn(
        "target", F.least(F.col("weight") * F.lit(unit), F.col("most").cast("double"))
    ).drop("weight", "most")


def shard_quotas(
    targets: DataFrame, seed: int, block_words: int = BLOCK_WORDS, shards: int = SHARDS
) -> DataFrame:
    """``source, shard, first_block, blocks``: which blocks of its line a source gives to a shard.

    The house of all blocks is filled by highest quotients target / (2 k - 1). The method
    never takes a seat back when the house grows, so the seats up to each shard's end nest
    and their differences are the shard's quotas. For every end only the seats that are in
    doubt compete: with divisor total / seats, n sources miss the house by n / 2 at most.
    """
    n, total = targets.agg(F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    house = max(1, round(total / block_words)) if total else 0
    ends = (
        F.explode(F.sequence(F.lit(1), F.lit(shards)))
        if house
        else F.explode(F.array().cast("array<int>"))
    )
    seats = F.round(F.col("shard") * F.lit(house) / F.lit(shards)).cast("long")
    share = F.col("target") / F.lit(total or 1.0)
    low = F.floor(share * F.greatest(F.col("seats") - F.lit(n / 2), F.lit(0)) - 0.5 - 1e-6)
    high = F.ceil(share * (F.col("seats") + F.lit(n / 2)) + 0.5 + 1e-6)
    bounds = (
        targets.filter("target > 0")
        .select("source", "target", ends.alias("shard"))
        .withColumn("seats", seats)
        .withColumn("low", F.greatest(low, F.lit(0)).cast("long"))
        .withColumn("high", high.cast("long"))
    )
    doubt = bounds.select(
        "source", "target", "shard", "seats", "low", F.explode(F.sequence(F.col("low") + 1, "high")).alias("k")
    )
    sure = bounds.groupBy("shard").agg(F.sum("low").alias("sure"))
    best = Window.partitionBy("shard").orderBy(
        (F.col("target") / (2 * F.col("k") - 1)).desc(), F.xxhash64(F.lit(seed), "source"), "k"
    )
    won = (
        doubt.join(sure, "shard")
        .withColumn("place", F.row_number().over(best))
        .groupBy("source", "shard")
        .agg(
            (F.first("low") + F.count(F.when(F.col("place") <= F.col("seats") - F.col("sure"), 1))).alias("end")
        )
    )
    before = F.coalesce(F.lag("end").over(Window.partitionBy("source").orderBy("shard")), F.lit(0))
    return won.select(
        "source", "shard", before.alias("first_block"), (F.col("end") - before).alias("blocks")
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 17,
) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken, shard_words, copies`` of every row.

    A source's documents lie end to end on a line in seeded order, and the line is cut into
    blocks of ``block_words``; the seeded order makes its first blocks a random choice. The
    source's quota of blocks runs along the line, again from its start after its end, at
    most ``most`` times. ``taken`` counts the words of a document on the blocks that the
    quota covers, repeats included; one document of a source at most is cut. ``shard_words``
    lists the words per shard as ``(shard, words)``. ``copies`` is ``taken`` in whole
    documents, rounded.

    Rows equal in id, source and size share one place on the line and get the same part.
    A NULL source is a source of its own; NULL texts and texts without words have size 0 and
    nothing is taken of them; a NULL id is a value like any other. Other columns are ignored.
    An empty table gives no rows.
    """
    units = store(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
        )
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("rows")),
        "mix-units",
    ).withColumn("length", F.col("size") * F.col("rows"))
    # Mixed again: a partition's rows would otherwise all have hashes near each other.
    spot = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    units = units.withColumn("spot", spot).withColumn("piece", F.pmod(F.shiftright("spot", 20), F.lit(LINE_PIECES)))
    totals = units.groupBy("source").agg(F.sum("length").alias("source_size"))
    targets = source_targets(totals, weights, most)
    quotas = shard_quotas(targets, seed, block_words, shards)
    per_source = quotas.groupBy(F.col("source").alias("_owner")).agg(
        F.array_sort(F.collect_list(F.struct("shard", "first_block", "blocks"))).alias("quotas")
    )
    plan = targets.join(per_source, F.col("source").eqNullSafe(F.col("_owner")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "quotas"
    )

    lengths = units.groupBy("source", "piece").agg(F.sum("length").alias("piece_length"))
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lengths.select(
        F.col("source").alias("_line"),
        F.col("piece").alias("_piece"),
        F.coalesce(F.sum("piece_length").over(earlier), F.lit(0)).alias("offset"),
    )
    offsets = offsets.join(plan, F.col("_line").eqNullSafe(F.col("_source"))).drop("_source")
    inside = (
        Window.partitionBy("source", "piece")
        .orderBy("spot", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = units.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    placed = placed.join(
        offsets, F.col("source").eqNullSafe(F.col("_line")) & (F.col("piece") == F.col("_piece"))
    ).drop("_line", "_piece")
    start = F.col("offset") + F.col("inside")

    def covered(low: Column, high: Column) -> Column:
        """Words of the document on the endless repetition of its line, between two points."""

        def up_to(point: Column) -> Column:
            whole = F.floor(point / F.col("source_size"))
            part = F.least(
                F.greatest(point - whole * F.col("source_size") - F.col("start"), F.lit(0)), F.col("length")
            )
            return whole * F.col("length") + part

        end = F.lit(most) * F.col("source_size")
        return F.when(F.col("length") > 0, up_to(F.least(high, end)) - up_to(F.least(low, end))).otherwise(0)

    shard_words = F.filter(
        F.transform(
            "quotas",
            lambda q: F.struct(
                q["shard"].alias("shard"),
                covered(q["first_block"] * block_words, (q["first_block"] + q["blocks"]) * block_words)
                .cast("long")
                .alias("words"),
            ),
        ),
        lambda x: x["words"] > 0,
    )
    result = placed.withColumn("start", start).withColumn("shard_words", F.coalesce(shard_words, F.array()))
    taken = F.aggregate("shard_words", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return result.withColumn("taken", F.floor(taken / F.col("rows")).cast("long")).select(
        "doc_id",
        "size",
        "source",
        "source_size",
        F.round("target", 6).alias("target"),
        "taken",
        "shard_words",
        F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int").alias("copies"),
        "rows",
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken``."""
    mixed = mix_sources(docs, **options)
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_row")
    ).drop("_row")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, all columns kept, each as often as the mix takes it."""
    parts = mix_sources(docs, id_col, text_col, source_col, **options).filter("copies > 0").select(
        F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"), F.col("copies").alias("_mix_copies")
    )
    match = (
        F.col("_mix_id").eqNullSafe(F.col(id_col))
        & F.col("_mix_source").eqNullSafe(F.col(source_col))
        & (F.col("_mix_size") == word_count(F.col(text_col)))
    )
    repeated = docs.join(parts, match).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
    return repeated.select(*docs.columns)
