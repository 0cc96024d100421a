"""Merkle manifest of a data set: content-addressed nodes, and proofs by descent from the root.

Every row is a leaf. The leaves of one source form a tree in which each node digests up to
three consecutive nodes below it; the subroots of all sources form one more tree. Nodes are
kept as digest-to-children records, packed by the digest that ``LEVELS`` levels have in common,
so that a tree of any size takes a few shuffles, and a task holds the nodes of a few packs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partledger.llm.common import small_batches, store

FANOUT = 3
#: Levels of the tree in a pack of records; a pack lies above ``FANOUT**LEVELS`` nodes at most.
LEVELS = 7
#: Packs that a Python worker holds at once; each has some hundred kilobytes.
PACKS = 16
SIZE = 32


def leaf_digest(*fields: Column) -> Column:
    """Hexadecimal SHA-256 of the fields: ``-`` for NULL, else length in bytes, ``:``, value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def digest_of(run: bytes) -> bytes:
    """Digest of consecutive digests, each taken as hexadecimal text."""
    return hashlib.sha256(run.hex().encode()).digest()


def height_of(total: int) -> int:
    """Levels above ``total`` nodes until one is left."""
    height = 0
    while total > 1:
        total, height = -(-total // FANOUT), height + 1
    return height


def block_height(total: int, levels: int) -> int:
    return levels if total > FANOUT**levels else height_of(total)


def pack_udf(levels: int):
    def pack(members: pa.Array, totals: pa.Array) -> pa.Array:
        """The records above a block's nodes, and the digest they all lie under."""
        out = []
        for digests, total in zip(members.to_pylist(), totals.to_pylist()):
            records = {}
            for _ in range(block_height(total, levels)):
                level = []
                for k in range(0, len(digests), FANOUT):
                    children = b"".join(digests[k : k + FANOUT])
                    digest = digest_of(children)
                    records[digest] = children
                    level.append(digest)
                digests = level
            out.append({"root": digests[0], "records": [{"digest": d, "children": c} for d, c in records.items()]})
        kind = pa.struct([("digest", pa.binary()), ("children", pa.binary())])
        return pa.array(out, pa.struct([("root", pa.binary()), ("records", pa.list_(kind))]))

    return F.arrow_udf(pack, "struct<root: binary, records: array<struct<digest: binary, children: binary>>>")


def walk(records: dict[bytes, bytes], digest: bytes, place: int, height: int) -> tuple[bytes, bytes]:
    """From a block's root to its node number ``place``: that node, and the way there.

    A segment of the way is a byte of the place among the children and the number of the
    others, then the others' digests from left to right.
    """
    way = b""
    for level in range(height - 1, -1, -1):
        children = records[digest]
        digit = place // FANOUT**level % FANOUT
        at = digit * SIZE
        others = children[:at] + children[at + SIZE :]
        way += bytes([digit << 4 | len(others) // SIZE]) + others
        digest = children[at : at + SIZE]
    return digest, way


def segments(way: bytes) -> list[tuple[int, bytes]]:
    """Place and siblings of each step of a way, in its order."""
    out, at = [], 0
    while at < len(way):
        end = at + 1 + (way[at] & 15) * SIZE
        out.append((way[at] >> 4, way[at + 1 : end]))
        at = end
    return out


def fold(digest: bytes, steps: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf digest leads to over its siblings, nearest first."""
    for digit, others in steps:
        digest = digest_of(others[: digit * SIZE] + digest + others[digit * SIZE :])
    return digest


def _records(packed) -> dict[bytes, bytes]:
    return {r["digest"]: r["children"] for r in packed.as_py()}


def descend_udf(levels: int):
    def descend(records: pa.Array, roots: pa.Array, totals: pa.Array, ways: pa.Array, places: pa.Array) -> pa.Array:
        """The wanted nodes of a block, with the way from the root of all to each."""
        out = []
        for packed, root, total, way, wanted in zip(records, roots, totals, ways, places):
            known, above, height = _records(packed), way.as_py(), block_height(total.as_py(), levels)
            found = [walk(known, root.as_py(), p % FANOUT**levels, height) for p in wanted.as_py()]
            out.append([{"digest": d, "way": above + w} for d, w in found])
        return pa.array(out, pa.list_(pa.struct([("digest", pa.binary()), ("way", pa.binary())])))

    return F.arrow_udf(descend, "array<struct<digest: binary, way: binary>>")


def prove_udf(levels: int, with_path: bool):
    def prove(records: pa.Array, roots: pa.Array, totals: pa.Array, ways: pa.Array, places: pa.Array, claims: pa.Array) -> pa.Array:
        """For each wanted leaf of a block: its digest, the digest of its siblings, and the root
        that the claimed digest leads to."""
        out = []
        for packed, root, total, way, wanted, claimed in zip(records, roots, totals, ways, places, claims):
            known, height = _records(packed), block_height(total.as_py(), levels)
            upper = segments(way.as_py())[::-1]
            upper_text = b"".join(others for _, others in upper).hex()
            made = []
            for place, claim in zip(wanted.as_py(), claimed.as_py()):
                leaf, below = walk(known, root.as_py(), place % FANOUT**levels, height)
                lower = segments(below)[::-1]
                siblings = b"".join(others for _, others in lower)
                made.append(
                    {
                        "leaf": leaf,
                        "proof": hashlib.sha256((siblings.hex() + upper_text).encode()).digest(),
                        "folded": fold(claim, lower + upper),
                        "path": [others for _, others in lower + upper] if with_path else None,
                    }
                )
            out.append(made)
        fields = [("leaf", pa.binary()), ("proof", pa.binary()), ("folded", pa.binary()), ("path", pa.list_(pa.binary()))]
        return pa.array(out, pa.list_(pa.struct(fields)))

    return F.arrow_udf(prove, "array<struct<leaf: binary, proof: binary, folded: binary, path: array<binary>>>")


def ranked(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``rank``, the place in its ``tree`` from 0, and ``total``, the tree's rows.

    Rows are dealt by ranges of (tree, order), so that a large tree covers many tasks, and
    equal rows are cut apart by where they were read. Offsets have a row per tree and range.
    """
    keys = ["tree", *order, "_read"]
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(ranges, *keys)
    placed = dealt.sortWithinPartitions(*keys).select(
        *rows.columns, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_place")
    )
    placed = store(placed, f"{purpose}-placed")
    tree = Window.partitionBy("tree")
    counts = placed.groupBy("tree", "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "_range",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("total"),
    )
    starts = store(starts, f"{purpose}-offsets")
    rank = (F.col("_place") + F.col("_shift")).alias("rank")
    return placed.join(starts, ["tree", "_range"]).select(*rows.columns, rank, "total")


def build(nodes: DataFrame, purpose: str, levels: int) -> list[DataFrame]:
    """The packs above ``tree, rank, total, digest`` rows, a table for each ``levels`` levels.

    A table has ``tree, block, total, root, records``; ``total`` counts the tree's nodes below
    that table. Trees of ``FANOUT**levels`` nodes at most end in it; ``root`` is then the tree's.
    """
    tiers, size = [], FANOUT**levels
    while True:
        blocks = nodes.groupBy("tree", F.expr(f"rank div {size}").alias("block")).agg(
            F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("members"),
        )
        made = blocks.select("tree", "block", "total", pack_udf(levels)(F.col("members.digest"), "total").alias("p"))
        packs = store(made.select("tree", "block", "total", "p.*"), f"{purpose}-packs")
        tiers.append(packs)
        more = packs.filter(F.col("total") > size)
        if more.isEmpty():
            return tiers
        above = F.expr(f"(total + {size - 1}) div {size}").alias("total")
        nodes = more.select("tree", F.col("block").alias("rank"), above, F.col("root").alias("digest"))


@dataclass
class Manifest:
    """Stored tables of a manifest: ranked leaves, packs of each source's tree, and those above."""

    leaves: DataFrame
    tiers: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    levels: int

    def records(self) -> DataFrame:
        """``digest, children`` of all inner nodes, each once; ``children`` are 32 bytes each."""
        every = None
        for packs in [*self.tiers, *self.top]:
            rows = packs.select(F.explode("records").alias("r")).select("r.*")
            every = rows if every is None else every.unionByName(rows)
        return every.distinct()


def build_manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", source_col: str = "source", claim: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``; ``claim`` is the digest to verify per row, by default its own.

    Leaves are ordered by id inside their source, ties by digest; NULL comes first, as id and
    as source, so equal rows are leaves of their own in places that do not matter. Texts of any
    length are digested where they are read and never moved. Columns other than ``fields`` are
    ignored, whatever their names. No rows give a manifest without nodes.
    """
    with small_batches(docs.sparkSession, rows=PACKS):
        leaf = leaf_digest(*(F.col(c) for c in fields))
        # Never NULL and ordered as the source is, NULL first.
        tree = F.when(F.col(source_col).isNull(), "").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))
        rows = docs.select(
            tree.alias("tree"),
            F.col(id_col).alias("leaf_id"),
            F.unhex(leaf).alias("digest"),
            F.unhex(leaf if claim is None else claim).alias("claim"),
        )
        leaves = store(ranked(rows, ["leaf_id", "digest", "claim"], "manifest"), "manifest-leaves")
        tiers = build(leaves.select("tree", "rank", "total", "digest"), "manifest", levels)
        ends = None
        for t, packs in enumerate(tiers):
            done = packs.filter(F.col("total") <= FANOUT**levels).select(F.col("tree").alias("source_tree"), F.lit(t).alias("tier"), "root")
            ends = done if ends is None else ends.unionByName(done)
        # All sources are one tree more; ranked by ranges like any other.
        ends = ends.withColumn("tree", F.lit("all"))
        subroots = store(ranked(ends, ["source_tree"], "manifest-sources"), "manifest-subroots")
        top = build(subroots.select("tree", "rank", "total", F.col("root").alias("digest")), "manifest-top", levels)
        return Manifest(leaves, tiers, subroots, top, levels)


def _in_packs(packs: DataFrame) -> DataFrame:
    """A pack per digest: equal blocks have equal records."""
    return packs.groupBy(F.col("root").alias("_root")).agg(F.first("records").alias("records"), F.first("total").alias("total"))


def _step(frontier: DataFrame, packs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Frontier blocks with the requests below them and their records, found by digest."""
    asked = frontier.join(wanted, ["tree", "block"])
    return asked.join(_in_packs(packs), F.col("digest") == F.col("_root")).drop("_root")


def _below(tiers: list[DataFrame], last: int, frontier_of, requests: DataFrame, purpose: str, levels: int) -> DataFrame:
    """Frontier rows ``tree, block, digest, way, ...`` of the lowest tier.

    ``frontier_of(t)`` gives the trees that begin in tier ``t``. Requests that share a prefix of
    rank digits share the descent: a tier's request is the block below which leaves are asked.
    """
    carried, size = None, FANOUT**levels
    for t in range(last, -1, -1):
        here = frontier_of(t)
        frontier = here if carried is None else here.unionByName(carried)
        if t == 0:
            return frontier
        below = requests.select("tree", F.expr(f"rank div {size**t}").alias("place")).distinct()
        wanted = below.groupBy("tree", F.expr(f"place div {size}").alias("block")).agg(F.collect_list("place").alias("places"))
        found = _step(frontier, tiers[t], wanted).withColumn("hit", descend_udf(levels)("records", "digest", "total", "way", "places"))
        rest = [c for c in frontier.columns if c not in ("tree", "block", "digest", "way")]
        carried = found.select("tree", *rest, F.explode(F.arrays_zip("places", "hit")).alias("h")).select(
            "tree", F.col("h.places").alias("block"), F.col("h.hit.digest").alias("digest"), F.col("h.hit.way").alias("way"), *rest
        )
        carried = store(carried, f"{purpose}-frontier")
    raise AssertionError("a tree has a lowest tier")


def proofs(manifest: Manifest, requests: DataFrame | None = None, with_path: bool = False) -> DataFrame:
    """``tree, rank, leaf_id, leaf, subroot, root, proof, folded, path`` of the requested leaves.

    ``requests`` has ``tree, rank, leaf_id, claim``, each leaf once (all leaves by default). Each
    descends from the root by the digits of its rank and collects the children it does not
    take; ``path`` has them reversed, leaf first, if ``with_path``. ``proof`` digests them, and
    ``folded`` is the root that ``claim`` leads to. A lone leaf has no siblings.
    """
    wanted_leaves = manifest.leaves if requests is None else requests
    levels, size = manifest.levels, FANOUT**manifest.levels
    with small_batches(wanted_leaves.sparkSession, rows=PACKS):
        sources = manifest.subroots
        of_tree = sources.select(F.col("source_tree").alias("tree"), F.col("rank").alias("place"), "tier")
        needed = wanted_leaves.select("tree").distinct().join(of_tree, "tree").select(F.lit("all").alias("tree"), F.col("place").alias("rank"))
        highest = len(manifest.top) - 1

        def from_root(t: int) -> DataFrame:
            packs = manifest.top[t].filter(F.lit(t == highest))
            return packs.select("tree", "block", F.col("root").alias("digest"), F.lit(b"").alias("way"), "root")

        frontier = _below(manifest.top, highest, from_root, needed, "manifest-top", levels)
        wanted = needed.groupBy("tree", F.expr(f"rank div {size}").alias("block")).agg(F.collect_list("rank").alias("places"))
        found = _step(frontier, manifest.top[0], wanted).withColumn("hit", descend_udf(levels)("records", "digest", "total", "way", "places"))
        entered = found.select("root", F.explode(F.arrays_zip("places", "hit")).alias("h")).select(
            "root", F.col("h.places").alias("place"), F.col("h.hit.digest").alias("subroot"), F.col("h.hit.way").alias("way")
        )
        entered = store(entered.join(of_tree, "place"), "manifest-entered")

        def from_source(t: int) -> DataFrame:
            return entered.filter(F.col("tier") == t).select(
                "tree", F.lit(0).cast("long").alias("block"), F.col("subroot").alias("digest"), "way", "root", "subroot"
            )

        lowest = _below(manifest.tiers, len(manifest.tiers) - 1, from_source, wanted_leaves, "manifest", levels)
        asked = wanted_leaves.groupBy("tree", F.expr(f"rank div {size}").alias("block")).agg(
            F.collect_list(F.struct("rank", "leaf_id", "claim")).alias("asked")
        )
        made = _step(lowest, manifest.tiers[0], asked).withColumn(
            "made", prove_udf(levels, with_path)("records", "digest", "total", "way", F.col("asked.rank"), F.col("asked.claim"))
        )
        each = made.select("tree", "root", "subroot", F.explode(F.arrays_zip("asked", "made")).alias("e"))
        return store(
            each.select("tree", "e.asked.rank", "e.asked.leaf_id", "e.made.leaf", "subroot", "root", "e.made.proof", "e.made.folded", "e.made.path"),
            "manifest-proofs",
        )
