"""N-gram Jaccard join by a grouped prefix join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partledger.llm.common import small_batches, store
from partledger.llm.words import pieces, shingle_sets

#: Words in a shingle, and the similarity of linked documents in percent.
WIDTH = 4
PERCENT = 85
#: Posting lists up to this length are paired as they are; longer ones are ordered anew.
SHORT_LIST = 64
#: The most frequent shingles that come last in the order, at most.
FREQUENT = 100_000
#: Ids that are broadcast to find their texts, at most (three numbers each).
BROADCAST_ROWS = 500_000
#: Words of a set's parity map, 64 bits each.
PARITY_WORDS = 16
#: Members of one list or group that one task compares with the others.
LIST_PIECE = 512
#: Members that are compared with one pivot in one group.
CHUNK = 64
#: Classes, and shingles of all of them, in one group of candidates that is compared in one go.
GROUP_CLASSES = 512
GROUP_SHINGLES = 2_000_000


def prefix_length(n: Column, percent: int) -> Column:
    """How many leading shingles of a set meet those of every set that is similar enough."""
    return n - F.ceil(n * percent / 100) + 1


def index_length(n: Column, percent: int) -> Column:
    """The same for the smaller set of a pair."""
    return n - F.ceil(n * (2 * percent) / (100 + percent)) + 1


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, *more: Column) -> DataFrame:
    """``doc_id, n, cls, region`` and ``more``: set size, hash of the set, its smallest shingle hashes.

    The region holds the prefix and some more, for shingles that will be put last.
    """
    kind = pa.struct([("n", pa.int64()), ("cls", pa.int64()), ("region", pa.list_(pa.int64()))])

    @F.arrow_udf("n long, cls long, region array<long>")
    def signed(texts: pa.Array) -> pa.Array:
        n_all, cls_all, parts, sizes = [], [], [], []
        for piece in pieces(texts):
            values, counts = shingle_sets(piece, width)
            end = 0
            for n in counts:
                own = values[end : end + n]
                end += n
                keep = min(n, (n - -(-n * percent // 100) + 1) * 5 // 4 + 8) if n else 0
                cls_all.append(_set_hash(own))
                parts.append(own[:keep].copy())
                sizes.append(keep)
            n_all.append(counts)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        region = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.view(np.int64))
        )
        n = np.concatenate(n_all) if n_all else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(cls_all, pa.int64()), region], fields=list(kind))

    made = docs.select(F.col(id_col).alias("doc_id"), signed(text_col).alias("s"), F.struct(F.lit(0), *more).alias("m"))
    return made.select("doc_id", "s.*", *[F.col("m")[c].alias(c) for c in made.schema["m"].dataType.names[1:]])


def _set_hash(values: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def sets_of(
    docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int,
    prefix_of: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """``cls, shingles`` (8 bytes each) of the classes in ``wanted`` (``doc_id, cls`` and columns to keep).

    With ``prefix_of``, ``cls, prefix``: what it takes from a set in the worker that made the set,
    for a second function would need a worker of its own. A repeated row of ``docs`` gives a
    class twice.
    """
    name, sql_kind, kind = ("prefix", "array<long>", pa.list_(pa.int64())) if prefix_of else ("shingles", "binary", pa.binary())

    @F.arrow_udf(f"cls long, {name} {sql_kind}")
    def full(texts: pa.Array) -> pa.Array:
        cls_all, made = [], []
        for piece in pieces(texts):
            values, counts = shingle_sets(piece, width)
            end = 0
            for n in counts:
                own = values[end : end + n]
                end += n
                cls_all.append(_set_hash(own))
                made.append(prefix_of(own.view(np.int64)) if prefix_of else own.tobytes())
        return pa.StructArray.from_arrays([pa.array(cls_all, pa.int64()), pa.array(made, kind)], ["cls", name])

    extra = [c for c in wanted.columns if c not in ("doc_id", "cls")]
    picked = store(
        wanted.select(F.col("doc_id").alias("_id"), F.col("cls").alias("_cls"), *extra), "jaccard-wanted"
    )
    # Ids of a known number: few enough are sent to the texts, else texts and ids are shuffled.
    if picked.count() <= BROADCAST_ROWS:
        picked = F.broadcast(picked)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Not deterministic for the planner: else the comparison below would become a join key,
    # and every text would be cut into shingles before the join.
    full = full.asNondeterministic()
    rows = texts.join(picked, F.col("doc_id").eqNullSafe(F.col("_id"))).select("_cls", *extra, full("text").alias("s"))
    # An id given to several texts brings them all; the set's hash tells which one is meant.
    return rows.filter(F.col("_cls") == F.col("s.cls")).select("s.*", *extra)


def list_pairs(postings: DataFrame, crowds: DataFrame, percent: int) -> DataFrame:
    """Distinct ``a, b`` (a the smaller set) that share enough prefix shingles to be similar.

    ``postings`` has ``shingle, cls, n``, whole prefixes but for shingles on longer lists;
    ``crowds`` has ``cls, crowd``, how many of those a prefix has. Shingles that two sets have
    in common come in one order, so behind the last one in both prefixes, all others lie
    outside one and the same prefix: no more than that set has there. Where prefixes share too
    few to make up for the rest, the sets can't be similar. A repeated posting only keeps more.
    """
    small = postings.select("shingle", F.col("cls").alias("a"), F.col("n").alias("an"))
    large = postings.select("shingle", F.col("cls").alias("b"), F.col("n").alias("bn"))
    before = (F.col("an") < F.col("bn")) | ((F.col("an") == F.col("bn")) & (F.col("a") < F.col("b")))
    needed = F.ceil((F.col("an") + F.col("bn")) * percent / (100 + percent))
    beyond = F.greatest(*(F.col(n) - prefix_length(F.col(n), percent) for n in ("an", "bn")))
    shared = (
        small.join(large, "shingle")
        .filter(before & (100 * F.col("an") >= percent * F.col("bn")))
        .select("a", "b", (needed - beyond).alias("least"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("k"), F.max("least").alias("least"))
    )
    both = shared.join(crowds.select(F.col("cls").alias("a"), F.col("crowd").alias("ca")), "a", "left").join(
        crowds.select(F.col("cls").alias("b"), F.col("crowd").alias("cb")), "b", "left"
    )
    crowd = F.least(F.coalesce("ca", F.lit(0)), F.coalesce("cb", F.lit(0)))
    return both.filter(F.col("k") + crowd >= F.col("least")).select("a", "b")


def prefix_groups(prefixes: DataFrame) -> DataFrame:
    """``gid, cls, n`` of all classes that have their size and whole prefix in common with another.

    ``prefixes`` has ``cls, n, prefix``; a group goes by its smallest class. Prefixes compare by
    two 64-bit hashes, so that they need not move. Repeated rows make no group.
    """
    keyed = prefixes.select("cls", "n", *(F.xxhash64(F.lit(k), "prefix").alias(f"h{k}") for k in (1, 2)))
    key = ["n", "h1", "h2"]
    groups = keyed.groupBy(*key).agg(F.min("cls").alias("gid"), F.max("cls").alias("top")).filter("gid <> top")
    return store(keyed.join(groups.drop("top"), key).select("gid", "cls", "n").distinct(), "jaccard-members")


def with_parity(sets: DataFrame) -> DataFrame:
    """``cls, n, parity``: of each of the map's bits, whether an odd number of shingles falls on it."""

    @F.arrow_udf("array<long>")
    def parity(blobs: pa.Array) -> pa.Array:
        bits = 64 * PARITY_WORDS
        out = []
        for blob in blobs:
            place = (np.frombuffer(blob.as_buffer(), np.uint64) % np.uint64(bits)).astype(np.int64)
            odd = (np.bincount(place, minlength=bits) & 1).astype(np.uint8)
            out.append(np.packbits(odd, bitorder="little").view(np.int64))
        return pa.array(out, pa.list_(pa.int64()))

    made = sets.select("cls", (F.octet_length("shingles") / 8).cast("long").alias("n"), parity("shingles").alias("words"))
    words = F.struct(*(F.get("words", F.lit(k)).alias(f"w{k}") for k in range(PARITY_WORDS)))
    return made.select("cls", "n", words.alias("parity"))


def parity_fits(percent: int) -> Column:
    """Whether the maps of ``a`` and ``b`` differ in no more bits than similar sets have shingles of one's own.

    Each bit that differs takes a shingle that only one of the two sets has, so no similar pair
    fails.
    """
    differ = sum((F.bit_count(F.col(f"ap.w{k}").bitwiseXOR(F.col(f"bp.w{k}"))) for k in range(1, PARITY_WORDS)),
                 F.bit_count(F.col("ap.w0").bitwiseXOR(F.col("bp.w0"))))
    total = F.col("an") + F.col("bn")
    return differ <= total - 2 * F.ceil(total * percent / (100 + percent))


def remaining_pairs(postings: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b`` on common lists that may be similar and are not connected.

    ``postings`` has ``shingle, cls, n, place, c`` (``c``: no list is longer), ``classes`` has
    ``cls, component, parity``. The conditions are part of the join, and long lists are cut into
    pieces, so that the pairs of a list are neither written nor all made in one task.
    """
    named = postings.join(classes, "cls").withColumn("cuts", F.ceil(F.col("c") / LIST_PIECE).cast("int"))
    small = named.filter(F.col("place") < index_length(F.col("n"), percent)).select(
        "shingle", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"), F.col("cls").alias("a"),
        F.col("n").alias("an"), F.col("component").alias("ac"), F.col("parity").alias("ap"),
    )
    large = named.select(
        "shingle", F.pmod(F.xxhash64("cls"), F.col("cuts")).cast("int").alias("cut"), F.col("cls").alias("b"),
        F.col("n").alias("bn"), F.col("component").alias("bc"), F.col("parity").alias("bp"),
    )
    before = (F.col("an") < F.col("bn")) | ((F.col("an") == F.col("bn")) & (F.col("a") < F.col("b")))
    fits = before & (F.col("ac") != F.col("bc")) & (100 * F.col("an") >= percent * F.col("bn")) & parity_fits(percent)
    return small.join(large, ["shingle", "cut"]).filter(fits).select("a", "b").distinct()


def expand_groups(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b`` of classes that may be similar and are not connected: one of either
    group of a pair, and both of one group.

    ``pairs`` has ``a, b``, the heads of groups; ``classes`` has ``cls, gid, n, component,
    parity``, with no ``gid`` for a class that is alone. Pairs whose classes are all in one
    component need no expanding. Large groups are cut into pieces like long lists.
    """
    owned = classes.withColumn("gid", F.coalesce("gid", "cls"))
    groups = store(
        owned.groupBy("gid").agg(
            F.min("component").alias("lo"),
            F.max("component").alias("hi"),
            F.ceil(F.count(F.lit(1)) / LIST_PIECE).cast("int").alias("cuts"),
        ),
        "jaccard-groups",
    )
    one, two = (groups.select(F.col("gid").alias(f"g{x}"), *(F.col(c).alias(f"{x}_{c}") for c in ("lo", "hi", "cuts"))) for x in "ab")
    loose = groups.filter("lo <> hi").select(F.col("gid").alias("ga"), F.col("gid").alias("gb"))
    open_pairs = store(
        pairs.select(F.col("a").alias("ga"), F.col("b").alias("gb"))
        .unionByName(loose)
        .join(one, "ga")
        .join(two, "gb")
        .filter(F.least("a_lo", "b_lo") != F.greatest("a_hi", "b_hi"))
        .select("ga", "gb", F.explode(F.sequence(F.lit(0), F.col("b_cuts") - 1)).alias("cut")),
        "jaccard-open",
    )
    small, large = (
        owned.select(
            F.col("gid").alias(f"g{x}"), F.col("cls").alias(x), F.col("n").alias(f"{x}n"),
            F.col("component").alias(f"{x}c"), F.col("parity").alias(f"{x}p"),
        )
        for x in "ab"
    )
    cut = F.pmod(F.xxhash64("b"), F.col("cuts")).cast("int").alias("cut")
    large = large.join(groups.select(F.col("gid").alias("gb"), "cuts"), "gb").select("*", cut).drop("cuts")
    once = (F.col("ga") != F.col("gb")) | (F.col("a") < F.col("b"))
    fits = once & (F.col("ac") != F.col("bc")) & parity_fits(percent)
    return open_pairs.join(small, "ga").join(large, ["gb", "cut"]).filter(fits).select("a", "b").distinct()


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough.

    Pairs are grouped by ``b``, at most ``CHUNK`` to a group: each set travels to its
    partners' group, and the common partner only once per group.
    """
    order = F.pmod(F.xxhash64("a"), F.lit(1 << 30))
    per_b = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("m"))
    dealt = (
        pairs.join(per_b, "b")
        .withColumn("chunk", F.pmod(order, F.ceil(F.col("m") / CHUNK)).cast("int"))
        .select("a", "b", "chunk")
    )
    dealt = store(dealt, "jaccard-dealt")
    shared = F.col("shingles")
    members = dealt.join(sets.select(F.col("cls").alias("a"), shared), "a")
    pivots = (
        dealt.select("b", "chunk").distinct().join(sets.select(F.col("cls").alias("b"), shared), "b").select(F.lit(None).cast("long").alias("a"), "b", "chunk", "shingles")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group, the pivot first; groups may run over batches."""
        pivot = None
        for batch in batches:
            out = []
            for a, b, blob in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["shingles"]):
                values = np.frombuffer(blob.as_buffer(), np.uint64)
                if a is None:
                    pivot = values
                    continue
                both = np.searchsorted(pivot, values)
                both = int((pivot[np.minimum(both, len(pivot) - 1)] == values).sum())
                if 100 * both >= percent * (len(values) + len(pivot) - both):
                    out.append((a, b))
            yield _pair_batch(out)

    rows = pivots.unionByName(members.select("a", "b", "chunk", "shingles"))
    sorted_rows = rows.repartition("b", "chunk").sortWithinPartitions(F.col("b"), F.col("chunk"), F.col("a").asc_nulls_first())
    return sorted_rows.select("a", "b", "shingles").mapInArrow(compared, "a long, b long")


def verify_groups(
    docs: DataFrame, pairs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links among ``pairs`` that fall into groups of bounded size, and the pairs of larger groups.

    A pair goes to the group of the smallest class next to either side, so families of copies
    mostly share one group, and chains of candidates do not join families. A set goes once to
    each group that has a pair of it, with the classes it is to be compared with.
    """
    sides = pairs.select(F.col("a").alias("cls"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("cls"), F.col("a").alias("other"))
    )
    least = store(sides.groupBy("cls").agg(F.least("cls", F.min("other")).alias("near")), "jaccard-nearest")
    grouped = store(
        pairs.join(least.select(F.col("cls").alias("a"), F.col("near").alias("na")), "a")
        .join(least.select(F.col("cls").alias("b"), F.col("near").alias("nb")), "b")
        .select("a", "b", F.least("na", "nb").alias("component")),
        "jaccard-grouped",
    )
    members = (
        grouped.select("component", F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes, "cls")
    )
    fits = store(
        members.groupBy("component")
        .agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
        .filter((F.col("members") <= GROUP_CLASSES) & (F.col("shingles") <= GROUP_SHINGLES))
        .select("component"),
        "jaccard-fits",
    )
    partners = (
        grouped.join(fits, "component", "left_semi")
        .groupBy("component", F.col("b").alias("cls"))
        .agg(F.collect_list("a").alias("partners"))
    )
    wanted = members.join(fits, "component", "left_semi").select("component", "cls", "doc_id")
    sets = sets_of(docs, wanted, id_col, text_col, width)

    def links_of(group: dict[int, np.ndarray], tasks: list[tuple[int, list[int]]]) -> Iterator[tuple[int, int]]:
        for b, others in tasks:
            for a in others:
                both = len(np.intersect1d(group[a], group[b], assume_unique=True))
                if 100 * both >= percent * (len(group[a]) + len(group[b]) - both):
                    yield a, b

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group, tasks = None, {}, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for component, cls, others, blob in zip(
                batch["component"].to_pylist(), batch["cls"].to_pylist(), batch["partners"].to_pylist(), batch["shingles"]
            ):
                if component != current:
                    out.extend(links_of(group, tasks))
                    current, group, tasks = component, {}, []
                if others is not None:
                    tasks.append((cls, others))
                else:
                    group[cls] = np.frombuffer(blob.as_buffer(), np.uint64)
            yield _pair_batch(out)
        yield _pair_batch(list(links_of(group, tasks)))

    rows = sets.select("component", "cls", "shingles").unionByName(partners, allowMissingColumns=True)
    rows = rows.repartition("component").sortWithinPartitions("component")
    links = store(rows.mapInArrow(compared, "a long, b long"), "jaccard-links")
    return links, grouped.join(fits, "component", "left_anti").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``cls, component`` of every class in a link ``a, b``: the smallest class reachable.

    Labels spread to neighbours and jump to their own label's label, until nothing changes;
    each round is stored.
    """
    edges = store(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "jaccard-edges",
    )
    labels = store(edges.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "jaccard-labels")
    while True:
        near = (
            edges.join(labels.select(F.col("cls").alias("b"), F.col("component").alias("seen")), "b")
            .groupBy("a")
            .agg(F.min("seen").alias("least"))
        )
        spread = labels.join(near, F.col("cls") == F.col("a")).select(
            "cls", F.col("component").alias("old"), F.least("component", "least").alias("new")
        )
        jump = labels.select(F.col("cls").alias("new"), F.col("component").alias("beyond"))
        moved = store(
            spread.join(jump, "new", "left").select("cls", "old", F.least("new", F.coalesce("beyond", "new")).alias("component")),
            "jaccard-labels",
        )
        labels = moved.select("cls", "component")
        if moved.filter("old <> component").isEmpty():
            return labels


def _unconnected(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose classes are not yet in one component."""
    one = labels.select(F.col("cls").alias("a"), F.col("component").alias("ca"))
    two = labels.select(F.col("cls").alias("b"), F.col("component").alias("cb"))
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    same = F.coalesce(F.col("ca"), F.col("a")) == F.coalesce(F.col("cb"), F.col("b"))
    return joined.filter(~same).select(*pairs.columns)


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, short_list: int = SHORT_LIST
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    1. Texts with equal shingle sets form one class; only classes are compared.
    2. A class has a prefix: its first shingles in one order that holds for all, the most
       frequent last. Sets that are similar enough share a prefix shingle. Classes of one size
       and one prefix form a group, which lists that prefix once, under its head.
    3. Short lists give pairs of groups at once; their heads are compared, and each head with
       its members. Groups on longer lists are a small share, of texts with many near copies;
       the sets of their heads are ordered anew, rarest first.
    4. On these lists, all heads are compared with the one that has most shingles in common
       with many others. What that connects needs no more comparing.
    5. Pairs of groups that may still hold a link between components are expanded to their
       members. Maps of parities, whose bits differ no more often than the sets do, tell most
       of these pairs apart inside the join; all others are verified. No pair is left out.

    Sets compare by 64-bit hashes of shingles, and classes by one of their set.

    NULL texts and texts without words have 0 shingles and a component of their own id, as has
    a row with no link. Rows with equal sets, repeated ones too, share a component. A NULL id
    takes part, but is never the smallest: it gets its component's id, or NULL alone. Other
    columns are ignored. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        return _similar_documents(docs, id_col, text_col, width, percent, short_list)


def _linked(
    docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, short_list: int, *more: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, classes, and the components of linked classes; all jobs that run
    Python run in here."""
    signed = store(signatures(docs, id_col, text_col, width, percent, *more), "jaccard-signatures")
    full = signed.filter("n > 0")
    classes = store(
        full.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "jaccard-classes"
    )
    # All rows of a class but that of its smallest id: few, while the regions are many.
    least = classes.select(F.col("cls").alias("_cls"), F.col("doc_id").alias("_least"))
    others = store(
        full.select("cls", "doc_id")
        .join(least, F.col("cls") == F.col("_cls"))
        .filter(~F.col("doc_id").eqNullSafe(F.col("_least")))
        .select(F.col("cls").alias("_cls"), F.col("doc_id").alias("_id")),
        "jaccard-copies",
    )
    regions = full.join(others, (F.col("cls") == F.col("_cls")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    links = class_links(docs, classes, regions, id_col, text_col, width, percent, short_list)
    return signed, classes, components(links)


def _similar_documents(
    docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, short_list: int
) -> DataFrame:
    """The result joins stored tables."""
    signed, classes, labels = _linked(docs, id_col, text_col, width, percent, short_list)
    named = classes.select("cls", F.col("doc_id").alias("least")).join(labels, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # Only classes with company need a look-up; all others have their own id.
    found = labels.join(smallest, "component").select(F.col("cls").alias("_cls"), F.col("component_id").alias("_linked"))
    copies = signed.groupBy("cls").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("_least"))
    grouped = copies.filter("rows > 1").join(found, F.col("cls") == F.col("_cls"), "full").select(
        F.coalesce("cls", "_cls").alias("_key"), F.coalesce("_linked", "_least").alias("_component")
    )
    joined = signed.select("doc_id", "n", "cls").join(grouped, F.col("cls") == F.col("_key"), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("_component", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def shared_shingles(sets: DataFrame) -> DataFrame:
    """``shingle, c``: the shingles of more than one set, and of how many. Those of a batch are summed where it lies."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(b.as_buffer(), np.int64) for b in batch["shingles"]]
            if own:
                shingle, c = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(c.astype(np.int64))], ["shingle", "c"])

    found = sets.select("shingles").mapInArrow(summed, "shingle long, c long")
    return store(found.groupBy("shingle").agg(F.sum("c").alias("c")).filter("c > 1"), "jaccard-common")


def rarest_candidates(sets: DataFrame, common: DataFrame, percent: int) -> DataFrame:
    """``cls, n, others, listed, weight, at, shingle``: what of each set can be in its prefix, if the order is by ``c, shingle``.

    The ``FREQUENT`` last shingles in that order are known to every task, so of these a set gives
    no more than its prefix has room for, and ``weight`` sums up all it has. The ``others`` come
    before them; unless all are of one set alone, they are listed, as the first ``listed`` rows.
    """
    tail = common.orderBy(F.col("c").desc(), F.col("shingle").desc()).limit(FREQUENT).collect()
    complete = len(tail) < FREQUENT
    ordered = np.array([r["shingle"] for r in reversed(tail)], np.int64)
    counts = np.array([r["c"] for r in reversed(tail)], np.int64)
    rank = np.argsort(ordered)
    last = ordered[rank]

    @F.arrow_udf("others long, listed long, weight long, shingles array<long>")
    def candidates(blobs: pa.Array, lengths: pa.Array) -> pa.Array:
        others, listed, weight, made = [], [], [], []
        for blob, p in zip(blobs, lengths.to_numpy()):
            own = np.frombuffer(blob.as_buffer(), np.int64)
            at = np.searchsorted(last, own)
            at[at == len(last)] = 0
            is_last = last[at] == own if len(last) else np.zeros(len(own), bool)
            first, late = own[~is_last], np.sort(rank[at[is_last]])
            others.append(len(first))
            listed.append(0 if complete else len(first))
            weight.append(int(counts[late].sum()))
            made.append(np.concatenate([first[: listed[-1]], ordered[late[: max(0, p - len(first))]]]))
        longs = [pa.array(c, pa.int64()) for c in (others, listed, weight)]
        return pa.StructArray.from_arrays([*longs, pa.array(made, pa.list_(pa.int64()))], ["others", "listed", "weight", "shingles"])

    p = prefix_length(F.col("n"), percent).cast("long")
    found = sets.select("cls", "n", candidates.asNondeterministic()("shingles", p).alias("t"))
    return found.select("cls", "n", "t.others", "t.listed", "t.weight", F.posexplode("t.shingles").alias("at", "shingle"))


def rarest_first(sets: DataFrame, percent: int) -> DataFrame:
    """``shingle, cls, n, place, c, centre`` of the prefixes of ``sets`` (``cls, n, shingles``), the rarest shingles first.

    Shingles of one set alone come before all others and are left out; ``c`` is of how many sets
    a shingle is, ``centre`` a set's sum of it over its size.
    """
    common = shared_shingles(sets)
    mine = Window.partitionBy("cls")
    is_other = F.col("at") < F.col("listed")
    return (
        rarest_candidates(sets, common, percent)
        .join(common, "shingle")
        .withColumn("rank", F.row_number().over(mine.orderBy("c", "shingle")))
        .withColumn("alone", F.col("others") - F.count(F.when(is_other, 1)).over(mine))
        .withColumn("weight", F.col("weight") + F.sum(F.when(is_other, F.col("c")).otherwise(0)).over(mine))
        .withColumn("place", F.col("alone") + F.col("rank") - 1)
        .filter(F.col("place") < prefix_length(F.col("n"), percent))
        .select("shingle", "cls", "n", "place", "c", (F.col("weight") / F.col("n")).alias("centre"))
    )


def class_links(docs: DataFrame, classes: DataFrame, regions: DataFrame, id_col: str, text_col: str, width: int, percent: int, short_list: int) -> DataFrame:
    """Links ``a, b`` between classes that connect the same classes as all links do."""
    # 32 bits are enough to say which shingles come last: any such choice keeps the join exact.
    counted = regions.select(F.explode("region").alias("s")).groupBy(F.shiftright("s", 32).cast("int").alias("s")).agg(F.count(F.lit(1)).alias("c"))
    frequent = [r["s"] for r in counted.filter(F.col("c") >= short_list).orderBy(F.col("c").desc(), "s").limit(FREQUENT).collect()]
    last = np.sort(np.array(frequent, np.int32))

    def are_last(values: np.ndarray) -> np.ndarray:
        top = (values >> 32).astype(np.int32)
        if not len(last):
            return np.zeros(len(top), bool)
        return last[np.minimum(np.searchsorted(last, top), len(last) - 1)] == top

    @F.arrow_udf("array<long>")
    def leading(regions: pa.Array, lengths: pa.Array, sizes: pa.Array) -> pa.Array:
        """The prefix, or NULL where the region has too few shingles that do not come last."""
        out = []
        values = regions.flatten().to_numpy()
        late, bounds = are_last(values), np.concatenate([[0], np.cumsum(regions.value_lengths().to_numpy())])
        for k, (p, n) in enumerate(zip(lengths.to_numpy(), sizes.to_numpy())):
            v, is_late = values[bounds[k] : bounds[k + 1]], late[bounds[k] : bounds[k + 1]]
            first = v[~is_late][:p]
            if len(first) < p:
                first = np.concatenate([first, v[is_late]])[:p] if len(v) == n else None
            out.append(first)
        return pa.array(out, pa.list_(pa.int64()))

    def leading_of_all(own: np.ndarray) -> np.ndarray:
        late = are_last(own)
        return np.concatenate([own[~late], own[late]])[: len(own) - -(-len(own) * percent // 100) + 1]

    p = prefix_length(F.col("n"), percent).cast("long")
    led = store(regions.select("cls", "doc_id", "n", leading("region", p, "n").alias("prefix")), "jaccard-prefixes")
    rest = led.filter("prefix is null").select("cls", "doc_id", "n")
    if rest.isEmpty():
        prefixes = led.select("cls", "n", "prefix")
    else:
        whole = sets_of(docs, rest, id_col, text_col, width, leading_of_all)
        prefixes = led.filter("prefix is not null").select("cls", "n", "prefix").unionByName(
            store(whole.select("cls", "n", "prefix"), "jaccard-prefixes")
        )
    members = prefix_groups(prefixes)
    heads = prefixes.join(members.filter("cls <> gid").select("cls"), "cls", "left_anti")
    every = heads.select("cls", "n", F.posexplode("prefix").alias("place", "shingle"))
    lengths = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    # Most shingles are one class's only; what is left is small.
    postings = store(every.join(lengths, "shingle"), "jaccard-postings")
    crowds = postings.filter(F.col("members") > short_list).groupBy("cls").agg(F.count(F.lit(1)).alias("crowd"))
    pairs = store(list_pairs(postings.filter(F.col("members") <= short_list), crowds, percent), "jaccard-pairs")
    # Their order is another one, in which members of a group differ: all of them are listed.
    on_crowded = postings.filter(F.col("members") > short_list).select("cls").distinct()
    crowded = store(
        on_crowded.unionByName(members.join(on_crowded, F.col("gid") == on_crowded["cls"], "left_semi").select("cls"))
        .distinct()
        .join(classes.select("cls", "doc_id", "n"), "cls"),
        "jaccard-crowded",
    )
    # A group is held together by its head at first: every member is compared with it.
    spokes = members.filter("cls <> gid").select(F.col("gid").alias("a"), F.col("cls").alias("b"))
    links, more = verify_groups(docs, pairs.unionByName(spokes), classes, id_col, text_col, width, percent)
    more = store(more, "jaccard-more")
    # Pairs of groups of which one has several classes; only their heads are compared so far.
    several = members.select("gid").distinct()
    heads_only = store(
        pairs.join(several.select(F.col("gid").alias("a"), F.lit(1).alias("in_a")), "a", "left")
        .join(several.select(F.col("gid").alias("b"), F.lit(1).alias("in_b")), "b", "left")
        .filter("in_a = 1 or in_b = 1")
        .select("a", "b"),
        "jaccard-heads",
    )
    wanted = (
        more.select(F.explode(F.array("a", "b")).alias("cls"))
        .unionByName(heads_only.select(F.explode(F.array("a", "b")).alias("cls")))
        .unionByName(members.select("cls"))
        .unionByName(crowded.select("cls"))
        .distinct()
        .join(classes.select("cls", "doc_id"), "cls")
    )
    wanted = store(wanted, "jaccard-wanted")
    if wanted.isEmpty():
        return links
    sets = store(sets_of(docs, wanted, id_col, text_col, width), "jaccard-sets")
    if sets.count() > wanted.count():  # repeated rows
        sets = store(sets.dropDuplicates(["cls"]), "jaccard-sets")
    links = links.unionByName(store(verify(more, sets, percent), "jaccard-links"))
    if crowded.isEmpty() and members.isEmpty():
        return links
    maps = store(with_parity(sets), "jaccard-maps")
    # Their shingles meet once more, to be counted; then each class takes its rarest ones.
    fresh = store(rarest_first(sets.join(crowded.select("cls", "n"), "cls"), percent), "jaccard-fresh")
    labels = components(links)
    done = None
    for _ in range(3):
        named = fresh.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        open_ = (
            named.groupBy("shingle")
            .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo <> hi")
            .select("shingle")
        )
        named = named.join(open_, "shingle", "left_semi")
        counts = named.groupBy("shingle", "component").agg(
            F.count(F.lit(1)).alias("k"), F.max(F.struct("centre", "cls", "n")).alias("best")
        )
        # First the member in the middle; in later rounds the one in the middle of the rest.
        if done is None:
            picked = counts.groupBy("shingle").agg(F.max("best").alias("pivot"))
        else:
            top = counts.groupBy("shingle").agg(F.max(F.struct("k", "component")).alias("top"))
            picked = (
                counts.join(top, "shingle").filter(F.col("component") != F.col("top.component")).groupBy("shingle").agg(F.max("best").alias("pivot"))
            )
        stars = named.join(picked, "shingle").filter(
            (F.col("cls") != F.col("pivot.cls"))
            & (100 * F.least("n", F.col("pivot.n")) >= percent * F.greatest("n", F.col("pivot.n")))
        ).select(F.col("cls").alias("a"), F.col("pivot.cls").alias("b")).distinct()
        stars = _unconnected(stars, labels)
        if done is not None:
            stars = stars.join(done, ["a", "b"], "left_anti")
        stars = store(stars, "jaccard-stars")
        found = store(verify(stars, sets, percent), "jaccard-links")
        done = stars if done is None else done.unionByName(stars)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        labels = components(links)
    named = store(
        maps.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls")), "jaccard-named"
    )
    left = remaining_pairs(fresh, named.select("cls", "component", "parity"), percent)
    expanded = expand_groups(heads_only, named.join(members.select("gid", "cls"), "cls", "left"), percent)
    return links.unionByName(store(verify(left.unionByName(expanded).distinct(), sets, percent), "jaccard-links"))


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, short_list: int = SHORT_LIST
) -> DataFrame:
    """``docs`` with one row of each component: the one of smallest id, then of smallest text hash.

    A row is told by its id and text, so an id given to several texts loses none of them
    unless another text stands for it. NULL ids come last and take part like others. Rows
    that repeat an id and text stay once. Rows without words link with nothing and all
    stay. Columns may have any names.
    """
    # Names of the row's own columns live inside a struct, so that none can clash.
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    with small_batches(docs.sparkSession):
        signed, _, labels = _linked(docs, id_col, text_col, width, percent, short_list, F.xxhash64(text_col).alias("text_hash"))
        grouped = signed.filter("n > 0").select("cls", "doc_id", "text_hash").join(labels, "cls", "left")
        grouped = grouped.select(F.coalesce("component", "cls").alias("component"), "doc_id", "text_hash")
        rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash"))
        best = grouped.groupBy("component").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
        crowd = grouped.join(store(best, "jaccard-best"), "component")
        fate = crowd.groupBy("doc_id", "text_hash").agg(
            F.max(rank.eqNullSafe(F.col("best"))).alias("stays"), F.count(F.lit(1)).alias("times")
        )
        fate = store(fate, "jaccard-fate")
    mine = rows["id"].eqNullSafe(fate["doc_id"]) & (rows["text_hash"] == fate["text_hash"])
    once = rows.join(fate.filter("not stays or times > 1"), mine, "left_anti").select("row")
    again = rows.join(fate.filter("stays and times > 1"), mine, "left_semi").dropDuplicates(["id", "text_hash"]).select("row")
    return once.unionByName(again).select("row.*")
