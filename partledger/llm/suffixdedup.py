"""Exact removal of long byte strings that occur more than once, by suffix arrays per shard.

Every window of ``length`` bytes is dealt by an anchor in it, the short stretch of least hash,
so that equal windows meet in one shard; neighbouring windows of one anchor travel as one piece.
Pieces that occur whole in several places need no sorting. What is left of an anchor with
different pieces goes to a shard, whose suffix array and common prefixes (``suffixes``) say
which windows repeat. Anchors with too many pieces are dealt again by ever longer stretches.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.llm.bitfilter import filter_of, in_filter
from partledger.llm.collocations import Polynomial
from partledger.llm.common import small_batches, store
from partledger.llm.suffixes import Scratch, with_common_prefixes
from partledger.llm.words import mix

LENGTH = 400
#: Pieces that share an anchor before the anchor is dealt anew; some 600 KB at 400 bytes.
HOT = 1024
#: Bytes of pieces in a shard; a shard of any size is sorted, with files beyond ``MEMORY``.
SHARD_BYTES = 4 << 20
#: Bytes that each array and queue of a sort may take before it lies in scratch files.
MEMORY = 64 << 20
#: Names of a recursion that are sorted without files.
IN_MEMORY = 4_000_000
#: Windows of a text that are dealt at once; longer texts are cut with overlap.
WINDOWS = 1 << 20

PIECE = "anchor long, s1 long, s2 long, k1 long, k2 long, span long, size long"


def text_keys(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(12), text).alias("k2")]


def anchor_bytes(length: int) -> int:
    return max(1, length * 4 // 25)


def span_of(start, windows, delta):
    """One long: first window, number of windows, and bytes from the first window to the anchor."""
    return start << 20 | windows << 10 | delta


def parts_of(span: int) -> tuple[int, int, int]:
    return span >> 20, span >> 10 & 1023, span & 1023


def anchors(data: np.ndarray, length: int, polynomial: Polynomial) -> tuple[np.ndarray, ...]:
    """Anchor hash, first window, number of windows and delta of the pieces of a text.

    A window's anchor is the stretch of least hash in it, the first of equal ones, so equal
    windows have equal anchors at equal places.
    """
    size = anchor_bytes(length)
    reach = length - size + 1
    with np.errstate(over="ignore"):
        sums = polynomial.prefixes(data)
        at = np.arange(len(data) - size + 1)
        hashes = mix(polynomial.slices(sums, at, at + size))
    keys = hashes >> np.uint64(22) << np.uint64(22) | at.astype(np.uint64)
    windows = len(data) - length + 1
    # Least key of each window: of the end of one stretch of ``reach`` and the start of the next.
    padded = np.full(-(-len(keys) // reach) * reach, 2**64 - 1, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()[reach - 1 : reach - 1 + windows]
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
    least = np.minimum(behind, ahead)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    place = (least[first] & np.uint64((1 << 22) - 1)).astype(np.int64)
    return hashes[place], first, np.diff(np.append(first, windows)), place - first


def pieces_of(text: bytes, length: int, polynomial: Polynomial) -> Iterator[tuple[int, int, int]]:
    """Anchor, 128-bit digest and span of each piece of a text."""
    for begin in range(0, max(len(text) - length + 1, 0), WINDOWS):
        data = text[begin : begin + WINDOWS + length - 1]
        for anchor, first, windows, delta in zip(*(c.tolist() for c in anchors(np.frombuffer(data, np.uint8), length, polynomial))):
            digest = xxhash.xxh3_128_intdigest(data[first : first + windows + length - 1])
            yield anchor, digest, span_of(begin + first, windows, delta)


def check_length(length: int) -> None:
    if not 1 <= length <= 1200:
        raise ValueError("a repeat has 1 to 1,200 bytes")


def signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def cut(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All pieces of all texts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial = Polynomial(12)
        for batch in batches:
            for text, k1, k2 in zip(batch.column("text"), batch.column("k1").to_pylist(), batch.column("k2").to_pylist()):
                data = text.as_buffer().to_pybytes()
                found = list(pieces_of(data, length, polynomial))
                if found:
                    columns = {
                        "anchor": signed([a for a, _, _ in found]),
                        "s1": signed([d >> 64 for _, d, _ in found]),
                        "s2": signed([d & (2**64 - 1) for _, d, _ in found]),
                        "k1": pa.array([k1] * len(found), pa.int64()),
                        "k2": pa.array([k2] * len(found), pa.int64()),
                        "span": pa.array([s for _, _, s in found], pa.int64()),
                        "size": pa.array([len(data)] * len(found), pa.int64()),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return emit


FETCHED = "anchor long, s1 long, s2 long, piece binary, copies long, k1 long, k2 long, start long, windows int, delta int, size long, pieces long"


def fetch(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of the asked pieces of each text, if they are the ones whose digest is known."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, asked, k1, k2 in zip(*(batch.column(c) for c in ("text", "asked", "k1", "k2"))):
                data = text.as_buffer().to_pybytes()
                rows = []
                for want in asked.as_py():
                    start, windows, delta = parts_of(want["span"])
                    piece = data[start : start + windows + length - 1]
                    digest = xxhash.xxh3_128_intdigest(piece)
                    if (digest >> 64, digest & (2**64 - 1)) == (want["s1"] % 2**64, want["s2"] % 2**64):
                        own = (want["anchor"], want["s1"], want["s2"], piece, want["copies"])
                        rows.append((*own, k1.as_py(), k2.as_py(), start, windows, delta, len(data), want["pieces"]))
                if rows:
                    yield batch_of(rows, FETCHED)

    return emit


KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split(" ") for field in schema.split(", ")))
    arrays = [pa.array(column, KINDS[kind]) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def deal_again(length: int, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces cut at fixed distances from their anchors, under the bytes that all windows of such
    a part have in common. At the last level a part is one window, and equal to all of its key."""
    width = max(1, -(-(length - anchor_bytes(length) + 1) >> level))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                piece, delta, windows = r["piece"], r["delta"], r["windows"]
                for part in range((delta - windows + 1) // width, delta // width + 1):
                    near, far = part * width, part * width + width - 1
                    # Any window of the part holds these bytes, so the piece does.
                    key = b"%d %d " % (level, part) + piece[delta - near : delta - far + length]
                    first, last = max(delta - far, 0), min(delta - near, windows - 1)
                    own = piece[first : last + length]
                    digest = xxhash.xxh3_128_intdigest(own)
                    marks = np.array([xxhash.xxh3_64_intdigest(key), digest >> 64, digest & (2**64 - 1)], np.uint64)
                    place = (r["start"] + first, last - first + 1, delta - first)
                    rows.append((*marks.view(np.int64).tolist(), own, r["copies"], r["k1"], r["k2"], *place, r["size"], 0))
            if rows:
                yield batch_of(rows, FETCHED)

    return emit


SPAN = "k1 long, k2 long, start long, stop long, size long"


class Shard:
    """The pieces of a shard as one text, each after a separator, in a file beyond ``memory`` bytes."""

    def __init__(self, folder: str, memory: int):
        self.path, self.memory = f"{folder}/shard", memory
        self.parts, self.held, self.total, self.top = [], 0, 0, 0
        self.starts: list[int] = []

    def add(self, pieces: list[bytes]) -> None:
        for piece in pieces:
            self.starts.append(self.total + 1)
            raw = np.frombuffer(piece, np.uint8).astype(np.uint16) + 2
            self.top = max(self.top, int(raw.max()))
            self.put(np.append(np.uint16(1), raw))

    def put(self, symbols: np.ndarray) -> None:
        self.parts.append(symbols)
        self.total += len(symbols)
        self.held += symbols.nbytes
        if self.held > self.memory:
            self.flush()

    def flush(self) -> None:
        with open(self.path, "ab") as file:
            for part in self.parts:
                file.write(part.tobytes())
        self.parts, self.held = [], 0

    def text(self, scratch: Scratch) -> np.ndarray:
        """Bytes from 2, separators 1, and a single 0 at the end."""
        kind = np.uint8 if self.top < 256 else np.uint16
        out, at = scratch.array(self.total + 1, kind), 0
        if self.total * 2 > self.held:
            self.flush()
            with open(self.path, "rb") as file:
                while len(part := np.frombuffer(file.read(1 << 22), np.uint16)):
                    out[at : at + len(part)] = part
                    at += len(part)
        for part in self.parts:
            out[at : at + len(part)] = part
            at += len(part)
        self.parts = []
        return out


def sort_shard(length: int, memory: int, in_memory: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spans of the windows of a task's pieces that occur again in one of them.

    Scratch files are the task's own, as those of Spark's sorts are, and go with it.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            shard, owners = Shard(folder, memory), []
            for batch in batches:
                shard.add(batch.column("piece").to_pylist())
                owners.append(batch.select(["copies", "k1", "k2", "start", "windows", "size"]))
            if not shard.total:
                return
            scratch = Scratch(folder, memory)
            text = shard.text(scratch)
            again, last = scratch.array(len(text), bool), None
            for positions, common in with_common_prefixes(text, length, in_memory, scratch):
                hits = np.flatnonzero(common >= length)
                again[positions[hits]] = True
                again[positions[hits[hits > 0] - 1]] = True
                if len(hits) and hits[0] == 0 and last is not None:
                    again[last] = True
                last = positions[-1]
            starts = iter(shard.starts)
            for owner in owners:
                rows = []
                for copies, k1, k2, start, windows, size in zip(*(c.to_pylist() for c in owner.columns)):
                    at = next(starts)
                    flags = np.asarray(again[at : at + windows])
                    if copies == 1 and flags.any():
                        edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
                        for lo, hi in edges.reshape(-1, 2).tolist():
                            rows.append((k1, k2, start + lo, start + hi - 1 + length, size))
                if rows:
                    yield batch_of(rows, SPAN)

    return emit


def merged(starts: list[int], stops: list[int]) -> list[dict]:
    """Maximal runs that cover the same bytes; runs that touch become one."""
    out: list[dict] = []
    for start, stop in sorted(zip(starts, stops)):
        if out and start <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], stop)
        else:
            out.append({"start": start, "stop": stop})
    return out


SPANS = "array<struct<start: long, stop: long>>"


def merge_udf():
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def merge(starts: pa.Array, stops: pa.Array) -> pa.Array:
        return pa.array([merged(a, b) for a, b in zip(starts.to_pylist(), stops.to_pylist())], kind)

    return F.arrow_udf(merge, SPANS)


def passes_udf(kept):
    def passes(keys: pa.Array) -> pa.Array:
        return pa.array(in_filter(kept.value, keys.to_numpy().view(np.uint64)))

    return F.arrow_udf(passes, "boolean")


def distinct_texts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``k1, k2, text`` of the texts that pass a filter of ``keys``, each once; copies are dropped
    before the shuffle."""
    kept = texts.sparkSession.sparkContext.broadcast(filter_of(keys.select("k1")))
    return texts.filter(passes_udf(kept)("k1")).groupBy("k1", "k2").agg(F.first("text").alias("text"))


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(text.cast("binary").alias("text"), *text_keys(text))


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    text_col: str = "text",
    hot: int = HOT,
    shard_bytes: int = SHARD_BYTES,
    memory: int = MEMORY,
    in_memory: int = IN_MEMORY,
) -> DataFrame:
    """``k1, k2, size, spans`` of the texts with bytes to remove; a text has its two keys.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in any
    text or the same one; all are judged on the input. ``spans`` are the maximal runs of such
    bytes. Equal texts, repeated rows too, have one result, and all of their bytes go if they
    are long enough. NULL and short texts have no span. No rows give none. Only the text is
    read, so other columns may have any name.
    """
    check_length(length)
    spark = docs.sparkSession
    texts = _keyed(docs, text_col).filter(F.length("text") >= length)
    with small_batches(spark):
        pieces = store(texts.mapInArrow(cut(length), PIECE), "suffix-cut")
        places = [F.first(c).alias(c) for c in ("k1", "k2", "span")]
        counted = pieces.groupBy("anchor", "s1", "s2").agg(F.count(F.lit(1)).alias("copies"), *places)
        counted = store(counted, "suffix-counted")
        repeated = counted.filter("copies > 1").select("s1", "s2")
        some = spark.sparkContext.broadcast(filter_of(repeated.select("s1")))
        marks = pieces.filter(passes_udf(some)("s1")).join(repeated, ["s1", "s2"], "left_semi")
        start = F.shiftright("span", 20)
        stop = start + F.shiftright("span", 10).bitwiseAND(1023) + length - 1
        marks = marks.select("k1", "k2", start.alias("start"), stop.alias("stop"), "size").distinct()
        spans = [store(marks, "suffix-marks")]

        crowds = counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("pieces")).filter("pieces > 1")
        asked = counted.join(crowds, "anchor").groupBy("k1", "k2").agg(
            F.collect_list(F.struct("anchor", "s1", "s2", "span", "copies", "pieces")).alias("asked")
        )
        asked = store(asked, "suffix-asked")
        found = distinct_texts(texts, asked).join(asked, ["k1", "k2"]).mapInArrow(fetch(length), FETCHED)
        found = store(found, "suffix-pieces")
        ready, level = [found.filter(F.col("pieces") <= hot)], 0
        crowded = found.filter(F.col("pieces") > hot)
        while not crowded.isEmpty():
            # Whatever shares an anchor with too many others is dealt by more bytes; at the last
            # level by a whole window, whose pieces are all equal and count as one.
            level += 1
            dealt = store(crowded.mapInArrow(deal_again(length, level), FETCHED).drop("pieces"), "suffix-dealt")
            rest = [F.first(c).alias(c) for c in ("piece", "k1", "k2", "start", "windows", "delta", "size")]
            once = dealt.groupBy("anchor", "s1", "s2").agg(F.sum("copies").alias("copies"), *rest)
            once = store(once, "suffix-once")
            again = dealt.filter("copies = 1").join(once.filter("copies > 1").select("anchor", "s1", "s2"), ["anchor", "s1", "s2"], "left_semi")
            covered = again.select("k1", "k2", "start", (F.col("start") + F.col("windows") + length - 1).alias("stop"), "size")
            spans.append(store(covered, "suffix-marks"))
            crowds = once.groupBy("anchor").agg(F.count(F.lit(1)).alias("pieces")).filter("pieces > 1")
            found = store(once.join(crowds, "anchor").select(found.columns), "suffix-pieces")
            ready.append(found.filter(F.col("pieces") <= hot))
            crowded = found.filter(F.col("pieces") > hot)

        shards = ready[0]
        for more in ready[1:]:
            shards = shards.unionByName(more)
        size = shards.agg(F.sum(F.length("piece"))).first()[0] or 0
        dealt = shards.repartition(max(1, -(-size // shard_bytes)), "anchor")
        spans.append(store(dealt.mapInArrow(sort_shard(length, memory, in_memory), SPAN), "suffix-spans"))
        every = spans[0]
        for more in spans[1:]:
            every = every.unionByName(more)
        grouped = every.groupBy("k1", "k2").agg(
            F.first("size").alias("size"), F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")
        )
        return store(grouped.select("k1", "k2", "size", merge_udf()("starts", "stops").alias("spans")), "suffix-merged")


def cut_udf():
    def cut_out(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, removed in zip(texts, spans):
            data, at, parts = text.as_buffer().to_pybytes(), 0, []
            for span in removed.as_py() or []:
                parts.append(data[at : span["start"]])
                at = span["stop"]
            out.append(b"".join([*parts, data[at:]]))
        return pa.array(out, pa.binary())

    return F.arrow_udf(cut_out, "binary")


def kept_texts(docs: DataFrame, spans: DataFrame, text_col: str = "text") -> DataFrame:
    """``k1, k2, spans, kept`` of each text with bytes to remove, once; ``kept`` is what is left.

    Bytes are cut, so what is left of a character may be no UTF-8. Only texts of which something
    stays are read again.
    """
    whole = F.col("spans")[0]["stop"] - F.col("spans")[0]["start"] == F.col("size")
    partly = spans.filter(~whole)
    with small_batches(docs.sparkSession):
        texts = distinct_texts(_keyed(docs, text_col), partly)
        cut_ = texts.join(partly, ["k1", "k2"]).select("k1", "k2", "spans", cut_udf()("text", "spans").alias("kept"))
        empty = spans.filter(whole).select("k1", "k2", "spans", F.lit(b"").alias("kept"))
        return store(cut_.unionByName(empty), "suffix-kept")


def remove_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``spans``, the removed runs, and ``kept``, the remaining bytes, in place of any
    columns of these names. A text without repeats is kept whole, NULL as no bytes; odd input
    is treated as in ``repeated_spans``."""
    found = kept_texts(docs, repeated_spans(docs, length, text_col, **options), text_col)
    found = found.select(F.struct("k1", "k2").alias("text_key"), F.struct("spans", "kept").alias("cut"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), F.struct(*text_keys(text)).alias("text_key"))
    joined = rows.join(found, "text_key", "left")
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("spans", "kept")]
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    whole = F.coalesce(F.col("row")[text_col], F.lit("")).cast("binary")
    return joined.select(*kept, F.coalesce("cut.spans", none).alias("spans"), F.coalesce("cut.kept", whole).alias("kept"))
