"""Words and word hashes of Arrow string batches, a column at a time.

Used inside Arrow UDFs: each call sees the texts of one batch. Work runs in pieces of
``PIECE_BYTES`` of text, so that memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 1 << 20
WHITESPACE = (9, 10, 11, 12, 13, 32)


def byte_table(separators: set[int]) -> bytes:
    """Translation of UTF-8 bytes: separators become spaces, A-Z become a-z."""
    table = bytearray(range(256))
    for b in range(65, 91):
        table[b] = b + 32
    for b in separators:
        table[b] = 32
    return bytes(table)


#: Words are runs of non-whitespace, A-Z lowered.
BY_SPACE = byte_table(set(WHITESPACE))
#: Words are runs of ASCII digits, letters and all characters beyond ASCII, A-Z lowered.
BY_LETTER = byte_table(
    {b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)}
)


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive slices of about ``PIECE_BYTES``, at least one row each; NULL becomes empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
    start = 0
    while start < len(texts):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + PIECE_BYTES, side="right")))
        yield texts.slice(start, end - start)
        start = end


def split_words(texts: pa.Array, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the number of words of each text."""
    texts = pa.concat_arrays([texts])  # a slice's buffers start at its first row
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = data.to_pybytes()[offsets[0] : offsets[-1]] if data is not None else b""
    clean = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(raw.translate(table))
    )
    lists = pc.ascii_split_whitespace(clean)
    flat = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    full = pc.greater(pc.binary_length(flat), 0)
    seen = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), np.diff(seen[bounds])


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; only distinct words are hashed."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(w.as_py()) for w in coded.dictionary), np.uint64, len(coded.dictionary)
    )
    return hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else hashes


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixing of 64-bit values, one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and their counts.

    Fewer words than ``width`` count as one shingle; no words, as none.
    """
    words, counts = split_words(texts, BY_SPACE)
    h = word_hashes(words)
    starts = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(counts)), counts)
    total = np.zeros(len(h), np.uint64)
    place = np.arange(len(h)) - starts[doc]
    short = counts < width
    with np.errstate(over="ignore"):
        for k in range(width):
            # A short text's words all enter its first position, each with its own factor.
            nxt = np.zeros(len(h), np.uint64)
            nxt[: len(h) - k] = h[k:] if k else h
            inside = place + k < counts[doc]
            total += np.where(inside, mix(nxt + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)), np.uint64(0))
            if k:
                total = mix(total)
        total = mix(total + counts[doc].clip(max=width).astype(np.uint64))
    wanted = np.where(short[doc], place == 0, place <= counts[doc] - width)
    total, doc = total[wanted], doc[wanted]
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    first = np.ones(len(total), bool)
    first[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[first], np.bincount(doc[first], minlength=len(counts)).astype(np.int64)
