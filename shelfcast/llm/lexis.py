"""Words of many texts at once, as slices of one byte buffer.

A word is a run of digits, ASCII letters and code points above U+007F.  In
UTF-8 each byte of a code point above U+007F is 0x80 or more, so words are
found byte by byte, in NumPy, for a whole Arrow slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
SPACE = 32


def _byte_map() -> np.ndarray:
    """Word bytes, A-Z in lower case; every other byte is a space."""
    table = np.full(256, SPACE, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    for first, last, to in (("0", "9", "0"), ("a", "z", "a"), ("A", "Z", "a")):
        n = ord(last) - ord(first) + 1
        table[ord(first): ord(first) + n] = np.arange(ord(to), ord(to) + n)
    return table


BYTE_MAP = _byte_map()


@dataclass
class Words:
    """``buf`` holds the words in a row, each followed by one space, then 8
    zero bytes; ``start`` and ``length`` are in bytes; the words of text i
    are ``first[i]`` to ``first[i + 1]``."""

    buf: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def array(self) -> pa.Array:
        """The words as an Arrow array of bytes."""
        offsets = np.zeros(len(self.length) + 1, np.int64)
        np.cumsum(self.length, out=offsets[1:])
        own = self.buf[: len(self.buf) - 8]
        own = own[own != SPACE]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.length), [None, pa.py_buffer(offsets), pa.py_buffer(own)])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``limit`` bytes of text (a
    longer text is a slice of its own); its column becomes a string without nulls."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(text)
        full = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
        batch = batch.set_column(at, text, full)
        ends = np.cumsum(pc.binary_length(full).to_numpy())
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def split_words(texts: pa.Array) -> Words:
    """The words of each text of a large_string array without nulls."""
    none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    texts = pc.binary_join_element_wise(texts, none, space)  # no word runs into the next text
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = BYTE_MAP[np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0])]
    inside = np.zeros(len(raw) + 1, bool)
    np.not_equal(raw, SPACE, out=inside[1:])  # shifted by one: a text's last byte is a space
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, stop = edges[::2], edges[1::2]
    length = stop - begin
    buf = np.concatenate([raw[inside[1:] | inside[:-1]], np.zeros(8, np.uint8)])
    ends = np.cumsum(length + 1)
    return Words(buf, ends - length - 1, length, np.searchsorted(begin, offsets - offsets[0]))
