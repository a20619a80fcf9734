"""Byte-level BPE encoding by reuse of content-defined chunks, and decoding.

A text is cut where a rolling hash of its last ``WINDOW`` bytes has ``BITS``
zero bits (moved on to the next code point), so copies and shared passages
are cut alike wherever they stand.  A distinct chunk is encoded once for all
documents of a task (up to ``REMEMBERED`` bytes of chunks, then the memory
starts anew); its ids serve every document that holds it.

Joins.  A chunk's ids near its ends may differ from those of the text, so
each join is encoded again, in a window between two *seams*: places that end
a piece of the vocabulary's pattern whatever stands around them (a letter or
digit or sign of ASCII before ASCII white space, or a change among letters,
digits and signs, but for an apostrophe before a letter).  The window runs on
by one seam more; from the seam after the join to the window's end its ids
must equal the right chunk's own ids, and the window must begin at an end of
a token of the left chunk.  Where they don't agree, the window grows on both
sides, by one seam, then two, then four, and is encoded anew, at most to the
ends of the text.  Windows
that meet become one.

The library cuts a text at the strings of its special tokens before anything
else, so the parts between them are encoded on their own.  Decoding looks up
the bytes of each id; bytes that aren't UTF-8 become U+FFFD as the library
has it.

Memory: slices of ``SLICE_BYTES`` of text (``SLICE_IDS`` ids when decoding),
or the longest text, times a small factor.  No shuffle: a lost task is run again on its input partition.

Defined results: a null text is empty, an empty text has no ids and decodes
to the empty text; a null or repeated ``doc_id`` is kept as it is, each row on
its own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .lexis import slices
from .wordcache import WordCache, encoder

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 16
BITS = 8
REMEMBERED = 32_000_000
SLICE_BYTES = 1_000_000
SLICE_IDS = 300_000
_SPACE, _LETTER, _DIGIT, _SIGN = 1, 2, 3, 4


def _classes() -> np.ndarray:
    """Kinds of ASCII bytes; 0: no statement (control characters, bytes of other letters)."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = _SIGN
    for c in range(0x21, 0x7F):
        if chr(c).isalpha():
            kind[c] = _LETTER
        elif chr(c).isdigit():
            kind[c] = _DIGIT
    kind[[ord(c) for c in " \t\n\x0b\f\r"]] = _SPACE
    return kind


KIND = _classes()
APOSTROPHE = ord("'")


def _gear() -> np.ndarray:
    """A fixed random number for each byte."""
    return np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)


GEAR = _gear()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each place the sum of its last ``WINDOW`` bytes' numbers, each doubled
    for every byte after it (by doubling the span)."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        more = h.copy()
        more[span:] += h[:-span] << np.uint32(span)
        h, span = more, 2 * span
    return h


def cut_places(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Chunk starts within the parts (not the parts' own starts), in order."""
    low = np.uint32(((1 << BITS) - 1) << WINDOW)  # bits that all bytes of the window reach
    at = np.flatnonzero((rolling_hash(data) & low) == 0) + 1
    starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    at = _merged(starts[np.searchsorted(starts, at)])
    part = np.searchsorted(first, at, "right") - 1
    inside = (at < len(data)) & (at - first[np.minimum(part, len(first) - 1)] >= WINDOW)
    return at[inside]


def seams(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places between two bytes where a piece ends in any context."""
    kind = KIND[data]
    a, b = kind[:-1], kind[1:]
    held = (a > _SPACE) & (b > 0) & (a != b) & ~((data[:-1] == APOSTROPHE) & (b == _LETTER))
    held[first[(first > 0) & (first < len(data))] - 1] = False  # not across parts
    return np.flatnonzero(held) + 1


def _merged(*parts: np.ndarray) -> np.ndarray:
    """The distinct numbers of some arrays, in order."""
    out = np.sort(np.concatenate(parts), kind="stable")
    return out[np.diff(out, prepend=-1) > 0]


class ChunkEncoder:
    """Encoder of one vocabulary file within a task."""

    def __init__(self, path: str) -> None:
        self.words: WordCache = encoder(path, lower=False)
        self.spelling = token_bytes(path)
        self.sizes = np.array([len(s) for s in self.spelling], np.int64)
        added = json.loads(self.words.tokenizer.to_str())["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("special tokens that take more than their own string aren't supported")
        self.special = {t["content"]: t["id"] for t in added}
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        self.known: dict[bytes, np.ndarray] = {}
        self.held = 0

    def _ids(self, strings: list[bytes]) -> list[np.ndarray]:
        """Ids of each string; what is known isn't encoded again."""
        if self.held > REMEMBERED:
            self.known, self.held = {}, 0
        new = [s for s in dict.fromkeys(strings) if s not in self.known]
        if new:
            self.known.update(zip(new, self.words.encode([s.decode() for s in new]), strict=True))
            self.held += sum(map(len, new))
        return [self.known[s] for s in strings]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        parts, owner, marks = [], [], []  # marks: id of the special token after the part, or -1
        for i, text in enumerate(texts):
            at = 0
            for m in self.split.finditer(text) if self.special else ():
                parts.append(text[at: m.start()].encode())
                owner.append(i)
                marks.append(self.special[m[0]])
                at = m.end()
            parts.append(text[at:].encode() if at else text.encode())
            owner.append(i)
            marks.append(-1)
        ids, count = self._parts(parts)
        marks = np.array(marks)
        special = np.flatnonzero(marks >= 0)
        ids = np.insert(ids, np.cumsum(count)[special], marks[special])
        count[special] += 1
        return ids, np.bincount(owner, count, len(texts)).astype(np.int64)

    def _parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts without special tokens."""
        whole = b"".join(parts)
        data = np.frombuffer(whole, np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        first, last = bounds[:-1], bounds[1:]
        filled = first[first < last]
        cuts = cut_places(data, filled) if len(data) else np.zeros(0, np.int64)
        starts = _merged(filled, cuts)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        chunks = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        distinct = list(dict.fromkeys(chunks))
        number = {c: i for i, c in enumerate(distinct)}
        code = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        own = self._ids(distinct)
        flat = np.concatenate(own) if own else np.zeros(0, np.uint16)
        # Distinct chunks in a row: the byte at which each of their tokens begins.
        token_at = np.concatenate([[0], np.cumsum(self.sizes[flat])])
        base = np.concatenate([[0], np.cumsum([len(c) for c in distinct])])
        places = _merged(seams(data, filled) if len(data) else cuts, bounds)
        begin, join, stop, window = self._windows(whole, cuts, places, first, last, starts, code, base, token_at, flat)
        # Pieces in the order of the text: chunk, window, chunk, ...; a chunk's
        # piece is what lies between the windows around it.
        edges = _merged(filled, stop)
        edges = edges[~np.isin(edges, begin)]
        edges = edges[edges < len(data)]
        till = np.minimum(np.append(begin, len(data))[np.searchsorted(begin, edges)],
                          np.append(last, len(data))[np.searchsorted(last, edges, "right")])
        of = np.searchsorted(starts, edges, "right") - 1
        shift = base[code[of]] - starts[of]
        lo, hi = np.searchsorted(token_at, edges + shift), np.searchsorted(token_at, till + shift)
        sizes = np.array([len(w) for w in window], np.int64)
        everything = np.concatenate([flat, *window]) if window else flat
        at = np.concatenate([edges, begin])
        src = np.concatenate([lo, len(flat) + np.cumsum(sizes) - sizes])
        n = np.concatenate([hi - lo, sizes])
        order = np.argsort(at, kind="stable")
        at, src, n = at[order], src[order], n[order]
        run = np.cumsum(n)
        ids = everything[np.repeat(src - (run - n), n) + np.arange(int(run[-1]) if len(run) else 0)]
        return ids, np.bincount(np.searchsorted(last, at, "right"), n, len(parts)).astype(np.int64)

    def _windows(self, whole: bytes, join: np.ndarray, places: np.ndarray, first: np.ndarray, last: np.ndarray,
                 starts: np.ndarray, code: np.ndarray, base: np.ndarray, token_at: np.ndarray, flat: np.ndarray,
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Windows (begin, last join, end, ids) that agree with the chunks around them."""
        part = np.searchsorted(last, join, "right")
        left = np.searchsorted(places, join) - 1  # the place before the join
        right = np.searchsorted(places, join, "right")  # and the one after it
        left, right = np.maximum(left, np.searchsorted(places, first[part])), np.minimum(right, np.searchsorted(places, last[part]))
        most = np.searchsorted(places, last[part])
        least = np.searchsorted(places, first[part])
        step = 1
        while True:
            begin, stop = places[left], places[np.minimum(right + 1, most)]
            # Windows that meet within a part become one.
            reach = np.maximum.accumulate(stop) if len(stop) else stop
            new = np.ones(len(begin), bool)
            new[1:] = (begin[1:] >= reach[:-1]) | (part[1:] != part[:-1])
            group = np.cumsum(new) - 1
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(new))[: len(heads)] - 1
            w_begin = np.minimum.reduceat(begin, heads) if len(heads) else begin
            w_stop = np.maximum.reduceat(stop, heads) if len(heads) else stop
            seam, joined = places[right[tails]], join[tails]
            strings = [whole[a:b] for a, b in zip(w_begin.tolist(), w_stop.tolist(), strict=True)]
            ids = self._ids(strings)
            at_start, at_end = w_begin == first[part[heads]], w_stop == last[part[heads]]
            wrong = ~(at_start | self._fits_left(w_begin, join[heads], starts, code, base, token_at))
            wrong |= ~(at_end | self._fits_right(ids, joined, seam, w_stop, starts, len(whole), code, base, token_at, flat))
            if not wrong.any():
                return w_begin, joined, w_stop, ids
            grow = wrong[group]
            left = np.where(grow, np.maximum(left - step, least), left)
            right = np.where(grow, np.minimum(right + step, most), right)
            step *= 2

    @staticmethod
    def _fits_left(begin: np.ndarray, join: np.ndarray, starts: np.ndarray, code: np.ndarray, base: np.ndarray,
                   token_at: np.ndarray) -> np.ndarray:
        """Whether a token of the chunk before the join begins where the window does."""
        of = np.searchsorted(starts, join) - 1
        place = begin - starts[of] + base[code[of]]
        return token_at[np.searchsorted(token_at, place)] == place

    @staticmethod
    def _fits_right(ids: list[np.ndarray], join: np.ndarray, seam: np.ndarray, stop: np.ndarray, starts: np.ndarray, end: int,
                    code: np.ndarray, base: np.ndarray, token_at: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Whether the chunk after the join has the window's ids from the seam to the window's end."""
        of = np.searchsorted(starts, join, "right") - 1
        inside = stop <= np.append(starts[1:], end)[of]
        shift = base[code[of]] - starts[of]
        lo = np.searchsorted(token_at, np.where(inside, seam + shift, 0))
        hi = np.searchsorted(token_at, np.where(inside, stop + shift, 0))
        same = inside & (token_at[lo] == seam + shift) & (token_at[hi] == stop + shift) & (hi > lo)
        for i in np.flatnonzero(same):
            same[i] = np.array_equal(ids[i][lo[i] - hi[i]:], flat[lo[i]: hi[i]])
        return same


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # The byte-level alphabet: printable bytes stand for themselves, the others
    # follow from U+0100 on, in order.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}
    out = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return out


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each text, as the library encodes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ChunkEncoder(path)
        for part in slices(batches, limit=SLICE_BYTES):
            ids, count = own.encode(part.column("text").to_pylist())
            cuts = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def _by_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``SLICE_IDS`` ids (at least a row)."""
    for batch in batches:
        ends = np.cumsum(batch.column("ids").value_lengths().fill_null(0).to_numpy().astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + SLICE_IDS, "right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` and the ``text`` of its ``ids``, special tokens as their strings."""
    schema = encoded.schema.simpleString()[len("struct<"):-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = token_bytes(path)
        size = np.array([len(s) for s in spelling], np.int64)
        letters = np.frombuffer(b"".join(spelling), np.uint8)
        at = np.cumsum(size) - size
        for part in _by_ids(batches):
            ids = part.column("ids").flatten().to_numpy()
            count = part.column("ids").value_lengths().fill_null(0).to_numpy().astype(np.int64)
            n = size[ids]
            stop = np.cumsum(n)
            data = letters[np.repeat(at[ids] - (stop - n), n) + np.arange(int(n.sum()))].tobytes()
            ends = np.concatenate([[0], stop])[np.cumsum(count)].tolist()
            texts = [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield part.append_column("text", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, f"{schema}, text string")


def op11_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    both = decode(encode(read_table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
