"""Encoding many texts with a public tokenizer, each distinct piece once.

The two vocabularies in use split a text into pieces before their merges
run, and no merge crosses a piece: letters end a piece where punctuation
starts, and a piece takes at most the one space in front of it.  So the ids
of a text are the ids of its pieces in a row, and a piece needs to be
encoded once.  Texts are split at line ends and spaces in Arrow, the
distinct words of a slice are found there too, trailing punctuation is cut
from words of letters, and what was not met before goes to the
``tokenizers`` library.  Pieces are remembered within a task, up to
``REMEMBERED``; then the memory starts anew.

Tests hold the result against encoding whole texts.  Strings of special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

REMEMBERED = 500_000
SLICE_CHARS = 6_000_000
LINE = 200

PUNCTUATION = '.,;:!?*&$%#|)]"'  # what may end a word; no apostrophe
# Letters whose lower case is the same everywhere and that nothing composes with.
PLAIN_LETTERS = "^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"
# White space beside white space: a split there would cut a piece in two (Arrow's pattern: its own \\s is ASCII).
WIDE_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
SAFE_SPACE = regex.compile(r"(?<![\s\x1c-\x1f\x85]) (?![\s\x1c-\x1f\x85])")


def _strings(a: pa.Array) -> list[str]:
    """Python strings of an array without nulls, by way of NumPy: several times as fast as one by one."""
    return a.to_numpy(zero_copy_only=False).tolist()


def _put(a: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``a`` with ``more`` behind its first ``used`` values; it grows by doubling."""
    end = used + len(more)
    if end > len(a):
        a = np.concatenate([a[:used], np.zeros(2 * end - used, a.dtype)])
    a[used:end] = more
    return a


_LOADED: dict[tuple[str, bool], WordCache] = {}


def encoder(path: str, lower: bool) -> WordCache:
    """This worker process's encoder of a file, kept from task to task."""
    key = (path, lower)
    if key not in _LOADED:
        _LOADED[key] = WordCache(path, lower)
    return _LOADED[key]


class WordCache:
    """Encoder of one vocabulary file; ``lower``: the file lower-cases and
    drops white space (else it is byte-level and keeps all)."""

    def __init__(self, path: str, lower: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lower = lower
        vocabulary = self.tokenizer.get_vocab()
        # Ids that end a word of letters (lower-casing file) or start one after a space (byte-level).
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.endswith("</w>") if lower else t.startswith("Ġ"))]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint16)
        self.used = 0  # of flat
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self._codes(["", "\n"])

    def _batch(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per piece) from the tokenizer."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint16, int(count.sum())), count

    def _line(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, encoded as one line of words and cut at their edges."""
        text = " ".join(pieces) if self.lower else "".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(pieces):
            return self._batch(pieces)
        return ids, np.diff(edges, prepend=-1) if self.lower else np.diff(edges, append=len(ids))

    def _codes(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; new ones are encoded."""
        codes = list(map(self.known.get, pieces))  # None: new
        at = [i for i, c in enumerate(codes) if c is None]
        if at:
            words: list[str] = []
            rest: list[str] = []
            new = dict.fromkeys([pieces[i] for i in at])
            for p in new:
                letters = p.isalpha() if self.lower else p[:1] == " " and p[1:].isalpha()
                (words if letters else rest).append(p)
            done = [self._line(words[i: i + LINE]) for i in range(0, len(words), LINE)]
            done += [self._batch(rest)] if rest else []
            base = len(self.known)
            self.known.update(zip(words + rest, range(base, base + len(new)), strict=True))
            count = np.concatenate([d[1] for d in done])
            self.start = _put(self.start, base, self.used + np.cumsum(count) - count)
            self.count = _put(self.count, base, count)
            self.flat = _put(self.flat, self.used, np.concatenate([d[0] for d in done]))
            self.used += int(count.sum())
            for i in at:
                codes[i] = self.known[pieces[i]]
        return np.array(codes, np.int64)

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces in a row, running count of ids after each piece)."""
        count = self.count[codes]
        total = np.cumsum(count)
        n = int(total[-1]) if len(total) else 0
        return self.flat[np.repeat(self.start[codes] - (total - count), count) + np.arange(n)], total

    def _pairs(self, words: pa.Array, space: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each word's letters and of its trailing punctuation (or of the whole word)."""
        cores = pc.utf8_rtrim(words, characters=PUNCTUATION)
        if self.lower:
            plain = pc.match_substring_regex(cores, PLAIN_LETTERS)
            cores = pc.utf8_lower(cores)
        else:
            plain = pc.utf8_is_alpha(cores)
        heads = pc.if_else(plain, cores, words)
        sizes = pc.utf8_length(heads).to_numpy()
        cut = np.flatnonzero(sizes != pc.utf8_length(words).to_numpy())
        tails = np.full(len(words), self.known[""])
        tails[cut] = self._codes([w[n:] for w, n in zip(_strings(words.take(pa.array(cut))), sizes[cut].tolist(), strict=True)])
        coded = heads.dictionary_encode()
        distinct = pc.binary_join_element_wise(space, coded.dictionary, "") if space else coded.dictionary
        codes = self._codes(_strings(distinct))
        return codes[coded.indices.to_numpy()], tails

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text (null: none)."""
        texts = [t or "" for t in texts]
        out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(texts)
        part: list[int] = []
        chars = 0
        for i, t in enumerate(texts):
            part.append(i)
            chars += len(t)
            if chars > SLICE_CHARS:
                self._slice(texts, part, out)
                part, chars = [], 0
        if part:
            self._slice(texts, part, out)
        return out

    def _wide(self, text: str) -> np.ndarray:
        """A byte-level text with wide white space: cut at safe single spaces only."""
        if len(self.known) > REMEMBERED:
            self._forget()
        parts = SAFE_SPACE.split(text)
        return self._gather(self._codes([parts[0], *(" " + p for p in parts[1:])]))[0]

    def _slice(self, texts: list[str], part: list[int], out: list[np.ndarray]) -> None:
        if len(self.known) > REMEMBERED:
            self._forget()
        own = pa.array([texts[i] for i in part], pa.string())
        if not self.lower:
            wide = pc.match_substring_regex(own, WIDE_SPACE)
            if pc.any(wide).as_py():
                for i, w in zip(part, wide.to_pylist(), strict=True):
                    if w:
                        out[i] = self._wide(texts[i])
                part = [i for i, w in zip(part, wide.to_pylist(), strict=True) if not w]
                own = own.filter(pc.invert(wide))
                if not part:
                    return
        if self.lower:  # white space is dropped: a line end is a space
            lines, lines_of = pc.replace_substring(own, "\n", " "), np.ones(len(own), np.int64)
        else:
            by_line = pc.split_pattern(own, "\n")
            lines, lines_of = by_line.flatten(), pc.list_value_length(by_line).to_numpy(zero_copy_only=False).astype(np.int64)
        by_word = pc.split_pattern(lines, " ")
        words_of = pc.list_value_length(by_word).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = by_word.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary
        line_ends = np.cumsum(words_of)
        head, tail = self._pairs(distinct, "" if self.lower else " ")
        pieces = np.stack([head[codes], tail[codes]], axis=1)
        last = np.cumsum(lines_of) - 1  # the last line of each text
        if not self.lower:  # a line's first word has no space in front
            firsts = line_ends - words_of
            pieces[firsts, 0], pieces[firsts, 1] = self._pairs(distinct.take(pa.array(codes[firsts])), "")
            inner = np.ones(len(words_of), bool)
            inner[last] = False
            at = 2 * line_ends[inner]
            flat = np.insert(pieces.ravel(), at, self.known["\n"])
            ends = 2 * line_ends + np.cumsum(inner)
        else:
            flat, ends = pieces.ravel(), 2 * line_ends
        ids, total = self._gather(flat)
        begin = 0
        for i, stop in zip(part, total[ends[last] - 1], strict=True):
            out[i] = ids[begin:stop]
            begin = stop
