"""Secret scans: patterns plus sliding-window entropy per character class.

Three fixed patterns give the base spans (kinds ``assign``, ``access`` and
``hex``); matches are leftmost and non-overlapping per kind, and a match
that fails its length is dropped after it has used up its characters.

The method adds spans of kinds ``entropy16``, ``entropy36`` and ``entropy64``:
candidate strings are runs of base-64 alphabet characters.  In a candidate,
every maximal run of a class's characters is scored by itself: hexadecimal
digits in one case, letters of one case with digits, and the whole alphabet.
Over a run slides a window of ``Class.window`` characters, and the window's
Shannon entropy is kept up to date by the counts of the one character that
enters and the one that leaves.  Windows at or above the class's threshold are
merged into one span.  A base-36 span must hold a digit and a letter, a base-64
span a digit and both letter cases.  The allow list suppresses added spans
(never base ones): UUIDs and words with a placeholder in them (``your_`` with
the short words after it) are cut out of the candidate, and what stands beside
them is scored; spans that are runs of one repeated unit or ascending or
descending code points are dropped.  An added span inside a base span or
another added one is not reported again; of equal ones the narrower class's
stays.

Spans are code points, end exclusive, of the whole match.  Defined results:
null or empty text has no span; repeated rows are scanned alike; other
columns are ignored; an empty table gives an empty result.  Whole texts are
scanned, one document at a time, so memory is bounded by a batch of texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

# The base patterns and the least length of a match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs: as long runs of [0-9a-f]+
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
KINDS = ("assign", "access", "hex", "entropy16", "entropy64", "entropy36")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
UUID = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}(?![0-9A-Za-z])")
YOUR = re.compile(r"(?i)(?<![A-Za-z0-9])your[_-](?:[A-Za-z0-9]{1,19}(?![A-Za-z0-9])[_-]?)*")
PLACEHOLDER = re.compile(r"(?i)example|placeholder|changeme|xxxx")
REPEATED = re.compile(r"(.{1,8}?)\1{2,}.{0,8}\Z")


@dataclass(frozen=True)
class Class:
    kind: str
    window: int
    bits: float  # least entropy of a window, in bits a character


HEX_CLASS = Class("entropy16", 20, 3.1)
BASE36_CLASS = Class("entropy36", 20, 3.5)
BASE64_CLASS = Class("entropy64", 20, 3.7)
RUNS = (  # narrower classes first
    (HEX_CLASS, re.compile(r"[0-9a-f]{20,}")), (HEX_CLASS, re.compile(r"[0-9A-F]{20,}")),
    (BASE36_CLASS, re.compile(r"[0-9a-z]{20,}")), (BASE36_CLASS, re.compile(r"[0-9A-Z]{20,}")),
    (BASE64_CLASS, CANDIDATE),
)

# c * log2(c) for the counts in a window.
_XLOGX = tuple(0.0 if c < 2 else c * math.log2(c) for c in range(65))

Span = tuple[int, int, int]  # start, kind index, end


def _mixed(span: str, cls: Class) -> bool:
    """Whether a span holds the kinds of characters that its class asks for."""
    if cls is HEX_CLASS:
        return True
    upper, lower = any(c.isupper() for c in span), any(c.islower() for c in span)
    return any(c.isdigit() for c in span) and (upper and lower if cls is BASE64_CLASS else upper or lower)


def _ladder(s: str) -> bool:
    """Code points that rise or fall by one nearly everywhere."""
    steps = [ord(b) - ord(a) for a, b in zip(s, s[1:], strict=False)]
    return max(steps.count(1), steps.count(-1)) * 10 >= 8 * len(steps)


def entropy_spans(s: str, cls: Class) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows of ``s`` at or above the threshold."""
    w, counts, total = cls.window, {}, 0.0  # total: sum of c * log2(c) over the window
    out: list[tuple[int, int]] = []
    least = (math.log2(w) - cls.bits) * w + 1e-9  # entropy = log2(w) - total / w
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += _XLOGX[c + 1] - _XLOGX[c]
        counts[ch] = c + 1
        if i >= w:
            old = s[i - w]
            c = counts[old]
            total += _XLOGX[c - 1] - _XLOGX[c]
            counts[old] = c - 1
        if i >= w - 1 and total <= least:
            start = i - w + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def allowed(s: str) -> bool:
    """Whether the allow list knows a span as harmless."""
    return bool(UUID.fullmatch(s) or REPEATED.match(s)) or _ladder(s)


def unlisted(s: str) -> list[tuple[int, int]]:
    """[start, end) of a candidate's parts between UUIDs and placeholder words."""
    cuts = [m.span() for p in (UUID, YOUR) for m in p.finditer(s)]
    end = 0
    for m in PLACEHOLDER.finditer(s):
        if m.start() < end:
            continue
        start, end = m.span()
        while start and s[start - 1].isalnum():
            start -= 1
        while end < len(s) and s[end].isalnum():
            end += 1
        cuts.append((start, end))
    out, at = [], 0
    for a, b in sorted(cuts):
        if a > at:
            out.append((at, a))
        at = max(at, b)
    return [*out, (at, len(s))]


def base_spans(text: str) -> list[Span]:
    """Spans of the three patterns."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans of the entropy windows that no base span holds."""
    out: list[Span] = []
    for m in CANDIDATE.finditer(text):
        found = []
        for first, last in unlisted(m[0]):
            part = m[0][first:last]
            for order, (cls, run) in enumerate(RUNS):
                for r in run.finditer(part):
                    if not _mixed(r[0], cls):
                        continue
                    for a, b in entropy_spans(r[0], cls):
                        if _mixed(r[0][a:b], cls) and not allowed(r[0][a:b]):
                            start = m.start() + first + r.start()
                            found.append((start + a, -(start + b), order))
        end = 0
        for a, b, order in sorted(found):
            if -b > end:  # else inside an earlier one
                end = -b
                out.append((a, KINDS.index(RUNS[order][0].kind), end))
    return _outside(out, base)


def _outside(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that no base span holds; both lists are by start, so one pass
    with the farthest end of the base spans begun so far."""
    kept, at, farthest = [], 0, 0
    for x in spans:
        while at < len(base) and base[at][0] <= x[0]:
            farthest = max(farthest, base[at][2])
            at += 1
        if farthest < x[2]:
            kept.append(x)
    return kept


def _text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans) per row of ``docs``.

    Span columns are texts ``kind:start:end``, by start, then kind.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b["text"]:
                t = text.as_py() or ""
                base = base_spans(t)
                every = sorted(base + added_spans(t, base))
                rows.append((*(sum(s[1] == k for s in base) for k in range(3)), _text(base), _text(every)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        find, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of all ``documents``."""
    found = scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
