"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings by character class."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from catchment.llm.buffers import LOWER, flat, giving_back, text_bytes

# Fixed patterns of the base kinds, with the least length of what must be long.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 18
HEX = re.compile(r"[0-9a-f]+")
HEX_CHARS = 16
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings for the entropy scan, and the window that slides over them.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Least bits per character of a window, by class of the candidate. 20 characters have at most 4.32 bits.
LEAST_BITS = {"hex": 3.0, "alnum": 3.6, "base64": 3.8}
#: Candidates that are never secrets: placeholders, one character repeated, identifiers made of words.
ALLOWED = re.compile(
    r"(?i:example|sample|placeholder|changeme|dummy|your[_-])|^(.)\1*$|^[A-Za-z][A-Za-z_/+=-]*$|^[0-9_/+=-]*$"
)

#: Within a candidate: words, which separators join to names or to each other, those that mark a placeholder, and
#: upper-case hex, which has no base kind.
WORD = re.compile(r"[A-Za-z0-9]+")
PLACEHOLDER = re.compile(r"(?i:example|sample|placeholder|changeme|dummy)")
UPPER_HEX = re.compile(rf"[0-9A-F]{{{WINDOW},}}")

_KEYWORDS = (b"passw", b"secret", b"token", b"api", b"akia")
_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*b"0123456789abcdef"]] = True
_IS_CANDIDATE = np.zeros(256, bool)
_IS_CANDIDATE[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def character_class(candidate: str) -> str:
    """hex, alnum (letters and digits) or base64 (anything more)."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return "hex"
    return "alnum" if candidate.isalnum() else "base64"


def entropy_spans(candidate: str, window: int = WINDOW, least: dict[str, float] | None = None) -> list[tuple[int, int]]:
    """Merged windows of a candidate whose Shannon entropy reaches the bound of its class.

    The sum of c * log2(c) over the counts in the window is kept by adding the character that enters and taking out
    the one that leaves, so a step costs the same however long the window is.
    """
    if len(candidate) < window or ALLOWED.search(candidate):
        return []
    bound = (least or LEAST_BITS)[character_class(candidate)]
    terms = [0.0] + [n * log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += terms[n + 1] - terms[n]
        if i < window - 1:
            continue
        if log2(window) - total / window >= bound - 1e-9:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
        gone = candidate[i - window + 1]
        n = counts[gone]
        counts[gone] = n - 1
        total += terms[n - 1] - terms[n]
    return out


def values(candidate: str) -> Iterator[tuple[int, str]]:
    """Place and text of all that a secret in a candidate may be: each is classed and checked against the allow-list alone.

    These are the stretches between words that mark a placeholder, the words in them, and the upper-case hex in those.
    So a name beside a secret changes neither its bound nor whether it counts, and a secret with separators stays whole.
    """
    at, words = 0, [m.span() for m in WORD.finditer(candidate)]
    for start, end in [*words, (len(candidate), len(candidate))]:
        word = candidate[start:end]
        yours = word[-4:].lower() == "your" and candidate[end : end + 1] in ("_", "-")
        if yours or start == len(candidate) or PLACEHOLDER.search(word):
            yield at, candidate[at:start]
            at = end + (end < len(candidate))  # without the separator that joins them
        elif len(word) >= WINDOW:
            yield start, word
            yield from ((start + m.start(), m[0]) for m in UPPER_HEX.finditer(word))


def candidate_spans(candidate: str) -> list[tuple[int, int]]:
    """Merged spans of all values of a candidate."""
    found = {(at + start, at + end) for at, value in set(values(candidate)) for start, end in entropy_spans(value)}
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text in code points, end exclusive, by start and then by kind as listed."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_VALUE]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    spans += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= HEX_CHARS]
    base = list(spans)
    for m in CANDIDATE.finditer(text):
        for start, end in candidate_spans(m[0]):
            start, end = m.start() + start, m.start() + end
            if not any(a <= start and end <= b for _, a, b in base):
                spans.append(("entropy", start, end))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _runs_of(is_member: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """Where `length` members stand in a row, by doubling."""
    mask, have = is_member[data], 1
    while have < length and len(mask):
        step = min(have, length - have)
        mask = mask[:-step] & mask[step:] if len(mask) > step else mask[:0]
        have += step
    return np.flatnonzero(mask)


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows in which any pattern can match; a test over the batch's bytes that passes over the rest."""
    hits = [_runs_of(_IS_HEX, data, HEX_CHARS), _runs_of(_IS_CANDIDATE, data, WINDOW)]
    low = LOWER[data].tobytes()
    for word in _KEYWORDS:
        at, found = low.find(word), []
        while at >= 0:
            found.append(at)
            at = low.find(word, at + 1)  # a hit across two rows may overlap the next
        hits.append(np.array(found, np.int64))
    return np.unique(np.searchsorted(offsets, np.concatenate(hits), side="right") - 1)


def spans_of(texts: pa.Array) -> pa.Array:
    data, offsets = flat(texts)
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for row in _suspects(data, offsets):
        out[row] = [{"kind": k, "start": a, "end": b} for k, a, b in find(text_bytes(data, offsets, row).decode("utf-8", "replace"))]
    return pa.array(out, _SPANS)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by one mark that names its first kind."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan(text: Column | str) -> Column:
    """Spans of a text column. A null or empty text has none; overlapping kinds are all listed."""

    @arrow_udf(SPANS)
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(spans_of, batches)

    return run(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows as they are, with every secret in `text` replaced by a mark. A null text stays null."""

    @arrow_udf("string")
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = texts.to_pylist()
            for row in _suspects(*flat(texts)):
                out[row] = redact_text(out[row], find(out[row]))
            yield pa.array(out, pa.string())

    return docs.withColumn(text, run(F.col(text)))
