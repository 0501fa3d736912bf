"""Secret scans: fixed patterns, and windows of high entropy.

Besides assignments, access keys and long hexadecimal strings, candidate
strings (runs of key characters) are scanned per character class with a
sliding window. The window's Shannon entropy is kept up to date from counts:
a step changes two of them. Windows above the class's threshold are joined to
spans; an allow list suppresses candidates that are known to be harmless
(plain words, identifiers, numbers, UUIDs).

Null and empty texts have no spans; repeated rows are scanned as rows of their
own; an empty table gives an empty result; other columns are kept by
:func:`redact` and ignored by :func:`scan`. Offsets are code points.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import bound_batches

# The base patterns, over text whose letters A-Z are lower case
# (assign) or as they are, and the least length of what they must hold.
_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class EntropyClass:
    """A character class with its window (characters) and threshold (bits a character)."""

    name: str
    run: re.Pattern
    window: int
    bits: float


CLASSES = (EntropyClass("entropy_hex", re.compile(rb"[0-9a-fA-F]{20,}"), 20, 3.0),
           EntropyClass("entropy_base64", re.compile(rb"[A-Za-z0-9+/=_-]{24,}"), 24, 4.0))
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/=_-]{20,}")

#: Candidates that match one of these as a whole are harmless.
ALLOW = (rb"[A-Za-z]+",  # words
         rb"[0-9_=+/-]+",  # numbers and rules
         rb"[A-Z]?[a-z]*([_/-][A-Z]?[a-z]*)+[0-9]{0,4}", rb"[A-Z]*([_/-][A-Z]*)+[0-9]{0,4}",  # identifiers and paths
         rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")  # UUIDs


def entropy_windows(run: bytes, window: int, bits: float) -> list[tuple[int, int]]:
    """Spans joined from the windows whose entropy is ``bits`` or more."""
    # With s the sum of c * log2(c) over the counts, a window's entropy is log2(window) - s / window.
    weigh = [0.0, *(c * math.log2(c) for c in range(1, window + 1))]
    most = (math.log2(window) - bits) * window + 1e-9
    counts = Counter(run[:window])
    s = sum(weigh[c] for c in counts.values())
    spans: list[tuple[int, int]] = []
    for start in range(len(run) - window + 1):
        if start:
            gone, come = run[start - 1], run[start + window - 1]
            c = counts[gone]
            s += weigh[c - 1] - weigh[c]
            counts[gone] = c - 1
            c = counts[come]
            s += weigh[c + 1] - weigh[c]
            counts[come] = c + 1
        if s <= most:
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], start + window)
            else:
                spans.append((start, start + window))
    return spans


class Scanner:
    """Spans ``(kind, start, end)`` of one text, by start, then in the order of the kinds."""

    def __init__(self, classes: tuple[EntropyClass, ...] = CLASSES, allow: tuple[bytes, ...] = ALLOW):
        self.classes = classes
        self.allowed = re.compile(b"|".join(b"(?:" + a + b")" for a in allow)).fullmatch
        self.order = {k: i for i, k in enumerate((*BASE_KINDS, *(c.name for c in classes)))}

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        raw = text.encode("utf-8", "surrogatepass")
        found = [("assign", *m.span()) for m in _ASSIGN.finditer(raw.lower()) if m.end(1) - m.start(1) >= LEAST_ASSIGNED]
        found += [("access", *m.span()) for m in _ACCESS.finditer(raw)]
        found += [("hex", *m.span()) for m in _HEX.finditer(raw)]
        base = sorted((a, b) for _, a, b in found)
        reach = list(accumulate((b for _, b in base), max))
        for candidate in _CANDIDATE.finditer(raw):
            if self.allowed(candidate[0]):
                continue
            for kind in self.classes:
                for run in kind.run.finditer(raw, *candidate.span()):
                    if self.allowed(run[0]):
                        continue
                    for a, b in entropy_windows(run[0], kind.window, kind.bits):
                        a, b = a + run.start(), b + run.start()
                        before = bisect_right(base, (a, len(raw)))
                        if not before or reach[before - 1] < b:  # else it lies within a base span
                            found.append((kind.name, a, b))
        found.sort(key=lambda f: (f[1], self.order[f[0]]))
        if found and len(raw) != len(text):
            # From bytes to code points: bytes that begin one, counted from the front.
            before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
            found = [(k, int(before[a]), int(before[b])) for k, a, b in found]
        return found


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: ``array<struct<kind, start, end>>`` of each document."""
    bound_batches(docs.sparkSession)

    def run(batches):
        scanner = Scanner()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t or "")]
                    for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns kept, with each span of the text replaced by ``[kind]`` of its first finding."""
    bound_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def clean(scanner: Scanner, text: str | None) -> str | None:
        if not text or not (spans := scanner.spans(text)):
            return text
        out, done = [], 0
        for kind, a, b in spans:
            if a >= done:
                out += [text[done:a], f"[{kind}]"]
            done = max(done, b)
        return "".join([*out, text[done:]])

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            texts = pa.array([clean(scanner, t) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def joined(spans, kinds: tuple[str, ...] | None = None):
    """``kind:start:end`` of an array of spans, comma-joined."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
