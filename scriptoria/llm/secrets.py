"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import slices

KINDS = ("assign", "access", "hex", "entropy")
_RANK = {kind: i for i, kind in enumerate(KINDS)}

# The base patterns.
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Character classes: name, run of the class, least bits of entropy in a window. The order is from narrow to wide.
WINDOW = 20
CLASSES = (
    ("hex", re.compile(r"[0-9A-Fa-f]{20,}"), 3.0),
    ("base32", re.compile(r"[A-Z2-7]{20,}"), 3.2),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.6),
)
#: Candidate strings that are no secrets, as whole strings. Each is read in one way only, so that no string is tried twice.
ALLOW = (
    re.compile(r"[A-Za-z]+"),  # words, however long
    re.compile(r"[0-9]+"),  # numbers
    re.compile(r"[^A-Za-z0-9]+"),  # rules and rows of signs
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUIDs
    re.compile(r"(?:[A-Z]?[a-z]++|[A-Z]++|[0-9]{1,4}+)(?:[-_/=+](?:[A-Z]?[a-z]++|[A-Z]++|[0-9]{1,4}+)?+)++"),  # names, slugs, paths, dates
)
#: Placeholders are made of such words and signs only, whatever their case.
PLACEHOLDER_WORDS = (
    "x", "0", "your", "my", "the", "a", "an", "insert", "change", "me", "here", "this", "example", "sample", "dummy", "placeholder", "fake", "test", "demo", "redacted",
    "secret", "access", "private", "public", "api", "auth", "key", "token", "password", "id", "-", "_", "=", "+", "/",
)
_BY_FIRST = {c: tuple(w for w in PLACEHOLDER_WORDS if w[0] == c) for c in {w[0] for w in PLACEHOLDER_WORDS}}
_LETTERS = frozenset("".join(PLACEHOLDER_WORDS))
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def entropy_runs(text: str, least: float, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Merged ranges whose windows of `window` characters have at least `least` bits of Shannon entropy a character.

    The entropy is log2(w) - sum(c * log2(c)) / w; the sum is kept as one character enters and one leaves.
    """
    if math.log2(max(1, len(set(text)))) < least - 1e-6:
        return  # no window of so few characters has that much
    counts: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1
    full, most = math.log2(window), window * (math.log2(window) - least) + 1e-9
    for i, char in enumerate(text):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += _TERM[c + 1] - _TERM[c]
        if i >= window:
            gone = text[i - window]
            c = counts[gone]
            counts[gone] = c - 1
            total += _TERM[c - 1] - _TERM[c]
        if i >= window - 1 and total <= most and full >= least:
            if begin < 0 or i - window + 1 > end:
                if begin >= 0:
                    yield begin, end
                begin = i - window + 1
            end = i + 1
    if begin >= 0:
        yield begin, end


def placeholder(candidate: str) -> bool:
    """Whether `candidate` is some placeholder words, one after the other: each place is looked at once, whatever the ways to it."""
    low, places, last = candidate.lower(), {0}, 0
    if not _LETTERS.issuperset(low):
        return False
    for i in range(len(low)):
        if i in places:
            places.discard(i)
            ends = [i + len(w) for w in _BY_FIRST.get(low[i], ()) if low.startswith(w, i)]
            places.update(ends)
            last = max([last, *ends])
        elif i >= last:
            return False
    return len(low) in places and bool(low)


def allowed(candidate: str) -> bool:
    return any(p.fullmatch(candidate) for p in ALLOW) or placeholder(candidate)


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets, by start and kind; offsets count code points, the end is exclusive."""
    if not text:
        return []
    found: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    long_runs = list(_LONG.finditer(text))
    if long_runs:
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    for run in long_runs:
        if allowed(run[0]):
            continue
        spans: set[tuple[int, int]] = set()
        for _, of_class, least in CLASSES:
            for m in of_class.finditer(run[0]):
                if m[0] == run[0] or not allowed(m[0]):
                    spans.update((m.start() + b, m.start() + e) for b, e in entropy_runs(m[0], least))
        last = -1
        merged: list[list[int]] = []
        for b, e in sorted(spans):
            if b < last:
                merged[-1][1] = last = max(last, e)
            else:
                merged.append([b, e])
                last = e
        found += [(run.start() + b, run.start() + e, "entropy") for b, e in merged]
    return sorted(found, key=lambda s: (s[0], _RANK[s[2]]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{b}:{e}" for b, e, kind in spans)


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each stretch of overlapping or touching spans replaced by `mark`; null stays null."""
    spans = find_spans(text)
    if not spans:
        return text
    out, last, end = [], 0, -1
    for b, e, _ in spans:
        if b > end:
            if end >= 0:
                last = end
            out += [text[last:b], mark]
        end = max(end, e)
    return "".join([*out, text[end:]])


_SPAN = "array<struct<start:long,end:long,kind:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id_col, secrets) for each row of `docs`; secrets is an array of (start, end, kind).

    Null and empty texts have no secrets; repeated rows and null ids are kept as they are; an empty table
    gives an empty result. Other columns of `docs` are not read, so their names cannot clash. Texts of any
    length are scanned whole. Each task streams its rows, so nothing is shuffled.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [[{"start": s, "end": e, "kind": k} for s, e, k in find_spans(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], [id_col, "secrets"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {id_type}, secrets {_SPAN}")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in `text_col` replaced by `mark`; all columns and rows stay, null texts stay null.

    Empty texts stay empty, repeated rows are repeated in the result, an empty table stays empty. The columns
    are taken by their places, so extra ones of any name pass through. Texts of any length are taken whole.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = pa.array([redacted(t, mark) for t in b.column(at).to_pylist()], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else b.column(i) for i in range(b.num_columns)], schema=b.schema)

    return docs.mapInArrow(run, docs.schema)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text, from what scan() gives."""
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(id_col, *(n(k) for k in KINDS[:3]), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"), n("entropy"))
