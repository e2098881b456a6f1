"""What the operators of this package share: tables, lineage cuts, words and their hashes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scriptoria.scratch import shared_folder, staged

#: Bytes of text that one pass of the numpy kernels takes at a time (a longer text is one pass of its own).
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` as stored under `sf_dir`; any path that Spark can read will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes `df` to a table in the shared folder and reads it back, so that a lost executor costs no earlier stage.

    A table rather than checkpoint(): its rows are packed, and its plan is a plain scan, where a checkpoint
    keeps what the optimiser has inferred and loops pile that up. As with checkpoints, the files stay until
    the folder of the application (its id) is removed.
    """
    return staged(df)


_ASCII_BREAKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_OTHER_BREAK = re.compile(r"[^\w\x00-\x7f]")


def normal_bytes(text: str | None) -> bytes:
    """Lower-cased UTF-8 in which every character that is neither letter, digit nor mark is a space."""
    if not text:
        return b""
    text = text.lower()
    if not text.isascii() and _OTHER_BREAK.search(text):
        text = _OTHER_BREAK.sub(" ", text)
    return text.encode("utf-8", "replace").translate(_ASCII_BREAKS)


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text: case, punctuation and spacing do not count. Null and empty texts have none."""
    return normal_bytes(text).split()


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers, so that any bits of the result may be compared or cut out."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    """64-bit hashes of the words of many texts at once, by prefix sums of a polynomial over their bytes."""

    def __init__(self) -> None:
        self._up = self._down = np.empty(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            self._up, self._down = _powers(_BASE, n), _powers(_INVERSE, n)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, where each text's words begin; one number more than texts)."""
        parts = [normal_bytes(t) for t in texts]
        sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8) if parts else np.empty(0, np.uint8)
        n = len(raw)
        starts_of = np.concatenate([[0], np.cumsum(sizes)])
        self._grow(n + 1)
        inside = raw != 32
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw.astype(np.uint64) * self._up[:n], dtype=np.uint64)])
        hashes = mix64((sums[end] - sums[begin]) * self._down[begin])
        return hashes, np.searchsorted(begin, starts_of)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words (one run fewer than k words long: the whole, if any)."""
    if len(words) == 0:
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _BASE
        out += words[j : j + n]
    return mix64(out + np.uint64(k))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that a task makes Python's strings of a few texts at a time."""
    for b in batches:
        for begin in range(0, b.num_rows, rows):
            yield b.slice(begin, rows)


def text_chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about CHUNK_BYTES together."""
    begin = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= CHUNK_BYTES:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


__all__ = ["CHUNK_BYTES", "WordHasher", "cut_lineage", "mix64", "normal_bytes", "normal_words", "shared_folder", "shingle_hashes", "slices", "table", "text_chunks"]
