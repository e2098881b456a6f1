"""Edit distance of long texts: bit-parallel columns in a diagonal band, which is widened until the distance fits it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cells of the table of two texts up to which Spark's own levenshtein is faster.
SMALL_CELLS = 1 << 19
#: Half the first band, and columns whose pattern masks are made together.
BAND, COLUMNS = 64, 2048


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    return int(differs[0]) if len(differs) else n


def _masks(rows: np.ndarray) -> dict[int, int]:
    """For each code point the rows that hold it, as bits."""
    order = np.argsort(rows, kind="stable")
    points, begin = np.unique(rows[order], return_index=True)
    out, size = {}, len(rows) // 8 + 1
    for point, at in zip(points.tolist(), np.split(order, begin[1:]), strict=True):
        if len(at) < 40:
            out[point] = sum(1 << int(i) for i in at)
        else:
            bits = np.zeros(size * 8, np.uint8)
            bits[at] = 1
            out[point] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    return out


def banded(pattern: np.ndarray, text: np.ndarray, k: int) -> int:
    """The edit distance if it is k or less, else some number above k. The text is no shorter than the pattern, by k at most.

    Column j holds the vertical differences of rows j - k to j + k, a bit a row; the next column's bits lie one place
    lower. A row that enters below counts as a substitution more than its upper left neighbour, which is never too little. The value
    is followed down the band's lower edge to the last row, then along that.
    """
    m, n = len(pattern), len(text)
    width = 2 * k + 1
    full = (1 << width) - 1
    plus, minus = full >> k << k, 0  # rows above the first have no difference
    value = min(k, m)
    low_edge = 1 << (width - 1)
    columns = max(COLUMNS, 2 * k)
    points = text.tolist()
    for first in range(1, n + 1, columns):
        # Rows of the pattern that the band of these columns can meet: row i is bit i - begin of a mask.
        begin = max(1, first - k)
        masks = _masks(pattern[begin - 1 : min(m, first + columns + k)])
        for j in range(first, min(n, first + columns - 1) + 1):
            mask = masks.get(points[j - 1], 0)
            shift = j - k - begin
            match = (mask >> shift if shift >= 0 else mask << -shift) & full
            diagonal = ((((match & plus) + plus) & full) ^ plus) | match | minus
            right_plus = minus | (full ^ (diagonal | plus))
            right_minus = diagonal & plus
            if j + k <= m:
                if not diagonal & low_edge:
                    value += 1
            else:
                last = 1 << (m - j + k) if m - j + k >= 0 else 0
                if right_plus & last:
                    value += 1
                elif right_minus & last:
                    value -= 1
            below = diagonal >> 1
            plus = right_minus | (full ^ (below | right_plus))
            minus = below & right_plus
    return value


def unmatched(a: np.ndarray, b: np.ndarray) -> int:
    """Code points of the one that the other has not, each as often as it occurs, the greater number of the two sides: no edit distance is less."""
    at = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    n = int(at.max()) + 1
    more = np.bincount(at[: len(a)], minlength=n) - np.bincount(at[len(a) :], minlength=n)
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def edit_distance(left: str, right: str) -> int:
    """Insertions, deletions and substitutions of code points that turn one text into the other.

    What both begin and end with is cut off. Where bounds meet, they are the answer, in one pass: the difference of lengths, if the
    shorter is left when code points of the longer are taken out; or what is unmatched, if texts of one length differ in so many places. Else the
    band starts at BAND around the lower bound, and grows fourfold.
    """
    if left == right:
        return 0
    a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) for x in (left, right))
    begin = common_prefix(a, b)
    a, b = a[begin:], b[begin:]
    end = common_prefix(a[::-1], b[::-1])
    a, b = a[: len(a) - end], b[: len(b) - end]
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return len(b)
    if len(a) < len(b):
        rest = iter(b.tolist())
        if all(x in rest for x in a.tolist()):
            return len(b) - len(a)
    least = unmatched(a, b)
    most = int(np.count_nonzero(a != b)) if len(a) == len(b) else len(b)
    if least == most:
        return least
    k = least + BAND
    while True:
        k = min(k, most)
        found = banded(a, b, k)
        if found <= k:
            return found
        k *= 4


def edits(left: Column, right: Column) -> Column:
    """The edit distance of two texts in code points, null if one is null. Tables of few cells are Spark's, others are told in Arrow batches."""

    @F.pandas_udf("long")
    def long_ones(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in pairs:
            yield pd.Series([None if x is None or y is None else edit_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")

    small = F.length(left).cast("long") * F.length(right) <= SMALL_CELLS
    large = ~small
    return F.when(small, F.levenshtein(left, right).cast("long")).otherwise(long_ones(F.when(large, left), F.when(large, right)))


__all__ = ["BAND", "SMALL_CELLS", "banded", "edit_distance", "edits"]
