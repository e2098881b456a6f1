"""Repeated passages: sparse suffix arrays over minimiser positions, neighbours compared, matches extended both ways."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import WordHasher, _powers, cut_lineage, mix64, text_chunks

#: Words of the shortest passage that counts.
MIN_WORDS = 50
#: Words of the gram whose hash selects a suffix. Of each MIN_WORDS - GRAM_WORDS + 1 grams in a row the least is taken,
#: so that two passages of MIN_WORDS words that are the same keep a suffix at the same place in both.
GRAM_WORDS = 32
REACH = MIN_WORDS - GRAM_WORDS

_UP = np.uint64(0xD6E8FEB86659FD93)
_DOWN = np.uint64(pow(int(_UP), -1, 1 << 64))


def grams(words: np.ndarray) -> np.ndarray:
    """Hashes of all stretches of GRAM_WORDS words."""
    n = len(words)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(_UP, n), dtype=np.uint64)])
    begin = np.arange(n - GRAM_WORDS + 1)
    return mix64((sums[begin + GRAM_WORDS] - sums[begin]) * _powers(_DOWN, n + 1)[begin])


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes of the grams there) of the suffixes that are retained; none if the text is too short for a passage."""
    if len(words) < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = grams(words)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, REACH + 1)
    at = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return at, hashes[at]


def spelled(words: np.ndarray) -> np.ndarray:
    """32 bits of each word's hash, never 0, as they are put into sort keys: big-endian, so that keys sort like their words."""
    return np.maximum((words >> np.uint64(32)).astype(np.uint32), 1).astype(">u4")


def merged(starts: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the stretches that passages of MIN_WORDS words cover without a gap, end exclusive: each word lies in one of them."""
    out: list[list[int]] = []
    for s in sorted(set(starts)):
        if out and s <= out[-1][1]:
            out[-1][1] = s + MIN_WORDS
        else:
            out.append([s, s + MIN_WORDS])
    return [(b, e) for b, e in out]


def word_offsets(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each word of a text, as common.normal_words() cuts it, in code points."""
    out: list[tuple[int, int]] = []
    begin = last = -1
    for i, char in enumerate(text or ""):
        for low in char.lower():  # of some capitals, a letter and a mark that is a break
            if re.match(r"[^\W_]" if low < "\x80" else r"\w", low):
                begin, last = i if begin < 0 else begin, i
            elif begin >= 0:
                out.append((begin, last + 1))
                begin = -1
    return [*out, (begin, last + 1)] if begin >= 0 else out


def _suffixes(texts: DataFrame) -> DataFrame:
    """(n1, n2, at, gram): the retained suffixes of each row of `texts` (n1, n2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            marks, all_texts = [b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)], b.column(2).to_pylist()
            for begin, end in text_chunks(all_texts):
                words, bounds = hasher(all_texts[begin:end])
                found = [minimisers(words[bounds[i] : bounds[i + 1]]) for i in range(end - begin)]
                sizes = [len(f[0]) for f in found]
                at, gram = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(m[begin:end], sizes), pa.int64()) for m in marks), pa.array(at.astype(np.int32)), pa.array(gram.view(np.int64))], ["n1", "n2", "at", "gram"])

    return texts.mapInArrow(run, "n1 long, n2 long, at int, gram long")


def _spelled_suffixes(texts: DataFrame) -> DataFrame:
    """(right, left, n1, n2, at): the words of each suffix that is asked for, up to MIN_WORDS, and the REACH words before it, the nearest first.

    `texts` is (n1, n2, text, copies, ats). A text of which there are several copies, and which is long
    enough, has one more row without words: at is minus its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            n1, n2, all_texts, copies, ats = (b.column(k).to_pylist() for k in range(5))
            for begin, end in text_chunks(all_texts):
                words, bounds = hasher(all_texts[begin:end])
                rows: list[tuple[bytes, bytes, int, int, int]] = []
                for i in range(begin, end):
                    own = spelled(words[bounds[i - begin] : bounds[i - begin + 1]])
                    back = own[::-1]
                    n = len(own)
                    if copies[i] > 1 and n >= MIN_WORDS:
                        rows.append((b"", b"", n1[i], n2[i], -n))
                    rows += [(own[at : at + MIN_WORDS].tobytes(), back[n - at : n - at + REACH].tobytes(), n1[i], n2[i], at) for at in ats[i] or ()]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()), strict=True)], ["right", "left", "n1", "n2", "at"])

    return texts.mapInArrow(run, "right binary, left binary, n1 long, n2 long, at int")


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(words by rows, 0 where a row has no more; how many each row has) of a column of sort keys."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(">u4") if data is not None and ends[-1] > ends[0] else np.empty(0, ">u4")
    sizes = np.diff(ends) // 4
    out = np.zeros((len(column), width), np.uint32)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out, sizes


def _agreeing(rows: np.ndarray) -> np.ndarray:
    """How many first words each row has in common with the row before it; none for the first."""
    unlike = (rows[1:] != rows[:-1]) | (rows[1:] == 0)
    found = np.where(unlike.any(axis=1), unlike.argmax(axis=1), rows.shape[1])
    return np.concatenate([[0], found]).astype(np.int64)


@dataclass
class _Sorted:
    """Rows of sorted suffixes: words to the right and to the left, the text's two marks, the place in it."""

    right: np.ndarray
    left: np.ndarray
    sizes: np.ndarray  # of right
    before: np.ndarray  # of left
    n1: np.ndarray
    n2: np.ndarray
    at: np.ndarray

    def __getitem__(self, rows: slice) -> _Sorted:
        return _Sorted(*(getattr(self, f.name)[rows] for f in fields(self)))

    @staticmethod
    def joined(parts: list[_Sorted]) -> _Sorted:
        return _Sorted(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(_Sorted)))

    def __len__(self) -> int:
        return len(self.at)


_TOLD = ("kind", "k1", "k2", "n1", "n2", "m1", "m2", "start")
_TOLD_SCHEMA = "kind int, k1 long, k2 long, n1 long, n2 long, m1 long, m2 long, start int"


def _rows(kind: int, n1: np.ndarray, n2: np.ndarray, start: np.ndarray | None = None, keys: tuple[np.ndarray, np.ndarray] | None = None, m: tuple[np.ndarray, np.ndarray] | None = None) -> pa.RecordBatch:
    none = np.zeros(len(n1), np.int64)
    columns = [np.full(len(n1), kind), *(keys or (none, none)), n1, n2, *(m or (none, none)), none if start is None else start]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if name in ("kind", "start") else pa.int64()) for name, c in zip(_TOLD, columns, strict=True)], list(_TOLD))


def _compared(rows: _Sorted, first_open: bool, last_open: bool) -> Iterator[pa.RecordBatch]:
    """Compares neighbours of a stretch of sorted suffixes, and extends what agrees to the left and to the right.

    Neighbours whose common prefix is shorter than GRAM_WORDS part the stretch into runs. A passage that takes
    d words on the left of a suffix and the rest on its right is in another text as well if both of its parts
    agree with those of another row of the run. How far rows agree is found on the right from the order they
    stand in, on the left from sorting the run by the words before; so all passages around all suffixes are
    compared word by word, without looking at pairs. Told as in _neighbours(); an open run may go on elsewhere.
    """
    n = len(rows)
    agree = _agreeing(rows.right)
    run = np.cumsum(agree < GRAM_WORDS)
    open_ = (first_open & (run == run[0])) | (last_open & (run == run[-1]))
    order = np.lexsort([rows.left[:, k] for k in range(REACH - 1, -1, -1)] + [run])
    behind = _agreeing(rows.left[order])
    behind[np.concatenate([[True], run[order][1:] != run[order][:-1]])] = -1
    words = keys = None
    for d in range(REACH + 1):
        has = np.flatnonzero((rows.before >= d) & (rows.sizes >= MIN_WORDS - d))
        if not len(has):
            continue
        side = np.empty(n, np.int64)
        side[order] = np.cumsum(behind < d)
        group = np.cumsum(agree < MIN_WORDS - d)[has] * (n + 1) + side[has]
        by = np.argsort(group, kind="stable")
        has, group = has[by], group[by]
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        member = np.repeat(np.arange(len(cuts)), np.diff(np.concatenate([cuts, [len(has)]])))
        n1, n2 = rows.n1[has], rows.n2[has]
        lo1, hi1, lo2, hi2 = (f.reduceat(x, cuts) for x in (n1, n2) for f in (np.minimum, np.maximum))
        several = (lo1 != hi1) | (lo2 != hi2)
        hit = several[member]
        yield _rows(0, n1[hit], n2[hit], rows.at[has[hit]] - d)
        told = open_[has[cuts]]
        if told.any():
            if words is None:  # of open runs, hashes of 128 bits of the words of each passage
                whole = np.concatenate([rows.left[:, ::-1], rows.right], axis=1).astype(np.uint64)
                words = [np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(mix64(whole + np.uint64(salt)) * _powers(_UP, whole.shape[1]), axis=1, dtype=np.uint64)], axis=1) for salt in (0, 1 << 40)]
                down = _powers(_DOWN, REACH + 1)
            keys = [mix64((w[:, REACH - d + MIN_WORDS] - w[:, REACH - d]) * down[REACH - d]).view(np.int64) for w in words]
            heads = has[cuts[told]]
            yield _rows(1, lo1[told], lo2[told], None, (keys[0][heads], keys[1][heads]), (hi1[told], hi2[told]))
            alone = (told & ~several)[member]
            yield _rows(2, n1[alone], n2[alone], rows.at[has[alone]] - d, (keys[0][has[alone]], keys[1][has[alone]]))


#: Sorted suffixes that are compared at a time; a longer run of one gram is cut, and its parts are matched like those of different tasks.
CHUNK_ROWS = 1 << 15


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares one sorted part (right, left, n1, n2, at): kind 0 is a passage (n1, n2, start) that another text has.

    The first and the last run of the part, and one that is cut, may go on elsewhere. Of their passages, kind 1
    tells the least and greatest marks of the texts that have it here, by its key (k1, k2); kind 2 is a passage
    of which only one text is seen here. Kind 3 is a text with copies, passed on.
    """
    held: list[_Sorted] = []
    first_open = True

    def stretches(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, first_open
        rows = _Sorted.joined(held)
        begins = np.flatnonzero(np.concatenate([[True], _agreeing(rows.right)[1:] < GRAM_WORDS]))
        cut = len(rows) if last or begins[-1] == 0 else int(begins[-1])  # one run alone is cut where it stands
        goes_on = last or begins[-1] == 0
        yield from _compared(rows[:cut], first_open, goes_on)
        first_open = goes_on
        held = [rows[cut:]] if cut < len(rows) else []

    for b in batches:
        right, sizes = _matrix(b.column(0), MIN_WORDS)
        left, before = _matrix(b.column(1), REACH)
        rows = _Sorted(right, left, sizes, before, *(b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3, 4)))
        copied = rows.at < 0
        if copied.any():
            yield _rows(3, rows.n1[copied], rows.n2[copied], rows.at[copied])
            rows = rows[~copied]
        if len(rows):
            held.append(rows)
        if sum(map(len, held)) >= CHUNK_ROWS:
            yield from stretches(False)
    if held:
        yield from stretches(True)


def _marks(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that together tell a text; null is the empty one."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.xxhash64(text).alias("n1"), F.xxhash64(text, F.lit(1)).alias("n2")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id_col, start_word, end_word, n_words, whole_copy) for each repeated stretch of each row of `docs`.

    Each word of a stretch lies in a passage of MIN_WORDS words of it that, case and punctuation apart, is in
    another text too; stretches that touch are one. Or else the row's whole text of MIN_WORDS words or more is
    that of another row (whole_copy). Words are counted from 0, end_word is exclusive; word_offsets() gives
    their places. Null, empty and shorter texts have none; a passage that only its own text repeats does not
    count; repeated rows are copies; null ids stay; an empty table gives an empty result; other columns are
    not read.

    Each distinct text keeps the suffixes at its minimisers. Those whose gram no other text has cannot have a
    neighbour that agrees for long, and go. The others are sorted over the whole corpus by their words (32
    bits of each), neighbours are compared, and what agrees is extended left and right; see _compared(). The
    sort goes on by the words before, text and place, so Spark can cut even the run of a passage that very
    many texts share, and no key is hot. What is cut is matched up from what each part tells of its ends.
    """
    of_text = [F.col("n1"), F.col("n2")]
    texts = docs.select(*_marks(F.col(text_col)), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    suffixes = _suffixes(texts)
    shared = suffixes.groupBy("gram").agg(F.min("n1").alias("lo"), F.max("n1").alias("hi")).where("lo <> hi").select("gram")
    shared = cut_lineage(shared)  # so that Spark can split the join for a gram that very many texts have
    kept = suffixes.join(shared, "gram").groupBy(*of_text).agg(F.collect_set("at").alias("ats"))
    by_text = texts.groupBy(*of_text).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    wanted = by_text.join(kept, ["n1", "n2"], "left").where("copies > 1 or ats is not null")
    key = ["right", "left", "n1", "n2", "at"]
    ordered = _spelled_suffixes(wanted.select("n1", "n2", "text", "copies", "ats")).repartitionByRange(*key).sortWithinPartitions(*key)
    told = cut_lineage(ordered.mapInArrow(_neighbours, _TOLD_SCHEMA))
    ends = told.where("kind = 1").groupBy("k1", "k2").agg(F.min("n1").alias("a"), F.max("m1").alias("b"), F.min("n2").alias("c"), F.max("m2").alias("d")).where("a <> b or c <> d").select("k1", "k2")
    hits = told.where("kind = 0").select("n1", "n2", "start").union(told.where("kind = 2").join(ends, ["k1", "k2"], "left_semi").select("n1", "n2", "start"))

    def merge(starts: pd.Series) -> pd.Series:
        return starts.map(lambda x: [{"start_word": b, "end_word": e} for b, e in merged(list(x))])

    spans = F.pandas_udf(merge, "array<struct<start_word:int,end_word:int>>")
    found = cut_lineage(hits.groupBy(*of_text).agg(F.collect_set("start").alias("starts")).select("n1", "n2", spans("starts").alias("spans")))
    whole = told.where("kind = 3").select("n1", "n2", (-F.col("start")).alias("n"))
    span = F.array(F.struct(F.lit(0).alias("start_word"), F.col("n").alias("end_word")))
    by_mark = found.join(whole, ["n1", "n2"], "full").select("n1", "n2", F.when(F.col("n").isNotNull(), span).otherwise(F.col("spans")).alias("spans"), F.col("n").isNotNull().alias("whole_copy"))
    slim = docs.select(F.col(id_col).alias("id"), *_marks(F.col(text_col)))
    out = slim.join(by_mark, ["n1", "n2"]).select("id", "whole_copy", F.explode("spans").alias("s"))
    return out.select(F.col("id").alias(id_col), "s.start_word", "s.end_word", (F.col("s.end_word") - F.col("s.start_word")).alias("n_words"), "whole_copy")
