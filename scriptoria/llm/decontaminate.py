"""Benchmark decontamination: every passage of every document is a query against a BM25 index of the test items."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from scriptoria.llm.common import WordHasher, cut_lineage, normal_words, shingle_hashes, text_chunks

K1, B = 1.2, 0.75
#: Least BM25 score of an item, as a share of the score that the item's own text gets.
THRESHOLD = 0.6
#: Least share of the word runs of question and of answer that the passage must hold.
OVERLAP = 0.6
#: Least share of the word runs of a whole item that lets its parts be told by their words, as one edit spoils all runs of a short part.
WHOLE_OVERLAP = 0.8
SHINGLE = 5
#: Postings whose best impact is kept together, and bytes of items that one index (and so one broadcast) holds.
POSTING_BLOCK, SHARD_BYTES = 32, 8 << 20
#: What the terms of an item that the screen leaves out may score together, at most.
REST = 0.25


@dataclass
class Item:
    item_id: object
    question: np.ndarray  # its words, as those of the answer
    answer: np.ndarray
    words: np.ndarray


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of a test item: the answer is its last sentence, or the last third of a single one."""
    text = text.strip()
    ends = [m.end() for m in re.finditer(r"[.?!](?=\s)", text)]
    if ends and len(normal_words(text[ends[-1] :])) >= SHINGLE:
        return text[: ends[-1]], text[ends[-1] :]
    words = text.split()
    cut = len(words) - max(1, len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


@dataclass
class Statistics:
    """What BM25 knows of all items: how many there are, their mean length in words, and in how many each term is."""

    n: int
    mean: float
    terms: np.ndarray  # rising
    frequency: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Statistics:
        words, bounds = WordHasher()(texts)
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(texts)), sizes)
        pairs = np.unique(np.stack([owner.astype(np.uint64), words]), axis=1)[1] if len(words) else np.empty(0, np.uint64)
        terms, frequency = np.unique(pairs, return_counts=True)
        n = int((sizes > 0).sum())
        return cls(n, float(sizes.sum()) / max(n, 1), terms, frequency)


class ItemIndex:
    """Inverted index of test items; impacts are BM25 scores as shares of the item's own, kept by blocks with their maxima.

    Terms are weighed by `statistics`, which are those of all items, whether or not all are in this index.
    """

    def __init__(self, rows: list[tuple[object, str | None]], statistics: Statistics | None = None) -> None:
        hasher = WordHasher()
        statistics = statistics or Statistics.of([text for _, text in rows])
        self.items: list[Item] = []
        for item_id, text in rows:
            question, answer = split_item(text or "")
            words, _ = hasher([text])
            if len(words):
                self.items.append(Item(item_id, hasher([question])[0], hasher([answer])[0], words))
        n = len(self.items)
        self.longest = max((len(x.words) for x in self.items), default=0)
        counts = [np.unique(x.words, return_counts=True) for x in self.items]
        mean = statistics.mean
        self.terms = np.unique(np.concatenate([c[0] for c in counts])) if n else np.empty(0, np.uint64)
        frequency = statistics.frequency[np.searchsorted(statistics.terms, self.terms)] if n else np.empty(0, np.int64)
        idf = np.log1p((statistics.n - frequency + 0.5) / (frequency + 0.5))
        flat: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, (terms, tf) in enumerate(counts):
            at = np.searchsorted(self.terms, terms)
            raw = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(self.items[i].words) / mean))
            flat.append((at, np.full(len(at), i), raw / raw.sum()))
        term = np.concatenate([x[0] for x in flat]) if n else np.empty(0, np.int64)
        order = np.argsort(term, kind="stable")
        self.posting_item = np.concatenate([x[1] for x in flat])[order] if n else np.empty(0, np.int64)
        self.posting_impact = np.concatenate([x[2] for x in flat])[order] if n else np.empty(0)
        self.posting_from = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.term_max = np.maximum.reduceat(self.posting_impact, self.posting_from[:-1]) if n else np.empty(0)
        self._choose_screen(flat)

    def _choose_screen(self, flat: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """For each item the terms that a passage must hit: the others score at most REST together. Rare and weighty terms first."""
        screen_term, screen_item, screen_impact, rest = [], [], [], []
        for i, (at, _, impact) in enumerate(flat):
            spread = np.diff(self.posting_from)[at]
            order = np.lexsort((-impact, spread))
            left = 1.0 - np.cumsum(impact[order])
            keep = order[: int(np.searchsorted(-left, -REST)) + 1]
            screen_term.append(at[keep])
            screen_item.append(np.full(len(keep), i))
            screen_impact.append(impact[keep])
            rest.append(max(0.0, 1.0 - float(impact[keep].sum())))
        term = np.concatenate(screen_term) if flat else np.empty(0, np.int64)
        order = np.argsort(term, kind="stable")
        self.screen_item = np.concatenate(screen_item)[order] if flat else np.empty(0, np.int64)
        self.screen_impact = np.concatenate(screen_impact)[order] if flat else np.empty(0)
        self.screen_from = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.rest = np.array(rest)

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """The number of each word's term, or -1."""
        if not len(self.terms):
            return np.full(len(words), -1)
        if not hasattr(self, "_slots"):
            self._slots = np.zeros(1 << 20, bool)
            self._slots[(self.terms >> np.uint64(44)).astype(np.int64)] = True
        out = np.full(len(words), -1, np.int64)
        maybe = np.flatnonzero(self._slots[(words >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, words[maybe]), len(self.terms) - 1)
        hit = self.terms[at] == words[maybe]
        out[maybe[hit]] = at[hit]
        return out

    def windows_above(self, terms: np.ndarray, begins: np.ndarray, threshold: float) -> np.ndarray:
        """First bound of the search, for all passages at once: numbers of the windows in which some item may reach `threshold`.

        Window j of the chunk has the words of strides j and j + 1 (see passages()); `begins` holds the
        stride of each word. A window's bound for an item is what it hits of the item's screen terms, plus
        all of the others.
        """
        at = np.flatnonzero(terms >= 0)
        n = np.diff(self.screen_from)[terms[at]]
        at, n = at[n > 0], n[n > 0]
        if not len(at):
            return np.empty(0, np.int64)
        posting = np.repeat(self.screen_from[terms[at]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        stride = np.repeat(begins[at], n)
        item, impact = self.screen_item[posting], self.screen_impact[posting]
        key, inverse = np.unique(np.concatenate([stride, stride - 1]) * len(self.items) + np.concatenate([item, item]), return_inverse=True)
        bound = np.bincount(inverse, np.concatenate([impact, impact])) + self.rest[key % len(self.items)]
        return np.unique(key[bound >= threshold - 1e-9] // len(self.items))

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items that score `threshold` or more for the query terms: block-max WAND.

        Lists are kept by their current item. The pivot is the first list up to which the lists' maxima reach
        the threshold; no item before its own can. If the maxima of the blocks that hold the pivot item fall
        short, all lists up to the pivot skip to the end of the nearest block; else the item is scored.
        """
        lists = [[int(self.posting_from[t]), int(self.posting_from[t]), int(self.posting_from[t + 1]), float(self.term_max[t])] for t in np.unique(terms[terms >= 0])]
        item, impact = self.posting_item, self.posting_impact
        threshold -= 1e-9
        found: list[tuple[int, float]] = []
        lists = [x for x in lists if x[0] < x[2]]
        while lists:
            lists.sort(key=lambda x: item[x[0]])
            total, pivot = 0.0, -1
            for j, x in enumerate(lists):
                total += x[3]
                if total >= threshold:
                    pivot = j
                    break
            if pivot < 0:
                break
            target = int(item[lists[pivot][0]])
            while pivot + 1 < len(lists) and item[lists[pivot + 1][0]] == target:
                pivot += 1
            bound, next_item = 0.0, len(self.items)
            for x in lists[: pivot + 1]:
                at = x[0] + int(np.searchsorted(item[x[0] : x[2]], target))
                if at < x[2]:
                    first = x[1] + (at - x[1]) // POSTING_BLOCK * POSTING_BLOCK
                    last = min(first + POSTING_BLOCK, x[2])
                    bound += float(impact[first:last].max())
                    next_item = min(next_item, int(item[last - 1]) + 1)
            if bound >= threshold:
                score = 0.0
                for x in lists[: pivot + 1]:
                    x[0] += int(np.searchsorted(item[x[0] : x[2]], target))
                    if x[0] < x[2] and item[x[0]] == target:
                        score += float(impact[x[0]])
                        x[0] += 1
                if score >= threshold:
                    found.append((target, score))
            else:
                if pivot + 1 < len(lists):
                    next_item = min(next_item, int(item[lists[pivot + 1][0]]))
                next_item = max(next_item, target + 1)
                for x in lists[: pivot + 1]:
                    x[0] += int(np.searchsorted(item[x[0] : x[2]], next_item))
            lists = [x for x in lists if x[0] < x[2]]
        return found


def overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of the distinct runs of SHINGLE words of `part` (of all its words, if fewer) that `passage` has; 1 if `part` is empty."""
    if not len(part):
        return 1.0
    k = min(SHINGLE, len(part))
    if len(passage) < k:
        return 0.0
    return float(np.isin(np.unique(shingle_hashes(part, k)), shingle_hashes(passage, k)).mean())


def nearby(part: np.ndarray, passage: np.ndarray) -> float:
    """Largest share of the distinct words of `part` that stand together in `passage`, in a stretch two words longer than `part`."""
    if not len(part):
        return 1.0
    words = np.unique(part)
    width = min(len(part) + 2, len(passage))
    if not width:
        return 0.0
    together = np.zeros(len(passage) - width + 1, np.int64)
    for word in words:
        at = np.concatenate([[0], np.cumsum(passage == word)])
        together += at[width:] > at[:-width]
    return float(together.max() / len(words))


def present(item: Item, passage: np.ndarray, question: float, answer: float, least: float) -> bool:
    """Whether the passage holds the item: both parts by their runs, or nearly all runs of the whole and both parts by runs or words."""
    if question >= least and answer >= least:
        return True
    if overlap(item.words, passage) < WHOLE_OVERLAP:
        return False
    return all(share >= least or nearby(part, passage) >= least for part, share in ((item.question, question), (item.answer, answer)))


def hits(index: ItemIndex, words: np.ndarray, bounds: np.ndarray, threshold: float = THRESHOLD, least: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap) of the verified items of each text; bounds as WordHasher gives them.

    A text's passages are windows of twice the words of the index's longest item, a longest item apart, so that
    any item that is copied into a text lies whole in one of them.
    """
    stride = max(index.longest, SHINGLE)
    sizes = np.diff(bounds)
    strides = -(-sizes // stride) + 1  # one stays empty, so that no window reaches into the next text
    first = np.cumsum(strides) - strides + 1
    offset = np.arange(len(words)) - np.repeat(bounds[:-1], sizes)
    terms = index.lookup(words)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for window in index.windows_above(terms, np.repeat(first, sizes) + offset // stride, threshold):
        text = int(np.searchsorted(first - 1, window, "right")) - 1
        begin = int(bounds[text]) + int(window - first[text]) * stride
        begin, end = max(begin, int(bounds[text])), min(int(bounds[text + 1]), begin + 2 * stride)
        for i, score in index.search(terms[begin:end], threshold):
            q, a = (overlap(part, words[begin:end]) for part in (index.items[i].question, index.items[i].answer))
            if present(index.items[i], words[begin:end], q, a, least):
                best[text, i] = max(best.get((text, i), (0.0, 0.0, 0.0)), (score, q, a))
    return [(t, i, *x) for (t, i), x in sorted(best.items())]


#: Items whose words are within this factor of each other share an index, so that one long item does not widen the windows of the short ones.
LENGTH_FACTOR = 4


def length_class(text: str) -> int:
    """The class of lengths of an item, by its words: 1 to 63, 64 to 255, 256 to 1,023, and so on."""
    n, k = len(normal_words(text)), 0
    while n >= 64 * LENGTH_FACTOR**k:
        k += 1
    return k


def index_shards(items: DataFrame, id_col: str, text_col: str, shard_bytes: int = SHARD_BYTES) -> Iterator[list[ItemIndex]]:
    """The indexes of all items, in shards of bounded size, each item once; the rows come to the driver a partition at a time.

    A shard has an index for each class of lengths. The statistics that BM25 weighs terms by are those of all
    items. They are counted in Spark, and a shard asks for its own terms, so how items are cut into shards
    changes no score.
    """
    slim = items.select(id_col, F.col(text_col).cast("string").alias("text")).where(F.col(text_col).isNotNull())
    total = slim.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    counted: tuple[int, float, DataFrame] | None = None
    if total > shard_bytes:
        def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher()
            for b in batches:
                for text in b.column(0).to_pylist():
                    words, _ = hasher([text])
                    distinct = np.unique(words)
                    sizes = np.zeros(len(distinct), np.int64)
                    sizes[:1] = len(words)  # once for each item
                    yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(sizes)], ["term", "size"])

        table = cut_lineage(slim.select("text").mapInArrow(terms, "term long, size long").groupBy("term").agg(F.count("*").alias("frequency"), F.sum("size").alias("size"), F.count_if(F.col("size") > 0).alias("items")))
        size, n = (int(x or 0) for x in table.agg(F.sum("size"), F.sum("items")).first())
        counted = n, size / max(n, 1), table

    def made(rows: list[tuple[object, str]]) -> list[ItemIndex]:
        statistics = Statistics.of([text for _, text in rows])
        if counted is not None:
            own = items.sparkSession.createDataFrame([(int(t),) for t in statistics.terms.view(np.int64)], "term long")
            found = {r["term"]: r["frequency"] for r in counted[2].join(F.broadcast(own), "term").select("term", "frequency").collect()}  # as many as the shard has terms
            frequency = np.array([found[int(t)] for t in statistics.terms.view(np.int64)], np.int64)
            statistics = Statistics(counted[0], counted[1], statistics.terms, frequency)
        by_class: dict[int, list[tuple[object, str]]] = {}
        for row in rows:
            by_class.setdefault(length_class(row[1]), []).append(row)
        return [ItemIndex(by_class[k], statistics) for k in sorted(by_class)]

    rows: list[tuple[object, str]] = []
    held = 0
    for item_id, text in slim.orderBy(id_col, "text").toLocalIterator():
        if rows and held + len(text) + 64 > shard_bytes:
            yield made(rows)
            rows, held = [], 0
        rows.append((item_id, text))
        held += len(text) + 64
    if rows:
        yield made(rows)


def _results(indexes: list[ItemIndex], hasher: WordHasher, texts: list[str | None]) -> Iterator[tuple[int, object, float, float, float]]:
    """(text, item's id, score, question overlap, answer overlap) of what is found in the texts."""
    for begin, end in text_chunks(texts):
        words, bounds = hasher(texts[begin:end])
        for index in indexes:
            for t, i, *rest in hits(index, words, bounds):
                yield (begin + t, index.items[i].item_id, *rest)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row (id_col, item_id, score, question_overlap, answer_overlap) for each document and test item found in it.

    The best passage of the document counts; its score is a share of the item's own. Null and empty texts
    hold no item; null and wordless items are in no text; repeated documents each have their rows, repeated
    items likewise; an empty table on either side gives an empty result. Other columns are not read. Texts
    of any length are searched whole.

    Nothing is shuffled: the items go to every task, at most `shard_bytes` of them at once; a larger
    benchmark takes as many passes over the documents as it has shards, to the same result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_field = to_arrow_type(items.schema[item_id_col].dataType)
    item_type = items.schema[item_id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {id_type}, item_id {item_type}, score double, question_overlap double, answer_overlap double"
    parts: list[DataFrame] = []
    for shard in index_shards(items, item_id_col, item_text_col, shard_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            indexes, hasher = shared.value, WordHasher()
            for b in batches:
                found = list(_results(indexes, hasher, b.column(1).to_pylist()))
                ids = b.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                names = [f[1] for f in found]
                numbers = [pa.array([f[k] for f in found], pa.float64()) for k in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(names, item_field), *numbers], [id_col, "item_id", "score", "question_overlap", "answer_overlap"])

        parts.append(rows.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of `docs`, all columns as they are, in whose text contaminated() finds no item.

    Rows with null, empty and wordless texts stay, as do all rows where there are no items; repeated rows stay
    or go together; an empty table stays empty; the columns are taken by their places, so extra ones of any
    name pass through.
    """
    at = docs.columns.index(text_col)
    for shard in index_shards(items, item_id_col, item_text_col, shard_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            indexes, hasher = shared.value, WordHasher()
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[f[0] for f in _results(indexes, hasher, b.column(at).to_pylist())]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
