"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import WordHasher, slices, text_chunks

#: Buckets that words are hashed to; the shape of a text has SHAPES more, its bias none (the thresholds are it).
WORD_BUCKETS, SHAPES = 1 << 18, 512
#: Labelled documents that the model is fitted to, at most: those with the least hash of their id. Everything else sees all rows.
SAMPLE_ROWS = 6000
#: Grades: toxic 0, poor 1, good 2.
GRADES = 3
#: A document stays if its chance of the top grade is at least this.
KEEP_TAIL = 0.5

_SIGNS = re.compile(r"[%&$#*|!~^=_<>{}\[\]\\@]")


def _level(share: float, steps: int = 12) -> int:
    """A share in steps that are finer near zero."""
    return min(steps - 1, int(np.sqrt(max(0.0, min(1.0, share))) * steps))


def shape_features(text: str, words: np.ndarray) -> list[int]:
    """Numbers below SHAPES: levels of what words do not show, such as signs, capitals, digits and repetition."""
    n = max(1, len(text))
    lines = text.split("\n")
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    capitals = int(((raw >= 65) & (raw <= 90)).sum())
    small = int(((raw >= 97) & (raw <= 122)).sum())
    levels = (
        _level(len(_SIGNS.findall(text)) / n),
        _level(capitals / max(1, capitals + small)),
        _level(int(((raw >= 48) & (raw <= 57)).sum()) / n),
        _level(len(np.unique(words)) / max(1, len(words))),
        _level(len(set(lines)) / len(lines)),
        _level(min(1.0, len(words) / n)),
        _level(float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0),
        min(11, len(words).bit_length()),
    )
    return [16 * i + level for i, level in enumerate(levels)]


def features(texts: list[str | None], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """(features of all texts, where each text's begin): the distinct buckets of its words, then its shape."""
    words, bounds = hasher(texts)
    n = len(texts)
    text_of = np.repeat(np.arange(n), np.diff(bounds))
    keys = np.unique(text_of * (WORD_BUCKETS + SHAPES) + (words & np.uint64(WORD_BUCKETS - 1)).astype(np.int64))
    shapes = [i * (WORD_BUCKETS + SHAPES) + WORD_BUCKETS + s for i, t in enumerate(texts) for s in shape_features(t or "", words[bounds[i] : bounds[i + 1]])]
    keys = np.sort(np.concatenate([keys, np.array(shapes, np.int64)]))
    return keys % (WORD_BUCKETS + SHAPES), np.searchsorted(keys, np.arange(n + 1) * (WORD_BUCKETS + SHAPES))


@dataclass
class OrdinalModel:
    """P(grade <= k | x) = sigmoid(thresholds[k] - weights . x), with rising thresholds and the same weights for each k."""

    weights: np.ndarray
    thresholds: np.ndarray

    def latent(self, found: np.ndarray, begins: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[found], dtype=np.float64)])
        return sums[begins[1:]] - sums[begins[:-1]]

    def tails(self, latent: np.ndarray) -> np.ndarray:
        """Columns P(grade >= 1), P(grade >= 2), ..."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - latent[:, None], -500, 500)))


def fit(found: np.ndarray, begins: np.ndarray, grades: np.ndarray, ridge: float = 1.0, steps: int = 250, least: int = 3) -> OrdinalModel:
    """Fits weights of the features that `least` samples have, and thresholds, by Adam on the penalised likelihood.

    With no samples, or samples of one grade, the model rates every text with the top grade.
    """
    size, cuts = WORD_BUCKETS + SHAPES, GRADES - 1
    weights = np.zeros(size, np.float32)
    n = len(grades)
    if n == 0 or len(np.unique(grades)) < 2:
        return OrdinalModel(weights, np.full(cuts, -20.0))
    row = np.repeat(np.arange(n), np.diff(begins))
    common = np.bincount(found, minlength=size) >= least
    row, found = row[common[found]], found[common[found]]
    used, col = np.unique(found, return_inverse=True)
    above = (grades[:, None] > np.arange(cuts)[None, :]).astype(np.float64)
    share = np.clip(above.mean(0), 1e-3, 1 - 1e-3)
    # thresholds are theta[0], theta[0] + exp(theta[1]), ...
    start = -np.log(share / (1 - share))
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    x = np.concatenate([np.zeros(len(used)), theta])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, theta = x[: len(used)], x[len(used) :]
        thresholds = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        f = np.bincount(row, w[col], n)
        upper = np.concatenate([np.full((n, 1), 1.0), 1 / (1 + np.exp(np.clip(thresholds[None, :] - f[:, None], -50, 50))), np.zeros((n, 1))], axis=1)
        p = np.maximum(upper[np.arange(n), grades] - upper[np.arange(n), grades + 1], 1e-9)
        slope = upper * (1 - upper)
        d_f = -(slope[np.arange(n), grades] - slope[np.arange(n), grades + 1]) / p
        d_t = np.zeros((n, GRADES + 1))
        d_t[np.arange(n), grades] += slope[np.arange(n), grades] / p
        d_t[np.arange(n), grades + 1] -= slope[np.arange(n), grades + 1] / p
        d_cut = d_t[:, 1:-1].sum(0)
        back = np.cumsum(d_cut[::-1])[::-1]
        g = np.concatenate([np.bincount(col, d_f[row], len(used)) + ridge * w, back * np.concatenate([[1.0], np.exp(theta[1:])])])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        rate = 0.1 * (1 - step / (steps + 1))
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights[used] = x[: len(used)]
    theta = x[len(used) :]
    return OrdinalModel(weights, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])])))


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, grade): toxic 0, poor 1, good 2; of several labels of a document the worst. Rows with nulls say nothing."""
    q, t = F.col("quality"), F.col("toxic")
    known = labels.where(F.col(id_col).isNotNull() & q.isNotNull() & t.isNotNull())
    return known.groupBy(id_col).agg(F.min(F.when(t > 0, 0).when(q > 0, 2).otherwise(1)).cast("int").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """The model of the `sample_rows` ratings (id_col, grade) whose ids have the least hashes, and of their documents.

    What comes to the driver is bounded by the sample: the distinct features of its documents. Only ids and
    texts of `docs` are read; ratings without a document, and null texts, are left out. Of several documents of
    one id the least text counts, so an id that very many rows have brings one row.
    """
    sample = ratings.orderBy(F.xxhash64(F.col(id_col)), F.col(id_col)).limit(sample_rows).select(F.col(id_col).alias("id"), "grade")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            out: list[bytes] = []
            for begin, end in text_chunks(texts):
                found, at = features(texts[begin:end], hasher)
                found = found.astype("<i4")
                out += [found[at[i] : at[i + 1]].tobytes() for i in range(end - begin)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["grade", "found"])

    # sample is bounded by sample_rows, so it may go to every task
    one = rows.join(F.broadcast(sample), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))
    picked = one.select("grade", "text").mapInArrow(run, "grade int, found binary")
    got = sorted((int(r[0]), bytes(r[1])) for r in picked.collect())
    grades = np.array([g for g, _ in got], np.int64)
    arrays = [np.frombuffer(f, "<i4").astype(np.int64) for _, f in got]
    begins = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int64)
    return fit(np.concatenate(arrays) if arrays else np.empty(0, np.int64), begins, grades)


def _rated(model: OrdinalModel, hasher: WordHasher, texts: list[str | None]) -> np.ndarray:
    parts = [model.tails(model.latent(*features(texts[b:e], hasher))) for b, e in text_chunks(texts)]
    return np.concatenate(parts) if parts else np.empty((0, GRADES - 1))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id_col, expected_grade, p_fair, p_good) for each row of `docs`: the chances of grade 1 or more, and of grade 2.

    Null texts rate like empty ones; null ids and repeated rows stay; an empty table gives an empty result;
    other columns are not read. Texts count whole. The model has a fixed size; nothing is shuffled.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches):
            tails = _rated(shared.value, hasher, b.column(1).to_pylist()).round(9)
            columns = [pa.array(x, pa.float64()) for x in (tails.sum(1), tails[:, 0], tails[:, -1])]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], [id_col, "expected_grade", "p_fair", "p_good"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {id_type}, expected_grade double, p_fair double, p_good double")


def select(docs: DataFrame, model: OrdinalModel, text_col: str = "text", keep_tail: float = KEEP_TAIL) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose chance of the top grade is at least `keep_tail`.

    Null texts rate like empty ones; repeated rows stay or go together; a chance of just `keep_tail` stays; an
    empty table stays empty; the columns are taken by their places, so extra ones of any name pass through.
    """
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches):
            yield b.filter(pa.array(_rated(shared.value, hasher, b.column(at).to_pylist())[:, -1] >= keep_tail))

    return docs.mapInArrow(run, docs.schema)
