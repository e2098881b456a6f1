"""Language-model scoring: prediction by partial matching over a byte-context trie, with unigram base scores."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage, text_chunks

#: Bytes of context. A gram is a context and the byte that follows it, in one number.
ORDER = 4
#: The end of a text; also what stands before its begin. It never occurs in UTF-8.
END = 255
SYMBOLS = 256
#: Text that one group of documents holds, about, and model that is sent to every task, at most.
BLOCK_BYTES, BROADCAST_BYTES = 12 << 20, 96 << 20
#: Copies of one row that go to one block at most.
BLOCK_COPIES = 20_000


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower()


def tokens(text: str | None) -> list[bytes]:
    """The words of lowered(), without the end: what stands between spaces, tabs, line and page breaks."""
    return lowered(text).split()


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(grams of all bytes and ends in order, how many each text has)."""
    parts = [lowered(t) for t in texts]
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    pad = bytes([END]) * ORDER
    raw = np.frombuffer(b"".join(x for p in parts for x in (pad, p, pad[:1])), np.uint8)
    n = len(raw) - ORDER
    if n <= 0:
        return np.empty(0, np.int64), sizes
    code = np.zeros(n, np.int64)
    for j in range(ORDER + 1):
        code = (code << 8) | raw[j : j + n]
    # A gram that ends in the padding of the next text is none.
    ends = np.cumsum(sizes + ORDER)
    keep = np.ones(n, bool)
    for j in range(ORDER):
        at = ends[:-1] - ORDER + j
        keep[at[(at >= 0) & (at < n)]] = False
    return code[keep], sizes


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sums of their values, where each key's sum is)."""
    found, inverse = np.unique(keys, return_inverse=True)
    return found, np.bincount(inverse, values, len(found)), inverse


class Shallow:
    """Contexts of no byte and of one byte: two dense tables, whatever the corpus."""

    def __init__(self, pairs: np.ndarray) -> None:
        """pairs[a, s]: how often s follows a."""
        self.c1, self.c0 = pairs.astype(np.float64), pairs.sum(0).astype(np.float64)
        self.t1, self.d1 = self.c1.sum(1), (pairs > 0).sum(1)
        self.t0, self.d0 = float(self.c0.sum()), int((pairs.sum(0) > 0).sum())
        self.e1 = ((pairs > 0) * self.c0[None, :]).sum(1)  # of what a context of one byte has seen, the counts without context

    def root(self, symbols: np.ndarray, excluded_total: np.ndarray, excluded_kinds: np.ndarray) -> np.ndarray:
        """log2 of the chances of symbols, given that those excluded are none of them."""
        t, d = self.t0 - excluded_total, self.d0 - excluded_kinds
        c = self.c0[symbols]
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log2((2 * c - 1) / (2 * t))
            novel = np.where(d > 0, np.log2(d / (2 * t)), 0.0) - np.log2(max(SYMBOLS - self.d0, 1))
        return np.where(c > 0, seen, novel)


def trie_scores(codes: np.ndarray, counts: np.ndarray, shallow: Shallow) -> np.ndarray:
    """log2 of the chance of each gram's byte after its context; `codes` are distinct and hold all grams with their last contexts.

    A context predicts a byte it has seen c times among t bytes of d kinds with (2c - 1) / 2t, and escapes to
    the next shorter one with d / 2t (Howard's estimation). Whatever the longer context has seen is excluded
    there; as it has been seen there too, what is left of the shorter context's t and d follows from sums
    over the longer one. Contexts never seen are passed by at no cost.
    """
    n = len(codes)
    out, open_ = np.zeros(n), np.ones(n, bool)
    gone_total, gone_kinds = np.zeros(n), np.zeros(n)  # what is excluded at the order in hand
    levels = []
    for order in range(ORDER, 1, -1):
        keys, c, of = _sums(codes & ((1 << 8 * (order + 1)) - 1), counts.astype(np.float64))
        levels.append((keys, c, of))
    for i, order in enumerate(range(ORDER, 0, -1)):
        if order > 1:
            keys, c, of = levels[i]
            contexts, total, at = _sums(keys >> 8, c)
            kinds = np.bincount(at, c > 0, len(contexts))
            shorter = shallow.c1[(keys >> 8) & 255, keys & 255] if order == 2 else levels[i + 1][1][np.searchsorted(levels[i + 1][0], keys & ((1 << 8 * order) - 1))]
            next_total = np.bincount(at, shorter * (c > 0), len(contexts))[at][of]
            c, total, kinds = c[of], total[at][of], kinds[at][of]
        else:
            context, symbol = (codes >> 8) & 255, codes & 255
            c, total, kinds = shallow.c1[context, symbol], shallow.t1[context], shallow.d1[context]
            next_total = shallow.e1[context]
        t, d = total - gone_total, kinds - gone_kinds
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = open_ & (c > 0)
            out[hit] += np.log2((2 * c[hit] - 1) / (2 * t[hit]))
            open_ &= c == 0
            escape = open_ & (d > 0)
            out[escape] += np.log2(d[escape] / (2 * t[escape]))
        # What this context has seen is out at the next; a context never seen has seen nothing.
        gone_total, gone_kinds = next_total, kinds.astype(np.float64)
    if open_.any():
        out[open_] += shallow.root(codes[open_] & 255, gone_total[open_], gone_kinds[open_])
    return out


class GramTable:
    """log2 chances by gram, looked up through slots; the few grams that share a slot are searched."""

    def __init__(self, codes: np.ndarray, chances: np.ndarray) -> None:
        order = np.argsort(codes)
        self.codes, self.chances = codes[order], chances[order]
        self.bits = max(8, int(len(codes) * 8).bit_length())
        self.slot = np.zeros(1 << self.bits, np.int32)
        self.slot[self._at(self.codes)] = np.arange(len(codes), dtype=np.int32)

    def _at(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        at = self.slot[self._at(codes)].astype(np.int64)
        wrong = np.flatnonzero(self.codes[at] != codes)
        at[wrong] = np.searchsorted(self.codes, codes[wrong])
        if len(wrong) and (self.codes[np.minimum(at[wrong], len(self.codes) - 1)] != codes[wrong]).any():
            raise ValueError("a gram is missing from the model")
        return self.chances[at]


_TABLES: dict[str, GramTable] = {}


def _kept_table(mark: str, model: tuple[np.ndarray, np.ndarray]) -> GramTable:
    """The table of the model named `mark`, made once in each Python worker and kept until another is asked for."""
    if mark not in _TABLES:
        _TABLES.clear()
        _TABLES[mark] = GramTable(*model)
    return _TABLES[mark]


def count_grams(docs: DataFrame) -> DataFrame:
    """(gram, n): every gram of `docs` (text, learn), and how often it occurs where `learn` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            texts, learn = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), bool)
            for begin, end in text_chunks(texts):
                codes, sizes = grams(texts[begin:end])
                counted = np.repeat(learn[begin:end], sizes)
                parts = [np.unique(codes[counted], return_counts=True), (np.unique(codes[~counted]), None)]
                keys = np.concatenate([held[0], parts[0][0], parts[1][0]])
                n = np.concatenate([held[1], parts[0][1], np.zeros(len(parts[1][0]), np.int64)])
                found, sums, _ = _sums(keys, n)
                held = found, sums.astype(np.int64)
                if len(found) > 1 << 20:  # bounded; Spark adds up what a task tells in several parts
                    yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["gram", "n"])
                    held = np.empty(0, np.int64), np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["gram", "n"])

    return docs.select("text", "learn").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def build_trie(counted: DataFrame) -> DataFrame:
    """(gram, chance): log2 chances of all grams. The trie is split by the last two bytes of context, below which each part is whole."""
    pairs = np.zeros((256, 256), np.int64)
    for pair, n in counted.groupBy(F.col("gram").bitwiseAND(F.lit(65535)).alias("pair")).agg(F.sum("n")).where("pair is not null").collect():  # 65,536 rows at most
        pairs[pair >> 8, pair & 255] = n
    shared = counted.sparkSession.sparkContext.broadcast(Shallow(pairs))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = pdf["gram"].to_numpy(np.int64)
        return pd.DataFrame({"gram": codes, "chance": trie_scores(codes, pdf["n"].to_numpy(np.int64), shared.value)})

    # Some hundred groups of many contexts; each holds the grams of whole contexts of two bytes.
    part = F.pmod(F.xxhash64(F.shiftright("gram", 8).bitwiseAND(F.lit(65535))), F.lit(512))
    return counted.groupBy(part.alias("part")).applyInPandas(run, "gram long, chance double")


def score_documents(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row (id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`.

    The model learns from the rows where `learn` holds (null: not), and scores all. base_score is the smoothed
    unigram log10 score by whitespace tokens, score the log10 chance that prediction by partial matching gives
    the text's lowered bytes and its end. Null texts count as empty: they have their end. Null ids and
    repeated rows stay, and repeated rows count each time. With nothing to learn from, every byte has the
    chance 1/256. An empty table gives an empty result. Other columns are not read. Texts are whole.

    Counts are summed in the tasks before Spark adds them up. Documents are dealt into blocks of about
    BLOCK_BYTES by a hash of id and text; a block asks for the counts of its own words only, so no task holds
    the vocabulary. A block's documents stream through its task and are not held; copies of one row that are more than
    a block, or than BLOCK_COPIES, are counted first and dealt to several. The grams of a block are looked up in
    the whole model where that is within `broadcast_bytes`, else in what the block asks for, as with words.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    rows = rows.withColumn("same", F.xxhash64("id", "text"))
    # Copies of one row are counted before they are dealt; those that are more than a block go to several.
    sizes = cut_lineage(rows.groupBy("same").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count_if("learn").alias("learnt")))
    size, n_docs = (int(x or 0) for x in sizes.agg(F.sum("bytes"), F.sum("learnt")).first())
    blocks = max(1, -(-size // BLOCK_BYTES))
    pieces = F.greatest(F.ceil(F.col("bytes") / BLOCK_BYTES), F.ceil(F.col("n") / BLOCK_COPIES)).cast("int")
    hot = cut_lineage(sizes.where((F.col("n") > 1) & (pieces > 1)).select("same", pieces.alias("pieces")))
    many = not hot.isEmpty()
    n_hot = (hot.agg(F.sum("pieces")).first()[0] or 0) if many else 0
    blocks = max(blocks, n_hot)  # copies of short rows, too, find blocks to be dealt to
    place = lambda piece: F.pmod(F.xxhash64("same") + piece, F.lit(blocks)).cast("int")
    if many:
        rows = rows.join(hot, "same", "left").withColumn("block", place(F.coalesce(F.pmod(F.monotonically_increasing_id(), "pieces"), F.lit(0))))
        # Each block that copies may come to asks for their words, by a row that is not counted.
        asking = rows.where(F.col("pieces").isNotNull()).groupBy("same", "pieces").agg(F.first("text").alias("text"))
        asking = asking.select(F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "same", "text").select(place(F.col("piece")).alias("block"), "text", F.lit(False).alias("learn"))
    else:
        rows, asking = rows.withColumn("block", place(F.lit(0))), None
    model = cut_lineage(build_trie(cut_lineage(count_grams(rows))))
    n_grams = model.count()
    small = n_grams * 12 <= broadcast_bytes

    def told_by(block: int, n: Counter[bytes], only: set[bytes], codes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = [*n, *(w for w in only if w not in n)]
        counts = [*n.values(), *[0] * (len(keys) - len(n))]
        kinds = [False] * len(keys)
        if not small:
            asked = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.int64)
            keys += [int(c).to_bytes(ORDER + 1, "big") for c in asked]
            counts += [0] * len(asked)
            kinds += [True] * len(asked)
        for at in range(0, len(keys), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(keys[part]), pa.int32()), pa.array(keys[part], pa.binary()), pa.array(counts[part], pa.int64()), pa.array(kinds[part], pa.bool_())], ["block", "key", "n", "is_gram"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each block asks for, and what it adds; a block's rows stand together and are not held."""
        now: int | None = None
        n: Counter[bytes] = Counter()
        only: set[bytes] = set()
        codes: list[np.ndarray] = []
        for b in batches:
            for block, text, learnt in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if block != now:
                    if now is not None:
                        yield from told_by(now, n, only, codes)
                    now, n, only, codes = block, Counter(), set(), []
                (n if learnt else only).update(tokens(text))
                if not small:
                    codes.append(np.unique(grams([text])[0]))
                    if len(codes) == 64:
                        codes = [np.unique(np.concatenate(codes))]
        if now is not None:
            yield from told_by(now, n, only, codes)

    asks_ = rows.select("block", "text", "learn")
    dealt = (asks_ if asking is None else asks_.unionByName(asking)).repartition("block").sortWithinPartitions("block")
    asked = cut_lineage(dealt.mapInArrow(ask, "block int, key binary, n long, is_gram boolean"))
    # A word has a row for each block that has it. These are summed in the tasks first, and what is summed is
    # written out, so that the join back is one of two plain inputs, which Spark splits where a word is in very many blocks.
    totals = cut_lineage(asked.where(~F.col("is_gram")).groupBy("key").agg(F.sum("n").alias("c")))
    n_all, v_all = (int(x or 0) for x in totals.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first())
    told = asked.where(~F.col("is_gram")).select("block", "key", "is_gram").join(totals.select("key", F.col("c").cast("double").alias("value")), "key").select("block", "key", "is_gram", "value")
    if not small:
        chances = model.select(F.unhex(F.lpad(F.hex("gram"), 2 * (ORDER + 1), "0")).alias("key"), F.col("chance").alias("value"))
        told = told.unionByName(asked.where("is_gram").select("block", "key", "is_gram").join(chances, "key").select("block", "key", "is_gram", "value"))

    train_tokens, kinds = n_all + n_docs, v_all + int(n_docs > 0)
    total_log = math.log10(train_tokens + 0.5 * (kinds + 1))
    shared = None
    if small:
        got = model.toPandas()
        shared = spark.sparkContext.broadcast((got["gram"].to_numpy(np.int64), got["chance"].to_numpy(np.float64)))
    mark = uuid.uuid4().hex
    unit = math.log10(2)

    # The end is a token: it is known if any document is learnt from, once for each of them.
    end_log, end_known = math.log10(n_docs + 0.5), int(n_docs > 0)
    least = math.log10(0.5) + 1e-12

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The scores of the documents of each block; what the block asked for stands before them, the documents are not held."""
        names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        now: int | None = None
        logs: dict[bytes, float] = {}
        codes: list[int] = []
        chances: list[float] = []
        table: GramTable | None = None
        for b in batches:
            blocks, kind = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                if blocks[lo] != now:
                    now, logs, codes, chances, table = int(blocks[lo]), {}, [], [], None
                if kind[lo] == 0:
                    keys, values = part.column(2).to_pylist(), part.column(3).to_numpy(zero_copy_only=False)
                    logs.update(zip(keys, np.log10(values + 0.5).tolist(), strict=True))
                elif kind[lo] == 1:
                    codes += [int.from_bytes(k, "big") for k in part.column(2).to_pylist()]
                    chances += part.column(3).to_pylist()
                else:
                    if table is None:
                        table = _kept_table(mark, shared.value) if small else GramTable(np.array(codes, np.int64), np.array(chances, np.float64))
                    texts = part.column(5).to_pylist()
                    n_tokens, n_known, base, score = [], [], [], []
                    for text in texts:
                        found = [logs[w] for w in tokens(text)]
                        n_tokens.append(len(found) + 1)
                        n_known.append(sum(x > least for x in found) + end_known)
                        base.append(math.fsum(found) + end_log - (len(found) + 1) * total_log)
                    for begin, end in text_chunks(texts):
                        c, sizes = grams(texts[begin:end])
                        sums = np.concatenate([[0.0], np.cumsum(table(c))])
                        score += (np.diff(sums[np.concatenate([[0], np.cumsum(sizes)])]) * unit).tolist()
                    n = len(texts)
                    held = [not x for x in part.column(6).to_pylist()]
                    columns = [part.column(4), pa.array(held, pa.bool_()), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array([train_tokens] * n, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, names)

    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    books = told.select("block", F.col("is_gram").cast("int").alias("kind"), "key", "value", none(id_type, "id"), none("string", "text"), none("boolean", "learn"))
    asks = rows.select("block", F.lit(2).alias("kind"), none("binary", "key"), none("double", "value"), "id", "text", "learn")
    both = books.unionByName(asks).repartition("block").sortWithinPartitions("block", "kind")
    scored = both.mapInArrow(rate, f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumnRenamed("id", id_col)
