"""Near-duplicate detection by Order MinHash, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import WordHasher, cut_lineage, mix64, shingle_hashes, slices, text_chunks
from scriptoria.llm.graph import components

#: Words of a shingle, and least similarity of near duplicates.
SHINGLE, SIMILARITY = 5, 0.8
#: Sketches of a text, and minima that each keeps in text order.
SKETCHES, MINIMA = 16, 3
#: Members and bytes of shingles of a bucket that are held together; a larger bucket is compared block by block.
BLOCK_MEMBERS, BLOCK_BYTES = 4096, 32 << 20
#: Members of a mixed bucket above which they meet by their rarest shingles instead, which loses no pair.
HOT_MEMBERS = 4096
#: The bound of partners' sizes where any size will do.
ANY_SIZE = (1 << 31) - 1
#: Counters that tell how frequent shingles are, as a power of two, and the highest ones that are kept: a few hundred KB, whatever the input.
SLOT_BITS, FREQUENT_SLOTS = 18, 1 << 14
_SEEDS = mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def labelled(found: np.ndarray) -> np.ndarray:
    """Hashes of shingles with their occurrence numbers, in the order given, so that no two are the same."""
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))
    times = np.empty(len(found), np.uint64)
    times[order] = (np.arange(len(ranked)) - begin).astype(np.uint64)
    return mix64(found + times * np.uint64(0xA0761D6478BD642F))


def labelled_shingles(words: np.ndarray) -> np.ndarray:
    """labelled() shingles of a text, in text order.

    A text of fewer than SHINGLE words has one shingle, the whole; one without words has none.
    """
    return labelled(shingle_hashes(words, SHINGLE))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCHES numbers, each of the MINIMA shingles that come first under one hash, taken in text order.

    Two texts agree in one with the chance that their least shingles are the same and in the same order: it
    falls with edits, and with moved parts.
    """
    if not len(shingles):
        return np.empty(0, np.int64)
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 20) // len(shingles))
    for begin in range(0, SKETCHES, step):
        ranks = mix64(shingles[None, :] ^ _SEEDS[begin : begin + step, None])
        if len(shingles) > MINIMA:
            at = np.sort(np.argpartition(ranks, MINIMA - 1, axis=1)[:, :MINIMA], axis=1)
        else:
            at = np.broadcast_to(np.arange(len(shingles)), (len(ranks), len(shingles)))
        value = np.zeros(len(ranks), np.uint64)
        for j in range(at.shape[1]):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + shingles[at[:, j]] + np.uint64(1))
        out[begin : begin + step] = value
    return out.view(np.int64)


#: Masks of repeated values that one alignment keeps, and half the width of the band that is tried first.
_MASKS, _BAND = 256, 128


def _common(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence of which no pair is further than `band` off the diagonal.

    Bit-parallel: a column's row differences are the bits of one number. Only those within the band are kept:
    the number slides along with the column, and what leaves it below is counted.
    """
    where = {value: i for i, value in enumerate(x.tolist())}
    repeated: dict[int, np.ndarray] = {}
    if len(where) < len(x):
        values, times = np.unique(x, return_counts=True)
        order = np.argsort(x, kind="stable")
        ends = np.cumsum(times)
        repeated = {int(values[k]): order[ends[k] - times[k] : ends[k]] for k in np.flatnonzero(times > 1)}
    masks: dict[int, int] = {}
    size, low, total = len(x), 0, 0
    row = full = (1 << min(size, band + 1)) - 1  # rows 0 to band, for the first column
    for j, value in enumerate(y.tolist()):
        if j:
            if j > band:  # the lowest row leaves
                total += not row & 1
                row >>= 1
                full >>= 1
                low += 1
            if j + band < size:  # a row comes in
                top = 1 << (j + band - low)
                row |= top
                full |= top
            if low >= size:
                break
        i = where.get(value)
        if i is None:
            continue
        if value in repeated:
            mask = masks.get(value)
            if mask is None:
                bits = np.zeros(size, bool)
                bits[repeated[value]] = True
                mask = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
                if len(masks) < _MASKS:
                    masks[value] = mask
            u = row & (mask >> low)
        elif abs(i - j) <= band:
            u = row & (1 << (i - low))
        else:
            continue
        row = ((row + u) | (row - u)) & full
    return total + full.bit_count() - row.bit_count()


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two sequences of numbers: those aligned in order, over all there are; 0 if below `least`.

    The alignment is the longest common subsequence within a band; a number may stand in a sequence more than
    once. If the similarity is `least`, all that is not aligned is at most (1 - least) of the union, which is at
    most the shorter's length over `least`: no aligned pair is further off the diagonal, so the band loses
    nothing. Narrower bands are tried first; what they find is enough where it reaches `least`, so near copies
    take time in proportion to their length. Common beginnings and ends are cut off first.
    """
    n, m = len(a), len(b)
    if not n and not m:
        return 1.0
    short, long = min(n, m), max(n, m)
    if short < least * long:
        return 0.0
    need = least * (n + m) / (1 + least) - 1e-9  # common ones at a similarity of `least`
    same = a[:short] == b[:short]
    head = short if same.all() else int(np.argmin(same))
    rest = short - head
    tail_same = a[n - rest :][::-1] == b[m - rest :][::-1]
    tail = rest if tail_same.all() else int(np.argmin(tail_same))
    common = head + tail
    x, y = a[head : n - tail], b[head : m - tail]
    if len(x) and len(y):
        if common + min(np.isin(x, y).sum(), np.isin(y, x).sum()) < need:
            return 0.0
        band = int((1 - least) / least * short) + 1
        width = min(band, _BAND)
        found = _common(x, y, width)
        while width < band and common + found < need:
            width = min(band, 8 * width)
            found = _common(x, y, width)
        common += found
    similarity = common / (n + m - common)
    return similarity if similarity >= least - 1e-12 else 0.0


def content(text_col: str) -> Column:
    """What tells texts apart, 128 bits; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")))


def _numbers(data: bytes) -> np.ndarray:
    """The shingles of _shingled()."""
    return np.frombuffer(data, np.uint32).astype(np.uint64)


def _shingled(docs: DataFrame) -> DataFrame:
    """(node, shingles) with the shingles, in text order, of each row of `docs` (node, text).

    Of each hash 32 bits are kept, which halves what is dealt out. Two shingles of a pair of texts are taken
    for the same by chance once in 2**32; of n shingles, that adds n / 2**32 to the similarity on average.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            nodes = b.column(0)
            for begin, end in text_chunks(texts):
                words, at = hasher(texts[begin:end])
                made = [(shingle_hashes(words[at[i] : at[i + 1]], SHINGLE) >> np.uint64(32)).astype(np.uint32).tobytes() for i in range(end - begin)]
                yield pa.RecordBatch.from_arrays([nodes.slice(begin, end - begin), pa.array(made, pa.binary())], ["node", "shingles"])

    return docs.select("node", "text").mapInArrow(run, "node binary, shingles binary")


def _sketches(docs: DataFrame) -> DataFrame:
    """(node, bucket) for each distinct text that has words, a row for each of its sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            nodes = b.column(0)
            for begin, end in text_chunks(texts):
                words, at = hasher(texts[begin:end])
                made = [sketch(labelled_shingles(words[at[i] : at[i + 1]])).tolist() for i in range(end - begin)]
                yield pa.RecordBatch.from_arrays([nodes.slice(begin, end - begin), pa.array(made, pa.list_(pa.int64()))], ["node", "sketch"])

    made = docs.select("node", "text").mapInArrow(run, "node binary, sketch array<long>")
    return cut_lineage(made.groupBy("node").agg(F.first("sketch").alias("sketch")).where(F.size("sketch") > 0))


def _verified(pairs: DataFrame, shingled: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts align."""
    # Only the texts that the pairs name are dealt out; where these are few, Spark sends their list to the tasks instead.
    named = cut_lineage(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
    shingled = shingled.join(named, "node", "left_semi")
    first = shingled.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    second = shingled.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            keep = [aligned(_numbers(p), _numbers(q)) > 0 for p, q in zip(x, y, strict=True)]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return cut_lineage(pairs.join(first, "a").join(second, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a binary, b binary"))


def parities(shingles: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of `bits` bits, in 64-bit words, for each sequence of distinct numbers: each number turns over one bit.

    Two rows differ in no more bits than there are numbers that only one of the two sequences has.
    """
    sizes = [len(x) for x in shingles]
    place = np.repeat(np.arange(len(shingles)), sizes) * bits + (np.concatenate(shingles) % np.uint64(bits)).astype(np.int64)
    out = np.zeros(len(shingles) * bits, np.uint8)
    at, times = np.unique(place, return_counts=True)
    out[at] = times % 2
    return np.packbits(out.reshape(len(shingles), bits), axis=1).view(np.uint64)


def joined(roots: np.ndarray, shingles: list[np.ndarray], side: np.ndarray | None = None, most_sizes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Aligned pairs (i, j) that join the components of `roots` as far as any pair of the members does.

    Every pair of two components is aligned or excluded: texts of n and m shingles that align at SIMILARITY
    have at most (n + m) (1 - SIMILARITY) / (1 + SIMILARITY) shingles that the other has not, each counted as
    often as it occurs, and the parities of their labelled shingles differ in no more bits. With `side`, only pairs of two sides are compared;
    with `most_sizes`, only those neither of whose texts has more shingles than the other's number there.
    """
    sizes = np.array([len(x) for x in shingles])
    longest = int(sizes.max())
    room = max(64, (BLOCK_BYTES * 8) // len(shingles))
    bits = 64
    while bits < 4 * longest and 2 * bits <= room:
        bits *= 2
    rows = parities([labelled(x) for x in shingles], bits)
    comp = np.unique(roots, return_inverse=True)[1]
    found: list[tuple[int, int]] = []
    for i in range(len(shingles) - 1):
        other = comp[i + 1 :] != comp[i]
        if side is not None:
            other &= side[i + 1 :] != side[i]
        if most_sizes is not None:
            other &= (sizes[i + 1 :] <= most_sizes[i]) & (most_sizes[i + 1 :] >= sizes[i])
        near = np.flatnonzero(other) + i + 1
        most = (sizes[near] + sizes[i]) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6
        ok = np.abs(sizes[near] - sizes[i]) <= most
        near, most = near[ok], most[ok]
        if not len(near):
            continue
        differ = np.bitwise_count(rows[near] ^ rows[i]).sum(axis=1)
        ok = differ <= most
        near = near[ok][np.argsort(differ[ok], kind="stable")]
        while len(near):
            j, near = int(near[0]), near[1:]
            if aligned(shingles[i], shingles[j]) > 0:
                found.append((i, j))
                comp[comp == comp[j]] = comp[i]
                near = near[comp[near] != comp[i]]
    return found


def _joined_in_buckets(members: DataFrame, shingled: DataFrame) -> DataFrame:
    """Links (a, b) that join what is left apart in the buckets of `members` (bucket, node, root, most): all pairs of each are compared.

    A member is compared with those of `most` shingles at most. Buckets of the same members are compared once. A large bucket is dealt out in blocks, and each pair of
    blocks is a group of its own, so that what a task holds is bounded whatever the bucket's size.
    """
    sizes = shingled.select("node", F.length("shingles").alias("size"))
    marks = (F.bit_xor(F.xxhash64("node", "most", F.lit(1))).alias("x"), F.sum(F.xxhash64("node", "most", F.lit(2)).cast("decimal(38,0)")).alias("y"))
    shapes = members.join(sizes, "node").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *marks)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    kept = cut_lineage(shapes.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"), F.first("bytes").alias("bytes")).select("bucket", blocks.alias("blocks")))
    dealt = members.join(kept, "bucket").withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = cut_lineage(dealt.select("node", "root", "most", "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block"))
    key = ["bucket", "lo", "hi"]
    placed = dealt.join(shingled, "node").select(*key, "block", "node", "root", "most", "shingles").repartition(*key).sortWithinPartitions(*key)

    def compared(group: list[tuple]) -> list[tuple[bytes, bytes]]:
        block, node, root, most, data = zip(*group, strict=True)
        side = np.array(block) if len(set(block)) > 1 else None
        number = {r: k for k, r in enumerate(dict.fromkeys(root))}
        return [(node[i], node[j]) for i, j in joined(np.array([number[r] for r in root]), [_numbers(x) for x in data], side, np.array(most))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []

        def done() -> pa.RecordBatch:
            whole = now[1] == now[2] or len({x[0] for x in group}) == 2
            pairs = compared(group) if whole and len(group) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])

        for b in slices(batches):
            for *at, block, node, root, most, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != now:
                    if group:
                        yield done()
                    now, group = at, []
                group.append((block, node, root, most, data))
        if group:
            yield done()

    return cut_lineage(placed.mapInArrow(run, "a binary, b binary"))


def _rarest(shingled: DataFrame) -> DataFrame:
    """(bucket, node, size, most): a row for each of the rarest labelled shingles of a text of `shingled` (node, shingles), so many that texts at SIMILARITY share one.

    Texts of n and m shingles at SIMILARITY have SIMILARITY * max(n, m) or more in common. In any one order of all shingles, the first
    n - ceil(SIMILARITY * n) + 1 of the one and of the other then hold a common one: no pair is lost, whatever the order. Here those come
    first whose counter is low, which only makes buckets small; what many texts share, such as a header, comes last. The two have
    t = ceil((n + m) * SIMILARITY / (1 + SIMILARITY)) in common, so their first n - t + 1 and m - t + 1 do already: the shingle at place p
    of a text of n (`size`) is asked for partners of t <= n - p only, that is of `most` shingles at most.
    """

    def slot(tokens: np.ndarray) -> np.ndarray:
        return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(1 << SLOT_BITS, np.int64)
        for b in slices(batches):
            for data in b.column(0):
                np.add.at(times, slot(labelled(_numbers(data.as_py()))), 1)
        at = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(times[at])], ["slot", "n"])

    counted = shingled.select("shingles").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    often = np.zeros(1 << SLOT_BITS, np.int64)
    for r in counted.orderBy(F.desc("n"), "slot").limit(FREQUENT_SLOTS).collect():
        often[r["slot"]] = r["n"]
    shared = shingled.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for node, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens = labelled(_numbers(data))
                first = len(tokens) - int(np.ceil(SIMILARITY * len(tokens) - 1e-6)) + 1
                chosen = tokens[np.lexsort((tokens, shared.value[slot(tokens)]))[:first]]
                size = np.full(first, len(tokens), np.int32)
                most = np.floor((size - np.arange(first)) * ((1 + SIMILARITY) / SIMILARITY) - size + 1e-6).astype(np.int32)
                nodes = pa.array([node] * first, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(chosen.view(np.int64)), nodes, pa.array(size), pa.array(most)], ["bucket", "node", "size", "most"])

    return shingled.select("node", "shingles").mapInArrow(run, "bucket long, node binary, size int, most int")


def _rare_buckets(members: DataFrame, shingled: DataFrame) -> DataFrame:
    """(bucket, node, root, most) where all pairs of `members` (node, root) at SIMILARITY and of two roots meet, each within the other's `most`.

    Left out are rows whose bucket has no partner within their bounds: the shorter text of a pair has a `most` of its own size or more.
    What many texts share, such as a header, is a bucket only of texts that are nearly all header, which are at SIMILARITY by that alone.
    """
    rows = cut_lineage(_rarest(cut_lineage(shingled.join(members, "node", "left_semi"))))
    bounds = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("size").alias("shortest"), F.max("most").alias("reach"), F.max(F.col("most") >= F.col("size")).alias("core"))
    bounds = cut_lineage(bounds.where("n > 1 and core").select("bucket", "shortest", "reach"))
    near = rows.join(bounds, "bucket").where("most >= shortest and size <= reach").select("bucket", "node", "most")
    near = cut_lineage(near.join(members, "node").select("bucket", "node", "root", "most"))
    mixed = cut_lineage(near.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket"))
    return near.join(mixed, "bucket", "left_semi").select("bucket", "node", "root", "most")


def _shared_buckets(sketches: DataFrame) -> DataFrame:
    """(bucket, node, n): the buckets of `sketches` (node, sketch) that n > 1 texts share, all of them whatever their size."""
    rows = sketches.select("node", F.posexplode("sketch").alias("i", "s")).select("node", F.xxhash64("i", "s").alias("bucket"))
    sizes = cut_lineage(rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    return cut_lineage(rows.join(sizes, "bucket").select("bucket", "node", "n"))


def links(docs: DataFrame, text_col: str = "text", exact: bool = False, hot_members: int = HOT_MEMBERS) -> tuple[DataFrame, DataFrame]:
    """(links, roots) between distinct texts, as content() tells them apart: (a, b) verified, and (node, root) of their components.

    What is summed up by a key that may be hot is written out before it is joined back: a join of two plain
    inputs is one that Spark splits. Texts that agree in a sketch share a bucket. First each member of a
    bucket is aligned with the most central one, which shares most with others. Where a bucket then still
    holds several components, every pair of members of two components is aligned or excluded by a bound that
    loses none (see joined()). Members of one component are not aligned again: that could join nothing.
    Members of such buckets of more than `hot_members` texts, such as those with one long header, are not compared
    there: all of their pairs at SIMILARITY meet again by their rarest shingles (see _rarest()).
    With `exact`, sketches are not asked: all texts are one bucket, whose blocks are compared pair by pair.
    """
    texts = docs.select(content(text_col).alias("node"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if exact:
        shingled = cut_lineage(_shingled(texts.groupBy("node").agg(F.first("text").alias("text"))).where(F.length("shingles") > 0))
        found = _joined_in_buckets(shingled.select(F.lit(0).cast("long").alias("bucket"), "node", F.col("node").alias("root"), F.lit(ANY_SIZE).alias("most")), shingled)
        return found, cut_lineage(components(found))
    multi = _shared_buckets(_sketches(texts))
    nodes = multi.groupBy("node").agg(F.sum("n").alias("degree"))
    wanted = texts.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    shingled = cut_lineage(_shingled(wanted))
    central = multi.join(nodes, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node")).alias("top"))
    central = cut_lineage(central.select("bucket", F.col("top.node").alias("b")))
    pairs = multi.select("bucket", F.col("node").alias("a")).join(central, "bucket").where("a <> b")
    found = _verified(cut_lineage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), shingled)
    roots = cut_lineage(components(found))
    # A bucket of two is done with: its one pair was aligned.
    labelled = multi.where("n > 2").join(roots, "node", "left").select("bucket", "node", "n", F.coalesce("root", "node").alias("root"))
    mixed = cut_lineage(labelled.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket"))
    apart = cut_lineage(labelled.join(mixed, "bucket", "left_semi"))
    members = apart.where(F.col("n") <= hot_members).select("bucket", "node", "root", F.lit(ANY_SIZE).alias("most"))
    hot = cut_lineage(apart.where(F.col("n") > hot_members).select("node", "root").distinct())
    if hot.take(1):
        members = cut_lineage(members.unionByName(_rare_buckets(hot, shingled)))
    more = _joined_in_buckets(members, shingled)
    if not more.take(1):
        return found, roots
    found = cut_lineage(found.union(more))
    return found, cut_lineage(components(found))


def _rooted(docs: DataFrame, id_col: str, text_col: str, exact: bool = False) -> DataFrame:
    """(node, root, class_id, class_size) of each distinct text."""
    _, roots = links(docs, text_col, exact)
    texts = docs.select(F.col(id_col).alias("id"), content(text_col).alias("node")).groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    rooted = texts.join(roots, "node", "left").select("node", "least", "copies", F.coalesce("root", "node").alias("root"))
    named = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size")))
    return cut_lineage(rooted.select("node", "root").join(named, "root").select("node", "root", "class_id", "class_size"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """One row (id_col, class_id, class_size) for each row of `docs`.

    Documents are of one class if their texts are the same, or linked by a chain of similarities of SIMILARITY
    or more: shingles of SHINGLE words aligned in order, over all there are. Case and punctuation do not
    count. class_id is the least id of the class (null if none of its rows has an id), class_size its rows.
    Null texts are empty; texts without words are of one class only where they are the same. Repeated rows
    are members of their own; an empty table gives an empty result; other columns are not read. Whole texts
    are compared, whatever their length.

    Sketches find a pair at SIMILARITY but for a chance of 1e-5; hot buckets lose none of theirs (see _rarest()).
    `exact` compares all pairs of distinct texts instead, block by block, at the cost of their number's square.
    """
    rows = docs.select(F.col(id_col).alias("id"), content(text_col).alias("node"))
    found = rows.join(_rooted(docs, id_col, text_col, exact), "node")
    return found.select(F.col("id").alias(id_col), "class_id", "class_size")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each class (see classes()), all columns as they are: that with the least id.

    Rows without an id are the last in this order; ties go to the least hash of the row, and of rows that
    are the same in all columns one stays. Columns that cannot be hashed (maps) do not break ties.
    """
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    mark = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(*hashed).alias("row"))
    slim = docs.select(content(text_col).alias("node"), mark.alias("mark"))
    firsts = slim.join(_rooted(docs, id_col, text_col).select("node", "root"), "node").groupBy("root").agg(F.min("mark").alias("mark"))
    kept = cut_lineage(firsts.select("mark"))
    times = cut_lineage(slim.groupBy("mark").agg(F.count("*").alias("times")).join(kept, "mark"))
    marked = docs.select(mark.alias("__mark"), F.struct(*(F.col(c) for c in docs.columns)).alias("__row"))
    single = marked.join(times.where("times = 1").select(F.col("mark").alias("__mark")), "__mark", "left_semi").select("__row")
    if not times.where("times > 1").take(1):
        return single.select("__row.*")
    several = marked.join(times.where("times > 1").select(F.col("mark").alias("__mark")), "__mark", "left_semi")
    once = several.groupBy("__mark").agg(F.first("__row").alias("__row")).select("__row")
    return single.union(once).select("__row.*")
