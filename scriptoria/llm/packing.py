"""Best-fit packing into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage

#: Permitted sequence lengths, in tokens.
CAPACITIES = (512, 1024, 2048, 4096)
#: What a sequence costs besides its length, in tokens: padding to a batch, attention resets, bookkeeping.
OPENING_COST = 16
#: Pieces that one task packs together, on average. Waste falls with the number of pieces; beyond a few thousand it hardly does.
SHARD_PIECES = 8192
#: Pieces that are told from one row at a time.
STEP = 8192


def word_tokens(text: Column) -> Column:
    """Words, and one end of text, as a stand-in for a tokenizer; a null text has its end only."""
    return (F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)) + 1).cast("long")


def cost(capacity: int) -> int:
    return capacity + OPENING_COST


def fitting(total: int, capacities: tuple[int, ...]) -> int:
    """The least permitted length that holds `total`."""
    return capacities[bisect_left(capacities, total)]


def filled(lengths: list[int], at: int, capacity: int) -> list[int]:
    """Positions in the rising `lengths` of what one bin takes: the piece at `at`, then each time the longest that still fits."""
    taken, room, below = [at], capacity - lengths[at], at
    while room > 0 and below > 0:
        below = bisect_right(lengths, room, 0, below) - 1
        if below < 0:
            break
        taken.append(below)
        room -= lengths[below]
    return taken


def pack_jointly(lengths: list[int], capacities: tuple[int, ...]) -> list[list[int]]:
    """Indices of the bins' pieces; `lengths` fall. Each bin's permitted length is chosen by itself.

    The longest piece left opens a bin. It is filled on trial at every length that holds it, and the trial
    stays which costs least for each token it holds, at the length that its contents need.
    """
    order = list(range(len(lengths)))[::-1]
    rising = [lengths[i] for i in order]
    bins: list[list[int]] = []
    while rising:
        last = len(rising) - 1
        best: tuple[float, int, list[int]] | None = None
        for capacity in capacities[bisect_left(capacities, rising[-1]) :]:
            taken = filled(rising, last, capacity)
            total = sum(rising[k] for k in taken)
            rate = cost(fitting(total, capacities)) / max(total, 1)
            if best is None or (rate, -total) < best[:2]:
                best = rate, -total, taken
        bins.append([order[k] for k in best[2]])
        for k in best[2]:  # from the end, so that places stay right
            del rising[k], order[k]
    return bins


def pack_opening(lengths: list[int], capacities: tuple[int, ...], opening: int) -> list[list[int]]:
    """Indices of the bins' pieces; `lengths` fall, each goes where it leaves the least room, else into a new bin of length `opening` (or the least that holds it)."""
    room: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for i, n in enumerate(lengths):
        at = bisect_left(room, (n, -1))
        if at < len(room):
            left, b = room.pop(at)
            bins[b].append(i)
        else:
            left, b = fitting(max(n, opening), capacities), len(bins)
            bins.append([i])
        if left > n:
            insort(room, (left - n, b))
    return bins


#: Pieces of which the cheapest packing is found by trying all.
TRIED = 8


def pack_few(lengths: list[int], capacities: tuple[int, ...]) -> list[list[int]]:
    """The cheapest packing of a few pieces: the cheapest of each subset, built from those of its parts."""
    n = len(lengths)
    total = [0] * (1 << n)
    for x in range(1, 1 << n):
        low = x & -x
        total[x] = total[x ^ low] + lengths[low.bit_length() - 1]
    alone = [cost(fitting(t, capacities)) if t <= capacities[-1] else None for t in total]
    best: list[tuple[int, int]] = [(0, 0)] * (1 << n)  # cost, the bin that holds the subset's lowest piece
    for x in range(1, 1 << n):
        low = x & -x
        rest = part = x ^ low
        found = None
        while True:
            own = alone[part | low]
            if own is not None and (found is None or own + best[rest ^ part][0] < found[0]):
                found = own + best[rest ^ part][0], part | low
            if not part:
                break
            part = (part - 1) & rest
        best[x] = found
    bins, x = [], (1 << n) - 1
    while x:
        bins.append([i for i in range(n) if best[x][1] >> i & 1])
        x ^= best[x][1]
    return bins


def repacked(bins: list[list[int]], lengths: list[int], capacities: tuple[int, ...]) -> list[list[int]]:
    """Bins beside each other in the order of their empty places are packed anew, the emptiest first, as many as hold TRIED pieces."""
    empty = lambda b: fitting(sum(lengths[i] for i in b), capacities) - sum(lengths[i] for i in b)
    out, group = [], []
    for b in [*sorted(bins, key=empty, reverse=True), None]:
        if b is not None and sum(map(len, group)) + len(b) <= TRIED:
            group.append(b)
            continue
        pieces = [i for x in group for i in x]
        out += [[pieces[k] for k in x] for x in pack_few([lengths[i] for i in pieces], capacities)] if len(group) > 1 else group
        group = [b] if b is not None else []
    return out


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> list[tuple[int, list[int]]]:
    """(capacity, indices) of bins for falling `lengths`, every bin as short as its contents allow.

    The cheapest is taken of the joint packing and, as a bound, those with one opening length throughout;
    then the emptiest bins are packed anew by trying all. TRIED pieces or fewer are packed at the least cost.
    """
    price = lambda bins: sum(cost(fitting(sum(lengths[i] for i in b), capacities)) for b in bins)
    if len(lengths) <= TRIED:
        bins = pack_few(lengths, capacities) if lengths else []
    else:
        bins = min([pack_jointly(lengths, capacities), *(pack_opening(lengths, capacities, c) for c in capacities)], key=price)
        bins = min(repacked(bins, lengths, capacities), bins, key=price)
    return [(fitting(sum(lengths[i] for i in b), capacities), b) for b in bins]


def pack_sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None, capacities: tuple[int, ...] = CAPACITIES, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row (id_col, piece, start, n_tokens, bin_id, capacity, offset) for each piece of each document.

    A document longer than the longest permitted length is cut into pieces of that length and a rest; no
    token is dropped. `tokens` gives a document's length (word_tokens() of text_col if not given); documents
    without tokens have one piece of length 0. Null ids, null texts and repeated rows are packed like others;
    an empty table gives an empty result. Other columns are not read, so their names cannot clash.

    Pieces are dealt to shards by a hash of document, copy and piece, so that neither a hot source nor a long
    document meets in one shard, nor a row that is repeated many times: equal rows are counted, and the count
    numbers the copies. The number of shards follows the number of pieces, so a shard is bounded.
    """
    caps = tuple(sorted({int(c) for c in capacities}))
    if not caps or caps[0] <= 0:
        raise ValueError("capacities must be positive")
    longest = caps[-1]
    n = (tokens if tokens is not None else word_tokens(F.col(text_col))).cast("long")
    sized = docs.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).alias("n"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    sized = cut_lineage(sized.groupBy("id", "n", "h").agg(F.count("*").alias("copies")))
    cuts = F.greatest(F.ceil(F.col("n") / longest), F.lit(1)).cast("long")
    total = sized.agg(F.sum(cuts * F.col("copies"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_pieces))
    # The pieces of many copies, and of a very long document, are told in steps, so that no task tells them all.
    told = sized.withColumn("whole", cuts * F.col("copies")).withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("whole") - 1) / STEP))))
    many = told.where(F.col("whole") > STEP).repartition("id", "n", "h", "step")
    told = told.where(F.col("whole") <= STEP).unionByName(many)
    told = told.withColumn("k", F.explode(F.sequence(F.col("step") * STEP, F.least((F.col("step") + 1) * STEP, F.col("whole")) - 1)))
    pieces = told.select("id", "h", (F.col("k") % cuts).alias("piece"), F.floor(F.col("k") / cuts).alias("copy"), "n")
    pieces = pieces.select("id", "piece", "copy", "h", (F.col("piece") * longest).alias("start"), F.least(F.col("n") - F.col("piece") * longest, F.lit(longest)).alias("n_tokens"), F.pmod(F.xxhash64("h", "id", "piece", "copy"), F.lit(shards)).alias("shard"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "id", "piece", "h", "copy"], ascending=[False, True, True, True, True], kind="stable", ignore_index=True)
        lengths = rows["n_tokens"].tolist()
        bin_of, capacity, offset = [0] * len(lengths), [0] * len(lengths), [0] * len(lengths)
        for b, (c, members) in enumerate(pack(lengths, caps)):
            at = 0
            for i in members:
                bin_of[i], capacity[i], offset[i] = b, c, at
                at += lengths[i]
        rows = rows.assign(bin_id=[f"{key[0]}-{b}" for b in bin_of], capacity=capacity, offset=offset)
        return rows[["id", "piece", "start", "n_tokens", "bin_id", "capacity", "offset"]]

    packed = pieces.groupBy("shard").applyInPandas(pack_shard, f"id {id_type}, piece long, start long, n_tokens long, bin_id string, capacity long, offset long")
    return packed.withColumnRenamed("id", id_col)


def utilisation(packed: DataFrame) -> DataFrame:
    """Sequences, tokens and share of filled places by permitted length."""
    bins = packed.groupBy("bin_id", "capacity").agg(F.sum("n_tokens").alias("filled"))
    return bins.groupBy("capacity").agg(F.count("*").alias("n_bins"), F.sum("filled").alias("n_tokens"), (F.sum("filled") / F.sum("capacity")).alias("filled_share"))


__all__ = ["CAPACITIES", "pack", "pack_sequences", "utilisation", "word_tokens"]
