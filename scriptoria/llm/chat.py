"""Chat formatting: turns become one string with a loss mask, assembled column by column."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: role: (header, footer). A role that is not listed is written out behind OTHER[0].
TEMPLATE = {"system": ("<s>[SYS] ", " [/SYS]</s>"), "user": ("<s>[INST] ", " [/INST]</s>"), "assistant": ("<s>[ASST] ", " [/ASST]</s>")}
OTHER = ("<s>[TURN] ", " [/TURN]</s>")
LOSS_ROLE = "assistant"

#: A control string, with any number of backslashes behind its first sign. Escaping adds one, unescaping takes one.
CONTROL = r"([<\[])(\\*)(/?(?:s>|(?:SYS|INST|ASST|TURN)\]))"
UNCONTROL = r"([<\[])\\(\\*)(/?(?:s>|(?:SYS|INST|ASST|TURN)\]))"
_CONTROL, _UNCONTROL = re.compile(CONTROL), re.compile(UNCONTROL)
_TURN = re.compile(r"<s>\[(SYS|INST|ASST|TURN)\] (.*?) \[/\1\]</s>", re.DOTALL)
_ROLES = {"SYS": "system", "INST": "user", "ASST": "assistant"}

#: Output bytes that one gather makes at most, but for a single longer segment, which is copied as a slice.
GATHER_BYTES = 4 << 20


def escape(text: str) -> str:
    """The text in which no control string stands; unescape() gives the text back, whatever it holds."""
    return _CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _UNCONTROL.sub(r"\1\2\3", text)


def header_of(role: str | None) -> tuple[str, str]:
    """Header and footer of a turn. The name of an unlisted role ends at the first line break that has no backslash."""
    role = role or ""
    if role in TEMPLATE:
        return TEMPLATE[role]
    name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
    return f"{OTHER[0]}{name}\n", OTHER[1]


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound the text, still escaped, in `formatted`."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        start, body = m.start(2), m[2]
        role = _ROLES.get(m[1])
        if role is None:
            name, _, body = body.partition("\n")
            start += len(name) + 1
            role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], unescape(name))
        out.append((role, unescape(body), start, m.end(2)))
        at = m.end()
    return out


def scatter(sources: np.ndarray, begins: np.ndarray, lengths: np.ndarray, out: np.ndarray) -> None:
    """Copies the segments sources[begin : begin + length], one behind the other, into `out`."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        base = int(ends[at] - lengths[at])
        to = max(at + 1, int(np.searchsorted(ends, base + GATHER_BYTES, "right")))
        if to == at + 1:
            out[base : ends[at]] = sources[begins[at] : begins[at] + lengths[at]]
        else:
            n = lengths[at:to]
            index = np.repeat(begins[at:to] - (ends[at:to] - n) + base, n) + np.arange(int(n.sum()))
            np.take(sources, index, out=out[base : int(ends[to - 1])])
        at = to


def assemble(texts: pa.Array, roles: list[str | None], first_of: np.ndarray) -> tuple[pa.Array, list[list[dict]]]:
    """Formatted conversations, and the loss mask of each as spans of code points.

    texts and roles hold the turns of all conversations in order; conversation i has the turns from
    first_of[i] to before first_of[i + 1]. Each turn is three segments: header, escaped text, footer.
    """
    body = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), CONTROL, r"\1\2\\\3")
    body = body.combine_chunks() if isinstance(body, pa.ChunkedArray) else body
    offsets = np.frombuffer(body.buffers()[1], np.int64, len(body) + 1, body.offset * 8)
    data = body.buffers()[2]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    known: dict[str | None, int] = {}
    code = np.fromiter((known.setdefault(r, len(known)) for r in roles), np.int64, len(roles))
    marks = [header_of(r) for r in known]
    pieces = [x.encode("utf-8", "replace") for pair in marks for x in pair]
    piece_len = np.array([len(p) for p in pieces], np.int64)
    piece_at = np.cumsum(piece_len) - piece_len
    table = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(roles)
    lengths, begins = np.empty((n, 3), np.int64), np.empty((n, 3), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2] = piece_len[2 * code], np.diff(offsets), piece_len[2 * code + 1]
    begins[:, 0], begins[:, 1], begins[:, 2] = piece_at[2 * code], offsets[:-1] + len(table), piece_at[2 * code + 1]
    total = int(lengths.sum())
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    if total:
        scatter(np.concatenate([table, content]), begins.ravel(), lengths.ravel(), out)
    turn_at = np.concatenate([[0], np.cumsum(lengths.sum(1))])
    bounds = turn_at[first_of].astype(np.int64)
    formatted = pa.LargeStringArray.from_buffers(len(first_of) - 1, pa.py_buffer(bounds.tobytes()), buffer)
    chars = np.empty((n, 3), np.int64)
    mark_chars = np.array([[len(h), len(f)] for h, f in marks], np.int64).reshape(-1, 2)
    chars[:, 0], chars[:, 1], chars[:, 2] = mark_chars[code, 0], pc.utf8_length(body).to_numpy(zero_copy_only=False), mark_chars[code, 1]
    before = np.concatenate([[0], np.cumsum(chars.sum(1))])
    is_loss = np.fromiter((r == LOSS_ROLE for r in known), bool, len(known))[code] if n else np.empty(0, bool)
    masks = []
    for i in range(len(first_of) - 1):
        turns = np.arange(first_of[i], first_of[i + 1])
        turns = turns[is_loss[turns]]
        begin = before[turns] + chars[turns, 0] - before[first_of[i]]
        masks.append([{"start": int(b), "end": int(e)} for b, e in zip(begin, begin + chars[turns, 1], strict=True)])
    return formatted, masks


_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row (id_col, n_turns, formatted, loss) for each conversation.

    Rows are taken by turn, ties by role and text, nulls first; repeated rows are turns of their own. A null
    text counts as empty, a null role as a role with an empty name; rows with a null id are one conversation.
    An empty table gives an empty result. Other columns are not read. `loss` holds the spans (code points of
    `formatted`, end exclusive) of all assistant texts, empty ones included.

    Conversations are dealt out by id and sorted by Spark, which spills; a task keeps the rows of one batch
    and of the conversation that runs over its end. One conversation is one row of the result, and so the
    least that a task must hold.
    """
    id_type = turns.schema[id_col].dataType.simpleString()
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_pylist()
            last = b.num_rows
            while last and ids[last - 1] == ids[-1]:
                last -= 1
            if kept and kept[-1].column(0)[-1].as_py() != ids[0]:
                yield from emit(kept)
                kept = []
            if last == 0:
                kept.append(b)
                continue
            yield from emit([*kept, b.slice(0, last)])
            kept = [b.slice(last)]
        yield from emit(kept)

    def emit(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        t = pa.Table.from_batches(parts).combine_chunks()
        ids = t.column(0).to_pylist()
        new = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        texts = t.column("text").combine_chunks()
        formatted, masks = assemble(texts if isinstance(texts, pa.Array) else texts.chunk(0), t.column("role").to_pylist(), np.array(new, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in new[:-1]], t.schema.field(0).type), pa.array(np.diff(new), pa.int64()), formatted.cast(pa.string()), pa.array(masks, _LOSS)], [id_col, "n_turns", "formatted", "loss"])

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_turns long, formatted string, loss array<struct<start:long,end:long>>")
