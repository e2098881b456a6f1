"""Pages under editing as a stateful stream: revision and status of a page, its blocks by id, and sessions that end by a timer.

One step serves the stream, which keeps blocks in a map state and touches only those that change, and the batch replay,
which keeps one page in memory while a task goes through the sorted events.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: A block of a page: `validated` is the hash of the text that a validation was made for, null without one.
BLOCK = "struct<id:string,text:string,skipped:boolean,validated:string>"
EVENT = f"page string, seq long, at timestamp, kind string, revision long, status string, blocks array<{BLOCK}>"
RESULT = "page string, seq long, outcome string, revision long, status string, n_blocks int, n_validated int"
_BLOCK_STATE = "place int, text string, skipped boolean, validated string"
#: What ends a session: no event of the page for so long.
IDLE_MS = 30 * 60 * 1000

Blocks = dict[str, tuple[int, str, bool, str | None]]


def text_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fresh(block: tuple[int, str, bool, str | None]) -> tuple[int, str, bool, str | None]:
    """A block as a save leaves it: a validation of a text that has changed since is gone."""
    place, text, skipped, validated = block
    return place, text, skipped, validated if validated == text_hash(text) else None


def completion_problem(blocks: Blocks) -> str | None:
    """Why a page cannot be completed: it needs a block that is not skipped, and a text in each of these."""
    active = [b for b in blocks.values() if not b[2]]
    return "no active block" if not active else "no text" if any(not b[1].strip() for b in active) else None


def step(page: tuple[int, str] | None, blocks: Blocks, kind: str, revision: int | None, status: str | None, given: Blocks | None) -> tuple[tuple[int, str] | None, Blocks | None, str]:
    """((revision, status), blocks or None if they stay, outcome) of an event.

    save: the revision must be the stored one (0 without a page); the blocks take the place of all there were, and a completed page
    that changes while it claims to be completed is edited. validate: gives the blocks named the hash of their text, which a completed page does not take.
    complete, reopen: as the stored page allows. All but a conflict, a refusal and what changes nothing count the revision up.
    """
    current = page[0] if page else 0
    if kind == "save":
        if revision != current:
            return page, None, "conflict"
        new = {i: fresh(b) for i, b in (given or {}).items()}
        if page and page[1] == status == "completed" and new != blocks:
            status = "edited"
        return (current + 1, status or "draft"), new, "saved"
    if page is None:
        return None, None, "missing"
    if kind == "validate":
        if page[1] == "completed":
            return page, None, "read-only"
        named = [i for i in (given or {}) if i in blocks and not blocks[i][2] and blocks[i][1].strip()]
        if not named:
            return page, None, "no eligible block"
        return (current + 1, page[1]), blocks | {i: (*blocks[i][:3], text_hash(blocks[i][1])) for i in named}, "validated"
    if kind == "complete":
        problem = completion_problem(blocks)
        return (page, None, problem) if problem else ((current + 1, "completed"), None, "completed")
    if kind == "reopen":
        return (page, None, "not completed") if page[1] != "completed" else ((current + 1, "draft"), None, "reopened")
    return page, None, f"unknown kind {kind}"


def _given(blocks: Any) -> Blocks:
    """The blocks of an event by id, in their order; of several of one id the last counts."""
    get = lambda b, k: b[k] if isinstance(b, dict) else getattr(b, k)
    return {get(b, "id"): (i, get(b, "text") or "", bool(get(b, "skipped")), get(b, "validated")) for i, b in enumerate(blocks if blocks is not None else ())}


def _row(key: str, seq: int | None, outcome: str, page: tuple[int, str] | None, blocks: Blocks) -> tuple:
    return key, seq, outcome, page[0] if page else 0, page[1] if page else None, len(blocks), sum(b[3] is not None for b in blocks.values())


_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_COLUMNS)
    return out.astype({"seq": "Int64", "revision": "int64", "n_blocks": "int32", "n_validated": "int32"})


def _whole(x: Any) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


class PageProcessor(StatefulProcessor):
    """Folds a page's events as they arrive, in the order of seq within a micro-batch."""

    def __init__(self, idle_ms: int = IDLE_MS) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.page = handle.getValueState("page", "revision long, status string")
        self.blocks = handle.getMapState("blocks", "id string", _BLOCK_STATE)
        self.session = handle.getValueState("session", "events long, timer long")

    def _held(self) -> tuple[tuple[int, str] | None, Blocks]:
        page = self.page.get() if self.page.exists() else None
        blocks = {k[0]: (int(v[0]), v[1], bool(v[2]), v[3]) for k, v in self.blocks.iterator()} if page else {}
        return (int(page[0]), page[1]) if page else None, dict(sorted(blocks.items(), key=lambda x: x[1][0]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        events = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        page, blocks = self._held()
        before, first, out = dict(blocks), page, []
        for e in events.itertuples(index=False):
            page, new, outcome = step(page, blocks, e.kind, _whole(e.revision), e.status, _given(e.blocks))
            blocks = blocks if new is None else new
            out.append(_row(key[0], int(e.seq), outcome, page, blocks))
        if page is not None and page != first:
            self.page.update(page)
        for i in before.keys() - blocks.keys():
            self.blocks.removeKey((i,))
        for i, b in blocks.items():
            if before.get(i) != b:
                self.blocks.updateValue((i,), b)
        self._wait(len(events), int(events["at"].max().timestamp() * 1000))
        yield _frame(out)

    def _wait(self, events: int, last: int) -> None:
        """One timer a session, IDLE_MS behind its last event."""
        count, timer = (int(x) for x in self.session.get()) if self.session.exists() else (0, 0)
        if timer:
            self.handle.deleteTimer(timer)
        timer = max(timer, last + self.idle_ms)
        self.handle.registerTimer(timer)
        self.session.update((count + events, timer))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """The session is over: the page stays, what was only the session's goes."""
        count = int(self.session.get()[0]) if self.session.exists() else 0
        self.session.clear()
        page, blocks = self._held()
        yield _frame([_row(key[0], None, f"idle after {count} events", page, blocks)])

    def close(self) -> None:
        pass


def follow(events: DataFrame, idle_ms: int = IDLE_MS, late: str = "10 minutes") -> DataFrame:
    """(page, seq, outcome, revision, status, n_blocks, n_validated) for each event of a stream, and a row without seq where a session ends.

    Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass). A session ends when the watermark, `late` behind the latest
    event of all pages, has passed `idle_ms` behind its last event.
    """
    return events.withWatermark("at", late).groupBy("page").transformWithStateInPandas(PageProcessor(idle_ms), RESULT, "append", "eventTime")


def replay(events: DataFrame) -> DataFrame:
    """As follow(), of a table: the events of each page in the order of seq. Sessions are not told.

    Spark sorts and spills; a task keeps one page.
    """
    rows = events.select("page", F.col("seq").cast("long").alias("seq"), "kind", F.col("revision").cast("long").alias("revision"), "status", "blocks").repartition("page").sortWithinPartitions("page", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, page, blocks = None, None, {}
        for pdf in batches:
            out = []
            for key, seq, kind, revision, status, given in pdf.itertuples(index=False):
                if key != at:
                    at, page, blocks = key, None, {}
                page, new, outcome = step(page, blocks, kind, _whole(revision), status, _given(given))
                blocks = blocks if new is None else new
                out.append(_row(key, int(seq), outcome, page, blocks))
            if out:
                yield _frame(out)

    return rows.mapInPandas(run, RESULT)


__all__ = ["BLOCK", "EVENT", "IDLE_MS", "PageProcessor", "follow", "replay", "step"]
