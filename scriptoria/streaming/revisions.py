"""Folds of event logs: saves with revisions, batch jobs, editing sessions. The same step serves a batch replay and a stream."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.functions import text as t

STATUSES = ("draft", "detected", "ocr", "edited", "completed")


def save(state: tuple[int, str, str] | None, revision: int, status: str, content: str) -> tuple[tuple[int, str, str] | None, str]:
    """(new state, outcome) of a save on state (revision, status, content): its revision must be the stored one, 0 if there is none.

    A completed page that changes while it claims to be completed is edited.
    """
    current = state[0] if state else 0
    if revision != current:
        return state, "conflict"
    if state and state[1] == status == "completed" and content != state[2]:
        status = "edited"
    return (current + 1, status, content), "saved"


RESULT = "key string, seq long, outcome string, revision long, status string"


def replay(events: DataFrame) -> DataFrame:
    """(key, seq, outcome, revision, status) of save events (key, seq, revision, status, content), by key in the order of seq.

    What a rejected save leaves behind decides over the next, so a key's saves are folded in order; Spark
    sorts and spills, and a task keeps one state, not a key's events.
    """
    rows = events.select(F.col("key").cast("string").alias("key"), F.col("seq").cast("long").alias("seq"), F.col("revision").cast("long").alias("revision"), "status", "content").repartition("key").sortWithinPartitions("key", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for pdf in batches:
            out = []
            for key, seq, revision, status, content in pdf.itertuples(index=False):
                if key != at:
                    at, state = key, None
                state, outcome = save(state, revision, status, content)
                out.append((key, seq, outcome, state[0] if state else 0, state[1] if state else None))
            yield pd.DataFrame(out, columns=["key", "seq", "outcome", "revision", "status"])

    return rows.mapInPandas(run, RESULT)


def follow(events: DataFrame) -> DataFrame:
    """As replay(), of a stream: events of a key are folded as they arrive, in the order of seq within a micro-batch."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key: tuple, frames: Iterable[pd.DataFrame], held: object) -> Iterator[pd.DataFrame]:
        state = held.get if held.exists else None
        rows = pd.concat(list(frames), ignore_index=True).sort_values("seq", kind="stable")
        out = []
        for r in rows.itertuples(index=False):
            state, outcome = save(tuple(state) if state else None, int(r.revision), r.status, r.content)
            out.append((key[0], int(r.seq), outcome, state[0] if state else 0, state[1] if state else None))
        if state:
            held.update(state)
        yield pd.DataFrame(out, columns=["key", "seq", "outcome", "revision", "status"])

    return events.groupBy("key").applyInPandasWithState(step, RESULT, "revision long, status string, content string", "append", GroupStateTimeout.NoTimeout)


# Fixed value: how often what goes on is looked at.
POLL_INTERVAL = "750 milliseconds"


def polled(rows: DataFrame, name: str, mode: str = "append"):
    """A running query that puts what a stream brings into the table `name` of the session, every POLL_INTERVAL."""
    return rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(processingTime=POLL_INTERVAL).start()


#: A batch job's states and what may follow each.
FOLLOWING = {"queued": {"running", "cancelled", "failed"}, "running": {"completed", "cancelling", "failed"}, "cancelling": {"cancelled", "failed"}, "completed": set(), "cancelled": set(), "failed": set()}


def transition_allowed(before: Column, after: Column) -> Column:
    """Whether a batch job may go from one state to the other; a new job (null) is queued."""
    pairs = [f"{a}>{b}" for a, bs in FOLLOWING.items() for b in sorted(bs)] + [">queued"]
    return F.concat_ws(">", F.coalesce(before, F.lit("")), after).isin(*pairs)


def batch_progress(events: DataFrame, job: str = "job") -> DataFrame:
    """Counts of a job's events (outcome: processed, skipped, failed, validation_failed) and of what is done in all."""
    n = lambda k: F.count_if(F.col("outcome") == k).alias(k)
    return events.groupBy(job).agg(n("processed"), n("skipped"), n("failed"), n("validation_failed"), F.count_if(F.col("outcome").isin("processed", "skipped", "failed")).alias("done"))


def batch_outcome(has_error: Column, saved: Column, fails: Column, overwrite: bool = False) -> Column:
    """What a batch does with an image: one with an error fails, one that has been saved is skipped, others are recognised; a failure does not stop the batch."""
    return F.when(has_error, "failed").when(saved & F.lit(not overwrite), "skipped").when(fails, "failed").otherwise("processed")


def stale(response: dict[str, Column], current: dict[str, Column]) -> Column:
    """Whether an answer belongs to an older generation, another image or an earlier version than the editor is at."""
    same = F.lit(True)
    for k in ("generation", "image", "version"):
        same = same & response[k].eqNullSafe(current[k])
    return ~same


DEPTH = 50


def edit(session: dict, kind: str, text: str, revision: int) -> dict:
    """One step of an editing session {text, status, revision, dirty, undo, redo}: edit, undo, redo, complete, saved.

    An edit reopens a completed page and forgets what could be redone; DEPTH steps can be undone. 'saved'
    brings the stored revision: the session is clean if nothing has changed since the text that was sent.
    """
    s = dict(session)
    if kind == "edit" and text != s["text"]:
        s |= {"undo": [*s["undo"], s["text"]][-DEPTH:], "redo": [], "text": text, "dirty": True, "status": "edited" if s["status"] == "completed" else s["status"]}
    elif kind in ("undo", "redo") and s[kind]:
        other = "redo" if kind == "undo" else "undo"
        s |= {other: [*s[other], s["text"]], "text": s[kind][-1], kind: s[kind][:-1], "dirty": True, "status": "edited" if s["status"] == "completed" else s["status"]}
    elif kind == "complete" and s["text"].strip():
        s |= {"status": "completed", "dirty": True}
    elif kind == "saved":
        s |= {"revision": revision, "dirty": s["dirty"] and text != s["text"]}
    return s


def new_session(text: str = "") -> dict:
    return {"text": text, "status": "draft", "revision": 0, "dirty": False, "undo": [], "redo": []}


def fold_sessions(events: DataFrame) -> DataFrame:
    """(session, text, status, revision, dirty, undo_steps, redo_steps) after all events (session, seq, kind, text, revision) in order."""
    rows = events.select(F.col("session").cast("string"), F.col("seq").cast("long"), "kind", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("revision").cast("long"), F.lit(0)).alias("revision")).repartition("session").sortWithinPartitions("session", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["session", "text", "status", "revision", "dirty", "undo_steps", "redo_steps"]
        told = lambda at, s: (at, s["text"], s["status"], s["revision"], s["dirty"], len(s["undo"]), len(s["redo"]))
        at, s = None, None
        for pdf in batches:
            out = []
            for key, _, kind, text, revision in pdf.itertuples(index=False):
                if key != at:
                    if s is not None:
                        out.append(told(at, s))
                    at, s = key, new_session()
                s = edit(s, kind, text, revision)
            if out:
                yield pd.DataFrame(out, columns=columns)
        if s is not None:
            yield pd.DataFrame([told(at, s)], columns=columns)

    return rows.mapInPandas(run, "session string, text string, status string, revision long, dirty boolean, undo_steps int, redo_steps int")


#: What may be done with a page that is completed; anything else needs it to be reopened first.
ON_COMPLETED = ("complete", "reopen", "save")


def acted(status: Column, action: Column, completable: Column) -> Column:
    """struct(status, problem, saved) of a page after an action: detect, prelabel, validate, edit, complete or reopen.

    A completed page is read-only until it is reopened as a draft; reopening another page changes nothing.
    A page that cannot be completed stays as it is. Detection leaves 'detected', an edit 'edited'.
    """
    locked = (status == "completed") & ~action.isin(*ON_COMPLETED)
    refused = (action == "complete") & ~F.coalesce(completable, F.lit(False))
    idle = (action == "reopen") & (status != "completed")
    after = F.when(locked | refused | idle, status).when(action == "complete", "completed").when(action == "reopen", "draft").when(action == "detect", "detected").when(action.isin("edit", "prelabel"), "edited").otherwise(status)
    problem = F.when(locked, "read-only").when(refused, "not complete")
    return F.struct(after.alias("status"), problem.alias("problem"), (~locked & ~refused & ~idle).alias("saved"))


def saved_status(stored: Column, status: Column, changed: Column) -> Column:
    """The status that a save leaves: a completed page that changes while it claims to be completed is edited."""
    return F.when((stored == "completed") & (status == "completed") & changed, "edited").otherwise(status)


def detect_outcome(has_error: Column, status: Column, n_blocks: Column) -> Column:
    """What a detection batch does with a page: pages with an error fail, completed ones and those with blocks are skipped."""
    return F.when(has_error, "failed").when((status == "completed") | (n_blocks > 0), "skipped").otherwise("processed")


def prelabel_outcome(has_error: Column, status: Column, needed: Column) -> Column:
    """What a prelabel batch does with a page; `needed` is annotate.needs_prelabel()."""
    return F.when(has_error, "failed").when((status == "completed") | ~F.coalesce(needed, F.lit(False)), "skipped").otherwise("processed")


def validation_error(outcome: Column, wanted: Column, configured: Column, eligible: Column, failure: Column) -> Column:
    """The error of the validation behind a prelabel, null for none. It fails open: the page stays processed.

    `failure` is what the validator says, null if it succeeds. A page without eligible blocks is no error.
    """
    asked = F.coalesce((outcome == "processed") & wanted, F.lit(False))
    return F.when(~asked, F.lit(None)).when(~configured, "LLM validation failed").when(~eligible, F.lit(None)).otherwise(failure)


def retried(first: Column, second: Column) -> Column:
    """How a validation ends, from the outcomes of two attempts: only an answer that breaks the contract ('semantic') is asked for once more."""
    return F.when(first == "semantic", second).otherwise(first)


def resume_problems(earlier: dict[str, Column], now: dict[str, Column]) -> Column:
    """Names of the settings in which a resumed run differs from the earlier one, in the order given."""
    return F.filter(F.array(*(F.when(~earlier[k].eqNullSafe(now[k]), F.lit(k)) for k in earlier)), lambda k: k.isNotNull())


def keeps_polling(state: Column) -> Column:
    """Whether a batch in this state is looked at again."""
    return F.coalesce(state.isin(*(k for k, after in FOLLOWING.items() if after)), F.lit(False))


def poll_delay(active: Column, pending: Column, terminal: Column) -> Column:
    """Milliseconds until a batch is looked at again: none while an answer is waited for, null when it has ended or there is none."""
    return F.when(pending, 0).when(~terminal & active, int(POLL_INTERVAL.split()[0]))


def navigates(succeeded: Column, dirty: Column) -> Column:
    """Whether an editor may leave a page after a save: it succeeded, and nothing has changed since."""
    return F.coalesce(succeeded & ~dirty, F.lit(False))


def asks_before_delete(text: Column) -> Column:
    return ~t.is_blank(text)


def pans(button: Column, space: Column) -> Column:
    """Whether a pointer moves the view: the middle button, or the first while space is held."""
    return (button == 1) | ((button == 0) & F.coalesce(space, F.lit(False)))
