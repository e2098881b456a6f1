import pytest
from parity import duck, rows

from scriptoria.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_match_sql(spark, small, name):
    got = QUERIES[name](spark, small).toPandas()
    expected = duck(small).sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["reason", "n"]


def test_editor_fold_is_a_plain_loop(spark, small):
    got = {r["session"]: r.asDict() for r in QUERIES["q_editor_fold"](spark, small).collect()}
    sessions = {}
    for r in sorted(spark.read.parquet(f"{small}/events.parquet").collect(), key=lambda r: r["event_id"]):
        kind = ("edit", "edit", "edit", "undo", "redo", "complete")[r["event_id"] % 6]
        key = str(r["user_id"])
        status, text, undo, redo = sessions.get(key, ("draft", "", [], []))
        if kind == "edit" and str(r["value"]) != text:
            undo, redo, text = (undo + [text])[-50:], [], str(r["value"])
            status = "edited" if status == "completed" else status
        elif kind == "undo" and undo:
            undo, redo, text = undo[:-1], redo + [text], undo[-1]
            status = "edited" if status == "completed" else status
        elif kind == "redo" and redo:
            undo, redo, text = undo + [text], redo[:-1], redo[-1]
            status = "edited" if status == "completed" else status
        elif kind == "complete" and text.strip():
            status = "completed"
        sessions[key] = status, text, undo, redo
    assert {k: (s[0], len(s[2]), len(s[3])) for k, s in sessions.items()} == {k: (g["status"], g["undo_steps"], g["redo_steps"]) for k, g in got.items()}
