"""Text expressions. All but nfc() run inside the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scriptoria.dims import LABEL_TASK, LABELS, PROMPTS, lookup

#: What str.strip() takes off: Unicode white space and the four separators of ASCII.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Canonical composition; what is ASCII only is passed on as it is."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def composed(text: Column) -> Column:
    """nfc() of what is not ASCII; ASCII, which it leaves as it is, is not sent to Python."""
    return F.coalesce(nfc(F.when(~text.rlike(r"\A\p{ASCII}*\z"), text)), text)


def strip(text: Column) -> Column:
    """Without white space at both ends, of any script."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text) == "", F.lit(True))


def first_filled(label: Column, text: Column) -> Column:
    """The first of the two that is not blank, else null."""
    return F.when(~is_blank(label), label).when(~is_blank(text), text)


def recognition_text(label: Column, text: Column) -> Column:
    """A line of text: composed, with breaks and tabs as spaces, stripped; '' if there is none."""
    return strip(F.regexp_replace(composed(F.coalesce(first_filled(label, text), F.lit(""))), r"\r\n|[\r\n\t]", " "))


def unix_breaks(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def target_text(label: Column, text: Column) -> Column:
    """A structured target: composed, with line feeds only; outer spaces stay; '' if there is nothing else."""
    return unix_breaks(composed(F.coalesce(first_filled(label, text), F.lit(""))))


def unsupported(text: Column, alphabet: str) -> Column:
    """Sorted distinct characters of `text` outside `alphabet`, as an array."""
    rest = F.translate(text, alphabet, "")
    return F.array_sort(F.array_distinct(F.filter(F.split(rest, ""), lambda c: c != "")))


def _ranges(alphabet: str) -> str:
    """The code points of an alphabet as ranges of a character class."""
    out: list[list[int]] = []
    for c in sorted(set(map(ord, alphabet))):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in out)


def has_unsupported(text: Column, alphabet: str) -> Column:
    """Whether unsupported() finds any: one look at each character, so that most rows need no list of them."""
    return text.rlike(f"[^{_ranges(alphabet)}]") if alphabet else text != ""


def has_control(text: Column, keep_line_feed: bool = False) -> Column:
    return text.rlike(r"[\p{Cc}&&[^\n]]" if keep_line_feed else r"\p{Cc}")


def too_long_detail(text: Column, limit: int) -> Column:
    """'n > limit' for longer texts, else null; code points count."""
    return F.when(F.length(text) > limit, F.concat(F.length(text).cast("string"), F.lit(f" > {limit}")))


def detail(text: Column, limit: int = 500) -> Column:
    return F.left(text, F.lit(limit))


def resolved_task(task: Column, default: str = "ocr") -> Column:
    """The row's task: the default where there is none, null where it is not a known one."""
    if default not in PROMPTS:
        raise ValueError(f"unknown task {default!r}")
    return F.when(task.isNull() | (task == ""), default).when(strip(task).isin(*PROMPTS), strip(task))


def prompt_of(task: Column) -> Column:
    return lookup(PROMPTS, task)


def task_of_prompt(prompt: Column) -> Column:
    return lookup({p: t for t, p in PROMPTS.items()}, prompt)


def task_of_label(label: Column) -> Column:
    return lookup(LABEL_TASK, strip(label))


def is_skippable(label: Column) -> Column:
    """Layout labels that have no task."""
    return F.coalesce(strip(label).isin(*(x for x in LABELS if x not in LABEL_TASK)), F.lit(False))


def transcription(raw: Column) -> Column:
    """Detection labels know only text and what is to be ignored."""
    return F.when(strip(raw).isin("*", "###"), "###").otherwise("text")


def natural_key(name: Column, digits: int = 20) -> Column:
    """Sorts digit runs as numbers, of any length, and the rest in lower case."""
    parts = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    number = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    # Numbers of more than `digits` digits come behind the others (':' is what follows '9'), by how many they have.
    wide = lambda n: F.concat(F.lit(":"), F.lpad(F.length(n).cast("string"), 10, "0"), n)
    padded = F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.when(F.length(number(p)) <= digits, F.lpad(number(p), digits, "0")).otherwise(wide(number(p)))).otherwise(F.lower(p)))
    # A run of digits sorts before any text, as does an empty beginning.
    return F.array_join(padded, "\x01")


def html_escaped(text: Column) -> Column:
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(raw), F.lit(name))
    return text


def span(text: Column, start: Column, end: Column) -> Column:
    """text[start:end] in code points."""
    return F.substring(text, start + 1, end - start)


def line_split(lines: Column, index: Column, start: Column, end: Column | None = None) -> Column:
    """A line cut in two at the cursor, without the selection; other lines stay. Positions are clamped."""
    line = F.get(lines, index)
    lo = F.least(F.greatest(start, F.lit(0)), F.length(line))
    hi = F.least(F.greatest(end if end is not None else start, lo), F.length(line))
    cut = F.concat(F.slice(lines, F.lit(1), index), F.array(F.left(line, lo), span(line, hi, F.length(line))), F.slice(lines, index + 2, F.size(lines)))
    return F.when((index >= 0) & (index < F.size(lines)), cut).otherwise(lines)


def line_merge(lines: Column, index: Column) -> Column:
    """A line joined to the one before it."""
    both = F.concat(F.get(lines, index - 1), F.get(lines, index))
    merged = F.concat(F.slice(lines, F.lit(1), index - 1), F.array(both), F.slice(lines, index + 2, F.size(lines)))
    return F.when((index > 0) & (index < F.size(lines)), merged).otherwise(lines)


def line_paste(lines: Column, index: Column, start: Column, pasted: Column) -> Column:
    """Text of any number of lines put in at the cursor."""
    line = F.get(lines, index)
    at = F.least(F.greatest(start, F.lit(0)), F.length(line))
    whole = F.split(F.concat(F.left(line, at), unix_breaks(pasted), span(line, at, F.length(line))), "\n", -1)
    put = F.concat(F.slice(lines, F.lit(1), index), whole, F.slice(lines, index + 2, F.size(lines)))
    return F.when((index >= 0) & (index < F.size(lines)), put).otherwise(lines)


def token_limits(spec: str) -> dict[str, int]:
    """{'task': n} from 'task=n,task=n'; tasks are known and told once, numbers positive."""
    out: dict[str, int] = {}
    for part in filter(None, (p.strip() for p in spec.split(","))):
        task, _, n = part.partition("=")
        if task not in PROMPTS or task in out or not n.isdigit() or int(n) <= 0:
            raise ValueError(f"bad token limit {part!r}")
        out[task] = int(n)
    return out


def log_counts(log: Column, key: str) -> Column:
    """A count such as '1,234' or '1.5e+09' that follows `key` in a log line, else null."""
    raw = F.regexp_extract(log, key + r"\D*?([0-9][0-9,]*(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)", 1)
    return F.when(raw != "", F.replace(raw, F.lit(","), F.lit("")).cast("double").cast("long"))


def canonical_json(json: Column) -> Column:
    """A JSON text with the keys of its objects in order and no spaces, so that equal values are equal texts; null if it is none."""
    return F.to_json(F.try_parse_json(json))


def csv(values: Column) -> Column:
    return F.array_join(values, ",")


def utc_stamp(at: Column) -> Column:
    """A time in UTC as ISO 8601, to the second."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_stamp(at: Column) -> Column:
    """A time as the names of run folders have it."""
    return F.date_format(at, "yyyyMMdd_HHmmss")


# Fixed value: the line of a trainer's log that tells the counts.
TRAINABLE = r"(?is)trainable\s+parameters?\s*[:=]\s*([0-9,.+e-]+).*?(?:all|total)\s+parameters?\s*[:=]\s*([0-9,.+e-]+)"


def trainable_report(log: Column, names_key: str) -> Column:
    """struct(trainable, total, names) of a trainer's log: two counts, and the JSON list of names behind `names_key`= at the begin of a line; null for what is not there."""
    number = lambda i: F.replace(F.regexp_extract(log, TRAINABLE, i), F.lit(","), F.lit("")).try_cast("double").cast("long")
    raw = F.regexp_extract(log, rf"(?m)^{names_key}=(\[.*\])", 1)
    names = F.try_variant_get(F.try_parse_json(raw), "$", "array<string>")
    return F.struct(number(1).alias("trainable"), number(2).alias("total"), F.when(F.forall(names, lambda n: n.isNotNull() & (n != "")), names).alias("names"))


def trainable_problem(report: Column, most: float = 0.2) -> Column:
    """The first thing wrong with a trainable_report(), null if training may start."""
    n, total, names = report["trainable"], report["total"], report["names"]
    return (
        F.when(n.isNull() | total.isNull(), "no counts")
        .when(names.isNull(), "no names")
        .when((total <= 0) | (n <= 0), "counts must be positive")
        .when(~F.exists(names, lambda x: F.lower(x).contains("lora")), "no adapter parameters")
        .when(F.exists(names, lambda x: ~in_adapter_scope(x)), "parameters outside the adapter's scope")
        .when((n >= total) | (n / total > most), "too much is trainable")
    )


# Parameters that adapters may train, and projections that they must have.
ADAPTER_SCOPE = r"^(?:model\.)?model\.layers\.\d+\.(?:self_attn\.(?:q_proj|k_proj|v_proj|o_proj)|mlp\.(?:up_proj|gate_proj|down_proj))\.lora_[AB]\z"
PROJECTIONS = ("q_proj", "k_proj", "v_proj", "o_proj", "up_proj", "gate_proj", "down_proj")


def in_adapter_scope(name: Column) -> Column:
    return name.rlike(ADAPTER_SCOPE)


def is_vision(name: Column) -> Column:
    return name.startswith("visual.") | name.contains(".vision_model.")
