"""Several values packed in one text field (problem 2)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlake.session import cut

#: The characters that separate items, besides white space.
SEPARATORS = ",;|/"
#: What a cover costs: a plain stretch that is no known value, a quoted stretch that is none, and a quote that is an ordinary character.
UNKNOWN, UNKNOWN_QUOTED, STRAY_QUOTE = 1, 1_999_999, 1_000_000
#: The dictionary is sent to every task if it has at most so many values and letters in them; beyond that lists are joined with it.
DICTIONARY_VALUES, DICTIONARY_LETTERS = 100_000, 4_000_000

_PAIRS = {"[": "]", "(": ")", "{": "}"}
_CALL = re.compile(r"[A-Za-z_][\w.]*\s*(?=\()")
#: A separator, a quote or a plain stretch.
_TOKEN = re.compile(rf"(\s*[{SEPARATORS}]\s*|\s+)|(['\"])|[^\s{SEPARATORS}'\"]+")
#: A plain or quoted stretch between separators or ends of the list; quoted ones may overlap.
_PLAIN = re.compile(rf"(?<![^\s{SEPARATORS}])[^\s{SEPARATORS}'\"]+(?![^\s{SEPARATORS}])")
_QUOTED = re.compile(rf"(?<![^\s{SEPARATORS}])(?=('[^']*'|\"[^\"]*\")(?![^\s{SEPARATORS}]))")
_SPAN = re.compile(r"(?=('[^']*'|\"[^\"]*\"))")


def unwrap(text: str) -> str:
    """Take the marks around a whole list off: white space, brackets, a constructor call, outer quotes."""
    body, bracketed = text.strip(), False
    while body:
        call = _CALL.match(body)
        if call and body.endswith(")"):
            body = body[call.end() :]
        first, last = body[0], body[-1]
        if len(body) > 1 and _PAIRS.get(first) == last:
            body, bracketed = body[1:-1].strip(), True
        elif len(body) > 1 and first == last and first in "'\"" and not bracketed and first not in body[1:-1].replace(first * 2, ""):
            body = body[1:-1].replace(first * 2, first).strip()
        else:
            break
    return body


def whole_values(bodies: Iterable[str]) -> set[str]:
    """The values that stand alone in some list: plain ones, and quoted ones with their quotes."""
    return {v for b in bodies for pattern in (_PLAIN, _QUOTED) for v in pattern.findall(b)}


def automaton_of(values: Iterable[str]) -> ahocorasick.Automaton | None:
    """A multi-pattern automaton over whole values."""
    automaton = ahocorasick.Automaton()
    for v in values:
        automaton.add_word(v, len(v))
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton


def best_cover(body: str, automaton: ahocorasick.Automaton | None) -> list[tuple[str, str]]:
    """The cheapest cover of *body* as (kind, text): 'gap', 'plain' or 'quoted' (without its quotes), by dynamic programming from the right.

    Known whole values cost nothing, and the separators inside a quoted one are covered by it. A quoted stretch that is no known value costs hardly less than its two
    quotes taken as ordinary characters. Of equal covers the one wins whose first quoted value starts leftmost and is shortest.
    """
    tokens = [(m.start(), m.end(), m.lastindex) for m in _TOKEN.finditer(body)]  # 1: separator, 2: quote, None: plain
    n = len(tokens)
    known = {(end + 1 - size, end + 1) for end, size in automaton.iter(body)} if automaton else set()
    starts = {a: i for i, (a, _, _) in enumerate(tokens)} | {len(body): n}
    cost, take = [0] * (n + 1), [0] * n
    after: dict[str, list[int]] = {"'": [], '"': []}  # quotes to the right, the nearest last
    for i in range(n - 1, -1, -1):
        a, b, kind = tokens[i]
        if kind == 1:
            cost[i] = cost[i + 1]
        elif kind is None:
            cost[i] = cost[i + 1] + (0 if (a, b) in known else UNKNOWN)
        else:
            mark = body[a]
            cost[i] = cost[i + 1] + STRAY_QUOTE
            if after[mark]:  # a quoted stretch ends at the next quote of its kind
                end = tokens[after[mark][-1]][1]
                j = starts[end]
                covered = cost[j] + (0 if (a, end) in known else UNKNOWN_QUOTED)
                if covered <= cost[i]:
                    cost[i], take[i] = covered, j
            after[mark].append(i)
    out, i = [], 0
    while i < n:
        a, b, kind = tokens[i]
        if take[i]:
            i = take[i]
            out.append(("quoted", body[a + 1 : tokens[i - 1][1] - 1]))
        else:
            out.append(("gap" if kind == 1 else "plain", body[a:b]))
            i += 1
    return out


def split_list(body: str, automaton: ahocorasick.Automaton | None) -> list[tuple[int, str]]:
    """(slot, item) of each non-empty item of one unwrapped list."""
    out, pos, item = [], 0, ""
    for kind, text in best_cover(body, automaton):
        if kind != "gap":
            item += text
            continue
        if item:
            out.append((pos, item))
        pos, item = pos + 1, ""
    return [*out, (pos, item)] if item else out


def _bodies(column: pa.Array) -> dict[str, str]:
    """Each different list of a column with what is in its wrapping."""
    return {t: unwrap(t) for t in set(column.to_pylist())}


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(sorted(whole_values(_bodies(b.column("list")).values())), pa.string())], ["value"])


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, value) of the quoted stretches that don't stand alone in their list."""
    for b in batches:
        made = [(t, v) for t, body in _bodies(b.column("list")).items() for v in set(_SPAN.findall(body)) - set(_QUOTED.findall(body))]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in made], pa.string()), pa.array([v for _, v in made], pa.string())], ["list", "value"])


def _splitter(id_column: str, values: list[str] | None):
    """Over batches of (id, field, list, known): their items. *values* is the dictionary; without it that of the batch, with each list's known values, serves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(values) if values is not None else None
        for b in batches:
            texts, bodies = b.column("list").to_pylist(), _bodies(b.column("list"))
            if values is None:
                automaton = automaton_of(whole_values(bodies.values()).union(*[k or () for k in b.column("known").to_pylist()]))
            split = {t: split_list(body, automaton) for t, body in bodies.items()}
            items = [split[t] for t in texts]
            row = pa.array(np.repeat(np.arange(len(texts)), [len(x) for x in items]))
            pos, item = pa.array([p for x in items for p, _ in x], pa.int32()), pa.array([s for x in items for _, s in x], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pos, item], [id_column, "field", "pos", "item"])

    return run


def explode_lists(df: DataFrame, id_column: str, fields: list[str], most_values: int = DICTIONARY_VALUES) -> DataFrame:
    """One row for each non-empty item of the lists in *fields*: id, field, pos, item.

    The dictionary is that of the column: every value, plain or quoted, that stands alone in some list. An automaton finds its values in each list, and
    dynamic programming picks the best cover, which protects separators inside quoted values. The dictionary is sent to the tasks only
    while it is measured to be small. Beyond that the quoted stretches that don't stand alone in their own list (the only ones that other
    lists can vouch for) are joined with it, so the result is the same.

    Null and blank lists give nothing. Items are separated by one of SEPARATORS with the white space around it, or by
    a run of white space; slots count from 0, also empty ones, which give no row. Text in quotes is one item without
    the quotes. A quote without partner is an ordinary character. Repeated rows give repeated results.
    """
    stacked = ", ".join(f"'{f}', `{f}`" for f in fields)
    lists = df.select(F.col(id_column), F.expr(f"stack({len(fields)}, {stacked}) as (field, list)")).filter(F.col("list").isNotNull())
    values = cut(lists.select("list").mapInArrow(_dictionary, "value string").distinct())
    size = values.agg(F.count("value").alias("n"), F.coalesce(F.sum(F.length("value")), F.lit(0)).alias("letters")).first()
    made = f"`{id_column}` {dict(df.dtypes)[id_column]}, field string, pos int, item string"
    if size["n"] <= most_values and size["letters"] <= DICTIONARY_LETTERS:
        return lists.mapInArrow(_splitter(id_column, [r[0] for r in values.collect()]), made)
    vouched = lists.select("list").mapInArrow(_suspects, "list string, value string").distinct().join(values, "value").groupBy("list").agg(F.collect_set("value").alias("known"))
    return lists.join(vouched, "list", "left").select(id_column, "field", "list", "known").mapInArrow(_splitter(id_column, None), made)
