"""Small string helpers that Spark's own functions lack, and intermediate values of large expressions."""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_numbers = itertools.count()


class Stages:
    """Intermediate values as columns of a table, in as few steps as their dependencies allow.

    While a `with` block of it runs, `let` binds its value to a column instead of a lambda's variable:
    each value is computed once a row, by compiled code.
    """

    def __init__(self) -> None:
        self.steps: list[dict[str, Column]] = []
        self.step_of: dict[str, int] = {}
        self.conditions: list[Column] = []

    def __enter__(self) -> Stages:
        self.token = _stages.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _stages.reset(self.token)

    @contextmanager
    def only(self, condition: Column) -> Iterator[None]:
        """Values bound inside are computed for rows that meet the condition only, and null elsewhere."""
        self.conditions.append(condition)
        yield
        self.conditions.pop()

    def bind(self, value: Column) -> Column:
        for condition in self.conditions[-1:]:
            value = F.when(condition, value)
        text = value._jc.toString() if hasattr(value, "_jc") else str(value)
        used = [self.step_of[x] for x in set(re.findall(r"_let_\d+", text)) if x in self.step_of]
        step, name = max(used, default=-1) + 1, f"_let_{next(_numbers)}"
        self.step_of[name] = step
        self.steps += [{} for _ in range(step + 1 - len(self.steps))]
        self.steps[step][name] = value
        return F.col(name)

    def add(self, rows: DataFrame, **results: Column) -> DataFrame:
        """The rows with the results as columns; the intermediate ones go."""
        out = rows
        for step in self.steps:
            out = out.withColumns(step)
        return out.select(*(F.col(c) for c in rows.columns if c not in results), *(v.alias(k) for k, v in results.items()))


_stages: ContextVar[Stages | None] = ContextVar("stages", default=None)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once.

    Catalyst would write out a column's expression at each of its uses. Among `Stages` the value is a
    column of its own; elsewhere it is a lambda's variable, which works in any expression but keeps
    what it holds out of compiled code.
    """
    stages = _stages.get()
    if stages is not None:
        return then(stages.bind(value))
    return F.element_at(F.transform(F.array(value), lambda x: then(x)), 1)


def let_all(values: dict[str, Column], then: Callable[[dict[str, Column]], Column]) -> Column:
    """then(values), each computed once."""
    stages = _stages.get()
    if stages is not None:
        return then({k: stages.bind(v) for k, v in values.items()})
    return let(F.struct(*(v.alias(k) for k, v in values.items())), lambda x: then({k: x[k] for k in values}))


def settled(rows: DataFrame, counter: str = "rows") -> DataFrame:
    """The rows as they are; filters above don't move below this, where they would compute the columns again.

    It is an observed metric (the number of rows), which Catalyst moves nothing through.
    """
    return rows.observe(f"{counter}_{uuid.uuid4().hex}", F.count(F.lit(1)).alias(counter))


def groups(text: Column, pattern: str, count: int) -> Column:
    """The groups of a pattern that takes the whole of a line, by one pass; an array of another size where it doesn't match.

    A line has no newline, which parts the groups; only the last group may.
    """
    return F.split(F.regexp_replace(text, pattern, "\n".join(f"${i + 1}" for i in range(count))), "\n", count)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends (trim() takes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def filled(text: Column) -> Column:
    """Null instead of an empty string."""
    return F.nullif(text, F.lit(""))


def first_filled(*texts: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(filled(t) for t in texts))


def extract(text: Column, pattern: str, group: int = 0) -> Column:
    """A group of the first match, null without a match or where the group is empty."""
    return let(F.regexp_extract(text, pattern, group), filled)


def extract_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def tokens(text: Column) -> Column:
    """Runs of non-space characters; no empty ones at the ends."""
    return extract_all(text, r"(?U)\S+")


def at(values: Column, place: int) -> Column:
    """An array's value at a place from 0, null beyond its end in any ANSI mode."""
    return F.get(values, F.lit(place))


def last_wins(keys: Column, values: Column) -> Column:
    """A map in which the last value of a repeated key stays, whatever spark.sql.mapKeyDedupPolicy is."""

    def build(x: dict[str, Column]) -> Column:
        keys, values, each = x["k"], x["v"], x["each"]
        chosen = F.transform(each, lambda k: F.try_element_at(values, F.array_position(keys, k).cast("int")))
        return F.when(F.size(each) == F.size(keys), F.map_from_arrays(keys, values)).otherwise(F.map_from_arrays(each, chosen))

    def distinct(x: dict[str, Column]) -> Column:
        return let_all({"k": x["k"], "v": x["v"], "each": F.array_distinct(x["k"])}, build)

    return let_all({"k": F.reverse(keys), "v": F.reverse(values)}, distinct)


def get(fields: Column, key: str) -> Column:
    return F.try_element_at(fields, F.lit(key))
