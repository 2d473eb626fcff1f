"""Columns derived in steps, and of them only those that a consumer asks for.

Steps are fixed in the plan (see ``evaluated_once``), and what is fixed is computed whether it is read
or not. So a step names what each of its columns is made of, and only columns that the wanted ones need
are put into the plan at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from inspect import signature

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewaste.functions.values import at, evaluated_once

#: A path in a VARIANT column, or a function whose parameters name the columns it is made of.
Made = tuple[str, str] | Callable[..., Column]
#: Columns that are made of those of earlier steps.
Step = dict[str, Made]


def paths(source: str, found: dict[str, str]) -> Step:
    """One VARIANT column per path of ``source``."""
    return {name: (source, path) for name, path in found.items()}


def _inputs(made: Made) -> list[str]:
    return [made[0]] if isinstance(made, tuple) else list(signature(made).parameters)


def _column(made: Made) -> Column:
    if isinstance(made, tuple):
        return at(F.col(made[0]), made[1])
    return made(*map(F.col, _inputs(made)))


def _demands(steps: list[Step], wanted: Iterable[str]) -> list[set[str]]:
    """Columns needed before each step, and after the last."""
    needed = [set(wanted)]
    for step in reversed(steps):
        made = step.keys() & needed[0]
        used = {name for m in made for name in _inputs(step[m])}
        needed.insert(0, (needed[0] - made) | used)
    return needed


def inputs_of(steps: list[Step], wanted: Iterable[str]) -> set[str]:
    """Columns that the wanted ones need from before the first step."""
    return _demands(steps, wanted)[0]


def derived(df: DataFrame, steps: list[Step], wanted: Iterable[str]) -> DataFrame:
    """The wanted columns; each step is fixed before the next, and a column goes once nothing needs it.

    The last step is left open, so that a caller may add to it.
    """
    needed = _demands(steps, wanted)
    fixed = True
    for step, after in zip(steps, needed[1:], strict=True):
        made = {name: m for name, m in step.items() if name in after}
        if not made:
            continue
        carried = [name for name in df.columns if name in after and name not in made]
        df = (df if fixed else evaluated_once(df)).select(
            *carried, *(_column(m).alias(name) for name, m in made.items())
        )
        fixed = False
    return df.select(*[name for name in df.columns if name in needed[-1]])
