"""A graph of models: what each is built from, in which order, and what a failed check stops.

A model names its inputs, other models or sources.  ``order_of`` sorts the
models so that each comes after its inputs; a cycle or an unknown input is an
error before anything is built.  ``run_graph`` builds each model once from the
stored tables of its inputs, stages it, checks what was staged and publishes
it.  With ``enforce`` a model whose checks fail, or whose build fails, is not
published: its old table stays, and every model below it is skipped.  Without,
checks are reported only and a failed build is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

BUILT, FAILED, SKIPPED = "built", "failed", "skipped"


class Store(Protocol):
    """Where models are kept: ``stage`` writes one and gives a read of it, which
    only ``publish`` makes the table."""

    def stage(self, name: str, rows: DataFrame) -> DataFrame: ...

    def publish(self, name: str) -> None: ...


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]  # takes one table for each input
    check: Callable[[DataFrame], DataFrame] | None = None  # a report with ``violations`` and ``passed``


@dataclass
class Run:
    """The outcome: state of each model, stored tables, check rows, and why builds failed."""

    states: dict[str, str] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    reports: list[DataFrame] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)


def order_of(models: Sequence[Model], sources: Sequence[str]) -> list[Model]:
    """The models, each after its inputs, otherwise in the given order."""
    by_name = {m.name: m for m in models}
    if len(by_name) < len(models) or set(by_name) & set(sources):
        raise ValueError("a model's name is taken twice")
    done, out, open_ = set(sources), [], []

    def visit(name: str) -> None:
        if name in done:
            return
        if name in open_:
            raise ValueError("models need each other: " + " -> ".join([*open_[open_.index(name):], name]))
        if name not in by_name:
            raise ValueError(f"{open_[-1] if open_ else 'the graph'} needs {name}, which is no model and no source")
        open_.append(name)
        for needed in by_name[name].inputs:
            visit(needed)
        open_.pop()
        done.add(name)
        out.append(by_name[name])

    for model in models:
        visit(model.name)
    return out


def run_graph(models: Sequence[Model], sources: Mapping[str, DataFrame], store: Store, enforce: bool = False) -> Run:
    run = Run(tables=dict(sources))
    for model in order_of(models, list(sources)):
        if any(run.states.get(i, BUILT) != BUILT for i in model.inputs):
            run.states[model.name] = SKIPPED
            continue
        try:
            staged = store.stage(model.name, model.build(*[run.tables[i] for i in model.inputs]))
        except PySparkException as error:
            if not enforce:
                raise
            run.states[model.name], run.errors[model.name] = FAILED, str(error)
            continue
        passed = True
        if model.check is not None:
            report = model.check(staged)
            run.reports.append(report)
            passed = not enforce or report.filter("not passed").isEmpty()
        if passed:
            store.publish(model.name)
            run.tables[model.name] = staged
        run.states[model.name] = BUILT if passed else FAILED
    return run
