"""The result of a plan: four tables, their issues and one outcome row per job."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame

from ..schemas import TABLES, conform

Parents = dict[str, DataFrame]
Step = Callable[[Parents], DataFrame]


class Batch:
    """Tables of one ingest, each planned when it is first asked for.

    ``parents`` are what the tables have in common, in order, each built from
    the ones before it; ``build`` makes the tables from them. ``rejected`` has
    the errors of jobs that were not assembled at all.
    """

    def __init__(
        self, parents: dict[str, Step], build: dict[str, Step], rejected: DataFrame | None = None
    ) -> None:
        self._steps = parents
        self._build = build
        self.rejected = rejected

    @cached_property
    def parents(self) -> Parents:
        made: Parents = {}
        for name, step in self._steps.items():
            made[name] = step(made)
        return made

    def kept(self, keep: Callable[[str, DataFrame], DataFrame]) -> Batch:
        """The same batch over parents that ``keep`` has stored, each read by the next."""
        steps = {
            name: lambda made, name=name, step=step: keep(name, step(made))
            for name, step in self._steps.items()
        }
        return Batch(steps, self._build, self.rejected)

    @cached_property
    def reflectivity(self) -> DataFrame:
        return self._build["reflectivity"](self.parents)

    @cached_property
    def sample(self) -> DataFrame:
        return self._build["sample"](self.parents)

    @cached_property
    def environment(self) -> DataFrame:
        return self._build["environment"](self.parents)

    @cached_property
    def reflectivity_model(self) -> DataFrame:
        return self._build["reflectivity_model"](self.parents)

    @cached_property
    def issues(self) -> DataFrame:
        return self._build["issues"](self.parents)

    @cached_property
    def outcomes(self) -> DataFrame:
        return self._build["outcomes"](self.parents)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}

    def reports(self) -> dict[str, DataFrame]:
        """What is said about the ingest: issues, outcomes, and errors of rejected jobs."""
        found = {"issues": self.issues, "outcomes": self.outcomes}
        return found if self.rejected is None else {**found, "rejected": self.rejected}


def table(df: DataFrame, name: str, columns: list[Column]) -> DataFrame:
    """Project rows to a declared table."""
    return conform(df.select(*columns), name)
