"""Row counts per step, gathered while the steps' own jobs run."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from wardflow.session import short_table

COLUMNS = {
    "ordre": "int", "etape": "string", "lignes_avant": "bigint", "lignes_apres": "bigint",
    "delta": "bigint", "detail": "string",
}


class Journal:
    """Journal of one run.

    Measures are observed on the data as it is written; a step names the
    measures that hold its rows before and after. Nothing is counted by a job
    of its own, so the journal can be read only after the tables were written.

    Watch a table where it is written, with no shuffle in between: tasks before
    a shuffle may run again when an executor is lost, and would count twice.
    """

    def __init__(self, wording: Mapping[str, tuple[str, str]]) -> None:
        """``wording`` gives each step's name and the pattern of its detail."""
        self._wording = wording
        self._observations: list[Observation] = []
        self._recalled: dict = {}
        self._steps: list[tuple[str, str, str, Callable[[dict], dict | list]]] = []

    def watch(self, df: DataFrame, **measures: Column) -> DataFrame:
        """Take aggregate measures of ``df`` when it is written."""
        observation = Observation()
        self._observations.append(observation)
        return df.observe(observation, *[m.alias(name) for name, m in measures.items()])

    def step(
        self,
        step: str,
        before: str,
        after: str,
        parts: Callable[[dict], dict | list] = lambda seen: seen,
    ) -> None:
        """Add a step; ``parts`` picks what its detail shows from all measures.

        A list of parts repeats the pattern, separated by commas.
        """
        self._steps.append((step, before, after, parts))

    @property
    def watches(self) -> int:
        """Number of tables watched so far."""
        return len(self._observations)

    def latest(self) -> dict:
        """Measures of the table watched last; waits for its job."""
        return dict(self._observations[-1].get)

    def recall(self, measures: Mapping[str, int]) -> None:
        """Take in measures of a table that an earlier run wrote."""
        self._recalled.update(measures)

    def measures(self) -> dict:
        """All measures by name; waits for the observed jobs."""
        return self._recalled | {
            name: value
            for observation in self._observations
            for name, value in observation.get.items()
        }

    def table(self, spark: SparkSession) -> DataFrame:
        """The journal, one row per step."""
        seen = self.measures()
        rows = []
        for i, (step, before, after, parts) in enumerate(self._steps, start=1):
            label, pattern = self._wording[step]
            shown = parts(seen)
            shown = shown if isinstance(shown, list) else [shown]
            detail = ", ".join(pattern.format(**part) for part in shown)
            n, m = seen[before], seen[after]
            rows.append((i, label, n, m, m - n, detail))
        return short_table(spark, rows, COLUMNS)
