"""Steps that are done, so that a run that died goes on from the last of them.

A step is recorded behind its table: a small file with the run's fingerprint, the
table's columns and what was measured while it was written. A table without its record was
not finished and is written again. The fingerprint covers names, sizes and times of the
input files, their columns and the run's parameters; with another one nothing is taken up.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from wardflow.plans.journal import Journal
from wardflow.sources.tables import hand_off
from wardflow.sources.versions import Folder

RECORDS = "_ledger"


def files_read(df: DataFrame) -> list[str]:
    """Files of the relations in a plan, also behind rows that are cached now."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set(df.inputFiles())
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            found.update(leaf.relation().location().inputFiles())
    return sorted(found)


def fingerprint(df: DataFrame, **parameters) -> str:
    """Of the files ``df`` reads and of parameters; no row is read."""
    files = files_read(df)
    if not files:
        raise ValueError("only a run that reads files can be taken up again")
    by_folder: dict[str, set[str]] = defaultdict(set)
    for path in files:
        parent, _, name = path.rpartition("/")
        by_folder[parent].add(name)
    digest = hashlib.sha256()
    for parent in sorted(by_folder):
        folder = Folder(df.sparkSession, parent)
        for status in sorted(
            (s.getPath().getName(), s.getLen(), s.getModificationTime())
            for s in folder.files.listStatus(folder.at())
        ):
            if status[0] in by_folder[parent]:
                digest.update(json.dumps([parent, *status]).encode())
    digest.update(json.dumps([df.schema.json(), parameters], sort_keys=True, default=str).encode())
    return digest.hexdigest()


class Ledger:
    """Tables of one run in its folder; without a fingerprint nothing is recorded."""

    def __init__(self, spark: SparkSession, path: str, run: str | None, journal: Journal):
        self.spark, self.path, self.run, self.journal = spark, path.rstrip("/"), run, journal
        self.folder = Folder(spark, path)

    def entry(self, name: str) -> dict | None:
        """A step's record, if this run has done it."""
        if self.run is None or f"{name}.json" not in self.folder.names(RECORDS):
            return None
        try:
            found = json.loads(self.folder.read(f"{RECORDS}/{name}.json"))
        except ValueError:  # the run died while it wrote the record
            return None
        return found if found["run"] == self.run else None

    def step(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step, built only if it was not done before.

        The journal's watch, if ``build`` sets one, is recorded with it.
        """
        path = f"{self.path}/{name}"
        found = self.entry(name)
        if found is not None:
            self.journal.recall(found["measures"])
            schema = T.StructType.fromJson(json.loads(found["schema"]))
            return self.spark.read.schema(schema).parquet(path)
        self.folder.delete(f"{RECORDS}/{name}.json")
        watches = self.journal.watches
        written = hand_off(build(), path)
        if self.run is not None:
            measures = self.journal.latest() if self.journal.watches > watches else {}
            self.folder.create(f"{RECORDS}/{name}.json", json.dumps(
                {"run": self.run, "schema": written.schema.json(), "measures": measures}))
        return written
