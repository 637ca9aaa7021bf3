"""Tables that grow run by run, as segments in levels.

A run adds one segment of level 0. When a level has ``fanout`` segments they are merged into one
of the next level, so a row is rewritten a few times at most and the number of segments grows with
the logarithm of the number of runs. A segment's parts count together, by one commit record (see
``sinks.commits``), and a run that is repeated adds nothing. One driver at a time may add.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from stormledger import files
from stormledger.sinks.commits import Output, RunLog

FANOUT = 4


@dataclass(frozen=True)
class Segment:
    run_id: str
    level: int
    totals: dict


class Segments:
    """The segments below one folder. ``parts`` are the tables that a segment consists of, and
    ``extra`` those that a run adds but merges leave alone."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        parts: Sequence[str],
        extra: Sequence[str] = (),
        fanout: int = FANOUT,
    ):
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout
        self.parts, self.extra = tuple(parts), tuple(extra)
        self.log = RunLog(spark, f"{self.root}/log")

    def add(self, run_id: str, write: Callable[[dict[str, str]], dict]) -> dict:
        """Add a run's segment. ``write`` gets a folder for each part and returns totals."""
        return self._run(run_id, (*self.parts, *self.extra), 0, [], write)

    def _run(
        self,
        run_id: str,
        parts: Sequence[str],
        level: int,
        replaces: list[str],
        write: Callable[[dict[str, str]], dict],
    ) -> dict:
        outputs = {n: Output(f"{self.root}/{n}", by_run=True) for n in parts}
        place = {"level": level, "replaces": replaces}
        return self.log.run(run_id, outputs, lambda folder: write(folder) | place)

    def live(self) -> list[Segment]:
        """The segments that make up the table now."""
        made, gone = [], set()
        for record in self.log.records():
            made.append(Segment(record["run_id"], record["totals"]["level"], record["totals"]))
            gone.update(record["totals"]["replaces"])
        return [s for s in made if s.run_id not in gone]

    def path(self, part: str, run_id: str) -> str:
        return f"{self.root}/{part}/run_id={quote(run_id, safe='')}"

    def read(self, part: str, run_ids: Sequence[str], ddl: str) -> DataFrame:
        """A part of some segments; one without rows may have no files."""
        paths = [self.path(part, r) for r in run_ids]
        found = self.spark.createDataFrame([], ddl)
        for path in paths:
            if files.exists(self.spark, path):
                found = found.unionByName(self.spark.read.schema(ddl).parquet(path))
        return found

    def merge_levels(self, write: Callable[[list[str], dict[str, str]], dict]) -> None:
        """Merge full levels, lowest first, and drop what committed merges have replaced.

        ``write`` gets the ids of the segments to merge, and a folder for each part.
        """
        level = 0
        while True:
            live = self.live()
            if not any(s.level >= level for s in live):
                break
            full = sorted(s.run_id for s in live if s.level == level)
            if len(full) >= self.fanout:
                name = hashlib.sha256("\n".join(full).encode()).hexdigest()[:16]
                self._run(
                    f"_merged-{name}", self.parts, level + 1, full, lambda folder: write(full, folder)
                )
            level += 1
        for record in self.log.records():
            for run_id in record["totals"]["replaces"]:
                for part in self.parts:
                    files.remove(self.spark, self.path(part, run_id))
