"""Runs with several outputs that count together or not at all.

A run first writes down what it is about to write (its intent), then every output into a hidden
folder of the attempt, then one commit record with the totals, made in one step. Only after
that the attempt's files are renamed to where readers look. So

* a run that failed before its record leaves nothing that readers see, and its next attempt
  removes what the failed one left;
* a run that failed after its record is finished by whoever comes next, by the same renames;
* a run that has its record is not run again: its totals are returned.

An output is either one folder that all runs add files to, or a folder with one part per run
(``run_id=…``). Spark's readers skip the hidden folders. One driver at a time may work on a run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import SparkSession

from stormledger import files


@dataclass(frozen=True)
class Output:
    path: str
    by_run: bool = False  # a part of its own for each run

    def hidden(self, attempt: str) -> str:
        return f"{self.path}/_attempt-{attempt}"


class RunLog:
    """The intents and commit records below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _record_path(self, run_id: str) -> str:
        return f"{self.root}/commits/{quote(run_id, safe='')}.json"

    def record(self, run_id: str) -> dict | None:
        """What a committed run wrote and counted."""
        path = self._record_path(run_id)
        if not files.exists(self.spark, path):
            return None
        return json.loads(files.read_text(self.spark, path))

    def records(self) -> list[dict]:
        """All committed runs, in order of their ids."""
        folder = f"{self.root}/commits"
        found = [n for n in files.names_in(self.spark, folder) if n.endswith(".json")]
        made = [json.loads(files.read_text(self.spark, f"{folder}/{n}")) for n in found]
        return sorted(made, key=lambda r: r["run_id"])

    def run(
        self,
        run_id: str,
        outputs: Mapping[str, Output],
        write: Callable[[dict[str, str]], dict],
    ) -> dict:
        """Run ``write`` unless the run is committed already, and return its totals.

        ``write`` gets a folder per output that it has to write, and returns the totals.
        """
        done = self.record(run_id)
        if done is None:
            self._discard(run_id)
            attempt = uuid.uuid4().hex
            intent = {
                "run_id": run_id,
                "attempt": attempt,
                "outputs": {n: [o.path.rstrip("/"), o.by_run] for n, o in outputs.items()},
            }
            files.write_once(
                self.spark, f"{self._intents(run_id)}/{attempt}.json", json.dumps(intent)
            )
            totals = write({n: o.hidden(attempt) for n, o in outputs.items()})
            record = intent | {"totals": totals}
            if not files.write_once(self.spark, self._record_path(run_id), json.dumps(record)):
                self._discard(run_id)
            done = self.record(run_id)
        self._publish(done)
        return done["totals"]

    def finish(self) -> None:
        """Show what committed runs wrote, where a run ended before it could."""
        for record in self.records():
            self._publish(record)

    def _intents(self, run_id: str) -> str:
        return f"{self.root}/intents/{quote(run_id, safe='')}"

    def _discard(self, run_id: str) -> None:
        """Remove what attempts without a record have written."""
        done = self.record(run_id)
        for name in files.names_in(self.spark, self._intents(run_id)):
            if not name.endswith(".json"):  # one that was never finished
                continue
            intent = json.loads(files.read_text(self.spark, f"{self._intents(run_id)}/{name}"))
            if done is None or intent["attempt"] != done["attempt"]:
                for path, by_run in intent["outputs"].values():
                    files.remove(self.spark, Output(path, by_run).hidden(intent["attempt"]))
                files.remove(self.spark, f"{self._intents(run_id)}/{name}")

    def _publish(self, record: dict) -> None:
        """Move an attempt's files to where readers look; those moved already stay."""
        for path, by_run in record["outputs"].values():
            hidden = Output(path, by_run).hidden(record["attempt"])
            shown = f"{path}/run_id={quote(record['run_id'], safe='')}" if by_run else path
            for name in files.names_in(self.spark, hidden):
                if not name.startswith(("_", ".")):
                    files.move(self.spark, f"{hidden}/{name}", f"{shown}/{name}")
            files.remove(self.spark, hidden)
