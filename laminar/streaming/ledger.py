"""What the batches of a stream have written: one small file per batch.

An entry names the batch's files and the largest event time seen up to it. It is written
before the files take their places (``done`` false) and again after, so a batch that runs
again knows which files are its own, and touches no others.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession

from laminar.sinks import files


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, batch: int) -> str:
        return f"{self.folder}/b{batch:010d}.json"

    def entry(self, batch: int) -> dict | None:
        text = files.read_text(self.spark, self._path(batch))
        return None if text is None else json.loads(text)

    def write(self, batch: int, **entry) -> None:
        files.publish_text(self.spark, self._path(batch), json.dumps(entry), replace=True)

    def batches(self) -> dict[int, dict]:
        """All entries (one per batch)."""
        found = [int(n[1:-5]) for n in files.names(self.spark, self.folder) if n.startswith("b") and n.endswith(".json")]
        return {b: self.entry(b) for b in found}

    def latest_time(self, batch: int) -> dt.datetime | None:
        """The largest event time of the batches before ``batch``."""
        before = self.entry(batch - 1)
        return dt.datetime.fromisoformat(before["latest"]) if before and before.get("latest") else None

    def later(self, batch: int, seen: dt.datetime | None) -> str | None:
        """``latest`` of a batch that saw event times up to ``seen``."""
        times = [t for t in (self.latest_time(batch), seen) if t is not None]
        return max(times).isoformat() if times else None
