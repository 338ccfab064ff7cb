"""A run ledger that several drivers share (K4, U2): one record per data set.

Before a driver trains a data set it claims it, by making a file that only one
caller can make.  It keeps the claim fresh while it works; a claim nobody has
touched for a while belonged to a driver that died, and the next claim, by number,
may be made.  The record is published as a whole under the data set's own
name, which also only one caller can do: even if a driver that was thought dead
comes back, each set is recorded once.
"""

from __future__ import annotations

import csv
import hashlib
import io
import threading
import time

from pyspark.sql import SparkSession

from centrix.sources.fs import list_names, path_exists, publish, remove, seconds_since_change, touch

# Seconds between two signs of life, and without any until a claim is void.
BEAT = 5.0
STALE = 60.0


class Ledger:
    """Claims beside, and records in, the folder of a history table."""

    def __init__(self, spark: SparkSession, path: str, beat: float = BEAT, stale: float = STALE):
        self.spark, self.path, self.beat, self.stale = spark, path.rstrip("/"), beat, stale

    def _name(self, dataset: str) -> str:
        return hashlib.sha256(dataset.encode()).hexdigest()[:32]

    def _claims(self, dataset: str) -> list[str]:
        folder = f"{self.path}.claims"
        if not path_exists(self.spark, folder):
            return []
        return [f"{folder}/{n}" for n in list_names(self.spark, folder) if n.startswith(self._name(dataset) + ".")]

    def recorded(self, dataset: str) -> bool:
        return path_exists(self.spark, f"{self.path}/record-{self._name(dataset)}.csv")

    def claim(self, dataset: str) -> str | None:
        """The path of a new claim, or None while another driver works on it."""
        held = self._claims(dataset)
        if held:
            age = seconds_since_change(self.spark, held[-1])
            if age is not None and age < self.stale:
                return None
        path = f"{self.path}.claims/{self._name(dataset)}.{len(held) + 1:06d}"
        return path if publish(self.spark, path, dataset) else None

    def release(self, claim: str) -> None:
        """Give a claim up: it counts as stale from now on."""
        remove(self.spark, claim)

    def record(self, dataset: str, header: list[str], row: list) -> bool:
        """Publish the data set's record; False if it has one already."""
        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerows([header, row])
        return publish(self.spark, f"{self.path}/record-{self._name(dataset)}.csv", text.getvalue())

    def work(self, claim: str, fn):
        """``fn()`` while the claim is kept fresh; a failure gives it up."""
        done = threading.Event()

        def beat() -> None:
            while not done.wait(self.beat):
                touch(self.spark, claim)

        sign = threading.Thread(target=beat, daemon=True)
        sign.start()
        try:
            return fn()
        except BaseException:
            self.release(claim)
            raise
        finally:
            done.set()
            sign.join()

    def wait(self) -> None:
        time.sleep(min(self.beat, 0.5))
