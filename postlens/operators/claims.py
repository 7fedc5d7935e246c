"""Claims on windows, so that of several drivers one copies each window.

A claim is a file created only where there is none. It names its owner and when it ends; a claim that
has ended belongs to a driver that died, and goes to whoever moves it away first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from postlens.sinks import commits


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Claims:
    """Claims of one owner below ``root``; each holds for ``lifetime``, longer than a window takes."""

    spark: SparkSession
    root: str
    lifetime: timedelta = timedelta(hours=6)
    owner: str = field(default_factory=lambda: uuid.uuid4().hex)
    clock: Callable[[], datetime] = _now

    def _path(self, window: str) -> str:
        return f"{self.root}/{window}.json"

    def _claim(self, window: str) -> dict | None:
        text = commits.read_text(self.spark, self._path(window))
        return None if text is None else json.loads(text)

    def take(self, window: str) -> bool:
        """Claim a window, or not, where another owner has it."""
        ends = (self.clock() + self.lifetime).isoformat()
        claim = json.dumps({"owner": self.owner, "ends": ends})
        if commits.publish(self.spark, self._path(window), claim):
            return True
        found = self._claim(window)
        if found is not None and datetime.fromisoformat(found["ends"]) >= self.clock():
            return False
        # One of those who see the dead claim moves it; the others find it gone, or a new one.
        try:
            commits.move(self.spark, self._path(window), f"{self.root}/.ended-{uuid.uuid4().hex}")
        except Exception:  # noqa: BLE001  stores differ in what they raise for a missing file
            if self._claim(window) is not None:
                return False
        return commits.publish(self.spark, self._path(window), claim)

    def holds(self, window: str) -> bool:
        """Whether this owner's claim still stands."""
        found = self._claim(window)
        return found is not None and found["owner"] == self.owner

    def release(self, window: str) -> None:
        if self.holds(window):
            commits.remove(self.spark, self._path(window))
