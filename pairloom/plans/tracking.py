"""Times of stages and measured figures, written after each event."""

from __future__ import annotations

import resource
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pairloom.sources.files import write_json


class Tracker:
    def __init__(self, path: str | None = None):
        self.path, self.log = path, {"stages": {}, "metrics": {}}

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = time.time()
        try:
            yield
        finally:
            peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
            self.log["stages"][name] = {"seconds": round(time.time() - began, 2), "driver_peak_mb": round(peak, 1)}
            self.flush()

    def record(self, key: str, value: object) -> None:
        self.log["metrics"][key] = value
        self.flush()

    def flush(self) -> None:
        if self.path:
            write_json(self.log, self.path)
