"""What a run of a load has finished, kept so that a failed run is taken up where it stopped."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import SparkSession

from starlog.session import file_system


class RunLedger:
    """The finished steps of one run below `path`, a file for each, which holds what the step returned."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        if not re.fullmatch(r"[\w.-]+", run):
            raise ValueError(f"a run's name is made of letters, digits, dots and dashes: {run}")
        self.spark, self.path = spark, f"{path}/{run}"

    def _place(self, step: str) -> str:
        return f"{self.path}/{step}"

    def finished(self) -> list[str]:
        """The names of the finished steps."""
        fs, location = file_system(self.spark, self.path)
        names = [status.getPath().getName() for status in fs.listStatus(location)] if fs.exists(location) else []
        return sorted(name for name in names if not name.startswith("."))

    def step(self, name: str, run: Callable[[], object]) -> object:
        """What the step returned (JSON), running it only if no earlier try of this run finished it."""
        fs, done = file_system(self.spark, self._place(name))
        if fs.exists(done):
            return json.loads(self.spark.read.text(self._place(name), wholetext=True).first()["value"])
        result = run()
        # written whole under another name first, so that a file that exists is complete
        _, draft = file_system(self.spark, self._place(f".{name}"))
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(result).encode()))
        out.close()
        fs.rename(draft, done)
        return result

    def forget(self) -> None:
        """Let every step run again."""
        fs, location = file_system(self.spark, self.path)
        fs.delete(location, True)
