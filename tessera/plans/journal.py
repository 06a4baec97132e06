"""Run journal: what a job has finished, so that a rerun goes on from there.

A journal lies in a shared folder, one subfolder for each set of parameters and version of
the input. Entries are small JSON files, each written beside its place and renamed into it, so an
entry is either there whole or not at all. Tables and models lie in the same subfolder; an
entry is made after they are written.
"""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import SparkSession

from tessera.session import remove_path
from tessera.sources import sinks


class Journal:
    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/{hashlib.sha256(key.encode()).hexdigest()[:32]}"

    def path(self, name: str) -> str:
        """Place of a table or model of this run."""
        return f"{self.folder}/{name}"

    def get(self, name: str) -> Any:
        """The value of an entry, None where there is none."""
        text = sinks.read_text(self.spark, self.path(f"{name}.json"))
        return None if text is None else json.loads(text)

    def put(self, name: str, value: Any) -> None:
        sinks.write_text(self.spark, self.path(f"{name}.json"), json.dumps(value))

    def clear(self) -> None:
        remove_path(self.spark, self.folder)
