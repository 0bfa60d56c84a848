"""How far a run has come, kept as properties of its tables.

A finished layer is marked with the load it belongs to: a digest of the input's listing and of the dataset's rules, and a
number that is new with every bronze table. A later run takes a layer as it is if its mark is the one it looks
for, so never one that was made from other files, by other rules, or from a bronze table of before.
"""

from __future__ import annotations

import hashlib
from uuid import uuid4

from pyspark.sql import SparkSession

from tierwork.sources.tables import set_table_property, table_property
from tierwork.spec import DatasetSpec

MARK = "tierwork.load"


class Progress:
    """The marks of one run. ``listing`` is the digest of the files it reads; with ``resume`` it goes on with the
    load that the bronze table has, if that is of the same files and rules."""

    def __init__(self, spark: SparkSession, spec: DatasetSpec, listing: int, resume: bool):
        self._spark, self._spec = spark, spec
        load = f"{listing}:{hashlib.sha256(repr(spec).encode()).hexdigest()}"
        found = table_property(spark, spec.table("bronze"), MARK) if resume else None
        self.resumed = bool(found) and found.rpartition(":")[0] == load
        self._mark = found if self.resumed else f"{load}:{uuid4().hex}"

    def done(self, layer: str, step: str = "") -> bool:
        """Whether the table of a layer, or a ``step`` noted on it, is complete and of this load."""
        return self.resumed and table_property(self._spark, self._spec.table(layer), MARK + step) == self._mark

    def mark(self, layer: str, step: str = "") -> None:
        set_table_property(self._spark, self._spec.table(layer), MARK + step, self._mark)

    def note(self, layer: str, key: str, value: str) -> None:
        set_table_property(self._spark, self._spec.table(layer), f"{MARK}.{key}", value)

    def noted(self, layer: str, key: str) -> str | None:
        return table_property(self._spark, self._spec.table(layer), f"{MARK}.{key}")
