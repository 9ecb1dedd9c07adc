"""Tables, operations and the canonical change log.

A log is a DataFrame with one row per log record: the key and regular columns of the base table, and

    cdc_operation      what the record is (see `Op`)
    cdc_deleted_<c>    boolean, optional: the change set regular column c to null
    cdc_deleted_elements_<c>  optional: elements removed from collection c

and the columns that identify a change and order the records of a row; operators take their names.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from enum import IntEnum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Op(IntEnum):
    PRE_IMAGE = 0
    ROW_UPDATE = 1
    ROW_INSERT = 2
    ROW_DELETE = 3
    PARTITION_DELETE = 4
    ROW_RANGE_DELETE_INCLUSIVE_LEFT = 5
    ROW_RANGE_DELETE_EXCLUSIVE_LEFT = 6
    ROW_RANGE_DELETE_INCLUSIVE_RIGHT = 7
    ROW_RANGE_DELETE_EXCLUSIVE_RIGHT = 8
    POST_IMAGE = 9


OPERATION = "cdc_operation"


@dataclass(frozen=True)
class TableSpec:
    """A base table: key columns (partition, then clustering) and regular columns, in schema order."""

    keyspace: str
    name: str
    pk: tuple[str, ...]
    ck: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()

    @property
    def key(self) -> tuple[str, ...]:
        return (*self.pk, *self.ck)

    @property
    def full_name(self) -> str:
        return f"{self.keyspace}.{self.name}"

    def with_columns(self, *columns: str) -> TableSpec:
        return replace(self, columns=columns)

    def with_key(self, pk: tuple[str, ...], ck: tuple[str, ...]) -> TableSpec:
        return replace(self, pk=pk, ck=ck)

    def change_operations(self) -> list[int]:
        """Operations that become events: a partition delete is one only where a partition is a single row."""
        return [Op.ROW_UPDATE, Op.ROW_INSERT, Op.ROW_DELETE, *([] if self.ck else [Op.PARTITION_DELETE])]

    def image(self, available: list[str]) -> Column:
        """A record's cells as a struct, with the deletion marks that the log has."""
        extra = [f"{p}{c}" for c in self.columns for p in ("cdc_deleted_", "cdc_deleted_elements_") if f"{p}{c}" in available]
        return F.struct(*self.key, *self.columns, F.col(OPERATION).alias("_op"), *extra)
