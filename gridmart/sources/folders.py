"""Folders of partitioned tables: what their names say, and exchanging them as a whole.

Only names are read and moved here, one call for each folder of a month; rows never pass.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import suppress

from pyspark.sql import SparkSession

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_JOURNAL = "_exchange"


class Folders:
    """The file system of a table's folder, by whatever scheme the path has."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)

    def matching(self, pattern: str) -> list[str]:
        """Names under the root that match a pattern, in order."""
        prefix = len(self.at("").toUri().getPath().rstrip("/")) + 1
        found = self._fs.globStatus(self.at(pattern))
        return [x.getPath().toUri().getPath()[prefix:] for x in found or []]

    def move(self, old: str, new: str) -> None:
        self._fs.mkdirs(self.at(new).getParent())
        if not self._fs.rename(self.at(old), self.at(new)):
            raise OSError(f"Cannot move {self.root}/{old} to {self.root}/{new}")

    def write(self, name: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        out = self._fs.create(self.at(f"{name}.part"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(f"{name}.part", name)

    def read(self, name: str) -> str:
        source = self._fs.open(self.at(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


def partition_values(spark: SparkSession, path: str, by: Sequence[str]) -> list[tuple[str | None, ...]]:
    """The values of the partition columns of a table, one tuple for each folder, from the folders' names."""
    names = Folders(spark, path).matching("/".join(f"{column}=*" for column in by))
    values = [tuple(part.split("=", 1)[1] for part in name.split("/")) for name in names]
    return [tuple(None if v == NO_VALUE else v for v in row) for row in values]


# --- exchanging folders ------------------------------------------------------


def new_exchange(tables: Folders, table: str) -> str:
    """A folder beside ``table`` for rows that are to replace some of its folders."""
    return f"{_JOURNAL}-{table}-{uuid.uuid4().hex[:12]}"


def _step(tables: Folders, table: str, exchange: str, folder: str, filled: bool) -> None:
    """Move the old folder aside and the new one in; repeating a finished step does nothing."""
    new, old, aside = f"{exchange}/new/{folder}", f"{table}/{folder}", f"{exchange}/old/{folder}"
    if filled and not tables.exists(new):
        return
    if tables.exists(old):
        tables.move(old, aside)
    if filled:
        tables.move(new, old)


def _undo(tables: Folders, table: str, exchange: str, folder: str, filled: bool) -> None:
    new, old, aside = f"{exchange}/new/{folder}", f"{table}/{folder}", f"{exchange}/old/{folder}"
    if filled and not tables.exists(new) and tables.exists(old):
        tables.move(old, new)
    if tables.exists(aside):
        tables.move(aside, old)


def exchange_folders(tables: Folders, table: str, exchange: str, folders: Sequence[str]) -> None:
    """Put the folders under ``exchange/new`` in the place of ``folders`` of the table, all or none.

    ``folders`` without new rows go. The journal is written before the first move. An error puts back
    what was moved and is raised; a process that dies leaves a journal, by which
    :func:`finish_exchanges` goes on to the end.
    """
    plan = [(folder, tables.exists(f"{exchange}/new/{folder}")) for folder in folders]
    tables.write(f"{exchange}/plan", json.dumps(plan))
    try:
        for folder, filled in plan:
            _step(tables, table, exchange, folder, filled)
    except Exception:
        for folder, filled in reversed(plan):
            _undo(tables, table, exchange, folder, filled)
        tables.delete(exchange)
        raise
    tables.delete(exchange)


def finish_exchanges(tables: Folders, table: str) -> None:
    """Finish the exchanges of a table that were cut off, and drop those that had not begun to move folders."""
    for exchange in tables.matching(f"{_JOURNAL}-{table}-*"):
        if tables.exists(f"{exchange}/plan"):
            for folder, filled in json.loads(tables.read(f"{exchange}/plan")):
                _step(tables, table, exchange, folder, filled)
        tables.delete(exchange)


def drop_exchange(tables: Folders, exchange: str) -> None:
    with suppress(Exception):  # the error that led here counts
        tables.delete(exchange)
