"""Parquet tables of the clip catalogue with insert, upsert and schema evolution."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import new_rows, upsert
from ..schemas import TABLES


#: Versions of a table that stay for readers that began with them.
VERSIONS = 3
_DONE = "\n.\n"


class Catalog:
    """Tables under ``root``.

    A write makes a new folder, then a pointer file with the next number that names it. Readers take the highest
    pointer that is complete, so they see all of a write or nothing, at every moment and after a crash. Pointers are
    created only where none is: of two writers that began with one version the later fails with FileExistsError and
    loses nothing of the other's. The last VERSIONS versions stay.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _pointers(self, table: str) -> list[int]:
        fs, p = self._fs(f"{self.root}/{table}")
        names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.removeprefix("CURRENT-")) for n in names if n.startswith("CURRENT-"))

    def _named(self, table: str, number: int) -> str | None:
        """The folder that a pointer names; none where its writer didn't come to the end."""
        fs, p = self._fs(f"{self.root}/{table}/CURRENT-{number:012d}")
        source = fs.open(p)
        text = bytes(source.readAllBytes()).decode()
        source.close()
        return text.removesuffix(_DONE) if text.endswith(_DONE) else None

    def version(self, table: str) -> tuple[int, str | None]:
        """(number of the last pointer, folder of the last complete one)."""
        numbers = self._pointers(table)
        return (numbers[-1] if numbers else 0), next((at for n in reversed(numbers) if (at := self._named(table, n))), None)

    def read(self, table: str) -> DataFrame:
        """The table, empty if it was never written; columns that older files lack are null."""
        return self._rows(table, self.version(table)[1])

    def _rows(self, table: str, at: str | None) -> DataFrame:
        empty = self.spark.createDataFrame([], TABLES[table][0])
        return self.spark.read.schema(empty.schema).parquet(at) if at else empty

    def replace(self, table: str, rows: DataFrame, after: int | None = None) -> None:
        """Makes rows the table; ``after`` is the number of the version that they were made from."""
        empty = self.spark.createDataFrame([], TABLES[table][0])
        number = (self.version(table)[0] if after is None else after) + 1
        at = f"{self.root}/{table}/v-{uuid.uuid4().hex}"
        rows.select(*(F.col(f.name).cast(f.dataType) for f in empty.schema)).write.parquet(at)
        fs, pointer = self._fs(f"{self.root}/{table}/CURRENT-{number:012d}")
        try:
            out = fs.create(pointer, False)
        except Py4JJavaError as e:
            fs.delete(self._fs(at)[1], True)
            raise FileExistsError(f"{table} was written by someone else meanwhile") from e
        out.write(bytearray((at + _DONE).encode()))
        out.close()
        for old in self._pointers(table)[:-VERSIONS]:
            if folder := self._named(table, old):
                fs.delete(self._fs(folder)[1], True)
            fs.delete(self._fs(f"{self.root}/{table}/CURRENT-{old:012d}")[1], False)

    def insert_new(self, table: str, rows: DataFrame) -> None:
        """Adds rows whose key isn't there."""
        number, at = self.version(table)
        old = self._rows(table, at)
        self.replace(table, old.unionByName(new_rows(rows, old, TABLES[table][1]).select(*old.columns)), number)

    def upsert(self, table: str, rows: DataFrame) -> None:
        """Adds rows, in place of those with equal keys."""
        number, at = self.version(table)
        old = self._rows(table, at)
        self.replace(table, upsert(old, rows.select(*old.columns), TABLES[table][1]), number)
