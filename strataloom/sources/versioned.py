"""Tables by day whose days are replaced in one step.

Rows are written aside, into `data/<day>/commit_id=<new>`; then a numbered file
in `log/` names the folders that count from now on. Readers take the folders of
the last number, so they see the table before or after a replacement, never a
day without its rows, and a write that fails leaves nothing but folders that no
list names. A replacement that began from a list which is no longer the last
one is refused. A list may carry marks, such as the last batch of a stream.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "commit_id"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Changed(RuntimeError):
    """Another writer replaced days in the meantime."""


class DayTable:
    """A table at `path` with one folder per value of `day`; rows have the columns of `schema`."""

    def __init__(self, spark: SparkSession, path: str, day: str, schema: T.StructType):
        if COMMIT in schema.names:
            raise ValueError(f"{COMMIT} is the name of the table's own column")
        self.spark, self.path, self.day, self.schema = spark, path.rstrip("/"), day, schema
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._hadoop.Path(self.path).getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        found = self._files.globStatus(self._hadoop.Path(f"{self.path}/log/*.json")) or []
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found)

    def _list(self, number: int) -> dict:
        stream = self._files.open(self._hadoop.Path(f"{self.path}/log/{number:012d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> tuple[int, dict]:
        """Number and content of the last list; 0 and an empty one for a new table."""
        numbers = self._numbers()
        return (numbers[-1], self._list(numbers[-1])) if numbers else (0, {"folders": [], "marks": {}})

    def mark(self, name: str) -> int | None:
        return self.last()[1]["marks"].get(name)

    def folder(self, day: dt.date | None) -> str:
        return f"{self.day}={NO_DAY if day is None else day}"

    def read(self, days: Iterable[dt.date | None] | None = None, number: int | None = None) -> DataFrame:
        """All rows, or those of some days, as of the last list or an earlier one."""
        listed = (self.last()[1] if number is None else self._list(number))["folders"]
        if days is not None:
            wanted = {self.folder(d) for d in days}
            listed = [f for f in listed if f.split("/")[0] in wanted]
        if not listed:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(COMMIT, T.StringType())]))
        return reader.option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{f}" for f in listed]).select(self.schema.names)

    def replace(self, rows: DataFrame, days: Iterable[dt.date | None] | None = None, marks: Mapping[str, int] | None = None, after: int | None = None) -> int:
        """Replace `days` (if not given, those that occur in `rows`) by the rows; returns the number of the new list.

        Days without rows end empty; rows of other days than those given are an
        error. `rows` may read this table. `after` is the list the rows were
        made from, by default the last one at the beginning of the write.
        """
        number, before = self.last()
        if after is not None and after != number:
            raise Changed(f"list {number} is there, the rows were made from {after}")
        commit = uuid.uuid4().hex
        named = rows.select(self.schema.names).withColumn(COMMIT, F.lit(commit)).hint("rebalance", self.day)
        named.write.mode("append").partitionBy(self.day, COMMIT).parquet(f"{self.path}/data")
        written = self._files.globStatus(self._hadoop.Path(f"{self.path}/data/*/{COMMIT}={commit}")) or []
        new = [f"{f.getPath().getParent().getName()}/{f.getPath().getName()}" for f in written]
        gone = {f.split("/")[0] for f in new} if days is None else {self.folder(d) for d in days}
        if strange := sorted({f.split("/")[0] for f in new} - gone):
            raise ValueError(f"rows outside the days to replace: {strange[:3]}")
        folders = [f for f in before["folders"] if f.split("/")[0] not in gone] + new
        self._publish(number + 1, {"folders": sorted(folders), "marks": before["marks"] | dict(marks or {})})
        return number + 1

    def _publish(self, number: int, content: dict) -> None:
        """Write a list beside its name, then give it the name; that fails if the name is taken."""
        aside = self._hadoop.Path(f"{self.path}/log/.{uuid.uuid4().hex}")
        out = self._files.create(aside, False)
        out.write(bytearray(json.dumps(content), "utf-8"))
        out.close()
        name = self._hadoop.Path(f"{self.path}/log/{number:012d}.json")
        options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            self._hadoop.FileContext.getFileContext(name.toUri(), self._conf).rename(aside, name, options)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise Changed(f"list {number} was written by another job") from error
            raise

    def vacuum(self, keep: int = 1) -> int:
        """Delete folders and lists that the last `keep` lists do not need; returns how many folders went.

        Not to be run beside a write: folders that are not listed yet would go.
        """
        numbers = self._numbers()
        kept = {f for n in numbers[-keep:] for f in self._list(n)["folders"]}
        all_ = self._files.globStatus(self._hadoop.Path(f"{self.path}/data/*/{COMMIT}=*")) or []
        gone = [f.getPath() for f in all_ if f"{f.getPath().getParent().getName()}/{f.getPath().getName()}" not in kept]
        for folder in gone:
            self._files.delete(folder, True)
        for n in numbers[:-keep]:
            self._files.delete(self._hadoop.Path(f"{self.path}/log/{n:012d}.json"), False)
        return len(gone)


def replace_days(table: DayTable, rows: DataFrame, start: dt.date, end: dt.date) -> int:
    """Delete the days of a range and insert those of `rows`, as one step; a day without new rows ends empty."""
    days = [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]
    return table.replace(rows.where(F.col(table.day).between(F.lit(start), F.lit(end))), days)
