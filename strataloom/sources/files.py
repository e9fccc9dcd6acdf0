"""Readers: typed CSV, JSON, Parquet, text and period files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Tables:
    """Parquet tables of one folder, as attributes: `Tables(spark, d).orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """Path for a stream: as a glob it may name one file as well as a folder of files."""
        return f"{self.folder}/{{{name}}}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]


def input_state(df: DataFrame) -> tuple:
    """Path, size and time of change of every file that a frame reads."""
    hadoop = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in sorted(df.inputFiles()):
        path = hadoop.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        found.append((name, status.getLen(), status.getModificationTime()))
    return tuple(found)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred by one extra scan.

    A row that does not fit a given schema fails the read instead of turning
    into NULLs.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """JSON lines, or one JSON array per file with `multi_line`.

    A multi-line file cannot be split, so large exports should use JSON lines.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def flatten(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Pick nested fields by path: `{"city": "address.city"}`."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def parse_payload(col: str | Column, schema: str) -> Column:
    """JSON text to a struct; unreadable text gives NULL fields."""
    return F.from_json(F.col(col) if isinstance(col, str) else col, schema)


def first_element(col: str | Column, default) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(default))


def first_map_key(col: str | Column, default) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_element_at(F.map_keys(c), F.lit(1)), F.lit(default))


def arrays_to_rows(df: DataFrame, arrays: dict[str, str | Column], keep: list[str]) -> DataFrame:
    """One row per position of arrays that run in parallel, one array per column."""
    zipped = F.arrays_zip(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in arrays.items()])
    return df.select(*keep, F.explode(zipped).alias("_item")).select(*keep, *[F.col("_item")[n].alias(n) for n in arrays])


def read_period_files(spark: SparkSession, paths: list[str], pattern: str, period: str, schema: str | None = None) -> DataFrame:
    """Read many period files as one table, with the period taken from each file name."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    stamp = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return reader.parquet(*paths).withColumn(period, stamp)


def preview(df: DataFrame, rows: int) -> DataFrame:
    """Some rows of a new source; the limit is the feature."""
    return df.limit(rows)


def schema_rows(df: DataFrame) -> DataFrame:
    """Column names, types and positions of a source, with its row count."""
    fields = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type")) for i, f in enumerate(df.schema.fields, 1)])
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select("row_count", F.inline(fields)).select("position", "column_name", "data_type", "row_count")
