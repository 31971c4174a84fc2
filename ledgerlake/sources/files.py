"""CSV, JSON and catalog readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ddl

CSV_LAYOUT = {"header": True, "sep": ",", "quote": '"', "escape": '"'}
# An unquoted empty field is NULL, a quoted one is empty text. The reader would turn the latter into NULL as well if
# the null marker were empty, so it is set to a character that text from a database cannot hold.
CSV_READ = CSV_LAYOUT | {"nullValue": "\u0000", "emptyValue": ""}
CSV_WRITE = CSV_LAYOUT | {"nullValue": "", "emptyValue": '""'}


def read_csv(spark: SparkSession, path: str, columns: dict[str, str], multi_line: bool = False) -> DataFrame:
    """Rows of CSV files. An unreadable value or a row of the wrong width stops the job.

    ``multi_line`` allows line breaks in quoted fields; a file is then read by one task.
    """
    options = CSV_READ | {"mode": "FAILFAST", "multiLine": multi_line}
    return spark.read.options(**options).schema(ddl(columns)).csv(path)


def read_json_lines(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """One object per line; a broken line stops the job."""
    return spark.read.option("mode", "FAILFAST").schema(ddl(columns)).json(path)


def explode_object(document: Column, root: str | None = None) -> Column:
    """Generator of (key, value) for a JSON object, or for the object under ``root``; a missing root gives no rows."""
    strict = {"mode": "FAILFAST"}
    if root is None:
        return F.explode(F.from_json(document, "map<string,string>", strict))
    return F.explode(F.from_json(document, f"`{root}` map<string,string>", strict).getField(root))


def read_json_object(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """One JSON object per file, any layout, as rows ``key, value, file_name``.

    A file is one record here, so this is for reference data of modest size; see ``read_flat_label_object``.
    """
    return (
        spark.read.text(path, wholetext=True)
        .select("value", F.col("_metadata.file_name").alias("file_name"))
        .where(F.col("value").rlike(r"\S"))
        .withColumn("value", F.when(F.col("value").rlike(r"(?s)^\s*\{.*\}\s*$"), F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit("not a whole JSON object: "), F.col("file_name")))
        ))
        .select(explode_object(F.col("value"), root), "file_name")
    )


# The three shapes of a piece of `{"<root>": {"<number>": "<text>", ...}}` cut at every `",`.
_HEAD = r'^\s*(?:\{\s*"ROOT"\s*:\s*\{)?\s*'
_ENTRY = r'"(-?[0-9]+)"\s*:\s*"([^"\\]*)'
_TAIL = r'(?:"\s*\}\s*\}\s*)?$'
_EMPTY = r'^\s*\{\s*("ROOT"\s*:\s*\{\s*\}\s*)?\}\s*$'


def read_flat_label_object(spark: SparkSession, path: str, root: str = "target") -> DataFrame:
    """The same rows as ``read_json_object`` for a huge ``{"target": {"<id>": "<label>", ...}}`` file.

    The file is split between entries instead of at line ends, so many tasks read one file. A piece that is not
    exactly one plain entry (escaped text, further nesting, other top-level keys) stops the job rather than being
    skipped; such files need ``read_json_object``.
    """
    entry = (_HEAD + _ENTRY + _TAIL).replace("ROOT", root)
    pieces = spark.read.text(path, lineSep='",').select("value", "_metadata.file_name", "_metadata.file_path")
    # A file that was cut off has no closing braces, two that ran together have them twice. The check is one row for all
    # pieces, combined before its shuffle; the pieces themselves stay where they are read.
    opens = F.col("value").rlike(r'^\s*\{')
    closes = F.col("value").rlike(r"\}\s*$")
    ends = pieces.groupBy("file_path").agg(F.count_if(opens).alias("heads"), F.count_if(closes).alias("tails"))
    broken = ends.where("heads != 1 or tails != 1").agg(F.min("file_path")).scalar()
    stop = F.raise_error(F.concat(F.lit("not one whole object: "), broken)).cast("boolean")
    pieces = pieces.where(F.when(broken.isNull(), True).otherwise(stop)).select("value", "file_name")
    filled = pieces.where(~F.col("value").rlike(_EMPTY.replace("ROOT", root)))
    complaint = F.raise_error(F.concat(F.lit("not a plain label entry: "), F.substring("value", 1, 200)))
    return filled.select(
        F.when(F.col("value").rlike(entry), F.regexp_extract("value", entry, 1)).otherwise(complaint).alias("key"),
        F.regexp_extract("value", entry, 2).alias("value"),
        "file_name",
    )
