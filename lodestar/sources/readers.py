"""File sources S1-S8: text lines, delimited files and tagged documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.functions import text as T


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (bz2/gzip decoded by Hadoop codecs)."""
    return spark.read.text(path)


def delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
              header: bool = False, sep: str = ",", infer: bool = False) -> DataFrame:
    """CSV with an explicit schema (preferred), a header, or inference."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def delimited_checked(spark: SparkSession, path: str, schema: str, header: bool = False, sep: str = ",") -> DataFrame:
    """S2-S4 with a column of rejected lines: the columns of ``schema`` and ``rejected``, the raw
    line where it doesn't fit (too few or too many fields, a field of another type), else null.
    ``rejected`` depends on every column, so whoever reads it gets lines judged whole, whatever else is
    selected.  Compressed files are read by Hadoop's codecs; bz2 is split like plain text."""
    raw = (spark.read.schema(f"{schema}, _raw_line string").option("columnNameOfCorruptRecord", "_raw_line")
           .option("mode", "PERMISSIVE").option("header", header).option("sep", sep).csv(path))
    columns = raw.columns[:-1]
    always = F.hash(*columns) >= F.lit(-2 ** 31)        # true, and reads all columns
    return raw.select(*columns, F.when(always, F.col("_raw_line")).alias("rejected"))


_TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean")


# What every string that casts to a type matches, and hardly any other: a cast of strings to these types fails by an
# exception, which costs far more than this look.
_LIKE = {"int": "^[^0-9A-Za-z.:]*[0-9]+[^0-9A-Za-z.:-]*$",
         "boolean": "^[^0-9A-Za-z]*(?i:t|true|y|yes|1|f|false|n|no|0)[^0-9A-Za-z]*$"}
_LIKE["bigint"] = _LIKE["int"]


def inferred_types(strings: DataFrame) -> dict[str, str]:
    """The narrowest of int, bigint, double, date, timestamp and boolean that every value of a string column
    reads as, in one aggregate over all columns; a column without values stays a string."""
    def fit(c: str, t: str):
        value = F.col(c)
        reads = value.try_cast(t).isNotNull()
        if t in _LIKE:
            reads = F.when(value.rlike(_LIKE[t]), reads).otherwise(False)
        if t == "date":                     # a time of day makes it a timestamp
            reads &= F.length(F.trim(value)) <= 10
        return F.every(value.isNull() | reads)

    fits = [fit(c, t).alias(f"{i}_{t}") for i, c in enumerate(strings.columns) for t in _TYPES]
    row = strings.agg(*fits, *[F.count(c).alias(f"{i}_n") for i, c in enumerate(strings.columns)]).first()
    return {c: next((t for t in _TYPES if row[f"{i}_n"] and row[f"{i}_{t}"]), "string") for i, c in enumerate(strings.columns)}


def delimited_inferred(spark: SparkSession, path: str, header: bool = False, sep: str = ",") -> DataFrame:
    """S3: delimited files whose column types are inferred over all rows in one pass."""
    strings = spark.read.option("header", header).option("sep", sep).csv(path)
    types = inferred_types(strings)
    return strings.select(*[F.col(c).cast(types[c]).alias(c) for c in strings.columns])


def parse_tagged(lines: DataFrame, value_col: str = "value", skip: int = 0) -> DataFrame:
    """S7/S8 + P8: ``(doc_id, text)`` from tagged lines; malformed lines dropped."""
    v = F.col(value_col)
    return (lines.filter(T.is_tagged_line(v))
            .select(T.tag_id(v, skip).alias("doc_id"), T.tag_body(v).alias("text")))
