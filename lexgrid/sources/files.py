"""CSV sources, named splits and the two sinks.

Readers always take an explicit schema (no inference pass over 100 TB) and
keep malformed lines in a corrupt-record column instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


NULL_TEXT = "\\N"


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    """Column names of the file's header line."""
    return spark.read.options(**options).option("header", True).csv(path).columns


def read_labelled_csv(spark: SparkSession, path: str, schema: StructType | str,
                      keep_corrupt: bool = True, multi_line: bool = True) -> DataFrame:
    """Header CSV, quoted newlines and doubled quotes, explicit schema.

    Columns are found by the header's names, in any order; a column of
    ``schema`` that the header lacks is an error. White space is kept, an empty field is
    the empty string and ``\\N`` is null. A value that does not fit its type (e.g. a label
    ``abc``) becomes null and the raw line lands in ``_corrupt_record``.
    ``multi_line=False`` lets one large file be read in many splits; use it where no field holds a newline.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    options = {"multiLine": multi_line, "escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False, "nullValue": NULL_TEXT, "emptyValue": ""}
    names = _header(spark, path, options)
    wanted = {f.name: f for f in schema.fields}
    missing = [n for n in wanted if n not in names and n != CORRUPT]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    fields = [wanted.get(n, StructField(n, StringType(), True)) for n in names]
    out = [f.name for f in schema.fields if f.name != CORRUPT] + ([CORRUPT] if keep_corrupt else [])
    if keep_corrupt:
        fields.append(StructField(CORRUPT, StringType(), True))
    reader = spark.read.options(**options).option("header", True).option("enforceSchema", False).schema(StructType(fields))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path).select(*[F.col(f"`{n}`") for n in out])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_labelled_csv`` reads back unchanged: all fields quoted, quotes doubled, white
    space kept, nulls as ``\\N``."""
    df.write.mode("overwrite").options(header=True, escape='"', quoteAll=True, nullValue=NULL_TEXT, emptyValue="",
                                       ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_splits(spark: SparkSession, paths: Mapping[str, str], schema: StructType | str | Mapping[str, StructType | str],
                split_col: str = "split", fmt: str = "csv") -> DataFrame:
    """One read per named split, tagged and unioned (missing columns become null).

    ``schema`` is one for all splits, or one per split name.
    Pick one split with ``.where(col(split_col) == name)``; the filter is pushed
    to the union branches, so only that split's files are read.
    """
    out = None
    for name, path in paths.items():
        own = schema[name] if isinstance(schema, Mapping) else schema
        if fmt == "csv":
            df = read_labelled_csv(spark, path, own, keep_corrupt=False)
        else:
            df = spark.read.schema(own).format(fmt).load(path)
        df = df.withColumn(split_col, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no split is named")
    return out


GOOD = "ok"


def route_rejects(df: DataFrame, checks: Mapping[str, Column], path: str, reason_col: str = "reason") -> dict[str, int]:
    """Write the rows in one pass, each into the folder of its reason below ``path``; count them by what the files say.

    ``checks`` name what is wrong with a row, the first that holds is its reason; a row without any goes to ``ok``.
    ``accepted`` and ``rejected`` read the two sides back; each reads its own folders only. Returns the counts by reason.
    """
    reason = F.lit(GOOD)
    for name, wrong in reversed(checks.items()):
        reason = F.when(F.coalesce(wrong, F.lit(False)), F.lit(name)).otherwise(reason)
    df.withColumn(reason_col, reason).write.partitionBy(reason_col).parquet(path)
    # no column is read for this: row counts and the folders' names are enough (an ``Observation`` would make the session
    # one that models of Spark ML can't be used in)
    found = {r[reason_col]: r["count"] for r in df.sparkSession.read.parquet(path).groupBy(reason_col).count().collect()}
    return {n: found.get(n, 0) for n in [GOOD, *checks]}


def accepted(spark: SparkSession, path: str, reason_col: str = "reason") -> DataFrame:
    return spark.read.parquet(path).where(F.col(reason_col) == GOOD).drop(reason_col)


def rejected(spark: SparkSession, path: str, reason_col: str = "reason") -> DataFrame:
    return spark.read.parquet(path).where(F.col(reason_col) != GOOD)


def save_prepared(df: DataFrame, path: str, split_col: str = "split") -> None:
    """K1: prepared rows as Parquet partitioned by split (later reads prune by split)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_submission(df: DataFrame, key: str, prediction: str, path: str) -> None:
    """K2: ``{id, prediction}`` JSON lines, one file per task (no single-file funnel)."""
    df.select(F.col(key).cast("string").alias("id"),
              F.col(prediction).cast("string").alias("prediction")) \
        .write.mode("overwrite").json(path)


SUBMISSION_SCHEMA = "id string, prediction string"


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUBMISSION_SCHEMA).json(path)
