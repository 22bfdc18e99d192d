"""File scans and the CSV export."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom import schemas as S
from payloom.operators.conform import empty

DOCUMENTS = S.ddl("file string, text string")
_MISSING = "PATH_NOT_FOUND"


def scan_payslip_text(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """``(file, text)``: one row per document of a folder, not recursive.

    The suffix is matched in any letter case.  A file of zero bytes is a document with an
    empty text.  A missing folder, or one without a match, gives an empty frame of the same
    schema.
    """
    glob = "*" + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in suffix)
    name = F.col("_metadata.file_name").alias("file")
    try:
        texts = spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=False)
    except AnalysisException as error:
        if error.getCondition() != _MISSING:
            raise
        return empty(spark, DOCUMENTS)
    found = texts.select(name, F.col("value").alias("text"))
    hollow = empty_files(spark, folder, glob)
    return found.unionByName(spark.createDataFrame([(f, "") for f in hollow], S.to_ddl(DOCUMENTS))) if hollow else found


def empty_files(spark: SparkSession, folder: str, glob: str) -> list[str]:
    """Names of the files of zero bytes, which Spark's readers leave out of their listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, glob)) or []
    return [s.getPath().getName() for s in listed if s.getLen() == 0 and s.isFile()]


def scan_payslip_table(spark: SparkSession, path: str) -> DataFrame:
    """The same rows from a splittable table; better than small files for a large archive."""
    return spark.read.schema(S.to_ddl(DOCUMENTS)).parquet(path)


def scan_employee_json(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """Landed API pages with a fixed schema, one row per employee.

    A page is a JSON array of employees, and a detail file one object, over any number of
    lines.  ``multi_line=False`` reads one page or one employee per line; such files can be
    split.  A missing folder gives an empty frame.
    """
    try:
        return spark.read.schema(S.EMPLOYEE).option("multiLine", multi_line).json(folder)
    except AnalysisException as error:
        if error.getCondition() != _MISSING:
            raise
        return spark.createDataFrame([], S.EMPLOYEE)


def locale_columns(df: DataFrame) -> DataFrame:
    """Decimals and doubles as text with a comma; the first header carries the UTF-8 mark."""

    def text(name: str, kind: str):
        c = F.col(name)
        if kind == "double" or kind.startswith("decimal"):
            return F.replace(c.cast("string"), F.lit("."), F.lit(","))
        return c

    columns = [text(name, kind).alias(name) for name, kind in df.dtypes]
    return df.select(columns[0].alias("﻿" + df.columns[0]), *columns[1:])


def write_csv_locale(df: DataFrame, folder: str) -> None:
    """Semicolon CSV with decimal commas, UTF-8 with mark, header in every part file."""
    (
        locale_columns(df)
        .write.mode("overwrite")
        .option("sep", ";")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(folder)
    )


def read_csv_locale(spark: SparkSession, folder: str, schema: dict[str, str]) -> DataFrame:
    """Read an export back with its types (decimal commas undone)."""
    text = ", ".join(f"{name} string" for name in schema)
    raw = (
        spark.read.schema(text)
        .option("sep", ";")
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(folder)
    )
    return raw.select(
        *(
            (
                F.replace(F.col(name), F.lit(","), F.lit("."))
                if kind == "double" or kind.startswith("decimal")
                else F.col(name)
            )
            .try_cast(kind)
            .alias(name)
            for name, kind in schema.items()
        )
    )
