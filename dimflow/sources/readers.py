"""Sources: tables, nested JSON reports, CSV landings, relational tables, watermarks."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from dimflow.operators.reshape import live_rows, union_extracts

__all__ = ["live_rows", "union_extracts"]


def read_table(spark: SparkSession, folder: str | None, name: str) -> DataFrame:
    """Logical table: parquet under a folder, or a catalog table when there is none."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def read_report_json(
    spark: SparkSession, path: str | list[str], root: str = "Report_Entry", schema: StructType | None = None
) -> DataFrame:
    """One row per entry of a ``{root: [...]}`` report; no entries, no rows.

    A document is parsed by one task; reports are landed as many bounded chunk
    files, which are read in parallel. Give a schema to spare the inference pass.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(StructType([StructField(root, ArrayType(schema))]))
    docs = reader.json(path)
    if root not in docs.columns:
        raise ValueError(f"report has no {root!r} list")
    kind = docs.schema[root].dataType
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)):
        return spark.createDataFrame([], schema or StructType([]))
    return docs.select(F.explode(root).alias("e")).select("e.*")


class InvalidFileFormat(ValueError):
    pass


class EmptyFile(ValueError):
    pass


#: Files of the landing format, whatever the case of their ending.
ANY_CSV = "*.[cC][sS][vV]"


def refuse_other_files(spark: SparkSession, path: str) -> None:
    """Raise if a landing folder holds a visible file that is no CSV file."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(root) or []:
        if not status.isDirectory():
            continue
        for f in fs.listStatus(status.getPath()):
            name = f.getPath().getName()
            if f.isDirectory() or name[0] in "_." or name.endswith("$folder$"):
                continue
            if not name.lower().endswith(".csv"):
                raise InvalidFileFormat(f"not a CSV file: {f.getPath().toString()}")


def read_landing_csv(
    spark: SparkSession, path: str | Iterable[str], *, schema: StructType | None = None, allow_empty: bool = False
) -> DataFrame:
    """CSV landing files, all columns text.

    The ending counts in any case. ``…$folder$`` placeholders and hidden files are
    skipped, other formats refused, also inside a folder, and a landing without rows
    is reported.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = [p for p in paths if not p.rstrip("/").endswith("$folder$")]
    for p in files:
        ext = os.path.splitext(p.rstrip("/"))[1]
        if ext and ext.lower() != ".csv":
            raise InvalidFileFormat(f"not a CSV file: {p}")
    if not files:
        raise EmptyFile("only folder placeholders to read")
    for p in files:
        refuse_other_files(spark, p)
    reader = spark.read.option("header", True).option("pathGlobFilter", ANY_CSV)
    df = (reader.schema(schema) if schema is not None else reader).csv(files)
    if not allow_empty and df.isEmpty():
        raise EmptyFile(f"no rows in {files}")
    return df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_col: str | None = None,
    bounds: tuple | None = None,
    n: int | None = None,
    *,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Relational table or ``(select …) alias``, read by ``n`` range queries in parallel.

    Filters and column lists put on the result are sent to the database.
    """
    if partition_col is None:
        return spark.read.jdbc(url, table, properties=properties)
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=partition_col, lowerBound=low, upperBound=high, numPartitions=n, properties=properties
    )


def watermark(target: DataFrame | None, col: str):
    """Largest value in the target, None when there is no target or it is empty."""
    return None if target is None else target.agg(F.max(col)).first()[0]


def since_watermark(
    df: DataFrame,
    target: DataFrame | None,
    src_col: str,
    tgt_col: str,
    *,
    inclusive: bool = False,
    enabled: bool = True,
) -> DataFrame:
    """Rows past the target's mark; all rows when there is no mark.

    The mark is read first and put in as a literal, so it prunes row groups.
    """
    mark = watermark(target, tgt_col) if enabled else None
    if mark is None:
        return df
    lit = F.lit(mark).cast(df.schema[src_col].dataType)
    return df.filter(F.col(src_col) >= lit if inclusive else F.col(src_col) > lit)


def since_watermark_by_key(
    df: DataFrame, target: DataFrame | None, keys: list[str], src_col: str, tgt_col: str, *, inclusive: bool = False
) -> DataFrame:
    """Rows past the mark of their own key; keys without a mark pass whole."""
    if target is None:
        return df
    marks = target.groupBy(*keys).agg(F.max(tgt_col).alias("__mark"))
    past = F.col(src_col) >= F.col("__mark") if inclusive else F.col(src_col) > F.col("__mark")
    return df.join(marks, keys, "left").filter(F.col("__mark").isNull() | past).drop("__mark")


def history_of_changed_keys(df: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the keys that occur in ``changed``."""
    return df.join(changed.select(*keys).distinct(), keys, "left_semi")
