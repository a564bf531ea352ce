"""Text staging of the source CSV files.

Each file is read with an explicit all-STRING schema, a header row and multi-line quoted
fields.  The usual spreadsheet null tokens are mapped to NULL in one projection, so the
staged values equal what a text-typed loader keeps.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quoted
from .schemas import STAGING_COLUMNS

# Tokens read as NULL by the common CSV-to-frame loaders' defaults.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _null_token(col: str) -> Column:
    return F.when(F.col(col).isin(NULL_TOKENS), F.lit(None)).otherwise(F.col(col)).alias(col)


def stage_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One CSV file (or folder of parts) as an all-text table, read by as many tasks as it
    has blocks, quoted line breaks or not (``quoted``)."""
    df = quoted.read(spark, path, ", ".join(f"`{c}` string" for c in STAGING_COLUMNS[table]), {"quote": '"', "escape": '"'})
    return df.select(*[_null_token(c) for c in STAGING_COLUMNS[table]])


def default_file_map() -> dict[str, str]:
    """Source file name (without .csv) for each staging table; override per data set."""
    return {t: t for t in STAGING_COLUMNS}


def path_is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def require_sources(spark: SparkSession, raw_dir: str,
                    file_map: dict[str, str] | None = None) -> None:
    """Fail before any work if a source file is missing (file listing only)."""
    file_map = file_map or default_file_map()
    missing = []
    for table, name in file_map.items():
        try:
            spark.read.text(f"{raw_dir.rstrip('/')}/{name}.csv")
        except AnalysisException as error:
            if not path_is_missing(error):
                raise
            missing.append(f"{name}.csv")
    if missing:
        raise FileNotFoundError(f"missing source files in {raw_dir}: {', '.join(missing)}")


def stage_all(spark: SparkSession, raw_dir: str, file_map: dict[str, str] | None = None,
              out_dir: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Stage the nine files; optionally overwrite them as parquet under ``out_dir``.

    Returns the staged frames and a (table, rows) frame; counts are computed by Spark.
    """
    file_map = file_map or default_file_map()
    require_sources(spark, raw_dir, file_map)
    frames: dict[str, DataFrame] = {}
    for table, name in file_map.items():
        df = stage_csv(spark, f"{raw_dir.rstrip('/')}/{name}.csv", table)
        if out_dir:
            target = f"{out_dir.rstrip('/')}/{table}"
            df.write.mode("overwrite").parquet(target)
            df = spark.read.parquet(target)
        frames[table] = df
    return frames, staged_row_counts(frames)


def staged_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for a dict of staged frames, one Spark job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows")
             for t, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_staging_csv(frames: dict[str, DataFrame], raw_dir: str,
                      file_map: dict[str, str] | None = None) -> None:
    """Write staged frames as header CSV folders that ``stage_csv`` reads back verbatim
    (quotes doubled, embedded newlines quoted, times to the microsecond)."""
    file_map = file_map or default_file_map()
    for table, df in frames.items():
        (df.write.mode("overwrite").option("header", "true").option("quote", '"')
         .option("escape", '"').option("quoteAll", "false").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
         .csv(f"{raw_dir.rstrip('/')}/{file_map[table]}.csv"))
