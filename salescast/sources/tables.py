"""Readers and writers of the logical tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast import schema as S
from salescast.functions.calendar import lenient_date
from salescast.sources.versions import publish, read_published

__all__ = [
    "append_batch", "csv_by_header", "publish", "read_optional", "read_published", "read_required", "rows_to_table", "typed",
    "with_headers", "write_table", "write_text_report",
]

# Texts that a table in text form writes for a missing value.
NULL_TEXTS = ("", "#N/A", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


#: Files whose headers are looked at together; each look is a small job that reads the begin of one file.
HEADER_JOBS = 16


def _exists_or_none(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _scan_csv(spark: SparkSession, files: Sequence[str] | str, base: str | None) -> DataFrame:
    """One scan of files with one header; a file whose header is another one fails the job."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return (reader.option("basePath", base) if base else reader).csv(files)


def csv_by_header(spark: SparkSession, path: str) -> list[DataFrame]:
    """The text files under ``path``, one frame for each distinct header line, columns as named there.

    Spark takes the header of one file for all files of a scan, so files of other orders or other columns would be misread.
    Here the header of every file is read first, files with the same one share a scan, and each scan
    checks the headers again. Files without a line are left out. Folders named ``column=value`` give columns, as in any
    scan. A path that does not exist gives no frame.
    """
    listed = _exists_or_none(spark, path, "binaryFile")
    if listed is None:
        return []
    folders = [c for c in listed.columns if c not in ("path", "modificationTime", "length", "content")]
    base = path if folders else None
    files = [r.path for r in listed.where("length > 0").select("path").collect()]

    def header(file: str) -> tuple[str, ...]:
        try:
            return tuple(c for c in _scan_csv(spark, file, base).columns if c not in folders)
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return ()  # nothing but blank lines
            raise

    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        for file, columns in zip(files, pool.map(header, files), strict=True):
            if columns:
                by_header.setdefault(columns, []).append(file)
    return [_scan_csv(spark, sorted(same), base) for _, same in sorted(by_header.items())]


def _load(spark: SparkSession, path: str, fmt: str, fields: tuple[S.Field, ...], extra: Mapping[str, str] | None) -> DataFrame | None:
    """The typed table, or None where there is none; text files with different headers are put together by column name."""
    if fmt != "csv":
        df = _exists_or_none(spark, path, fmt)
        return None if df is None else typed(df, fields, extra)
    batches = [typed(df, fields, extra) for df in csv_by_header(spark, path)]
    return reduce(append_batch, batches) if batches else None


def typed(df: DataFrame, fields: tuple[S.Field, ...], extra: Mapping[str, str] | None = None) -> DataFrame:
    """Rename headers to canonical names and cast leniently; absent optional columns stay absent.

    Texts that stand for a missing value become null. Other columns keep their names, and the types in ``extra`` if given.
    """
    df = df.select([
        F.when(~F.col(f"`{f.name}`").isin(*NULL_TEXTS), F.col(f"`{f.name}`")).alias(f.name)
        if f.dataType == T.StringType() else F.col(f"`{f.name}`") for f in df.schema])
    by_lower = {c.lower(): c for c in df.columns}
    out, missing = [], []
    for f in fields:
        found = by_lower.get(f.header.lower()) or by_lower.get(f.name.lower())
        if found is None:
            if f.required:
                missing.append(f.header)
            continue
        c = F.col(f"`{found}`")
        if isinstance(f.dtype, T.DateType) and df.schema[found].dataType == T.StringType():
            out.append(lenient_date(c).alias(f.name))
        elif isinstance(f.dtype, T.IntegerType) and df.schema[found].dataType == T.StringType():
            # integer columns with gaps are often written as "3.0"
            out.append(c.try_cast("double").try_cast("int").alias(f.name))
        else:
            out.append(c.try_cast(f.dtype).alias(f.name))
    known = {f.name.lower() for f in fields} | {f.header.lower() for f in fields}
    types = {k.lower(): v for k, v in (extra or {}).items()}
    out += [F.col(f"`{c}`").try_cast(types[c.lower()]).alias(c) if c.lower() in types else F.col(f"`{c}`")
            for c in df.columns if c.lower() not in known]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df.select(out)


def read_required(
    spark: SparkSession, path: str, fields: tuple[S.Field, ...], fmt: str = "parquet", extra: Mapping[str, str] | None = None
) -> DataFrame:
    """The table, typed by ``fields``. ``extra`` gives SQL types to further columns of a text format, which sort
    and compare as text otherwise.

    The text files of a folder may have their columns in different orders; an optional or further column that only some of
    them have is null in the rows of the others, and one without a required column is refused."""
    df = _load(spark, path, fmt, fields, extra)
    if df is None:
        raise FileNotFoundError(path)
    return df


def read_optional(
    spark: SparkSession, path: str, fields: tuple[S.Field, ...], fmt: str = "parquet", extra: Mapping[str, str] | None = None
) -> DataFrame:
    """Like :func:`read_required`, but a missing table reads as an empty one of the known schema."""
    df = _load(spark, path, fmt, fields, extra)
    return spark.createDataFrame([], S.struct(fields)) if df is None else df


def rows_to_table(
    spark: SparkSession, rows: Iterable[Mapping], fields: tuple[S.Field, ...]
) -> DataFrame:
    """A few hand-made rows (dimension entries, scores) as a typed table."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], S.struct(fields))


def with_headers(df: DataFrame, fields: tuple[S.Field, ...]) -> DataFrame:
    """Columns in file order under their file headers."""
    return df.select([F.col(f.name).alias(f.header) for f in fields if f.name in df.columns])


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()
) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_batch(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Add a batch by column name; columns only one side has are null on the other."""
    return existing.unionByName(batch, allowMissingColumns=True)


def write_text_report(report: DataFrame, path: str, column: str = "summary") -> None:
    """Write a one-row report as a text document."""
    report.select(column).coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)
