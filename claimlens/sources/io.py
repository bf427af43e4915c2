"""Scans and sinks.

Raw files are read with a fixed all-string schema (no inference pass over 100 TB),
split by Spark into file partitions; the reference's 100k-row chunks become
partitions and, unlike there, the chunk size never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["reproducible_sample", "RAW_COLUMNS", "raw_schema", "read_raw", "read_raw_tolerant", "read_columns", "read_prepared_csv",
           "read_or_build", "write_table", "write_sample", "write_splits", "write_head", "write_report",
           "head_rows", "path_exists"]

# The 52 raw columns in file order.
RAW_COLUMNS = [
    "UnderwrittenCoverID", "PolicyID", "TransactionMonth", "IsVATRegistered", "Citizenship", "LegalType",
    "Title", "Language", "Bank", "AccountType", "MaritalStatus", "Gender", "Country", "Province",
    "PostalCode", "MainCrestaZone", "SubCrestaZone", "ItemType", "mmcode", "VehicleType",
    "RegistrationYear", "make", "Model", "Cylinders", "cubiccapacity", "kilowatts", "bodytype",
    "NumberOfDoors", "VehicleIntroDate", "CustomValueEstimate", "AlarmImmobiliser", "TrackingDevice",
    "CapitalOutstanding", "NewVehicle", "WrittenOff", "Rebuilt", "Converted", "CrossBorder",
    "NumberOfVehiclesInFleet", "SumInsured", "TermFrequency", "CalculatedPremiumPerTerm",
    "ExcessSelected", "CoverCategory", "CoverType", "CoverGroup", "Section", "Product",
    "StatutoryClass", "StatutoryRiskType", "TotalPremium", "TotalClaims",
]
OVERFLOW = "_overflow"


def raw_schema(columns: Sequence[str] = RAW_COLUMNS, overflow: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if overflow:
        fields.append(T.StructField(OVERFLOW, T.StringType(), True))
    return T.StructType(fields)


def _csv(spark: SparkSession, schema: T.StructType, sep: str, mode: str):
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("mode", mode).option("encoding", "UTF-8").option("quote", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_raw(spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS, sep: str = "|") -> DataFrame:
    """Delimited scan, every column a string, malformed UTF-8 replaced by U+FFFD."""
    return _csv(spark, raw_schema(columns), sep, "PERMISSIVE").csv(path)


def read_raw_tolerant(spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS,
                      sep: str = "|") -> DataFrame:
    """Short lines are kept (null-padded); over-long lines are skipped. One
    extra trailing column catches overflow; rows where it is set are dropped."""
    df = _csv(spark, raw_schema(columns, overflow=True), sep, "PERMISSIVE").csv(path)
    return df.where(F.col(OVERFLOW).isNull()).drop(OVERFLOW)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "|") -> DataFrame:
    """S3: column-subset scan; the projection is pruned into the CSV reader."""
    return read_raw(spark, path, sep=sep).select(*columns)


def read_prepared_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      sep: str = ",") -> DataFrame:
    """A prepared table written as CSV, with an explicit schema (preferred at
    scale) or, when none is given, one inference pass."""
    r = spark.read.option("header", True).option("sep", sep)
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet") -> DataFrame:
    """Use the materialised result when present, else build, write and re-read
    (the write cuts lineage: later jobs read the table, not the plan)."""
    ext = {"parquet": ".parquet", "csv": ".csv", "json": ".json"}[fmt]
    path = path if path.endswith(ext) else path + ext
    if not path_exists(spark, path):
        path = write_table(build(), path, fmt=fmt, mode="ignore")
    return spark.read.format(fmt).load(path) if fmt != "csv" else read_prepared_csv(spark, path, sep="|")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, sep: str = "|", compression: str | None = None) -> str:
    """Parquet-snappy (default) or delimited text with header, ``compression`` (such as gzip) if named. The path's
    extension is fixed up to match the format."""
    ext = {"parquet": ".parquet", "csv": ".csv", "json": ".json"}[fmt]
    if "." in path.rsplit("/", 1)[-1]:
        path = path.rsplit(".", 1)[0]
    path = path + ext
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        w = w.option("compression", compression) if compression else w
        w.option("header", True).option("sep", sep).csv(path)
    else:
        w.json(path)
    return path


def reproducible_sample(df: DataFrame, n: int = 1000, keys: Sequence[str] | None = None) -> DataFrame:
    """A reproducible sample of ``n`` rows: the ``n`` smallest MD5 digests of the key
    columns' text (default all columns), so that any engine can repeat it (TakeOrdered keeps
    ``n`` rows per partition, never a full sort)."""
    keys = list(keys or df.columns)
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in keys])
    return df.withColumn("_h", F.md5(text)).orderBy("_h", *keys).limit(n).drop("_h")


def write_sample(df: DataFrame, path: str, n: int = 1000, fmt: str = "csv", keys: Sequence[str] | None = None) -> str:
    """Write the claim subset's reproducible sample."""
    return write_table(reproducible_sample(df, n, keys), path, fmt=fmt)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> str:
    """The prepared table with its train/test label, partitioned by split so a
    reader of one split prunes the other."""
    return write_table(df, path, partition_by=[split_col])


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (early stop)."""
    return df.orderBy(*order).limit(n)


def write_head(df: DataFrame, path: str, order: Sequence[str], n: int = 1000) -> str:
    """Head sample sink."""
    return write_table(head_rows(df, n, order), path, fmt="csv")


def write_report(df: DataFrame, path: str, fmts: Sequence[str] = ("json", "csv")) -> list[str]:
    """Small result tables (tests, describe, correlations, importances)
    written as JSON and CSV. The input is already aggregated; one file each."""
    return [write_table(df.repartition(1), f"{path}", fmt=f, sep=",") for f in fmts]
