"""Monthly sale snapshots: CSV scan, file filter, month stamp, rename, yes/no, coercion.

A1 load_snapshots, A2 snapshot_file_filter, A3 stamp_month, A4 rename_columns,
A5 yes_no_to_bool, A6 union_snapshots, B1 project_contract, B3 coerce_types.

Every CSV column is read as text (no per-file inference, so two files can never
disagree on a type); the contract types are applied afterwards with ``try_cast`` so a
value that cannot be coerced becomes a counted violation instead of aborting the job.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus import constants as C
from domus.errors import DataError
from domus.operators.contract import FAILURES, coercion_counts
from domus.session import materialize

# functions for Python workers travel by value: executors need no copy of this package for them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Contract type per normalised column.
LISTING_TYPES: dict[str, T.DataType] = {
    "id": T.StringType(),
    "city": T.StringType(),
    "property_type": T.StringType(),
    "square_meters": T.DoubleType(),
    "rooms": T.LongType(),
    "floor": T.LongType(),
    "floor_count": T.LongType(),
    "build_year": T.LongType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
    "centre_distance_km": T.DoubleType(),
    "poi_count": T.LongType(),
    **{c: T.DoubleType() for c in C.DISTANCE_COLUMNS},
    "ownership": T.StringType(),
    "building_material": T.StringType(),
    "condition": T.StringType(),
    **{c: T.BooleanType() for c in C.BOOL_FEATURES},
    "price_pln": T.LongType(),
    "snapshot_month": T.StringType(),
}


def yes_no_to_bool(col: Column | str) -> Column:
    """A5: case-insensitive 'yes' -> true, 'no' -> false, anything else or null -> null."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    return F.when(c == "yes", F.lit(True)).when(c == "no", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def check_header(columns: list[str]) -> None:
    """A4 precondition: every raw column must be present (extra columns are ignored)."""
    missing = [c for c in C.RENAME if c not in columns]
    if missing:
        raise DataError(f"snapshot header is missing columns: {missing}")


def rename_columns(df: DataFrame) -> DataFrame:
    """A4: camelCase raw names -> snake_case contract names; a missing column is an error."""
    check_header(df.columns)
    return df.withColumnsRenamed(C.RENAME)


def coerce_column(name: str, col: Column | None = None) -> Column:
    """Cast one column to its contract type; impossible values become null (``coercion_failures`` and
    ``failed_columns`` count them). A whole number written as ``3.0`` is an integer."""
    col = F.col(name) if col is None else col
    kind = LISTING_TYPES[name]
    if not isinstance(kind, T.LongType):
        return col.try_cast(kind)
    exact = col.try_cast(T.DecimalType(38, 6))
    return F.coalesce(col.cast("string").try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast(kind)))


def coerce_types(df: DataFrame) -> DataFrame:
    """Cast every contract column present to its declared type (``try_cast``)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    casts = {c: coerce_column(c) for c, t in LISTING_TYPES.items()
             if c in fields and fields[c] != t}
    return df.withColumns(casts) if casts else df


def coercion_failures(raw: DataFrame, cols: list[str] | None = None) -> list[Column]:
    """B3 counts: per column, rows whose non-null text does not cast to the contract type."""
    out = []
    for c in cols or raw.columns:
        if c in LISTING_TYPES and c not in C.BOOL_FEATURES:
            bad = F.col(c).isNotNull() & coerce_column(c).isNull()
            out.append(F.sum(bad.cast("long")).alias(c))
    return out


def failed_columns(cols: list[str]) -> Column:
    """B3 row by row: names of the columns whose non-null text does not parse."""
    return F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & coerce_column(c).isNull(), F.lit(c))
        for c in cols if c in LISTING_TYPES and c not in C.BOOL_FEATURES]))


def normalise(raw: DataFrame, month: Column | None = None, keep: tuple[str, ...] = (),
              failures: bool = False) -> DataFrame:
    """A4 + A5 + A3 + B3 + B1: raw snapshot rows -> the 29 contract columns in order.

    ``month`` is the ``YYYY-MM`` stamp expression; when omitted the frame must already
    carry ``snapshot_month``. Columns beyond the 28 raw ones are dropped except ``keep``.
    With ``failures`` a column lists for each row which cells did not parse; a contract counts them.
    """
    df = rename_columns(raw)
    df = df.withColumns({c: yes_no_to_bool(c) for c in C.BOOL_FEATURES})
    if month is not None:
        df = df.withColumn("snapshot_month", month)
    if failures:
        df = df.withColumn(FAILURES, failed_columns(df.columns))
        keep = (*keep, FAILURES)
    df = coerce_types(df)
    return project_contract(df, keep)


def project_contract(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """B1: exactly the 29 contract columns in order (plus any ``keep`` columns)."""
    return df.select(*C.LISTING_COLUMNS, *keep)


def month_from_file_name(file_name: Column, filtered: bool = False) -> Column:
    """A3/H4: ``apartments_pl_YYYY_MM.csv`` -> ``YYYY-MM``. Names that passed the file filter (``filtered``) have year and
    month at fixed places from their end, which two substrings give without a regular expression a row."""
    if filtered:
        return F.concat_ws("-", F.substring(file_name, -11, 4), F.substring(file_name, -6, 2))
    year = F.regexp_extract(file_name, C.SALE_FILE_REGEX, 1)
    mon = F.regexp_extract(file_name, C.SALE_FILE_REGEX, 2)
    return F.concat_ws("-", year, mon)


#: Bytes read at a time until a file's first line ends.
HEADER_BYTES = 1 << 16


def _first_line(path: str) -> str:
    """The first line of a file, without reading on."""
    from pyarrow import fs

    if path.startswith("file:"):
        system, inside = fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    else:
        system, inside = fs.FileSystem.from_uri(path)
    data = b""
    with system.open_input_stream(inside) as f:
        while b"\n" not in data:
            chunk = f.read(HEADER_BYTES)
            if not chunk:
                break
            data += chunk
    return data.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8-sig")


def _header_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [next(csv.reader([_first_line(p)]), []) for p in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.list_(pa.string()))], names=["file", "header"])


def _scan(spark: SparkSession, form: str, raw_dir: str) -> DataFrameReader:
    """Reader of the sale snapshot files under a folder."""
    return (spark.read.format(form).option("pathGlobFilter", C.SALE_FILE_GLOB).option("recursiveFileLookup", True))


def read_headers(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(file, header): the column names of every sale file. Executors read the first line of each file and no more;
    the list of files stays a table."""
    try:
        files = _scan(spark, "binaryFile", raw_dir).load(raw_dir).select("_metadata.file_path", "path")
    except AnalysisException as exc:  # missing directory
        raise DataError(f"no sale snapshot files found in {raw_dir}") from exc
    return files.mapInArrow(_header_batches, "file string, header array<string>")


def load_snapshots(spark: SparkSession, raw_dir: str, failures: bool = False) -> DataFrame:
    """Every ``apartments_pl_YYYY_MM.csv`` under ``raw_dir`` (searched recursively,
    so a month may be sharded over several directories) as one frame of 29 columns.

    Rent files and other look-alikes are skipped by the file-name filter. The headers are read first, a line a file,
    and only the distinct ones (a few) reach the driver. The rest is one scan: files that share a header are read with
    it; where files order their columns in several ways, cells are read by place and named by each file's header,
    joined by file. Raises ``DataError`` when no file matches or a header lacks a column. ``failures``: see
    ``normalise``; ``load_checked`` counts them.
    """
    headers = read_headers(spark, raw_dir)
    distinct = [tuple(r["header"]) for r in headers.select("header").distinct().collect()]
    if not distinct:
        raise DataError(f"no sale snapshot files found in {raw_dir}")
    for header in sorted(distinct):
        check_header(list(header))
    width = max(len(h) for h in distinct)
    one = len(distinct) == 1
    names = list(distinct[0]) if one else [f"_c{k}" for k in range(width)]
    cells = (_scan(spark, "csv", raw_dir).schema(T.StructType([T.StructField(n, T.StringType(), True) for n in names]))
             .option("header", one).option("enforceSchema", True)  # the names were checked above
             .option("nullValue", "").option("mode", "PERMISSIVE").load(raw_dir))
    if one:
        raw = cells.withColumn("_file_name", F.col("_metadata.file_name"))
    else:
        found = cells.select(F.array(*names).alias("_cells"), F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_name").alias("_file_name")).join(headers, "file")
        found = found.filter(~F.col("_cells").eqNullSafe(F.concat("header", F.array_repeat(
            F.lit(None).cast("string"), F.lit(width) - F.size("header")))))  # the header line itself
        raw = found.select("_file_name", *[F.element_at("_cells", F.array_position("header", F.lit(c)).cast("int")).alias(c)
                                           for c in C.RENAME])
    return normalise(raw, month_from_file_name(F.col("_file_name"), filtered=True), failures=failures)


def load_checked(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """The loaded rows, written once, and B3's (``coercion``, column, rows) for cells that did not parse. The
    rows keep ``coercion_failures``, so that a contract that validates them counts the same."""
    listings = materialize(load_snapshots(spark, raw_dir, failures=True))
    return listings, coercion_counts(listings)


def write_snapshot_files(raw: DataFrame, month_col: str, root: str,
                         max_records: int = 1_000_000) -> list[str]:
    """Sink: the raw rows as ``<root>/shard-NNNNN/apartments_pl_YYYY_MM.csv`` files (header
    included, at most ``max_records`` rows per file).

    Rows are written where they are (no repartition by month, so a month holding a third of
    the data is still written by many tasks); each month's part files are then renamed to
    the canonical snapshot name, one shard directory per file, with the cluster file system
    API (metadata operations). Returns the written paths.
    """
    spark = raw.sparkSession
    root = root.rstrip("/")
    staging = f"{root}/_staging"
    (raw.write.option("header", True).option("nullValue", "").option("maxRecordsPerFile", max_records)
     .partitionBy(month_col).csv(staging))
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    per_month: dict[str, int] = {}
    out = []
    for st in sorted(fs.globStatus(Path(f"{staging}/{month_col}=*/part-*.csv")),
                     key=lambda s: s.getPath().toString()):
        month = st.getPath().getParent().getName().split("=", 1)[1]
        k = per_month.get(month, 0)
        per_month[month] = k + 1
        target = f"{root}/shard-{k:05d}/apartments_pl_{month.replace('-', '_')}.csv"
        fs.mkdirs(Path(f"{root}/shard-{k:05d}"))
        fs.rename(st.getPath(), Path(target))
        out.append(target)
    fs.delete(Path(staging), True)
    return sorted(out)
