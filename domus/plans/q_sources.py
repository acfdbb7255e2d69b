"""Queries: sources and sinks (A4–A12, F2) and the small scalar helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.functions import numeric as N
from domus.functions import text as X
from domus.plans import q_training  # noqa: F401  (registers batch_score first)
from domus.plans.catalog import register
from domus.sources import listings as LS
from domus.sources import store as ST
from domus.sources.panel import panel, panel_sql, raw_panel
from domus.sources.snapshots import rename_columns, yes_no_to_bool
from domus.session import materialize, scratch_path

RAW_BOOL = ("hasParkingSpace", "hasBalcony", "hasElevator", "hasSecurity", "hasStorageRoom")


@register("rename_columns", panel_sql(raw=True) + "\nSELECT uid, " + ", ".join(
    c for c in C.LISTING_COLUMNS if c != "snapshot_month") + " FROM panel")
def q_rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A4: raw camelCase snapshot columns renamed to the contract names (yes/no text kept)."""
    raw = rename_columns(raw_panel(spark, sf))
    return raw.select("uid", *[c for c in C.LISTING_COLUMNS if c != "snapshot_month"])


@register("yes_no_to_bool", panel_sql(raw=True) + "\nSELECT uid, " + ", ".join(
    f"{c} AS {c}_raw, CASE WHEN lower({c}) = 'yes' THEN true WHEN lower({c}) = 'no' THEN false END AS {c}"
    for c in C.BOOL_FEATURES) + " FROM panel")
def q_yes_no_to_bool(spark: SparkSession, sf: str) -> DataFrame:
    """A5/H9: yes/no text (any case) to booleans; other text and null become null."""
    raw = raw_panel(spark, sf)
    cols = []
    for r, c in zip(RAW_BOOL, C.BOOL_FEATURES):
        cols += [F.col(r).alias(f"{c}_raw"), yes_no_to_bool(r).alias(c)]
    return raw.select("uid", *cols)


@register("union_snapshots", panel_sql() + "\nSELECT " + ", ".join(C.LISTING_COLUMNS) + ", uid FROM panel")
def q_union_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly snapshots written as separate tables and stacked back by name."""
    p = panel(spark, sf)
    root = scratch_path(spark, "snapshots")
    latest = p.agg(F.max("snapshot_month")).collect()[0][0]
    p.filter(F.col("snapshot_month") == latest).write.parquet(f"{root}/latest")
    p.filter(F.col("snapshot_month") != latest).select(*reversed(p.columns)).write.parquet(f"{root}/earlier")
    return LS.union_snapshots([spark.read.parquet(f"{root}/earlier"), spark.read.parquet(f"{root}/latest")])


@register("table_write", panel_sql() + "\nSELECT " + ", ".join(C.LISTING_COLUMNS) + ", uid FROM panel")
def q_table_write(spark: SparkSession, sf: str) -> DataFrame:
    """Create-or-replace a named table (written twice: the second write replaces)."""
    store = ST.TableStore(spark, scratch_path(spark, "store"))
    p = panel(spark, sf)
    store.write("listings_2", p.limit(0))
    store.write("listings_2", p)
    return store.read("listings_2")


@register("table_read", panel_sql() + "\nSELECT uid, price_pln FROM panel")
def q_table_read(spark: SparkSession, sf: str) -> DataFrame:
    """Read a named table back (column-pruned read of a written table)."""
    store = ST.TableStore(spark, scratch_path(spark, "store"))
    store.write("prices", panel(spark, sf).select("uid", "price_pln", "city"))
    return store.read("prices").select("uid", "price_pln")


_FILLED = ", ".join(f"coalesce({c}, false) AS {c}" for c in C.BOOL_FEATURES)
_NN = " AND ".join(f"{c} IS NOT NULL" for c in ("id", "city", "square_meters", "rooms", "latitude", "longitude",
                   "centre_distance_km", "poi_count", "ownership", "has_parking", "has_balcony",
                   "has_security", "has_storage", "price_pln", "snapshot_month"))
UPSERT_SQL = panel_sql() + f""",
valid AS (SELECT * FROM (SELECT * REPLACE ({_FILLED}) FROM panel) WHERE {_NN}),
b AS (SELECT p.*, 1 AS batch FROM valid p
      UNION ALL
      SELECT p.* REPLACE (price_pln + 1000 AS price_pln), 2 AS batch FROM valid p WHERE build_year IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY id, snapshot_month ORDER BY batch DESC, uid DESC) AS rn FROM b)
SELECT """ + ", ".join(C.LISTING_COLUMNS) + " FROM r WHERE rn = 1"


def valid_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Panel rows as the table takes them: unknown yes/no cells are false, then the NOT NULL rules (B12 split,
    valid side)."""
    from domus.operators.contract import split_valid_rejected
    from domus.sources.listings import _NOT_NULL

    valid, _ = split_valid_rejected(panel(spark, sf).fillna(False, list(C.BOOL_FEATURES)), _NOT_NULL)
    return valid


@register("panel_upsert", UPSERT_SQL)
def q_panel_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert the panel (batch order = uid) into an empty table, then upsert a second batch
    repricing the rows without build year; key (id, month), the later row wins."""
    path = scratch_path(spark, "listings")
    p = materialize(valid_panel(spark, sf))
    LS.upsert(spark, path, p.select(*C.LISTING_COLUMNS, "uid"), order_col="uid", stored_batch=True)
    second = p.filter(F.col("build_year").isNull()).withColumn("price_pln", F.col("price_pln") + 1000)
    LS.upsert(spark, path, second.select(*C.LISTING_COLUMNS, "uid"), order_col="uid", stored_batch=True)
    return LS.fetch_all(spark, path).select(*C.LISTING_COLUMNS)


@register("panel_fetch_all", UPSERT_SQL.replace("SELECT " + ", ".join(C.LISTING_COLUMNS) + " FROM r WHERE rn = 1",
                                                "SELECT id, snapshot_month, price_pln FROM r WHERE rn = 1"))
def q_panel_fetch_all(spark: SparkSession, sf: str) -> DataFrame:
    """A10/F2: every stored listing ordered by (id, snapshot_month)."""
    path = scratch_path(spark, "listings")
    p = materialize(valid_panel(spark, sf))
    LS.upsert(spark, path, p.select(*C.LISTING_COLUMNS, "uid"), order_col="uid", stored_batch=True)
    second = p.filter(F.col("build_year").isNull()).withColumn("price_pln", F.col("price_pln") + 1000)
    LS.upsert(spark, path, second.select(*C.LISTING_COLUMNS, "uid"), order_col="uid", stored_batch=True)
    return LS.fetch_all(spark, path).select("id", "snapshot_month", "price_pln")


@register("panel_table_schema", panel_sql() + f""",
valid AS (SELECT * FROM (SELECT * REPLACE ({_FILLED}) FROM panel) WHERE {_NN}),
r AS (SELECT *, row_number() OVER (PARTITION BY id, snapshot_month ORDER BY uid DESC) AS rn FROM valid),
t AS (SELECT * FROM r WHERE rn = 1)
""" + "\nUNION ALL ".join(
    f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type, "
    f"{str(f.name == 'snapshot_month').lower()} AS is_partition, count({f.name}) AS n_values FROM t"
    for f in LS.LISTINGS_SCHEMA.fields))
def q_panel_table_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Columns, types and partitions of the written panel table, read back from its files, and the number
    of values in each column."""
    path = scratch_path(spark, "listings")
    LS.upsert(spark, path, valid_panel(spark, sf).select(*C.LISTING_COLUMNS, "uid"), order_col="uid")
    stored = spark.read.schema(LS.LISTINGS_SCHEMA).parquet(path)
    month = spark.read.format("binaryFile").load(path).select(  # the directories say what the table is split by
        F.regexp_extract(F.col("path"), r"/([^/=]+)=[^/]*/[^/]*$", 1).alias("p")).distinct()
    types = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in stored.schema.fields],
                                  "column string, type string")
    filled = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).unpivot([], stored.columns, "column", "n_values")
    return (types.join(filled, "column").join(month, F.col("column") == F.col("p"), "left")
            .select("column", "type", F.col("p").isNotNull().alias("is_partition"), "n_values"))


def _log_sql() -> str:
    from domus.plans.catalog import ORACLE

    return ("WITH b AS (" + ORACLE["batch_score"] + """)
SELECT uid, CAST(predicted_price AS DECIMAL(12,2)) AS predicted_price,
       CAST(interval_low AS DECIMAL(12,2)) AS interval_low, CAST(interval_high AS DECIMAL(12,2)) AS interval_high,
       model_name, model_version, predicted_at, CAST(predicted_at AS DATE) AS predicted_date FROM b""")


@register("prediction_log", _log_sql())
def q_prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    """Scored requests appended to the prediction log (request JSON, decimal prices,
    partitioned by prediction date) and read back; the JSON column is checked in pytest."""
    from domus.operators import conformal
    from domus.plans.q_training import AS_OF, linear_setup
    from domus.plans.training import batch_score

    split, model = linear_setup(spark, sf)
    cal = model.predict(split.filter(F.col("part") == "cal"), keep=(C.TARGET,))
    model.q = conformal.calibrate(cal, C.TARGET, "prediction")
    reqs = split.select("uid", *C.REQUEST_COLUMNS).withColumn("request", LS.request_json())
    scored = batch_score(model, reqs, "price-linear", "1", keep=("uid", "request"),
                         predicted_at=F.lit(AS_OF).cast("timestamp"))
    path = scratch_path(spark, "prediction_log")
    LS.append_predictions(scored, path)
    return spark.read.parquet(path).drop("request")


# --- scalar helpers ------------------------------------------------------------------
@register("str_lower_eq", panel_sql(raw=True) + """
SELECT uid, lower(has_parking) = 'yes' AS parking_yes FROM panel""")
def q_str_lower_eq(spark: SparkSession, sf: str) -> DataFrame:
    """H1: case-insensitive comparison of raw yes/no text."""
    return raw_panel(spark, sf).select("uid", X.str_lower_eq(F.col("hasParkingSpace"), "yes").alias("parking_yes"))


@register("regex_capture", panel_sql() + """
SELECT DISTINCT 'apartments_pl_' || replace(snapshot_month, '-', '_') || '.csv' AS file_name,
       snapshot_month AS month FROM panel""")
def q_regex_capture(spark: SparkSession, sf: str) -> DataFrame:
    """H4/A3: month captured from snapshot file names (names built from the panel months)."""
    from domus.sources.snapshots import month_from_file_name

    names = panel(spark, sf).select(
        F.concat(F.lit("apartments_pl_"), F.replace(F.col("snapshot_month"), F.lit("-"), F.lit("_")),
                 F.lit(".csv")).alias("file_name")).distinct()
    return names.select("file_name", month_from_file_name(F.col("file_name")).alias("month"))


@register("identifier_check", """
SELECT name, regexp_full_match(name, '[A-Za-z_][A-Za-z0-9_]*') AS ok FROM (
  SELECT n_name AS name FROM nation UNION ALL SELECT c_name FROM customer
  UNION ALL SELECT c_mktsegment || ' ' || c_nationkey FROM customer)""")
def q_identifier_check(spark: SparkSession, sf: str) -> DataFrame:
    """H5: safe table-name check over names taken from the nation and customer tables."""
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_name").alias("name"))
    c = spark.read.parquet(f"{sf}/customer.parquet")
    names = n.unionAll(c.select(F.col("c_name").alias("name"))).unionAll(
        c.select(F.concat_ws(" ", "c_mktsegment", "c_nationkey").alias("name")))
    return names.select("name", X.identifier_ok(F.col("name")).alias("ok"))


@register("format_pln", panel_sql() + """
SELECT uid, replace(format('{:,}', CAST(round_even(CAST(price_pln AS DOUBLE) / 7.0, 0) AS BIGINT)), ',', ' ') || ' PLN' AS text
FROM panel""")
def q_format_pln(spark: SparkSession, sf: str) -> DataFrame:
    """H6: prices / 7 rounded half-even and printed with space thousands separators."""
    p = panel(spark, sf)
    return p.select("uid", X.format_pln(F.col("price_pln").cast("double") / 7.0).alias("text"))


@register("cast_double", panel_sql() + """
SELECT uid, CAST(floor AS DOUBLE) AS floor_d, CAST(property_type AS VARCHAR) AS type_text,
       TRY_CAST(CASE WHEN has_elevator THEN 'yes' WHEN NOT has_elevator THEN 'no' END AS BOOLEAN) AS elevator
FROM panel""")
def q_cast_double(spark: SparkSession, sf: str) -> DataFrame:
    """H7: casts before imputing (to double, to text, lenient text-to-boolean)."""
    p = panel(spark, sf)
    txt = F.when(F.col("has_elevator"), "yes").when(~F.col("has_elevator"), "no")
    return p.select("uid", F.col("floor").cast("double").alias("floor_d"),
                    F.col("property_type").cast("string").alias("type_text"),
                    txt.try_cast("boolean").alias("elevator"))


@register("fill_null", panel_sql() + """
SELECT uid, coalesce(CAST(floor AS DOUBLE), -1.0) AS floor, coalesce(property_type, 'missing') AS property_type FROM panel""")
def q_fill_null(spark: SparkSession, sf: str) -> DataFrame:
    """H8: nulls replaced with constants (NaN would be kept)."""
    p = panel(spark, sf)
    return p.select("uid", F.coalesce(F.col("floor").cast("double"), F.lit(-1.0)).alias("floor"),
                    F.coalesce("property_type", F.lit(C.MISSING_CATEGORY)).alias("property_type"))


@register("round_half_even", panel_sql() + """
SELECT uid, CAST(round_even(CAST(price_pln AS DOUBLE) / 2.0 / 1000.0, 0) AS BIGINT) AS k_half FROM panel""")
def q_round_half_even(spark: SparkSession, sf: str) -> DataFrame:
    """Half-even rounding of half-thousands (exact .5 ties occur)."""
    p = panel(spark, sf)
    return p.select("uid", N.round_half_even(F.col("price_pln").cast("double") / 2.0 / 1000.0)
                    .cast("long").alias("k_half"))


@register("clip_low", panel_sql() + """
SELECT uid, CASE WHEN build_year IS NULL THEN NULL ELSE greatest(build_year - 1990, 0) END AS low,
       CASE WHEN floor IS NULL THEN NULL ELSE least(CAST(floor AS DOUBLE) / 50.0, 1.0) END AS high FROM panel""")
def q_clip_low(spark: SparkSession, sf: str) -> DataFrame:
    """Clip at a floor of 0 and a ceiling of 1, nulls kept."""
    p = panel(spark, sf)
    return p.select("uid", N.clip_low(F.col("build_year") - 1990, 0).alias("low"),
                    N.clip_high(F.col("floor").cast("double") / 50.0, 1.0).alias("high"))


@register("month_to_date", panel_sql() + """
SELECT DISTINCT snapshot_month, CAST(snapshot_month || '-01' AS DATE) AS month_start FROM panel""")
def q_month_to_date(spark: SparkSession, sf: str) -> DataFrame:
    """YYYY-MM month text to the first day of the month."""
    p = panel(spark, sf).select("snapshot_month").distinct()
    return p.select("snapshot_month", X.month_to_date(F.col("snapshot_month")).alias("month_start"))


# --- A1 / A2 / A3 -------------------------------------------------------------------
def _snapshot_dir(spark: SparkSession, sf: str) -> str:
    """The raw panel written as monthly sale CSVs plus a rent file and a look-alike to skip."""
    from domus.sources.snapshots import write_snapshot_files

    root = scratch_path(spark, "raw")
    raw = raw_panel(spark, sf)
    files = write_snapshot_files(raw.drop("uid"), "_month", root)
    one = spark.read.option("header", True).csv(files[0])
    one.limit(1).write.option("header", True).csv(f"{root}/rent_tmp")
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    part = fs.globStatus(Path(f"{root}/rent_tmp/part-*.csv"))[0].getPath()
    fs.rename(part, Path(f"{root}/apartments_rent_pl_2024_06.csv"))
    part2 = files[0].rsplit("/", 1)[0] + "/" + files[0].rsplit("/", 1)[1].replace(".csv", "_extra.csv")
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, Path(f"{root}/apartments_rent_pl_2024_06.csv"), fs,
                                          Path(part2), False, spark._jsc.hadoopConfiguration())
    return root


@register("load_snapshots", panel_sql() + "\nSELECT " + ", ".join(C.LISTING_COLUMNS) + " FROM panel")
def q_load_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Every monthly sale CSV read back into the 29-column frame (rent and look-alike
    files skipped, month from the file name, yes/no parsed, types coerced)."""
    from domus.sources.snapshots import load_snapshots

    return load_snapshots(spark, _snapshot_dir(spark, sf))


@register("snapshot_file_filter", panel_sql() + """
SELECT DISTINCT 'apartments_pl_' || replace(snapshot_month, '-', '_') || '.csv' AS file_name FROM panel""")
def q_snapshot_file_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A2: the files the sale-snapshot filter accepts in a directory that also holds a rent
    file and a look-alike."""
    root = _snapshot_dir(spark, sf)
    files = (spark.read.option("header", True).option("pathGlobFilter", C.SALE_FILE_GLOB)
             .option("recursiveFileLookup", True).csv(root).inputFiles())
    names = sorted({f.rsplit("/", 1)[-1] for f in files})
    return spark.createDataFrame([(n,) for n in names], "file_name string")


@register("stamp_month", panel_sql() + """
SELECT snapshot_month, CAST(count(*) AS BIGINT) AS n FROM panel GROUP BY snapshot_month""")
def q_stamp_month(spark: SparkSession, sf: str) -> DataFrame:
    """A3: rows per month stamped from the file names after loading."""
    from domus.sources.snapshots import load_snapshots

    df = load_snapshots(spark, _snapshot_dir(spark, sf))
    return df.groupBy("snapshot_month").agg(F.count(F.lit(1)).cast("long").alias("n"))
