"""The shared test tables seen as a listing panel (stand-in input).

The driver's test tables hold no listings, so operators are exercised on a *panel view*
built from lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part. This module only shapes rows
into the raw snapshot schema (camelCase columns, yes/no text); all the listing work
(rename, yes/no parsing, coercion, contract, features, ...) runs afterwards through the
library's own operators.

Column formulas (same in the DuckDB oracle, see ``panel_sql``):

- uid  = orderkey-linenumber-partkey-suppkey-yyyymmdd(shipdate)  (unique row key)
- id   = orderkey-linenumber  (not unique: a natural upsert key together with month)
- city = customer nation name; type = p_type (null when partkey % 5 = 0)
- squareMeters = 25 + 2.5 * quantity; rooms = linenumber; floor/floorCount/poiCount = p_size
  (floor null when suppkey % 6 = 0); buildYear = year(shipdate) - p_size (null when
  orderkey % 6 = 0); latitude = 49 + (partkey % 600) / 100; longitude = 14 + (suppkey % 1000) / 100
- centreDistance = int(round(tax * 100)); seven distances ((partkey + j) % 30) / 10, null when
  (partkey + j) % 9 = 0
- ownership = returnflag; buildingMaterial = linestatus (null when orderkey % 5 < 2);
  condition = orderpriority (null when orderkey % 4 = 0)
- has* raw text = yes / No / YES / maybe by (linenumber + j) % 4; hasElevator also null when
  orderkey % 20 = 0
- price = 225000 + 22500 * quantity + 40000 * linenumber - 8000 * round(tax * 100) + floor(extendedprice)
- month = yyyy-MM of shipdate

Join plan: orders ⋈ customer on custkey (shuffle), ⋈ nation (broadcast: the nation
dimension is fixed at 25 rows), then lineitem ⋈ part on partkey and ⋈ orders on orderkey
(shuffle joins; AQE may switch a side to broadcast when its measured size is small).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.sources.snapshots import normalise

_YES_NO = ("yes", "No", "YES", "maybe")
_BOOL_RAW = ("hasParkingSpace", "hasBalcony", "hasElevator", "hasSecurity", "hasStorageRoom")
_DIST_RAW = ("schoolDistance", "clinicDistance", "postOfficeDistance", "kindergartenDistance",
             "restaurantDistance", "collegeDistance", "pharmacyDistance")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _yes_no_text(j: int) -> Column:
    k = (F.col("l_linenumber") + j) % 4
    out = F.when(k == 0, _YES_NO[0])
    for i in range(1, 4):
        out = out.when(k == i, _YES_NO[i])
    return out


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the raw snapshot schema (28 camelCase columns) plus ``uid`` and ``_month``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")

    oc = (orders.join(cust, orders.o_custkey == cust.c_custkey)
          .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
          .select("o_orderkey", "o_orderpriority", "n_name"))
    rows = (li.join(part, li.l_partkey == part.p_partkey)
            .join(oc, li.l_orderkey == oc.o_orderkey))

    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    tax100 = F.round(F.col("l_tax") * 100)
    cols: dict[str, Column] = {
        "uid": F.concat_ws("-", ok, F.col("l_linenumber"), pk, sk,
                           F.date_format("l_shipdate", "yyyyMMdd")),
        "id": F.concat_ws("-", ok, F.col("l_linenumber")),
        "city": F.col("n_name"),
        "type": _null_when(pk % 5 == 0, F.col("p_type")),
        "squareMeters": F.lit(25.0) + F.lit(2.5) * F.col("l_quantity"),
        "rooms": F.col("l_linenumber").cast("long"),
        "floor": _null_when(sk % 6 == 0, F.col("p_size").cast("long")),
        "floorCount": F.col("p_size").cast("long"),
        "buildYear": _null_when(ok % 6 == 0, (F.year("l_shipdate") - F.col("p_size")).cast("long")),
        "latitude": F.lit(49.0) + (pk % 600) / 100.0,
        "longitude": F.lit(14.0) + (sk % 1000) / 100.0,
        "centreDistance": tax100.cast("int").cast("double"),
        "poiCount": F.col("p_size").cast("long"),
    }
    for j, name in enumerate(_DIST_RAW, start=1):
        cols[name] = _null_when((pk + j) % 9 == 0, ((pk + j) % 30) / 10.0)
    cols["ownership"] = F.col("l_returnflag")
    cols["buildingMaterial"] = _null_when(ok % 5 < 2, F.col("l_linestatus"))
    cols["condition"] = _null_when(ok % 4 == 0, F.col("o_orderpriority"))
    for j, name in enumerate(_BOOL_RAW, start=1):
        text = _yes_no_text(j)
        cols[name] = _null_when(ok % 20 == 0, text) if name == "hasElevator" else text
    cols["price"] = (F.lit(225000) + F.lit(22500) * F.col("l_quantity")
                     + F.lit(40000) * F.col("l_linenumber") - F.lit(8000) * tax100
                     + F.floor("l_extendedprice")).cast("long")
    cols["_month"] = F.date_format("l_shipdate", "yyyy-MM")
    return rows.select(*[c.alias(n) for n, c in cols.items()])


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised panel: the 29 contract columns plus the unique row key ``uid``."""
    raw = raw_panel(spark, sf_dir).withColumnRenamed("_month", "snapshot_month")
    return normalise(raw, keep=("uid",))


# ---------------------------------------------------------------------------
# DuckDB twin of the panel view, used by the oracle SQL strings.
# ---------------------------------------------------------------------------
def _sql_yes_no(j: int) -> str:
    k = f"((l_linenumber + {j}) % 4)"
    return (f"CASE WHEN {k} = 0 THEN '{_YES_NO[0]}' WHEN {k} = 1 THEN '{_YES_NO[1]}' "
            f"WHEN {k} = 2 THEN '{_YES_NO[2]}' WHEN {k} = 3 THEN '{_YES_NO[3]}' END")


def _sql_bool(raw: str) -> str:
    return f"CASE WHEN lower({raw}) = 'yes' THEN true WHEN lower({raw}) = 'no' THEN false END"


def panel_sql(raw: bool = False) -> str:
    """``WITH`` clause defining ``panel`` (29 contract columns + uid) in DuckDB SQL.

    With ``raw`` the five ``has_*`` columns keep their yes/no text."""
    dist = ",\n".join(
        f"CASE WHEN (l_partkey + {j}) % 9 = 0 THEN NULL ELSE CAST((l_partkey + {j}) % 30 AS DOUBLE) / 10.0 END AS {n}"
        for j, n in enumerate(C.DISTANCE_COLUMNS, start=1))
    bools = []
    for j, n in enumerate(C.BOOL_FEATURES, start=1):
        text = _sql_yes_no(j)
        if n == "has_elevator":
            text = f"CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE {text} END"
        bools.append(f"({text}) AS {n}" if raw else f"{_sql_bool('(' + text + ')')} AS {n}")
    bools_sql = ",\n".join(bools)
    return f"""WITH panel AS (
SELECT
  concat_ws('-', l_orderkey, l_linenumber) AS id,
  n_name AS city,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE p_type END AS property_type,
  25.0 + 2.5 * l_quantity AS square_meters,
  CAST(l_linenumber AS BIGINT) AS rooms,
  CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS floor,
  CAST(p_size AS BIGINT) AS floor_count,
  CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE CAST(year(l_shipdate) - p_size AS BIGINT) END AS build_year,
  49.0 + CAST(l_partkey % 600 AS DOUBLE) / 100.0 AS latitude,
  14.0 + CAST(l_suppkey % 1000 AS DOUBLE) / 100.0 AS longitude,
  CAST(CAST(round(l_tax * 100) AS INTEGER) AS DOUBLE) AS centre_distance_km,
  CAST(p_size AS BIGINT) AS poi_count,
  {dist},
  l_returnflag AS ownership,
  CASE WHEN l_orderkey % 5 < 2 THEN NULL ELSE l_linestatus END AS building_material,
  CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS condition,
  {bools_sql},
  CAST(225000 + 22500 * l_quantity + 40000 * l_linenumber - 8000 * round(l_tax * 100)
       + floor(l_extendedprice) AS BIGINT) AS price_pln,
  strftime(l_shipdate, '%Y-%m') AS snapshot_month,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS uid
FROM lineitem
JOIN part ON p_partkey = l_partkey
JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
)"""
