"""Location operators: N1 city_centre, C2 district_lookup, N2 resolve_address,
N3 resolve_choice, N4 enrich_requests.

The place dictionary is a fixed dimension (15 centres, 77 districts). It is attached to
requests with a broadcast join on city — one row per city carrying that city's districts
as an array sorted by priority — so each request picks its first whole-word match with
``filter(...)[1]`` inside a projection: no shuffle, no per-request grouping, whatever the
number of requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.functions.geo import centre_distance
from domus.functions.text import normalise_text, word_contains


def places(spark: SparkSession) -> DataFrame:
    """District dimension: (city, priority, label, lat, lon, label_norm)."""
    rows = [(city, i, label, lat, lon) for city, ds in C.DISTRICTS.items()
            for i, (label, lat, lon) in enumerate(ds)]
    df = spark.createDataFrame(rows, "city string, priority int, label string, lat double, lon double")
    return df.withColumn("label_norm", normalise_text(F.col("label")))


def centres(spark: SparkSession) -> DataFrame:
    """Centre dimension: (city, centre_label, c_lat, c_lon)."""
    rows = [(city, f"{name} centrum", lat, lon) for city, (name, lat, lon) in C.CITY_CENTRES.items()]
    return spark.createDataFrame(rows, "city string, centre_label string, c_lat double, c_lon double")


def city_places(spark: SparkSession) -> DataFrame:
    """One row per city: centre + districts array ordered by priority (15 rows, broadcast)."""
    arr = (places(spark).groupBy("city").agg(F.array_sort(F.collect_list(
        F.struct("priority", "label", "label_norm", "lat", "lon"))).alias("districts")))
    return centres(spark).join(arr, "city", "left")


def attach_places(df: DataFrame, city_col: str = "city") -> DataFrame:
    """Broadcast-join the per-city dictionary row (fixed size) onto requests."""
    cp = city_places(df.sparkSession).withColumnRenamed("city", "_pl_city")
    return df.join(F.broadcast(cp), F.col(city_col) == F.col("_pl_city"), "left").drop("_pl_city")


def first_district_match(text_norm: Column) -> Column:
    """Highest-priority district whose normalised label occurs as whole words. The text is bound to a variable,
    so that it is normalised once a row and not once a district."""
    def first(text: Column) -> Column:
        return F.try_element_at(F.filter(F.col("districts"), lambda p: word_contains(text, p["label_norm"])), F.lit(1))

    return F.element_at(F.transform(F.array(text_norm), first), 1)


def _resolution(lat: Column, lon: Column, dist: Column, label: Column, matched: Column) -> dict[str, Column]:
    return {"latitude": lat, "longitude": lon, "centre_distance_km": dist, "label": label,
            "matched": matched}


def _centre(matched: Column) -> dict[str, Column]:
    return _resolution(F.col("c_lat"), F.col("c_lon"), F.lit(0.0), F.col("centre_label"), matched)


def _point(p: Column) -> dict[str, Column]:
    return _resolution(p["lat"], p["lon"], centre_distance(p["lat"], p["lon"], F.col("c_lat"), F.col("c_lon")),
                       p["label"], F.lit(True))


def _pick(cases: list[tuple[Column, dict[str, Column]]], default: dict[str, Column]) -> dict[str, Column]:
    out = {}
    for k in default:
        expr = None
        for cond, res in cases:
            expr = F.when(cond, res[k]) if expr is None else expr.when(cond, res[k])
        out[k] = expr.otherwise(default[k]) if expr is not None else default[k]
    return out


def with_hit(df: DataFrame, text: Column, asked: Column | None = None) -> DataFrame:
    """Add the normalised text (``_q``) and its district (``_hit``), for the rows that are ``asked``. They are columns
    of their own, because every column of a resolution reads them."""
    q = normalise_text(F.coalesce(text, F.lit("")))
    df = df.withColumn("_q", q if asked is None else F.when(asked, q))
    return df.withColumn("_hit", F.when(F.col("_q") != "", first_district_match(F.col("_q"))))


def address_resolution() -> dict[str, Column]:
    """N2 columns of a frame ``with_hit``: empty text -> centre (matched); district hit -> its point; else centre
    (not matched)."""
    q, hit = F.col("_q"), F.col("_hit")
    return _pick([(q == "", _centre(F.lit(True))), (hit.isNotNull(), _point(hit))],
                 _centre(F.lit(False)))


def resolve_address(df: DataFrame, text_col: str, city_col: str = "city") -> DataFrame:
    """Adds latitude, longitude, centre_distance_km, label, matched."""
    a = with_hit(attach_places(df, city_col), F.col(text_col))
    return a.withColumns(address_resolution()).drop("centre_label", "c_lat", "c_lon", "districts", "_q", "_hit")


def resolve_choice(df: DataFrame, choice_col: str, hint_col: str, city_col: str = "city") -> DataFrame:
    """N3: '__centre__' -> centre; '__other__' -> address text of the hint; an exact
    district label of the city -> its point; anything else -> ``reject_reason`` set and
    null coordinates (a batch row cannot raise)."""
    choice = F.col(choice_col)
    a = with_hit(attach_places(df, city_col), F.col(hint_col), choice == C.DISTRICT_OTHER)
    a = a.withColumn("_exact", F.try_element_at(F.filter(F.col("districts"), lambda p: p["label"] == choice), F.lit(1)))
    exact = F.col("_exact")
    res = _pick([(choice == C.DISTRICT_CENTRE, _centre(F.lit(True))),
                 (choice == C.DISTRICT_OTHER, address_resolution()),
                 (exact.isNotNull(), _point(exact))],
                {k: F.lit(None).cast(t) for k, t in
                 (("latitude", "double"), ("longitude", "double"), ("centre_distance_km", "double"),
                  ("label", "string"), ("matched", "boolean"))})
    known = (choice == C.DISTRICT_CENTRE) | (choice == C.DISTRICT_OTHER) | exact.isNotNull()
    reason = F.when(F.col("c_lat").isNull(), F.concat(F.lit("unknown city "), F.col(city_col))).when(
        ~known, F.concat(F.lit("unknown district "), choice, F.lit(" for city "), F.col(city_col)))
    return (a.withColumns(res).withColumn("reject_reason", reason)
            .drop("centre_label", "c_lat", "c_lon", "districts", "_q", "_hit", "_exact"))


def city_centre(df: DataFrame, city_col: str = "city") -> DataFrame:
    """Centre coordinates, distance 0.0, '<City> centrum', matched true."""
    a = attach_places(df, city_col)
    return a.withColumns(_centre(F.lit(True))).drop("centre_label", "c_lat", "c_lon", "districts")


def enrich_requests(df: DataFrame, choice_col: str = "district_choice", hint_col: str = "address_hint",
                    city_col: str = "city") -> DataFrame:
    """Attach latitude, longitude and centre distance to a whole table of requests."""
    return resolve_choice(df, choice_col, hint_col, city_col)
