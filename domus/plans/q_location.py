"""Queries: location resolution (N1–N4, C2) and the text/geo helpers it relies on (H2, H3,
H12, H13). Requests are built from the customer table: city by nation key, a district
choice and a free-text address hint picked from the place dictionary by key arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.functions.geo import centre_distance_sql, haversine_km, haversine_sql
from domus.functions.text import normalise_text, normalise_text_sql
from domus.operators import location as L
from domus.plans.catalog import register
from domus.sources.panel import table

CITY_KEYS = list(C.CITY_CENTRES)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """(c_custkey, city, district_choice, address_hint) for every customer (stand-in input)."""
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    city = F.element_at(F.array(*[F.lit(c) for c in CITY_KEYS]), (F.col("c_nationkey") % 15 + 1).cast("int"))
    n = F.when(city == "warszawa", F.lit(len(C.DISTRICTS["warszawa"]))).otherwise(F.lit(5))
    pl = L.places(spark).select(F.col("city").alias("_c"), "priority", "label", "label_norm")
    base = cust.withColumn("city", city).withColumn("slot", (F.col("c_custkey") % n).cast("int"))
    j = base.join(F.broadcast(pl), (F.col("city") == F.col("_c")) & (F.col("slot") == F.col("priority")), "left")
    k, v = F.col("c_custkey") % 4, (F.floor(F.col("c_custkey") / 4) % 4)
    choice = (F.when(k == 0, F.lit(C.DISTRICT_CENTRE)).when(k == 1, F.lit(C.DISTRICT_OTHER))
              .when(k == 2, F.col("label")).otherwise(F.concat(F.lit("Osiedle "), F.col("c_custkey").cast("string"))))
    hint = (F.when(v == 0, F.concat(F.lit("ul. Długa "), (F.col("c_custkey") % 90 + 1).cast("string"),
                                    F.lit(", "), F.col("label")))
            .when(v == 1, F.concat(F.upper(F.col("label")), F.lit(" "), (F.col("c_custkey") % 50).cast("string")))
            .when(v == 2, F.concat(F.lit("Nowhere street "), F.col("c_custkey").cast("string")))
            .otherwise(F.lit("")))
    return j.select("c_custkey", "city", choice.alias("district_choice"), hint.alias("address_hint"))


def _places_values() -> str:
    rows = []
    for city, ds in C.DISTRICTS.items():
        for i, (label, lat, lon) in enumerate(ds):
            rows.append(f"('{city}', {i}, '{label}', CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))")
    return ", ".join(rows)


def _centre_values() -> str:
    return ", ".join(f"('{c}', '{name} centrum', CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))"
                     for c, (name, lat, lon) in C.CITY_CENTRES.items())


CITY_LIST = "[" + ", ".join(f"'{c}'" for c in CITY_KEYS) + "]"

REQ_SQL = f"""WITH pl AS (SELECT city, priority, label, lat, lon, {normalise_text_sql('label')} AS label_norm
            FROM (VALUES {_places_values()}) AS t(city, priority, label, lat, lon)),
ce AS (SELECT * FROM (VALUES {_centre_values()}) AS t(city, centre_label, c_lat, c_lon)),
b AS (SELECT c_custkey, {CITY_LIST}[c_nationkey % 15 + 1] AS city FROM customer),
b2 AS (SELECT b.*, CAST(c_custkey % CASE WHEN city = 'warszawa' THEN 7 ELSE 5 END AS INTEGER) AS slot FROM b),
j AS (SELECT b2.*, pl.label FROM b2 LEFT JOIN pl ON pl.city = b2.city AND pl.priority = b2.slot),
req AS (SELECT c_custkey, city,
          CASE WHEN c_custkey % 4 = 0 THEN '{C.DISTRICT_CENTRE}' WHEN c_custkey % 4 = 1 THEN '{C.DISTRICT_OTHER}'
               WHEN c_custkey % 4 = 2 THEN label ELSE 'Osiedle ' || CAST(c_custkey AS VARCHAR) END AS district_choice,
          CASE WHEN (c_custkey // 4) % 4 = 0 THEN 'ul. Długa ' || CAST(c_custkey % 90 + 1 AS VARCHAR) || ', ' || label
               WHEN (c_custkey // 4) % 4 = 1 THEN upper(label) || ' ' || CAST(c_custkey % 50 AS VARCHAR)
               WHEN (c_custkey // 4) % 4 = 2 THEN 'Nowhere street ' || CAST(c_custkey AS VARCHAR)
               ELSE '' END AS address_hint
        FROM j),
rq AS (SELECT req.*, {normalise_text_sql("coalesce(address_hint, '')")} AS qn FROM req),
hit AS (SELECT rq.c_custkey, min(pl.priority) AS pr FROM rq JOIN pl ON pl.city = rq.city
          AND contains(' ' || rq.qn || ' ', ' ' || pl.label_norm || ' ') GROUP BY rq.c_custkey),
addr AS (SELECT rq.*, ce.centre_label, ce.c_lat, ce.c_lon, p.label AS h_label, p.lat AS h_lat, p.lon AS h_lon
         FROM rq JOIN ce ON ce.city = rq.city LEFT JOIN hit ON hit.c_custkey = rq.c_custkey
         LEFT JOIN pl p ON p.city = rq.city AND p.priority = hit.pr),
ex AS (SELECT addr.*, e.label AS e_label, e.lat AS e_lat, e.lon AS e_lon FROM addr
       LEFT JOIN pl e ON e.city = addr.city AND e.label = addr.district_choice)"""


def _addr_cols(prefix: str = "") -> dict[str, str]:
    """SQL CASE pieces for address resolution."""
    dist = centre_distance_sql("h_lat", "h_lon", "c_lat", "c_lon")
    return {
        "latitude": "CASE WHEN qn = '' THEN c_lat WHEN h_label IS NOT NULL THEN h_lat ELSE c_lat END",
        "longitude": "CASE WHEN qn = '' THEN c_lon WHEN h_label IS NOT NULL THEN h_lon ELSE c_lon END",
        "centre_distance_km": f"CASE WHEN qn = '' THEN 0.0 WHEN h_label IS NOT NULL THEN {dist} ELSE 0.0 END",
        "label": "CASE WHEN qn = '' THEN centre_label WHEN h_label IS NOT NULL THEN h_label ELSE centre_label END",
        "matched": "CASE WHEN qn = '' THEN true WHEN h_label IS NOT NULL THEN true ELSE false END",
    }


def _choice_cols() -> dict[str, str]:
    a = _addr_cols()
    edist = centre_distance_sql("e_lat", "e_lon", "c_lat", "c_lon")
    ex = {"latitude": "e_lat", "longitude": "e_lon", "centre_distance_km": edist, "label": "e_label",
          "matched": "true"}
    ce = {"latitude": "c_lat", "longitude": "c_lon", "centre_distance_km": "0.0", "label": "centre_label",
          "matched": "true"}
    out = {}
    for k in a:
        out[k] = (f"CASE WHEN district_choice = '{C.DISTRICT_CENTRE}' THEN {ce[k]} "
                  f"WHEN district_choice = '{C.DISTRICT_OTHER}' THEN {a[k]} "
                  f"WHEN e_label IS NOT NULL THEN {ex[k]} ELSE NULL END")
    out["reject_reason"] = (f"CASE WHEN district_choice IN ('{C.DISTRICT_CENTRE}', '{C.DISTRICT_OTHER}') "
                            f"OR e_label IS NOT NULL THEN NULL ELSE 'unknown district ' || district_choice "
                            f"|| ' for city ' || city END")
    return out


def _sel(cols: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in cols.items())


@register("city_centre", REQ_SQL + """
SELECT c_custkey, city, c_lat AS latitude, c_lon AS longitude, CAST(0.0 AS DOUBLE) AS centre_distance_km,
       centre_label AS label, true AS matched FROM ex""")
def q_city_centre(spark: SparkSession, sf: str) -> DataFrame:
    """Every request's city centre (distance 0, '<City> centrum', matched)."""
    return L.city_centre(requests(spark, sf)).select(
        "c_custkey", "city", "latitude", "longitude", "centre_distance_km", "label", "matched")


@register("district_lookup", REQ_SQL + """
SELECT c_custkey, h_label AS district FROM ex""")
def q_district_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """First (highest-priority) district of the city whose label occurs in the address."""
    a = L.attach_places(requests(spark, sf))
    q = normalise_text(F.coalesce(F.col("address_hint"), F.lit("")))
    return a.select("c_custkey", L.first_district_match(q)["label"].alias("district"))


@register("resolve_address", REQ_SQL + "\nSELECT c_custkey, " + _sel(_addr_cols()) + " FROM ex")
def q_resolve_address(spark: SparkSession, sf: str) -> DataFrame:
    """Address text -> district point, or centre (matched only for empty text)."""
    r = L.resolve_address(requests(spark, sf), "address_hint")
    return r.select("c_custkey", "latitude", "longitude", "centre_distance_km", "label", "matched")


@register("resolve_choice", REQ_SQL + "\nSELECT c_custkey, " + _sel(_choice_cols()) + " FROM ex")
def q_resolve_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Dropdown choice (centre / other+hint / exact label / unknown -> reject reason)."""
    r = L.resolve_choice(requests(spark, sf), "district_choice", "address_hint")
    return r.select("c_custkey", "latitude", "longitude", "centre_distance_km", "label", "matched",
                    "reject_reason")


@register("enrich_requests", REQ_SQL + "\nSELECT c_custkey, city, district_choice, address_hint, "
          + _sel(_choice_cols()) + " FROM ex")
def q_enrich_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The whole request table with latitude, longitude and centre distance attached."""
    r = L.enrich_requests(requests(spark, sf))
    return r.select("c_custkey", "city", "district_choice", "address_hint", "latitude", "longitude",
                    "centre_distance_km", "label", "matched", "reject_reason")


@register("normalise_text", REQ_SQL + f"""
SELECT c_custkey, {normalise_text_sql('address_hint')} AS normalised,
       {normalise_text_sql('district_choice')} AS choice_normalised FROM req""")
def q_normalise_text(spark: SparkSession, sf: str) -> DataFrame:
    """H2: normalised address hints and district choices."""
    r = requests(spark, sf)
    return r.select("c_custkey", normalise_text(F.col("address_hint")).alias("normalised"),
                    normalise_text(F.col("district_choice")).alias("choice_normalised"))


@register("word_contains", REQ_SQL + """
SELECT rq.c_custkey, pl.label, contains(' ' || rq.qn || ' ', ' ' || pl.label_norm || ' ') AS hit
FROM rq JOIN pl ON pl.city = rq.city""")
def q_word_contains(spark: SparkSession, sf: str) -> DataFrame:
    """H3: whole-word containment of every district label of the request's city."""
    from domus.functions.text import word_contains

    r = requests(spark, sf).withColumn("qn", normalise_text(F.coalesce(F.col("address_hint"), F.lit(""))))
    pl = L.places(spark).withColumnRenamed("city", "_c")
    # the dictionary is fixed (77 rows): a broadcast join fanning out <= 7 labels per request
    j = r.join(F.broadcast(pl), F.col("city") == F.col("_c"))
    return j.select("c_custkey", "label", word_contains(F.col("qn"), F.col("label_norm")).alias("hit"))


@register("haversine_km", REQ_SQL + f"""
SELECT rq.c_custkey, pl.label, round({haversine_sql('ce.c_lat', 'ce.c_lon', 'pl.lat', 'pl.lon')}, 6) AS km
FROM rq JOIN pl ON pl.city = rq.city JOIN ce ON ce.city = rq.city""")
def q_haversine_km(spark: SparkSession, sf: str) -> DataFrame:
    """Great-circle distance from the city centre to each district of the request's city."""
    r = requests(spark, sf)
    pl = L.places(spark).withColumnRenamed("city", "_c")
    ce = L.centres(spark).withColumnRenamed("city", "_cc")
    j = (r.join(F.broadcast(pl), F.col("city") == F.col("_c"))
         .join(F.broadcast(ce), F.col("city") == F.col("_cc")))
    km = haversine_km(F.col("c_lat"), F.col("c_lon"), F.col("lat"), F.col("lon"))
    return j.select("c_custkey", "label", F.round(km, 6).alias("km"))


@register("centre_distance", REQ_SQL + f"""
SELECT c_custkey, {centre_distance_sql('e_lat', 'e_lon', 'c_lat', 'c_lon')} AS centre_distance_km FROM ex
WHERE e_label IS NOT NULL""")
def q_centre_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Rounded centre distance of each exactly chosen district."""
    r = L.resolve_choice(requests(spark, sf), "district_choice", "address_hint")
    exact = ~F.col("district_choice").isin(C.DISTRICT_CENTRE, C.DISTRICT_OTHER) & F.col("reject_reason").isNull()
    return r.filter(exact).select("c_custkey", "centre_distance_km")
