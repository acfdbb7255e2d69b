"""Snapshot loading, normalisation and the contract (mutation per rule)."""

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus import constants as C
from domus.errors import ContractError, DataError, StorageError
from domus.operators import contract as K
from domus.sources.snapshots import load_snapshots
from domus.sources.store import TableStore

HEADER = list(C.RENAME)


def _row(i, city="warszawa"):
    vals = {"id": f"id{i}", "city": city, "type": "blockOfFlats" if i % 3 else "", "squareMeters": 50.5,
            "rooms": 3, "floor": "" if i % 4 == 0 else 2, "floorCount": 5, "buildYear": 1990,
            "latitude": 52.2, "longitude": 21.0, "centreDistance": 3.1, "poiCount": 10,
            "schoolDistance": 0.2, "clinicDistance": 0.3, "postOfficeDistance": 0.4,
            "kindergartenDistance": 0.5, "restaurantDistance": 0.6, "collegeDistance": 0.7,
            "pharmacyDistance": 0.8, "ownership": "udział", "buildingMaterial": "brick", "condition": "",
            "hasParkingSpace": "yes", "hasBalcony": "no", "hasElevator": "YES" if i % 2 else "",
            "hasSecurity": "No", "hasStorageRoom": "maybe", "price": 500000 + i}
    return [vals[h] for h in HEADER]


def _write(path, rows, header=HEADER):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def test_load_snapshots_filters_and_stamps(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "apartments_pl_2023_08.csv"), [_row(i) for i in range(60)])
    _write(os.path.join(tmpdir_path, "apartments_pl_2024_06.csv"), [_row(i) for i in range(40)])
    _write(os.path.join(tmpdir_path, "apartments_rent_pl_2024_06.csv"), [_row(1)])
    _write(os.path.join(tmpdir_path, "apartments_pl_2024_06_extra.csv"), [_row(1)])
    df = load_snapshots(spark, tmpdir_path)
    assert df.columns == list(C.LISTING_COLUMNS)
    assert df.count() == 100
    months = {r[0]: r[1] for r in df.groupBy("snapshot_month").count().collect()}
    assert months == {"2023-08": 60, "2024-06": 40}
    types = dict(df.dtypes)
    assert types["has_parking"] == "boolean" and types["floor"] == "bigint"
    row = df.filter(F.col("id") == "id1").first()
    assert row["has_parking"] is True and row["has_balcony"] is False
    assert row["has_storage"] is None and row["has_security"] is False
    assert row["ownership"] == "udział"


def test_load_snapshots_reordered_header(spark, tmpdir_path):
    rows = [_row(i) for i in range(5)]
    rev = list(reversed(HEADER))
    _write(os.path.join(tmpdir_path, "apartments_pl_2024_01.csv"), [list(reversed(r)) for r in rows], rev)
    _write(os.path.join(tmpdir_path, "apartments_pl_2024_02.csv"), rows)
    df = load_snapshots(spark, tmpdir_path)
    assert df.count() == 10
    assert df.filter(F.col("price_pln") == 500003).count() == 2


def test_load_snapshots_errors(spark, tmpdir_path):
    with pytest.raises(DataError):
        load_snapshots(spark, tmpdir_path)
    _write(os.path.join(tmpdir_path, "apartments_pl_2024_01.csv"), [_row(1)[:-1]], HEADER[:-1])
    with pytest.raises(DataError):
        load_snapshots(spark, tmpdir_path)


def _valid(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "apartments_pl_2023_08.csv"),
           [[v if v not in ("", "maybe") else ("yes" if h.startswith("has") else v)
             for h, v in zip(HEADER, _row(i))] for i in range(20)])
    return load_snapshots(spark, tmpdir_path)


@pytest.mark.parametrize("col,value,rule", [
    ("price_pln", 0, "range"), ("square_meters", 10.0, "range"), ("city", "paris", "isin"),
    ("latitude", 60.0, "range")])
def test_contract_mutations(spark, tmpdir_path, col, value, rule):
    df = _valid(spark, tmpdir_path)
    contract = K.listing_contract()
    assert contract.validate(df) == []
    bad = df.withColumn(col, F.when(F.col("id") == "id3", F.lit(value)).otherwise(F.col(col)))
    fails = contract.validate(bad)
    assert (rule, col, 1) in fails
    with pytest.raises(ContractError):
        contract.validate(bad, raise_on_error=True)


def test_contract_columns(spark, tmpdir_path):
    df = _valid(spark, tmpdir_path)
    c = K.listing_contract()
    assert ("column_missing", "price_pln", 0) in c.validate(df.drop("price_pln"))
    assert ("column_extra", "x", 0) in c.validate(df.withColumn("x", F.lit(1)))


def test_split_valid_rejected_and_record_rules(spark, tmpdir_path):
    df = _valid(spark, tmpdir_path).withColumn(
        "build_year", F.when(F.col("id") == "id2", F.lit(2999)).otherwise(F.col("build_year")))
    rules = K.listing_contract(as_of=dt.date(2026, 1, 1), record=True).rules()
    valid, rejected = K.split_valid_rejected(df, rules)
    assert valid.count() == 19
    assert rejected.first()["reject_reason"] == ["not_future:build_year"]


def test_null_profile_and_price_per_sqm(spark):
    df = spark.createDataFrame([(1, 100.0, 3), (None, 7.0, 3)], "a int, b double, price_pln long")
    prof = {r["column"]: r["n_null"] for r in K.null_profile(df).collect()}
    assert prof == {"a": 1, "b": 0, "price_pln": 0}
    out = spark.createDataFrame([(1203471, 120.0), (612345, 50.0)], "price_pln long, square_meters double")
    got = [r[0] for r in out.select(K.price_per_sqm()).collect()]
    assert got == [round(1203471 / 120.0, 2), round(612345 / 50.0, 2)]


def test_table_store(spark, tmpdir_path):
    store = TableStore(spark, tmpdir_path)
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "listing_id string, price double")
    store.write("t1", df)
    store.write("t1", df.limit(1))
    assert store.read("t1").count() == 1
    with pytest.raises(StorageError):
        store.read("missing")
    for bad in ("1abc", "a-b", "a b", "x;drop"):
        with pytest.raises(StorageError):
            store.write(bad, df)


def test_cells_that_do_not_parse_are_counted(spark):
    from domus import constants as C
    from domus.operators.contract import FAILURES, coercion_counts
    from domus.sources.snapshots import LISTING_TYPES, normalise

    back = {v: k for k, v in C.RENAME.items()}
    names = [c for c in C.LISTING_COLUMNS if c != "snapshot_month"]
    good = {c: "1" if not isinstance(LISTING_TYPES[c], T.StringType) else "x" for c in names}
    rows = [good, {**good, "rooms": "3.0"}, {**good, "rooms": "3.5"}, {**good, "rooms": "many", "latitude": "north"},
            {**good, "rooms": None}]
    raw = spark.createDataFrame([tuple(r[c] for c in names) for r in rows],
                                ", ".join(f"`{back.get(c, c)}` string" for c in names))
    out = normalise(raw, F.lit("2024-01"), failures=True)
    assert sorted(coercion_counts(out)) == [("coercion", "latitude", 1), ("coercion", "rooms", 2)]
    assert [r.rooms for r in out.collect()] == [1, 3, None, None, None]
    assert FAILURES not in normalise(raw, F.lit("2024-01")).columns


def test_upsert_keeps_the_later_row_by_number(spark, tmpdir_path):
    from domus import constants as C
    from domus.sources import listings as LS

    defaults = {f.name: {"string": "x", "double": 1.0, "bigint": 1, "boolean": True}[f.dataType.simpleString()]
                for f in LS.LISTINGS_SCHEMA.fields}
    rows = [{**defaults, "id": "a", "snapshot_month": "2024-01", "price_pln": p, "seq": s} for s, p in ((9, 100), (10, 200))]
    schema = T.StructType([*LS.LISTINGS_SCHEMA.fields, T.StructField("seq", T.LongType())])
    batch = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
    for _ in range(2):  # twice: the second upsert changes nothing
        assert LS.upsert(spark, f"{tmpdir_path}/t", batch, order_col="seq") == 2
        assert [(r.id, r.price_pln) for r in LS.fetch_all(spark, f"{tmpdir_path}/t").collect()] == [("a", 200)]
    assert set(C.LISTING_COLUMNS) == {f.name for f in LS.LISTINGS_SCHEMA.fields}


def test_an_unreadable_table_is_not_an_empty_one(spark, tmpdir_path):
    from domus.sources.store import read_if_there

    schema = T.StructType([T.StructField("a", T.LongType())])
    assert read_if_there(spark, f"{tmpdir_path}/nothing", schema) is None
    with pytest.raises(Exception, match="(?i)scheme|filesystem|UnknownHost|class"):
        read_if_there(spark, "nowhere://host/table", schema)


def test_only_rows_whose_key_repeats_compete_for_it(spark, tmpdir_path, monkeypatch):
    """Rows of keys that occur once aren't shuffled to find winners, and a large batch is written and fetched in more parts
    than the session shuffles into, in order."""
    import domus.sources.listings as LS

    def listing(i, k):
        return {**{c: None for c in LS.C.LISTING_COLUMNS}, "id": i, "snapshot_month": "2024-01", "price_pln": k, "city": "a",
                **{r.column: v for r in LS._NOT_NULL if (v := _some(r.column)) is not None}, "_o": k}

    def _some(c):
        kind = LS.LISTING_TYPES[c].typeName()
        return None if c in ("id", "snapshot_month", "price_pln", "city") else {
            "string": "x", "double": 50.0, "long": 2, "boolean": False}[kind]

    schema = LS.T.StructType([*LS.LISTINGS_SCHEMA.fields, LS.T.StructField("_o", LS.T.LongType())])
    rows = [listing(f"i{k:04d}", k) for k in range(300)] + [listing("i0007", 1000), listing("i0009", 5), listing("i0007", 999)]
    batch = spark.createDataFrame([[r[f.name] for f in schema.fields] for r in rows], schema).repartition(3)
    want = {f"i{k:04d}": k for k in range(300)} | {"i0007": 1000, "i0009": 9}
    assert sorted((r.id, r.price_pln) for r in LS.winners(batch).collect()) == sorted(want.items())
    once = LS.winners(batch.dropDuplicates(["id"]))
    assert "Window" not in once._jdf.queryExecution().toString()
    monkeypatch.setattr(LS, "PART_ROWS", 5)
    LS.upsert(spark, f"{tmpdir_path}/t", batch, order_col="_o")
    stored = LS.fetch_all(spark, f"{tmpdir_path}/t")
    assert stored.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [(r.id, r.price_pln) for r in stored.collect()] == sorted(want.items())


def test_upsert_filter_never_lets_a_twin_through(spark, tmpdir_path, monkeypatch):
    """Against a dictionary: hot keys, several batches, a filter with far too few bits."""
    import random

    from domus import constants as C
    from domus.sources import listings as LS

    monkeypatch.setattr(LS, "FILTER_BUCKETS", 1)
    monkeypatch.setattr(LS, "_BITS", 64)  # nearly every stored row is a suspect
    r, want = random.Random(5), {}
    values = {c: {"string": "x", "double": 1.0, "bigint": 1, "boolean": True}[t.simpleString()] for c, t in LS.LISTING_TYPES.items()}
    for size in (400, 150, 1):
        rows = []
        for k in range(size):
            key = ("hot", "2024-01") if k % 3 == 0 else (f"i{r.randint(0, 200)}", f"2024-0{r.randint(1, 4)}")
            rows.append((*key, len(want) * 1000 + k, k))
            want[key] = len(want) * 1000 + k
        prices = spark.createDataFrame([(*x[:2], p, x[3]) for x, p in zip(rows, [x[2] for x in rows])],
                                       "id string, snapshot_month string, price_pln long, seq long")
        batch = prices.select(*[F.col(c) if c in prices.columns else F.lit(values[c]).cast(LS.LISTING_TYPES[c]).alias(c)
                                for c in C.LISTING_COLUMNS], "seq")
        assert LS.upsert(spark, f"{tmpdir_path}/t", batch.repartition(4), order_col="seq") == size
        got = {(x.id, x.snapshot_month): x.price_pln for x in LS.fetch_all(spark, f"{tmpdir_path}/t").collect()}
        assert got == want


def test_most_stored_rows_pass_the_filter_unshuffled(spark):
    from domus.sources import listings as LS

    stored = spark.range(20_000).select(F.concat(F.lit("s"), "id").alias("id"), F.lit("2024-01").alias("snapshot_month"), F.lit(1).alias("v"))
    keys = spark.range(19_990, 20_500).select(F.concat(F.lit("s"), "id").alias("id"), F.lit("2024-01").alias("snapshot_month"))
    bits, buckets = LS.key_filter(keys, 510)
    assert buckets == 1 and bits.count() == 1
    assert LS.without_twins(stored, keys, 510).count() == 19_990


def test_headers_of_several_orders_and_quotes(spark, tmpdir_path):
    """Three orders of columns, one with further columns, in nested folders; only first lines are read for the headers."""
    from domus.sources.snapshots import read_headers

    rows = [_row(i) for i in range(7)]
    os.makedirs(f"{tmpdir_path}/deep/er")
    _write(f"{tmpdir_path}/apartments_pl_2024_01.csv", rows)
    _write(f"{tmpdir_path}/deep/apartments_pl_2024_02.csv", [list(reversed(r)) for r in rows], list(reversed(HEADER)))
    _write(f"{tmpdir_path}/deep/er/apartments_pl_2024_03.csv", [["x,y", *r, "z"] for r in rows], ["note, quoted", *HEADER, "more"])
    headers = {tuple(r.header) for r in read_headers(spark, tmpdir_path).collect()}
    assert headers == {tuple(HEADER), tuple(reversed(HEADER)), ("note, quoted", *HEADER, "more")}
    df = load_snapshots(spark, tmpdir_path)
    assert df.columns == list(C.LISTING_COLUMNS) and df.count() == 21
    per = df.drop("snapshot_month")
    by_month = [sorted(map(repr, per.filter(df.snapshot_month == m).collect())) for m in ("2024-01", "2024-02", "2024-03")]
    assert by_month[0] == by_month[1] == by_month[2]


def test_cells_that_do_not_parse_fail_the_flow_without_asking(spark, tmpdir_path):
    from domus.plans.training import train_on_files
    from domus.sources.snapshots import load_checked

    rows = [_row(i) for i in range(30)]
    rows[3][HEADER.index("price")] = "cheap"
    rows[4][HEADER.index("buildYear")] = "19x0"
    rows[5][HEADER.index("buildYear")] = "old"
    _write(f"{tmpdir_path}/apartments_pl_2024_01.csv", rows)
    _, failures = load_checked(spark, tmpdir_path)
    assert failures == [("coercion", "build_year", 2), ("coercion", "price_pln", 1)]
    with pytest.raises(ContractError, match="coercion"):
        train_on_files(spark, tmpdir_path)


def test_months_of_loaded_files_take_no_regular_expression(spark, tmpdir_path):
    """the file filter fixes the form of a name, so year and month are cut from its end; they equal the captured ones."""
    from domus.sources.snapshots import month_from_file_name

    os.makedirs(f"{tmpdir_path}/shard 1/apartments_pl_1999_01")
    _write(f"{tmpdir_path}/apartments_pl_2023_08.csv", [_row(i) for i in range(3)])
    _write(f"{tmpdir_path}/shard 1/apartments_pl_1999_01/apartments_pl_2024_12.csv", [_row(i) for i in range(4)])
    df = load_snapshots(spark, tmpdir_path)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    assert "regexp_extract" not in plan
    assert {r[0]: r[1] for r in df.groupBy("snapshot_month").count().collect()} == {"2023-08": 3, "2024-12": 4}
    names = spark.createDataFrame([("apartments_pl_2023_08.csv",), ("apartments_pl_0001_12.csv",)], "n string")
    both = names.select(month_from_file_name(F.col("n")).alias("a"), month_from_file_name(F.col("n"), filtered=True).alias("b"))
    assert [tuple(r) for r in both.collect()] == [("2023-08", "2023-08"), ("0001-12", "0001-12")]
