"""Drift (two-sample cases + brute force), location, promotion decision table, registry."""

import random

import pytest
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import ModelNotLoadedError, MonitoringError, RegistryError
from domus.functions.text import normalise_text
from domus.operators import drift as D
from domus.operators import location as L
from domus.operators.promotion import recommend_promotion
from domus.operators.registry import Registry, RegistryPredictor
from domus.plans.drift_job import drift_by_month, drift_job


def test_no_drift(spark):
    rng = random.Random(1)
    base = [(rng.gauss(50, 5), "A" if i % 2 else "B") for i in range(500)]
    rows = [("reference", a, c) for a, c in base] + [("current", a, c) for a, c in reversed(base)]
    df = spark.createDataFrame(rows, "side string, area double, city string")
    v = D.drift_verdict(D.drift_features(df, ["area", "city"])).first()
    assert v["n_drifted"] == 0 and not v["dataset_drift"]


def test_both_drift(spark):
    rng = random.Random(2)
    rows = [("reference", rng.gauss(50, 5), "A" if i < 400 else "B") for i in range(500)]
    rows += [("current", rng.gauss(80, 5), "B" if i < 400 else "C") for i in range(500)]
    df = spark.createDataFrame(rows, "side string, area double, city string")
    v = D.drift_verdict(D.drift_features(df, ["area", "city"])).first()
    assert v["share_drifted"] == 1.0 and v["dataset_drift"] and v["drifted_features"] == "area,city"


def test_shared_columns_error():
    with pytest.raises(MonitoringError):
        D.shared_columns(["a"], ["b"])


def test_ks_matches_brute_force(spark):
    rng = random.Random(3)
    ref = [round(rng.gauss(0, 1), 1) for _ in range(300)]
    cur = [round(rng.gauss(0.3, 1), 1) for _ in range(200)]
    df = spark.createDataFrame([("reference", v) for v in ref] + [("current", v) for v in cur],
                               "side string, x double")
    d = D.ks_test(df, ["x"]).first()["statistic"]
    pts = sorted(set(ref + cur))
    brute = max(abs(sum(v <= p for v in ref) / len(ref) - sum(v <= p for v in cur) / len(cur)) for p in pts)
    assert abs(d - brute) < 1e-12


def test_drift_by_month_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"2024-0{m}", float(rng.randint(0, 20) + m), rng.choice("abc") if m < 3 else rng.choice("cd"))
            for m in range(1, 5) for _ in range(50)]
    df = spark.createDataFrame(rows, "snapshot_month string, x double, c string")
    got = {(r["snapshot_month"], r["feature"]): r["statistic"] for r in drift_by_month(df).collect()}
    for m in ("2024-02", "2024-03", "2024-04"):
        ref = [x for mm, x, _ in rows if mm < m]
        cur = [x for mm, x, _ in rows if mm == m]
        pts = sorted(set(ref + cur))
        brute = max(abs(sum(v <= p for v in ref) / len(ref) - sum(v <= p for v in cur) / len(cur)) for p in pts)
        assert abs(got[(m, "x")] - brute) < 1e-12
        import math
        rc = [c for mm, _, c in rows if mm < m]
        cc = [c for mm, _, c in rows if mm == m]
        psi = 0.0
        for cat in set(rc) | set(cc):
            r = rc.count(cat) / len(rc) + 1e-6
            c = cc.count(cat) / len(cc) + 1e-6
            psi += (c - r) * math.log(c / r)
        assert abs(got[(m, "c")] - psi) < 1e-9


def test_drift_job_single_month_halves(spark):
    df = spark.createDataFrame([(str(i), "2024-01", float(i)) for i in range(10)], "uid string, snapshot_month string, x double")
    rep, verdict = drift_job(df)
    row = rep.filter(F.col("feature") == "x").first()
    assert row["n_ref"] == 5 and row["n_cur"] == 5
    with pytest.raises(MonitoringError):
        drift_job(df.limit(1))


@pytest.mark.parametrize("text,plain", [
    ("ul. Puławska 10, Mokotów", "ul pulawska 10 mokotow"), ("  ŁÓDŹ--Śródmieście ", "lodz srodmiescie"),
    ("Lo\u0301dz\u0301 S\u0301ro\u0301dmies\u0301cie", "lodz srodmiescie"), ("søby", "s by"), ("Hà Nội", "ha noi"),
    ("Straße ﬁn", "strasse fin"), ("ＡＢ１²", "ab12"), ("Đà Æon", "a on"), ("日本 x", "x"), ("", "")])
def test_normalise_text(spark, text, plain):
    got = spark.createDataFrame([(text,)], "t string").select(normalise_text(F.col("t"))).first()[0]
    assert got == plain


def test_drift_of_columns_without_values(spark):
    from domus.operators import drift as D

    rows = [("reference", float(k), None, float(k)) for k in range(60)] + [("current", None, None, k + 30.0) for k in range(60)]
    df = spark.createDataFrame(rows, "side string, one double, none double, both double")
    got = {r.feature: r for r in D.drift_features(df).collect()}
    assert set(got) == {"one", "none", "both"}
    for name in ("one", "none"):
        assert got[name].statistic is None and got[name].p_value is None and got[name].drifted is None
    assert got["both"].drifted
    verdict = D.drift_verdict(D.drift_features(df)).first()
    assert verdict.n_features == 3 and verdict.n_drifted == 1 and abs(verdict.share_drifted - 1 / 3) < 1e-9


def test_table_forms_do_not_judge_without_a_metric(spark):
    from domus.operators import promotion as P

    df = spark.createDataFrame([("a", None, 1.0), ("b", None, None), ("c", 2.0, None), ("d", 1.0, 2.0)],
                               "name string, candidate double, incumbent double")
    got = {r.name: (r.should_promote, r.reason) for r in P.recommend_all(df).select(
        F.col("name"), "should_promote", "reason").collect() for r in [r]}
    assert got["a"][0] is None and got["b"][0] is None and "no metric" in got["a"][1]
    assert got["c"] == (True, P.NO_INCUMBENT) and got["d"][0] is True and got["d"][1].endswith("-> promote")


def test_no_stage_event_without_a_version(spark, tmpdir_path):
    from domus.errors import ModelNotFoundError
    from domus.plans.training import FittedModel

    reg = Registry(spark, tmpdir_path)
    model = FittedModel("simple_linear", {c: 1.0 for c in C.NUMERIC_FEATURES}, slope=2.0, intercept=3.0, q=4.5)
    reg.log_and_register(model, "m", {"mae": 10.0})
    with pytest.raises(ModelNotFoundError):
        reg.transition_stage("m", "2", "production")
    assert reg.log_and_register(model, "m", {"mae": 9.0})["stage"] == "none"
    with pytest.raises(ModelNotFoundError):
        reg.get_version("m", "production")


def test_location_cases(spark):
    reqs = spark.createDataFrame([
        (1, "warszawa", "ul. Puławska 10, Mokotów"), (2, "warszawa", ""), (3, "warszawa", "nowhere"),
        (4, "krakow", "STARE MIASTO"), (5, "lodz", "Śródmieście i Bałuty")],
        "k int, city string, addr string")
    out = {r["k"]: r for r in L.resolve_address(reqs, "addr").collect()}
    assert out[1]["label"] == "Mokotów" and out[1]["matched"] and out[1]["centre_distance_km"] > 0
    assert out[2]["label"] == "Warszawa centrum" and out[2]["matched"] and out[2]["centre_distance_km"] == 0.0
    assert out[3]["label"] == "Warszawa centrum" and not out[3]["matched"]
    assert out[4]["label"] == "Stare Miasto"
    assert out[5]["label"] == "Śródmieście"  # first dictionary entry wins
    ch = spark.createDataFrame([(1, "warszawa", C.DISTRICT_CENTRE, ""), (2, "warszawa", C.DISTRICT_OTHER, "Wola"),
                                (3, "warszawa", "Wilanów", ""), (4, "warszawa", "Atlantis", "")],
                               "k int, city string, choice string, hint string")
    got = {r["k"]: r for r in L.resolve_choice(ch, "choice", "hint").collect()}
    assert got[1]["label"] == "Warszawa centrum" and got[2]["label"] == "Wola" and got[3]["label"] == "Wilanów"
    assert got[4]["reject_reason"].startswith("unknown district") and got[4]["latitude"] is None


@pytest.mark.parametrize("cand,inc,lower,thr,expected", [
    ({"mae": 90.0}, None, True, 0.0, True),
    ({"mae": 90.0}, {"mae": 100.0}, True, 0.0, True),
    ({"mae": 110.0}, {"mae": 100.0}, True, 0.0, False),
    ({"mae": 100.0}, {"mae": 100.0}, True, 0.0, False),
    ({"r2": 0.9}, {"r2": 0.8}, False, 0.05, True),
    ({"mae": 1.0}, {"mae": 0.0}, True, 0.0, False),
])
def test_promotion_table(cand, inc, lower, thr, expected):
    key = next(iter(cand))
    r = recommend_promotion(cand, inc, primary=key, lower_is_better=lower, min_relative_improvement=thr)
    assert r["should_promote"] is expected
    if inc is not None:
        assert ("promote" if expected else "hold") in r["reason"]


def test_promotion_missing_metric():
    with pytest.raises(RegistryError):
        recommend_promotion({}, None)
    with pytest.raises(RegistryError):
        recommend_promotion({"mae": 1.0}, {"rmse": 1.0})


def test_registry_round_trip(spark, tmpdir_path):
    from domus.plans.training import FittedModel

    reg = Registry(spark, tmpdir_path)
    pred = RegistryPredictor(reg, "m")
    with pytest.raises(ModelNotLoadedError):
        pred.ensure_loaded()
    assert not pred.describe()["loaded"]
    model = FittedModel("simple_linear", {c: 1.0 for c in C.NUMERIC_FEATURES}, slope=2.0, intercept=3.0, q=4.5)
    v1 = reg.log_and_register(model, "m", {"mae": 10.0})
    v2 = reg.log_and_register(model, "m", {"mae": 9.0})
    assert (v1["version"], v2["version"]) == ("1", "2")
    reg.transition_stage("m", "1", "staging")
    reg.transition_stage("m", "2", "staging")
    assert reg.get_version("m", "staging")["version"] == "2"
    reg.transition_stage("m", "1", "production")
    loaded = reg.load_model("m", "production")
    assert loaded.q == 4.5 and loaded.slope == 2.0
    assert pred.ensure_loaded()[1] == "1"


def test_metric_tags(spark):
    from domus.functions.maps import map_merge, metric_tags

    df = spark.createDataFrame([({"metric.mae": "1.5", "metric.bad": "x", "owner": "me"},)],
                               "tags map<string,string>")
    got = df.select(metric_tags(F.col("tags")).alias("m")).first()["m"]
    assert got == {"mae": 1.5}
    merged = df.select(map_merge(metric_tags(F.col("tags")), F.create_map(F.lit("mae"), F.lit(2.0))).alias("m"))
    assert merged.first()["m"] == {"mae": 2.0}


def test_racing_registrations_get_numbers_of_their_own(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor

    names = ["price", "odd name/..%"]

    def register(k):
        return Registry(spark, tmpdir_path).register_all({n: {"mae": float(k)} for n in names})

    with ThreadPoolExecutor(6) as pool:
        taken = list(pool.map(register, range(6)))
    for n in names:
        assert sorted(t[n] for t in taken) == [1, 2, 3, 4, 5, 6]
    stored = Registry(spark, tmpdir_path).versions().collect()
    assert sorted((r.name, r.version) for r in stored) == sorted((n, v) for n in names for v in range(1, 7))
    # a writer that died between its claim and its row: the number stays unused
    assert Registry(spark, tmpdir_path)._claim("price", 7) and not Registry(spark, tmpdir_path)._claim("price", 7)
    assert register(9)["price"] == 8


def test_exact_law_of_two_samples(spark):
    """Against all orders of small samples, against values worked out before, and the switch to the asymptotic law."""
    from itertools import combinations
    from math import comb

    from domus.functions.stats import EXACT_ROWS, exact_pvalue, ks_pvalue

    assert round(exact_pvalue(0.22, 60, 100), 4) == 0.0461 and round(exact_pvalue(0.325, 30, 40), 4) == 0.0435
    for n1, n2 in ((1, 1), (3, 4), (4, 4), (2, 6), (5, 3)):
        found = []
        for places in combinations(range(n1 + n2), n1):
            i = j = top = 0
            for k in range(n1 + n2):
                i, j = (i + 1, j) if k in places else (i, j + 1)
                top = max(top, abs(i * n2 - j * n1))
            found.append(top)
        for d in sorted(set(found)):
            assert abs(exact_pvalue(d / (n1 * n2), n1, n2) - sum(x >= d for x in found) / comb(n1 + n2, n1)) < 1e-12
    assert exact_pvalue(0.0, 5, 9) == 1.0 and exact_pvalue(1.0, 10_000, 10_000) < 1e-9
    rows = [(0.22, 60, 100), (None, 5, 0), (0.02, EXACT_ROWS + 1, 5000), (0.02, EXACT_ROWS, 5000)]
    got = [r.p for r in spark.createDataFrame(rows, "d double, a long, b long").select(
        ks_pvalue(F.col("d"), F.col("a"), F.col("b")).alias("p")).collect()]
    assert round(got[0], 4) == 0.0461 and got[1] is None and abs(got[2] - got[3]) < 5e-3 and got[2] != got[3]


def test_month_sweep_with_gaps_ids_and_many_buckets(spark, monkeypatch):
    """Months in which a column has no values, ids seen once, ties, values of one month only; many small buckets."""
    import math

    from domus.operators import rank as R

    monkeypatch.setattr(R, "SAMPLE", 120)
    r = random.Random(8)
    rows = []
    for k in range(700):
        m = r.choice((1, 2, 4, 5, 6, 7, 9, 10, 11, 12))
        rows.append((f"2024-{m:02d}", None if m == 5 and k % 2 else r.choice([1.0, 1.0, 2.5, r.gauss(0, 2) + m / 6]),
                     None if m < 6 else float(k % 9), f"id{k}", r.choice(["a", None, f"c{m}"])))
    df = spark.createDataFrame(rows, "snapshot_month string, x double, late double, id string, c string").repartition(5)
    got = {(x.snapshot_month, x.feature): x for x in drift_by_month(df).collect()}
    months = sorted({x[0] for x in rows})
    for m in months[1:]:
        for name, at in (("x", 1), ("late", 2)):
            ref = [x[at] for x in rows if x[0] < m and x[at] is not None]
            cur = [x[at] for x in rows if x[0] == m and x[at] is not None]
            if not ref or not cur:
                assert got[m, name].statistic is None
                continue
            brute = max(abs(sum(v <= p for v in ref) / len(ref) - sum(v <= p for v in cur) / len(cur)) for p in set(ref + cur))
            assert abs(got[m, name].statistic - brute) < 1e-12 and (got[m, name].n_ref, got[m, name].n_cur) == (len(ref), len(cur))
        for name, at in (("id", 3), ("c", 4)):
            ref, cur = [x[at] for x in rows if x[0] < m], [x[at] for x in rows if x[0] == m]
            psi = 0.0
            for cat in set(ref) | set(cur):
                a, b = ref.count(cat) / len(ref) + 1e-6, cur.count(cat) / len(cur) + 1e-6
                psi += (b - a) * math.log(b / a)
            assert abs(got[m, name].statistic - psi) < 1e-9


def test_addresses_are_normalised_once_a_row(spark):
    """each column and each district of a resolution normalised the text again."""
    city = next(iter(C.DISTRICTS))
    label, lat, lon = C.DISTRICTS[city][1]
    texts = [None, "", "--", f"ul. X 1, {label.upper()}", "nowhere", "Straße ﬁ"]
    df = spark.createDataFrame([(k, city, t, C.DISTRICT_OTHER) for k, t in enumerate(texts)],
                               "k int, city string, hint string, choice string")
    out = L.resolve_address(df, "hint")
    # the texts and the dictionary, each with the branches of one normalisation
    assert out._jdf.queryExecution().optimizedPlan().toString().count("translate(") <= 8
    assert out.columns == ["k", "city", "hint", "choice", "latitude", "longitude", "centre_distance_km", "label", "matched"]
    centre, c_lat, c_lon = C.CITY_CENTRES[city]
    for got in (out, L.resolve_choice(df, "choice", "hint").drop("reject_reason")):
        rows = {r.k: (r.latitude, r.longitude, r.label, r.matched) for r in got.collect()}
        assert rows == {k: (lat, lon, label, True) if k == 3 else (c_lat, c_lon, f"{centre} centrum", k < 3) for k in range(6)}


def test_drift_jobs_work_the_input_out_once(spark):
    """The split and the tests read one written table: the input is read once, and the counts of categories are too."""
    from domus.operators import drift as D
    from domus.plans.drift_job import drift_job

    acc = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def city(k):
        acc.add(1)
        return f"c{k % 3}"

    df = spark.range(60).select(F.col("id").cast("string").alias("uid"), city.asNondeterministic()("id").alias("city"),
                                F.col("id").cast("double").alias("x"),
                                F.when(F.col("id") < 40, "2024-01").otherwise("2024-02").alias("snapshot_month"))
    rep, verdict = drift_job(df, cols=["city", "x"])
    rep.collect()
    verdict.collect()
    assert acc.value == 60
    sided = D.reference_current(df.select("city", "snapshot_month"))
    p = D.psi(sided, ["city"])
    once = acc.value
    p.collect()
    p.collect()
    assert acc.value == once
