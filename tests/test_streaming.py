"""Stream scoring: a replayed batch, malformed lines, and the same rows as batch scoring."""

import json

from pyspark.sql import functions as F

from domus import constants as C
from domus.operators.contract import RuleSpec
from domus.plans.training import FittedModel, batch_score
from domus.streaming.scoring import CORRUPT, score_batch, stream_score

RULES = [RuleSpec("not_null", "city", ())]


def model():
    return FittedModel("simple_linear", {c: 1.0 for c in C.NUMERIC_FEATURES}, slope=1000.0, intercept=5.0, q=100.0)


def lines():
    good = [{"request_id": str(k), "city": "warszawa", "square_meters": 30.0 + k} for k in range(5)]
    bad = [{"request_id": "no-city", "square_meters": 10.0}]
    return [json.dumps(r) for r in good + bad] + ['{"request_id": "cut', '{"request_id": "type", "city": "x", "rooms": "many"}']


def test_stream_equals_batch_and_rejects_malformed_lines(spark, tmpdir_path):
    src, log, rejected = (f"{tmpdir_path}/{n}" for n in ("src", "log", "rejected"))
    spark.createDataFrame([(x,) for x in lines()], "value string").coalesce(1).write.text(src)
    for _ in range(2):  # the second run finds nothing new
        stream_score(spark, src, model(), RULES, log, rejected, f"{tmpdir_path}/ck", "m", "1")
    got = {(r.request_id, float(r.predicted_price), float(r.interval_low)) for r in spark.read.parquet(log).collect()}
    frame = spark.createDataFrame([(str(k), "warszawa", 30.0 + k) for k in range(5)], "request_id string, city string, "
                                  "square_meters double")
    for c in C.REQUEST_COLUMNS:
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(None).cast("double"))
    want = {(r.request_id, float(r.predicted_price), float(r.interval_low))
            for r in batch_score(model(), frame, "m", "1", keep=("request_id",)).collect()}
    assert got == want and len(got) == 5 and spark.read.parquet(log).count() == 5
    reasons = {r.reject_reason for r in spark.read.parquet(rejected).collect()}
    assert "malformed" in reasons and len(reasons) == 2 and spark.read.parquet(rejected).count() == 3


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmpdir_path):
    from domus.streaming.scoring import stream_schema

    batch = spark.createDataFrame([], stream_schema()).unionByName(
        spark.createDataFrame([("1", "warszawa", 40.0)], "request_id string, city string, square_meters double"),
        allowMissingColumns=True)
    assert CORRUPT in batch.columns
    for batch_id in (0, 0, 1):
        score_batch(batch, model(), RULES, f"{tmpdir_path}/log", f"{tmpdir_path}/rej", "m", "1", batch_id=batch_id)
    assert spark.read.parquet(f"{tmpdir_path}/log").count() == 2


def test_requests_with_unknown_fields_are_rejected_by_name(spark, tmpdir_path):
    src, log, rejected = (f"{tmpdir_path}/{n}" for n in ("src", "log", "rejected"))
    good = {"request_id": "a", "city": "warszawa", "square_meters": 30.0}
    texts = [json.dumps(good), json.dumps({**good, "request_id": "b", "colour": "red"}),
             json.dumps({"request_id": "c", "Rooms": 3}), "", "  ", "[1, 2]", '"text"',
             json.dumps({**good, "request_id": "d", "nested": {"x": 1}, "rooms": 2})]
    spark.createDataFrame([(x,) for x in texts], "value string").coalesce(1).write.text(src)
    stream_score(spark, src, model(), RULES, log, rejected, f"{tmpdir_path}/ck", "m", "1")
    assert [r.request_id for r in spark.read.parquet(log).collect()] == ["a"]
    got = {(r.request_id, r.request): r.reject_reason for r in spark.read.parquet(rejected).collect()}
    assert set(got) == {("b", texts[1]), ("c", texts[2]), ("d", texts[7]), (None, "[1, 2]"), (None, '"text"')}
    assert got["b", texts[1]] == got["d", texts[7]] == "column_extra"
    assert got["c", texts[2]].startswith("column_extra,") and got[None, "[1, 2]"] == got[None, '"text"'] == "malformed"


def outcome_rows(spark, path):
    return {(r.window_start.hour, r.outcome): r for r in spark.read.parquet(path).collect()}


def test_windows_without_events_and_late_events(spark, tmpdir_path):
    """Every window has both outcomes and all buckets; an event behind the watermark changes nothing."""
    import datetime as dt

    from domus.operators.monitoring import LATENCY_BUCKETS
    from domus.streaming.outcomes import EVENTS_SCHEMA, bucket_name, stream_outcome_metrics

    def write(rows, name):
        spark.createDataFrame([(k, dt.datetime(2024, 1, 1, h, m), 1, kind, v, None) for k, (h, m, kind, v) in enumerate(rows)],
                              EVENTS_SCHEMA).coalesce(1).write.parquet(f"{tmpdir_path}/in/{name}")

    def run():
        return stream_outcome_metrics(spark, f"{tmpdir_path}/in/*", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", "*.parquet")

    write([(0, 10, "view", 0.2), (0, 50, "error", 9.0), (1, 5, "view", 0.005), (1, 30, "buy", 0.3), (5, 15, "view", None)], "a")
    run()
    got = outcome_rows(spark, f"{tmpdir_path}/out")
    # the watermark is 04:15: hours 0 to 3 are closed, two of them without an event
    assert set(got) == {(h, o) for h in range(4) for o in ("ok", "error")}
    assert (got[0, "ok"].n, got[0, "error"].n, got[1, "ok"].n, got[1, "error"].n) == (1, 1, 2, 0)
    assert all(got[h, o].n == 0 for h in (2, 3) for o in ("ok", "error"))
    assert got[0, "error"].latency_sum is None and got[2, "ok"].latency_sum == 0.0 and abs(got[1, "ok"].latency_sum - 0.305) < 1e-9
    for b in LATENCY_BUCKETS:
        assert got[1, "ok"][bucket_name(b)] == sum(v <= b for v in (0.005, 0.3)) and got[0, "error"][bucket_name(b)] == 0
    write([(0, 30, "view", 0.1), (2, 30, "view", 0.1), (4, 30, "view", 0.1), (7, 59, "error", 1.0)], "b")
    run()
    late = outcome_rows(spark, f"{tmpdir_path}/out")
    assert all(late[k] == got[k] for k in got)  # closed windows stay as they were
    assert set(late) == {(h, o) for h in range(6) for o in ("ok", "error")}
    assert late[4, "ok"].n == 1 and late[5, "ok"].n == 1 and late[5, "ok"].le_10_0 == 0
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 12


def test_a_batch_is_not_kept(spark, tmpdir_path, monkeypatch):
    """the parsed rows of a whole batch were kept on disk while both sinks were written."""
    from pyspark.sql.classic.dataframe import DataFrame

    def kept(*_):
        raise AssertionError("a batch was persisted")

    for name in ("persist", "cache"):
        monkeypatch.setattr(DataFrame, name, kept)
    batch = spark.createDataFrame([("1", "warszawa", 40.0), ("2", None, 41.0)],
                                  "request_id string, city string, square_meters double")
    for c in C.REQUEST_COLUMNS:
        if c not in batch.columns:
            batch = batch.withColumn(c, F.lit(None).cast("double"))
    score_batch(batch, model(), RULES, f"{tmpdir_path}/log", f"{tmpdir_path}/rejected", "m", "1", batch_id=3)
    assert [r.request_id for r in spark.read.parquet(f"{tmpdir_path}/log").collect()] == ["1"]
    assert [r.request_id for r in spark.read.parquet(f"{tmpdir_path}/rejected").collect()] == ["2"]
