"""Notification parsing (F1-F3, P1-P5, J1, J2, L3) edge cases."""

import json


from gridspark.functions.messages import accepted, parse_notifications, rejected
from gridspark.operators import match as M

FIELDS = {"bucket": "b", "name": "lwe_snowfall_rate", "key": "0e6c.nc",
          "created_time": "2019-07-19T16:18:22Z", "forecast_reference_time": "2019-07-19T12:00:00Z"}


def body(msg):
    return json.dumps({"Message": msg if isinstance(msg, str) else json.dumps(msg)})


def parse(spark, bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    return parse_notifications(df)


def test_valid_message(spark):
    rows = accepted(parse(spark, [body(FIELDS)])).collect()
    assert [r.asDict() for r in rows] == [FIELDS]


def test_doubled_backslashes_are_removed(spark):
    inner = json.dumps({**FIELDS, "name": "lwe_\\snowfall_rate"})  # JSON text carries a backslash pair
    assert "\\\\" in inner
    rows = accepted(parse(spark, [body(inner)])).collect()
    assert rows[0]["name"] == "lwe_snowfall_rate"


def test_rejects_with_reasons(spark):
    missing = {k: v for k, v in FIELDS.items() if k != "created_time"}
    bodies = [
        json.dumps({"Msg": json.dumps(FIELDS)}),
        body(json.dumps(FIELDS)[:-1]),
        body(missing),
        "not json at all",
        body(FIELDS),
    ]
    out = {r["reject_reason"] for r in rejected(parse(spark, bodies)).collect()}
    assert out == {"no Message in envelope", "malformed Message", "missing field: created_time"}
    assert accepted(parse(spark, bodies)).count() == 1


def test_same_key_twice_is_kept(spark):
    assert accepted(parse(spark, [body(FIELDS), body(FIELDS)])).count() == 2


def test_name_filter_is_full_case_insensitive_equality(spark):
    rows = [body({**FIELDS, "name": n}) for n in ("CLICK", "click", "clicks", "Click")]
    n = accepted(parse(spark, rows))
    assert M.filter_name_ci(n, "cLiCk").count() == 3


def test_param_join_exact_and_case_insensitive(spark):
    rows = [body({**FIELDS, "name": n}) for n in ("lwe_snowfall_rate", "LWE_SNOWFALL_RATE", "other")]
    n = accepted(parse(spark, rows))
    params = M.params_frame(spark, {"lwe_snowfall_rate": "lwe_snowfall_rate,projection_y_coordinate,projection_x_coordinate,1"})
    assert M.match_params(n, params).count() == 1
    assert M.match_params(n, params, case_insensitive=True).count() == 2
    assert M.is_wanted(n, params).count() == 1


def test_file_names(spark):
    n = accepted(parse(spark, [body(FIELDS)]))
    r = M.with_file_names(n, "/data/in", None).first()
    assert r["file_name"] == "lwe_snowfall_rate_2019-07-19T16:18:22Z_0e6c.nc"
    assert r["file_path"] == "/data/in/" + r["file_name"]
    assert r["object_uri"] == "s3a://b/0e6c.nc" and r["object_name"] == "0e6c.nc"
    r2 = M.with_file_names(n, "/data/in", "file:/store/").first()
    assert r2["object_uri"] == "file:/store/0e6c.nc"


def test_cap_takes_earliest(spark):
    rows = [body({**FIELDS, "created_time": f"2019-07-19T16:18:{s:02d}Z"}) for s in (9, 3, 7, 1, 5, 2)]
    got = [r["created_time"][-3:-1] for r in M.cap(accepted(parse(spark, rows)), 3).collect()]
    assert got == ["01", "02", "03"]


def test_params_names_are_unique(spark):
    import pytest

    with pytest.raises(ValueError):
        M.params_frame(spark, [("n", "m", "y", "x", 1)] * 2)


def test_names_equal_but_for_case_match_once(spark):
    n = accepted(parse(spark, [body(FIELDS)]))
    params = M.params_frame(spark, [("lwe_snowfall_rate", "a", "y", "x", 1), ("LWE_snowfall_rate", "b", "y", "x", 1)])
    assert [r["measure"] for r in M.match_params(n, params, case_insensitive=True).collect()] == ["b"]
    assert [r["measure"] for r in M.match_params(n, params).collect()] == ["a"]


def test_stored_name_uses_the_last_part_of_a_key(spark):
    n = accepted(parse(spark, [body({**FIELDS, "key": "a/b c/0e6c.nc"})]))
    r = M.with_file_names(n, "/data/in", None).first()
    assert r["file_name"] == "lwe_snowfall_rate_2019-07-19T16:18:22Z_0e6c.nc" and r["object_uri"] == "s3a://b/a/b c/0e6c.nc"


def test_matched_cap_counts_matched_messages_only(spark):
    rows = [body({**FIELDS, "name": "other" if s % 2 else "lwe_snowfall_rate", "created_time": f"2019-07-19T16:18:{s:02d}Z"}) for s in range(8)]
    params = M.params_frame(spark, [("lwe_snowfall_rate", "m", "y", "x", 1)])
    got = [r["created_time"][-3:-1] for r in M.matched_cap(accepted(parse(spark, rows)), params, 2).collect()]
    assert got == ["00", "02"]


def test_params_broadcast_in_plan(spark):
    n = accepted(parse(spark, [body(FIELDS)]))
    params = M.params_frame(spark, [("lwe_snowfall_rate", "m", "y", "x", 1)])
    plan = M.match_params(n, params)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_commas_in_names_survive_typed_columns(spark):
    """Typed columns carry names with commas that comma-joined text rows would split."""
    n = accepted(parse(spark, [body({**FIELDS, "name": "rain,rate", "key": "a,b.nc"})]))
    params = M.params_frame(spark, [("rain,rate", "rain", "y", "x", -1)])
    r = M.with_file_names(M.match_params(n, params), "/d").first()
    assert r["file_name"] == "rain,rate_2019-07-19T16:18:22Z_a,b.nc" and r["object_name"] == "a,b.nc"
