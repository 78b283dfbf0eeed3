"""Decode cases: envelope, payload forms, bad values, aliases, renames."""

import json

from pyspark.sql import functions as F

from skyvane import schema as S
from skyvane import feeds as FE
from skyvane.functions import decode as D


def _records(spark, lines):
    return spark.createDataFrame([(bytearray(l.encode()),) for l in lines], "value binary")


def _decode(spark, lines, **kw):
    return D.decode_stream(_records(spark, lines), **kw)


def test_object_and_quoted_payload_decode_the_same(spark):
    payload = {"value": 1.5, "k": 3, "sensor": "click", "phase": "cruise"}
    obj = json.dumps({"timestamp": 10.5, "sensor": "click", "value": payload})
    quoted = json.dumps({"timestamp": 10.5, "sensor": "click", "value": json.dumps(payload)})
    rows = _decode(spark, [obj, quoted]).select("features", "value", "k").collect()
    assert rows[0] == rows[1]
    assert rows[0]["features"] == {"value": 1.5, "k": 3.0}
    assert (rows[0]["value"], rows[0]["k"]) == (1.5, 3.0)


def test_scalar_payload_becomes_value_feature(spark):
    r = _decode(spark, [json.dumps({"timestamp": 1.0, "sensor": "error", "value": 3.2})]).first()
    assert r["features"] == {"value": 3.2}
    assert r["value"] == 3.2 and r["k"] is None


def test_malformed_line_goes_to_dead_letters(spark):
    good, dead = D.split_dead_letters(_decode(spark, ["not json", json.dumps(
        {"timestamp": 1.0, "sensor": "click", "value": {"value": 1}})]))
    assert good.count() == 1
    assert [r["json_str"] for r in dead.collect()] == ["not json"]


def test_bad_timestamp_is_null_other_fields_kept(spark):
    r = _decode(spark, [json.dumps({"timestamp": "bad", "sensor": "click",
                                    "value": {"value": 2}})]).first()
    assert r["timestamp"] is None and r["sensor"] == "click" and r["value"] == 2.0


def test_non_numeric_feature_is_null_not_error(spark):
    r = _decode(spark, [json.dumps({"timestamp": 1.0, "sensor": "flap",
                                    "value": {"value": "OK", "k": 4}})]).first()
    assert r["value"] is None and r["k"] == 4.0
    assert r["features"] == {"k": 4.0}


def test_faulty_key_names_coalesce_to_one_feature(spark):
    lines = [json.dumps({"timestamp": 1.0, "sensor": "view", "value": {"value (units)": 7.0,
                                                                         "k (count)": 2}}),
             json.dumps({"timestamp": 2.0, "sensor": "view", "value": {"value": 8.0, "k": 1}})]
    rows = _decode(spark, lines).orderBy("timestamp").select("value", "k", "features").collect()
    assert [(r["value"], r["k"]) for r in rows] == [(7.0, 2.0), (8.0, 1.0)]
    assert rows[0]["features"] == {"value": 7.0, "k": 2.0}


def test_wing_payloads_flatten_with_aliases_and_renames(spark):
    healthy = {"temperature_C": -12.5, "gradient_C_per_min": 0.1, "thermal_stability": "STABLE"}
    faulty = {"temperature (Degree C)": -3.0, "jitter (Degree C)": 0.2}
    lines = [json.dumps({"timestamp": 1.0, "sensor": "fueltemp", "value": healthy}),
             json.dumps({"timestamp": 2.0, "sensor": "wing_surface_pressure",
                         "value": {"dynamic_pressure (Pa)": 1100.0}}),
             json.dumps({"timestamp": 3.0, "sensor": "fueltemp", "value": faulty})]
    lines.append(json.dumps({"timestamp": 4.0, "sensor": "wingtip_strain", "value": {"temperature_C": -20.0, "snr_dB": 31.0}}))
    records = spark.createDataFrame([(x,) for x in lines], "value string")
    out = FE.decode(records, FE.WING).orderBy("timestamp").collect()
    assert out[0]["fuel_temp"] == -12.5 and out[2]["fuel_temp"] == -3.0 and out[2]["fuel_jitter"] == 0.2
    assert out[1]["sensor"] == "pressure" and out[1]["pressure"] == 1100.0
    # one raw key, two quantities: the sensor decides
    assert out[3]["strain_temp"] == -20.0 and out[3]["fuel_temp"] is None and out[3]["snr"] == 31.0
    # the edge feature map drops text values and renames known keys
    edge = _decode(spark, lines[:1], key_map=S.WING_KEY_MAP).first()
    assert edge["features"] == {"fuel_temp": -12.5, "gradient_C_per_min": 0.1}


def test_missing_key_is_null(spark):
    df = spark.createDataFrame([('{"a": "1"}',)], "v string")
    m = D.payload_map(F.col("v"))
    assert df.select(D.coalesce_aliases(m, ["b", "c"]).alias("x")).first()["x"] is None


def test_envelope_round_trip_matches_readings(spark):
    from tests.conftest import SF0001
    from skyvane.sources import telemetry as T
    r = T.readings(spark, SF0001).select("event_id", "sensor", "phase", "value", "k")
    d = _decode_records(spark, T.envelope_records(spark, SF0001)).select(
        "event_id", "sensor", "phase", "value", "k")
    assert r.exceptAll(d).count() == 0 and d.exceptAll(r).count() == 0


def _decode_records(spark, records):
    return D.decode_stream(records)
