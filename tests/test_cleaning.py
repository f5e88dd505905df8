import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidewatch.operators import cleaning, enrich
from tidewatch.schemas import CLEAN_SCHEMA, RAW_FIELDS, RAW_SCHEMA

GOOD = {
    "MMSI": "123456789", "BaseDateTime": "2024-12-25T00:00:10", "LAT": "29.8", "LON": "-95.1", "SOG": "10.5", "COG": "90",
    "Heading": "91", "VesselName": "ANNA", "IMO": "IMO1234567", "CallSign": "WXY", "VesselType": "70", "Status": "0",
    "Length": "100", "Width": "20", "Draft": "5.5", "Cargo": "70", "TransceiverClass": "A",
}


def parsed(spark, *changes):
    data = [tuple({**GOOD, **c}.get(f) for f in RAW_FIELDS) for c in changes]
    return spark.createDataFrame(data, RAW_SCHEMA)


def reasons(spark, profile, *changes):
    return [r["reject_reason"] for r in cleaning.classify(parsed(spark, *changes), profile).collect()]


def messages(spark, *bodies):
    data = [(b.encode() if b is not None else None, 0, i, dt.datetime(2025, 1, 1)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(data, "value binary, partition int, offset long, timestamp timestamp")


@pytest.mark.parametrize("change, reason", [
    ({}, None),
    ({"MMSI": None}, "MMSI_MISSING"),
    ({"MMSI": "MMSI"}, "HEADER"),
    ({"MMSI": "12345"}, "MMSI_FORMAT"),
    ({"MMSI": "ABC"}, "MMSI_FORMAT"),
    ({"MMSI": "1234567890"}, "MMSI_FORMAT"),
    ({"MMSI": " "}, "MMSI_FORMAT"),
    ({"MMSI": " 123456789 "}, None),
    ({"BaseDateTime": "bad-time"}, "TIMESTAMP"),
    ({"BaseDateTime": "2024/01/01"}, "TIMESTAMP"),
    ({"BaseDateTime": None}, "TIMESTAMP"),
    ({"LAT": "90"}, None),
    ({"LAT": "90.01"}, "LATLON_RANGE"),
    ({"LON": "-180"}, None),
    ({"LON": "-181"}, "LATLON_RANGE"),
    ({"LAT": None}, "LATLON_MISSING"),
    ({"LAT": "n/a"}, "LATLON_MISSING"),
    ({"LAT": "100", "LON": None}, "LATLON_RANGE"),
    ({"SOG": "-1"}, None),
])
def test_stream_reasons(spark, change, reason):
    assert reasons(spark, cleaning.STREAM, change) == [reason]


@pytest.mark.parametrize("change, reason", [
    ({"MMSI": " mmsi "}, "HEADER"),
    ({"SOG": "-1"}, "SOG_RANGE"),
    ({"SOG": "junk"}, None),
    ({"COG": "-0.1"}, "COG_RANGE"),
    ({"COG": "360"}, None),
    ({"Heading": "400"}, "HEADING_RANGE"),
    ({"Heading": "511"}, None),
])
def test_batch_reasons(spark, change, reason):
    assert reasons(spark, cleaning.BATCH, change) == [reason]


def test_sentinels_and_lenient_numbers(spark):
    typed = cleaning.classify(parsed(
        spark, {"SOG": "102.1", "COG": "359.9", "Heading": "0"}, {"SOG": "102.2", "COG": "360", "Heading": "511"},
        {"SOG": "abc", "VesselType": "70.9", "Cargo": "x", "Status": " 5 "},
    ))
    got = [tuple(r) for r in typed.select("SOG", "COG", "Heading", "VesselType", "Cargo", "Status").collect()]
    assert got[0][:3] == (102.1, 359.9, 0.0)
    assert got[1][:3] == (None, None, None)
    assert got[2][0] is None and got[2][3:] == (70, None, 5)


def test_stream_profile_end_to_end(spark):
    bodies = [json.dumps({**GOOD, **c}) for c in (
        {}, {"SOG": "11"}, {"VesselName": " ", "IMO": "IMO0000000", "CallSign": None, "BaseDateTime": "2024-12-25T00:00:11"},
    )]
    source = cleaning.parse_json(cleaning.kafka_columns(messages(spark, *bodies)))
    cleaned, rejected = cleaning.clean(source, cleaning.STREAM)
    assert cleaned.schema.names == CLEAN_SCHEMA.names
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in CLEAN_SCHEMA]
    first, second = cleaned.orderBy("BaseDateTime").collect()
    assert first["SOG"] == 10.5 and first["speed_kmh"] == pytest.approx(19.446)
    assert (first["day_of_week"], first["quarter"], str(first["date"])) == (4, 4, "2024-12-25")
    assert (second["VesselName"], second["IMO"], second["CallSign"]) == ("UNKNOWN",) * 3
    assert rejected.count() == 0


def test_json_split_and_raw_evidence(spark):
    source = messages(spark, '{"MMSI":', "[1,2]", '"x"', None, "", '{"Z":1}', json.dumps({**GOOD, "BaseDateTime": "bad"}))
    typed = cleaning.classify(cleaning.parse_json(cleaning.kafka_columns(source)))
    dead = rows(cleaning.json_rejects(typed), "kafka_offset", "raw_json")
    assert dead == [(0, '{"MMSI":'), (1, "[1,2]"), (2, '"x"')]
    kept = {r["kafka_offset"]: r for r in cleaning.rejects(typed).collect()}
    assert {o: r["reject_reason"] for o, r in kept.items()} == {3: "MMSI_MISSING", 4: "MMSI_MISSING", 5: "MMSI_MISSING", 6: "TIMESTAMP"}
    assert kept[6]["BaseDateTime"] == "bad" and json.loads(kept[6]["raw_json"])["BaseDateTime"] == "bad"
    assert cleaning.accepted(typed).count() == 0


def test_batch_profile_recovers_info_and_rounds(spark):
    source = parsed(
        spark, {"VesselName": None, "IMO": "imo0000000", "Draft": None},
        {"BaseDateTime": "2024-12-25T00:01:00", "VesselName": "LATE", "IMO": "IMO7"},
        {"BaseDateTime": "2024-12-25T00:02:00", "VesselName": "LATER"},
        {"MMSI": "987654321", "VesselName": None, "IMO": None},
    )
    cleaned, _ = cleaning.clean(source, cleaning.BATCH)
    got = {(r["MMSI"], r["BaseDateTime"].minute): r for r in cleaned.collect()}
    assert got[123456789, 0]["VesselName"] == "LATE" and got[123456789, 0]["IMO"] == "IMO7"
    assert got[123456789, 2]["VesselName"] == "LATER" and got[123456789, 0]["Draft"] == 5.5
    assert got[987654321, 0]["VesselName"] == "UNKNOWN" and got[987654321, 0]["IMO"] == "UNKNOWN"
    assert got[123456789, 0]["speed_kmh"] == 19.45


def test_batch_dedup_needs_all_four_keys(spark):
    source = parsed(spark, {}, {"SOG": "1"}, {"LAT": "29.9"})
    assert cleaning.clean(source, cleaning.BATCH)[0].count() == 2
    assert cleaning.clean(source, cleaning.STREAM)[0].count() == 1


def test_minimal_and_legacy_forms(spark):
    source = parsed(spark, {}, {}, {"SOG": "-2"}, {"LAT": None}, {"SOG": None, "LAT": "1"})
    assert rows(cleaning.clean_minimal(source), "LAT", "speed_kmh") == [(1.0, None), (29.8, 19.45)]
    legacy = spark.createDataFrame(
        [("1", "t", 1.0, 2.0, 3.0, None), ("1", "t", 1.0, 2.0, 4.0, None), ("2", "t", 91.0, 2.0, 3.0, 1.0), (None, "t", 1.0, 2.0, 3.0, 1.0)],
        "mmsi string, timestamp string, lat double, lon double, sog double, cog double",
    )
    got = cleaning.clean_legacy(legacy, "2024-12-25").collect()
    assert [(r["sog"], round(r["speed_kmh"], 3), r["run_date"]) for r in got] == [(3.0, 5.556, "2024-12-25")]


def test_union_rejects_mixes_types_without_failing(spark):
    typed = spark.createDataFrame([(123456789, 1.5, "A")], "MMSI long, LAT double, reject_reason string")
    text = spark.createDataFrame([("junk", "B")], "MMSI string, reject_reason string")
    assert rows(cleaning.union_rejects(typed, text), "MMSI", "LAT") == [("123456789", "1.5"), ("junk", None)]


def test_vessel_reference_spreads_when_it_does_not_fit(spark, monkeypatch):
    from tidewatch.operators import lookup

    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a: False)
    data = [(m, dt.datetime(2024, 1, 1, 0, 0, s), None if s == 0 else f"V{m}") for m in (1, 2) for s in range(5)]
    pings = spark.createDataFrame(data, "MMSI long, BaseDateTime timestamp, VesselName string")
    got = enrich.recover_vessel_info(pings, ["VesselName"])
    assert rows(got.groupBy("MMSI", "VesselName").agg(F.count("*"))) == [(1, "V1", 5), (2, "V2", 5)]
