import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import labels, timeparts
from tidegrid.operators import compaction, flatten, quality
from tidegrid.sources import bronze
from tidegrid.streaming.hourly import silver_rows


def put(root, source, day, name, doc, text=None):
    y, m, d = day.split("-")
    folder = root / source / f"year={y}" / f"month={m}" / f"day={d}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text if text is not None else json.dumps(doc, indent=2))


def weather_doc(hours, **extra):
    return {"queryCost": 1, "address": "x", "days": [{"datetime": "2024-01-01", "hours": hours}], **extra}


def load_doc(records, key="data"):
    return {"zone": "Z", key: records, "_metadata": {"signal": "total_load", "query_date": "2024-01-01", "zone": "Z"}}


def test_weather_documents(spark, tmp_path):
    hours = [
        {"datetime": "00:30:00", "temp": "x1", "humidity": 80},
        {"datetime": "13:00:00", "temp": 24.5, "humidity": "79.5", "precip": 0},
    ]
    put(tmp_path, "weather", "2024-01-05", "data.json", weather_doc(hours))
    put(tmp_path, "weather", "2024-01-06", "13_30.json", weather_doc(hours[1:]))
    put(tmp_path, "weather", "2024-01-07", "data.json", {"queryCost": 1, "days": []})
    put(tmp_path, "weather", "2024-01-08", "data.json", None, "{ not json")
    docs = bronze.read_bronze(spark, str(tmp_path), "weather")
    good, bad = quality.check_payload(docs, "weather")
    assert {(r["query_date"], r["problem"]) for r in bad.collect()} == {
        (date(2024, 1, 7), "no days"),
        (date(2024, 1, 8), "unreadable"),
    }
    rows = flatten.coerce_numeric(flatten.flatten_weather(good), list(flatten.WEATHER_NAMES))
    silver = flatten.select_weather(rows).orderBy("datetime").collect()
    assert [r["datetime"] for r in silver] == [datetime(2024, 1, 5), datetime(2024, 1, 5, 13), datetime(2024, 1, 6, 13)]
    assert silver[0]["temperature"] is None and silver[0]["humidity"] == 80 and silver[1]["cloud_cover"] is None
    # The same rows as the jobs make them: bad text and unreadable documents never stop a run.
    made = silver_rows(docs, "weather").orderBy("datetime").collect()
    assert [r["temperature"] for r in made] == [None, 24.5, 24.5]
    assert bronze.read_bronze(spark, str(tmp_path), "weather", granularity="hourly").count() == 1
    assert bronze.read_bronze(spark, str(tmp_path), "weather", granularity="daily").count() == 3
    assert {r["month"] for r in docs.collect()} == {"01"}


def test_electricity_documents(spark, tmp_path):
    base = tmp_path / "electricity"
    put(base, "total_load", "2024-01-01", "data.json", load_doc([{"datetime": "2024-01-01T18:30:00Z", "value": "5.5"}]))
    empty = load_doc([])
    empty["history"] = [{"datetime": "2024-01-02T00:00:00Z", "value": 1}]
    put(base, "total_load", "2024-01-02", "data.json", empty)
    put(base, "total_load", "2024-01-03", "data.json", load_doc([{"datetime": "2024-01-03T02:00:00+01:00", "value": 2}], "history"))
    put(base, "total_load", "2024-01-04", "data.json", {"zone": "Z"})
    docs = bronze.read_bronze(spark, str(tmp_path), "electricity", "total_load")
    good, bad = quality.check_payload(docs, "electricity")
    assert [r["problem"] for r in bad.collect()] == ["no data or history"]
    rows = flatten.select_electricity(flatten.flatten_electricity(good)).orderBy("datetime").collect()
    # An empty data list wins over a filled history; offsets are converted; UTC moves to the next local day.
    assert [(r["datetime"], r["total_load"]) for r in rows] == [
        (datetime(2024, 1, 2, 1, 30), 5.5),
        (datetime(2024, 1, 3, 8), 2.0),
    ]


def test_hour_documents_compact_to_days(spark, tmp_path):
    for h in (14, 13):
        put(tmp_path, "weather", "2024-01-01", f"{h}_30.json", weather_doc([{"datetime": f"{h}:00:00", "temp": h}], latitude=h))
    docs = bronze.read_bronze(spark, str(tmp_path), "weather", granularity="hourly")
    hours = docs.select(flatten.payload_hour(docs).alias("h"))
    assert sorted(r["h"] for r in hours.collect()) == ["13", "14"]
    day = compaction.compact_weather_docs(docs).collect()
    assert len(day) == 1 and [h["datetime"] for h in day[0]["days"][0]["hours"]] == ["13:00:00", "14:00:00"]
    assert day[0]["latitude"] == 13 and day[0]["days"][0]["datetime"] == "2024-01-01"
    cut = flatten.slice_hour_weather(compaction.compact_weather_docs(docs), "14").first()
    assert [h["temp"] for h in cut["days"][0]["hours"]] == ["14"]


def test_mix_with_open_names(spark, tmp_path):
    base = tmp_path / "electricity"
    records = [
        {"datetime": "2024-01-01T00:00:00Z", "powerConsumptionBreakdown": {"hydro": 1.0, "gas": 2.0}},
        {"datetime": "2024-01-01T01:00:00Z", "powerConsumptionBreakdown": {"solar": 3.0}},
    ]
    put(base, "electricity_mix", "2024-01-01", "data.json", {"zone": "Z", "data": records})
    docs = bronze.read_bronze(spark, str(tmp_path), "electricity", "electricity_mix")
    rows = flatten.parse_mix(docs).orderBy("datetime").collect()
    assert [(r["mix_gas_mw"], r["mix_hydro_mw"], r["mix_solar_mw"]) for r in rows] == [(2.0, 1.0, None), (None, None, 3.0)]


def test_time_expressions(spark):
    df = spark.createDataFrame([("2024-01-01T18:30:00Z", datetime(2024, 1, 31, 23)), ("nonsense", datetime(2024, 2, 3))], "s string, t timestamp_ntz")
    rows = df.select(
        timeparts.to_local(timeparts.parse_utc("s")).alias("local"),
        timeparts.next_hour("t").alias("next"),
        timeparts.is_weekend("t").alias("weekend"),
        timeparts.is_month_closed(F.year("t"), F.month("t"), F.lit("2024-02-01").cast("timestamp_ntz")).alias("closed"),
    ).collect()
    assert rows[0]["local"] == datetime(2024, 1, 2, 1, 30) and rows[1]["local"] is None
    assert rows[0]["next"] == datetime(2024, 2, 1) and (rows[0]["closed"], rows[1]["closed"]) == (True, False)
    assert (rows[0]["weekend"], rows[1]["weekend"]) == (0, 1)


def test_grades(spark):
    rows = [("mape", 5.0), ("mape", 10.0), ("mape", 10.1), ("rmse", 50.0), ("r2", 0.85), ("r2", 0.7), ("r2", 0.69), ("mae", 1.0)]
    df = spark.createDataFrame(rows, "m string, v double")
    got = [r[0] for r in df.select(labels.grade_metric(F.col("m"), F.col("v"))).collect()]
    assert got == ["Good", "OK", "Poor", "Good", "Good", "OK", "Poor", None]


def test_dedup_keeps_first_and_null_keys(spark):
    rows = [("a", 1, 2, "x"), ("a", 1, 1, "y"), (None, 1, 1, "z"), (None, 1, 5, "w"), ("a", 2, 0, None)]
    df = spark.createDataFrame(rows, "k string, t int, o int, v string")
    got = {(r["k"], r["t"]): r["v"] for r in quality.dedup_first(df, ["k"], "t", ["o"]).collect()}
    assert got == {("a", 1): "y", (None, 1): "z", ("a", 2): None}


def test_missing_features_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert quality.check_features(df, ["a"]) is df
    with pytest.raises(ValueError):
        quality.check_features(df, ["c"])
