"""Declared schemas of the lake layers. Absent optional fields read as NULL, so layouts stay stable."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


TEXT, REAL, LONG, WHOLE = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
LOCAL_TIME = T.TimestampNTZType()

# Measures arrive as numbers or text; they are read as text and coerced later.
WEATHER_HOUR = _struct(
    datetime=TEXT, temp=TEXT, humidity=TEXT, precip=TEXT, windspeed=TEXT, cloudcover=TEXT
)
WEATHER_DAY = _struct(datetime=TEXT, temp=REAL, humidity=REAL, hours=T.ArrayType(WEATHER_HOUR))
WEATHER_DOC = _struct(
    queryCost=WHOLE,
    latitude=REAL,
    longitude=REAL,
    resolvedAddress=TEXT,
    address=TEXT,
    timezone=TEXT,
    days=T.ArrayType(WEATHER_DAY),
)

PROVENANCE = _struct(signal=TEXT, query_date=TEXT, zone=TEXT, hour=TEXT)

SIGNAL_RECORDS = {
    "total_load": _struct(datetime=TEXT, value=TEXT),
    "price_day_ahead": _struct(datetime=TEXT, value=TEXT),
    "carbon_intensity": _struct(
        datetime=TEXT, value=TEXT, carbonIntensity=REAL, fossilFreePercentage=REAL
    ),
    "electricity_mix": _struct(
        datetime=TEXT, powerConsumptionBreakdown=T.MapType(TEXT, REAL)
    ),
    "electricity_flows": _struct(datetime=TEXT, exchange=T.MapType(TEXT, REAL)),
}
SIGNALS = tuple(SIGNAL_RECORDS)

CORRUPT = "_corrupt_record"


def electricity_doc(signal: str) -> T.StructType:
    record = SIGNAL_RECORDS[signal]
    return _struct(
        zone=TEXT,
        data=T.ArrayType(record),
        history=T.ArrayType(record),
        _metadata=PROVENANCE,
    )


SILVER_WEATHER = _struct(
    datetime=LOCAL_TIME,
    temperature=T.FloatType(),
    humidity=T.FloatType(),
    precipitation=T.FloatType(),
    wind_speed=T.FloatType(),
    cloud_cover=T.FloatType(),
)
SILVER_ELECTRICITY = _struct(datetime=LOCAL_TIME, total_load=T.FloatType())

CANONICAL_COLUMNS = (
    "datetime",
    "electricity_demand",
    "temperature",
    "humidity",
    "wind_speed",
    "precipitation",
)
CANONICAL_MEASURES = CANONICAL_COLUMNS[1:]
CANONICAL_REQUIRED = CANONICAL_COLUMNS[:3]

PREDICTION = _struct(
    prediction_for=TEXT,
    predicted_value=REAL,
    confidence_lower=REAL,
    confidence_upper=REAL,
    model_type=TEXT,
    model_version=TEXT,
    generated_at=TEXT,
    based_on_data_until=TEXT,
    feature_count=WHOLE,
    historical_hours_used=WHOLE,
)
# One reader for both layouts: a single record, or parallel arrays.
PREDICTION_ANY = T.StructType(
    PREDICTION.fields
    + _struct(
        predictions=T.ArrayType(REAL),
        timestamps=T.ArrayType(TEXT),
        confidence_intervals=_struct(lower=T.ArrayType(REAL), upper=T.ArrayType(REAL)),
        feature_importance=T.MapType(TEXT, REAL),
    ).fields
)

TRAINING_RECORD = _struct(
    started_at=TEXT,
    completed_at=TEXT,
    duration_seconds=REAL,
    total_samples=LONG,
    train_samples=LONG,
    val_samples=LONG,
    test_samples=LONG,
    features_count=WHOLE,
    feature_names=T.ArrayType(TEXT),
    mode=TEXT,
    hyperparameters=T.MapType(TEXT, TEXT),
)
REGISTRY = _struct(
    model_type=TEXT,
    version=TEXT,
    training=TRAINING_RECORD,
    metrics=T.MapType(TEXT, REAL),
    tags=T.MapType(TEXT, TEXT),
    notes=TEXT,
)
