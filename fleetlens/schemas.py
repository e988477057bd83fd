"""Table schemas, category lists and column names."""

from __future__ import annotations

from pyspark.sql import types as T

# Names the input tables use.
MEASURES = ("volt", "rotate", "pressure", "vibration")
ERROR_CODES = ("error1", "error2", "error3", "error4", "error5")
COMPONENTS = ("comp1", "comp2", "comp3", "comp4")
MODELS = ("model1", "model2", "model3", "model4")
NO_FAILURE = "none"
LABELS = (NO_FAILURE, *COMPONENTS)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

KEYS = ("machineID", "datetime")
ERROR_COUNTS = tuple(f"{code}count" for code in ERROR_CODES)
MEAN_BIN = tuple(f"{m}mean_3h" for m in MEASURES)
SD_BIN = tuple(f"{m}sd_3h" for m in MEASURES)
MEAN_ROLL = tuple(f"{m}mean_24h" for m in MEASURES)
SD_ROLL = tuple(f"{m}sd_24h" for m in MEASURES)
TELEMETRY_FEATURES = (*KEYS, *MEAN_BIN, *SD_BIN, *MEAN_ROLL, *SD_ROLL)
ERROR_FEATURES = (*KEYS, *ERROR_COUNTS)
MAINTENANCE_FEATURES = ("datetime", "machineID", *COMPONENTS)
FINAL_FEATURES = (*TELEMETRY_FEATURES, *ERROR_COUNTS, *COMPONENTS, "model", "age")
LABELED_FEATURES = (*FINAL_FEATURES, "failure")
MODEL_DUMMIES = tuple(f"model_{m}" for m in MODELS)
MODEL_MATRIX = (
    *MEAN_BIN, *SD_BIN, *MEAN_ROLL, *SD_ROLL, *ERROR_COUNTS, *COMPONENTS, "age", *MODEL_DUMMIES,
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TELEMETRY = _struct(
    datetime=T.TimestampType(), machineID=T.LongType(), **{m: T.DoubleType() for m in MEASURES}
)
ERRORS = _struct(datetime=T.TimestampType(), machineID=T.LongType(), errorID=T.StringType())
MAINT = _struct(datetime=T.TimestampType(), machineID=T.LongType(), comp=T.StringType())
FAILURES = _struct(datetime=T.TimestampType(), machineID=T.LongType(), failure=T.StringType())
MACHINES = _struct(machineID=T.LongType(), model=T.StringType(), age=T.LongType())
HEADERLESS_MATRIX = _struct(**{f"c{i}": T.DoubleType() for i in range(len(MODEL_MATRIX))})

PAYLOAD = T.ArrayType(T.ArrayType(T.DoubleType()))
_SIDE = _struct(observedContentType=T.StringType(), mode=T.StringType(),
                data=T.StringType(), encoding=T.StringType())
CAPTURE = _struct(
    captureData=_struct(endpointInput=_SIDE, endpointOutput=_SIDE),
    eventMetadata=_struct(eventId=T.StringType(), inferenceId=T.StringType(),
                          inferenceTime=T.StringType()),
    eventVersion=T.StringType(),
)
