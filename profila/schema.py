"""Explicit schemas of the inputs and of the stage artefacts.

The reference reads CSV with inferred types; here every input has a
declared ``StructType`` so that a scan never samples the data.
"""

from pyspark.sql import types as T

# Device table (train.csv / test.csv): one row per device, labels NULL on
# unlabelled rows.  ``is_train`` replaces the reference's row position.
DEVICE_CSV = T.StructType([
    T.StructField("device_id", T.LongType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("phone_brand", T.IntegerType()),
    T.StructField("device_model", T.IntegerType()),
])

DEVICE_TEST_CSV = T.StructType([
    T.StructField("device_id", T.LongType()),
    T.StructField("phone_brand", T.IntegerType()),
    T.StructField("device_model", T.IntegerType()),
])

# App-event log (train_app_events.csv / test_app_events.csv).
APP_EVENTS_CSV = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("device_id", T.LongType()),
    T.StructField("app_id", T.LongType()),
    T.StructField("is_installed", T.IntegerType()),
    T.StructField("is_active", T.IntegerType()),
    T.StructField("tag_list", T.StringType()),
    T.StructField("date", T.IntegerType()),
])

DEVICE_COLUMNS = ["device_id", "phone_brand", "device_model", "gender", "age", "is_train"]
EVENT_COLUMNS = ["event_id", "device_id", "app_id", "is_installed", "is_active", "date", "tag_list"]
