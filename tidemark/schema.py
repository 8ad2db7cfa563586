"""Declared schemas. Drift is an error, never inferred."""

from pyspark.sql import types as T

VALUE = "decimal(24,6)"

OBSERVATION = T.StructType(
    [
        T.StructField("indicator_code", T.StringType()),
        T.StructField("indicator_name", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("frequency", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("region_level", T.StringType()),
        T.StructField("parent_region_code", T.StringType()),
        T.StructField("observation_date", T.DateType()),
        T.StructField("value", T.DecimalType(24, 6)),
        T.StructField("source_code", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("retrieved_at", T.TimestampNTZType()),
    ]
)

# The columns and codes of the observation contract.
REQUIRED = [name for name in OBSERVATION.names if name != "parent_region_code"]
TEXT_COLUMNS = [
    "indicator_code", "indicator_name", "unit", "frequency", "region_code", "region_name",
    "region_level", "source_code", "source_name", "source_url",
]
NATURAL_KEY = ["indicator_code", "region_code", "source_code", "observation_date"]
SERIES_KEY = ["indicator_code", "region_code"]
FREQUENCIES = ["annual", "quarterly", "monthly", "daily"]
REGION_LEVELS = ["country", "province", "city"]
