"""Input schema contracts."""

from pyspark.sql import types as T

# The raw sensor CSV contract, 12 nullable fields in file order.
RAW_CONTRACT = T.StructType([
    T.StructField("Formatted Date", T.TimestampType(), True),
    T.StructField("Summary", T.StringType(), True),
    T.StructField("Precip Type", T.StringType(), True),
    T.StructField("Temperature (C)", T.DoubleType(), True),
    T.StructField("Apparent Temperature (C)", T.DoubleType(), True),
    T.StructField("Humidity", T.DoubleType(), True),
    T.StructField("Wind Speed (km/h)", T.DoubleType(), True),
    T.StructField("Wind Bearing (degrees)", T.DoubleType(), True),
    T.StructField("Visibility (km)", T.DoubleType(), True),
    T.StructField("Loud Cover", T.DoubleType(), True),
    T.StructField("Pressure (millibars)", T.DoubleType(), True),
    T.StructField("Daily Summary", T.StringType(), True),
])

# The standardised readings frame the operators work on.
STANDARD_CONTRACT = T.StructType([
    T.StructField("reading_id", T.LongType(), True),
    T.StructField("formatted_date", T.TimestampNTZType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("temperatureC", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("wind_speed_kmh", T.DoubleType(), True),
    T.StructField("pressure_millibars", T.DoubleType(), True),
    T.StructField("visibility_km", T.DoubleType(), True),
])
