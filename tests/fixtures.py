"""In-memory fixtures (FIXTURES.md F1-F4, F7)."""

import datetime as dt

from pyspark.sql import types as T

F1_HEADER = ("Formatted Date,Summary,Precip Type,Temperature (C),Apparent Temperature (C),Humidity,"
             "Wind Speed (km/h),Wind Bearing (degrees),Visibility (km),Loud Cover,"
             "Pressure (millibars),Daily Summary")
F1_ROWS = [
    "2031-07-15 00:30:00.000 +0200,Dust,none,31.25,33.5,0.125,7.75,12.0,4.5,0.0,987.5,"
    "Dust until dawn.",
    "2031-07-15 01:45:00.000 +0200,Calm,none,30.75,32.0,0.25,0.5,300.0,9.25,0.0,988.25,"
    "Calm after the dust.",
]


def write_f1(path, copies=1):
    with open(path, "w") as fh:
        fh.write(F1_HEADER + "\n")
        for _ in range(copies):
            fh.write("\n".join(F1_ROWS) + "\n")


READING_SCHEMA = T.StructType([
    T.StructField("reading_id", T.LongType()),
    T.StructField("formatted_date", T.TimestampNTZType()),
    T.StructField("summary", T.StringType()),
    T.StructField("temperatureC", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("wind_speed_kmh", T.DoubleType()),
    T.StructField("pressure_millibars", T.DoubleType()),
    T.StructField("visibility_km", T.DoubleType()),
])


def reading(i, ts, temp=10.0, hum=0.5, wind=10.0, pressure=1000.0, vis=10.0, summary="x"):
    return (i, ts, summary, temp, hum, wind, pressure, vis)


DAILY_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("avg_tempC", T.DoubleType()),
])


def daily_rows(start: dt.date, values):
    return [(start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
