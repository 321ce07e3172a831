"""Record types shared by readers, codecs, the serving table and search results."""

from __future__ import annotations

from pyspark.sql import types as T

LOCATION = T.StructType([
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
])

PROFILE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("dob", T.StringType()),
    T.StructField("weight", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("nickname", T.StringType()),
    T.StructField("country", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("caption", T.StringType()),
    T.StructField("location", LOCATION),
    T.StructField("gender", T.IntegerType()),
])

# The serving table keeps dates as dates; everything else as on the wire.
SERVING = T.StructType([
    T.StructField(f.name, T.DateType() if f.name == "dob" else f.dataType) for f in PROFILE
])

STRING_FIELDS = [f.name for f in PROFILE if isinstance(f.dataType, T.StringType)]
# Fields tokenised for full-text search.
TEXT_FIELDS = ["email", "nickname", "city", "caption"]
INTEGER_FIELDS = ["weight", "height", "country", "gender"]

CORRUPT = "_corrupt_record"

# Positional layout of the delimited files.
DELIMITED_COLUMNS = [
    "pnum", "lon", "lat", "email", "weight", "height", "nickname",
    "country", "city", "caption", "gender", "dob",
]

# Order in which numeric columns are checked; the first failure names the reject.
NUMERIC_CHECK_ORDER = ["pnum", "lon", "lat", "weight", "height", "country", "gender"]

# Columns of the database extract (it has no email column).
DATABASE_COLUMNS = [
    "pnum", "dob", "weight", "height", "nickname", "country", "city",
    "caption", "longitude", "latitude", "gender",
]

# Fixed value: dates that mean "unknown".
UNKNOWN_DATE = "0000-00-00"
