"""Record layouts and typed index mappings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The columns of the trip files and the names later files use for them.
TRIP_COLUMNS = T.StructType(
    [
        T.StructField("vendor_id", T.StringType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("rate_code", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("surcharge", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)
TRIP_ALIASES = {
    "vendor_id": ("VendorID",),
    "pickup_datetime": ("tpep_pickup_datetime",),
    "dropoff_datetime": ("tpep_dropoff_datetime",),
    "rate_code": ("RatecodeID",),
    "surcharge": ("extra",),
}

# The message fields that the jobs read.
TRIP_MESSAGE = T.StructType(
    [
        T.StructField("trip_id", T.LongType()),
        T.StructField("VendorID", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# The text-only row of the republishing job, in its column order.
REPUBLISHED_FIELDS = [
    "timestamp",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]

# Field order of an enriched message.
ENRICHED_FIELDS = ["cluster", "lat", "lon", "time_stamp"]

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
    ]
)

POINT = T.StructType(
    [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
)

# The two date formats of the mappings.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"
SPACE_MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"


@dataclass(frozen=True)
class Field:
    """One mapped field: ``type`` is a Spark DDL type, ``geo_point`` or ``date``."""

    name: str
    type: str
    format: str | None = None


# The index mappings. The misspelt date field of one mapping and the
# doubled count of another are corrected here, so every index reads back what was written.
EVENT_MAPPING = [
    Field("cluster", "int"),
    Field("location", "geo_point"),
    Field("time_stamp", "date", ISO_MILLIS),
]
CLUSTER_MAPPING = [
    Field("cluster", "int"),
    Field("ratio", "double"),
    Field("u_count", "bigint"),
    Field("c_count", "bigint"),
    Field("location", "geo_point"),
]
TRIP_MAPPING = [
    Field("pick_location", "geo_point"),
    Field("drop_location", "geo_point"),
    Field("time_stamp", "date", SPACE_MILLIS),
    Field("trip_distance", "double"),
]
PREDICTION_MAPPING = [
    Field("pick_location", "geo_point"),
    Field("drop_location", "geo_point"),
    Field("prediction_mins", "float"),
    Field("pick_up_hour", "int"),
]

MOVIE = T.StructType(
    [
        T.StructField("_id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("release_year", T.IntegerType()),
        T.StructField("genre", T.ArrayType(T.StringType())),
        T.StructField("actors", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
    ]
)
PERSON = T.StructType(
    [
        T.StructField("email", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField(
            "info",
            T.StructType(
                [
                    T.StructField("bio", T.StringType()),
                    T.StructField("age", T.IntegerType()),
                    T.StructField("interests", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("join_date", T.DateType()),
    ]
)
PERSON_DATE_FORMAT = "yyyy/MM/dd"


def mapping_type(mapping: list[Field]) -> T.StructType:
    """The Spark schema that a mapping declares."""
    special = {"geo_point": POINT, "date": T.TimestampNTZType()}
    return T.StructType(
        [
            T.StructField(f.name, special.get(f.type) or T._parse_datatype_string(f.type))
            for f in mapping
        ]
    )
