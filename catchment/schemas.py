"""Declared schemas: nothing the library reads is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "double": T.DoubleType(),
        "boolean": T.BooleanType(),
        "date": T.DateType(),
        "timestamp": T.TimestampNTZType(),
    }
    fields = (part.split() for part in ddl.split(","))
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))

QUERY_LOG = _schema(
    "query_name string, last_run timestamp, frequency string, status string, "
    "execution_time_seconds double, error_message string, user_id string"
)
PERFORMANCE_LOG = _schema("query_name string, execution_time_seconds double, last_run timestamp, user_id string")
SYNC_STATE = _schema("table_name string, last_sync_ts bigint")

ACH = _schema(
    "routing_number string, bank_name string, address_full string, phone string, office_type string, "
    "servicing_fed_main_office_rtn string, servicing_fed_main_office_addr string, status string, "
    "change_date date, scraped_at timestamp, source_url string"
)
WIRE = _schema(
    "routing_number string, bank_name string, telegraphic_name string, location string, "
    "funds_transfer_status string, book_entry_securities_transfer_status string, revision_date date, "
    "scraped_at timestamp, source_url string"
)
FAILURES = _schema(
    "routing_number string, url string, http_status int, level string, error_type string, "
    "error_message string, when_utc timestamp"
)
PAGES = _schema("routing_number string, url string, status int, html string")

MATRIX = T.StructType(
    [
        T.StructField(
            side,
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("location", T.ArrayType(T.DoubleType())),
                        T.StructField("distance", T.DoubleType()),
                    ]
                )
            ),
        )
        for side in ("destinations", "sources")
    ]
    + [T.StructField("durations", T.ArrayType(T.ArrayType(T.DoubleType())))]
)
