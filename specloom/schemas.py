"""Explicit table schemas. Nothing is inferred when a snapshot is read."""

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampType,
)

_TYPES = {"string": StringType(), "timestamp": TimestampType(), "double": DoubleType(), "boolean": BooleanType(),
          "int": IntegerType(), "bigint": LongType()}


def _s(columns: str) -> StructType:
    """Schema from 'name type, ...'; needs no running session."""
    out = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        out.add(name, _TYPES[kind])
    return out


PRODUCT_KEY = ("brand", "series_l1", "series_l2", "product_model")

HIERARCHY = _s("run_id string, brand string, series_l1 string, series_l2 string, series_source string, "
               "series_status string, discovered_at timestamp")
CATALOG = _s("run_id string, brand string, series_l1 string, series_l2 string, product_model string, "
             "product_name string, product_url string, locale string, first_seen_at timestamp, "
             "last_seen_at timestamp, catalog_status string")
SPECS = _s("run_id string, brand string, series_l1 string, series_l2 string, product_model string, "
           "field_code string, field_name string, raw_value string, normalized_value string, unit string, "
           "value_type string, source_url string, extract_confidence double, is_manual_override boolean, "
           "updated_at timestamp")
MANUAL = _s("input_id string, brand string, series_l1 string, series_l2 string, product_model string, "
            "field_code string, manual_value string, operator string, reason string, created_at timestamp")
ISSUES = _s("run_id string, brand string, series_l1 string, series_l2 string, product_model string, "
            "issue_type string, field_code string, issue_detail string, severity string, status string, "
            "owner string, created_at timestamp")
FEED = ("products array<struct<productModel:string,series:string,subseries:string,detailPath:string,"
        "title:string>>")

TABLES = {"catalog": CATALOG, "specs": SPECS, "hierarchy": HIERARCHY, "issues": ISSUES}
