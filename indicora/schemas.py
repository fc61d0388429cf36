"""Declared shapes of the tables that jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LONG_TABLE = _struct(
    country=_S, year=_I, indicator=_S, sub_indicator=_S, sex=_S, unit=_S, value=_D
)
METADATA = _struct(
    indicator=_S,
    indicator_label=_S,
    description=_S,
    source_url=_S,
    raw_data=_S,
    issue_url=_S,
    is_cleansed=_S,
    should_combine=_S,
    remarks=_S,
)
SENSOR_EVENT = _struct(
    event_id=_S,
    station_id=_S,
    country=_S,
    timestamp=_S,
    temperature_c=_D,
    humidity_pct=_D,
    rainfall_mm=_D,
    retry_count=_I,
)
DEAD_LETTER = _struct(
    original_payload=_S,
    error_type=_S,
    error_message=_S,
    retry_count=_I,
    failed_at=_TS,
    source_topic=_S,
    resolved_at=_TS,
    resolution_notes=_S,
)
OPS_EVENT = T.StructType(
    [
        T.StructField("event_id", _L),
        T.StructField("event_type", _S),
        T.StructField("source", _S),
        T.StructField("status", _S),
        T.StructField("message", _S),
        T.StructField("country", _S),
        T.StructField("metric", _S),
        T.StructField("value", _D),
        T.StructField("threshold", _D),
        T.StructField("observed_at", _TS),
        T.StructField("metadata", T.MapType(_S, _S)),
    ]
)
RUN_LEDGER = _struct(
    pipeline_run_id=_S,
    pipeline_name=_S,
    source_name=_S,
    file_name=_S,
    record_count_in=_L,
    record_count_valid=_L,
    record_count_rejected=_L,
    record_count_dlq=_L,
    started_at=_TS,
    completed_at=_TS,
    status=_S,
    checksum=_S,
)
FILE_LEDGER = _struct(file_name=_S, checksum=_S, ingestion_timestamp=_TS, pipeline_run_id=_S)
METRIC_LEDGER = _struct(
    pipeline_name=_S, metric_name=_S, metric_value=_D, metric_unit=_S, recorded_at=_TS
)

_NTZ = T.TimestampNTZType()

# The given tables. Reading with a declared shape skips the footer-reading job of every scan.
GIVEN_TABLES = {
    "nation": _struct(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _struct(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "part": _struct(
        p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D
    ),
    "orders": _struct(
        o_orderkey=_L,
        o_custkey=_L,
        o_orderstatus=_S,
        o_totalprice=_D,
        o_orderdate=_NTZ,
        o_orderpriority=_S,
    ),
    "lineitem": _struct(
        l_orderkey=_L,
        l_partkey=_L,
        l_suppkey=_L,
        l_linenumber=_I,
        l_quantity=_D,
        l_extendedprice=_D,
        l_discount=_D,
        l_tax=_D,
        l_returnflag=_S,
        l_linestatus=_S,
        l_shipdate=_NTZ,
    ),
    "events": _struct(event_id=_L, ts=_NTZ, user_id=_L, event_type=_S, value=_D, props=_S),
}
