"""Explicit schemas of the feeds and tables. Their column names and types are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def ddl(text: str) -> T.StructType:
    """``"name type, name type"`` as a schema; unlike ``fromDDL`` this needs no session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def pick(schema: T.StructType, names: list[str]) -> T.StructType:
    """Some fields of a schema, in the given order."""
    return T.StructType([schema[n] for n in names])


# Change envelopes. Row images travel as JSON text; times inside are epoch milliseconds.
ENVELOPE = ddl("op string, ts_ms bigint, before string, after string")
ENVELOPE_APPEND_ONLY = ddl("op string, ts_ms bigint, after string")
POSITION = ddl("_partition_id int, _partition_offset bigint")

ORDER_PAYLOAD = ddl(
    "id int, customer_name string, pickup_address string, pickup_latitude double, "
    "pickup_longitude double, collected_at bigint, delivery_address string, dest_latitude double, "
    "dest_longitude double, weight_kg int, status string, truck_id string, created_at bigint, "
    "dispatched_at bigint, delivered_at bigint"
)
TRUCK_PAYLOAD = ddl("id string, model string, capacity_kg int, status string")
TELEMETRY_PAYLOAD = ddl(
    "id bigint, truck_id string, latitude double, longitude double, speed_kmh double, "
    "fuel_level string, timestamp bigint"
)

METRIC_STORE = ddl(
    "id string, full_table_name string, column_name string, metric_name string, metric_type string, "
    "metric_value double, source_value string, bucket_start timestamp, bucket_end timestamp, "
    "bucket_duration_hours int, updated_at timestamp, dimension string, dimension_value string, "
    "metric_properties string, created_at timestamp"
)
SCHEMA_SNAPSHOT = ddl(
    "column_state_id string, full_column_name string, full_table_name string, column_name string, "
    "data_type string, is_new boolean, detected_at timestamp"
)
RUN_RESULTS = ddl(
    "model_execution_id string, unique_id string, invocation_id string, generated_at timestamp, "
    "name string, message string, status string, resource_type string, execution_time double, "
    "execute_started_at timestamp, execute_completed_at timestamp, rows_affected bigint, "
    "full_refresh boolean, materialization string"
)
INVOCATIONS = ddl(
    "invocation_id string, job_id string, job_name string, job_run_id string, "
    "run_started_at timestamp, run_completed_at timestamp, generated_at timestamp, command string, "
    "full_refresh boolean"
)
SOURCE_FRESHNESS = ddl(
    "source_freshness_execution_id string, unique_id string, max_loaded_at timestamp, "
    "snapshotted_at timestamp, generated_at timestamp, max_loaded_at_time_ago_in_s double, "
    "status string, error string, warn_after string, error_after string, filter string"
)
TEST_RESULTS = ddl(
    "id string, data_issue_id string, test_execution_id string, test_unique_id string, "
    "model_unique_id string, invocation_id string, detected_at timestamp, database_name string, "
    "schema_name string, table_name string, column_name string, test_type string, "
    "test_sub_type string, test_results_description string, owners string, tags string, "
    "test_results_query string, other string, test_name string, test_params string, "
    "severity string, status string, failures bigint, test_short_name string, "
    "test_alias string, result_rows string"
)
TEST_RESULT_ROWS = ddl(
    "test_result_id string, result_row string, detected_at timestamp, "
    "created_at timestamp"
)
