"""Record definitions: fields, constraints, defaults and Spark schemas.

One ``Record`` drives the Spark schema, the default values and the validation
rules (``functions/rules.py``), so a constraint is written once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# The vocabularies of the record models.
SOURCE_TYPES = ("kafka", "document_store", "api", "file", "stream")
JOB_STATUSES = ("pending", "processing", "completed", "failed", "retrying")
HEALTH_STATUSES = ("healthy", "unhealthy", "degraded", "unknown")
SERVICES = ("api", "database", "kafka", "spark", "airflow")
METRIC_TYPES = ("counter", "gauge", "histogram", "summary")
SEVERITIES = ("info", "warning", "error", "critical")

# Topics, limits and defaults of the pipeline.
TOPICS = ("data.ingestion", "data.processing", "data.output", "platform.monitoring")
DEFAULT_PAGE_SIZE = 20
MAX_PAGE_SIZE = 100
MAX_WINDOW_HOURS = 168
METRIC_READ_CAP = 1000
MAX_REQUEST_BYTES = 10 * 1024 * 1024
RATE_LIMIT_PER_WINDOW = 100
RATE_WINDOW_SECONDS = 60
BATCH_SIZE = 1000
MAX_RETRIES = 3
RETRY_DELAY_SECONDS = 5
JOB_TIMEOUT_SECONDS = 300
POLL_RECORDS = 500
CHECKPOINT_SECONDS = 60
RETENTION_DAYS = 7
MIN_QUALITY_SCORE = 0.8
DURATION_BOUNDS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)

# Letters, digits, "_" and ":" with at least one letter or digit, any script.
METRIC_NAME_PATTERN = r"^[\p{L}\p{N}_:]*[\p{L}\p{N}][\p{L}\p{N}_:]*$"
ID_PATTERN = r"^[0-9a-fA-F]{24}$"

# Free-form objects are kept as JSON text; their keys are read on demand.
JSON = T.StringType()


@dataclass(frozen=True)
class Field:
    """One record field.  ``low``/``high`` are inclusive bounds.

    A default fills an absent key; ``nullable`` says whether an explicit null
    is accepted next to a default.
    """

    name: str
    type: T.DataType
    required: bool = False
    default: Any = None
    one_of: tuple[str, ...] | None = None
    low: float | None = None
    high: float | None = None
    json_object: bool = False
    non_empty: bool = False
    pattern: str | None = None
    nullable: bool = False


@dataclass(frozen=True)
class Record:
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, True) for f in self.fields])

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]


_STRING = T.StringType()
_LONG = T.LongType()
_INT = T.IntegerType()
_DOUBLE = T.DoubleType()
_TIME = T.TimestampNTZType()

_ID = Field("id", _STRING, pattern=ID_PATTERN)
_STAMPS = (Field("created_at", _TIME), Field("updated_at", _TIME))


def _percent(name: str) -> Field:
    return Field(name, _DOUBLE, required=True, low=0.0, high=100.0)


INGESTION = Record(
    "ingestion",
    (
        _ID,
        Field("source_type", _STRING, required=True, one_of=SOURCE_TYPES),
        Field("source_id", _STRING, required=True),
        Field("topic", _STRING),
        Field("partition", _INT),
        Field("offset", _LONG),
        Field("data", JSON, required=True, json_object=True, non_empty=True),
        Field("metadata", JSON, default="{}", json_object=True, nullable=True),
        Field("size_bytes", _LONG, low=0),
        Field("checksum", _STRING),
        *_STAMPS,
    ),
)

JOB = Record(
    "job",
    (
        _ID,
        Field("job_id", _STRING, required=True),
        Field("job_name", _STRING, required=True),
        Field("input_data_id", _STRING, required=True),
        Field("status", _STRING, default="pending", one_of=JOB_STATUSES),
        Field("spark_application_id", _STRING),
        Field("processing_config", JSON, default="{}", json_object=True),
        Field("progress_percentage", _DOUBLE, default=0.0, low=0.0, high=100.0),
        Field("error_message", _STRING),
        Field("retry_count", _INT, default=0, low=0),
        Field("max_retries", _INT, default=MAX_RETRIES, low=0),
        Field("started_at", _TIME),
        Field("completed_at", _TIME),
        Field("duration_seconds", _DOUBLE, low=0),
        *_STAMPS,
    ),
)

OUTPUT = Record(
    "output",
    (
        _ID,
        Field("job_id", _STRING, required=True),
        Field("output_type", _STRING, required=True),
        Field("destination", _STRING, required=True),
        Field("data", JSON, required=True, json_object=True, non_empty=True),
        Field("schema_version", _STRING, default="1.0"),
        Field("quality_score", _DOUBLE, low=0.0, high=1.0),
        Field("validation_errors", T.ArrayType(_STRING), default=()),
        Field("size_bytes", _LONG),
        Field("compression_ratio", _DOUBLE, low=0.0),
        *_STAMPS,
    ),
)

HEALTH_CHECK = Record(
    "health_check",
    (
        _ID,
        Field("service", _STRING, required=True, one_of=SERVICES),
        Field("status", _STRING, required=True, one_of=HEALTH_STATUSES),
        Field("timestamp", _TIME),
        Field("response_time_ms", _DOUBLE, low=0),
        Field("details", JSON, default="{}", json_object=True, nullable=True),
        Field("error_message", _STRING),
    ),
)

METRIC = Record(
    "metric",
    (
        _ID,
        Field("name", _STRING, required=True, pattern=METRIC_NAME_PATTERN),
        Field("type", _STRING, required=True, one_of=METRIC_TYPES),
        Field("value", _DOUBLE, required=True),
        Field("labels", T.MapType(_STRING, _STRING), default={}),
        Field("help_text", _STRING),
        Field("unit", _STRING),
        *_STAMPS,
    ),
)

SYSTEM_METRICS = Record(
    "system_metrics",
    (
        _ID,
        _percent("cpu_usage_percent"),
        _percent("memory_usage_percent"),
        _percent("disk_usage_percent"),
        Field("network_io_bytes", T.MapType(_STRING, _LONG), default={}),
        Field("disk_io_bytes", T.MapType(_STRING, _LONG), default={}),
        Field("load_average", T.ArrayType(_DOUBLE), default=()),
        *_STAMPS,
    ),
)

APPLICATION_METRICS = Record(
    "application_metrics",
    (
        _ID,
        Field("active_connections", _LONG, required=True, low=0),
        Field("requests_per_second", _DOUBLE, required=True, low=0),
        Field("average_response_time_ms", _DOUBLE, required=True, low=0),
        _percent("error_rate_percent"),
        Field("queue_size", _LONG, required=True, low=0),
        Field("processed_messages", _LONG, required=True, low=0),
        Field("failed_messages", _LONG, required=True, low=0),
        *_STAMPS,
    ),
)

ALERT = Record(
    "alert",
    (
        _ID,
        Field("name", _STRING, required=True),
        Field("severity", _STRING, required=True, one_of=SEVERITIES),
        Field("message", _STRING, required=True),
        Field("service", _STRING, required=True, one_of=SERVICES),
        Field("metric_name", _STRING),
        Field("threshold_value", _DOUBLE),
        Field("current_value", _DOUBLE),
        Field("resolved_at", _TIME),
        Field("acknowledged_at", _TIME),
        Field("acknowledged_by", _STRING),
        *_STAMPS,
    ),
)

RECORDS = {
    r.name: r
    for r in (
        INGESTION, JOB, OUTPUT, HEALTH_CHECK, METRIC, SYSTEM_METRICS, APPLICATION_METRICS, ALERT,
    )
}

# One message of the log, with the column names of Spark's Kafka source.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
