"""Fixed record schemas. Evolution is add-with-default only, so every reader declares one of these."""

from pyspark.sql import types as T

S, L, I, D, FL, B, TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
    T.FloatType(), T.BooleanType(), T.TimestampType(),
)


def _struct(*fields: tuple) -> T.StructType:
    """Fields as (name, type) for required or (name, type, True) for nullable ones."""
    return T.StructType([T.StructField(f[0], f[1], len(f) > 2 and f[2]) for f in fields])


# The enumerations of the record formats.
ACTION_TYPES = ["VIEW", "CLICK", "SEARCH", "PURCHASE", "ADD_TO_CART", "WISHLIST"]
INVENTORY_EVENT_TYPES = ["PRICE_CHANGE", "STOCK_CHANGE", "PRODUCT_UPDATE"]
NOTIFICATION_TYPES = ["PRICE_DROP", "BACK_IN_STOCK", "RECOMMENDATION"]
CHANNELS = ["PUSH", "SMS", "EMAIL", "IN_APP"]
PRIORITIES = ["LOW", "NORMAL", "HIGH"]
DELIVERY_STATUSES = ["SENT", "FAILED", "RATE_LIMITED", "USER_OPTED_OUT"]
ANOMALY_TYPES = ["SLOW_TRACE", "SLOW_SPAN", "ERROR_SPAN", "DLQ_ROUTED", "HIGH_RETRY"]
SEVERITIES = ["CRITICAL", "ERROR", "WARNING"]

USER_ACTION = _struct(
    ("trace_id", S, True), ("user_id", S), ("product_id", S), ("category", S), ("action_type", S),
    ("metadata", T.MapType(S, S), True), ("ts", TS),
)

INVENTORY_EVENT = _struct(
    ("event_id", S), ("product_id", S), ("event_type", S),
    ("previous_price", FL, True), ("current_price", FL, True),
    ("previous_stock", I, True), ("current_stock", I, True),
    ("ts", TS), ("trace_id", S, True),
)

NOTIFICATION = _struct(
    ("notification_id", S), ("user_id", S), ("product_id", S), ("notification_type", S),
    ("title", S), ("body", S), ("data", T.MapType(S, S)), ("channels", T.ArrayType(S)),
    ("priority", S), ("ts", TS), ("trace_id", S, True),
)

PRODUCT = _struct(
    ("product_id", S), ("product_name", S), ("category", S), ("price", FL),
    ("sub_category", S, True), ("stock", I, True), ("brand", S, True), ("description", S, True),
    ("tags", T.ArrayType(S), True), ("product_vector", T.ArrayType(FL), True),
    ("created_at", L, True), ("updated_at", L, True),
)

PREFERENCE = _struct(
    ("user_id", S), ("preference_vector", T.ArrayType(FL)), ("action_count", I),
    ("updated_at", L), ("version", L),
)

HISTORY = T.StructType(
    NOTIFICATION.fields + [T.StructField("status", S, False), T.StructField("sent_at", TS, False)]
)

RECOMMENDATION = _struct(
    ("user_id", S),
    ("recommendations", T.ArrayType(_struct(
        ("product_id", S), ("product_name", S), ("category", S), ("price", FL), ("score", D)))),
    ("strategy", S), ("latency_ms", L),
)

# Tag values may be of any JSON type, so they travel as text next to their type name.
TAG = _struct(("key", S, True), ("type", S, True), ("value", S, True))
SPAN = _struct(
    ("traceID", S, True), ("spanID", S, True), ("operationName", S, True),
    ("references", T.ArrayType(_struct(("refType", S, True), ("traceID", S, True), ("spanID", S, True))), True),
    ("startTime", L, True), ("duration", L, True),
    ("tags", T.ArrayType(TAG), True),
    ("logs", T.ArrayType(_struct(("timestamp", L, True), ("fields", T.ArrayType(TAG), True))), True),
    ("processID", S, True),
)
TRACE = _struct(
    ("traceID", S, True), ("spans", T.ArrayType(SPAN), True),
    ("processes", T.MapType(S, _struct(("serviceName", S, True), ("tags", T.ArrayType(TAG), True))), True),
)

ANOMALY = _struct(
    ("trace_id", S), ("type", S), ("severity", S), ("service_name", S), ("operation_name", S),
    ("duration_ms", L), ("threshold_ms", L, True), ("error_message", S, True), ("span_count", I, True),
    ("metadata", T.MapType(S, S), True), ("note", S, True), ("is_bookmark", B),
    ("detected_at", TS), ("created_at", TS),
)

RUN_METRICS = _struct(
    ("kafkaConsumerLag", D, True), ("kafkaProcessedRate", D, True), ("esBulkSuccessRate", D, True),
    ("esBulkFailedTotal", D, True), ("preferenceUpdateRate", D, True),
    ("recApiP50Ms", D, True), ("recApiP95Ms", D, True), ("recApiP99Ms", D, True),
    ("notificationTriggered", D, True), ("notificationRateLimited", D, True),
    ("jvmHeapUsedBytes", D, True), ("redisMemoryUsedBytes", D, True),
    ("totalRequestsSent", L, True), ("totalErrors", L, True), ("avgLatencyMs", D, True),
)
RUN_RESULT = _struct(
    ("id", S, True), ("scenario", S, True), ("config", T.MapType(S, S), True),
    ("startedAt", S, True), ("completedAt", S, True), ("durationSec", L, True),
    ("finalMetrics", RUN_METRICS, True),
    ("metricsTimeSeries", T.ArrayType(_struct(
        ("timestamp", S, True), ("elapsedSec", L, True), ("metrics", RUN_METRICS, True))), True),
    ("note", S, True),
)

LOG_LINE = _struct(
    ("level", S, True), ("message", S, True), ("logger_name", S, True), ("thread_name", S, True),
    ("traceId", S, True), ("spanId", S, True), ("@timestamp", S, True), ("application", S, True),
    ("stack_trace", S, True),
)
