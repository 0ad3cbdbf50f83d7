"""Predicates and lookups on trace spans (`tags` is an array of (key, type, value))."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def span_has_error(tags: Column) -> Column:
    """Tagged with the boolean error, or carrying an error status code; the text "true" is no error."""
    return F.coalesce(F.exists(tags, lambda t: (
        (t["key"] == "error") & (t["type"] == "bool") & (t["value"] == "true")
        | (t["key"] == "otel.status_code") & (t["value"] == "ERROR"))), F.lit(False))


def span_is_dlq(operation: Column, tags: Column) -> Column:
    """Sent to a dead-letter topic: by operation name (any case) or by destination."""
    by_tag = F.exists(tags, lambda t: (
        (t["key"] == "messaging.destination.name") & F.contains(t["value"], F.lit(".dlq"))))
    return F.contains(F.lower(operation), F.lit("dlq")) | F.coalesce(by_tag, F.lit(False))


def tag_value(tags: Column, *keys: str) -> Column:
    """Value of the first tag, in list order, whose key is one of `keys`."""
    return F.try_element_at(F.filter(tags, lambda t: t["key"].isin(list(keys))), F.lit(1))["value"]


def service_of(processes: Column, process_id: Column) -> Column:
    return F.coalesce(F.try_element_at(processes, process_id)["serviceName"], F.lit("unknown"))
