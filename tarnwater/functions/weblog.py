"""Fields of a web access log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log line format, as the pattern of each quoted or bracketed field.
HOST_PATTERN = r"^(.*) - -.*"
TIMESTAMP_PATTERN = r".* - - \[(.*)\].*"
REQUEST_PATTERN = r'.*"(.*)".*'


def _from_end(line: Column, offset: int) -> Column:
    parts = F.split(line, " ")
    return F.get(parts, F.size(parts) - offset)


def log_fields(line: Column) -> dict[str, Column]:
    """host, timestamp and request text ('' when absent), reply code and byte count (NULL when absent or '-')."""
    return {
        "host": F.regexp_extract(line, HOST_PATTERN, 1),
        "timestamp": F.regexp_extract(line, TIMESTAMP_PATTERN, 1),
        "request": F.regexp_extract(line, REQUEST_PATTERN, 1),
        "reply_code": _from_end(line, 2).try_cast("int"),
        "bytes": _from_end(line, 1).try_cast("int"),
    }


def day_of(timestamp: Column) -> Column:
    """Day of month, the first two characters of the log timestamp."""
    return F.substring(timestamp, 1, 2)


def hour_of(timestamp: Column) -> Column:
    """Hour, characters 13 and 14 of the log timestamp."""
    return F.substring(timestamp, 13, 2)
