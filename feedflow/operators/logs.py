"""Log lines to log records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.functions.log_text import COMPAT_PATTERN, STRICT_PATTERNS, log_fields
from feedflow.functions.once import compute_once
from feedflow.operators.decode import STRICT, check_mode
from feedflow.operators.encode import to_message
from feedflow.schemas import LOG_FIELDS


def parse_lines(lines: DataFrame, mode: str = STRICT) -> DataFrame:
    """``value`` to timestamp, thread, level, logger, message, ``event_time``, ``parsed``.

    Lines no pattern matches are kept. Compat leaves their text in ``log`` alone, as the agent does; strict puts
    it into ``message``.
    """
    strict = check_mode(mode)
    line = F.col("value")
    patterns = STRICT_PATTERNS if strict else ((COMPAT_PATTERN, r"$1\n$2\n$3\n$4\n$5"),)
    found = F.coalesce(*[log_fields(line, pattern, template) for pattern, template in patterns])
    rows = compute_once(lines, _fields=found)
    columns = [F.nullif(F.col("_fields")[i], F.lit("")).alias(name) for i, name in enumerate(LOG_FIELDS[:-1])]
    message = F.col("_fields")[len(LOG_FIELDS) - 1]
    if strict:
        message = F.coalesce(message, line)
    return rows.select(
        *columns,
        message.alias("message"),
        F.try_to_timestamp(F.col("_fields")[0], F.lit("yyyy-MM-dd HH:mm:ss")).alias("event_time"),
        F.col("_fields").isNotNull().alias("parsed"),
        F.when(F.col("_fields").isNull(), line).alias("log"),
    )


def drop_debug(records: DataFrame) -> DataFrame:
    """Leave out records whose message text says DEBUG. The level is not looked at."""
    return records.filter(~F.coalesce(F.col("message").contains("DEBUG"), F.lit(False)))


def log_messages(records: DataFrame) -> DataFrame:
    """Log records as JSON messages."""
    return to_message(records.select(*LOG_FIELDS, "log"))
