"""Log-line patterns. One regex pass per pattern yields all five fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the log agent's line pattern (timestamp, thread, level, logger, message).
COMPAT_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \[([^\]]+)\] ([A-Z]+) ([^ ]+) - (.*)$"
)

# Layouts that occur besides it: padded levels, no thread, Python's logging format.
_STAMP = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
STRICT_PATTERNS = (
    (_STAMP + r"\s+\[([^\]]+)\]\s+([A-Z]+)\s+(\S+)\s+- (.*)$", r"$1\n$2\n$3\n$4\n$5"),
    (_STAMP + r"\s+([A-Z]+)\s+(\S+)\s+- (.*)$", r"$1\n\n$2\n$3\n$4"),
    (_STAMP + r",\d{3}\s+-\s+([A-Z]+)\s+-\s(.*)$", r"$1\n\n$2\n\n$3"),
)


def log_fields(line: Column, pattern: str, template: str = r"$1\n$2\n$3\n$4\n$5") -> Column:
    """``array(timestamp, thread, level, logger, message)`` or NULL where the pattern does not match.

    A log line holds no line feed, so rewriting a matching line with a line feed between the groups and
    splitting on it yields every group from one regex pass, where ``regexp_extract`` would run the pattern once
    per group. ``(?d)`` lets only a line feed end a line.
    """
    rewritten = F.regexp_replace(line, F.lit(f"(?d){pattern}"), F.lit(template.replace(r"\n", "\n")))
    parts = F.split(rewritten, "\n", 5)
    return F.when(~line.contains("\n") & (F.size(parts) == 5), parts)
