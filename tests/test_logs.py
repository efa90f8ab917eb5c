from datetime import datetime

from feedflow.operators.logs import drop_debug, log_messages, parse_lines
from feedflow.operators.rollup import log_rollup
from feedflow.sources.files import log_files
from feedflow.sources.literal import literal

# line -> (compat fields or None, strict fields or None): timestamp, thread, level, logger, message
STAMP = "2025-01-20 10:11:12"
CASES = {
    f"{STAMP} [main] ERROR SparkContext - boom DEBUG x": ((STAMP, "main", "ERROR", "SparkContext", "boom DEBUG x"),) * 2,
    f"{STAMP} [t 1] DEBUG a.B - m": ((STAMP, "t 1", "DEBUG", "a.B", "m"),) * 2,
    f"{STAMP} [main] INFO  SparkContext - hi": (None, (STAMP, "main", "INFO", "SparkContext", "hi")),
    f"{STAMP} INFO  Foo:12 - cfg - more": (None, (STAMP, None, "INFO", "Foo:12", "cfg - more")),
    f"{STAMP},123 - INFO - py - more": (None, (STAMP, None, "INFO", None, "py - more")),
    f"{STAMP} [main] ERROR a.B - ": ((STAMP, "main", "ERROR", "a.B", ""),) * 2,
    "java.lang.RuntimeException: DEBUG": (None, None),
    "": (None, None),
}


def _rows(spark, mode):
    lines = literal(spark, [(line,) for line in CASES], "value string")
    parsed = parse_lines(lines, mode).collect()
    return dict(zip(CASES, parsed))


def test_compat(spark):
    for line, row in _rows(spark, "compat").items():
        expected = CASES[line][0]
        assert row.parsed is (expected is not None), line
        assert row[:5] == (expected or (None,) * 5), line
        assert row.log == (None if expected else line)


def test_strict(spark):
    for line, row in _rows(spark, "strict").items():
        expected = CASES[line][1]
        assert row.parsed is (expected is not None), line
        assert row[:5] == (expected or (None, None, None, None, line)), line
        assert row.event_time == (datetime(2025, 1, 20, 10, 11, 12) if expected else None)


def test_multi_line_text_is_not_a_log_line(spark):
    lines = literal(spark, [("a\nb\nc\nd\ne",), (f"{STAMP} [m] INFO a.B - x\ny",)], "value string")
    assert parse_lines(lines, "strict").filter("parsed").isEmpty()


def test_debug_filter_looks_at_the_message(spark):
    lines = literal(spark, [(line,) for line in CASES], "value string")
    assert drop_debug(parse_lines(lines, "compat")).count() == len(CASES) - 1
    assert drop_debug(parse_lines(lines, "strict")).count() == len(CASES) - 2


def test_log_files_and_messages(spark, tmp_path):
    (tmp_path / "app.log").write_text(f"{STAMP} [main] ERROR a.B - boom\r\nsecond\n")
    lines = log_files(spark, str(tmp_path), streaming=False)
    values = [row.value for row in log_messages(parse_lines(lines, "strict")).collect()]
    assert values == [
        '{"timestamp":"2025-01-20 10:11:12","thread":"main","level":"ERROR","logger":"a.B","message":"boom\\r"}',
        '{"message":"second","log":"second"}',
    ]


def test_log_rollup(spark):
    lines = literal(spark, [(line,) for line in CASES], "value string")
    found = {(row.bucket, row.level): row.n for row in log_rollup(parse_lines(lines)).collect()}
    hour = datetime(2025, 1, 20, 10)
    assert found == {(hour, "ERROR"): 2, (hour, "DEBUG"): 1, (hour, "INFO"): 3}
