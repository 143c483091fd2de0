"""Time columns.

Log times carry no zone, so everything stays in ``timestamp_ntz``: the answers
do not depend on the session zone, the parser policy or ANSI mode.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted time formats and the date-key format.
TIMESTAMP_PATTERN = r"^\s*(\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}:\d{1,2})"
DATE_KEY_PATTERN = r"^\s*(\d+-\d+-\d+)(?:[ T]|\s*$)"


def parse_timestamp(text: Column) -> Column:
    """Time of a log line, or NULL where the text holds no valid one.

    Date and time are joined by ``T`` or a blank; fields may lack padding, and
    whatever follows the seconds is ignored.
    """
    return F.regexp_extract(text, TIMESTAMP_PATTERN, 1).try_cast("timestamp_ntz")


def hour_bucket(ts: Column) -> Column:
    """``yyyy-MM-dd-HH`` text of a ``timestamp_ntz``.

    ``date_format`` would go through the session zone and shift hours that the
    zone skips.
    """
    return F.translate(F.substring(ts.cast("string"), 1, 13), " ", "-")


def date_key(text: Column) -> Column:
    """``y-m-d`` digits as written, without a calendar check; '' if there are none."""
    return F.regexp_extract(text, DATE_KEY_PATTERN, 1)
