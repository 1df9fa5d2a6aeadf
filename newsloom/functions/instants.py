"""Feed timestamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two timestamp formats of the feeds and the start of an empty history.
SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
FRACTION_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"
# Any ISO-8601 instant: one to nine digits of a second, the zone as Z, +hh or +hh:mm.
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}(:\d{2})?)$"
BEYOND_MICROS = r"(\.\d{6})\d+"
HISTORY_START = "1950-01-01T00:00:00Z"


def parse_instant(text) -> Column:
    """ISO-8601 text, with or without a fraction of a second, to a timestamp in microseconds; null when malformed."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(SECONDS_FORMAT)),
        F.try_to_timestamp(text, F.lit(FRACTION_FORMAT)),
        F.when(text.rlike(ISO_INSTANT), F.regexp_replace(text, BEYOND_MICROS, "$1").try_cast("timestamp")),
    )


def history_start(kind: T.DataType = T.TimestampType()) -> Column:
    """The start of an empty history as a timestamp, with or without a zone."""
    text = HISTORY_START.removesuffix("Z") if kind == T.TimestampNTZType() else HISTORY_START
    return F.lit(text).cast(kind)
