"""Column helpers: the cleaning rules, epoch -> day, list index, TSV lines.

All are plain Catalyst expressions, so they stay inside whole-stage codegen
and, where they are simple comparisons on a scanned column, Catalyst can push
them to the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original job's for the same results.
EPOCH_MIN = 1000000000          # smallest ten-digit number
EPOCH_MAX = 9999999999          # largest ten-digit number
MIN_ID_LENGTH = 11              # ids must be longer than 10 characters
SITE_LENGTH = 14                # the strict job keeps sites of exactly 14 characters
NULL_TEXT = "null"              # how a null field is printed in a line
FIELD_SEP = "\t"
QUOTE = '"'

MILLIS_PER_DAY = 86400 * 1000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: str | Column) -> Column:
    """Delete every double quote."""
    return F.translate(_col(c), QUOTE, "")


def is_epoch_seconds(c: str | Column, text: bool = False) -> Column:
    """True when the value is exactly ten decimal digits.

    For an integral column that is a range test (it can reach the Parquet
    reader as a pushed filter); for text it is an anchored regex.  ``\\z`` is
    used instead of ``$`` so that a trailing line break does not pass.
    """
    c = _col(c)
    if text:
        return c.rlike(r"^[0-9]{10}\z")
    return c.between(EPOCH_MIN, EPOCH_MAX)


def is_valid_id(c: str | Column, min_length: int = MIN_ID_LENGTH) -> Column:
    """Ids (device addresses, phone numbers) must be at least ``min_length`` long."""
    return F.length(_col(c)) >= min_length


def is_valid_site(c: str | Column, length: int = SITE_LENGTH) -> Column:
    return F.length(_col(c)) == length


def epoch_to_day(c: str | Column) -> Column:
    """``yyyyMMdd`` (UTC) of an epoch value: ten digits are seconds, anything
    else milliseconds.  Commas only matter for the length test.

    Day arithmetic is done on integers and formatted from a DATE, so the
    result does not depend on the session time zone.
    """
    text = F.regexp_replace(_col(c).cast("string"), ",", "")
    v = text.try_cast("long")
    millis = F.when(F.length(text) == 10, v * 1000).otherwise(v)
    day_number = (millis - F.pmod(millis, F.lit(MILLIS_PER_DAY))).cast("long") / F.lit(MILLIS_PER_DAY)
    return F.date_format(F.date_from_unix_date(day_number.cast("int")), "yyyyMMdd")


def day_of_epoch(seconds: int) -> str:
    """Driver-side twin of :func:`epoch_to_day` for a literal (partition pruning)."""
    import datetime as _dt

    text = str(seconds).replace(",", "")
    millis = int(text) * 1000 if len(text) == 10 else int(text)
    day = _dt.datetime.fromtimestamp(millis // 1000, tz=_dt.timezone.utc)
    return day.strftime("%Y%m%d")


def csv_index(name: str | Column, csv: str | Column) -> Column:
    """0-based position of ``name`` in the comma list ``csv``; -1 when absent.
    No trimming, exact comparison."""
    return (F.array_position(F.split(_col(csv), ",", -1), _col(name)) - 1).cast("long")


def tsv_line(*cols: str | Column) -> Column:
    """Fields joined by tab, null printed as ``null``, then every quote removed.

    ``concat_ws`` alone would silently drop null fields, so each field is
    coalesced first.
    """
    fields = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TEXT)) for c in cols]
    return strip_quotes(F.concat_ws(FIELD_SEP, *fields))


def segment_line(source: str, id_col: str = "id", stime: str = "stime", site: str = "site",
                 etime: str = "etime") -> Column:
    """``id \\t stime \\t site \\t etime \\t source``."""
    return F.concat_ws(FIELD_SEP, F.col(id_col), F.col(stime).cast("string"), F.col(site),
                       F.col(etime).cast("string"), F.lit(source))


def same_site(a: Column, b: Column) -> Column:
    """Case-insensitive site equality."""
    return F.lower(a) == F.lower(b)
