"""Value normalisation: dates, timestamps, flags, markers and canonical item fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailsight.functions import fixed

# Layouts of visit dates, month before day where both could be meant.
VISIT_DATE_FORMATS = (
    "yyyy-M-d",
    "M/d/yyyy",
    "yyyy/M/d",
    "d/M/yyyy",
    "yyyyMMdd",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "M-d-yyyy",
)
NO_DATE = "0001-01-01"


def date_shape(layout: str) -> str:
    """A pattern that every text has to match that a date layout can read, and few others do."""
    number, word = r"\s*[-+]?\d+", r".*?"
    parts = re.findall(r"([A-Za-z]+)|([^A-Za-z]+)", layout)
    shape = "".join(
        word if "MMM" in letters and letters.strip("M") == "" else number if letters else re.escape(literal) for letters, literal in parts
    )
    return rf"(?sU)^{shape}"


def parse_date(text: Column, formats: tuple[str, ...]) -> Column:
    """First format that fits, in order; NULL when none does.

    A layout that does not fit is found out by an exception inside the parser, which costs many times
    what a pattern does; so a layout is only tried on texts of its shape.
    """
    return F.coalesce(*[F.when(text.rlike(date_shape(f)), F.try_to_date(text, f)) for f in formats])


def normal_date(name: str) -> Column:
    """yyyy-MM-dd when the text reads as a date or timestamp, else the text itself."""
    raw = F.col(name)
    text = F.trim(raw)
    # A timestamp keeps its own calendar day, whatever its offset.
    day = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})[T ]\d{2}:\d{2}", 1)
    us_day = F.regexp_extract(text, r"^(\d{1,2}/\d{1,2}/\d{4}) \d{1,2}:\d{2}", 1)
    core = F.when(day != "", day).when(us_day != "", us_day).otherwise(text)
    return F.coalesce(F.date_format(parse_date(core, VISIT_DATE_FORMATS), "yyyy-MM-dd"), raw)


def date_sort_key(normalised: Column) -> Column:
    """Sortable yyyy-MM-dd; anything else comes first."""
    text = F.substring(normalised, 1, 10)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).otherwise(F.lit(NO_DATE))


def normal_timestamp(name: str) -> Column:
    """ISO text to 'yyyy-MM-dd HH:mm:ss' in UTC; blanks to NULL; other text unchanged.

    Text without an offset keeps its clock time, whatever the session time zone.
    """
    text = F.trim(F.col(name).cast("string"))
    blank = (text == "") | F.lower(text).isin("none", "nan")
    iso = text.rlike(
        r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
    )
    # Nothing to complete or move: the steps below would leave such a text as it is.
    plain = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2})?$")
    as_is = F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd HH:mm:ss")
    # Spark wants minutes and seconds in a time and a colon in an offset.
    hours = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(?=$|Z|[+-])", "$1:00")
    minutes = F.regexp_replace(hours, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(?=$|Z|[+-])", "$1:00")
    offset = F.regexp_replace(minutes, r"(:\d{2}(?:[.,]\d+)?)([+-]\d{2}):?(\d{2})?$", "$1$2:$3")
    full = F.regexp_replace(F.regexp_replace(offset, r"([+-]\d{2}):$", "$1:00"), ",", ".")
    instant = F.try_to_timestamp(full)
    utc = F.when(full.rlike(r":\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"), in_utc(instant)).otherwise(instant)
    stamp = F.date_format(utc, "yyyy-MM-dd HH:mm:ss")
    shown = F.when(plain, F.coalesce(as_is, text)).when(iso, F.coalesce(stamp, text)).otherwise(text)
    return F.when(blank, F.lit(None).cast("string")).otherwise(shown)


def flag(name: str | Column) -> Column:
    """true or 'TRUE' in any case; everything else, NULL included, is false."""
    col = F.col(name) if isinstance(name, str) else name
    return F.coalesce(F.lower(F.trim(col.cast("string"))) == "true", F.lit(False))


def has_first_marker(text: str | Column) -> Column:
    """A bracketed first-to-find mark, with optional stars, in any case."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.rlike(fixed.FTF_MARKER), F.lit(False))


def rounded(name: str, places: int) -> Column:
    """Decimal rounding half away from zero, as stored values are compared."""
    return F.round(F.col(name).cast("decimal(20,10)"), places).cast("double")


def canonical_attributes(name: str) -> Column:
    """Attribute list as sorted JSON of id and name, for comparison; NULL counts as empty."""
    empty = F.array().cast("array<struct<id:int,name:string>>")
    pairs = F.transform(
        F.coalesce(F.col(name), empty),
        lambda a: F.struct(a["id"].cast("int").alias("id"), a["name"].alias("name")),
    )
    return F.to_json(F.array_sort(pairs))


def in_utc(stamp: Column) -> Column:
    """Clock time of an instant in UTC, to be formatted in the session time zone."""
    return F.to_utc_timestamp(stamp, F.current_timezone())


def iso_millis(stamp: Column) -> Column:
    return F.date_format(in_utc(stamp), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
