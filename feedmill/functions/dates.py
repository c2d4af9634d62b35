"""Mixed-format date strings to UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.columns import bound

# Month names as they begin.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
MONTH = rf"({'|'.join(MONTHS)})[a-z]*\.?"
ORDINAL = "(?:st|nd|rd|th)?"

# The spellings of a date, in the order they are tried: pattern and the groups of year, month and day.
# Two numbers before a year are month and day, unless the first can only be a day.
SPELLINGS = (
    (r"\b(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)", 1, 2, 3),
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", 1, 2, 3),
    (rf"\b(\d{{1,2}}){ORDINAL}[ -]+(?:of )?{MONTH}[ -]+'?(\d{{4}}|\d{{2}})\b(?!:)", 3, 2, 1),
    (rf"\b(\d{{4}})[ -]+{MONTH}[ -]+(\d{{1,2}}){ORDINAL}\b(?!:)", 1, 2, 3),
    (rf"\b{MONTH}[ -]+(\d{{1,2}}){ORDINAL}[ -]+(\d{{4}})\b(?!:)", 3, 1, 2),
    (rf"\b{MONTH} +(\d{{1,2}}){ORDINAL} (?=.*\d:\d)", 0, 1, 2),
    (r"\b(1[3-9]|2\d|3[01])[-/.](\d{1,2})[-/.](\d{4}|\d{2})\b(?!:)", 3, 2, 1),
    (r"\b(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})\b(?!:)", 3, 1, 2),
)
CLOCK = r"(?:^|[ t])(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6})\d*)?)?"
COMPACT_CLOCK = r"^ ?t(\d{2})(\d{2})(\d{2})?(?:\.(\d{1,6})\d*)?"
HALF = r"([ap])\.?m\b\.?"
HOUR = rf"(?:^| )(\d{{1,2}}) ?{HALF}"
ZONE = r"([+-]\d{2})(?::?(\d{2}))?(?: ?\([^)]*\))?$"
LAST_YEAR = r" (\d{4})$"
WEEKDAY = r"^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.? ?"
# A zone given by name is read as UTC, and so is none at all.
NAMED_ZONE = r"^ *[a-z]{0,5} *$"
ISO = r"^\d{4}-\d{1,2}-\d{1,2}"


def _read(text: Column) -> Column:
    """The date in a lower-case text with single blanks: date, clock, half of the day, zone, and nothing else."""

    def group(value: Column, pattern: str, number: int) -> Column:
        return F.nullif(F.regexp_extract(value, pattern, number), F.lit(""))

    def spelt(pattern: str, year: int, month: int, day: int) -> Column:
        rest = F.regexp_replace(text, pattern, " ")
        last = group(rest, LAST_YEAR, 1)
        name = F.lower(group(text, pattern, month))
        number = F.coalesce(*[F.when(name == m, F.lit(str(i))) for i, m in enumerate(MONTHS, 1)], name)
        digits = group(text, pattern, year) if year else last
        full = F.when(F.length(digits) == 2, F.concat(F.when(digits < "69", "20").otherwise("19"), digits)).otherwise(digits)
        return F.struct(
            F.concat_ws("-", full, F.lpad(number, 2, "0"), F.lpad(group(text, pattern, day), 2, "0")).alias("date"),
            (rest if year else F.regexp_replace(rest, LAST_YEAR, "")).alias("rest"),
        )

    found = F.coalesce(*[F.when(text.rlike(s[0]), spelt(*s)) for s in SPELLINGS])

    def timed(date: Column) -> Column:
        rest = date["rest"]
        zoned = rest.rlike(r"\d:?\d{2}.*" + ZONE)
        offset = F.concat(group(rest, ZONE, 1), F.lit(":"), F.coalesce(group(rest, ZONE, 2), F.lit("00")))
        plain = F.when(zoned, F.regexp_replace(rest, ZONE, "")).otherwise(rest)
        pattern = lambda i: F.coalesce(group(plain, CLOCK, i), group(plain, COMPACT_CLOCK, i))
        hour = F.coalesce(pattern(1), group(plain, HOUR, 1)).cast("int")
        half = F.coalesce(group(plain, rf"\d ?{HALF}", 1), F.lit(""))
        hour = F.when(half == "p", hour % 12 + 12).when(half == "a", hour % 12).otherwise(hour)
        two = lambda value: F.lpad(F.coalesce(value.cast("string"), F.lit("0")), 2, "0")
        clock = F.concat(
            two(hour), F.lit(":"), two(pattern(2)), F.lit(":"), two(pattern(3)), F.lit("."), F.coalesce(pattern(4), F.lit("0"))
        )
        left = plain
        for seen in (CLOCK, COMPACT_CLOCK, HOUR, rf"(?:^| )?{HALF}"):
            left = F.regexp_replace(left, seen, "")
        stamp = F.concat(date["date"], F.lit(" "), clock, F.when(zoned, offset).otherwise("Z"))
        return F.when(left.rlike(NAMED_ZONE), stamp.try_cast("timestamp"))

    return bound(found, timed)


def _spelt_out(text: Column) -> Column:
    tidy = F.lower(F.trim(F.regexp_replace(text, r"[\s,]+", " ")))
    return bound(F.regexp_replace(tidy, WEEKDAY, ""), _read)


def to_utc(text: Column) -> Column:
    """UTC timestamp of ``text``, or null when it is no date; a missing zone means UTC.

    The ISO forms, the bulk of real feeds, take the native cast; what that cannot read, and any other
    spelling, is taken apart.
    """
    iso = F.regexp_replace(F.trim(text), r"(?i) ?(?:utc|gmt|z)$", "Z")
    iso = F.regexp_replace(iso, r" ?([+-]\d{2}):?(\d{2})$", "$1:$2")
    native = F.when(F.trim(text).rlike(ISO), iso.try_cast("timestamp"))
    return F.coalesce(native, _spelt_out(text))
