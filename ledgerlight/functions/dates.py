"""Dates as they are stored and as they are printed, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of months, full and short, by number; English, German, Slovene and Portuguese.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "januar": 1, "februar": 2, "märz": 3, "maerz": 3, "mai": 5, "juni": 6, "juli": 7, "oktober": 10, "dezember": 12,
    "marec": 3, "maj": 5, "junij": 6, "julij": 7, "avgust": 8,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "fev": 2, "abr": 4, "ago": 8, "set": 9, "out": 10, "dez": 12,
}
ISO = r"^([0-9]{4})-([0-9]{2})-([0-9]{2})\z"


def _made(year: Column, month: Column, day: Column) -> Column:
    """The date of three texts or numbers; null where there is no such day."""
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat_ws("-", pad(year, 4), pad(month, 2), pad(day, 2)).try_cast("date")


def parse_date(value: Column) -> Column:
    """An ISO date; days 29 to 31 past the end of their month are its last day, anything else unreal is null."""
    part = lambda n: F.regexp_extract(value, ISO, n)
    last = F.last_day(_made(part(1), part(2), F.lit("01")))
    real = _made(part(1), part(2), part(3))
    return F.when(value.rlike(ISO) & (part(1) > "0000"), F.coalesce(real, F.when(part(3).between("29", "31"), last)))


def parse_printed_date(value: Column) -> Column:
    """The date at the beginning of a text: ISO, D.M.Y, Month D, Y or D Month Y; an unreal day is null."""
    names = "|".join(sorted(MONTHS, key=lambda m: (-len(m), m)))
    number = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    forms = [  # pattern, and the groups of year, month and day
        (r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", 1, 2, 3, False),
        (r"^([0-9]{1,2})[./][ \t]*([0-9]{1,2})[./][ \t]*([0-9]{4})", 3, 2, 1, False),
        (rf"(?iu)^({names})\.?\s+([0-9]{{1,2}})(?:st|nd|rd|th)?,?\s+([0-9]{{4}})", 3, 1, 2, True),
        (rf"(?iu)^([0-9]{{1,2}})(?:\.?\s*|-)({names})\.?(?:\s+|-)([0-9]{{4}})", 3, 2, 1, True),
    ]
    out = None
    for pattern, year, month, day, named in forms:
        part = lambda n, pattern=pattern: F.regexp_extract(value, pattern, n)
        told = F.element_at(number, F.lower(part(month))) if named else part(month)
        date = _made(part(year), told, part(day))
        out = F.when(value.rlike(pattern), date) if out is None else out.when(value.rlike(pattern), date)
    return out
