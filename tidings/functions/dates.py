"""Dates as written on Russian and Kyrgyz news listings, as Column expressions.

``run_date`` stands for "today"; no expression reads the clock.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.text import ASCII_SPACE, trim_space

# Month names, weekday names and relative words.
RU_MONTHS = (
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
)
KY_MONTHS = (
    "январь", "февраль", "март", "апрель", "май", "июнь",
    "июль", "август", "сентябрь", "октябрь", "ноябрь", "декабрь",
)
RU_WEEKDAYS = (
    "пн", "вт", "ср", "чт", "пт", "сб", "вс", "понедельник", "вторник", "среда",
    "четверг", "пятница", "суббота", "воскресенье",
)
KY_WEEKDAYS = ("дүй", "шейш", "шарш", "бейш", "жума", "ишемби", "чекмек")
RU_TODAY, RU_YESTERDAY = ("сегодня", "сейчас"), ("вчера", "вчерашний")
KY_TODAY, KY_YESTERDAY = ("бүгүн",), ("кечээ",)

# Language codes in use; 'kg' is another name of 'ky'.
RUSSIAN, KYRGYZ = ("ru",), ("ky", "kg")


def safe_int(c: Column) -> Column:
    """Integer, or NULL where the text is none (checked first: a failing cast
    costs an exception per row)."""
    return F.when(F.rlike(c, F.lit(r"^[+-]?\d+$")), c.try_cast("int"))


def calendar_day(year: Column, month: Column, day: Column) -> Column:
    """Day of a month; 31 February rolls over. NULL outside 1-31 and 1-12."""
    valid = day.between(1, 31) & month.between(1, 12)
    first = F.make_date(year, F.when(valid, month), F.lit(1))
    return F.date_add(first, day - 1)


def drop_weekdays(c: Column, words: tuple[str, ...]) -> Column:
    """Lower-case and cut the weekday words, in list order, as substrings."""
    c = F.lower(c)
    for word in words:
        c = F.replace(c, F.lit(word), F.lit(""))
    return c


def relative_date(c: Column, run_date: Column, today: tuple, yesterday: tuple) -> Column:
    """Run date or the day before where such a word occurs, else NULL."""
    def has(words):
        return reduce(Column.__or__, [F.contains(c, F.lit(w)) for w in words])

    return F.when(has(today), run_date).when(has(yesterday), F.date_add(run_date, -1))


def absolute_date(c: Column, run_date: Column, months: tuple[str, ...], strict: bool) -> Column:
    """``d month [yyyy]`` or ``d.m[.yyyy]``; a missing year is the run's year.

    A text that has the first form is never tried as the second. The forms
    with a separator after the month come first; without ``strict`` a text that
    has neither of them is tried without that separator.
    """
    sep = ASCII_SPACE + "+"
    named, dotted = rf"\d{{1,2}}{sep}[а-яё]+{sep}(?:\d{{4}})?", r"\d{1,2}\.\d{1,2}\.(?:\d{4})?"
    loose_named, loose_dotted = rf"\d{{1,2}}{sep}[а-яё]+", r"\d{1,2}\.\d{1,2}"
    names = F.array(*map(F.lit, months))

    def number(found, pattern):
        # Digits or nothing, by the patterns above.
        return F.nullif(F.regexp_extract(found, pattern, 1), F.lit("")).cast("int")

    def build(found, month):
        year = F.coalesce(number(found, r"(\d{4})$"), F.year(run_date))
        parts = F.struct(year.alias("y"), month.alias("m"), number(found, r"^(\d+)").alias("d"))
        return let(parts, lambda p: calendar_day(p["y"], p["m"], p["d"]))

    def by_number(found):
        return build(found, number(found, r"^\d+\.(\d+)"))

    def by_name(found):
        return build(found, F.array_position(names, F.regexp_extract(found, "[а-яё]+", 0)).cast("int"))

    def first(forms):
        if not forms:
            return F.lit(None).cast("date")
        (pattern, read), rest = forms[0], forms[1:]
        return let(F.regexp_extract(c, pattern, 0), lambda found: F.when(found != "", read(found)).otherwise(first(rest)))

    forms = [(named, by_name), (dotted, by_number)]
    return first(forms if strict else [*forms, (loose_named, by_name), (loose_dotted, by_number)])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parse(c, run_date, weekdays, today, yesterday, months, strict):
    return let(trim_space(drop_weekdays(c, weekdays)), lambda text: F.coalesce(
        relative_date(text, run_date, today, yesterday),
        absolute_date(text, run_date, months, strict),
    ))


def _day(run_date: Column | dt.date | str) -> Column:
    return run_date if isinstance(run_date, Column) else F.lit(str(run_date)).cast("date")


def parse_russian(c: Column, run_date, strict: bool = False) -> Column:
    return _parse(c, _day(run_date), RU_WEEKDAYS, RU_TODAY, RU_YESTERDAY, RU_MONTHS, strict)


def parse_kyrgyz(c: Column, run_date, strict: bool = False) -> Column:
    return _parse(c, _day(run_date), KY_WEEKDAYS, KY_TODAY, KY_YESTERDAY, KY_MONTHS, strict)


def parse_date(c: Column, lang: Column, run_date, strict: bool = False) -> Column:
    """Date of a card in its language; NULL for text or languages not understood."""
    return (F.when(lang.isin(*RUSSIAN), parse_russian(c, run_date, strict))
            .when(lang.isin(*KYRGYZ), parse_kyrgyz(c, run_date, strict)))
