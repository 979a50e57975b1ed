import datetime as dt

from pyspark.sql import functions as F

from tidings.functions import dates

RUN = "2024-12-31"


def day(y, m, d):
    return dt.date(y, m, d)


def test_russian(apply):
    given = {
        "сегодня": day(2024, 12, 31), "Сейчас читают": day(2024, 12, 31), "вчера, 10:00": day(2024, 12, 30),
        "18 октября 2024": day(2024, 10, 18), "18 октября": day(2024, 10, 18), "18.10.2024": day(2024, 10, 18),
        "18.10": day(2024, 10, 18), "18.10.": day(2024, 10, 18), "Вторник, 5 МАЯ 2020 г.": day(2020, 5, 5),
        "31 февраля 2024": day(2024, 3, 2), "31.2.2023": day(2023, 3, 3), "0 мая 2024": None,
        "32.10.2024": None, "1.13.2024": None, "18 шт 18.10.2024": None, "18 foo 18.10.2024": day(2024, 10, 18),
        "118 мая 2024": day(2024, 5, 18), "5 май 2024": None, "": None, "нет даты": None, None: None,
        " 5 мая 2024 ": day(2024, 5, 5),
    }
    assert apply(lambda c: dates.parse_russian(c, RUN), list(given)) == list(given.values())


def test_a_number_before_the_date(apply):
    given = ["10.05 18.10.2024", "12.30, 18.10.2024", "10 ч, 18 октября 2024"]
    for strict in (True, False):
        assert apply(lambda c: dates.parse_russian(c, RUN, strict), given) == [day(2024, 10, 18)] * 3


def test_strict_wants_the_separator(apply):
    given = {"18 октября": None, "18 октября 2024": day(2024, 10, 18), "18 октября г": day(2024, 10, 18),
             "18.10": None, "18.10.": day(2024, 10, 18), "сегодня": day(2024, 12, 31)}
    assert apply(lambda c: dates.parse_russian(c, RUN, strict=True), list(given)) == list(given.values())


def test_kyrgyz(apply):
    given = {"бүгүн": day(2024, 12, 31), "Кечээ": day(2024, 12, 30), "жума, 18 октябрь 2024": day(2024, 10, 18),
             "18 октября 2024": None, "7 июнь": day(2024, 6, 7), "7.6.2021": day(2021, 6, 7), "сегодня": None}
    assert apply(lambda c: dates.parse_kyrgyz(c, RUN), list(given)) == list(given.values())


def test_by_language(spark):
    rows = spark.createDataFrame(
        [("ru", "1 мая 2020"), ("kg", "1 май 2020"), ("ky", "1 май 2020"), ("de", "1.5.2020")], "lang string, s string")
    out = rows.select(dates.parse_date(F.col("s"), F.col("lang"), RUN)).collect()
    assert [r[0] for r in out] == [day(2020, 5, 1)] * 3 + [None]


def test_weekdays_go_in_list_order(apply):
    out = apply(lambda c: dates.drop_weekdays(c, dates.RU_WEEKDAYS), ["Вторник Среда ПТ", "впнт"])
    assert out == ["орник еда ", ""]


def test_safe_int(apply):
    assert apply(dates.safe_int, ["5", "-7", "x", "", None, "99999999999"]) == [5, -7, None, None, None, None]
