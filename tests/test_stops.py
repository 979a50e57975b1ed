import random

from pyspark.sql import functions as F

from tidings import schema
from tidings.operators import stops
from tidings.session import sized

COLS = "lang string, page_num int, cards int, old int, has_next boolean, fetched boolean"


def walk(pages, stop_after, max_pages):
    """The crawl loop, page by page."""
    total = cards = old = streak = 0
    for n, c, o, has_next, fetched in pages:
        if not fetched:
            return total, cards, old, streak, "fetch_error"
        if c == 0:
            return total, cards, old, streak, "no_cards"
        total, cards, old = total + 1, cards + c, old + o
        streak = streak + 1 if o == c else 0
        if streak >= stop_after:
            return total, cards, old, streak, "old_streak"
        if not has_next:
            return total, cards, old, streak, "no_next"
        if n == max_pages:
            return total, cards, old, streak, "max_pages"
    raise AssertionError("a run must end")


def test_random_runs_against_the_loop(spark):
    rng, rows, want = random.Random(6), [], []
    for i in range(300):
        lang, max_pages, k = f"l{i}", rng.randint(1, 12), 3
        pages = []
        for n in range(1, max_pages + 1):
            c = rng.choice([0, 1, 2, 3, 3, 3, 3])
            o = rng.choice([c, c, rng.randint(0, c)])
            pages.append((n, c, o, rng.random() < .93, True))
            if not pages[-1][3]:
                break
            if rng.random() < .05 and n < max_pages:
                pages.append((n + 1, 0, 0, False, False))
                break
        rows += [(lang, *p) for p in pages]
        want.append((lang, *walk(pages, k, max_pages), max_pages))
    df = spark.createDataFrame(rows, COLS)
    langs = spark.createDataFrame([(w[0], 1, "", w[6]) for w in want], schema.LANGUAGES)
    reasoned = stops.with_reason(stops.with_streak(df, block=4), 3)
    out = stops.run_stats(reasoned, sized(stops.stop_pages(reasoned)), langs)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted(w[:6] for w in want)


def test_counts_from_cards(spark):
    rows = spark.sql("""select * from values ('ru', 1, date'2024-01-01'), ('ru', 1, date'2024-03-01'),
        ('ru', 2, date'2024-01-01'), ('ru', 2, null), ('ru', 3, date'2024-01-01') t(lang, page_num, dt)""")
    out = stops.count_pages(rows, F.lit("2024-02-01").cast("date")).withColumn("all_old", stops.all_old())
    assert sorted(tuple(r) for r in out.collect()) == [
        ("ru", 1, 2, 1, False), ("ru", 2, 2, 1, False), ("ru", 3, 1, 1, True)]


def test_cards_up_to_the_stop_page(spark):
    cards = spark.createDataFrame([("a", n) for n in range(1, 6)] + [("b", 9)], "lang string, page_num int")
    stop_at = spark.createDataFrame([("a", 2, "no_next")], "lang string, stop_page int, reason string")
    assert sorted(tuple(r) for r in stops.until_stop(cards, stop_at).collect()) == [("a", 1), ("a", 2), ("b", 9)]
