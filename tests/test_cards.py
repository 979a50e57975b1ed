import random

from pyspark.sql import functions as F

from tidings import schema
from tidings.operators import cards as cd
from tidings.operators import ordered


def test_sequence_numbers_against_a_loop(spark):
    rng = random.Random(4)
    pages, want = [], []
    for page in range(60):
        cards, seq = [], 0
        for _ in range(rng.randint(0, 25)):
            t, u, x, d = (rng.choice(["", v, v, v]) for v in ("t", "/u", "x", "5 мая 2020"))
            cards.append((t, u, "", None, x, d, None))
            seq += 1
            ok = t and u and d
            want.append((page, len(cards), seq, bool(ok)))
            seq += 1 if ok else 0
        pages.append((page, "ru", cards))
    rows = spark.createDataFrame(pages, f"page int, lang string, cards {schema.LISTING['cards'].dataType.simpleString()}")
    judged = cd.judge(rows, F.col("lang"), "2024-12-31")
    got = judged.select("page", F.inline("accepted")).select("page", "pos", "seq", F.lit(True)).union(
        judged.select("page", F.inline("rejected")).select("page", "pos", "seq", F.lit(False)))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_page_counts_keep_undated_cards(spark):
    cards = [("t", "/u", "", None, "x", d, None) for d in ("1.1.2020", "1.1.2025", "когда-то")]
    rows = spark.createDataFrame([("ru", cards)], f"lang string, cards {schema.LISTING['cards'].dataType.simpleString()}")
    counted = cd.page_counts(cd.judge(rows, F.col("lang"), "2024-12-31"), F.lit("2024-06-01").cast("date"))
    assert counted.select("cards", "old").first() == (3, 1)


def test_split_by_mark_is_inclusive(spark):
    rows = spark.sql("select * from values (1, date'2024-01-01'), (2, date'2024-01-02'), (3, null) t(id, dt)")
    new, late = cd.split_by_mark(rows, F.lit("2024-01-02").cast("date"))
    assert [r.id for r in new.collect()] == [2] and [r.id for r in late.collect()] == [1]


def test_running_values_in_blocks_equal_plain_windows(spark):
    rng = random.Random(5)
    # One key holds most rows; the order has gaps.
    rows = [("hot" if rng.random() < .7 else f"k{rng.randint(0, 3)}", o, rng.choice([None, rng.randint(0, 999)]))
            for o in sorted(rng.sample(range(100_000), 3000))]
    df = spark.createDataFrame(rows, "k string, o long, v int").repartition(5)
    out = ordered.running_max(ordered.row_number(df, ["k"], "o", "n", block=977), ["k"], "o", F.col("v"), "m", block=313)
    plain = df.selectExpr("k", "o", "v", "row_number() over (partition by k order by o) n",
                          "max(v) over (partition by k order by o) m")
    assert out.count() == 3000
    assert out.select("k", "o", "v", "n", "m").exceptAll(plain).isEmpty()
