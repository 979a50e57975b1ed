import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidings import schema
from tidings.operators import lookup, merge
from tidings.sources import rules as rl
from tidings.sources import sinks

D = dt.date


def news(spark, rows):
    """(uid, seq, dt, title, url) with the title as text and checksum."""
    return spark.createDataFrame([(u, s, d, t, t, url, "", f"{s}{d}{t}") for u, s, d, t, url in rows], schema.NEWS)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(1, "ru"), (2, "ky")], schema.LANG_DIM)


@pytest.fixture(scope="module")
def langs(spark):
    return spark.createDataFrame([("ru", 1, "", 5), ("kg", 2, "", 5), ("xx", 3, "", 5)], schema.LANGUAGES)


def test_marks_and_counts(spark, dim, langs):
    table = news(spark, [(1, 1, D(2024, 12, 1), "a", "/a"), (1, 1, D(2024, 11, 1), "b", "/b"), (7, 1, D(2025, 1, 1), "c", "/c")])
    day = F.lit("2024-12-31").cast("date")
    latest = dict(tuple(r) for r in lookup.latest_dates(table, langs, dim, day).collect())
    assert latest == {"ru": D(2024, 12, 1), "kg": D(2023, 12, 31), "xx": None}
    marks = dict(tuple(r) for r in lookup.high_water_marks(table, langs, dim, day, 120).collect())
    assert marks == {"ru": D(2024, 12, 1), "kg": D(2024, 9, 2), "xx": D(2024, 9, 2)}
    counts = dict(tuple(r) for r in lookup.card_counts(table, langs, dim).collect())
    assert counts == {"ru": 2, "kg": 0}


def test_a_year_before_leap_day(spark):
    row = spark.range(1).select(lookup.a_year_before(F.lit("2024-02-29").cast("date"))).first()
    assert row[0] == D(2023, 3, 1)


def test_language_codes(spark, dim):
    rows = spark.createDataFrame([("ru",), ("kg",), ("ky",), ("xx",)], "lang string")
    assert sorted(tuple(r) for r in lookup.with_language_uid(rows, dim).collect()) == [("kg", 2), ("ky", 2), ("ru", 1)]
    assert [r[0] for r in lookup.unknown_languages(rows, dim).collect()] == ["xx"]
    own = spark.createDataFrame([(1, "kg"), (2, "ky")], schema.LANG_DIM)
    assert sorted(tuple(r) for r in lookup.known_codes(own).collect()) == [("kg", 1), ("ky", 2)]


def test_url_lookups(spark):
    table = news(spark, [(1, 1, D(2024, 1, 1), "a", "/a"), (1, 2, D(2024, 1, 1), "b", "/a")])
    urls = spark.createDataFrame([("/a",), ("/a",), ("/b",)], "url string")
    assert sorted(tuple(r) for r in lookup.known_urls(urls, table).collect()) == [("/a", True), ("/b", False)]
    assert [r[0] for r in lookup.stored_urls(urls, table).collect()] == ["/a"]
    assert [r[0] for r in lookup.unseen_urls(urls, table).collect()] == ["/b"]


def one_by_one(table, rows):
    """Row-wise merges: a match takes all but the language."""
    out = {r[4]: r for r in table}
    for r in rows:
        out[r[4]] = (out[r[4]][0], *r[1:]) if r[4] in out else r
    return sorted(out.values())


def as_rows(df):
    return sorted((r.language_uid, r.sequence_num, r.dt, r.title, r.url) for r in df.collect())


def test_merge_against_single_merges(spark):
    rng = random.Random(7)

    def make(n, start):
        return [(rng.randint(1, 3), start + i, D(2024, 1, rng.randint(1, 28)), rng.choice("abc"), f"/{rng.randint(0, 60)}")
                for i in range(n)]

    old = one_by_one([], make(50, 0))
    new = make(120, 1000)
    table = news(spark, old).repartition(3)
    batch = merge.dedupe_batch(news(spark, new).repartition(4), ["sequence_num"])
    want = one_by_one(old, new)
    for small in (True, False, None):
        plan = merge.merge_plan(table, batch, small=small)
        assert as_rows(plan) == want
        # The same batch again changes nothing.
        again = merge.merge_plan(plan.drop("status"), batch, small=small)
        assert as_rows(again) == want
        assert {r.status for r in again.select("status").distinct().collect()} == {"kept", "unchanged"}
    counts = {r.status: r.n for r in merge.merge_counts(merge.merge_plan(table, batch)).collect()}
    known = {r[4] for r in old}
    assert counts["new"] == len({r[4] for r in new} - known)
    assert counts["kept"] == len(known - {r[4] for r in new})


def test_changed_picture_is_an_update(spark):
    table = news(spark, [(1, 1, D(2024, 1, 1), "a", "/a")])
    batch = table.withColumn("thumbnail_url", F.lit("/new.jpg"))
    row = merge.merge_plan(table, batch, small=False).first()
    assert (row.status, row.thumbnail_url) == ("updated", "/new.jpg")


def test_size_of_a_batch_is_measured(spark):
    batch = news(spark, [(1, i, D(2024, 1, 1), "title", f"/{i}") for i in range(20)])
    assert merge.is_small(batch)
    assert not merge.is_small(batch, max_rows=19)
    assert not merge.is_small(batch, max_bytes=100)
    assert merge.is_small(batch.limit(0))


def test_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    table = sinks.NewsTable(spark, str(tmp_path / "news"))
    table.write(news(spark, [(1, i, D(2024, 1, 1), "t", f"/{i}") for i in range(50)]))
    plan = merge._merge_small(table.read(), news(spark, [(1, 1, D(2024, 1, 1), "t", "/1")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_news_table(spark, tmp_path):
    root = tmp_path / "news"
    table = sinks.NewsTable(spark, str(root))
    assert table.versions() == [] and table.read().count() == 0
    table.merge(news(spark, [(1, 1, D(2024, 1, 1), "a", "/a")]))
    table.merge(news(spark, [(2, 2, D(2024, 1, 2), "b", "/a"), (2, 1, D(2024, 1, 1), "c", "/c")]))
    assert as_rows(table.read()) == [(1, 2, D(2024, 1, 2), "b", "/a"), (2, 1, D(2024, 1, 1), "c", "/c")]
    assert as_rows(table.read(1)) == [(1, 1, D(2024, 1, 1), "a", "/a")]
    # A writer that died leaves no marker: its folder does not count and is replaced.
    (root / "v=3").mkdir()
    (root / "v=3" / "part-0.parquet").write_bytes(b"half")
    assert table.versions() == [1, 2]
    table.merge(news(spark, [(1, 5, D(2024, 1, 5), "d", "/d")]))
    assert table.versions() == [1, 2, 3] and table.read().count() == 3
    table.expire(keep=1)
    assert table.versions() == [3] and table.read().count() == 3


def test_a_merge_rewrites_only_the_buckets_of_its_batch(spark, tmp_path):
    table = sinks.NewsTable(spark, str(tmp_path / "news"), buckets=16)
    table.write(news(spark, [(1 + i % 2, i, D(2024, 1, 1 + i % 28), "t", f"/{i}") for i in range(200)]))
    batch = news(spark, [(1, 7, D(2025, 1, 1), "u", "/7"), (2, 1, D(2025, 1, 2), "u", "/new")])
    touched = table.touched(batch)
    before = {r.bucket: r.folder for r in table.manifest().collect()}
    table.merge(batch)
    after = {r.bucket: r.folder for r in table.manifest().collect()}
    assert 1 <= len(touched) <= 2 and len(before) == 16
    assert {b for b in after if after[b] != before.get(b)} == set(touched)
    data = [p for p in (tmp_path / "news" / "data").iterdir()]
    assert sorted(len(list(p.glob("bucket=*"))) for p in data) == [len(touched), 16]
    rows = {r.url: r.title for r in table.read().collect()}
    assert len(rows) == 201 and rows["/7"] == rows["/new"] == "u" and rows["/8"] == "t"
    # Older versions keep their files until they expire; then only unnamed files go.
    assert table.read(1).count() == 200
    table.expire(keep=1)
    assert table.read().count() == 201 and table.versions() == [2]
    named = {r.folder for r in table.manifest().collect()}
    assert {f"{p.parent.name}/{p.name}" for p in (tmp_path / "news" / "data").glob("*/bucket=*")} == named
    # The number of buckets is the table's own.
    assert sinks.NewsTable(spark, table.root, buckets=3).touched(batch) == touched


def test_files_of_a_writer_that_died_do_not_count(spark, tmp_path):
    table = sinks.NewsTable(spark, str(tmp_path / "news"), buckets=4)
    table.merge(news(spark, [(1, 1, D(2024, 1, 1), "a", "/a")]))
    lost = tmp_path / "news" / "data" / "w=lost" / "bucket=0"
    lost.mkdir(parents=True)
    (lost / "part-0.parquet").write_bytes(b"half")
    assert table.read().count() == 1
    table.expire()
    assert not lost.exists() and table.read().count() == 1


def test_marks_and_counts_read_no_data(spark, dim, langs, tmp_path):
    rows = [(1, 1, D(2024, 12, 1), "a", "/a"), (1, 1, D(2024, 11, 1), "b", "/b"), (7, 1, None, "c", "/c")]
    table = sinks.NewsTable(spark, str(tmp_path / "news"), buckets=4)
    day = F.lit("2024-12-31").cast("date")
    table.write(news(spark, rows))
    table.merge(news(spark, [(2, 3, D(2024, 12, 5), "k", "/k")]))
    marks = lookup.high_water_marks(table.summary(), langs, dim, day, 120)
    assert sorted(map(tuple, marks.collect())) == sorted(map(tuple, lookup.high_water_marks(table.read(), langs, dim, day, 120).collect()))
    counts = lookup.card_counts(table.summary(), langs, dim)
    assert sorted(map(tuple, counts.collect())) == [("kg", 1), ("ru", 2)]
    for df in (marks, counts):
        assert "/data/" not in df._jdf.queryExecution().executedPlan().toString()
        assert all("/data/" not in f for f in df.inputFiles())
    empty = sinks.NewsTable(spark, str(tmp_path / "none")).summary()
    assert sorted(map(tuple, lookup.card_counts(empty, langs, dim).collect())) == [("kg", 0), ("ru", 0)]


def test_lookups_open_only_buckets_that_may_hold_a_url(spark, tmp_path):
    table = sinks.NewsTable(spark, str(tmp_path / "news"), buckets=32)
    table.write(news(spark, [(1, i, D(2024, 1, 1), "t", f"/{i}") for i in range(300)]))
    urls = spark.createDataFrame([("/5",), ("/absent",)], "url string")
    some = table.read_for(urls)
    assert len({f.split("bucket=")[1].split("/")[0] for f in some.inputFiles()}) <= 2 < len(table.read().inputFiles())
    assert sorted(map(tuple, lookup.known_urls(urls, some).collect())) == [("/5", True), ("/absent", False)]


def test_checksum_refresh_of_the_table(spark, tmp_path):
    table = sinks.NewsTable(spark, str(tmp_path / "news"))
    table.write(news(spark, [(1, 1, D(2024, 1, 1), "a", "/a")]))
    assert table.refresh_checksums() == 1
    assert table.refresh_checksums() == 0 and table.versions() == [1, 2]


def test_merge_into_needs_a_table_with_row_level_changes(spark):
    news(spark, []).createOrReplaceTempView("plain")
    with pytest.raises(Exception, match="(?i)merge"):
        merge.merge_into_table(news(spark, []), "plain")


def test_rule_and_language_checks(spark):
    rules = dict(rl.SITE_RULES, text_selectors=[], next_page_link="")
    langs = spark.createDataFrame([("ru",), ("kg",)], "lang string")
    frame = rl.rules_frame(spark, {"ru": rl.SITE_RULES, "kg": rules})
    assert sorted(tuple(r) for r in rl.rule_violations(langs, frame).collect()) == [("kg", "next"), ("kg", "text")]
    rows = spark.createDataFrame(
        [("ru", "u", "s", "a", 1), ("ru", "", "s", None, 0), ("", "u", None, "a", 5)],
        "lang string, base_url string, selectors_file string, accept_language string, max_pages int")
    assert sorted(tuple(r) for r in rl.language_violations(rows).collect()) == [
        ("", "no_name"), ("", "no_selectors_file"), ("ru", "bad_max_pages"), ("ru", "duplicate"),
        ("ru", "no_accept_language"), ("ru", "no_base_url")]
    assert rl.no_languages(rows.limit(0)) and not rl.no_languages(rows)


def test_rules_from_files(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text(yaml.safe_dump(dict(rl.SITE_RULES)), encoding="utf-8")
    frame = rl.read_rules(spark, {"ru": "a.yaml", "kg": str(tmp_path / "a.yaml")}, base=str(tmp_path))
    assert frame.exceptAll(rl.rules_frame(spark, {"ru": rl.SITE_RULES, "kg": rl.SITE_RULES})).isEmpty()
    with pytest.raises(FileNotFoundError):
        rl.read_rules(spark, {"ru": "none.yaml"}, base=str(tmp_path))


def test_sinks_replace_the_rows_of_a_repeated_run(spark, tmp_path):
    path = str(tmp_path / "q")
    issues = spark.createDataFrame([("no_title", 1), ("no_url", 2)], "reason string, seq int")
    for run, rows in (("a", issues), ("b", issues), ("a", issues.where("seq = 1"))):
        sinks.write_quarantine(rows, path, run)
    assert sorted((r.run, r.reason, r.seq) for r in spark.read.parquet(path).collect()) == [
        ("a", "no_title", 1), ("b", "no_title", 1), ("b", "no_url", 2)]
