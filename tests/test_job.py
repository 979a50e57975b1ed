import pytest

from tests.test_run import BASE, fetched, site
from tidings.plans import job
from tidings.sources import rules as rl
from tidings.sources import sinks

yaml = pytest.importorskip("yaml")


def config(**first):
    rows = [{"name": "ru", "base_url": f"{BASE}/ru", "selectors_file": "site.yaml", "accept_language": "ru", "max_pages": 5},
            {"name": "kg", "base_url": f"{BASE}/kg", "selectors_file": "site.yaml", "accept_language": "ky", "max_pages": 2}]
    rows[0].update(first)
    return {"languages": rows, "pagination": {"stop_on_known_chain_pages": 2, "days_back_threshold": 120}}


def test_job(spark, tmp_path):
    (tmp_path / "site.yaml").write_text(yaml.safe_dump(dict(rl.SITE_RULES)), encoding="utf-8")
    (tmp_path / "config.yaml").write_text(yaml.safe_dump(config()), encoding="utf-8")
    fetched(spark, site()).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    read = job.read_config(spark, str(tmp_path / "config.yaml"))
    for run_id in ("one", "one", "two", None):
        stats = job.run_job(spark, read, str(tmp_path / "in"), out, {"ru": 1, "ky": 2}, "2024-12-31", str(tmp_path), True, run_id)
        assert {r.lang: r.stopped_reason for r in stats.collect()} == {"ru": "old_streak", "kg": "max_pages"}
    assert sinks.NewsTable(spark, f"{out}/news").read().count() == 4
    # The repeated run replaced its own quarantine, statistics and archive; other runs of the day kept theirs.
    assert spark.read.parquet(f"{out}/quarantine").count() == 2 * 3
    assert spark.read.parquet(f"{out}/stats").count() == 2 * 3
    assert spark.read.parquet(f"{out}/pages").count() == len(site()) * 3


def test_broken_configurations_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="at least one"):
        job.checked_languages(spark, {})
    with pytest.raises(ValueError, match="bad_max_pages"):
        job.checked_languages(spark, config(max_pages=0))
    with pytest.raises(ValueError, match="duplicate"):
        job.checked_languages(spark, config(name="kg"))
    (tmp_path / "site.yaml").write_text(yaml.safe_dump(dict(rl.SITE_RULES, date_selectors=[])), encoding="utf-8")
    with pytest.raises(ValueError, match="kg: date|ru: date"):
        job.checked_rules(spark, config(), job.checked_languages(spark, config()), str(tmp_path))
