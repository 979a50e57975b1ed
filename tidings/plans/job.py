"""One scheduled run as a job:

    zip -qr tidings.zip tidings
    spark-submit --py-files tidings.zip tidings/plans/job.py --config config.yaml --pages <folder> \\
        --out <folder> --uids ru=1,ky=2 --run-date 2024-12-31

The configuration lists the languages (name, base_url, selectors_file,
accept_language, max_pages) and the limits of the stop rule. Results go below
``--out``: ``news`` (the table), ``parsed`` (pages parsed so far and their ledger), ``quarantine``,
``rejects`` (cards without a readable date or of an unknown language) and ``stats`` (one folder per run), and with ``--archive`` also ``pages``. Pages are read
by day of fetch where their folder has ``fetch_date`` partitions.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidings import schema
from tidings.plans.run import DAYS_BACK, STOP_AFTER, run_news
from tidings.session import builder, local_table
from tidings.sources import pages as page_source
from tidings.sources import rules as rl
from tidings.sources import sinks
from tidings.sources.parsed import ParsedPages


def read_config(spark: SparkSession, path: str) -> dict:
    import yaml  # optional: only YAML configurations need it

    return yaml.safe_load(spark.read.text(path, wholetext=True).first()[0]) or {}


def checked_languages(spark: SparkSession, config: Mapping) -> DataFrame:
    """The language table of a configuration; a broken one is refused."""
    rows = [(r.get("name"), r.get("base_url"), r.get("selectors_file"), r.get("accept_language"),
             r.get("max_pages")) for r in config.get("languages") or []]
    if not rows:
        raise ValueError("at least one language is required")
    problems = rl.language_violations(local_table(spark, rows, schema.LANGUAGE_ROWS)).collect()
    if problems:
        raise ValueError("languages: " + ", ".join(f"{p.lang or '?'}: {p.problem}" for p in problems))
    return local_table(spark, [(r[0], i + 1, r[1], r[4]) for i, r in enumerate(rows)], schema.LANGUAGES)


def checked_rules(spark: SparkSession, config: Mapping, languages: DataFrame, base: str) -> DataFrame:
    files = {r["name"]: r["selectors_file"] for r in config["languages"]}
    rules = rl.read_rules(spark, files, base)
    missing = rl.rule_violations(languages, rules).collect()
    if missing:
        raise ValueError("rules missing: " + ", ".join(f"{m.lang}: {m.field}" for m in missing))
    return rules


def run_job(spark: SparkSession, config: Mapping, pages: str, out: str, uids: Mapping[str, int],
            run_date: str, base: str = "configs", archive: bool = False, run_id: str | None = None) -> DataFrame:
    """Run once and store the results; the statistics per language.

    ``run_id`` names the run's rows in quarantine, statistics and archive: a
    retry under the same name replaces them. Without one the run is a new one.
    """
    run_id = run_id or f"{run_date}-{uuid.uuid4().hex[:12]}"
    languages = checked_languages(spark, config)
    rules = checked_rules(spark, config, languages, base)
    limits = config.get("pagination") or {}
    fetched = page_source.read_pages(spark, pages)
    parsed = ParsedPages(spark, f"{out}/parsed")
    parsed.parse_new(fetched, rules, run_id)
    table = sinks.NewsTable(spark, f"{out}/news")
    run = run_news(
        fetched, rules, languages,
        local_table(spark, [(uid, alias) for alias, uid in uids.items()], schema.LANG_DIM),
        table.read(), run_date,
        limits.get("days_back_threshold", DAYS_BACK), limits.get("stop_on_known_chain_pages", STOP_AFTER),
        summary=table.summary(), listing=parsed.listing(rules))
    if archive:
        sinks.write_page_archive(fetched, f"{out}/pages", run_id)
    sinks.write_quarantine(run.issues, f"{out}/quarantine", run_id)
    sinks.write_quarantine(run.rejects, f"{out}/rejects", run_id)
    sinks.write_run_stats(run.stats, f"{out}/stats", run_id)
    table.merge(run.batch)
    return run.stats


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("config", "pages", "out", "uids", "run-date"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--rules-folder", default="configs")
    p.add_argument("--archive", action="store_true")
    p.add_argument("--run-id", help="name of this run; give the same one to retry it")
    a = p.parse_args(argv)
    spark = builder("news run").getOrCreate()
    uids = {k: int(v) for k, v in (pair.split("=") for pair in a.uids.split(","))}
    run_job(spark, read_config(spark, a.config), a.pages, a.out, uids, a.run_date, a.rules_folder,
            a.archive, a.run_id).show(truncate=False)


if __name__ == "__main__":
    main()
