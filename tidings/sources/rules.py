"""Extraction rules and languages as data: loading and checking."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings import schema
from tidings.session import folder, local_table

# Rule fields by their names in rule files.
FILE_FIELDS = {
    "card_selectors": "card",
    "title_selectors": "title",
    "url_selectors": "url",
    "image_selectors": "image",
    "text_selectors": "text",
    "date_selectors": "date",
    "next_page_link": "next",
}
REQUIRED = tuple(FILE_FIELDS.values())

# The rules in use for both languages of the site.
SITE_RULES = {
    "card_selectors": "article.elementor-post",
    "title_selectors": ["h3.elementor-post__title > a", ".elementor-post__title > a"],
    "url_selectors": [
        "h3.elementor-post__title > a@href",
        ".elementor-post__read-more@href",
        "a.elementor-post__thumbnail__link@href",
    ],
    "image_selectors": [
        ".elementor-post__thumbnail img@data-src",
        ".elementor-post__thumbnail img@srcset",
        ".elementor-post__thumbnail img@src",
    ],
    "date_selectors": ["span.elementor-post-date", ".elementor-post__meta-data span"],
    "text_selectors": [".elementor-post__excerpt p", ".elementor-post__excerpt"],
    "next_page_link": [
        "nav.elementor-pagination a.page-numbers.next@href",
        "a.page-numbers.next@href",
    ],
}


def rule_rows(lang: str, rules: Mapping) -> list[tuple]:
    """Rows of one language. ``css@attr`` splits in two; more than one ``@`` has
    no meaning, such a rule stays whole, with no attribute, and is never used."""
    rows = []
    for key, field in FILE_FIELDS.items():
        entries = rules.get(key) or []
        for i, entry in enumerate([entries] if isinstance(entries, str) else entries):
            css, at, attr = entry.partition("@") if field != "card" else (entry, "", "")
            if "@" in attr:
                css, attr = entry, ""
            rows.append((lang, field, i, css, attr if at else None))
    return rows


def rules_frame(spark: SparkSession, by_lang: Mapping[str, Mapping]) -> DataFrame:
    rows = [r for lang, rules in by_lang.items() for r in rule_rows(lang, rules)]
    return local_table(spark, rows, schema.RULES)


def read_rules(spark: SparkSession, files: Mapping[str, str], base: str = "configs") -> DataFrame:
    """Rules from one YAML file per language, on any storage Spark can read.

    A relative path that does not exist is looked up below ``base``.
    """
    import yaml  # optional: only YAML rule files need it

    def load(path):
        is_absolute = path.startswith("/") or "://" in path
        tries = [path] if is_absolute else [path, f"{base}/{path}"]
        for at in tries:
            parent, _, name = at.rpartition("/")
            if folder(spark, parent or ".").has(name):
                return yaml.safe_load(spark.read.text(at, wholetext=True).first()[0]) or {}
        raise FileNotFoundError(f"rule file not found: {path} (tried: {', '.join(tries)})")

    return rules_frame(spark, {lang: load(path) for lang, path in files.items()})


def _given(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def rule_violations(languages: DataFrame, rules: DataFrame) -> DataFrame:
    """(lang, field) pairs that have no rule although one is required."""
    wanted = languages.select("lang").distinct().select(
        "lang", F.explode(F.array(*map(F.lit, REQUIRED))).alias("field"))
    present = rules.where(_given(F.col("css"))).select("lang", "field").distinct()
    return wanted.join(present, ["lang", "field"], "left_anti")


def language_violations(languages: DataFrame) -> DataFrame:
    """(lang, problem) for every broken row of the language table."""
    checks = {
        "no_name": ~_given(F.col("lang")),
        "no_base_url": ~_given(F.col("base_url")),
        "no_selectors_file": ~_given(F.col("selectors_file")),
        "no_accept_language": ~_given(F.col("accept_language")),
        "bad_max_pages": F.coalesce(F.col("max_pages"), F.lit(0)) <= 0,
    }
    found = F.array_compact(F.array(*[F.when(bad, F.lit(p)) for p, bad in checks.items()]))
    rows = languages.select("lang", F.explode(found).alias("problem"))
    twice = (languages.where(_given(F.col("lang"))).groupBy("lang").count().where("count > 1")
             .select("lang", F.lit("duplicate").alias("problem")))
    return rows.unionByName(twice)


def no_languages(languages: DataFrame) -> bool:
    return languages.isEmpty()
