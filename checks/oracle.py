"""SQL for the registered queries, as DuckDB runs it on the same tables."""

from __future__ import annotations

from checks import derived as d
from tidings.sources.rules import REQUIRED

SQL: dict[str, str] = {}

SPACES = r"[\s\x0B\x{85}\p{Z}]+"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACES}|{SPACES}$', '', 'g')"


def unsymbol(x: str) -> str:
    return rf"regexp_replace({x}, '^[^\x00-\x1F\x21-\x7Fа-яА-Я]+', '')"


def tidy(x: str) -> str:
    return trim(rf"regexp_replace(replace({x}, chr(160), ' '), '[\t\n\f\r ]+', ' ', 'g')")


def decode(x: str) -> str:
    for ref, shown in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&copy;", "chr(169)"),
                       ("&middot;", "chr(183)"), ("&amp;", "'&'")):
        # These count without the semicolon, too.
        x = f"regexp_replace({x}, '{ref}?', {shown}, 'g')"
    return x


def text_of(x: str) -> str:
    hidden = "|".join(f"<{t}[^>]*>.*?</{t}>" for t in ("script", "style", "nav", "footer"))
    x = f"regexp_replace({x}, '<!--.*?-->|{hidden}', '', 'gs')"
    return decode(f"regexp_replace({x}, '<[a-zA-Z/!][^>]*>', '', 'g')")


def utf16_hash(x: str) -> str:
    """SHA-256 over UTF-16LE code units, built from code points."""
    unit = "printf('%02x%02x', {0} % 256, {0} // 256)"
    code = "unicode(c)"
    high = f"(55296 + ({code} - 65536) // 1024)"
    low = f"(56320 + ({code} - 65536) % 1024)"
    chars = (f"case when {code} < 65536 then {unit.format(code)} "
             f"else {unit.format(high)} || {unit.format(low)} end")
    listed = f"list_transform(list_filter(string_split({x}, ''), lambda c: c <> ''), lambda c: {chars})"
    return f"upper(sha256(unhex(array_to_string({listed}, ''))))"


def content_hash(seq: str, day: str, title: str, text: str, image: str = "''") -> str:
    parts = [f"cast({seq} as varchar)", f"strftime({day}, '%Y-%m-%d')", title, text]
    return " || ".join([*map(utf16_hash, parts), f"upper(sha256({image}))"])


def preview(x: str, n: int) -> str:
    """Longest prefix of at most n bytes, cut at its last space."""
    fits = f"list_filter(range(greatest({n} // 4, 1), least(length(x), {n}) + 1), lambda i: strlen(left(x, i)) <= {n})"
    return f"""(select case when strlen(x) <= {n} then x
        when regexp_matches(h, '(?s)^. *.* ') and regexp_extract(h, '(?s)^(.+) ', 1) <> ''
        then regexp_extract(h, '(?s)^(.+) ', 1) || '…' else h || '…' end
        from (select x, left(x, coalesce(list_max({fits}), 0)) as h from (select {x} as x)))"""


def values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)


# --- Pages ------------------------------------------------------------------

BODY = r"regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)"
H1 = r"regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"
HOST = r"split_part(regexp_extract({0}, '^[a-z]+://([^/?#]*)', 1), '@', -1)"
TITLE, TEXT = trim(text_of(H1)), tidy(text_of(BODY))

SQL["clean_html"] = f"select page_id, {tidy(text_of('html'))} as text from pages"
SQL["clean_html_tree"] = SQL["clean_html"]
SQL["detail_page"] = f"select page_id, {TITLE} as title, '' as image_url, {TEXT} as text from pages"
SQL["detail_page_pattern"] = SQL["detail_page"]
SQL["articles"] = f"""
with a as materialized (
  select page_id, split_part({trim('url')}, '#', 1) as url, {HOST.format('url')} as host,
    {TITLE} as title, {TEXT} as text from pages)
select page_id, url, host, title, '' as image_url, text, {preview('text', 350)} as preview,
  {content_hash('page_id', f"date '{d.RUN_DATE}'", 'title', 'text')} as check_sum from a"""

BLOCK = r"""case page_id % 4
  when 0 then '<DIV class=''x''> <h3>ПОХОЖИЕ</h3> новости <i><br></i></DIV>'
  when 1 then '<section id="v">Видео дня<b></b></section>'
  when 2 then '<aside>Новое видео, похожие темы<br><br></aside>'
  else '<div>Разное Похожие</div>' end"""


# Blocks of the first three kinds go, the last kind has no heading and stays.
SQL["strip_blocks"] = f"""
select page_id, case when page_id % 4 = 3 then b || '<hr>' || html || b else '<hr>' || html end as html
from (select page_id, html, {BLOCK} as b from pages)"""

LINK = r"""regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', {0})"""
NAV = rf"""
items as (
  select page_id, unnest(range(len({LINK.format(1)}))) + 1 as pos,
    unnest({LINK.format(1)}) as href, unnest({LINK.format(2)}) as label from pages
  where len({LINK.format(1)}) > 0),
raw as (
  select page_id, pos, {trim(decode('label'))} as title, {decode('href')} as url,
    coalesce(case when regexp_matches(href, '^/[to]') then {decode('href')} end, '') as image,
    case when contains({decode('href')}, 'e') then {trim(decode('label'))} else '' end as text,
    case when contains({decode('href')}, 'n') then {decode('href')} else '' end as date_raw
  from items
  union all
  select page_id, 1 + (select count(*) from items i where i.page_id = p.page_id), {TITLE}, '', '', '', '' from pages p
  union all
  select page_id, 2 + (select count(*) from items i where i.page_id = p.page_id), '', '', '', '', '' from pages p),
judged as (
  select page_id, cast(pos as int) as pos, {unsymbol('title')} as title,
    split_part({trim('url')}, '#', 1) as url, split_part({trim('image')}, '#', 1) as thumbnail_url,
    image = '' as no_thumb, text, date_raw,
    case when title = '' then 'no_title' when url = '' then 'no_url'
      when text = '' and {unsymbol('title')} = '' then 'no_text_title'
      when date_raw = '' then 'no_date' end as reason from raw),
numbered as (
  select * replace (case when text = '' then title else text end as text),
    cast(pos + coalesce(sum(cast(reason is null as int)) over (
      partition by page_id order by pos rows between unbounded preceding and 1 preceding), 0) as int) as seq
  from judged)"""

SQL["listing_cards"] = f"""
with {NAV} select page_id, seq, pos, title, url, thumbnail_url, text, date_raw
from numbered where reason is null"""
SQL["listing_issues"] = f"""
with {NAV}
select page_id, seq, pos, title, url, text, date_raw, reason, false as stored from numbered
where reason is not null
union all
select page_id, seq, pos, title, url, text, date_raw, 'no_thumb', reason is null from numbered
where no_thumb and coalesce(reason, '') not in ('no_title', 'no_url')"""
SQL["listing_cards_pattern"] = rf"""
with {NAV.replace("coalesce(case when regexp_matches(href, '^/[to]')", "coalesce(case when false")
      .replace("case when contains(" + decode('href') + ", 'e')", "case when false")}
select page_id, seq, pos, title, url, thumbnail_url, text, date_raw from numbered where reason is null"""
SQL["next_link"] = rf"""
select page_id, split_part({trim(decode(
    "coalesce(list_filter(" + LINK.format(1) + ", lambda h: contains(h, 'th'))[1], '')"))}, '#', 1) as next_link
from pages"""
SQL["incremental_next_link"] = SQL["next_link"]
SQL["image_srcset"] = """
select page_id, case page_id % 3 when 0 then url when 1 then url else 'data:a 1x,data:b 2x' end as image,
  case page_id % 3 when 0 then 'data:image/gif 1x, ' || url || ' 2x'
    when 1 then ' ' || url || '  320w,' || url || '?b 640w' else 'data:a 1x,data:b 2x' end as plain
from pages"""
SQL["fallback_list"] = r"""
select page_id, coalesce(nullif(regexp_extract(url, '\?([^#]*)', 1), ''), nullif(regexp_extract(url, '#(.*)$', 1), ''),
  regexp_extract(url, '//[^/]*(/[^?#]*)', 1)) as value from pages"""
SQL["normalize_url"] = f"""
select page_id, split_part({trim("'  ' || chr(10) || url || chr(9) || ' '")}, '#', 1) as url from pages"""
SQL["url_host"] = f"""
select page_id, {HOST.format("case when page_id % 2 = 0 then replace(url, '.example', '@a.example:8080') else url end")}
  as host from pages"""
SQL["latest_fetch"] = f"""
with fetched as (
  select split_part(split_part(url, '?', 1), '#', 1) as url, page_id, n * 60 + page_id * 7 as fetched_s
  from (select url, page_id, unnest(range(page_id % 3 + 1)) as n from pages))
select url, arg_max(page_id, (fetched_s, page_id)) as page_id, max(fetched_s) as fetched_s from fetched group by url"""

# --- Texts and dates ----------------------------------------------------------

LEAD = """case doc_id % 5 when 0 then chr(128512) || chr(129535) || ' ' when 1 then ' «Ё' when 2 then ''
  when 3 then '→  Ү' else 'Яё' end"""
SQL["strip_symbols"] = f"select doc_id, {unsymbol(f'{LEAD} || text')} as text from documents"
SQL["tidy_space"] = f"""
select doc_id, {tidy("chr(160) || replace(replace(text, 'e ', 'e' || chr(160) || ' '), 'a ', ' a' || chr(9) || chr(10) || ' ') || chr(133)")}
  as text from documents"""
SQL["preview"] = f"""
select doc_id, {preview('text', 350)} as preview, {preview("replace(text, ' ', 'é')", 97)} as unspaced
from documents"""
SQL["checksum_text"] = f"""
select doc_id, {utf16_hash('text')} as text_hash, upper(sha256(text)) as bytes_hash from documents"""
SQL["content_checksum"] = f"""
select doc_id, {content_hash('doc_id', f"(date '{d.RUN_DATE}' - cast(doc_id % 1000 as int))",
                             "split_part(text, '.', 1)", 'text', 'source')} as check_sum from documents"""

# What was written for an order, read back: with its year, or in the run's year.
OWN = "cast(o_orderdate as date)"
THIS_YEAR = (f"cast(make_date({d.RUN_DATE[:4]}, month(o_orderdate), 1) + cast(day(o_orderdate) - 1 as int) as date)")
SQL["date_ru"] = f"""
select o_orderkey, case when o_orderkey % 5 <= 2 then {OWN} else {THIS_YEAR} end as dt,
  case when o_orderkey % 5 <= 2 then {OWN} end as strict_dt from orders"""
SQL["date_ky"] = f"""
select o_orderkey, case when o_orderkey % 2 = 1 and o_orderkey % 3 = 0 then null
    when o_orderkey % 5 <= 2 then {OWN} else {THIS_YEAR} end as dt,
  case when o_orderkey % 5 <= 2 then {OWN} end as strict_dt from orders"""
SQL["date_relative"] = f"""
select o_orderkey,
  case o_orderkey % 6 when 0 then {OWN} when 1 then {OWN} - 1 when 2 then {OWN} when 3 then {OWN} - 1
    when 5 then date '2020-01-01' end as ru,
  case o_orderkey % 6 when 3 then date '2020-05-05' when 4 then {OWN} when 5 then {OWN} - 1 end as ky
from orders"""
SQL["calendar_day"] = """
select o_orderkey, case when o_orderkey % 14 between 1 and 12 and o_orderkey % 33 between 1 and 31
  then make_date(o_orderkey % 4 + 2021, o_orderkey % 14, 1) + cast(o_orderkey % 33 - 1 as int) end as dt,
  try_cast(split_part(o_orderpriority, '-', 1) as int) as priority from orders"""

# --- Cards of the documents ---------------------------------------------------

CARDS = f"""
placed as (select *, row_number() over (partition by lang order by doc_id) - 1 as rn from documents),
cards as (
  select doc_id, lang, cast(list_position({d.LANGS}, lang) as int) as lang_ord,
    cast(rn // 10 + 1 as int) as page_num, cast(rn % 10 + 1 as int) as pos, cast(rn % 10 * 2 + 1 as int) as seq,
    'https://example.org/a/' || (doc_id // 3) as url, {trim("split_part(text, '.', 1)")} as title, text,
    '' as thumbnail_url,
    case when doc_id % 97 <> 0 then date '{d.RUN_DATE}' - cast((doc_id // 5) % 36500 as int) end as dt
  from placed),
articles as materialized (
  select lang, lang_ord, page_num, pos, dt, title, text, url, thumbnail_url, seq as sequence_num,
    {content_hash('seq', 'dt', 'title', 'text')} as check_sum from cards),
langs as (select * from (values {values((g, i + 1) for i, g in enumerate(d.LANGS))}) t(lang, lang_ord)),
dim as (select * from (values {values(d.UIDS)}) t(language_uid, lang)),
loaded as (select * from (values {values(d.LOADED.items())}) t(lang, until))"""
LAST = ", ".join(f"arg_max({n}, (lang_ord, page_num, pos)) as {n}"
                 for n in ("sequence_num", "dt", "title", "text"))


def deduped(source: str) -> str:
    return f"""(select arg_min(language_uid, (lang_ord, page_num, pos)) as language_uid, {LAST}, url,
      arg_max(thumbnail_url, (lang_ord, page_num, pos)) as thumbnail_url,
      arg_max(check_sum, (lang_ord, page_num, pos)) as check_sum from {source} group by url)"""


KNOWN = f"""{CARDS},
known as materialized {deduped("(select * from articles join dim using (lang) join loaded using (lang) where dt <= cast(until as date))")},
latest as (
  select lang, case when language_uid is not null then coalesce(m, date '{d.RUN_DATE}' - interval 1 year) end as latest
  from langs left join dim using (lang) left join (select language_uid, max(dt) as m from known group by all) using (language_uid)),
marks as (
  select lang, cast(greatest(date '{d.RUN_DATE}' - {d.DAYS_BACK}, latest) as date) as mark from latest)"""
BATCH = f"""{KNOWN},
batch as materialized {deduped("(select * from articles join marks using (lang) join dim using (lang) where dt >= mark)")}"""
COLUMNS = "language_uid, sequence_num, dt, title, text, url, thumbnail_url, check_sum"

SQL["high_water_mark"] = f"with {KNOWN} select lang, mark from marks"
SQL["latest_dates"] = f"with {KNOWN} select lang, cast(latest as date) as latest from latest"
SQL["card_counts"] = f"""
with {KNOWN} select lang, coalesce(n, 0) as n from langs join dim using (lang)
left join (select language_uid, count(*) as n from known group by all) using (language_uid)"""
SQL["known_urls"] = f"""
with {KNOWN} select url, exists (select 1 from known k where k.url = c.url) as known
from (select distinct url from cards) c"""
SQL["table_marks"], SQL["table_counts"], SQL["table_known_urls"] = SQL["high_water_mark"], SQL["card_counts"], SQL["known_urls"]
SQL["stored_urls"] = f"with {KNOWN} select distinct url from cards where url in (select url from known)"
SQL["unseen_urls"] = f"with {KNOWN} select distinct url from cards where url not in (select url from known)"
SQL["new_cards"] = f"""
with {KNOWN} select page_num, pos, lang, dt, title, text, url, thumbnail_url, sequence_num, check_sum
from articles join marks using (lang) where dt >= mark"""
SQL["late_cards"] = f"""
with {KNOWN} select lang, count(*) as late from cards join marks using (lang) where dt < mark group by lang"""
SQL["stream_late_cards"] = f"""
with {KNOWN} select lang, page_num, count(*) as late from cards join marks using (lang) where dt < mark
group by all"""
SQL["lang_join"] = f"with {CARDS} select doc_id, lang, language_uid from cards join dim using (lang)"
SQL["lang_rejects"] = f"with {CARDS} select doc_id, lang from cards where lang not in (select lang from dim)"

TOUCHED = """(select * replace (case when right(url, 1) = '7' then title || '!' else title end as title) from known)"""
SQL["checksum_audit"] = f"""
with {KNOWN} select url, sequence_num, dt from {TOUCHED}
where check_sum <> {content_hash('sequence_num', 'dt', 'title', 'text')}"""
SQL["checksum_refresh"] = f"""
with {KNOWN}, now as (select url, check_sum as old, {content_hash('sequence_num', 'dt', 'title', 'text')} as check_sum
  from {TOUCHED})
select url, check_sum, old <> check_sum as changed from now"""


def stop_rule(cards: str, limit: str, stop_after: int) -> str:
    """Page counts, streaks and reasons over card rows (lang, page_num, dt)."""
    return f"""
pages_of as (
  select lang, page_num, count(*) as cards, count(*) filter (dt < mark) as old,
    page_num < max(page_num) over (partition by lang) as has_next
  from {cards} join marks using (lang) group by lang, page_num),
limited as (select *, old = cards as all_old from pages_of where {limit}),
islands as (select *, sum(cast(not all_old as int)) over (partition by lang order by page_num) as island from limited),
streaks as (select *, cast(sum(cast(all_old as int)) over (partition by lang, island order by page_num) as int) as streak
  from islands),
reasons as (select *, case when streak >= {stop_after} then 'old_streak' when not has_next then 'no_next' end as reason
  from streaks),
stopped as (select lang, min(page_num) as stop_page, arg_min(reason, page_num) as reason from reasons
  where reason is not null group by lang),
totals as (
  select lang, count(*) as total_pages, sum(cards) as total_cards, sum(old) as old_cards,
    arg_max(streak, page_num) as streak, max(page_num) as last_page
  from reasons left join stopped using (lang) where stop_page is null or page_num <= stop_page group by lang)"""


def stats(langs: str, max_pages: int) -> str:
    return f"""
select lang, coalesce(total_pages, 0) as total_pages, cast(coalesce(total_cards, 0) as bigint) as total_cards,
  cast(coalesce(old_cards, 0) as bigint) as old_cards, cast(coalesce(streak, 0) as bigint) as consecutive_old_pages,
  coalesce(reason, case when last_page >= {max_pages} then 'max_pages' end) as stopped_reason
from {langs} left join totals using (lang) left join stopped using (lang)"""


RULE = f"with {KNOWN}, {stop_rule('cards', 'true', d.STOP_AFTER)}"
SQL["page_stats"] = f"{RULE} select lang, page_num, cards, old, all_old from limited"
SQL["old_streak"] = f"{RULE} select lang, page_num, streak from streaks"
SQL["stop_page"] = f"{RULE} select * from stopped"
SQL["run_stats"] = f"{RULE} {stats('langs', 1_000_000_000)}"
SQL["run_stats_max_pages"] = (
    f"with {KNOWN}, {stop_rule('cards', 'page_num <= 5', d.STOP_AFTER)} {stats('langs', 5)}")

SQL["page_chain"] = r"""
with recursive starts as (
  select regexp_extract(url, '//[^/]*/([a-z]+)/', 1) as lang, arg_min(url, page_id) as base_url
  from pages group by 1),
linked as (
  select lang, p.url, coalesce(n.url, case when lang in ('de', 'en') then '' else 'https://gone.example/' end) as next_link
  from pages p left join pages n on n.page_id = p.page_id + 1 cross join (select lang from starts) s),
walk as (
  select lang, 1 as page_num, base_url as url, coalesce(next_link, '') as next_link, next_link is not null as fetched
  from starts s left join linked l using (lang) where l.url = base_url
  union all
  select w.lang, page_num + 1, w.next_link, coalesce(l.next_link, ''), l.next_link is not null
  from walk w left join linked l on l.lang = w.lang and l.url = w.next_link
  where w.next_link <> '')
select * from walk"""

# --- Merge --------------------------------------------------------------------

UPSERT = """
select case when k.url is null then b.language_uid else k.language_uid end as language_uid,
  case when b.url is null then k.sequence_num else b.sequence_num end as sequence_num,
  case when b.url is null then k.dt else b.dt end as dt,
  case when b.url is null then k.title else b.title end as title,
  case when b.url is null then k.text else b.text end as text,
  coalesce(k.url, b.url) as url,
  case when b.url is null then k.thumbnail_url else b.thumbnail_url end as thumbnail_url,
  case when b.url is null then k.check_sum else b.check_sum end as check_sum,
  case when b.url is null then 'kept' when k.url is null then 'new'
    when k.check_sum = b.check_sum and k.thumbnail_url = b.thumbnail_url then 'unchanged' else 'updated' end as status
from known k full join batch b on k.url = b.url"""
SQL["batch_dedupe"] = f"with {BATCH} select {COLUMNS} from batch"
SQL["upsert"] = SQL["upsert_wide"] = SQL["upsert_small"] = f"with {BATCH} {UPSERT}"
SQL["merge_counts"] = f"with {BATCH} select status, count(*) as n from ({UPSERT}) group by status"
SQL["news_snapshots"] = f"with {BATCH} select {COLUMNS} from ({UPSERT})"

STREAMED = f"""
streamed as materialized (
  select 1 as lang_ord, doc_id as page_num, 0 as pos, language_uid, cast(doc_id as int) as sequence_num, dt, title, text, url,
    thumbnail_url, {content_hash('doc_id', 'dt', 'title', 'text')} as check_sum
  from cards join marks using (lang) join dim using (lang) where dt >= mark),
batch as materialized {deduped('streamed')}"""
SQL["stream_upsert"] = f"with {KNOWN}, {STREAMED} select {COLUMNS} from ({UPSERT})"

LATEST = ", ".join(f"arg_max({n}, (page_id, pos)) as {n}" for n in ("title", "text", "thumbnail_url", "dt"))
SQL["stream_pages"] = f"""
with {NAV},
dated as (select *, date '{d.RUN_DATE}' - cast((page_id // 5) % 36500 as int) as dt from numbered where reason is null),
merged as (select 1 as language_uid, arg_max(seq, (page_id, pos)) as sequence_num, {LATEST}, url
  from dated where dt >= date '{d.RUN_DATE}' - {d.DAYS_BACK} group by url)
select *, {content_hash('sequence_num', 'dt', 'title', 'text')} as check_sum from merged"""

# --- Rules --------------------------------------------------------------------

SQL["rule_violations"] = f"""
with rules as (select source || '-' || lang as lang, ({list(REQUIRED)})[doc_id % 7 + 1] as field,
  case when n_chars > 1000 then text end as css from documents)
select lang, field from (select distinct lang, unnest({list(REQUIRED)}) as field from rules) w
where not exists (select 1 from rules r where r.lang = w.lang and r.field = w.field and coalesce(r.css, '') <> '')"""
SQL["language_violations"] = """
with rows as (select case when c_custkey % 50 <> 0 then 'c' || cast(floor(c_custkey * 0.99) as bigint) end as lang,
  c_acctbal, c_nationkey from customer)
select lang, 'no_name' as problem from rows where lang is null
union all select lang, 'no_base_url' from rows where c_acctbal <= 0
union all select lang, 'no_accept_language' from rows where c_nationkey = 3
union all select lang, 'bad_max_pages' from rows where c_nationkey - 2 <= 0
union all select lang, 'duplicate' from rows where lang is not null group by lang having count(*) > 1"""

# --- Whole runs ---------------------------------------------------------------

NAMES = values(d.SITE_LANGS.items())


def site(limit: int) -> str:
    """The site's cards and the run over them, with so many pages at most."""
    return f"""{CARDS.replace('articles as materialized', 'plain as materialized')
           .replace(values(d.UIDS), "(1, 'ru'), (2, 'kg')")},
names as (select * from (values {NAMES}) t(lang, code)),
articles as (select * replace (code as lang) from plain join names using (lang)),
site_loaded as (select code as lang, until from loaded join names using (lang)),
known as materialized {deduped("(select * from articles join dim using (lang) join site_loaded using (lang) where dt <= cast(until as date))")},
marks as (
  select code as lang, cast(greatest(date '{d.RUN_DATE}' - {d.DAYS_BACK}, case when language_uid is not null
    then coalesce(m, date '{d.RUN_DATE}' - interval 1 year) end) as date) as mark
  from names left join dim on dim.lang = code
  left join (select language_uid, max(dt) as m from known group by all) using (language_uid)),
checked as (
  select code as lang, lang_ord, page_num, pos, {trim(unsymbol('title'))} as title, text as whole,
    case when doc_id % 17 <> 0 then url else '' end as url,
    case when doc_id % 13 <> 0 then url || '.jpg' else '' end as thumbnail_url,
    case when code in ('ru', 'kg') then dt end as dt,
    case when title = '' then 'no_title' when doc_id % 17 = 0 then 'no_url'
      when {trim('text')} = '' and {unsymbol('title')} = '' then 'no_text_title'
      when doc_id % 194 = 0 then 'no_date' end as reason
  from cards join names using (lang)),
seen as (
  select * exclude (whole, title), {unsymbol('title')} as title,
    case when {trim('whole')} = '' then title else {trim('whole')} end as text,
    cast(pos + coalesce(sum(cast(reason is null as int)) over (partition by lang, page_num order by pos
      rows between unbounded preceding and 1 preceding), 0) as int) as seq from checked),
{stop_rule('(select * from seen where reason is null)', f'page_num <= {limit}', d.STOP_AFTER)},
visited as (select seen.* from seen left join stopped using (lang)
  where page_num <= coalesce(stop_page, {limit})),
batch as materialized {deduped(f"(select lang_ord, page_num, pos, language_uid, seq as sequence_num, dt, title, text, url, thumbnail_url, "
                               f"{content_hash('seq', 'dt', 'title', 'text')} as check_sum "
                               "from visited join marks using (lang) join dim using (lang) where reason is null and dt >= mark)")}"""


SQL["news_run"] = f"with {site(d.UNBOUND)} {UPSERT}"
SQL["news_run_max_pages"] = f"with {site(d.MAX_PAGES)} {UPSERT}"
SQL["news_run_stats"] = f"with {site(d.UNBOUND)} {stats('(select code as lang from names)', d.UNBOUND)}"
SQL["news_run_issues"] = f"""
with {site(d.UNBOUND)},
issues as (
  select lang, page_num, reason, false as stored, seq from visited where reason is not null
  union all
  select lang, page_num, 'no_thumb', reason is null, seq from visited
  where thumbnail_url = '' and coalesce(reason, '') not in ('no_title', 'no_url'))
select lang, page_num, reason, stored, count(*) as n, cast(sum(seq) as bigint) as seq_sum from issues group by all"""
SQL["news_run_rejects"] = f"""
with {site(d.UNBOUND)},
rejects as (
  select lang, page_num, 'bad_date' as reason, seq from visited where reason is null and dt is null
  union all
  select lang, page_num, 'unknown_language', seq from visited join marks using (lang)
  where reason is null and dt >= mark and lang not in (select lang from dim))
select lang, page_num, reason, count(*) as n, cast(sum(seq) as bigint) as seq_sum from rejects group by all"""
SQL["page_archive"] = r"""
select url, regexp_extract(url, '//[^/]*/([a-z]+)/', 1) as lang, cast(page_id as int) as page_num, 200 as status, html
from pages"""
