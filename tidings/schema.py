"""Column layouts shared by every job."""

from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("page_num", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("html", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("fetched_at", T.TimestampType()),
])

LANGUAGES = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("lang_ord", T.IntegerType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("max_pages", T.IntegerType()),
])

# The language table as configured, before it is checked.
LANGUAGE_ROWS = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("selectors_file", T.StringType()),
    T.StructField("accept_language", T.StringType()),
    T.StructField("max_pages", T.IntegerType()),
])

RULES = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("css", T.StringType()),
    T.StructField("attr", T.StringType()),
])

LANG_DIM = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("alias", T.StringType()),
])

NEWS = T.StructType([
    T.StructField("language_uid", T.IntegerType()),
    T.StructField("sequence_num", T.IntegerType()),
    T.StructField("dt", T.DateType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("thumbnail_url", T.StringType()),
    T.StructField("check_sum", T.StringType()),
])

# What the extraction job hands back for one page.
CARD = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("image_attr", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("date_raw", T.StringType()),
    T.StructField("html", T.StringType()),
])

LISTING = T.StructType([
    T.StructField("next_link", T.StringType()),
    T.StructField("cards", T.ArrayType(CARD)),
])

DETAIL = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("body_html", T.StringType()),
])
