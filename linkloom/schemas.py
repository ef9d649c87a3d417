"""Row types of the data model."""

from pyspark.sql import types as T

JOB = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("link_depth", T.IntegerType()),
        T.StructField("discovered_at", T.TimestampType()),
    ]
)

PARSED_PAGE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("links", T.ArrayType(T.StringType())),
        T.StructField("charset", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("body_text", T.StringType()),
    ]
)

PARSED_COLUMNS = [f.name for f in PARSED_PAGE.fields]

# Stored widths of the page table (fixed values).
PAGE_WIDTHS = {
    "page_url": 80,
    "title": 100,
    "author": 100,
    "keywords": 2048,
    "charset": 100,
    "description": 4000,
    "body_text": 100000,
}

# Stored width of a link target (fixed value).
LINK_TO_WIDTH = 100
