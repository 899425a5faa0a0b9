"""Article records: one column layout for all origins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions import text
from presslake.functions.dates import as_of_column
from presslake.functions.match import no_strings
from presslake.schemas import ARTICLES, TAGS


def tag_struct(continents: Column, **others: Column) -> Column:
    """The tag struct; tags an origin does not give are empty or NULL."""
    given = {"continents": continents, **others}
    fields = []
    for field in TAGS.fields:
        default = no_strings() if field.name in ("matched_keywords", "core_topics", "special_tags") else F.lit(None)
        fields.append(given.get(field.name, default).cast(field.dataType).alias(field.name))
    return F.struct(*fields)


def to_articles(
    df: DataFrame, origin: str, as_of: datetime, keep_date: bool = False, extra: tuple[str, ...] = ()
) -> DataFrame:
    """ARTICLES columns plus `content` (and `extra`), from rows with url, content, tags and what
    else there is. With `keep_date` the rows bring their own collection date."""
    stamp = as_of_column(as_of)
    computed = {
        "article_id": text.article_id(F.col("url")),
        "source": text.source_label(F.lit(origin)),
        "origin": F.lit(origin),
        "content_length": text.content_length(F.col("content")),
        "collection_ts": stamp,
        "collection_date": stamp.cast("date"),
    }
    if keep_date:
        del computed["collection_date"]
    columns = []
    for field in ARTICLES.fields:
        if field.name in computed:
            column = computed[field.name]
        elif field.name in df.columns:
            column = F.col(field.name)
        else:
            column = F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns, "content", *extra)
