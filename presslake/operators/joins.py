"""Joins between articles, pages, sources and lexicons.

No side is broadcast by hint: tables that grow (seen URLs, pages, logs) are
left to the optimizer, which broadcasts below its size limit and otherwise
shuffles and splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.functions import lexicons as lex
from presslake.functions.match import NOT_WORD, WHOLE_WORD, WORD, TermScanner, bind
from presslake.operators.shape import compute_once
from presslake.session import scratch_dir


def drop_seen(items: DataFrame, seen: DataFrame, fresh: bool = False, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Items whose URL (within `keys`) is not in `seen`; all of them in a fresh run."""
    if fresh:
        return items
    return items.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def drop_stored(
    items: DataFrame, meta: DataFrame, content: DataFrame, keys: Sequence[str] = ("article_id",)
) -> DataFrame:
    """Items not stored yet; an article counts as stored when its metadata and content both exist."""
    keys = list(keys)
    pairs = meta.select(*keys).join(content.select(*keys), keys, "left_semi")
    return items.join(pairs, keys, "left_anti")


def pending_sources(sources: DataFrame, log: DataFrame, fresh: bool = False) -> DataFrame:
    if fresh:
        return sources
    return sources.join(log.select("source_url").distinct(), "source_url", "left_anti")


def attach_content(items: DataFrame, pages: DataFrame, on: str = "url") -> DataFrame:
    """Items with their page's html; items without one are dropped.

    Each page URL occurs once, unless `pages` has a column `fetched_at`: then the latest fetch is taken (a fetch
    without a time counts as the oldest), of several at the same time the one with the smallest digest.
    """
    if "fetched_at" in pages.columns:
        latest = F.row_number().over(Window.partitionBy(on).orderBy(F.col("fetched_at").desc_nulls_last(), F.md5("html")))
        # Each task keeps one fetch of a URL before the shuffle.
        pages = pages.withColumn("_fetch", latest).where("_fetch = 1")
    columns = [c for c in pages.columns if c in (on, "html")]
    return items.join(pages.select(*columns), on, "inner")


def with_content(meta: DataFrame, content: DataFrame, keys: Sequence[str] = ("article_id",)) -> DataFrame:
    return meta.join(content, list(keys), "inner")


def orphans(meta: DataFrame, content: DataFrame, key: str = "article_id") -> DataFrame:
    """Ids with only one half stored, and which half is missing."""
    no_content = meta.join(content, key, "left_anti").select(key, F.lit("content").alias("missing"))
    no_meta = content.join(meta, key, "left_anti").select(key, F.lit("metadata").alias("missing"))
    return no_content.unionByName(no_meta)


def with_region(df: DataFrame, sources: DataFrame, on: str = "source") -> DataFrame:
    """Rows with their source's region; sources without an entry are Global."""
    region = sources.select(on, "region")
    return df.join(region, on, "left").withColumn("region", F.coalesce("region", F.lit("Global")))


def explode_matches(
    df: DataFrame, lexicon: DataFrame, key: str, text: str, block: int = 2_000
) -> DataFrame:
    """One row per text and whole-word lexicon term in it, with the lexicon's columns.

    `lexicon` has a column `term`, each term once in lower case. Up to `block` terms are compiled
    into one scan of the texts; a larger lexicon stays a table, see `join_matches`. Both give the same rows.
    """
    # A lexicon may be costly itself; it is read several times below.
    staged = scratch_dir(df.sparkSession, "lexicon")
    lexicon.write.parquet(staged)
    lexicon = df.sparkSession.read.schema(lexicon.schema).parquet(staged)
    rows = lexicon.limit(block + 1).collect()
    if len(rows) <= block:
        return _scan_matches(df, rows, lexicon, key, text)
    return join_matches(df, lexicon, key, text)


#: Up to so many bytes of terms are broadcast; beyond, both sides are shuffled.
BROADCAST_BYTES = 32 << 20
#: Up to so many terms of rare lengths are looked for in a scan of the texts.
SCANNED_TERMS = 256
#: Parts a term's texts are spread over in a shuffled join.
TERM_SALTS = 8


def join_matches(df: DataFrame, lexicon: DataFrame, key: str, text: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`explode_matches` for lexicons of any size: texts and terms meet in a hash join.

    A text is a sequence of tokens: words, and single characters of other kinds. A whole-word
    term is a run of tokens, so each text is cut, in one pass per length that the lexicon has, into all
    runs of that length that may be a term; each run comes once per text and joins the terms as a table. The driver
    learns only the lengths. A word that is in most texts would bring all of them to one task: in a shuffled
    join its texts are spread over `TERM_SALTS` parts, each with its own copy of the terms.
    """
    low_term = F.lower("term")
    tokens = F.size(F.regexp_extract_all(low_term, F.lit(f"{WORD}+|{NOT_WORD}"), F.lit(0)))
    terms = lexicon.where("term <> ''").withColumn("run", low_term)
    shapes = terms.select(
        tokens.alias("tokens"), F.col("run").rlike(f"^{WORD}").alias("first"), F.col("run").rlike(f"{WORD}$").alias("last"),
        F.octet_length("run").alias("bytes"),
    )
    # At most four rows per length.
    sizes = [F.sum(F.col("bytes") + 64).alias("bytes"), F.count(F.lit(1)).alias("terms")]
    shapes = sorted(shapes.groupBy("tokens", "first", "last").agg(*sizes).collect(), key=lambda s: s["terms"])
    if not shapes:
        return _no_matches(df, lexicon, key)
    # Cutting texts into runs of a shape pays for many terms only. Of the rare shapes the terms are looked for in one scan.
    scanned = []
    while len(shapes) > 1 and sum(s["terms"] for s in scanned) + shapes[0]["terms"] <= SCANNED_TERMS:
        scanned.append(shapes.pop(0))
    found = _no_matches(df, lexicon, key)
    if scanned:
        rare = reduce(Column.__or__, [(tokens == s["tokens"]) & (F.col("run").rlike(f"^{WORD}") == s["first"]) & (F.col("run").rlike(f"{WORD}$") == s["last"]) for s in scanned])
        found = _scan_matches(df, terms.where(rare).select(*lexicon.columns).collect(), lexicon, key, text)
        terms = terms.where(~rare)
    patterns = [_run_pattern(s["tokens"], s["first"], s["last"]) for s in shapes]
    low = F.lower(F.coalesce(text, F.lit("")))
    runs = bind(low, lambda t: F.array_distinct(F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in patterns))))
    each = df.select(key, F.explode(runs).alias("run"))
    if sum(s["bytes"] for s in shapes) <= broadcast_bytes:
        return each.join(F.broadcast(terms), "run").select(key, *lexicon.columns).unionByName(found)
    each = each.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(TERM_SALTS)).cast("int"))
    terms = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(TERM_SALTS - 1))))
    return each.join(terms.hint("merge"), ["run", "salt"]).select(key, *lexicon.columns).unionByName(found)


def _run_pattern(tokens: int, first: bool, last: bool) -> str:
    """All runs of `tokens` tokens, overlapping, that begin and end with a word or with another character.

    Next to a character that is no word, whole-word matching asks for a word outside the run.
    """
    word, other = f"{WORD}++", NOT_WORD
    if tokens == 1 and first:
        # Words do not overlap.
        return f"({word})"
    if tokens == 1:
        body = other
    else:
        body = (word if first else other) + f"(?:{word}|{other}){{{tokens - 2}}}" + (word if last else other)
    start = f"(?<!{WORD})" if first else f"(?<={WORD})"
    return f"{start}(?=({body}){'' if last else f'(?={WORD})'})"


def _scan_matches(df: DataFrame, rows: list, lexicon: DataFrame, key: str, text: str) -> DataFrame:
    terms = list(dict.fromkeys(row["term"] for row in rows if row["term"]))
    # The block's rows, bounded by its size, may be broadcast.
    listed = df.sparkSession.createDataFrame(rows, lexicon.schema)
    if not terms:
        return _no_matches(df, lexicon, key)
    scanner = TermScanner({t.lower(): WHOLE_WORD for t in terms})
    hits = scanner.hits(F.lower(F.coalesce(text, F.lit(""))))
    found = compute_once(df.select(key, text), hits=hits).where(F.size("hits") > 0)
    values = scanner.values(F.col("hits"), [(t, [t.lower()]) for t in terms])
    each = found.select(key, F.explode_outer(values).alias("term")).where(F.col("term").isNotNull())
    return each.join(F.broadcast(listed), "term").select(key, *lexicon.columns)


def _no_matches(df: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    return df.select(key, *(F.lit(None).cast(f.dataType).alias(f.name) for f in lexicon.schema)).limit(0)


def keyword_topics(
    df: DataFrame, keywords: str, topics: Mapping[str, Sequence[str]] = lex.TOPIC_TERMS
) -> DataFrame:
    """One row per matched keyword and topic that lists it."""
    spark = df.sparkSession
    rows = [(t.lower(), topic) for topic, terms in topics.items() for t in terms]
    table = spark.createDataFrame(rows, "keyword_low string, topic string")
    keep = [c for c in df.columns if c != keywords]
    exploded = df.select(*keep, F.explode_outer(F.array_distinct(keywords)).alias("keyword"))
    # The topic table holds as many rows as the lexicon argument has terms.
    return (
        exploded.withColumn("keyword_low", F.lower("keyword"))
        .join(F.broadcast(table), "keyword_low")
        .drop("keyword_low")
    )
