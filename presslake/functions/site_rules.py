"""Extraction rules of single sites, as a table, with the generic rules behind them."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.functions import html as H
from presslake.functions import page_reader
from presslake.functions.page_reader import TextRule

#: A rule holds for its domain and all subdomains; of several the longest domain counts.
RULES = "domain string, selectors array<string>, drop array<string>, separator string, min_chars int"


@lru_cache(maxsize=4096)
def _compiled(selectors: tuple, drop: tuple, separator: str, min_chars: int) -> TextRule:
    # Without a selected element there is no text: the generic rules are asked then.
    return TextRule(selectors=selectors, drop=drop, separator=separator, min_chars=min_chars, fallback="none")


@F.pandas_udf(T.StringType())
def _ruled_text(html: pd.Series, rule: pd.DataFrame) -> pd.Series:
    out = []
    for page, selectors, drop, separator, min_chars in zip(html, rule["selectors"], rule["drop"], rule["separator"], rule["min_chars"]):
        text = None
        if page is not None and selectors is not None:
            compiled = _compiled(tuple(selectors), tuple(drop if drop is not None else ()), separator or "", int(min_chars or 0))
            text = page_reader.selected_text(page, compiled)
        out.append(text)
    return pd.Series(out, dtype=object)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def domains_of(host: Column) -> Column:
    """A host and all domains above it, the longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rules_of_hosts(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rule) for every host of `pages` with a rule. Works on the distinct hosts, not on the pages."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    each = hosts.select("host", F.posexplode(domains_of(F.col("host"))).alias("above", "domain"))
    rule = F.struct("selectors", "drop", "separator", "min_chars").alias("rule")
    # If a domain is there twice, any one of equal rules, else the first by its selectors.
    named = rules.select(F.lower("domain").alias("domain"), rule)
    met = each.join(named, "domain")
    best = F.row_number().over(Window.partitionBy("host").orderBy("above", "rule"))
    return met.withColumn("best", best).where("best = 1").select("host", "rule")


def extract_by_site(
    pages: DataFrame, rules: DataFrame, generic: TextRule = H.LEGISLATION_RULE, into: str = "content"
) -> DataFrame:
    """Adds the text of each page (url, html, and bill_xml and bill_html where bills are read) by its site's rule, else by
    `html.extract_content`, and `extractor`: `site`, or `generic`.

    Only pages of sites with a rule are read by the tag reader for it; a rule that finds nothing, or not more than its
    `min_chars`, leaves the page to the generic rules.
    """
    keyed = pages.withColumn("site_host", host_of(F.col("url")))
    ruled = rules_of_hosts(pages, rules).select(F.col("host").alias("site_host"), F.col("rule").alias("site_rule"))
    joined = keyed.join(ruled, "site_host", "left")
    empty = F.struct(*(F.lit(None).cast(k).alias(n) for n, k in (("selectors", "array<string>"), ("drop", "array<string>"), ("separator", "string"), ("min_chars", "int"))))
    text = _ruled_text(F.when(F.col("site_rule").isNotNull(), F.col("html")), F.coalesce("site_rule", empty))
    read = H.compute_once(joined, site_text=text)
    # What the site's rule has read is not read again.
    rest = read.withColumn("page_source", F.col("html")).withColumn("html", F.when(F.col("site_text").isNull(), F.col("html")))
    done = H.extract_content(rest, generic, "generic_content").drop("html").withColumnRenamed("page_source", "html")
    by_site = F.col("site_text").isNotNull()
    return done.withColumns(
        {
            into: F.coalesce("site_text", "generic_content"),
            "extractor": F.when(by_site, "site").when(F.col("generic_content").isNotNull(), "generic"),
        }
    ).drop("site_host", "site_rule", "site_text", "generic_content")
