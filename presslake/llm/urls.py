"""URL filter: host and path rules, then a weighted vocabulary found by Aho-Corasick.

One pass of the automaton over a URL finds every term of the vocabulary. A hit counts
when no letter or digit touches it. A strict term rejects a URL alone; soft terms
have weights, and several distinct ones together reject it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import fresh

# Terms that reject a URL alone.
STRICT_TERMS = [
    "adult", "bets", "betting", "casino", "escort", "gambling", "hentai", "jackpot", "nude", "pills", "poker", "porn",
    "sex", "slots", "spam", "viagra", "warez", "xxx",
]
# Terms that speak against a URL, with their weights.
SOFT_TERMS = {
    "ads": 1.0, "bonus": 1.0, "cheap": 1.0, "click": 0.5, "crack": 1.0, "deal": 0.5, "discount": 0.5, "download": 0.5,
    "farm": 0.5, "free": 0.5, "keygen": 1.0, "loan": 1.0, "promo": 0.5, "torrent": 1.0, "track": 1.0, "tracker": 1.0,
    "win": 1.0, "winner": 1.0,
}
#: Distinct soft terms and their summed weight, both at least, that reject a URL.
SOFT_HITS, SOFT_WEIGHT = 2, 1.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule (verdict, host, path) as a struct (verdict, rule), or null.

    A rule fits its host and all subdomains when the path starts with the rule's path.
    Of rules of the same length the one with the longer path wins, then the earlier one.
    """
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), -len(rules[i][2]), i))
    fitting = [
        F.when(
            ((host == rules[i][1]) | F.endswith(host, F.lit(f".{rules[i][1]}"))) & F.startswith(path, F.lit(rules[i][2])),
            F.struct(F.lit(rules[i][0]).alias("verdict"), F.lit(rules[i][1] + rules[i][2]).alias("rule")),
        )
        for i in order
    ]
    return F.coalesce(*fitting, F.lit(None).cast("struct<verdict:string,rule:string>"))


def term_hits(url: Column, strict: Sequence[str] = STRICT_TERMS, soft: Mapping[str, float] = SOFT_TERMS) -> Column:
    """Struct (strict, soft, weight): distinct strict and soft terms of a URL, sorted, and the soft weight."""
    kinds = {**{t: None for t in strict}, **{t: w for t, w in soft.items() if t not in set(strict)}}
    fields = "struct<strict:array<string>,soft:array<string>,weight:double>"

    @F.arrow_udf(fields)
    def found(urls: pa.Array) -> pa.Array:
        automaton = ahocorasick.Automaton()
        for term in kinds:
            automaton.add_word(term, term)
        automaton.make_automaton()
        word = set("abcdefghijklmnopqrstuvwxyz0123456789")
        out = []
        for url in urls.to_pylist():
            hits = set()
            for last, term in automaton.iter(url):
                first = last - len(term) + 1
                if (first == 0 or url[first - 1] not in word) and (last + 1 == len(url) or url[last + 1] not in word):
                    hits.add(term)
            soft_hits = sorted(t for t in hits if kinds[t] is not None)
            out.append(
                {"strict": sorted(t for t in hits if kinds[t] is None), "soft": soft_hits, "weight": float(sum(kinds[t] for t in soft_hits))}
            )
        return pa.array(out, pa.struct([("strict", pa.list_(pa.string())), ("soft", pa.list_(pa.string())), ("weight", pa.float64())]))

    return found(ascii_lower(F.coalesce(url, F.lit(""))))


def judge_urls(
    df: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    url_col: str = "url",
    strict: Sequence[str] = STRICT_TERMS,
    soft: Mapping[str, float] = SOFT_TERMS,
    soft_hits: int = SOFT_HITS,
    soft_weight: float = SOFT_WEIGHT,
) -> DataFrame:
    """Every row of `df` with added columns host, path, rule, verdict, strict_terms, soft_terms.

    The verdict is the longest fitting rule's, else "block" for one strict term or for
    `soft_hits` distinct soft terms that weigh `soft_weight`, else "allow". A null URL, or
    one without `://`, has an empty host and path and fits no rule; a null URL has no
    terms. Added names that clash with columns of `df` get an underscore in front.
    """
    host, path, rule, verdict, strict_terms, soft_terms, fit, hits = fresh(
        df, "host", "path", "rule", "verdict", "strict_terms", "soft_terms", "fit", "hits"
    )
    url = F.col(f"`{url_col}`")
    out = df.withColumn(host, host_of(url)).withColumn(path, path_of(url)).withColumn(hits, term_hits(url, strict, soft))
    out = out.withColumn(fit, rule_for(F.col(host), F.col(path), rules))
    rejected = (F.size(f"{hits}.strict") > 0) | ((F.size(f"{hits}.soft") >= soft_hits) & (F.col(f"{hits}.weight") >= soft_weight))
    return (
        out.withColumn(rule, F.col(f"{fit}.rule"))
        .withColumn(verdict, F.coalesce(F.col(f"{fit}.verdict"), F.when(rejected, "block").otherwise("allow")))
        .withColumn(strict_terms, F.col(f"{hits}.strict"))
        .withColumn(soft_terms, F.col(f"{hits}.soft"))
        .drop(fit, hits)
    )
