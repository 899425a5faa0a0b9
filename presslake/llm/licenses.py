"""License scan by an exact set-similarity join, with DataFrame functions only.

Text blocks are compared with license templates as sets of words: single lines, and the
words around each line break of a paragraph, as license texts are wrapped as a rule. A block
meets a template when it holds at least `threshold` of the template's words. The join
is exact and never compares all blocks with all templates:

* words are ordered by their frequency over all blocks, the rarest first;
* prefix filter: a block that meets a template holds one of the template's first
  |T| - need + 1 words, and that word is among its own first |B| - need + 1;
* length filter: a block has at least `need` of the template vocabulary's words;
* positional filter: after a first common word at places i and j at most
  min(|T| - i, |B| - j) words are left to share, which must be enough.

What passes is counted exactly. Only words of the template vocabulary can be shared, so
all others are left out of the blocks beforehand.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.match import bind
from presslake.llm.common import fresh, staged, text_key, whole_text
from presslake.llm.urls import ascii_lower

#: Separates words: ASCII characters that are neither digits nor lower-case letters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

# Phrases whose places count, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Public license statements, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("all-rights-reserved", "All rights reserved."),
]


def scan_words(text: Column) -> Column:
    """Words of a text in order, A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(text), BREAKS), "")


def _python_words(text: str) -> list[str]:
    return [w for w in re.split(BREAKS, "".join(c.lower() if c.isascii() else c for c in text)) if w]


def phrase_places(words: Column, phrase: Sequence[str]) -> Column:
    """Starts of the places where the words of `phrase` stand one after the other."""
    last = F.size(words) - len(phrase)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    # The first word is looked up everywhere, the others only behind it.
    here = lambda i: [F.get(words, i + k) == w for k, w in enumerate(phrase)]

    def stands(i):
        first, *others = here(i)
        for other in others:
            first = first & other
        return first

    held = F.array_contains(words, phrase[0])
    return F.when(held, F.filter(starts, stands)).otherwise(F.array().cast("array<int>"))


def text_blocks(text: Column, reach: int) -> Column:
    """The word lists of a text's lines, and of what goes on over line breaks.

    For each line that is followed by another of its paragraph: its last `reach` words and the first `reach` words of the
    lines after it, up to a line without words. Whatever stands in `reach` words or fewer, over however
    many lines, is in one of these blocks.
    """
    lines = F.transform(F.split(text, r"\n"), scan_words)

    def over_breaks(lines: Column, heads: Column) -> Column:
        def following(i: Column) -> Column:
            after = F.slice(heads, i + 2, reach)
            stop = F.array_position(after, F.array().cast("array<string>")).cast("int")
            return F.slice(F.flatten(F.when(stop > 0, F.slice(after, 1, stop - 1)).otherwise(after)), 1, reach)

        def block(words: Column, i: Column) -> Column:
            size, ahead = F.size(words), F.size(F.get(heads, i + 1))
            # A full line is all there is to reach; only short ones need those after them.
            after = F.when(ahead >= reach, F.get(heads, i + 1)).otherwise(following(i))
            return F.when(
                (size > 0) & (ahead > 0), F.concat(F.slice(words, F.greatest(size - (reach - 1), F.lit(1)), F.lit(reach)), after)
            )

        return F.concat(lines, F.array_compact(F.transform(lines, block)))

    # Each step is bound: inside the lambda it would be worked out again for every line.
    return bind(lines, lambda words: bind(F.transform(words, lambda line: F.slice(line, 1, reach)), lambda heads: over_breaks(words, heads)))


def reach_of(templates: Sequence[tuple[str, str]], threshold: float) -> int:
    """Words the longest template may stand in, with others between its own."""
    return math.ceil(max((len(_python_words(text)) for _, text in templates), default=1) / threshold)


def telling_words(sets: Sequence[tuple[int, str, list[str]]], threshold: float) -> dict[int, list[list[str]]]:
    """Per template, lists of words of each of which a block must hold one.

    Where the words of another label's template alone would meet a template, only the words that the other lacks tell
    the two apart: a notice of one then does not pass for the other.
    """
    out: dict[int, list[list[str]]] = {}
    for n, label, words in sets:
        own = set(words)
        rivals = (set(other) for _, name, other in sets if name != label)
        lacked = {tuple(sorted(own - rival)) for rival in rivals if len(own & rival) >= threshold * len(own) - 1e-9}
        out[n] = [list(words) for words in sorted(lacked) if words]
    return out


def template_matches(blocks: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """For blocks (rid, words): every block and template that meet, as rid, label and containment.

    A block meets a template with enough of its words, among them telling ones where templates are alike.
    """
    sets = [(label, sorted(set(_python_words(text)))) for label, text in templates]
    sets = [(n, label, words) for n, (label, words) in enumerate(sets) if words]
    vocabulary = sorted({w for _, _, words in sets for w in words})
    need_of = lambda words: math.ceil(threshold * len(words) - 1e-9)
    least = min((need_of(words) for _, _, words in sets), default=0)
    kept = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    # Staged: the frequencies and the join read the few blocks left, not the texts again.
    held = staged(blocks.select("rid", kept.alias("held")).filter((F.size("held") >= least) & (F.size("held") > 0)), "blocks")
    counted = {r["word"]: r["n"] for r in held.select(F.explode("held").alias("word")).groupBy("word").count().withColumnRenamed("count", "n").collect()}
    order = sorted(vocabulary, key=lambda w: (counted.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    ranks = F.create_map(*[x for w, i in place.items() for x in (F.lit(w), F.lit(i))])
    ordered = held.select("rid", F.array_sort(F.transform("held", lambda w: ranks[w])).alias("held"))
    spark = blocks.sparkSession
    rows, telling = [], telling_words(sets, threshold)
    for n, label, words in sets:
        own, need = sorted(place[w] for w in words), need_of(words)
        told = [[place[w] for w in some] for some in telling[n]]
        rows += [(n, label, own, told, need, own[i], i) for i in range(len(own) - need + 1)]
    # One row per template and prefix word: bounded by the template list.
    prefixes = spark.createDataFrame(rows, "template int, label string, own array<int>, told array<array<int>>, need int, token int, i int")
    heads = ordered.select("rid", "held", F.size("held").alias("n"), F.posexplode(F.slice("held", 1, F.size("held") - least + 1)).alias("j", "token"))
    heads = heads.filter(F.col("token").isin(sorted({r[5] for r in rows})))
    joined = heads.join(F.broadcast(prefixes), "token").filter(
        (F.col("n") >= F.col("need"))
        & (F.col("j") <= F.col("n") - F.col("need"))
        & (1 + F.least(F.size("own") - F.col("i") - 1, F.col("n") - F.col("j") - 1) >= F.col("need"))
    )
    both = F.array_intersect("held", "own")
    # A pair that shares several prefix words is taken at its first common word only.
    met = joined.filter((F.element_at(both, 1) == F.col("token")) & (F.size(both) >= F.col("need")))
    met = met.filter(F.forall("told", lambda some: F.arrays_overlap(some, F.col("held"))))
    return met.select("rid", "label", (F.size(both) / F.size("own")).alias("containment"))


def scan_licenses(
    df: DataFrame,
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every row of `df` with what its text says about licenses, in added columns.

    Added: n_words, n_base (places of all phrases), first_word and last_word (their
    smallest and largest start, null without a place), base_labels, labels (those of
    the phrases and of the templates met) as sorted comma-joined texts, and score (the
    largest containment of a template that is met, else 0). Clashing names get an
    underscore in front. Null texts are empty: no words, no labels, score 0.
    """
    names = fresh(df, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    n_words, n_base, first_word, last_word, base_labels, labels, score = names
    key, found, met, places, all_words, said = fresh(df, "text_key", "found", "met", "places", "words", "mentions")
    text = whole_text(text_col)
    # What a text meets depends on nothing else, so texts are named by their digest.
    blocks = df.select(text_key(text).alias("rid"), F.explode(text_blocks(text, reach_of(templates, threshold))).alias("words"))
    matches = template_matches(blocks, templates, threshold)
    by_text = staged(
        matches.groupBy(F.col("rid").alias(key)).agg(F.struct(F.collect_set("label").alias("labels"), F.max("containment").alias("score")).alias(met)),
        "license-texts",
    )
    words = F.col(all_words)
    base = [(label, phrase_places(words, phrase.split(" "))) for phrase, label in phrases.items()]
    mentions = F.lit(False)
    for phrase in phrases:
        mentions = mentions | F.contains(ascii_lower(text), F.lit(phrase.split(" ")[-1]))
    none = F.array().cast("array<int>")
    # The words are a column of their own: an expression inside the place filter would be split again for every word.
    scanned = (
        df.withColumns({all_words: scan_words(text), said: mentions, key: text_key(text)})
        .withColumns(
            {
                n_words: F.size(words).cast("long"),
                found: F.array(*[F.when(F.col(said), place).otherwise(none) for _, place in base]),
            }
        )
        .withColumn(places, F.flatten(found))
        .drop(all_words, said)
    )
    own = F.array_compact(
        F.array(*[F.when(F.size(F.col(found)[i]) > 0, F.lit(label)) for i, (label, _) in enumerate(base)])
    )
    joined = scanned.join(by_text, key, "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col(n_words),
        F.size(places).cast("long").alias(n_base),
        F.array_min(places).cast("long").alias(first_word),
        F.array_max(places).cast("long").alias(last_word),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias(base_labels),
        F.array_join(
            F.array_sort(F.array_distinct(F.concat(own, F.coalesce(f"{met}.labels", F.array().cast("array<string>"))))), ","
        ).alias(labels),
        F.coalesce(f"{met}.score", F.lit(0.0)).alias(score),
    )
