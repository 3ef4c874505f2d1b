"""Licenses named or quoted in documents.

Phrases are looked for word by word in the whole text. License notices are found by an exact set-similarity
join of text blocks with a list of templates. A block is a window of consecutive words, as many as the template
has over the wanted share; where a line ends does not matter. It matches if it has at least that share of the
template's distinct words. All words of the templates are counted in the corpus and ordered rare ones first.
A block that matches shares one of the first few words of the template in that order (prefix filter), has enough
words (length filter), and has enough of them from the first shared word on (positional filter). The filters run
on stretches of 128 window starts; in a stretch that passes every window is verified by intersection. Only the
templates and their words, fixed lists, are broadcast or collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import ascii_lower, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINED = 0.8
STEP = 128

# Phrases and their labels: fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences and paragraphs of well-known license notices and their labels: fixed values.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "released under the mit license": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "subject to the terms of the mozilla public license v 2 0": "mpl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied see the license for the "
    "specific language governing permissions and limitations under the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "mit",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose see the gnu general public license for more "
    "details": "gpl",
    "you should have received a copy of the gnu general public license along with this program": "gpl",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "mpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
    "as a compiled binary for any purpose commercial or non commercial and by any means": "public-domain",
}


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _phrase_starts(words: Column, phrase: list[str], lead: Column) -> Column:
    """Numbers of the words at which the phrase starts; null where not all of its words occur."""
    here = F.array_contains(words, phrase[0])
    for word in phrase[1:]:
        here = here & F.array_contains(words, word)

    def at(i: Column) -> Column:
        same = F.get(words, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            same = same & (F.get(words, i + k) == word)
        return same

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), at)
    return F.when(here, F.transform(places, lambda i: (i - lead).cast("bigint")))


def _need(text: str, contained: float) -> int:
    return math.ceil(contained * len(set(text.split())) - 1e-9)


def _reach(text: str, contained: float) -> int:
    return math.floor(len(text.split()) / contained + 1e-9)


def _stretches(words: Column, over: int = 0) -> Column:
    """`words` in arrays of STEP, each with the next `over` words as well."""
    last = F.floor((F.size(words) - 1) / STEP).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(words, k * STEP + 1, STEP + over))


def _by_rarity(split: DataFrame) -> list[str]:
    """All words of the templates, those in the fewest stretches of the corpus first."""
    vocabulary = sorted({word for text in TEMPLATES for word in text.split()})
    held = F.transform(_stretches(F.col("words")), lambda s: F.array_intersect(s, _literal(vocabulary)))
    counts = split.select(F.explode(F.flatten(held)).alias("word")).groupBy("word").count()
    often = {r["word"]: r["count"] for r in counts.collect()}  # the words of the templates at most
    return sorted(vocabulary, key=lambda w: (often.get(w, 0), w))


def _scanned(split: DataFrame, ordered: list[str], prefixes: dict[str, list[str]], over: int) -> DataFrame:
    """For each row: its number of words, the starts of each phrase, and the stretches with a word of a prefix.

    A stretch has its words `text`, and those of `ordered` in that order.
    """
    first_words = _literal(sorted(set().union(*prefixes.values())))
    ends = split.withColumn("lead", (F.get("words", F.lit(0)) == "").cast("int"))
    size, tail = F.size("words"), ((F.element_at("words", -1) == "") & (F.size("words") > 1)).cast("int")
    met = F.filter(_stretches(F.col("words"), over), lambda s: F.arrays_overlap(s, first_words))
    return ends.select(
        "row",
        "doc_id",
        (size - F.col("lead") - tail).cast("bigint").alias("n_words"),
        F.struct(
            *[
                _phrase_starts(F.col("words"), phrase.split(), F.col("lead")).alias(f"p{i}")
                for i, phrase in enumerate(PHRASES)
            ]
        ).alias("starts"),
        F.transform(
            met, lambda s: F.struct(F.array_intersect(_literal(ordered), s).alias("words"), s.alias("text"))
        ).alias("stretches"),
    )


def _template_matches(
    scanned: DataFrame, own: dict[str, list[str]], prefixes: dict[str, list[str]], contained: float
) -> DataFrame:
    """(row, found, score): labels of the templates matched by a block of the row, and the largest share matched."""
    entries = [
        F.struct(
            F.lit(word).alias("word"),
            F.lit(place).alias("at"),
            F.lit(TEMPLATES[text]).alias("label"),
            F.lit(_need(text, contained)).alias("need"),
            F.lit(_reach(text, contained)).alias("reach"),
            _literal(own[text]).alias("template"),
        )
        for text, prefix in prefixes.items()
        for place, word in enumerate(prefix)
    ]
    index = scanned.sparkSession.range(1).select(F.inline(F.array(*entries)))

    stretches = scanned.select("row", F.inline("stretches"))
    candidates = stretches.select("row", "words", "text", F.posexplode("words").alias("place", "word")).join(
        F.broadcast(index), "word"
    )
    enough = F.size("words") >= F.col("need")
    rest = F.least(F.size("words") - F.col("place"), F.size("template") - F.col("at"))
    shared = F.array_intersect("words", "template")
    once = F.get(shared, F.lit(0)) == F.col("word")  # a pair meets at each shared word of the prefix
    passed = candidates.where(enough & (rest >= F.col("need"))).where((F.size(shared) >= F.col("need")) & once)

    starts = F.filter(
        F.sequence(F.lit(0), F.least(F.size("text"), F.lit(STEP)) - 1),
        lambda i: F.array_contains("template", F.get("text", i)),
    )
    best = F.array_max(
        F.transform(starts, lambda i: F.size(F.array_intersect("template", F.slice("text", i + 1, F.col("reach")))))
    )
    matches = passed.withColumn("best", best).where(F.col("best") >= F.col("need"))
    return matches.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max(F.col("best") / F.size("template")).alias("found_score")
    )


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", contained: float = CONTAINED
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of `docs`.

    `n_base` counts the places of all PHRASES and `base_labels` has their labels; `labels` has those of matched
    TEMPLATES too. `score` is 1 with a phrase, else the largest share of a matched template, else 0. A null
    text is empty and has neither words nor labels; a very long text is scanned whole, in stretches. Rows that
    repeat are scanned each; an empty table gives no rows; other columns are not read.
    """
    named = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    low = ascii_lower(F.coalesce("text", F.lit("")))
    split = named.select("row", "doc_id", F.split(low, SEPARATORS).alias("words"))
    ordered = _by_rarity(split)
    own = {text: [w for w in ordered if w in set(text.split())] for text in TEMPLATES}
    prefixes = {text: words[: len(words) - _need(text, contained) + 1] for text, words in own.items()}
    over = max(_reach(text, contained) for text in TEMPLATES) - 1
    scanned = written(_scanned(split, ordered, prefixes, over), "scanned")
    matches = _template_matches(scanned, own, prefixes, contained)

    starts = [F.col(f"starts.p{i}") for i in range(len(PHRASES))]
    places = F.flatten(F.filter(F.array(*starts), lambda x: x.isNotNull()))
    labels = F.array_compact(
        F.array(*[F.when(F.size(s) > 0, F.lit(label)) for s, label in zip(starts, PHRASES.values(), strict=True)])
    )

    def joined(values: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(values)), ",")

    found = F.coalesce("found", F.array().cast("array<string>"))
    return (
        scanned.drop("stretches")
        .join(matches, "row", "left")
        .select("*", places.alias("places"), labels.alias("own"))
        .select(
            "doc_id",
            "n_words",
            F.size("places").cast("bigint").alias("n_base"),
            F.array_min("places").alias("first_word"),
            F.array_max("places").alias("last_word"),
            joined(F.col("own")).alias("base_labels"),
            joined(F.concat("own", found)).alias("labels"),
            F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("found_score", F.lit(0.0))).alias("score"),
        )
    )


def oracle() -> str:
    """The same in DuckDB: for each template, every window that starts with one of its words."""
    starts, labels = [], []
    for phrase, label in PHRASES.items():
        same = " and ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), 1))
        starts.append(f"list_filter(range(len(words)), lambda i: {same})")
        labels.append(f"case when len({starts[-1]}) > 0 then '{label}' end")
    rows, words = [], []
    for no, (text, label) in enumerate(TEMPLATES.items()):
        own = sorted(set(text.split()))
        rows.append(f"({no}, '{label}', {_need(text, CONTAINED)}, {_reach(text, CONTAINED)}, {len(own)})")
        words += [f"({no}, '{w}')" for w in own]
    return f"""
        with d as materialized (
          select row_number() over () as row, doc_id,
            list_filter(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '{SEPARATORS}'), lambda x: x <> '') as words
          from documents),
        t(no, label, need, reach, size) as (values {", ".join(rows)}),
        tw(no, word) as (values {", ".join(words)}),
        u as (select row, unnest(words) as word, unnest(range(len(words))) as place from d),
        h as materialized (
          select row, no, place, word, need, reach, size, label from u join tw using (word) join t using (no)
          qualify count(distinct word) over (partition by row, no) >= need),
        b as (
          select a.row, a.no, a.place, any_value(a.label) as label, any_value(a.size) as size,
            count(distinct b.word) as n
          from h a join h b on a.row = b.row and a.no = b.no and b.place >= a.place and b.place < a.place + a.reach
          group by a.row, a.no, a.place having count(distinct b.word) >= any_value(a.need)),
        m as (select row, list(distinct label) as found, max(n / size) as score from b group by row),
        s as (
          select row, doc_id, len(words) as n_words, flatten([{", ".join(starts)}]) as places,
            list_filter([{", ".join(labels)}], lambda x: x is not null) as own
          from d)
        select doc_id, n_words, len(places) as n_base, list_min(places) as first_word, list_max(places) as last_word,
          coalesce(array_to_string(list_sort(list_distinct(own)), ','), '') as base_labels,
          coalesce(array_to_string(list_sort(list_distinct(list_concat(own, coalesce(found, [])))), ','), '') as labels,
          case when len(places) > 0 then 1.0 else coalesce(cast(score as double), 0.0) end as score
        from s left join m using (row)
    """
