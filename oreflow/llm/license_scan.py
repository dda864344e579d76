"""License scan: an exact set-similarity join of text blocks with license notices, in DataFrame functions only.

A text's blocks are windows over all its words, line breaks being gaps like any
other: each twice as long as ``BLOCK_WORDS`` or the longest notice, and half a window
after the last, so every run of half a window lies within one block. A block
carries a notice when it contains at least ``THRESHOLD`` of the notice's different
words, the telling ones among them. Notices of one family share most of their
words (versions and variants of one license); of these, a block carries those
that it contains best, by share and then by words. The join finds all such pairs:

- Tokens (the words of the notices) are put in order of their frequency in the
  blocks of all texts, rarest first.
- Prefix filter: a notice of t tokens that needs a of them is found by one of its
  first t - a + 1 tokens, and that token is among the first b - a + 1 of the
  block's b tokens.
- Length filter: b >= a. Positional filter: after the first common token, enough
  tokens must be left on both sides.
- What passes is counted exactly.

With ``across_lines=False`` the blocks are the lines of a text, long ones cut into
windows of ``BLOCK_WORDS``: a notice wrapped over lines is then found only if one line
holds enough of it.

Besides, the base phrases are found wherever their words stand one after another
in the whole text, across lines.

Scale: nothing but tokens and matches is shuffled; the texts are read twice, once
for the frequencies, once for the join. Only the postings of the notices are
broadcast: they are a parameter of at most ``MAX_TOKENS`` tokens.

Defined results: a null or empty text has no words, no labels and score 0; rows
that repeat a doc_id are scanned each by its own text; a null doc_id is scanned
like any other; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
BLOCK_WORDS = 64
MAX_TOKENS = 10_000

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}



class Notice(NamedTuple):
    label: str
    text: str
    telling: str = ""  # words without which it is another notice
    family: str = ""  # of notices that differ in some words; the label stands for itself


# Wordings of public license notices and their labels.
NOTICES = [
    Notice("mit", "Released under the MIT License.", "mit"),
    Notice("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "granted free charge"),
    Notice(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "granted sublicense",
    ),
    Notice("apache-2", "Licensed under the Apache License, Version 2.0.", "apache 2"),
    Notice("apache-2", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache 2"),
    Notice(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache 2",
    ),
    Notice("cc-by", "Licensed under CC BY 4.0.", "cc by", "cc"),
    Notice("cc-by-sa", "Licensed under CC BY-SA 4.0.", "cc by sa", "cc"),
    Notice("cc-by-nc", "Licensed under CC BY-NC 4.0.", "cc by nc", "cc"),
    Notice("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "commons attribution", "cc"),
    Notice(
        "cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "commons attribution sharealike", "cc",
    ),
    Notice(
        "cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "commons attribution noncommercial", "cc",
    ),
    Notice("gpl-2", "This work is licensed under the GNU General Public License, version 2.", "gnu 2", "gpl"),
    Notice("gpl-3", "This work is licensed under the GNU General Public License, version 3.", "gnu 3", "gpl"),
    Notice(
        "gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "gnu general public", "gpl",
    ),
    Notice(
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
        "gnu general public 2", "gpl",
    ),
    Notice(
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "gnu general public 3", "gpl",
    ),
    Notice("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution binary"),
    Notice(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met", "redistribution binary conditions",
    ),
    Notice("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2"),
    Notice(
        "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "permission fee granted",
    ),
    Notice("all-rights-reserved", "Copyright. All rights reserved.", "copyright all rights reserved"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def _words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(_UPPER, _LOWER)))


def notice_tokens(text: str) -> list[str]:
    return sorted(set(_words_of(text)))


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def _prepared(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, lined (words with one blank between, lines kept)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lined = F.regexp_replace(F.translate(text, _UPPER, _LOWER), _GAPS_IN_LINE, " ")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), lined.alias("lined")
    )


def _base(prepared: DataFrame, phrases: dict[str, str]) -> DataFrame:
    flat = F.trim(F.regexp_replace("lined", r"[ \n]+", " "))
    rows = prepared.select("doc_id", "text_key", flat.alias("flat"))
    n_words = F.when(F.col("flat") == "", 0).otherwise(
        F.length("flat") - F.length(F.replace(F.col("flat"), F.lit(" "), F.lit(""))) + 1
    )
    padded = F.concat(F.lit(" "), F.col("flat"), F.lit(" "))
    holds = {p: F.contains(padded, F.lit(f" {p} ")) for p in phrases}
    words = F.split("flat", " ")

    def starts(phrase: str) -> Column:
        parts = phrase.split(" ")

        def stands(words: Column, i: Column) -> Column:
            found = F.get(words, i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                found = found & (F.get(words, i + k) == part)
            return found

        def places(words: Column) -> Column:
            return F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), lambda i: stands(words, i))

        # as an element of an array the words are a variable, cut once and not anew for every place
        return F.when(holds[phrase], F.get(F.transform(F.array(words), places), F.lit(0))).otherwise(F.array().cast("array<int>"))

    rows = rows.withColumn("n_words", n_words.cast("long")).withColumn(
        "found", F.array(*[F.struct(F.lit(label).alias("label"), starts(p).alias("starts")) for p, label in phrases.items()])
    )
    all_starts = F.flatten("found.starts")
    labels = F.array_sort(F.array_distinct(F.transform(F.filter("found", lambda x: F.size(x["starts"]) > 0), lambda x: x["label"])))
    return rows.select(
        "doc_id", "text_key", "n_words", F.size(all_starts).cast("long").alias("n_base"),
        F.array_min(all_starts).cast("long").alias("first_word"), F.array_max(all_starts).cast("long").alias("last_word"),
        labels.alias("base"),
    )


def text_blocks(prepared: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text_key, line, start and ``words`` of every block of a line with a word."""
    lines = prepared.select("doc_id", "text_key", F.posexplode(F.split("lined", "\n")).alias("line", "text"))
    lines = lines.select("doc_id", "text_key", "line", F.trim("text").alias("text")).filter("text <> ''")
    lines = lines.select("doc_id", "text_key", "line", F.split("text", " ").alias("line_words"))
    half = block_words // 2
    starts = F.when(F.size("line_words") <= block_words, F.array(F.lit(1))).otherwise(
        F.sequence(F.lit(1), F.size("line_words") - half, F.lit(half))
    )
    return lines.select("doc_id", "text_key", "line", "line_words", F.explode(starts).alias("start")).select(
        "doc_id", "text_key", "line", "start", F.slice("line_words", F.col("start"), block_words).alias("words")
    )


def window_words(notices: list[Notice] = NOTICES, block_words: int = BLOCK_WORDS) -> int:
    return 2 * max([block_words] + [len(_words_of(notice[1])) for notice in notices])


def text_windows(prepared: DataFrame, notices: list[Notice] = NOTICES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text_key, line (0), start and ``words`` of every window over the whole text."""
    whole = prepared.withColumn("lined", F.regexp_replace("lined", r"[ \n]+", " "))
    return text_blocks(whole, window_words(notices, block_words))


def _token_order(blocks: DataFrame, tokens: list[str]) -> list[str]:
    """The tokens by the number of blocks that hold them, rarest first."""
    counted = blocks.select(F.explode(F.array_intersect(_array(tokens), F.col("words"))).alias("token")).groupBy("token").count()
    counts = {row["token"]: row["count"] for row in counted.collect()}  # at most one row per token of the notices
    return sorted(tokens, key=lambda t: (counts.get(t, 0), t))


class _Known(NamedTuple):
    label: str
    family: str
    tokens: set[str]
    telling: list[str]
    need: int


def _known(notices: list[Notice], threshold: float) -> list[_Known]:
    out = []
    for label, text, telling, family in (Notice(*notice) for notice in notices):
        tokens = set(notice_tokens(text))
        if set(_words_of(telling)) - tokens:
            raise ValueError(f"the telling words {telling!r} are not all in the notice of {label}")
        if tokens:
            out.append(_Known(label, family or label, tokens, notice_tokens(telling), max(1, math.ceil(threshold * len(tokens) - 1e-9))))
    return out


def _postings(documents: DataFrame, notices: list[_Known], rank: dict[str, int]) -> DataFrame:
    rows = []
    for number, notice in enumerate(notices):
        ordered = sorted(notice.tokens, key=rank.__getitem__)
        for place, token in enumerate(ordered[: len(ordered) - notice.need + 1]):
            rows.append(F.struct(
                F.lit(token).alias("token"), F.lit(number).alias("notice"), F.lit(notice.label).alias("label"),
                F.lit(notice.family).alias("family"), F.lit(place).alias("notice_place"), F.lit(notice.need).alias("need"),
                _array(ordered).alias("notice_tokens"), _array(notice.telling).alias("telling"),
            ))
    return documents.sparkSession.range(1).select(F.inline(F.array(*rows)))


def notice_matches(
    blocks: DataFrame, notices: list[Notice] = NOTICES, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, text_key, notice, label, containment: every pair of a block and a notice that it carries."""
    known = _known(notices, threshold)
    universe = sorted(set().union(*[notice.tokens for notice in known])) if known else []
    if not known or len(universe) > MAX_TOKENS:
        raise ValueError(f"notices must have words, and at most {MAX_TOKENS} different ones")
    order = _token_order(blocks, universe)
    rank = {token: i for i, token in enumerate(order)}
    prefixes = sorted(
        {t for notice in known for t in sorted(notice.tokens, key=rank.__getitem__)[: len(notice.tokens) - notice.need + 1]}, key=rank.__getitem__
    )

    block = ["doc_id", "text_key", "line", "start"]
    probes = blocks.select(
        *block, F.explode(F.array_intersect(_array(prefixes), F.col("words"))).alias("token"), "words"
    ).select(*block, "token", F.array_intersect(_array(order), F.col("words")).alias("tokens"))
    joined = probes.join(F.broadcast(_postings(blocks, known, rank)), "token")
    size, wanted = F.size("tokens"), F.size("notice_tokens")
    place = F.array_position("tokens", F.col("token")).cast("int") - 1
    passed = joined.filter(
        (size >= F.col("need")) & (place <= size - F.col("need"))
        & (1 + F.least(wanted - F.col("notice_place") - 1, size - place - 1) >= F.col("need"))
    )
    common = F.size(F.array_intersect("notice_tokens", "tokens"))
    told = F.size(F.array_intersect("telling", "tokens")) == F.size("telling")
    found = passed.filter((common >= F.col("need")) & told).select(
        *block, "family", F.struct((common / wanted).alias("containment"), common.alias("common")).alias("fit"), "notice", "label"
    )
    # at most one match per notice in a block
    best = found.groupBy(*block, "family").agg(F.collect_set(F.struct("fit", "notice", "label")).alias("matches"), F.max("fit").alias("best"))
    kept = F.filter("matches", lambda match: match["fit"] == F.col("best"))
    return best.select("doc_id", "text_key", F.inline(kept)).select("doc_id", "text_key", "notice", "label", F.col("fit.containment").alias("containment"))


def scan_licenses(
    documents: DataFrame, notices: list[Notice] = NOTICES, phrases: dict[str, str] = BASE_PHRASES,
    threshold: float = THRESHOLD, across_lines: bool = True,
) -> DataFrame:
    """Per document: words, base places, ``base`` labels, all ``labels`` (both sorted arrays) and the best score."""
    prepared = _prepared(documents)
    blocks = text_windows(prepared, notices) if across_lines else text_blocks(prepared)
    found = notice_matches(blocks, notices, threshold).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    base = _base(prepared, phrases)
    keyed = found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "more", "best")
    joined = base.join(keyed, (F.col("text_key") == F.col("found_key")) & F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base",
        F.array_sort(F.array_union("base", F.coalesce("more", none))).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scan_sql() -> str:
    """The same scan for DuckDB, without any filter: every block against every notice."""
    words = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    def listed(words: list[str]) -> str:
        return f"CAST([{', '.join(_quoted(w) for w in words)}] AS VARCHAR[])"

    notices = ", ".join(
        f"({_quoted(n.label)}, {_quoted(n.family)}, {listed(sorted(n.tokens))}, {listed(n.telling)}, {n.need})" for n in _known(NOTICES, THRESHOLD)
    )
    phrases = ", ".join(
        f"({_quoted(label)}, [{', '.join(_quoted(w) for w in phrase.split(' '))}])" for phrase, label in BASE_PHRASES.items()
    )
    size = window_words()
    half = size // 2
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, {lower} AS txt FROM documents
), worded AS (
    SELECT row_id, doc_id, txt, regexp_extract_all(txt, {words}) AS words FROM docs
), phrases(label, parts) AS (VALUES {phrases}),
notices(label, family, tokens, telling, need) AS (VALUES {notices}),
places AS (
    SELECT row_id, label, i - 1 AS place
    FROM (SELECT row_id, words, label, parts, unnest(generate_series(1, len(words) - len(parts) + 1)) AS i
          FROM worded, phrases WHERE list_contains(words, parts[1]))
    WHERE words[i : i + len(parts) - 1] = parts
), base AS (
    SELECT row_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
           list(DISTINCT label) AS base FROM places GROUP BY 1
), blocks AS (
    SELECT row_id, start, words[start : start + {size - 1}] AS words
    FROM (SELECT row_id, words, unnest(CASE WHEN len(words) <= {size} THEN [1]
                                       ELSE generate_series(1, len(words) - {half}, {half}) END) AS start
          FROM worded WHERE len(words) > 0)
), carried AS (
    SELECT row_id, start, label, family, len(list_intersect(tokens, words)) AS common,
           len(list_intersect(tokens, words)) / len(tokens) AS containment
    FROM blocks, notices WHERE len(list_intersect(tokens, words)) >= need AND len(list_intersect(telling, words)) = len(telling)
), matched AS (
    SELECT row_id, label, containment FROM carried
    QUALIFY rank() OVER (PARTITION BY row_id, start, family ORDER BY containment DESC, common DESC) = 1
), more AS (
    SELECT row_id, list(DISTINCT label) AS more, max(containment) AS best FROM matched GROUP BY 1
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
       greatest(coalesce(CAST(best AS DOUBLE), 0.0), CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END) AS score
FROM worded LEFT JOIN base USING (row_id) LEFT JOIN more USING (row_id)
"""
