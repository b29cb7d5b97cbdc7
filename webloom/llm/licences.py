"""Licence scan: lines, whole texts and notices inside them, by Dice coefficient.

A passage (every line of a text, the text itself when it has several, and windows of
its words) is normalised to lower-case words of a-z and 0-9 and reduced to its set of word bigrams;
a passage of one word has that word as its only bigram. With passage set A and
template set B

    dice = 2 |A and B| / (|A| + |B|),

which reaches ``threshold`` t only if t / (2 - t) |B| <= |A| <= (2 - t) / t |B|. These
size bounds are applied three times: to the words of a passage, before its bigrams are
made; to the bigrams over all templates; and template by template, before any
intersection. Every line is normalised once.

Windows find notices that are wrapped over lines or stand inside longer ones. They are
runs of the whole text's words, of any length and from any word. For a given start, the
best window ends where a template bigram occurs for the first time, and a window that
starts at none is no better than the same without its first word; only such windows are
formed, so the best ones are among them and none is left out by its length. A window
needs t / (2 - t) |B| bigrams of the template, so texts with fewer of its words, then of
its bigrams, have none. Of windows of one licence that share words, the one with the
highest dice counts (ties: first, then longest); so does, of windows of two licences,
the better one if it has half of the other's words. A window is not counted if the whole
text matches the same licence, or a line does that has all of its words, or some of them
and no lower dice.

All work is one projection of DataFrame functions; nothing is shuffled. The templates
are a parameter and travel inside the plan; give some dozens, not thousands.

Defined results: null and empty texts match nothing; repeated lines match as often
as they occur; a window's line is that of its first word; ``best_match`` breaks ties by name, then line; rows and
extra columns stay, except that ``matches`` replaces a column of that name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
THRESHOLD = 0.8

# Usual short notices and key paragraphs of public licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    ("Proprietary", "All rights reserved."),
)


def template_bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])}) or words


def words(passage: Column) -> Column:
    plain = F.regexp_replace(F.translate(passage, UPPER, UPPER.lower()), "[^a-z0-9]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def bigrams(of: Column) -> Column:
    """Distinct bigrams of an array of words, joined by a space."""
    pairs = F.zip_with(
        F.slice(of, 1, F.greatest(F.size(of) - 1, F.lit(0))),
        F.slice(of, 2, F.greatest(F.size(of) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.when(F.size(of) < 2, of).otherwise(F.array_distinct(pairs))


def _bounds(size: int | Column, t: float):
    """Least and greatest size of a passage's set, wide enough for rounding."""
    return size * t / (2 - t) - 1e-9, size * (2 - t) / t + 1e-9


def window_template(name: str, text: str, threshold: float) -> Column | None:
    """What windows are compared with; None for a template without words.

    ``need``: bigrams that a window must have. ``need_words``: distinct words that a
    text with so many has at least; a bigram lacks when one of its two words does.
    """
    grams = template_bigrams(text)
    need = max(1, math.ceil(_bounds(len(grams), threshold)[0]))
    of_word = Counter(w for b in grams for w in set(b.split()))
    lacking, spent = 0, 0
    for count in sorted(of_word.values()):
        spent += count
        if spent > 2 * (len(grams) - need):
            break
        lacking += 1
    if not grams:
        return None
    return F.struct(
        F.lit(name).alias("licence"),
        F.array(*map(F.lit, grams)).alias("bigrams"),
        F.array(*map(F.lit, sorted(of_word))).alias("words"),
        F.lit(" " not in grams[0]).alias("single"),
        F.lit(need).alias("need"),
        F.lit(len(of_word) - lacking).alias("need_words"),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


_WINDOWS = "array<struct<low:double,first:int,end:int,last:int,licence:string,dice:double>>"


def _overlap(a: Column, b: Column) -> Column:
    """Number of words, or less than 1."""
    return F.least(a["last"], b["last"]) - F.greatest(a["first"], b["first"]) + 1


def _best_apart(windows: Column, gives_way: Callable[[Column, Column], Column]) -> Column:
    """Windows by falling dice, without those that give way to a better one that stays."""
    return F.aggregate(
        F.array_sort(windows.cast(_WINDOWS)),
        F.array().cast(_WINDOWS),
        lambda kept, w: F.when(F.exists(kept, lambda x: gives_way(w, x) > 0), kept).otherwise(
            F.concat(kept, F.array(w))
        ),
    )


def _windows_of(template: Column, words_: Column, pairs: Column, threshold: float) -> Column:
    """(low, first, end, last, licence, dice) of the windows that reach a template.

    ``first`` and ``last`` are numbers of words from 0; ``low`` is -dice and ``end`` -last.
    """
    need, known = template["need"], template["bigrams"]
    units = F.when(template["single"], words_).otherwise(pairs)

    def of_units(units: Column) -> Column:
        # (at, code): where a bigram of the template occurs, and which.
        coded = F.transform(
            units, lambda u, i: F.struct(i.alias("at"), F.array_position(known, u).alias("code"))
        )
        return _let(F.filter(coded, lambda h: h["code"] > 0), lambda hits: of_hits(units, hits))

    def of_hits(units: Column, hits: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hits) - need + 1)

        def from_start(start: Column) -> Column:
            tail = F.slice(hits, start, F.size(hits))
            return _let(tail, lambda tail: _let(tail["code"], lambda c: ends(tail, c)))

        def ends(tail: Column, codes: Column) -> Column:
            """Windows from the first hit to each hit that brings a new bigram."""
            fresh = F.array_distinct(codes)
            least = _let(fresh, lambda f: F.when(F.size(f) >= need, f))

            def window(code: Column, common: Column) -> Column:
                first = tail[0]["at"]
                last = tail[(F.array_position(codes, code) - 1).cast("int")]["at"]
                inside = F.size(F.array_distinct(F.slice(units, first + 1, last - first + 1)))
                dice = F.lit(2.0) * common / (inside + F.size(known))
                last = F.when(template["single"], last).otherwise(last + 1)
                return F.struct(
                    (-dice).alias("low"),
                    first.alias("first"),
                    (-last).alias("end"),
                    last.alias("last"),
                    template["licence"].alias("licence"),
                    dice.alias("dice"),
                )

            def reached(fresh: Column) -> Column:
                later = F.slice(fresh, need, F.size(fresh) - need + 1)
                return F.filter(
                    F.transform(later, lambda c, i: window(c, need + i)),
                    lambda w: w["dice"] >= threshold,
                )

            return _let(least, lambda f: F.when(f.isNotNull(), reached(f)))

        found = F.filter(F.transform(starts, from_start), lambda w: w.isNotNull())
        # One place of a template is one window from here on.
        return F.when(F.size(hits) >= need, _best_apart(F.flatten(found), _overlap))

    return _let(units, of_units)


def notices(
    lines: Column,
    whole: Column,
    matches: Column,
    templates: Sequence[tuple[str, str]],
    threshold: float,
) -> Column:
    """(line, licence, dice) of the windows that count beside ``matches``.

    ``lines``: words of each line; ``whole``: the words of all of them.
    """
    columns = [window_template(n, t, threshold) for n, t in templates]
    columns = [c for c in columns if c is not None]
    kind = "array<struct<line:int,licence:string,dice:double>>"
    none = F.array().cast(kind)
    if not columns:
        return none
    known = F.array(*columns)
    every = sorted({w for _, t in templates for b in template_bigrams(t) for w in b.split()})

    def worded(present: Column) -> Column:
        """Templates of which the text has enough words."""
        return F.filter(
            known, lambda t: F.size(F.array_intersect(t["words"], present)) >= t["need_words"]
        )

    def searched(likely: Column) -> Column:
        pairs = F.zip_with(
            F.slice(whole, 1, F.greatest(F.size(whole) - 1, F.lit(0))),
            F.slice(whole, 2, F.greatest(F.size(whole) - 1, F.lit(0))),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
        return F.when(F.size(likely) > 0, _let(pairs, lambda p: by_pairs(likely, p)))

    def by_pairs(likely: Column, pairs: Column) -> Column:
        def enough(distinct: Column) -> Column:
            return F.filter(
                likely,
                lambda t: t["single"]
                | (F.size(F.array_intersect(t["bigrams"], distinct)) >= t["need"]),
            )

        held = _let(F.array_intersect(pairs, F.flatten(likely["bigrams"])), enough)
        found = F.transform(held, lambda t: _windows_of(t, whole, pairs, threshold))
        flat = F.flatten(F.filter(found, lambda w: w.isNotNull()))
        return _let(flat, lambda w: F.when(F.size(w) > 0, _let(line_of, lambda n: counted(w, n))))

    line_of = F.flatten(F.transform(lines, lambda w, i: F.array_repeat(i + 1, F.size(w))))

    def counted(windows: Column, line_of: Column) -> Column:
        def is_new(w: Column) -> Column:
            first, last = line_of[w["first"]], line_of[w["last"]]
            return ~F.exists(
                matches,
                lambda m: (m["licence"] == w["licence"])
                & (
                    (m["line"] == 0)
                    | m["line"].between(first, last)
                    & ((first == last) | (m["dice"] >= w["dice"]))
                ),
            )

        def gives_way(w: Column, x: Column) -> Column:
            half = F.when(x["licence"] == w["licence"], 0).otherwise(
                (w["last"] - w["first"]) / F.lit(2)
            )
            return _overlap(w, x) - half

        return F.transform(
            F.filter(_best_apart(windows, gives_way), is_new),
            lambda w: F.struct(
                line_of[w["first"]].alias("line"),
                w["licence"].alias("licence"),
                w["dice"].alias("dice"),
            ),
        )

    present = F.array_intersect(whole, F.array(*map(F.lit, every)))
    return F.coalesce(_let(present, lambda p: _let(worded(p), searched)).cast(kind), none)


def with_matches(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``matches``: array of (line, licence, dice); line 0 is the whole text.

    Lines and the whole text come first, then windows. Lines count from 1 and split at line feeds.
    """
    sets = [(name, template_bigrams(text)) for name, text in templates]
    known = F.array(
        *[
            F.struct(F.lit(n).alias("licence"), F.array(*map(F.lit, b)).alias("bigrams"))
            for n, b in sets
        ]
    )
    least, _ = _bounds(min(len(b) for _, b in sets), threshold)
    _, most = _bounds(max(len(b) for _, b in sets), threshold)

    def against(passage: Column) -> Column:
        """(licence, dice) of the templates that the set of a passage reaches."""

        def compare(template: Column) -> Column:
            total = F.size(passage["set"]) + F.size(template["bigrams"])
            same = F.size(F.array_intersect(passage["set"], template["bigrams"]))
            return F.struct(
                passage["line"].alias("line"),
                template["licence"].alias("licence"),
                (F.lit(2.0) * same / total).alias("dice"),
            )

        def near(template: Column) -> Column:
            low, high = _bounds(F.size(template["bigrams"]).cast("double"), threshold)
            return F.size(passage["set"]).between(low, high)

        return F.filter(
            F.transform(F.filter(known, near), compare), lambda m: m["dice"] >= threshold
        )

    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    # Words end at line ends, so the whole text's words are those of its lines.
    per_line = docs.withColumn("_lines", F.transform(lines, words))
    worded = per_line.withColumn("_whole", F.flatten("_lines"))

    # d distinct words make at least d - 1 distinct bigrams, w words w - 1 at most.
    def in_reach(w: Column) -> Column:
        return (F.size(w) >= least) & (F.size(F.array_distinct(w)) - 1 <= most)

    kind = "array<struct<line:int,words:array<string>>>"
    whole = F.when(
        (F.size("_lines") > 1) & in_reach(F.col("_whole")),
        F.array(F.struct(F.lit(0).alias("line"), F.col("_whole").alias("words"))),
    ).otherwise(F.array().cast(kind))
    numbered = F.transform(
        "_lines", lambda w, i: F.struct((i + 1).alias("line"), w.alias("words"))
    )
    passages = F.filter(F.concat(whole, numbered), lambda p: in_reach(p["words"]))
    split_up = F.transform(
        passages, lambda p: F.struct(p["line"].alias("line"), bigrams(p["words"]).alias("set"))
    )
    fitting = F.filter(split_up, lambda p: F.size(p["set"]).between(least, most))
    found = F.flatten(F.transform(fitting, against))
    scanned = worded.withColumn("matches", found)
    inside = _let(
        F.col("matches"),
        lambda m: F.concat(
            m, notices(F.col("_lines"), F.col("_whole"), m, templates, threshold)
        ),
    )
    return scanned.withColumn("matches", inside).drop("_lines", "_whole")


def best_match(matches: Column) -> Column:
    """The match with the highest dice; ties to the first name, then the first line."""
    ordered = F.array_sort(
        F.transform(
            matches,
            lambda m: F.struct(
                (-m["dice"]).alias("low"), m["licence"].alias("licence"), m["line"].alias("line")
            ),
        )
    )
    return F.get(ordered, F.lit(0))
