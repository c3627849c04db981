"""License scan: lines of a text against license notices by Dice coefficient of word bigrams.

A line's normalised words are lower-case runs of a-z and 0-9. With b bigrams, a line can reach a
coefficient of t with a notice of c bigrams only if t / (2 - t) <= b / c <= (2 - t) / t, so lines
outside the bounds of all notices are dropped before their bigrams are built, and each other line
meets only the notices whose bounds it fits. All of it happens within the row of a document:
nothing is exploded, shuffled or gathered, whatever lines are common.

Results for odd input: a missing or empty text has no license; of several best notices the first
in the table's order wins; lines without two words match nothing; repeated rows get the same
result each; an empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.llm.common import whole_text

LEAST_DICE = 0.8

# Common notices by license.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted under the BSD 3-Clause License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
    "v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
    "License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
    "International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and "
    "related rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Proprietary": "All rights reserved. No part of this work may be reproduced without "
    "permission.",
}


def bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _bounds(n: int, least: float) -> tuple[float, float]:
    return n * least / (2 - least), n * (2 - least) / least


def _line_bigrams(words: Column) -> Column:
    pairs = F.zip_with(
        F.slice(words, 1, F.size(words) - 1),
        F.slice(words, 2, F.size(words) - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(pairs)


def scan_licenses(
    docs: DataFrame, notices: Mapping[str, str] = NOTICES, least: float = LEAST_DICE
) -> DataFrame:
    """``doc_id, license, dice, n_lines``: the best notice of each document, its coefficient, and
    how many lines reach ``least`` with any notice."""
    templates = [(place, name, bigrams(text)) for place, (name, text) in enumerate(notices.items())]
    sizes = [len(grams) for _, _, grams in templates]
    low, _ = _bounds(min(sizes), least)
    _, high = _bounds(max(sizes), least)

    plain = F.trim(F.regexp_replace(F.lower(whole_text()), "[^a-z0-9\n]+", " "))
    # A line of w words has at most w - 1 bigrams, and no fewer than low unless it repeats some.
    lines = F.transform(F.split(plain, "\n"), lambda line: F.trim(line))

    def word_count(line: Column) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1

    long_enough = F.filter(lines, lambda line: word_count(line) - 1 >= low)
    grams = F.filter(
        F.transform(long_enough, lambda line: _line_bigrams(F.split(line, " "))),
        lambda found: (F.size(found) >= low) & (F.size(found) <= high),
    )

    def best(found: Column) -> Column:
        def score(place: int, name: str, template: list[str]) -> Column:
            smallest, largest = _bounds(len(template), least)
            shared = F.size(F.array_intersect(found, F.array(*[F.lit(g) for g in template])))
            dice = 2 * shared / (F.size(found) + len(template))
            fits = F.size(found).between(smallest, largest)
            return F.struct(
                F.when(fits, dice).otherwise(0.0).alias("dice"),
                F.lit(-place).alias("place"),
                F.lit(name).alias("license"),
            )

        return F.array_max(F.array(*[score(*template) for template in templates]))

    matches = F.filter(F.transform(grams, best), lambda match: match["dice"] >= least)
    found = docs.select("doc_id", matches.alias("matches"))
    top = F.array_max("matches")
    return found.select(
        "doc_id",
        top["license"].alias("license"),
        top["dice"].alias("dice"),
        F.size("matches").cast("bigint").alias("n_lines"),
    )
