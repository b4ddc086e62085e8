"""Licence notices: lines and whole texts compared with templates by the Dice coefficient of their word bigrams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.pii import _let
from tallyworks.llm.shared import documents

# The wording of common notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
}
LEAST = 0.8


def bigrams_of(text: str) -> list[str]:
    words = "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _words(text: Column) -> Column:
    plain = F.lower(F.trim(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def scan(
    docs: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    least: float = LEAST,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, line_no, licence, dice)``: each line, and as line 0 each text of several lines, whose best template
    reaches ``least``.

    Words are runs of ASCII letters and digits in lower case; everything else
    separates. Dice is twice the common bigrams over the bigrams of both, each bigram counted
    once. Ties go to the licence first in the alphabet. Null and empty texts, and lines
    of fewer than two words, have no bigrams and match nothing. Repeated rows are judged
    alike; other columns are not read.

    Two sets whose sizes differ by more than the threshold allows cannot reach it: a line
    is compared only with templates within the bounds of its size, most with none.
    """
    sets = [(name, bigrams_of(text)) for name, texts in sorted(templates.items()) for text in texts]
    ratio = least / (2 - least)
    smallest, largest = min(len(s) for _, s in sets) * ratio, max(len(s) for _, s in sets) / ratio
    text = F.coalesce(text_column, F.lit(""))
    units = docs.select(F.col(id_column), F.split(text, "\n", -1).alias("_lines")).select(
        id_column,
        F.posexplode(F.concat(
            F.array(F.when(F.size("_lines") > 1, F.array_join("_lines", " ")).otherwise(F.lit(""))), F.col("_lines")
        )).alias("line_no", "_line"),
    )
    def pairs_of(words: Column) -> Column:
        shorter = F.greatest(F.size(words) - 1, F.lit(0))
        return F.array_distinct(F.zip_with(
            F.slice(words, F.lit(1), shorter), F.slice(words, F.lit(2), shorter), lambda a, b: F.concat_ws(" ", a, b)
        ))

    def best_of(pairs: Column) -> Column:
        size = F.size(pairs)

        def against(name: str, own: list[str]) -> Column:
            fits = (size >= len(own) * ratio) & (size <= len(own) / ratio)
            common = F.size(F.array_intersect(pairs, F.array(*map(F.lit, own))))
            dice = F.when(fits, common * 2.0 / (size + len(own))).otherwise(0.0)
            return F.struct((-dice).alias("dice"), F.lit(name).alias("licence"))

        return F.when(
            size.between(math.ceil(smallest), math.floor(largest)), F.array_min(F.array(*[against(name, own) for name, own in sets]))
        )

    # Each step is the variable of a lambda and the result comes out of a generator: Spark would otherwise put the whole
    # expression in the place of each of its names, once for every template.
    # A text of so many different words has at least as many bigrams, less one.
    best = _let(_words(F.col("_line")), lambda words: F.when(
        (F.size(words) > smallest) & (F.size(F.array_distinct(words)) - 1 <= largest), _let(pairs_of(words), best_of)
    ))
    # a line has at least as many characters as its bigrams need, so most short lines go unread
    found = units.where(F.length("_line") >= 2 * smallest).select(id_column, "line_no", F.inline_outer(F.array(best)))
    return found.where(F.col("dice") <= -least).select(id_column, "line_no", "licence", (-F.col("dice")).alias("dice"))


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    return scan(documents(spark, folder))


def licences_sql() -> str:
    quoted = lambda words: "[" + ", ".join("'" + w + "'" for w in words) + "]"
    rows = ", ".join(
        f"('{name}', {quoted(bigrams_of(text))})" for name, texts in TEMPLATES.items() for text in texts
    )
    return f"""
    WITH templates(licence, own) AS (VALUES {rows}),
    lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
    units AS (
        SELECT doc_id, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS line_no, unnest(l) AS line FROM lines
        UNION ALL SELECT doc_id, 0, array_to_string(l, ' ') FROM lines WHERE len(l) > 1),
    worded AS (SELECT doc_id, line_no,
        string_split(lower(trim(regexp_replace(line, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM units),
    sets AS (SELECT doc_id, line_no,
        list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs
        FROM worded WHERE len(w) >= 2),
    scored AS (SELECT doc_id, line_no, licence,
        len(list_intersect(pairs, own)) * CAST(2.0 AS DOUBLE) / (len(pairs) + len(own)) AS dice
        FROM sets, templates)
    SELECT doc_id, line_no, licence, dice FROM scored WHERE dice >= {LEAST}
    QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY dice DESC, licence) = 1"""
