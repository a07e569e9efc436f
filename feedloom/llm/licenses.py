"""Licence statements in documents, by Dice coefficient over word bigrams: on a line
of their own, spread over several lines, or inside a longer one.

DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ids_and_texts

# Usual wording of licence statements, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)
# Licence texts and headers that usually take several lines. The
# part that names the rights is enough; disclaimers differ little between licences.
TEXTS: tuple[tuple[str, str], ...] = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions:"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0"""),
    ("GPL-2.0-or-later", """This program is free software; you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation; either version 2
        of the License, or (at your option) any later version."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version."""),
    ("LGPL-2.1-or-later", """This library is free software; you can redistribute it and/or modify it under the
        terms of the GNU Lesser General Public License as published by the Free Software Foundation; either
        version 2.1 of the License, or (at your option) any later version."""),
    ("LGPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU Lesser General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version."""),
    ("AGPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU Affero General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
        of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code must retain
        the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
        binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code must retain
        the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
        binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the
        name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to
        copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
        a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
)
THRESHOLD = 0.8
#: Room for rounding in the size bounds; the dice itself decides.
_SLACK = 1e-9


def normalized_words(text: str) -> list[str]:
    """The Python twin of ``_words``, for the few templates."""
    import re

    return [w for w in re.sub(r"[^a-z0-9]+", " ", text.lower()).split(" ") if w]


def bigrams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(line), "[^a-z0-9]+", " "), " "), "")


def _pairs(words: Column) -> Column:
    """Word bigrams in place; ``words`` has two words at least."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(
        " ", F.element_at(words, i), F.element_at(words, i + 1)))


def _once(rows: DataFrame, value: Column, name: str, *others: str) -> DataFrame:
    """``value`` as a column that is computed once a row: filters on it are not
    pushed below a generator, which would compute it again in each of them."""
    return rows.select("doc_id", *(others or ("line_no",)), F.explode(F.array(value)).alias(name))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where ``value`` is computed once inside an expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _known(templates: tuple[tuple[str, str], ...]) -> list[tuple[str, list[str]]]:
    known = [(name, bigrams(normalized_words(text))) for name, text in templates]
    return [(name, grams) for name, grams in known if grams]


def _strings(values: list[str]) -> Column:
    """A constant array, sent to the planner as one literal."""
    return F.split(F.lit("\n".join(values)), "\n")


def _best(grams: Column, known: list[tuple[str, list[str]]], threshold: float) -> Column:
    """(dice, place, license) of the best template for a line's distinct bigrams."""
    def dice(template: list[str]) -> Column:
        m, n = len(template), F.size(grams)
        bounded = (n * (2 - threshold) + _SLACK >= m * threshold) & (n * threshold - _SLACK <= m * (2 - threshold))
        shared = F.size(F.array_intersect(grams, _strings(template)))
        return F.when(bounded, F.lit(2.0) * shared / (n + F.lit(m)))

    return F.array_max(F.array(*(
        F.struct(F.coalesce(dice(template), F.lit(-1.0)).alias("dice"), F.lit(-i).alias("place"), F.lit(name).alias("license"))
        for i, (name, template) in enumerate(known))))


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, line_no, license, dice) for every line of every document whose best
    template reaches ``threshold``; ``line_no`` counts from 0.

    A line and a template are lower-cased, everything but a-z and 0-9 becomes one
    blank, and the distinct word bigrams are compared: dice = 2 * shared / (line's
    + template's). A template of m bigrams can reach the threshold t only with
    lines of m*t/(2-t) to m*(2-t)/t bigrams; only those candidates are counted, and
    only for lines that have any bigram of a template at all. The best dice wins;
    ties go to the template that stands first in ``templates``, which are a fixed
    short list and travel in the plan. Every line is judged in its own row, so
    there is no join and no shuffle, and hot lines cost what other lines do.

    Null and empty texts and lines of fewer than two words match nothing; repeated
    rows give repeated results; a null id keeps its matches; an empty table gives
    an empty result; further columns are not looked at.
    """
    known = _known(templates)
    every = sorted({g for _, grams in known for g in grams})
    least = min((len(g) for _, g in known), default=0) * threshold / (2 - threshold) - _SLACK
    lines = ids_and_texts(docs, id_col, text_col).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    words = _once(lines, _words(F.col("line")), "words").where((F.size("words") > 1) & (F.size("words") - 1 >= least))
    pairs = _once(words, _pairs(F.col("words")), "pairs").where(F.arrays_overlap("pairs", _strings(every)))
    candidates = _once(pairs, F.array_distinct("pairs"), "grams")
    best = _once(candidates, _best(F.col("grams"), known, threshold), "best").where(F.col("best.dice") >= threshold)
    return best.select("doc_id", "line_no", "best.license", "best.dice")


def _windows(template: Column, pairs: Column, threshold: float) -> Column:
    """(worse, smaller, place, start, end, license) of the best window from each start."""
    grams, m, need, longest = (template[k] for k in ("grams", "m", "need", "longest"))
    at = F.filter(F.sequence(F.lit(1), F.size(pairs)), lambda i: F.array_contains(grams, F.element_at(pairs, i)))

    def starts(at: Column) -> Column:
        # A shared bigram more at the front never lowers the dice, so windows begin
        # where a run of shared bigrams does, and with enough of them in reach.
        return F.filter(at, lambda p, i: ((i == 0) | (F.get(at, i - 1) != p - 1)) & F.coalesce(
            F.get(at, i + need - 1) - p < longest, F.lit(False)))

    def window(start: Column) -> Column:
        return _let(F.slice(pairs, start, longest), lambda own: _let(F.array_distinct(own), lambda distinct: _let(
            # The window that ends with the q-th shared bigram, the k-th distinct one.
            F.array_max(F.transform(F.array_intersect(distinct, grams), lambda g, q: _let(
                F.array_position(distinct, g), lambda k: F.struct(
                    (F.lit(2.0) * (q + 1) / (k + m)).alias("dice"), F.array_position(own, g).cast("int").alias("size"))))),
            lambda best: F.struct(
                (-best["dice"]).alias("worse"), (-m).alias("smaller"), template["place"].alias("place"),
                start.alias("start"), (start + best["size"]).alias("end"), template["license"].alias("license")))))

    return F.filter(F.transform(_let(at, starts), window), lambda w: -w["worse"] >= threshold)


def spread(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES + TEXTS, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text", lines: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """(doc_id, line_no, license, dice) for statements that ``scan`` with the templates
    ``lines`` does not give: those over several lines, and those inside a longer line.

    The whole text is one sequence of words. A window is up to (2-t)/t times as long as
    its template and begins where a run of the template's bigrams does; its dice is
    that of ``scan``. Of windows that share a word the one with the highest dice stays,
    then the one of the longer template, the one that stands first in ``templates``, and
    the earliest. ``line_no`` is the line of the first word. A window is not given if a
    line that it touches has a row of the same licence in ``scan``.

    A window that reaches the threshold has m*t/(2-t) of its template's m bigrams, so
    only documents with so many distinct ones are looked at. No join and no shuffle;
    edge cases are those of ``scan``.
    """
    known, own = _known(templates), _known(lines)
    every = sorted({g for _, grams in known for g in grams})
    if not known:
        return scan(docs, (), threshold, id_col, text_col)
    rows = []
    for i, (name, text) in enumerate(templates):
        words = normalized_words(text)
        grams = bigrams(words)
        if grams:
            need = max(1, math.ceil(len(grams) * threshold / (2 - threshold) - _SLACK))
            longest = int((len(words) - 1) * (2 - threshold) / threshold + _SLACK)
            rows.append(F.struct(
                F.lit(i).alias("place"), F.lit(name).alias("license"), F.lit(len(grams)).alias("m"),
                F.lit(need).alias("need"), F.lit(longest).alias("longest"), _strings(grams).alias("grams")))
    table = F.array(*rows)
    texts = ids_and_texts(docs, id_col, text_col)
    words = _once(texts, _words(F.col("text")), "words", "text").where(F.size("words") > 1)
    pairs = _once(words, _pairs(F.col("words")), "pairs", "text")
    shared = _once(pairs, F.array_intersect("pairs", _strings(every)), "shared", "text", "pairs").where(F.size("shared") > 0)
    possible = _once(shared, F.filter(table, lambda t: F.size(F.array_intersect("shared", t["grams"])) >= t["need"]),
                     "possible", "text", "pairs").where(F.size("possible") > 0)
    found = _once(possible, F.array_sort(F.flatten(F.transform(
        "possible", lambda t: _windows(t, F.col("pairs"), threshold)))), "found", "text").where(F.size("found") > 0)
    chosen = F.aggregate("found", F.slice("found", 1, 0), lambda taken, w: F.when(
        F.exists(taken, lambda o: (o["start"] <= w["end"]) & (w["start"] <= o["end"])), taken).otherwise(F.concat(taken, F.array(w))))
    chosen = _once(found, chosen, "chosen", "text")
    split = _once(chosen, F.split("text", "\n"), "lines", "chosen")
    line_of = F.flatten(F.transform("lines", lambda line, i: F.array_repeat(i, F.size(_words(line)))))
    split = _once(split, line_of, "line_of", "lines", "chosen")
    each = split.select("doc_id", "lines", "line_of", F.explode("chosen").alias("w")).select(
        "doc_id", "lines", F.element_at("line_of", F.col("w.start")).alias("line_no"),
        F.element_at("line_of", F.col("w.end")).alias("last"), F.col("w.license").alias("license"), (-F.col("w.worse")).alias("dice"))

    def given(line: Column) -> Column:
        return _let(_words(line), lambda words: F.when(F.size(words) > 1, _let(
            F.array_distinct(_pairs(words)), lambda grams: _let(_best(grams, own, threshold), lambda best:
                (best["dice"] >= threshold) & (best["license"] == F.col("license"))))))

    touched = F.slice("lines", F.col("line_no") + 1, F.col("last") - F.col("line_no") + 1)
    if own:
        each = each.where(~F.exists(touched, lambda line: F.coalesce(given(line), F.lit(False))))
    return each.select("doc_id", "line_no", "license", "dice")


def statements(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, license, dice) of every licence statement: the lines of ``scan``
    and what ``spread`` finds besides."""
    return scan(docs, TEMPLATES, threshold, id_col, text_col).unionByName(
        spread(docs, TEMPLATES + TEXTS, threshold, id_col, text_col))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scan_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB's SQL for the same rows of ``documents``, without the pruning."""
    rows = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(templates))
    words = "list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"
    grams = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return f"""
    WITH t AS (SELECT place, license, {grams.format('w')} AS tg
               FROM (SELECT col0 AS place, col1 AS license, {words.format('col2')} AS w FROM (VALUES {rows}))),
    l AS (SELECT doc_id, s AS lines, unnest(range(len(s))) AS line_no
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
    g AS (SELECT doc_id, line_no, {grams.format('w')} AS lg
          FROM (SELECT doc_id, line_no, {words.format('lines[line_no + 1]')} AS w FROM l)),
    d AS (SELECT doc_id, line_no, place, license,
                 2.0::DOUBLE * len(list_intersect(lg, tg)) / (len(lg) + len(tg)) AS dice
          FROM g, t WHERE len(lg) > 0)
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, license, dice FROM d WHERE dice >= {threshold}
    QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY dice DESC, place) = 1
    """
