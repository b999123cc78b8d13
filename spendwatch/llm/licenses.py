r"""Licence scans by Dice similarity of word bigrams with templates (native).

A text is normalised (lower case, every run of other signs one space, copyright
names and years as they stand) and looked at in units. A unit's set of word bigrams is
compared with a template's by ``2 * common / (|unit| + |template|)``:

* each line (unit from 0). A template can only reach the limit if ``|unit|`` lies between ``limit / (2 - limit)`` and its inverse times
  ``|template|``, so units outside every template's bounds are dropped on size alone and each line meets
  only templates within its bounds. By the same bound a unit must share so many of a template's bigrams that it
  has one of a few words; texts and lines without any are dropped first. Lines of one word are compared as that word.
* windows (unit -2) over the words of the text, across line breaks: for each anchor word of a template, as many words as the
  template has, laid so that the word is where the template has it. So wrapped notices, and notices that share a line with other
  words, are found. Of lines and windows that overlap only the best is kept: that which shares most bigrams with its template, then the
  more similar, then the line.
* the whole text (unit -1), if it has line breaks and nothing else in it matches.

The templates are a small literal table: no join, no shuffle, and every row is judged by itself. Every text is read whole.

Rows: a NULL text has no licence; equal lines count each; ties in similarity go to the template that comes first in
order of its id, and between windows of one template to the earlier; repeated rows each get a row; very long texts are scanned
like others; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so extra columns do not matter.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices of public licences, as they are usually put in a file.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License."
    ),
    "bsd-2-clause": "Released under the BSD 2-Clause License.",
    "bsd-2-clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
        " distribution."
    ),
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more"
        " details."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
        " notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
        " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,"
        " commercial or non-commercial, and by any means."
    ),
}
#: Least similarity of a match, in percent.
PERCENT = 80

#: Anchor words of a template at most.
ANCHORS = 4

_SIGNS = r"[^a-z0-9]+"


def normalised(text: Column) -> Column:
    """Words of ASCII letters and digits, one space apart; other signs are space."""
    return F.trim(F.regexp_replace(F.lower(text), _SIGNS, " "))


def template_words(template: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in template.lower()).split()


def template_bigrams(template: str) -> list[str]:
    """Sorted distinct bigrams; a single word stands for itself."""
    w = template_words(template)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])} or set(w))


def bigrams(words: Column) -> Column:
    """Distinct bigrams of an array of words, as an array."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))
    )
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(words))


def _bounds(size: int, percent: int) -> tuple[int, int]:
    """Least and greatest set size that can reach the limit with a template of ``size`` bigrams."""
    return -(-size * percent // (200 - percent)), size * (200 - percent) // percent


def required_words(sets: list[list[str]], percent: int) -> list[str]:
    """Strings of which a unit that reaches the limit with any template contains at least one.

    It shares at least ``limit / (2 - limit)`` of the template's bigrams, so it cannot lack all of any larger part:
    words are chosen, long ones first, until the bigrams that they touch are such a part of each template.
    """
    chosen: list[str] = []
    for grams in sorted(sets, key=len):
        spare = len(grams) + (-len(grams) * percent // (200 - percent))
        words = {w for g in grams for w in g.split()}
        while sum(any(c in g for c in chosen) for g in grams) <= spare:
            rest = [w for w in words if not any(c in w for c in chosen)]
            touch = {w: (sum(w in g.split() for g in grams), sum(any(w in g.split() for g in s) for s in sets)) for w in rest}
            chosen.append(max(rest, key=lambda w: (len(w) > 4, not w.isdigit(), touch[w], w)))
    return chosen


def anchors(template: str, percent: int) -> list[tuple[str, int]]:
    """Words of a template at which windows are laid, with their first places in it; of the words that a match needs, some."""
    w = template_words(template)
    needed = [x for x in required_words([template_bigrams(template)], percent) if x in w] or w
    return [(x, w.index(x)) for x in needed[:ANCHORS]]


def _found(text: Column, templates: dict[str, str], percent: int) -> Column:
    """The matches (unit, license, dice) of a text, as an array."""
    sets = {k: template_bigrams(v) for k, v in sorted(templates.items())}
    bounds = [_bounds(len(v), percent) for v in sets.values()]
    least, most = min(a for a, _ in bounds), max(b for _, b in bounds)
    literal = F.array(
        *[
            F.struct(
                F.lit(name).alias("license"),
                F.lit(-k).alias("order"),
                F.lit(low).alias("low"),
                F.lit(high).alias("high"),
                F.lit(len(have)).alias("n"),
                F.array(*map(F.lit, have)).alias("grams"),
            )
            for k, ((name, have), (low, high)) in enumerate(zip(sets.items(), bounds))
        ]
    )

    def scored(grams: Column, t: Column) -> Column:
        """(dice, order, common, license); inside lambdas, so that nothing is computed twice."""
        def told(common: Column) -> Column:
            share = F.lit(200.0) * common / (F.size(grams) + t["n"])
            return F.struct(share.alias("dice"), t["order"].alias("order"), common.alias("common"), t["license"].alias("license"))

        return F.transform(F.array(F.size(F.array_intersect(grams, t["grams"]))), told)[0]

    def similar(unit: Column) -> Column:
        """The unit's best template."""
        near = F.filter(literal, lambda t: F.size(unit["grams"]).between(t["low"], t["high"]))
        return F.struct(unit["unit"].alias("unit"), F.array_max(F.transform(near, lambda t: scored(unit["grams"], t))).alias("best"))

    asked = required_words(list(sets.values()), percent)

    def likely(x: Column) -> Column:
        """Whether a required word is in the text, which is lowered once."""
        return F.exists(F.array(F.lower(x)), lambda low: functools.reduce(operator.or_, [low.contains(w) for w in asked]))

    split = lambda x: F.array_remove(F.split(normalised(x), " "), "")
    def as_match(unit: Column, best: Column, start: Column, end: Column) -> Column:
        fields = [best[c].alias(c) for c in ("license", "dice", "common", "order")]
        return F.struct(unit.alias("unit"), *fields, start.cast("int").alias("start"), end.cast("int").alias("end"))

    def judged(units: Column) -> Column:
        """Matches of units (unit, raw)."""
        units = F.filter(units, lambda u: likely(u["raw"]))
        units = F.transform(units, lambda u: F.struct(u["unit"].alias("unit"), split(u["raw"]).alias("words")))
        # distinct words less one are at most the bigrams, all words at least
        sized = F.filter(units, lambda u: (F.size(u["words"]) >= max(1, least)) & (F.size(F.array_distinct(u["words"])) - 1 <= most))
        grams = F.transform(sized, lambda u: F.struct(u["unit"].alias("unit"), bigrams(u["words"]).alias("grams")))
        near = F.filter(F.transform(grams, similar), lambda x: x["best"]["dice"] >= percent)
        return F.transform(near, lambda x: as_match(x["unit"], x["best"], F.lit(0), F.lit(0)))

    # windows: (word, template, offset, words) of each anchor
    marks = [
        (word, k, at, len(template_words(body))) for k, (_, body) in enumerate(sorted(templates.items())) for word, at in anchors(body, percent)
    ]
    mark_words = F.array(*[F.lit(w) for w in sorted({m[0] for m in marks})])
    mark_rows = F.array(*[
        F.struct(F.lit(w).alias("word"), F.lit(k).alias("template"), F.lit(at).alias("at"), F.lit(n).alias("n")) for w, k, at, n in marks
    ])

    def windows(words: Column) -> Column:
        """Matches of windows over the words."""
        placed = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i")))
        hits = F.filter(placed, lambda x: F.array_contains(mark_words, x["word"]))

        def laid(hit: Column) -> Column:
            here = F.filter(mark_rows, lambda m: m["word"] == hit["word"])
            return F.transform(here, lambda m: F.struct(
                m["template"].alias("template"),
                F.greatest(F.lit(0), hit["i"] - m["at"]).alias("start"),
                F.least(F.size(words), hit["i"] - m["at"] + m["n"]).alias("end"),
            ))

        spans = F.array_distinct(F.flatten(F.transform(hits, laid)))
        def judge(c: Column) -> Column:
            grams = F.array(bigrams(F.slice(words, c["start"] + 1, c["end"] - c["start"])))
            best = F.transform(grams, lambda g: scored(g, F.element_at(literal, c["template"] + 1)))
            return F.transform(best, lambda x: as_match(F.lit(-2), x, c["start"], c["end"]))[0]

        return F.filter(F.transform(spans, judge), lambda x: x["dice"] >= percent)

    def best_of(matches: Column) -> Column:
        """Matches without those that a better one overlaps."""
        overlaps = lambda x, y: (y["start"] < x["end"]) & (x["start"] < y["end"])
        rank = lambda x: F.struct(x["common"], x["dice"], (x["unit"] >= 0).cast("int"), x["order"], -x["start"], x["end"])
        kept = lambda all_: F.filter(all_, lambda x: ~F.exists(all_, lambda y: (rank(y) > rank(x)) & overlaps(x, y)))
        return F.flatten(F.transform(F.array(matches), kept))

    def scanned(raw: Column) -> Column:
        """All of a likely text's matches."""
        lines = F.split(raw, "\n")
        units = F.transform(lines, lambda x, i: F.struct(i.alias("unit"), x.alias("raw")))

        def with_places(met: Column) -> Column:
            """Line matches with their places among the text's words."""
            def placed(sizes: Column) -> Column:
                def one(m: Column) -> Column:
                    start = F.aggregate(F.slice(sizes, F.lit(1), m["unit"]), F.lit(0), lambda a, n: a + n)
                    return F.transform(F.array(start), lambda at: as_match(m["unit"], m, at, at + F.get(sizes, m["unit"])))[0]

                return F.transform(met, one)

            sizes = F.array(F.transform(lines, lambda x: F.size(split(x))))
            return F.when(F.size(met) > 0, F.flatten(F.transform(sizes, placed))).otherwise(met)

        by_line = F.flatten(F.transform(F.array(judged(units)), with_places))
        by_window = F.flatten(F.transform(F.array(split(raw)), windows))
        whole = F.when(F.instr(raw, "\n") > 0, F.array(F.struct(F.lit(-1).alias("unit"), raw.alias("raw"))))
        other = lambda m: F.when((F.size(m) > 0) | whole.isNull(), m).otherwise(judged(whole))
        return F.flatten(F.transform(F.array(best_of(F.concat(by_line, by_window))), other))

    likely_texts = F.filter(F.array(F.coalesce(text, F.lit(""))), likely)
    return F.flatten(F.transform(likely_texts, scanned))


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, unit, license, dice_percent) of each match: lines (unit from 0), windows (-2), or the whole text (-1)."""
    # the outer form, as the inner one makes Spark compute the array again for a filter on its size
    rows = docs.select("doc_id", F.explode_outer(_found(F.col("text"), templates, percent)).alias("u")).where("u is not null")
    return rows.select("doc_id", "u.unit", F.col("u.license").alias("license"), F.round("u.dice", 6).alias("dice_percent"))


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Per document: number of matches, the distinct licences in order, and the best similarity; made in each row."""
    told = lambda f: F.struct(
        F.size(f).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(f, lambda m: m["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform(f, lambda m: F.round(m["dice"], 6))), F.lit(0.0)).alias("best_dice"),
    )
    # exploded from an array of one, so that the matches are made once a row
    one = F.transform(F.array(_found(F.col("text"), templates, percent)), told)
    return docs.select("doc_id", F.explode_outer(one).alias("m")).select("doc_id", "m.*")


def license_sql(templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> str:
    """DuckDB SQL of ``license_scan``: bigrams as rows, joined with the templates' and counted."""
    rows = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in sorted(templates.items()))
    marks = ", ".join(f"('{k}', '{w}', {at})" for k, v in sorted(templates.items()) for w, at in anchors(v, percent))
    pairs = lambda w: f"CASE WHEN len({w}) > 1 THEN list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]) ELSE {w} END"
    return rf"""
WITH t(license, body) AS (VALUES {rows}),
mark(license, word, place) AS (VALUES {marks}),
u AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS unit FROM u
), raw AS (
  SELECT id, unit, raw FROM lines UNION ALL SELECT id, 0, text FROM u WHERE contains(text, chr(10))
), words AS (
  SELECT id, unit, regexp_extract_all(lower(raw), '[a-z0-9]+') AS w FROM raw
), tw AS (SELECT license, regexp_extract_all(lower(body), '[a-z0-9]+') AS w FROM t),
grams AS (SELECT DISTINCT id, unit, g FROM (SELECT id, unit, unnest({pairs("w")}) AS g FROM words)),
tg AS (SELECT DISTINCT license, g FROM (SELECT license, unnest({pairs("w")}) AS g FROM tw)),
gn AS (SELECT id, unit, count(*) AS n FROM grams GROUP BY ALL),
tn AS (SELECT license, count(*) AS n FROM tg GROUP BY ALL),
common AS (SELECT id, unit, license, count(*) AS n FROM grams JOIN tg USING (g) GROUP BY ALL),
scored AS (
  SELECT id, unit, license, common.n AS common, 200.0::DOUBLE * common.n / (gn.n + tn.n) AS dice
  FROM common JOIN gn USING (id, unit) JOIN tn USING (license)
), best AS (
  SELECT id, unit, license, common, dice FROM scored WHERE dice >= {percent}
  QUALIFY row_number() OVER (PARTITION BY id, unit ORDER BY dice DESC, license) = 1
), line_places AS (
  SELECT id, unit, len(w) AS n, coalesce(sum(len(w)) OVER (PARTITION BY id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "from"
  FROM words WHERE unit > 0
), leftover AS (
  SELECT id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM u
), placed AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM leftover),
spans AS (
  SELECT DISTINCT id, license, greatest(0, i - place) AS "from", least(len(leftover.w), i - place + len(tw.w)) AS "to"
  FROM placed JOIN mark USING (word) JOIN tw USING (license) JOIN leftover USING (id)
), wg AS (
  SELECT DISTINCT id, license, "from", "to", g FROM (
    SELECT id, license, "from", "to", unnest({pairs('x')}) AS g
    FROM (SELECT spans.*, w["from" + 1:"to"] AS x FROM spans JOIN leftover USING (id)))
), ws AS (
  SELECT id, license, "from", "to", count(tg.g) AS common, 200.0::DOUBLE * count(tg.g) / (count(*) + any_value(tn.n)) AS dice
  FROM wg LEFT JOIN tg USING (license, g) JOIN tn USING (license) GROUP BY id, license, "from", "to" HAVING dice >= {percent}
), all_parts AS (
  SELECT id, license, "from", "to", common, dice, 0 AS line FROM ws
  UNION ALL SELECT id, license, "from", "from" + n, common, dice, 1 FROM best JOIN line_places USING (id, unit)
), parts AS (
  SELECT id, license, dice FROM all_parts x WHERE NOT EXISTS (
    FROM all_parts y WHERE y.id = x.id AND y."from" < x."to" AND x."from" < y."to"
      AND (y.common, y.dice, y.line) >= (x.common, x.dice, x.line)
      AND ((y.common, y.dice, y.line) > (x.common, x.dice, x.line) OR y.license < x.license
        OR y.license = x.license AND (y."from" < x."from" OR y."from" = x."from" AND y."to" > x."to")))
), matches AS (
  FROM parts UNION ALL SELECT id, license, dice FROM best ANTI JOIN parts USING (id) WHERE unit = 0
), found AS (
  SELECT id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(round(dice, 6)) AS best_dice
  FROM matches GROUP BY id
)
SELECT doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses, coalesce(best_dice, 0.0)::DOUBLE AS best_dice
FROM u LEFT JOIN found USING (id)"""
