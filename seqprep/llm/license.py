"""License scans by the Dice coefficient over word bigrams.

A text is normalised across its line ends (lower case, letters and digits only)
and its windows of words are compared with licence templates: twice the shared
bigrams over both counts of distinct bigrams. A template of ``n`` bigrams
reaches ``least`` only in windows of at most ``n * (2 - least) / least`` that
share ``n * least / (2 - least)`` of them, so most texts hold too few of any
template's bigrams and are left at once. In the others one pass per template
keeps the distinct bigrams up to a position in the order of their last
occurrence: the last ``m`` of them are the window of ``m`` bigrams that ends
there, however often they repeat. Of the windows that reach ``least`` the best
is kept, then the best of those that share no word with it, and so on.
Templates are a short fixed list, so everything stays in the row: nothing is
shuffled, whatever line or document is frequent.

Native throughout: DataFrame and SQL functions only.

Defined results: null and empty texts have no matches; a template of one word
is one bigram of its own (the word) and equals every such word; of windows that
tie, the one that shares more bigrams, then the shorter, the earlier and the
first template by name; repeated rows are scanned each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions.arrays import let
from seqprep.llm.common import text_of

# Short notices of public licences, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
NOT_WORD = "[^a-z0-9]+"
# Templates are part of the plan; a longer list needs a table and a join.
MOST_TEMPLATES = 200


def template_bigrams(text: str) -> list[str]:
    words = re.sub(NOT_WORD, " ", text.lower()).split()
    return sorted({" ".join(pair) for pair in zip(words, words[1:])} or set(words))


def line_words(line: Column) -> Column:
    normal = F.trim(F.regexp_replace(F.lower(line), NOT_WORD, " "))
    return F.when(normal == "", F.array().cast("array<string>")).otherwise(F.split(normal, " "))


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id, n_matches`` (windows kept, none sharing a
    word), ``licenses`` (their templates by name, joined by commas) and ``best``
    (the highest coefficient, null without a match), and ``matches`` (array of
    ``line`` from 1, where the window begins, ``license``, ``dice``)."""
    templates = TEMPLATES if templates is None else templates
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates, not {len(templates)}")
    known = [(name, b) for name, text in sorted(templates.items()) if (b := template_bigrams(text))]
    single = [(name, b[0]) for name, b in known if " " not in b[0]]
    known = [(name, b) for name, b in known if " " in b[0]]
    wanted = sorted({x for _, b in known for x in b})
    heads = sorted({x.split(" ")[0] for x in wanted})
    # the bounds leave room for rounding, the coefficient itself decides
    low, high = least / (2 - least) - 1e-9, (2 - least) / least + 1e-9
    fewest = min((len(b) for _, b in known), default=0) * low
    none = F.array().cast("array<struct<worse:double,fewer:int,span:int,from:int,license:string,to:int>>")
    table = F.array(*[
        # bigrams hold no line end, so a template is one literal
        F.struct(F.lit(name).alias("name"), F.split(F.lit("\n".join(b)), "\n").alias("bigrams"), F.lit(len(b)).alias("n")) for name, b in known
    ])

    def pair(words, i):
        return F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))

    def window(dice, shared, start, name, end):
        """In the order in which windows are kept; words from ``start`` to ``end``."""
        return F.struct(
            (-dice).alias("worse"), (-shared).cast("int").alias("fewer"), (end - start).alias("span"),
            start.alias("from"), name.alias("license"), end.alias("to"),
        )

    def windows(words, t, places):
        """All windows that reach ``least`` and begin and end with a bigram of ``t``."""
        most = F.floor(t["n"] * high).cast("int")

        def ending_here(live, i):
            own = F.filter(F.transform(live, lambda x, k: F.struct(x["p"].alias("p"), x["t"].alias("t"), (F.size(live) - k).alias("m"))), lambda x: x["t"])
            reached = let(own, lambda o: F.transform(o, lambda x, k: window(
                F.lit(2.0) * (F.size(o) - k) / (x["m"] + t["n"]), F.size(o) - k, x["p"], t["name"], i + 1)))
            return F.filter(reached, lambda w: -w["worse"] >= least)

        def step(state, i):
            b = pair(words, i)
            moved = let(b, lambda b: F.concat(
                F.filter(state["live"], lambda x: x["b"] != b),
                F.array(F.struct(i.alias("p"), b.alias("b"), F.array_contains(t["bigrams"], b).alias("t"))),
            ))
            kept = let(moved, lambda x: F.when(F.size(x) > most, F.slice(x, -most, most)).otherwise(x))
            return let(kept, lambda live: F.struct(live.alias("live"), F.when(
                F.element_at(live, -1)["t"], F.concat(state["out"], ending_here(live, i))).otherwise(state["out"]).alias("out")))

        start = F.struct(F.array().cast("array<struct<p:int,b:string,t:boolean>>").alias("live"), none.alias("out"))
        return F.aggregate(F.sequence(F.element_at(places, 1), F.element_at(places, -1)), start, step, lambda state: state["out"])

    def reaching(words, hits):
        """Windows of all templates that the text holds enough bigrams of."""
        def of(t):
            own = F.filter(hits, lambda h: F.array_contains(t["bigrams"], h["b"]))
            return let(own, lambda h: F.when(
                F.size(F.array_distinct(h["b"])) >= t["n"] * low, windows(words, t, h["p"])).otherwise(none))

        return F.flatten(F.transform(table, of)) if known else none

    def equal_words(words, name, word):
        """Windows of a template of one word."""
        equal = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.element_at(words, i) == word)
        return F.transform(equal, lambda i: window(F.lit(1.0), F.lit(1), i, F.lit(name), i))

    def apart(found):
        """The best windows of which no two share a word, by place."""
        best = F.aggregate(F.array_sort(found), none, lambda kept, w: F.when(
            F.exists(kept, lambda k: (k["from"] <= w["to"]) & (w["from"] <= k["to"])), kept).otherwise(F.concat(kept, F.array(w))))
        return F.array_sort(F.transform(best, lambda w: F.struct(w["from"].alias("from"), w["license"].alias("license"), (-w["worse"]).alias("dice"))))

    def matches(text, words):
        places = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
        hits = F.filter(places, lambda i: F.element_at(words, i).isin(heads) & pair(words, i).isin(wanted))
        hits = F.transform(hits, lambda i: F.struct(i.alias("p"), pair(words, i).alias("b")))
        found = let(hits, lambda h: F.when(F.size(h) >= fewest, reaching(words, h)).otherwise(none))
        found = F.concat(found, *[equal_words(words, name, word) for name, word in single])
        line_of = F.flatten(F.transform(F.split(text, "\n"), lambda x, i: F.array_repeat(i + 1, F.size(line_words(x)))))
        placed = lambda kept: let(line_of, lambda lines: F.transform(kept, lambda w: F.struct(
            F.element_at(lines, w["from"]).alias("line"), w["license"].alias("license"), w["dice"].alias("dice"))))
        empty = F.array().cast("array<struct<line:int,license:string,dice:double>>")
        return let(found, lambda f: F.when(F.size(f) > 0, let(apart(f), placed)).otherwise(empty))

    text = text_of(F.col("text"))
    # an empty text is one empty word, which is in no template
    words = F.split(F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), " ")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", let(words, lambda w: matches(text, w)).alias("matches")
    )
    return rows.select(
        "id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"),
        F.array_max(F.col("matches.dice")).alias("best"), "matches",
    )
