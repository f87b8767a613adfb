"""Licence scan: Dice coefficient over word bigrams against licence templates. DataFrame functions only.

A text's units are its sentences, its lines, its paragraphs and the whole of it, so notices and the paragraphs of
licence texts are found inside long texts, and short licence files as such. A unit is normalised (lower case, all but letters and digits to blanks) and becomes a set of
word bigrams. A Dice coefficient of t needs sizes within t / (2 - t) of each other, so units outside the bounds of
all templates go before any bigram is made, and a template is a unit's candidate only within its own bounds. Shared
bigrams are counted by an equi-join on the bigram.

From the same bound a match shares m * t / (2 - t) of a template's m bigrams at least. Words that touch more than the
rest of them are chosen for each template, common ones last and longest first: a unit without any of them can't match, nor can a text, so
one regular expression leaves out most texts before they are taken apart.

Edge cases: null, empty and one-word units have no bigram and match nothing; templates without bigrams are ignored;
of equal templates each is reported; a null doc_id is reported as null; repeated rows count as further units of their
doc_id; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DICE = 0.8
#: Templates (bigrams) up to this number are sent to every executor; beyond, the join shuffles.
BROADCAST_BIGRAMS = 100_000

#: Words that say little about a text.
COMMON = {"a", "and", "by", "for", "in", "is", "of", "the", "this", "to", "under", "with"}

#: Notices by which texts name a licence.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("bsd-2-clause", "Released under the BSD 2-Clause License."),
    ("mpl-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
]

#: Paragraphs of licence texts and the headers that files carry.
PARAGRAPHS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
TEMPLATES = NOTICES + PARAGRAPHS


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *x) for i, x in enumerate(TEMPLATES)], "template_id long, license string, text string")


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))


def required_words(templates: list[list[str]], threshold: float) -> list[str]:
    """Words of which every match of any template has one. templates: the bigrams of each."""
    chosen: set[str] = set()
    for grams in templates:
        pairs = [tuple(g.split(" ")) for g in grams]
        spare = len(pairs) * (1 - threshold / (2 - threshold))
        covered = lambda: sum(a in chosen or b in chosen for a, b in pairs)  # noqa: B023, E731
        for word in sorted({w for p in pairs for w in p}, key=lambda w: (w in COMMON, -len(w), w)):
            if covered() > spare + 1e-9:
                break
            chosen.add(word)
    return sorted(chosen)


def license_matches(docs: DataFrame, templates: DataFrame | None = None, threshold: float = DICE) -> DataFrame:
    """One row per document and licence whose notice or text it holds: doc_id, license, dice (the largest), n_units."""
    spark = docs.sparkSession
    templates = default_templates(spark) if templates is None else templates
    known = templates.select("template_id", "license", _bigrams(_words(F.col("text"))).alias("grams")).withColumn("t_size", F.size("grams")).where("t_size > 0")
    least, most, total = known.agg(F.min("t_size"), F.max("t_size"), F.sum("t_size")).first()
    if least is None:
        least, most, total = 1, 0, 0
    reach = threshold / (2 - threshold)
    grams = known.select("template_id", "license", "t_size", F.explode("grams").alias("gram"))
    may_match = F.lit(True)
    if total <= BROADCAST_BIGRAMS:
        grams = F.broadcast(grams)
        words = required_words([r.grams for r in known.select("grams").collect()], threshold)
        # Case-blind like the normalised text, or more so; a word found inside a longer one only lets a unit pass.
        may_match = F.col("text").rlike("(?iu)" + "|".join(re.escape(w) for w in words)) if words else F.lit(False)

    text = F.col("text").cast("string")
    sentences = F.split(F.regexp_replace(text, r"([.;!?])\s+", "$1\n"), "\n")
    units = docs.where(may_match).select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), F.posexplode(F.array_distinct(F.concat(sentences, F.split(text, "\n"), F.split(text, r"\n[ \t\r]*\n"), F.array(text)))).alias("pos", "unit"))
    units = units.withColumnRenamed("unit", "text").where(may_match).withColumnRenamed("text", "unit").select("doc_id", "uid", "pos", _words(F.col("unit")).alias("words"))
    # A set of n bigrams needs n + 1 words at least; more words than the upper bound can only be repeats of bigrams, seen below.
    units = units.where(F.size("words") - 1 >= F.lit(least * reach)).select("doc_id", "uid", "pos", _bigrams(F.col("words")).alias("grams")).withColumn("size", F.size("grams"))
    units = units.where(F.col("size").between(F.lit(least * reach), F.lit(most / reach)))
    hits = units.select("doc_id", "uid", "pos", "size", F.explode("grams").alias("gram")).join(grams, "gram")
    hits = hits.where((F.col("size") >= F.col("t_size") * reach) & (F.col("size") <= F.col("t_size") / reach))
    dice = hits.groupBy("doc_id", "uid", "pos", "size", "template_id", "license", "t_size").agg(F.count("*").alias("shared"))
    dice = dice.withColumn("dice", 2 * F.col("shared") / (F.col("size") + F.col("t_size"))).where(F.col("dice") >= threshold)
    # Of all templates a unit is near to, the nearest counts.
    best = dice.groupBy("doc_id", "uid", "pos").agg(F.max(F.struct("dice", (-F.col("template_id")).alias("tie"), "license")).alias("top"))
    return best.groupBy("doc_id", F.col("top.license").alias("license")).agg(F.max("top.dice").alias("dice"), F.count("*").alias("n_units"))
