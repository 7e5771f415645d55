"""Operator 8: licence texts found by the Dice coefficient over word bigrams. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
# The wordings of public licences and of their usual notices.
TEMPLATES = {
    ("MIT", "text"): f"{_PERMISSION} {_NOTICE} {_AS_IS}",
    ("MIT", "grant"): _PERMISSION,
    ("MIT", "warranty"): _AS_IS,
    ("MIT", "notice"): "Released under the MIT License.",
    ("MIT", "notice 2"): "Licensed under the MIT License.",
    ("MIT", "notice 3"): "This project is licensed under the terms of the MIT license.",
    ("BSD-2-Clause", "text"): _BSD_TWO,
    ("BSD-3-Clause", "text"): f"{_BSD_TWO} {_BSD_THIRD}",
    ("BSD-3-Clause", "notice"): "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ("ISC", "text"):
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ("Apache-2.0", "header"):
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ("Apache-2.0", "notice"): "Licensed under the Apache License, Version 2.0.",
    ("Apache-2.0", "notice 2"): "Released under the Apache License, Version 2.0.",
    ("GPL-3.0", "header"):
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ("GPL-3.0", "notice"): "This work is licensed under the GNU General Public License, version 3.",
    ("GPL-3.0", "notice 2"): "Licensed under the GNU General Public License, version 3.",
    ("CC-BY-NC-4.0", "notice"): "Licensed under CC BY-NC 4.0.",
    ("CC-BY-NC-4.0", "notice 2"): "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ("CC-BY-4.0", "notice"): "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ("MPL-2.0", "header"):
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def _words(text):
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _bigram():
    return F.xxhash64(F.get("words", F.col("at")), F.get("words", F.col("at") + 1)).alias("bigram")


def licence_matches(
    documents: DataFrame, templates: Mapping[tuple[str, str], str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Every line, paragraph and whole text that reads like a licence template.

    Texts are lower-cased and cut into runs of letters and digits. Dice is taken over bags of word bigrams:
    ``2 * common / (bigrams here + bigrams there)``. A unit of ``a`` bigrams can reach ``t`` against a template of
    ``b`` only if ``b * t / (2 - t) <= a <= b * (2 - t) / t``; units outside the bounds of all templates are not laid
    out at all. Bigrams are generated and probed in one pass against the broadcast bigrams of the templates, which are
    as many as the templates' words; only common bigrams reach a shuffle. Null, empty and one-word texts match nothing,
    and rows with the same id are scanned separately but reported together.

    Returns ``doc_id, licence, template, unit_kind, n_units, dice``: for each document, template and kind of unit the
    number of units that match and the best Dice.
    """
    spark = documents.sparkSession
    known = spark.createDataFrame([(licence, form, text) for (licence, form), text in templates.items()],
                                  "licence string, template string, text string")
    known = known.select("licence", "template", _words(F.col("text")).alias("words")).where(F.size("words") > 1)
    least, most = F.lit(threshold / (2 - threshold)), F.lit((2 - threshold) / threshold)
    known = known.withColumn("theirs", F.size("words") - 1)
    bounds = known.agg(F.min(F.ceil(F.col("theirs") * least - 1e-9)).alias("lo"), F.max(F.floor(F.col("theirs") * most + 1e-9)).alias("hi")).first()
    grams = (
        known.select("licence", "template", "theirs", "words", F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)).alias("at"))
        .select("licence", "template", "theirs", _bigram())
        .groupBy("licence", "template", "theirs", "bigram").agg(F.count("*").alias("there"))
    )
    text = F.coalesce("text", F.lit(""))
    lines, paragraphs = F.split(text, "\n"), F.split(text, r"\n[\x20\t]*\n")
    units = F.concat(
        F.transform(lines, lambda u: F.struct(F.lit("line").alias("kind"), u.alias("text"))),
        F.transform(F.filter(paragraphs, lambda u: F.instr(F.trim(u), "\n") > 0), lambda u: F.struct(F.lit("paragraph").alias("kind"), u.alias("text"))),
        F.when(F.size(paragraphs) > 1, F.array(F.struct(F.lit("text").alias("kind"), text.alias("text")))).otherwise(F.array()))
    # A unit with n characters has fewer than n / 2 + 1 words, so the shortest are skipped before they are cut.
    rows = (
        documents.select("doc_id", F.monotonically_increasing_id().alias("row"), units.alias("units"))
        .select("doc_id", "row", F.posexplode("units").alias("unit", "u"))
        .where(F.length("u.text") > 2 * (bounds.lo or 0))
        .select("doc_id", "row", "unit", F.col("u.kind").alias("unit_kind"), _words(F.col("u.text")).alias("words"))
        .where(F.size("words").between((bounds.lo or 0) + 1, (bounds.hi or 0) + 1))
        .select("doc_id", "row", "unit", "unit_kind", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 2)).alias("at"))
        .select("doc_id", "row", "unit", "unit_kind", (F.size("words") - 1).alias("ours"), _bigram())
    )
    fits = (F.col("ours") >= F.col("theirs") * least - 1e-9) & (F.col("ours") <= F.col("theirs") * most + 1e-9)
    unit = ["doc_id", "row", "unit", "unit_kind", "ours"]
    common = (
        rows.join(F.broadcast(grams), "bigram").where(fits)
        .groupBy(*unit, "licence", "template", "theirs", "bigram", "there").agg(F.count("*").alias("here"))
        .groupBy(*unit, "licence", "template", "theirs").agg(F.sum(F.least("here", "there")).alias("common"))
        .withColumn("dice", 2.0 * F.col("common") / (F.col("ours") + F.col("theirs")))
        .where(F.col("dice") >= threshold)
    )
    return common.groupBy("doc_id", "licence", "template", "unit_kind").agg(
        F.count("*").alias("n_units"), F.max("dice").alias("dice"))
