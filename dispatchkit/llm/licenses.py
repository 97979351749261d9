"""Licence scans with a trained paragraph classifier (operator 1).

Paragraphs are the lines of a text, wrapped lines joined: a line that ends in a letter, digit, comma or
semicolon goes on in the next one if that begins in lower case, comment signs before it left out. Every
paragraph is scored. Features are its distinct word 1- to 3-grams. A multinomial logistic regression over the families, 'unknown' and 'none' is fitted on notices
composed from the tables below. Its scores are calibrated with a temperature (least log loss on
held-back notices, whole and with words missing, and held-back plain lines), and the least probability at which a family is named is the one that best
separates held-back known notices from held-back notices of licences in no family; below it the
paragraph is 'unknown', a class that is trained on other such licences and on reservations of all
rights. A named family is confirmed by comparing the paragraph's words and word pairs with the family's
names and templates, none of them held back: shared ones over the smaller set. Without confirmation it is 'unknown' too.

Grams outside the fitted vocabulary have no weight, so on tables only grams that begin with a word
of the vocabulary are written out; the scores are the same. Lines are scored where they lie, without
a shuffle; only lines that are not 'none' travel.

Everything on the tables is DataFrame functions and ML transformers; the driver sees the composed
notices (a few hundred rows, the same for every input) only.

Defined results: NULL and empty texts are 'none'; lines of any length are classified whole; rows
that repeat id and text are answered alike and their paragraphs counted once; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Names of each family, as notices write them.
NAMES = {
    "apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "Apache-2.0", "the Apache Software License 2.0"),
    "mit": ("the MIT License", "the MIT licence", "MIT", "the MIT/Expat License"),
    "gpl-3.0": ("the GNU General Public License, version 3", "the GNU General Public License v3.0", "GPL-3.0", "GPLv3"),
    "lgpl": ("the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License", "LGPL-2.1", "LGPLv3"),
    "agpl-3.0": ("the GNU Affero General Public License, version 3", "the GNU Affero General Public License", "AGPL-3.0"),
    "bsd": ("the BSD License", "the BSD 3-Clause License", "the 2-clause BSD licence", "BSD-3-Clause"),
    "mpl-2.0": ("the Mozilla Public License, v. 2.0", "the Mozilla Public License 2.0", "MPL-2.0"),
    "cc-by-nc": ("CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC-SA 4.0", "CC-BY-NC-4.0"),
    "cc-by-sa": ("CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-3.0"),
    "cc-by": ("CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    "cc0": ("CC0 1.0", "the CC0 1.0 Universal public domain dedication", "CC0-1.0"),
}

#: Sentences of the licences themselves (fixed public texts).
SENTENCES = {
    "apache-2.0": ("you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
                   "See the License for the specific language governing permissions and limitations under the License",
                   "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
            "The Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
            "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise"),
    "gpl-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
                "This program is distributed in the hope that it will be useful, but without any warranty; see the GNU General Public License for more details",
                "You should have received a copy of the GNU General Public License along with this program"),
    "lgpl": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
             "You should have received a copy of the GNU Lesser General Public License along with this library",
             "This library is distributed in the hope that it will be useful; see the GNU Lesser General Public License for more details"),
    "agpl-3.0": ("You should have received a copy of the GNU Affero General Public License along with this program",
                 "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
                 "your modified version must prominently offer all users interacting with it remotely through a computer network an opportunity to receive the Corresponding Source"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
            "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties are disclaimed"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org/MPL/2.0"),
    "cc-by-nc": ("You may not use the material for commercial purposes under this Creative Commons NonCommercial license",
                 "NonCommercial means not primarily intended for or directed towards commercial advantage or monetary compensation"),
    "cc-by-sa": ("you must distribute your contributions under the same Creative Commons ShareAlike license",
                 "If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original"),
    "cc-by": ("You must give appropriate credit under the Creative Commons Attribution license",
              "You must give appropriate credit, provide a link to the license, and indicate if changes were made"),
    "cc0": ("has dedicated the work to the public domain by waiving all rights to the work worldwide under copyright law",
            "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
}

#: Sentences of licences of no family here.
OTHER_SENTENCES = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software",
    "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software",
    "Permission is hereby granted to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    "This is free and unencumbered software released into the public domain",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License",
    "The fonts and derivatives may not be sold by themselves; the font may be embedded in any document",
    "Licensee may not reverse engineer, decompile or disassemble the Software",
    "This Agreement grants you a limited, non-transferable, revocable licence for internal evaluation only",
)

CARRIERS = ("Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "Distributed under the terms of {}.",
            "This project is available under {}.", "License: {}", "SPDX-License-Identifier: {}", "The code is published under {}.",
            "All files are covered by {}.", "Use of this text is subject to {}.")

#: Shorter lines that name a licence; they only train.
SHORT = ("Covered by {}.", "Files covered by {}", "License {}", "Available under {}", "{} licensed")

#: Licences of no family here; they set the unknown class's threshold.
OTHERS = ("the Zlib License", "the Boost Software License 1.0", "the Artistic License 2.0", "the Eclipse Public License 2.0",
          "the European Union Public Licence 1.2", "the Acme Internal Licence", "the Open Data Commons Licence", "the ISC License",
          "the Vendor Evaluation License", "the SIL Open Font License 1.1", "the Microsoft Reference Source License",
          "the Q Public License", "the Community Data Licence", "the Zope Public License 2.1", "the Museum Image Licence 3",
          "the Harbour Licence", "the Orchard Licence", "the Lantern License", "the Compass License",
          "the Delta Licence", "the Meadow License", "the Winter License", "the Open Atlas License")

#: Short names of licences of no family here, most without a word that says licence.
OTHER_NAMES = ("Zlib", "BSL-1.0", "EPL-2.0", "OFL-1.1", "EUPL-1.2", "Artistic-2.0", "MS-PL", "the Unlicense", "NCSA", "PostgreSQL",
               "CDDL-1.1", "QPL-1.0", "GPL-1.0", "LPPL-1.3c", "CC BY-ND 3.0", "CC-BY-NC-ND-4.0", "0BSD", "OSL-3.0", "the Beerware terms")

#: Reservations of all rights: licence language that grants nothing, class 'unknown'.
RESERVED = ("All rights reserved.", "All rights are reserved.", "All rights reserved by the author.", "All Rights Reserved worldwide.",
            "Copyright 2019 by the publisher. All rights reserved.", "(c) 2021 The Company. All rights reserved.",
            "No part of this publication may be reproduced without written permission.")

PLAIN = ("He renewed his driving license in the spring.", "The public gave permission for the rights of way.",
         "An apache helicopter landed near the commons.", "She studied at MIT before moving abroad.",
         "The warranty on the kettle lasts two years.", "Creative people need public space.",
         "The copyright dispute went on for years.", "The public transport system is licensed by the city.",
         "Human rights are public rights.", "The attribution of the painting is disputed.", "We asked for permission to enter.",
         "The pub lost its licence last year.", "Add 5 cc of water to the mix.", "The house of commons voted late.",
         "The report was released under pressure.", "The garden is covered by snow.", "The fields are covered by water and mud.",
         "Her use of the text is subject to change.", "The house is available under the hill.", "The goods were distributed to the poor.",
         "This project is late.", "This work is hard and the days are long.", "The code is easy to read.",
         "The book was published by the old press.", "All people have rights.", "The seats are reserved for guests.",
         "The version of the story is not the same.", "It was the general opinion of the public.", "You may go if you must.",
         "The roof was covered by leaves.", "The costs are covered by the insurance.", "The shop is licensed to sell beer.",
         "He is licensed to drive a bus in two cities.", "Drinks are available under the tent.", "It was published by a small house in 1990.",
         "The price is subject to change.", "Copies were distributed to the members.", "The dog was released by its owner.",
         "The hall is covered by a glass roof and the stage by a cloth.", "The bus is available to all.", "The work is done under the bridge.",
         "Add the software to the list of conditions.", "In 2021 the company moved to the north.", "He sold 4.0 or 3 or 2.0 of it.",
         "The international conference and the foundation met.", "The author of the source is not known.",
         "That is what they had with them, and for the most part it was from there or as good as this.",
         "By then all of the others have been there.", "No part of the play was written in a day.",
         "Er kam mit dem Rad nach Hause.", "Mit der Zeit wird es besser.", "Sie sprach mit einer Frau und mit den Kindern.", "Mit.",
         "Das ist mit und ohne Zucker gut.", "Wir fahren mit.", "Mit einem Wort, es war in der Stadt am Abend zu still.",
         "A la casa de los padres no se va en coche.", "Il a vu un an de plus et des amis dans la rue.", "Et by by, or no.", "cc all of you")
#: Words that say nothing by themselves; each is a training line of class 'none'.
COMMON = ("the", "of", "and", "to", "in", "is", "it", "that", "this", "by", "a", "an", "or", "all", "are", "as", "at", "for", "from", "if",
          "may", "mit", "must", "no", "not", "on", "under", "use", "was", "with", "you", "your", "have", "has", "be", "can", "any", "been",
          "must give", "des", "die", "der", "en", "es", "la", "los", "que", "se", "v", "c", "s", "1", "2", "3", "4.0", "by the", "of the",
          "in the", "to the", "this is", "it is", "you may", "you must")

WORDS = r"[a-z0-9][a-z0-9.+\-/]*[a-z0-9]|[a-z0-9]"
#: True of every paragraph with a gram.
CANDIDATE = r"[A-Za-z0-9]"
MIN_SIMILARITY = 0.5
HELD_BACK = 4                    # every fourth notice calibrates, the others train
VOCABULARY = 16384


#: A line break inside a wrapped paragraph, with the comment sign after it.
WRAP = r"(?<=[\p{L}\p{N},;])[ \t]*\r?\n[ \t]*(?:(?:#+|//+|\*+|--)[ \t]*)?(?=[\p{Ll}(])"


def paragraphs_of(text: Column) -> Column:
    """The paragraphs of a text in order."""
    return F.split(F.regexp_replace(text, WRAP, " "), "\n")


def paragraph_words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(f"({WORDS})"), 1)


def word_grams(words: Column, n: int) -> Column:
    last = F.size(words) - (n - 1)
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))) \
        .otherwise(F.array().cast("array<string>"))


def with_features(df: DataFrame, first: list[str] | None = None) -> DataFrame:
    """Adds ``words`` and the distinct word 1- to 3-grams (``grams``) of column ``paragraph``; with
    ``first`` only the grams that begin with one of these words. Each is exploded from an array of
    one, so that filters on it do not compute it again."""
    df = df.withColumn("words", F.explode(F.array(paragraph_words(F.col("paragraph")))))
    words, at = F.col("words"), F.sequence(F.lit(1), F.size("words"))
    starts = F.filter(at, lambda i: i.between(1, F.size("words")) & (F.lit(True) if first is None else F.get(words, i - 1).isin(first)))
    # at the end of a line the missing words are left out and the gram is a repeat
    grams = F.transform(starts, lambda i: F.array(*[F.array_join(F.slice(words, i, n), " ") for n in (1, 2, 3)]))
    return df.withColumn("grams", F.explode(F.array(F.array_distinct(F.flatten(grams)))))


def plain_lines(held: bool) -> list[str]:
    """Every fourth plain line only calibrates."""
    return [s for i, s in enumerate(PLAIN) if (i % HELD_BACK == 3) == held]


def notices() -> list[tuple[str, str, bool]]:
    """(paragraph, class, held back) of the composed notices. Every fourth known notice is held
    back, and every notice of every other licence outside the families."""
    known = [(c.format(n), family) for family, names in NAMES.items() for n in names for c in CARRIERS]
    out = [(p, c, i % HELD_BACK == 0) for i, (p, c) in enumerate(known)]
    out += [(s, family, False) for family, sentences in SENTENCES.items() for s in sentences for _ in range(HELD_BACK)]
    # the empty line stands for lines without a known word
    out += [(s, "none", False) for s in plain_lines(held=False) for _ in range(HELD_BACK)]
    out += [(s, "none", False) for s in [*COMMON, *[""] * 16]]
    out += [(s, "unknown", False) for s in OTHER_SENTENCES for _ in range(HELD_BACK)]
    # forms that are no prose weigh more
    out += [(c.format(n), "unknown", False) for n in OTHER_NAMES for c in (*CARRIERS, *SHORT) for _ in range(HELD_BACK if ":" in c else 1)]
    out += [(p, family, False) for family, names in NAMES.items() for n in names if " " in n for p in sorted({n, n.removeprefix("the ")})]
    out += [(c.format(n), family, False) for family, names in NAMES.items() for n in names for c in SHORT]
    out += [(c.format(n), "unknown", i % 2 == 1) for i, n in enumerate(OTHERS) for c in CARRIERS
            for _ in range(1 if i % 2 else HELD_BACK)]
    out += [(c.format(n), "unknown", False) for i, n in enumerate(OTHERS) if i % 2 == 0 for c in SHORT]
    out += [(s, "unknown", False) for s in RESERVED for _ in range(HELD_BACK)]
    return out


def thinned(paragraph: str, every: int) -> str:
    """The paragraph without each ``every``-th word."""
    return " ".join(w for i, w in enumerate(paragraph.split(), 1) if i % every)


class LicenseModel:
    """Fitted on the composed notices: vocabulary, regression, temperature and threshold. ``calibration_error``
    is the mean gap between probability and share of right answers over ten bins of held-back lines."""

    def __init__(self, spark: SparkSession, min_similarity: float = MIN_SIMILARITY):
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import CountVectorizer
        from pyspark.ml.functions import vector_to_array
        self.classes, self.min_similarity = [*sorted(NAMES), "unknown", "none"], min_similarity
        lines = [(p, c, h, True) for p, c, h in notices()]
        lines += [(p, "none", True, True) for p in plain_lines(held=True)]
        lines += [(thinned(p, n), c, True, False) for p, c, h, _ in list(lines) if h for n in (2, 3)]
        rows = [(i, p, c, h, w, float(self.classes.index(c))) for i, (p, c, h, w) in enumerate(lines)]
        data = with_features(spark.createDataFrame(rows, "i int, paragraph string, class string, held boolean, whole boolean, label double")
                             .coalesce(1)).persist()
        train, held = data.filter("not held"), data.filter("held")
        self.vectors = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, binary=True).fit(train)
        self.regression = LogisticRegression(maxIter=60, regParam=0.001, elasticNetParam=0.2, family="multinomial").fit(
            self.vectors.transform(train))
        scored = self.regression.transform(self.vectors.transform(held)).orderBy("i").select(
            "class", "whole", vector_to_array("rawPrediction").alias("raw")).collect()
        data.unpersist()
        self.first_words = sorted({g.split(" ")[0] for g in self.vectors.vocabulary})
        self._calibrate([(r["class"], r["whole"], list(r["raw"])) for r in scored])
        templates = [(name, [sorted(_parts(t)) for t in sorted({p for p, c, h in notices() if c == name and not h} | set(NAMES[name]))])
                     for name in sorted(NAMES)]
        self.templates = spark.createDataFrame(templates, "named string, templates array<array<string>>")

    def _calibrate(self, scored) -> None:
        def soft(raw, t):
            top = max(raw)
            e = [math.exp((x - top) / t) for x in raw]
            return [x / sum(e) for x in e]

        families = len(self.classes) - 2
        grid = [0.1 * 1.15 ** k for k in range(40)]
        loss = {t: -sum(math.log(max(1e-12, soft(raw, t)[self.classes.index(c)])) for c, _, raw in scored) for t in grid}
        self.temperature = min(loss, key=lambda t: (round(loss[t], 6), t))
        answers = [(c, whole, soft(raw, self.temperature)) for c, whole, raw in scored]
        inside = [max(p[:families]) for c, whole, p in answers if whole and c in NAMES]
        outside = [max(p[:families]) for c, whole, p in answers if whole and c == "unknown"]
        bins = {}
        for c, _, p in answers:
            bins.setdefault(min(9, int(max(p) * 10)), []).append((max(p), self.classes[p.index(max(p))] == c))
        self.calibration_error = sum(abs(sum(x for x, _ in b) - sum(y for _, y in b)) for b in bins.values()) / max(1, len(answers))

        def balance(t):
            return sum(x >= t for x in inside) / len(inside) + sum(x < t for x in outside) / max(1, len(outside))

        best = max(round(balance(t / 200), 6) for t in range(1, 200))
        good = [t / 200 for t in range(1, 200) if round(balance(t / 200), 6) == best]
        self.threshold = good[len(good) // 2]

    def scored(self, lines: DataFrame) -> DataFrame:
        """``lines`` (column ``paragraph``) with ``named`` (the best family), ``best`` and ``other`` (calibrated
        probabilities of that family and of the unknown class) and whether ``none`` is likelier than all other
        classes together, line by line, no shuffle."""
        from pyspark.ml.functions import vector_to_array
        families = len(self.classes) - 2
        scored = self.regression.transform(self.vectors.transform(with_features(lines, self.first_words)))
        e = F.transform("raw", lambda x: F.exp((x - F.array_max("raw")) / F.lit(self.temperature)))
        p = F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b))
        for name, value in (("raw", vector_to_array("rawPrediction")), ("e", e), ("p", p)):
            scored = scored.withColumn(name, F.explode(F.array(value)))
        return (scored.withColumn("best", F.array_max(F.slice("p", 1, families)))
                .withColumn("other", F.element_at("p", families + 1))
                .withColumn("none", (F.size("grams") == 0) | (F.element_at("p", families + 2) >= 0.5))
                .withColumn("named", F.element_at(F.array(*[F.lit(c) for c in self.classes]),
                                                  F.array_position("p", F.col("best")).cast("int"))))

    def answered(self, scored: DataFrame) -> DataFrame:
        """Adds ``family``, ``probability`` and ``similarity`` to scored lines."""
        pairs = F.array_distinct(F.concat("words", word_grams(F.col("words"), 2)))
        shared = F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("pairs")))
                             / F.greatest(F.lit(1), F.least(F.size(t), F.size("pairs"))))
        family = (F.when(F.col("none"), F.lit("none"))
                  .when((F.col("best") < F.greatest("other", F.lit(self.threshold))) | (F.col("similarity") < self.min_similarity), F.lit("unknown"))
                  .otherwise(F.col("named")))
        return (scored.withColumn("pairs", pairs).join(F.broadcast(self.templates), "named")           # 11 rows
                .withColumn("similarity", F.array_max(shared)).withColumn("family", family)
                .withColumn("probability", F.round("best", 6)).withColumn("similarity", F.round("similarity", 6)))

    def classify(self, paragraphs: DataFrame) -> DataFrame:
        """One row per distinct ``paragraph``: ``family`` (a family, 'unknown' or 'none'),
        ``probability`` (calibrated, of the best family) and ``similarity`` to its templates."""
        return self.answered(self.scored(paragraphs.select("paragraph").distinct())).select(
            "paragraph", "family", "probability", "similarity")


def _parts(text: str) -> set[str]:
    """Words and word pairs."""
    import re
    words = re.findall(WORDS, text.lower())
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


def license_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """One row per licence paragraph: id, text hash, number of the paragraph (``line``), paragraph, family,
    probability and similarity. 'none' paragraphs do not appear."""
    model = LicenseModel(docs.sparkSession, min_similarity)
    lines = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .withColumn("text_hash", F.xxhash64("text"))
             .select("id", "text_hash", F.posexplode(paragraphs_of(F.col("text"))).alias("line", "paragraph"))
             .filter(F.col("paragraph").rlike(CANDIDATE)))
    found = model.scored(lines).filter(~F.col("none"))
    return model.answered(found).select("id", "text_hash", "line", "paragraph", "family", "probability",
                                        "similarity").dropDuplicates(["id", "text_hash", "line"])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """One row per document: id, ``license`` (family of its most probable confirmed paragraph, else
    'unknown' if it has a licence paragraph at all, else 'none'), that paragraph's ``probability`` and
    ``similarity``, the number of licence paragraphs and all families found."""
    found = license_paragraphs(docs, id_col, text_col, min_similarity)
    best = F.max(F.struct((F.col("family") != "unknown").alias("ok"), F.col("probability"), F.col("similarity"), F.col("family")))
    per = found.groupBy("id", "text_hash").agg(best.alias("best"), F.count(F.lit(1)).alias("n"),
                                               F.array_sort(F.collect_set("family")).alias("families"))
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"))
    return rows.join(per, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left").select(
        F.col("doc").alias(id_col), F.coalesce("best.family", F.lit("none")).alias("license"),
        F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"),
        F.array_join(F.coalesce("families", F.array().cast("array<string>")), ",").alias("families"))
