"""License scans: a trained paragraph classifier, an unknown class with a calibrated limit, and template comparison.

Built from DataFrame functions and Spark's own logistic regression; no Python runs on executors. Paragraphs end at a line
feed, unless the line was hard-wrapped: it ends no sentence, and the next one starts with a small letter.
Features are hashed one- and two-word n-grams. The training rows are made from the templates below (cut at each sentence,
with and without words of the corpus around them, and cut into pieces as hard-wrapped texts have them) and, for the
unknown class, from paragraphs of a bounded sample of the corpus that share no word trigram with a template, and from
sentences about licences that name none. A quarter of these rows is held out: the model that scores has not seen them, and
its limits are found on them. Every paragraph is scored. A prediction counts if its probability reaches its family's
limit, above which held-out rows of both kinds have no wrong prediction, and if at least MIN_SHARED of some template's
word trigrams, or of the paragraph's own, are shared.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.llm.common import first_by_hash, stage, text_of

UNKNOWN = "unknown"
MIN_SHARED = 0.5
BUCKETS = 1 << 13
PIECE_WORDS = 7
# fixed values: sentences of common licences and of the notices that refer to them; one that several licences share is given to one
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU General Public License, version 2 or later.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "This software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed.",
        "Licensed under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "The author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.",
    ],
    "Zlib": [
        "Licensed under the zlib License.",
        "In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ],
    "Unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary.",
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software.",
    ],
    "EPL": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ],
    "EUPL": ["Licensed under the EUPL, version 1.2 or later.", "Licensed under the European Union Public Licence, version 1.2."],
    "Artistic-2.0": ["Licensed under the Artistic License 2.0.", "You may redistribute it under the terms of the Artistic License."],
    "OFL-1.1": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "PSF": ["Licensed under the Python Software Foundation License, version 2."],
    "MS-PL": ["Licensed under the Microsoft Public License.", "This source is subject to the Microsoft Public License (MS-PL)."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work.", "Dedicated to the public domain under CC0."],
    "All-rights-reserved": ["Copyright. All rights reserved.", "All rights reserved. No part of this publication may be reproduced without prior written permission."],
}
NEAR_MISSES = [
    "The licence of the restaurant was renewed last year.", "You need a driving license.", "He asked for permission to leave.",
    "The warranty of the car covers two years.", "Ask for copyright questions at the desk.", "She was licensed as a doctor under the old law.",
    "The terms of the contract are public.", "Version 2.0 of the app was released.", "Software is released under pressure.", "License plates are issued by the state.",
]


def paragraphs_of(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"(?<![.!?:\n\r])\r?\n(?=\p{Ll})", " "), "\n")


def tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def grams(words: Column, n: int) -> Column:
    """Word n-grams; the whole line if it has fewer words. words is bound once, so that no plan evaluates it for each n-gram."""

    def of(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, many).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))

    return F.get(F.transform(F.array(words), of), F.lit(0))


def _featured(rows: DataFrame) -> DataFrame:
    words = rows.withColumn("words", tokens(F.col("line")))
    words = words.withColumn("features_of", F.concat(F.col("words"), grams(F.col("words"), 2)))
    return HashingTF(numFeatures=BUCKETS, inputCol="features_of", outputCol="features", binary=True).transform(words)


@dataclass
class LicenseModel:
    regression: LogisticRegressionModel
    families: list[str]
    limits: dict[str, float]


def _templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, line string")


def _trigrams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)} or {" ".join(words)}


def _pieces() -> list[tuple[str, str]]:
    """Runs of PIECE_WORDS words of the longer templates, without those that another family has half of, too."""
    of = {f: set().union(*(_trigrams(_plain_words(t)) for t in ts)) for f, ts in TEMPLATES.items()}
    out = []
    for f, ts in TEMPLATES.items():
        for words in map(_plain_words, ts):
            for i in range(0, len(words) - PIECE_WORDS + 1 if len(words) > PIECE_WORDS else 0, 2):
                own = _trigrams(words[i : i + PIECE_WORDS])
                if all(len(own & o) < MIN_SHARED * len(own) for g, o in of.items() if g != f):
                    out.append((f, " ".join(words[i : i + PIECE_WORDS])))
    return out


def fit_licenses(docs: DataFrame, sample_rows: int = 500, text_col: str = "text", unknown_lines: int = 400, around_lines: int = 8) -> LicenseModel:
    """Train on rows made from the templates and on the paragraphs of at most sample_rows documents (the first by a hash).

    Of these paragraphs at most unknown_lines (the first by a hash) are trained on as unknown, and around_lines of them lend
    their first four words to stand around templates; limits are found on a quarter of the rows, by a hash, and on all
    other paragraphs of the sample, neither of which the model has seen. Null and empty texts give no paragraphs. Without any document the unknown class has the near misses alone.
    """
    spark = docs.sparkSession
    families = [UNKNOWN, *sorted(TEMPLATES)]
    number = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(families) for x in (f, float(i))]), F.col("family"))
    some = first_by_hash(docs.select(text_of(text_col).alias("text")).where("text <> ''"), sample_rows, "text")
    lines = some.select(F.explode(paragraphs_of(F.col("text"))).alias("line"))
    known = F.array(*map(F.lit, sorted(set().union(*(_trigrams(_plain_words(t)) for ts in TEMPLATES.values() for t in ts)))))
    plain = stage(lines.where(~F.arrays_overlap(grams(tokens(F.col("line")), 3), known)).select("line").distinct(), "op6-plain")
    noise = F.slice(F.split("line", " "), 1, 4)
    around = plain.orderBy(F.xxhash64("line"), "line").limit(around_lines).select(F.array_join(noise, " ").alias("noise")).unionByName(spark.createDataFrame([("",), ("Copyright 2021",), ("Code is",)], "noise string"))
    made = _templates(spark).join(around.withColumn("k", F.lit(1)), F.lit(1) == F.col("k"))
    made = made.select("family", F.explode(F.array(F.concat_ws(" ", "noise", "line"), F.concat_ws(" ", "line", "noise"), F.lower("line"), F.upper("line"))).alias("line"))
    made = made.unionByName(spark.createDataFrame(_pieces(), "family string, line string").select("family", F.explode(F.array("line", F.upper("line"))).alias("line")))
    misses = spark.createDataFrame([(x,) for x in NEAR_MISSES], "line string")
    misses = misses.select(F.explode(F.array(F.col("line"), F.lower("line"), F.upper("line"))).alias("line"))
    few = plain.orderBy(F.xxhash64("line"), "line").limit(unknown_lines)
    unknown = few.unionByName(misses).select(F.lit(UNKNOWN).alias("family"), "line")
    rows = stage(_featured(made.unionByName(unknown).distinct()).select("family", "line", "features", number.alias("label")), "op6-train")
    fit = LogisticRegression(maxIter=40, regParam=0.002, family="multinomial")
    part = F.pmod(F.xxhash64("line"), F.lit(4)) == 0
    model = fit.fit(rows.where(~part))
    rest = _featured(plain.join(few, "line", "left_anti").select(F.lit(UNKNOWN).alias("family"), "line")).select("family", "line", "features", F.lit(0.0).alias("label"))
    held = model.transform(rows.where(part).unionByName(rest)).select("label", "prediction", F.array_max(vector_to_array("probability")).alias("p"))
    # smallest limit above all wrong predictions of a family, so that the unknown class takes what is uncertain
    wrong = {families[int(r.prediction)]: r.p for r in held.where("prediction <> label and prediction <> 0").groupBy("prediction").agg(F.max("p").alias("p")).collect()}
    return LicenseModel(model, families, {f: max(0.5, wrong.get(f, 0.0) + 1e-6) for f in families})


def paragraphs(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scored paragraphs: key (128 bits) and doc_id of the row, line number from 0, line, family, probability, shared, confirmed."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("key", _key(F.col("doc_id"), F.col("text")))
    lines = base.where("text <> ''").select("key", "doc_id", F.posexplode(paragraphs_of(F.col("text"))).alias("at", "line"))
    scored = model.regression.transform(_featured(lines)).withColumn("p", vector_to_array("probability"))
    scored = scored.withColumn("family", F.element_at(F.array(*map(F.lit, model.families)), F.col("prediction").cast("int") + 1)).withColumn("probability", F.array_max("p"))
    limit = F.element_at(F.array(*[F.lit(model.limits[f]) for f in model.families]), F.col("prediction").cast("int") + 1)
    scored = scored.withColumn("family", F.when(F.col("probability") >= limit, F.col("family")).otherwise(UNKNOWN))
    own = F.when(F.col("family") != UNKNOWN, grams(F.col("words"), 3))
    # some dozens of fixed templates, as one map that the optimizer makes once
    made = F.from_json(F.lit(json.dumps({f: [sorted(_trigrams(_plain_words(t))) for t in ts] for f, ts in TEMPLATES.items()})), "map<string, array<array<string>>>")

    def share(three: Column) -> Column:
        both = F.size(F.array_intersect("trigrams", three))
        return F.greatest(both / F.size(three), F.when(F.size("trigrams") >= 3, both / F.size("trigrams")).otherwise(0.0))

    shares = F.when(F.col("family") == UNKNOWN, 0.0).otherwise(F.array_max(F.transform(F.element_at(made, F.col("family")), share)))
    scored = scored.withColumn("trigrams", own).withColumn("shared", shares)
    return scored.select("key", "doc_id", "at", "line", "family", "probability", "shared", ((F.col("family") != UNKNOWN) & (F.col("shared") >= MIN_SHARED)).alias("confirmed"))


def _key(doc_id: Column, text: Column) -> Column:
    """128 bits of an id and a text, so that rows share results only if they are equal in both."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), text)))


def _plain_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def license_scan(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_paragraphs, n_licensed, families (sorted), family (most probable), probability.

    A document without a confirmed paragraph has family "unknown" if a paragraph was taken for a licence and not
    confirmed, else null. Null and empty texts have no paragraphs; a null id stays null; rows that repeat id and text get
    equal results; an empty table gives an empty result. Only id and text are read.
    """
    found = paragraphs(docs, model, id_col, text_col)
    sure = F.col("confirmed")
    # rows that repeat id and text have one key; each has a line 0
    found = found.groupBy("key").agg((F.count_if(sure) / F.count_if(F.col("at") == 0)).cast("long").alias("n_licensed"), F.array_sort(F.collect_set(F.when(sure, F.col("family")))).alias("families"), F.max(F.when(sure, F.struct("probability", "family"))).alias("best"), F.max(F.when(F.col("family") != UNKNOWN, F.lit(True))).alias("some"))
    text = text_of(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(F.col(id_col).cast("long"), text).alias("key"), F.when(text == "", 0).otherwise(F.array_size(paragraphs_of(text))).cast("long").alias("n_paragraphs"))
    out = base.join(found, "key", "left")
    family = F.coalesce(F.col("best.family"), F.when(F.col("some"), F.lit(UNKNOWN)))
    return out.select("doc_id", "n_paragraphs", F.coalesce("n_licensed", F.lit(0)).alias("n_licensed"), F.coalesce("families", F.array().cast("array<string>")).alias("families"), family.alias("family"), F.round("best.probability", 6).alias("probability"))
