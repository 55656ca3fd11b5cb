"""Licence scan by sentence rules (native: DataFrame functions only).

1. A text is cut into pieces: after ``. ! ? ; :`` followed by white space and
   at line ends; pieces without a letter or digit don't count.  Its words are
   lower case and joined by one sign each: a space inside a piece, ``/`` at a
   single line end, ``.`` after a sentence or at an empty line.  The holder and
   years of a copyright line are dropped.
2. The known licence sentences are found in that row of words, wherever their
   lines are wrapped and whatever marks the cut sets inside them ("v. 2.0",
   "Identifier: MIT").  A known sentence begins and ends with a piece; one that
   the table leaves unfinished (no mark at its end) may go on with another
   known one in the same piece.
3. Known sentences that follow each other directly form a sequence of
   identifiers.  The ordered rules are tried at its first identifier: the
   first rule that fits there names the licence and takes its sentences, and
   so on after them.  A known sentence that no rule takes is ``UNKNOWN``.

Only sentences that are known leave the scan: the table of sentences is a
fixed, small list, so they are found by one expression, the lookup of their
identifiers is a broadcast join inside the scan's stage, and what is shuffled
afterwards is one small row for each licence sentence.

Defined results: one row for each licence found in a document, none for a
document without; null and empty texts have none; repeated rows are scanned
each on its own and so repeat their results; a null id is carried as it is;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Public licence notices, sentence by sentence or in parts of
#: sentences.  A number at the beginning stands for any item mark or none.
SENTENCES = {
    "a01": "Licensed under the Apache License, Version 2.0.",
    "a02": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "a03": "you may not use this file except in compliance with the License.",
    "a04": "You may obtain a copy of the License at",
    "a05": "http://www.apache.org/licenses/LICENSE-2.0",
    "a06": "Unless required by applicable law or agreed to in writing, software",
    "a07": "distributed under the License is distributed on an \"AS IS\" BASIS,",
    "a08": "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "a09": "See the License for the specific language governing permissions and",
    "a10": "limitations under the License.",
    "a11": "SPDX-License-Identifier: Apache-2.0",
    "b01": "Redistribution and use in source and binary forms, with or without",
    "b02": "modification, are permitted provided that the following conditions are met:",
    "b03": "3. Neither the name of the copyright holder nor the names of its",
    "b04": "SPDX-License-Identifier: BSD-3-Clause",
    "b05": "SPDX-License-Identifier: BSD-2-Clause",
    "b06": "Released under the BSD License.",
    "b07": "1. Redistributions of source code must retain the above copyright notice, "
           "this list of conditions and the following disclaimer.",
    "b08": "2. Redistributions in binary form must reproduce the above copyright notice, "
           "this list of conditions and the following disclaimer in the documentation "
           "and/or other materials provided with the distribution.",
    "b09": "contributors may be used to endorse or promote products derived from this "
           "software without specific prior written permission.",
    "c01": "Licensed under CC BY-NC 4.0.",
    "c02": "Licensed under CC BY 4.0.",
    "c03": "Licensed under CC BY-SA 4.0.",
    "c04": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "c05": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "c06": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "c07": "This work is dedicated to the public domain.",
    "g01": "This work is licensed under the GNU General Public License, version 3.",
    "g02": "This program is free software: you can redistribute it and/or modify",
    "g03": "it under the terms of the GNU General Public License as published by",
    "g04": "the Free Software Foundation; either version 3 of the License, or",
    "g05": "(at your option) any later version.",
    "g06": "the Free Software Foundation; either version 2 of the License, or",
    "g07": "SPDX-License-Identifier: GPL-3.0-or-later",
    "g08": "SPDX-License-Identifier: GPL-3.0-only",
    "m01": "Released under the MIT License.",
    "m02": "Licensed under the MIT License.",
    "m03": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "m04": "SPDX-License-Identifier: MIT",
    "m05": "of this software and associated documentation files (the \"Software\"), to deal "
           "in the Software without restriction, including without limitation the rights to "
           "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
           "the Software, and to permit persons to whom the Software is furnished to do so, "
           "subject to the following conditions:",
    "p01": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "p02": "SPDX-License-Identifier: MPL-2.0",
    "r01": "copyright notice",
    "r02": "All rights reserved.",
}

#: Licence and the sequence of sentences that names it, in the
#: order in which the rules are tried.
RULES = [
    ("Apache-2.0", "a02 a03 a04 a05 a06 a07 a08 a09 a10"),
    ("Apache-2.0", "a02 a03 a04 a05"),
    ("Apache-2.0", "a02 a03"),
    ("Apache-2.0", "a01"),
    ("Apache-2.0", "a11"),
    ("BSD-3-Clause", "b01 b02 b07 b08 b03 b09"),
    ("BSD-3-Clause", "b01 b02 b07 b08 b03"),
    ("BSD-3-Clause", "b01 b02 b03 b09"),
    ("BSD-3-Clause", "b01 b02 b03"),
    ("BSD-2-Clause", "b01 b02 b07 b08"),
    ("BSD-2-Clause", "b01 b02"),
    ("BSD-3-Clause", "b04"),
    ("BSD-2-Clause", "b05"),
    ("BSD", "b06"),
    ("CC-BY-NC-4.0", "c01"),
    ("CC-BY-4.0", "c02"),
    ("CC-BY-SA-4.0", "c03"),
    ("CC-BY-4.0", "c04"),
    ("CC-BY-NC-4.0", "c05"),
    ("CC-BY-SA-4.0", "c06"),
    ("CC0-1.0", "c07"),
    ("GPL-3.0-or-later", "g02 g03 g04 g05"),
    ("GPL-2.0-or-later", "g02 g03 g06 g05"),
    ("GPL-3.0-only", "g01"),
    ("GPL-3.0-or-later", "g07"),
    ("GPL-3.0-only", "g08"),
    ("MIT", "m01"),
    ("MIT", "m02"),
    ("MIT", "m03 m05"),
    ("MIT", "m03"),
    ("MIT", "m04"),
    ("MPL-2.0", "p01"),
    ("MPL-2.0", "p02"),
    ("all-rights-reserved", "r01 r02"),
    ("all-rights-reserved", "r02"),
    ("copyright-notice", "r01"),
]
UNKNOWN = "UNKNOWN"


def words(text: Column) -> Column:
    """The words of a text, joined by `` ``, ``/`` and ``.`` (see above)."""
    marked = F.regexp_replace(F.regexp_replace(text, r"[.!?;:][ \t\r\n]+", "\n\n"), r"\r\n?", "\n")
    plain = F.lower(F.regexp_replace(marked, r"[^A-Za-z0-9\n]+", " "))
    joined = F.regexp_replace(F.regexp_replace(plain, r" ?\n ?\n[ \n]*+", "."), r" ?\n ?", "/")
    return F.regexp_replace(F.btrim(joined, F.lit(" ./")), r"(?<![a-z0-9 ])copyright( c)?( [0-9]{4})+ [a-z0-9 ]*+",
                            SENTENCES["r01"])


_MARKS = "0123456789abcdefghijklmnopqrstuvwxyz"
_ITEM = r"^\(?[0-9a-z][.)] +"


def known_words(sentence: str) -> str:
    """The words of a known sentence, without item mark."""
    return " ".join(re.findall("[a-z0-9]+", re.sub(_ITEM, "", sentence).lower()))


def expression(sentence: str) -> str:
    """Finds a known sentence in ``words(text)``."""
    cut = re.split(r"(?<=[.!?;:])\s+", re.sub(_ITEM, "", sentence).strip())
    found = "[ ./]".join("[ /]".join(known_words(part).split()) for part in cut)
    item = r"(?:(?<![a-z0-9 ])[0-9a-z][ ./])?" if re.match(_ITEM, sentence) else ""
    return item + found + ("(?![a-z0-9 ])" if sentence.rstrip()[-1] in ".!?;:" else "")


def known_sentences(spark, table: dict[str, str]) -> DataFrame:
    """Identifiers of all forms in which the words of a known sentence are found."""
    forms = [(code, mark + known_words(s)) for code, s in table.items()
             for mark in ["", *(c + " " for c in _MARKS if re.match(_ITEM, s))]]
    return spark.createDataFrame(forms, "code string, norm string")


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  table: dict[str, str] = SENTENCES,
                  rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``(<id>, license, first_sentence, last_sentence, sentence_codes)``, one
    row for each licence found; sentences count from 0."""
    spark = docs.sparkSession
    any_known = "|".join(expression(s) for s in sorted(table.values(), key=len, reverse=True))
    # every row is scanned by itself, whatever its id; a part ends with a known
    # sentence and the sign after it, but for the last part of a text; outer,
    # else the whole scan would run a second time to filter out empty arrays
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.split(
        F.regexp_replace(words(F.col(text_col)), f"(?<![a-z0-9])(?:{any_known})(?![a-z0-9])(?=(.?))", "\t$0\t$1\n"),
        "\n").alias("_parts"))
    parts = (rows.select("_row", "_id", F.posexplode_outer("_parts").alias("_n", "_part"))
             .where(F.col("_part").contains("\t")))
    signs = lambda c: F.length(F.regexp_replace(c, "[^./]", ""))
    part = F.split("_part", "\t")
    hits = (parts.select("_row", "_id", "_n", part[0].alias("_gap"), part[1].alias("_hit"), part[2].alias("_next"))
            .select("_row", "_id", "_n", signs(F.col("_gap")).alias("_before"), signs(F.col("_hit")).alias("_inside"),
                    F.coalesce((F.col("_n") > 0) & (F.length("_gap") == 1), F.lit(False)).alias("_joined"),
                    F.col("_gap").endswith(" ").alias("_spaced"), (F.col("_next") == " ").alias("_open"),
                    F.translate("_hit", "./", "  ").alias("norm"))
            .join(F.broadcast(known_sentences(spark, table)), "norm").drop("norm"))
    by_row = Window.partitionBy("_row").orderBy("_n")
    # sentences of one piece stand or fall together
    within = F.col("_joined") & F.col("_spaced")
    placed = (hits.withColumn("_to", F.sum(F.col("_before") + F.col("_inside")).over(by_row))
              .withColumn("_piece", F.sum(F.when(within, 0).otherwise(1)).over(by_row))
              .withColumn("_whole", (within | ~F.col("_spaced")) &
                          (~F.col("_open") | F.coalesce(F.lead(within).over(by_row), F.lit(False))))
              .withColumn("_whole", F.min("_whole").over(Window.partitionBy("_row", "_piece")))
              .withColumn("_run", F.sum(F.when(F.col("_joined") & F.lag("_whole").over(by_row), 0).otherwise(1)).over(by_row))
              .where("_whole"))
    runs = (placed.groupBy("_row", "_run")
            .agg(F.first("_id").alias("_id"), F.array_sort(F.collect_list(F.struct(
                "_n", "code", (F.col("_to") - F.col("_inside")).cast("int").alias("from"),
                F.col("_to").cast("int").alias("to")))).alias("_hits"))
            .withColumn("_codes", F.array_join("_hits.code", " ")))
    width = len(next(iter(table))) + 1
    any_rule = "|".join([*(codes for _, codes in rules), f"[^ ]{{{width - 1}}}"])
    names = spark.createDataFrame(rules, "license string, sentence_codes string").dropDuplicates(["sentence_codes"])
    found = F.expr(f"regexp_extract_all(_codes, '({any_rule})', 1)")
    # one element for each known sentence again, with the rule that took it
    taken = F.flatten(F.transform(found, lambda codes, n: F.array_repeat(
        F.struct(n.alias("n"), codes.alias("sentence_codes")), ((F.length(codes) + 1) / width).cast("int"))))
    return (runs.select("_row", "_run", "_id", F.inline(F.arrays_zip(F.col("_hits").alias("hit"), taken.alias("rule"))))
            .groupBy("_row", "_run", "rule.n")
            .agg(F.first("_id").alias("_id"), F.first("rule.sentence_codes").alias("sentence_codes"),
                 F.min("hit.from").alias("first_sentence"), F.max("hit.to").alias("last_sentence"))
            .join(F.broadcast(names), "sentence_codes", "left")
            .select(F.col("_id").alias(id_col), F.coalesce("license", F.lit(UNKNOWN)).alias("license"),
                    "first_sentence", "last_sentence", "sentence_codes"))
