"""Licence recognition by sentences and rules, with built-in expressions only.

A text is split where a sentence can end; the pieces are normalised (ASCII letters in lower
case, digits, single blanks). A known licence sentence is one piece or several in a row, so line
ends, comment marks, colons, semicolons and "v." inside it do not hide it; the longest known
sentence at a piece wins. The
identifiers found, in order, form a row that is matched against ordered rules: a rule is
a row of identifiers and consumes what it matches, so a full text wins over a mere reference.
Every known sentence carries a licence word, so texts without one are not split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common

# Words that licence sentences carry, sentences as normalised, and rules.
LICENCE_WORDS = ("licen", "copyright", "rights reserved", "permission", "redistribut", "warrant", "spdx")
SENTENCES = {
    "licensed under the mit license": "mitRef",
    "released under the mit license": "mitRef",
    "this project is licensed under the mit license": "mitRef",
    "spdx license identifier mit": "mitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "asIs",
    "licensed under the apache license version 2 0": "apacheRef",
    "licensed under the apache license version 2 0 the license": "apacheRef",
    "released under the apache license version 2 0": "apacheRef",
    "spdx license identifier apache 2 0": "apacheRef",
    "you may not use this file except in compliance with the license": "apacheComply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apacheBasis",
    "see the license for the specific language governing permissions and limitations under the license": "apacheSee",
    "this work is licensed under the gnu general public license version 3": "gpl3Ref",
    "licensed under the gnu general public license version 3": "gpl3Ref",
    "spdx license identifier gpl 3 0 only": "gpl3Ref",
    "this work is licensed under the gnu general public license version 2": "gpl2Ref",
    "licensed under the gnu general public license version 2": "gpl2Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2Later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gplHope",
    "see the gnu general public license for more details": "gplSee",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsdIntro",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsdNames",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mplTerms",
    "licensed under the mozilla public license version 2 0": "mplTerms",
    "licensed under cc by 4 0": "ccByRef",
    "licensed under cc by sa 4 0": "ccBySaRef",
    "licensed under cc by nc 4 0": "ccByNcRef",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccByRef",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccBySaRef",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccByNcRef",
    "all rights reserved": "allRights",
}
RULES = (
    ("MIT", ("mitGrant", "mitNotice", "asIs")),
    ("MIT-incomplete", ("mitGrant", "mitNotice")),
    ("MIT-incomplete", ("mitGrant",)),
    ("Apache-2.0", ("apacheRef", "apacheComply", "apacheCopy", "apacheBasis", "apacheSee")),
    ("Apache-2.0", ("apacheRef", "apacheComply")),
    ("GPL-3.0-or-later", ("gpl3Later", "gplHope", "gplSee")),
    ("GPL-3.0-or-later", ("gpl3Later", "gplHope")),
    ("GPL-3.0-or-later", ("gpl3Later",)),
    ("GPL-2.0-or-later", ("gpl2Later", "gplHope", "gplSee")),
    ("GPL-2.0-or-later", ("gpl2Later", "gplHope")),
    ("GPL-2.0-or-later", ("gpl2Later",)),
    ("BSD-3-Clause", ("bsdIntro", "bsdSource", "bsdBinary", "bsdNames")),
    ("BSD-2-Clause", ("bsdIntro", "bsdSource", "bsdBinary")),
    ("MPL-2.0", ("mplTerms",)),
    ("Apache-2.0", ("apacheRef",)),
    ("GPL-3.0", ("gpl3Ref",)),
    ("GPL-2.0", ("gpl2Ref",)),
    ("MIT", ("mitRef",)),
    ("CC-BY-4.0", ("ccByRef",)),
    ("CC-BY-SA-4.0", ("ccBySaRef",)),
    ("CC-BY-NC-4.0", ("ccByNcRef",)),
    ("All-rights-reserved", ("allRights",)),
)
#: A sentence can end at punctuation before white space, or at a line end.
SENTENCE_END = r"[.!?;:]+[ \t]+|[.!?;:]*[\r\n]+"
#: Known sentences, longest first, in a row of normalised pieces, each after its mark; they begin and
#: end with a piece, and may be cut into pieces between any two words.
KNOWN = "[+-](?:" + "|".join(s.replace(" ", "[ +-]") for s in sorted(SENTENCES, key=len, reverse=True)) + ")(?![^+-])"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def marked(identifiers: tuple[str, ...]) -> str:
    """A row of identifiers as text, each in its own brackets."""
    return "".join(f"<{i}>" for i in identifiers)


def _carries(text: F.Column) -> F.Column:
    found = text.contains(LICENCE_WORDS[0])
    for word in LICENCE_WORDS[1:]:
        found = found | text.contains(word)
    return found


def _normal(sentence: F.Column) -> F.Column:
    return F.btrim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, licences, sentence_ids, n_known, n_unknown for every row of ``docs``.

    licences lists the rules that matched, in rule order, without repeats of one rule, joined by a
    semicolon; sentence_ids the known sentences in text order; n_unknown counts
    pieces with a licence word that are in no known sentence. NULL and empty texts, and texts without
    such sentences, give empty text and zeros. Repeated rows stay; an empty table
    gives no rows; other columns are not read.
    """
    common.prepare(docs.sparkSession)
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    rules = F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(marked(ids)).alias("ids")) for n, ids in RULES])
    lower = docs.select("doc_id", F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).alias("_lower"))
    # "rights reserved" may be wrapped; the other licence words are single words.
    some = _carries(F.col("_lower")) | F.col("_lower").contains("reserved")
    pieces = F.transform(
        F.split("_lower", SENTENCE_END),
        lambda s: F.concat(F.when(_carries(s), F.lit("+")).otherwise(F.lit("-")), _normal(s)),
    )
    laid = lower.select("doc_id", F.when(some, F.concat_ws("", F.filter(pieces, lambda p: p != "-"))).alias("_row"))
    named = laid.select(
        "doc_id",
        F.transform(
            F.regexp_extract_all("_row", F.lit(KNOWN), F.lit(0)),
            lambda s: F.element_at(known, F.ltrim(F.translate(s, "+-", "  "))),
        ).alias("_ids"),
        F.regexp_count(F.regexp_replace("_row", KNOWN, ""), F.lit("[+]")).alias("_left"),
    )
    counted = named.select(
        "doc_id",
        F.coalesce("_ids", F.array().cast("array<string>")).alias("_known"),
        F.coalesce("_left", F.lit(0)).alias("_unknown"),
    )
    start = F.struct(
        F.concat_ws("", F.transform("_known", lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("rest"),
        F.array().cast("array<string>").alias("found"),
    )

    def apply(state, rule):
        matched = F.struct(
            F.replace(state["rest"], rule["ids"], F.lit("<>")).alias("rest"),
            F.concat(state["found"], F.array(rule["licence"])).alias("found"),
        )
        return F.when(F.contains(state["rest"], rule["ids"]), matched).otherwise(state)

    matched = F.when(F.size("_known") > 0, F.aggregate(rules, start, apply, lambda s: F.concat_ws(";", s["found"])))
    return counted.select(
        "doc_id",
        F.coalesce(matched, F.lit("")).alias("licences"),
        F.concat_ws(";", "_known").alias("sentence_ids"),
        F.size("_known").cast("long").alias("n_known"),
        F.col("_unknown").cast("long").alias("n_unknown"),
    )
