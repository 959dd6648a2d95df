"""Licence recognition: known sentences in order, by DataFrame functions only.

A text is normalised (lower case, all other characters than letters and digits as space).  Known
sentences are found as whole word runs wherever they stand, so wrapping, comment marks and what
stands before a sentence do not matter.  Rules then match the order of their identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import lower_ascii, text_or_empty

# Sentences of public licences, normalised (lower case, runs of other characters
# than letters and digits as one space).
TEXTS = {
    "apache2_grant": "licensed under the apache license version 2 0 the license",
    "apache2_use": "you may not use this file except in compliance with the license",
    "apache2_copy": "you may obtain a copy of the license at",
    "apache2_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "lgpl21_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl_hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "agpl3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "epl2_grant": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
    "epl2_grant_v": "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0",
    "epl1_grant": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0",
    "bsd_as_is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "zlib_grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "reserved": "all rights reserved",
}
# What one-line statements call a licence ("licensed under the ..."), by its SPDX identifier.
NAMED = {
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license"),
    "MIT": ("mit license", "mit licence", "mit x11 license"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"),
    "ISC": ("isc license",),
    "GPL-2.0-only": ("gnu general public license version 2", "gnu gpl version 2", "gpl v2", "gplv2"),
    "GPL-3.0-only": ("gnu general public license version 3", "gnu gpl version 3", "gpl v3", "gplv3"),
    "LGPL-2.1-only": ("gnu lesser general public license version 2 1", "lgpl v2 1", "lgplv2 1"),
    "LGPL-3.0-only": ("gnu lesser general public license version 3", "lgpl v3", "lgplv3"),
    "AGPL-3.0-only": ("gnu affero general public license version 3", "agpl v3", "agplv3"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0"),
    "EPL-1.0": ("eclipse public license v1 0", "eclipse public license version 1 0"),
    "EPL-2.0": ("eclipse public license 2 0", "eclipse public license v2 0", "eclipse public license version 2 0"),
    "BSL-1.0": ("boost software license version 1 0",),
    "Zlib": ("zlib license",),
    "Unlicense": ("unlicense",),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC0-1.0": ("cc0 1 0", "cc0"),
    "GPL-2.0-or-later": ("gnu general public license version 2 or later", "gnu general public license version 2 or any later version", "gpl v2 or later"),
    "GPL-3.0-or-later": ("gnu general public license version 3 or later", "gnu general public license version 3 or any later version", "gpl v3 or later"),
}
# SPDX identifiers that only tags use.
TAGGED = ("LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later",
          "0BSD", "MIT-0", "BSD-3-Clause-Clear", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
VERBS = ("licensed", "released", "distributed", "published", "available", "provided", "covered")


def _key(name: str) -> str:
    return name.lower().replace("-", "_").replace(".", "_")


def _plain(name: str) -> str:
    return name.lower().replace("-", " ").replace(".", " ")


# The identifier of each normalised sentence: one for a licence's one-line statements, one for its tag.
SENTENCES = {sentence: name for name, sentence in TEXTS.items()}
SENTENCES |= {f"under {name}": f"{_key(spdx)}_line" for spdx, names in NAMED.items() for name in names}
SENTENCES |= {f"spdx license identifier {_plain(spdx)}": f"{_key(spdx)}_tag" for spdx in (*NAMED, *TAGGED)}
# Ordered rules over the identifiers found in a text, in text order: the first that fits takes
# its sentences, later rules see what is left.
RULES = (
    ("Apache-2.0", ("apache2_grant", "apache2_use", "apache2_copy", "apache2_basis")),
    ("Apache-2.0", ("apache2_grant", "apache2_use")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_hope")),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_hope")),
    ("BSD-3-Clause", ("reserved", "bsd_grant", "bsd_endorse")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_endorse")),
    ("BSD-2-Clause", ("reserved", "bsd_grant")),
    ("Apache-2.0", ("apache2_grant",)),
    ("Apache-2.0", ("apache2_use",)),
    ("AGPL-3.0-or-later", ("agpl3_free",)),
    ("LGPL-2.1-or-later", ("lgpl21_free",)),
    ("LGPL-3.0-or-later", ("lgpl3_free",)),
    ("MIT", ("mit_grant",)),
    ("GPL-3.0-or-later", ("gpl_free",)),
    ("GPL-2.0-or-later", ("gpl2_free",)),
    ("BSD-2-Clause", ("bsd_grant",)),
    ("ISC", ("isc_grant",)),
    ("MPL-2.0", ("mpl2",)),
    ("Unlicense", ("unlicense",)),
    ("EPL-2.0", ("epl2_grant",)),
    ("EPL-2.0", ("epl2_grant_v",)),
    ("EPL-1.0", ("epl1_grant",)),
    ("Zlib", ("zlib_grant",)),
    ("CC0-1.0", ("cc0",)),
    *((name, (f"{_key(name)}_line",)) for name in NAMED),
    *((name, (f"{_key(name)}_tag",)) for name in (*NAMED, *TAGGED)),
    ("Proprietary", ("reserved",)),
)
OPENING = f"(?:{'|'.join(VERBS)}) under (?:the terms of the |the |an |a )?"
#: Every known sentence has one of these words, or one of the verbs before "under".
CUES = ("licen", "warrant", "permission", "reserved", "redistribut", "copyright", "unencumbered")
CUE = f"{'|'.join(CUES)}|(?:{'|'.join(VERBS)})[^a-z0-9]+under"

LONG_RULES = [rule for rule in RULES if len(rule[1]) > 1]
SHORT_RULES = RULES[len(LONG_RULES):]

assert all(any(c in s for c in CUES) for s in TEXTS.values())
assert all(len(sequence) == 1 for _, sequence in SHORT_RULES)


def _any_of(sentences) -> str:
    return "|".join(sorted(sentences, key=lambda s: (-len(s), s)))


# Words stand between double spaces, so that matches of whole words need no look-around.
PATTERN = (
    f" (?:not )?(?:{_any_of(TEXTS.values())}|{OPENING}(?:{_any_of(n for names in NAMED.values() for n in names)})"
    f"|spdx license identifier (?:{_any_of(map(_plain, (*NAMED, *TAGGED)))})) ").replace(" ", "  ")[1:-1]


def licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences stated in each text.

    Returns id, sentences (identifiers of the known sentences, in text order, comma-joined), licenses
    (identifiers by ordered rule, comma-joined, each once) and n_licenses.  Of known sentences that
    begin at the same word the longest counts, and sentences do not overlap; one after "not" does not
    count.  A rule matches identifiers that follow each other; other text in between does not matter.
    Texts that are null, empty or state none have '' and 0.  One row for each input row.  Time is linear
    in the text.
    """
    text = text_or_empty(text_col)
    table = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    words = F.concat(F.lit("  "), F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", "  ")), F.lit("  "))
    hits = F.transform(
        F.regexp_extract_all(words, F.lit(PATTERN), F.lit(0)), lambda hit: F.trim(F.replace(hit, F.lit("  "), F.lit(" "))))
    ids = F.array_compact(F.transform(hits, lambda hit: F.coalesce(
        F.try_element_at(table, hit), F.try_element_at(table, F.regexp_replace(hit, f"^{OPENING}", "under ")))))
    cued = lower_ascii(text).rlike(CUE)
    rows = df.select(F.col(id_col).alias("id"), F.when(cued, ids).otherwise(F.array().cast("array<string>")).alias("ids"))
    rows = rows.select("id", F.array_join("ids", ",").alias("sentences"))
    rest, names = F.concat(F.lit(","), F.replace("sentences", F.lit(","), F.lit(",,")), F.lit(",")), []
    for name, sequence in LONG_RULES:
        part = F.lit("".join(f",{s}," for s in sequence))
        names.append(F.when(rest.contains(part), F.lit(name)))
        rest = F.replace(rest, part, F.lit("|"))
    # Rules of one sentence do not depend on each other.
    short = F.array(*[F.struct(F.lit(f",{one},").alias("part"), F.lit(name).alias("name")) for name, (one,) in SHORT_RULES])
    alone = F.filter(short, lambda rule: F.contains(rest, rule["part"]))
    found = F.concat(F.array_compact(F.array(*names)), F.transform(alone, lambda rule: rule["name"]))
    some = F.when(F.col("sentences") == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(found))
    return rows.select(
        F.col("id").alias(id_col), "sentences", some.alias("found")
    ).select(id_col, "sentences", F.array_join("found", ",").alias("licenses"), F.size("found").alias("n_licenses"))
