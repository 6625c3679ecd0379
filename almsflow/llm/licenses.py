"""Licence scan by sentence rules, in column expressions only.

A text is normalised, and known licence sentences become identifiers in text order. A sentence
stands between two marks: a stop before white space or a line without letters or digits (hard), a
line end with the comment signs that open the next line (wrap), a semicolon or colon before white
space (pause). It may itself run over wraps and pauses, so a line and a wrapped sentence are both
found; of sentences that start at one mark the longest counts. Ordered rules then rewrite sequences
of identifiers to licence names, the longer and more specific rules first; what a rule has used,
later rules no longer see. Sentences, rules and names are data below; nothing is shuffled.

The SQL twin knows ``SENTENCES`` and ``RULES`` and one line at a time; wrapped texts and the
families of ``MORE_SENTENCES`` are found here only.

Defined cases: null and empty texts have no sentences and no licence; a sentence that occurs
twice counts twice; equal rows give equal results; only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Identifier -> licence sentences, normalised (lower case, a-z and 0-9, single spaces).
SENTENCES: dict[str, list[str]] = {
    "mit": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "apache2": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license"],
    "apache2-use": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "gpl3": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-warranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "cc-by-nc4": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"],
    "cc-by4": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0"],
    "cc0": ["this work is dedicated to the public domain", "released under cc0 1 0"],
    "reserved": ["all rights reserved"],
}
#: Ordered rules, sequence of identifiers -> licence.
RULES: list[tuple[tuple[str, ...], str]] = [
    (("mit-grant", "mit-notice", "as-is"), "MIT"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("apache2", "apache2-use", "apache2-copy"), "Apache-2.0"),
    (("gpl-free", "gpl-warranty"), "GPL-3.0-or-later"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("gpl-free",), "GPL-3.0-or-later"),
    (("gpl3",), "GPL-3.0-only"),
    (("apache2",), "Apache-2.0"),
    (("mit",), "MIT"),
    (("cc-by-nc4",), "CC-BY-NC-4.0"),
    (("cc-by4",), "CC-BY-4.0"),
    (("cc0",), "CC0-1.0"),
    (("reserved",), "All-Rights-Reserved"),
]

_FSF = "as published by the free software foundation either"
_LATER = "of the license or at your option any later version"
_ONLY = "as published by the free software foundation"
#: Further sentences. ``*`` stands for 1 to 12 words.
MORE_SENTENCES: dict[str, list[str]] = {
    "apache2-copy": ["you may obtain a copy of the license at", "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "bsd-advert": ["all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-endorse": ["neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
                    "neither the name of * nor the names of contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "gpl2-free": [f"this {x} is free software you can redistribute it and or modify it under the terms of the gnu general public license {_FSF} version 2 {_LATER}" for x in ("program", "file", "software", "library")],
    "gpl2-only": [f"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 {_ONLY}"],
    "lgpl21-free": [f"this {x} is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license {_FSF} version 2 1 {_LATER}" for x in ("library", "program", "file", "software")],
    "lgpl3-free": [f"this {x} is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license {_FSF} version 3 {_LATER}" for x in ("library", "program", "file", "software")],
    "agpl3-free": [f"this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license {_FSF} version 3 {_LATER}"],
    "mpl2": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
                  "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "bsl1": ["distributed under the boost software license version 1 0"],
    "bsl1-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "epl2": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"],
    "cc-by-sa4": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0",
                  "this work is licensed under a creative commons attribution sharealike 4 0 international license",
                  "this work is licensed under the creative commons attribution sharealike 4 0 international license"],
    "cc-by4": ["this work is licensed under a creative commons attribution 4 0 international license", "this work is licensed under the creative commons attribution 4 0 international license"],
    "cc-by-nc4": ["this work is licensed under a creative commons attribution noncommercial 4 0 international license", "this work is licensed under the creative commons attribution noncommercial 4 0 international license"],
}
#: Their rules, before the others.
MORE_RULES: list[tuple[tuple[str, ...], str]] = [
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse"), "BSD-4-Clause"),
    (("gpl2-free", "gpl-warranty"), "GPL-2.0-or-later"),
    (("gpl2-free",), "GPL-2.0-or-later"),
    (("gpl2-only",), "GPL-2.0-only"),
    (("lgpl21-free",), "LGPL-2.1-or-later"),
    (("lgpl3-free",), "LGPL-3.0-or-later"),
    (("agpl3-free",), "AGPL-3.0-or-later"),
    (("mpl2",), "MPL-2.0"),
    (("isc-grant",), "ISC"),
    (("zlib-grant",), "Zlib"),
    (("bsl1",), "BSL-1.0"),
    (("bsl1-grant",), "BSL-1.0"),
    (("unlicense",), "Unlicense"),
    (("epl2",), "EPL-2.0"),
    (("cc-by-sa4",), "CC-BY-SA-4.0"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HARD, WRAP, PAUSE = "\u0001", "\u0002", "\u0003"
#: In this order. Runs are single character classes, so that none of them nests.
MARKS = [
    (r"[.!?]+(?:\s+|$)", HARD),
    ("\n[^a-z0-9\u0001]*\n", HARD),
    ("\n[^a-z0-9\u0001]*", WRAP),
    ("[;:]+\\s*\u0002", HARD),
    (r"[;:]+(?:\s+|$)", PAUSE),
    ("[^a-z0-9\u0001\u0002\u0003]+", " "),
]
INNER = "[ \u0002\u0003]+"


def _known() -> dict[str, str]:
    """Sentence -> identifier."""
    return {s: name for data in (SENTENCES, MORE_SENTENCES) for name, texts in data.items() for s in texts}


def _pattern(sentence: str) -> str:
    return INNER.join("[a-z0-9]+(?:%s[a-z0-9]+){0,11}?" % INNER if w == "*" else w for w in sentence.split())


def sentences(text: Column) -> Column:
    """Known sentences in text order, normalised."""
    marked = F.translate(text, UPPER + WRAP + PAUSE, LOWER + "  ")
    for pattern, mark in MARKS:
        marked = F.regexp_replace(marked, pattern, mark)
    any_known = "|".join(_pattern(s) for s in sorted(_known(), key=lambda s: (-len(s), s)))
    found = F.regexp_extract_all(F.concat(F.lit(HARD), marked), F.lit(f"[\u0001-\u0003] ?({any_known})(?= ?(?:[\u0001-\u0003]|$))"), F.lit(1))
    return F.transform(found, lambda s: F.regexp_replace(s, INNER, " "))


def identifiers(found: Column) -> Column:
    """Identifiers of the known sentences, in order."""
    plain = {s: name for s, name in _known().items() if "*" not in s}
    table = F.create_map(*[F.lit(x) for pair in plain.items() for x in pair])

    def name_of(s: Column) -> Column:
        names = [F.when(s.rlike(f"^(?:{_pattern(p)})$"), F.lit(name)) for p, name in _known().items() if "*" in p]
        return F.coalesce(F.try_element_at(table, s), *names)

    return F.transform(found, name_of)


def apply_rules(ids: Column) -> Column:
    """Identifier sequence as text, every recognised run rewritten to ``[licence]``."""
    out = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    for sequence, name in MORE_RULES + RULES:
        out = F.replace(out, F.lit("".join(f"<{i}>" for i in sequence)), F.lit(f"[{name}]"))
    return out


def license_scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: number of known sentences, their identifiers, and licences in text order."""
    ids = docs.select(*keep, identifiers(sentences(F.coalesce(text, F.lit("")))).alias("_ids"))
    names = F.array_distinct(F.regexp_extract_all(apply_rules(F.col("_ids")), F.lit(r"\[([^\]]+)\]"), F.lit(1)))
    return ids.select(*keep, F.size("_ids").cast("long").alias("n_known"), F.array_join("_ids", ",").alias("sentence_ids"),
                      F.array_join(names, ",").alias("licenses"))
