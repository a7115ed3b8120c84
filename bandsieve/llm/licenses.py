"""Licence scans by sentence rules, in DataFrame operations only.

A text is cut into sentences: at lines without a letter or digit, and at . ! ? : ; before white space and a capital, but not behind SPDX-License-Identifier. Line ends
inside a sentence, comment marks at lines' beginnings and all other characters are normalised away (lower case, only letters, digits and pluses, single
spaces), so hard-wrapped notices read like plain ones. Each sentence is mapped to the identifiers of the known licence sentences
whose wording it holds, whole words only, the more specific first, and no word counts twice. The sequence of identifiers is then matched
against ordered rules: a rule's identifiers must stand next to each other (unknown sentences in between don't count), what matches is taken out of
the sequence, and later rules see the rest. What is left is reported as unmatched.

Every known wording holds one of the cues, each a part of one word and so the same in raw and in normalised text, or the words cc by (asserted
when the table is made); texts and sentences without any cue are not looked at further. Null and empty texts have no sentences: licenses is '' and the counts are 0. Repeated
rows each get their own row. Extra columns don't matter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cues, the wording of known licence sentences (normalised), and rules.
CUES = ("licen", "permission", "redistribut", "warrant", "domain", "cc0", "commons", "gpl", "spdx")

_LEADS = ("under", "under a", "under an", "under the", "under the terms of the")
_FSF = ("", " as published by the free software foundation")
_GNU = {"agpl": "gnu affero general public license", "lgpl": "gnu lesser general public license", "gpl": "gnu general public license"}
_VERSIONS = (("agpl", "3"), ("lgpl", "3"), ("lgpl", "2 1"), ("gpl", "3"), ("gpl", "2"))
_CC = (("by nc nd", "noncommercial noderivatives"), ("by nc sa", "noncommercial sharealike"), ("by nc", "noncommercial"), ("by nd", "noderivatives"), ("by sa", "sharealike"), ("by", ""))

RULES = (
    ("Apache-2.0", ("apache2", "apache_comply", "apache_basis")),
    ("Apache-2.0", ("apache2", "apache_comply")),
    ("Apache-2.0", ("apache2",)),
    ("MIT", ("mit_grant", "mit_notice", "as_is")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_line",)),
    ("ISC", ("isc_grant", "isc_notice", "as_is")),
    ("ISC", ("isc_grant", "isc_notice")),
    ("ISC", ("isc_grant", "as_is")),
    ("ISC", ("isc_grant",)),
    ("ISC", ("isc_line",)),
    ("BSL-1.0", ("bsl_grant", "as_is")),
    ("BSL-1.0", ("bsl_grant",)),
    ("Zlib", ("zlib_as_is", "zlib_grant")),
    ("Zlib", ("zlib_grant",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_name", "bsd_as_is")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_name")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD-3-Clause", ("bsd3_line",)),
    ("BSD-2-Clause", ("bsd2_line",)),
    ("BSD", ("bsd_line",)),
    *(
        (f"{family.upper()}-{version.replace(' ', '.') if ' ' in version else version + '.0'}{more}", (f"{family}{version.replace(' ', '')}{tail}", *rest))
        for family, version in _VERSIONS
        for more, tail in (("-or-later", "_later"), ("", ""))
        for rest in (("gnu_hope", f"{family}_copy"), ("gnu_hope",), (f"{family}_copy",), ())
    ),
    *((family.upper(), (f"{family}_any", *rest)) for family in _GNU for rest in (("gnu_hope", f"{family}_copy"), ())),
    ("MPL-2.0", ("mpl2",)),
    ("EPL-2.0", ("epl2",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    *((f"CC-{kind.upper().replace(' ', '-')}", (f"cc_{kind.replace(' ', '_')}",)) for kind, _ in _CC),
)

#: Identifiers after 'SPDX-License-Identifier:', each with the rule that it stands for.
SPDX = {
    "Apache-2.0": "Apache-2.0", "MIT": "MIT", "ISC": "ISC", "BSL-1.0": "BSL-1.0", "Zlib": "Zlib", "BSD-3-Clause": "BSD-3-Clause", "BSD-2-Clause": "BSD-2-Clause",
    "AGPL-3.0-or-later": "AGPL-3.0-or-later", "AGPL-3.0+": "AGPL-3.0-or-later", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0": "AGPL-3.0",
    "LGPL-3.0-or-later": "LGPL-3.0-or-later", "LGPL-3.0+": "LGPL-3.0-or-later", "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0": "LGPL-3.0",
    "LGPL-2.1-or-later": "LGPL-2.1-or-later", "LGPL-2.1+": "LGPL-2.1-or-later", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1": "LGPL-2.1",
    "GPL-3.0-or-later": "GPL-3.0-or-later", "GPL-3.0+": "GPL-3.0-or-later", "GPL-3.0-only": "GPL-3.0", "GPL-3.0": "GPL-3.0",
    "GPL-2.0-or-later": "GPL-2.0-or-later", "GPL-2.0+": "GPL-2.0-or-later", "GPL-2.0-only": "GPL-2.0", "GPL-2.0": "GPL-2.0",
    "MPL-2.0": "MPL-2.0", "EPL-2.0": "EPL-2.0", "Unlicense": "Unlicense", "CC0-1.0": "CC0-1.0",
    "CC-BY-NC-ND-4.0": "CC-BY-NC-ND", "CC-BY-NC-SA-4.0": "CC-BY-NC-SA", "CC-BY-NC-4.0": "CC-BY-NC", "CC-BY-ND-4.0": "CC-BY-ND", "CC-BY-SA-4.0": "CC-BY-SA", "CC-BY-4.0": "CC-BY",
}


def _under(*names: str) -> list[str]:
    return [f"{lead} {name}" for name in names for lead in _LEADS]


def _gnu(family: str, version: str) -> list[tuple[str, list[str]]]:
    name, key = _GNU[family], f"{family}{version.replace(' ', '')}"
    later = [f"{name}{by} {x}" for by in _FSF for x in (f"either version {version} of the license or at your option any later version", f"version {version} of the license or at your option any later version", f"version {version} or at your option any later version", f"version {version} or later", f"v{version} or later", f"either version {version}")]
    return [(f"{key}_later", later), (key, [f"{name}{by} {x}" for by in _FSF for x in (f"version {version}", f"v{version}")] + _under(f"{family}v{version}", f"{family} v{version}", f"{family} {version}"))]


#: Identifier and wordings of known sentences; earlier ones take their words first.
SENTENCES: list[tuple[str, list[str]]] = [
    *((f"spdx:{rule}", [f"spdx license identifier {re.sub('[^a-z0-9+]+', ' ', name.lower())}"]) for name, rule in SPDX.items()),
    ("spdx", ["spdx license identifier"]),
    ("apache2", [f"{lead}apache {x}" for lead in ("licensed under the ", "under the ", "") for x in ("license version 2 0", "license version 2", "license 2 0", "license v2 0", "2 0 license", "software license version 2 0")]),
    ("apache_comply", ["you may not use this file except in compliance with the license", "you may not use this work except in compliance with the license", "you may not use these files except in compliance with the license"]),
    ("apache_basis", ["distributed under the license is distributed on an as is basis"]),
    ("bsl_grant", ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"]),
    ("mit_grant", ["permission is hereby granted free of charge to any person obtaining a copy"]),
    ("mit_notice", ["the above copyright notice and this permission notice shall be included in all copies", "this permission notice shall be included in all copies", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies"]),
    ("mit_line", _under("mit license", "mit x11 license", "mit expat license") + ["mit licensed"]),
    ("isc_grant", [f"permission to use copy modify {x} this software for any purpose with or without fee is hereby granted" for x in ("and or distribute", "and distribute")] + [f"permission to use copy modify {x} this software for any purpose" for x in ("and or distribute", "and distribute")]),
    ("isc_notice", ["the above copyright notice and this permission notice appear in all copies", "copyright notice and this permission notice appear in all copies"]),
    ("isc_line", _under("isc license")),
    ("zlib_as_is", ["this software is provided as is without any express or implied warranty"]),
    ("zlib_grant", ["permission is granted to anyone to use this software for any purpose including commercial applications"]),
    ("bsd_grant", ["redistribution and use in source and binary forms with or without modification are permitted"]),
    ("bsd_source", ["redistributions of source code must retain"]),
    ("bsd_binary", ["redistributions in binary form must reproduce"]),
    ("bsd_name", [f"used to endorse or promote products derived from this software without {x}prior written permission" for x in ("specific ", "")] + ["used to endorse or promote products without specific prior written permission"]),
    ("bsd_as_is", [f"this software is provided by the {x} as is and any express or implied warranties" for x in ("copyright holders and contributors", "copyright holder and contributors", "copyright holders", "copyright holder", "regents and contributors", "author and contributors", "authors and contributors", "author", "authors")]),
    ("as_is", ["the software is provided as is without warranty of any kind", "software is provided as is without warranty", "the software is provided as is and the author disclaims all warranties", "software is provided as is and the author disclaims all warranties"]),
    ("bsd3_line", _under("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license")),
    ("bsd2_line", _under("bsd 2 clause license", "2 clause bsd license", "simplified bsd license")),
    ("bsd_line", _under("bsd license", "bsd style license")),
    ("gnu_hope", ["distributed in the hope that it will be useful but without any warranty"]),
    *((f"{family}_copy", [f"you should have received a copy of the {name}"]) for family, name in _GNU.items()),
    *(x for family, version in _VERSIONS for x in _gnu(family, version)),
    *((f"{family}_any", _under(name, f"{family} license")) for family, name in _GNU.items()),
    ("mpl2", ["subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0", "mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v2 0"]),
    ("epl2", ["eclipse public license v 2 0", "eclipse public license version 2 0", "eclipse public license 2 0", "eclipse public license v2 0"]),
    ("unlicense", ["free and unencumbered software released into the public domain"]),
    ("cc0", ["cc0 1 0 universal public domain dedication", "cc0 public domain dedication", "under the creative commons zero license", "under creative commons zero", *_under("cc0"), "cc0 1 0 universal", "public domain dedication"]),
    *(
        (f"cc_{kind.replace(' ', '_')}", _under(f"cc {kind}", *(f"creative commons attribution{' ' * bool(x)}{x}" for x in dict.fromkeys((long, long.replace("noncommercial", "non commercial"), long.replace("noderivatives", "noderivs"), long.replace("sharealike", "share alike"), long.replace("noderivatives", "no derivatives"))))))
        for kind, long in _CC
    ),
]

for _name, _wordings in SENTENCES:
    for _wording in _wordings:
        if not any(cue in word for word in _wording.split(" ") for cue in CUES) and "cc by" not in _wording:
            raise ValueError(f"no cue in {_wording!r}")

_BREAK = "\x01"
#: The identifier behind an SPDX line's colon belongs to the line's sentence.
_CUT = r"\n[^\p{L}\p{N}\n]*\n|[.!?:;](?<!(?i:spdx-license-identifier):)[\x22')\]]*\s+(?=[^\p{L}\p{N}]*\p{Lu})"
_OTHER = r"[^a-z0-9+\x01]+"


def has_cue(low: Column) -> Column:
    out = low.contains(CUES[0])
    for cue in CUES[1:]:
        out = out | low.contains(cue)
    return out | low.contains("cc") & low.rlike("cc[^a-z0-9]+by")


def known_in(sentence: Column) -> Column:
    """The marks, like [mit_grant], of the known wordings in a normalised sentence, in the order in which they stand."""
    table = F.array(*[F.struct(F.lit(f" {wording} ").alias("words"), F.lit(f" [{name}] ").alias("mark")) for name, wordings in SENTENCES for wording in wordings])
    marked = F.aggregate(table, F.concat(F.lit(" "), sentence, F.lit(" ")), lambda acc, x: F.replace(acc, x["words"], x["mark"]))
    return F.regexp_extract_all(marked, F.lit(r"\[[^\]]*\]"), F.lit(0))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, licenses (rule names in order of rules, ';' after each), n_known (known sentences), unmatched (their ids left over).

    A narrow plan: one scan, no shuffle, no Python. Each step is a projection of its own over arrays, so nothing is computed twice."""
    cued = F.when(has_cue(F.lower(F.col(text_col))), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), cued.alias("raw"))
    normalised = F.regexp_replace(F.lower(F.regexp_replace("raw", _CUT, _BREAK)), _OTHER, " ")
    sentences = F.filter(F.transform(F.split(normalised, _BREAK), lambda x: F.trim(x)), has_cue)
    marks = F.flatten(F.transform(sentences, known_in))
    one = rows.select("id", F.coalesce(F.when(F.col("raw").isNotNull(), marks), F.array().cast("array<string>")).alias("marks"))
    spdx = [(rule, (f"spdx:{rule}",)) for rule in dict.fromkeys(SPDX.values())]
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"[{x}]" for x in parts)).alias("marks")) for name, parts in (*RULES, *spdx)])
    step = lambda acc, rule: F.when(
        F.contains(acc["left"], rule["marks"]),
        F.struct(F.replace(acc["left"], rule["marks"], F.lit("")).alias("left"), F.concat(acc["found"], rule["name"], F.lit(";")).alias("found")),
    ).otherwise(acc)
    start = F.struct(F.array_join("marks", "").alias("left"), F.lit("").alias("found"))
    matched = F.when(F.size("marks") > 0, F.aggregate(rules, start, step)).otherwise(start)
    return one.select("id", F.size("marks").cast("long").alias("n_known"), matched.alias("m")).select(F.col("id").alias(id_col), F.col("m.found").alias("licenses"), "n_known", F.col("m.left").alias("unmatched"))


# The SQL knows the sentences by patterns of its own, so that it is not of one table with the operator.
_U = r"under (?:an? |the (?:terms of the )?)?"
_BY = r"(?: as published by the free software foundation)?"
_LATER = r"(?: of the license)? or (?:at your option any later version|later)"
SQL_PATTERNS = (
    ("spdx", r"spdx license identifier"),
    ("apache2", r"(?:(?:licensed )?under the )?apache (?:(?:software )?license (?:version |v)?2 0|license version 2|2 0 license)"),
    ("apache_comply", r"you may not use (?:this (?:file|work)|these files) except in compliance with the license"),
    ("apache_basis", r"distributed under the license is distributed on an as is basis"),
    ("bsl_grant", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("mit_grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit_notice", r"this permission notice (?:including the next paragraph )?shall be included in all copies"),
    ("mit_line", _U + r"mit (?:x11 |expat )?license|mit licensed"),
    ("isc_grant", r"permission to use copy modify and (?:or )?distribute this software for any purpose"),
    ("isc_notice", r"copyright notice and this permission notice appear in all copies"),
    ("isc_line", _U + r"isc license"),
    ("zlib_as_is", r"this software is provided as is without any express or implied warranty"),
    ("zlib_grant", r"permission is granted to anyone to use this software for any purpose including commercial"),
    ("bsd_grant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd_source", r"redistributions of source code must retain"),
    ("bsd_binary", r"redistributions in binary form must reproduce"),
    ("bsd_name", r"used to endorse or promote products (?:derived from this software )?without (?:specific )?prior written permission"),
    ("bsd_as_is", r"this software is provided by the (?:copyright holders?|regents|authors?)(?: and contributors)? as is and any express or implied warranties"),
    ("as_is", r"software is provided as is (?:without warranty|and the author disclaims all warranties)"),
    ("bsd3_line", _U + r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd) license"),
    ("bsd2_line", _U + r"(?:bsd 2 clause|2 clause bsd|simplified bsd) license"),
    ("bsd_line", _U + r"bsd (?:style )?license"),
    ("gnu_hope", r"distributed in the hope that it will be useful but without any warranty"),
    ("agpl_copy", r"you should have received a copy of the gnu affero general public license"),
    ("lgpl_copy", r"you should have received a copy of the gnu lesser general public license"),
    ("gpl_copy", r"you should have received a copy of the gnu general public license"),
    ("agpl3_later", rf"(?:{_U})?gnu affero general public license{_BY} (?:either version 3|(?:either )?(?:version |v)3{_LATER})"),
    ("agpl3", rf"(?:{_U})?gnu affero general public license{_BY} (?:version |v)3|{_U}agpl ?v?3"),
    ("lgpl3_later", rf"(?:{_U})?gnu lesser general public license{_BY} (?:either version 3|(?:either )?(?:version |v)3{_LATER})"),
    ("lgpl3", rf"(?:{_U})?gnu lesser general public license{_BY} (?:version |v)3|{_U}lgpl ?v?3"),
    ("lgpl21_later", rf"(?:{_U})?gnu lesser general public license{_BY} (?:either version 2 1|(?:either )?(?:version |v)2 1{_LATER})"),
    ("lgpl21", rf"(?:{_U})?gnu lesser general public license{_BY} (?:version |v)2 1|{_U}lgpl ?v?2 1"),
    ("gpl3_later", rf"(?:{_U})?gnu general public license{_BY} (?:either version 3|(?:either )?(?:version |v)3{_LATER})"),
    ("gpl3", rf"(?:{_U})?gnu general public license{_BY} (?:version |v)3|{_U}gpl ?v?3"),
    ("gpl2_later", rf"(?:{_U})?gnu general public license{_BY} (?:either version 2|(?:either )?(?:version |v)2{_LATER})"),
    ("gpl2", rf"(?:{_U})?gnu general public license{_BY} (?:version |v)2|{_U}gpl ?v?2"),
    ("agpl_any", _U + r"(?:gnu affero general public|agpl) license"),
    ("lgpl_any", _U + r"(?:gnu lesser general public|lgpl) license"),
    ("gpl_any", _U + r"(?:gnu general public|gpl) license"),
    ("mpl2", r"mozilla public license (?:version |v ?)?2 0"),
    ("epl2", r"eclipse public license (?:version |v ?)?2 0"),
    ("unlicense", r"free and unencumbered software released into the public domain"),
    ("cc0", rf"{_U}cc0|cc0 1 0 universal|public domain dedication|{_U}creative commons zero"),
    ("cc_by_nc_nd", _U + r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)"),
    ("cc_by_nc_sa", _U + r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)"),
    ("cc_by_nc", _U + r"(?:cc by nc|creative commons attribution non ?commercial)"),
    ("cc_by_nd", _U + r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)"),
    ("cc_by_sa", _U + r"(?:cc by sa|creative commons attribution share ?alike)"),
    ("cc_by", _U + r"(?:cc by|creative commons attribution)"),
)


def oracle_sql() -> str:
    """Finds sentences by SQL_PATTERNS, one after the other from left to right, in whole texts without the operator's cues; the rules are the same.

    SPDX lines keep their identifier unread here: none is in the tables that it is for."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    cases = " ".join(f"WHEN regexp_full_match(s, {quote(p)}) THEN {quote(f'[{n}]')}" for n, p in SQL_PATTERNS)
    cut = r"regexp_replace(regexp_replace(text, '\n[^\pL\pN\n]*\n', ' % ', 'g'), '[.!?:;][\x22\x27)\]]*\s+([^\pL\pN]*\p{Lu})', ' % \1', 'g')"
    patterns = rf"\b(?:{'|'.join(p for _, p in SQL_PATTERNS)})\b"
    steps = [
        f"d AS (SELECT doc_id, list_transform(regexp_extract_all(regexp_replace(lower({cut}), '[^a-z0-9+%]+', ' ', 'g'), {quote(patterns)}), lambda s: CASE {cases} END) AS m FROM documents)",
        "r0 AS (SELECT doc_id, coalesce(len(m), 0) AS n_known, coalesce(array_to_string(m, ''), '') AS l, '' AS f FROM d)",
    ]
    for i, (name, parts) in enumerate(RULES):
        seq = quote("".join(f"[{x}]" for x in parts))
        steps.append(f"r{i + 1} AS (SELECT doc_id, n_known, replace(l, {seq}, '') AS l, f || CASE WHEN contains(l, {seq}) THEN {quote(name + ';')} ELSE '' END AS f FROM r{i})")
    return "WITH " + ",\n ".join(steps) + f"\nSELECT doc_id, f AS licenses, n_known::BIGINT AS n_known, l AS unmatched FROM r{len(RULES)}"
