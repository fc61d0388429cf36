"""Signature rules for licence statements, built from hand-written names and the phrases around them.

All patterns match canonical words: A-Z lowered, one space between words, punctuation gone (so
"CC BY-NC 4.0" reads "cc by nc 4 0"). ``FAMILIES`` lists, per label, a gate word and the patterns of
its names; ``FRAMES`` lists the sentences that turn a name into a statement, with priority and score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Phrases whose places are counted and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Label, gate word, name patterns.
FAMILIES = (
    ("afl-3.0", "academic", r"academic free licen[sc]e(?: (?:version|v) ?)? ?3 0"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e(?: version| v)? ?3(?: 0)?"),
    ("agpl-3.0", "agpl", r"agpl(?: ?v?3)(?: 0)?(?: only| or later)?"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e(?: version| v)? ?1 1"),
    ("apache-2", "apache", r"apache (?:software )?licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("apache-2", "apache", r"apache 2(?: 0)?"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e(?: version)? 1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e(?: version)? 2(?: 0)?"),
    ("blueoak-1.0.0", "oak", r"blue oak model licen[sc]e(?: 1 0 0)?"),
    ("bsd-0-clause", "0bsd", r"0bsd"),
    ("bsd-0-clause", "clause", r"(?:zero|0) clause bsd"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e(?: version| v)?(?: 1 0)?"),
    ("bsl-1.1", "business", r"business source licen[sc]e(?: 1 1)?"),
    ("cc-by", "cc", r"cc by(?: [1-4] 0)?"),
    ("cc-by", "attribution", r"creative commons attribution(?: [1-4] 0)?(?: international| unported)?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] 0)?"),
    ("cc-by-nc", "attribution", r"creative commons attribution non ?commercial(?: [1-4] 0)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] 0)?"),
    ("cc-by-nc-nd", "attribution", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] 0)?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] 0)?"),
    ("cc-by-nc-sa", "attribution", r"creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] 0)?"),
    ("cc-by-nd", "attribution", r"creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] 0)?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] 0)?"),
    ("cc-by-sa", "attribution", r"creative commons attribution share ?alike(?: [1-4] 0)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cddl-1.0", "cddl", r"cddl(?: 1 [01])?"),
    ("cddl-1.0", "distribution", r"common development and distribution licen[sc]e(?: 1 [01])?"),
    ("cecill-2.1", "cecill", r"cecill(?: 2 [01])?"),
    ("cpl-1.0", "common", r"common public licen[sc]e(?: version)?(?: 1 0)?"),
    ("ecl-2.0", "educational", r"educational community licen[sc]e(?: version)?(?: 2 0)?"),
    ("efl-2.0", "eiffel", r"eiffel forum licen[sc]e(?: version)?(?: 2)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("eupl-1.2", "eupl", r"eupl(?: v?1 [12])?"),
    ("eupl-1.2", "european", r"european union public licen[sc]e(?: 1 [12])?"),
    ("fdl-1.3", "documentation", r"gnu free documentation licen[sc]e(?: version)?(?: 1 [123])?"),
    ("ftl", "freetype", r"freetype (?:project )?licen[sc]e"),
    ("gpl-1.0", "general", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?1"),
    ("gpl-2.0", "general", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("gpl-2.0", "gpl", r"gpl ?v?2(?: 0)?(?: only| or later)?"),
    ("gpl-2.0", "gplv2", r"gplv2"),
    ("gpl-3.0", "general", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?3(?: 0)?"),
    ("gpl-3.0", "gpl", r"gpl ?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-3.0", "gplv3", r"gplv3"),
    ("gpl", "general", r"(?:gnu )?general public licen[sc]e"),
    ("isc", "isc", r"isc(?: licen[sc]e)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?2 1"),
    ("lgpl-2.1", "lgpl", r"lgpl ?v?2(?: 1)?(?: only| or later)?"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?3(?: 0)?"),
    ("lgpl-3.0", "lgpl", r"lgpl ?v?3(?: 0)?(?: only| or later)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e"),
    ("libpng", "libpng", r"libpng licen[sc]e"),
    ("lppl-1.3", "latex", r"latex project public licen[sc]e(?: version)?(?: 1 3c?)?"),
    ("mit", "mit", r"mit(?: licen[sc]e)?"),
    ("mit", "expat", r"expat licen[sc]e"),
    ("mit-0", "mit", r"mit (?:0|no attribution)(?: licen[sc]e)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e(?: version| v)? ?1 [01]"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("mpl-2.0", "mpl", r"mpl ?2(?: 0)?"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("ncsa", "illinois", r"(?:university of )?illinois (?:ncsa )?open source licen[sc]e"),
    ("odbl", "database", r"open (?:data commons )?open database licen[sc]e|open database licen[sc]e"),
    ("odc-by", "commons", r"open data commons attribution(?: licen[sc]e)?"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[sc]e(?: version)?(?: 1 1)?"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("osl-3.0", "open", r"open software licen[sc]e(?: version| v)? ?3(?: 0)?"),
    ("pddl", "commons", r"public domain dedication and licen[sc]e"),
    ("php-3.01", "php", r"php licen[sc]e(?: version)?(?: 3 01?)?"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("psf-2.0", "python", r"python software foundation licen[sc]e(?: version)?(?: 2)?"),
    ("qpl-1.0", "public", r"q public licen[sc]e(?: version)?(?: 1 0)?"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[sc]e"),
    ("sspl-1.0", "server", r"server side public licen[sc]e(?: version| v)?(?: ?1)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e(?: version| v)?(?: 1 0)?"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("w3c", "w3c", r"w3c (?:software )?(?:notice and )?licen[sc]e"),
    ("wtfpl", "wtfpl", r"wtfpl(?: 2)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("zpl-2.1", "zope", r"zope public licen[sc]e(?: version)?(?: 2 [01])?"),
)

#: How a statement frames a name, its gate word, priority (smaller is stronger), score.
FRAMES = (
    ("tag", "spdx", r"spdx licen[sc]e identifier {name}", 10, 1.0),
    ("granted", "under", r"(?:licen[sc]ed|released|distributed|published|available|provided|covered|redistributed?) under (?:the )?(?:terms of (?:the )?)?{name}", 20, 0.95),
    ("under", "under", r"under (?:the )?(?:terms of (?:the )?)?{name}", 30, 0.9),
    ("named", "licen", r"licen[sc]e(?: is| type)? {name}", 40, 0.85),
    ("title", "", r"{name}", 50, 0.6),
)

#: Statements of their own: label, gate word, pattern, priority, score.
STATEMENTS = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 15, 0.95),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose", 15, 0.95),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", 15, 0.9),
    ("apache-2", "compliance", r"you may not use this file except in compliance with the licen[sc]e", 15, 0.9),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms", 15, 0.9),
    ("mpl-2.0", "source", r"this source code form is subject to the terms of the mozilla public licen[sc]e", 15, 0.95),
    ("bsl-1.0", "boost", r"boost software licen[sc]e version 1 0 august 17th 2003", 15, 0.95),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 15, 0.95),
    ("public-domain", "domain", r"(?:released |dedicated |placed )?(?:in|into|to) the public domain", 45, 0.7),
    ("proprietary", "rights", r"all rights reserved", 60, 0.5),
    ("proprietary", "confidential", r"proprietary and confidential", 55, 0.7),
    ("wtfpl", "fuck", r"do what the fuck you want to public licen[sc]e", 15, 0.95),
    ("cc-unspecified", "creative", r"creative commons licen[sc]e", 58, 0.5),
    ("zlib", "altered", r"altered source versions must be plainly marked as such", 15, 0.9),
    ("warranty", "warranty", r"without warranty of any kind express or implied", 70, 0.3),
)

#: A bare one-word name is no title on its own.
_COMMON = {"mit", "isc", "cc by", "zlib", "vim", "ruby", "unlicense"}


@dataclass(frozen=True)
class Rule:
    label: str
    gates: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    priority: int
    score: float


def rules() -> list[Rule]:
    """All rules in order of priority: base phrases, then frames around names, then statements."""

    def made(label: str, gates: list[str], body: str, priority: int, score: float) -> Rule:
        if "licen[sc]e" in body and "licen[sc]e)?" not in body and "|" not in body:
            gates = [*gates, "licen"]
        return Rule(label, tuple(g.encode() for g in gates if g), re.compile(rb"(?<= )(?:" + body.encode() + rb")(?= )"), priority, score)

    out = [made(label, phrase.split(), phrase, 0, 1.0) for phrase, label in BASE]
    for label, gate, name in FAMILIES:
        for frame, also, body, priority, score in FRAMES:
            if frame == "title" and name.split("(")[0] in _COMMON:
                if "licen" not in name:
                    continue
                name = name.replace("(?: licen[sc]e)?", " licen[sc]e")
            out.append(made(label, [gate, also], body.format(name=f"(?:{name})"), priority, score))
    out += [made(label, [gate], *rest) for label, gate, *rest in STATEMENTS]
    return sorted(out, key=lambda r: r.priority)
