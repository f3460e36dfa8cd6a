"""License scans: ordered signature rules behind literals that they contain, with priorities and suppression of contained detections."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from attesta.llm import arrays as A

#: The phrases whose places every document reports, and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licences by label: (names in running text as patterns over words, versions). The hundreds of rules come from these by `rules()`: a name, a name with each
#: version, a notice, an SPDX tag, an address.
LICENSES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "apache": (("apache (?:software )?license",), ("1 0", "1 1", "2 0")),
    "mit": (("mit license", "mit licence", "expat license"), ("0",)),
    "bsd": (("bsd license", "bsd style license", "berkeley software distribution"), ("2 clause", "3 clause", "4 clause", "0 clause")),
    "gpl": (("gnu general public licen[sc]e", "gnu gpl"), ("1 0", "2", "2 0", "3", "3 0")),
    "lgpl": (("gnu (?:lesser|library) general public licen[sc]e", "gnu lgpl"), ("2", "2 0", "2 1", "3", "3 0")),
    "agpl": (("(?:gnu )?affero general public licen[sc]e",), ("1 0", "3", "3 0")),
    "gfdl": (("gnu free documentation licen[sc]e",), ("1 1", "1 2", "1 3")),
    "mpl": (("mozilla public licen[sc]e",), ("1 0", "1 1", "2 0")),
    "epl": (("eclipse public licen[sc]e",), ("1 0", "2 0")),
    "cddl": (("common development and distribution licen[sc]e", "cddl"), ("1 0", "1 1")),
    "cpl": (("common public licen[sc]e",), ("1 0",)),
    "eupl": (("european union public licen[sc]e",), ("1 0", "1 1", "1 2")),
    "isc": (("isc licen[sc]e",), ()),
    "zlib": (("zlib licen[sc]e", "zlib libpng licen[sc]e"), ()),
    "artistic": (("artistic licen[sc]e",), ("1 0", "2 0")),
    "boost": (("boost software licen[sc]e",), ("1 0",)),
    "unlicense": (("the unlicense",), ()),
    "wtfpl": (("wtfpl",), ("1", "2")),
    "psf": (("python software foundation licen[sc]e", "psf licen[sc]e"), ("2",)),
    "php": (("php licen[sc]e",), ("3 0", "3 01")),
    "ofl": (("sil open font licen[sc]e",), ("1 0", "1 1")),
    "odbl": (("open database licen[sc]e", "odbl"), ("1 0",)),
    "odc-by": (("open data commons attribution licen[sc]e",), ("1 0",)),
    "ogl": (("open government licen[sc]e",), ("1 0", "2 0", "3 0")),
    "cc0": (("cc0", "creative commons zero"), ("1 0",)),
    "cc-by-nc-nd": (("cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s"), ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-nc-sa": (("cc by nc sa", "creative commons attribution non ?commercial share ?alike"), ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-nc": (("cc by nc", "creative commons attribution non ?commercial"), ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-nd": (("cc by nd", "creative commons attribution no ?deriv(?:ative)?s"), ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-sa": (("cc by sa", "creative commons attribution share ?alike"), ("2 0", "2 5", "3 0", "4 0")),
    "cc-by": (("cc by", "creative commons attribution"), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "ms-pl": (("microsoft public licen[sc]e",), ()),
    "ms-rl": (("microsoft reciprocal licen[sc]e",), ()),
    "osl": (("open software licen[sc]e",), ("1 0", "2 0", "3 0")),
    "afl": (("academic free licen[sc]e",), ("2 0", "2 1", "3 0")),
    "upl": (("universal permissive licen[sc]e",), ("1 0",)),
    "ncsa": (("(?:university of illinois )?ncsa open source licen[sc]e",), ()),
    "postgresql": (("postgresql licen[sc]e",), ()),
    "openssl": (("openssl licen[sc]e",), ()),
    "public-domain": (("released into the public domain", "(?:is|are) in the public domain", "public domain dedication"), ()),
    "proprietary": (("proprietary and confidential", "proprietary licen[sc]e"), ()),
    "reserved": (("all rights reserved", "no part of this (?:work|publication|document) may be reproduced"), ()),
    "copyright": ((r"copyright(?: c)? (?:19|20)\d\d", "copyright notice"), ()),
}

#: Rule forms by rising priority: a longer, more specific statement outweighs the bare name inside it. (form, confidence)
FORMS = (("name", 0.6), ("short", 0.6), ("version", 0.8), ("notice", 0.9), ("tag", 0.95), ("address", 0.9), ("header", 0.9), ("clause", 0.95))

#: Signatures written by hand, over lowered words joined by one space: what licences say without naming themselves, the notices that stand in file headers, short names,
#: SPDX identifiers and addresses. (label, form, pattern)
SIGNATURES: tuple[tuple[str, str, str], ...] = (
    # grants and conditions of permissive licences
    ("mit", "clause", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "clause", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", "clause", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "clause", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "clause", "except as contained in this notice the names? of .{1,80}? shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("bsd", "clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "clause", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "clause", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "clause", "neither the names? of .{1,80}? nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "clause", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd", "clause", "in no event shall the (?:copyright (?:holder|owner)|regents|author)s? or contributors be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("isc", "clause", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "clause", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("isc", "clause", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits"),
    ("zlib", "clause", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "clause", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "clause", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("boost", "clause", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("apache", "header", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "header", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache", "header", "you may obtain a copy of the license at (?:https? )?www apache org licenses license 2 0"),
    ("apache", "header", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache", "clause", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache", "clause", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent license"),
    ("unlicense", "clause", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "clause", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "clause", "we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("wtfpl", "clause", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("cc0", "clause", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0", "clause", "to the extent possible under law .{1,120}? (?:has|have) waived all copyright and related or neighboring rights"),
    ("artistic", "clause", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "clause", "you may copy and distribute verbatim copies of the source form of the standard version of this package without restriction"),
    ("psf", "clause", "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly"),
    ("ofl", "clause", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("ofl", "clause", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("openssl", "clause", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("postgresql", "clause", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("upl", "clause", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("ncsa", "clause", "neither the names of .{1,80}? nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission the software is provided as is"),
    # copyleft licences and their notices
    ("gpl", "header", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation"),
    ("gpl", "header", "this file is part of .{1,60}? (?:.{1,60}? )?is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("gpl", "header", "you should have received a copy of the gnu general public licen[sc]e along with this (?:program|package|file|library|software)"),
    ("gpl", "header", "either version (?:2|3|2 0|3 0) of the licen[sc]e or at your option any later version"),
    ("gpl", "header", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "clause", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", "clause", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", "clause", "you may convey verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl", "clause", "you must cause any work that you distribute or publish that in whole or in part contains or is derived from the program"),
    ("gpl", "clause", "as a special exception .{1,120}? permission to link"),
    ("lgpl", "header", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    ("lgpl", "header", "you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e along with this (?:program|package|file|library|software)"),
    ("lgpl", "clause", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("agpl", "header", "under the terms of the gnu affero general public licen[sc]e as published by the free software foundation"),
    ("agpl", "header", "you should have received a copy of the gnu affero general public licen[sc]e along with this (?:program|package|file|library|software)"),
    ("agpl", "clause", "your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "header", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("gfdl", "header", "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl", "header", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl", "header", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "header", "the contents of this file are subject to the mozilla public licen[sc]e"),
    ("epl", "header", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("epl", "clause", "the accompanying program is provided under the terms of this eclipse public license"),
    ("cddl", "header", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("cpl", "clause", "the accompanying program is provided under the terms of this common public license"),
    ("eupl", "header", "licensed under the eupl"),
    ("osl", "header", "licensed under the open software licen[sc]e"),
    ("afl", "header", "licensed under the academic free licen[sc]e"),
    ("ms-pl", "clause", "this license governs use of the accompanying software if you use the software you accept this license"),
    # works and databases
    ("cc-by", "clause", "you are free to share copy and redistribute the material in any medium or format"),
    ("cc-by", "clause", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-nc", "clause", "you may not use the material for commercial purposes"),
    ("cc-by-sa", "clause", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-by-nd", "clause", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-by-sa", "header", "text is available under the creative commons attribution share ?alike licen[sc]e"),
    ("cc-by", "header", "this (?:work|article|document|content|dataset) is licensed under a creative commons attribution"),
    ("cc-by", "header", "this is an open access article distributed under the terms of the creative commons attribution"),
    ("odbl", "header", "this data(?:base)? is made available under the open database licen[sc]e"),
    ("odbl", "clause", "any rights in individual contents of the database are licensed under the database contents licen[sc]e"),
    ("odc-by", "header", "made available under the open data commons attribution licen[sc]e"),
    ("ogl", "header", "contains public sector information licensed under the open government licen[sc]e"),
    ("public-domain", "header", "(?:has|have) been (?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "header", "this (?:work|book|ebook) is in the public domain"),
    ("public-domain", "clause", "no known copyright restrictions"),
    # reserved and closed
    ("reserved", "clause", "no part of this (?:work|book|publication|document|site) may be reproduced stored in a retrieval system or transmitted in any form or by any means"),
    ("reserved", "header", "unauthori[sz]ed (?:copying|use|reproduction|distribution) .{0,60}?is strictly prohibited"),
    ("reserved", "header", "may not be (?:published broadcast rewritten or redistributed|reproduced distributed or transmitted)"),
    ("reserved", "header", "used (?:here )?(?:with|by) permission of the (?:copyright (?:holder|owner)|publisher|author)"),
    ("proprietary", "header", "this (?:software|file|document|program) is the (?:confidential and )?proprietary (?:information|property) of"),
    ("proprietary", "header", "trade secrets? of .{1,60}? and may not be disclosed"),
    ("proprietary", "clause", "you may not reverse engineer decompile or disassemble the software"),
    ("proprietary", "clause", "by (?:installing|using|downloading) (?:this|the) software you agree to (?:be bound by )?the terms of this (?:end user )?licen[sc]e agreement"),
    ("proprietary", "name", "end user licen[sc]e agreement"),
    ("proprietary", "name", "commercial licen[sc]e required"),
    ("copyright", "header", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)* (?:by )?the authors"),
    ("copyright", "header", r"c (?:19|20)\d\d(?: (?:19|20)\d\d)* all rights reserved"),
    # short names
    ("apache", "short", "apache ?2(?: 0)?"), ("apache", "short", "apache version 2(?: 0)?"), ("apache", "short", "asl 2 0"),
    ("gpl", "short", r"gplv[123](?: 0)?\+?"), ("gpl", "short", r"gpl (?:version )?v?[123](?: 0)?(?: only| or later)?"), ("gpl", "short", "gpl licensed"),
    ("lgpl", "short", r"lgplv[23](?: [01])?"), ("lgpl", "short", r"lgpl (?:version )?v?[23](?: [01])?(?: only| or later)?"),
    ("agpl", "short", r"agplv[13]"), ("agpl", "short", r"agpl (?:version )?v?[13](?: 0)?(?: only| or later)?"),
    ("gfdl", "short", r"gfdl(?: 1 [123])?"), ("mpl", "short", r"mpl (?:version )?v?[12] [01]"), ("mpl", "short", r"mplv[12]"), ("epl", "short", r"epl (?:version )?v?[12] 0"),
    ("cddl", "short", r"cddl (?:version )?v?1 [01]"), ("eupl", "short", r"eupl (?:version )?v?1 [012]"), ("bsd", "short", r"bsd [0234] clause"), ("bsd", "short", "(?:new|modified|simplified|revised) bsd"), ("bsd", "short", "bsd licensed"),
    ("mit", "short", "mit licensed"), ("mit", "short", "mit x11"), ("cc0", "short", "cc zero"), ("cc0", "short", "cc0 1 0"), ("ofl", "short", r"ofl 1 [01]"), ("ogl", "short", r"ogl v?[123] 0"), ("artistic", "short", r"artistic 2 0"),
    ("postgresql", "short", "postgres licensed"), ("public-domain", "short", "public domain work"), ("cc-by", "short", "attribution 4 0 international"), ("cc-by-sa", "short", "attribution share ?alike 4 0 international"),
    ("cc-by-nc", "short", "attribution non ?commercial 4 0 international"), ("cc-by-nd", "short", "attribution no ?derivatives 4 0 international"),
    # SPDX identifiers that are no label with a version
    ("psf", "tag", "spdx license identifier python 2 0(?: \\d)?"), ("psf", "tag", "spdx license identifier psf 2 0"), ("zlib", "tag", "spdx license identifier libpng(?: 2 0)?"), ("boost", "tag", "spdx license identifier bsl 1 0"),
    ("bsd", "tag", "spdx license identifier 0bsd"), ("mit", "tag", "spdx license identifier x11"), ("openssl", "tag", "spdx license identifier openssl"), ("ncsa", "tag", "spdx license identifier ncsa"),
    ("proprietary", "tag", "spdx license identifier licenseref .{1,40}? proprietary"), ("ogl", "tag", "spdx license identifier ogl uk 3 0"), ("artistic", "tag", "spdx license identifier artistic 1 0 perl"), ("ms-rl", "tag", "spdx license identifier ms rl"),
    # addresses
    ("apache", "address", "apache org licenses license [12] [01]"), ("mit", "address", "opensource org licenses? mit(?: license)?"), ("bsd", "address", r"opensource org licenses? bsd(?: [234] clause| license)?"),
    ("gpl", "address", r"gnu org licenses (?:old licenses )?gpl(?: [123] 0)?"), ("lgpl", "address", r"gnu org licenses (?:old licenses )?lgpl(?: [23] [01])?"), ("agpl", "address", r"gnu org licenses agpl(?: 3 0)?"), ("gfdl", "address", r"gnu org licenses fdl(?: 1 [123])?"),
    ("gpl", "address", "gnu org copyleft gpl"), ("mpl", "address", r"mozilla org (?:en us )?mpl(?: [12] [01])?"), ("epl", "address", r"eclipse org (?:org documents|legal) epl v?[12]0?(?: 0)?"),
    ("cc-by", "address", r"creativecommons org licenses by [1234] [05]"), ("cc-by-sa", "address", r"creativecommons org licenses by sa [1234] [05]"), ("cc-by-nc", "address", r"creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nd", "address", r"creativecommons org licenses by nd [1234] [05]"), ("cc-by-nc-sa", "address", r"creativecommons org licenses by nc sa [1234] [05]"), ("cc-by-nc-nd", "address", r"creativecommons org licenses by nc nd [1234] [05]"),
    ("cc0", "address", "creativecommons org publicdomain zero 1 0"), ("public-domain", "address", "creativecommons org publicdomain mark 1 0"), ("unlicense", "address", "unlicense org"), ("boost", "address", "boost org license 1 0 txt"),
    ("odbl", "address", r"opendatacommons org licenses odbl(?: 1 0)?"), ("odc-by", "address", r"opendatacommons org licenses by(?: 1 0)?"), ("ogl", "address", r"nationalarchives gov uk doc open government licence(?: version [123])?"),
    ("ofl", "address", "scripts sil org ofl"), ("wtfpl", "address", "wtfpl net"), ("psf", "address", r"docs python org [\d ]*license"), ("php", "address", r"php net license [\d ]+"), ("postgresql", "address", "postgresql org about licence"),
    ("zlib", "address", "zlib net zlib license"), ("openssl", "address", "openssl org source license"), ("isc", "address", "opensource org licenses? isc(?: license)?"), ("artistic", "address", r"opensource org licenses? artistic(?: license)? 2 0"),
)


@dataclass(frozen=True)
class Rule:
    """`literal` stands in whatever `pattern` matches."""

    label: str
    form: str
    priority: int
    confidence: float
    literal: str
    pattern: str


def literal_of(pattern: str) -> str:
    """The longest run of characters that every match of the pattern contains: neither in a group or a class nor optional."""
    left, before = re.sub(r"\.\{\d+,\d+\}\??", "\0", pattern), None
    while left != before:
        left, before = re.sub(r"\([^()]*\)[?*+]?", "\0", left), left
    left = re.sub(r"(?:\[[^\]]*\]|\\.)[?*+]?|.[?*]", "\0", left)
    if re.search(r"[][(){}|+\\^$.]", left):
        raise ValueError(f"no literal can be read from {pattern!r}")
    return max(left.split("\0"), key=len)


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """All rules in order. Patterns match the words of a text, lowered and joined by one space, from word to word. The literal of a name, a version or a
    notice is that of the name, which all three contain."""
    out = []
    for label, (names, versions) in LICENSES.items():
        spdx = re.escape(label.replace("-", " "))
        for p, (form, confidence) in enumerate(FORMS):
            if form == "name":
                patterns = [(literal_of(n), n) for n in names]
            elif form == "version":
                patterns = [(literal_of(n), f"{n}(?: version)?(?: v)? v?{v}(?: only| or later| or any later version)?") for n in names for v in versions]
            elif form == "notice":
                patterns = [(literal_of(n), f"(?:licensed|released|distributed|published|available|provided|redistributed) under (?:the )?(?:terms of )?(?:the )?{n}(?: (?:version |v)?\\d[\\d ]*)?") for n in names]
            elif form in ("short", "header", "clause"):
                patterns = []  # written out in SIGNATURES
            elif form == "tag":
                patterns = [("spdx license identifier ", f"spdx license identifier {spdx}(?: [\\d.]+(?: \\d+)?)?(?: only| or later)?")]
            else:
                patterns = [(" org licen", f"(?:https? )?(?:www )?(?:opensource org|spdx org|creativecommons org|gnu org|apache org) licen[sc]es {spdx}(?: \\d+ \\d+)?")]
            out += [Rule(label, form, p, confidence, literal, x) for literal, x in patterns]
    by_form = {form: (p, confidence) for p, (form, confidence) in enumerate(FORMS)}
    out += [Rule(label, form, *by_form[form], literal_of(pattern), pattern) for label, form, pattern in SIGNATURES]
    return tuple(out)


@lru_cache(1)
def _compiled():
    """Rules by literal, patterns compiled over bytes and bounded by words."""
    by: dict[bytes, list] = {}
    for order, r in enumerate(rules()):
        by.setdefault(r.literal.encode(), []).append((order, r, re.compile(b"(?:(?<=^)|(?<= ))(?:" + r.pattern.encode() + b")(?= |$)")))
    return by


def candidates(words: bytes, gated: bool = True) -> list[tuple[int, int, int, Rule]]:
    """(start, end, rule number, rule) of every match; ungated: without looking for the literals of the rules first."""
    return [(m.start(), m.end(), order, r) for literal, own in _compiled().items() if not gated or literal in words for order, r, pattern in own for m in pattern.finditer(words)]


def suppressed(found: list[tuple[int, int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """The matches that no stronger one contains. They are taken by priority, then length, then rule order; one that lies inside one taken before is dropped.

    A tree of largest ends by start (prefix maxima) answers whether one that starts no later ends no earlier, so the time is that of sorting.
    """
    starts = sorted({s for s, _, _, _ in found})
    place = {s: i + 1 for i, s in enumerate(starts)}
    largest = [0] * (len(starts) + 1)
    kept: list[tuple[int, int, Rule]] = []
    for s, e, _, r in sorted(found, key=lambda f: (-f[3].priority, f[0] - f[1], f[2], f[0])):
        i, most = place[s], 0
        while i:
            most = max(most, largest[i])
            i &= i - 1
        if most >= e:
            continue
        kept.append((s, e, r))
        i = place[s]
        while i <= len(starts):
            largest[i] = max(largest[i], e)
            i += i & -i
    return sorted(kept, key=lambda k: k[:2])


def detect(words: bytes) -> list[tuple[int, int, Rule]]:
    """Detections in lowered words joined by one space: (start, end) in bytes and the rule. "gnu general public license" inside a notice gives one detection, and "cc by" inside "cc by sa" none of its own."""
    return suppressed(candidates(words))


SCHEMA = "doc_id long, n_words long, base array<struct<word: long, label: string>>, detections array<struct<first: long, last: long, label: string, form: string, confidence: double>>"
_BASE = [(b" " + p.encode() + b" ", label) for p, label in BASE.items()]
#: Lowers A-Z and makes a space of every byte outside words, so that one space is left between words once runs of them are shortened.
_SPACED = bytes(np.where(A.ALNUM, A.LOWER, ord(" ")).astype(np.uint8))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("word", pa.int64()), ("label", pa.string())])
    kind2 = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("form", pa.string()), ("confidence", pa.float64())])
    for batch in batches:
        ids = batch.column(0)
        for a, b, data, offsets in A.text_blocks(A.as_texts(batch.column(1))):
            raw, sizes, base, detections = data.tobytes().translate(_SPACED), [], [], []
            for k in range(b - a):
                joined, places, found = raw[offsets[k]:offsets[k + 1]].strip(), [], []
                while b"  " in joined:
                    joined = joined.replace(b"  ", b" ")
                padded = b" " + joined + b" "
                detected = detect(joined)
                hits = [(needle, label) for needle, label in _BASE if needle in padded]
                if hits or detected:
                    at = np.concatenate([[0], np.flatnonzero(np.frombuffer(joined, np.uint8) == ord(" ")) + 1])  # where each word starts in what is joined
                    for needle, label in hits:
                        i = padded.find(needle)
                        while i >= 0:
                            places.append((int(np.searchsorted(at, i)), label))
                            i = padded.find(needle, i + 1)
                    places.sort()
                    found = [(int(np.searchsorted(at, x)), int(np.searchsorted(at, y)) - 1, r.label, r.form, r.confidence) for x, y, r in detected]
                sizes.append(joined.count(b" ") + 1 if joined else 0)
                base.append([{"word": w, "label": x} for w, x in places])
                detections.append([dict(zip(("first", "last", "label", "form", "confidence"), f, strict=True)) for f in found])
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(base, pa.list_(kind)), pa.array(detections, pa.list_(kind2))],
                                             names=["doc_id", "n_words", "base", "detections"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, `base` (every place where the words of a base phrase stand, by first word) and `detections` of the rules
    (first and last word, label, form, confidence) that no stronger detection contains.

    A-Z are lowered; words are runs of digits, letters and characters beyond ASCII. Null and empty texts have no words and no detections;
    repeated rows give repeated rows. One pass without a shuffle; the rules see whole texts.
    """
    return A.texts_only(docs, id_col, text_col).mapInArrow(_scan, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query. score: the chance that at least one detection or base phrase (0.5 each) states a licence, 0 without any."""
    return found.selectExpr(
        "doc_id", "n_words", "cast(size(base) as long) n_base", "array_min(base.word) first_word", "array_max(base.word) last_word",
        "concat_ws(',', array_sort(array_distinct(base.label))) base_labels", "concat_ws(',', array_sort(array_union(base.label, detections.label))) labels",
        "1D - aggregate(concat(transform(base, x -> 0.5D), detections.confidence), 1D, (a, c) -> a * (1D - c)) score")
