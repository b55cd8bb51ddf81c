"""Signature rules of licenses.

Texts are compared as words: letters a-z, digits and everything beyond ASCII, one space between words.  So ``CC BY-NC 4.0``
reads ``cc by nc 4 0`` and ``GPL-3.0-or-later`` reads ``gpl 3 0 or later``.

A rule is a pattern over whole words with a label, a priority (1 is strongest), a confidence, and two sets of plain
texts, gates and needs: every match has one of each at the beginning of a word (of a rule without needs, a gate).  The rules of a license come from its names, its short identifier and its address by the
forms below; sentences of the licenses themselves follow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Words of a gap; with their length bounded, so is every match.
GAP = r"(?:[^ ]{1,60} )"
#: Characters that a match has at most.
REACH = 2048


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    pattern: re.Pattern
    gates: tuple[str, ...]
    needs: tuple[str, ...]
    priority: int
    confidence: float


def _v(version: str) -> str:
    """A version as it may be written: ``2 0``, ``v2``, ``version 2 0``."""
    major, _, minor = version.partition(" ")
    tail = rf" {minor}" if minor not in ("", "0") else (r"(?: 0)?" if minor == "0" else "")
    return rf"(?:version |v ?|ver )?{major}{tail}"


# What licenses are called.  label, names, short identifiers, addresses, gates of the names.
_GPL = r"(?:gnu )?(?:general public licen[cs]e|gpl)"
_LGPL = r"(?:gnu )?(?:(?:lesser|library) general public licen[cs]e|lgpl)"
_AGPL = r"(?:gnu )?(?:affero general public licen[cs]e|agpl)"
_MPL = r"(?:mozilla public licen[cs]e|mpl)"
_EPL = r"(?:eclipse public licen[cs]e|epl)"
_CC = r"(?:creative commons|cc)"
_LATER = r"(?: or later| or any later version| only)?"
_CC_VERSION = r"(?: (?:version |v ?)?[1-4] [05])?(?: international| unported| generic)?"
LICENSES: list[tuple[str, str, str, str, tuple[str, ...]]] = [
    ("mit", r"mit(?: expat| x11)?|expat|x11 mit", "mit", "opensource org licenses? mit", ("mit", "expat")),
    ("mit-0", "mit 0|mit no attribution", "mit 0", "opensource org licenses? mit 0", ("mit 0", "mit no attr")),
    ("x11", "x11|x consortium", "x11", "", ("x11", "x consortium")),
    ("isc", "isc|internet systems consortium", "isc", "opensource org licenses? isc", ("isc", "internet systems")),
    ("0bsd", "0bsd|zero clause bsd|bsd zero clause", "0bsd", "opensource org licenses? 0bsd", ("0bsd", "zero clause")),
    ("bsd-2", r"bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd", "bsd 2 clause(?: freebsd| netbsd| views)?", "opensource org licenses? bsd 2 clause", ("bsd", "freebsd")),
    ("bsd-3", r"bsd 3 clause|3 clause bsd|three clause bsd|new bsd|revised bsd|modified bsd", "bsd 3 clause(?: clear| lbnl| attribution)?", "opensource org licenses? bsd 3 clause", ("bsd",)),
    ("bsd-4", r"bsd 4 clause|4 clause bsd|four clause bsd|original bsd", "bsd 4 clause(?: uc)?", "", ("bsd",)),
    ("bsd", r"bsd(?: style)?", "bsd", "opensource org licenses? bsd license", ("bsd",)),
    ("apache-1", rf"apache(?: software)?(?: licen[cs]e)? {_v('1 0')}", "apache 1 0", "apache org licenses? license 1 0", ("apache",)),
    ("apache-1.1", rf"apache(?: software)?(?: licen[cs]e)? {_v('1 1')}", "apache 1 1", "apache org licenses? license 1 1", ("apache",)),
    ("apache-2", rf"apache(?: software)?(?: licen[cs]e)? {_v('2 0')}|asl 2(?: 0)?", "apache 2 0", "apache org licenses? license 2 0", ("apache", "asl 2")),
    ("apache", "apache(?: software)?", "apache", "apache org licenses?", ("apache",)),
    ("gpl-1", rf"{_GPL} {_v('1 0')}{_LATER}|gplv1", rf"gpl 1 0{_LATER}", "gnu org licenses? gpl 1 0", ("general public", "gpl")),
    ("gpl-2", rf"{_GPL} {_v('2 0')}{_LATER}|gplv2", rf"gpl 2 0{_LATER}", "gnu org licenses?(?: old licenses)? gpl 2 0", ("general public", "gpl")),
    ("gpl-3", rf"{_GPL} {_v('3 0')}{_LATER}|gplv3", rf"gpl 3 0{_LATER}", "gnu org licenses? gpl 3 0", ("general public", "gpl")),
    ("gpl", _GPL, "gpl", "gnu org licenses? gpl(?: html)?", ("general public", "gpl")),
    ("lgpl-2", rf"{_LGPL} {_v('2 0')}{_LATER}|lgplv2", rf"lgpl 2 0{_LATER}", "gnu org licenses?(?: old licenses)? lgpl 2 0", ("general public", "lgpl")),
    ("lgpl-2.1", rf"{_LGPL} {_v('2 1')}{_LATER}|lgplv2 1", rf"lgpl 2 1{_LATER}", "gnu org licenses?(?: old licenses)? lgpl 2 1", ("general public", "lgpl")),
    ("lgpl-3", rf"{_LGPL} {_v('3 0')}{_LATER}|lgplv3", rf"lgpl 3 0{_LATER}", "gnu org licenses? lgpl 3 0", ("general public", "lgpl")),
    ("lgpl", _LGPL, "lgpl", "gnu org licenses? lgpl(?: html)?", ("general public", "lgpl")),
    ("agpl-1", rf"{_AGPL} {_v('1 0')}{_LATER}", rf"agpl 1 0{_LATER}", "", ("general public", "agpl")),
    ("agpl-3", rf"{_AGPL} {_v('3 0')}{_LATER}|agplv3", rf"agpl 3 0{_LATER}", "gnu org licenses? agpl 3 0", ("general public", "agpl")),
    ("agpl", _AGPL, "agpl", "gnu org licenses? agpl(?: html)?", ("general public", "agpl")),
    ("gfdl", rf"(?:gnu )?(?:free documentation licen[cs]e|gfdl|fdl)(?: {_v('1 [123]')})?", "gfdl 1 [123](?: only| or later)?", "gnu org (?:licenses? |copyleft )fdl", ("free documentation", "gfdl", "fdl")),
    ("mpl-1", rf"{_MPL} {_v('1 0')}", "mpl 1 0", "mozilla org mpl 1 0", ("mozilla public", "mpl")),
    ("mpl-1.1", rf"{_MPL} {_v('1 1')}", "mpl 1 1", "mozilla org mpl (?:mpl )?1 1", ("mozilla public", "mpl")),
    ("mpl-2", rf"{_MPL} {_v('2 0')}", "mpl 2 0(?: no copyleft exception)?", "mozilla org mpl 2 0", ("mozilla public", "mpl")),
    ("mpl", _MPL, "mpl", "mozilla org mpl", ("mozilla public", "mpl")),
    ("epl-1", rf"{_EPL} {_v('1 0')}", "epl 1 0", "eclipse org legal epl v10", ("eclipse public", "epl")),
    ("epl-2", rf"{_EPL} {_v('2 0')}", "epl 2 0", "eclipse org legal epl (?:2 0|v20)", ("eclipse public", "epl")),
    ("cddl-1", rf"(?:common development and distribution licen[cs]e|cddl)(?: {_v('1 [01]')})?", "cddl 1 [01]", "opensource org licenses? cddl 1 0", ("common development and", "cddl")),
    ("cpl-1", rf"(?:common public licen[cs]e|cpl)(?: {_v('1 0')})?", "cpl 1 0", "", ("common public", "cpl")),
    ("eupl", rf"(?:european union public licen[cs]e|eupl)(?: {_v('1 [012]')})?", "eupl 1 [012]", "joinup ec europa eu [^ ]{1,60} eupl", ("european union public", "eupl")),
    ("osl-3", rf"(?:open software licen[cs]e|osl)(?: {_v('3 0')})?", "osl 3 0", "", ("open software", "osl")),
    ("afl-3", rf"(?:academic free licen[cs]e|afl)(?: {_v('3 0')})?", "afl 3 0", "", ("academic free", "afl")),
    ("artistic-1", rf"(?:perl )?artistic(?: licen[cs]e)? {_v('1 0')}", "artistic 1 0(?: perl| cl8)?", "", ("artistic",)),
    ("artistic-2", rf"(?:perl )?artistic(?: licen[cs]e)? {_v('2 0')}", "artistic 2 0", "opensource org licenses? artistic 2 0", ("artistic",)),
    ("boost-1", rf"boost(?: software)?(?: licen[cs]e)?(?: {_v('1 0')})?|bsl 1 0", "bsl 1 0", "boost org license 1 0", ("boost", "bsl")),
    ("zlib", r"zlib(?: libpng)?|libpng zlib", "zlib(?: acknowledgement)?", "zlib net zlib license", ("zlib",)),
    ("libpng", "libpng(?: 2 0)?", "libpng(?: 2 0)?", "", ("libpng",)),
    ("openssl", "openssl", "openssl", "openssl org source license", ("openssl",)),
    ("php-3", rf"php(?: licen[cs]e)?(?: {_v('3 0?1')})?", "php 3 0?1", "php net license", ("php",)),
    ("python-2", r"(?:python software foundation|psf|python)(?: licen[cs]e)?(?: (?:version |v ?)?2)?", "(?:python|psf) 2 0", "python org (?:psf )?license", ("python", "psf")),
    ("ruby", "ruby", "ruby", "ruby lang org [^ ]{1,60} license", ("ruby",)),
    ("postgresql", "postgresql", "postgresql", "postgresql org about licen[cs]e", ("postgresql",)),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa", "opensource org licenses? ncsa", ("ncsa",)),
    ("ofl-1.1", rf"(?:sil )?open font licen[cs]e(?: {_v('1 1')})?|ofl 1 1|sil ofl", "ofl 1 1(?: rfn| no rfn)?", "scripts sil org ofl", ("open font", "ofl")),
    ("ms-pl", "microsoft public|ms pl", "ms pl", "", ("microsoft public", "ms pl")),
    ("ms-rl", "microsoft reciprocal|ms rl", "ms rl", "", ("microsoft reciprocal", "ms rl")),
    ("unlicense", "unlicense", "unlicense", "unlicense org", ("unlicense",)),
    ("wtfpl", r"wtfpl|do what the [^ ]{1,60} you want to public licen[cs]e", "wtfpl", "wtfpl net", ("wtfpl", "do what the")),
    ("beerware", "beer ?ware", "beerware", "", ("beerware", "beer ware")),
    ("vim", "vim", "vim", "", ("vim",)),
    ("w3c", r"w3c(?: software(?: notice)?(?: and document)?)?", "w3c(?: 19980720| 20150513)?", "w3 org consortium legal", ("w3c", "w3 org")),
    ("cecill", r"cecill(?: [abc])?(?: [12] [01])?", "cecill (?:[abc]|[12] [01])", "cecill info", ("cecill",)),
    ("upl-1", rf"universal permissive(?: licen[cs]e)?(?: {_v('1 0')})?", "upl 1 0", "oss oracle com licenses upl", ("universal permissive", "upl")),
    ("bsl-1.1", rf"business source(?: licen[cs]e)?(?: {_v('1 1')})?", "busl 1 1", "mariadb com bsl11", ("business source", "busl", "bsl11")),
    ("sspl-1", rf"server side public licen[cs]e(?: {_v('1')})?|sspl", "sspl 1 0", "", ("server side public", "sspl")),
    ("elastic-2", rf"elastic(?: licen[cs]e)?(?: {_v('2 0')})?", "elastic 2 0", "elastic co licensing elastic license", ("elastic",)),
    ("json", "json", "json", "json org license", ("json",)),
    ("unicode", "unicode(?: inc)?", "unicode dfs 201[56]", "unicode org copyright", ("unicode",)),
    ("odbl-1", rf"(?:open (?:data commons )?(?:open )?database licen[cs]e|odbl)(?: {_v('1 0')})?", "odbl 1 0", "opendatacommons org licenses odbl", ("database licen", "odbl")),
    ("odc-by-1", "open data commons attribution|odc by", "odc by 1 0", "opendatacommons org licenses by", ("open data commons", "odc by", "opendatacommons")),
    ("pddl-1", "public domain dedication and licen[cs]e|pddl", "pddl 1 0", "opendatacommons org licenses pddl", ("public domain dedication", "pddl")),
    ("cc0", rf"cc0(?: 1 0)?(?: universal)?|{_CC} (?:cc0|zero)(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero", ("cc0", "commons zero", "cc zero", "publicdomain zero")),
    ("cc-by", rf"{_CC} (?:attribution|by){_CC_VERSION}", "cc by [1-4] [05]", "creativecommons org licenses by", ("creative commons attr", "creative commons by", "cc attr", "cc by", "licenses by")),
    ("cc-by-sa", rf"{_CC} (?:attribution share ?alike|by sa){_CC_VERSION}", "cc by sa [1-4] [05]", "creativecommons org licenses by sa", ("creative commons attr", "creative commons by", "cc attr", "cc by sa", "licenses by sa")),
    ("cc-by-nd", rf"{_CC} (?:attribution no ?deriv(?:ative)?s|by nd){_CC_VERSION}", "cc by nd [1-4] [05]", "creativecommons org licenses by nd", ("creative commons attr", "creative commons by", "cc attr", "cc by nd", "licenses by nd")),
    ("cc-by-nc", rf"{_CC} (?:attribution non ?commercial|by nc){_CC_VERSION}", "cc by nc [1-4] [05]", "creativecommons org licenses by nc", ("creative commons attr", "creative commons by", "cc attr", "cc by nc", "licenses by nc")),
    ("cc-by-nc-sa", rf"{_CC} (?:attribution non ?commercial share ?alike|by nc sa){_CC_VERSION}", "cc by nc sa [1-4] [05]", "creativecommons org licenses by nc sa", ("creative commons attr", "creative commons by", "cc attr", "cc by nc sa", "licenses by nc sa")),
    ("cc-by-nc-nd", rf"{_CC} (?:attribution non ?commercial no ?deriv(?:ative)?s|by nc nd){_CC_VERSION}", "cc by nc nd [1-4] [05]", "creativecommons org licenses by nc nd", ("creative commons attr", "creative commons by", "cc attr", "cc by nc nd", "licenses by nc nd")),
]

_TERMS = r"(?:the )?(?:(?:terms|conditions)(?: and conditions)? of )?(?:the )?(?:same )?"
_GRANT = r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|governed|shared|redistributed|offered)"
# Forms in which a license is named: name, priority, confidence, pattern around N (names), I (identifier) or A (address)
# and needs.
FORMS = [
    ("identifier", 1, 0.99, r"spdx licen[cs]e identifiers? (?:I)", ("spdx licen",)),
    ("grant", 2, 0.95, rf"{_GRANT} (?:by {GAP}{{1,4}})?under (?:an? )?{_TERMS}(?:N)(?: (?:public )?licen[cs]e)?(?: {_v('[1-4] [0-5]')})?", ("under",)),
    ("terms", 2, 0.9, r"(?:terms|conditions|provisions) of (?:the )?(?:N)(?: licen[cs]e)?", ("terms of", "conditions of", "provisions of")),
    ("field", 3, 0.85, r"licen[cs]es?(?: type| id| name| is)? (?:I)", ("licen",)),
    ("address", 3, 0.9, r"(?:www )?(?:A)", ()),
    ("title", 4, 0.8, r"(?:the )?(?:N) (?:public )?licen[cs]e(?: agreement)?", ("licen",)),
    ("dual", 4, 0.75, r"(?:dual|multi) licen[cs]ed (?:under )?(?:the )?(?:N)", ("licensed", "licenced")),
]
#: Names that say nothing outside a form that speaks of a license; of the others the bare name is a (weak) rule.
_COMMON = set("mit x11 isc bsd apache ruby vim json php-3 python-2 elastic-2 unicode openssl zlib libpng postgresql w3c boost-1 artistic-1 artistic-2 unlicense".split())

# Sentences of the licenses.  label, pattern, gates.
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "person obtaining a copy"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "copies or substantial portions"),
    ("x11", r"except as contained in this notice the name of (?:the )?x consortium shall not be used", "x consortium shall"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that", "with or without fee"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)", "with or without fee"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd-3", rf"neither the names? of {GAP}{{1,12}}nor the names? of (?:its|their|the) {GAP}{{0,4}}may be used to endorse or promote products", "neither the name"),
    ("bsd-4", r"all advertising materials mentioning features or use of this software must display", "all advertising materials"),
    ("apache-2", r"you may not use this (?:file|work|software) except in compliance with the license", "except in compliance with"),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "agreed to in writing software"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation", "developed by the apache"),
    ("gpl", r"you can redistribute it and or modify it under the terms of the gnu general public license", "under the terms of the gnu general"),
    ("gpl-2", r"gnu general public license as published by the free software foundation either version 2", "either version 2"),
    ("gpl-3", r"gnu general public license as published by the free software foundation either version 3", "either version 3"),
    ("gpl", rf"you should have received a copy of the gnu general public license {GAP}{{0,8}}if not", "received a copy of the gnu general"),
    ("lgpl", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "under the terms of the gnu l"),
    ("lgpl-2.1", r"gnu lesser general public license as published by the free software foundation either version 2 1", "either version 2 1"),
    ("lgpl-3", r"gnu lesser general public license as published by the free software foundation either version 3", "either version 3"),
    ("agpl-3", r"gnu affero general public license as published by the free software foundation either version 3", "either version 3"),
    ("agpl", r"you can redistribute it and or modify it under the terms of the gnu affero general public license", "under the terms of the gnu affero"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "modify this document under"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public license v 2 0", "source code form is subject"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", "subject to the mozilla public"),
    ("epl-1", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "accompanying materials are made"),
    ("epl-2", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0", "accompanying materials are made"),
    ("cddl-1", r"the contents of this file are subject to the terms of the common development and distribution license", "terms of the common development"),
    ("boost-1", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "person or organization obtaining"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "in no event will the authors"),
    ("zlib", r"the origin of this software must not be misrepresented", "must not be misrepresented"),
    ("openssl", r"this product includes software developed by the openssl project", "by the openssl project"),
    ("php-3", r"this product includes php software freely available from", "includes php software"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license", "font software is licensed"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "free and unencumbered"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", "as long as the name is changed"),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer", "you can buy me a beer"),
    ("json", r"the software shall be used for good not evil", "for good not evil"),
    ("ncsa", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software", "to deal with the software"),
    ("cc0", r"(?:has |have )?waived all copyright and related or neighboring rights", "related or neighboring rights"),
    ("public-domain", r"(?:is|are|released|placed|dedicated|donated) (?:hereby )?(?:in|into|to) the public domain", "the public domain"),
    ("public-domain", r"public domain (?:work|software|dedication|mark)", "public domain"),
    ("proprietary", r"all rights reserved", "all rights reserved"),
    ("proprietary", r"(?:confidential and proprietary|proprietary and confidential)", "confidential"),
    ("proprietary", r"unauthorized (?:copying|use|reproduction|distribution) (?:of this file |of this software )?(?:[^ ]{1,60} ){0,6}(?:is|are) (?:strictly )?prohibited", "unauthorized"),
    ("proprietary", r"no part of this (?:publication|work|document|book) may be reproduced", "may be reproduced"),
    ("noncommercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", "noncommercial|non commercial"),
]


def _rule(name: str, label: str, pattern: str, gates, needs, priority: int, confidence: float) -> Rule:
    whole = re.compile(rf"(?<= )(?:{pattern})(?= )", re.ASCII)
    return Rule(name, label, whole, tuple(f" {g}" for g in gates), tuple(f" {n}" for n in needs), priority, confidence)


def _license_rules() -> list[Rule]:
    rules = []
    for label, names, identifier, address, gates in LICENSES:
        for form, priority, confidence, pattern, needs in FORMS:
            if "(?:A)" in pattern and not address:
                continue
            for mark, value in (("(?:N)", names), ("(?:I)", identifier), ("(?:A)", address)):
                pattern = pattern.replace(mark, f"(?:{value})")
            rules.append(_rule(f"{label} {form}", label, pattern, gates, needs, priority, confidence))
        if label not in _COMMON:
            rules.append(_rule(f"{label} name", label, names, gates, (), 5, 0.6))
    return rules


def _sentence_rules() -> list[Rule]:
    weak = {"public-domain": (4, 0.7), "proprietary": (5, 0.5), "noncommercial": (5, 0.5)}
    return [
        _rule(f"{label} sentence {i}", label, pattern, gates.split("|"), (), *weak.get(label, (2, 0.95)))
        for i, (label, pattern, gates) in enumerate(SENTENCES)
    ]


RULES: list[Rule] = _license_rules() + _sentence_rules()
