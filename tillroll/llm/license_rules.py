"""The ordered signature rules of the license scan.

A rule is a regular expression over words: lower-case, parted by single spaces, each with a space
before it. Rules come from two hand-written tables: families of named licenses, each in the few
forms in which texts cite a license, and sentences of license texts. Their order is their
priority: license tags first, then sentences, grants, titles with a version, bare titles.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache


@dataclass(frozen=True)
class Rule:
    """`gates`: a match holds at least one word of each of these sets."""

    label: str
    tier: int
    confidence: float
    pattern: str
    gates: tuple[frozenset[str], ...]


@dataclass(frozen=True)
class Family:
    """A license by name. `anchors` are words of which every name holds one, alone or with its version.

    An `everyday` name means a license only next to that word or a grant.
    """

    label: str
    names: str
    anchors: str
    versions: str = ""
    everyday: bool = False


# Names and versions of public licenses.
FAMILIES = [
    Family("0bsd", "(?:0bsd|zero clause bsd|bsd zero clause|0 clause bsd)", "0bsd bsd"),
    Family("aal", "attribution assurance", "assurance", everyday=True),
    Family("afl", "(?:academic free(?: licen[sc]e)?|afl)", "academic afl", "1.1 1.2 2.0 2.1 3.0"),
    Family("agpl", "(?:(?:gnu )?affero (?:general public licen[sc]e|gpl)|(?:gnu )?agpl)", "affero agpl", "1.0 3.0"),
    Family("apache", "(?:apache(?: software)?|asl)", "apache asl", "1.0 1.1 2.0", everyday=True),
    Family("apsl", "(?:apple public source(?: licen[sc]e)?|apsl)", "apple apsl", "1.0 1.1 1.2 2.0"),
    Family("artistic", "(?:the )?artistic", "artistic", "1.0 2.0", everyday=True),
    Family("beerware", "beer ?ware", "beerware beer", everyday=True),
    Family("bittorrent", "bittorrent(?: open source)?", "bittorrent", "1.0 1.1", everyday=True),
    Family("bsd-2-clause", "(?:bsd 2 clause|(?:2|two) clause bsd|simplified bsd|freebsd)", "bsd freebsd", everyday=True),
    Family("bsd-3-clause", "(?:bsd 3 clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)", "bsd"),
    Family("bsd-4-clause", "(?:bsd 4 clause|(?:4|four) clause bsd|original bsd)", "bsd"),
    Family("bsd", "bsd(?: style)?", "bsd", everyday=True),
    Family("bsl", "(?:boost software|bsl)", "boost bsl", "1.0", everyday=True),
    Family("busl", "(?:business source|busl)", "business busl", "1.0 1.1", everyday=True),
    Family("cc-by-nc-nd", "(?:cc by nc nd|(?:creative commons )?attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)", "cc attribution", "1.0 2.0 2.5 3.0 4.0"),
    Family("cc-by-nc-sa", "(?:cc by nc sa|(?:creative commons )?attribution non ?commercial share ?alike)", "cc attribution", "1.0 2.0 2.5 3.0 4.0"),
    Family("cc-by-nc", "(?:cc by nc|(?:creative commons )?attribution non ?commercial)", "cc attribution", "1.0 2.0 2.5 3.0 4.0"),
    Family("cc-by-nd", "(?:cc by nd|(?:creative commons )?attribution no ?deriv(?:ative)?s?(?: works)?)", "cc attribution", "1.0 2.0 2.5 3.0 4.0"),
    Family("cc-by-sa", "(?:cc by sa|(?:creative commons )?attribution share ?alike)", "cc attribution", "1.0 2.0 2.5 3.0 4.0"),
    Family("cc-by", "(?:cc by|creative commons attribution)", "cc creative", "1.0 2.0 2.5 3.0 4.0"),
    Family("cc0", "(?:cc0|cc zero|creative commons (?:zero|0))", "cc0 cc creative", "1.0"),
    Family("cddl", "(?:common development and distribution(?: licen[sc]e)?|cddl)", "distribution cddl", "1.0 1.1"),
    Family("cecill", "cecill", "cecill", "1.0 1.1 2.0 2.1"),
    Family("commons-clause", "commons clause", "clause"),
    Family("cpal", "(?:common public attribution(?: licen[sc]e)?|cpal)", "attribution cpal", "1.0"),
    Family("cpl", "(?:common public licen[sc]e|cpl)", "common cpl", "0.5 1.0"),
    Family("dl-de-by", "(?:dl de by|data licen[sc]e germany attribution|datenlizenz deutschland namensnennung)", "dl germany deutschland", "2.0"),
    Family("ecl", "(?:educational community(?: licen[sc]e)?|ecl)", "educational ecl", "1.0 2.0", everyday=True),
    Family("efl", "eiffel forum", "eiffel", "1.0 2.0", everyday=True),
    Family("elastic", "elastic", "elastic", "1.0 2.0", everyday=True),
    Family("epl", "(?:eclipse public(?: licen[sc]e)?|epl)", "eclipse epl", "1.0 2.0"),
    Family("etalab", "(?:etalab|licence ouverte(?: open licence)?)", "etalab ouverte", "1.0 2.0"),
    Family("eupl", "(?:european union public(?: licen[sc]e)?|eupl)", "european eupl", "1.0 1.1 1.2"),
    Family("fdk-aac", "fraunhofer fdk aac(?: codec library)?", "fraunhofer"),
    Family("ftl", "(?:the )?free ?type(?: project)?", "freetype free", everyday=True),
    Family("gfdl", "(?:(?:gnu )?free documentation licen[sc]e|gfdl)", "documentation gfdl", "1.1 1.2 1.3"),
    Family("gpl", "(?:(?:gnu )?general public licen[sc]e|gnu gpl|gpl)", "general gpl", "1.0 2.0 3.0"),
    Family("hpnd", "historical permission notice(?: and disclaimer)?", "historical"),
    Family("icu", "(?:icu|unicode)", "icu unicode", everyday=True),
    Family("ijg", "independent jpeg group", "jpeg"),
    Family("imagemagick", "imagemagick", "imagemagick", everyday=True),
    Family("ipl", "ibm public(?: licen[sc]e)?", "ibm", "1.0"),
    Family("isc", "isc", "isc", everyday=True),
    Family("json", "(?:the )?json", "json", everyday=True),
    Family("lgpl", "(?:(?:gnu )?(?:lesser|library) (?:general public licen[sc]e|gpl)|(?:gnu )?lgpl)", "lesser library lgpl", "2.0 2.1 3.0"),
    Family("libpng", "libpng", "libpng", "1.0 2.0", everyday=True),
    Family("llama", "llama(?: (?:2|3))?(?: community)?", "llama", everyday=True),
    Family("lppl", "(?:latex project public(?: licen[sc]e)?|lppl)", "latex lppl", "1.0 1.1 1.2 1.3"),
    Family("mit-0", "mit (?:0|no attribution|zero)", "mit", everyday=True),
    Family("mit", "(?:mit(?: x11)?|expat|x11)", "mit expat x11", everyday=True),
    Family("mpl", "(?:mozilla public(?: licen[sc]e)?|mpl)", "mozilla mpl", "1.0 1.1 2.0"),
    Family("ms-pl", "(?:microsoft public(?: licen[sc]e)?|ms pl)", "microsoft ms"),
    Family("ms-rl", "(?:microsoft reciprocal(?: licen[sc]e)?|ms rl)", "microsoft ms"),
    Family("mulanpsl", "mulan (?:permissive software|psl)", "mulan", "1.0 2.0"),
    Family("nasa", "nasa open source(?: agreement)?", "nasa", "1.3"),
    Family("ncsa", "(?:university of illinois ncsa(?: open source)?|ncsa)", "ncsa", everyday=True),
    Family("nlod", "norwegian licen[sc]e for open government data", "norwegian", "1.0 2.0"),
    Family("npl", "(?:netscape public(?: licen[sc]e)?|npl)", "netscape npl", "1.0 1.1"),
    Family("odbl", "(?:(?:open data commons )?open database(?: licen[sc]e)?|odbl)", "database odbl", "1.0"),
    Family("odc-by", "(?:open data commons attribution(?: licen[sc]e)?|odc by)", "commons odc", "1.0"),
    Family("ofl", "(?:sil )?open font(?: licen[sc]e)?", "font", "1.0 1.1"),
    Family("ogl", "open government", "government", "1.0 2.0 3.0", everyday=True),
    Family("openrail", "(?:bigscience |creativeml )?(?:open ?rail(?: (?:m|s|d|pp))*|open responsible ai)", "openrail open"),
    Family("openssl", "openssl(?: ssleay)?", "openssl", everyday=True),
    Family("osl", "(?:open software licen[sc]e|osl)", "software osl", "1.0 1.1 2.0 2.1 3.0"),
    Family("pddl", "(?:(?:open data commons )?public domain dedication and licen[sc]e|pddl)", "dedication pddl", "1.0"),
    Family("php", "php", "php", "3.0 3.01", everyday=True),
    Family("postgresql", "postgresql", "postgresql", everyday=True),
    Family("psf", "(?:python software foundation|psf|python)", "python psf", "2.0", everyday=True),
    Family("qpl", "(?:q public(?: licen[sc]e)?|qpl)", "q qpl", "1.0"),
    Family("rpl", "(?:reciprocal public(?: licen[sc]e)?|rpl)", "reciprocal rpl", "1.1 1.5"),
    Family("ruby", "ruby", "ruby", everyday=True),
    Family("sleepycat", "sleepycat", "sleepycat", everyday=True),
    Family("spl", "sun public", "sun", "1.0", everyday=True),
    Family("sspl", "(?:server side public(?: licen[sc]e)?|sspl)", "server sspl", "1.0"),
    Family("unlicense", "(?:the )?unlicen[sc]e", "unlicense unlicence"),
    Family("upl", "(?:universal permissive(?: licen[sc]e)?|upl)", "universal upl", "1.0"),
    Family("vim", "vim", "vim", everyday=True),
    Family("w3c", "w3c(?: software(?: notice)?(?: and)?)?", "w3c", everyday=True),
    Family("wtfpl", "(?:do what the fuck you want to public licen[sc]e|wtfpl)", "fuck wtfpl", "1.0 2.0"),
    Family("zlib", "zlib(?: libpng)?", "zlib", everyday=True),
    Family("zpl", "(?:zope public(?: licen[sc]e)?|zpl)", "zope zpl", "1.1 2.0 2.1"),
]

# Label, anchor words of which a match holds one, and the sentence.
SENTENCES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "hereby fee", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification(?:s)? are permitted"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "basis", "software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-2.0", "apache", "www apache org licenses license 2 0"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e"),
    ("gpl", "gnu", "www gnu org licenses(?: old licenses)? gpl"),
    ("lgpl", "gnu", "www gnu org licenses(?: old licenses)? lgpl"),
    ("agpl", "gnu", "www gnu org licenses agpl"),
    ("gfdl", "invariant", "with no invariant sections"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl-2.0", "mozilla", "mozilla org mpl 2 0"),
    ("epl", "eclipse", "www eclipse org legal epl"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "dedicated domain", "dedicated to the public domain"),
    ("public-domain", "domain", "(?:is|are|has been|have been) (?:placed |released )?in(?:to)? the public domain"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("bsl-1.0", "boost", "www boost org license 1 0"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("commons-clause", "sell", "the licen[sc]e does not grant to you the right to sell the software"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("proprietary", "proprietary", "(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "permission", "(?:may not|no part (?:of \\S+ (?:\\S+ )?)?may) be (?:copied|reproduced|distributed)(?: \\S+){0,8} without (?:the )?(?:prior |express |written )*permission"),
    ("proprietary", "unauthorized unauthorised", "unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: \\S+){0,8} is (?:strictly )?prohibited"),
    ("source-available", "evaluation", "for (?:internal )?evaluation purposes only"),
    ("non-commercial", "commercial noncommercial", "(?:for )?(?:personal(?: and| or) )?non ?commercial use only"),
]

TAG, SENTENCE, GRANT, TITLE, BARE = range(1, 6)
CONFIDENCE = {TAG: 1.0, SENTENCE: 0.95, GRANT: 0.9, TITLE: 0.8, BARE: 0.5}
VERBS = "(?:dual |multi |re)?licen[sc]ed|released|distributed|redistributed|published|available|provided|issued|shared|offered"
UNDER = f"(?:{VERBS}) (?:\\S+ )?under(?: either)?(?: the| a| an)?(?: terms(?: and conditions)? of)?(?: the| a| an)?"
WORD = "(?: licen[sc]e)?"
NEEDED_WORD = " licen[sc]e"
WORDS = frozenset(["license", "licence"])
LATER = "(?: (?:only|(?:or|and)(?: at your option)?(?: any)? (?:later|newer)(?: version)?))?"


def _number(version: str) -> str:
    """`2.1` as the words of that version; a closing zero may be left out."""
    return version.replace(".", " ").removesuffix(" 0") + ("(?: 0)?" if version.endswith(".0") else "")


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


def _family_rules(family: Family) -> list[Rule]:
    found = []
    majors = {version.split(".")[0] for version in family.versions.split()}
    named = _words(family.anchors) | {f"{word}v{major}" for word in family.anchors.split() for major in majors}
    for version in [*family.versions.split(), ""]:
        label = f"{family.label}-{version}" if version else family.label
        number = f"(?: (?:version |ver |v )?v?|v){_number(version)}{LATER}" if version else ""
        tag = label.replace("-", " ").replace(".", " ")
        tagged = frozenset([*tag.split()])

        def add(tier: int, pattern: str, *gates: frozenset[str], label: str = label) -> None:
            found.append(Rule(label, tier, CONFIDENCE[tier], f" {pattern}", gates))

        add(TAG, f"spdx licen[sc]e identifier {tag}{LATER}", frozenset(["spdx"]), tagged)
        add(GRANT, f"{UNDER} {family.names}{WORD}{number}{WORD}", frozenset(["under"]), named)
        if version:
            title = f"{family.names}(?:{NEEDED_WORD}{number}|{number}{NEEDED_WORD})" if family.everyday else f"{family.names}{WORD}{number}"
            add(TITLE, title, named, *([WORDS] if family.everyday else []))
        elif family.everyday:
            add(BARE, f"{family.names}{NEEDED_WORD}", named, WORDS)
        else:
            add(BARE, family.names, named)
    return found


@cache
def rules() -> tuple[Rule, ...]:
    """All rules by priority; within a tier in the order of the tables."""
    found = [rule for family in FAMILIES for rule in _family_rules(family)]
    for label, anchors, sentence in SENTENCES:
        found.append(Rule(label, SENTENCE, CONFIDENCE[SENTENCE], f" {sentence}", (_words(anchors),)))
    return tuple(sorted(found, key=lambda rule: rule.tier))
