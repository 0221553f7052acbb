"""Signature rules of the license scan.

A rule is (rule id, label, priority, keyword, pattern, weight). Patterns run on
the normalised text: lower-cased words joined by one space. Rules are written
by hand per license family (the name as people write it) and per form of words
(a grant, a file tag, a reference, a bare name), so a family and a form give
one regex each. A rule only runs when its keyword (empty: none) occurs in the
normalised text; keywords are part of every match, so they only save time.
"""

from __future__ import annotations

from re import _constants as ops
from re import _parser

# License families. (label, keyword, name as a regex over words, tag words, needs the word "license" when bare)
FAMILIES = [
    ("mit", "", r"(?:the )?(?:expat|mit)(?: x11)?", "mit", True),
    ("mit-0", "mit", r"mit no attribution", "mit 0", False),
    ("apache-1.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? 1(?: 0)?(?! 1)", "apache 1 0", True),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version| v)? 1 1", "apache 1 1", True),
    ("apache-2", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version| v| v2)? ?2(?: 0)?", "apache 2 0", False),
    ("bsd-2-clause", "", r"(?:simplified|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", "bsd 2 clause", True),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)", "bsd 3 clause", True),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", "bsd 4 clause", True),
    ("0bsd", "bsd", r"(?:zero clause bsd|0 clause bsd|bsd zero clause)", "0bsd", True),
    ("gpl-1", "g", r"(?:gnu )?(?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?1(?: 0)?", "gpl 1 0(?: only| or later)?", False),
    ("gpl-2", "g", r"(?:gnu )?(?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?", False),
    ("gpl-3", "g", r"(?:gnu )?(?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?", False),
    ("gpl", "g", r"(?:gnu (?:gpl|general public license)|general public license|gpl)", "gpl", False),
    ("lgpl-2", "l", r"(?:gnu )?(?:library general public license|lesser general public license|lgpl)(?: version| v)? ?2(?: 0)?", "lgpl 2 0(?: only| or later)?", False),
    ("lgpl-2.1", "l", r"(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?2 1", "lgpl 2 1(?: only| or later)?", False),
    ("lgpl-3", "l", r"(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?", False),
    ("lgpl", "l", r"(?:gnu )?(?:lesser general public license|lgpl)", "lgpl", False),
    ("agpl-3", "a", r"(?:gnu )?(?:affero general public license|agpl)(?: version| v)? ?3(?: 0)?", "agpl 3 0(?: only| or later)?", False),
    ("agpl", "a", r"(?:gnu )?(?:affero general public license|agpl)", "agpl", False),
    ("gfdl", "", r"(?:gnu )?free documentation license(?:(?: version| v)? 1 [123])?", "gfdl 1 [123](?: only| or later)?", False),
    ("mpl-1.1", "m", r"(?:mozilla public license|mpl)(?: version| v)? 1 1", "mpl 1 1", False),
    ("mpl-2", "m", r"(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?", "mpl 2 0", False),
    ("epl-1", "e", r"(?:eclipse public license|epl)(?: version| v)? 1(?: 0)?", "epl 1 0", False),
    ("epl-2", "e", r"(?:eclipse public license|epl)(?: version| v)? 2(?: 0)?", "epl 2 0", False),
    ("cddl-1", "c", r"(?:common development and distribution license|cddl)(?:(?: version| v)? 1 [01])?", "cddl 1 [01]", False),
    ("cpl-1", "", r"common public license(?:(?: version| v)? 1 0)?", "cpl 1 0", False),
    ("isc", "isc", r"isc", "isc", True),
    ("zlib", "zlib", r"zlib(?: libpng)?", "zlib", True),
    ("bsl-1", "", r"boost(?: software license)?(?:(?: version| v)? 1(?: 0)?)?", "bsl 1 0", True),
    ("artistic-1", "artistic", r"artistic license(?: version| v)? 1(?: 0)?", "artistic 1 0", False),
    ("artistic-2", "artistic", r"artistic license(?: version| v)? 2(?: 0)?", "artistic 2 0", False),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl", False),
    ("unlicense", "unlicense", r"unlicense", "unlicense", False),
    ("cc0-1", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0", False),
    ("eupl-1", "eu", r"(?:european union public licen[cs]e|eupl)(?:(?: version| v)? 1 [012])?", "eupl 1 [012]", False),
    ("ofl-1.1", "o", r"(?:sil open font license|ofl)(?:(?: version| v)? 1 1)?", "ofl 1 1", False),
    ("psf-2", "p", r"(?:python software foundation license|psf license)(?:(?: version| v)? 2)?", "psf 2 0", False),
    ("postgresql", "postgresql", r"postgresql", "postgresql", True),
    ("ms-pl", "m", r"(?:microsoft public license|ms pl)", "ms pl", False),
    ("ms-rl", "m", r"(?:microsoft reciprocal license|ms rl)", "ms rl", False),
    ("odbl-1", "o", r"(?:open database license|odbl)(?:(?: version| v)? 1 0)?", "odbl 1 0", False),
    ("pddl-1", "", r"public domain dedication and license(?:(?: version| v)? 1 0)?", "pddl 1 0", False),
    ("vim", "vim", r"vim", "vim", True),
    ("openssl", "openssl", r"openssl", "openssl", True),
    ("php-3", "php", r"php(?: license)?(?:(?: version| v)? 3(?: 01)?)?", "php 3(?: 01?)?", True),
    ("busl-1.1", "", r"business source license(?:(?: version| v)? 1 1)?", "busl 1 1", False),
    ("elastic-2", "elastic", r"elastic license(?: version| v)? 2(?: 0)?", "elastic 2 0", False),
    ("sspl-1", "s", r"(?:server side public license|sspl)(?:(?: version| v)? 1)?", "sspl 1 0", False),
]

# Creative Commons terms; every subset that exists, longest first
CC_TERMS = [("by nc nd", "by-nc-nd"), ("by nc sa", "by-nc-sa"), ("by nc", "by-nc"), ("by nd", "by-nd"), ("by sa", "by-sa"), ("by", "by")]
CC_NAMES = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}

# Forms of words. (form, priority, weight, template)
FORMS = [
    ("grant", 90, 1.0, r"(?:licen[cs]ed|released|distributed|redistributed|published|provided|issued|available|made available|offered|covered) (?:to you )?(?:under|by|according to)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {name}(?: licen[cs]e)?"),
    ("tag", 95, 1.0, r"spdx license identifier {tag}"),
    ("reference", 70, 0.8, r"(?:see|read|refer to|subject to|governed by|terms of|copy of|under)(?: the)? {name}(?: licen[cs]e)?"),
    ("dual", 80, 0.9, r"(?:dual|dually|multi) licen[cs]ed under(?: the)? {name}"),
    ("bare", 30, 0.5, r"{bare}"),
]

# Texts and notices that stand alone. (rule id, label, priority, keyword, pattern, weight)
NOTICES = [
    ("mit-text", "mit", 100, "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("mit-warranty", "mit", 60, "warranty", r"the software is provided as is without warranty of any kind", 0.6),
    ("bsd-text", "bsd-3-clause", 100, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("isc-text", "isc", 100, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 1.0),
    ("gpl-later", "gpl", 85, "version", r"either version [123] of the license or at your option any later version", 0.9),
    ("gpl-preamble", "gpl", 60, "free software", r"this program is free software you can redistribute it", 0.8),
    ("zlib-text", "zlib", 100, "altered", r"altered source versions must be plainly marked as such", 0.9),
    ("unlicense-text", "unlicense", 100, "public domain", r"this is free and unencumbered software released into the public domain", 1.0),
    ("public-domain", "public-domain", 50, "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain", 0.8),
    ("all-rights", "proprietary", 40, "rights reserved", r"all rights reserved", 0.4),
    ("some-rights", "some-rights-reserved", 40, "rights reserved", r"some rights reserved", 0.4),
    ("no-redistribution", "proprietary", 75, "prohibited", r"(?:unauthori[sz]ed )?(?:copying|reproduction|redistribution|distribution) (?:of this (?:file|work|document) )?(?:via any medium )?is strictly prohibited", 0.8),
    ("proprietary", "proprietary", 75, "proprietary", r"proprietary and confidential", 0.8),
    ("copyright", "copyright-notice", 20, "copyright", r"copyright(?: c)? (?:1 ?9|2 ?0)[0-9 ]{2,3}", 0.3),
]


def build_rules() -> list[tuple]:
    """All rules, in order: (id, label, priority, keyword, pattern, weight)."""
    rules = []
    for label, keyword, name, tag, needs_word in FAMILIES:
        bare = f"{name} licen[cs]e" if needs_word else name
        for form, priority, weight, text in FORMS:
            rules.append((f"{label}-{form}", label, priority, keyword,
                          text.format(name=name, tag=tag, bare=bare), weight))
    for terms, label in CC_TERMS:
        named = " ".join(CC_NAMES[t] for t in terms.split())
        name = rf"(?:creative commons |cc )(?:{terms}|{named})(?! (?:nc|nd|sa|non|share|no)\b)(?: [1-4] [05])?(?: international| unported)?"
        for form, priority, weight, text in FORMS:
            rules.append((f"cc-{label}-{form}", f"cc-{label}", priority, "c", text.format(name=name, tag=rf"cc {terms}(?! (?:nc|nd|sa)\b) [1-4] [05]", bare=name), weight))
    return rules + NOTICES


# Words that are poor signs of a license, and words of license texts in general
COMMON = set("""a according and any as at available by conditions copy covered either for free general governed in is issued it
    made of offered open or provided public published read refer released see server side software source subject terms the this
    to under use version with you your""".split())
USUAL = {"license", "licence", "licen", "licensed", "licenced"}


def _ends(items: list, last: bool) -> tuple[set | None, bool]:
    """Characters that a match can begin (or end) with, None for unknown ones, and whether it can be empty."""
    out: set = set()
    for op, arg in reversed(items) if last else items:
        if op is ops.LITERAL:
            return out | {arg}, False
        if op in (ops.ASSERT, ops.ASSERT_NOT, ops.AT):
            continue
        if op is ops.BRANCH:
            some = [_ends(list(x), last) for x in arg[1]]
        elif op is ops.SUBPATTERN:
            some = [_ends(list(arg[3]), last)]
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            chars, empty = _ends(list(arg[2]), last)
            some = [(chars, empty or not arg[0])]
        else:
            return None, False
        if any(chars is None for chars, _ in some):
            return None, False
        out = out.union(*[chars for chars, _ in some])
        if not any(empty for _, empty in some):
            return out, False
    return out, True


def _spaced(items: list, last: bool, outside: bool) -> bool:
    """Whether the character next to ``items``' end, seen from inside the pattern, is always a space."""
    chars, empty = _ends(items, last)
    return chars is not None and chars <= {32} and (outside or not empty)


def _cost(words: frozenset | None) -> tuple:
    """Order of choice: rare and long words first."""
    if not words:
        return (9, 0, 0)

    def rank(w: str) -> int:
        bare = w.strip()
        if bare in COMMON or len(w) < 4:
            return 3
        return 2 if bare in USUAL else int(w[0] != " ")

    return (max(map(rank, words)), -min(map(len, words)), len(words), sorted(words))


def _necessary(items: list, left: bool, right: bool) -> frozenset | None:
    """Words of which every match has one; ``left``, ``right``: a space always stands there."""
    found, i = [], 0
    while i < len(items):
        op, arg = items[i]
        j = i + 1
        before = _spaced(items[:i], True, left)
        if op is ops.LITERAL:
            while j < len(items) and items[j][0] is ops.LITERAL:
                j += 1
            run = items[i:j]
            if j < len(items) and items[j][0] is ops.BRANCH:      # the parser took out a common beginning
                after = _spaced(items[j + 1:], False, right)
                parts = [_necessary(run + list(x), before, after) for x in items[j][1][1]]
                if all(parts):
                    found.append(frozenset().union(*parts))
            after = _spaced(items[j:], False, right)
            words = "".join(chr(c) for _, c in run).split(" ")
            for k, w in enumerate(words):
                if w:
                    found.append(frozenset([" " * (k > 0 or before) + w + " " * (k < len(words) - 1 or after)]))
        else:
            after = _spaced(items[j:], False, right)
            if op is ops.BRANCH:
                parts = [_necessary(list(x), before, after) for x in arg[1]]
                if all(parts):
                    found.append(frozenset().union(*parts))
            elif op is ops.SUBPATTERN:
                found.append(_necessary(list(arg[3]), before, after))
            elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[0]:
                found.append(_necessary(list(arg[2]), False, False))
        i = j
    return min(found, key=_cost, default=None)


def necessary_words(pattern: str) -> frozenset | None:
    """Single words of which every match of a rule's pattern has one; None if there are none.

    A space before or after a word says that the word begins or ends there.
    """
    return _necessary(list(_parser.parse(pattern)), True, True)
