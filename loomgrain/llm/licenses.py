"""License scan with ordered signature rules.

Hundreds of regular expressions, one per license and way of naming it, run over
the normalised words of a text. A keyword prefilter decides which of them run
at all. Rules have a priority; a detection that lies inside one of at least its
priority, or shares words with one of a higher priority, is suppressed.
Base phrases are found apart from the rules and are never suppressed.

Defined results: a NULL text counts as empty: no words, no labels, score 0.
Rows that repeat an id are scanned each. Only the id and the text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.arrow import map_texts

# The base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# what follows the name of a Creative Commons license
PORT = r"(?: [1-4] \d)?(?: (?:international|unported|generic))?(?: public)?"

# Licenses by family: label, the ways its name is written (a regular expression over normalised words), keywords one of which every writing has.
NAMES = (
    ("mit", r"mit(?: x11)?", ("mit",)),
    ("apache-1.1", r"apache(?: software)?(?: license)?(?: version| ver| v|v)? ?1 1", ("apache",)),
    ("apache-2", r"apache(?: software)?(?: license)?(?: version| ver| v|v)? ?2(?: 0)?", ("apache",)),
    ("bsd-2-clause", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)", ("bsd",)),
    ("bsd-3-clause", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)", ("bsd",)),
    ("bsd-4-clause", r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd|old bsd)", ("bsd",)),
    ("bsd-0-clause", r"(?:0bsd|zero clause bsd|bsd zero clause|bsd 0 clause)", ("bsd",)),
    ("gpl-1", r"(?:gnu )?(?:gpl|general public)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("gpl", "general public")),
    ("gpl-2", r"(?:gnu )?(?:gpl|general public)(?: license)?(?: version| ver| v|v)? ?2(?: 0)?", ("gpl", "general public")),
    ("gpl-3", r"(?:gnu )?(?:gpl|general public)(?: license)?(?: version| ver| v|v)? ?3(?: 0)?", ("gpl", "general public")),
    ("lgpl-2", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public)(?: license)?(?: version| ver| v|v)? ?2(?: 0)?", ("lgpl", "general public")),
    ("lgpl-2.1", r"(?:gnu )?(?:lgpl|lesser general public)(?: license)?(?: version| ver| v|v)? ?2 1", ("lgpl", "general public")),
    ("lgpl-3", r"(?:gnu )?(?:lgpl|lesser general public)(?: license)?(?: version| ver| v|v)? ?3(?: 0)?", ("lgpl", "general public")),
    ("agpl-1", r"(?:gnu )?(?:agpl|affero general public)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("agpl", "affero")),
    ("agpl-3", r"(?:gnu )?(?:agpl|affero general public)(?: license)?(?: version| ver| v|v)? ?3(?: 0)?", ("agpl", "affero")),
    ("gfdl-1.2", r"(?:gnu )?(?:gfdl|free documentation)(?: license)?(?: version| ver| v|v)? ?1 2", ("gfdl", "free documentation")),
    ("gfdl-1.3", r"(?:gnu )?(?:gfdl|free documentation)(?: license)?(?: version| ver| v|v)? ?1 3", ("gfdl", "free documentation")),
    ("mpl-1.1", r"(?:mpl|mozilla public)(?: license)?(?: version| ver| v|v)? ?1 1", ("mpl", "mozilla")),
    ("mpl-2", r"(?:mpl|mozilla public)(?: license)?(?: version| ver| v|v)? ?2(?: 0)?", ("mpl", "mozilla")),
    ("epl-1", r"(?:epl|eclipse public)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("epl", "eclipse")),
    ("epl-2", r"(?:epl|eclipse public)(?: license)?(?: version| ver| v|v)? ?2(?: 0)?", ("epl", "eclipse")),
    ("edl-1", r"(?:edl|eclipse distribution)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("edl", "eclipse")),
    ("eupl-1.1", r"(?:eupl|european union public)(?: licen[cs]e)?(?: version| ver| v|v)? ?1 1", ("eupl", "european union")),
    ("eupl-1.2", r"(?:eupl|european union public)(?: licen[cs]e)?(?: version| ver| v|v)? ?1 2", ("eupl", "european union")),
    ("cddl-1", r"(?:cddl|common development and distribution)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("cddl", "common development")),
    ("cpl-1", r"(?:cpl|common public)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("cpl", "common public")),
    ("artistic-1", r"artistic(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("artistic",)),
    ("artistic-2", r"artistic(?: license)?(?: version| ver| v|v)? ?2(?: 0)?", ("artistic",)),
    ("isc", r"isc", ("isc",)),
    ("zlib", r"zlib(?: libpng)?", ("zlib",)),
    ("boost-1", r"(?:bsl|boost software)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("bsl", "boost")),
    ("unlicense", r"unlicense", ("unlicense",)),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public)", ("wtfpl", "what the fuck")),
    ("cc0-1", r"(?:cc0|cc zero|creative commons zero)(?: v?1 0)?(?: universal)?", ("cc0", "cc zero", "creative commons")),
    ("cc-by", rf"(?:cc by|creative commons attribution){PORT}", ("cc by", "creative commons")),
    ("cc-by-sa", rf"(?:cc by sa|creative commons attribution share ?alike){PORT}", ("cc by", "creative commons")),
    ("cc-by-nd", rf"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?){PORT}", ("cc by", "creative commons")),
    ("cc-by-nc", rf"(?:cc by nc|creative commons attribution non ?commercial){PORT}", ("cc by", "creative commons")),
    ("cc-by-nc-sa", rf"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike){PORT}", ("cc by", "creative commons")),
    ("cc-by-nc-nd", rf"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?){PORT}", ("cc by", "creative commons")),
    ("odbl-1", r"(?:odbl|open database)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("odbl", "open database")),
    ("ofl-1.1", r"(?:ofl|sil open font)(?: license)?(?: version| ver| v|v)? ?1 1", ("ofl", "sil open")),
    ("psf-2", r"(?:psf|python software foundation)(?: license)?(?: version| ver| v|v)? ?2(?: 0)?", ("psf", "python software")),
    ("postgresql", r"postgresql", ("postgresql",)),
    ("ms-pl", r"(?:ms pl|microsoft public)", ("ms pl", "microsoft")),
    ("ms-rl", r"(?:ms rl|microsoft reciprocal)", ("ms rl", "microsoft")),
    ("osl-3", r"(?:osl|open software)(?: license)?(?: version| ver| v|v)? ?3(?: 0)?", ("osl", "open software")),
    ("afl-3", r"(?:afl|academic free)(?: license)?(?: version| ver| v|v)? ?3(?: 0)?", ("afl", "academic free")),
    ("upl-1", r"(?:upl|universal permissive)(?: license)?(?: version| ver| v|v)? ?1(?: 0)?", ("upl", "universal permissive")),
    ("ncsa", r"(?:ncsa|university of illinois ncsa)(?: open source)?", ("ncsa",)),
)

# Ways to name a license: priority (higher first), what the text must hold (one of them), pattern; {n} is the name.
OF = r"(?:(?:the|an?) )?(?:terms (?:and conditions )?of (?:(?:the|an?) )?)?"
GIVEN = ("released", "distributed", "published", "available", "provided")
FORMS = (
    (90, ("spdx",), r"spdx license identifier {n}"),
    (80, ("licen",), rf"licen[cs]ed under {OF}{{n}}(?: licen[cs]e)?"),
    (75, tuple(f"{word} under" for word in GIVEN), rf"(?:{'|'.join(GIVEN)}) under {OF}{{n}}(?: licen[cs]e)?"),
    (70, ("licen",), rf"under {OF}{{n}} licen[cs]e"),
    (65, ("licen",), rf"subject to {OF}{{n}}(?: public)? licen[cs]e"),
    (60, ("licen",), r"licen[cs]e {n}"),
    (50, ("licen",), r"{n} licen[cs]e"),
)

# a name with the word license between name and version stands alone
NAMED = (55, ("licen",))

# Families named without a version: label, short names, full names, keywords. All their forms have a lower priority than those above.
FAMILIES = (
    ("gpl", r"(?:gnu )?gpl", r"(?:gnu )?general public", ("gpl", "general public")),
    ("lgpl", r"(?:gnu )?lgpl", r"(?:gnu )?(?:lesser|library) general public", ("lgpl", "general public")),
    ("agpl", r"(?:gnu )?agpl", r"(?:gnu )?affero general public", ("agpl", "affero")),
    ("gfdl", r"(?:gnu )?gfdl", r"(?:gnu )?free documentation", ("gfdl", "free documentation")),
    ("bsd", r"bsd(?: style)?", r"berkeley software distribution", ("bsd", "berkeley")),
    ("apache", r"apache", r"apache software", ("apache",)),
    ("mpl", r"mpl", r"mozilla public", ("mpl", "mozilla")),
    ("epl", r"epl", r"eclipse public", ("epl", "eclipse")),
    ("edl", r"edl", r"eclipse distribution", ("edl", "eclipse")),
    ("eupl", r"eupl", r"european union public", ("eupl", "european union")),
    ("cddl", r"cddl", r"common development and distribution", ("cddl", "common development")),
    ("cpl", r"cpl", r"common public", ("cpl", "common public")),
    ("boost", r"bsl", r"boost(?: software)?", ("bsl", "boost")),
    ("odbl", r"odbl", r"open database", ("odbl", "open database")),
    ("ofl", r"ofl", r"(?:sil )?open font", ("ofl", "open font")),
    ("psf", r"psf", r"python software foundation", ("psf", "python software")),
    ("osl", r"osl", r"open software", ("osl", "open software")),
    ("afl", r"afl", r"academic free", ("afl", "academic free")),
    ("upl", r"upl", r"universal permissive", ("upl", "universal permissive")),
    ("cc", r"creative commons", r"creative commons(?: public)?", ("creative commons",)),
)
# {s} is the short name, {f} the full one, which needs the word license; so does a short one that is not said to be licensed.
FAMILY_FORMS = (
    (48, ("licen",), rf"licen[cs]ed under {OF}(?:{{s}}(?: licen[cs]e)?|{{f}} licen[cs]e)"),
    (46, tuple(f"{word} under" for word in GIVEN), rf"(?:{'|'.join(GIVEN)}) under {OF}(?:{{s}}(?: licen[cs]e)?|{{f}} licen[cs]e)"),
    (44, ("licen",), rf"(?:under|subject to) {OF}(?:{{s}}|{{f}}) licen[cs]e"),
    (42, ("licen",), r"(?:{s}|{f}) licen[cs]e"),
    (40, ("licen",), r"licen[cs]e {s}"),
)

# Sentences of license texts: label, priority, what the text must hold, sentence.
SENTENCES = (
    ("mit", 95, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", 95, "permission to use copy", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 85, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 95, "nor the names", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse"),
    ("apache-2", 95, "you may obtain a copy", r"you may obtain a copy of the license at https? www apache org licenses license 2 0"),
    ("gpl", 85, "free software you can", r"free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 86, "lesser general public", r"under the terms of the gnu lesser general public license"),
    ("agpl", 86, "affero general public", r"under the terms of the gnu affero general public license"),
    ("mpl-2", 95, "this source code form", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", 95, "free and unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", 60, "public domain", r"(?:released|dedicated|placed) (?:in|in to|into|to) the public domain"),
    ("proprietary", 55, "all rights reserved", r"all rights reserved"),
    ("zlib", 95, "altered source versions", r"altered source versions must be plainly marked as such and must not be misrepresented"),
    ("cc-by", 88, "creativecommons org", r"creativecommons org licenses by [1-4] \d"),
    ("cc-by-sa", 88, "creativecommons org", r"creativecommons org licenses by sa [1-4] \d"),
    ("cc-by-nc", 88, "creativecommons org", r"creativecommons org licenses by nc [1-4] \d"),
    ("cc0-1", 88, "creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("cc-by-nd", 88, "creativecommons org", r"creativecommons org licenses by nd [1-4] \d"),
    ("cc-by-nc-sa", 88, "creativecommons org", r"creativecommons org licenses by nc sa [1-4] \d"),
    ("cc-by-nc-nd", 88, "creativecommons org", r"creativecommons org licenses by nc nd [1-4] \d"),
    ("public-domain", 88, "creativecommons org", r"creativecommons org publicdomain mark 1 0"),
    ("gpl-2", 91, "published by the free software foundation", r"(?:general public license|gpl) as published by the free software foundation (?:either )?version 2"),
    ("gpl-3", 91, "published by the free software foundation", r"(?:general public license|gpl) as published by the free software foundation (?:either )?version 3"),
    ("lgpl-2.1", 92, "published by the free software foundation", r"(?:lesser general public license|lgpl) as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-3", 92, "published by the free software foundation", r"(?:lesser general public license|lgpl) as published by the free software foundation (?:either )?version 3"),
    ("agpl-3", 92, "published by the free software foundation", r"(?:affero general public license|agpl) as published by the free software foundation (?:either )?version 3"),
    ("gpl-2", 88, "gnu org", r"gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", 88, "gnu org", r"gnu org licenses gpl 3 0"),
    ("mit", 88, "opensource org", r"opensource org licenses? mit"),
    ("bsd-3-clause", 88, "opensource org", r"opensource org licenses? bsd 3 clause"),
    ("mpl-2", 88, "mozilla org", r"mozilla org (?:en us )?mpl 2 0"),
    ("apache-1.1", 90, "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("bsd-4-clause", 95, "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("openssl", 90, "openssl project", r"this product includes software developed by the openssl project"),
    ("boost-1", 95, "obtaining a copy of the software and accompanying", r"any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("wtfpl", 90, "what the fuck you want to", r"you just do what the fuck you want to"),
    ("beerware", 85, "beer", r"(?:the )?beer ?ware license"),
    ("fsf-all-permissive", 90, "copying and distribution of this file", r"copying and distribution of this file with or without modification are permitted in any medium"),
    ("sspl-1", 85, "server side public license", r"server side public license"),
    ("busl-1.1", 85, "business source license", r"business source license"),
    ("artistic", 48, "the artistic license", r"(?:under|terms of) the artistic license"),
)

NOT_A_WORD = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
LOWER = bytes(range(256)).lower().translate(NOT_A_WORD)

RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "found array<struct<label:string,first_word:long,last_word:long,priority:int>>"
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    gates: tuple[str, ...]
    pattern: re.Pattern


def rules() -> list[Rule]:
    """All rules, highest priority first."""
    made = [
        Rule(label, priority, keywords, gates, re.compile(rf"(?<= ){form.format(n=f'(?:{name})')}(?= )"))
        for label, name, keywords in NAMES
        for priority, gates, form in FORMS
    ]
    for label, name, keywords in NAMES:
        named = re.sub(r"\(\?: (licen\[?[cs]+\]?e)\)\?", r" \1", name)
        if named != name:
            made.append(Rule(label, NAMED[0], keywords, NAMED[1], re.compile(rf"(?<= )(?:{named})(?= )")))
    made += [
        Rule(label, priority, keywords, gates, re.compile(rf"(?<= ){form.format(s=f'(?:{short})', f=f'(?:{full})')}(?= )"))
        for label, short, full, keywords in FAMILIES
        for priority, gates, form in FAMILY_FORMS
    ]
    made += [Rule(label, priority, (key,), (key,), re.compile(rf"(?<= ){text}(?= )")) for label, priority, key, text in SENTENCES]
    return sorted(made, key=lambda rule: (-rule.priority, rule.label))


def normalised(text: str | None) -> list[bytes]:
    """The words: A-Z in lower case, everything ASCII that is no letter or digit separates."""
    return (text or "").encode("utf-8").translate(LOWER).split()


def places(spaced: str, phrase: str) -> list[int]:
    """Character offsets in `` w w w `` where the phrase's words stand consecutively, overlaps included."""
    needle, found, at = f" {phrase} ", [], spaced.find(f" {phrase} ")
    while at >= 0:
        found.append(at)
        at = spaced.find(needle, at + 1)
    return found


def settled(detections: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """(first, last, priority, label) left after suppression, by place.

    A detection goes if it shares words with one of a higher priority that
    stays, or lies inside one of its own priority. One sweep per priority; what
    higher priorities cover is a sorted list of disjoint intervals.
    """
    kept, covered = [], []
    for priority in sorted({d[2] for d in detections}, reverse=True):
        starts = [start for start, _ in covered]
        furthest, stay = -1, []
        for found in sorted((d for d in detections if d[2] == priority), key=lambda d: (d[0], -d[1], d[3])):
            first, last = found[:2]
            near = bisect_right(starts, last) - 1
            if last <= furthest or (near >= 0 and covered[near][1] >= first):
                continue
            furthest = last
            stay.append(found)
        kept += stay
        merged = []
        for first, last in sorted([*covered, *((d[0], d[1]) for d in stay)]):
            if merged and first <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
            else:
                merged.append((first, last))
        covered = merged
    return sorted(kept)


class Scanner:
    """Runs the rules over one text after another."""

    def __init__(self):
        self.rules = rules()
        # one of its rule's gates and one of its keywords is in every match
        self.gates = sorted({gate for rule in self.rules for gate in rule.gates})
        self.keywords = sorted({keyword for rule in self.rules for keyword in rule.keywords})

    def detections(self, spaced: str) -> list[tuple[int, int, int, str]]:
        """Unsuppressed detections as word intervals."""
        gates = {gate for gate in self.gates if gate in spaced}
        if not gates:
            return []
        keywords = {keyword for keyword in self.keywords if keyword in spaced}
        found = set()
        for rule in self.rules:
            if not gates.isdisjoint(rule.gates) and not keywords.isdisjoint(rule.keywords):
                for m in rule.pattern.finditer(spaced):
                    found.add((m.start(), m.end(), rule.priority, rule.label))
        if not found:
            return []
        starts = [m.start() for m in re.finditer(" ", spaced)]
        return [(bisect_left(starts, a - 1), bisect_left(starts, b) - 1, p, label) for a, b, p, label in found]

    def scan(self, text: str | None) -> tuple:
        words = normalised(text)
        spaced = f" {b' '.join(words).decode('utf-8')} " if words else ""
        base = [(at, label) for phrase, label in BASE_PHRASES for at in places(spaced, phrase)]
        if base:
            blanks = [m.start() for m in re.finditer(" ", spaced)]
            base = [(bisect_left(blanks, at), label) for at, label in base]
        found = settled(self.detections(spaced))
        base_labels = sorted({label for _, label in base})
        labels = sorted({*base_labels, *(label for _, _, _, label in found)})
        strongest = max([70 if base else 0, *(priority for _, _, priority, _ in found)])
        return (
            len(words),
            len(base),
            min((at for at, _ in base), default=None),
            max((at for at, _ in base), default=None),
            ",".join(base_labels),
            ",".join(labels),
            strongest / 100,
            [{"label": label, "first_word": a, "last_word": b, "priority": p} for a, b, p, label in found],
        )


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, the columns of RESULT with ``found``: the detections left after suppression."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def start():
        scanner = Scanner()
        return lambda key, text: (key, *scanner.scan(text))

    return map_texts(docs.select(F.col(id_column), F.col(text_column)), f"`{id_column}` {id_type}, {RESULT}", start)
