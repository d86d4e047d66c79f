"""License scans: ordered signature rules with a keyword prefilter, priorities and containment suppression.

Rules are regular expressions over the text with A-Z lower-cased; a blank in a rule stands for any run of characters that
aren't letters or digits. An Aho-Corasick automaton finds which keywords a text holds, and only rules whose pattern can
match with those are run: the gate of a rule is read from its own pattern, so it holds back no match. A detection inside
the interval of one of higher priority (or an equal, longer one) is suppressed, so "GNU Lesser General Public License"
isn't also the GPL. The base phrases are places of whole words; their labels always stay.

One pass over whole texts, without a shuffle. Defined results: null or empty text has no words, no places and score 0;
repeated rows are scanned alike; an empty table gives none; a text of any length is scanned as a whole.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafile.llm.words import LOWER, rounds, spans, text_bytes

#: Base phrases: consecutive words, and the label of each.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label; name as a pattern; identifiers as patterns.
LICENSES = [
    ("mit", "mit|expat", "mit"),
    ("mit-0", "mit no attribution", "mit 0"),
    ("apache-2", "apache(?: software)? licen[cs]e v(?:ersion )?2(?: 0)?|apache 2(?: 0)?", "apache 2(?: 0)?"),
    ("apache-1.1", "apache(?: software)? licen[cs]e v(?:ersion )?1 1", "apache 1 1"),
    ("apache-1", "apache(?: software)? licen[cs]e v(?:ersion )?1(?: 0)?", "apache 1 0"),
    ("bsd-2-clause", "(?:simplified|2 clause|two clause|freebsd) bsd|bsd (?:2|two) clause", "bsd 2 clause"),
    ("bsd-3-clause", "(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause", "bsd 3 clause"),
    ("bsd-4-clause", "(?:original|4 clause|four clause) bsd|bsd (?:4|four) clause", "bsd 4 clause"),
    ("0bsd", "(?:zero clause|0 clause) bsd", "0bsd"),
    ("bsd", "bsd(?: style)?", "bsd"),
    ("isc", "isc", "isc"),
    ("gpl-1", "gnu general public licen[cs]e v(?:ersion )?1|gnu gpl ?v?1", "gpl 1 0"),
    ("gpl-2", "gnu general public licen[cs]e v(?:ersion )?2|gnu gpl ?v?2", "gpl 2 0"),
    ("gpl-3", "gnu general public licen[cs]e v(?:ersion )?3|gnu gpl ?v?3", "gpl 3 0"),
    ("gpl", "gnu general public|gnu gpl", "gpl"),
    ("lgpl-2", "gnu (?:library|lesser) general public licen[cs]e v(?:ersion )?2(?: 0)?", "lgpl 2 0"),
    ("lgpl-2.1", "gnu lesser general public licen[cs]e v(?:ersion )?2 1", "lgpl 2 1"),
    ("lgpl-3", "gnu lesser general public licen[cs]e v(?:ersion )?3", "lgpl 3 0"),
    ("lgpl", "gnu (?:library|lesser) general public", "lgpl"),
    ("agpl-3", "(?:gnu )?affero general public licen[cs]e v(?:ersion )?3", "agpl 3 0"),
    ("agpl", "(?:gnu )?affero general public", "agpl"),
    ("gfdl", "gnu free documentation", "gfdl 1 [123]"),
    ("mpl-1", "mozilla public licen[cs]e v(?:ersion )?1(?: 0)?", "mpl 1 0"),
    ("mpl-1.1", "mozilla public licen[cs]e v(?:ersion )?1 1", "mpl 1 1"),
    ("mpl-2", "mozilla public licen[cs]e v(?:ersion )?2(?: 0)?", "mpl 2 0"),
    ("mpl", "mozilla public", "mpl"),
    ("epl-1", "eclipse public licen[cs]e v(?:ersion )?1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse public licen[cs]e v(?:ersion )?2(?: 0)?", "epl 2 0"),
    ("epl", "eclipse public", "epl"),
    ("cddl-1", "common development and distribution|cddl", "cddl 1 [01]"),
    ("cpl-1", "common public", "cpl 1 0"),
    ("ibm-public", "ibm public", "ipl 1 0"),
    ("artistic-1", "artistic licen[cs]e v?(?:ersion )?1(?: 0)?", "artistic 1 0"),
    ("artistic-2", "artistic licen[cs]e v?(?:ersion )?2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", "artistic"),
    ("boost-1", "boost software", "bsl 1 0"),
    ("zlib", "zlib|zlib libpng", "zlib"),
    ("libpng", "libpng", "libpng"),
    ("openssl", "openssl", "openssl"),
    ("python-2", "python(?: software foundation)?", "(?:psf|python) 2 0"),
    ("php-3", "php", "php 3 01"),
    ("ruby", "ruby", "ruby"),
    ("postgresql", "postgresql", "postgresql"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("x11", "x11|mit x11", "x11"),
    ("ncsa", "(?:university of illinois )?ncsa", "ncsa"),
    ("afl-3", "academic free", "afl 3 0"),
    ("osl-3", "open software", "osl 3 0"),
    ("ecl-2", "educational community", "ecl 2 0"),
    ("ms-pl", "microsoft public", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "ms rl"),
    ("eupl-1.2", "european union public", "eupl 1 2"),
    ("cecill", "cecill", "cecill 2 1"),
    ("apsl-2", "apple public source", "apsl 2 0"),
    ("sleepycat", "sleepycat", "sleepycat"),
    ("vim", "vim", "vim"),
    ("ofl-1.1", "sil open font", "ofl 1 1"),
    ("odbl", "open database", "odbl 1 0"),
    ("odc-by", "open data commons attribution", "odc by 1 0"),
    ("pddl", "open data commons public domain dedication", "pddl 1 0"),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "cc by(?! (?:nc|nd|sa))", "cc by [1-4] [05]"),
    ("cc-by-sa", "cc by sa", "cc by sa [1-4] [05]"),
    ("cc-by-nd", "cc by nd", "cc by nd [1-4] [05]"),
    ("cc-by-nc", "cc by nc(?! (?:nd|sa))", "cc by nc [1-4] [05]"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd [1-4] [05]"),
    ("cc-by", "creative commons attribution(?! (?:non|no|share))", "creativecommons org licenses by"),
    ("cc-by-sa", "creative commons attribution share ?alike", "creativecommons org licenses by sa"),
    ("cc-by-nd", "creative commons attribution no ?deriv\\w*", "creativecommons org licenses by nd"),
    ("cc-by-nc", "creative commons attribution non ?commercial(?! (?:no|share))", "creativecommons org licenses by nc"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv\\w*", "creativecommons org licenses by nc nd"),
    ("ogl", "open government", "ogl uk 3 0"),
    ("bsl-1.1", "business source", "busl 1 1"),
    ("sspl-1", "server side public", "sspl 1 0"),
    ("elastic-2", "elastic", "elastic 2 0"),
]

#: What makes a rule of a name or identifier: priority (1 is highest), confidence, field, pattern.
TEMPLATES = [
    (1, 0.99, "id", "spdx licen[cs]e identifier {}"),
    (2, 0.95, "name", "(?:licen[cs]ed|released|distributed|published|available|provided)(?: \\w+)? under(?: the)?(?: terms of)?(?: the)? (?:{})(?: licen[cs]e)?"),
    (2, 0.95, "name", "(?:subject to|governed by|covered by|according to) the(?: terms of the)? (?:{})(?: licen[cs]e)?"),
    (3, 0.8, "name", "(?:{}) licen[cs]e"),
    (3, 0.8, "id", "licen[cs]e (?:is )?{}"),
]

#: Rules that belong to no single license: label, priority, confidence, pattern.
OTHERS = [
    ("all-rights-reserved", 3, 0.7, "all rights reserved"),
    ("public-domain", 3, 0.7, "(?:released|dedicated|placed)(?: in)?to? the public domain"),
    ("public-domain", 4, 0.5, "public domain"),
    ("copyright", 4, 0.3, "copyright (?:c )?(?:19|20)\\d\\d"),
    ("proprietary", 3, 0.7, "proprietary and confidential"),
]

#: Signatures of the licenses' own wording, written by hand: label, priority, confidence, pattern. ``{gap}`` spans what stands
#: between two sentences of one notice, so that a longer signature holds a shorter one, which is then suppressed.
HELD_BY = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
BSD_START = "redistribution and use in source and binary forms with or without modification are permitted"
ANY_USE = "permission to use copy modify(?: and| and or| or)? distribute this software"
CC_BOUND = "you accept and agree to be bound by the terms and conditions of this creative commons"
WORDINGS = [
    ("mit", 3, 0.97, HELD_BY + " the software to deal in the software without restriction"),
    ("mit", 3, 0.9, "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit-0", 2, 0.98, HELD_BY + " the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("x11", 2, 0.97, HELD_BY + "{gap}except as contained in this notice the names? of"),
    ("json", 2, 0.98, HELD_BY + "{gap}the software shall be used for good not evil"),
    ("ncsa", 2, 0.97, HELD_BY + " the software to deal with the software without restriction"),
    ("boost-1", 2, 0.98, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsd", 4, 0.9, BSD_START),
    ("bsd-2-clause", 2, 0.97, BSD_START + " provided that the following conditions are met{gap}the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by"),
    ("bsd-3-clause", 3, 0.97, BSD_START + "{gap}(?:neither the names? of|the names? of the author may not be used to endorse)"),
    ("bsd-4-clause", 2, 0.97, BSD_START + "{gap}all advertising materials mentioning features or use of this software must display the following acknowledge?ment{gap}(?:neither the names? of|the names? of the author may not be used to endorse)"),
    ("apache-1.1", 2, 0.97, BSD_START + "{gap}this product includes software developed by the apache software foundation"),
    ("openssl", 1, 0.97, BSD_START + "{gap}this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("isc", 3, 0.95, ANY_USE + " for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("curl", 2, 0.97, "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is without warranty of any kind"),
    ("0bsd", 2, 0.97, ANY_USE + " for any purpose with or without fee is hereby granted the software is provided as is"),
    ("hpnd", 2, 0.95, "permission to use copy modify(?: sell)? and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted provided that the above copyright notice appears? in all copies"),
    ("postgresql", 2, 0.97, "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("apache-2", 2, 0.97, "you may not use this file except in compliance with the license you may obtain a copy of the license at https? www apache org licenses license 2 0"),
    ("apache-2", 3, 0.8, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", 2, 0.97, "apache license version 2 0 january 2004"),
    ("gpl-1", 2, 0.97, "(?:program|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 1 "),
    ("gpl-2", 2, 0.98, "(?:program|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license(?: version 2)? as published by the free software foundation either version 2 "),
    ("gpl-3", 2, 0.98, "(?:program|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 "),
    ("gpl-1", 2, 0.97, "the license agreements of most software companies try to keep users at the mercy of those companies"),
    ("gpl-2", 2, 0.97, "gnu general public license version 2 june 1991"),
    ("gpl-3", 2, 0.97, "gnu general public license version 3 29 june 2007"),
    ("gpl-3", 2, 0.97, "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-2", 2, 0.98, "under the terms of the gnu library general public license as published by the free software foundation either version 2 "),
    ("lgpl-2.1", 2, 0.98, "under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1"),
    ("lgpl-3", 2, 0.98, "under the terms of the gnu lesser general public license as published by the free software foundation either version 3 "),
    ("lgpl-2", 2, 0.97, "this is the first released version of the library gpl"),
    ("lgpl-2.1", 2, 0.97, "this is the first released version of the lesser gpl"),
    ("lgpl-3", 2, 0.97, "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("agpl-3", 2, 0.98, "under the terms of the gnu affero general public license as published by the free software foundation either version 3 "),
    ("agpl-3", 2, 0.97, "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl", 2, 0.98, "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", 2, 0.95, "make a manual textbook or other functional and useful document free in the sense of freedom"),
    ("mpl-1", 2, 0.98, "the contents of this file are subject to the mozilla public license version 1 0"),
    ("mpl-1.1", 2, 0.98, "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2", 2, 0.98, "this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0"),
    ("epl-1", 2, 0.98, "made available under the terms of the eclipse public license v(?:ersion)? ?1 0"),
    ("epl-2", 2, 0.98, "made available under the terms of the eclipse public license v(?:ersion)? ?2 0"),
    ("epl", 2, 0.9, "the accompanying program is provided under the terms of this eclipse public license"),
    ("cpl-1", 2, 0.97, "the accompanying program is provided under the terms of this common public license"),
    ("ibm-public", 2, 0.97, "the accompanying program is provided under the terms of this ibm public license"),
    ("cddl-1", 2, 0.98, "the contents of this file are subject to the terms of the common development and distribution license"),
    ("artistic-1", 2, 0.97, "the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2", 2, 0.97, "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("zlib", 2, 0.97, "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("libpng", 2, 0.95, "the origin of this source code must not be misrepresented"),
    ("python-2", 2, 0.97, "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly"),
    ("php-3", 2, 0.97, "this product includes php software freely available from"),
    ("unlicense", 2, 0.98, "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 2, 0.97, "do what the fuck you want to public license"),
    ("beerware", 2, 0.97, "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("vim", 2, 0.95, "there are no restrictions on distributing unmodified copies of vim"),
    ("sleepycat", 2, 0.9, "redistributions in any form must be accompanied by information on how to obtain complete source code for the"),
    ("ms-rl", 2, 0.95, "for any file you distribute that contains code from the software in source code or binary format you must provide recipients the source code"),
    ("eupl-1.2", 2, 0.9, "this european union public licence the eupl applies to the work"),
    ("cecill", 2, 0.97, "this software is governed by the cecill(?: [bc])? license under french law and abiding by the rules of distribution of free software"),
    ("ofl-1.1", 2, 0.98, "this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", 2, 0.97, "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("odbl", 2, 0.97, "this [0-9a-z]+(?: [0-9a-z]+)? is made available under the open database license"),
    ("cc0", 2, 0.97, "affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"),
    ("cc0", 2, 0.95, "dedicated the work to the public domain by waiving all of his or her rights to the work worldwide"),
    ("cc-by", 2, 0.97, CC_BOUND + " attribution [1-4] [05]"),
    ("cc-by-sa", 2, 0.97, CC_BOUND + " attribution share ?alike [1-4] [05]"),
    ("cc-by-nd", 2, 0.97, CC_BOUND + " attribution no ?derivatives [1-4] [05]"),
    ("cc-by-nc", 2, 0.97, CC_BOUND + " attribution non ?commercial [1-4] [05]"),
    ("cc-by-nc-sa", 2, 0.97, CC_BOUND + " attribution non ?commercial share ?alike [1-4] [05]"),
    ("cc-by-nc-nd", 2, 0.97, CC_BOUND + " attribution non ?commercial no ?derivatives [1-4] [05]"),
    ("bsl-1.1", 2, 0.97, "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl-1", 2, 0.97, "if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available"),
    ("elastic-2", 2, 0.97, "you may not provide the software to third parties as a hosted or managed service"),
]
#: Characters that a ``{gap}`` spans at most: longer than any clause that stands between two signatures of one notice.
GAP = " [\\s\\S]{0,1500}? "

WORD, BETWEEN = "0-9a-z\x80-\xff", "[^0-9a-z\x80-\xff]+"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    gate: tuple[frozenset[str], ...]
    pattern: re.Pattern


def _compiled(pattern: str) -> re.Pattern:
    pattern = pattern.replace("\\w", f"[{WORD}]").replace(" ?", f"(?:{BETWEEN})?").replace(" ", BETWEEN)
    return re.compile(f"(?<![{WORD}])(?:{pattern})(?![{WORD}])")


def _needed(parsed) -> list[frozenset[str]]:
    """What every match of a parsed pattern holds: of each set at least one literal."""
    sets, run = [], ""
    for kind, value in [*parsed, (None, None)]:
        if kind is sre.LITERAL and value != ord(" "):
            run += chr(value)
            continue
        sets, run = [*sets, *([frozenset([run])] if run else [])], ""
        if kind is sre.SUBPATTERN:
            sets += _needed(value[-1])
        elif kind is sre.MAX_REPEAT and value[0]:
            sets += _needed(value[2])
        elif kind is sre.BRANCH:  # a match holds all sets of one branch, so of any choice of a set per branch at least one
            sets += [frozenset().union(*chosen) for chosen in itertools.product(*map(_needed, value[1]))]
    return sets


def _gate(pattern: str) -> tuple[frozenset[str], ...]:
    """The sets of :func:`_needed` that tell most: none of single characters, none that another one implies."""
    sets = {s for s in _needed(sre_parser.parse(pattern)) if min(map(len, s)) > 1}
    gate = [s for s in sets if not any(other < s for other in sets)]
    return tuple(sorted(gate, key=lambda s: (-min(map(len, s)), len(s), sorted(s))))


def _rule(label: str, priority: int, confidence: float, pattern: str, words: int | None = None) -> Rule:
    """``words`` bounds the gate to the words that tell most; a match holds those as well."""
    return Rule(label, priority, confidence, _gate(pattern)[:words], _compiled(pattern))


def rules() -> list[Rule]:
    """The signature rules in order: each license by each template, those of no single license, and the licenses' wording."""
    made = []
    for label, name, own_id in LICENSES:
        for priority, confidence, field, template in TEMPLATES:
            pattern = template.replace("{}", name if field == "name" else own_id)
            if field == "id" and template.startswith("licen") and " " not in own_id and not own_id[-1].isdigit():
                continue  # a bare word after "license" is no identifier
            made.append(_rule(label, priority, confidence, pattern))
        if name.count(" ") and "licen" in name or label.startswith("cc"):
            made.append(_rule(label, 3, 0.8, f"(?:{name})"))
    wordings = [_rule(label, p, c, pattern.replace("{gap}", GAP).strip(), 4) for label, p, c, pattern in WORDINGS]
    return made + [_rule(*other) for other in OTHERS] + wordings


class Scanner:
    def __init__(self):
        import ahocorasick

        self.rules = rules()
        self.base = [(label, _compiled(phrase)) for phrase, label in BASE.items()]
        self.base_keywords = [max(phrase.split(), key=len) for phrase in BASE]
        wanted = sorted(set().union(*(s for rule in self.rules for s in rule.gate)))
        self.by_word: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            for w in rule.gate[0]:
                self.by_word.setdefault(w, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for w in wanted:
            self.automaton.add_word(w, w)
        self.automaton.make_automaton()

    def base_places(self, text: str) -> list[tuple[int, str]]:
        """(start, label) of all places of the base phrases."""
        found = []
        for (label, pattern), keyword in zip(self.base, self.base_keywords, strict=True):
            if keyword in text:
                found += [(m.start(), label) for m in pattern.finditer(text)]
        return found

    def detections(self, text: str) -> list[tuple[int, int, int, float, str]]:
        """(start, end, priority, confidence, label) that no other of higher priority holds."""
        held = {w for _, w in self.automaton.iter(text)}
        if not held:
            return []
        found = []
        for i in {i for w in held for i in self.by_word.get(w, ())}:
            r = self.rules[i]
            if not any(s.isdisjoint(held) for s in r.gate):
                found += [(m.start(), m.end(), r.priority, r.confidence, r.label) for m in r.pattern.finditer(text)]
        return unsuppressed(found)


def unsuppressed(found: list[tuple[int, int, int, float, str]]) -> list[tuple[int, int, int, float, str]]:
    """Detections that lie in no interval of higher priority, nor in a longer one, or an earlier rule's, of their own.

    One sweep by start: an interval that began no later holds this one if it ends no earlier.
    """
    kept, reach = [], {}
    for d in sorted(set(found), key=lambda d: (d[0], -d[1], d[2], -d[3], d[4])):
        if not any(p <= d[2] and end >= d[1] for p, end in reach.items()):
            kept.append(d)
        reach[d[2]] = max(reach.get(d[2], 0), d[1])
    return kept


@functools.lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

PLACE = pa.struct([("label", pa.string()), ("word", pa.int64())])
FOUND = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32()), ("confidence", pa.float64())])


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = scanner()
    for batch in rounds(batches):
        data, offsets = text_bytes(batch.column("text"))
        starts, _, first = spans(data, offsets, NOT_WORD)
        lowered = LOWER[data].tobytes()
        places, found = [], []
        for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist(), strict=False)):
            text = lowered[a:b].decode("latin-1")  # one character a byte
            own = starts[first[i] : first[i + 1]] - a
            places.append([{"label": label, "word": int(np.searchsorted(own, at))} for at, label in sorted(scan.base_places(text))])
            found.append([dict(zip(("start", "end", "priority", "confidence", "label"), d, strict=True)) for d in scan.detections(text)])
        columns = [batch.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), pa.array(places, pa.list_(PLACE)), pa.array(found, pa.list_(FOUND))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "places", "detections"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the base places (label, start word) and the rules' detections (label, byte span, priority)."""
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(
        _scan_batches,
        "doc_id bigint, n_words bigint, places array<struct<label:string,word:bigint>>, "
        "detections array<struct<label:string,start:bigint,end:bigint,priority:int,confidence:double>>",
    )


def license_report(docs: DataFrame) -> DataFrame:
    """The query's columns, from the places and detections."""
    df = scan_licenses(docs)
    base, other = F.transform("places", lambda p: p["label"]), F.transform("detections", lambda d: d["label"])
    words = F.transform("places", lambda p: p["word"])
    doubt = F.aggregate("detections", F.lit(1.0), lambda left, d: left * (1 - d["confidence"]))
    return df.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, other)), ",").alias("labels"),
        (1 - doubt * F.when(F.size("places") > 0, 0.05).otherwise(1.0)).alias("score"),
    )
