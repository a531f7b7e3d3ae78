"""License scans: ordered signature rules over the words of a text.

A text is read as its words (runs of letters, digits and non-ASCII characters, A-Z folded),
joined by single spaces. A rule is a pattern over that string with a label, a priority, a
confidence and keywords; it is tried only where one of its keywords occurs. Detections that
overlap are resolved by priority, then length: a detection contained in one that was
accepted before it is dropped. The base phrases are reported apart, all their places.

Of detections with one priority and place the first by label stays.
Null and empty texts have no words and no labels; every row gives one row, in any number and
order of repeats; other columns are not looked at.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadbook.llm.arrays import ALPHANUMERIC, LOWER, text_bytes
from squadbook.llm.tasks import map_batches, slices

# Phrases looked for and the label of each.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Licenses by label: names as words, the short identifier, and keywords one of which any name has.
LICENSES = {
    "mit": ("mit|expat", "mit", "mit expat"),
    "apache-2": ("apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache 2 0", "apache"),
    "apache-1.1": ("apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1", "apache"),
    "bsd-2-clause": ("(?:simplified|freebsd|2 clause|two clause) bsd|bsd 2 clause", "bsd 2 clause", "bsd"),
    "bsd-3-clause": ("(?:new|modified|3 clause|three clause) bsd|bsd 3 clause", "bsd 3 clause", "bsd"),
    "bsd-4-clause": ("(?:original|4 clause|four clause) bsd|bsd 4 clause", "bsd 4 clause", "bsd"),
    "0bsd": ("zero clause bsd|0bsd", "0bsd", "bsd"),
    "isc": ("isc|internet systems consortium", "isc", "isc internet"),
    "gpl-2": ("gnu general public license(?: version)? 2|(?:gnu )?gpl(?: version)? ?v? ?2(?: 0)?", "gpl 2 0", "gnu gpl"),
    "gpl-3": ("gnu general public license(?: version)? 3|(?:gnu )?gpl(?: version)? ?v? ?3(?: 0)?", "gpl 3 0", "gnu gpl"),
    "lgpl-2.1": ("gnu lesser general public license(?: version)? 2 1|lgpl ?v? ?2 1", "lgpl 2 1", "gnu gpl"),
    "lgpl-3": ("gnu lesser general public license(?: version)? 3|lgpl ?v? ?3(?: 0)?", "lgpl 3 0", "gnu gpl"),
    "agpl-3": ("gnu affero general public license(?: version)? 3|agpl ?v? ?3(?: 0)?", "agpl 3 0", "gnu gpl"),
    "gpl": ("(?:gnu )?gpl|gnu general public license", "gpl", "gnu gpl"),
    "gpl-2-or-later": (
        "(?:gnu general public license|(?:gnu )?gpl)(?: version)? ?v? ?2(?: 0)? (?:or(?: any)? later|plus)(?: versions?)?",
        "gpl 2 0 or later",
        "gnu gpl",
    ),
    "gpl-3-or-later": (
        "(?:gnu general public license|(?:gnu )?gpl)(?: version)? ?v? ?3(?: 0)? (?:or(?: any)? later|plus)(?: versions?)?",
        "gpl 3 0 or later",
        "gnu gpl",
    ),
    "lgpl": ("(?:gnu )?lgpl|gnu (?:lesser|library) general public license", "lgpl", "gnu gpl"),
    "lgpl-2.1-or-later": (
        "(?:gnu lesser general public license|(?:gnu )?lgpl)(?: version)? ?v? ?2 1 or(?: any)? later(?: versions?)?",
        "lgpl 2 1 or later",
        "gnu gpl",
    ),
    "agpl": ("(?:gnu )?agpl|gnu affero general public license", "agpl", "gnu gpl"),
    "apache": ("apache(?: software)?", "apache", "apache"),
    "bsd": ("bsd(?: style)?|berkeley software distribution", "bsd", "bsd berkeley"),
    "mpl": ("mpl|mozilla public license", "mpl", "mozilla mpl"),
    "mpl-1.1": ("mozilla public license(?: version)? 1 1|mpl ?v? ?1 1", "mpl 1 1", "mozilla mpl"),
    "epl": ("epl|eclipse public license", "epl", "eclipse epl"),
    "mpl-2": ("mozilla public license(?: version)? 2(?: 0)?|mpl ?v? ?2(?: 0)?", "mpl 2 0", "mozilla mpl"),
    "epl-2": ("eclipse public license(?: version)? 2(?: 0)?", "epl 2 0", "eclipse epl"),
    "epl-1": ("eclipse public license(?: version)? 1(?: 0)?", "epl 1 0", "eclipse epl"),
    "cddl-1": ("common development and distribution license(?: version)? 1(?: 0)?", "cddl 1 0", "distribution cddl"),
    "bsl-1": ("boost software license(?: version)? 1(?: 0)?", "bsl 1 0", "boost bsl"),
    "artistic-2": ("artistic license(?: version)? 2(?: 0)?", "artistic 2 0", "artistic"),
    "zlib": ("zlib(?: libpng)?", "zlib", "zlib"),
    "unlicense": ("unlicense", "unlicense", "unlicense"),
    "wtfpl": ("do what the fuck you want to public license|wtfpl", "wtfpl", "wtfpl want"),
    "ofl-1.1": ("sil open font license(?: version)? 1 1", "ofl 1 1", "sil ofl"),
    "postgresql": ("postgresql", "postgresql", "postgresql"),
    "python-2": ("python software foundation license(?: version)? 2", "psf 2 0", "python psf"),
    "cc0": ("cc0(?: 1 0)?|creative commons zero", "cc0 1 0", "cc0 creative"),
    "cc-by": ("cc by|creative commons attribution", "cc by 4 0", "cc creative"),
    "cc-by-sa": ("cc by sa|creative commons attribution share ?alike", "cc by sa 4 0", "cc creative"),
    "cc-by-nc": ("cc by nc|creative commons attribution non ?commercial", "cc by nc 4 0", "cc creative"),
    "cc-by-nd": ("cc by nd|creative commons attribution no ?deriv(?:ative)?s", "cc by nd 4 0", "cc creative"),
    "cc-by-nc-sa": (
        "cc by nc sa|creative commons attribution non ?commercial share ?alike",
        "cc by nc sa 4 0",
        "cc creative",
    ),
    "cc-by-nc-nd": (
        "cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s",
        "cc by nc nd 4 0",
        "cc creative",
    ),
}

_TERMS = "(?:the )?(?:terms of (?:the )?)?"
_LICENSE = "(?: licen[cs]e)?"

# How a text states a license: keywords, a pattern around a name, priority (low first), confidence.
STATEMENTS = [
    ("spdx", "spdx license identifier {spdx}", 0, 1.0),
    ("under", "(?:licen[cs]ed|released|distributed|published|provided|available) under " + _TERMS + "(?:{name})" + _LICENSE, 1, 0.95),
    ("subject covered governed", "(?:subject to|covered by|governed by) " + _TERMS + "(?:{name})" + _LICENSE, 2, 0.9),
    ("redistribut modify copy", "(?:redistribut[a-z]*|modify|copy)(?: [^ ]+){{0,6}} under " + _TERMS + "(?:{name})" + _LICENSE, 3, 0.85),
    ("under", "under " + _TERMS + "(?:{name})" + _LICENSE, 4, 0.8),
    ("see read refer", "(?:see|read|refer to) (?:the )?(?:{name}) licen[cs]e", 4, 0.75),
    ("licen", "(?:the )?(?:{name}) licen[cs]ed?(?: agreement| terms)?", 5, 0.7),
    ("licen", "licen[cs]ed? (?:is |as |type )?(?:the )?(?:{name})", 6, 0.6),
]

# Wordings that need no name: label, keywords, pattern, priority, confidence.
WORDINGS = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 0, 1.0),
    ("isc", "permission", "permission to use copy modify and or distribute this software", 0, 1.0),
    ("bsd", "redistribut", "redistribution and use in source and binary forms", 0, 0.9),
    # Short headers of files.
    ("gpl", "free software", "this (?:program|file|software) is free software(?: you can redistribute it and or modify it under the terms of the gnu general public license)?", 1, 0.9),
    ("gpl-2-or-later", "general public", "gnu general public license as published by the free software foundation either version 2 of the license or(?: at your option)? any later version", 0, 1.0),
    ("gpl-3-or-later", "general public", "gnu general public license as published by the free software foundation either version 3 of the license or(?: at your option)? any later version", 0, 1.0),
    ("gpl-2", "general public", "gnu general public license version 2 as published by the free software foundation", 0, 1.0),
    ("lgpl", "free software", "this library is free software(?: you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license)?", 1, 0.9),
    ("lgpl-2.1-or-later", "lesser general", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or(?: at your option)? any later version", 0, 1.0),
    ("apache-2", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", 0, 1.0),
    ("apache-2", "www apache", "www apache org licenses license 2 0", 0, 1.0),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0", 0, 1.0),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1", 0, 1.0),
    ("epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license", 1, 0.95),
    ("cddl-1", "common development", "the contents of this file are subject to the terms of the common development and distribution license", 0, 0.95),
    ("bsd", "bsd", "use of this source code is governed by a bsd style license", 0, 1.0),
    ("mit", "mit", "use of this source code is governed by an mit style license", 0, 1.0),
    # Wordings of license texts.
    ("mit", "software is provided", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", 1, 0.8),
    ("bsl-1", "organization", "to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 0, 1.0),
    ("bsd-3-clause", "endorse", "neither the name of(?: [^ ]+){1,12} nor the names of its contributors may be used to endorse or promote products", 0, 0.95),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display", 0, 0.95),
    ("zlib", "authors be held", "in no event will the authors be held liable for any damages arising from the use of this software", 0, 0.9),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 0, 1.0),
    ("isc", "hereby granted", "provided that the above copyright notice and this permission notice appear in all copies", 1, 0.8),
    ("ofl-1.1", "font software", "this font software is licensed under the sil open font license", 0, 0.95),
    ("artistic-2", "copyright holder", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed", 0, 0.95),
    # Titles and bare names with a version.
    ("gpl-2", "gpl", "gnu gpl(?: version)? ?v? ?2(?: 0)?|gplv2", 5, 0.7),
    ("gpl-3", "gpl", "gnu gpl(?: version)? ?v? ?3(?: 0)?|gplv3", 5, 0.7),
    ("gpl-2-or-later", "gpl", "gpl(?: version)? ?v? ?2(?: 0)? (?:or(?: any)? later|plus)(?: versions?)?", 4, 0.8),
    ("gpl-3-or-later", "gpl", "gpl(?: version)? ?v? ?3(?: 0)? (?:or(?: any)? later|plus)(?: versions?)?", 4, 0.8),
    ("gpl-2", "general public", "gnu general public license version 2(?: june 1991)?", 5, 0.8),
    ("gpl-3", "general public", "gnu general public license version 3(?: 29 june 2007)?", 5, 0.8),
    ("lgpl-2.1", "lesser general", "gnu lesser general public license version 2 1(?: february 1999)?", 5, 0.8),
    ("agpl-3", "affero", "gnu affero general public license version 3(?: 19 november 2007)?", 5, 0.8),
    ("apache-2", "apache", "apache license version 2 0(?: january 2004)?", 5, 0.8),
    ("mpl-2", "mozilla", "mozilla public license version 2 0", 5, 0.8),
    ("epl-2", "eclipse", "eclipse public license v(?:ersion)? ?2 0", 5, 0.8),
    ("bsl-1", "boost", "boost software license version 1 0", 5, 0.8),
    ("artistic-2", "artistic", "the artistic license 2 0", 5, 0.8),
    ("wtfpl", "want to", "do what the fuck you want to public license version 2", 5, 0.9),
    ("cc0", "cc0", "cc0 1 0 universal", 3, 0.9),
    ("cc0", "copyright domain", "no copyright reserved|dedicated to the public domain", 2, 0.7),
    ("proprietary", "proprietary", "proprietary and confidential|confidential and proprietary", 3, 0.8),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa(?: [0-9] 0)?", 3, 0.85),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd(?: [0-9] 0)?", 3, 0.85),
    ("cc-by-nc", "cc by nc", "cc by nc(?: [0-9] 0)?", 4, 0.8),
    ("cc-by-sa", "cc by sa", "cc by sa(?: [0-9] 0)?", 4, 0.8),
    ("cc-by-nd", "cc by nd", "cc by nd(?: [0-9] 0)?", 4, 0.8),
    ("public-domain", "domain", "(?:in|into|to) the public domain", 5, 0.6),
    ("all-rights-reserved", "reserved", "all rights reserved", 8, 0.6),
    ("copyright", "copyright", "copyright (?:c )?(?:[0-9]{4}(?: [0-9]{4})?|by)", 9, 0.4),
]
# Wordings whose keyword is a phrase rather than a choice of words.
_PHRASES = (
    "cc by", "free software", "general public", "lesser general", "www apache", "common development",
    "software is provided", "authors be held", "hereby granted", "font software", "copyright holder", "want to",
)


class Rule(NamedTuple):
    label: str
    pattern: re.Pattern
    keywords: tuple[str, ...]
    priority: int
    confidence: float


class Scanner:
    """The rules, grouped by what must occur in a text before any of a group is tried."""

    def __init__(self) -> None:
        self.groups: list[tuple[tuple[str, ...], list[Rule]]] = []
        for label, (name, spdx, keywords) in LICENSES.items():
            group = [
                self.rule(label, pattern.format(name=name, spdx=spdx), needs.split(), priority, sure)
                for needs, pattern, priority, sure in STATEMENTS
            ]
            self.groups.append((tuple(keywords.split()), group))
        for label, needs, pattern, priority, sure in WORDINGS:
            keywords = [needs] if needs.startswith(_PHRASES) else needs.split()
            self.groups.append((tuple(keywords), [self.rule(label, pattern, keywords, priority, sure)]))
        # A text without any of these has no detection and no base phrase.
        needed = {k for _, group in self.groups for r in group for k in r.keywords}
        needed |= {phrase.split()[0] for phrase in BASE_PHRASES}
        self.gate = sorted(k for k in needed if not any(o in k and o != k for o in needed))

    @staticmethod
    def rule(label, pattern, keywords, priority, confidence) -> Rule:
        pattern = re.compile(f"(?<![^ ])(?:{pattern})(?![^ ])")
        return Rule(label, pattern, tuple(keywords), priority, confidence)

    def detections(self, joined: str) -> list[tuple[int, int, str, float]]:
        """Start, end, label and confidence of what is left after suppression."""
        found = []
        for keywords, group in self.groups:
            if not any(k in joined for k in keywords):
                continue
            for rule in group:
                if any(k in joined for k in rule.keywords):
                    for m in rule.pattern.finditer(joined):
                        found.append((rule.priority, m.start() - m.end(), m.start(), rule))
        found.sort(key=lambda d: d[:3] + (d[3].label,))
        # Containment against accepted ones: the furthest end among those that start no later.
        accepted: list[tuple[int, int, str, float]] = []
        starts: list[int] = []
        reach: list[int] = []
        for _, length, start, rule in found:
            end = start - length
            at = bisect.bisect_right(starts, start)
            if at and reach[at - 1] >= end:
                continue
            accepted.append((start, end, rule.label, rule.confidence))
            starts.insert(at, start)
            reach.insert(at, max(end, reach[at - 1] if at else 0))
            for k in range(at + 1, len(reach)):
                if reach[k] >= end:
                    break
                reach[k] = end
        return accepted


def base_places(joined: str) -> list[tuple[int, str]]:
    """Word number and label of every place where a base phrase stands."""
    padded, places = f" {joined} ", []
    for phrase, label in BASE_PHRASES.items():
        at = padded.find(f" {phrase} ")
        word, seen = 0, 0
        while at >= 0:
            word += padded.count(" ", seen, at)
            seen = at
            places.append((word, label))
            at = padded.find(f" {phrase} ", at + 1)
    return places


RESULT = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_scanner: list[Scanner] = []


def scan_batch(batch: pa.RecordBatch, column: str) -> list[tuple]:
    """For each row: words, base places, first and last word, base labels, labels, score."""
    if not _scanner:
        _scanner.append(Scanner())
    scanner = _scanner[0]
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    inside = ALPHANUMERIC[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    starts[borders] = inside[borders]
    counts = np.concatenate(([0], np.cumsum(starts, dtype=np.int64)))
    n_words = counts[offsets[1:]] - counts[offsets[:-1]]
    folded = LOWER[data].tobytes()
    candidates: set[int] = set()
    for keyword in scanner.gate:
        # A keyword of several words may be set apart by anything, so its first word gates.
        needle = keyword.split()[0].encode()
        at = folded.find(needle)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            candidates.add(row)
            at = folded.find(needle, int(offsets[row + 1]))
    rows = []
    for row, n in enumerate(n_words.tolist()):
        places, labels, score = [], set(), 0.0
        if row in candidates:
            words = _WORD.findall(folded[offsets[row] : offsets[row + 1]])
            joined = b" ".join(words).decode("utf-8", "replace")
            places = base_places(joined)
            found = scanner.detections(joined)
            labels = {d[2] for d in found}
            score = max([1.0 if places else 0.0, *(d[3] for d in found)])
        base = sorted({label for _, label in places})
        rows.append(
            (
                n,
                len(places),
                min((p for p, _ in places), default=None),
                max((p for p, _ in places), default=None),
                ",".join(base),
                ",".join(sorted(labels | set(base))),
                score,
            )
        )
    return rows


def license_scan(
    docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per document: the columns ``keep`` and what the scan found.

    A map over the rows: nothing is shuffled, and texts go through in pieces of a few MB.
    """
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_text"]
    names = [c for c in chosen.columns if c != "_text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 2 << 20):
            found = list(zip(*scan_batch(batch, "_text")))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            arrays += [pa.array(x, kind) for x, kind in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names + RESULT)

    types = ["bigint"] * 4 + ["string"] * 2 + ["double"]
    fields += [f"{name} {kind}" for name, kind in zip(RESULT, types)]
    return map_batches(chosen, scan, ", ".join(fields))

