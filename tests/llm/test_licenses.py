import random
import re

from squadbook.llm.licenses import BASE_PHRASES, Scanner, license_scan
from tests.llm.conftest import frame, prose


def base(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    places = [
        (i, label)
        for phrase, label in BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [p for p, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_base_against_brute_force(spark, awkward):
    df, rows = awkward
    rng = random.Random(5)
    parts = [*BASE_PHRASES, "Under The MIT", "license.", "apache", "cc-by-nc", "CC BY", "NCé", prose(1, 5), "\n"]
    more = [(50 + i, " ".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    got = license_scan(df.unionByName(frame(spark, more))).collect()
    want = sorted((str(r[0]), *map(str, base(r[1]))) for r in rows + more)
    assert want == sorted(
        (str(r.doc_id), *map(str, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))) for r in got
    )
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_there_are_hundreds_of_rules():
    assert sum(len(group) for _, group in Scanner().groups) > 200


def test_labels_and_suppression():
    scanner = Scanner()

    def labels(text):
        return {d[2] for d in scanner.detections(text)}

    assert labels("spdx license identifier gpl 3 0") == {"gpl-3"}
    assert labels("released under the terms of the gnu lesser general public license version 3") == {"lgpl-3"}
    assert labels("licensed under creative commons attribution noncommercial share alike") == {"cc-by-nc-sa"}
    assert labels("this work is cc by nc sa 4 0") == {"cc-by-nc-sa"}
    assert labels("redistribution and use in source and binary forms") == {"bsd"}
    assert labels("we went mit der bahn under the bridge") == set()


PROBES = {
    # Names without a version.
    "released under the gnu gpl": {"gpl"},
    "under the bsd license": {"bsd"},
    "under the apache license": {"apache"},
    "licensed under the mozilla public license": {"mpl"},
    "distributed under the terms of the gnu affero general public license": {"agpl"},
    # With a version, or later.
    "gnu gpl version 2": {"gpl-2"},
    "gpl 2 or later": {"gpl-2-or-later"},
    "licensed under gpl version 3 or any later version": {"gpl-3-or-later"},
    "under the apache license version 2": {"apache-2"},
    # Headers of files.
    "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "lesser general public license as published by the free software foundation either version 2 1 of the "
    "license or at your option any later version": {"lgpl", "lgpl-2.1-or-later"},
    "this source code form is subject to the terms of the mozilla public license v 2 0": {"mpl-2"},
    "use of this source code is governed by a bsd style license": {"bsd"},
    # Wordings of texts.
    "neither the name of the university nor the names of its contributors may be used to endorse or "
    "promote products": {"bsd-3-clause"},
    "this is free and unencumbered software released into the public domain": {"unlicense"},
    # Titles.
    "gnu affero general public license version 3 19 november 2007": {"agpl-3"},
    "mozilla public license version 2 0": {"mpl-2"},
    # Nothing.
    "the apache helicopter and the free software movement": set(),
}


def test_probes_of_every_group_of_rules():
    scanner = Scanner()
    assert {text: {d[2] for d in scanner.detections(text)} for text in PROBES} == PROBES


def test_gate_lets_every_rule_through():
    """Whatever a rule matches holds one of the words that let a text be scanned."""
    scanner = Scanner()
    for _, group in scanner.groups:
        for rule in group:
            assert any(any(g in k or k in g for g in scanner.gate) for k in rule.keywords)


def test_empty_table(empty):
    assert license_scan(empty).collect() == []
