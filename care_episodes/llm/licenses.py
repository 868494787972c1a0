"""License scans by ordered signature rules.

A text becomes its words (A-Z in lower case; runs of letters a-z, digits and anything beyond ASCII).  Base phrases are
counted wherever their words stand consecutively.  Signature rules are regular expressions over the words joined by one
space: grants, SPDX lines, bare names and characteristic sentences of each licence family.  Keywords gate them: a text
without any root keyword is never joined, and a rule runs only where its own keyword occurs.  Detections are taken by
priority, then length, then place; one that lies inside a taken interval is suppressed, base phrases never are.

Defined results: null and empty texts have 0 words, 0 places, null first and last word, empty label lists and score 0.
Labels are distinct, sorted by code point and joined by commas.  The score is the highest weight among the taken
detections.  Each row is scanned by itself, so repeated rows give equal rows, and other columns pass through untouched.

Scale: one pass, no shuffle; memory is bounded by a slice of texts, or one text if that is longer.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_episodes.llm.buffers import rows_of, slices, sums, utf8
from care_episodes.llm.columns import packed, unpacked

#: Fixed phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Licence families: label, SPDX words, pattern of the name over normalised words, a keyword every match holds.
FAMILIES = (
    ("mit", "mit", "(?:the )?(?:mit|expat|x11) licen[sc]e", "licen"),
    ("apache-2", "apache 2 0", "apache (?:software )?(?:licen[sc]e )?(?:version |v ?)?(?:2 0|2)(?! [1-9])", "apache"),
    ("apache-1.1", "apache 1 1", "apache (?:software )?licen[sc]e (?:version |v ?)?1 1", "apache"),
    ("gpl-2", "gpl 2 0", "gnu (?:general public licen[sc]e|gpl) (?:version |v ?)?2|gplv2|gpl (?:version |v ?)?2", "g"),
    ("gpl-3", "gpl 3 0", "gnu (?:general public licen[sc]e|gpl) (?:version |v ?)?3|gplv3|gpl (?:version |v ?)?3", "g"),
    ("gpl", "gpl", "gnu (?:general public licen[sc]e|gpl)", "gnu"),
    ("lgpl-2.1", "lgpl 2 1", "gnu lesser general public licen[sc]e (?:version |v ?)?2 1|lgplv?2 1|lgpl (?:version |v ?)?2 1", "l"),
    ("lgpl-3", "lgpl 3 0", "gnu lesser general public licen[sc]e (?:version |v ?)?3|lgplv3|lgpl (?:version |v ?)?3", "l"),
    ("lgpl", "lgpl", "gnu (?:lesser|library) general public licen[sc]e|lgpl", "l"),
    ("agpl-3", "agpl 3 0", "(?:gnu )?affero general public licen[sc]e|agplv?3|agpl (?:version |v ?)?3", "a"),
    ("bsd-2", "bsd 2 clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd"),
    ("bsd-3", "bsd 3 clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[sc]e)?", "bsd"),
    ("bsd-4", "bsd 4 clause", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", "bsd"),
    ("bsd", "bsd", "bsd(?: style)? licen[sc]e", "bsd"),
    ("0bsd", "0bsd", "0bsd|zero clause bsd", "bsd"),
    ("isc", "isc", "isc licen[sc]e", "isc"),
    ("mpl-1.1", "mpl 1 1", "mozilla public licen[sc]e (?:version |v ?)?1 1", "mozilla"),
    ("mpl-2", "mpl 2 0", "mozilla public licen[sc]e(?: version| v)? 2 0|mpl 2 0", "m"),
    ("epl-1", "epl 1 0", "eclipse public licen[sc]e (?:version |v ?)?1 0", "eclipse"),
    ("epl-2", "epl 2 0", "eclipse public licen[sc]e (?:version |v ?)?2 0", "eclipse"),
    ("cddl-1", "cddl 1 0", "common development and distribution licen[sc]e|cddl", "c"),
    ("cpl-1", "cpl 1 0", "common public licen[sc]e", "common public"),
    ("artistic-1", "artistic 1 0", "artistic licen[sc]e (?:version |v ?)?1 0", "artistic"),
    ("artistic-2", "artistic 2 0", "artistic licen[sc]e (?:version |v ?)?2 0", "artistic"),
    ("perl", "perl", "same terms as perl(?: itself)?", "perl"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", "zlib"),
    ("boost-1", "bsl 1 0", "boost software licen[sc]e", "boost"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl|do what the fuck you want to public licen[sc]e", "w"),
    ("eupl", "eupl 1 2", "european union public licen[sc]e|eupl", "eu"),
    ("osl-3", "osl 3 0", "open software licen[sc]e", "open software"),
    ("ofl-1.1", "ofl 1 1", "sil open font licen[sc]e|open font licen[sc]e", "open font"),
    ("odbl", "odbl 1 0", "open (?:data commons open )?database licen[sc]e|odbl", "od|database"),
    ("pddl", "pddl 1 0", "public domain dedication and licen[sc]e|pddl", "p"),
    ("psf", "psf 2 0", "(?:python software foundation|psf) licen[sc]e", "licen"),
    ("ruby", "ruby", "ruby licen[sc]e|ruby s licen[sc]e", "ruby"),
    ("php-3", "php 3 01", "php licen[sc]e", "php"),
    ("openssl", "openssl", "openssl licen[sc]e", "openssl"),
    ("ms-pl", "ms pl", "microsoft public licen[sc]e|ms pl", "m"),
    ("ms-rl", "ms rl", "microsoft reciprocal licen[sc]e|ms rl", "m"),
    ("gfdl-1.3", "gfdl 1 3", "gnu free documentation licen[sc]e|gfdl", "g"),
    ("afl-3", "afl 3 0", "academic free licen[sc]e", "academic"),
    ("ncsa", "ncsa", "(?:university of illinois ncsa|ncsa) (?:open source )?licen[sc]e", "ncsa"),
    ("postgresql", "postgresql", "postgresql licen[sc]e", "postgresql"),
    ("bsl-1.1", "busl 1 1", "business source licen[sc]e", "business source"),
    ("sspl-1", "sspl 1 0", "server side public licen[sc]e|sspl", "s"),
    ("elastic-2", "elastic 2 0", "elastic licen[sc]e", "elastic"),
    ("openrail", "openrail", "(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[sc]e)?", "rail"),
    ("cc0", "cc0 1 0", "cc0|creative commons zero", "c"),
    ("cc-by", "cc by 4 0", "cc by(?! (?:nc|sa|nd))|creative commons attribution(?! (?:non|share|no))", "c"),
    ("cc-by-sa", "cc by sa 4 0", "cc by sa|creative commons attribution share ?alike", "c"),
    ("cc-by-nd", "cc by nd 4 0", "cc by nd|creative commons attribution no ?deriv\\w*", "c"),
    ("cc-by-nc", "cc by nc 4 0", "cc by nc(?! (?:sa|nd))|creative commons attribution non ?commercial(?! (?:share|no))", "c"),
    ("cc-by-nc-sa", "cc by nc sa 4 0", "cc by nc sa|creative commons attribution non ?commercial share ?alike", "c"),
    ("cc-by-nc-nd", "cc by nc nd 4 0", "cc by nc nd|creative commons attribution non ?commercial no ?deriv\\w*", "c"),
)

#: Ways to name a licence: priority, weight, pattern around the name.
FORMS = (
    (90, 0.95, "(?:licen[sc]ed|released|distributed|available|published|provided|covered) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:{name})"),
    (80, 0.85, "(?:subject to|governed by|according to|in accordance with|use of) (?:the )?(?:terms of )?(?:the )?(?:{name})"),
    (70, 0.8, "(?:see|read|copy of) (?:the )?(?:{name})"),
    (50, 0.6, "(?:{name})"),
)

#: Characteristic sentences: label, priority, weight, pattern, keyword.
SENTENCES = (
    ("mit", 95, 0.98, "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", 95, 0.98, "permission to use copy modify and or distribute this software for any purpose with or without fee", "with or without fee"),
    ("bsd", 94, 0.95, "redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("bsd-3", 95, 0.97, "neither the name of [^.]{0,200}? may be used to endorse or promote products", "endorse"),
    ("bsd-4", 95, 0.97, "all advertising materials mentioning features or use of this software", "advertising"),
    ("zlib", 95, 0.97, "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "held liable"),
    ("boost-1", 95, 0.97, "permission is hereby granted free of charge to any person or organization obtaining a copy", "organization obtaining"),
    ("unlicense", 95, 0.97, "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("gpl", 93, 0.95, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public", "redistribute"),
    ("lgpl", 94, 0.95, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser", "redistribute"),
    ("apache-2", 94, 0.95, "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org", "compliance"),
    ("mpl-2", 94, 0.95, "this source code form is subject to the terms of the mozilla public license", "source code form"),
    ("public-domain", 60, 0.7, "(?:released into|dedicated to|placed in|is in) the public domain", "public domain"),
    ("all-rights-reserved", 40, 0.5, "all rights reserved", "rights reserved"),
    ("proprietary", 60, 0.7, "(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("unknown-license", 10, 0.3, "licen[sc]ed under", "licen"),
)

#: A text without any of these holds no match of any rule; more than a quick look is taken at the others only.
ROOTS = (
    b"licen", b"cc", b"gpl", b"gnu", b"bsd", b"apache", b"mozilla", b"mpl", b"spdx", b"creative", b"public domain",
    b"rights", b"permission", b"redistribut", b"warranty", b"proprietary", b"rail", b"gfdl", b"wtfpl", b"eupl", b"odbl",
    b"pddl", b"cddl", b"sspl", b"same terms", b"ms", b"advertising", b"endorse", b"unencumbered",
)
_ROOT_WORDS = re.compile(
    rb"licen|copyright|unencumbered|creative|spdx|(?<![a-z])(?:cc|cc0|gnu|a?gplv?|lgplv?|gfdl|bsd|0bsd|freebsd|apache|mpl|mozilla|wtfpl|"
    rb"eupl|odbl|pddl|cddl|sspl|ms|domain|openrail|open ?rail|perl|rights|proprietary|hereby|fee|redistribution|redistribute|endorse|advertising|liable|zero)(?![a-z])|gplv"
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


Rule = tuple[int, float, str, str, re.Pattern]


def rules() -> list[Rule]:
    """(priority, weight, label, keyword, pattern), highest priority first: four forms and an SPDX line for each family."""
    found = []
    for label, spdx, name, keyword in FAMILIES:
        found.append((100, 1.0, label, "spdx", rf"(?<!\S)spdx license identifier {spdx}(?: only| or later)?(?!\S)"))
        found += [(p, w, label, keyword, rf"(?<!\S){form.format(name=name)}(?!\S)") for p, w, form in FORMS]
    found += [(p, w, label, keyword, rf"(?<!\S)(?:{pattern})(?!\S)") for label, p, w, pattern, keyword in SENTENCES]
    return sorted(((p, w, a, k, re.compile(x)) for p, w, a, k, x in found), key=lambda r: (-r[0], r[2], r[4].pattern))


def scan(words: str, ordered: list[Rule]) -> tuple[list[tuple[int, int, str, float]], list[tuple[int, int, str]]]:
    """(taken detections, base places) of normalised words: character intervals with their label."""
    padded = f" {words} "
    base = []
    for phrase, label in BASE.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            base.append((at, at + len(phrase), label))
            at = padded.find(f" {phrase} ", at + 1)
    raw = []
    present: dict[str, bool] = {}
    for priority, weight, label, keyword, pattern in ordered:
        if keyword not in present:
            present[keyword] = any(k in words for k in keyword.split("|"))
        if present[keyword]:
            raw += [(-priority, m.start() - m.end(), m.start(), m.end(), label, weight) for m in pattern.finditer(words)]
    taken: list[tuple[int, int, str, float]] = [(a, b, label, 1.0) for a, b, label in base]
    starts: list[tuple[int, int]] = sorted((a, b) for a, b, _ in base)
    raw.sort()
    for *_, a, b, label, weight in raw:
        if not _inside(starts, a, b):
            taken.append((a, b, label, weight))
            _insert(starts, a, b)
    return taken, base


def _inside(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    """Taken intervals are kept without one inside another, so both ends rise and one look is enough."""
    k = bisect_right(taken, (a, float("inf"))) - 1
    return k >= 0 and taken[k][1] >= b


def _insert(taken: list[tuple[int, int]], a: int, b: int) -> None:
    k = bisect_left(taken, (a, b))
    while k < len(taken) and taken[k][1] <= b:
        del taken[k]
    taken.insert(k, (a, b))


def _scanner(ordered: list[Rule]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = batch.num_rows
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            low = _LOWER[data]
            word = _WORD[low]
            begins = word.copy()
            begins[1:] &= ~word[:-1] | (rows_of(offsets)[1:] != rows_of(offsets)[:-1])
            n_words = sums(begins, offsets)
            n_base, score = np.zeros(n, np.int64), np.zeros(n)
            first: list[int | None] = [None] * n
            last: list[int | None] = [None] * n
            base_labels, labels = [""] * n, [""] * n
            raw = low.tobytes()
            for i in range(n):
                text = raw[offsets[i] : offsets[i + 1]]
                if not any(root in text for root in ROOTS) or not _ROOT_WORDS.search(text):
                    continue
                gaps = np.where(word[offsets[i] : offsets[i + 1]], low[offsets[i] : offsets[i + 1]], 32).astype(np.uint8)
                words = " ".join(w for w in gaps.tobytes().decode("utf-8", "replace").split(" ") if w)
                taken, base = scan(words, ordered)
                if base:
                    n_base[i] = len(base)
                    first[i] = words.count(" ", 0, min(base)[0])
                    last[i] = words.count(" ", 0, max(base)[0])
                    base_labels[i] = ",".join(sorted({b[2] for b in base}))
                if taken:
                    labels[i] = ",".join(sorted({t[2] for t in taken}))
                    score[i] = max(t[3] for t in taken)
            added = {
                "n_words": pa.array(n_words), "n_base": pa.array(n_base), "first_word": pa.array(first, pa.int64()),
                "last_word": pa.array(last, pa.int64()), "base_labels": pa.array(base_labels), "labels": pa.array(labels), "score": pa.array(score),
            }
            kept = {f.name: batch.column(k) for k, f in enumerate(batch.schema) if f.name != "text"}
            yield pa.RecordBatch.from_pydict(kept | added)

    return run


ADDED = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """The documents with the columns of `ADDED`."""
    rows = packed(docs, text=F.col("text"))
    found = rows.mapInArrow(_scanner(rules()), f"row {rows.schema['row'].dataType.simpleString()}, {ADDED}")
    return unpacked(found, *[c.split()[0] for c in ADDED.split(", ")])


def license_digest(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scanner(rules()), f"doc_id {kind}, {ADDED}")


#: The base columns only, for tests.
BASE_ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
p(phrase, label) AS (VALUES (['under', 'the', 'mit', 'license'], 'mit'), (['apache', 'license', 'version', '2'], 'apache-2'), (['cc', 'by', 'nc'], 'cc-by-nc')),
hits AS (SELECT doc_id, label, unnest(list_filter(range(len(words)), lambda i: words[i + 1 : i + len(phrase)] = phrase)) AS place FROM w, p)
SELECT w.doc_id, len(words)::BIGINT AS n_words, count(place)::BIGINT AS n_base, min(place)::BIGINT AS first_word, max(place)::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM w LEFT JOIN hits USING (doc_id) GROUP BY w.doc_id, words
"""
