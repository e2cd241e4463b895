"""Licences in texts: known sentences get identifiers, ordered rules match sequences of them."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import map_batches

# Sentences of well-known public licences and notices with their identifiers (fixed values).
SENTENCES: dict[str, str] = {
    "mit.title": "MIT License",
    "mit.title2": "The MIT License (MIT)",
    "mit.short": "Released under the MIT License",
    "mit.short2": "Licensed under the MIT License",
    "mit.short3": "This project is licensed under the MIT License",
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit.warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "isc.title": "ISC License",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd.names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache.short": "Licensed under the Apache License, Version 2.0",
    "apache.notice": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache.notice2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache.copy": "You may obtain a copy of the License at",
    "apache.spdx": "SPDX-License-Identifier: Apache-2.0",
    "mit.spdx": "SPDX-License-Identifier: MIT",
    "gpl3.spdx": "SPDX-License-Identifier: GPL-3.0-or-later",
    "gpl3.short": "This work is licensed under the GNU General Public License, version 3",
    "gpl.free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl.useful": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl.copy": "You should have received a copy of the GNU General Public License along with this program",
    "ccbync4.short": "Licensed under CC BY-NC 4.0",
    "ccby4.short": "Licensed under CC BY 4.0",
    "ccby4.long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "ccbysa4.long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0.short": "This work is dedicated to the public domain under CC0 1.0",
    "unlicense.free": "This is free and unencumbered software released into the public domain",
    "mpl2.notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
# Licences with the sentence sequences that name them, in the order in which they are tried at a
# sentence; other known sentences must not stand between (fixed values).
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit.title", "mit.grant", "mit.notice", "mit.warranty")),
    ("MIT", ("mit.title2", "mit.grant", "mit.notice", "mit.warranty")),
    ("MIT", ("mit.grant", "mit.notice", "mit.warranty")),
    ("ISC", ("isc.title", "isc.grant")),
    ("ISC", ("isc.grant",)),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names")),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary")),
    ("GPL-3.0-or-later", ("gpl.free", "gpl.useful", "gpl.copy")),
    ("GPL-3.0-or-later", ("gpl.free",)),
    ("Apache-2.0", ("apache.notice2", "apache.copy")),
    ("Apache-2.0", ("apache.notice2",)),
    ("Apache-2.0", ("apache.notice",)),
    ("Apache-2.0", ("apache.short",)),
    ("Apache-2.0", ("apache.spdx",)),
    ("MIT", ("mit.short",)),
    ("MIT", ("mit.short2",)),
    ("MIT", ("mit.short3",)),
    ("MIT", ("mit.spdx",)),
    ("GPL-3.0", ("gpl3.short",)),
    ("GPL-3.0-or-later", ("gpl3.spdx",)),
    ("CC-BY-NC-4.0", ("ccbync4.short",)),
    ("CC-BY-4.0", ("ccby4.short",)),
    ("CC-BY-4.0", ("ccby4.long",)),
    ("CC-BY-SA-4.0", ("ccbysa4.long",)),
    ("CC0-1.0", ("cc0.short",)),
    ("Unlicense", ("unlicense.free",)),
    ("MPL-2.0", ("mpl2.notice",)),
]
# A sentence ends at a line end, or at full stops and the like before a space.
SENTENCE_END = r"\n|[.!?:;]+[ \t\r\f\x0B]"
# What parts the words of a normalised sentence.
BETWEEN = r"[^a-z0-9]+"
# A known text may run over a single line end, and over the other cuts that it has itself.
STOPS = (".", "!", "?", ":", ";")
_END, _BETWEEN = re.compile(f"({SENTENCE_END})"), re.compile(BETWEEN)


def normalise(sentence: str) -> str:
    """Lower-case ASCII words and numbers, one space between."""
    return _BETWEEN.sub(" ", sentence.lower()).strip(" ")


def known_sentences(sentences: dict[str, str] = SENTENCES) -> dict[str, str]:
    """Identifier of each normalised sentence."""
    return {normalise(text): name for name, text in sentences.items()}


def cut(text: str) -> list[tuple[str, bool, bool]]:
    """The normalised sentences of a text that have a word, each with whether a stop follows it, and
    whether an empty line does, or one without a word."""
    out: list[tuple[str, bool, bool]] = []
    parts = _END.split(text.lower())
    lines = 0
    for raw, end in zip(parts[::2], [*parts[1::2], ""]):
        sentence = _BETWEEN.sub(" ", raw).strip(" ")
        stop = end not in ("", "\n") or raw.endswith(STOPS)
        if sentence:
            lines = int(end == "\n")
            out.append((sentence, stop, False))
        elif out:
            lines += end == "\n"
            out[-1] = (out[-1][0], out[-1][1] or stop, lines > 1)
    return out


def beginnings(sentences: dict[str, str] = SENTENCES) -> tuple[dict[str, str], dict[str, set], dict[str, set]]:
    """Names of the known texts by their normalised form; by each of their beginnings of whole words;
    and by the beginnings that a stop follows in them."""
    heads: dict[str, set] = {}
    stops: dict[str, set] = {}
    for text, name in known_sentences(sentences).items():
        words = text.split(" ")
        for i in range(1, len(words) + 1):
            heads.setdefault(" ".join(words[:i]), set()).add(name)
        pieces = cut(sentences[name])
        for i, (_, stop, _) in enumerate(pieces[:-1], 1):
            if stop:
                stops.setdefault(" ".join(p for p, _, _ in pieces[:i]), set()).add(name)
    return known_sentences(sentences), heads, stops


def sentences_of(text: str, known: tuple[dict, dict, dict]) -> tuple[int, list[tuple[int, str]]]:
    """How many sentences with a word a text has, and the known texts (see ``beginnings``) that are a
    sentence or a run of them: name and number of the first. At each place the longest is taken. A run
    goes on over a single line end, and over a stop where the known text has one too."""
    whole, heads, stops = known
    sentences = cut(text)
    found, at = [], 0
    while at < len(sentences):
        run, stop, empty = sentences[at]
        fits, end, best = heads.get(run), at + 1, None
        while fits:
            if whole.get(run) in fits:
                best = (end, whole[run])
            if empty or end == len(sentences):
                break
            if stop:
                fits = fits & stops.get(run, set())
            more, stop, empty = sentences[end]
            run, end = f"{run} {more}", end + 1
            fits = fits & heads.get(run, set())
        if best:
            found.append((at, best[1]))
        at = best[0] if best else at + 1
    return len(sentences), found


def match_rules(names: list[str], rules: list[tuple[str, tuple[str, ...]]]) -> list[tuple[int, int, str]]:
    """Matches ``(first, length, licence)`` in a sequence of identifiers, from its start: at each place
    the first rule that fits takes its sentences; a sentence that fits no rule is passed over."""
    out, at = [], 0
    while at < len(names):
        for licence, rule in rules:
            if tuple(names[at : at + len(rule)]) == rule:
                out.append((at, len(rule), licence))
                at += len(rule)
                break
        else:
            at += 1
    return out


def scan_licences(
    docs: DataFrame,
    sentences: dict[str, str] = SENTENCES,
    rules: list[tuple[str, tuple[str, ...]]] = RULES,
) -> DataFrame:
    """``(doc_id, n_sentences, sentence_ids, matches)`` for every row of ``docs``: its sentences with a
    word, the identifiers of the known texts in order, wrapped or not, and the rule matches as ``(sentence, length,
    licence)`` with the number of the sentence they start at. Null and empty texts have no sentence."""

    known = beginnings(sentences)

    def compute(batch: pa.RecordBatch) -> list:
        counts, ids, matches = [], [], []
        for text in batch.column("text").to_pylist():
            count, found = sentences_of(text or "", known)
            names = [name for _, name in found]
            counts.append(count)
            ids.append(names)
            matches.append(
                [
                    {"sentence": found[at][0], "length": length, "licence": licence}
                    for at, length, licence in match_rules(names, rules)
                ]
            )
        return [counts, ids, matches]

    new = (
        "n_sentences bigint, sentence_ids array<string>, "
        "matches array<struct<sentence:bigint,length:int,licence:string>>"
    )
    return map_batches(docs.select("doc_id", "text"), ["doc_id"], new, compute)


def licence_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_sentences, n_known, n_matches, licences)``: counts, and the different licences in
    the order of their names, joined by commas."""
    found = scan_licences(docs)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    return found.select(
        "doc_id",
        "n_sentences",
        F.size("sentence_ids").cast("bigint").alias("n_known"),
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(names, ",").alias("licences"),
    )
