"""Licence scans by conditional compression.

A block is a paragraph with a line that speaks of licensing, its wrapped lines joined. It is
compressed plainly and with each licence template as a raw zstandard dictionary, which gives
the bytes a template saves. Templates are confirmed by the words in which the block's closest
stretch differs from them; all that don't overlap a better one are named.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wordings of public licences and of the notices by which they are applied.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": ("Licensed under CC0 1.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
# Beginnings of words that make a line a candidate.
MARKS = ("licen", "copyright", "permission", "redistribut", "public domain", "warrant", "free software")
LEVEL = 3
# Of a template's words, the share that may be worded differently.
MOST_DIFFERENT = 0.15
MEMORY = 50_000
LONGEST_KEPT = 4_000
FOUND = (
    "doc_id long, block int, first_line int, n_lines int, license string, saved int, plain int, "
    "n_different int, template_words int, different array<string>"
)
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def blocks_of(text: str) -> list[tuple[int, list[str]]]:
    """First line number and lines of each paragraph with a candidate line; a line without a word ends one."""
    found: list[tuple[int, list[str]]] = []
    lines: list[str] = []
    marked = False
    for n, line in enumerate([*text.split("\n"), ""]):
        if _WORD.search(line):
            low = line.lower()
            marked = marked or any(m in low for m in MARKS)
            lines.append(line)
        else:
            if marked:
                found.append((n - len(lines), lines))
            lines, marked = [], False
    return found


def closest(template: list[str], words: list[str]) -> tuple[int, int, int]:
    """The fewest word edits that turn the template into a stretch of words, and that stretch.

    One row of the edit table at a time, over all end positions at once; ties go to
    the earliest end and, for that end, to the latest start.
    """
    numbers = {w: i for i, w in enumerate(dict.fromkeys([*template, *words]))}
    text = np.array([numbers[w] for w in words], np.int64)
    n = len(text)
    big = np.int64(1) << np.int64(32)
    place = np.arange(n + 1)
    # cost and start packed: a later start makes the smaller number
    row = n - place
    for w in template:
        swap = row[:-1] + big * (text != numbers[w])
        new = row + big
        new[1:] = np.minimum(new[1:], swap)
        row = np.minimum.accumulate(new - big * place) + big * place
    end = int((row // big).argmin())
    return int(row[end] // big), n - int(row[end] % big), end


class Scanner:
    """Ranks the templates for a block and confirms the winner; equal blocks are looked at once."""

    def __init__(self, templates: dict[str, tuple[str, ...]], level: int = LEVEL, most_different: float = MOST_DIFFERENT):
        self.plain = zstandard.ZstdCompressor(level=level)
        self.most_different = most_different
        self.templates = [
            (
                name,
                _WORD.findall(text.lower()),
                zstandard.ZstdCompressor(
                    level=level,
                    dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                ),
            )
            for name, texts in templates.items()
            for text in texts
        ]
        self.counts = [Counter(wording) for _, wording, _ in self.templates]
        self.memory: dict[str, list[tuple]] = {}

    def scan(self, block: str) -> list[tuple]:
        """(first line, lines, licence or None, bytes saved, plain bytes, words different, template words, differences) of each licence."""
        if len(block) > LONGEST_KEPT:
            return self._scan(block)
        found = self.memory.get(block)
        if found is None:
            if len(self.memory) > MEMORY:
                self.memory.clear()
            found = self.memory[block] = self._scan(block)
        return found

    def _best(self, words: list[str], saved: list[int]) -> tuple[int, int, int, int] | None:
        """The template that fits a stretch best, its edits and that stretch: most words less four an edit, then bytes saved."""
        have, best = Counter(words), None
        for i, (_, wording, _) in enumerate(self.templates):
            most = self.most_different * len(wording)
            # words the stretch lacks are edits
            if sum((self.counts[i] - have).values()) > most:
                continue
            edits, begin, end = closest(wording, words)
            key = (len(wording) - 4 * edits, saved[i], -i)
            if edits <= most and (best is None or key > best[0]):
                best = key, (i, edits, begin, end)
        return best and best[1]

    def _scan(self, block: str) -> list[tuple]:
        raw = block.encode()
        plain = len(self.plain.compress(raw))
        saved = [plain - len(coder.compress(raw)) for _, _, coder in self.templates]
        words, line = [], []
        for n, text in enumerate(block.split("\n")):
            own = _WORD.findall(text.lower())
            words += own
            line += [n] * len(own)
        found, free = [], [(0, len(words))]
        while free:
            a, b = free.pop()
            best = self._best(words[a:b], saved)
            if best is not None:
                i, edits, begin, end = best[0], best[1], a + best[2], a + best[3]
                found.append((begin, end, i, edits))
                free += [(a, begin), (end, b)]
        if not found:
            return [(0, block.count("\n") + 1, None, max(saved, default=0), plain, None, None, [])]
        return [
            (line[begin], line[end - 1] - line[begin] + 1, self.templates[i][0], saved[i], plain, edits,
             len(self.templates[i][1]), _differences(self.templates[i][1], words[begin:end]))
            for begin, end, i, edits in sorted(found)
        ]


def _differences(template: list[str], words: list[str]) -> list[str]:
    matcher = difflib.SequenceMatcher(None, template, words, autojunk=False)
    return [
        f"{' '.join(template[a:b]) or '-'} > {' '.join(words[c:d]) or '-'}"
        for kind, a, b, c, d in matcher.get_opcodes()
        if kind != "equal"
    ]


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A row for each licence in each candidate block; one with a null license where none is confirmed.

    Rows are numbered in the order of the text. first_line and n_lines are those of the licence's
    stretch, or of the whole block. Of templates that overlap, the one with most words, less four
    for each edit, is named; ties go to bytes saved, then to the order of the table. Null and empty texts, and texts without a candidate line, give no row. Only
    doc_id and text are read; repeated rows give repeated results.
    """
    templates = TEMPLATES if templates is None else templates

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kinds = pa.schema([
            ("doc_id", pa.int64()), ("block", pa.int32()), ("first_line", pa.int32()), ("n_lines", pa.int32()),
            ("license", pa.string()), ("saved", pa.int32()), ("plain", pa.int32()), ("n_different", pa.int32()),
            ("template_words", pa.int32()), ("different", pa.list_(pa.string())),
        ])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = [(first + x[0], *x[1:]) for first, lines in blocks_of(text) for x in scanner.scan("\n".join(lines))]
                rows += [(doc_id, k, *x) for k, x in enumerate(found)]
            columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    low = F.lower("text")
    candidate = F.lit(False)
    for mark in MARKS:
        candidate = candidate | low.contains(mark)
    return docs.select("doc_id", "text").filter(candidate).mapInArrow(look, FOUND)
