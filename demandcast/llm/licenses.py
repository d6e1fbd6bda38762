"""License scans by conditional compression.

A notice counts as found where enough of its words stand in order with few words between. So many
of its words are telling that a found notice has one at least; a candidate block is what surrounds
telling words in a text, as far as a notice around them can reach, across line breaks. In a block
the longest common subsequence of words chooses each notice's span. The text of a span is then
compressed by zstandard alone and with each license notice as raw dictionary; the notices are
ranked by how much smaller it gets, and the words that are missing, or come between, are listed.
Equal blocks are scanned once, however many texts hold them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import own_store, whole_text, with_row_id
from demandcast.sources.storage import Storage

# Short notices of well-known licenses, as their authors word them.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
    "this work",
    "LGPL-text": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
    "General Public License as published by the Free Software Foundation",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
    "General Public License as published by the Free Software Foundation",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
    "2.0",
}
#: Words of notices that most texts have; they tell of a notice only where it has too few others.
COMMON = frozenset("a all and any are as at be by for free from in is it not of or that the this to under use with without you".split())
WORD = re.compile(r"\w+(?:[.-]\w+)*")
#: Notices compared word by word for each block, the share of a notice's words that must be there, words between them.
RANKED, COVERED, EXTRA = 4, 0.8, 0.25
LEVEL = 9


def notice_words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def _compressor(text: str = ""):
    import zstandard

    held = {"dict_data": zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)}
    return zstandard.ZstdCompressor(
        level=LEVEL, write_content_size=False, write_checksum=False, **({"write_dict_id": False} | held if text else {})
    )


class Book:
    """A list of notices, made ready for scans."""

    def __init__(self, notices: Mapping[str, str]):
        self.texts = {name: text for name, text in notices.items() if notice_words(text)}
        self.words = {name: notice_words(text) for name, text in self.texts.items()}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        #: For each notice, by word: a bit for each place where the notice has it.
        self.places: dict[str, dict[str, int]] = {}
        for name, words in self.words.items():
            own = self.places[name] = {}
            for n, word in enumerate(words):
                own[word] = own.get(word, 0) | 1 << n
        self.telling: set[str] = set()
        for name, words in self.words.items():
            spare = len(words) - self.least(name)  # so many words may be missing
            order = sorted(self.counts[name], key=lambda w: (w in COMMON, w not in self.telling, -len(w), w))
            held = 0
            for word in order:
                if held > spare:
                    break
                self.telling.add(word)
                held += self.counts[name][word]
        #: Most words that a found notice spans.
        self.reach = max((len(w) + int(EXTRA * len(w)) for w in self.words.values()), default=0)

    def least(self, name: str) -> int:
        """Fewest words of a notice that are enough."""
        n = len(self.words[name])
        return next(k for k in range(n + 1) if k / n >= COVERED)

    def pattern(self) -> str:
        """Finds telling words in lower-case text; alternatives by first letter."""
        by_first: dict[str, list[str]] = {}
        for word in sorted(self.telling):
            by_first.setdefault(word[0], []).append(word[1:])
        return "|".join(f"{re.escape(c)}(?:{'|'.join(map(re.escape, rest))})" for c, rest in by_first.items()) or "(?!)"

    def find(self, name: str, have: list[str]) -> tuple[int, int, int] | None:
        """(words missing or between, first, end) of the span that holds the notice best; the first of equal ones."""
        want, places, least = self.counts[name], self.places[name], self.least(name)
        n, best = len(self.words[name]), None
        if sum((Counter(w for w in have if w in places) & want).values()) < least:
            return None
        for first, word in enumerate(have):
            if word not in places:
                continue
            left = full = (1 << n) - 1  # bit-parallel longest common subsequence: a zero for each word in it
            for end in range(first + 1, len(have) + 1):
                match = left & places.get(have[end - 1], 0)
                left = ((left + match) | (left - match)) & full
                kept = n - left.bit_count()
                between = end - first - kept
                if between > EXTRA * n:
                    break
                if kept >= least and (best is None or n - kept + between < best[0]):
                    best = (n - kept + between, first, end)
        return best


@cache
def _book(items: tuple[tuple[str, str], ...]) -> Book:
    return Book(dict(items))


@cache
def _compressors(items: tuple[tuple[str, str], ...]) -> dict:
    return {"": _compressor()} | {name: _compressor(text) for name, text in _book(items).texts.items()}


def _items(notices: Mapping[str, str] | None) -> tuple[tuple[str, str], ...]:
    return tuple((NOTICES if notices is None else notices).items())


def rank_notices(block: str, notices: Mapping[str, str] | None = None) -> list[tuple[str, float]]:
    """Notices by the share of the block's compressed size that they save, largest first, ties by name."""
    body = block.lower().encode()
    held = _compressors(_items(notices))
    alone = len(held[""].compress(body))
    return sorted(
        ((name, 1 - len(c.compress(body)) / alone) for name, c in held.items() if name), key=lambda x: (-round(x[1], 9), x[0])
    )


def compare_wording(block: str, notice: str) -> tuple[float, list[str], list[str]]:
    """Share of the notice's words that the block has in order, those missing, and the words between."""
    have, want = notice_words(block), notice_words(notice)
    rest = [[0] * (len(want) + 1) for _ in range(len(have) + 1)]
    for i in range(len(have) - 1, -1, -1):
        for j in range(len(want) - 1, -1, -1):
            rest[i][j] = rest[i + 1][j + 1] + 1 if have[i] == want[j] else max(rest[i + 1][j], rest[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(have) and j < len(want) and rest[i][j]:
        if have[i] == want[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif rest[i + 1][j] >= rest[i][j + 1]:
            i += 1
        else:
            j += 1
    if not pairs:
        return 0.0, want, []
    used, covered = {i for i, _ in pairs}, {j for _, j in pairs}
    span = range(pairs[0][0], pairs[-1][0] + 1)
    return len(pairs) / len(want), [w for n, w in enumerate(want) if n not in covered], [have[n] for n in span if n not in used]


def scan_block(block: str, notices: Mapping[str, str] | None = None) -> list[dict]:
    """The notices that the block holds, in order; ``begin`` and ``end`` are their code points in it.

    Of notices whose spans overlap, the one covered best is taken, then the longest, then the first;
    what is before and behind its span is scanned again.
    """
    book = _book(_items(notices))
    spans = [(m.start(), m.end()) for m in WORD.finditer(block)]
    have = [block[a:b].lower() for a, b in spans]
    hits, open_ = [], [(0, len(have), tuple(book.words))]
    while open_:
        low, high, names = open_.pop()
        found = [(name, span) for name in names if (span := book.find(name, have[low:high]))]
        kept = None
        for name, (_, first, end) in sorted(found, key=lambda f: (f[1][0], -len(book.texts[f[0]]), f[1][1], f[0])):
            begin, stop = spans[low + first][0], spans[low + end - 1][1]
            ranked = rank_notices(block[begin:stop], notices)
            rank = next(n for n, (other, _) in enumerate(ranked) if other == name)
            if ranked[rank][1] > 0:
                share, missing, between = compare_wording(block[begin:stop], book.texts[name])
                hits.append({"begin": begin, "end": stop, "license": name, "rank": rank + 1, "saved": ranked[rank][1],
                             "covered": share, "missing": missing, "between": between})
                kept = (low + first, low + end)
                break
        if kept:
            # a notice that is nowhere in the whole is in no part of it
            rest = tuple(name for name, _ in found)
            open_ += [(low, kept[0], rest), (kept[1], high, rest)]
    return sorted(hits, key=lambda h: h["begin"])


def candidate_blocks(text: str, notices: Mapping[str, str] | None = None) -> list[tuple[int, str]]:
    """(offset, block) of a whole text: telling words and as many words around them as a notice can span."""
    book = _book(_items(notices))
    words = [(m.start(), m.end(), m.group().lower()) for m in WORD.finditer(text)]
    spans: list[list[int]] = []
    for n, (_, _, word) in enumerate(words):
        if word in book.telling:
            low, high = max(0, n - book.reach + 1), min(len(words), n + book.reach)
            if spans and low <= spans[-1][1]:
                spans[-1][1] = high
            else:
                spans.append([low, high])
    return [(words[low][0], text[words[low][0] : words[high - 1][1]]) for low, high in spans]


def scan_licenses(docs: DataFrame, store: Storage, notices: Mapping[str, str] | None = None) -> DataFrame:
    """License notices of every row: row, doc_id, at, license, rank, saved, covered, missing, between, block.

    ``notices`` are names and texts to look for, those of ``NOTICES`` if it is None. ``at`` is the
    code point where the notice's words begin in the whole text, ``block`` the text from there to
    its last word. Null and empty texts have none, repeated rows have theirs each. An empty table
    gives no rows.
    """
    store = own_store(store)
    rows = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), "row")
    telling = F.lower("text").rlike(_book(_items(notices)).pattern())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (row, doc_id, at, block)
                for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns))
                for at, block in candidate_blocks(text, notices)
            ]
            columns = list(zip(*out)) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names=["row", "doc_id", "at", "block"]
            )

    blocks = rows.where(telling).select("row", "doc_id", "text").mapInArrow(cut, "row long, doc_id long, at long, block string")
    blocks = store.table("blocks", blocks)
    found_type = "block string, begin long, end long, license string, rank int, saved double, covered double, missing array<string>, between array<string>"
    schema = pa.schema(
        [("block", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("license", pa.string()),
         ("rank", pa.int32()), ("saved", pa.float64()), ("covered", pa.float64()),
         ("missing", pa.list_(pa.string())), ("between", pa.list_(pa.string()))]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{"block": b, **hit} for b in batch.column(0).to_pylist() for hit in scan_block(b, notices)]
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    known = store.table("found", blocks.select("block").distinct().mapInArrow(scan, found_type))
    return blocks.join(known, "block").select(
        "row",
        "doc_id",
        (F.col("at") + F.col("begin")).alias("at"),
        "license",
        "rank",
        "saved",
        "covered",
        "missing",
        "between",
        F.col("block").substr(F.col("begin").cast("int") + 1, (F.col("end") - F.col("begin")).cast("int")).alias("block"),
    )
