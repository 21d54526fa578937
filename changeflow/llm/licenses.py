"""License scans: selected fingerprints of templates in an inverted index pick candidates, banded alignment reports them.

Templates are few and of bounded size (checked), so their index is broadcast. A template's fingerprints are single words, one more than
a match may miss, so that every match has one of them; those in few templates and long ones are taken. Each word of a
document is looked up. Hits with enough of the template's words around them are candidates, and a banded alignment of the template
on both sides of the hit gives the share of template words matched and the span in the document. Rows never leave their task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from changeflow.llm import common as C

# Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                         "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                          "following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                      "files (the \"Software\"), to deal in the Software without restriction",
    "all-rights-reserved": "All rights reserved.",
}

#: Words that a template has at least, and how far an alignment may drift on either side of a fingerprint, in words.
LEAST_WORDS, BAND = 3, 6
MAX_TEMPLATE_BYTES = 8 << 20

_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class PlainWords:
    """Lower-cased words without punctuation around them: byte spans, hashes, and the range of words of each text."""

    def __init__(self, texts: C.Texts):
        words = C.Words(texts)
        starts, ends = words.starts.copy(), words.ends.copy()
        plain = _PLAIN[texts.data]
        moving = np.arange(len(starts))
        while len(moving):
            moving = moving[(starts[moving] < ends[moving])]
            moving = moving[~plain[starts[moving]]]
            starts[moving] += 1
        moving = np.arange(len(starts))
        while len(moving):
            moving = moving[(starts[moving] < ends[moving])]
            moving = moving[~plain[ends[moving] - 1]]
            ends[moving] -= 1
        some = starts < ends
        self.starts, self.ends = starts[some], ends[some]
        self.bounds = np.concatenate([[0], np.cumsum(some)])[words.bounds]
        self.hashes = C.span_hashes(C.byte_values(C.lowered(texts.data)), self.starts, self.ends)


class Index:
    """Words of the templates, the words a match needs, and the fingerprints with the templates and places they stand for."""

    def __init__(self, templates: dict[str, str], coverage: float = 0.8):
        if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
            raise ValueError(f"templates are larger than {MAX_TEMPLATE_BYTES} bytes together; scan in several calls")
        self.names = sorted(templates)
        blobs = [templates[n].encode() for n in self.names]
        words = PlainWords(C.Texts(np.arange(len(blobs)), np.frombuffer(b"".join(blobs), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)))
        self.words = [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        self.short = [n for n, w in zip(self.names, self.words) if len(w) < LEAST_WORDS]
        if self.short:
            raise ValueError(f"templates of fewer than {LEAST_WORDS} words: {self.short}")
        sizes = [(words.ends - words.starts)[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        known, templates_of = np.unique(np.concatenate([np.unique(w) for w in self.words]), return_counts=True)
        self.needed, keys, where = [], [], []
        for t, w in enumerate(self.words):
            self.needed.append(next((k for k in range(1, len(w)) if k >= coverage * len(w)), len(w)))
            # A match misses len(w) - needed words at most, so it has one of any set with one word more.
            rare = np.lexsort((w, -sizes[t], templates_of[np.searchsorted(known, w)]))
            for p in sorted(rare[:len(w) - self.needed[t] + 1].tolist()):
                keys.append(w[p])
                where.append((t, p))
        order = np.argsort(np.array(keys, np.uint64), kind="stable")
        self.keys = np.array(keys, np.uint64)[order]
        self.where = np.array(where)[order]

    def hits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``prints``, template, place in the template) of all fingerprints found."""
        low = np.searchsorted(self.keys, prints)
        at = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == prints)
        counts = np.searchsorted(self.keys, prints[at], "right") - low[at]
        entries = C.ranges(low[at], counts)
        return np.repeat(at, counts), self.where[entries, 0], self.where[entries, 1]


def align(template: np.ndarray, words: np.ndarray, offset: int, band: int) -> tuple[int, int, int]:
    """(matched template words, first, last matched word) of the best alignment of the template with ``words`` that stays within ``band``
    words of the diagonal where word ``offset`` stands for the template's first."""
    width = 2 * band + 1
    n = len(template)
    # best[i][d]: most matches of the first i template words with words before offset + i + d - band.
    best = np.zeros((n + 1, width), np.int32)
    same = np.zeros((n, width), bool)
    for i in range(n):
        j = offset + i - band + np.arange(width)
        inside = (j >= 0) & (j < len(words))
        same[i, inside] = words[j[inside]] == template[i]
        row = np.maximum(best[i] + same[i], np.append(best[i][1:], 0))
        best[i + 1] = np.maximum.accumulate(row)
    # The words before a cell of row i + 1 end one word later than those of row i with the same place in the band.
    d, matched, first, last = width - 1, int(best[n].max()), -1, -1
    for i in range(n, 0, -1):
        while d > 0 and best[i][d - 1] == best[i][d]:
            d -= 1
        if same[i - 1, d] and best[i][d] == best[i - 1][d] + 1:
            first = offset + i - 1 - band + d
            last = first if last < 0 else last
        else:
            d = min(d + 1, width - 1)
    return matched, first, last


def around(template: np.ndarray, words: np.ndarray, at: int, place: int, band: int) -> tuple[int, int, int]:
    """(matched template words, first, last matched word) of the best alignment that has word ``place`` for the template's word ``at``; of
    several, the one that keeps closest to it."""
    right = template[at + 1:]
    left = template[:at][::-1]
    after, _, last = align(right, words[place + 1:place + 1 + len(right) + band], 0, band)
    before, _, first = align(left, words[max(0, place - len(left) - band):place][::-1], 0, band)
    return before + 1 + after, place - 1 - first if before else place, place + 1 + last if after else place


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, coverage: float = 0.8,
         band: int = BAND) -> DataFrame:
    """(id, license, coverage, n_matched, start, end) for each place in a text of ``docs`` that matches ``coverage`` of a template's
    words; ``start`` and ``end`` are code points of the text.

    Null and empty texts match nothing. Places of one template that overlap are one, the one that covers most (then the shortest, then the first).
    Repeated rows and null ids are reported as they stand. Other columns are not looked at. No rows give no rows."""
    index = docs.sparkSession.sparkContext.broadcast(Index(templates or TEMPLATES, coverage))
    schema = pa.schema([("id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("n_matched", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in C.texts_of(batches, C.CHUNK_BYTES):
            rows = [dict(zip(schema.names, r)) for r in found(texts, index.value, coverage, band)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    out = C.text_column(docs, id_col, text_col).mapInArrow(scanned, "id long, license string, coverage double, n_matched long, start long, end long")
    return out.withColumn("id", C.id_or_null())


def found(texts: C.Texts, index: Index, coverage: float, band: int) -> Iterator[tuple]:
    words = PlainWords(texts)
    place, template, at = index.hits(words.hashes)
    owner = np.searchsorted(words.bounds, place, "right") - 1
    best: dict[tuple[int, int], list] = {}
    for t in np.unique(template).tolist():
        own = index.words[t]
        mine = np.flatnonzero(template == t)
        # Of the words that an alignment can reach, as many as it needs must be words of the template.
        among = np.concatenate([[0], np.cumsum(np.isin(words.hashes, own))])
        begins = np.maximum(words.bounds[owner[mine]], place[mine] - at[mine] - band)
        ends = np.minimum(words.bounds[owner[mine] + 1], place[mine] - at[mine] + len(own) + band)
        for k in mine[among[ends] - among[begins] >= index.needed[t]].tolist():
            doc = int(owner[k])
            low, high = int(words.bounds[doc]), int(words.bounds[doc + 1])
            matched, first, end = around(own, words.hashes[low:high], int(at[k]), int(place[k]) - low, band)
            if matched >= coverage * len(own):
                best.setdefault((doc, t), []).append((-matched, end - first, low + first, low + end, matched))
    for (doc, t), places in sorted(best.items()):
        chosen: list = []
        for p in sorted(places):
            if all(p[2] > c[3] or p[3] < c[2] for c in chosen):
                chosen.append(p)
        begin = texts.offsets[doc]
        points = lambda to: int(((texts.data[begin:to] & 0xC0) != 0x80).sum())
        for _, _, a, b, matched in sorted(chosen, key=lambda p: p[2]):
            yield (int(texts.ids[doc]), index.names[t], matched / len(index.words[t]), matched, points(words.starts[a]), points(words.ends[b]))
