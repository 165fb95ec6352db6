"""License scan: MinHash bands over overlapping windows of a text retrieve templates, exact shingle containment verifies them.

A window is as long as the templates it is compared with and moves by an eighth of that, so a template's occurrence is off the
nearest window by a sixteenth at most. BANDS bands of ROWS minima each find a window whose Jaccard similarity to a template is s
with probability 1 - (1 - s ** ROWS) ** BANDS: 0.9999 at 0.5 and over 0.999999 at 0.6, the least that 80 % containment and that
offset leave. What the bands bring up is then compared shingle by shingle.
"""

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows
from plotloom.llm.decontaminate import words_of
from plotloom.llm.tokens import _runs

SHINGLE, CONTAINED = 5, 0.8
BANDS, ROWS = 32, 2
#: Words of a shard of whole documents that a task works on at once.
SHARD = 1 << 20

#: Notices and opening terms of public licenses, word for word.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of '
                         "the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
                         'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "mit-notice": "Released under the MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the '
                 "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "all-rights-reserved": "All rights reserved",
}


def _minima(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash of each row of shingle hashes: one minimum for each pair of factors."""
    return np.stack([(sets * x + y >> np.uint64(11)).min(1) for x, y in zip(a, b, strict=True)], 1)


class Templates:
    """Templates by their length in words, with shingle hashes and their bands."""

    def __init__(self, texts: dict[str, str]):
        ws = {n: words_of(t.encode()) for n, t in texts.items()}
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for x in ws.values() for w in x}))}
        rng = np.random.default_rng(11)
        self.word = rng.integers(1, 2**63, len(self.vocab) + 1, np.uint64)
        self.a = rng.integers(1, 2**63, BANDS * ROWS, np.uint64) | np.uint64(1)
        self.b = rng.integers(1, 2**63, BANDS * ROWS, np.uint64)
        self.groups: dict[int, list] = defaultdict(list)
        for name, x in sorted(ws.items()):
            if x:
                h = self.shingles(np.array([self.vocab[w] for w in x]), min(SHINGLE, len(x)))
                self.groups[len(x)].append((name, np.unique(h), self.bands(h[None, :])[0]))

    def shingles(self, ids: np.ndarray, size: int) -> np.ndarray:
        """A 64-bit hash of each run of ``size`` words."""
        n = max(0, len(ids) - size + 1)
        h = np.zeros(n, np.uint64)
        for j in range(size):
            h = (h ^ self.word[ids[j:n + j]]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def bands(self, sets: np.ndarray) -> np.ndarray:
        m = _minima(sets, self.a, self.b).reshape(len(sets), BANDS, ROWS)
        return (m * np.arange(1, 2 * ROWS, 2, dtype=np.uint64)).sum(2)

    def scan(self, ids: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, str, int, int, float]]:
        """(document, template, first word, word after the last, containment) for the documents that begin at ``starts`` in ``ids``.

        Words of no template have id 0. A window all of whose shingles hold such a word shares no shingle with any template.
        """
        lengths = np.diff(np.r_[starts, len(ids)])
        for n, group in self.groups.items():
            size = min(SHINGLE, n)
            h = self.shingles(ids, size)
            unknown = np.r_[0, np.cumsum(ids == 0)]
            whole = np.r_[0, np.cumsum(unknown[size:] == unknown[:-size])] if len(ids) >= size else np.zeros(1, int)
            step, wide = max(1, n // 8), n - size + 1
            fits = lengths >= n
            many = np.where(fits, (lengths - n + step - 1) // step + 1, 0)
            at = np.minimum(_runs(np.zeros(len(starts), np.int64), many) * step, np.repeat(lengths - n, many)) + np.repeat(starts, many)
            doc = np.repeat(np.arange(len(starts)), many)
            some = np.flatnonzero(whole[at + wide] > whole[at])
            found: dict[tuple[int, str], list] = defaultdict(list)
            for part in np.array_split(some, max(1, len(some) // 20_000)):
                bands = self.bands(h[at[part][:, None] + np.arange(wide)])
                for name, own, mine in group:
                    for k in part[(bands == mine).any(1)].tolist():
                        d = int(doc[k])
                        low, high = max(int(starts[d]), int(at[k]) - step), min(int(starts[d] + lengths[d]), int(at[k]) + n + step)
                        here = np.flatnonzero(np.isin(h[low:high - size + 1], own))
                        share = len(np.unique(h[low + here])) / len(own)
                        if share >= CONTAINED:
                            found[d, name].append((low + int(here[0]), low + int(here[-1]) + size, share))
            for d, name, s, e, share in self._merged(found):
                yield d, name, s - int(starts[d]), e - int(starts[d]), share
            short = np.flatnonzero((lengths < n) & (lengths >= size))     # shorter than the template: the whole text is the window
            for d in short[[bool(whole[starts[d] + lengths[d] - size + 1] > whole[starts[d]]) for d in short.tolist()]].tolist() if len(short) else []:
                own_h = h[starts[d]:starts[d] + lengths[d] - size + 1]
                bands = self.bands(own_h[None, :])[0]
                for name, own, mine in group:
                    here = np.flatnonzero(np.isin(own_h, own)) if (bands == mine).any() else []
                    share = len(np.unique(own_h[here])) / len(own) if len(here) else 0.0
                    if share >= CONTAINED:
                        yield d, name, int(here[0]), int(here[-1]) + size, share

    @staticmethod
    def _merged(found: dict[tuple[int, str], list]) -> Iterator[tuple[int, str, int, int, float]]:
        """Overlapping finds of one template in one document become one."""
        for (d, name), spans in sorted(found.items()):
            s, e, share = None, None, 0.0
            for a, b, c in sorted(spans):
                if s is None or a >= e:
                    if s is not None:
                        yield d, name, s, e, share
                    s, e, share = a, b, c
                else:
                    e, share = max(e, b), max(share, c)
            yield d, name, s, e, share


@lru_cache(maxsize=1)
def _standard() -> Templates:
    return Templates(TEMPLATES)


FOUND = "array<struct<license:string,first_word:int,end_word:int,containment:double>>"


def scanned(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, found) for every row of ``docs`` (doc_id, text, anything else): where which template stands, in words.

    Null and wordless texts hold nothing; texts shorter than a template are one window; repeated rows each get their row.
    Texts stay where they are; the templates are a fixed, small list.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(templates) if templates is not None else _standard()
        kind = None
        for whole in batches:
            texts = whole.column("text").cast(pa.large_binary())
            size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 6 + 1)
            for s in np.unique(size // SHARD):
                at, n = int(np.searchsorted(size // SHARD, s)), int((size // SHARD == s).sum())
                ids = [np.fromiter((t.vocab.get(w, 0) for w in ws), np.int64, len(ws)) for ws in map(words_of, texts.slice(at, n).to_pylist())]
                found: list[list] = [[] for _ in ids]
                for d, name, a, b, share in t.scan(np.concatenate(ids), np.cumsum([0, *map(len, ids)])[:-1]):
                    found[d].append({"license": name, "first_word": a, "end_word": b, "containment": share})
                kind = kind or pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int32()), ("end_word", pa.int32()), ("containment", pa.float64())]))
                yield pa.RecordBatch.from_arrays([whole.column("doc_id").slice(at, n), pa.array(found, kind)], ["doc_id", "found"])
    rows = as_rows(docs).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, found {FOUND}")


def report(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, n_matches, licenses (sorted names, comma-joined), containment of its best match (0 if none)."""
    return scanned(docs).select("doc_id", F.size("found").cast("long").alias("n_matches"),
                                F.array_join(F.array_sort(F.array_distinct("found.license")), ",").alias("licenses"), F.coalesce(F.array_max("found.containment"), F.lit(0.0)).alias("containment"))
