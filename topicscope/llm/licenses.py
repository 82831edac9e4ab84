"""License scans (8): MinHash bands over overlapping text windows retrieve
templates, exact shingle containment verifies them.

Texts and templates are lower-cased words of letters and digits; shingles are
``SHINGLE`` consecutive words (a shorter template is one shingle of all its
words).  Templates are classed by their number of shingles t: class k holds t
in [2^k, 2^(k+1)).  A document is cut into blocks of s = max(1, 2^(k-1))
shingles, and a window is q consecutive blocks, q chosen so that a run of t
shingles lies inside one window wherever it starts.  A template of which a
share ``CONTAINMENT`` of the shingles occurs in such a run then has a Jaccard
similarity of at least J = CONTAINMENT * t / (q * s + (1 - CONTAINMENT) * t)
with that window, and the class gets so many bands (of one row) that the
probability to miss it, (1 - J)^bands, is at most ``MISS``.

Retrieved (text, template) pairs are verified on the whole text: every run that
holds the share of the template's shingles and is no longer than a window is an
occurrence, and occurrences of one template don't overlap.  Of templates that
overlap on a span only the best is reported (:func:`best_of`).  Only the
templates are broadcast, after a check of their size.

The templates are a table of (license, text): :func:`read_templates` reads one
by path, by default the package's license_templates.jsonl (notices, "-text"
openings and "-full" license texts by SPDX id).

Defined cases: a null or wordless text matches nothing; templates with a null
id or without words are ignored; templates of equal words all match; a text
shorter than a window is one window; repeated rows each get a row;
:func:`scan` passes other columns through, its output column replaces an input
column of that name.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterable
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import WordHashes, bounded_batches, shingle_hashes, sliced, without
from .decontaminate import _TABLE, words_of

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4
MAX_TEMPLATE_BYTES = 16 << 20

#: Public licence notices (the first rows of the package's table).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("All-rights-reserved", "All rights reserved."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                 "software and associated documentation files (the \"Software\"), to deal in the Software "
                 "without restriction, including without limitation the rights to use, copy, modify, merge, "
                 "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
                 "to whom the Software is furnished to do so, subject to the following conditions"),
    ("Apache-2.0-text", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                        "this file except in compliance with the License. You may obtain a copy of the "
                        "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0-text", "This program is free software: you can redistribute it and/or modify it under the "
                     "terms of the GNU General Public License as published by the Free Software Foundation, "
                     "either version 3 of the License, or (at your option) any later version."),
    ("BSD-text", "Redistribution and use in source and binary forms, with or without modification, are "
                 "permitted provided that the following conditions are met"),
)

MATCHES = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("containment", T.DoubleType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class _Class:
    """Templates of one shingle width and size class."""

    def __init__(self, width: int, k: int):
        self.width, self.k = width, k
        self.step = max(1, 1 << k >> 1)
        longest = (1 << k + 1) - 1
        self.blocks = -(-(longest + self.step - 1) // self.step)
        t = 1 << k
        j = CONTAINMENT * t / (self.blocks * self.step + (1 - CONTAINMENT) * t)
        if longest == 1:
            j = 1.0  # one shingle, one-shingle windows: equal or not
        self.bands = 1 if j >= 1 else math.ceil(math.log(MISS) / math.log(1 - j))
        rng = np.random.default_rng(1000 * width + k)
        self.factors = rng.integers(1, 1 << 62, self.bands, np.uint64) * np.uint64(2) + np.uint64(1)
        #: A text of fewer shingles holds no template of the class.
        self.least = math.ceil(CONTAINMENT * t - 1e-9)
        self.names: list[str] = []
        self.sets: list[np.ndarray] = []
        self.times: list[dict[int, int]] = []

    def add(self, name: str, shingles: np.ndarray) -> None:
        times = Counter(shingles.tolist())
        self.names.append(name)
        self.sets.append(np.unique(shingles))
        self.times.append(times)

    def occurrences(self, shingles: np.ndarray, template: int) -> list[tuple[float, int, int, int]]:
        """(containment, first word, last word, words of the shingles found, if they
        lie in one run) of the template's occurrences, in order."""
        of, times = self.sets[template], self.times[template]
        where = np.flatnonzero(np.isin(shingles, of))
        need, longest = math.ceil(CONTAINMENT * len(of) - 1e-9), self.step * self.blocks
        if len(where) < need or len(np.unique(shingles[where])) < need:
            return []
        at, hits = where.tolist(), shingles[where].tolist()
        out: list[tuple[float, int, int, int]] = []
        left = right = 0
        held: dict[int, int] = {}

        def drop() -> None:
            nonlocal left
            held[hits[left]] -= 1
            if not held[hits[left]]:
                del held[hits[left]]
            left += 1

        while right < len(at):
            held[hits[right]] = held.get(hits[right], 0) + 1
            right += 1
            # stray shingles before the run, and what lies more than a window behind
            while at[right - 1] - at[left] >= longest or held[hits[left]] > times[hits[left]]:
                drop()
            if len(held) < need:
                continue
            # the run goes on while it adds shingles of the template
            while right < len(at) and at[right] - at[left] < longest:
                h = hits[right]
                if held.get(h, 0) >= times[h]:
                    # a stray first shingle gives way to its place in the run
                    if hits[left] != h or at[left + 1] - at[left] <= at[right] - at[right - 1]:
                        break
                    drop()
                held[h] = held.get(h, 0) + 1
                right += 1
            last = at[right - 1] + self.width - 1
            out.append((len(held) / len(of), at[left], last, len(held) + self.width - 1))
            held.clear()
            while right < len(at) and at[right] <= last:
                right += 1
            left = right
        return out

    def close(self) -> None:
        self.minima = []
        for f in self.factors:
            m = np.array([(s * f).min() for s in self.sets], np.uint64)
            order = np.argsort(m, kind="stable")
            self.minima.append((m[order], order))

    def retrieve(self, texts: list[np.ndarray]) -> set[tuple[int, int, int]]:
        """(text, first shingle of the window, template) that share a band.

        The texts lie one behind the other, each filled up to whole blocks and
        at least one window; windows across two texts are extra candidates at
        most, as every run inside a text also lies in a window of its own.
        """
        s, q = self.step, self.blocks
        blocks = np.array([max(q, -(-len(t) // s)) for t in texts])
        first = np.concatenate(([0], np.cumsum(blocks)))
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        flat = np.concatenate(texts)
        at = np.arange(len(flat)) + np.repeat(first[:-1] * s - (ends - sizes), sizes)
        laid = np.zeros(first[-1] * s, np.uint64)
        laid[at] = flat
        filler = np.ones(len(laid), bool)
        filler[at] = False
        filler = np.flatnonzero(filler)
        n_windows = int(first[-1]) - q + 1
        out: set[tuple[int, int, int]] = set()
        for f, (values, owner) in zip(self.factors, self.minima, strict=True):
            h = laid * f  # shingles are mixed already
            h[filler] = _TOP
            blocks_min = h
            for _ in range(s.bit_length() - 1):  # s is a power of two: halves of halves
                blocks_min = np.minimum(blocks_min[0::2], blocks_min[1::2])
            low = blocks_min[:n_windows].copy()
            for i in range(1, q):
                np.minimum(low, blocks_min[i:i + n_windows], out=low)
            if len(values) > 8:
                hits = np.flatnonzero(values[np.minimum(np.searchsorted(values, low), len(values) - 1)] == low)
            else:
                hits = np.unique(np.concatenate([np.flatnonzero(low == v) for v in values]))
            for w in hits.tolist():
                text = int(np.searchsorted(first, w, side="right")) - 1
                for i in np.flatnonzero(values == low[w]).tolist():
                    out.add((text, (w - int(first[text])) * s, int(owner[i])))
        return out


_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class Scanner:
    """All classes of a template list."""

    def __init__(self, templates: Iterable[tuple[str, str]]):
        self.hashes = WordHashes()
        classes: dict[tuple[int, int], _Class] = {}
        whole: list[tuple[str, bytes]] = []
        for name, text in templates:
            words = words_of(text.encode()) if name is not None and text else []
            if not words:
                continue
            whole.append((name, b" " + b" ".join(words) + b" "))
            width = min(SHINGLE, len(words))
            shingles = shingle_hashes(self.hashes.array(words), width)
            key = (width, len(np.unique(shingles)).bit_length() - 1)
            classes.setdefault(key, _Class(*key)).add(name, shingles)
        #: Pairs of names of which the first's text is part of the second's.
        self.parts = {(a, b) for a, s in whole for b, t in whole
                      if len(s) < len(t) and _license(a) != _license(b) and s in t}
        self.classes = list(classes.values())
        for c in self.classes:
            c.close()

    def matches(self, texts: list[bytes | None]) -> list[list[tuple[str, float, int, int]]]:
        """Per text its (template, containment, first word, last word): every
        occurrence of every template that is the best on its span."""
        words = [words_of(t) for t in texts]
        hashed = [self.hashes.array(w) for w in words]
        by_width: dict[int, list[np.ndarray]] = {}
        found: list[set[tuple[str, float, int, int, int]]] = [set() for _ in texts]
        for c in self.classes:
            if c.width not in by_width:
                by_width[c.width] = [shingle_hashes(h, c.width) if len(h) >= c.width else h[:0]
                                     for h in hashed]
            sh = by_width[c.width]
            used = [i for i, x in enumerate(sh) if len(x) >= c.least]
            if not used:
                continue
            for k, template in sorted({(k, t) for k, _, t in c.retrieve([sh[i] for i in used])}):
                i = used[k]
                found[i].update((c.names[template], *o) for o in c.occurrences(sh[i], template))
        return [best_of(sorted(f), self.parts) for f in found]


def _license(name: str) -> str:
    return name.removesuffix("-text").removesuffix("-full")


def best_of(found: list[tuple[str, float, int, int, int]],
            parts: set[tuple[str, str]]) -> list[tuple[str, float, int, int]]:
    """Of occurrences that lie mostly on one span that of most words; of those
    that lie mostly inside a longer one of another license those of higher
    containment, unless their text is a part of the longer one's."""
    out: list[tuple[str, float, int, int]] = []
    for name, share, first, last, n in sorted(found, key=lambda m: (-m[4], -m[1], m[2], m[0])):
        for other, s, a, b in out:
            common = 2 * (min(last, b) - max(first, a) + 1)
            if common > 0 and other == name or common > last - first and (
                    common > b - a or (name, other) in parts
                    or s >= share and _license(other) != _license(name)):
                break
        else:
            out.append((name, share, first, last))
    return sorted(out, key=lambda m: (m[0], m[2]))


def _offsets(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets of runs of words in the original text."""
    if not runs:
        return []
    norm = np.frombuffer(text.translate(_TABLE), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], norm.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(points[starts[first]]), int(points[ends[last]])) for first, last in runs]


def read_templates(spark: SparkSession | None = None, path: str | None = None) -> tuple[tuple[str, str], ...]:
    """(license, text) of a JSON-lines or Parquet table; by default the package's."""
    if path is None:
        lines = resources.files(__package__).joinpath("license_templates.jsonl").read_text("utf-8")
        return tuple((r["license"], r["text"]) for r in map(json.loads, lines.splitlines()))
    rows = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") \
        else spark.read.schema("license string, text string").json(path)
    size = rows.selectExpr("sum(octet_length(text))").first()[0] or 0
    if size > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes: scan them in parts")
    return tuple((r["license"], r["text"]) for r in rows.select("license", "text").collect())


_scanners: dict = {}


def scan(docs: DataFrame, templates: Iterable[tuple[str, str]] | None = None, text_col: str = "text",
         keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with ``licenses``: one
    entry per occurrence of a template (of the package's table by default), with
    its containment and place."""
    templates = read_templates() if templates is None else templates
    docs = without(bounded_batches(docs), ["licenses"], text_col)
    templates = tuple(templates)
    if sum(len((t or "").encode()) for _, t in templates) > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_BYTES} bytes: scan them in parts")
    keep = [c for c in (docs.columns if keep is None else keep) if c != "licenses"]
    at, columns = docs.columns.index(text_col), [docs.columns.index(c) for c in keep]
    shared = docs.sparkSession.sparkContext.broadcast(templates)
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()),
                               ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        if _scanners.get("of") != shared.value:
            _scanners.update(of=shared.value, scanner=Scanner(shared.value))
        scanner = _scanners["scanner"]
        for batch in sliced(batches):
            texts = [None if (t := v.as_py()) is None else t.encode() for v in batch.column(at)]
            found = []
            for raw, rows in zip(texts, scanner.matches(texts), strict=True):
                places = _offsets(raw, [(first, last) for _, _, first, last in rows])
                found.append([{"license": name, "containment": share, "start": start, "end": end}
                              for (name, share, _, _), (start, end) in zip(rows, places, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in columns] + [pa.array(found, kind)],
                                             names=[batch.schema.names[i] for i in columns] + ["licenses"])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in keep]
                                             + [T.StructField("licenses", MATCHES)]))
