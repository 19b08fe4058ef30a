"""Licence scans: TF-IDF cosine of headers and licence files to templates, inherited from the nearest directory.

1. Document frequencies of words are counted over all texts, in ``CELLS`` hashed counters.
2. Every line of a text, every block of lines between empty lines, the whole text, and around every line with a telling word the
   runs of lines of each template's number of words are header candidates. A candidate's sparse TF-IDF
   vector is compared with every template's; the best cosine of ``COSINE`` or more is the text's own licence (ties: the earlier
   candidate, then the earlier template). Candidates without a telling word are skipped: words are left out of the
   telling ones, heaviest last, while their weights alone cannot reach ``COSINE`` in any template, so nothing is lost.
   A template only counts if the candidate has the marks of its licence (name, version, NC, SA, ND: ``MARKS``) and none that
   contradicts it; a candidate that agrees with two licences within ``TIED`` states neither.
3. A directory's licence is that of its licence file (of several, the first by path). A file without a licence of its own
   takes that of its nearest ancestor directory with one: directories are joined with those above them by path.

Scale: two passes over the texts without a shuffle; what is joined are paths. Ancestors are listed per directory, not per
file. A directory with a third of all files is one row in that join; files take its result by a join that can be split.

Defined cases: null texts are empty and null paths lie in no directory; repeated rows are scanned each; empty texts have no
licence of their own; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import batch_of, staged, text_or_empty, text_slices
from quarterdeck.llm.counters import CELLS, added, cells, sliced
from quarterdeck.llm.shingles import Shingler

COSINE = 0.6
LICENCE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^copyright|^notice"

#: Opening or notice texts of public licences, (licence, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, version 1.2."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("Unlicense", "Released under the Unlicense."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
)

_GNU, _CC = r"general public licen[cs]e|\bgpl", r"\bcc by\b|creative commons attribution"
_NC, _SA, _ND = r"\bnc\b|non ?commercial", r"\bsa\b|share ?alike", r"\bnd\b|no ?deriv"
_BSD = r"redistributions in binary form"


def _version(number: str) -> str:
    """A version number that is named as one (version 2, v2, v. 2, GPL-2, License 2.0, 2.0)."""
    major, _, minor = number.partition(".")
    return rf"\b(version|v|[al]?gpl|mpl|epl|eupl|licen[cs]e|apache) ?v?{major}{f' {minor}' if minor not in ('', '0') else r'(?! [1-9]\b)'}\b"


#: What a text must say to state a licence, and what it must not; over its words in lower case, one space apart.
MARKS = {
    "MIT": ((r"\bmit\b|hereby granted free of charge to any person",), ()),
    "Apache-2.0": ((r"\bapache\b", _version("2.0")), (r"\bversion 1\b",)),
    "GPL-2.0": ((_GNU, _version("2")), (r"\b(lesser|library general|affero)\b", _version("3"))),
    "GPL-3.0": ((_GNU, _version("3")), (r"\b(lesser|library general|affero)\b", _version("2"))),
    "LGPL-2.1": ((r"\blesser general public|\blgpl", _version("2.1")), (r"\baffero\b", _version("3"))),
    "LGPL-3.0": ((r"\blesser general public|\blgpl", _version("3")), (r"\baffero\b", _version("2.1"))),
    "AGPL-3.0": ((r"\baffero general public|\bagpl", _version("3")), (r"\blesser\b",)),
    "MPL-2.0": ((r"\bmozilla public|\bmpl\b", _version("2.0")), ()),
    "EPL-2.0": ((r"\beclipse public|\bepl\b", _version("2.0")), ()),
    "EUPL-1.2": ((r"\beuropean union public|\beupl\b", _version("1.2")), ()),
    "BSD-2-Clause": ((rf"\bbsd 2 clause|\b(simplified|freebsd) bsd|{_BSD}",), (r"\b[034] clause", r"neither the name|names? of .* endorse", r"all advertising")),
    "BSD-3-Clause": ((rf"\bbsd 3 clause|\b(new|revised|modified) bsd|{_BSD}.*(neither the name|names? of .* endorse)",), (r"\b[024] clause", r"all advertising")),
    "ISC": ((r"\bisc licen|with or without fee is hereby granted",), ()),
    "Unlicense": ((r"\bunlicense\b|free and unencumbered software",), ()),
    "CC0-1.0": ((r"\bcc0\b|waived all copyright",), ()),
    "CC-BY-4.0": ((_CC, r"\b4 0\b"), (_NC, _SA, _ND)),
    "CC-BY-SA-4.0": ((_CC, _SA, r"\b4 0\b"), (_NC, _ND)),
    "CC-BY-NC-4.0": ((_CC, _NC, r"\b4 0\b"), (_SA, _ND)),
    "CC-BY-NC-SA-4.0": ((_CC, _NC, _SA, r"\b4 0\b"), (_ND,)),
    "CC-BY-ND-4.0": ((_CC, _ND, r"\b4 0\b"), (_NC, _SA)),
    "CC-BY-NC-ND-4.0": ((_CC, _NC, _ND, r"\b4 0\b"), (_SA,)),
}
TIED = 0.05


def says(text: str, licence: str) -> bool:
    """Whether a text has all marks of a licence and none that contradicts it."""
    plain = " ".join(re.findall(r"[a-z0-9]+", text.lower()))
    need, refused = MARKS[licence]
    return all(re.search(m, plain) for m in need) and not any(re.search(m, plain) for m in refused)


def word_frequencies(texts: DataFrame) -> np.ndarray:
    """How many texts have a word of each cell, and at the end how many texts there are."""
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        shingler, counts, n = Shingler(1), np.zeros(CELLS, np.int64), 0
        for batch in text_slices(batches, 0):
            place, words = shingler.words(batch.column(0).to_pylist())
            n += batch.num_rows
            pairs = np.unique(place * CELLS + cells(words))
            counts += np.bincount(pairs % CELLS, minlength=CELLS)
        if n:
            slices, parts = zip(*sliced(counts), strict=True)
            yield batch_of(schema, (slices, parts))
            yield batch_of(schema, ([-1], [np.array([n], "<i8").tobytes()]))

    rows = staged(texts.mapInArrow(run, "slice int, counts binary"), "licence-words")
    documents = sum(int.from_bytes(r["counts"], "little") for r in rows.where("slice < 0").select("counts").toLocalIterator())
    return np.append(added(rows.where("slice >= 0")), documents)


class Matcher:
    """Best template of candidate texts, by cosine of TF-IDF vectors over hashed words."""

    def __init__(self, frequencies: np.ndarray, templates=TEMPLATES, cosine: float = COSINE):
        self.cosine, self.templates, self.shingler = cosine, templates, Shingler(1)
        self.idf = np.log((1 + frequencies[-1]) / (1 + np.minimum(frequencies[:-1], frequencies[-1]))) + 1
        vectors = [self.vector(t) for _, t in templates]
        self.vocabulary = np.unique(np.concatenate([w for w, _ in vectors]))
        self.matrix = np.zeros((len(templates), len(self.vocabulary)))
        for i, (w, v) in enumerate(vectors):
            self.matrix[i, np.searchsorted(self.vocabulary, w)] = v / np.sqrt((v * v).sum())
        # Lightest words first: without the others no candidate reaches the cosine.
        light = np.argsort(self.matrix.max(axis=0), kind="stable")
        reach = np.sqrt(np.cumsum(self.matrix[:, light] ** 2, axis=1)).max(axis=0)
        self.lengths = sorted({len(self.shingler.words([t])[1]) for _, t in templates})
        self.telling = np.sort(self.vocabulary[light[int(np.searchsorted(reach, cosine - 1e-9)) :]])

    def _known(self, words: np.ndarray, table: np.ndarray) -> np.ndarray:
        at = np.searchsorted(table, words)
        at[at == len(table)] = 0
        return table[at] == words

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words, n = np.unique(self.shingler.words([text])[1], return_counts=True)
        return words, n * self.idf[cells(words)]

    def candidates(self, text: str, lines: list[str], words: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(line it is reported at, first line, last line) of lines, of blocks between empty lines, of runs of lines and of the whole text.

        Only those with a telling word: the others reach no template's cosine. ``starts`` has the place of each line's first word.
        """
        n = len(lines)
        each = np.arange(n)
        out = [np.column_stack([each, each, each])]
        telling = np.unique(place[self._known(words, self.telling)])
        if n > 1:
            blocks, at = [], 0
            for block in re.split(r"\n[^\S\n]*\n", text):
                if "\n" in block.strip("\n"):
                    blocks.append((at, at, at + block.count("\n")))
                at += block.count("\n") + 2
            out += [np.array(blocks, np.int64).reshape(-1, 3), self.windows(n, words, place, starts, telling), np.array([[0, 0, n - 1]])]
        spans = np.concatenate(out)
        told = np.concatenate([[0], np.cumsum(np.bincount(telling, minlength=n))])
        return spans[told[spans[:, 2] + 1] > told[spans[:, 1]]]

    def windows(self, n: int, words: np.ndarray, place: np.ndarray, starts: np.ndarray, telling: np.ndarray) -> np.ndarray:
        """Runs of two or more lines that hold a template's number of words, with or without the line that exceeds it.

        They start at lines from which such a run reaches a line with a telling word, and are listed once each, in order.
        """
        ends, before, each = starts[1:], starts[:-1], np.arange(n)
        reach = np.append(telling, n)[np.searchsorted(telling, each)]
        runs = []
        for length in self.lengths:
            last = np.searchsorted(ends, before + length)  # the line with the run's last word
            i = np.flatnonzero((reach <= last) & (ends > before))
            stop = np.minimum(last[i], n - 1)
            runs += [(i * n + k)[k > i] for k in (stop - 1, stop)]
        i, k = np.divmod(np.unique(np.concatenate(runs)), n)
        if not len(i):
            return np.zeros((0, 3), np.int64)
        # A repeated word adds more to the norm than its places' squares do, so a run below the cosine by this bound is below it.
        weight, inside = self.idf[cells(words)], np.flatnonzero(self._known(words, self.vocabulary))
        at, own = np.searchsorted(self.vocabulary, words[inside]), weight[inside]
        bounds = np.searchsorted(inside, starts)
        norms = np.concatenate([[0.0], np.cumsum(weight * weight)])[starts]
        most, sums = np.zeros(len(i)), np.zeros(len(inside) + 1)
        first, stop = bounds[i], bounds[k + 1]
        for row in self.matrix:
            np.cumsum(row[at] * own, out=sums[1:])
            np.maximum(most, sums[stop] - sums[first], out=most)
        kept = most >= (self.cosine - 1e-6) * np.sqrt(norms[k + 1] - norms[i])
        return np.column_stack([i, i, k])[kept]

    def _stated(self, near: np.ndarray, candidate: str, text: str) -> int | None:
        """The best template that the candidate agrees with; none if one of another licence is ``TIED`` with it."""
        agreeing: list[int] = []
        for k in np.argsort(-np.round(near, 12), kind="stable"):
            if near[k] < self.cosine or (agreeing and near[k] < near[agreeing[0]] - TIED):
                break
            licence = self.templates[k][0]
            # The opening of a BSD notice does not tell its clauses: they are looked for in the whole text.
            if says(text if self.templates[k][1].startswith("Redistribution") else candidate, licence):
                agreeing.append(int(k))
        return agreeing[0] if len({self.templates[k][0] for k in agreeing}) == 1 else None

    def best(self, text: str, stated: bool = False) -> tuple[str, float, int] | None:
        """Licence, cosine and line; with ``stated`` only candidates that have the marks of the licence count."""
        top: tuple[float, int, int] | None = None
        lines, seen = text.split("\n"), set()
        place, words = self.shingler.words(lines)
        starts = np.searchsorted(place, np.arange(len(lines) + 1))
        for line, first, last in self.candidates(text, lines, words, place, starts).tolist():
            own = words[starts[first] : starts[last + 1]]
            if own.tobytes() in seen:  # a repeated line
                continue
            seen.add(own.tobytes())
            own, n = np.unique(own, return_counts=True)
            v, inside = n * self.idf[cells(own)], self._known(own, self.vocabulary)
            near = self.matrix[:, np.searchsorted(self.vocabulary, own[inside])] @ v[inside] / np.sqrt((v * v).sum())
            if near.max() < self.cosine:
                continue
            k = self._stated(near, "\n".join(lines[first : last + 1]), text) if stated else int(np.argmax(np.round(near, 12)))
            if k is not None and near[k] >= self.cosine and (top is None or near[k] > top[0] + 1e-12):
                top = (float(near[k]), line, k)
        return None if top is None else (self.templates[top[2]][0], min(top[0], 1.0), top[1])

    def matches(self, texts: list[str], stated: bool = False) -> list[tuple[str, float, int] | None]:
        place, words = self.shingler.words(texts)
        hit = np.zeros(len(texts), bool)
        hit[place[self._known(words, self.telling)]] = True
        return [self.best(t, stated) if h else None for t, h in zip(texts, hit, strict=True)]


def own_licences(files: DataFrame, frequencies: np.ndarray, cosine: float = COSINE) -> DataFrame:
    """file_id, path, own, cosine, line (of the statement, from 0), lines of every file; ``files`` has file_id, path, text."""
    held = files.sparkSession.sparkContext.broadcast(frequencies)
    kinds = [("file_id", pa.int64()), ("path", pa.string()), ("own", pa.string()), ("cosine", pa.float64()), ("line", pa.int64()), ("lines", pa.int64())]
    schema = pa.schema(kinds)

    def run(batches):
        matcher = Matcher(held.value, cosine=cosine)
        for batch in text_slices(batches, 2):
            texts = batch.column(2).to_pylist()
            found = [m or (None, None, None) for m in matcher.matches(texts, stated=True)]
            yield batch_of(schema, (*batch.columns[:2], *zip(*found, strict=True), [t.rstrip("\n").count("\n") + 1 for t in texts]))

    return files.mapInArrow(run, "file_id long, path string, own string, cosine double, line long, lines long")


def directory_of(path: Column) -> Column:
    """All before the last slash; the root is the empty path."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(files: DataFrame, is_licence_file: Column) -> DataFrame:
    """Adds directory, licence, origin ('own', 'inherited', 'none'), licence_directory and distance to own licences.

    ``is_licence_file`` is a condition on the columns of ``files`` (path, own, line, ...).
    """
    files = files.withColumn("directory", directory_of(F.col("path")))
    declared = files.where(is_licence_file & F.col("own").isNotNull() & F.col("path").isNotNull())
    declared = declared.groupBy(F.col("directory").alias("ancestor")).agg(F.min(F.struct("path", "own")).getField("own").alias("given"))
    # Every directory with those above it, itself first: a/b/c -> a/b/c, a/b, a, root.
    parts = F.filter(F.split("directory", "/"), lambda x: x != "")
    dirs = files.where(F.col("path").isNotNull()).select("directory").distinct().withColumn("parts", parts)
    above = dirs.select("directory", F.size("parts").alias("depth"), F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("level"), "parts")
    lead = F.when(F.col("directory").startswith("/"), F.lit("/")).otherwise(F.lit(""))
    prefix = F.when(F.col("level") == F.col("depth"), F.col("directory")).when(F.col("level") == 0, F.lit("")).otherwise(
        F.concat(lead, F.array_join(F.expr("slice(parts, 1, level)"), "/"))
    )
    above = above.select("directory", (F.col("depth") - F.col("level")).alias("distance"), prefix.alias("ancestor"))
    nearest = above.join(declared, "ancestor").groupBy("directory").agg(F.min(F.struct("distance", "ancestor", "given")).alias("near"))
    out = files.join(nearest, "directory", "left")
    from_above = F.col("own").isNull() & F.col("near").isNotNull()
    return out.select(
        *[c for c in files.columns],
        F.coalesce("own", "near.given").alias("licence"),
        F.when(F.col("own").isNotNull(), "own").when(from_above, "inherited").otherwise("none").alias("origin"),
        F.when(from_above, F.col("near.ancestor")).alias("licence_directory"),
        F.when(from_above, F.col("near.distance")).cast("int").alias("distance"),
    )


def scan(files: DataFrame, is_licence_file: Column | None = None, cosine: float = COSINE) -> DataFrame:
    """Licences of files (file_id, path, text); licence files are known by their names unless a condition is given."""
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE) if is_licence_file is None else is_licence_file
    files = files.select(F.col("file_id").cast("long").alias("file_id"), F.col("path").cast("string").alias("path"), text_or_empty().alias("text"))
    frequencies = word_frequencies(files.select("text"))
    return inherited(staged(own_licences(files, frequencies, cosine), "licence-own"), named)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``; one whose first or last line states a licence is a licence file of its directory."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    files = docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    out = scan(files, (F.col("line") == 0) | (F.col("line") == F.col("lines") - 1))
    kept = ("path", "own", "cosine", "line", "licence", "origin", "licence_directory", "distance")
    return out.select(F.col("file_id").alias("doc_id"), *kept)
