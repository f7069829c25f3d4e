"""Licence scan by a positional index of rare words.

Templates are licence texts, the notices by which files refer to a licence, and
SPDX identifiers; ``listed`` takes a table of others. Their words are weighed by inverse document
frequency over the whole corpus; each template is indexed under the positions
of its rarest words. A document looks up its own occurrences of those words:
postings of one template that agree on the relative position mark a candidate,
which is accepted if the template's mandatory key phrases stand at that place
and enough of its words are aligned.

Two scans of the texts, no shuffle but that of the counts of the templates'
words (about a hundred, whatever the corpus); index and weights travel with the
task. A document is read by itself, so memory is bounded by one batch.

Defined results: null and empty texts have no words and no labels; null ids
and repeated rows pass through; an empty table gives an empty result; only
the id and text columns are read, others cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pii import TO_WORDS

#: Phrases of the base labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: (label, text, mandatory key phrases). Sentences of the licences themselves.
TEMPLATES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license", "version 3")),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2",
     ("gnu general public license", "version 2")),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as "
            "published by the free software foundation", ("gnu general public license", "redistribute")),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
             "published by the free software foundation", ("gnu lesser general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", ("permission is hereby granted", "free of charge")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ("permission to use copy modify", "with or without fee")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ("source and binary forms", "following conditions are met")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0", ("cc by nc sa 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
     "(at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
     ("gnu lesser general public license", "version 2.1")),
    ("lgpl-2.1", "licensed under the GNU Lesser General Public License version 2.1",
     ("gnu lesser general public license", "version 2.1")),
    ("lgpl-3.0", "licensed under the GNU Lesser General Public License version 3",
     ("gnu lesser general public license", "version 3")),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version.", ("gnu affero general public license",)),
    ("agpl-3.0", "licensed under the GNU Affero General Public License version 3",
     ("gnu affero general public license", "version 3")),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
     "details.", ("gnu general public license for more details",)),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
     "specific language governing permissions and limitations under the License.",
     ("apache license version 2.0", "as is basis")),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
     "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
     '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
     "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
     "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
     ("permission is hereby granted", "without restriction", "this permission notice shall be included")),
    ("bsd-2-clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
     "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
     "and the following disclaimer in the documentation and/or other materials provided with the distribution.",
     ("redistributions of source code must retain", "redistributions in binary form must reproduce")),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission.",
     ("endorse or promote products derived from this software",)),
    ("bsd-3-clause", "licensed under the BSD 3-Clause License", ("bsd 3 clause",)),
    ("bsd-2-clause", "licensed under the BSD 2-Clause License", ("bsd 2 clause",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
     'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
     "OF MERCHANTABILITY AND FITNESS.", ("with or without fee is hereby granted", "disclaims all warranties")),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
     "any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
     "restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original "
     "software.", ("permission is granted to anyone", "must not be misrepresented")),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
     'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
     "and transmit the Software, and to prepare derivative works of the Software",
     ("any person or organization obtaining a copy", "covered by this license")),
    ("bsl-1.0", "distributed under the Boost Software License, Version 1.0", ("boost software license",)),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
     "2.0", ("eclipse public license",)),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
     ("mozilla public license", "a copy of the mpl")),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
     "this software to the public domain worldwide", ("to the extent possible under law", "public domain worldwide")),
    ("cc0-1.0", "released under the CC0 1.0 Universal public domain dedication", ("cc0 1.0 universal",)),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
     "purpose, commercial or non-commercial, and by any means.", ("unencumbered software", "public domain")),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software", "public domain")),
    ("proprietary", "all rights reserved unauthorized copying of this file is strictly prohibited",
     ("all rights reserved", "strictly prohibited")),
)
#: Identifiers by which files name a licence (fixed values of the SPDX list); each makes a template.
SPDX = ("AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
        "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib")
#: Rarest words by which a template is indexed, and how many of them must agree on a position.
ANCHORS = 4
AGREE = 2
#: Share of a template's words that must be aligned.
ACCEPT = 0.6
#: Words by which an aligned word may be displaced (an inserted or missing word).
SLIP = 2


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]


def spdx_templates() -> list[tuple[str, str, tuple[str, ...]]]:
    """A template for each identifier, under its label without the part that names later versions."""
    return [(name.lower().removesuffix("-only").removesuffix("-or-later"), f"SPDX-License-Identifier: {name}",
             (f"spdx license identifier {name}",)) for name in SPDX]


def templates(listed=None) -> list[Template]:
    """The templates of a table of (label, text, mandatory phrases), in the words of the scan."""
    listed = [*TEMPLATES, *spdx_templates()] if listed is None else listed
    return [Template(label, words_of(text.encode()), [words_of(p.encode()) for p in phrases])
            for label, text, phrases in listed]


def vocabulary(listed: list[Template]) -> frozenset[bytes]:
    return frozenset(w for t in listed for w in t.words)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TO_WORDS).split()


def document_frequencies(docs: DataFrame, vocab: frozenset[bytes], text_col: str = "text") -> tuple[int, dict]:
    """Number of documents, and of those that hold each word of the templates: at most
    ``len(vocab)`` rows reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = Counter(), 0
        for batch in batches:
            for text in batch.column(0):
                n += 1
                held.update(vocab.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_pydict({
            "word": pa.array([None, *(w.decode() for w in held)], pa.string()),
            "n": pa.array([n, *held.values()], pa.int64())})

    rows = (docs.select(F.col(text_col).cast("string").cast("binary").alias("t"))
            .mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect())
    counts = {r["word"]: r["n"] for r in rows}
    return counts.pop(None, 0), {w.encode(): n for w, n in counts.items()}


def rare_index(listed: list[Template], total: int, counts: dict) -> tuple[dict, list[int]]:
    """word -> [(template, position)] of the templates' words of highest IDF; anchors by template."""
    idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) for t in listed for w in t.words}
    index, anchors = defaultdict(list), []
    for number, t in enumerate(listed):
        rare = sorted(set(t.words), key=lambda w: (-idf[w], w))[:ANCHORS]
        anchors.append(len(rare))
        for position, word in enumerate(t.words):
            if word in rare:
                index[word].append((number, position))
    return dict(index), anchors


def phrase_at(words: list[bytes], phrase: list[bytes], low: int, high: int) -> int:
    """The first place of a phrase that starts within [low, high), or -1."""
    first = phrase[0]
    for i in range(max(0, low), min(high, len(words) - len(phrase) + 1)):
        if words[i] == first and words[i:i + len(phrase)] == phrase:
            return i
    return -1


def aligned(words: list[bytes], template: list[bytes], at: int) -> float:
    """Share of a template's words that stand at their place, give or take ``SLIP``."""
    good = sum(w in words[max(0, at + i - SLIP):max(0, at + i + SLIP + 1)] for i, w in enumerate(template))
    return good / len(template)


def match(words: list[bytes], found: set, index: dict, anchors: list[int], listed: list[Template]
          ) -> list[tuple[str, int, float]]:
    """(label, start, score) of the accepted templates, by start and label; a start before the
    document's first word (a text that lost its beginning) counts from 0."""
    places = [(i, w) for i, w in enumerate(words) if w in found]
    votes: dict[tuple[int, int], set] = defaultdict(set)
    for i, w in places:
        for number, position in index[w]:
            votes[number, i - position].add(w)
    best: dict[tuple[str, int], float] = {}
    for (number, at), agreeing in votes.items():
        t = listed[number]
        if len(agreeing) < min(AGREE, anchors[number]):
            continue
        low, high = at - SLIP, at + len(t.words) + SLIP
        if all(phrase_at(words, p, low, high) >= 0 for p in t.phrases):
            score = aligned(words, t.words, at)
            if score >= ACCEPT:
                key = t.label, max(0, at)
                best[key] = max(best.get(key, 0.0), score)
    # Of starts that differ by a slip only, the best stays.
    out: list[tuple[str, int, float]] = []
    for (label, at), score in sorted(best.items(), key=lambda x: (x[0][0], x[0][1])):
        if out and out[-1][0] == label and at - out[-1][1] <= 2 * SLIP:
            if score > out[-1][2]:
                out[-1] = (label, at, score)
        else:
            out.append((label, at, score))
    return sorted(out, key=lambda x: (x[1], x[0]))


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(start, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE.items():
        parts = phrase.encode().split()
        if all(p in words for p in parts):
            at = phrase_at(words, parts, 0, len(words))
            while at >= 0:
                out.append((at, label))
                at = phrase_at(words, parts, at + 1, len(words))
    return sorted(out)


RESULT = ("id {id}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, matches array<struct<label:string,start:long,score:double>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", listed=None) -> DataFrame:
    """One row per document row: id, words, base places and labels, and the method's matches."""
    known = templates(listed)
    vocab = vocabulary(known)
    index, anchors = rare_index(known, *document_frequencies(docs, vocab, text_col))
    base_words = frozenset(w for p in BASE for w in p.encode().split())
    # A document without two anchors of one template, or without the last word of a base
    # phrase, cannot match.
    interesting = frozenset(index) | base_words

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("t"):
                words = words_of(text.as_py())
                found = interesting.intersection(words)
                base = base_places(words) if b"license" in found or b"by" in found else []
                hits = match(words, found & index.keys(), index, anchors, known) if len(found) >= AGREE else []
                names = {name for _, name in base}
                out.append({
                    "n_words": len(words), "n_base": len(base), "first_word": base[0][0] if base else None,
                    "last_word": base[-1][0] if base else None, "base_labels": ",".join(sorted(names)),
                    "labels": ",".join(sorted(names | {h[0] for h in hits})),
                    # A base phrase alone is half a finding.
                    "score": max([0.5 if base else 0.0, *(h[2] for h in hits)]),
                    "matches": [{"label": n, "start": s, "score": x} for n, s, x in hits]})
            schema = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                                ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                                ("score", pa.float64()), ("matches", pa.list_(pa.struct([
                                    ("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())])))])
            made = pa.RecordBatch.from_pylist(out, schema=schema)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made.columns], ["id", *schema.names])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
            .mapInArrow(label, RESULT.format(id=kind)))


def license_digest(docs: DataFrame) -> DataFrame:
    """The digest of ``op4``: one row per document."""
    return scan(docs.select("doc_id", "text")).select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.concat_ws(",", F.transform("matches", lambda m: F.concat_ws(":", m["label"], m["start"].cast("string"))))
        .alias("matches"))
