"""License scans: a positional rare-token index over licence templates.

Words are maximal runs of ASCII letters, digits and characters beyond ASCII, in
lower case (A-Z only).  The corpus' document frequencies give each template
word an IDF; the index holds every template's words of highest IDF with their
positions.  A text's indexed words are looked up, postings are intersected by
relative position (text position minus template position), and where at least
two agree the template's mandatory key phrase is verified word by word at that
place.  Cost is one pass for the frequencies and one for the scan, both without
a shuffle of text; what reaches the driver is one count per template word.

Defined results: a null or empty text has no words, zero counts, null places
and empty labels; repeated rows give repeated rows; an empty table gives none;
only ``doc_id`` and ``text`` are read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, chunks, fold_case, hash_of, text_bytes, word_hashes, words

#: Phrases that count by themselves, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, template and its mandatory key phrase (public licence texts and notices).
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so", "use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall be included in all copies or substantial portions"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache org licenses license 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "distributed under the license is distributed on an as is basis"),
    ("apache", "terms and conditions for use reproduction and distribution 1 definitions license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document", "as defined by sections 1 through 9 of this document"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license as published by"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program", "received a copy of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with this library", "received a copy of the gnu lesser general public license"),
    ("lgpl", "under the terms of the gnu library general public license as published by the free software foundation", "gnu library general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "gnu free documentation license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display the following acknowledgement", "all advertising materials mentioning features or use of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "common development and distribution license"),
    ("eupl", "licensed under the eupl the european union public licence", "european union public licence"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "origin of this software must not be misrepresented"),
    ("boost", "distributed under the boost software license version 1 0", "boost software license"),
    ("artistic", "you may redistribute it and or modify it under the same terms as the artistic license", "artistic license"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "without fee and without a written agreement is hereby granted"),
    ("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives 4 0 international license", "creative commons attribution noderivatives"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0", "this work is dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_template long"


class _Index:
    """Hashed templates and, with IDFs, the postings of each template's rarest words."""

    def __init__(self, templates, phrases, rare: int):
        self.templates = [(label, np.array([hash_of(w) for w in text.split()], np.uint64), np.array([hash_of(w) for w in key.split()], np.uint64)) for label, text, key in templates]
        self.keys = [_place(t.split(), k.split()) for _, t, k in templates]
        self.phrases = [(label, np.array([hash_of(w) for w in phrase.split()], np.uint64)) for phrase, label in phrases.items()]
        self.vocabulary = np.unique(np.concatenate([t for _, t, _ in self.templates] + [p for _, p in self.phrases]))
        self.rare = rare
        self.first_bits = np.zeros(1 << 16, bool)
        self.first_bits[self.vocabulary & np.uint64(0xFFFF)] = True

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of template words among ``h`` and their numbers in the vocabulary."""
        at = np.flatnonzero(self.first_bits[(h & np.uint64(0xFFFF)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.vocabulary, h[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[number] == h[at]
        return at[same], number[same]

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        self.idf = np.array([np.log((n_docs + 1) / (df.get(k, 0) + 1)) + 1e-9 for k in range(len(self.vocabulary))])
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for t, (_, text, _) in enumerate(self.templates):
            numbers = np.searchsorted(self.vocabulary, text)
            for k in sorted(set(numbers.tolist()), key=lambda k: (-self.idf[k], k))[: self.rare]:
                for place in np.flatnonzero(numbers == k):
                    self.postings.setdefault(k, []).append((t, int(place)))
        self.indexed = np.zeros(len(self.vocabulary), bool)
        self.indexed[list(self.postings)] = True
        self.flat = {k: np.array(v, np.int64) for k, v in self.postings.items()}


def _place(text: list[str], key: list[str]) -> int:
    return next(i for i in range(len(text) - len(key) + 1) if text[i : i + len(key)] == key)


def _runs_at(h: np.ndarray, at: np.ndarray, last: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` start ``phrase`` before the exclusive end ``last`` of their text."""
    fine = (at >= 0) & (at + len(phrase) <= last)
    for k, x in enumerate(phrase):
        fine &= h[np.clip(at + k, 0, len(h) - 1)] == x
    return fine


def _labels(pairs: list[tuple[int, str]], n: int) -> list[str]:
    found: list[set[str]] = [set() for _ in range(n)]
    for row, label in pairs:
        found[row].add(label)
    return [",".join(sorted(x)) for x in found]


def _scan_chunk(index: _Index, data: np.ndarray, offsets: np.ndarray) -> dict[str, object]:
    n = len(offsets) - 1
    data = fold_case(data)
    starts, ends, first = words(data, offsets, ALNUM)
    h = word_hashes(data, starts, ends)
    n_words = np.diff(first)
    places, numbers = index.known(h)
    row = np.searchsorted(first, places, "right") - 1
    n_base, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
    base: list[tuple[int, str]] = []
    for label, phrase in index.phrases:
        mine = index.vocabulary[numbers] == phrase[0]
        at, r = places[mine], row[mine]
        fine = _runs_at(h, at, first[r + 1], phrase) if len(at) else np.zeros(0, bool)
        at, r = at[fine], r[fine]
        np.add.at(n_base, r, 1)
        np.minimum.at(low, r, at - first[r])
        np.maximum.at(high, r, at - first[r])
        base += [(int(x), label) for x in np.unique(r)]
    # postings of the rare words, as diagonals: text position minus template position
    keep = index.indexed[numbers]
    at, r, number = places[keep], row[keep], numbers[keep]
    votes = [(np.repeat(at[number == k], len(p)), np.repeat(r[number == k], len(p)), np.tile(p, (int((number == k).sum()), 1))) for k, p in index.flat.items()]
    more: list[tuple[int, str]] = []
    score, n_template = np.zeros(n), np.zeros(n, np.int64)
    if votes:
        pos, rows, posting = (np.concatenate([v[i] for v in votes]) for i in range(3))
        diagonal = np.stack([rows, posting[:, 0], pos - posting[:, 1]], axis=1)
        diagonal = diagonal[np.lexsort(diagonal.T[::-1])]
        new = np.any(np.diff(diagonal, axis=0, prepend=np.full((1, 3), -1 << 62)) != 0, axis=1)
        heads = np.flatnonzero(new)
        agreed = np.diff(np.append(heads, len(diagonal))) >= 2
        for rr, t, start in diagonal[heads[agreed]]:
            label, text, key = index.templates[t]
            if not _runs_at(h, np.array([start + index.keys[t]]), first[rr + 1 : rr + 2], key)[0] or start + index.keys[t] < first[rr]:
                continue
            lo, hi = max(start, first[rr]), min(start + len(text), first[rr + 1])
            part = text[lo - start : hi - start]
            weights = index.idf[np.searchsorted(index.vocabulary, text)]
            share = weights[lo - start : hi - start][h[lo:hi] == part].sum() / weights.sum()
            score[rr] = max(score[rr], min(1.0, float(share)))
            n_template[rr] += 1
            more.append((int(rr), label))
    none = n_base == 0
    return {
        "n_words": n_words, "n_base": n_base,
        "first_word": pa.array(low, mask=none), "last_word": pa.array(high, mask=none),
        "base_labels": _labels(base, n), "labels": _labels(base + more, n), "score": score, "n_template": n_template,
    }


def scan_licenses(documents: DataFrame, templates=TEMPLATES, phrases=BASE_PHRASES, rare: int = 8) -> DataFrame:
    """Per row of ``documents``: licence labels, base phrase places and the best template coverage.

    ``rare``: words of highest IDF that each template has in the index.
    ``score`` is the IDF-weighted share of the best verified template that stands at its place, 0 without one.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = _Index(templates, phrases, rare)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(len(index.vocabulary), np.int64), 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in chunks(offsets):
                part, own = fold_case(data[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i]
                starts, ends, first = words(part, own, ALNUM)
                places, numbers = index.known(word_hashes(part, starts, ends))
                row = np.searchsorted(first, places, "right") - 1
                counts += np.bincount(np.unique(row * len(counts) + numbers) % len(counts), minlength=len(counts))
                rows += j - i
        ids = np.append(np.flatnonzero(counts), -1)
        yield pa.RecordBatch.from_pydict({"word": pa.array(ids, pa.int64()), "n": pa.array(np.append(counts[counts > 0], rows), pa.int64())})

    df = {r["word"]: r["n"] for r in texts.select("text").mapInArrow(frequencies, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    index.weigh(df, df.pop(-1, 0))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in chunks(offsets):
                found = _scan_chunk(index, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(i, j - i)} | found)

    return texts.mapInArrow(scan, SCHEMA)
