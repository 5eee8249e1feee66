"""Licence scan with a positional rare-token index.

Postings give, for the highest-IDF word of each template's key phrases (IDF over
the whole corpus), the template, the phrase and the word's position in it. Each
rare word that a file has is looked up; where the phrases around it stand word for
word, every alignment (template, start) that covers the place with the fewest is
counted: the template's words in place vote for it. Alignments on which enough
words agree are verified: all mandatory key phrases must stand within, and the
IDF-weighted share of template words in place is the score. An alignment without
its key phrases has no label, so none is missed, however many notices a file holds.

Defined results: null or empty text has no words, no label and score 0; repeated
rows are scanned row by row; extra columns are ignored; an empty table gives an
empty result; long texts are read whole, block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flight_engine.llm import text as tx

# Phrases and labels of the base rules.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Label, notice, mandatory key phrases. Notices are passages of
# the public licence texts and of their usual short forms.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "deal in the software without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license", "2 0"]),
    ("apache-2", "http www apache org licenses license 2 0", ["apache org licenses license 2 0"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ["gnu general public license", "version 3"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2",
     ["gnu general public license", "version 2"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation",
     ["gnu general public license", "free software foundation"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
             "lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     ["gnu affero general public license"]),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission",
     ["endorse or promote products", "prior written permission"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["source and binary forms", "conditions are met"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["with or without fee is hereby granted"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]

#: Alignments' least votes, least score of a label.
MIN_VOTES, MIN_SCORE = 2, 0.6
#: Alignments counted at a time.
BLOCK_STARTS = 1 << 14

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType())])

_WORDS = sorted({w for _, t, _ in TEMPLATES for w in t.split()} | {w for p, _ in BASE for w in p.split()})
_HASHES = np.array([tx.hash_of(w) for w in _WORDS], dtype=np.uint64)
_ORDER = np.argsort(_HASHES)
_SORTED = _HASHES[_ORDER]
_ID = {w: i for i, w in enumerate(_WORDS)}


def word_ids(hashes: np.ndarray) -> np.ndarray:
    """Number of each licence word, -1 for other words."""
    at = np.minimum(np.searchsorted(_SORTED, hashes), len(_SORTED) - 1)
    return np.where(_SORTED[at] == hashes, _ORDER[at], -1)


def _ids(phrase: str) -> list[int]:
    return [_ID[w] for w in phrase.split()]


def _found(ids: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Starts of a phrase in a sequence of word numbers."""
    m = len(ids) - len(phrase) + 1
    if m <= 0:
        return np.empty(0, np.int64)
    ok = ids[:m] == phrase[0]
    for j, w in enumerate(phrase[1:], 1):
        ok &= ids[j:m + j] == w
    return np.flatnonzero(ok)


@F.arrow_udf(T.ArrayType(T.StringType()))
def licence_words(texts: pa.Array) -> pa.Array:
    """The distinct licence words of each text."""
    out = []
    for _, data, offsets in tx.text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
        h, _, _, edges = tx.word_hashes(data, offsets, tx.ALNUM_WORD)
        ids = word_ids(h)
        row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        seen = np.unique(row[ids >= 0] * len(_WORDS) + ids[ids >= 0])
        cut = np.searchsorted(seen, np.arange(len(edges)) * len(_WORDS))
        out += [[_WORDS[x] for x in seen[a:b] % len(_WORDS)] for a, b in zip(cut[:-1], cut[1:])]
    return pa.array(out, pa.list_(pa.string()))


def word_idf(docs: DataFrame) -> dict[str, float]:
    """IDF of the licence words over all documents (one number per template word)."""
    n, *rows = (docs.select(F.explode(F.concat(F.array(F.lit("")), licence_words("text"))).alias("w"))
                .groupBy("w").agg(F.count(F.lit(1)).alias("df")).orderBy("w").collect()) or [None]
    total = n.df if n else 0
    df = {r.w: r.df for r in rows}
    return {w: math.log((1 + total) / (1 + df.get(w, 0))) + 1 for w in _WORDS}


class Index:
    """Template postings by word, with the corpus's IDF."""

    def __init__(self, idf: dict[str, float]):
        self.idf = np.array([idf[w] for w in _WORDS])
        self.templates = [(label, np.array(_ids(t)), [_ids(p) for p in keys]) for label, t, keys in TEMPLATES]
        #: Rarest word of a key phrase -> (template, phrase, position of the word).
        self.postings: dict[int, list[tuple[int, int, int]]] = {}
        for t, (_, _, phrases) in enumerate(self.templates):
            for j, phrase in enumerate(phrases):
                q = max(range(len(phrase)), key=lambda i: self.idf[phrase[i]])
                self.postings.setdefault(phrase[q], []).append((t, j, q))
        #: A file without any of these cannot hold any template's key phrases.
        self.needed = np.array(sorted(self.postings))

    def _phrases(self, ids: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Starts of each key phrase (template, phrase) that stands in a file."""
        out = {}
        at = np.flatnonzero(np.isin(ids, self.needed))
        for w in np.unique(ids[at]):
            p = at[ids[at] == w]
            for t, j, q in self.postings[int(w)]:
                phrase = self.templates[t][2][j]
                start = p - q
                start = start[(start >= 0) & (start + len(phrase) <= len(ids))]
                for i, x in enumerate(phrase):
                    start = start[ids[start + i] == x]
                if len(start):
                    out[t, j] = start
        return out

    def labels(self, ids: np.ndarray) -> dict[str, float]:
        """Verified labels of a file's word numbers, with their scores."""
        found = self._phrases(ids)
        out: dict[str, float] = {}
        for t, (label, words, phrases) in enumerate(self.templates):
            places = [found.get((t, j)) for j in range(len(phrases))]
            if any(p is None for p in places):
                continue
            anchor = min(range(len(phrases)), key=lambda j: len(places[j]))
            slack = np.arange(len(words) - len(phrases[anchor]) + 1)
            for lo in range(0, len(places[anchor]), BLOCK_STARTS // len(slack) + 1):
                part = places[anchor][lo:lo + BLOCK_STARTS // len(slack) + 1]
                start = np.unique(part[:, None] - slack)
                for p, phrase in zip(places, phrases):
                    # the first place at or after the start has to end within the template's length
                    first = p[np.minimum(np.searchsorted(p, start), len(p) - 1)]
                    start = start[(first >= start) & (first + len(phrase) <= start + len(words))]
                spot = start[:, None] + np.arange(len(words))
                inside = (spot >= 0) & (spot < len(ids))
                right = inside & (ids[np.clip(spot, 0, len(ids) - 1)] == words)
                missed = np.where(right, 0.0, self.idf[words]).sum(axis=1)
                score = (1 - missed / self.idf[words].sum())[right.sum(axis=1) >= MIN_VOTES]
                if len(score) and score.max() >= MIN_SCORE:
                    out[label] = max(out.get(label, 0.0), float(score.max()))
        return out


def scan_block(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[dict]:
    h, _, _, edges = tx.word_hashes(data, offsets, tx.ALNUM_WORD)
    ids, n = word_ids(h), len(edges) - 1
    row = np.repeat(np.arange(n), np.diff(edges))
    out = [{"n_words": int(edges[i + 1] - edges[i]), "n_base": 0, "first_word": None, "last_word": None,
            "base_labels": set(), "labels": set(), "score": 0.0} for i in range(n)]
    for phrase, label in BASE:
        p = _ids(phrase)
        for s in _found(ids, p):
            i = row[s]
            if row[s + len(p) - 1] == i:
                o, k = out[i], int(s - edges[i])
                o["n_base"] += 1
                o["first_word"] = k if o["first_word"] is None else min(k, o["first_word"])
                o["last_word"] = k if o["last_word"] is None else max(k, o["last_word"])
                o["base_labels"].add(label)
                o["score"] = 1.0
    for i in np.unique(row[np.isin(ids, index.needed)]):
        found = index.labels(ids[edges[i]:edges[i + 1]])
        out[i]["labels"] = set(found)
        out[i]["score"] = max([out[i]["score"], *found.values()])
    for o in out:
        o["labels"] = ",".join(sorted(o["labels"] | o["base_labels"]))
        o["base_labels"] = ",".join(sorted(o["base_labels"]))
    return out


def scan_licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base places and labels, all labels and the best score of each document."""
    index = Index(word_idf(docs))

    @F.arrow_udf(RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        rows = [o for _, d, f in tx.text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))
                for o in scan_block(index, d, f)]
        return pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                                         ("last_word", pa.int64()), ("base_labels", pa.string()),
                                         ("labels", pa.string()), ("score", pa.float64())]))

    return docs.select("doc_id", scan(F.col("text")).alias("r")).select("doc_id", "r.*")
