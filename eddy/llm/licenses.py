"""Licence scans: a generalised suffix automaton over licence tokens.

The automaton holds every substring of the template texts and of the base
phrases.  A document is streamed through it word by word: the state after a
word gives the longest run of words ending there that occurs in some template
(matching statistics).  Base phrases are read off the suffix links of the same
states.  Maximal matches of ``MIN_RUN`` words or more are chained, template by
template, where both the document and the template positions increase with
small gaps; a chain's covered share of the template is its score.
"""

from __future__ import annotations

from bisect import bisect
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eddy.llm.common import ALNUM, byte_texts

MIN_RUN = 5        # words of a match that counts
MAX_GAP = 12       # words skipped between chained matches
MIN_COVER = 0.5    # covered share of a template that gives its label

# Phrase -> label.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Opening or notice texts of public licences, by label.
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                     "in compliance with the License. You may obtain a copy of the License at",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                "that the following conditions are met",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split()


class Automaton:
    """Generalised suffix automaton over word numbers."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.vocab: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]  # (template, position after the last word)
        self.labels = list(templates)
        self.lengths = []
        self.phrases = []
        for k, text in enumerate(templates.values()):
            self.lengths.append(len(self._add(words(text.encode()), k)))
        for text, label in phrases.items():
            self.phrases.append((len(self._add(words(text.encode()), None)), label))
        self.shortest = min([MIN_RUN, *(n for n, _ in self.phrases)])   # shorter runs hold nothing that counts
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True)
        for s in order:  # positions of a state hold those of all states below it
            if self.link[s] >= 0:
                self.ends[self.link[s]] |= self.ends[s]
        own: dict[int, list[int]] = {}
        for i, text in enumerate(phrases):
            s = 0
            for w in words(text.encode()):
                s = self.step[s][self.vocab[w]]
            own.setdefault(s, []).append(i)
        self.out: list[tuple[int, ...]] = [()] * len(self.size)
        for s in reversed(order):  # phrases that are suffixes of a state
            self.out[s] = tuple(own.get(s, ())) + (self.out[self.link[s]] if self.link[s] > 0 else ())

    def _add(self, tokens: list[bytes], template: int | None) -> list[bytes]:
        last = 0
        for pos, w in enumerate(tokens, 1):
            last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
            if template is not None:
                self.ends[last].add((template, pos))
        return tokens

    def _extend(self, last: int, c: int) -> int:
        if (q := self.step[last].get(c)) is not None:
            return q if self.size[q] == self.size[last] + 1 else self._clone(last, c, q)
        cur = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[cur] = q if self.size[q] == self.size[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._state(self.size[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = new
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = new
            p = self.link[p]
        return new

    def _state(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.ends.append(set())
        return len(self.size) - 1

    def scan(self, tokens: list[bytes]):
        """(base places, matches) of a document: places are (start, phrase);
        matches are (start, length, state) of runs that can't be extended."""
        get, step, link, size, out = self.vocab.get, self.step, self.link, self.size, self.out
        ids = [get(t, -1) for t in tokens]
        known = np.fromiter(ids, dtype=np.int32, count=len(ids)) >= 0
        at = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        places, matches = [], []
        for a, b in zip(at[::2].tolist(), at[1::2].tolist()):
            if b - a < self.shortest:
                continue
            s = n = 0
            for i in range(a, b):
                c = ids[i]
                if c not in step[s]:
                    if n >= MIN_RUN:
                        matches.append((i - n, n, s))
                    while s and c not in step[s]:
                        s = link[s]
                    n = size[s]
                s = step[s][c]
                n += 1
                for p in out[s]:
                    if self.phrases[p][0] <= n:
                        places.append((i + 1 - self.phrases[p][0], p))
            if n >= MIN_RUN:
                matches.append((b - n, n, s))
        return places, matches

    def chains(self, matches) -> list[tuple[str, int, int, float]]:
        """(label, first word, one past the last word, covered share) of each
        template's chains that don't overlap, best first: all that cover at least
        ``MIN_COVER``, or the best one if none does."""
        found = sorted((t, a, end - n, n) for a, n, s in matches for t, end in self.ends[s])
        spans = []
        for t, group in groupby(found, key=lambda x: x[0]):
            ends: list[tuple[int, int, int]] = []        # covered, first word, one past the last
            tails: list[tuple[int, int, int, int]] = []  # doc end, template end, covered, first word
            for _, a, b, n in group:
                tails = [x for x in tails if a - x[0] <= MAX_GAP]
                covered, first = n, a
                for d, e, c, f in tails:
                    over = max(0, d - a, e - b)
                    if over < n and abs((a - d) - (b - e)) <= MAX_GAP and b + n > e and c + n - over > covered:
                        covered, first = c + n - over, f
                tails.append((a + n, b + n, covered, first))
                ends.append((covered, first, a + n))
            ends.sort(key=lambda x: (-x[0], x[1], x[2]))
            taken: list[tuple[int, int]] = []            # disjoint, by first word
            for covered, first, end in ends:
                if taken and covered < MIN_COVER * self.lengths[t]:
                    break
                at = bisect(taken, (first, end))
                if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < end):
                    continue
                taken.insert(at, (first, end))
                spans.append((self.labels[t], first, end, min(1.0, covered / self.lengths[t])))
        return spans


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=None, templates=None) -> DataFrame:
    """One row a document: doc_id, n_words, n_base (places of base phrases),
    first_word and last_word (smallest and largest start; null without one),
    base_labels, labels (base ones and those of templates covered by at least
    ``MIN_COVER``), score (1 with a base place, else the best covered share) and
    spans (label, start, end, cover).

    Spans of one template are disjoint; a licence that stands in a text twice
    gives two.  Null and empty texts have no words, no label and score 0.  Ids may be null
    or repeated; an empty table gives no rows.
    """
    frame = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]))

    def row(auto: Automaton, text: bytes):
        tokens = words(text)
        places, matches = auto.scan(tokens)
        spans = auto.chains(matches) if matches else []
        starts = [x[0] for x in places]
        base = {auto.phrases[p][1] for _, p in places}
        more = {x[0] for x in spans if x[3] >= MIN_COVER}
        return (len(tokens), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | more)), 1.0 if places else max((x[3] for x in spans), default=0.0),
                [dict(zip(("label", "start", "end", "cover"), x)) for x in spans])

    def run(batches):
        auto = Automaton(phrases, templates)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [row(auto, t) for t in byte_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    return frame.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
                                 "base_labels string, labels string, score double, "
                                 "spans array<struct<label:string,start:long,end:long,cover:double>>")
