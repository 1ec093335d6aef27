"""License scans: phrase places, and an exact set-similarity join with templates.

A block matches a template if it holds at least ``threshold`` of the template's
distinct words and every telling phrase of it (name, variant and version of the
licence, word after word), so a neighbour's version or variant is no match.  All
templates are joined with all blocks; phrases are looked at in what was found,
and blocks without them are listed apart.
Words are ordered by their frequency in the corpus, rarest first.  A block that
reaches the threshold must hold one of a template's rarest words (its prefix),
so only those start candidates; the length filter drops blocks with too few
template words and the positional filter those whose remaining words cannot
suffice.  All candidates left are verified, so no block above the threshold is
missed.

Blocks of long templates are paragraphs (lines between lines without a word).
Blocks of short ones are runs of at most a quarter more words than the template
in one paragraph, across line ends, that begin with a template word and hold
the template's words in its order (by their first places).  A run holds words
of one template only, so its positional filter is the prefix filter itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import bare_words, batches, encode, owners, pick, texts

# fixed values: base phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: parts of Creative Commons and GNU names, identifiers in file headers
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported"}
_GNU = {"gpl": ("General", ("2", "3")), "lgpl": ("Lesser General", ("2.1", "3")), "agpl": ("Affero General", ("3",))}
_SPDX = {"Apache-2.0": "apache-2.0", "BSD-2-Clause": "bsd-2-clause", "BSD-3-Clause": "bsd-3-clause", "MIT": "mit-notice",
         "ISC": "isc", "MPL-2.0": "mpl-2.0", "EPL-2.0": "epl-2.0", "GPL-2.0": "gpl-2.0", "GPL-3.0": "gpl-3.0",
         "LGPL-2.1": "lgpl-2.1", "LGPL-3.0": "lgpl-3.0", "AGPL-3.0": "agpl-3.0", "CC0-1.0": "cc0-1.0",
         "Unlicense": "unlicense"}

# fixed values: usual license notices, (label, notice, telling phrases)
_NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", ["Apache License, Version 2.0"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at", ["Apache License, Version 2.0"]),
    ("bsd", "Released under the BSD License.", ["BSD License"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met", ["Redistribution and use in source and binary forms"]),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission.",
     ["endorse or promote products derived from this software"]),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0.", ["Boost Software License, Version 1.0"]),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work.", ["waived all copyright and related or neighboring rights"]),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0.", ["Eclipse Public License 2.0"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.",
     ["for any purpose with or without fee"]),
    ("mit-notice", "Released under the MIT License.", ["MIT License"]),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                   "associated documentation files, to deal in the Software without restriction, including without "
                   "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense",
     ["deal in the Software without restriction"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     ["Mozilla Public License, v. 2.0"]),
    ("rights-reserved", "All rights reserved.", ["All rights reserved"]),
    ("unlicense", "This is free and unencumbered software released into the public domain.",
     ["free and unencumbered software"]),
]


def _templates() -> list[tuple[str, str, list[str]]]:
    out = list(_NOTICES)
    for code, name in _CC.items():
        for version, scope in _CC_VERSIONS.items():
            label, full = f"cc-{code.lower()}-{version}", f"Creative Commons {name} {version}"
            out += [(label, f"Licensed under CC {code} {version}.", [f"CC {code} {version}"]),
                    (label, f"This work is licensed under a {full} {scope} License.", [full])]
    for code, (name, versions) in _GNU.items():
        for version in versions:
            label, full = f"{code}-{version}" + ("" if "." in version else ".0"), f"GNU {name} Public License"
            out += [(label, f"This work is licensed under the {full}, version {version}.", [f"{full}, version {version}"]),
                    (label, f"This program is free software: you can redistribute it and/or modify it under the terms of the "
                            f"{full} as published by the Free Software Foundation, either version {version} of the License, or "
                            "(at your option) any later version.", [full, f"version {version} of the License"])]
    return out + [(label, f"SPDX-License-Identifier: {name}", [f"Identifier: {name}"]) for name, label in _SPDX.items()]


#: (label, notice, phrases without which the notice is another licence's)
TEMPLATES = _templates()
#: templates of more distinct words than this are sought in paragraphs, others in runs of words
RUN_WORDS = 14

MATCH = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("words", pa.int64()),
                   ("containment", pa.float64())])
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, matches array<struct<label:string,template:int,first_word:bigint,words:bigint,containment:double>>, "
          "near array<struct<label:string,template:int,first_word:bigint,words:bigint,containment:double>>")


def words_of(text: str) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Occurrences of the template words over all rows of ``docs`` (text)."""
    wanted = pa.array(vocabulary, pa.string())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches(rows, text=0):
            words, _ = bare_words(texts(batch.column(0)))
            codes = pc.drop_null(pc.index_in(words, wanted)).to_numpy(zero_copy_only=False)
            total += np.bincount(codes, minlength=len(wanted))
        yield pa.RecordBatch.from_arrays([wanted, pa.array(total)], ["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


class Templates:
    """Templates as rank sets in global frequency order, with their prefixes."""

    def __init__(self, templates: list[tuple[str, str, list[str]]], counts: dict[str, int], threshold: float):
        self.labels = [label for label, _, _ in templates]
        own = [words_of(notice) for _, notice, _ in templates]
        signs = [[words_of(s) for s in phrases] for _, _, phrases in templates]
        self.words = sorted({w for ws in own + [s for ss in signs for s in ss] for w in ws}, key=lambda w: (counts.get(w, 0), w))
        rank = {w: k for k, w in enumerate(self.words)}
        self.sets = [np.array(sorted({rank[w] for w in ws}), np.int64) for ws in own]
        self.order = [{rank[w]: k for k, w in enumerate(dict.fromkeys(ws))} for ws in own]
        self.signs = [[np.array([rank[w] for w in s], np.int64) for s in ss if s] for ss in signs]
        self.need = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in self.sets]
        self.reach = [reach(len(ws)) for ws in own]
        self.wide = np.array([len(s) > RUN_WORDS for s in self.sets], bool)

    def telling(self, at: np.ndarray, rank: np.ndarray) -> dict[int, list[np.ndarray]]:
        """Template -> where each of its telling phrases begins (as places in ``at``),
        for the templates whose phrases all occur (for what the join has found)."""
        order = np.argsort(rank, kind="stable")
        ends = np.searchsorted(rank[order], np.arange(len(self.words) + 1))
        known: dict[tuple, np.ndarray] = {}

        def starts(sign: np.ndarray) -> np.ndarray:
            rarest = int(sign.argmin())
            begin = order[ends[sign[rarest]]:ends[sign[rarest] + 1]] - rarest
            begin = begin[(begin >= 0) & (begin + len(sign) <= len(rank))]
            for k, r in enumerate(sign.tolist()):
                begin = begin[rank[begin + k] == r]
            return begin[at[begin + len(sign) - 1] - at[begin] == len(sign) - 1]

        out = {}
        for t, signs in enumerate(self.signs):
            for s in signs:
                if tuple(s) not in known:
                    known[tuple(s)] = starts(s)
            places = [known[tuple(s)] for s in signs]
            if all(map(len, places)):
                out[t] = places
        return out

    def join(self, block: np.ndarray, rank: np.ndarray, n_blocks: int,
             telling: dict[int, list[np.ndarray]]) -> list[tuple[int, int, float, bool]]:
        """(block, template, containment, told) of every pair of a block and a long template
        at the threshold; told: all telling phrases stand in the block.

        ``block`` and ``rank`` list the template words of the blocks.
        """
        told = {t: [np.unique(block[s[block[s] == block[s + len(w) - 1]]]) for s, w in zip(places, self.signs[t])]
                for t, places in telling.items() if self.wide[t]}
        size = max(len(self.words), 1)
        pairs = np.unique(block * size + rank)
        block, rank = pairs // size, pairs % size
        ends = np.searchsorted(block, np.arange(n_blocks + 1))
        held = np.diff(ends)[block]
        out = []
        for t in np.flatnonzero(self.wide).tolist():
            need, ranks = self.need[t], self.sets[t]
            place = np.full(size, -1)
            place[ranks] = np.arange(len(ranks))
            i = place[rank]
            # length; prefix: words come rarest first, so a block shares none before its first word of the prefix
            k = np.flatnonzero((i >= 0) & (i <= len(ranks) - need) & (held >= need))
            k = k[np.unique(block[k], return_index=True)[1]]
            k = k[np.minimum(len(ranks) - i[k], ends[block[k] + 1] - k) >= need]        # position
            some = np.zeros(n_blocks, bool)
            some[block[k]] = True
            shared = np.bincount(block[(i >= 0) & some[block]], minlength=n_blocks)
            for b in np.flatnonzero(shared >= need).tolist():
                signs = t in told and all(j < len(s) and s[j] == b for s in told[t] for j in [np.searchsorted(s, b)])
                out.append((b, t, int(shared[b]) / len(ranks), signs))
        return sorted(out)

    def runs(self, at: np.ndarray, rank: np.ndarray, paragraph: np.ndarray,
             telling: dict[int, list[np.ndarray]]) -> list[tuple[int, int, int, float, bool]]:
        """(first word, end, template, containment, told) of the runs at the threshold of short
        templates; told: all telling phrases stand in the run.

        ``at`` lists the places of the template words.  A run goes on to its last
        template word; one inside another holds no more words than that and is part of it.
        """
        out = []
        for t in np.flatnonzero(~self.wide).tolist():
            need, ranks, order = self.need[t], self.sets[t], self.order[t]
            own = np.flatnonzero(np.isin(rank, ranks))
            place, r, part = at[own], rank[own], paragraph[own]
            end = np.minimum(np.searchsorted(place, place + self.reach[t]), np.searchsorted(part, part, side="right"))
            rare = np.concatenate([[0], np.cumsum(np.isin(r, ranks[:len(ranks) - need + 1]))])
            some = (end - np.arange(len(own)) >= need) & (rare[end] > rare[:-1])     # length, prefix
            whole = np.full(len(own), 0 if t in telling else len(own) + 1)  # where the first of each telling phrase has ended
            for s, w in zip(telling.get(t, []), self.signs[t]):
                first = np.searchsorted(at[s], place)
                stop = np.append(np.searchsorted(place, at[s] + len(w)), len(own) + 1)     # the last: no phrase follows
                whole = np.maximum(whole, stop[first])
            beyond, near, found = 0, 0, []              # ends of the runs found so far
            for a in np.flatnonzero(some).tolist():
                seen: set[int] = set()
                newest, last, stop = -1, a, int(end[a])
                for k in range(a, stop):
                    x = int(r[k])
                    if x in seen:
                        continue
                    if order[x] < newest:               # out of the template's order: no longer run either
                        stop = k
                        break
                    seen.add(x)
                    newest, last = order[x], k
                if len(seen) >= need and whole[a] <= stop:
                    last = max(last, int(whole[a]) - 1)
                    if int(place[last]) >= beyond:
                        beyond = int(place[last]) + 1
                        out.append((int(place[a]), beyond, t, len(seen) / len(ranks), True))
                elif len(seen) >= need and int(place[last]) >= max(near, beyond):
                    near = int(place[last]) + 1
                    found.append((int(place[a]), near, t, len(seen) / len(ranks), False))
            told = np.array([x[:2] for x in out if x[2] == t] or [(0, 0)])      # both ends grow
            for x in found:
                k = np.searchsorted(told[:, 0], x[0], side="right") - 1
                if k < 0 or told[k, 1] < x[1]:
                    out.append(x)
        return sorted(out)


def reach(words: int) -> int:
    """Words of the longest run that a short template of so many words is sought in."""
    return words + words // 4


def _lines(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    lists = pc.split_pattern(text, "\n")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
         templates: list[tuple[str, str, list[str]]] = TEMPLATES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, matches, near.

    n_base counts the places of all base phrases; labels adds those of the
    templates found.  score is 1 for a phrase or a whole template, else the best
    containment found, else 0.  matches lists every block found: label,
    template number, first word and number of words of the block, containment.
    A block is a paragraph (lines between those without a word) for templates
    of more than 14 distinct words, however long it is, and a run of words of one
    paragraph for others; runs that overlap are listed each, unless one lies inside
    another.  A template's telling phrases (made of its own words; it may have
    none) must stand in the block word after word; ``near`` lists the blocks at
    the threshold without them, which get no label and no score.  Null and empty texts
    have no words and no labels; repeated rows are scanned each; an empty table
    gives no rows.
    """
    own = pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string")
    vocabulary = sorted({w for _, t, signs in templates for x in (t, *signs) for w in words_of(x)})
    held = docs.sparkSession.sparkContext.broadcast(Templates(templates, word_counts(own, vocabulary), threshold))
    phrases = {tuple(p.split()): label for p, label in PHRASES.items()}

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        ranks = pa.array(known.words, pa.string())
        for batch in batches(rows, text=1):
            lines, line_of_doc = _lines(texts(batch.column(1)))
            words, line_ends = bare_words(lines)
            codes, distinct = encode(words)
            doc_ends = line_ends[line_of_doc]
            own_doc = owners(doc_ends)
            n = batch.num_rows
            n_base = np.zeros(n, np.int64)
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base: list[set] = [set() for _ in range(n)]
            at_code = {w: k for k, w in enumerate(distinct.to_pylist()) if w in {x for p in phrases for x in p}}
            for phrase, label in phrases.items():
                if any(w not in at_code for w in phrase) or len(codes) < len(phrase):
                    continue
                size = len(codes) - len(phrase) + 1
                hit = own_doc[:size] == own_doc[len(phrase) - 1:]
                for k, w in enumerate(phrase):
                    hit &= codes[k:k + size] == at_code[w]
                places = np.flatnonzero(hit)
                where = own_doc[places]
                np.add.at(n_base, where, 1)
                np.minimum.at(first, where, places - doc_ends[where])
                np.maximum.at(last, where, places - doc_ends[where])
                for d in np.unique(where).tolist():
                    base[d].add(label)
            found = pc.index_in(distinct, ranks).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = found[codes] if len(codes) else np.zeros(0, np.int64)
            some = np.flatnonzero(rank >= 0)
            line = owners(line_ends)
            blank = np.diff(line_ends) == 0
            fresh = np.zeros(len(lines), bool)
            fresh[line_of_doc[:-1][np.diff(line_of_doc) > 0]] = True
            fresh[1:] |= blank[:-1]
            paragraph = np.cumsum(fresh) - 1 if len(lines) else np.zeros(0, np.int64)
            starts = line_ends[:-1][fresh]
            ends = np.append(starts[1:], line_ends[-1])[:len(starts)]
            part = paragraph[line] if len(line) else line
            telling = known.telling(some, rank[some])
            found_ = [(int(starts[b]), int(ends[b]), t, share, told)
                      for b, t, share, told in known.join(part[some], rank[some], len(starts), telling)]
            matches: list[list] = [[] for _ in range(n)]
            near: list[list] = [[] for _ in range(n)]
            for a, z, t, share, told in found_ + known.runs(some, rank[some], part[some], telling):
                d = int(own_doc[a])
                (matches if told else near)[d].append({
                    "label": known.labels[t], "template": t, "first_word": a - int(doc_ends[d]), "words": z - a, "containment": share})
            some_base = n_base > 0
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), pa.array(np.diff(doc_ends)), pa.array(n_base),
                pa.array(first, mask=~some_base), pa.array(last.astype(np.int64), mask=~some_base),
                pa.array([",".join(sorted(b)) for b in base], pa.string()),
                pa.array([",".join(sorted(b | {m["label"] for m in own_})) for b, own_ in zip(base, matches)], pa.string()),
                pa.array([1.0 if b else max((m["containment"] for m in own_), default=0.0) for b, own_ in zip(base, matches)],
                         pa.float64()),
                pa.array(matches, pa.list_(MATCH)), pa.array(near, pa.list_(MATCH))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches", "near"])

    return own.mapInArrow(run, SCHEMA)


def license_sql(threshold: float = 0.8) -> str:
    """The digest columns in DuckDB SQL: every block, each run of words too, against every template."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = lambda c: f"regexp_extract_all(translate({c}, '{upper}', '{lower}'), '{pattern}')"
    listed = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    phrases = ", ".join(f"({listed(p.split())}, '{label}')" for p, label in PHRASES.items())
    own = [(label, words_of(t), [words_of(x) for x in signs]) for label, t, signs in TEMPLATES]
    notices = ", ".join(
        f"({k}, '{label}', {listed(dict.fromkeys(ws))}, {reach(len(ws))}, {listed(' ' + ' '.join(x) + ' ' for x in signs)})"
        for k, (label, ws, signs) in enumerate(own))
    share = "len(list_intersect(n.w, {0})) / CAST(len(n.w) AS DOUBLE) AS share"
    told = "len([x FOR x IN n.signs IF NOT contains(' ' || array_to_string({0}, ' ') || ' ', x)]) = 0"
    return f"""
WITH phrases(p, label) AS (VALUES {phrases}),
notices(k, label, w, reach, signs) AS (VALUES {notices}),
docs AS (SELECT doc_id, coalesce(text, '') AS text, {words("coalesce(text, '')")} AS w FROM documents),
places AS (
  SELECT doc_id, label, unnest([i FOR i IN range(len(w)) IF w[i + 1:i + len(p)] = p]) AS place FROM docs, phrases),
base AS (
  SELECT doc_id, COUNT(*) AS n_base, MIN(place) AS first_word, MAX(place) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
worded AS (SELECT doc_id, pos, {words("line")} AS w FROM lines),
marked AS (SELECT *, SUM(CASE WHEN len(w) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM worded),
blocks AS (
  SELECT doc_id, g, flatten(list(w ORDER BY pos)) AS w FROM marked WHERE len(w) > 0 GROUP BY doc_id, g),
told AS (SELECT b.doc_id, b.w AS block, n.* FROM blocks b JOIN notices n ON {told.format("b.w")}),
starts AS (
  SELECT *, unnest([i FOR i IN range(len(block)) IF list_contains(w, block[i + 1])]) AS i FROM told WHERE len(w) <= {RUN_WORDS}),
runs AS (SELECT *, unnest(range(1, least(reach, len(block) - i) + 1)) AS size FROM starts),
tried AS (SELECT doc_id, k, label, w, signs, block[i + 1:i + size] AS run FROM runs),
found AS (
  SELECT doc_id, list(DISTINCT label) AS labels, MAX(share) AS share FROM (
    SELECT doc_id, label, {share.format("block")} FROM told n WHERE len(w) > {RUN_WORDS}
    UNION ALL
    SELECT doc_id, label, {share.format("run")} FROM tried n
    WHERE {told.format("run")} AND [list_position(run, x) FOR x IN w IF list_contains(run, x)]
          = list_sort([list_position(run, x) FOR x IN w IF list_contains(run, x)]))
  WHERE share >= {threshold} - 1e-9 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(b.n_base, 0) AS BIGINT) AS n_base,
       CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
       array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0 ELSE coalesce(f.share, 0.0) END AS score
FROM docs d LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)"""
