"""License scans by template-markup matching.

A template is a row of words with ``[...]`` around words that may be missing and
``{a-b}`` for a replaceable region of a to b arbitrary words.  It is compiled into
an automaton over words; a text is accepted where its words run through the
automaton from start to end, so all mandatory wording must be there exactly and
in order.  License texts are whole (conditions and disclaimer), so a relative that lacks,
adds or alters a clause is not accepted; short notices have templates of their own.
Every template has a *key*: two mandatory words that stand together.
Only documents in which a key occurs are run, from the places around it.

Wording that takes back part of the grant (RIDERS) and follows a match at once undoes it: "licensed
under the apache license version 2 0 but with the commons clause" is no Apache-2.0, a phrase in it still counts.

Base labels come from fixed phrases, at every place where their words stand
consecutively.  Both are read from whole texts; words are compared by 64-bit hashes.
score is 1 if a template accepts, else 0.5 if a phrase occurs, else 0.

Null, empty and word-free texts have no words, no places and empty labels.  Rows are
scanned one by one, so null or repeated doc_ids need no rule; an empty table gives no rows.  Very long texts are whole (some hundred
bytes of memory per byte of the longest one).  Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, prepare, table, text_bytes, words

# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Fixed value: the MIT text, which others continue.
MIT_TEXT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this {1-8} and associated documentation files "
    "the {1-3} to deal in the {1-3} without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the {1-3} and to permit persons to whom the {1-3} is furnished to do so subject to the following conditions "
    "the above copyright notice and this permission notice [including the next paragraph] shall be included in all copies or substantial portions of the {1-3} "
    "the {1-3} is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
    "fitness for a particular purpose and noninfringement in no event shall the {1-12} be liable for any claim damages or other liability "
    "whether in an action of contract tort or otherwise arising from out of or in connection with the {1-3} or the use or other dealings in the {1-3}"
)

# Parts of the BSD and ISC texts and of the GNU notices.
BSD_OPEN = (
    "redistribution and use [of this software] in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "[{1-1}] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "[{1-1}] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution "
)
BSD_NAME = (
    "[{1-1}] neither the name of {1-20} nor the names of {1-8} may be used to endorse or promote products derived from this software without specific prior written permission "
)
BSD_END = (
    "this software is provided by {1-20} as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
    "and fitness for a particular purpose are disclaimed in no event shall {1-20} be liable for any direct indirect incidental special exemplary or consequential damages "
    "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability "
    "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
ISC_OPEN = "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted "
ISC_END = (
    "the software is provided as is and {1-20} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
    "in no event shall {1-20} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
    "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"
)
GNU_OPEN = "you can redistribute it and or modify it under the terms of the "
GNU_END = "as published by the free software foundation [either] version {version} of the license [or [at your option] any later version]"

# Wording of license notices and texts.  label -> templates
TEMPLATES = {
    "MIT": [
        "[this {1-6} is] released under the mit license",
        "[this {1-6} is] licensed under the [terms of the] mit license",
        MIT_TEXT,
    ],
    "X11": [
        MIT_TEXT + " except as contained in this notice the name [s] of {1-20} shall not be used in advertising or otherwise to promote the sale use "
        "or other dealings in this {1-3} without prior written authorization",
    ],
    "Apache-2.0": [
        "licensed under the apache license version 2 0 [the license] [you may not use this file except in compliance with the license]",
    ],
    "GPL-3.0": [
        "[this {1-6} is] licensed under the gnu general public license version 3 [or {0-3} later [version]]",
        "{1-6} under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or [at your option] any later version",
    ],
    "CC-BY-NC-4.0": [
        "licensed under cc by nc 4 0",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "BSD-3-Clause": [BSD_OPEN + BSD_NAME + BSD_END],
    "BSD-2-Clause": [BSD_OPEN + BSD_END],
    "ISC": [ISC_OPEN + "provided that the above copyright notice and this permission notice appear in all copies " + ISC_END],
    "0BSD": [ISC_OPEN + ISC_END],
    "Unlicense": [
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software "
        "either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means "
        "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain "
        "we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors "
        "we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the authors be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ],
    "GPL-2.0": [
        "licensed under the gnu general public license [gpl] version 2 [or {0-3} later [version]]",
        GNU_OPEN + "gnu general public license [version 2] " + GNU_END.format(version="2"),
    ],
    "LGPL-2.1": [
        "licensed under the gnu lesser general public license [lgpl] version 2 1 [or {0-3} later [version]]",
        GNU_OPEN + "gnu lesser general public license " + GNU_END.format(version="2 1"),
    ],
    "LGPL-3.0": [
        "licensed under the gnu lesser general public license [lgpl] version 3 [or {0-3} later [version]]",
        GNU_OPEN + "gnu lesser general public license " + GNU_END.format(version="3"),
    ],
    "AGPL-3.0": [
        "licensed under the gnu affero general public license [agpl] version 3 [or {0-3} later [version]]",
        GNU_OPEN + "gnu affero general public license " + GNU_END.format(version="3"),
    ],
    "MPL-2.0": [
        "licensed under the mozilla public license [version] [v] 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 "
        "if a copy of the mpl was not distributed with this file you can obtain one at [http] [https] mozilla org mpl 2 0",
    ],
    "CC-BY-4.0": [
        "licensed under cc by 4 0",
        "licensed under [a] [the] creative commons attribution 4 0 international [public] license",
    ],
    "CC-BY-SA-4.0": [
        "licensed under cc by sa 4 0",
        "licensed under [a] [the] creative commons attribution sharealike 4 0 international [public] license",
    ],
    "Commons-Clause": [
        "without limiting other conditions in the license the grant of rights under the license will not include and the license does not grant to you the right to sell the software",
    ],
}

# Wording right after a match that restricts or alters what was granted.
RIDERS = [
    "but with", "but not", "but excluding", "but without", "but subject", "but only", "except for", "except that",
    "[and] with [the] commons clause", "and [the] commons clause", "plus [the] commons clause",
    "with [the] [following] additional", "with the following {0-2} restriction", "with the following {0-2} restrictions",
    "with [the] {1-3} exception", "with [the] {1-3} exceptions", "subject to [the] [following] additional", "subject to the commons clause",
    "for non commercial", "for noncommercial", "as amended by", "as modified by",
    "[this source code form is] incompatible with secondary licenses",
]


def codes(text: str) -> np.ndarray:
    """Hashes of the words of a text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return words(raw, np.array([0, len(raw)])).code


ANY = None


@dataclass
class Automaton:
    """States 0..n; steps[s] lists (word hash or ANY, next state), skips[s]
    the states reached without a word.  The last state accepts."""
    label: str
    steps: list[list[tuple[int | None, int]]]
    skips: list[list[int]]
    key: int          # hash of the two key words
    before: int       # most words before the key

    def closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.skips[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return out

    def match(self, code: list[int], start: int) -> int | None:
        """End of the longest accepted run of words from ``start``."""
        now, end, i = self.closure({0}), None, start
        while True:
            if len(self.steps) - 1 in now:
                end = i
            if i >= len(code) or not now:
                return end
            now = self.closure({t for s in now for w, t in self.steps[s] if w is ANY or w == code[i]})
            i += 1


def compile_template(label: str, template: str) -> Automaton:
    steps: list[list] = [[]]
    skips: list[list] = [[]]

    def state() -> int:
        steps.append([])
        skips.append([])
        return len(steps) - 1

    def any_word(at: int) -> int:
        to = state()
        steps[at].append((ANY, to))
        return to
    at, depth, most, opened, key, last = 0, 0, 0, [], None, None
    for item in re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", template):
        if item == "[":
            opened.append(at)
            last = None
        elif item == "]":
            skips[opened.pop()].append(at)
            # what follows must not be stepped into from inside an earlier state
            to = state()
            skips[at].append(to)
            at, last = to, None
        elif item[0] == "{":
            low, high = map(int, item[1:-1].split("-"))
            for _ in range(low):
                at = any_word(at)
            ends = [at]
            for _ in range(high - low):
                at = any_word(at)
                ends.append(at)
            to = state()
            for e in ends:
                skips[e].append(to)
            at, most, last = to, most + high, None
        else:
            to = state()
            steps[at].append((int(codes(item)[0]), to))
            if not opened and last is not None and key is None and len(item) + len(last) >= 8:
                key, depth = f"{last} {item}", most - 1
            at, most = to, most + 1
            last = None if opened else item
    return Automaton(label, steps, skips, _pair(codes(key)) if key else 0, depth)  # riders need no key


def _pair(code: np.ndarray) -> int:
    raw = words(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    raw.code, raw.first = code, np.array([0, len(code)])
    return int(raw.grams(len(code))[0][0])


def automata() -> list[Automaton]:
    return [compile_template(k, t) for k, some in TEMPLATES.items() for t in some]


def riders() -> list[Automaton]:
    return [compile_template("rider", t) for t in RIDERS]


def accepted(code: list[int], anchors: dict[int, list[int]], machines: list[Automaton], undo: list[Automaton] = ()) -> list[tuple[str, int, int]]:
    """(label, first word, end word) of the templates accepted around their
    key's places; of one template, those that do not overlap, leftmost first.  A
    match inside a longer one of another label (MIT in X11) is left out, and one that is
    followed by wording of ``undo``."""
    out = []
    for k, m in enumerate(machines):
        done = 0
        for a in anchors.get(k, ()):
            for start in range(max(done, a - m.before), a + 1):
                end = m.match(code, start)
                if end is not None and end > a:
                    if all(u.match(code, end) is None for u in undo):
                        out.append((m.label, start, end))
                    done = end
                    break
    return [x for x in out if not any(y[0] != x[0] and y[1] <= x[1] and x[2] <= y[2] and y[2] - y[1] > x[2] - x[1] for y in out)]


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    matches (label, first word, end word) and score of every row."""
    prepare(documents.sparkSession)

    def run(batches):
        machines, undo = automata(), riders()
        phrases = [(len(p.split()), _pair(codes(p)), label) for p, label in PHRASES.items()]
        keys = np.array([m.key for m in machines], np.uint64)
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            for lo, hi, part, offs in blocks(data, offsets):
                w = words(part, offs)
                n = w.counts
                row = np.repeat(np.arange(hi - lo), n)
                places: dict[int, list[int]] = {}
                base: dict[int, set[str]] = {}
                by_length = {k: w.grams(k) for k in {x[0] for x in phrases}}
                for k, h, label in phrases:
                    gram, at = by_length[k]
                    for i in at[gram == np.uint64(h)]:
                        r = int(row[i])
                        places.setdefault(r, []).append(int(i - w.first[r]))
                        base.setdefault(r, set()).add(label)
                gram, at = w.grams(2)
                anchors: dict[int, dict[int, list[int]]] = {}
                near = np.flatnonzero(np.isin(gram, keys))
                for i in near:
                    r = int(row[at[i]])
                    for k in np.flatnonzero(keys == gram[i]):
                        anchors.setdefault(r, {}).setdefault(int(k), []).append(int(at[i] - w.first[r]))
                more = {r: accepted(w.code[w.first[r]:w.first[r + 1]].tolist(), a, machines, undo) for r, a in anchors.items()}
                rows = range(hi - lo)
                labels = [",".join(sorted(base.get(r, set()) | {m[0] for m in more.get(r, ())})) for r in rows]
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.array([len(places.get(r, ())) for r in rows], pa.int64()),
                    pa.array([min(places[r]) if r in places else None for r in rows], pa.int64()),
                    pa.array([max(places[r]) if r in places else None for r in rows], pa.int64()),
                    pa.array([",".join(sorted(base.get(r, ()))) for r in rows], pa.string()),
                    pa.array(labels, pa.string()),
                    pa.array([[{"label": a, "first": s, "end": e} for a, s, e in more.get(r, ())] for r in rows],
                             pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))),
                    pa.array([1.0 if more.get(r) else 0.5 if r in places else 0.0 for r in rows], pa.float64())],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "matches", "score"])
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "matches array<struct<label: string, first: long, end: long>>, score double")


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("matches")
