"""Small tests of the helpers that need no Spark."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnout.llm import bitmap, jaccard, licenses, mixing, pii, substrings, tokens, warc
from turnout.llm.common import text_bytes, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é.\n日Z", max_size=30), max_size=6))
def test_words_follow_the_pattern(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    w = words(data, np.cumsum([0, *map(len, raw)]))
    expected = [x for t in texts for x in WORD.findall(lower(t))]
    found = [data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
    assert [lower(x) for x in found] == expected
    assert w.counts.tolist() == [len(WORD.findall(lower(t))) for t in texts]
    assert len(set(w.code.tolist())) == len(set(expected))
    grams, at = w.grams(2)
    assert len(grams) == sum(max(0, n - 1) for n in w.counts)


def test_posterior_table_is_sound():
    assert jaccard.posterior(0, 16) < 1e-6 < jaccard.posterior(16, 16)
    # a pair of exactly 0.8 is dropped at any step with small probability only
    from math import comb
    for n, least in jaccard.LEAST.items():
        assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(least)) < 1e-5


def test_overlaps_dense_and_sparse_agree():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, 30).astype(np.uint64)) for _ in range(12)]
    a, c = np.triu_indices(12, 1)
    assert jaccard._overlaps(sets, a, c).tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, c)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.1, 100), min_size=1, max_size=8), st.integers(0, 60), st.integers(1, 40))
def test_highest_quotients_like_one_by_one(votes, seats, most):
    got = mixing.highest_quotients(np.array(votes), seats, np.full(len(votes), most))
    slow = np.zeros(len(votes), int)
    for _ in range(min(seats, most * len(votes))):
        q = [v / (2 * s + 1) if s < most else -1 for v, s in zip(votes, slow)]
        slow[int(np.argmax(q))] += 1
    assert got.tolist() == slow.tolist()


def test_token_counts_are_the_librarys():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public.path(tokens.VOCABULARY))
    counter = tokens.Counter()
    rng = random.Random(3)
    texts = ["", "<|endoftext|>", " <|endoftext|> a<|endoftext|>", " " * 3000, "a" * 5000, "　 x " * 200, "we're 123 4567 !!?? d'll\n\n  c\t\t",
             "\U0001F600" * 700, "日本語 テキスト" * 300, *("".join(rng.choice("ab \n\t'<|endoftext>1.é") for _ in range(3000)) for _ in range(20))]
    for t in texts:
        n = len(library.encode(t, add_special_tokens=False).ids)
        for chunk, overlap in ((1 << 16, 1 << 10), (64, 16), (300, 20), (1000, 100)):
            assert counter.count(t.encode(), chunk, overlap) == n


# ------------------------------------------------------------------ personal data

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    def holds(kind, x):
        digits = re.sub("[^0-9]", "", x)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in x.split(".")), "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
    return [(k, *m.span()) for k, p in PATTERNS for m in re.finditer(p, text) if holds(k, m[0])]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1@.@-+ ()2_%4é,", max_size=40))
def test_base_spans_like_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_the_field_learns_its_table_and_generalises():
    f = pii.field()
    rows = pii.labelled()
    best = f.viterbi(f.ids([s for s, _ in rows]))
    right = [all(pii.LABELS[best[r, k]] == x for k, x in enumerate(labels)) for r, (_, labels) in enumerate(rows)]
    assert np.mean(right) > 0.95
    unseen = {"mail bob at example dot org now": ["bob at example dot org"], "tel 089 7654321 bitte": ["089 7654321"], "card 4111.1111.1111.1111 was": ["4111.1111.1111.1111"],
              "on 2021-01-02 at 11:45 we met": [], "licensed under the apache license, version 2.0.": [], "row 1 2 3 4 5 6 7 8": []}
    for text, wanted in unseen.items():
        found = pii.field_spans(f, [text], [pii.base_spans(text)])[0]
        assert [text[a:b] for _, a, b in found] == wanted


def added(text):
    return [(k, text[a:b]) for k, a, b in pii.field_spans(pii.field(), [text], [pii.base_spans(text)])[0]]


@pytest.mark.parametrize("text, found", [("anna (at) example.org", "anna (at) example.org"), ("jan at firma.de", "jan at firma.de"), ("max [at] web.de", "max [at] web.de")])
def test_spelt_out_addresses_without_digits(text, found):
    assert added(text) == [("email", found)]
    assert added(f"write to {text} soon, or not") == [("email", found)]


def held_out_sentences():
    """Sentences of other words, names and numbers than the labelled table, and their spans."""
    rng = random.Random(3)
    names, hosts, ends = ["olga", "b.stein", "ravi.k", "team", "sven"], ["north", "posten", "blue"], ["org", "com", "net", "de", "fr"]
    rows = []
    for _ in range(40):
        n, h, e = rng.choice(names), rng.choice(hosts), rng.choice(ends)
        rows.append(("kindly write to {} about it", rng.choice([f"{n} at {h} dot {e}", f"{n} (at) {h}.{e}", f"{n} at {h}.{e}", f"{n} [at] {h}.{e}", f"{n} (at) {h} (dot) {e}"]), "email"))
        a, b, c = rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        rows.append((rng.choice(["please call {} tonight", "tel: {} is mine", "phone {} for tickets"]), rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"0{a} {b}{c}", f"{a}.{b}.{c}"]), "phone"))
        p = [rng.randrange(1, 255) for _ in range(4)]
        rows.append((rng.choice(["the host {} answered", "from ip {} yesterday"]), " . ".join(map(str, p)) if rng.random() < 0.5 else "-".join(map(str, p)), "ip"))
        d = [rng.randrange(10) for _ in range(15)]
        check = next(x for x in range(10) if pii.luhn("".join(map(str, [4, *d[1:], x]))))
        text = "".join(map(str, [4, *d[1:], check]))
        rows.append((rng.choice(["card {} was charged", "visa {} is valid"]), rng.choice("./").join(text[i:i + 4] for i in range(0, 16, 4)), "card"))
    plain = ["we left at {0} and came back at {1}", "the score at half time was {0}-{1}", "see page {0}, line {1} of the book", "at first. then at {0} percent", "paid {0}.{1} euros at the desk",
             "version {0}.{1}.{0} is out", "in 19{0} and 19{1} it rained", "look at example.org or at home"]
    return rows, [rng.choice(plain).format(rng.randrange(10, 99), rng.randrange(10, 99)) for _ in range(160)]


def test_added_spans_on_held_out_sentences():
    """Recall and precision of what the field adds (base spans left aside)."""
    rows, clean = held_out_sentences()
    right = wrong = wanted = 0
    for frame, data, kind in rows:
        text = frame.format(data)
        if any(text[a:b] == data for _, a, b in pii.base_spans(text)):
            continue
        wanted += 1
        got = added(text)
        right += (kind, data) in got
        wrong += len([g for g in got if g != (kind, data)])
    wrong += sum(len(added(text)) for text in clean)
    print("recall", right / wanted, "precision", right / max(right + wrong, 1), wanted)
    assert wanted > 120 and right / wanted >= 0.9 and right / (right + wrong) >= 0.95


def test_long_texts_are_decoded_throughout(monkeypatch):
    """What a sentence holds is found wherever it stands, at block borders too."""
    filler = "we went home and it was late so nobody said a word about it "
    for n in (0, 5, 14, 15, 16, 17, 40, 500):
        text = filler * n + "call (555) 123-4567 or write to anna (at) example.org now " + filler * 30
        assert added(text) == [("phone", "(555) 123-4567"), ("email", "anna (at) example.org")]


def test_viterbi_is_the_best_path():
    f = pii.field()
    ids = f.ids([["w", "d3", "-", "d4"], ["w:call", "d3"]])
    best = f.viterbi(ids)
    e = f.emissions(ids)
    import itertools

    def score(r, path):
        if not f.starts[path[0]] or not all(f.allowed[a, b] for a, b in zip(path, path[1:])):
            return -np.inf
        return f.first[path[0]] + sum(e[r, t, k] for t, k in enumerate(path)) + sum(f.step[a, b] for a, b in zip(path, path[1:]))
    for r, n in ((0, 4), (1, 2)):
        top = max(itertools.product(range(len(pii.LABELS)), repeat=n), key=lambda p: score(r, p))
        assert tuple(best[r, :n]) == top


def test_redact_merges_overlaps():
    assert pii.redact("x 1.2.3.4 y", [("ip", 2, 9), ("card", 4, 11)]) == "x <ip>"
    assert pii.redact("abc", []) == "abc"


# ------------------------------------------------------------------ licenses

@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
    ("Released under the MIT License.", {"MIT"}), ("released under my mit license", set()),
    ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}), ("Licensed under CC BY 4.0.", {"CC-BY-4.0"}), ("Licensed under CC BY-ND 4.0.", set()),
    ("Licensed under the Apache License, Version 2.0 (the License);", {"Apache-2.0"}),
    ("Licensed under the Apache License, Version 1.0", set()),
    ("This small library is licensed under the terms of the MIT license", {"MIT"}),
    ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
    ("Licensed under the Creative Commons Attribution 4.0 International Public License", {"CC-BY-4.0"}),
    ("Licensed under the GNU Lesser General Public License, version 2.1 or any later version", {"LGPL-2.1"}),
    ("Licensed under the GNU Lesser General Public License (LGPL) version 3", {"LGPL-3.0"}),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
     "Foundation; either version 2 of the License, or (at your option) any later version.", {"GPL-2.0"}),
    ("it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or any later version", {"GPL-3.0"}),
    ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License.", {"AGPL-3.0"}),
    ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 2 of the License.", set()),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/.", {"MPL-2.0"}),
    ("Licensed under the Mozilla Public License 1.1", set()),
])
def test_templates(text, labels):
    code = licenses.codes(text).tolist()
    machines = licenses.automata()
    # every place is an anchor: the plain run of all automata
    found = licenses.accepted(code, {k: list(range(len(code))) for k in range(len(machines))}, machines)
    assert {m[0] for m in found} == labels


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0, but with the Commons Clause", set()),
    ("Licensed under the Apache License, Version 2.0 (the \"License\") with Commons Clause", set()),
    ("Licensed under the Apache License, Version 2.0. You may read it, but not today", {"Apache-2.0"}),
    ("Released under the MIT License for non-commercial use only", set()),
    ("Released under the MIT License, except that nobody may sell it", set()),
    ("licensed under the GNU General Public License version 2 with the Classpath exception", set()),
    ("Released under the MIT license with love", {"MIT"}),
    ("Released under the MIT license, but not for you. Docs are licensed under CC BY 4.0.", {"CC-BY-4.0"}),
    ("Released under the MIT license but not here. Elsewhere released under the MIT license.", {"MIT"}),
    ("If a copy: this Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/. This Source Code Form is \"Incompatible With Secondary Licenses\", as defined", set()),
])
def test_restricted_notices_are_not_the_license(text, labels):
    code = licenses.codes(text).tolist()
    machines = licenses.automata()
    found = licenses.accepted(code, {k: list(range(len(code))) for k in range(len(machines))}, machines, licenses.riders())
    assert {m[0] for m in found} == labels


def test_every_template_has_a_telling_key():
    """Only documents with a key are run, so each needs one of its own that is in its wording."""
    for label, some in licenses.TEMPLATES.items():
        for t in some:
            m = licenses.compile_template(label, t)
            assert m.key, t
            plain = re.sub(r"\[|\]", " ", re.sub(r"\{(\d+)-\d+\}", lambda x: "filler " * int(x[1]), t))
            code = licenses.codes(plain)
            w = licenses.words(np.frombuffer(plain.encode(), np.uint8), np.array([0, len(plain.encode())]))
            grams, at = w.grams(2)
            places = at[grams == np.uint64(m.key)].tolist()
            assert places and licenses.accepted(code.tolist(), {0: places}, [m]), t


def test_automaton_optional_and_replaceable():
    m = licenses.compile_template("x", "[one two] alphabet gammaray {0-2} delta")
    run = lambda t: m.match(licenses.codes(t).tolist(), 0)
    assert run("one two alphabet gammaray delta") == 5 and run("alphabet gammaray q q delta") == 5
    assert run("one alphabet gammaray delta") is None and run("alphabet gammaray q q q delta") is None


# ------------------------------------------------------------------ chunks

def chunks_of(text):
    raw = text.encode()
    ends = substrings.boundaries(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])) if raw else []
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def test_chunks_cover_texts_and_resist_insertions():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefghijé") for _ in range(rng.randint(1, 9))) for _ in range(800))
    own = chunks_of(text)
    assert b"".join(own) == text.encode() and all(c.decode() for c in own)
    moved = chunks_of(text[:2000] + "inserted words " + text[2000:])
    assert len(set(own) - set(moved)) <= 6
    assert chunks_of("") == [] and chunks_of("short") == [b"short"] and chunks_of("a" * 500) == [b"a" * 500]


def test_chunks_do_not_depend_on_the_block():
    texts = ["".join(random.Random(i).choice("abcdef ") for _ in range(600)) for i in range(5)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    ends = substrings.boundaries(np.frombuffer(b"".join(raw), np.uint8), offsets)
    alone = [o + e for r, o in zip(raw, offsets) for e in substrings.boundaries(np.frombuffer(r, np.uint8), np.array([0, len(r)]))]
    assert ends.tolist() == [int(x) for x in alone]


# ------------------------------------------------------------------ archives

def test_archive_round_trip_and_damage():
    payloads = [b"", b"x", b"\n" * 5000, bytes(range(256)) * 50, "é日".encode() * 2000] * 20
    import hashlib
    made = [warc.record(i, f"http://e/{i}\r\nX: y", p, hashlib.sha1(p).hexdigest(), len(p), None) for i, p in enumerate(payloads)]
    data = b"".join(f + warc.FILL + b"\n" for f in warc.frames(iter(made)))
    back = list(warc.records(data))
    assert [p for _, p in back] == payloads and [warc._id(f["WARC-Record-ID"]) for f, _ in back] == list(range(len(payloads)))
    import zstandard
    assert len(list(warc.split(data))) == 2 * (len(payloads) + 1)  # dictionary, records, and a fill after each
    for bad in (data[:-20], data[:5000] + b"zz" + data[5002:], data[8:], data + b"\x00" * 9):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.records(bad))
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n")
    assert list(warc.frames(iter([]))) == [] and list(warc.records(b"")) == []
    one = b"".join(warc.frames(iter([warc.record(None, None, b"p", hashlib.sha1(b"p").hexdigest(), 1, None)])))
    assert [(warc._id(f["WARC-Record-ID"]), p) for f, p in warc.records(one)] == [(None, b"p")]


def test_bitmap_passes_what_it_holds():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**63, 1000).astype(np.uint64)
    bits = np.zeros(1 << 10, np.uint64)
    for p in bitmap.probes(h, 16):
        np.bitwise_or.at(bits, (p >> np.uint64(6)).astype(int), np.uint64(1) << (p & np.uint64(63)))
    assert len(bitmap.passes(bits, 16, h)) == 1000
    assert len(bitmap.passes(bits, 16, rng.integers(0, 2**63, 1000).astype(np.uint64))) < 50


# ------------------------------------------------------------------ whole license texts

GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
         "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
         "Software, and to permit persons to whom the Software is furnished to do so")
NOTICE = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
NO_WARRANTY = (" THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
               "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
               "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
X_NAME = (" Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this "
          "Software without prior written authorization from the X Consortium.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of "
       "source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
       "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
ADVERTISING = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software. "
NAME = ("{}. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission. ")
BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES "
           "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
           "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
           "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
           "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
             "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or "
             "authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and "
             "to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
             "software under copyright law." + NO_WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS"))
COMMONS = ("Without limiting other conditions in the License, the grant of rights under the License will not include, and the License does not grant to you, the right to Sell the "
           "Software.")
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
ISC_END = (". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
           "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
           "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")


@pytest.mark.parametrize("text, labels", [
    (GRANT + NOTICE + NO_WARRANTY, {"MIT"}), (GRANT + NO_WARRANTY, set()), (GRANT + NOTICE, set()),
    (GRANT + NOTICE + " The Software shall be used for Good, not Evil." + NO_WARRANTY, set()), (GRANT + NOTICE + NO_WARRANTY + X_NAME, {"X11"}),
    (BSD + NAME.format(3) + BSD_END, {"BSD-3-Clause"}), (BSD + BSD_END, {"BSD-2-Clause"}), (BSD + ADVERTISING + NAME.format(4) + BSD_END, set()),
    (ISC + ISC_NOTICE + ISC_END, {"ISC"}), (ISC + ISC_END, {"0BSD"}), (ISC.replace("and/or", "and") + ISC_NOTICE + ISC_END, {"ISC"}),
    (UNLICENSE, {"Unlicense"}), (UNLICENSE.replace("We intend", "We hope"), set()), (COMMONS, {"Commons-Clause"}),
], ids=["MIT", "MIT-0", "MIT without disclaimer", "JSON", "X11", "BSD-3", "BSD-2", "BSD-4", "ISC", "0BSD", "ISC with and", "Unlicense", "Unlicense altered", "Commons Clause"])
def test_license_texts_and_their_relatives(text, labels):
    code = licenses.codes("Copyright 2020 A. " + text + " More words.").tolist()
    machines = licenses.automata()
    found = licenses.accepted(code, {k: list(range(len(code))) for k in range(len(machines))}, machines)
    assert {m[0] for m in found} == labels


def test_winnowing_keeps_few_grams_and_every_shared_span():
    """Of two texts that share ten words both keep one gram inside them; the kept
    grams are some 2 in 7."""
    from turnout.llm import decontaminate
    rng = random.Random(8)
    every = kept = 0
    for _ in range(200):
        span = [f"s{rng.randrange(50)}" for _ in range(10)]
        texts = [[f"w{rng.randrange(50)}" for _ in range(rng.randrange(30))] + span + [f"w{rng.randrange(50)}" for _ in range(rng.randrange(30))] for _ in "ab"]
        found = []
        for t in texts:
            data, offsets = text_bytes(pa.array([" ".join(t)]))
            w = words(data, offsets)
            mark, at, around = decontaminate.fingerprints(w, 10)
            every, kept = every + len(t) - 4, kept + len(at)
            found.append({(int(m), int(x)) for m, row in zip(mark, around) for x in row if x})
        whole = words(*text_bytes(pa.array([" ".join(span)]))).grams(10)[0][0]
        assert any(x == int(whole) for _, x in found[0] & found[1])
    assert kept < 0.45 * every


def test_winnowing_of_equal_grams():
    """Ties keep the rightmost; windows outside the text are 0."""
    from turnout.llm import decontaminate
    data, offsets = text_bytes(pa.array(["a " * 12, "b"]))
    mark, at, around = decontaminate.fingerprints(words(data, offsets), 10)
    assert at.tolist() == [5, 6, 7] and len(set(mark.tolist())) == 1
    assert [[int(x != 0) for x in row] for row in around] == [[1, 1, 1, 0, 0, 0], [1, 1, 0, 0, 0, 0], [1, 0, 0, 0, 0, 0]]
