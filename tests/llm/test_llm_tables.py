"""The operators on small tables with odd rows, against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from turnout.llm import decontaminate, embeddings, jaccard, langid, licenses, mixing, pii, substrings, tokens, warc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _d long, size string"


def split(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def corpus():
    """Prose of two made-up languages, copies, near copies, a benchmark and odd rows."""
    rng = random.Random(11)
    sound = {"aa": ["ka", "to", "mi", "ra", "shu", "ne"], "bb": ["gro", "lup", "whe", "zin", "ftal", "xo"]}

    def prose(lang, n):
        return " ".join("".join(rng.choice(sound[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    items = [(i, prose("aa", 16)) for i in range(4)] + [(4, "rare shortitem"), (5, None), (6, ""), (None, prose("bb", 12)), (7, items_text := prose("bb", 14)), (8, items_text)]
    docs = []
    for i in range(60):
        lang = "aa" if i % 3 else "bb"
        docs.append([i, prose(lang, rng.randint(60, 150)), lang, f"s{i % 4}", 1])
    for i, j in ((60, 3), (61, 3), (62, 5)):
        docs.append([i, docs[j][1], docs[j][2], "s9", 1])
    for i, j in ((63, 3), (64, 7), (65, 64), (66, 10)):  # near copies, and a near copy of one
        w = docs[j][1].split()
        w[len(w) // 2] = f"changed{i}"
        docs.append([i, " ".join(w), docs[j][2], None, 1])
    docs[20][1] += " " + items[0][1]
    docs[21][1] = "X " + items[1][1].upper() + ". " + docs[21][1]
    docs[22][1] += " rare, shortitem " + items_text
    docs[23][1] += " write a.b@c.example.org or +1 (555) 123-4567, 10.0.0.1 and 4111 1111 1111 1111. tel 089 7654321 please"
    docs[24][1] += "\nReleased under the MIT License.\nApache License, Version 2.0; cc by nc"
    passage = prose("aa", 60)
    docs[25][1] = docs[25][1] + " " + passage + " " + prose("aa", 20)
    docs[26][1] = prose("aa", 15) + " " + passage + " " + docs[26][1]
    odd = [[70, None, "aa", "s1", None], [71, "", None, None, 0], [72, "12 34 !!", "aa", None, 8], [None, prose("aa", 50), "aa", "s1", 5], [None, None, None, None, None],
           [1, docs[1][1], "aa", "s1", 1], [1, docs[1][1], "aa", "s1", 1], [73, "word", "aa", "", 4], [74, "word", "aa", "", 4],
           [75, "long" * 30000, "bb", "s2", 120000], [76, prose("bb", 9000), "bb", "s2", 1], [77, "日本語 テキスト", "zz", "s2", 8], [-5, "tiny text here", None, "s1", 1]]
    rows = [(*r, 7, "x") for r in docs + odd]
    return rows, items


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus[0], DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text):
    w = split(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    """doc_id -> (class, links) by comparing all rows."""
    named = [(r[0], shingle_set(r[1])) for r in rows if r[0] is not None]
    links = [(i, j) for i, j in itertools.combinations(range(len(named)), 2)
             if named[i][1] and named[j][1] and len(named[i][1] & named[j][1]) >= 0.8 * len(named[i][1] | named[j][1])]
    low = [x for x, _ in named]
    for _ in named:
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
    n = [0] * len(named)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    return sorted((named[k][0], low[k], n[k]) for k in range(len(named)))


def test_jaccard_join(docs, corpus):
    found = jaccard.join(docs).collect()
    assert len(found) == len(corpus[0])
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found if r.doc_id is not None) == brute_classes(corpus[0])
    assert all((r.class_id, r.n_links) == (None, 0) for r in found if r.doc_id is None)


def test_jaccard_blocks_of_a_large_bucket(spark, monkeypatch):
    """A group of near copies larger than a block."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(w), None, None, None))
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found) == brute_classes(rows)


def test_jaccard_members_of_a_group_travel_without_pairs():
    """A group of n near copies leaves the pruning as n rows, not as its pairs."""
    n = 50
    sig = np.tile(np.arange(jaccard.HASHES, dtype=np.uint32), (n, 1))
    sig[np.arange(n), 64 + np.arange(n)] = 999
    task = pa.RecordBatch.from_pydict({"key": [7] * n, "bi": [0] * n, "bj": [0] * n, "band": [0] * n, "side": [0] * n, "rep": list(range(n)),
                                       "text_id": [-i for i in range(n)], "sig": [x.tobytes() for x in sig]})
    assert len(jaccard._survivors(pa.Table.from_batches([task]))[0]) == n * (n - 1) // 2
    out = pa.Table.from_batches(jaccard._prune([task.slice(0, 20), task.slice(20)]))
    assert out.column("rep").to_pylist() == list(range(n)) and out.column("text_id").to_pylist() == [-i for i in range(n)]
    assert not any(pa.types.is_list(f.type) for f in out.schema)


def test_jaccard_versions_of_a_document(spark):
    """A doc_id with two texts links with the near copies of both."""
    rng = random.Random(11)
    one, two, other = ([f"w{rng.randrange(10**6)}" for _ in range(100)] for _ in range(3))
    rows = [(1, one), (1, two), (2, [*one, "x"]), (3, [*two, "y"]), (4, other)]
    found = jaccard.join(spark.createDataFrame([(i, " ".join(w), None, None, None) for i, w in rows], "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links > 0) for r in found) == [(1, 1, True), (1, 1, True), (2, 1, True), (3, 1, True), (4, 4, False)]


def brute_hits(text, items):
    w, hit, ids = split(text), set(), set()
    for item, other in items:
        v = split(other)
        n = min(10, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                ids.add(item)
    return len(w), len(hit), sorted(str(x) for x in ids if x is not None)


def test_decontamination(spark, docs, corpus):
    items = spark.createDataFrame(corpus[1], "item_id long, text string")
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in decontaminate.scan(docs, items).collect())
    assert found == sorted((str(r[0]), *brute_hits(r[1], corpus[1])) for r in corpus[0])
    assert sum(x[2] > 0 for x in found) == 3
    nothing = decontaminate.scan(docs, spark.createDataFrame([], "item_id long, text string")).where("n_hit > 0")
    assert nothing.count() == 0


def test_token_counts(docs, corpus):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public.path(tokens.VOCABULARY))
    wanted = []
    for r in corpus[0]:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        wanted.append((str(r[0]), len((r[1] or "").encode()), n, n > 512))
    assert sorted((str(r.doc_id), *r[1:]) for r in tokens.counts(docs).collect()) == sorted(wanted)


def test_pii(docs, corpus):
    found = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in pii.scan(docs).collect())
    wanted = []
    for r in corpus[0]:
        base = pii.base_spans(r[1] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        more = pii.field_spans(pii.field(), [r[1] or ""], [base])[0]
        wanted.append((str(r[0]), *[sum(k == x[0] for x in base) for k in pii.KINDS], hashlib.sha256(joined.encode()).hexdigest(), pii._joined(base + more)))
        assert set(joined.split(",")) <= set(wanted[-1][-1].split(","))
    assert found == sorted(wanted)
    row = next(x for x in found if x[0] == "23")
    assert row[1:5] == (1, 1, 1, 1) and row[6].count("phone:") == 2  # the field adds the number without a plus


def test_licenses(docs, corpus):
    found = {(str(r.doc_id), r.n_words): r for r in licenses.scan(docs).collect()}
    for r in corpus[0]:
        w, places, labels = split(r[1]), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        f = found[str(r[0]), len(w)]
        assert (f.n_base, f.first_word, f.last_word, f.base_labels) == (len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(f.labels.split(",")) | set() and 0 <= f.score <= 1
    assert found["24", len(split(corpus[0][24][1]))].labels == "MIT,apache-2,cc-by-nc,mit"


def test_language_models(docs, corpus):
    model = langid.fit(docs)
    assert model.names == ["aa", "bb", "zz"] or model.names == ["aa", "bb"]
    found = langid.identify(docs, model).collect()
    assert len(found) == len(corpus[0])
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    for i in (70, 71, 72):
        assert (by[i].lang_pred, by[i].score, by[i].accepted) == ("und", 0.0, False)
    own = [(r[2], by[r[0]].lang_pred) for r in corpus[0][:60] if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert own and all(a == b for a, b in own)
    assert all(0 <= r.score <= 1 for r in found)
    # every context's distribution sums to one
    a = model.languages[0]
    letters = sorted({ord(c) for r in corpus[0][:60] if r[2] == "aa" for c in r[1].lower() if c.isalpha()} | {32})
    columns = [np.full(len(letters), ord(c)) for c in "k a"] + [np.array(letters)]
    assert abs(np.exp(a.logs(columns)).sum() - 1) < 0.02


def test_language_models_without_labels(spark, empty):
    assert langid.fit(empty).names == []
    some = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.identify(some, langid.fit(some)).collect()] == ["und"]


def test_substring_repeats(docs, corpus):
    found = substrings.repeats(docs).collect()
    text = {r[0]: (r[1] or "").encode() for r in corpus[0]}
    pairs = {(r.doc_id, r.first_doc_id) for r in found}
    assert {(26, 25), (60, 3), (61, 3), (62, 5), (63, 3)} <= pairs
    near = {3, 5, 7, 10, 60, 61, 62, 63, 64, 65, 66}
    planted = {20, 21, 22} | near | {25, 26} | {73, 74}  # the last two: whole texts of one word
    assert {x for p in pairs for x in p} <= planted
    for r in found:
        part = text[r.doc_id][r.start:r.end]
        assert len(part) == r.end - r.start and (part == text[r.doc_id] or len(part) >= substrings.LEAST_BYTES) and part.decode()
    clean = {r.doc_id: r.text for r in substrings.deduplicate(docs.where("doc_id IN (25, 26, 30)")).collect()}
    assert clean[25].encode() == text[25] and clean[30].encode() == text[30] and len(clean[26].encode()) < len(text[26]) - 100


def test_mixing(spark, docs, corpus):
    rows = mixing.mix(docs, ["doc_id", "source"]).collect()
    assert len(rows) == len(corpus[0])
    size = {}
    for r in corpus[0]:
        size[r[3]] = size.get(r[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    order = sorted(x for x in size if x is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full = dict.fromkeys(order, 0.0), set()
    while True:  # fill, reshare the excess
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * size[s] if s in full else rest * weight[s] / share for s in order}
        over = {s for s in order if target[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    for s in order:
        own = [r for r in rows if r.source == s]
        assert all(r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 3 * mixing.BLOCK
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mixing.mix(docs.repartition(3), ["doc_id", "source"]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_archives(spark, tmp_path):
    big = "x" * 1500
    rows = [(1, "http://a/1", big, 0), (2, "http://a/2", big, 0), (3, None, big, 0), (4, "u", None, 0), (5, "u", "", 0), (6, "u\r\nv", "small", 0), (7, "u", "small", 0),
            (None, "u", big, 0), (8, "u", "é" * 700, 0), (9, "u", "é" * 700, 0), (10, "u", "long" * 100000, 0), (3, None, big, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    warc.write_archives(pages.repartition(3), f"{tmp_path}/w")
    back = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert len(back) == len(rows)
    for r in back:
        html = next((h or "").encode() for i, _, h, _ in rows if i == r.page_id)
        assert r.payload_bytes == len(html) and r.payload_digest == hashlib.sha1(html).hexdigest()
        revisit = {1: 3, 2: 3, None: 3, 8: 9}.get(r.page_id)
        assert (r.record_type, r.refers_to) == (("revisit", revisit) if revisit else ("response", None))
        assert r.payload == (None if revisit else html)
    warc.write_archives(pages.limit(0), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize("held,shares", [(256 << 20, 3), (1, 3), (256 << 20, 0)])  # some intervals, each block one, one for all
def test_embeddings(spark, monkeypatch, held, shares):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(5, 16))
    v = [(i, (centre[i % 5] + rng.normal(size=16) * rng.choice([0.05, 0.4, 1.0])).tolist()) for i in range(150)]
    v += [(200 + i, v[3][1]) for i in range(20)] + [(300, [2 * x for x in v[3][1]])]
    odd = [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [None] * 16), (404, [1.0, 2.0]), (405, [2.0, 4.0]), (406, []), (None, v[3][1]), (407, [float("inf")] + [1.0] * 15)]
    monkeypatch.setattr(embeddings, "HELD_BYTES", held)
    monkeypatch.setattr(embeddings, "SHARES", shares)
    rows = v + odd
    found = embeddings.join(spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, size string")).collect()
    assert len(found) == len(rows)
    real = [(i, np.array(x)) for i, x in rows if i is not None and x and all(a is not None and np.isfinite(a) for a in x) and any(x)]
    links = {i: set() for i, _ in rows}
    for (i, a), (j, b) in itertools.combinations(real, 2):
        if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.9:
            links[i].add(j)
            links[j].add(i)

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(seen)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (len(links[r.vec_id]), reach(r.vec_id), reach(r.vec_id) == r.vec_id)


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for out in (jaccard.join(empty), decontaminate.scan(empty, items), tokens.counts(empty), pii.scan(empty), licenses.scan(empty), substrings.repeats(empty),
                mixing.mix(empty, ["doc_id", "source"]), embeddings.join(vectors)):
        assert out.count() == 0


def test_pipeline(spark, corpus, tmp_path):
    docs = spark.createDataFrame(corpus[0], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(corpus[1], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows, now = corpus[0], spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = now.columns
    key = lambda rs: sorted(str(tuple(r)) for r in rs)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        got = [tuple(r) for r in now.collect()]
        if name == "language_id":
            # rejected: no letter, or like neither language (prose of both is kept)
            assert now.columns == columns and {r[0] for r in rows} - {r[0] for r in got} <= {70, 71, 72, 73, 74, 75, 77, -5} and {r[0] for r in got} >= set(range(70)) - {67, 68, 69}
        elif name == "ngram_jaccard_join":
            low = {i: c for i, c, _ in brute_classes(rows)}
            wanted = [r for r in {x for x in rows if x[0] is not None} if low[r[0]] == r[0]] + [r for r in rows if r[0] is None]
            assert now.columns == columns and key(got) == key(wanted)
        elif name == "benchmark_decontamination":
            assert now.columns == columns and key(got) == key(r for r in rows if not brute_hits(r[1], corpus[1])[1])
        elif name == "pii":
            wanted = []
            for r in rows:
                base = pii.base_spans(r[1] or "")
                more = pii.field_spans(pii.field(), [r[1] or ""], [base])[0]
                text = r[1] and pii.redact(r[1], base + more)
                wanted.append((r[0], text, r[2], r[3], r[4] if text is None else len(text), *r[5:]))
            assert now.columns == columns and key(got) == key(wanted)
            assert "<email>" in next(r[1] for r in got if r[0] == 23)
        else:
            # the size column of the documents makes way for the mix's
            assert now.columns == [c for c in columns if c != "size"] + ["size", "source_size", "target", "taken"]
            assert {r[0] for r in got} <= {r[0] for r in rows} and all(0 < r[-1] <= 3 * r[-4] for r in got)
        rows = got
    assert key(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == key(rows)


def test_substring_repeats_inside_a_document(spark):
    """A passage that stands twice in one document, and in a document of the same id."""
    rng = random.Random(21)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n))
    passage, other = prose(60), prose(60)
    twice = f"{prose(30)} {passage} {prose(30)} {passage} {prose(30)}"
    rows = [(1, twice), (1, twice), (2, f"{prose(20)} {other} {prose(20)}"), (2, f"{other} {prose(25)}"), (3, prose(80))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeats(docs).collect()
    own = [r for r in found if r.doc_id == 1]
    assert len(own) == 1 and own[0].first_doc_id == 1 and own[0].n_inside == own[0].n_chunks
    again = twice.rindex(passage)
    assert again <= own[0].start and own[0].end <= again + len(passage) and own[0].end - own[0].start > len(passage) / 2
    across = [r for r in found if r.doc_id == 2]
    assert len(across) == 1 and (across[0].first_doc_id, across[0].n_inside) == (2, 0)
    assert {r.doc_id for r in found} == {1, 2} and {r.doc_id for r in substrings.repeats(docs, within=False).collect()} == set()
    clean = sorted((r.doc_id, r.text) for r in substrings.deduplicate(docs).collect())
    assert all(t.startswith(twice[:again]) and len(t) < len(twice) - len(passage) / 2 for i, t in clean if i == 1)
    assert (3, rows[4][1]) in clean


def test_an_unlearnt_language_is_rejected(spark):
    """Languages of the same letters, one not learnt, one too rare to calibrate, and odd texts among the labelled."""
    rng = random.Random(31)
    words = {x: ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 8))) for _ in range(150)] for x in ("aa", "bb", "cc", "dd")}
    prose = lambda x, n: " ".join(rng.choice(words[x]) for _ in range(n))
    rows = [(i, prose("aa" if i % 2 else "bb", rng.randint(20, 200)), "aa" if i % 2 else "bb") for i in range(300)]
    rows += [(300 + i, "".join(rng.choice("0123456789abcdef") for _ in range(60)), "aa" if i % 2 else "bb") for i in range(16)]  # odd
    rows += [(400 + i, prose("cc", 60), "bb") for i in range(6)]  # mislabelled
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    share = lambda x, n: np.mean(model.predict([prose(x, n) for _ in range(100)])[3])
    assert all(share(x, n) > 0.95 for x in ("aa", "bb") for n in (20, 150))
    assert share("dd", 60) < 0.05 and share("dd", 150) < 0.05
    # a language without calibrating texts has the limit of all together
    frame = pd.DataFrame({"lang": "aa", "entropy": [1.0, 1.1, 1.2, 6.0], "n": 500, "other": "bb", "foreign": 3.0})
    model.calibrate(frame)
    k = model.names.index("bb")
    assert np.isfinite(model.limits(np.array([k]), np.array([500]))).all() and model.limits(np.array([k]), np.array([500]))[0] < 3.0


def brute_repeats(rows, least):
    """Chunks by the plain definition (every window and neighbourhood by itself), every
    repeat of a chunk at any but its first place, neighbours joined."""
    from turnout.llm.substrings import RADIUS, WINDOW, gear
    places, texts = {}, {}
    for doc, text in rows:
        if doc is None or not text:
            continue
        raw = text.encode()
        key = (doc, text)
        if key in texts:  # a repeated row: one document, but its places count
            for a, b in texts[key]:
                places[raw[a:b]].append((doc, a, text))
            continue
        h = [int(gear(np.frombuffer(raw[i - WINDOW + 1:i + 1], np.uint8))[-1]) if i >= WINDOW - 1 else 0 for i in range(len(raw))]
        ends = [i + 1 for i in range(RADIUS + WINDOW - 1, len(raw) - RADIUS)
                if h[i] > max(h[i - RADIUS:i]) and h[i] >= max(h[i + 1:i + RADIUS + 1]) and raw[i + 1] & 0xC0 != 0x80]
        texts[key] = list(zip([0, *ends], [*ends, len(raw)]))
        for a, b in texts[key]:
            places.setdefault(raw[a:b], []).append((doc, a, text))
    out = []
    several = {d for d, _ in texts if sum(x == d for x, _ in texts) > 1}
    assert not several  # the order of texts of one id is by a hash
    for (doc, text), chunks in texts.items():
        raw, span = text.encode(), None
        for a, b in [*chunks, (-1, -1)]:
            group = sorted(places.get(raw[a:b], [])) if a >= 0 else []
            if len(group) > 1 and group[0][:2] != (doc, a):
                if span and span[1] == a:
                    span = [span[0], b, span[2] + 1, span[3], min(span[4], len(group)), span[5] + (group[0][0] == doc)]
                    continue
                if span and (span[1] - span[0] >= least or span[:2] == [0, len(raw)]):
                    out.append((doc, *span))
                span = [a, b, 1, group[0][0], len(group), int(group[0][0] == doc)]
            else:
                if span and (span[1] - span[0] >= least or span[:2] == [0, len(raw)]):
                    out.append((doc, *span))
                span = None
    return sorted(out)


def test_substring_repeats_like_brute_force(spark):
    rng = random.Random(4)
    def word(k): return "".join(rng.choice("abcdefghij") for _ in range(k))
    def prose(n, k): return " ".join(word(k) for _ in range(n))
    shared = [prose(40, 3), prose(51, 2), prose(30, 6) + " äöü 日本語 " + prose(5, 4)]
    rows = [(i, prose(rng.randint(5, 60), 4) + " " + rng.choice(shared) + " " + prose(rng.randint(5, 40), 5)) for i in range(25)]
    rows += [(30, rows[2][1]), (31, "tiny"), (32, "tiny"), (33, "x" * 300), (34, "x" * 300), (35, shared[0] + " " + prose(20, 5) + " " + shared[0]), (36, None), (37, ""), (None, shared[0]), (30, rows[2][1]),
             (38, "forty-six bytes of text that two documents are"), (39, "forty-six bytes of text that two documents are")]
    found = substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = sorted((r.doc_id, r.start, r.end, r.n_chunks, r.first_doc_id, r.n_places, r.n_inside) for r in found)
    assert got == brute_repeats(rows, substrings.LEAST_BYTES) and len(got) > 20
    assert {32, 34, 39} <= {g[0] for g in got}


def test_passages_of_short_words_are_found(spark):
    """51 words of two letters, shared by two documents each."""
    rng = random.Random(6)
    def prose(n, k): return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k)) for _ in range(n))
    rows = []
    for i in range(200):
        p = prose(51, 2)
        rows += [(2 * i, f"{prose(rng.randrange(20, 60), 4)} {p} {prose(30, 4)}"), (2 * i + 1, f"{prose(rng.randrange(20, 60), 5)} {p} {prose(30, 5)}")]
    found = {r.doc_id for r in substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not {d for d in found if d % 2 == 0} and len(found) >= 0.98 * 200


def test_a_language_with_few_labels_is_learnt(spark):
    """Its one labelled text falls in the part that is set aside."""
    def texts(letters, n):
        rng = random.Random(n)
        return [" ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(60)) for _ in range(n)]
    part = spark.range(1000).selectExpr("id", "crc32(cast(cast(id AS string) AS binary)) % 4 = 2 AS held", "pmod(xxhash64(id, 23), 4) AS part").collect()
    late = next(r.id for r in part if not r.held and r.part == 0)
    ids = [r.id for r in part if not r.held and r.id != late][:40]
    rows = [(i, t, "en") for i, t in zip(ids, texts("abcdef", 40))] + [(late, texts("uvwxyz", 1)[0], "pl"), (5000, texts("uvwxyz", 2)[1], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert sorted(model.names) == ["en", "pl"]
    assert {r.doc_id: r.lang_pred for r in langid.identify(df, model).collect()}[5000] == "pl"


def test_pipeline_of_an_empty_table(spark, empty, tmp_path):
    empty.drop("_d", "size").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
