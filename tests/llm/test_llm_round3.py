"""Centroid clustering, log-bilinear scoring and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from turnout.llm import centroids, logbilinear, prefixtrie
from turnout.llm.common import text_bytes

import pyarrow as pa

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, distance double, raw string"


def integers(v):
    return [int(np.floor(1024 * float(np.float32(x)))) for x in v]


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, integers(v)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    digest = {n: hashlib.sha256(f"3:{i}".encode()).hexdigest() for n, (i, _) in enumerate(kept)}
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, digest[n], kept[n][1]))
    cs = [kept[n][1] for n in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs)) for _, v in kept]
    for _ in range(rounds):
        best = assign()
        for j in range(len(cs)):
            mine = [kept[n][1] for n, (_, b) in enumerate(best) if b == j]
            if mine:
                cs[j] = [sum(x) // len(mine) for x in zip(*mine)]
    best = assign()
    per = defaultdict(int)
    for d, j in best:
        per[j] += d
    return [(i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, best)]


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (5, 64))
    x = (middles[rng.integers(0, 5, n)] + rng.normal(0, 0.4, (n, 64))).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(n + i, rows[3][1]) for i in range(40)] + [(7, rows[7][1]), (None, rows[9][1]), (n + 50, [0.0] * 64)]  # copies, a repeated id, ties
    rows += [(n + 60, None), (n + 61, []), (n + 62, [1.0] * 63), (n + 63, [float("nan")] * 64), (n + 64, [float("inf")] + [0.0] * 63), (n + 65, [None] + [0.0] * 63)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5, "y") for i, v in rows], VECTORS).repartition(4)


def registered(spark, tmp_path, name, query, frame_):
    frame_.write.parquet(str(tmp_path / f"{name}.parquet"))
    return query(spark, str(tmp_path))


def test_clusters_like_brute_force(spark, tmp_path):
    rows = vectors(160, 3)
    found = registered(spark, tmp_path, "embeddings", centroids.query, frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute_clusters(rows)))


@pytest.mark.parametrize("rows", [[], [(1, None)], vectors(10, 1)[:3], [(i, [0.25] * 64) for i in range(20)]])
def test_clusters_of_few_vectors(spark, tmp_path, rows):
    found = registered(spark, tmp_path, "embeddings", centroids.query, spark.createDataFrame([(i, v, 1, "x", 0.5, "y") for i, v in rows], VECTORS)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute_clusters(rows)))


def test_very_large_components_are_held(spark):
    found, cs = centroids.cluster(frame(spark, [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]))
    assert {r.vec_id: r.distance for r in found.collect()} == {1: 0, 2: 0, 3: 0}
    assert max(map(max, cs)) == 1 << 27 and min(map(min, cs)) == -(1 << 27)


def test_filter_bounds_and_skips():
    """No bound exceeds the exact distance, and far centroids are not compared."""
    rng = np.random.default_rng(0)
    middles = rng.integers(-3000, 3000, (8, 64))
    x = middles[rng.integers(0, 8, 500)] + rng.integers(-200, 200, (500, 64))
    values, vectors_ = np.linalg.eigh(np.cov(x.T.astype(float)))
    turn = vectors_[:, ::-1]
    lead, rest = centroids.rotated(x, turn, 16)
    c_lead, c_rest = centroids.rotated(middles, turn, 16)
    exact = ((x[:, None] - middles[None]) ** 2).sum(axis=2)
    bound = ((lead[:, None] - c_lead[None]) ** 2).sum(axis=2) + (rest[:, None] - c_rest[None]) ** 2
    assert (bound <= exact * (1 + 1e-9) + 1e-3).all()
    cluster, best, compared = centroids.nearest(x, lead, rest, middles, c_lead, c_rest)
    assert (cluster == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert compared < 2 * len(x)  # of 8 a vector


# ---- log-bilinear scoring -------------------------------------------------

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, held_out string, key long, c int, ids string"
END = object()


def split(text):
    return [*TOKEN.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")), END]


def prose(rng, lang, n):
    return " ".join(rng.choice(lang) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    langs = [[f"{c}{i}" for i in range(30)] for c in "xyz"]
    rows = [(i, prose(rng, langs[i % 3], rng.randint(20, 60))) for i in range(600)]
    rows += [(600, None), (601, ""), (602, " \t\n"), (None, "Null ID text"), (None, None), (5, rows[5][1]), (5, rows[5][1]),
             (603, "long" * 50000), (604, "ÄÖ  wort eins WORD Word"), (605, prose(rng, langs[0], 20000)), (606, "never seen 1 2 3")]
    return rows


def brute_counts(rows):
    c = Counter()
    for i, t in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            c.update(split(t))
    return c


@pytest.mark.parametrize("vocabulary, heavy", [(1024, 1 << 18), (20, 40)])
def test_scores_like_brute_force(spark, corpus, monkeypatch, vocabulary, heavy):
    """Base scores from plain counts; the model's from its parameters by a
    plain softmax, token by token, also where most tokens are joined (``heavy`` small)."""
    models = []
    fit = logbilinear.fit
    monkeypatch.setattr(logbilinear, "fit", lambda *a: models.append(fit(*a)) or models[-1])
    lexica = []

    made = logbilinear.Lexicon.__init__
    monkeypatch.setattr(logbilinear.Lexicon, "__init__", lambda self, *a: lexica.append(self) or made(self, *a))
    df = spark.createDataFrame([(i, t, "en", "x", 1, 2, "z") for i, t in corpus], DOCS).repartition(3)
    found = logbilinear.score(df, vocabulary, heavy).collect()
    assert len(found) == len(corpus)
    c = brute_counts(corpus)
    total, types = sum(c.values()), len(c)
    model, lex = models[0], lexica[0]
    digest = {}
    for t in c:
        if t is END:
            digest[t] = logbilinear.END
        else:
            data, offsets = text_bytes(pa.array([t]))
            d1, d2, _ = logbilinear.tokens(data, offsets)
            digest[t] = d1[0], d2[0]
    other = len(lex.counts) - 1
    classes = {}
    for t, d in digest.items():
        at = lex.find(np.array([d[0]], np.uint64), np.array([d[1]], np.int32))[0]
        classes[t] = int(lex.classes[at]) if at >= 0 else other
    outside = [t for t in c if classes[t] == other]
    n_out, v_out = sum(c[t] for t in outside), len(outside)
    assert other + 1 == min(vocabulary, types + 1) and len(lex.d1) <= heavy
    r, t_, b, cc = (x.astype(np.float64) for x in (model.r, model.t, model.b, model.c))
    tables = {}

    def p(ctx):
        if ctx not in tables:
            s = t_ @ sum(r[w] * cc[i] for i, w in enumerate(ctx)) + b
            tables[ctx] = np.exp(s) / np.exp(s).sum()
        return tables[ctx]

    def brute(text):
        ctx, score = (other + 1, other + 1), 0.0
        for w in split(text):
            k = classes.get(w, other)
            score += np.log10(p(ctx)[k])
            if k == other:
                score += np.log10((c[w] + 1) / (n_out + v_out + 1))
            ctx = (k, ctx[0])
        return score
    plain = {}
    for i, t in corpus:
        ws = split(t)
        held = zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
        base = sum(np.log10((c[w] + 1) / (total + types + 1)) for w in ws)
        plain.setdefault(i, []).append((held, len(ws), sum(c[w] > 0 for w in ws), total, base, brute(t)))
    for row in found:
        facts = tuple(row)[1:]
        assert any(facts[:4] == want[:4] and facts[4:] == pytest.approx(want[4:], rel=1e-5) for want in plain[row.doc_id]), (row, plain[row.doc_id])
    # all classes, and in the last one all known types and an unknown one, add up to 1
    assert p((0, 1)).sum() == pytest.approx(1)
    assert sum((c[w] + 1) / (n_out + v_out + 1) for w in outside) + 1 / (n_out + v_out + 1) == pytest.approx(1)


def test_the_model_learns_its_context(spark, corpus):
    """Held-out texts are more probable than by their tokens' frequencies: a
    context tells the language, which divides the choice by three."""
    rows = [(i, t) for i, t in corpus if i is not None and i < 600] * 24
    df = spark.createDataFrame([(i, t, "en", "x", 1, 2, "z") for i, t in rows], DOCS).coalesce(2)
    held = [r for r in logbilinear.score(df).collect() if r.held_out]
    n = sum(r.n_tokens for r in held)
    gain = (sum(r.score for r in held) - sum(r.base_score for r in held)) / n
    assert len(held) > 200 and gain > 0.25  # log10(3) = 0.48


def test_scores_of_empty_tables(spark):
    assert logbilinear.score(spark.createDataFrame([], DOCS)).count() == 0
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = logbilinear.score(spark.createDataFrame([(only_held, "a b", "", "", 1, 2, "")], DOCS)).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
    assert row.score == pytest.approx(3 * np.log10(1 / 2))  # an end or not, nothing learnt


# ---- prefix trie ----------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth string, rank int, digest string"


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 225), -5, -100, -103]:
        n = rng.choice([0, 1, 2, 5, 9, 12]) if c % 100 else rng.randint(1, 6)
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hello", "héllo wörld", "x"])))
    rows += [(3, None, None, None), (4, 2, "user", None), (4, 2, None, "x"), (6, 0, "user", "x"), (6, 0, "user", "x"),  # null, equal and repeated turns
             (None, 0, "user", "lost"), (None, None, None, None), (31, 77, "user", "y" * 200000)]
    rows += [(1000 + i, t, "user", "same") for i in range(60) for t in range(3)]  # many ends at few nodes
    rows += [(2001, t, "user", f"t{t % 3}") for t in range(120)]  # a long one
    return rows


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r.decode(), t.decode()) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        stem = c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(stem, [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, who in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += kids[n] == 0
            saved[n[:d]] += (len(who) - 1) * len(n[-1][1]) if n else 0
    return sorted(repr((min(who), len(n), min(members[n[:-1]]) if n else None, len(who), kids[n], leaves[n], saved[n],
                        hashlib.sha256(",".join(str(c) for c in sorted(who) if len(built[c]) == len(n)).encode()).hexdigest())) for n, who in members.items())


@pytest.mark.parametrize("height, piece", [(16, 1 << 16), (3, 7)])
def test_trie_like_brute_force(spark, tmp_path, monkeypatch, height, piece):
    """Also with low bands (many rounds) and short pieces of ids."""
    monkeypatch.setattr(prefixtrie, "PIECE", piece)
    rows = conversations(4)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TURNS).repartition(3)
    found = prefixtrie.trie(df, height).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert sorted(repr(tuple(r)) for r in found) == brute_trie(rows)


def test_trie_of_few_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, 1, "a", "b", "x", 1, "y")], TURNS)
    assert registered(spark, tmp_path, "conversations", prefixtrie.query, df).count() == 0
    assert prefixtrie.trie(spark.createDataFrame([], TURNS)).count() == 0
    c = next(i for i in range(100, 200) if i % 100 and zlib.crc32(str(i).encode()) % 6 > 1)
    (root,) = prefixtrie.trie(spark.createDataFrame([(c, 1, "a", "b", "x", 1, "y")], TURNS)).collect()  # turnless: its stem is absent
    assert (root.conv_id, root.depth, root.n_convs, root.n_children, root.n_leaves, root.saved_tokens, root.ends_sha256) == (c, 0, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
