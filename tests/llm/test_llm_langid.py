"""Language identification against a model of plain dictionaries."""

import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnout.llm import langid

N = 4


def plain_symbols(text):
    """The characters as the docstring states them, start symbols first."""
    out = list("\x01" * 3)
    for c in (text or "").lower():
        c = c if c.isalpha() or unicodedata.combining(c) else " "
        if c != " " or out[-1] != " ":
            out.append(c)
    return out


def grams_of(text):
    s = plain_symbols(text)
    return ["".join(s[i - N + 1:i + 1]) for i in range(3, len(s))]


class Plain:
    """Interpolated Kneser-Ney of one language from its texts, in dictionaries."""

    def __init__(self, texts, alphabet):
        self.base, self.levels = 1 / (alphabet + 1), []
        counts = Counter(g for t in texts for g in grams_of(t))
        for n in range(N, 0, -1):
            once, twice = (sum(1 for c in counts.values() if c == k) for k in (1, 2))
            discount = min(0.95, max(0.1, once / max(1.0, once + 2 * twice)))
            total, kinds = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.levels.append((n, counts, discount, total, kinds))
            left = defaultdict(set)
            for g in counts:
                left[g[1:]].add(g[0])
            counts = Counter({g: len(x) for g, x in left.items()})

    def p(self, gram):
        p = self.base
        for n, counts, discount, total, kinds in reversed(self.levels):
            own = gram[N - n:]
            context = own[:-1]
            if context in total:
                p = (counts[own] - discount if own in counts else 0.0) / total[context] + discount * kinds[context] / total[context] * p
        return p

    def entropy(self, text):
        grams = grams_of(text)
        return -sum(math.log(self.p(g)) for g in grams) / max(1, len(grams))


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    letters = {"aa": "abcdefgh", "bb": "efghijklå", "cc": "ijklmnopé"}
    words = {x: ["".join(rng.choice(s) for _ in range(rng.randint(1, 6))) for _ in range(60)] for x, s in letters.items()}
    out = [(i, prose(rng, words[x], rng.randint(4, 60)), x) for i, x in enumerate(("aa", "bb", "cc") * 30)]
    out += [(100, None, "aa"), (101, "", "bb"), (102, "12, 34!", "cc"), (103, "a", "aa"), (104, "Ab́ C--d  9 e", "aa"), (105, "日本 語", None),
            (106, prose(rng, words["bb"], 4000), None), (None, prose(rng, words["cc"], 30), "cc"), (107, "\x01\x01 abc \x01", "aa"), (3, out[3][1], "aa")]
    return out


def test_every_entropy_is_the_plain_models(rows):
    """Seen and unseen grams, all orders: the sorted arrays against the dictionaries."""
    import pandas as pd
    texts = {x: [t for _, t, y in rows if y == x and t is not None] for x in ("aa", "bb", "cc")}
    table = [(x, g, n) for x, some in texts.items() for g, n in Counter(g for t in some for g in grams_of(t)).items()]
    model = langid.Model(pd.DataFrame(table, columns=["lang", "gram", "n"]))
    alphabet = len({c for _, g, _ in table for c in g})
    plain = [Plain(texts[x], alphabet) for x in model.names]
    some = [t for _, t, _ in rows] + ["quite other letters: xyz ÄÖ", "zzzz", "hgfedcba"]
    entropy, n, has = model.entropies(some)
    for k, t in enumerate(some):
        assert n[k] == len(grams_of(t)) and has[k] == any(c.isalpha() for c in t or "")
        if n[k]:
            assert entropy[k] == pytest.approx([m.entropy(t) for m in plain], rel=1e-5)


def test_query_predicts_as_the_plain_model(spark, rows, tmp_path):
    """The registered query, with its folds: learnt documents and predictions rebuilt by hand."""
    path = tmp_path / "sf"
    kind = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame([(*r, "s") for r in rows], kind)
    docs.write.parquet(f"{path}/documents.parquet")
    found = langid.query(spark, str(path)).collect()
    assert len(found) == len(rows)
    part = {(r.doc_id, r.part) for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(4)).alias("part")).collect()}
    part = dict(part)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in part}
    learnt = [(t, x) for i, t, x in rows if i is not None and not held[i] and part[i] > 0 and t is not None and x is not None]
    names = sorted({x for _, x in learnt})
    assert names == ["aa", "bb", "cc"]
    alphabet = len({c for t, _ in learnt for g in grams_of(t) for c in g})
    plain = {x: Plain([t for t, y in learnt if y == x], alphabet) for x in names}
    text = {i: t for i, t, _ in rows}
    for r in found:
        t = text[r.doc_id]
        assert r.held_out == held[r.doc_id]
        if not any(c.isalpha() for c in t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        entropy = {x: m.entropy(t) for x, m in plain.items()}
        low = min(entropy.values())
        assert r.entropy == pytest.approx(low, rel=1e-5) and entropy[r.lang_pred] == pytest.approx(low, rel=1e-5)
        weights = [math.exp(-(e - low) * min(len(grams_of(t)), langid.SHARP)) for e in entropy.values()]
        assert r.score == pytest.approx(1 / sum(weights), rel=1e-3)
    assert np.mean([r.lang_pred == x for r, x in zip(sorted(found, key=lambda r: str(r.doc_id)), [x for _, _, x in sorted(rows, key=lambda r: str(r[0]))]) if x]) > 0.9
