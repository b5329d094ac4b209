import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltlens.llm import langid

PARTS = {"en": "the and ing tion er ly of that th ou", "de": "sch ein und der keit ung ch ie ver ü",
         "fr": "eau oi les que ment é è ç tre aux"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    return [(i, prose(rng, k, rng.randint(5, 60)), k) for i in range(600) for k in [rng.choice(list(PARTS))]]


@pytest.fixture(scope="module")
def model(frame, corpus):
    return langid.fit(frame(corpus))


def test_held_out_accuracy_and_rejection(frame, corpus, model):
    rows = langid.predict(frame(corpus), model).select(
        "doc_id", "lang", "lang_pred", "score", "rejected", langid.learned(F.col("doc_id")).alias("learned")).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(r.learned == (zlib.crc32(str(r.doc_id).encode()) % 3 != 1) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert not any(r.rejected for r in rows) and all(0 <= r.score <= 1 for r in rows)


def test_other_language_is_rejected(frame, model):
    rows = langid.predict(frame([(1, "xkq zvb wjjq pqx kkz vxw " * 20), (2, "日本語 " * 50)]), model).collect()
    assert all(r.rejected for r in rows)


def slow_probability(grams, text, at):
    """Interpolated Kneser-Ney straight from the definition, over Python dicts."""
    from collections import Counter

    n = langid.ORDER
    counts = {n: Counter(grams)}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    alphabet = len({c for g in grams for c in g}) + 1

    def p(k, g):
        c = counts[k]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        below = p(k - 1, g[1:]) if k > 1 else 1 / alphabet
        own = {x: v for x, v in c.items() if x[:-1] == g[:-1]}
        if not own:
            return below
        total = sum(own.values())
        return (max(own.get(g, 0) - d, 0) if g in own else 0) / total + d * len(own) / total * below

    return p(n, (" " * (n - 1) + text)[at:at + n])


def test_probabilities_match_definition():
    rng = random.Random(9)
    text, probe = prose(rng, "en", 40), "the zing thou andly"
    flat, own, _ = langid.symbols([text], langid.ORDER - 1)
    rows = ["".join(map(chr, g)) for g in flat[own[:, None] + np.arange(1 - langid.ORDER, 1)]]
    seen = sorted(set(rows))
    codes = np.array([[ord(c) for c in g] for g in seen], np.uint32)
    counts = np.array([rows.count(g) for g in seen])
    alphabet = len({c for g in seen for c in g}) + 1
    model = langid.Model(["en"], [langid.fit_language(codes, counts, alphabet)])
    flat, own, _ = langid.symbols([probe], langid.ORDER - 1)
    got = np.exp(model.log_probabilities(flat[own[:, None] + np.arange(1 - langid.ORDER, 1)])[:, 0])
    want = [slow_probability(rows, probe, i) for i in range(len(probe))]
    assert np.allclose(got, want, rtol=1e-4)
    entropy, n = langid.Scorer(model).entropies([probe, None, probe])
    assert n.tolist() == [len(probe), 0, len(probe)] and np.isnan(entropy[1, 0])
    assert np.allclose(entropy[[0, 2], 0], -np.log(want).mean(), rtol=1e-4)


def test_normalisation():
    flat, own, n = langid.symbols(["  A1b!!C ", "123", None, "É"], 2)
    assert "".join(chr(c) for c in flat[own]) == " a b c é" and n.tolist() == [7, 0, 0, 1]


def test_edges(frame, edge, model):
    rows = {r.doc_id: r for r in langid.predict(edge, model).collect()}
    for i in (1, 2, 3, 11):
        assert rows[i].lang_pred == "und" and rows[i].score == 0.0 and rows[i].rejected
    assert langid.keep_identified(edge, model).columns == edge.columns
    assert langid.predict(frame([]), model).count() == 0
    empty = langid.fit(frame([(3, "text", None), (None, "text", "en"), (5, None, "en")]))
    assert [r.lang_pred for r in langid.predict(frame([(1, "text")]), empty).collect()] == ["und"]


def test_few_long_texts_are_learned_in_pieces(frame, corpus):
    """A language of few texts, each longer than ``fit_chars``."""
    rng = random.Random(6)
    long = [(1000 + i, "zug " * 20 + prose(rng, "de", 4000), "xx") for i in range(12)]
    rows = [r for r in corpus if r[2] != "de"] + long
    model = langid.fit(frame(rows), fit_rows=100, fit_chars=8000)
    assert model.languages == ["en", "fr", "xx"]
    got = langid.predict(frame(long), model).collect()
    assert all(r.lang_pred == "xx" and not r.rejected for r in got)


def test_languages_of_one_text_and_of_copies_are_learned(frame):
    rng = random.Random(7)
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    single = [(i, prose(rng, "fr", 30), f"l{i}") for i in ids[:30]]
    copies = [(i, "ein text", "de") for i in range(1000, 3000)] + [(i, prose(rng, "de", 20), "de") for i in range(3000, 3040)]
    model = langid.fit(frame(single + copies), fit_rows=30)
    assert set(model.languages) == {k for _, _, k in single} | {"de"}
    drawn = langid.draw(langid.pick(frame(copies), {"lang": "lang", "text": "text"}), 30, 10 ** 6).collect()
    assert len(drawn) == len({r.text for r in drawn}) == 30 and sum(r.counts for r in drawn) == 24


def test_piece_length():
    assert langid.piece_length([5, 7], 100) == 7 and langid.piece_length([5, 50, 50], 45) == 20
    assert langid.piece_length([10 ** 6] * 3, 1) == 1
