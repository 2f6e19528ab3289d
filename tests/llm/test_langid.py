import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs  # noqa: E402

from valence.llm import langid as L  # noqa: E402

WORDS = {"en": "the and that with this from have been which their", "de": "der die und nicht eine auch werden über schön",
         "fr": "les des une dans être avec pour très où leur"}


def text(rng, lang, n=40):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def train(spark, rng):
    return docs(spark, [(i, text(rng, lang), lang) for i in range(30) for lang in WORDS]
                + [(900, None, "en"), (901, "", "fr"), (902, "12 34", "xx"), (903, "no label", None)])


def test_predictions_and_odd_rows(spark):
    rng = random.Random(4)
    langs, probs = L.learn(train(spark, rng))
    assert langs == ["de", "en", "fr"] and np.allclose(probs.sum(1), 1)
    rows = [(i, text(rng, lang), lang) for i, lang in enumerate(WORDS)]
    rows += [(10, None), (11, ""), (12, "12 3_4!\n"), rows[0], rows[0], (None, text(rng, "de")),
             (13, text(rng, "en", 400_000)), (14, text(rng, "en") + " " + text(rng, "de", 20))]
    df = docs(spark, rows).selectExpr("*", "'q' as lang_pred", "1 as score")
    got = {(r.doc_id, i): r for i, r in enumerate(L.predict(df, langs, probs).collect())}
    by = [(k[0], r.lang_pred, r.score) for k, r in got.items()]
    assert [b for b in by if b[0] in (10, 11, 12)] == [(i, "und", 0.0) for i in (10, 11, 12)]
    assert [p for _, p, _ in by[:3]] == [lang for _, _, lang in rows[:3]]
    assert len([b for b in by if b[0] == 0]) == 3 and ("de" in [b[1] for b in by if b[0] is None])
    mixed = next(r for k, r in got.items() if k[0] == 14)
    assert mixed.langs == ["en", "de"] and abs(mixed.shares[0] - 2 / 3) < 0.1 and abs(sum(mixed.shares) - 1) < 1e-9
    kept = L.accept(df, langs, probs).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r[0]) for r in rows if r[0] not in (10, 11, 12))


def test_slices_count_the_same(monkeypatch):
    t = "Ein  schöner--Tag, 12 mal é" * 7
    whole = L.trigrams(t)
    monkeypatch.setattr(L, "SLICE", 5)
    assert (L.trigrams(t) == whole).all() and L.trigrams("1 2") is None


def test_nothing_learned_and_empty(spark):
    langs, probs = L.learn(docs(spark, []))
    assert [r.lang_pred for r in L.predict(docs(spark, [(1, "abc")]), langs, probs).collect()] == ["und"]
    assert L.predict(docs(spark, []), langs, probs).count() == 0


def test_texts_that_no_learned_language_fits_go_and_mixtures_stay(spark):
    rng = random.Random(5)
    langs, probs = L.learn(train(spark, rng))
    junk = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(40))
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki"
    keep = [(i, " ".join(text(rng, lang, 20) for lang in rng.sample(sorted(WORDS), 1 + i % 3))) for i in range(30)]
    away = [(100 + i, junk()) for i in range(10)] + [(200, finnish), (201, "δεν υπάρχει τίποτα καινούργιο κάτω από τον ήλιο")]
    kept = L.accept(docs(spark, keep + away), langs, probs).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [i for i, _ in keep]
