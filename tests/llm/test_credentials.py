import hashlib
import math
import random
import re
import string

import pytest

from tests.llm.helpers import docs
from valence.llm import credentials as C

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"""
                    r"""|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def _base(text):
    """The contract's patterns, in the plain form."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def _expected(doc, text):
    spans = _base(text)
    joined = ",".join(f"{C.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return (doc, *(sum(x[1] == k for x in spans) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest()), joined


def _value(rng, form):
    n = {"hex": 40, "ghp": 36, "key": 32, "AKIA": 16}[form]
    letters = {"hex": "0123456789abcdef", "AKIA": string.ascii_uppercase + string.digits}.get(form, string.ascii_letters + string.digits)
    return {"hex": "", "ghp": "ghp_", "key": "sk_live_", "AKIA": "AKIA"}[form] + "".join(rng.choice(letters) for _ in range(n))


def _prose(rng, n=60):
    return " ".join(rng.choice("the tokens of words password ist nicht été secret: key naïve Überraschung "
                               "internationalization www.example.com/path/to/page 4952935900253052 snake_case_identifier "
                               "----------------------- CONSTANT_NAMES_ARE_LONG thunderstormlikeweather".split(" ")) for _ in range(n))


def _corpus(seed=1):
    rng = random.Random(seed)
    rows, planted, values = [], {}, set()
    for i in range(900):
        text = _prose(rng)
        if i % 3 == 0:
            form = rng.choice(("hex", "ghp", "key", "AKIA"))
            v = _value(rng, form)
            values.add(v)
            text += rng.choice((' token = "%s"', " api_key: %s", " PASSWORD='%s'", " apikey=%s ")) % v
        elif i % 20 == 1:
            v = _value(rng, rng.choice(("ghp", "key")))
            planted[i] = (len(text) + 5, len(text) + 5 + len(v))
            values.add(v)
            text += " see " + v + " " + _prose(rng, 5)
        rows.append((i, text))
    return rows, planted, values


ODD = [(1900, None), (1901, ""), (None, "password=abcdef"), (1902, "Password : 'abcde'"), (903, "token==abcdef secret:token=abc"),
       (904, "api-key=abcdefg api_key=abcdefg APIKEY='abcdefg'"), (905, "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "AKIAAKIA"),
       (906, "é" * 10 + "0" * 24 + "g" + "a" * 23), (907, "toKen=abcdefgh ſecret=abcdefgh"), (908, "password = \n abcdefgh"),
       (909, "token=" + "x" * 100_000), (910, "secret='AKIA" + "Z9" * 10 + "'"), (911, "passwordpasswd=abcdefgh" * 3)]


def test_base_spans_by_the_contract(spark):
    rows = _corpus()[0]
    rows += ODD + rows[:3]
    df = docs(spark, rows)
    got = C.digest(C.scan(df, C.learn(df))).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    got, expected = sorted(map(tuple, got), key=key), sorted((_expected(*r) for r in rows), key=lambda r: key(r[0]))
    assert [r[:5] for r in got] == [r for r, _ in expected]
    for row, (_, joined) in zip(got, expected):
        # the added spans stand between the base ones, which stay
        assert [s for s in row[5].split(",") if s and not s.startswith("format")] == [s for s in joined.split(",") if s]
        starts = [int(s.split(":")[1]) for s in row[5].split(",") if s]
        assert starts == sorted(starts)


def test_learned_formats_are_found_without_their_keyword(spark):
    rows, planted, values = _corpus()
    texts = dict(rows)
    df = docs(spark, rows)
    added = {}
    for r in C.scan(df, C.learn(df)).collect():
        for s in r.spans:
            if s.kind == "format":
                assert s.gain >= C.LEAST_GAIN
                added.setdefault(r.doc_id, []).append((s.start, s.end))
    found = sum(planted[d] in added.get(d, ()) for d in planted)
    assert found >= 0.9 * len(planted), (found, len(planted))
    # prose stays alone; a credential may stand behind words that a base pattern takes for one
    assert all(texts[d][s:e] in values for d, spans in added.items() for s, e in spans)


def test_automaton_is_a_distribution_and_generalises():
    rng = random.Random(3)
    values = [_value(rng, "ghp") for _ in range(200)]
    model = C.infer(values)
    assert len(model.steps) < 40  # the prefix tree has thousands of states
    for steps, unseen in zip(model.steps, model.unseen):
        total = sum(math.exp(p) for p, _ in steps.values())
        for i, size in enumerate(C._SIZES):
            total += (size - sum(C._class(c) == i for c in steps)) * math.exp(unseen[i][0])
        assert total == pytest.approx(1, abs=1e-9)
    fresh = [_value(rng, "ghp") for _ in range(50)]
    assert min(model.score(v) for v in fresh) > max(model.score(v[::-1]) for v in fresh)
    assert min(model.score(v) for v in fresh) > max(model.score("x" + v) for v in fresh)
    # the prefix keeps its own states: it costs next to nothing
    assert model.score(fresh[0]) > 36 * math.log(1 / 62) - 15


def test_merging_by_brute_force_likelihood():
    """Counts of a folded automaton are those of walking the values through it."""
    rng = random.Random(5)
    values = [_value(rng, rng.choice(("ghp", "hex"))) for _ in range(150)]
    model = C.infer(values)
    counts = [dict() for _ in model.steps]
    for v in values:
        state = 0
        for c in v:
            counts[state][c] = counts[state].get(c, 0) + 1
            state = model.steps[state][c][1]
    for state, seen in enumerate(counts):
        n = sum(seen.values())
        assert set(seen) == set(model.steps[state])
        for c, k in seen.items():
            i = C._class(c)
            of_class = (sum(m for d, m in seen.items() if C._class(d) == i) + 1 / len(C._SIZES)) / (n + 1)
            assert model.steps[state][c][0] == pytest.approx(math.log((k + C.SMOOTH * of_class / C._SIZES[i]) / (n + C.SMOOTH)))


def test_pairs_by_counting():
    text = "ab a-b\nÄx  0=1 "
    seen = {}
    plain = " " + "".join(c if c.isascii() and (c.isalnum() or c in "+/_.-") else " " * len(c.encode()) for c in text) + " "
    for pair in zip(plain, plain[1:]):
        if pair != (" ", " "):
            seen["".join(pair)] = seen.get("".join(pair), 0) + 1
    got = C.pair_counts(text.encode())
    assert {chr(p >> 8) + chr(p & 255): got[p] for p in got.nonzero()[0].tolist()} == seen


def test_empty_and_unlabelled(spark):
    df = docs(spark, [])
    assert C.digest(C.scan(df, C.learn(df))).collect() == []
    df = docs(spark, [(1, "no credentials " + "x" * 50), (2, None)])
    rows = C.digest(C.scan(df, C.learn(df))).collect()
    assert [(r.n_assign, r.n_access, r.n_hex, r.spans) for r in rows] == [(0, 0, 0, "")] * 2


def test_candidates_keep_clear_of_base_spans():
    text = "token=ABCDEFGHIJKLMNOPQRST.more/path0123456789 ABCDEFGHIJKLMNOPQRST x=ABCDEFGHIJKLMNOPQRST=="
    base, longest = C.base_spans(text, text.encode())
    assert [text[s:e] for s, e, _ in C.candidates(text, base, longest)] == ["ABCDEFGHIJKLMNOPQRST", "ABCDEFGHIJKLMNOPQRST=="]
