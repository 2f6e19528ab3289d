import base64
import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
import tiktoken

from tests.llm.helpers import docs
from valence.llm import alignment as A

SCHEMA = ["doc_id", *A.COLUMNS, "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    """Other readers of the same vocabularies: ranks for the first side, the
    model's own byte spans for the second."""
    with open(os.path.join(A.FOLDER, "byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return (tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}),
            sentencepiece.SentencePieceProcessor(model_file=os.path.join(A.FOLDER, A.B_FILE)))


def _tokens(text, tokenizers):
    """``(ids, byte strings)`` of both sides, or None."""
    if not text:
        return None
    own, pieces = tokenizers
    a = own.encode_ordinary(" " + text)
    b = pieces.encode(text)
    bytes_b = []
    for i in b:
        p = pieces.id_to_piece(i)
        bytes_b.append(bytes.fromhex(p[3:5]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
    if b"".join(bytes_b) != (" " + text).encode():
        return None
    return (a, [own.decode_single_token_bytes(i) for i in a]), (b, bytes_b)


def _expected(rows, tokenizers):
    """All links by comparing each pair of ranges that can meet."""
    links, out = {}, []
    for at, (_, text) in enumerate(rows):
        found = _tokens(text, tokenizers)
        if found is None:
            links[at] = []
            continue
        ranges = []
        for ids, parts in found:
            pos, side = 0, []
            for i, p in zip(ids, parts):
                side.append((pos, pos + len(p), i))
                pos += len(p)
            ranges.append(side)
        links[at] = [(x[2], y[2]) for x in ranges[0] for y in ranges[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({e for _, e, _ in ranges[0]} & {e for _, e, _ in ranges[1]})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, t, i in side if low <= s and t <= e) for side in ranges))
            low = e
        links[at, "row"] = (len(ranges[0]), len(ranges[1]), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest())
    holds = Counter(p for at in range(len(rows)) for p in set(links[at]))
    best = defaultdict(int)
    for (a, _), n in holds.items():
        best[a] = max(best[a], n)
    for at, (doc, _) in enumerate(rows):
        n_a, n_b, n_groups, digest = links.get((at, "row"), (0, 0, 0, ""))
        out.append((doc, n_a, n_b, n_groups, len(links[at]), sum(holds[p] == best[p[0]] for p in links[at]),
                    sum(holds[p] for p in links[at]), digest))
    return out


def _rows():
    rng = random.Random(4)
    words = "the naïve Straße tokenization 日本語 12345 e.g. --- 🙂 été  \n\n \t x".split(" ")
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(1, 60))) for i in range(30)]
    return rows + [(40, None), (41, ""), (42, " "), (43, "  two  blanks  "), (44, "▁ lower block"), (45, "<|endoftext|><s></s><unk>"),
                   (46, "<0x41>\x00\x01\x7f"), (47, "​﻿nulĺ"), (48, "\n"), (None, "no id here"), (49, "a" * 700),
                   (50, "é" * 300), rows[0], rows[0], (51, rows[0][1]), (52, "ﬁ ﬀ ｆｕｌｌ Å Å"), (53, text(900))]


@pytest.mark.parametrize("head_size", [A.HEAD, 40, 0])
def test_against_all_ranges(spark, tokenizers, head_size):
    rows = _rows()
    got = A.aligned(docs(spark, rows).repartition(3), head_size=head_size).select(SCHEMA).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(map(tuple, got), key=key) == sorted(_expected(rows, tokenizers), key=key)


def test_given_table(spark, tokenizers):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    kept = [r for r in rows if len(r[1] or "") < 2500]  # the slow version compares all ranges
    got = {r.doc_id: tuple(r) for r in A.query(spark, sf).collect()}
    assert len(got) == len(rows)
    for doc, n_a, n_b, n_groups, n_links, _, _, digest in _expected(kept, tokenizers):
        assert got[doc][1:5] + got[doc][-1:] == (n_a, n_b, n_groups, n_links, digest)


def test_tokens_spell_their_texts():
    sides = A.load(*(open(os.path.join(A.FOLDER, f), "rb").read() for f in (A.A_FILE, A.B_FILE))).sides
    for text in ("plain words", "ünï 🙂", "tabs\tand\nlines", "\x00\x1f"):
        for side in sides:
            assert b"".join(side.pieces[i] for i in side.encode([text])[0]) == b" " + text.encode()
            assert side.ids([text]) == side.encode([text])


def test_forgetting_changes_nothing(monkeypatch):
    texts = [(t or "").encode() for _, t in _rows()]
    files = [open(os.path.join(A.FOLDER, f), "rb").read() for f in (A.A_FILE, A.B_FILE)]
    memory = A.load(*files)
    monkeypatch.setattr(A, "HELD_CHARS", 50)
    plain = [x.to_pylist() if hasattr(x, "to_pylist") else list(x) for x in memory.texts(texts)]
    for i, t in enumerate(texts):
        one = [x.to_pylist() if hasattr(x, "to_pylist") else list(x) for x in memory.texts([t])]
        assert one == [c[i:i + 1] for c in plain]


def test_pairs_spell_overlaps(spark):
    """The links themselves, for the general result of the operator."""
    row = A.aligned(docs(spark, [(1, "hello world hello world")])).collect()[0]
    assert sum(row.times) == row.n_links and len(row.pairs) == len(set(row.pairs)) == len(row.times)
    assert row.count_sum == row.n_links


def test_empty(spark):
    assert A.aligned(docs(spark, [])).collect() == []
    got = A.aligned(docs(spark, [(1, None), (2, "")])).select(SCHEMA).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_no_token_crosses_a_cut():
    for side in A.load(*(open(os.path.join(A.FOLDER, f), "rb").read() for f in (A.A_FILE, A.B_FILE))).sides:
        assert not any(A.CUT.search(p.decode("utf-8", "ignore")) for p in side.pieces)
