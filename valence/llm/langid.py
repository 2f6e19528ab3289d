"""Language ID by multilingual mixture inference.

Training counts hashed letter trigrams for each language. A document is then a
mixture: expectation-maximisation estimates the share of its trigrams that
each language explains, and the language set is the nested set (largest shares
first) with the best likelihood less half a log(n) for each language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
without any learned language every text is ``und``; equal shares go to the
alphabetically first language; repeated rows get equal results; very long
texts are counted in slices that carry their last letters over; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valence.llm.common import column, fold, read_table, record

BUCKETS = 1 << 14
ROUNDS = 12
LEAST_SHARE = 0.02  # a language below this share joins no set
SLICE = 1 << 20
SLACK = 1.5  # nats a trigram by which a text's own subject may lower its likelihood
ERRORS = 4  # standard errors by which chance may
CELLS = 1 << 21  # trigram x language cells worked on at a time


@functools.cache
def _letters() -> np.ndarray:
    """Lower-case letter of every code point; 0 where it is no letter."""
    fold_to = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            fold_to[cp] = ord(ch.lower()[0])
    return fold_to


def trigrams(text: str | None) -> np.ndarray | None:
    """Counts of hashed letter trigrams, runs of other characters being one
    gap; None if there is no letter."""
    total, tail = np.zeros(BUCKETS, np.int64), np.zeros(1, np.uint32)
    seen = False
    for at in range(0, len(text or ""), SLICE):
        cp = np.frombuffer(text[at:at + SLICE].encode("utf-32-le", "surrogatepass"), "<u4")
        c = np.concatenate((tail, _letters()[cp]))
        seen = seen or bool(c.any())
        if at + SLICE >= len(text):
            c = np.append(c, np.uint32(0))
        c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]
        if len(c) > 2:
            h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            total += np.bincount(h >> np.uint32(18), minlength=BUCKETS)
        tail = c[-2:]
    return total if seen else None


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the probability of each trigram bucket in each of them,
    from rows ``(text, lang)``; each task adds its counts up first."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def flush(sums):
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield record(schema, [[lang] * len(at), at.astype(np.int32), total[at]])
        sums.clear()

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(column(b, "text").to_pylist(), column(b, "lang").to_pylist()):
                got = trigrams(text)
                if got is not None:
                    sums[lang] = sums[lang] + got if lang in sums else got
                    if len(sums) > 200:
                        yield from flush(sums)
        yield from flush(sums)

    rows = (docs.where("lang is not null").select("text", "lang")
            .mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(rows.lang.unique())
    counts = np.full((len(langs), BUCKETS), 0.5)
    counts[rows.lang.map({x: i for i, x in enumerate(langs)}).to_numpy(int), rows.bucket.to_numpy(int)] += rows.n
    return langs, counts / counts.sum(1, keepdims=True)


def _em(p: np.ndarray, c: np.ndarray, start: np.ndarray, theta: np.ndarray, rounds: int):
    """Mixture shares and log-likelihood of each document. ``p``: probability
    of each (document, trigram) row by language; ``start``: first rows."""
    of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(c))))
    n = np.add.reduceat(c, start)[:, None]
    for _ in range(rounds):
        w = p * theta[of]
        w *= (c / w.sum(1))[:, None]
        theta = np.add.reduceat(w, start) / n
    return theta, np.add.reduceat(c * np.log((p * theta[of]).sum(1)), start)


def mixtures(counts: list[np.ndarray], probs: np.ndarray) -> list[tuple[list[int], list[float]]]:
    """For each document's trigram counts: the selected languages, largest
    share first, and their shares."""
    if not counts:
        return []
    at = [np.flatnonzero(x) for x in counts]
    rows = np.concatenate(at)
    c = np.concatenate([x[i] for x, i in zip(counts, at)]).astype(float)
    start = np.cumsum([0, *(len(i) for i in at[:-1])])
    p = np.ascontiguousarray(probs[:, rows].T)
    theta, _ = _em(p, c, start, np.full((len(at), len(probs)), 1 / len(probs)), ROUNDS)
    order = np.argsort(-theta, axis=1, kind="stable")
    of = np.repeat(np.arange(len(at)), [len(i) for i in at])
    n = np.add.reduceat(c, start)
    best = np.add.reduceat(c * np.log(p[np.arange(len(c)), order[of, 0]]), start) - 0.5 * np.log(n)
    chosen = [([int(o[0])], [1.0]) for o in order]
    for k in range(2, len(probs) + 1):
        docs = np.flatnonzero(theta[np.arange(len(at)), order[:, k - 1]] >= LEAST_SHARE)
        if not len(docs):
            break
        keep = np.isin(of, docs)
        sub = order[docs, :k]
        inner = np.repeat(np.arange(len(docs)), [len(at[d]) for d in docs])
        begin = np.cumsum([0, *(len(at[d]) for d in docs[:-1])])
        first = theta[docs[:, None], sub]
        got, like = _em(p[keep][np.arange(keep.sum())[:, None], sub[inner]], c[keep], begin,
                        first / first.sum(1, keepdims=True), ROUNDS)
        like = like - 0.5 * k * np.log(n[docs])
        for j, d in enumerate(docs):
            if like[j] > best[d]:
                best[d] = like[j]
                o = np.argsort(-got[j], kind="stable")
                chosen[d] = ([int(sub[j][x]) for x in o], [float(got[j][x]) for x in o])
    return chosen


def predict(docs: DataFrame, langs: list[str], probs: np.ndarray) -> DataFrame:
    """``(doc_id, lang_pred, score, langs, shares)`` for each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("langs", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))])
    shared = docs.sparkSession.sparkContext.broadcast(probs)  # languages x buckets, whatever the corpus

    def infer(ids, texts):
        counts = [trigrams(t) if langs else None for t in texts]
        found = iter(mixtures([x for x in counts if x is not None], shared.value))
        rows = [("und", 0.0, [], []) if x is None else
                (langs[(m := next(found))[0][0]], m[1][0], [langs[i] for i in m[0]], m[1]) for x in counts]
        return record(schema, [ids, *zip(*rows)])

    def run(batches):
        for b in batches:
            texts, ids = column(b, "text").to_pylist(), column(b, "doc_id").to_pylist()
            at, cells = 0, 0
            for i, t in enumerate(texts):
                cells += min(len(t or ""), BUCKETS) * max(1, len(langs))
                if cells >= CELLS or i - at >= 511:
                    yield infer(ids[at:i + 1], texts[at:i + 1])
                    at, cells = i + 1, 0
            if at < len(texts):
                yield infer(ids[at:], texts[at:])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>")


def fits(counts: list[np.ndarray], chosen: list[tuple[list[int], list[float]]], probs: np.ndarray) -> list[bool]:
    """Whether each document is as likely under its mixture as texts of the
    learned languages are: its log-likelihood a trigram may lie below what the
    languages expect of their own trigrams by SLACK and ERRORS standard errors."""
    logs, seen = np.log(probs), probs - probs.min(1, keepdims=True)  # what was learned, without the smoothing
    seen = seen / np.maximum(seen.sum(1, keepdims=True), 1e-300)
    mean = (seen * logs).sum(1)
    var = (seen * logs ** 2).sum(1) - mean ** 2
    out = []
    for c, (which, share) in zip(counts, chosen):
        at, share = np.flatnonzero(c), np.array(share)
        n, own = c.sum(), share > 0
        like = (c[at] * np.log(share @ probs[np.ix_(which, at)])).sum() / n
        # each trigram may also cost the choice among the languages
        expected = share @ mean[which] + (share[own] * np.log(share[own])).sum()
        out.append(bool(like >= expected - SLACK - ERRORS * np.sqrt(share @ var[which] / n)))
    return out


def accept(docs: DataFrame, langs: list[str], probs: np.ndarray, least: float = 0.25) -> DataFrame:
    """The rows of ``docs``, all columns, of which one language explains at
    least the share ``least`` and which the learned languages fit; texts
    without a letter go."""
    shared = docs.sparkSession.sparkContext.broadcast(probs)

    def run(batches):
        for b in batches:
            texts = column(b, "text").to_pylist()
            keep = []
            for at in range(0, len(texts), 256):
                counts = [trigrams(t) if langs else None for t in texts[at:at + 256]]
                some = [x for x in counts if x is not None]
                found = mixtures(some, shared.value)
                good = iter([m[1][0] >= least and f for m, f in zip(found, fits(some, found, shared.value) if some else [])])
                keep += [x is not None and next(good) for x in counts]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_id(train: DataFrame, docs: DataFrame) -> DataFrame:
    """Learn from ``train(text, lang)`` and predict every row of ``docs``."""
    return predict(docs, *learn(train))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    got = language_id(docs.where(fold("doc_id", 5) != 0), docs)
    return got.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score",
                      F.concat_ws(",", "langs").alias("langs"))


QUERIES = {"op5_language_id": query}
ORACLE = {}
