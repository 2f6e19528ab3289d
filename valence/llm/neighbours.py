"""Embedding near-dedup by a subspace pigeonhole join.

Two unit vectors with cosine c are sqrt(2 - 2c) apart. After one rotation for
all, the coordinates are cut into blocks; if a pair is within the distance,
some block holds at most its proportional share of the squared distance. Each
block is joined by range: a vector has one home cell over the block's leading
coordinates and probes the cells that its range reaches. In a cell the block
distance gives the candidates, a pair counts in its first block only, and the
exact cosine in double precision decides. Cells return link counts and a
spanning forest of their links, never pairs.

Equal vectors are one row with a count before anything is joined. Cells with
more than ``TILE`` rows are cut into tiles of homes and probes that go to
different tasks; every home meets every probe in exactly one tile.

Defined cases: vectors that are null, empty, zero or hold a null or
non-finite component, and vectors without a label or an id, link with nothing
(component: their own id); vectors of different lengths are not compared;
labels may be of any type that Spark can hash;
repeated rows are vectors of their own that link with each other; ids are
expected to name one vector; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from valence.llm.common import column, connected_components, materialise, read_table, record

COSINE = 0.98
BLOCKS = 8
LEADING = 3  # coordinates of a block that make its cells
CELL = 2.8  # width of a cell in ranges; 2 at least
TILE = 4096
SEED = 17


def _usable() -> Column:
    e = F.col("embedding")
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(e) > 0)
            & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(e, lambda x: x != 0))


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diagonal(r))


def blocks(dim: int) -> list[slice]:
    edges = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int)
    return [slice(a, b) for a, b in itertools.pairwise(edges.tolist())]


def ranges(dim: int, cosine: float) -> list[float]:
    """Largest distance in each block: its share of the squared distance."""
    return [np.sqrt(max(0.0, 2 - 2 * cosine) * (s.stop - s.start) / dim) + 1e-7 for s in blocks(dim)]


def _rows(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` for each length of the vectors in a list column."""
    size = col.value_lengths().to_numpy()
    values, start = col.values.to_numpy().astype(np.float64), col.offsets.to_numpy()[:-1]
    return [(at := np.flatnonzero(size == n), values[start[at][:, None] + np.arange(n)]) for n in np.unique(size)]


def _mix(parts: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of small whole numbers."""
    h = np.full(len(parts), 0x243F6A8885A308D3, np.uint64)
    for c in parts.T:
        h = (h ^ c.astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _scaled(v: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first against overflow."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def cells(vectors: DataFrame, cosine: float, carry: bool) -> DataFrame:
    """``(key, home, block, vec_id[, label, copies, embedding])``: the home cell and the
    probed cells of each vector in each block."""
    fields = [("key", pa.int64()), ("home", pa.bool_()), ("block", pa.int32()), ("vec_id", pa.int64())]
    fields += [("label", pa.int64()), ("copies", pa.int64()), ("embedding", pa.list_(pa.float64()))] if carry else []
    schema = pa.schema(fields)

    def run(batches):
        for batch in batches:
            label = column(batch, "label").to_numpy()
            for rows, v in _rows(column(batch, "embedding")):
                dim = v.shape[1]
                turned = _scaled(v) @ rotation(dim)
                for k, (s, r) in enumerate(zip(blocks(dim), ranges(dim, cosine))):
                    x = turned[:, s][:, :LEADING]
                    home = np.floor(x / (CELL * r))
                    low, high = np.floor((x - r) / (CELL * r)), np.floor((x + r) / (CELL * r))
                    prefix = np.stack((label[rows] & (1 << 48) - 1, np.full(len(rows), dim), np.full(len(rows), k)), 1)
                    sets = [(True, np.arange(len(rows)), home)]
                    for ends in itertools.product((0, 1), repeat=x.shape[1]):
                        up = np.array(ends, bool)
                        fresh = ((low != high) | ~up).all(1)  # where both ends share a cell, it is probed once
                        sets.append((False, np.flatnonzero(fresh), np.where(up, high, low)[fresh]))
                    for is_home, at, cell in sets:
                        key = _mix(np.concatenate((prefix[at], cell), 1))
                        out = [key, np.full(len(at), is_home), np.full(len(at), k, np.int32)]
                        back = pa.array(rows[at])
                        names = ["vec_id", "label", "copies", "embedding"] if carry else ["vec_id"]
                        yield record(schema, out + [column(batch, n).take(back) for n in names])

    text = "key long, home boolean, block int, vec_id long"
    return vectors.mapInArrow(run, text + (", label long, copies long, embedding array<double>" if carry else ""))


def _spanning(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Edges that connect what the links between left and right ids connect."""
    big = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        new_a = np.minimum(a, np.where(linked, b, big).min(1, initial=big))
        new_b = np.minimum(b, np.where(linked, new_a[:, None], big).min(0, initial=big))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    edges = np.concatenate((np.stack((left, a), 1), np.stack((right, b), 1)))
    return np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)


def _compare(t: dict, cosine: float):
    """Link counts of the homes and spanning edges of one tile."""
    home = np.flatnonzero(t["home"])
    probe = np.flatnonzero(~t["home"])
    v = t["v"]
    dim, block = v.shape[1], int(t["block"][0])
    turned, far = _scaled(v) @ rotation(dim), [r * r for r in ranges(dim, cosine)]
    unit = _scaled(v)
    for h in (home[i:i + 512] for i in range(0, len(home), 512)):
        for p in (probe[i:i + 2048] for i in range(0, len(probe), 2048)):
            near = (t["vec_id"][h][:, None] != t["vec_id"][p]) & (t["label"][h][:, None] == t["label"][p])
            for k in [block, *range(block)]:
                s = blocks(dim)[k]
                x, y = turned[h][:, s], turned[p][:, s]
                d = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)
                near &= d <= far[k] if k == block else d > far[k]  # a pair counts in its first block only
                if not near.any():
                    break
            if near.any():
                i, j = np.nonzero(near)
                near[i, j] = (unit[h[i]] * unit[p[j]]).sum(1) >= cosine
                if near.any():
                    yield t["vec_id"][h], near @ t["copies"][p], _spanning(near, t["vec_id"][h], t["vec_id"][p])


def cell_links(rows: DataFrame, cosine: float) -> DataFrame:
    """``(a, b, n)``: b null, n links counted for a; or n null, a and b connected."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def closed(batch: pa.RecordBatch | pa.Table):
        batch = batch.combine_chunks().to_batches()[0]
        key = np.stack([column(batch, n).to_numpy() for n in ("key", "i", "j")], 1)
        edge = np.flatnonzero((np.diff(key, axis=0) != 0).any(1)) + 1
        home = column(batch, "home").to_numpy(zero_copy_only=False)
        flat = {n: column(batch, n).to_numpy() for n in ("block", "vec_id", "label", "copies")}
        for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(key)]):
            if e - s < 2 or home[s:e].all() or not home[s:e].any():
                continue
            for at, v in _rows(column(batch, "embedding").slice(s, e - s)):
                t = {n: x[s:e][at] for n, x in flat.items()} | {"home": home[s:e][at], "v": v}
                for ids, n, edges in _compare(t, cosine):
                    some = n > 0
                    a = np.concatenate((ids[some], edges[:, 0]))
                    none = some.sum()
                    yield record(schema, [a, pa.array(np.concatenate((np.zeros(none, np.int64), edges[:, 1])),
                                                      mask=np.arange(len(a)) < none),
                                          pa.array(np.concatenate((n[some], np.zeros(len(edges), np.int64))),
                                                   mask=np.arange(len(a)) >= none)])

    def run(batches):
        held: list = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            ends = [tuple(column(b, n)[i].as_py() for n in ("key", "i", "j")) for i in (0, b.num_rows - 1)]
            if ends[0] == ends[1]:
                if held and last != ends[0]:
                    yield from closed(pa.Table.from_batches(held))
                    held = []
                held.append(b)
            else:
                key = np.stack([column(b, n).to_numpy() for n in ("key", "i", "j")], 1)
                cut = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1
                held.append(b.slice(0, cut))
                yield from closed(pa.Table.from_batches(held))
                held = [b.slice(cut)]
            last = ends[1]
        if held:
            yield from closed(pa.Table.from_batches(held))

    return (rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(run, "a long, b long, n long"))


def links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(a, b, n)`` as of :func:`cell_links` for distinct ``vectors``."""
    rows = cells(vectors, cosine, carry=True)
    hot = materialise(cells(vectors, cosine, carry=False).groupBy("key").agg(
        F.count(F.when(F.col("home"), 1)).alias("h"), F.count(F.when(~F.col("home"), 1)).alias("p"))
        .where((F.col("h") > TILE) | (F.col("p") > TILE)), "vectors")
    if hot.isEmpty():
        return cell_links(rows.withColumns({"i": F.lit(0), "j": F.lit(0)}), cosine)
    # tiles: a home in part i of its cell goes to all parts of the probes, and the other way round
    parts = lambda n: F.coalesce(F.ceil(F.col(n) / TILE), F.lit(1)).cast("int")
    own = lambda n: F.pmod(F.xxhash64("vec_id"), parts(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), parts(n) - 1)
    tiled = rows.join(hot, "key", "left")
    tiled = (tiled.withColumn("i", F.explode(F.when(F.col("home"), F.array(own("h"))).otherwise(every("h"))))
             .withColumn("j", F.explode(F.when(F.col("home"), every("p")).otherwise(F.array(own("p"))))).drop("h", "p"))
    return cell_links(tiled, cosine)


def _label(embeddings: DataFrame) -> Column:
    """Whole numbers as they are; labels of other types by a 64-bit hash, null
    if null."""
    if isinstance(embeddings.schema["label"].dataType, IntegralType):
        return F.col("label").cast("long")
    return F.when(F.col("label").isNotNull(), F.xxhash64("label"))


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row for each vector."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), _label(embeddings).alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    key = [F.xxhash64(F.lit(s), "label", "embedding").alias(f"_h{s}") for s in (1, 2)]
    usable = F.coalesce(_usable(), F.lit(False))
    good = rows.where(usable)
    distinct = materialise(good.select("*", *key).groupBy("_h1", "_h2").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding")), "vectors")
    found = materialise(links(distinct, cosine), "vectors")
    roots = connected_components(found.where("b is not null").select("a", "b"))
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    told = (distinct.select("_h1", "_h2", "vec_id", "copies")
            .join(counts, F.col("vec_id") == F.col("a"), "left").join(roots, F.col("vec_id") == F.col("node"), "left")
            .select("_h1", "_h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("root", "vec_id").alias("component_id")))
    out = good.select("vec_id", *key).join(told, ["_h1", "_h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), r AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a
), c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.node AS vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.node = c.component_id AS kept
FROM c LEFT JOIN n ON n.a = c.node
"""

QUERIES = {"op4_embedding_near_dedup": query}
ORACLE = {"op4_embedding_near_dedup": SQL}
