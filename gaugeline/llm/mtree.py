"""Exact top-k by inner product with an M-tree and best-first search.

Vectors are rounded to whole numbers, floor(256 x). With M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and
q' = (q, 0), the distance |q' - x'| falls as the inner product rises: |q|^2 + M^2 - 2 q.x is its square. So
a metric tree over the x' answers the question.

The root holds `PIVOTS` routing vectors with covering radii (a bounded sample of the rows); each row goes to
the nearest. Nodes of more than `NODE_ROWS` rows are split again in the same way, by routing vectors of their own,
a level at a time over all nodes. What routing vectors can't split (equal vectors: a child keeps three quarters
of its node) is dealt to leaves by a hash. A leaf's rows are cut into pages of at most `PAGE` entries; a page is a
stored row with its routing vector, covering radius and distance to the leaf's vector, and for each entry the
distance to the page's. The pages are written once and read by all searches.

A query first goes to the leaf with the least bound, which gives it a k-th best score, and then to those branches
and, of these, those leaves that might beat it. Inside a leaf it takes the pages in order of their bounds, leaves out
pages and entries that the stored distances rule out by the triangle inequality, and stops when no bound can beat its
k-th score. A leaf that many queries visit is read by as many tasks as `QUERY_BLOCK` queries each make; a leaf
without a visit is not read.

Vectors that are null or hold a null or a non-finite component take no part, nor do rows without an id, nor
vectors with a component that is no 64-bit whole number after rounding (2^55 or more in size). Scores are
exact; a result of 2^63 - 1 or more in size, which doesn't fit a long, is an error. Shorter vectors count as filled up
with zeros. Rows with the query's id are its own and no candidates; ties go to the smaller id. Equal rows count once, and so
do rows of an id with the same score; an id with different vectors has a place for each score. An
empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import ship, stored

SCALE = 256
LARGEST = 2.0**63
PIVOTS = 32
NODE_ROWS = 8192
PAGE = 64
QUERY_BLOCK = 16384  # queries that one task tests against a leaf or a branch's list of leaves
DEAL_ROWS = 65536  # rows that one task deals to a node's children
ROUTED = 16384  # rows of a batch of visits, at most, or a query's own
NONE = np.iinfo(np.int64).min  # the score of a place without a candidate
LEAST, MOST = NONE + 1, np.iinfo(np.int64).max  # stand for scores that don't fit


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of every component, or null if the vector takes no part."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double") * SCALE) < LARGEST))
    return F.when(vector.isNotNull() & F.coalesce(fits, F.lit(False)), scaled)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of vectors in 64-bit whole numbers, little-endian."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), width)


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a and b; those that don't fit are LEAST or MOST."""
    largest = max(int(np.abs(a).max(initial=0)), 1) * max(int(np.abs(b).max(initial=0)), 1) * max(a.shape[1], 1)
    if largest < 1 << 52:  # every partial sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    whole = a @ b.T  # modulo 2^64, whatever the partial sums
    if largest >= 1 << 63:
        sizes = np.abs(a.astype(np.float64)) @ np.abs(b.astype(np.float64)).T
        for i, j in zip(*np.nonzero(sizes >= 2.0**62)):
            whole[i, j] = min(max(sum(x * y for x, y in zip(a[i].tolist(), b[j].tolist())), int(LEAST)), int(MOST))
    return whole


def _near_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in floating point, for bounds: the slack covers the rounding."""
    return a.astype(np.float64) @ b.T.astype(np.float64)


def _apart(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Distances between lifted vectors a' (rows) and b' (columns)."""
    lift = [np.sqrt(np.maximum(most - (x.astype(np.float64) ** 2).sum(axis=1), 0)) for x in (a, b)]
    square = 2.0 * most - 2 * (_near_products(a, b) + np.outer(*lift))
    return np.sqrt(np.maximum(square, 0))


def _from_queries(q: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    square = (q.astype(np.float64) ** 2).sum(axis=1)[:, None] + most - 2.0 * _near_products(q, b)
    return np.sqrt(np.maximum(square, 0))


def _once(order: np.ndarray, every: np.ndarray, names: np.ndarray) -> np.ndarray:
    """`order` with the second and further places of an id with the same score moved to the end and their scores set to NONE."""
    score, name = np.take_along_axis(every, order, axis=1), np.take_along_axis(names, order, axis=1)
    again = np.zeros(order.shape, bool)
    again[:, 1:] = (score[:, 1:] == score[:, :-1]) & (name[:, 1:] == name[:, :-1])
    np.put_along_axis(every, order, np.where(again, NONE, score), axis=1)
    return np.take_along_axis(order, np.argsort(again, axis=1, kind="stable"), axis=1)


def _slack(most: float) -> float:
    """Rounding in square roots of differences; scores are whole, so a slack costs no exactness."""
    return 1e-6 * np.sqrt(most + 1.0) + 1e-3


class Node:
    """A leaf: pages of entries around routing vectors, made from rows or read from stored pages."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, most: float):
        self.most = most
        order = np.lexsort((ids,))
        self.ids, self.rows = ids[order], rows[order]
        self.pages = self._split(np.arange(len(ids)))
        heads = np.array([p[0] for p in self.pages])
        self.heads = self.rows[heads]
        self.dists = [_apart(self.rows[p], self.rows[h : h + 1], most)[:, 0] for p, h in zip(self.pages, heads)]
        self.radii = np.array([d.max() for d in self.dists])
        # The leaf's vector: the row nearest to the middle of them all.
        middle = np.round(self.rows.mean(axis=0)).astype(np.int64)[None, :] if abs(self.rows).max(initial=0) < 1 << 52 else self.rows[:1]
        self.top = self.rows[[_apart(self.rows, middle, most)[:, 0].argmin()]]
        self.to_top = _apart(self.heads, self.top, most)[:, 0]
        self.radius = float(_apart(self.rows, self.top, most).max())
        self._ready()

    def _ready(self) -> None:
        self.repeated = len(np.unique(self.ids)) < len(self.ids)
        self.slack = _slack(self.most)

    def stored(self) -> list[dict]:
        """The pages as rows; the first holds the leaf's vector and radius."""
        out = []
        for p, head, dists, radius, to_top in zip(self.pages, self.heads, self.dists, self.radii, self.to_top):
            held = {"ids": self.ids[p].astype("<i8").tobytes(), "vectors": self.rows[p].astype("<i8").tobytes(), "dists": dists.astype("<f8").tobytes()}
            out.append(held | {"head": head.astype("<i8").tobytes(), "radius": float(radius), "to_top": float(to_top), "top": self.top.astype("<i8").tobytes()})
        return out

    @classmethod
    def read(cls, pages: list[dict], width: int, most: float) -> Node:
        node = cls.__new__(cls)
        node.most = most
        ids = [np.frombuffer(p["ids"], "<i8") for p in pages]
        ends = np.cumsum([len(i) for i in ids])
        node.ids = np.concatenate(ids)
        node.rows = np.frombuffer(b"".join(p["vectors"] for p in pages), "<i8").reshape(len(node.ids), width)
        node.pages = [np.arange(e - len(i), e) for e, i in zip(ends, ids)]
        node.dists = [np.frombuffer(p["dists"], "<f8") for p in pages]
        node.heads = np.frombuffer(b"".join(p["head"] for p in pages), "<i8").reshape(len(pages), width)
        node.top = np.frombuffer(pages[0]["top"], "<i8").reshape(1, width)
        node.radii, node.to_top = (np.array([p[c] for p in pages]) for c in ("radius", "to_top"))
        node._ready()
        return node

    def _split(self, at: np.ndarray) -> list[np.ndarray]:
        """Halves by the nearer of two routing entries until the pages are small; equal entries by count."""
        done, todo = [], [at]
        while todo:
            at = todo.pop()
            if len(at) <= PAGE:
                done.append(at)
                continue
            one = _apart(self.rows[at], self.rows[at[:1]], self.most)[:, 0]
            a = int(one.argmax())
            from_a = _apart(self.rows[at], self.rows[at[a : a + 1]], self.most)[:, 0]
            b = int(from_a.argmax())
            gap = from_a - _apart(self.rows[at], self.rows[at[b : b + 1]], self.most)[:, 0]
            by_gap = np.argsort(gap, kind="stable")
            cut = int((gap <= 0).sum())
            if not len(at) // 8 <= cut <= len(at) - len(at) // 8:
                cut = len(at) // 2
            todo += [at[np.sort(by_gap[:cut])], at[np.sort(by_gap[cut:])]]
        return done

    def search(self, qids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of shape queries x k; places without a candidate have the score NONE. Scores below a
        query's `floor` may be left out."""
        n = len(q)
        ids, scores = np.zeros((n, k), np.int64), np.full((n, k), NONE)
        norms = (q.astype(np.float64) ** 2).sum(axis=1) + self.most
        need = np.where(floor == NONE, -np.inf, floor.astype(np.float64))

        def reach() -> np.ndarray:
            """The distance beyond which nothing reaches the k-th score."""
            return np.sqrt(np.maximum(norms - 2 * need, 0)) + self.slack

        # First bounds from the distances kept in the tree alone, then those to the pages' own vectors
        # where the first don't rule the page out.
        to_top = _from_queries(q, self.top, self.most)
        first = np.abs(to_top - self.to_top[None, :]) - self.radii[None, :]
        to_page = np.full(first.shape, np.inf)
        for page in range(len(self.pages)):
            open_ = np.flatnonzero(first[:, page] <= reach())
            if len(open_):
                to_page[open_, page] = _from_queries(q[open_], self.heads[page : page + 1], self.most)[:, 0]
        bound = np.where(np.isinf(to_page), np.inf, np.maximum(to_page - self.radii[None, :], 0))
        order = np.argsort(bound, axis=1, kind="stable")
        active = np.arange(n)
        for step in range(order.shape[1]):
            page = order[active, step]
            alive = bound[active, page] <= reach()[active]
            active, page = active[alive], page[alive]
            if not len(active):
                break
            for p in np.unique(page):
                who = active[page == p]
                maybe = np.abs(to_page[who, p][:, None] - self.dists[p][None, :]) <= reach()[who][:, None]
                held = np.flatnonzero(maybe.any(axis=0))
                if not len(held):
                    continue
                entry = self.pages[p][held]
                own = self.ids[entry][None, :] == qids[who][:, None]
                found = np.where(own, NONE, _products(q[who], self.rows[entry]))
                named = np.broadcast_to(self.ids[entry], found.shape)
                every, names = np.concatenate([scores[who], found], axis=1), np.concatenate([ids[who], named], axis=1)
                # Highest score first, then smallest id; ~x reverses the order of whole numbers.
                best = np.lexsort((names, ~every), axis=1)
                if self.repeated:
                    best = _once(best, every, names)
                best = best[:, :k]
                scores[who], ids[who] = np.take_along_axis(every, best, axis=1), np.take_along_axis(names, best, axis=1)
                full = scores[who, k - 1] > NONE
                need[who[full]] = np.maximum(need[who[full]], scores[who[full], k - 1])
        return ids, scores


_PAGE = "ids binary, vectors binary, dists binary, head binary, radius double, to_top double, top binary"
_NO_LONG, _NO_BINARY = "CAST(NULL AS BIGINT)", "CAST(NULL AS BINARY)"


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) for neighbouring rows that agree in the first `keys` columns."""
    for batch in batches:
        change = np.zeros(batch.num_rows, bool)
        change[:1] = True
        for c in batch.columns[:keys]:
            codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= codes[1:] != codes[:-1]
        ends = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(ends, ends[1:]):
            yield tuple(c[a].as_py() for c in batch.columns[:keys]), batch.slice(a, b - a)


def _met(held: DataFrame, asked: DataFrame, key: str, work, schema: str) -> DataFrame:
    """`work` over groups by `key` and share: the rows of `held` first, those of `asked` behind them in a stream."""
    rows = held.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)))
    rows = rows.select(key, "share", "kind", *[c for c in rows.columns if c not in (key, "share", "kind")])
    return rows.repartition(key, "share").sortWithinPartitions(key, "share", "kind", "id").mapInArrow(work, schema)


def _shared(held: DataFrame, asked: DataFrame, key: str, of: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Both with `share`: the rows of a key asked for are cut into shares of about `size`, each of which meets the key's held rows.

    Keys that nothing asks for are left out of `held`. `asked` is read twice.
    """
    shares = asked.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("shares"))
    held = held.join(shares, key).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    return held, asked.join(shares, key).withColumn("share", F.pmod(F.xxhash64(of), F.col("shares")).cast("int")).drop("shares")


def _children(rows: DataFrame, width: int, most: float) -> DataFrame:
    """vec_id, v, before, node: each row of the nodes (rows: node, vec_id, v, n) with the child it goes to; before: the node's size."""
    # A routing vector for each of PIVOTS slots of a hash that holds rows, at least one a node.
    hashed = rows.withColumn("hash", F.xxhash64("vec_id", "v", "node")).withColumn("slot", F.pmod("hash", F.lit(PIVOTS)))
    least = hashed.groupBy("node", "slot").agg(F.min("hash").alias("hash"))
    pivots = hashed.join(least, ["node", "slot", "hash"]).dropDuplicates(["node", "slot"]).select("node", F.col("slot").alias("id"), "v", "n")
    held, asked = _shared(pivots, rows.select("node", F.col("vec_id").alias("id"), "v", "n"), "node", "id", DEAL_ROWS)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, slots, heads = None, [], []
        for (node, share, kind), run in _runs(batches, 3):
            if (node, share) != at:
                at, slots, heads = (node, share), [], []
            v = _vectors(run.column("v"), width)
            if kind == 0:
                slots += run.column("id").to_pylist()
                heads.append(v)
                continue
            near = _apart(v, np.concatenate(heads), most).argmin(axis=1)
            child = pa.array([f"{node}.{slots[i]}" for i in near.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([run.column("id"), run.column("v"), run.column("n"), child], names=["vec_id", "v", "before", "node"])

    return _met(held, asked, "node", dealt, "vec_id long, v binary, before long, node string")


def _leaves(level: DataFrame, width: int, most: float) -> DataFrame:
    """leaf, vec_id, v: the rows of `level` (node, vec_id, v, before) dealt down to leaves of about NODE_ROWS rows."""
    done = []
    while True:
        # One row for each node, an 8192nd of the rows or so at the last level.
        sizes = stored(level.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("before").alias("before")), "mtree-sizes")
        split = (F.col("n") > NODE_ROWS) & (F.col("n") * 4 <= F.col("before") * 3)
        sized = level.drop("before").join(sizes.withColumn("split", split).drop("before"), "node")
        part = F.pmod(F.xxhash64("vec_id", "v"), F.ceil(F.col("n") / NODE_ROWS))
        done.append(sized.where("NOT split").select(F.concat("node", F.lit(".p"), part.cast("string")).alias("leaf"), "vec_id", "v"))
        if sizes.where(split).isEmpty():
            break
        level = stored(_children(sized.where("split"), width, most), "mtree-level")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _pages(leaves: DataFrame, width: int, most: float) -> DataFrame:
    """leaf, radius_of_leaf (in its first page), and the columns of a page."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, rows = None, [], []

        def closed() -> pa.RecordBatch:
            node = Node(np.concatenate(ids), np.concatenate(rows), most)
            pages = node.stored()
            columns = [pa.array([at] * len(pages), pa.string()), pa.array([node.radius] + [None] * (len(pages) - 1), pa.float64())]
            names = [x.split()[0] for x in _PAGE.split(", ")]
            columns += [pa.array([p[c] for p in pages], pa.float64() if c in ("radius", "to_top") else pa.binary()) for c in names]
            return pa.RecordBatch.from_arrays(columns, names=["leaf", "leaf_radius", *names])

        for (leaf,), run in _runs(batches, 1):
            if leaf != at:
                if ids:
                    yield closed()
                at, ids, rows = leaf, [], []
            ids.append(run.column("vec_id").to_numpy())
            rows.append(_vectors(run.column("v"), width))
        if ids:
            yield closed()

    return leaves.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(cut, f"leaf string, leaf_radius double, {_PAGE}")


def _visit(pages: DataFrame, visits: DataFrame, width: int, most: float, k: int) -> DataFrame:
    """query_id, vec_id, score: what each visit (leaf, query_id, q, floor) finds in its leaf."""
    names = [x.split()[0] for x in _PAGE.split(", ")]
    held = pages.select("leaf", F.struct(*names).alias("page"), F.expr(f"{_NO_LONG} AS id"), F.expr(f"{_NO_BINARY} AS v"), F.expr(f"{_NO_LONG} AS floor"))
    asked = visits.select("leaf", F.lit(None).cast(held.schema["page"].dataType).alias("page"), F.col("query_id").alias("id"), F.col("q").alias("v"), "floor")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pages, node = None, [], None
        for (leaf, share, kind), run in _runs(batches, 3):
            if (leaf, share) != at:
                at, pages, node = (leaf, share), [], None
            if kind == 0:
                pages += run.column("page").to_pylist()
                continue
            if node is None:
                node, pages = Node.read(pages, width, most), []
            qids, floor = run.column("id").to_numpy(), run.column("floor").fill_null(int(NONE)).to_numpy()
            ids, scores = node.search(qids, _vectors(run.column("v"), width), floor, k)
            w, c = np.nonzero(scores > NONE)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (qids[w], ids[w, c], scores[w, c])], names=["query_id", "vec_id", "score"])

    return _met(*_shared(held, asked, "leaf", "id", QUERY_BLOCK), "leaf", found, "query_id long, vec_id long, score long")


def _routed(tops: DataFrame, queries: DataFrame, width: int, most: float, nearest: bool) -> DataFrame:
    """query_id, q, leaf, floor: for each query and branch (queries: branch, query_id, q, floor, skip) the leaf with the least
    bound, or all leaves but `skip` whose bound doesn't rule out a score of `floor`.

    tops: branch, leaf, top, leaf_radius. A branch's list of leaves is some NODE_ROWS * PIVOTS times shorter than the table.
    """
    held = tops.select("branch", "leaf", F.expr(f"{_NO_LONG} AS id"), F.col("top").alias("v"), F.col("leaf_radius").alias("radius"), F.expr(f"{_NO_LONG} AS floor"))
    asked = queries.select("branch", F.col("skip").alias("leaf"), F.col("query_id").alias("id"), F.col("q").alias("v"), F.lit(None).cast("double").alias("radius"), "floor")

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leaves, tops, radii = None, [], [], []
        for (branch, share, kind), run in _runs(batches, 3):
            if (branch, share) != at:
                at, leaves, tops, radii = (branch, share), [], [], []
            if kind == 0:
                leaves += run.column("leaf").to_pylist()
                tops.append(_vectors(run.column("v"), width))
                radii += run.column("radius").to_pylist()
                continue
            heads, names, numbers = np.concatenate(tops), np.array(leaves, object), {x: i for i, x in enumerate(leaves)}
            step = max(1, ROUTED // len(leaves))
            for part in (run.slice(i, step) for i in range(0, run.num_rows, step)):
                q = _vectors(part.column("v"), width)
                apart = _from_queries(q, heads, most)
                bound = np.maximum(apart - np.array(radii)[None, :] - _slack(most), 0)
                if nearest:
                    who, to = np.arange(len(q)), np.lexsort((apart, bound), axis=1)[:, 0]
                else:
                    floor = np.array([-np.inf if x is None else float(x) for x in part.column("floor").to_pylist()])
                    square = (q.astype(np.float64) ** 2).sum(axis=1) + most
                    open_ = bound <= np.sqrt(np.maximum(square - 2 * floor, 0))[:, None]
                    for i, x in enumerate(part.column("leaf").to_pylist()):
                        if x in numbers:
                            open_[i, numbers[x]] = False
                    who, to = np.nonzero(open_)
                taken = pa.array(who, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(taken), part.column("v").take(taken), pa.array(names[to].tolist(), pa.string()), part.column("floor").take(taken)], names=["query_id", "q", "leaf", "floor"]
                )

    return _met(*_shared(held, asked, "branch", "id", QUERY_BLOCK), "branch", routed, "query_id long, q binary, leaf string, floor long")


def top_k(vectors: DataFrame, k: int, every: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k best others."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), whole_numbers(F.col(vector)).alias("v"))
    rows = stored(rows.where("vec_id IS NOT NULL AND v IS NOT NULL").distinct(), "mtree-rows")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.max(norm).alias("most"), F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    most, width = facts.most or 0.0, facts.width or 0
    # Routing vectors of the root: a bounded sample in the order of a hash.
    pivots = [r.v for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(PIVOTS).collect()] or [[]]
    held = spark.sparkContext.broadcast(_matrix(pivots, width))

    @F.arrow_udf("struct<branch:int,apart:double,v:binary>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            own = _matrix(batch.to_pylist(), width)
            apart = _apart(own, held.value, most)
            at = apart.argmin(axis=1)
            packed = pa.array([r.astype("<i8").tobytes() for r in own], pa.binary())
            yield pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(apart[np.arange(len(at)), at], pa.float64()), packed], names=["branch", "apart", "v"])

    dealt = stored(rows.withColumn("at", nearest("v")).select("vec_id", "at.v", "at.branch", "at.apart"), "mtree-dealt")
    # At most PIVOTS rows.
    radii_of = {r.branch: r.radius for r in dealt.groupBy("branch").agg(F.max("apart").alias("radius")).collect()}
    radii = np.array([radii_of.get(b, -np.inf) for b in range(len(pivots))])
    slack = _slack(most)
    level = dealt.select("vec_id", "v", F.lit(facts.n).cast("bigint").alias("before"), F.col("branch").cast("string").alias("node"))
    pages = stored(_pages(_leaves(level, width, most), width, most), "mtree-pages")
    tops = pages.where("leaf_radius IS NOT NULL").select(F.substring_index("leaf", ".", 1).alias("branch"), "leaf", "top", "leaf_radius")
    queries = dealt.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))

    @F.arrow_udf("array<struct<branch:string,bound:double>>")
    def bounds(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """The branches that hold rows, nearest bound first; of equal bounds the one with the nearer vector."""
        for batch in batches:
            apart = _from_queries(_vectors(batch, width), held.value, most)
            least = np.maximum(apart - radii[None, :] - slack, 0)
            order = np.lexsort((apart, least), axis=1)
            yield pa.array([[{"branch": str(b), "bound": float(x[b])} for b in o if radii[b] >= 0] for x, o in zip(least, order)], pa.list_(pa.struct([("branch", pa.string()), ("bound", pa.float64())])))

    @F.arrow_udf("array<string>")
    def can_beat(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        """The branches whose bound doesn't rule out a score of `floor`. The bounds are less by the slack, which covers these roots too."""
        for q, floor, to in batches:
            square = (_vectors(q, width).astype(np.float64) ** 2).sum(axis=1) + most
            least = np.array([-np.inf if x is None else float(x) for x in floor.to_pylist()])
            reach = np.sqrt(np.maximum(square - 2 * least, 0))
            yield pa.array([[x["branch"] for x in branches if x["bound"] <= r] for branches, r in zip(to.to_pylist(), reach)], pa.list_(pa.string()))

    to_branches = stored(queries.withColumn("to", bounds("q")), "mtree-routed")
    first = to_branches.select("query_id", "q", F.get("to", F.lit(0))["branch"].alias("branch"), F.expr(f"{_NO_LONG} AS floor"), F.lit(None).cast("string").alias("skip"))
    first = stored(_routed(tops, first.where("branch IS NOT NULL"), width, most, nearest=True), "mtree-visits")
    best = stored(_visit(pages, first, width, most, k), "mtree-first")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # An id's rows with the same score, or those found for two rows of a query, are one place.
    kth = best.distinct().withColumn("nr", F.row_number().over(ranked)).where(F.col("nr") == k).select("query_id", F.col("score").alias("floor"))
    rest = to_branches.join(first.select("query_id", "q", F.col("leaf").alias("skip")), ["query_id", "q"], "left").join(kth, "query_id", "left")
    rest = rest.withColumn("to", can_beat("q", "floor", "to"))
    rest = rest.select("query_id", "q", "floor", "skip", F.explode("to").alias("branch"))
    rest = _routed(tops, stored(rest, "mtree-branches"), width, most, nearest=False)
    others = _visit(pages, stored(rest, "mtree-visits"), width, most, k)
    out = best.unionByName(others).distinct().withColumn("rank", F.row_number().over(ranked).cast("int"))
    fits = (F.col("score") > int(LEAST)) & (F.col("score") < int(MOST))
    score = F.when(fits, F.col("score")).otherwise(F.raise_error(F.concat(F.lit("a score doesn't fit a long, query "), F.col("query_id").cast("string"))).cast("bigint"))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
