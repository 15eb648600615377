"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct shingles of five words. Each hash function (permutation) keeps its
smallest and its largest value over the set: two samples for one evaluation, each equal between two
sets with a chance of their Jaccard similarity. Bands of values make the buckets, as long as still
find a pair at the threshold but for one in a million: two sets of similarity 0.85 meet in one of 32
bands of six values, two of 0.8 in one of 38 bands of five, but for 3 pairs in 10 million each, more
similar ones more surely. Every link is confirmed on the full sets; candidates alone decide nothing.

Equal sets are one node from the start, so exact copies cost their rows only. Candidates are tested in
rounds, each over what the rounds before left in different components: first every node against the
first node it shares a bucket with, then against the first and last node of all its buckets, and
last all pairs of different components that still share a bucket. A family of near copies has
become one component by then. What is left, texts that are alike but not enough, is compared inside
the tasks, bucket by bucket in blocks; pairs are never rows. Blocks hold sketches of 192 bytes, one of
each value; texts follow only for nodes with a partner whose sketch allows a link (6 standard errors
below the threshold), and each pair is looked at in the first bucket it shares only.

Texts without words have the empty set and link with nothing. `deduplicated` works on ids: rows that share an
id are linked with each other, whatever their texts (those without words stay alone), and rows without an id link with
nothing (component null). `representatives` works on rows: a text without a copy is never lost, whatever its id,
and of rows that are alike one stays, a row with an id before one without. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import fresh_name, ship, stored, whole_text
from gaugeline.llm.components import components

SHINGLE = 5
BANDS = 32
PERMUTATIONS = 96  # 3 a band, with 2 values each
# A link: 100 * intersection >= least * union. This value is fixed for the query op8.
LEAST = 85
# Chance that a pair at the threshold shares no band, at most.
MISSED = 1e-6
# Nodes tested against one node in one task.
HUB_ROWS = 4096
# Nodes of a bucket in one block of the last round; a task compares two blocks, and texts of so many at a time.
BLOCK_ROWS = 512
TEXT_ROWS = 128
# Shingles of a comparison that are held at a time.
_HELD_SHINGLES = 1 << 21
# Nodes whose tables are worth a task and a file: a small corpus isn't spread over as many as the session has partitions.
NODES_A_TASK = 2000
# Shingles times permutations that are held at a time.
_CELLS = 1 << 18

_rng = np.random.default_rng(20240229)


def _odd(n: int) -> np.ndarray:
    return _rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE, _PLACE, _STEP = _odd(256), _odd(1024), _odd(1)[0]
_WORD, _SHORT = _odd(SHINGLE), _odd(SHINGLE + 1)
_SCALE, _SHIFT, _FOLD = _odd(PERMUTATIONS)[:, None], _odd(PERMUTATIONS)[:, None], _odd(PERMUTATIONS // BANDS * 2)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(data: bytes) -> np.ndarray:
    """The sorted set of 64-bit shingle hashes of a UTF-8 text, A-Z lower-cased."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~_BLANK[raw]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64)
    # Place of each byte in its word; blanks count for nothing.
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))) if starts[0] == 0 else None
    if place is None:
        raw, inside, starts = raw[starts[0] :], inside[starts[0] :], starts - starts[0]
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    weight = _PLACE[place & 1023] + (place >> 10).astype(np.uint64) * _STEP
    words = _mixed(np.add.reduceat(np.where(inside, _BYTE[_LOWER[raw]] * weight, np.uint64(0)), starts))
    n = len(words)
    if n < SHINGLE:
        return _mixed((words * _SHORT[:n]).sum(dtype=np.uint64, keepdims=True) + _SHORT[-1:] * np.uint64(n))
    total = np.zeros(n - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        total += words[k : n - SHINGLE + 1 + k] * _WORD[k]
    return np.unique(_mixed(total))


def signature(found: np.ndarray) -> np.ndarray:
    """Per permutation the smallest and the largest value: shape (PERMUTATIONS, 2)."""
    step = max(1, _CELLS // PERMUTATIONS)
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(found), step):
        values = found[None, at : at + step] * _SCALE + _SHIFT
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack([low, high], axis=1)


def values_a_band(least: int) -> int:
    """The most values a band may have, so that pairs at the threshold still meet."""
    for n in range(len(_FOLD), 0, -1):
        if (1 - (least / 100) ** n) ** (2 * PERMUTATIONS // n) <= MISSED:
            return n
    raise ValueError(f"{PERMUTATIONS} permutations don't find pairs of similarity {least} %")


def bands(values: np.ndarray, least: int = LEAST) -> np.ndarray:
    """One signed 64-bit key per band; the band's number is part of it."""
    size = values_a_band(least)
    count = values.size // size
    rows = values.reshape(-1)[: count * size].reshape(count, size)
    keys = _mixed((_mixed(rows) * _FOLD[:size]).sum(axis=1, dtype=np.uint64) + np.arange(count, dtype=np.uint64))
    return keys.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> bool:
    """Whether two sets are similar enough, exactly."""
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < least * large:
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= least * (len(a) + len(b) - both)


def least_matches(least: int) -> int:
    """How many of the sampled values agree at least between sets of that similarity, but for one pair in a billion."""
    share = least / 100
    return int(2 * PERMUTATIONS * share - 6 * (2 * PERMUTATIONS * share * (1 - share)) ** 0.5)


def sketches(docs: DataFrame, text: str, least: int = LEAST) -> DataFrame:
    """`docs` with _set: n, h1, h2 (128-bit digest of the set), bands, sketch (a byte of each value)."""
    ship(docs.sparkSession)

    @F.arrow_udf("struct<n:long,h1:long,h2:long,bands:array<long>,sketch:binary>")
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        for batch in batches:
            sizes, digests, keys, bits = [], [], [], []
            for x in batch:
                found = shingles(x.as_buffer().to_pybytes())
                values = signature(found) if len(found) else None
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                keys.append(None if values is None else bands(values, least))
                bits.append(None if values is None else (_mixed(values) & np.uint64(255)).astype(np.uint8).tobytes())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=["n", "h1", "h2", "bands", "sketch"],
            )

    return docs.withColumn(fresh_name(docs, "_set"), sketched(whole_text(text).cast("binary")))


def confirmed(pairs: DataFrame, texts: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; texts (node, data).

    Node a is a hub: its text goes once to each task that tests nodes against it, at most HUB_ROWS of
    them, and is followed there by theirs.
    """
    hubs = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).withColumn("salts", F.ceil(F.col("n") / HUB_ROWS))
    salted = pairs.join(hubs.select("a", "salts"), "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    members = salted.select("a", "salt", F.lit(1).alias("nr"), F.col("b").alias("node"))
    heads = hubs.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("nr"), F.col("a").alias("node"))
    rows = members.unionByName(heads).join(texts, "node").select("a", "salt", "nr", "node", "data")

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)  # a hub's text comes before those of its nodes
        for batch in batches:
            a, b = [], []
            for hub, _, nr, node, data in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingles(data)
                if nr == 0:
                    head = found
                elif linked(found, head, least):
                    a.append(hub)
                    b.append(node)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    grouped = rows.repartition(F.col("a"), F.col("salt")).sortWithinPartitions("a", "salt", "nr")
    return grouped.mapInArrow(tested, "a long, b long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets in a with all in b: a product of 0/1 matrices over the shared shingles.

    Shingles are taken by ranges of their hashes, so that a few are held at a time however long the texts are.
    """
    sets, total = [*a, *b], np.zeros((len(a), len(b)), np.float32)
    steps = max(1, -(-sum(map(len, sets)) // _HELD_SHINGLES))
    cuts = [(np.iinfo(np.uint64).max // steps) * k for k in range(1, steps)]
    places = [[0, *np.searchsorted(x, np.array(cuts, np.uint64)), len(x)] for x in sets]
    for step in range(steps):
        parts = [x[p[step] : p[step + 1]] for x, p in zip(sets, places)]
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in parts])
        _, column, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = times > 1
        number, keep = np.cumsum(shared) - 1, shared[column]
        owner, column = owner[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, int(shared.sum()), 4096):
            lo, hi = np.searchsorted(column, [at, at + 4096])
            part = np.zeros((len(sets), 4096), np.float32)
            part[owner[lo:hi], column[lo:hi] - at] = 1
            total += part[: len(a)] @ part[len(a) :].T
    return total.astype(np.int64)


def alike(one: list[tuple], two: list[tuple] | None, least: int = LEAST) -> list[tuple[int, bool]]:
    """(place, whether in the second block) of rows (component, n, sketch) with a partner that may be linked."""
    sides = [one, one if two is None else two]
    (c1, n1, s1), (c2, n2, s2) = ((np.array([r[0] for r in x]), np.array([r[1] for r in x]), np.frombuffer(b"".join([r[2] for r in x]), np.uint8).reshape(len(x), -1)) for x in sides)
    most, active = least_matches(least), np.zeros(len(sides[1]), bool)
    out = []
    for i in range(len(one)):
        fit = (c2 != c1[i]) & (100 * np.minimum(n2, n1[i]) >= least * np.maximum(n2, n1[i]))
        at = np.flatnonzero(fit)
        at = at[(s2[at] == s1[i]).sum(axis=1) >= most]
        if len(at):
            out.append((i, False))
            active[at] = True
    return out if two is None else out + [(int(j), True) for j in np.flatnonzero(active)]


def _block_links(key: int, one: list[tuple], two: list[tuple] | None, least: int = LEAST) -> Iterator[tuple[int, int]]:
    """Links between rows (node, component, shingles) of two blocks of a bucket, or within one."""
    rows = [*one, *(two or [])]
    keys = np.stack([bands(signature(r[2]), least) for r in rows])
    node, component, size = (np.array(x, np.int64) for x in ([r[0] for r in rows], [r[1] for r in rows], [len(r[2]) for r in rows]))
    first = range(0, len(one), TEXT_ROWS)
    second = range(len(one), len(rows), TEXT_ROWS) if two is not None else first
    for left_at in first:
        for right_at in second:
            if two is None and right_at < left_at:
                continue
            left = np.arange(left_at, min(left_at + TEXT_ROWS, len(one)))
            right = np.arange(right_at, min(right_at + TEXT_ROWS, len(rows) if two is not None else len(one)))
            small, large = np.minimum.outer(size[left], size[right]), np.maximum.outer(size[left], size[right])
            maybe = (component[left][:, None] != component[right][None, :]) & (100 * small >= least * large)
            if two is None:
                maybe &= left[:, None] < right[None, :]
            # Bands come in order; a pair that shares an earlier one is looked at there.
            for band in range(keys.shape[1]):
                same = keys[left, band][:, None] == keys[right, band][None, :]
                if (keys[:, band] == key).any():
                    maybe &= same
                    break
                maybe &= ~same
            i, j = np.nonzero(maybe)
            if len(i) <= 16:
                good = [linked(rows[left[x]][2], rows[right[y]][2], least) for x, y in zip(i, j)]
            else:
                both = overlaps([rows[x][2] for x in left], [rows[y][2] for y in right])[i, j]
                good = 100 * both >= least * (size[left[i]] + size[right[j]] - both)
            yield from ((int(node[left[x]]), int(node[right[y]])) for x, y, ok in zip(i, j, good) if ok)


_PAIR = ["key", "lo", "hi", "second"]


def _by_block_pair(batches: Iterator[pa.RecordBatch], row_of) -> Iterator[tuple[tuple, list[tuple], list[tuple] | None]]:
    """((key, lo, hi), rows, rows of the second block or None) from sorted rows key, lo, hi, second, ..."""
    at, sides = None, ([], [])
    for batch in batches:
        for key, lo, hi, second, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, lo, hi) != at:
                if at is not None:
                    yield at, sides[0], None if at[1] == at[2] else sides[1]
                at, sides = (key, lo, hi), ([], [])
            sides[second].append(row_of(*rest))
    if at is not None:
        yield at, sides[0], None if at[1] == at[2] else sides[1]


def links_within(rest: DataFrame, nodes: DataFrame, texts: DataFrame, tasks: int, least: int = LEAST) -> DataFrame:
    """Links (a, b) between nodes of different components in the same bucket.

    rest (key, node, component), nodes (node, n, sketch), texts (node, data); at most `tasks` tasks sift sketches.
    """
    sizes = rest.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    rows = rest.join(nodes.select("node", "n", "sketch"), "node").join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    pair = [F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).alias("second")]
    rows = rows.select("key", *pair, "node", "component", "n", "sketch")

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, one, two in _by_block_pair(batches, lambda *r: r):
            found = alike([r[1:] for r in one], None if two is None else [r[1:] for r in two], least) if one and (two is None or two) else []
            kept = [(two if second else one)[i] for i, second in found]
            columns = [[at[k]] * len(found) for k in range(3)] + [[second for _, second in found], [r[0] for r in kept], [r[1] for r in kept]]
            kinds = [pa.int64()] * 3 + [pa.bool_()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_PAIR, "node", "component"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, one, two in _by_block_pair(batches, lambda node, component, data: (node, component, shingles(data))):
            pairs = list(_block_links(at[0], one, two, least)) if one and (two is None or two) else []
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    grouped = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    active = stored(grouped.mapInArrow(sifted, "key long, lo long, hi long, second boolean, node long, component long").coalesce(tasks), "minhash-active")
    grouped = active.join(texts, "node").select(*_PAIR, "node", "component", "data")
    return grouped.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(compared, "a long, b long")


def _between(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, node, component of the buckets that still hold several components."""
    rows = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return rows.join(mixed, "key")


def _sets(found: DataFrame, least: int, ids: DataFrame | None = None) -> DataFrame:
    """h1, h2, first (the smallest doc_id), component of each distinct set of found (row, doc_id, data, set).

    ids: rows (doc_id, h1, h2) whose sets are linked, too, where they share an id.
    """
    some = found.where("set.n > 0").select("row", "doc_id", "set.*")
    nodes = some.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first"), F.min("row").alias("row"), F.min("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")
    )
    # Numbered as written: the numbers stay when a task is run again.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    tasks = 1 + nodes.count() // NODES_A_TASK
    keys = nodes.select("node", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    members = stored(keys.join(buckets, "key").coalesce(tasks), "minhash-members")
    # Every node against the first node it shares a bucket with.
    first = members.groupBy("node").agg(F.min("lo").alias("a"))
    wanted = nodes.select("node", "row").join(first.select("node"), "node", "left_semi")
    texts = stored(found.select("row", "data").join(wanted, "row").select("node", "data").coalesce(tasks), "minhash-texts")
    links = confirmed(first.where("a <> node").select("a", F.col("node").alias("b")), texts, least)
    if ids is not None:
        held = ids.join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("doc_id", "node")
        smallest = held.groupBy("doc_id").agg(F.min("node").alias("a"))
        links = links.union(held.join(smallest, "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct())
    links = stored(links.coalesce(tasks), "minhash-links")
    labels = components(links)
    # Against the first and the last node of each bucket, where the components differ.
    rest = stored(_between(members, labels).coalesce(tasks), "minhash-rest")
    ends = rest.select("node", "component", F.explode(F.array("lo", "hi")).alias("a")).where("a <> node").distinct()
    ends = ends.join(labels.select(F.col("node").alias("a"), F.col("component").alias("other")), "a", "left")
    ends = ends.where(F.coalesce("other", "a") != F.col("component")).select("a", F.col("node").alias("b"))
    links = stored(links.union(confirmed(ends, texts, least)).coalesce(tasks), "minhash-links")
    labels = components(links)
    # Nodes of different components that are left in one bucket.
    rest = stored(_between(rest.select("key", "node"), labels).select("key", "node", "component").coalesce(tasks), "minhash-rest")
    links = stored(links.union(links_within(rest, nodes, texts, tasks, least)).coalesce(tasks), "minhash-links")
    labels = components(links)
    return nodes.select("h1", "h2", "first", "node").join(labels, "node", "left").select("h1", "h2", "first", F.coalesce("component", "node").alias("component"))


def _stored_sketches(docs: DataFrame, doc_id: str, text: str, least: int, keep: list[str]) -> tuple[DataFrame, DataFrame, str]:
    """Columns `keep` with row numbers and sketches, written; row, doc_id, data, set of it; the row number's name."""
    own, row = fresh_name(docs, "_set"), fresh_name(docs, "_row")
    columns = list(dict.fromkeys([*keep, doc_id, text]))
    rows = stored(sketches(docs, text, least).select(*columns, own, F.monotonically_increasing_id().alias(row)), "minhash-sketches")
    found = rows.select(F.col(row).alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).cast("binary").alias("data"), F.col(own).alias("set"))
    return rows, found, row


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of `docs`; sets of a similarity of `least` % are linked."""
    _, found, _ = _stored_sketches(docs, doc_id, text, least, [])
    rows = found.select("doc_id", "set.n", "set.h1", "set.h2")
    named = rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "h1", "h2")
    several = named.groupBy("doc_id").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("h1", "h2") for f in (F.min, F.max)))
    several = stored(several.where("min_h1 <> max_h1 OR min_h2 <> max_h2").select("doc_id"), "minhash-several")
    ids = None if several.isEmpty() else named.join(several, "doc_id").distinct()
    sets = stored(_sets(found.where("doc_id IS NOT NULL"), least, ids), "minhash-sets")
    group = sets.join(sets.groupBy("component").agg(F.min("first").alias("component_id")), "component").select("h1", "h2", "component_id")
    out = rows.join(group, ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 80) -> DataFrame:
    """The rows of `docs` that stay: of each group of near-duplicate rows the one with the smallest id, all rows without words."""
    rows, found, row = _stored_sketches(docs, doc_id, text, least, docs.columns)
    sets, tasks = _sets(found, least).select("h1", "h2", "component"), 1 + rows.count() // NODES_A_TASK
    placed = stored(found.where("set.n > 0").select("row", "doc_id", "set.h1", "set.h2").join(sets, ["h1", "h2"]).select("component", "doc_id", "row").coalesce(tasks), "minhash-rows")
    kept = placed.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row"))
    gone = stored(placed.select("row").join(kept, "row", "left_anti").coalesce(tasks), "minhash-gone")
    return rows.join(gone.withColumnRenamed("row", row), row, "left_anti").select(*docs.columns)
