r"""Lines that many documents share, found with levelled sorted runs of line hashes.

A line's key is the line without outer ASCII white space, A-Z lower-cased; its hash has 128 bits. A run
holds (d1, d2, docs): how many documents of some batches hold a key, written in buckets of the hash and
sorted by it. A new batch counts its keys, is merged with every run in an anti-join that takes out keys a
run has counted up already, and adds what is left as its own run. As soon as `FANOUT` runs of one level
stand next to each other they are compacted into one run of the next level, so that a store of b batches has
about FANOUT * log(b) runs. A batch is dealt out like the buckets, so that its merge moves no run; a compaction
moves each row once a level. A key is frequent when its counts over all runs reach `least`.

A run's folder is named by the batches it covers and counts once Spark has marked it complete; one inside a
larger one is ignored. A job that ends half way leaves the store as it was, and a store can be opened
again from its folder.

Rows are documents, whatever their ids: null or repeated ones change nothing, and copies count each. A null or
empty text is one empty line. Keys shorter than `shortest` code points are never frequent. A line at its
end without a line break counts like any other. An empty batch adds an empty run; an empty table gives no rows.
Other columns are kept as they are; `n_lines` and `n_dropped` get underscores in front where those names are taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm.common import fresh_name, ship, stored, whole_text

FANOUT = 4
# Frequent keys up to this number (16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 1 << 18
# Keys that a task counts before it passes them on.
_HELD_KEYS = 1 << 19
_BLANK = b" \t\n\x0b\x0c\r"


def key_digests(data: bytes, shortest: int = 1) -> list[bytes]:
    """The 16-byte hash of each line's key, empty for keys that are too short."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    keys = [line.strip(_BLANK) for line in data.lower().split(b"\n")]  # bytes: ASCII letters only
    if shortest <= 1:
        return [digest(k) if k or shortest < 1 else b"" for k in keys]
    return [digest(k) if len(k) >= shortest and len(k.decode("utf-8", "replace")) >= shortest else b"" for k in keys]


def key_counts(docs: DataFrame, text: str = "text", shortest: int = 1) -> DataFrame:
    """d1, d2, docs: in how many rows each key stands, summed up by task (a key has a row per task)."""
    ship(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def summed() -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(held), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0], pa.int64()), pa.array(halves[:, 1], pa.int64()), pa.array(held.values(), pa.int64())], names=["d1", "d2", "docs"]
            )

        for batch in batches:
            for x in batch.column(0):
                for key in set(key_digests(x.as_buffer().to_pybytes(), shortest)):
                    held[key] = held.get(key, 0) + 1
            held.pop(b"", None)
            if len(held) >= _HELD_KEYS:
                yield summed()
                held.clear()
        yield summed()

    return docs.select(whole_text(text).cast("binary").alias("data")).mapInArrow(counted, "d1 long, d2 long, docs long")


class LineRuns:
    """The runs in the folder `path`; `add` batches, then ask for `frequent` keys or `without` their lines."""

    def __init__(self, spark: SparkSession, path: str, least: int = 10, shortest: int = 1, buckets: int | None = None):
        self.spark, self.path, self.least, self.shortest = spark, path.rstrip("/"), least, shortest
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[tuple[int, int]]:
        """(first, last) batch of each run in use, in order."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = []
        for status in files.listStatus(folder) if files.exists(folder) else []:
            name = re.fullmatch(r"run-(\d+)-(\d+)", status.getPath().getName())
            if name and files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append((int(name[1]), int(name[2])))
        return sorted(r for r in found if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in found))

    def _folder(self, run: tuple[int, int]) -> str:
        return f"{self.path}/run-{run[0]}-{run[1]}"

    def _table(self, run: tuple[int, int]) -> str:
        """The run's name in the session's catalog, which knows its buckets."""
        return "line_run_" + re.sub(r"\W", "_", self._folder(run))

    def read(self, run: tuple[int, int]) -> DataFrame:
        name = self._table(run)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} (d1 BIGINT, d2 BIGINT, docs BIGINT) USING parquet "
                f"CLUSTERED BY (d1, d2) SORTED BY (d1, d2) INTO {self.buckets} BUCKETS LOCATION '{self._folder(run)}'"
            )
        return self.spark.table(name)

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        """One task for a bucket; `rows` are partitioned as buckets are."""
        writer = rows.write.mode("overwrite").bucketBy(self.buckets, "d1", "d2").sortBy("d1", "d2")
        writer.option("path", self._folder(run)).option("compression", "zstd").saveAsTable(self._table(run))

    def _summed(self, rows: DataFrame) -> DataFrame:
        """One row per key, dealt out like the buckets: the grouping needs no further exchange."""
        return rows.repartition(self.buckets, "d1", "d2").groupBy("d1", "d2").agg(F.sum("docs").alias("docs"))

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Take in a batch of documents."""
        runs = self.runs()
        at = runs[-1][1] + 1 if runs else 0
        fresh = self._summed(key_counts(docs, text, self.shortest))
        for run in runs:
            fresh = fresh.join(self.read(run).where(F.col("docs") >= self.least).hint("merge"), ["d1", "d2"], "left_anti")
        self._write(fresh, (at, at))
        self._compact()

    def _compact(self) -> None:
        """Replace the last FANOUT runs by one as long as they cover equally many batches."""
        while True:
            tail = self.runs()[-FANOUT:]
            if len(tail) < FANOUT or len({last - first for first, last in tail}) > 1:
                return
            self._write(self._summed(self._rows(tail)), (tail[0][0], tail[-1][1]))

    def _rows(self, runs: list[tuple[int, int]]) -> DataFrame:
        """The rows of several runs, read as plain files.

        A union of bucketed tables claims to be partitioned like them but isn't (Spark 4.1), and a grouping
        above it would miss rows. So a compaction deals its rows anew, each level once.
        """
        return self.spark.read.schema("d1 long, d2 long, docs long").parquet(*map(self._folder, runs))

    def frequent(self) -> DataFrame:
        """d1, d2 of the keys that `least` documents or more hold, over all batches."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], "d1 long, d2 long")
        return self._rows(runs).groupBy("d1", "d2").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= self.least).select("d1", "d2")

    def without(self, docs: DataFrame, text: str = "text", broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
        """`docs`, their texts without the lines of frequent keys, with n_lines (before) and n_dropped."""
        ship(self.spark)
        found = stored(self.frequent(), "frequent-lines")
        lines, dropped = fresh_name(docs, "n_lines"), fresh_name(docs, "n_dropped")
        data = whole_text(text).cast("binary")
        kept = "struct<text:string,n_lines:long,n_dropped:long>"
        if found.count() <= broadcast_keys:
            cut = F.arrow_udf(_cutter(self.spark, found, self.shortest), kept)(data)
            out = docs.withColumn(fresh_name(docs, "_cut"), cut)
        else:
            out = self._cut_by_join(docs, data, found, text, kept)
        cut = out.columns[-1]
        return out.select(
            *[F.col(cut)["text"].alias(c) if c == text else F.col(c) for c in docs.columns],
            F.col(cut)["n_lines"].alias(lines),
            F.col(cut)["n_dropped"].alias(dropped),
        )

    def _cut_by_join(self, docs: DataFrame, data, found: DataFrame, text: str, kept: str) -> DataFrame:
        """The same with any number of frequent keys: places of lines go to the keys, what is dropped goes back.

        Places belong to a text (by its hash), not to a row, so that copies of a text ask once per task.
        """
        shortest = self.shortest

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            for batch in batches:
                texts = {xxhash.xxh3_128_digest(d): d for d in (x.as_buffer().to_pybytes() for x in batch.column(0))}
                of, at, keys = [], [], []
                for digest, one in texts.items():
                    for place, key in enumerate(key_digests(one, shortest)):
                        if key:
                            of.append(digest)
                            at.append(place)
                            keys.append(key)
                t, d = (np.frombuffer(b"".join(x), "<i8").reshape(-1, 2) for x in (of, keys))
                columns = [pa.array(c, pa.int64()) for c in (t[:, 0], t[:, 1], d[:, 0], d[:, 1])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(at, pa.int32())], names=["t1", "t2", "d1", "d2", "at"])

        @F.arrow_udf("struct<t1:long,t2:long>")
        def text_digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import xxhash

            for batch in batches:
                halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.as_buffer()) for x in batch), "<i8").reshape(-1, 2)
                yield pa.StructArray.from_arrays([pa.array(halves[:, 0], pa.int64()), pa.array(halves[:, 1], pa.int64())], names=["t1", "t2"])

        places = docs.select(data.alias("data")).mapInArrow(placed, "t1 long, t2 long, d1 long, d2 long, at int")
        gone = places.join(found, ["d1", "d2"], "left_semi").groupBy("t1", "t2").agg(F.collect_set("at").alias("gone"))
        t, t1, t2, at = (fresh_name(docs, n) for n in ("_t", "_t1", "_t2", "_gone"))
        rows = docs.withColumn(t, text_digest(data))
        rows = rows.join(gone.select(F.col("t1").alias(t1), F.col("t2").alias(t2), F.col("gone").alias(at)), (F.col(t)["t1"] == F.col(t1)) & (F.col(t)["t2"] == F.col(t2)), "left")

        @F.arrow_udf(kept)
        def cut_at(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, places in batches:
                gone = [set(p) if p else set() for p in places.to_pylist()]
                yield _kept((x.as_buffer().to_pybytes().split(b"\n") for x in texts), gone)

        return rows.select(*docs.columns, cut_at(data, F.col(at)).alias(fresh_name(docs, "_cut")))


def _kept(texts, gone: list[set[int]]) -> pa.Array:
    """text, n_lines, n_dropped for texts in lines and the places to leave out."""
    out, n_lines, n_dropped = [], [], []
    for lines, places in zip(texts, gone):
        out.append((b"\n".join([x for i, x in enumerate(lines) if i not in places]) if places else b"\n".join(lines)).decode("utf-8", "replace"))
        n_lines.append(len(lines))
        n_dropped.append(len(places))
    return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=["text", "n_lines", "n_dropped"])


def _cutter(spark: SparkSession, found: DataFrame, shortest: int):
    """The function that cuts frequent lines, with the keys (a bounded number) broadcast to it."""
    rows = found.toArrow()
    halves = np.stack([rows.column(c).to_numpy() for c in ("d1", "d2")], axis=1).astype("<i8") if rows.num_rows else np.zeros((0, 2), "<i8")
    held = spark.sparkContext.broadcast(halves.tobytes())

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys = {held.value[i : i + 16] for i in range(0, len(held.value), 16)}
        for batch in batches:
            texts = [x.as_buffer().to_pybytes() for x in batch]
            gone = [{i for i, k in enumerate(key_digests(t, shortest)) if k in keys} for t in texts]
            yield _kept((t.split(b"\n") for t in texts), gone)

    return cut


def dropped_in_batches(docs: DataFrame, path: str, batches: int, least: int = 10, shortest: int = 1, text: str = "text") -> DataFrame:
    """`LineRuns.without` over a table that is taken in as `batches` batches, by the text's hash."""
    store = LineRuns(docs.sparkSession, path, least, shortest)
    for nr in range(batches):
        store.add(docs.where(F.pmod(F.xxhash64(text), F.lit(batches)) == nr), text)
    return store.without(docs, text)
