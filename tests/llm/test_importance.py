"""Importance resampling against a literal reading of the contract."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd

from gaugeline.llm import importance, queries

SF = "/root/testdata/sf0.01"
ASCII = {c: c + 32 for c in range(65, 91)}


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % 10_000 for r in runs]


def plain(rows, target, percent=5, least=20):
    """(doc_id, n_features, weight, score) of each row in order; the drawn places, best first."""
    found = [plain_features(t) for _, t in rows]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in plain_features(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000))))

    out = []
    for (doc, _), (_, f) in zip(rows, found):
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((i for i, (n, _) in enumerate(found) if n >= least), key=lambda i: (-out[i][3], -1 if out[i][0] is None else out[i][0]))
    return out, able[: percent * len(able) // 100]


def test_query_on_a_table(spark):
    docs, target = pd.read_parquet(f"{SF}/documents.parquet"), pd.read_parquet(f"{SF}/benchmark.parquet")
    rows, drawn = plain(list(zip(docs.doc_id.tolist(), docs.text)), target.text)
    rank = {rows[i][0]: n for n, i in enumerate(drawn, 1)}
    got = queries.QUERIES["op13_importance"](spark, SF)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, got.collect())) == sorted((*r, rank.get(r[0])) for r in rows)
    assert len(drawn) > 10


def test_odd_texts(spark):
    rng = random.Random(7)
    words = ["Ab", "cd", "é", "É", "0", "x́", "日本"]
    texts = [None, "", " ", "\n\n", "a", "a\nb", "a\nb\nc\nd", "a b\nc", "a\nb c", "a\n\n.\nb", "A-b_c\td\x00e", "long " * 60_000, "w" * 200_000, "line of text\n" * 5000]
    texts += [" ".join(rng.choice(words) + rng.choice(["", "\n", " \n ", ",", "\r\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    # A third of the rows share an id, some have none.
    rows = [(None if i % 11 == 0 else 3 if i % 3 == 0 else i, t) for i, t in enumerate(texts)]
    want, drawn = plain(rows, ["Ab cd\né", None, "日本 x"], percent=30)
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, rank int")
    target = spark.createDataFrame([("Ab cd\né", 1), (None, 2), ("日本 x", 3)], "text string, _own int")
    got = importance.resample(docs, target, percent=30)
    assert got.columns == ["doc_id", "text", "rank", "n_features", "weight", "score", "_rank"]
    found = sorted(got.collect(), key=lambda r: r["rank"])
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in found] == want
    assert [r.text for r in found] == texts
    # Rows that are equal in score and id may stand in for each other.
    assert [(r.doc_id, r.score) for r in sorted((r for r in found if r._rank), key=lambda r: r._rank)] == [(want[i][0], want[i][3]) for i in drawn]
    assert sorted(r._rank for r in found if r._rank) == list(range(1, len(drawn) + 1))


def test_segments_are_counted_once(spark):
    docs = spark.createDataFrame([("one two\nThree",), ("ONE, two\n\none two\nfour",), (None,)], "text string")
    found = importance.segments(docs).collect()
    assert sorted((r.times, r.n_words, len(r.buckets) // 2) for r in found) == [(1, 1, 1), (1, 1, 1), (3, 2, 3)]
    crossing = docs.transform(importance.outlines).select("_own.crossing", "_own.n_words").collect()
    assert [(r.n_words, len(r.crossing) // 2) for r in crossing] == [(3, 2), (5, 5), (0, 0)]


def test_crossing_runs_and_segments_are_all_runs():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("ab \n.") for _ in range(rng.randint(0, 40)))
        lines = importance.words_by_line(text.encode())
        parts = [importance.buckets(w) for w in lines] + [importance.crossing(lines)]
        words, want = plain_features(text)
        assert sorted(np.concatenate(parts).tolist()) == sorted(want)
        assert importance.n_runs(words) == len(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert importance.resample(none, some).collect() == []
    assert [tuple(r) for r in importance.resample(some, none, keep=["doc_id"]).collect()] == [(*plain([(1, "a b")], [])[0][0], None)]
