"""Importance resampling against plain counting, SQL, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from paywarden.llm import oracles, queries, resampling
from paywarden.llm.text_arrays import text_bytes
from tests.llm.test_operators import LOWER, SMALL, UPPER, duck, same_rows


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_resample(docs, target):
    def buckets(texts):
        return Counter(zlib.crc32(f.encode()) % 10_000 for text in texts for f in plain_features(text)[1])

    s, t = buckets(text for _, text in docs), buckets(target)
    total, wanted = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        words, features = plain_features(text)
        weight = 0
        for b in (zlib.crc32(f.encode()) % 10_000 for f in features):
            weight += math.floor(1000 * math.log((t[b] + 1.0) * (total + 10_000) / ((s[b] + 1.0) * (wanted + 10_000))))
        h = int(hashlib.sha256(f"42:{chr(92) + 'N' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(features), weight, score, None, len(words)])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for rank, row in enumerate(fit[: 5 * len(fit) // 100], 1):
        row[4] = rank
    return sorted(str(tuple(r[:5])) for r in rows)


def rows_of(frame):
    return sorted(str(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank"))) for r in frame.collect())


def test_query_equals_plain_counting(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = queries.op13_importance_resampling(spark, SMALL)
    assert rows_of(found) == plain_resample(docs, target)


def test_awkward_rows_equal_plain_counting_and_sql(spark, tricky, tmp_path):
    more = tricky.unionByName(tricky.where("doc_id = 8")).unionByName(tricky.where("doc_id = 1"))
    target = spark.createDataFrame([(1, "word1 WORD2\nword3 é"), (None, None), (2, ""), (3, "same\n\nline here")], "item_id long, text string")
    plain = plain_resample([(r["doc_id"], r["text"]) for r in more.collect()], [r["text"] for r in target.collect()])
    assert rows_of(resampling.resample(more, target)) == plain
    more.write.parquet(f"{tmp_path}/documents.parquet")
    target.write.parquet(f"{tmp_path}/benchmark.parquet")
    tables = duck({"documents": pa.table(more.toArrow()), "benchmark": pa.table(target.toArrow())})
    same_rows(queries.op13_importance_resampling(spark, str(tmp_path)), tables, oracles.ORACLES["op13_importance_resampling"])


def test_all_ranks_are_drawn_and_repeated_rows_have_one_each(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(7, text)] * 50 + [(i, text) for i in range(10)], "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    rows = resampling.resample(docs, target, percent=50).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 31))


def test_counts_by_line_equal_counts_by_text(spark):
    """Short, blank and repeated lines, so that runs cross one line end and two."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "B", " ", "\n", "cc d", "é-", "\r\n", " "]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(4)
    found = {r["bucket"]: r["n"] for r in resampling.feature_counts(frame).collect()}
    assert found == Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in plain_features(t)[1])


def test_checksums_equal_the_library():
    rng = random.Random(4)
    words = ["w" * n for n in (1, 2, 63, 64, 65, 66, 129, 700)] + [
        "".join(rng.choice("abz09é漢") for _ in range(rng.randint(1, 90))) for _ in range(200)
    ]
    rng.shuffle(words)
    data, offsets = text_bytes(pa.array([" ".join(words), "", "lone"]))
    _, owner, runs = resampling.word_runs(data, offsets)
    assert list(np.bincount(owner, minlength=3)) == [len(words), 0, 1]
    for size, (first, buckets) in enumerate(runs, 1):
        runs_of_text = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] + ["lone"] * (size == 1)
        assert [zlib.crc32(r.encode()) % 10_000 for r in runs_of_text] == list(buckets) and len(first) == len(buckets)
