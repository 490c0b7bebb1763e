"""Exact Jaccard join of word shingles by grouped prefixes, and the components of its links.

A document's set is its different runs of five words; two documents link if
``100 * intersection >= PERCENT * union``. Equal sets are one class from the
start, known by size and a 128-bit sum of its shingle hashes.

1. Sieve. In the order of their hashes, linked sets share ``l`` of their first
   ``n - t + l`` shingles, where ``t`` are needed in the intersection. Classes
   too few of whose first shingles occur in any other class have no link and
   leave. Only these shingles are shuffled, packed by hash bucket; a task sends
   a shingle that it sees more than once a single time.
2. Order. The shingles of the remaining classes are counted in a sketch of
   fixed size, summed over all tasks. Rare first, then by hash, is a total
   order, so prefixes stay exact whatever the sketch's error.
3. Grouped prefix join. Classes with the same prefix and size are one group.
   Groups meet through a shared shingle of their prefixes if size and position
   leave room for the needed intersection. Each group is verified against one
   group of each of its shingles, that with the fewest rarer shingles before it
   (of near copies the one least edited), then every pair of groups that is not
   yet in one component; groups are expanded and their members verified.
4. Components of the links, and of the copies of each class.

So a passage that many documents share is last in the order and joins nothing,
and near copies of one document cost a few comparisons each, not one per pair.

Hashes have 64 bits; different shingles are taken for equal with a chance that
does not matter at any size (2^-64 a pair).

Nulls: a null or empty text has no shingles and no links; a row with a null id
is returned with the component null and links nothing. Rows that repeat an id
or a text are returned as often; an id with two texts is in both components,
each row with its own. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paywarden.llm.components import connected_components
from paywarden.llm.storage import saved, small
from paywarden.llm.text_arrays import BLANK_BYTES, FOLDED, mixed, runs_of, slices, words_in

SHINGLE = 5
PERCENT = 80
# Buckets of the sieve for each shuffle partition.
BUCKETS_PER_PARTITION = 32
# A shingle in this many prefixes, or a component of this many rows, is joined apart from the others, without a
# shuffle of its rows: there is one of them in so many rows at most.
HOT = 1_000
# Shingles that a task gathers before it sends them.
GATHERED = 600_000
SKETCH_BITS = 20
SKETCH_PARTS = 256
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def needed(n: np.ndarray) -> np.ndarray:
    """The least intersection of a set of ``n`` with any set it links to: ``ceil(PERCENT * n / 100)``."""
    return -(-PERCENT * n // 100)


def extra(n: np.ndarray) -> np.ndarray:
    """Shared shingles asked for by the sieve; larger sets can be asked for more."""
    return 1 + n // 12


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch with the sorted sets of their texts: batch, first row, rows, bounds, hashes."""
    for batch in batches:
        for first, end, data, offsets in slices(batch.column("text")):
            words = words_in(data, offsets, BLANK_BYTES, FOLDED)
            hashes, at = runs_of(words, SHINGLE)
            owner = words.owner[at]
            few = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
            if len(few):
                whole = np.zeros(len(few), np.uint64)
                for k in range(SHINGLE - 1):
                    has = words.counts[few] > k
                    whole[has] = whole[has] * _GOLDEN + words.hashes[words.first[few][has] + k]
                hashes = np.concatenate([hashes, mixed(whole + words.counts[few].astype(np.uint64))])
                owner = np.concatenate([owner, few])
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            if len(hashes):
                new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
                hashes, owner = hashes[new], owner[new]
            yield batch, first, end - first, np.searchsorted(owner, np.arange(end - first + 1)), hashes


def signatures(bounds: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; the first, with the size mixed in, numbers the class."""
    one, two = np.zeros((2, len(hashes) + 1), np.uint64)
    np.cumsum(mixed(hashes), out=one[1:])
    np.cumsum(mixed(hashes ^ _GOLDEN), out=two[1:])
    sizes = np.diff(bounds).astype(np.uint64)
    return (
        mixed(one[bounds[1:]] - one[bounds[:-1]] + sizes * _GOLDEN).view(np.int64),
        (two[bounds[1:]] - two[bounds[:-1]]).view(np.int64),
    )


def describe_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, first, n, bounds, hashes in shingle_sets(batches):
        one, two = signatures(bounds, hashes)
        ids = batch.column("doc_id").slice(first, n)
        sizes = np.diff(bounds).astype(np.int64)
        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (sizes, one, two))], ["doc_id", "n", "class", "check"])


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, set size ``n``, ``class`` and ``check`` of each row."""
    given = docs.select("doc_id", "text")
    fields = [StructField(name, LongType()) for name in ("n", "class", "check")]
    return given.mapInArrow(describe_sets, StructType([given.schema["doc_id"], *fields]))


def pack_first_shingles(buckets: int):
    """A function for ``mapInArrow``: the first shingles of each set, packed by bucket of their hash.

    Rows are ``bucket``, ``hashes``, ``classes`` and ``shared``: whether the
    task has seen the shingle in several classes. Those classes' counts are
    sent directly, as rows of ``class`` and ``seen``.
    """
    fields = ["bucket", "hashes", "classes", "shared", "class", "seen"]

    def packed(hashes: np.ndarray, classes: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((classes, hashes))
        hashes, classes = hashes[order], classes[order]
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (classes[1:] != classes[:-1])])
        hashes, classes = hashes[new], classes[new]
        start = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        several = np.diff(np.append(start, len(hashes))) > 1
        inside = np.repeat(several, np.diff(np.append(start, len(hashes))))
        ids, seen = np.unique(classes[inside], return_counts=True)
        nothing = pa.nulls(len(ids), pa.binary())
        if len(ids):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(ids), pa.int64()), nothing, nothing, nothing, pa.array(ids), pa.array(seen)], fields
            )
        hashes, classes = hashes[start], classes[start]
        # Hashes are sorted, and so are the buckets, their leading bits.
        bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        numbers, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(hashes))
        columns = [
            pa.array([part[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())
            for part in (hashes, classes, several)
        ]
        none = pa.nulls(len(numbers), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int64)), *columns, none, none], fields)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        classes: list[np.ndarray] = []
        gathered = 0
        for _, _, _, bounds, all_hashes in shingle_sets(batches):
            sizes = np.diff(bounds)
            take = np.where(sizes > 0, sizes - needed(sizes) + extra(sizes), 0)
            place = np.arange(len(all_hashes)) - np.repeat(bounds[:-1], sizes)
            kept = place < np.repeat(take, sizes)
            one, _ = signatures(bounds, all_hashes)
            hashes.append(all_hashes[kept])
            classes.append(np.repeat(one, sizes)[kept])
            gathered += len(hashes[-1])
            if gathered >= GATHERED:
                yield from packed(np.concatenate(hashes), np.concatenate(classes))
                hashes, classes, gathered = [], [], 0
        if gathered:
            yield from packed(np.concatenate(hashes), np.concatenate(classes))

    return pack


PACKED = "bucket long, hashes binary, classes binary, shared binary, class long, seen long"


def count_shared(table):
    """Of one bucket: each class with the number of its shingles that another task or class has, too."""

    def read(name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    hashes, classes, shared = read("hashes", np.uint64), read("classes", np.int64), read("shared", bool)
    order = np.lexsort((classes, hashes))
    hashes, classes, shared = hashes[order], classes[order], shared[order]
    start = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    length = np.diff(np.append(start, len(hashes)))
    differs = np.minimum.reduceat(classes, start) != np.maximum.reduceat(classes, start)
    found = np.repeat(differs | np.logical_or.reduceat(shared, start), length)
    # A task that saw the shingle in several classes has counted it for them already.
    ids, seen = np.unique(classes[found & ~shared], return_counts=True)
    return pa.table({"class": ids, "seen": seen})


def sieve(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The classes that may have a link: ``class`` and a document of it, as a written table.

    A class of which two tasks hold copies may count a shingle several times;
    that keeps a class too many at worst.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.where("doc_id is not null").select("text").mapInArrow(
        pack_first_shingles(BUCKETS_PER_PARTITION * partitions), PACKED
    )
    packed = packed.repartition(partitions, F.coalesce("bucket", "class"))
    direct = packed.where("bucket is null").select("class", "seen")
    counted = (
        packed.where("bucket is not null").groupBy("bucket").applyInArrow(count_shared, "class long, seen long")
    )
    seen = counted.union(direct).groupBy("class").agg(F.sum("seen").alias("seen"))
    # The partner may be smaller: it is asked for as many as a set of PERCENT of the size.
    least = F.lit(1) + F.floor(F.ceil(F.col("n") * PERCENT / 100) / 12)
    return saved(
        sets.where("doc_id is not null and n > 0")
        .groupBy("class", "check", "n")
        .agg(F.min("doc_id").alias("doc_id"))
        .join(seen, "class")
        .where(F.col("seen") >= least)
        .select("class", "n", "doc_id"),
        "jaccard-classes",
    )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, _, bounds, hashes in shingle_sets(batches):
        one, _ = signatures(bounds, hashes)
        listed = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(one), listed], ["class", "shingles"])


def sets_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``class``, ``n`` and ``shingles`` of each remaining class, as a written table of one row per class."""
    chosen = docs.select("doc_id", "text").join(small(classes.select("doc_id")), "doc_id", "left_semi")
    listed = chosen.select("text").mapInArrow(full_sets, "class long, shingles array<bigint>")
    # A repeated id brings other texts along; they leave, and so do repeated rows.
    written = saved(listed.join(small(classes.select("class")), "class", "left_semi"), "jaccard-sets")
    if written.count() > written.select("class").distinct().count():
        written = saved(written.dropDuplicates(["class"]), "jaccard-sets")
    return written.withColumn("n", F.size("shingles").cast("bigint"))


def sketch_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts of hash prefixes, as packed parts of the sketch."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        hashes = batch.column("shingles").flatten().to_numpy().view(np.uint64)
        counts += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
    for part, values in enumerate(counts.reshape(SKETCH_PARTS, -1)):
        if values.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([values.astype(np.int32).tobytes()], pa.binary())], ["part", "counts"]
            )


def sum_part(table):
    counts = sum(np.frombuffer(value, np.int32).astype(np.int64) for value in table.column("counts").to_pylist())
    return pa.table({"part": table.column("part")[:1], "counts": pa.array([counts.tobytes()], pa.binary())})


def sketch_of(sets: DataFrame) -> np.ndarray:
    """How often each hash prefix occurs in all sets: ``2^SKETCH_BITS`` numbers, whatever the input."""
    parts = sets.select("shingles").mapInArrow(sketch_parts, "part long, counts binary")
    summed = parts.groupBy("part").applyInArrow(sum_part, "part long, counts binary").collect()
    sketch = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for row in summed:
        sketch[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return sketch.ravel()


def prefix_rows(sketch: Broadcast):
    """A function for ``mapInArrow``: ``class``, ``n``, hash of the prefix, and its shingles in order."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            listed = batch.column("shingles")
            bounds, hashes = listed.offsets.to_numpy(), listed.values.to_numpy().view(np.uint64)
            rows, keys = [], np.empty(batch.num_rows, np.int64)
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                own = hashes[a:b]
                often = counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                first = own[np.lexsort((own, often))[: b - a - needed(b - a) + 1]]
                key = mixed(first * _GOLDEN + np.arange(len(first), dtype=np.uint64)).sum(dtype=np.uint64)
                rows.append(first.view(np.int64))
                keys[i] = np.array([key], np.uint64).view(np.int64)[0]
            sizes = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("n"), pa.array(keys), lists], ["class", "n", "key", "prefix"]
            )

    return prefixes


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (classes ``a``, ``b``) whose sets meet the threshold."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - shared
    return pairs.join(left, "a").join(right, "b").where(shared * 100 >= union * PERCENT).select("a", "b")


def room(n: Column, other: Column, at: Column, other_at: Column) -> Column:
    """Whether sizes and positions allow the needed intersection if this is the first shingle a pair shares.

    Then all they share stands at it or behind it. A pair that links is found
    through its first shared shingle, so rows of later ones need not pass.
    """
    behind = F.least(n - at, other - other_at)
    lengths = F.least(n, other) * 100 >= F.greatest(n, other) * PERCENT
    return lengths & (behind * (100 + PERCENT) >= (n + other) * PERCENT)


def links_of(sets: DataFrame) -> DataFrame:
    """Enough links between classes to connect every component: ``a``, ``b``, as a written table."""
    sketch = sets.sparkSession.sparkContext.broadcast(sketch_of(sets))
    prefixes = saved(
        sets.mapInArrow(prefix_rows(sketch), "class long, n long, key long, prefix array<bigint>"), "jaccard-prefixes"
    )
    # Classes with the same prefix and size are one group, led by the smallest.
    groups = prefixes.groupBy("n", "key").agg(F.min("class").alias("lead"), F.first("prefix").alias("prefix"))
    members = prefixes.select("n", "key", "class").join(groups.select("n", "key", "lead"), ["n", "key"])
    members = saved(members.select("class", "lead"), "jaccard-members")
    postings = saved(groups.select("lead", "n", F.posexplode("prefix").alias("at", "shingle")), "jaccard-prefixes")
    lists = postings.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("held"), F.min(F.struct("at", "lead", "n")).alias("head")
    )
    lists = saved(lists.where("held > 1"), "jaccard-lists")
    hot = small(lists.where(F.col("held") >= HOT))
    usual = postings.join(hot.select("shingle"), "shingle", "left_anti").join(lists.where(F.col("held") < HOT), "shingle")
    met = saved(
        postings.join(hot, "shingle").unionByName(usual).select("shingle", "lead", "n", "at", "head"),
        "jaccard-postings",
    )
    head = met.where(F.col("lead") != F.col("head.lead")).where(
        room(F.col("n"), F.col("head.n"), F.col("at"), F.col("head.at"))
    )
    stars = head.select(F.col("lead").alias("a"), F.col("head.lead").alias("b")).distinct()
    inside = members.where("class <> lead").select(F.col("class").alias("a"), F.col("lead").alias("b"))
    first = saved(linked(stars.union(inside), sets), "jaccard-links")
    return saved(first.union(remaining(met, members, first, sets)), "jaccard-links")


def remaining(met: DataFrame, members: DataFrame, first: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components of the first links, among all pairs of groups that share a shingle."""
    labels = connected_components(first)
    component = F.coalesce("component", "class")
    named = saved(
        members.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
            "class", "lead", component.alias("component")
        ),
        "jaccard-named",
    )
    # A group may be spread over components; a list with one component in all has no pair left.
    spread = named.groupBy("lead").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = met.select("shingle", "lead", "n", "at").join(spread, "lead")
    mixed_lists = (
        placed.groupBy("shingle")
        .agg(F.min("low").alias("least"), F.max("high").alias("most"), F.min(F.struct("at", "lead", "low")).alias("first"))
        .where("least <> most")
        .select("shingle", F.col("first.low").alias("main"))
    )
    settled = (F.col("low") == F.col("main")) & (F.col("high") == F.col("main"))
    left = saved(placed.join(mixed_lists, "shingle").withColumn("settled", settled), "jaccard-left")
    # Groups inside a list's main component are not compared with each other.
    x, y = left.where("not settled").alias("x"), left.alias("y")
    apart = (F.col("x.low") != F.col("y.low")) | (F.col("x.high") != F.col("y.high")) | (
        F.col("x.low") != F.col("x.high")
    )
    once = F.col("y.settled") | (F.col("x.lead") < F.col("y.lead"))
    fits = room(F.col("x.n"), F.col("y.n"), F.col("x.at"), F.col("y.at"))
    same = (F.col("x.shingle") == F.col("y.shingle")) & once
    groups = x.join(y, same & apart & fits).select(F.col("x.lead").alias("g"), F.col("y.lead").alias("h")).distinct()
    within = spread.where("low <> high").select(F.col("lead").alias("g"), F.col("lead").alias("h"))
    a = named.select(F.col("class").alias("a"), F.col("lead").alias("g"), F.col("component").alias("ca"))
    b = named.select(F.col("class").alias("b"), F.col("lead").alias("h"), F.col("component").alias("cb"))
    pairs = groups.union(within).join(a, "g").join(b, "h").where("ca <> cb and a <> b")
    return linked(pairs.select("a", "b").distinct(), sets)


def described_components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n``, ``class`` and ``component_id`` of each row, as the module describes."""
    sets = saved(described(docs), "jaccard-described")
    classes = sieve(docs, sets)
    labels = connected_components(links_of(sets_of(docs, classes))).withColumnsRenamed(
        {"node": "class", "component": "group"}
    )
    placed = sets.join(small(labels), "class", "left").withColumn("group", F.coalesce("group", "class"))
    linkable = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    lowest = (
        placed.where(linkable)
        .groupBy("group")
        .agg(F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("rows"))
        # A component of one row is its own smallest id; only others are joined back.
        .where("rows > 1")
        .select("group", "lowest", "rows")
    )
    lowest = saved(lowest, "jaccard-lowest")
    hot = small(lowest.where(F.col("rows") >= HOT).select("group", F.col("lowest").alias("hot")))
    usual = lowest.where(F.col("rows") < HOT).select("group", "lowest")
    split = placed.join(hot, "group", "left")
    asking = linkable & F.col("hot").isNull()
    settled = split.where(~asking).withColumn("lowest", F.when(linkable, F.col("hot")))
    joined = settled.unionByName(split.where(asking).join(usual, "group", "left"))
    return joined.select("doc_id", "n", "class", F.coalesce("lowest", "doc_id").alias("component_id"))


def similar_components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs``."""
    return described_components(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def with_class(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with the class of each row's text."""

    def classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, n, bounds, hashes in shingle_sets(batches):
            rows = batch.slice(first, n)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(signatures(bounds, hashes)[0])], [*rows.schema.names, column]
            )

    return docs.mapInArrow(classified, StructType([*docs.schema.fields, StructField(column, LongType())]))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component, that of the smallest id, with the columns of ``docs``.

    Rows without shingles or id are in no component and stay. Only the ids of
    rows that leave are joined; if ids are repeated, rows are told apart by
    their texts, too.
    """
    placed = saved(described_components(docs), "jaccard-placed")
    linked_rows = placed.where("doc_id is not null and n > 0")
    ids = linked_rows.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    if ids[0] == ids[1]:
        leaving = saved(linked_rows.where("doc_id <> component_id").select("doc_id"), "jaccard-leaving")
        return docs.join(small(leaving), "doc_id", "left_anti").select(*docs.columns)
    first = linked_rows.where("doc_id = component_id").groupBy("doc_id").agg(F.min("class").alias("class"))
    rows = with_class(docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text"), "class")
    alone = F.col("doc_id").isNull() | F.col("class").isin(empty_class())
    kept = rows.where(~alone).join(first, ["doc_id", "class"], "left_semi").dropDuplicates(["doc_id", "class"])
    return kept.select("_row").union(rows.where(alone).select("_row")).select("_row.*")


def empty_class() -> int:
    """The class of a text without shingles."""
    return int(signatures(np.zeros(2, np.int64), np.empty(0, np.uint64))[0][0])
