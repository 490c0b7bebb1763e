"""The Merkle manifest against plain trees, on awkward rows and with changed texts."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paywarden.llm import merkle, oracles, queries
from paywarden.llm.positions import numbered
from paywarden.llm.storage import saved
from tests.llm.test_operators import duck, same_rows


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves, fanout):
    """The root, and per leaf the nodes before and after it by level."""
    paths, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            first = k - k % fanout
            paths[i].append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + fanout])))
        nodes = [digest("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return nodes[0], paths


def plain_manifest(rows, fanout):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((row["doc_id"], digest("".join(field(row[c]) for c in merkle.LEAF_COLUMNS))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        leaves = sorted(by_source[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[source] = (leaves, *plain_tree([leaf for _, leaf in leaves], fanout))
    root, tops = plain_tree([trees[s][1] for s in order], fanout)
    found = []
    for source, top in zip(order, tops):
        leaves, subroot, paths = trees[source]
        found += [(i, leaf, subroot, root, tuple(path + top)) for (i, leaf), path in zip(leaves, paths)]
    return sorted(map(str, found))


def manifest_rows(docs):
    return sorted(
        str((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"])))
        for r in merkle.build_manifest(docs).collect()
    )


@pytest.mark.parametrize("fanout, levels", [(2, 1), (3, 2)])
def test_all_sizes_equal_plain_trees(spark, monkeypatch, fanout, levels):
    """Blocks are so small that the exchange has several rounds, with last subtrees of all sizes."""
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", fanout**levels)
    sizes = [1, 2, 3, 5, 6, 9, 17, 22, 37]
    rows = [(i, f"text {i} é", "en", f"s{k}", 5) for k, size in enumerate(sizes) for i in range(size)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert manifest_rows(docs) == plain_manifest(docs.collect(), fanout)


def test_awkward_rows_equal_plain_trees_and_sql(spark, tricky, tmp_path):
    assert manifest_rows(tricky) == plain_manifest(tricky.collect(), merkle.FANOUT)
    tricky.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duck({"documents": pa.table(tricky.toArrow())})
    sql = oracles.ORACLES["op11_merkle_manifest"]
    same_rows(queries.QUERIES["op11_merkle_manifest"](spark, str(tmp_path)), connection, sql)


def test_a_changed_text_is_found_and_no_other(spark, tricky):
    given = tricky.where("doc_id IS NOT NULL").select(*merkle.LEAF_COLUMNS)
    other = F.when(F.col("doc_id") == 9, merkle.leaf_digest(*[F.lit(c) for c in "abcde"]))
    manifest = merkle.build_manifest(given, {"shown": other})
    folded = manifest.withColumn("ok", merkle.fold(F.col("path"), F.coalesce("shown", "leaf")) == F.col("root"))
    assert {r["doc_id"] for r in folded.where("NOT ok").collect()} == {9}


def test_positions_spread_equal_rows(spark):
    """A group with most rows, all equal, is numbered without gaps by several tasks."""
    rows = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), F.lit(1).alias("x")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = numbered(saved(rows, "rows"), [F.col("x")], "g").collect()
        tasks = numbered(saved(rows, "rows"), [F.col("x")], "g").where("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by_group = {}
    for r in found:
        by_group.setdefault(r["g"], []).append((r["position"], r["total"]))
    assert sum(map(len, by_group.values())) == 4000 and tasks > 1
    for places in by_group.values():
        assert sorted(places) == [(i, len(places)) for i in range(len(places))]
