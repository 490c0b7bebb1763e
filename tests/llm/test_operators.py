"""Each operator on awkward rows, on an empty table, and against brute force or SQL."""

import base64
import bz2
import gzip
import hashlib
import itertools
import json
import lzma
import random
import re
import timeit
import urllib.parse
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paywarden.llm import decontamination, jaccard_join, license_scan, mixing, oracles, quality_ranking, queries, toxicity
from paywarden.llm.line_dedup import drop_boilerplate, host_of, page_text
from paywarden.llm.quality_rules import judge_documents
from paywarden.llm.secret_scan import Scan, expanded, scan_secrets, written
from paywarden.llm.sharding import assign_shards, number_slots
from paywarden.llm.text_arrays import slices, words_in
from tests.llm.conftest import PROSE, TRICKY

SMALL = "/root/testdata/sf0.001"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def by_id(rows, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}


# Oracles


def duck(tables):
    connection = duckdb.connect()
    for name, table in tables.items():
        connection.register(name, table)
    return connection


def same_rows(frame, connection, sql):
    columns = sorted(frame.columns)
    ours = Counter(
        tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in columns) for r in frame.collect()
    )
    result = connection.sql(sql)
    assert sorted(result.columns) == columns
    theirs = Counter(
        tuple(round(v, 9) if isinstance(v, float) else v for v in r)
        for r in connection.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    )
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_equal_their_sql(spark, name):
    tables = {t: pa.table(spark.read.parquet(f"{SMALL}/{t}.parquet").toArrow()) for t in ("documents", "pages", "benchmark")}
    same_rows(queries.QUERIES[name](spark, SMALL), duck(tables), oracles.ORACLES[name])


@pytest.mark.parametrize("name", ["op4_quality_rules", "op6_license_scan", "op8_mixing"])
def test_awkward_rows_equal_their_sql(spark, tricky, name, tmp_path):
    tricky.write.parquet(f"{tmp_path}/documents.parquet")
    same_rows(queries.QUERIES[name](spark, str(tmp_path)), duck({"documents": tricky.toArrow()}), oracles.ORACLES[name])


def test_every_query_takes_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# 1 Secret scans


def brute_base(text):
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        found += [(m.start(), 1, m.end())] if len(m[0]) >= 20 else []
    for m in re.finditer(r"[0-9a-f]+", text):
        found += [(m.start(), 2, m.end())] if len(m[0]) >= 24 else []
    return sorted(found)


def test_base_spans_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = by_id(docs.collect(), "text")
    for r in scan_secrets(docs).collect():
        base = brute_base(texts[r["doc_id"]][0] or "")
        assert r["base_sha256"] == hashlib.sha256(written(base).encode()).hexdigest()
        assert r["n_assign"] == sum(kind == 0 for _, kind, _ in base)


SECRET = "password=hunter22x"


def spans(text):
    return written(sorted(Scan(text).spans))


def test_nested_layers_are_mapped_to_the_text():
    once = base64.b64encode(SECRET.encode()).decode()
    packed = base64.b64encode(gzip.compress(SECRET.encode())).decode()
    twice = urllib.parse.quote(urllib.parse.quote(SECRET, safe=""), safe="")
    assert spans(f"é {once} z") == f"assign:2:{2 + len(once)}"
    assert spans(f"q {packed} r") == f"assign:2:{2 + len(packed)}"
    assert spans(twice) == f"assign:0:{len(twice)}"
    assert spans("".join(f"\\u{ord(c):04x}" for c in SECRET)) == f"assign:0:{6 * len(SECRET)}"
    assert spans("password: hun%74er2") == "assign:0:19"  # too short before it is decoded
    assert spans(base64.b64encode(f"x {packed}".encode()).decode()).startswith("assign:")
    assert spans("x " + SECRET) == "assign:2:20"


def test_plain_words_and_broken_layers_give_nothing():
    for text in ("", "a" * 500, "%zz %4", "\\u12", "QUJD" * 9, base64.b64encode(b"\x1f\x8b broken").decode()):
        assert spans(text) == ("" if "a" * 24 not in text else f"hex:0:{len(text)}")


def test_a_large_expansion_is_reported_and_a_cycle_ends(monkeypatch):
    bomb = base64.b64encode(zlib.compress(b"\0" * (65 << 20))).decode()
    assert Scan(bomb).closed == 1
    assert expanded(b"plain") == b"plain"
    monkeypatch.setattr("paywarden.llm.secret_scan.expanded", lambda data: data[::-1])
    Scan(base64.b64encode(b"an encoding that turns round").decode())


def test_secret_scan_of_awkward_rows(tricky):
    rows = scan_secrets(tricky).collect()
    assert len(rows) == len(TRICKY)
    assert by_id(rows, "n_assign", "spans")[10] == (1, "assign:180:197")
    assert by_id(rows, "spans")[3] == ("",)


def test_secrets_beside_other_base64_characters_are_mapped():
    once = base64.b64encode(SECRET.encode() + b"  x").decode()
    for before, after in (("https://host.example/cb/", ""), ("blob-", ""), ("data_", ""), ("", "/next"), ("x" * 3, "-y"), ("ab/c_", "_d")):
        for encoded in (once, base64.urlsafe_b64encode(SECRET.encode()).decode().rstrip("=")):
            found = spans(f"{before}{encoded}{after}")
            at, end = len(before), len(before) + -(-8 * len(SECRET) // 6)
            assert f"assign:{at}:{end}" in found.split(","), (before, encoded, after, found)
    packed = base64.b64encode(zlib.compress(SECRET.encode())).decode()
    for packed in (packed, base64.b64encode(gzip.compress(SECRET.encode())).decode(), base64.b64encode(bz2.compress(SECRET.encode())).decode()):
        assert spans(f"data_{packed}") == f"assign:5:{5 + len(packed)}"


def test_secrets_next_to_other_bytes_are_found():
    for data in (
        b"\x00\x1b[0m " + SECRET.encode() + b" \x00", b"\xff\xfe" + SECRET.encode("utf-16-le"), SECRET.encode("utf-16-be"),
        ("\u4e2d\u00e9 " + SECRET).encode("utf-16"), b"caf\xe9 " + SECRET.encode(), ("\u00e9 " + SECRET).encode("latin-1"),
    ):
        assert spans(base64.b64encode(data).decode()).startswith("assign:"), data
        assert spans("".join(f"%{byte:02x}" for byte in data)).startswith("assign:"), data
        assert spans(base64.b64encode(gzip.compress(data)).decode()).startswith("assign:"), data
    assert spans("%ff%70assword=hunter22x") == "assign:3:23"


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress])
def test_all_members_of_a_compressed_stream_are_read(pack):
    packed = base64.b64encode(pack(b"first member, ") + pack(SECRET.encode())).decode()
    # The second member is also read by itself, and xz keeps short texts as they are.
    assert f"assign:0:{len(packed)}" in spans(packed).split(",") and Scan(packed).closed == 0
    assert expanded(pack(b"a") + pack(b"b")) == b"ab"


def test_large_layers_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr("paywarden.llm.secret_scan.MAX_LAYER_BYTES", 1 << 20)
    monkeypatch.setattr("paywarden.llm.secret_scan.PIECE_BYTES", 1 << 16)
    monkeypatch.setattr("paywarden.llm.secret_scan.OVERLAP_BYTES", 1 << 10)
    inner = base64.b64encode(SECRET.encode())
    for at in (3 << 19, (1 << 20) + (1 << 16) - 9, (1 << 21) - 40):
        for secret in (SECRET.encode(), inner):
            data = bytearray(b". " * (1 << 20))
            data[at : at + len(secret)] = secret
            packed = base64.b64encode(gzip.compress(bytes(data))).decode()
            scan = Scan(packed)
            assert written(sorted(scan.spans)) == f"assign:0:{len(packed)}" and scan.closed == 1


def test_generated_nestings_are_found():
    rng = random.Random(1)
    wraps = [
        lambda t: base64.b64encode(t.encode()).decode(),
        lambda t: base64.urlsafe_b64encode(gzip.compress(t.encode())).decode(),
        lambda t: base64.b64encode(zlib.compress(t.encode())).decode(),
        lambda t: base64.b64encode(t.encode("utf-16")).decode(),
        lambda t: "".join(f"%{byte:02X}" for byte in t.encode()),
        lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
        lambda t: "".join(f"&#{ord(c)};" for c in t),
    ]
    for n in range(200):
        text = SECRET
        for _ in range(rng.randrange(1, 4)):
            text = rng.choice(["", "cb/", "blob-", "data_", "x ", "\u00e9 "]) + rng.choice(wraps)(text) + rng.choice(["", " ", "/next", "\n"])
        assert "assign:" in spans(text), (n, text)


def escaped(data, one, raw=b""):
    return "".join(chr(byte) if byte in raw else one % byte for byte in data)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_compressed_bytes_are_found_in_every_layer(pack):
    rng = random.Random(3)
    letters = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-~"
    for _ in range(12):
        data = pack(f"{rng.random()} {SECRET} {rng.random()}".encode())
        quoted = urllib.parse.quote(data, safe="")
        for layer in (
            quoted, f"%20{quoted}", urllib.parse.quote(quoted, safe=""), escaped(data, "%%%02x", letters), escaped(data, "\\x%02x"),
            escaped(data, "\\u%04x"), escaped(data, "&#%d;"), escaped(data, "&#x%x;"), repr(data)[2:-1], data.decode("latin-1"),
            base64.b64encode(b"?" + data).decode(), base64.b64encode(b"\xfe\xff" + data + b"\x80").decode(),
            base64.b64encode(pack(data)).decode(),
        ):
            # The span starts at the stream's first byte; what stands behind is not part of it.
            found = {tuple(map(int, s.split(":")[1:])) for s in spans(f"q {layer} r").split(",") if s.startswith("assign:")}
            assert any(2 <= start <= 5 and len(layer) - 4 <= end <= len(layer) + 2 for start, end in found), (layer, found)
        layer = escaped(data, "\\x%02x")
        # xz keeps short texts as they are, so there the secret is also read without the stream.
        assert f"assign:2:{2 + len(layer)}" in spans(f"q {layer} r").split(",")


def test_quoted_strings_and_wrapped_runs_are_unwrapped():
    once = json.dumps(f'{{"password": "hunter22x/{"y" * 4}"}}').replace("/", "\\/")
    for text in (once, json.dumps(once), json.dumps(json.dumps(once))):
        assert any(s.startswith("assign:") for s in spans(text).split(",")), text
    whole = base64.b64encode(f"{'. ' * 37}{SECRET}{' .' * 40}".encode()).decode()
    for width in (16, 40, 64, 76, 100):
        for indent in ("", "    ", "\t"):
            for feed in ("\n", "\r\n"):
                wrapped = feed.join(indent + whole[i : i + width] for i in range(0, len(whole), width))
                text = f"x\n{wrapped}\n"
                first, last = ((8 * b // 6) for b in (74, 74 + len(SECRET) - 1))
                digits = [i for i, c in enumerate(text) if i > 1 and not c.isspace()]
                end = digits[(8 * (74 + len(SECRET)) - 1) // 6] + 1
                assert f"assign:{digits[first]}:{end}" in spans(text).split(","), (width, indent, last)


@pytest.mark.parametrize("unit", ["H4sI", "eJw", "QlpoOTFBWSZTWQ", "x^", "%1f%8b%08", "\\x1f\\x8b\\x08", "/Td6WFoA", "aaaa\n"])
def test_hostile_texts_take_time_in_proportion(unit):
    def seconds(size):
        text = unit * (size // len(unit))
        return min(timeit.repeat(lambda: Scan(text), number=1, repeat=2))

    seconds(10_000)
    assert seconds(400_000) < 4 * seconds(200_000) + 0.5


def test_a_secret_behind_hostile_bytes_is_found_and_what_stays_closed_is_counted():
    hostile = b"\x1f\x8b\x08\x1f" * 60_000
    scan = Scan(base64.b64encode(hostile + gzip.compress(SECRET.encode())).decode())
    assert scan.closed >= 1 and any(kind == 0 for _, kind, _ in scan.spans)


# 2 Toxicity, 3 quality


def labelled(spark, n=240):
    texts, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [f"w{(i * 7 + k * k) % 50}" for k in range(60)]
        if bad:
            words[10] = "vile"
            words[20:40] = [word + "##" for word in words[20:40]]
        texts.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, int(bad)))
    return (
        spark.createDataFrame(texts, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def accuracy(scores, labels, column):
    marks = by_id(labels.collect(), column)
    return sum((r["score"] >= 0.7) == (marks[r["doc_id"]][0] == 1) for r in scores.collect()) / len(marks)


def test_classifiers_learn_held_out_rows(spark):
    docs, labels = labelled(spark)
    seen = labels.where("doc_id % 3 <> 1")
    assert accuracy(toxicity.with_toxicity(docs, seen), labels, "toxic") > 0.97
    assert accuracy(quality_ranking.score_quality(docs, seen), labels, "quality") > 0.97


def test_classifiers_on_awkward_rows(spark, tricky):
    docs, labels = labelled(spark)
    both = docs.unionByName(tricky.select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 1000))
    for scored in (toxicity.with_toxicity(both, labels), quality_ranking.score_quality(both, labels)):
        scores = [r["score"] for r in scored.collect()]
        assert len(scores) == both.count() and all(0 <= s <= 1 for s in scores)
    broken = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.with_toxicity(tricky, broken).collect()} == {1.0}
    assert {r["score"] for r in quality_ranking.score_quality(tricky, broken).collect()} == {1.0}


def test_scores_do_not_change_with_partitions(spark):
    docs, labels = labelled(spark)
    a = by_id(toxicity.with_toxicity(docs.repartition(1), labels).collect(), "score")
    b = by_id(toxicity.with_toxicity(docs.repartition(5, "text"), labels.repartition(4)).collect(), "score")
    assert a == b


# 4, 5 Lines


def test_frequent_lines_deplete_documents(spark):
    common = " ".join(f"c{i}" for i in range(60))
    own = [" ".join(f"d{n}x{i}" for i in range(70)) for n in range(6)]
    rows = [(n, f"{common}\n{own[n]}", "h") for n in range(6)] + [(9, f"{common}\n{common.upper()} ", "h"), (10, common, "g")]
    judged = by_id(
        judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), 5, 0.5).collect(),
        "n_removed_lines", "kept_words", "base_failed", "kept",
    )
    assert judged[0] == (1, 70, False, True)
    assert judged[9] == (2, 0, False, False)  # lines are compared without case, words as they are
    assert judged[10] == (0, 60, False, True)  # another host


def test_a_repeated_document_counts_once_for_its_lines(spark, tmp_path):
    lines = "\n".join(" ".join(f"r{k}x{i}" for i in range(15)) for k in range(6))
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, lines, "h")] * 120 + [(None, lines + "\nend", "h")] * 120
    rows += [(1000 + n, f"{shared}\n" + " ".join(f"o{n}x{i}" for i in range(70)), "h") for n in range(101)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = judge_documents(docs).select("doc_id", "n_removed_lines", "kept").distinct()
    found = {r["doc_id"]: (r["n_removed_lines"], r["kept"]) for r in judged.collect()}
    assert found[1] == (0, True) and found[None] == (0, True) and found[1000] == (1, True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    same_rows(queries.QUERIES["op4_quality_rules"](spark, str(tmp_path)), duck({"documents": docs.toArrow()}), oracles.ORACLES["op4_quality_rules"])


def test_boilerplate_is_relative_to_the_host(spark):
    rows = [(n, "a.com", f"menu\nbody {n}\n\nmenu") for n in range(10)] + [(20, "b.com", "menu\nx"), (21, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, host string, text string")
    got = {r["page_id"]: r for r in drop_boilerplate(frame, 0.5, 3).collect()}
    assert got[3]["text"] == "body 3\n" and got[3]["n_removed"] == 2 and got[3]["n_lines"] == 4
    assert got[20]["text"] == "menu\nx" and got[21]["text"] is None and got[21]["n_lines"] == 0


def test_pages_are_turned_into_text_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(text):
        made.add(1)
        return text

    rows = [(n, "a.com", f"menu\nbody {n}") for n in range(10)] + [(3, "a.com", "menu\nbody 3"), (20, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, host string, given string")
    got = drop_boilerplate(frame.withColumn("text", F.udf(counted)("given"))).collect()
    assert sorted(r["text"] or "" for r in got) == sorted([*(f"body {n}" for n in range(10)), "body 3", ""])
    assert made.value == len(rows)


def test_page_text_and_host(spark):
    html = "<html><title>T</title><script>x<y</script><p>a <b>b</b></p><!-- c --></html>"
    r = spark.createDataFrame([("HTTP://A.example.com:80/x", html)], "url string, html string").select(
        host_of(F.col("url")), page_text(F.col("html"))
    ).first()
    assert r[0] == "a.example.com" and r[1].split() == ["T", "a", "b"]


# 6 Licenses


def test_templates_are_found_by_containment(spark, tricky):
    rows = [
        (1, "x\nreleased UNDER the MIT licence"),  # four of five words
        (2, "released under the"),
        (3, "the mit, license; Apache License\nlicensed under the apache license version 2 0"),
    ]
    got = by_id(license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect(), "base_labels", "labels", "score")
    assert got[1] == ("", "mit", 0.8) and got[2] == ("", "", 0.0) and got[3] == ("apache,mit", "apache,mit", 1.0)
    assert license_scan.scan_licenses(tricky).count() == len(TRICKY)


VARIANTS = set(license_scan.VARIANTS)


def brute_templates(text):
    """Labels of the templates of which some word window holds the share, the naming words and no other variant."""
    words, found = re.findall(r"[a-z0-9]+", text.lower()), set()
    for label, template in license_scan.TEMPLATES:
        held = set(template.split())
        size = -(-len(template.split()) * 5 // 4)
        for i in range(len(words)):
            block = set(words[i : i + size])
            named = held & ({*label.split("-")} | VARIANTS)
            if words[i] in held and 10 * len(held & block) >= 8 * len(held) and named <= block and not block & VARIANTS - held:
                found.add(label)
    return found


BSD = "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"
GPL = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public\n#\n# License as published"


def test_notices_are_found_across_lines_and_only_where_they_stand(spark):
    far = " ".join(["released", *["x"] * 90, "under", *["x"] * 90, "the", *["x"] * 90, "mit license"])
    rows = [(1, BSD, "bsd"), (2, GPL, "gpl"), (3, "Released under the GPL license.", ""), (4, "Licensed under CC BY 4.0.", "")]
    rows += [(5, "Licensed under the GPL license, version 2.0", ""), (6, "Licensed under CC BY-NC 4.0.", "cc-by-nc"), (7, "Permission is hereby granted, free of\n\ncharge, to any person\nobtaining a copy of this software", "mit")]
    got = by_id(license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, want string")).collect(), "labels")
    assert got == {doc_id: (want,) for doc_id, _, want in rows}
    far_labels = license_scan.scan_licenses(spark.createDataFrame([(1, far)], "doc_id long, text string"), phrases=license_scan.PHRASES[:1])
    assert far_labels.first()["labels"] == ""


CC = "This work is licensed under a Creative Commons Attribution{} 4.0\nInternational License."
NOTICES = [
    (CC.format(""), "cc-by"),
    (CC.format("-ShareAlike"), "cc-by-sa"),
    (CC.format("-NonCommercial"), "cc-by-nc"),
    (CC.format("-NoDerivatives"), "cc-by-nd"),
    (CC.format("-NonCommercial-NoDerivatives"), "cc-by-nc-nd"),
    (CC.format("-NonCommercial-ShareAlike"), "cc-by-nc-sa"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    (GPL, "gpl"),
    (GPL.replace("GNU", "GNU Lesser"), "lgpl"),
    (GPL.replace("GNU", "GNU Affero"), "agpl"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted", "isc"),
    (BSD, "bsd"),
    ("nothing but words", ""),
    (GPL + " x" * 40 + " " + CC.format("-ShareAlike"), "cc-by-sa,gpl"),
]


def test_variants_of_licenses_are_told_apart(spark, tricky, tmp_path):
    rows = [(n, text, "en", "s", 1) for n, (text, _) in enumerate(NOTICES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = by_id(license_scan.scan_licenses(docs, phrases=(("none", "zz zz"),)).collect(), "labels")
    assert got == {n: (want,) for n, (_, want) in enumerate(NOTICES)}
    # The statement takes the same windows.
    given = docs.unionByName(tricky.select(*docs.columns)).unionByName(random_notices(spark).withColumns({c: F.lit("x") for c in ("lang", "source")} | {"n_chars": F.lit(1)}))
    given.write.parquet(f"{tmp_path}/documents.parquet")
    same_rows(queries.op6_license_scan(spark, str(tmp_path)), duck({"documents": given.toArrow()}), oracles.ORACLES["op6_license_scan"])


def test_each_filter_alone_drops_no_window_that_meets(spark):
    known = license_scan.Templates(license_scan.TEMPLATES, license_scan.CONTAINMENT, {"the": 9, "license": 4, "gnu": 1})
    texts = [r["text"] for r in random_notices(spark).collect()]
    dropped = [0, 0, 0]
    for first, _, data, offsets in slices(pa.array(texts)):
        words = words_in(data, offsets, license_scan.NOT_ALNUM, license_scan.FOLDED)
        numbers = known.numbers(words.hashes)
        at = np.flatnonzero(numbers >= 0)
        owner, numbers = words.owner[at], numbers[at]
        places = known.spread(at, owner)
        for k in range(len(known.labels)):
            other = places[known.foreign[k][numbers]]
            mine = known.held[k][numbers]
            args = (places[mine], numbers[mine], owner[mine], other)
            ranks, end = known.ranks[k][args[1]], known.windows_of(k, args[0])
            every = np.arange(len(args[0]))
            met = [x.tolist() for x in known.verified(k, *args, end, every)]
            for i, kept in enumerate((known.by_prefix(k, ranks, end, every), known.by_length(k, end, every), known.by_position(k, ranks, end, every))):
                assert [x.tolist() for x in known.verified(k, *args, end, kept)] == met
                dropped[i] += len(every) - len(kept)
    assert all(dropped)


def test_words_are_counted_over_all_texts(spark, tricky):
    counts = license_scan.word_counts(tricky, ["line", "one", "same", "zz"])
    assert counts == {"line": 5, "one": 2, "same": 5, "zz": 0} or counts == {"line": 5, "one": 2, "same": 5}


def random_notices(spark):
    rng = random.Random(6)
    rows = []
    for n in range(300):
        words = []
        for _ in range(rng.randrange(4)):
            template = rng.choice(license_scan.TEMPLATES)[1].split()
            for _ in range(rng.randrange(5)):
                template.insert(rng.randrange(len(template)), rng.choice(["x", "the", "license", "sa", "lesser"]))
            for _ in range(rng.randrange(4)):
                template.pop(rng.randrange(len(template)))
            words += ["y"] * rng.randrange(4) + template
        rows.append((n, "".join(word + rng.choice(" \n.") for word in words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_templates_equal_brute_force(spark):
    docs = random_notices(spark)
    got = by_id(license_scan.scan_licenses(docs, phrases=(("none", "zz zz"),)).collect(), "labels")
    assert got == {r["doc_id"]: (",".join(sorted(brute_templates(r["text"]))),) for r in docs.collect()}


# 7 Sharding, 8 mixing


def jump(key, shards):
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return at


def test_shards_follow_the_published_hash_and_slots_have_no_gaps(spark):
    placed = number_slots(assign_shards(spark.range(4000).withColumnRenamed("id", "doc_id")), ["doc_id"]).collect()
    for r in placed:
        assert (r["shard"], r["grown_shard"]) == (jump(r["key_number"], 24), jump(r["key_number"], 25))
    for shard in range(24):
        slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_shards_of_awkward_rows(spark, tricky, tmp_path):
    tricky.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_sharding(spark, str(tmp_path)).collect()
    expected = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in TRICKY)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    assert len({(r["shard"], r["slot"]) for r in got}) == len(TRICKY)


def test_rows_of_one_id_are_numbered_by_several_tasks(spark, tmp_path):
    ids = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    spark.range(6000).select(ids.alias("doc_id"), (F.col("id") % 50).alias("tie")).write.parquet(f"{tmp_path}/rows")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = number_slots(assign_shards(spark.read.parquet(f"{tmp_path}/rows")), ["doc_id", "tie"])
        rows = placed.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for hot in (7, None):
        assert len({r["task"] for r in rows if r["doc_id"] == hot}) > 1
    for shard in range(24):
        inside = sorted((r for r in rows if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in inside] == list(range(len(inside)))
        order = [(r["key_number"], r["doc_id"] or -1, r["tie"]) for r in inside]
        assert order == sorted(order)


def test_mix_reaches_capped_targets(spark):
    rows = [(n, "w " * 10, source) for n, source in enumerate(["a"] * 30 + ["b"] * 600 + [None] * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mixing.plan_mix(docs)
    targets = {r["source"]: r["target"] for r in planned.select("source", "target").distinct().collect()}
    assert targets["a"] == 900.0  # 5/8 of all, cut to three times its words
    assert abs(sum(targets.values()) - 9300) < 1e-6 and abs(targets["b"] - 2 * targets[None]) < 1e-6
    taken = {r["source"]: r["t"] for r in planned.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()}
    assert all(abs(taken[s] - targets[s]) <= 0.1 * targets[s] for s in targets)
    assert mixing.emit_mix(docs).count() * 10 == sum(taken.values())


def test_rows_without_an_id_are_drawn_each_by_its_text(spark):
    rows = [(None, f"w{n} " * 10, source) for n, source in enumerate(["a"] * 200 + [None] * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mixing.plan_mix(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("taken"))
    assert all(abs(r["taken"] - r["t"]) <= 0.1 * r["t"] for r in planned.collect())


# 9 Jaccard join


def brute_components(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans(UPPER, LOWER))) for _, t in rows]
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset() for w in words]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= 80 * len(a | b):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        lowest[root(i)] = min(lowest.get(root(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), lowest[root(i)]) for i, (doc_id, _) in enumerate(rows)}


@pytest.mark.parametrize("hot", [jaccard_join.HOT, 3])
def test_components_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for n in range(30):
        base = [f"b{n}x{rng.randrange(40)}" for _ in range(rng.choice([1, 4, 5, 30, 120]))]
        for _ in range(rng.choice([1, 2, 6])):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(99)}"
            if rng.random() < 0.4:
                text += passage
            rows.append((len(rows), " ".join(text).title()))
    rows += [(1000, ""), (1001, None), (1002, passage[0]), (1003, passage[0].upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = by_id(jaccard_join.similar_components(docs).collect(), "n_shingles", "component_id")
    assert got == brute_components(rows)
    kept = {r["doc_id"] for r in jaccard_join.deduplicate(docs).collect()}
    assert kept == {i for i, (n, component) in got.items() if i == component or n == 0}


def test_repeated_ids_and_rows_in_the_join(tricky):
    rows = jaccard_join.similar_components(tricky).collect()
    assert len(rows) == len(TRICKY)
    got = by_id(rows, "n_shingles", "component_id")
    assert got[1] == (116, 1) and got[2][1] == 1 and got[7] == (1, 6) and got[3] == (0, 3) and got[None] == (116, None)
    kept = jaccard_join.deduplicate(tricky)
    assert kept.columns == tricky.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 8, 9, 10]


# 10 Decontamination


def test_substitutions_are_tolerated(spark, tricky):
    rng = random.Random(9)
    item = [f"q{i}" for i in range(30)]
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, "tiny item"), (9, None), (10, "s1 s2 s3 s4 s5 s6")], "item_id long, text string")
    rows = [(0, PROSE)]
    for n in range(1, 60):
        words = list(item[: rng.choice([13, 20, 30])])
        for at in rng.sample(range(13), 2):
            words[at] = "changed"
        rows.append((n, f"{PROSE} {' '.join(words).upper()}, {PROSE}"))
    rows += [(70, "s1 s2 s3 s4 s5 s6"), (71, "s1 s2 s3 x s5 s6"), (72, " ".join(item[:12])), (73, "tiny item")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(decontamination.find_overlaps(docs, benchmark).collect(), "items", "starts")
    for n in range(1, 60):
        assert got[n][0] == [7], n
    assert got[0][0] == [] and got[70] == ([10], [0]) and got[72][0] == [] and got[73][0] == []
    clean = decontamination.remove_contaminated(docs, benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, (items, _) in got.items() if not items}
    split = by_id(decontamination.find_overlaps(docs, benchmark, block_words=1).collect(), "items", "starts")
    assert split == got
    assert decontamination.remove_contaminated(tricky, benchmark).count() == len(TRICKY)


def test_masks_reach_every_allowed_substitution():
    for size in range(decontamination.MIN_ITEM, decontamination.MIN_OVERLAP + 1):
        masks = decontamination.short_masks(size) if size < decontamination.MIN_OVERLAP else decontamination.MASKS
        runs = [{i + k for k in decontamination.mask_positions(m)} for m in masks for i in range(size - len(m) + 1)]
        allowed = max(n for n in range(size) if size - n >= decontamination.MIN_MATCHED * size)
        for n in range(allowed + 1):
            for differing in itertools.combinations(range(size), n):
                assert any(not run & set(differing) for run in runs), (size, differing)


def brute_items(text, items):
    """Ids of the items of which a window of 13 words, or the whole item, stands in the text by the share."""
    words, found = re.findall(r"[a-z0-9]+", text.lower()), set()
    for item_id, item in items:
        theirs = re.findall(r"[a-z0-9]+", (item or "").lower())
        size = min(len(theirs), 13)
        if len(theirs) < 5:
            continue
        for i in range(len(theirs) - size + 1):
            for k in range(len(words) - size + 1):
                if sum(a == b for a, b in zip(theirs[i : i + size], words[k : k + size])) >= 0.8 * size:
                    found.add(item_id)
    return sorted(found)


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(71)
    items = [(n, " ".join(f"v{rng.randrange(40)}" for _ in range(4 + n % 16))) for n in range(64)]
    rows = []
    for n in range(320):
        words = items[n % 64][1].split()
        for at in rng.sample(range(len(words)), rng.randrange(4)):
            words[at] = f"v{rng.randrange(40)}"
        around = [f"v{rng.randrange(40)}" for _ in range(12)]
        cut = rng.randrange(13)
        rows.append((n, " ".join(around[:cut] + words + around[cut:])))
    rows.append((900, "s1 s2 s3 x s5 s6"))
    items.append((64, "s1 s2 s3 s4 s5 s6"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontamination.find_overlaps(docs, benchmark).collect(), "items")
    expected = {n: brute_items(text, items) for n, text in rows}
    assert {n: sorted(set(found)) for n, (found,) in got.items()} == expected
    assert expected[900] == [64] and sum(map(bool, expected.values())) > 150
    kept = {r["doc_id"] for r in decontamination.remove_contaminated(docs, benchmark).collect()}
    assert kept == {n for n, found in expected.items() if not found}


def brute_spans(text, items):
    """Item, start and length of the overlaps of each alignment, by all windows."""
    words, found = re.findall(r"[a-z0-9]+", text.lower()), []
    for item_id, item in items:
        theirs = re.findall(r"[a-z0-9]+", item.lower())
        size = min(len(theirs), 13)
        for shift in range(-len(theirs) + 1, len(words)) if len(theirs) >= 5 else ():
            open_ = None
            for k in range(max(shift, 0), min(len(words), len(theirs) + shift) - size + 1):
                if sum(a == b for a, b in zip(words[k : k + size], theirs[k - shift :])) >= 0.8 * size:
                    if open_ and k < open_[1]:
                        open_[1] = k + size
                    else:
                        open_ = [k, k + size]
                        found.append((item_id, open_))
    return sorted((item_id, start, end - start) for item_id, (start, end) in found)


def test_spans_equal_brute_force_and_split_at_gaps(spark):
    rng = random.Random(17)
    items = [(n, " ".join(f"v{rng.randrange(60)}" for _ in range(5 + 3 * n))) for n in range(20)] + [(99, "same " * 40)]
    rows = []
    for n in range(120):
        words = items[n % 20][1].split()
        gap = rng.randrange(0, 40)
        changed = range(15, 15 + gap)
        rows.append((n, " ".join(f"z{i}" if i in changed else w for i, w in enumerate(["a", "b"] + words))))
    rows.append((500, "same " * 60))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (decontamination.BLOCK_WORDS, 200):
        got = by_id(decontamination.find_overlaps(docs, benchmark, block_words).collect(), "items", "starts", "lengths")
        for n, text in rows:
            assert sorted(zip(*got[n])) == brute_spans(text, items), n
    assert any(len(set(zip(items, starts))) > len(set(items)) for items, starts, _ in got.values())


def test_equal_words_take_bounded_memory(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(decontamination, "HIT_PAIRS", 1 << 18)
    block = decontamination.Block([1], ["same " * 400])
    text = ("same " * 6000).encode()
    words = words_in(np.frombuffer(text, np.uint8), np.array([0, len(text)], np.int64), decontamination.NOT_ALNUM, decontamination.FOLDED)
    tracemalloc.start()
    found = list(block.overlaps(words))
    assert tracemalloc.get_traced_memory()[1] < 150 << 20
    tracemalloc.stop()
    assert len(found) == 6000 + 400 - 2 * 13 + 1 and max(length for *_, length in found) == 400


def test_items_without_an_id_count(spark):
    benchmark = spark.createDataFrame([(None, "s1 s2 s3 s4 s5 s6"), (2, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x s1 s2 s3 s4 s5 s6"), (2, "x y")], "doc_id long, text string")
    assert by_id(decontamination.find_overlaps(docs, benchmark).collect(), "items") == {1: ([None],), 2: ([],)}
    assert [r["doc_id"] for r in decontamination.remove_contaminated(docs, benchmark).collect()] == [2]


# Pipeline


def test_the_pipeline_keeps_columns_and_its_decisions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = stage(spark, given, SMALL)
        assert given.columns == docs.columns, name
        given = given.cache()
    final = corpus_pipeline.STAGES[-1][1](spark, given, SMALL)
    assert final.count() == given.count() > 0
    assert corpus_pipeline.run(spark, SMALL).count() == final.count()
