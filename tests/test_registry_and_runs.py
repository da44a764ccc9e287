import csv
import json
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleaner.operators import outcome, registry, responses
from gleaner.schemas import EVENT


def event(seq, key, status, path="s/x.pdf", size=13, **more):
    row = {"seq": seq, "doc_key": key, "document_id": None, "article_id": None, "section": "s", "filename": "x.pdf", "file_path": path, "file_size_bytes": size, "article_title": "ሕግ", "article_url": "", "download_url": "u", "link_text": "", "status": status, "error": None, "reason": None, "timestamp": datetime(2024, 1, 2, 3, 4, 5, 6)}
    row |= more
    return tuple(row.values())


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT)


def test_workflow(spark, tmp_path):
    store = registry.Registry(spark, str(tmp_path / "r"))
    files = spark.createDataFrame([("s/x.pdf", 13), ("s/empty.pdf", 0)], "path string, length long")
    candidates = spark.createDataFrame([("doc_123",), ("doc_9",)], "doc_key string")
    assert registry.split_downloaded(candidates, store.load(), files)[0].count() == 0
    store.append(events(spark, event(0, "doc_123", "success", document_id="123"), event(1, "doc_9", "success", "s/empty.pdf", 0)))
    again = registry.Registry(spark, str(tmp_path / "r"))
    skipped, rest = registry.split_downloaded(candidates, again.load(), files)
    assert [r.doc_key for r in skipped.collect()] == ["doc_123"] and [r.doc_key for r in rest.collect()] == ["doc_9"]
    assert again.load().where("doc_key = 'doc_123'").first().file_size_bytes == 13
    again.append(events(spark, event(0, "doc_123", "failed", "", 0, error="e")))
    assert registry.split_downloaded(candidates, again.load(), files)[0].count() == 0
    before = {r.doc_key: (r.status, r.seq, r.first_seen.seq) for r in again.load().collect()}
    for i in range(5):
        again.append(events(spark, event(0, "doc_9", "failed" if i % 2 else "success")))
    entries = lambda: {r.doc_key: (r.status, r.seq, r.first_seen.seq) for r in again.load().collect()}
    assert entries() == {"doc_123": before["doc_123"], "doc_9": ("success", 8, 2)} and again.versions() == []
    again.compact()
    assert entries() == {"doc_123": before["doc_123"], "doc_9": ("success", 8, 2)} and again.recent().count() == 0 and again.versions() == [1]
    # Later events win over the snapshot, later skips do not; new keys come in.
    again.append(events(spark, event(0, "doc_9", "skipped"), event(1, "doc_123", "success"), event(2, "new", "skipped", reason="r")))
    want = {"doc_123": ("success", 10, before["doc_123"][2]), "doc_9": ("success", 8, 2), "new": ("skipped", 11, 11)}
    assert entries() == want and again.last_seq() == 11
    again.compact()
    # The version before stays for readers, and an unfinished one does not count.
    assert entries() == want and again.versions() == [1, 2]
    (tmp_path / "r" / "base" / "v3").mkdir()
    assert again.versions() == [1, 2] and registry.Registry(spark, str(tmp_path / "r")).load().count() == 3
    again.compact()
    assert entries() == want and again.versions() == [2, 3] and not (tmp_path / "r" / "log" / "v1").exists()


def test_a_snapshot_writes_only_touched_buckets(spark, tmp_path):
    store, base = registry.Registry(spark, str(tmp_path / "r"), buckets=8), tmp_path / "r" / "base"
    store.append(events(spark, *(event(i, f"k{i}", "success", f"s/{i}") for i in range(200))))
    store.compact()
    buckets = lambda v: {f.name for f in (base / f"v{v}").iterdir() if f.name.startswith("bucket=")}
    files = lambda b: [f.name for f in (base / "v1" / b).iterdir() if f.name.endswith(".parquet")]
    assert len(buckets(1)) == 8 and all(len(files(b)) == 1 for b in buckets(1))  # one sorted file for each bucket
    entries = lambda s: {r.doc_key: (r.status, r.seq, r.first_seen.seq) for r in s.load().collect()}
    first = store.base()
    store.append(events(spark, event(0, "k7", "failed")))
    want = entries(store)
    store.compact()
    assert len(buckets(2)) == 1 and buckets(2) < buckets(1) and len(buckets(1)) == 8
    assert entries(store) == entries(registry.Registry(spark, str(tmp_path / "r"))) == want and want["k7"] == ("failed", 201, 8)
    assert first.count() == 200 and first.where("doc_key = 'k7'").first().status == "success"  # readers of the one before
    # What no kept snapshot has goes: the bucket of k7 as it was, then, when all are touched, the first version.
    store.compact()
    assert store.versions() == [2, 3] and buckets(1) == {f"bucket={b}" for b in range(8)} - buckets(2) and buckets(3) == set()
    for _ in range(2):
        store.append(events(spark, *(event(i, f"k{i}", "success", f"s/{i}") for i in range(200))))
        store.compact()
    assert sorted(f.name for f in base.iterdir()) == ["v4", "v5"] and len(entries(store)) == 200


def test_the_snapshot_is_not_dealt_again(spark, tmp_path):
    import re

    store = registry.Registry(spark, str(tmp_path / "r"), buckets=8)
    store.append(events(spark, *(event(i, f"k{i}", "success" if i % 3 else "failed", f"s/{i}") for i in range(40))))
    store.compact()
    store.append(events(spark, event(0, "k4", "failed"), event(1, "k3", "success", "s/3"), event(2, "k5", "skipped"), event(3, "k99", "success", "s/99")))
    files = spark.createDataFrame([(f"s/{i}", i % 5) for i in range(100)], "path string, length long")
    candidates = spark.createDataFrame([(f"k{i}",) for i in range(120)] + [("k7",)], "doc_key string")
    skipped, rest = store.split(candidates, files)
    old, left = registry.split_downloaded(candidates, store.load(), files)
    of = lambda df: sorted(r.doc_key for r in df.collect())
    assert of(skipped) == of(old) and of(rest) == of(left) and "k3" in of(skipped) and "k4" in of(rest) and of(skipped).count("k7") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (store.load(), store.split(candidates, files)[0]):
            lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
            scans = [i for i, x in enumerate(lines) if "FileScan parquet" in x and "Bucketed: true" in x]
            assert scans, "\n".join(lines)
            for i in scans:  # no exchange between the snapshot and the join that it takes part in
                depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
                above, at = [], depth(lines[i])
                for x in reversed(lines[:i]):
                    if depth(x) < at:
                        at = depth(x)
                        above.append(x)
                        if "Join" in x:
                            break
                assert above and not any(re.search("Exchange", x) for x in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_stale_lock_is_taken_over(spark, tmp_path):
    import os
    import time

    store = registry.Registry(spark, str(tmp_path / "r"))
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "_writing").touch()
    with pytest.raises(TimeoutError), store.writing(0.2):
        pass
    os.utime(tmp_path / "r" / "_writing", (time.time() - 9999, time.time() - 9999))
    store.append(events(spark, event(0, "a", "success")))
    assert store.last_seq() == 1 and not (tmp_path / "r" / "_writing").exists()


def test_one_writer_at_a_time(spark, tmp_path):
    store = registry.Registry(spark, str(tmp_path / "r"))
    with store.writing(), pytest.raises(TimeoutError), store.writing(0.2):
        pass
    store.append(events(spark, event(0, "a", "success")))
    assert store.last_seq() == 1


def test_current_entries(spark):
    log = events(spark, event(1, "a", "success"), event(2, "a", "failed"), event(3, "b", "skipped", reason="r1"), event(4, "b", "skipped", reason="r2"), event(5, "c", "skipped"), event(6, "c", "success"), event(7, "a", "skipped"))
    got = {r.doc_key: (r.status, r.reason, r.first_seen.seq) for r in registry.current(log).collect()}
    assert got == {"a": ("failed", None, 1), "b": ("skipped", "r1", 3), "c": ("success", None, 5)}
    assert tuple(registry.summary(registry.current(log)).first()) == (3, 1, 1, 1)
    assert tuple(registry.summary(registry.current(log.limit(0))).first()) == (0, 0, 0, 0)


def test_exports(spark, tmp_path):
    store = registry.Registry(spark, str(tmp_path / "r"))
    store.append(events(spark, event(0, "b", "success", article_title='say "x", y'), event(1, "a", "failed", "", 0, error="no")))
    store.append(events(spark, event(0, "b", "success"), event(1, "c", "skipped", reason="already_exists")))
    store.export_csv(str(tmp_path / "m.csv"))
    with open(tmp_path / "m.csv", encoding="utf-8", newline="") as f:
        rows = list(csv.DictReader(f))
    assert [r["key"] for r in rows] == ["b", "a", "c"] and rows[1]["error"] == "no" and rows[0]["error"] == "" and rows[0]["timestamp"] == "2024-01-02T03:04:05.000006+00:00"
    store.export_json(str(tmp_path / "m.json"))
    text = (tmp_path / "m.json").read_text(encoding="utf-8")
    entries = json.loads(text)
    assert list(entries) == ["b", "a", "c"] and "ሕግ" in text and entries["c"]["reason"] == "already_exists" and "filename" not in entries["c"] and entries["b"]["error"] is None
    back = registry.import_json(spark, str(tmp_path / "m.json")).orderBy("seq").collect()
    assert [(r.doc_key, r.status) for r in back] == [("b", "success"), ("a", "failed"), ("c", "skipped")]


def test_exports_in_many_parts(spark, tmp_path):
    """A file of several splits and parts is what one writer would have written; no row passes through the driver."""
    from unittest import mock

    store = registry.Registry(spark, str(tmp_path / "r"))
    odd = ['"key": {', "a\n  \"b\": {\n", "ሕግ, \\", "", "\r\n,\t\x01"]
    order = list(range(300))
    random.Random(1).shuffle(order)
    store.append(events(spark, *(event(place, f'k{i} {odd[i % 5]}', ("success", "failed", "skipped")[i % 3], size=i, article_title=odd[i % 4], error=odd[(i + 1) % 5] if i % 3 == 1 else None, reason="r") for place, i in enumerate(order))))
    with mock.patch("pyspark.sql.DataFrame.toLocalIterator", side_effect=AssertionError):
        store.export_json(str(tmp_path / "m.json"))
        store.export_csv(str(tmp_path / "m.csv"))
    entries = json.loads((tmp_path / "m.json").read_text(encoding="utf-8"))
    keys = [f"k{i} {odd[i % 5]}" for i in order]
    assert list(entries) == keys and json.dumps(entries, ensure_ascii=False, indent=2).replace("\\u0001", "\\u0001") == (tmp_path / "m.json").read_text(encoding="utf-8")
    with open(tmp_path / "m.csv", encoding="utf-8", newline="") as f:
        rows = list(csv.reader(f))
    assert [r[0] for r in rows[1:]] == keys and {len(r) for r in rows} == {13} and sorted(p.name for p in tmp_path.iterdir()) == ["m.csv", "m.json", "r"]
    want = [(i, k, e["status"], e.get("article_title"), e.get("error"), e.get("reason")) for i, (k, e) in enumerate(entries.items())]
    for size in ("700", "64000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            back = registry.import_json(spark, str(tmp_path / "m.json"))
            got = sorted((r.seq, r.doc_key, r.status, r.article_title, r.error, r.reason) for r in back.collect())
            assert spark.read.text(str(tmp_path / "m.json")).rdd.getNumPartitions() > 1
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == want


def test_an_empty_registry_is_exported(spark, tmp_path):
    store = registry.Registry(spark, str(tmp_path / "r"))
    store.export_json(str(tmp_path / "m.json"))
    store.export_csv(str(tmp_path / "m.csv"))
    assert json.loads((tmp_path / "m.json").read_text()) == {} and (tmp_path / "m.csv").read_text().startswith("key,") and registry.import_json(spark, str(tmp_path / "m.json")).count() == 0


@pytest.mark.parametrize("text", ["{nope", "", '{\n  "a": {\n    "status": "success"\n  }', '{\n  "a": {\n    "status": "succ\n  },\n  "b": {\n    "status": "failed"\n  }\n}', "[]"])
def test_import_of_a_broken_file(spark, tmp_path, text):
    (tmp_path / "m.json").write_text(text)
    assert registry.import_json(spark, str(tmp_path / "m.json")).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_states_fold_to_the_current_entries(seed):
    from gleaner.streaming.keyed_state import folded

    rng = random.Random(seed)
    log = [(i, rng.choice(["skipped", "skipped", "failed", "success"])) for i in range(rng.randrange(1, 9))]
    others = [e for e in log if e[1] != "skipped"]
    want = (*(others[-1] if others else log[0]), 0)
    some = log + rng.choices(log, k=4)  # in any order, some more than once
    rng.shuffle(some)
    entry = None
    for e in some:
        entry = folded(entry, e, [0], 1)
    assert entry == want


def loop(rows, limit, dry):
    """A run told as a loop over its rows."""
    got, out = 0, []
    done = set()
    for seq, kind, key, ok, size, known in rows:
        if limit and got >= limit:
            break
        if kind != "document":
            out.append((seq, "visited"))
        elif known or (not dry and key in done):
            out.append((seq, "skipped"))
        elif dry:
            out.append((seq, "discovered"))
        elif ok:
            got += 1
            if size:
                done.add(key)
            out.append((seq, "downloaded"))
        else:
            out.append((seq, "failed"))
    return out


@pytest.mark.parametrize("limit, dry", [(None, False), (0, False), (1, False), (3, False), (7, False), (-2, False), (3, True), (None, True)])
def test_runs_match_a_loop(spark, limit, dry):
    rng = random.Random(limit or 99)
    rows = []
    for i in range(150):
        kind = rng.choice(["page", "article", "document", "document", "document"])
        doc = kind == "document"
        rows.append((i + 1, kind, f"k{rng.randrange(12)}" if doc else None, doc and rng.random() < 0.6, rng.choice([0, 5]) if doc else None, (rng.random() < 0.1) if doc else None))
    log = spark.createDataFrame(rows, "seq long, kind string, doc_key string, ok boolean, size long, known boolean")
    got = outcome.resolve_run(log, limit, dry)
    want = loop(rows, limit, dry)
    assert sorted((r.seq, r.action) for r in got.collect()) == want
    c = outcome.counters(got).first()
    assert c.pdfs_discovered == sum(1 for s, a in want if a != "visited") and c.pdfs_skipped == sum(1 for _, a in want if a == "skipped")
    if not dry:
        assert c.pdfs_discovered == c.pdfs_downloaded + c.pdfs_skipped + c.pdfs_failed


def test_running_total_over_blocks(spark):
    df = spark.range(1, 101).select(F.col("id").alias("seq"), (F.col("id") % 3 == 0).alias("f"))
    got = outcome.running_total(df, "f", "n", block=7).orderBy("seq").collect()
    assert [r.n for r in got] == [(i - 1) // 3 for i in range(1, 101)]


def test_html_bodies(spark):
    bodies = [b"  \n<!DOCTYPE html>", b"<!doctype html>", b"<html lang=x>", b"<HTML>", b"%PDF-1.4", b"", None, b"\xff<html"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b binary")
    assert [r[0] for r in df.orderBy("i").select(responses.is_html(F.col("b"))).collect()] == [True, False, True, False, False, False, None, False]


def test_rows_without_a_key_are_dealt_evenly(spark):
    rows = [(i, "page" if i % 2 else "article", None, None, None, False) for i in range(4000)]
    rows += [(4000, "document", "k", True, 1, False), (4001, "document", None, True, 1, False), (4002, "document", None, True, 1, False), (4003, "document", "k", True, 1, False), (4004, "document", "\x004001", True, 1, False)]
    log = spark.createDataFrame(rows, "seq long, kind string, doc_key string, ok boolean, size long, known boolean")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = outcome.in_run_skips(log).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r.seq for r in got if r.skipped] == [4003] and len(got) == 4005 and got[0].asDict().keys() == {*log.columns, "skipped", "part"}
    sizes = Counter(r.part for r in got)
    assert max(sizes.values()) < 2 * len(got) / len(sizes) and len(sizes) > 1
