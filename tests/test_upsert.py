"""The incremental index: batches against a dictionary, repeats, compaction."""

import os
import random

import pytest

from textrail.streaming import upsert as U

SCHEMA = "doc_id bigint, text string"
CHANGES = SCHEMA + ", seq bigint, op string"


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def folders(target):
    return {(v, b) for v in os.listdir(f"{target}/data") for b in os.listdir(f"{target}/data/{v}") if b.startswith("bucket=")}


def test_batches_equal_a_dictionary(spark, schema, tmpdir_run):
    rnd, target, state, all_changes = random.Random(3), f"{tmpdir_run}/index", {}, []
    for version in range(4):
        changes = [(rnd.choice([None, *range(40)]), f"t{version}.{i}", 100 * version + i, rnd.choice(["upsert", "upsert", "delete"])) for i in range(30)]
        for k, text, _, op in changes:
            state.pop(k, None)
            if op == "upsert":
                state[k] = text
        all_changes += changes
        U.upsert(spark.createDataFrame(changes, CHANGES), target, version, schema, buckets=8)
        assert rows(U.read_index(spark, target, schema)) == sorted(state.items(), key=repr)
    twin = U.apply_changes(spark.createDataFrame([], SCHEMA), spark.createDataFrame(all_changes, CHANGES))
    assert rows(twin) == sorted(state.items(), key=repr)


def test_only_touched_buckets_are_rewritten_and_repeats_do_nothing(spark, schema, tmpdir_run):
    target = f"{tmpdir_run}/index"
    base = [(i, f"a{i}", i, "upsert") for i in range(200)]
    assert U.upsert(spark.createDataFrame(base, CHANGES), target, 0, schema, buckets=16) == 16
    one = spark.createDataFrame([(7, "b", 300, "upsert"), (7, "c", 299, "upsert")], CHANGES)
    assert U.upsert(one, target, 1, schema, buckets=16) == 1
    want = sorted([(i, f"a{i}") for i in range(200) if i != 7] + [(7, "b")], key=repr)
    before = folders(target)
    assert len([f for f in before if f[0] == "version=1"]) == 1
    assert U.upsert(one, target, 1, schema, buckets=16) == 0 and U.upsert(one, target, 0, schema, buckets=16) == 0
    assert folders(target) == before and rows(U.read_index(spark, target, schema)) == want
    assert rows(U.read_index(spark, target, schema, version=0)) == sorted([(i, f"a{i}") for i in range(200)], key=repr)
    # what a failed batch left behind is not seen, and is overwritten
    spark.createDataFrame([(9, "torn")], SCHEMA).write.parquet(f"{target}/data/version=2/bucket=3")
    assert rows(U.read_index(spark, target, schema)) == want
    assert U.compact(spark, target, keep=1) == 1
    assert len([f for f in folders(target) if f[0] == "version=0"]) == 15 and ("version=2", "bucket=3") in folders(target)
    assert U.upsert(spark.createDataFrame([(500, "z", 1, "upsert")], CHANGES), target, 2, schema, buckets=16) == 1
    assert rows(U.read_index(spark, target, schema)) == sorted([*want, (500, "z")], key=repr)
    with pytest.raises(ValueError):
        U.read_index(spark, target, schema, version=0)


def test_deleted_buckets_and_empty_batches(spark, schema, tmpdir_run):
    target = f"{tmpdir_run}/index"
    assert rows(U.read_index(spark, target, schema)) == []
    U.upsert(spark.createDataFrame([], CHANGES), target, 0, schema, buckets=4)
    assert rows(U.read_index(spark, target, schema)) == []
    U.upsert(spark.createDataFrame([(i, "x", i, "upsert") for i in range(20)], CHANGES), target, 1, schema, buckets=4)
    U.upsert(spark.createDataFrame([(i, None, i, "delete") for i in range(30)], CHANGES), target, 2, schema, buckets=4)
    assert rows(U.read_index(spark, target, schema)) == []
    U.upsert(spark.createDataFrame([(3, None, 1, "upsert")], CHANGES), target, 3, schema, buckets=4)
    assert rows(U.read_index(spark, target, schema)) == [(3, None)]


def test_stream_in_several_batches(spark, schema, tmpdir_run):
    source, state = f"{tmpdir_run}/changes", {}
    stream_schema = spark.createDataFrame([], CHANGES).schema
    for wave in range(3):
        changes = [(k, f"w{wave}", wave, "delete" if (k + wave) % 5 == 0 else "upsert") for k in range(wave, 30, wave + 1)]
        for k, text, _, op in changes:
            state.pop(k, None)
            if op == "upsert":
                state[k] = text
        spark.createDataFrame(changes, CHANGES).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # a run that finds nothing new changes nothing
            U.stream_upsert(spark.readStream.schema(stream_schema).parquet(source), f"{tmpdir_run}/index", f"{tmpdir_run}/ck", schema,
                            buckets=4, compact_every=2).awaitTermination()
        assert rows(U.read_index(spark, f"{tmpdir_run}/index", schema)) == sorted(state.items(), key=repr)
    assert U.versions(spark, f"{tmpdir_run}/index")[-1] == 2
