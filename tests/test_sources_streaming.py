"""Sources/sinks in scratch folders, streaming operators vs batch twins,
and the driver contract."""

import base64
import datetime as dt
import os
import struct
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF001
from textrail.sources import files as SF
from textrail.sources import html as H
from textrail.streaming import feeds as G
from textrail.streaming import trigger as TR


def test_read_corpus_merges_and_indexes(spark, tmpdir_run):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, text string")
    b = spark.createDataFrame([(3, "z", 7)], "id long, text string, extra int")
    a.coalesce(1).write.parquet(os.path.join(tmpdir_run, "p1"))
    b.coalesce(1).write.parquet(os.path.join(tmpdir_run, "p2"))
    df = SF.read_corpus(spark, os.path.join(tmpdir_run, "p*"), row_index=True)
    rows = sorted(df.collect(), key=lambda r: r["row_id"])
    assert [r["row_id"] for r in rows] == [0, 1, 2] and {r["id"] for r in rows} == {1, 2, 3}
    assert [r["extra"] for r in rows if r["id"] == 3] == [7]
    tol = SF.read_corpus(spark, os.path.join(tmpdir_run, "p*"), tolerant=True, require="extra").collect()
    assert [r["id"] for r in tol] == [3]


def test_read_corpus_tells_files_of_one_name_apart(spark, tmpdir_run):
    for i, (folder, ddl, row) in enumerate((("p1", "id long, extra int", (1, 7)), ("p2", "id long", (2,)), ("p3", "id long, extra int", (3, 8)))):
        spark.createDataFrame([row, row], ddl).coalesce(1).write.parquet(os.path.join(tmpdir_run, f"w{i}"))
        os.makedirs(os.path.join(tmpdir_run, folder))
        part = next(f for f in os.listdir(os.path.join(tmpdir_run, f"w{i}")) if f.endswith(".parquet"))
        with open(os.path.join(tmpdir_run, f"w{i}", part), "rb") as a, open(os.path.join(tmpdir_run, folder, "data.parquet"), "wb") as b:
            b.write(a.read())
    rows = sorted((r["row_id"], r["id"], r["file_name"]) for r in SF.read_corpus(spark, os.path.join(tmpdir_run, "p*"), row_index=True).collect())
    assert rows == [(i, i // 2 + 1, "data.parquet") for i in range(6)]
    tol = SF.read_corpus(spark, os.path.join(tmpdir_run, "p*"), tolerant=True, require="extra").collect()
    assert sorted(r["id"] for r in tol) == [1, 1, 3, 3]


def test_text_dir_csv_jsonl_delimited(spark, tmpdir_run):
    d = os.path.join(tmpdir_run, "txt")
    os.makedirs(d)
    for name, body in (("a.txt", b"  hello\nworld  "), ("b.txt", b"   "), ("c.txt", b"bad \xff byte")):
        with open(os.path.join(d, name), "wb") as f:
            f.write(body)
    got = {r["filename"]: r["text"] for r in SF.read_text_dir(spark, d).collect()}
    assert got == {"a.txt": "hello\nworld", "c.txt": "bad  byte"}
    csvp = os.path.join(tmpdir_run, "fb.csv")
    with open(csvp, "w") as f:
        f.write('query,answer,source,feedback\nq1,"line one\nline ""two""",s,good\nq2,plain,s,bad\n')
    rows = SF.read_feedback_csv(spark, csvp).collect()
    assert len(rows) == 2 and rows[0]["answer"] == 'line one\nline "two"'
    jl = os.path.join(tmpdir_run, "log.jsonl")
    with open(jl, "w") as f:
        f.write('{"timestamp": "2024-01-01T00:00:00", "query": "q", "retrieved_chunks": ["a", "b"], "answer": "x"}\n')
    js = SF.read_jsonl(spark, jl, "timestamp string, query string, retrieved_chunks array<string>, answer string",
                       ["query", "retrieved_chunks"]).collect()
    assert js[0]["retrieved_chunks"] == ["a", "b"]
    texts = spark.createDataFrame([("  first doc \n",), ("second",), ("   ",)], "t string")
    out = os.path.join(tmpdir_run, "delim")
    SF.write_delimited(texts.coalesce(1), out, "t")
    back = sorted(r["text"] for r in SF.read_delimited(spark, out).collect())
    assert back == ["first doc", "second"]


def test_sinks_partition_append_snapshot(spark, tmpdir_run):
    df = spark.createDataFrame([(50, "a"), (150, "b")], "threshold int, chunk_text string")
    p = os.path.join(tmpdir_run, "sweep")
    SF.write_table(df, p, partition_by="threshold")
    assert sorted(os.listdir(p))[:2] == ["_SUCCESS", "threshold=150"] or "threshold=50" in os.listdir(p)
    logp = os.path.join(tmpdir_run, "log")
    SF.append_rows(df.limit(1), logp)
    SF.append_rows(df.limit(1), logp)
    assert SF.read_feedback_csv(spark, logp).count() == 2
    snap = SF.export_snapshot(df, os.path.join(tmpdir_run, "feedback_export"), dt.datetime(2025, 7, 23, 0, 16, 59))
    assert snap.endswith("feedback_export_20250723_001659") and os.path.isdir(snap)


def _png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", w, h) + b"\x08\x02\x00\x00\x00"


def test_image_helpers(spark):
    png = _png(640, 480)
    df = spark.createDataFrame([(1, png, base64.b64encode(png).decode(), str({"bytes": png, "path": "x.png"}), 3)],
                               "id int, raw binary, b64 string, dictstr string, label int")
    s = df.select(SF.image_bytes(df, "raw").alias("r"), SF.image_bytes(df, "b64").alias("b"),
                  SF.image_bytes(df, "dictstr").alias("d")).collect()[0]
    assert bytes(s["r"]) == png and bytes(s["b"]) == png and bytes(s["d"]) == png
    fmt, size = SF.image_header(F.col("raw"))
    h = df.select(fmt.alias("f"), size.alias("s")).collect()[0]
    assert (h["f"], h["s"]) == ("PNG", "640 x 480 px")
    st = spark.createDataFrame([((png, "a.png"), 2)], "image struct<bytes:binary,path:string>, label int")
    assert bytes(st.select(SF.image_bytes(st, "image")).collect()[0][0]) == png
    man = spark.createDataFrame([("f1", 0, 3), ("f1", 1, 4), ("f2", 0, 5)], "file_name string, row_in_file long, label int")
    names = sorted(r["image_name"] for r in SF.image_manifest(man, "file_row").collect())
    assert names == ["0000_img_00000.png", "0000_img_00001.png", "0001_img_00000.png"]


def test_html_paragraphs(spark):
    html = ('<html><head><script>var t="</p>";</script><style>p{}</style></head><body><!-- <p>no</p> -->'
            '<p><b>One &amp; two<br><p class="x">Three</p><div><p>Four</div><P>five</P></body></html>')
    df = spark.createDataFrame([(1, html)], "id int, html string")
    assert H.html_paragraphs(df, "html").collect()[0]["text"] == "One & two Three Four five"


def test_batch_ids(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "k")
    out = {r["k"]: r["batch_id"] for r in SF.batch_ids(df, "k", 100).collect()}
    assert out[0] == 0 and out[99] == 0 and out[100] == 1 and out[249] == 2


def _events(n=400):
    import random
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows, ts = [], t0
    for i in range(n):
        ts = ts + dt.timedelta(seconds=rnd.choice([30, 600, 4000, 90000]))
        rows.append((i, ts, rnd.randrange(3), "error" if rnd.random() < 0.35 else "view"))
    return pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type"])


def _py_trigger(pdf, strict=False):
    out = []
    for uid, g in pdf.sort_values(["user_id", "ts", "event_id"]).groupby("user_id"):
        st = TR.TriggerState()
        for eid, ts, et in zip(g["event_id"], g["ts"], g["event_type"]):
            f = st.step(pd.Timestamp(ts).timestamp(), et == "error", strict)
            if f:
                out.append((str(uid), int(eid), f[0]))
    return sorted(out)


def test_trigger_rules_edges():
    st = TR.TriggerState()
    fired = [st.step(float(i), True) for i in range(20)]
    assert fired[:19] == [None] * 19 and fired[19] == ("threshold", 20)
    st = TR.TriggerState()
    assert [st.step(t, True) for t in (0.0, 1, 2, 3, 4)] == [None] * 5
    assert st.step(3600.0, False) is None                 # 5 bad at 3600 s: no
    assert st.step(3601.0, True) == ("interval", 6)        # 6 bad: fires
    st = TR.TriggerState()
    st.step(0.0, True)
    for t in range(5):
        st.step(1.0 + t, True)
    assert st.step(86400.0 + 10, False) == ("interval", 6)
    st = TR.TriggerState()
    st.step(0.0, True)
    for t in range(5):
        st.step(1.0 + t, True)
    assert st.step(86400.0 + 10, False, strict_reference=True) is None   # .seconds drops the day


def test_trigger_batch_equals_python_and_stream(spark, tmpdir_run):
    pdf = _events()
    df = spark.createDataFrame(pdf)
    batch = sorted((r["key"], r["event_id"], r["reason"]) for r in
                   TR.retrain_trigger_batch(df, "user_id", "ts", "event_id", F.col("event_type") == "error").collect())
    assert batch == _py_trigger(pdf)
    src = os.path.join(tmpdir_run, "events")
    df.coalesce(1).write.parquet(src)
    sdf = spark.readStream.schema(df.schema).parquet(src)
    out = TR.retrain_trigger_stream(sdf, "user_id", "ts", "event_id", F.col("event_type") == "error", watermark="3650 days")
    q = (out.writeStream.format("memory").queryName("trig_out").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_run, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    stream = sorted((r["key"], r["event_id"], r["reason"]) for r in spark.sql("SELECT * FROM trig_out").collect())
    assert stream == batch


def test_stream_history_counters_index(spark, tmpdir_run):
    conv = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "x")], "conv_id long, turn long, text string")
    src = os.path.join(tmpdir_run, "conv")
    conv.coalesce(1).write.parquet(src)
    sdf = spark.readStream.schema(conv.schema).parquet(src)
    q = (G.rolling_history(sdf, 2).writeStream.format("memory").queryName("hist_out").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_run, "ck1")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    hist = {(r["conv_id"], r["turn"]): r["context"] for r in spark.sql("SELECT * FROM hist_out").collect()}
    assert hist == {(1, 0): "", (1, 1): "a", (1, 2): "a\nb", (2, 0): ""}
    fbp = os.path.join(tmpdir_run, "fb")
    fb = spark.createDataFrame([(dt.datetime(2024, 1, 1), "hola", "a", "s", "good", 1.0),
                                (dt.datetime(2024, 1, 1), "hola", "b", "s", "bad", 3.0)], G.FEEDBACK_SCHEMA)
    fb.coalesce(1).write.option("header", True).csv(fbp)
    live = G.live_counters(G.stream_feedback(spark, fbp))
    q = (live.writeStream.format("memory").queryName("live_out").outputMode("complete")
         .option("checkpointLocation", os.path.join(tmpdir_run, "ck2")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    r = spark.sql("SELECT * FROM live_out").collect()[0]
    assert (r["category"], r["good"], r["bad"], r["total"]) == ("conversational", 1, 1, 2)
    docs = spark.createDataFrame([(1, "some words " * 30), (2, "[NO TEXT DETECTED]")], "doc_id long, text string")
    dsrc = os.path.join(tmpdir_run, "docs")
    docs.coalesce(1).write.parquet(dsrc)
    target = os.path.join(tmpdir_run, "chunks")
    G.incremental_index(spark.readStream.schema(docs.schema).parquet(dsrc), target, os.path.join(tmpdir_run, "ck3"),
                        size=20, overlap=5).awaitTermination(120)
    chunks = spark.read.parquet(target)
    assert chunks.select("doc_id").distinct().collect()[0][0] == 1 and chunks.count() == 4


def _append(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_trigger_stream_drops_late_rows_and_ends_idle_state(spark, tmpdir_run):
    schema = "event_id long, ts timestamp, user_id string, event_type string"
    src, day = os.path.join(tmpdir_run, "ev"), dt.datetime(2024, 1, 20)

    def bad(first, n, start, user="u"):
        return [(first + i, start + dt.timedelta(seconds=i), user, "error") for i in range(n)]

    def run():
        sdf = spark.readStream.schema(schema).parquet(src)
        out = TR.retrain_trigger_stream(sdf, "user_id", "ts", "event_id", F.col("event_type") == "error",
                                        watermark="1 hour", idle_seconds=86400)
        q = (out.writeStream.format("parquet").option("checkpointLocation", os.path.join(tmpdir_run, "ck"))
             .trigger(availableNow=True).start(os.path.join(tmpdir_run, "fired")))
        assert q.awaitTermination(90)
        return [r["event_id"] for r in spark.read.parquet(os.path.join(tmpdir_run, "fired")).collect()]

    _append(spark, bad(0, 19, day), schema, src)
    assert run() == []
    _append(spark, bad(100, 1, day - dt.timedelta(days=9)), schema, src)    # would be the 20th bad event
    assert run() == []
    _append(spark, bad(200, 1, day + dt.timedelta(days=5), user="v"), schema, src)   # ends the state of u
    assert run() == []
    _append(spark, bad(300, 2, day + dt.timedelta(days=5)), schema, src)
    assert run() == []
    _append(spark, bad(400, 18, day + dt.timedelta(days=5, seconds=60)), schema, src)
    assert run() == [417]


def test_index_keeps_one_copy_of_repeated_batches_and_the_last_of_changed_documents(spark, tmpdir_run):
    schema = "doc_id long, text string"
    src, target = os.path.join(tmpdir_run, "docs"), os.path.join(tmpdir_run, "chunks")

    def run(ck):
        G.incremental_index(spark.readStream.schema(schema).parquet(src), target, os.path.join(tmpdir_run, ck),
                            size=3, overlap=0).awaitTermination(90)
        return sorted((r["doc_id"], r["chunk_no"], r["chunk_text"]) for r in G.latest_chunks(spark, target).collect())

    _append(spark, [(1, "one two three four"), (2, "kept"), (3, "gone soon")], schema, src)
    first = [(1, 0, "one two three"), (1, 1, "four"), (2, 0, "kept"), (3, 0, "gone soon")]
    assert run("a") == first
    assert run("b") == first                                  # the same batch once more, as after a lost commit
    _append(spark, [(1, "changed"), (3, None)], schema, src)
    assert run("a") == [(1, 0, "changed"), (2, 0, "kept")]


def test_jpeg_size(spark):
    jpeg = (b"\xff\xd8" + b"\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xff\xc4" + struct.pack(">H", 3) + b"x"
            + b"\xff\xc2" + struct.pack(">HBHH", 11, 8, 480, 640) + b"\x01")
    df = spark.createDataFrame([(0, jpeg), (1, jpeg[:12]), (2, None)], "i int, raw binary")
    fmt, size = SF.image_header(F.col("raw"))
    rows = df.select(fmt.alias("f"), size.alias("s")).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [("JPEG", "640 x 480 px"), ("JPEG", None), (None, None)]


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) == {"lang", "n_docs", "n_chunks", "n_tokens", "avg_tokens"}
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 100
    for name in ("clean_ocr_docs", "topk_l2_all", "preference_pairs", "retrain_trigger_fold"):
        assert qs[name](spark, SF001).count() > 0


def test_stream_cache_split_and_periodic_counts(spark, tmpdir_run):
    reqs = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), "k1"), (dt.datetime(2024, 1, 1, 0, 1), "k2"),
                                  (dt.datetime(2024, 1, 1, 0, 2), "k2"), (dt.datetime(2024, 1, 1, 7, 0), "k3")],
                                 "timestamp timestamp, cache_key string")
    src = os.path.join(tmpdir_run, "reqs")
    reqs.coalesce(1).write.parquet(src)
    cache = spark.createDataFrame([("k1", "cached answer")], "cache_key string, answer string")
    sdf = spark.readStream.schema(reqs.schema).parquet(src)
    hits, misses = G.stream_cache_split(sdf, cache)
    q1 = (hits.writeStream.format("memory").queryName("hits_out").outputMode("append")
          .option("checkpointLocation", os.path.join(tmpdir_run, "c1")).trigger(availableNow=True).start())
    q2 = (misses.writeStream.format("memory").queryName("miss_out").outputMode("append")
          .option("checkpointLocation", os.path.join(tmpdir_run, "c2")).trigger(availableNow=True).start())
    q1.awaitTermination(120)
    q2.awaitTermination(120)
    assert [r["cache_key"] for r in spark.sql("SELECT * FROM hits_out").collect()] == ["k1"]
    assert sorted(r["cache_key"] for r in spark.sql("SELECT * FROM miss_out").collect()) == ["k2", "k3"]
    counts = G.periodic_changes(sdf, "timestamp", "6 hours", watermark="1 minute")
    q3 = (counts.writeStream.format("memory").queryName("period_out").outputMode("complete")
          .option("checkpointLocation", os.path.join(tmpdir_run, "c3")).trigger(availableNow=True).start())
    q3.awaitTermination(120)
    got = sorted((r["period_start"].hour, r["n_changes"]) for r in spark.sql("SELECT * FROM period_out").collect())
    batch = sorted((r["period_start"].hour, r["n_changes"]) for r in G.periodic_changes(reqs, "timestamp", "6 hours").collect())
    assert got == batch == [(0, 3), (6, 1)]


def test_reference_log_layouts(spark, tmpdir_run):
    p1 = os.path.join(tmpdir_run, "feedback_log.csv")
    with open(p1, "w") as f:
        f.write('query,answer,source,feedback\nWho is X?,"X is a singer.\nShe has albums, ""Y"" and Z.",0_0.txt,good\n'
                'Where is R?,"R is in Bavaria.",0_17.txt,bad\n')
    rows = SF.read_feedback_csv(spark, p1).collect()
    assert len(rows) == 2 and rows[0]["answer"] == 'X is a singer.\nShe has albums, "Y" and Z.' and rows[1]["source"] == "0_17.txt"
    p2 = os.path.join(tmpdir_run, "timed.csv")
    with open(p2, "w") as f:
        f.write("timestamp,query,answer,feedback\n2025-07-23 10:35:20,q,a,good\n")
    r = SF.read_feedback_csv(spark, p2, SF.TIMED_FEEDBACK_SCHEMA).collect()[0]
    assert r["timestamp"] == dt.datetime(2025, 7, 23, 10, 35, 20)


def test_trigger_ignored_while_training():
    st = TR.TriggerState()
    fires = [st.step(float(i), True, training_seconds=10.0) for i in range(26)]
    assert fires[19] == ("threshold", 20)
    assert all(f is None for f in fires[20:26])       # 20..25 s: training runs 19..29 s, triggers ignored
    st2 = TR.TriggerState()
    out = [st2.step(float(i), True, training_seconds=10.0) for i in range(20)]
    out += [st2.step(29.0, True, training_seconds=10.0)]   # training over at 29: counter reset, this is bad #1
    assert out[-1] is None and st2.bad == 1 and st2.last_train == 29.0


def test_extract_images_from_parquet(spark, tmpdir_run):
    png = _png(32, 16)
    df = spark.createDataFrame([((png, b"a.png"), 1), ((None, b"b.png"), 0), ((png, b"c.png"), 2)],
                               "image struct<bytes:binary,path:binary>, label int")
    p = os.path.join(tmpdir_run, "imgs")
    df.coalesce(1).write.parquet(p)
    src = spark.read.parquet(p).select("image", "label", F.col("image.path").alias("path"))
    out = sorted((r["image_name"], r["format"], r["size"], r["path"]) for r in
                 SF.extract_images(src, "image", "label", path_col="path").collect())
    assert out == [("1_0.png", "PNG", "32 x 16 px", "a.png"), ("2_2.png", "PNG", "32 x 16 px", "c.png")]


def test_describe_with_quartiles(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    r = SF.describe_numeric(df, ["x"], quartiles=True).collect()[0]
    assert (r["count"], r["min"], r["max"]) == (100, 1.0, 100.0) and r["mean"] == 50.5
    assert (r["q25"], r["q50"], r["q75"]) == (25.0, 50.0, 75.0)


def test_text_dir_keeps_a_file_per_row_in_few_folders(spark, tmpdir_run):
    """Rows with one key, null keys and null texts have files of their own; folders do not grow with the rows."""
    rows = [(1, "a b"), (1, "c\nd"), (None, "e"), (None, " f "), (3, None), (4, "")] + [(i, f"t{i}") for i in range(10, 90)]
    SF.write_text_dir(spark.createDataFrame(rows, "k bigint, html string").repartition(1), f"{tmpdir_run}/out", "k", "html", folders=4)
    folders = [n for n in os.listdir(f"{tmpdir_run}/out") if n.startswith("folder=")]
    assert len(folders) <= 4
    assert sum(f.endswith(".txt") for n in folders for f in os.listdir(f"{tmpdir_run}/out/{n}")) == len(rows)
    got = sorted(r["text"] for r in SF.read_text_dir(spark, f"{tmpdir_run}/out").collect())
    assert got == sorted(t.strip() for _, t in rows if t and t.strip())


def test_stream_trigger_takes_few_columns_and_rows_without_times(spark, tmpdir_run):
    """A key's rows reach Python as one text each; a key whose times are all missing ends the run no more."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", i, t0 + dt.timedelta(seconds=i), True) for i in range(25)] + [("b", i, None, True) for i in range(3)] + [("a", None, t0, False)]
    spark.createDataFrame(rows, "k string, e bigint, ts timestamp_ntz, bad boolean").write.parquet(f"{tmpdir_run}/in")
    src = spark.readStream.schema("k string, e bigint, ts timestamp_ntz, bad boolean").parquet(f"{tmpdir_run}/in")
    out = TR.retrain_trigger_stream(src, "k", "ts", "e", F.col("bad"))
    got = []
    (out.writeStream.foreachBatch(lambda b, i: got.extend(b.collect())).option("checkpointLocation", f"{tmpdir_run}/state")
     .trigger(availableNow=True).start().awaitTermination())
    assert [(r["key"], r["event_id"], r["ts"], r["reason"]) for r in got] == [("a", 19, t0 + dt.timedelta(seconds=19), "threshold")]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "timestampdiff" in plan and "event#" in plan
