"""Each operator on nulls, empty and very long texts, ties, repeated rows,
empty tables and clashing names, and against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers as P
from pyspark.sql import functions as F

from textrail.llm import ann, bpe, cotrain, exact, langid, licenses, linededup, minhash, packing, ppm
from textrail.llm.queries import QUERIES

# the rows of the fixture ``docs``
from .conftest import ROWS

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


def brute_exact(rows):
    by = defaultdict(list)
    for k, r in enumerate(rows):
        by[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append((-len(r[1] or ""), r[0] is None, r[0] or 0, k))
    return sorted((rows[k][0] or -1, rows[min(g)[3]][0] or -1, len(g), k == min(g)[3], hashlib.sha256(t.encode()).hexdigest()) for t, g in by.items() for *_, k in g)


@pytest.mark.parametrize("block,bits", [(2048, 64), (7, 64), (7, 2)])
def test_exact_groups(docs, none, block, bits):
    rows = [r for r in ROWS if r[0] != 10] if bits < 64 else ROWS
    df = docs.where("doc_id is null or doc_id <> 10") if bits < 64 else docs
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept, r.text_sha256) for r in exact.exact_groups(df, block=block, bits=bits).collect())
    assert got == brute_exact(rows)
    assert exact.exact_groups(none).count() == 0


def test_drop_copies(docs):
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 2, 4, 7, 8, 9, 10]


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORD)
    got = {(r.doc_id, r.ids, r.decoded) for r in bpe.encode_documents(docs, WORD).collect()}
    want = set()
    for doc, text, *_ in ROWS:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.add((doc, " ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False)))
    assert got == want
    assert bpe.encode_digests(none, WORD).count() == 0


def test_bpe_odd_characters():
    from tokenizers import Tokenizer
    lib, own = Tokenizer.from_file(WORD), bpe.WordBpe(WORD)
    for text in ["ΑΣ İ ﬁ é", "a\x1cb c d", "it's I'LL <|startoftext|>x<|ENDOFTEXT|>", "՘a \U0001f600!!x", "日本語 ½ ²3"]:
        ids = lib.encode(text, add_special_tokens=False).ids
        assert own.both(text) == (" ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False))


def test_packing(docs, none):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BYTE)
    pieces = packing.pack_documents(docs, BYTE, window=256, buffer=4).collect()
    seqs, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length
        seqs[p.sequence_id].append((p.offset, p.length))
        if p.doc_id not in (None, 10):
            parts[p.doc_id].append((p.start, ids))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0
    for doc, text, *_ in ROWS:
        if doc not in (None, 10):
            assert sum((i for _, i in sorted(parts[doc])), []) == [*lib.encode(text or "", add_special_tokens=False).ids, 1]
    assert packing.pack_documents(none, BYTE).count() == 0


def test_best_fill_is_the_best():
    rng = random.Random(4)
    for _ in range(60):
        counts = Counter(rng.randint(1, 30) for _ in range(rng.randint(0, 12)))
        capacity = rng.randint(1, 120)
        reach = {0}
        for length, n in counts.items():
            for _ in range(n):
                reach |= {r + length for r in reach if r + length <= capacity}
        got = packing.best_fill(counts, capacity)
        assert sum(x * n for x, n in got.items()) == max(reach)
        assert all(n <= counts[x] for x, n in got.items())


def test_language(docs, none, spark):
    rng = random.Random(1)
    words = {"en": "the and of to with house green water light".split(), "fr": "le la et de avec maison verte eau lumière".split(), "de": "der die und mit haus grün wasser licht nicht".split()}
    rows = [(i, " ".join(rng.choices(words[x], k=30)), x) for i, x in enumerate(["en", "fr", "de"] * 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(df.where("doc_id >= 30"))
    told = langid.predict(df.where("doc_id < 30"), model).collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in told)
    edge = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert {k for k, r in edge.items() if r.lang_pred == "und"} == {5, 6, 7}
    assert langid.predict(none, model).count() == 0
    nothing = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    single = langid.fit(df.where("lang = 'en'"))
    assert {r.lang_pred for r in langid.predict(df, single).collect()} == {"en"}


def test_codewords_differ():
    for n in (2, 3, 4, 6, 7, 20):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code}) == n and all(len(set(c)) == 2 for c in code.T)


def test_quality(docs, none, spark):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(120):
        bad = i % 4 == 0
        text = " ".join(rng.choice("alpha beta gamma delta epsilon".split()) + ("$$$" if bad else "") for _ in range(40))
        rows.append((i, text, "en", f"s{i % 3}"))
        if i < 80:
            marks.append((i, 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([*marks, (None, 1), (7, None)], "doc_id bigint, quality int")
    model = cotrain.fit(df, labels)
    scored = cotrain.score(df, model).collect()
    assert sum(r.keep == (r.doc_id % 4 != 0) for r in scored) >= 118
    assert cotrain.score(docs, model).count() == len(ROWS) and cotrain.score(none, model).count() == 0
    blank = cotrain.fit(docs, labels.where("false"))
    assert {r.keep for r in cotrain.score(docs, blank).collect()} == {True}


def test_quality_is_a_probability():
    rng = np.random.default_rng(8)
    y = (rng.random(6000) < 0.85).astype(float)
    views = tuple((y[:, None] + rng.normal(0, 1, (6000, 2))).astype(np.float32) for _ in range(2))
    fold = np.arange(6000) % 5
    for folds in (fold, np.where(fold == 0, 1, fold)):  # with and without rows to calibrate on
        model = cotrain.co_train(views, np.where(fold == 1, np.nan, y) if folds is fold else y, folds)
        for side, x in zip((model.content, model.metadata), views, strict=True):
            p = 1 / (1 + np.exp(-side.log_odds(x)))
            assert abs(p.mean() - 0.85) < 0.03
            near = (p > 0.4) & (p < 0.6)
            assert abs(y[near].mean() - 0.5) < 0.12


def test_quality_learns_from_all_unlabelled_rows(spark):
    """The rounds in Spark against plain ones over arrays; copies count once, the order of rows does not matter."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        words = rng.choices("alpha beta gamma delta epsilon zeta".split(), k=30)
        rows.append((i, " ".join(w + ("$" if bad and rng.random() < 0.5 else "") for w in words), "en", f"s{i % 4}" if rng.random() < 0.7 else "s9"))
    rows += [(1000 + i, rows[301][1], "en", rows[301][3]) for i in range(150)] + [(None, "gamma delta", None, None), (None, None, "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    marks = {i: int(i % 4 != 0) for i in range(60)}
    labels = spark.createDataFrame(list(marks.items()), "doc_id bigint, quality int")
    added = 12
    model = cotrain.fit(df, labels, added=added)

    seen = df.select("doc_id", F.xxhash64("doc_id", F.lit(5)).alias("f"), cotrain.key(F.col("source"), F.col("lang"), F.col("text")).alias("key"),
                     F.col("text").alias("_text"), F.col("source").alias("_source"), F.col("lang").alias("_lang")).toArrow()
    batch = seen.combine_chunks().to_batches()[0]
    views = [x.astype(np.float16).astype(np.float32) for x in cotrain._views(batch)]
    ids, keys = seen.column("doc_id").to_pylist(), seen.column("key").to_pylist()
    at = sorted((k for k, i in enumerate(ids) if i in marks), key=lambda k: ids[k])
    pool = {keys[k]: k for k in range(len(ids)) if ids[k] not in marks}
    assert len(pool) < len(ids) - 60 - 140
    given, learned = [{}, {}], []

    def propose(sides, good):
        fresh = [{}, {}]
        for me in (0, 1):
            p = {key: round(float(1 / (1 + np.exp(-sides[me].raw(views[me][k:k + 1])[0].astype(float)))), 6) for key, k in pool.items() if key not in given[1 - me]}
            low = sorted((v, k) for k, v in p.items() if v <= 1 - cotrain.SURE)[:max(1, int(added * (1 - good)))]
            high = sorted((-v, k) for k, v in p.items() if v >= cotrain.SURE)[:max(1, int(added * good))]
            fresh[1 - me] = {k: 0 for _, k in low} | {k: 1 for _, k in high}
            given[1 - me] |= fresh[1 - me]
        learned.append(sum(map(len, fresh)))
        return [(views[i][[pool[k] for k in sorted(fresh[i])]], np.array([fresh[i][k] for k in sorted(fresh[i])], float)) for i in (0, 1)]

    y = np.array([marks[ids[k]] for k in at], float)
    plain = cotrain.co_train(tuple(x[at] for x in views), y, np.array([seen.column("f")[k].as_py() % 5 for k in at]), propose)
    assert sum(learned) > 20
    ours, theirs = (cotrain.probabilities(m, *views)[2] for m in (model, plain))
    assert np.abs(ours - theirs).max() < 1e-3
    again = cotrain.fit(df.orderBy(F.rand(3)).repartition(5), labels.orderBy(F.rand(4)), added=added)
    assert np.abs(cotrain.probabilities(again, *views)[2] - ours).max() < 1e-3


def test_pipeline_stages(spark, tmpdir_run):
    import corpus_pipeline

    rng = random.Random(9)
    lang = {"en": "the and of to with house green water light".split(), "fr": "le la et de avec maison verte eau lumière".split()}
    rows = [(i, " ".join(rng.choices(lang[x], k=40)) + (" $$$ @@@ ###" * 10 if i % 10 < 2 else ""), x, f"s{i % 3}") for i, x in enumerate(["en", "fr"] * 100)]
    rows += [(500, rows[3][1], "fr", "s0"), (501, "12 34 !!", "en", "s0"), (502, None, "en", "s0"),
             (503, (base := " ".join(f"word{k} and" for k in range(200))), "en", "s1"), (504, base + " more", "en", "s1")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmpdir_run}/documents.parquet")
    spark.createDataFrame([(i, 0 if i % 10 < 2 else 1) for i in range(150)], "doc_id bigint, quality int").write.parquet(f"{tmpdir_run}/labels.parquet")
    docs, left = spark.read.parquet(f"{tmpdir_run}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, tmpdir_run).write.parquet(f"{tmpdir_run}/{name}")
        docs = spark.read.parquet(f"{tmpdir_run}/{name}")
        left[name] = sorted(r.doc_id for r in docs.collect())
    text, every = {r[0]: r[1] for r in rows}, {r[0] for r in rows}
    assert {501, 502} <= every - set(left["language"]) and len(left["language"]) >= 200
    good = {i for i in left["language"] if i < 200 and i % 10 >= 2}
    bad = {i for i in left["language"] if i < 200 and i % 10 < 2}
    assert len(good & set(left["quality"])) >= 0.97 * len(good) and len(bad & set(left["quality"])) <= 0.05 * len(bad)
    firsts = {}
    for i in left["quality"]:
        firsts.setdefault("".join(text[i].split()), i)
    assert left["exact_dedup"] == sorted(firsts.values())
    alone = {i for i in left["exact_dedup"] if all(brute_similarity(bag(text[i]), bag(text[k])) < 0.8 for k in left["exact_dedup"] if k != i)}
    assert alone <= set(left["near_dedup"]) <= set(left["exact_dedup"]) and len({503, 504} & set(left["near_dedup"])) == len({503, 504} & set(left["quality"])) // 2
    assert set(left["packing"]) == set(left["near_dedup"])


def bag(text):
    w = re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").strip(" \t\n\x0b\x0c\r"))
    w = [x for x in w if x]
    return Counter(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_similarity(a, b):
    both = a.keys() & b.keys()
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in both)


def test_near_groups_against_brute_force(spark, docs, none):
    rng = random.Random(3)
    base = [[rng.choice([f"w{i}" for i in range(50)]) for _ in range(60)] for _ in range(12)]
    rows = []
    for i in range(120):
        words = list(base[i % 12])
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.class_id for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    bags, root = [bag(t) for _, t in rows], list(range(120))
    for x in range(120):
        for y in range(x):
            if brute_similarity(bags[x], bags[y]) >= 0.8 and root[x] != root[y]:
                old, new = max(root[x], root[y]), min(root[x], root[y])
                root = [new if r == old else r for r in root]
    assert got == dict(enumerate(root))
    edge = minhash.near_groups(docs).collect()
    assert len(edge) == len(ROWS) and sum(r.kept for r in edge) == 8  # 1-3, 4, 5-6, 7, null, 8, 9, 10
    assert minhash.near_groups(none).count() == 0


def test_probability_jaccard():
    a, b = (np.array([1, 2, 3], np.uint64), np.array([1, 2, 1])), (np.array([2, 3, 9], np.uint64), np.array([1, 1, 4]))
    want = brute_similarity(*(Counter(dict(zip(k.tolist(), n.tolist()))) for k, n in (a, b)))
    assert math.isclose(minhash.probability_jaccard(a, b), want)


def test_line_dedup(spark, docs, none):
    long = " ".join(f"p{i}" for i in range(60)) + "."
    short = "Just a short line."
    rows = [(1, f"Intro one.\n{long}\n{short}"), (2, f"{short}\nOther words here. {long} After it."), (3, f"{long}\n{long}"), (4, None), (5, short)]
    got = {r.doc_id: (r.clean_text, r.removed_lines) for r in linededup.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: (f"{short}\nOther words here. After it.", 1), 3: ("", 2), 4: (None, 0), 5: (short, 0)}
    assert linededup.drop_repeats(docs).count() == len(ROWS) and linededup.drop_repeats(none).count() == 0


def test_line_dedup_other_line_breaks(spark):
    words = [f"p{i}" for i in range(45)]
    title, wrapped = "A short title.", " ".join(words[:20]) + "\n" + " ".join(words[20:])
    rows = [(1, " ".join(words)), (2, wrapped), (3, f"{' '.join(words)}\n{title}"), (4, f"{wrapped}\n{title}")]
    got = {r.doc_id: r.clean_text for r in linededup.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1] == rows[0][1]
    # the title is too short to count as a repeat
    assert all(got[k].endswith(title) for k in (3, 4))


def test_line_dedup_by_words(spark):
    rng = random.Random(5)
    passage = [f"q{i}" for i in range(51)]
    fresh = (f"u{i}" for i in range(100_000))
    rows = [(0, " ".join([*(next(fresh) for _ in range(7)), *passage, *(next(fresh) for _ in range(7))]))]
    for k in range(1, 20):
        mid = "".join(w + rng.choice([" ", " ", "\n", "  "]) for w in passage).strip()
        # amid a sentence, hard-wrapped, beside full stops that are not ASCII
        rows.append((k, f"{next(fresh)} {next(fresh)}。 {mid} {next(fresh)}"))
    rows += [(30, " ".join(f"p{i}" for i in range(45))), (31, "\n".join([" ".join(f"p{i}" for i in range(20)), " ".join(f"p{i}" for i in range(20, 45))]))]
    twice = [next(fresh) for _ in range(60)]
    rows.append((40, " ".join([*twice, next(fresh), *twice, next(fresh), *twice])))
    got = {r.doc_id: r for r in linededup.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].clean_text == rows[0][1] and got[30].clean_text == rows[20][1] and got[31].clean_text == ""
    for k in range(1, 20):
        w = rows[k][1].split()
        assert got[k].clean_text.split() == [*w[:2], w[-1]] and got[k].removed_words == 51
    assert got[40].clean_text.split() == [w for i, w in enumerate(rows[-1][1].split()) if i < 61 or i == 121]


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(6)
    pieces = [[f"w{rng.randrange(300)}" for _ in range(rng.randint(42, 90))] for _ in range(8)]
    rows = []
    for k in range(40):
        words = []
        for _ in range(3):
            p = rng.choice(pieces)
            a = rng.randrange(20)
            words += [*p[a:len(p) - rng.randrange(20)], *(f"x{rng.randrange(10 ** 9)}" for _ in range(rng.randint(0, 30)))]
        rows.append((k, "".join(w + rng.choice([" ", "\n", ". "]) for w in words).replace(". ", " ")))
    got = {r.doc_id: r for r in linededup.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}

    def covered(w, seen, size):
        hit = set()
        own = set()
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            if g in seen or g in own:
                hit |= set(range(i, i + size))
            own.add(g)
        return hit

    long, short = set(), set()
    for k, text in rows:
        w = text.split()
        must, may = covered(w, long, 50), covered(w, short, 40)
        # of each run of 50 words and more all but REACH words at its ends
        inner = {i for i in must if all(i + j in must for j in range(-linededup.REACH, linededup.REACH + 1))}
        assert len(inner) <= got[k].removed_words <= len(may) and len(w) - got[k].removed_words == len(got[k].clean_text.split())
        long |= {tuple(w[i:i + 50]) for i in range(len(w) - 49)}
        short |= {tuple(w[i:i + 40]) for i in range(len(w) - 39)}


def test_licenses(spark, docs, none):
    rows = [(1, "a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License"),
            (2, "a/b/x.txt", "nothing here"), (3, "a/b/y.txt", "Some text.\nLicensed under the Apache License, Version 2.0.\nMore."),
            (4, "c/z.txt", "nothing"), (5, None, None), (6, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (7, "a/w.txt", "")]
    df = spark.createDataFrame(rows, "doc_id bigint, place string, text string")
    got = {r.doc_id: (r.license, r.via, r.origin) for r in licenses.scan(df, F.col("place")).collect()}
    assert got == {1: ("MIT", "file", None), 2: ("GPL-3.0", "inherited", "a/b/LICENSE"), 3: ("Apache-2.0", "header", None), 4: (None, None, None),
                   5: (None, None, None), 6: ("GPL-3.0", "file", None), 7: ("MIT", "inherited", "a/LICENSE")}
    assert licenses.scan(docs, F.lit(None).cast("string")).where("license is not null").count() == 0
    assert licenses.scan(none, F.col("source")).count() == 0


def test_licenses_in_long_lines(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
           "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
           "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
    chaff = " ".join(f"chaff{i}" for i in range(200))
    rows = [(1, mit), (2, f"{chaff} licensed under the apache license, version 2.0 {chaff}"), (3, f"{chaff} licensed {chaff}"), (4, f"note: this work is licensed under the gnu general public license, version 3, ok")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.license, r.via) for r in licenses.scan(df, F.lit("a/b.txt")).collect()}
    assert got == {1: ("MIT", "header"), 2: ("Apache-2.0", "header"), 3: (None, None), 4: ("GPL-3.0", "header")}


def test_licenses_query_inherits(spark, tmpdir_run):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    # ids of which (id / 4) % 3 is 0, 1 and 2: licence files of the folders of 10,000, 1,000 and 100 ids
    rows = [(12, f"Some words.\n{mit}"), (1012, f"{gpl}\nMore words."), (1100, mit), (1, "plain"), (1001, "plain"), (1101, "plain"), (1102, None),
            (1103, f"Mine. {gpl}"), (20_001, "plain"), (None, "plain"), (4, "plain")]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{tmpdir_run}/documents.parquet")
    got = {r.doc_id: (r.license, r.via, r.origin) for r in QUERIES["op2_licenses"](spark, tmpdir_run).collect()}
    top, mid, low = "s/0/LICENSE-12", "s/0/1/LICENSE-1012", "s/0/1/11/LICENSE-1100"
    assert got == {12: ("MIT", "file", None), 1012: ("GPL-3.0", "file", None), 1100: ("MIT", "file", None), 1: ("MIT", "inherited", top), 4: ("MIT", "inherited", top),
                   1001: ("GPL-3.0", "inherited", mid), 1101: ("MIT", "inherited", low), 1102: ("MIT", "inherited", low), 1103: ("GPL-3.0", "header", None),
                   20_001: (None, None, None), None: (None, None, None)}


def test_ppm_against_brute_force(docs, none):
    rows = [r for r in ROWS if r[0] != 10]
    train = [r for r in rows if (r[0] or 0) % 3 != 1]
    seqs = {k: [0xFF] * 3 + list(b" ".join(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (r[1] or "").encode()).split())) + [0xFE] for k, r in enumerate(rows)}
    trie = defaultdict(Counter)
    for k, r in enumerate(rows):
        if r in train:
            s = seqs[k]
            for p in range(3, len(s)):
                for j in range(4):
                    trie[tuple(s[p - j:p])][s[p]] += 1

    def length(s, p):
        seen, total = set(), 0.0
        for j in range(3, -1, -1):
            node = trie.get(tuple(s[p - j:p]))
            if not node:
                continue
            left = {a: n for a, n in node.items() if a not in seen}
            n = sum(left.values())
            if s[p] in left:
                return total + math.log10((2 * left[s[p]] - 1) / (2 * n))
            if n:
                total += math.log10(len(left) / (2 * n))
            seen |= set(node)
        return total - math.log10(256 - len(seen))

    df = docs.where("doc_id is null or doc_id <> 10")
    got = sorted((r.doc_id or -1, r.n_tokens, r.score, r.base_score) for r in ppm.score(df, F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1, order=3).collect())
    words = Counter(w for r in train for w in [*re.sub(rb"[A-Z]", lambda m: m[0].lower(), (r[1] or "").encode()).split(), None])
    size = sum(words.values()) + 0.5 * (len(words) + 1)
    want = sorted((r[0] or -1, len(seqs[k]) and len(b"".join([bytes(seqs[k][3:-1])]).split()) + 1, sum(length(seqs[k], p) for p in range(3, len(seqs[k]))),
                   sum(math.log10((words.get(w, 0) + 0.5) / size) for w in [*bytes(seqs[k][3:-1]).split(), None])) for k, r in enumerate(rows))
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-5) and math.isclose(g[3], w[3], rel_tol=1e-9)
    assert ppm.score(none, F.lit(True)).count() == 0
    assert {r.n_known for r in ppm.score(docs, F.lit(False)).collect()} == {0}


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    x[50:90] = x[50]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    bad = [(900, None, 1), (901, [0.0] * 8, 1), (902, [None] + [1.0] * 7, 1), (903, [float("nan")] + [1.0] * 7, 1), (904, [float("inf")] + [1.0] * 7, 1), (905, [1.0], 1)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, row int")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    hit = 0
    for q in range(0, 300, 20):
        s = x @ x[q]
        want = sorted((i for i in range(300) if i != q), key=lambda i: (-round(s[i], 9), i))[:10]
        assert len(got[q]) == 10
        hit += len(set(want) & set(got[q]))
    assert hit >= 0.9 * 150 and got[60] == [50, 51, 52, 53, 54, 55, 56, 57, 58, 59] and got.keys() == set(range(0, 300, 20))
    assert ann.nearest(df.where("vec_id < 3"), F.lit(True), k=10).count() == 6
    assert ann.nearest(df.where("false"), F.lit(True)).count() == 0


def test_neighbours_read_few_cells_of_clustered_rows():
    """The visits are fitted: on 100,000 clustered vectors a query reads less than a tenth of them and finds nine tenths of its neighbours."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 64))[rng.integers(0, 1000, 100_000)] + 0.8 * rng.normal(size=(100_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = ann.make_tables(float(np.linalg.norm(x, axis=1).max()), x[:ann.ROWS], len(x))

    def exact(ids):
        s = x[ids] @ x.T
        s[np.arange(len(ids)), ids] = -np.inf
        return np.argsort(-s, axis=1, kind="stable")[:, :20]

    tried, held = np.arange(0, 960, 10), np.arange(5, 1005, 20)
    t = ann.fit_visits(t, x[tried], [x[n] for n in exact(tried)])
    _, cells = ann.cells_of(t, x)
    _, visits = ann.visits_of(t, x[held], t.probes)
    read = np.stack([np.any([np.isin(cells[:, k], v[k]) for k in range(ann.TABLES)], axis=0) for v in visits])
    assert read.mean() < 0.1
    assert np.take_along_axis(read, exact(held), axis=1).mean() >= 0.9


def test_crc_of_packed_ids():
    ids = np.array([5, 70000], "<u4").tobytes()
    assert zlib.crc32(ids) == zlib.crc32(b"\x05\x00\x00\x00\x70\x11\x01\x00")
