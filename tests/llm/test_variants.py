"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from textrail.llm import variants
from textrail.llm.queries import QUERIES

from .conftest import ROWS


def edited(word):
    """Every deletion of a word, with its place: words that share one of equal place differ there alone."""
    return {(k, word[:k] + word[k + 1:]) for k in range(len(word))}


def brute(vocab, factor=10):
    """vocab: word -> n"""
    words = list(vocab)
    replaced = {}
    for w in words:
        for e in edited(w):
            replaced.setdefault(e, []).append(w)
    near = {w: set() for w in words}
    for w in words:
        for k, d in edited(w):
            near[w].update(x for x in replaced[k, d] if x != w)
            if d in near:
                near[w].add(d)
                near[d].add(w)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-vocab[x], x))
            if vocab[best] >= factor * vocab[w]:
                form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, vocab[w], len(near[w]), vocab.get(form.get(w))))
    return sorted(out)


def grouped(spark, vocab, **more):
    df = spark.createDataFrame([(w, n, "x") for w, n in vocab.items()], "word string, n bigint, near string")
    got = variants.group_variants(df, **more)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


def random_words(n, letters, sizes, seed):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.choice(sizes))) for _ in range(n)}
    for w in list(words):  # chains of variants
        for _ in range(2):
            k = rnd.randrange(len(w))
            words.add(rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice(letters) + w[k:], w[:k] + rnd.choice(letters) + w[k + 1:]]))
    return {w: rnd.choice([2, 3, 20, 30, 400, 5000]) for w in sorted(words)}


@pytest.mark.parametrize("letters,sizes,limit", [("ab", (7, 8, 9), 20_000), ("abcdéÿ", (7, 8, 12), 20_000), ("ab", (7, 8), 5), ("a\U0001f600z", (2, 3, 5, 6), 7)])
def test_equals_brute_force(spark, monkeypatch, letters, sizes, limit):
    monkeypatch.setattr(variants, "LIMIT", limit)
    monkeypatch.setattr(variants, "CHUNK", 40)
    vocab = {w: n for w, n in random_words(120, letters, sizes, 1).items() if len(w) > 1}
    assert grouped(spark, vocab) == brute(vocab)


def test_composition_equals_brute_force():
    for seed in range(20):
        rnd = random.Random(seed)
        words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.choice((0, 1, 3, 4, 5)))) for _ in range(60)})
        codes = np.array([ord(c) for w in words for c in w], np.int64)
        at = np.r_[0, np.cumsum([len(w) for w in words])]
        role = np.array([rnd.choice((1, 2, 3)) for _ in words])
        u, v = variants.near_pairs(np.zeros(len(words), np.int64), role, codes, at)
        got = sorted((words[a], words[b]) for a, b in zip(u, v, strict=True))
        want = sorted((a, b) for a, i in zip(words, role, strict=True) for b, j in zip(words, role, strict=True) if i & 1 and j & 2 and a != b
                      and ((len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1) or (len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b))))))
        assert got == want


def test_acceptors_are_minimal():
    words = sorted(a + b + c for a in "pq" for b in ("aa", "b") for c in ("x", "yz"))
    codes = np.array([ord(c) for w in words for c in w], np.int64)
    m = variants.Acceptor(np.zeros(len(words), np.int64), codes, np.r_[0, np.cumsum([len(w) for w in words])], 1)
    # the end, before z, before x or yz, before the second a, before aa or b, the root
    assert len(m.final) == 6 and m.final.sum() == 1


def test_chains_reach_their_root(spark):
    vocab = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000, "abcdefghijkl": 200000, "zbcdefghijkl": 200000, "abcdefghijkm": 200000}
    got = grouped(spark, vocab)
    assert got == brute(vocab)
    assert {r[2] for r in got if r[0].startswith("abcdefg") and r[3] < 200000} == {"abcdefghijkl"}


def test_odd_vocabularies(spark):
    assert grouped(spark, {}) == []
    long = "".join(random.Random(1).choice("abcdef") for _ in range(3000))
    vocab = {long: 100, long[:1500] + long[1501:]: 9, long + "a": 2, "a": 3, "b": 50}
    got = grouped(spark, vocab)
    assert [r[:2] for r in got if r[0] in "ab"] == [("a", None), ("b", None)]
    assert sorted(r for r in got if r[0] not in "ab") == brute({w: n for w, n in vocab.items() if len(w) > 1})
    df = spark.createDataFrame([(None, 3), ("abcdefg", None), ("abcdefh", 3)], "word string, n bigint")
    assert [tuple(r) for r in variants.group_variants(df).collect()] == [("abcdefh", None, "abcdefh", 3, 0, None)]
    with pytest.raises(ValueError):
        variants.group_variants(df, factor=1)


def words_of(rows):
    count = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


@pytest.mark.parametrize("some", [0, None])
def test_query(spark, tmp_path, some):
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("aeinorstÀÉ") for _ in range(rnd.choice((6, 7, 8, 11)))) for _ in range(40)]
    rows = [*ROWS, *((100 + i, " ".join(rnd.choice(vocab) for _ in range(200)) + "x×÷y1" * (i % 3), "en", "s", "r") for i in range(60))][:some]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op13_variants"](spark, str(tmp_path)).collect())
    assert got == brute(words_of(rows))
    assert some == 0 or any(r[1] for r in got)
