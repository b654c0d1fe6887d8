"""Pipeline stages on columns that clash with their own, on empty tables and on long runs."""

import uuid
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers as P

import corpus_pipeline
from textrail.llm import packing

SCHEMA = ("doc_id bigint, text string, lang string, source string, _row string, _text string, score string, keep string, lang_pred string, "
          "ambiguous string, p_content string, quality_score string, _id string, _source string, `odd name` string, doc struct<doc: string>")
BYTE = P.path("byte_bpe_50k.json")


def rows(n):
    words = {"en": "the house of a friend was near to the river and we went there on foot every day".split(),
             "fr": "la maison de mon ami se trouvait pres de la riviere et nous y allions a pied chaque jour".split()}
    out = []
    for i in range(n):
        lang = ("en", "fr")[i % 2]
        text = " ".join(words[lang][(i * 7 + j * j + j * (i // 9)) % len(words[lang])] for j in range(60)) + f" number {i // 2 * 2}."
        out.append((i, text, lang, "s", *(f"{c}{i}" for c in "rtskpacqids"), (f"x{i}",)))
    return [*out, *((1000 + r[0], *r[1:]) for r in out[:5])]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('stages')}/{uuid.uuid4().hex}"
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 80, 2)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_clashing_columns(spark, folder, name, stage):
    given = rows(80)
    got = stage(spark, spark.createDataFrame(given, SCHEMA).repartition(3), folder)
    assert got.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
    left = [tuple(r) for r in got.collect()]
    assert left and set(left) <= set(given) and len(set(left)) == len(left)
    if name.endswith("dedup"):
        assert {r[0] for r in left}.isdisjoint(range(1000, 1010)) and len({r[1] for r in left}) == len(left)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, folder, name, stage):
    assert stage(spark, spark.createDataFrame([], SCHEMA), folder).count() == 0


@pytest.mark.parametrize("run", [" ", "\n", "\t", "\u00a0", " \n"])
def test_packing_of_long_runs(spark, run):
    from tokenizers import Tokenizer
    texts = ["word " + run * (1_000_000 // len(run)) + "end", "short", run * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    parts = defaultdict(list)
    for p in packing.pack_documents(df, BYTE).collect():
        parts[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    lib = Tokenizer.from_file(BYTE)
    for i, text in enumerate(texts):
        assert [x for _, ids in sorted(parts[i]) for x in ids] == lib.encode(text, add_special_tokens=False).ids + [packing.END_ID]
