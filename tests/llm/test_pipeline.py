"""The pipeline against its stages' plain versions, and without the operators' folder."""

import random
import subprocess
import sys

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_prob_minhash import classes


def test_stages(spark, documents):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, SMALL), "test")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == documents.columns
    lang_in, lang_out = seen["language"]
    assert lang_in.count() == lang_out.count()  # all clean documents have a language
    near_in, near_out = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen["near copies"])
    assert set(near_out) == set(classes(near_in).values())
    bench_in, bench_out = ({r["doc_id"] for r in d.collect()} for d in seen["benchmark"])
    assert bench_out < bench_in
    assert {r["doc_id"] for r in docs.collect()} == bench_out
    lines_out = seen["lines"][1].collect()
    assert all(r["n_chars"] == len(r["text"]) for r in lines_out)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, docs.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))


def test_rejected_documents(spark):
    rows = [(1, "the house and the garden", "en"), (2, "das haus und der garten", "de"), (3, None, "en"), (4, "12 34", "en"), (5, "", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, found string")
    got = corpus_pipeline.known_language(spark, df, SMALL)
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 2]


def test_unlearned_script_and_random_letters_go(spark, documents):
    rng = random.Random(7)
    def noise(letters, words):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(words))
    latin, others = "abcdefghijklmnopqrstuvwxyz", ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")
    texts = [noise(x, n) for x in (latin, *others) for n in (25, 150, 150, 600)]
    real = documents.select("doc_id", "text", "lang")
    df = real.union(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(texts)], real.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.known_language(spark, df, SMALL).collect()}
    assert kept == {r["doc_id"] for r in corpus_pipeline.known_language(spark, real, SMALL).collect()}
    assert len(kept) == real.filter("text rlike '\\\\p{L}'").count()


def test_empty_table_passes_all_stages(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SMALL), "test")
    assert docs.count() == 0


def test_entry_works_without_the_folder(tmp_path):
    """The registered queries of the rest import when the operators' folder and the pipeline are absent."""
    code = ("import sys, importlib.abc\n"
            "class Absent(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('pricekit.llm'):\n"
            "            raise ModuleNotFoundError('absent', name=name)\n"
            "sys.meta_path.insert(0, Absent())\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())\n")
    import os
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
