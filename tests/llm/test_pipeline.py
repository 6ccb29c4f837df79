"""The pipeline, stage by stage, against loops over what the stage before it kept."""

import os
import subprocess
import sys

import public_tokenizers

import corpus_pipeline
from tests.llm import brute
from tests.llm.helpers import AWKWARD, documents
from tests.llm.test_packing import check
from tidemark.llm import neardup, packing, toxicity
from tidemark.llm.spark import stored

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = stored(stage(spark, docs, FOLDER), "stage")
        if name != "packing":
            assert docs.columns == columns

    before, after = (seen[n] for n in ("toxicity", "line dedup"))
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = toxicity.score(before, toxicity.train_open(before, labels)).collect()
    assert sorted(r.doc_id for r in scored if r.score < 0.3) == sorted(r.doc_id for r in after.collect())

    kept = seen["near-duplicate dedup"].orderBy("doc_id").collect()
    expected = brute.without_repeats([(r.doc_id, r.text) for r in after.collect()])
    assert {r.doc_id: r.text for r in kept} == expected

    singles = seen["packing"].collect()
    groups = brute.classes([r.text for r in kept])
    assert sorted(r.doc_id for r in singles) == sorted({kept[c].doc_id for c in groups})
    assert docs.select("doc_id").distinct().count() == len(singles)

    ran = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "piece", "ids_crc32", "sequence_id", "offset"]
    assert sorted(ran.select(*key).collect()) == sorted(docs.select(*key).collect())


def test_awkward_documents_pass_all_stages(spark, tmp_path):
    docs = documents(spark, AWKWARD).selectExpr("nullif(doc_id, 3) doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, 0, 0) for i in range(1, len(AWKWARD) + 1)] * 3 + [(None, 1, 1), (999, 1, 1)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # one document without words and each other text once, the null id among them
    assert len({r.doc_id for r in found}) == 7


def test_packing_of_what_is_left(spark):
    docs = documents(spark, ["one two", "one two", "three"])
    left = neardup.keep_one(docs).orderBy("doc_id")
    path = public_tokenizers.path("word_bpe_49k.json")
    found = packing.pack(left.selectExpr("if(doc_id = 3, 2, doc_id) doc_id", "text"), path).collect()
    check(found, ["one two", "three"], 2048)


def test_the_entry_works_without_the_operators(tmp_path):
    """As after deleting both folders and the pipeline."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name in ('tidemark.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries()); assert len(names) > 90 and set(e.oracle_sql()) <= names\n"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in names)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_a_broken_operator_is_not_hidden(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        "import sys\nsys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e\n"
        "try:\n    e.queries()\nexcept ImportError:\n    sys.exit(0)\nsys.exit(1)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
