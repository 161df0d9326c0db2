import os
import re
import subprocess
import sys

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from assetlake.llm import secret_scan as S
from test_minhash_dedup import brute as near

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_run_against_brute_force(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    stay = {i: t for i, t in rows.items() if re.search(r"[^\W\d_]", t)}  # every document is in a learned language
    last = {re.sub("[A-Z]", lambda m: m[0].lower(), t): i for i, t in sorted(stay.items())}
    stay = {i: stay[i] for i in last.values()}
    comp = near(list(stay.items()))
    stay = {i: t for i, t in stay.items() if comp[i][1] == i}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in stay.items():
        for start, v, before, _ in reversed(list(S.candidates(t))):
            if S.weak_label(v, before):
                t = t[:start] + S.MASK + t[start + len(v):]
        want[i] = lib.encode(t, add_special_tokens=False).ids + [2]
    got = {}
    for r in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(got.setdefault(r.doc_id, []))
        got[r.doc_id] += r.ids
    assert set(got) == set(want)
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_works_without_the_subpackage(tmp_path):
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('assetlake.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert not any(q.startswith('op') or q == 'pipeline' for q in e.queries()) and e.oracle_sql()\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
