import os
import time

from assetlake.llm import line_dedup as L
from assetlake.llm import suffix_dedup as S


def shuffle_files(spark) -> set[str]:
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (folder.apply(k) for k in range(folder.size())) if f.getName().startswith("shuffle_")}


def gone(spark, files: set[str]) -> bool:
    end = time.time() + 10
    while shuffle_files(spark) & files and time.time() < end:
        time.sleep(0.1)
    return not shuffle_files(spark) & files


def test_texts_are_shuffled_once_and_no_longer_kept_than_needed(spark, monkeypatch):
    docs = spark.createDataFrame([(bytes([k]) * 32, f"{k} " * 300) for k in (1, 2, 3, 3, 3)], "digest binary, text string")
    before, seen = shuffle_files(spark), []
    tidy = S.tidy
    monkeypatch.setattr(S, "tidy", lambda s: seen.append(shuffle_files(s)) or tidy(s))
    got = S.distinct_texts(docs, 400)
    assert sorted((r.text[0], r.copies) for r in got.collect()) == [("1", 1), ("2", 1), ("3", 3)]
    made = seen[0] - before
    assert len({f.split("_")[1] for f in made}) == 1
    assert gone(spark, made)


def test_shuffled_lines_go_once_the_signatures_are_stored(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "\n".join(f"line {k} {j} of some length" for j in range(20))) for k in range(20)], "doc_id long, text string")
    before, state = shuffle_files(spark), {}
    store = L.store

    def watched(df, name):
        if name == "line-buckets":
            state["gone"] = gone(spark, state["made"])
        out = store(df, name)
        if name == "line-sigs":
            state["made"] = shuffle_files(spark) - before
        return out

    monkeypatch.setattr(L, "store", watched)
    assert L.line_components(docs).count() == 400
    assert state["made"] and state["gone"]
