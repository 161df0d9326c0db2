import zlib

import numpy as np

from assetlake.llm import langid as L

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def test_grams_against_brute_force():
    texts = ["Hello  World!", "", "a", "Äb cde", "1234", "x" * 50]
    keys, before, letter = L.grams(texts)
    for i, t in enumerate(texts):
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        want = [s[k:k + 4] for k in range(len(s) - 3) if "  " not in s[k:k + 4]]
        s2 = " " + s + " "
        want = [s2[k:k + 4] for k in range(len(s2) - 3) if "  " not in s2[k:k + 4]]
        got = ["".join(chr(int(x) >> sh & 0xFFFF) for sh in (48, 32, 16, 0)) for x in keys[before[i]:before[i + 1]]]
        assert sorted(got) == sorted(want), t
    assert letter.tolist() == [True, False, True, True, False, True]


def test_filter_has_no_false_negative_and_known_false_rate():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, (2, 5000)).astype(np.uint64)
    f = L.Filter({"a": a, "b": b}, "a", slots_log2=16)
    assert (f.masks(a)[0] & 1).all() and (f.masks(b)[0] & 2).all()
    other = rng.integers(0, 1 << 63, 200_000).astype(np.uint64)
    assert abs((f.masks(other)[0] & 1).mean() - f.false_rate[0]) < 0.01


def test_grams_of_dense_scripts():
    texts = ["日本語です ok", "漢", "abc漢def", "\U00020001\U00020002", ""]
    keys, before, letter = L.grams(texts)
    for i, t in enumerate(texts):
        dense = [ord(c) > 0x3000 for c in t]
        want = [ord(c) for c, d in zip(t, dense) if d] + [(ord(t[k]) << 21) | ord(t[k + 1]) for k in range(len(t) - 1) if dense[k] and dense[k + 1]]
        s = " " + "".join(" " if d or not c.isalpha() else c for c, d in zip(t, dense)) + " "
        want += [int.from_bytes(s[k:k + 4].encode("utf-16-be")) for k in range(len(s) - 3) if "  " not in s[k:k + 4]]
        assert sorted(map(int, keys[before[i]:before[i + 1]])) == sorted(want), t
    assert letter.tolist() == [True, True, True, True, False]


def test_top_grams_cover_and_bound(spark):
    rows = [("flat", g, 1) for g in range(5000)] + [("steep", g, 1 << (20 - g) if g < 20 else 1) for g in range(3000)]
    counts = spark.createDataFrame(rows, "lang string, gram long, n long")
    got = {}
    for r in L.frequent_grams(counts, cover=0.9, most=1000).collect():
        got.setdefault(r.lang, set()).add(r.gram)
    assert 850 <= len(got["flat"]) <= 1150          # drawn by hash, none is more frequent
    assert got["steep"] >= {0, 1, 2} and len(got["steep"]) <= 4
    assert L.frequent_grams(counts.limit(0)).count() == 0


def _random(spark, n, langs):
    rng = np.random.default_rng(5)
    rows = []
    for k, (lang, alphabet, length) in enumerate(langs):
        letters = np.array(list(alphabet))
        rows += [(i * len(langs) + k, "".join(rng.choice(letters, length)), lang, None, None, None) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


HAN = "".join(map(chr, range(0x4E00, 0x9E00)))


def test_flat_language_stays_on_as_the_corpus_grows(spark):
    for n in (50, 600):
        han = _random(spark, n, [("zh", HAN, 120)])
        words = spark.createDataFrame([(10**6 + i, f"the cat number {'abcdefghij'[i % 10] * 3} sat on the mat with words and words", "en", None, None, None)
                                       for i in range(n)], SCHEMA)
        docs = han.unionByName(words)
        rows = L.predict(docs, L.train(docs.where(~L.held_out())), "lang").where(L.held_out()).collect()
        assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.95
        assert L.stage(spark, docs, SF).where("lang = 'zh'").count() >= 0.97 * n


def test_seventy_languages(spark):
    langs = [(f"l{k:02d}", "".join(chr(0x400 + 3 * k + j) for j in range(3)), 60) for k in range(70)]
    docs = _random(spark, 10, langs)
    rows = L.predict(docs, L.train(docs), "lang").collect()
    assert len(rows) == 700 and np.mean([r.lang_pred == r.lang for r in rows]) >= 0.95


def test_held_out_accuracy(spark):
    rows = L.q_language_id(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held)
    print("held-out accuracy", right)
    assert right >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat", "en", None, None, "q"), (2, "der hund und die katze", "de", None, None, "q"),
                                (3, None, None, None, None, None), (4, "123 !!", "en", None, None, None), (5, "ж", None, None, None, None),
                                (None, "the cat", "en", None, None, None), (6, "the mat " * 50_000, None, None, None, None)], SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(df, L.train(df)).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[6][0] == "en"
    assert got[3] == got[4] == ("und", 0.0) and got[5] == ("en", 0.0)
    assert L.predict(df.limit(0), L.train(df.limit(0))).count() == 0
    assert {r.doc_id for r in L.stage(spark, df, SF).collect()} >= {1, 2, 6}
