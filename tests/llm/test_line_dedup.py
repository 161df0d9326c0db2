import random

from assetlake.llm import line_dedup as X

SF = "/root/testdata/sf0.001"


def shingles(line):
    b = line.strip(" ").encode()
    return {b[k:k + X.SHINGLE] for k in range(max(1, len(b) - X.SHINGLE + 1))}


def brute(rows):
    """(doc, line) -> (kept doc, kept line): all pairs of distinct lines that share a shingle."""
    every = [((d, k), line.strip(" ")) for d, t in rows if t is not None for k, line in enumerate(t.split("\n"))]
    distinct = sorted({x for _, x in every if x})
    sets = {x: shingles(x) for x in distinct}
    root = {x: x for x in distinct}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for x in distinct:
        for s in sets[x]:
            where.setdefault(s, []).append(x)
    common = {}
    for xs in where.values():
        for p in range(len(xs)):
            for q in range(p):
                common[xs[q], xs[p]] = common.get((xs[q], xs[p]), 0) + 1
    near = 0
    for (x, y), n in common.items():
        if 100 * n >= 75 * (len(sets[x]) + len(sets[y]) - n):
            near += 1
            root[top(x)] = top(y)
    first = {}
    for at, x in every:
        if x:
            first.setdefault(top(x), []).append(at)
    first = {r: min(v, key=lambda at: (at[0] is None, at)) for r, v in first.items()}
    return {at: first[top(x)] if x else at for at, x in every}, near


def result(df):
    rows = df.collect()
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.keep_doc_id, r.keep_line_no)) for r in rows)
    return {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in rows}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want, near = brute(rows)
    df = X.q_line_dedup(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert result(df) == want


def edited(rng, near):
    words = [f"{rng.choice(['al', 'be', 'ga'])}{rng.randrange(10**5)}" for _ in range(40)]
    out = [" ".join(words)]
    for _ in range(near):
        w = list(words)
        w[rng.randrange(40)] = "changed"
        out.append(" ".join(w))
    return out


def test_near_lines_and_edges(spark, monkeypatch):
    rng = random.Random(6)
    every = [x for _ in range(15) for x in edited(rng, 4)]
    chain = [f"c{k} {rng.randrange(10**9)}" for k in range(200)]
    every += [" ".join(chain[5 * k:5 * k + 40]) for k in range(20)]
    rng.shuffle(every)
    rows = [(i, "\n".join(["", " same line here ", "x", *every[4 * i:4 * i + 4], "é" * i])) for i in range(21)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "y" * 200_000), (54, "y" * 200_000 + "z")]
    want, near = brute(rows)
    assert near > 60
    df = spark.createDataFrame([(i, t, 1, "x", None) for i, t in rows], "doc_id long, text string, id int, line string, h1 long")
    assert result(X.line_components(df)) == want
    monkeypatch.setattr(X, "CELL", 2)
    assert result(X.line_components(df)) == want
    assert X.line_components(df.limit(0)).count() == 0
    texts = {r.doc_id: r.text for r in X.rebuild(df, X.line_components(df)).collect()}
    for i, t in rows:
        assert texts[i] == (t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if want[i, k] == (i, k)))


def found_pairs(spark, pairs):
    """Share of the pairs whose two lines are one component."""
    rows = [(k, f"{a}\n{b}") for k, (a, b) in enumerate(pairs)]
    got = result(X.line_components(spark.createDataFrame(rows, "doc_id long, text string")))
    return sum(got[k, 1] == (k, 0) for k in range(len(pairs))) / len(pairs)


def test_short_lines_near_the_threshold_are_candidates(spark):
    """Isolated pairs of 8 to 40 shingles in the union, at similarity 0.75 to 0.85."""
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    pairs = []
    while len(pairs) < 1500:
        union = rng.randrange(8, 41)
        same = rng.randrange(union)
        if 0.75 <= same / union <= 0.85:
            b = "".join(rng.choice(letters) for _ in range(union + X.SHINGLE - 1))
            pairs.append((b[:same + X.SHINGLE - 1], b))
    assert all(len(shingles(a) & shingles(b)) * 100 >= 75 * len(shingles(a) | shingles(b)) for a, b in pairs)
    share = found_pairs(spark, pairs)
    print("found near the threshold", share)
    assert share >= 0.99


def test_one_changed_character(spark):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz "

    def planted(low, high, n=800):
        out = []
        for _ in range(n):
            a = "x" + "".join(rng.choice(letters) for _ in range(rng.randrange(low, high + 1) - 2)) + "x"
            at = rng.randrange(len(a))
            out.append((a, a[:at] + "#" + a[at + 1:]))
        return out

    long, short = found_pairs(spark, planted(39, 90)), found_pairs(spark, planted(30, 38))
    print("one changed character found: 39 to 90 bytes", long, "30 to 38 bytes", short)
    assert long >= 0.99


def test_sketches_leave_out_unlike_candidates_alone(spark):
    """Of all pairs of lines, those at the threshold stay; few of those far below it are verified."""
    rng = random.Random(11)
    texts = []
    for i in range(12):
        base = "".join(rng.choice("abcdefghij ") for _ in range(120)).strip()
        far = base[:70] + "".join(rng.choice("klmnopqrst") for _ in range(50))
        texts += [base, base[:60] + "#" + base[61:], base[:30] + f"%{i}" + base[30:100], far]
    rows = X.lines(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    sigs = X.signatures(rows).localCheckpoint()
    line = {r.id: r.line for r in sigs.join(rows, ["h1", "h2"]).select("id", "line").collect()}
    ids = sorted(line)
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a > b], "a long, b long")
    got = {(r.a, r.b) for r in X.likely(pairs, sigs).collect()}
    like = {}
    for a, b in ((a, b) for a in ids for b in ids if a > b):
        x, y = shingles(line[a]), shingles(line[b])
        like[a, b] = len(x & y) / len(x | y)
    near, unlike = {p for p, s in like.items() if s >= 0.75}, {p for p, s in like.items() if s < 0.4}
    assert len(near) >= 12 and near <= got
    assert len(got & unlike) <= 0.02 * len(unlike)
