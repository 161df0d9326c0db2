"""Secret scan: pattern candidates, false positives removed by a random forest.

Candidates are values assigned to a name for secrets (of any length and
characters), private key bodies, passwords in URLs, signed web tokens, issuers'
formats wherever they stand, and, in what is left, long runs of key characters
that hold a digit or change case often. A random forest scores each by length, character transitions, dictionary
coverage, whether it lies in a path, and the words beside it. The dictionary is
every word that makes up at least ``MIN_SHARE`` of all words of the corpus (so at
most 1 / MIN_SHARE words, counted over all documents). The forest is trained from
labelled findings (value, before, after, label); ``weak_findings`` derives such
labels from these forms where no reviewed ones are at hand; a value that only
stands near a word for secrets gets no label. The forms that are sure by
themselves (keys, tokens, issuers' formats, passwords in URLs) score at least
``CUTOFF`` whatever the findings held.
At most ``PER_LABEL`` findings per label, picked by hash, are used for fitting
(bounded, documented sample of labelled rows); everything else reads all rows.

Defined results: NULL and empty texts have no candidate; without findings of
both labels every score is 0 and nothing counts as a secret; equal candidates in
several places are scored each. Extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, store, table, unclash

CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{16,}={0,2}")
ISSUED = re.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_\-]{20,}"
                    r"|sk_live_[A-Za-z0-9]{16,}|xox[abpr]-[A-Za-z0-9\-]{10,}|AIza[A-Za-z0-9_\-]{35})")
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "sk_live_", "xox", "AIza")
JWT = re.compile(r"(?<![A-Za-z0-9_\-])eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{4,}\.[A-Za-z0-9_\-]*")
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:\\[nr]|\s)*+"
                 r"(?:([^-]*+(?:-(?!----)[^-]*+)*+)(?=-----END )|((?:[A-Za-z0-9+/=]{40,}+(?:\\[nr]|\s)*+)++(?:[A-Za-z0-9+/]{0,39}={1,2})?))")
URL_PASSWORD = re.compile(r"(?<![A-Za-z0-9+.\-])[A-Za-z][A-Za-z0-9+.\-]{1,30}://[^\s/:@]*:([^\s/]+)@")
NAMES = r"(?:token|password|passwd|passphrase|pwd|secret|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?[\"']?\s*(?::?=>?|:)\s*"
BEARER = r"authorization[\"']?\s*[:=]\s*[\"']?(?:bearer|basic|token)\s+"
NAMED = ("token", "pass", "pwd", "secret", "key", "cred", "auth")
ASSIGNMENT = re.compile(rf"(?i)(?:{NAMES}|{BEARER})(?:\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)'|[\"']?([^\s\"']\S*))")
ASSIGNED = re.compile(rf"(?i)(?:{NAMES}|{BEARER})[\"']?$")
URL_BEFORE = re.compile(r"://[^\s/:@]*:$")
PEM_BEFORE = re.compile(r"PRIVATE KEY(?: BLOCK)?-----(?:\\[nr]|\s)*$")
HINTS = ("token", "pass", "secret", "key", "auth", "cred")
PLAIN = ("sha", "md5", "commit", "id", "uuid", "hash", "digest", "card", "phone", "order")
NEAR = 32
MIN_SHARE = 1e-5
PER_LABEL = 10_000
TREES, DEPTH, LEAF = 40, 8, 3
CUTOFF = 0.5
SEED = 7
MASK = "[SECRET]"


def _forms(text: str):
    """(start, end) of values told by their form, the most telling form first; a pattern runs only where its fixed part occurs."""
    folded = text.casefold()
    for m in PEM.finditer(text) if "PRIVATE KEY" in text else ():
        k = 1 if m[1] is not None else 2
        yield m.start(k), m.start(k) + len(re.sub(r"(?:\\[nr]|\s)+\Z", "", m[k]))
    for m in ASSIGNMENT.finditer(text) if any(w in folded for w in NAMED) else ():
        k = m.lastindex
        yield m.start(k), m.start(k) + len(m[k] if k < 3 else m[k].rstrip("\"'.,;:)]}>"))
    for m in URL_PASSWORD.finditer(text) if "://" in text else ():
        yield m.span(1)
    for found, fixed in ((JWT, ("eyJ",)), (ISSUED, PREFIXES)):
        for m in found.finditer(text) if any(w in text for w in fixed) else ():
            yield m.span()


def candidates(text: str):
    """(start, value, before, after) of each candidate of a whole text, in their order; none overlap."""
    taken: list[tuple[int, int]] = []
    for a, b in _forms(text):
        at = bisect.bisect(taken, (a, b))
        if a < b and (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, b))
    spans, k = list(taken), 0
    for m in CANDIDATE.finditer(text):
        # what the forms leave of a run
        start, end = m.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        pieces, j = [], k
        while j < len(taken) and taken[j][0] < end:
            pieces.append((start, taken[j][0]))
            start, j = taken[j][1], j + 1
        for a, b in [*pieces, (start, end)]:
            v = text[a:b]
            if b - a >= 16 and (any(c.isdigit() for c in v) or sum(x.islower() != y.islower() for x, y in zip(v, v[1:], strict=False)) >= 4):
                spans.append((a, b))
    for a, b in sorted(spans):
        yield a, text[a:b], text[max(0, a - NEAR):a], text[b:b + 8]


def sure(value: str, before: str, after: str) -> bool:
    """A form that is a secret by itself: issuer's format, signed token, private key body, password in a URL."""
    return (ISSUED.fullmatch(value) is not None or JWT.fullmatch(value) is not None or PEM_BEFORE.search(before) is not None
            or URL_BEFORE.search(before) is not None and after.startswith("@"))


class Dictionary:
    """Frequent words, and how likely one letter follows another in them."""

    def __init__(self, words: list[str]):
        self.words = {w for w in words if len(w) >= 3}
        counts = np.ones((27, 27))
        for w in words:
            codes = [26, *(ord(c) - 97 for c in w if "a" <= c <= "z"), 26]
            for a, b in zip(codes, codes[1:], strict=False):
                counts[a, b] += 1
        self.logp = np.log(counts / counts.sum(axis=1, keepdims=True))

    def coverage(self, v: str) -> float:
        """Share of the value covered by dictionary words, longest first from the left."""
        v, at, covered = v.lower(), 0, 0
        while at < len(v):
            n = next((n for n in range(min(12, len(v) - at), 2, -1) if v[at:at + n] in self.words), 0)
            covered += n
            at += n or 1
        return covered / len(v)

    def likely(self, v: str) -> float:
        c = [ord(x) - 97 for x in v.lower() if "a" <= x <= "z"]
        return float(np.mean(self.logp[c[:-1], c[1:]])) if len(c) > 1 else -6.0


def features(value: str, before: str, after: str, words: Dictionary) -> list[float]:
    kinds = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in value]
    n = len(value)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    share = [kinds.count(k) / n for k in range(4)]
    _, counts = np.unique(list(value), return_counts=True)
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    beside = re.findall(r"[a-z]+", before.lower())[-3:]
    return [
        n, changes / n, *share, entropy, len(counts) / n, float(re.fullmatch("[0-9a-fA-F]+", value) is not None),
        float(value.isdigit()), words.coverage(value), words.likely(value),
        float("/" in value) + float(before.endswith(("/", ".", "@"))) + float(after.startswith(("/", ".", "@"))),
        float(before.rstrip(" \"'").endswith(("=", ":", ">"))), float(before[-1:] in ("'", '"')),
        float(any(h in w for w in beside for h in HINTS)), float(any(w.endswith(PLAIN) for w in beside)), float(sure(value, before, after)),
    ]


class Forest:
    """A random forest for two classes: bootstrap samples, random feature subsets, Gini splits."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        both = len(y) and 0 < y.sum() < len(y)
        self.trees = [self._grow(x, y, rng, rng.integers(0, len(y), len(y))) for _ in range(TREES)] if both else []

    @staticmethod
    def _grow(x, y, rng, rows) -> np.ndarray:
        """Nodes (feature or -1, threshold, left, right, share of positives) as one array."""
        nodes: list[list[float]] = []

        def node(rows, depth) -> int:
            at, p = len(nodes), y[rows].mean()
            nodes.append([-1, 0, 0, 0, p])
            if depth == DEPTH or len(rows) < 2 * LEAF or p in (0, 1):
                return at
            best = (p * (1 - p) - 1e-9, None, None)
            for f in rng.choice(x.shape[1], max(2, int(math.sqrt(x.shape[1]))), replace=False):
                v = x[rows, f]
                values = np.unique(v)
                if len(values) < 2:
                    continue
                mids = (values[1:] + values[:-1]) / 2
                for t in mids if len(mids) <= 16 else np.quantile(mids, np.linspace(0.03, 0.97, 16)):
                    low = v <= t
                    k = low.sum()
                    if LEAF <= k <= len(rows) - LEAF:
                        a, b = y[rows[low]].mean(), y[rows[~low]].mean()
                        gini = (k * a * (1 - a) + (len(rows) - k) * b * (1 - b)) / len(rows)
                        if gini < best[0]:
                            best = (gini, f, t)
            if best[1] is not None:
                low = x[rows, best[1]] <= best[2]
                left = node(rows[low], depth + 1)
                nodes[at][:4] = [best[1], best[2], left, node(rows[~low], depth + 1)]
            return at

        node(np.asarray(rows), 0)
        return np.array(nodes)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.zeros(len(x))
        total, every = np.zeros(len(x)), np.arange(len(x))
        for t in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                f = t[at, 0].astype(int)
                down = np.where(x[every, np.maximum(f, 0)] <= t[at, 1], t[at, 2], t[at, 3]).astype(int)
                at = np.where(f >= 0, down, at)
            total += t[at, 4]
        return total / len(self.trees)


class Model:
    def __init__(self, words: Dictionary, forest: Forest):
        self.words, self.forest = words, forest

    def score(self, found: list[tuple[str, str, str]]) -> np.ndarray:
        if not found:
            return np.zeros(0)
        told = self.forest.score(np.array([features(*f, self.words) for f in found]))
        return np.where([sure(*f) for f in found], np.maximum(told, CUTOFF), told) if self.forest.trees else told


def weak_label(value: str, before: str, after: str = "@") -> int | None:
    """1: sure by its form, or assigned to a name for secrets; None (unreviewed): letters alone after a colon, or near a word for secrets; else 0."""
    if sure(value, before, after):
        return 1
    if ASSIGNED.search(before):
        return None if value.isalpha() and before.rstrip(" \t\"'").endswith(":") else 1
    beside = re.findall(r"[a-z]+", before.lower())[-3:]
    return None if any(h in w for w in beside for h in (*HINTS, "bearer", "basic")) else 0


def weak_findings(docs: DataFrame) -> DataFrame:
    """Labelled findings (value, before, after, label) of all documents, labelled by format and assignment."""
    schema = pa.schema([("value", pa.string()), ("before", pa.string()), ("after", pa.string()), ("label", pa.int32())])

    def run(batches):
        for b in batches:
            rows = [(v, pre, post, weak_label(v, pre, post)) for t in b.column(0).to_pylist() for _, v, pre, post in candidates(t or "")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, schema.types, strict=True)], schema=schema)

    return docs.select("text").mapInArrow(run, "value string, before string, after string, label int")


def dictionary(docs: DataFrame, min_share: float = MIN_SHARE) -> Dictionary:
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^\p{L}]+")).alias("w")).where("w != ''")
    counts = store(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return Dictionary(sorted(r.w for r in counts.where(F.col("n") >= min_share * total).select("w").collect()))


def train(findings: DataFrame, words: Dictionary, per_label: int = PER_LABEL) -> Model:
    """Fit on at most ``per_label`` distinct findings of each label, those with the least hashes."""
    rows = []
    distinct = store(findings.where("label is not null and value is not null").select("value", F.coalesce("before", F.lit("")).alias("before"),
                     F.coalesce("after", F.lit("")).alias("after"), "label").distinct(), "secret-findings")
    for label in (0, 1):
        rows += distinct.where(F.col("label") == label).orderBy(F.xxhash64("value", "before"), "value", "before", "after").limit(per_label).collect()
    x = np.array([features(r.value, r.before, r.after, words) for r in rows])
    return Model(words, Forest(x, np.array([r.label for r in rows])))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per candidate: doc_id, start, length (characters), value_sha256, score, secret."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("value_sha256", pa.string()),
                        ("score", pa.float64()), ("secret", pa.bool_())])

    def run(batches):
        for b in batches:
            found = [(i, *c) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for c in candidates(t or "")]
            score = shared.value.score([f[2:] for f in found])
            cols = ([f[0] for f in found], [f[1] for f in found], [len(f[2]) for f in found],
                    [hashlib.sha256(f[2].encode()).hexdigest() for f in found], score, score >= CUTOFF)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)

    return unclash(docs, ["doc_id", "text"]).mapInArrow(run, "doc_id long, start long, length long, value_sha256 string, score double, secret boolean")


def redact(text: str, model: Model) -> str:
    found = list(candidates(text))
    for (start, value, _, _), s in reversed(list(zip(found, model.score([f[1:] for f in found]), strict=True))):
        if s >= CUTOFF:
            text = text[:start] + MASK + text[start + len(value):]
    return text


def fit(docs: DataFrame) -> Model:
    bounded_batches(docs.sparkSession)
    return train(weak_findings(docs), dictionary(docs))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: confirmed secrets are masked in the text and n_chars follows; no document goes."""
    shared = spark.sparkContext.broadcast(fit(docs))
    names = docs.columns

    def run(batches):
        for b in batches:
            old = b.column("text").to_pylist()
            new = [t and redact(t, shared.value) for t in old]
            cols = dict(zip(names, b.columns, strict=True))
            cols["text"] = pa.array(new, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([n if x == y else len(y) for x, y, n in zip(old, new, cols["n_chars"].to_pylist(), strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names)

    return docs.mapInArrow(run, docs.schema)


def q_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs))
