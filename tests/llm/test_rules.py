"""Divergence rules, filter audit and spelling variants against plain versions, and at their edges."""

import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from roadspark.llm import divergence, filter_audit, queries, spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, key string, word string, n long"
WORDS = re.compile("[^\x20\x09-\x0D]+")
LONG = "Word and\nmore w%rds, " * 60000


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").collect()


def documents(spark, texts):
    return spark.createDataFrame([(i, t, lang, "s", 0, "p", "k", "w", 1) for i, t, lang in texts], DOCS)


EDGES = [
    (1, "a b c a b c", "en"), (1, "a b c a b c", "en"), (2, None, None), (3, "", ""), (None, "a b c a b c", "en"), (None, None, "en"),
    (4, LONG, "en"), (5, LONG, None), (6, " \n\t\v ", "de"), (7, "é一 \U0001f600|\né一 \U0001f600|\n x", "de"),
    (8, "x" * 3_000_000 + " y", "xx"), (9, "a b\x1cc \x85d", "en"),
]


# ---- divergence


def plain_base(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), sum(n - 1 for n in Counter(lines).values()),
        len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def plain_classes(text):
    kinds = ["[a-z]", "[A-Z]", "[0-9]", "[ \t\v\f\r]", "\n", "[.,;:?'\"()-]", None, "[À-ÿ]", "[\u0080-¿Ā-\U0010ffff]"]
    found = [len(re.findall(k, text)) if k else 0 for k in kinds]
    return [n if k else len(text) - sum(found) for n, k in zip(found, kinds)]


def plain_words(text):
    return Counter(
        w.translate({c: c + 32 for c in range(65, 91)}).strip(".,;:!?\"'()") for w in WORDS.findall(text)
    )


def plain_distance(a, b):
    a, b = [x / sum(a) for x in a], [x / sum(b) for x in b]
    half = [(x + y) / 2 for x, y in zip(a, b)]
    return math.sqrt(max(sum(
        x * math.log2(x / m) / 2 * (x > 0) if x else 0 for p in (a, b) for x, m in zip(p, half)
    ), 0))


def plain_divergence(rows):
    """Counts and verdicts of all rows, with dictionaries and loops."""
    shares, texts = {}, {}
    for r in rows:
        words = plain_words(r.text or "")
        n = sum(words.values())
        if n < 50 or r.lang is None:
            continue
        classes = plain_classes(r.text)
        for kind, found, total in (("c", dict(enumerate(classes)), sum(classes)), ("w", words, n)):
            for name, count in found.items():
                shares.setdefault((r.lang, kind), Counter())[name] += 1_000_000 * count // total
                texts.setdefault((r.lang, kind), Counter())[name] += 1
    known = {}
    judged = sum(found[3] for (_, kind), found in texts.items() if kind == "c")
    for lang in {lang for lang, _ in shares}:
        of = texts[lang, "c"][3]
        if of * 1000 < judged:
            continue
        ranked = sorted(shares[lang, "w"], key=lambda w: (-texts[lang, "w"][w], -shares[lang, "w"][w], w.encode()))[:64]
        histogram = [shares[lang, "w"][w] for w in ranked]
        known[lang] = [shares[lang, "c"][i] for i in range(9)], ranked, [*histogram, max(1_000_000 * of - sum(histogram), 0)]
    result = []
    for r in rows:
        base = plain_base(r.text)
        kept = not base[-1]
        if kept and known:
            words, n = plain_words(r.text), base[0]
            best = None
            for lang in sorted(known):
                classes, ranked, histogram = known[lang]
                own = [words[w] for w in ranked]
                c, w = plain_distance(plain_classes(r.text), classes), plain_distance([*own, n - sum(own)], histogram)
                if best is None or c + w < sum(best):
                    best = c, w
            kept = best[0] <= 0.2 + math.sqrt(8 / (8 * math.log(2) * len(r.text))) and (
                n < 60 or best[1] <= 0.11 + math.sqrt(64 / (8 * math.log(2) * n))
            )
        result.append((r.doc_id, *base, kept))
    return Counter(result)


def test_divergence_equals_loops(spark, rows):
    out = queries.QUERIES["op11_distribution_divergence"](spark, DATA)
    assert Counter(tuple(r)[:8] for r in out.collect()) == plain_divergence(rows)


def test_divergence_keeps_good_texts(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    out = queries.QUERIES["op11_distribution_divergence"](spark, DATA).where("NOT base_failed").join(labels, "doc_id")
    seen = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert seen.get((1, False), 0) <= 0.01 * seen[1, True]
    assert seen.get((0, True), 0) <= 0.4 * seen[0, False]


def test_divergence_edges(spark):
    docs = documents(spark, EDGES)
    known = divergence.references(docs)
    out = divergence.judged(docs, known).collect()
    assert Counter(tuple(r)[:8] for r in out) == plain_divergence(docs.collect())
    assert divergence.references(docs.where("doc_id < 0")) == [] and divergence.judged(docs.where("doc_id < 0"), []).count() == 0
    alone = documents(spark, [(1, "the quick brown fox of all " * 3 + " ".join(f"w{i}" for i in range(60)), None)])
    assert [(r.kept, r.nearest_lang) for r in divergence.judged(alone, divergence.references(alone)).collect()] == [(True, None)]


def test_divergence_of_known_distributions():
    p, q = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    assert divergence.divergence(p, q) == 1.0 and divergence.divergence(p, p) == 0.0
    assert divergence.divergence(np.array([0.5, 0.5]), p) == pytest.approx(plain_distance([1, 1], [1, 0]), abs=1e-12)


# ---- filter audit


def plain_audit(rows, labels):
    first = {}
    for r in rows:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    parts = {}
    for r in rows:
        text = r.text or ""
        words = WORDS.findall(text)
        failed = "".join(x for x, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)),
            r.doc_id is not None and first[text] < r.doc_id,
        )) if bad)
        parts.setdefault(r.lang or "", []).append((failed, labels.get(r.doc_id, (0, 0))))
    table = set()
    for part, docs in parts.items():
        removed_by, lines = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [(f, m) for f, m in docs if x in f and not before & set(f)]
                removed_by[x] += len(gone)
                lines.append((x, (
                    part, order, step, sum(not (before | {x}) & set(f) for f, _ in docs), len(gone),
                    sum(x in f and bool(before & set(f)) for f, _ in docs), sum(f == x for f, _ in docs),
                    sum(m[0] for _, m in gone), sum(m[1] for _, m in gone),
                )))
        table |= {(*line, removed_by[x]) for x, line in lines}
    return table


def test_audit_equals_loops_at_the_edges(spark):
    docs = documents(spark, EDGES)
    marks = [(1, 1, 0), (1, 0, 1), (4, 1, None), (5, None, 1), (None, 1, 1), (6, 2, 0)]
    labels = spark.createDataFrame([(*m, "p") for m in marks], "doc_id long, quality int, toxic int, part string")
    got = [tuple(r) for r in filter_audit.audit(docs, labels).drop("filter").collect()]
    want = plain_audit(docs.collect(), {1: (1, 1), 4: (1, 0), 5: (0, 1)})
    assert len(got) == len(want) == 600 * 4 and set(got) == want
    assert filter_audit.audit(docs.where("doc_id < 0"), labels).count() == 0
    bare = filter_audit.audit(docs, labels.where("doc_id < 0")).agg(F.sum("good_lost"), F.sum("toxic_lost"), F.sum("removed"))
    assert tuple(bare.first())[:2] == (0, 0) and bare.first()[2] > 0


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_transducer_in_any_blocks(rows, block):
    texts = [(r.text or "")[:400] for r in rows[:60]] + ["", "", "a", " ", "A b A", "éA一 #", "", "word " * 40 + "x" * 300, ""]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[3], 3 + np.cumsum([len(b) for b in raw])])
    got = filter_audit.count(np.frombuffer(b"abc" + b"".join(raw) + b"zz", np.uint8), offsets, block)
    words = [WORDS.findall(t) for t in texts]
    want = [
        [len(w) for w in words], [len(set(w)) for w in words], [len(re.findall("[A-Z]", t)) for t in texts],
        [len(re.findall("[#$%&*|]", t)) for t in texts], [len(t) for t in texts],
    ]
    assert got.tolist() == want


def test_spans_with_one_hash_stay_apart():
    raw = np.frombuffer(b"abcdabxy", np.uint8)
    table = filter_audit.SpanTable(raw)
    start, length = np.array([0, 2, 4, 6, 0]), np.full(5, 2)
    new = table.insert(np.array([0, 0, 0, 0, 1]), start, length, np.zeros(5, np.uint64))
    assert len(new) == 4 and set(new) & {0, 2} and {1, 3, 4} <= set(new)
    assert len(table.insert(np.zeros(2, np.int64), np.array([4, 5]), np.full(2, 2), np.zeros(2, np.uint64))) == 1


# ---- spelling variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    out, form = {}, {}
    for w, n in counts.items():
        found = [v for v in counts if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * n else None
        out[w] = (form[w], n, len(found), counts[best] if form[w] else None)

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def plain_vocabulary(rows):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if r.doc_id is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


@pytest.mark.parametrize("partition", [2, 4096])
def test_variants_equal_all_pairs(spark, rows, partition):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = [tuple(r) for r in spelling.variants(docs, partition=partition).collect()]
    want = plain_variants(plain_vocabulary(rows))
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("partition", [1, 8, 4096])
def test_pairs_of_repetitive_words(spark, partition):
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abé"), rng.integers(6, 10))) for _ in range(250)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa"}
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(sorted(words))], "word string, n long")
    got = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(table, partition=partition).collect()]
    want = {(a, b) for a in words for b in words if a < b and near(a, b)}
    assert len(got) == len(want) and set(got) == want


def test_acceptor_is_minimal_and_exact():
    words = ["tap", "taps", "top", "tops", "", "stop", "stops"]
    acceptor = spelling.Acceptor(words)
    assert len(acceptor.arcs) == 7  # one state per right language
    assert sorted(acceptor.common(acceptor.start, acceptor.start)) == sorted(words)
    pairs = {frozenset(p[:2]) for size in range(6) for p in acceptor.one_edit_pairs(size)}
    assert pairs == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}


def test_variants_edges(spark):
    words = "wordabc " * 30 + "wordabd " * 6 + "wordabcx " * 5 + "WordabÀ " * 5
    docs = documents(spark, [*EDGES, (None, words, "en"), (None, words, "en")])
    got = {tuple(r) for r in spelling.variants(docs).collect()}
    assert got == plain_variants(plain_vocabulary(docs.collect()))
    assert spelling.variants(docs.where("doc_id < 0")).count() == 0
    chain = documents(spark, [(None, " ".join([w] * n), "en") for w, n in (
        ("abcdef", 3125), ("abcdeg", 625), ("abcdhg", 125), ("abcihg", 25), ("abjihg", 5),
    ) for _ in range(1)])
    assert {r.root for r in spelling.variants(chain).collect()} == {"abcdef"}
