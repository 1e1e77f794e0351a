"""The pipeline's operators against plain versions, and at their edges."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from checking import database, differences
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from roadspark.llm import (
    bitsliced, bpe_automaton, caps, components, extraction, packing, pii, quality, queries, repeats, sharding, simhash,
)

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans int, `row` int, score double"
LONG = "word and more words, " * 6000


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls, empty and long texts, repeated rows, columns whose names operators use."""
    rows = [
        (1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (None, "only a text"), (None, None), (4, LONG), (5, LONG),
        (6, "mail me.now@host.example.org or +1 (555) 555-1234, 10.0.0.1"), (7, "é" * 300), (8, " \n\t "), (9, "x" * 199),
    ]
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, 0.5) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, DATA), database(DATA), queries.ORACLE[name]) == []


# ---- quality


def test_quality_on_held_out_rows(spark):
    out = queries.QUERIES["op1_byte_cnn"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.85


def test_network_blocks_do_not_matter(monkeypatch):
    network = quality.ByteNetwork()
    text = bytes(np.random.default_rng(1).integers(32, 127, 9000).astype(np.uint8))
    whole = network.score(text)
    monkeypatch.setattr(quality, "BLOCK", 3)
    assert network.score(text) == pytest.approx(whole, abs=1e-6)
    assert network._paired(quality._padded(text)) == pytest.approx(network._paired_now(quality._padded(text)), abs=1e-4)


def test_quality_edges(edges, nothing):
    network = quality.ByteNetwork()
    kept = quality.keep_good(edges, network, 0.0)
    assert kept.columns == edges.columns and kept.count() == edges.count()
    assert quality.keep_good(nothing, network).count() == 0
    assert {r._score for r in quality.scored(edges, None).collect()} == {0.5}


def test_texts_reach_the_network_once(spark, monkeypatch):
    sent = lambda batches, network: (pa.RecordBatch.from_arrays([b.column("_doc"), pa.array([float(b.nbytes)] * len(b))], names=["_doc", "_score"]) for b in batches)
    table = spark.range(0, 100, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 200).alias("text"))
    with monkeypatch.context() as patch:
        patch.setattr(quality, "_scored", sent)
        assert quality.scored(table, None).agg(F.max("_score")).first()[0] < 1.5 * 100 * 1000
    network = quality.ByteNetwork()
    raw = table.withColumn("text", F.col("text").cast("binary"))
    one, cast = ({r._score for r in quality.scored(t, network).collect()} for t in (table, raw))
    assert one == cast == {network.score(b"word " * 200)} and quality.keep_good(raw, network, 0.0).schema == raw.schema


# ---- top-k search


def test_top_k_equals_sorting(spark):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-3, 4, (300, 5)) / 8
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(900, None), (920, [float("nan")] * 5), (940, [None] * 5), (7, [float(x) for x in vectors[7]])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = bitsliced.top_k(table, F.col("vec_id") % 20 == 0, k=6, block=64, group=4).collect()
    q = np.floor(64 * vectors).astype(int)
    want = set()
    for i in range(0, 300, 20):
        score = q @ q[i]
        order = [j for j in sorted(range(300), key=lambda j: (-score[j], j)) if j != i][:6]
        want |= {(i, r + 1, j, int(score[j])) for r, j in enumerate(order)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert bitsliced.top_k(table.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


# ---- extraction


def test_extraction_reads_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    odd_ids = pages.unionByName(pages.limit(3)).unionByName(pages.limit(2).withColumn("page_id", F.lit(None).cast("long")))
    by_id = {r.page_id: r.html for r in pages.collect()}
    assert set(extraction.training_sample(pages, 20)) <= set(by_id.values()) and len(extraction.training_sample(pages, 20)) == 20
    assert len(extraction.training_sample(odd_ids, 10**6)) == len(by_id) + 1
    labeller = extraction.fit(pages)
    for row in extraction.extract(pages, labeller).join(pages, ["page_id", "url"]).collect():
        article = row.html[row.html.index("<article"):row.html.index("</article>")]
        plain = [b.text for b in extraction.blocks(article)]
        assert row.text == "\n\n".join(plain) and row.n_chars == len(row.text)
    odd = spark.createDataFrame(
        [(1, "u", None, 1), (1, "u", None, 1), (2, None, "", 1), (3, "u", "<p", 1), (4, "u", "<div class='sidebar'><p>beside</p></div>", 1),
         (5, "u", "<script>x</script><!-- <p>no</p>", 1)],
        "page_id long, url string, html string, text int",
    )
    out = extraction.extract(odd, labeller).collect()
    assert len(out) == 6 and [r.text for r in out if r.page_id in (1, 2, 4, 5)] == [""] * 5
    assert extraction.extract(odd.where("page_id < 0"), labeller).count() == 0


def test_blocks_are_decoded_and_trimmed():
    found = extraction.blocks("<p>a&amp;b<br>c \n <b>d</b><p>e&nbsp;&lt;f&gt;<style>x</style></p><title>t</title>g")
    assert [b.text for b in found] == ["a&b c d", "e <f>", "g"]


# ---- embedding near-duplicates


@pytest.mark.parametrize("region,words", [(8192, None), (60, 4), (9, 8)])
def test_caps_find_every_link(spark, region, words):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 12))
    near = np.concatenate([b + rng.normal(size=(6, 12)) * rng.choice([0.1, 0.2, 0.25]) for b in base])
    vectors = np.concatenate([base, near, base[:3]]).round(3)
    rows = [(i, [float(x) for x in v], int(i % 2 if i % 5 else 0)) for i, v in enumerate(vectors)]
    rows += [(1000, None, 0), (1001, [0.0] * 12, 0), (1002, [float("inf")] * 12, 0), (1003, rows[0][1], None), (1004, [1.0, 0.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id) for r in caps.near_duplicates(table, region=region, words=words).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[: len(vectors)]])
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    root = np.arange(len(vectors))
    components.merge(root, *np.nonzero(linked))
    for i in range(len(vectors)):
        assert got[i] == (linked[i].sum(), root[i])
    assert all(got[i] == (0, i) for i in (1000, 1001, 1002, 1003, 1004))
    assert caps.near_duplicates(table.where("vec_id < 0")).count() == 0


# ---- packing


def test_packing_gives_the_tokens_back(spark, texts, edges, nothing):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    pieces = {}
    for r in packing.pack(docs, path).collect():
        assert r.length == len(r.ids) <= 1024 and r.length & (r.length - 1) == 0 and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    for i, own in pieces.items():
        ids = [t for _, part, _ in sorted(own) for t in part]
        assert ids == whole.encode(texts[i], add_special_tokens=False).ids + [0] and {n for *_, n in own} == {len(ids)}
    rows = packing.pack(edges, path).collect()
    assert sum(r.start == 0 for r in rows) == edges.count() and len({r.sequence_id for r in rows}) == len(rows)
    assert packing.pack(nothing, path).count() == 0


@pytest.mark.parametrize("text", ["", " a", "a ", "a  b", "a\n\nb", "a\n b", "x\ny z\n", "<|endoftext|>a", "don't  é à", "a　b", "\r\n"])
def test_cached_pieces_equal_the_tokenizer(text):
    from roadspark.llm.bpe_cache import ByteBpe

    bpe = ByteBpe(P.path("byte_bpe_50k.json"))
    assert np.frombuffer(bpe(text), "<u4").tolist() == bpe._whole.encode(text, add_special_tokens=False).ids


# ---- SimHash


def plain_fingerprint(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("cell", [3, 1024])
def test_simhash_equals_all_pairs(spark, texts, cell):
    rows = simhash.near_duplicates(spark.read.parquet(f"{DATA}/documents.parquet"), cell=cell).collect()
    ids = sorted(texts)
    prints = np.array([plain_fingerprint(texts[i]) for i in ids], np.uint64)
    root = np.arange(len(ids))
    components.merge(root, *np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (i, f"{int(p):016x}", ids[k]) for i, p, k in zip(ids, prints, root)
    }


def test_blocks_hold_every_close_pair(spark):
    rng = np.random.default_rng(4)
    prints = []
    for _ in range(200):
        x = int(rng.integers(0, 1 << 62))
        prints += [x, x ^ sum(1 << int(b) for b in rng.choice(62, 4, replace=False))]
    table = spark.createDataFrame([(p,) for p in sorted(set(prints))], "print long")
    root = {r.print: r.root for r in simhash.classes(table).collect()}
    assert all(root[a] == root[b] for a, b in zip(prints[::2], prints[1::2]))


def test_simhash_edges(edges, nothing):
    kept = simhash.one_of_each(edges, words=5, distance=8, blocks=10)
    assert kept.columns == edges.columns
    rows = kept.collect()
    assert sum(r.text == "a b c d e f" for r in rows) == 1 and sum(r.text == LONG for r in rows) == 1
    assert sum(not (r.text or "").strip() for r in rows) == 1
    assert simhash.near_duplicates(edges).count() == edges.count()
    assert simhash.one_of_each(nothing).count() == simhash.near_duplicates(nothing).count() == 0


def plain_similarity(a, b, words=5):
    def sets(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {" ".join(found[i : i + words]) for i in range(len(found) - words + 1)} or ({" ".join(found)} if found else set())

    x, y = sets(a), sets(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_rows_fall_only_through_like_texts(spark):
    """Unlike texts whose fingerprints are as close as asked for; both stay."""
    one = "a b c d e f g h i j"
    rng, seen = np.random.default_rng(8), simhash.fingerprint(one, 5)
    words = list("klmnopqrstuvwxyz")
    other = min((" ".join(rng.choice(words, 7)) for _ in range(20_000)), key=lambda t: (simhash.fingerprint(t, 5) ^ seen).bit_count())
    distance = (simhash.fingerprint(other, 5) ^ seen).bit_count()
    assert plain_similarity(one, other) == 0
    table = spark.createDataFrame([(1, one), (2, other), (3, one)], "doc_id long, text string")
    kept = simhash.one_of_each(table, words=5, distance=distance, blocks=distance + 2)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]



@pytest.mark.parametrize("cell", [3, 1024])
def test_near_copies_equal_brute_force(spark, texts, cell):
    rng = np.random.default_rng(9)
    rows = dict(texts)
    for k, i in enumerate(sorted(texts)[:60]):
        found = (texts[i] or "").split()[:120]
        for copy in range(3):  # edits of a few words of short and mid-length texts
            edited = list(found)
            for at in rng.integers(0, max(len(found), 1), 1 + copy) if found else ():
                edited[at] = f"edit{copy}"
            rows[10**6 + 10 * k + copy] = " ".join(edited)
    ids = sorted(rows)
    table = spark.createDataFrame([(i, rows[i]) for i in ids], "doc_id long, text string")
    root = np.arange(len(ids))
    sets = [set(simhash.shingles(rows[i] or "", 5).tolist()) for i in ids]
    near = [(x, y) for x in range(len(ids)) for y in range(x) if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])]
    assert sum(plain_similarity(rows[ids[x]], rows[ids[y]]) >= 0.8 for x, y in near[:200]) == len(near[:200])
    components.merge(root, *np.array(near).T)
    want = {ids[k] for k in np.unique(root)}
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"] if cell == 1024 else lambda s, t, d: simhash.one_of_each(t, words=5, cell=cell)
    assert {r.doc_id for r in stage(spark, table, DATA).collect()} == want



def test_near_copy_stage_uses_simhash(spark, monkeypatch):
    """Without any minima in common, texts within four bits are still found and verified."""
    words = [f"w{i}" for i in range(400)]
    one, other = " ".join(words), " ".join([*words[:-1], "end"])
    assert (simhash.fingerprint(one, 5) ^ simhash.fingerprint(other, 5)).bit_count() <= 4
    monkeypatch.setattr(simhash, "_band_keys", lambda least: np.zeros(0, np.uint64))
    table = spark.createDataFrame([(1, one), (2, other), (3, "some other text of a few words")], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, table, DATA).collect()) == [1, 3]


# ---- automaton


def test_automaton_equals_the_tokenizer(spark, texts, edges, nothing):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    for r in bpe_automaton.tokenize(spark.read.parquet(f"{DATA}/documents.parquet"), path).collect():
        ids = whole.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == whole.decode(ids, skip_special_tokens=False)
    rows = bpe_automaton.tokenize(edges, path).collect()
    assert len(rows) == edges.count() and all(r.ids == [] and r.decoded == "" for r in rows if r.doc_id in (2, 3, 8))
    assert bpe_automaton.tokenize(nothing, path).count() == 0


def test_automaton_on_random_words():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    whole, own, rng = Tokenizer.from_file(path), bpe_automaton.WordBpe(path), np.random.default_rng(5)
    odd = ["x<|endoftext|>y <|startoftext|>", "don't we'LL", "ΑΣ ΟΔΟΣ", "İ", "é", "\x1c a", "aaaa" * 9, "!!! a., 12"]
    for text in odd + ["".join(rng.choice(list("aabbhtinerso'!1 é"), 40)) for _ in range(300)]:
        found = whole.encode(text, add_special_tokens=False).ids
        assert own(text)[0] == " ".join(map(str, found))


# ---- repeats


def plain_removal(texts, window=200):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for p in range(len(raw) - window + 1):
            seen[raw[p : p + window]] = seen.get(raw[p : p + window], 0) + 1
    out = []
    for raw in raws:
        mark = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            if seen[raw[p : p + window]] > 1:
                mark[p : p + window] = b"\1" * window
        runs = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        out.append((len(raw), sum(mark), runs, hashlib.sha256(bytes(b for b, m in zip(raw, mark) if not m)).hexdigest()))
    return out


@pytest.mark.parametrize("part", [2, 4096])
def test_repeats_equal_comparing_all(spark, part):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.octet_length("text") < 6000)
    rows = docs.collect()
    want = dict(zip([r.doc_id for r in rows], plain_removal([r.text for r in rows])))
    got = {r[0]: tuple(r)[1:] for r in repeats.removal_report(docs, part=part).collect()}
    assert got == want


def test_repeats_inside_and_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    rng = np.random.default_rng(6)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    shared, run = word(230), "ab" * 300
    texts = [word(900) + shared + word(500), shared + word(50), run, word(400), None, "", shared[:199], word(60) + shared + shared]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [tuple(r)[1:] for r in sorted(repeats.removal_report(table).collect())] == plain_removal(texts)


def test_frequent_passages_meet_no_join(spark, monkeypatch):
    """A passage of many texts is marked in place, as one range for each text; what is rarer beside it is still found."""
    rng = np.random.default_rng(12)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    often, rare = word(900), word(260)
    texts = [word(int(rng.integers(0, 300))) + often[: int(rng.integers(700, 900))] + word(40) for _ in range(60)]
    texts += [rare + word(300), word(20) + rare, often + often, word(50), None, "", texts[0], texts[0]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, cut = [], repeats._ranges
    monkeypatch.setattr(repeats, "_any_of", lambda kinds, made=repeats._any_of: seen.append(len(kinds)) or made(kinds))
    for frequent in (2, 20):
        found = repeats.removal_report(table, frequent=frequent)
        assert [tuple(r)[1:] for r in sorted(found.collect())] == plain_removal(texts)
    assert min(seen) > 0
    names = ["anchor", "whole", "key", "size", "at", "starts"]
    rows = [(1, 7, 5, 999, 0, 50), (2, 8, 5, 999, 50, 60), (3, 9, 5, 999, 110, 10), (1, 7, 5, 999, 600, 50), (1, 7, 6, 999, 640, 50), (4, 7, 6, 999, 700, 9)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
    got = [tuple(r.values()) for b in cut(iter([batch]), 200, {7: 1, 8: 2}) for r in b.to_pylist()]
    assert got == [(5, 999, 0, 309), (5, 999, 600, 849), (6, 999, 640, 889)]


@pytest.mark.parametrize("before", [65536 - 186, 65536 - 150, 65536 - 100])
def test_lone_run_across_65536(spark, before):
    """Equal grams on both sides of a multiple of 65536; the run stands nowhere else."""
    rng = np.random.default_rng(10)
    word = lambda n: "".join(rng.choice(list("abcde "), n))
    texts = [word(before) + "-" * 250 + word(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [tuple(r)[1:] for r in repeats.removal_report(table).collect()] == plain_removal(texts)


def test_suffix_order_is_that_of_sorting():
    data = np.random.default_rng(7).integers(97, 99, 3000).astype(np.uint8)
    raw = data.tobytes()
    order = repeats.suffix_order(data, 30).tolist()
    keys = [raw[i : i + 30] for i in order]
    assert sorted(order) == list(range(3000)) and all(a.ljust(30, b"\0") <= b.ljust(30, b"\0") for a, b in zip(keys, keys[1:]))


def test_repeats_edges(edges, nothing):
    out = repeats.without_repeats(edges)
    assert out.columns == edges.columns and out.count() == edges.count()
    assert {r.text for r in out.where("doc_id in (4, 5)").collect()} == {""}
    assert out.where("doc_id = 9").first().text == "x" * 199
    assert repeats.without_repeats(nothing).count() == repeats.removal_report(nothing).count() == 0


# ---- sharding


def test_shards_are_even_and_gapless(spark, texts, edges, nothing):
    rows = queries.QUERIES["op9_virtual_slots"](spark, DATA).collect()
    size = {i: len((t or "").encode()) + 1 for i, t in texts.items()}
    assert all(r["size"] == size[r.doc_id] and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    load = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(load) - min(load) <= max(size.values())
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    out = sharding.shard(edges, 3).collect()
    assert len(out) == edges.count() and {r["size"] for r in out if r.doc_id in (2, 3)} == {1}
    assert sharding.shard(nothing, 3).count() == 0


def test_rebalancing_moves_little(spark, tmp_path):
    totals = {s: 10 + s % 7 for s in range(256)}
    before = sharding.balanced_map(totals, 4, 256)
    after = sharding.rebalanced_map(before, totals, 5)
    moved = [s for s in range(256) if before[s] != after[s]]
    assert all(after[s] == 4 for s in moved)
    load = [sum(totals[s] for s in range(256) if after[s] == k) for k in range(5)]
    assert max(load) < 1.1 * sum(load) / 5
    assert set(sharding.rebalanced_map(after, totals, 3)) == {0, 1, 2}
    folder = f"file://{tmp_path}/map"
    sharding.store_map(spark, folder, 0, before)
    sharding.store_map(spark, folder, 1, after)
    assert [r.shard for r in sharding.stored_map(spark, folder, 1).orderBy("vslot").collect()] == after
    assert [r.shard for r in sharding.stored_map(spark, folder, 0).orderBy("vslot").collect()] == before


# ---- personal data


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns(spark, texts):
    odd = [
        "a@b.c_x@d.e", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "1.2.3", "999.1.1.1 001.02.3.4", "4111 1111 1111 1111 4111-1111-1111-1111",
        "4111111111111111 2", "+1 (555) 555-1234 +12 +123456789", "é😀 a.b@c.de", "5" * 3000, "1 " * 4000, "", None, "x@y", "+" * 50,
    ]
    rows = [*texts.items(), *enumerate(odd, 10**6)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.CandidateModel([], {})
    for r in pii.detect(table, model).collect():
        assert [(s.start, s.kind, s.end) for s in r.base] == plain_base(dict(rows)[r.doc_id] or "")


def test_pii_query_and_redaction(spark, texts, edges, nothing):
    kinds = pii.KINDS
    for r in queries.QUERIES["op10_candidate_boosting"](spark, DATA).collect():
        base = plain_base(texts[r.doc_id])
        listed = [f"{kinds[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
    model = pii.fit(edges)
    out = pii.redact(edges, model)
    assert out.columns == edges.columns and out.count() == edges.count()
    assert out.where("doc_id = 6").first().text == "mail [EMAIL] or [PHONE], [IP]"
    assert out.where("doc_id = 1").first().text == "a b c d e f" and out.where("doc_id = 2").first().text is None
    assert pii.redact(nothing, pii.fit(nothing)).count() == 0


PLANTED = [
    "write to jane.doe (at) mail (dot) example (dot) org. Then wait", "host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 is up",
    "reach fe80::8a2e:370:7334, please", "tel 555-234-5678 today", "call (415) 555 2671 now", "phone: 030 1234 5678", "dial 0049 30 123456",
]
CLEAN = ["at 12:30:45 on 2024-01-05", "a[1::2] of std::vector", "sums 123 456 7890 and 1000 2000", "pages 10-20, 3.14 2718", "look (at) this (dot) 5", "1234.5678.9012.3456"]


@pytest.mark.parametrize("others", [0, 40])
def test_wider_spellings_are_added(spark, others):
    rows = PLANTED + CLEAN + ["mail me.now@host.example.org or +1 (555) 555-1234, 10.0.0.1 but 300.1.2.3 or 1234567890123456"] * others
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.redact(table, pii.fit(table)).collect()}
    n = len(PLANTED)
    assert [out[i] for i in range(n)] == [
        "write to [EMAIL]. Then wait", "host [IP] is up", "reach [IP], please", "tel [PHONE] today", "call [PHONE] now", "phone: [PHONE]", "dial [PHONE]",
    ]
    assert [out[n + i] for i in range(len(CLEAN))] == CLEAN


def test_thresholds_reach_the_precision():
    scored = [(0, 2.0, 1.0, 9), (0, 1.0, 0.0, 1), (0, 0.5, 1.0, 30), (0, -1.0, 0.0, 50), (1, 1.0, 1.0, 5)]
    limits = pii.calibrated(scored)
    assert limits[0] == 0.5 and limits[1] == 0.0


# ---- components and pipeline


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    table = spark.createDataFrame(path + hub + [(5000, 5000)], "a long, b long")
    root = {r.node: r.root for r in components.components(table).collect()}
    assert all(root[i] == 0 for i in range(201)) and all(root[1000 + i] == 1000 for i in range(400))


def test_pipeline_stages(spark, edges, nothing, tmp_path):
    import corpus_pipeline as pipeline

    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "personal_data", "packing",
    ]
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    for name, docs in (("edges", edges), ("nothing", nothing)):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        for stage, run in pipeline.STAGES[:-1]:
            assert run(spark, docs, folder).columns == docs.columns, stage
        assert pipeline.run(spark, folder).columns[:3] == ["doc_id", "start", "length"]


def test_pipeline_sends_small_batches(spark, monkeypatch):
    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20

    def watched(of):
        def run(batches, *rest):
            def small():
                for batch in batches:
                    if batch.nbytes > most:
                        raise ValueError(f"{batch.nbytes} bytes in a batch")
                    yield batch

            return of(small(), *rest)

        return run

    text = F.concat(F.repeat(F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" ")), 600), F.col("id").cast("string"))
    table = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    for module, function in ((quality, "_scored"), (simhash, "_described"), (repeats, "_contexts"), (packing, "_cut")):
        monkeypatch.setattr(module, function, watched(getattr(module, function)))
    for stage in ("quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "packing"):
        spark.conf.unset(name)
        dict(corpus_pipeline.STAGES)[stage](spark, table, DATA).write.format("noop").mode("overwrite").save()
    spark.conf.set(name, "1m")
    corpus_pipeline.packing_by_powers_of_two(spark, table, DATA)
    assert spark.conf.get(name) == "1m"
    spark.conf.unset(name)
