"""The corpus operators against brute force, on small tables with nulls, empty and long texts, repeats and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from handbill.llm import ann, media, mixing, packing, quality, sharding, simhash, substring, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, shard string, n int"


def rows():
    r = random.Random(3)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(1, 6))) for _ in range(300)]
    passage = " ".join(r.choices(vocabulary, k=60))
    out = [(None, "no id here", "en", None), (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", "b"), (4, "x " * 500, "en", "b"), (4, "x " * 500, "en", "b"), (5, "one two", "en", "c")]
    for i in range(6, 60):
        words = r.choices(vocabulary, k=r.choice([3, 25, 80, 400]))
        if i % 5 == 0:
            words[2:2] = passage.split()
        out.append((i, " ".join(words), "de", "abc"[i % 3]))
    long = " ".join(r.choices(vocabulary, k=30_000))
    out += [(60, long, "en", "c"), (61, long + " end", "en", "c"), (62, out[20][1], "en", "a"), (63, "ein Wort  <|endoftext|> ß\n\nzwei ", "de", "b")]
    return [(d, t, lang, s, None if t is None else len(t), "clash", "clash", 1) for d, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def test_simhash(docs):
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows())
    fp = np.array([r["fp"] for r in found], np.int64).view(np.uint64)
    label = list(range(len(fp)))
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3):
            a, b = label[i], label[int(j)]
            label = [min(a, b) if x in (a, b) else x for x in label]
    for i, r in enumerate(found):
        ids = [s["doc_id"] for s, x in zip(found, label, strict=True) if x == label[i] and s["doc_id"] is not None]
        assert r["component_id"] == (min(ids) if ids else None)
    assert {r["fp"] for r in found if r["doc_id"] in (1, 2, 3)} == {0}
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))


def test_simhash_deep_tree(spark):
    """Crowds, chains and lone fingerprints over a tree of depth 10 and more: components as of all pairs."""
    r = np.random.default_rng(1)
    lone = r.integers(0, 2**64, 6000, dtype=np.uint64)
    flips = np.uint64(1) << r.integers(0, 64, (3, 3000)).astype(np.uint64)
    near = lone[r.integers(0, 6000, 3000)] ^ np.where(r.random((3, 3000)) < 0.6, flips, np.uint64(0))[0] ^ flips[1] ^ np.where(r.random(3000) < 0.5, flips[2], np.uint64(0))
    crowd = lone[0] ^ np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (4, 1500)).astype(np.uint64), axis=0)
    fp = np.unique(np.concatenate([lone, near, crowd]))
    tree = simhash.layout(r.permutation(fp)[:5000], 4)
    index, leaf, point = simhash.route(fp, tree, 3)
    depth = np.zeros(len(tree.points), int)
    for i, own in enumerate(tree.children):
        depth[own[own >= 0]] = depth[i] + 1
    assert depth.max() >= 10 and tree.leaves > 1000 and set(index.tolist()) == set(range(len(fp)))
    label = np.arange(len(fp))
    for i in range(len(fp)):
        alike = np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3)
        old = np.unique(label[alike])
        label[np.isin(label, old)] = old[0]
    nodes = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
    found = simhash.links(nodes, len(fp), 3, least=100, most=16).collect()
    parent = {int(x): int(x) for x in fp.view(np.int64)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in found:
        a, b = root(e["a"]), root(e["b"])
        parent[max(a, b)] = min(a, b)
    groups = {}
    for x, k in zip(fp.view(np.int64).tolist(), label.tolist(), strict=True):
        groups.setdefault(k, set()).add(root(x))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_substring(docs):
    seen, expected = set(), {}
    unique = {(d, t or ""): None for d, t, *_ in rows()}
    for d, t in sorted(unique, key=lambda x: (x[0] is None, x[0])):
        w = t.encode().split()
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            gone[i : i + 20] |= key in seen
            seen.add(key)
        expected[d, t] = (len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    for crowd in (substring.CROWD, 1):
        was, substring.CROWD = substring.CROWD, crowd
        found = substring.remove_repeats(docs).collect()
        substring.CROWD = was
        assert len(found) == len(rows())
        for r in found:
            assert (r["n_words"], r["n_removed"], r["kept"]) == expected[r["doc_id"], r["text"] or ""], r["doc_id"]


def test_tokens_and_packing(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.byte_bpe_path())
    ids = {(d, t): library.encode(t or "", add_special_tokens=False).ids for d, t, *_ in rows()}
    counts = sorted((str(r["doc_id"]), r["n_tokens"]) for r in tokens.token_counts(docs).collect())
    assert counts == sorted((str(d), len(ids[d, t])) for d, t, *_ in rows())
    packed = packing.pack(docs).collect()
    full: dict[int, list] = {}
    for r in packed:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in full.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and sum(n for _, n in own) <= 1024
    assert sum(r["length"] for r in packed) == sum(len(ids[d, t]) + 1 for d, t, *_ in rows())
    assert len(full) <= -(-sum(r["length"] for r in packed) // 1024) + 2
    long = sorted((r for r in packed if r["doc_id"] == 60), key=lambda r: r["piece"])
    whole = np.array([*ids[60, rows()[-4][1]], 2], "<u4")
    for r in long:
        assert r["ids_crc32"] == zlib.crc32(whole[r["start"] : r["start"] + r["length"]].tobytes())
        assert r["length"] == 1024 or r["piece"] == 0


def test_sharding(docs):
    found = sharding.shard(docs, 4).collect()
    sizes = [[r["slot"] for r in found if r["shard"] == s] for s in range(4)]
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1 and all(sorted(x) == list(range(len(x))) for x in sizes)
    assert {r["text_crc32"] for r in found if r["doc_id"] == 1} == {0}
    where: dict[tuple, set] = {}
    for r in found:
        where.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert sum(len(x) > 1 for x in where.values()) <= 1


def test_neighbours(spark):
    r = np.random.default_rng(2)
    v = r.standard_normal((700, 8)).astype(np.float32)
    v[50:90] = v[3]
    data = [(i, [float(x) for x in row], i % 3) for i, row in enumerate(v)]
    data += [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [None] * 8, 0), (1003, [float("nan")] * 8, 0), (None, [1.0] * 8, 0), (5, [float(x) for x in v[5]], 0)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    found: dict[int, list] = {}
    for x in ann.neighbours(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(x["query_id"], []).append((x["score"], x["vec_id"]))
    hits = 0
    for q, own in found.items():
        d = np.sqrt(((v.astype(float) - v[q].astype(float)) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(700), d)) if i != q][:10]
        hits += len(set(best) & {i for _, i in own})
        assert own == sorted(own) and all(s == pytest.approx(d[i], rel=1e-12) for s, i in own)
    assert set(found) == set(range(0, 700, 100)) and hits >= 0.95 * 70
    assert ann.neighbours(table.where("false"), F.lit(True)).count() == 0


def test_media(docs):
    text = {d: (t or "").encode() for d, t, *_ in rows()}
    for r in media.media_columns(docs).collect():
        raw = text[r["doc_id"]]
        payload = raw + b" " * ((-len(raw)) % 192 if raw else 192)
        assert (r["n_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))


def test_media_extremes():
    every = bytes(range(256)) * 3 + bytes([0, 255] * 96 * 50)
    several = bytes(192) * (media.MOST_BLOCKS + 2)
    for payload, shown in zip((every, several), media.thumbnails(media.encode([every, several])), strict=True):
        assert media.samples(shown) == payload


def test_mixing(docs):
    found = mixing.words_taken(docs).collect()
    assert len(found) == len(rows()) and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in found)
    targets = {(r["source_size"], r["target"]) for r in found}
    assert sum(t for _, t in targets) == pytest.approx(1.5 * sum(s for s, _ in targets)) and all(t <= 2 * s for s, t in targets)


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(8)
    words = ["".join(r.choices("aeioulmnrst", k=r.randint(2, 6))) for _ in range(200)]
    data, labels = [], []
    for i in range(700):
        w = r.choices(words, k=r.randint(15, 80))
        toxic, junk = i % 4 == 0, i % 5 == 0
        for _ in range(3 * toxic):
            w[r.randrange(len(w))] = r.choice(["vile", "scumbag", "wretch"])
        data.append((i, ". ".join(" ".join(w[a : a + 8]) + ("$$$ ###" if junk else "") for a in range(0, len(w), 8)), "en", "a", 1, "x", "y", 1))
        labels.append((i, int(not junk), int(toxic)))
    data += [(None, None, None, None, None, None, None, None), (9000, "", "en", "a", 0, "x", "y", 1)]
    return spark.createDataFrame(data, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(labelled):
    docs, labels = labelled
    found = {r["doc_id"]: r for r in toxicity.tag(docs, labels).collect()}
    held = [r for d, r in found.items() if r["held_out"] and d is not None and d < 700]
    assert len(held) > 90 and np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) >= 0.97
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    spans = [text[r["doc_id"]][s["begin"] : s["end"]] for r in held for s in r["spans"]]
    assert spans and np.mean([any(w in s for w in ("vile", "scumbag", "wretch")) for s in spans]) > 0.95
    assert found[9000]["predicted"] == 0 and found[None]["spans"] == []
    assert toxicity.tag(docs.where("false"), labels).count() == 0
    assert {r["score"] for r in toxicity.tag(docs, labels.where("false")).collect()} == {0.5}


def test_quality(labelled):
    docs, labels = labelled
    found = {r["doc_id"]: r for r in quality.score_quality(docs, labels, epochs=12).collect()}
    held = [r for d, r in found.items() if r["held_out"] and d is not None and d < 700]
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 != 0) for r in held]) >= 0.95
    assert {r["score"] for r in quality.score_quality(docs, labels.where("false")).collect()} == {0.5}


def test_empty_tables(docs):
    none = docs.where("false")
    for f in (simhash.near_duplicates, simhash.deduplicate, substring.remove_repeats, tokens.token_counts, packing.pack, sharding.shard, media.media_columns, mixing.words_taken):
        assert f(none).count() == 0, f


def test_pipeline(spark, labelled, tmp_path):
    docs, labels = labelled
    docs.select("doc_id", "text", "lang", "source", F.col("n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == corpus_pipeline.COLUMNS, name
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} <= {r["doc_id"] for r in kept.select("doc_id").distinct().collect()}
    assert packed.count() > 400
