"""The training-text operators on small tables with nulls, empty texts, repeats, ties and clashing columns."""

import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from catalith.llm import (byte_bpe, embedding_dups, exact_dedup, language, packing, registry, sharding,  # noqa: E402
                          simhash, token_counts, token_files, toxicity, transducers)
from catalith.llm.components import components  # noqa: E402
from catalith.llm.segments import Encoder  # noqa: E402

LONG = " ".join(f"word{i % 977}, and" for i in range(6000)) + "\n"
TEXTS = ["The cat sat.\nIt slept", "the CAT sat.\nit slept", "", None, " ", "\n\n", "Straße, né à l'école\t!", "中文 한글", LONG, LONG, "a b"]
ROWS = [(i if i != 7 else None, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "y")]


@pytest.fixture(scope="module")
def docs(spark):
    registry.on_workers(spark)
    return spark.createDataFrame(ROWS, "doc_id long, text string, ids string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_equal_the_library(name):
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(P.path(name)), Encoder(P.path(name))
    tok.encode_special_tokens = True
    for t in [*filter(None, TEXTS), "a  b\n c", "don't <|endoftext|> x.,\r\n", "İstanbul é ŉ 12 3"]:
        want = tok.encode(t, add_special_tokens=False)
        assert np.frombuffer(own.ids(t), "<u4").tolist() == want.ids
        assert [tuple(x) for x in own.spans(t).tolist()] == want.offsets


def test_byte_bpe_round_trip(docs, empty):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    both = byte_bpe.decode(byte_bpe.encode(docs.select("doc_id", "text"), path, P.PATTERN), path, P.PATTERN)
    rows = both.collect()
    enc = byte_bpe.encoding(path, P.PATTERN)
    assert len(rows) == len(ROWS)
    for r in rows:
        assert list(r["ids"]) == enc.encode_ordinary(r["text"] or "") and bytes(r["bytes"]) == (r["text"] or "").encode()
    assert byte_bpe.encode(empty, path, P.PATTERN).count() == 0
    assert "".join(byte_bpe.safe_chunks(LONG, 100)) == LONG


def test_simhash_join_equals_all_pairs(spark, docs, empty):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(k)) ^ (np.uint64(1) << np.uint64((k * 7 + 3) % 64)) for b in base[:20] for k in range(12)]
    fp = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64), np.array([0, 3, 2**64 - 1], dtype=np.uint64)]))
    want = {(i, j) for i in range(len(fp)) for j in range(i) if int(fp[i] ^ fp[j]).bit_count() <= 2}
    got = [(max(i, j), min(i, j)) for a, b in simhash.joined_pairs(fp, fp) for i, j in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    nodes = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    root = {r["node"]: r["root"] for r in components(simhash.link_stars(nodes, leaf=8)).collect()}
    label = np.arange(len(fp))
    for _ in range(len(fp)):
        for i, j in want:
            label[i] = label[j] = min(label[i], label[j])
    same = lambda i, j: root.get(int(fp.view(np.int64)[i]), i) == root.get(int(fp.view(np.int64)[j]), j)
    assert all(same(i, j) == (label[i] == label[j]) for i in range(len(fp)) for j in range(i))
    rows = simhash.near_groups(docs).collect()
    assert len(rows) == len(ROWS) and {r["component"] for r in rows if r["fp"] == 0} == {2}
    assert simhash.near_groups(empty).count() == 0
    assert simhash.keep_one(docs).columns == docs.columns


def test_embedding_links_equal_all_pairs(spark):
    registry.on_workers(spark)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((30, 8))
    vectors = [(b + 0.1 * rng.standard_normal(8)).tolist() for b in base for _ in range(6)] + [base[0].tolist()] * 3
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [None] * 8, [1e300] * 8, [1e300] * 8]
    rows = [(i, v, "z") for i, v in enumerate(vectors + odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    got = {r["k"]: r for r in embedding_dups.near_vectors(df, leaf=16, block=8, recall=0.9999).collect()}
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert len(got) == len(rows)
    assert [got[i]["n_links"] for i in range(len(vectors))] == want.tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["component"] == i for i in range(len(vectors), len(vectors) + 5))
    assert got[len(rows) - 1]["component"] == len(rows) - 2
    assert embedding_dups.near_vectors(df.limit(0)).count() == 0


def test_packing_covers_every_id_once(docs, empty):
    path = P.path("byte_bpe_50k.json")
    rows = packing.pack(docs, path).collect()
    enc, at = Encoder(path), {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0) and r["length"] == len(r["ids"]) // 4
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 1024
    for i in (1, 3, 8, 9):
        got = b"".join(bytes(r["ids"]) for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]))
        assert got == enc.ids(TEXTS[i] or "") + b"\0\0\0\0"
    assert packing.pack(empty, path).count() == 0


def test_cut_windows_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(30):
        places = np.concatenate(([0], np.cumsum(rng.integers(1, 9, 24))))
        pen = rng.choice([0, 4], len(places))
        cost = lambda n: 0 if n & (n - 1) == 0 else 16 - n
        best = [0] + [10**9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                if (n := int(places[j] - places[i])) <= 16:
                    best[j] = min(best[j], best[i] + cost(n) + int(pen[j]) + packing.WINDOW)
        cuts = packing.cut_windows(places, pen, 16)
        got = sum(cost(int(places[b] - places[a])) + int(pen[b]) + packing.WINDOW for a, b in zip(cuts, cuts[1:]))
        assert got == best[-1]


def test_token_counts_add_up(docs, empty):
    path = P.path("byte_bpe_50k.json")
    rows = token_counts.section_tokens(docs, path).filter("doc_id in (0, 8)").collect()
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 8) == len(Encoder(path).ids(LONG)) // 4
    best, crossing = token_counts.attribute(np.array([[0, 4], [4, 6], [6, 9], [20, 21]]), np.array([[0, 5], [5, 7], [7, 12]]))
    assert best.tolist() == [0, 0, 2, -1] and crossing.tolist() == [False, True, True, False]
    assert token_counts.section_tokens(empty, path).count() == 0


def test_token_files_read_back(spark, docs, empty, tmp_path):
    path, folder = P.path("word_bpe_49k.json"), f"file://{tmp_path}/a"
    manifest = token_files.write_files(docs, path, folder)
    rows = sorted(token_files.read_files(manifest, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    at, enc = 0, Encoder(path)
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    eight = next(r for r in rows if r["doc_id"] == 8)
    assert zlib.crc32(bytes(eight["ids"])) == zlib.crc32(enc.ids(LONG) + b"\1\0\0\0")
    first = manifest.orderBy("before").first()["shard"]
    assert token_files.read_document(folder, first, 0)[2] == bytes(rows[0]["ids"])
    none = token_files.write_files(empty, path, f"file://{tmp_path}/b")
    assert token_files.read_files(none, f"file://{tmp_path}/b").count() == 0


def test_sharding_table(docs):
    shards = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(shards, 1009)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.lookup_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a < 6)
    assert moved < 0.2 * 1009
    rows = sharding.place(docs, "doc_id", shards, 1009).collect()
    assert len(rows) == len(ROWS) and all(r["shard"] == shards[table[r["slot"]]] for r in rows)


@pytest.mark.parametrize("digits", [64, 1])
def test_exact_dedup(docs, empty, digits):
    rows = exact_dedup.groups(docs, digits=digits).collect()
    norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    by: dict = {}
    for k, t, _ in ROWS:
        by.setdefault(norm(t), []).append(k)
    want = sorted(((k, max((x for x in by[norm(t)] if x is not None), default=None), len(by[norm(t)])) for k, t, _ in ROWS), key=str)
    assert sorted(((r["k"], r["keep_k"], r["n"]) for r in rows), key=str) == want
    if digits == 64:
        assert exact_dedup.drop_copies(docs).count() == len(by)
        assert exact_dedup.groups(empty).count() == 0


def test_transducers_and_clauses(spark, docs):
    marks = toxicity.machine().run
    assert transducers.LETTERS and marks("YI")[1] == "t" and marks("NOI")[2] == "-" and marks("QIQI")[1::2] == ["r", ""]
    g = toxicity.Grammar({"idiot": ("I", 4.0), "kill": ("T", 4.0)}, {"lowe": 4.0})
    s = toxicity.Scorer(g)
    assert [c[3] for c in s.clauses("Fine here. You idiot! Not an idiot; loweisch")] == ["It", "I-", "I"]
    assert s.score(None) == s.score("") and s.score("you idiot")[0] > 0.7 > s.score("he said that")[0]
    rows = spark.createDataFrame([(i, f"t{i} plain words here and gronk{i % 5} u{i} end" if i % 2 else f"u{i} zorg w{i} plain words", i % 2 == 0, "c")
                                  for i in range(400)], "doc_id long, text string, toxic boolean, score string").selectExpr(
        "doc_id", "text", "cast(toxic as int) toxic", "score")
    learned = toxicity.fit(rows)
    assert "zorg" in learned.words and "plain" not in learned.words
    assert toxicity.fit(rows.limit(0)).words


def test_language(spark, docs, empty):
    rows = [(i, "the cat and the dog were here" if i % 2 else "der hund und die katze waren da", "en" if i % 2 else "de") for i in range(40)]
    model = language.fit(spark.createDataFrame(rows + [(99, None, "en"), (None, "x", None)], "doc_id long, text string, lang string"))
    told, score = model.predict(["the dog", "die katze", None, "", "12 !", "the " * 50000])
    assert told == ["en", "de", "und", "und", "und", "en"] and 0 <= score.min() <= score.max() <= 1
    assert language.fit(empty).predict(["a"])[0] == ["und"]
    assert docs.select(language.language(model, docs["text"]).alias("l")).count() == len(ROWS)
