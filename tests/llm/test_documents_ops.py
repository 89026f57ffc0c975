"""Operators on documents against brute force, with odd rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from voxelframe.llm import bpe, mixing, quality_mil, queries, shard, simhash, token_count, words
from voxelframe.llm.common import prepare
from voxelframe.llm.graph import connected_components

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        return bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts(spark):
    prepare(spark)
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeats."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "Gamma,", "déjà", "42"]) for _ in range(40000))
    rows = [(1, None, None, None, None), (2, "", "en", "src0", 0), (3, " \t\n ", "en", None, 4), (4, long, "en", "src0", 1),
            (5, long, "en", "src0", 1), (6, long + " tail", None, "src1", 1), (7, "x" * 30000, "de", "src1", 1),
            (8, "one", "en", "src0", 3), (9, "one two", "en", "src0", 7), (None, "no id here at all", "en", "src2", 1),
            (None, "no id here at all", "en", "src2", 1), (10, "a b c d", "en", "src2", 7), (10, "a b c d", "en", "src2", 7),
            (11, "a\x1cb \x85 c d  e", "fr", "src2", 1), (12, "café's 你好 \U00018da7\U00018da7a 12½", "fr", "src2", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def simhash_brute(text):
    words_ = [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))) if w]
    if not words_:
        return 0
    shingles = [" ".join(words_)] if len(words_) < 3 else [" ".join(words_[i:i + 3]) for i in range(len(words_) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(100)] + [(5, 5), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    pairs = [(a, b) for a, b in edges if a is not None and a != b]
    want = components({n for p in pairs for n in p}, pairs)
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_matches_brute_force(spark, texts):
    got = queries.op3(spark, SF_SMALL).collect()
    fps = {d: simhash_brute(t) for d, t in texts.items()}
    ids = sorted(fps)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = components(ids, linked)
    assert len(got) == len(ids)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        d: (f"{fps[d]:016x}", want[d]) for d in ids}


@pytest.mark.parametrize("piece", [1024, 16])
def test_fingerprint_links_are_complete(spark, monkeypatch, piece):
    """Dense and sparse fingerprints, also with blocks dealt out as pieces."""
    monkeypatch.setattr(simhash, "PIECE", piece)
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(120)]
    fps = set(base)
    for b in base[:30]:
        for _ in range(12):
            fps.add(b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(1, 5))))
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    comp = connected_components(simhash.fingerprint_links(df, len(fps), 3)).collect()
    label = {r["node"]: r["component"] for r in comp}
    linked = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3]
    want = components(fps, linked)
    assert {f: label.get(f, f) for f in fps} == want
    for n in (10, 10 ** 6, 10 ** 10):          # every pair within 3 bits shares a block at any size
        masks = simhash.block_tables(n, 3)
        for _ in range(300):
            flips = sum(1 << i for i in rng.sample(range(64), 3))
            assert any(not flips & m for m in masks)


def test_near_duplicates_odd_rows(spark):
    docs = odd_documents(spark)
    got = simhash.near_duplicates(docs).collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    kept = simhash.drop_near_duplicates(docs.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(2)))
    assert kept.columns == [*docs.columns, "fp", "component_id"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        [(False, i) for i in (1, 4, 7, 8, 9, 10, 11, 12)] + [(True, 0)])      # 6 is a near copy of 4
    # one id with different texts: only the row that stands for its group stays
    more = docs.unionByName(spark.createDataFrame([(1, "one", "x", "y", 1), (8, "some other words of its own", "x", "y", 1)], SCHEMA))
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.drop_near_duplicates(more).collect())
    assert [t for i, t in texts if i == 1] and len([t for i, t in texts if i in (1, 8)]) == 2
    assert len(texts) == len({simhash_brute(t) for _, t in texts})
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def test_hubs_of_many_edges(spark, monkeypatch):
    """A star, stars that share leaves, and a clique: the minima of hubs are
    broadcast, with the same components."""
    from voxelframe.llm import graph
    prepare(spark)
    rng = random.Random(8)
    pairs = [(500, i) for i in range(1000, 1400)] + [(i, 2000) for i in range(1300, 1500)] + [(3000 + i, 3000 + j)
             for i in range(40) for j in range(i)] + [(rng.randrange(4000, 4300), rng.randrange(4000, 4300)) for _ in range(150)]
    want = components({n for p in pairs for n in p}, pairs)
    hubs = []
    whole = graph._hub_edges
    monkeypatch.setattr(graph, "_hub_edges", lambda n, parts: hubs.append(whole(n, parts)) or hubs[-1])
    got = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in pairs)}
    assert hubs[0] < 400                # so the star's centre was one


def test_dropping_keeps_columns_of_any_name(spark):
    prepare(spark)
    docs = odd_documents(spark).filter("doc_id is null or doc_id <> 4").withColumn("out_id", F.lit(1)).withColumn("odd_id", F.col("doc_id"))
    docs = docs.withColumn("look_up", F.lit("x")).withColumn("LOOK_UP_", F.lit(2)).withColumn("row", F.lit(3)).withColumn("fp", F.lit(4))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    plain = simhash.drop_near_duplicates(docs.select("doc_id", "text"))
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in plain.collect())


def test_replay_equals_library(vocabulary, library, texts):
    split = words.splitter(public_tokenizers.PATTERN)
    for t in list(texts.values())[:60] + ["a\x1cb \x85 c d  e", "\U00018da7\U00018da7a's 12½", "x" * 5000, "͸a�"]:
        pieces = [w for c in words.chunks(t, split) for w in split(c)]
        ids = [i for w in bpe.replay([p.encode() for p in pieces], vocabulary) for i in w]
        assert "".join(pieces) == t and ids == library.encode_ordinary(t)


def test_replay_with_any_order_of_ranks():
    """Vocabularies in which merges form pairs of lower rank."""
    rng = random.Random(2)
    for trial in range(60):
        found = set()
        while len(found) < 12:
            found.add(bytes(rng.choice(b"ab") for _ in range(rng.randrange(2, 5))))
        found = sorted(found)
        rng.shuffle(found)
        own = {t: i for i, t in enumerate([bytes([c]) for c in range(256)] + found)}
        reference = tiktoken.Encoding(f"t{trial}", pat_str="[ab]+", mergeable_ranks=own, special_tokens={})
        some = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 24))) for _ in range(80)]
        assert bpe.replay(some, bpe.Vocabulary(own)) == [reference.encode_ordinary(w.decode()) for w in some]


def test_words_of_every_character(library):
    """Classes of characters as the tokenizer library sees them."""
    split = words.splitter(public_tokenizers.PATTERN)
    token = {i: library.decode_single_token_bytes(i) for i in range(library.n_vocab)}
    for at in range(0, 0x110000, 0x400):
        chars = [chr(c) for c in range(at, at + 0x400) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1{c},{c}{c} " for c in chars)
        pieces = [w for c in words.chunks(text, split) for w in split(c)]
        assert "".join(pieces) == text and pieces == split(text)
        # no token of the library spans a border of ours
        ends = {0}
        for w in pieces:
            ends.add(max(ends) + len(w.encode()))
        place = 0
        for i in library.encode_ordinary(text):
            start, place = place, place + len(token[i])
            assert not any(start < e < place for e in range(start + 1, place) if e in ends)


@pytest.mark.parametrize("block_chars", [words.BLOCK_CHARS, 3000])
def test_encode_decode(spark, library, block_chars):
    prepare(spark)
    docs = odd_documents(spark).unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id") + 100, *SCHEMA.replace(" string", "").replace(" bigint", "").split(", ")[1:]).toDF(
            "doc_id", "text", "lang", "source", "n_chars")).withColumn("block", F.lit("clash")).withColumn("words", F.lit(1))
    def want(t):
        ids = library.encode_ordinary(t or "")
        return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())
    got = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, block_chars=block_chars).collect()
    key = lambda r: str(r)
    assert sorted([tuple(r) for r in got], key=key) == sorted(
        [(r["doc_id"], *want(r["text"])) for r in docs.collect()], key=key)
    full = bpe.encode_decode(docs.filter("doc_id <= 12"), RANKS, public_tokenizers.PATTERN, full=True).collect()
    by = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(bytes(r["decoded"]).decode() == by[r["doc_id"]] and r["ids"] == library.encode_ordinary(by[r["doc_id"]])
               for r in full)
    assert bpe.encode_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_trie_states_hold_cost_and_pieces(ranks):
    costs = token_count.Costs(ranks)
    plain = token_count.unigram_costs(ranks)
    some = [b"thing", b"things", b"thin", b"", "déjà".encode(), b"xyzzyxyzzy"]
    assert token_count.trie_counts(some, costs) == [best_pieces(w, plain, costs.longest) for w in some]


def best_pieces(word, costs, longest):
    """Plain forward search of one word."""
    best = [(0, 0)] + [None] * len(word)
    for j in range(1, len(word) + 1):
        best[j] = min((best[i][0] + costs[word[i:j]], best[i][1] + 1) for i in range(max(0, j - longest), j) if word[i:j] in costs)
    return best[-1][1]


def test_token_counts(spark, ranks):
    prepare(spark)
    costs = token_count.unigram_costs(ranks)
    longest = max(map(len, ranks))
    split = words.splitter(public_tokenizers.PATTERN)
    docs = odd_documents(spark).withColumn("value", F.lit(0))
    some = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("n_chars < 1500")
    both = docs.select("doc_id", "text", "value").unionByName(some.select(F.col("doc_id") + 100, "text", F.lit(0)).toDF(
        "doc_id", "text", "value"))
    cache = {}
    def want(t):
        return sum(cache.setdefault(w, None) or cache.update({w: best_pieces(w.encode(), costs, longest)}) or cache[w]
                   for w in split(t or ""))
    got = token_count.token_counts(both, RANKS, public_tokenizers.PATTERN, block_chars=5000).collect()
    key = lambda r: str(r)
    assert sorted([tuple(r) for r in got], key=key) == sorted([(r["doc_id"], want(r["text"])) for r in both.collect()], key=key)
    assert token_count.token_counts(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_jump_hash_properties():
    keys = shard.mixed(np.arange(-2000, 20000))
    a, b = shard.jump(keys, 16), shard.jump(keys, 17)
    assert set(a) == set(range(16)) and ((b == a) | (b == 16)).all()
    assert abs((b == 16).mean() - 1 / 17) < 0.01
    assert np.bincount(a).max() < 1.1 * len(keys) / 16
    assert (shard.jump(keys, 1) == 0).all()


def test_shards_odd_rows(spark):
    docs = odd_documents(spark).withColumn("shard", F.lit("x")).withColumn("part", F.lit("y"))
    got = shard.assign_shards(docs, 3).collect()
    assert len(got) == docs.count()
    for s in {r["shard"] for r in got}:
        slots = sorted((r["slot"], r["doc_id"] is not None, r["doc_id"] or 0) for r in got if r["shard"] == s)
        assert [x[0] for x in slots] == list(range(len(slots))) and [x[1:] for x in slots] == sorted(x[1:] for x in slots)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert shard.assign_shards(docs.limit(0), 3).count() == 0


def plain_split(children, given):
    """Water filling by steps: fill every child that asks for less than its share."""
    budget, open_, rest = {}, dict(children), given
    while open_:
        weight = sum(w for _, w in open_.values())
        full = [n for n, (s, w) in open_.items() if s * weight <= rest * w]
        if not full:
            shares = {n: rest * w // weight for n, (s, w) in open_.items()}
            spare = rest - sum(shares.values())
            for n in sorted(open_, key=lambda n: (open_[n][0] / open_[n][1], n))[:spare]:
                shares[n] += 1
            return budget | shares
        n = min(full, key=lambda n: (open_[n][0] / open_[n][1], n))
        budget[n] = open_.pop(n)[0]
        rest -= budget[n]
    return budget


def test_budgets_equal_stepwise_filling(spark):
    rng = random.Random(4)
    leaves = [(f"d{i}", f"l{j}", f"s{k}", rng.choice([0, 1, 7, 300, 5000])) for i in range(3) for j in range(3)
              for k in range(rng.randrange(1, 4))]
    weights = [{("d0",): 9, ("d1",): 2}, {("d0", "l1"): 3}, {("d2", "l2", "s0"): 4}]
    got = mixing.leaf_budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint"),
                              weights, 700, 2).collect()
    supply = {p[:3]: 2 * p[3] for p in leaves}
    total = sum(p[3] for p in leaves)
    def weigh(path):
        return weights[len(path) - 1].get(path, 1)
    def fill(path, given):
        if len(path) == 3:
            return {path: given}
        kids = {p[:len(path) + 1] for p in supply if p[:len(path)] == path}
        part = plain_split({k: (sum(s for p, s in supply.items() if p[:len(k)] == k), weigh(k)) for k in kids}, given)
        return {leaf: b for k in kids for leaf, b in fill(k, part[k]).items()}
    want = fill((), min(total * 700 // 1000, 2 * total))
    assert {(r["domain"], r["lang"], r["source"]): r["budget"] for r in got} == want
    assert sum(want.values()) == min(total * 700 // 1000, 2 * total)


def test_mix_rows_follow_the_selection(spark):
    docs = odd_documents(spark).withColumn("epoch", F.lit("c")).withColumn("mix_cut", F.lit("d"))
    path = {"domain": F.lit("all"), "lang": F.col("lang"), "source": F.col("source")}
    picked = mixing.select_mix(docs, path, [], 1400, 2).collect()
    rows = mixing.mix(docs, path, [], 1400, 2)
    assert rows.columns == docs.columns
    key = lambda v: (v is None, v or 0)
    assert sorted((r["doc_id"] for r in rows.collect()), key=key) == sorted((r["doc_id"] for r in picked), key=key)
    used = sum(r["n_tokens"] for r in picked)
    total = docs.agg(F.sum(mixing.word_tokens(F.col("text")))).first()[0]
    assert used <= total * 1400 // 1000
    assert mixing.select_mix(docs.limit(0), path, []).count() == 0 and mixing.mix(docs.limit(0), path, []).count() == 0
    with pytest.raises(ValueError):
        mixing.select_mix(docs, path, [{("all",): 0}])


def test_quality_held_out_accuracy(spark):
    """On the larger tables: documents never learned from are told apart."""
    sf = "/root/testdata/sf0.1"
    got = queries.op1(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in got) / len(got)
    kept = [r["predicted"] for r in got if r["quality"] == 1]
    assert len(got) > 500 and right > 0.97 and sum(kept) / len(kept) > 0.98


def plain_vector(word):
    """A word's description by loops over its characters."""
    import zlib
    marks = ["9" if c.isdigit() else ("X" if c.isupper() else "x") if c.isalpha() else c for c in word]
    shape = ""
    for i, m in enumerate(marks):
        if i and m == marks[i - 1]:
            continue
        run = i + 1 < len(marks) and marks[i + 1] == m
        shape += m + ("+" if run and m not in "Xx" else "")
    v = np.zeros(quality_mil.WIDTH)
    v[zlib.crc32(shape.encode("utf-8", "replace")) % quality_mil.SHAPES] = 1
    n, upper = len(marks), marks.count("X")
    letters = upper + marks.count("x")
    stats = [n / 10, letters / n, upper / n, marks.count("9") / n, (n - letters) / n, letters == 0, n > 20, upper == letters > 1]
    v[quality_mil.SHAPES:quality_mil.SHAPES + quality_mil.STATS] = [min(float(s), 10) for s in stats]
    padded = f" {word.lower()} "
    for a, b in zip(padded, padded[1:]):
        pair = (ord(a) * 2654435761 + ord(b) * 2246822519) % 2 ** 64 >> 15
        v[quality_mil.SHAPES + quality_mil.STATS + pair % quality_mil.PAIRS] += 1 / (len(padded) - 1)
    return v


def plain_score(model, text):
    """A document's score by loops over its passages."""
    words = text.split()
    passages = [words[i:i + quality_mil.PASSAGE] for i in range(0, len(words), quality_mil.PASSAGE)] or [[]]
    codes, energies = [], []
    for p in passages:
        x = sum(map(plain_vector, p)) / len(p) if p else np.zeros(quality_mil.WIDTH)
        h = np.tanh((x - model["mean"]) / model["scale"] @ model["W"] + model["b"])
        codes.append(h)
        energies.append((np.tanh(h @ model["V"]) / (1 + np.exp(-(h @ model["U"])))) @ model["w"])
    weights = np.exp(np.array(energies) - max(energies))
    z = sum(w * h for w, h in zip(weights / weights.sum(), codes))
    return 1 / (1 + np.exp(-(z @ model["beta"] + model["c"])))


def test_quality_scores_equal_plain_loops(spark, texts):
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_mil.fit(docs, labels)
    long = "İstanbul " + "x" * 1500 + "\U00010400\U00010428 ab--" + "!" * 40 + " ABC 12 a\u0301 ß \x1c"
    some = [*list(texts.values())[:60], "", " \n", long, "one"]
    got = quality_mil.Scorer(model)(some)
    assert np.allclose(got, [plain_score(model, t) for t in some], atol=2e-5)
    again = quality_mil.Scorer(model)
    assert [float(again([t])[0]) for t in some] == got.tolist()         # whoever shares the call


def test_quality_reads_letters(spark):
    """Prose keeps its place, the same text with random letters loses it."""
    prepare(spark)
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_mil.fit(docs, labels)
    held = docs.join(labels.filter("quality = 1"), "doc_id").filter(quality_mil.held_out(F.col("doc_id"))).orderBy("doc_id")
    prose = [r["text"] for r in held.limit(300).collect()]
    scorer = quality_mil.Scorer(model)
    before, after = scorer(prose), scorer([quality_mil.scrambled(t, 10 ** 6 + i) for i, t in enumerate(prose)])
    assert (after < before).mean() > 0.99 and (before >= 0.7).mean() > 0.98 and (after < 0.7).mean() > 0.95


def test_quality_places_go_to_documents_that_are_there(spark, monkeypatch):
    prepare(spark)
    docs = spark.createDataFrame([(i, f"text {i} " * (1 if i % 2 else 9000)) for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 4 // 2) for i in range(4000)], "doc_id bigint, quality int")

    def count(batches):         # in place of the model, what it would learn from
        import pickle
        import pyarrow as pa
        ids = {i for b in batches for i in b.column(0).to_pylist()}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(ids)])], names=["model"])
    monkeypatch.setattr(quality_mil, "_train_sample", count)
    found = quality_mil.fit(docs, labels, max_docs=10)
    held = {r["doc_id"] for r in docs.filter(quality_mil.held_out(F.col("doc_id"))).collect()}
    assert len(found) == 10 and all(i % 2 and i < 40 and i not in held for i in found)


def test_quality_attention_gradient():
    rng = np.random.default_rng(0)
    x, starts, y = rng.normal(size=(9, quality_mil.WIDTH)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    model = {"W": rng.normal(0, .2, (quality_mil.WIDTH, 5)), "b": rng.normal(size=5), "V": rng.normal(size=(5, 3)),
             "U": rng.normal(size=(5, 3)), "w": rng.normal(size=3), "beta": rng.normal(size=5), "c": 0.3}
    def loss(m):
        p = quality_mil._attend(m, np.tanh(x @ m["W"] + m["b"]), starts)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    grad = quality_mil._gradient(model, x, starts, y)
    for k, v in model.items():
        step = rng.normal(size=np.shape(v))
        up, down = ({**model, k: v + s * 1e-6 * step} for s in (1, -1))
        assert np.isclose((loss(up) - loss(down)) / 2e-6, np.sum(grad[k] * step), rtol=1e-4, atol=1e-7), k


def test_quality_odd_rows(spark):
    prepare(spark)
    docs = odd_documents(spark).withColumn("score", F.lit("x")).withColumn("label", F.lit(0))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 13)] + [(3, 0, 0), (None, 1, 0), (4, None, 0), (5, 7, 1)],
                                   "doc_id bigint, quality int, toxic int")
    model = quality_mil.fit(docs, labels)
    got = quality_mil.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    kept = quality_mil.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got)
    none = quality_mil.fit(docs, labels.limit(0))
    assert none is None and {r["score"] for r in quality_mil.score(docs, none).collect()} == {0.5}
    assert quality_mil.keep_good(docs, none).count() == docs.count()
    assert quality_mil.score(docs.limit(0), model).count() == 0
    assert quality_mil.fit(docs, labels.filter("quality = 1")) == 1
