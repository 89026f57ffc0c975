"""Speculative BPE, cross-tokenizer alignment and centroid clustering against
the libraries and brute force, with odd rows."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from test_documents_ops import odd_documents
from voxelframe.llm import align, bisector, queries, speculate
from voxelframe.llm.common import prepare
from voxelframe.llm.words import splitter

FILE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
ODD = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>\n", "x \n\n  y\t z 　 w\xa0\xa0v \x1c q",
       "do n't don't we'll 's's", "tabs\tand\r\nlines\n\n\n", " lead and trail  ", "你好，世界。これは文です" * 20, "naïve café \U0001f600\U0001f600!",
       "a▁b", "<0x41> <s></s>", "zz" * 4000, "=" * 70 + "-" * 70, "foo  bar   baz", "1234567 89.5%", "\x00\x01",
       "if (a) {\r\n  b();\r\r\rc\r\n}\r", "\n\n\nab\u2003\u2003cd \n\n ef\r\rgh"]


@pytest.fixture(scope="module")
def table():
    with open(FILE, "rb") as f:
        return speculate.MergeTable(f.read())


@pytest.fixture(scope="module")
def pieces():
    with open(MODEL, "rb") as f:
        return align.Pieces(f.read())


@pytest.fixture(scope="module")
def corpus(spark):
    prepare(spark)
    return [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def odd_texts(spark):
    rows = [(100 + i, t, "en", "src0", 1) for i, t in enumerate(ODD)]
    return odd_documents(spark).unionAll(spark.createDataFrame(rows, odd_documents(spark).schema))


def random_words(rng, table, n):
    tokens = list(table.token.values())
    made = [b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 4))).decode("utf-8", "ignore") for _ in range(n)]
    made += ["".join(rng.choice("abeilnorst") for _ in range(rng.randint(1, 20))) for _ in range(n)]
    made += [c * k for c in "ab -=\n" for k in range(1, 90)]
    split = splitter(PATTERN)
    return sorted({w for t in made for w in split(t)})


def test_speculation_equals_library(table, corpus):
    library = Tokenizer.from_file(FILE)
    library.encode_special_tokens = True
    split = splitter(PATTERN)
    words = sorted(set(random_words(random.Random(2), table, 4000)) | {w for t in corpus for w in split(t)})
    ids, failed = speculate.encode_words([w.encode() for w in words], table)
    assert ids == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    assert 0 < failed < len(words)
    assert [speculate.merge_exactly(w.encode(), table) for w in words[:3000]] == ids[:3000]


def merges_file(rng, ordered: bool) -> bytes:
    """A tokenizer file of random merges over a few letters; unordered ones may
    make a token from parts that come about later."""
    char = {b: c for c, b in speculate.byte_of_char().items()}
    vocab = {char[b]: b for b in range(256)}
    tokens, merges = list("abc"), []
    while len(merges) < 40:
        a, b = rng.choice(tokens), rng.choice(tokens)
        if len(a + b) > 6 or a + b in vocab:
            continue
        vocab[a + b] = len(vocab)
        tokens.append(a + b)
        merges.append([a, b])
    if not ordered:
        rng.shuffle(merges)
    with open(FILE) as f:
        made = json.load(f)
    made["added_tokens"] = []
    made["model"] |= {"vocab": vocab, "merges": merges}
    return json.dumps(made).encode()


@pytest.mark.parametrize("ordered", [True, False])
def test_speculation_with_random_merges(ordered):
    rng = random.Random(7)
    for _ in range(25):
        data = merges_file(rng, ordered)
        table, library = speculate.MergeTable(data), Tokenizer.from_str(data.decode())
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 24))) for _ in range(200)]
        ids, _ = speculate.encode_words([w.encode() for w in words], table)
        assert ids == [e.ids for e in library.encode_batch(words)]


def test_other_tokenizer_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        with pytest.raises(ValueError):
            speculate.MergeTable(f.read())
    with open(FILE) as f:
        short = json.load(f)
    del short["model"]["vocab"]["!"]
    short["model"]["merges"] = []
    with pytest.raises(ValueError, match="no token for the single bytes"):
        speculate.MergeTable(json.dumps(short).encode())


@pytest.mark.parametrize("block_chars", [1, 300_000])
def test_speculative_encode_decode(spark, block_chars):
    prepare(spark)
    library = Tokenizer.from_file(FILE)
    docs = odd_texts(spark).withColumn("n_tokens", F.lit("clash")).withColumn("text", F.col("text"))
    if block_chars == 1:
        docs = docs.filter("length(text) < 20000 or text is null")
    got = speculate.encode_decode(docs, FILE, PATTERN, block_chars=block_chars).collect()
    full = {(r["doc_id"], r["n_tokens"], bytes(r["decoded"]))
            for r in speculate.encode_decode(docs, FILE, PATTERN, full=True, block_chars=block_chars).collect()}
    want, decoded = [], set()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False).encode()
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text).hexdigest()))
        decoded.add((r["doc_id"], len(ids), text))
    assert Counter(map(tuple, got)) == Counter(want)
    assert full == decoded
    assert speculate.encode_decode(docs.limit(0), FILE, PATTERN).count() == 0
    library.encode_special_tokens = True
    plain = speculate.encode_decode(docs.filter("doc_id = 101"), FILE, PATTERN, special=False).first()["n_tokens"]
    assert plain == len(library.encode(ODD[1], add_special_tokens=False).ids)


def test_speculation_query(spark, corpus):
    library = Tokenizer.from_file(FILE)
    got = Counter(r["ids_sha256"] for r in queries.op13(spark, SF_SMALL).collect())
    assert got == Counter(hashlib.sha256(",".join(map(str, library.encode(t or "", add_special_tokens=False).ids)).encode())
                          .hexdigest() for t in corpus)


# ---- alignment

def align_brute(texts):
    """Whole texts through both libraries."""
    a_model, b_model = Tokenizer.from_file(FILE), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_model.encode_special_tokens = True
    byte = speculate.byte_of_char()
    found, count = [], Counter()
    for text in texts:
        ids_a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b_model.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
                   else b_model.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append(None)
            continue
        ends_a = {int(e): i for i, e in enumerate(np.cumsum([len(t) for t in bytes_a]))}
        links, groups, i, j = [], [], 0, 0
        for q, e in enumerate(np.cumsum([len(t) for t in bytes_b])):
            p = ends_a.get(int(e))
            if p is not None:
                links.append((ids_a[p], ids_b[q]))
                groups.append(",".join(map(str, ids_a[i:p + 1])) + "|" + ",".join(map(str, ids_b[j:q + 1])))
                i, j = p + 1, q + 1
        count.update(links)
        found.append((len(ids_a), len(ids_b), links, ";".join(groups)))
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[2]), len(f[2]), sum(count[p] == top[p[1]] for p in f[2]), sum(count[p] for p in f[2]),
             hashlib.sha256(f[3].encode()).hexdigest()) for f in found]


@pytest.mark.parametrize("sizes", [{}, {"long_bytes": 40, "range_chars": 13, "fan": 3, "block_chars": 2000},
                                   {"long_bytes": 3000, "range_chars": 700, "fan": 2, "block_chars": 1}])
def test_alignment_equals_brute_force(spark, sizes):
    prepare(spark)
    docs = odd_texts(spark).withColumn("n_a", F.lit("clash")).withColumn("uid", F.lit(3)).repartition(3)
    if sizes.get("long_bytes") == 40:
        docs = docs.filter("length(text) < 20000 or text is null")
    rows = docs.collect()
    want = [(r["doc_id"], *w) for r, w in zip(rows, align_brute([r["text"] for r in rows]))]
    got = align.align(docs, FILE, MODEL, PATTERN, **sizes).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert align.align(docs.limit(0), FILE, MODEL, PATTERN, **sizes).count() == 0


def test_alignment_query(spark, corpus):
    got = Counter(tuple(r)[1:] for r in queries.op11(spark, SF_SMALL).collect())
    assert got == Counter(align_brute(corpus))


def test_fragments_compose_in_any_order():
    rng = random.Random(5)

    def listed(groups):
        return [g for g in groups.text().split(";") if g]

    def fold(parts, order):
        # neighbours are composed until one is left; groups keep their place
        done = [([(g.first_end, listed(g))] if len(g) else [], f) for g, f in parts]
        while len(done) > 1:
            k = order(len(done) - 1)
            (g1, f1), (g2, f2) = done[k], done[k + 1]
            met, f = align.compose(f1, f2)
            done[k:k + 2] = [(g1 + ([(met.first_end, listed(met))] if len(met) else []) + g2, f)]
        groups, f = done[0]
        spans = [tuple(x.tolist() for x in getattr(f, s)) for s in ("pre_a", "pre_b", "suf_a", "suf_b")]
        assert groups == sorted(groups)
        return [x for _, g in groups for x in g], f.closed, spans
    for _ in range(150):
        n = rng.randint(1, 40)
        a, b = (align._arrays(range(100, 100 + len(e)), e) for e in
                (sorted(set(rng.sample(range(1, n + 1), rng.randint(0, n))) | {n}) for _ in range(2)))
        whole = align.fragment(a, b, True)
        cuts = [sorted(rng.randint(0, len(x[0])) for _ in range(4)) for x in (a, b)]
        parts = [align.fragment(*[(x[0][s:e], x[1][s:e]) for x, s, e in ((a, *ab[0]), (b, *ab[1]))], k == 0)
                 for k, ab in enumerate(zip(*[zip([0, *c], [*c, len(x[0])]) for c, x in zip(cuts, (a, b))]))]
        left = fold(parts, lambda m: 0)
        assert left == fold(parts, lambda m: m - 1) == fold(parts, rng.randrange)
        assert left[0] == listed(whole[0]) and left[1]


def test_no_token_crosses_a_border(pieces, corpus):
    rng = random.Random(4)
    library = Tokenizer.from_file(FILE)
    library.encode_special_tokens = True

    def a(text):
        return library.encode(text, add_special_tokens=False).ids
    for text in [t for t in corpus if t][:40] + ODD:
        if "▁" in text:
            continue
        text = " " + text
        parts = align.stretches(text, pieces)
        assert "".join(parts) == text
        assert [i for p in parts for i in a(p)] == a(text)
        assert [i for ids in pieces.encode(parts) for i in ids] == pieces.encode([text])[0]
        for _ in range(5):
            at = rng.randrange(1, len(text) + 1)
            cut = pieces.border(text, at)
            found = align._A_BORDER.search(text, at)
            assert sum(pieces.encode([text[:cut], text[cut:]]), []) == pieces.encode([text])[0]
            if found:
                assert a(text[:found.start()]) + a(text[found.start():]) == a(text)


# ---- centroids

def centroid_brute(rows, k, dims, rounds, seed):
    """Plain Python integers."""
    import math
    from fractions import Fraction
    kept = [(i, [math.floor(Fraction(float(x)) * 1024) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = {id(r): hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest() for r in kept}
    centroids = [v for _, v in sorted(kept, key=lambda r: (key[id(r)], r[1]))[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        groups = [[v for (_, v), n in zip(kept, of) if n == c] for c in range(len(centroids))]
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else old for g, old in zip(groups, centroids)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]
    per = Counter()
    for _, c, d in out:
        per[c] += d
    return Counter((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for i, c, d in out)


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_centroids_equal_brute_force(spark, scale):
    prepare(spark)
    rng = random.Random(int(scale))
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.choice([-1, -0.5, 0, 0.25, 0.3, 1]) * scale for _ in range(3)]) for i in range(120)]
    rows += [(7, [0.1, 0.2, 0.3]), (7, [0.1, 0.2, 0.3]), (7, [0.0, 0.2, 0.3]), (None, [1.0, 1.0, 1.0]), (200, None), (201, []),
             (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 0.0]), (204, [nan, 0.0, 0.0]), (205, [0.0, -inf, 0.0]), (206, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("cluster", F.lit("clash"))
    table = table.withColumn("vec", F.lit(1)).repartition(5)
    got = bisector.cluster_report(table, 5, 3, 4, 3).collect()
    assert Counter(map(tuple, got)) == centroid_brute(rows, 5, 3, 4, 3)
    # fewer rows than centroids, and none
    few = table.filter("vec_id in (202, 3)")
    assert Counter(map(tuple, bisector.cluster_report(few, 8, 3, 2, 3).collect())) == centroid_brute(
        [r for r in rows if r[0] in (202, 3)], 8, 3, 2, 3)
    none = bisector.cluster_report(table.limit(0), 8, 3, 2, 3)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_wide_components_stay_exact():
    x = np.array([[1e300, -1e300], [2.0 ** 60 + 256, 0.5], [-0.0001, 3.7]])
    got = bisector.to_integers(x, False).tolist()
    assert got == [[int(1e300) * 1024, -int(1e300) * 1024], [(2 ** 60 + 256) * 1024, 512], [-1, 3788]]
    assert bisector.to_integers(x[2:], True).tolist() == got[2:]


def test_tournament_equals_least_distance():
    rng = np.random.default_rng(3)
    for k in (1, 2, 8):
        centroids = rng.integers(-3, 4, (k, 4))
        x = rng.integers(-4, 5, (500, 4))
        away = ((x[:, None, :] - centroids[None]) ** 2).sum(-1)
        found = bisector.Bisectors(centroids)
        assert (found.nearest(x) == away.argmin(1)).all()       # argmin takes the first of ties
        assert (found.distance(x, found.nearest(x)) == away.min(1)).all()
        assert (found.nearest(x.astype(object)) == away.argmin(1)).all()
