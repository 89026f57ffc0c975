"""Operators on vectors, conversations and pages, and the pipeline."""

import hashlib
import math
import random
from datetime import datetime

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from test_documents_ops import RANKS, components, library, odd_documents, ranks, simhash_brute  # noqa: F401
from voxelframe.llm import chat, mih, mixing, projection, quality_mil, queries, token_count, url_lists
from voxelframe.llm.common import prepare

NAN = float("nan")


def vectors(seed=0, n=300, dims=16):
    """Random vectors, pairs near the threshold, a dense group and copies."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist(), i % 3) for i in range(n)]
    for i in range(40):
        v = np.array(rows[i][1]) + rng.normal(size=dims) * 0.12
        rows.append((len(rows), v.astype(np.float32).tolist(), rows[i][2]))
    rows += [(len(rows) + i, (np.array(rows[0][1]) + rng.normal(size=dims) * 0.03).astype(np.float32).tolist(), 0)
             for i in range(120)]
    rows += [(len(rows) + i, rows[7][1], rows[7][2]) for i in range(30)]
    odd = [None, [], [0.0] * dims, [NAN] + [1.0] * (dims - 1), [float("inf")] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1),
           [1.0, 2.0]]
    return rows + [(len(rows) + i, v, 0) for i, v in enumerate(odd)] + [(9000, rows[3][1], None), (None, rows[3][1], 0)]


VECTORS = "vec_id bigint, embedding array<float>, label int"


def cosines(rows):
    x = np.array([r[1] for r in rows], float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    return x @ x.T


def sound(rows, dims=16):
    return [r for r in rows if r[1] is not None and len(r[1]) == dims and all(v is not None and math.isfinite(v) for v in r[1])
            and any(r[1])]


@pytest.mark.parametrize("window", [32, 4])
def test_projection_links(spark, window):
    prepare(spark)
    rows = vectors()
    good = sound([r for r in rows if r[2] is not None and r[0] is not None])
    rows = [r for r in rows if r[0] is not None]
    sims = cosines(good)
    same = np.array([r[2] for r in good])
    link = (sims >= 0.98) & (same[:, None] == same[None, :]) & ~np.eye(len(good), dtype=bool)
    want = components([r[0] for r in rows], [(good[i][0], good[j][0]) for i, j in zip(*np.nonzero(link))])
    count = {r[0]: 0 for r in rows} | {r[0]: int(link[i].sum()) for i, r in enumerate(good)}
    df = spark.createDataFrame(rows, VECTORS).withColumn("node", F.lit("x")).withColumn("copies", F.lit(0))
    got = projection.near_duplicates(df, 0.98, window=window).collect()
    assert len(got) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {
        i: (count[i], want[i], want[i] == i) for i in want}


def test_projection_links_in_a_cone(spark):
    """Vectors of mean cosine 0.9 with a threshold that links only the planted
    pairs, and a window that holds a sliver of them."""
    prepare(spark)
    rng = np.random.default_rng(5)
    n, dims = 3000, 64
    x = rng.normal(size=(n, dims))
    x = np.sqrt(0.1 / dims) * x + np.eye(dims)[0] * np.sqrt(0.9)
    x /= np.linalg.norm(x, axis=1)[:, None]
    far = rng.normal(size=(500, dims))
    far -= (far * x[:500]).sum(1)[:, None] * x[:500]
    near = 0.9805 * x[:500] + np.sqrt(1 - 0.9805 ** 2) * far / np.linalg.norm(far, axis=1)[:, None]
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(np.vstack([x, near]))]
    link = (cosines(rows) >= 0.98) & ~np.eye(len(rows), dtype=bool)
    assert link.sum() >= 900
    got = {r["vec_id"]: r["n_links"] for r in projection.near_duplicates(
        spark.createDataFrame(rows, VECTORS), 0.98, window=4).collect()}
    assert got == {i: int(k) for i, k in enumerate(link.sum(1))}


@pytest.mark.parametrize("cosine", [0.5, 0.9])
def test_projection_keeps_to_windows_in_a_cone(spark, monkeypatch, cosine):
    """Close directions: the planted pairs are all found, and hardly a row is
    compared with its whole label."""
    prepare(spark)
    rng, n, dims = np.random.default_rng(6), 4000, 64
    x = np.sqrt((1 - cosine) / dims) * rng.normal(size=(n, dims)) + np.eye(dims)[0] * np.sqrt(cosine)
    x /= np.linalg.norm(x, axis=1)[:, None]
    far = rng.normal(size=(2000, dims))
    far -= (far * x[:2000]).sum(1)[:, None] * x[:2000]
    near = 0.9805 * x[:2000] + np.sqrt(1 - 0.9805 ** 2) * far / np.linalg.norm(far, axis=1)[:, None]
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(np.vstack([x, near]))]
    compared, whole = [], projection._candidates
    monkeypatch.setattr(projection, "_candidates", lambda *a: compared.append(whole(*a)) or compared[0])
    got = {r["vec_id"]: r["n_links"] for r in projection.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    link = (cosines(rows) >= 0.98) & ~np.eye(len(rows), dtype=bool)
    assert link.sum() >= 3900 and got == {i: int(k) for i, k in enumerate(link.sum(1))}
    assert compared[0][1].count() < len(rows) / 10


def test_projection_angles_bound_every_partner():
    rng = np.random.default_rng(2)
    u = projection.unit(rng.normal(size=(4000, 5)))
    mean = np.array([0.7, 0.2, 0, 0, 0.1])
    away = rng.normal(size=u.shape) * rng.uniform(0, 0.2, (4000, 1))
    v = projection.unit(u + away)
    linked = (u * v).sum(1) >= 0.98
    x, y = u - mean, v - mean
    norm = np.linalg.norm(x, axis=1)
    angle = np.arccos(np.clip((x * y).sum(1) / norm / np.linalg.norm(y, axis=1), -1, 1))
    assert linked.sum() > 1000 and (angle <= projection._angles(norm, 0.98) + 1e-9)[linked].all()


def test_projection_names_may_clash(spark, monkeypatch):
    prepare(spark)
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 1.0], 1)], VECTORS)
    seen = {tuple(r) for s in (0, 1) for r in projection.near_duplicates(df, name_seed=s).collect()}
    assert seen == {(1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False)}


def test_projection_odd_tables(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0], 1)], VECTORS)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in projection.near_duplicates(df).collect()),
                 key=str)
    assert got == sorted([(None, 2, 2, False), (2, 2, 2, True), (2, 2, 2, True), (3, 0, 3, True)], key=str)
    assert projection.near_duplicates(df.limit(0)).count() == 0


def test_passes_grow_with_the_table():
    assert projection.passes_for(10 ** 6, 0.98) > projection.passes_for(10 ** 4, 0.98)


def test_nearest_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op2(spark, sf).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()]
    ids, sims = np.array([r[0] for r in rows]), cosines(rows)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in ids.tolist() if i % 50 == 0}
    at = {i: k for k, i in enumerate(ids.tolist())}
    hit = 0
    for q, best in found.items():
        best.sort()
        assert [b[0] for b in best] == [1, 2, 3, 4, 5]
        assert all(abs(s - sims[at[q], at[v]]) < 1e-12 for _, v, s in best)
        assert [s for *_, s in best] == sorted((s for *_, s in best), reverse=True)
        row = sims[at[q]].copy()
        row[at[q]] = -2
        hit += len(set(ids[np.argsort(-row)[:5]].tolist()) & {b[1] for b in best})
    assert hit / (5 * len(found)) >= 0.9


def test_substring_probing_is_complete():
    """Every code within the radius is retrieved, whatever the substrings."""
    rng = np.random.default_rng(5)
    x, q = (projection.unit(rng.normal(size=(n, 64))) for n in (500, 20))
    p = mih.fit_codes(x)
    a, b = mih.codes(x, p), mih.codes(q, p)
    away = np.bitwise_count(a[None] ^ b[:, None]).sum(-1)
    for radius in (40, 50, 58, mih.BITS):
        qs, rs, _ = mih.search_block(x, np.arange(500), q, np.arange(1000, 1020), p, radius, 500)
        assert sorted(zip(qs.tolist(), rs.tolist())) == sorted(zip(*(v.tolist() for v in np.nonzero(away <= radius))))


def clustered(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 20, dim))
    return (centres[rng.integers(0, len(centres), n)] + 0.15 * rng.normal(size=(n, dim))).astype("f4").astype(float)


@pytest.mark.parametrize("share", [mih.MAX_SHARE, 0.0])
def test_nearest_of_every_length(spark, monkeypatch, share):
    """Two lengths, one rare, and a single vector of a third; both layouts give
    the same rows, and the index deals out no blocks."""
    prepare(spark)
    x, y = clustered(2000, 32), clustered(1200, 16)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(10_000 + i, v.tolist(), 0) for i, v in enumerate(y)]
    rows += [(20_000, [1.0, 2.0], 0), (3, x[3].tolist(), 0), (5000, x[7].tolist(), 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("rid", F.lit("clash")).withColumn("c0", F.lit(0))
    whole, dealt = mih._pairs, []
    monkeypatch.setattr(mih, "_pairs", lambda *a: dealt.append(a[-3]) or whole(*a))
    got = mih.nearest(df, F.col("vec_id") % 50 == 0, max_share=share)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i, *_ in rows if i % 50 == 0} - {20_000}
    assert all(d == mih.BITS for d in dealt) if share else mih.BITS not in dealt or len(dealt) > 2
    hit = wanted = 0
    for ids, v in ((np.r_[np.arange(2000), 5000], np.vstack([x, x[7]])), (10_000 + np.arange(1200), y)):
        sims = projection.unit(v) @ projection.unit(v).T
        for at in np.flatnonzero(ids % 50 == 0):
            best = sorted(found[int(ids[at])])
            assert [b[0] for b in best] == [1, 2, 3, 4, 5]
            assert all(abs(s - sims[at, np.flatnonzero(ids == i)[0]]) < 1e-9 for _, i, s in best)
            row = sims[at].copy()
            row[at] = -2
            hit += len(set(ids[np.argsort(-row)[:5]].tolist()) & {b[1] for b in best})
            wanted += 5
    assert hit / wanted >= 0.9


def test_index_retrieves_every_code_in_the_radius(spark):
    prepare(spark)
    x = clustered(400, 24)
    p = mih.fit_codes(projection.unit(x))
    c = mih.codes(projection.unit(x), p)
    away = np.bitwise_count(c[None] ^ c[:, None]).sum(-1)
    rows = spark.createDataFrame([(i, i, bytearray(v.astype("<f8").tobytes())) for i, v in enumerate(x)],
                                 "rid bigint, vec_id bigint, vec binary")
    for radius in (0, 9, 25):
        found = mih._indexed(rows, rows.filter("vec_id < 40").select("vec_id", "vec"), p, radius, "<f8").collect()
        want = {(q, r) for q, r in zip(*np.nonzero(away[:40] <= radius)) if q != r}
        assert len(found) == len(want) and {(f["query_id"], f["vec_id"]) for f in found} == want


def test_nearest_odd_rows(spark):
    prepare(spark)
    rows = vectors(n=20)
    df = spark.createDataFrame(rows + [rows[0]], VECTORS).withColumn("asks", F.lit("x")).withColumn("vec", F.lit(1))
    got = mih.nearest(df, F.col("vec_id") < 3, k=5).collect()
    assert len(got) == 15 and {r["query_id"] for r in got} == {0, 1, 2}
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (3, None, 0)], VECTORS)
    got = mih.nearest(few, F.col("vec_id") == 0, k=5).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got) == [(1, 1), (2, 2)]          # ties to the smaller id
    assert mih.nearest(few.limit(0), F.col("vec_id") == 0).count() == 0
    assert mih.nearest(few.filter("vec_id = 3"), F.col("vec_id") == 3).count() == 0
    assert mih.nearest(few.filter("vec_id = 0"), F.col("vec_id") == 0).count() == 0


TRICKY = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\s> [\\INST]", "<s><s>", "[[INST]]", "plain", "", "<", "a\\", "</s", "é你 <s>"]


def test_escape_is_reversible():
    rng = random.Random(1)
    for t in TRICKY + ["".join(rng.choice("<>[]/\\sINST") for _ in range(30)) for _ in range(2000)]:
        out = chat.escape(t)
        assert chat.unescape(out) == t
        assert not any(m in out for m in ("<s>", "</s>", "[INST]", "[/INST]"))
        text, _, _ = chat.render([("user", t), ("assistant", t)], 0)
        assert chat.parse(text) == [("user", t), ("assistant", t)]


def digests(turns):
    said, learned = hashlib.sha256(), ""
    for role, text in turns:
        said.update(f"{role}\n{text}\n".encode())
        learned += text if role == "assistant" else ""
    return len(turns), said.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op6(spark, SF_SMALL).collect()}
    assert got == {c: digests([(r[2], r[3]) for r in sorted(x for x in rows if x[0] == c)]) for c in {r[0] for r in rows}}


def test_windows_budget_history_and_mask(spark):
    prepare(spark)
    rng = random.Random(9)
    rows = []
    for conv in range(6):
        if conv % 2 == 0:
            rows.append((conv, 0, "system", f"rules {conv} " * (1 + 300 * (conv == 4))))
        for turn in range(1, 2 + 30 * conv):
            n = 4000 if turn == 17 else rng.randrange(0, 150)
            rows.append((conv, turn, "assistant" if turn % 2 == 0 else "user", " ".join(rng.choice(["yes", "</s>", "maybe"]) for _ in range(n))))
    rows += [(9, 0, "system", "only a system turn"), (None, 0, "user", None), (None, None, None, "x"), (8, 1, "user", "tie"),
             (8, 1, "user", "tie"), (8, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("cell", F.lit("x")) \
        .withColumn("window", F.lit(0))
    windows = chat.format_windows(df, RANKS, public_tokenizers.PATTERN)
    got = windows.collect()
    by = {}
    for r in sorted(got, key=lambda r: r["window"]):
        by.setdefault(r["conv_id"], []).append(r)
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
        new = []
        for i, w in enumerate(by[conv]):
            turns = chat.parse(w["formatted"])
            assert w["n_tokens"] <= chat.BUDGET or len(turns) - w["context_turns"] == 1 or own[0][0] == "system" == turns[0][0]
            if own[0][0] == "system":
                assert turns[0] == own[0]
            repeated = turns[1 if own[0][0] == "system" and i else 0:w["context_turns"]]
            assert not repeated or repeated == new[-len(repeated):]
            fresh = turns[w["context_turns"]:]
            learned = [chat.unescape(w["formatted"][s:s + n]) for s, n in zip(w["loss_start"], w["loss_size"])]
            assert learned == [t for role, t in fresh if role == "assistant"]
            new += fresh
        assert sorted(new) == sorted(own) and (conv in (None, 8) or new == own)
    assert any(r["context_turns"] > 1 for r in got) and any(r["over_budget"] for r in got)
    back = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(windows).collect()}
    assert all(back[c] == digests([(r[2], r[3]) for r in sorted(x for x in rows if x[0] == c)]) for c in range(6))
    assert chat.read_back(chat.format_windows(df.limit(0), RANKS, public_tokenizers.PATTERN)).count() == 0
    with pytest.raises(ValueError):
        chat.format_windows(df, RANKS, public_tokenizers.PATTERN, budget=100)


def test_windows_keep_their_budget(spark, library):  # noqa: F811
    """In tokens of the whole formatted window: with system turns of any
    length, control strings, long roles and equal turn numbers."""
    prepare(spark)
    rng = random.Random(12)
    words = ["yes", "</s>", "[INST]", "<\\\\s>", "maybe", "Donaudampfschiff", "12", "\n"]
    rows = []
    for conv, n in enumerate((0, 5, 100, 200, 300, 350, 500, 1100, 2500)):
        if n:
            rows.append((conv, 0, "system", " ".join(rng.choice(["rule", "</s>"]) for _ in range(n))))
        for turn in range(1, 60):
            size = rng.choice([0, 3, 30, 200]) if turn % 9 else 900
            role = "assistant" if turn % 2 == 0 else "user" if turn % 5 else "[INST] a long role </s>"
            rows.append((conv, turn // 2, role, " ".join(rng.choice(words) for _ in range(size))))
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    tokens = {}
    for budget, history in ((1024, 256), (600, 0), (512, 256)):
        got = chat.format_windows(df, RANKS, public_tokenizers.PATTERN, budget, history).collect()
        for r in got:
            used, turns = len(library.encode_ordinary(r["formatted"])), chat.parse(r["formatted"])
            assert used <= r["n_tokens"]
            alone = len(turns) - (1 if turns[0][0] == "system" else 0) <= 1
            assert r["over_budget"] == (r["n_tokens"] > budget) and (alone if r["over_budget"] else used <= budget)
        tokens[budget, history] = got
        back = {r["conv_id"]: r["n_turns"] for r in chat.read_back(df.sparkSession.createDataFrame(got)).collect()}
        assert back == {c: sum(r[0] == c for r in rows) for c in range(9)}
    # turns between the system turn's length and the budget share windows, and history is repeated where it fits
    wide = [r for r in tokens[1024, 256] if r["conv_id"] in (2, 3)]
    assert any(r["context_turns"] > 1 for r in wide) and any(len(chat.parse(r["formatted"])) > 3 for r in wide)


def test_piece_counts_do_not_reach_the_cost():
    """A state of as many pieces as the longest text has bytes."""
    costs = token_count.Costs({b"a": 0, b"b": 1})
    for piece, cost in token_count.unigram_costs({b"a": 0, b"b": 1}).items():
        cost_sum, pieces = divmod(costs.state[piece] * 2 ** 31, 1 << token_count.PIECE_BITS)
        assert (cost_sum, pieces) == (cost * 2 ** 31, 2 ** 31)


def test_url_lists_against_brute_force(spark):
    prepare(spark)
    rng = random.Random(6)
    day = lambda d: datetime(2020, 1 + d // 28, 1 + d % 28)
    hosts = ["a.example.org", "b.a.example.org", "example.org", "other.net", "localhost"]
    events = [(rng.choice(hosts + ["a.example.org/x/", "other.net/x/y/"]), rng.choice(["ads", "spam"]), rng.choice(["add", "remove", "ADD"]),
               day(rng.randrange(300))) for _ in range(80)]
    events += [("example.org", "ads", "keep", day(1)), (None, "ads", "add", day(1)), ("other.net", None, "add", day(1)),
               ("other.net", "ads", "add", None)] + events[:5]
    urls = ["https://a.example.org/x/p", "http://u:p@B.a.Example.org.:8080/q?x=/x/", "http://other.net/x/y/z#f", "https://other.net",
            "http://localhost/x", "no url", "", None, "http:///path", "https://b.a.example.org/x/"]
    caps = [(i, rng.choice(urls), day(rng.randrange(300)) if i % 9 else None) for i in range(200)] + [(7, urls[0], day(5))] * 2 \
        + [(None, urls[0], day(100))]
    ev = spark.createDataFrame(events, "pattern string, category string, action string, at timestamp")
    cf = spark.createDataFrame(caps, "page_id bigint, url string, fetched timestamp").withColumn("period", F.lit("x")).withColumn("n", F.lit(0))
    got = url_lists.filter_captures(cf, ev).collect()
    parts = {"https://a.example.org/x/p": ["a.example.org", "example.org", "a.example.org/", "a.example.org/x/"],
             urls[1]: ["b.a.example.org", "a.example.org", "example.org"], urls[2]: ["other.net", "other.net/x/", "other.net/x/y/"],
             urls[3]: ["other.net"], urls[4]: ["localhost"], urls[9]: ["b.a.example.org", "a.example.org", "example.org", "b.a.example.org/x/"]}
    def active(pattern, category, at):
        past = [(t, a.lower() == "remove") for p, c, a, t in events if p == pattern and c == category and t is not None and t <= at
                and a.lower() in ("add", "remove")]
        return bool(past) and not max(past)[1]
    def want(url, at):
        hits = [(p, c) for p in parts.get(url, []) for c in ("ads", "spam") if at is not None and active(p, c, at)]
        return len(hits), ",".join(sorted({c for _, c in hits})), bool(hits)
    key = lambda r: str(r)
    assert sorted([(r["page_id"], r["n_hits"], r["categories"], r["blocked"]) for r in got], key=key) == sorted(
        [(i, *want(u, t)) for i, u, t in caps], key=key)
    assert {r["host"] for r in got} == {"a.example.org", "b.a.example.org", "other.net", "localhost", None}
    assert url_lists.filter_captures(cf.limit(0), ev).count() == 0
    assert not any(r["blocked"] for r in url_lists.filter_captures(cf, ev.limit(0)).collect())


def test_url_lists_match_deep_entries_as_the_sql(spark):
    import duckdb
    prepare(spark)
    deep_path = "other.net/" + "".join(f"d{i}/" for i in range(20))
    deep_host = ".".join(f"l{i}" for i in range(20)) + ".example.org"
    day = datetime(2020, 1, 1)
    events = [(p, c, "add", day) for p, c in ((deep_path, "ads"), (deep_host, "spam"), ("other.net/d0/", "spam"),
                                              ("localhost", "ads"))]
    urls = ["http://" + deep_path + "x", "http://" + deep_path, "http://" + deep_path[:-4] + "x", "http://www." + deep_host + "/a/b",
            "http://" + deep_host, "http://l19.example.org/", "http://" + deep_path + "more/and/more", "http://x.localhost/"]
    con = duckdb.connect()
    con.execute("create table host(page_id bigint, url varchar, host varchar, path varchar, fetched timestamp)")
    con.execute("create table spans(pattern varchar, category varchar, since timestamp, until timestamp)")
    sql = queries.URL_SQL.replace(queries._listed_sql(), "one AS (SELECT 1)")
    for listed in (events, events[3:]):
        con.execute("delete from host"), con.execute("delete from spans")
        for i, u in enumerate(urls):
            h, _, path = u.removeprefix("http://").partition("/")
            con.execute("insert into host values (?, ?, ?, ?, ?)", [i, u, h, "/" + path if "/" in u[7:] else "", datetime(2020, 5, 1)])
        for p, c, _, at in listed:
            con.execute("insert into spans values (?, ?, ?, ?)", [p, c, at, datetime(9999, 12, 31)])
        want = {r[0]: r[3:] for r in con.execute(sql).fetchall()}
        got = url_lists.filter_captures(
            spark.createDataFrame([(i, u, datetime(2020, 5, 1)) for i, u in enumerate(urls)], "page_id bigint, url string, fetched timestamp"),
            spark.createDataFrame(listed, "pattern string, category string, action string, at timestamp")).collect()
        assert {r["page_id"]: (r["n_hits"], r["categories"], r["blocked"]) for r in got} == want
        if listed is events:
            assert [want[i][0] for i in range(8)] == [2, 2, 1, 1, 1, 0, 2, 0]


def test_pipeline_equals_its_stages_by_brute_force(spark, library):  # noqa: F811
    prepare(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality_mil.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    scorer = quality_mil.Scorer(model)
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {i for i, r in rows.items() if scorer([r["text"]])[0] >= quality_mil.THRESHOLD}
    fps = {i: simhash_brute(rows[i]["text"]) for i in good}
    label = components(good, [(a, b) for a in good for b in good if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    kept = docs.filter(F.col("doc_id").isin([i for i in good if label[i] == i]))
    picked = mixing.select_mix(kept, queries.mix_path(), queries.MIX_WEIGHTS, queries.MIX_PER_MILLE, queries.MIX_EPOCHS,
                               queries.MIX_SEED)
    want = []
    for r in picked.collect():
        ids = library.encode_ordinary(rows[r["doc_id"]]["text"])
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(rows[r["doc_id"]]["text"].encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(want) and len(want) > 100
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline_stages_take_odd_documents(spark):
    docs = odd_documents(spark).withColumn("extra", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        out.count()
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        if name != "encode":
            assert out.columns == corpus_pipeline.COLUMNS
