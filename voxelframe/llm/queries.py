"""The operators as queries over the driver's tables, with their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm import (
    align,
    bisector,
    bpe,
    chat,
    mih,
    mixing,
    projection,
    quality_mil,
    shard,
    simhash,
    speculate,
    token_count,
    url_lists,
)
from voxelframe.llm.common import prepare, staged
from voxelframe.tables import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
SHARDS = 16
CENTROIDS, CENTROID_DIMS, CENTROID_ROUNDS, CENTROID_SEED = 8, 64, 10, 3

# which domain a source belongs to, and the target weights among siblings
DOMAIN_SOURCES = {"web": range(0, 8), "news": range(8, 14), "books": range(14, 18)}
OTHER_DOMAIN = "code"
MIX_WEIGHTS = [
    {("web",): 5, ("news",): 3, ("books",): 2, (OTHER_DOMAIN,): 1},
    {("web", "en"): 4, ("web", "de"): 2, ("web", "fr"): 2, ("news", "en"): 3, ("books", "en"): 2},
    {("web", "en", "src0"): 2},
]
MIX_PER_MILLE = 900
MIX_EPOCHS = 2
MIX_SEED = 17

# categories of listed hosts whose name says so; other hosts are listed by chance
NAMED_CATEGORIES = {"casino": "gambling", "bets": "gambling", "adult": "adult", "pills": "spam", "spam": "spam",
                    "ads": "ads"}
CHANCE_CATEGORIES = ["ads", "adult", "gambling", "malware"]


def domain_of(source) -> F.Column:
    out = F.lit(OTHER_DOMAIN)
    for name, numbers in DOMAIN_SOURCES.items():
        out = F.when(source.isin([f"src{i}" for i in numbers]), F.lit(name)).otherwise(out)
    return out


def mix_path() -> dict:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels"))
    return quality_mil.score(docs, model)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mih.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                             public_tokenizers.PATTERN)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    placed = shard.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("bigint"), F.col("id"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(marks))
    windows = chat.format_windows(said.unionAll(extra), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return chat.read_back(windows)


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time between 2018 and 2023, which follows from the id."""
    day = F.pmod(F.col("page_id") * 7919, F.lit(2000)).cast("int")
    second = F.pmod(F.col("page_id") * 104729, F.lit(86400))
    return pages.select("page_id", "url", F.timestamp_seconds(
        F.lit(1514764800) + day.cast("bigint") * 86400 + second).alias("fetched"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list entries about the hosts and host/language folders of the
    pages: which are listed, as what and when, follows from their names and
    MD5 digits.  The tables hold no list of their own."""
    host = url_lists.url_host(F.col("url"))
    folder = F.regexp_extract(url_lists.url_path(F.col("url")), "^(/[a-z]+/)", 1)
    names = pages.select(F.explode(F.array(host, F.regexp_replace(host, "^(www|m|blog)[.]", ""),
                                           F.concat(host, folder))).alias("pattern")).filter("pattern <> ''").distinct()

    def digits(at):
        return F.conv(F.substring(F.md5(F.col("pattern").cast("binary")), at, 4), 16, 10).cast("int")
    named = F.lit(None).cast("string")
    for word, category in NAMED_CATEGORIES.items():
        named = F.when(F.col("pattern").contains(word), F.lit(category)).otherwise(named)
    chance = F.element_at(F.array(*[F.lit(c) for c in CHANCE_CATEGORIES]), F.pmod(digits(5), F.lit(4)) + 1)
    listed = names.withColumn("category", F.coalesce(named, F.when(F.pmod(digits(1), F.lit(6)) == 0, chance))).filter(
        "category is not null")
    start, length, pause = F.pmod(digits(9), F.lit(1500)), F.pmod(digits(13), F.lit(700)), F.pmod(digits(17), F.lit(300))
    steps = F.array(F.struct(F.lit("add").alias("action"), start.alias("day")),
                    F.struct(F.lit("remove").alias("action"), (start + length).alias("day")),
                    F.struct(F.lit("add").alias("action"), (start + length + pause).alias("day")))
    return listed.select("pattern", "category", F.explode(steps).alias("step")).select(
        "pattern", "category", "step.action", F.timestamp_seconds(
            F.lit(1514764800) + F.col("step.day").cast("bigint") * 86400).alias("at"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.filter_captures(captures(pages), staged(list_events(pages), "list-events"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.select_mix(table(spark, sf_dir, "documents"), mix_path(), MIX_WEIGHTS, MIX_PER_MILLE, MIX_EPOCHS,
                             MIX_SEED)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return projection.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                                    public_tokenizers.PATTERN)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return align.align(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES),
                       public_tokenizers.PATTERN)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bisector.cluster_report(table(spark, sf_dir, "embeddings"), CENTROIDS, CENTROID_DIMS, CENTROID_ROUNDS,
                                   CENTROID_SEED)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return speculate.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                   public_tokenizers.PATTERN)


# ---- oracle SQL

_MASK = 2 ** 64

SHARD_SQL = f"""
WITH RECURSIVE crc(i, v, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
base AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, encode(coalesce(text, '')) AS b FROM documents),
hashed AS (
  SELECT doc_id, size, xor(list_reduce(
      list_transform(range(0, size - 1), lambda p: ('0x' || substr(hex(b), 2 * p + 1, 2))::BIGINT),
      lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM base, crc_table),
m1 AS (SELECT *, ((CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + {_MASK} ELSE doc_id::HUGEINT END
                   + {shard.MIX[0]}) % {_MASK})::UBIGINT AS x FROM hashed),
m2 AS (SELECT * EXCLUDE (x), ((xor(x, x >> 30)::UHUGEINT * {shard.MIX[1]}) % {_MASK})::UBIGINT AS x FROM m1),
m3 AS (SELECT * EXCLUDE (x), ((xor(x, x >> 27)::UHUGEINT * {shard.MIX[2]}) % {_MASK})::UBIGINT AS x FROM m2),
keys AS (SELECT row_number() OVER () AS r, doc_id, size, text_crc32, xor(x, x >> 31) AS key FROM m3),
walk(r, n, key, b, j) AS (
  SELECT r, n, key, -1::BIGINT, 0::BIGINT FROM keys, (VALUES ({SHARDS}), ({SHARDS + 1})) s(n)
  UNION ALL
  SELECT r, n, k2, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT r, n, j, ((key::UHUGEINT * {shard.JUMP} + 1) % {_MASK})::UBIGINT AS k2 FROM walk WHERE j < n)),
ends AS (SELECT r, n, max(b) AS shard FROM walk WHERE j >= n GROUP BY r, n)
SELECT doc_id, size, text_crc32, 'key' AS law, a.shard::INT AS shard,
  row_number() OVER (PARTITION BY a.shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, g.shard::INT AS grown_shard
FROM keys JOIN ends a ON a.r = keys.r AND a.n = {SHARDS} JOIN ends g ON g.r = keys.r AND g.n = {SHARDS + 1}
"""


def _listed_sql() -> str:
    named = " ".join(f"WHEN contains(pattern, '{w}') THEN '{c}'" for w, c in reversed(NAMED_CATEGORIES.items()))
    names = ", ".join(f"'{c}'" for c in CHANCE_CATEGORIES)

    def digits(at):
        return f"('0x' || substr(md5(pattern), {at}, 4))::INT"
    return f"""
host AS (SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
    make_timestamp((1514764800 + (page_id * 7919 % 2000) * 86400 + page_id * 104729 % 86400) * 1000000) AS fetched FROM pages),
names AS (SELECT DISTINCT unnest([host, regexp_replace(host, '^(www|m|blog)[.]', ''),
    host || regexp_extract(path, '^(/[a-z]+/)', 1)]) AS pattern FROM host),
listed AS (SELECT pattern, {digits(9)} % 1500 AS d, {digits(13)} % 700 AS l, {digits(17)} % 300 AS p,
    CASE {named} WHEN {digits(1)} % 6 = 0 THEN [{names}][{digits(5)} % 4 + 1] END AS category
  FROM names WHERE pattern <> ''),
spans AS (
  SELECT pattern, category, TIMESTAMP '2018-01-01' + to_days(d) AS since,
    TIMESTAMP '2018-01-01' + to_days(d + l) AS until FROM listed WHERE category IS NOT NULL AND l > 0
  UNION ALL
  SELECT pattern, category, TIMESTAMP '2018-01-01' + to_days(d + l + p), TIMESTAMP '9999-12-31'
  FROM listed WHERE category IS NOT NULL AND p > 0)"""


URL_SQL = f"""
WITH {_listed_sql()},
keyed AS (SELECT page_id, fetched, host, unnest(list_distinct(list_concat(
    [array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, greatest(2, len(string_split(host, '.'))))],
    [host || array_to_string(string_split(CASE WHEN path = '' THEN '/' ELSE path END, '/')[1:i], '/') || '/'
     FOR i IN range(1, greatest(2, len(string_split(CASE WHEN path = '' THEN '/' ELSE path END, '/'))))]))) AS pattern
  FROM host),
hits AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT category, ',' ORDER BY category) AS cats
  FROM keyed JOIN spans USING (pattern) WHERE since <= fetched AND fetched < until GROUP BY page_id)
SELECT page_id, fetched, host, coalesce(n, 0)::BIGINT AS n_hits, coalesce(cats, '') AS categories,
  coalesce(n, 0) > 0 AS blocked FROM host LEFT JOIN hits USING (page_id)
"""


def _mix_sql() -> str:
    domain = " ".join(f"WHEN source IN ({', '.join(f"'src{i}'" for i in r)}) THEN '{d}'" for d, r in DOMAIN_SOURCES.items())

    def weight(level):
        cases = "".join(" WHEN " + " AND ".join(f"{c} = '{n}'" for c, n in zip(mixing.LEVELS, key)) + f" THEN {w}"
                        for key, w in MIX_WEIGHTS[level].items())
        return f"CASE{cases} ELSE {mixing.OTHER_WEIGHT} END"
    out = [f"""
WITH rows AS (SELECT doc_id, CASE {domain} ELSE '{OTHER_DOMAIN}' END AS domain, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM rows GROUP BY ALL),
n0 AS (SELECT 0 AS root, least(sum(tokens) * {MIX_PER_MILLE} // 1000, sum(tokens) * {MIX_EPOCHS})::HUGEINT AS given FROM leaves)"""]
    for d, level in enumerate(mixing.LEVELS):
        path = ", ".join(mixing.LEVELS[:d + 1])
        parent = ", ".join(["root", *mixing.LEVELS[:d]])
        by = f"PARTITION BY {parent}"
        line = f"{by} ORDER BY ratio, {level}"
        out.append(f"""
c{d} AS (SELECT *, supply::DOUBLE / weight AS ratio FROM (
    SELECT 0 AS root, {path}, sum(tokens)::HUGEINT * {MIX_EPOCHS} AS supply, ({weight(d)})::HUGEINT AS weight
    FROM leaves GROUP BY {path}) JOIN n{d} USING ({parent})),
f{d} AS (SELECT *, supply * (sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({line} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    <= (given - coalesce(sum(supply) OVER ({line} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS fits FROM c{d}),
s{d} AS (SELECT *, CASE WHEN fits THEN supply ELSE ((given - coalesce(sum(supply) FILTER (fits) OVER ({by}), 0)) * weight)
    // (sum(weight) FILTER (NOT fits) OVER ({by})) END AS share FROM f{d}),
n{d + 1} AS (SELECT root, {path}, share + CASE WHEN NOT fits AND
    count(*) FILTER (NOT fits) OVER ({line} ROWS UNBOUNDED PRECEDING) <= given - sum(share) OVER ({by}) THEN 1 ELSE 0 END AS given
    FROM s{d})""")
    out.append(f"""
plan AS (SELECT l.*, CASE WHEN tokens = 0 THEN 1 ELSE given // tokens END AS whole,
    CASE WHEN tokens = 0 THEN 0 ELSE given % tokens END AS part FROM leaves l JOIN n3 USING (domain, lang, source)),
keyed AS (SELECT r.*, epoch, whole, part, md5('{MIX_SEED}:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS key
    FROM rows r JOIN plan USING (domain, lang, source), range({MIX_EPOCHS}) e(epoch)),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY key) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, epoch::INT AS epoch, upto::BIGINT AS upto FROM placed
WHERE epoch < whole OR (part > 0 AND epoch = whole AND upto <= part)""")
    return ",".join(out)


VECTOR_SQL = """
WITH RECURSIVE sound AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    AND list_bool_or([x <> 0 FOR x IN embedding])),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  (SELECT min(b) FROM reach r WHERE r.a = e.vec_id) AS component_id,
  e.vec_id = (SELECT min(b) FROM reach r WHERE r.a = e.vec_id) AS kept FROM embeddings e
"""



def _centroid_sql() -> str:
    k, dims = CENTROIDS, CENTROID_DIMS

    def nearest(r):
        # distance and number in one value, so that ties go to the smaller number
        return f"""
a{r} AS MATERIALIZED (SELECT rid, vec_id, v, (best % {k})::INT AS c, best // {k} AS d FROM (
    SELECT rid, any_value(s.vec_id) AS vec_id, any_value(s.v) AS v, min({k} * list_sum(
      [(x - c.v[i]) * (x - c.v[i]) FOR x, i IN s.v])::HUGEINT + c.c) AS best FROM sound s, c{r} c GROUP BY rid))"""
    out = [f"""
WITH sound AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
    [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dims} AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{CENTROID_SEED}:' || vec_id), v) - 1 AS c, v FROM (
    SELECT * FROM sound ORDER BY sha256('{CENTROID_SEED}:' || vec_id), v LIMIT {k}))"""]
    for r in range(CENTROID_ROUNDS):
        out.append(nearest(r) + f""",
m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
    SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {dims + 1}) p(i) GROUP BY c, i) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN m{r} m USING (c))""")
    last = CENTROID_ROUNDS
    out.append(nearest(last) + f"""
SELECT vec_id, a.c AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON a.c = c.c""")
    return ",".join(out)


QUERIES = {
    "op1_attention_quality": op1,
    "op2_multi_index_hashing": op2,
    "op3_simhash_pivots": op3,
    "op4_merge_replay_bpe": op4,
    "op5_jump_sharding": op5,
    "op6_chat_windows": op6,
    "op7_url_list_asof": op7,
    "op8_hierarchical_mix": op8,
    "op9_projection_dedup": op9,
    "op10_trie_token_counts": op10,
    "op11_fragment_alignment": op11,
    "op12_bisector_clusters": op12,
    "op13_speculative_bpe": op13,
}


def queries() -> dict:
    import corpus_pipeline
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline
    out = {"op5_jump_sharding": SHARD_SQL, "op7_url_list_asof": URL_SQL, "op8_hierarchical_mix": _mix_sql(),
           "op9_projection_dedup": VECTOR_SQL, "op12_bisector_clusters": _centroid_sql()}
    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
