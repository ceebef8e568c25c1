"""The queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relfeat.llm.byte_bpe import encode_and_decode
from relfeat.llm.common import stored
from relfeat.llm.decontaminate import decontaminate
from relfeat.llm.exact_dedup import exact_dedup
from relfeat.llm.html_text import main_text
from relfeat.llm.near_dedup import near_dedup
from relfeat.llm.periodic_runs import periodic_runs
from relfeat.llm.prefix_trie import trie_of_keys, turn_keys
from relfeat.llm.sharding import kd_shards
from relfeat.llm.token_ids import token_id_round_trip
from relfeat.llm.toxicity import toxicity
from relfeat.llm.trie_bpe import trie_encode
from relfeat.llm.url_filter import url_filter
from relfeat.llm.warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# fixed values: (verdict, host/path)
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def query(name: str, sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_token_ids")
def op1_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_id_round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query(
    "op2_decontamination",
    r"""
    WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
    item_words AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
        WHERE item_id IS NOT NULL AND text IS NOT NULL),
    win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS v
        FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item_words WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM win),
    spots AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS v
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
    found AS (SELECT doc_id, item_id, i, n FROM spots JOIN win USING (n, v)),
    hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found)
        GROUP BY 1),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_key")


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_and_decode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query(
    "op4_warc",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS holder FROM d)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN holder END AS refers_to FROM g
    """,
)
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc_round_trip(table(spark, folder, "pages"), min_bytes=1000)


@query("op5_sharding")
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return kd_shards(table(spark, folder, "documents"), shards=8)


def level_sql(level: str, keys: str, above: str) -> str:
    """Nodes of one level of the reputation tree with posterior and variance, and the prior weight fitted on them, for the
    checking engine."""
    return f"""{level}_n AS (SELECT c.*, p, above FROM (SELECT {keys}, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k FROM hosts
        GROUP BY ALL) c {above}),
      {level}_w AS (SELECT CASE WHEN n IS NULL OR s IS NULL OR n - nn / n - (m - 1) <= 0 OR s - (m - 1) <= 0 THEN 10000.0
        ELSE least(greatest((n - nn / n - (m - 1)) / (s - (m - 1)) - 1, 1.0), 10000.0) END AS w
        FROM (SELECT sum(n * pow(k / n - p, 2) / nullif(p * (1 - p), 0)) AS s, count(*) AS m, sum(n)::DOUBLE AS n,
              sum(n * n)::DOUBLE AS nn FROM {level}_n)),
      {level}_p AS (SELECT *, a / (a + b) AS mean, a * b / (pow(a + b, 2) * (a + b + 1)) AS own,
          a * b / (pow(a + b, 2) * (a + b + 1)) + pow(w / (n + w), 2) * above AS v
        FROM (SELECT *, p * w + k AS a, (1 - p) * w + n - k AS b FROM {level}_n, {level}_w))"""


PARTS = """CASE WHEN len(parts) > 1 THEN parts[-2] || '.' || parts[-1] ELSE host END AS domain, parts[-1] AS suffix"""

# a host without labels has the posterior of its domain, else of its suffix, else the rate of all labelled pages, and a
# variance that counts the spread of each level without labels
OP6_SQL = f"""
WITH parsed AS (SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
  hosts AS (SELECT host, n, k, {PARTS} FROM (SELECT host, count(*) AS n, sum(CAST(toxic = 1 OR quality = 0 AS INT)) AS k,
    string_split(host, '.') AS parts FROM parsed JOIN labels ON page_id = doc_id
    WHERE (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY host)),
  total AS (SELECT sum(k) / sum(n) AS m0, (sum(k) + 1) * (sum(n) - sum(k) + 1) / (pow(sum(n) + 2, 2) * (sum(n) + 3)) AS v0 FROM hosts),
  {level_sql("suffix", "suffix", "CROSS JOIN (SELECT m0 AS p, v0 AS above FROM total)")},
  {level_sql("domain", "domain, suffix", "JOIN (SELECT suffix, mean AS p, v AS above FROM suffix_p) USING (suffix)")},
  {level_sql("host", "host, domain, suffix", "JOIN (SELECT domain, suffix, mean AS p, v AS above FROM domain_p) USING (domain, suffix)")},
  every AS (SELECT host, {PARTS} FROM (SELECT DISTINCT host, string_split(host, '.') AS parts FROM parsed)),
  by_suffix AS (SELECT every.*, coalesce(mean, m0) AS m1, coalesce(v, m0 * (1 - m0) / (suffix_w.w + 1) + v0) AS v1
    FROM every CROSS JOIN total CROSS JOIN suffix_w LEFT JOIN suffix_p USING (suffix)),
  by_domain AS (SELECT d.*, coalesce(mean, m1) AS m2, coalesce(v, m1 * (1 - m1) / (domain_w.w + 1) + v1) AS v2
    FROM by_suffix d CROSS JOIN domain_w LEFT JOIN domain_p USING (domain, suffix)),
  rated AS (SELECT d.host, coalesce(mean, m2) AS mean, sqrt(coalesce(own, m2 * (1 - m2) / (host_w.w + 1) + v2)) AS sd
    FROM by_domain d CROSS JOIN host_w LEFT JOIN host_p USING (host)),
  ruled AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM parsed)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN coalesce(mean - 1.645 * sd > 0.3, false) THEN 'block' ELSE 'allow' END AS verdict,
  round(mean, 6) AS bad_rate
FROM ruled LEFT JOIN rated USING (host)
"""


@query("op6_url_filters", OP6_SQL)
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """A page is bad when its label says toxic or low quality; labels carry the id of the page."""
    labels = table(spark, folder, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.expr("CAST(toxic = 1 OR quality = 0 AS INT)").alias("bad"))
    judged = url_filter(table(spark, folder, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bad_rate", 6).alias("bad_rate"))


@query("op7_minhash_near_dedup")
def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(table(spark, folder, "documents"), words_each=3, similar=(85, 100)).drop("text_key")


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), threshold=0.3).drop("text_key")


@query(
    "op10_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(encode(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'))) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup(table(spark, folder, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: with h = crc32(decimal doc_id) divisible by 10, each word i >= a becomes word a + (i - a) % p, where
    g = h // 10, a = g % n, p = 1 + (n - a) // (3 + g % 8); the words of such a text are joined by one space."""
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = chosen.withColumn("h", F.crc32(F.col("doc_id").cast("string"))).withColumn("g", F.expr("h DIV 10"))
    chosen = chosen.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    chosen = chosen.withColumn("a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
    chosen = chosen.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    moved = F.expr("array_join(transform(sequence(0, n - 1), i -> w[IF(i < a, i, a + (i - a) % p)]), ' ')")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), moved).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(planted(table(spark, folder, "documents")), with_runs=False).drop("text_key")


@query("op12_trie_bpe")
def op12_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return trie_encode(table(spark, folder, "documents"), path, with_ids=False).drop("text_key")


def rebuilt(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversation c as the first h turns of conversation c - c % 5 and its own turns after its first h, where
    h = crc32(decimal c) % 9; and the ids of all conversations."""
    place = "row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, turn_key) - 1 AS at"
    own = stored(keys.selectExpr("conv_id", "turn_key", "bytes", place), "numbered-turns")
    h = "crc32(CAST(conv_id AS STRING)) % 9"
    ids = stored(own.select("conv_id").distinct(), "conversations")
    heads = own.where("at < 8").withColumnRenamed("conv_id", "base")
    taken = ids.selectExpr("conv_id", "conv_id - conv_id % 5 AS base", f"{h} AS h").join(heads, "base").where("at < h")
    turns = taken.select("conv_id", "at", "turn_key", "bytes").unionByName(own.where(f"at >= {h}"))
    return turns.withColumnRenamed("at", "turn"), ids


@query(
    "op13_prefix_trie",
    """
    WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS pos
        FROM (SELECT conv_id, turn, strlen(text) AS b, md5(concat(strlen(role), ':', role, text)) AS k
          FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            WHERE conv_id IS NOT NULL))),
    crc AS (SELECT conv_id, xor(list_reduce(flatten([[4294967295::BIGINT],
        flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))]),
        lambda a, x: CASE WHEN x < 256 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) AS h
        FROM (SELECT DISTINCT conv_id FROM t)),
    ids AS (SELECT conv_id, conv_id - conv_id % 5 AS base, h % 9 AS h FROM crc),
    r AS (SELECT i.conv_id, pos, k, b FROM ids i JOIN t ON t.conv_id = base AND pos < h
        UNION ALL SELECT conv_id, pos, k, b FROM t JOIN ids USING (conv_id) WHERE pos >= h),
    p AS (SELECT conv_id, row_number() OVER w AS depth, b, string_agg(k, '') OVER w AS path FROM r
        WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
    a AS (SELECT conv_id, 0 AS depth, 0 AS b, '' AS path FROM ids UNION ALL SELECT conv_id, depth, b, path FROM p),
    n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(b) AS b FROM a GROUP BY path, depth),
    kids AS (SELECT left(path, (depth - 1) * 32) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (path)),
    sub AS (SELECT left(path, j * 32) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * b) AS saved
        FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM f) GROUP BY 1),
    ends AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS names
        FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM a) WHERE depth = last GROUP BY 1)
    SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
        CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(names, '')) AS ends_sha256
    FROM f JOIN sub USING (path) LEFT JOIN ends USING (path)
    LEFT JOIN n u ON f.depth > 0 AND u.path = left(f.path, (f.depth - 1) * 32) AND u.depth = f.depth - 1
    """,
)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie_of_keys(*rebuilt(turn_keys(table(spark, folder, "conversations")))).drop("path")
