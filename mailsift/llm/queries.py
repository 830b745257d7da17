"""Each operator of this subpackage as a query on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.llm import (
    ann,
    bpe,
    divergence,
    embedding_dedup,
    html_extract,
    merkle,
    minhash,
    mixing,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from mailsift.llm.common import table, text_bytes


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(sql: str | None = None):
    def add(run):
        CATALOG[run.__name__] = Entry(run, sql)
        return run

    return add


@query()
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.Repeats(table(spark, folder, "documents").select("doc_id", "text")).result()
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


# The shards take turns in a recursion of one step per slot.
@query(
    f"""
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS shard FROM range({len(sharding.SHARDS)}) t(i)),
prefs AS (
  SELECT list((('0x' || substr(md5(shard), 1, 15))::BIGINT % {sharding.TABLE_SIZE}) ORDER BY i) AS offs,
         list((('0x' || substr(md5(shard), 16, 15))::BIGINT % {sharding.TABLE_SIZE - 1} + 1) ORDER BY i) AS skip
  FROM shards),
fill(turn, slot, claimed) AS (
  SELECT 0, offs[1], [offs[1]] FROM prefs
  UNION ALL
  SELECT turn + 1, s, list_append(claimed, s) FROM (
    SELECT turn, claimed,
           (SELECT (p.offs[1 + (turn + 1) % {len(sharding.SHARDS)}]
                    + j * p.skip[1 + (turn + 1) % {len(sharding.SHARDS)}]) % {sharding.TABLE_SIZE}
            FROM prefs p, range({sharding.TABLE_SIZE}) r(j)
            WHERE NOT list_contains(claimed, (p.offs[1 + (turn + 1) % {len(sharding.SHARDS)}]
                    + j * p.skip[1 + (turn + 1) % {len(sharding.SHARDS)}]) % {sharding.TABLE_SIZE})
            ORDER BY j LIMIT 1) AS s
    FROM fill WHERE turn + 1 < {sharding.TABLE_SIZE}))
SELECT doc_id, f.slot::INTEGER AS slot, shard
FROM documents d
JOIN fill f ON f.slot = ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.TABLE_SIZE}
JOIN shards s ON s.i = f.turn % {len(sharding.SHARDS)}
"""
)
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents").select("doc_id"))


@query(
    r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
r AS (
  SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS parts,
         coalesce(sum(source_size) OVER lower, 0) AS less_words, coalesce(sum(weight) OVER lower, 0) AS less_parts
  FROM w
  WINDOW lower AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (words - 3 * less_words) * weight > 3 * source_size * (parts - less_parts) AS capped FROM r),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN (3 * source_size)::DOUBLE
              ELSE ((max(words) OVER () - 3 * coalesce(sum(source_size) FILTER (capped) OVER (), 0)) * weight)::DOUBLE
                   / (max(parts) OVER () - coalesce(sum(weight) FILTER (capped) OVER (), 0))::DOUBLE END AS target
  FROM c),
k AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
p AS (
  SELECT d.doc_id, d.size, k.source_size, k.target, k.whole, k.target - k.whole * k.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, h) AS here
  FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest OR (upto - here < rest AND upto - rest < rest - (upto - here))
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
)
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


@query()
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op3_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.Index(table(spark, folder, "embeddings")).search(F.col("id") % 100 == 0)


@query(
    r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(rule, site, prefix, said) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
  FROM parts JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix)
  GROUP BY page_id)
SELECT p.page_id, host, path, rule,
       coalesce(said, CASE WHEN regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.')
                           THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best USING (page_id)
"""
)
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_extract.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


# crc32 of the decimal id, bit by bit; a level of the tree is one step of a recursion.
@query(
    r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text, row_number() OVER () AS rid,
         list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc
  FROM documents),
h AS (
  SELECT rid, doc_id, source,
         coalesce(strlen(source) || ':' || source, '-') AS tree,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS whole,
         CASE WHEN crc % 2 = 1 THEN coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')
              ELSE coalesce(strlen(text) || ':' || text, '-') END AS cut
  FROM d),
leaves AS (
  SELECT rid, doc_id, source, tree, sha256(head || whole) AS leaf, sha256(head || cut) AS now,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, sha256(head || whole), rid) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM h),
up(level, tree, n, pos, hash) AS (
  SELECT 0, tree, n, pos, leaf FROM leaves
  UNION ALL
  SELECT level + 1, tree, (n + 2) // 3, pos // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY level, tree, n, pos // 3),
subs AS (SELECT tree, level AS height, hash AS subroot FROM up WHERE n = 1),
tops AS (
  SELECT s.tree, s.height, s.subroot, count(*) OVER () AS n,
         row_number() OVER (ORDER BY g.source NULLS FIRST) - 1 AS pos
  FROM subs s JOIN (SELECT DISTINCT tree, source FROM leaves) g USING (tree)),
above(level, n, pos, hash) AS (
  SELECT 0, n, pos, subroot FROM tops
  UNION ALL
  SELECT level + 1, (n + 2) // 3, pos // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM above WHERE n > 1 GROUP BY level, n, pos // 3),
root AS (SELECT hash AS root, level AS height FROM above WHERE n = 1),
nodes AS (
  SELECT tree, level, pos, hash FROM up
  UNION ALL
  SELECT NULL, level, pos, hash FROM above),
way AS (
  SELECT l.rid, l.now, t.subroot, t.height, t.height + r.height AS steps, r.root, l.tree, l.pos, t.pos AS top
  FROM leaves l JOIN tops t USING (tree) CROSS JOIN root r),
trace(rid, step, tree, pos, top, height, steps, node, proof) AS (
  SELECT rid, 0, CASE WHEN height = 0 THEN NULL ELSE tree END, CASE WHEN height = 0 THEN top ELSE pos END, top, height, steps, now, ''
  FROM way
  UNION ALL
  SELECT w.rid, w.step + 1, any_value(CASE WHEN w.step + 1 >= w.height THEN NULL ELSE w.tree END),
         any_value(CASE WHEN w.step + 1 = w.height THEN w.top ELSE w.pos // 3 END), any_value(w.top), any_value(w.height), any_value(w.steps),
         sha256(string_agg(CASE WHEN s.pos = w.pos THEN w.node ELSE s.hash END, '' ORDER BY s.pos)),
         any_value(w.proof) || coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos <> w.pos), '')
  FROM trace w JOIN nodes s ON s.tree IS NOT DISTINCT FROM w.tree AND s.pos // 3 = w.pos // 3
       AND s.level = CASE WHEN w.step < w.height THEN w.step ELSE w.step - w.height END
  WHERE w.step < w.steps GROUP BY w.rid, w.step)
SELECT l.doc_id, l.leaf, y.subroot, y.root, sha256(t.proof) AS proof_sha256, t.node AS folded_root, t.node = y.root AS verified
FROM leaves l JOIN way y USING (rid) JOIN trace t ON t.rid = l.rid AND t.step = t.steps
"""
)
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(touched, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    now = merkle.leaf([*[F.col(c) for c in merkle.FIELDS[:-1]], text])
    manifest = merkle.Manifest(docs, carry={"now": now})
    return manifest.verify(manifest.proofs(), "now").select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"), "folded_root", "verified",
    )


LIMIT = 4096  # tokens


@query()
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("n_bytes", F.octet_length(text_bytes("text")).cast("long"))
    counted = token_counts.prefix_counts(docs, keep=["doc_id", "n_bytes"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


@query(
    r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
t AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM dense JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
)
def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    audit = divergence.Audit(table(spark, folder, "documents"))
    pairs = audit.pairs().select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank")
    terms = audit.telling().select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
