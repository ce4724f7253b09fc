"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.bpe_prefix import encode_digests
from tallyfold.llm import pii_crf, quality_pu
from tallyfold.llm.common import held_out, read
from tallyfold.llm.decontaminate import contaminated
from tallyfold.llm.debruijn import remove_repeats
from tallyfold.llm.exact_radix import exact_groups
from tallyfold.llm.fair_mix import fair_queue
from tallyfold.llm.merkle import lowered, merkle_manifest
from tallyfold.llm.shingle_join import jaccard_components
from tallyfold.llm.simplex_kmeans import cluster_vectors
from tallyfold.llm.suffix_dedup import remove_repeated_bytes
from tallyfold.llm.toxic_gru import score, train
from tallyfold.llm.url_rules import PATTERN_RULES, SITE_RULES, judge_urls, site_pattern

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@query("op6_radix_exact_dedup", r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n_points, doc_id)) AS keep_id FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256 FROM t JOIN g USING (text_sha256)
""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(read(spark, folder, "documents")).drop("n_points")


def _url_sql() -> str:
    site = sorted(SITE_RULES, key=lambda r: -len(r[1]))

    def fits(pattern: str) -> str:
        return "regexp_matches(host || path, '" + pattern.replace(r"\A", "^") + "')"

    rule = " ".join(f"WHEN {fits(site_pattern(r))} THEN '{r}'" for _, r in site)
    verdict = " ".join(f"WHEN rule = '{r}' THEN '{a}'" for a, r in site)
    pattern = " ".join(f"WHEN {fits(p)} THEN '{p}'" for a, p, _ in PATTERN_RULES if a == "block")
    return rf"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
v AS (SELECT *, CASE {rule} END AS rule, CASE {pattern} END AS pattern FROM u)
SELECT page_id, host, path, rule, CASE {verdict} WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern FROM v
"""


@query("op8_rarest_token_url_rules", _url_sql())
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(read(spark, folder, "pages")).drop("n_tested")


@query("op7_prefix_dp_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return encode_digests(read(spark, folder, "documents"), tokenizer_path())


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def toxicity(spark: SparkSession, folder: str):
    """The network trained on the labels that may be learnt from."""
    labels = read(spark, folder, "labels").filter(~held_out(F.col("doc_id"), 3, 1)).select("doc_id", F.col("toxic").alias("label"))
    return train(read(spark, folder, "documents"), labels)


@query("op5_bigru_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    scored = score(read(spark, folder, "documents"), toxicity(spark, folder))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op10_grouped_prefix_jaccard")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(read(spark, folder, "documents"))


@query("op2_debruijn_substring_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read(spark, folder, "documents"))


@query("op9_suffix_array_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_bytes(read(spark, folder, "documents"))


@query("op1_minhash_decontamination", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
s AS (SELECT item_id, least(5, len(w)) AS k, unnest(list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2),
             lambda j: array_to_string(w[j : j + least(5, len(w)) - 1], ' ')))) AS g FROM i WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n FROM s GROUP BY item_id),
h AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda j: array_to_string(w[j : j + 4], ' ')))) AS g FROM d WHERE len(w) >= 5)
SELECT doc_id, item_id, any_value(n.n)::INT AS n_item_shingles, count(*)::INT AS n_shared
FROM h JOIN s USING (g) JOIN n USING (item_id) WHERE k = 5 GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n.n)
""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op3_pu_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs, held = read(spark, folder, "documents"), held_out(F.col("doc_id"), 4, 2)
    trusted = read(spark, folder, "labels").filter((F.col("quality") == 1) & ~held)
    model, _ = quality_pu.train(docs, trusted, docs.filter(~held))
    return quality_pu.score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op4_crf_personal_data")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return pii_crf.detect(docs, pii_crf.train(docs))


@query("op11_fair_queue_mix", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
q AS (SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING))::BIGINT AS done FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM d GROUP BY source),
w AS (SELECT *, (nth - 1) % 3 + 1 AS weight, 3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS budget FROM s),
r AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight RANGE UNBOUNDED PRECEDING EXCLUDE TIES) - cap, 0))::BIGINT AS rest,
             (sum(weight) OVER (ORDER BY cap / weight DESC RANGE UNBOUNDED PRECEDING))::BIGINT AS free FROM w),
l AS (SELECT max(rest::DOUBLE / free) AS level FROM r WHERE rest::DOUBLE / free <= cap / weight),
t AS (SELECT w.*, least(weight * level, cap::DOUBLE) AS target FROM w, l),
e AS (SELECT t.source, nth, size, turn * source_size + done AS position, (turn * source_size + done) / target AS finish
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0 AND target > 0),
c AS (SELECT source, max(position) AS reached
      FROM (SELECT *, sum(size) OVER (ORDER BY finish, nth, position ROWS UNBOUNDED PRECEDING) AS spent FROM e)
      WHERE spent <= (SELECT any_value(budget) FROM w) GROUP BY source)
SELECT doc_id, size, t.source_size, target,
       size * ((done <= coalesce(reached, 0))::BIGINT + (done + source_size <= coalesce(reached, 0))::BIGINT
               + (done + 2 * source_size <= coalesce(reached, 0))::BIGINT) AS taken
FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source LEFT JOIN c ON c.source IS NOT DISTINCT FROM t.source
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return fair_queue(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _leaf_sql(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


@query("op12_midstate_merkle_manifest", rf"""
WITH RECURSIVE d AS (SELECT *, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ascii(c)::BIGINT) AS digits FROM documents),
c AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], digits), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc FROM d),
leaf AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, CASE WHEN crc % 5 = 0 THEN
                {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf_sql("text")} END AS found FROM c),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaf),
node AS (SELECT source, 0 AS level, pos, leaf AS digest, n FROM ranked
         UNION ALL SELECT source, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
         FROM node WHERE n > 1 GROUP BY source, level, pos // 16),
sub AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (SELECT 0 AS level, pos, digest, n FROM sub
        UNION ALL SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16 FROM top WHERE n > 1 GROUP BY level, pos // 16),
-- one forest: levels of the sources first, those of the top from 100 on, under one key
forest AS (SELECT coalesce('s' || source, 'null') AS tree, level, pos, digest, n FROM node
           UNION ALL SELECT 'top', 100 + level, pos, digest, n FROM top),
walk AS (SELECT id, coalesce('s' || source, 'null') AS tree, 0 AS level, pos, found AS folded, '' AS seen, n FROM ranked
         UNION ALL
         SELECT * FROM (
           SELECT w.id, any_value(w.tree), any_value(w.level) + 1, any_value(w.pos) // 16,
                  sha256(string_agg(CASE WHEN f.pos = w.pos THEN w.folded ELSE f.digest END, '' ORDER BY f.pos)),
                  any_value(w.seen) || coalesce(string_agg(f.digest, '' ORDER BY f.pos) FILTER (f.pos <> w.pos), ''), (any_value(w.n) + 15) // 16
           FROM walk w JOIN forest f ON f.tree = w.tree AND f.level = w.level AND f.pos // 16 = w.pos // 16 WHERE w.n > 1 GROUP BY w.id
           UNION ALL
           SELECT w.id, 'top', 100, s.pos, w.folded, w.seen, s.n FROM walk w JOIN sub s ON w.tree = coalesce('s' || s.source, 'null')
           WHERE w.n = 1 AND w.level < 100)),
done AS (SELECT id, folded, seen FROM walk WHERE n = 1 AND level >= 100)
SELECT w.doc_id, w.leaf, s.digest AS subroot, t.digest AS root, sha256(d.seen) AS proof_sha256, d.folded AS folded_root, d.folded = t.digest AS verified
FROM ranked w JOIN done d USING (id) JOIN sub s ON s.source IS NOT DISTINCT FROM w.source, (SELECT digest FROM top WHERE n = 1) t
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    altered = F.when(held_out(F.col("doc_id"), 5, 0), lowered(F.col("text")))
    return merkle_manifest(docs, altered)


def _kmeans_sql(rounds: int) -> str:
    square = "list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS (SELECT v.rid, arg_min(c.c, ({square}, c.c)) AS c FROM v, c{i} c GROUP BY v.rid)")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT c, list((s - ((s % n + n) % n)) // n ORDER BY j) AS q FROM (
  SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS j FROM a{i} JOIN v USING (rid)) GROUP BY c, j)
  GROUP BY c),
c{i + 1} AS (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m USING (c))""")
    return rf"""
WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: floor(greatest(least(64 * x::DOUBLE, 67108864), -67108864))::BIGINT) AS q FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS (SELECT *, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), q) AS rid FROM w),
c0 AS (SELECT rid - 1 AS c, q FROM v WHERE rid <= 16),
{", ".join(steps)},
e AS (SELECT v.vec_id, c.c AS cluster, {square} AS distance, sha256(array_to_string(c.q, ',')) AS centroid_sha256
      FROM a{rounds} a JOIN v USING (rid) JOIN c{rounds} c ON c.c = a.c)
SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256 FROM e
"""


@query("op13_simplex_centroids", _kmeans_sql(3))
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(read(spark, folder, "embeddings")).drop("compared")
