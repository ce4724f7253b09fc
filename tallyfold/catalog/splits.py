"""Split, sampling and resampling queries. Both engines order rows by the same seeded hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.registry import Tables, h32, h60, query
from tallyfold.operators import neighbours, resample, sampling
from tallyfold.operators.rowsets import first_per_key

_H0, _H1, _H2 = h32("o_orderkey"), h32("o_orderkey", "12346"), h32("o_orderkey", "12347")


def _plan(source: str, strata: str) -> str:
    part = f"PARTITION BY {strata} " if strata else ""
    whole = f"PARTITION BY {strata}" if strata else ""
    return f"""r AS (SELECT *, row_number() OVER ({part}ORDER BY {_H0}, o_orderkey) AS rk, count(*) OVER ({whole}) AS n FROM {source}),
z AS (SELECT *, (n * 30 + 100) // 200 AS nt FROM r),
s AS (SELECT *, CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + ((n - nt) * 30 + 85) // 170 THEN 'val' ELSE 'train' END AS holdout FROM z),
f AS (SELECT o_orderkey, row_number() OVER ({part}ORDER BY {_H1}, o_orderkey) - 1 AS r0, count(*) OVER ({whole}) AS m FROM s
  WHERE holdout <> 'test'),
plan AS (SELECT s.*, (r0 * 5 // m + 1)::INT AS fold FROM s LEFT JOIN f USING (o_orderkey))"""


_SLIM = "(SELECT o_orderkey, o_orderstatus, (o_orderstatus = 'F')::INT AS y FROM orders)"


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_orderstatus") == "F").cast("int").alias("y"))


@query("stratified_plan", f"WITH {_plan(_SLIM, 'o_orderstatus')} SELECT o_orderkey, o_orderstatus, y, holdout, fold FROM plan")
def stratified_plan(t: Tables) -> DataFrame:
    return sampling.plan_splits(_orders(t), "o_orderkey", ["o_orderstatus"])


@query("plain_plan", f"WITH {_plan(_SLIM, '')} SELECT o_orderkey, o_orderstatus, y, holdout, fold FROM plan")
def plain_plan(t: Tables) -> DataFrame:
    return sampling.plan_splits(_orders(t), "o_orderkey")


_BALANCED = f"""o AS {_SLIM}, c AS (SELECT min(n) AS keep, max(n) AS big FROM (SELECT count(*) AS n FROM o GROUP BY y)),
mj AS (SELECT *, row_number() OVER (ORDER BY {_H2}, o_orderkey) AS mk FROM o WHERE y = 0),
used AS (SELECT o_orderkey, o_orderstatus, y FROM mj, c WHERE mk <= keep UNION ALL FROM o WHERE y = 1),
spare AS (SELECT o_orderkey, o_orderstatus, y, CASE WHEN mk <= big - (big - keep + 1) // 2 THEN 'val' ELSE 'test' END AS extra FROM mj, c
  WHERE mk > keep), {_plan('used', 'y')},
balanced AS (SELECT o_orderkey, o_orderstatus, y, holdout, fold, NULL::VARCHAR AS extra FROM plan UNION ALL
  SELECT o_orderkey, o_orderstatus, y, extra, NULL, extra FROM spare)"""


@query("balanced_plan", f"WITH {_BALANCED} SELECT * FROM balanced")
def balanced_plan(t: Tables) -> DataFrame:
    return sampling.balanced_plan(_orders(t), "o_orderkey", "y")


@query("named_splits", f"WITH {_BALANCED} " + " UNION ALL ".join(
    [f"SELECT '{n}' AS split, count(*) FILTER (extra IS NULL AND holdout {a}) AS n_train, count(*) FILTER (holdout = '{b}') AS n_eval FROM balanced"
     for n, a, b in (("testing", "<> 'test'", "test"), ("validation", "= 'train'", "val"))]
    + [f"SELECT 'fold_{i}', count(*) FILTER (fold <> {i}), count(*) FILTER (fold = {i} OR extra = 'val') FROM balanced" for i in range(1, 6)]))
def named_splits(t: Tables) -> DataFrame:
    from tallyfold.session import stage_table
    plan = stage_table(sampling.balanced_plan(_orders(t), "o_orderkey", "y"), "plan")
    parts = []
    for name in sampling.split_names():
        train, evaluate = sampling.named_split(plan, name)
        both = train.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(evaluate.select(F.lit(0), F.lit(1)))
        parts.append(both.agg(F.sum("a").alias("n_train"), F.sum("b").alias("n_eval")).select(
            F.lit(name).alias("split"), "n_train", "n_eval"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("split_class_counts", f"WITH {_plan(_SLIM, 'o_orderstatus')} SELECT y, count(*) FILTER (holdout = 'train') AS train, "
       "count(*) FILTER (holdout = 'val') AS val, count(*) FILTER (holdout = 'test') AS test FROM plan GROUP BY 1")
def split_class_counts(t: Tables) -> DataFrame:
    return sampling.split_class_counts(sampling.stratified_holdout(_orders(t), "o_orderkey", ["o_orderstatus"]), "y")


@query("fold_class_counts", f"WITH {_plan(_SLIM, 'o_orderstatus')} SELECT y, " + ", ".join(
    f"count(*) FILTER (fold = {i}) AS \"{i}\"" for i in range(1, 6)) + " FROM plan WHERE fold IS NOT NULL GROUP BY 1")
def fold_class_counts(t: Tables) -> DataFrame:
    plan = sampling.plan_splits(_orders(t), "o_orderkey", ["o_orderstatus"]).filter("fold is not null")
    return sampling.split_class_counts(plan, "y", "fold", range(1, 6))


@query("sample_per_year", f"WITH r AS (SELECT o_orderkey, year(o_orderdate)::INT AS yr, row_number() OVER (PARTITION BY year(o_orderdate) "
       f"ORDER BY {_H0}, o_orderkey) AS rk, count(*) OVER (PARTITION BY year(o_orderdate)) AS n FROM orders) "
       "SELECT o_orderkey, yr FROM r WHERE rk <= greatest(1, n * 200 // 1000)")
def sample_per_year(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr"))
    return sampling.sample_per_group(df, "o_orderkey", ["yr"])


@query("random_undersample", f"SELECT o_orderkey, y FROM {_SLIM} o QUALIFY y = 1 OR row_number() OVER (PARTITION BY y ORDER BY {_H0}, "
       "o_orderkey) <= count(*) FILTER (y = 1) OVER ()")
def random_undersample(t: Tables) -> DataFrame:
    return resample.random_undersample(_orders(t).select("o_orderkey", "y"), "o_orderkey", "y")


_OVER = f"""o AS (SELECT o_orderkey, y FROM {_SLIM}), c AS (SELECT min(n) AS small, max(n) AS big FROM (SELECT count(*) AS n FROM o GROUP BY y)),
pool AS (SELECT *, row_number() OVER (ORDER BY {_H0}, o_orderkey) AS rk FROM o WHERE y = 1),
draws AS (SELECT d, ({h60('d', '12345:draw')}) % small + 1 AS rk FROM c, range({{need}}) g(d)),
grown AS (SELECT o_orderkey, y, NULL::BIGINT AS draw FROM o UNION ALL SELECT o_orderkey, y, d FROM draws JOIN pool USING (rk))"""


@query("random_oversample", "WITH " + _OVER.format(need="(SELECT max(n) - min(n) FROM (SELECT count(*) AS n FROM orders "
       "GROUP BY o_orderstatus = 'F'))") + " SELECT * FROM grown")
def random_oversample(t: Tables) -> DataFrame:
    return resample.random_oversample(_orders(t).select("o_orderkey", "y"), "o_orderkey", "y")


@query("over_then_under", """SELECT y, count(*) AS n FROM (SELECT (l_returnflag = 'R' AND l_linenumber = 1)::INT AS y FROM lineitem
UNION ALL SELECT 1 FROM range((SELECT (count(*) FILTER (NOT (l_returnflag = 'R' AND l_linenumber = 1)) // 2)::INT
- count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 1) FROM lineitem))) GROUP BY 1
HAVING y = 1 UNION ALL SELECT 0, floor(count(*) * 0.5)::BIGINT FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linenumber = 1)""")
def over_then_under(t: Tables) -> DataFrame:
    from tallyfold.catalog.registry import LINE_ID
    y = ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)).cast("int")
    rows = t.lineitem.select(F.expr(LINE_ID).alias("id"), y.alias("y"))
    return resample.over_then_under(rows, "id", "y").groupBy("y").agg(F.count("*").alias("n"))


# --- neighbours --------------------------------------------------------------------------------

_PTS = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, (label < 2)::INT AS y, label FROM embeddings)"


def _near(left: str, right: str, k: int, extra: str = "a.id <> b.id", dist: str = "list_distance(a.v, b.v)") -> str:
    return (f"SELECT a.id AS left_id, b.id AS right_id, {dist} AS d, row_number() OVER (PARTITION BY a.id ORDER BY {dist}, b.id) AS rank "
            f"FROM {left} a, {right} b WHERE {extra} QUALIFY rank <= {k}")


def _labelled(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "embedding", "label", (F.col("label") < 2).cast("int").alias("y"))


@query("knn_join", f"WITH {_PTS} SELECT left_id, right_id, round(d, 6) AS distance, rank::INT AS rank FROM ({_near('e', 'e', 5)})")
def knn_join(t: Tables) -> DataFrame:
    out = neighbours.knn_join(t.embeddings, t.embeddings, 5, "vec_id", "vec_id", "embedding", exclude_self=True)
    return out.withColumn("distance", F.round("distance", 6))


@query("radius_counts", f"WITH {_PTS} SELECT a.id AS vec_id, count(*)::DOUBLE AS n_within FROM e a, e b WHERE list_distance(a.v, b.v) <= 1.2 GROUP BY 1")
def radius_counts(t: Tables) -> DataFrame:
    return neighbours.radius_counts(t.embeddings, "vec_id", "embedding", 1.2)


_TRAIN = "tr AS (FROM e WHERE id % 5 <> 0), te AS (FROM e WHERE id % 5 = 0)"


@query("knn_classify", f"WITH {_PTS}, {_TRAIN}, n AS ({_near('te', 'tr', 5, 'TRUE')}), v AS (SELECT left_id, label, count(*) AS vote FROM n "
       "JOIN e ON e.id = right_id GROUP BY 1, 2) SELECT left_id AS vec_id, arg_min(label, (-vote, label)) AS prediction, "
       "round(max(vote) / sum(vote), 6) AS score FROM v GROUP BY 1")
def knn_classify(t: Tables) -> DataFrame:
    e = _labelled(t)
    out = neighbours.knn_classify(e.filter("vec_id % 5 <> 0"), e.filter("vec_id % 5 = 0"), "vec_id", "embedding", "label")
    return out.withColumn("score", F.round("score", 6))


@query("knn_classify_weighted", f"WITH {_PTS}, {_TRAIN}, n AS (" + _near(
    "te", "tr", 7, "TRUE", "list_sum(list_transform(list_zip(a.v, b.v), lambda z: abs(z[1] - z[2])))")
    + "), v AS (SELECT left_id, label, sum(1 / d) AS vote FROM n JOIN e ON e.id = right_id GROUP BY 1, 2) SELECT left_id AS vec_id, "
    "arg_max(label, vote) AS prediction, round(max(vote) / sum(vote), 6) AS score FROM v GROUP BY 1")
def knn_classify_weighted(t: Tables) -> DataFrame:
    e = _labelled(t)
    out = neighbours.knn_classify(e.filter("vec_id % 5 <> 0"), e.filter("vec_id % 5 = 0"), "vec_id", "embedding", "label",
                                  k=7, weights="distance", p=1)
    return out.withColumn("score", F.round("score", 6))


@query("near_miss", f"WITH {_PTS}, n AS (" + _near("(FROM e WHERE y = 0)", "(FROM e WHERE y = 1)", 3, "TRUE") + "), m AS (SELECT left_id AS id, "
       "avg(d) AS md FROM n GROUP BY 1) SELECT id, round(md, 6) AS mean_distance, row_number() OVER (ORDER BY md, id) AS rank FROM m "
       "QUALIFY rank <= (SELECT count(*) FROM e WHERE y = 1)")
def near_miss(t: Tables) -> DataFrame:
    return resample.near_miss(_labelled(t), "vec_id", "embedding", "y").withColumn("mean_distance", F.round("mean_distance", 6))


# Synthetic rows: quota per seed row, neighbour and step by hash, point between the two.
_SYNTH = """near AS (SELECT * FROM ({near})),
draws AS (SELECT id, unnest(range(quota)) AS j FROM quotas),
picks AS (SELECT id, j, ({hn}) % 5 + 1 AS pick, ({hg}) / 4294967296.0 AS t FROM draws),
synth AS (SELECT p.id AS seed_id, n.right_id AS neighbour_id, j, t, a.v AS x, b.v AS y FROM picks p JOIN near n ON n.left_id = p.id AND
  n.rank = p.pick JOIN e a ON a.id = p.id JOIN e b ON b.id = n.right_id)
SELECT seed_id, neighbour_id, j::INT AS j, round(t, 9) AS t, round(list_sum(list_transform(list_zip(x, y), lambda z: z[1] + t * (z[2] - z[1]))), 5)
AS checksum FROM synth""".replace("{hn}", h32("concat(id, '-', j)", "12345:nn")).replace("{hg}", h32("concat(id, '-', j)", "12345:gap"))
_NEED = "(SELECT count(*) FILTER (y = 0) - count(*) FILTER (y = 1) FROM e)"


def _spread(source: str) -> str:
    return (f"quotas AS (SELECT id, {_NEED} // n + (CASE WHEN rk <= {_NEED} % n THEN 1 ELSE 0 END) AS quota FROM (SELECT id, row_number() OVER "
            f"(ORDER BY {h32('id')}, id) AS rk, count(*) OVER () AS n FROM {source}))")


def _checked(out: DataFrame) -> DataFrame:
    total = F.aggregate("vec", F.lit(0.0), lambda a, b: a + b)
    return out.select("seed_id", "neighbour_id", "j", F.round("t", 9).alias("t"), F.round(total, 5).alias("checksum"))


_MINOR = "mi AS (FROM e WHERE y = 1)"
_SHARE = "share AS (SELECT left_id AS id, count(*) FILTER (o.y = 0) AS n_major FROM ({near}) n JOIN e o ON o.id = n.right_id GROUP BY 1)"


@query("smote", f"WITH {_PTS}, {_MINOR}, {_spread('mi')}, " + _SYNTH.replace("{near}", _near("mi", "mi", 5)))
def smote(t: Tables) -> DataFrame:
    return _checked(resample.smote(_labelled(t), "vec_id", "embedding", "y"))


@query("borderline_smote", f"WITH {_PTS}, {_MINOR}, " + _SHARE.format(near=_near("mi", "e", 10))
       + f", danger AS (SELECT id FROM share WHERE n_major >= 5 AND n_major < 10), {_spread('danger')}, "
       + _SYNTH.replace("{near}", _near("mi", "mi", 5)))
def borderline_smote(t: Tables) -> DataFrame:
    return _checked(resample.borderline_smote(_labelled(t), "vec_id", "embedding", "y"))


@query("adasyn", f"WITH {_PTS}, {_MINOR}, " + _SHARE.format(near=_near("mi", "e", 5))
       + f", quotas AS (SELECT id, round(n_major / 5 * {_NEED} / (SELECT sum(n_major / 5) FROM share))::INT AS quota FROM share), "
       + _SYNTH.replace("{near}", _near("mi", "mi", 5)))
def adasyn(t: Tables) -> DataFrame:
    return _checked(resample.adasyn(_labelled(t), "vec_id", "embedding", "y"))


@query("smote_then_under", f"WITH {_PTS}, c AS (SELECT count(*) FILTER (y = 0) AS big, count(*) FILTER (y = 1) AS small FROM e) "
       "SELECT 1 AS y, greatest(small, (big // 2)) AS n FROM c UNION ALL SELECT 0, least(big, greatest(small, big // 2)) FROM c")
def smote_then_under(t: Tables) -> DataFrame:
    e = _labelled(t).withColumn("embedding", F.col("embedding").cast("array<double>")).select("vec_id", "embedding", "y")
    return resample.smote_then_under(e, "vec_id", "embedding", "y").groupBy("y").agg(F.count("*").alias("n"))


@query("top_orders_per_segment", """SELECT c_mktsegment, o_orderkey, rank::INT AS rank FROM (SELECT c_mktsegment, o_orderkey, row_number() OVER
(PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rank <= 3""")
def top_orders_per_segment(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return first_per_key(rows.select("c_mktsegment", "o_orderkey", "o_totalprice"), ["c_mktsegment"],
                         [F.desc("o_totalprice"), F.col("o_orderkey")], 3, "rank").drop("o_totalprice")
