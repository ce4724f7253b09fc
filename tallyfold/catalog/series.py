"""Time buckets, calendar counts and clustering of days, points and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.registry import Tables, query
from tallyfold.operators import density, rowsets, shapes, timeseries


def _buckets(unit: str) -> str:
    return (f"b AS (SELECT unnest(generate_series(date_trunc('{unit}', min(ts)), date_trunc('{unit}', max(ts)), INTERVAL 1 {unit})) AS bucket "
            f"FROM events), s AS (SELECT date_trunc('{unit}', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1), "
            f"f AS (SELECT bucket, coalesce(v, 0) AS total FROM b LEFT JOIN s USING (bucket))")


def _text(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@query("hourly_sums", f"WITH {_buckets('hour')} SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket, round(total, 4) AS total FROM f")
def hourly_sums(t: Tables) -> DataFrame:
    return _text(timeseries.resample_sum(t.events, "ts", "value", "hour")).withColumn("total", F.round("total", 4))


@query("minute_sums", f"WITH {_buckets('minute')} SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket, round(total, 4) AS total FROM f")
def minute_sums(t: Tables) -> DataFrame:
    return _text(timeseries.resample_sum(t.events, "ts", "value", "minute")).withColumn("total", F.round("total", 4))


@query("daily_profile", f"WITH {_buckets('hour')} SELECT strftime(bucket, '%Y-%m-%d') AS date, "
       + ", ".join(f"round(max(CASE WHEN hour(bucket) = {h} THEN total END), 4) AS \"{h:02d}:00\"" for h in range(24))
       + ", any_value(dayname(bucket)) AS day_name FROM f GROUP BY 1")
def daily_profile(t: Tables) -> DataFrame:
    out = timeseries.daily_profile(t.events, "ts", "value")
    return out.withColumns({h: F.round(f"`{h}`", 4) for h in timeseries.HOURS})


@query("count_by_weekday", "SELECT dayname(ts) AS day_name, (isodow(ts) - 1)::INT AS day_order, count(*) AS count FROM events GROUP BY 1, 2")
def count_by_weekday(t: Tables) -> DataFrame:
    return timeseries.count_by_weekday(t.events, "ts")


@query("count_by_hour", "SELECT hour(ts)::INT AS hour, count(*) AS count FROM events GROUP BY 1")
def count_by_hour(t: Tables) -> DataFrame:
    return timeseries.count_by_hour(t.events, "ts")


@query("evening_events", "SELECT event_id FROM events WHERE hour(ts) = 18")
def evening_events(t: Tables) -> DataFrame:
    return t.events.filter(F.hour("ts") == 18).select("event_id")


@query("range_filter", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'")
def range_filter(t: Tables) -> DataFrame:
    lo, hi = (F.to_timestamp_ntz(F.lit(f"{d} 00:00:00")) for d in ("2024-01-05", "2024-01-20"))
    return rowsets.between_half_open(t.events, "ts", lo, hi).select("event_id")


# --- one-dimensional density -------------------------------------------------------------------

_MINUTES = f"""{_buckets('minute')}, m AS (SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket, floor(total)::BIGINT AS v FROM f),
d AS (SELECT v, count(*) AS w, min(bucket) AS first FROM m GROUP BY 1),
n AS (SELECT *, sum(w) OVER (ORDER BY v RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) >= 50 AS core FROM d),
c AS (SELECT v, first, sum(CASE WHEN v - p <= 1 THEN 0 ELSE 1 END) OVER (ORDER BY v) AS run FROM
  (SELECT *, lag(v) OVER (ORDER BY v) AS p FROM n WHERE core)),
i AS (SELECT run, row_number() OVER (ORDER BY min(first)) - 1 AS cluster FROM c GROUP BY 1),
l AS (SELECT n.v, min(cluster) AS cluster FROM n JOIN c ON abs(n.v - c.v) <= 1 AND (NOT n.core OR n.v = c.v) JOIN i USING (run) GROUP BY 1),
labelled AS (SELECT m.bucket, m.v AS total, coalesce(l.cluster, -1)::INT AS cluster FROM m LEFT JOIN l USING (v))"""


def _minutes(t: Tables) -> DataFrame:
    sums = timeseries.resample_sum(t.events, "ts", "value", "minute")
    return _text(sums).withColumn("total", F.floor("total"))


@query("minute_density", f"WITH {_MINUTES} SELECT * FROM labelled")
def minute_density(t: Tables) -> DataFrame:
    return density.dbscan_1d(_minutes(t), "bucket", "total", 1.0, 50)


@query("anomalies", f"WITH {_MINUTES} SELECT * FROM labelled WHERE cluster = -1")
def anomalies(t: Tables) -> DataFrame:
    return density.anomalies(density.dbscan_1d(_minutes(t), "bucket", "total", 1.0, 50))


@query("anomalies_by_weekday", f"WITH {_MINUTES} SELECT dayname(bucket::TIMESTAMP) AS day_name, (isodow(bucket::TIMESTAMP) - 1)::INT "
       "AS day_order, count(*) AS count FROM labelled WHERE cluster = -1 GROUP BY 1, 2")
def anomalies_by_weekday(t: Tables) -> DataFrame:
    odd = density.anomalies(density.dbscan_1d(_minutes(t), "bucket", "total", 1.0, 50))
    return timeseries.count_by_weekday(odd.withColumn("ts", F.to_timestamp("bucket", "yyyy-MM-dd HH:mm")), "ts")


@query("anomalies_by_hour", f"WITH {_MINUTES} SELECT hour(bucket::TIMESTAMP)::INT AS hour, count(*) AS count FROM labelled WHERE cluster = -1 GROUP BY 1")
def anomalies_by_hour(t: Tables) -> DataFrame:
    odd = density.anomalies(density.dbscan_1d(_minutes(t), "bucket", "total", 1.0, 50))
    return timeseries.count_by_hour(odd.withColumn("ts", F.to_timestamp("bucket", "yyyy-MM-dd HH:mm")), "ts")


@query("density_cluster_days", f"WITH {_MINUTES} SELECT cluster, array_to_string(list_sort(list_distinct(list(substr(bucket, 1, 10)))), ',') AS dates, "
       "array_to_string(list_sort(list_distinct(list(dayname(bucket::TIMESTAMP)))), ',') AS day_names FROM labelled GROUP BY 1")
def density_cluster_days(t: Tables) -> DataFrame:
    """Days and weekdays of the members of each density cluster."""
    found = density.dbscan_1d(_minutes(t), "bucket", "total", 1.0, 50)
    days = found.withColumns({"date": F.substring("bucket", 1, 10), "day": F.date_format(F.to_timestamp("bucket", "yyyy-MM-dd HH:mm"), "EEEE")})
    out = density.cluster_members(days, "date", "day")
    return out.select("cluster", F.array_join("dates", ",").alias("dates"), F.array_join("day_names", ",").alias("day_names"))


@query("cluster_sizes", f"WITH {_MINUTES} SELECT cluster, count(*) AS count FROM labelled GROUP BY 1")
def cluster_sizes(t: Tables) -> DataFrame:
    return density.cluster_sizes(density.dbscan_1d(_minutes(t), "bucket", "total", 1.0, 50))


# --- points ------------------------------------------------------------------------------------

_POINTS = """pts AS (SELECT p_size::DOUBLE AS x, p_retailprice AS y, count(*)::DOUBLE AS w, min(l_partkey) AS pid
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
# Label propagation on the core points: every step takes the smallest label among near cores.
_DENSE = """nb AS (SELECT a.pid AS a, b.pid AS b, b.w FROM pts a JOIN pts b ON (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= {e} * {e}),
core AS (SELECT a AS pid FROM nb GROUP BY 1 HAVING sum(w) >= {m}),
ce AS (SELECT a, b FROM nb WHERE a IN (FROM core) AND b IN (FROM core)),
walk AS (SELECT pid AS a, pid AS label FROM core UNION SELECT ce.b, walk.label FROM walk JOIN ce ON walk.a = ce.a AND walk.label < ce.b),
comp AS (SELECT a AS pid, min(label) AS root FROM walk GROUP BY 1),
rk AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM comp)),
lab AS (SELECT pid, cluster FROM comp JOIN rk USING (root) UNION ALL SELECT nb.a, min(cluster) FROM nb JOIN comp ON nb.b = comp.pid
  JOIN rk USING (root) WHERE nb.a NOT IN (FROM core) GROUP BY 1)"""


@query("hotspots", f"WITH RECURSIVE {_POINTS}, {_DENSE.format(e=1.0, m=60)} SELECT pts.pid, coalesce(cluster, -1)::INT AS cluster "
       "FROM pts LEFT JOIN lab USING (pid)")
def hotspots(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    pts = rows.groupBy(F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y")).agg(
        F.count("*").alias("w"), F.min("l_partkey").alias("pid"))
    return density.dbscan(pts, "pid", ["x", "y"], 1.0, 60, "w").select("pid", "cluster")


@query("polygon_centroids", "SELECT p_partkey, (p_size + 0.5)::DOUBLE AS geometry_x, round(p_retailprice + 1, 6) AS geometry_y FROM part")
def polygon_centroids(t: Tables) -> DataFrame:
    corners = ((0, 0), (1, 0), (1, 2), (0, 2))
    ring = F.array(*[F.struct((F.col("p_size") + a).cast("double").alias("x"), (F.col("p_retailprice") + b).alias("y"))
                     for a, b in corners])
    out = shapes.polygon_centroid(t.part.withColumn("ring", ring), "ring")
    return out.select("p_partkey", F.round("geometry_x", 6).alias("geometry_x"), F.round("geometry_y", 6).alias("geometry_y"))


@query("mean_centroids", "SELECT p_type, round(avg(p_size + 0.5), 6) AS geometry_x, round(avg(p_retailprice + 1), 6) AS geometry_y FROM part GROUP BY 1")
def mean_centroids(t: Tables) -> DataFrame:
    corners = ((0, 0), (1, 0), (1, 2), (0, 2))
    ring = F.array(*[F.struct((F.col("p_size") + a).cast("double").alias("x"), (F.col("p_retailprice") + b).alias("y"))
                     for a, b in corners])
    out = shapes.mean_centroid(shapes.polygon_centroid(t.part.withColumn("ring", ring), "ring"), "p_type")
    return out.select("p_type", F.round("geometry_x", 6).alias("geometry_x"), F.round("geometry_y", 6).alias("geometry_y"))


# --- days and vectors --------------------------------------------------------------------------

@query("daily_kmeans")
def daily_kmeans(t: Tables) -> DataFrame:
    return shapes.dtw_kmeans(timeseries.daily_vectors(t.events, "ts", "value"), "date", "profile", 3)


@query("daily_elbow")
def daily_elbow(t: Tables) -> DataFrame:
    return shapes.elbow(timeseries.daily_vectors(t.events, "ts", "value"), "date", "profile")


@query("daily_cluster_members")
def daily_cluster_members(t: Tables) -> DataFrame:
    days = shapes.dtw_kmeans(timeseries.daily_vectors(t.events, "ts", "value"), "date", "profile", 3)
    return density.cluster_members(days.withColumn("day_name", F.date_format(F.to_date("date"), "EEEE")), "date", "day_name")


_VEC = """pts AS (SELECT vec_id AS pid, embedding::DOUBLE[] AS v, 1.0 AS w FROM embeddings),
nb AS (SELECT a.pid AS a, b.pid AS b, b.w FROM pts a, pts b WHERE list_distance(a.v, b.v) <= {e})"""


def _vector_sql(eps: float, m: int) -> str:
    dense = _DENSE[_DENSE.index("core AS"):].format(e=eps, m=m)
    return f"WITH RECURSIVE {_VEC.format(e=eps)}, {dense} SELECT pts.pid AS vec_id, coalesce(cluster, -1)::INT AS cluster FROM pts LEFT JOIN lab USING (pid)"


@query("vector_density", _vector_sql(1.2, 5))
def vector_density(t: Tables) -> DataFrame:
    return density.dbscan_vectors(t.embeddings, "vec_id", "embedding", 1.2, 5).select("vec_id", "cluster")


@query("day_density", f"WITH RECURSIVE {_buckets('hour')}, days AS (SELECT strftime(bucket, '%Y%m%d')::BIGINT AS pid, "
       "list(total ORDER BY bucket) AS v, 1.0 AS w FROM f GROUP BY 1), pts AS (FROM days), nb AS (SELECT a.pid AS a, b.pid AS b, b.w "
       "FROM pts a, pts b WHERE list_distance(a.v, b.v) <= 1500), " + _DENSE[_DENSE.index("core AS"):].format(e=1500, m=5)
       + " SELECT pts.pid AS day, coalesce(cluster, -1)::INT AS cluster FROM pts LEFT JOIN lab USING (pid)")
def day_density(t: Tables) -> DataFrame:
    days = timeseries.daily_vectors(t.events, "ts", "value").withColumn("day", F.regexp_replace("date", "-", "").cast("long"))
    return density.dbscan_vectors(days, "day", "profile", 1500.0, 5).select("day", "cluster")
