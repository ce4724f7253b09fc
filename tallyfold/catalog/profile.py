"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.registry import Tables, query
from tallyfold.operators import rowsets, stats


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _long(cols: dict[str, str], table: str, keep: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {keep}'{c}' AS \"column\", {e}::DOUBLE AS value FROM {table}" for c, e in cols.items())


_LI = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "l_tax": "l_tax"}
_LONG = f"WITH long AS ({_long(_LI, 'lineitem')})"


@query("row_delta", "SELECT count(*) AS n_before, count(*) FILTER (o_totalprice > 100000) AS n_after, "
       "count(*) FILTER (NOT o_totalprice > 100000) AS n_removed FROM orders")
def row_delta(t: Tables) -> DataFrame:
    return stats.row_delta(t.orders, t.orders.filter("o_totalprice > 100000"))


@query("value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def value_counts(t: Tables) -> DataFrame:
    return stats.value_counts(t.orders, "o_orderpriority")


@query("value_counts_with_nulls", "SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS seg, count(*) AS count FROM customer GROUP BY 1")
def value_counts_with_nulls(t: Tables) -> DataFrame:
    df = t.customer.select(F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"))
    return stats.value_counts(df, "seg", dropna=False)


@query("unique_values", "SELECT DISTINCT 'p_brand' AS \"column\", p_brand AS value FROM part UNION "
       "SELECT DISTINCT 'p_type', p_type FROM part UNION SELECT DISTINCT 'p_size', p_size::VARCHAR FROM part")
def unique_values(t: Tables) -> DataFrame:
    return stats.unique_values(t.part, ["p_brand", "p_type", "p_size"])


@query("describe_numeric", _LONG + """ SELECT "column", count(*) AS n, round(avg(value), 6) AS mean,
round(stddev_samp(value), 6) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max FROM long GROUP BY 1""")
def describe_numeric(t: Tables) -> DataFrame:
    return rounded(stats.describe_numeric(t.lineitem, list(_LI)), ("mean", "std", "q25", "q50", "q75"))


@query("describe_categorical", """WITH c AS (SELECT 'p_brand' AS "column", p_brand AS v FROM part UNION ALL
SELECT 'p_type', p_type FROM part UNION ALL SELECT 'p_name', p_name FROM part), g AS (SELECT "column", v, count(*) AS n FROM c GROUP BY ALL)
SELECT "column", sum(n)::BIGINT AS n, count(*) AS n_unique, arg_min(v, (-n, v)) AS top, max(n) AS freq FROM g GROUP BY 1""")
def describe_categorical(t: Tables) -> DataFrame:
    return stats.describe_categorical(t.part, ["p_brand", "p_type", "p_name"])


@query("describe_by_group", """SELECT c_mktsegment, 'c_acctbal' AS "column", count(*) AS n, round(avg(c_acctbal), 6) AS mean,
round(stddev_samp(c_acctbal), 6) AS std, min(c_acctbal) AS min, round(quantile_cont(c_acctbal, 0.25), 6) AS q25,
round(quantile_cont(c_acctbal, 0.5), 6) AS q50, round(quantile_cont(c_acctbal, 0.75), 6) AS q75, max(c_acctbal) AS max FROM customer GROUP BY 1""")
def describe_by_group(t: Tables) -> DataFrame:
    return rounded(stats.describe_numeric(t.customer, ["c_acctbal"], ["c_mktsegment"]), ("mean", "std", "q25", "q50", "q75"))


@query("crosstab", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, "
       "count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def crosstab(t: Tables) -> DataFrame:
    return stats.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("count_by_two_keys", "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2")
def count_by_two_keys(t: Tables) -> DataFrame:
    return stats.count_by(t.lineitem, ["l_returnflag", "l_linestatus"])


@query("mean_by_category", "SELECT p_type, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY 1")
def mean_by_category(t: Tables) -> DataFrame:
    return rounded(stats.mean_by(t.part, "p_type", "p_retailprice"), ("mean",))


@query("skewness", _LONG + """ SELECT "column", count(*) AS n, round(skewness(value), 6) AS skewness FROM long GROUP BY 1""")
def skewness(t: Tables) -> DataFrame:
    return rounded(stats.skewness(t.lineitem, list(_LI), bias=False), ("skewness",))


@query("skewness_population", _LONG + """ SELECT "column", count(*) AS n,
round(skewness(value) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 6) AS skewness FROM long GROUP BY 1""")
def skewness_population(t: Tables) -> DataFrame:
    return rounded(stats.skewness(t.lineitem, list(_LI)), ("skewness",))


@query("skew_direction", _LONG + """ SELECT count(*) FILTER (s > 0) AS n_right, count(*) FILTER (s < 0) AS n_left FROM
(SELECT skewness(value) AS s FROM long GROUP BY "column")""")
def skew_direction(t: Tables) -> DataFrame:
    return stats.skew_direction_counts(t.lineitem, list(_LI))


_LIMITS = """lim AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, min(value) AS lo,
max(value) AS hi FROM long GROUP BY 1)"""


@query("iqr_limits", _LONG + f", {_LIMITS}" + """ SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper, round(q1 - 3 * (q3 - q1), 6) AS lower_extreme,
round(q3 + 3 * (q3 - q1), 6) AS upper_extreme FROM lim""")
def iqr_limits(t: Tables) -> DataFrame:
    return rounded(stats.iqr_limits(t.lineitem, list(_LI)),
                   ("q1", "q3", "iqr", "lower", "upper", "lower_extreme", "upper_extreme"))


_SHAPED = {"l_tax": "l_tax", "big": "l_extendedprice * l_quantity * l_quantity"}


@query("outlier_columns", f"WITH long AS ({_long(_SHAPED, 'lineitem')}), {_LIMITS}"
       """ SELECT "column" FROM lim WHERE lo < q1 - 1.5 * (q3 - q1) OR hi > q3 + 1.5 * (q3 - q1)""")
def outlier_columns(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_tax", F.expr(_SHAPED["big"]).alias("big"))
    return stats.outlier_columns(df, ["l_tax", "big"])


@query("fence_percentages", f"WITH long AS ({_long(_SHAPED, 'lineitem')}), {_LIMITS}"
       """ SELECT "column", round(100.0 * count(*) FILTER (value >= q1 - 1.5 * (q3 - q1)) / count(*), 6) AS pct_lower,
round(100.0 * count(*) FILTER (value >= q1 - 3 * (q3 - q1)) / count(*), 6) AS pct_lower_extreme,
round(100.0 * count(*) FILTER (value >= q3 + 1.5 * (q3 - q1)) / count(*), 6) AS pct_upper,
round(100.0 * count(*) FILTER (value >= q3 + 3 * (q3 - q1)) / count(*), 6) AS pct_upper_extreme
FROM long JOIN lim USING ("column") GROUP BY 1""")
def fence_percentages(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_tax", F.expr(_SHAPED["big"]).alias("big"))
    return rounded(stats.fence_percentages(df, ["l_tax", "big"]),
                   [f"pct_{f}" for f in ("lower", "lower_extreme", "upper", "upper_extreme")])


@query("center_stats", """SELECT 'l_quantity' AS "column", round(avg(l_quantity), 6) AS mean, median(l_quantity) AS median,
(SELECT l_quantity FROM (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1) ORDER BY n DESC, l_quantity LIMIT 1) AS mode
FROM lineitem""")
def center_stats(t: Tables) -> DataFrame:
    return rounded(stats.center_stats(t.lineitem, "l_quantity"), ("mean",))


_CORR = ["l_quantity", "l_extendedprice", "mixed", "l_tax"]
_CORR_SRC = "(SELECT *, l_quantity * 1000 + l_extendedprice AS mixed FROM lineitem)"
_CORR_SQL = " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM {_CORR_SRC}"
                               for a in _CORR for b in _CORR if a != b)


@query("correlation_pairs", f"SELECT col_a, col_b, round(r, 8) AS r FROM ({_CORR_SQL}) WHERE abs(r) >= 0.4")
def correlation_pairs(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("mixed", F.col("l_quantity") * 1000 + F.col("l_extendedprice"))
    return rounded(stats.correlation_pairs(df, _CORR, 0.4), ("r",), 8)


@query("max_abs_correlation", f"SELECT col_a AS \"column\", round(max(abs(r)), 8) AS max_abs_r FROM ({_CORR_SQL}) GROUP BY 1 HAVING max(abs(r)) > 0.3")
def max_abs_correlation(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("mixed", F.col("l_quantity") * 1000 + F.col("l_extendedprice"))
    return rounded(stats.max_abs_correlation(df, _CORR, 0.3), ("max_abs_r",), 8)


def _hist(col: str, table: str, bins: int, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    return (f"WITH e AS (SELECT min({col}) AS lo, max({col}) AS hi, count(*) AS total FROM {table}), "
            f"b AS (SELECT {keys}least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1})::INT AS bin, lo, (hi - lo) / {bins} AS w, "
            f"total FROM {table}, e) SELECT {keys}bin, count(*) AS n, round(any_value(lo + bin * w), 6) AS bin_lo, "
            f"round(any_value(lo + (bin + 1) * w), 6) AS bin_hi")


@query("histogram", _hist("o_totalprice", "orders", 30) + ", round(count(*) / any_value(total * w), 12) AS density FROM b GROUP BY bin")
def histogram(t: Tables) -> DataFrame:
    out = stats.histogram(t.orders, "o_totalprice", 30, density=True)
    return rounded(rounded(out, ("bin_lo", "bin_hi")), ("density",), 12)


@query("histogram_by_status", _hist("o_totalprice", "orders", 100, "o_orderstatus") + " FROM b GROUP BY o_orderstatus, bin")
def histogram_by_status(t: Tables) -> DataFrame:
    return rounded(stats.histogram(t.orders, "o_totalprice", 100, ["o_orderstatus"]), ("bin_lo", "bin_hi"))


@query("kernel_density", """WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(*) AS n,
stddev_samp(c_acctbal) * pow(count(*), -0.2) AS bw FROM customer), g AS (SELECT i::INT AS i, lo - 3 * bw + i * (hi - lo + 6 * bw) / 199 AS x,
bw, n FROM s, range(200) r(i)) SELECT i, round(x, 6) AS x, round(sum(exp(-0.5 * ((x - c_acctbal) / bw) ** 2)) / any_value(n * bw *
sqrt(2 * pi())), 12) AS density FROM g, customer GROUP BY i, x""")
def kernel_density(t: Tables) -> DataFrame:
    return rounded(rounded(stats.kde(t.customer, "c_acctbal"), ("x",)), ("density",), 12)


@query("top_words", r"""SELECT word, count(*) AS count FROM (SELECT unnest(regexp_split_to_array(text, '[\s!-/:-@\[-`{-~]+')) AS word
FROM documents) WHERE word <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 60""")
def top_words(t: Tables) -> DataFrame:
    return stats.top_words(t.documents, "text", 60)


@query("top_bottom_groups", """WITH c AS (SELECT c_nationkey, count(*) AS count FROM customer GROUP BY 1), u AS (
(SELECT *, 'top' AS side FROM c ORDER BY count DESC, c_nationkey LIMIT 10) UNION ALL
(SELECT *, 'bottom' AS side FROM c ORDER BY count, c_nationkey LIMIT 10))
SELECT u.*, n_name AS label FROM u LEFT JOIN nation ON n_nationkey = c_nationkey""")
def top_bottom_groups(t: Tables) -> DataFrame:
    return stats.top_bottom_groups(t.customer, "c_nationkey", 10, t.nation, "n_nationkey", "n_name")


@query("default_rate_by_nation", """SELECT c_nationkey, round(nullif(count(*) FILTER (o_orderstatus = 'F'), 0) / count(*), 9) AS rate,
array_to_string(list_transform(string_split(lower(n_name), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey, n_name""")
def default_rate_by_nation(t: Tables) -> DataFrame:
    from tallyfold.functions.scalars import title_case
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rates = rounded(stats.rate_by(rows, "c_nationkey", F.col("o_orderstatus") == "F"), ("rate",), 9)
    return rates.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_nationkey", "rate", title_case(F.col("n_name")).alias("title"))


@query("duplicate_rows", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY
l_orderkey, l_linenumber ORDER BY l_partkey * 10000 + l_suppkey) AS rn FROM lineitem) WHERE rn > 1""")
def duplicate_rows(t: Tables) -> DataFrame:
    shown = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = t.lineitem.select(*shown, F.struct("l_orderkey", "l_linenumber", (F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("k")).alias("__id"))
    return rowsets.duplicate_rows(rows, ["l_orderkey", "l_linenumber"], "__id").select(*shown)


@query("whole_row_dedup", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def whole_row_dedup(t: Tables) -> DataFrame:
    return rowsets.dedup(t.customer.select("c_nationkey", "c_mktsegment"))


@query("key_dedup", "SELECT o_custkey, o_orderstatus, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1")
def key_dedup(t: Tables) -> DataFrame:
    df = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey")
    return rowsets.dedup(df, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("best_per_group", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
ORDER BY o_totalprice DESC, o_orderkey) = 1""")
def best_per_group(t: Tables) -> DataFrame:
    return rowsets.best_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_totalprice", "o_orderkey")


@query("worst_per_group", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
ORDER BY o_totalprice, o_orderkey) = 1""")
def worst_per_group(t: Tables) -> DataFrame:
    return rowsets.best_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_totalprice",
                                  "o_orderkey", largest=False)


@query("wide_to_long", """SELECT p_partkey, variable, value FROM (SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM part)
UNPIVOT (value FOR variable IN (p_size, p_retailprice))""")
def wide_to_long(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return rowsets.melt(df, ["p_partkey"], ["p_size", "p_retailprice"])


@query("unnest_parallel", "SELECT n_nationkey, unnest([n_nationkey, n_regionkey]) AS key, unnest(['nation', 'region']) AS role FROM nation")
def unnest_parallel(t: Tables) -> DataFrame:
    df = t.nation.select("n_nationkey", F.array("n_nationkey", "n_regionkey").alias("ks"),
                         F.array(F.lit("nation"), F.lit("region")).alias("rs"))
    return rowsets.unnest_parallel(df, ["n_nationkey"], {"ks": "key", "rs": "role"})


@query("lookup_left_join", "SELECT c_custkey, n_name AS label FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) "
       "ON c_nationkey = n_nationkey")
def lookup_left_join(t: Tables) -> DataFrame:
    some = t.nation.filter("n_regionkey <> 2")
    return rowsets.lookup_key(t.customer, some, {"c_nationkey": "n_nationkey"}, "n_name", "label", "left").select("c_custkey", "label")


@query("join_roles", """SELECT o_orderkey, cn.n_name AS buyer, sn.n_name AS seller, l_linenumber, l_partkey FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey""")
def join_roles(t: Tables) -> DataFrame:
    rows = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")))
    out = rowsets.join_roles(rows, t.nation, "n_nationkey", {"c_nationkey": {"n_name": "buyer"}, "s_nationkey": {"n_name": "seller"}})
    return out.select("o_orderkey", "buyer", "seller", "l_linenumber", "l_partkey")
