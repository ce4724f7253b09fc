"""URL filter: pattern rules found through their rarest literal token, then tested as regular expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the contract, (action, host/path). The longest that fits decides.
SITE_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# The method's own rules for what no site rule covers: (action, regular expression over host and path).
# A rule's literal tokens are the letters-and-digits words of ``tokens``; all of them must be in a url that fits. A rule with
# alternatives has a set of tokens for each, split by ``|``: all tokens of one of the sets must be in a url that fits.
PATTERN_RULES = (
    ("block", r"(^|\.)casino-[^/]*\.", "casino"),
    ("block", r"(^|\.)[^/.]*-bets\.", "bets"),
    ("block", r"(^|\.)cheap-pills\.", "cheap pills"),
    ("block", r"(^|\.)ads-track\.", "ads track"),
    ("block", r"(^|\.)[^/]*-win\.[^/]*/", "win"),
    ("block", r"/(popunder|adserver)/", "popunder|adserver"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` and path up to ``?`` or ``#``; both empty without ``://`` or url."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return host, path


def site_pattern(rule: str) -> str:
    """The regular expression of a host/path rule over host and path: the host itself or any subdomain, path prefix."""
    escaped = "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in rule)
    return r"\A(?:[^/]*\.)?" + escaped


def words_of(text: Column) -> Column:
    """Distinct words of letters and digits: the tokens rules are indexed by."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda t: t != ""))


def judge_urls(pages: DataFrame, site_rules: Sequence[tuple[str, str]] = SITE_RULES,
               pattern_rules: Sequence[tuple[str, str, str]] = PATTERN_RULES, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, pattern (the method's rule that fired), n_tested.

    Every rule is filed, for each of its alternatives, under the literal token that is in fewest urls; token counts cover all urls. The
    tokens of a url fetch the rules filed under them, and only those run their expression. The rule table is made from
    the arguments, so its size is theirs and never follows the pages. Rows are only exploded into the tokens that index
    some rule, so a token of every url costs nothing unless a rule has no other.

    The longest site rule that fits decides; else a url is blocked if a pattern rule that blocks fits, and allowed if
    not. A null url, or one without ``://``, has an empty host and path and is allowed. Repeated rows are each judged;
    an empty table gives no rows. Columns of the input other than id and url are not read.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")) \
        .withColumn("place", F.concat("host", "path"))
    rules = [(i, "site", action, text, site_pattern(text), [_literals(text)])
             for i, (action, text) in enumerate(site_rules)]
    rules += [(len(rules) + i, "pattern", action, pattern, pattern, [way.split() for way in tokens.split("|")])
              for i, (action, pattern, tokens) in enumerate(pattern_rules)]
    table = spark.createDataFrame(rules, "rule_no int, kind string, action string, rule string, regex string, ways array<array<string>>")
    literal = table.select("rule_no", F.posexplode("ways").alias("way", "tokens")).select("rule_no", "way", F.explode("tokens").alias("token"))
    wanted = sorted({t for r in rules for way in r[5] for t in way})
    known = F.array(*[F.lit(t) for t in wanted])
    urls = urls.withColumn("tokens", F.array_intersect(words_of(F.col("place")), known))
    counts = urls.select(F.explode("tokens").alias("token")).groupBy("token").count()
    rarest = (literal.join(counts, "token", "left")
              .groupBy("rule_no", "way").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("r"))
              .select("rule_no", F.col("r.token").alias("token")))
    by_token = {r["token"]: r["rules"] for r in
                rarest.groupBy("token").agg(F.collect_set("rule_no").alias("rules")).collect()}  # at most one row an alternative
    fetch = F.create_map(*[x for t, nos in sorted(by_token.items()) for x in (F.lit(t), F.array(*map(F.lit, sorted(nos))))]) \
        if by_token else F.create_map().cast("map<string,array<int>>")
    nos = F.array_distinct(F.flatten(F.transform(F.array_intersect("tokens", F.map_keys(fetch)), lambda t: fetch[t])))
    urls = urls.withColumn("nos", nos)
    fits = [(r, F.array_contains("nos", r[0]) & F.col("place").rlike(r[4])) for r in rules]
    site = sorted((x for x in fits if x[0][1] == "site"), key=lambda x: -len(x[0][3]))
    own = [x for x in fits if x[0][1] == "pattern"]

    def first(pairs, value):
        return F.coalesce(*[F.when(ok, F.lit(value(r))) for r, ok in pairs], F.lit(None).cast("string"))

    blocked = [x for x in own if x[0][2] == "block"]
    return urls.withColumn("rule", first(site, lambda r: r[3])).withColumn("pattern", first(blocked, lambda r: r[3])).select(
        "page_id", "host", "path", "rule",
        F.coalesce(first(site, lambda r: r[2]), F.when(F.col("pattern").isNotNull(), F.lit("block")), F.lit("allow")).alias("verdict"),
        "pattern", F.size("nos").alias("n_tested"))


def _literals(rule: str) -> list[str]:
    word, out = "", []
    for c in rule + "/":
        if c.isalnum():
            word += c.lower()
        elif word:
            out.append(word)
            word = ""
    return sorted(set(out))
