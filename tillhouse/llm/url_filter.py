"""URL filters: a blocked Bloom filter of listed URLs in front of an exact hash join.

A listed URL is a rule: a host (which also covers its subdomains) and the start of a path. The keys
under which a page could be listed are every domain above its host joined with every start of its
path that has the length of some listed path. A key goes on to the exact join only if the filter
holds all of its bits; the join removes the false positives and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import LOWER, UPPER, repeat_rows, table

COLUMNS = ["page_id", "host", "path", "rule", "verdict"]


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> Column:
    """Four bits of one 64-bit block, from a second hash of the key."""
    second = F.xxhash64(key, F.lit(1))
    bits = F.lit(0).cast("bigint")
    for shift in (0, 6, 12, 18):
        place = F.shiftrightunsigned(second, shift).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return bits


def _fixed(df: DataFrame, kind: str) -> Column:
    """The one array that ``df`` holds, as a constant (higher-order functions take no subqueries)."""
    return F.from_json(F.lit(df.select(F.to_json(F.col(df.columns[0]))).first()[0]), f"array<{kind}>")


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> Column:
    """The filter as an array of ``blocks`` 64-bit blocks: 8 bytes each, whatever the list's length."""
    filled = keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(F.bit_or(_bits(F.col(key))).alias("bits"))
    every = keys.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block")).join(filled, "block", "left")
    rows = F.sort_array(F.collect_list(F.struct("block", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return _fixed(every.agg(F.transform(rows, lambda row: row["bits"]).alias("blocks")), "bigint")


def filter_urls(pages: DataFrame, rules: DataFrame, unlisted: str = "allow", blocks: int = 4096) -> DataFrame:
    """Verdict for every page by the longest rule that fits its url.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the page's path
    starts with the rule's path. The longest host + path wins, then the longer host, then ``block``.
    Pages that no rule fits (null urls and urls without ``://`` have neither host nor path) get
    ``unlisted`` and a null rule. Rules without host or verdict are ignored, a null path is empty.
    Repeated pages stay repeated, other columns of ``pages`` are ignored. ``blocks`` fixes the
    filter's size: a list too long for it only sends more keys to the exact join.
    """
    listed = (
        rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict"))
        .where("rule_host is not null and rule_verdict is not null")
        .withColumn("rule", F.concat("rule_host", "rule_path"))
        .groupBy("rule", "rule_host", "rule_path")
        .agg(F.max("rule_verdict").alias("rule_verdict"))  # of contradictory verdicts, block
    )
    bloom = bloom_filter(listed, "rule", blocks)
    # One length for each different one in the list: no more than the longest path has characters.
    lengths = _fixed(listed.agg(F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths")), "int")

    parsed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(lengths, lambda size: size <= F.length("path"))
    keys = F.flatten(
        F.transform(above, lambda host: F.transform(fitting, lambda size: F.concat(host, F.substr("path", F.lit(1), size))))
    )

    def may_be_listed(key: Column) -> Column:
        wanted = _bits(key)
        return F.element_at(bloom, _block(key, blocks) + 1).bitwiseAND(wanted) == wanted

    judged = parsed.withColumn("hits", F.filter(keys, may_be_listed))
    clear = judged.where("size(hits) = 0").select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(unlisted).alias("verdict")
    )
    longest = F.struct(F.length("rule"), F.length("rule_host"), "rule", "rule_verdict")
    possible = judged.where("size(hits) > 0").select("page_id", "url", "host", "path", F.posexplode("hits").alias("nth", "hit"))
    exact = (
        possible.join(listed, F.col("hit") == F.col("rule"), "left")
        .groupBy("page_id", "url")
        .agg(
            F.first("host").alias("host"),
            F.first("path").alias("path"),
            F.max(F.when(F.col("rule").isNotNull(), longest)).alias("best"),
            F.sum(F.when(F.col("nth") == 0, 1).otherwise(0)).alias("copies"),
        )
    )
    decided = exact.select(
        "page_id", "host", "path", "copies",
        F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(unlisted)).alias("verdict"),
    )
    return clear.unionByName(repeat_rows(decided, "copies", COLUMNS))


RULES = """select * from values
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block') as rules(host, path, verdict)"""


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages"), spark.sql(RULES))


QUERIES = {"op7_url_filter": op7_url_filter}
ORACLE_SQL = {
    "op7_url_filter": f"""
with parsed as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rules(rule_host, rule_path, rule_verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), numbered as (select *, row_number() over () as row_id from parsed),
fitting as (
  select row_id, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by row_id order by length(rule_host || rule_path) desc) as place
  from numbered join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from numbered left join fitting on fitting.row_id = numbered.row_id and place = 1
"""
}
