"""URL filters: rules first, then logistic regression on hashed character n-grams (operator 4, native).

Everything runs on DataFrame functions and Spark's own feature hashing and logistic regression; no Python
runs on the executors. The labelled table is small by contract and fits one partition; the table that is
judged is only projected, never shuffled.
"""

from __future__ import annotations

import string
import zlib
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path) of the rules that the contract states.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: A small labelled table: names of sites to block and to let through, and paths that speak for either. Names with paths that say nothing,
#: and paths on sites that say nothing, teach host and path apart.
BLOCKED = """
cheap-meds discount-pills pills-online cheap-tablets viagra-store link-farm content-spam seo-spam spam-mail spam-network online-casino
casino-slots casino-bonus poker-slots sport-bets bets-live bets-today free-spins adult-cams adult-video adult-live xxx-video xxx-cams ad-tracker
ads-network track-clicks click-ads popup-ads ads-server free-crack keygen-warez torrent-warez fast-loans payday-loans win-prize free-prize
followers-cheap replica-watches click-farm win-big hot-xxx cheap-replica
""".split()
CLEAN = """
library weather gardening museum university almanac traveller recipes thenews archive thinking software theatre history station
government health encyclopedia thunder school thread nation sports photos music thethird books city-council north-valley old-bridge
tea-house data-science open-source handbook motion freedom winter pilgrim farmers address mathematics anthology education
northern tradition rhythm lighthouse another clothing weathering bathing foundation together
""".split()
BLOCKED_PATHS = """
/buy-viagra-online /casino/free-spins /xxx/cams/live /adult/video/hot /win-prize/now /cheap-meds/order /payday-loan/apply /crack/keygen.exe
/click/ads/redirect /poker-bonus /bets/live-odds /replica-watches/sale
""".split()
CLEAN_PATHS = """
/docs/introduction /news/science/article /about/history /recipes/bread-and-butter /courses/mathematics /research/papers/index /library/catalogue
/sports/results /weather/forecast /council/meetings/minutes /travel/guide/mountains /books/reviews
""".split()
PLAIN_SITES = ("https://files.example.net", "http://www.node.example.com", "https://s3.example.org")
SITES = ("https://{}.example.net", "http://www.{}.example.com", "https://blog.{}.example.org", "http://m.{}.example.com", "https://{}.example.org")
PATHS = ("/en/44", "/fr/825?page=2&ref=x", "/en/685.html", "/de/12/", "/es/960#top", "/en/7", "/en/474?utm_source=feed")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null. The rules are a short list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def grams(text: Column, mark: str, sizes: tuple[int, ...] = (3, 4)) -> Column:
    """Character n-grams with ``^`` and ``$`` at the ends; ``mark`` keeps those of host and path apart."""
    whole = F.concat(F.lit("^"), text, F.lit("$"))
    each = [F.when(F.length(whole) >= n, F.transform(F.sequence(F.lit(1), F.length(whole) - n + 1), lambda i, n=n: F.concat(F.lit(mark), whole.substr(i, F.lit(n))))).otherwise(F.array().cast("array<string>")) for n in sizes]
    return reduce(F.concat, each)


def labelled_names() -> list[tuple[str, list[str], float]]:
    """Each name or path of the table with its urls and its label."""
    out = [(name, [site.format(name) + PATHS[(i + k) % len(PATHS)] for k, site in enumerate(SITES)], v) for v, names in ((1.0, BLOCKED), (0.0, CLEAN)) for i, name in enumerate(names)]
    return out + [(path, [site + path for site in PLAIN_SITES], v) for v, paths in ((1.0, BLOCKED_PATHS), (0.0, CLEAN_PATHS)) for path in paths]


def labelled_urls(spark: SparkSession, part: str = "all") -> DataFrame:
    """The small table above as url, label. ``part``: all, or learn and held_out, a fifth of the names drawn by their checksum with all their urls."""
    wanted = {"all": range(5), "learn": range(1, 5), "held_out": (0,)}[part]
    rows = ", ".join(f"('{u}', {v}D)" for name, urls, v in labelled_names() if zlib.crc32(name.encode()) % 5 in wanted for u in urls)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, label)")


def fit(labelled: DataFrame, features: int = 1 << 14):
    """Logistic regression over url, label (1: block); returns a function that adds ``p_block``."""
    tf = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=features, binary=True)

    def ready(df: DataFrame) -> DataFrame:
        # The top-level name says nothing of a site.
        host, path = url_parts(F.col("url"))
        site = F.regexp_replace(host, r"(\.[^.]*)$", "")
        return tf.transform(df.withColumn("_grams", F.concat(grams(site, "h:"), grams(path, "p:"))))

    # Both labels weigh the same, however many urls have each.
    share = labelled.agg(F.avg("label")).first()[0]
    weight = F.when(F.col("label") == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9))
    learner = LogisticRegression(featuresCol="_features", labelCol="label", weightCol="_weight", regParam=0.003, maxIter=40, standardization=False, aggregationDepth=2)
    table = ready(labelled.coalesce(1)).select("label", weight.alias("_weight"), "_features").cache()
    model = learner.fit(table)
    table.unpersist()
    model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
    return lambda df: model.transform(ready(df)).withColumn("p_block", vector_to_array("_p")[1]).drop("_grams", "_features", "_p")


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, p_block.

    verdict: the longest fitting rule's, else block if the model gives p_block of 0.5 or more, else allow. Null
    urls and such without ``://`` have empty host and path, fit no rule and are judged by the model like any other. Repeated rows
    all come out; further columns are not carried; an empty table gives an empty table.
    """
    host, path = url_parts(F.col("url"))
    scored = fit(labelled)(pages.select("page_id", "url"))
    found = rule_of(F.col("host"), F.col("path"), rules)
    out = scored.select("page_id", host.alias("host"), path.alias("path"), "p_block").withColumn("_rule", found)
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "p_block")
