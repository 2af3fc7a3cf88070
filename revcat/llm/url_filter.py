"""URL rules by host suffix and path prefix.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path
starts with the rule's. Each URL is expanded into one expression per shape of
rule there is (labels of the host, characters of the path), so the number of
expressions does not depend on the URL. Expressions meet the rules on the first
four bytes of a digest; the full digest confirms. The longest rule wins, of equally
long ones that with the longer host.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
case; path: from there up to ``?``, ``#`` or the end. A null URL, or one without
``://``, has neither. Repeated rows are judged one by one. A URL that no rule fits
gets no rule and the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revcat.llm.common import bind, fold

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Hexadecimal digits of the digest that are joined on.
PREFIX = 8
#: So many rules are broadcast (some 200 bytes each); more are joined by a shuffle.
BROADCAST_RULES = 100_000


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    rules = rules.select(fold(F.col("host")).alias("host"), "path", "verdict").distinct()
    shapes = rules.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("chars")).distinct().collect()
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"),
        fold(F.regexp_extract(url, PARTS, 1)).alias("host"), F.regexp_extract(url, PARTS, 2).alias("path"),
    )
    expressions = [
        F.when(
            (F.col("host") != "") & (_labels(F.col("host")) >= s["labels"]) & (F.length("path") >= s["chars"]),
            F.concat(F.substring_index("host", ".", -s["labels"]), F.left("path", F.lit(s["chars"]))),
        )
        for s in shapes
    ]
    each = F.array_compact(F.array(*expressions)) if expressions else F.array().cast("array<string>")
    asked = bind(parts.select("*", F.explode_outer(each).alias("expression")), digest=F.sha2("expression", 256))
    known = rules.select(F.concat("host", "path").alias("rule"), F.length("host").alias("host_chars"), "verdict")
    # A rule given with both verdicts blocks.
    known = known.groupBy("rule", "host_chars").agg(F.max("verdict").alias("verdict"))
    known = known.withColumn("rule_digest", F.sha2("rule", 256)).withColumn("prefix", F.left("rule_digest", F.lit(PREFIX)))
    known = F.broadcast(known) if rules.count() <= BROADCAST_RULES else known
    met = asked.join(known, F.left("digest", F.lit(PREFIX)) == F.col("prefix"), "left")
    fits = F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "verdict")
    best = F.max(F.when(F.col("digest") == F.col("rule_digest"), fits)).alias("best")
    found = met.groupBy("row", "page_id", "host", "path").agg(best)
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
