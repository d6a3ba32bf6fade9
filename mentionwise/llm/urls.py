"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

Every url is expanded into the expressions that a rule fitting it could be: each
suffix of its host at a label, followed by each prefix of its path of a length that
some rule has. Expressions meet rules by an equi-join on the first hex digits of
their SHA-256; the full digest confirms, and the longest rule wins (on a tie the
longer host, then block before allow). Expansion and join run once for each distinct
address, so a hot host or url costs one row.

Edge cases: a null url, or one without ``://``, has empty host and path, and no rule
fits; an empty path fits only rules with an empty path; repeated and null page ids
are judged row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionwise.llm.components import join_counted
from mentionwise.llm.decontamination import BROADCAST_ROWS, lower_ascii
from mentionwise.session import freeze

# hex digits of the digest that the join compares
PREFIX = 8
# copies of each rule in the shuffled join, which is used beyond BROADCAST_ROWS rules
SALTS = 32


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def digests(rules: DataFrame) -> DataFrame:
    """``digest, short, rank, rule, verdict`` of rules (``host, path, verdict``)."""
    text = F.concat("host", "path")
    blocks = (F.col("verdict") == "block").cast("int")
    return rules.select(
        F.sha2(text, 256).alias("digest"), F.left(F.sha2(text, 256), F.lit(PREFIX)).alias("short"),
        F.struct(F.length(text).alias("length"), F.length("host").alias("host_length"), blocks.alias("blocks")).alias("rank"),
        text.alias("rule"), "verdict",
    )


def expressions(address: Column, host: Column, path: Column, lengths: list[int]) -> Column:
    """All host suffixes of an address with all path prefixes of the given lengths."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    cuts = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
    prefixes = F.transform(cuts, lambda n: F.left(path, n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id, url``).

    ``rules``: ``host, path, verdict`` (allow or block).
    """
    # one number for each length that a path of a rule has
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    read = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    read = read.withColumn("address", F.concat("host", "path"))
    known = read.groupBy("address", "host", "path").agg(F.count(F.lit(1)).alias("n"))
    known = freeze(known, "addresses")
    if not lengths:
        return read.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    tried = known.where("host <> ''").select(
        "address", F.explode(expressions(F.col("address"), F.col("host"), F.col("path"), lengths)).alias("expression")
    )
    digest = F.sha2("expression", 256)
    tried = tried.select("address", digest.alias("digest"), F.left(digest, F.lit(PREFIX)).alias("short"))
    listed = digests(rules)
    if listed.count() <= BROADCAST_ROWS:
        met = tried.join(F.broadcast(listed.withColumnRenamed("digest", "full")), "short")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        tried = tried.withColumn("salt", F.pmod(F.xxhash64("address"), F.lit(SALTS)).cast("int"))
        met = tried.join(listed.withColumnRenamed("digest", "full").withColumn("salt", salts), ["short", "salt"])
    best = met.where("digest = full").groupBy("address").agg(
        F.max(F.struct("rank", "rule", "verdict")).alias("best")
    )
    facts = known.join(best, "address", "left").select(
        "address", "n", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
    facts = freeze(facts, "verdicts")
    judged = join_counted(read, facts, "address", "n", read.count())
    return judged.select("page_id", "host", "path", "rule", "verdict")
