"""URL rules as a sort-merge range join over reversed-host keys, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lies between host and path in a key; sorts before all else.
GAP = "\u0000"


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (after the first ://, up to /, ?, # or the end, A-Z in lower case) and path (then
    up to ?, # or the end); both are empty for a null url and one without ://."""
    at = F.coalesce(F.instr(F.col(url), "://"), F.lit(0))
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def nested_rules(rules: DataFrame) -> DataFrame:
    """A rule's key with the stack of rules whose keys begin it, outermost first, itself last.

    The key is the host's labels in reverse, then the path; a rule covers the interval of keys that
    begin with its own. A rule has at most as many others around it as its key has characters.
    """
    labels = F.reverse(F.split("host", r"\."))
    keyed = (
        rules.where(F.col("host").isNotNull() & (F.col("host") != "") & F.col("path").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat(F.array_join(labels, "."), F.lit(GAP), "path").alias("key"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        )
    )
    begins = keyed.select(
        "key", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.left(F.col("key"), n))).alias("begin")
    )
    outer = keyed.select(F.col("key").alias("begin"), "rule", "verdict")
    level = F.struct(F.length("begin").alias("depth"), "begin", "rule", "verdict")
    return begins.join(outer, "begin").groupBy("key").agg(F.sort_array(F.collect_list(level)).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int | None = None) -> DataFrame:
    """The verdict on every url: page_id, host, path, rule, verdict.

    ``rules``: host, path, verdict. A rule fits its host and all its subdomains if the path begins
    with the rule's; the longest rule (host and path together) wins, among equally long ones the
    last by text; of two verdicts on one rule the last by name. Without a rule that fits, rule is
    null and verdict is ``default``. Rules without host or path fit nothing.

    Each url asks once for its host and once for each parent domain that a rule could name. Rules
    and askings are sorted together by key. The sweep takes along the stack of the rule that began
    last: every rule around an asking is on it. A salt deals the askings out, whatever their host;
    each salt gets all rules, which ``salts`` (shuffle partitions, unless given) so multiplies.

    A null url, or one without ://, has an empty host and path and no rule. Null ids stay; repeated
    rows are judged each; other columns are dropped; empty tables give no rows, or no rules.
    """
    spark = pages.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    asked = with_host_and_path(pages.select("page_id", "url"))
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    asked = asked.withColumn("labels", F.reverse(F.split("host", r"\.")))
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size("labels"), F.lit(deepest)))),
        lambda n: F.concat(F.array_join(F.slice(F.col("labels"), 1, n), "."), F.lit(GAP), F.col("path")),
    )
    asked = asked.select("salt", "page_id", "url", "host", "path", F.posexplode(domains).alias("nth", "key"))
    nested = nested_rules(rules)
    none = F.lit(None)
    dealt = nested.select(
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        *(none.cast(t).alias(c) for c, t in asked.dtypes if c not in ("salt", "key")),
        "key",
        "stack",
    )
    stack_type = nested.schema["stack"].dataType
    swept = asked.withColumn("stack", none.cast(stack_type)).unionByName(dealt)
    order = Window.partitionBy("salt").orderBy("key", F.col("nth").isNotNull())
    swept = swept.withColumn("stack", F.last("stack", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    around = F.filter("stack", lambda s: F.startswith(F.col("key"), s["begin"]))
    top = F.try_element_at(around, F.lit(-1))
    best = F.struct(F.length(top["rule"]).alias("length"), top["rule"].alias("rule"), top["verdict"].alias("verdict"))
    swept = swept.where("nth is not null").withColumn("best", F.when(top["rule"].isNotNull(), best))
    row = Window.partitionBy("salt", "page_id", "url")
    judged = swept.withColumn("best", F.max("best").over(row)).where("nth = 0")
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
