"""URL filters by a sort-merge range join.

A host key is the host's labels in reverse, each followed by a separator, so that a host and all its subdomains
are one interval of sorted keys, and nested rules are nested intervals. URLs and rules are sorted together and
swept: a rule brings the stack of the rules around it, the last rule before a URL is at hand in a running window,
and the part of its stack that still holds the URL is active. That finds the hosts with rules above a URL's host;
a second sweep, over (host with rules, path), finds the longest path rule of each. The sort is over ranges that
split any key, however many rows have it; what is carried from one range to the next is one stack per range.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assortment.sources.lineage import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Separators below any character of a key: the path begins, a label ends, an escaped one of these three.
PATH, LABEL, ESCAPE = "\x00", "\x01", "\x02"
BLOCK, ALLOW = "block", "allow"

# The production rules.
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lowered and path; both empty for null and where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    for plain, written in ((ESCAPE, "b"), (LABEL, "a"), (PATH, "c")):
        host = F.replace(host, F.lit(plain), F.lit(ESCAPE + written))
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column) -> Column:
    return F.concat(F.array_join(labels, LABEL), F.lit(LABEL))


def rule_rows(spark: SparkSession, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(verdict, host, path) of rules written as `host/path`."""
    rows = F.array(*(F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules))
    each = spark.range(1).select(F.explode(rows).alias("r")).select("r.verdict", "r.rule")
    host = F.substring_index("rule", "/", 1)
    return each.select("verdict", host.alias("host"), F.substr("rule", F.length(host) + 1, F.length("rule")).alias("path"))


def _stacks(keys: DataFrame, prefixes: Column) -> DataFrame:
    """(key, stack): with each key those keys that are among its prefixes, itself included, shortest first.

    `keys` holds (key, value); the stack holds struct(key, value). `prefixes` lists the candidates.
    """
    wide = keys.select(F.col("key").alias("own"), F.explode(prefixes).alias("key"))
    around = wide.join(keys.select("key", "value"), "key")
    entry = F.struct(F.length("key").alias("length"), F.col("key"), F.col("value"))
    return around.groupBy(F.col("own").alias("key")).agg(F.array_sort(F.collect_list(entry)).alias("stack"))


def sweep(points: DataFrame, stacks: DataFrame) -> DataFrame:
    """Add to each row of `points` (a column `key` and others) `stack`: the entries whose key begins its key."""
    others = [c for c in points.columns if c != "key"]
    nothing = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in others]
    kind = stacks.schema["stack"].dataType
    rows = stacks.select("key", F.lit(0).alias("_point"), "stack", *nothing).unionByName(
        points.select("key", F.lit(1).alias("_point"), F.lit(None).cast(kind).alias("stack"), *others)
    )
    order = ["key", "_point", *others]
    line = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    line = line.withColumn("_range", F.shiftright("_at", 33))

    brought = line.groupBy("_range").agg(F.max_by("stack", F.when(F.col("_point") == 0, F.col("_at"))).alias("last"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = brought.select(F.col("_range").alias("_own"), F.last("last", True).over(earlier).alias("_carried"))
    running = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    swept = line.withColumn("_here", F.last("stack", True).over(running)).where("_point = 1")
    swept = swept.join(F.broadcast(carried), F.col("_range") == F.col("_own"))
    active = F.filter(F.coalesce("_here", "_carried"), lambda rule: F.startswith(F.col("key"), rule["key"]))
    return swept.select("key", *others, active.alias("stack"))


def judged(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", otherwise: str = ALLOW,
) -> DataFrame:
    """(key, host, path, rule, verdict) for each row of `pages`, repeated rows included.

    A rule (verdict, host, path) fits its host and all subdomains where the path starts with the rule's. Of the
    rules that fit, that with the longest host and path together wins, then that with the longer host; of equal
    rules with two verdicts `block` wins. `rule` is null and the verdict `otherwise` where none fits. A null url,
    and one without `://`, has an empty host and path. Rules with a null host are left out, a null path counts
    as empty; without rules all rows get `otherwise`. Other columns are ignored.
    """
    host, path = host_and_path(F.col(url))
    own = cut(pages.select(
        F.col(key).alias("page"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row")
    ))
    known = rules.where(F.col("host").isNotNull()).select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    known = cut(known.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("host_key", _key(_labels(F.col("host")))))

    hosts = known.select(F.col("host_key").alias("key"), F.length("host").alias("value")).distinct()
    parts = F.slice(F.split("key", LABEL), 1, F.size(F.split("key", LABEL)) - 1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: _key(F.slice(parts, 1, n)))
    found = sweep(own.withColumn("key", _key(_labels(F.col("host")))), _stacks(hosts, above))

    rule = F.struct(
        (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"), "verdict",
    )
    paths = known.select(F.concat("host_key", F.lit(PATH), "path").alias("key"), rule.alias("value"), "host_key", "path")
    begins = F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda n: F.concat("host_key", F.lit(PATH), F.substr("path", F.lit(1), n))
    )
    below = found.select("page", "host", "path", "row", F.explode_outer("stack.key").alias("under"))
    below = below.withColumn("key", F.coalesce(F.concat("under", F.lit(PATH), "path"), F.lit(""))).drop("under")
    best = sweep(below, _stacks(paths, begins)).withColumn("best", F.try_element_at("stack", F.lit(-1))["value"])
    out = best.groupBy("row").agg(
        F.first("page").alias(key), F.first("host").alias("host"), F.first("path").alias("path"), F.max("best").alias("best")
    )
    return out.select(
        key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict")
    )
