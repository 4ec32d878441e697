"""URL allow and block rules by a sort-merge range join, in DataFrame operations only.

A host is written with its labels reversed (``org.example.www``), so that a domain and its path are a prefix of all
keys it covers, i.e. an interval of the sort order. As a rule on a host also covers its subdomains, a url has one
key for each of its parent domains: ``org/p``, ``org.example/p``, ``org.example.www/p``. Rule starts and keys
are sorted together and swept: each rule start carries the stack of rules that are open there
(itself and the rules it is nested in), and a key takes the stack of the last start before it. Prefix intervals are nested
or apart, so every rule that covers the key is on that stack.

A window sweeps one (top-level label, salt) at a time. The number of salts of a label follows its
number of keys, and its rules are copied to each salt, so a host with most of the rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RULES_SCHEMA = "host string, path string, verdict string"
# Ends a host in a key. It sorts below every character of a host, so the paths of a domain come before its subdomains.
_END = "\x01"
# Keys of one sweep, about.
SWEEP_ROWS = 4_096


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what stands after the first ``://`` up to ``/ ? #``, in lower-case ASCII; then up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(F.regexp_extract(rest, r"(?s)^([^?#]*)", 1), F.lit(""))
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, F.substring(rest, F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise("")
    return lower_ascii(host), path


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    ``rules`` has ``host, path, verdict``. A rule covers its host and all its subdomains where the url's path starts with
    its own; of several the longest host wins, then the longest path. ``rule`` is host and path of the
    winner, or null, and then ``verdict`` is ``default``. A null url, or one without ``://``, has
    empty host and path and no rule. Repeated rows are judged each, and a null id stays null; other columns are
    ignored; empty tables are allowed on both sides. A rule listed twice counts once; of two verdicts
    for the same host and path the smaller text (allow before block) holds; rules with a null are ignored.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select(pages[f"`{id_col}`"].alias("page_id"), pages[f"`{url_col}`"].alias("url"))
    urls = urls.select("page_id", host.alias("host"), path.alias("path"))
    # Equal (host, path) pairs are swept once.
    labels = F.reverse(F.split("host", r"\.", -1))
    keys = (
        urls.filter("host <> ''").groupBy("host", "path").agg(F.count("*").alias("n"))
        .select("host", "path", labels.alias("labels"))
        .select("host", "path", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("depth"))
        .select(
            "host", "path", F.col("labels")[0].alias("top"),
            F.concat(F.array_join(F.slice("labels", 1, F.col("depth")), "."), F.lit(_END), "path").alias("key"),
        )
    )
    known = (
        rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").dropna()
        .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
        .withColumn("labels", F.reverse(F.split("host", r"\.", -1)))
        .select(
            F.col("labels")[0].alias("top"),
            F.concat(F.array_join("labels", "."), F.lit(_END), "path").alias("key"),
            F.struct(
                F.length("host").alias("host_length"), F.length("path").alias("path_length"),
                F.concat("host", "path").alias("rule"), "verdict",
            ).alias("found"),
        )
    )
    opened = stacks(known)
    # Salts of a top-level label: counted per label, so one row for each label that has rules.
    salts = (
        keys.groupBy("top").agg(F.count("*").alias("keys"))
        .join(opened.select("top").distinct(), "top", "left_semi")
        .select("top", F.ceil(F.col("keys") / SWEEP_ROWS).cast("int").alias("salts"))
    )
    spread = keys.join(salts, "top").withColumn(
        "salt", F.pmod(F.xxhash64("host", "path"), F.col("salts")).cast("int")
    )
    copied = opened.join(salts, "top").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    stack_type = opened.schema["stack"].dataType
    # One column for both, or Spark would sweep in place after the join on the label alone.
    lane = F.concat_ws("\x02", "top", "salt").alias("lane")
    events = copied.select(
        lane, "key", F.lit(0).alias("kind"), "stack",
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
    ).unionByName(
        spread.select(lane, "key", F.lit(1).alias("kind"), F.lit(None).cast(stack_type).alias("stack"), "host", "path")
    )
    sweep = Window.partitionBy("lane").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    covering = F.filter("open", lambda r: F.startswith(F.col("key"), r["key"]))
    winners = (
        events.withColumn("open", F.last("stack", ignorenulls=True).over(sweep))
        .filter("kind = 1 AND open IS NOT NULL")
        .select("host", "path", F.array_max(F.transform(covering, lambda r: r["found"])).alias("found"))
        .groupBy("host", "path").agg(F.max("found").alias("found"))
        .filter("found IS NOT NULL")
    )
    return urls.join(winners, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )


def stacks(known: DataFrame) -> DataFrame:
    """Each rule with the rules that are open at its start: itself and those whose key begins its own.

    A rule's parents are found by equality: one lookup for each beginning of its key, at most as many as it has characters.
    """
    starts = known.select("top", "key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(
        "top", "key", F.expr("left(key, n)").alias("parent")
    )
    parents = known.select(F.col("top").alias("parent_top"), F.col("key").alias("parent"), "found")
    joined = starts.join(parents, (starts["parent"] == parents["parent"]) & (starts["top"] == parents["parent_top"]))
    entry = F.struct(parents["parent"].alias("key"), F.col("found"))
    return joined.groupBy("top", starts["key"]).agg(F.sort_array(F.collect_list(entry)).alias("stack"))
