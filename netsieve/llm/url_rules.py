"""URL rules as a range join: sorted keys, intervals of prefixes and a stack of nested rules."""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS = 200_000  # rows of a range, on average
SAMPLE = 20_000  # keys that set the ranges, in expectation
KEY_CHARS = 256  # of a key, where ranges are set


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    The host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in
    lower case; the path goes on up to ``?``, ``#`` or the end. Both are empty for a null url or
    one without ``://``. ``rules`` has ``host, path, verdict``: a rule fits its host and all
    subdomains if the path starts with the rule's; of several the longest host wins, then the
    longest path. ``rule`` is host and path of the winner, else null, and ``verdict`` its
    verdict or ``otherwise``. Of rules that repeat host and path the first by verdict holds;
    rules with a null or empty host, or a null path or verdict, fit nothing.

    Keys are hosts with their labels reversed, each followed by a dot, so a rule's host is a
    prefix and covers an interval of keys. Urls and rules are sorted together, a rule before
    the urls it covers; a sweep keeps the rules whose interval is open on a stack. The order is
    cut into ranges at keys of a sample and a hash, so a host with a third of all rows spreads
    over several; a rule goes to every range that its interval touches. The sample sets where
    to cut and nothing else. Repeated rows are judged each; an empty table gives an empty
    result; columns named like a result give way to it.
    """
    gone = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c.lower() not in gone]
    start = F.locate("://", F.col(url_col))
    rest = F.when(start > 0, F.expr(f"substring(`{url_col}`, locate('://', `{url_col}`) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.struct(*[f"`{c}`" for c in kept]).alias("row"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", _key("host")).withColumn("salt", F.abs(F.xxhash64("row", "path") % 1_000_000))
    fits = F.col("host").isNotNull() & (F.col("host") != "") & F.col("path").isNotNull() & F.col("verdict").isNotNull()
    rules = rules.where(fits).groupBy("host", "path").agg(F.min("verdict").alias("verdict")).withColumn("key", _key("host"))

    n = rows.count()
    ranges = max(pages.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS))
    cuts = _cuts(rows, n, ranges)
    row_type = rows.schema["row"].dataType.simpleString()
    shape = f"part int, key string, kind int, row {row_type}, host string, path string, verdict string"
    both = rows.select("key", F.lit(1).alias("kind"), "row", "host", "path", F.lit(None).cast("string").alias("verdict"), "salt")
    both = both.union(
        rules.select("key", F.lit(0), F.lit(None).cast(rows.schema["row"].dataType), "host", "path", "verdict", F.lit(0).cast("long"))
    )
    dealt = both.mapInArrow(_dealer(cuts), shape).repartition(len(cuts) + 1, "part").sortWithinPartitions("part", "key", "kind")
    out = dealt.mapInArrow(_sweeper(otherwise), f"row {row_type}, host string, path string, rule string, verdict string")
    return out.select(*[F.col(f"row.`{c}`") for c in kept], "host", "path", "rule", "verdict")


def _key(host):
    labels = F.reverse(F.split(F.col(host), r"\."))
    return F.when(F.col(host) == "", "").otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


def _cuts(rows, n, ranges) -> list[tuple[str, int]]:
    """Where one range ends and the next begins, as (key, salt)."""
    share = min(SAMPLE / max(n, 1), 1.0)
    some = rows.where(F.pmod(F.xxhash64("key", "salt", "path"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    keys = sorted((r[0], r[1]) for r in some.select(F.substring("key", 1, KEY_CHARS), "salt").collect())
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def _dealer(cuts):
    """Adds the range of each url and of each range that a rule touches."""

    def run(batches):
        for batch in batches:
            keys, kinds, salts = (batch.column(k).to_pylist() for k in (0, 1, 6))
            at, parts = [], []
            for k, (key, kind, salt) in enumerate(zip(keys, kinds, salts, strict=True)):
                first = bisect_right(cuts, (key[:KEY_CHARS], salt if kind else -1))
                last = first if kind else bisect_right(cuts, (key + chr(0x10FFFF), 0))
                for part in range(first, last + 1):
                    at.append(k)
                    parts.append(part)
            chosen = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), *[chosen.column(k) for k in (0, 1, 2, 3, 4, 5)]],
                ["part", "key", "kind", "row", "host", "path", "verdict"],
            )

    return run


def _sweeper(otherwise):
    def run(batches):
        stack: list[tuple[str, dict, list]] = []  # key, verdicts by path, path lengths
        part = None
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (0, 1, 2, 4, 5, 6)]
            rule_of, verdict_of, urls = [], [], []
            for k, (p, key, kind, host, path, verdict) in enumerate(zip(*columns, strict=True)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    stack[-1][1][path] = (host + path, verdict)
                    stack[-1][2][:] = sorted({len(x) for x in stack[-1][1]}, reverse=True)
                    continue
                found = next((rules[path[:n]] for _, rules, sizes in reversed(stack) for n in sizes if path[:n] in rules), (None, otherwise))
                urls.append(k)
                rule_of.append(found[0])
                verdict_of.append(found[1])
            chosen = batch.take(pa.array(urls, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [chosen.column(3), chosen.column(4), chosen.column(5), pa.array(rule_of, pa.string()), pa.array(verdict_of, pa.string())],
                ["row", "host", "path", "rule", "verdict"],
            )

    return run
