"""URL filters as a sort-merge range join.

A host becomes its labels in reverse, each closed by a character that sorts before all others, so a host and all its
subdomains are one interval of keys.  URLs and rules are laid out in key order over partitions (by bounds taken from a
bounded sample of keys; the row's hash is part of the order, so one hot host or URL spreads over several), and each
rule is sent to every partition that its interval meets.  A partition is one sorted sweep: rules whose interval
has ended leave the stack, rules that begin are pushed, and a URL looks at the rules on the stack only.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOSE = "\x01"
SAMPLE = 20_000  # keys that the bounds are taken from
DEFAULT = "allow"  # verdict where no rule fits


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the ``/`` that ends the host up to ``?``, ``#`` or the end; empty where none follows the host."""
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*(/[^?#]*)", 1)


def host_key(host: Column) -> Column:
    labels = F.reverse(F.split(F.translate(host, CLOSE, "\x02"), r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, CLOSE), F.lit(CLOSE)))


def _sweep(default: str):
    def best(stack: list[tuple[str, list[tuple[str, str, str]]]], path: str) -> tuple[str | None, str]:
        found = None
        for _, rules in stack:
            for rule_path, rule, verdict in rules:
                if path.startswith(rule_path) and (found is None or (len(rule), rule_path, verdict) > (len(found[0]), found[2], found[1])):
                    found = (rule, verdict, rule_path)
        return (found[0], found[1]) if found else (None, default)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []
        for batch in batches:
            rule, verdict, keep = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("part", "key", "is_url", "path", "rule", "verdict")]
            for i, (p, key, is_url, path, r, v) in enumerate(zip(*columns, strict=True)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if is_url:
                    hit = best(stack, path)
                    rule.append(hit[0])
                    verdict.append(hit[1])
                    keep.append(i)
                elif stack and stack[-1][0] == key:
                    stack[-1][1].append((path, r, v))
                else:
                    stack.append((key, [(path, r, v)]))
            if keep:
                rows = batch.take(pa.array(keep))
                names = [c for c in batch.schema.names if c not in ("part", "key", "is_url", "rule", "verdict")]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in names), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[*names, "rule", "verdict"]
                )

    return run


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", partitions: int | None = None, default: str = DEFAULT) -> DataFrame:
    """``urls`` without the url, with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict.  A rule fits its host and all subdomains if the url's path starts with its
    path; of several the longest (host and path together) wins, then the longer path, then block.  A null url, or one
    without ``://``, has an empty host and path and meets no rule; repeated rows are judged each for itself.
    """
    names = [c for c in urls.columns if c not in (url, "host", "path", "rule", "verdict")]
    u = F.col(f"`{url}`").cast("string")
    passing = urls.select(F.struct(*[F.col(f"`{c}`") for c in names] or [F.lit(1)]).alias("row"), host_of(u).alias("host"), path_of(u).alias("path"))
    passing = passing.withColumns({"key": host_key(F.col("host")), "tie": F.xxhash64("row", "path")})
    spark = urls.sparkSession
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, 2 * SAMPLE / max(1, urls.count()))  # few more than the sample are ordered
    sample = passing.select("key", "tie", F.rand(17).alias("r")).where(F.col("r") < share).orderBy("r").limit(SAMPLE).select("key", "tie").toArrow()
    keys = sorted(zip(sample["key"].to_pylist(), sample["tie"].to_pylist(), strict=True), key=lambda x: (x[0].encode(), x[1]))
    bounds = sorted({(k.encode(), t) for k, t in (keys[len(keys) * i // wanted] for i in range(1, wanted))} if keys else set())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(bounds, (k.encode(), t)) for k, t in zip(batch.column("key").to_pylist(), batch.column("tie").to_pylist(), strict=True)]
            yield batch.append_column("part", pa.array(np.array(at, dtype=np.int32)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, last = [], []
            for k in batch.column("key").to_pylist():
                first.append(bisect_right(bounds, (k.encode(), -(2**63) - 1)))
                last.append(bisect_right(bounds, (k.encode() + b"\xff", 0)))
            out = batch.append_column("first", pa.array(np.array(first, dtype=np.int32)))
            yield out.append_column("last", pa.array(np.array(last, dtype=np.int32)))

    def with_fields(df: DataFrame, *more: str) -> str:
        return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *more])

    placed = passing.mapInArrow(place, with_fields(passing, "part int"))
    own = rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host is not null and host <> ''").distinct()
    own = own.withColumns({"key": host_key(F.col("host")), "rule": F.concat("host", "path")})
    dealt = own.mapInArrow(spread, with_fields(own, "first int", "last int")).withColumn("part", F.explode(F.sequence("first", "last")))
    row_type = passing.schema["row"].dataType.simpleString()
    both = placed.select("part", "key", F.lit(True).alias("is_url"), "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"), "row", "host").unionByName(
        dealt.select("part", "key", F.lit(False).alias("is_url"), "path", "rule", "verdict", F.lit(None).cast(row_type).alias("row"), "host")
    )
    ordered = both.repartitionByRange(wanted, "part").sortWithinPartitions("part", "key", "is_url")
    out = ordered.mapInArrow(_sweep(default), f"path string, row {row_type}, host string, rule string, verdict string")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "host", "path", "rule", "verdict")
