"""Secret scans: strong patterns, and weak credential parts that are reported only beside their complements.

Everything is a DataFrame expression.  A kind's matches are found with one regular expression; the text between two
matches is extracted by a second one (anchored where the last match ended, so the rest is passed once), so lengths of gaps and matches give positions by a running sum.  Matches then
become rows (text, kind, start, end).  An identifier, a secret and an endpoint belong together if they lie in one
scope, here at most ``SCOPE`` code points between the end of one and the start of the next: an interval join of the
parts of a text with themselves, computed from the last end of each kind among the parts that start before and its first
start among those that start after, so no pairs are made.  A weak identifier is reported with a strong secret, or
with a weak one and an endpoint; a weak secret likewise with an identifier; an endpoint with one of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, sha256_hex

SCOPE = 200  # code points between parts that belong together, from the end of one to the start of the next
MASK = "[SECRET]"

# Fixed values of the contract, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

# Weak parts: nothing is reported for them alone.
WEAK_ID = r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,40}(?![A-Za-z0-9])"
WEAK_SECRET = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""[a-z][a-z0-9+.-]{0,31}://[^\s"'<>]+"""  # a scheme has a bound, so a long run of letters stays linear

KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = 3  # the first kinds are reported wherever they are


def _matches(text: Column, worth: Column, kind: int, pattern: str, value: int | None, least: int) -> Column:
    """array<struct<kind, at, gap, size, ok>> of all matches of a kind, empty where ``worth`` is false."""
    gaps = F.regexp_extract_all(text, F.lit(f"\\G(?s)(.*?)(?:{pattern})"), F.lit(1))
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    values = found if value is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    one = F.transform(
        F.arrays_zip(gaps.alias("g"), found.alias("m"), values.alias("v")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("at"),
            F.length(x["g"]).cast("long").alias("gap"),
            F.length(x["m"]).cast("long").alias("size"),
            (F.length(x["v"]) >= least).alias("ok"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,at:int,gap:bigint,size:bigint,ok:boolean>>")
    return F.when(worth, one).otherwise(none)


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, one row per input row, with ``n_assign``, ``n_access``, ``n_hex`` and ``spans``.

    ``spans`` is array<struct<start, kind, kind_name, end>> sorted by start and kind, in code points, ends exclusive.
    A null or empty text has none, nor has one whose candidates all fail; rows that repeat each other are kept apart.
    Other columns pass through, but one called like an output is replaced.  An empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in (text, "n_assign", "n_access", "n_hex", "spans")]
    source = docs.select(packed(docs, names).alias("__rest"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"))
    t = F.col("__t")
    source = source.withColumns(
        {
            "__row": F.monotonically_increasing_id(),
            "__a": t.rlike(ASSIGN),
            "__k": t.contains("AKIA"),
            "__h": t.rlike(f"{HEX[:-1]}{{{HEX_LENGTH}}}"),
            "__e": t.contains("://"),
        }
    )
    strong = F.col("__a") | F.col("__k") | F.col("__h")
    parts = F.concat(
        _matches(t, F.col("__a"), 0, ASSIGN, 2, ASSIGN_VALUE),
        _matches(t, F.col("__k"), 1, ACCESS, None, ACCESS_LENGTH),
        _matches(t, F.col("__h"), 2, f"{HEX[:-1]}{{{HEX_LENGTH},}}", None, HEX_LENGTH),
        _matches(t, strong | F.col("__e"), 3, WEAK_ID, None, 1),
        _matches(t, strong | F.col("__e"), 4, WEAK_SECRET, None, 1),
        _matches(t, F.col("__e"), 5, ENDPOINT, None, 1),
    )
    rows = source.select("__row", "__rest", F.explode_outer(parts).alias("p")).select("__row", "__rest", "p.*").repartition("__row")
    running = Window.partitionBy("__row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(running)).withColumn("start", F.col("end") - F.col("size"))
    rows = rows.withColumn("kind", F.when(F.col("ok"), F.col("kind")))  # a failing match keeps its row, so its text stays
    base = F.col("kind") < BASE
    earlier = Window.partitionBy("__row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("__row").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    covered = (F.coalesce(F.max(F.when(base, F.col("end"))).over(earlier), F.lit(-1)) > F.col("start")) | (
        F.coalesce(F.min(F.when(base, F.col("start"))).over(later), F.col("end")) < F.col("end")
    )
    rows = rows.withColumn("covered", covered).where(F.col("kind").isNull() | base | ~F.col("covered"))
    before = Window.partitionBy("__row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("__row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ended = lambda i: F.max(F.when(F.col("kind") == i, F.col("end"))).over(before) >= F.col("start") - SCOPE
    begins = lambda i: F.min(F.when(F.col("kind") == i, F.col("start"))).over(after) <= F.col("end") + SCOPE
    near = {k: F.coalesce(ended(i), F.lit(False)) | F.coalesce(begins(i), F.lit(False)) for i, k in enumerate(KINDS)}
    rows = rows.withColumns({f"near_{k}": c for k, c in near.items()})
    an_id, a_secret = F.col("near_access"), F.col("near_assign") | F.col("near_hex")
    both_weak = F.col("near_weak_id") & F.col("near_weak_secret") & F.col("near_endpoint")
    reported = (
        F.when(F.col("kind") == 3, a_secret | both_weak)
        .when(F.col("kind") == 4, an_id | both_weak)
        .when(F.col("kind") == 5, (an_id | F.col("near_weak_id")) & (a_secret | F.col("near_weak_secret")))
        .otherwise(F.lit(True))
    )
    named = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", "kind", named.alias("kind_name"), "end")
    kept = F.when(F.col("kind").isNotNull() & reported, span)
    count = lambda i: F.count(F.when(F.col("kind") == i, 1))
    whole = (
        rows.withColumn("__span", kept)
        .groupBy("__row")
        .agg(
            F.first("__rest").alias("__rest"),
            count(0).alias("n_assign"),
            count(1).alias("n_access"),
            count(2).alias("n_hex"),
            F.array_sort(F.collect_list("__span")).alias("spans"),
        )
    )
    return whole.select(*[F.col(f"__rest.`{c}`").alias(c) for c in names], "n_assign", "n_access", "n_hex", "spans")


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind_name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] < BASE)
    return found.select(id_col, "n_assign", "n_access", "n_hex", sha256_hex(spans_text(base)).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every reported span replaced by ``MASK``; spans that overlap become one mask.

    The length column, if the table has one, is renewed for changed texts.  Rows without spans are unchanged.
    """
    whole = F.col(f"`{text}`").cast("string")
    key = F.struct(F.xxhash64(F.lit("span"), whole), F.xxhash64(F.lit("text"), whole))  # 128 bits stand for a text
    found = find_spans(docs.select(key.alias("__key"), F.length(whole).alias("__size"), whole.alias("__secret")), "__secret")
    hits = found.where(F.size("spans") > 0).groupBy("__key", "__size").agg(F.first("spans").alias("__spans"))
    moved = docs.select(packed(docs, docs.columns).alias("__rest"), key.alias("__key"), F.length(whole).alias("__size"))
    joined = moved.join(hits, ["__key", "__size"], "left")
    t = F.col(f"__rest.`{text}`").cast("string")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("pieces"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        before = F.substring(t, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["pieces"], F.array(F.concat(before, F.lit(MASK))))).otherwise(acc["pieces"]).alias("pieces"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["pieces"], ""), F.substring(t, (acc["at"] + 1).cast("int"), F.length(t)))

    changed = F.when(F.col("__spans").isNotNull(), F.aggregate("__spans", start, step, finish)).otherwise(t)
    out = joined.withColumn("__new", changed)
    columns = [F.col("__new").alias(c) if c == text else F.col(f"__rest.`{c}`").alias(c) for c in docs.columns]
    if length in docs.columns:
        kind = docs.schema[length].dataType
        fresh = F.when(F.col("__spans").isNotNull(), F.length("__new").cast(kind)).otherwise(F.col(f"__rest.`{length}`"))
        columns = [fresh.alias(c) if c == length else x for c, x in zip(docs.columns, columns, strict=True)]
    return out.select(*columns)
