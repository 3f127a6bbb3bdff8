"""Mixing sources to target weights by Pareto order sampling (DataFrame
functions only).

Targets: every source gets a share of the wanted words by its weight; a target
stops at ``cap`` times its source's size and the excess goes to the others by
weight, until none is above (water-filling over the table of sources).

Copies: a document is expected ``e = min(cap, c * w)`` times, ``w`` growing with the
root of its size and ``c`` such that the source's expected words meet its target
(water-filling again, over the few distinct ``w`` of a source). ``floor(e)`` whole
copies are certain. What is left of ``e`` is the document's inclusion probability
``p`` for one more: documents are ranked by random odds divided by inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and a source takes as many from the start of that
order as fit into the words that its target still lacks: a sample of fixed size in
words. What the next document would exceed goes to shorter ones in the same order,
in up to ``PASSES - 1`` more passes, so that a target is also met where a few long
documents hold most words.

Scale: texts are read once, for their sizes. The order is cut without sorting a
source: sizes are summed by buckets of the key (two levels of 1024), only the bucket in which
the cut falls is ranked, which holds about a millionth of its source. A source may hold any
share of the rows: its documents stay where they are, its sums are combined before they move. Tables
of sources and of their distinct ``w`` are broadcast behind a check of their size.

Random numbers are digests of the seed and the id (of the text for a null id), so
reruns agree. Defined cases: null text has size 0, a document of size 0 is taken 0
words; a null source is a source of its own, the last; repeated ids are documents of
their own that share a random number; rows equal in id and size are ranked in any order,
which doesn't show in the result; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordform.llm.common import table, written
from wordform.llm.order import numbered
from wordform.operators.joins import bounded_broadcast

WEIGHTS, CAP, PERCENT, SEED = (5, 2, 1), 3, 100, 2024
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a key's bucket; half of them are its coarse bucket.
BUCKET_BITS = 20
NO_CUT = 1 << (BUCKET_BITS + 1)
#: The second pass over a source's order takes documents of at most an eighth of the
#: gap; it and the last document are for gaps of more than a thousandth of the target.
PASSES, SHORTER, NEAR = 2, 8, 1000


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, w, u): words, selection weight and random number in (0, 1)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("null:"), F.md5(t)))
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), who)), 1, 13), 16, 10).cast("long")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"), ((h + F.lit(0.5)) / F.lit(float(1 << 52))).alias("u"),
    )
    return rows.withColumn("w", F.ceil(F.sqrt("size")).cast("long"))


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, percent: int = PERCENT) -> DataFrame:
    """``sources`` (source, source_size) with ``sid`` (1, 2, 3... by code point, null
    last) and ``target``. Each round of the water-filling is one sum over sources."""
    rows = numbered(sources, F.col("source").isNull(), "source", out="sid")
    pattern = F.array(*[F.lit(w).cast("long") for w in weights])
    rows = rows.withColumn("weight", F.element_at(pattern, ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * percent / 100
    full, stopped, level = F.lit(False), -1, 0.0
    while True:
        held, weight, n = rows.agg(
            F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)
        ).first()
        if n == stopped or not weight:
            break
        stopped, level = n, (total - cap * (held or 0)) / weight
        full = F.col("weight") * F.lit(level) >= F.col("source_size") * F.lit(cap)
    most = (F.col("source_size") * cap).cast("double")
    return rows.withColumn("target", F.least(F.col("weight") * F.lit(level), most)).drop("weight")


def with_copies(classes: DataFrame, cap: int = CAP) -> DataFrame:
    """``classes`` (sid, target, w, words) with ``copies``, the probability ``p`` of
    one more, and ``rest``, the words that the source's target lacks after them.
    The windows hold a source's distinct ``w``."""
    of = Window.partitionBy("sid")
    down = of.orderBy(F.col("w").desc())
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("w") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    rows = classes.where("w > 0").withColumn("level", (F.col("target") - above * cap) / below)
    # the largest w that the cap doesn't stop; the smallest if it stops all
    fits = (F.col("level") * F.col("w") <= cap) | (F.col("w") == F.min("w").over(of))
    rows = rows.withColumn("level", F.max(F.when(fits, F.struct("w", "level"))).over(of)["level"])
    expected = F.least(F.lit(float(cap)), F.col("level") * F.col("w"))
    rows = rows.withColumn("copies", F.floor(expected)).withColumn("p", expected - F.floor(expected))
    rest = F.col("target") - F.sum(F.col("copies") * F.col("words")).over(of)
    return rows.select("sid", "w", "copies", "p", rest.alias("rest"))


def cut(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Where each source's order passes its budget of words: (sid, got, bucket,
    last). The rows of lower buckets are in, and those of that bucket up to ``last``
    (null: none); ``got`` is their words. ``rows``: sid, size, bucket, place."""
    budgets, _ = bounded_broadcast(budgets)
    half = BUCKET_BITS // 2

    def passed(sums: DataFrame, start: str) -> DataFrame:
        """First bucket that exceeds the budget, and the words before it."""
        upto = F.sum("size").over(Window.partitionBy("sid").orderBy("b")) + F.col(start)
        sums = sums.withColumn("upto", upto)
        over = F.min(F.when(F.col("upto") > F.col("budget"), F.struct("b", (F.col("upto") - F.col("size")).alias("before"))))
        return sums.groupBy("sid", "budget").agg(over.alias("over"), F.max("upto").alias("all"))

    coarse = rows.groupBy("sid", F.shiftright("bucket", half).alias("b")).agg(F.sum("size").alias("size"))
    coarse = written(passed(coarse.join(budgets, "sid").withColumn("zero", F.lit(0)), "zero"), "coarse-cuts")
    whole = coarse.where("over is null").select("sid", F.col("all").alias("got"), F.lit(NO_CUT).cast("long").alias("bucket"))
    at, _ = bounded_broadcast(coarse.where("over is not null").select("sid", "budget", "over.b", "over.before"))
    fine = rows.join(at.withColumnRenamed("b", "c"), "sid").where(F.shiftright("bucket", half) == F.col("c"))
    fine = fine.groupBy("sid", "budget", "before", F.col("bucket").alias("b")).agg(F.sum("size").alias("size"))
    fine = written(passed(fine, "before").select("sid", "budget", "over.b", "over.before"), "fine-cuts")
    at, _ = bounded_broadcast(fine)
    inside = rows.join(at, "sid").where(F.col("bucket") == F.col("b"))
    upto = F.sum("size").over(Window.partitionBy("sid").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    inside = inside.withColumn("upto", upto)
    fits = F.col("upto") <= F.col("budget")
    last = inside.groupBy("sid", F.col("b").alias("bucket"), "before").agg(
        F.max(F.when(fits, F.col("upto"))).alias("upto"), F.max(F.when(fits, F.col("place"))).alias("last")
    )
    last = last.select("sid", F.coalesce("upto", "before").alias("got"), "bucket", "last")
    return last.unionByName(whole, allowMissingColumns=True)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row:
    the mix takes ``copies`` times the document, ``taken`` words in all."""
    rows = written(sized(docs, doc_id, source, text, seed), "sized")
    classes = written(rows.groupBy("source", "w").agg(F.sum("size").alias("words")), "classes")
    sources = written(with_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap, percent), "sources")
    # source by source; the few rows of a class meet one row of its source
    classes = classes.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source")))
    ids = classes.select("source", "sid", "w", "target", "words")
    plan = written(ids.join(with_copies(ids, cap), ["sid", "w"], "left").drop("words"), "plan")
    per_class, _ = bounded_broadcast(plan.select(F.col("source").alias("of"), "sid", F.col("w").alias("cw"), "copies", "p"))
    odds = lambda x: x / (F.lit(1.0) - x)
    key = F.when(F.col("p") > 0, odds(F.col("u")) / odds(F.col("p")))
    keyed = rows.join(per_class, F.col("source").eqNullSafe(F.col("of")) & (F.col("w") == F.col("cw")))
    keyed = keyed.withColumn("key", key).select(
        "sid", "doc_id", "size", F.coalesce("copies", F.lit(0)).alias("copies"), "key",
        F.floor(F.col("key") / (F.col("key") + F.lit(1.0)) * F.lit(float(1 << BUCKET_BITS))).alias("bucket"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = written(keyed, "keyed").withColumn("place", F.struct("key", "doc_id", "size", "row")).withColumn("more", F.lit(False))
    left = written(plan.where("rest is not null").groupBy("sid", "target").agg(F.max("rest").alias("gap")), "gaps")
    free = F.col("key").isNotNull() & ~F.col("more")
    for i in range(PASSES + 1):
        if i:
            left = written(left.where(F.col("gap") * NEAR > F.col("target")), "gaps")
            if left.isEmpty():
                break
        if i == PASSES:
            gaps, _ = bounded_broadcast(left.select("sid", "gap"))
            near = F.abs(F.col("size") - F.col("gap"))
            one = keyed.where(free).join(gaps, "sid").where(near < F.col("gap")).groupBy("sid").agg(F.min(F.struct(near.alias("near"), "place")).alias("one"))
            found, _ = bounded_broadcast(written(one.select("sid", "one.place.row"), "nearest"))
            keyed = keyed.join(found.select(F.col("sid").alias("s"), F.col("row").alias("r")), (F.col("sid") == F.col("s")) & (F.col("row") == F.col("r")), "left")
            keyed = keyed.withColumn("more", F.col("more") | F.col("r").isNotNull()).drop("s", "r")
            break
        most = F.floor(F.col("gap") / SHORTER) if i else F.lit((1 << 63) - 1)
        budgets = left.select("sid", F.col("gap").alias("budget"), most.alias("longest"))
        longest, _ = bounded_broadcast(budgets.select("sid", "longest"))
        order = keyed.where(free).join(longest, "sid").where(F.col("size") <= F.col("longest"))
        cuts = written(cut(order, budgets.drop("longest")), "cuts")
        found, _ = bounded_broadcast(cuts.join(budgets, "sid").select("sid", F.col("bucket").alias("b"), "last", "longest"))
        inside = (F.col("bucket") < F.col("b")) | ((F.col("bucket") == F.col("b")) & (F.col("place") <= F.col("last")))
        inside = F.coalesce(inside & (F.col("size") <= F.col("longest")), F.lit(False))
        keyed = keyed.join(found, "sid", "left").withColumn("more", F.col("more") | inside).drop("b", "last", "longest")
        left = left.join(cuts.select("sid", "got"), "sid", "left").withColumn("gap", F.col("gap") - F.coalesce("got", F.lit(0))).drop("got")
    per_source, _ = bounded_broadcast(sources)
    out = keyed.withColumn("copies", F.col("copies") + F.col("more").cast("long")).join(per_source, "sid")
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _pass_sql(i: int) -> str:
    """One pass over the order of each source."""
    before = "ordered" if i == 0 else f"taken{i - 1}"
    gap, longest = ("rest", "9223372036854775807") if i == 0 else (f"gap{i - 1}", f"floor(gap{i - 1} / {SHORTER})")
    near = "TRUE" if i == 0 else f"{gap} * {NEAR} > target"
    return f"""
), free{i} AS (
  SELECT r, sum(size) OVER (PARTITION BY sid ORDER BY key, doc_id NULLS FIRST, size, r ROWS UNBOUNDED PRECEDING) <= {gap} AS fits
  FROM {before} WHERE p > 0 AND NOT more AND {near} AND size <= {longest}
), taken{i} AS (
  SELECT o.* REPLACE (o.more OR coalesce(f.fits, FALSE) AS more),
         o.{gap} - sum(CASE WHEN coalesce(f.fits, FALSE) THEN o.size ELSE 0 END) OVER (PARTITION BY o.sid) AS gap{i}
  FROM {before} o LEFT JOIN free{i} f USING (r)"""


OP13_SQL = rf"""
WITH sized AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         (CAST('0x' || substr(md5('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
), weighed AS (SELECT *, CAST(ceil(sqrt(size)) AS BIGINT) AS w FROM sized
), totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM weighed GROUP BY source
), sources AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM totals
), filling AS (  -- sources that the cap stops first come first
  SELECT *, row_number() OVER f AS k, coalesce(sum(source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others
  FROM sources WINDOW f AS (ORDER BY 3 * source_size / weight::DOUBLE, sid)
), leveled AS (SELECT *, ((SELECT sum(source_size) FROM totals) - 3 * held)::DOUBLE / others::DOUBLE AS level FROM filling
), level AS (SELECT level FROM leveled WHERE level * weight < 3 * source_size ORDER BY k LIMIT 1
), targets AS (
  SELECT source, source_size, sid, CAST(least(coalesce((SELECT level FROM level), 0) * weight, (3 * source_size)::DOUBLE) AS DOUBLE) AS target FROM sources
), classes AS (
  SELECT t.sid, t.target, d.w, sum(d.size) AS words FROM weighed d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source WHERE d.w > 0 GROUP BY ALL
), levels AS (
  SELECT *, (target - 3 * coalesce(sum(words) OVER (d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(w * words) OVER (d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS own, w = min(w) OVER (PARTITION BY sid) AS least_w
  FROM classes WINDOW d AS (PARTITION BY sid ORDER BY w DESC)
), chosen AS (SELECT sid, max_by(own, w) AS c FROM levels WHERE own * w <= 3 OR least_w GROUP BY sid
), expected AS (SELECT l.*, least(3::DOUBLE, c.c * l.w) AS e FROM levels l JOIN chosen c USING (sid)
), planned AS (
  SELECT sid, w, CAST(floor(e) AS BIGINT) AS copies, e - floor(e) AS p, target - (sum(CAST(floor(e) AS BIGINT) * words) OVER (PARTITION BY sid))::DOUBLE AS rest
  FROM expected
), ordered AS (
  SELECT d.r, d.doc_id, d.size, t.sid, t.source_size, t.target, coalesce(p.copies, 0) AS copies, coalesce(p.p, 0) AS p, p.rest, FALSE AS more,
         CASE WHEN p.p > 0 THEN (d.u / (1 - d.u)) / (p.p / (1 - p.p)) END AS key
  FROM weighed d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN planned p ON p.sid = t.sid AND p.w = d.w
{''.join(_pass_sql(i) for i in range(PASSES))}
), nearest AS (
  SELECT arg_min(r, (abs(size - gap{PASSES - 1}), key, doc_id IS NOT NULL, doc_id, size, r)) AS r FROM taken{PASSES - 1}
  WHERE p > 0 AND NOT more AND gap{PASSES - 1} * {NEAR} > target AND abs(size - gap{PASSES - 1}) < gap{PASSES - 1} GROUP BY sid
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((copies + CAST(more OR r IN (SELECT r FROM nearest) AS BIGINT)) * size AS BIGINT) AS taken
FROM taken{PASSES - 1}
"""
