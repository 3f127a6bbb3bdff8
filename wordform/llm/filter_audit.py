"""Filter interaction audit: what each step of every order of filters removes.

Each document gets a mask with one bit for every filter that it fails; masks are
counted per part into cells (at most 2^filters per part). A recursive CTE then
extends the empty prefix by every filter that the prefix does not hold yet: a
level joins the prefix with its part's cells, carries the bits applied so far
and emits the metrics of the step it adds. A prefix is shared by all orders that
begin with it, so 5 filters need 325 prefixes for their 120 orders.

Work and bounds: documents are read once and move as (digest, part, id, mask);
rows of one text are added up before they meet, so a text that a third of all
rows repeat is one row per task and part. The recursion reads only the cells; its
rows grow with parts, for which ``LIMIT ALL`` lifts Spark's row limit. A text is
split into words in the task that reads it: memory follows the longest text.

Defined cases: null text is empty; a null part is the empty string; a null id
is no one's smaller id and has no smaller one, so such a row never fails E and has
no label; rows that repeat the smallest id of a text pass E, all of them; a document
is good (or toxic) if any of its label rows says so. An empty table gives no rows.
Columns beside those named make no difference."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordform.llm.common import table, written
from wordform.operators.filters import once

#: Filters of the audit, by letter: what fails, in terms of ``text`` and ``words``.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
MARKS = "[#$%&*|]"
SPACES = r"[\x20\x09-\x0D]+"
#: The letter of the filter that a table-wide comparison decides.
REPEATED = "E"


def text_filters() -> dict[str, Column]:
    """Failure conditions that depend on one text only."""
    text, words = F.col("text"), F.col("words")
    upper = F.size(F.split(text, "[A-Z]", -1)) - 1
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * MIN_DISTINCT_PERCENT,
        "C": upper * F.lit(100) > F.length(text) * MAX_UPPER_PERCENT,
        "D": text.rlike(MARKS),
    }


def masked(docs: DataFrame, filters: dict[str, Column], part: str = "lang") -> DataFrame:
    """(part, doc_id, digest, mask) of every row; filter i sets bit i."""
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = once(rows, F.filter(F.split(F.col("text"), SPACES), lambda w: w != "").alias("words"))
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(filters.values())]
    return rows.select("part", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))


def count_cells(rows: DataFrame, labels: DataFrame, repeated_bit: int) -> DataFrame:
    """(part, cells): per part the counts of its documents by mask, as an array of
    structs (mask, n, good, toxic) with at most one for each mask. Rows whose text
    a smaller id has too get ``repeated_bit``."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    one = rows.groupBy("digest", "part", "mask", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    # rows without an id meet no label: they are kept from sharing a key
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("~"), F.hex("digest")))
    one = one.withColumn("key", key).join(marks.withColumn("key", F.col("label_id").cast("string")), "key", "left")
    one = one.select(
        "digest", "part", "mask", "doc_id", "n",
        (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    counts = ["n", "good", "toxic"]
    # per text and part: everything, the rows of the smallest id, the rows without one
    texts = one.groupBy("digest", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *counts))).alias("first"),
        *[F.sum(F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(F.lit(0))).alias(f"{c}_free") for c in counts],
    )
    # one row for each part that has the text
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    texts = texts.withColumn("is_least", F.coalesce(F.col("first.doc_id") == least, F.lit(False)))
    passed = {c: F.col(f"{c}_free") + F.when(F.col("is_least"), F.col(f"first.{c}")).otherwise(F.lit(0)) for c in counts}
    cells = texts.select(
        "part",
        F.inline(
            F.array(
                F.struct(F.col("mask"), *[passed[c].alias(c) for c in counts]),
                F.struct(F.col("mask").bitwiseOR(F.lit(repeated_bit)).alias("mask"), *[(F.col(c) - passed[c]).alias(c) for c in counts]),
            )
        ),
    )
    cells = cells.where("n > 0").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])
    return cells.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("mask", *counts))).alias("cells"))


def audit_steps(cells: DataFrame, letters: str) -> DataFrame:
    """The recursion: one row per part and prefix of an order, with the metrics
    of the prefix's last step (step 0 is the empty prefix)."""
    spark = cells.sparkSession
    unused = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))

    def total(value: str, condition: str) -> str:
        return f"aggregate(c.cells, 0L, (acc, x) -> acc + if({condition}, x.{value}, 0L))"

    here = "(x.mask & p.applied) = 0 and (x.mask & l.bit) <> 0"
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    metrics = [
        total("n", "(x.mask & (p.applied | l.bit)) = 0"),
        total("n", here),
        total("n", "(x.mask & p.applied) <> 0 and (x.mask & l.bit) <> 0"),
        total("n", "x.mask = l.bit"),
        total("good", here),
        total("toxic", here),
    ]
    query = f"""
        WITH RECURSIVE steps(part, prefix, letter, step, applied, {', '.join(names)}) MAX RECURSION LEVEL {len(letters) + 1} AS (
            SELECT part, '', '', 0, 0, {', '.join(['0L'] * len(names))} FROM {{cells}}
            UNION ALL
            SELECT c.part, concat(p.prefix, l.letter), l.letter, p.step + 1, p.applied | l.bit, {', '.join(metrics)}
            FROM steps p JOIN {{cells}} c ON c.part = p.part
            LATERAL VIEW inline(filter(array({unused}), x -> (p.applied & x.bit) = 0)) l
        )
        SELECT part, prefix, letter, step, {', '.join(names)} FROM steps LIMIT ALL
    """
    return spark.sql(query, cells=cells)


def audit(cells: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) for every part, order and step."""
    m = len(letters)
    steps = written(audit_steps(cells, letters), "audit-steps").where("step > 0")
    # a prefix of k filters begins (m - k)! orders
    orders_of = F.element_at(F.array(*[F.lit(math.factorial(m - k)) for k in range(1, m + 1)]), F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders_of).alias("shapley"))
    orders = steps.where(F.col("step") == m).select("part", F.col("prefix").alias("filter_order"))
    orders = orders.select("part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(m))).alias("at"))
    orders = orders.withColumn("prefix", F.substring(F.col("filter_order"), F.lit(1), F.col("at"))).drop("at")
    return orders.join(steps, ["part", "prefix"]).join(shapley, ["part", "letter"]).drop("prefix", "letter")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = text_filters()
    rows = masked(table(spark, sf_dir, "documents"), filters)
    letters = "".join(filters) + REPEATED
    cells = written(count_cells(rows, table(spark, sf_dir, "labels"), 1 << len(filters)), "cells")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return audit(cells, letters).select(*columns)


OP11_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), fails AS (
  SELECT d.part,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask,
         coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic
  FROM texts d LEFT JOIN marks m ON m.doc_id = d.doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, mask
), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders(filter_order) AS (
  SELECT letter FROM letters
  UNION ALL
  SELECT o.filter_order || l.letter FROM orders o, letters l WHERE NOT contains(o.filter_order, l.letter)
), steps AS (
  SELECT o.filter_order, s.step, l.letter, l.bit,
         (SELECT coalesce(sum(b.bit), 0) FROM letters b WHERE contains(substr(o.filter_order, 1, s.step - 1), b.letter)) AS earlier
  FROM orders o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s, letters l
  WHERE length(o.filter_order) = 5 AND l.letter = substr(o.filter_order, s.step, 1)
), counted AS (
  SELECT c.part, s.filter_order, s.step, s.letter,
         coalesce(sum(c.n) FILTER (c.mask & (s.earlier + s.bit) = 0), 0) AS kept,
         coalesce(sum(c.n) FILTER (c.mask & s.earlier = 0 AND c.mask & s.bit <> 0), 0) AS removed,
         coalesce(sum(c.n) FILTER (c.mask & s.earlier <> 0 AND c.mask & s.bit <> 0), 0) AS redundant,
         coalesce(sum(c.n) FILTER (c.mask = s.bit), 0) AS unique_fails,
         coalesce(sum(c.good) FILTER (c.mask & s.earlier = 0 AND c.mask & s.bit <> 0), 0) AS good_lost,
         coalesce(sum(c.toxic) FILTER (c.mask & s.earlier = 0 AND c.mask & s.bit <> 0), 0) AS toxic_lost
  FROM cells c, (SELECT filter_order, step, letter, CAST(bit AS BIGINT) AS bit, CAST(earlier AS BIGINT) AS earlier FROM steps) s
  GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
