"""Mixing sources to target weights.

Each source gets a share of all words by its weight, at most ``most`` times its
own words; what a full source cannot take goes to the others by weight. Its
documents are drawn in the order of a hash key, whole epochs first, the last one
up to the exact budget: the document at the cut is taken in part.

Keys are hash-random, so equal ranges of the key space hold about equally many
documents: a source is cut into as many ranges as its rows call for. Running
sums within ranges and the sums of the ranges before give the prefix sums, and
no task holds a whole source.

A null text has no words; a null source is a source of its own, the last one.
Documents without words are taken zero times. Rows that are repeated, or share
an id, each count as a document. Null ids are ordered first among equal keys.
Columns named like those made here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from measlake.llm.common import kept

WEIGHTS = (5, 2, 1)
MOST = 3
RANGE_ROWS = 2048
SPACE = r" \t-\r"


def words(text: str = "text") -> Column:
    """Number of words; spaces are U+0020 and U+0009 to U+000D."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source of (source, size): rank, number of rows, words, and target.

    Sources by words per weight: the full ones come first. With ``left`` words
    and ``open`` weights from a source on, it is full if its cap is within its
    share; the share of the first that is not full holds for all behind it.
    """
    each = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = Window.partitionBy()
    ranked = (
        each.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn(
            "weight", F.array(*map(F.lit, weights))[F.col("rank") % len(weights)].cast("long")
        )
        .withColumn("cap", F.col("source_size") * most)
        .withColumn(
            "left",
            F.sum("source_size").over(every) - F.sum("cap").over(by_fill) + F.col("cap"),
        )
        .withColumn(
            "open", F.sum("weight").over(every) - F.sum("weight").over(by_fill) + F.col("weight")
        )
        .withColumn("full", F.col("cap") * F.col("open") <= F.col("left") * F.col("weight"))
        .withColumn("place", F.row_number().over(by_fill))
    )
    first = F.min(F.when(~F.col("full"), F.struct("place", "left", "open"))).over(every)
    share = F.col("first.left") * F.col("weight") / F.col("first.open")
    return (
        ranked.withColumn("first", first)
        .withColumn(
            "target",
            F.when(
                F.col("first").isNull() | (F.col("place") < F.col("first.place")),
                F.col("cap").cast("double"),
            ).otherwise(share),
        )
        .select("source", "rank", "rows", "source_size", "target")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows with a ``size`` and a ``source``, and how much of each is taken.

    Adds source_size, target and taken (words, repeats counted).
    """
    docs = docs.drop("source_size", "target", "taken")
    sources = kept(targets(docs.select("source", "size"), weights, most), "mix-sources")
    budget = F.floor("target").cast("long")
    named = sources.withColumnsRenamed({"source": "__name", "rank": "__rank", "rows": "__rows"})
    share = F.when(F.col("source_size") > 0, F.col("source_size"))
    drawn = (
        docs.join(named, F.col("source").eqNullSafe(F.col("__name")))
        .drop("__name")
        .withColumn("__epochs", F.coalesce(F.floor(budget / share), F.lit(0)).cast("long"))
        .withColumn("__rest", budget - F.col("__epochs") * F.col("source_size"))
        .withColumn(
            "__key",
            F.md5(
                F.concat_ws(":", F.col("doc_id").cast("string"), F.col("__epochs").cast("string"))
            ),
        )
        .withColumn(
            "__range",
            F.floor(
                F.conv(F.substring("__key", 1, 8), 16, 10).cast("double")
                / 2**32
                * F.ceil(F.col("__rows") / RANGE_ROWS)
            ).cast("long"),
        )
    )
    before = Window.partitionBy("__name").orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = (
        drawn.select(F.col("__rank").alias("__name"), F.col("__range").alias("__part"), "size")
        .groupBy("__name", "__part")
        .agg(F.sum("size").alias("__sum"))
        .withColumn("__offset", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        .drop("__sum")
    )
    within = (
        Window.partitionBy("__rank", "__range")
        .orderBy("__key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.col("__offset") + F.col("__inside")
    return (
        drawn.withColumn("__inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(
            kept(ranges, "mix-ranges"),
            (F.col("__rank") == F.col("__name")) & (F.col("__range") == F.col("__part")),
        )
        .withColumn(
            "taken",
            F.col("__epochs") * F.col("size")
            + F.greatest(F.lit(0), F.least(F.col("size"), F.col("__rest") - reached)),
        )
        .select(*docs.columns, "source_size", "target", "taken")
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """The documents of the mix: a row per copy, the one at a cut with its first words only.

    Columns are those of ``docs``; ``n_chars``, if there, follows a cut text.
    """
    own = docs.select(
        F.struct(*docs.columns).alias("__row"), "doc_id", "source", words().alias("size")
    )
    taken = mix(own, weights, most).where("taken > 0")
    copies = taken.withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size"))))
    )
    left = F.col("taken") - (F.col("__copy") - 1) * F.col("size")
    # The text behind the first `left` words is what a split with that limit leaves over.
    text, limit = F.col("__row.text"), (left + 1).cast("int")
    parts = F.split(text, f"(?<=[^{SPACE}])[{SPACE}]+", limit)
    rest = F.when(left < F.col("size"), F.element_at(parts, limit))
    copies = copies.withColumn("__rest", rest).withColumn(
        "__text",
        F.when(F.col("__rest").isNull(), text).otherwise(
            F.rtrim(
                F.substring(text, F.lit(1), F.length(text) - F.length("__rest")),
                F.lit(" \t\n\x0b\x0c\r"),
            )
        ),
    )
    columns = {name: F.col("__row").getField(name) for name in docs.columns}
    columns["text"] = F.col("__text")
    if "n_chars" in columns:
        length = F.length("__text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("__rest").isNull(), columns["n_chars"]).otherwise(length)
    return copies.select(*[column.alias(name) for name, column in columns.items()])


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
f AS (
  SELECT *,
    sum(source_size) OVER () - sum(cap) OVER o + cap AS remaining,
    sum(weight) OVER () - sum(weight) OVER o + weight AS open,
    row_number() OVER o AS place
  FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
g AS (SELECT *, cap * open <= remaining * weight AS filled FROM f),
h AS (SELECT * FROM g WHERE NOT filled ORDER BY place LIMIT 1),
t AS (
  SELECT g.source, g.source_size,
    CASE WHEN h.place IS NULL OR g.place < h.place THEN CAST(g.cap AS DOUBLE)
      ELSE CAST(h.remaining AS BIGINT) * g.weight / CAST(h.open AS BIGINT) END AS target
  FROM g LEFT JOIN h ON true),
b AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END
      AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY md5(concat_ws(':', doc_id, epochs)), doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached
  FROM b)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size
    + greatest(0, least(size, budget - epochs * source_size - reached)) AS BIGINT) AS taken
FROM k
"""
