"""Mixing sources to target weights.

Tokens are aggregated per source; the targets give each source its repetition rate; a document is emitted floor(rate)
times plus one more time if a hash of its id, seeded, falls below the fraction.

Cases: a null text has size 0; a null source is a source of its own, last in order; a null id is hashed as a fixed
string; equal ids share one draw, so repeated rows are repeated alike; an empty table gives an empty table; a corpus
without words has targets 0.  Columns of the input are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_REGEX, bounded_broadcast, stored, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"
_KEY, _SIZE = "__mix_source", "__mix_size"


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def draw(doc_id: F.Column, seed: str) -> F.Column:
    """A number in [0, 1) from the leading 32 bits of an MD5 of seed and id."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a source from (source key, size): __mix_source, source_size, target.

    Sources are ranked by code point.  Targets fill like water, in one pass: those whose share would pass `most` times their size stop
    there and the excess is dealt to the others by weight.  Everything here is one row a source; ranks and running sums
    are taken in ranges of sources, so no task needs all of them.
    """
    spark = sized.sparkSession
    per = stored(sized.groupBy(_KEY).agg(F.sum(_SIZE).alias("source_size")), "mix-sources")
    # ranks by range: the ranges' counts are as few as the partitions
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), per.count() // 50_000 + 1))
    ranged = stored(per.repartitionByRange(parts, F.col(_KEY).asc_nulls_last()).withColumn("__part", F.spark_partition_id()), "mix-ranges")
    before, total = {}, 0
    for r in ranged.groupBy("__part").count().orderBy("__part").collect():  # one row a partition
        before[r["__part"]] = total
        total += r["count"]
    if not total:
        return spark.createDataFrame([], f"{_KEY} string, source_size bigint, target double")
    base = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(F.col(_KEY).asc_nulls_last())) - 1 + base[F.col("__part")]
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = stored(ranged.withColumn("__w", w).drop("__part"), "mix-ranked")
    # Sources are filled in order of size by weight.  With the first k of them at their caps the level of the others is
    # (what is left) / (their weight); it rises as long as the next source is above its cap, and falls from there on.
    by_ratio = F.col("source_size") / F.col("__w")
    order = stored(ranked.withColumn("__ratio", by_ratio).repartitionByRange(parts, "__ratio").withColumn("__part", F.spark_partition_id()), "mix-order")
    size_before, w_before, total_size, total_w = {}, {}, 0, 0.0
    for r in order.groupBy("__part").agg(F.sum("source_size").alias("s"), F.sum("__w").alias("w")).orderBy("__part").collect():  # one row a partition
        size_before[r["__part"]], w_before[r["__part"]] = total_size, total_w
        total_size, total_w = total_size + r["s"], total_w + r["w"]
    before = Window.partitionBy("__part").orderBy("__ratio", F.col(_KEY).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    of = lambda known: F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[F.col("__part")]
    capped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) + of(size_before)
    weight = F.lit(total_w) - (F.coalesce(F.sum("__w").over(before), F.lit(0.0)) + of(w_before))
    level = order.select(((F.lit(share * float(total_size)) - F.lit(float(most)) * capped.cast("double")) / weight).alias("level")).agg(F.max("level")).first()[0]
    cap = most * F.col("source_size").cast("double")
    return ranked.select(_KEY, "source_size", F.least(cap, F.lit(level) * F.col("__w")).alias("target"))


def with_rates(docs: DataFrame, id_col: str, source_col: str, size: F.Column, **mix) -> DataFrame:
    """docs plus __mix_size, source_size, target and __mix_copies."""
    narrow = docs.select(F.col(source_col).cast("string").alias(_KEY), size.alias(_SIZE))
    targets = source_targets(narrow, **{k: v for k, v in mix.items() if k != "seed"})
    key = F.coalesce(F.concat(F.lit("s"), F.col(_KEY)), F.lit("n"))  # a null key joins as well
    side = targets.select(key.alias("__mix_key"), F.col("source_size").alias("__mix_total"), F.col("target").alias("__mix_target"))
    wide = docs.withColumn(_SIZE, size).withColumn("__mix_key", F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")))
    joined = bounded_broadcast(wide, side, "__mix_key", "left", side.count())
    rate = F.when(F.col("__mix_total") > 0, F.col("__mix_target") / F.col("__mix_total")).otherwise(0.0)
    whole = F.floor(rate)
    copies = whole + F.when(draw(F.col(id_col), mix.get("seed", SEED)) < rate - whole, 1).otherwise(0)
    return joined.withColumn("__mix_copies", F.coalesce(copies, F.lit(0)).cast("int"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The mixed corpus: the input's columns, each document as often as the mix takes it."""
    sized = with_rates(docs, id_col, source_col, word_count(F.col(text_col)), **how)
    return _repeat(sized, docs.columns)


def _repeat(sized: DataFrame, columns: list[str]) -> DataFrame:
    taken = sized.where(F.col("__mix_copies") > 0)
    return taken.withColumn("__mix_n", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*columns)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = stored(docs, "mix-sizes")  # the texts are read once
    out = with_rates(sized, "doc_id", "source", F.col("size"))
    return out.select("doc_id", "size", F.col("__mix_total").alias("source_size"), F.col("__mix_target").alias("target"), (F.col("size") * F.col("__mix_copies")).cast("long").alias("taken"))


OP2_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM per),
lev AS (
  SELECT 0 AS n, 1.5::DOUBLE * (SELECT sum(source_size) FROM ranked)::DOUBLE / (SELECT sum(w) FROM ranked) AS level
  UNION ALL
  SELECT n + 1, (1.5::DOUBLE * (SELECT sum(source_size) FROM ranked)::DOUBLE
     - 2.0::DOUBLE * (SELECT coalesce(sum(source_size), 0) FROM ranked WHERE w * level > 2.0::DOUBLE * source_size::DOUBLE)::DOUBLE)
     / (SELECT sum(w) FROM ranked WHERE w * level <= 2.0::DOUBLE * source_size::DOUBLE)
  FROM lev WHERE n < 200 AND (SELECT coalesce(sum(w), 0) FROM ranked WHERE w * level <= 2.0::DOUBLE * source_size::DOUBLE) > 0),
top AS (SELECT level FROM lev ORDER BY n DESC LIMIT 1),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size::DOUBLE, level * w) AS target FROM ranked, top),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated
"""
