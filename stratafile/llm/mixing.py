"""Mixing sources to target weights: capped water-filling over source sizes, then seeded whole and fractional
repetitions of documents.

Each source's target is its weight's share of all words, at most ``max_epochs`` times its own size; what a cap cuts off
is shared by weight among the others until no target is above its cap. A source then takes every document
floor(target / size) times and fills the rest in seeded hash order; only the last document of that order is taken in
part. So a source's taken words equal its target rounded down, and a rerun takes the same words.

The order inside a source is cut into 4096 hash buckets, summed before the shuffle. Only the documents of the one bucket
in which the rest ends (a 4096th of a source) are sorted, so a hot source is never one group of rows.

Defined results: null text has size 0 and takes nothing; a null source is a source of its own, the last; repeated rows
are separate documents, and of equal ones it is left open which is taken; an empty table, or one without words, takes
nothing; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafile.llm.quality_rules import free_name
from stratafile.llm.tables import stored, text_or_empty

SPACE = r"[ \t\n\x0B\f\r]"
BUCKET_DIGITS = 3  # hex digits of the order key: 4096 buckets per source


def word_count(text: str) -> Column:
    trimmed = F.regexp_replace(text_or_empty(text), rf"^{SPACE}+|{SPACE}+\z", "")
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, f"{SPACE}+"))).otherwise(F.lit(0)).cast("bigint")


def order_key(doc_id: str, seed: int) -> Column:
    """The seeded order of documents inside their source."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def ranked_sources(sources: DataFrame, weights: list[int]) -> DataFrame:
    """Adds ``weight`` by the source's place in code point order, null last. Any number of sources: they are
    range-partitioned, and a partition's place is the count of those before it."""
    keyed = sources.withColumn("_null", F.col("_source").isNull())
    keyed = stored(
        keyed.repartitionByRange(F.col("_null"), F.col("_source")).withColumn("_part", F.spark_partition_id()), "sources"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per partition
        keyed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_null", "_source")) - 1 + F.col("_offset")
    pick = F.array(*[F.lit(int(w)) for w in weights])
    return (
        keyed.join(offsets, "_part")
        .withColumn("weight", F.get(pick, F.pmod(place, F.lit(len(weights))).cast("int")).cast("bigint"))
        .drop("_part", "_null")
    )


def water_level(sources: DataFrame, total: int, max_epochs: int) -> tuple[int, int]:
    """Words and weight that the uncapped sources share: a source's target is weight * words / weight_sum or its cap.

    Each pass caps every source that the level of the pass before lifts over its cap; the level only rises, so a capped
    source stays capped. One row of sums reaches the driver a pass.
    """
    words, weight = total, None
    cap = max_epochs * F.col("source_size")
    while True:
        if weight is None:
            over = F.lit(False)
        else:
            over = F.col("weight").cast("double") * F.lit(float(words)) / F.lit(float(weight)) > cap.cast("double")
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        level = (total - int(row["capped"]), int(row["weight"]))
        if level == (words, weight) or not level[1]:
            return words, max(weight or 1, 1)
        words, weight = level


def source_plan(sized: DataFrame, weights: list[int], max_epochs: int) -> DataFrame:
    """One row per source: size, weight, target, whole repetitions, and where in the seeded order the rest ends."""
    buckets = sized.groupBy("_source", F.substring("_key", 1, BUCKET_DIGITS).alias("_bucket")).agg(
        F.sum("_size").alias("_words")
    )
    buckets = stored(buckets, "buckets")
    sources = ranked_sources(buckets.groupBy("_source").agg(F.sum("_words").alias("source_size")), weights)
    sources = stored(sources, "weights")
    total = int(sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    words, weight = water_level(sources, total, max_epochs)
    cap = (F.lit(max_epochs) * F.col("source_size")).cast("double")
    share = F.col("weight").cast("double") * F.lit(float(words)) / F.lit(float(weight))
    sources = sources.withColumn("target", F.least(share, cap))
    budget = F.floor("target").cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    # a quotient of large numbers may be rounded up to the next whole number
    sources = sources.withColumn("_whole", whole).withColumn(
        "_whole", F.when(F.col("_whole") * F.col("source_size") > budget, F.col("_whole") - 1).otherwise(F.col("_whole"))
    )
    sources = sources.withColumn("_rest", budget - F.col("_whole") * F.col("source_size"))
    # the bucket in which the running sum passes the rest; a source has at most 4096 rows here
    running = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        buckets.withColumn("_s", F.col("_source")).withColumn("_before", F.coalesce(F.sum("_words").over(running), F.lit(0)))
        .join(sources.select(F.col("_source").alias("_s2"), "_rest"), F.col("_s").eqNullSafe(F.col("_s2")))
        .where((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_words")))
        .select(F.col("_s"), F.col("_bucket").alias("_end"), F.col("_before"))
    )
    return stored(
        sources.join(ends, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"), "plan"
    )


def mixture(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 42,
) -> DataFrame:
    """The documents with a struct ``_mix`` of size, source_size, target, whole (repetitions of the whole text), part
    (words of one more, partial or whole, repetition) and taken."""
    def sized(df: DataFrame) -> DataFrame:
        return df.select(
            F.col(source).cast("string").alias("_source"), order_key(doc_id, seed).alias("_key"), word_count(text).alias("_size")
        )

    plan = source_plan(sized(docs), list(weights), max_epochs)
    key, size, src, mix = (free_name(docs, c) for c in ("_key", "_size", "_src", "_mix"))
    full = docs.withColumn(src, F.col(source).cast("string")).withColumn(key, order_key(doc_id, seed)).withColumn(size, word_count(text))
    plan = plan.select(F.struct(*plan.columns).alias(mix))
    rows = full.join(plan, F.col(src).eqNullSafe(F.col(mix)["_source"]))
    bucket, end, rest = F.substring(key, 1, BUCKET_DIGITS), F.col(mix)["_end"], F.col(mix)["_rest"]
    inside = end.isNotNull() & (bucket == end)
    plain = rows.where(~inside)
    part = F.when(bucket < end, F.col(size)).otherwise(F.lit(0))
    plain = plain.withColumn(size, F.struct(F.col(size).alias("n"), part.cast("bigint").alias("part")))
    order = Window.partitionBy(src).orderBy(key, doc_id, size).rowsBetween(Window.unboundedPreceding, -1)
    so_far = free_name(docs, "_sum")
    edge = rows.where(inside).withColumn(so_far, F.coalesce(F.sum(size).over(order), F.lit(0)) + F.col(mix)["_before"])
    part = F.greatest(F.lit(0), F.least(F.col(size), rest - F.col(so_far))).cast("bigint")
    edge = edge.withColumn(size, F.struct(F.col(size).alias("n"), part.alias("part"))).drop(so_far)
    both = plain.unionByName(edge)
    m, s = F.col(mix), F.col(size)
    return both.withColumn(
        mix,
        F.struct(
            s["n"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
            m["_whole"].alias("whole"), s["part"].alias("part"), (m["_whole"] * s["n"] + s["part"]).alias("taken"),
        ),
    ).drop(key, size, src)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mixture has them: a row for each repetition; a partial one has the text's first words."""
    columns = docs.columns
    text = options.get("text", "text")
    mix = free_name(docs, "_mix")
    df = mixture(docs, **options)
    m, n = F.col(mix), free_name(docs, "_copy")
    extra = F.when((m["part"] > 0) & (m["size"] > m["part"]), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    whole = (m["whole"] + F.when((m["part"] > 0) & (m["part"] == m["size"]), 1).otherwise(0)).cast("int")
    copies = F.concat(F.when(whole > 0, F.sequence(F.lit(1), whole)).otherwise(F.array().cast("array<int>")), extra)
    df = df.withColumn(n, F.explode(copies))
    head = F.array_join(F.slice(F.split(F.regexp_replace(F.col(text), rf"^{SPACE}+", ""), f"{SPACE}+"), 1, m["part"].cast("int")), " ")
    df = df.withColumn(text, F.when(F.col(n) == 0, head).otherwise(F.col(text)))
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.when(F.col(n) == 0, F.length(text).cast("bigint")).otherwise(F.col("n_chars")))
    return df.select(*columns)


def mixing_report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    df = mixture(docs.select("doc_id", "text", "source"))
    return df.select("doc_id", *[F.col("_mix")[c].alias(c) for c in ("size", "source_size", "target", "taken")])
