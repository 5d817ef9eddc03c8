"""Benchmark decontamination: test items inside documents, by size-partitioned MinHash containment.

An item of m shingles is contained in a document that holds ``need`` =
ceil(0.8 m) of them, so at most m - need are missing, and of any m - need + 1
shingles at least one is there. Items are partitioned by m, which sets both
numbers; the sketch of an item is its m - need + 1 smallest MinHash values, a
share of the item, whatever the length of the document. Documents that hold a
value of a sketch and have enough shingles are verified word for word. An item
of fewer words than a shingle is one shingle of its own width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntlake.functions.once import once
from huntlake.llm.common import saved, words_of

SHINGLE = 5
CONTAINED = 0.8
SEED = 17


def valued(df: DataFrame, shingle: int) -> DataFrame:
    """``df`` (.., words) with ``values``: the MinHash values of all shingles, repeats included."""
    named = df.withColumn("names", F.transform("words", lambda word: F.xxhash64(word)))
    return named.withColumn("values", minhashes(shingle)).drop("names")


def minhashes(width: int) -> Column:
    """The values of all runs of ``width`` words, from their ``names``; NULL if there are fewer words."""
    places = F.sequence(F.lit(0), F.size("words") - width)
    values = F.transform(
        places, lambda at: F.xxhash64(F.lit(SEED), *[F.get(F.col("names"), at + i) for i in range(width)])
    )
    return F.when(F.size("words") >= width, values)


def item_sketches(items: DataFrame, shingle: int = SHINGLE, contained: float = CONTAINED) -> DataFrame:
    """(item_id, item_key, width, shingles, n_shingles, need, value): the items, one row per value of a sketch.

    ``width`` is the number of words of a shingle, or of the whole item if it has fewer.
    """
    words = words_of(F.lower("text"))
    cut = items.where("text is not null").select("item_id", F.xxhash64("item_id", "text").alias("item_key"), words.alias("words"))
    cut = cut.distinct().where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(shingle)))
    cut = cut.withColumn("names", F.transform("words", lambda word: F.xxhash64(word)))
    values = minhashes(shingle)
    for width in range(1, shingle):
        values = F.when(F.size("words") == width, minhashes(width)).otherwise(values)
    texts = F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.size("words") - F.col("width") + 1),
            lambda at: F.array_join(F.slice("words", at, F.col("width")), " "),
        )
    )
    sized = cut.select("item_id", "item_key", "width", texts.alias("shingles"), F.sort_array(F.array_distinct(values)).alias("values"))
    sized = sized.withColumn("n_shingles", F.size("shingles"))
    sized = sized.withColumn("need", F.ceil(F.col("n_shingles") * contained - 1e-9).cast("int"))
    return sized.select(
        "item_id",
        "item_key",
        "width",
        "shingles",
        "n_shingles",
        "need",
        F.explode_outer(F.slice("values", F.lit(1), F.col("n_shingles") - F.col("need") + 1)).alias("value"),
    )


def contained_items(
    docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, contained: float = CONTAINED
) -> DataFrame:
    """(tag, item_id, n_shingles, n_shared) of the texts that hold an item, where ``tag`` is xxhash64(text).

    Words are lower-cased runs between white space; an item's distinct shingles
    of five words are counted, wherever they stand in the text. An item of fewer
    words is one shingle: a text holds it where its words stand in a row. A NULL
    text holds nothing, and an item without words is in no text. Repeated texts
    and items are compared once.
    """
    sketches = saved(item_sketches(items, shingle, contained), "sketches")
    # few and small as a rule: Spark broadcasts them if they are, and else shuffles and splits a frequent value
    looked_up = sketches.select("value", "item_key", "need", "width")
    texts = docs.where("text is not null").select(
        F.xxhash64("text").alias("tag"), words_of(F.lower("text")).alias("words")
    )
    # an outer explode and a size that is never NULL: else Spark filters on them below, computing the arrays once more
    size = F.coalesce(F.size("words") - (shingle - 1), F.lit(0)).alias("size")
    spread = valued(texts, shingle).select("tag", size, F.explode_outer("values").alias("value"))
    looked = spread.join(looked_up.where(F.col("width") == shingle), "value").where("size >= need").select("tag", "item_key")
    short = [row["width"] for row in sketches.where(F.col("width") < shingle).select("width").distinct().collect()]
    for width in sorted(short):  # fewer than a shingle has words; each costs a pass over the texts
        runs = valued(texts, width).select("tag", F.explode_outer("values").alias("value"))
        looked = looked.union(runs.join(looked_up.where(F.col("width") == width), "value").select("tag", "item_key"))
    candidates = saved(looked.distinct(), "candidates")
    full = sketches.select("item_key", "item_id", "shingles", "n_shingles", "need").dropDuplicates(["item_key"])
    wanted = saved(candidates.join(full, "item_key"), "candidates")
    tagged = docs.where("text is not null").select(F.xxhash64("text").alias("tag"), "text")
    line = F.concat(F.lit(" "), F.array_join(words_of(F.lower("text")), " "), F.lit(" "))
    held = F.filter("shingles", lambda one: F.contains(F.col("line"), F.concat(F.lit(" "), one, F.lit(" "))))
    return (
        tagged.join(wanted, "tag")
        .withColumn("line", once(line))
        .withColumn("n_shared", once(F.size(held)))
        .where("n_shared >= need")
        .select("tag", "item_id", "n_shingles", "n_shared")
        .distinct()
    )


def contamination(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment), one row per document and item it holds.

    Where several rows have one id, the largest containment counts.
    """
    found = saved(contained_items(docs, items, shingle, contained), "contained")
    tagged = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tag"))
    best = F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shared", "n_shingles")
    return (
        tagged.join(found, "tag")
        .groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            "doc_id",
            F.col("item_id").cast("long"),
            F.col("best.n_shingles").cast("long").alias("n_shingles"),
            F.col("best.n_shared").cast("long").alias("n_shared"),
            F.col("best.containment").alias("containment"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, contained: float = CONTAINED) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; a NULL text holds none."""
    found = saved(contained_items(docs, items, shingle, contained).select("tag").distinct(), "contained")
    return docs.join(found, F.xxhash64(docs["text"]) == found["tag"], "left_anti")
