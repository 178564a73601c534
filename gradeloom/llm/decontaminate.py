"""Benchmark items inside documents: bottom-k MinHash search by size class, exact check of the shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.sqltext import rolling, words
from gradeloom.session import materialize

K = 5
LEAST_PERCENT = 75
#: Item shingles are sent to all executors up to this many (about 100 bytes each), and so are candidates' ids;
#: more are shuffled.
BROADCAST_ROWS = 200_000


def shingles(table: DataFrame, key: str) -> DataFrame:
    """Rows (row, key, n_words, w0..w4, hash), one for each run of five words; the words as one row if fewer."""
    text = table.select(F.monotonically_increasing_id().alias("row"), key, words(F.col("text")).alias("words"))
    text = text.withColumn("n_words", F.size("words"))
    runs = text.select("row", key, "n_words", F.posexplode(rolling(F.col("words"), F.col("n_words"), K)).alias("at", "w"))
    whole = (F.col("at") <= F.col("n_words") - K) | (F.col("at") == 0)
    parts = [F.col(f"w.w{i}") for i in range(K)]
    return runs.where(whole).select("row", key, *parts, F.xxhash64(*parts).alias("hash"))


def phrases(table: DataFrame, key: str, size: int) -> DataFrame:
    """Rows as of `shingles`, one for each run of `size` words, fewer than five; the other words are null."""
    text = table.select(F.monotonically_increasing_id().alias("row"), key, words(F.col("text")).alias("words"))
    runs = text.select("row", key, F.posexplode(rolling(F.col("words"), F.size("words"), size)).alias("at", "w"))
    parts = [F.col(f"w{i}") if i < size else F.lit(None).cast("string").alias(f"w{i}") for i in range(K)]
    return runs.select("row", key, "w.*").where(F.col(f"w{size - 1}").isNotNull()).select("row", key, *parts).withColumn(
        "hash", F.xxhash64(*(f"w{i}" for i in range(K))))


def short_sizes(table: DataFrame) -> list[int]:
    """The numbers of words, below five, that items of the table have."""
    count = sum((F.col(f"i{i}").isNotNull().cast("int") for i in range(K)), F.lit(0))
    return [r[0] for r in table.select(count.alias("c")).where(f"c < {K}").distinct().orderBy("c").collect()]


def item_sketches(items: DataFrame) -> DataFrame:
    """Distinct shingles of the items; `sketch` marks the smallest hashes that have to be searched for.

    Items are put in classes by size, a class holding sizes up to a power of two. A document with at least
    three quarters of an item's n shingles lacks at most n/4 of them, so it has one of any n/4 + 1; the class
    takes that number for its largest size. The search with these minima therefore misses nothing.
    """
    sets = shingles(items, "item_id").drop("row").distinct()
    sizes = sets.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"), F.sort_array(F.collect_list("hash")).alias("hashes"))
    top = F.pow(F.lit(2), F.ceil(F.log2(F.col("n_shingles")))).cast("int")
    k = F.least(F.col("n_shingles"), F.floor(top * (100 - LEAST_PERCENT) / 100).cast("int") + 1)
    sizes = sizes.select("item_id", "n_shingles", F.element_at("hashes", k.cast("int")).alias("limit"))
    return sets.join(sizes, "item_id").withColumn("sketch", F.col("hash") <= F.col("limit")).drop("limit")


def item_table(items: DataFrame) -> DataFrame:
    return item_sketches(items).select(
        "item_id", "n_shingles", "sketch", F.col("hash").alias("i_hash"), *(F.col(f"w{i}").alias(f"i{i}") for i in range(K)))


def meeting(docs: DataFrame, table: DataFrame, short: list[int]) -> DataFrame:
    """The shingles of the documents that are among those of the table, compared word by word.

    For items of fewer than five words, of the sizes `short`, the documents' runs of as many words are looked at too.
    """
    equal = F.col("hash") == F.col("i_hash")
    for i in range(K):
        equal = equal & F.col(f"w{i}").eqNullSafe(F.col(f"i{i}"))
    runs = shingles(docs, "doc_id")
    for size in short:
        runs = runs.unionByName(phrases(docs, "doc_id", size))
    return runs.join(table, equal)


def few(table: DataFrame) -> DataFrame:
    """The table, to be sent to all executors if it has at most BROADCAST_ROWS."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def candidates(docs: DataFrame, table: DataFrame, short: list[int]) -> DataFrame:
    """Distinct (c_doc, c_item) where a document has a shingle of the item's sketch."""
    sketches = few(table.where("sketch"))
    return meeting(docs, sketches, short).select(F.col("doc_id").alias("c_doc"), F.col("item_id").alias("c_item")).distinct()


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_shared, containment): 75 % of the item's shingles lie in the document.

    Shingles are five words in a row, words being letters a-z (A-Z lower-cased), digits and characters beyond
    ASCII. An item of fewer words is one shingle of all its words, and is found wherever a text has these words in a
    row; a text of fewer than five words is one shingle to longer items. Items and texts without words, null or not, match
    nothing. Documents are searched for the items' sketches; only the pairs found so have all their shingles
    compared. Other columns are ignored. Rows with equal doc_id and text, or equal item_id and text, give
    one pair; rows that only share an id count as one with all their shingles. Empty tables give no rows.
    """
    table = materialize(item_table(items))
    short = short_sizes(table)
    found = materialize(candidates(docs, table, short))
    same_doc = F.col("doc_id").eqNullSafe(F.col("c_doc"))
    searched = docs.select("doc_id", "text").join(few(found.select("c_doc").distinct()), same_doc, "left_semi")
    # a hash stands for its five words, compared in the join
    met = meeting(searched, few(table), short).select("doc_id", "item_id", "n_shingles", "hash").distinct()
    pairs = met.groupBy("doc_id", "item_id", "n_shingles").agg(F.count(F.lit(1)).alias("n_shared"))
    pairs = pairs.where(F.col("n_shared") * 100 >= F.col("n_shingles") * LEAST_PERCENT)
    pairs = pairs.join(found, same_doc & F.col("item_id").eqNullSafe(F.col("c_item")), "left_semi")
    return pairs.select(
        "doc_id", "item_id", F.col("n_shingles").cast("long"), F.col("n_shared").cast("long"),
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item.

    Rows whose doc_id is null are kept, as are null and empty texts; repeated rows all stay or all go, and so do all rows
    of a doc_id, as one of them is enough. All columns are kept. Without items everything stays; no rows give no rows.
    """
    found = contained_items(docs, items).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, F.col("doc_id") == F.col("_found"), "left_anti")
