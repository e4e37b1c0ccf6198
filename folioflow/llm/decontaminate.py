"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

Words are runs of letters and digits in lower case; a text is the set of its runs of five words. A
document holds an item if at least ``threshold`` of the item's shingles occur in it, however long
the document. Items are put in classes by their number of shingles, a power of two each. An item
keeps a bottom-k MinHash sketch, its k smallest shingle hashes, with k one more than the number of
shingles an item of its class may miss: a document that holds the item has at least one of them, so
the search loses nothing. Documents look their own shingle hashes up in the sketches, and each pair
found is verified on the shingles themselves. An item of fewer than five words is one shingle of its own
length, in a size class of its own; documents look up their runs of such a length only if an item has it.

Edge cases: a text without a word, or null, matches nothing; rows with one id are
one document, null ids included; repeated rows and items with equal ids give a pair once; empty
tables give no pairs; only the named columns are read.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .line_rules import window_hashes
from .scratch import free_name, written

_WORDS_PER_SHINGLE = 5


def shingle_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _word_hashes(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_words``, the hashes of the words, in order."""
    return docs.withColumn("_words", F.transform(shingle_words(F.col(text)), lambda w: F.xxhash64(w)))


def shingles(words: Column, n=_WORDS_PER_SHINGLE) -> Column:
    """The shingles of a stored array of words, as strings, each once."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
    runs = F.transform(starts, lambda w, i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))
    return F.array_distinct(F.when(F.size(words).between(1, n - 1), F.array(F.array_join(words, " "))).otherwise(runs))


def sketches(items: DataFrame, item="item_id", text="text", threshold=0.8, n=_WORDS_PER_SHINGLE) -> DataFrame:
    """``(item, size_class, hash)``: the bottom-k sketch of each item. An item of m < n words has the size class m - n."""
    told = _word_hashes(items.select(F.col(item).alias("item"), F.col(text).alias("_text")), "_text")
    m = F.size("_words")
    short = F.when(m >= n, window_hashes(F.col("_words"), n))
    for length in range(1, n):
        short = short.when(m == length, window_hashes(F.col("_words"), length))
    sets = told.select("item", m.alias("_m"), F.sort_array(F.array_distinct(short)).alias("_set"))
    size_class = F.when(F.col("_m") < n, F.col("_m") - n).otherwise(F.floor(F.log2(F.size("_set")))).cast("int")
    most = F.pow(F.lit(2.0), F.greatest(F.col("size_class"), F.lit(0)) + 1) - 1
    missed = F.floor(most * F.lit(1 - threshold) + F.lit(1e-9))
    sized = sets.withColumn("size_class", size_class)
    each = sized.select("item", "size_class", F.explode_outer(F.slice("_set", F.lit(1), (missed + 1).cast("int"))).alias("hash"))
    return each.where(F.col("hash").isNotNull()).distinct()


def contaminated(docs: DataFrame, items: DataFrame, key="doc_id", text="text", item="item_id", item_text="text", threshold=0.8, n=_WORDS_PER_SHINGLE) -> DataFrame:
    """Pairs ``(key, item, n_shared, n_shingles, containment)`` of documents and the items they hold."""
    told = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    # Written first, so that Spark knows the size and broadcasts only what is below its limit.
    index, _ = written(sketches(items, item, item_text, threshold, n), "sketches")
    # The outer form: for the inner one Spark tests the array beforehand, and computes its words per shingle.
    lengths = [n + r["size_class"] for r in index.where("size_class < 0").select("size_class").distinct().collect()]  # fewer than n
    runs = F.concat(*[window_hashes(F.col("_words"), k) for k in (n, *sorted(lengths))])
    probes = _word_hashes(told, "_text").select("_key", F.xxhash64("_text").alias("_at"), F.explode_outer(runs).alias("hash"))
    met = probes.join(index, "hash").select("_key", "_at", "item").distinct()
    candidates, _ = written(met, "candidates")

    wanted = items.select(F.col(item).alias("item"), shingle_words(F.col(item_text)).alias("_item_words"))
    wanted = wanted.select("item", shingles(F.col("_item_words"), n).alias("_item_set"), (F.size("_item_words") < n).alias("_short"))
    full = told.withColumn("_at", F.xxhash64("_text"))
    pairs = full.alias("d").join(
        candidates.alias("c"), (F.col("d._at") == F.col("c._at")) & F.col("d._key").eqNullSafe(F.col("c._key"))
    ).select("d._key", "d._text", "c.item")
    checked = pairs.join(wanted, pairs["item"].eqNullSafe(wanted["item"])).select(
        "_key", pairs["item"], "_item_set", "_short", shingle_words(F.col("_text")).alias("_doc_words")
    )
    around = F.concat(F.lit(" "), F.array_join("_doc_words", " "), F.lit(" "))
    whole = F.contains(around, F.concat(F.lit(" "), F.get("_item_set", F.lit(0)), F.lit(" "))).cast("long")
    shared = F.when(F.col("_short"), whole).otherwise(F.size(F.array_intersect("_item_set", shingles(F.col("_doc_words"), n))).cast("long"))
    counted = checked.select("_key", "item", shared.alias("n_shared"), F.size("_item_set").cast("long").alias("n_shingles"))
    least = F.ceil(F.col("n_shingles") * F.lit(threshold) - F.lit(1e-9))
    # The test stays above the aggregate: pushed down, it would compute the words of a text per shingle.
    found = counted.groupBy("_key", "item").agg(F.max(F.struct((F.col("n_shared") >= least).alias("ok"), "n_shared", "n_shingles")).alias("_m"))
    return found.where("_m.ok").select(
        F.col("_key").alias(key), F.col("item").alias(item), "_m.n_shared", "_m.n_shingles", (F.col("_m.n_shared") / F.col("_m.n_shingles")).alias("containment")
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold an item. Each text is judged by itself, whatever its id."""
    text = options.get("text", "text")
    own = free_name(docs, "own")
    marked = docs.withColumn(own, F.struct(F.xxhash64(F.lit("own"), text).alias("a"), F.xxhash64(F.lit("text"), text).alias("b")))
    held, _ = written(contaminated(marked, items, own, **options).select(F.col(own).alias("_held")).distinct(), "contaminated")
    return marked.join(held, marked[own] == held["_held"], "left_anti").drop(own)
