"""Quality rules: word statistics of each text and line frequency across the documents of a host.

Line rule: lines are normalised (lower case, digits as 0, one space for white space) and hashed; a
line counts once per distinct text of a host, so that exact copies do not rule each other out. Lines
in more than ``max_docs`` texts are removed, whatever the size of the host, and on smaller hosts those in
more than ``max(min_docs, max_share * distinct texts of the host)``. A document is depleted when less
than ``min_left_share`` of its words, or no word, is left.

Edge cases: a null text has no words; a null host is a host of its own; documents with equal host
and text get equal results, repeated rows stay; empty tables give no rows; only the named columns
are read.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .scratch import free_name, written

SPACE = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def window_hashes(words: Column, n=WINDOW) -> Column:
    """A hash for each run of ``n`` words, in order, from the stored hashes of the words."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, n)]))


def repeated_words(hashes: Column, n=WINDOW) -> Column:
    """Words inside windows found twice or more; sorts only texts that repeat a window."""

    def positions(pairs):
        def pick(x, j):
            def same(k):
                return F.coalesce(F.get(pairs, j + k)["h"] == x["h"], F.lit(False))

            return F.when(((j > 0) & same(-1)) | same(1), x["i"])

        return F.sort_array(F.filter(F.transform(pairs, pick), lambda p: p.isNotNull()))

    def covered(at):
        each = F.transform(at, lambda p, j: F.least(F.lit(n), F.coalesce(F.get(at, j + 1) - p, F.lit(n))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = let(let(pairs, positions), covered)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(some)


def _text_keys(host: Column, text: Column) -> dict[str, Column]:
    """Equal for rows with equal host and text."""
    return {"_host": host, "_text_a": F.xxhash64(text), "_text_b": F.xxhash64(F.lit("b"), text), "_bytes": F.octet_length(text)}


_KEYS = ["_text_a", "_text_b", "_bytes"]


def word_stats(docs: DataFrame, text="text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.rlike(line, F.lit(NOT_SPACE)))
    # Separate projections: an array that a lambda looks into must be computed once per row.
    one = docs.withColumns({"_words": words_of(whole), "_lines": lines})
    two = one.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    out = two.withColumn("_windows", window_hashes(F.col("_hashes")))
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_windows")),
        }
    ).drop("_words", "_lines", "_hashes", "_windows")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def normal_lines(text: Column) -> Column:
    """The lines in lower case, digits as 0; only white space that is not a single space is rewritten."""
    plain = F.regexp_replace(F.lower(text), "[\\x20\\x09\\x0B-\\x0D]{2,}|[\\x09\\x0B-\\x0D]", " ")
    return F.split(F.regexp_replace(plain, "[0-9]", "0"), "\n")


def removed_words(docs: DataFrame, host="source", text="text", min_docs=20, max_share=0.05, max_docs=500, with_lines=False) -> DataFrame:
    """Words in over-frequent lines per distinct (host, text) that has such lines; ``with_lines``, the hashes of these lines too."""
    keys = [c.alias(k) for k, c in _text_keys(F.col(host), F.col(text)).items()]
    told = docs.where(F.col(text).isNotNull())
    each = told.select(*keys, F.explode(normal_lines(F.col(text))).alias("_line"))
    each = each.withColumn("_line", F.trim("_line")).where(F.col("_line") != "")
    n_words = F.octet_length("_line") - F.octet_length(F.replace("_line", F.lit(" "), F.lit(""))) + 1
    each = each.select("_host", *_KEYS, F.xxhash64("_line").alias("_hash"), n_words.cast("long").alias("_n"))
    # One row per line and distinct text; copies of a text fall together on the map side.
    per_text = each.groupBy("_host", "_hash", *_KEYS).agg(F.count("*").alias("_times"), F.first("_n").alias("_n"))
    # Written: lines are counted first and looked up then, and texts are split once for both.
    per_text, _ = written(per_text, "lines")
    copies = told.select(*keys).groupBy("_host", *_KEYS).agg(F.count("*").alias("_copies"))
    hosts = copies.groupBy("_host").agg(F.count("*").alias("_docs"))
    counted = per_text.groupBy("_host", "_hash").agg(F.count("*").alias("_found")).where(F.col("_found") > min_docs)
    frequent = (
        counted.alias("c")
        .join(hosts.alias("h"), F.col("c._host").eqNullSafe(F.col("h._host")))
        .where((F.col("_found") > max_docs) | (F.col("_found") > max_share * F.col("_docs")))
        .select("c._host", "c._hash")
    )
    hit = per_text.alias("p").join(
        frequent.alias("f"), F.col("p._host").eqNullSafe(F.col("f._host")) & (F.col("p._hash") == F.col("f._hash"))
    )
    lost = hit.groupBy("p._host", *["p." + k for k in _KEYS]).agg(
        F.sum(F.col("_times") * F.col("_n")).alias("_all"),
        F.count("*").alias("n_frequent_lines"),
        *[F.collect_set("p._hash").alias("_removed")] * with_lines,
    )
    # _times counts the lines of every copy of a text; the division brings that back to one.
    same = F.col("l._host").eqNullSafe(F.col("c._host"))
    for k in _KEYS:
        same = same & (F.col("l." + k) == F.col("c." + k))
    return lost.alias("l").join(copies.alias("c"), same).select(
        "l._host", *["l." + k for k in _KEYS], (F.col("_all") / F.col("_copies")).cast("long").alias("n_removed_words"), "n_frequent_lines", *["_removed"] * with_lines
    )


def without_lines(text: Column, hashes: Column) -> Column:
    """The text without the lines whose normal form has one of the hashes; null hashes remove nothing."""
    lines = F.arrays_zip(F.split(text, "\n").alias("line"), normal_lines(text).alias("normal"))
    kept = F.filter(lines, lambda x: (F.trim(x["normal"]) == "") | ~F.array_contains(hashes, F.xxhash64(F.trim(x["normal"]))))
    return F.when(hashes.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))


def remove_frequent_lines(docs: DataFrame, host="source", text="text", cleaned="cleaned_text", **limits) -> DataFrame:
    """``docs`` with ``cleaned``: each text without its over-frequent lines. Null texts stay null."""
    named = {k: free_name(docs, k.strip("_")) for k in ("_host", *_KEYS, "_removed")}
    keys = _text_keys(F.col(host), F.coalesce(F.col(text), F.lit("")))
    marked = docs.withColumns({named[k]: c for k, c in keys.items()})
    lost = removed_words(docs.select(host, text), host, text, with_lines=True, **limits)
    same = marked[named["_host"]].eqNullSafe(lost["_host"])
    for k in _KEYS:
        same = same & (marked[named[k]] == lost[k])
    joined = marked.join(lost, same, "left")
    return joined.select(*[marked[c] for c in docs.columns], without_lines(marked[text], lost["_removed"]).alias(cleaned))


def quality_rules(docs: DataFrame, host="source", text="text", min_docs=20, max_share=0.05, max_docs=500, min_left_share=0.3) -> DataFrame:
    """Every row of ``docs`` with its statistics, ``n_removed_words``, ``depleted`` and ``kept``."""
    stats = word_stats(docs, text).withColumns(_text_keys(F.col(host), F.coalesce(F.col(text), F.lit("")))).drop(text)
    lost = removed_words(docs, host, text, min_docs, max_share, max_docs)
    same = F.col("s._host").eqNullSafe(F.col("l._host"))
    for k in _KEYS:
        same = same & (F.col("s." + k) == F.col("l." + k))
    joined = stats.alias("s").join(lost.alias("l"), same, "left")
    left = F.col("n_words") - F.col("n_removed_words")
    out = joined.select("s.*", F.coalesce("l.n_removed_words", F.lit(0)).alias("n_removed_words"), F.coalesce("l.n_frequent_lines", F.lit(0)).alias("n_frequent_lines"))
    out = out.withColumn("depleted", (F.col("n_removed_words") > 0) & ((left < 1) | (left < min_left_share * F.col("n_words"))))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")).drop("_host", *_KEYS)
