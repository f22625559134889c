"""Passages of benchmark items in documents, by spaced-seed hashing.

Words are lower-case runs of letters and digits. A seed is a mask over twelve
consecutive words; eight of them count, the other positions may hold anything, so a
few substituted words do not hide a passage. Two of the masks leave out every third
and every fourth word, which the others would meet wherever they begin. Seeds of items
and documents are joined on the hash of the words that count. Around each hit the two
texts are compared word by word, up to six words to either side of the seed: at least ten
and 60 % of the compared words must be equal, or eleven of the seed's own twelve (an
excerpt that is no longer than the seed). Items of five to eleven words are compared whole.

All work is built-in expressions on one pass over the documents (a second one if there
are short items). The item side holds each seed once for every different context, so
repeated words multiply nothing; it is broadcast only if it was counted to be small
(16 bytes a seed), else the join is a shuffled one.

Defined cases: null and empty texts, and items of fewer than five words, match
nothing; repeated rows are told apart by nothing but their id, so their hits are found
at the same words; rows with null ids are reported with null ids; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmill.llm.common import texts, written

#: The positions that count in each mask.
MASKS = (
    (0, 1, 2, 4, 6, 7, 10, 11),
    (0, 2, 3, 5, 6, 8, 9, 11),
    (0, 1, 3, 4, 7, 8, 10, 11),
    (0, 1, 3, 4, 6, 7, 9, 10),
    (0, 1, 2, 4, 5, 6, 8, 9),
)
SPAN = 12


@dataclass(frozen=True)
class Settings:
    context: int = 6
    least_words: int = 10
    least_share: float = 0.6
    own_words: int = SPAN - 1
    shortest_item: int = 5
    broadcast_seeds: int = 500_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words; equal words have equal hashes."""
    words = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(h: Column, at: Column) -> Column:
    """Hash of what counts at a position, for each mask."""
    keys = [F.xxhash64(F.lit(m), *(F.get(h, at + k) for k in mask)) for m, mask in enumerate(MASKS)]
    return F.array(*keys)


def whole(h: Column, at: Column, n: int) -> Column:
    """Hash of n words from a position, for items of that length."""
    return F.xxhash64(F.lit(-n), *(F.get(h, at + k) for k in range(n)))


def positions(h: Column, span: int = SPAN) -> Column:
    return F.when(F.size(h) >= span, F.sequence(F.lit(0), F.size(h) - span))


def _equal(x: Column, y: Column) -> Column:
    """In how many places two lists of words agree."""
    same = F.zip_with(x, y, lambda p, q: F.coalesce((p == q).cast("int"), F.lit(0)))
    return F.aggregate(same, F.lit(0), lambda n, e: n + e)


def hits(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Verified hits: doc_id, item_id, doc_word (where the seed begins), n_equal of n_compared words.
    One row for each word of a document and different context in an item, however many masks agree."""
    c = settings.context
    items = benchmark.select("item_id", word_hashes(F.coalesce("text", F.lit(""))).alias("g"))
    items = written(items.select("item_id", "g", F.xxhash64("item_id", "g").alias("item")).distinct(), "items")
    size = F.size("g")
    is_short = (size >= settings.shortest_item) & (size < SPAN)
    shorts = sorted(r.n for r in items.where(is_short).select(size.alias("n")).distinct().collect())  # seven at most

    # contexts of items: the words around a seed, and how many of them stand before it
    long = items.select("item", "item_id", "g", F.explode(positions(F.col("g"))).alias("j")).select(
        "item", "item_id", F.lit(SPAN).alias("span"), F.least("j", F.lit(c)).alias("before"),
        F.expr(f"slice(g, greatest(j - {c}, 0) + 1, least(j, {c}) + {SPAN + c})").alias("y"),
        seeds(F.col("g"), F.col("j")).alias("seeds"),
    )
    contexts = long
    for n in shorts:
        at = items.where(size == n).select(
            "item", "item_id", F.lit(n).alias("span"), F.lit(0).alias("before"), F.col("g").alias("y"),
            F.array(whole(F.col("g"), F.lit(0), n)).alias("seeds"),
        )
        contexts = contexts.unionByName(at)
    contexts = contexts.withColumn("context", F.xxhash64("item", "span", "before", "y"))
    contexts = written(contexts.dropDuplicates(["context"]), "contexts")
    at = written(contexts.select("context", F.explode("seeds").alias("seed")).distinct(), "seeds")
    few = at.limit(settings.broadcast_seeds + 1).count() <= settings.broadcast_seeds

    words = texts(docs).select("doc_id", word_hashes(F.col("text")).alias("h"))
    own = words.select("doc_id", "h", F.explode(positions(F.col("h"))).alias("i"))
    own = own.select("doc_id", "h", "i", F.explode(seeds(F.col("h"), F.col("i"))).alias("seed"))
    for n in shorts:
        more = words.select("doc_id", "h", F.explode(positions(F.col("h"), n)).alias("i"))
        own = own.unionByName(more.select("doc_id", "h", "i", whole(F.col("h"), F.col("i"), n).alias("seed")))
    near = F.expr(f"slice(h, greatest(i - {c}, 0) + 1, least(i, {c}) + {SPAN + c})")
    if not few:  # a shuffled join must not carry whole documents
        own = own.select("doc_id", "i", "seed", near.alias("h0"))
        near = F.col("h0")
    found = own.join(F.broadcast(at) if few else at, "seed").select("doc_id", "context", "i", near.alias("x"))
    found = found.join(contexts.select("context", "item_id", "span", "before", "y"), "context")
    # both lists begin up to ``c`` words before the seed; align their beginnings
    both = F.least(F.col("i"), F.col("before"))
    length = F.when(F.col("span") == SPAN, both + SPAN + c).otherwise(F.col("span"))
    x = F.slice("x", F.least("i", F.lit(c)) - both + 1, length)
    y = F.slice("y", F.col("before") - both + 1, length)
    found = found.select("doc_id", "item_id", "i", "span", x.alias("x"), y.alias("y"), both.alias("both"))
    found = found.select(
        "doc_id", "item_id", F.col("i").cast("long").alias("doc_word"), _equal(F.col("x"), F.col("y")).cast("long").alias("n_equal"),
        F.least(F.size("x"), F.size("y")).cast("long").alias("n_compared"), "span",
        _equal(F.slice("x", F.col("both") + 1, F.col("span")), F.slice("y", F.col("both") + 1, F.col("span"))).alias("own"),
    )
    enough = (F.col("n_equal") >= settings.least_words) & (F.col("n_equal") >= settings.least_share * F.col("n_compared"))
    enough = F.when(F.col("span") == SPAN, enough | (F.col("own") >= settings.own_words)).otherwise(F.col("own") == F.col("span"))
    return found.where(enough).select("doc_id", "item_id", "doc_word", "n_equal", "n_compared").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, n_hits (words of the document at which a seed is confirmed), best_equal, first_word
    for each document and item that overlap."""
    at = hits(docs, benchmark, settings).groupBy("doc_id", "item_id", "doc_word").agg(F.max("n_equal").alias("n_equal"))
    return at.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_hits"), F.max("n_equal").alias("best_equal"), F.min("doc_word").alias("first_word")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, whole and unchanged, that hold no passage of an item. Rows without
    an id are told apart by their text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.sha2(F.coalesce("text", F.lit("")), 256)))
    found = hits(docs.select(key.alias("doc_id"), "text"), benchmark, settings)
    gone = written(found.select(F.col("doc_id").alias("gone_key")).distinct(), "leaks")
    return docs.join(gone, key == F.col("gone_key"), "left_anti").select(docs.columns)
