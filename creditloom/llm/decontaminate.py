"""Benchmark decontamination with windows of normalised words, in DataFrame functions only.

Benchmark items become windows of ten words (a shorter item is one window). Their hashes form a set that is broadcast while
its counted size is below a bound; beyond it Spark joins by shuffle. Documents are scanned window by window; a hash that
hits is verified by comparing words. Words inside verified windows are hit. A text is cut into blocks of words first, so that
a window is accompanied by its block and not by its text: time and rows grow with the words of a text, however long it is.

Null and empty texts have no words. Items without words give no window; items without an id mark words but are not listed.
Results depend on the key columns and the text, so repeated rows get equal results, each its own row.
Without items, or in an empty table of documents, nothing is hit. Other columns of any name do not matter and stay untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.texts import lower_ascii, packed, text_of
from creditloom.runtime import materialise

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Windows whose hashes and words may be broadcast: 64 MB or so. Of more windows only the hashes are, up to the second bound: 128 MB or so.
MAX_BROADCAST_WINDOWS, MAX_BROADCAST_HASHES = 500_000, 4_000_000
#: Rows of a key and a digest that may be broadcast: 100 MB or so.
MAX_BROADCAST_DOCUMENTS = 1_000_000
#: Starts of windows in a block.
BLOCK = 64


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def _hash_at(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(words, at + k) for k in range(size)))


def _windows(words: Column, size: int, starts: int | None = None) -> Column:
    """Start, size and hash of every window of ``size`` words; of the first ``starts`` only, if given."""
    last = F.size(words) - size
    return F.when(
        F.size(words) >= size,
        F.transform(F.sequence(F.lit(0), last if starts is None else F.least(last, F.lit(starts - 1))), lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"), _hash_at(words, i, size).alias("hash"))),
    ).otherwise(F.array().cast("array<struct<at:int,size:int,hash:bigint>>"))


def _words_of(words: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, size), " ")


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, list[int]]:
    """Distinct (item, size, hash, gram) and the sizes that occur, ten at most."""
    worded = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), normal_words(text_of(f"`{text}`")).alias("words")).filter(F.size("words") > 0)
    sizes = [r[0] for r in worded.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().sort("n").collect()]
    windows = F.lit(None).cast("array<struct<at:int,size:int,hash:bigint>>")
    for size in sizes:
        windows = F.when(F.least(F.size("words"), F.lit(WINDOW)) == size, _windows(F.col("words"), size)).otherwise(windows)
    worded_windows = F.transform(windows, lambda w: F.struct(w["size"], w["hash"], _words_of(F.col("words"), w["at"], w["size"]).alias("gram")))
    grams = worded.select("item", F.inline(worded_windows)).toDF("item", "size", "hash", "gram").distinct()
    return grams, sizes


def hits(docs: DataFrame, items: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """A row for each document with words hit: ``keys``, ``_digest`` of the text, ``spans`` of hit words, n_hit, items."""
    grams, sizes = benchmark_windows(items)
    grams = materialise(grams, "benchmark-windows")
    known = grams.select("hash", "gram").distinct()
    body = text_of(f"`{text}`")
    worded = docs.select(*(F.col(f"`{k}`") for k in keys), F.md5(body).alias("_digest"), normal_words(body).alias("_words"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("_words") - 1, F.lit(0)), F.lit(BLOCK)),
        lambda i: F.struct(i.alias("base"), F.slice("_words", i + 1, F.lit(BLOCK + WINDOW - 1)).alias("words")),
    )
    cut = worded.select(*keys, "_digest", F.explode(blocks).alias("_b")).select(*keys, "_digest", "_b.base", F.col("_b.words").alias("_words"))
    windows = F.concat(*(_windows(F.col("_words"), n, BLOCK) for n in sizes)) if sizes else F.array().cast("array<struct<at:int,size:int,hash:bigint>>")
    scanned = cut.select(*keys, "_digest", "base", "_words", F.explode(windows).alias("_w")).select(*keys, "_digest", "base", "_words", "_w.at", "_w.size", "_w.hash")
    gram = _words_of(F.col("_words"), F.col("at"), F.col("size"))
    place = (F.col("base") + F.col("at")).cast("int").alias("at")
    n_known = known.count()
    if n_known <= MAX_BROADCAST_WINDOWS:
        same = F.coalesce(gram == F.col("gram"), F.lit(False))
        verified = scanned.join(F.broadcast(known), "hash").filter(same).select(*keys, "_digest", place, "size", "hash", "gram")
    else:
        if n_known <= MAX_BROADCAST_HASHES:
            scanned = scanned.join(F.broadcast(known.select("hash").distinct()), "hash", "left_semi")
        verified = scanned.select(*keys, "_digest", place, "size", "hash", gram.alias("gram")).join(known, ["hash", "gram"], "left_semi")
    found = materialise(verified, "benchmark-hits")
    places = F.array_distinct(F.flatten(F.transform(F.col("windows"), lambda w: F.sequence(w["at"], w["at"] + w["size"] - 1))))
    spans = found.groupBy(*keys, "_digest").agg(F.array_sort(F.collect_set(F.struct("at", "size"))).alias("windows"))
    spans = spans.withColumn("n_hit", F.size(places).cast("long"))
    listed = (
        found.select(*keys, "_digest", "hash", "gram").distinct()
        .join(grams.filter("item IS NOT NULL").select("hash", "gram", "item"), ["hash", "gram"])
        .groupBy(*keys, "_digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    both = _left(spans, listed, keys)
    return both.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))


def _left(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "left") -> DataFrame:
    """Join on keys, null-safe, and the digest of the text."""
    named = right.select(*(F.col(f"`{k}`").alias(f"_r_{k}") for k in keys), F.col("_digest").alias("_r_digest"), *(c for c in right.columns if c not in (*keys, "_digest")))
    match = left["_digest"] == named["_r_digest"]
    for k in keys:
        match &= left[f"`{k}`"].eqNullSafe(named[f"_r_{k}"])
    joined = left.join(named, match, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_r_digest", *(f"_r_{k}" for k in keys))


def report(docs: DataFrame, items: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Per document: words, words hit, the items found, and whether it is contaminated."""
    body = text_of(f"`{text}`")
    rows = docs.select(*(F.col(f"`{k}`") for k in keys), F.md5(body).alias("_digest"), F.size(normal_words(body)).cast("long").alias("n_words"))
    joined = _left(rows, hits(docs, items, keys, text).drop("windows"), keys)
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        *(F.col(f"`{k}`") for k in keys), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        listed.alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The documents without a hit, with all their columns. Texts are only shuffled if the hit documents are too many to broadcast."""
    rows = packed(docs, **{k: F.col(f"`{k}`") for k in keys}, _digest=F.md5(text_of(f"`{text}`")))
    bad = materialise(hits(docs, items, keys, text).select(*keys, "_digest"), "contaminated")
    few = bad.count() <= MAX_BROADCAST_DOCUMENTS
    return _left(rows, F.broadcast(bad) if few else bad, keys, "left_anti").select("_whole.*")
