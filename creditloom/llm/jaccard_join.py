"""Exact n-gram Jaccard join by index lists, with answers taken over from similar sets.

A text's set holds the hashes of its five-word shingles (64 bits; equal hashes count as equal shingles). Two sets link when
their Jaccard similarity is at least a threshold.

* Equal sets are one class and share one answer.
* Texts become sets inside the tasks that read them, once to count, once for each part of the index, and once more for the few to be compared; sets
  are never shuffled whole for all texts. A task hashes the words of many texts at once, as bytes.
* A set is indexed by its neighbours: pairs of elements that follow each other in the order of hashes. An element that a
  partner lacks breaks two of them, one that it has beside breaks one, so the threshold bounds how many a partner can miss; a set
  indexes one more than that (prefix filter). Unlike one element, two neighbours are rarely shared by texts that are not similar,
  however many texts there are. Thresholds below ``PAIRS_FROM`` leave too few whole neighbours; there elements are indexed.
* Neighbours that many sets have come last. A table of counters of fixed size tells them apart, so any corpus gives one total
  order and the filter is exact.
* The index is shuffled in ``TURNS`` parts by hash of the entry, one after the other, so that only one of them is on disk at a time.
* It is sorted by entry and set and scanned as lists. In each list, every set is paired with the list's first set
  only: first one such pair a set is compared, then those whose sets are still apart. A set that links takes the component over;
  pairs inside a component need no check of their own.
* In lists whose sets then lie in several components, sets that share ``TIED`` lists with the same first set meet once through it,
  however many lists they have in common. Only sets that share fewer lists with a list's first set are joined with the list. No
  block of a list is skipped: among the sets of a head, pairs from different components are looked at, the square of their number.
* A pair goes on to be compared only when its sizes, the places of the entry among either set's own, and the bits in which the
  two sets' sketches differ can reach the threshold. A sketch is the parity of the elements that fall on each of its bits; two
  sets differ in at least as many elements as their sketches in bits. Pairs are compared in as many parts as keep what is sent for one
  in proportion to the sets, and what is written on the way goes when it was read for the last time.

Components grow by contraction: every component takes the smallest neighbour's name, names are followed to their end, and only
links between different components go on to the next round.

Null and empty texts have an empty set and link with nothing. Fewer words than a shingle has are one element. Rows of equal id
are rows of their own; a null id is never a component's name unless all its rows lack one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.llm.tasks import map_rows
from creditloom.llm.texts import packed, text_of
from creditloom.runtime import materialise, scratch_scope

SHINGLE = 5
#: The threshold in percent.
SIMILAR = 75
#: The least threshold whose sets are indexed by neighbours.
PAIRS_FROM = 70
#: Counters that estimate how common an entry of the index is; a fixed table of 2 MB.
COUNTERS = 1 << 18
#: Lists with the same first set that a set must be in to meet others through that set instead of in each list.
TIED = 4
#: Words of 64 bits in a set's sketch.
SKETCH = 16
SKETCH_COLUMNS = [f"b{i}" for i in range(SKETCH)]
#: Counters that travel in one row.
CHUNK = 1 << 12
#: Parts of the index that are shuffled after each other, each when the shuffle files of the one before are gone; every part makes the sets anew.
TURNS = 3
#: Rows of the index that a task sorts, about.
SORTED = 1_000_000
#: Bytes of sets that are sent at a time for pairs to be compared, about: these, or a quarter of all sets if that is more.
SENT = 1 << 26

#: Classes or pairs of them that may be named to every task: 32 MB of keys.
MAX_BROADCAST_CLASSES = 1_000_000
#: Classes that a task remembers to have indexed.
KEPT_CLASSES = 200_000
#: Bytes of texts that are hashed together; a longer text is hashed alone.
BYTES_AT_ONCE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits to 64 bits, one to one (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _noise(start: int, end: int) -> np.ndarray:
    return _mixed(np.arange(start, end, dtype=np.uint64) * _MIX)


_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
#: A number for each byte; capitals have that of their small letter, blanks none.
_BYTE = _noise(1, 257)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_BLANK] = 0


def _word_hashes(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where each text's words begin and end among them: sums of numbers of byte times numbers of place in the word."""
    blank = _BLANK[data]
    first = ~blank
    first[1:] &= blank[:-1]
    inner = borders[:-1][borders[:-1] < len(data)]
    first[inner] = ~blank[inner]
    starts = np.flatnonzero(first)
    words = np.searchsorted(starts, borders)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), words
    spans = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    sums = np.add.reduceat(_BYTE[data[starts[0] :]] * (_noise(300, 300 + int(spans.max())) | np.uint64(1))[place], starts - starts[0])
    return _mixed(sums), words


def _chain(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` words from every word on; a chain, so that order counts."""
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = (total ^ words[k : k + len(total)]) * _MIX
        total ^= total >> np.uint64(29)
    return total


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    kept = np.empty(len(values), dtype=bool)
    kept[0] = True
    np.not_equal(values[1:], values[:-1], out=kept[1:])
    return values[kept]


def sets_of(bodies: pa.Array, size: int = SHINGLE) -> Iterator[list[np.ndarray]]:
    """Sorted distinct hashes of the shingles of each text, given in UTF-8 and without nulls, some texts at a time."""
    wide = pa.types.is_large_binary(bodies.type) or pa.types.is_large_string(bodies.type)
    _, places, content = bodies.buffers()
    if not len(bodies):
        return
    at = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[bodies.offset : bodies.offset + len(bodies) + 1].astype(np.int64)
    data = np.frombuffer(content, dtype=np.uint8) if content is not None else np.empty(0, dtype=np.uint8)
    begin = 0
    while begin < len(bodies):
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + BYTES_AT_ONCE, side="right")) - 1)
        words, borders = _word_hashes(data[at[begin] : at[end]], at[begin : end + 1] - at[begin])
        shingles = _chain(words, size).view(np.int64) if len(words) >= size else np.empty(0, dtype=np.int64)
        found = []
        for low, high in zip(borders.tolist(), borders[1:].tolist()):
            if high - low >= size or high == low:
                found.append(_distinct(shingles[low : max(low, high - size + 1)]))
            else:
                found.append(_chain(words[low:high], high - low).view(np.int64))
        yield found
        begin = end


def _class(elements: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(elements.tobytes())).astype(np.int64))


def _sketch(elements: np.ndarray) -> bytes:
    odd = np.bincount(elements & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _entries(elements: np.ndarray, similar: int) -> np.ndarray:
    """What a set may be found by: its neighbours, or its elements."""
    h = elements.view(np.uint64)
    if similar < PAIRS_FROM:
        return _mixed(h)
    return _mixed((h[:-1] * _MIX) ^ (h[1:] >> np.uint64(1)))


@lru_cache(maxsize=1 << 16)
def _missing(n: int, similar: int) -> int:
    """How many entries of a set of n elements a partner can lack; -1 if no other set can be a partner.

    Of a set with n elements, a partner lacks some and has others beside them: 100 * (n - lacked) >= similar * (n + beside).
    """
    if similar < PAIRS_FROM:
        return n - (similar * n + 99) // 100
    room = (100 - similar) * n
    if room < similar:
        return -1
    # a hundred beside cost as much as ``similar`` lacked, which break more
    return max(2 * ((room - similar * beside) // 100) + beside for beside in range(min(room // similar, 100) + 1))


def _members(texts: DataFrame, similar: int, size: int) -> tuple[DataFrame, np.ndarray]:
    """doc_id and digest with the set's class, size and sketch; and how many entries of all sets fall on each counter.

    Every task sums its own table first, and writes it beside its rows.
    """
    schema = T.StructType.fromDDL(f"doc_id {dict(texts.dtypes)['doc_id']}, digest bigint, cls bigint, n bigint, chunk int, counts binary, {', '.join(f'{b} bigint' for b in SKETCH_COLUMNS)}")
    arrow = to_arrow_schema(schema)

    def batch(*columns: list | pa.Array) -> pa.RecordBatch:
        rows = len(next(c for c in columns if c is not None))
        made = [pa.nulls(rows, f.type) if c is None else pa.array(c, type=f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip(columns, arrow)]
        return pa.RecordBatch.from_arrays(made, schema=arrow)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, dtype=np.int64)
        for rows in batches:
            if not rows.num_rows:
                continue
            classes, sizes, sketches = [], [], []
            for sets in sets_of(rows.column(2), size):
                classes.extend(_class(s) for s in sets)
                sizes.extend(len(s) for s in sets)
                sketches.extend(_sketch(s) for s in sets)
                entries = np.concatenate([_entries(s, similar) for s in sets])
                table += np.bincount((entries & np.uint64(COUNTERS - 1)).view(np.int64), minlength=COUNTERS)
            bits = np.frombuffer(b"".join(sketches), dtype=np.int64).reshape(-1, SKETCH)
            yield batch(rows.column(0), rows.column(1), classes, sizes, None, None, *(pa.array(b) for b in bits.T.copy()))
        if table.any():
            chunks = table.reshape(-1, CHUNK)
            yield batch(None, None, None, None, list(range(len(chunks))), [c.tobytes() for c in chunks], *[None] * SKETCH)

    def summed(rows: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[int, np.ndarray] = {}
        for chunk, counts in rows:
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, dtype=np.int64)
        for chunk, counts in sums.items():
            yield chunk, counts.tobytes()

    found = materialise(texts.select("doc_id", "digest", F.col("body").cast("binary")).mapInArrow(work, schema), "members")
    common = np.zeros((COUNTERS // CHUNK, CHUNK), dtype=np.int64)
    for chunk, counts in map_rows(found.filter("chunk IS NOT NULL").select("chunk", "counts").repartition(F.col("chunk")), "chunk int, counts binary", summed).collect():
        common[chunk] = np.frombuffer(counts, dtype=np.int64)
    return found.filter("chunk IS NULL").drop("chunk", "counts"), common.ravel()


def _index(texts: DataFrame, common: np.ndarray, similar: int, size: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """The rarest entries of every set, as many as the filter needs: entry, class, and in one number the set's size and the entry's place.

    Copies that a task meets are indexed once. Each of the ``turns`` has the entries of some hashes, all turns together have all entries.
    """
    # entries are ordered by how common they are, to the power of two, and then by hash
    sent = texts.sparkSession.sparkContext.broadcast(np.frexp(common.astype(np.float64))[1].astype(np.uint8))
    schema = T.StructType.fromDDL("h bigint, cls bigint, size_at bigint")
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = sent.value, set()
        for rows in batches:
            for sets in sets_of(rows.column(0), size):
                chosen, classes, sizes_at, counts = [], [], [], []
                for elements in sets:
                    missing = _missing(len(elements), similar) if len(elements) else -1
                    if missing < 0 or (cls := _class(elements)) in seen:
                        continue
                    if len(seen) >= KEPT_CLASSES:
                        seen.clear()
                    seen.add(cls)
                    entries = _entries(elements, similar)
                    keys = (level[entries & np.uint64(COUNTERS - 1)].astype(np.uint64) << np.uint64(57)) | (entries >> np.uint64(7))
                    keys = np.sort(np.partition(keys, missing)[: missing + 1] if missing < len(keys) else keys)
                    places = np.flatnonzero(keys % np.uint64(turns) == np.uint64(turn))
                    chosen.append(keys[places])
                    classes.append(cls)
                    sizes_at.append(places + (len(elements) << 32))
                    counts.append(len(places))
                if chosen:
                    size_at = np.concatenate(sizes_at)
                    columns = [np.concatenate(chosen).view(np.int64), np.repeat(np.array(classes, dtype=np.int64), counts), size_at]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return texts.select(F.col("body").cast("binary")).mapInArrow(work, schema)


def _lists(index: DataFrame, parts: int) -> DataFrame:
    """Members of lists that several classes share: entry, class, size and place, and the same of the first class of the list."""
    ordered = index.repartition(parts, "h").sortWithinPartitions("h", "cls").select("h", "cls", "size_at")
    schema = T.StructType.fromDDL("h bigint, cls bigint, size_at bigint, head bigint, head_size_at bigint")
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = last = None
        sent = False  # whether the head that came from earlier batches is out
        for found in batches:
            if not found.num_rows:
                continue
            rows = np.stack([found.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            repeated = np.zeros(len(rows), dtype=bool)
            repeated[1:] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
            repeated[0] = last is not None and bool((rows[0, :2] == last[:2]).all())
            last = rows[-1]
            rows = rows[~repeated]
            if head is not None:
                rows = np.concatenate([head[None, :], rows])
            starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            counts = np.diff(np.append(starts, len(rows)))
            heads = np.repeat(rows[starts], counts, axis=0)
            out = np.repeat(counts > 1, counts)
            if sent:
                out[0] = False
            sent = bool(counts[-1] > 1 or (sent and len(starts) == 1))
            head = rows[starts[-1]]
            if out.any():
                columns = [*rows[out].T, *heads[out, 1:].T]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return materialise(ordered.mapInArrow(work, schema), "index-lists")


def _shared(n_x: Column, n_y: Column, similar: int) -> Column:
    """How many elements two sets of these sizes must share."""
    return F.floor(((n_x + n_y) * similar + (99 + similar)) / (100 + similar))


def _in_reach(x: str, y: str, similar: int) -> Column:
    """Whether two sets can reach the threshold if this entry, by size and place in both, is the first that they share.

    The entries before it are all missing in the other set, and the threshold bounds how many can be.
    """
    (n_x, at_x), (n_y, at_y) = ((F.shiftright(c, 32), F.col(c).bitwiseAND(F.lit((1 << 31) - 1))) for c in (x, y))
    shared = _shared(n_x, n_y, similar)
    own_x, own_y = n_x - shared, n_y - shared
    most_x, most_y = (2 * own_x + own_y, 2 * own_y + own_x) if similar >= PAIRS_FROM else (own_x, own_y)
    return (own_x >= 0) & (own_y >= 0) & (at_x <= most_x) & (at_y <= most_y)


def _sketches_near(x: str, y: str, n_x: Column, n_y: Column, similar: int) -> Column:
    """Whether the sketches, in columns of these endings, differ in no more bits than sets that reach the threshold may in elements."""
    apart = sum((F.bit_count(F.col(b + x).bitwiseXOR(F.col(b + y))) for b in SKETCH_COLUMNS), F.lit(0))
    return apart <= n_x + n_y - 2 * _shared(n_x, n_y, similar)


def _near_pairs(mixed: DataFrame, similar: int) -> DataFrame:
    """Pairs (a, b) of sets that share a list, lie in different components and by sizes and sketches can reach the threshold.

    ``mixed`` has the lists without their first sets; ``tied`` says whether a set meets others through that first set.
    """

    def sides(left: DataFrame, right: DataFrame, by: str) -> tuple[DataFrame, DataFrame, Column]:
        x, y = (d.select(by, *(F.col(c).alias(f"{c}_{s}") for c in d.columns if c != by)) for d, s in ((left, "x"), (right, "y")))
        n_x, n_y = F.col("n_x"), F.col("n_y")
        near = (F.least(n_x, n_y) >= _shared(n_x, n_y, similar)) & _sketches_near("_x", "_y", n_x, n_y, similar)
        return x, y, (x[by] == y[by]) & (F.col("root_x") != F.col("root_y")) & near

    pair = [F.greatest("cls_x", "cls_y").alias("a"), F.least("cls_x", "cls_y").alias("b")]
    tied = materialise(mixed.filter("tied").drop("h", "size_at", "tied").dropDuplicates(["head", "cls"]), "tied-sets")
    x, y, near = sides(tied, tied, "head")
    through_heads = x.join(y, near & (F.col("cls_x") < F.col("cls_y"))).select(*pair)
    x, y, near = sides(mixed.filter("NOT tied"), mixed, "h")
    in_lists = x.join(y, near & (F.col("tied_y") | (F.col("cls_x") < F.col("cls_y"))) & _in_reach("size_at_x", "size_at_y", similar)).select(*pair)
    return through_heads.union(in_lists).distinct()


def _named(df: DataFrame) -> DataFrame:
    """A written table of classes or pairs, told to every task if that is small."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_CLASSES else df


def _sets(pairs: DataFrame, firsts: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The sets of the classes in ``pairs``. ``firsts`` names one text of each class, whose set is made anew."""
    named = _named(materialise(firsts.select("cls", "first").join(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "cls", "left_semi"), "compared-classes"))
    match = (texts["digest"] == named["first.digest"]) & texts["doc_id"].eqNullSafe(named["first.doc_id"])
    schema = T.StructType.fromDDL("cls bigint, n bigint, elements binary")
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            at = 0
            for sets in sets_of(rows.column(1), size):
                columns = [rows.column(0).slice(at, len(sets)), pa.array([len(s) for s in sets], type=arrow[1].type), pa.array([s.tobytes() for s in sets], type=arrow[2].type)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                at += len(sets)

    made = texts.join(named, match).select("cls", F.col("body").cast("binary").alias("body")).mapInArrow(work, schema)
    return materialise(made.dropDuplicates(["cls"]), "compared-sets")


def _linked(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    left, right = (sets.select(F.col("cls").alias(c), F.col("elements").alias(f"set_{c}")) for c in "ab")

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for a, b, *both in rows:
            x, y = (np.frombuffer(v, dtype=np.int64) for v in both)
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= similar * (len(x) + len(y) - common):
                yield a, b

    return materialise(map_rows(pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b"), "a bigint, b bigint", work), "links")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the components of both, root_a and root_b, where they differ."""
    for c in "ab":
        pairs = pairs.join(roots.select(F.col("cls").alias(c), F.col("root").alias(f"root_{c}")), c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    return pairs.filter("root_a != root_b")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, root) after some links (a, b) more, for every class but those that are their component's smallest, its root."""
    while True:
        ends = _between(links, roots).select(F.greatest("root_a", "root_b").alias("a"), F.least("root_a", "root_b").alias("b")).distinct()
        links = materialise(ends, "links-between")
        if not links.limit(1).count():
            return roots
        above = materialise(links.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("root")), "labels")
        while True:  # a name is smaller than who takes it, so the names form trees
            up = above.select(F.col("cls").alias("root"), F.col("root").alias("top"))
            jumped = above.join(up, "root", "left").select("cls", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))
            jumped = materialise(jumped, "labels")
            above = jumped.select("cls", "root")
            if not jumped.filter("moved").limit(1).count():
                break
        up = above.select(F.col("cls").alias("root"), F.col("root").alias("top"))
        roots = materialise(roots.join(up, "root", "left").select("cls", F.coalesce("top", "root").alias("root")).union(above), "roots")


def _compared(roots: DataFrame, pairs: DataFrame, sets: DataFrame, similar: int, room: int) -> DataFrame:
    """``roots`` after those of the written pairs (a, b) that reach the threshold.

    The pairs are taken in so many parts that the sets sent along with the pairs of one are about ``room`` bytes, however many pairs there are. Pairs
    that earlier parts have brought into one component are left out of later ones.
    """
    sent = pairs.join(sets.select(F.col("cls").alias("a"), "n"), "a").agg(F.sum(8 * F.col("n"))).first()[0] or 0
    parts = -(-int(sent) // room)
    for k in range(parts):
        part = pairs if parts == 1 else pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == k)
        if k:
            part = _between(part, roots).select("a", "b")
        roots = merged(roots, _linked(part, sets, similar))
    return roots


def _roots(texts: DataFrame, found: DataFrame, common: np.ndarray, parts: int, similar: int, size: int) -> DataFrame:
    """(cls, root) for every class that is not its component's root. The copies written on the way belong to the caller's scope."""
    spark = texts.sparkSession
    same = [F.first(c).alias(c) for c in ("n", *SKETCH_COLUMNS)]
    firsts = materialise(found.filter("n > 0").groupBy("cls").agg(F.min(F.struct("doc_id", "digest")).alias("first"), *same), "classes")
    sketches = firsts.drop("first")
    room = max(int(firsts.agg(F.sum(8 * F.col("n"))).first()[0] or 0) // 4, SENT)
    sorters = max(1, max(parts, int(common.sum()) // (2 * SORTED)) // TURNS)
    lists = reduce(DataFrame.union, [_lists(_index(texts, common, similar, size, turn, TURNS), sorters) for turn in range(TURNS)])
    # every set with the first sets of its lists; one of them first
    pairs = lists.filter("cls != head").filter(_in_reach("size_at", "head_size_at", similar)).groupBy(F.col("cls").alias("a"), F.col("head").alias("b")).agg(F.count("*").alias("shared"))
    for s in "ab":
        pairs = pairs.join(sketches.select(*(F.col(c).alias(s if c == "cls" else c + s) for c in sketches.columns)), s)
    pairs = materialise(pairs.filter(_sketches_near("a", "b", F.col("na"), F.col("nb"), similar)).select("a", "b", "shared"), "pairs")
    with scratch_scope(spark) as scratch:
        tried = materialise(pairs.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b")), "first-pairs")
        sets = _sets(pairs, firsts, texts, size)
        roots = _compared(spark.createDataFrame([], "cls bigint, root bigint"), tried, sets, similar, room)
        open_pairs = materialise(_between(pairs.select("a", "b"), roots).select("a", "b").join(tried, ["a", "b"], "left_anti"), "open-pairs")
        roots = materialise(_compared(roots, open_pairs, sets, similar, room), "roots")
        scratch.keep_last()
    # lists that still hold several components: those with a set apart from the first one
    others = lists.filter("cls != head").select("h", "cls", "size_at", "head")
    heads = materialise(others.groupBy("cls", "head").agg((F.count("*") >= TIED).alias("tied")), "heads")
    apart = _named(materialise(_between(heads.select(F.col("cls").alias("a"), F.col("head").alias("b")), roots).select(F.col("a").alias("cls"), F.col("b").alias("head")), "apart"))
    hit = materialise(others.join(apart, ["cls", "head"], "left_semi").select("h").distinct(), "mixed-entries")
    mixed = others.join(_named(hit), "h", "left_semi").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    several = mixed.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("h")
    mixed = materialise(mixed.join(several, "h", "left_semi").join(_named(heads), ["cls", "head"]).join(sketches, "cls"), "mixed-lists")
    rest = materialise(_near_pairs(mixed, similar).join(pairs, ["a", "b"], "left_anti"), "rest-pairs")
    if rest.limit(1).count():
        roots = _compared(roots, rest, _sets(rest, firsts, texts, size), similar, room)
    return roots


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id reached), and ``digest``, the hash of its text."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    body = text_of(f"`{text}`")
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("digest"), body.alias("body"))
    found, common = _members(texts, similar, size)
    members = found.select("doc_id", "digest", "cls", "n")
    with scratch_scope(spark) as scratch:
        roots = materialise(_roots(texts, found, common, parts, similar, size), "roots")
        scratch.keep_last()
    named = members.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("low")).join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    names = named.groupBy("root").agg(F.min("low").alias("component_id"))
    answers = named.join(names, "root").select("cls", "component_id")
    return members.join(answers, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "digest"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, the one that names it; documents with an empty set stay. Rows that repeat its id and text stay with it."""
    keepers = link(docs, doc_id, text).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id"), "digest").distinct()
    marked = packed(docs, _doc=F.col(f"`{doc_id}`"), _digest=F.xxhash64(text_of(f"`{text}`")))
    match = marked["_doc"].eqNullSafe(keepers["_id"]) & (marked["_digest"] == keepers["digest"])
    return marked.join(keepers, match, "left_semi").select("_whole.*")
