"""A hidden Markov language model, trained by Baum-Welch and scored by the scaled forward recursion.

States emit word classes; a class emits its words by their smoothed counts. So the model's state-by-class table has a fixed
size, while the counts behind it hold every word of the training texts and grow with them:

    P(text) = forward(classes) * product of (count + 1) / (class count + class words + 1)

A frequent word (at least one token in ``1 / HOT_SHARE``, so no more than ``1 / HOT_SHARE`` words) may have a class of its own;
the rest share classes by hash. Frequent words' counts go to every task, a size bounded by that share; counts of rare words are
joined by shuffle, on keys that are rare by definition. Each Baum-Welch step sends every partition's expected counts, a table
of fixed size, into one sum. Steps go on until the likelihood, with the priors, settles; it never falls from step to step, so
they end. A text is one sequence whatever its length: forward and backward states are carried over the borders of segments.

Tokens are words in lower case (A-Z only) and one end for each text. Null and empty texts are one end. Rows are scored one by
one, so repeated rows and null ids give a row each; a null id counts as the empty text in the choice of training rows.
An empty training set gives a model that knows no word.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.llm.tasks import map_rows
from creditloom.runtime import materialise

#: The end's name among words; no word is empty.
END = ""
#: Places of the sequences that advance together, some 75 MB while training.
PLACES_AT_ONCE = 1 << 20
#: Places of the sequences that are ordered by length before they are trained in groups, 16 MB.
PLACES_ORDERED = 1 << 23
#: What a text counts beside its places, so that short ones are not held in any number.
PLACES_OF_A_TEXT = 64
#: A text longer than this is trained by segments of this size.
SEGMENT = 1 << 18
#: Steps after which the forward states are scaled to a sum of 1.
RESCALED_EVERY = 8
#: Distinct words that a task holds at a time, with their counts or classes.
KEPT_WORDS = 200_000


@dataclass(frozen=True)
class Plan:
    states: int = 4
    #: training ends when a step raises the log likelihood by less than this share of it
    settled: float = 1e-4
    #: share of tokens from which a word's count goes to every task
    hot_share: float = 1 / 65536
    #: frequent words with a class of their own
    own_classes: int = 2048
    #: classes that all other words share by hash
    shared_classes: int = 256
    #: added to every expected count of first states and moves
    smoothing: float = 0.1
    #: tokens that follow the shares of classes in all texts, added to every state's emissions
    prior_tokens: float = 1000.0


PLAN = Plan()


def held_out(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _tokens(text: str | None) -> list[bytes]:
    """The tokens in UTF-8. Bytes have no capitals but A-Z and no blanks but those of ASCII."""
    found = (text or "").encode("utf-8").lower().split()
    found.append(END.encode())
    return found


# -- the recursion ------------------------------------------------------------------------------------------------------


def _side_by_side(texts: list[np.ndarray]) -> tuple[list[int], list[int], np.ndarray]:
    """The texts from the longest to the shortest, and their classes by time: those of time t stand from at[t] to at[t + 1]."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
    at = np.concatenate([[0], np.cumsum(active)])
    flat = np.empty(at[-1], dtype=np.intp)
    for place, i in enumerate(order):
        flat[at[: lengths[place]] + place] = texts[i]
    return order, at.tolist(), flat


def forward(start: np.ndarray, move: np.ndarray, emit: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each class sequence. All sequences advance together; each leaves when it ends."""
    out = np.zeros(len(texts))
    if not len(texts):
        return out
    order, at, flat = _side_by_side(texts)
    total, onward = np.zeros(len(order)), np.ascontiguousarray(move.T)
    state = np.broadcast_to(start[:, None], (len(start), len(order)))  # state, text
    for t, (begin, end) in enumerate(zip(at, at[1:])):
        n = end - begin
        if n < state.shape[1]:
            total[n : state.shape[1]] += np.log(state[:, n:].sum(axis=0))
            state = state[:, :n]
        state = (state if t == 0 else onward @ state) * emit[:, flat[begin:end]]
        if t % RESCALED_EVERY == RESCALED_EVERY - 1:
            scale = state.sum(axis=0)
            state /= scale
            total[:n] += np.log(scale)
    total[: state.shape[1]] += np.log(state.sum(axis=0))
    out[order] = total
    return out


def expected(start: np.ndarray, move: np.ndarray, emit: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of first states, moves and emissions of class sequences, by the scaled forward and backward recursions, and the log likelihood."""
    k = len(start)
    _, at, flat = _side_by_side(texts)
    onward, last = np.ascontiguousarray(move.T), len(at) - 2
    seen = np.take(emit, flat, axis=1)  # state, place
    ahead = np.empty((k, len(flat)))
    scales: dict[int, tuple[int, np.ndarray]] = {}  # by time: the first text that is scaled, and the scales
    state, value = np.broadcast_to(start[:, None], (k, at[1])), 0.0
    for t, (begin, end) in enumerate(zip(at, at[1:])):
        n = end - begin
        here = ahead[:, begin:end]
        np.multiply(state if t == 0 else onward @ state[:, :n], seen[:, begin:end], out=here)
        going_on = at[t + 2] - end if t < last else 0
        due = t % RESCALED_EVERY == RESCALED_EVERY - 1
        if due or going_on < n:  # a text that ends is scaled, too
            low = 0 if due else going_on
            scale = here[:, low:].sum(axis=0)
            here[:, low:] /= scale
            scales[t] = low, scale
            value += float(np.log(scale).sum())
        state = here
    moves, back = np.zeros((k, k)), np.ones((k, 0))
    for t in range(last, -1, -1):
        begin, end = at[t], at[t + 1]
        n = end - begin
        if back.shape[1] < n:
            back = np.concatenate([back, np.ones((k, n - back.shape[1]))], axis=1)
        coming = seen[:, begin:end]
        coming *= back
        if t in scales:
            low, scale = scales[t]
            coming[:, low:] /= scale
        ahead[:, begin:end] *= back  # from now on the states' weights
        if t:
            moves += ahead[:, at[t - 1] : at[t - 1] + n] @ coming.T
            back = move @ coming
    emissions = np.stack([np.bincount(flat, weights=weights, minlength=emit.shape[1]) for weights in ahead])
    return ahead[:, : at[1]].sum(axis=1), moves * move, emissions, value


def expected_long(start: np.ndarray, move: np.ndarray, emit: np.ndarray, text: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """``expected`` of one sequence that is held a segment at a time: forward over all segments, then back, each walked forward again."""
    by_class = np.ascontiguousarray(emit.T)
    k, borders = len(start), range(0, len(text), segment)

    def ahead_of(state: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward states and scales of a segment, from the state before its first emission."""
        states, scales = np.empty((len(part), k)), np.empty(len(part))
        for t, c in enumerate(part.tolist()):
            state = (state if t == 0 else state @ move) * by_class[c]
            scales[t] = state.sum()
            states[t] = state = state / scales[t]
        return states, scales

    entries, value = [start], 0.0
    for at in borders:
        states, scales = ahead_of(entries[-1], text[at : at + segment])
        entries.append(states[-1] @ move)
        value += float(np.log(scales).sum())
    moves, emissions, coming = np.zeros((k, k)), np.zeros_like(emit), None
    for at, entry in zip(reversed(borders), reversed(entries[:-1])):
        part = text[at : at + segment]
        states, scales = ahead_of(entry, part)
        weights = np.empty((len(part), k))
        for t in range(len(part) - 1, -1, -1):
            if coming is None:  # the text's end
                back = np.ones(k)
            else:
                moves += np.outer(states[t], coming)
                back = move @ coming
            weights[t] = states[t] * back
            coming = by_class[part[t]] * back / scales[t]
        emissions += np.stack([np.bincount(part, weights=weights[:, s], minlength=emit.shape[1]) for s in range(k)])
    return weights[0], moves * move, emissions, value


# -- training -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    #: log10 of each class's denominator; a class that is one word needs no room for unseen words
    spread: np.ndarray
    #: shares of classes in the training texts, unseen words included
    shares: np.ndarray
    hot: dict[str, tuple[int, int]]  # word: count, class
    own: int
    shared: int
    n_tokens: int
    n_words: int

    def class_of(self, word: str) -> int:
        found = self.hot.get(word)
        return found[1] if found else self.own + zlib.crc32(word.encode()) % self.shared


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """The count of every word of the texts, the end among them, as a written table. Tasks add up repeated words before they are shuffled."""
    schema = T.StructType.fromDDL("word string, c bigint")
    arrow = to_arrow_schema(schema)

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), type=pa.binary()).cast(arrow[0].type), pa.array(list(counts.values()), type=arrow[1].type)], schema=arrow)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for found in batches:
            for body in found.column(0):
                counts.update(_tokens(body.as_py()))
                if len(counts) >= KEPT_WORDS:
                    yield batch(counts)
                    counts = Counter()
        if counts:
            yield batch(counts)

    parts = docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(work, schema)
    return materialise(parts.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def initial(counts: DataFrame, plan: Plan = PLAN) -> Model:
    """Frequent words, classes and a start for Baum-Welch: class shares with a fixed ripple that tells the states apart."""
    n_tokens, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    bar = max(1, math.ceil(n_tokens * plan.hot_share))
    hot_rows = counts.filter((F.col("c") >= bar) | (F.col("word") == END)).collect()  # no more than 1 / hot_share words and the end
    ranked = sorted(hot_rows, key=lambda r: (r["word"] != END, -r["c"], r["word"]))
    own = plan.own_classes
    hot = {r["word"]: (r["c"], i if i < own else own + zlib.crc32(r["word"].encode()) % plan.shared_classes) for i, r in enumerate(ranked)}
    size = own + plan.shared_classes
    tokens_in, words_in = np.zeros(size), np.zeros(size)
    for count, place in hot.values():
        tokens_in[place] += count
        words_in[place] += 1
    bucket = (F.crc32(F.col("word").cast("binary")) % plan.shared_classes).alias("b")
    for b, c, n in counts.filter((F.col("c") < bar) & (F.col("word") != END)).groupBy(bucket).agg(F.sum("c"), F.count("*")).collect():
        tokens_in[own + b] += c
        words_in[own + b] += n
    k = plan.states
    ripple = 0.5 + np.random.RandomState(7).rand(k, size)
    room = tokens_in + words_in + (np.arange(size) >= own)
    shares = np.maximum(room, 1e-3)  # classes without a word are never met
    shares /= shares.sum()
    emit = shares[None, :] * ripple
    return Model(
        np.full(k, 1 / k), np.full((k, k), 0.5 / k) + 0.5 * np.eye(k), emit / emit.sum(axis=1, keepdims=True),
        np.log10(np.maximum(room, 1)), shares, hot, own, plan.shared_classes, n_tokens, n_words,
    )


class _Classes(dict):
    """Classes of words in UTF-8: the frequent words, and others as they come, bounded in number."""

    def __init__(self, model: Model) -> None:
        super().__init__((word.encode("utf-8"), place) for word, (_, place) in model.hot.items())
        self.own, self.shared, self.room = model.own, model.shared, len(self) + KEPT_WORDS

    def __missing__(self, word: bytes) -> int:
        found = self.own + zlib.crc32(word) % self.shared
        if len(self) < self.room:
            self[word] = found
        return found


def encode(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts as classes, once: with the part of the score that frequent words decide, and the rare words with their numbers."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        m = known.value
        logs = {word.encode("utf-8"): math.log10(count + 1) for word, (count, _) in m.hot.items()}
        class_of = _Classes(m).__getitem__
        for key, out, body in rows:
            found = _tokens(body)
            classes = np.fromiter(map(class_of, found), dtype="<u2", count=len(found))
            times = Counter(found)
            hot = [(w, n) for w, n in times.items() if w in logs]
            rare = [w for w in times if w not in logs]
            yield (
                key, out, len(found), sum(n for _, n in hot), math.fsum(logs[w] * n for w, n in hot), float(m.spread[classes].sum()), classes.tobytes(),
                [w.decode("utf-8") for w in rare], [times[w] for w in rare],
            )

    kind = dict(docs.dtypes)[doc_id]
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, hot_known bigint, hot_log double, spread double, classes binary, "
        "rare array<string>, rare_n array<bigint>"
    )
    rows = map_rows(docs.select(F.col(f"`{doc_id}`"), held_out(doc_id), F.col(f"`{text}`")), schema, work)
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "word-classes")


def grouped(texts: Iterable[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """The texts in their order, in groups that end with the text that brings the places to ``most``."""
    group: list[np.ndarray] = []
    places = 0
    for text in texts:
        group.append(text)
        places += len(text) + PLACES_OF_A_TEXT
        if places >= most:
            yield group
            group, places = [], 0
    if group:
        yield group


def baum_welch(encoded: DataFrame, model: Model, plan: Plan = PLAN) -> Model:
    """The model after as many passes over the training rows as it takes to settle.

    A group takes as many steps of time as its longest text has places, so texts of like length go together, and a task gets
    enough of them: small partitions are joined, down to one for each core.
    """
    cores = encoded.sparkSession.sparkContext.defaultParallelism
    training = encoded.filter("NOT held_out").select("classes").coalesce(max(cores, math.ceil(model.n_tokens / PLACES_ORDERED)))
    start, move, emit = model.start, model.move, model.emit
    k = plan.states
    before = None
    while model.n_tokens:
        sent = encoded.sparkSession.sparkContext.broadcast((start, move, emit))

        def work(rows: Iterator[tuple], sent=sent) -> Iterator[tuple]:
            params = sent.value
            sums = [np.zeros_like(p) for p in params] + [np.zeros(1)]

            def add(found: tuple) -> None:
                for total, part in zip(sums, found):
                    total += part

            def texts() -> Iterator[np.ndarray]:
                for (data,) in rows:
                    classes = np.frombuffer(data, dtype="<u2")
                    if len(classes) > SEGMENT:
                        add(expected_long(*params, classes))
                    else:
                        yield classes

            for ordered in grouped(texts(), PLACES_ORDERED):
                for group in grouped(sorted(ordered, key=len), PLACES_AT_ONCE):
                    add(expected(*params, group))
            for kind, total in enumerate(sums):
                for row, values in enumerate(np.atleast_2d(total)):
                    for place in np.flatnonzero(values).tolist():
                        yield kind, row, place, float(values[place])

        counts = map_rows(training, "kind int, row int, place int, x double", work).groupBy("kind", "row", "place").agg(F.sum("x").alias("x")).collect()
        sums = [np.zeros((1, k)), np.zeros((k, k)), np.zeros_like(emit), np.zeros((1, 1))]
        for kind, row, place, x in counts:
            sums[kind][row, place] = x
        sent.unpersist()
        # what the steps raise: the likelihood times the priors, whose exponents are the added counts
        value = sums[3][0, 0] + plan.smoothing * (np.log(start).sum() + np.log(move).sum()) + plan.prior_tokens * (np.log(emit) @ model.shares).sum()
        if before is not None and value - before < plan.settled * abs(value):
            break
        before = value
        smooth = [sums[0] + plan.smoothing, sums[1] + plan.smoothing, sums[2] + plan.prior_tokens * model.shares]
        start, move, emit = smooth[0][0] / smooth[0].sum(), *(s / s.sum(axis=1, keepdims=True) for s in smooth[1:])
    return Model(start, move, emit, model.spread, model.shares, model.hot, model.own, model.shared, model.n_tokens, model.n_words)


def score(encoded: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """Per document: base_score from counts alone, and score, the model's log10 probability of the text."""
    params = encoded.sparkSession.sparkContext.broadcast((model.start, model.move, model.emit))

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        group: list[tuple] = []
        places = 0

        def flush() -> Iterator[tuple]:
            for row, value in zip(group, forward(*params.value, [np.frombuffer(r[-1], dtype="<u2") for r in group])):
                yield (*row[:-1], float(value) / math.log(10))

        for row in rows:
            group.append(row)
            places += len(row[-1]) // 2 + PLACES_OF_A_TEXT
            if places >= PLACES_AT_ONCE:
                yield from flush()
                group, places = [], 0
        if group:
            yield from flush()

    names = ["row", "doc_id", "held_out", "n_tokens", "hot_known", "hot_log", "spread"]
    kinds = dict(encoded.dtypes)
    walked = map_rows(encoded.select(*names, "classes"), ", ".join(f"{n} {kinds[n]}" for n in names) + ", walk double", work)
    rare = encoded.select("row", F.explode(F.arrays_zip(F.col("rare").alias("word"), F.col("rare_n").alias("n"))).alias("r")).select("row", "r.word", "r.n")
    known = rare.join(counts, "word").groupBy("row").agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log"))
    logs = F.col("hot_log") + F.coalesce("rare_log", F.lit(0.0))
    return walked.join(known, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(math.log10(model.n_tokens + model.n_words + 1))).alias("base_score"),
        (logs - F.col("spread") + F.col("walk")).alias("score"),
    )


def train_and_score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plan: Plan = PLAN) -> DataFrame:
    """Learn from the rows that are not held out, score all."""
    counts = count_words(docs.filter(~held_out(doc_id)), text)
    model = initial(counts, plan)
    encoded = encode(docs, model, doc_id, text)
    return score(encoded, counts, baum_welch(encoded, model, plan))
