"""The Jaccard join by neighbours, sketches and contraction; training in groups of texts of like length."""

import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditloom import runtime
from creditloom.llm import hmm_lm, jaccard_join

TEXTS = ["", " \t a B\x0bc\n", "a b c d e f", "é É x y z w q", "A b C d e", " x", "x ", "one\u0085two three four five six seven", "x" * 9000 + " y z a b c"]


def shingles(text):
    words = re.findall(r"[^ \x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def test_sets_of_many_texts(monkeypatch):
    bodies = pa.array([t.encode() for t in TEXTS * 3])
    at_once = [s for sets in jaccard_join.sets_of(bodies) for s in sets]
    assert [len(s) for s in at_once] == [len(shingles(t)) for t in TEXTS * 3]
    distinct = {tuple(s.tolist()) for s in at_once}
    assert len(distinct) == len({frozenset(shingles(t)) for t in TEXTS})
    monkeypatch.setattr(jaccard_join, "BYTES_AT_ONCE", 10)
    sliced = [s for sets in jaccard_join.sets_of(bodies.slice(3, 20)) for s in sets]
    assert [s.tolist() for s in sliced] == [s.tolist() for s in at_once[3:23]]


@pytest.mark.parametrize("similar", [70, 75, 90])
def test_entries_that_a_partner_can_lack(similar):
    for n in range(1, 50):
        partners = [2 * a + b for a in range(n) for b in range(2 * n) if a + b and 100 * (n - a) >= similar * (n + b)]
        found = jaccard_join._missing(n, similar)
        assert found == max(partners, default=-1) and found < n - 1


def test_chance_shingles_share_no_list(spark):
    rnd = np.random.RandomState(5)
    common = [[f"c{i}.{k}" for k in range(5)] for i in range(20)]
    texts = []
    for i in range(120):  # any two of these texts share shingles, none is similar to another
        parts = [common[j] for j in rnd.choice(20, 6, replace=False)]
        texts.append(" ".join(w for p in parts for w in [*(f"{i}.{x}" for x in rnd.randint(10**6, size=12)), *p]))
    docs = spark.createDataFrame([(t,) for t in texts], "body string")
    lists = jaccard_join._lists(jaccard_join._index(docs, np.zeros(jaccard_join.COUNTERS, dtype=np.int64), 75, 5), 3)
    assert lists.count() < 60


def test_looser_thresholds(spark):
    rnd = np.random.RandomState(8)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(80):
        w = list(base)
        for at in rnd.randint(0, 80, rnd.randint(0, 8)):
            w[at] = f"x{rnd.randint(1000)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [shingles(t) for t in texts]
    for similar in (50, 90):
        root = list(range(len(texts)))
        for _ in texts:
            for i, s in enumerate(sets):
                root[i] = min(root[j] for j, o in enumerate(sets) if 100 * len(s & o) >= similar * len(s | o))
        got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link(docs, similar=similar).collect()}
        assert got == dict(enumerate(root))


def joined_rows(plan):
    """The most rows that a join below ``plan`` has made."""
    kind, below = plan.getClass().getSimpleName(), plan.children()
    if kind == "AdaptiveSparkPlanExec":
        return joined_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return joined_rows(plan.plan())
    own = [plan.metrics().get("numOutputRows").get().value()] if "Join" in kind else []
    return max([*own, *(joined_rows(below.apply(i)) for i in range(below.size()))], default=0)


def test_copies_apart_meet_once_a_head(spark, monkeypatch):
    rnd = np.random.RandomState(3)
    texts = []
    for i in range(24):  # any two of them differ in too much to link, and share hundreds of entries
        words = [f"w{k}" for k in range(1500)]
        for at in rnd.choice(1500, 30, replace=False):
            words[at] = f"x{i}.{at}"
        texts.append(words)
    for i in range(3):
        texts.append([*texts[i][:700], "other", *texts[i][701:]])
    texts = [" ".join(words) for words in texts]
    made, write = [], jaccard_join.materialise

    def counted(df, label):
        if label == "rest-pairs":
            df.collect()
            made.append(joined_rows(df._jdf.queryExecution().executedPlan()))
        return write(df, label)

    monkeypatch.setattr(jaccard_join, "materialise", counted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for _ in texts:
        for i, s in enumerate(sets):
            root[i] = min(root[j] for j, o in enumerate(sets) if 100 * len(s & o) >= 75 * len(s | o))
    assert got == dict(enumerate(root)) and len(set(root)) == 24
    pairs = len(texts) * (len(texts) - 1) // 2
    assert 0 < made[0] < 10 * pairs


def test_names_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 120), (120, 110)], "a bigint, b bigint")
    none = spark.createDataFrame([], "cls bigint, root bigint")
    some = jaccard_join.merged(none, links.filter("a % 2 = 0"))
    found = {r["cls"]: r["root"] for r in jaccard_join.merged(some, links).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 110: 100, 120: 100}


def test_groups_by_length():
    texts = [np.zeros(n, dtype="<u2") for n in (5, 900, 3, 7, 800, 2)]
    room = 2 * hmm_lm.PLACES_OF_A_TEXT
    groups = list(hmm_lm.grouped(sorted(texts, key=len), room))
    assert [[len(t) for t in g] for g in groups] == [[2, 3], [5, 7], [800], [900]]
    assert list(hmm_lm.grouped([], room)) == []


def similar_texts():
    rnd = np.random.RandomState(11)
    texts = []
    for i in range(90):  # families of ten, some of whose texts link
        words = [f"w{i // 10}.{k}" for k in range(120)]
        for at in rnd.choice(120, rnd.randint(1, 4), replace=False):
            words[at] = f"x{i}.{at}"
        texts.append(" ".join(words))
    return texts


def components(texts):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for _ in texts:
        for i, s in enumerate(sets):
            root[i] = min(root[j] for j, o in enumerate(sets) if s == o or 100 * len(s & o) >= 75 * len(s | o))
    return dict(enumerate(root))


def test_turns_share_out_the_index(spark):
    docs = spark.createDataFrame([(t,) for t in similar_texts()], "body string")
    common = np.zeros(jaccard_join.COUNTERS, dtype=np.int64)
    whole = jaccard_join._index(docs, common, 75, 5).collect()
    turns = [jaccard_join._index(docs, common, 75, 5, turn, 3).collect() for turn in range(3)]
    assert sorted(map(tuple, whole)) == sorted(tuple(r) for rows in turns for r in rows)
    assert max(map(len, turns)) < 0.4 * len(whole)
    assert not {r["h"] for r in turns[0]} & {r["h"] for r in turns[1] + turns[2]}


def test_pairs_are_compared_in_parts(spark, monkeypatch):
    calls, linked = [], jaccard_join._linked

    def counted(pairs, sets, similar):
        calls.append(pairs.count())
        return linked(pairs, sets, similar)

    monkeypatch.setattr(jaccard_join, "_linked", counted)
    texts = similar_texts()[:30]
    made = [s for sets in jaccard_join.sets_of(pa.array([t.encode() for t in texts])) for s in sets]
    sets = spark.createDataFrame([(i, len(s), s.tobytes()) for i, s in enumerate(made)], "cls bigint, n bigint, elements binary")
    pairs = spark.createDataFrame([(a, b) for a in range(30) for b in range(a) if a // 10 == b // 10], "a bigint, b bigint")
    none = spark.createDataFrame([], "cls bigint, root bigint")
    expected = {i: root for i, root in components(texts).items() if i != root}
    assert 3 < len(expected) < 27
    for room in (40 * 8 * 116, 10**9):
        assert dict(map(tuple, jaccard_join._compared(none, pairs, sets, 75, room).collect())) == expected
    *parts, at_once = calls
    assert len(parts) == 4 and max(parts) < 60 and sum(parts) < at_once == 135
    assert not jaccard_join._compared(none, pairs.limit(0), sets, 75, 1).count()


def test_only_what_is_read_later_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "shared_dir", lambda _: str(tmp_path))
    texts = similar_texts()
    linked = jaccard_join.link(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "creditloom").iterdir()) == ["members", "roots"]
    assert {r["doc_id"]: r["component_id"] for r in linked.collect()} == components(texts)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        if (name := files.next().getName()).startswith("shuffle_"):
            found.add(name)
    return found


def test_shuffle_files_go_with_the_write(spark):
    before, setting = shuffle_files(spark), spark.conf.get(runtime.SHUFFLE_CLEANUP, None)
    rows = spark.range(20_000).repartition(7, "id").groupBy((F.col("id") % 9).alias("k")).count()
    kept = rows.collect()  # a query that is not written keeps its files
    assert shuffle_files(spark) - before
    own = shuffle_files(spark)
    written = runtime.materialise(spark.range(20_000).repartition(5, "id").sortWithinPartitions("id"))
    for _ in range(50):
        if not (left := shuffle_files(spark) - own):
            break
        time.sleep(0.2)
    assert not left and written.count() == 20_000
    assert sorted(rows.collect()) == sorted(kept) and spark.conf.get(runtime.SHUFFLE_CLEANUP, None) == setting
