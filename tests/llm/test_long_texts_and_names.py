"""Texts of very many words, benchmarks of very many windows, and documents whose other columns have the names that operators use."""

import random
import re
import string
import time

import pytest

from creditloom.llm import decontaminate, html_text, jaccard_join, quality_rules

TR = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BOUNDS = ["MAX_BROADCAST_WINDOWS", "MAX_BROADCAST_HASHES", "MAX_BROADCAST_DOCUMENTS"]


def words(text):
    return WORD.findall((text or "").translate(TR))


def brute_report(docs, items):
    """Words hit and items found, by looking at every window."""
    windows = {}
    for name, text in items:
        w = words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(name))
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        out[i] = (len(w), len(hit), sorted(found))
    return out


@pytest.fixture(scope="module")
def passages():
    rnd = random.Random(5)
    items = [(k, " ".join(rnd.choice("Ab cd EF gh ij".split()) + str(rnd.randrange(40)) for _ in range(n))) for k, n in enumerate([1, 3, 9, 10, 11, 25, 80, 200, 0])]
    docs = []
    for i in range(120):  # items at every offset in a block, across its end and at both ends of a text
        w = [f"x{rnd.randrange(500)}" for _ in range(rnd.choice([0, 1, 9, 63, 64, 65, 73, 130, 400]))]
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(w) + 1)
            w[at:at] = rnd.choice(items)[1].split()[rnd.choice([0, 0, 2]) :]
        docs.append((i, " ".join(w)))
    return docs, items


@pytest.mark.parametrize("bounds", [(500_000, 4_000_000, 1_000_000), (0, 4_000_000, 0), (0, 0, 0)])
def test_windows_over_blocks(spark, passages, monkeypatch, bounds):
    for name, bound in zip(BOUNDS, bounds):
        monkeypatch.setattr(decontaminate, name, bound)
    docs, items = passages
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = brute_report(docs, items)
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.report(table, bench).collect()} == want
    kept = {r.doc_id for r in decontaminate.drop_contaminated(table, bench).collect()}
    assert kept == {i for i, (_, n, _) in want.items() if n == 0} and 0 < len(kept) < len(docs)


def test_a_very_long_text_takes_time_in_proportion(spark, passages):
    """Windows once carried their whole text: 240,000 words took a minute."""
    _, items = passages
    bench = spark.createDataFrame(items[5:], "item_id int, text string")
    text = " ".join(f"x{i % 977}" for i in range(240_000)) + " " + items[6][1]

    def seconds(body):
        start = time.monotonic()
        row = decontaminate.report(spark.createDataFrame([(1, body)], "doc_id int, text string"), bench).first()
        assert row.n_hit == 80
        return time.monotonic() - start

    seconds(items[6][1])
    assert seconds(text) < seconds(items[6][1]) + 10


def test_texts_stay_where_they_are(spark, passages):
    docs, items = passages
    table = spark.createDataFrame(docs, "doc_id long, text string")
    kept = decontaminate.drop_contaminated(table, spark.createDataFrame(items, "item_id int, text string"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


CLASHING = "n_words int, kept string, clean_text int, _words int, _digest string, _row int, _text int, digest int, _whole int, cls int, _id int, component_id int, `a b` int"


@pytest.mark.parametrize("stage", ["clean", "keep_one", "drop_contaminated"])
def test_other_columns_come_through_untouched(spark, stage):
    prose = " ".join(f"Sentence number {i} tells of harbour {i * 7}." for i in range(30))
    rows = [(i, text, -7, "k", i, 1, "d", 2, 3, 4, 5, 6, 7, 8, 9) for i, text in enumerate([prose, "other " + prose.replace("harbour", "mountain ridge"), None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + CLASHING)
    items = spark.createDataFrame([(1, "words that no document holds")], "item_id int, text string")
    run = {"clean": quality_rules.clean, "keep_one": jaccard_join.keep_one, "drop_contaminated": lambda d: decontaminate.drop_contaminated(d, items)}[stage]
    got = run(docs)
    assert got.columns == docs.columns
    assert [tuple(r) for r in sorted(got.collect(), key=lambda r: r.doc_id)] == rows[: 2 if stage == "clean" else 3]
    assert run(docs.limit(0)).count() == 0


@pytest.mark.parametrize("page,want", [
    ("<body><p>Kept text.</p><!-- never closed <p>gone</p>", "Kept text."),
    ("<body><!--><p>Kept text.</p>", "Kept text."),
    ("<body><script>if (a) { x = '<!--'; }</script><p>Kept text.</p>", "Kept text."),
    ("<body><p>Kept</p><!-- one --><p>text.</p><!-- <!-- two --><p>Too.</p>", "Kept\ntext.\nToo."),
])
def test_comments(page, want):
    assert html_text.main_text(page) == want
