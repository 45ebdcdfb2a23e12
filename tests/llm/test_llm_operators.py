"""Operators on texts: brute force, exact round trips, SQL, and the odd inputs that each must survive."""

import hashlib
import itertools
import re
import string
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from compare import differences, duck
from creditloom.llm import byte_bpe, decontaminate, hmm_lm, html_text, jaccard_join, license_scan, pii, quality_rules, queries, token_records, url_filter

TR = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (None, None), (1, None), (2, ""), (3, "one two"), (3, "one two"), (4, "word " * 3000), (5, "a" * 4000), (6, " \n\t "), (7, "é日本 x\n" * 40),
    (8, "mail a.b@c.de, call +1 (555) 010-9999, 10.0.0.1 4111 1111 1111 1111"), (9, "one two three four five six seven"), (10, "One Two three four five six seven"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 0, 1) for i, t in ODD], "doc_id bigint, text string, source string, n_words int, cls int")


@pytest.fixture(scope="module")
def empty(spark, odd):
    return odd.filter("false")


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, small_sf, name):
    assert not differences(entry_point.queries()[name](spark, small_sf), duck(small_sf), queries.ORACLES[name])


def test_pages(spark, small_sf):
    import html

    for r in queries.op1_html_extraction(spark, small_sf).join(spark.read.parquet(f"{small_sf}/pages.parquet"), "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<div>" * 3000 + "deep"), (4, "<p>a<div class=ad>x</div><p>b &lt;<ul><li>c<li>d</ul>")], "page_id int, html string")
    got = {r["page_id"]: r["text"] for r in rows(html_text.extract(pages, keep=("page_id",)))}
    assert got == {1: "", 2: "", 3: "deep", 4: "a\nb <\nc\nd"}


def test_bpe(spark, small_sf, odd):
    ranks = byte_bpe.load_ranks(queries.BYTE_RANKS)
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text")).withColumn("n_tokens", queries.F.lit("clash"))
    got = byte_bpe.encode(docs, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    wanted = Counter(np.array(model.encode_ordinary(r["text"] or ""), dtype="<u4").tobytes() for r in docs.collect())
    assert Counter(bytes(r["ids"]) for r in got.collect()) == wanted
    back = byte_bpe.decode(got, queries.BYTE_RANKS)
    assert Counter(bytes(r["decoded"]) for r in back.collect()) == Counter((r["text"] or "").encode() for r in docs.collect())


def brute_components(texts):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(TR))
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 5 else zip(*(w[k:] for k in range(5)))))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in lists[g]).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for g in s:
            lists[g].append(i)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def test_jaccard(spark, small_sf, odd, empty):
    found = spark.read.parquet(f"{small_sf}/documents.parquet").sort("doc_id").collect()
    rnd = np.random.RandomState(3)
    base = [f"w{i}" for i in range(200)]
    texts = [r["text"] for r in found] + [t for _, t in ODD]
    for _ in range(60):  # one group of near copies, and texts that share a passage
        w = list(base)
        for at in rnd.randint(0, 200, rnd.randint(0, 9)):
            w[at] = f"x{rnd.randint(1000)}"
        texts.append(" ".join(w))
        texts.append(" ".join([*base[:30], *(f"y{rnd.randint(10**6)}" for _ in range(rnd.randint(1, 60)))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(jaccard_join.link(docs))}
    assert got == dict(enumerate(brute_components(texts)))
    assert jaccard_join.link(odd).count() == len(ODD)
    assert jaccard_join.link(empty).count() == 0


def test_decontamination_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "ONE, two"), (2, None), (3, ""), (None, "mail a")], "item_id int, text string")
    got = rows(decontaminate.report(odd, items))
    assert len(got) == len(ODD)
    assert Counter(r["doc_id"] for r in got if r["contaminated"]) == Counter({3: 2, 8: 1, 9: 1, 10: 1})
    assert {tuple(r["items"]) for r in got if r["doc_id"] == 9} == {("1",)}
    assert decontaminate.report(empty, items).count() == 0
    assert decontaminate.report(odd, items.filter("false")).filter("contaminated").count() == 0
    assert decontaminate.drop_contaminated(odd, items).count() == len(ODD) - 5


def test_pii():
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def brute(t):
        out = [(m.start(), m.end(), "email") for m in email.finditer(t)]
        out += [(m.start(), m.end(), "ip") for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        out += [(m.start(), m.end(), "card") for m in card.finditer(t) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
        out += [(m.start(), m.end(), "phone") for m in phone.finditer(t) if 9 <= len(digits(m)) <= 15]
        return sorted(out, key=lambda s: (s[0], pii.BASE.index(s[2])))

    rnd, finder = np.random.RandomState(5), pii.Finder()
    for _ in range(8000):
        text = "".join(rnd.choice(list("ab1249.@+- ()é"), rnd.randint(0, 60)))
        assert [s for s in finder.spans(text) if s[2] in pii.BASE] == brute(text)
    assert pii.masked("x a@b.de y", finder.spans("x a@b.de y")) == "x <EMAIL> y"
    assert finder.spans(None) == []


def test_urls():
    probe = url_filter.Probe(*url_filter.digest(queries.URL_RULES)[:2])
    urls = {"http://a.EXAMPLE.net/en/1": "example.net/en/", "http://x.net/q": "net/", "http://x.net": None, "http://notexample.com/de/": None, None: None, "x": None}
    found = probe.longest([url_filter.split_url(u) for u in urls])
    assert [probe.rules[i] if i >= 0 else None for i in found] == list(urls.values())


def test_licenses():
    scanner = license_scan.Scanner()
    assert scanner.scan("a\nReleased under the MIT License.\nb") == [(2, 33, "MIT")]
    assert [n for _, _, n in scanner.scan("Licensed under CC BY-NC 4.0.")] == ["CC-BY-NC-4.0"]
    assert scanner.scan(None) == [] and scanner.scan("plain text") == []


def test_hmm_by_enumeration():
    rnd, k, c = np.random.RandomState(0), 3, 5
    start, move, emit = rnd.rand(k), rnd.rand(k, k), rnd.rand(k, c)
    start, move, emit = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)
    texts = [rnd.randint(0, c, n) for n in (4, 1, 5, 2)]
    sums = [np.zeros(k), np.zeros((k, k)), np.zeros((k, c))]
    for x, value in zip(texts, hmm_lm.forward(start, move, emit, texts)):
        paths = {}
        for q in itertools.product(range(k), repeat=len(x)):
            p = start[q[0]] * emit[q[0], x[0]]
            for t in range(1, len(x)):
                p *= move[q[t - 1], q[t]] * emit[q[t], x[t]]
            paths[q] = p
        total = sum(paths.values())
        assert np.isclose(np.log(total), value)
        for q, p in paths.items():
            sums[0][q[0]] += p / total
            for t in range(len(x)):
                sums[2][q[t], x[t]] += p / total
                if t:
                    sums[1][q[t - 1], q[t]] += p / total
    assert all(np.allclose(a, b) for a, b in zip(hmm_lm.expected(start, move, emit, texts), sums))


def test_scores(spark, small_sf, odd, empty):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in rows(queries.op9_hmm_scoring(spark, small_sf))}
    words = {r["doc_id"]: [*WORD.findall((r["text"] or "").translate(TR)), ""] for r in docs}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    counts = Counter(w for i, ws in words.items() if not out[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert np.isclose(r["base_score"], sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert hmm_lm.train_and_score(odd).count() == len(ODD)
    assert hmm_lm.train_and_score(empty).count() == 0


def test_records(spark, small_sf, odd, empty):
    docs = sorted(spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect())
    model, at, wanted = Tokenizer.from_file(queries.WORD_MODEL), 0, {}
    for r in docs:
        ids = [*model.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        wanted[r["doc_id"]] = (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    manifest = token_records.write(spark.read.parquet(f"{small_sf}/documents.parquet"), queries.WORD_MODEL)
    assert {r[0]: tuple(r[1:]) for r in token_records.read(manifest).collect()} == wanted
    shard = manifest.first()
    assert token_records.read_record(shard["path"], shard["n_records"] - 1) is not None
    assert token_records.read(token_records.write(odd, queries.WORD_MODEL)).count() == len(ODD)
    assert token_records.read(token_records.write(empty, queries.WORD_MODEL)).count() == 0


def test_encoding_by_word_is_encoding_of_the_text():
    model, by_word, rnd = Tokenizer.from_file(queries.WORD_MODEL), token_records.Encoder(queries.WORD_MODEL, True), np.random.RandomState(9)
    marks = ["a", "Σ", "ΑΣ", "é", "e", "\u0301", "\u0345", " ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2000", "\u200b", "İ", "'s", "'ll", "7", "日本", "한", "ᄒ", "ᅡ", "--", "<|endoftext|>", "\r\n", "👍🏽", "\x00"]
    texts = ["".join(rnd.choice(marks, rnd.randint(0, 30))) for _ in range(20_000)]
    texts += ["x" * 500 + " " + "y" * 500, "", " "]
    for at in range(0, len(texts), 64):
        group = texts[at : at + 64]
        assert [x.tolist() for x in by_word.encode(group)] == [model.encode(t, add_special_tokens=False).ids for t in group]


def test_damaged_record(tmp_path):
    data = bytearray(token_records.frame(b"payload"))
    data[14] ^= 1
    (tmp_path / "x").write_bytes(data)
    with open(tmp_path / "x", "rb") as f, pytest.raises(ValueError):
        token_records.read_frame(f)


def test_pipeline(spark, small_sf):
    """Every stage against what brute force makes of its input, up to the ids."""
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    kept = sorted((r["doc_id"], r["text"]) for r in quality_rules.clean(docs).collect())
    groups = brute_components([t for _, t in kept])
    kept = [x for i, x in enumerate(kept) if groups[i][1] == i]
    norm = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = set()
    for (text,) in spark.read.parquet(f"{small_sf}/benchmark.parquet").select("text").collect():
        w = norm.findall((text or "").translate(TR))
        n = min(len(w), 10)
        grams |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    sizes = {len(g) for g in grams}

    def clean(text):
        w = norm.findall(text.translate(TR))
        return not any(tuple(w[i : i + n]) in grams for n in sizes for i in range(len(w) - n + 1))

    finder, codec = pii.Finder(), byte_bpe.Codec(queries.BYTE_RANKS, public_tokenizers.PATTERN)
    wanted = {i: codec.encode(pii.masked(t, finder.spans(t))) for i, t in kept if clean(t)}
    assert {r["doc_id"]: bytes(r["ids"]) for r in corpus_pipeline.run(spark, small_sf).collect()} == wanted


def test_empty_texts_have_the_digest_of_nothing(odd):
    nothing = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in rows(pii.find(odd)) if r["doc_id"] in (None, 1, 2)} == {nothing}
