"""Periodic runs, the conversation trie and WARC packages against brute force, and on odd input."""

import base64
import gzip
import hashlib
import io
import random
import struct
import zipfile
import zlib
from collections import defaultdict

import pytest
from compare import differences, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import conversation_trie, periodic_runs, queries, warc_zip


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_conversation_trie", "op13_warc_zip"])
def test_query_against_sql(spark, small_sf, name):
    assert differences(queries.QUERIES[name](spark, small_sf), duck(small_sf), queries.ORACLES[name]) == ""


# ---------------------------------------------------------------- runs


def slow_runs(words, exponent, least):
    n, found = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            smallest = not any(all(part[k] == part[k + r] for k in range(len(part) - r)) for r in range(1, q))
            if j > i and len(part) >= max(least, exponent * q) and smallest:
                found.append((i, len(part), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=50), st.integers(0, 49), st.integers(1, 9), st.sampled_from([2, 3, 4]), st.sampled_from([0, 4, 6]))
def test_runs_against_brute_force(words, a, p, exponent, least):
    words = [words[a + (i - a) % p] if i >= a and a + p <= len(words) else word for i, word in enumerate(words)]
    assert periodic_runs.runs_of(words, exponent, least) == slow_runs(words, exponent, least)


def test_long_and_nested_runs():
    rng = random.Random(3)
    block = [rng.randrange(1000) for _ in range(700)]
    inner = block[:300] + [7] * 40 + block[340:]
    words = [2000 + i for i in range(50)] + inner * 5 + [5000]
    found = periodic_runs.runs_of(words)
    assert (50, 3500, 700) in found and (50 + 300, 40, 1) in found and len(found) == 6
    assert periodic_runs.runs_of([1] * 30_000) == [(0, 30_000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 200:  # has no fourth powers, but cubes
        a, b = b, b + a
    assert periodic_runs.runs_of(b) == [] and periodic_runs.runs_of(b, 3, 0) == slow_runs(b, 3, 0) != []


def test_tree_colours_against_plain_walk():
    rng = random.Random(5)
    for _ in range(40):
        parent = [0, 0] + [rng.randrange(1, k) for k in range(2, 60)]
        paths, colours = periodic_runs.ColouredPaths(parent), [-1] * 60
        for time in range(150):
            node = rng.randrange(1, 60)
            wanted, x = [], node
            while x:
                if not wanted or wanted[-1][1] != colours[x]:
                    wanted.append((x, colours[x]))
                colours[x], x = time, parent[x]
            met = paths.access(node, time)
            merged = [s for k, s in enumerate(met) if k == 0 or met[k - 1][1] != s[1]]
            assert merged == wanted


def test_runs_of_odd_texts(spark):
    rows = [(1, None, 1), (2, "", 2), (3, " \n\t ", 3), (4, "a a a a a a b", 4), (4, "a a a a a a b", 4), (None, "x y x y x y x y", 5), (6, " a " * 8, 6), (7, "w " * 60_000, 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find(df).collect()), key=str)
    assert got == sorted(
        [
            (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 6, 1)], "a b"), (4, [(0, 6, 1)], "a b"), (None, [(0, 8, 2)], "x y"),
            (6, [(0, 8, 1)], " a"), (7, [(0, 60_000, 1)], "w"),
        ],
        key=str,
    )
    assert periodic_runs.find(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find(df, exponent=1)


# ---------------------------------------------------------------- trie


def slow_trie(conversations):
    """Nodes by their sequence of turns, straight from the definition."""
    members = defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        leaves = sum(1 for m in below if not any(len(o) == len(m) + 1 and o[: len(m)] == m for o in below))
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(conversations[c]) == len(node)))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(1 for m in below if len(m) == len(node) + 1),
            leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "IDS_A_PIECE", 3)
    rng = random.Random(11)
    rows, wanted = [], {}
    for conv in rng.sample(range(-50, 4000), 160):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "héllo \U0001f642", "", None, "ok"])) for _ in range(rng.choice([1, 1, 2, 4, 7]))]
        rows += [(conv, None if k == 0 else k, role, text, "x") for k, (role, text) in enumerate(turns)]
        wanted[conv] = [(role or "", text or "") for role, text in turns]
    rows += [(None, 1, "user", "nobody", "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, digest string")
    sessions = conversation_trie.sessions(df)
    got = conversation_trie.build(sessions).select(NODE).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow_trie(wanted)
    # conversations may have no turns at all
    bare = spark.createDataFrame([(5, []), (3, [])], sessions.schema)
    wanted = {5: [], 3: []}
    assert sorted((tuple(r) for r in conversation_trie.build(bare).select(NODE).collect()), key=str) == slow_trie(wanted)


def test_trie_of_nothing(spark, small_sf):
    empty = conversation_trie.sessions(queries.table(spark, small_sf, "conversations").limit(0))
    assert conversation_trie.build(empty).collect() == []


def test_repeated_and_equal_turns_are_turns(spark):
    rows = [(1, 1, "user", "a"), (1, 1, "user", "a"), (1, 1, "user", "b"), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    nodes = conversation_trie.build(conversation_trie.sessions(df)).collect()
    assert sorted((r.depth, r.n_convs, r.n_leaves) for r in nodes) == [(d, 2, 1) for d in range(4)]
    long_text = "é" * 3_000_000
    one = spark.createDataFrame([(1, 1, "user", long_text), (2, 1, "user", long_text)], df.schema)
    assert {r.depth: r.saved_tokens for r in conversation_trie.build(conversation_trie.sessions(one)).collect()} == {0: 3_000_000, 1: 3_000_000}


# ---------------------------------------------------------------- WARC packages


def ranges(data):
    def read(offset, length):
        assert 0 <= offset and offset + length <= len(data)
        return data[offset : offset + length]

    return read


def packed(files, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, body in files:
            z.writestr(name, body)
        z.comment = comment
    return out.getvalue()


FILES = [("archive/data.warc.gz", b"0123456789" * 50), ("indexes/index.cdxj", b"{}\n"), ("déjà.txt", b"")]


@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05\x06" + bytes(18) + b" in it"])
@pytest.mark.parametrize("limit", [None, 100, 0])
def test_directories_with_and_without_zip64(monkeypatch, comment, limit):
    if limit is not None:  # makes the writer use ZIP64 records for small packages
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = packed(FILES, comment)
    assert (b"PK\x06\x06" in data) == (limit is not None)
    members = warc_zip.read_directory(ranges(data), len(data))
    assert [m.name for m in members] == [name for name, _ in FILES]
    for member, (_, body) in zip(members, FILES):
        at = warc_zip.locate(ranges(data), member)
        assert data[at : at + member.size] == body and member.crc == zlib.crc32(body)


def test_damaged_packages_raise():
    data = packed(FILES)
    with pytest.raises(ValueError, match="no end record"):
        warc_zip.read_directory(ranges(data[:-30]), len(data) - 30)
    start = struct.unpack_from("<I", data, len(data) - 6)[0]
    broken = data[:start] + b"XX" + data[start + 2 :]
    with pytest.raises(ValueError, match="central directory"):
        warc_zip.read_directory(ranges(broken), len(broken))
    squeezed = packed(FILES, method=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="not stored"):
        warc_zip.locate(ranges(squeezed), warc_zip.read_directory(ranges(squeezed), len(squeezed))[0])
    record = warc_zip.record_bytes(1, "http://a/", b"x", warc_zip.base32_sha1(b"y"), True, None)
    with pytest.raises(ValueError, match="digest"):
        warc_zip.parse_record(record)
    with pytest.raises(ValueError, match="length"):
        warc_zip.parse_record(record[:-1])


def slow_records(rows, least):
    """Types by the definition; rows alike in id and payload count as one that may answer once."""
    out = []
    payloads = [((html or "").encode(), page, url) for page, url, html in rows]
    rank = lambda row: (row[1] is not None, row[1] or 0, row[2] is not None, row[2] or "")
    answered = set()
    for body, page, url in payloads:
        best = max((p for p in payloads if p[0] == body), key=rank)
        if len(body) < least:
            kind, refers = "response", None
        elif rank((body, page, url)) == rank(best) and body not in answered:
            kind, refers = "response", None
            answered.add(body)
        else:
            kind, refers = "revisit", best[1]
        out.append((page, url, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), kind, refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_records_of_odd_pages(spark, least, tmp_path):
    long = "<p>" + "é" * 2_000_000
    rows = [
        (1, "http://a/", "same"), (9, "http://b/", "same"), (4, None, "same"), (2, "http://c/", None), (3, "http://d/", ""), (None, "http://e/", "own"),
        (None, "http://f/", "same"), (7, "http://g/", "twice"), (7, "http://g/", "twice"), (7, "http://h/", "twice"), (5, "http://i/", long), (6, "http://i/", long),
        (8, "http://j/", "WARC/1.1\r\n\r\nContent-Length: 3"),
    ]
    df = spark.createDataFrame([(*row, b"no") for row in rows], "page_id bigint, url string, html string, digest binary")
    manifest = warc_zip.write(df, least_shared=least, package_bytes=500, folder=str(tmp_path / "warc"))
    got = warc_zip.read(manifest, with_payload=True).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == slow_records(rows, least)
    texts = {(page, url): (html or "").encode() for page, url, html in rows}
    assert all(bytes(r.payload) == texts[r.page_id, r.url] if r.record_type == "response" else r.payload is None for r in got)
    # a stranger's tools can read the packages
    records = 0
    for row in manifest.collect():
        with zipfile.ZipFile(row.path) as z:
            assert z.testzip() is None and z.namelist() == [warc_zip.ARCHIVE, warc_zip.INDEX]
            whole = gzip.decompress(z.read(warc_zip.ARCHIVE))
            records += whole.count(b"WARC-Record-ID:")
    assert records == len(rows)


def test_many_ranges_and_no_pages(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "READ_BYTES", 400)
    pages = spark.range(300).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "repeat(cast(id % 50 AS string), 30) AS html").coalesce(2)
    manifest = warc_zip.write(pages)
    assert warc_zip.blocks(manifest).count() > 50
    got = warc_zip.read(manifest).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow_records([tuple(r) for r in pages.collect()], 0)
    assert sum(r.record_type == "response" for r in got) == 50 and all(r.refers_to == 250 + r.page_id % 50 for r in got if r.record_type == "revisit")
    empty = warc_zip.write(pages.limit(0))
    assert empty.count() == 0 and warc_zip.read(empty).collect() == []
