"""URL rules in a sorted digest array.

Rules (``host/path``) become 64-bit xxhash keys, sorted, beside their full strings. A task maps the keys from a file, forms
for every url the strings a fitting rule could have (each suffix of the host, with each rule length's prefix of the path),
finds all of them by one vectorised binary search per batch, and confirms full strings, so that a collision of keys decides
nothing. The longest confirmed rule wins; without one the verdict is the default. Rule lists are a parameter whose size
is checked; they travel to executors once, as bytes.

A null url, and one without ``://``, has an empty host and path, and no rule fits it. Rows are judged one by one.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from creditloom.llm.texts import LOWER, UPPER

#: Bytes of rules that may be sent to every executor.
MAX_RULE_BYTES = 256 << 20
SLICE = 4096
_LOWER = str.maketrans(UPPER, LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case, and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[end:]
    stop = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return rest[:end].translate(_LOWER), path[:stop]


def digest(rules: dict[str, str]) -> tuple[bytes, list[str], list[str]]:
    """Sorted keys as bytes, and the rules and verdicts in the keys' order."""
    for rule in rules:
        if "/" not in rule or rule.startswith("/"):
            raise ValueError(f"a rule needs a host, a slash and a path: {rule!r}")
    if sum(len(rule.encode()) + 16 for rule in rules) > MAX_RULE_BYTES:
        raise ValueError("the rules are larger than MAX_RULE_BYTES; split the list and judge in passes")
    rows = sorted((xxhash.xxh64_intdigest(rule.encode()), rule, verdict) for rule, verdict in rules.items())
    return np.array([key for key, _, _ in rows], dtype="<u8").tobytes(), [rule for _, rule, _ in rows], [verdict for _, _, verdict in rows]


class Probe:
    """The mapped keys of one task."""

    def __init__(self, keys: bytes, rules: list[str]) -> None:
        self.file = tempfile.TemporaryFile()  # has no name: gone with the task
        self.file.write(keys)
        self.file.flush()
        self.keys = np.memmap(self.file, dtype="<u8", mode="r") if keys else np.empty(0, dtype="<u8")
        self.rules = rules
        self.lengths = sorted({len(rule) - rule.index("/") for rule in rules})
        self.depths = {rule.partition("/")[0].count(".") + 1 for rule in rules}

    def candidates(self, host: str, path: str) -> list[str]:
        labels = host.split(".") if host else []
        found = []
        for depth in self.depths:
            if 0 < depth <= len(labels):
                suffix = ".".join(labels[len(labels) - depth :])
                found.extend(suffix + path[:n] for n in self.lengths if n <= len(path))
        return found

    def longest(self, urls: list[tuple[str, str]]) -> list[int]:
        """For each host and path the place of the longest fitting rule, or -1."""
        best = [-1] * len(urls)
        owners, texts = [], []
        for i, (host, path) in enumerate(urls):
            for text in self.candidates(host, path):
                owners.append(i)
                texts.append(text)
        if not texts or not len(self.keys):
            return best
        wanted = np.array([xxhash.xxh64_intdigest(text.encode()) for text in texts], dtype="<u8")
        places = np.searchsorted(self.keys, wanted)
        hits = np.flatnonzero((places < len(self.keys)) & (self.keys[np.minimum(places, len(self.keys) - 1)] == wanted))
        for hit in hits.tolist():
            place = int(places[hit])
            while place < len(self.keys) and self.keys[place] == wanted[hit]:  # equal keys of different rules stand side by side
                if self.rules[place] == texts[hit]:
                    owner = owners[hit]
                    if best[owner] < 0 or len(self.rules[best[owner]]) < len(texts[hit]):
                        best[owner] = place
                    break
                place += 1
        return best


def judge(df: DataFrame, rules: dict[str, str], url: str = "url", default: str = "allow") -> DataFrame:
    """``df``'s columns with host, path, rule and verdict; columns of those names give way to them."""
    packed = df.sparkSession.sparkContext.broadcast(digest(rules))
    names = ("host", "path", "rule", "verdict")
    kept = [c for c in df.columns if c.lower() not in names]
    added = T.StructType.fromDDL(", ".join(f"{n} string" for n in names))
    picked = df.select(*(f"`{c}`" for c in kept), df[f"`{url}`"].alias("_probed_url"))
    schema = T.StructType([*picked.schema.fields[:-1], *added.fields])
    arrow_added = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ordered, verdicts = packed.value
        probe = Probe(keys, ordered)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                urls = [split_url(u) for u in batch.column(batch.num_columns - 1).to_pylist()]
                best = probe.longest(urls)
                values = [
                    [host for host, _ in urls], [path for _, path in urls], [ordered[b] if b >= 0 else None for b in best],
                    [verdicts[b] if b >= 0 else default for b in best],
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *(pa.array(v, pa.string()) for v in values)],
                    schema=pa.schema([*list(batch.schema)[:-1], *arrow_added]),
                )

    return picked.mapInArrow(run, schema)
