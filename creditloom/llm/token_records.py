"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A shard is a row of records: the payload's length (8 bytes, little endian), the masked checksum of those bytes (4), the payload
(the document's id, then unsigned ids of 16 bits if all fit, else 32), the masked checksum of the payload (4). The checksum is CRC-32, rotated by 15 bits and moved by a
constant, so that checksums of data that hold checksums stay sound. Beside each shard ``.index`` lists the offset of every
record (8 bytes each). Documents are sorted by id over all shards; a manifest table holds one row per finished shard with
its ids, so shards that lost attempts left behind are never read. A failed checksum raises.

Null ids come first; equal ids are ordered by their texts; a null or empty text is a record of the end id alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.llm.tasks import map_rows
from creditloom.runtime import materialise, scratch_path

MASK_DELTA = 0xA282EAD8
END_ID = 1
ENCODED_AT_ONCE = 64
#: Distinct words, and pieces of them, that a worker keeps with their ids, 100 MB or so each, and the longest that it keeps.
KEPT_WORDS = 500_000
KEPT_CHARS = 64
#: New words that are encoded as one text.
LEARNED_AT_ONCE = 1024
#: Words of visible ASCII and Latin-1 letters: they are in normal form, and their lower case and classes are the same for every library.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: What the pre-tokenizer below finds in plain words of lower case.
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: The steps before the merges of models whose plain words ``PIECE`` cuts.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def read_frame(stream) -> bytes | None:
    """The next payload; None at the end of the file."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked_crc(head[:8]):
        raise ValueError("a record's length is damaged")
    size = struct.unpack("<Q", head[:8])[0]
    body = stream.read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked_crc(body[:size]):
        raise ValueError("a record's payload is damaged")
    return body[:size]


def _payload(key: int | None, ids: np.ndarray) -> bytes:
    width = 2 if int(ids.max()) < 1 << 16 else 4
    return struct.pack("<?qB", key is not None, key or 0, width) + ids.astype(f"<u{width}").tobytes()


def sequence(payload: bytes) -> tuple[int | None, np.ndarray]:
    """A record's document id, and its token ids as unsigned 32-bit integers."""
    has, key, width = struct.unpack_from("<?qB", payload)
    return key if has else None, np.frombuffer(payload, dtype=f"<u{width}", offset=10).astype("<u4")


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if not uri.startswith("file:") else uri.replace("file:", "file://", 1))


def read_record(uri: str, number: int) -> bytes:
    """One record of a shard by its place in the offset index."""
    files, path = _place(uri)
    with files.open_input_file(f"{path}.index") as index:
        index.seek(8 * number)
        offset = struct.unpack("<Q", index.read(8))[0]
    with files.open_input_file(path) as shard:
        shard.seek(offset)
        return read_frame(shard)


class Encoder:
    """Whole texts to ids with a tokenizer of the library; lives in a worker process, which keeps it for its next task.

    With ``by_word`` the library encodes every distinct word once and its ids are kept, bounded in words and characters. That
    gives the ids of the whole text only for a tokenizer whose pieces never hold or depend on a blank. Many distinct words are
    made of the same pieces, by case and marks around them; where the tokenizer's own steps say what a plain word's pieces are,
    the library encodes distinct pieces, and words are put together from their ids.
    """

    def __init__(self, path: str, by_word: bool) -> None:
        from tokenizers import Tokenizer

        self.model, self.by_word = Tokenizer.from_file(path), by_word
        self.known: dict[bytes, bytes] = {}  # words in UTF-8 and their ids of 32 bits
        self.pieces: dict[str, bytes] = {}
        self.last = self._last_ids() if by_word else None

    def _last_ids(self) -> np.ndarray | None:
        """By id, whether a token ends a piece; None unless plain words fall into the pieces of ``PIECE`` and each ends in such a token."""
        steps = json.loads(self.model.to_str())
        suffix = steps["model"].get("end_of_word_suffix")
        rest = (steps["normalizer"], steps["pre_tokenizer"], steps["post_processor"], steps["truncation"], steps["padding"], steps["model"].get("dropout"))
        if not suffix or rest != (NORMALIZER, PRE_TOKENIZER, None, None, None, None):
            return None
        vocab = self.model.get_vocab()
        last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        last[[at for token, at in vocab.items() if token.endswith(suffix)]] = True
        self.added = [token.content for token in self.model.get_added_tokens_decoder().values()]
        return last

    def _learn(self, words: list[bytes]) -> None:
        """Encodes words as one text of lines and cuts its ids at the lines' starts."""
        lines = [word.decode("utf-8") for word in words]
        found = self.model.encode("\n".join(lines), add_special_tokens=False)
        ids, starts = np.array(found.ids, dtype="<u4").tobytes(), np.array([start for start, _ in found.offsets], dtype=np.int64)
        ends = np.cumsum([0, *(len(line) + 1 for line in lines)])
        cuts = (np.searchsorted(starts, ends) * 4).tolist()
        self.known.update((word, ids[at:end]) for word, at, end in zip(words, cuts, cuts[1:]))

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Encodes pieces as one text and cuts its ids behind the tokens that end one."""
        (found,) = self.model.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        cuts = [0, *((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()]
        if len(cuts) != len(pieces) + 1 or cuts[-1] != 4 * len(ids):
            raise ValueError("the tokenizer cuts a plain word in other places")
        packed = ids.tobytes()
        self.pieces.update((piece, packed[at:end]) for piece, at, end in zip(pieces, cuts, cuts[1:]))

    def _learn_plain(self, words: list[bytes]) -> list[bytes]:
        """Learns the plain words and returns the others."""
        if len(self.pieces) >= KEPT_WORDS:
            self.pieces.clear()
        plain, cut, others = [], [], []
        joined = b" ".join(words).decode("utf-8")  # words hold no blank
        marked = any(token in joined for token in self.added)
        for word, line, low in zip(words, joined.split(" "), joined.lower().split(" ")):
            if PLAIN.fullmatch(line) and not (marked and any(token in line for token in self.added)):
                plain.append(word)
                cut.append((low,) if low.isalpha() else PIECE.findall(low))
            else:
                others.append(word)
        new = list(set(chain.from_iterable(cut)).difference(self.pieces))
        for at in range(0, len(new), LEARNED_AT_ONCE):
            self._learn_pieces(new[at : at + LEARNED_AT_ONCE])
        self.known.update((word, b"".join(map(self.pieces.__getitem__, parts))) for word, parts in zip(plain, cut))
        for piece in new:
            if len(piece) > KEPT_CHARS:
                del self.pieces[piece]
        return others

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(found.ids, dtype="<u4") for found in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        worded = [text.encode("utf-8").split() for text in texts]  # bytes split at ASCII blanks alone
        new = list(set(chain.from_iterable(worded)).difference(self.known))
        rest = new if self.last is None else self._learn_plain(new)
        for at in range(0, len(rest), LEARNED_AT_ONCE):
            self._learn(rest[at : at + LEARNED_AT_ONCE])
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype="<u4") for words in worded]
        for word in new:
            if len(word) > KEPT_CHARS:
                del self.known[word]
        return ids


@lru_cache(maxsize=1)
def kept_encoder(path: str, by_word: bool) -> Encoder:
    """The encoder of this process: a worker's tasks use one after the other, so the tokenizer and the words' ids are read once."""
    return Encoder(path, by_word)


def write(
    df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", folder: str | None = None, by_word: bool = False
) -> DataFrame:
    """Write shards below ``folder`` in the order of ids; returns the manifest: part, path, n_records, n_ids.

    ``by_word`` says that the tokenizer's pieces never hold or depend on a blank, so that repeated words are encoded once.
    """
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "token-records")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        df.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
        .withColumn("tie", F.xxhash64("body")).repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie").drop("tie")
    )

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part = TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:05d}-{uuid.uuid4().hex}.records"
        files, path = _place(uri)
        model, total, offset, count = kept_encoder(tokenizer, by_word), 0, 0, 0
        first = next(rows, None)
        if first is None:
            return
        files.create_dir(os.path.dirname(path), recursive=True)

        def groups() -> Iterator[list[tuple]]:
            group = [first]
            for row in rows:
                if len(group) == ENCODED_AT_ONCE:
                    yield group
                    group = []
                group.append(row)
            yield group

        with files.open_output_stream(path) as out, files.open_output_stream(f"{path}.index") as index:
            for group in groups():
                for (key, _), ids in zip(group, model.encode([body for _, body in group])):
                    ids = np.append(ids, np.uint32(END_ID))
                    record = frame(_payload(key, ids))
                    out.write(record)
                    index.write(struct.pack("<Q", offset))
                    offset, total, count = offset + len(record), total + len(ids), count + 1
        yield part, uri, count, total

    return materialise(map_rows(ordered, "part int, path string, n_records bigint, n_ids bigint", work), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Every record of the manifest's shards: doc_id, start (ids of all records before it), n_tokens, ids_crc32.

    The running total over shards is taken over one row per shard.
    """
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.select("path", before.alias("base"))

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for uri, base in rows:
            files, path = _place(uri)
            at = base
            with files.open_input_stream(path) as shard:
                while (payload := read_frame(shard)) is not None:
                    key, ids = sequence(payload)
                    yield key, at, len(ids), zlib.crc32(ids.tobytes())
                    at += len(ids)

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_rows(shards.repartition(spread, "path"), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", work)
