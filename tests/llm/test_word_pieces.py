"""Ids of pieces, shared by the words that hold them."""

import json

import numpy as np
from tokenizers import Tokenizer

from creditloom.llm import queries, token_records


def test_words_are_put_together_from_pieces():
    model, encoder = Tokenizer.from_file(queries.WORD_MODEL), token_records.Encoder(queries.WORD_MODEL, True)
    encoder.encode(["Äb, äb. ÄB! it's"])
    assert set(encoder.pieces) == {"äb", ",", ".", "!", "it", "'s"}
    encoder._learn = None  # new words of known pieces need the library no more
    (found,) = encoder.encode(["äB's it. It!"])
    assert found.tolist() == model.encode("äB's it. It!", add_special_tokens=False).ids
    assert token_records.kept_encoder(queries.WORD_MODEL, True) is token_records.kept_encoder(queries.WORD_MODEL, True)


def test_plain_words_have_the_ids_of_the_text():
    model, encoder, rnd = Tokenizer.from_file(queries.WORD_MODEL), token_records.Encoder(queries.WORD_MODEL, True), np.random.RandomState(4)
    marks = [*map(chr, range(0x20, 0x7F)), *map(chr, range(0xA0, 0x100)), "'S", "'ll", "<|endoftext|>", "x" * 70, "\x7f", "\x1f", "ı", "ſ"]
    texts = ["".join(rnd.choice(marks, rnd.randint(0, 30))) for _ in range(5_000)]
    assert [x.tolist() for x in encoder.encode(texts)] == [model.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(len(piece) <= token_records.KEPT_CHARS for piece in encoder.pieces)


def test_other_models_are_not_cut_into_pieces(tmp_path):
    steps = json.loads(Tokenizer.from_file(queries.WORD_MODEL).to_str())
    steps["normalizer"] = None
    (tmp_path / "model.json").write_text(json.dumps(steps))
    model, encoder = Tokenizer.from_file(str(tmp_path / "model.json")), token_records.Encoder(str(tmp_path / "model.json"), True)
    assert encoder.last is None
    assert [x.tolist() for x in encoder.encode(["Ab, ab It's"])] == [model.encode("Ab, ab It's", add_special_tokens=False).ids]
