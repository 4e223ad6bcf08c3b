import hashlib
import random

import numpy as np
import regex
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lamella.llm import bpe

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("tokens", T.StringType())])


def texts():
    rnd = random.Random(5)
    out = [None, "", " ", "\n \t x", "don't we'll I'd", "<|endoftext|>a <|endoftext|>", "a" * 3000, "thequick" * 200, "\x1c\x85᠎  x", "é漢字\U0001f600 ab12"]
    letters = "abcetaoin  \n\t0129'.,!?<|>éß漢 　\U0001f600\x1d̀"
    return out + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 200))) for _ in range(200)]


def test_matches_the_library(spark):
    path = bpe.public_vocabulary()
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(5, "dup", None), (5, "dup", None), (None, "x", None)]
    library = Tokenizer.from_file(path)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = bpe.round_trip(spark.createDataFrame(rows, SCHEMA), path).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.round_trip(spark.createDataFrame([], SCHEMA), path).collect() == []


def test_every_code_point_splits_alike():
    path = bpe.public_vocabulary()
    library, own = Tokenizer.from_file(path), bpe.Vocabulary(open(path, encoding="utf-8").read())
    points = [c for c in [*range(0x3100), *range(0xA000, 0xD800, 7), *range(0xE000, 0x20000, 5)] if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 2000):
        some = [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in points[at : at + 2000]]
        for text, enc in zip(some, library.encode_batch(some, add_special_tokens=False), strict=True):
            assert np.frombuffer(own.encode(text), "<u4").tolist() == enc.ids, repr(text)


def test_words_break_alike_at_every_letter_and_digit():
    path = bpe.public_vocabulary()
    library, own = Tokenizer.from_file(path), bpe.Vocabulary(open(path, encoding="utf-8").read())
    wide = [(0x3400, 0x9F00), (0xAC00, 0xD700), (0x17000, 0x18C00), (0x20000, 0x2A000), (0x2B000, 0x2EB00), (0x30000, 0x31200)]
    known = regex.compile(r"[\p{L}\p{N}\s]")
    points = [c for c in range(0x34000) if not 0xD800 <= c < 0xE000 and (c % 13 == 0 or not any(a <= c < b for a, b in wide)) and known.match(chr(c))]
    newer = [ord(c) for c in regex.findall(f"[{bpe.NEWER}]", "".join(chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000))]
    points = sorted({*points, *newer})
    for at in range(0, len(points), 50):
        some = ["\n".join(f"{chr(c)}'s|a{chr(c)}'t|{chr(c)}1|1{chr(c)} {chr(c)}" for c in points[i : i + 5]) for i in range(at, at + 50, 5)]
        for text, enc in zip(some, library.encode_batch(some, add_special_tokens=False), strict=True):
            assert np.frombuffer(own.encode(text), "<u4").tolist() == enc.ids, text


def test_short_and_long_words_agree():
    own = bpe.Vocabulary(open(bpe.public_vocabulary(), encoding="utf-8").read())
    rnd = random.Random(1)
    for _ in range(300):
        word = bytes(rnd.choice(b"aetoinsh ") for _ in range(rnd.randrange(1, 60)))
        assert own._short(word) == own._long(word)
