"""Byte-level BPE encoding and decoding with a contiguous rank array.

A short word is held as its part boundaries and the ranks of adjacent parts; the
smallest rank is found by a scan, its boundary deleted and the two neighbouring
ranks refreshed. Scans are quadratic, so words beyond ``LONG_WORD`` bytes keep the
same ranks in a heap over linked parts, with the same result.

The vocabulary file is read on the driver and broadcast: its size is checked
against ``MAX_VOCABULARY_BYTES``, and it doesn't grow with the corpus.

Defined results: a null text is encoded as the empty text (no tokens, decoded to
the empty text); the text of a special token is that token, as the library does by
default; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm.common import table

#: Fixed value: the published word pattern of byte-level vocabularies of this kind.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Code points, in hexadecimal, that the regex module counts as letters or digits since versions of
#: Unicode after 16.0, whose tables the tokenizers library has. A test goes through all letters and digits.
NEWER_POINTS = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8
16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128
1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED
1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
NEWER = "".join("-".join(f"\\U{int(c, 16):08x}" for c in r.split("-")) for r in NEWER_POINTS.split())
#: Texts with such a character are rare and are split by a pattern that takes it as neither letter nor digit.
OLDER_WORDS = WORDS.replace(r"\p{L}+", rf"(?:(?![{NEWER}])\p{{L}})+").replace(r"\p{N}+", rf"(?:(?![{NEWER}])\p{{N}})+").replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{NEWER}])+")

MAX_VOCABULARY_BYTES = 64 << 20
LONG_WORD = 256
#: Words whose tokens a worker remembers, twice: when the newer memory is full it becomes the older
#: one, so that frequent words stay; results don't depend on it.
REMEMBERED = 100_000
#: Longest word, in characters, that is remembered.
REMEMBERED_CHARS = 40

#: Words looked up in the same memory; it may be replaced between.
FOUND = 1 << 12
#: Ids decoded at once; bounds a task's memory.
DECODED = 1 << 16

NONE = 1 << 62


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte: printable Latin-1 stays, the rest moves to 256 and up."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """Ranks of mergeable pairs, ids of parts, and bytes of ids."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, back = spec["model"], byte_symbols()
        raw = lambda symbols: bytes(back[c] for c in symbols)
        ids = {raw(k): v for k, v in model["vocab"].items() if all(c in back for c in k)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = [(raw(a), raw(b)) for a, b in pairs]
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [ids[a + b] for a, b in pairs]
        self.of_byte = [ids.get(bytes([b])) for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        of_id = {v: k for k, v in ids.items()} | {v: k.encode() for k, v in self.special.items()}
        parts = [of_id.get(i, b"") for i in range(max(of_id, default=-1) + 1)]
        self.table = np.frombuffer(b"".join(parts), np.uint8)
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.words, self.older_words = regex.compile(WORDS), regex.compile(OLDER_WORDS)
        self.newer = regex.compile(f"[{NEWER}]")
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _short(self, word: bytes) -> list[int]:
        # parts[i] is the token that begins at boundary i; taking it out deletes the boundary.
        get, merged = self.ranks.get, self.merged
        parts = list(map(self.of_byte.__getitem__, word))
        adjacent = [get(a << 32 | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while adjacent and (least := min(adjacent)) != NONE:
            i = adjacent.index(least)
            new = merged[least]
            parts[i] = new
            del parts[i + 1], adjacent[i]
            if i:
                adjacent[i - 1] = get(parts[i - 1] << 32 | new, NONE)
            if i < len(adjacent):
                adjacent[i] = get(new << 32 | parts[i + 1], NONE)
        return parts

    def _long(self, word: bytes) -> list[int]:
        n = len(word)
        part: list[int | None] = list(map(self.of_byte.__getitem__, word))
        after, before = list(range(1, n + 1)), list(range(-1, n))
        rank = lambda i: self.ranks.get(part[i] << 32 | part[after[i]], NONE) if after[i] < n else NONE
        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if part[i] is None or rank(i) != r:
                continue  # one of the parts has grown since
            j = after[i]
            part[i], part[j], after[i] = self.merged[r], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) != NONE:
                    heapq.heappush(heap, (r, k))
        return [p for p in part if p is not None]

    def _pack(self, word: str) -> bytes:
        if (got := self.older.get(word)) is None:
            raw = word.encode()
            got = array("I", self._short(raw) if len(raw) <= LONG_WORD else self._long(raw)).tobytes()
        if len(word) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        pack = self._pack
        sections = self.split.split(text) if self.split else [text]
        out = []
        for k, section in enumerate(sections):
            if k % 2:
                out.append(array("I", [self.special[section]]).tobytes())
                continue
            newer = not section.isascii() and self.newer.search(section)
            words = (self.older_words if newer else self.words).findall(section)
            for at in range(0, len(words), FOUND):
                known = self.known.get
                out += [known(w) or pack(w) for w in words[at : at + FOUND]]
        packed = b"".join(out)
        return packed if sys.byteorder == "little" else np.frombuffer(packed, "=u4").astype("<u4").tobytes()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, gathered from one table of all tokens' bytes."""
        starts, lengths = self.starts[ids], self.lengths[ids]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
        return self.table[place].tobytes()

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        return b"".join(self.decode_bytes(ids[k : k + DECODED]) for k in range(0, len(ids), DECODED)).decode("utf-8", "replace")


def _sent(spark: SparkSession, path: str):
    """A broadcast of the vocabulary, built once on the driver from a file of checked size."""
    with open(path, encoding="utf-8") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is larger than the bound for broadcasting")
    return spark.sparkContext.broadcast(Vocabulary(content))


def _mapped(df: DataFrame, column: str, out: str, kind: T.DataType, arrow: pa.DataType, make) -> DataFrame:
    """Replace ``column`` by ``out``, made value by value inside Arrow batches."""
    others = [c for c in df.columns if c != column]
    schema = T.StructType([*[df.schema[c] for c in others], T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([make(x.as_py()) for x in batch.column(column)], arrow)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], values], [*others, out])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens): the ids of each text, packed as little-endian unsigned 32-bit integers."""
    sent = _sent(docs.sparkSession, vocabulary_path)
    df = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return _mapped(df, "_text", "tokens", T.BinaryType(), pa.binary(), lambda text: sent.value.encode(text or ""))


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """Add ``decoded``, the text of packed ``tokens``."""
    sent = _sent(encoded.sparkSession, vocabulary_path)
    df = encoded.withColumn("_packed", F.col("tokens"))
    return _mapped(df, "_packed", "decoded", T.StringType(), pa.string(), lambda packed: sent.value.decode(packed or b""))


def round_trip(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", keep_tokens: bool = False) -> DataFrame:
    """Digests of the ids and of the text decoded from them, with the packed tokens if asked for.

    Both ways are gone in one pass, so that neither tokens nor decoded texts leave the task unless asked for.
    """
    sent = _sent(docs.sparkSession, vocabulary_path)
    df = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType([df.schema[0], *[T.StructField("tokens", T.BinaryType())] * keep_tokens, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, digest = sent.value, lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            packed, decoded = [], []
            for text in batch.column(1):
                packed.append(vocabulary.encode(text.as_py() or ""))
                decoded.append(digest(vocabulary.decode(packed[-1]).encode()))
            arrays = [pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(map(digest, packed), pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(packed, pa.binary())] * keep_tokens, *arrays], schema.names)

    return df.mapInArrow(run, schema)


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_vocabulary())


QUERIES = {"op7_bpe": op7_bpe}
SQL: dict[str, str] = {}
