"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut where a rolling hash of the last 16 bytes meets a mask, so equal passages give equal
chunks wherever they stand. A first pass counts the chunks of all documents by their 128-bit hash.
The chunks that save the most are encoded once, in a job of their own, and become a dictionary of
at most ``DICTIONARY_BYTES`` of text, which tasks receive. Other chunks are encoded where they
occur, and remembered within the task. The bound changes the work, never the ids.

Joins: at a cut, the ids on both sides need not be those of the whole text. The repair re-encodes
the text from the last safe place of the chunk before to the first safe place of the chunk after,
and widens, chunk by chunk, until both ends are safe. A safe place is a single blank between two
visible ASCII signs: the pre-tokeniser always ends a piece there, whatever stands around it.

Cases: a null text is empty: no ids. Texts without any safe place are encoded whole. Strings of
special tokens become their ids, as the tokenizers library does it. Repeated rows are encoded
each; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import small_batches

DICTIONARY_BYTES = 8 << 20
CHUNK_MASK = np.uint32((1 << 10) - 1)  # a cut every 1,024 bytes on average
MEMO_CHUNKS = 2_000

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
_SAFE = re.compile(rb"(?<=[\x21-\x7e]) (?=[\x21-\x7e])")
#: White space as the pattern below has it. Of a run, all but the last sign are one piece if
#: something visible follows, else all of it is; longer runs than this are cut so beforehand, for
#: the pattern matcher keeps a place for every sign and gives up on millions.
LONG_RUN = 4096
_RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_RUN},}}")
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in the vocabulary: visible Latin-1 signs stand for
    themselves, the others for the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coder:
    """Encoder and decoder of one tokenizer file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec["pre_tokenizer"], spec["model"]
        plain = pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        if model["type"] != "BPE" or spec["normalizer"] or not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        signs = byte_signs()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special
        }
        self.core = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.pieces = [b""] * (1 + max([*ranks.values(), *self.special.values()]))
        for token, i in [*ranks.items(), *((k.encode(), i) for k, i in self.special.items())]:
            self.pieces[i] = token
        self.names = [str(i) for i in range(len(self.pieces))]
        longest = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def plain(self, data: bytes) -> list[int]:
        """Ids of text that holds no special token."""
        text, at, out = data.decode("utf-8"), 0, []
        if len(data) < LONG_RUN:
            return self.core.encode_ordinary(text)
        for run in _RUN.finditer(text):
            last = run.end() if run.end() == len(text) else run.end() - 1
            if run.start() > at:
                out += self.core.encode_ordinary(text[at : run.start()])
            out += self.core._encode_single_piece(text[run.start() : last])
            at = last
        return out + self.core.encode_ordinary(text[at:])

    def decode(self, ids: list[int]) -> bytes:
        """The decoded text in UTF-8; bytes that are no UTF-8 become the replacement sign."""
        data = b"".join(map(self.pieces.__getitem__, ids))
        return data.decode("utf-8", "replace").encode("utf-8")


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def cuts(data: bytes) -> list[int]:
    """Places of the chunk ends of ``data``, at character starts; the last is its length."""
    n = len(data)
    if n <= 64:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    rolling = _GEAR[raw]
    for step in (1, 2, 4, 8):  # sums over 2, 4, 8, 16 bytes, older bytes shifted further
        rolling[step:] = rolling[step:] + (rolling[:-step] << np.uint32(step))
    found = np.flatnonzero((rolling[16:] >> np.uint32(8)) & CHUNK_MASK == 0) + 17
    out = []
    for at in found.tolist():
        while at < n and raw[at] & 0xC0 == 0x80:
            at += 1
        if at < n and (not out or at > out[-1]):
            out.append(at)
    out.append(n)
    return out


def segments(code: Coder, text: str):
    """(bytes, None) of ordinary text and (b"", id) of special tokens, in order."""
    if code.split is None:
        yield text.encode("utf-8"), None
        return
    for i, part in enumerate(code.split.split(text)):
        if i % 2:
            yield b"", code.special[part]
        elif part:
            yield part.encode("utf-8"), None


class Encoder:
    """Encodes texts chunk by chunk; ``known`` maps chunk hashes to the ids made once for all, as
    bytes of 32-bit numbers."""

    def __init__(self, code: Coder, known: dict[bytes, bytes] | None = None):
        self.code, self.known, self.memo = code, known or {}, {}

    def chunk(self, data: bytes) -> list[int]:
        key = xxhash.xxh3_128_digest(data)
        packed = self.known.get(key) or self.memo.get(key)
        if packed is not None:
            return np.frombuffer(packed, np.int32).tolist()
        ids = self.code.plain(data)
        if len(self.memo) >= MEMO_CHUNKS:
            self.memo.clear()
        self.memo[key] = np.array(ids, np.int32).tobytes()
        return ids

    def segment(self, data: bytes) -> list[int]:
        """Ids of a text without special tokens."""
        out: list[int] = []
        start = floor = 0  # ids up to ``floor``, a safe place, are final
        joint = None  # the first cut behind ``floor`` whose ids may be wrong
        for end in cuts(data):
            if start and _SAFE.match(data, start):
                if joint is not None:
                    self.repair(data, out, last_safe(data, floor, joint), start, start)
                    joint = None
                floor = start
            elif start and joint is None:
                joint = start
            ids = self.chunk(data[start:end])
            if joint is not None:
                right = _SAFE.search(data, start, min(end + 1, len(data)))
                if right is not None and right.start() < end:
                    stop = right.start()
                    self.repair(data, out, last_safe(data, floor, joint), start, stop)
                    ids = after(ids, stop - start, self.code.pieces)
                    floor, joint = stop, None
            out += ids
            start = end
        if joint is not None:
            self.repair(data, out, last_safe(data, floor, joint), len(data), len(data))
        return out

    def repair(self, data: bytes, out: list[int], left: int, done: int, stop: int) -> None:
        """Replace the ids of data[left:done] at the end of ``out`` by those of data[left:stop]."""
        drop, pieces = done - left, self.code.pieces
        while drop > 0:
            drop -= len(pieces[out.pop()])
        if drop:
            raise AssertionError("a safe place is inside a token")
        out += self.code.plain(data[left:stop])

    def text(self, text: str | None) -> list[int]:
        out: list[int] = []
        for data, special in segments(self.code, text or ""):
            if special is None:
                out += self.segment(data)
            else:
                out.append(special)
        return out


def last_safe(data: bytes, floor: int, end: int) -> int:
    """The last safe place in (floor, end), or ``floor``."""
    at = end
    while (at := data.rfind(b" ", floor + 1, at)) > floor:
        if _SAFE.match(data, at):
            return at
    return floor


def after(ids: list[int], skip: int, pieces: list[bytes]) -> list[int]:
    """``ids`` without the first ``skip`` bytes."""
    at = 0
    while skip > 0:
        skip -= len(pieces[ids[at]])
        at += 1
    if skip:
        raise AssertionError("a safe place is inside a token")
    return ids[at:]


def dictionary(docs: DataFrame, path: str, most_bytes: int = DICTIONARY_BYTES) -> dict[bytes, bytes]:
    """Ids (32-bit numbers as bytes) of the shared chunks that save the most work, each encoded once; bounded in size."""

    def counted(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                keys, sizes, owners = [], [], []
                texts = batch.column(1).slice(at, 500).to_pylist()
                for owner, text in zip(batch.column(0).slice(at, 500).to_pylist(), texts):
                    data, start = (text or "").encode("utf-8"), 0
                    for end in cuts(data):
                        keys.append(xxhash.xxh3_128_digest(data[start:end]))
                        sizes.append(end - start)
                        owners.append(owner)
                        start = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(owners, pa.int64())],
                    ["key", "size", "owner"],
                )

    small_batches(docs.sparkSession)
    texts = docs.select(F.xxhash64("text").alias("owner"), "text")
    chunks = texts.mapInArrow(counted, "key binary, size int, owner long")
    shared = chunks.groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("size"), F.min("owner").alias("owner"))
    # At most this many rows reach the driver, whatever the tables hold: a chunk has 32 bytes or more.
    best = shared.where("n > 1 and size >= 32").orderBy(F.desc(F.expr("(n - 1) * size")), "key").limit(most_bytes // 256)
    wanted: dict[bytes, int] = {}
    room = most_bytes
    for row in best.collect():
        if row["size"] > room:
            break
        room -= row["size"]
        wanted[bytes(row["key"])] = row["owner"]
    if not wanted:
        return {}
    owners = set(wanted.values())
    spark = docs.sparkSession
    listed = spark.createDataFrame([(x,) for x in sorted(owners)], "owner long")

    def encoded(batches):
        code, done = coder(path), set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                data, start = (text or "").encode("utf-8"), 0
                keys, ids = [], []
                for end in cuts(data):
                    key = xxhash.xxh3_128_digest(data[start:end])
                    if key in wanted and key not in done and not (code.split and code.split.search(data[start:end].decode())):
                        done.add(key)
                        keys.append(key)
                        ids.append(np.array(code.plain(data[start:end]), np.int32).tobytes())
                    start = end
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.binary())], ["key", "ids"])

    # The list has at most most_bytes / 256 rows, so it may be broadcast.
    owned = texts.join(F.broadcast(listed), "owner", "left_semi").select("text").dropDuplicates()
    rows = owned.mapInArrow(encoded, "key binary, ids binary")
    rows = rows.groupBy("key").agg(F.first("ids").alias("ids"))
    return {bytes(r["key"]): bytes(r["ids"]) for r in rows.collect()}


def _run(docs: DataFrame, path: str, known, columns, schema: str) -> DataFrame:
    """Rows of doc_id and what ``columns`` makes of (coder, ids)."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        encoder = Encoder(coder(path), shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 200):
                made = [columns(encoder.code, encoder.text(x)) for x in texts.slice(at, 200).to_pylist()]
                if made:
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": i, **row} for i, row in zip(ids.slice(at, 200).to_pylist(), made)],
                        schema=_SCHEMAS[schema],
                    )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


_IDS = "doc_id long, ids array<int>, decoded string"
_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_SCHEMAS = {
    _IDS: pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]),
    _DIGESTS: pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
}


def _ids_columns(code: Coder, ids: list[int]) -> dict:
    return {"ids": ids, "decoded": code.decode(ids).decode("utf-8")}


def _digest_columns(code: Coder, ids: list[int]) -> dict:
    return {
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(",".join(map(code.names.__getitem__, ids)).encode()).hexdigest(),
        "decoded_sha256": hashlib.sha256(code.decode(ids)).hexdigest(),
    }


def encode(docs: DataFrame, path: str, most_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """doc_id, ids and the text decoded from them, for every row."""
    return _run(docs, path, dictionary(docs, path, most_bytes), _ids_columns, _IDS)


def digests(docs: DataFrame, path: str, most_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text, for every row."""
    return _run(docs, path, dictionary(docs, path, most_bytes), _digest_columns, _DIGESTS)
