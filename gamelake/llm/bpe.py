"""Byte-level BPE encoding and decoding with content-defined chunk reuse (operator 8).

Every whole text is cut into chunks where a rolling hash of the sixteen bytes before a place says so.
Chunks that occur more than once in the corpus are encoded once, and their ids are joined back by
digest; documents without such a chunk are encoded where they are read. Around each cut between
chunks the text is then encoded again, ever further out, until the ids on both sides end at a word
start: there they agree with the ids of the whole text, since a word start (a blank between two
letters) splits alike whatever stands around it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.common import bounded_batches, materialise

#: The pattern that splits texts before byte-level merges, and the special token of the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space (as the pattern's \\s) that are taken out before the pattern.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
LEAST, MASK = 256, 0xFF
#: Digests of shared chunks that a task remembers, so as to write their bytes once.
REMEMBER = 500_000
#: Bits (as a power of two) of the filter of shared chunks: 16 MB that are sent to each executor, whatever
#: the input. Wrong hits only send a document the longer way; beyond some 10^8 shared chunks most take it.
FILTER_BITS = 27


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Encodes texts as the tokenizers library does with the same file, special tokens in texts included."""

    def __init__(self, content: str):
        import tiktoken

        spec = json.loads(content)
        of = byte_alphabet()
        ranks = {bytes(of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in of for c in token)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t in self.special:
            ranks.pop(t.encode(), None)
        #: Text and special tokens in turn; of those that start at one place the longest.
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.bytes_of = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        #: How ids are packed between stages: two bytes each if the vocabulary allows it.
        self.packed = "<u2" if max(self.bytes_of) < 1 << 16 else "<u4"
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if not any(t in text for t in self.special):
            return self._ordinary(text)
        out: list[int] = []
        for k, part in enumerate(self.split_special(text)):
            out += [self.special[part]] if k % 2 else self._ordinary(part)
        return out

    def _ordinary(self, text: str) -> list[int]:
        """A long run of white space is one stretch up to its last character (up to its end, if the text
        ends there), as the pattern says; it goes to the merges without the pattern, whose matcher would
        go one level deeper for each of its characters."""
        out: list[int] = []
        at = 0
        for run in LONG_BLANK.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += self.encoding.encode_ordinary(text[at : run.start()])
            out += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(content: str) -> Codec:
    return Codec(content)


def chunk_cuts(body: bytes) -> list[int]:
    """Ends of the content-defined chunks of a text, between characters and at least LEAST bytes apart.
    Each place is judged by the sixteen bytes before it, so equal passages are cut alike wherever they
    stand, but for the first cuts."""
    if len(body) <= LEAST:
        return [len(body)] if body else []
    b = np.frombuffer(body, np.uint8)
    h = b.astype(np.uint32)
    for width in (1, 2, 4, 8):
        h[width:] = h[width:] + h[:-width] * np.uint32(pow(0x01000193, width, 1 << 32))
    chosen = np.flatnonzero(((h[15:-1] * np.uint32(0x85EBCA6B)) >> np.uint32(16)) & np.uint32(MASK) == 0) + 16
    cuts, last = [], 0
    for c in chosen[(b[chosen] & 0xC0) != 0x80].tolist():
        if c - last >= LEAST:
            cuts.append(c)
            last = c
    return [*cuts, len(body)]


def is_word_start(body: bytes, at: int) -> bool:
    return 0 < at < len(body) - 1 and body[at] == 32 and body[at - 1 : at].isalpha() and body[at + 1 : at + 2].isalpha()


def word_start_before(body: bytes, at: int) -> int:
    """The last word start before a place; 0 if there is none."""
    at = body.rfind(b" ", 0, at)
    while at > 0 and not is_word_start(body, at):
        at = body.rfind(b" ", 0, at)
    return max(at, 0)


def word_start_after(body: bytes, at: int) -> int:
    """The first word start after a place; the text's end if there is none."""
    at = body.find(b" ", at + 1)
    while at >= 0 and not is_word_start(body, at):
        at = body.find(b" ", at + 1)
    return at if at >= 0 else len(body)


def join_chunks(c: Codec, body: bytes, cuts: list[int], parts: list) -> list[int]:
    """Ids of the whole text from those of its chunks, which end at cuts. Each stretch that is encoded
    again runs between two word starts (or ends of the text) that are also ends of ids on their side;
    it may hold several short chunks, so that the work stays in proportion to the text."""
    size = c.bytes_of
    out, k = list(parts[0]), 0
    while k < len(cuts) - 1:
        if is_word_start(body, cuts[k]):
            k += 1
            out += parts[k]
            continue
        a, left = cuts[k], word_start_before(body, cuts[k])
        while a > left:
            a -= len(size[out.pop()])
            if a < left:  # the ids on the left have no end there: further out
                left = word_start_before(body, left)
        k += 1
        z, right, j = cuts[k - 1], word_start_after(body, cuts[k - 1]), 0
        while z < right:
            if j == len(parts[k]):
                if z == len(body):
                    break
                k, j = k + 1, 0
                continue
            z += len(size[parts[k][j]])
            j += 1
            if z > right:
                right = word_start_after(body, right)
        out += c.encode(body[a:z].decode("utf-8"))
        out += parts[k][j:]
    return out


def _ids(lists: list) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate([np.empty(0, np.int32), *lists])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _spots(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two filter bits of each digest (rows of 16 bytes)."""
    two = digests.view("<u8").reshape(-1, 2)
    return tuple((two[:, k] >> np.uint64(64 - FILTER_BITS)).astype(np.int64) for k in (0, 1))


def _digests(body: bytes, cuts: list[int]) -> list[bytes]:
    return [hashlib.md5(body[x:y]).digest() for x, y in zip([0, *cuts], cuts)]


def _shared_filter(docs: DataFrame) -> bytes:
    """A bitmap that holds the spots of every chunk that occurs more than once."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [d for t in batch.column("text").to_pylist() if t for b in (t.encode("utf-8", "surrogatepass"),) for d in _digests(b, chunk_cuts(b))]
            yield pa.RecordBatch.from_pydict({"digest": pa.array(found, pa.binary())})

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8)
            at = np.concatenate(_spots(d))
            yield pa.RecordBatch.from_arrays([pa.array((at >> 16).astype(np.int32)), pa.array((at & 0xFFFF).astype(np.int32))], ["word", "bit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for bits in batch.column("bits").to_pylist():
                one = np.zeros(1 << 16, np.uint8)
                one[bits] = 1
                maps.append(np.packbits(one, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(maps, pa.binary())], ["word", "map"])

    shared = docs.select("text").mapInArrow(digest, "digest binary").groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1")
    rows = shared.select("digest").mapInArrow(spots, "word int, bit int").distinct().groupBy("word").agg(F.collect_list("bit").alias("bits")).mapInArrow(pack, "word int, map binary").collect()
    whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in rows:
        whole[r["word"] << 13 : (r["word"] + 1) << 13] = np.frombuffer(r["map"], np.uint8)
    return whole.tobytes()


def _flags(bitmap: np.ndarray, digests: list[bytes]) -> np.ndarray:
    d = np.frombuffer(b"".join(digests), np.uint8)
    hit = [(bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 for at in _spots(d)]
    return (hit[0] & hit[1]).astype(bool)


class Encoded:
    """Encoded documents in two parts: ``alone`` (doc_id, ids) holds those that share no chunk, one row
    per row of docs; ``rows`` (doc_id, text_key) and ``texts`` (text_key, ids) hold the others, with
    each distinct text once."""

    def __init__(self, alone: DataFrame, rows: DataFrame, texts: DataFrame):
        self.alone, self.rows, self.texts = alone, rows, texts

    def documents(self) -> DataFrame:
        return self.alone.union(self.rows.join(self.texts, "text_key").select("doc_id", "ids"))


def encode(docs: DataFrame, vocabulary: str | None = None) -> Encoded:
    """Ids of each whole text as the tokenizers library gives them with the file ``vocabulary`` and
    add_special_tokens=False.

    Null and empty texts have no ids. Repeated rows are alike, one row each. Null doc_ids are kept. An
    empty table gives empty ones; other columns are left out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = vocabulary or default_vocabulary()
    content = spark.sparkContext.broadcast(open(path, encoding="utf-8").read())
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = spark.sparkContext.broadcast(_shared_filter(own))

    def cut(text: str | None, bitmap: np.ndarray):
        body = (text or "").encode("utf-8", "surrogatepass")
        cuts = chunk_cuts(body)
        digests = _digests(body, cuts)
        return body, cuts, digests, _flags(bitmap, digests) if digests else np.zeros(0, bool)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, bitmap = codec(content.value), np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            kept = [i for i, t in enumerate(texts) if not cut(t, bitmap)[3].any()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(kept, pa.int32())), _ids([np.array(c.encode(texts[i] or ""), np.int32) for i in kept])], ["doc_id", "ids"])

    chunk = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("seq", pa.int32()), ("digest", pa.binary()), ("chunk", pa.binary())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, written = np.frombuffer(sent.value, np.uint8), set()
        for batch in batches:
            out: list[tuple] = []
            if len(written) > REMEMBER:  # what was written before may then be written once more
                written.clear()
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                body, cuts, digests, flags = cut(text, bitmap)
                if flags.any():
                    key = hashlib.md5(body).digest()
                    for k, (x, y, d, f) in enumerate(zip([0, *cuts[:-1]], cuts, digests, flags, strict=True)):
                        out.append((doc, key, k, d if f else None, None if f and d in written else body[x:y]))
                        if f:
                            written.add(d)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], chunk.types[k]) for k in range(5)], schema=chunk)

    cut_up = materialise(own.mapInArrow(chunks, "doc_id long, text_key binary, seq int, digest binary, chunk binary"), "chunks")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(content.value)
        for batch in batches:
            packed = [np.array(c.encode(b.decode("utf-8")), c.packed).tobytes() for b in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(packed, pa.binary())], ["digest", "ids"])

    shared = cut_up.filter("digest is not null and chunk is not null").groupBy("digest").agg(F.first("chunk").alias("chunk")).mapInArrow(once, "digest binary, ids binary")
    refs = cut_up.filter("digest is not null").select("text_key", "seq", "digest").distinct().join(shared, "digest").select("text_key", "seq", "ids", F.lit(None).cast("binary").alias("chunk"))
    # a chunk without a digest occurs once in the corpus, so these rows are distinct as they are
    rest = cut_up.filter("digest is null").select("text_key", "seq", F.lit(None).cast("binary").alias("ids"), "chunk")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(content.value)
        for batch in batches:
            done = []
            for row in batch.column("parts"):  # one document's ids at a time as Python numbers
                parts = row.as_py()
                parts.sort(key=lambda p: p["seq"])
                ids = [c.encode(p["chunk"].decode("utf-8")) if p["ids"] is None else np.frombuffer(p["ids"], c.packed).tolist() for p in parts]
                bodies = [p["chunk"] if p["ids"] is None else b"".join(map(c.bytes_of.__getitem__, i)) for p, i in zip(parts, ids, strict=True)]
                done.append(np.array(join_chunks(c, b"".join(bodies), np.cumsum([len(b) for b in bodies]).tolist(), ids), np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), _ids(done)], ["text_key", "ids"])

    texts = refs.union(rest).groupBy("text_key").agg(F.collect_list(F.struct("seq", "ids", "chunk")).alias("parts")).mapInArrow(assemble, "text_key binary, ids array<int>")
    return Encoded(own.mapInArrow(alone, "doc_id long, ids array<int>"), cut_up.filter("seq = 0").select("doc_id", "text_key"), texts)


def decode(ids: Column, spark, vocabulary: str | None = None) -> Column:
    """The text of each list of ids, special tokens included; bytes that are no UTF-8 become U+FFFD. A null list gives
    null, an empty one an empty text."""
    content = spark.sparkContext.broadcast(open(vocabulary or default_vocabulary(), encoding="utf-8").read())

    @F.pandas_udf("string")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(content.value)
        for part in parts:
            yield pd.Series([None if x is None else c.decode(x.tolist()) for x in part], dtype=object)

    return decoded(ids)


def _summary(df: DataFrame, vocabulary: str | None) -> DataFrame:
    text = decode(F.col("ids"), df.sparkSession, vocabulary)
    return df.select(
        df.columns[0],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(text, 256).alias("decoded_sha256"),
    )


def encode_and_decode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256: one row per
    row of docs. Texts that several documents share are summed up once."""
    e = encode(docs, vocabulary)
    return _summary(e.alone, vocabulary).union(e.rows.join(_summary(e.texts, vocabulary), "text_key").drop("text_key"))
