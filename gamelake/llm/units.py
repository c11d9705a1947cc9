"""Removal of repeated units: lines (operator 1) and content-defined runs of lines (operator 3).

Both cut every whole text into units in one pass where the text is read, meet the units' digests in
one distributed grouping, and join the decisions back to the documents. Only digests and offsets
move for that; text moves once for the documents that are rewritten, and, for operator 3, once for
the bytes that are compared.

A document is known by its id and a hash of its text, so that repeated rows (same id, same text) are
one document and are all treated alike, and rows with the same id but different texts are not mixed
up. Units are ranked by id (null first), text hash and offset; the first of equal units stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm import sharing
from gamelake.llm.common import bounded_batches, fresh, materialise

SPANS = "array<struct<start_char:int,end_char:int>>"
UNIT = "doc_id long, text_hash long, unit int, start_char int, end_char int, n_lines int, n_words int, digest binary"
#: Where the lines around a chunk begin and end that it may be extended by.
AROUND = ("from_char", "to_char")
#: Least words of a line, and of a run of pieces: a passage of over 50 words holds at least one such
#: run, while common turns of phrase are shorter.
MIN_WORDS, PASSAGE_WORDS = 25, 20
#: Characters that end a sentence or a part of one, as code points.
SENTENCE_ENDS = np.array([ord(c) for c in ".!?;:"])
#: Characters of texts that are cut in one go, and an odd number for hashes of word sequences.
TOGETHER, RADIX = 1 << 21, np.uint64(0x9E3779B97F4A7C15)
#: How many ways lines are cut into chunks, as odd factors of the rolling hash. Of passages of 5 lines in
#: other surroundings these four catch about nine in ten, one of them alone fewer than half.
SEEDS = (1, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: Of each code point up to U+3001, whether str.split() takes it as white space; none is beyond.
SPACE = np.array([chr(c).isspace() for c in range(0x3002)])


def _rows(found: list[tuple], ids: pa.Array, hashes: pa.Array, more: Sequence[str] = ()) -> pa.RecordBatch:
    """found: (row of the batch, unit, start, end, lines, words, digest, and the numbers named in more)."""
    at = pa.array([x[0] for x in found], pa.int32())
    kinds = (pa.int32(),) * 5 + (pa.binary(),) + (pa.int32(),) * len(more)
    return pa.RecordBatch.from_arrays(
        [ids.take(at), hashes.take(at), *(pa.array([x[k + 1] for x in found], t) for k, t in enumerate(kinds))],
        ["doc_id", "text_hash", "unit", "start_char", "end_char", "n_lines", "n_words", "digest", *more],
    )


def _cut(docs: DataFrame, units_of, more: Sequence[str] = ()) -> DataFrame:
    """units_of: text -> iterator of (unit, start, end, lines, words, digest, and the numbers named in more)."""
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *u) for i, t in enumerate(batch.column("text").to_pylist()) if t for u in units_of(t)]
            yield _rows(found, batch.column("doc_id"), batch.column("text_hash"), more)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(cut, ", ".join([UNIT, *(f"{c} int" for c in more)]))


def line_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each line of at least ``min_words`` words: its offsets in the text (characters, end
    exclusive) and the MD5 of the line in lower case with white space runs as one blank."""

    def lines(text: str) -> Iterator[tuple]:
        start = 0
        for n, line in enumerate(text.split("\n")):
            words = line.lower().split()
            if len(words) >= min_words:
                yield n, start, start + len(line), 1, len(words), hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()
            start += len(line) + 1

    return _cut(docs, lines)


class Passages:
    """Runs of pieces in some texts, in arrays over all their words.

    A piece starts at each line, after a word that ends a sentence, at a word that is said again, and
    where a hash of two neighbours (their first and last characters and their lengths) says so (at one
    pair in eight), so that equal passages are cut alike wherever they stand. A run is the shortest
    sequence of pieces from a piece on that has ``least`` words, or the shortest one that ends at the
    end of a line."""

    def __init__(self, texts: list[str], least: int):
        body = "\n".join(texts)
        self.words = words = body.lower().split()
        of = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = np.append(SPACE[np.minimum(of, len(SPACE) - 1)], True)
        turns = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1))
        starts, ends = turns[::2], turns[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        text = np.searchsorted(begins, starts, "right") - 1
        self.text, self.starts, self.ends = text, starts - begins[text], ends - begins[text]
        line = np.append(0, np.cumsum(of == 10, dtype=np.int32))[starts]
        breaks = line[1:] > line[:-1]
        joined = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        at = np.cumsum(size + 1) - size - 1
        self.word_hashes = _of_stretches(joined, at, at + size)
        first, last = joined[at].astype(np.int64), joined[at + size - 1].astype(np.int64)
        pair = 17 * first[:-1] + 101 * last[:-1] + 43 * size[:-1] + 61 * first[1:] + 31 * last[1:] + 7 * size[1:]
        opens = np.ones(len(words), bool)
        opens[1:] = (pair % 2**31 * 1103515245 % 2**32 < 2**29) | breaks | np.isin(last[:-1], SENTENCE_ENDS) | np.fromiter(map(eq, words[1:], words), bool, max(0, len(words) - 1))
        edges = np.append(np.flatnonzero(opens), len(words))
        since = edges[:-1]
        to = edges[np.minimum(np.searchsorted(edges, since + least), len(edges) - 1)]
        inside = (to >= since + least) & (to <= np.searchsorted(text, text[since], "right"))
        till = np.append(np.flatnonzero(breaks) + 1, len(words)) if words else since
        back = np.searchsorted(edges, till - least, "right") - 1
        till, back = till[back >= 0], edges[back[back >= 0]]
        whole = text[back] == text[till - 1]
        self.runs = np.unique(np.stack([np.append(since[inside], back[whole]), np.append(to[inside], till[whole])], 1), axis=0)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each run's words, the same on every machine; runs that it takes for equal are
        compared by their digests."""
        return _of_stretches(self.word_hashes, *self.runs.T).view(np.int64)

    def digest(self, run: int) -> bytes:
        a, z = self.runs[run].tolist()
        return hashlib.md5(" ".join(self.words[a:z]).encode("utf-8", "surrogatepass")).digest()


def _of_stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash (uint64) of each stretch of values: sums of values times powers of an odd number, shifted to the
    stretch's start by the inverse power, then mixed so that all bits depend on all values."""
    n = len(values)
    power, inverse = (np.cumprod(np.append(np.uint64(1), np.full(n, b, np.uint64)), dtype=np.uint64) for b in (RADIX, np.uint64(pow(int(RADIX), -1, 1 << 64))))
    sums = np.append(np.uint64(0), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64))
    h = (sums[ends] - sums[starts]) * inverse[starts]
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xC2B2AE3D27D4EB4F)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def _together(texts: list) -> Iterator[list[int]]:
    """Places of texts of about TOGETHER characters in all; null and empty ones are left out."""
    part, size = [], 0
    for i, t in enumerate(texts):
        if t:
            part.append(i)
            size += len(t)
        if part and size >= TOGETHER:
            yield part
            part, size = [], 0
    if part:
        yield part


def passage_units(docs: DataFrame, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """One row for each run (see ``Passages``) of ``min_words`` words or more that may occur more than
    once, with the MD5 of its words in lower case, joined by blanks. Equal passages have in common the
    runs of all whole pieces in them, if these have that many words; what stands before the first and
    after the last such run isn't found. Lines and sentences are made of whole pieces.

    Texts are cut twice: for the hashes of their runs, which are counted, and for the rows of those
    whose hash is in the bitmap of repeated ones (see ``sharing``)."""
    bounded_batches(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in _together(texts):
                yield pa.RecordBatch.from_arrays([pa.array(Passages([texts[i] for i in part], min_words).hashes())], ["hash"])

    often = docs.select("text").mapInArrow(hashed, "hash long").groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    sent = docs.sparkSession.sparkContext.broadcast(sharing.bitmap(often))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in _together(texts):
                p = Passages([texts[i] for i in part], min_words)
                hit = np.flatnonzero(sharing.held(sent.value, p.hashes()))
                a, z = p.runs[hit].T
                at = pa.array(np.array(part, np.int64)[p.text[a]])
                digests = pa.array([p.digest(k) for k in hit.tolist()], pa.binary())
                numbers = (pa.array(x.astype(np.int32)) for x in (p.starts[a], p.ends[z - 1], z - a))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_hash").take(at), *numbers, digests], ["doc_id", "text_hash", "start_char", "end_char", "n_words", "digest"])

    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return own.mapInArrow(found, "doc_id long, text_hash long, start_char int, end_char int, n_words int, digest binary")


def chunk_ends(hashes: np.ndarray, seed: int) -> np.ndarray:
    """The last line of each chunk. A rolling hash over two line hashes is taken at every line; a
    chunk ends where it, times the seed, is a local minimum, and at the last line. Whether a line ends a
    chunk thus depends on the lines from two before it to one after it only, and no two neighbours both do."""
    roll = hashes.astype(np.uint64)
    roll[1:] += np.uint64(31) * hashes[:-1].astype(np.uint64)
    roll = (roll & np.uint64(0xFFFFFFFF)) * np.uint64(seed) & np.uint64(0xFFFFFFFF)
    inner = np.flatnonzero((roll[1:-1] < roll[:-2]) & (roll[1:-1] <= roll[2:])) + 1
    return np.append(inner, len(hashes) - 1)


def chunk_units(docs: DataFrame, seeds: Sequence[int] = SEEDS) -> DataFrame:
    """One row for each content-defined chunk of at least two lines, not all of them blank, with the
    MD5 of its bytes; chunk offsets leave out the line break after the last line. Each seed cuts the
    lines in another way, so that a short passage, too, likely holds a whole chunk of some; what several
    seeds cut is one unit. from_char and to_char bound the lines by which a match may be extended: those of
    the chunk before and two more, and those of the chunk after (of several seeds, the farthest)."""

    def chunks(text: str) -> Iterator[tuple]:
        lines = text.split("\n")
        if len(lines) < 2:
            return
        hashes = np.array([int.from_bytes(hashlib.md5(x.encode("utf-8", "surrogatepass")).digest()[:4]) for x in lines], np.uint32)
        starts, found = np.cumsum([0, *(len(x) + 1 for x in lines)]).tolist(), {}
        for seed in seeds:
            ends = chunk_ends(hashes, seed).tolist()
            firsts = [0, *(e + 1 for e in ends[:-1])]
            for k, (a, z) in enumerate(zip(firsts, ends, strict=True)):
                if z > a:
                    low, high = found.get((a, z), (a, z))
                    found[a, z] = min(low, max(0, firsts[k - 1] - 2) if k else a), max(high, ends[min(k + 1, len(ends) - 1)])
        for (a, z), (low, high) in sorted(found.items()):
            body = text[starts[a] : starts[z + 1] - 1]
            if body.strip():
                yield a, starts[a], starts[z + 1] - 1, z - a + 1, len(body.split()), hashlib.md5(body.encode("utf-8", "surrogatepass")).digest(), starts[low], starts[high + 1] - 1

    return _cut(docs, chunks, AROUND)


def _repeats(units: DataFrame) -> DataFrame:
    """Every unit that is not the first of its digest, with the first one's place. The grouping is
    partly done before its shuffle, so that a common unit costs one row a task. Its result is written
    before the join: only the side with the units is skewed then, and adaptive execution can split it."""
    names = {"doc_id": "kept_doc_id", "text_hash": "kept_hash", "start_char": "kept_start_char", "end_char": "kept_end_char", **{c: f"kept_{c}" for c in AROUND if c in units.columns}}
    place = F.struct(*(F.col(c).alias(name) for c, name in names.items()))
    first = materialise(units.groupBy("digest").agg(F.min(place).alias("kept"), F.count("*").alias("n")).filter("n > 1").select("digest", "kept"), "first")
    return (
        units.join(first, "digest")
        .filter(~(F.col("doc_id").eqNullSafe(F.col("kept.kept_doc_id")) & (F.col("text_hash") == F.col("kept.kept_hash")) & (F.col("start_char") == F.col("kept.kept_start_char"))))
        .select(*units.columns, "kept.*")
    )


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each line that repeats an earlier ranked one: doc_id, text_hash, unit (line number
    from 0), start_char, end_char, n_lines (1), n_words, digest, and the kept line's kept_doc_id,
    kept_hash, kept_start_char, kept_end_char.

    Null and empty texts and shorter lines have no rows; repeated rows of a document have one each.
    An empty table gives an empty one; other columns are left out."""
    return _repeats(line_units(docs, min_words))


def repeated_passages(docs: DataFrame, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """One row for each run of pieces (see ``Passages``) that repeats an earlier ranked one:
    doc_id, text_hash, start_char, end_char, n_words, digest, and the kept run's place as in
    ``repeated_lines``. Runs overlap: their union is what repeats. Each repeated word has an equal one of
    a lower rank, so that no passage goes everywhere; a short line goes only as part of a repeated run,
    and a text or passage of fewer words has no rows. ``united`` gives the union.

    Null and empty texts have no rows; repeated rows of a document have one each. An empty table gives
    an empty one; other columns are left out."""
    return _repeats(materialise(passage_units(docs, min_words), "units"))


def _runs(spans: DataFrame) -> DataFrame:
    """spans with ``run``, the same for spans of a document that overlap or have one character between them."""
    at = Window.partitionBy("doc_id", "text_hash").orderBy("start_char", "end_char")
    reach = F.max("end_char").over(at.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start_char") > F.col("reach") + 1).cast("int"), F.lit(1))
    return spans.withColumn("reach", reach).withColumn("run", F.sum(opens).over(at.rowsBetween(Window.unboundedPreceding, 0))).drop("reach")


def united(spans: DataFrame) -> DataFrame:
    """doc_id, text_hash, start_char, end_char: spans of a document that overlap or have one character between them as one."""
    runs = _runs(spans.select("doc_id", "text_hash", "start_char", "end_char").distinct())
    return runs.groupBy("doc_id", "text_hash", "run").agg(F.min("start_char").alias("start_char"), F.max("end_char").alias("end_char")).drop("run")


def _document(docs: DataFrame) -> Column:
    """A key of the id and the text's hash."""
    return F.xxhash64(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.xxhash64(docs["text"]))


def _documents_of(spans: DataFrame) -> DataFrame:
    return spans.select(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_hash").alias("key"))


def remove_spans(docs: DataFrame, spans: DataFrame, offsets: str | None = "removed_spans", changed_only: bool = False) -> DataFrame:
    """docs without the given character spans (doc_id, text_hash, start_char, end_char) and the character
    (a line break or another white space) that follows each, or, at the end of a text, the line break
    before it. Columns of docs stay as they are but for the text; the original offsets of what was cut
    are added as the column ``offsets`` (array of start_char, end_char; empty where nothing was cut; a
    column of that name is replaced) unless that is None. Null texts stay null. With ``changed_only`` only
    rows from which something is cut are returned.

    Spans don't overlap and are written tables: they are read twice. Documents that surely have none pass
    without a shuffle. Repeated rows are cut alike; null ids are an id; an empty table gives an empty one."""
    at, h, hit = fresh(docs, "own_spans", "own_hash", "may_change")
    lists = spans.distinct().groupBy(F.col("doc_id").alias("span_doc"), F.col("text_hash").alias("span_hash")).agg(F.sort_array(F.collect_list(F.struct("start_char", "end_char"))).alias(at))
    own = docs.withColumns({h: F.xxhash64("text"), hit: sharing.may_hold(docs, sharing.bitmap(_documents_of(spans)), _document(docs))})
    # the same join at every size: a list that happens to be small is not broadcast
    near = own.filter(hit)
    joined = near.join(lists.hint("merge"), near["doc_id"].cast("long").eqNullSafe(lists["span_doc"]) & (near[h] == lists["span_hash"]), "inner" if changed_only else "left")
    cut = joined.select(
        *(F.when(F.col(at).isNull(), near["text"]).otherwise(_without(near["text"], F.col(at))).alias("text") if c == "text" else near[c] for c in docs.columns if c != offsets),
        *([F.coalesce(F.col(at), F.array().cast(SPANS)).alias(offsets)] if offsets else []),
    )
    if changed_only:
        return cut
    rest = own.filter(~F.col(hit)).select(*(c for c in docs.columns if c != offsets), *([F.array().cast(SPANS).alias(offsets)] if offsets else []))
    return cut.unionByName(rest)


def _without(text: Column, spans: Column) -> Column:
    """What lies between the spans, in order; then no line break at the end that the text didn't have.
    Offsets count code points, as Spark's substring does."""
    between = F.transform(
        spans,
        lambda s, i: F.substring(text, F.when(i == 0, 0).otherwise(F.element_at(spans, F.greatest(i, F.lit(1)))["end_char"] + 1) + 1, F.greatest(F.lit(0), s["start_char"] - F.when(i == 0, 0).otherwise(F.element_at(spans, F.greatest(i, F.lit(1)))["end_char"] + 1))),
    )
    end = F.element_at(spans, -1)["end_char"]
    tail = F.substring(text, end + 2, F.lit(2**31 - 1))
    whole = F.concat(F.array_join(between, ""), tail)
    return F.when(end >= F.length(text), F.regexp_replace(whole, r"\n\z", "")).otherwise(whole)


def repeated_chunks(docs: DataFrame, seeds: Sequence[int] = SEEDS) -> DataFrame:
    """One row for each content-defined chunk of lines whose bytes equal those of an earlier ranked
    one, in the columns of ``repeated_lines`` and with from_char, to_char, kept_from_char and kept_to_char
    (see ``chunk_units``). Chunks of several seeds overlap: ``united`` gives the
    lines that repeat, each of which has an equal one of a lower rank.

    Chunks with equal MD5 digests are looked up in their documents and compared byte by byte; those
    that differ stay. Only documents with such a chunk move for that, and equal bytes are one row a task.
    Null, empty and one-line texts have no rows; repeated rows of a document have one each; an empty
    table gives an empty one; other columns are left out."""
    found = materialise(_repeats(materialise(chunk_units(docs, seeds), "chunks")), "repeats")
    dup = found.select("doc_id", "text_hash", "start_char", "end_char", "digest", F.lit(False).alias("first"))
    first = found.select(F.col("kept_doc_id").alias("doc_id"), F.col("kept_hash").alias("text_hash"), F.col("kept_start_char").alias("start_char"), F.col("kept_end_char").alias("end_char"), "digest", F.lit(True).alias("first")).distinct()
    both = dup.union(first)
    wanted = both.groupBy(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_hash")).agg(F.collect_set(F.struct("start_char", "end_char", "digest", "first")).alias("spans"))
    near = docs.filter(sharing.may_hold(docs, sharing.bitmap(_documents_of(both)), _document(docs)))
    own = near.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    bodies = (
        own.join(wanted.hint("merge"), own["doc_id"].eqNullSafe(wanted["in_doc"]) & (own["text_hash"] == wanted["in_hash"]))
        .select("doc_id", "text_hash", "text", F.explode("spans").alias("s"))
        .select("doc_id", "text_hash", "s.*", F.expr("substring(text, s.start_char + 1, s.end_char - s.start_char)").alias("body"))
    )
    unlike = materialise(bodies.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high")).filter("low <> high").select("digest"), "unlike")
    if unlike.isEmpty():
        return found
    doubtful = materialise(bodies.join(unlike, "digest"), "doubtful")
    kept = doubtful.filter("first").groupBy("digest").agg(F.first("body").alias("kept_body"))
    differ = doubtful.filter("not first").join(kept, "digest").filter("body <> kept_body").select("doc_id", "text_hash", "start_char", "end_char").distinct()
    same = (found["text_hash"] == differ["text_hash"]) & (found["start_char"] == differ["start_char"]) & (found["end_char"] == differ["end_char"])
    return found.join(differ, found["doc_id"].eqNullSafe(differ["doc_id"]) & same, "left_anti")


def _same_lines(own: Column, kept: Column, before: Column) -> Column:
    """How many characters two texts have in common in whole lines, read from their ends where before
    is true, else from their starts; lines of blanks at the far end don't count. Each line counts its break."""
    a, b = (F.split(x, "\n") for x in (own, kept))
    a, b = (F.when(before, F.reverse(x)).otherwise(x) for x in (a, b))
    unlike = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    shared = F.when(unlike > 0, F.slice(a, 1, (unlike - 1).cast("int"))).otherwise(a)
    last = F.coalesce(F.array_max(F.transform(shared, lambda x, i: F.when(x.rlike("[^ \\t\\r]"), i + 1).otherwise(0))), F.lit(0))
    return F.aggregate(F.slice(shared, 1, last), F.lit(0), lambda n, x: n + F.length(x) + 1)


def extensions(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text_hash, start_char, end_char: whole lines beside the chunks of ``repeated_chunks`` that
    equal, byte by byte, the lines beside the kept chunk, as far as from_char and to_char of both reach.

    A passage that two documents share holds, of each seed, the same chunks but for those that its first and last
    lines are in; these lie in the chunks beside its outermost whole ones (and, at the front, in two more
    lines), so that this much is looked at, at the ends of what repeats without a gap. Each such line, too, has an equal
    one of a lower rank. Lines of blanks at the far end stay. found is a written table. Only documents with such an
    end, or the kept place of one, move; a kept place is one row however many repeat it."""
    ends = Window.partitionBy("doc_id", "text_hash", "run")
    edges = _runs(found).withColumns({"low": F.min("start_char").over(ends), "high": F.max("end_char").over(ends)})
    sides = F.array(
        F.struct(F.lit(True).alias("before"), F.col("start_char").alias("edge"), F.col("from_char").alias("a"), (F.col("start_char") - 1).alias("z"), F.col("kept_from_char").alias("kept_a"), (F.col("kept_start_char") - 1).alias("kept_z"), (F.col("start_char") == F.col("low")).alias("open")),
        F.struct(F.lit(False).alias("before"), F.col("end_char").alias("edge"), (F.col("end_char") + 1).alias("a"), F.col("to_char").alias("z"), (F.col("kept_end_char") + 1).alias("kept_a"), F.col("kept_to_char").alias("kept_z"), (F.col("end_char") == F.col("high")).alias("open")),
    )
    # a side of no line has z < a, as there is no line break
    sided = edges.select("doc_id", "text_hash", "kept_doc_id", "kept_hash", F.explode(sides).alias("s")).select("doc_id", "text_hash", "kept_doc_id", "kept_hash", "s.*")
    wide = materialise(sided.filter("open and z >= a and kept_z >= kept_a").drop("open").distinct(), "sides")
    place = wide.select("doc_id", "text_hash", "a", "z").union(wide.select("kept_doc_id", "kept_hash", "kept_a", "kept_z"))
    wanted = place.groupBy(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_hash")).agg(F.collect_set(F.struct("a", "z")).alias("places"))
    near = docs.filter(sharing.may_hold(docs, sharing.bitmap(_documents_of(place)), _document(docs)))
    own = near.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    parts = (
        own.join(wanted.hint("merge"), own["doc_id"].eqNullSafe(wanted["in_doc"]) & (own["text_hash"] == wanted["in_hash"]))
        .select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_hash"), "text", F.explode("places").alias("p"))
        .select("of_doc", "of_hash", F.col("p.a").alias("of_a"), F.col("p.z").alias("of_z"), F.expr("substring(text, p.a + 1, p.z - p.a)").alias("part"))
    )
    parts = materialise(parts.dropDuplicates(["of_doc", "of_hash", "of_a", "of_z"]), "beside")

    def with_part(df: DataFrame, doc: str, text: str, a: str, z: str, name: str) -> DataFrame:
        same = df[doc].eqNullSafe(parts["of_doc"]) & (df[text] == parts["of_hash"]) & (df[a] == parts["of_a"]) & (df[z] == parts["of_z"])
        return df.join(parts, same).select(*df.columns, F.col("part").alias(name))

    both = with_part(with_part(wide, "doc_id", "text_hash", "a", "z", "own"), "kept_doc_id", "kept_hash", "kept_a", "kept_z", "kept")
    n = both.withColumn("n", _same_lines(F.col("own"), F.col("kept"), F.col("before"))).filter("n > 0")
    return n.select("doc_id", "text_hash", F.expr("if(before, edge - n, edge + 1)").alias("start_char"), F.expr("if(before, edge - 1, edge + n)").alias("end_char"))


def drop_repeated_chunks(docs: DataFrame, offsets: str | None = "removed_spans") -> DataFrame:
    """docs without the union of the chunks of ``repeated_chunks`` and their ``extensions``; see
    ``remove_spans``, also for odd rows."""
    found = materialise(repeated_chunks(docs), "found")
    spans = found.select("doc_id", "text_hash", "start_char", "end_char").union(extensions(docs, found))
    return remove_spans(docs, materialise(united(spans), "spans"), offsets)


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, offsets: str | None = "removed_spans") -> DataFrame:
    """docs without the lines of ``repeated_lines``; see ``remove_spans``, also for odd rows."""
    return remove_spans(docs, materialise(repeated_lines(docs, min_words).select("doc_id", "text_hash", "start_char", "end_char"), "spans"), offsets)


def drop_repeated_passages(docs: DataFrame, min_words: int = PASSAGE_WORDS, offsets: str | None = "removed_spans", changed_only: bool = False) -> DataFrame:
    """docs without the union of the passages of ``repeated_passages``; see ``remove_spans``, also for odd rows."""
    return remove_spans(docs, materialise(united(repeated_passages(docs, min_words)), "spans"), offsets, changed_only)
