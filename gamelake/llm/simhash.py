"""SimHash near-duplicates (operator 9) through a byte-position inverted index.

Two 64-bit fingerprints that differ in at most four bits agree in at least four of their eight bytes.
One posting for each (position, byte) would list 1/256 of all rows, so the corpus is first dealt under
the bytes of three positions. The twenty triples used meet every set of four positions, so any such
pair shares a list. In a list, postings under single positions and bytes give the tally of the shared
bytes of each pair; pairs that reach four are verified by their differing bits.

Only connectivity is asked for, so a list gives a spanning forest of its links, never all its pairs.
Long lists are dealt anew under more bytes and bits (see ``links``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gamelake.llm.common import bounded_batches, materialise
from gamelake.llm.graph import connected_components

BITS, BYTES_SHARED, SHINGLE, SEED = 4, 4, 4, 42
#: Fingerprints of a list that meet in one group; a cell of a longer list has at most about twice as many.
CELL = 4096


def index_triples() -> list[tuple[int, int, int]]:
    """Triples of the eight positions such that any four positions hold one (Turan's construction)."""
    group = {p: k for k, ps in enumerate(((0, 1, 2), (3, 4, 5), (6, 7))) for p in ps}

    def used(t: tuple[int, ...]) -> bool:
        k = [group[p] for p in t]
        return any(k.count(g) == 3 or (k.count(g) == 2 and k.count((g + 1) % 3) == 1) for g in range(3))

    return [t for t in combinations(range(8), 3) if used(t)]


def fingerprint_of(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(body[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)], dtype="<u8")
    count = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        count += np.unpackbits(h[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprint(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield pd.Series([fingerprint_of(t) for t in part], dtype=np.int64)


def fingerprint(text: Column) -> Column:
    """64-bit SimHash of the whole text, as a signed long: ASCII letters in lower case, words between
    ASCII white space, four-word shingles with repeats (fewer words: all of them; none: zero)."""
    return _fingerprint(text)


def spanning_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, breadth first.

    Each (position, byte) has a posting list of the fingerprints with that byte there. The shared bytes of
    a fingerprint and every other are tallied from the postings of its own eight bytes; only those that
    reach the guaranteed minimum are compared. A byte that the whole list has counts for all at once."""
    fps = prints.view(np.uint64)
    at = fps.view(np.uint8).reshape(-1, 8)
    varied = [p for p in range(8) if (at[:, p] != at[0, p]).any()] if len(fps) > 1 else []
    least = BYTES_SHARED - (8 - len(varied))
    order = {p: np.argsort(at[:, p], kind="stable") for p in varied}
    ends = {p: np.append(0, np.cumsum(np.bincount(at[:, p], minlength=256))) for p in varied}
    new, a, b = np.ones(len(fps), bool), [], []
    for first in range(len(fps)):
        if not new[first]:
            continue
        new[first] = False
        frontier = [first]
        while frontier:
            f = frontier.pop()
            if least > 0:
                own = at[f].tolist()
                posted = np.concatenate([order[p][ends[p][own[p]] : ends[p][own[p] + 1]] for p in varied])
                if least == 1:
                    near = np.unique(posted)
                else:
                    near = np.flatnonzero(np.bincount(posted, minlength=len(fps)) >= least)
                near = near[new[near]]
            else:
                near = np.flatnonzero(new)
            near = near[np.bitwise_count(fps[near] ^ fps[f]) <= BITS]
            if len(near):
                new[near] = False
                a.append(np.full(len(near), fps[f]))
                b.append(fps[near])
                frontier.extend(near.tolist())
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *a]).view(np.int64), np.concatenate([none, *b]).view(np.int64)


def _finer(listed: DataFrame, level: int) -> DataFrame:
    """Lists that are too long, dealt anew (key, triple, fourth, fp) so that any pair that links still meets.

    Level 1: under the byte of a fourth position, as such a pair shares four. Level 2: the 32 bits at the
    other positions in five blocks, one of which such a pair shares, as it differs in at most four bits."""
    if level == 1:
        others = F.array(*[F.array(*[F.lit(p) for p in range(8) if p not in t]) for t in index_triples()])
        dealt = listed.select("key", "triple", F.explode(F.element_at(others, F.col("triple") + 1)).alias("fourth"), "fp")
        return dealt.withColumn("key", F.xxhash64("key", "fourth", F.expr("shiftrightunsigned(fp, 8 * fourth) & 255")))
    others = F.array(*[F.array(*[F.array(*[F.lit(p) for p in range(8) if p not in t and p != q]) for q in range(8)]) for t in index_triples()])
    rest = listed.withColumn("others", F.slice(F.element_at(F.element_at(others, F.col("triple") + 1), F.col("fourth") + 1), 1, 4))
    bits = rest.withColumn("rest", F.expr("aggregate(others, 0L, (x, p) -> (x << 8) | (shiftrightunsigned(fp, 8 * p) & 255))"))
    blocks = F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("rest", 6 * k + max(0, k - 3)).bitwiseAND(F.lit(63 if k < 3 else 127)).alias("bits")) for k in range(5)])
    return bits.select("key", "triple", "fourth", "fp", F.explode(blocks).alias("b")).select(F.xxhash64("key", "b.block", "b.bits").alias("key"), "triple", "fourth", "fp")


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp, long) that hold every connected group together.

    A list of more than CELL fingerprints is dealt anew twice, five times its rows each, into lists some
    256 and then 64 times shorter; what is still longer is dealt into cells of two parts, so that no task
    gets more than about 2 * CELL fingerprints of a list."""
    bounded_batches(prints.sparkSession)
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    keys = [F.struct((F.lit(k << 24).cast("long") + byte(x) * 65536 + byte(y) * 256 + byte(z)).alias("key"), F.lit(k).alias("triple")) for k, (x, y, z) in enumerate(index_triples())]
    posted = prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.key", "k.triple", F.lit(-1).alias("fourth"), "fp")
    lists = []
    for level in range(3):
        sizes = materialise(posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
        long = sizes.filter(F.col("n") > CELL)
        last = level == 2 or long.isEmpty()
        lists.append(posted.join(sizes if last else sizes.filter(F.col("n") <= CELL), "key"))
        if last:
            break
        posted = _finer(posted.join(long.select("key"), "key"), level + 1)
    listed = lists[0]
    for other in lists[1:]:
        listed = listed.unionByName(other)
    listed = listed.withColumn("parts", F.ceil(F.col("n") / CELL).cast("int")).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    cells = listed.select("fp", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select("fp", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    members = cells.groupBy("key", "i", "j").agg(F.collect_list("fp").alias("fps"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("fps")
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
            found = [spanning_links(np.unique(flat[x:y])) for x, y in zip(ends[:-1], ends[1:], strict=True)]
            none = np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *(f[k] for f in found)])) for k in (0, 1)], ["a", "b"])

    return members.select("fps").mapInArrow(linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach): one row
    per row of docs.

    Null and empty texts have fingerprint zero and are linked like others. A row without an id has a
    fingerprint and the component of the documents that share it, if any; it does not link others.
    Repeated rows are alike. An empty table gives an empty one; other columns are left out."""
    bounded_batches(docs.sparkSession)
    own = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text")).alias("fp")), "prints")
    nodes = own.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("root"))
    groups = materialise(connected_components(links(nodes.select("fp"))), "components")
    joined = nodes.join(groups, nodes["fp"] == groups["node"], "left")
    least = joined.filter("component is not null").groupBy("component").agg(F.min("root").alias("least"))
    known = joined.join(least, "component", "left").select("fp", F.coalesce("least", "root").alias("component_id"))
    return own.join(known, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id. Rows without an id stay;
    of repeated rows with one id, all or none stay. Empty and null texts are near-duplicates of each other;
    an empty table gives an empty one; other columns stay, whatever their names."""
    groups = near_duplicates(docs).filter("doc_id is not null and doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(groups, docs["doc_id"].cast("long") == groups["gone"], "left_anti").select(*docs.columns)
