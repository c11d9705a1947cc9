"""Ranked lexical search (operator 13): many queries at once, over partial scores that queries share.

A score is a sum over the item's terms, so items that hold the same terms have the same partial sum.

1. Mining. An item's terms are put in order of how many items hold them, so that common terms stand close
   to each other. Pairs of close terms that at least two items have become one node, round after round, until
   no pair is shared: a graph in which each node is the sum of two others and each item the sum of a few
   nodes. Work grows with the length of the items, not with the square of it.
2. One pass over the texts counts terms and writes, for each document, its length and the frequencies of
   the items' terms (postings). Document frequencies come from these.
3. The second pass reads the postings in batches. It computes each term's weight for each document once,
   then each node of the graph once from its two parts (the document accumulators), then each item from
   its nodes. A task keeps the best rows of each item; the best of all tasks are ranked.

Items go through in blocks of at most ``BLOCK_TERMS`` terms, which bounds what is broadcast.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.common import bounded_batches, materialise

K = 10
#: Terms, with repeats, of the items of one block (an item of more is a block of its own).
BLOCK_TERMS = 1 << 18
#: Numbers of all accumulators that are held at once: 32 MB.
CELLS = 1 << 22
#: Rounds of mining, and how many of an item's next nodes a node is paired with. Only the work depends on
#: them, not the result.
ROUNDS, NEAR = 12, 12

#: Separators become blanks, A-Z small letters; all bytes of characters beyond ASCII belong to terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, in order: runs of digits, letters and characters beyond ASCII."""
    return (text or b"").translate(_TABLE).split()


@dataclass(frozen=True)
class Graph:
    """terms: the leaves, nodes 0 to len(terms) - 1. merges: rows (left, right) of the nodes that follow, each
    after its parts. items: id and nodes of each item."""

    terms: list[bytes]
    merges: np.ndarray
    items: list[tuple[int | None, np.ndarray]]

    def additions(self) -> int:
        """Additions that one document takes."""
        return len(self.merges) + sum(len(nodes) - 1 for _, nodes in self.items)

    def levels(self) -> list[np.ndarray]:
        """Merges that can be done together, in order."""
        level = np.zeros(len(self.terms) + len(self.merges), np.int64)
        for k, (a, b) in enumerate(self.merges):
            level[len(self.terms) + k] = max(level[a], level[b]) + 1
        own = level[len(self.terms) :]
        return [np.flatnonzero(own == v) for v in np.unique(own)]


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item (long), terms (array of binary, repeats included) of each item that has terms. Of several texts
    of one id the smallest counts; a null id is an id. Other columns are left out."""
    bounded_batches(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([terms_of(t) for t in batch.column(1).to_pylist()], pa.list_(pa.binary()))], ["item", "terms"])

    one = items.select(F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("t")).groupBy("item").agg(F.min("t").cast("binary").alias("t"))
    return one.mapInArrow(cut, "item long, terms array<binary>").filter(F.size("terms") > 0)


def blocks(items: DataFrame, most: int = BLOCK_TERMS) -> DataFrame:
    """``items`` with block (long): numbers that put at most ``most`` terms together, by running sums within
    parts of about 10,000 items, so that no task orders all of them."""
    part = F.pmod(F.xxhash64("item"), F.lit(max(1, items.count() // 10_000)))
    inside = F.sum(F.size("terms")).over(Window.partitionBy("part").orderBy("item").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = items.withColumn("part", part).withColumn("upto", inside).withColumn("cut", F.floor((F.col("upto") - 1) / (most // 2)))
    # an item that crosses a bound goes with those before it; a block then has at most half of most and one item
    return numbered.withColumn("block", F.col("part") * F.lit(1 << 32) + F.col("cut")).drop("part", "upto", "cut")


def mine(items: DataFrame, rounds: int = ROUNDS) -> Graph:
    """The graph of ``items`` (item, terms), which are one block: its size is bounded by the block's terms.

    A round looks at the pairs of a node and its NEAR next ones in each item, counts the items of each pair,
    and merges, of the pairs that two items or more have, those that both of their nodes have no better one
    than (more items, then the larger name)."""
    each = items.select("item", F.explode("terms").alias("t"))
    held = each.groupBy("t").agg(F.count_distinct(F.struct("item")).alias("held"))
    order = Window.partitionBy("item").orderBy(F.desc("held"), "t")
    # nodes are named by a digest of what they are made of, so that equal sums have equal names
    named = each.join(held, "t").select("item", F.md5("t").alias("node"), F.row_number().over(order).alias("at"))
    now, made = materialise(named.withColumns({"a": F.lit(None).cast("string"), "b": F.lit(None).cast("string")}), "nodes"), None
    near = Window.partitionBy("item").orderBy("at").rowsBetween(1, NEAR)
    for _ in range(rounds):
        own = now.select("item", "at", "node")
        pairs = own.withColumn("after", F.collect_list(F.struct("at", "node")).over(near)).withColumn("next", F.explode("after"))
        pairs = pairs.select("item", "at", F.col("next.at").alias("other"), F.least("node", "next.node").alias("a"), F.greatest("node", "next.node").alias("b"))
        shared = pairs.groupBy("a", "b").agg(F.count_distinct(F.struct("item")).alias("many")).filter("many > 1")
        # ranks differ within an item, so the best pair of each item is merged in any case
        ranked = pairs.join(shared, ["a", "b"]).withColumn("rank", F.struct("many", "a", "b", "at", "other"))
        ends = ranked.select("item", "rank", F.explode(F.array("at", "other")).alias("end"))
        best = ends.withColumn("best", F.max("rank").over(Window.partitionBy("item", "end"))).filter(F.col("rank") == F.col("best"))
        chosen = best.groupBy("item", "rank").agg(F.count("*").alias("n")).filter("n = 2").select("item", "rank.*")
        spots = chosen.select("item", F.explode(F.array(F.struct(F.col("at").alias("at"), F.lit(False).alias("gone")), F.struct(F.col("other").alias("at"), F.lit(True).alias("gone")))).alias("s"), "a", "b")
        told = own.join(spots.select("item", "s.*", "a", "b"), ["item", "at"], "left").filter(~F.coalesce("gone", F.lit(False)))
        node = F.coalesce(F.md5(F.concat("a", F.lit("+"), "b")), F.col("node"))
        now = materialise(told.select("item", node.alias("node"), "at", "a", "b"), "nodes")
        part = now.filter("a IS NOT NULL").select("a", "b", F.col("node").alias("name"))
        if part.isEmpty():
            break
        made = part if made is None else made.union(part)
    return _graph(held, made, now)


def _graph(held: DataFrame, made: DataFrame | None, now: DataFrame) -> Graph:
    """Numbers for the nodes that items reach. All of it is bounded by the terms of a block."""
    terms = sorted(bytes(r["t"]) for r in held.select("t").collect())
    number = {hashlib.md5(t).hexdigest(): i for i, t in enumerate(terms)}
    parts = {r["name"]: (r["a"], r["b"]) for r in made.distinct().collect()} if made is not None else {}
    lists: dict[int | None, list[str]] = {}
    for r in now.select("item", "node").collect():
        lists.setdefault(r["item"], []).append(r["node"])
    merges: list[tuple[int, int]] = []
    open_ = sorted({n for nodes in lists.values() for n in nodes if n not in number})
    while open_:  # parts before the nodes made of them
        name = open_[-1]
        missing = [p for p in parts[name] if p not in number]
        if name in number or not missing:
            open_.pop()
            if name not in number:
                number[name] = len(terms) + len(merges)
                merges.append((number[parts[name][0]], number[parts[name][1]]))
        else:
            open_ += missing
    items = [(i, np.array(sorted(number[n] for n in nodes), np.int64)) for i, nodes in sorted(lists.items(), key=lambda x: (x[0] is None, x[0] or 0))]
    return Graph(terms, np.array(merges, np.int64).reshape(-1, 2), items)


def postings(docs: DataFrame, terms: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc (long), n (terms of the whole text) and, for each of ``terms`` in it, ids and tfs (arrays of int), for
    each row of docs that has a term at all. Null texts have none; other columns are left out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = sent.value.get
        for batch in batches:
            doc, many, ids, tfs = [], [], [], []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms_of(t)
                if found:
                    own = [(i, c) for term, c in Counter(found).items() if (i := find(term)) is not None]
                    doc.append(d)
                    many.append(len(found))
                    ids.append([i for i, _ in own])
                    tfs.append([c for _, c in own])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(many, pa.int64()), pa.array(ids, ints), pa.array(tfs, ints)], ["doc", "n", "ids", "tfs"])

    return docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("t")).mapInArrow(count, "doc long, n long, ids array<int>, tfs array<int>")


def weights(found: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms of all of them, and the weight of each term, from the postings of all documents."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"id": pa.array(some, pa.int32()), "df": pa.array(df[some])})

    n, total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    many = np.zeros(terms, np.int64)
    for r in found.select("ids").mapInArrow(add, "id int, df long").groupBy("id").agg(F.sum("df").alias("df")).collect():
        many[r["id"]] = r["df"]
    return n, total, np.floor(1000 * np.log((2 * n + 2) / (2 * many + 1.0))).astype(np.int64)


class Best:
    """The k best (score, doc) of each item so far, equal scores by rising doc; null docs (the largest number)
    last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores, self.docs = np.zeros((items, k), np.int64), np.full((items, k), np.iinfo(np.int64).max)

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """scores: (items, len(docs))."""
        last, at = self.scores[:, -1:], self.docs[:, -1:]
        item, col = np.nonzero((scores > last) | ((scores == last) & (scores > 0) & (docs[None, :] < at)))
        if not len(item):
            return
        touched = np.unique(item)
        i = np.concatenate((item, np.repeat(touched, self.k)))
        s = np.concatenate((scores[item, col], self.scores[touched].ravel()))
        d = np.concatenate((docs[col], self.docs[touched].ravel()))
        order = np.lexsort((d, -s, i))
        i, s, d = i[order], s[order], d[order]
        first = np.searchsorted(i, touched)[:, None] + np.arange(self.k)
        self.scores[touched], self.docs[touched] = s[first], d[first]


def accumulate(graph: Graph, levels: list[np.ndarray], leaves: np.ndarray) -> np.ndarray:
    """Scores (items, documents) from the scores of the leaves (terms, documents): every node once."""
    leaf = len(graph.terms)
    acc = np.empty((leaf + len(graph.merges), leaves.shape[1]), np.int64)
    acc[:leaf] = leaves
    for at in levels:
        acc[leaf + at] = acc[graph.merges[at, 0]] + acc[graph.merges[at, 1]]
    out = np.empty((len(graph.items), leaves.shape[1]), np.int64)
    for i, (_, nodes) in enumerate(graph.items):
        acc[nodes].sum(0, out=out[i])
    return out


def term_scores(ids: np.ndarray, tf: np.ndarray, m: np.ndarray, w: np.ndarray) -> np.ndarray:
    return w[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def best_of(found: DataFrame, graph: Graph, stats: tuple[int, int, np.ndarray], k: int) -> DataFrame:
    """item (its number), doc, score: the k best of each item in each task."""
    sent = found.sparkSession.sparkContext.broadcast((graph, graph.levels(), stats))
    wide = len(graph.terms) + len(graph.merges) + len(graph.items)
    rows = max(1, CELLS // wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, levels, (n_docs, total, w) = sent.value
        best, leaf = Best(len(graph.items), k), len(graph.terms)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                doc = part.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
                m = 100 - 75 + (75 * n_docs * part.column(1).to_numpy()) // total
                ids, tf = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(doc)), part.column(2).value_lengths().to_numpy())
                leaves = np.zeros((leaf, len(doc)), np.int64)
                leaves[ids, row] = term_scores(ids, tf, m[row], w)
                best.add(accumulate(graph, levels, leaves), doc)
        item, col = np.nonzero(best.scores > 0)
        doc = best.docs[item, col]
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, mask=doc == np.iinfo(np.int64).max), pa.array(best.scores[item, col])], ["at", "doc", "score"])

    return found.mapInArrow(run, "at int, doc long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", item: str = "item_id", text: Column | str = "text", most: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents with the highest scores above 0 of each item, all
    if there are fewer; equal scores by rising doc_id, null ids last.

    Every row of docs is a document, so repeated rows are ranked beside each other. Null and empty texts
    have no terms: such documents count nowhere, such items give no rows. Of several texts of one item id
    the smallest counts. Empty tables give no rows. Other columns are left out. Each block of items writes
    its postings once; scores are exact below 2^63."""
    spark = docs.sparkSession
    numbered = materialise(blocks(item_terms(items, item, text), most), "items")
    out = None
    for (block,) in numbered.select("block").distinct().orderBy("block").collect():
        graph = mine(numbered.filter(F.col("block") == block).drop("block"))
        found = materialise(postings(docs, graph.terms, key, text), "postings")
        stats = weights(found, len(graph.terms))
        if not stats[1]:
            continue
        order = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        top = best_of(found, graph, stats, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(graph.items)], "at int, item long")
        ranked = top.join(names, "at").select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")
        out = ranked if out is None else out.union(ranked)
    if out is None:
        return spark.createDataFrame([], f"{item} long, rank int, {key} long, score long")
    return out
