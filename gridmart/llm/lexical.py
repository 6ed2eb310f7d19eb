"""Ranked lexical search of many items at once, with what items have in common evaluated once.

An item's terms with their number of repeats are its atoms. Atoms that stand together in several items are mined: the pair
of nodes that most items share becomes a node of its own, in all of them, until no pair is shared. So items become sums over
a graph in which each node adds two others, and a node's partial accumulators are made once for all items above it.

1. One pass over the texts keeps, per block of documents, how often each has the items' terms, and counts documents and terms.
2. One pass over these blocks scores every document: the accumulators of atoms, then of shared nodes by their depth, then of
   items; the ``k`` best of each item in a task stay, documents of the ``k``-th score included until ids decide.
3. The best of the tasks are ranked, in two steps, so that no group grows with the number of tasks.

Every document that has a term of an item is scored; nothing is skipped. Items are taken in groups of a bounded size, and
several groups with a bounded size together in a pass; so what is sent to the tasks never exceeds that, and the passes
grow with the items. Terms are told by 64-bit hashes.

A null text has no terms and does not count as a document. Rows without an id count and can be found; they come last among
equal scores. Repeated rows of a document count and are found singly. Rows of one item id are one item with the terms of its
distinct texts together; an item without terms finds nothing.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.tables import in_tasks, written
from gridmart.llm.terms import terms_of

GROUP_BYTES, PASS_BYTES = 256_000, 16_000_000
#: Shared nodes of an item that take part in mining; the others are added one by one.
MINED = 64
BLOCK, AT_ONCE, HELD = 256, 1 << 15, 200_000
BLOCKS = "kind int, cell long, n long, ids array<long>, lengths array<long>, ends array<int>, terms array<int>, times array<int>"
FOUND = "item int, doc_id long, score long"


@dataclass
class Graph:
    """The items of a group as sums: ``atoms`` are (term, repeats), a node adds two earlier ones, an item some of all."""

    atoms: list[tuple[int, int]]
    nodes: list[tuple[int, int]]
    items: list[list[int]]
    leaf_terms: np.ndarray = field(init=False)
    leaf_repeats: np.ndarray = field(init=False)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self):
        self.leaf_terms, self.leaf_repeats = (np.array([a[i] for a in self.atoms], np.int64) for i in (0, 1))
        depth = [0] * len(self.atoms)
        for a, b in self.nodes:
            depth.append(max(depth[a], depth[b]) + 1)
        levels = defaultdict(list)
        for i, (a, b) in enumerate(self.nodes, len(self.atoms)):
            levels[depth[i]].append((i, a, b))
        self.steps = [tuple(np.array(x) for x in zip(*levels[d], strict=True)) for d in sorted(levels)]


def mined(items: list[dict[int, int]]) -> Graph:
    """The graph of items given as repeats by term. Pairs of nodes in most items come first, of equal ones the earlier nodes."""
    number: dict[tuple[int, int], int] = {}
    sums = [[number.setdefault(atom, len(number)) for atom in sorted(item.items())] for item in items]
    often = Counter(node for nodes in sums for node in nodes)
    # Nodes that several items have, the most common ones of each item.
    open_ = [set(sorted((x for x in nodes if often[x] > 1), key=lambda x: (-often[x], x))[:MINED]) for nodes in sums]
    holders: defaultdict[tuple[int, int], set[int]] = defaultdict(set)
    for i, nodes in enumerate(open_):
        ordered = sorted(nodes)
        for j, a in enumerate(ordered):
            for b in ordered[j + 1 :]:
                holders[a, b].add(i)
    heap = [(-len(x), pair) for pair, x in holders.items() if len(x) > 1]
    heapq.heapify(heap)
    pairs: list[tuple[int, int]] = []
    own = [set(nodes) for nodes in sums]
    while heap:
        n, (a, b) = heapq.heappop(heap)
        having = holders.get((a, b), ())
        if len(having) != -n:
            if len(having) > 1:
                heapq.heappush(heap, (-len(having), (a, b)))
            continue
        node = len(number) + len(pairs)
        pairs.append((a, b))
        having = list(having)
        for i in having:
            for gone in (a, b):
                open_[i].discard(gone)
                own[i].discard(gone)
                for other in open_[i]:
                    holders[min(gone, other), max(gone, other)].discard(i)
            for other in open_[i]:
                holders[other, node].add(i)
        for i in having:
            open_[i].add(node)
            own[i].add(node)
        near = {other for i in having for other in open_[i]} - {node}
        for other in near:
            if len(holders[other, node]) > 1:
                heapq.heappush(heap, (-len(holders[other, node]), (other, node)))
    return Graph(list(number), pairs, [sorted(nodes) for nodes in own])


def accumulators(graph: Graph, leaves: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and scores of the items over a block of documents; ``leaves`` has the atoms' contributions."""
    n = len(graph.atoms)
    sums = np.empty((n + len(graph.nodes), leaves.shape[1]), np.int64)
    sums[:n] = leaves
    for at, a, b in graph.steps:
        sums[at] = sums[a] + sums[b]
    whole = [i for i, nodes in enumerate(graph.items) if nodes]
    lo = 0
    while lo < len(whole):
        hi, held = lo, 0
        while hi < len(whole) and (hi == lo or held + len(graph.items[whole[hi]]) <= AT_ONCE):
            held += len(graph.items[whole[hi]])
            hi += 1
        some = [graph.items[i] for i in whole[lo:hi]]
        edges = np.cumsum([0, *(len(x) for x in some[:-1])])
        yield np.array(whole[lo:hi]), np.add.reduceat(sums[np.concatenate(some)], edges, axis=0)
        lo = hi


# --- items ---------------------------------------------------------------------------------


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, term, n)`` of each text."""
    for batch in batches:
        for words in terms_of(batch.column(1)):
            hashes = words.hashes().view(np.int64)
            for i, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True), words.first):
                terms, n = np.unique(hashes[a:b], return_counts=True)
                if len(terms):
                    ids = batch.column(0).take(pa.array(np.full(len(terms), i)))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(terms), pa.array(n)], names=["id", "term", "n"])


def _mined_group(group: pa.Table) -> pa.Table:
    """One row with the graph of a group of items ``(group, id, terms, repeats)``."""
    items = [dict(zip(t, n, strict=True)) for t, n in zip(group.column("terms").to_pylist(), group.column("repeats").to_pylist(), strict=True)]
    graph = mined(items)
    lists = {
        "terms": [a for a, _ in graph.atoms],
        "repeats": [n for _, n in graph.atoms],
        "lefts": [a for a, _ in graph.nodes],
        "rights": [b for _, b in graph.nodes],
        "sums": [x for nodes in graph.items for x in nodes],
        "sizes": [len(nodes) for nodes in graph.items],
    }
    ids = group.column("id").combine_chunks()
    columns = {"group": group.column("group").slice(0, 1), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)}
    return pa.table(columns | {name: pa.array([x], pa.list_(pa.int64())) for name, x in lists.items()})


def item_graphs(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, list[list[int]]]:
    """The graphs of groups of items, one row for each, and the groups of each pass."""
    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where("text is not null").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    groups = max(1, -(-int(total) // GROUP_BYTES))
    terms = in_tasks(rows, _item_terms, f"id {kind}, term long, n long").groupBy("id", "term").agg(F.sum("n").alias("n"))
    whole = terms.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "n"))).alias("terms"))
    whole = whole.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), "id", F.col("terms.term").alias("terms"), F.col("terms.n").alias("repeats"))
    names = ", ".join(f"{x} array<long>" for x in ("terms", "repeats", "lefts", "rights", "sums", "sizes"))
    graphs = whole.groupBy("group").applyInArrow(_mined_group, f"group int, ids array<{kind}>, {names}")
    per_pass = max(1, PASS_BYTES // GROUP_BYTES)
    return written(graphs, "lexical-graphs"), [list(range(lo, min(lo + per_pass, groups))) for lo in range(0, groups, per_pass)]


def _graph(row) -> Graph:
    ends = np.cumsum(row.sizes).tolist()
    items = [row.sums[b - n : b] for b, n in zip(ends, row.sizes, strict=True)]
    return Graph(list(zip(row.terms, row.repeats, strict=True)), list(zip(row.lefts, row.rights, strict=True)), items)


# --- documents -----------------------------------------------------------------------------


def _blocks(vocabulary):
    """Blocks of documents with their terms among the vocabulary (kind 0), and counts of the task (kind 1).

    The counts' cells are the terms; -1 is the number of documents with terms, -2 that of all their terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        having, documents, length = np.zeros(len(known), np.int64), 0, 0
        for batch in batches:
            ids = batch.column(0)
            for words in terms_of(batch.column(1)):
                counts = words.counts
                documents += int((counts > 0).sum())
                length += int(counts.sum())
                if not len(known):
                    continue
                hashes = words.hashes()
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = np.flatnonzero(known[place] == hashes)
                text = np.repeat(np.arange(len(counts)), counts)[hit]
                cells, times = np.unique(text * len(known) + place[hit], return_counts=True)
                text, term = np.divmod(cells, len(known))
                having += np.bincount(term, minlength=len(known))
                for lo in range(0, len(counts), BLOCK):
                    hi = min(lo + BLOCK, len(counts))
                    a, b = np.searchsorted(text, (lo, hi))
                    own, ends = np.unique(text[a:b], return_index=True)
                    if not len(own):
                        continue
                    ends = np.append(ends[1:], b - a)
                    lists = [ids.take(pa.array(own + words.first)), pa.array(counts[own]), pa.array(ends.astype(np.int32)), pa.array(term[a:b].astype(np.int32)), pa.array(times[a:b].astype(np.int32))]
                    yield _row(0, None, None, lists)
        some = np.flatnonzero(having)
        for cell, n in [*zip(some.tolist(), having[some].tolist(), strict=True), (-1, documents), (-2, length)]:
            yield _row(1, cell, n, None)

    return run


_KINDS = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())


def _row(kind: int, cell: int | None, n: int | None, lists: list[pa.Array] | None) -> pa.RecordBatch:
    columns = [pa.array([kind], pa.int32()), pa.array([cell], pa.int64()), pa.array([n], pa.int64())]
    if lists:
        columns += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(t)) for x, t in zip(lists, _KINDS, strict=True)]
    else:
        columns += [pa.array([None], pa.list_(t)) for t in _KINDS]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in BLOCKS.split(", ")])


def term_weights(having: np.ndarray, documents: int) -> np.ndarray:
    """Thousandths of the logarithm, rounded down, in doubles."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in having.tolist()], np.int64)


class Best:
    """The ``k`` best documents of each item so far; ties go to the smaller id, and rows without an id come last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)  # a score above 0 is needed
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        row, column = np.nonzero(scores >= self.least[items][:, None])
        if len(row):
            self.held.append((items[row], scores[row, column], ids[column], known[column]))
            self.n += len(row)
            if self.n > HELD:
                self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        items, scores, ids, known = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((ids, ~known, -scores, items))
        items, scores, ids, known = (x[order] for x in (items, scores, ids, known))
        begin = np.flatnonzero(np.diff(items, prepend=-1))
        place = np.arange(len(items)) - np.repeat(begin, np.diff(np.append(begin, len(items))))
        last = place == self.k - 1
        self.least[items[last]] = scores[last]
        self.held = [tuple(x[place < self.k] for x in (items, scores, ids, known))]
        # Of what is held only ``k`` rows an item stay, so the next time comes after as many more.
        self.n = 0
        return self.held[0]


def _scored(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graphs, weights, documents, length = shared.value
        edges = np.cumsum([0, *(len(g.items) for g in graphs)])
        best = Best(int(edges[-1]), k)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, ends, terms, times = (batch.column(c)[i].values for c in ("ids", "lengths", "ends", "terms", "times"))
                known = np.asarray(ids.is_valid())
                ids, lengths, ends, terms, times = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in (ids, lengths, ends, terms, times))
                m = np.array([75 + 25 * n * documents // length for n in lengths.tolist()], np.int64)
                column = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
                worth = weights[terms] * (1_000_000_000 * times.astype(np.int64) // (1000 * times.astype(np.int64) + 12 * m[column]))
                order = np.argsort(terms, kind="stable")
                sorted_terms = terms[order]
                for graph, first in zip(graphs, edges, strict=False):
                    a, b = np.searchsorted(sorted_terms, graph.leaf_terms, "left"), np.searchsorted(sorted_terms, graph.leaf_terms, "right")
                    n = b - a
                    at = order[np.repeat(a - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
                    leaf = np.repeat(np.arange(len(n)), n)
                    leaves = np.zeros((len(n), len(ids)), np.int64)
                    leaves[leaf, column[at]] = worth[at] * graph.leaf_repeats[leaf]
                    for items, scores in accumulators(graph, leaves):
                        best.add(items + first, scores, ids, known)
        items, scores, ids, known = best.settle()
        if len(items):
            yield pa.RecordBatch.from_arrays([pa.array(items.astype(np.int32)), pa.array(ids, mask=~known), pa.array(scores)], names=["item", "doc_id", "score"])

    return run


def _one_pass(docs: DataFrame, graphs: list[Graph], k: int) -> DataFrame:
    """``(item, rank, doc_id, score)`` of the items of some graphs, numbered one after the other."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([g.leaf_terms.view(np.uint64) for g in graphs]))
    for g in graphs:
        g.leaf_terms = np.searchsorted(vocabulary, g.leaf_terms.view(np.uint64))
    blocks = written(in_tasks(docs, _blocks(spark.sparkContext.broadcast(vocabulary)), BLOCKS), "lexical-blocks")
    # One row for each term of the pass, and two more.
    counts = blocks.where("kind = 1").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = dict(zip(counts.column(0).to_pylist(), counts.column(1).to_pylist(), strict=True))
    documents, length = counts.pop(-1, 0), counts.pop(-2, 0)
    having = np.zeros(len(vocabulary), np.int64)
    having[list(counts)] = list(counts.values())
    shared = spark.sparkContext.broadcast((graphs, term_weights(having, documents), documents, length))
    found = in_tasks(blocks.where("kind = 0").select("ids", "lengths", "ends", "terms", "times"), _scored(shared, k), FOUND)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("salt", F.spark_partition_id() % 64)
    for groups in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("rank") <= k)
    return found


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    groups, passes = item_graphs(items, item_id, item_text)
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"`{item_id}` {kind}, rank int, doc_id long, score long")
    for i, some in enumerate(passes):
        own = groups.where(F.col("group").isin(some)).collect()  # the graphs of about PASS_BYTES of text
        if not own:
            continue
        found = _one_pass(rows, [_graph(x) for x in own], k)
        names = spark.createDataFrame(list(enumerate(x for row in own for x in row.ids)), f"item int, id {kind}")
        found = found.join(F.broadcast(names), "item").select(F.col("id").alias(item_id), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = out.unionByName(found) if i else found
    return out
