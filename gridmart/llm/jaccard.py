"""Near duplicates: an exact similarity join of word shingles with skipping by set relations.

A document's set is its distinct shingles of five words. Two documents link when their intersection has at least
75 of 100 parts of their union. Every such pair shares one of the first quarter of their shingles in any common order; the
order puts shingles of many documents last, so lists of the index are short.

What one set's answers say about another's is used three times. Equal sets are one class with one set that stands for all.
Sets that agree in a few minimum hashes are first compared with one leader each, the most central one; those that link are one
component from then on, and whatever a member links to, its component has. A leader's answers then serve its members: of two
sets of different components their leaders are compared first. Since the shingles in which a set differs from its leader are
counted, the leaders' overlap bounds the members': at most what the members have beyond their leaders comes on top, at most what
they lack goes off. Only pairs that these bounds do not decide are compared themselves.

The lists of the index are skipped by blocks. A list's members are sorted by size class and by the position of the shingle in
their sets, and cut into blocks. A pair of blocks is skipped as a whole, by its largest rest behind the positions, if these
leave too little for the needed intersection, if the sizes are too far apart, or if all members are of one component; so is a
whole list of one component. Pairs of members are only looked at in the blocks that are left.

Before sets are compared, bit maps rule out those that differ in too many shingles; the rest is compared exactly, on the
whole texts. Candidates are no pairs within a group, as long as its members link to their leaders; nothing is capped, and what
neither leaders nor bounds settle is compared pair by pair.

Texts are lower-cased (A-Z). A text of fewer than five words is one shingle as a whole; without words a document has no
set and links with nothing. Null texts have no words. Rows of one id are one document, linked in itself; rows without an
id link with nothing. Shingles are told by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.components import components
from gridmart.llm.tables import by_shuffle, gathered, in_tasks, written
from gridmart.llm.words import Words, mixed, ranges, signed, windows, words_of

SHINGLE, PERCENT = 5, 75
BINS, BANDS = 32, 8
#: A shingle is common if that many documents that a task holds at once have it and its counts add up to that part of all documents.
COMMON_IN_TASK, COMMON_LEAST, COMMON_PART = 2, 64, 4000
#: The most common shingles that are told apart in the order of all; further ones are like any other.
MOST_COMMON = 200_000
LIST_ROWS, ENTRIES, BLOCK, PAIRS_AT_ONCE = 150_000, 100_000, 64, 250_000
#: What a task holds at once: bytes of texts and shingles to be counted. A longer text is held as a whole.
TEXT_BYTES, COUNTED = 400_000, 1_000_000
SKETCH = "kind int, doc_id long, size long, signature long, check long, bands array<long>, bits binary"


def shingle_sets(words: Words, shingle: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    hashes = words.hashes()
    all_ = windows(hashes, shingle)
    out = []
    for lo, n in zip(words.bounds[:-1].tolist(), words.counts.tolist(), strict=True):
        if n >= shingle:
            out.append(np.unique(all_[lo : lo + n - shingle + 1]))
        else:
            out.append(ranges(hashes, np.array([lo]), n) if n else np.zeros(0, np.uint64))
    return out


def signature(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    one, two = int(mixed(own + np.uint64(77)).sum(dtype=np.uint64)), int(mixed(own ^ np.uint64(0xABCDEF)).sum(dtype=np.uint64))
    return _long(one), _long(two)


def _long(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def bands(own: np.ndarray) -> list[int]:
    """Hashes of the least shingles of groups of bins; groups without any are left out."""
    edge = np.searchsorted(own, np.arange(BINS, dtype=np.uint64) << np.uint64(59))
    filled = np.append(edge[1:], len(own)) > edge
    least = np.where(filled, own[np.minimum(edge, len(own) - 1)], np.uint64(0)).reshape(BANDS, -1)
    keys = mixed(mixed(least + np.arange(1, BINS // BANDS + 1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    return keys[filled.reshape(BANDS, -1).any(axis=1)].view(np.int64).tolist()


def bitmap(own: np.ndarray) -> bytes:
    """As many bits as the set has shingles, rounded up to a power of two; each shingle turns one over.

    The bits in which two maps differ are no more than the shingles in which the sets differ.
    """
    n = max(64, 1 << (len(own) - 1).bit_length())
    counts = np.bincount((own & np.uint64(n - 1)).astype(np.int64), minlength=n)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _room(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles each pair can share at most, by its maps."""
    for batch in batches:
        sizes = [batch.column(c).to_numpy() for c in ("a_size", "b_size")]
        most = np.zeros(batch.num_rows, np.int64)
        for i, (m, n, x, y) in enumerate(zip(*sizes, batch.column("a_bits"), batch.column("b_bits"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            size = min(len(x), len(y))
            # A longer map is folded: its halves turn each other over.
            x, y = (np.bitwise_xor.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
            most[i] = (m + n - int(np.bitwise_count(x ^ y).sum())) // 2
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *map(pa.array, (*sizes, most))], names=["a", "b", "a_size", "b_size", "most"])


def _sketched(shingle: int) -> Callable:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
    names = [x.split()[0] for x in SKETCH.split(", ")]

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def common(seen: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(np.concatenate(seen), return_counts=True)
        seen.clear()
        often = counts >= COMMON_IN_TASK
        values, counts = values[often].view(np.int64), counts[often]
        if len(values):
            none = [pa.nulls(len(values), t) for t in kinds]
            none[0], none[2], none[3] = pa.array(np.ones(len(values), np.int32)), pa.array(counts), pa.array(values)
            yield pa.RecordBatch.from_arrays(none, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        held = 0
        for batch in batches:
            ids = batch.column(0)
            for words in words_of(batch.column(1), lower=True, size=TEXT_BYTES):
                rows = []
                for i, own in enumerate(shingle_sets(words, shingle), words.first):
                    if len(own):
                        rows.append((0, ids[i].as_py(), len(own), *signature(own), bands(own), bitmap(own)))
                        seen.append(own)
                        held += len(own)
                    else:
                        rows.append((0, ids[i].as_py(), 0, 0, 0, [], None))
                yield rows_of(rows)
                if held > COUNTED:
                    yield from common(seen)
                    held = 0
        if seen:
            yield from common(seen)

    return run


def _compared(shingle: int) -> Callable:
    """How many shingles both texts of a pair share, and their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, 3), np.int64)
            for lo in range(0, batch.num_rows, 250):
                part = batch.slice(lo, 250)
                sets = [[own for words in words_of(part.column(c), lower=True, size=TEXT_BYTES) for own in shingle_sets(words, shingle)] for c in ("x_text", "y_text")]
                for i, (x, y) in enumerate(zip(*sets, strict=True), lo):
                    found[i] = len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *map(pa.array, found.T)], names=["a", "b", "same", "a_size", "b_size"])

    return run


def links(same: str | Column, percent: int, a_size: str = "a_size", b_size: str = "b_size") -> Column:
    """Whether sets of these sizes that share so many shingles link."""
    same = F.col(same) if isinstance(same, str) else same
    return (same > 0) & (100 * same >= percent * (F.col(a_size) + F.col(b_size) - same))


def room(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) with the number of shingles that they share at most; ``classes`` has id, size and bits."""
    bits = classes.select("id", "size", "bits")
    pairs = pairs.join(bits.withColumnsRenamed({"id": "a", "size": "a_size", "bits": "a_bits"}), "a")
    pairs = pairs.join(bits.withColumnsRenamed({"id": "b", "size": "b_size", "bits": "b_bits"}), "b")
    return in_tasks(pairs, _room, "a long, b long, a_size long, b_size long, most long")


def overlaps(pairs: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) of documents with what their sets share; ``rows`` has id and text, and only texts in pairs move."""
    pairs = pairs.select("a", "b").distinct()
    ids = gathered(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-ids")
    texts = rows.join(ids, "id", "left_semi")
    with_x = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x_text")), "a")
    both = with_x.join(texts.select(F.col("id").alias("b"), F.col("text").alias("y_text")), "b")
    return in_tasks(both.select("a", "b", "x_text", "y_text"), _compared(shingle), "a long, b long, same long, a_size long, b_size long").distinct()


def answers(pairs: DataFrame, classes: DataFrame, rows: DataFrame, shingle: int, percent: int, label: str) -> tuple[DataFrame, DataFrame]:
    """Which pairs (a, b) link, and what all of them share at most: exactly, if ``exact``, or by their maps."""
    found = gathered(room(pairs, classes), f"{label}-room")
    exact = written(overlaps(found.where(links("most", percent)), rows, shingle), f"{label}-exact")
    at_most = found.groupBy("a", "b").agg(F.max("most").alias("most"))
    known = exact.groupBy("a", "b").agg(F.max("same").alias("same"))
    at_most = at_most.join(known, ["a", "b"], "left").select("a", "b", F.coalesce("same", "most").alias("most"), F.col("same").isNotNull().alias("exact"))
    return exact.where(links("same", percent)), at_most


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def members_of(leaders: DataFrame, linked: DataFrame, single: DataFrame) -> DataFrame:
    """``(id, leader, beyond, lacking)``: sets that link to a leader, with the nearest one and what they have and lack of it.

    Only ids with one set are here (``single``), and leaders lead themselves.
    """
    both = linked.select("a", "b", "same", "a_size", "b_size").unionByName(
        linked.select(F.col("b").alias("a"), F.col("a").alias("b"), "same", F.col("b_size").alias("a_size"), F.col("a_size").alias("b_size"))
    )
    ids = leaders.select(F.col("leader.id").alias("b")).distinct()
    near = both.join(ids, "b", "left_semi").join(ids.withColumnRenamed("b", "a"), "a", "left_anti")
    for side in ("a", "b"):
        near = near.join(single.withColumnRenamed("id", side), side, "left_semi")
    best = F.max_by(F.struct("b", "same", "a_size", "b_size"), F.struct("same", -F.col("b"))).alias("best")
    near = near.groupBy(F.col("a").alias("id")).agg(best)
    return near.select("id", F.col("best.b").alias("leader"), (F.col("best.a_size") - F.col("best.same")).alias("beyond"), (F.col("best.b_size") - F.col("best.same")).alias("lacking"))


def by_leaders(pairs: DataFrame, members: DataFrame, classes: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The links among pairs (a, b) of sets of different components, found by their leaders' answers where these decide."""
    for side in ("a", "b"):
        own = members.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("leader", "beyond", "lacking")))
        pairs = pairs.join(own, side, "left").withColumn(f"{side}_leader", F.coalesce(f"{side}_leader", side))
        pairs = pairs.na.fill(0, [f"{side}_beyond", f"{side}_lacking"])
    pairs = gathered(pairs, "jaccard-led")
    first = pairs.select(*_pair("a_leader", "b_leader")).distinct()
    linked, at_most = answers(first, classes, rows, shingle, percent, "jaccard-leaders")
    linked = gathered(linked.select("a", "b").distinct(), "jaccard-leader-links")
    # Where leaders link, their components are one, and their members' links tell nothing more.
    rest = pairs.where("a <> a_leader or b <> b_leader").withColumnsRenamed({"a": "x", "b": "y"}).select("*", *_pair("a_leader", "b_leader"))
    rest = rest.join(linked, ["a", "b"], "left_anti").join(at_most, ["a", "b"]).select(
        *_pair("x", "y"), "most", "exact", (F.col("a_beyond") + F.col("b_beyond")).alias("beyond"), (F.col("a_lacking") + F.col("b_lacking")).alias("lacking")
    )
    # An id can have several sets: what is left open goes by the smallest, what is sure by the largest.
    size = classes.groupBy("id").agg(F.min("size").alias("least"), F.max("size").alias("size"))
    for side in ("a", "b"):
        rest = rest.join(size.select(F.col("id").alias(side), F.col("least").alias(f"{side}_least"), F.col("size").alias(f"{side}_size")), side)
    upper = F.least(F.col("most") + F.col("beyond"), "a_size", "b_size")
    rest = gathered(rest.where(links(upper, percent, "a_least", "b_least")), "jaccard-undecided")
    sure = F.col("exact") & links(F.col("most") - F.col("lacking"), percent)
    more, _ = answers(rest.where(~sure).select("a", "b").distinct(), classes, rows, shingle, percent, "jaccard-members")
    return linked.unionByName(rest.where(sure).select("a", "b")).unionByName(more.select("a", "b")).distinct()


def _firsts(shingle: int, percent: int, common) -> Callable:
    """The first shingles of each document, common ones last: ``(id, n, firsts)``, ``n`` of them in its whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = common.value  # common shingles, ascending by hash, and their ranks
        for batch in batches:
            ids = batch.column("id")
            for words in words_of(batch.column("text"), lower=True, size=TEXT_BYTES):
                rows = []
                for i, own in enumerate(shingle_sets(words, shingle), words.first):
                    n = len(own)
                    if not n:
                        continue
                    if len(hashes):
                        place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                        is_late = hashes[place] == own
                        if is_late.any():
                            rest = own[is_late][np.argsort(ranks[place[is_late]])]
                            own = np.concatenate((own[~is_late], rest))
                    rows.append((ids[i].as_py(), n, own[: n - -(-percent * n // 100) + 1].tobytes()))
                if rows:
                    columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "firsts"])

    return run


def _dealt(parts: int) -> Callable:
    """The entries of the index, dealt to parts by shingle, packed; ``ENTRIES`` at a time, or those of one document."""

    def packs(ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, firsts: list[bytes]) -> Iterator[pa.RecordBatch]:
        length = np.array([len(x) // 8 for x in firsts])
        shingles = np.frombuffer(b"".join(firsts), np.uint64)
        part = ((shingles >> np.uint64(11)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        row = np.repeat(np.arange(len(firsts)), length)[order]
        at = (order - (np.cumsum(length) - length)[row]).astype(np.int32)
        for p in np.flatnonzero(np.diff(edges)).tolist():
            some = slice(int(edges[p]), int(edges[p + 1]))
            own = row[some]
            blob = packed([shingles[order[some]], ids[own], labels[own], sizes[own], at[some]])
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([len(own)], pa.int32()), pa.array([blob], pa.binary())], names=["part", "n", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(x).to_numpy() for x in ("id", "label", "n")]
            firsts = batch.column("firsts")
            ends = np.cumsum(pc.binary_length(firsts).to_numpy().astype(np.int64) // 8)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + ENTRIES, "right")))
                yield from packs(*(x[lo:hi] for x in columns), firsts.slice(lo, hi - lo).to_pylist())
                lo = hi

    return run


def packed(columns: list[np.ndarray]) -> bytes:
    """Shingle, id, label, size and position of entries: the shingles as they are, the others as differences, compressed."""
    shingles, ids, labels, size, at = columns
    rest = (np.diff(ids, prepend=np.int64(0)), labels - ids, size.astype(np.int32), at)
    return shingles.tobytes() + pa.compress(b"".join(x.tobytes() for x in rest), codec="zstd", asbytes=True)


def unpacked(n: int, blob: bytes) -> list[np.ndarray]:
    rest = pa.decompress(memoryview(blob)[8 * n :], decompressed_size=24 * n, codec="zstd", asbytes=True)
    ids = np.cumsum(np.frombuffer(rest, np.int64, n))
    labels = np.frombuffer(rest, np.int64, n, 8 * n) + ids
    return [np.frombuffer(blob, np.uint64, n), ids, labels, np.frombuffer(rest, np.int32, n, 16 * n), np.frombuffer(rest, np.int32, n, 20 * n)]


def _candidates(percent: int) -> Callable:
    """Pairs of documents out of the lists of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def pairs() -> Iterator[pa.RecordBatch]:
            found = candidates([np.concatenate([x[i] for x in held]) for i in range(5)], percent)
            for columns in found:
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["a", "b"])

        for batch in batches:
            for p, n, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if p != part and held:
                    yield from pairs()
                    held = []
                part = p
                held.append(unpacked(n, blob))
        if held:
            yield from pairs()

    return run


def candidates(columns: list[np.ndarray], percent: int, block: int = BLOCK, skipped: dict[str, int] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs of one part's lists that no relation settles, smaller id first; a pair can come several times.

    ``skipped`` takes the number of pairs in blocks that were passed over, and of those that were looked at.
    """
    if not len(columns[0]):
        return
    # Sizes of a class differ by less than a quarter of what may link.
    class_ = np.floor(np.log(columns[3]) * (4 / np.log(100 / percent))).astype(np.int16) if percent < 100 else columns[3]
    order = np.lexsort((columns[4], class_, columns[0]))
    h, ids, labels, size, at = (x[order] for x in columns)
    class_ = class_[order]
    known, number = np.unique(ids, return_inverse=True)
    size, at = size.astype(np.int64), at.astype(np.int64)
    rest = size - at
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    # Lists whose members are all of one component have nothing to compare.
    open_list = np.minimum.reduceat(labels, first) < np.maximum.reduceat(labels, first)
    run = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (class_[1:] != class_[:-1]))))
    in_run = np.arange(len(h)) - np.repeat(run, np.diff(np.append(run, len(h))))
    lo = np.flatnonzero(in_run % block == 0)
    hi = np.append(lo[1:], len(h))
    of_list = np.searchsorted(first, lo, "right") - 1
    low, high = (f.reduceat(size, lo) for f in (np.minimum, np.maximum))
    behind = np.maximum.reduceat(rest, lo)
    least, most = (f.reduceat(labels, lo) for f in (np.minimum, np.maximum))
    found: list[np.ndarray] = []
    held = 0

    def distinct() -> tuple[np.ndarray, ...]:
        nonlocal held
        keys = np.unique(np.concatenate(found))
        found.clear()
        held = 0
        return known[keys // len(known)], known[keys % len(known)]

    def look(x: np.ndarray, y: np.ndarray) -> None:
        """Take what may link of all pairs of the members of blocks ``x`` and ``y``."""
        nonlocal held
        n, width = (hi[x] - lo[x]) * (hi[y] - lo[y]), hi[y] - lo[y]
        which = np.repeat(np.arange(len(n)), n)
        i, j = np.divmod(np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n), width[which])
        i, j = lo[x][which] + i, lo[y][which] + j
        need = (i < j) & (labels[i] != labels[j])
        i, j = i[need], j[need]
        # If this is the first shingle that they share, no more than the smaller rest can be shared.
        share = np.minimum(rest[i], rest[j])
        may = 100 * share >= percent * (size[i] + size[j] - share)
        a, b = number[i[may]], number[j[may]]
        found.append(np.minimum(a, b) * len(known) + np.maximum(a, b))
        held += len(a)
        if skipped is not None:
            skipped["looked at"] = skipped.get("looked at", 0) + len(need)

    blocks = np.flatnonzero(open_list[of_list])
    step = 0
    while len(blocks):
        x, y = blocks, blocks + step
        share = np.minimum(behind[x], behind[y])
        may = 100 * share >= percent * (low[x] + low[y] - share)
        may &= 100 * np.minimum(high[x], high[y]) >= percent * np.maximum(low[x], low[y])
        may &= (least[x] != most[x]) | (least[y] != most[y]) | (least[x] != least[y])
        if skipped is not None:
            skipped["skipped"] = skipped.get("skipped", 0) + int(((hi[x] - lo[x]) * (hi[y] - lo[y]))[~may].sum())
        x, y = x[may], y[may]
        total = np.cumsum((hi[x] - lo[x]) * (hi[y] - lo[y]))
        cuts = np.arange(PAIRS_AT_ONCE, int(total[-1]), PAIRS_AT_ONCE) if len(total) else []
        for own in np.split(np.arange(len(x)), np.searchsorted(total, cuts, "right")):
            if len(own):
                look(x[own], y[own])
            if held > PAIRS_AT_ONCE:
                yield distinct()
        step += 1
        blocks = blocks[(blocks + step < len(lo))]
        blocks = blocks[of_list[blocks + step] == of_list[blocks]]
    if held:
        yield distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sketch = written(in_tasks(rows, _sketched(shingle), SKETCH), "jaccard-sketch")
    sets = sketch.where("kind = 0").select("doc_id", "size", "signature", "check", "bands", "bits")
    compared = sets.where("size > 0 and doc_id is not null")

    # One document stands for all with the same set.
    classes = gathered(compared.groupBy("signature", "check", "size").agg(F.min("doc_id").alias("id"), F.min("bands").alias("bands"), F.min("bits").alias("bits")), "jaccard-classes")
    total = classes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size")).alias("size")).first()
    if not total["n"]:
        return sets.select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))

    # Sets that agree in a group of least hashes meet one leader, the one that meets the most others in all its groups: the
    # text that copies were made of is near to all of them, the copies are not near to each other.
    banded = gathered(classes.select("id", "size", F.explode("bands").alias("band")), "jaccard-bands")
    groups = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    banded = gathered(banded.join(gathered(groups, "jaccard-groups"), "band"), "jaccard-grouped")
    others = gathered(banded.groupBy("id", "size").agg(F.sum("n").alias("others")), "jaccard-others")
    banded = gathered(banded.join(others, ["id", "size"]).select("band", "id", "size", "others"), "jaccard-ranked")
    leaders = banded.groupBy("band").agg(F.max_by(F.struct("id", "size"), F.struct("others", -F.col("id"))).alias("leader"))
    met = banded.join(gathered(leaders, "jaccard-leaders"), "band")
    small, large = F.least("size", "leader.size"), F.greatest("size", "leader.size")
    met = met.where((F.col("id") != F.col("leader.id")) & (100 * small >= percent * large))
    met = gathered(met.select(F.least("leader.id", "id").alias("a"), F.greatest("leader.id", "id").alias("b")).distinct(), "jaccard-met")
    linked = gathered(answers(met, classes, rows, shingle, percent, "jaccard-met")[0], "jaccard-links")
    # Rows of one id with several sets are one document.
    own = compared.join(classes.select("signature", "check", "size", "id"), ["signature", "check", "size"])
    own = gathered(own.select("doc_id", "signature", "check", "size", "id"), "jaccard-members")
    several = own.groupBy("doc_id").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.min("size").alias("small"), F.max("size").alias("large"))
    several = gathered(several.select("doc_id", (F.col("least") < F.col("most")).alias("several"), (F.col("small") == F.col("large")).alias("alike")), "jaccard-several")
    same = own.join(several.where("several").select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    first = components(linked.select("a", "b").unionByName(same.where("a <> b")))

    # The index of first shingles, with components.
    late = (
        sketch.where("kind = 1").groupBy("signature").agg(F.sum("size").alias("n"))
        .where(F.col("n") >= max(COMMON_LEAST, total["n"] // COMMON_PART))
    )
    late = late.select("signature", "n").orderBy(F.col("n").desc(), "signature").limit(MOST_COMMON).toPandas()
    hashes = late["signature"].to_numpy(np.int64).view(np.uint64)
    ranks = np.empty(len(late), np.int64)
    ranks[np.lexsort((hashes, late["n"].to_numpy()))] = np.arange(len(late))
    order = np.argsort(hashes)
    common = spark.sparkContext.broadcast((hashes[order], ranks[order]))
    parts = max(1, int(total["size"]) * (100 - percent) // 100 // LIST_ROWS + 1)
    labelled = classes.select("id").distinct().join(first.withColumnRenamed("node", "id"), "id", "left")
    labelled = gathered(labelled.select("id", F.coalesce("label", "id").alias("label")), "jaccard-labels")
    firsts = in_tasks(rows, _firsts(shingle, percent, common), "id long, n int, firsts binary").join(by_shuffle(labelled), "id")
    index = in_tasks(firsts, _dealt(parts), "part int, n int, blob binary")
    index = index.repartition(parts, "part").sortWithinPartitions("part")
    pairs = in_tasks(index, _candidates(percent), "a long, b long").distinct()
    pairs = gathered(pairs.join(met, ["a", "b"], "left_anti"), "jaccard-pairs")
    # Sets of one id, and only such, have overlaps and sizes that can be told from the id.
    single = classes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("id")
    single = single.join(several.where("not several and alike").select(F.col("doc_id").alias("id")), "id", "left_semi")
    members = gathered(members_of(leaders, linked, single), "jaccard-led-by")
    more = gathered(by_leaders(pairs, members, classes, rows, shingle, percent), "jaccard-more")

    # Components of both kinds of links, back to all documents.
    label = components(first.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))
    label = gathered(label, "jaccard-components").withColumnRenamed("node", "id")
    members = own.join(label, "id", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("label", "id").alias("component_id"))
    rest = sets.where("size = 0 or doc_id is null")
    return members.unionByName(rest.select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the smallest id; of repeated rows of an id one stays.

    Rows without an id stay.
    """
    found = near_duplicates(docs, doc_id, text).where("doc_id = component_id")
    keys = [f"_{i}_" + "_".join(docs.columns) for i in range(2)]
    kept = gathered(found.groupBy(F.col("doc_id").alias(keys[0])).agg(F.count(F.lit(1)).alias(keys[1])), "jaccard-kept")
    # Written on their own, so that Spark knows how few they are: documents move once, not again for repeated rows.
    repeated = gathered(kept.where(F.col(keys[1]) > 1).select(keys[0]), "jaccard-repeated")
    same_id = docs[doc_id].cast("long") == F.col(keys[0])
    single = docs.join(by_shuffle(kept), same_id, "left").where(F.col(doc_id).isNull() | (F.col(keys[1]) == 1))
    more = docs.join(repeated, same_id, "left_semi")
    return single.select(*docs.columns).unionByName(more.dropDuplicates([doc_id]))
