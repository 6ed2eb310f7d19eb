"""Lexical search, jump hashing and importance resampling against plain versions, and on odd tables."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from gridmart.llm import lexical, resampling
from gridmart.llm.lexical import Best, Graph, accumulators, mined, ranked_documents
from gridmart.llm.numbering import numbered
from gridmart.llm.resampling import Table, drawn_documents, features, resampled, same_bytes, xxhash64
from gridmart.llm.sharding import moved, shard_slots, sharded, write_shards
from gridmart.llm.tables import written
from gridmart.llm.terms import terms_of
from pyspark.sql import functions as F

ODD = "doc_id long, text string, rank string, item long, score long, id string, shard int, place int"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [x.encode().lower().decode() for x in TERM.findall(text or "")]  # bytes: A-Z only


def odd_rows():
    chance = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "漢字", "Ab", "aB", "_", "x-y", "a" * 40, "b" * 33, "🙂z"]
    rows = [(i, " ".join(chance.choice(words) for _ in range(chance.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \n\t--"), (103, "w1 " * 30_000), (104, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (None, "w1 w2 w2"), (-9, "W1\x00w2")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "r", 1, 2, "x", 7, 8) for i, t in odd_rows()], ODD).repartition(5)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "item_id string, text string, doc_id string")


ITEMS = [("a", "w1 w2 w3 W1 漢字"), ("b", "w1 w2 w3 w1 é"), ("c", "w1, w2; w3 w9"), ("c", "w1, w2; w3 w9"), ("c", "w50"), ("d", None), ("e", "--"), ("f", "nowhere"), (None, "w2 É")]


def plain_search(docs, items, k):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for i, t in set(items):
        wanted.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, want in wanted.items():
        found = []
        for i, c, n in counted:
            m = 100 - 25 + 25 * n * n_docs // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in want.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def test_search_equals_scoring_every_document(spark, odd, monkeypatch):
    want = plain_search(odd_rows(), ITEMS, 20)
    assert want
    assert sorted(map(tuple, ranked_documents(odd, items_of(spark, ITEMS)).select("item_id", "rank", "doc_id", "score").collect()), key=str) == want
    # Several passes of several groups, blocks of few documents and sums of few nodes give the same.
    for name, value in (("GROUP_BYTES", 20), ("PASS_BYTES", 40)):
        monkeypatch.setattr(lexical, name, value)
    found = ranked_documents(odd, items_of(spark, ITEMS), k=3).collect()
    assert sorted(map(tuple, found), key=str) == plain_search(odd_rows(), ITEMS, 3)


def test_search_of_empty_tables(spark, odd):
    some = items_of(spark, ITEMS)
    for docs, items in ((odd.limit(0), some), (odd, some.limit(0)), (odd.where("text is null"), some)):
        found = ranked_documents(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and not found.count()


def test_shared_nodes_sum_to_the_items():
    chance = random.Random(5)
    items = [{chance.randrange(40): chance.randint(1, 2) for _ in range(chance.randint(0, 25))} for _ in range(60)]
    graph = mined(items)
    assert graph.nodes  # something is shared
    sums = [[a] for a in range(len(graph.atoms))]
    for a, b in graph.nodes:
        sums.append(sums[a] + sums[b])
    for item, nodes in zip(items, graph.items, strict=True):
        atoms = sorted(graph.atoms[a] for node in nodes for a in sums[node])
        assert atoms == sorted(item.items())  # each atom once
    leaves = np.arange(len(graph.atoms) * 7).reshape(-1, 7) % 11
    found = {int(i): row.tolist() for some, rows in accumulators(graph, leaves) for i, row in zip(some, rows, strict=True)}
    for i, item in enumerate(items):
        want = sum((leaves[graph.atoms.index(a)] for a in item.items()), np.zeros(7, int)).tolist()
        assert found.get(i, [0] * 7) == want
    # Shared sums take fewer additions than the items by themselves.
    assert len(graph.nodes) + sum(map(len, graph.items)) < sum(map(len, items))


def test_best_keeps_ties_until_ids_decide(monkeypatch):
    monkeypatch.setattr(lexical, "HELD", 8)
    best = Best(1, 3)
    ids = np.random.Generator(np.random.PCG64(1)).permutation(60)
    for part in ids.reshape(-1, 4):
        best.add(np.array([0]), np.full((1, 4), 5), part, np.ones(4, bool))
    assert best.settle()[2].tolist() == [0, 1, 2]


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jumps_are_those_of_the_published_function(spark):
    keys = [*range(-50, 400), 2**63 - 1, -(2**63), None, 2**33, 10**12]
    for shards in (1, 2, 8, 37):
        found = sharded(spark.createDataFrame([(k,) for k in keys], "k long"), "k", shards, "shard", "grown").collect()
        for k, shard, grown in found:
            seed = int(md5(b"" if k is None else str(k).encode()).hexdigest()[:16], 16)
            assert (shard, grown) == (jump(seed, shards), jump(seed, shards + 1))
    with pytest.raises(ValueError, match="0"):
        sharded(spark.range(1), "id", 0)


def test_a_new_shard_takes_rows_only_into_itself(spark):
    rows = spark.range(6000)
    some = rows.join(moved(rows, "id", 8), "id")
    assert 400 < some.count() < 950  # a ninth
    assert {tuple(r) for r in sharded(some, "id", 9).select("shard").distinct().collect()} == {(8,)}


def test_slots_are_gapless_and_whole(spark, odd):
    found = shard_slots(odd).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_rows())
    for shard in {r.shard for r in found}:
        own = sorted((r for r in found if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        ids = [r.doc_id for r in own if r.doc_id is not None]
        assert ids == sorted(ids) and all(r.doc_id is None for r in own[len(ids) :])
    assert {r.law for r in found} == {"key"}
    assert not shard_slots(odd.limit(0)).count()


def test_a_key_of_most_rows_is_numbered_in_many_ranges(spark):
    rows = written(spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.lit("v").alias("n")), "numbering-test")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = numbered(rows, [F.col("k")], "at", "numbering-test").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found.sort(key=lambda r: r["at"])
    assert [r["at"] for r in found] == list(range(30_000))
    assert [r.k for r in found] == sorted(r.k for r in found)


def test_shards_are_written_whole(spark, odd, tmp_path):
    write_shards(odd.withColumnRenamed("shard", "other"), "doc_id", 3, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == odd.count()
    assert sorted(r.shard for r in back.select("shard").distinct().collect()) == [0, 1, 2]


def plain_draw(docs, target, longest=1, buckets=10_000, percent=10):
    def runs(text):
        w = terms(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = (Counter(bucket(x) for _, text in rows for x in runs(text)) for rows in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        own = runs(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, own))
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(terms(text)) >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    return sorted((str(r[:4]), next((n for n, x in enumerate(drawn, 1) if x is r), None)) for r in rows)


@pytest.mark.parametrize("longest", [1, 3])
def test_draw_equals_the_plain_version(spark, odd, longest, monkeypatch):
    monkeypatch.setattr(resampling, "AT_ONCE", 64)
    target = items_of(spark, ITEMS)
    found = resampled(odd, target, longest=longest).collect()
    want = plain_draw(odd_rows(), ITEMS, longest)
    # Rows that are the same in all columns share their ranks in any way.
    assert sorted((str(list(r)[:4]), r["rank"] is None) for r in found) == sorted((x, n is None) for x, n in want)
    assert sorted(r["rank"] for r in found if r["rank"]) == sorted(n for _, n in want if n)
    drawn = drawn_documents(odd, target, longest=longest)
    assert drawn.columns == odd.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in found if r["rank"] and r.doc_id is not None}


def test_draw_from_and_for_empty_tables(spark, odd):
    target = items_of(spark, ITEMS)
    assert not resampled(odd.limit(0), target).count()
    assert resampled(odd, target.limit(0)).count() == odd.count()


def test_hashes_are_those_of_the_library():
    chance = random.Random(1)
    spans = [bytes(chance.randrange(256) for _ in range(chance.randrange(0, 70))) for _ in range(3000)]
    data = np.frombuffer(b"".join(spans) + b"\0" * 8, np.uint8)
    lengths = np.array([len(s) for s in spans])
    starts = np.cumsum(lengths) - lengths
    assert xxhash64(data, starts, lengths).tolist() == [xxhash.xxh64_intdigest(s) for s in spans]
    a, b = np.array([0, 10]), np.array([0, 1000])
    assert same_bytes(data, a, b, np.array([40, 40])).tolist() == [True, data[10:50].tobytes() == data[1000:1040].tobytes()]


@pytest.mark.parametrize("hashed", [xxhash64, lambda data, starts, lengths: np.zeros(len(starts), np.uint64)])
def test_slots_tell_features_by_their_bytes(hashed):
    words = next(terms_of(pa.array(["b a b c a a aa aaaaaaaaab aaaaaaaaac", "c b aaaaaaaaab"])))
    data, starts, lengths, of = features(words, 1)
    table = Table(32, hashed)
    for _ in range(2):  # a table is used again
        slots = table.intern(data, starts, lengths, 1000)
        own = [bytes(data[a : a + n]) for a, n in zip(starts, lengths, strict=True)]
        assert len(set(slots.tolist())) == len(set(own)) == len({*zip(own, slots.tolist(), strict=True)})
        assert [int(table.counts[s]) for s in slots] == [own.count(x) for x in own]
        assert [int(table.buckets[s]) for s in slots] == [zlib.crc32(x) % 1000 for x in own]
    assert of.tolist() == [0] * 9 + [1] * 3
