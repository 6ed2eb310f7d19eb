"""Operators on documents against plain versions, and on odd tables."""

import random
import zlib
from hashlib import sha256
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from gridmart.llm.jaccard import near_duplicates, one_of_each
from gridmart.llm.packing import pack, pack_documents
from gridmart.llm.pieces import PieceCoder, encode_documents, encoding_digests
from gridmart.llm.queries import op7_toxicity, tokenizer_path
from gridmart.llm.rules import beta_prior, judged, well_formed
from gridmart.llm.substrings import removal_digests, without_repeats
from gridmart.llm.toxicity import fit, not_toxic, scored, trained
from gridmart.session import scratch_root

ODD = "doc_id long, text string, lang string, source string, n_chars long, rules string, id long, label int"
WORDS = [f"w{i}" for i in range(50)]


def made(seed=3, groups=25):
    chance, rows = random.Random(seed), []
    for _ in range(groups):
        base = [chance.choice(WORDS) for _ in range(chance.randint(1, 160))]
        for _ in range(chance.randint(1, 5)):
            own = list(base)
            for _ in range(chance.randint(0, 3)):
                own[chance.randrange(len(own))] = chance.choice(WORDS)
            rows.append((len(rows) + 10, " ".join(own)))
    chance.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    texts = [None, "", " \n\t", "one", "A b c d e", "a B c d e", long, long, "ﬁ ́x é漢字🙂\x00 ▁a", "same line\nsame line\n" * 40]
    rows = [(i, t, "en", None if i % 2 else "h", len(t or ""), "r", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3], rows[6], (None, "no id here", None, None, None, None, None, None)], ODD)


def lowered(text):
    return text.encode().lower().split()  # bytes: A-Z only


def shingles(text):
    w = lowered(text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_components_match_all_pairs(spark):
    rows = made()
    sets, parent = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    expected = sorted((d, len(s), root(d)) for d, s in sets.items())
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == expected
    assert any(d != c for d, _, c in expected)


def removed(rows, size=50):
    first, out = {}, []
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for s in range(len(w) - size + 1):
            key = tuple(w[s : s + size])
            first[key] = min(first.get(key, d), d)
    for d, w in split:
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < d:
                gone.update(range(s, s + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), sha256(kept).hexdigest()))
    return sorted(out)


def test_removed_words_match_all_windows(spark):
    rows = made(5, 30)
    rows.append((1, "x " * 70))
    rows.append((2, "x " * 120 + rows[0][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = removed(rows)
    assert sorted(map(tuple, removal_digests(docs).collect())) == expected
    assert sum(x[2] for x in expected) > 0
    kept = {r.doc_id: r.text.encode().split() for r in without_repeats(docs).collect()}
    assert sorted((d, sha256(b" ".join(w)).hexdigest()) for d, w in kept.items()) == sorted((x[0], x[3]) for x in expected)


def test_pieces_match_the_library(spark):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), PieceCoder(path)
    chance = random.Random(1)
    texts = ["".join(chance.choice("ab ▁\né漢t he in  on <s>🙂") for _ in range(chance.randint(0, 40))) for _ in range(2000)]
    for text in texts:
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids)
    rows = spark.createDataFrame(list(enumerate(texts[:200])), "doc_id long, text string")
    digest = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoding_digests(rows, path).collect()}
    for r in encode_documents(rows, path).collect():
        ids = ",".join(map(str, r.ids))
        assert digest[r.doc_id] == (len(r.ids), sha256(ids.encode()).hexdigest(), sha256(r.decoded.encode()).hexdigest())


def test_pieces_fill_sequences(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [*made(7, 40), (1, None), (2, "It's ÀÉ ×÷ <|x|> İ a1b22 '''s"), (3, "word " * 9000)]
    chance = random.Random(12)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", " ", " ", "\n", "Ab", "é", "e\u0301", "\u00a0", "'s", "7", "漢", "!"]
    rows += [(100_000 + i, "".join(chance.choice(bits) for _ in range(chance.randint(0, 12)))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = pack_documents(docs, path).collect()
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in rows}
    at = dict.fromkeys(ids, 0)
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == at[p.doc_id] and p.doc_tokens == len(ids[p.doc_id])
        at[p.doc_id] += p.length
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())
    assert at == {d: len(x) for d, x in ids.items()}
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    padding = sum(4096 - x for x in filled.values() if x & (x - 1))
    assert max(filled.values()) <= 4096 and padding < 0.02 * sum(filled.values())


def test_all_limits_hold():
    chance = np.random.default_rng(2)
    tokens = chance.integers(1, 900, 400)
    loss = np.minimum(chance.integers(0, 600, 400), tokens)
    placed = np.zeros(400, int)
    for own in pack(tokens, loss, 512, 4, 300, 16):
        assert sum(n for _, _, n in own) <= 512 and len(own) <= 4
        assert sum(max(0, s + n - max(s, tokens[e] - loss[e])) for e, s, n in own) <= 300
        for e, s, n in own:
            placed[e] += n
    assert (placed == tokens).all()


def test_prior_shrinks():
    assert beta_prior(0, 0, 0, 0.0) == (0.0, 1.0)
    mean, weight = beta_prior(2000, 20, 200, 20.0)  # every host at one tenth
    assert mean == pytest.approx(0.1) and weight == 10_000
    assert beta_prior(200, 2, 100, 100.0)[1] == 1.0  # one host fails wholly, one never


def test_bad_host_loses_good_documents(spark):
    good, bad = " ".join(f"v{i}" for i in range(40)), "few words"
    rows = [(i, good if i % 20 == 0 else bad, "bad") for i in range(100)] + [(i, good, f"h{i % 5}") for i in range(100, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in well_formed(docs).collect()}
    assert kept == set(range(100, 300))


def chained(seed, groups, length):
    """Groups of texts that drift away from each other word by word, so that many pairs lie near the bound."""
    chance, rows = random.Random(seed), []
    for g in range(groups):
        own = [f"g{g % (groups // 2)}w{i}" for i in range(length)] if g % 3 else [chance.choice(WORDS) for _ in range(length)]
        for _ in range(chance.randint(3, 14)):
            own = list(own)
            for _ in range(chance.randint(0, 3)):
                own[chance.randrange(length)] = f"x{chance.randrange(900)}"
            rows.append((len(rows) * 3 + 1, " ".join(own)))
    return rows + [(rows[5][0], rows[40][1]), (rows[6][0], "another text of the same id")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_drifting_groups(spark, seed, monkeypatch):
    from gridmart.llm import jaccard

    monkeypatch.setattr(jaccard, "LIST_ROWS", 400)  # several parts
    rows = chained(seed, 12, 90)
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if 100 * len(x & y) >= 75 * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()} == {(d, root(d)) for d, _ in rows}


@pytest.mark.parametrize("block", [2, 7, 64])
def test_blocks_that_are_skipped_have_no_link(block):
    from gridmart.llm.jaccard import candidates

    chance = np.random.default_rng(block)
    sets, labels = {}, {}
    for i in range(220):
        base = np.arange(i % 20 * 40, i % 20 * 40 + chance.integers(8, 60))
        sets[i] = set(chance.choice(base, chance.integers(5, len(base) + 1), replace=False).tolist()) if i % 11 else set(range(30))
        labels[i] = i // 4
    rows = []
    for i, own in sets.items():
        ordered = sorted(own, key=lambda x: -x)
        for at, shingle in enumerate(ordered[: len(own) - -(-75 * len(own) // 100) + 1]):
            rows.append((shingle, i, labels[i], len(own), at))
    columns = [np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int64, np.int32, np.int32))]
    skipped = {}
    found = {(int(a), int(b)) for x, y in candidates(columns, 75, block, skipped) for a, b in zip(x, y)}
    want = {(a, b) for a in sets for b in sets if a < b and labels[a] != labels[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert want and want <= found and all(labels[a] != labels[b] for a, b in found)
    assert skipped["skipped"] > 0
    assert list(candidates([c[:0] for c in columns], 75)) == []


def toxic_texts(n=500, seed=1):
    chance, texts, labels = random.Random(seed), [], []
    for i in range(n):
        words = ["".join(chance.choice("aeiounrst") for _ in range(chance.randint(2, 8))) for _ in range(chance.randint(0, 120))]
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            words[chance.randint(0, len(words)) : 0] = ["vil" + chance.choice(["ko", "kam", "kett", "ky"]), "grub"]
        texts.append(" ".join(words))
    return texts, np.array(labels)


def test_held_out_accuracy():
    import pyarrow as pa
    from gridmart.llm.words import words_of

    texts, labels = toxic_texts()
    model = fit(texts, labels)
    others, expected = toxic_texts(300, 9)
    scores = np.concatenate([model.scores(w) for w in words_of(pa.array([*others, None, ""]))])
    assert ((scores[:300] >= 0.7) == expected).mean() > 0.97
    assert scores.min() >= 0 and scores.max() <= 1 and len(scores) == 302
    assert fit([], np.zeros(0)).constant == 0.0 and fit(["a"], np.ones(1)).constant == 1.0


def test_odds_come_from_all_labelled_rows(spark, monkeypatch):
    import pyarrow as pa
    from gridmart.llm import toxicity
    from gridmart.llm.words import words_of

    texts, toxic = toxic_texts(300, 3)
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, texts[i]) for i in range(0, 300, 7)] + [(1000 + i, None) for i in range(50)]
    docs = spark.createDataFrame([*rows, (2000, "far " * 4000), (None, "no id")], "doc_id long, text string").repartition(5)
    marks = [(i, int(y)) for i, y in enumerate(toxic)] + [(1000 + i, 1) for i in range(50)] + [(2000, 0), (3000, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    free = [i for i in [*range(300), 2000] if zlib.crc32(str(i).encode()) % 3 != 1]
    plain = toxicity.Counts()
    for i in free:
        for words in words_of(pa.array([texts[i] if i < 300 else "far " * 4000])):
            plain.add(words, np.array([toxic[i] if i < 300 else 0]))
    texts_only = docs.withColumn("hash", F.xxhash64("text")).where("text is not null").withColumnRenamed("doc_id", "id")
    whole = toxicity.trained(docs, labels)
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 20)
    monkeypatch.setattr(toxicity, "MAX_OTHER", 40)
    keys = toxicity.known_rows(texts_only, labels)
    # Rows without a text and repeated rows take no place in the sample, and a smaller sample changes no odds.
    assert keys.ids.tolist() == free and keys.sampled.sum() == 60 and keys.toxic[keys.sampled].sum() == 20
    assert keys.copies.tolist() == [2 if i < 300 and i % 7 == 0 else 1 for i in free]
    few = toxicity.trained(docs, labels)
    for model in (whole, few):
        for found, c in zip([model.word_odds, *model.gram_odds], plain.kinds, strict=True):
            assert np.allclose(found, toxicity.odds(c[1], c[0], *plain.words[::-1]))
    assert any((a != b).any() for a, b in zip(whole.network.p.values(), few.network.p.values(), strict=True))
    # Beyond the bound a share of the rows by the hash of their ids is counted.
    monkeypatch.setattr(toxicity, "MAX_COUNTED", 80)
    some = toxicity.known_rows(texts_only, labels)
    assert 50 < len(some.ids) < 110 and set(some.ids) < set(free)


def test_query_of_toxicity(spark):
    sample = "/root/testdata/sf0.001"
    found = op7_toxicity(spark, sample).collect()
    docs = spark.read.parquet(f"{sample}/documents.parquet").collect()
    assert sorted(r.doc_id for r in found) == sorted(d.doc_id for d in docs)
    by_text = {}
    texts = {d.doc_id: d.text for d in docs}
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
        assert by_text.setdefault(texts[r.doc_id], r.score) == r.score  # nothing but the text counts
    # Labels of held-out rows and other columns change nothing.
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = spark.read.parquet(f"{sample}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    rows = spark.read.parquet(f"{sample}/documents.parquet").withColumn("lang", F.lit("xx"))
    again = {r.doc_id: r.score for r in scored(rows, trained(rows, turned)).collect()}
    assert again == {r.doc_id: r.score for r in found}


def test_counts_of_words_and_runs():
    """Each distinct word of a text counts once, and each of its runs as often as distinct words have it."""
    import pyarrow as pa
    from gridmart.llm import toxicity
    from gridmart.llm.words import words_of

    texts, label = ["abcde abcde xabcd", "abcde", None, "zz"], np.array([1, 0, 1, 0])
    counts = toxicity.Counts()
    for words in words_of(pa.array(texts)):
        counts.add(words, label, np.array([0.5, 1, 1, 1]))
    assert counts.words.tolist() == [2, 1]
    own = toxicity.vocabulary(next(words_of(pa.array(["abcde xabcd"]))))
    for kind, cells, bounds in zip(counts.kinds[1:], own.grams, own.begin, strict=True):
        for i, word in enumerate(np.split(cells, bounds[1:])):
            for run in word:
                mine = sum(int(run in w) for w in np.split(cells, bounds[1:]))
                assert kind[1, run] == mine / 2
    assert counts.kinds[0].sum(axis=1).tolist() == [2, 1]


def test_every_window_is_scored():
    from gridmart.llm.toxicity import INPUTS, WINDOW, Network, highest

    chance, net = np.random.default_rng(6), Network()
    features = chance.standard_normal((40, INPUTS)).astype(np.float32)
    lengths = [0, 1, WINDOW - 1, WINDOW, WINDOW + 1, 200]
    texts = [chance.integers(0, 40, n) for n in lengths]
    text, logit = highest(net, features, np.concatenate(texts), np.array(lengths), at_once=50)
    assert np.bincount(text).tolist() == [1, 1, 1, 1, 2, 200 - WINDOW + 1]
    at = 0
    for words in texts:
        for s in range(max(1, len(words) - WINDOW + 1)):
            own = words[s : s + WINDOW]
            place = np.append(own, 0)[: max(1, len(own))][:, None]
            alone = net.forward(features, place, np.full(place.shape, len(own) > 0))
            assert logit[at] == pytest.approx(alone[0], abs=1e-4)
            at += 1
    # What stands before a passage does not change its score.
    passage = chance.integers(1, 40, 10)
    blank = lambda n: np.zeros(n, int)
    tops = [highest(net, features, w, np.array([len(w)]))[1].max() for k in range(WINDOW, 2 * WINDOW) for w in [np.concatenate((blank(k), passage, blank(WINDOW)))]]
    assert np.ptp(tops) < 1e-4


def test_gradients_match_differences():
    from gridmart.llm.toxicity import INPUTS, Network, steps

    chance, net = np.random.default_rng(0), Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    table = chance.standard_normal((9, INPUTS))
    table[-1] = 0
    place, alive = steps(np.arange(9), np.array([0, 3, 8]), np.array([4, 5, 0]))
    target = np.array([1.0, 0.0, 1.0])
    found = net.gradients(table, place, alive, target, np.ones(3))

    def loss():
        z = net.forward(table, place, alive)
        return np.mean(np.logaddexp(0, z) - target * z)

    for k, v in net.p.items():
        at = np.unravel_index(v.size // 2, v.shape)
        v[at] += 1e-3
        up = loss()
        v[at] -= 2e-3
        assert found[k][at] == pytest.approx((up - loss()) / 2e-3, abs=2e-3)
        v[at] += 1e-3


def test_odd_documents(spark, odd):
    labels = spark.createDataFrame([(0, 0, 1), (4, 1, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        assert near_duplicates(docs).count() == n
        assert removal_digests(docs).count() == n
        assert judged(docs).count() == n
        assert encoding_digests(docs, tokenizer_path("piece_bpe_32k.model")).count() == n
        assert pack_documents(docs, tokenizer_path("word_bpe_49k.json")).where("start = 0").count() == n
        assert scored(docs, trained(docs, labels)).count() == n
        for stage in (lambda d: not_toxic(d, labels), well_formed, one_of_each, without_repeats):
            assert stage(docs).columns == docs.columns
            assert stage(docs).count() <= n
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(odd).collect()}
    assert {(0, 0, 0), (1, 0, 1), (3, 1, 3), (4, 1, 4), (5, 1, 4)} <= rows
    assert (7, 29_996, 6) in rows
    gone = {r.doc_id: (r.n_words, r.n_removed) for r in removal_digests(odd).collect()}
    assert gone[6] == (30_000, 0) and gone[7] == (30_000, 30_000) and gone[0] == (0, 0) and gone[None] == (3, 0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_move_once_at_all_sizes(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A B C D E F G"), (3, "h i j k l m n"), (3, "o p q r s t u"), (None, "a b c d e f g"), (None, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = one_of_each(docs)
    # The one join that moves all documents, and one with the few ids that repeat.
    assert plan_of(kept).count("SortMergeJoin") == 1 and plan_of(kept).count("BroadcastHashJoin") == 1
    found = sorted(map(tuple, kept.collect()), key=str)
    assert [x[0] for x in found] == [1, 3, None, None]
    assert found[0] == (1, "a b c d e f g") and found[1][1] in ("h i j k l m n", "o p q r s t u")
    assert {x[1] for x in found[2:]} == {"a b c d e f g", "v"}
    words = " ".join(WORDS) + " " + " ".join(reversed(WORDS))
    docs = spark.createDataFrame([(1, words), (2, "x " + words), (3, "y")], "doc_id long, text string")
    found = without_repeats(docs)
    assert "SortMergeJoin" in plan_of(found) and "BroadcastHashJoin" not in plan_of(found)
    assert sorted(map(tuple, found.collect())) == [(1, words), (2, "x "), (3, "y")]


def test_small_tables_have_few_files(spark):
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    root = Path(scratch_root(spark))
    there = set(root.glob("*"))
    before = {x: spark.conf.get(x, None) for x in settings}
    try:
        for x, y in settings.items():
            spark.conf.set(x, y)
        chance = random.Random(5)
        rows = [(i, " ".join(chance.choice(WORDS) for _ in range(30))) for i in range(200)]
        docs = spark.createDataFrame([*rows, *((i + 1000, text + " end") for i, text in rows)], "doc_id long, text string")
        found = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
        assert found == {i: i % 1000 for i in found} and len(found) == 400
        files = {x.name: len(list(x.glob("part-*"))) for x in set(root.glob("*")) - there if "-exact-" not in x.name}
        assert len(files) > 20 and max(files.values()) <= 2 * spark.sparkContext.defaultParallelism
    finally:
        for x, y in before.items():
            spark.conf.unset(x) if y is None else spark.conf.set(x, y)
