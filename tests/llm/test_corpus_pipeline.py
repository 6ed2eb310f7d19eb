"""The pipeline against plain versions of its stages, and stage by stage on the smallest sample and on odd rows."""

import random
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from corpus_pipeline import STAGES, run
from gridmart.llm.queries import RULES_SQL, tokenizer_path
from gridmart.llm.tables import written
from gridmart.llm.toxicity import trained
from gridmart.llm.words import words_of

SAMPLE = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return text.encode().lower().split()


def shingles(text):
    w = lowered(text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def planted(seed=2):
    """Documents with toxic ones, rule breakers on a bad host, near copies and passages that several have; and their labels."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choice("aeiounrstl") for _ in range(chance.randint(2, 8)))
    passage = " ".join(word() for _ in range(70))
    rows, labels = [], []
    for i in range(240):
        words = [word() for _ in range(chance.randint(20, 160))]
        toxic, source = i % 6 == 0, f"h{i % 5}"
        if toxic:
            at = chance.randint(0, len(words))
            words[at:at] = ["vil" + chance.choice(["ko", "kam", "kett", "ky"]), "grubba"]
        elif i % 12 == 1:
            words[5:5] = passage.split()
        elif i % 12 == 2:  # a near copy of the next one
            words = words[:100]
        text = " ".join(words)
        if i % 12 == 4:
            source, text = "bad", "#$%& " * 40 + text if i % 24 == 4 else ("same line\n" * 12 + text)
        rows.append((i, text, "en", source, len(text)))
        labels.append((i, 0, int(toxic)))
    for i, text, *rest in [r for r in rows if r[0] % 12 == 2]:
        words = text.split()
        words[chance.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words), *rest))
        rows.append((2000 + i, text.upper(), *rest))
    rows += [(5000, None, "en", "h1", None), (5001, "", None, None, 0), (5002, "few words", "en", "h1", 9)]
    chance.shuffle(rows)
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("planted")
    rows, labels = planted()
    spark.createDataFrame(rows, DOCUMENTS).coalesce(2).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def plain_run(spark, folder):
    """What is left of each document at the end: its id and words."""
    rows, _ = planted()
    # 1. The network alone is the operator's; every text goes through it by itself.
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    model = trained(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    score = lambda text: model.scores(next(words_of(pa.array([text], pa.string()))))[0]
    rows = [r for r in rows if score(r[1]) < 0.7]
    # 2. The rules' SQL.
    duck = duckdb.connect()
    duck.register("documents", pa.table({n: [r[i] for r in rows] for i, n in enumerate(("doc_id", "text", "lang", "source", "n_chars"))}))
    kept = {x for (x,) in duck.execute(f"with {RULES_SQL} select doc_id from judged where kept").fetchall()}
    rows = [r for r in rows if r[0] in kept]
    # 3. All pairs.
    sets, parent = {r[0]: shingles(r[1]) for r in rows}, {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    rows = [r for r in rows if root(r[0]) == r[0]]
    # 4. All windows.
    first, split = {}, {r[0]: (r[1] or "").split() for r in rows}
    for d, w in split.items():
        for s in range(len(w) - 49):
            first[tuple(w[s : s + 50])] = min(first.get(tuple(w[s : s + 50]), d), d)
    left = {}
    for d, w in split.items():
        gone = {i for s in range(len(w) - 49) if first[tuple(w[s : s + 50])] < d for i in range(s, s + 50)}
        left[d] = [x for i, x in enumerate(w) if i not in gone]
    return left, {d: len(split[d]) - len(left[d]) for d in left}


def test_run_equals_the_plain_stages(spark, folder):
    from tokenizers import Tokenizer

    left, removed = plain_run(spark, folder)
    assert 60 < len(left) < 200 and sum(n >= 70 for n in removed.values()) > 3
    assert not {d for d in left if d % 6 == 0 and d < 240} and not {d for d in left if 2000 <= d < 5000}  # toxic ones and copies are gone
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = {d: [*library.encode(" ".join(w), add_special_tokens=False).ids, 2] for d, w in left.items()}
    pieces = run(spark, folder).collect()
    assert {p.doc_id for p in pieces} == set(ids)
    at, filled = dict.fromkeys(ids, 0), {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        own = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4")
        assert p.start == at[p.doc_id] and p.ids_crc32 == zlib.crc32(own.tobytes())
        at[p.doc_id] += p.length
    assert at == {d: len(x) for d, x in ids.items()}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert max(filled.values()) <= 4096


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, SAMPLE), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    pieces = STAGES[-1][1](spark, docs, SAMPLE)
    assert pieces.where("start = 0").count() == before
    empty = spark.read.parquet(f"{SAMPLE}/documents.parquet").limit(0)
    for _, stage in STAGES:
        assert stage(spark, empty, SAMPLE).count() == 0


def test_odd_rows_pass_the_stages(spark):
    """Nulls in all columns, repeated rows, equal ids, very long texts and columns with names of the operators."""
    long = " ".join(f"x{i}" for i in range(20_000))
    rows = [(None, None, None, None, None), (1, long, "en", "a", 1), (1, long, "en", "a", 1), (2, "", "en", None, 0), (2, "y " * 30, "en", "a", 2)]
    rows += [(10 + i, f"word{i} and some more words that stand here once number {i} of all", "en", "a", 3) for i in range(30)]
    docs = spark.createDataFrame([(*r, 1, "x", 2, 0.5) for r in rows], DOCUMENTS + ", label int, id string, size int, score double")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, SAMPLE), name)
        assert len(docs.columns) == 9
    kept = {r.doc_id for r in docs.collect()}
    assert set(range(10, 40)) <= kept and 1 in kept
    assert docs.where("doc_id = 1").count() == 1
    assert STAGES[-1][1](spark, docs, SAMPLE).where("start = 0").count() == docs.count()
