"""Operators on pages, conversations and embeddings against plain versions, and on odd tables."""

import base64
import hashlib
import math
import random
from hashlib import sha256

import pytest
from gridmart.llm.chat import TemplateError, compile_template, escape, fold, format_conversations, parse, read_conversations, unescape
from gridmart.llm.html import extract, main_text, votes, winning_paths
from gridmart.llm.topk import exact_topk
from gridmart.llm.warc import archived, parse_archive, payload_of, read_archives, write_archives

PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><script>var a='</p>'</script></head><body><nav><ul><li><a href=x>menu</a></ul></nav>"
    "<div class='ad'>buy now</div><article class='post-{n}'><h1>Head &amp; line</h1><p><b>First  block,<br>still\nfirst<p>Second one is longer than that.</p>"
    "<div class='comments'><p>a reader says much more than anybody else here, really a lot of words</p></div></article>"
    "<aside>side</aside><form><p>mail</p></form><footer>&copy; all</footer>"
)


def test_article_without_the_rest(spark):
    text = "Head & line\nFirst block, still first\nSecond one is longer than that."
    rows = [(i, f"http://h.example/{i}", PAGE.replace("{n}", str(i))) for i in range(6)]
    rows += [(6, None, None), (7, "http://h.example/7", ""), (8, "nothing", "<p>only &am"), (9, "http://h.example/9", "plain &lt; text"), (10, "http://h.example/x", "<art")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    found = {r.page_id: r for r in main_text(pages).collect()}
    assert [found[i].text for i in range(6)] == [text] * 6
    assert [found[i].text for i in (6, 7, 8, 9, 10)] == ["", "", "only &am", "plain < text", ""]
    assert all(r.n_chars == len(r.text) for r in found.values())
    assert dict(winning_paths(pages).collect())["h.example"] == "html/body/article.post-"
    assert main_text(pages.limit(0)).count() == 0
    assert extract("<div>" * 3000 + "deep", None) == "deep"


def test_article_in_several_containers(spark):
    parts = [" ".join(f"{w}{n}" for w in "one two three four five six seven eight".split()) for n in ("first", "second", "third")]
    first, second, third = parts
    split = f"<div class=content><div class=part><p>{first} {third}</p></div><div class=ad><p>buy</p></div><div class='part w-1/2x'></div><div class=part><p>{second}</p></div></div>"
    pages = [(i, f"http://p.example/{i}", f"<body>{split}</body>") for i in range(3)]
    pages += [(10, "http://a.example/1", f"<body><main><article><p>{first}</p></article><article><p>{second}</p><p>{third}</p></article></main></body>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in main_text(frame).collect()}
    assert [found[i] for i in range(3)] == [f"{first} {third}\n{second}"] * 3
    assert found[10] == "\n".join(parts)
    # The page's own best containers, and a class with a slash.
    assert extract(f"<body>{split}</body>", "html/body/none") == extract(f"<body>{split}</body>", None) == f"{first} {third}\n{second}"
    assert extract(f"<body><div class=w-1/2><p>{first}</p></div><div class=w-1/2><p>{second}</p></div></body>", "body/div.w-/") == f"{first}\n{second}"
    # All scored containers of a page vote.
    assert len(votes("<body>" + "".join(f"<div class={c}><p>{first}</p></div>" for c in "abcdefg") + "</body>")) == 8


def test_archives_give_back_what_was_written(spark, tmp_path):
    chance = random.Random(2)
    texts = ["".join(chance.choice("aé\r\n<🙂WARC/1.1 ") for _ in range(chance.choice([0, 5, 40_000, 90_000]))) for _ in range(30)]
    rows = [(i, f"http://x/{i}\r\nA: b" if i % 3 else None, t) for i, t in enumerate(texts)]
    rows += [(100 + i, "u", t) for i, t in enumerate(texts[:10])] + [(200, "u", None), (None, "u", "no id"), (5, rows[5][1], rows[5][2])]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, sha1 int")
    largest = {}
    for i, _, t in rows:
        largest[t or ""] = max(largest.get(t or "", -1), -1 if i is None else i)
    expected = []
    for i, _, t in rows:
        data, best = (t or "").encode(), largest[t or ""]
        again = best >= 0 and i != best
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", best if again else None))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archived(pages).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert archived(pages.limit(0)).count() == 0
    write_archives(pages, str(tmp_path / "w"), segment_bytes=100, chunk_bytes=7)
    again = read_archives(spark, str(tmp_path / "w"))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest) for r in again.collect()], key=str) == sorted([x[:3] for x in expected], key=str)


def test_broken_archives_are_told():
    with pytest.raises(ValueError):
        list(parse_archive(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    assert payload_of(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabcd\r\n0\r\n\r\n") is None
    assert payload_of(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"


def test_template_language():
    def shown(template, **scope):
        return "".join(t for t, _ in compile_template(template)([scope]))

    assert shown("{% for m in messages %}{{ m.a | upper }}{% if m.a == 'x' and not m.b %}1{% elif m.b %}2{% else %}3{% endif %}{% endfor %}", a="x") == "X1"
    assert fold(parse("a{{ 'b' + 'c' }}{# no #}{% if 'q' == 'q' %}d{% else %}e{% endif %}")) == [("text", "abcd")]
    assert shown("{% for m in messages %}{{ m.__class__ }}{{ m.a.__class__ }}{% endfor %}", a="x") == ""
    for wrong in ("{% for x %}", "{% if a %}", "{{ a | none }}", "{% endif %}", "{{ a( }}", "{% do x %}"):
        with pytest.raises(TemplateError):
            compile_template(wrong)
    text = r"\### Assistant: </turn> ok \\ \< #"
    assert unescape(escape(text)) == text


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", "hi </turn>\n### a:\n"), (1, 1, "assistant", r"\### x \ "), (1, None, None, None), (2, 0, "we:\nird\\", "\n</turn>\n")]
    rows += [(None, 0, "assistant", "x"), (3, 0, "assistant", ""), (3, 0, "assistant", "b"), (3, 0, "assistant", "b")]
    rows += [(7, i, "assistant" if i % 2 else "user", "long " * (i % 90)) for i in range(3000)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, piece int")
    found = {r.conv_id: r for r in read_conversations(format_conversations(frame)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted([(-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        learnt = "".join(t for _, role, t in own if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.loss_chars) == (len(own), len(learnt))
        assert r.turns_sha256 == sha256("".join(f"{role}\n{t}\n" for _, role, t in own).encode()).hexdigest()
        assert r.loss_sha256 == sha256(learnt.encode()).hexdigest()
    assert format_conversations(frame.limit(0)).count() == 0


def test_topk_matches_all_scores(spark):
    chance = random.Random(4)
    rows = [(i, [chance.uniform(-1, 1) for _ in range(7)], 0) for i in range(0, 900, 3)]
    rows += [(i, rows[0][1], 0) for i in range(1, 60, 3)] + [(5, None, 0), (8, [1.0, None] * 4, 0), (11, [float("nan")] * 7, 0), (14, [1.0], 0), (None, rows[0][1], 0)]
    rows.append(rows[3])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block int")
    asked = frame.where("pmod(vec_id, 100) = 0")
    vectors = [(r.vec_id, [math.floor(1024 * x) for x in r.embedding]) for r in frame.collect() if r.vec_id is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
    expected = []
    for q, v in vectors:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q and len(w) == len(v))
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    for sizes in ({}, {"block_rows": 50, "query_rows": 2, "slices": 3}):
        assert sorted(map(tuple, exact_topk(frame, asked, **sizes).collect())) == sorted(expected)
    assert exact_topk(frame.limit(0), asked.limit(0)).count() == 0


def planted_pages(seed=8):
    """Pages of several hosts with a known main text each."""
    chance, rows = random.Random(seed), []
    word = lambda: "".join(chance.choice("aeiounrstlé") for _ in range(chance.randint(1, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    shells = [
        ("<div class='wrap has-sidebar'><article>", "</article></div>"),
        ("<article class='post tag-legal category-social'>", "</article>"),
        ("<div class='page-header-fixed'><div class=content>", "</div></div>"),
        ("<main id=top><section class='story'>", "</section></main>"),
        ("<div class=body><div class='part'>", "</div></div>"),
    ]
    for i in range(60):
        before, after = shells[i % len(shells)]
        blocks = [line(chance.randint(12, 60)) for _ in range(chance.randint(2, 6))]
        shown = "".join(
            f"<p>{b[: len(b) // 2]}<button>buy <b>now</b></button>{b[len(b) // 2 :]}</p><!-->" if chance.random() < 0.3 else f"<p>\n {b.replace(' ', '  ')}</p><!-- > -->"
            for b in blocks
        )
        noise = f"<nav><a href=/>{line(3)}</a></nav><div class=sidebar><p>{line(6)}</p></div><script>var a='</p>';</script>"
        readers = f"<div id=comments><article class=comment><p>{line(200)}</p></article></div>"
        rows.append((i, f"https://h{i % len(shells)}.example/{i}", f"<html><body>{noise}{before}{shown}{after}{readers}<footer>{line(9)}</footer>", "\n".join(blocks)))
    return rows


def test_planted_main_texts(spark):
    rows = planted_pages()
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    found = {r.page_id: r.text for r in main_text(pages).collect()}
    assert found == {r[0]: r[3] for r in rows}
