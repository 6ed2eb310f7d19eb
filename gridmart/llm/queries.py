"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.chat import format_conversations, read_conversations
from gridmart.llm.html import main_text
from gridmart.llm.jaccard import near_duplicates
from gridmart.llm.lexical import ranked_documents
from gridmart.llm.packing import pack_documents
from gridmart.llm.pieces import encoding_digests
from gridmart.llm.resampling import resampled
from gridmart.llm.rules import judged
from gridmart.llm.sharding import shard_slots
from gridmart.llm.substrings import removal_digests
from gridmart.llm.tables import table
from gridmart.llm.topk import exact_topk
from gridmart.llm.toxicity import THRESHOLD, is_held_out, scored, trained
from gridmart.llm.warc import archived


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are installed, on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(table(spark, sf_dir, "documents"), min_words=50)


def op3_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2, max_tokens=4096)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judged(table(spark, sf_dir, "documents"), columns=["doc_id"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return docs.select("doc_id", *(F.col(f"rules.{x}") for x in names))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=75)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, trained(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return read_conversations(format_conversations(rows))


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return exact_topk(rows, rows.where("pmod(vec_id, 100) = 0"), k=10, scale=1024.0)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_slots(table(spark, sf_dir, "documents"), shards=8)


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc_roundtrip": op3_warc_roundtrip,
    "op4_pack_sequences": op4_pack_sequences,
    "op5_quality_rules": op5_quality_rules,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_chat_format": op8_chat_format,
    "op9_piece_encoding": op9_piece_encoding,
    "op10_exact_topk": op10_exact_topk,
    "op11_lexical_search": op11_lexical_search,
    "op12_jump_shards": op12_jump_shards,
    "op13_target_resampling": op13_target_resampling,
}

#: Base counts of documents, failures of rules by host, and the hosts' shrunk rates, as in gridmart.llm.rules.
RULES_SQL = r"""
    texts as (
        select row_number() over () as r, doc_id, source, coalesce(text, '') as text,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
        from documents
    ), starts as (
        select r, len(words) as n, unnest(range(1, len(words) - 3)) as i, words from texts where len(words) >= 5
    ), windows as (
        select r, n, i, count(*) over (partition by r, array_to_string(words[i:i + 4], ' ')) as c from starts
    ), covered as (
        select r, count(distinct i + k)::bigint as n_repeat_words from windows, range(5) as o(k) where c > 1 group by r
    ), counts as (
        select t.r, doc_id, source, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
            (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, len(lines) as n_lines
        from texts t left join covered using (r)
    ), failures as (
        select *, n_words < 10 as f1, 100 * n_repeat_words > 20 * n_words as f2, 100 * n_symbols > 10 * word_chars as f3, 100 * n_dup_lines > 30 * n_lines as f4
        from counts
    ), rates as (
        select source, rule, count(*) as n, count(*) filter (where f) as x
        from (select source, unnest([1, 2, 3, 4]) as rule, unnest([f1, f2, f3, f4]) as f from failures) group by source, rule
    ), moments as (
        select rule, sum(x) / sum(n) as m, count(*) / sum(n) as k, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) ** 2 as s from rates group by rule
    ), priors as (
        select rule, m, least(greatest(case when s - m * (1 - m) * k > 0 then (m * (1 - m) - s) / (s - m * (1 - m) * k) else 10000.0 end, 1.0), 10000.0) as w
        from moments
    ), hosts as (
        select source, bool_or((x + m * w) / (n + w) > 0.5) as bad from rates join priors using (rule) group by source
    ), judged as (
        select f.*, f1 or f2 as base_failed, not (f1 or f2) and not bad as kept
        from failures f join hosts h on f.source is not distinct from h.source
    )
"""

#: Unsigned CRC-32 of the UTF-8 bytes of a text, byte by byte.
CRC32_SQL = """
    polynomials as (
        select list(c order by i) as cells from (
            select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
            from (select unnest(range(256)) as i)
        )
    ), checked as (
        select content, xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(content)), '..'), lambda h: ('0x' || h)::bigint),
            lambda c, x: xor(c >> 8, cells[(xor(c, x) & 255) + 1])), 4294967295) as crc
        from contents, polynomials
    )
"""

#: Jumps of keys among 8 and 9 shards, one after the other: ``k`` is the sequence's number, ``j`` the shard that it leads to.
NEXT_SQL = "(k * 2862933555777941757 + 1) % 18446744073709551616"
JUMPS_SQL = "".join(
    f""", jump{i + 1} as (
        select doc_id, size, text_crc32, k, b8, b9, case when j < 9 then floor((j + 1) * (2147483648::double / ((k >> 33) + 1)::double))::bigint else j end as j
        from (
            select doc_id, size, text_crc32, case when j < 9 then {NEXT_SQL} else k end as k, case when j < 8 then j else b8 end as b8,
                case when j < 9 then j else b9 end as b9, j
            from jump{i}
        )
    )"""
    for i in range(10)
)

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
        with texts as (
            select row_number() over () as r, doc_id,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
            from documents
        ), starts as (
            select r, doc_id, words, unnest(range(1, len(words) - 48)) as i from texts where len(words) >= 50
        ), windows as (
            select r, doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) as w from starts
        ), repeated as (
            select r, i from (select *, min(doc_id) over (partition by w) as origin from windows) where doc_id > origin
        ), gone as (
            select distinct r, i + k as i from repeated, range(50) as o(k)
        ), removed as (
            select r, list(i) as gone, count(*) as n from gone group by r
        )
        select doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
            sha256(array_to_string(case when n is null then words else
                list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: not list_contains(gone, x[2])), lambda x: x[1]) end, ' ')) as kept_sha256
        from texts left join removed using (r)
    """,
    "op5_quality_rules": f"with {RULES_SQL} "
    "select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from judged",
    "op6_jaccard_join": r"""
        with recursive texts as (
            select row_number() over () as r, doc_id,
                list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
            from documents
        ), shingles as (
            select distinct doc_id, array_to_string(words[i:i + 4], ' ') as s
            from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from texts where len(words) > 0)
        ), sizes as (
            select doc_id, count(*) as n from shingles group by doc_id
        ), links as (
            select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
            join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
            group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))
        ), reach as (
            select a as node, a as seen from links union select node, b from reach join links on seen = a
        ), labels as (
            select node, min(seen) as label from reach group by node
        )
        select t.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(label, t.doc_id) as component_id
        from texts t left join sizes s on s.doc_id = t.doc_id left join labels l on l.node = t.doc_id
    """,
    "op8_chat_format": r"""
        with rows as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
            coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
            sum(15 + length(regexp_replace(role, '[\\<#:\n]', '__', 'g')) + length(regexp_replace(text, '[\\<#]', '__', 'g')))::bigint as formatted_chars
        from rows group by conv_id
    """,
    "op10_exact_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
            where vec_id is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
            from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
            where q.vec_id % 100 = 0
        )
        select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
        from s qualify rank <= 10
    """,
    "op11_lexical_search": r"""
        with found as (
            select row_number() over () as r, doc_id,
                regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
            from documents where text is not null
        ), totals as (
            select count(*) as n_docs, sum(len(terms))::bigint as length from found where len(terms) > 0
        ), times as (
            select r, term, count(*) as tf from (select r, unnest(terms) as term from found) group by r, term
        ), weights as (
            select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w from times, totals group by term, n_docs
        ), wanted as (
            select item_id, term, count(*) as repeats from (
                select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                from (select distinct item_id, text from benchmark)
            ) group by item_id, term
        ), sizes as (
            select r, doc_id, 75 + (25 * len(terms) * n_docs) // length as m from found, totals where len(terms) > 0
        ), scores as (
            select item_id, r, any_value(doc_id) as doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
            from wanted join times using (term) join weights using (term) join sizes using (r) group by item_id, r
        )
        select item_id, (row_number() over (partition by item_id order by score desc, doc_id, r))::int as rank, doc_id, score
        from scores where score > 0 qualify rank <= 20
    """,
    "op12_jump_shards": f"""
        with contents as (
            select distinct coalesce(text, '') as content from documents
        ), {CRC32_SQL}, jump0 as (
            select doc_id, strlen(content) + 1 as size, crc as text_crc32, ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 16))::ubigint::hugeint as k,
                0::bigint as b8, 0::bigint as b9, 0::bigint as j
            from documents join checked on content = coalesce(text, '')
        ) {JUMPS_SQL}
        select doc_id, size, text_crc32, 'key' as law, b8::int as shard,
            row_number() over (partition by b8 order by doc_id nulls last, size, text_crc32) - 1 as slot, b9::int as grown_shard
        from jump10
    """,
    "op13_target_resampling": rf"""
        with docs as (
            select row_number() over () as r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from documents
        ), wanted as (
            select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as content
            from benchmark
        ), held as (
            select r, content, count(*) as n from (select r, unnest(words) as content from docs) group by r, content
        ), contents as (
            select content from held union select content from wanted
        ), {CRC32_SQL}, source as (
            select crc % 10000 as bucket, sum(n) as s from held join checked using (content) group by bucket
        ), target as (
            select crc % 10000 as bucket, count(*) as t from wanted join checked using (content) group by bucket
        ), totals as (
            select (select coalesce(sum(s), 0) from source) + 10000 as all_s, (select coalesce(sum(t), 0) from target) + 10000 as all_t
        ), gains as (
            select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * all_s::double / ((s + 1)::double * all_t::double)))::bigint as gain
            from source left join target using (bucket), totals
        ), weights as (
            select r, sum(n * gain)::bigint as weight from held join checked using (content) join gains on bucket = crc % 10000 group by r
        ), scores as (
            select r, doc_id, len(words) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
                (('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
            from docs left join weights using (r)
        ), places as (
            select r, row_number() over (order by score desc, doc_id nulls last, r) as place, count(*) over () as n from scores where n_features >= 20
        )
        select doc_id, n_features, weight, score, case when place <= (10 * n) // 100 then place end as rank from scores left join places using (r)
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
