"""The registered queries of this subpackage and the SQL they must agree with, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import ann, bpe, chat, langid, lexical, lines, mixing, negatives, omh, simhash, substring, toxicity, warc
from rowtide.llm.common import in_test_fold, table
from rowtide.tables.folders import shared_folder


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.compare_with_next(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_test_fold("doc_id", 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    messages = rows.unionByName(probe).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.digests(chat.format_chats(messages))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_duplicates(table(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op8_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_test_fold("doc_id", 4, 2)
    model = langid.fit(docs.filter(~held_out))
    found = langid.identify(docs, model, spans=False)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = lines.fit(docs, table(spark, sf_dir, "labels"))
    return lines.judge(docs, field)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), every=100, least=80, most=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_order_minhash": op1_order_minhash,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_inverted_multi_index": op8_inverted_multi_index,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_quality_rules": op11_quality_rules,
    "op12_ranked_search": op12_ranked_search,
    "op13_hard_negatives": op13_hard_negatives,
}

def _escaped_length(column: str) -> str:
    """SQL for the length of an escaped text: a backslash more for each backslash and each control string."""
    counts = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ("\\", *chat.CONTROL)]
    return " + ".join([f"length({column})", *counts])


ORACLES: dict[str, str] = {
    "op3_mixing": f"""
        with recursive counts as (select source, count(*) as n from documents group by source),
        shares as (select source, n, sqrt(n) / (select sum(sqrt(n)) from counts) as share from counts),
        size as (select greatest({mixing.BLOCK_ROWS}, cast(ceil(max(n / share) / {mixing.MOST_SLOTS}) as bigint)) as rows from shares),
        lanes as (
            select list(source order by source nulls first) as sources, list(share order by source nulls first) as w,
                list(cast(ceil(n / rows) as bigint) order by source nulls first) as blocks
            from shares, size
        ),
        -- t: a slot; i, n: the source and its block that got it; done: the blocks every source has had
        run(t, i, n, done) as (
            select cast(-1 as bigint), cast(null as bigint), cast(null as bigint), list_transform(w, lambda x: cast(0 as bigint)) from lanes
            union all
            select t, i, done[i], list_transform(done, lambda d, k: d + case when k = i then 1 else 0 end)
            from (
                select t, done, list_min(list_filter(list_transform(range(1, len(w) + 1), lambda k:
                    case when done[k] < blocks[k] and floor(done[k] / w[k] + {mixing.NEAR}) <= t
                        then {{'due': ceil((done[k] + 1) / w[k] - {mixing.NEAR}), 'i': k}} end), lambda x: x is not null)).i as i
                from (select t + 1 as t, done from run), lanes
                where list_sum(done) < list_sum(blocks)
            )
        ),
        slots as (select sources[i] as source, n as block, t as slot, w[i] as share from run, lanes where i is not null),
        rows as (
            select doc_id, source, row_number() over (
                partition by source order by md5(cast(doc_id as varchar))[1:15], doc_id) - 1 as place
            from documents
        )
        select doc_id, r.source, block, cast(floor(block / share + {mixing.NEAR}) as bigint) as release,
            cast(ceil((block + 1) / share - {mixing.NEAR}) as bigint) as deadline, slot,
            slot * size.rows + place % size.rows as position
        from rows r, size join slots s on r.source is not distinct from s.source and r.place // size.rows = s.block
    """,
    "op4_chat_formatting": f"""
        with said as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ),
        chats as (
            select conv_id, count(*) as n_turns,
                string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
                coalesce(string_agg(text, '' order by turn nulls first, role, text)
                    filter (where role = 'assistant'), '') as loss,
                sum({_escaped_length("role")} + {_escaped_length("text")} + {len(chat.TURN + chat.TEXT + chat.END)}) as size
            from said group by conv_id
        )
        select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
            cast(size as bigint) as formatted_chars
        from chats
    """,
    "op5_substring_dedup": r"""
        with words as (
            select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
            from documents
        ),
        wins as (
            select doc_id, i, array_to_string(w[i : i + 12], ' ') as win
            from words, unnest(range(1, len(w) - 11)) as u(i)
        ),
        firsts as (select win, min(doc_id) as first_id from wins group by win),
        hit as (select doc_id, unnest(range(i, i + 13)) as pos from wins join firsts using (win) where first_id < doc_id),
        gone as (select distinct doc_id, pos from hit),
        every as (select doc_id, w, unnest(range(1, len(w) + 1)) as pos from words),
        kept as (
            select every.doc_id, string_agg(w[every.pos], ' ' order by every.pos) as text
            from every left join gone on every.doc_id = gone.doc_id and every.pos = gone.pos
            where gone.pos is null group by every.doc_id
        )
        select doc_id, cast(len(w) as bigint) as n_words,
            coalesce((select count(*) from gone where gone.doc_id = words.doc_id), 0) as n_removed,
            sha256(coalesce((select text from kept where kept.doc_id = words.doc_id), '')) as kept_sha256
        from words
    """,
    "op10_warc": r"""
        with p as (select page_id, coalesce(html, '') as html from pages),
        k as (select html, max(page_id) as keeper from p group by html),
        d as (
            select page_id, strlen(p.html) as payload_bytes, sha1(p.html) as h, keeper
            from p join k on p.html = k.html
        )
        select page_id, payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((cast('0x' || substr(h, cast(i // 4 * 5 + 1 as int), 5) as bigint) >> (15 - i % 4 * 5)) & 31) + 1, 1)), '')
                as payload_digest,
            case when page_id is not distinct from keeper then 'response' else 'revisit' end as record_type,
            case when page_id is distinct from keeper then keeper end as refers_to
        from d
    """,
    "op12_ranked_search": r"""
        with words as (
            select doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ),
        lengths as (select doc_id, count(*) as n from words group by doc_id),
        sizes as (select count(*) as docs, cast(sum(n) as bigint) as every from lengths),
        asked as (
            select item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ),
        tfs as (select doc_id, term, count(*) as tf from words semi join asked using (term) group by all),
        dfs as (select term, count(*) as df from tfs group by term),
        impacts as (
            select doc_id, term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint)
                * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // every)))) as impact
            from tfs join dfs using (term) join lengths using (doc_id) cross join sizes
        ),
        scores as (select item_id, doc_id, cast(sum(impact) as bigint) as score from asked join impacts using (term) group by all),
        ranked as (
            select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
                doc_id, score
            from scores where score > 0
        )
        select * from ranked where rank <= 20
    """,
    "op13_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
            from embeddings
            where label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scores as (
            select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
                cast(list_dot_product(a.q, b.q) as bigint) as score
            from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
        ),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scores where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        ),
        ranked as (
            select anchor_id, positive_id, cast(row_number() over (
                    partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
                vec_id as negative_id, positive_score, score as negative_score
            from positives join scores using (anchor_id)
            where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
        )
        select * from ranked where rank <= 5
    """,
}
