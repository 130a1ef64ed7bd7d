"""The registered queries of this subpackage and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from wardflow.llm import (
    bpe, exact_dedup, extract, packing, quality, repair, search, secrets, simhash,
    substring, token_counts, topk, warc,
)
from wardflow.llm.common import table
from wardflow.llm.tokens import BYTE_BPE, WORD_BPE, tokenizer_path
from wardflow.session import configure, work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    QUERIES[function.__name__] = run
    return function


@query
def op1_warc(spark, folder):
    path = work_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path, "page_id", "url", "html")
    return warc.read_archives(spark, path, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        "refers_to",
    )


ORACLES["op1_warc"] = """
with rows as (
    select page_id, coalesce(html, '') as body, max(page_id) over (partition by coalesce(html, ''))
        as last, sha1(coalesce(html, '')) as hex
    from pages
)
select page_id, strlen(body)::bigint as payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex, (1 + 5 * (k // 4))::int, 5))::bigint >> (15 - 5 * (k % 4))::int) & 31)
            + 1)::int, 1)), '') as payload_digest,
       case when page_id = last then 'response' else 'revisit' end as record_type,
       case when page_id <> last then last end as refers_to
from rows
"""


@query
def op2_simhash(spark, folder):
    groups = simhash.near_groups(table(spark, folder, "documents"), "doc_id", "text")
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op3_packing(spark, folder):
    packed = packing.pack(table(spark, folder, "documents"), "doc_id", "text", tokenizer_path(WORD_BPE))
    return packed.withColumnRenamed("id", "doc_id")


@query
def op4_topk(spark, folder):
    return topk.top_k(
        table(spark, folder, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


ORACLES["op4_topk"] = """
with rows as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
), scored as (
    select q.vec_id as query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
    from rows q join rows c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place
    from scored
)
select query_id, place::int as rank, vec_id, score from ranked where place <= 5
"""


@query
def op5_secrets(spark, folder):
    found = secrets.scan(table(spark, folder, "documents"), "doc_id", "text")
    return found.withColumnRenamed("id", "doc_id")


@query
def op6_substring_dedup(spark, folder):
    found = substring.remove_repeats(table(spark, folder, "documents"), "doc_id", "text")
    return found.withColumnRenamed("id", "doc_id")


ORACLES["op6_substring_dedup"] = r"""
with texts as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), windows as (
    select doc_id, i, array_to_string(words[i:i + 12], ' ') as run
    from (select doc_id, words, unnest(range(1, len(words) - 11)) as i from texts)
), firsts as (
    select run, min(doc_id) as low from windows group by run
), gone as (
    select distinct doc_id, unnest(range(i, i + 13)) as place
    from windows join firsts using (run) where low < doc_id
), listed as (
    select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from texts
), kept as (
    select doc_id, string_agg(word, ' ' order by place) as text
    from listed anti join gone using (doc_id, place) group by doc_id
), counted as (
    select doc_id, count(*) as n from gone group by doc_id
)
select doc_id, len(words)::bigint as n_words, coalesce(n, 0) as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from texts left join counted using (doc_id) left join kept using (doc_id)
"""


@query
def op7_token_counts(spark, folder):
    lengths = token_counts.encoded_lengths(
        table(spark, folder, "documents"), "text", tokenizer_path(BYTE_BPE))
    return token_counts.histogram(lengths)


@query
def op8_exact_dedup(spark, folder):
    return exact_dedup.duplicate_report(table(spark, folder, "documents"), "doc_id", "text")


ORACLES["op8_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""


@query
def op9_quality(spark, folder):
    documents = table(spark, folder, "documents")
    weights = quality.fit(documents, table(spark, folder, "labels"), "doc_id", "text")
    return quality.score(documents, weights, "doc_id", "text").withColumnRenamed("id", "doc_id")


@query
def op10_bpe(spark, folder):
    found = bpe.round_trip(
        table(spark, folder, "documents"), "doc_id", "text", tokenizer_path(BYTE_BPE))
    return found.withColumnRenamed("id", "doc_id")


@query
def op11_repair(spark, folder):
    rows = repair.damage(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    return repair.repair_report(rows).withColumnRenamed("conv", "conv_id")


@query
def op12_search(spark, folder):
    return search.ranked(
        table(spark, folder, "documents"), "doc_id", "text",
        table(spark, folder, "benchmark"), "item_id", "text")


ORACLES["op12_search"] = r"""
with words as (
    select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
), counts as (
    select doc_id, term, count(*) as tf from words group by all
), sizes as (
    select doc_id, sum(tf)::bigint as n from counts group by doc_id
), totals as (
    select count(*) as docs, sum(n)::bigint as length from sizes
), asked as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), weights as (
    select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
    from counts, totals where term in (select term from asked) group by term, docs
), scored as (
    select item_id, doc_id, sum(w * ((1000000000 * tf)
        // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))))::bigint as score
    from asked join weights using (term) join counts using (term) join sizes using (doc_id), totals
    group by item_id, doc_id
), ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as place
    from scored where score > 0
)
select item_id, place::int as rank, doc_id, score from ranked where place <= 50
"""


@query
def op13_extract(spark, folder):
    pages = table(spark, folder, "pages")
    model = extract.fit(pages, "page_id", "html")
    return extract.extract(pages, model, "page_id", "url", "html").withColumnRenamed("id", "page_id")


@query
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
