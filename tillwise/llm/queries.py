"""The registered queries of the subpackage. Each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    alignment, ann_graph, bpe, chat, knn_join, lexical, license_scan, mixing, pii, simhash,
    substring, toxicity, warc,
)
from tillwise.workspace import materialise

# The key of the registered query; deployments pass their own.
PII_KEY = "registered query"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return knn_join.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(table(spark, folder, "documents"), TOKENIZER, packed=True)
    return bpe.decode(encoded, TOKENIZER).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_license(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op5_ann(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann_graph.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    counted = materialise(mixing.features(documents, "doc_id"), "mix-features")
    return mixing.mix(counted, mixing.weights(counted))


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_windows(rows.unionByName(extra)))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(documents, PII_KEY)


def toxicity_model(spark: SparkSession, documents: DataFrame, folder: str) -> dict:
    """Trained on the labelled documents that are not held out."""
    labels = table(spark, folder, "labels").where(~toxicity.held_out())
    return toxicity.train(documents, labels)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    scored = toxicity.score(documents, toxicity_model(spark, documents, folder))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "spans"
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.archive_pages(table(spark, folder, "pages"))
    records = warc.read_archives(manifest)
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
        "problem",
    )


def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    index = lexical.build(table(spark, folder, "documents"))
    return lexical.search(index, table(spark, folder, "benchmark"))


def op12_substring(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), BYTE_LEVEL, PIECES).documents


def _list(values) -> str:
    return ", ".join(values)


def _license_sql() -> str:
    """The scan in DuckDB's dialect: the same levelling, digests of the known texts inline."""
    level = "lower(text)"
    for old, new in (("https://", ""), ("http://", ""), ("&", " and "), ("©", "(c)")):
        level = f"replace({level}, '{old}', '{new}')"
    for pattern, put in (
        (license_scan.COPYRIGHT, "\n"),
        (r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f‘’“”–—]+", " "),
    ):
        level = f"regexp_replace({level}, '{pattern}', '{put}', 'g')"
    for old, new in license_scan.SPELLINGS:
        level = f"replace({level}, '{old}', '{new}')"
    known = _list(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in license_scan.KNOWN
    )
    return f"""
    with texts as (
        select doc_id, chr(10) || coalesce(text, '') as text, null as license from documents
        union all select null, chr(10) || t, l from (values {known}) k(l, t)
    ), level as (
        select doc_id, license, [trim(x) for x in string_split({level}, chr(10)) if trim(x) <> '']
               as lines from texts
    ), units as (
        select doc_id, license, lines, coalesce(array_to_string(lines, ' '), '') as form,
               sha256(coalesce(array_to_string(lines, ' '), '')) as digest
        from level
    ), known as (
        select distinct license, digest from units where license is not null
    ), longer as (
        select distinct length(form) as n from units where license is not null and len(lines) > 1
    ), ends as (
        select doc_id, digest, lines,
               [coalesce(list_sum([length(x) + 1 for x in lines[1:k]]), 0)
                for k in range(0, len(lines) + 1)] as e
        from units where license is null
    ), parts as (
        select doc_id, digest, true as single, unnest(lines) as line from units where license is null
        union all
        select doc_id, digest, false, array_to_string(lines[a.i:b.j], ' ')
        from ends, unnest(range(1, len(lines))) as a(i), unnest(range(a.i + 1, len(lines) + 1)) as b(j)
        where e[b.j + 1] - e[a.i] - 1 in (select n from longer)
    ), hits as (
        select doc_id, p.digest, list_sort(list(distinct k.license)) as all_of,
               list_sort(coalesce(list(distinct k.license) filter (where p.single), [])) as of_lines
        from parts p join known k on k.digest = sha256(p.line)
        group by all
    ), whole as (select digest, min(license) as license from known group by digest)
    select u.doc_id, u.digest, w.license,
           coalesce(case when w.license is null then h.all_of else h.of_lines end, []::varchar[]) as notices
    from (select * from units where license is null) u
    left join whole w on w.digest = u.digest
    left join hits h on h.doc_id is not distinct from u.doc_id and h.digest = u.digest
    """


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    f"'{lexical.TERM}')"
)

TOPK_SQL = """
with v as (
    select distinct vec_id, [floor(256 * x::double) for x in embedding] as q from embeddings
    where embedding is not null
      and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
), scored as (
    select a.vec_id as query_id, a.q as asked, b.vec_id,
           max(list_inner_product(a.q, b.q))::bigint as score
    from v a join v b on b.vec_id <> a.vec_id where a.vec_id % 50 = 0
    group by all
), ranked as (
    select query_id, vec_id, score,
           row_number() over (partition by query_id, asked order by score desc, vec_id) as rank
    from scored
)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 5
"""

WARC_SQL = """
with p as (
    select page_id, encode(coalesce(html, '')) as body from pages
), d as (
    select page_id, octet_length(body) as payload_bytes, sha1(body) as hex from p
), g as (
    select *, max(page_id) over (partition by hex, payload_bytes) as last from d
)
select page_id, payload_bytes::bigint as payload_bytes,
       array_to_string([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  (('0x' || substr(hex, (n // 4 * 5 + 1)::integer, 5))::integer
                   >> (15 - n % 4 * 5)::integer) % 32 + 1, 1)
           for n in range(0, 32)], '') as payload_digest,
       case when page_id is distinct from last and last is not null
            then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from last then last end as refers_to,
       null::varchar as problem
from g
"""

LEXICAL_SQL = rf"""
with t as (
    select row_number() over () as r, doc_id, {_TERMS} as terms from documents
), d as (
    select r, doc_id, terms, len(terms) as n from t where len(terms) > 0
), c as (
    select count(*) as total, sum(n)::bigint as tokens from d
), q as (
    select item_id, text, term, count(*) as times
    from (select item_id, text, unnest({_TERMS}) as term
          from (select distinct item_id, text from benchmark))
    group by all
), p as (
    select r, term, count(*) as tf from (select r, unnest(terms) as term from d)
    where term in (select term from q) group by all
), w as (
    select term, floor(1000 * ln((2 * total + 2)::double / (2 * count(*) + 1)))::bigint as w
    from p, c group by term, total
), scored as (
    select q.item_id, q.text, d.r, d.doc_id,
           sum(q.times * w.w * ((1000000000 * p.tf)
               // (1000 * p.tf + 12 * (100 - 25 + (25 * d.n * c.total) // c.tokens))))::bigint as score
    from q join p using (term) join w using (term) join d using (r), c
    group by all
), ranked as (
    select item_id, doc_id, score, row_number() over (
        partition by item_id, text order by score desc, doc_id nulls last) as rank
    from scored where score > 0
)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 20
"""

SUBSTRING_SQL = r"""
with w as (
    select row_number() over () as r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
    from documents
), win as (
    select r, doc_id, i, array_to_string(ws[i : i + 12], ' ') as g
    from (select *, unnest(range(1, len(ws) - 11)) as i from w where len(ws) >= 13)
), least as (
    select g, min(doc_id) as first from win group by g
), hit as (
    select distinct r, i + unnest(range(13)) as place from win join least using (g)
    where first < doc_id or (doc_id is null and first is not null)
), words as (
    select r, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as place from w
), kept as (
    select r, count(*) as n, string_agg(word, ' ' order by place) as kept
    from words anti join hit using (r, place) group by r
)
select w.doc_id, len(w.ws)::bigint as n_words, (len(w.ws) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from w left join kept using (r)
"""

REGISTRY = {
    "op1_topk": op1_topk,
    "op2_bpe": op2_bpe,
    "op3_license": op3_license,
    "op4_simhash": op4_simhash,
    "op5_ann": op5_ann,
    "op6_mixing": op6_mixing,
    "op7_chat": op7_chat,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_lexical": op11_lexical,
    "op12_substring": op12_substring,
    "op13_alignment": op13_alignment,
}

ORACLE = {
    "op1_topk": TOPK_SQL,
    "op3_license": _license_sql(),
    "op10_warc": WARC_SQL,
    "op11_lexical": LEXICAL_SQL,
    "op12_substring": SUBSTRING_SQL,
}
