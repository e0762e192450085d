"""One query for each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WARC_SQL = """
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
  select page_id, octet_length(payload) as payload_bytes, sha1(payload) as hex, payload,
         max(page_id) over (partition by payload) as best
  from p
), s as (
  select page_id, payload_bytes, best, k,
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(hex, 1 + 10 * (k // 8)::int, 10))::ubigint >> (35 - 5 * (k % 8))) & 31)::int, 1) as letter
  from d, range(32) r(k)
)
select page_id, payload_bytes::bigint as payload_bytes, string_agg(letter, '' order by k) as payload_digest,
       case when page_id = best then 'response' else 'revisit' end as record_type,
       case when page_id <> best then best end as refers_to
from s group by page_id, payload_bytes, best
"""


@query("op1_warc_archive", WARC_SQL)
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import warc

    found = warc.page_records(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_toxicity")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import toxicity

    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


REPEATS_SQL = """
with pieces as (
  select doc_id, unnest(str_split(regexp_replace(text, '([.!?] |\\n)', '\\1' || chr(1), 'g'), chr(1))) as piece,
         generate_subscripts(str_split(regexp_replace(text, '([.!?] |\\n)', '\\1' || chr(1), 'g'), chr(1)), 1) as k
  from documents where text is not null and doc_id is not null
), placed as (
  select *, coalesce(sum(length(piece)) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) as start,
    trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\r\\v\\f]+', ' ', 'g'), ' ') as unit
  from pieces
), units as (
  select *, row_number() over (partition by doc_id order by k) as idx, length(unit) - length(replace(unit, ' ', '')) + 1 as words,
    row_number() over (partition by unit order by doc_id, k) as occurrence,
    first_value(doc_id) over (partition by unit order by doc_id, k) as kept_doc_id,
    first_value(start) over (partition by unit order by doc_id, k) as kept_start
  from placed where unit <> ''
), repeated as (
  select *, idx - row_number() over (partition by doc_id order by idx) as run from units where occurrence > 1
), runs as (
  select *, sum(words) over (partition by doc_id, run) as run_words from repeated
)
select doc_id, start::bigint as unit_start, (start + length(piece))::bigint as unit_end, words::bigint as n_words, kept_doc_id,
  kept_start::bigint as kept_start
from runs where run_words >= 20
"""


@query("op3_repeated_units", REPEATS_SQL)
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import repeats

    # passages only: clean documents hold common lines that are no copies
    return repeats.repeated_units(table(spark, sf_dir, "documents"), params=repeats.PASSAGES)


@query("op4_token_counts")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from fallowlens.llm import token_counts

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_benchmark_contamination")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import decontaminate

    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_quality_rules")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import quality

    found = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


@query("op7_language_id")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import language_id

    return language_id.language_id(table(spark, sf_dir, "documents"))


@query("op8_language_model")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import language_model

    return language_model.score_texts(table(spark, sf_dir, "documents"))


@query("op9_near_duplicates")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import near_dedup

    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), params=near_dedup.Params(percent=85))


MIXING_SQL = """
with sizes as (
  select source, sum(coalesce(octet_length(encode(text)), 0)) as bytes from documents group by source
), weighed as (
  select *, case when bytes > 0 then 1.0::double else 0 end as weight from sizes
), rates as (
  select source, case when bytes > 0 then weight / sum(weight) over () * 1.0::double * sum(bytes) over ()::double / bytes else 0 end as rate
  from weighed
), drawn as (
  select d.*, r.rate, ('0x' || substr(md5('0|' || coalesce(doc_id::varchar, '~')), 1, 13))::ubigint::double / 4503599627370496.0 as u
  from documents d join rates r on d.source is not distinct from r.source
), cdf as (
  select rate, k, sum(exp(-rate) * rate ** k / gamma(k + 1)) over (partition by rate order by k) as c
  from (select distinct rate from rates where rate > 0), range(0, 100) t(k)
), counted as (
  select doc_id, text, lang, source, n_chars, (select count(*) from cdf where cdf.rate = drawn.rate and c <= u) as copies
  from drawn where rate > 0
)
select doc_id, text, lang, source, n_chars, unnest(range(copies))::int as copy from counted where copies > 0
"""


@query("op10_mix_sources", MIXING_SQL)
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import mixing

    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op11_quality_classifier")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import quality_trees

    return quality_trees.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


FIM_SQL = """
with t as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
         sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), g as (
  select *, [('0x' || substr(h, 1 + 8 * k, 8))::ubigint for k in range(4)] as d from t
), c as (
  select doc_id, text, n, least(d[1] % (n + 1), d[2] % (n + 1))::bigint as a, greatest(d[1] % (n + 1), d[2] % (n + 1))::bigint as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or d[3] % 100 >= 90 then 'plain'
         when d[4] % 100 < 20 then 'spm' else 'psm' end as form
  from g
), o as (
  select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle, substr(text, b + 1) as suffix from c
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a end as prefix_chars,
  case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from o
"""


@query("op12_fill_in_middle", FIM_SQL)
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import fill_in_middle

    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


@query("op13_vector_codes")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fallowlens.llm import vector_codes

    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
