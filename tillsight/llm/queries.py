"""Registered queries of the operators, each over its whole table, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import conversation, decontaminate, divergence, exactdedup, langid, mixing, packing, quality, secretscan, simhash, tokencount, urlfilter, warc
from tillsight.llm.common import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.secrets(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random", "random_spans")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), tokencount.read_vocabulary())


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_groups(_table(spark, sf_dir, "documents"))


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(_table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archive")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.index(warc.read_archive(spark, path))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identified(docs, langid.train(docs))


def op11_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repaired_after_damage(_table(spark, sf_dir, "conversations"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_secrets, op3_decontaminate, op4_token_counts, op5_exact_dedup,
        op6_mixture, op7_url_filter, op8_quality, op9_warc, op10_language, op11_conversation,
        op12_divergence, op13_packing,
    )
}

LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"list_filter(regexp_split_to_array({LOWER_AZ}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
SIZE = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))"
LETTERS = "length(regexp_replace(coalesce(text, ''), '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+', '', 'g'))"
SHOWN = "length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g'))"
TERMS = f"list_filter(regexp_split_to_array({LOWER_AZ}, '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
SQL: dict[str, str] = {
    "op3_decontaminate": f"""
        with d as (select doc_id, {WORDS} as w from documents),
        i as (select item_id, {WORDS} as w from benchmark),
        n as (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from i where len(w) > 0),
        known as (select distinct item_id, array_to_string(w[p:p + 9], ' ') as x, least(len(w), 10) as l from n),
        spot as (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as p from d, (select distinct l from known) q),
        hits as (select doc_id, p, a.l, item_id from (select *, array_to_string(w[p:p + l - 1], ' ') as x from spot) a join known using (x)),
        places as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + l)) as q from hits) group by 1),
        found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
                  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(list, '')) as items_sha256, n_hit is not null as contaminated
        from d left join places using (doc_id) left join found using (doc_id)""",
    "op5_exact_dedup": f"""
        with d as (select doc_id, {LOWER_AZ} as t from documents),
        r as (select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
              row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
              from d window w as (partition by t))
        select * from r""",
    "op6_mixture": f"""
        with d as (select doc_id, source, cast({SIZE} as bigint) as size, md5(coalesce(text, '')) as tie,
                   -ln((cast('0x' || substring(md5(concat_ws('|', 'mix', cast(doc_id as varchar))), 1, 13) as bigint) + 0.5::double)
                       / 4503599627370496::double) / ((1 + {LETTERS})::double / (1 + {SHOWN})) as key from documents),
        s as (select source, cast(sum(size) as bigint) as source_size from d group by 1),
        w as (select *, 2.0::double * source_size as cap,
              [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from s),
        v as (select *, cap / weight as reach, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (o rows between current row and unbounded following) as level
              from w window o as (order by cap / weight, source nulls last)),
        l as (select level from v where level <= reach order by reach, source nulls last limit 1),
        t as (select source, source_size, least(cap, coalesce((select level from l) * weight, cap)) as target from v),
        e as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs from t),
        r as (select d.*, source_size, target, epochs, cast(floor(target) as bigint) - epochs * source_size as rest,
              coalesce(sum(size) over (partition by d.source order by key, tie rows between unbounded preceding and 1 preceding), 0) as before
              from d join e on d.source is not distinct from e.source)
        select doc_id, size, source_size, target, cast(epochs * size + greatest(0, least(size, rest - before)) as bigint) as taken from r""",
    "op9_warc": """
        with p as (select page_id, sha256(coalesce(html, '')) as payload_digest, strlen(coalesce(html, '')) as payload_bytes from pages),
        f as (select *, min(page_id) over (partition by payload_digest) as first_id from p),
        t as (select *, payload_bytes >= 100 and page_id is distinct from first_id as again from f)
        select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
               case when again then 'revisit' else 'response' end as record_type,
               case when again then first_id end as refers_to from t""",
    "op12_divergence": f"""
        with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, {TERMS} as w, row_number() over () as r from documents),
        c as (select lang, source, term, count(*) as n, count(distinct r) as docs
              from (select lang, source, r, unnest(w) as term from d) x group by all),
        k as (select lang, term, sum(n) as lang_n from c group by all having sum(docs) >= 3),
        v as (select lang, count(*) as terms, sum(lang_n) as lang_total from k group by all),
        g as (select distinct lang, source from d),
        m as (select lang, source, sum(n) as total from c semi join k using (lang, term) group by all),
        e as (select g.*, coalesce(total, 0)::hugeint as total, terms::hugeint as terms, lang_total::hugeint as lang_total
              from g left join m using (lang, source) left join v using (lang)),
        s as (select e.lang, e.source, k.term, coalesce(n, 0) as n, 1 + 1000000000::hugeint * (coalesce(n, 0) + 1) // (total + terms) as p,
              1 + 1000000000::hugeint * (lang_n + 1) // (lang_total + terms) as q
              from e join k using (lang) left join c using (lang, source, term)),
        f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
              from s a join s b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        o as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
              from g a join g b on a.lang = b.lang and a.source <> b.source
              left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
              union all select lang, source, 'term', term, cast((p - q) * (p - q) // q as bigint) from s where n > 0 and p > q),
        r as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from o)
        select * from r where part = 'pair' or rank <= 200""",
}
