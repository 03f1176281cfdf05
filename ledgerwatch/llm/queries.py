"""One query per operator, over whole tables, and the SQL that some of them can be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (byte_bpe, collocations, decontamination, exact_dedup, html_text, pieces, pii, quality, simhash, spelling, token_counts,
               url_filter, warc)
from .common import new_path, read_table, staged


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.owners(read_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
with d as (
    select doc_id, length(coalesce(text, '')) as points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
    from documents)
select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by body) as group_size,
       doc_id = first_value(doc_id) over best as kept, sha256(body) as text_sha256
from d
window best as (partition by body order by points desc, doc_id
                rows between unbounded preceding and unbounded following)
"""


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of changes over all documents: all are inserted; the counts of those with repeated
    lines are revised to the text without them; exact copies (equal text, a greater id) are deleted at their
    revised counts.  The second batch is sent twice, and counts once."""
    docs = read_table(spark, sf_dir, "documents")
    copies = staged(token_counts.copies(docs), "copies")
    counted = staged(token_counts.counts(docs), "token-counts")
    images = lambda rows, before, after: token_counts.signed_changes(rows.select(
        *token_counts.KEYS, before.alias("n_before"), after.alias("n_after")))
    none = F.lit(None).cast("long")
    store = token_counts.Rollup(spark, new_path(spark, "token-rollup"))
    store.commit("1-insert", images(counted, none, F.col("n_tokens")))
    for _ in range(2):
        store.commit("2-revise", images(counted, F.col("n_tokens"), F.col("n_revised")))
    store.commit("3-delete", images(counted.join(copies, "doc_id", "left_semi"), F.col("n_revised"), none))
    return store.totals()


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: Date of the capture of ``pages``, which have none of their own.
CAPTURED = "2024-01-01T00:00:00Z"


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build(warc.responses_of(read_table(spark, sf_dir, "pages"), CAPTURED))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


OP5_SQL = r"""
with u as (
    select page_id, case when contains(url, '://') then url[strpos(url, '://') + 3:] else '' end as rest from pages),
p as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from u),
r(rule_host, rule_path, verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
    select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
           arg_max(verdict, length(rule_host || rule_path)) as verdict
    from p join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by page_id)
select p.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from p left join fits using (page_id)
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.scores(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read_table(spark, sf_dir, "documents"), pieces.Model(spark))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components_of(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.extract(read_table(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with t as (
    select row_number() over () as doc, coalesce(lang, 'und') as lang,
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
    from documents),
p as (select lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') as w from t),
g as (
    select lang, m, array_to_string(list_slice(w, s, s + m - 1), ' ') as phrase
    from (select lang, w, unnest(range(1, len(w) + 1)) as s from p where len(w) > 0), (values (1), (2), (3), (4)) as lengths(m)
    where s + m - 1 <= len(w)),
f as (select lang, m, phrase, count(*) as f from g group by all),
totals as (select lang, sum(f)::bigint as n from f where m = 1 group by lang),
often as (select * from f where f >= 30),
c as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from often where m > 1),
cuts as (
    select c.lang, m, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') as head, array_to_string(list_slice(w, k + 1, m), ' ') as tail
    from c, (values (1), (2), (3)) as places(k) where k < m),
scores as (
    select cuts.*, h.f as l, t.f as r, (2000000::hugeint * a // (h.f + t.f))::bigint as score
    from cuts join often h on h.lang = cuts.lang and h.phrase = head join often t on t.lang = cuts.lang and t.phrase = tail),
best as (select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as (
    select lang, array_to_string(list_slice(w, s, s + z - 1), ' ') as inner_phrase, max(a) as most
    from c, (values (1), (2), (3)) as starts(s), (values (2), (3)) as sizes(z) where z < m and s + z - 1 <= m group by all),
kept as (
    select best.* from best left join around on best.lang = around.lang and phrase = inner_phrase
    where most is null or 100 * most::hugeint < 80 * a::hugeint)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, score
from kept join totals using (lang)
qualify rank <= 2000
"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), *byte_bpe.public_vocabulary())


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_token_rollup, op3_decontamination, op4_warc, op5_url_filter, op6_quality, op7_html_text, op8_pieces,
    op9_simhash, op10_pii, op11_spelling_variants, op12_collocations, op13_byte_bpe)}
ORACLE = {"op1_exact_dedup": OP1_SQL, "op5_url_filter": OP5_SQL, "op12_collocations": OP12_SQL}
