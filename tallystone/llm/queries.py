"""The subpackage's registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystone.llm import (
    chat,
    fill_in_middle,
    fingerprints,
    language,
    license_scan,
    mixing,
    near_dedup,
    packing,
    private_data,
    token_counts,
    top_k,
    toxicity,
    whitening,
)

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The chain's order: what a text's quality tells comes before the verdict on toxicity.
TOXICITY_CHAIN = ("quality", "toxic")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    models = toxicity.train_chain(documents, _table(spark, sf_dir, "labels"), TOXICITY_CHAIN)
    return toxicity.predict_chain(documents, models, TOXICITY_CHAIN)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = chat.conversations(_table(spark, sf_dir, "conversations"))
    return chat.format_preferences(chat.reply_pairs(talks))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    prototypes = language.learn_prototypes(documents.filter(~language.held_out()))
    return language.identify(documents, prototypes)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(_table(spark, sf_dir, "embeddings")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(again, 256)}
    return made.withColumns(digests).drop("output")


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.find_private_data(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["is_base"])
    kinds = F.transform(base, lambda s: s["kind"])
    count = lambda kind: F.size(F.filter(kinds, lambda k: k == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in private_data.KINDS],
        F.sha2(private_data.joined(base), 256).alias("base_sha256"),
        private_data.joined(F.col("spans")).alias("spans"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_license_scan,
        op2_toxicity,
        op3_best_fit_packing,
        op4_token_counts,
        op5_preference_formatting,
        op6_document_fingerprints,
        op7_mixing,
        op8_language_id,
        op9_minhash_near_dedup,
        op10_exact_top_k,
        op11_whitening,
        op12_fill_in_middle,
        op13_private_data,
    ]
    return {f.__name__: f for f in found}


OP7_SQL = r"""
with docs as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           ('0x' || substr(md5('7:' || coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as place
    from documents
), sources as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as turn
    from docs group by source
), caps as (
    select source, source_size, 2.0::double * source_size as cap,
           (case turn % 3 when 0 then 5 when 1 then 2 else 1 end)::double as weight
    from sources
), levels as (
    -- the water level if the sources before this one, by cap over weight, are at their caps
    select cap / weight as own_level, turn_key,
           (1.5::double * sum(source_size) over () - coalesce(sum(cap) over lower, 0))
             / sum(weight) over (order by cap / weight, turn_key rows between current row and unbounded following) as level
    from (select *, coalesce(source, chr(1114111)) as turn_key from caps)
    window lower as (order by cap / weight, turn_key rows between unbounded preceding and 1 preceding)
), targets as (
    select source, source_size,
           round(least(weight * coalesce((select level from levels where level <= own_level
                                              order by own_level, turn_key limit 1), 1e300), cap), 6) as target
    from caps
), goals as (
    select source, source_size, target, case when source_size > 0 then round(target)::bigint // source_size else 0 end as epochs,
           round(target)::bigint as goal
    from targets
), ordered as (
    select d.*, source_size, target, epochs, goal - epochs * source_size as rest,
           sum(size) over (partition by d.source order by place) as through,
           sum(size) over (partition by d.source, place) as here
    from docs d join goals g on d.source is not distinct from g.source
)
select doc_id, size, source_size, target,
       (epochs * size + case when through <= rest then size
                             when through - here < rest then size * (rest - (through - here)) // here
                             else 0 end)::bigint as taken
from ordered
"""


OP10_SQL = """
with usable as (
    select vec_id, min([floor(x::double * 64) for x in embedding]) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)
    group by vec_id
), scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from usable q join usable c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

_RENDERED = "array_to_string(['<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10) for t in {}], '')"
# Every turn's own rendering is 24 characters longer than its role and text; the text starts 13 in.
_SPANS = """(
        select coalesce(string_agg(reach, ',' order by i), '') from (
            select i, role, sum(len(role) + len(text) + 24) over (order by i) as stop,
                   (stop - len(text) - 11)::varchar || '-' || (stop - 1)::varchar as reach
            from (select unnest(range(1, len({0}) + 1)) as i, unnest({0}).role as role, unnest({0}).text as text)
        ) where role = 'assistant')"""
OP5_SQL = f"""
with turns as (
    select distinct conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text
    from conversations where conv_id is not null and turn is not null
), talks as (
    select conv_id, list({{'role': role, 'text': text}} order by turn, role, text) as turns from turns group by conv_id
), spots as (
    select *, [i for i in range(1, len(turns) + 1) if turns[i].role = 'assistant'] as spots from talks
), picked as (
    select *, (('0x' || substr(md5(conv_id::varchar), 1, 8))::bigint % len(spots) + 1)::int as pick
    from spots where len(spots) > 0
), pairs as (
    select conv_id as pair_id, turns[1:spots[-1]] as c,
           turns[1:spots[pick] - 1] || [{{'role': 'assistant', 'text':
               case when len(spots) > 1 then turns[spots[pick % len(spots) + 1]].text
                    when spots[pick] > 1 then turns[spots[pick] - 1].text else '' end}}] as r
    from picked
), prefixes as (
    select *, coalesce(list_min([i for i in range(1, least(len(c), len(r)) + 1) if c[i] <> r[i]]) - 1,
                       least(len(c), len(r)))::int as prompt_turns
    from pairs
), cut as (
    select pair_id, prompt_turns, c[1:prompt_turns] as p, c[prompt_turns + 1:] as c, r[prompt_turns + 1:] as r from prefixes
)
select pair_id, prompt_turns, {_RENDERED.format('p')} as prompt, {_RENDERED.format('c')} as chosen,
       {_RENDERED.format('r')} as rejected, {_SPANS.format('c')} as chosen_spans, {_SPANS.format('r')} as rejected_spans
from cut
"""


OP12_SQL = r"""
with units as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
           sha256('7:' || coalesce(doc_id::varchar, 'null')) as h
    from documents
), drawn as (
    select *, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as a, ('0x' || h[9:16])::bigint % (len(u) + 1) as b,
           ('0x' || h[17:24])::bigint % 100 as h3, ('0x' || h[25:32])::bigint % 100 as h4
    from units
), pieces as (
    select *, array_to_string(u[:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
           array_to_string(u[greatest(a, b) + 1:], '') as s,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= 100 then 'plain'
                when h4 < 50 then 'spm' else 'psm' end as form
    from drawn
)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then length(p) end::bigint as prefix_chars,
       case when form <> 'plain' then length(m) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from pieces
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_preference_formatting": OP5_SQL,
        "op7_mixing": OP7_SQL,
        "op10_exact_top_k": OP10_SQL,
        "op12_fill_in_middle": OP12_SQL,
    }
