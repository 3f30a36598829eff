"""The registered queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    divergence,
    exact_dedup,
    filter_audit,
    katz,
    language_id,
    mixing,
    quality,
    simhash,
    substring_dedup,
    token_files,
    topk,
    toxicity,
)
from .ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A public vocabulary; the folder can be named in TOKENIZERS_DIR, and executors have it in
    the same place."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=20, with_text=False)


SQL["op1_substring_dedup"] = r"""
with words as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), windows as (
  select r, coalesce(doc_id, 9223372036854775807) as id, i, array_to_string(list_slice(w, i, i + 19), ' ') as words
  from (select r, doc_id, w, unnest(range(1, len(w) - 18)) as i from words where len(w) >= 20)
), later as (
  select r, i from windows
  qualify id > min(id) over (partition by words) or i > min(i) over (partition by words, r)
), gone as (
  select distinct r, unnest(range(i, i + 20)) as p from later
), kept as (
  select w.r, count(g.p) as n_removed,
         string_agg(w.word, ' ' order by w.p) filter (where g.p is null) as kept
  from (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from words) w
  left join gone g on g.r = w.r and g.p = w.p
  group by w.r
)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from words left join kept using (r)
"""


@query
def op2_quality_classifier(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark, sf_dir):
    return language_id.language_id(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


@query
def op4_simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query
def op5_token_files(spark, sf_dir):
    shards = token_files.write_tokens(
        table(spark, sf_dir, "documents"),
        token_files.shared_folder(spark, "token-shards"),
        tokenizer_path("byte_bpe_50k.json"),
        end_id=2,
    )
    return token_files.read_tokens(shards, with_ids=False)


@query
def op7_katz_scores(spark, sf_dir):
    return katz.katz_scores(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


SQL["op6_exact_dedup"] = r"""
with d as (
  select doc_id, coalesce(length(text), 0) as points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents
)
select doc_id, text_sha256,
       first_value(doc_id) over best as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = first_value(doc_id) over best as kept
from d
window best as (partition by text_sha256 order by points desc, doc_id)
"""


#: Target weights of the tree domain, language, source; siblings that are not named weigh 1.
MIX_WEIGHTS = {
    ("web",): 0.5,
    ("books",): 0.3,
    ("forum",): 0.2,
    ("web", "en"): 3.0,
    ("web", "de"): 2.0,
    ("books", "fr"): 2.0,
}
MIX_SEED = 7


def mix_path(docs: DataFrame) -> dict[str, Column]:
    number = F.coalesce(F.regexp_extract(docs["source"], "([0-9]+)$", 1).try_cast("int"), F.lit(0))
    domain = F.when(number < 9, "web").when(number < 15, "books").otherwise("forum")
    return {"domain": domain, "language": docs["lang"], "origin": docs["source"]}


@query
def op9_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = mix_path(docs)
    plan = mixing.mix_plan(docs, path, MIX_WEIGHTS, budget=0.6, max_epochs=2, seed=MIX_SEED)
    out = mixing.mix(docs.select("doc_id", "lang", "source"), path, plan, MIX_SEED)
    return out.select("doc_id", "lang", "source", F.col("_copies").alias("copies"))


SQL["op9_mix_sources"] = r"""
with words as (
  select doc_id, lang, source,
         case when nr < 9 then 'web' when nr < 15 then 'books' else 'forum' end as d0,
         coalesce(lang, '') as d1, coalesce(source, '') as d2,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as tokens
  from (select *, coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 0) as nr from documents)
), leaves as (
  select d0, d1, d2, sum(tokens)::double as tokens, 2 * sum(tokens)::double as cap, 1.0::double as weight
  from words group by all
), langs as (
  select d0, d1, sum(cap) as cap,
         case when d0 = 'web' and d1 = 'en' then 3.0 when d0 = 'web' and d1 = 'de' then 2.0
              when d0 = 'books' and d1 = 'fr' then 2.0 else 1.0 end::double as weight
  from leaves group by all
), domains as (
  select d0, sum(cap) as cap, case d0 when 'web' then 0.5 when 'books' then 0.3 else 0.2 end::double as weight,
         (select floor(sum(tokens) * 0.6) from leaves) as budget
  from langs group by d0
), f0 as (
  select *, cap / weight * (sum(weight) over (order by cap / weight desc, d0 desc))
            + coalesce(sum(cap) over (order by cap / weight, d0 rows between unbounded preceding and 1 preceding), 0)
            <= budget as is_full
  from domains
), g0 as (
  select d0, case when is_full then cap else least(cap, greatest(budget - sum(if(is_full, cap, 0)) over (), 0)
         * weight / sum(if(is_full, 0, weight)) over ()) end as given
  from f0
), f1 as (
  select l.*, g.given as budget,
         cap / weight * (sum(weight) over (partition by d0 order by cap / weight desc, d1 desc))
         + coalesce(sum(cap) over (partition by d0 order by cap / weight, d1 rows between unbounded preceding and 1 preceding), 0)
         <= g.given as is_full
  from langs l join g0 g using (d0)
), g1 as (
  select d0, d1, case when is_full then cap else least(cap, greatest(budget - sum(if(is_full, cap, 0)) over (partition by d0), 0)
         * weight / sum(if(is_full, 0, weight)) over (partition by d0)) end as given
  from f1
), f2 as (
  select l.*, g.given as budget,
         cap / weight * (sum(weight) over (partition by d0, d1 order by cap / weight desc, d2 desc))
         + coalesce(sum(cap) over (partition by d0, d1 order by cap / weight, d2 rows between unbounded preceding and 1 preceding), 0)
         <= g.given as is_full
  from leaves l join g1 g using (d0, d1)
), g2 as (
  select d0, d1, d2, tokens, floor(round(case when is_full then cap
         else least(cap, greatest(budget - sum(if(is_full, cap, 0)) over (partition by d0, d1), 0)
         * weight / sum(if(is_full, 0, weight)) over (partition by d0, d1)) end, 6)) as given
  from f2
), plan as (
  select *, case when tokens > 0 then floor(given / tokens) else 0 end::bigint as full_epochs from g2
), keyed as (
  select w.doc_id, w.lang, w.source, full_epochs, given - full_epochs * p.tokens as rest,
         sum(w.tokens) over (partition by w.d0, w.d1, w.d2
           order by md5('7:' || full_epochs || ':' || doc_id) range between unbounded preceding and current row) as upto
  from words w join plan p using (d0, d1, d2)
)
select doc_id, lang, source, full_epochs + (rest > 0 and upto <= rest)::bigint as copies from keyed
"""


@query
def op10_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10
    )


SQL["op10_benchmark_decontamination"] = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as words
  from (select item_id, w, least(len(w), 10) as n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i
        from items where len(w) > 0)
), starts as (
  select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
  from words, (select distinct n from windows) where len(w) >= n
), hits as (
  select doc_id, item_id, i, s.n as n
  from starts s join windows v on v.n = s.n and v.words = array_to_string(list_slice(w, i, i + s.n - 1), ' ')
), covered as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id
), found as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as listed
  from (select distinct doc_id, item_id from hits) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join found using (doc_id)
"""


@query
def op11_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


SQL["op11_exact_top_k"] = r"""
with whole as (
  select row_number() over () as r, vec_id, embedding from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
  select r, vec_id, unnest(range(1, len(embedding) + 1)) as i, floor(256 * unnest(embedding)::double)::bigint as w from whole
), products as (
  select q.r as q, d.r as d, sum(q.w * d.w)::bigint as score
  from parts q join parts d on d.i = q.i and d.r <> q.r
  where q.vec_id % 50 = 0 group by all
), scored as (
  select q.r, q.vec_id as query_id, d.vec_id, coalesce(p.score, 0) as score
  from whole q join whole d on d.r <> q.r left join products p on p.q = q.r and p.d = d.r
  where q.vec_id % 50 = 0
)
select query_id, row_number() over (partition by r order by score desc, vec_id nulls last) as rank, vec_id, score
from scored qualify rank <= 5
"""


@query
def op12_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


SQL["op12_source_divergence"] = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), occurring as (
  select r, lang, source, term, count(*) as n from (select r, lang, source, unnest(w) as term from d) group by all
), kept as (
  select lang, term, count(*) over (partition by lang) as v
  from occurring group by lang, term having count(*) >= 30
), groups as (
  select distinct lang, source from d
), counts as (
  select lang, source, term, v, coalesce(sum(n), 0)::hugeint as c
  from groups join kept using (lang) left join occurring using (lang, source, term) group by all
), rated as (
  select lang, source, term, c,
         1 + (1000000000 * (c + 5)) // (sum(c) over (partition by lang, source) + 5 * v)::hugeint as p
  from counts
), languages as (
  select lang, term, 1 + (1000000000 * (c + 5)) // (sum(c) over (partition by lang) + 5 * v)::hugeint as q
  from (select lang, term, v, sum(c)::hugeint as c from counts group by all)
), parts as (
  select g.lang, g.source, 'pair' as part, h.source as item,
         coalesce((select sum(abs(a.p - b.p)) from rated a join rated b using (lang, term)
                   where a.lang = g.lang and a.source = g.source and b.source = h.source), 0)::bigint as value
  from groups g join groups h on h.lang = g.lang and h.source <> g.source
  union all
  select lang, source, 'term', term, (p - q)::bigint from rated join languages using (lang, term) where c > 0 and p > q
)
select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
from parts qualify part = 'pair' or rank <= 50
"""


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op13_filter_audit"] = r"""
with marks as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, coalesce(good, false) as good,
         coalesce(toxic, false) as toxic, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents left join marks using (doc_id)
), failing as (
  select part, good, toxic, [
           len(w) < 100,
           100 * len(list_distinct(w)) < 80 * len(w),
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
           regexp_matches(text, '[#$%&*|]'),
           coalesce(coalesce(doc_id, 9223372036854775807) > min(coalesce(doc_id, 9223372036854775807)) over (partition by text), false)
         ] as fails
  from d
), cells as (
  select part, good, toxic, fails, count(*) as n from failing group by all
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps as (
  select filter_order, step, filter_order[step] as x, ascii(filter_order[step]) - 64 as nr,
         list_transform(range(1, step), lambda i: ascii(filter_order[i]) - 64) as before
  from orders, (select unnest(range(1, 6))::int as step)
), judged as (
  select part, filter_order, step, x, n, good, toxic, fails[nr] as failed,
         len(list_filter(fails, lambda f: f)) as n_fails, len(list_filter(before, lambda i: fails[i])) = 0 as alive
  from cells, steps
), counted as (
  select part, filter_order, step, x,
         sum(if(alive and not failed, n, 0))::bigint as kept,
         sum(if(alive and failed, n, 0))::bigint as removed,
         sum(if(not alive and failed, n, 0))::bigint as redundant,
         sum(if(failed and n_fails = 1, n, 0))::bigint as unique_fails,
         sum(if(alive and failed and good, n, 0))::bigint as good_lost,
         sum(if(alive and failed and toxic, n, 0))::bigint as toxic_lost
  from judged group by all
)
select * exclude (x), sum(removed) over (partition by part, x)::bigint as shapley from counted
"""
