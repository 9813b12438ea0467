"""The corpus queries as DuckDB SQL, where SQL can express them: plain forms, without the methods."""

WORD = r"[^\x20\x09-\x0D]+"

EXACT_DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC_REVISITS = f"""
with hashed as (
  select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
         sha1(coalesce(html, '')) as hexed
  from pages
), named as (
  select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}',
           1 + cast((cast('0x' || substr(hexed, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as integer), 1)),
         '') as payload_digest
  from hashed
), firsts as (
  select *, min(page_id) over (partition by payload_digest) as first_id from named
)
select page_id, payload_bytes, payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from firsts
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JACCARD = f"""
with recursive words as materialized (
  select doc_id, regexp_extract_all({_LOWER}, '{WORD}') as w from documents
), sets as materialized (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end as s
  from words
), sized as materialized (select doc_id, s, cast(len(s) as bigint) as n_shingles from sets),
shingles as materialized (select doc_id, n_shingles as n, unnest(s) as shingle from sized),
meeting as (
  select a.doc_id as a, b.doc_id as b, a.n as n, b.n as m, count(*) as shared
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  where 100 * a.n >= 75 * b.n and 100 * b.n >= 75 * a.n
  group by all
), links as materialized (select a, b from meeting where 100 * shared >= 75 * (n + m - shared)),
reached as (
  select doc_id as start, doc_id as node from documents where doc_id in (select a from links)
  union
  select start, b from reached join links on node = a
), smallest as (select start, min(node) as component_id from reached group by start)
select doc_id, n_shingles, coalesce(component_id, doc_id) as component_id
from sized left join smallest on doc_id = start
"""


def _draw(*parts: str) -> str:
    text = " || ':' || ".join(parts)
    return f"cast('0x' || substr(sha256({text}), 1, 13) as bigint)"


def _seats(parties: str, group: str, key: str, votes: str, total: str) -> str:
    """Seats by listing every quotient that could win."""
    by = f"partition by {group} " if group else ""
    keys = f"{group}, {key}" if group else key
    return f"""
  select {keys}, count(*) as quota from (
    select {keys}, {total}, row_number() over ({by}order by cast({votes} as double) / (2 * k + 1) desc, {key}, k) as place
    from (select {keys}, {votes}, {total}, unnest(range(cast({total} as bigint) + 1)) as k from {parties} where {votes} > 0)
  ) where place <= {total} group by all"""


SOURCE_MIX = f"""
with sizes as materialized (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as bigint) as size from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as source_rank
  from sizes group by source
), weighed as (
  select *, [5, 2, 1][1 + source_rank % 3] as weight, 3 * source_size as most,
         cast(sum(source_size) over () as bigint) as words
  from sources
), queued as (
  select *, sum(weight) over later as left_weight, words - coalesce(sum(most) over earlier, 0) as left_words
  from weighed
  window later as (order by cast(source_size as double) / weight, source_rank
                   rows between current row and unbounded following),
         earlier as (order by cast(source_size as double) / weight, source_rank
                     rows between unbounded preceding and 1 preceding)
), shared as (
  select *, most * left_weight <= weight * left_words as is_full,
         max(case when most * left_weight > weight * left_words
                  then cast(left_words as double) / cast(left_weight as double) end) over () as share
  from queued
), targets as materialized (
  select source, source_rank, source_size, case when is_full then cast(most as double) else weight * share end as target,
         cast(round(cast(words as double) / 16) as bigint) as blocks,
         greatest(1, cast(ceil(source_size / 1048576.0) as bigint)) as n_shards
  from shared
), source_quota as ({_seats("targets", "", "source_rank", "target", "blocks")}
), placed as materialized (
  select s.doc_id, s.size, t.source_rank, t.source_size, t.target, coalesce(q.quota, 0) as source_quota,
         {_draw("'mix'", "'shard'", "cast(s.doc_id as varchar)")} % t.n_shards as shard,
         {_draw("'mix'", "'order'", "cast(s.doc_id as varchar)")} as draw
  from sizes s join targets t on s.source is not distinct from t.source
  left join source_quota q on q.source_rank = t.source_rank
), shards as materialized (
  select source_rank, shard, source_quota, cast(sum(size) as bigint) as shard_size from placed group by all
), shard_quota as ({_seats("shards", "source_rank", "shard", "shard_size", "source_quota")}
), laid as (
  select p.*, coalesce(sum(size) over (partition by source_rank, shard order by draw, doc_id, size
                                       rows between unbounded preceding and 1 preceding), 0) as start
  from placed p
), chosen as (
  select l.*, greatest(1, cast(ceil(h.shard_size / 16.0) as bigint)) as n, coalesce(q.quota, 0) as asked,
         {_draw("'mix'", "'run'", "cast(l.source_rank as varchar)", "cast(l.shard as varchar)")} as run
  from laid l join shards h on h.source_rank = l.source_rank and h.shard = l.shard
  left join shard_quota q on q.source_rank = l.source_rank and q.shard = l.shard
), runs as (
  select *, least(asked, 3 * n) // n as rounds, least(asked, 3 * n) % n as rest, run % n as first from chosen
)
select doc_id, size, source_size, target,
       cast(rounds * size
            + greatest(0, least(start + size, 16 * (first + rest)) - greatest(start, 16 * first))
            + greatest(0, least(start + size, 16 * greatest(0, first + rest - n)) - start) as bigint) as taken
from runs
"""

EMBEDDINGS = """
with recursive usable as materialized (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as materialized (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.95
), reached as (
  select vec_id as start, vec_id as node from usable where vec_id in (select a from links)
  union
  select start, b from reached join links on node = a
), smallest as (select start, min(node) as component_id from reached group by start),
counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, coalesce(component_id, vec_id) as component_id,
       vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join smallest on vec_id = start left join counted on vec_id = a
"""

REPEATED_PASSAGES = f"""
with words as materialized (
  select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents
), windows as materialized (
  select doc_id, i as place, sha256(array_to_string(w[i : i + 49], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from words where len(w) >= 50)
), firsts as (select h, min(doc_id) as first_id from windows group by h),
covered as materialized (
  select distinct doc_id, unnest(range(place, place + 50)) as place
  from windows join firsts using (h) where doc_id > first_id
), left_over as (
  select doc_id, list(word order by place) as kept
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from words
        where doc_id in (select doc_id from covered)) anti join covered using (doc_id, place)
  group by doc_id
), removed as (select doc_id, count(*) as n from covered group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_removed,
       sha256(array_to_string(case when n is null then w else coalesce(kept, []) end, ' ')) as kept_sha256
from words left join removed using (doc_id) left join left_over using (doc_id)
"""

_FIXED = "[cast(floor(256 * cast(x as double)) as bigint) for x in embedding]"
_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


_DISTANCE = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _assigned(step: int) -> str:
    return f"""assigned{step} as materialized (
  select vec_id, part, arg_min(entry, apart * 64 + entry) as entry, cast(min(apart) as bigint) as apart
  from (select p.vec_id, p.part, b.entry, {_DISTANCE} as apart from pieces p join books{step} b using (part))
  group by vec_id, part
)"""


def _moved_books(step: int) -> str:
    return f"""means{step} as (
  select part, entry, list(m order by place) as v from (
    select part, entry, place, cast(floor(cast(sum(x) as double) / count(*)) as bigint) as m
    from (select part, entry, unnest(v) as x, unnest(range(1, len(v) + 1)) as place
          from assigned{step - 1} join pieces using (vec_id, part))
    group by part, entry, place) group by part, entry
), books{step} as materialized (
  select part, entry, coalesce(n.v, o.v) as v from books{step - 1} o left join means{step} n using (part, entry)
)"""


VECTOR_CODES = f"""
with kept as materialized (select vec_id, label, {_FIXED} as v from embeddings where {_FINITE}),
pieces as materialized (
  select vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] as v
  from (select vec_id, v, unnest(range(16)) as part from kept)
), books0 as materialized (
  select part, entry, v from pieces join (
    select vec_id, row_number() over (order by vec_id) - 1 as entry from kept order by vec_id limit 64) using (vec_id)
), {_assigned(0)}, {_moved_books(1)}, {_assigned(1)}, {_moved_books(2)}, {_assigned(2)},
final as (
  select vec_id, string_agg(lower(printf('%02x', cast(entry as integer))), '' order by part) as code, cast(sum(apart) as bigint) as error
  from assigned2 group by vec_id
), digest as (
  select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from books2
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from final join kept using (vec_id) cross join digest
"""

HARD_NEGATIVES = f"""
with rows as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, {_FIXED} as v
  from embeddings where label is not null and {_FINITE}
), scored as materialized (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as bigint) as score
  from (select * from rows where vec_id % 100 = 0) a join rows b on a.vec_id <> b.vec_id
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select anchor_id, positive_id, cast(row_number() over best as integer) as rank, other_id as negative_id,
       positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
window best as (partition by anchor_id, positive_id order by score desc, other_id)
qualify row_number() over best <= 5
"""

ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op2_warc_revisits": WARC_REVISITS,
    "op3_ngram_jaccard": NGRAM_JACCARD,
    "op4_source_mix": SOURCE_MIX,
    "op8_embeddings": EMBEDDINGS,
    "op10_repeated_passages": REPEATED_PASSAGES,
    "op12_vector_codes": VECTOR_CODES,
    "op13_hard_negatives": HARD_NEGATIVES,
}
