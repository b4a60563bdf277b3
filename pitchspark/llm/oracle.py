"""DuckDB SQL for the registered queries that SQL can express, and for the pipeline's stages."""

_OP4 = r"""
with d as (select doc_id, coalesce(text, '') t from documents),
w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws from d),
u as (select doc_id, unnest(ws) a, generate_subscripts(ws, 1) i from w where len(ws) >= 3),
p as (select doc_id, i, a, lead(a, 1) over v b, lead(a, 2) over v c from u window v as (partition by doc_id order by i)),
g as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) c from p where c is not null),
r as (select doc_id, count(distinct i + o) n from g, (values (0), (1), (2)) x(o) where c >= 2 group by doc_id),
l as (select doc_id, unnest(string_split(t, chr(10))) line from d),
dup as (select doc_id, count(*) - count(distinct line) n from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
s as (
  select w.doc_id, t, len(ws)::bigint n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(dup.n, 0)::bigint n_dup_lines, coalesce(r.n, 0)::bigint n_repeat_words
  from w left join r using (doc_id) left join dup using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 100 * n_symbols > 40 * n_words
    or 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 60 * length(regexp_replace(t, '[^A-Za-z]', '', 'g'))
    or word_chars < 2 * n_words or word_chars > 15 * n_words
    or 100 * n_dup_lines > 50 * len(string_split(t, chr(10)))) kept
from f
"""

_OP5 = r"""
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint n, sha256(coalesce(html, '')) d from pages),
f as (select *, case when n >= 100 then min(page_id) over (partition by d) else page_id end first from p)
select page_id, n payload_bytes, d payload_digest, case when page_id = first then 'response' else 'revisit' end record_type,
  case when page_id <> first then first end refers_to
from f
"""

#: The mix of table {docs} (doc_id, text, source): one row per document with what ``op10`` returns and how often it is taken.
MIX = r"""
mix_d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint hash from {docs}),
mix_s as (select *, list_element([5, 2, 1], ((place % 3) + 1)::int) weight, 3 * source_size most from (
    select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) - 1 place from mix_d group by source)),
mix_f as (select *, most / weight ratio, (sum(source_size) over () - coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (order by most / weight, place rows between current row and unbounded following))::double lev from mix_s),
mix_l as (select arg_min(lev, ratio * 1000 + place / 1000.0) lev from mix_f where lev <= ratio),
mix_t as (select source, source_size, least(coalesce(mix_l.lev * weight, most), most)::double target,
    case when source_size > 0 then floor(least(coalesce(mix_l.lev * weight, most), most) / source_size)::bigint else 0 end whole from mix_f, mix_l),
mix_h as (select d.source, hash, sum(size)::bigint tokens from mix_d d group by d.source, hash),
mix_c as (select h.source, hash, t.target - t.whole * t.source_size rest, sum(tokens) over (partition by h.source order by hash) upto, tokens
    from mix_h h join mix_t t on h.source is not distinct from t.source),
mix_b as (select source, hash + (case when upto - rest < rest - (upto - tokens) then 1 else 0 end) below from mix_c where upto - tokens <= rest and rest < upto),
mix_o as (select d.doc_id, d.size, d.source, d.hash, t.source_size, t.target, (t.whole + (case when d.hash < coalesce(b.below, 0) then 1 else 0 end))::bigint times
    from mix_d d join mix_t t on d.source is not distinct from t.source left join mix_b b on d.source is not distinct from b.source)
"""

_OP10 = "with " + MIX.format(docs="documents") + " select doc_id, size, source_size, target, size * times taken from mix_o"

_OP11 = r"""
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end::bigint label,
    list_transform(embedding, lambda x: floor(256 * x::double)) q
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id anchor_id, b.vec_id other, a.label = b.label same, list_inner_product(a.q, b.q)::bigint score
  from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, other positive_id, score positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id, row_number() over w::int as rank, other negative_id, positive_score, score negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other)
qualify row_number() over w <= 10
"""

ORACLE_SQL = {"op4_quality_rules": _OP4, "op5_warc": _OP5, "op10_mix_sources": _OP10, "op11_hard_negatives": _OP11}
