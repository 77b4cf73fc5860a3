"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')"
_SPACE_WORDS = _WORDS.format(r"[^\x20\x09-\x0D]+")
_LETTER_WORDS = _WORDS.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

JACCARD = """
with recursive w as (select doc_id, {words} w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {width} then [w]
    else list_transform(range(1, len(w) - {width} + 2), lambda i: w[i:i + {width} - 1]) end) s from w),
classes as (select s, min(doc_id) rep from sets where len(s) > 0 group by s),
tok as (select rep, len(s) n, unnest(s) t from classes),
shared as (select a.rep a, b.rep b, any_value(a.n) na, any_value(b.n) nb, count(*) k
  from tok a join tok b on a.t = b.t and a.rep < b.rep group by 1, 2),
links as (select a, b from shared where 100 * k >= {percent} * (na + nb - k)),
edges as (select a, b from links union all select b, a from links),
reach as (select rep as node, rep as seen from classes
  union select e.b, r.seen from reach r join edges e on r.node = e.a),
comp as (select node, min(seen) c from reach group by 1)
"""

CONTAMINATION = """
with b as (select item_id, {words} w from benchmark where item_id is not null),
windows as (select distinct item_id, len(x) n, x from (
  select item_id, unnest(case when len(w) = 0 then [] when len(w) < 10 then [w]
    else list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) end) x from b)),
d as (select doc_id, {words} w from documents),
lengths as (select distinct n from windows),
runs as (select doc_id, n, unnest(range(1, len(w) - n + 2)) i, w from d, lengths where len(w) >= n),
hits as (select r.doc_id, r.i, r.n, x.item_id
  from (select doc_id, n, i, w[i:i + n - 1] x from runs) r join windows x on x.n = r.n and x.x = r.x),
places as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hits) group by 1),
held as (select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) names
  from hits group by 1)
select d.doc_id, len(d.w) n_words, coalesce(p.n_hit, 0) n_hit, coalesce(h.n_items, 0) n_items,
  sha256(coalesce(h.names, '')) items_sha256, coalesce(p.n_hit, 0) > 0 contaminated
from d left join places p using (doc_id) left join held h using (doc_id)
""".format(words=_LETTER_WORDS)

NEAR_VECTORS = """
with recursive v as (select vec_id, label, cast(embedding as double[]) e from embeddings where label is not null and len(embedding) > 0),
valid as (select vec_id, label, e from v where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
  and list_sum(list_transform(e, lambda x: x * x)) > 0),
links as (select a.vec_id a, b.vec_id b from valid a join valid b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach as (select vec_id node, vec_id seen from embeddings union select l.b, r.seen from reach r join links l on l.a = r.node),
comp as (select node, min(seen) c from reach group by 1),
n as (select a, count(*) k from links group by 1)
select m.vec_id, coalesce(n.k, 0) n_links, comp.c component_id, m.vec_id = comp.c kept
from embeddings m join comp on comp.node = m.vec_id left join n on n.a = m.vec_id
"""

_TERMS = _WORDS.format(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")

DIVERGENCE = f"""
with d as (select row_number() over () id, coalesce(lang, '') lang, coalesce(source, '') source, {_TERMS} w from documents),
groups as (select distinct lang, source from d),
tok as (select id, lang, source, unnest(w) term from d),
kept as (select lang, term, count(*) k from tok group by 1, 2 having count(distinct id) >= 10),
c as (select t.lang, t.source, t.term, count(*) k from tok t join kept using (lang, term) group by 1, 2, 3),
vocabulary as (select lang, count(*) v, sum(k) n from kept group by 1),
sizes as (select lang, source, sum(k) n from c group by 1, 2),
rate as (select g.lang, g.source, kept.term, coalesce(c.k, 0) k,
    1 + (1000000000::hugeint * (coalesce(c.k, 0) + 2)) // (coalesce(s.n, 0) + 2 * v.v) p,
    1 + (1000000000::hugeint * (kept.k + 2)) // (v.n + 2 * v.v) q
  from groups g join kept using (lang) join vocabulary v using (lang)
  left join sizes s on s.lang = g.lang and s.source = g.source
  left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
pair as (select g.lang, g.source, h.source item, coalesce(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)), 0) value
  from groups g join groups h on g.lang = h.lang and g.source <> h.source
  left join rate a on a.lang = g.lang and a.source = g.source
  left join rate b on b.lang = h.lang and b.source = h.source and b.term = a.term
  group by 1, 2, 3),
term as (select lang, source, term item, (p - q) * (p - q) // (p + q) value from rate where k > 0 and p > q),
parts as (select 'pair' part, * from pair union all select 'term' part, * from term),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) rank from parts)
select lang, source, part, item, value::bigint value, rank::int rank from ranked where part = 'pair' or rank <= 10
"""

MIX = r"""
with s as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
    md5(concat_ws(':', doc_id::varchar, text, '42')) draw from documents),
g as (select source, sum(size)::hugeint size, row_number() over (order by source nulls last) - 1 place from s group by source),
w as (select *, (case place % 3 when 0 then 5 when 1 then 2 else 1 end)::hugeint weight, 3 * size cap,
    sum(size) over ()::hugeint total from g),
o as (select *, cap::double / weight::double r,
    coalesce(sum(cap) over (order by cap::double / weight::double, place rows between unbounded preceding and 1 preceding), 0)::hugeint clamped,
    sum(weight) over (order by cap::double / weight::double, place rows between current row and unbounded following)::hugeint open from w),
level as (select total - clamped top, open bottom from o where (total - clamped) * weight <= cap * open order by r, place limit 1),
t as (select source, size, case when cap * bottom <= weight * top then cap::double else (weight * top)::double / bottom::double end target,
    case when cap * bottom <= weight * top then cap else (2 * weight * top + bottom) // (2 * bottom) end quota from w, level),
b as (select s.*, t.size source_size, t.target, case when t.size > 0 then t.quota // t.size else 0 end whole,
    case when t.size > 0 then t.quota % t.size else 0 end rest,
    coalesce(sum(s.size) over (partition by s.source order by s.draw, s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0) earlier
  from s join t on s.source is not distinct from t.source)
select doc_id, size, source_size::bigint source_size, target,
  (whole * size + greatest(0, least(size, rest - earlier)))::bigint taken from b
"""

SQL = {
    "op11_source_divergence": DIVERGENCE,
    "op12_source_mix": MIX,
    "op4_near_vectors": NEAR_VECTORS,
    "op3_contamination": CONTAMINATION,
    "op9_ngram_jaccard": JACCARD.format(words=_SPACE_WORDS, width=3, percent=90)
    + """select d.doc_id, len(d.s) as n_shingles, coalesce(comp.c, d.doc_id) as component_id
from sets d left join classes c on len(d.s) > 0 and d.s = c.s left join comp on comp.node = c.rep""",
}
