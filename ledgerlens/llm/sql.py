"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from ledgerlens.llm.licences import LEAST, REPEATS, TEMPLATES, words_of

# one order of all documents of a source, and running sums over it, instead of cells and cuts
_MIXING = r"""
with recursive sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size from documents
), sums as (
  select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) - 1 n from sized group by source
), weighted as (
  select *, (n % 3 + 1)::bigint w from sums
), limits as (
  select a.source, a.source_size, a.n, a.w,
    (sum(a.source_size) over () - coalesce((select sum(3 * b.source_size) from weighted b where (b.source_size / b.w, b.n) < (a.source_size / a.w, a.n)), 0))::double
    / (sum(a.w) over () - coalesce((select sum(b.w) from weighted b where (b.source_size / b.w, b.n) < (a.source_size / a.w, a.n)), 0))::double share
  from weighted a
), level as (
  select arg_min(share, (source_size / w, n)) share from limits where share * w <= 3 * source_size
), plan as (
  select source, source_size, n, least(coalesce(level.share * w, 0), 3 * source_size)::double target from limits, level
), goals as (
  select *, round(target)::bigint // greatest(source_size, 1) passes, round(target)::bigint % greatest(source_size, 1) want from plan
), keyed as (
  select s.doc_id, s.size, g.*, md5('mix:' || coalesce(s.doc_id::varchar, '-')) r
  from sized s join goals g on s.source is not distinct from g.source
), ordered as (
  select *, md5('mix:block:' || n || ':' || r[1:2])[1:8] || r[1:2] || md5('mix:block:' || n || ':' || r[1:4])[1:8] || r[3:4]
    || md5('mix:block:' || n || ':' || r[1:6])[1:8] || r[5:6] || r place from keyed
), run as (
  select *, sum(size) over (partition by n order by place) upto from ordered
), first as (
  select *, upto <= want and want > 0 taken,
    want - coalesce(max(upto) filter (upto <= want) over (partition by n), 0) gap from run
), last as (
  select n, arg_min(doc_id, (abs(size - gap), place)) doc_id from first where not taken and abs(size - gap) < gap group by n
)
, passed as (
  select f.*, f.taken or l.doc_id is not null partial, f.place[1:10] block
  from first f left join last l on l.n = f.n and l.doc_id = f.doc_id
), blocks as (
  select n, block, max(passes) + max(partial::int) times from passed group by n, block
), tickets as (
  select n, block, epoch, row_number() over (partition by n order by md5('mix:ticket:' || n || ':' || block || ':' || epoch), block, epoch) - 1 spot
  from (select n, block, unnest(range(times::bigint)) epoch from blocks)
), tree as (
  -- a node of the tree: how many blocks of each source it has, how many of them went left so far
  select 0 as level, 0::bigint shard, (select list(coalesce(c, 0) order by p.n) from (select distinct n from plan) p
    left join (select n, count(*) c from tickets group by n) t on t.n = p.n) blocks, []::bigint[] lefts
  union all
  select case when done then level + 1 else level end, case when done then 2 * shard + side else shard end,
    case when not done then blocks when side = 0 then lefts else list_transform(blocks, lambda b, i: b - lefts[i]) end,
    case when done then []::bigint[] else list_append(lefts, drawn) end
  from (
    select *, first + len(list_filter(range(len(ps)), lambda i: list_sum(ps[1:i + 1]) < u * list_sum(ps)))::bigint drawn
    from (
      select *, list_transform(range(first, least(d, k) + 1), lambda x:
        exp(lgamma(mode + 1) + lgamma(k - mode + 1) + lgamma(d - mode + 1) + lgamma(n - k - d + mode + 1)
          - lgamma(x + 1) - lgamma(k - x + 1) - lgamma(d - x + 1) - lgamma(n - k - d + x + 1))) ps
      from (
        select *, greatest(0, d + k - n) as first, least(d, k, greatest(0, d + k - n, ((d + 1) * (k + 1)) // (n + 2))) as mode,
          ('0x' || md5('mix:split' || level || ':' || shard || ':' || len(lefts))[1:13])::bigint::double / 4503599627370496 u
        from (
          select level, shard, blocks, lefts, len(lefts) = len(blocks) done,
            coalesce(list_sum(blocks[len(lefts) + 1:]), 0)::bigint n, coalesce(blocks[len(lefts) + 1], 0) k,
            coalesce(list_sum(blocks), 0)::bigint // 2 - coalesce(list_sum(lefts), 0)::bigint d
          from tree where level < 4
        )
      )
    )
  ), (values (0), (1)) sides(side)
  where done or side = 0
), shards as (
  select shard, n, count, sum(count) over (partition by n order by shard) upto
  from (select shard, unnest(range(len(blocks))) n, unnest(blocks) count from tree where level = 4)
), dealt as (
  select t.n, t.block, t.epoch, s.shard from tickets t join shards s on s.n = t.n and t.spot < s.upto and t.spot >= s.upto - s.count
), copied as (
  select p.n, p.doc_id, string_agg(d.epoch || ':' || d.shard, ',' order by d.epoch) copies
  from (select distinct n, doc_id, block, passes, partial from passed) p
  join dealt d on d.n = p.n and d.block = p.block and (d.epoch < p.passes or p.partial) group by p.n, p.doc_id
)
select p.doc_id, p.size, p.source_size, p.target, (p.size * (p.passes + p.partial::int))::bigint taken, coalesce(c.copies, '') copies
from passed p left join copied c on c.n = p.n and c.doc_id is not distinct from p.doc_id
"""

_VECTORS = """
with recursive given as (
  select vec_id, embedding::double[] e from embeddings
), usable as (
  select vec_id, e, sqrt(list_dot_product(e, e)) length from given
  where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id a, b.vec_id b from usable a join usable b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.length * b.length) >= 0.95
), reached as (
  select vec_id a, vec_id b from embeddings union select r.a, l.b from reached r join links l on r.b = l.a
), groups as (
  select a vec_id, min(b) component_id from reached group by a
)
select g.vec_id, (select count(*) from links l where l.a = g.vec_id)::bigint n_links, g.component_id, g.vec_id = g.component_id kept
from groups g
"""

_NEAR_DUPLICATES = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] else
    list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) end s from words
), parts as (
  select doc_id, len(s) n, unnest(s) part from sets
), common as (
  select a.doc_id a, b.doc_id b, a.n an, b.n bn, count(*) c from parts a join parts b on a.part = b.part and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n
), links as (
  select a, b from common where 100 * c >= 75 * (an + bn - c)
), reached as (
  select doc_id a, doc_id b from documents union select r.a, l.b from reached r join links l on r.b = l.a
), groups as (
  select a doc_id, min(b) component_id from reached group by a
)
select doc_id, len(s)::bigint n_shingles, component_id, doc_id = component_id kept from sets join groups using (doc_id)
"""

_ARCHIVES = """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint payload_bytes, sha1(coalesce(html, '')) hex from pages
), bits as (
  select *, array_to_string(list_transform(range(1, 41), lambda i: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', hex[i]) - 1)::int + 1, 4)), '') b
  from payloads
), named as (
  select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * b[5 * i + 1]::int + 8 * b[5 * i + 2]::int + 4 * b[5 * i + 3]::int + 2 * b[5 * i + 4]::int + b[5 * i + 5]::int, 1)), '') payload_digest
  from bits
), kept as (
  select *, max(page_id) over (partition by payload_digest) keeper from named
)
select page_id, payload_bytes, payload_digest, case when page_id = keeper then 'response' else 'revisit' end record_type,
  case when page_id <> keeper then keeper end refers_to
from kept
"""

_NEGATIVES = """
with given as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
    list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id anchor_id, b.vec_id, a.label = b.label same, list_dot_product(a.v, b.v)::bigint score
  from given a join given b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id positive_id, score positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
  select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank,
    vec_id negative_id, positive_score, score negative_score
  from positives p join scored s on s.anchor_id = p.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
)
select * from ranked where rank <= 10
"""

# the checksum byte by byte over a table of 256, for each distinct run of words
_RESAMPLING = r"""
with given as (
  select 0 side, row_number() over () r, doc_id, text from documents union all select 1, row_number() over (), null, text from benchmark
), worded as (
  select side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from given
), features as (
  select side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) f from worded
), steps as (
  select list(x order by i) t from (
    select i, list_reduce(list_concat([i], range(8)), lambda x, k: xor(x // 2, (x % 2) * 3988292384)) x
    from (select unnest(range(256)) i))
), hashed as (
  select f, xor(list_reduce(list_concat([4294967295], list_transform(range(0, octet_length(encode(f))), lambda i: ('0x' || hex(encode(f))[2 * i + 1:2 * i + 2])::bigint)),
    lambda x, b: xor(x // 256, t[xor(x % 256, b) + 1])), 4294967295) % 10000 bucket
  from (select distinct f from features), steps
), filled as (
  select bucket, count(*) filter (side = 0) s, count(*) filter (side = 1) t from features join hashed using (f) group by bucket
), totals as (
  select coalesce(sum(s), 0) s, coalesce(sum(t), 0) t from filled
), gains as (
  select bucket, floor(1000 * ln((f.t + 1)::double * (a.s + 10000)::double / ((f.s + 1)::double * (a.t + 10000)::double)))::bigint gain from filled f, totals a
), weights as (
  select r, count(*) n, floor(sum(gain)::double / count(*))::bigint weight
  from features join hashed using (f) join gains using (bucket) where side = 0 group by r
), scored as (
  select doc_id, len(w) words, coalesce(n, 0)::bigint n_features, coalesce(weight, 0)::bigint weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint score
  from worded left join weights using (r) where side = 0
), ordered as (
  select *, case when words >= 20 then row_number() over (partition by words >= 20 order by score desc, doc_id) end place from scored
)
select doc_id, n_features, weight, score, case when place <= (select 25 * count(*) // 100 from scored where words >= 20) then place end as rank from ordered
"""

_TEMPLATE_ROWS = ", ".join(f"({i}, '{name}', '{' '.join(words_of(text))}')" for i, (name, text) in enumerate(TEMPLATES))

# a row for each place of a text, each pair of places that a passage may start and end at, and the passages kept so far
_LICENCES = rf"""
with recursive templates(t, licence, words) as (values {_TEMPLATE_ROWS}
), known as (
  select t, licence, unnest(b) b, len(b) size, floor(len(b) * {200 - LEAST} / {LEAST})::int longest from (
    select t, licence, list_distinct(list_transform(range(1, len(string_split(words, ' '))),
      lambda i: string_split(words, ' ')[i] || ' ' || string_split(words, ' ')[i + 1])) b from templates)
), texts as (
  select row_number() over () r, doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') w from documents
), cut as (
  select r, unnest(range(len(w) - 1)) i, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) b from texts where len(w) > 1
), hits as (
  select r, i, t from cut join known using (b)
), likely as (
  select r, t, any_value(size) size, any_value(longest) longest, any_value(licence) licence from cut join known using (b)
  group by r, t having count(distinct b) * {200 - LEAST} >= any_value(size) * {LEAST}
), places as (
  select *, coalesce(lag(i) over (partition by r, b order by i), -1) last from cut where r in (select r from likely)
), grown as (
  select l.r, l.t, l.size, l.longest, l.licence, h.i s, p.i e, p.last < h.i fresh, x.i is not null hit,
    sum((p.last < h.i)::int) over w d, sum((p.last < h.i and x.i is not null)::int) over w c
  from likely l join hits h on h.r = l.r and h.t = l.t
  join places p on p.r = l.r and p.i >= h.i and p.i < h.i + {REPEATS} * l.longest
  left join hits x on x.r = l.r and x.t = l.t and x.i = p.i
  window w as (partition by l.r, l.t, h.i order by p.i rows between unbounded preceding and current row)
), spans as (
  select r, t, licence, s, e, c * 2 / (d + size) dice, e - s length from grown where fresh and hit and d <= longest
  qualify row_number() over (partition by r, t, s order by c / (d + size) desc, e desc) = 1 and c * 200 >= (d + size) * {LEAST}
), ranked as (
  select r, licence, s, e, dice, row_number() over (partition by r order by dice desc, length desc, s desc, e desc, licence desc) n from spans
), kept as (
  select r, n, [{{'s': s, 'e': e, 'licence': licence, 'dice': dice}}] found from ranked where n = 1
  union all
  select k.r, a.n, case when len(list_filter(k.found, lambda f: f.s <= a.e and a.s <= f.e)) > 0 then k.found
    else list_append(k.found, {{'s': a.s, 'e': a.e, 'licence': a.licence, 'dice': a.dice}}) end
  from kept k join ranked a on a.r = k.r and a.n = k.n + 1
), matches as (
  select r, unnest(arg_max(found, n)) m from kept group by r
)
select d.doc_id, coalesce(m.licences, '') licences, coalesce(m.best_dice, 0)::double best_dice
from texts d left join (
  select r, string_agg(distinct m.licence, ',' order by m.licence) licences, max(m.dice) best_dice from matches group by r
) m on m.r = d.r
"""

ORACLES = {
    "op1_vectors": _VECTORS,
    "op5_mixing": _MIXING,
    "op6_licences": _LICENCES,
    "op8_near_duplicates": _NEAR_DUPLICATES,
    "op10_archives": _ARCHIVES,
    "op11_negatives": _NEGATIVES,
    "op13_resampling": _RESAMPLING,
}
