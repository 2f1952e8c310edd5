"""SQL that checks the queries it can express over whole tables in useful time."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

SUBSTRING_DEDUP = f"""
with split as (
  select doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) as ws from documents
),
placed as (
  select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from split
),
windows as (
  select doc_id, i, array_to_string(ws[i:i + 12], ' ') as w from placed
),
firsts as (select w, min(doc_id) as first_doc from windows group by w),
gone as (
  select distinct doc_id, i + k as pos
  from windows join firsts using (w) cross join range(13) as r(k)
  where first_doc < doc_id
),
words as (
  select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from split
),
kept as (
  select doc_id, string_agg(word, ' ' order by pos) as text
  from words anti join gone using (doc_id, pos) group by doc_id
),
removed as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, len(ws) as n_words, coalesce(removed.n, 0) as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from split left join removed using (doc_id) left join kept using (doc_id)
"""

ADAPTIVE_JACCARD = f"""
with recursive split as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    {_WORDS}) as ws
  from documents
),
placed as (
  select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) as i from split
),
shingles as (select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as s from placed),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b using (s) where a.doc_id < b.doc_id group by all
),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * c >= 85 * (p.n + q.n - c)
),
edges as (select x, y from links union all select y, x from links),
reached(node, origin) as (
  select doc_id, doc_id from documents
  union
  select edges.y, origin from reached join edges on node = edges.x
),
least as (select node, min(origin) as component_id from reached group by node)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from split left join sizes using (doc_id) join least on node = doc_id
"""

SMALL_WORLD_LINKS = """
with recursive vectors as (
  select vec_id, embedding::double[] as v,
         case when list_count(v) = len(v) then sqrt(list_dot_product(v, v)) end as norm
  from embeddings
),
good as (
  select * from vectors
  where norm > 0 and isfinite(norm)
),
links as (
  select a.vec_id as x, b.vec_id as y
  from good a join good b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_dot_product(a.v, b.v) >= 0.9 * a.norm * b.norm
),
reached(node, origin) as (
  select vec_id, vec_id from embeddings
  union
  select links.y, origin from reached join links on node = links.x
),
least as (select node, min(origin) as component_id from reached group by node),
counts as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join least on node = vec_id left join counts on x = vec_id
"""


# --- manifest: leaves, then one level after another, then the languages in the same way

#: Levels that the SQL can climb: trees of up to 8 ** MANIFEST_LEVELS leaves.
MANIFEST_LEVELS = 6


def _told(column: str) -> str:
    text = f"cast({column} as varchar)"
    return f"coalesce(cast(strlen({text}) as varchar) || ':' || {text}, '-')"


def _manifest_leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_told, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _climbed(prefix: str) -> str:
    """Levels of the trees in ``{prefix}0``: ``tree``, ``idx``, ``h`` and ``n``, the nodes of the
    tree on that level. A tree of one node climbs no further."""
    return ",\n".join(
        f"""{prefix}{k + 1} as (
  select tree, idx // 8 as idx, sha256(string_agg(h, '' order by idx)) as h, (n + 7) // 8 as n
  from {prefix}{k} where n > 1 group by tree, idx // 8, n
)"""
        for k in range(MANIFEST_LEVELS)
    )


def _roots(prefix: str) -> str:
    levels = range(MANIFEST_LEVELS + 1)
    return " union all ".join(f"select tree, h from {prefix}{k} where n = 1" for k in levels)


def _siblings(prefix: str) -> str:
    """Siblings of every node of ``{prefix}0`` before and after, level by level."""
    return " union all ".join(
        f"""select z.tree, z.idx, {k} as level,
  coalesce(string_agg(s.h, '' order by s.idx) filter (where s.idx < a.idx), '') as before,
  coalesce(string_agg(s.h, '' order by s.idx) filter (where s.idx > a.idx), '') as after
from {prefix}0 z
join {prefix}{k} a on a.tree = z.tree and a.idx = z.idx // {8**k} and a.n > 1
join {prefix}{k} s on s.tree = a.tree and s.idx // 8 = a.idx // 8
group by z.tree, z.idx"""
        for k in range(MANIFEST_LEVELS)
    )


def _folded() -> str:
    """Columns f1, f2, ...: the shown leaf carried up one level after another."""
    node = "shown"
    for k in range(2 * MANIFEST_LEVELS):
        node = f"f{k}"
        below = "shown" if k == 0 else f"f{k - 1}"
        level = f"path[{k + 1}]"
        step = f"sha256({level}.before || {below} || {level}.after)"
        yield f"case when len(path) > {k} then {step} else {below} end as {node}"


def _nested(select: str) -> str:
    for column in _folded():
        select = f"select *, {column} from ({select})"
    return select


#: CRC-32 of the bytes of a decimal number, bit by bit.
_BIT = "case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end"


def _crc(value: str) -> str:
    step = "xor(c, b)"
    body = f"list_reduce([{step}, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {_BIT})"
    codes = f"list_transform(string_split({value}, ''), lambda ch: cast(ascii(ch) as bigint))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {codes}), lambda c, b: {body}), 4294967295)"


INCREMENTAL_MANIFEST = f"""
with leaves as (
  select doc_id, lang, {_manifest_leaf("text")} as h,
         case when {_crc("cast(doc_id as varchar)")} % 3 = 0
              then {_manifest_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         end as tampered
  from documents
),
named as (
  select *, coalesce('=' || lang, '-') as tree,
         row_number() over (partition by lang order by doc_id nulls first, h) - 1 as idx,
         count(*) over (partition by lang) as n
  from leaves
),
t0 as (select tree, idx, h, n from named),
{_climbed("t")},
subroots as ({_roots("t")}),
l0 as (
  select '' as tree, row_number() over (order by tree) - 1 as idx, h, count(*) over () as n,
         tree as key
  from subroots
),
{_climbed("l")},
top as ({_roots("l")}),
low as ({_siblings("t")}),
high as ({_siblings("l")}),
low_paths as (
  select tree, idx, list(struct_pack(before, after) order by level) as path from low group by tree, idx
),
high_paths as (
  select l0.key as tree, list(struct_pack(high.before, high.after) order by level) as path
  from high join l0 on l0.idx = high.idx group by l0.key
),
paths as (
  select d.doc_id, d.h as leaf, coalesce(d.tampered, d.h) as shown, s.h as subroot,
         (select h from top) as root,
         list_concat(coalesce(a.path, []), coalesce(b.path, [])) as path
  from named d join subroots s on s.tree = d.tree
  left join low_paths a on a.tree = d.tree and a.idx = d.idx
  left join high_paths b on b.tree = d.tree
)
select doc_id, leaf, subroot, root,
       sha256(list_aggregate(list_prepend('', list_transform(path, lambda p: p.before || p.after)), 'string_agg', '')) as proof_sha256,
       f{2 * MANIFEST_LEVELS - 1} as folded_root, f{2 * MANIFEST_LEVELS - 1} = root as verified
from ({_nested("select * from paths")})
"""
