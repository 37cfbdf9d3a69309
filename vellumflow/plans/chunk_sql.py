"""SQL of structural chunking, for comparison: packing, splitting and merging as recursive walks over numbered rows."""

from __future__ import annotations

from vellumflow.operators.chunking import NAVIGATION, ChunkConfig
from vellumflow.plans.text_queries import _noise_sql

_W = r"[\t-\r\x1c-\x20\x85\p{Z}]"
_END = chr(1)


def _words(t: str) -> str:
    return rf"len(regexp_extract_all({t}, '[^{_W[1:-1]}]+'))"


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^{_W}+|{_W}+$', '', 'g')"


def _sentences(t: str) -> str:
    """List of the trimmed sentences of a text."""
    marked = rf"""regexp_replace({t}, '([.!?…]){_W}+([A-ZÀ-Ú0-9"''(\[])', '\1{_END}\2', 'g')"""
    return f"list_filter(list_transform(string_split({marked}, '{_END}'), lambda s: {_strip('s')}), lambda s: s <> '')"


def _tail(t: str, overlap: int, largest: int) -> str:
    """The end of a text that the next chunk begins with."""
    last = f"coalesce({_strip(f'''list_filter(string_split({t}, chr(10) || chr(10)), lambda p: {_strip('p')} <> '')[-1]''')}, '')"
    sizes = f"list_transform(list_reverse(ss), lambda s: {_words('s')})"
    kept = f"greatest(1, len(list_filter(range(1, len(ss) + 1), lambda k: list_sum(list_slice({sizes}, 1, k)) <= {overlap})))"
    return f"(select case when {_words('p')} between 1 and {min(largest, 2 * overlap)} then p else array_to_string(list_slice(ss, len(ss) - {kept} + 1, len(ss)), ' ') end from (select p, {_sentences('p')} as ss from (select {last} as p)))"


def _walk(name: str, source: str, keys: str, opens: str, more: str = "false") -> str:
    """Recursive CTE ``name``: group number g of each row k of ``source`` (keys, k, n). A row opens a group where ``opens`` holds of its n and p.tot, or where the group was closed by ``more`` of n and the total."""
    on = " and ".join(f"s.{k} = p.{k}" for k in keys.split(", "))
    closed = lambda total: more.replace("@total", total).replace("@n", "s.n")
    new = f"(p.closed or {opens.replace('@n', 's.n')})"
    ks = ", ".join(f"s.{k}" for k in keys.split(", "))
    total = f"(case when {new} then s.n else p.tot + s.n end)"
    return f"""{name} as (select {ks}, s.k, s.n, 0 as g, s.n as tot, {closed('s.n')} as closed from {source} s where s.k = 1
 union all select {ks}, s.k, s.n, p.g + {new}::int, {total}, {closed(total)} from {name} p join {source} s on {on} and s.k = p.k + 1)"""


def structural_sql(cfg: ChunkConfig = ChunkConfig()) -> str:
    """Approved chunks of all blocks under the default modes of a configuration."""
    return f"""{_chunked(cfg)}
select document_id, chunk_index, chunk_id, lag(chunk_id) over (partition by document_id order by chunk_index) as previous_chunk_id, text, sha256(case when coalesce(len(path), 0) > 0 then 'Seção: ' || array_to_string(path, ' > ') || chr(10) || chr(10) || text else text end) as input_sha256,
 tokens::integer as token_count, length(text)::integer as character_count, type as content_type, method as split_method, array_to_string(ids, ',') as block_ids, array_to_string(path, ' > ') as section_path, sk as section_kind, level as heading_level, list_min(pages) as page_start, list_max(pages) as page_end, array_to_string(pages, ',') as page_numbers, ov::integer as overlap_token_count, array_to_string(ov_ids, ',') as overlap_block_ids, more as is_continuation, first::integer as first_item, last::integer as last_item from id"""


def report_sql(cfg: ChunkConfig = ChunkConfig()) -> str:
    """The report on each document's chunks."""
    size = "octet_length(encode(to_json({'chunk_id': chunk_id, 'chunk_index': chunk_index, 'text': text, 'content_type': type})::varchar)) + 1"
    return f"""{_chunked(cfg)},
bt as (select document_id, string_agg(k || '=' || c, ',' order by k) as blocks_by_type from (select document_id, coalesce(kind, 'unknown') as k, count(*) as c from b group by 1, 2) group by 1),
rj as (select document_id, string_agg(reason || '=' || c, ',' order by reason) as rejected_by_reason from (select document_id, reason, count(*) as c from jd where reason <> 'aprovado' group by 1, 2) group by 1),
rk as (select *, row_number() over (partition by document_id order by tokens) - 1 as at_place, count(*) over (partition by document_id) as c from id),
ts as (select document_id, count(*) as chunk_count, round_even(avg(tokens), 2) as avg_tokens, median(tokens) as median_tokens, min(tokens)::integer as min_tokens, max(tokens)::integer as max_tokens, max(case when at_place = floor(c * 0.95) then tokens end)::integer as p95_tokens, count_if(tokens < 80)::bigint as below_min, count_if(tokens > 768)::bigint as above_max,
 sum(ov)::bigint as overlap_tokens, count_if(method = 'sentence')::bigint as sentence_splits, count_if(method = 'token_fallback')::bigint as token_splits, count_if(type = 'table')::bigint as table_chunks, count_if(type = 'list')::bigint as list_chunks, len(list_distinct(flatten(list(pages))))::integer as pages_covered,
 count_if(type in ('paragraph', 'references') and right(regexp_replace(text, '{_W}+$', ''), 1) not in ('.', '!', '?', '…', '”', '"', ')'))::bigint as mid_sentence_cuts, sum({size})::bigint as jsonl_bytes from rk group by 1)
select * from bt left join rj using (document_id) left join ts using (document_id)"""


def _chunked(cfg: ChunkConfig) -> str:
    """CTEs up to jd, all drafts with their reasons, and id, the approved ones with their numbers and ids."""
    hidden = ", ".join(f"'{k}'" for k in ("front_matter", *NAVIGATION))
    exempt = "type in ('table', 'list', 'figure_caption', 'references', 'formula', 'quote', 'footnote')"
    noisy = "type in ('paragraph', 'references', 'quote', 'footnote')"
    complete = rf"""(length(s) >= 20 and regexp_matches(s, '^[A-ZÀ-ÚÄ-Ü0-9"''(\[]') and regexp_matches(s, '[.!?;:]$') and tokens >= 5)"""
    return rf"""with recursive d as (select document_id, block_id, arg_min(b, (ingested_at, lower(coalesce(block_type, '')), page_number)) as r from blocks b group by 1, 2),
b as (select document_id, block_id, lower(r.block_type) as kind, r.text as text, r.order_index as o, r.page_number as page, coalesce(r.section_path, []) as path, r.section_path as shown_path, r.section_kind as sk, r.heading_level as hl, coalesce(r.chunkable, true) as ok, nullif(r.metadata.table_markdown, '') as md, r.metadata.table_caption as caption from d where document_id is not null and block_id is not null),
v as (select *, case when kind in ('heading', 'title') then 'heading' when not ok or coalesce(sk in ({hidden}), false) then 'skip' when kind = 'table' then 'table' when kind = 'list' then 'list' when kind in ('figure_caption', 'figure', 'image') then 'figure' when kind = 'reference' then 'reference' when kind in ('header', 'footer', 'page_number') then 'skip' else 'text' end as role from b where trim(coalesce(text, '')) <> ''),
l as (select *, lag(role) over w as role0, lag(path) over w as path0, last_value(case when role = 'heading' then hl end ignore nulls) over (partition by document_id order by o nulls first, block_id rows between unbounded preceding and 1 preceding) as level from v where role <> 'skip' window w as (partition by document_id order by o nulls first, block_id)),
i as (select *, sum(case when role = 'text' and role0 = 'text' and path0 = path then 0 else 1 end) over (partition by document_id order by o nulls first, block_id rows unbounded preceding) as island from l),
t as (select *, {_words('text')} as n, row_number() over (partition by document_id, island order by o nulls first, block_id) as k from i where role in ('text', 'reference')),
{_walk('pk', 't', 'document_id, island', f'p.tot + @n > {cfg.max_tokens}', f'(@n > {cfg.max_tokens} or @total >= {cfg.target_tokens})')},
tp as (select t.*, pk.g as part from t join pk using (document_id, island, k)),
big as (select document_id, island, part, block_id, unnest({_sentences('text')}) as s, generate_subscripts({_sentences('text')}, 1) as k from tp where n > {cfg.max_tokens}),
bn as (select *, {_words('s')} as n from big),
{_walk('sp', 'bn', 'document_id, island, part', f'p.tot + @n > {cfg.target_tokens}')},
sg as (select document_id, island, part, sp.g, string_agg(s, ' ' order by k) as s, max(bn.n) as n, count(*) as c from bn join sp using (document_id, island, part, k) group by 1, 2, 3, 4),
sx as (select *, unnest(case when c = 1 and n > {cfg.max_tokens} then range(0, n, {cfg.max_tokens}) else [-1] end) as fr from sg),
sl as (select *, case when fr < 0 then s else array_to_string(list_slice(regexp_extract_all(s, '[^{_W[1:-1]}]+'), fr + 1, fr + {cfg.max_tokens}), ' ') end as piece from sx),
sq as (select *, row_number() over (partition by document_id, island, part order by g, fr) as pno, lag(piece) over (partition by document_id, island, part order by g, fr) as piece0 from sl),
st as (select *, case when piece0 is not null then {_tail('piece0', cfg.overlap_tokens, cfg.max_overlap_tokens)} end as head from sq),
sz as (select *, coalesce(head <> '' and {_words('piece')} + {_words('head')} <= {cfg.max_tokens}, false) as fits from st),
dr as (select document_id, island, part, 0 as pno, string_agg(text, chr(10) || chr(10) order by k) as text, arg_min(role, k) as role, 'block' as method, 0 as ov, []::varchar[] as ov_ids from tp where n <= {cfg.max_tokens} group by 1, 2, 3
 union all select z.document_id, z.island, z.part, pno, case when fits then head || chr(10) || chr(10) || piece else piece end, role, case when fr < 0 then 'sentence' else 'token_fallback' end, case when fits then {_words('head')} else 0 end, case when fits then [block_id] else []::varchar[] end from sz z join tp using (document_id, island, part)),
dn as (select *, {_words('text')} as n, row_number() over (partition by document_id, island order by part, pno) as k from dr),
{_walk('mg', 'dn', 'document_id, island', f'@n >= {cfg.min_tokens} or p.tot + @n > {cfg.max_tokens}')},
gm as (select dn.*, mg.g from dn join mg using (document_id, island, k)),
gb as (select distinct gm.document_id, gm.island, gm.g, tp.block_id, tp.page, tp.k, tp.o from gm join tp on tp.document_id = gm.document_id and tp.island = gm.island and tp.part = gm.part),
gl as (select document_id, island, g, list(block_id order by k) as ids, list_sort(list_distinct(list(page) filter (page is not null))) as pages, min(k) as k from gb group by 1, 2, 3),
gt as (select document_id, island, g, string_agg(text, chr(10) || chr(10) order by gm.k) as text, arg_min(role, gm.k) as role, arg_min(method, gm.k) as method, arg_min(ov, gm.k) as ov, arg_min(ov_ids, gm.k) as ov_ids from gm group by 1, 2, 3),
ga as (select gt.*, gl.ids, gl.pages, tp.o, tp.block_id as b0, tp.shown_path as path, tp.sk, tp.level, {_words('gt.text')} as n from gt join gl using (document_id, island, g) join tp on tp.document_id = gl.document_id and tp.island = gl.island and tp.k = gl.k),
gv as (select *, lag(text) over w as text0, lag(role) over w as role0, lag(ids) over w as ids0 from ga window w as (partition by document_id, island order by g)),
gh as (select *, case when role = 'text' and role0 = 'text' then {_tail('text0', cfg.overlap_tokens, cfg.max_overlap_tokens)} end as head from gv),
gf as (select *, coalesce(head <> '' and n + {_words('head')} <= {cfg.max_tokens}, false) as fits from gh),
tl as (select document_id, block_id, island, string_split(md, chr(10)) as x from i where role = 'table' and md is not null and {_words('text')} > {cfg.table_max_tokens}),
ty as (select document_id, block_id, island, unnest(list_filter(x, lambda y: {_strip('y')} <> '')) as y, generate_subscripts(list_filter(x, lambda y: {_strip('y')} <> ''), 1) as j from tl),
tz as (select *, j = 1 or regexp_matches(y, '^{_W}*\|?(?:{_W}|[\-:|])+\|?{_W}*$') as rule from ty),
th as (select document_id, block_id, string_agg(y, chr(10) order by j) as head, sum({_words('y')}) as hn from tz where rule group by 1, 2),
tr as (select document_id, block_id, island, y, {_words('y')} as n, row_number() over (partition by document_id, block_id order by j) as k from tz where not rule),
tn as (select tr.*, hn + coalesce({_words('caption')}, 0) as hn, head, caption from tr join th using (document_id, block_id) join i using (document_id, block_id)),
{_walk('tg', 'tn', 'document_id, block_id', f'p.tot + @n > {cfg.table_max_tokens} - s.hn')},
tc as (select document_id, block_id, tg.g, any_value(case when caption <> '' then caption || chr(10) else '' end || head) || chr(10) || string_agg(y, chr(10) order by k) as text, min(k) - 1 as first, max(k) as last from tn join tg using (document_id, block_id, k) group by 1, 2, 3),
li as (select document_id, block_id, unnest(list_filter(string_split(text, chr(10)), lambda y: {_strip('y')} <> '')) as y, generate_subscripts(list_filter(string_split(text, chr(10)), lambda y: {_strip('y')} <> ''), 1) as k from i where role = 'list' and {_words('text')} > {cfg.list_max_tokens}),
lm as (select *, {_words('y')} as n from li),
{_walk('lg', 'lm', 'document_id, block_id', f'p.tot + @n > {cfg.list_max_tokens}')},
lc as (select document_id, block_id, lg.g, string_agg(y, chr(10) order by k) as text, min(k) as first, max(k) as last from lm join lg using (document_id, block_id, k) group by 1, 2, 3),
al as (select document_id, block_id, g, text, first, last, 'table_rows' as method from tc union all select document_id, block_id, g, text, first, last, 'list_items' from lc
 union all select document_id, block_id, 0, text, case role when 'table' then 0 else 1 end, case role when 'figure' then 1 when 'list' then len(list_filter(string_split(text, chr(10)), lambda y: {_strip('y')} <> '')) else len(list_filter(list_transform(list_filter(string_split(coalesce(md, case when contains(text, '|') then text end, ''), chr(10)), lambda y: contains(y, '|')), lambda y: string_split(regexp_replace({_strip('y')}, '^\|+|\|+$', '', 'g'), '|')), lambda r: len(list_filter(r, lambda c: not regexp_matches({_strip('c')}, '^[\s\-:]*$'))) > 0)) end, 'block'
  from i where role in ('table', 'list', 'figure') and not exists (select 1 from tc where tc.document_id = i.document_id and tc.block_id = i.block_id) and not exists (select 1 from lc where lc.document_id = i.document_id and lc.block_id = i.block_id)),
a1 as (select *, count(*) over (partition by document_id, block_id) as c from al),
every as (select document_id, island, g, o, b0, case when fits then head || chr(10) || chr(10) || text else text end as text, case role when 'reference' then 'references' else 'paragraph' end as type, method, ids, pages, path, sk, level, case when fits then {_words('head')} else ov end as ov, case when fits then ids0 else ov_ids end as ov_ids, null::bigint as first, null::bigint as last, false as more from gf
 union all select document_id, island, a1.g, o, block_id, a1.text, case role when 'figure' then 'figure_caption' else role end, case when c = 1 then 'block' else method end, [block_id], case when page is null then []::integer[] else [page] end, shown_path, sk, hl, 0, []::varchar[], first, last, a1.g > 0 from a1 join i using (document_id, block_id)),
ev as (select *, {_strip('text')} as s, {_words('text')} as tokens from every),
jd as (select *, case when type <> 'table' and tokens > {cfg.force_split_above_tokens} then 'too_large' when s = '' then 'vazio' when not {exempt} and length(regexp_replace(text, '[^a-zA-ZÀ-ÿ0-9]', '', 'g')) < 10 then 'sem_corpo_textual' when {noisy} and round_even({_noise_sql('text')}, 2) >= 0.65 then 'ruido_ocr_excessivo' when not {exempt} and tokens < 10 and not {complete} then 'abaixo_do_minimo_de_tokens' else 'aprovado' end as reason from ev),
nm as (select *, (row_number() over (partition by document_id order by o nulls first, b0, island, g) - 1)::integer as chunk_index from jd where reason = 'aprovado'),
id as (select *, sha256(concat_ws('|', document_id, '', '', '{cfg.chunking_version}', '{cfg.hash}', chunk_index::varchar, sha256(trim(regexp_replace(text, '{_W}+', ' ', 'g'))))) as chunk_id from nm)"""


_ONCE = """d as (select document_id, block_id, arg_min(b, (ingested_at, lower(coalesce(block_type, '')), page_number)) as r from blocks b group by 1, 2)"""


def capitals_sql(t: str) -> str:
    """Spaced capitals joined, then white space squashed, token by token."""
    parts = f"string_split_regex(coalesce({t}, ''), '{_W}')"
    goes = r"regexp_matches(w[i], '(^|[^\p{L}\p{N}_])[A-ZÀ-Ú]$') and coalesce(regexp_matches(w[i + 1], '^[A-ZÀ-Ú]$'), false)"
    glued = f"list_transform(range(1, len(w) + 1), lambda i: w[i] || case when {goes} then '' else ' ' end)"
    return f"(select trim(regexp_replace(array_to_string({glued}, ''), ' +', ' ', 'g')) from (select {parts} as w))"


def _rejected(t: str, kind: str) -> str:
    """Whether the older strategy's rules reject a text."""
    s, words = _strip(t), _words(t)
    urls = rf"""length(array_to_string(regexp_extract_all({t}, '(?i)https?://[^\s<>"'']+|www\.[^\s<>"'']+'), ''))"""
    lines = f"list_filter(list_transform(string_split({t}, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"
    cells = "(contains(x, '|') or contains(x, chr(9)))"
    rows = rf"len(list_filter({lines}, lambda x: {cells} and not regexp_matches(x, '^\|?[\s\-:]+\|')))"
    caption = f"len(list_filter(list_slice({lines}, 1, 2), lambda x: lower(x) like 'tabela%' or lower(x) like 'table%')) > 0"
    outside = f"length(array_to_string(list_filter({lines}, lambda x: not {cells}), ' '))"
    solid = f"length(regexp_replace({t}, '{_W}', '', 'g'))"
    complete = rf"""(length({s}) >= 20 and regexp_matches({s}, '^[A-ZÀ-ÚÄ-Ü0-9"''(\[]') and regexp_matches({s}, '[.!?;:]$') and {words} >= 5)"""
    return rf"""(length(regexp_replace({t}, '[^a-zA-ZÀ-ÿ0-9]', '', 'g')) < 10 or {s} = '' or coalesce({solid} > 0 and {urls} / {solid}::double > 0.85, false)
 or (length({s}) <= 120 and not contains({s}, chr(10)) and not regexp_matches({s}, '[.!?;:]$')) or ({kind} = 'table' and {rows} < 2 and not ({caption}) and {outside} < 50) or round_even({_noise_sql(t)}, 2) >= 0.65 or {words} < 10 or (length({t}) < 300 and not {complete}))"""


def legacy_sql(largest: int = 1200, overlap: int = 250) -> str:
    """The older strategy on all blocks: sections carried, texts filtered, long ones cut by characters, parts filtered."""
    cut = f"right(p.cur, {overlap})"
    space = f"(strpos({cut}, ' ') - 1)"
    head = f"case when {space} > 0 and {space} < length({cut}) // 2 then {_strip(f'substr({cut}, {space} + 1)')} else {cut} end"
    over = f"length(p.cur) + length(s.s) > {largest}"
    fresh = _strip(f"{head} || ' ' || s.s")
    return rf"""with recursive {_ONCE},
b as (select document_id, block_id, r.order_index as position, case when lower(r.block_type) in ('heading', 'table') then lower(r.block_type) else 'paragraph' end as type, r.text as text from d),
c as (select *, coalesce(last_value(case when type = 'heading' then trim(text) end ignore nulls) over (partition by document_id order by position nulls first rows unbounded preceding), 'Introdução') as section from b),
k as (select document_id, position, block_id, type, section, case when type = 'table' then coalesce(text, '') else {capitals_sql('text')} end as t, text as raw from c where type <> 'heading'),
f as (select * from k where not {_rejected('t', 'type')}),
u as (select document_id, block_id, unnest(string_split(regexp_replace(t, '([.!?]){_W}+', '\1{_END}', 'g'), '{_END}')) as s, generate_subscripts(string_split(regexp_replace(t, '([.!?]){_W}+', '\1{_END}', 'g'), '{_END}'), 1) as k from f where type <> 'table' and length(t) > {largest}),
z as (select document_id, block_id, k, 0 as part, null::varchar as done, case when length(s) > {largest} then {_strip('s')} else s end as cur from u where k = 1
 union all select s.document_id, s.block_id, s.k, p.part + (case when {over} then 1 else 0 end), case when {over} then {_strip('p.cur')} end, case when {over} then {fresh} when p.cur = '' then s.s else p.cur || ' ' || s.s end from z p join u s on s.document_id = p.document_id and s.block_id = p.block_id and s.k = p.k + 1),
parts as (select document_id, block_id, part - 1 as part, done as text from z where done is not null union all select document_id, block_id, part, {_strip('cur')} from (select *, row_number() over (partition by document_id, block_id order by k desc) as back from z) where back = 1),
w as (select document_id, position, 0 as part, section, type, case when type = 'table' then raw else t end as text from f where type = 'table' or length(t) <= {largest}
 union all select f.document_id, position, parts.part, section, type, text from parts join f using (document_id, block_id) where not {_rejected('text', 'type')})
select document_id, position, part::integer as part, section, type, text from w"""


def page_merge_sql(tolerance: float = 0.12) -> str:
    """Paragraphs put together over page breaks, as a walk along each run of paragraphs that may go on."""
    far = f"coalesce(len(s.box) >= 4 and len(p.box) >= 4 and abs(p.box[1] - s.box[1]) > greatest(60.0, {tolerance} * greatest(p.box[3], s.box[3], 1.0)), false)"
    joins = f"(coalesce(s.page > p.page, false) and not {far})"
    left = f"regexp_replace(p.t, '{_W}+$', '')"
    right = f"regexp_replace(s.t, '^{_W}+', '')"
    glued = f"case when regexp_matches({left}, '[A-Za-zÀ-ÿ]-$') then left({left}, -1) || {right} else {left} || ' ' || {right} end"
    return rf"""with recursive {_ONCE},
b as (select document_id, block_id, r.order_index as o, lower(r.block_type) as kind, coalesce(r.text, '') as t, r.page_number as page, r.bbox as box, {{'p': coalesce(r.section_path, []), 'k': coalesce(r.section_kind, '')}} as path from d),
l as (select *, lag(kind) over w as kind0, lag(path) over w as path0, lag(t) over w as t0 from b window w as (partition by document_id order by o nulls first, block_id)),
j as (select *, coalesce(kind = 'paragraph' and kind0 = 'paragraph' and path = path0 and page is not null and not regexp_matches(t0, '[.!?:;”"''\)\]]\s*$') and regexp_matches(t, '^\s*(?:R\$|US\$|[a-zà-ÿ0-9(%,\-–—])'), false) as goes from l),
r as (select *, sum((not goes)::int) over (partition by document_id order by o nulls first, block_id rows unbounded preceding) as run from j),
s as (select *, row_number() over (partition by document_id, run order by o nulls first, block_id) as k from r),
z as (select document_id, run, k, o, 0 as g, page, box, t, [block_id] as ids, [page] as pages from s where k = 1
 union all select s.document_id, s.run, s.k, case when {joins} then p.o else s.o end, p.g + (not {joins})::int, case when {joins} then p.page else s.page end, case when {joins} then p.box else s.box end, case when {joins} then {glued} else s.t end, case when {joins} then list_append(p.ids, s.block_id) else [s.block_id] end, case when {joins} then list_append(p.pages, s.page) else [s.page] end from z p join s on s.document_id = p.document_id and s.run = p.run and s.k = p.k + 1),
e as (select *, row_number() over (partition by document_id, run, g order by k desc) as back from z)
select document_id, o as order_index, array_to_string(ids, ',') as block_ids, array_to_string(list_sort(list_distinct(pages)), ',') as pages, t as text from e where back = 1 and len(ids) > 1"""
