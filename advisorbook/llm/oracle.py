"""SQL, for DuckDB, of the queries that SQL can express."""


def _spans(kind: str, pattern: str, keep: str = ".*") -> str:
    """Rows of doc_id, kind, start and end of each match, from pieces and matches of the text."""
    return f"""
    select doc_id, '{kind}' as kind, z.s as s, z.s + length(z.m) as e from (
      select doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
        s := list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
        m := m[i]))) as z
      from (select doc_id, regexp_extract_all(t, '{pattern}') as m, string_split_regex(t, '{pattern}') as p
            from (select doc_id, coalesce(text, '') as t from documents)))
    where regexp_full_match(z.m, '{keep}')"""


_KEYWORDS = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?"
)

_OP1 = f"""
with spans as ({_spans("assign", _KEYWORDS + "[A-Za-z0-9+/_.=-]+", _KEYWORDS + "[A-Za-z0-9+/_.=-]{12,}")}
  union all {_spans("access", "AKIA[A-Z0-9]{14,}")}
  union all {_spans("hex", "[0-9a-f]{16,}")}
  union all {_spans("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----")}),
ranked as (select *, kind || ':' || s || ':' || e as told,
  case kind when 'assign' then 0 when 'access' then 1 when 'hex' then 2 else 3 end as k from spans),
found as (select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
  count(*) filter (kind = 'hex') as n_hex, string_agg(told, ',' order by s, k) filter (k < 3) as base,
  string_agg(told, ',' order by s, k) as spans from ranked group by doc_id)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join found using (doc_id)"""

_OP4 = """
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
sets as (
  select doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [w]
    else list_transform(range(1, len(w) - 1), lambda i: w[i:i+2]) end)) as s from words),
classes as (select s, min(doc_id) as c, len(s) as n from sets where len(s) > 0 group by s),
shingles as (select c, n, unnest(s) as g from classes),
links as (
  select a.c as a, b.c as b from shingles a join shingles b on a.g = b.g and a.c <> b.c
  where 10 * a.n >= 9 * b.n and 10 * b.n >= 9 * a.n
  group by a.c, b.c, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (select c as a, c as b from classes union select r.a, l.b from reach r join links l on r.b = l.a),
roots as (select a, min(b) as root from reach group by a)
select d.doc_id, len(d.s)::bigint as n_shingles, coalesce(r.root, d.doc_id) as component_id
from sets d left join classes c on d.s = c.s left join roots r on c.c = r.a"""

_OP6 = """
with words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w from documents),
items as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w from benchmark),
windows as (
  select distinct item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i+9])) as p
  from items where len(w) > 0),
sizes as (select distinct len(p) as n from windows),
places as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from words, sizes where len(w) >= n),
hits as (
  select doc_id, i, n, item_id from places join windows on w[i:i+n-1] = p),
covered as (
  select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as told
  from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id),
tokens as (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as place from words),
counts as (select word, count(*) as times from tokens group by word),
terms as (select distinct p, word from (select p, unnest(p) as word from (select distinct p from windows))),
rarest as (
  select p, word from terms join counts using (word) qualify row_number() over (partition by p order by times, word) <= 2),
marks as (
  select doc_id, item_id, word, place, lag(word) over w as word_before, lag(place) over w as place_before
  from tokens join (select distinct item_id, word from rarest join windows using (p)) using (word)
  window w as (partition by doc_id, item_id order by place)),
near as (
  select doc_id, count(distinct item_id) as n_near_items from marks
  where place - place_before <= 20 and word <> word_before group by doc_id)
select words.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(told, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near_items, 0)::bigint as n_near_items
from words left join covered using (doc_id) left join found using (doc_id) left join near using (doc_id)"""

_OP7 = """
with parts as (
  select page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') as path from pages),
rules(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best as (
  select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as v
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from parts left join best using (page_id)"""

_OP8 = """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
hard as (
  select conv_id, bool_or(regexp_matches(text, '<\\|(im_start|im_end|nl)\\|>|<\\\\+\\|')
    or regexp_matches(role, '<\\|(im_start|im_end|nl)\\|>|<\\\\+\\||\\n')) as escaped from turns group by conv_id),
told as (
  select *, 24 + length(replace(case when escaped then regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g') else role end, chr(10), '<|nl|>'))
    + length(case when escaped then regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') else text end) as chars
  from turns join hard using (conv_id))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from told group by conv_id"""

_OP9 = """
with texts as (select doc_id, coalesce(text, '') as t from documents),
words as (
  select doc_id, t, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as l from texts),
windows as (select doc_id, unnest(range(1, len(w) - 3)) as i, w from words where len(w) >= 5),
repeated as (
  select doc_id, unnest(places) as i from (
    select doc_id, list(i) as places from (select doc_id, i, w[i:i+4] as p from windows) group by doc_id, p having count(*) > 1)),
covered as (
  select doc_id, count(distinct place) as n from (select doc_id, unnest(range(i, i + 5)) as place from repeated) group by doc_id),
counts as (
  select doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words, len(l) as n_lines
  from words left join covered using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or 10 * n_symbols > 3 * n_words or 10 * n_dup_lines > 3 * n_lines
    or word_chars < 2 * n_words or word_chars > 12 * n_words) as kept
from counts"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_OP11 = f"""
with docs as (select row_number() over () as r, doc_id, {_TERMS} as w from documents),
totals as (select count(*) filter (len(w) > 0) as docs, sum(len(w)) as terms from docs),
asked as (select item_id, term, count(*) as times from (select item_id, unnest({_TERMS}) as term from benchmark) group by item_id, term),
counts as (select r, term, count(*) as tf from (select r, unnest(w) as term from docs) group by r, term),
weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from counts, totals group by term, docs),
lengths as (select r, doc_id, 100 - 75 + ((75 * len(w) * docs) // terms)::bigint as m from docs, totals where len(w) > 0),
scores as (
  select item_id, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join counts using (term) join weights using (term) join lengths using (r) group by item_id, r),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scores join lengths using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10"""

# The CRC-32 of each id's digits, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint), lambda c, b:
    list_reduce(range(8), lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, xor(c, b)), 4294967295::bigint), 4294967295::bigint)"""

_OP12 = f"""
with turns as (
  select conv_id, turn, left(sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 32) as id,
    length(coalesce(text, '')) as size
  from conversations where conv_id is not null),
own as (select conv_id, list(struct_pack(id := id, size := size) order by turn nulls first, id) as w from turns group by conv_id),
built as (
  select o.conv_id, coalesce(b.w, [])[1:h] || o.w[h+1:] as w
  from (select *, {_CRC} % 6 as h from own) o left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
paths as (
  select conv_id, list_transform(w, lambda t: t.id) as p, list_transform(w, lambda t: t.size) as sizes,
    unnest(range(0, len(w) + 1)) as depth from built),
nodes as (
  select depth, p[1:depth] as path, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(p) = depth), '')) as ends_sha256,
    case when depth = 0 then 0 else min(sizes[depth]) end as size
  from paths group by depth, p[1:depth]),
kids as (select depth - 1 as depth, path[1:depth-1] as path, count(*) as n_children from nodes where depth > 0 group by all),
told as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join kids k on n.depth = k.depth and n.path = k.path),
above as (select unnest(range(0, depth + 1)) as top, path, n_children, (n_convs - 1) * size as saved from told),
sums as (
  select top as depth, path[1:top] as path, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
  from above group by top, path[1:top])
select t.conv_id, t.depth, p.conv_id as parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens, t.ends_sha256
from told t join sums s on t.depth = s.depth and t.path = s.path
left join nodes p on t.depth > 0 and p.depth = t.depth - 1 and p.path = t.path[1:t.depth-1]"""

ORACLE = {
    "op1_secret_scan": _OP1,
    "op4_jaccard_join": _OP4,
    "op6_decontamination": _OP6,
    "op7_url_filter": _OP7,
    "op8_chat_format": _OP8,
    "op9_quality_rules": _OP9,
    "op11_ranked_search": _OP11,
    "op12_turn_trie": _OP12,
}
