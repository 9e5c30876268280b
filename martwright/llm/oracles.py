"""DuckDB SQL of the queries that SQL can express."""

from martwright.llm import license_rules

_SPACE = r"[\x20\x09\x0B-\x0D]"


def _reading(text: str) -> str:
    """Numbers of a text's sentences, each between its own spaces."""
    upper, lower = license_rules.UPPER, license_rules.LOWER
    plain = f"trim(regexp_replace(translate(s, '{upper}', '{lower}'), '[^a-z0-9]+', ' ', 'g'))"
    whole = f"regexp_replace({text}, '{license_rules.FIRM}', '\\1\\2', 'g')"
    cut = f"string_split(regexp_replace({whole}, '([.;:!?]){_SPACE}+', '\\1' || chr(10), 'g'), chr(10))"
    said = f"list_filter(list_transform({cut}, lambda s: {plain}), lambda s: regexp_matches(s, '[a-z]'))"
    numbers, read, clause = license_rules.numbered(), "s", "0"
    for pattern, key in license_rules.PATTERNS:
        read = f"regexp_replace({read}, '{pattern}', '{license_rules._one(key)}')"
    for words, key in license_rules.CLAUSES:
        clause = f"case when contains(s, '{words}') then {numbers[license_rules._one(key)]} else {clause} end"
    read_as = f"list_transform({said}, lambda s: {read})"
    return f"list_transform({read_as}, lambda s: coalesce(known.numbers[s], {clause}))"


def _split_tags(text: str) -> str:
    split = text
    for _ in range(license_rules.MAX_IDS - 1):
        split = f"regexp_replace({split}, '{license_rules.SPDX_WITH}', '\\1', 'g')"
        split = f"regexp_replace({split}, '{license_rules.SPDX_OPERATOR}', '\\1 \\2' || chr(10) || '\\1 ', 'g')"
    split = f"regexp_replace({split}, '{license_rules.SPDX_WITH}', '\\1', 'g')"
    return f"case when contains({text}, '{license_rules.TAG}') then {split} else {text} end"


# Line ends as spaces, but for lines without a letter or digit.
_UNWRAPPED = (
    r"translate(regexp_replace(text, '\n[^\p{L}\p{N}]*\n', chr(1), 'g'),"
    " chr(10) || chr(1), ' ' || chr(10))"
)


def _op1() -> str:
    numbers = license_rules.numbered()
    keys = ", ".join(f"'{s}'" for s in numbers)
    values = ", ".join(str(n) for n in numbers.values())
    steps, before = [], "line_0"
    for i, (name, pattern) in enumerate(license_rules.rule_patterns(), start=1):
        steps.append(
            f"line_{i} as (select doc_id, n_sentences, n_known, replace(line, '{pattern}', ' 0 ') as line,"
            f" case when contains(line, '{pattern}') then list_append(found, '{name}') else found end as found"
            f" from {before})"
        )
        before = f"line_{i}"
    return f"""
with known as (select map([{keys}], [{values}]) as numbers),
readings as (
  select doc_id, {_reading("text")} as by_line, {_reading(_UNWRAPPED)} as unwrapped
  from (select doc_id, {_split_tags("coalesce(text, '')")} as text from documents), known
),
lines as (
  select doc_id, by_line, unnest([by_line, unwrapped]) as numbers from readings
),
line_0 as (
  select doc_id, len(by_line) as n_sentences, len(list_filter(by_line, lambda n: n > 0)) as n_known,
         list_aggregate(list_transform(numbers, lambda n: ' ' || n || ' '), 'string_agg', '') as line,
         []::varchar[] as found
  from lines
),
{", ".join(steps)}
select doc_id, n_sentences, n_known,
       coalesce(array_to_string(list_sort(list_distinct(flatten(list(found)))), ','), '') as licences
from {before} group by doc_id, n_sentences, n_known
"""


_OP6 = r"""
with words as (
  select doc_id, i, list[i] as w from (
    select doc_id, list, unnest(range(1, len(list) + 1)) as i from (
      select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                 lambda s: s <> '') as list
      from documents))
),
grams as (
  select doc_id, i, w, lag(w) over d as v, lag(w, 2) over d as u
  from words window d as (partition by doc_id order by i)
),
others as (
  select doc_id, i, count(*) over () - count(*) over (partition by doc_id) as n,
         count(*) over (partition by w) - count(*) over (partition by doc_id, w) as o1,
         case when i > 1 then count(*) over (partition by v, w) - count(*) over (partition by doc_id, v, w) end as o2,
         case when i > 2 then count(*) over (partition by u, v, w) - count(*) over (partition by doc_id, u, v, w) end as o3
  from grams
),
contexts as (
  select *, lag(o1) over d as p1, lag(o2) over d as p2
  from others window d as (partition by doc_id order by i)
),
single as (select *, case when o1 > 0 then o1 / n else 0.4e0 / (n + 1) end as s1 from contexts),
double as (select *, case when o2 > 0 then o2 / p1 when i > 1 then 0.4e0 * s1 else s1 end as s2 from single),
triple as (select *, case when o3 > 0 then o3 / p2 when i > 2 then 0.4e0 * s2 else s2 end as s from double)
select d.doc_id, count(s) as n_words, count(*) filter (o3 > 0) as n_full,
       count(*) filter (o1 = 0) as n_unseen, round(sum(ln(s)) / count(s), 6) as mean_log_score
from documents d left join triple using (doc_id) group by d.doc_id
"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_OP11 = f"""
with said as (
  select doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), '{license_rules.UPPER}', '{license_rules.LOWER}'), '{_TERM}')) as term
  from documents
),
sizes as (select doc_id, count(*) as n from said group by doc_id),
corpus as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
wanted as (
  select distinct item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), '{license_rules.UPPER}', '{license_rules.LOWER}'), '{_TERM}')) as term
  from benchmark
),
held as (
  select doc_id, term, count(*) as tf from said
  where term in (select term from wanted) group by doc_id, term
),
weights as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as weight
  from held, corpus group by term, n_docs
),
impacts as (
  select doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)) as impact
  from held join sizes using (doc_id), corpus
),
scores as (
  select item_id, doc_id, cast(sum(weight * impact) as bigint) as score
  from wanted join impacts using (term) join weights using (term) group by item_id, doc_id
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank,
       doc_id, score
from scores where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10
"""


# crc32 of a number's digits, bit by bit.
_CRC = """xor(4294967295, list_reduce([4294967295::bigint] || list_transform(
  string_split(cast(conv_id as varchar), ''), lambda c: ascii(c)::bigint),
  lambda crc, byte: list_reduce([xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""
_OP13 = f"""
with turns as (
  select conv_id, coalesce(text, '') as text, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) as said,
         row_number() over (partition by conv_id
                            order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null
),
convs as (select conv_id, {_CRC} % 4 as h from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 as part, place, said, text from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 20
  where place <= h
  union all
  select c.conv_id, 1, place, said, text from convs c join turns t on t.conv_id = c.conv_id where place > h
),
paths as (
  select c.conv_id, coalesce(list(said order by part, place) filter (said is not null), []) as said,
         coalesce(list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) order by part, place)
                  filter (said is not null), []) as words
  from convs c left join rebuilt using (conv_id) group by c.conv_id
),
prefixes as (
  select *, array_to_string(said[1:depth], ',') as node
  from (select *, unnest(range(0, len(said) + 1)) as depth from paths)
),
nodes as (
  select depth, node, min(conv_id) as conv_id, count(*) as n_convs, any_value(said) as said,
         max(case when depth > 0 then words[depth] else 0 end) as words,
         sha256(coalesce(string_agg(case when len(said) = depth then conv_id end, ',' order by conv_id), '')) as ends_sha256
  from prefixes group by depth, node
),
children as (
  select depth - 1 as depth, array_to_string(said[1:depth - 1], ',') as node, count(*) as n_children
  from nodes where depth > 0 group by all
),
counted as (
  select n.*, coalesce(n_children, 0) as n_children from nodes n left join children using (depth, node)
),
totals as (
  select up as depth, array_to_string(said[1:up], ',') as node, count(*) filter (n_children = 0) as n_leaves,
         cast(sum((n_convs - 1) * words) as bigint) as saved_tokens
  from (select *, unnest(range(0, depth + 1)) as up from counted) group by all
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
from counted n join totals using (depth, node)
left join nodes p on p.depth = n.depth - 1 and p.node = array_to_string(n.said[1:n.depth - 1], ',')
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_rules": _op1(), "op6_backoff_lm": _OP6, "op11_lemp_search": _OP11, "op13_conversation_trie": _OP13}
