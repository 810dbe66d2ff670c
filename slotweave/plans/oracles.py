"""SQL twins of the registered queries, in DuckDB's dialect, written apart from the Spark code.

They follow the definitions step by step: texts by plain patterns, JSON by the JSON functions,
spans by trying every start, entities by their start positions.
"""

from __future__ import annotations

from slotweave.plans.queries import JSON_LIST_SQL, LOOSE_SQL, REPEATED_KEYS_SQL, REQUOTED_SQL
from slotweave.plans.query_log import QUERY_LOG_SQL

LOG = QUERY_LOG_SQL.format(part="part")
_BLANK = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def clean(x: str) -> str:
    """Strip, collapse blanks, space after punctuation, quotes to apostrophes, collapse again."""
    one = f"regexp_replace(regexp_replace(coalesce({x}, ''), '^{_BLANK}+|{_BLANK}+$', '', 'g'), '{_BLANK}+', ' ', 'g')"
    two = f"regexp_replace({one}, '([.,!?;:]){_BLANK}*', '\\1 ', 'g')"
    return f"trim(regexp_replace(regexp_replace({two}, '[\"`´]', '''', 'g'), '{_BLANK}+', ' ', 'g'))"


def tokens(cleaned: str) -> str:
    """Token list of a cleaned text."""
    return f"list_filter(string_split(regexp_replace({cleaned}, '([.,!?;:])', ' \\1 ', 'g'), ' '), lambda w: w <> '')"


def joined(items: str, separator: str = "|") -> str:
    return f"array_to_string({items}, '{separator}')"


def distinct(items: str) -> str:
    """Distinct non-empty items in order; ``items`` is evaluated often, so it should be a column."""
    return f"list_filter({items}, lambda v, k: v <> '' and list_position({items}, v) = k)"


def cleaned_items(items: str) -> str:
    return f"list_transform({items}, lambda a: {clean('a')})"


def json_items(z: str) -> str:
    """Item texts of a JSON list, or value texts of an object with distinct keys; NULL for other text."""
    raw = f"case json_type({z}) when 'ARRAY' then json_extract({z}, '$[*]') when 'OBJECT' then json_extract({z}, '$.*') else []::json[] end"
    kept = f"list_filter(list_transform({raw}, lambda r: cast(r as varchar)), lambda r: r not in ('null', 'false', '0', '0.0', '\"\"', '[]', '{{}}'))"
    text = (
        "case when r = 'true' then 'True' when r[1] = '\"' then json_extract_string(r, '$') "
        "when regexp_matches(r, '[.eE]') then cast(cast(r as double) as varchar) else r end"
    )
    return f"case when json_valid({z}) then list_transform({kept}, lambda r: {text}) end"


def parse(x: str) -> str:
    """Raw items of an attribute text: JSON, re-quoted JSON, then the loose patterns."""
    quoted, bracketed, runs = (
        f"""regexp_extract_all({x}, '[''"]([^''"]*)[''"]', 1)""",
        rf"regexp_extract_all({x}, '[\[\{{\(]([^\]\}}\)]+)[\]\}}\)]', 1)",
        rf"regexp_extract_all({x}, '([^,\[\]\{{\}}\(\)]+)', 1)",
    )
    requoted = f"replace({x}, '''', '\"')"
    return (
        f"case when {x} is null or {x} in ('', '[]', '{{}}', '()', 'nan') then []::varchar[] "
        f"else coalesce({json_items(x)}, {json_items(requoted)}, "
        f"case when len({quoted}) > 0 then {quoted} when len({bracketed}) > 0 then {bracketed} else {runs} end) end"
    )


def parsed(source: str, key: str, text: str) -> str:
    return (
        f"with s as (select {key}, {text} as x from {source}), i as (select {key}, {cleaned_items(parse('x'))} as l from s) "
        f"select {key}, {joined(distinct('l'))} as attributes from i"
    )


def _span(length: str, label: str) -> str:
    return (
        f"case {length} when 1 then ['S-{label}'] else ['B-{label}'] || list_transform(range({length} - 2), lambda z: 'I-{label}') "
        f"|| ['E-{label}'] end"
    )


def step(source: str, target: str, entity: str, label: str, name: str) -> str:
    """CTEs that tag one entity: add its start and length, replace ``tags``."""
    free = "len(list_filter(tags[i + 1 : i + len(e)], lambda g: g <> 'O')) = 0"
    starts = "range(0, greatest(len(low) - len(e) + 1, 0))"
    return f"""
{target}_e as materialized (select *, list_transform({tokens(entity)}, lambda w: lower(w)) as e from {source}),
{target}_x as materialized (select *, case when len(e) > 0 then list_filter({starts}, lambda i: low[i + 1 : i + len(e)] = e and {free})[1] end as x from {target}_e),
{target}_f as materialized (select *, coalesce(x, case when len(e) >= 5 then list_filter({starts}, lambda i:
   5 * len(list_filter(range(1, len(e) + 1), lambda j: low[i + j] = e[j])) >= 4 * len(e) and {free})[1] end) as st from {target}_x),
{target} as materialized (select * exclude (e, x, st, tags), st as start_{name}, len(e) as size_{name},
   case when st is null then tags else tags[1 : st] || ({_span('len(e)', label)}) || tags[st + len(e) + 1 :] end as tags from {target}_f)"""


def labelled(source: str, attribute_list: str, keys: str = "query_id") -> str:
    """CTEs up to ``lab``: cleaned inputs, start of every entity, tags, and the appended brand.

    ``attribute_list`` is an expression over the source columns: the cleaned attributes.
    """
    return f"""with src as materialized ({source}),
parsed as materialized (select *, {attribute_list} as raw_attributes from src),
cleaned as materialized (select {keys}, {clean('query')} as q, {clean('brand')} as b, raw_attributes as a, {clean('product_type')} as p from parsed),
opened as materialized (select *, {tokens('q')} as tok from cleaned),
ready as materialized (select *, list_transform(tok, lambda w: lower(w)) as low, list_transform(tok, lambda w: 'O') as tags,
   b <> '' and contains(lower(q), lower(b)) as found from opened),
{step('ready', 'one', "case when found then b else '' end", 'Brand', 'b')},
{step('one', 'two', "coalesce(a[1], '')", 'Attribute', 'a1')},
{step('two', 'three', "coalesce(a[2], '')", 'Attribute', 'a2')},
{step('three', 'four', 'p', 'ProductType', 'p')},
lab as materialized (select *, len(tok) > 0 and b <> '' and not found as added, {tokens('b')} as btok from four),
res as materialized (select {keys}, q as query, b as brand, a, p as product_type,
   case when added then tok || btok else tok end as tokens,
   case when added then tags || ({_span('len(btok)', 'Brand')}) else tags end as bioes_tags,
   case when added then concat(q, ' ', b) else q end as augmented_query, added as brand_added from lab)"""


# Attributes of the query log: at most two.
_LOG_ATTRIBUTES = (
    f"list_filter({cleaned_items(parse('attributes'))}, lambda v, k: v <> '' and "
    f"list_position({cleaned_items(parse('attributes'))}, v) = k)"
)
LABELLED = labelled(LOG, _LOG_ATTRIBUTES)
FLAT = (
    f"query, brand, {joined('a')} as attributes, product_type, {joined('tokens', ' ')} as tokens, "
    f"{joined('bioes_tags', ' ')} as bioes_tags, augmented_query, brand_added"
)

_TEXT_AT = "array_to_string(tok[start_{0} + 1 : start_{0} + size_{0}], ' ')"
# Predicted slots by start positions: decoding well-formed tags reads them from left to right.
SLOTS = f"""{LABELLED},
slots as materialized (select lab.query_id,
   case when start_b is not null then {_TEXT_AT.format('b')} when added then array_to_string(btok, ' ') else '' end as brand_pred,
   list_filter(case when start_a2 < start_a1 then [{_TEXT_AT.format('a2')}, {_TEXT_AT.format('a1')}] else
     [case when start_a1 is not null then {_TEXT_AT.format('a1')} end, case when start_a2 is not null then {_TEXT_AT.format('a2')} end] end,
     lambda t: t is not null) as attributes_pred,
   case when start_p is not null then {_TEXT_AT.format('p')} else '' end as product_type_pred from lab),
pred as materialized (select src.query_id, src.query, src.brand, src.product_type, [true_attr1, true_attr2] as attributes,
   brand_pred, attributes_pred, product_type_pred from src join slots on src.query_id = slots.query_id),
sets as (select *, list_distinct(attributes) as ts, list_distinct(attributes_pred) as ps,
   list_distinct(attributes || attributes_pred) as us from pred),
scored as (select *, len(list_intersect(ts, ps)) as hits, len(us) as pool,
   coalesce(brand = brand_pred and product_type = product_type_pred and len(ts) = len(us) and len(ps) = len(us), false) as exact from sets)"""

_TOP1 = "round(avg(case when exact then 1.0 else 0.0 end), 6) as top1_accuracy"


def _single(truth: str, name: str) -> str:
    share = f"round(avg(case when coalesce({truth}, '') = {truth}_pred then 1.0 else 0.0 end), 6)"
    return f"{share} as {name}_precision, {share} as {name}_recall"


_LIST = ", ".join(f"round(coalesce(sum(hits) / nullif(sum(pool), 0), 0), 6) as attribute_{s}" for s in ("precision", "recall"))


def _entity(name: str, hits: str, predicted: str, expected: str) -> str:
    return (
        f"round(sum({hits}) / sum({predicted}), 6) as {name}_entity_precision, "
        f"round(sum({hits}) / sum({expected}), 6) as {name}_entity_recall, "
        f"round(2 * sum({hits}) / (sum({predicted}) + sum({expected})), 6) as {name}_entity_f1"
    )


def _entity_single(truth: str, name: str) -> str:
    return _entity(
        name, f"case when {truth} = {truth}_pred and {truth} <> '' then 1 else 0 end",
        f"case when {truth}_pred <> '' then 1 else 0 end", f"case when coalesce({truth}, '') <> '' then 1 else 0 end",
    )


def report(pairs: str) -> str:
    """CTEs and selection of a classification report over ``pairs`` with columns t and p."""
    return f"""{pairs}, sides as (select t as label, 1 as s, 0 as n, case when t = p then 1 else 0 end as h from pairs
  union all select p, 0, 1, 0 from pairs),
per as (select label, sum(s) as support, sum(n) as predicted, sum(h) as hits from sides group by label),
sc as (select label, support, hits, case when predicted > 0 then hits / predicted else 0 end as pr,
   case when support > 0 then hits / support else 0 end as re, 2 * hits / (support + predicted) as f from per),
alls as (select label, pr, re, f, support from sc
  union all select 'accuracy', null, null, sum(hits) / sum(support), sum(support) from sc
  union all select 'macro avg', avg(pr), avg(re), avg(f), sum(support) from sc
  union all select 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support), sum(f * support) / sum(support), sum(support) from sc)
select label, round(pr, 6) as precision, round(re, 6) as recall, round(f, 6) as f1, cast(support as bigint) as support from alls"""


def bucket(seed: int, key: str) -> str:
    return f"cast('0x' || substr(md5('{seed}|' || {key}), 1, 8) as ubigint) % 100"


_DOCUMENT_WORDS = f"""docs as materialized (select doc_id, {tokens(clean('text'))} as tok from documents),
mid as materialized (select doc_id, list_transform(tok, lambda w: lower(w)) as low, cast(floor(len(tok) / 2) as bigint) as m from docs)"""

_MALFORMED_TAGS = (
    "['O', 'B-Brand', 'I-Brand', 'E-Brand', 'S-Brand', 'B-Attribute', 'I-Attribute', 'E-Attribute', "
    "'S-Attribute', 'B-ProductType', 'I-ProductType', 'E-ProductType', 'S-ProductType']"
)
# The 13 tags in sorted order.
_SORTED_TAGS = f"list_sort({_MALFORMED_TAGS})"

DECODED = f"""with toks as materialized (select conv_id, turn, {tokens(clean('text'))} as tok from conversations),
cells as (select conv_id, turn, unnest(tok) as w, generate_subscripts(tok, 1) - 1 as k from toks),
tagged as materialized (select *, {_MALFORMED_TAGS}[((length(w) * 7 + k * k + k) % 13) + 1] as g from cells),
broken as materialized (select *, max(case when g = 'O' or g[1] in ('B', 'E') then k end) over
   (partition by conv_id, turn order by k rows between unbounded preceding and 1 preceding) as k0 from tagged),
spans as (select e.conv_id, e.turn, e.k, b.k as k0, b.g[3:] as label from broken e join broken b
   on e.conv_id = b.conv_id and e.turn = b.turn and e.k0 = b.k where e.g[1] = 'E' and b.g[1] = 'B'),
texts as (select s.conv_id, s.turn, s.k, s.label, string_agg(t.w, ' ' order by t.k) as x from spans s join tagged t
   on s.conv_id = t.conv_id and s.turn = t.turn and t.k between s.k0 and s.k and t.g[1] in ('B', 'I', 'E') group by all
   union all select conv_id, turn, k, g[3:], w from tagged where g[1] = 'S')
select c.conv_id, c.turn, {', '.join(f"coalesce(string_agg(x, '|' order by k) filter (label = '{label}'), '') as {label.lower()}" for label in ('Brand', 'Attribute', 'ProductType'))}
from conversations c left join texts x on c.conv_id = x.conv_id and c.turn = x.turn group by c.conv_id, c.turn"""

_WORDS = r"string_split(trim(regexp_replace(text, '[ \n]+', ' ', 'g')), ' ')"
DOCUMENT_LABELS = labelled(
    f"""select doc_id, text as query, source as brand, w[-1] as product_type,
   [w[cast(floor(len(w) / 2) as bigint) + 1], array_to_string(w[1:2], ' ')] as items from (select *, {_WORDS} as w from documents)""",
    f"list_transform(list_filter(items, lambda a: a <> ''), lambda a: {clean('a')})", "doc_id",
)

_LISTED = "list_filter([brand, query], lambda v: v is not null) || ['1.0', '2.5', '1000.0', '[\"x\",1]']"
_JSON_ATTRIBUTES = f"case when query_id % 2 = 0 then {cleaned_items(_LISTED)} else {_LOG_ATTRIBUTES} end"


def with_failures(labelled_rows: str, lost: bool) -> str:
    """All columns of labelled rows of which every tenth failed; of a lost row nothing is known."""
    bad = "res.query_id % 10 = 0"
    good = {"attributes": joined("a"), "tokens": joined("tokens", " "), "bioes_tags": joined("bioes_tags", " ")}
    empty = {"tokens": "''", "bioes_tags": "''", "query": "null" if lost else "src.query"}
    columns = ", ".join(
        f"case when {bad} then {empty.get(name, 'null')} else {good.get(name, 'res.' + name)} end as {name}"
        for name in ("query", "brand", "attributes", "product_type", "tokens", "bioes_tags", "augmented_query", "brand_added")
    )
    key = f"case when not ({bad}) then res.query_id end" if lost else "res.query_id"
    return f"{labelled_rows} select {key} as query_id, {bad} as failed, {columns} from res join src on res.query_id = src.query_id"

_TRAIN_TAGS = (
    f"{LABELLED}, train as (select distinct unnest(bioes_tags) as tag from res join src on res.query_id = src.query_id "
    f"where {bucket(0, 'src.query')} >= 20)"
)
_IDS = f"list_transform(bioes_tags, lambda g: list_position({_SORTED_TAGS}, g) - 1)"
_UNSEEN = (
    f"{LABELLED}, unseen as (select res.query_id, res.query, bioes_tags from res join src on res.query_id = src.query_id "
    f"where {bucket(0, 'src.query')} < 20)"
)

_COUNTERS = (
    f"with t as (select len({tokens(clean('text'))}) as n from documents union all select 0 from documents) "
    "select count(*) as rows_read, cast(0 as bigint) as errors, count(*) filter (n = 0) as rows_without_tokens, "
    "count(*) filter (n > 0) as rows_processed from t"
)

ORACLES = {
    "tag_distribution": f"{LABELLED} select tag, count(*) as n_tokens from (select unnest(bioes_tags) as tag from res) group by tag",
    "A1_csv_source": f"select query_id, replace(query, ' ', chr(10)) as query, brand, attributes, product_type from ({LOG})",
    "A2_json_source": f"select query_id, {clean('query')} as query, {clean('brand')} as brand, {clean('product_type')} as product_type, {joined(_JSON_ATTRIBUTES)} as attributes from ({LOG})",
    "A3_column_names": "select p_partkey, p_name as query, cast(p_size as varchar) as brand, '' as product_type, '' as attributes from part",
    "A4_missing_texts": "select p_partkey, ['nil', 'none', '0'][p_partkey % 22 - 18] as cell from part where p_partkey % 22 >= 19 "
                        "union all select p_partkey, null from part where p_partkey % 22 < 19",
    "A1_csv_split": f"select query_id, replace(query, ' ', concat(chr(10), '\"')) as query, brand, attributes, product_type from ({LOG})",
    "A1_csv_headers": f"select query_id, query, case when query_id % 3 < 2 then brand end as brand, attributes, product_type, case when query_id % 3 = 1 then 'é' end as extra, cast(null as varchar) as error from ({LOG})",
    "A1_csv_folder": with_failures(LABELLED, lost=False),
    "A5_stream_csv": with_failures(LABELLED, lost=False),
    "A5_stream_json": with_failures(labelled(LOG, _JSON_ATTRIBUTES), lost=True),
    "A5_stream_labelling": f"{LABELLED} select query_id, cast(null as varchar) as error, {FLAT} from res",
    "A6_csv_sink": f"{LABELLED} select query_id, cast(null as varchar) as error, {FLAT} from res",
    "A7_json_sink": f"{LABELLED} select query_id, cast(null as varchar) as error, {FLAT} from res",
    "A8_read_list_literals": f"with t as (select conv_id, turn, {tokens(clean('text'))} as tok from conversations) "
                             f"select conv_id, turn, len(tok) as n_tokens, md5({joined('tok', ' ')}) as digest from t",
    "A9_metrics_sink": f"{SLOTS} select round(avg(case when coalesce(coalesce(brand, '') = brand_pred and product_type = product_type_pred and len(ts) = len(us) and len(ps) = len(us), false) then 1.0 else 0.0 end), 6) as top1_accuracy, "
                       f"{_single('brand', 'brand')}, {_LIST}, {_single('product_type', 'product_type')} from scored",
    "A10_predictions_sink": f"{SLOTS} select query_id, query, brand, product_type, {joined('attributes')} as attributes, brand_pred, {joined('attributes_pred')} as attributes_pred, product_type_pred from pred",
    "A11_leaderboard_sink": f"{SLOTS} select query_id, query, brand_pred as brand, product_type_pred as product_type, {joined('attributes_pred')} as attributes, {joined('attributes_pred')} as attributes_pred from pred",
    "A13_checked_source": "select p_brand, count(*) as n_parts from part group by p_brand",
    "B1_clean_documents": f"select doc_id, {clean('text')} as cleaned from documents",
    "B2_tokenize_conversations": f"select conv_id, turn, {joined('l', ' ')} as tokens, len(l) as n_tokens from (select conv_id, turn, {tokens(clean('text'))} as l from conversations)",
    "B3_parse_attribute_mix": parsed(f"({LOG})", "query_id", "attributes"),
    "B3a_parse_json_lists": parsed("part", "p_partkey", JSON_LIST_SQL.replace("as string", "as varchar")),
    "B3b_parse_event_objects": parsed("events", "event_id", "props"),
    "B3b_parse_repeated_keys": (
        "select p_partkey, array_to_string(case when p_size % 2 = 0 then list_filter([" + clean("p_name") + ", case when p_size > 1 then cast(p_size - 1 as varchar) end], lambda v: v is not null) "
        "else list_filter([p_brand, case when p_size > 1 then cast(p_size - 1 as varchar) end, " + clean("p_name") + "], lambda v: v is not null) end, '|') as attributes from part"
    ),
    "B3c_parse_requoted_json": parsed("part", "p_partkey", REQUOTED_SQL.replace("as string", "as varchar")),
    "B3d_parse_loose_lists": parsed("part", "p_partkey", LOOSE_SQL),
    "B3d_parse_loose_documents": parsed("documents", "doc_id", "text"),
    "B3e_dedupe_document_lines": f"with s as (select doc_id, string_split(text, chr(10)) as l from documents), d as (select doc_id, {distinct('l')} as l from s) "
                                 f"select doc_id, {joined('l')} as lines, len(l) as n_lines from d",
    "B4_clean_native_lists": "with s as (select conv_id, turn, list_filter(string_split(concat(text, chr(10), ' ', chr(10), chr(10), role), chr(10)), lambda v: v <> '') as l from conversations), "
                             f"c as (select conv_id, turn, {cleaned_items('l')} as l from s) select conv_id, turn, {joined('l')} as items, len(l) as n_items from c",
    "B5_brand_in_query": f"select query_id, {clean('brand')} <> '' and contains(lower({clean('query')}), lower({clean('brand')})) as found from ({LOG})",
    "C1_exact_span": f"with {_DOCUMENT_WORDS}, w as (select *, low[m + 1 : m + 3] as e from mid) "
                     "select doc_id, case when len(e) > 0 then list_filter(range(0, greatest(len(low) - len(e) + 1, 0)), lambda i: low[i + 1 : i + len(e)] = e)[1] end as span_start from w",
    "C2_fuzzy_span": f"with {_DOCUMENT_WORDS}, w as (select *, low[m + 1 : m + 5] as e from mid) "
                     "select doc_id, case when len(e) = 5 then list_filter(range(0, greatest(len(low) - 4, 0)), lambda i: low[i + 1] = e[1] and low[i + 2] = e[2] and low[i + 4] = e[4] and low[i + 5] = e[5])[1] end as span_start from w",
    "C3_span_encoding": f"select p_partkey, {joined(_span('p_size', 'Attribute'), ' ')} as tags from part",
    "C4_priority_fold": f"""with src as materialized ({LOG}), cleaned as materialized (select query_id, {clean('query')} as q, {clean('brand')} as b, {clean('true_attr1')} as a, {clean('product_type')} as p from src),
opened as materialized (select *, {tokens('q')} as tok from cleaned),
ready as materialized (select *, list_transform(tok, lambda w: lower(w)) as low, list_transform(tok, lambda w: 'O') as tags from opened),
{step('ready', 'one', 'p', 'ProductType', 'p')}, {step('one', 'two', 'b', 'Brand', 'b')}, {step('two', 'three', 'a', 'Attribute', 'a1')}
select query_id, {joined('tags', ' ')} as tags from three""",
    "C5_augment_brand": f"{LABELLED} select query_id, augmented_query, brand_added from res",
    "C6_label_query_log": f"{LABELLED} select query_id, {FLAT} from res",
    "C6_label_documents": f"{DOCUMENT_LABELS} select doc_id, {joined('bioes_tags', ' ')} as bioes_tags, len(tokens) as n_tokens, brand_added from res",
    "C7_error_capture": f"select query_id, query_id % 10 = 0 as failed, case when query_id % 10 = 0 then 0 else 1 + coalesce(len(string_split(brand, ' ')), 0) end as n_tokens, "
                        f"case when query_id % 10 <> 0 then brand is not null end as brand_added from ({LOG})",
    "C8_label_job": f"{LABELLED} select product_type, count(*) as n_queries, cast(sum(len(tokens)) as bigint) as n_tokens, count(*) filter (brand_added) as n_brand_added from res group by product_type",
    "D1_decode_entities": DECODED,
    "D2_slot_projection": f"{SLOTS} select query_id, brand_pred, {joined('attributes_pred')} as attributes_pred, product_type_pred from slots",
    "E1_top1_accuracy": f"{SLOTS} select brand, {_TOP1} from scored group by brand",
    "E2_single_slot_scores": f"{SLOTS} select product_type, {_single('brand', 'brand')}, {_single('product_type', 'product_type')} from scored group by product_type",
    "E3_list_slot_scores": f"{SLOTS} select product_type, {_LIST} from scored group by product_type",
    "E4_row_alignment": SLOTS.replace(_LOG_ATTRIBUTES, "list_transform([true_attr1, true_attr2], lambda v: " + clean("v") + ")")
                        + f" select query_id, brand, brand_pred, {joined('attributes')} as attributes, {joined('attributes_pred')} as attributes_pred, product_type, product_type_pred from pred",
    "E4_evaluated_failures": SLOTS.replace(_LOG_ATTRIBUTES, "list_transform([true_attr1, true_attr2], lambda v: " + clean("v") + ")")
                             + f" select {_TOP1}, {_single('brand', 'brand')}, {_LIST}, {_single('product_type', 'product_type')}, cast((select count(*) from src) as bigint) as rows_read, "
                             + "cast((select count(*) from src where query_id % 10 = 0) as bigint) as errors from scored where query_id % 10 <> 0",
    "E5_metric_pack": f"{SLOTS} select {_TOP1}, {_single('brand', 'brand')}, {_LIST}, {_single('product_type', 'product_type')} from scored",
    "E5_entity_scores": f"{SLOTS} select {_entity_single('brand', 'brand')}, {_entity_single('product_type', 'product_type')}, {_entity('attribute', 'hits', 'len(ps)', 'len(ts)')} from scored",
    "E6_report_labels": report("with pairs as (select cast(quality as varchar) as t, cast(toxic as varchar) as p from labels)"),
    "E6_report_tags": report(f"""{LABELLED}, bare as (select query_id, tok, low, p, b, found, list_transform(tok, lambda w: 'O') as tags from ready),
{step('bare', 'branded', "case when found then b else '' end", 'Brand', 'b')},
{step('branded', 'alone', 'p', 'ProductType', 'p')},
pairs as (select unnest(res.bioes_tags) as t, unnest(alone.tags || res.bioes_tags[len(alone.tags) + 1 :]) as p from res join alone on res.query_id = alone.query_id)"""),
    "E7_drop_ignored": f"""{LABELLED}, kept as (select query_id, list_filter(list_transform(range(1, len(tokens) + 1), lambda k: case when k % 3 = 0 then null else concat(length(bioes_tags[k]), ':', length(tokens[k])) end), lambda s: s is not null) as l from res)
select query_id, len(l) as n_pairs, {joined('l', ' ')} as pairs from kept""",
    "E8_decode_ids": f"{LABELLED} select query_id, {joined(_IDS, ' ')} as tag_ids, {joined('bioes_tags', ' ')} as tags from res",
    "F1_split_rows": f"select lang, case when {bucket(7, 'doc_id')} < 20 then 'validation' else 'train' end as side, count(*) as n_rows from documents group by all",
    "F2_vocabulary": f"{_TRAIN_TAGS} select tag, cast(row_number() over (order by tag) - 1 as integer) as tag_id from train",
    "F3_align_labels": f"""{DOCUMENT_LABELS}, ids as (select doc_id, tokens, {_IDS} as ids from res),
labs as (select doc_id, [-100] || flatten(list_transform(range(1, len(tokens) + 1), lambda k:
   [ids[k]] || list_transform(range(cast(ceil(length(tokens[k]) / 4) as bigint) - 1), lambda z: -100))) || [-100] as l from ids)
select doc_id, {joined('(l || list_transform(range(128), lambda z: -100))[1:128]', ' ')} as labels, greatest(len(l) - 128, 0) as n_cut from labs""",
    "F4_train_and_report": f"{_UNSEEN} select g as label, count(*) as support, true as found from (select unnest(bioes_tags) as g from unseen) group by g",
    "F5_A12_tag_unseen": f"{_UNSEEN} select query_id, len({tokens('query')}) as n_tokens, len({tokens('query')}) as n_tags, true as all_known, true as same_after_loading from unseen",
    "G1_counters": _COUNTERS,
    "G1_stream_totals": _COUNTERS,
}
ORACLES["E4_aligned_files"] = ORACLES["E4_row_alignment"]
ORACLES["C6_sql_labels"] = ORACLES["C6_label_query_log"]
ORACLES["D2_sql_slots"] = ORACLES["D2_slot_projection"]
ORACLES["A2_json_documents"] = ORACLES["A2_json_source"]
