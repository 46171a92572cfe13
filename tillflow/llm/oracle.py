"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tillflow.llm.license_scan import CUES, MARGIN, OF_FAMILY, TEMPLATES, TERM, THRESHOLD, VERSION
from tillflow.llm.queries import URL_RULES
from tillflow.llm.ranked_search import TERM as RANKED_TERM
from tillflow.llm.url_filter import CANONICAL, HIDDEN, HREF, REFRESH, SENT_TO, TAG


def _lower(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate({text}, '{upper}', '{upper.lower()}')"


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

EXACT = f"""
    with t as (select doc_id, {_lower("coalesce(text, '')")} as text from documents)
    select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
        doc_id = max(doc_id) over w as kept, sha256(text) as text_sha256
    from t window w as (partition by text)"""

LINES = f"""
    with split as (
        select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    each as (
        select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from split),
    keyed as (select *, {_lower(f"trim(line, {_BLANKS})")} as key from each),
    counted as (
        select key, count(distinct doc_id) as n, max(doc_id) as last from keyed
        where length(key) >= 40 group by key),
    decided as (
        select k.*, coalesce(c.n >= 5 and k.doc_id <> c.last, false) as gone
        from keyed k left join counted c using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), ''))
            as kept_sha256
    from decided group by doc_id"""

# All pairs of different texts that share a shingle, and the closure of the links.
JOIN = rf"""
    with recursive t as (
        select doc_id, {_WORDS.format(_lower("coalesce(text, '')"))} as words from documents),
    node as (
        select array_to_string(words, ' ') as copy, any_value(words) as words,
            max(doc_id) as best, count(*) as n_copies
        from t where len(words) > 0 group by 1),
    shingle as (
        select distinct best, array_to_string(words[i : i + 4], ' ') as s from (
            select best, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from node) x),
    size as (select best, count(*) as n from shingle group by best),
    pair as (
        select a.best as a, b.best as b, count(*) as common
        from shingle a join shingle b on a.s = b.s and a.best <> b.best group by 1, 2),
    link as (
        select a, b from pair join size x on a = x.best join size y on b = y.best
        where common / (x.n + y.n - common) >= 0.8),
    reach as (
        select best as a, best as b from node
        union select r.a, l.b from reach r join link l on r.b = l.a),
    class as (select a, max(b) as class_id from reach group by a),
    degree as (select a, count(*) as n from link group by a)
    select t.doc_id, n.best as copy_of, n.n_copies, coalesce(d.n, 0) as n_links, c.class_id,
        t.doc_id = c.class_id as kept
    from t join node n on array_to_string(t.words, ' ') = n.copy join class c on n.best = c.a
        left join degree d on n.best = d.a
    union all
    select doc_id, doc_id, 1, 0, doc_id, true from t where len(words) = 0"""

QUALITY = rf"""
    with w as (
        select doc_id, lang, source, coalesce(text, '') as text,
            {_WORDS.format("coalesce(text, '')")} as words from documents),
    win as (
        select doc_id, i, words[i : i + 4] as k from (
            select doc_id, words, unnest(range(1, len(words) - 3)) as i from w
            where len(words) >= 5) x),
    often as (select doc_id, i from win qualify count(*) over (partition by doc_id, k) > 1),
    inside as (
        select doc_id, count(distinct i + j) as n from often, range(5) r(j) group by doc_id),
    line as (
        select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup from (
            select doc_id, unnest(string_split(text, chr(10))) as line from w) x
        where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
    c as (
        select w.doc_id, lang, source, len(words) as n_words,
            cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint)
                as word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
            coalesce(n_dup, 0) as n_dup_lines, coalesce(inside.n, 0) as n_repeat_words,
            coalesce(n_lines, 0) as n_lines
        from w left join inside using (doc_id) left join line using (doc_id)),
    base as (
        select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from c),
    rate as (
        select doc_id, lang, source, name, least_, both_, (1000 * top) // bottom as r from (
            select doc_id, lang, source, unnest([
                {{name: 'symbols', top: n_symbols, bottom: n_words, least_: 50, both_: false}},
                {{name: 'length', top: word_chars, bottom: n_words, least_: 1000, both_: true}},
                {{name: 'lines', top: n_dup_lines, bottom: n_lines, least_: 150, both_: false}},
                {{name: 'repeats', top: n_repeat_words, bottom: n_words, least_: 60, both_: false}}
            ], recursive := true) from base where n_words > 0) x),
    bucket as (
        select *, (r >> greatest(length(bin(r)) - 11, 0)) << greatest(length(bin(r)) - 11, 0) as b
        from rate),
    level as (
        select 0 as level, lang, source, name, least_, b from bucket
        union all select 1, lang, null, name, least_, b from bucket
        union all select 2, null, null, name, least_, b from bucket),
    sketch as (
        select level, lang, source, name, least_, b, count(*) as n from level group by all),
    running as (
        select *, sum(n) over (partition by level, lang, source, name order by b) as up_to,
            sum(n) over (partition by level, lang, source, name) as docs from sketch),
    quartile as (
        select level, lang, source, name, least_, docs,
            min(b) filter (4 * up_to >= docs) as q1, min(b) filter (4 * up_to >= 3 * docs) as q3
        from running group by all),
    fence as (
        select *, q1 - 3 * greatest(q3 - q1, least_) as low,
            q3 + 3 * greatest(q3 - q1, least_) as high from quartile),
    judged as (
        select r.doc_id, bool_or(r.r > f.high or (r.both_ and r.r < f.low)) as rejected
        from (select rate.*, case
                when (select max(docs) from quartile q where q.level = 0
                    and q.lang is not distinct from rate.lang
                    and q.source is not distinct from rate.source) >= 200 then 0
                when (select max(docs) from quartile q where q.level = 1
                    and q.lang is not distinct from rate.lang) >= 200 then 1
                else 2 end as level from rate) r
        join fence f on f.level = r.level and f.name = r.name
            and f.lang is not distinct from case when r.level < 2 then r.lang end
            and f.source is not distinct from case when r.level < 1 then r.source end
        group by r.doc_id)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and not coalesce(rejected, false) as kept
    from base left join judged using (doc_id)"""

_TEMPLATES = ", ".join(
    f"({i}, '{name}', '{text.lower()}')" for i, (name, text) in enumerate(TEMPLATES)
)

LICENSES = rf"""
    with l as (
        select *, list_filter(string_split(text, chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
    d as (
        select doc_id, text, concat_ws('/', source, doc_id // 4096, doc_id // 64) as directory,
            coalesce(regexp_matches(lower(lines[1]), '{CUES}') or 2 * len(list_filter(lines,
                lambda x: regexp_matches(lower(x), '{CUES}'))) >= len(lines) and len(lines) > 0,
                false) as is_file
        from l),
    found as (
        select distinct doc_id, line from (
            select doc_id, unnest(string_split(text, chr(10))) as line from d) x
        where regexp_matches(lower(line), '{CUES}')),
    unit as (select line, count(*) as n from found group by line),
    template(t, license, body) as (values {_TEMPLATES}),
    term as (
        select line, n, w, count(*) as tf from (
            select line, n, unnest(regexp_extract_all(lower(line), '{TERM}')) as w from unit) x
        group by all),
    wanted as (
        select t, license, w, count(*) as tf from (
            select t, license, unnest(regexp_extract_all(body, '{TERM}')) as w from template) x
        group by all),
    idf as (
        select w, ln((1.0 + (select count(*) from found) + {len(TEMPLATES)}) / (1.0 + sum(n))) + 1.0
            as idf
        from (select w, n from term union all select w, 1 from (select distinct t, w from wanted)) x
        group by w),
    p as (select line, w, tf * idf as x from term join idf using (w)),
    q as (select t, license, w, tf * idf as y from wanted join idf using (w)),
    score as (
        select line, license, round(sum(x * y) / (any_value(pn) * any_value(qn)), 9) as score,
            count(*) filter (regexp_matches(w, '{VERSION}')) = any_value(versions) as same,
            regexp_replace(license, '{OF_FAMILY}', '') as family
        from p join q using (w)
            join (select line, sqrt(sum(x * x)) as pn from p group by line) a using (line)
            join (select t, sqrt(sum(y * y)) as qn,
                count(*) filter (regexp_matches(w, '{VERSION}')) as versions from q group by t) b
                using (t)
        group by line, t, license),
    near as (
        select *, max(score) over (partition by line) as top from score
        qualify top - score <= {MARGIN}),
    best as (
        select line, any_value(family) as family, any_value(top) as score,
            case when count(distinct license) filter (same and license <> family) = 1
                then any_value(license) filter (same and license <> family) end as exact
        from near where top >= {THRESHOLD} group by line having count(distinct family) = 1),
    kin as (
        select doc_id, max(score) as score, coalesce(
            arg_max(exact, {{s: score, e: exact}}) filter (exact is not null), family) as license
        from found join best using (line) group by doc_id, family),
    own as (
        select doc_id, license, score from kin
        qualify row_number() over (partition by doc_id order by score desc, license desc) = 1),
    file as (
        select directory, license, score from d join own using (doc_id) where is_file
        qualify row_number() over (partition by directory order by score desc, license desc) = 1),
    above as (
        select d.doc_id, f.directory, f.license, f.score
        from (select distinct doc_id, directory from d) d join file f
            on d.directory = f.directory or starts_with(d.directory, f.directory || '/')
        qualify row_number() over (partition by d.doc_id order by length(f.directory) desc) = 1)
    select d.doc_id, coalesce(o.license, n.license) as license, coalesce(o.score, n.score) as score,
        o.license is not null as own, case when o.license is null then n.directory end
            as from_directory
    from d left join own o using (doc_id) left join above n using (doc_id)"""

SEARCH = rf"""
    with d as (
        select row_number() over () as row, doc_id,
            regexp_extract_all({_lower("coalesce(text, '')")}, '{RANKED_TERM}') as terms
        from documents),
    i as (
        select row_number() over () as item, item_id,
            regexp_extract_all({_lower("coalesce(text, '')")}, '{RANKED_TERM}') as terms
        from benchmark),
    size as (select count(*) filter (len(terms) > 0) as docs, sum(len(terms))::bigint as total from d),
    wanted as (
        select item, term, count(*) as times
        from (select item, unnest(terms) as term from i) x group by all),
    found as (
        select row, n, term, count(*) as tf
        from (select row, len(terms) as n, unnest(terms) as term from d) x
        where term in (select term from wanted) group by all),
    weight as (
        select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
        from found, size group by term),
    part as (
        select row, term, w * ((1000000000 * tf)
            // (1000 * tf + 8 * (25 + (75 * n * docs) // total))) as x
        from found join weight using (term), size),
    score as (
        select item, row, sum(times * x)::bigint as score
        from wanted join part using (term) group by all having sum(times * x) > 0),
    ranked as (
        select item, doc_id, score, row_number() over (
            partition by item order by score desc, doc_id nulls last) as rank
        from score join d using (row))
    select item_id, rank::int as rank, doc_id, score from ranked join i using (item) where rank <= 10"""

_FIELDS = "doc_id source lang n_chars text".split()


def _sized(value: str) -> str:
    text = f"cast({value} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    fields = [n_chars if f == "n_chars" else f for f in _FIELDS]
    return f"sha256({' || '.join(map(_sized, fields))})"


# crc32 by the bits of its polynomial, since DuckDB has no such function.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, range(8 * strlen(digits))), lambda c, i:
    case when xor(c, (ascii(digits[i // 8 + 1]) >> (i % 8)) & 1) & 1 = 1
        then xor(c >> 1, 3988292384) else c >> 1 end))"""

_LEVELS = """
    select {key}, 0 as level, list(h order by {order}) as hashes from {of} group by {key}
    union all
    select {key}, level + 1, list_transform(range((len(hashes) + 1) // 2),
        lambda i: sha256(hashes[2 * i + 1] || coalesce(hashes[2 * i + 2], '')))
    from {name} where len(hashes) > 1"""

MERKLE = f"""
    with recursive t as (
        select row_number() over (order by doc_id nulls first) as row, doc_id,
            coalesce('=' || lang, '') as tree, n_chars, {_leaf("n_chars")} as h,
            {_leaf("n_chars + 1")} as more, cast(doc_id as varchar) as digits
        from documents),
    d as (
        select row, doc_id, tree, h, case when n_chars is not null and ({_CRC32}) % 7 = 0
            then more else h end as changed,
            row_number() over (partition by tree order by doc_id nulls first, h) - 1 as rank
        from t),
    lower_ as ({_LEVELS.format(key="tree", order="rank", of="d", name="lower_")}),
    subroot as (select tree, hashes[1] as h, level as height, 1 as one,
        row_number() over (order by encode(tree)) - 1 as rank from lower_ where len(hashes) = 1),
    upper_ as ({_LEVELS.format(key="one", order="rank", of="subroot", name="upper_")}),
    top as (select hashes[1] as root from upper_ where len(hashes) = 1),
    level_ as (
        select tree, level, hashes from lower_ where len(hashes) > 1
        union all
        select tree, height + level, hashes from subroot, upper_ where len(hashes) > 1),
    fold as (
        select row, d.tree, s.height, d.rank as place, s.rank as upper_place, 0 as level, changed as own,
            '' as proof from d join subroot s using (tree)
        union all
        select row, f.tree, height,
            place // 2, upper_place, level + 1,
            sha256(case when place % 2 = 1 then hashes[place] || own
                else own || coalesce(hashes[place + 2], '') end),
            proof || case when place % 2 = 1 then hashes[place] else coalesce(hashes[place + 2], '') end
        from (select * replace (
            case when level = height then upper_place else place end as place) from fold) f
            join level_ using (tree, level)),
    last_ as (select * from fold qualify row_number() over (partition by row order by level desc) = 1)
    select doc_id, d.h as leaf, s.h as subroot, root, sha256(proof) as proof_sha256,
        own as folded_root, own = root as verified
    from d join subroot s using (tree) join last_ using (row), top"""


def _address(url: str) -> str:
    behind = f"substr({url}, strpos({url}, '://') + 3)"
    host = _lower(f"regexp_extract({behind}, '^[^/?#]*')")
    known = f"coalesce(strpos({url}, '://') > 0, false)"
    return f"""case when {known} then {host} else '' end as host,
        case when {known} then regexp_extract({behind}, '^[^/?#]*([^?#]*)', 1) else '' end as path,
        case when {known} then {host} || regexp_extract({behind}, '^[^/?#]*([^#]*)', 1) end as node"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_FITS = " ".join(
    f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
    f" then '{host}{path}'"
    for _, host, path in sorted(URL_RULES, key=lambda r: -len(r.host + r.path))
)
_ACTION = " ".join(f"when '{r.host}{r.path}' then '{r.action}'" for r in URL_RULES)

URLS = f"""
    with recursive p as (select page_id, url, {_address("url")} from pages),
    shown as (
        select url, regexp_replace(html, {_quoted(HIDDEN)}, '', 'g') as html
        from pages where strpos(url, '://') > 0),
    tag as (select url, unnest(regexp_extract_all(html, {_quoted(TAG)})) as tag from shown),
    aim as (
        select url, trim(replace(case
            when regexp_matches(tag, {_quoted(CANONICAL)}) then
                regexp_extract(tag, {_quoted(HREF)}, 1) || regexp_extract(tag, {_quoted(HREF)}, 2)
                || regexp_extract(tag, {_quoted(HREF)}, 3)
            when regexp_matches(tag, {_quoted(REFRESH)}) then
                regexp_extract(tag, {_quoted(SENT_TO)}, 1) end, '&amp;', '&')) as aim,
            regexp_extract(url, '^(.*?)://', 1) as scheme,
            regexp_extract(url, '^.*?://([^/?#]*)', 1) as site,
            regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) as place
        from tag),
    link as (
        select url, case
            when regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*://') then aim
            when regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*:') then null
            when starts_with(aim, '//') then scheme || ':' || aim
            when starts_with(aim, '/') then scheme || '://' || site || aim
            when aim = '' or starts_with(aim, '#') then null
            when starts_with(aim, '?') then scheme || '://' || site || place || aim
            else scheme || '://' || site
                || case when place = '' then '/' else regexp_extract(place, '^.*/') end || aim
            end as aim
        from aim where aim is not null),
    ends as (
        select url, aim, row_number() over () as edge from link where strpos(aim, '://') > 0),
    end_ as (
        select edge, {_address("url")} from ends union all select edge, {_address("aim")} from ends),
    arc as (select distinct a.node as a, b.node as b from end_ a join end_ b using (edge)),
    reach as (
        select distinct node as a, node as b from end_
        union select r.a, arc.b from reach r join arc on r.b = arc.a),
    ruled as (select *, case {_FITS} end as rule from p),
    word as (select node, case (case {_FITS} end) {_ACTION} end as action from end_),
    passed as (select a as node, min(action) as passed from reach join word on b = word.node
        group by a)
    select page_id, host, path, rule, coalesce(case rule {_ACTION} end, passed, 'allow') as verdict
    from ruled left join passed using (node)"""


ORACLES = {
    "op1_exact_dedup": EXACT,
    "op2_line_dedup": LINES,
    "op4_license_scan": LICENSES,
    "op7_jaccard_join": JOIN,
    "op8_quality_rules": QUALITY,
    "op11_ranked_search": SEARCH,
    "op12_merkle_manifest": MERKLE,
    "op13_url_filter": URLS,
}
