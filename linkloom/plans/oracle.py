"""ANSI SQL (DuckDB) equivalents of the registered queries."""

from __future__ import annotations

from linkloom.plans.inputs import BUDGET, DAY, MAX_DEPTH, STEPS, THREADS

_DAY_US = DAY * 1_000_000
_REST = """(?:[\\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*)?>"""
_VALUE = """("[^"]*"|''[^'']*''|[^\\s"''>]+)"""

def _elements(*names: str) -> str:
    """Whole elements of these names; unclosed, they reach to the end."""
    return "|".join(f"<{n}{_REST}.*?(?:</{n}\\s*>|\\z)" for n in names)


_NOISE = f"(?s)<!--.*?(?:-->|\\z)|{_elements('script', 'style', 'title', 'iframe')}"
_SHOWN = f"(?s){_elements('textarea', 'xmp')}"


def _doc(html: str) -> str:
    return f"regexp_replace(lower({html}), '{_NOISE}', ' ', 'g')"


def _shielded(doc: str) -> str:
    """Shown raw text without its tags: every other piece between them, its brackets out of sight."""
    between = f"regexp_split_to_array({doc}, '<(?:textarea|xmp){_REST}|</(?:textarea|xmp)\\s*>')"
    return f"array_to_string(list_transform({between}, lambda x, i: case when i % 2 = 0 then replace(x, '<', chr(1)) else x end), ' ')"


def _decode(raw: str) -> str:
    """Entities one after the other: numbers by their code, names by a table."""
    code = (
        "coalesce(try_cast(regexp_extract(p, '^&#([0-9]+);', 1) as int), "
        "try_cast(case when p like '&#x%' then '0x' || regexp_extract(p, '^&#x([0-9a-f]+);', 1) end as int))"
    )
    names = {"lt": "<", "gt": ">", "quot": '"', "apos": "''", "nbsp": " ", "amp": "&", "eacute": "é"}
    named = " ".join(f"when '&{n};' then '{c}'" for n, c in names.items())
    known = f"case when {code} = 160 then ' ' when {code} between 1 and 55295 or {code} between 57344 and 1114111 then chr({code}) else p end"
    each = f"case when p like '&#%' then {known} else case p {named} else p end end"
    pieces = f"regexp_extract_all({raw}, '(?s)&#x[0-9a-f]{{1,6}};|&#[0-9]{{1,7}};|&[a-z]{{2,8}};|[^&]+|&')"
    return f"(case when contains({raw}, '&') then array_to_string(list_transform({pieces}, lambda p: {each}), '') else {raw} end)"


def _value(raw: str) -> str:
    bare = f"(case when left({raw}, 1) in ('\"', '''') then substr({raw}, 2, length({raw}) - 2) else {raw} end)"
    return f"(case when {raw} <> '' then {_decode(bare)} end)"


def _attr(tag: str, name: str) -> str:
    return f"regexp_extract({tag}, '\\s{name}\\s*=\\s*{_VALUE}', 1)"


def _domain(url: str) -> str:
    bare = f"regexp_replace({url}, '^https?://(www\\.)?', '', 'i')"
    return f"regexp_replace(regexp_replace({bare}, '/.*', ''), '[?#:].*', '')"


def _site(url: str) -> str:
    host = f"nullif(regexp_extract({url}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1), '')"
    return f"(case when contains({host}, 'www') then regexp_replace({host}, '\\.?[^.]*$', '') else {host} end)"


def _esc(text: str) -> str:
    return f"""replace(replace(replace({text}, '&', '&amp;'), '"', '&quot;'), '<', '&lt;')"""


_DOCUMENT_PAGES = f"""
document_pages as (
  select doc_id as page_id,
    concat('http://www.', source, '.example.com/', lang, '/', n_chars % 100) as url,
    concat('<HTML><HEAD><META NAME="Keywords" CONTENT="', lang, ', ', source, ' * doc', doc_id,
      '"><meta name=keywords content=''n', n_chars,
      '''><title>Not <a href=/no>the title</title><meta name="title" content="draft"><META Name=''title'' Content="',
      source, ' &amp; ', doc_id,
      '"><meta name="author" content="', lang,
      ' desk"><meta http-equiv="Content-Type" content="text/html; charset=utf-8; lang=', lang,
      '"><meta name="x" http-equiv="content-type" content="ignored"><meta name="description" content="',
      {_esc("text")},
      '"><!-- <a href="http://commented.example.com/">no</a> --><script>var x = "<a href=''/no''>";</script>',
      case doc_id % 5 when 0 then '<base target=x><base href="../up&#x2F;here?x"><base href=/late/>'
        when 1 then '<BASE HREF=''http://base.example.org/a/b?c#d''>' else '' end,
      '</HEAD><BODY class="d"><p>', text,
      '</p><a class=q href="http://', source, '.example.com/', doc_id,
      '?a=1&amp;b=2">src</a><a href=/rel/', lang,
      '>x</a><a name=top>t</a><a title="a > b" href=''https://www.example.org/''>w</a>',
      '<a href="page', doc_id % 7, '.html#s">p</a><a href="../x/./y/../', lang,
      '">r</a><a href="?q=1&#38;r">q</a><a href="//cdn.example.net/../z">c</a><a href="#top">f</a>',
      '<textarea rows=2>a <a href=/t>b</a> &c</textarea><a href="&#47;num&#x2f;&#228;&eacute;&#x1f600;&#0;/..">n</a>',
      '<a href="mailto:a@b.example">m</a><a href="">e</a><xmp><b></xmp>z</BODY><a href=after></HTML>') as html
  from documents
)"""

_ALL_PAGES = f"""{_DOCUMENT_PAGES},
all_pages as (
  select 'crawl' as origin, page_id, url, html from pages
  union all select 'document', page_id, url, html from document_pages
),
cleaned as (select origin, page_id, url, {_doc("html")} as whole from all_pages),
docs as (select *, regexp_replace(whole, '{_SHOWN}', ' ', 'g') as doc from cleaned),
tags as (
  select origin, page_id, url, i, regexp_extract_all(doc, '<a{_REST}')[i] as tag
  from docs, unnest(generate_series(1, len(regexp_extract_all(doc, '<a{_REST}')))) as g(i)
),
hrefs as (
  select origin, page_id, url, row_number() over (partition by origin, page_id order by i) - 1 as pos, href
  from (select *, {_value(_attr("tag", "href"))} as href from tags) where href is not null
)"""

_PARSED = f"""{_ALL_PAGES},
meta_tags as (
  select origin, page_id, i, {_value(_attr("tag", "name"))} as name,
    {_value(_attr("tag", "http-equiv"))} as equiv, {_value(_attr("tag", "content"))} as content
  from (
    select origin, page_id, i, regexp_extract_all(doc, '<meta{_REST}')[i] as tag
    from docs, unnest(generate_series(1, len(regexp_extract_all(doc, '<meta{_REST}')))) as g(i)
  )
),
fields as (
  select origin, page_id,
    arg_max(content, i) filter (where name = 'title') as title,
    arg_max(content, i) filter (where name = 'author') as author,
    arg_max(content, i) filter (where name = 'description') as description,
    arg_max(content, i) filter (where name is null and equiv = 'content-type') as charset
  from meta_tags group by origin, page_id
),
keyword_rows as (
  select origin, page_id, row_number() over (partition by origin, page_id order by i, j) - 1 as pos, keyword
  from (
    select origin, page_id, i, j, string_split_regex(content, '[\\s,*]+')[j] as keyword
    from meta_tags, unnest(generate_series(1, len(string_split_regex(content, '[\\s,*]+')))) as g(j)
    where name = 'keywords'
  ) where keyword <> ''
),
bodies as (
  select origin, page_id, nullif(trim(regexp_replace(replace(regexp_replace(
    regexp_extract({_shielded("whole")}, '(?s)<body{_REST}(.*?)(?:</body\\s*>|\\z)', 1),
    '</?[a-z!?](?:[^>"'']|"[^"]*"|''[^'']*'')*>', ' ', 'g'), chr(1), '<'), '\\s+', ' ', 'g')), '') as body_text
  from docs
),
parsed as (
  select d.origin, d.page_id, d.url, f.title, f.author, f.charset, f.description, b.body_text,
    coalesce((select string_agg(href, '|' order by pos) from hrefs h
      where h.origin = d.origin and h.page_id = d.page_id), '') as links,
    coalesce((select string_agg(keyword, '|' order by pos) from keyword_rows k
      where k.origin = d.origin and k.page_id = d.page_id), '') as keywords
  from docs d
  left join fields f on f.origin = d.origin and f.page_id = d.page_id
  left join bodies b on b.origin = d.origin and b.page_id = d.page_id
)"""

_ROWS = f"""{_PARSED},
stored as (
  select origin, page_id, url as page_url, title, author, charset, replace(keywords, '|', ',') as keywords,
    description, body_text
  from parsed
)"""

_STEP_ROWS = ", ".join(f"({step}, {pos})" for pos, step in enumerate(STEPS))
_WEB = f"""
web as (
  select p.page_id, p.url as src, k.pos, q.url as dst
  from (select *, count(*) over () as n, row_number() over (order by page_id) - 1 as nth from pages) p
  cross join (values {_STEP_ROWS}) as k(step, pos)
  join (select url, row_number() over (order by page_id) - 1 as nth from pages) q on q.nth = (p.nth + k.step) % p.n
),
seeds as (
  select page_id, url, row_number() over (order by page_id) - 1 as position
  from (select *, row_number() over (partition by {_domain("url")} order by page_id) as nth from pages) where nth = 1
)"""


def _url_parts(url: str, prefix: str) -> str:
    rest = f"regexp_replace({url}, '^[a-zA-Z][a-zA-Z0-9+.-]*:', '')"
    tail = f"regexp_replace({rest}, '^//[^/?#]*', '')"
    return f"""regexp_extract({url}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) as {prefix}scheme, regexp_extract({rest}, '^//[^/?#]*') as {prefix}host,
      regexp_extract({tail}, '^[^?#]*') as {prefix}path, regexp_extract({tail}, '^[^?#]*(\\?[^#]*)', 1) as {prefix}query,
      regexp_extract({tail}, '#.*$') as {prefix}fragment"""


def _resolution(name: str, source: str) -> str:
    """CTEs that resolve ``ref`` against ``base`` of the rows (key, ref, base) of a table.

    Dot segments by windows, not one after the other: the depth of the folder after each segment is a running sum,
    kept at zero or above; a segment stays if the depth never falls below its own again.
    """
    return f"""
{name}_parts as (select key, ref, base, {_url_parts("ref", "r_")}, {_url_parts("base", "b_")} from {source}),
{name}_own as (select *, r_scheme <> '' and not (r_scheme = b_scheme and r_host = '' and left(r_path, 1) <> '/') as own from {name}_parts),
{name}_whole as (
  select key, ref, b_scheme <> '' and length(b_host) > 2 as absolute, r_fragment as fragment,
    case when own then r_scheme else b_scheme end as scheme,
    case when own or r_host <> '' then r_host else b_host end as host,
    case when own or r_host <> '' or left(r_path, 1) = '/' then r_path when r_path = '' then b_path
      else concat(coalesce(nullif(regexp_extract(b_path, '^.*/'), ''), '/'), r_path) end as path,
    case when own or r_host <> '' or r_path <> '' or r_query <> '' then r_query else b_query end as query,
    not own and r_host = '' and r_path = '' as untouched
  from {name}_own
),
{name}_steps as (
  select key, i, s, case s when '..' then -1 when '.' then 0 else 1 end as step, n
  from (
    select key, i, string_split(substr(path, 2), '/')[i] as s, len(string_split(substr(path, 2), '/')) as n
    from {name}_whole, unnest(generate_series(1, len(string_split(substr(path, 2), '/')))) as g(i)
    where left(path, 1) = '/' and not untouched)
),
{name}_sums as (select *, sum(step) over (partition by key order by i) as depth from {name}_steps),
{name}_levels as (select *, depth - least(0, min(depth) over (partition by key order by i)) as level from {name}_sums),
{name}_kept as (
  select *, step = 1
    and coalesce(min(level) over (partition by key order by i rows between 1 following and unbounded following), level) >= level as stays
  from {name}_levels
),
{name}_paths as (
  select key, concat('/', coalesce(string_agg(s, '/' order by i) filter (where stays), ''),
    case when max(case when i = n then step end) < 1 and count(*) filter (where stays) > 0 then '/' else '' end) as path
  from {name}_kept group by key
),
{name} as (
  select w.key, case when absolute then concat(scheme, ':', host, coalesce(p.path, w.path), query, fragment) else ref end as dst
  from {name}_whole w left join {name}_paths p on p.key = w.key
)"""


_PAGE_KEY, _LINK_KEY = "concat(origin, '/', page_id)", "concat(origin, '/', page_id, '/', pos)"
_ABSOLUTE = f"""
base_tags as (
  select origin, page_id, i, regexp_extract_all(doc, '<base{_REST}')[i] as tag
  from docs, unnest(generate_series(1, len(regexp_extract_all(doc, '<base{_REST}')))) as g(i)
),
bases as (
  select {_PAGE_KEY} as key, arg_min(href, i) as ref
  from (select *, {_value(_attr("tag", "href"))} as href from base_tags) where href is not null group by origin, page_id
),
page_keys as (select {_PAGE_KEY} as page_key, origin, page_id, url from all_pages),
based as (select key, ref, url as base from bases join page_keys on page_key = key),
{_resolution("base_urls", "based")},
linked as (
  select {_LINK_KEY} as key, href as ref, coalesce(b.dst, h.url) as base
  from hrefs h left join base_urls b on b.key = {_PAGE_KEY}
),
{_resolution("targets", "linked")},
links as (select origin, page_id, url as src, pos, dst from hrefs h join targets t on t.key = {_LINK_KEY})"""

_REAL = f"""{_ALL_PAGES},{_ABSOLUTE},
real_links as (select page_id, src, pos, dst from links where origin = 'crawl'),
wanted as (select url from pages union select dst from real_links),
near as (
  select 0 as link_depth, url from seeds
  union all
  select 1, dst from (select distinct dst from real_links where src in (select url from seeds))
  where dst not in (select url from seeds)
)"""


_LINKS = f"{_ALL_PAGES},{_ABSOLUTE}"


def _crawl(name: str, depth: int, condition: str = "true", seed_condition: str = "true") -> str:
    """Every path of a crawl: one row per job, with its path as the queue order."""
    return f"""
{name}(link_depth, url, path) as (
  select 0, url, [position] from seeds where {seed_condition}
  union all
  select c.link_depth + 1, w.dst, list_append(c.path, w.pos)
  from {name} c join web w on w.src = c.url where c.link_depth < {depth} and {condition}
)"""


_JOB_LOG = f"""{_ALL_PAGES},
counted as (
  select row_number() over (order by p.page_id) - 1 as nth, p.url,
    (select count(*) from hrefs h where h.origin = 'crawl' and h.page_id = p.page_id) as n_links
  from pages p
),
log as (
  select e.event_id, e.user_id as worker, c.url, e.ts as processed_at, c.n_links
  from events e join counted c on c.nth = e.event_id % (select count(*) from pages)
)"""

_SAMPLES = f"""
ev as (select user_id as worker, epoch_us(ts) as t from events),
ordered as (select worker, t, row_number() over (partition by worker order by t) as rn from ev),
bounds(worker, k, rn, t) as (
  select worker, 0, 1, t from ordered where rn = 1
  union all
  select b.worker, b.k + 1, n.rn, n.t
  from bounds b, lateral (
    select min(o.rn) as rn, min(o.t) as t from ordered o where o.worker = b.worker and o.t >= b.t + {_DAY_US}
  ) n where n.rn is not null
),
chained as (
  select worker, k, rn, t, lead(rn) over w as next_rn, lead(t) over w as next_t,
    (select count(*) from ev e where e.worker = bounds.worker) as n_jobs
  from bounds window w as (partition by worker order by k)
),
closed as (
  select worker, k,
    coalesce(next_rn, n_jobs) - case when k = 0 then 0 else rn end as jobs,
    coalesce((next_t - t) // {_DAY_US}, 1) as slots
  from chained
),
placed as (
  select worker, jobs, slots, sum(slots) over (partition by worker order by k) - slots as idx from closed
),
dense as (
  select worker, (idx + s.i)::bigint as idx, (case when s.i = 0 then jobs else 0 end)::bigint as jobs
  from placed, unnest(generate_series(0, (slots - 1)::bigint)) as s(i)
),
starts as (select worker, min(t) as start from ev group by worker),
per_worker as (
  select d.worker, s.start, count(*) as n_samples, s.start + count(*) * {_DAY_US} as "end"
  from dense d join starts s on s.worker = d.worker group by d.worker, s.start
),
total as (
  select b.bucket, coalesce(sum(d.jobs), 0)::bigint as jobs
  from (select unnest(generate_series(0, (
      select max((s.start - (select min(start) from starts)) // {_DAY_US} + d.idx)
      from dense d join starts s on s.worker = d.worker))) as bucket) b
  left join (
    select (s.start - (select min(start) from starts)) // {_DAY_US} + d.idx as bucket, d.jobs
    from dense d join starts s on s.worker = d.worker
  ) d on d.bucket = b.bucket
  group by b.bucket
)"""

_THREAD_LIST = ", ".join(str(n) for n in THREADS)
_RUNS = f"""
runs as (
  select e.event_type, n.n_threads, e.user_id % n.n_threads as worker, count(*) as n_pages,
    sum(e.value::decimal(18, 2)) as seconds
  from events e, unnest([{_THREAD_LIST}]) as n(n_threads) group by all
)"""


def _with(*ctes: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{','.join(ctes)}\n"


def _parsed(columns: str) -> str:
    return _with(_PARSED) + f"select origin, page_id, {columns} from parsed"


_FULL = "title, author, links, charset, keywords, description, body_text"
_JOBS = _with(_WEB, _crawl("jobs", MAX_DEPTH), recursive=True)
_PER_URL = "select link_depth, url, count(*)::bigint as n_jobs from jobs group by link_depth, url"
_PAGE_TABLE = """select page_url, title, author, charset, keywords, description, body_text from (
  select *, row_number() over (partition by page_url order by batch, origin, page_id) as nth
  from (
    select 0 as batch, * from stored where origin = 'crawl'
    union all select 1, * from stored
  )) where nth = 1"""

ORACLE: dict[str, str] = {
    "seed_source": "select row_number() over (order by page_id) - 1 as line_no, url from pages",
    "url_list_limit": """select line_no, url from (
        select row_number() over (order by page_id) - 1 as line_no, url from pages) where line_no < 100""",
    "page_source": _with(_WEB, _REAL)
    + "select w.url, octet_length(encode(p.html))::bigint as n_bytes from wanted w left join pages p on p.url = w.url",
    "job_log": _with(_JOB_LOG) + "select worker, url, processed_at, n_links from log",
    "access_lookup": """select p.page_id, p.url, n.n_name as auth_name, concat('db_', n.n_regionkey) as "database",
          concat(lower(n.n_name), '_pages') as page_table
        from pages p join nation n on n.n_name = concat('NATION_', p.page_id % 30)""",
    "page_links": _with(_ALL_PAGES) + "select origin, page_id, pos, href from hrefs",
    "page_keywords": _with(_PARSED) + "select origin, page_id, pos, keyword from keyword_rows",
    "page_description": _parsed("description"),
    "page_title": _parsed("title"),
    "page_author": _parsed("author"),
    "page_charset": _parsed("charset"),
    "page_body_text": _parsed("body_text"),
    "parsed_pages": _parsed(_FULL),
    "link_counts": _with(_ALL_PAGES)
    + f"""select d.origin, d.page_id, len(regexp_extract_all(doc, '<a{_REST}'))::bigint as n_anchors,
          coalesce(h.n_links, 0) as n_links,
          len(regexp_extract_all(doc, '<a{_REST}')) - coalesce(h.n_links, 0) as n_without_href,
          coalesce(h.n_pruned, 0) as n_pruned
        from docs d left join (
          select origin, page_id, count(*) as n_links, count(*) filter (where href like 'http://%') as n_pruned
          from hrefs group by origin, page_id) h on h.origin = d.origin and h.page_id = d.page_id""",
    "prune_http": "select page_id, url from pages where url like 'http://%'",
    "prune_contains_http": "select page_id, url from pages where url like '%http://%'",
    "prune_any_http": "select page_id, url from pages where url ilike 'http%'",
    "prune_page_links": _with(_ALL_PAGES)
    + """select origin, page_id, row_number() over (partition by origin, page_id order by pos) - 1 as pos, href
        from hrefs where href like 'http://%'""",
    "build_page_records": "select url, 0 as link_depth, timestamp '2024-01-01 00:00:00' as discovered_at from pages",
    "format_time": """select event_id, strftime(ts, '%-d/%-m/%Y %H:%M:%S') as padded,
          strftime(ts, '%-d/%-m/%Y %-H:%-M:%-S') as unpadded from events""",
    "depth_filter": _JOBS + f"select * from ({_PER_URL}) where link_depth < 2",
    "url_domain": _with(_WEB, _REAL)
    + f"select page_id, pos, {_domain('src')} as src_domain, {_domain('dst')} as dst_domain from real_links",
    "site_key": _with(_ALL_PAGES) + f"select origin, page_id, {_site('url')} as site from all_pages",
    "skip_unfetched": _with(_WEB, _REAL)
    + "select w.url, octet_length(encode(p.html))::bigint as n_bytes from wanted w join pages p on p.url = w.url",
    "clip_columns": _with(_ROWS)
    + """select origin, page_id, substr(page_url, 1, 80) as page_url, substr(title, 1, 100) as title,
          substr(author, 1, 100) as author, substr(charset, 1, 100) as charset, substr(keywords, 1, 2048) as keywords,
          substr(description, 1, 4000) as description, substr(body_text, 1, 100000) as body_text from stored""",
    "resolve_links": _with(_LINKS) + "select origin, page_id, pos, dst from links",
    "random_order": """select page_id, row_number() over (order by md5(concat('42:', page_id)), page_id) - 1 as position
        from pages""",
    "frontier_all": _JOBS + _PER_URL,
    "frontier_tree": f"""with recursive tree(src, dst) as (
          select concat('region/', n_regionkey), concat('nation/', n_nationkey) from nation
          union all select concat('nation/', c_nationkey), concat('customer/', c_custkey) from customer
          union all select concat('customer/', o_custkey), concat('order/', o_orderkey) from orders
        ), jobs(link_depth, url) as (
          select 0, concat('region/', r_regionkey) from region
          union all
          select j.link_depth + 1, t.dst from jobs j join tree t on t.src = j.url where j.link_depth < {MAX_DEPTH}
        ) {_PER_URL}""",
    "frontier_dedupe": f"""with recursive {_WEB}, found(link_depth, url) as (
          select 0, url from seeds
          union
          select f.link_depth + 1, w.dst from found f join web w on w.src = f.url where f.link_depth < {2 * MAX_DEPTH}
        ) select min(link_depth) as link_depth, url from found group by url""",
    "frontier_budget": _JOBS
    + f"""select * from (
          select row_number() over (order by link_depth, path) - 1 as position, link_depth, url from jobs
        ) where position < {BUDGET}""",
    "frontier_unlimited": _JOBS + "select row_number() over (order by link_depth, path) - 1 as position, link_depth, url from jobs",
    "frontier_budget_dedupe": _JOBS
    + f"""select * from (
          select row_number() over (order by link_depth, path) - 1 as position, link_depth, url from (
            select *, row_number() over (partition by url order by link_depth, path) as nth from jobs) where nth = 1
        ) where position < {BUDGET}""",
    "frontier_dfs_set": _with(
        _WEB, _crawl("jobs", MAX_DEPTH, "contains(w.dst, 'http://')", "contains(url, 'http://')"), recursive=True
    )
    + "select distinct link_depth, url from jobs",
    "frontier_dfs_order": _with(
        _WEB, _crawl("jobs", MAX_DEPTH, "contains(w.dst, 'http://')", "contains(url, 'http://')"), recursive=True
    )
    # A path sorts before its extensions and, of two that part, the one with the later link comes first.
    + """select row_number() over (order by list_transform(path, lambda p: -p)) - 1 as position, link_depth, url from jobs""",
    "frontier_fetch": _with(_WEB, _REAL)
    + """select n.link_depth, n.url, octet_length(encode(p.html))::bigint as n_bytes
        from near n left join pages p on p.url = n.url""",
    "frontier_counts": _JOBS
    + """select link_depth, count(distinct url) as n_urls, count(*) as n_jobs,
          (sum(count(*)) over (order by link_depth))::bigint as n_discovered
        from jobs group by link_depth""",
    "domain_graph": _with(_LINKS)
    + f"""select page_id % 8 as worker, {_domain('src')} as src_domain, {_domain('dst')} as dst_domain,
          count(*) as n_links from links group by all""",
    "domain_graph_total": _with(_LINKS)
    + f"""select {_domain('src')} as src_domain, {_domain('dst')} as dst_domain, count(*) as n_links
        from links group by all""",
    "branching_factor": _with(_ALL_PAGES)
    + f"""select domain, count(*) as n_pages, sum(n)::bigint as n_links, round(sum(n) / count(*), 6) as branching_factor
        from (select {_domain('p.url')} as domain,
            (select count(*) from hrefs h where h.origin = 'crawl' and h.page_id = p.page_id) as n from pages p)
        group by domain""",
    "branching_factor_running": _with(_JOB_LOG)
    + """select worker, event_id, n_processed, n_discovered, round(n_discovered / n_processed, 6) as branching_factor
        from (select worker, event_id, count(*) over w as n_processed, (sum(n_links) over w)::bigint as n_discovered
          from log window w as (partition by worker order by processed_at, event_id rows unbounded preceding))""",
    "worker_totals": _with(_JOB_LOG)
    + "select worker, count(*) as n_processed, sum(n_links)::bigint as n_discovered from log group by worker",
    "throughput_samples": _with(_SAMPLES, recursive=True) + "select worker, idx, jobs from dense",
    "throughput_samples_busy": _with(_SAMPLES, recursive=True) + "select worker, idx, jobs from dense",
    "sample_start": "select user_id as worker, min(ts) as sample_start from events group by user_id",
    "sample_bounds": _with(_SAMPLES, recursive=True) + "select worker, start, n_samples, \"end\" from per_worker",
    "sample_bounds_overall": _with(_SAMPLES, recursive=True)
    + 'select min(start) as earliest, max("end") as latest from per_worker',
    "throughput_total": _with(_SAMPLES, recursive=True) + "select bucket, jobs from total",
    "throughput_moving_avg": _with(_SAMPLES, recursive=True)
    + """select worker, idx, jobs, round(avg(jobs) over (
          partition by worker order by idx rows between 2 preceding and current row), 6) as moving_avg from dense""",
    "worker_lifespan": """with spans as (
          select user_id as worker, count(*) as n_processed, epoch_us(max(ts)) - epoch_us(min(ts)) as lifespan_us
          from events group by user_id)
        select * from spans union all select null, sum(n_processed)::bigint, sum(lifespan_us)::bigint from spans""",
    "avg_page_size": f"""select count(*) as n_configurations, round(avg(size), 4) as avg_page_size from (
          select {_domain('url')} as domain, avg(octet_length(encode(html))) as size from pages group by 1)""",
    "pages_per_second": _with(_RUNS)
    + """select n_threads, sum(n_pages)::bigint as n_pages,
          round(sum(n_pages) / (sum(seconds)::double / n_threads), 6) as pps from runs group by n_threads""",
    "site_link_counts": _with(_LINKS)
    + f"select {_site('src')} as site, {_site('dst')} as link_to, count(*) as n_links from links where {_site('src')} is not null and {_site('dst')} is not null group by all",
    "site_links_hostless": _with(_ALL_PAGES)
    + f"select count(*) filter (where {_site('url')} is null or {_site('href')} is null) as n_hostless, "
    "count(*) as n_links from hrefs",
    "series_report": _with(_RUNS)
    + """, rates as (
          select event_type, n_threads,
            round(sum(n_pages) / (sum(seconds)::double / n_threads), 6)::decimal(20, 6) as pps
          from runs group by event_type, n_threads
        ), series as (
          select concat(event_type, '{threads}') as series, string_agg(n_threads::varchar, ',' order by n_threads) as data
          from rates group by event_type
          union all
          select concat(event_type, '{pps}'), string_agg(pps::varchar, ',' order by n_threads) from rates group by event_type
        ), numbered as (select row_number() over (order by series) - 1 as n, * from series)
        select 0 as line_no, concat('n_pages=', count(*)) as line from pages
        union all select 1 + 2 * n, concat('series', n, '_name=', series) from numbered
        union all select 2 + 2 * n, concat('series', n, '_data=', data) from numbered""",
    "throughput_csv": _with(_SAMPLES, recursive=True) + f"select bucket * {DAY} / 60 as time, jobs from total",
    "throughput_csv_raw": _with(_SAMPLES, recursive=True)
    + f"select bucket * {DAY} as time_s, jobs as throughput_jobs from total",
    "page_table": _with(_ROWS) + _PAGE_TABLE,
    "page_table_routed": _with(_ROWS)
    + """select "database", page_table, page_url, title, author, charset, keywords, description, body_text from (
          select s.*, concat('db_', n.n_regionkey) as "database", concat(lower(n.n_name), '_pages') as page_table,
            row_number() over (partition by n.n_name, page_url order by page_id) as nth
          from stored s join nation n on n.n_name = concat('NATION_', s.page_id % 30) where origin = 'document'
        ) where nth = 1""",
    "site_link_table": _with(_LINKS)
    + f"""select {_site('src')} as site, replace({_site('src')}, '.', '_') as site_table, {_site('dst')} as link_to,
          count(*) as n_links from links where {_site('src')} is not null and {_site('dst')} is not null group by all""",
    "raw_archive": _with(_WEB, _REAL)
    + """select concat('run1_', sha256(n.url)) as archive_id,
          concat('<!-- url: ', n.url, ' --><!-- timestamp: 2/1/2024 3:4:5 --><!-- linkDepth: ', n.link_depth, ' -->',
            p.html) as content
        from near n join pages p on p.url = n.url""",
    "link_list": _with(_ALL_PAGES) + "select href from hrefs",
    "page_json": _parsed(_FULL),
    "stream_parse": _with(_PARSED)
    + """select page_id, title, links, coalesce((select string_agg(href, '|' order by pos) from hrefs h
          where h.origin = 'crawl' and h.page_id = p.page_id and href ilike 'http%'), '') as pruned_links, body_text
        from parsed p where origin = 'crawl'""",
    "stream_throughput": """select user_id as worker, date_trunc('hour', ts)::timestamp as window_start, count(*) as jobs
        from events group by all""",
    # A batch drops what is behind the watermark that the batch before it began with: for the third, that of the first.
    "stream_late_rows": """with rows as (
          select greatest(event_id % 10 - 7, 0) as part, ts, date_trunc('hour', ts) + interval 1 hour as closes from events
        ), limits as (select max(ts) filter (where part = 0) - interval 1 day as watermark from rows),
        told as (select part, part = 2 and epoch_ms(closes) <= epoch_ms(watermark) as late from rows, limits)
        select part as batch_id, count(*) as n_arrived, 0::bigint as n_untimed, count(*) filter (where not late) as n_counted,
          count(*) filter (where late) as n_late
        from told group by part""",
    "stream_frontier": f"""with recursive {_WEB}, found(link_depth, url) as (
          select 0, url from seeds
          union
          select f.link_depth + 1, w.dst from found f join web w on w.src = f.url where f.link_depth < {MAX_DEPTH}
        ) select min(link_depth) as link_depth, url from found group by url""",
    "stream_frontier_all": _JOBS + _PER_URL,
    "stream_crawl": _with(_WEB, _REAL)
    + """select min(n.link_depth) as link_depth, n.url, n.url in (select url from pages) as stored
        from near n where n.link_depth = 0 or n.url ilike 'http%' group by n.url""",
    "stream_sampler": _with(_SAMPLES, recursive=True)
    + """select d.worker, d.idx, d.jobs from dense d
        where d.idx < (select max(o.idx) from dense o where o.worker = d.worker)""",
    "stream_page_table": _with(_ROWS)
    + """select page_url, title, author, charset, keywords, description, body_text from (
          select *, row_number() over (partition by page_url order by page_id) as nth
          from stored where origin = 'crawl') where nth = 1""",
    "stream_totals": """select count(*) as n_processed, sum((props->>'$.k')::bigint)::bigint as n_discovered from events""",
    "crawl_summary": _with(_WEB, _REAL)
    + """, every as (
          select 0 as link_depth, url from pages
          union all select 1, dst from real_links where dst ilike 'http%'
        ), per_page as (
          select p.url, count(l.dst) as n_links, count(l.dst) filter (where l.dst ilike 'http%') as n_pruned
          from pages p left join real_links l on l.src = p.url group by p.url
        )
        select e.link_depth, count(*) as n_jobs, count(p.url) as n_fetched,
          coalesce(sum(p.n_links), 0)::bigint as n_links, coalesce(sum(p.n_pruned), 0)::bigint as n_pruned
        from every e left join per_page p on p.url = e.url group by e.link_depth""",
    "stage_chain": _with(_LINKS)
    + f"select {_domain('dst')} as domain, count(*) as n_links from links where dst like 'http://%' group by 1",
}
