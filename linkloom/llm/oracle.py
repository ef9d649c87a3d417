"""SQL for DuckDB with the rows of the text queries, where SQL can express them."""

from __future__ import annotations

from linkloom.llm import importance, licences

ORACLE: dict[str, str] = {
    "op10_exact_dedup": r"""
        with texts as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
        )
        select doc_id,
               min(doc_id) over g as keep_id,
               count(*) over g as group_size,
               row_number() over (partition by norm order by doc_id nulls last) = 1 as kept,
               sha256(norm) as text_sha256
        from texts window g as (partition by norm)
    """,
}


def _licence_sql() -> str:
    """Rules as a chain of steps; each takes what it matches out of the row of identifiers."""
    known = ", ".join(f"('{s}', '{i}')" for s, i in licences.SENTENCES.items())
    carries = " or ".join(f"contains(s, '{w}')" for w in licences.LICENCE_WORDS)
    steps, last = [], "s0"
    for n, (_, ids) in enumerate(licences.RULES, 1):
        row = licences.marked(ids)
        steps.append(
            f"s{n} as (select * replace (replace(rest, '{row}', '<>') as rest), contains(rest, '{row}') as f{n} from {last})"
        )
        last = f"s{n}"
    found = ", ".join(f"case when f{n} then '{name}' end" for n, (name, _) in enumerate(licences.RULES, 1))
    return f"""
        with known(sentence, id) as (values {known}),
        rows as (select row_number() over () as r, doc_id, translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}') as t from documents),
        split as (select r, unnest(regexp_split_to_array(t, '{licences.SENTENCE_END}')) as s,
                         generate_subscripts(regexp_split_to_array(t, '{licences.SENTENCE_END}'), 1) as k from rows),
        picked as (select r, k, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) as sentence from split where {carries}),
        ids as (
            select r, coalesce(string_agg('<' || id || '>', '' order by k), '') as rest, coalesce(string_agg(id, ';' order by k), '') as sentence_ids,
                   count(id) as n_known, count(*) - count(id) as n_unknown
            from picked left join known using (sentence) group by r
        ),
        s0 as (select * from ids),
        {", ".join(steps)}
        select doc_id, coalesce(concat_ws(';', {found}), '') as licences, coalesce(sentence_ids, '') as sentence_ids,
               coalesce(n_known, 0) as n_known, coalesce(n_unknown, 0) as n_unknown
        from rows left join {last} using (r)
    """


ORACLE["op5_license_scan"] = _licence_sql()


def _importance_sql() -> str:
    """crc32 of each distinct word by a table of bytes; the cut by a rank over all rows."""
    n, least = importance.BUCKETS, importance.MIN_WORDS
    return rf"""
        with recursive steps(i, step, c) as (
            select i, 0, i::bigint from range(256) t(i)
            union all
            select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end from steps where step < 8
        ),
        crc_table as (select list(c order by i) as t from steps where step = 8),
        rows as (select row_number() over () as r, doc_id, {_words("documents")}),
        wanted as (select {_words("benchmark")}),
        source as (select r, unnest(words) as word from rows),
        target as (select unnest(words) as word from wanted),
        vocabulary as (select distinct word, hex(encode(word)) as h from (select word from source union all select word from target)),
        bytes as (select word, list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, (2 * k + 1)::int, 2))::bigint) as b from vocabulary),
        buckets as (
            select word, xor(list_reduce(list_prepend(4294967295::bigint, b),
                                         lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::bigint) % {n} as bucket
            from bytes, crc_table
        ),
        s_counts as (select bucket, count(*) as s from source join buckets using (word) group by bucket),
        t_counts as (select bucket, count(*) as t from target join buckets using (word) group by bucket),
        totals as (select (select count(*) from source) as s_all, (select count(*) from target) as t_all),
        gains as (
            select bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + {n}))::double / ((coalesce(s, 0) + 1) * (t_all + {n}))::double))::bigint as gain
            from s_counts full join t_counts using (bucket), totals
        ),
        weights as (
            select r, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
            from source join buckets using (word) join gains using (bucket) group by r
        ),
        hashed as (
            select r, doc_id, len(words) as n_words, ('0x' || substr(sha256('{importance.SEED}:' || doc_id::varchar), 1, 8))::bigint as h from rows
        ),
        scored as (
            select r, doc_id, n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
                   coalesce(weight, 0) + floor(-1000.0 * ln(-ln((h + 0.5::double) / 4294967296.0::double)))::bigint as score
            from hashed left join weights using (r)
        ),
        ranked as (
            select r, row_number() over (order by score desc, doc_id, r) as place, count(*) over () as n
            from scored where n_words >= {least} and score is not null
        )
        select doc_id, n_features, weight, score, case when place <= n * {importance.PERCENT} // 100 then place end as rank
        from scored left join ranked using (r)
    """


def _words(table: str) -> str:
    lower = f"translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from {table}"


ORACLE["op11_importance_resampling"] = _importance_sql()
