"""What the queries return, as DuckDB SQL, where SQL can express it."""

from __future__ import annotations

_PHRASES = (
    "accept cookies|all rights reserved|click here|cookie policy|enable javascript|lorem ipsum|privacy policy|sign up|"
    "subscribe to our newsletter|terms of service|terms of use"
).replace(" ", "  ")
# Every character that bounds a word is written twice, so that two phrases side by side have a bound each.
_BOUNDED = r"regexp_replace(lower(line), '([^\p{L}\p{N}_])', '\1\1', 'g')"
_FOUND = rf"regexp_extract_all({_BOUNDED}, '(?:^|[^\p{{L}}\p{{N}}_])({_PHRASES})(?:[^\p{{L}}\p{{N}}_]|$)', 1)"

QUALITY_RULES = rf"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), words as (
    select r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
           string_split(t, chr(10)) as lines
    from texts
), windows as (
    select r, i, array_to_string(w[i : i + 4], ' ') as five
    from (select r, w, unnest(generate_series(1, len(w) - 4)) as i from words where len(w) >= 5)
), repeated as (
    select r, i from windows qualify count(*) over (partition by r, five) > 1
), covered as (
    select r, count(distinct i + k) as n from repeated, (values (0), (1), (2), (3), (4)) f(k) group by r
), lines as (
    select r, unnest(lines) as line, generate_subscripts(lines, 1) as place from words
), judged as (
    select *, regexp_matches(line, '[^\x20\x09-\x0D]') as worded,
           len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as n,
           len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]'), lambda x: x in ('|', '»', '›', '•', '·', '>')))
               as separators,
           length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) as symbols
    from lines
), failed as (
    select *, worded and (
               (n >= 30 and not regexp_matches(line, '[.,;:!?…。؟।]'))
               or symbols * 100 > length(line) * 10
               or (separators >= 2 and separators * 6 >= n)
               or (len(phrases) > 0 and (n <= 12 or 100 * len(regexp_split_to_array(array_to_string(phrases, ' '),
                                                                                      '[\x20\x09-\x0D]+')) >= 30 * n))) as bad
    from (select *, {_FOUND} as phrases from judged)
), by_text as (
    select r, count(*) filter (where worded) - count(distinct line) filter (where worded) as n_dup_lines,
           count(*) filter (where bad) as n_lines_removed, coalesce(sum(n) filter (where bad), 0) as lost_words
    from failed group by r
), counted as (
    select doc_id, len(w)::BIGINT as n_words,
           length(array_to_string(w, ''))::BIGINT as word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT as n_symbols,
           n_dup_lines::BIGINT as n_dup_lines, coalesce(covered.n, 0)::BIGINT as n_repeat_words,
           n_lines_removed::BIGINT as n_lines_removed, lost_words::BIGINT as lost_words
    from words join by_text using (r) left join covered using (r)
)
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and lost_words * 100 <= n_words * 50 as kept
from counted
"""

NEIGHBOURS = """
with usable as (
    select vec_id, embedding::DOUBLE[] as v from embeddings
    where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)
select q.vec_id as query_id,
       row_number() over (partition by q.vec_id order by list_inner_product(q.v, c.v) desc, c.vec_id)::INT as rank,
       c.vec_id as vec_id, list_inner_product(q.v, c.v) as score
from usable q join usable c on q.vec_id <> c.vec_id
where q.vec_id % 20 = 0
qualify rank <= 20
"""

HARD_NEGATIVES = """
with usable as (
    select vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::BIGINT as score
    from usable a join usable b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
       row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::INT as rank
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""

_TERMS = (
    "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
)
RANKED_SEARCH = f"""
with documents_in as (
    select row_number() over () as r, doc_id, text from documents
), items_in as (
    select row_number() over () as q, item_id, text from benchmark
), counted as (
    select r, doc_id, term, count(*) as tf from (select r, doc_id, {_TERMS} as term from documents_in) group by all
), lengths as (
    select r, sum(tf)::BIGINT as n from counted group by r
), corpus as (
    select count(*)::BIGINT as docs, sum(n)::BIGINT as words from lengths
), asked as (
    select distinct q, item_id, term from (select q, item_id, {_TERMS} as term from items_in)
), weights as (
    select term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT as w
    from (select term, count(*) as df from counted group by term), corpus
), scored as (
    select q, item_id, r, doc_id, sum(w * (1000000000 * tf // (1000 * tf + 20 * (100 - 50 + 50 * n * docs // words))))::BIGINT as score
    from asked join weights using (term) join counted using (term) join lengths using (r), corpus
    group by all
)
select item_id, row_number() over (partition by q order by score desc, doc_id nulls last)::INT as rank, doc_id, score
from scored where score > 0 qualify rank <= 50
"""


def _segment(level: int, depth: int) -> str:
    """The generalised segment of a path; the last takes all that is left."""
    parts = "string_split(regexp_replace(path, '^/', ''), '/')"
    last = f"case when len({parts}) > {depth} then array_to_string({parts}[{depth + 1} :], '/') end"
    raw = last if level == depth else f"{parts}[{level + 1}]"
    shapes = [
        (r"[0-9]+(\.[A-Za-z0-9]{1,5})?", "{n}"),
        (r"[0-9]{4}-[0-9]{2}(-[0-9]{2})?(\.[A-Za-z0-9]{1,5})?", "{date}"),
        (r"[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}(\.[A-Za-z0-9]{1,5})?", "{uuid}"),
    ]
    cases = " ".join(
        f"when regexp_full_match({raw}, '{p}') then '{s}' || regexp_extract({raw}, '(\\.[A-Za-z0-9]{{1,5}})?$')"
        for p, s in shapes
    )
    stem = f"string_split({raw}, '.')[1]"
    cases += (
        f" when regexp_full_match({raw}, '[0-9A-Fa-f]{{8,}}(\\.[A-Za-z0-9]{{1,5}})?') and regexp_matches({stem}, '[0-9]')"
        f" then '{{hex}}' || regexp_extract({raw}, '(\\.[A-Za-z0-9]{{1,5}})?$')"
        f" when regexp_full_match({raw}, '[0-9A-Za-z_-]{{16,}}(\\.[A-Za-z0-9]{{1,5}})?') and regexp_matches({stem}, '[0-9]')"
        f" then '{{id}}' || regexp_extract({raw}, '(\\.[A-Za-z0-9]{{1,5}})?$')"
    )
    return f"case when path = '' then null {cases} else {raw} end as s{level}"


def url_templates(rules: list[tuple[str, str]], depth: int = 4) -> str:
    """Longest rule, else a template whose smoothed share of blocked urls among the decided ones is 0.9 or more."""
    decided = " ".join(
        f"when (host = '{p.partition('/')[0]}' or suffix(host, '.{p.partition('/')[0]}'))"
        f" and starts_with(path, '/{p.partition('/')[2]}') then {{}}"
        for p, _ in sorted(rules, key=lambda r: -len(r[0]))
    )
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    rule = "case " + decided.format(*[f"'{p}'" for p, _ in ordered]) + " end"
    verdict = "case " + decided.format(*[f"'{v}'" for _, v in ordered]) + " end"
    steps = [f"s{i}" for i in range(depth + 1)]
    sql = f"""
with split as (
    select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), parts as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) as path
    from split
), ruled as (
    select *, {rule} as rule, {verdict} as ruled, {", ".join(_segment(i, depth) for i in range(depth + 1))} from parts
), t_paths as (
    select host, {", ".join(steps)}, count(*) as n, count(ruled) as n_labelled,
           count(*) filter (where ruled = 'block') as n_bad
    from ruled group by all
)"""
    tree = "t_paths"
    for level in range(depth + 1):
        above = ", ".join(["host", *(f"t{i}" for i in range(level))])
        same = " and ".join(f"a.{c} is not distinct from b.{c}" for c in above.split(", "))
        ended = f"s{level + 1} is null" if level < depth else "true"

        def alike(part: str, whole: str) -> str:
            rest = f"({whole} - {part})"
            return (
                f"(({part} * n_rest - {rest} * n) * ({part} * n_rest - {rest} * n)"
                f" <= 9.0::DOUBLE * {whole} * (total - {whole}) * n * n_rest / total)"
            )

        sql += f""", branch{level} as (
    select {above}, s{level}, sum(n)::DOUBLE as n, sum(n_bad)::DOUBLE as bad,
           sum(case when {ended} then n else 0 end)::DOUBLE as ended
    from {tree} group by all
), parent{level} as (
    select {above}, sum(n) as total, sum(bad) as all_bad, sum(ended) as all_ended, count(s{level}) as children
    from branch{level} group by all
), chosen{level} as (
    select {", ".join("a." + c for c in above.split(", "))}, a.s{level}, total - n as n_rest,
           case when a.s{level} is not null and n_rest > 0
                     and ((children > 50 and n < 0.01::DOUBLE * total)
                          or ({alike("bad", "all_bad")} and {alike("ended", "all_ended")}))
                then '*' else a.s{level} end as t{level}
    from branch{level} a join parent{level} b on {same}
), tree{level} as (
    select a.*, b.t{level} from {tree} a join chosen{level} b on {same} and a.s{level} is not distinct from b.s{level}
)"""
        tree = f"tree{level}"
    template = ", ".join(["host", *(f"t{i}" for i in range(depth + 1))])
    same = " and ".join(f"a.{c} is not distinct from b.{c}" for c in template.split(", "))
    own = " and ".join(f"r.{c} is not distinct from j.{c}" for c in ["host", *steps])
    return sql + f""", stats as (
    select {template}, sum(n_labelled) as labelled, sum(n_bad) as bad from {tree} group by all
), judged as (
    select a.host, {", ".join("a." + s for s in steps)}, '/' || concat_ws('/', {", ".join("a.t" + str(i) for i in range(depth + 1))}) as template,
           (bad + 2.0::DOUBLE) / (labelled + 4.0::DOUBLE) as bad_share
    from {tree} a join stats b on {same}
)
select page_id, r.host, path, rule, coalesce(ruled, case when bad_share >= 0.9 then 'block' else 'allow' end) as verdict,
       template, bad_share
from ruled r join judged j on {own}
"""
