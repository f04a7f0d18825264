r"""DuckDB statements of the operators that SQL can express, over the whole documents table."""

from pageflow.llm import centroids, quality, spelling

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = rf"""
with recursive d as (select doc_id, {_WORDS} w from (select doc_id, {_LOWER.format("coalesce(text, '')")} t from documents)),
shingles as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) = 0 then []
                               when len(w) < 5 then [array_to_string(w, ' ')]
                               else list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) end) s from d)),
sizes as (select doc_id, count(*) n from shingles group by doc_id),
common as (select x.doc_id a, y.doc_id b, count(*) c from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by 1, 2),
links as (select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= 80 * (p.n + q.n - c)),
reach(a, b) as (select doc_id, doc_id from d union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, min(b) component_id from reach group by a)
select d.doc_id, coalesce(n, 0)::bigint n_shingles, component_id
from d left join sizes on sizes.doc_id = d.doc_id join least on least.a = d.doc_id
"""

QUALITY = rf"""
with d as (select row_number() over () rid, doc_id, coalesce('s' || source, 'n') host, text is null as no_text, coalesce(text, '') t from documents),
w as (select *, {_WORDS} w from d),
tri as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] k from (select rid, w, unnest(generate_series(1, len(w) - 2)) i from w)),
twice as (select rid, k from tri group by rid, k having count(*) > 1),
repeated as (select rid, count(distinct p) n from (select rid, unnest([i, i + 1, i + 2]) p from tri join twice using (rid, k)) group by rid),
lines as (select rid, host, no_text, t, unnest(string_split(t, chr(10))) line from d),
normal as (select *, array_to_string(regexp_extract_all(regexp_replace({_LOWER.format('line')}, '[0-9]', '0', 'g'),
                                                        '[0a-z\x{{80}}-\x{{10FFFF}}]+'), ' ') k from lines),
docs_of as (select host, count(distinct (no_text, t)) n from d group by host),
counts as (select host, k, count(distinct t) c from normal where k <> '' group by host, k),
bad as (select host, k from counts join docs_of using (host) where c >= {quality.MIN_DOCS} and c > {quality.MAX_SHARE} * n or c > {quality.MAX_DOCS}),
gone as (select rid, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) n from normal join bad using (host, k) group by rid),
f as (select doc_id, len(w)::bigint n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint n_symbols,
        (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
         - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::bigint n_dup_lines,
        coalesce(repeated.n, 0)::bigint n_repeat_words, coalesce(gone.n, 0)::bigint n_removed_words
      from w left join repeated using (rid) left join gone using (rid)),
g as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed from f)
select *, not base_failed and not (n_removed_words > 0 and n_words - n_removed_words < {quality.MIN_LEFT} * n_words) as kept from g
"""

SUBSTRINGS = rf"""
with w as (select doc_id, {_WORDS} w from (select doc_id, coalesce(text, '') t from documents)),
windows as (select doc_id, i, array_to_string(w[i:i + 12], ' ') k from (select doc_id, w, unnest(generate_series(1, len(w) - 12)) i from w)),
first as (select k, min(doc_id) least from windows group by k),
gone as (select distinct doc_id, i + j p from windows join first using (k), (select unnest(generate_series(0, 12)) j) where least < doc_id),
lists as (select doc_id, list(p) ps from gone group by doc_id)
select w.doc_id, len(w)::bigint n_words, coalesce(len(ps), 0)::bigint n_removed,
  sha256(array_to_string(case when ps is null then w else list_filter(w, lambda x, i: not list_contains(ps, i)) end, ' ')) kept_sha256
from w left join lists on lists.doc_id = w.doc_id
"""

_C = centroids


def _rounds() -> str:
    """Assignments and centroids of every round, one after the other."""
    steps = []
    for i in range(_C.ROUNDS + 1):
        steps.append(f"""a{i} as materialized (
  select vec_id, v, unnest(arg_min({{'c': c, 'd': d}}, d * {_C.CENTROIDS} + c, 1), max_depth := 2) from (
    select vec_id, v, c, list_sum(list_transform(generate_series(1, {_C.SIZE}), lambda j: (v[j] - m[j]) * (v[j] - m[j])))::bigint d
    from vectors, c{i}) group by vec_id, v)""")
        if i < _C.ROUNDS:
            steps.append(f"""s{i} as (select c, j, sum(v[j])::bigint s, count(*) n from a{i}, (select unnest(generate_series(1, {_C.SIZE})) j) group by c, j),
n{i} as (select c, list((s - ((s % n) + n) % n) // n order by j) m from s{i} group by c),
c{i + 1} as materialized (select c{i}.c, coalesce(n{i}.m, c{i}.m) m from c{i} left join n{i} on n{i}.c = c{i}.c)""")
    return ",\n".join(steps)


CENTROIDS = f"""
with vectors as materialized (
  select vec_id, list_transform(e, lambda x: floor({_C.SCALE} * x)::bigint) v from (select vec_id, list_transform(embedding, lambda x: x::double) e from embeddings)
  where len(e) = {_C.SIZE} and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (select row_number() over (order by h) - 1 c, v m from (
  select v, sha256('{_C.SEED}' || vec_id) h from vectors order by h limit {_C.CENTROIDS})),
{_rounds()},
digests as (select c, sha256(array_to_string(m, ',')) centroid_sha256 from c{_C.ROUNDS})
select vec_id, a.c::integer as cluster, d::bigint distance, (sum(d) over (partition by a.c))::bigint cluster_inertia,
  (sum(d) over ())::bigint inertia, centroid_sha256
from a{_C.ROUNDS} a join digests on digests.c = a.c
"""

_S = spelling
#: crc32 by bytes: the remainders of the 256 bytes come from eight halvings each.
SPELLING = rf"""
with recursive
halvings as (select b, b::bigint r, 0 k from (select unnest(generate_series(0, 255)) b)
             union all select b, xor(r >> 1, 3988292384 * (r & 1)), k + 1 from halvings where k < 8),
remainders as (select list(r order by b) t from halvings where k = 8),
runs as (select coalesce(doc_id::varchar, '') id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]+')) run from documents),
counted as (select id, run, count(*) n from runs group by id, run),
bytes as (select *, hex(encode(id || ':' || run)) x from counted),
hashed as (select run, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(generate_series(1, len(x), 2),
    lambda i: ('0x' || x[i:i + 1])::bigint)), lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]))) h from bytes, remainders),
words as materialized (
  select word, sum(n)::bigint n from (
    select n, case when h % {_S.DROP_EVERY} = 0 then run[:h % len(run)] || run[h % len(run) + 2:] else run end word from hashed)
  where len(word) >= {_S.MIN_LETTERS} group by word having sum(n) >= {_S.MIN_COUNT}),
places as (select word, unnest(generate_series(1, len(word))) i from words),
without as materialized (select word, i, word[:i - 1] || word[i + 1:] rest from places),
pairs as (select x.word, y.word near from without x join without y on x.i = y.i and x.rest = y.rest and x.word <> y.word
          union select x.word, y.word from without x join words y on x.rest = y.word
          union select y.word, x.word from without x join words y on x.rest = y.word),
best as (select p.word, count(*) n_near, arg_max(near, (w.n, place)) form, max(w.n) form_n
         from pairs p join (select *, -row_number() over (order by encode(word)) as place from words) w on w.word = p.near group by p.word),
forms as materialized (select w.word, w.n, coalesce(n_near, 0)::bigint n_near, case when form_n >= {_S.MIN_RATIO} * w.n then form end form,
          case when form_n >= {_S.MIN_RATIO} * w.n then form_n end form_n from words w left join best on best.word = w.word),
chain as (select word, word here, 0 k from forms union all select chain.word, forms.form, k + 1 from chain join forms on forms.word = chain.here where form is not null)
select f.word, form, root, n, n_near, form_n from forms f join (select word, arg_max(here, k) root from chain group by word) c on c.word = f.word
"""
