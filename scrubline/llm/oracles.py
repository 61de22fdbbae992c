"""SQL for DuckDB that states the queries which SQL can express."""

# Components that are numbers; DuckDB says so with isfinite.
_USABLE = "embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))"

TOP_K = f"""
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings where vec_id is not null and {_USABLE}),
scores as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5"""

NEAR_VECTORS = f"""
with recursive vectors as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings
  where label is not null and vec_id is not null and {_USABLE}
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links as (
  select a.vec_id as a, b.vec_id as b from vectors a join vectors b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.98),
reached(a, b) as (select a, b from links union select r.a, l.b from reached r join links l on l.a = r.b),
degree as (select a, count(*) as n from links group by a),
smallest as (select a, min(b) as b from reached group by a)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(s.b, vec_id)) as component_id,
  vec_id <= coalesce(s.b, vec_id) as kept
from embeddings left join degree d on d.a = vec_id left join smallest s on s.a = vec_id"""


def _decoded(text: str) -> str:
    """The character references that the pages hold; the ampersand last, so nothing is decoded twice."""
    for reference, character in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#x27;", "''")):
        text = f"replace({text}, '{reference}', '{character}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


# Pages of the tables hold one article each, in which h1 and p are the blocks.
PAGE_TEXT = f"""
with articles as (
  select page_id, url, regexp_replace(regexp_extract(coalesce(html, ''),
    '<article>(.*?)(?:</article>|$)', 1, 's'), '<br>', ' ', 'g') as inner_html from pages),
blocks as (
  select page_id, url, list_filter(list_transform(
    string_split_regex(inner_html, '</?(?:h1|p)>'),
    lambda block: trim(regexp_replace({_decoded("regexp_replace(block, '</?b>', '', 'g')")}, '\\s+', ' ', 'g'))),
    lambda block: block <> '') as texts from articles)
select page_id, url, array_to_string(texts, chr(10)) as text,
  cast(length(array_to_string(texts, chr(10))) as bigint) as n_chars from blocks"""

HOST_RULES = r"""
with docs as (
  select row_number() over () as r, cast(doc_id as bigint) as doc_id, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
spans as (
  select r, unnest(list_transform(range(1, len(words) - 1),
    lambda i: {'i': i, 'span': words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]})) as s
  from docs where len(words) > 2),
twice as (select r, s.i as i from spans qualify count(*) over (partition by r, s.span) > 1),
repeated as (
  select r, count(distinct j) as n from (select r, unnest([i, i + 1, i + 2]) as j from twice) group by r),
lines as (
  select r, count(*) as n, count(distinct line) as n_distinct
  from (select r, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
counts as (
  select doc_id, nullif(source, '') as host, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(l.n, 0) as bigint) as n_lines, cast(coalesce(l.n - l.n_distinct, 0) as bigint) as n_dup_lines,
    cast(coalesce(p.n, 0) as bigint) as n_repeat_words
  from docs left join lines l using (r) left join repeated p using (r)),
failed as (
  select *, {'short': n_words < 50, 'repeats': 100 * n_repeat_words > 50 * n_words, 'symbols': 10 * n_symbols > n_words,
    'long_words': word_chars > 12 * n_words, 'repeated_lines': 2 * n_dup_lines > n_lines} as f from counts),
long as (
  select host, unnest(['short', 'repeats', 'symbols', 'long_words', 'repeated_lines', 'any']) as rule,
    unnest([f.short, f.repeats, f.symbols, f.long_words, f.repeated_lines,
      f.short or f.repeats or f.symbols or f.long_words or f.repeated_lines]) as fails from failed),
hosts as (
  select host, rule, cast(count(*) as double) as n, cast(sum(cast(fails as int)) as double) as f
  from long where host is not null group by all),
moments as (
  select rule, sum(f) / sum(n) as m, (count(*) - 1) / sum(n) as chance,
    1 - sum(n * n) / (sum(n) * sum(n)) - (count(*) - 1) / sum(n) as gain,
    sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) as spread from hosts group by rule),
priors as (
  select rule, m, (1 - between_hosts) / between_hosts as strength from (
    select rule, m, case when m * (1 - m) > 0 and gain > 0
      then least(greatest((spread - m * (1 - m) * chance) / (m * (1 - m) * gain), 0.0001), 0.1)
      else 0.0001 end as between_hosts from moments)),
rates as (select host, rule, (f + m * strength) / (n + strength) as rate from hosts join priors using (rule)),
verdicts as (
  select host, list(rule) filter (rate >= 0.01 and rule <> 'any') as binding,
    coalesce(bool_or(rate >= 0.5) filter (rule = 'any'), false) as closed from rates group by host
  union all
  select null, list(rule) filter (m >= 0.01 and rule <> 'any'), coalesce(bool_or(m >= 0.5) filter (rule = 'any'), false)
  from priors),
named as (
  select *, f.short or f.repeats as base_failed, list_filter(
    [case when f.short then 'short' end, case when f.repeats then 'repeats' end, case when f.symbols then 'symbols' end,
     case when f.long_words then 'long_words' end, case when f.repeated_lines then 'repeated_lines' end],
    lambda x: x is not null) as fails from failed)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not closed and not list_has_any(fails, coalesce(binding, [])) as kept, named.host,
  array_to_string(fails, ',') as failed_rules,
  case when closed then 'closed' when len(coalesce(binding, [])) > 0 then 'binding' else 'open' end as host_verdict
from named left join verdicts on named.host is not distinct from verdicts.host"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a string's UTF-8, bit by bit: SQL has no function for it."""
    digits = f"hex(encode({text}))"
    bits = f"""flatten(list_transform(range(0, cast(len({digits}) / 2 as bigint)), lambda i: list_transform(range(8),
      lambda b: ((16 * (strpos('0123456789ABCDEF', {digits}[2 * i + 1]) - 1)
        + strpos('0123456789ABCDEF', {digits}[2 * i + 2]) - 1) >> b) & 1)))"""
    step = "xor(c >> 1, 3988292384 * xor(c & 1, bit))"
    start = "cast(4294967295 as bigint)"
    return f"xor(list_reduce(list_transform({bits}, lambda x: cast(x as bigint)), lambda c, bit: {step}, {start}), {start})"


SPELLING = rf"""
with recursive runs as (
  select row_number() over () as r, coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{{00C0}}-\x{{00FF}}]+')) as run from documents),
counted as (select id, run, count(*) as n from runs where length(run) >= 5 group by all),
hashed as (select *, {_crc32("id || ':' || run")} as h from counted),
typed as (
  select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n
  from hashed),
words as (
  select word, cast(sum(n) as bigint) as n from typed where length(word) >= 5 group by word having sum(n) >= 3),
cuts as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, a.n, b.word as other, b.n as other_n from cuts a join cuts b using (i, rest) where a.word <> b.word
  union select c.word, c.n, w.word, w.n from cuts c join words w on c.rest = w.word
  union select w.word, w.n, c.word, c.n from cuts c join words w on c.rest = w.word),
best as (
  select word, n, count(*) as n_near, max(other_n) as form_n, arg_max(other, (other_n, -place)) as form
  from (select *, row_number() over (partition by word order by other) as place from near) group by all),
forms as (select word, form, form_n from best where form_n >= 2 * n),
walk(word, here, depth) as (
  select word, word, 0 from words union all select w.word, f.form, depth + 1 from walk w join forms f on f.word = w.here),
roots as (select word, arg_max(here, depth) as root from walk group by word)
select w.word, f.form, r.root, w.n, cast(coalesce(b.n_near, 0) as bigint) as n_near, f.form_n
from words w left join best b using (word) left join forms f using (word) join roots r using (word)"""

RESAMPLING = rf"""
with texts as (
  select 'd' as side, row_number() over () as r, cast(doc_id as bigint) as doc_id, text from documents
  union all select 'b', row_number() over (), null, text from benchmark),
split as (
  select side, r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from texts),
features as (
  select side, r, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) as feature
  from split),
distinct_features as (select distinct feature from features),
hashed as (select feature, {_crc32("feature")} % 10000 as bucket from distinct_features),
placed as (select side, r, bucket, count(*) as n from features join hashed using (feature) group by all),
counts as (
  select bucket, coalesce(sum(n) filter (side = 'd'), 0) as s, coalesce(sum(n) filter (side = 'b'), 0) as t
  from placed group by bucket),
totals as (
  select coalesce(sum(n) filter (side = 'd'), 0) as s_all, coalesce(sum(n) filter (side = 'b'), 0) as t_all from placed),
gains as (
  select bucket, cast(floor(1000 * ln(cast((t + 1) * (s_all + 10000) as double) / cast((s + 1) * (t_all + 10000) as double)))
    as bigint) as gain from counts, totals),
weights as (
  select r, cast(sum(n) as bigint) as n_features, cast(floor(sum(n * gain) / sum(n)) as bigint) as weight
  from placed join gains using (bucket) where side = 'd' group by r),
scores as (
  select doc_id, len(words) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || coalesce(cast(doc_id as varchar), '')),
      1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from split left join weights using (r) where side = 'd'),
ranked as (
  select *, n_words >= 20 as eligible, row_number() over (
    partition by n_words >= 20 order by score desc, doc_id nulls last, n_features, weight) as place,
    (select count(*) from scores where n_words >= 20) as n from scores)
select doc_id, n_features, weight, score,
  case when eligible and place <= 25 * n // 100 then place end as rank from ranked"""
