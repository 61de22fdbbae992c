"""SQL for DuckDB that states each query independently of the Spark operators."""

from __future__ import annotations

from checks.fixtures import with_messy
from scrubline import fixed

STRIPPED = "regexp_replace(part_number, '^\\s+|\\s+$', '', 'g')"
ERA = f"""case when regexp_matches({STRIPPED}, '^PN-[0-9]{{4}}$') then 'current'
  when regexp_matches({STRIPPED}, '^2019-PN-[0-9]+$') then '2019'
  when regexp_matches({STRIPPED}, '^P[0-9]+$') then 'legacy' else 'unknown' end"""

NUMBER = f"regexp_extract({STRIPPED}, '^(2019-PN-|P)([0-9]+)$', 2)"
NORMALIZED = f"""case when {NUMBER} <> '' then
  'PN-' || lpad(cast(cast({NUMBER} as hugeint) as varchar),
    cast(greatest(4, length(cast(cast({NUMBER} as hugeint) as varchar))) as int), '0')
  else {STRIPPED} end"""

EMAIL = "trim(contact_email)"
BAD_EMAIL = f"""contact_email is not null and {EMAIL} not in ('', 'nan', 'None')
  and (position('@' in {EMAIL}) = 0 or {EMAIL} like '%.invalid' or position(' ' in {EMAIL}) > 0)"""

VOCABULARY = "vocabulary(variant, canonical) as (values " + ", ".join(
    f"('{variant}', '{canonical}')" for variant, canonical in fixed.STATE_VOCABULARY
) + ")"

# Longest common subsequence by the textbook dynamic program: one row of the
# table per step, its running maximum taken with a list.
MATCHES = """
named as (select name, min(supplier_code) as first_seen, array_to_string(list_sort(list_filter(
    string_split_regex(lower(name), '\\s+'), lambda t: t <> '')), ' ') as key
  from suppliers_messy where name is not null group by name),
keys as (select distinct key from named where key <> ''),
pairs as (select a.key as ka, b.key as kb from keys a join keys b on a.key < b.key),
steps(ka, kb, i, best) as (
  select ka, kb, 0, list_transform(range(0, length(kb) + 1), lambda z: 0) from pairs
  union all
  select ka, kb, i + 1, list_concat([0], list_transform(range(1, length(kb) + 1), lambda j:
    list_max(list_transform(range(1, j + 1), lambda q: greatest(best[q + 1],
      case when substring(ka, i + 1, 1) = substring(kb, q, 1) then best[q] + 1 else 0 end)))))
  from steps where i < length(ka)),
scores as (select ka, kb, 200.0::double * best[length(kb) + 1] / (length(ka) + length(kb)) as score
  from steps where i = length(ka)),
alike as (select ka, kb, score from scores where score >= 85
  union all select kb, ka, score from scores where score >= 85
  union all select key, key, 100.0::double from keys),
matches as (select x.name as name, y.name as match, s.score as score
  from alike s join named x on x.key = s.ka join named y on y.key = s.kb
  where x.name <> y.name)"""

CODE_PAIRS = f"""{MATCHES},
found as (select later.supplier_code as later, earlier.supplier_code as earlier, s.score
  from suppliers_messy later
  join named nx on nx.name = later.name
  join alike s on s.ka = nx.key
  join named ny on ny.key = s.kb
  join suppliers_messy earlier on earlier.name = ny.name
  where later.supplier_code > earlier.supplier_code)"""

GROUPS = f"""{MATCHES},
visited as (select name, row_number() over (order by first_seen, name) as spot from named
  where key <> ''),
around as (select v.spot, v.name, coalesce(list(w.spot) filter (w.spot is not null), []) as near
  from visited v left join matches m on m.name = v.name
  left join visited w on w.name = m.match group by v.spot, v.name),
walk(spot, claimed, leaders) as (
  select 0::bigint, []::bigint[], []::bigint[]
  union all
  select a.spot,
    case when list_contains(w.claimed, a.spot) then w.claimed
      else list_concat(w.claimed, list_concat([a.spot], a.near)) end,
    case when list_contains(w.claimed, a.spot) then w.leaders
      else list_append(w.leaders, a.spot) end
  from walk w join around a on a.spot = w.spot + 1),
led as (select unnest(leaders) as spot from walk where spot = (select max(spot) from walk)),
groups as (select v.name as canonical, m.match as variant, m.score, v.spot as canonical_spot
  from led join visited v on v.spot = led.spot join matches m on m.name = v.name),
mapping as (select variant, arg_max(canonical, canonical_spot) as canonical from groups group by variant)"""

PART_DEFECTS = f"""select '{fixed.PART_NUMBERS}' as category, part_number as record_key,
  part_number as value, {ERA} as detail from parts_messy where {ERA} <> 'current'"""
EMAIL_DEFECTS = f"""select '{fixed.INVALID_EMAILS}' as category, supplier_code as record_key,
  contact_email as value, 'malformed address' as detail from suppliers_messy where {BAD_EMAIL}"""
STATE_DEFECTS = f"""select '{fixed.STATE_VARIANTS}' as category, co_number as record_key,
  state as value, canonical as detail
  from change_orders_messy join vocabulary on state = variant where variant <> canonical"""
DATE_DEFECTS = f"""select '{fixed.IMPOSSIBLE_DATES}' as category, co_number as record_key,
  strftime(closed_at, '%Y-%m-%d %H:%M:%S') as value,
  'opened ' || strftime(opened_at, '%Y-%m-%d %H:%M:%S') as detail
  from change_orders_messy where closed_at < opened_at"""
DATE_KEYS = """select co_number as record_key from change_orders_messy
  where opened_at is not null and closed_at is not null and closed_at < opened_at"""

DETECTED = f"""{VOCABULARY}, detected as (
  select category, record_key from ({PART_DEFECTS})
  union all select category, record_key from ({EMAIL_DEFECTS})
  union all select category, record_key from ({STATE_DEFECTS})
  union all select '{fixed.IMPOSSIBLE_DATES}', record_key from ({DATE_KEYS}))"""

ALL_DETECTED = f"""{CODE_PAIRS}, {DETECTED.replace("detected as (", "single as (")},
detected as (select * from single
  union all select '{fixed.NEAR_DUPLICATES}', later || '->' || earlier from found)"""

SIDES = """d as (select distinct category, record_key from detected where record_key is not null),
t as (select distinct category, record_key from truth where record_key is not null
  and category in (select category from run)),
sides as (select coalesce(d.category, t.category) as category,
    coalesce(d.record_key, t.record_key) as record_key,
    d.record_key is not null as in_d, t.record_key is not null as in_t
  from d full outer join t on d.category = t.category and d.record_key = t.record_key)"""

FOUR = "run(category) as (values " + ", ".join(
    f"('{c}')" for c in fixed.MANIFEST_RECORDS if c != fixed.NEAR_DUPLICATES
) + ")"
FIVE = "run(category) as (values " + ", ".join(f"('{c}')" for c in fixed.MANIFEST_RECORDS) + ")"

OUTCOMES = """select category, record_key, case when in_d and in_t then 'matched'
  when in_d then 'false_positive' else 'false_negative' end as outcome from sides"""

RATED = """counts as (select coalesce(category, '_overall') as category,
    count(*) filter (in_t) as expected, count(*) filter (in_d) as detected,
    count(*) filter (in_t and in_d) as matched,
    count(*) filter (in_d and not in_t) as false_positives,
    count(*) filter (in_t and not in_d) as false_negatives
  from sides group by rollup (category)),
rated as (select *,
    case when expected = 0 then 1.0::double else matched::double / expected end as recall,
    case when detected = 0 then 1.0::double else matched::double / detected end as precision
  from counts)"""
SCORES = """select category, expected, detected, matched, false_positives, false_negatives,
  recall as detection_rate, recall, precision,
  case when precision + recall = 0 then 0.0::double
    else 2 * precision * recall / (precision + recall) end as f1,
  'row_keys' as validation_mode from rated"""


def pair_scores(suppliers: str, truth: str) -> str:
    """The rates of pair keys of any two rows, for codes that repeat or hold arrows."""
    return f"""{MATCHES.replace("suppliers_messy", suppliers)},
rows_of as (select r.s_suppkey, r.supplier_code, n.key from {suppliers} r join named n on n.name = r.name
  where n.key <> ''),
detected as (select distinct '{fixed.NEAR_DUPLICATES}' as category,
    greatest(x.supplier_code, y.supplier_code) || '->' || least(x.supplier_code, y.supplier_code)
    as record_key
  from rows_of x join alike s on s.ka = x.key join rows_of y on y.key = s.kb
  where x.s_suppkey <> y.s_suppkey),
run(category) as (values ('{fixed.NEAR_DUPLICATES}')),
{SIDES.replace("from truth", f"from {truth}")}, {RATED}"""


def in_order(first_seen: str, table: str = "suppliers_messy") -> str:
    """The groups with names visited in another order, or of another table."""
    return GROUPS.replace("min(supplier_code) as first_seen", f"{first_seen} as first_seen").replace(
        "suppliers_messy", table
    )


ROUNDED = """select category, expected, detected, matched, false_positives, false_negatives,
  round_even(recall, 4) as recall, round_even(precision, 4) as precision, round_even(f1, 4) as f1,
  case when round_even(recall, 4) >= 0.9 then 'green' when round_even(recall, 4) >= 0.7 then 'yellow'
    else 'red' end as health,
  printf('%.1f%%', round_even(round_even(recall, 4) * 100, 1)) as recall_percent from
  (select *, case when precision + recall = 0 then 0.0::double
    else 2 * precision * recall / (precision + recall) end as f1 from rated)"""

CHECK_OF = f"""case category when '{fixed.PART_NUMBERS}' then 'part_number_eras'
  when '{fixed.INVALID_EMAILS}' then 'invalid_emails'
  when '{fixed.STATE_VARIANTS}' then 'state_variants' else 'impossible_dates' end"""

SECTIONS = f"""select 'part_number_eras' as "check", 'eras' as field, {ERA} as item,
    cast(null as varchar) as parent, cast(count(*) as double) as amount from parts_messy group by 3
  union all select 'part_number_eras', 'unknown', part_number, null, count(*) from parts_messy
    where {ERA} = 'unknown' group by part_number
  union all select 'invalid_emails', 'examples', contact_email, null, null from
    (select * from suppliers_messy where {BAD_EMAIL} order by supplier_code limit 10)
  union all select 'state_variants', 'counts', value, null, count(*) from ({STATE_DEFECTS}) group by value
  union all select distinct 'state_variants', 'unknown', state, null, null from change_orders_messy
    where state is not null and state not in (select variant from vocabulary)
  union all select 'impossible_dates', 'unparsed', c, null, 0 from (values ('opened_at'), ('closed_at')) v(c)
  union all select 'near_duplicate_groups', 'groups', canonical, null, count(*) from groups group by canonical
  union all select 'near_duplicate_groups', 'variants', variant, canonical, score from groups
  union all select {CHECK_OF}, 'record_keys', record_key, null, null from detected
    where record_key is not null"""

INTEGRITY = f"""with_counts as (select category, count(*) as n from truth where record_key is not null
    group by category)
  select category,
    case when category = '{fixed.NEAR_DUPLICATES}' then -1
      when category = '{fixed.INVALID_EMAILS}' then n + 1 else n end as expected,
    case when category in ('{fixed.STATE_VARIANTS}', '{fixed.IMPOSSIBLE_DATES}') then -1 else n end as listed,
    case category when '{fixed.NEAR_DUPLICATES}' then 'no summary count for {fixed.NEAR_DUPLICATES}'
      when '{fixed.INVALID_EMAILS}' then 'summary count and listed keys disagree for {fixed.INVALID_EMAILS}'
      when '{fixed.STATE_VARIANTS}'
        then 'there is no defect_records.{fixed.MANIFEST_RECORDS[fixed.STATE_VARIANTS]}'
      when '{fixed.IMPOSSIBLE_DATES}'
        then 'defect_records.{fixed.MANIFEST_RECORDS[fixed.IMPOSSIBLE_DATES]} must be a list'
      end as problem
  from with_counts"""

def _with(tables: str, query: str) -> str:
    return with_messy(f", {tables} {query}")


SHOWN_NAME = "name || ' “Café” €5 – Œuvre™'"

ORACLES = {
    "era_distribution": with_messy(
        f"select {ERA} as era, count(*) as n from parts_messy group by 1"
    ),
    "part_number_non_standard": with_messy(PART_DEFECTS),
    "part_number_summary": with_messy(
        f"""select count(*) filter (era <> 'current') as non_standard_count,
        count(*) filter (era = 'unknown') as unknown_format_count
        from (select {ERA} as era from parts_messy)"""
    ),
    "unknown_part_numbers": with_messy(
        f"select part_number from parts_messy where {ERA} = 'unknown'"
    ),
    "normalize_part_numbers": with_messy(
        f"""select p_partkey, {NORMALIZED} as part_number, name, category, uom, status
        from parts_messy"""
    ),
    "invalid_emails": with_messy(EMAIL_DEFECTS),
    "invalid_email_examples": with_messy(
        f"""select contact_email from (select * from suppliers_messy where {BAD_EMAIL}
        order by supplier_code limit 10)"""
    ),
    "state_variants": _with(VOCABULARY, STATE_DEFECTS),
    "state_variant_counts": _with(
        VOCABULARY, f"select value as state, count(*) as n from ({STATE_DEFECTS}) group by value"
    ),
    "unknown_states": _with(
        VOCABULARY,
        """select distinct state from change_orders_messy
        where state is not null and state not in (select variant from vocabulary)""",
    ),
    "normalize_states": _with(
        VOCABULARY,
        """select o_orderkey, co_number, coalesce(canonical, state) as state, opened_at, closed_at
        from change_orders_messy left join vocabulary on state = variant""",
    ),
    "impossible_dates": with_messy(DATE_DEFECTS),
    "change_order_defects": _with(VOCABULARY, f"{STATE_DEFECTS} union all {DATE_DEFECTS}"),
    "impossible_dates_text": with_messy(DATE_KEYS),
    "impossible_dates_lineitem": """select l_orderkey, l_linenumber, o_orderdate, l_shipdate
        from lineitem join orders on o_orderkey = l_orderkey where l_shipdate < o_orderdate""",
    "supplier_duplicate_pairs": _with(CODE_PAIRS, "select later, earlier, score from found"),
    "name_duplicate_matches": _with(MATCHES, "select name, match, score from matches"),
    "name_duplicate_groups": _with(GROUPS, "select canonical, variant, score from groups"),
    "name_groups_in_order": _with(
        GROUPS,
        """select canonical, variant, score, row_number() over (
          partition by canonical order by score desc, first_seen nulls first, variant) as position
        from groups join (select name as variant, first_seen from named) using (variant)""",
    ),
    "name_duplicate_group_count": _with(
        GROUPS, "select count(distinct canonical) as n_groups from groups"
    ),
    "canonical_name_map": _with(GROUPS, "select variant, canonical from mapping"),
    "normalize_suppliers": _with(
        GROUPS,
        """select s_suppkey, supplier_code, coalesce(canonical, name) as name, contact_email
        from suppliers_messy left join mapping on name = variant""",
    ),
    "scorecard": _with(f"{FOUR}, {DETECTED}, {SIDES}, {RATED}", SCORES),
    "scorecard_all": _with(f"{FIVE}, {ALL_DETECTED}, {SIDES}, {RATED}", SCORES),
    "scorecard_outcomes": _with(f"{FOUR}, {DETECTED}, {SIDES}", OUTCOMES),
    "scorecard_outcomes_all": _with(f"{FIVE}, {ALL_DETECTED}, {SIDES}", OUTCOMES),
    "false_positives": _with(
        f"{FOUR}, {DETECTED}, {SIDES}",
        "select category, record_key from sides where in_d and not in_t",
    ),
    "false_negatives": _with(
        f"{FOUR}, {DETECTED}, {SIDES}",
        "select category, record_key from sides where in_t and not in_d",
    ),
    "expected_counts": with_messy(
        """select category, count(*) as expected from truth where record_key is not null
        group by category"""
    ),
    "truth_keys": with_messy("select category, record_key from truth where record_key is not null"),
    "manifest_integrity": with_messy(
        """select category, count(*) as expected, count(*) as listed, cast(null as varchar) as problem
        from truth where record_key is not null group by category"""
    ),
    "csv_v1_roundtrip": with_messy(
        "select part_number, name, category, uom, status from parts_messy"
    ),
    "csv_v2_roundtrip": with_messy(
        "select part_number, name, category, uom, status from parts_messy"
    ),
    "csv_auto_schema": with_messy(
        """select part_number, name, category, uom, status from parts_messy
        union all select part_number, name, category, uom, status from parts_messy"""
    ),
    "suppliers_cp1252_roundtrip": with_messy(
        f"""select supplier_code, {SHOWN_NAME} as name, cast(null as varchar) as country,
        contact_email, cast(null as varchar) as active from suppliers_messy"""
    ),
    "workbook_scan": with_messy(
        """select co_number, state, 'line one of ' || co_number as description,
        strftime(opened_at, '%Y-%m-%d %H:%M:%S') as opened_at,
        strftime(closed_at, '%Y-%m-%d %H:%M:%S') as closed_at from change_orders_messy"""
    ),
    "cleaned_cells": with_messy(
        """select co_number, case o_orderkey % 4 when 1 then 'one ' || co_number when 2 then 'nano' end
        as cell from change_orders_messy"""
    ),
    "missing_column_guards": _with(
        VOCABULARY,
        f"""select 'emails without codes' as input, count(*) as defect_count, 0 as keyed_count
          from ({EMAIL_DEFECTS})
        union all select 'states without numbers', count(*), 0 from ({STATE_DEFECTS})
        union all select 'dates without numbers', count(*), 0 from ({DATE_KEYS})
        union all select 'no email column', 0, 0
        union all select 'no state column', 0, 0
        union all select 'no close column', 0, 0""",
    ),
    "defect_summary": _with(
        DETECTED,
        """select category, count(*) as defect_count, count(record_key) as keyed_count
        from detected group by category""",
    ),
    "report_checks": _with(
        f"{GROUPS}, {DETECTED}",
        f"""select 'part_number_eras' as "check", count(*) as defect_count from detected
          where category = '{fixed.PART_NUMBERS}'
        union all select 'invalid_emails', count(*) from detected
          where category = '{fixed.INVALID_EMAILS}'
        union all select 'state_variants', count(*) from detected
          where category = '{fixed.STATE_VARIANTS}'
        union all select 'impossible_dates', count(*) from detected
          where category = '{fixed.IMPOSSIBLE_DATES}'
        union all select 'near_duplicate_groups', count(distinct canonical) from groups""",
    ),
    "report_previews": _with(
        DETECTED,
        """select category, substring('record_keys: [' || string_agg(record_key, ', '
            order by record_key) filter (spot <= 3) || ']' ||
            case when count(*) > 3 then '...' else '' end, 1, 120) as details
        from (select category, record_key, row_number() over
            (partition by category order by record_key) as spot
          from detected where record_key is not null) where spot <= 4 group by category""",
    ),
    "detection_total": _with(
        f"{GROUPS}, {DETECTED}",
        """select 'defect_count' as metric, cast((select count(*) from detected)
        + (select count(distinct canonical) from groups) as varchar) as value""",
    ),
    "stream_part_defects": with_messy(PART_DEFECTS),
    "csv_clean_sink": with_messy(
        f"select {NORMALIZED} as part_number, name, category, uom, status from parts_messy"
    ),
    "csv_rejects": """select s_name || ',' || s_suppkey || ',' || 'more, cells' as record
        from supplier where s_suppkey % 7 = 0""",
    "csv_rows_beside_rejects": """select cast(s_suppkey as varchar) as supplier_code, s_name as name,
        cast(null as varchar) as country, cast(null as varchar) as contact_email,
        cast(null as varchar) as active from supplier where s_suppkey % 7 <> 0""",
    "csv_line_breaks": with_messy(
        """select supplier_code, name || case when s_suppkey % 3 = 0 then chr(10) || '"next" line'
        else '' end as name, cast(null as varchar) as country, contact_email,
        cast(null as varchar) as active from suppliers_messy"""
    ),
    "impossible_dates_formats": with_messy(
        """select co_number as record_key from change_orders_messy
        where closed_at < opened_at and o_orderkey % 7 not in (5, 6)"""
    ),
    "impossible_dates_day_first": with_messy(
        "select co_number as record_key from change_orders_messy where closed_at < opened_at"
    ),
    "date_orders": with_messy(
        """, dated as (
          select 'opened_at' as "column", case when o_orderkey % 3 = 0 then '.' else '/' end as separator,
            day(opened_at) as first, month(opened_at) as second from change_orders_messy
          union all select 'closed_at', '/', month(closed_at), day(closed_at) from change_orders_messy
          union all select 'early', case when o_orderkey % 3 = 0 then '.' else '-' end, day(opened_at), month(opened_at)
            from change_orders_messy where day(opened_at) <= 12)
        select *, case when day_first > month_first then 'day_first' when month_first > day_first then 'month_first'
          else 'ambiguous' end as "order" from (
          select "column", separator, count(*) filter (first > 12) as day_first,
            count(*) filter (second > 12) as month_first, count(*) filter (first <= 12 and second <= 12) as either
          from dated where first is not null group by all)"""
    ),
    "unparsed_dates": with_messy(
        """select 'closed_at' as "column", count(*) as n from change_orders_messy
          where closed_at is not null and o_orderkey % 7 in (5, 6)
        union all select 'opened_at', 0"""
    ),
    "normalize_file_order": _with(
        in_order("min(-s_suppkey)"),
        """select supplier_code, coalesce(canonical, name) as name, cast(null as varchar) as country,
        contact_email, cast(null as varchar) as active
        from suppliers_messy left join mapping on name = variant""",
    ),
    "numbered_name_groups": _with(
        in_order("min(supplier_code)", "numbered"), "select canonical, variant, score from groups"
    ),
    "scorecard_repeated_codes": _with(pair_scores("suppliers_repeated", "truth_repeated"), SCORES),
    "scorecard_shared_name": _with(pair_scores("suppliers_shared", "truth_shared"), SCORES),
    "scorecard_many_names": _with(pair_scores("suppliers_many", "truth_many"), SCORES),
    "scorecard_arrow_codes": _with(pair_scores("suppliers_arrows", "truth_arrows"), SCORES),
    "validation_scorecard": _with(f"{FIVE}, {ALL_DETECTED}, {SIDES}, {RATED}", ROUNDED),
    "validation_keys": _with(
        f"{FIVE}, {ALL_DETECTED}, {SIDES}",
        """select category, record_key, case when in_d then 'false_positive' else 'false_negative' end
        as outcome from sides where in_d <> in_t""",
    ),
    "report_sections": _with(f"{GROUPS}, {DETECTED}", SECTIONS),
    "report_field_previews": _with(
        f"{GROUPS}, {DETECTED}, sections as ({SECTIONS})",
        """, items as (select "check", field, concat_ws(': ', concat_ws(' < ', item, parent),
            cast(cast(floor(amount) as bigint) as varchar)) as shown from sections),
          lines as (select "check", field || ': [' || array_to_string(list(shown order by shown)[1:3], ', ') || ']'
            || case when count(*) > 3 then '...' else '' end as line from items group by "check", field)
        select "check", substr(string_agg(line, ' | ' order by line), 1, 120) as details from lines group by all""",
    ),
    "report_json": _with(
        f"{FIVE}, {GROUPS}, {ALL_DETECTED.replace(MATCHES + ',', '', 1)}, {SIDES}, {RATED}",
        f"""select 'tables' as source, 'detection' as section, {CHECK_OF} as name,
          count(*) as defect_count, -1.0::double as recall from single group by category
        union all select 'tables', 'detection', 'near_duplicate_groups', count(distinct canonical), -1
          from groups
        union all select 'tables', 'validation', category, -1, round_even(recall, 4) from rated""",
    ),
    "manifest_integrity_problems": _with(INTEGRITY.split("\n  select category,")[0],
        "select category," + INTEGRITY.split("\n  select category,")[1]
    ),
}
