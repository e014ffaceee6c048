"""DuckDB statements equivalent to the core queries, over the same parquet tables."""

from __future__ import annotations

B = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"


def strip(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^[{B}]+|[{B}]+$', '', 'g')"


def collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '[{B}]+', ' ', 'g'))"


def fold(c: str) -> str:
    return f"replace(lower({c}), 'ß', 'ss')"


def norm_question(c: str) -> str:
    return fold(collapse(c))


REF = rf"(?s)^[{B}]*(.*[^{B}])[{B}]*#[{B}]*0*([0-9]+)[{B}]*$"


def ref(c: str) -> str:
    return rf"case when regexp_matches({c}, '{REF}') then regexp_replace({c}, '{REF}', '\1#\2') end"


def json_string(c: str) -> str:
    """A JSON literal with ASCII escapes, for text without control characters."""
    plain = f"replace(replace({c}, '\\', '\\\\'), '\"', '\\\"')"
    wide = rf"array_to_string(list_transform(string_split({plain}, ''), lambda ch: case when ch <= '~' then ch else printf('\u%04x', unicode(ch)) end), '')"
    return f"('\"' || case when regexp_matches({c}, '^[ -~]*$') then {plain} else {wide} end || '\"')"


def json_list(c: str) -> str:
    return f"('[' || array_to_string(list_transform({c}, lambda x: '\"' || x || '\"'), ',') || ']')"


def doc_of(c: str) -> str:
    return f"regexp_replace({c}, '#[^#]*$', '')"


def idx_of(c: str) -> str:
    return f"cast(regexp_extract({c}, '#([0-9]+)$', 1) as bigint)"


TRAINING = rf"""
training0 as (
 select record_number, csv_line_number, {strip("question")} question, {strip("answer")} answer,
  list_filter(list_transform(coalesce(doc_ids, []), lambda x: {strip("x")}), lambda x: x <> '') doc_ids,
  list_filter(list_transform(coalesce(chunk_ids, []), lambda x: {ref("x")}), lambda x: x is not null) chunk_ids,
  {strip("pipeline")} pipeline, lower({strip("is_exact_duplicate")}) in ('1', 'true', 'yes', 'y') is_dup,
  {strip("duplicate_of_row")} duplicate_of, snapshot_id
 from training_rows),
training as (
 select *, list_sort(list_distinct(chunk_ids)) evidence_signature, list_sort(list_distinct(doc_ids)) doc_set_signature
 from training0)"""

KEYED = rf"""{TRAINING},
keyed as (
 select *, sha256('{{"answer":' || {json_string(norm_question("answer"))} || ',"chunk_ids":' || {json_list("evidence_signature")}
   || ',"question":' || {json_string(norm_question("question"))} || '}}') train_key,
  sha256({json_list("doc_set_signature")}) doc_key
 from training)"""


def summary(name: str, values: str) -> str:
    q = lambda p: f"coalesce(round(quantile_cont(v, {p}), 2), 0)"
    return f"""select '{name}' measure, coalesce(min(v), 0)::double min, {q(0.25)}::double p25, {q(0.5)}::double median,
     coalesce(round(avg(v), 2), 0)::double mean, {q(0.75)}::double p75, coalesce(max(v), 0)::double max from ({values})"""


def top(values: str, limit: int = 20) -> str:
    return f"select value, count(*) count from ({values}) group by value order by count(*) desc, min(record_number), value limit {limit}"


def signatures(c: str) -> str:
    return f"""with {TRAINING}
    select array_to_string(s, '|') signature, n row_count, array_to_string(r[1:20], ',') first_records from
     (select {c} s, count(*) n, list_sort(list(record_number)) r from training where len({c}) > 0 group by {c})
    order by n desc, len(s), s limit 20"""


_TEXT = r"""list_transform(regexp_extract_all(',' || line, ',("([^"]|"")*"|[^",]*)', 1), lambda f: case when f[1] = '"' then replace(f[2 : -2], '""', '"') else f end)"""
PARSED = rf"""lines as (select csv_line_number, regexp_replace(coalesce(raw_line, ''), '\r$', '') line from raw_training_lines),
split as (select csv_line_number, line, regexp_full_match(line, '("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*') sound from lines),
fielded as (select csv_line_number, line, sound, case when sound then {_TEXT} else [] end f,
  sound and len(list_filter(regexp_extract_all(',' || line, ',("([^"]|"")*"|[^",]*)', 1), lambda f: f[1] <> '"' and regexp_matches(f, '[\r\n]'))) > 0 broken from split),
kinds as (select *, case when not sound then 'broken_quoting' when broken or len(f) <> 8 then 'column_count' end whole from fielded),
arrays as (select csv_line_number, u.field, u.txt, case when {strip("u.txt")} = '' then 'blank' when not json_valid(u.txt) or regexp_matches(u.txt, ',\s*\]\s*$') then 'invalid_json' when json_type(u.txt) <> 'ARRAY' then 'not_an_array' else 'array' end kind
  from kinds, lateral (values ('docIds', f[3]), ('chunk_ids', f[4])) u(field, txt) where whole is null),
items as (select csv_line_number, field, unnest(json_extract(txt, '$[*]')) j from arrays where kind = 'array'),
texts as (select csv_line_number, field, json_type(j) t, json_extract_string(j, '$') s from items),
cited as (select csv_line_number, s, {strip("regexp_extract(s, '(?s)^(.*)#[^#]*$', 1)")} doc, {strip("regexp_extract(s, '(?s)#([^#]*)$', 1)")} idx from texts where t = 'VARCHAR' and field = 'chunk_ids' and {strip("s")} <> ''),
issues as (select csv_line_number, 'record' field, whole error from kinds where whole is not null
 union select csv_line_number, field, kind from arrays where kind in ('invalid_json', 'not_an_array') union select csv_line_number, field, 'item_not_string' from texts where t <> 'VARCHAR'
 union select csv_line_number, 'chunk_ids', case when not contains(s, '#') then 'no_hash' when doc = '' then 'empty_doc' when not regexp_full_match(idx, '[+-]?[0-9]+') then 'index_not_integer' when idx[1] = '-' and regexp_matches(idx, '[1-9]') then 'index_negative' else '' end from cited
 union select csv_line_number, 'source_row_number', 'not_an_integer' from kinds where whole is null and {strip("f[6]")} <> '' and not regexp_full_match({strip("f[6]")}, '[0-9]+')
 union select csv_line_number, 'is_exact_duplicate', 'not_a_boolean' from kinds where whole is null and {strip("f[7]")} <> '' and lower({strip("f[7]")}) not in ('true', 'false', 'yes', 'no', 'y', 'n', '1', '0'))"""

ORACLES = {
    "p6_found": f"with {PARSED} select csv_line_number, field, error from issues where error <> ''",
    "p6_loaded": f"""with {PARSED} select k.csv_line_number, f[1] question, f[2] answer,
      coalesce((select list({strip("s")}) from texts t where t.csv_line_number = k.csv_line_number and field = 'docIds' and {strip("s")} <> ''), []) doc_ids,
      coalesce((select list(doc || '#' || case when ltrim(ltrim(idx, '+-'), '0') = '' then '0' else ltrim(ltrim(idx, '+-'), '0') end) from cited t where t.csv_line_number = k.csv_line_number), []) chunk_ids,
      f[5] pipeline, f[6] source_row_number, lower({strip("f[7]")}) in ('true', 'yes', 'y', '1') is_exact_duplicate, f[8] duplicate_of_row
      from kinds k where whole is null and csv_line_number not in (select csv_line_number from issues where error <> '')""",
    "source_row_counts": f"""with {TRAINING}
     select count(*) total, count(*) filter (not is_dup) non_duplicate, count(*) filter (is_dup) exact_duplicate,
      count(*) filter (len(doc_ids) = 0) rows_missing_doc_ids, count(*) filter (len(chunk_ids) = 0) rows_missing_chunk_ids from training""",
    "source_unique_counts": f"""with {TRAINING}
     select (select count(distinct d) from (select unnest(doc_ids) d from training)) docs_from_docids,
      (select count(distinct {doc_of("c")}) from (select unnest(chunk_ids) c from training)) docs_from_chunk_ids,
      (select count(distinct c) from (select unnest(chunk_ids) c from training)) chunks,
      (select count(distinct evidence_signature) from training where len(evidence_signature) > 0) evidence_signatures,
      (select count(distinct doc_set_signature) from training where len(doc_set_signature) > 0) doc_set_signatures,
      (select count(distinct {norm_question("question")}) from training where question <> '') normalized_questions""",
    "citations_per_row_summary": f"""with {TRAINING}
     {summary("chunk_ids_per_row", "select len(chunk_ids) v from training")} union all
     {summary("doc_ids_per_row", "select len(doc_ids) v from training")} union all
     {summary("question_reuse", f"select count(*) v from training where question <> '' group by {norm_question('question')}")}""",
    "top_chunks": f"with {TRAINING} {top('select record_number, unnest(evidence_signature) value from training')}",
    "top_docs": f"with {TRAINING} {top('select record_number, unnest(doc_set_signature) value from training')}",
    "pipeline_distribution": f"""with {TRAINING} {top("select record_number, case when pipeline = '' then '<blank>' else pipeline end as value from training")}""",
    "duplicate_pipeline_distribution": f"""with {TRAINING} {top("select record_number, case when pipeline = '' then '<blank>' else pipeline end as value from training where is_dup")}""",
    "duplicate_of_distribution": f"""with {TRAINING} {top("select record_number, case when duplicate_of = '' then '<blank>' else duplicate_of end as value from training")}""",
    "top_evidence_signatures": signatures("evidence_signature"),
    "top_doc_sets": signatures("doc_set_signature"),
    "question_reuse": f"""with {TRAINING}
     select uses, count(*) questions from (select count(*) uses from training where question <> '' group by {norm_question("question")}) group by uses""",
    "docids_chunk_mismatch": f"""with {TRAINING}
     select record_number, string_agg(d, '|' order by d) missing_doc_ids from
      (select distinct record_number, {doc_of("c")} d, doc_ids from (select record_number, doc_ids, unnest(chunk_ids) c from training))
     where not list_contains(doc_ids, d) group by record_number""",
    "one_sided_docs": f"""with {TRAINING},
     a as (select distinct unnest(doc_ids) d from training), b as (select distinct {doc_of("c")} d from (select unnest(chunk_ids) c from training))
     select d doc_id, 'doc_ids' seen_in from a where d not in (select d from b) union all select d, 'chunk_ids' from b where d not in (select d from a)""",
    "train_keys": f"with {KEYED} select record_number, train_key, doc_key from keyed",
    "eval_question_hashes": f"""select row_id, sha256('{{"eval_question":' || {json_string(norm_question("coalesce(question, '')"))} || '}}') question_hash from generated_eval_rows""",
    "delta_new_keys": f"""with {KEYED}, latest as (select max(snapshot_id) s from keyed),
     now as (select train_key, arg_max(doc_key, record_number) doc_key from keyed where snapshot_id = (select s from latest) group by train_key)
     select train_key, doc_key, (select s from latest) first_seen_snapshot from now
     where train_key not in (select train_key from keyed where snapshot_id < (select s from latest))""",
    "delta_summary": f"""with {KEYED}, latest as (select max(snapshot_id) s from keyed),
     cur as (select * from keyed where snapshot_id = (select s from latest)), led as (select * from keyed where snapshot_id < (select s from latest)),
     fresh as (select train_key, arg_max(doc_key, record_number) doc_key from cur where train_key not in (select train_key from led) group by train_key)
     select (select count(*) from cur) row_count, (select count(distinct train_key) from cur) unique_train_keys, (select count(distinct train_key) from led) known_train_keys,
      (select count(*) from fresh) new_train_keys, (select count(distinct doc_key) from fresh where doc_key not in (select doc_key from led)) new_doc_keys""",
    "p7_found": f"""select d doc_id from (select distinct record_number, d from (select record_number, {strip("x")} d from (select record_number, unnest(doc_ids) x from training_rows)) where d <> '')
     group by d having count(*) >= 0.02 * (select count(*) from training_rows)""",
    "p7_figures": f"""with {TRAINING},
     held as (select t.record_number, t.question, coalesce(r.answer, '') answer, evidence_signature, unnest(doc_set_signature) doc_id from training t join training_rows r using (record_number)),
     figures as (select doc_id, count(*) as rows, count(distinct {norm_question("question")}) distinct_questions, quantile_disc(length(answer), 0.5) p from held group by doc_id),
     chunked as (select doc_id, count(distinct c) n from (select doc_id, unnest(evidence_signature) c from held) group by doc_id)
     select f.doc_id, f.rows, distinct_questions, coalesce(n, 0) distinct_chunks, p answer_chars_p50 from figures f left join chunked c on c.doc_id = f.doc_id""",
}
