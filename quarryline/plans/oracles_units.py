"""DuckDB statements for work units, hydration, rule checks, replies and exports."""

from __future__ import annotations

from .oracles import KEYED, collapse, doc_of, fold, json_list, json_string, norm_question, ref, strip
from .oracles_clusters import CLUSTERS

RELATED_LIMIT, MEMORY_LIMIT, DISTINCT_LIMIT = 10, 3, 5

UNITS = f"""{CLUSTERS},
parts as (select *, unnest(range(1, cast(ceil(chunk_count / 6.0) as bigint) + 1)) part, ceil(chunk_count / 6.0) > 1 many from clusters),
units as (select 'asg_' || lpad(cast(row_number() over (order by case kind when 'co_citation' then 0 when 'doc_set' then 1 when 'doc_local_seen_chunks' then 2 when 'multi_doc_bridge' then 3 else 4 end,
   -doc_count, chunk_count, cluster_id, part) as varchar), 6, '0') assignment_id,
  cluster_id parent_cluster_id, case when many then cluster_id || '_part' || lpad(cast(part as varchar), 2, '0') else cluster_id end cluster_id, kind cluster_kind, part,
  chunk_ids[(part - 1) * 6 + 1 : part * 6] chunk_ids, list_sort(list_distinct(list_transform(chunk_ids[(part - 1) * 6 + 1 : part * 6], lambda x: {doc_of("x")}))) doc_ids,
  case when many and split_from = '' then 'microcluster_budget' else split_from end split_from, row_count, edge_density from parts),
carded as (select *, length('{{"assignment_id":"' || assignment_id || '","cluster_kind":"' || cluster_kind || '","chunk_ids":' || {json_list("chunk_ids")} || ',"doc_ids":' || {json_list("doc_ids")} || '}}') prompt_chars,
  sha256({json_list("doc_ids")}) doc_key from units)"""

LAST = "last_rows as (select train_key, arg_max(question, record_number) question, arg_max(evidence_signature, record_number) es from keyed group by train_key)"

TOKENS = lambda c: f"list_distinct(regexp_extract_all(lower({c}), '[a-z0-9]{{2,}}'))"
JACCARD = "case when len(a) > 0 and len(b) > 0 then len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) else 0 end"

GENERATED = f"""
gen as (select row_id, batch_no, assignment_id, eval_question_hash, created_at, doc_key, status, question raw_question, {strip("question")} question, {strip("answer")} answer,
  list_filter(list_transform(coalesce(chunk_ids, []), lambda x: {ref("x")}), lambda x: x is not null) chunk_ids,
  list_sort(list_distinct(list_filter(list_transform(coalesce(allowed_doc_ids, []), lambda x: {strip("x")}), lambda x: x <> ''))) doc_ids,
  list_distinct(list_filter(list_transform(coalesce(seed_train_keys, []), lambda x: {strip("x")}), lambda x: x <> '')) seed_train_keys
  from generated_eval_rows),
gc as (select distinct row_id, chunk_id, {doc_of("chunk_id")} doc, doc_ids from (select row_id, doc_ids, unnest(chunk_ids) chunk_id from gen)),
seen as (select distinct unnest(evidence_signature) chunk_id from keyed),
derived as (select row_id, list_sort(list_distinct(list(doc))) docs, count(*) filter (chunk_id not in (select chunk_id from seen)) unseen,
  count(*) filter (not list_contains(doc_ids, doc)) strange from gc group by row_id)"""

LINKS = f"""{UNITS}, {GENERATED}, {LAST},
place as (select unnest(chunk_ids) first_chunk, assignment_id, parent_cluster_id from units),
firsts as (select first_chunk, min(assignment_id) a, arg_min(parent_cluster_id, assignment_id) c from place group by 1),
links as (select g.row_id, case when g.row_id % 9 = 0 then '' else coalesce(f.a, 'asg_unknown') end assignment_id, coalesce(f.c, case when g.row_id % 2 = 0 then 'eqg_none' end) cluster_id,
  list_distinct(g.chunk_ids) cited, g.chunk_ids[1] head, g.question, g.answer, g.doc_ids, g.seed_train_keys from gen g left join firsts f on f.first_chunk = g.chunk_ids[1]),
derived2 as (select row_id, coalesce(list_sort(list_distinct(list_transform(cited, lambda x: {doc_of("x")}))), []) docs from links)"""

COLLECTED2 = f"""with recursive {LINKS},
lined as (select l.*, d.docs, row_number() over (partition by l.assignment_id order by l.row_id) ordinal, l.row_id % 10 s from links l join derived2 d using (row_id) where l.row_id % 10 <> 2),
shaped as (select l.*, u.cluster_id micro, u.parent_cluster_id parent, u.doc_ids allowed_docs, u.chunk_ids allowed, case when s = 8 then case when len(cited) > 0 then [head] else [] end else cited end ids,
  case when s = 6 then '' else l.answer end said from lined l join units u on u.assignment_id = l.assignment_id),
judged as (select *, assignment_id || '_q' || lpad(cast(ordinal as varchar), 2, '0') candidate_id,
  case when s in (3, 4) then ['malformed_jsonl'] else list_filter([case when question = '' then 'empty_question' end, case when said = '' then 'empty_answer' end, case when len(ids) = 0 then 'empty_chunk_ids' end,
   case when len(list_filter(ids, lambda x: not list_contains(allowed, x))) > 0 then 'chunk_not_in_assignment' end,
   case when len(docs) = 0 then 'empty_docIds' when docs <> list_sort(list_distinct(list_transform(ids, lambda x: {doc_of("x")}))) then 'docIds_do_not_match_chunk_ids' end], lambda x: x is not null) end reasons from shaped)"""

CHECKED = f"""with recursive {LINKS},
related as (select row_id, unnest(seed_train_keys) train_key from links union select row_id, s.train_key from links l join seeds s on s.cluster_id = l.cluster_id),
scored as (select row_id, train_key, {JACCARD} similarity from (select row_id, r.train_key, {TOKENS("l.question")} a, {TOKENS("t.question")} b from related r join links l using (row_id) join last_rows t on t.train_key = r.train_key)),
best as (select row_id, train_key, similarity, row_number() over (partition by row_id order by similarity desc, train_key) rn from scored where similarity > 0),
exact as (select distinct {norm_question("question")} q from keyed where question <> ''),
stray as (select row_id, count(*) n from (select row_id, unnest(cited) c from links) where c not in (select chunk_id from seen) group by 1),
validated as (select l.row_id, l.assignment_id, list_filter([case when l.row_id % 17 = 0 and l.row_id % 19 <> 0 then 'missing_column:pipeline' end, case when l.question = '' then 'empty_question' end, case when l.answer = '' then 'empty_answer' end,
  case when l.row_id % 19 = 0 then 'docIds_not_string_array' end, case when len(cited) = 0 then 'empty_chunk_ids' end, case when s.n > 0 then 'unseen_chunk_id' end,
  case when (case when l.row_id % 19 = 0 then [] else l.doc_ids end) <> d.docs then 'docIds_do_not_match_chunk_ids' end,
  case when regexp_matches(l.question, '(?i)\\bclf-[a-z0-9]+#[0-9]+\\b') then 'question_contains_internal_chunk_id' end,
  case when {norm_question("l.question")} in (select q from exact) then 'exact_training_question_duplicate' end,
  case when len(list_filter(cited, lambda x: not list_contains(u.chunk_ids, x))) > 0 then 'chunk_id_not_in_assignment_allowed_chunks' end,
  case when l.cluster_id is not null and k.cluster_id is null then 'unknown_candidate_cluster' end,
  case when len(list_filter(cited, lambda x: not list_contains(k.chunk_ids, x))) > 0 then 'chunk_id_not_in_candidate_cluster' end,
  case when coalesce(b.similarity, 0) >= 0.85 then 'too_similar_to_related_training_question' end], lambda x: x is not null) reasons,
  round(coalesce(b.similarity, 0), 4) similarity, b.train_key most_similar_train_key
  from links l join derived2 d using (row_id) left join stray s on s.row_id = l.row_id left join units u on u.assignment_id = l.assignment_id left join clusters k on k.cluster_id = l.cluster_id
   left join best b on b.row_id = l.row_id and b.rn = 1)"""

HASH = f"""case when coalesce(eval_question_hash, '') <> '' then eval_question_hash else sha256('{{"eval_question":' || {json_string(norm_question(strip("question")))} || '}}') end"""

COLLECTED = f"""with {KEYED}, {GENERATED},
collected as (select g.row_id, list_filter([case when question = '' then 'empty_question' end, case when answer = '' then 'empty_answer' end,
  case when d.docs is null then 'empty_chunk_ids' end, case when d.unseen > 0 or d.strange > 0 then 'chunk_not_in_assignment' end,
  case when len(doc_ids) = 0 then 'empty_docIds' when doc_ids <> coalesce(d.docs, []) then 'docIds_do_not_match_chunk_ids' end], lambda x: x is not null) reasons
  from gen g left join derived d using (row_id))"""

SIMILAR = f"""with {KEYED}, {LAST}, {GENERATED},
pairs as (select row_id, s.train_key, {TOKENS("s.question")} a, {TOKENS("l.question")} b from (select row_id, question, unnest(seed_train_keys) train_key from gen) s join last_rows l using (train_key)),
scored as (select row_id, train_key, {JACCARD} similarity from pairs),
best as (select row_id, train_key, similarity, row_number() over (partition by row_id order by similarity desc, train_key) rn from scored where similarity > 0)"""

HYDRATED = rf"""with {KEYED},
wanted as (select distinct unnest(evidence_signature) chunk_id from keyed),
fetched as (select * from (select {ref("chunk_id")} cid, hydration_status, fetch_status, fetch_error_kind, text, row_number() over (partition by {ref("chunk_id")}
  order by hydration_status = 'ok' desc, fetched_at desc, coalesce(text, '') desc, coalesce(fetch_error_kind, '') desc) rn from evidence_chunks) where rn = 1),
hydrated as (select w.chunk_id, {doc_of("w.chunk_id")} doc_id,
  coalesce(f.hydration_status, case when s.doc_id is not null then 'missing_chunk' else 'no_hit' end) hydration_status,
  coalesce(f.fetch_status, case when s.doc_id is not null then 'ok' else 'no_hit' end) fetch_status, f.fetch_error_kind,
  {collapse("regexp_replace(coalesce(f.text, ''), '^\\[Page [0-9]+(?:-[0-9]+)?\\][ \t\n]*', '')")} cleaned
  from wanted w left join fetched f on f.cid = w.chunk_id left join source_docs s on s.doc_id = {doc_of("w.chunk_id")})"""

REPLY = """case row_id % 7
 when 0 then '{"verdict":"accept","answer_support":"supported","distinctness":"distinct","citation_quality":"sufficient","eval_quality":"useful","difficulty":"hard","supporting_chunk_ids":["' || first_chunk || '"]}'
 when 1 then '{"verdict":"accept","answer_support":"supported","distinctness":"distinct","citation_quality":"sufficient","eval_quality":"useful","difficulty":"easy","supporting_chunk_ids":["' || first_chunk || '"]}'
 when 2 then '{"verdict":"reject","answer_support":"partial","distinctness":"too_similar","citation_quality":"over_cited","eval_quality":"weak","difficulty":"medium"}'
 when 3 then '{"verdict":"accept","grounding":"supported","distinctness":"distinct","chunk_sufficiency":"sufficient","usefulness":"useful","difficulty":"medium","supporting_chunk_ids":["zz-999#0"]}'
 when 4 then '{"verdict":"maybe"}'
 when 5 then '["not an object"]'
 else 'Verdict: {"verdict":"accept","answer_support":"supported","distinctness":"distinct","citation_quality":"sufficient","eval_quality":"useful","difficulty":"medium","supporting_chunk_ids":["' || first_chunk || '"],"unnecessary_chunk_ids":["x"]} end.' end"""

GATED = f"""with {KEYED}, {GENERATED},
gated as (select row_id, batch_no, case row_id % 7 when 0 then [] when 1 then ['difficulty_too_low']
  when 2 then ['judge_verdict_reject', 'answer_not_supported', 'too_similar', 'citation_over_cited', 'eval_quality_weak', 'missing_supporting_chunk_ids']
  when 3 then ['supporting_chunk_outside_cited']
  when 4 then ['judge_verdict_reject', 'answer_not_supported', 'too_similar', 'citation_insufficient', 'eval_quality_weak', 'difficulty_too_low', 'missing_supporting_chunk_ids']
  when 5 then ['judge_verdict_reject', 'answer_not_supported', 'too_similar', 'citation_insufficient', 'eval_quality_weak', 'difficulty_too_low', 'missing_supporting_chunk_ids']
  else ['citation_over_cited'] end r, len(chunk_ids) > 0 has from gen),
gate as (select row_id, batch_no, case when not has and row_id % 7 in (0, 1, 6) then list_append(r, 'supporting_chunk_outside_cited') else r end reasons from gated)"""

ORACLES = {
    "assignment_splits": f"""with recursive {UNITS} select assignment_id, cluster_id, parent_cluster_id, cluster_kind, part, array_to_string(chunk_ids, '|') chunk_ids, array_to_string(doc_ids, '|') doc_ids, split_from from units""",
    "assignment_admission": f"""with recursive {UNITS} select assignment_id, prompt_chars, case when len(chunk_ids) < 2 then 'too_few_chunks' else '' end || case when prompt_chars > 30000 then '|prompt_too_large' else '' end reasons from carded""",
    "cluster_scores": f"""with recursive {UNITS} select assignment_id, round(edge_density * sqrt(row_count) * case when len(chunk_ids) between 4 and 6 then 1.15 when len(chunk_ids) between 3 and 8 then 1.0 when len(chunk_ids) = 2 then 0.7 else 0.6 end
      * case when len(doc_ids) between 2 and 3 then 1.2 when len(doc_ids) > 5 then 0.8 else 1.0 end, 3) score from units""",
    "related_row_rank": f"""with recursive {UNITS}, {LAST},
      uc as (select assignment_id, unnest(chunk_ids) chunk_id from units),
      kc as (select distinct train_key, unnest(evidence_signature) chunk_id from keyed),
      pairs as (select assignment_id, train_key from uc join kc using (chunk_id) union select assignment_id, train_key from units u join seeds s on s.cluster_id = u.parent_cluster_id),
      facts as (select assignment_id, train_key, len(list_intersect(l.es, u.chunk_ids)) overlap, l.es = list_sort(u.chunk_ids) exact_same, len(l.es) > 0 and len(list_intersect(l.es, u.chunk_ids)) = len(l.es) is_subset, len(l.es) n
        from pairs join last_rows l using (train_key) join units u using (assignment_id)),
      ranked as (select *, row_number() over (partition by assignment_id order by exact_same desc, is_subset desc, overlap desc, n - overlap, train_key) rank from facts)
      select assignment_id, rank, train_key, overlap, exact_same, is_subset from ranked where rank <= {RELATED_LIMIT}""",
    "run_memory_topk": f"""with recursive {UNITS}, {GENERATED},
      newest as (select doc_key, q, arg_min(row_id, (age, row_id)) row_id, min(age) age from (select doc_key, {fold("question")} q, row_id, -epoch_us(created_at) age from gen where status in ('generated', 'accepted') and coalesce(doc_key, '') <> '' and question <> '') group by 1, 2),
      top as (select *, row_number() over (partition by doc_key order by age, row_id) rank from newest)
      select assignment_id, rank, t.row_id from carded c join top t using (doc_key) where rank <= {MEMORY_LIMIT}""",
    "hydrated_chunks": f"""{HYDRATED} select chunk_id, doc_id, hydration_status, fetch_status, fetch_error_kind, case when hydration_status = 'ok' then sha256(cleaned) end text_sha256, case when hydration_status = 'ok' then length(cleaned) end chars from hydrated""",
    "hydration_status": f"""with recursive {UNITS}, {HYDRATED.partition(KEYED + ",")[2]},
      f as (select assignment_id, count(*) chunks, count(*) filter (coalesce(hydration_status, '') <> 'ok') missing, max((fetch_status = 'error' and fetch_error_kind = 'network_permission_denied')::int) blocked,
        max((fetch_status = 'error' and fetch_error_kind in ('connection_refused', 'timeout'))::int) unreachable, max((fetch_status = 'error')::int) err, max((fetch_status = 'wrong_doc')::int) wrong,
        max((fetch_status = 'no_hit')::int) no_hit, max((hydration_status = 'missing_chunk')::int) gap from (select assignment_id, unnest(chunk_ids) chunk_id from units) left join hydrated using (chunk_id) group by 1)
      select assignment_id, case when missing = 0 then 'ok' when blocked = 1 then 'store_access_blocked' when unreachable = 1 then 'store_unreachable' when err = 1 then 'store_fetch_error' when wrong = 1 then 'store_wrong_doc'
        when no_hit = 1 then 'store_doc_missing' when gap = 1 then 'missing_chunks' else 'hydration_incomplete' end status, chunks, missing from f""",
    "collected_candidates": f"{COLLECTED} select row_id, array_to_string(reasons, '|') reasons from collected",
    "collection_reject_reasons": f"{COLLECTED} select reason, count(*) as rows from (select unnest(reasons) reason from collected) group by reason",
    "max_question_jaccard": f"{SIMILAR} select row_id, train_key, round(similarity, 4) similarity from best where rn = 1",
    "validated_candidates": f"{CHECKED} select row_id, array_to_string(reasons, '|') reasons, similarity, most_similar_train_key from validated",
    "validation_reasons": f"{CHECKED} select reason, count(*) as rows from (select unnest(reasons) reason from validated) group by reason",
    "judge_distinctness_topk": f"""with {KEYED}, {LAST}, {GENERATED},
      kc as (select distinct train_key, unnest(evidence_signature) chunk_id from keyed),
      shared as (select row_id, train_key, count(*) overlap from gc join kc using (chunk_id) group by 1, 2),
      pairs as (select row_id, train_key, overlap, {TOKENS("g.question")} a, {TOKENS("l.question")} b from shared join last_rows l using (train_key) join gen g using (row_id)),
      ranked as (select *, row_number() over (partition by row_id order by overlap desc, s desc, train_key) rank from (select row_id, train_key, overlap, {JACCARD} s from pairs))
      select row_id, rank, train_key, overlap, round(s, 4) similarity from ranked where rank <= {DISTINCT_LIMIT}""",
    "assignment_cards": f"""with recursive {LINKS},
      uc as (select assignment_id, unnest(chunk_ids) chunk_id from units), kc as (select distinct train_key, unnest(evidence_signature) chunk_id from keyed),
      rel as (select assignment_id, count(*) n from (select assignment_id, train_key from uc join kc using (chunk_id) union select assignment_id, train_key from units u join seeds s on s.cluster_id = u.parent_cluster_id) group by 1),
      newest as (select doc_key, q, 1 from (select doc_key, {fold("question")} q from gen where status in ('generated', 'accepted') and coalesce(doc_key, '') <> '' and question <> '') group by 1, 2),
      avoid as (select doc_key, least(count(*), {MEMORY_LIMIT}) n from newest group by 1)
      select assignment_id, parent_cluster_id cluster_id, cluster_id microcluster_id, array_to_string(list_sort(list_distinct(list_transform(chunk_ids, lambda x: {doc_of("x")}))), '|') allowed_doc_ids, len(chunk_ids) chunk_count,
       coalesce(r.n, 0) related_count, greatest(coalesce(r.n, 0) - {RELATED_LIMIT}, 0) omitted, coalesce(a.n, 0) earlier_questions from carded c left join rel r using (assignment_id) left join avoid a using (doc_key)""",
    "hydrated_cards": f"""with recursive {UNITS}, {HYDRATED.partition(KEYED + ",")[2]},
      one as (select assignment_id, chunk_id, case when hydration_status = 'ok' then length(cleaned) end chars, hydration_status, fetch_status, fetch_error_kind from (select assignment_id, unnest(chunk_ids) chunk_id from units) left join hydrated using (chunk_id)),
      f as (select assignment_id, count(*) filter (chars is null) missing, coalesce(sum(chars), 0) chars, coalesce(array_to_string(list_sort(list(chunk_id) filter (chars is null)), '|'), '') names, max((fetch_status = 'error' and fetch_error_kind = 'network_permission_denied')::int) blocked,
        max((fetch_status = 'error' and fetch_error_kind in ('connection_refused', 'timeout'))::int) unreachable, max((fetch_status = 'error')::int) err, max((fetch_status = 'wrong_doc')::int) wrong, max((fetch_status = 'no_hit')::int) no_hit, max((hydration_status = 'missing_chunk')::int) gap from one group by 1)
      select assignment_id, case when missing = 0 then '' else (case when blocked = 1 then 'store_access_blocked' when unreachable = 1 then 'store_unreachable' when err = 1 then 'store_fetch_error' when wrong = 1 then 'store_wrong_doc'
        when no_hit = 1 then 'store_doc_missing' when gap = 1 then 'missing_chunks' else 'hydration_incomplete' end) || '_after_assignment_hydration' end reasons, names missing, chars from f""",
    "candidate_links": f"with recursive {LINKS} select row_id, assignment_id, cluster_id from links",
    "collected_outputs": f"{COLLECTED2} select candidate_id, array_to_string(reasons, '|') reasons, case when s = 5 then 'extra_columns_ignored' else '' end warnings, case when s in (3, 4) then 0 else len(ids) end chunks from judged",
    "memory_records": f"""{COLLECTED2} select assignment_id, parent cluster_id, micro microcluster_id, sha256({json_list("allowed_docs")}) doc_key, sha256('{{"eval_question":' || {json_string(norm_question("question"))} || '}}') eval_question_hash, 'generated' status from judged where len(reasons) = 0""",
    "prior_questions_topk": f"""with recursive {LINKS},
      newest as (select doc_key, q, arg_min(row_id, (age, row_id)) row_id, min(age) age from (select doc_key, {fold("question")} q, row_id, -epoch_us(created_at) age from gen where status in ('generated', 'accepted') and coalesce(doc_key, '') <> '' and question <> '') group by 1, 2),
      top as (select *, row_number() over (partition by doc_key order by age, row_id) pos from newest),
      pairs as (select l.row_id, t.pos, g.raw_question question, g2.answer, {TOKENS("l.question")} a, {TOKENS("g.raw_question")} b from links l join carded c on c.assignment_id = l.assignment_id join top t on t.doc_key = c.doc_key and t.pos <= {MEMORY_LIMIT}
        join gen g on g.row_id = t.row_id join generated_eval_rows g2 on g2.row_id = t.row_id),
      ranked as (select *, row_number() over (partition by row_id order by sim desc, pos) rank from (select *, {JACCARD} sim from pairs))
      select row_id, rank, case when length({collapse("question")}) <= 400 then {collapse("question")} else rtrim(left({collapse("question")}, 397)) || '...' end question,
       case when length({collapse("left(coalesce(answer, ''), 500)")}) <= 300 then {collapse("left(coalesce(answer, ''), 500)")} else rtrim(left({collapse("left(coalesce(answer, ''), 500)")}, 297)) || '...' end answer_short, round(sim, 4) similarity from ranked where rank <= 2""",
    "judge_preflight": f"""with recursive {LINKS}, {HYDRATED.partition(KEYED + ",")[2]},
      n as (select l.*, u.chunk_ids allowed, cast(substr(u.assignment_id, 5) as integer) no from links l left join units u on u.assignment_id = l.assignment_id),
      bad as (select row_id, count(*) filter (coalesce(hydration_status, '') <> 'ok') missing from (select row_id, unnest(cited) chunk_id from links) left join hydrated using (chunk_id) group by 1)
      select n.row_id, case when n.assignment_id = '' then 'missing_assignment_id' when allowed is null then 'assignment_not_found' when len(cited) = 0 then 'empty_cited_chunks'
       when len(list_filter(cited, lambda x: not list_contains(allowed, x))) > 0 then 'cited_chunk_outside_assignment' when no % 13 = 0 then 'missing_assignment_evidence_bundle' when b.missing > 0 then 'missing_cited_chunk_text'
       when no % 11 = 0 then 'missing_related_training_rows_artifact' when no % 7 = 0 then 'missing_related_training_rows_bundle' when no % 5 = 0 then 'empty_related_training_rows_bundle' else '' end reason from n left join bad b using (row_id)""",
    "filter_prompts": """with b as (select (record_number - 11) // 5 batch, (record_number - 11) % 5 i, question, answer from training_rows where record_number > 10),
      p as (select batch, string_agg('[ROW ' || i || ']' || chr(10) || 'Question:' || chr(10) || coalesce(question, '') || chr(10) || chr(10) || 'Answer:' || chr(10) || coalesce(answer, '') || chr(10), chr(10) || '---' || chr(10) order by i) || chr(10) || '---' || chr(10) || 'Return your decision as JSON:' prompt from b group by 1)
      select batch, length(prompt) chars, sha256(prompt) sha from p""",
    "final_distribution": f"""with {KEYED}, {GENERATED},
      d as (select row_id, case row_id % 7 when 0 then 'hard' when 1 then 'easy' when 2 then 'medium' when 3 then 'medium' when 4 then 'easy' when 5 then 'unknown' else 'medium' end difficulty from gen),
      one as (select distinct row_id, chunk_id, doc from gc), docs as (select doc, count(distinct row_id) n from one group by 1 order by 2 desc, 1 limit 10), chunks as (select chunk_id, count(*) n from one group by 1 order by 2 desc, 1 limit 10)
      select 'difficulty' measure, difficulty as value, count(*) as count from d group by 2 union all select 'question_type', 'unknown', count(*) from d having count(*) > 0 union all select 'doc', doc, n from docs union all select 'chunk', chunk_id, n from chunks""",
    "bank_records": f"""with {KEYED}, {GENERATED}, h as (select *, sha256('{{"eval_question":' || {json_string(norm_question("question"))} || '}}') own, list_sort(list_distinct(doc_ids)) d from gen)
      select case when row_id % 3 > 0 then 'c' || row_id else own end eval_id, case when coalesce(eval_question_hash, '') <> '' then eval_question_hash else own end eval_question_hash, sha256({json_list("d")}) doc_key, 'run' run_id, 'v3' judge_version from h""",
    "judge_rollup": f"""{CHECKED},
      gated as ({GATED.partition("gated as (")[2].partition("),\ngate as")[0]}), gate as ({GATED.partition("gate as (")[2].rstrip().removesuffix(")")}),
      j as (select coalesce(g.assignment_id, '') assignment_id, len(reasons) = 0 good, t.row_id % 11 = 0 err from gate t join generated_eval_rows g using (row_id))
      select 'judge' phase, assignment_id, count(*) as rows, count(*) filter (good) accepted, count(*) filter (not good) rejected, count(*) filter (err) errors from j group by 2
      union all select 'validate', assignment_id, count(*), count(*) filter (len(reasons) = 0), count(*) filter (len(reasons) > 0), 0 from validated group by 2""",
    "subset_reject_counts": f"""with {KEYED}, bank as (select eval_id, list_filter(list_transform(coalesce(chunk_ids, []), lambda x: {ref("x")}), lambda x: x is not null) chunk_ids, coalesce(seed_train_keys, []) seeds from eval_bank),
      seen as (select distinct unnest(evidence_signature) chunk_id from keyed), hit as (select distinct eval_id from (select eval_id, unnest(seeds) k from bank) where k in (select train_key from keyed))
      select (select count(*) from bank where eval_id not in (select eval_id from hit)) no_seed_overlap, (select count(distinct eval_id) from (select eval_id, unnest(chunk_ids) c from bank where eval_id in (select eval_id from hit)) where c not in (select chunk_id from seen)) chunk_outside_subset""",
    "judge_gate": f"{GATED} select row_id, case when len(reasons) = 0 then 'accept' else 'reject' end status, array_to_string(reasons, '|') gate_reasons, reasons[1] reject_reason from gate",
    "judge_upsert": f"{GATED} select row_id, case when batch_no >= 4 then 'second' else 'first' end attempt, case when len(reasons) = 0 then 'accept' else 'reject' end status from gate",
    "filter_verdicts": """with r as (select (record_number - 1) // 5 batch, (record_number - 1) % 5 local_id from training_rows), k as (select *, batch % 4 k from r)
      select batch, local_id, case when k = 0 and local_id in (0, 2) then 'KEEP' when k = 1 and local_id = 4 then 'KEEP' when k = 3 and local_id = 3 then 'KEEP' else 'REJECT' end decision,
       case when k = 0 then case local_id when 0 then '' when 1 then 'short' when 2 then '' else 'missing_from_batch_response' end
        when k = 1 then case local_id when 0 then 'unparseable_decision' when 4 then 'ok' else 'missing_from_batch_response' end
        when k = 3 and local_id = 3 then '' else 'missing_from_batch_response' end reason from k""",
    "ledger_append": f"""with h as (select row_id, batch_no, coalesce(assignment_id, '') assignment_id, {HASH} hash from generated_eval_rows), b as (select max(batch_no) m from h),
      fresh as (select assignment_id, hash, min(row_id) row_id from h where batch_no = (select m from b) group by 1, 2)
      select row_id, assignment_id, hash from fresh f where not exists (select 1 from h where h.batch_no < (select m from b) and h.assignment_id = f.assignment_id and h.hash = f.hash)""",
    "bank_append": f"""with bank as (select distinct {HASH} hash from eval_bank), fresh as (select hash, arg_min(row_id, (batch_no, row_id)) row_id from (select row_id, batch_no, {HASH} hash from generated_eval_rows) group by 1)
      select row_id, hash from fresh where hash not in (select hash from bank)""",
    **{
        name: f"""with {KEYED}, bank as (select eval_id, eval_question_hash hash, list_filter(list_transform(coalesce(chunk_ids, []), lambda x: {ref("x")}), lambda x: x is not null) chunk_ids, coalesce(seed_train_keys, []) seeds from eval_bank),
      seen as (select distinct unnest(evidence_signature) chunk_id from keyed),
      kept as (select * from bank where eval_id in (select eval_id from (select eval_id, unnest(seeds) k from bank) where k in (select train_key from keyed)) {extra})
      select eval_id from kept where coalesce(hash, '') = '' union all select min(eval_id) from kept where coalesce(hash, '') <> '' group by hash"""
        for name, extra in (("bank_subset", ""), ("bank_subset_contained", "and eval_id not in (select eval_id from (select eval_id, unnest(chunk_ids) c from bank) where c not in (select chunk_id from seen))"))
    },
    "export_dedupe": f"""with g as (select row_id, batch_no, {norm_question("coalesce(question, '')")} q from generated_eval_rows)
      select row_id, case when q = '' then 'empty_question' when row_number() over (partition by q order by batch_no, row_id) = 1 then 'accepted' else 'duplicate_final_question' end export_status from g""",
    "chunk_id_parse": f"""with r as (select distinct unnest(chunk_ids) raw from training_rows), p as (select raw, {ref("raw")} chunk_id from r where raw is not null)
      select raw, chunk_id, case when chunk_id is not null then {doc_of("chunk_id")} end doc_id, cast(regexp_extract(chunk_id, '#([0-9]+)$', 1) as bigint) chunk_index from p where chunk_id is not null
      union all select raw, null, null, null from p where chunk_id is null""",
}
