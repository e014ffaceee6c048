"""DuckDB statements for the graph and cluster queries."""

from __future__ import annotations

from .oracles import KEYED, doc_of, idx_of, norm_question

MAX_CHUNKS, MAX_GAP = 30, 3

GRAPH = f"""{KEYED},
live as (select * from keyed where not is_dup),
cit as (select *, {doc_of("chunk_id")} doc, {idx_of("chunk_id")} idx from
  (select record_number, train_key, doc_set_signature dss, evidence_signature es, unnest(evidence_signature) chunk_id from live)),
chunks as (select distinct chunk_id, doc, idx from cit),
edges as (select a.chunk_id src, b.chunk_id dst, count(*) weight from cit a join cit b on a.record_number = b.record_number
  and (a.doc < b.doc or (a.doc = b.doc and (a.idx < b.idx or (a.idx = b.idx and a.chunk_id < b.chunk_id)))) group by 1, 2)"""

COMPONENTS = """
hop as (select src a, dst b from edges union all select dst, src from edges),
reach(chunk_id, other) as (select chunk_id, chunk_id from chunks union select r.chunk_id, h.b from reach r join hop h on h.a = r.other),
component as (select chunk_id, min(other) component, count(*) size from reach group by chunk_id)"""


def split_part(kind_at: int, kind: str, members: str) -> str:
    """members: gkey, chunk_id, doc, idx -> kind_at, kind, gkey, sdoc, slice, chunk_id, doc, idx, group_size."""
    return f"""select {kind_at} kind_at, '{kind}' kind, gkey, case when n <= {MAX_CHUNKS} then '' else doc end sdoc,
      case when n <= {MAX_CHUNKS} then 0 else (rn - 1) // {MAX_CHUNKS} end slice, chunk_id, doc, idx, n group_size from
      (select *, count(*) over (partition by gkey) n, row_number() over (partition by gkey, doc order by idx, chunk_id) rn from ({members}))"""


CLUSTERS = f"""{GRAPH}, {COMPONENTS},
gaps as (select *, sum(brk) over (partition by doc order by idx, chunk_id rows unbounded preceding) g from
  (select *, case when idx - lag(idx) over (partition by doc order by idx, chunk_id) > {MAX_GAP} then 1 else 0 end brk from chunks)),
gapped as (select doc || '~' || lpad(cast(g as varchar), 9, '0') gkey, chunk_id, doc, idx, count(*) over (partition by doc, g) n from gaps),
members as (
 select 0 kind_at, 'exact_evidence_set' kind, array_to_string(es, '|') gkey, '' sdoc, 0 slice, chunk_id, doc, idx, 0 group_size from (select distinct es, chunk_id, doc, idx from cit)
 union all {split_part(1, "doc_set", "select distinct array_to_string(dss, '|') gkey, chunk_id, doc, idx from cit where len(dss) > 0")}
 union all {split_part(2, "co_citation", "select component gkey, chunk_id, doc, idx from component join chunks using (chunk_id) where size > 1")}
 union all {split_part(3, "doc_local_seen_chunks", "select gkey, chunk_id, doc, idx from gapped where n > 1")}
 union all {split_part(4, "multi_doc_bridge", "select distinct array_to_string(dss, '|') gkey, chunk_id, doc, idx from cit where len(dss) > 1")}),
touched as (
 select distinct kind, gkey, sdoc, slice, record_number from members m join cit c on c.chunk_id = m.chunk_id
  and case kind when 'exact_evidence_set' then array_to_string(c.es, '|') = gkey when 'doc_set' then array_to_string(c.dss, '|') = gkey
   when 'multi_doc_bridge' then array_to_string(c.dss, '|') = gkey else true end),
group_rows as (select 'exact_evidence_set' kind, array_to_string(evidence_signature, '|') gkey, count(*) n from live group by 2
 union all select k, array_to_string(doc_set_signature, '|') gkey, count(*) n from live, (values ('doc_set'), ('multi_doc_bridge')) v(k) group by 1, 2),
sets as (select kind_at, kind, gkey, sdoc, slice, list(chunk_id order by doc, idx, chunk_id) chunk_ids, list_sort(list_distinct(list(doc))) doc_ids, max(group_size) group_size,
  count(*) chunk_count, count(distinct doc) doc_count from members group by all),
split_counts as (select kind, gkey, count(*) splits from sets group by 1, 2),
support as (select t.kind, t.gkey, t.sdoc, t.slice, count(distinct train_key) row_count,
  count(distinct {norm_question("question")}) filter (question <> '') unique_question_count,
  coalesce(array_to_string(list_sort(list_distinct(list(pipeline) filter (pipeline <> ''))), '|'), '') source_pipelines
  from touched t join live l using (record_number) group by all),
comp_size as (select component gkey, max(size) size from component group by 1),
ordered as (
 select s.*, u.row_count, u.unique_question_count, u.source_pipelines, c.splits,
  row_number() over (order by s.kind_at, case when s.kind = 'doc_local_seen_chunks' then s.gkey else '' end,
   case s.kind when 'co_citation' then -cs.size when 'doc_local_seen_chunks' then 0 else -g.n end,
   case when s.kind in ('co_citation') then [s.gkey] when s.kind = 'doc_local_seen_chunks' then [] else string_split(s.gkey, '|') end, s.sdoc, s.slice) ordinal
 from sets s join support u using (kind, gkey, sdoc, slice) join split_counts c using (kind, gkey)
  left join group_rows g using (kind, gkey) left join comp_size cs on cs.gkey = s.gkey and s.kind = 'co_citation'
 where not (s.kind in ('doc_set', 'doc_local_seen_chunks') and s.chunk_count < 2) and not (s.kind = 'multi_doc_bridge' and s.doc_count < 2)),
named as (
 select *, 'eqg_' || case kind when 'exact_evidence_set' then 'exact' when 'doc_set' then 'docset' when 'co_citation' then 'cocite' when 'doc_local_seen_chunks' then 'doclocal' else 'multidoc' end
   || '_' || lpad(cast(ordinal as varchar), 6, '0') cluster_id,
  case kind when 'doc_local_seen_chunks' then case when group_size > chunk_count then 'doc_local_large_group' else '' end
   when 'exact_evidence_set' then '' else case when splits > 1 then case kind when 'doc_set' then 'large_doc_set' when 'co_citation' then 'large_co_citation_component' else 'large_multi_doc_bridge' end else '' end end split_from
 from ordered),
cm as (select cluster_id, unnest(chunk_ids) chunk_id from named),
present as (select x.cluster_id, count(*) filter (src < dst) n, count(*) n_fixed from edges e join cm x on x.chunk_id = e.src join cm y on y.chunk_id = e.dst and y.cluster_id = x.cluster_id group by 1),
clusters as (select n.*, case when chunk_count < 2 then 0 else round(coalesce(p.n, 0) / (chunk_count * (chunk_count - 1) / 2), 4) end edge_density,
  case when chunk_count < 2 then 0 else round(coalesce(p.n_fixed, 0) / (chunk_count * (chunk_count - 1) / 2), 4) end edge_density_fixed from named n left join present p using (cluster_id)),
seeds as (select distinct n.cluster_id, l.train_key from named n join touched t using (kind, gkey, sdoc, slice) join live l using (record_number))"""

FLAT = """cluster_id, array_to_string(chunk_ids, '|') chunk_ids, array_to_string(doc_ids, '|') doc_ids, source_pipelines, split_from, row_count, unique_question_count, chunk_count, doc_count, edge_density"""

ORACLES = {
    "cocitation_edges": f"with {GRAPH} select * from edges",
    "cocitation_components": f"with recursive {GRAPH}, {COMPONENTS} select chunk_id, component, size from component where size > 1",
    **{
        name: f"with recursive {CLUSTERS} select {FLAT} from clusters where kind = '{kind}'"
        for name, kind in (
            ("exact_evidence_clusters", "exact_evidence_set"),
            ("doc_set_clusters", "doc_set"),
            ("cocitation_clusters", "co_citation"),
            ("doc_local_clusters", "doc_local_seen_chunks"),
            ("multi_doc_bridge_clusters", "multi_doc_bridge"),
        )
    },
    "cluster_edge_density_fixed": f"with recursive {CLUSTERS} select cluster_id, edge_density_fixed edge_density from clusters",
    "cluster_kind_summary": f"with recursive {CLUSTERS} select kind cluster_kind, split_from, count(*) clusters, sum(chunk_count)::bigint chunks, sum(row_count)::bigint as rows from clusters group by 1, 2",
    "focused_clusters": f"""with recursive {CLUSTERS} select cluster_id, kind cluster_kind, row_count, chunk_count from clusters where cluster_id in
      (select cluster_id from seeds where train_key in (select train_key from keyed where is_dup))""",
}
