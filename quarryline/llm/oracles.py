"""DuckDB statements for those queries of this subpackage that SQL can state, by plain brute force over the whole tables."""

from __future__ import annotations

import unicodedata

from .canonical import LOOK_ALIKES

B = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"
REF = rf"(?s)^[{B}]*(.*[^{B}])[{B}]*#[{B}]*0*([0-9]+)[{B}]*$"


def words(c: str) -> str:
    return rf"trim(regexp_replace(replace(lower(coalesce({c}, '')), 'ß', 'ss'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def refs(c: str) -> str:
    one = rf"case when regexp_matches(x, '{REF}') then regexp_replace(x, '{REF}', '\1#\2') end"
    return f"list_sort(list_distinct(list_filter(list_transform(coalesce({c}, []), lambda x: {one}), lambda x: x is not null)))"


def runs(c: str, key: str, table: str) -> str:
    """(key, run): every run of eight words."""
    return f"""select distinct {key}, array_to_string(w[i : i + 7], ' ') run from
      (select {key}, w, unnest(generate_series(1, len(w) - 7)) i from (select {key}, string_split({words(c)}, ' ') w from {table}) where len(w) > 7)"""


_LABEL = r"(^|[;|\n\r{,])([^;|\n\r{,:]*\p{L}[^;|\n\r{,:]*):"
_MARKED = f"string_split(regexp_replace(coalesce(answer, ''), '{_LABEL}', chr(1) || '\\2 ', 'g'), chr(1))"
_PARTS = r"list_filter(string_split_regex(coalesce(answer, ''), '[;|\n\r]+'), lambda x: regexp_matches(x, '[\p{L}\p{N}]'))"
_SORTED = lambda parts: f"array_to_string(list_sort(list_transform({parts}, lambda x: {words('x')})), ' ')"
_NAMED = """list_transform(json_keys(answer), lambda k: k || ' ' || coalesce(json_extract_string(answer, '$."' || k || '"'), ''))"""

RECORDS = f"""keyed as (select record_number, {words("question")} q, {refs("chunk_ids")} refs,
  case when regexp_matches(coalesce(answer, ''), '^\\s*\\{{') and json_valid(answer) and json_type(answer) = 'OBJECT' and len(json_keys(answer)) > 1 then {_SORTED(_NAMED)}
   when len({_PARTS}) > 1 and len(list_filter({_PARTS}, lambda x: not regexp_matches(x, '^[^:]*\\p{{L}}[^:]*:'))) = 0 then {_SORTED(_PARTS)}
   when len({_MARKED}) > 2 and {words(f"{_MARKED}[1]")} = '' then {_SORTED(f"{_MARKED}[2:]")} else {words("answer")} end a from training_rows),
sets as (select *, min(record_number) over (partition by q, a, refs) first_record from keyed)"""

_LOOKS = [p for p in LOOK_ALIKES.split() if p[1] != "'"]
_ALIKE = {p[0]: p[1] for p in _LOOKS}
for _c in map(chr, range(0xC0, 0x2000)):
    _d = unicodedata.normalize("NFD", _c)
    if len(_d) == 2 and _d[0] in _ALIKE and len(_made := unicodedata.normalize("NFC", _ALIKE[_d[0]] + _d[1])) == 1:
        _ALIKE[_c] = _made
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
_FORM = f"translate(nfc_normalize(translate(text, '{_WIDE}', '{_NARROW}')), '{''.join(_ALIKE)}', '{''.join(_ALIKE.values())}')"
for _a, _b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"), ("…", "...")):
    _FORM = f"replace({_FORM}, '{_a}', '{_b}')"
_FORM = rf"nfc_normalize(regexp_replace({_FORM}, '[\p{{Cf}}\x{{034F}}\x{{FE00}}-\x{{FE0F}}]', '', 'g'))"
_FORM = rf"trim(regexp_replace(regexp_replace({_FORM}, '[\t\p{{Zs}}\n\r]*[\n\r][\t\p{{Zs}}\n\r]*', chr(10), 'g'), '[\t\p{{Zs}}]+', ' ', 'g'), ' ' || chr(10))"

ORACLES = {
    "p1_found": f"""with items as ({runs("question", "item_id", "eval_items")} union {runs("answer", "item_id", "eval_items")}),
      texts as ({runs("question", "record_number", "training_rows")} union {runs("answer", "record_number", "training_rows")}), docs as ({runs("text", "doc_id", "documents")})
      select distinct 'training_rows' corpus, record_number row_key, item_id from texts join items using (run) union select distinct 'documents', doc_id, item_id from docs join items using (run)""",
    "p3_found": f"with {RECORDS} select first_record, record_number copy_record from sets where len(refs) > 0 and record_number <> first_record",
    "p3_records": f"with {RECORDS} select first_record, count(*) copies from sets group by 1",
    "p4_found": f"""with recursive links as (select record_number r, unnest({refs("chunk_ids")}) c from training_rows), star as (select c, min(r) a from links group by 1),
      edges as (select distinct a, r b from links join star using (c) where a <> r), hop as (select a, b from edges union select b, a from edges),
      reach(node, other) as (select a, a from hop union select r.node, e.b from reach r join hop e on e.a = r.other)
      select g group_record, node member_record from (select node, min(other) g from reach group by 1) where node <> g""",
    "p10_found": f"""with formed as (select doc_id, text, {_FORM} form from documents where text is not null)
      select a.doc_id doc_a, b.doc_id doc_b from formed a join formed b on a.form = b.form and a.doc_id < b.doc_id and a.text <> b.text where a.form <> ''""",
    "p10_classes": f"""with formed as (select doc_id, text, {_FORM} form from documents where text is not null)
      select doc_id, min(doc_id) over (partition by form) class_id from formed where form <> '' and form in (select form from formed group by 1 having count(distinct text) > 1)""",
}
