import csv
import io
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.sources import raw_records as R

HEAD = "q,a,[],[],p,1,no,"


def issues(line):
    return sorted({(f, e) for f, _, e in R.parse_record(line)[1]})


def made(docs="", chunks="", number="", flag=""):
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(["q", "a", docs, chunks, "p", number, flag, ""])
    return out.getvalue()


def test_structure():
    assert issues(HEAD) == [] and issues(HEAD + "\r") == []
    assert issues('"open,a,[],[],p,1,no,') == [("record", "broken_quoting")]
    assert issues('"q" x,a,[],[],p,1,no,') == issues('q "x",a,[],[],p,1,no,') == issues(' "q",a,[],[],p,1,no,') == [("record", "broken_quoting")]
    assert issues('"q ""x"" y\nz",a,[],[],p,1,no,') == []
    assert issues("") == issues("a,b") == issues(HEAD + ",") == issues("q\na,b,c,d,e,f,g,h") == [("record", "column_count")]
    assert issues('"q""') == [("record", "broken_quoting")]


def test_fields():
    assert issues(made(docs="[oops")) == [("docIds", "invalid_json")]
    assert issues(made(docs='{"a":1}')) == issues(made(docs="null")) == [("docIds", "not_an_array")]
    assert issues(made(docs='["a", 1, null]')) == [("docIds", "item_not_string")]
    assert issues(made(docs=" ", chunks=" ", number=" ", flag=" ")) == []
    assert issues(made(chunks='["d#1", " ", "d", "#3", "d#x", "d# -1", "d#", "a#b# 007 "]')) == [("chunk_ids", e) for e in ("empty_doc", "index_negative", "index_not_integer", "no_hash")]
    assert issues(made(number="1.5")) == issues(made(number="-")) == [("source_row_number", "not_an_integer")]
    assert issues(made(flag="T R U E")) == [("is_exact_duplicate", "not_a_boolean")]
    row, _ = R.parse_record(made(docs='[" d ", ""]', chunks='["d # 007"]', number="12", flag=" Yes "))
    assert row["doc_ids"] == ["d"] and row["chunk_ids"] == ["d#7"] and row["is_exact_duplicate"] is True


def test_table(spark):
    rows = [(1, made(docs='["d"]'), 0), (2, None, 0), (3, "", 0), (4, made(number="x"), 0), (4, made(number="x"), 0), (5, made(docs="[" * 100_000), 0)]
    df = spark.createDataFrame(rows, "csv_line_number long, raw_line string, row int").repartition(2)
    found = sorted((r.csv_line_number, r.field, r.error) for r in R.parse_issues(df).collect())
    assert found == [(2, "record", "column_count"), (3, "record", "column_count"), (4, "source_row_number", "not_an_integer"), (4, "source_row_number", "not_an_integer"), (5, "docIds", "invalid_json")]
    assert [r.csv_line_number for r in R.loaded_rows(df).collect()] == [1]
    assert R.parse_issues(df.limit(0)).count() == R.loaded_rows(df.limit(0)).count() == 0


def test_records_are_assembled_over_lines(spark, tmp_path):
    rng = random.Random(1)
    records = [[rng.choice(['plain', 'two\nlines', 'say "x"', '', 'a,b\n\nc']) for _ in range(3)] for _ in range(60)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(records)
    lines = out.getvalue().split("\n")[:-1]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines, 1)], "file_name string, line_no long, line string").repartition(3)
    got = [r.raw_line for r in R.assemble_records(df, block_lines=7).orderBy("csv_line_number").collect()]
    assert [next(csv.reader(io.StringIO(x, newline=""))) for x in got if x] == [r for r in records]
    path = tmp_path / "t.csv"
    path.write_text("﻿" + out.getvalue())
    read = R.read_lines(spark, str(path)).orderBy("line_no").collect()
    assert [r.line for r in read] == lines and [r.line_no for r in read] == list(range(1, len(lines) + 1))


def assembled(spark, lines, **options):
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines, 1)], "file_name string, line_no long, line string")
    return [r.raw_line for r in R.assemble_records(df, **options).orderBy("csv_line_number").collect()]


def test_a_quote_never_closed_swallows_no_line(spark):
    lines = ["a,b", '"open', "c", "d", "e"]
    assert assembled(spark, lines) == assembled(spark, lines, block_lines=2) == lines


def test_a_stray_quote_costs_no_valid_line(spark):
    lines = ["a,b", 'stray",b', "c,d", '"e","f"', '"two', 'lines",g', "h,i", '"three', "lines", 'here"\r', "j,k"]
    got = assembled(spark, lines, block_lines=3)
    assert "c,d" in got and '"e","f"' in got and "a,b" in got and "h,i" in got
    assert "\n".join(got) == "\n".join(lines)


def test_a_record_may_have_any_length(spark):
    body = "\n".join(f"line {i}" for i in range(25_000))
    assert assembled(spark, ["a,b", *f'"{body}",c'.split("\n"), "d,e"], block_lines=1000) == ["a,b", f'"{body}",c', "d,e"]


def test_no_content_stops_the_load(spark):
    rows = [(1, made(chunks='["d#' + "9" * 5000 + '", "d#-' + "0" * 5000 + '", "d#-' + "9" * 5000 + '"]')), (2, made(docs='["\\ud800"]')), (3, made(docs="[" + "1" * 5000 + "]")), (4, made(docs='["\\ud83d\\ude00"]'))]
    df = spark.createDataFrame(rows, "csv_line_number long, raw_line string")
    assert sorted((r.csv_line_number, r.field, r.error) for r in R.parse_issues(df).collect()) == [(1, "chunk_ids", "index_negative"), (2, "docIds", "invalid_json"), (3, "docIds", "item_not_string")]
    assert R.loaded_rows(df).collect()[0].doc_ids == ["😀"]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), st.text('[]{}",\\\\u0d8#-1 \r\n\x00', max_size=60), st.tuples(st.text('"[]\\\\ud80,', max_size=20), st.text('["#1-\\\\ud]', max_size=20)).map(lambda x: made(*x))))
def test_any_text_is_a_row_or_issues(line):
    row, found = R.parse_record(line)
    assert (row is None) == bool(found)
    R._arrow([(row, found)])


def test_source_rows_of_files(spark, tmp_path):
    one = 'question,answer,docIds,chunk_ids,pipeline,source_row_number,is_exact_duplicate,duplicate_of_row,extra\r\n"q\r\n1",a,"[""d""]","[""d#07"",""x""]",p,1,yes,,more\r\n\r\nq2,a2\r\n"q3"x,a\r\nq4,a4,[1],,p,,no,\r\n'
    (tmp_path / "a.csv").write_bytes(("\ufeff" + one).encode())
    (tmp_path / "b.csv").write_text("answer,question\nA,Q\n")
    (tmp_path / "c.csv").write_text("answer,question\n")
    rows, issues_ = R.source_rows(spark, str(tmp_path))
    got = [(r.file_name, r.record_number, r.csv_line_number, r.question, r.answer, r.doc_ids, r.chunk_ids, r.is_exact_duplicate) for r in rows.orderBy("file_name", "record_number").collect()]
    assert got == [("a.csv", 1, 2, "q\r\n1", "a", ["d"], ["d#7"], True), ("a.csv", 2, 3, "q2", "a2", [], [], False), ("a.csv", 4, 5, "q4", "a4", [], [], False), ("b.csv", 1, 2, "Q", "A", [], [], False)]
    assert sorted((r.record_number, r.csv_line_number, r.field, r.error) for r in issues_.collect()) == [(1, 2, "chunk_ids", "no_hash"), (3, 4, "record", "broken_quoting"), (4, 5, "docIds", "item_not_string")]
