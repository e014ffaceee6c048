import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from quarryline.functions import variants
from quarryline.operators import assign, cards, collect, replies, reports, rowfilter, validate
from quarryline.sources import chunkstore, settings


def lists(spark, values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumn("v", F.try_parse_json("v"))
    return [r.x for r in df.select("i", variants.string_list(F.col("v"), **options).alias("x")).orderBy("i").collect()]


def test_lists_however_written(spark):
    given = ['[" a ", "", 1, true, null]', '"[\\"b \\", \\" \\"]"', '" plain "', '""', '"{\\"k\\": 1}"', '"7"', '"false"', "5", '{"a": 1}', "null", None]
    assert lists(spark, given) == [["a", "1", "True", "None"], ["b"], ["plain"], [], ['{"k":1}'], ["7"], [], [], [], [], []]
    assert lists(spark, given[:6], trimmed=False) == [[" a ", "1", "True", "None"], ["b "], ["plain"], [], [], []]


CARDS = "assignment_id string, allowed_chunk_ids array<string>, cluster_id string, microcluster_id string, cluster_kind string, doc_key string, allowed_doc_ids array<string>, seed_train_keys array<string>, note int"


def test_collection(spark):
    full = {"question": " q ", "answer": "a", "docIds": ["d"], "chunk_ids": ["d#1", "d#1"], "pipeline": "p"}
    texts = [json.dumps(full), "", "{oops", "[1]", json.dumps({**full, "more": 1, "answer": None}), json.dumps({**full, "chunk_ids": "d#2", "docIds": "[]"}), json.dumps({**full, "chunk_ids": [], "docIds": ["d"], "question": ""})]
    lines = spark.createDataFrame([("a1", i, t, 0) for i, t in enumerate(texts)] + [("zz", 0, texts[0], 0)], "assignment_id string, line_no long, value string, ordinal int").repartition(3)
    known = spark.createDataFrame([("a1", ["d#1"], "c", "c_part01", "k", "", ["d"], ["s"], 1)], CARDS)
    got = collect.collect_outputs(collect.output_records(lines), known)
    assert [(r.candidate_id, r.reasons, r.warnings) for r in got.orderBy("ordinal").collect()] == [
        ("a1_q01", [], []),
        ("a1_q02", ["malformed_jsonl"], []),
        ("a1_q03", ["malformed_jsonl"], []),
        ("a1_q04", ["empty_answer"], ["extra_columns_ignored"]),
        ("a1_q05", ["chunk_not_in_assignment", "empty_docIds"], []),
        ("a1_q06", ["empty_question", "empty_chunk_ids", "docIds_do_not_match_chunk_ids"], []),
    ]
    good, bad = collect.parted(got)
    assert (good.count(), bad.count()) == (1, 5)
    record = collect.memory_records(good, known, "run", 7).first()
    assert (record.created_at, record.used_chunk_ids, record.seed_train_keys, record.question, record.status) == (7, ["d#1"], ["s"], "q", "generated") and len(record.doc_key) == 64
    assert collect.collect_outputs(collect.output_records(lines.limit(0)), known).count() == 0
    assert collect.missing_assignments(known, ["a1", "b"]) == ["b"]
    with pytest.raises(ValueError, match="b"):
        collect.picked(known, ["b"])
    assert collect.picked(known, [], done=known).count() == 0 and collect.picked(known, ["a1"], limit=5).count() == 1


def test_cards_by_id(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, None), ("", 4, "z"), (None, 5, "z")], "assignment_id string, at int, v string").repartition(3)
    assert sorted(tuple(r) for r in collect.last_cards(df, "at").collect()) == [("a", 3, "y"), ("b", 2, None)]
    for bad in (df, df.limit(0)):
        with pytest.raises(ValueError, match="cards"):
            collect.require_cards(bad)
    assert collect.require_cards(collect.last_cards(df, "at")).count() == 2


def test_column_rules(spark):
    texts = ['{"question":"q","answer":null,"docIds":["d"],"chunk_ids":["d#1"],"pipeline":""}', '{"docIds":"[]","chunk_ids":[1]}', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, t string").withColumn("record", F.try_parse_json("t"))
    got = validate.candidates_of_records(df).orderBy("row_id").collect()
    assert (got[0].missing_columns, got[0].wrong_arrays, got[0].chunk_ids, got[0].answer) == ([], [], ["d#1"], "")
    assert got[1].missing_columns == ["missing_column:question", "missing_column:answer", "missing_column:pipeline"] and got[1].wrong_arrays == ["docIds_not_string_array", "chunk_ids_not_string_array"]
    assert len(got[2].missing_columns) == 5 and len(got[2].wrong_arrays) == 2 and got[2].chunk_ids == []


def test_fetch_retries_and_checks():
    waits, calls = [], []

    def look_up(doc):
        calls.append(doc)
        if doc == "busy" and calls.count("busy") < 3:
            raise urllib.error.HTTPError("u", 503, "busy", {}, None)
        return {"gone": None, "other": {"docId": "x"}}.get(doc, {"docId": f" {doc} "})

    fetch = lambda d: chunkstore.fetch_one(d, look_up, 2, 0.5, waits.append)
    assert (fetch("busy")["fetch_status"], fetch("gone")["fetch_status"], fetch("other")["fetch_error_kind"]) == ("ok", "no_hit", "wrong_doc")
    assert waits == [0.5, 1.0]

    def fails(error):
        def run(_):
            raise error

        return chunkstore.fetch_one("d", run, 1, 0, lambda s: None)

    kinds = {urllib.error.HTTPError("u", 404, "no", {}, None): ("http_404", 1), urllib.error.URLError(ConnectionRefusedError()): ("connection_refused", 2), urllib.error.URLError(PermissionError()): ("network_permission_denied", 2), urllib.error.URLError(TimeoutError()): ("timeout", 2), TimeoutError(): ("timeout", 2), urllib.error.URLError("x"): ("url_error", 2), json.JSONDecodeError("m", "d", 0): ("invalid_json_response", 2), KeyError("k"): ("KeyError", 2)}
    for error, (kind, attempts) in kinds.items():
        got = fails(error)
        assert (got["fetch_status"], got["fetch_error_kind"], got["attempts"]) == ("error", kind, attempts)


def test_fetched_chunks(spark):
    def look_up(doc):
        if doc == "e":
            raise TimeoutError
        return {"d": {"docId": "d", "title": " A  title ", "chunks_summary": ["[Page 3] one &amp; two", {"chunk": "c"}, {"text": "t"}, 5], "chunks_map": [{"chunk_index": 1, "page_numbers": [4]}, {"block_labels": ["x"]}]}, "n": None, "w": {"docId": "v"}}[doc]

    wanted = spark.createDataFrame([("d", [0, 1, 2, 3, 4, -1]), ("n", [0]), ("w", [0]), ("e", [0])], "doc_id string, chunk_indexes array<long>")
    fetched = chunkstore.fetch_documents(wanted, look_up, retries=0).cache()
    got = {r.chunk_id: r for r in chunkstore.hydrated_chunks(wanted, fetched).collect()}
    assert {k: (r.hydration_status, r.text) for k, r in got.items()} == {"d#0": ("ok", "one & two"), "d#1": ("ok", "c"), "d#2": ("ok", "t"), "d#3": ("ok", ""), "d#4": ("missing_chunk", None), "d#-1": ("missing_chunk", None), "n#0": ("store_doc_missing", None), "w#0": ("store_wrong_doc", None), "e#0": ("store_fetch_error", None)}
    assert got["d#1"].pages == [] and got["d#1"].labels == ["x"] and got["d#0"].pages == [] and got["e#0"].fetch_error_kind == "timeout"
    assert chunkstore.doc_metadata(fetched).where("doc_id = 'd'").first().title == "A title"
    units = spark.createDataFrame([("a", ["d#0", "d#4", "e#0"])], "assignment_id string, chunk_ids array<string>")
    counts = chunkstore.card_counts(chunkstore.hydrated_chunks(wanted, fetched), fetched, units).first()
    assert counts.doc_status_counts == {"ok": 1, "error": 1} and counts.chunk_status_counts == {"ok": 1, "missing_chunk": 1, "store_fetch_error": 1} and counts.error_kind_counts == {"timeout": 1} and counts.attempts == 2


def test_settings(tmp_path, monkeypatch, spark):
    env = tmp_path / ".env"
    env.write_text("# c\nA=1\nexport B = 'two words'\n\nnone\nC=\"x=y\"\n")
    read = settings.read_env(str(env))
    assert read == {"A": "1", "B": "two words", "C": "x=y"} and settings.read_env(str(tmp_path / "no")) == {}
    with pytest.raises(FileNotFoundError):
        settings.read_env(str(tmp_path / "no"), required=True)
    monkeypatch.setenv("A", "5")
    assert settings.setting("A", env=read) == "5" and settings.int_setting("C", 9, read) == 9 and settings.setting("Z", "d") == "d"
    settings.write_summary({"b": 1, "a": {"x": 2}}, str(tmp_path / "s" / "s.json"), sort_keys=True)
    assert settings.read_summary(str(tmp_path / "s" / "s.json"))["a"] == {"x": 2} and settings.read_summary(str(tmp_path / "q")) == {}
    assert (tmp_path / "s" / "s.json").read_text().index('"a"') < (tmp_path / "s" / "s.json").read_text().index('"b"')
    assert [settings.retry_delay(a) for a in (0, 3, 9)] == [1, 8, 30] and settings.retry_delay(0, "99") == 60 and settings.retry_delay(3, "2") == 8 and settings.retry_delay(1, "x") == 2
    assert settings.reply_text({"choices": [{"message": {"content": [{"text": "a"}, "b", {"content": "c"}, 5]}}]}) == "abc" and settings.reply_text({"choices": [{"text": "t"}]}) == "t"
    with pytest.raises(ValueError, match="no text"):
        settings.reply_text({"choices": [{"message": {"content": " "}}]})
    assert settings.run_id(0) == "19700101_000000" and settings.iso_time(0) == "1970-01-01T00:00:00Z" and settings.snapshot_id(0) == "train_19700101_000000"
    (tmp_path / "o.jsonl").write_text("a\n\n  \nb\n")
    assert settings.nonblank_lines(spark, str(tmp_path / "o.jsonl")) == 2
    settings.append_event(spark, str(tmp_path / "log"), event="started")
    settings.append_event(spark, str(tmp_path / "log"), event="failed", n=1)
    events = spark.read.text(str(tmp_path / "log")).select(F.get_json_object("value", "$.event").alias("event"))
    assert {r.event: r["count"] for r in settings.event_counts(events).collect()} == {"started": 1, "failed": 1}


def test_row_filter(spark):
    def ask(prompt):
        ids = [int(x.split("]")[0]) for x in prompt.split("[ROW ")[1:]]
        if "bad" in prompt and len(ids) > 1 or "worst" in prompt:
            raise RuntimeError("down")
        return json.dumps([{"row_id": i, "decision": "keep" if i % 2 == 0 else "reject", "reason": "r"} for i in ids]) if len(ids) > 1 else '{"decision": "KEEP"}'

    rows = spark.createDataFrame([(i, f"q{i}", "bad" if i == 6 else "worst" if i == 7 else None, i) for i in range(12)], "position long, question string, answer string, reason_ int")
    kept, rejected = rowfilter.filter_rows(rows, ask, rows_per_call=5, attempts=2)
    assert sorted(r.position for r in kept.collect()) == [0, 2, 4, 5, 6, 8, 9, 10]
    assert {r._source_row_index: r._reject_reason for r in rejected.collect()} == {1: "r", 3: "r", 7: "llm_error: RuntimeError: down", 11: "r"}
    assert kept.columns == rows.columns
    assert [r.position for r in rowfilter.row_range(rows, 3, 4, 6).orderBy("position").collect()] == [3, 4, 5] and rowfilter.row_range(rows, 20, 5).count() == 0
    kept, rejected = rowfilter.filter_rows(rows.limit(0), ask)
    assert kept.count() == rejected.count() == 0


GOOD = '{"verdict":"accept","answer_support":"supported","distinctness":"distinct","citation_quality":"sufficient","eval_quality":"useful","difficulty":"hard","supporting_chunk_ids":["d#1"]}'


def test_judge_run_doubles_its_tokens(spark):
    def ask(prompt, tokens):
        if "never" in prompt:
            raise RuntimeError("down")
        return GOOD if tokens >= 2800 else "cut off"

    packets = spark.createDataFrame([(1, "fine"), (2, "never")], "row_id long, packet string")
    cited = spark.createDataFrame([(1, ["d#1"]), (2, ["d#1"])], "row_id long, chunk_ids array<string>")
    before = spark.createDataFrame([(3, "assignment_not_found")], "row_id long, reason string")
    got = [(r.row_id, r.status, r.reject_reason, r.error) for r in replies.judge(packets, cited, before, ask, max_tokens=700).collect()]
    assert got == [(1, "accept", None, None), (2, "reject", "judge_error", "RuntimeError: down"), (3, "reject", "assignment_not_found", None)]
    assert replies.MAX_TOKENS == 8000


def test_packets_and_earlier_questions(spark):
    rows = spark.createDataFrame([(1, "a", "c", "who signs the form", "x", ["d"], ["d#2", "d#1"], ["k"])], "row_id long, assignment_id string, cluster_id string, question string, answer string, doc_ids array<string>, chunk_ids array<string>, seed_train_keys array<string>")
    earlier = spark.createDataFrame([("a", 1, "who signs a letter", "l" * 400), ("a", 2, " ", ""), ("a", 3, "who signs the form", "s"), ("b", 1, "who signs the form", "s")], "assignment_id string, rank int, question string, answer_short string")
    top = validate.earlier_questions_topk(rows, earlier, 3).orderBy("rank").collect()
    assert [(r.rank, r.question, len(r.answer_short)) for r in top] == [(1, "who signs the form", 1), (2, "who signs a letter", 300)]
    evidence = spark.createDataFrame([("a", "d#1", "one  text " + "w " * 2000), ("a", "d#2", "two")], "assignment_id string, chunk_id string, text string")
    compact = spark.createDataFrame([(1, 1, "k", "q")], "row_id long, rank int, train_key string, question string")
    packet = json.loads(validate.packets(rows, evidence, compact, validate.earlier_questions_topk(rows, earlier, 3), max_chunk_chars=20).first().packet)
    assert [c["chunk_id"] for c in packet["cited_chunks"]] == ["d#2", "d#1"] and packet["cited_chunks"][1]["text"] == "one text w w w w..." and len(packet["earlier_questions"]) == 2 and packet["candidate"]["chunk_ids"] == ["d#2", "d#1"]


UNITS = "assignment_id string, unit_cluster_id string, parent_cluster_id string, cluster_kind string, part int, chunk_ids array<string>, doc_ids array<string>, doc_key string, row_count long, edge_density double, ordinal long"
ROWS = "train_key string, record_number long, evidence_signature array<string>"


def test_cards_and_their_selection(spark):
    units = spark.createDataFrame([(f"asg_{i:06d}", f"c{i}", f"c{i}", "doc_set" if i % 2 else "co_citation", 1, [f"d{i}#1", f"d{i}#2"] if i else ["d0#1"], [f"d{i}"], f"k{i % 3}", 5, 0.5, i) for i in range(8)], UNITS)
    rows = spark.createDataFrame([(f"t{i}", i, [f"d{i % 8}#1"]) for i in range(40)], ROWS)
    seeds = spark.createDataFrame([("c1", "t1"), ("c1", "t2")], "cluster_id string, train_key string")
    memory = spark.createDataFrame([(1, "k1", " Old? ", "x" * 600, ["d#1"], "asg", "generated"), (2, "k1", "old?", "y", [], "asg", "generated"), (3, "k1", "new", "z", [], "asg", "rejected")], "row_id long, doc_key string, question string, answer string, chunk_ids array<string>, assignment_id string, status string").withColumn("created_at", F.current_timestamp())
    found = cards.cards(units, rows, seeds, memory, related=4, root="/r")
    got = {r.assignment_id: r for r in found.collect()}
    one = got["asg_000001"]
    assert one.related_rows.asDict() == {"complete": 6, "shown": 4, "visible_limit": 4, "capped": True, "omitted": 2}
    assert [q.question for q in one.earlier_questions] == ["Old?"] and len(one.earlier_questions[0].answer_short) == 500 and got["asg_000002"].earlier_questions == []
    assert one.paths.output == "/r/outputs/asg_000001.jsonl" and [r.chunk_index for r in one.allowed_chunk_refs] == [1, 2] and one.prompt_chars > 6 * cards.SEED_CHARS
    hydrated = spark.createDataFrame([(f"d{i}#{k}", "ok" if i != 3 else "missing_chunk", "ok", None, "text") for i in range(8) for k in (1, 2)], "chunk_id string, hydration_status string, fetch_status string, fetch_error_kind string, text string")
    built = cards.build_assignments(found, rows, hydrated, target_rows=10, questions_per_assignment=2)
    assert built.summary["needed_assignments"] == 5 and built.summary["selected_before_hydration"] == 5
    reasons = {r.assignment_id: r.reasons for r in built.rejected.collect()}
    assert reasons["asg_000000"] == ["too_few_chunks"] and reasons["asg_000003"] == ["missing_chunks_after_assignment_hydration"]
    assert sorted([*reasons, *(r.assignment_id for r in built.selected.collect())]) == sorted(got)
    assert cards.needed(1000, eval_ratio=0.0301) == 31 and cards.needed(0, eval_ratio=0.1) == 1 and cards.needed(9, max_assignments=7) == 7 and cards.needed(9) == 100
    assert cards.build_assignments(found.limit(0), rows, None).summary["selected_count"] == 0
    assert assign.split_units(spark.createDataFrame([], "cluster_id string, cluster_kind string, chunk_ids array<string>, doc_ids array<string>, split_from string, ordinal long")).count() == 0


def test_manifest(spark, tmp_path):
    df = spark.createDataFrame([("a1", 1), ("a2", None)], "assignment_id string, n int")
    cards.write_manifest(df, str(tmp_path / "m"))
    assert sorted(p.name for p in (tmp_path / "m").iterdir() if p.is_dir()) == ["assignment_id=a1", "assignment_id=a2"]


FINAL = "row_id long, candidate_id string, question string, answer string, doc_ids array<string>, chunk_ids array<string>, seed_train_keys array<string>, status string, judge_version string, difficulty string"


def test_export_of_a_judged_run(spark, tmp_path):
    rows = [(i, f"c{i}", q, "a" * 300, ["d"], ["d#1"], ["t"], "accept", "v1", d) for i, (q, d) in enumerate([("Q one", "hard"), ("q  ONE", ""), ("Q two", "hard"), ("", None)])]
    judged = spark.createDataFrame(rows, FINAL)
    bank, folder = str(tmp_path / "bank"), str(tmp_path / "run")
    with pytest.raises(ValueError, match="judge summary"):
        reports.export_final(judged, bank, folder, run_id="r", version="v1", order=["row_id"])
    settings.write_summary({"judge_version": "v1", "phase": "judge", "input_candidate_count": 4}, f"{folder}/judge_summary.json")
    first = reports.export_final(judged, bank, folder, run_id="r", version="v1", order=["row_id"])
    assert (first["final_count"], first["bank_written_count"], first["reject_reason_counts"]) == (2, 2, {"duplicate_final_question": 1, "empty_question": 1})
    assert reports.export_final(judged, bank, folder, run_id="r", version="v1", order=["row_id"])["bank_written_count"] == 0
    assert sorted(r.eval_id for r in spark.read.parquet(bank).collect()) == ["c0", "c2"]
    assert spark.read.option("header", True).csv(f"{folder}/final_csv").count() == 2
    with pytest.raises(ValueError, match="not accepted"):
        reports.export_final(judged.withColumn("status", F.lit("reject")), bank, folder, run_id="r", version="v1", order=["row_id"])
    text = reports.report("Run", judged.where("row_id in (0, 2)"), judged.withColumn("export_status", F.lit("empty_question")), [settings.read_summary(f"{folder}/judge_summary.json"), {}])
    assert "- final_count: 2" in text and '- difficulty: [["hard", 2]]' in text and "### judge" in text and "- input_candidate_count: 4" in text and "..." in text and "- empty_question" in text
    assert reports.distribution(judged.limit(0)).count() == 0


def test_judged_attempts_and_state(spark, tmp_path):
    cols = "candidate_id string, status string, reject_reason string"
    before = spark.createDataFrame([("b", "reject", "judge_error"), ("a", "accept", None), (None, "accept", None)], cols)
    again = spark.createDataFrame([("b", "accept", None), ("c", "reject", "judge_error"), ("", "accept", None)], cols)
    judged, good, bad, errors = reports.merge_judged(before, again)
    assert [r.candidate_id for r in judged.collect()] == ["a", "b", "c"] and good.count() == 2 and bad.count() == errors.count() == 1
    rows = spark.createDataFrame([("k2", "d1", 1), ("k1", "d1", 2), ("k1", "d2", 3)], "train_key string, doc_key string, record_number long")
    path = str(tmp_path / "state")
    fresh, n = reports.update_state(rows, path, "s1")
    assert n == 2 and [(r.train_key, r.doc_key) for r in fresh.collect()] == [("k1", "d2"), ("k2", "d1")]
    fresh, n = reports.update_state(rows.unionByName(spark.createDataFrame([("k3", "d", 4)], rows.schema)), path, "s2")
    assert n == 1 and spark.read.parquet(path).count() == 3
