import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarryline import runtime
from quarryline.operators import assign, cluster, components, delta, docfigures, export, graph, hydrate, keyfigures, ordinals, profile, replies, select, skew
from quarryline.sources import training as T


def test_components_equal_union_find(spark):
    for seed in range(5):
        rng = random.Random(seed)
        edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(10, 70))]
        parent = list(range(60))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        want = {x: root(x) for e in edges for x in e}
        df = spark.createDataFrame([(a, b, 1) for a, b in [*edges, *edges[:5]]] + [(None, 1, 1)], "a long, b long, node int").repartition(3)
        assert {r.node: r.component for r in components.components(df).collect()} == want
    assert components.components(df.limit(0)).count() == 0


def test_components_with_a_giant_hub(spark):
    links = [(7, n) for n in range(3000)] + [(8, 5), (8, 5000), (9, 6000), (10, 6000), (11, 6001)]
    df = spark.createDataFrame(links, "key long, node long").repartition(3)
    edges = components.star_edges(df, salts=8)
    assert edges.groupBy("a").count().agg(F.max("count")).first()[0] < 1000  # no node meets all others of its key
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {n: 0 for n in [*range(3000), 5000]}


def test_hot_keys_join_in_place(spark):
    big = spark.createDataFrame([("hot", i) for i in range(50)] + [(f"k{i % 5}", i) for i in range(20)] + [(None, 1)], "key string, v int").repartition(3)
    small = big.groupBy("key").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    want = sorted((r.key, r.v, r.m) for r in big.join(small, "key").collect())
    for bound, most in ((10, None), (10, 50), (1000, 50), (1000, None), (0, None)):
        assert sorted((r.key, r.v, r.m) for r in skew.join_unique(big, small, "key", "n", most, bound).collect()) == want
    assert skew.join_unique(big.limit(0), small, "key", "n", None, 10).count() == 0


def test_ordinals_number_every_row(spark):
    rows = [(random.Random(1).random() * i % 7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "x double, i int").repartition(5)
    got = {r.i: r.ordinal for r in ordinals.with_ordinal(df, [F.col("x"), F.col("i")]).collect()}
    assert got == {i: n for n, (_, i) in enumerate(sorted(rows), 1)}
    assert ordinals.with_ordinal(df.limit(0), [F.col("i")]).count() == 0


def test_quantiles_of_hot_keys(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([-(2**62), 5, 5, 2**62, rng.randrange(10**9)])) for _ in range(2000)] + [(f"k{i}", rng.randrange(-50, 50)) for i in range(40) for _ in range(i)] + [("none", None), (None, 3)]
    df = spark.createDataFrame(rows, "key string, value long").repartition(4)
    got = {(r.key, r.fraction): (r.n, r.value) for r in keyfigures.quantiles_by_key(df, (0.0, 0.25, 0.5, 1.0)).collect()}
    held = defaultdict(list)
    for k, v in rows:
        if k is not None and v is not None:
            held[k].append(v)
    want = {}
    for k, v in held.items():
        v.sort()
        for f in (0.0, 0.25, 0.5, 1.0):
            want[k, f] = (len(v), v[max(1, -(-int(f * 100) * len(v) // 100)) - 1])
    assert got == want
    assert keyfigures.quantiles_by_key(df.limit(0)).count() == 0


ROWS = "record_number long, csv_line_number long, question string, answer string, doc_ids array<string>, chunk_ids array<string>, pipeline string, is_exact_duplicate string, duplicate_of_row string, snapshot_id string, key string, n int"


def source(spark, n=60, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        docs = rng.sample("abcd", rng.randint(0, 2))
        refs = [f"{d}#{rng.randrange(12)}" for d in docs for _ in range(rng.randint(1, 3))]
        rows.append((i, i + 1, rng.choice(["q one", "Q  One", "other?", None, ""]), "x" * rng.randrange(5), docs if rng.random() < 0.9 else None, refs + [None, " "], "p", rng.choice(["no", "", "Yes"]) if i % 5 == 0 else None, "", rng.choice(["s1", "s2"]), "z", 1))
    return spark.createDataFrame(rows, ROWS).repartition(3)


def test_doc_figures(spark):
    df = source(spark)
    rows, held = df.collect(), defaultdict(list)
    for r in rows:
        for d in set(r.doc_ids or []):
            held[d].append(r)
    got = {r.doc_id: r for r in docfigures.doc_figures(df).collect()}
    assert set(got) == set(held)
    for d, rs in held.items():
        assert got[d].rows == len(rs)
        assert got[d].distinct_questions == len({" ".join(r.question.split()).lower() for r in rs if r.question is not None})
        assert got[d].distinct_chunks == len({c for r in rs for c in r.chunk_ids if c and c.strip()})
        lengths = sorted(len(r.answer) for r in rs)
        assert got[d].answer_chars_p50 == lengths[-(-len(lengths) // 2) - 1]
    assert {r.doc_id for r in docfigures.hot_docs(df, 0.2).collect()} == {d for d, rs in held.items() if len(rs) >= 0.2 * len(rows)}
    assert docfigures.hot_docs(df.limit(0)).count() == docfigures.doc_figures(df.limit(0)).count() == 0


def test_profile_of_nothing(spark):
    rows = T.training(source(spark).limit(0))
    assert profile.row_counts(rows).first().asDict() == {"total": 0, "non_duplicate": 0, "exact_duplicate": 0, "rows_missing_doc_ids": 0, "rows_missing_chunk_ids": 0}
    assert profile.unique_counts(rows).first().chunks == 0
    assert {r.max for r in profile.citation_summaries(rows).collect()} == {0}
    assert profile.top_chunks(rows).count() == profile.question_reuse(rows).count() == 0
    one = spark.createDataFrame([(4,)], "v int")
    assert tuple(profile.numeric_summary(one, "v").first()) == (4, 4, 4, 4, 4, 4)


def test_delta_is_idempotent(spark):
    rows = T.training(source(spark))
    ledger = delta.current_keys(rows.where("snapshot_id = 's1'")).withColumn("first_seen_snapshot", F.lit("s1"))
    fresh = delta.new_keys(rows.where("snapshot_id = 's2'"), ledger, "s2")
    assert fresh.count() > 0
    assert delta.new_keys(rows, ledger.unionByName(fresh), "s3").count() == 0


def test_gap_groups(spark):
    df = spark.createDataFrame([(1, f"d#{i}", "d", i) for i in (1, 4, 8, 8)] + [(2, "e#3", "e", 3)], "record_number long, chunk_id string, doc_id string, chunk_index long")
    groups = defaultdict(set)
    for r in cluster.gap_groups(df, 3).collect():
        groups[r.group].add(r.chunk_id)
    assert sorted(map(sorted, groups.values())) == [["d#1", "d#4"], ["d#8"], ["e#3"]]


def _plan_sizes(monkeypatch):
    """Fills with the plan size of each table that is cut from now on."""
    sizes, cut = [], runtime.Cuts.cut

    def sized(self, df):
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        return cut(self, df)

    monkeypatch.setattr(runtime.Cuts, "cut", sized)
    return sizes


def test_plans_of_linked_chunks_do_not_multiply(spark, monkeypatch):
    rows = [(n, [f"d{n % 7}#{n}", f"d{n % 7}#{n + 1}", f"d{n % 5}#{n * 3}"], ["d1"]) for n in range(40)]
    live = spark.createDataFrame(rows, "record_number long, evidence_signature array<string>, doc_set_signature array<string>")
    sizes = _plan_sizes(monkeypatch)
    tied = graph.component_sizes(graph.chunk_components(T.citations(live)))
    assert tied.count() > 0
    assert len(tied._jdf.queryExecution().optimizedPlan().toString().splitlines()) < 40
    assert max(sizes) < 80


def test_members_of_groups_are_made_once(spark):
    members = spark.createDataFrame([("g", f"d{i % 3}#{i}", f"d{i % 3}", i) for i in range(9)] + [("h", "d1#1", "d1", 1)], "group string, chunk_id string, doc_id string, chunk_index int")
    split = cluster._split_keys(members.distinct(), 4)
    assert sorted((r.group, r.split.doc, r.n) for r in split.groupBy("group", "split").agg(F.count("*").alias("n")).collect()) == [("g", "d0", 3), ("g", "d1", 3), ("g", "d2", 3), ("h", "", 1)]
    assert "Join" not in split._jdf.queryExecution().optimizedPlan().toString()  # a table, which any number of readers may use


def test_cuts_leave_no_shuffle_files(spark):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: sum(tracker.getAllFiles().apply(i).getName().startswith("shuffle_") for i in range(tracker.getAllFiles().size()))
    before = files()
    back = runtime.Cuts(spark, "files").cut(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and back.count() == 7
    assert spark.conf.get(runtime.CLEANUP_KEY) == "false"


def test_density_looks_up_string_order(spark):
    members = spark.createDataFrame([("c", "d#9"), ("c", "d#10")], "cluster string, chunk_id string")
    weighted = spark.createDataFrame([("d#9", "d#10", 1)], "src string, dst string, weight long")
    assert graph.densities(members, weighted).first().edge_density == 0.0
    assert graph.densities(members, weighted, fixed=True).first().edge_density == 1.0


def test_clusters_do_not_depend_on_partitions(spark):
    rows = T.training(source(spark, 80))
    flat = lambda df: sorted((r.cluster_id, tuple(r.chunk_ids), r.row_count, r.split_from, r.edge_density) for r in df.collect())
    a, _ = cluster.clusters(rows, max_chunks=4)
    b, _ = cluster.clusters(rows.repartition(7), max_chunks=4)
    assert flat(a) == flat(b) and a.count() > 10
    assert max(len(r.chunk_ids) for r in a.where("cluster_kind <> 'exact_evidence_set'").collect()) <= 4
    assert cluster.clusters(rows.limit(0))[0].count() == 0


def test_train_keys_travel_short(spark):
    rows = T.training(source(spark, 30))
    live = rows.where("not is_dup").withColumns({"key": F.unhex(F.md5("train_key")), "question_key": F.unhex(F.md5("question"))})
    _, _, seeds = cluster._assembled(runtime.Cuts(spark, "short"), cluster.build(live, "doc_set"), live)
    assert seeds.count() > 0 and seeds.where(F.length("key") > 16).count() == 0
    _, named = cluster.clusters(rows)
    assert named.join(rows, "train_key", "left_anti").count() == 0 and named.count() == named.distinct().count()


def test_split_units(spark):
    rows = [("eqg_docset_000001", "doc_set", [f"d#{i}" for i in (10, 9, 1)] + [f"e#{i}" for i in range(7)], ["d", "e"], None, 3, 0.5)]
    found = spark.createDataFrame(rows, "cluster_id string, cluster_kind string, chunk_ids array<string>, doc_ids array<string>, split_from string, row_count long, edge_density double")
    units = assign.split_units(found).orderBy("assignment_id").collect()
    assert [u.unit_cluster_id[-7:] for u in units] == ["_part01", "_part02"]
    assert [u.chunk_ids for u in units] == [["d#1", "d#9", "d#10", "e#0", "e#1", "e#2"], ["e#3", "e#4", "e#5", "e#6"]]


CARDS = "assignment_id string, cluster_kind string, chunk_ids array<string>, doc_ids array<string>, row_count long, prompt_chars int, score double, ordinal long"


def cards(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(1, 61):
        refs = sorted({f"{rng.choice('abcdefgh')}#{rng.randrange(4)}" for _ in range(rng.randint(1, 5))})
        rows.append((f"a{i:03d}", rng.choice(["x", "y", "z"]), refs, sorted({r[0] for r in refs}), rng.randint(1, 12), rng.randint(50, 60), float(rng.randint(0, 3)), i))
    return rows, spark.createDataFrame(rows, CARDS).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_balanced_selection_follows_the_model(spark, seed):
    rows, df = cards(spark, seed)
    buckets = defaultdict(list)
    for r in rows:
        buckets[r[1]].append(r)
    for b in buckets.values():
        b.sort(key=lambda r: (len(r[3]) < 2, abs(4 - len(r[2])), -min(r[4], 8), r[5], r[0]))
    want, taken, used = [], set(), Counter()
    while len(want) < 12 and any(buckets.values()):
        before = len(want)
        for k in sorted(buckets):
            while buckets[k]:
                r = buckets[k].pop(0)
                if tuple(r[2]) in taken or any(used[d] >= 5 for d in r[3]):
                    continue
                want.append(r[0])
                taken.add(tuple(r[2]))
                used.update(r[3])
                break
            if len(want) >= 12:
                break
        if len(want) == before:
            break
    assert select.select_balanced(df, limit=12, max_per_doc=5) == want


@pytest.mark.parametrize("seed", range(3))
def test_coverage_selection_follows_the_model(spark, seed):
    rows, df = cards(spark, seed)
    limit, cap = 15, 6
    every = {c for r in rows for c in r[2]}
    open_, want, used, rest = set(every), [], Counter(), {r[0]: r for r in rows}
    rank = lambda r: (-len(set(r[2]) & open_), -r[6])
    fits = lambda r: all(used[d] < cap for d in r[3])

    def add(r):
        want.append(r[0])
        open_.difference_update(r[2])
        used.update(r[3])
        del rest[r[0]]

    pool = Counter(r[1] for r in rows)
    for kind in sorted(pool):
        n = 0
        for r in sorted([r for r in rest.values() if r[1] == kind], key=rank):
            if n >= max(3, int(pool[kind] * limit / len(rows))) or len(want) >= limit:
                break
            if fits(r):
                add(r)
                n += 1
    while len(want) < limit and len(open_) > int(len(every) * (1 - 0.98)):
        best = min((r for r in rest.values() if fits(r) and rank(r)[0] < 0), key=rank, default=None)
        if best is None:
            break
        add(best)
    for r in sorted(rest.values(), key=rank):
        if len(want) >= limit:
            break
        if fits(r):
            add(r)
    assert select.select_coverage(df, limit=limit, max_per_doc=cap) == want
    assert select.select_coverage(df.limit(0), limit=3) == select.select_balanced(df.limit(0), limit=3) == []


def test_hydration(spark):
    store = spark.createDataFrame(
        [("d#1", "ok", "ok", None, "[Page 3-4] a &amp;  b", "2031-01-01"), ("d#01", "missing_chunk", "ok", None, None, "2031-02-01"), ("d#2", "error", "error", "timeout", None, "2031-01-01")],
        "chunk_id string, hydration_status string, fetch_status string, fetch_error_kind string, text string, fetched_at string",
    )
    docs = spark.createDataFrame([("d",)], "doc_id string")
    wanted = spark.createDataFrame([("d#1",), ("d#2",), ("d#3",), ("e#1",), ("d#1",)], "chunk_id string")
    got = hydrate.hydrate(wanted, store, docs)
    assert {r.chunk_id: (r.hydration_status, r.text) for r in got.collect()} == {"d#1": ("ok", "a & b"), "d#2": ("error", None), "d#3": ("missing_chunk", None), "e#1": ("no_hit", None)}
    units = spark.createDataFrame([("u1", ["d#1"]), ("u2", ["d#1", "d#2", "e#1"]), ("u3", ["d#3"]), ("u4", ["e#1", "d#3"])], "assignment_id string, chunk_ids array<string>")
    assert {r.assignment_id: r.status for r in hydrate.unit_status(units, got).collect()} == {"u1": "ok", "u2": "store_unreachable", "u3": "missing_chunks", "u4": "store_doc_missing"}


def test_verdicts_and_calls(spark):
    rows = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 0)], "batch long, local_id long")
    said = spark.createDataFrame([(1, '[{"row_id":0,"decision":"keep"},{"row_id":0,"decision":"reject","reason":"r"},{"id":"1","verdict":"?"}]'), (2, None)], "batch long, reply string")
    got = {(r.batch, r.local_id): (r.decision, r.reason) for r in replies.parse_verdicts(said, rows).collect()}
    assert got == {(1, 0): ("REJECT", "r"), (1, 1): ("REJECT", "unparseable_decision"), (1, 2): ("REJECT", "missing_from_batch_response"), (2, 0): ("REJECT", "missing_from_batch_response")}

    def ask(prompt):
        if prompt == "bad":
            raise RuntimeError("no")
        return prompt.upper()

    asked = replies.call_model(spark.createDataFrame([(1, "a"), (2, "bad")], "id long, prompt string"), ask, attempts=2).collect()
    assert sorted((r.id, r.reply, r.attempts, r.error) for r in asked) == [(1, "A", 1, None), (2, None, 2, "RuntimeError: no")]


def test_reply_shapes(spark):
    rows = [('{"verdict":"ACCEPT","grounding":"supported","distinctness":"distinct","chunk_sufficiency":"sufficient","usefulness":"useful","difficulty":"hard","supporting_chunk_ids":["d#1"]}',), ("[]",), (None,), ('```json\n{"verdict":"accept","answer_support":"partial"}\n```',)]
    df = spark.createDataFrame([(i, r[0], ["d#1"]) for i, r in enumerate(rows)], "i int, reply string, chunk_ids array<string>")
    got = {r.i: r for r in replies.gate(replies.normalize_replies(df)).collect()}
    assert got[0].status == "accept" and got[0].gate_reasons == []
    assert got[1].reject_reason == got[2].reject_reason == "judge_verdict_reject" and "difficulty_too_low" in got[1].gate_reasons
    assert got[3].answer_support == "unsupported" and got[3].verdict == "accept"


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "Q a", "x"), (2, "q  A", "x"), (3, None, None), (4, " ", "y"), (5, "b", "y")], "row_id long, question string, hash string")
    assert {r.row_id: r.export_status for r in export.export_status(df, ["row_id"]).collect()} == {1: "accepted", 2: "duplicate_final_question", 3: "empty_question", 4: "empty_question", 5: "accepted"}
    assert sorted(r.row_id for r in export.keep_first(df, "hash", ["row_id"]).collect()) == [1, 4]
    fresh = export.append_new(df.limit(0), df.where("hash is not null"), ["hash"], ["row_id"])
    assert sorted(r.row_id for r in fresh.collect()) == [1, 4]
    assert export.append_new(df, df.where("hash is not null"), ["hash"], ["row_id"]).count() == 0
    out = spark.createDataFrame([('say "hi"\nx', "a", ["d"], ["d#1", 'e"#2'])], "question string, answer string, doc_ids array<string>, chunk_ids array<string>")
    export.write_csv(export.csv_rows(out, "made"), str(tmp_path / "csv"))
    back = T.read_training_csv(spark, str(tmp_path / "csv")).first()
    assert back.question == 'say "hi"\nx' and back.docIds == '["d"]' and back.chunk_ids == '["d#1", "e\\"#2"]' and back.source_row_number == ""
    with pytest.raises(ValueError, match="no final rows"):
        export.fail_closed(spark.createDataFrame([], "status string"))
    with pytest.raises(ValueError, match="1 final rows"):
        export.fail_closed(spark.createDataFrame([("accept",), (None,)], "status string"))


def test_json_scans(spark, tmp_path):
    lines = spark.createDataFrame([(x,) for x in ('{"train_key":"k1"}', '"k2"', "k3", "7", "[1]", " ", None, '{"a":1}')], "value string")
    assert sorted(r.train_key for r in T.focus_keys(lines).collect()) == ["k1", "k2", "k3"]
    parsed = T.parse_json_lines(lines).select("parse_error").collect()
    assert Counter(r.parse_error for r in parsed) == {None: 2, "not_an_object": 3, "malformed_jsonl": 1}
    from pyspark.sql import types as ty

    schema = ty.StructType([ty.StructField("a", ty.LongType())])
    assert T.read_jsonl(spark, str(tmp_path / "none"), schema).count() == 0
    assert T.column_conformance(["question", "x"])["extra"] == ["x"]


def test_chunk_metadata_by_index(spark):
    schema = "m array<struct<chunk_index:bigint,page:string>>"
    df = spark.createDataFrame([([(None, "a"), (5, "b"), (None, "c"), (5, "d")],), ([],)], schema)
    got = [r.x for r in df.select(hydrate.chunk_index_of(F.col("m")).alias("x")).collect()]
    assert {k: v.split('"')[-2] for k, v in got[0].items()} == {0: "a", 5: "d", 2: "c"} and got[1] == {}
    asked = spark.createDataFrame([("d#2",), ("d#10",), ("d#2",), ("e#1",)], "chunk_id string")
    assert {r.doc_id: r.chunk_indexes for r in hydrate.requested_docs(asked).collect()} == {"d": [2, 10], "e": [1]}
