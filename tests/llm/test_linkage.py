import random

import numpy as np
import pytest

from quarryline.llm import linkage

FIRMS = ["Alderby Holdings", "Brunswick Trustees", "Carvene Clearing", "Dunmore Capital", "Eastvale Brokers", "Farrow Advisers"]
PAPERS = ["fee schedule", "risk letter", "audit report", "pledge form", "client statement"]
TEMPLATES = [
    "What filing window does AB/{y}/{n} give {f} for the {p} once the quarter closes?",
    "Within how many days must {f} file the {p} with the Board under AB/{y}/{n}?",
    "How large a penalty did the Board set for {f} when the {p} missed its date of {d} May {y}?",
    "Who has to sign the {p} that {f} files in form R-{d} following AB/{y}/{n}?",
]


def questions(n, seed):
    rng = random.Random(seed)
    return [rng.choice(TEMPLATES).format(y=rng.randint(2018, 2031), n=rng.randint(10000, 99999), f=rng.choice(FIRMS), p=rng.choice(PAPERS), d=rng.randint(1, 28)) for _ in range(n)]


@pytest.fixture(scope="module")
def bank_rows():
    return [(i, q, [f"d#{i}", "hot#1"]) for i, q in enumerate(questions(300, 1), 1)]


BANK, ROWS = "eval_id long, question string, chunk_ids array<string>, key int", "row_id long, batch_no int, question string, chunk_ids array<string>, member int"


def test_repeats_in_order_of_batches(spark, bank_rows):
    q1, q2, q3 = bank_rows[0][1], bank_rows[1][1], "Why did the Northgate desk return the audit report that Alderby Holdings sent on 3 June 2021?"
    batches = [
        (1001, 1, q1.upper() + "  ", [" d # 01"]),  # other letters and blanks
        (1002, 1, q2.replace("the", "teh", 1) + " Give the figure.", ["d#2"]),  # a slip and words added
        (1003, 1, q3, ["z#1"]),
        (1004, 1, q1, ["other#9"]),  # no chunk in common
        (2001, 2, "So, " + q3[0].lower() + q3[1:].replace("return", "send back"), ["z#1"]),  # repeats the first batch
        (2002, 2, q3.replace("Alderby", "Dunmore"), ["z#1"]),  # another name
        (2003, 2, q3.replace("3 June", "4 June"), ["z#1"]),  # another number
        (2004, 2, q3.replace("June", "July"), ["z#1"]),  # another month
        (3001, 3, q3, ["z#1", None, " "]),
        (3002, 3, None, ["z#1"]),
        (3003, 3, "", ["z#1"]),
        (3004, 3, q3, None),
    ]
    bank = spark.createDataFrame([(*r, 0) for r in bank_rows], BANK)
    rows = spark.createDataFrame([(*r, 0) for r in batches], ROWS).repartition(3)
    pairs, clusters = linkage.link_batches(bank, rows)
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 1001), (2, 1002), (1003, 2001), (1003, 3001)]
    named = {r.id: r.cluster for r in clusters.collect()}
    assert named == {1: 1, 1001: 1, 2: 2, 1002: 2, 1003: 1003, 2001: 1003, 3001: 1003}


def test_hot_question_and_empty_tables(spark, bank_rows):
    bank = spark.createDataFrame([(*r, 0) for r in bank_rows], BANK)
    q = bank_rows[5][1]
    rows = spark.createDataFrame([(1000 + i, 1 + i % 2, q, ["d#6"], 0) for i in range(120)], ROWS)
    pairs, _ = linkage.link_batches(bank, rows)
    assert sorted(tuple(r) for r in pairs.collect()) == [(6, 1000 + i) for i in range(120)]
    assert linkage.link_batches(bank, rows.limit(0))[0].count() == 0
    assert linkage.link_batches(bank.limit(0), rows.where("row_id < 1002"))[0].collect()[0].dup_id == 1001


def test_every_copy_is_in_a_cluster(spark, bank_rows):
    q, other, alone = bank_rows[5][1], bank_rows[6][1], bank_rows[7][1]
    bank = spark.createDataFrame([(*r, 0) for r in [*bank_rows, (501, q.upper(), ["d#6", "hot#1"]), (502, alone, ["d#8", "hot#1"])]], BANK)
    batches = [(1000 + i, 1 + i % 2, q, ["d#6"], 0) for i in range(120)]  # a repeated question, in both batches
    batches += [(1200, 1, other, ["y#1"], 0), (1201, 1, other + "?", [" y # 01"], 0)]  # copies that repeat nothing
    batches += [(1202, 2, other, ["y#2"], 0), (1203, 1, other, ["y#2"], 0)]  # a repeat in the second batch
    rows = spark.createDataFrame(batches, ROWS).repartition(3)
    named = sorted(tuple(r) for r in linkage.link_batches(bank, rows)[1].collect())
    hot = [(6, 6), (501, 6), *((1000 + i, 6) for i in range(120))]
    assert named == sorted([*hot, (8, 8), (502, 8), (1200, 1200), (1201, 1200), (1202, 1203), (1203, 1203)])
    assert sorted(tuple(r) for r in linkage.link_batches(bank, rows.limit(0))[1].collect()) == [(6, 6), (8, 8), (501, 6), (502, 8)]


def test_every_copy_of_a_kept_row_is_kept(spark, bank_rows):
    q, other = bank_rows[5][1], bank_rows[6][1]
    bank = spark.createDataFrame([(*r, 0) for r in [*bank_rows, (501, q.upper() + " ", ["d#6", "hot#1"])]], BANK)
    batches = [(1001, 1, q, ["d#6"]), (1002, 1, other, ["y#1"]), (1003, 1, other + "?", [" y # 01"]), (2001, 2, q, ["d#6"]), (2002, 2, other, ["y#1"]), (2003, 2, other.lower(), ["y#1"])]
    pairs, _ = linkage.link_batches(bank, spark.createDataFrame([(*r, 0) for r in batches], ROWS).repartition(3))
    of_bank = [(kept, dup) for kept in (6, 501) for dup in (1001, 2001)]
    assert sorted(tuple(r) for r in pairs.collect()) == sorted(of_bank + [(kept, dup) for kept in (1002, 1003) for dup in (2002, 2003)])


def test_rows_without_a_batch_are_the_last_one(spark, bank_rows):
    q, other = bank_rows[5][1], bank_rows[6][1]
    batches = [(1001, None, q, ["d#6"]), (1002, None, other, ["y#1"]), (1003, None, other, ["y#1"]), (1004, 1, other, ["y#1"])]
    rows = spark.createDataFrame([(*r, 0) for r in batches], ROWS)
    pairs, _ = linkage.link_batches(spark.createDataFrame([(*r, 0) for r in bank_rows], BANK), rows)
    assert sorted(tuple(r) for r in pairs.collect()) == [(6, 1001), (1004, 1002), (1004, 1003)]


def test_lexicon_covers_every_word(spark):
    import zlib

    lexicon = linkage.capital_lexicon(spark.createDataFrame([("so " + "word " * 1500 + "Zelda ends",), ("",)], "q string"))
    assert lexicon[zlib.crc32(b"zelda") % linkage.BUCKETS] == 1.0


def test_weights_hold_on_pairs_kept_out(bank_rows):
    texts = [r[1] for r in bank_rows]
    lexicon = np.full(linkage.BUCKETS, np.nan)
    import zlib

    for t in texts:
        for w in t.replace("?", "").replace(",", "").split(" ")[1:]:
            lexicon[zlib.crc32(w.lower().encode()) % linkage.BUCKETS] = float(w[0].isupper())
    model = linkage.fit(texts, lexicon)
    assert model.accuracy > 0.97
    assert model.score("how does x change y on 3 May 2020", "how does x change y on 3 May 2020") >= model.threshold


def test_close():
    assert linkage._close("annexure", "anenxure", 1) and linkage._close("letter", "lettr", 1)
    assert not linkage._close("may", "day", 1) and not linkage._close("window", "widnwo", 1) and linkage._close("window", "widnwo", 2)


def test_numbers_written_otherwise(spark, bank_rows):
    asked = "How large was the fee of {} crowns that Alderby Holdings paid on {} March 2021 under AB/2021/{}?"
    same = [("1,000", "2", "77"), ("1000", "02", "077"), ("1'000", "2nd", "77")]
    other = [("1,001", "2", "77"), ("1,000", "3rd", "77"), ("10,000", "2", "77"), ("1,000", "2", "78")]
    bank = spark.createDataFrame([(*r, 0) for r in [*bank_rows, (900, asked.format(*same[0]), ["n#1"])]], BANK)
    rows = [(1000 + i, 1, asked.format(*x), ["n#1"], 0) for i, x in enumerate([*same, *other])]
    pairs = sorted(tuple(r) for r in linkage.link_batches(bank, spark.createDataFrame(rows, ROWS))[0].collect())
    assert pairs == [(900, 1000), (900, 1001), (900, 1002)]


def batch_frames(spark, bank_rows, n):
    rng = random.Random(4)
    new = questions(40, 9)
    every = [q for _, q, _ in bank_rows[:40]] + new
    return [[(1000 * b + i, rng.choice(every).replace("the", "teh", 1), [f"d#{rng.randint(1, 40)}", "hot#1"]) for i in range(30)] for b in range(1, n + 1)]


def test_a_second_session_goes_on(spark, bank_rows, tmp_path):
    frames = batch_frames(spark, bank_rows, 4)
    bank = spark.createDataFrame([(*r, 0) for r in bank_rows], BANK)
    whole = spark.createDataFrame([(i, b, q, refs, 0) for b, rows in enumerate(frames, 1) for i, q, refs in rows], ROWS)
    pairs, clusters = linkage.link_batches(bank, whole)
    path = f"file://{tmp_path}/store"
    linkage.link_batches(bank, whole.where("batch_no <= 3"), path=path)
    store = linkage.LinkStore(spark, path)
    last = whole.where("batch_no = 4")
    store.add(last, 4)
    again = linkage.LinkStore(spark, path)
    assert sorted(map(tuple, again.pairs().collect())) == sorted(map(tuple, pairs.collect())) and pairs.count() > 20
    assert sorted(map(tuple, again.clusters().collect())) == sorted(map(tuple, clusters.collect()))
    with pytest.raises(ValueError, match="part 4"):
        again.add(last, 4)
    with pytest.raises(ValueError, match="store"):
        linkage.LinkStore.create(spark, path, bank)


def test_only_touched_buckets_are_read(spark, bank_rows, tmp_path):
    bank = spark.createDataFrame([(*r, 0) for r in bank_rows], BANK)
    store = linkage.LinkStore.create(spark, f"file://{tmp_path}/store", bank, buckets=64)
    rows = spark.createDataFrame([(5001, 1, "Who pays?", ["d#1"], 0)], ROWS)
    keys = linkage._keys(linkage._prepared(rows, "row_id")).withColumn("bucket", store._bucket("key"))
    touched = [r.bucket for r in keys.collect()]
    read = store.read("keys", touched)
    assert len(touched) == 1 and len(read.inputFiles()) > 30
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scan or f"(bucket#" in scan and "PartitionFilters" in scan
    assert read.count() < store.read("keys").count() / 8


def test_hot_blocks_are_split_without_loss(spark, bank_rows, monkeypatch):
    frames = batch_frames(spark, bank_rows, 2)
    bank = spark.createDataFrame([(*r, 0) for r in bank_rows], BANK)
    rows = spark.createDataFrame([(i, b, q, refs, 0) for b, part in enumerate(frames, 1) for i, q, refs in part], ROWS)
    want = sorted(map(tuple, linkage.link_batches(bank, rows)[0].collect()))
    monkeypatch.setattr(linkage, "MAX_BLOCK_PAIRS", 0)
    assert sorted(map(tuple, linkage.link_batches(bank, rows)[0].collect())) == want and want


def test_without_anything_to_learn_from_equal_words_repeat(spark):
    bank = spark.createDataFrame([], BANK)
    rows = spark.createDataFrame([(1, 1, "Who signs the form?", ["a#1"], 0), (2, 2, "who signs  the form", ["a#1"], 0), (3, 2, "Who signs a form?", ["a#1"], 0)], ROWS)
    assert [tuple(r) for r in linkage.link_batches(bank, rows)[0].collect()] == [(1, 2)]


def test_only_united_clusters_are_written(spark, tmp_path):
    store = linkage.LinkStore(spark, f"file://{tmp_path}/s")
    link = lambda *rows: spark.createDataFrame(rows, "a long, b long")
    named = lambda: {r.id: r.cluster for r in store.clusters().collect()}

    def unite(part, links):
        store._unite(part, store.parts(), links, list(range(store.buckets)))
        store._commit(part)

    unite(1, link((1, 11), (2, 12), (3, 13)))
    assert named() == {1: 1, 11: 1, 2: 2, 12: 2, 3: 3, 13: 3}
    unite(2, link((2, 21), (3, 21), (4, 22), (1, 23)))
    assert named() == {1: 1, 11: 1, 23: 1, 2: 2, 12: 2, 3: 2, 13: 2, 21: 2, 4: 4, 22: 4}
    assert [tuple(r) for r in store.read("unions", parts=[2]).select("root", "now").collect()] == [(3, 2)]
    unite(3, link((1, 31), (13, 31)))  # a member of a united cluster, with another one
    assert named() == {x: 1 for x in (1, 11, 23, 2, 12, 3, 13, 21, 31)} | {4: 4, 22: 4}
    assert sorted(tuple(r) for r in store.read("unions", parts=[3]).select("root", "now").collect()) == [(2, 1), (3, 1)]
    before = named()
    unite(4, link().limit(0))
    assert named() == before
