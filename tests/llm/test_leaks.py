import random

from quarryline.llm import leaks
from quarryline.llm.codepoints import sliding_min


def brute(texts, items, k=8):
    shingles = {}
    for i, t in items:
        shingles.setdefault(i, set()).update(leaks.exact_shingles(t, k))
    return {(key, i) for key, t in texts for i, s in shingles.items() if not s.isdisjoint(leaks.exact_shingles(t, k))}


def data(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Straße", "СЛОВО", "x9", "don't"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 25)))) for i in range(12)]
    texts = [(100 + n, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for n in range(60)]
    for n in range(40):
        piece = rng.choice(items)[1].split()
        at, size = rng.randrange(len(piece)), rng.randint(5, 12)
        cut = [w.upper() if rng.random() < 0.5 else w for w in piece[at : at + size]]
        texts.append((200 + n, "; ".join(["so", *cut, "and", "more"])))
    return texts + [(1, None), (2, ""), (3, "w1 " * 5)], items + [(50, None), (51, "")]


def test_both_ways_equal_brute_force(spark):
    texts, items = data(3)
    long = " ".join(f"q{i}" for i in range(50_000)) + " " + items[0][1] + " " + items[1][1]
    texts.append((999, long))
    corpus = spark.createDataFrame([("c", k, t, 0) for k, t in texts], "corpus string, row_key long, text string, sig int").repartition(3)
    held = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, row_key int")
    want = brute(texts, items)
    assert want
    for most in (2_000_000, 0):
        got = leaks.leaked_items(corpus, held, ["corpus", "row_key"], max_sent=most).collect()
        assert {(r.row_key, r.item_id) for r in got} == want and len(got) == len(want)


def test_longer_passages_for_larger_items(spark):
    import numpy as np

    least = leaks.least_passages(8, 5, 0.5)
    assert least[:6].tolist() == [4, 4, 4, 4, 8, 16]
    item = [f"w{i}" for i in range(44)]  # 40 shingles, of the class from 32 on: 16 of them, 20 words in a row
    rows = [(1, " ".join(["x", *item[3:23], "y"])), (2, " ".join(["x", *item[3:22], "y"])), (3, " ".join(item)), (4, "s1 s2 s3 s4 s5 s6 s7 s8")]
    corpus = spark.createDataFrame(rows, "row_key long, text string")
    held = spark.createDataFrame([(7, " ".join(item)), (8, "s1 s2 s3 s4 s5 s6 s7 s8 s9")], "item_id long, text string")
    for most in (10**6, 0):
        got = leaks.leaked_items(corpus, held, ["row_key"], containment=0.5, max_sent=most)
        assert sorted(tuple(r) for r in got.collect()) == [(1, 7), (3, 7), (4, 8)]
    x = np.random.default_rng(1).integers(0, 100, 50)
    assert all((leaks_min == [x[i : i + w].min() for i in range(51 - w)]).all() for w in (1, 2, 3, 7, 16, 50) for leaks_min in [sliding_min(x, w)])


def test_a_common_passage_in_every_text(spark):
    common = "this is a line that every text of the corpus holds somewhere"
    corpus = spark.createDataFrame([(i, f"text {i} says {common} and goes on") for i in range(300)], "row_key long, text string").repartition(3)
    held = spark.createDataFrame([(i, f"item {i}: {common}") for i in range(20)], "item_id long, text string")
    for most in (10**6, 0):
        assert leaks.leaked_items(corpus, held, ["row_key"], max_sent=most).count() == 6000


def test_empty_tables(spark):
    texts, items = data(4)
    corpus = spark.createDataFrame([(k, t) for k, t in texts], "row_key long, text string")
    held = spark.createDataFrame(items, "item_id long, text string")
    for most in (10**6, 0):
        assert leaks.leaked_items(corpus.limit(0), held, ["row_key"], max_sent=most).count() == 0
        assert leaks.leaked_items(corpus, held.limit(0), ["row_key"], max_sent=most).count() == 0


def test_runs_do_not_cross_fields(spark):
    rows = spark.createDataFrame([(1, "a b c d", "e f g h")], "record_number long, question string, answer string")
    docs = spark.createDataFrame([(1, "a b c d, E F G H")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c d e f g h", None)], "item_id long, question string, answer string")
    got = leaks.leaked_items(leaks.corpus_texts(rows, docs), leaks.item_texts(items), ["corpus", "row_key"]).collect()
    assert [tuple(r) for r in got] == [("documents", 1, 7)]
