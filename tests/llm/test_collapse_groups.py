import itertools
import random

from quarryline.llm import collapse, groups

SCHEMA = "record_number long, question string, answer string, chunk_ids array<string>, raw string, form int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_formatting_field_order_and_references(spark):
    rows = [
        (5, "Who signs?", "Fee: 1,200 crowns; Form: N-7", ["d#1", "d#02 "]),
        (2, "WHO  signs", "form: n-7 | fee: 1,200 crowns.", ["d # 2", "d#1", "d#1", None, ""]),
        (9, "Who signs?", '{"Form": "N-7", "Fee": "1,200 crowns"}', ["d#1", "d#2"]),
        (7, "Who signs?", "Fee: 1,200 crowns; Form: N-8", ["d#1", "d#2"]),
        (8, "Who signs?", "Fee: 1,200 crowns; Form: N-7", ["d#1"]),
        (1, "Straße", None, ["d#3"]),
        (3, "STRASSE", "", ["d#3"]),
        (4, "same", "order a b", ["d#4"]),
        (6, "same", "order b a", ["d#4"]),
        (10, "no refs", "a", []),
        (11, "no refs", "a", None),
        (12, "no refs", "a", [" "]),
    ]
    assert pairs(collapse.hidden_copies(frame(spark, rows))) == [(1, 3), (2, 5), (2, 9)]
    records, _ = collapse.collapse_records(frame(spark, rows))
    assert {r.first_record: r.copies for r in records.collect()} == {2: 3, 7: 1, 8: 1, 1: 2, 4: 1, 6: 1, 10: 3}


def test_labels_of_any_kind(spark):
    wide = "amount of the fee payable to the registry office on the day of filing"
    rows = [
        (1, "q", f"{wide}: 7 crowns; Date/time: noon", ["d#1"]),
        (2, "q", f"Date/time: noon\n{wide.upper()}: 7 crowns.", ["d#1"]),
        (3, "q", f'{{"Date/time": "noon", "{wide}": "7 crowns"}}', ["d#1"]),
        (4, "p", 'Fee (crowns), net: 17,250; Rule: clause 3, "b": x', ["d#1"]),
        (5, "p", '{"Rule": "clause 3, \\"b\\": x", "Fee (crowns), net": "17,250"}', ["d#1"]),
        (6, "r", "Café: 1.50, Größe: 2", ["d#1"]),
        (7, "r", '{"Gr\\u00f6\\u00dfe": 2, "Caf\\u00e9": 1.50}', ["d#1"]),
        (8, "s", "He said: no. A sum is due: 7", ["d#1"]),
        (9, "s", "A sum is due: 7. He said: no", ["d#1"]),
    ]
    assert pairs(collapse.hidden_copies(frame(spark, rows))) == [(1, 2), (1, 3), (4, 5), (6, 7)]


def test_hot_record_and_empty(spark):
    rows = [(i, "hot  question" if i % 2 else "Hot question", "a", ["d#1"]) for i in range(1, 301)] + [(1000, None, None, ["d#1"])]
    assert pairs(collapse.hidden_copies(frame(spark, rows).repartition(5))) == [(1, i) for i in range(2, 301)]
    assert collapse.hidden_copies(frame(spark, rows).limit(0)).count() == 0


def test_long_answer(spark):
    long = "word " * 100_000
    assert pairs(collapse.hidden_copies(frame(spark, [(1, "q", long, ["d#1"]), (2, "q", long.upper(), ["d#1"])]))) == [(1, 2)]


def union_find(rows):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for key, refs in rows:
        for ref in refs or []:
            if ref and "#" in ref and ref.split("#")[0].strip():
                doc, i = ref.rsplit("#", 1)
                parent[root(("c", doc.strip(), int(i)))] = root(("r", key))
    held = {}
    for key, refs in rows:
        if ("r", key) in parent:
            held.setdefault(root(("r", key)), []).append(key)
    return sorted((min(v), k) for v in held.values() for k in v if k != min(v))


def test_groups_equal_union_find(spark):
    for seed in range(4):
        rng = random.Random(seed)
        rows = [(k, [f" d{rng.randrange(40)}# {rng.randrange(3):02d}" for _ in range(rng.randint(0, 3))] + rng.choice([[], [None], ["", "zz"]])) for k in rng.sample(range(1000), 120)]
        rows.append((5000, None))
        df = spark.createDataFrame([(k, r, 1) for k, r in rows], "record_number long, chunk_ids array<string>, key int").repartition(4)
        assert pairs(groups.row_groups(df)) == union_find(rows)
    assert groups.row_groups(df.limit(0)).count() == 0


def test_long_chain_and_hot_chunk(spark):
    chain = [(k, [f"d#{k}", f"d#{k + 1}"]) for k in range(200)]
    hot = [(1000 + k, ["h#0", f"h#{k + 1}"]) for k in range(200)]
    df = spark.createDataFrame(list(itertools.chain(chain, hot)), "record_number long, chunk_ids array<string>")
    assert pairs(groups.row_groups(df)) == union_find(chain + hot)
