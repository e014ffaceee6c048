import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import mixing, packing
from quarryline.runtime import Cuts


def counts(spark, lengths):
    return spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, tokens long")


def check(rows, lengths, capacity):
    by_doc, by_container = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.piece_no, r.tokens))
        by_container[r.container_id] = by_container.get(r.container_id, 0) + r.tokens
    assert max(by_container.values()) <= capacity
    for i, n in enumerate(lengths):
        pieces = [t for _, t in sorted(by_doc[i])]
        assert sum(pieces) == n
        assert len(pieces) == max(1, -(-n // capacity)) and all(t == capacity for t in pieces[:-1])
    used = {c for c, t in by_container.items() if t}
    assert used == set(range(len(used)))
    return len(used)


def test_every_text_once_and_little_room_left(spark):
    rng = random.Random(5)
    lengths = [int(rng.lognormvariate(5, 0.8)) for _ in range(3000)] + [0, 0, 512, 1024, 5000, 513]
    df = counts(spark, lengths).repartition(3)
    n = check(packing.pack(df, 512, "k", Cuts(spark, "t")).collect(), lengths, 512)
    assert sum(lengths) / (512 * n) > 0.97


def test_hot_length_and_empty(spark):
    lengths = [170] * 500 + [171] * 250 + [1] * 250
    assert check(packing.pack(counts(spark, lengths), 512, "k", Cuts(spark, "t")).collect(), lengths, 512) <= 252
    assert packing.pack(counts(spark, []), 512, "k", Cuts(spark, "t")).count() == 0
    zero = packing.pack(counts(spark, [0, 0]), 512, "k", Cuts(spark, "t")).collect()
    assert [(r.container_id, r.tokens) for r in zero] == [(0, 0), (0, 0)]


def test_texts(spark):
    docs = spark.createDataFrame([(1, "one two three", 5), (2, None, 5), (3, "", 5), (4, "<|endoftext|> " * 50, 5)], "doc_id long, text string, tokens int")
    caps = spark.createDataFrame([("a", 16), ("b", 64), ("c", None), ("d", 0)], "container_kind string, capacity_tokens int")
    packed = packing.pack_all(docs, caps)
    assert {r.container_kind for r in packed.collect()} == {"a", "b"}
    room = {r.container_kind: r for r in packing.room_used(packed, caps).collect()}
    assert room["a"].tokens == room["b"].tokens > 100 and room["a"].containers >= room["a"].least_containers
    assert packing.pack_all(docs, caps.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 4)), min_size=1, max_size=7, unique_by=lambda x: x[0]), st.integers(5, 40))
def test_pattern_is_the_dearest(items, capacity):
    size, stock = (np.array(x) for x in zip(*items, strict=True))
    price = size * 1.5 + (size % 3)
    best = {0: 0.0}
    for s, k, p in zip(size, stock, price, strict=True):
        for _ in range(k):
            best = {**best, **{r + s: max(v + p, best.get(r + s, 0)) for r, v in sorted(best.items()) if r + s <= capacity}}
    pattern = packing.best_pattern(size, price, stock, capacity)
    assert (pattern <= stock).all() and (pattern * size).sum() <= capacity
    assert (pattern * price).sum() == pytest.approx(max(best.values()))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 300)), min_size=1, max_size=12, unique_by=lambda x: x[0]), st.integers(60, 200))
def test_a_plan_holds_all_and_the_bound_is_one(items, capacity):
    size, count = (np.array(x) for x in zip(*sorted(items), strict=True))
    plan = packing.plan_patterns(size, count, capacity)
    assert (sum(p * c for p, c in plan.patterns) == count).all() and all((p * size).sum() <= capacity for p, _ in plan.patterns)
    assert -(-int((size * count).sum()) // capacity) <= plan.bound <= plan.containers <= 1.25 * plan.bound + 2


def test_the_bound_is_above_the_volume_where_items_do_not_pair():
    plan = packing.plan_patterns(np.array([60]), np.array([100]), 100)
    assert plan.bound == plan.containers == 100


@given(st.integers(1, 500), st.integers(0, 10**6))
@settings(max_examples=40, deadline=None)
def test_permutation(n, key):
    assert sorted(mixing.permuted(np.arange(n), n, key)) == list(range(n))


def test_shard_counts_meet_quotas():
    quota = np.array([1000, 37, 0, 4096])
    drawn = mixing.shard_counts(quota, 256, 3)
    assert (drawn.sum(0) == quota).all() and (drawn >= 0).all() and (drawn.sum(1)[:-1] == 256).all()
    assert (mixing.quotas(np.array([0.5, 0.5]), np.array([1, 4]), np.array([10, 10])) == [10, 10]).all()
    assert mixing.quotas(np.array([0.5, 0.5]), np.array([1, 4]), np.array([0, 10])).tolist() == [0, 40]


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(rng.randint(1, 300))), rng.choices(["big", "small", "other"], [8, 2, 2])[0], 1) for i in range(400)]
    docs += [(900, None, "big", 1), (901, "", "small", 1), (902, "text", None, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, block int").repartition(3)
    targets = spark.createDataFrame([("big", 0.6, 2), ("small", 0.4, 3), ("absent", 0.0, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mixture(df, targets, block_tokens=32, shard_slots=64, group_shards=3)
    shares = {r.source: r for r in mixing.shares_reached(mixed, targets).collect()}
    assert shares["big"].share == pytest.approx(0.6, abs=0.01) and shares["small"].share == pytest.approx(0.4, abs=0.01)
    assert shares["absent"].tokens == 0
    assert shares["big"].most_repeats <= 2 and shares["small"].most_repeats <= 3
    rows = mixed.collect()
    slots = {}
    for r in rows:
        slots.setdefault((r.shard, r.position), set()).add((r.source, r.block, r.repeat_no))
    assert all(len(v) == 1 for v in slots.values())
    filled = {}
    for shard, position in slots:
        filled.setdefault(shard, []).append(position)
    assert len(filled) > 6 and all(sorted(v) == list(range(64)) for k, v in filled.items() if k != max(filled))  # shards have one size, however many
    seen = [x for v in slots.values() for x in v]
    assert len(seen) == len(set(seen))  # a block comes once in each pass
    assert all(sum(t.tokens for t in rows if (t.shard, t.position) == k) <= 32 for k in list(slots)[:50])
    again = mixing.mixture(df.repartition(5), targets, block_tokens=32, shard_slots=64, group_shards=3).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert mixing.mixture(df.limit(0), targets).count() == 0 and mixing.mixture(df, targets.limit(0)).count() == 0
