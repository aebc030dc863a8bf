import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.llm import neardup, packing, quota_sample, splits

# --- problem 1 -----------------------------------------------------------------------------


def test_linked_groups_and_splits(spark):
    rng = random.Random(8)
    rows = [(f"j{i:04d}", f"c{rng.randrange(120)}", f"u{rng.randrange(400)}" if rng.random() < 0.9 else None, f"t{rng.randrange(300)}" if rng.random() < 0.3 else None, rng.choice("xy")) for i in range(500)]
    rows += [(f"h{i}", "hub", f"hu{i}", None, "x") for i in range(200)] + [("lone", None, None, None, None), ("j0001", "other", None, None, "x"), (None, "hub", None, None, "x")]
    df = spark.createDataFrame(rows, "id string, c string, u string, t string, component string")
    got = {r.id: r.component for r in splits.linked_groups(df, "id", ["c", "u", "t"]).collect()}
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, c, u, t, _ in rows:
        if i is not None:
            for k in (("c", c), ("u", u), ("t", t)):
                root(("id", i))
                if k[1] is not None:
                    parent[root(k)] = root(("id", i))
    want = defaultdict(set)
    for i in got:
        want[root(("id", i))].add(i)
    have = defaultdict(set)
    for i, g in got.items():
        have[g].add(i)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values())) and len(got) == len({r[0] for r in rows if r[0]})
    grouped = spark.createDataFrame(list(got.items()), "id string, component string")
    out = splits.split_groups(grouped, "id", splits={"train": 8, "validation": 1, "test": 1}).collect()
    assert len(out) == len(got)
    per = defaultdict(set)
    for r in out:
        per[r.component].add(r.split)
    assert all(len(v) == 1 for v in per.values())
    assert out and {r.id: r.split for r in out} == {r.id: r.split for r in splits.split_groups(grouped, "id", splits={"train": 8, "validation": 1, "test": 1}).collect()}
    assert splits.linked_groups(df.where("false"), "id", ["c", "u"]).count() == 0 and splits.split_groups(grouped.where("false"), "id").count() == 0


def test_names_of_columns_may_clash(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "y"), (4, None, None)], "first int, ks string, own string")
    got = {r["first"]: r.component for r in splits.linked_groups(df, "first", ["ks", "own"]).collect()}
    assert got[1] == got[2] == got[3] != got[4]
    grouped = spark.createDataFrame([(i, str(i // 3), "x") for i in range(30)], "n int, l string, size string")
    out = splits.split_groups(grouped, "n", group="l", label="size").collect()
    assert len(out) == 30 and set(out[0].asDict()) == {"n", "l", "split"}
    rows = spark.createDataFrame([(f"d{i}", "m") for i in range(20)], "seats string, t string")
    targets = spark.createDataFrame([(1, "m", 1.0, 5, 1)], "plan_id int, t string, share double, sample_size int, min_rows int")
    assert quota_sample.draw(rows, targets, "seats", ["t"]).count() == 5


def as_bundles(rows):
    """(size, counts by label, groups) -> bundles."""
    return [splits.Bundle(n, s * n, tuple(c * n for c in counts)) for s, counts, n in rows]


@given(st.dictionaries(st.tuples(st.integers(0, 20), st.integers(0, 20), st.integers(0, 20)).filter(any), st.integers(1, 20), min_size=1, max_size=15))
@settings(max_examples=60, deadline=None)
def test_allocation_is_whole_and_near(found):
    rows = [(sum(c), c, n) for c, n in found.items()]
    out = splits.allocate(as_bundles(rows), [0.8, 0.1, 0.1])
    assert all(sum(take) == n and min(take) >= 0 for take, (_, _, n) in zip(out, rows))
    total, largest = sum(s * n for s, _, n in rows), max(s for s, _, _ in rows)
    for j, p in enumerate((0.8, 0.1, 0.1)):
        assert abs(sum(s * t[j] for t, (s, _, _) in zip(out, rows)) - p * total) <= 2 * largest + 1


def test_quotas_are_met_around_a_large_group():
    rows = [(1041, (600, 441), 1), (151, (151, 0), 2), (9, (6, 3), 60), (1, (1, 0), 300), (1, (0, 1), 100), (2, (1, 1), 40)]
    out = splits.allocate(as_bundles(rows), [0.8, 0.1, 0.1])
    sums = [sum(s * t[j] for t, (s, _, _) in zip(out, rows)) for j in range(3)]
    assert sum(sums) == 2363 and abs(sums[0] - 1890) <= 2 and abs(sums[1] - 236) <= 2
    for label in range(2):
        of = [sum(c[label] * t[j] for t, (_, c, _) in zip(out, rows)) for j in range(3)]
        assert abs(of[0] - 0.8 * sum(of)) <= 20 and abs(of[1] - 0.1 * sum(of)) <= 20


def test_a_hundred_thousand_bundles_in_a_minute():
    import time

    rng = random.Random(1)
    found = {}
    while len(found) < 100_000:
        size = min(int(rng.paretovariate(0.6)), 3_000_000)
        cuts = sorted(rng.randint(0, size) for _ in range(4))
        found[tuple(b - a for a, b in zip([0, *cuts], [*cuts, size]))] = max(1, int(1e6 / size**2))
    rows = [(sum(c), c, n) for c, n in found.items()]
    start = time.perf_counter()
    out = splits.allocate(as_bundles(rows), [0.8, 0.1, 0.1])
    assert time.perf_counter() - start < 60
    total = sum(s * n for s, _, n in rows)
    for label in range(5):
        of = [sum(c[label] * int(t[j]) for t, (_, c, _) in zip(out, rows)) for j in range(3)]
        assert all(abs(x - p * sum(of)) < 1e-3 * total for x, p in zip(of, (0.8, 0.1, 0.1)))


def test_three_rows_of_one_record_are_one_component(spark):
    rows = [("r", "a"), ("r", "b"), ("r", "c"), ("x", "b"), ("y", "c"), ("z", "d")]
    got = {r.id: r.component for r in splits.linked_groups(spark.createDataFrame(rows, "id string, k string"), "id", ["k"]).collect()}
    assert len(got) == 4 and got["r"] == got["x"] == got["y"] != got["z"]


def test_min_cost_flow():
    # two ways, the cheap one too narrow
    flow = splits.min_cost_flow(4, [(0, 1, 5, 1), (0, 2, 5, 3), (1, 3, 2, 0), (2, 3, 9, 0), (1, 2, 9, 1)], 0, 3)
    assert sum(flow[:2]) == 10 and flow[0] == 5 and flow[2] == 2


# --- problem 4 -----------------------------------------------------------------------------


def brute_seats(available, shares, floors, size):
    rows = []
    for i, (a, s, f) in enumerate(zip(available, shares, floors)):
        for r in range(1, a + 1):
            if r <= f:
                rows.append((0, (r - 0.5) / s if s else math.inf, i))
            elif s > 0:
                rows.append((1, (r - 0.5) / s, i))
    rows.sort()
    out = [0] * len(available)
    for _, _, i in rows[:size]:
        out[i] += 1
    return out


@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from([0.1, 0.15, 0.2, 0.3, 0.45]), st.integers(0, 6)), min_size=1, max_size=6), st.integers(0, 120))
@settings(max_examples=200, deadline=None)
def test_seats_are_the_smallest_priorities(cats, size):
    a, s, f = (list(x) for x in zip(*cats))
    got, want = quota_sample.seats(a, s, f, size), brute_seats(a, s, f, size)
    assert sum(got) == sum(want)
    # ties between categories may fall either way; the priorities kept are the same
    val = lambda take: sorted(round((r - 0.5) / s[i], 9) for i, n in enumerate(take) for r in range(1, n + 1) if r > f[i] or sum(map(min, a, f)) > size)
    assert val(got) == val(want)


def test_draw_and_shortfalls(spark):
    rows = [(f"d{i}", "m", "hot") for i in range(900)] + [(f"e{i}", "m", "few") for i in range(5)] + [(f"d{i}", "m", "hot") for i in range(50)] + [("n", None, "hot"), ("x", "z", "hot"), (None, "m", "hot")]
    targets = [(1, "m", "hot", 0.5, 100, 3), (1, "m", "few", 0.4, 100, 3), (1, "m", "none", 0.1, 100, 2), (2, "m", "hot", 0.9, 10, 1), (2, "m", "few", 0.1, 10, 4)]
    r = spark.createDataFrame([(*x, 1) for x in rows], "id string, mode string, tone string, rank int")
    t = spark.createDataFrame([(p, m, x, s, n, k, 9) for p, m, x, s, n, k in targets], "plan_id int, mode string, tone string, share double, sample_size int, min_rows int, rank int")
    t = t.withColumn("share", t.share.cast("decimal(6,4)"))
    got = quota_sample.draw(r, t, "id", ["mode", "tone"]).collect()
    per = Counter((x.plan_id, x.tone) for x in got)
    assert per == {(1, "hot"): 95, (1, "few"): 5, (2, "hot"): 6, (2, "few"): 4}
    assert len({(x.plan_id, x.id) for x in got}) == len(got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, quota_sample.draw(r.repartition(7), t, "id", ["mode", "tone"]).collect()))
    short = {(x.plan_id, x.tone) for x in quota_sample.shortfalls(r, t, "id", ["mode", "tone"]).collect()}
    assert short == {(1, "few"), (1, "none")}
    both = r.union(spark.createDataFrame([("d0", "m", "few", 1)], r.schema))  # one id with two labels is drawn once
    again = quota_sample.draw(both, t, "id", ["mode", "tone"]).collect()
    assert len({(x.plan_id, x.id) for x in again}) == len(again) and ("few" in {x.tone for x in again if x.id == "d0"})
    report = {(x.plan_id, x.tone): (x.available, x.drawn) for x in quota_sample.Sample(r, t, "id", ["mode", "tone"]).report().collect()}
    assert report == {(1, "hot"): (900, 95), (1, "few"): (5, 5), (1, "none"): (0, 0), (2, "hot"): (900, 6), (2, "few"): (5, 4)}
    assert quota_sample.draw(r.where("false"), t, "id", ["mode", "tone"]).count() == 0
    assert quota_sample.shortfalls(r.where("false"), t, "id", ["mode", "tone"]).count() == 5


# --- problem 3 -----------------------------------------------------------------------------


def jaccard(a, b, k=5):
    x, y = neardup.shingle_set(a, k), neardup.shingle_set(b, k)
    return len(x & y) / len(x | y) if x | y else 0.0


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(n))
    rows = []
    for c in range(25):
        base = text(rng.randrange(60, 500))
        for v in range(4):
            t = list(base)
            for _ in range(rng.choice([0, 1, 3, 8, 20])):
                t[rng.randrange(len(t))] = rng.choice("xyz")
            rows.append((f"d{c:02d}{v}", "".join(t)))
    rows += [(f"copy{i:03d}", "the very same text of some length") for i in range(60)] + [("short1", "ab"), ("short2", "ab"), ("blank", " ,. ")]
    parts = []
    for i, t in rows:
        cut = len(t) // 2
        parts += [(i, 2, t[cut:]), (i, 1, t[:cut]), (i, 1, t[:cut]), (i, 3, None)]
    parts += [(None, 1, "the very same text of some length")]
    df = spark.createDataFrame(parts, "id string, place int, part string")
    nd = neardup.NearDuplicates(df, threshold=0.6)
    got = {tuple(r) for r in nd.all_pairs().collect()}
    from dialoom.llm.letters import letters

    clean = {i: letters(t) for i, t in rows}
    want = {(a, b) for a in clean for b in clean if a < b and jaccard(clean[a], clean[b]) >= 0.6}
    assert got == want and len(want) > 60 * 59 // 2
    groups = {r.id: (r.group_id, r.group_size) for r in nd.groups().collect()}
    assert set(groups) == {x for p in want for x in p}
    assert all(groups[a][0] == groups[b][0] for a, b in want)
    members = defaultdict(set)
    for i, (g, _) in groups.items():
        members[g].add(i)
    linked = lambda g: {x for p in want if p[0] in g or p[1] in g for x in p}
    for g, m in members.items():
        reached = {g}
        while (more := linked(reached) | reached) != reached:
            reached = more
        assert g == min(m) and reached == m and all(groups[i][1] == len(m) for i in m)
    assert neardup.NearDuplicates(df.where("false")).groups().count() == 0
    assert neardup.NearDuplicates(df.where("false")).all_pairs().count() == 0


def test_sketch_estimates_similarity():
    import numpy as np

    from dialoom.llm.letters import batch_letters

    rng = random.Random(1)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(400))
        t = list(a)
        for _ in range(rng.choice([2, 10, 18, 40, 200])):
            t[rng.randrange(400)] = "z"
        pairs += [a, "".join(t)]
    samples, has = neardup.minhash_samples(*batch_letters(pairs), 5)
    assert has.all()
    same = (samples[::2] == samples[1::2]).mean(1)
    true = np.array([jaccard(a, b) for a, b in zip(pairs[::2], pairs[1::2])])
    assert np.abs(same - true).mean() < 0.03
    sk = neardup.odd_sketches(samples)
    words = neardup.SKETCH_BITS // 64
    apart = np.bitwise_count((sk[::2, :words] ^ sk[1::2, :words]).view(np.uint64)).sum(1)
    assert (apart[true >= 0.6] <= neardup.largest_distance(0.6)).all()
    assert (apart[true < 0.1] > neardup.largest_distance(0.6)).mean() > 0.95


# --- problem 6 -----------------------------------------------------------------------------


@given(st.lists(st.integers(0, 50), max_size=80), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_island_gives_a_valid_packing(sizes, seed):
    pool, fit = packing.evolve(sizes, 50, str(seed), [], 4, 5)
    for best in pool:
        fill = defaultdict(int)
        for x, b in enumerate(best):
            fill[b] += sizes[x]
        assert len(best) == len(sizes) and all(v <= 50 for v in fill.values())
    assert 0 <= fit <= 1 and pool == packing.evolve(sizes, 50, str(seed), [], 4, 5)[0]
    # an epoch with guests is never worse than they are
    again, _ = packing.evolve(sizes, 50, "next", pool, 4, 5)
    assert max(again[0], default=-1) <= max(pool[0], default=-1)


def test_evolution_improves_on_best_fit():
    rng = random.Random(3)
    sizes = [rng.choice([260, 270, 340, 350, 410, 490, 510]) for _ in range(300)]
    order = sorted(range(300), key=lambda x: -sizes[x])
    plain: tuple = ([], [])
    packing.best_fit(order, sizes, 1000, *plain)
    pool, _ = packing.evolve(sizes, 1000, "s", [], 6, 120)
    assert max(pool[0]) + 1 <= len(plain[0])


def test_epochs_carry_the_population_and_improve():
    rng = random.Random(8)
    sizes = [rng.choice([rng.randrange(1, 512), rng.randrange(150, 300)]) for _ in range(800)]
    plain: tuple = ([], [])
    packing.best_fit(sorted(range(800), key=lambda x: -sizes[x]), sizes, 512, *plain)
    pool: list = []
    used = []
    for epoch in range(4):
        pool, _ = packing.evolve(sizes, 512, f"e{epoch}", pool, 4, 20)
        used.append(max(pool[0]) + 1)
    assert used == sorted(used, reverse=True) and used[-1] < len(plain[0])


def test_pack(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["red", "boat", "河边", "lantern"]) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "word " * 3000), (902, "word " * 3000), (None, "x")]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id bigint, text string, block int")
    packs = spark.createDataFrame([(1, 64), (2, 500)], "pack_id int, capacity_tokens int")
    out = packing.pack(docs, packs, block_rows=60).collect()
    enc = packing._encoding(packing.TOKENIZER, packing.PATTERN)
    size = {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in rows if i is not None}
    for p, cap in ((1, 64), (2, 500)):
        mine = [r for r in out if r.pack_id == p]
        whole = defaultdict(list)
        fill, places = defaultdict(int), defaultdict(list)
        for r in mine:
            whole[r.doc_id].append(r)
            fill[r.container] += r.n_tokens
            places[r.container].append(r.place)
        assert set(whole) == set(size) and all(v <= cap for v in fill.values())
        assert all(sorted(v) == list(range(1, len(v) + 1)) for v in places.values())
        for i, rs in whole.items():
            rs.sort(key=lambda r: r.piece)
            assert sum(r.n_tokens for r in rs) == size[i] and (len(rs) == 1 or size[i] > cap)
            assert [r.first_token for r in rs] == [sum(x.n_tokens for x in rs[:k]) for k in range(len(rs))]
        assert len(fill) <= math.ceil(sum(size.values()) / cap) + 4
    assert packing.pack(docs.where("false"), packs).count() == 0 and packing.pack(docs, packs.where("false")).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, spark.createDataFrame([(1, 0)], packs.schema))
