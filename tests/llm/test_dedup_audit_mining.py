"""Near-duplicate detection, the filter audit and hard-negative mining against plain versions."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywise.llm import filter_audit, hard_negatives, near_dedup, words

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOREM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
BIG = 2**53 + 1


def made(seed, n, vocabulary=LOREM):
    return " ".join(np.random.default_rng(seed).choice(vocabulary, n))


def varied(seed, n):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 100_000, n))


def frame(spark, rows):
    """Texts with columns whose names clash with those the operators use inside."""
    schema = "doc_id long, text string, n int, comp string, rid string, band string, mask string, digest string, h string, source string"
    return spark.createDataFrame([(i, t, 1, "a", "b", "c", "d", "e", "f", s) for i, t, s in rows], schema)


# Near duplicates


def shingles(text, k=4):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def plain_dedup(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    changed = True
    linked = [
        (i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in linked:
            if comp[i] != comp[j]:
                comp[i] = comp[j] = min(comp[i], comp[j])
                changed = True
    out = []
    for x, (i, _) in enumerate(rows):
        ids = [rows[y][0] for y in range(len(rows)) if comp[y] == comp[x] and rows[y][0] is not None]
        c = min(ids, default=None) if sets[x] else i
        out.append((i, len(sets[x]), c, i == c))
    return sorted(out, key=repr)


def changed(text, seed, share):
    w = text.split()
    at = np.random.default_rng(seed).choice(len(w), max(1, int(share * len(w))), replace=False)
    for i in at:
        w[i] = f"new{seed}x{i}"
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    rows, i = [], 100
    for seed in range(12):
        base = varied(seed, 20 + 37 * seed)
        rows.append((i, base))
        for c in range(6):
            i += 1
            rows.append((i, changed(base, 50 * seed + c, 0.01 + 0.006 * c)))
        i += 1
    chain = varied(99, 200).split()
    rows += [(1000 - j, " ".join(chain[12 * j : 12 * j + 150])) for j in range(5)]
    rows += [(3, None), (4, ""), (5, " \t\n"), (6, "one two"), (7, "ONE two"), (8, "one  two three"), (8, "one  two three")]
    rows += [(None, rows[1][1]), (None, rows[1][1]), (None, "a text without id"), (None, "a text without id")]
    rows += [(9, rows[20][1]), (9, rows[40][1]), (BIG, varied(7, 90)), (BIG + 1, varied(7, 90)), (-(2**63), "x" * 4000 + " " + made(3, 6000))]
    rows += [(11, "a " * 3000), (12, "a a a a a"), (13, rows[0][1].upper()), (14, "Ünïcode   word s end and more")]
    return rows


def test_near_duplicates_are_those_of_all_pairs(spark, copies):
    got = near_dedup.near_duplicates(frame(spark, [(i, t, "s") for i, t in copies]))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_dedup(copies)


def test_a_row_without_id_joins_two_components(spark):
    w = varied(5, 228).split()
    rows = [(5, " ".join(w[:200])), (None, " ".join(w[14:214])), (7, " ".join(w[28:228]))]
    assert {r[2] for r in plain_dedup(rows[::2])} == {5, 7} and {r[2] for r in plain_dedup(rows)} == {5}
    got = near_dedup.near_duplicates(frame(spark, [(i, t, None) for i, t in rows]))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_dedup(rows)


def test_many_copies_of_one_text(spark):
    base = varied(1, 60)
    rows = [(i, base) for i in range(300)] + [(1000 + i, changed(base, i, 0.01)) for i in range(150)] + [(5000, varied(2, 60))]
    got = near_dedup.near_duplicates(frame(spark, [(i, t, "s") for i, t in rows])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_dedup(rows)


def test_no_rows_and_no_words(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []
    got = near_dedup.near_duplicates(frame(spark, [(1, None, "s"), (None, "", "s")])).collect()
    assert {tuple(r) for r in got} == {(1, 0, 1, True), (None, 0, None, True)}


def test_sketches_estimate_the_samples_that_differ():
    a = np.unique(words.mixed(np.arange(2000, dtype=np.uint64)))
    k = near_dedup.BANDS * near_dedup.ROWS
    for share in (1.0, 0.95, 0.9, 0.8, 0.6):
        cut = int(2000 * 2 * share / (1 + share))
        b = np.unique(np.concatenate((a[:cut], words.mixed(np.arange(10_000, 12_000 - cut + 0, dtype=np.uint64)))))
        found = near_dedup.samples(np.concatenate((a, b)), np.array([0, len(a)]))
        x, y = near_dedup.odd_sketches(found)
        z = sum(bin(int(p ^ q) & (2**64 - 1)).count("1") for p, q in zip(x, y))
        differing = int((found[:, 0] != found[:, 1]).sum())
        assert z <= 2 * differing and z % 2 == 0
        estimate = -near_dedup.BITS / 2 * np.log(1 - 2 * z / near_dedup.BITS) / 2
        assert abs(estimate - differing) <= 8
        jaccard = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((1 - differing / k) - jaccard) < 0.15


def test_whole_sketches_count_differing_shingles():
    sets = [np.unique(words.mixed(np.arange(i * 20, i * 20 + 150, dtype=np.uint64))) for i in range(5)] + [np.zeros(0, np.uint64)]
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    maps = near_dedup.whole_sketches(np.concatenate(sets), at)
    for i, j in itertools.product(range(6), repeat=2):
        z = sum(bin(int(p ^ q) & (2**64 - 1)).count("1") for p, q in zip(maps[i], maps[j]))
        differing = len(np.setxor1d(sets[i], sets[j]))
        assert differing * 0.75 <= z <= differing


def test_sketches_of_large_sets_stay_within_their_bound(spark):
    rng = np.random.default_rng(8)
    for n in (300, 1500, 4000, 20_000):
        both = rng.integers(1 << 63, size=int(n * 8 / 9), dtype=np.uint64)
        own = [rng.integers(1 << 63, size=n - len(both), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate((both, x))) for x in own)
        assert 0.79 < len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.81
        found = near_dedup.samples(np.concatenate((a, b)), np.array([0, len(a)]))
        whole = near_dedup.whole_sketches(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
        sketches = np.concatenate((near_dedup.odd_sketches(found), whole), axis=1)
        row = [(len(a), len(b), sketches[0].tolist(), sketches[1].tolist())]
        df = spark.createDataFrame(row, "na long, nb long, ha array<long>, hb array<long>")
        assert df.where(near_dedup._possible(79, near_dedup.most_differing(79))).count() == 1


def test_the_bound_on_sketches_holds_for_drawn_pairs():
    most = near_dedup.most_differing(80)
    rng = np.random.default_rng(4)
    k = near_dedup.BANDS * near_dedup.ROWS
    assert most < 2 * k
    seen = []
    for _ in range(3000):
        flips = rng.integers(0, near_dedup.BITS, 2 * rng.binomial(k, 0.2))
        seen.append(int((np.bincount(flips, minlength=near_dedup.BITS) & 1).sum()))
    assert max(seen) <= most and np.mean(seen) < 0.6 * most


def test_pairs_at_the_threshold_share_a_band():
    lost = 0
    for seed in range(200):
        base = np.unique(words.mixed(np.arange(seed * 1000, seed * 1000 + 90, dtype=np.uint64)))
        both, own = base[:80], base[80:]
        a, b = np.sort(np.concatenate((both, own[:10]))), np.sort(np.concatenate((both, own[10:])))
        keys = near_dedup.band_keys(near_dedup.samples(np.concatenate((a, b)), np.array([0, len(a)])))
        lost += not (keys[0] == keys[1]).any()
    assert lost == 0


# Filter audit


def fails(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        out.append((s or "", i, "".join(f for f, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and first.get(t, i) < i,
        )) if bad)))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    found = fails(rows)
    out = []
    for part in {p for p, _, _ in found}:
        mine = [(i, f) for p, i, f in found if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in itertools.permutations("ABCDE"):
            gone = []
            left = mine
            for step, f in enumerate(order, 1):
                out_now = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in gone)
                left = [x for x in left if f not in x[1]]
                gone += out_now
                shapley[f] += len(out_now)
                lines.append([
                    part, "".join(order), step, len(left), len(out_now), redundant, sum(x[1] == f for x in mine),
                    sum(x[0] in good for x in out_now), sum(x[0] in toxic for x in out_now), f,
                ])
        out += [tuple(x[:9]) + (shapley[x[9]],) for x in lines]
    return sorted(out)


def test_audit_equals_filtering_in_every_order(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        t = varied(i, int(rng.integers(20, 120)))
        if rng.random() < 0.3:
            t = made(i, 80)
        if rng.random() < 0.3:
            t = t.upper()
        if rng.random() < 0.3:
            t += " 5 % & more"
        rows.append((int(rng.integers(0, 400)), t, ["a", "b", None, ""][i % 4]))
    rows += [(i + 1000, t, s) for i, t, s in rows[:40]] + [(i, t, "b") for i, t, s in rows[:10]]
    rows += [(None, rows[0][1], "a"), (None, None, "a"), (BIG, "", None), (BIG + 1, None, "only"), (-5, " \x0b\x0c", "only")]
    labels = [(int(i), int(q), int(x)) for i, q, x in zip(rng.integers(0, 1400, 300), rng.integers(0, 2, 300), rng.integers(0, 2, 300))]
    labels += [(None, 1, 1), (BIG, None, 1), (BIG, 1, None)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("source", F.lit("x"))
    got = filter_audit.audit_filters(frame(spark, rows), marks)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, labels)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(frame(spark, []), labels).collect() == []


def test_removal_steps_are_the_first_failing_filter():
    steps = filter_audit.removal_steps()
    for mask in range(32):
        for j, name in enumerate(filter_audit.NAMES):
            hit = [s for s, f in enumerate(name, 1) if mask >> "ABCDE".index(f) & 1]
            assert steps[mask, j] == min(hit, default=filter_audit.NEVER)


def test_mask_of_a_long_text(monkeypatch):
    text = (made(1, 40_000) + " É# " + "Q" * 50_000).encode()
    whole = filter_audit.text_mask(text)
    monkeypatch.setattr(filter_audit, "AT_ONCE", 1000)
    monkeypatch.setattr(words.blocks, "__defaults__", (777,))
    assert filter_audit.text_mask(text) == whole == 0b1110


# Hard negatives


def plain_negatives(rows, every=100, scale=256):
    ok = [
        (i, l, [int(np.floor(scale * x)) for x in v]) for i, l, v in rows
        if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, l, q in ok:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (l, q)), (l, q))
    out = []
    for a, (label, q) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(q, w)), i, l) for i, l, w in ok if i != a)
        for top, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [(i, s) for s, i, l in scored if l != label and 80 * -top <= 100 * -s <= 100 * -top][:5]
            out += [(a, p, r, i, -top, -s) for r, (i, s) in enumerate(fit, 1)]
    return sorted(out)


def vectors(seed, n, labels, dim=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    return [(i * 5, int(rng.integers(labels)), [float(y) for y in v]) for i, v in enumerate(x)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 32)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, l, v, 1, "x", "y") for i, l, v in rows], "vec_id long, label long, embedding array<float>, score int, rid string, aid string")
    return sorted(tuple(r) for r in hard_negatives.mine_negatives(df, **options).collect())


def test_negatives_equal_a_search_of_all_pairs(spark, small_blocks):
    rows = vectors(1, 300, 3)
    rows += [(i + 1, l, v) for i, l, v in rows[:60]] + rows[10:20]  # equal scores; repeated rows
    rows += [(None, 1, rows[0][2]), (2000, None, rows[0][2]), (2100, 1, None), (2200, 1, [1.0, None]), (2300, 1, [float("nan")] * 6)]
    rows += [(2400, 2, [float("inf")] * 6), (2500, 1, []), (2600, 0, [0.5]), (BIG, 0, rows[0][2]), (-300, 1, rows[3][2]), (2700, 2, [0.0] * 6)]
    got = mined(spark, rows)
    assert got and got == plain_negatives(rows)


def test_one_vector_held_by_a_third_of_the_rows(spark, small_blocks):
    rows = vectors(2, 200, 2)
    rows += [(3000 + i, i % 2, rows[0][2]) for i in range(100)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_large_components_are_exact(spark, small_blocks):
    rows = [(i, l, [float(np.float32(x * 300_000)) for x in v]) for i, l, v in vectors(3, 80, 2)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_neither_vectors_nor_pairs_of_blocks_are_broadcast(spark, small_blocks, monkeypatch):
    plans = []

    def spied(df, name, store=hard_negatives.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(hard_negatives, "stored", spied)
    rows = vectors(4, 200, 2)
    assert mined(spark, rows) == plain_negatives(rows)
    assert sum("MapInArrow" in p for p in plans) == 2
    assert not [p for p in plans if "Broadcast" in p]


def test_many_groups_and_ranges_agree_with_one_of_each(spark, monkeypatch):
    rows = vectors(5, 400, 3, dim=4) + [(5000 + i, i % 3, [0.25] * (i % 5)) for i in range(150)]
    rows += [(i, (l + 1) % 3, v) for i, l, v in rows[:40] if i % 20] + [(7000 + 10 * i, 0, v) for i, (_, _, v) in enumerate(rows[40:50])]
    expected = plain_negatives(rows, every=20)
    assert mined(spark, rows, every=20) == expected
    for name, value in {"BLOCK_ROWS": 32, "BLOCK_ANCHORS": 5, "GROUP_ANCHORS": 9, "TILE_ROWS": 120, "TILES": 2, "FIRST_ROWS": 3, "STEP_ROWS": 7, "FEW": 2}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(spark, rows, every=20) == expected


def test_scores_take_the_smallest_type_that_is_exact():
    a = np.array([[2000, -1], [1, 2]], np.int64)
    for times, kind in ((1, np.float32), (1000, np.float64), (10**10, np.int64)):
        s = hard_negatives.scores(a, a * times, 2000 * 2000 * times)
        assert s.dtype == kind and s.astype(object).tolist() == (a.astype(object) @ (a.astype(object) * times).T).tolist()
    with pytest.raises(ValueError):
        hard_negatives.scores(a, a, 1 << 62)


@pytest.mark.parametrize("shape", [(1, 1), (3, 8), (5, 13), (64, 31)])
def test_places_of_true_ones(shape):
    rng = np.random.default_rng(2)
    for part in (0.0, 0.02, 1.0):
        mask = rng.random(shape) < part
        assert [x.tolist() for x in hard_negatives._true(mask)] == [x.tolist() for x in np.nonzero(mask)]


def test_without_anchors_or_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert mined(spark, [(100, 1, [1.0]), (2, 2, [1.0])]) == []


def test_keys_sort_as_their_parts():
    rng = np.random.default_rng(1)
    parts = [tuple(int(x) for x in rng.integers(-5, 5, 3)) + (int(rng.integers(2)),) for _ in range(300)]
    parts += [(2**63 - 1, -(2**63), BIG, 1), (-(2**63), 2**63 - 1, -BIG, 0)]
    by_key = sorted(parts, key=lambda p: hard_negatives.packed(p[0], p[1], p[3], p[2]))
    assert by_key == sorted(parts, key=lambda p: (p[0], -p[1], p[3], p[2]))


def test_windows_hold_only_what_is_open():
    keys = [hard_negatives.packed(1, s, neg, i) for i, s, neg in [(7, 100, 0), (8, 100, 1), (9, 90, 0), (3, 85, 1), (4, 80, 1), (5, 72, 1), (6, 71, 1)]]
    keys += [hard_negatives.packed(2, 50, 1, 1), hard_negatives.packed(2, -10, 0, 2), hard_negatives.packed(2, -10, 1, 3)]
    got = list(hard_negatives.windows(((k, None) for k in sorted(keys)), 2, 80, 100))
    assert got == [(1, 7, 1, 8, 100, 100), (1, 7, 2, 3, 100, 85), (1, 9, 1, 3, 90, 85), (1, 9, 2, 4, 90, 80)]
