import random
import re

import numpy as np
import pytest

from millrace.llm import neardup

WORD = re.compile("[a-z0-9_]+")


def shingles(t, n=3):
    w = WORD.findall((t or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 12, 40, 90]))] for _ in range(n // 4)]
    out = [None, "", "one two", "Ünïcode — only"]
    while len(out) < n:
        t = list(rnd.choice(base))
        for _ in range(rnd.randint(0, max(1, len(t) // 6))):
            i = rnd.randrange(len(t))
            rnd.choice([lambda: t.__setitem__(i, rnd.choice(vocab)), lambda: t.insert(i, "new"), lambda: t.reverse()])()
        out.append((" ".join(t)).upper() if rnd.random() < 0.2 else "-".join(t))
    return out


def brute(texts, g):
    sets = [shingles(t) for t in texts]
    return {
        (i, j)
        for i in range(len(texts))
        for j in range(i + 1, len(texts))
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= g * len(sets[i] | sets[j])
    }


@pytest.mark.parametrize("seed, g", [(1, 0.6), (2, 0.6), (3, 0.8)])
def test_pairs_equal_brute_force(spark, seed, g):
    a, b = corpus(seed), corpus(seed + 100)
    df = spark.createDataFrame([(i, x, y, "s") for i, (x, y) in enumerate(zip(a, b))], "row_id bigint, patch string, test_patch string, side string")
    links = neardup.near_duplicates(df, similarity=g)
    got = {tuple(r) for r in neardup.similar_pairs(links).collect()}
    assert got == brute(a, g) | brute(b, g)


def test_many_copies_become_a_star(spark):
    t = "alpha beta gamma delta epsilon"
    df = spark.createDataFrame([(i, t, None) for i in range(90)] + [(500, t + " zeta", None)], "row_id bigint, patch string, test_patch string")
    links = neardup.near_duplicates(df)
    got = {tuple(r) for r in neardup.similar_pairs(links).collect()}
    assert got == {(0, i) for i in range(1, 90)} | {(0, 500)}
    one = {r["row_id"]: r for r in neardup.class_links(links).collect()}
    assert one[7]["class_id"] == 0 and one[7]["copies"] == 90 and one[500]["links"] == 1


def test_star_holds_only_the_very_same_text(spark):
    t = "alpha beta gamma delta epsilon"
    texts = {i: t for i in range(80)} | {100 + i: t.replace(" ", "-" * (i + 1)) for i in range(3)} | {500: t + " zeta"}
    df = spark.createDataFrame([(i, x, None) for i, x in texts.items()], "row_id bigint, patch string, test_patch string")
    got = {tuple(r) for r in neardup.similar_pairs(neardup.near_duplicates(df)).collect()}
    different = {(a, b) for a in (0, 100, 101, 102, 500) for b in (100, 101, 102, 500) if a < b}
    assert got == {(0, i) for i in range(1, 80)} | different


def test_empty(spark):
    df = spark.createDataFrame([], "row_id bigint, patch string, test_patch string")
    assert neardup.similar_pairs(neardup.near_duplicates(df)).count() == 0


def test_shingle_sets():
    texts = ["a b c d", "A,B;c d", "a b c d a b c d", None, "x y", "b c d a"]
    s = neardup.shingle_sets(texts)
    assert np.array_equal(s[0], s[1]) and len(s[2]) == 4 and len(s[3]) == len(s[4]) == 0 and len(s[5]) == 2
    assert [len(x) for x in s] == [len(shingles(t)) for t in texts]


def pair(rnd, common, own, other, hot):
    x = np.array([rnd.getrandbits(64) for _ in range(common + own + other)], np.uint64)
    df = np.array([rnd.choice([2, 2, 3, 9, *([5000] * hot)]) for _ in x], np.int32)
    return x, df, np.r_[0 : common + own], np.r_[0:common, common + own : common + own + other]


def test_similar_sets_always_share_a_signature():
    rnd = random.Random(11)
    for turn in range(3000):
        if turn < 1000:
            common, own, other = rnd.choice([(1, 0, 0), (3, 1, 1), (3, 0, 2), (4, 1, 1), (5, 1, 1), (6, 2, 2), (12, 4, 4)])
        else:
            common = rnd.randint(1, 250)
            most = int(common / 0.6) - common  # differences at similarity 0.6
            own = rnd.randint(0, most)
            other = rnd.choice([most - own, rnd.randint(0, most - own)])
        x, df, a, b = pair(rnd, common, own, other, rnd.choice([0, 0, 1, 8, 40]))
        # shingles that only one of all texts holds are left out and counted
        keep = lambda i: np.array([j for j in i if j < common or rnd.random() < 0.7], int)
        sigs = [set(neardup.signatures(1, len(i), x[k], df[k], 0.6)[0].tolist()) for i in (a, b) for k in [keep(i)]]
        assert sigs[0] & sigs[1], (common, own, other)


def test_enumerated_subsets_bring_pairs_together():
    """Ablation: few sets are thin, and pairs of the others meet by subsets of cells alone, of several shingles each."""
    rnd = random.Random(5)
    thin, met = 0, 0
    for _ in range(300):
        x, df, a, b = pair(rnd, 90, 12, 12, 0)
        (s, t), (u, v) = (neardup.signatures(1, len(i), x[i], df[i], 0.6) for i in (a, b))
        thin += t and v
        met += bool(set(s[: len(s) - (t and 41)].tolist()) & set(u[: len(u) - (v and 41)].tolist()))
    assert met == 300 and thin < 100


def test_heavy_shingles_are_not_gathered(spark, monkeypatch):
    licence = " ".join(f"licence{i}" for i in range(30))
    texts = [f"{licence} " + " ".join(f"t{i // 2}_{k}" for k in range(60 if i % 2 else 58)) for i in range(80)]
    df = spark.createDataFrame([(i, x, None) for i, x in enumerate(texts)], "row_id bigint, patch string, test_patch string")
    got = {tuple(r) for r in neardup.similar_pairs(neardup.near_duplicates(df)).collect()}
    assert got == brute(texts, 0.6) and len(got) == 40
    sets = neardup.shingle_sets(texts)
    heavy = np.sort(neardup._salted(neardup.shingle_sets([licence])[0], 1))
    dealt = list(neardup._deal(3, 4, heavy, np.full(len(heavy), 80, np.int32))(iter([pa_batch(texts)])))
    counted = [len(k) // 8 for b in dealt for k, n in zip(b.column(3).to_pylist(), b.column(4).to_pylist()) if n]
    plain = [len(k) // 8 for b in dealt for k, n in zip(b.column(3).to_pylist(), b.column(4).to_pylist()) if not n]
    assert sum(counted) == 80 * len(heavy) and sum(plain) == sum(map(len, sets)) - sum(counted)


def pa_batch(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["row_id", "patch"])
