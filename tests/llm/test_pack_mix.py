import random

import numpy as np
import pytest
import regex

from millrace.llm import mix, pack, tokens

D_SCHEMA = "doc_id bigint, text string, source string, tokens string, profile string"
TEXTS = ["", None, "one two, three!", "naïve café’s — «ok»", "日本語 テキスト 123", "a_b __init__ x-y", "é" + "é", "नमस्ते दुनिया"]


def docs(spark, n=300, seed=1):
    rnd = random.Random(seed)
    data = [(i, " ".join(["w"] * rnd.choice([0, 1, 3, 9, 10, 11, 25, rnd.randint(1, 9)])), rnd.choice(["a", "a", "a", "b", "c", None]), "x", "y") for i in range(n)]
    return spark.createDataFrame([*data, (n, None, "a", "x", "y")], D_SCHEMA)


def test_token_count(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(tokens.token_count("t")).collect()]
    assert got == [len(regex.findall(r"\w+|[^\w\s]+", t or "")) for t in TEXTS]


@pytest.mark.parametrize("seed", range(5))
def test_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 101, 400)
    box = pack.best_fit_decreasing(sizes, 100)
    assert np.bincount(box, weights=sizes).max() <= 100
    bound = pack.lower_bound(sizes, 100)
    assert -(-sizes.sum() // 100) <= bound <= box.max() + 1
    assert pack.lower_bound(np.array([51] * 7), 100) == 7
    assert pack.lower_bound(np.array([34] * 9), 100) == 5  # two to a container
    assert pack.lower_bound(np.empty(0, int), 100) == 0


@pytest.mark.parametrize("seed", range(3))
def test_thresholds_are_all_tried(seed):
    rng = np.random.default_rng(seed)
    sizes, cap = rng.integers(1, 5001, 60), 5000
    want = max(
        -(-sum(cap if x > cap - t else 0 if x < t else int(x) for x in sizes) // cap) for t in {1, *sizes[sizes * 2 <= cap].tolist()}
    )
    assert pack.lower_bound(sizes, cap) >= want


def test_rounds_go_on_until_the_pool_is_small(spark, monkeypatch):
    monkeypatch.setattr(pack, "ITEMS", 40)
    df = docs(spark, 700, 9)
    profiles = spark.createDataFrame([("p30", 30)], "profile string, capacity_tokens int")
    out = pack.pack(df, profiles).collect()
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in df.collect()}
    fill = {}
    for r in out:
        fill[r["container"]] = fill.get(r["container"], 0) + r["tokens"]
    assert sum(r["tokens"] for r in out) == sum(size.values()) and max(fill.values()) <= 30
    assert len({r["container"].split("-")[1] for r in out}) > 1
    assert len(fill) <= 1.05 * pack.lower_bound(np.array([n for n in size.values() if n]), 30) + 3


def test_pack(spark):
    df = docs(spark)
    profiles = spark.createDataFrame([("p10", 10), ("p10", 10), ("p30", 30)], "profile string, capacity_tokens int")
    out = pack.pack(df, profiles).collect()
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in df.collect()}
    for profile, cap in (("p10", 10), ("p30", 30)):
        mine = [r for r in out if r["profile"] == profile]
        fill, per = {}, {}
        for r in mine:
            fill[r["container"]] = fill.get(r["container"], 0) + r["tokens"]
            per.setdefault(r["doc_id"], []).append(r["tokens"])
        assert max(fill.values()) <= cap
        assert {k: sum(v) for k, v in per.items()} == {k: v for k, v in size.items() if v}
        assert all(len(v) == -(-size[k] // cap) for k, v in per.items())
        assert len(fill) <= -(-sum(size.values()) // cap) + 2
    assert pack.pack(df.limit(0), profiles).count() == 0
    assert pack.pack(df, profiles.limit(0)).count() == 0


def test_mix(spark):
    df = docs(spark, 600, 3)
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("none", 0.2, 2)], "source string, weight double, max_repeats int")
    size = {r["doc_id"]: (len((r["text"] or "").split()), r["source"]) for r in df.collect()}
    budget = sum(n for n, _ in size.values())
    out = sorted(mix.mixture(df, t).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in out] == list(range(1, len(out) + 1))
    assert [r["finish"] for r in out] == sorted(r["finish"] for r in out)
    for s, w, k in (("a", 0.5, 1), ("b", 0.3, 3)):
        mine = [r for r in out if r["source"] == s]
        assert len({(r["doc_id"], r["copy"]) for r in mine}) == len(mine)
        assert max((r["copy"] for r in mine), default=0) <= k
        # in the order of its own finish times a source serves every document once before any comes again
        assert [r["copy"] for r in mine] == sorted(r["copy"] for r in mine)
        served = 0
        for r in mine:
            served += r["tokens"]
            assert r["finish"] == pytest.approx(served / w)
    longest = max(n for n, _ in size.values())
    total = sum(r["tokens"] for r in out)
    supply = {s: k * sum(n for n, src in size.values() if src == s) for s, k in (("a", 1), ("b", 3))}
    got = {s: sum(r["tokens"] for r in out if r["source"] == s) for s in supply}
    assert total <= budget and total > min(budget, sum(supply.values())) - longest
    # what one source cannot serve goes to the other
    end = mix.fluid_time([(0.5, supply["a"]), (0.3, supply["b"])], budget)
    assert all(abs(got[s] - min(supply[s], w * end)) <= 2 * longest for s, w in (("a", 0.5), ("b", 0.3)))
    rep = {r["source"]: r for r in mix.mix_report(df, t).collect()}
    assert rep["none"]["short"] and rep["none"]["tokens"] == 0
    assert rep["a"]["short"] == (sum(n for n, s in size.values() if s == "a") < 0.5 * budget)
    assert rep["a"]["budget"] if "budget" in rep["a"].asDict() else True
    assert mix.mixture(df.limit(0), t).count() == 0
    assert not any(r["short"] for r in mix.supply_report(df.limit(0), t).collect())


def test_fluid_time():
    assert mix.fluid_time([(0.5, 100), (0.5, 1000)], 100) == pytest.approx(100)
    assert mix.fluid_time([(0.5, 100), (0.5, 1000)], 400) == pytest.approx(600)
    assert mix.fluid_time([(0.5, 100), (0.25, 10)], 400) == pytest.approx(200)  # all empty
    assert mix.fluid_time([], 5) == 0


def test_ample_sources_fill_the_budget_at_their_weights(spark):
    data = [(i, "w " * (1 + i % 7), s, "x", "y") for i in range(900) for s in ("a", "b", None)[i % 3 : i % 3 + 1]]
    df = spark.createDataFrame(data, D_SCHEMA)
    t = spark.createDataFrame([("a", 0.75, 5), ("b", 0.25, 5)], "source string, weight double, max_repeats int")
    rep = {r["source"]: r for r in mix.mix_report(df, t).collect()}
    budget = sum(len(r[1].split()) for r in data)
    assert budget - 7 < sum(r["mixed_tokens"] for r in rep.values()) <= budget
    assert rep["a"]["actual_share"] == pytest.approx(0.75, abs=0.01) and rep["a"]["rounds"] >= 3
