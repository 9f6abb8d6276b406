from collections import defaultdict

from weftline.llm import mixing as M


def test_targets_and_copies(spark):
    data = [(i, "w " * (i % 17), ["a", "b", "c", None, "é"][i % 5], 1.0) for i in range(3000)]
    data += [(5000 + i, "big " * 400, "a", 1.0) for i in range(40)] + [(9000, None, "zero", 1.0), (None, "x y", "b", 1.0), (7, "dup dup", "c", 1.0), (7, "dup dup", "c", 1.0)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, target double")
    got = M.mix(df).collect()
    assert len(got) == len(data)
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    words = {s: sum(len((t or "").split()) for _, t, x, _ in data if x == s) for s in {d[2] for d in data}}
    order = sorted((s for s in words if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full: set = set()
    while True:
        c = (1.5 * sum(words.values()) - sum(2 * words[s] for s in full)) / sum(weight[s] for s in words if s not in full)
        more = {s for s in words if s not in full and weight[s] * c >= 2 * words[s]}
        if not more:
            break
        full |= more
    by_size = {(w, 2 * w if s in full else weight[s] * c) for s, w in words.items()}
    for r in got:
        assert any(r["source_size"] == w and abs(r["target"] - t) < 1e-6 for w, t in by_size)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source_size"]] += r["taken"]
    for w, t in by_size:
        assert abs(taken[w] - t) <= (200 if w == words["a"] else 9)
    assert sorted(map(repr, got)) == sorted(map(repr, M.mix(df.repartition(7)).collect()))
    assert M.mix(df.limit(0)).collect() == []


def test_odds_change_who_is_taken(spark):
    data = [(i, "w w", "s", 9.0 if i % 2 else 1.0) for i in range(2000)] + [(5000 + i, "w w", "t", 1.0) for i in range(2000)]
    got = M.mix(spark.createDataFrame(data, "doc_id long, text string, source string, o double"), weights=(1, 5), total=1.2, odds_col="o").collect()
    odd = [r["copies"] for r in got if r["doc_id"] < 5000 and r["doc_id"] % 2]
    even = [r["copies"] for r in got if r["doc_id"] < 5000 and r["doc_id"] % 2 == 0]
    assert sum(odd) > 1.3 * sum(even)
