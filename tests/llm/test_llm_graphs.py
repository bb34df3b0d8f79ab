"""Components, NN-descent, tool calls and mixing against brute force."""

import json
import math
import random
from collections import Counter

import numpy as np
import pytest

from pagetally.llm import mixing, nn_descent, tool_calls
from pagetally.llm.components import components, small_components

# --- components ------------------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 620)]
    links += [(7, 7), (9, 8), (8, 9), (9, 8), (1, 2), (2, 3), (3, 1)]
    rnd.shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components(frame).collect()))
    assert dict(map(tuple, small_components(frame).collect())) == got
    assert small_components(frame.limit(0)).count() == 0
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 620)} | {8: 8, 9: 8, 1: 1, 2: 1, 3: 1, 7: 7}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- NN-descent ------------------------------------------------------------------------------


def true_links(rows, threshold=0.98):
    """n_links and smallest id reachable per usable vec_id."""
    good = {}
    for i, x, label in rows:
        ok = i is not None and label is not None and x and all(v is not None and math.isfinite(v) for v in x)
        if ok and any(x):
            good[i] = (np.array(x, float) / np.linalg.norm(x), label)
    near = {
        i: {j for j, (y, m) in good.items() if j != i and m == k and len(x) == len(y) and x @ y >= threshold}
        for i, (x, k) in good.items()
    }
    label = {i: i for i in near}
    for _ in near:
        new = {i: min([label[i], *(label[j] for j in near[i])]) for i in near}
        if new == label:
            break
        label = new
    return {i: (len(near[i]), label[i]) for i in near}


def vectors():
    rng, rows = np.random.default_rng(2), []
    add = lambda x, label: rows.append((len(rows), None if x is None else [float(v) for v in x], label))
    centre = rng.normal(size=32)
    for _ in range(150):  # a dense group: longer than the first lists
        add(centre + rng.normal(size=32) * 0.08, 1)
    for _ in range(300):
        add(rng.normal(size=32), int(rng.integers(0, 3)))
    for _ in range(40):  # pairs
        x = rng.normal(size=32)
        add(x, 2)
        add(x * 3 + rng.normal(size=32) * 0.05, 2)
    for label in (1, 1, 1, 2, None):  # exact copies, also under another label and under none
        add(rows[155][1], label)
    odd = [None, [0.0] * 32, [], [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0], [2.0]]
    for x in odd:
        rows.append((len(rows), x, 1))
    rows += [rows[155], (None, rows[155][1], 1)]
    return rows


def test_links_equal_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame = frame.selectExpr("*", "'x' n_links", "'x' kind", "'x' id")
    got = nn_descent.near_duplicates(frame).collect()
    # The table holds floats: compare with what it holds.
    plain = [(i, None if x is None else [None if v is None else float(np.float32(v)) for v in x], k) for i, x, k in rows]
    want = true_links(plain)
    assert len(got) == len(rows)
    for r in got:
        n, low = want.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (n, low, r.vec_id is None or r.vec_id == low)
    assert max(n for n, _ in want.values()) > 100


def test_blocks_count_the_same(spark):
    rows = [r for r in vectors()[:160] if r[1]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    counts = [
        sorted(map(tuple, nn_descent.near_duplicates(frame, nn_descent.Settings(block=b)).collect()))
        for b in (16, 1024)
    ]
    assert counts[0] == counts[1]


def test_audit_sees_missing_links(spark):
    rows = vectors()[:200]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    points = nn_descent.nodes(nn_descent.distinct(nn_descent.usable(frame)))
    nothing = spark.createDataFrame([], "id long, n_links long")
    nowhere = nothing.select("id")
    assert nn_descent.audit(points, nowhere, nothing, nn_descent.Settings()).recall == 0.0
    every = nn_descent.near_duplicates(frame).selectExpr("vec_id id", "n_links")
    assert nn_descent.audit(points, nowhere, every, nn_descent.Settings()).recall == 1.0


def test_audit_of_rare_links_asks_those_with_near_ones(spark, monkeypatch):
    """Two near copies among 3,000 vectors: a random sample would not see them."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[2999] = x[17] * np.float32(1.0001) + np.float32(0.001)
    rows = [(i, [float(v) for v in row], 1) for i, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    few = nn_descent.Settings(audited=16, most_audited=16)
    got, seen = nn_descent.audited(frame, few)
    assert seen.links >= 2 and seen.recall == 1.0 and 16 < seen.asked <= 32
    assert {r.vec_id for r in got.collect() if r.n_links} == {17, 2999}
    none = frame.where("vec_id < 2999")
    seen = nn_descent.audited(none, nn_descent.Settings(audited=16, most_audited=100))[1]
    assert seen.links == 0 and math.isnan(seen.recall) and seen.asked >= 100  # asked for more


def test_hot_vectors_and_null_labels(spark):
    """A third of all rows have one vector, another third no label."""
    rng = np.random.default_rng(9)
    some = [[float(np.float32(v)) for v in row] for row in rng.normal(size=(200, 8))]
    rows = [(i, some[0] if i % 3 == 0 else some[i % 200], 1 if i % 3 < 2 else None) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(6)
    want = true_links(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(frame).collect()}
    assert got == {i: want.get(i, (0, i)) for i in range(1500)}


def test_few_jobs_where_there_are_no_links(spark):
    """The number of jobs does not grow with rounds of small tables."""
    rng = np.random.default_rng(10)
    rows = [(i, [float(np.float32(v)) for v in row], 1) for i, row in enumerate(rng.normal(size=(500, 16)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("nn_descent", "jobs")
    try:
        nn_descent.near_duplicates(frame).collect()
        jobs = len(tracker.getJobIdsForGroup("nn_descent"))
    finally:
        spark.sparkContext.setJobGroup("tests", "others")
    assert jobs <= 60


def two_groups(n, across=0.985):
    """Rows of two groups of n vectors, near 0.999 inside and near `across` between them."""
    rng = np.random.default_rng(5)
    axes = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
    centres = axes[0], across * axes[0] + math.sqrt(1 - across**2) * axes[1]
    x = [c + rng.normal(size=32) * 0.0045 for c in centres for _ in range(n)]
    return [(i, [float(np.float32(v)) for v in row], 1) for i, row in enumerate(x)]


def equals_brute_force(spark, rows, settings):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = true_links(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(frame, settings).collect()}
    assert got == want
    return want


@pytest.mark.parametrize("n", [20, 90])  # of full lists that become long enough, and of those that do not
def test_groups_with_full_lists_are_joined(spark, n):
    # Of an audit that sees nothing, so that neither more rounds nor the exact end help.
    want = equals_brute_force(spark, two_groups(n), nn_descent.Settings(block=32, recall=0.0))
    assert {low for _, low in want.values()} == {0} and min(k for k, _ in want.values()) > n


def test_groups_too_far_from_each_other_stay_apart(spark):
    want = equals_brute_force(spark, two_groups(70, 0.9), nn_descent.Settings(recall=0.0))
    assert {low for _, low in want.values()} == {0, 70}


def test_short_audit_ends_exactly(spark, monkeypatch):
    nothing = spark.createDataFrame([], nn_descent.PAIRS)
    monkeypatch.setattr(nn_descent, "first_lists", lambda points, settings: nothing)
    rows = two_groups(40) + [(i + 1000, x, k) for i, x, k in two_groups(12, 0.5)]
    equals_brute_force(spark, rows, nn_descent.Settings(rounds=1, most_rounds=1, block=16))


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert nn_descent.near_duplicates(none).count() == 0


# --- tool calls ------------------------------------------------------------------------------

CALL = "conv_id long, call_id string, turn long, name string, arguments string, after string, message string"
RESULT = "conv_id long, call_id string, turn long, content string, status string"


def linked(spark, calls, results):
    calls = spark.createDataFrame([(*c, "x") for c in calls], CALL)
    results = spark.createDataFrame([(*r, "x") for r in results], RESULT)
    return tool_calls.link(calls, results, tool_calls.TOOLS).collect()


GOOD = '{"query": "q", "limit": 3}'


def test_every_kind_of_link(spark):
    calls = [
        (1, "a", 1, "search", GOOD, None),
        (1, "b", 3, "search", GOOD, "a"),
        (1, "c", 5, "search", GOOD, "b"),
        (1, "d", 7, "search", GOOD, "not there"),
        (1, "e", 9, "search", GOOD, "f"),
        (1, "f", 11, "search", GOOD, "e"),
        (1, "g", 13, "search", GOOD, "e"),
        (1, "b", 4, "search", "{}", None),
        (2, "a", 1, "search", GOOD, "b"),
        (None, "a", 1, "search", GOOD, None),
        (1, None, 1, None, None, None),
    ]
    results = [(1, "a", 2, "ra"), (1, "a", 2, "rb"), (1, "b", 1, "early"), (1, "z", 4, "alone"), (None, None, None, None)]
    rows = linked(spark, calls, results)
    by_key = {(r.conv_id, r.call_id): r for r in rows if r.status != "no_id"}
    got = {k: (r.status, r.level, r.n_calls, r.n_results) for k, r in by_key.items()}
    assert got == {
        (1, "a"): ("linked", 0, 1, 2),
        (1, "b"): ("early_result", 1, 2, 1),
        (1, "c"): ("no_result", 2, 1, 0),
        (1, "d"): ("no_result", 0, 1, 0),
        (1, "e"): ("circle", None, 1, 0),
        (1, "f"): ("circle", None, 1, 0),
        (1, "g"): ("circle", None, 1, 0),
        (1, "z"): ("no_call", None, 0, 1),
        (2, "a"): ("no_result", 0, 1, 0),
    }
    assert len(rows) == len(got) + 3
    assert json.loads(by_key[1, "a"].message)["result"] == "ra"


def test_levels_of_a_long_chain(spark):
    n = 150
    calls = [(1, str(i), i, "search", GOOD, str(i - 1)) for i in range(n)]
    random.Random(1).shuffle(calls)
    assert {r.call_id: r.level for r in linked(spark, calls, [])} == {str(i): i for i in range(n)}


def plain_levels(after):
    """The longest way back for each call of a dictionary of lists, by trying again until nothing
    changes; None where a way leads into a circle."""
    there = {k: {x for x in v or () if x in after} for k, v in after.items()}
    level = {}
    while True:
        new = {k: 1 + max((level[x] for x in v), default=-1) for k, v in there.items() if k not in level and v <= level.keys()}
        if not new:
            return {k: level.get(k) for k in after}
        level |= new


SEVERAL = "conv_id long, call_id string, turn long, name string, arguments string, after array<string>"


def several(spark, after):
    rows = [(1, k, i, "search", GOOD, v) for i, (k, v) in enumerate(after.items())]
    calls = tool_calls.link(spark.createDataFrame(rows, SEVERAL), spark.createDataFrame([], RESULT), tool_calls.TOOLS)
    return {r.call_id: (r.level, r.status) for r in calls.collect()}


LATER = [str(i) for i in range(1, 40)]
GRAPHS = {
    "null and absent": {"a": None, "b": [], "c": [None, "x", "a", "a"], "d": ["x", None]},
    "longest way": {"a": [], "b": ["a"], "c": ["b"], "d": ["a", "c"], "e": ["d", "a"], "f": ["e"]},
    "ways that meet": {str(i): [str(i - 1)] + ([str(i - 3)] if i % 3 == 2 else []) for i in range(60)},
    "nested forks": {str(i): [str(i - 1), str(i - 2)] for i in range(7)},
    "circles": {
        "a": [], "b": ["a", "d"], "c": ["b"], "d": ["c"], "e": ["e"], "f": ["e", "a"], "g": ["a", "f"], "h": ["g"],
        "i": ["b", "h"], "j": ["a"], "k": ["j", "a"], "l": ["i", "k"], "m": ["n", "o"], "n": ["m", "o"], "o": ["m", "n"],
    },
    "hot call": {"a": [], **{x: ["a"] for x in LATER}, "end": LATER},
}


@pytest.mark.parametrize("name", GRAPHS)
def test_levels_of_calls_after_several(spark, name):
    want = plain_levels(GRAPHS[name])
    got = several(spark, GRAPHS[name])
    assert {k: v for k, (v, _) in got.items()} == want
    assert {k for k, (_, status) in got.items() if status == "circle"} == {k for k, v in want.items() if v is None}


def test_levels_of_random_graphs(spark):
    """Many conversations at once, of all kinds of graphs, with and without circles."""
    rnd, rows, want = random.Random(14), [], {}
    for conv in range(60):
        n, back = rnd.randrange(1, 14), rnd.random() < 0.3
        after = {}
        for i in range(n):
            pool = range(n) if back else range(i)
            after[str(i)] = [str(x) for x in pool if rnd.random() < 0.25]
        want |= {(conv, k): v for k, v in plain_levels(after).items()}
        rows += [(conv, k, v) for k, v in after.items()]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, after array<string>")
    assert {(r.conv_id, r.call_id): r.level for r in tool_calls.levels(calls).collect()} == want


@pytest.mark.parametrize(
    "name, arguments, wrong",
    [
        ("search", GOOD, []),
        ("search", '{"query":"q","limit":"3"}', ["type:limit"]),
        ("search", '{"query":"q","limit":3.5}', ["type:limit"]),
        ("search", '{"query":null,"more":1}', ["missing:limit", "missing:query", "unexpected:more"]),
        ("search", "[1]", ["not_an_object"]),
        ("search", "nonsense", ["bad_json"]),
        ("search", '{"query":"q","query":"p","limit":1}', ["bad_json"]),
        ("search", None, ["bad_json"]),
        ("search", "", ["bad_json"]),
        ("other", GOOD, ["unknown_tool"]),
        (None, GOOD, ["unknown_tool"]),
        ("translate", '{"text":"t","target":"xx"}', ["choice:target"]),
        ("count_words", '{"text":"t","options":{"b":1,"a":[{"d":1,"c":2}]}}', []),
        ("count_words", '{"text":"t","options":[]}', ["type:options"]),
    ],
)
def test_arguments_are_checked(spark, name, arguments, wrong):
    row = linked(spark, [(1, "a", 1, name, arguments, None)], [])[0]
    assert row.problems == wrong


def test_messages_are_canonical(spark):
    arguments = '{"text": "t\\u00e9\\n\\"", "options": {"b": 1, "a": [{"d": true, "c": null}]}}'
    message = linked(spark, [(1, "a", 1, "count_words", arguments, None)], [(1, "a", 2, "r")])[0].message
    want = {
        "arguments": json.loads(arguments), "call_id": "a", "conv_id": 1, "name": "count_words",
        "result": "r", "status": "linked",
    }
    assert message == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_no_calls(spark):
    assert linked(spark, [], []) == []


# --- mixing ----------------------------------------------------------------------------------


def plain_weights(tokens, target):
    """Exponent and repetitions by trying the whole grid."""
    total = sum(tokens.values())
    best = None
    for k in range(mixing.GRID + 1):
        mass = {s: (t / total) ** (k / mixing.GRID) for s, t in tokens.items()}
        z = sum(mass.values())
        w = {s: m / z for s, m in mass.items()}
        entropy = -sum(x * math.log2(x) for x in w.values())
        budget = target.budget or max(tokens[s] / w[s] for s in w)
        repeats = {s: w[s] * budget / tokens[s] for s in w}
        if target.entropy is not None and (k == 0 or entropy >= target.entropy):
            best = k, repeats
        if target.max_repeats is not None and best is None and max(repeats.values()) <= target.max_repeats:
            best = k, repeats
    return best


SIZES = {"big": 3000, "middle": 700, "small": 160, "tiny": 40}


def corpus(spark):
    rnd, rows = random.Random(6), []
    for source, n in SIZES.items():
        rows += [(len(rows) + i, "w " * rnd.randrange(1, 20), None, source, None) for i in range(n)]
    rows += [(90_000, "", None, "empty", None), (90_001, None, None, None, None), (None, "a b", None, None, None)]
    return rows + [rows[0]]


@pytest.mark.parametrize(
    "target",
    [
        mixing.Target(max_repeats=2.0),
        mixing.Target(max_repeats=7.5),
        mixing.Target(entropy=1.4),
        mixing.Target(entropy=9.0),
        mixing.Target(max_repeats=3.0, budget=20_000),
        mixing.Target(entropy=1.8, budget=90_000),
    ],
)
def test_mixture_meets_its_target(spark, target):
    rows = corpus(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    tokens = Counter()
    for _, text, _, source, _ in rows:
        tokens[source] += len((text or "").split())
    tokens = {s: n for s, n in tokens.items() if n}
    _, repeats = plain_weights(tokens, target)
    got = mixing.mixture(docs, target).collect()
    taken, blocks = Counter(), {}
    for r in got:
        taken[r.source] += r.n_tokens
        blocks.setdefault((r.source, r.block), []).append(r.doc_id)
    for s, n in tokens.items():
        assert taken[s] <= repeats[s] * n + 1
        # The last block misses its budget by less than the largest texts of one place.
        assert taken[s] >= repeats[s] * n - 40
    assert sum(r.source == "empty" for r in got) == 1
    whole = Counter(r[0] for r in rows if r[3] == "small")
    for (source, block), ids in blocks.items():
        if source == "small" and block < int(repeats["small"] + 1e-6):
            assert Counter(ids) == whole  # a block is a permutation of all documents
    assert all(0 <= r.at <= 1 for r in got)


def test_every_document_comes_where_the_budget_is_open(odd, odd_rows, none):
    got = mixing.mixture(odd, mixing.Target(max_repeats=2.0))
    seen = Counter(str(r.doc_id) for r in got.collect())
    assert all(seen[k] >= n for k, n in Counter(str(r[0]) for r in odd_rows).items())
    assert {"score", "ids", "text"} <= set(got.columns)
    assert mixing.mixture(none, mixing.Target(entropy=1.0)).count() == 0


def test_blocks_are_in_different_orders(spark):
    docs = spark.createDataFrame([(i, "w", None, "s", 1) for i in range(50)] + [(99, "w " * 100, None, "t", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mixture(docs, mixing.Target(max_repeats=2.0)).where("source = 's'")
    orders = [[r.doc_id for r in got.where(f"block = {b}").orderBy("place").collect()] for b in (0, 1)]
    assert len(orders[0]) == 50 and orders[0] != orders[1]


def test_targets_are_one_of_two():
    with pytest.raises(ValueError):
        mixing.Target()
    with pytest.raises(ValueError):
        mixing.Target(entropy=1.0, max_repeats=2.0)
