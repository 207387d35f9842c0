"""Graph and shape operators against brute force on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citygrain.grid import Grid
from citygrain.operators import centrality, facility, graph, nearest, places, reach, shapes, topology
from citygrain.plans import accessibility, roads
from citygrain.scale import Rounds, crowded_join


def test_cities_are_searched_apart(spark):
    """Nearest nodes and costs between points of two cities whose nodes lie among each other."""
    rng = random.Random(31)
    spots = lambda n: [(i, rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(n)]
    nodes, places = {c: spots(70) for c in "ab"}, {c: spots(8) for c in "abc"}
    rows = {c: random_edges(70, 160, ord(c)) for c in "ab"}
    table = lambda held, schema: spark.createDataFrame([(c, *r) for c in held for r in held[c]], f"city string, {schema}")
    pairs = {c: [(a, (a + 3) % 8) for a in range(8)] for c in "ab"}
    found = reach.od_from_points(
        table(nodes, "node long, x double, y double"), table(rows, "edge long, u long, v long, length double"),
        table(places, "id long, x double, y double"), table(places, "id long, x double, y double"),
        table(pairs, "origin long, destination long"), 99.0, 12.0, by=["city"],
    )
    near = {(c, i): min(nodes[c], key=lambda n: (math.dist(n[1:], (x, y)), n[0]))[0] for c in "ab" for i, x, y in places[c]}
    want = {}
    for c in "ab":
        for a, b in pairs[c]:
            cost = costs_by_hand(rows[c], near[c, a]).get(near[c, b], math.inf)
            want[c, a, b] = cost if cost <= 12 else 99.0
    assert {(r.city, r.origin, r.destination): r.cost for r in found.collect()} == want


def random_edges(n, m, seed):
    rng = random.Random(seed)
    return [(i, rng.randrange(n), rng.randrange(n), float(rng.randint(1, 9))) for i in range(m)]


def edge_table(spark, rows):
    return spark.createDataFrame(rows, "edge long, u long, v long, length double")


def costs_by_hand(rows, source):
    best, todo = {source: 0.0}, [source]
    while todo:
        u = todo.pop()
        for _, a, b, w in rows:
            if a == u and best[u] + w < best.get(b, math.inf):
                best[b] = best[u] + w
                todo.append(b)
    return best


def test_shortest_costs(spark):
    rows = random_edges(30, 70, 1)
    edges = edge_table(spark, rows)
    origins = spark.createDataFrame([(i,) for i in range(5)], "node long").withColumn("origin", F.col("node"))
    got = {(r["origin"], r["node"]): r["cost"] for r in reach.shortest_costs(edges, origins, carry=["origin"]).collect()}
    want = {(s, n): c for s in range(5) for n, c in costs_by_hand(rows, s).items()}
    assert got == want


@pytest.mark.parametrize("cutoff", [None, 14.0])
def test_shortest_costs_in_bands(spark, cutoff):
    rows = random_edges(40, 110, 21) + [(900 + i, 40 + i, 41 + i, 1.0) for i in range(12)] + [(990, 3, 40, 2.0)]
    cities = ("a", "b")
    edges = spark.createDataFrame([(c, *r) for c in cities for r in rows], "city string, edge long, u long, v long, length double")
    starts = [("a", s) for s in range(8)] + [("b", 3), ("b", 3), ("b", 77)]
    origins = spark.createDataFrame(starts, "city string, node long").withColumn("origin", F.col("node"))
    found = reach.shortest_costs(edges, origins, cutoff, by=["city"], carry=["origin"], open_rows=60)
    got = {(r.city, r.origin, r.node): r.cost for r in found.collect()}
    want = {(c, s, n): d for c, s in starts for n, d in costs_by_hand(rows, s).items() if cutoff is None or d <= cutoff}
    assert got == want and found.count() == len(want)
    assert not [t for t in spark.catalog.listTables() if "settled_costs" in t.name]


def shuffled_rows(spark, run):
    """Rows that stages write to shuffles while ``run`` works."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._jvm.java.util.ArrayList()
    stages = lambda: store.stageList(none, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), none)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = {(s.stageId(), s.attemptId()) for s in (stages().apply(i) for i in range(stages().size()))}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    now = stages()
    after = [now.apply(i) for i in range(now.size())]
    return sum(s.shuffleWriteRecords() for s in after if (s.stageId(), s.attemptId()) not in before)


def test_settled_costs_are_not_shuffled_again(spark):
    # along a line every round extends one node: with bands, rows moved grow with its length, not with its square
    def moved(n):
        edges = edge_table(spark, [(i, i, i + 1, 1.0) for i in range(n)])
        origins = spark.createDataFrame([(0,)], "node long")
        return shuffled_rows(spark, lambda: reach.shortest_costs(edges, origins, n / 1, open_rows=8).count())

    small, large = moved(10), moved(30)
    assert large < 4 * small


def test_reach_grows_with_the_cutoff(spark):
    edges = edge_table(spark, random_edges(40, 100, 2))
    origins = spark.createDataFrame([(0,), (1,)], "node long")
    near = {r["node"] for r in reach.reach(edges, origins, 5.0).collect()}
    far = {r["node"] for r in reach.reach(edges, origins, 9.0).collect()}
    assert near <= far


def test_bad_weights_fail(spark):
    edges = edge_table(spark, [(0, 0, 1, 0.0), (1, 1, 2, 3.0)])
    origins = spark.createDataFrame([(0,)], "node long")
    with pytest.raises(Exception, match="without a positive length"):
        reach.shortest_costs(edges, origins).collect()


def test_od_from_either_side(spark):
    rows = random_edges(25, 60, 3)
    edges = edge_table(spark, rows)
    few = spark.createDataFrame([(1,), (2,)], "node long")
    many = spark.createDataFrame([(i,) for i in range(10)], "node long")
    for o, d in ((few, many), (many, few)):
        got = {(r["o"], r["d"]): r["cost"] for r in reach.od_costs(edges, o, d, math.inf).collect()}
        dest = {r["node"] for r in d.collect()}
        want = {
            (s["node"], n): c for s in o.collect() for n, c in costs_by_hand(rows, s["node"]).items() if n in dest
        }
        assert got == want


def components_by_hand(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "path", "shuffled path"])
def test_connected_components(spark, kind):
    rng = random.Random(5)
    if kind == "random":
        pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    else:
        order = list(range(80))
        if kind == "shuffled path":
            rng.shuffle(order)
        pairs = list(zip(order, order[1:]))
    nodes = spark.createDataFrame([(i,) for i in range(80)], "node long")
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = {r["node"]: r["label"] for r in topology.connected_components(edges, nodes).collect()}
    assert got == components_by_hand(pairs, range(80))


def test_strong_components(spark):
    rows = random_edges(40, 60, 7)
    edges = edge_table(spark, rows)
    reached = {s: set(costs_by_hand(rows, s)) for s in range(40)}
    got = {r["node"]: r["component"] for r in topology.strong_components(edges).collect()}
    for a in got:
        for b in got:
            assert (got[a] == got[b]) == (b in reached[a] and a in reached[b])
    sizes = {}
    for _, u, v, _ in rows:
        if got[u] == got[v]:
            sizes[got[u]] = sizes.get(got[u], 0) + 1
    best = min((-n, c) for c, n in sizes.items())
    assert topology.largest_scc(edges).count() == -best[0]


def strong_by_hand(pairs):
    """Tarjan's way without recursion; each component is a frozen set."""
    ahead: dict = {}
    for u, v in pairs:
        ahead.setdefault(u, []).append(v)
        ahead.setdefault(v, [])
    index, low, on, stack, out = {}, {}, set(), [], {}
    for root in ahead:
        work = [(root, iter(ahead[root]))] if root not in index else []
        while work:
            u, rest = work[-1]
            if u not in index:
                index[u] = low[u] = len(index)
                stack.append(u)
                on.add(u)
            for v in rest:
                if v not in index:
                    work.append((v, iter(ahead[v])))
                    break
                if v in on:
                    low[u] = min(low[u], index[v])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[u])
                if low[u] == index[u]:
                    part = set()
                    while u not in part:
                        part.add(stack.pop())
                    on -= part
                    out |= dict.fromkeys(part, frozenset(part))
    return out


def streets_with_one_ways(rng):
    """A lattice of mostly one-way streets with pendant ways, rings hung on by one edge, and a long way in."""
    pairs = []
    for x in range(7):
        for y in range(7):
            for a, b in ((x + 1, y), (x, y + 1)):
                if a < 7 and b < 7:
                    ends = (10 * x + y, 10 * a + b)
                    pairs += [ends, ends[::-1]] if rng.random() < 0.3 else [ends if rng.random() < 0.5 else ends[::-1]]
    pairs += [(100 + i, 101 + i) for i in range(30)] + [(130, 0)]
    pairs += [(200 + i, 200 + (i + 1) % 17) for i in range(17)] + [(205, 33)]
    pairs += [(300 + i, 300 + (i + 1) % 9) for i in range(9)] + [(44, 303), (303, 500), (500, 501), (501, 305)]
    return pairs


@pytest.mark.parametrize("kind", ["sparse", "dense", "streets", "functional", "ring with chords", "none"])
def test_strong_components_of_many_shapes(spark, kind):
    rng = random.Random(kind)
    pairs = {
        "sparse": lambda: [(rng.randrange(150), rng.randrange(150)) for _ in range(190)],
        "dense": lambda: [(rng.randrange(60), rng.randrange(60)) for _ in range(240)],
        "streets": lambda: streets_with_one_ways(rng),
        "functional": lambda: [(i, rng.randrange(120)) for i in range(120)],
        "ring with chords": lambda: [(i, (i + 1) % 90) for i in range(90)] + [(5, 40), (41, 7), (60, 95), (95, 96)],
        "none": lambda: [(1, 1)],
    }[kind]()
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = {r.node: r.component for r in topology.strong_components(edges).collect()}
    want = strong_by_hand(pairs)
    assert got.keys() == want.keys()
    parts: dict = {}
    for node, name in got.items():
        assert name in want[node]
        parts.setdefault(name, set()).add(node)
    assert {frozenset(p) for p in parts.values()} == set(want.values())


def test_origins_of_one_search_share_its_band(spark, monkeypatch):
    """Rows that may be open are counted by search, so many origins of one category need no bands."""
    n = 30
    links = [(i, (i + 1) % n, 1.0 + i % 3) for i in range(n)]
    edges = spark.createDataFrame(links, "u long, v long, length double")
    origins = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(0, n, 2)] + [(1, "a")], "node long, category string")

    def banded(*args, **named):
        raise AssertionError("a band was opened")

    monkeypatch.setattr(reach, "Kept", banded)
    found = reach.shortest_costs(edges, origins, 4.0, carry=["category"], open_rows=100)
    want = {}
    for start, category in [(r.node, r.category) for r in origins.collect()]:
        at, cost = start, 0.0
        while cost <= 4.0:
            want[category, at] = min(cost, want.get((category, at), cost))
            cost, at = cost + links[at][2], links[at][1]
    assert {(r.category, r.node): r.cost for r in found.collect()} == want


@pytest.mark.parametrize("kind", ["sparse", "streets"])
def test_components_of_pivots_by_city(spark, monkeypatch, kind):
    """Large graphs: the component of a city's best-connected node is found first, each edge being passed once each way."""
    rng = random.Random(kind)
    make = {
        "sparse": lambda: [(rng.randrange(150), rng.randrange(150)) for _ in range(230)],
        "streets": lambda: streets_with_one_ways(rng),
    }[kind]
    cities = {"a": make(), "b": make()}
    monkeypatch.setattr(topology, "PIVOT_EDGES", 1)
    rests = []
    pivots = topology._without_pivots
    monkeypatch.setattr(topology, "_without_pivots", lambda *a: rests.append(pivots(*a)) or rests[-1])
    edges = spark.createDataFrame([(c, u, v) for c, pairs in cities.items() for u, v in pairs], "city string, u long, v long")
    got = {(r.city, r.node): r.component for r in topology.strong_components(edges, ["city"]).collect()}
    one = {r.node: r.component for r in topology.strong_components(edges.where("city = 'a'").select("u", "v")).collect()}
    assert len(rests) == 2
    want = {(c, n): part for c, pairs in cities.items() for n, part in strong_by_hand(pairs).items()}
    for found, wanted in ((got, want), ({("a", n): c for n, c in one.items()}, {k: p for k, p in want.items() if k[0] == "a"})):
        assert found.keys() == wanted.keys()
        parts: dict = {}
        for (city, node), name in found.items():
            assert name in wanted[city, node]
            parts.setdefault((city, name), set()).add(node)
        assert {(c, frozenset(p)) for (c, _), p in parts.items()} == {(c, p) for (c, _), p in wanted.items()}


def test_a_long_ring_takes_few_rounds(spark, monkeypatch):
    n, rounds = 10_000, []
    cut = Rounds.cut
    monkeypatch.setattr(Rounds, "cut", lambda self, df: rounds.append(1) or cut(self, df))
    ring = spark.range(n).select(F.col("id").alias("u"), ((F.col("id") * 1 + 1) % n).alias("v"))
    got = topology.strong_components(ring).agg(F.count_distinct("component").alias("c"), F.count("*").alias("n")).first()
    assert (got.c, got.n) == (1, n) and len(rounds) < 40


def test_leaps_shorten_a_spread(spark, monkeypatch):
    n, rounds = 600, []
    cut = Rounds.cut
    monkeypatch.setattr(Rounds, "cut", lambda self, df: rounds.append(1) or cut(self, df))
    line = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    labels = spark.range(n + 1).select(F.col("id").alias("node"), F.col("id").alias("label"))
    got = topology._spread_min(Rounds(spark, "leaps"), line, labels)
    assert got.agg(F.max("label")).first()[0] == 0 and got.count() == n + 1 and len(rounds) < 70


def test_places_just_beyond_the_distance_stay_apart(spark):
    """Two places of one tiny box, whose corner is within reach of a third place while they are not."""
    rows, d = [], 1e-10
    for i, at in enumerate((0.31, 0.377, 0.4123, 0.52017, 0.6333)):
        x, h = 10.0 * i + at, (1 - d / 4) / math.sqrt(2)
        rows += [(10 * i, x, at - d), (10 * i + 1, x - d, at), (10 * i + 2, x + h, at + h)]
        rows += [(10 * i + 5, x + 5, at), (10 * i + 6, x + 5 + 1 - d, at)]
    apart = [math.dist(a[1:], b[1:]) for a, b in zip(rows[::5], rows[2::5])]
    assert all(x > 1 for x in apart)
    nodes = spark.createDataFrame(rows, "node long, x double, y double")
    got = {r.node: r.cluster for r in topology.merge_clusters(nodes, 0.5).collect()}
    for i in range(5):
        assert got[10 * i] == got[10 * i + 1] == 10 * i and 10 * i + 2 not in got
        assert got[10 * i + 5] == got[10 * i + 6] == 10 * i + 5


def test_merge_clusters_crowded(spark):
    rng = random.Random(11)
    # two crowds a little more than the reach apart, a bridge elsewhere, and scattered nodes
    spots = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(300)]
    spots += [(61 + rng.uniform(0, 5), rng.uniform(0, 10)) for _ in range(300)]
    spots += [(rng.uniform(0, 2000), rng.uniform(200, 2000)) for _ in range(150)]
    nodes = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "node long, x double, y double")
    pairs = [
        (i, j) for i in range(len(spots)) for j in range(i) if math.dist(spots[i], spots[j]) <= 50.0
    ]
    label = components_by_hand(pairs, range(len(spots)))
    sizes = {}
    for c in label.values():
        sizes[c] = sizes.get(c, 0) + 1
    want = {n: c for n, c in label.items() if sizes[c] > 1}
    got = {r["node"]: r["cluster"] for r in topology.merge_clusters(nodes, 25.0).collect()}
    assert got == want


def test_contract_chains_by_hand(spark):
    # end points 0 and 4 with a two-way chain between them, a side street at 4, and a ring 10-11-12
    pairs = [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (4, 6)]
    rows = [(k, a, b, float(k + 1)) for k, (a, b) in enumerate(pairs)]
    rows += [(k + 20, b, a, float(k + 1)) for k, (a, b) in enumerate(pairs)]
    rows += [(50, 10, 11, 1.0), (51, 11, 12, 1.0), (52, 12, 10, 1.0)]
    out, members = topology.contract_chains(edge_table(spark, rows))
    got = {(r["u"], r["v"]): (r["length"], r["pieces"]) for r in out.collect()}
    assert got[(0, 4)] == (10.0, 4) and got[(4, 0)] == (10.0, 4)
    assert got[(4, 5)] == (5.0, 1)
    assert {(10, 11), (11, 12), (12, 10)} <= set(got)
    places_in_chain = {r["edge"]: r["pos"] for r in members.where("chain = 0").collect()}
    assert places_in_chain == {0: 0, 1: 1, 2: 2, 3: 3}


def test_long_chain(spark):
    rows = [(i, i, i + 1, 1.0) for i in range(300)]
    out, _ = topology.contract_chains(edge_table(spark, rows))
    assert [(r["u"], r["v"], r["length"]) for r in out.collect()] == [(0, 300, 300.0)]


def test_clean_network_removes_interior_nodes(spark):
    nodes = spark.createDataFrame([(i, 200.0 * i, 0.0) for i in range(6)], "node long, x double, y double")
    edges = edge_table(spark, [(i, i, i + 1, 200.0) for i in range(5)])
    final, summary = topology.clean_network(nodes, edges, 10.0)
    assert {(r["u"], r["v"], r["length"]) for r in final.collect()} == {("0", "5", 1000.0), ("5", "0", 1000.0)}
    assert summary.first()["removed_pct"] == pytest.approx(60.0)


def test_networks_of_two_cities_are_changed_apart(spark):
    """Cleaning two cities with the same ids, one of them without a name, equals one run for each; components stay inside a city."""
    rng = random.Random(41)
    spots = {c: [(i, rng.uniform(0, 20), rng.uniform(0, 20)) for i in range(30)] for c in ("a", None)}
    rows = {c: random_edges(30, 36, seed) for seed, c in enumerate(spots)}
    table = lambda held, schema: spark.createDataFrame([(c, *r) for c in held for r in held[c]], f"city string, {schema}")
    nodes, edges = table(spots, "node long, x double, y double"), table(rows, "edge long, u long, v long, length double")
    final, summary = topology.clean_network(nodes, edges, 0.9, ["city"])
    here = lambda df: df.where("city IS NULL").drop("city")
    final_alone, summary_alone = topology.clean_network(here(nodes), here(edges), 0.9)
    order = ["edge", "u", "v", "length"]
    assert sorted(here(final).select(*order).collect()) == sorted(final_alone.select(*order).collect())
    assert here(summary).collect() == summary_alone.collect()
    assert final.where("city = 'a'").count() == summary.where("city = 'a'").first()["edges_after"] > 0

    label = {(c, i): i for c in spots for i in range(30)}
    for _ in range(30):
        for c in spots:
            for _, u, v, _ in rows[c]:
                label[c, u] = label[c, v] = min(label[c, u], label[c, v])
    found = topology.connected_components(edges, nodes, ["city"]).collect()
    assert {(r.city, r.node): r.label for r in found} == label


def test_largest_components_of_two_cities(spark):
    rows = [("a", 0, 1, 2), ("a", 1, 2, 1), ("a", 2, 2, 3), ("b", 0, 1, 2), ("b", 1, 2, 3), ("b", 2, 3, 1), ("b", 3, 4, 1)]
    edges = spark.createDataFrame(rows, "city string, edge long, u long, v long")
    found = topology.largest_scc(edges, ["city"]).collect()
    assert {(r.city, r.edge) for r in found} == {("a", 0), ("a", 1), ("b", 0), ("b", 1), ("b", 2)}


def test_split_long_both_ways(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 1200.0, 0.0)], "node long, x double, y double")
    edges = edge_table(spark, [(0, 1, 2, 1200.0), (1, 2, 1, 1200.0)])
    new_nodes, out = topology.split_long(edges, nodes, 500.0)
    assert {(r["node"], r["x"]) for r in new_nodes.collect()} == {("1_2_1", 500.0), ("1_2_2", 1000.0)}
    rows = {(r["u"], r["v"]): r["length"] for r in out.collect()}
    assert rows == {
        ("1", "1_2_1"): 500.0, ("1_2_1", "1_2_2"): 500.0, ("1_2_2", "2"): 200.0,
        ("1_2_1", "1"): 500.0, ("1_2_2", "1_2_1"): 500.0, ("2", "1_2_2"): 200.0,
    }


def test_split_at_crossings_crowded(spark):
    rng = random.Random(3)
    rows = [(i, *(rng.uniform(0, 1) for _ in range(4))) for i in range(60)]
    lines = spark.createDataFrame(rows, "edge long, x1 double, y1 double, x2 double, y2 double")
    counts = {r["edge"]: r["n"] for r in topology.split_at_crossings(lines, 0.3, crowd=12).groupBy("edge").agg(F.count(F.lit(1)).alias("n")).collect()}

    def cross(a, b):
        _, x1, y1, x2, y2 = a
        _, x3, y3, x4, y4 = b
        d = (x2 - x1) * (y4 - y3) - (y2 - y1) * (x4 - x3)
        t = ((x3 - x1) * (y4 - y3) - (y3 - y1) * (x4 - x3)) / d
        w = ((x3 - x1) * (y2 - y1) - (y3 - y1) * (x2 - x1)) / d
        return 0 <= t <= 1 and 0 <= w <= 1

    assert counts == {a[0]: 1 + sum(cross(a, b) for b in rows if b is not a) for a in rows}


def test_cuts_are_shuffled_once(spark):
    # all lines cross all others; small tiles are shared by many pairs that cross elsewhere
    n = 200
    rows = [(i, i / n, 0.0, 1 - i / n + 0.001 * (i % 7), 1.0) for i in range(n)]
    lines = spark.createDataFrame(rows, "edge long, x1 double, y1 double, x2 double, y2 double")
    pieces = []
    moved = shuffled_rows(spark, lambda: pieces.append(topology.split_at_crossings(lines, 0.1).count()))
    assert n * n / 2 < pieces[0] <= n * n
    assert moved < 2 * pieces[0]


def test_snap_to_edges(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 0.0), (3, 100.0, 100.0)], "node long, x double, y double")
    edges = edge_table(spark, [(0, 1, 2, 100.0), (1, 2, 3, 100.0)])
    pois = spark.createDataFrame([(7, 30.0, 10.0), (8, 60.0, -5.0), (9, 5000.0, 0.0)], "poi long, x double, y double")
    snapped, new_nodes, out = topology.snap_to_edges(pois, nodes, edges, 500.0)
    assert {(r["poi"], r["edge"], r["distance"]) for r in snapped.collect()} == {(7, 0, 10.0), (8, 0, 5.0)}
    rows = {(r["u"], r["v"]): r["length"] for r in out.collect()}
    assert rows[("1", "0@0.3")] == pytest.approx(30.0)
    assert rows[("0@0.3", "0@0.6")] == pytest.approx(30.0)
    assert rows[("poi_7", "0@0.3")] == 10.0 and rows[("0@0.3", "poi_7")] == 10.0
    assert new_nodes.count() == 3 + 2 + 2


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_with_crowds(spark, k):
    rng = random.Random(9)
    items = [(i, rng.gauss(0, 0.001), rng.gauss(0, 0.001)) for i in range(800)]
    items += [(800 + i, 5.0, 5.0) for i in range(300)]  # copies of one place
    items += [(1100 + i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(300)]
    asks = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(150)]
    asks += [(150 + i, rng.gauss(0, 0.002), rng.gauss(0, 0.002)) for i in range(100)] + [(250, 5.0, 5.0), (251, 5.0, 5.0)]
    nodes = spark.createDataFrame(items, "node long, x double, y double")
    points = spark.createDataFrame(asks, "id long, lon double, lat double")
    got = {}
    for r in nearest.k_nearest(points, nodes, k).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["node"]))
    for i, x, y in asks:
        order = sorted((math.hypot(a - x, b - y), n) for n, a, b in items)[:k]
        assert [n for _, n in sorted(got[i])] == [n for _, n in order]


def test_thin_points_equals_the_sequential_rule(spark):
    rng = random.Random(4)
    spots = [(i, rng.uniform(0, 20), rng.uniform(0, 20)) for i in range(250)]
    spots += [(250 + i, rng.uniform(3, 3.2), rng.uniform(3, 3.2)) for i in range(250)]
    kept = []
    for i, x, y in spots:
        if all(math.hypot(x - a, y - b) > 1.0 for _, a, b in kept):
            kept.append((i, x, y))
    df = spark.createDataFrame(spots, "id long, lon double, lat double")
    assert {r["id"] for r in places.thin_points(df, 0.5).collect()} == {k[0] for k in kept}


def betweenness_by_hand(rows):
    out = {}
    for _, u, v, _ in rows:
        if u != v:
            out.setdefault(u, set()).add(v)
    nodes = sorted({x for r in rows if r[1] != r[2] for x in r[1:3]})
    edge, node = {(u, v): 0.0 for u in out for v in out[u]}, dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, paths, order = {s: 0}, {s: 1.0}, [s]
        for u in order:
            for v in out.get(u, ()):
                if v not in dist:
                    dist[v], paths[v] = dist[u] + 1, 0.0
                    order.append(v)
                if dist[v] == dist[u] + 1:
                    paths[v] += paths[u]
        owed = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for u in order:
                if w in out.get(u, ()) and dist[w] == dist[u] + 1:
                    c = paths[u] / paths[w] * (1 + owed[w])
                    edge[(u, w)] += c
                    owed[u] += c
            if w != s:
                node[w] += owed[w]
    n = len(nodes)
    return {e: c / (n * (n - 1)) for e, c in edge.items()}, {v: c / ((n - 1) * (n - 2)) for v, c in node.items()}


def test_betweenness(spark):
    rows = random_edges(25, 60, 6)
    edges = edge_table(spark, rows)
    by_edge, by_node = betweenness_by_hand(rows)
    got = {(r["u"], r["v"]): r["centrality"] for r in centrality.betweenness(edges).collect()}
    assert got == pytest.approx(by_edge)
    got = {r["node"]: r["centrality"] for r in centrality.betweenness(edges, "node").collect()}
    assert got == pytest.approx(by_node)


@pytest.mark.parametrize("kind", ["edge", "node"])
def test_betweenness_in_blocks_of_sources(spark, kind):
    rows = random_edges(14, 34, 12)
    edges = edge_table(spark, rows)
    whole = {tuple(r)[:-2]: tuple(r)[-2:] for r in centrality.betweenness(edges, kind).collect()}
    parts = {tuple(r)[:-2]: tuple(r)[-2:] for r in centrality.betweenness(edges, kind, block_rows=100).collect()}
    assert whole.keys() == parts.keys()
    assert all(parts[k] == pytest.approx(v) for k, v in whole.items())
    assert not [t for t in spark.catalog.listTables() if "betweenness" in t.name]


@pytest.mark.parametrize("kind", ["edge", "node"])
def test_betweenness_keeps_a_row_for_each_node_and_chunk_of_sources(spark, kind, monkeypatch):
    rows = random_edges(40, 160, 5)
    sizes, cut = [], centrality.Rounds.cut

    def counted(self, df):
        out = cut(self, df)
        sizes.append(out.where("score is null" if "score" in out.columns else "true").count())
        return out

    monkeypatch.setattr(centrality.Rounds, "cut", counted)
    monkeypatch.setattr(centrality, "CHUNK", 16)
    edges = edge_table(spark, rows)
    got = {r[0] if kind == "node" else (r[0], r[1]): r["centrality"] for r in centrality.betweenness(edges, kind).collect()}
    assert got == pytest.approx(betweenness_by_hand(rows)[kind == "node"])
    # 40 sources are three chunks; a row for each source and node would be 1600
    assert max(sizes) <= 3 * 40


@pytest.mark.parametrize("kind", ["edge", "node"])
def test_betweenness_of_a_long_ring_takes_few_tables(spark, kind, monkeypatch):
    # a ring one way has as many levels as nodes; a second component has other places
    rows = [(i, i, (i + 1) % 40, 1.0) for i in range(40)] + [(100 + i, 90 - i, 89 - i, 1.0) for i in range(5)] + [(200, 88, 86, 1.0), (201, 3, 3, 1.0)]
    tables, cut = [], centrality.Rounds.cut
    monkeypatch.setattr(centrality.Rounds, "cut", lambda self, df: tables.append(1) or cut(self, df))
    monkeypatch.setattr(centrality, "TASK_REACH", 300)
    edges = edge_table(spark, rows)
    got = {r[0] if kind == "node" else (r[0], r[1]): r["centrality"] for r in centrality.betweenness(edges, kind).collect()}
    assert got == pytest.approx(betweenness_by_hand(rows)[kind == "node"])
    assert len(tables) <= 4


@pytest.mark.parametrize("kind", ["edge", "node"])
def test_betweenness_of_more_links_than_a_task_holds(spark, kind, monkeypatch):
    monkeypatch.setattr(centrality, "TASK_LINKS", 0)
    monkeypatch.setattr(centrality, "CHUNK", 4)
    rows = random_edges(11, 26, 9) + [(50, 2, 30, 1.0), (51, 30, 31, 1.0)]
    plans, blocks = [], centrality._block_scores

    def planned(*x):
        finish = centrality.Rounds.finish
        monkeypatch.setattr(centrality.Rounds, "finish", lambda self, df: plans.append(df._jdf.queryExecution().analyzed().toString()) or finish(self, df))
        out = blocks(*x)
        monkeypatch.setattr(centrality.Rounds, "finish", finish)
        return out

    monkeypatch.setattr(centrality, "_block_scores", planned)
    got = {r[0] if kind == "node" else (r[0], r[1]): r["centrality"] for r in centrality.betweenness(edge_table(spark, rows), kind, block_rows=70).collect()}
    assert got == pytest.approx(betweenness_by_hand(rows)[kind == "node"])
    # levels are read together, not one by one
    assert len(plans) > 1 and not any("Union" in p for p in plans)


def test_betweenness_sampled_sources(spark):
    edges = edge_table(spark, random_edges(25, 60, 6))
    once = {(r["u"], r["v"]): r["centrality"] for r in centrality.betweenness(edges, sources=10, seed=1).collect()}
    again = {(r["u"], r["v"]): r["centrality"] for r in centrality.betweenness(edges, sources=10, seed=1).collect()}
    assert once == again and any(once.values())
    with pytest.raises(ValueError):
        centrality.betweenness(edges, "node", sources=10)


def test_several_choices_a_job_are_the_choices_one_by_one(spark, monkeypatch):
    rng = random.Random(44)
    weight = {o: float(rng.randint(0, 6)) for o in range(300)}
    reach_of = {d: {rng.randrange(300) for _ in range(rng.choice([2, 8, 30]))} for d in range(70)}
    od = spark.createDataFrame([(o, d, 1.0) for d, held in reach_of.items() for o in held], "o long, d long, cost double")
    origins = spark.createDataFrame([(o,) for o in weight], "o long")
    weights = spark.createDataFrame(list(weight.items()), "o long, weight double")
    jobs = []
    overlaps = facility._overlaps
    monkeypatch.setattr(facility, "_overlaps", lambda *x: jobs.append(1) or overlaps(*x))
    got = [(r.d, r.gain) for r in facility.greedy_cover(od, origins, 40, 2.0, weights, forced=[3, 99, 3]).collect()]
    open_to, want = {d: set(held) for d, held in reach_of.items()}, []
    for step in range(40):
        gains = {d: sum(weight[o] for o in held) for d, held in open_to.items() if held}
        if step < 3:
            pick = (3, 99, 3)[step]
        elif gains:
            pick = min(gains, key=lambda d: (-gains[d], d))
        else:
            break
        want.append((pick, gains.get(pick, 0.0)))
        served = set(open_to.get(pick, ()))
        open_to = {d: held - served for d, held in open_to.items()}
    assert got == want and len(jobs) <= len(want) / 3


def test_choices_of_the_driver_are_those_of_jobs(spark, monkeypatch):
    rng = random.Random(45)
    # ids whose order as text is not that of their numbers, and many equal gains
    od = spark.createDataFrame([(o, f"f{d}", 1.0 + (o + d) % 3) for d in range(60) for o in {rng.randrange(200) for _ in range(rng.choice([1, 4, 9]))}], "o long, d string, cost double")
    origins = spark.createDataFrame([(o,) for o in range(210)], "o long")
    weights = spark.createDataFrame([(o, float(rng.randint(0, 2))) for o in range(0, 200, 1)], "o long, weight double")
    jobs, overlaps = [], facility._overlaps
    monkeypatch.setattr(facility, "_overlaps", lambda *x: jobs.append(1) or overlaps(*x))

    def choices():
        return [
            facility.greedy_cover(od, origins, None, 2.0, share=0.7).collect(),
            facility.greedy_cover(od, origins, 50, 3.0, weights, forced=["f7", "f59", "none", "f7"], share=2.0).collect(),
            facility.greedy_cover(od.limit(0), origins, None, 2.0, share=0.7).collect(),
        ]

    at_once = choices()
    assert not jobs
    monkeypatch.setattr(facility, "DRIVER_LINKS", -1)
    assert at_once == choices() and jobs and len(at_once[0]) > 12


def test_greedy_facilities(spark):
    rows = [(o, d, float(abs(o - d))) for o in range(12) for d in range(0, 12, 3)]
    od = spark.createDataFrame(rows, "o long, d long, cost double")
    origins = spark.range(14).withColumnRenamed("id", "o")
    chosen = facility.greedy_cover(od, origins, 3, 1.0).collect()
    covered = set()
    for step in chosen:
        gains = {d: len({o for o, e, c in rows if e == d and c <= 1} - covered) for d in range(0, 12, 3)}
        best = max(gains.values())
        assert step["gain"] == best and step["d"] == min(d for d, g in gains.items() if g == best)
        covered |= {o for o, e, c in rows if e == step["d"] and c <= 1}
    assert [r["covered"] for r in chosen] == sorted(r["covered"] for r in chosen)
    first = facility.greedy_cover(od, origins, 2, 1.0, forced=[9]).first()
    assert first["d"] == 9
    median = facility.greedy_median(od, origins, 2, fail=100.0).collect()
    # origins 12 and 13 have no route and cost the fail value
    options = {d: sum(abs(o - d) for o in range(12)) + 200 for d in range(0, 12, 3)}
    assert median[0]["total_cost"] == min(options.values())
    assert median[1]["total_cost"] <= median[0]["total_cost"]
    with pytest.raises(ValueError):
        facility.greedy_median(od, origins, 9)


def test_origins_without_a_route(spark):
    od = spark.createDataFrame([(1, 10, 5.0), (2, 10, 7.0), (3, 11, 1.0), (4, 11, 2.0)], "o long, d long, cost double")
    origins = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5)], "o long")
    pick = lambda d: spark.createDataFrame([(d,)], "d long")
    cost = {d: tuple(facility.median_cost(od, origins, pick(d), 100.0).first()) for d in (10, 11, 12)}
    assert cost == {10: (312.0, 5, 3), 11: (303.0, 5, 3), 12: (500.0, 5, 5)}
    weights = spark.createDataFrame([(1, 2), (5, 3)], "o long, weight int")
    assert facility.median_cost(od, origins, pick(10), 100.0, weights).first()["total_cost"] == 310.0
    assert tuple(facility.coverage(od, origins, 6.0).first()) == (5.0, 3.0, 60.0)
    assert tuple(facility.coverage(od, origins, 6.0, pick(10), weights).first()) == (5.0, 2.0, 40.0)
    steps = facility.greedy_cover(od, origins, None, 10.0, share=1.0).collect()
    assert [(s["d"], s["percent"]) for s in steps] == [(10, 40.0), (11, 80.0)]


def test_random_disruption(spark):
    # both directions share a street id; streets 0 to 9 all join the same two nodes
    rows = [(i, i % 100, 0, 1, 1.0) if i % 100 < 10 else (i, i % 100, i % 100, i % 100 + 1, 1.0) for i in range(200)]
    edges = spark.createDataFrame(rows, "edge long, street long, u long, v long, length double").withColumn("time", F.lit(1.0))
    out = graph.disrupt_random(edges, 10, 9.0, seed=3, street="street").collect()
    assert len(out) == 200
    assert len({r["street"] for r in out if r["disrupted"]}) == 10 and sum(r["disrupted"] for r in out) == 20
    assert all(r["time"] == (9.0 if r["disrupted"] else 1.0) for r in out)
    again = graph.disrupt_random(edges, 10, 9.0, seed=4, street="street").collect()
    assert {r["street"] for r in again if r["disrupted"]} != {r["street"] for r in out if r["disrupted"]}


def test_fill_holes(spark):
    picture = [
        "#######..###",
        "#.....#..#.#",
        "#.###.#..#.#",
        "#.#.#.#..###",
        "#.###.#.....",
        "#.....#.##..",
        "####.##.##..",
    ]
    cells = [(x, y) for y, row in enumerate(picture) for x, c in enumerate(row) if c == "#"]
    width, height = len(picture[0]), len(picture)
    outside, todo = set(), [(-1, -1)]
    while todo:
        x, y = todo.pop()
        if (x, y) in outside or (x, y) in cells or not (-1 <= x <= width and -1 <= y <= height):
            continue
        outside.add((x, y))
        todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
    want = {(x, y) for x in range(width) for y in range(height) if (x, y) not in outside}
    df = spark.createDataFrame(cells, "x int, y int")
    assert {(r["x"], r["y"]) for r in shapes.fill_holes(df).collect()} == want


def test_footprint_of_a_point(spark):
    df = spark.createDataFrame([(5.0, 5.0, 5.0, 5.0)], "x1 double, y1 double, x2 double, y2 double")
    got = {(r["x"], r["y"]) for r in shapes.footprint(df, 2.0, Grid(0, 0, 1, 1)).collect()}
    want = {(x, y) for x in range(12) for y in range(12) if math.hypot(x + 0.5 - 5, y + 0.5 - 5) <= 2}
    assert got == want


def test_density_by_group(spark):
    rng = random.Random(2)
    rows = [("a", rng.gauss(0, 1), rng.gauss(0, 2)) for _ in range(200)] + [("b", rng.gauss(5, 3), rng.gauss(1, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "city string, x double, y double")
    both = {(r["city"], r["x"], r["y"]): r["value"] for r in shapes.density(df, 12, by=("city",)).collect()}
    assert len(both) == 2 * 144
    for city in "ab":
        alone = shapes.density(df.where(F.col("city") == city), 12).collect()
        for r in alone:
            assert both[(city, r["x"], r["y"])] == pytest.approx(r["value"], abs=1e-9)
        assert {0.0, 1.0} <= {r["value"] for r in alone}


def broadcast_tables(df):
    """Parts of the physical plan that are sent to every task, as text."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastExchange" in line]


def test_nodes_of_zones_are_not_broadcast(spark):
    # a plan expects few bytes of these nodes, as of any table whose rows are repeated for each network
    roads = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("road")
    nodes = spark.range(60).select(F.col("id").alias("node"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"), roads)
    edges = spark.range(59).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"), F.lit(1.0).alias("length"), roads)
    origins = nodes.where("node = 0").select("road", F.lit("k").alias("category"), "node")
    out = accessibility.isochrone_footprints(edges, nodes, origins, [4], 0.5, Grid(0.0, 0.0, 1.0, 1.0), by=["road"])
    assert not broadcast_tables(out)
    assert out.where("road = 'b'").count() == 8

    left, right = spark.range(10).withColumn("a", F.lit(1)), spark.range(10).withColumn("b", F.lit(2))
    plain, dealt = (crowded_join(left, right, ["id"], F.lit(True), deal=deal) for deal in (False, True))
    assert len(broadcast_tables(plain)) > len(broadcast_tables(dealt))
    assert dealt.count() == 10


def test_two_cities_equal_two_runs(spark):
    a, b = random_edges(12, 30, 1), random_edges(17, 45, 2)
    tables = {c: edge_table(spark, rows).withColumn("city", F.lit(c)) for c, rows in (("a", a), ("b", b))}
    both = tables["a"].unionByName(tables["b"])
    for kind, keys in (("edge", ["u", "v"]), ("node", ["node"])):
        joined = centrality.betweenness(both, kind, by=["city"]).collect()
        for city, edges in tables.items():
            alone = {tuple(r[k] for k in keys): (r["centrality"], r["mean_centrality"]) for r in centrality.betweenness(edges, kind).collect()}
            mine = {tuple(r[k] for k in keys): (r["centrality"], r["mean_centrality"]) for r in joined if r["city"] == city}
            assert set(mine) == set(alone)
            assert all(mine[k] == pytest.approx(alone[k]) for k in alone)
    ends = spark.createDataFrame([(c, i) for c in "ab" for i in (0, 3, 5)], "city string, node long")
    joined = reach.od_costs(both, ends, ends, 50.0, by=["city"]).collect()
    for city, edges in tables.items():
        mine = ends.where(F.col("city") == city).select("node")
        alone = {(r["o"], r["d"], r["cost"]) for r in reach.od_costs(edges, mine, mine, 50.0).collect()}
        assert alone == {(r["o"], r["d"], r["cost"]) for r in joined if r["city"] == city}


def test_exposure_on_two_grids(spark):
    from citygrain.operators import exposure

    hazard = spark.createDataFrame([("c", x, y, 1.0) for x in range(4) for y in range(4)] + [("e", 0, 0, 1.0)], "city string, x int, y int, value double")
    # settled cells are twice as wide and shifted by a cell
    settled = spark.createDataFrame([("c", 0, 0, 1990), ("c", 1, 1, 1992), ("c", 9, 9, 1990)], "city string, x int, y int, value int")
    out = exposure.exposure_by_year(
        hazard, settled, Grid(0, 0, 100, 100), range(1990, 1993), scale=1e-6, settlement_grid=Grid(100, 0, 200, 200)
    )
    got = {(r["city"], r["year"]): round(r["cumulative_area"], 6) for r in out.collect()}
    assert got == {("c", 1990): 0.04, ("c", 1991): 0.04, ("c", 1992): 0.06, ("e", 1990): 0.0, ("e", 1991): 0.0, ("e", 1992): 0.0}
    people = settled.withColumn("value", F.when(F.col("x") == 0, 9.0).otherwise(1.0))
    share = exposure.exposed_dense_share(hazard.where("city = 'c'"), people, 0.9, grid=Grid(0, 0, 1, 1), population_grid=Grid(1, 0, 2, 2)).first()
    assert (share["dense_cells"], share["exposed_pct"]) == (4, 100.0)


def test_road_assessment_by_city(spark):
    """The tables of two cities equal those of one run for each; parallel edges share their score."""
    nodes = [(c, i, 0.1 * i, 0.01 * i * i) for c in "ab" for i in range(5)]
    streets = [("a", 0, 1), ("a", 1, 2), ("a", 1, 2), ("a", 2, 0), ("a", 2, 3), ("b", 0, 1), ("b", 1, 3), ("b", 3, 4), ("b", 4, 4)]
    rows = [(c, i, u, v, 100.0 + i, ["primary" if i % 2 else "service"]) for i, (c, u, v) in enumerate(streets)]
    nodes = spark.createDataFrame(nodes, "city string, node long, x double, y double")
    edges = spark.createDataFrame(rows, "city string, edge long, u long, v long, length double, highway array<string>")
    both = roads.assess(nodes, edges)
    # paths a: 0-1, 0-2, 0-3, 1-2, 1-0, 1-3, 2-0, 2-3, 2-1
    scores = {r.edge: r.edge_centrality for r in both.edges.collect()}
    assert scores[0] == pytest.approx(100 * 4 / 12) and scores[1] == scores[2] == pytest.approx(100 * 5 / 12)
    assert scores[8] is None and scores[6] == pytest.approx(100 * 4 / 12)
    assert {r.edge: r.road_type for r in both.edges.collect()} == {i: "Primary" if i % 2 else "Secondary" for i in range(9)}
    alone = roads.assess(nodes.where("city = 'b'").drop("city"), edges.where("city = 'b'").drop("city"), ())
    flat = lambda df: sorted(repr([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())
    for one, all_cities in zip(alone, both):
        assert flat(one) == flat(all_cities.where("city = 'b'").select(*one.columns))
