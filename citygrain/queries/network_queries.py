"""Queries on street graphs, reach, origin-destination tables and facilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from citygrain.grid import Grid
from citygrain.operators import centrality, facility, graph, reach, shapes, spatial, topology
from citygrain.plans import accessibility, roads
from citygrain.queries.registry import query

SPEED_CASE = "CASE road WHEN 'motorway' THEN 50 WHEN 'primary' THEN 40 WHEN 'secondary' THEN 30 ELSE 20 END"
TIMED = f"(SELECT *, length / 1000 / {SPEED_CASE} * 3600 AS time FROM streets)"


def timed(t):
    return graph.travel_time(t.streets())


# graph tables ---------------------------------------------------------------------------


@query(
    "ways_to_edges",
    """WITH s AS (SELECT l_orderkey AS way, l_suppkey AS node, row_number() OVER w AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n,
      count(*) OVER (PARTITION BY l_suppkey) AS uses_any, lead(l_suppkey) OVER w AS next FROM lineitem
      WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
    u AS (SELECT node, count(*) AS uses FROM s WHERE n >= 2 GROUP BY node),
    c AS (SELECT s.*, CASE WHEN pos > 1 AND pos < n AND uses > 1 THEN 1 ELSE 0 END AS cut FROM s JOIN u USING (node) WHERE n >= 2),
    p AS (SELECT way, node AS u, next AS v, cast(sum(cut) OVER (PARTITION BY way ORDER BY pos) as int) AS piece,
      o_orderstatus = 'P' AS oneway FROM c JOIN orders ON o_orderkey = way),
    d AS (SELECT way, piece, u, v, false AS reverse FROM p WHERE v IS NOT NULL UNION ALL
      SELECT way, piece, v, u, true FROM p WHERE v IS NOT NULL AND NOT oneway)
    SELECT way, piece, u, v, reverse, round(asin(sqrt(sin(radians(b.cy - a.cy) / 2) ** 2 + cos(radians(a.cy)) * cos(radians(b.cy))
      * sin(radians(b.cx - a.cx) / 2) ** 2)) * 2 * 6371000.0::double, 3) AS length
    FROM d JOIN zones a ON a.zone = u JOIN zones b ON b.zone = v""",
)
def ways_to_edges(t):
    nds = F.transform(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda r: r["l_suppkey"]
    )
    ways = t.read("lineitem").groupBy(F.col("l_orderkey").alias("way")).agg(nds.alias("nds"))
    status = t.read("orders").select(
        F.col("o_orderkey").alias("way"), F.lit("road").alias("highway"), (F.col("o_orderstatus") == "P").alias("oneway")
    )
    nodes = t.zones().select(F.col("zone").alias("node"), F.col("cx").alias("lon"), F.col("cy").alias("lat"))
    out = topology.ways_to_edges(ways.join(status, "way"), nodes)
    return out.select("way", "piece", "u", "v", "reverse", F.round("length", 3).alias("length"))


@query(
    "single_edge_table",
    """SELECT edge, u, v, NOT EXISTS (SELECT 1 FROM streets r WHERE r.u = s.v AND r.v = s.u) AS oneway,
      round(a.x, 6) AS x1, round(b.y, 6) AS y2 FROM streets s JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v
    WHERE u <= v OR NOT EXISTS (SELECT 1 FROM streets r WHERE r.u = s.v AND r.v = s.u)""",
)
def single_edge_table(t):
    out = graph.graph_tables(t.nodes(), t.streets(), True)
    return out.select(
        "edge", "u", "v", "oneway",
        F.round(F.col("line")[0]["x"], 6).alias("x1"), F.round(F.col("line")[1]["y"], 6).alias("y2"),
    )


@query(
    "unused_nodes",
    """SELECT c_custkey AS node, road FROM customer, (SELECT DISTINCT road FROM streets) r WHERE NOT EXISTS
    (SELECT 1 FROM streets s WHERE s.road = r.road AND (u = c_custkey OR v = c_custkey))""",
)
def unused_nodes(t):
    """Nodes that no street of a class touches, for every class."""
    streets = t.streets().select("u", "v", F.element_at("highway", 1).alias("road"))
    classes = F.array(*[F.lit(c) for c in ("motorway", "primary", "secondary", "residential", "track")])
    every = t.nodes().select("node", F.explode(classes).alias("road"))
    return graph.unused_nodes(every, streets, ["road"])


@query(
    "reflected_edges",
    """SELECT edge, u, v, false AS reflected FROM streets UNION ALL SELECT edge, v, u, true FROM streets WHERE NOT oneway""",
)
def reflected_edges(t):
    _, edges = graph.build_graph(t.nodes(), t.streets(), "oneway")
    return edges.select("edge", "u", "v", "reflected")


@query(
    "missing_reflections",
    """SELECT edge, u, v, false AS reflected FROM streets UNION ALL SELECT edge, v, u, true FROM streets s
    WHERE NOT EXISTS (SELECT 1 FROM streets r WHERE r.u = s.v AND r.v = s.u)""",
)
def missing_reflections(t):
    return graph.reflect_edges(t.streets(), only_missing=True).select("edge", "u", "v", "reflected")


@query(
    "composed_nodes",
    """SELECT node, coalesce(s_acctbal, weight) AS weight, s_suppkey IS NOT NULL AS extra FROM
    (SELECT node, weight FROM nodes UNION SELECT s_suppkey + 10, NULL FROM supplier WHERE s_suppkey + 10 NOT IN (SELECT node FROM nodes)) n
    LEFT JOIN supplier ON s_suppkey + 10 = node""",
)
def composed_nodes(t):
    second = t.read("supplier").select(
        (F.col("s_suppkey") + 10).alias("node"), F.col("s_acctbal").alias("weight"), F.lit(True).alias("extra")
    )
    first = t.nodes().select("node", "weight", F.lit(False).alias("extra"))
    return graph.compose_graphs([first, second], ["node"])


@query("drive_times", f"SELECT edge, round(time, 6) AS time FROM {TIMED}")
def drive_times(t):
    return timed(t).select("edge", F.round("time", 6).alias("time"))


@query("walk_times", "SELECT edge, round(length / 1000 / 4.5 * 3600, 6) AS time FROM streets")
def walk_times(t):
    return graph.travel_time(t.streets(), "walk").select("edge", F.round("time", 6).alias("time"))


@query(
    "intersection_delays",
    f"""WITH e AS (SELECT *, CASE road WHEN 'motorway' THEN 1 WHEN 'primary' THEN 2 WHEN 'secondary' THEN 3 ELSE 5 END AS rank FROM {TIMED}),
    deg AS (SELECT node FROM (SELECT u AS node FROM streets UNION ALL SELECT v FROM streets) GROUP BY node HAVING count(*) > 2),
    p AS (SELECT u, v, arg_max(rank, edge) AS rank FROM e GROUP BY u, v),
    b AS (SELECT v, min(rank) AS best FROM p WHERE v IN (SELECT node FROM deg) GROUP BY v),
    s AS (SELECT b.v, best, count(*) AS sharing FROM b JOIN p ON p.v = b.v AND p.rank = best GROUP BY ALL)
    SELECT e.edge, round(time + CASE WHEN s.v IS NULL OR road = 'motorway' OR (sharing <= 2 AND p.rank = best) THEN 0 ELSE 7 END, 6) AS time
    FROM e JOIN p ON p.u = e.u AND p.v = e.v LEFT JOIN s ON s.v = e.v""",
)
def intersection_delays(t):
    return graph.intersection_delay(timed(t)).select("edge", F.round("time", 6).alias("time"))


@query("length_by_road_class", "SELECT road, sum(length) AS length FROM streets GROUP BY road")
def length_by_road_class(t):
    return graph.length_by_class(t.streets())


@query(
    "network_mean_speed",
    f"SELECT round(sum(length) / 1000 / (sum(time) / 3600), 6) AS mean_speed_kmh FROM {TIMED}",
)
def network_mean_speed(t):
    return graph.mean_speed(timed(t)).select(F.round("mean_speed_kmh", 6).alias("mean_speed_kmh"))


@query("accepted_roads", "SELECT edge FROM streets WHERE road IN ('primary', 'secondary', 'motorway')")
def accepted_roads(t):
    return graph.filter_classes(t.streets()).select("edge")


@query(
    "disrupted_network",
    f"""WITH b AS (SELECT node FROM nodes WHERE weight > 8000)
    SELECT edge, u IN (SELECT node FROM b) OR v IN (SELECT node FROM b) AS disrupted,
      round(CASE WHEN u IN (SELECT node FROM b) OR v IN (SELECT node FROM b) THEN 99999 ELSE time END, 6) AS time FROM {TIMED}""",
)
def disrupted_network(t):
    out = graph.disrupt(timed(t), t.nodes(), "weight", 8000, 99999)
    return out.select("edge", "disrupted", F.round("time", 6).alias("time"))


@query(
    "randomly_disrupted_network",
    f"""WITH r AS (SELECT edge, time, row_number() OVER (ORDER BY md5('7 ' || edge), edge) - 1 AS rank FROM {TIMED})
    SELECT edge, rank < floor((SELECT count(*) FROM r) / 2.0 * 0.05::double) AS disrupted,
      round(CASE WHEN rank < floor((SELECT count(*) FROM r) / 2.0 * 0.05::double) THEN 99999 ELSE time END, 6) AS time FROM r""",
)
def randomly_disrupted_network(t):
    out = graph.disrupt_random(timed(t), 5, 99999, seed=7)
    return out.select("edge", "disrupted", F.round("time", 6).alias("time"))


@query(
    "near_duplicate_edges_dropped",
    """WITH g AS (SELECT u, v, min(edge) AS first, max(length) / min(length) AS ratio FROM streets GROUP BY u, v)
    SELECT edge FROM streets JOIN g USING (u, v) WHERE ratio >= 1.5 OR edge = first""",
)
def near_duplicate_edges_dropped(t):
    return graph.drop_parallel(t.streets()).select("edge")


@query(
    "joined_networks",
    """WITH s AS (SELECT s_suppkey, (s_suppkey * 7 % 40) * 0.01::double + 0.001 AS x, floor(s_suppkey / 3.0) * 0.01::double + 0.002 AS y FROM supplier),
    d AS (SELECT s_suppkey, node, sqrt((s.x - n.x) ** 2 + (s.y - n.y) ** 2) AS d FROM s, nodes n),
    g AS (SELECT s_suppkey, arg_min(node, (d, node)) AS node, min(d) AS d FROM d GROUP BY s_suppkey HAVING min(d) < 0.004),
    e AS (SELECT cast(u as varchar) AS u, cast(v as varchar) AS v, length, 'base' AS kind FROM streets
      UNION ALL SELECT 'add_net_' || u, 'add_net_' || v, length, 'new' FROM links
      UNION ALL SELECT 'add_net_' || s_suppkey, cast(node as varchar), d / 1000, 'net_glue' FROM g
      UNION ALL SELECT cast(node as varchar), 'add_net_' || s_suppkey, d / 1000, 'net_glue' FROM g),
    i AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS id FROM (SELECT cast(node as varchar) AS label FROM nodes
      UNION SELECT 'add_net_' || s_suppkey FROM s))
    SELECT a.id AS u, b.id AS v, kind, round(length, 9) AS length FROM e JOIN i a ON a.label = u JOIN i b ON b.label = v""",
)
def joined_networks(t):
    k = F.col("s_suppkey")
    extra = t.read("supplier").select(
        k.alias("node"), ((k * 7 % 40) * 0.01 + 0.001).alias("x"), (F.floor(k / 3.0) * 0.01 + 0.002).alias("y")
    )
    base = t.nodes().select("node", "x", "y")
    _, edges = graph.join_networks(base, t.streets().select("u", "v", "length"), extra, t.links(), 0.004)
    return edges.select(
        F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"), "kind", F.round("length", 9).alias("length")
    )


@query(
    "bearing_rose",
    """WITH s AS (SELECT a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2 FROM streets JOIN points a ON a.id = u JOIN points b ON b.id = v),
    a AS (SELECT (degrees(atan2(sin(radians(x2 - x1)) * cos(radians(y2)), cos(radians(y1)) * sin(radians(y2))
      - sin(radians(y1)) * cos(radians(y2)) * cos(radians(x2 - x1)))) + 365) % 360 AS b FROM s),
    c AS (SELECT cast(floor(b / 10) as int) AS sector, count(*) AS n FROM a GROUP BY ALL)
    SELECT cast(k as int) AS sector, coalesce(n, 0) AS count, round(coalesce(n, 0) / (SELECT count(*) FROM a), 8) AS frequency
    FROM (SELECT unnest(range(0, 36)) AS k) LEFT JOIN c ON sector = k""",
)
def bearing_rose(t):
    p = t.points()
    a = p.select(F.col("id").alias("u"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    b = p.select(F.col("id").alias("v"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    out = graph.bearing_rose(t.streets().join(a, "u").join(b, "v"))
    return out.withColumn("frequency", F.round("frequency", 8))


@query(
    "major_roads",
    """SELECT edge, 'Primary' AS road_type, round(length * 100, 6) AS edge_centrality FROM streets WHERE road IN ('motorway', 'primary')""",
)
def major_roads(t):
    major = graph.major_roads(t.streets()).withColumn("edge_centrality", F.col("length"))
    out = graph.road_type(major)
    return out.select("edge", "road_type", F.round("edge_centrality", 6).alias("edge_centrality"))


@query(
    "external_travel_times",
    f"""WITH g AS (SELECT u, v, min(length) * 2 AS given FROM links GROUP BY ALL)
    SELECT edge, given IS NOT NULL AS matched, round(coalesce(given, time), 6) AS time FROM {TIMED} s LEFT JOIN g USING (u, v)""",
)
def external_travel_times(t):
    times = t.links().select("u", "v", (F.col("length") * 2).alias("time"))
    return graph.attach_times(timed(t), times).select("edge", "matched", F.round("time", 6).alias("time"))


@query(
    "network_statistics",
    """WITH s AS (SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b FROM streets),
    e AS (SELECT node, count(*) AS k FROM (SELECT a AS node FROM s UNION ALL SELECT b FROM s) GROUP BY node)
    SELECT (SELECT count(*) FROM nodes) AS n, (SELECT count(*) FROM streets) AS m, (SELECT sum(length) FROM streets) AS length_total,
      (SELECT round(avg(length), 6) FROM streets) AS length_mean, (SELECT count(*) FROM e WHERE k > 1) AS intersections,
      round((SELECT sum(k) FROM e) / (SELECT count(*) FROM nodes), 6)::double AS streets_per_node,
      round((SELECT count(*) FROM streets) * 2 / (SELECT count(*) FROM nodes), 6)::double AS degree_mean""",
)
def network_statistics(t):
    out = graph.network_stats(t.nodes(), t.streets())
    return out.select(
        "n", "m", "length_total", F.round("length_mean", 6).alias("length_mean"), "intersections",
        F.round("streets_per_node", 6).alias("streets_per_node"), F.round("degree_mean", 6).alias("degree_mean"),
    )


@query(
    "long_edges_split",
    """WITH s AS (SELECT s.edge, s.u, s.v, s.length, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) * 100000 AS len FROM streets s
      JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v),
    n AS (SELECT *, CASE WHEN len > 300 THEN cast(ceil(len / 300) as int) ELSE 1 END AS n FROM s),
    p AS (SELECT *, unnest(range(1, n + 1)) AS k FROM n)
    SELECT edge, cast(k as int) AS piece, CASE WHEN u > v THEN hi ELSE lo END AS u, CASE WHEN u > v THEN lo ELSE hi END AS v,
      round(length * (CASE WHEN k < n THEN 300 ELSE len - (n - 1) * 300 END) / len, 5) AS length FROM
    (SELECT *, CASE WHEN k = 1 THEN cast(least(u, v) as varchar) ELSE least(u, v) || '_' || greatest(u, v) || '_' || (k - 1) END AS lo,
      CASE WHEN k = n THEN cast(greatest(u, v) as varchar) ELSE least(u, v) || '_' || greatest(u, v) || '_' || k END AS hi FROM p)""",
)
def long_edges_split(t):
    nodes = t.nodes().select("node", (F.col("x") * 100000).alias("x"), (F.col("y") * 100000).alias("y"))
    _, edges = topology.split_long(t.streets(), nodes, 300.0)
    return edges.withColumn("length", F.round("length", 5))


@query(
    "largest_strong_component",
    """WITH RECURSIVE e AS MATERIALIZED (SELECT l_orderkey AS u, (l_partkey * 7919 + l_suppkey * 104729) % (SELECT count(*) FROM orders) AS v FROM lineitem),
    -- components of the ten best-connected nodes, by what each reaches and what reaches it; the largest counts
    hub AS MATERIALIZED (SELECT h FROM (SELECT u AS h, count(*) AS a FROM e GROUP BY u) JOIN (SELECT v AS h, count(*) AS b FROM e GROUP BY v) USING (h)
      ORDER BY a * b DESC, h LIMIT 10),
    f(h, n) AS (SELECT h, h FROM hub UNION SELECT h, v FROM f JOIN e ON e.u = f.n),
    b(h, n) AS (SELECT h, h FROM hub UNION SELECT h, e.u FROM b JOIN e ON e.v = b.n),
    c AS MATERIALIZED (SELECT h, n FROM f JOIN b USING (h, n)),
    m AS MATERIALIZED (SELECT n FROM c WHERE h = (SELECT h FROM c GROUP BY h ORDER BY count(*) DESC, h LIMIT 1))
    SELECT u, v FROM e WHERE u IN (SELECT n FROM m) AND v IN (SELECT n FROM m)""",
)
def largest_strong_component(t):
    """Edges of the largest strongly connected component of a network of order and part links."""
    total = t.read("orders").agg(F.count(F.lit(1)).alias("n"))
    edges = t.read("lineitem").select(
        F.col("l_orderkey").alias("u"),
        ((F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729) % total.scalar()).alias("v"),
    )
    return topology.largest_scc(edges)


@query(
    "merged_junctions",
    """WITH RECURSIVE near AS (SELECT a.id AS u, b.id AS v FROM points a JOIN points b ON a.id <> b.id AND abs(a.lon - b.lon) <= 1.6
      AND abs(a.lat - b.lat) <= 1.6 AND sqrt((a.lon - b.lon) ** 2 + (a.lat - b.lat) ** 2) <= 1.6),
    cc(node, label) USING KEY (node) AS (SELECT id, id FROM points UNION SELECT v, min(label) FROM (SELECT near.v, cc.label FROM cc JOIN near ON near.u = cc.node) n
      WHERE label < (SELECT k.label FROM recurring.cc k WHERE k.node = n.v) GROUP BY v),
    big AS (SELECT label FROM cc GROUP BY label HAVING count(*) > 1),
    m AS (SELECT node, 'c' || label AS c FROM cc WHERE label IN (SELECT label FROM big))
    SELECT edge, coalesce(a.c, cast(u as varchar)) AS u, coalesce(b.c, cast(v as varchar)) AS v,
      cast((a.c IS NOT NULL)::int + (b.c IS NOT NULL)::int as int) AS ends_moved
    FROM streets LEFT JOIN m a ON a.node = u LEFT JOIN m b ON b.node = v WHERE a.c IS NULL OR b.c IS NULL OR a.c <> b.c""",
)
def merged_junctions(t):
    """Customers' places closer than 3 degrees chained into clusters."""
    nodes = t.points().select(F.col("id").alias("node"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    edges = t.streets().select("edge", "u", "v", "length")
    _, out = topology.merge_junctions(nodes, edges, 0.8)
    return out.select("edge", "u", "v", "ends_moved")


@query(
    "contracted_chains",
    """WITH RECURSIVE c AS (SELECT *, CASE road WHEN 'motorway' THEN 0 WHEN 'primary' THEN 1 WHEN 'secondary' THEN 2 WHEN 'residential' THEN 3 ELSE 4 END AS k FROM streets),
    e AS (SELECT u * 5 + k AS u, v * 5 + k AS v, min(edge) AS edge, min(length) AS length FROM c GROUP BY ALL),
    ends AS (SELECT u AS node, v AS other FROM e UNION ALL SELECT v, u FROM e),
    inner_nodes AS (SELECT node FROM ends GROUP BY node HAVING count(DISTINCT other) = 2 AND count(*) IN (2, 4)),
    link AS (SELECT b.edge, min(a.edge) AS prev FROM e a JOIN inner_nodes i ON i.node = a.v JOIN e b ON b.u = a.v AND b.v <> a.u GROUP BY b.edge),
    walk(edge, chain, pos) AS (SELECT edge, edge, 0 FROM e WHERE edge NOT IN (SELECT edge FROM link)
      UNION ALL SELECT link.edge, chain, pos + 1 FROM walk JOIN link ON link.prev = walk.edge),
    ring AS (SELECT edge, edge AS chain, 0 AS pos FROM e WHERE edge NOT IN (SELECT edge FROM walk)),
    w AS (SELECT * FROM walk UNION ALL SELECT * FROM ring)
    SELECT chain AS edge, arg_min(u, pos) AS u, arg_max(v, pos) AS v, sum(length) AS length, count(*) AS pieces FROM w JOIN e USING (edge) GROUP BY chain""",
)
def contracted_chains(t):
    """Street chains contracted between their end points; every road class is a network of its own."""
    road = F.element_at("highway", 1)
    code = (
        F.when(road == "motorway", 0).when(road == "primary", 1).when(road == "secondary", 2).when(road == "residential", 3).otherwise(4)
    )
    lanes = t.streets().withColumns({"u": F.col("u") * 5 + code, "v": F.col("v") * 5 + code})
    unique = lanes.groupBy("u", "v").agg(F.min("edge").alias("edge"), F.min("length").alias("length"))
    out, _ = topology.contract_chains(unique.select("edge", "u", "v", "length"))
    return out


def chains_sql(src: str, out: str) -> str:
    """Table ``out``: the edges of ``src`` (road, edge, u, v, length) with chains contracted, in each road class."""
    return f"""{out}_ends AS (SELECT road, u AS node, v AS other FROM {src} UNION ALL SELECT road, v, u FROM {src}),
    {out}_inner AS (SELECT road, node FROM {out}_ends GROUP BY road, node
      HAVING count(DISTINCT other) = 2 AND count(*) IN (2, 4) AND NOT bool_or(node = other)),
    {out}_next AS (SELECT b.road, b.edge, min(a.edge) AS prev FROM {src} a JOIN {out}_inner i ON i.road = a.road AND i.node = a.v
      JOIN {src} b ON b.road = a.road AND b.u = a.v AND b.v <> a.u GROUP BY b.road, b.edge),
    {out}_link AS MATERIALIZED (SELECT road, min(edge) AS edge, prev FROM {out}_next GROUP BY road, prev),
    {out}_walk(road, edge, chain, pos) AS (SELECT road, edge, edge, 0 FROM {src} s
        WHERE NOT EXISTS (SELECT 1 FROM {out}_link l WHERE l.road = s.road AND l.edge = s.edge)
      UNION ALL SELECT l.road, l.edge, chain, pos + 1 FROM {out}_walk w JOIN {out}_link l ON l.road = w.road AND l.prev = w.edge),
    {out}_all AS (SELECT * FROM {out}_walk UNION ALL SELECT road, edge, edge, 0 FROM {src} s
      WHERE NOT EXISTS (SELECT 1 FROM {out}_walk w WHERE w.road = s.road AND w.edge = s.edge)),
    {out} AS MATERIALIZED (SELECT road, chain AS edge, arg_min(u, pos) AS u, arg_max(v, pos) AS v, sum(length) AS length
      FROM {out}_all JOIN {src} USING (road, edge) GROUP BY road, chain)"""


def cleaning_sql(streets: str, near: str) -> str:
    """Tables that clean ``streets``: ``near`` has the pairs (road, u, v) of close nodes, both ways; the result is ``cleaned``."""

    def both_ways(src: str) -> str:
        return f"""SELECT road, edge, u, v, length FROM {src} UNION ALL SELECT road, edge || '/r', v, u, length FROM {src} s
      WHERE NOT EXISTS (SELECT 1 FROM {src} r WHERE r.road = s.road AND r.u = s.v AND r.v = s.u)"""

    return f"""before AS MATERIALIZED ({streets}), near AS MATERIALIZED ({near}),
    cc(road, node, label) USING KEY (road, node) AS (SELECT DISTINCT road, u, u FROM near
      UNION SELECT road, v, min(label) FROM (SELECT near.road, near.v, cc.label FROM cc JOIN near ON near.road = cc.road AND near.u = cc.node) n
      WHERE label < (SELECT k.label FROM recurring.cc k WHERE k.road = n.road AND k.node = n.v) GROUP BY road, v),
    named AS MATERIALIZED (SELECT road, node, 'c' || label AS c FROM cc),
    merged AS MATERIALIZED (SELECT e.road, cast(edge as varchar) AS edge, coalesce(a.c, cast(u as varchar)) AS u, coalesce(b.c, cast(v as varchar)) AS v,
      length FROM before e LEFT JOIN named a ON a.road = e.road AND a.node = u LEFT JOIN named b ON b.road = e.road AND b.node = v
      WHERE a.c IS NULL OR b.c IS NULL OR a.c <> b.c),
    reflected AS MATERIALIZED ({both_ways("merged")}),
    {chains_sql("reflected", "first")},
    ratio AS (SELECT road, u, v, min(edge) AS lead, max(length) / min(length) AS r FROM first GROUP BY road, u, v),
    fewer AS MATERIALIZED (SELECT first.* FROM first JOIN ratio USING (road, u, v) WHERE r >= 1.5 OR edge = lead),
    {chains_sql("fewer", "second")},
    cleaned AS MATERIALIZED ({both_ways("second")})"""


CLOSE_PLACES = """WITH touched AS (SELECT road, u AS node FROM streets UNION SELECT road, v FROM streets),
      placed AS MATERIALIZED (SELECT road, node, lon, lat FROM touched JOIN points ON id = node)
    SELECT a.road, a.node AS u, b.node AS v FROM placed a JOIN placed b ON a.road = b.road AND a.node <> b.node
      AND abs(a.lon - b.lon) <= 1.6 AND abs(a.lat - b.lat) <= 1.6 AND sqrt((a.lon - b.lon) ** 2 + (a.lat - b.lat) ** 2) <= 1.6"""


@query(
    "cleaned_networks",
    f"""WITH RECURSIVE {cleaning_sql("SELECT road, edge, u, v, length FROM streets", CLOSE_PLACES)}
    SELECT road, edge, u, v, length FROM cleaned""",
)
def cleaned_networks(t):
    """The streets of every class as a network of its own, cleaned: all edges that are left."""
    streets = t.streets().select(F.element_at("highway", 1).alias("road"), "edge", "u", "v", "length")
    touched = streets.select("road", F.explode(F.array("u", "v")).alias("node")).distinct()
    nodes = touched.join(t.points().select(F.col("id").alias("node"), F.col("lon").alias("x"), F.col("lat").alias("y")), "node")
    final, _ = topology.clean_network(nodes, streets, 0.8, ["road"])
    return final.select("road", "edge", "u", "v", "length")


@query(
    "cleaned_network",
    f"""WITH RECURSIVE {cleaning_sql("SELECT '' AS road, edge, u, v, length FROM streets",
    "SELECT '' AS road, a.node AS u, b.node AS v FROM nodes a JOIN nodes b ON a.node <> b.node AND abs(a.x - b.x) <= 0.004 AND abs(a.y - b.y) <= 0.004")}
    SELECT (SELECT count(*) FROM before) AS edges_before, (SELECT count(*) FROM cleaned) AS edges_after,
      ((SELECT count(*) FROM before) - (SELECT count(*) FROM cleaned)) / (SELECT count(*) FROM before)::double * 100 AS removed_pct""",
)
def cleaned_network(t):
    nodes = t.nodes().select("node", "x", "y")
    _, summary = topology.clean_network(nodes, t.streets().select("edge", "u", "v", "length"), 0.002)
    return summary


@query(
    "clipped_graph",
    """WITH z AS (SELECT (s_suppkey * 7 % 40) * 0.01::double + 0.0013 AS cx, floor(s_suppkey / 3.0) * 0.01::double + 0.0017 AS cy, 0.0123::double AS r FROM supplier),
    s AS (SELECT edge, length, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM streets JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v),
    k AS (SELECT edge, CASE WHEN y1 = y2 THEN (cx + sgn * (r - abs(y1 - cy)) - x1) / (x2 - x1) ELSE (cy + sgn * (r - abs(x1 - cx)) - y1) / (y2 - y1) END AS t
      FROM s JOIN z ON CASE WHEN y1 = y2 THEN abs(y1 - cy) ELSE abs(x1 - cx) END < r, (SELECT unnest([-1, 1]) AS sgn)),
    c AS (SELECT DISTINCT edge, round(t, 12) AS t FROM k WHERE t > 0 AND t < 1 UNION SELECT edge, 0.0 FROM s UNION SELECT edge, 1.0 FROM s),
    p AS (SELECT edge, t AS t0, lead(t) OVER (PARTITION BY edge ORDER BY t) AS t1 FROM c),
    q AS (SELECT s.*, t0, t1, x1 + (x2 - x1) * (t0 + t1) / 2 AS mx, y1 + (y2 - y1) * (t0 + t1) / 2 AS my FROM p JOIN s USING (edge) WHERE t1 IS NOT NULL)
    SELECT edge, round(t0, 6) AS t0, round(length * (t1 - t0), 5) AS length FROM q WHERE EXISTS (SELECT 1 FROM z WHERE abs(mx - cx) + abs(my - cy) < r)""",
)
def clipped_graph(t):
    from citygrain.queries.geometry_queries import street_zones

    _, edges = topology.clip_graph(t.nodes(), t.streets(), street_zones(t).select("rings"), 0.02)
    return edges.select("edge", F.round("t0", 6).alias("t0"), F.round("length", 5).alias("length"))


def lines_of(t):
    """Long straight lines: each supplier's place to its nation's place."""
    n = t.countries().select(
        F.regexp_extract("name", r"(\d+)", 1).cast("int").alias("nation"),
        (F.col("xmin") + 31.7).alias("x2"), (F.col("ymin") + 17.3).alias("y2"),
    )
    return t.zones().join(n, "nation").select(F.col("zone").alias("edge"), F.col("cx").alias("x1"), F.col("cy").alias("y1"), "x2", "y2")


@query(
    "lines_split_at_crossings",
    """WITH l AS (SELECT zone AS edge, cx AS x1, cy AS y1, xmin + 31.7 AS x2, ymin + 17.3 AS y2 FROM zones
      JOIN countries ON name = 'NATION_' || nation),
    d AS (SELECT a.edge, (a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1) AS det,
      (b.x1 - a.x1) * (b.y2 - b.y1) - (b.y1 - a.y1) * (b.x2 - b.x1) AS tn,
      (b.x1 - a.x1) * (a.y2 - a.y1) - (b.y1 - a.y1) * (a.x2 - a.x1) AS wn FROM l a JOIN l b ON a.edge <> b.edge),
    c AS (SELECT DISTINCT edge, round(tn / det, 9) AS t FROM d WHERE det <> 0 AND tn / det BETWEEN 0 AND 1 AND wn / det BETWEEN 0 AND 1)
    SELECT edge, count(*) FILTER (WHERE t > 0 AND t < 1) + 1 AS pieces, round(coalesce(min(t) FILTER (WHERE t > 0 AND t < 1), 1), 6) AS first_cut
    FROM (SELECT edge, t FROM c UNION ALL SELECT edge, NULL FROM l) GROUP BY edge""",
)
def lines_split_at_crossings(t):
    out = topology.split_at_crossings(lines_of(t), 20.0)
    return out.groupBy("edge").agg(
        F.count(F.lit(1)).alias("pieces"), F.round(F.min("t1"), 6).alias("first_cut")
    )


POIS = """(SELECT c_custkey AS poi, (c_custkey * 37 % 4000) * 0.0001::double AS x, (c_custkey * 91 % 3700) * 0.0001::double AS y FROM customer)"""


def pois(t):
    k = F.col("c_custkey")
    return t.read("customer").select(
        k.alias("poi"), ((k * 37 % 4000) * 0.0001).alias("x"), ((k * 91 % 3700) * 0.0001).alias("y")
    )


@query(
    "places_snapped_to_edges",
    f"""WITH s AS (SELECT DISTINCT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM streets JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v),
    q AS (SELECT poi, p.x, p.y, s.*, greatest(0, least(1, ((p.x - x1) * (x2 - x1) + (p.y - y1) * (y2 - y1))
      / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS w FROM {POIS} p JOIN s ON p.x BETWEEN least(x1, x2) - 0.03 AND greatest(x1, x2) + 0.03
      AND p.y BETWEEN least(y1, y2) - 0.03 AND greatest(y1, y2) + 0.03),
    d AS (SELECT poi, min(sqrt((x1 + (x2 - x1) * w - x) ** 2 + (y1 + (y2 - y1) * w - y) ** 2)) AS d FROM q GROUP BY poi)
    SELECT poi, round(d, 7) AS distance FROM d WHERE d <= 0.003""",
)
def places_snapped_to_edges(t):
    snapped, _, _ = topology.snap_to_edges(pois(t), t.nodes().select("node", "x", "y"), t.streets(), 0.003)
    return snapped.select("poi", F.round("distance", 7).alias("distance"))


@query(
    "network_with_places",
    f"""WITH s AS (SELECT DISTINCT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM streets JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v),
    q AS (SELECT poi, p.x, p.y, s.*, greatest(0, least(1, ((p.x - x1) * (x2 - x1) + (p.y - y1) * (y2 - y1))
      / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS w FROM {POIS} p JOIN s ON p.x BETWEEN least(x1, x2) - 0.03 AND greatest(x1, x2) + 0.03
      AND p.y BETWEEN least(y1, y2) - 0.03 AND greatest(y1, y2) + 0.03),
    d AS (SELECT poi, min(sqrt((x1 + (x2 - x1) * w - x) ** 2 + (y1 + (y2 - y1) * w - y) ** 2)) AS d FROM q GROUP BY poi)
    SELECT 'street' AS kind, round(sum(length), 3) AS length FROM streets UNION ALL SELECT 'access', round(2 * sum(d), 3) FROM d WHERE d <= 0.003""",
)
def network_with_places(t):
    """The street network split at places and with access edges."""
    _, _, edges = topology.snap_to_edges(pois(t), t.nodes().select("node", "x", "y"), t.streets(), 0.003)
    return edges.groupBy("kind").agg(F.round(F.sum("length"), 3).alias("length"))


# reach ------------------------------------------------------------------------------------

REACH = """r(category, node, cost) USING KEY (category, node) AS (
      SELECT DISTINCT category, node, 0.0::double FROM facilities
      UNION SELECT category, v, min(cost) FROM (SELECT r.category, s.v, r.cost + s.length AS cost FROM r JOIN streets s ON s.u = r.node
        WHERE r.cost + s.length <= {cutoff}) n
        WHERE NOT EXISTS (SELECT 1 FROM recurring.r o WHERE o.category = n.category AND o.node = n.v AND o.cost <= n.cost)
      GROUP BY category, v)"""


@query("facility_reach", f"WITH RECURSIVE {REACH.format(cutoff=800)} SELECT category, node, 1 AS reached FROM r")
def facility_reach(t):
    origins = t.facilities().select("category", "node")
    return reach.reach(t.streets(), origins, 800.0, carry=["category"])


@query(
    "facility_reach_counts",
    """WITH RECURSIVE r(origin, node, cost) USING KEY (origin, node) AS (
      SELECT DISTINCT node, node, 0.0::double FROM facilities
      UNION SELECT origin, v, min(cost) FROM (SELECT r.origin, s.v, r.cost + s.length AS cost FROM r JOIN streets s ON s.u = r.node
        WHERE r.cost + s.length <= 500) n
        WHERE NOT EXISTS (SELECT 1 FROM recurring.r o WHERE o.origin = n.origin AND o.node = n.v AND o.cost <= n.cost)
      GROUP BY origin, v)
    SELECT node, count(*) AS reached FROM r GROUP BY node""",
)
def facility_reach_counts(t):
    return reach.reach(t.streets(), t.facilities().select("node"), 500.0, stacking=True)


@query(
    "isochrone_nodes",
    f"""WITH RECURSIVE {REACH.format(cutoff=800)}
    SELECT category, node, round(cost, 6) AS cost, t AS threshold FROM r JOIN (SELECT unnest([300.0, 500.0, 800.0])::double AS t) ON cost <= t""",
)
def isochrone_nodes(t):
    origins = t.facilities().select("category", "node")
    out = reach.isochrone_nodes(t.streets(), origins, [300, 500, 800])
    return out.withColumn("cost", F.round("cost", 6))


def footprint_sql(radius: float) -> str:
    """Table ``zoned`` (keys of ``segs``, x, y): cells of a grid of 0.002 whose centre is within the radius of a segment."""
    return f"""tried AS (SELECT *, unnest(range(cast(floor((least(y1, y2) - {radius}) / 0.002) as int), cast(floor((greatest(y1, y2) + {radius}) / 0.002) as int) + 1)) AS y
      FROM (SELECT *, unnest(range(cast(floor((least(x1, x2) - {radius}) / 0.002) as int), cast(floor((greatest(x1, x2) + {radius}) / 0.002) as int) + 1)) AS x FROM segs)),
    foot AS (SELECT *, (x + 0.5) * 0.002::double AS px, (y + 0.5) * 0.002::double AS py, (x2 - x1) ** 2 + (y2 - y1) ** 2 AS d2 FROM tried),
    along AS (SELECT *, CASE WHEN d2 = 0 THEN 0 ELSE greatest(0, least(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / d2)) END AS w FROM foot),
    zoned AS MATERIALIZED (SELECT DISTINCT road, category, threshold, x, y FROM along
      WHERE sqrt((px - x1 - w * (x2 - x1)) ** 2 + (py - y1 - w * (y2 - y1)) ** 2) <= {radius})"""


# whatever the surroundings of a zone cannot be entered from outside belongs to it
FILLED = """box AS MATERIALIZED (SELECT road, category, threshold, min(x) - 1 AS x1, max(x) + 1 AS x2, min(y) - 1 AS y1, max(y) + 1 AS y2 FROM zoned GROUP BY ALL),
    spots AS (SELECT *, unnest(range(y1, y2 + 1)) AS y FROM (SELECT *, unnest(range(x1, x2 + 1)) AS x FROM box)),
    free AS MATERIALIZED (SELECT road, category, threshold, x, y FROM spots ANTI JOIN zoned USING (road, category, threshold, x, y)),
    outside(road, category, threshold, x, y) AS (SELECT road, category, threshold, x1, y1 FROM box
      UNION SELECT f.road, f.category, f.threshold, f.x, f.y FROM outside o, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dx, dy), free f
        WHERE f.road = o.road AND f.category = o.category AND f.threshold = o.threshold AND f.x = o.x + dx AND f.y = o.y + dy)"""


@query(
    "isochrone_bands",
    f"""WITH RECURSIVE {REACH.format(cutoff=500)},
    z AS (SELECT '' AS road, category, node, t AS threshold FROM r JOIN (SELECT unnest([300.0, 500.0])::double AS t) ON cost <= t),
    segs AS (SELECT z.road, z.category, z.threshold, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM z JOIN (SELECT DISTINCT u, v FROM streets) s ON s.u = z.node
      JOIN z w ON w.node = s.v AND w.category = z.category AND w.threshold = z.threshold JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v
      UNION SELECT road, category, threshold, x, y, x, y FROM z JOIN nodes USING (node)),
    {footprint_sql(0.003)}, {FILLED}
    SELECT category, x, y, min(threshold) AS threshold FROM spots ANTI JOIN outside USING (road, category, threshold, x, y) GROUP BY ALL""",
)
def isochrone_bands(t):
    """Walking zones as cell footprints, each cell in its nearest zone."""
    nodes = t.nodes().select("node", "x", "y")
    origins = t.facilities().select("category", "node")
    grid = Grid(0.0, 0.0, 0.002, 0.002)
    return accessibility.isochrone_bands(t.streets(), nodes, origins, [300, 500], 0.003, grid, fill=True)


@query(
    "zones_of_places",
    f"""WITH RECURSIVE touched AS MATERIALIZED (SELECT road, u AS node FROM streets UNION SELECT road, v FROM streets),
    near AS (SELECT poi, road, arg_min(node, (sqrt((p.x - n.x) ** 2 + (p.y - n.y) ** 2), node)) AS node FROM {POIS} p, touched JOIN nodes n USING (node) GROUP BY ALL),
    starts AS MATERIALIZED (SELECT DISTINCT road, 'kind' || poi % 3 AS category, node FROM near WHERE poi % 3 < 2),
    r(road, category, node, cost) USING KEY (road, category, node) AS (SELECT road, category, node, 0.0::double FROM starts
      UNION SELECT road, category, v, min(cost) FROM (SELECT r.road, r.category, s.v, r.cost + s.length AS cost FROM r
        JOIN streets s ON s.road = r.road AND s.u = r.node WHERE r.cost + s.length <= 500) n
        WHERE NOT EXISTS (SELECT 1 FROM recurring.r o WHERE o.road = n.road AND o.category = n.category AND o.node = n.v AND o.cost <= n.cost)
      GROUP BY road, category, v),
    z AS (SELECT road, category, node, t AS threshold FROM r JOIN (VALUES ('kind0', 200.0::double), ('kind0', 500.0::double), ('kind1', 350.0::double)) k(category, t)
      USING (category) WHERE cost <= t),
    segs AS (SELECT z.road, z.category, z.threshold, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM z
      JOIN (SELECT DISTINCT road, u, v FROM streets) s ON s.road = z.road AND s.u = z.node
      JOIN z w ON w.road = z.road AND w.node = s.v AND w.category = z.category AND w.threshold = z.threshold
      JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v
      UNION SELECT road, category, threshold, x, y, x, y FROM z JOIN nodes USING (node)),
    {footprint_sql(0.0034)}
    SELECT road, category, x, y, min(threshold) AS threshold FROM zoned GROUP BY ALL""",
)
def zones_of_places(t):
    """From places to zones in one plan; every street class is a network of its own, categories have limits of their own."""
    places = pois(t).withColumn("category", F.concat(F.lit("kind"), (F.col("poi") % 3).cast("string")))
    streets = t.streets().select(F.element_at("highway", 1).alias("road"), "edge", "u", "v", "length")
    road = F.explode(F.array(*[F.lit(c) for c in ("motorway", "primary", "secondary", "residential", "track")])).alias("road")
    nodes, spots = t.nodes().select("node", "x", "y", road), places.select("category", "x", "y", road)
    limits = {"kind0": [200, 500], "kind1": [350]}
    return accessibility.zones_of_places(spots, streets, nodes, limits, 0.0034, Grid(0.0, 0.0, 0.002, 0.002), by=["road"])


@query(
    "facility_nodes",
    f"""WITH d AS (SELECT poi, node, sqrt((p.x - n.x) ** 2 + (p.y - n.y) ** 2) AS d FROM {POIS} p, nodes n)
    SELECT DISTINCT 'kind' || poi % 3 AS category, node FROM (SELECT poi, arg_min(node, (d, node)) AS node FROM d GROUP BY poi)""",
)
def facility_nodes(t):
    places = pois(t).withColumn("category", F.concat(F.lit("kind"), (F.col("poi") % 3).cast("string")))
    return reach.facility_nodes(places, t.nodes().select("node", "x", "y"))


# costs above this are no routes
LIMIT = 12.0

OD = f"""od(o, d, cost) USING KEY (o, d) AS (
      SELECT s_suppkey, s_suppkey, 0.0::double FROM supplier
      UNION SELECT o, v, min(cost) FROM (SELECT od.o, l.v, od.cost + l.length AS cost FROM od JOIN links l ON l.u = od.d
        WHERE od.cost + l.length <= {LIMIT}) n
        WHERE NOT EXISTS (SELECT 1 FROM recurring.od k WHERE k.o = n.o AND k.d = n.v AND k.cost <= n.cost) GROUP BY o, v)"""


def od_table(t):
    nodes = t.read("supplier").select(F.col("s_suppkey").alias("node"))
    return reach.od_costs(t.links(), nodes, nodes, LIMIT)


def od_origins(t):
    return t.read("supplier").select(F.col("s_suppkey").alias("o"))


@query("od_costs", f"WITH RECURSIVE {OD} SELECT o, d, cost FROM od")
def od_costs(t):
    return od_table(t)


@query(
    "od_lookup",
    f"""WITH RECURSIVE {OD} SELECT l_orderkey, l_linenumber, o, d, coalesce(cost, 99999) AS cost FROM
    (SELECT l_orderkey, l_linenumber, l_suppkey AS o, l_suppkey + l_linenumber AS d FROM lineitem) p LEFT JOIN od USING (o, d)""",
)
def od_lookup(t):
    pairs = t.read("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("o"), (F.col("l_suppkey") + F.col("l_linenumber")).alias("d")
    )
    return reach.od_lookup(od_table(t), pairs, 99999)


@query(
    "od_unreached",
    """WITH RECURSIVE r(o, node, cost) USING KEY (o, node) AS (
      SELECT DISTINCT node, node, 0.0::double FROM facilities
      UNION SELECT o, v, min(cost) FROM (SELECT r.o, s.v, r.cost + s.length AS cost FROM r JOIN streets s ON s.u = r.node
        WHERE r.cost + s.length <= 700) n
        WHERE NOT EXISTS (SELECT 1 FROM recurring.r k WHERE k.o = n.o AND k.node = n.v AND k.cost <= n.cost) GROUP BY o, v),
    f AS (SELECT DISTINCT node FROM facilities)
    SELECT o, count(*) AS reached, (SELECT count(*) FROM f) - count(*) AS unreached FROM r WHERE node IN (SELECT node FROM f) GROUP BY o""",
)
def od_unreached(t):
    f = t.facilities().select("node")
    return reach.od_unreached(reach.od_costs(t.streets(), f, f, 700.0), f, f)


@query(
    "od_between_points",
    f"""WITH RECURSIVE {OD}, d AS (SELECT id, zone, sqrt((lon - cx) ** 2 + (lat - cy) ** 2) AS d FROM points, zones),
    s AS (SELECT id, arg_min(zone, (d, zone)) AS node, min(d) AS d FROM d GROUP BY id)
    SELECT o_orderkey AS pair, a.id AS origin, b.id AS destination,
      round(coalesce(cost, 99999) + (a.d + b.d) / 1000 / 5 * 3600, 5) AS cost
    FROM orders JOIN s a ON a.id = o_custkey JOIN s b ON b.id = (o_custkey * 31 + o_orderkey) % (SELECT count(*) FROM customer)
    LEFT JOIN od ON od.o = a.node AND od.d = b.node""",
)
def od_between_points(t):
    nodes = t.zones().select(F.col("zone").alias("node"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    people = t.points().select("id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    total = t.read("customer").agg(F.count(F.lit(1)).alias("n"))
    pairs = t.read("orders").select(
        F.col("o_orderkey").alias("pair"),
        F.col("o_custkey").alias("origin"),
        ((F.col("o_custkey") * 31 + F.col("o_orderkey")) % total.scalar()).alias("destination"),
    )
    out = reach.od_from_points(nodes, t.links(), people, people, pairs.drop("pair").distinct(), 99999, LIMIT, walk_speed_kmh=5.0)
    return pairs.join(out, ["origin", "destination"]).select("pair", "origin", "destination", F.round("cost", 5).alias("cost"))


@query(
    "gravity_access",
    f"""WITH RECURSIVE {OD} SELECT o, {", ".join(f"round(s_acct.w * sum(dw * exp(-{k:.10f}::double * cost)), 2) AS decay_{i}" for i, k in enumerate(reach.DECAYS))}
    FROM od JOIN (SELECT s_suppkey AS d, s_nationkey + 1 AS dw FROM supplier) USING (d)
    JOIN (SELECT s_suppkey AS o, s_nationkey % 3 + 1 AS w FROM supplier) s_acct USING (o) GROUP BY o, s_acct.w""",
)
def gravity_access(t):
    s = t.read("supplier")
    ow = s.select(F.col("s_suppkey").alias("o"), (F.col("s_nationkey") % 3 + 1).cast("double").alias("weight"))
    dw = s.select(F.col("s_suppkey").alias("d"), (F.col("s_nationkey") + 1).cast("double").alias("weight"))
    out = reach.gravity_access(od_table(t), ow, dw)
    return out.select("o", *[F.round(f"`{reach.decay_name(k)}`", 2).alias(f"decay_{i}") for i, k in enumerate(reach.DECAYS)])


@query(
    "market_access",
    f"""WITH p AS (SELECT o_custkey AS "O_UID", l_suppkey AS "D_UID", min(sqrt((lon - cx) ** 2 + (lat - cy) ** 2) * 100) AS dist, min(s_nationkey + 1) AS pop
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN points ON id = o_custkey JOIN zones ON zone = l_suppkey
      JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL)
    SELECT "O_UID", {", ".join(f"round(sum(pop * exp(-{k:.10f}::double * dist)), 5) AS decay_{i}" for i, k in enumerate(reach.DECAYS))} FROM p WHERE dist > 0 GROUP BY ALL""",
)
def market_access(t):
    od = straight_pairs(t)
    out = reach.market_access(od)
    return out.select("O_UID", *[F.round(f"`{reach.decay_name(k)}`", 5).alias(f"decay_{i}") for i, k in enumerate(reach.DECAYS)])


def straight_pairs(t):
    """Straight distances from customers to the suppliers they order from, with populations."""
    pairs = (
        t.read("orders").join(t.read("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("O_UID"), F.col("l_suppkey").alias("D_UID"))
    )
    people = t.points().select("id", "lon", "lat", (F.col("nation") + 1).alias("weight"))
    depots = t.zones().select(F.col("zone").alias("id"), F.col("cx").alias("lon"), F.col("cy").alias("lat"), (F.col("nation") + 1).alias("weight"))
    return reach.attach_population(reach.straight_od(pairs, people, depots), people, depots)


@query(
    "straight_od_populations",
    """SELECT DISTINCT o_custkey AS "O_UID", l_suppkey AS "D_UID", round(sqrt((lon - cx) ** 2 + (lat - cy) ** 2) * 100, 6) AS "DIST",
      p.nation + 1 AS "O_POP", z.nation + 1 AS "D_POP" FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      JOIN points p ON id = o_custkey JOIN zones z ON zone = l_suppkey""",
)
def straight_od_populations(t):
    return straight_pairs(t).withColumn("DIST", F.round("DIST", 6))


@query(
    "gravity_demand",
    f"""WITH RECURSIVE {OD}, w AS (SELECT s_suppkey AS node, s_nationkey + 1 AS weight FROM supplier),
    r AS (SELECT o, d, CASE WHEN o = d THEN 0 ELSE a.weight * b.weight * exp(-cost / (SELECT max(cost) FROM od)) END AS raw
      FROM od JOIN w a ON a.node = o JOIN w b ON b.node = d)
    SELECT o, d, cast(ceil(round(raw / (SELECT max(raw) FROM r) * 100, 9)) as int) AS trips FROM r""",
)
def gravity_demand(t):
    weights = t.read("supplier").select(F.col("s_suppkey").alias("node"), (F.col("s_nationkey") + 1).cast("double").alias("weight"))
    return reach.gravity_demand(od_table(t), weights)


# centrality and facilities -----------------------------------------------------------------

PATHS = """dist(s, t, d) USING KEY (s, t) AS (SELECT s_suppkey, s_suppkey, 0 FROM supplier
      UNION SELECT s, v, min(d) FROM (SELECT dist.s, l.v, dist.d + 1 AS d FROM dist JOIN links l ON l.u = dist.t) n
        WHERE NOT EXISTS (SELECT 1 FROM recurring.dist k WHERE k.s = n.s AND k.t = n.v) GROUP BY s, v),
    pc(s, t, d, c) AS (SELECT s_suppkey, s_suppkey, 0, 1.0::double FROM supplier
      UNION ALL SELECT s, t, d, sum(c) FROM (SELECT pc.s, l.v AS t, pc.d + 1 AS d, pc.c FROM pc JOIN links l ON l.u = pc.t
        JOIN dist x ON x.s = pc.s AND x.t = l.v AND x.d = pc.d + 1) GROUP BY s, t, d)"""


@query(
    "edge_betweenness",
    f"""WITH RECURSIVE {PATHS}, n AS (SELECT count(*) AS n FROM supplier),
    b AS (SELECT l.u, l.v, sum(a.c * z.c / p.c) / (SELECT n * (n - 1) FROM n) AS c FROM links l JOIN pc a ON a.t = l.u JOIN pc z ON z.s = l.v
      JOIN pc p ON p.s = a.s AND p.t = z.t AND p.d = a.d + 1 + z.d GROUP BY ALL)
    SELECT u, v, round(c, 9) AS centrality, round((SELECT avg(c) FROM b), 9) AS mean_centrality FROM b""",
)
def edge_betweenness(t):
    out = centrality.betweenness(t.links())
    return out.select("u", "v", F.round("centrality", 9).alias("centrality"), F.round("mean_centrality", 9).alias("mean_centrality"))


@query(
    "road_network_edges",
    f"""WITH RECURSIVE {PATHS}, n AS (SELECT count(*) AS n FROM supplier),
    b AS (SELECT l.u, l.v, l.length, sum(a.c * z.c / p.c) / (SELECT n * (n - 1) FROM n) AS c FROM links l JOIN pc a ON a.t = l.u JOIN pc z ON z.s = l.v
      JOIN pc p ON p.s = a.s AND p.t = z.t AND p.d = a.d + 1 + z.d GROUP BY ALL)
    SELECT u, v, CASE WHEN length < 20 THEN 'Primary' ELSE 'Secondary' END AS road_type, round(c * 100, 7) AS edge_centrality,
      round((SELECT avg(c) FROM b) * 100, 7) AS mean_centrality FROM b""",
)
def road_network_edges(t):
    """Links between suppliers assessed as a road network: every edge, with the mean beside it."""
    road, city = F.when(F.col("length") < 20, "primary").otherwise("residential"), F.lit("links").alias("city")
    nodes = t.zones().select(city, F.col("zone").alias("node"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    found = roads.assess(nodes, t.links().select(city, "*", F.array(road).alias("highway")))
    joined = found.edges.join(found.statistics.select("city", "mean_centrality"), "city")
    return joined.select(
        "u", "v", "road_type", F.round("edge_centrality", 7).alias("edge_centrality"), F.round("mean_centrality", 7).alias("mean_centrality")
    )


@query(
    "node_betweenness",
    f"""WITH RECURSIVE {PATHS}, n AS (SELECT count(*) AS n FROM supplier),
    b AS (SELECT a.t AS node, sum(a.c * z.c / p.c) / (SELECT (n - 1) * (n - 2) FROM n) AS c FROM pc a JOIN pc z ON z.s = a.t
      JOIN pc p ON p.s = a.s AND p.t = z.t AND p.d = a.d + z.d WHERE a.d > 0 AND z.d > 0 GROUP BY ALL)
    SELECT node, round(c, 9) AS centrality FROM b""",
)
def node_betweenness(t):
    out = centrality.betweenness(t.links(), "node")
    return out.select("node", F.round("centrality", 9).alias("centrality"))


def _steps(first: str, step: str, n: int) -> str:
    """Common table expressions of ``n`` greedy steps, each on the one before."""
    return ", ".join([first, *[step.format(k=k, j=k - 1) for k in range(1, n + 1)]])


@query(
    "facility_coverage",
    f"""WITH RECURSIVE {OD}, c AS (SELECT DISTINCT o FROM od WHERE cost <= 5 AND d IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)),
    w AS (SELECT s_suppkey AS o, cast(s_nationkey + 1 as double) AS w FROM supplier WHERE s_suppkey % 5 > 0)
    SELECT sum(w) AS demand, sum(w) FILTER (WHERE o IN (SELECT o FROM c)) AS covered,
      round(100 * sum(w) FILTER (WHERE o IN (SELECT o FROM c)) / sum(w), 6) AS percent FROM w""",
)
def facility_coverage(t):
    s = t.read("supplier")
    chosen = s.where("s_nationkey = 3").select(F.col("s_suppkey").alias("d"))
    weights = s.where("s_suppkey % 5 > 0").select(F.col("s_suppkey").alias("o"), (F.col("s_nationkey") + 1).alias("weight"))
    out = facility.coverage(od_table(t), od_origins(t), 5.0, chosen, weights)
    return out.withColumn("percent", F.round("percent", 6))


COVER_STEPS = 60


@query(
    "facilities_for_coverage",
    f"""WITH RECURSIVE {OD}, n AS (SELECT count(*) AS n FROM supplier), l AS MATERIALIZED (SELECT o, d FROM od WHERE cost <= 4),
    {_steps(
        "c0 AS (SELECT o FROM l WHERE false)",
        "p{k} AS MATERIALIZED (SELECT {k} AS step, d, count(*)::double AS gain FROM l WHERE o NOT IN (SELECT o FROM c{j}) GROUP BY d ORDER BY gain DESC, d LIMIT 1), "
        "c{k} AS MATERIALIZED (SELECT o FROM c{j} UNION SELECT o FROM l WHERE d IN (SELECT d FROM p{k}))",
        COVER_STEPS,
    )},
    p AS ({" UNION ALL ".join(f"SELECT * FROM p{k}" for k in range(1, COVER_STEPS + 1))}),
    r AS (SELECT step::bigint AS step, d, gain, sum(gain) OVER (ORDER BY step) AS covered FROM p)
    SELECT step, d, gain, covered, round(covered / n * 100, 6) AS percent FROM r, n WHERE covered - gain < 0.8 * n""",
)
def facilities_for_coverage(t):
    """Facilities chosen greedily until 80 percent of the suppliers are within 4."""
    out = facility.greedy_cover(od_table(t), od_origins(t), None, 4.0, share=0.8)
    return out.withColumns({"step": F.col("step").cast("long"), "percent": F.round("percent", 6)})


@query(
    "median_cost",
    f"""WITH RECURSIVE {OD}, c AS (SELECT o, min(cost) AS cost FROM od WHERE d IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3) GROUP BY o)
    SELECT sum(coalesce(cost, 500.0)) AS total_cost, count(*) AS origins, count(*) FILTER (WHERE cost IS NULL) AS unserved
    FROM supplier LEFT JOIN c ON o = s_suppkey""",
)
def median_cost(t):
    chosen = t.read("supplier").where("s_nationkey = 3").select(F.col("s_suppkey").alias("d"))
    return facility.median_cost(od_table(t), od_origins(t), chosen, 500.0)


MEDIAN_STEPS = 4


@query(
    "median_facilities",
    f"""WITH RECURSIVE {OD}, {_steps(
        "p0 AS (SELECT -1 AS d WHERE false), m0 AS MATERIALIZED (SELECT s_suppkey AS o, 500.0::double AS now FROM supplier)",
        "p{k} AS MATERIALIZED (SELECT d, sum(greatest(now - cost, 0)) AS saved FROM od JOIN m{j} USING (o) WHERE d NOT IN (SELECT d FROM t{j}) "
        "GROUP BY d ORDER BY saved DESC, d LIMIT 1), t{k} AS MATERIALIZED (SELECT d FROM t{j} UNION ALL SELECT d FROM p{k}), "
        "m{k} AS MATERIALIZED (SELECT o, least(now, coalesce(cost, now)) AS now FROM m{j} LEFT JOIN (SELECT o, cost FROM od WHERE d IN (SELECT d FROM p{k})) USING (o))",
        MEDIAN_STEPS,
    ).replace("p0 AS (SELECT -1 AS d WHERE false)", "t0 AS (SELECT -1 AS d WHERE false)")}
    {" UNION ALL ".join(f"SELECT {k} AS step, (SELECT d FROM p{k}) AS d, (SELECT sum(now) FROM m{k}) AS total_cost" for k in range(1, MEDIAN_STEPS + 1))}""",
)
def median_facilities(t):
    """Four facilities added greedily for the lowest total cost; suppliers out of reach cost 500."""
    return facility.greedy_median(od_table(t), od_origins(t), MEDIAN_STEPS, fail=500.0)


# shapes -------------------------------------------------------------------------------------


@query(
    "street_footprint",
    """WITH s AS (SELECT DISTINCT road, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM streets JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v),
    c AS (SELECT s.*, cx.x, cy.y, (cx.x + 0.5) * 0.003::double AS px, (cy.y + 0.5) * 0.003::double AS py FROM s,
      LATERAL (SELECT unnest(range(cast(floor((least(x1, x2) - 0.004) / 0.003) as int), cast(floor((greatest(x1, x2) + 0.004) / 0.003) as int) + 1)) AS x) cx,
      LATERAL (SELECT unnest(range(cast(floor((least(y1, y2) - 0.004) / 0.003) as int), cast(floor((greatest(y1, y2) + 0.004) / 0.003) as int) + 1)) AS y) cy),
    w AS (SELECT *, greatest(0, least(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS w FROM c)
    SELECT DISTINCT road, cast(x as int) AS x, cast(y as int) AS y FROM w
    WHERE sqrt((x1 + (x2 - x1) * w - px) ** 2 + (y1 + (y2 - y1) * w - py) ** 2) <= 0.004""",
)
def street_footprint(t):
    classed = t.streets().withColumn("road", F.element_at("highway", 1))
    segs = spatial.straight_edges(classed, t.nodes())
    return shapes.footprint(segs, 0.004, Grid(0.0, 0.0, 0.003, 0.003), ["road"])


@query(
    "distance_bands",
    """SELECT x, y, min(threshold) AS threshold FROM (SELECT x, y, CASE layer WHEN 'A' THEN 800 WHEN 'N' THEN 1600 ELSE 2400 END AS threshold
      FROM hazard) GROUP BY ALL""",
)
def distance_bands(t):
    layer = F.col("layer")
    cells = t.hazard().select("x", "y", F.when(layer == "A", 800).when(layer == "N", 1600).otherwise(2400).alias("threshold"))
    return shapes.distance_bands(cells)


@query("dissolved_zones", "SELECT DISTINCT layer, x, y FROM hazard")
def dissolved_zones(t):
    return shapes.dissolve(t.hazard(), ["layer"])


@query("label_points", "SELECT zone, round(cx, 4) AS x, round(cy, 4) AS y, round(r / sqrt(2), 4) AS radius FROM zones")
def label_points(t):
    out = shapes.label_points(t.zone_polygons())
    return out.select(
        "zone", (F.round("x", 4) + 0.0).alias("x"), (F.round("y", 4) + 0.0).alias("y"), F.round("radius", 4).alias("radius")
    )


@query(
    "place_density",
    """WITH q AS (SELECT count(*) AS n, min(lon) AS x1, max(lon) AS x2, min(lat) AS y1, max(lat) AS y2,
      least(stddev_samp(lon), (quantile_cont(lon, 0.75) - quantile_cont(lon, 0.25)) / 1.34) * 1.06 * count(*) ** -0.2 AS hx,
      least(stddev_samp(lat), (quantile_cont(lat, 0.75) - quantile_cont(lat, 0.25)) / 1.34) * 1.06 * count(*) ** -0.2 AS hy FROM points),
    g AS (SELECT x, y, x1 + (x2 - x1) * x / 24.0 AS gx, y1 + (y2 - y1) * y / 24.0 AS gy, hx, hy FROM q, (SELECT unnest(range(0, 25)) AS x), (SELECT unnest(range(0, 25)) AS y)),
    d AS (SELECT x, y, sum(exp(-0.5 * ((gx - lon) / hx) ** 2) * exp(-0.5 * ((gy - lat) / hy) ** 2)) AS d FROM g, points GROUP BY x, y)
    SELECT cast(x as int) AS x, cast(y as int) AS y, round((d - (SELECT min(d) FROM d)) / ((SELECT max(d) FROM d) - (SELECT min(d) FROM d)), 6) AS value FROM d""",
)
def place_density(t):
    return shapes.density(t.points(), 25, x="lon", y="lat").withColumn("value", F.round("value", 6))


@query(
    "rasterized_places",
    """SELECT cast(floor((lon + 180.0) / 7.3) as int) AS x, cast(floor((lat + 85.0) / 5.1) as int) AS y, arg_max(weight, id) AS value FROM points GROUP BY ALL""",
)
def rasterized_places(t):
    return shapes.rasterize(t.points(), Grid(-180.0, -85.0, 7.3, 5.1, 50, 40), "weight", "id")


@query(
    "interpolated_places",
    """WITH c AS (SELECT x, y, -180 + (x + 0.5) * 18.0 AS cx, -85 + (y + 0.5) * 17.0 AS cy FROM (SELECT unnest(range(0, 20)) AS x), (SELECT unnest(range(0, 10)) AS y)),
    d AS (SELECT x, y, weight, sqrt((lon - cx) ** 2 + (lat - cy) ** 2) AS d, row_number() OVER (PARTITION BY x, y ORDER BY sqrt((lon - cx) ** 2 + (lat - cy) ** 2), id) AS k FROM c, points)
    SELECT cast(x as int) AS x, cast(y as int) AS y, round(sum(weight / greatest(d, 1e-12)) / sum(1 / greatest(d, 1e-12)), 4) AS value FROM d WHERE k <= 3 GROUP BY x, y""",
)
def interpolated_places(t):
    out = shapes.interpolate(t.points(), Grid(-180.0, -85.0, 18.0, 17.0, 20, 10), "weight")
    return out.withColumn("value", F.round("value", 4))


@query(
    "gravity_access_with_unreached",
    """WITH RECURSIVE r(o, node, cost) USING KEY (o, node) AS (
      SELECT DISTINCT node, node, 0.0::double FROM facilities
      UNION SELECT o, v, min(cost) FROM (SELECT r.o, s.v, r.cost + s.length AS cost FROM r JOIN streets s ON s.u = r.node
        WHERE r.cost + s.length <= 700) n
        WHERE NOT EXISTS (SELECT 1 FROM recurring.r k WHERE k.o = n.o AND k.node = n.v AND k.cost <= n.cost) GROUP BY o, v),
    f AS (SELECT DISTINCT node FROM facilities)
    SELECT a.node AS o, round(sum((b.node % 7 + 1) * exp(-0.001 * coalesce(cost, 2000))), 6) AS score
    FROM f a CROSS JOIN f b LEFT JOIN r ON r.o = a.node AND r.node = b.node GROUP BY a.node""",
)
def gravity_access_with_unreached(t):
    """Facility scores where facilities out of reach count at a fail cost, without listing those pairs."""
    f = t.facilities().select("node").distinct()
    od = reach.od_costs(t.streets(), f, f, 700.0)
    ow = f.select(F.col("node").alias("o"), F.lit(1.0).alias("weight"))
    dw = f.select(F.col("node").alias("d"), (F.col("node") % 7 + 1).cast("double").alias("weight"))
    out = reach.gravity_access(od, ow, dw, [0.001], fail=2000.0)
    return out.select("o", F.round("`d_0.001`", 6).alias("score"))
