import json
import random

import pytest

from pyspark.sql import functions as F

from loomline.operators import calc, graph, lineage, records


def closure_by_hand(edges):
    seen = set(edges)
    while True:
        new = {(a, d) for a, b in seen for c, d in edges if b == c} - seen
        if not new:
            return seen
        seen |= new


def test_closure_and_reach(spark):
    random.seed(3)
    edges = sorted({(random.randrange(14), random.randrange(14)) for _ in range(22)})
    df = spark.createDataFrame(edges, "src long, dst long")
    want = closure_by_hand(edges)
    assert {tuple(r) for r in graph.closure(df).collect()} == want
    starts = spark.createDataFrame([(0,), (5,)], "start long")
    got = {(r.start, r.node) for r in graph.reach(df, starts).collect()}
    assert got == {(a, b) for a, b in want if a in (0, 5)} | {(0, 0), (5, 5)}
    stopped = graph.reach(df, starts, stop=spark.createDataFrame([(0,)], "node long"))
    assert {r.node for r in stopped.where("start = 0").collect()} == {0}


def test_levels_with_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (4, 5), (5, 4), (5, 6)], "src long, dst long")
    nodes = spark.createDataFrame([(i, i) for i in range(1, 8)], "node long, ord long")
    assert {r.node: r.level for r in graph.levels(nodes, edges).collect()} == {1: 0, 2: 1, 3: 2, 4: None, 5: None, 6: None, 7: 0}
    order = [r.node for r in graph.topological_order(nodes, edges).orderBy("position").collect()]
    assert order == [1, 7, 2, 3, 4, 5, 6]


def test_hierarchy(spark):
    rows = [("d", 0, "a", None), ("d", 1, "b", "a"), ("d", 2, "c", "a"), ("d", 3, "e", "c"), ("d", 4, "x", "gone")]
    m = spark.createDataFrame(rows, "dim string, ordinal long, name string, parent string")
    assert {r.name: r.children for r in graph.hierarchy(m, ("dim",)).collect()} == {"a": ["b", "c"], "b": [], "c": ["e"], "e": [], "x": []}
    assert {r.name for r in graph.roots(m, ("dim",)).collect()} == {"a", "x"}
    assert {r.name for r in graph.leaves(m, ("dim",)).collect()} == {"b", "e", "x"}
    assert {r.path for r in graph.paths(m, ("dim",)).collect()} == {"a", "a.b", "a.c", "a.c.e", "x"}


def test_log_is_numbered_and_upserted(spark):
    one = spark.range(3).select(F.concat(F.lit("u"), "id").alias("u"))
    a = records.flow_info(one, F.col("u"), "n", phase=1, k1=F.col("u"))
    b = records.dataset_properties(one.union(one), F.col("u"), "d", phase=0, k1=F.col("u"))
    log = records.emit([a, b], "p")
    rows = log.orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(9)) and rows[0].workunit_id == "p:0"
    assert [r.aspect_name for r in rows] == ["datasetProperties"] * 6 + ["dataFlowInfo"] * 3
    assert json.loads(rows[-1].payload) == {"name": "n"}
    last = records.latest(log).collect()
    assert len(last) == 6 and {r.seq for r in last} == {1, 3, 5, 6, 7, 8}
    assert {(r.aspect_name, r.emitted, r.entities) for r in records.report(log).collect()} == {("datasetProperties", 6, 3), ("dataFlowInfo", 3, 3)}


def test_aspect_payloads(spark):
    one = spark.range(1)
    fine = F.array(F.struct(F.array(F.lit("a")).alias("upstreams"), F.array(F.lit("b")).alias("downstreams"), F.lit("X").alias("transformOperation")))
    parts = [
        records.job_io(one, F.lit("j"), F.array(F.lit("i")), None, F.array(F.lit("k")), at_ms=F.lit(5)), records.upstream_lineage(one, F.lit("d"), F.array(F.lit("u")), fine), records.platform_instance(one, F.lit("d"), "oracle", "P"),
        records.schema_metadata(one, F.lit("d"), "oracle", F.array(F.struct(F.lit("f").alias("fieldPath")))), records.status(one, F.lit("d"), "dataset"), records.global_tags(one, F.lit("d"), "dataset", F.array(F.lit("t"))), records.glossary_terms(one, F.lit("d"), "dataset", F.array(F.lit("g"))),
    ]
    got = {r.aspect_name: json.loads(r.payload) for p in parts for r in p.collect()}
    assert got["dataJobInputOutput"]["inputDatajobEdges"][0] == {"destinationUrn": "k", "created": {"time": 5, "actor": records.ACTOR}}
    assert got["dataJobInputOutput"]["outputDatasets"] == [] and "outputDatasetEdges" not in got["dataJobInputOutput"]
    assert got["upstreamLineage"]["upstreams"] == [{"dataset": "u", "type": "TRANSFORMED"}] and got["upstreamLineage"]["fineGrainedLineages"][0]["upstreams"] == ["a"]
    assert got["globalTags"]["tags"] == ["urn:li:tag:t"] and got["status"] == {"removed": False}


def test_name_matching(spark):
    names = spark.createDataFrame([("t",), ("a.t",), ("zz",)], "name string")
    known = spark.createDataFrame([("x.A.T", 1), ("T", 2), ("a.tt", 0)], "table string, ord long")
    assert {tuple(r)[:2] for r in lineage.match_tables(names, known).collect()} == {("t", "x.A.T"), ("a.t", "x.A.T")}


SCRIPT = """SET UPDATECALC OFF;
SET MODE = TOP;
VAR v = 1.5;
/* c */
FIX ("Actual", Market->"East")
  FIX (Year->Q1)
    "Profit" = "Sales" - "COGS";
  ENDFIX
  AGG("Market", Product);
ENDFIX
DATACOPY "Budget" TO "Forecast";
CALC DIM (Year, "Scenario");
CLEARDATA "Old";
CALC ALL;
"Margin" = @SUM("A", [B]) + Year->Q2;
"""


def test_calc_script():
    ops, refs = calc.parse_script(SCRIPT)
    assert [(o.kind, o.line) for o in ops] == [("FORMULA", 7), ("AGGREGATION", 9), ("DATACOPY", 11), ("CALC_DIM", 12), ("CLEAR", 13), ("AGGREGATION", 14), ("FORMULA", 15)]
    assert ops[0].fix == {"Market": ["East"], "_unresolved_": ["Actual"], "Year": ["Q1"]} and ops[1].fix == {"Market": ["East"], "_unresolved_": ["Actual"]} and ops[2].fix == {}
    assert ops[0].targets == ["Profit"] and ops[0].sources == ["Sales", "COGS"] and ops[6].sources == ["A", "B", "Year->Q2"]
    assert (ops[2].source_region, ops[2].target_region) == ('"Budget"', '"Forecast"') and ops[3].targets == ["Year", "Scenario"] and ops[5].targets == ["ALL"]
    assert calc.variables(SCRIPT) == [("UPDATECALC", "OFF", "global"), ("MODE", "TOP", "global"), ("v", "1.5", "local")]
    assert refs["Year"] == ["Q2"]
    assert calc.parse_script("ENDFIX;\nENDFIX;")[0] == [] and calc.parse_script(None)[0] == []


def test_calc_lineage(spark):
    s = spark.createDataFrame([("s", "a", "c", SCRIPT), ("e", "a", "c", ""), ("n", "a", "c", None)], "script string, app string, cube string, content string")
    rows = {(r.source_field, r.target_field, r.transformation_type, r.filter) for r in calc.all_lineage(scripts=s).collect()}
    assert ("Sales", "Profit", "calc_script_formula", 'Market IN ("East") AND Year IN ("Q1")') in rows and ("Year.*", "Year.*", "calc_dim", None) in rows
    assert {tuple(r) for r in calc.script_variables(s).select("name", "value", "scope").collect()} == set(calc.variables(SCRIPT))
    members = spark.createDataFrame([("a", "c", "D", 0, 0, "p", None, "+", None), ("a", "c", "D", 0, 1, "k", "p", "-", None), ("a", "c", "E", 1, 0, "f", None, "+", "@AVG([k]) + @MIN('zz') + G->q")], "app string, cube string, dim string, dim_ord int, ordinal long, name string, parent string, consolidation string, formula string")
    got = {(r.source_field, r.target_field, r.aggregation, r.transformation_type) for r in calc.all_lineage(members=members).collect()}
    assert got == {("D.k", "D.p", "SUBTRACT", "consolidation"), ("D.k", "E.f", "MIN", "member_formula"), ("E.zz", "E.f", "MIN", "member_formula"), ("G.q", "E.f", "MIN", "member_formula")}


def test_walks_are_whole_or_raise(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)], "src long, dst long")
    starts = spark.createDataFrame([(0,)], "start long")
    assert graph.reach(edges, starts).count() == 7 == graph.reach(edges, starts, max_rounds=6).count()
    with pytest.raises(ValueError):
        graph.reach(edges, starts, max_rounds=3)
    assert graph.closure(edges).count() == 21


def test_packed_walks_equal_rounds(spark, monkeypatch):
    """Scopes small enough for one worker and those walked by rounds give the same rows; cycles and ends in the middle included."""
    from loomline.operators import graph

    edges = [(g, f"n{i}", f"n{j}") for g in ("a", "b") for i, j in ((1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (1, 6))] + [("c", "n1", "n2")]
    e = spark.createDataFrame(edges, "g string, src string, dst string")
    s = spark.createDataFrame([("a", "n1"), ("b", "n2"), ("b", "n4"), ("c", "n2"), ("d", "n9")], "g string, start string")
    x = spark.createDataFrame([("a", "n4"), ("a", "n6"), ("b", "n4"), ("b", "n3"), ("c", "n2"), ("c", "n1")], "g string, node string")
    got = []
    for packed in (5000, 5, 0):  # all, some, none
        monkeypatch.setattr(graph, "PACKED", packed)
        got.append(sorted(map(tuple, graph.reach_ends(e, s, x, ("g",)).collect())))
    assert got[0] == got[1] == got[2] == [("a", "n1", "n4", 3), ("a", "n1", "n6", 1), ("b", "n2", "n3", 1), ("b", "n4", "n4", 0), ("c", "n2", "n2", 0)]


def test_levels_of_cycles_loops_and_strangers(spark):
    from loomline.operators import graph

    nodes = spark.createDataFrame([(i,) for i in range(8)], "node long")
    edges = spark.createDataFrame([(0, 1), (0, 2), (1, 2), (2, 3), (3, 4), (4, 3), (5, 5), (9, 6), (7, 99)], "src long, dst long")
    assert {r.node: r.level for r in graph.levels(nodes, edges).collect()} == {0: 0, 1: 1, 2: 2, 3: None, 4: None, 5: None, 6: 0, 7: 0}
    assert graph.levels(nodes.limit(0), edges).count() == 0


def test_stitch(spark):
    from loomline.operators import records

    job = "urn:li:dataJob:(urn:li:dataFlow:(x,f,PROD),j)"
    set_ = "urn:li:dataset:(urn:li:dataPlatform:o,a.b,PROD)"
    make = lambda rows: spark.createDataFrame(rows, "entity_urn string, payload string")
    one = make([(job, f'{{"upstreams":["urn:li:schemaField:({set_},c)"]}}'), (job, None)])
    two = make([(set_, "{}"), ("urn:other", f'"{job}"')])
    got = {r.urn: (r.emitted_by, r.named_by) for r in records.stitch({"one": one, "two": two, "none": make([])}).collect()}
    assert got == {job: (["one"], ["two"]), set_: (["two"], ["one"])}
