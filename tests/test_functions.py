import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.functions import scalars, sqlscan, urns


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expr.alias("x")).first().x


def test_urns(spark):
    flow = urns.flow_urn("autosys", F.col("f"))
    assert one(spark, urns.job_urn(flow, "j"), f="box") == "urn:li:dataJob:(urn:li:dataFlow:(autosys,box,PROD),j)"
    assert one(spark, urns.dataset_urn("oracle", F.col("f"), "DEV", "P1"), f="s.t") == "urn:li:dataset:(urn:li:dataPlatform:oracle,P1.s.t,DEV)"
    assert one(spark, urns.field_urn(urns.dataset_urn("x", F.col("f")), "c"), f="t") == "urn:li:schemaField:(urn:li:dataset:(urn:li:dataPlatform:x,t,PROD),c)"
    job, dataset = urns.procedure_urns(F.col("f"))
    assert one(spark, job, f="own.p").startswith("urn:li:dataJob:(urn:li:dataFlow:(oracle,stored_procedures,PROD),own.p")
    assert one(spark, dataset, f="own.p") == "urn:li:dataset:(urn:li:dataPlatform:oracle,own.p,PROD)"


@pytest.mark.parametrize(
    ("rule", "db", "schema", "name", "want"),
    [
        (urns.normalise_parsed, "d", "s", "t", "d.s.t"), (urns.normalise_parsed, "d", None, "t", "t"), (urns.normalise_parsed, None, "s", "t", "s.t"),
        (urns.normalise_parsed, "d", None, "s.t", "d.s.t"), (urns.normalise_parsed, "d", "s", "a.b.c", "a.b.c"),
        (urns.normalise_text, "d", "s", "[t]", "d.s.t"), (urns.normalise_text, "d", None, "t", "t"), (urns.normalise_text, "d", None, "x.t", "d.x.t"),
        (urns.normalise_observed, "d", None, "t", "d.t"), (urns.normalise_observed, "d", "s", "a.b.c.e", "b.c.e"),
    ],
)
def test_table_names(spark, rule, db, schema, name, want):
    assert one(spark, rule(F.col("n"), db, schema), n=name) == want


def test_text_functions(spark):
    assert one(spark, scalars.port_references(F.col("e")), e="IIF(A > 0, NVL(B_1, 'X'), lower_c)") == ["A", "B_1", "X"]
    assert one(spark, scalars.upstream_jobs_raw(F.col("e")), e="s(A) & success(B) | f(C,12.00) & s(A)") == ["A", "C,12.00"]
    assert one(spark, scalars.upstream_jobs(F.col("e")), e="s(A) & success(B) | f(C,12.00) & v(G) = 1") == ["A", "B", "C"]
    assert one(spark, scalars.blank_to_null(F.col("e")), e="  ") is None
    assert one(spark, scalars.quote_path(F.col("e")), e="a b/c") == "a%20b%2Fc"
    assert one(spark, scalars.written_tables_hint(F.col("e")), e="INSERT into x") is False
    call = one(spark, scalars.procedure_call(F.col("e")), e="begin own.load_it(1); end;")
    assert (call.schema, call.name) == ("own", "load_it")
    assert one(spark, scalars.procedure_call(F.col("e")), e="select 1") is None
    assert one(spark, scalars.safe_int(F.col("e")), e="x") is None


def test_fix_filter(spark):
    fix = F.create_map(F.lit("Year"), F.array(F.lit("Q1"), F.lit("Q2")), F.lit("_unresolved_"), F.array(F.lit("x")))
    assert one(spark, scalars.fix_filter(fix), e="") == 'Year IN ("Q1", "Q2")'
    assert one(spark, scalars.fix_filter(F.create_map(F.lit("_unresolved_"), F.array(F.lit("x")))), e="") is None


@pytest.mark.parametrize(
    ("sql", "inputs", "outputs"),
    [
        ("SELECT a FROM dbo.t1 b JOIN [x].[t 2] AS z ON b.i=z.i WHERE EXISTS (SELECT 1 FROM t3)", ["dbo.t1", "x.t 2", "t3"], []),
        ("INSERT INTO dw.f (a,b) SELECT s.a, EXTRACT(YEAR FROM s.d) y FROM stg.s s, stg.t t", ["stg.s", "stg.t"], ["dw.f"]),
        ("WITH c AS (SELECT * FROM raw.a) INSERT INTO x SELECT * FROM c", ["raw.a"], ["x"]),
        ("UPDATE t SET a=1 FROM dbo.orders t JOIN y ON t.i=y.i", ["y"], ["dbo.orders"]),
        ("MERGE INTO tgt t USING (SELECT id FROM src) s ON t.id=s.id WHEN MATCHED THEN UPDATE SET t.a=s.a", ["src"], ["tgt"]),
        ("DELETE FROM a.b WHERE x IN (SELECT x FROM c)", ["c"], ["a.b"]),
        ("delete t", [], ["t"]),
        ("CREATE TABLE n AS SELECT * FROM o; SELECT 1 FROM p -- from q", ["o", "p"], ["n"]),
        ("CREATE TABLE n (a int, b int)", [], ["n"]),
        ("SELECT TOP 10 x FROM y WITH (NOLOCK) WHERE z = 'from k'", ["y"], []),
        ("", [], []), ("not sql at all", [], []),
    ],
)
def test_statement_tables(sql, inputs, outputs):
    assert sqlscan.tables(sql) == (inputs, outputs)


def test_statement_columns():
    sql = "SELECT o.id AS oid, c.name cname, o.a + c.b total, upper(x), * FROM dw.orders o JOIN dw.cust c ON o.c = c.c"
    got = sqlscan.column_lineage(sql, {"dw.orders": ["x", "id"], "dw.cust": ["name"]})
    assert got[:4] == [("oid", [("dw.orders", "id")]), ("cname", [("dw.cust", "name")]), ("total", [("dw.orders", "a"), ("dw.cust", "b")]), ("expr_3", [("dw.orders", "x")])]
    assert [g[0] for g in got[4:]] == ["x", "id", "name"]
    assert sqlscan.column_lineage("SELECT a FROM t JOIN u ON t.k = u.k") == [("a", [("", "a")])]


@given(st.text(max_size=200))
def test_scanner_takes_any_text(text):
    sqlscan.tables(text)
    sqlscan.column_lineage(text)


def test_table_function_in_sql(spark):
    sqlscan.register(spark)
    got = spark.sql("SELECT role, table FROM VALUES ('insert into a select * from b') AS s(q), LATERAL sql_tables(s.q, 'D', 'S')").collect()
    assert sorted(map(tuple, got)) == [("input", "D.S.b"), ("output", "D.S.a")]


def test_names_agree_with_sparks_parser(spark):
    """Spark's own parser names the same tables for statements that both understand."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    for sql in ("SELECT a.x FROM s.t a JOIN u.v b ON a.i = b.i", "SELECT * FROM (SELECT y FROM p.q) z WHERE y IN (SELECT k FROM r.w)", "WITH c AS (SELECT 1 AS x FROM m.n) SELECT * FROM c JOIN o.p"):
        import re

        plan = parser.parsePlan(sql).toString()
        named = {".".join(p.strip() for p in m.split(",")) for m in re.findall(r"UnresolvedRelation \[([^\]]+)\]", plan)} - {"c"}
        assert set(sqlscan.tables(sql)[0]) == named
