"""Artifact texts rendered from tables, so that queries parse what the oracle can work out from columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.session import read


def _text(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def _n(expr: str):
    return F.expr(expr).cast("string")


def _spread(df: DataFrame) -> DataFrame:
    """Small tables come as one split; texts that cost much to parse are dealt to all cores."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, ord, content: 100 orders a file, a job each. Box by customer (every seventh job has none); one or two upstreams."""
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    condition = F.when(k % 3 == 0, "").when(k % 3 == 1, _text("condition: s(J", _n("o_orderkey - 1"), ")\n")).otherwise(_text("condition: s(J", _n("o_orderkey - 1"), ") &\n  s(J", _n("o_orderkey - 2"), ")\n"))
    box = F.when(k % 7 == 0, "").otherwise(_text("box_name: BOX_", _n("o_custkey"), "\n"))
    command = F.when(F.col("o_orderstatus") == "F", _text("command: infa -start wf_", _n("o_custkey"), "\n")).otherwise(_text("command: run.sh ", _n("o_orderkey"), "\n"))
    job = _text("/* job ", k.cast("string"), " */\ninsert_job: J", k.cast("string"), "   job_type: CMD\n", box, command, condition, "\n")
    rows = o.select((F.floor(k / 100)).alias("ord"), F.struct(k.alias("k"), job.alias("job")).alias("j"))
    texts = rows.groupBy("ord").agg(F.array_sort(F.collect_list("j")).alias("js"))
    return texts.select(_text("jobs_", F.col("ord").cast("string"), ".jil").alias("file"), "ord", F.array_join(F.transform("js", lambda j: j["job"]), "").alias("content"))


def redefined_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of files: in the second every fifth job is defined again, in another box."""
    first = job_files(spark, sf_dir)
    o = read(spark, sf_dir, "orders").where("o_orderkey % 5 = 0")
    again = o.select(_text("again_", _n("o_orderkey"), ".jil").alias("file"), (F.col("o_orderkey") + 1_000_000_000).alias("ord"), _text("INSERT_JOB: J", _n("o_orderkey"), "\njob_type: BOX\njob_type: FT\nbox_name: NEW_", _n("o_orderkey % 10"), "\n").alias("content"))
    return first.unionByName(again)


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, event_type, ts, sql: a statement by event type, with names from the user."""
    e = read(spark, sf_dir, "events")
    u, v = _n("user_id"), _n("user_id % 7")
    sql = (
        F.when(F.col("event_type") == "view", _text("SELECT o.id AS order_id, c.name cust, o.qty * o.price AS amount FROM [stg].[o", u, "] o JOIN dbo.c", v, " AS c ON o.cid = c.id WHERE o.d > '2024-01-01'"))
        .when(F.col("event_type") == "click", _text("/* load */ INSERT INTO mart.f", u, " (a, b) SELECT s.a, EXTRACT(YEAR FROM s.d) AS b FROM raw.s", v, " s, raw.x WHERE s.k = x.k"))
        .when(F.col("event_type") == "purchase", _text("MERGE INTO mart.p", u, " t USING (SELECT id, q FROM raw.q", v, ") s ON (t.id = s.id) WHEN MATCHED THEN UPDATE SET t.q = s.q"))
        .when(F.col("event_type") == "signup", _text("WITH fresh AS (SELECT id FROM raw.n", u, ") UPDATE m SET flag = 1 FROM mart.m", v, " m JOIN fresh ON fresh.id = m.id"))
        .otherwise(_text("DELETE FROM t", u, " WHERE id IN (SELECT id FROM gone", v, ") -- from nowhere"))
    )
    return _spread(e).select("event_id", "event_type", "user_id", "ts", sql.alias("sql"))


def mapping_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, content: a mapping a part. Source A feeds an expression whose output port sums two inputs, which feeds target T."""
    p = read(spark, sf_dir, "part")
    k = _n("p_partkey")
    body = _text(
        '<?xml version="1.0"?>\n<!DOCTYPE POWERMART SYSTEM "powrmart.dtd">\n<POWERMART><REPOSITORY NAME="R"><FOLDER NAME="F', _n("p_size"), '">',
        '<SOURCE NAME="A', k, '" OWNERNAME="own"><SOURCEFIELD NAME="C1" DATATYPE="number" PRECISION="', _n("p_size"), '" SCALE="0" NULLABLE="NOTNULL"/></SOURCE><TARGET NAME="T', k, '"/>',
        '<MAPPING NAME="M', k, '"><TRANSFORMATION NAME="EXP" TYPE="Expression"><TRANSFORMFIELD NAME="IN1" PORTTYPE="INPUT"/><TRANSFORMFIELD NAME="IN2" PORTTYPE="INPUT"/>',
        '<TRANSFORMFIELD NAME="OUT1" PORTTYPE="OUTPUT" EXPRESSION="IIF(IN1 &gt; 0, IN1, IN2)"/><TRANSFORMFIELD NAME="OUT2" PORTTYPE="OUTPUT" EXPRESSION="IN2"/>',
        '<TABLEATTRIBUTE NAME="Sql Query" VALUE="select C1 from A', k, '"/></TRANSFORMATION>',
        '<INSTANCE NAME="SRC" TYPE="SOURCE" TRANSFORMATION_NAME="A', k, '"/><INSTANCE NAME="EXP" TYPE="TRANSFORMATION" TRANSFORMATION_NAME="EXP"/><INSTANCE NAME="TGT" TYPE="TARGET" TRANSFORMATION_NAME="T', k, '"/>',
        '<CONNECTOR FROMINSTANCE="SRC" FROMFIELD="C1" TOINSTANCE="EXP" TOFIELD="IN1"/><CONNECTOR FROMINSTANCE="SRC" FROMFIELD="C', _n("2 + p_partkey % 3"), '" TOINSTANCE="EXP" TOFIELD="IN2"/>',
        '<CONNECTOR FROMINSTANCE="EXP" FROMFIELD="OUT1" TOINSTANCE="TGT" TOFIELD="X"/><CONNECTOR FROMINSTANCE="EXP" FROMFIELD="OUT2" TOINSTANCE="TGT" TOFIELD="Y"/></MAPPING>',
        '<SESSION NAME="s_', k, '" MAPPINGNAME="M', _n("p_partkey + IF(p_partkey % 10 = 0, 1000000, 0)"), '"/></FOLDER></REPOSITORY></POWERMART>',
    )
    return _spread(p).select(_text("part_", k, ".xml").alias("file"), body.alias("content"))


def workflow_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, content: a workflow a customer, whose session runs a mapping that declares its own tables.

    The target gets two columns through a source qualifier with SQL and one directly; every second mapping calls a
    procedure first.
    """
    c = read(spark, sf_dir, "customer")
    k = _n("c_custkey")
    call = F.when(F.col("c_custkey") % 2 == 0, _text('<TABLEATTRIBUTE NAME="Pre SQL" VALUE="call own.fill_', k, '(1)"/>')).otherwise("")
    body = _text(
        '<POWERMART><REPOSITORY NAME="R"><FOLDER NAME="folder"><MAPPING NAME="m_', k, '"><SOURCE NAME="S_', k, '" OWNERNAME="own"/><TARGET NAME="T_', k, '" OWNERNAME="dw"/>',
        '<INSTANCE NAME="src" TYPE="source" TRANSFORMATIONNAME="S_', k, '"/><INSTANCE NAME="tgt" TYPE="target" TRANSFORMATIONNAME="T_', k, '"/>',
        '<INSTANCE NAME="sq" TYPE="TRANSFORMATION" TRANSFORMATIONNAME="sq" TRANSFORMATION_TYPE="source qualifier"/>',
        '<TRANSFORMATION NAME="sq" TYPE="Source Qualifier"><TRANSFORMFIELD NAME="ID" PORTTYPE="INPUT/OUTPUT"/><TABLEATTRIBUTE NAME="Sql Query" VALUE="select s.ID, s.N', _n("c_nationkey"), " as name from own.S_", k, ' s"/></TRANSFORMATION>',
        '<CONNECTOR FROMINSTANCE="src" FROMFIELD="ID" TOINSTANCE="sq" TOFIELD="ID"/><CONNECTOR FROMINSTANCE="sq" FROMFIELD="ID" TOINSTANCE="tgt" TOFIELD="ID"/>',
        '<CONNECTOR FROMINSTANCE="src" FROMFIELD="N', _n("c_nationkey"), '" TOINSTANCE="sq" TOFIELD="NAME"/><CONNECTOR FROMINSTANCE="sq" FROMFIELD="NAME" TOINSTANCE="tgt" TOFIELD="NAME"/>',
        '<CONNECTOR FROMINSTANCE="src" FROMFIELD="D', _n("c_nationkey"), '" TOINSTANCE="tgt" TOFIELD="D"/>', call, '</MAPPING><SESSION NAME="s_', k, '" MAPPINGNAME="m_', k, '"/>',
        '<WORKFLOW NAME="wf_', k, '"><TASKINSTANCE NAME="s_', k, '" TASKTYPE="Session"/><TASKINSTANCE NAME="Start" TASKTYPE="Start"/><WORKFLOWLINK FROMTASK="Start" TOTASK="s_', k, '"/></WORKFLOW></FOLDER></REPOSITORY></POWERMART>',
    )
    return _spread(c).select(_text("wf_", k, ".xml").alias("file"), body.alias("content"))


def package_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, content: a package a customer; a container with two tasks, SQL as an attribute and as text."""
    c = read(spark, sf_dir, "customer")
    k = _n("c_custkey")
    body = _text(
        '<DTS:Executable xmlns:DTS="www.microsoft.com/SqlServer/Dts" xmlns:SQLTask="www.microsoft.com/sqlserver/dts/tasks/sqltask" DTS:ObjectName="P', k, '"><DTS:Executables>',
        '<DTS:Executable DTS:ObjectName="Box" DTS:ExecutableType="STOCK:SEQUENCE"><DTS:Executables>',
        '<DTS:Executable DTS:ObjectName="T1" DTS:ExecutableType="Microsoft.ExecuteSQLTask"><DTS:ObjectData><SQLTask:SqlTaskData SQLTask:SqlStatementSource="INSERT INTO dw.c', k, ' SELECT a FROM src.n', _n("c_nationkey"), '"/></DTS:ObjectData></DTS:Executable>',
        '<DTS:Executable DTS:ObjectName="T2" DTS:ExecutableType="Microsoft.Pipeline"><DTS:ObjectData><SqlStatementSource>SELECT 1 FROM x', k, "</SqlStatementSource></DTS:ObjectData></DTS:Executable>",
        "</DTS:Executables></DTS:Executable></DTS:Executables></DTS:Executable>",
    )
    return _spread(c).select(_text("/pk/p_", k, ".dtsx").alias("file"), body.alias("content"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A geography dimension (world, regions, nations, customers), and an accounts dimension of parts with formulas."""
    r, n, c, p = (read(spark, sf_dir, t) for t in ("region", "nation", "customer", "part"))
    symbol = lambda k: F.element_at(F.array(*[F.lit(x) for x in "+-*/%~^"]), (F.expr(k) % 7 + 1).cast("int"))
    cols = lambda df, dim, n_, ordinal, name, parent, level, key, formula: df.select(F.lit("app").alias("app"), F.lit("cube").alias("cube"), F.lit(dim).alias("dim"), F.lit(n_).alias("dim_ord"), ordinal.cast("long").alias("ordinal"), name.alias("name"), parent.cast("string").alias("parent"), F.lit(level).alias("level"), symbol(key).alias("consolidation"), formula.cast("string").alias("formula"))
    none = F.lit(None)
    region, nation = F.col("r_name"), _text("N", _n("n_nationkey"))
    geo = cols(r, "Geo", 0, F.col("r_regionkey"), region, none, 0, "r_regionkey", none)
    geo = geo.unionByName(cols(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey), "Geo", 0, F.col("n_nationkey") + 100, nation, region, 1, "n_nationkey", none))
    geo = geo.unionByName(cols(c, "Geo", 0, F.col("c_custkey") + 1000, _text("C", _n("c_custkey")), _text("N", _n("c_nationkey")), 2, "c_custkey", none))
    formula = F.when(F.col("p_partkey") % 2 == 0, _text('@SUM("P', _n("p_partkey + 1"), '", "C', _n("p_size"), '") - Geo->N1;')).otherwise(none)
    return geo.unionByName(cols(p, "Acct", 1, F.col("p_partkey"), _text("P", _n("p_partkey")), F.when(F.col("p_size") == 1, "missing"), 0, "p_partkey", formula))


def calc_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """script, app, cube, content: a script a supplier, with two levels of FIX and the other operations after them."""
    s = read(spark, sf_dir, "supplier")
    k, n = _n("s_suppkey"), _n("s_nationkey")
    body = _text("/* script */\nSET AGGMISSG ON;\nVAR v = ", n, ";\nFIX (Scenario->Actual, \"Y", n, '")\n  FIX (Market->"M', k, '")\n    "P', k, '" = "A', n, '" - "B', k, '";\n  ENDFIX\n  AGG("Market", Product);\nENDFIX;\n', "DATACOPY Budget TO Forecast_", k, ";\nCALC DIM(Year);\nCLEARDATA Old;\n")
    return s.select(_text("S", k).alias("script"), F.lit("app").alias("app"), F.lit("cube").alias("cube"), body.alias("content"))


def load_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    source = F.when(F.col("s_suppkey") % 2 == 0, '{"type":"sql","connection":"db1","sql":"select 1"}').otherwise(_text('{"type":"file","name":"f', _n("s_suppkey"), '.csv"}'))
    detail = _text('{"name":"r', _n("s_suppkey"), '","dataSource":', source, ',"fieldMappings":[{"fieldNumber":1,"dimension":"Market","sourceField":"mkt"},{"fieldNumber":2,"dimension":"N', _n("s_nationkey"), '","transformation":"upper"}]}')
    return s.select(F.lit("app").alias("app"), F.lit("cube").alias("cube"), F.when(F.col("s_suppkey") % 3 == 0, "dimension").otherwise("data").alias("rule_type"), _text("r", _n("s_suppkey")).alias("rule"), detail.alias("detail"))


def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, ord, content: record layouts in both syntaxes, by the parity of the part."""
    p = read(spark, sf_dir, "part")
    typed = _text("record\n  // a part\n  string(", _n("p_size"), ") name;\n  decimal(10) /* money */ price;\n  date(\"YYYY-MM-DD\") made_", _n("p_partkey"), ";\nend;\n")
    named = _text("# a part\nname : string(", _n("p_size"), ")\nprice : decimal(10,2)\n")
    return p.select(_text("/dml/part_", _n("p_partkey"), ".dml").alias("file"), F.col("p_partkey").alias("ord"), F.when(F.col("p_partkey") % 2 == 0, typed).otherwise(named).alias("content"))


def transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    double = _text("out::f(in) =\nbegin\n  out.full_name :: string_concat(in.first, in.l", _n("p_size"), ");\n  out.id :: in.key;\nend;\n")
    single = _text("# old\nfull_name = first;\nid = k", _n("p_size"), ";\n")
    return p.select(_text("/xfr/part_", _n("p_partkey"), ".xfr").alias("file"), F.col("p_partkey").alias("ord"), F.when(F.col("p_partkey") % 2 == 0, double).otherwise(single).alias("content"))


def io_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, ord, content: graphs with inputs and outputs; odd suppliers' graphs are given twice, the second time without outputs."""
    s = read(spark, sf_dir, "supplier")
    one = s.select(_text("io_", _n("s_suppkey"), ".json").alias("file"), F.col("s_suppkey").alias("ord"), _text('{"g', _n("s_suppkey"), '":{"inputs":["in.n', _n("s_nationkey"), '","in.b"],"outputs":["out.s', _n("s_suppkey"), '"]},"x', _n("s_suppkey"), '":5}').alias("content"))
    two = s.where("s_suppkey % 2 = 1").select(_text("io2_", _n("s_suppkey"), ".json").alias("file"), (F.col("s_suppkey") + 1_000_000_000).alias("ord"), _text('{"g', _n("s_suppkey"), '":{"inputs":["late.a"],"outputs":null}}').alias("content"))
    return one.unionByName(two)


def edge_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage edges out of lineitem: supplier's table to part's table, with procedure, folder, workflow and mapping."""
    l = read(spark, sf_dir, "lineitem")  # noqa: E741
    return l.select(
        _text("src.s", _n("l_suppkey")).alias("source_dataset"), _text("c", _n("l_linenumber")).alias("source_column"), _text("dw.p", _n("l_partkey")).alias("target_dataset"), _text("t", _n("l_linenumber % 3")).alias("target_column"),
        F.when(F.col("l_returnflag") == "R", "SQL").when(F.col("l_returnflag") == "A", "CONNECTOR").otherwise("PROCEDURE").alias("kind"), _text("e", _n("l_orderkey")).alias("expression"),
        F.round(F.col("l_discount") + 0.5, 2).alias("confidence"), F.col("l_linenumber").alias("step_order"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
        F.when(F.col("l_returnflag") == "N", _text("proc", _n("l_suppkey % 11"))).alias("procedure"), _text("F", _n("l_suppkey % 5")).alias("folder"), _text("wf", _n("l_partkey % 50")).alias("workflow"), _text("m", _n("l_partkey")).alias("mapping"),
    )
