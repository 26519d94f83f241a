"""Mapping exports in XML: one reader for both dialects (tables inside the mapping, or beside it in the folder).

The XML is parsed by Spark's own row parser with explicit schemas; everything after that is projection and explode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.scalars import blank_to_null, safe_int, sql_attribute

_S = "string"
_ATTR = "TABLEATTRIBUTE array<struct<_NAME:string,_VALUE:string>>"
_FIELD = "array<struct<_NAME:string,_DATATYPE:string,_PRECISION:string,_SCALE:string,_NULLABLE:string,_FIELDNUMBER:string>>"
_TABLE = f"struct<_NAME:string,_OWNERNAME:string,_DBDNAME:string,_DATABASETYPE:string,{_ATTR.replace(' ', ':', 1)},SOURCEFIELD:{_FIELD},TARGETFIELD:{_FIELD}>"
_PORT = "array<struct<_NAME:string,_PORTTYPE:string,_DATATYPE:string,_EXPRESSION:string,_TRANSFORMATIONNAME:string,_TRANSFORMATIONINSTANCENAME:string>>"
_TRANSFORMATION = f"array<struct<_NAME:string,_TYPE:string,_REUSABLE:string,TRANSFORMFIELD:{_PORT},{_ATTR.replace(' ', ':', 1)}>>"
_INSTANCE = f"array<struct<_NAME:string,_TYPE:string,_TRANSFORMATIONNAME:string,_TRANSFORMATION_NAME:string,_TRANSFORMATION_TYPE:string,_REFOBJECTNAME:string,{_ATTR.replace(' ', ':', 1)}>>"
_CONNECTOR = "array<struct<_FROMINSTANCE:string,_FROMFIELD:string,_TOINSTANCE:string,_TOFIELD:string>>"
_MAPPING = f"_NAME string, SOURCE array<{_TABLE}>, TARGET array<{_TABLE}>, TRANSFORMATION {_TRANSFORMATION}, INSTANCE {_INSTANCE}, TRANSFORMFIELD {_PORT}, CONNECTOR {_CONNECTOR}, {_ATTR}"
_SESSION = f"array<struct<_NAME:string,_MAPPINGNAME:string,CONNECTIONREFERENCE:array<struct<_CNXREFNAME:string,_CONNECTIONNAME:string,_CONNECTIONTYPE:string>>,ATTRIBUTE:array<struct<_NAME:string,_VALUE:string>>>>"
_WORKFLOW = "array<struct<_NAME:string,TASK:array<struct<_NAME:string,_TYPE:string,ATTRIBUTE:array<struct<_NAME:string,_VALUE:string>>>>,TASKINSTANCE:array<struct<_NAME:string,_TASKNAME:string,_TASKTYPE:string>>,WORKFLOWLINK:array<struct<_FROMTASK:string,_TOTASK:string>>,ATTRIBUTE:array<struct<_NAME:string,_VALUE:string>>>>"
_struct = lambda ddl: "struct<" + ",".join(":".join(x.split(" ", 1)) for x in ddl.split(", ")) + ">"
_FOLDER = f"_NAME string, SOURCE array<{_TABLE}>, TARGET array<{_TABLE}>, TRANSFORMATION {_TRANSFORMATION}, MAPPING array<{_struct(_MAPPING)}>, SESSION {_SESSION}, WORKFLOW {_WORKFLOW}"


def read_folders(files: DataFrame) -> DataFrame:
    """file, folder, x (the parsed folder) for each FOLDER, and for text without one, of its mappings and workflows.

    files: file, content. A text that is no XML gives no folder; `unreadable` reports it.
    """
    head = F.regexp_replace("content", r"(?s)^\s*(<\?xml.*?\?>)?\s*(<!DOCTYPE[^>\[]*(\[.*?\])?\s*>)?", "")
    bodies = F.regexp_extract_all(head, F.lit(r"(?s)<FOLDER\b.*?</FOLDER>"), 0)
    loose = F.concat(F.lit("<FOLDER>"), F.array_join(F.regexp_extract_all(head, F.lit(r"(?s)<MAPPING\b.*?</MAPPING>|<WORKFLOW\b.*?</WORKFLOW>|<SESSION\b.*?</SESSION>"), 0), ""), F.lit("</FOLDER>"))
    df = files.select("file", F.explode(F.when(F.size(bodies) > 0, bodies).otherwise(F.array(loose))).alias("body"))
    return df.select("file", F.from_xml("body", _FOLDER).alias("x")).select("file", F.coalesce("x._NAME", F.lit("")).alias("folder"), "x")


def unreadable(files: DataFrame) -> DataFrame:
    """file, error: texts that hold neither a folder nor a mapping nor a workflow."""
    return files.where(~F.coalesce(F.col("content").rlike(r"<(FOLDER|MAPPING|WORKFLOW)\b"), F.lit(False))).select("file", F.lit("no folder, mapping or workflow").alias("error"))


def _attribute(attrs: Column, names: list[str]) -> Column:
    return blank_to_null(F.get(F.transform(F.filter(attrs, lambda a: F.lower(F.trim(a["_NAME"])).isin(names)), lambda a: a["_VALUE"]), 0))


def _mappings(folders: DataFrame) -> DataFrame:
    return folders.select("file", "folder", F.col("x.SOURCE").alias("fs"), F.col("x.TARGET").alias("ft"), F.col("x.TRANSFORMATION").alias("fx"), F.explode("x.MAPPING").alias("m")).withColumn("mapping", F.col("m._NAME"))


def mappings(folders: DataFrame) -> DataFrame:
    """file, folder, mapping: the mappings of each export, once."""
    return folders.select("file", "folder", F.explode("x.MAPPING").alias("m")).select("file", "folder", F.col("m._NAME").alias("mapping")).distinct()


def tables(folders: DataFrame) -> DataFrame:
    """folder, scope (a mapping, or empty for the folder), role, name, schema, db."""
    parts = []
    for role, tag in (("source", "SOURCE"), ("target", "TARGET")):
        parts.append(folders.select("folder", F.lit("").alias("scope"), F.lit(role).alias("role"), F.explode(f"x.{tag}").alias("t")))
        parts.append(folders.select("folder", F.explode("x.MAPPING").alias("m")).select("folder", F.col("m._NAME").alias("scope"), F.lit(role).alias("role"), F.explode(f"m.{tag}").alias("t")))
    df = reduce(DataFrame.unionByName, parts)
    schema = F.coalesce(_attribute(F.col("t.TABLEATTRIBUTE"), ["owner name", "schema", "schema name"]), blank_to_null(F.col("t._OWNERNAME")))
    db = F.coalesce(_attribute(F.col("t.TABLEATTRIBUTE"), ["db name", "database", "database name"]), blank_to_null(F.col("t._DBDNAME")))
    return df.select("folder", "scope", "role", F.col("t._NAME").alias("name"), schema.alias("schema"), db.alias("db"))


def table_fields(folders: DataFrame) -> DataFrame:
    """folder, role, table, ordinal, field, datatype, precision, scale, nullable of folder-level tables."""
    parts = [folders.select("folder", F.lit(r).alias("role"), F.explode(f"x.{t}").alias("t")).select("folder", "role", F.col("t._NAME").alias("table"), F.posexplode(f"t.{t}FIELD").alias("ordinal", "f")) for r, t in (("source", "SOURCE"), ("target", "TARGET"))]
    df = parts[0].unionByName(parts[1])
    return df.select("folder", "role", "table", "ordinal", F.col("f._NAME").alias("field"), F.col("f._DATATYPE").alias("datatype"), safe_int(F.col("f._PRECISION")).alias("precision"), safe_int(F.col("f._SCALE")).alias("scale"), (F.upper("f._NULLABLE") != "NOTNULL").alias("nullable"))


def instances(folders: DataFrame) -> DataFrame:
    """folder, mapping, instance, ref (what it is an instance of), type, kind."""
    df = _mappings(folders).select("folder", "mapping", F.explode("m.INSTANCE").alias("i"))
    return df.select("folder", "mapping", F.col("i._NAME").alias("instance"), F.coalesce("i._TRANSFORMATIONNAME", "i._TRANSFORMATION_NAME", "i._REFOBJECTNAME", "i._NAME").alias("ref"), F.upper(F.coalesce("i._TYPE", F.lit(""))).alias("type"), F.col("i._TRANSFORMATION_TYPE").alias("kind"))


def ports(folders: DataFrame) -> DataFrame:
    """folder, mapping, instance, field, port_type, expression: of transformations in the mapping or reused from the folder, by instance."""
    m = _mappings(folders)
    loose = m.select("folder", "mapping", F.explode("m.TRANSFORMFIELD").alias("p")).select("folder", "mapping", F.coalesce("p._TRANSFORMATIONINSTANCENAME", "p._TRANSFORMATIONNAME").alias("instance"), "p")
    own = m.select("folder", "mapping", F.explode("m.TRANSFORMATION").alias("t")).select("folder", "mapping", F.col("t._NAME").alias("ref"), F.explode("t.TRANSFORMFIELD").alias("p"))
    shared = folders.select("folder", F.explode("x.TRANSFORMATION").alias("t")).select("folder", F.col("t._NAME").alias("ref"), F.explode("t.TRANSFORMFIELD").alias("p"))
    inst = instances(folders).select("folder", "mapping", "instance", "ref")
    mine = own.join(inst, ["folder", "mapping", "ref"], "left").select("folder", "mapping", F.coalesce("instance", "ref").alias("instance"), "p")
    reused = inst.join(own.select("folder", "mapping", "ref").distinct(), ["folder", "mapping", "ref"], "left_anti").join(shared, ["folder", "ref"]).select("folder", "mapping", "instance", "p")
    df = loose.unionByName(mine).unionByName(reused)
    return df.select("folder", "mapping", "instance", F.col("p._NAME").alias("field"), F.col("p._PORTTYPE").alias("port_type"), blank_to_null(F.col("p._EXPRESSION")).alias("expression")).where("instance is not null and field is not null")


def connectors(folders: DataFrame) -> DataFrame:
    df = _mappings(folders).select("folder", "mapping", F.explode("m.CONNECTOR").alias("c"))
    return df.select("folder", "mapping", F.col("c._FROMINSTANCE").alias("from_instance"), F.col("c._FROMFIELD").alias("from_field"), F.col("c._TOINSTANCE").alias("to_instance"), F.col("c._TOFIELD").alias("to_field"))


def snippets(folders: DataFrame) -> DataFrame:
    """folder, mapping, ord, owner, name, sql: attributes that may hold SQL and do, once for each element."""
    m = _mappings(folders)
    flat = lambda c: F.flatten(F.coalesce(F.transform(c, lambda t: F.coalesce(F.transform(t["TABLEATTRIBUTE"], lambda a: F.struct(t["_NAME"].alias("owner"), a["_NAME"].alias("name"), a["_VALUE"].alias("sql"))), F.array())), F.array()))
    plain = F.coalesce(F.transform("m.TABLEATTRIBUTE", lambda a: F.struct(F.lit("").alias("owner"), a["_NAME"].alias("name"), a["_VALUE"].alias("sql"))), F.array())
    every = F.concat(flat(F.col("m.SOURCE")), flat(F.col("m.TARGET")), flat(F.col("m.TRANSFORMATION")), flat(F.col("m.INSTANCE")), plain)
    return m.select("folder", "mapping", F.posexplode(every).alias("ord", "a")).where(sql_attribute(F.col("a.name"), F.col("a.sql"))).select("folder", "mapping", "ord", "a.owner", "a.name", "a.sql")


def bound_tables(folders: DataFrame) -> DataFrame:
    """folder, mapping, instance, role, name, schema, db: instances of tables, of the mapping's own or else the folder's."""
    t = tables(folders)
    inst = instances(folders).withColumn("role", F.when(F.col("type").contains("TARGET"), "target").when(F.col("type").contains("SOURCE") & ~F.col("type").contains("QUALIFIER"), "source"))
    inst = inst.where("role is not null")
    own = t.where("scope != ''").select("folder", F.col("scope").alias("mapping"), "role", F.col("name").alias("ref"), F.struct("name", "schema", "db").alias("a"))
    out = t.where("scope = ''").select("folder", "role", F.col("name").alias("ref"), F.struct("name", "schema", "db").alias("b"))
    df = inst.join(own, ["folder", "mapping", "role", "ref"], "left").join(out, ["folder", "role", "ref"], "left").withColumn("t", F.coalesce("a", "b")).where("t is not null")
    return df.select("folder", "mapping", "instance", "role", "t.name", "t.schema", "t.db").distinct()


def sessions(folders: DataFrame) -> DataFrame:
    """file, folder, session, mapping, connections (name -> connection)."""
    df = folders.select("file", "folder", F.explode("x.SESSION").alias("s"))
    refs = F.transform("s.CONNECTIONREFERENCE", lambda c: F.concat_ws("=", c["_CNXREFNAME"], c["_CONNECTIONNAME"]))
    return df.select("file", "folder", F.col("s._NAME").alias("session"), F.col("s._MAPPINGNAME").alias("mapping"), F.coalesce(refs, F.array()).alias("connections"))


def workflow_tasks(folders: DataFrame) -> DataFrame:
    """folder, workflow, ord, task, type of workflows' tasks and task instances."""
    df = folders.select("folder", F.explode("x.WORKFLOW").alias("w"))
    both = F.concat(F.coalesce(F.transform("w.TASKINSTANCE", lambda t: F.struct(t["_NAME"].alias("task"), t["_TASKTYPE"].alias("type"))), F.array()), F.coalesce(F.transform("w.TASK", lambda t: F.struct(t["_NAME"].alias("task"), t["_TYPE"].alias("type"))), F.array()))
    return df.select("folder", F.col("w._NAME").alias("workflow"), F.posexplode_outer(both).alias("ord", "t")).select("folder", "workflow", "ord", "t.task", "t.type")


def workflow_links(folders: DataFrame) -> DataFrame:
    df = folders.select("folder", F.explode("x.WORKFLOW").alias("w")).select("folder", F.col("w._NAME").alias("workflow"), F.explode("w.WORKFLOWLINK").alias("l"))
    return df.select("folder", "workflow", F.col("l._FROMTASK").alias("src"), F.col("l._TOTASK").alias("dst"))


def workflow_snippets(folders: DataFrame) -> DataFrame:
    """folder, workflow, ord, sql: task and workflow attributes that hold SQL."""
    df = folders.select("folder", F.explode("x.WORKFLOW").alias("w"))
    attrs = F.concat(F.coalesce("w.ATTRIBUTE", F.array()), F.flatten(F.coalesce(F.transform("w.TASK", lambda t: F.coalesce(t["ATTRIBUTE"], F.array())), F.array())))
    return df.select("folder", F.col("w._NAME").alias("workflow"), F.posexplode(attrs).alias("ord", "a")).where(sql_attribute(F.col("a._NAME"), F.col("a._VALUE"))).select("folder", "workflow", "ord", F.col("a._VALUE").alias("sql"))
