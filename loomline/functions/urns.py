"""Identity: URNs and table names as column expressions (no UDF: they are the engine's join keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Name = str | Column


def _c(x: Name | None) -> Column:
    return F.lit(None).cast("string") if x is None else x if isinstance(x, Column) else F.lit(x)


def platform_urn(platform: Name) -> Column:
    return F.concat(F.lit("urn:li:dataPlatform:"), _c(platform))


def flow_urn(platform: Name, flow: Name, env: Name = "PROD") -> Column:
    return F.concat(F.lit("urn:li:dataFlow:("), _c(platform), F.lit(","), _c(flow), F.lit(","), _c(env), F.lit(")"))


def job_urn(flow: Column, job: Name) -> Column:
    return F.concat(F.lit("urn:li:dataJob:("), flow, F.lit(","), _c(job), F.lit(")"))


def dataset_urn(platform: Name, name: Name, env: Name = "PROD", instance: Name | None = None) -> Column:
    """With an instance the dataset's name is prefixed by it."""
    full = F.concat_ws(".", F.nullif(_c(instance), F.lit("")), _c(name))
    return F.when(_c(name).isNotNull(), F.concat(F.lit("urn:li:dataset:("), platform_urn(platform), F.lit(","), full, F.lit(","), _c(env), F.lit(")")))


def field_urn(dataset: Column, path: Name) -> Column:
    return F.concat(F.lit("urn:li:schemaField:("), dataset, F.lit(","), _c(path), F.lit(")"))


def procedure_urns(name: Name, env: Name = "PROD") -> tuple[Column, Column]:
    """A stored procedure as a job of a flow of its own, and as a dataset."""
    return job_urn(flow_urn("oracle", "stored_procedures", env), name), dataset_urn("oracle", name, env)


def fqn(name: Column, schema: Column | None = None, db: Column | None = None, default_db: Name | None = None, default_schema: Name | None = None) -> Column:
    """Database, schema and name, each part with its default; absent parts are left out."""
    part = lambda own, other: F.coalesce(F.nullif(_c(own), F.lit("")), F.nullif(_c(other), F.lit("")))
    return F.concat_ws(".", part(db, default_db), part(schema, default_schema), name)


def _dots(table: Column) -> Column:
    return F.length(table) - F.length(F.replace(table, F.lit("."), F.lit("")))


def normalise_parsed(table: Column, db: Name | None = None, schema: Name | None = None) -> Column:
    """Names out of a parsed statement: the database is added only where the schema is known."""
    d, s, n = F.nullif(_c(db), F.lit("")), F.nullif(_c(schema), F.lit("")), _dots(table)
    return F.when(n >= 2, table).when(n == 1, F.concat_ws(".", d, table)).when(s.isNotNull(), F.concat_ws(".", d, s, table)).otherwise(table)


def normalise_text(table: Column, db: Name | None = None, schema: Name | None = None) -> Column:
    """Names out of plain text: outer brackets go; the schema comes first, then the database if there is one dot exactly."""
    bare = F.regexp_replace(F.trim(table), r"^[\[\"`]+|[\]\"`]+$", "")
    s = F.when((_dots(bare) == 0) & F.nullif(_c(schema), F.lit("")).isNotNull(), F.concat_ws(".", _c(schema), bare)).otherwise(bare)
    return F.when((_dots(s) == 1) & F.nullif(_c(db), F.lit("")).isNotNull(), F.concat_ws(".", _c(db), s)).otherwise(s)


def normalise_observed(table: Column, db: Name | None = None, schema: Name | None = None) -> Column:
    """Names out of observed statements: the last three parts, with whatever defaults there are."""
    d, s, n = F.nullif(_c(db), F.lit("")), F.nullif(_c(schema), F.lit("")), _dots(table)
    return F.when(n == 0, F.concat_ws(".", d, s, table)).when(n == 1, F.concat_ws(".", d, table)).otherwise(F.substring_index(table, ".", -3))
