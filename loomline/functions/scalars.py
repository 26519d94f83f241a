"""Scalar functions and predicates over artifact texts, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Function words of expressions that are not port names.
EXPRESSION_WORDS = ["IIF", "DECODE", "NVL", "TO_DATE", "TO_CHAR", "SUBSTR", "CASE", "WHEN", "THEN", "ELSE", "END"]
#: Names of attributes that may hold SQL.
SQL_ATTRIBUTES = ["sql query", "sql override", "source filter", "lookup sql override", "pre sql", "post sql", "stored procedure", "command", "query"]
#: Consolidation symbols and what they do.
CONSOLIDATION = {"+": "SUM", "-": "SUBTRACT", "*": "MULTIPLY", "/": "DIVIDE", "%": "PERCENT", "~": "IGNORE", "^": "NEVER_CONSOLIDATE"}
#: Member storage by its name in metadata.
STORAGE = {"STORE": "store", "DYNAMIC_CALC": "dynamic_calc", "DYNAMIC_CALC_AND_STORE": "dynamic_calc_and_store", "NEVER_SHARE": "never_share", "LABEL_ONLY": "label_only", "SHARED": "shared"}
#: Dimension categories that have a name of their own.
CATEGORY = {"ACCOUNTS": "ACCOUNTS", "TIME": "TIME", "COUNTRY": "COUNTRY", "ATTRIBUTE": "ATTRIBUTE"}
#: Transformation kinds of mapping exports.
TRANSFORMATIONS = ["Source Definition", "Source Qualifier", "Target Definition", "Expression", "Filter", "Aggregator", "Joiner", "Lookup Procedure", "Router", "Sorter", "Sequence Generator", "Normalizer", "Rank", "Union", "Update Strategy", "Stored Procedure", "Custom Transformation"]

#: Patterns that decide what counts as SQL, as a port, as an upstream job and as a procedure call (by the
#: first form that fits), so that results are the same.
SQL_VERB = r"(?i)\b(select|insert|merge|update|delete|call|exec|execute)\b"
PORT_NAME = r"\b([A-Z][A-Z0-9_$#]*)\b"
JOB_OF_STATUS = r"\b[a-zA-Z]\(([^\)]+)\)"
PROCEDURE_CALLS = [r"(?i)CALL\s+(?:(\w+)\.)?(\w+)\s*\(", r"(?i)EXECUTE\s+(?:(\w+)\.)?(\w+)\s*", r"(?i)BEGIN\s+(?:(\w+)\.)?(\w+)\s*\(", r"(?i)\{\s*call\s+(?:(\w+)\.)?(\w+)\s*\("]
#: Fixed value: a workflow name inside a scheduler command (its second group).
WORKFLOW_IN_COMMAND = r"(?i)\b(infa|informatica)\b.*\b([A-Z0-9_\-\.]+)\b"


def _lookup(table: dict[str, str], key: Column, default: str) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def ignored(name: Column, full: Column, patterns: list[str]) -> Column:
    """Whether a table's bare or full name is like one of the patterns, whatever the case."""
    out = F.lit(False)
    for p in patterns:
        out = out | F.coalesce(name.ilike(p), F.lit(False)) | F.coalesce(full.ilike(p), F.lit(False))
    return out


def like_sql(x: Column) -> Column:
    return x.rlike(SQL_VERB)


def sql_attribute(name: Column, value: Column) -> Column:
    """An attribute that may hold SQL and does."""
    return F.lower(F.trim(name)).isin(SQL_ATTRIBUTES) & like_sql(value)


def port_references(expression: Column) -> Column:
    """Distinct upper-case names of an expression that are not its function words."""
    return F.array_except(F.regexp_extract_all(expression, F.lit(PORT_NAME), 1), F.array(*map(F.lit, EXPRESSION_WORDS)))


def upstream_jobs_raw(condition: Column) -> Column:
    """Distinct names after a one-letter status, as written."""
    return F.array_distinct(F.regexp_extract_all(condition, F.lit(JOB_OF_STATUS), 1))


def upstream_jobs(condition: Column) -> Column:
    """Distinct names after a status of any length, without look-back or instance; value tests of globals are no jobs."""
    found = F.regexp_extract_all(condition, F.lit(r"(?i)\b(?:s|su|success|f|fa|failure|d|do|done|t|te|terminated|n|no|notrunning|e|ex|exitcode)\s*\(\s*([^\s,^()]+)"), 1)
    return F.array_distinct(found)


def bridged_workflow(command: Column) -> Column:
    """The workflow that a command starts, or null."""
    return F.nullif(F.regexp_extract(command, WORKFLOW_IN_COMMAND, 2), F.lit(""))


def written_tables_hint(sql: Column) -> Column:
    """Whether a text has a writing verb between two spaces (so not at its start)."""
    return F.lower(sql).rlike(" (insert|update|merge|delete) ")


def observed_tables(sql: Column) -> Column:
    """Distinct names after from, join, into, update or merge into."""
    return F.array_distinct(F.regexp_extract_all(sql, F.lit(r"(?i)\b(from|join|into|update|merge\s+into)\s+([a-zA-Z0-9_$#]+(?:\.[a-zA-Z0-9_$#]+){0,2})"), 2))


def fallback_tables(sql: Column) -> Column:
    """Distinct names after from, join, into or update in text that can't be parsed; outer brackets go, inner ones stay."""
    found = F.regexp_extract_all(sql, F.lit(r"(?i)\b(from|join|into|update)\s+([\w.\[\]]+)"), 2)
    return F.array_distinct(F.transform(found, lambda x: F.btrim(x, F.lit("[]"))))


def procedure_call(sql: Column) -> Column:
    """schema and name of the procedure that a statement calls, by the first form that fits; null if none does."""
    return F.coalesce(*[F.when(sql.rlike(p), F.struct(F.regexp_extract(sql, p, 1).alias("schema"), F.regexp_extract(sql, p, 2).alias("name"))) for p in PROCEDURE_CALLS])


def capped(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def fingerprint(snippets: Column, cap: int = 20000) -> tuple[Column, Column]:
    """SHA-256 of snippets, capped each and joined, and the first 4000 characters of the same."""
    joined = F.array_join(F.transform(snippets, lambda s: F.substring(s, 1, cap)), "\n\n-- ---\n\n")
    return F.sha2(joined, 256), capped(joined, 4000)


def consolidation_name(symbol: Column) -> Column:
    return _lookup(CONSOLIDATION, symbol, "SUM")


def consolidation_symbol(value: Column) -> Column:
    return F.when(value.isin(list(CONSOLIDATION)), value).otherwise("+")


def storage(value: Column) -> Column:
    return _lookup(STORAGE, F.upper(value), "store")


def dimension_type(value: Column) -> Column:
    return F.when(F.upper(value) == "DENSE", "DENSE").otherwise("SPARSE")


def dimension_category(value: Column) -> Column:
    return _lookup(CATEGORY, F.upper(value), "STANDARD")


def transformation_kind(value: Column) -> Column:
    """A known transformation kind, whatever the case, else Unknown."""
    return _lookup({k.lower(): k for k in TRANSFORMATIONS}, F.lower(value), "Unknown")


def has_formula(formula: Column) -> Column:
    return F.coalesce(F.length(F.trim(formula)) > 0, F.lit(False))


def is_calculated(stored: Column) -> Column:
    return F.coalesce(stored.isin("dynamic_calc", "dynamic_calc_and_store"), F.lit(False))


def iso_timestamp(x: Column) -> Column:
    return F.try_to_timestamp(x)


def safe_int(x: Column) -> Column:
    return x.try_cast("int")


def quote_path(x: Column) -> Column:
    return F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))


def path_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"(?<=.)\.[^.]*$", "")


def url_namespace(url: Column) -> Column:
    return F.split_part(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), F.lit("/"), F.lit(1))


def fix_filter(fix: Column) -> Column:
    """A FIX context (dimension -> members) as text; unresolved members are left out; nothing left is null."""
    named = F.filter(F.map_entries(fix), lambda e: e["key"] != "_unresolved_")
    parts = F.transform(named, lambda e: F.concat(e["key"], F.lit(" IN ("), F.array_join(F.transform(e["value"], lambda m: F.concat(F.lit('"'), m, F.lit('"'))), ", "), F.lit(")")))
    return F.nullif(F.array_join(parts, " AND "), F.lit(""))


def job_type(prefix: str, kind: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.upper(kind))
