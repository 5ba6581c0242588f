"""String rules, functional dependencies, references."""

from __future__ import annotations

from pyspark.sql import functions as F

from refinery.operators.validate import dependency_violations, orphans, string_violations
from refinery.queries import query, table


def people(spark, folder):
    """Customers with a nullable segment and a padded, mixed-case one."""
    segment = F.nullif("c_mktsegment", F.lit("FURNITURE"))
    padded = F.concat(F.lit(" "), F.lower("c_mktsegment"))
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.regexp_replace("c_name", "#00000000", " ").alias("c_name"),
        segment.alias("c_mktsegment"),
        padded.alias("padded"),
    )


PEOPLE_SQL = """
p AS (SELECT c_custkey, replace(c_name, '#00000000', ' ') AS c_name,
             NULLIF(c_mktsegment, 'FURNITURE') AS c_mktsegment,
             ' ' || lower(c_mktsegment) AS padded FROM customer)
"""

RULES = {
    "c_mktsegment": {"rules": [{"type": "required"}]},
    "c_name": {
        "rules": [{"type": "no_spaces"}, {"type": "regex", "pattern": "^Customer#[0-9]*[1-4]$"}]
    },
    "PADDED": {
        "rules": [{"type": "allowed_values", "values": ["Building", "machinery", "household"]}]
    },
}

RULES_SQL = {
    "required": ("c_mktsegment", "NULL_NOT_ALLOWED", "c_mktsegment IS NULL"),
    "no_spaces": ("c_name", "CONTAINS_WHITESPACE", r"NOT regexp_matches(c_name, '^\S+$')"),
    "regex": ("c_name", "PATTERN_MISMATCH",
              "NOT regexp_matches(c_name, '^Customer#[0-9]*[1-4]$')"),
    "allowed_values": ("padded", "INVALID_VALUE",
                       "upper(trim(padded)) NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"),
}


def _violations_sql(kinds):
    return f"WITH {PEOPLE_SQL} " + " UNION ALL ".join(
        f"""SELECT c_custkey, '{c}' AS "column", {c} AS value, '{code}' AS rule FROM p WHERE {bad}"""
        for c, code, bad in (RULES_SQL[k] for k in kinds)
    )


def _one_rule(kind, name):
    chosen = {
        c: {"rules": [r for r in config["rules"] if r["type"] == kind]}
        for c, config in RULES.items()
    }

    def build(spark, folder):
        return string_violations(people(spark, folder), chosen, ["c_custkey"])

    build.__name__ = name
    return query(_violations_sql([kind]))(build)


_one_rule("required", "validate_required")
_one_rule("regex", "validate_regex")
_one_rule("no_spaces", "validate_no_spaces")
_one_rule("allowed_values", "validate_allowed")


@query(_violations_sql(RULES_SQL))
def validate_strings_all(spark, folder):
    """Every rule over every column in one scan."""
    return string_violations(people(spark, folder), RULES, ["c_custkey"])


def _dependency_sql(source, key, column, dependent):
    return f"""
SELECT '{{' || {key} || '}}' AS determinant, '{column}' AS "column", '{dependent}' AS dependent_column,
       CAST({dependent} AS VARCHAR) AS conflicting_value, n AS distinct_count,
       'FUNCTIONAL_DEPENDENCY_VIOLATION' AS rule
FROM (SELECT DISTINCT {column}, {dependent} FROM {source} WHERE {dependent} IS NOT NULL)
JOIN (SELECT {column}, COUNT(DISTINCT {dependent}) AS n FROM {source} GROUP BY {column}) USING ({column}) WHERE n > 1"""


FD_SQL = (
    _dependency_sql("part", """'"p_brand":"' || p_brand || '"'""", "p_brand", "p_type")
    + " UNION ALL "
    + _dependency_sql(
        "part",
        """'"p_brand":"' || p_brand || '","p_type":"' || p_type || '"'""",
        "p_brand, p_type",
        "p_size",
    )
)


@query(FD_SQL)
def fd_violations(spark, folder):
    """A single and a composite determinant, reported side by side."""
    return dependency_violations(
        table(spark, folder, "part"), {"p_brand": "p_type", ("p_brand", "p_type"): "p_size"}
    )


@query(_dependency_sql("part", "p_partkey", "p_partkey", "p_type"))
def fd_holds(spark, folder):
    """A dependency that holds gives no rows."""
    return dependency_violations(table(spark, folder, "part"), {"p_partkey": "p_type"})


@query("""
SELECT l_partkey AS partkey, l_suppkey AS supplier, n AS suppliers
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
JOIN (SELECT l_partkey, COUNT(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_partkey) USING (l_partkey) WHERE n > 1
""")
def fd_violations_in_parts(spark, folder):
    """Every value of every violating determinant, a row each."""
    found = dependency_violations(table(spark, folder, "lineitem"), {"l_partkey": "l_suppkey"})
    return found.select(
        F.get_json_object("determinant", "$.l_partkey").cast("bigint").alias("partkey"),
        F.col("conflicting_value").cast("bigint").alias("supplier"),
        F.col("distinct_count").alias("suppliers"),
    )


ORPHANS_SQL = """
SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
"""


@query(ORPHANS_SQL)
def referential_orphans_many_parents(spark, folder):
    """The way for parents that are too many to broadcast: only possible orphans are shuffled."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return orphans(documents, "doc_id", table(spark, folder, "labels"), "doc_id", max_rows=0)


@query(ORPHANS_SQL)
def referential_orphans(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return orphans(documents, "doc_id", table(spark, folder, "labels"), "doc_id")


@query("SELECT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def referential_holds(spark, folder):
    """No line item is without its order."""
    rows = table(spark, folder, "lineitem").select("l_orderkey")
    return orphans(rows, "l_orderkey", table(spark, folder, "orders"), "o_orderkey")
