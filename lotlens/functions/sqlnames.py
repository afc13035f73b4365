"""The five cleaning functions under their SQL names.

`register(spark)` creates temporary SQL functions; their bodies are SQL, so a
call is inlined by Catalyst and never reaches a Python worker.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import SparkSession

from . import vocab as v


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(expr: str, words: list[str]) -> str:
    return " OR ".join(f"contains({expr}, {_q(w)})" for w in words)


def facility_case(name: str) -> str:
    """SQL for the canonical facility of the upper-cased, trimmed column `name`."""
    rules = " ".join(f"WHEN contains({name}, {_q(k)}) THEN {_q(o)}" for k, o in v.FACILITY_RULES.items())
    return (
        f"CASE WHEN length({name}) > 0 AND NOT ({_any(name, v.FACILITY_STOP_FRAGMENTS)}) "
        f"THEN lower(replace(CASE {rules} ELSE {name} END, ' ', '_')) END"
    )


def bare_company(folded: str) -> str:
    return reduce(lambda a, w: f"replace({a}, {_q(w)}, '')", v.AGENCY_STOP_WORDS, folded)


def company_case(name: str, folded: str, bare: str) -> str:
    """SQL for the canonical agency from the upper-cased, folded and bare names."""
    known = " ".join(f"WHEN contains({folded}, {_q(w)}) THEN {_q(w)}" for w in v.KNOWN_AGENCIES)
    return (
        f"CASE WHEN contains({name}, 'CENTURY 21') OR contains({name}, 'CENTURY21') THEN 'CENTURY21' {known} "
        f"WHEN {bare} IN ('', 'PROPERTI') OR {_any(bare, v.INDEPENDENT_SPELLINGS)} THEN 'INDEPENDENT' "
        f"ELSE {bare} END"
    )


def _bodies() -> dict[str, str]:
    name = r"trim(BOTH ' \t\n\r\u000B\f' FROM upper(s))"
    # a lambda holds each cleaned name, so it is computed once however many rules read it
    agency = (
        f"get(transform(array({name}), n -> get(transform(array(replace(n, 'PROPERTY', 'PROPERTI')), f -> get(transform("
        f"array(trim(regexp_replace({bare_company('f')}, ' +', ' '))), b -> {company_case('n', 'f', 'b')}), 0)), 0)), 0)"
    )
    return {
        "TITLE_CASE": (
            r"array_join(transform(regexp_extract_all(s, '([\\p{Lu}\\p{Ll}\\p{Lt}]+|[^\\p{Lu}\\p{Ll}\\p{Lt}]+)', 1), "
            "w -> concat(substr(upper(substr(w, 1, 1)), 1, 1), "
            "lower(concat(substr(upper(substr(w, 1, 1)), 2), substr(w, 2))))), '')"
        ),
        "MASK_NAME": (
            r"CASE WHEN length(s) >= 1 THEN array_join(transform(filter(split(s, '\\s+'), w -> w <> ''), "
            "w -> concat(substr(w, 1, 1), repeat('x', length(w) - 1))), ' ') END"
        ),
        "MASK_PHONE": "CASE WHEN length(s) >= 3 THEN concat(repeat('x', length(s) - 3), right(s, 3)) END",
        "CLEAN_FACILITY": f"get(transform(array({name}), n -> {facility_case('n')}), 0)",
        "CLEAN_AGENCY_COMPANY": agency,
    }


SQL_NAMES = list(_bodies())


def register(spark: SparkSession) -> None:
    for name, body in _bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN {body}")
