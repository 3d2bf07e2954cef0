"""Read-only check of SQL text, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words that no statement may contain.
BLOCKED = [
    "INSERT", "UPDATE", "DELETE", "DROP", "TRUNCATE", "ALTER", "CREATE", "REPLACE", "MERGE",
    "GRANT", "REVOKE", "EXEC", "EXECUTE", "CALL",
]

OK = "ok"
NOT_SELECT = "not_select"


def statement_body(sql: Column) -> Column:
    """The statement without leading blanks and semicolons."""
    return F.regexp_replace(sql, r"(?U)^\s*;*\s*", "")


def verdict(sql: Column) -> Column:
    """``ok``, ``not_select`` or the first blocked word in the statement; NULL text is no SELECT."""
    body = statement_body(F.coalesce(sql, F.lit("")))
    blocked = F.upper(F.regexp_extract(body, r"(?iuU)\b(" + "|".join(BLOCKED) + r")\b", 1))
    return (
        F.when(~F.startswith(F.upper(body), F.lit("SELECT")), NOT_SELECT)
        .when(blocked != "", blocked)
        .otherwise(OK)
    )
