"""The same answers in SQL over the same Parquet tables, one text per query."""

from __future__ import annotations

from hackney.plans.checks import cleaning, keyed, reports, text


def all_sql() -> dict[str, str]:
    return {**text.SQL, **cleaning.SQL, **reports.SQL, **keyed.SQL}
