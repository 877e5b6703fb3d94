"""Independent SQL for every registered query, run by another engine."""

from ledger_sql.quality import QUALITY
from ledger_sql.reports import REPORTS
from ledger_sql.tables import with_tables


def oracle_sql() -> dict[str, str]:
    return {key: with_tables(sql) for key, sql in {**REPORTS, **QUALITY}.items()}
