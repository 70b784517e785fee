"""Oracle SQL per registered query name (see ``oracle_sql.py``)."""

from __future__ import annotations

from contrail.plans import oracle_sql as O


def oracle_sql() -> dict[str, str]:
    return dict(O.ORACLES)
