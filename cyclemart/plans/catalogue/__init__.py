"""Query catalogue on the driver tables (TPC-H-like), one entry per operator.

Entities are role-mapped onto the driver tables:

* transactions <- ``lineitem`` (status ``l_returnflag = 'R'``, eligibility flag
  ``l_linestatus = 'F'``, amount ``l_extendedprice``, rate ``l_discount``)
* policy <- ``orders`` (active statuses O, P); agent <- ``o_custkey``
* feature <- ``part``; exchange <- ``supplier`` (positive balance)
* coverage / rider <- distinct (order, line) subsets of ``lineitem``
* arrivals and metric events <- ``events`` (cycle = day, file type = event type)

Every query reads whole tables; each has an ANSI SQL twin in :data:`ORACLE_SQL` that
DuckDB runs on the same Parquet files.  Every computed column is aliased identically in
both.
"""

from cyclemart.plans.catalogue.base import (  # noqa: F401
    CYCLE, DEMO_KEY, EVENT_TYPES, INIT_CYCLE, NOW, T_INIT, oracle_sql, queries,
)

# Importing a module registers its queries; the order here is the catalogue order.
from cyclemart.plans.catalogue import filters_joins, aggregates, quality, merge  # noqa: E402,F401
from cyclemart.plans.catalogue import audit, ingest, streams, jobs  # noqa: E402,F401
from cyclemart.plans.catalogue.audit import audit_table, event_arrivals  # noqa: E402,F401
from cyclemart.plans.catalogue.filters_joins import star_fact, star_join, star_tables  # noqa: E402,F401
from cyclemart.plans.catalogue.jobs import entity_frames, land_entities  # noqa: E402,F401
from cyclemart.plans.catalogue.merge import _merge_inputs  # noqa: E402,F401
