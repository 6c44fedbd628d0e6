"""Registered queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

One module per area; importing the package registers every query in ``QUERIES``.
"""

from riskframe.plans.queries import (  # noqa: F401  (registration side effects)
    evaluation,
    expressions,
    io,
    models,
    preparation,
    profiling,
    rollups,
)
from riskframe.plans.queries.common import (  # noqa: F401
    CORR_COLUMNS,
    DIGITS,
    LINEITEM_NUMERIC,
    OVERVIEW_TABLES,
    QUERIES,
    RECORD_SOURCES,
    STATUS_SOURCES,
    applicant_features,
    families,
    features,
    register,
    round_doubles,
    split_assignment,
    stage_dir,
    stored_features,
)
from riskframe.plans.queries.evaluation import ALIGN_KEYS, SCORE_KEYS, model_scores, scored_lines  # noqa: F401
from riskframe.plans.queries.expressions import FAMILY_PREFIXES, ORDER_REFERENCE_DATE  # noqa: F401
from riskframe.plans.queries.preparation import ready_tables  # noqa: F401
from riskframe.plans.queries.profiling import returned_lines  # noqa: F401
