"""Column expressions: exact rounding aggregates, cleaning rules, text parsing.

All are Spark built-ins composed into ``Column`` objects, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from flotilla.functions.aggregates import (  # noqa: F401
    avg_of_limbs, avg_of_limbs_sql, avg_round, avg_round_sql, count_if, misfit, pct_round, pct_round_sql,
    sum_of_limbs, sum_of_limbs_sql, sum_round, sum_round_sql, with_limbs, with_limbs_sql,
)
from flotilla.functions.cleaning import (  # noqa: F401
    null_if, null_unless_true, parse_ts, text_to_int,
)
from flotilla.functions.text import (  # noqa: F401
    alert_route_text, alert_speed_text, log_fields, log_parts,
)
