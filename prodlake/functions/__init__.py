from prodlake.functions.expressions import (  # noqa: F401
    CHRONOLOGICAL,
    INDEPENDENT,
    all_of,
    chronological_bounds,
    decimal_mean,
    decimal_sum,
    from_limbs,
    independent_bounds,
    interval_bounds,
    limbs,
    search_predicate,
    text_contains,
)
