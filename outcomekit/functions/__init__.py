from outcomekit.functions.columns import (  # noqa: F401
    DRAW_SPAN,
    any_substring,
    bce_loss,
    draw,
    first_match,
    fixed_decimals,
    lenient_double,
    linear_margin,
    map_values,
    percent_text,
    sigmoid,
    squared_distance,
    thousands_text,
    threshold_label,
)
