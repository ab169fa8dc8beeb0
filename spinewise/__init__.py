"""Cohort linkage and reporting on Spark DataFrames."""

from spinewise.operators.agreement import (
    agreement_counts,
    agreement_report,
    all_source_agreement,
    availability_coverage,
    crosstab,
    distinct_rows,
    frequency,
    link_checks,
    pairwise_agreement,
    source_coverage,
    tally,
    within_days,
)
from spinewise.operators.asof import asof_filled, asof_record, asof_ties, asof_waves, latest_filled
from spinewise.operators.harmonise import (
    age_band,
    anchor_flag,
    area_fifth,
    available,
    date_disagreement,
    harmonise,
    prioritise,
)
from spinewise.operators.link import (
    Provider,
    assemble,
    checked_unique,
    entity_link,
    link_to_spine,
    lookup,
    natural_left_join,
    waves_wide,
    zero_fill,
)
from spinewise.operators.report import (
    activity_table,
    binary_table,
    column_sums,
    complete_rows,
    condition_table,
    dictionary,
    event_counts_by,
    event_share,
    found_levels,
    in_level_order,
    in_words,
    level_table,
    missing_causes,
    prefix_stats,
    quantiles,
    row_scores,
    score_table,
    side_by_side,
    stratified_table,
    stratum_sizes,
)
from spinewise.operators.varlist import Variable, VariableList
from spinewise.operators.windowed import (
    Measure,
    Span,
    about_distinct,
    add_partials,
    anchor_to_date,
    any_where,
    between_anchors,
    count_where,
    day_partials,
    distinct_values,
    features_from_partials,
    fixed_period,
    look_back,
    row_count,
    total,
    window_features,
)

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("operators", "functions")]
