from starmart.operators.cube import (  # noqa: F401
    aggregate,
    cube,
    distinct_counts,
    drill_down,
    finest,
    grouping_sets,
    level_label,
    pivot,
    pivot_matrix,
    roll_up,
    share_of_total,
)
from starmart.operators.distribution import exact_median, positions, prefix_sums  # noqa: F401
from starmart.operators.joins import (  # noqa: F401
    balance,
    child_counts,
    drill_across,
    either_role,
    orphans,
    restrict_to_top,
    semi,
    star_join,
    two_perspectives,
    union_all,
)
from starmart.operators.ledger import (  # noqa: F401
    accepted,
    accepted_and_counted,
    reject_missing,
    reject_orphans,
    reject_where,
)
from starmart.operators.loading import (  # noqa: F401
    add_unknown_member,
    apply_null_rules,
    dedupe,
    derive_outcome,
    detect_date_formats,
    enrich,
    file_order_key,
    filter_fk,
    first_available,
    iso_dates,
    lookup,
    redirect_fk,
    rename,
    require,
    select_available,
    truncate_text,
    widen_by_role,
    with_file_order_key,
    with_surrogate_key,
)
from starmart.operators.periods import moving_avg, period_change, running_total, vs_group, with_mean  # noqa: F401
from starmart.operators.quality import (  # noqa: F401
    assert_no_nulls,
    cascade_counts,
    date_range,
    fact_stats,
    key_check,
    load_rate,
    measure_totals,
    null_audit,
    null_counts,
    null_summary,
    orphan_counts,
    reject_classes,
    reject_counts,
    reject_examples,
    row_counts,
    sample_rows,
    sentinel_audit,
    value_counts,
    verify_derived,
)
from starmart.operators.ranking import (  # noqa: F401
    arg_max,
    best_per_group,
    extremes,
    kpi_ranking,
    order,
    rank_columns,
    tile_of,
    tiers,
    top_by_any,
    top_overall,
    top_per_group,
    with_ties,
)
from starmart.operators.selection import any_of, dice, known, lookup_key, slice_  # noqa: F401
from starmart.operators.tally import tally  # noqa: F401
from starmart.operators.trend import medians, trend  # noqa: F401
