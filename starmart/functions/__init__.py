from starmart.functions.aggregates import (  # noqa: F401
    BITMAP_IDS,
    MOST_BITMAPS,
    DistinctIds,
    Mergeable,
    avg_where,
    count_where,
    distinct_ids,
    highest,
    lowest,
    n_distinct,
    n_distinct_where,
    number,
    quotient,
    string_list,
    sum_case,
    sum_where,
    total,
)
from starmart.functions.columns import (  # noqa: F401
    between,
    bucket,
    clean_text,
    concat_text,
    date_id,
    date_in,
    date_text,
    is_type,
    label,
    leading_token,
    matches,
    money,
    null_if_token,
    null_unless,
    per_90,
    period_label,
    ratio,
    scaled,
    season_of,
    season_start,
    to_date_lenient,
    to_number,
    word,
)
