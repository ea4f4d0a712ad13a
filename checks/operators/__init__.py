"""Single operators over the test tables, each with its check query."""

from checks.operators import grouping, joining, loading, quality, ranking

OPERATORS = {
    **loading.OPERATORS,
    **quality.OPERATORS,
    **joining.OPERATORS,
    **grouping.OPERATORS,
    **ranking.OPERATORS,
}
