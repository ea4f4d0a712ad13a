"""Snippets for the check queries, so that both engines return the same types and digits."""


def cents(value: str, factor: int = 1) -> str:
    """``value * factor`` in hundredths as a whole number."""
    return f"cast(cast({value} as decimal(22,2)) * cast({factor * 100} as decimal(14,0)) as hugeint)"


def rounded(numerator: str, denominator: str, digits: int, factor: int = 1) -> str:
    """``factor * numerator / denominator`` rounded half away from zero, in whole-number arithmetic."""
    n = cents(numerator, factor)
    d = f"nullif({cents(denominator)}, 0)"
    whole = f"((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d})))"
    return f"(cast(sign({n}) * sign({d}) * {whole} as double) / {10**digits})"


def isum(value: str) -> str:
    return f"cast(sum({value}) as bigint)"


def msum(value: str) -> str:
    return f"cast(sum({value}) as double)"


def big_five(column: str = "competition_id") -> str:
    return f"{column} in ('ES1', 'GB1', 'IT1', 'FR1', 'L1')"
