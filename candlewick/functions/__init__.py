from candlewick.functions.numbers import exact_sum, to_fixed
from candlewick.functions.symbols import code_to_symbol, dashed_code, quote_of, underscored_code
from candlewick.functions.times import (
    bucket_ms,
    bucket_start,
    epoch_ms,
    from_epoch_ms,
    is_aligned,
    period_start,
    ts_literal,
)

__all__ = [
    "bucket_ms", "bucket_start", "code_to_symbol", "dashed_code", "epoch_ms", "exact_sum",
    "from_epoch_ms", "is_aligned", "period_start", "quote_of", "to_fixed", "ts_literal",
    "underscored_code",
]
