"""Display formats, explanation sentences and rule results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Sentences, limits and labels that must appear exactly so.
# ---------------------------------------------------------------------------
NORMAL_TEXT = "Transaction appears normal based on its characteristics."
ANOMALY_PREFIX = "Potential anomaly detected: "
HIGH_FEE_RATE_TEXT = "Unusually high fee rate (%s satoshis/byte)"
LOW_FEE_RATE_TEXT = "Unusually low fee rate (%s satoshis/byte)"
LARGE_SIZE_TEXT = "Unusually large transaction size (%s bytes)"
MANY_INPUTS_TEXT = "Unusually high number of inputs (%s)"
MANY_OUTPUTS_TEXT = "Unusually high number of outputs (%s)"
NO_REASON_TEXT = "Combination of transaction characteristics deviates from normal patterns"
RULE_TEXT = "Unusual fee rate (%s satoshis/byte)"
MAX_FEE_RATE = 100
MIN_FEE_RATE = 1
MAX_SIZE = 10000
MAX_INPUTS = 50
MAX_OUTPUTS = 50
RULE_ANOMALY_SCORE = 1.5
RULE_NORMAL_SCORE = 0.2
STATUS_ANOMALY = "Anomaly"
STATUS_NORMAL = "Normal"
STATUS_UNSCORED = "Unscored"
HASH_PREFIX_LENGTH = 10
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------


def two_decimals(value: Column) -> Column:
    """``12345.678`` as ``12345.68``.

    ``format_number`` rounds the binary value half-even, as C's ``%.2f`` does;
    ``format_string`` would round the decimal text half-up.
    """
    return F.replace(F.format_number(value, 2), F.lit(","), F.lit(""))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def short_hash(value: Column) -> Column:
    return F.concat(F.substring(value, 1, HASH_PREFIX_LENGTH), F.lit("..."))


def display_time(value: Column) -> Column:
    return F.date_format(value, TIME_FORMAT)


def status_label(flag: Column) -> Column:
    return F.when(flag, STATUS_ANOMALY).when(~flag, STATUS_NORMAL).otherwise(STATUS_UNSCORED)


def _sentence(template: str, value: Column) -> Column:
    head, tail = template.split("%s")
    return F.concat(F.lit(head), value, F.lit(tail))


def explanation(
    flag: Column,
    fee_rate: Column,
    size: Column,
    inputs_count: Column,
    outputs_count: Column,
    *,
    max_fee_rate: float = MAX_FEE_RATE,
    min_fee_rate: float = MIN_FEE_RATE,
    max_size: int = MAX_SIZE,
    max_inputs: int = MAX_INPUTS,
    max_outputs: int = MAX_OUTPUTS,
) -> Column:
    """One sentence per row. A NULL fee rate (size 0) gives no fee reason."""
    rate_text = two_decimals(fee_rate)
    # concat_ws skips NULL, and a `when` without `otherwise` is NULL when not met.
    reasons = F.concat_ws(
        "; ",
        F.when(fee_rate > max_fee_rate, _sentence(HIGH_FEE_RATE_TEXT, rate_text)).when(
            fee_rate < min_fee_rate, _sentence(LOW_FEE_RATE_TEXT, rate_text)
        ),
        F.when(size > max_size, _sentence(LARGE_SIZE_TEXT, size.cast("string"))),
        F.when(inputs_count > max_inputs, _sentence(MANY_INPUTS_TEXT, inputs_count.cast("string"))),
        F.when(
            outputs_count > max_outputs, _sentence(MANY_OUTPUTS_TEXT, outputs_count.cast("string"))
        ),
    )
    flagged = F.concat(
        F.lit(ANOMALY_PREFIX), F.coalesce(F.nullif(reasons, F.lit("")), F.lit(NO_REASON_TEXT))
    )
    return F.when(flag, flagged).otherwise(NORMAL_TEXT)


def breaks_rule(fee_rate: Column, size: Column) -> Column:
    return F.coalesce(
        (fee_rate > MAX_FEE_RATE) | (fee_rate < MIN_FEE_RATE) | (size > MAX_SIZE), F.lit(False)
    )


def rule_score(flag: Column) -> Column:
    return F.when(flag, RULE_ANOMALY_SCORE).otherwise(RULE_NORMAL_SCORE)


def rule_explanation(flag: Column, fee_rate: Column) -> Column:
    """The rule text always names the fee rate, even when only the size fired."""
    text = _sentence(ANOMALY_PREFIX + RULE_TEXT, F.coalesce(two_decimals(fee_rate), F.lit("n/a")))
    return F.when(flag, text).otherwise(NORMAL_TEXT)
