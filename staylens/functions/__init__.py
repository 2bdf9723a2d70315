from staylens.functions.exprs import (  # noqa: F401
    hundred, lga_code_of, month_of, pct_change, ratio6, to_number, stay_days,
    is_true_flag, is_false_flag,
)
