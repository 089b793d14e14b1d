from tessera.functions.scalar import (
    date_key,
    epoch_ms_to_utc_day,
    is_weekend,
    iso_day_of_week,
    iso_utc_to_ntz,
    ntz_lit,
    pct_change,
    price_text,
    round_n,
    signed_pct_text,
    surrogate_key,
)

__all__ = [
    "date_key",
    "epoch_ms_to_utc_day",
    "is_weekend",
    "iso_day_of_week",
    "iso_utc_to_ntz",
    "ntz_lit",
    "pct_change",
    "price_text",
    "round_n",
    "signed_pct_text",
    "surrogate_key",
]
