"""Price of one usage event under a tariff."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.measures import rounded

# Event kinds by key, unit prices (prepaid, otherwise) and the days a monthly allowance is spread over.
VOICE_EVENTS = (1, 7)
SMS_EVENT = 2
DATA_EVENT = 3
BILLING_EVENT = 4
MINUTE_PRICE = (0.10, 0.05)
MEGABYTE_PRICE = (0.005, 0.002)
ALLOWANCE_DAYS = 30


def _over_allowance(used: Column, monthly: Column) -> Column:
    free = F.coalesce(monthly, F.lit(0)).cast("double") / ALLOWANCE_DAYS
    return F.greatest(F.lit(0.0), used - free)


def rated_amount(
    event: Column, seconds: Column, megabytes: Column, plan: Column, fee: Column, free_minutes: Column, free_mb: Column
) -> Column:
    def unit(price: tuple[float, float]) -> Column:
        return F.when(plan == "Prepaid", F.lit(price[0])).otherwise(F.lit(price[1]))

    voice = _over_allowance(seconds.cast("double") / 60, free_minutes) * unit(MINUTE_PRICE)
    data = _over_allowance(megabytes.cast("double"), free_mb) * unit(MEGABYTE_PRICE)
    billing = F.coalesce(fee, F.lit(0)).cast("double") / ALLOWANCE_DAYS
    amount = F.when(event.isin(*VOICE_EVENTS), voice).when(event == DATA_EVENT, data).when(event == BILLING_EVENT, billing)
    return rounded(F.coalesce(amount, F.lit(0.0)), 4).cast("decimal(12,4)")
