"""Model usage, cost, the estimate before a run, and run totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = ("calls", "input_tokens", "output_tokens", "cache_read_tokens", "cache_write_tokens")
PROMPT_TOKENS = 2500
#: Share of the input that comes out, and the factor for reasoning, at the low and the high end.
ENDS = {"low": (0.25, 1.2), "high": (0.6, 2.0)}
READ_FACTOR, WRITE_FACTOR = 0.1, 1.25


def usage_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Per model the summed counters and the cost in USD; a model without a price costs nothing."""
    sums = usage.groupBy("model").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    paid = sums.join(prices, "model", "left").fillna(0.0, ["input_per_m", "output_per_m"])
    cost = F.col("input_tokens") * F.col("input_per_m") + F.col("cache_read_tokens") * F.col("input_per_m") * READ_FACTOR + F.col("cache_write_tokens") * F.col("input_per_m") * WRITE_FACTOR + F.col("output_tokens") * F.col("output_per_m")
    return paid.select("model", *COUNTERS, F.round(cost / 1e6, 4).alias("cost"))


def cost_estimate(sections: DataFrame, extract_price: tuple[float, float], compose_price: tuple[float, float]) -> DataFrame:
    """sections: token_estimate, skip_reason. n, tokens and the low and high cost of reading and writing all sections that aren't skipped."""
    own = sections.filter("skip_reason is null").agg(F.count("*").alias("n"), F.coalesce(F.sum("token_estimate"), F.lit(0)).cast("long").alias("tokens"))
    (in1, out1), (in2, out2) = extract_price, compose_price
    prompts = F.col("n") * PROMPT_TOKENS

    def cost(share: float, think: float):
        notes = F.col("tokens") * F.lit(share)
        return F.round(((F.col("tokens") + prompts) * in1 + notes * think * out1 + (notes + prompts) * in2 + notes * think * out2) / 1e6, 2)

    return own.select("n", "tokens", *[cost(*ends).alias(name) for name, ends in ENDS.items()])


def run_totals(reports: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The sums of a run's per-document counters."""
    return reports.agg(F.count("*").alias("documents"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in columns])
