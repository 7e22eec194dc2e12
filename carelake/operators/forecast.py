"""Monthly claim counts per provider, their linear trend and the forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import month_text

# Fixed value: last forecast month when the caller names none.
DEFAULT_END_MONTH = "2027-12"


def monthly_counts(claims: DataFrame) -> DataFrame:
    """Claims per provider and month; rows without provider or date are left out."""
    dated = claims.filter(F.col("provider_id").isNotNull() & F.col("service_date").isNotNull())
    return dated.groupBy("provider_id", F.trunc("service_date", "month").alias("month")).agg(
        F.min("provider_name").alias("provider_name"), F.count(F.lit(1)).alias("claim_count")
    )


def month_index(monthly: DataFrame) -> DataFrame:
    """Dense 0-based index over a provider's observed months; a group is at most its month count."""
    by_month = Window.partitionBy("provider_id").orderBy("month")
    return monthly.withColumn("month_index", F.row_number().over(by_month) - 1)


def linear_trend(x: Column, y: Column) -> dict[str, Column]:
    """Least-squares slope, intercept and r2 as aggregates; one point is flat with a perfect fit."""
    y = y.cast("double")
    x = x.cast("double")
    return {
        "slope": F.coalesce(F.regr_slope(y, x), F.lit(0.0)),
        "intercept": F.coalesce(F.regr_intercept(y, x), F.max(y), F.lit(0.0)),
        "r2": F.when(F.count(y) == 0, 0.0).otherwise(F.coalesce(F.regr_r2(y, x), F.lit(1.0))),
    }


def provider_regression(monthly: DataFrame) -> DataFrame:
    """One row per provider: name, trend, number of observed months and the last of them."""
    trend = linear_trend(F.col("month_index"), F.col("claim_count"))
    return (
        month_index(monthly)
        .groupBy("provider_id")
        .agg(
            F.min("provider_name").alias("provider_name"),
            F.count(F.lit(1)).alias("n_months"),
            F.max("month").alias("last_month"),
            *[c.alias(name) for name, c in trend.items()],
        )
    )


def predicted_count(slope: Column, intercept: Column, x: Column) -> Column:
    """Rounded half to even and never negative; float noise is cut first so ties are stable."""
    value = F.round(slope * x + intercept, 9)
    return F.greatest(F.lit(0).cast("bigint"), F.bround(value, 0).cast("bigint"))


def forecast_counts(regression: DataFrame, end_month: str = DEFAULT_END_MONTH) -> DataFrame:
    """One row per provider and future month up to ``end_month``; none where that has passed."""
    end = F.to_date(F.lit(f"{end_month}-01"))
    future = regression.filter(F.col("last_month") < end).select(
        "*", F.posexplode(F.expr(f"sequence(add_months(last_month, 1), date'{end_month}-01', interval 1 month)"))
    )
    x = F.col("n_months") + F.col("pos")
    return future.select(
        "provider_id",
        "provider_name",
        F.col("col").alias("month"),
        predicted_count(F.col("slope"), F.col("intercept"), x).alias("predicted_claims"),
    )


def provider_forecast(claims: DataFrame, end_month: str = DEFAULT_END_MONTH) -> DataFrame:
    """Flat forecast: provider, ``yyyy-MM`` and predicted claims."""
    flat = forecast_counts(provider_regression(monthly_counts(claims)), end_month)
    return flat.withColumn("month", month_text("month"))


def forecast_series(claims: DataFrame, end_month: str = DEFAULT_END_MONTH) -> DataFrame:
    """History points followed by forecast points as one typed series per provider."""
    monthly = monthly_counts(claims)
    history = monthly.select(
        "provider_id", month_text("month").alias("x"), F.col("claim_count").alias("y"), F.lit("history").alias("type")
    )
    future = forecast_counts(provider_regression(monthly), end_month).select(
        "provider_id", month_text("month").alias("x"), F.col("predicted_claims").alias("y"), F.lit("forecast").alias("type")
    )
    return history.unionByName(future)


def provider_documents(claims: DataFrame, end_month: str = DEFAULT_END_MONTH) -> DataFrame:
    """One nested document per provider: history, forecast and rounded regression.

    The arrays hold one entry per calendar month, so their length does not grow with the claims.
    """
    indexed = month_index(monthly_counts(claims))
    trend = linear_trend(F.col("month_index"), F.col("claim_count"))
    base = indexed.groupBy("provider_id").agg(
        F.min("provider_name").alias("provider_name"),
        F.array_sort(F.collect_list(F.struct("month", "claim_count"))).alias("points"),
        F.count(F.lit(1)).alias("n_months"),
        F.max("month").alias("last_month"),
        *[c.alias(name) for name, c in trend.items()],
    )
    end = F.to_date(F.lit(f"{end_month}-01"))
    future = F.when(
        F.col("last_month") < end,
        F.expr(f"sequence(add_months(last_month, 1), date'{end_month}-01', interval 1 month)"),
    ).otherwise(F.array().cast("array<date>"))
    history = F.transform("points", lambda p: F.struct(month_text(p["month"]).alias("month"), p["claim_count"].alias("claim_count")))
    forecast = F.transform(
        future,
        lambda m, i: F.struct(
            month_text(m).alias("month"),
            predicted_count(F.col("slope"), F.col("intercept"), F.col("n_months") + i).alias("predicted_claims"),
        ),
    )
    return base.select(
        "provider_id",
        "provider_name",
        history.alias("history"),
        forecast.alias("forecast"),
        F.struct(*[F.round(n, 6).alias(n) for n in ("slope", "intercept", "r2")]).alias("regression"),
    )
