"""Statistics named by the reference's README without code (X-01 .. X-04,
X-08, X-11 .. X-13).  Definitions are ours; every one is a grouped
aggregate, and sums of money are exact (decimal) before the final double
arithmetic, so results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.special import chi_square_tail, normal_two_sided, t_two_sided


def welch_t(df: DataFrame, value: str, group: str, a: str, b: str) -> DataFrame:
    """X-01: Welch two-sample t statistic, degrees of freedom (6 decimals) and
    two-sided p-value (9 decimals) of ``value`` between groups ``a`` and ``b`` of
    ``group``; null where a group has fewer than two values or none varies.
    One conditional aggregate over both groups; variances by ``var_samp``,
    which does not subtract large squares."""
    x = F.col(value).cast("decimal(18,2)")
    g = F.col(group)
    aggs = []
    for tag, level in (("a", a), ("b", b)):
        hit = (g == level) & x.isNotNull()
        aggs += [F.count_if(hit).alias(f"n_{tag}"),
                 F.sum(F.when(hit, x)).cast("double").alias(f"s_{tag}"),
                 F.var_samp(F.when(hit, x.cast("double"))).alias(f"var_{tag}")]
    m = df.where(g.isin(a, b)).agg(*aggs)

    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    mean_a, mean_b = F.col("s_a") / F.col("n_a"), F.col("s_b") / F.col("n_b")
    t = F.try_divide(mean_a - mean_b, F.sqrt(va + vb))
    dof = F.try_divide((va + vb) * (va + vb), va * va / (F.col("n_a") - 1) + vb * vb / (F.col("n_b") - 1))
    return m.select(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"),
                    F.col("n_a"), F.col("n_b"), F.round(mean_a, 6).alias("mean_a"),
                    F.round(mean_b, 6).alias("mean_b"), F.round(t, 6).alias("t"),
                    F.round(dof, 6).alias("dof"), F.round(t_two_sided(t, dof), 9).alias("p_value"))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """X-02: Pearson chi-square statistic of independence of two categorical
    columns (rows with a null in either are left out): sum(O^2 / E) - N over
    the observed cells, degrees of freedom (R - 1)(C - 1), and its p-value (null
    without degrees of freedom)."""
    base = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = base.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("o"))
    ra = cells.groupBy(a).agg(F.sum("o").alias("ra"))
    cb = cells.groupBy(b).agg(F.sum("o").alias("cb"))
    joined = cells.join(ra, a).join(cb, b)
    return joined.agg(
        F.sum("o").alias("_n"), F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("cb"))).alias("_q"),
        F.count_distinct(a).alias("_r"), F.count_distinct(b).alias("_c"),
    ).select(F.round(F.col("_q") * F.col("_n") - F.col("_n"), 6).alias("chi_square"),
             ((F.col("_r") - 1) * (F.col("_c") - 1)).cast("bigint").alias("dof"),
             F.col("_n").cast("bigint").alias("n"),
             F.round(chi_square_tail(F.col("_q") * F.col("_n") - F.col("_n"), (F.col("_r") - 1) * (F.col("_c") - 1)), 9)
             .alias("p_value"))


def ab_two_proportion(df: DataFrame, variant: str, success: F.Column, a: str, b: str) -> DataFrame:
    """X-03: two-proportion z test of ``success`` between variants ``a`` and
    ``b`` (pooled standard error) with its two-sided p-value, from one
    conditional aggregate; null where no variant or every one succeeds."""
    v = F.col(variant)
    ok = F.coalesce(success.cast("boolean"), F.lit(False))
    both = df.where(v.isin(a, b)).agg(
        F.count_if(v == a).alias("n_a"), F.count_if((v == a) & ok).alias("k_a"),
        F.count_if(v == b).alias("n_b"), F.count_if((v == b) & ok).alias("k_b"))
    p_a, p_b = F.col("k_a") / F.col("n_a"), F.col("k_b") / F.col("n_b")
    pool = (F.col("k_a") + F.col("k_b")) / (F.col("n_a") + F.col("n_b"))
    z = F.try_divide(p_a - p_b, F.sqrt(pool * (1 - pool) * (1 / F.col("n_a") + 1 / F.col("n_b"))))
    return both.select(F.lit(a).alias("variant_a"), F.lit(b).alias("variant_b"), "n_a", "n_b",
                       F.round(p_a, 6).alias("p_a"), F.round(p_b, 6).alias("p_b"),
                       F.round(z, 6).alias("z"), F.round(normal_two_sided(z), 9).alias("p_value"))


def stratified_effect(df: DataFrame, outcome: str, treated: F.Column, stratum: str) -> DataFrame:
    """X-04: difference of mean ``outcome`` (treated - control) per stratum,
    and the average of those differences weighted by stratum size over the
    strata that have both groups (row ``stratum = '(weighted)'``)."""
    x = F.col(outcome).cast("decimal(18,2)")
    t = treated.cast("boolean")
    per = (df.where(F.col(outcome).isNotNull() & F.col(stratum).isNotNull()).groupBy(stratum).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t).alias("n_treated"), F.count_if(~t).alias("n_control"),
        F.sum(F.when(t, x)).cast("double").alias("_st"), F.sum(F.when(~t, x)).cast("double").alias("_sc")))
    per = per.select(F.col(stratum).cast("string").alias("stratum"), "n", "n_treated", "n_control",
                     (F.col("_st") / F.col("n_treated")).alias("_mt"),
                     (F.col("_sc") / F.col("n_control")).alias("_mc"))
    per = per.withColumn("_eff", F.col("_mt") - F.col("_mc"))
    rows = per.select("stratum", "n", "n_treated", "n_control", F.round("_mt", 6).alias("mean_treated"),
                      F.round("_mc", 6).alias("mean_control"), F.round("_eff", 6).alias("effect"))
    both = per.where((F.col("n_treated") > 0) & (F.col("n_control") > 0))
    total = both.agg(
        F.lit("(weighted)").alias("stratum"), F.sum("n").alias("n"), F.sum("n_treated").alias("n_treated"),
        F.sum("n_control").alias("n_control"), F.lit(None).cast("double").alias("mean_treated"),
        F.lit(None).cast("double").alias("mean_control"),
        F.round(F.sum(F.col("_eff") * F.col("n")) / F.sum("n"), 6).alias("effect"))
    return rows.unionByName(total)


def cohort_retention(orders: DataFrame) -> DataFrame:
    """X-08: share of each first-order-month cohort that orders again k
    months later.  (customer, month) pairs are de-duplicated first, so a
    customer's rows are bounded by the calendar; the cohort of a customer is
    a window over those pairs, and the cohort size is the month-0 count."""
    from pyspark.sql import Window
    month = F.trunc(F.to_date("order_date"), "month")
    active = (orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
              .select("customer_id", month.alias("month")).distinct())
    tagged = active.withColumn("cohort", F.min("month").over(Window.partitionBy("customer_id")))
    k = F.months_between("month", "cohort").cast("int")
    counts = tagged.groupBy("cohort", k.alias("months_since")).agg(F.count(F.lit(1)).alias("active_customers"))
    size = F.max(F.when(F.col("months_since") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort"))
    return counts.select(F.date_format("cohort", "yyyy-MM").alias("cohort_month"), "months_since",
                         "active_customers", size.alias("cohort_size"),
                         F.round(F.col("active_customers") / size, 6).alias("retention"))


def channel_performance(customers: DataFrame, orders: DataFrame, marketing: DataFrame) -> DataFrame:
    """X-11: per acquisition channel: campaigns, spend, impressions, clicks,
    click-through rate, cost per click, revenue of the channel's customers and
    revenue per unit of spend (null where undefined)."""
    per_customer = orders.groupBy("customer_id").agg(
        F.sum(F.col("order_amount").cast("decimal(18,2)")).alias("_rev"))
    revenue = (per_customer.join(customers.select("customer_id", "acquisition_channel"), "customer_id")
               .groupBy(F.col("acquisition_channel").alias("channel"))
               .agg(F.sum("_rev").alias("_rev")))
    mk = (marketing.where(F.col("channel").isNotNull()).groupBy("channel")
          .agg(F.count("campaign_id").alias("campaigns"), F.sum("spend").alias("_spend"),
               F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks")))
    j = revenue.join(mk, "channel", "full")
    # a channel without campaigns has zero spend, impressions and clicks
    spend = F.coalesce(F.col("_spend").cast("double"), F.lit(0.0))
    rev = F.col("_rev").cast("double")
    j = j.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
                       for c in ("campaigns", "impressions", "clicks")})
    return j.select("channel", "campaigns", spend.alias("spend"), "impressions", "clicks",
                    F.round(F.try_divide(F.col("clicks").cast("double"), F.col("impressions").cast("double")), 6).alias("ctr"),
                    F.round(F.try_divide(spend, F.col("clicks").cast("double")), 6).alias("cost_per_click"),
                    rev.alias("revenue"), F.round(F.try_divide(rev, spend), 6).alias("revenue_per_spend"))


def return_drivers(orders: DataFrame, items: DataFrame, products: DataFrame,
                   returns: DataFrame) -> DataFrame:
    """X-12: return rate of orders by payment method and by product category
    (an order counts once per distinct category it contains).  Returned =
    the order has a row in ``returns_refunds`` (not the filled summary, D8)."""
    returned = returns.where(F.col("order_id").isNotNull()).select("order_id").distinct() \
        .withColumn("_ret", F.lit(1))
    o = orders.select("order_id", "payment_method").join(returned, "order_id", "left") \
        .withColumn("_ret", F.coalesce("_ret", F.lit(0)))
    by_pay = o.where(F.col("payment_method").isNotNull()).groupBy(
        F.lit("payment_method").alias("dimension"), F.col("payment_method").alias("value")
    ).agg(F.count(F.lit(1)).alias("orders"), F.sum("_ret").alias("returned_orders"))
    # categories per order as a set (bounded by the catalogue), partitioned
    # by order_id like ``o``: the join below needs no further shuffle
    cats = (items.select("order_id", "product_id").join(products.select("product_id", "category"), "product_id")
            .where(F.col("category").isNotNull())
            .groupBy("order_id").agg(F.collect_set("category").alias("cats")))
    by_cat = (cats.join(o.select("order_id", "_ret"), "order_id")
              .select(F.explode("cats").alias("value"), "_ret")
              .groupBy(F.lit("category").alias("dimension"), "value")
              .agg(F.count(F.lit(1)).alias("orders"), F.sum("_ret").alias("returned_orders")))
    both = by_pay.unionByName(by_cat)
    return both.withColumn("return_rate", F.round(F.col("returned_orders") / F.col("orders"), 6))


def revenue_pivot(orders: DataFrame, values: list[str], rows: str = "acquisition_channel",
                  cols: str = "order_status") -> DataFrame:
    """X-13: revenue pivot table, one column per given value of ``cols``.  The
    values are stated by the caller: finding them takes a job, and Spark stops
    at its own limit of pivot columns."""
    return orders.groupBy(rows).pivot(cols, values).agg(F.sum(F.col("order_amount").cast("decimal(18,2)")).cast("double"))
