"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's test tables through the adapter and runs one
operator over the whole tables.  ``__spark_entry__`` and ``bench.py`` use it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import marts
from basketry.sources.testdata import test_inputs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _in(spark, sf_dir):
    return test_inputs(spark, sf_dir)


# --- marts -------------------------------------------------------------------

@query("customer_rfm")
def q_customer_rfm(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.customer_rfm(i["customers_dim"], i["orders_fact"])


@query("customer_lifetime_value")
def q_clv(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.customer_lifetime_value(i["customers_dim"], i["orders_fact"], i["order_items"])


@query("customer_lifetime_value_corrected")
def q_clv_corrected(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.customer_lifetime_value(i["customers_dim"], i["orders_fact"], i["order_items"],
                                         mode="corrected")


@query("segment_profitability")
def q_segment(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.segment_profitability(i["customers_dim"], i["orders_fact"])


@query("revenue_by_payment")
def q_payment(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.revenue_by_payment(i["customers_dim"], i["orders_fact"])


@query("repeat_purchase")
def q_repeat(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.repeat_purchase(i["customers_dim"], i["orders_fact"])


@query("customer_engagement")
def q_engagement(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.customer_engagement(i["customers_dim"], i["customer_interactions"])


@query("marketing_influence")
def q_marketing(spark, sf_dir):
    i = _in(spark, sf_dir)
    return marts.marketing_influence(i["customers_dim"], i["marketing_spend"])


@query("customer_features")
def q_features(spark, sf_dir):
    return marts.customer_features(_in(spark, sf_dir))


@query("customer_features_one_row")
def q_features_one_row(spark, sf_dir):
    return marts.customer_features(_in(spark, sf_dir), mode="corrected")


# --- summaries and fills -------------------------------------------------------

from basketry.operators import fills, summaries  # noqa: E402


@query("items_per_order")
def q_items_per_order(spark, sf_dir):
    i = _in(spark, sf_dir)
    return summaries.items_per_order(i["order_items"], i["products_dim"])


@query("returns_per_order")
def q_returns_per_order(spark, sf_dir):
    return summaries.returns_per_order(_in(spark, sf_dir)["returns_refunds"])


@query("interactions_per_customer")
def q_interactions_per_customer(spark, sf_dir):
    return summaries.interactions_per_customer(_in(spark, sf_dir)["customer_interactions"])


@query("marketing_per_channel")
def q_marketing_per_channel(spark, sf_dir):
    return summaries.marketing_per_channel(_in(spark, sf_dir)["marketing_spend"])


@query("orders_per_customer")
def q_orders_per_customer(spark, sf_dir):
    return summaries.orders_per_customer(_in(spark, sf_dir)["orders_fact"])


@query("items_per_customer")
def q_items_per_customer(spark, sf_dir):
    i = _in(spark, sf_dir)
    return summaries.items_per_customer(i["order_items"], i["orders_fact"])


@query("returns_per_customer")
def q_returns_per_customer(spark, sf_dir):
    i = _in(spark, sf_dir)
    return summaries.returns_per_customer(i["returns_refunds"], i["orders_fact"])


@query("order_summary")
def q_order_summary(spark, sf_dir):
    return summaries.order_summary(_in(spark, sf_dir))


@query("customer_summary")
def q_customer_summary(spark, sf_dir):
    return summaries.customer_summary(_in(spark, sf_dir))


@query("median_fill")
def q_median_fill(spark, sf_dir):
    return summaries.customer_summary(_in(spark, sf_dir), fill="median")


@query("mode_fill")
def q_mode_fill(spark, sf_dir):
    return summaries.order_summary(_in(spark, sf_dir), fill="mode")


@query("null_profile")
def q_null_profile(spark, sf_dir):
    return fills.null_profile(summaries.order_summary(_in(spark, sf_dir), fill="none"))


# --- cleaning, features, exploration -------------------------------------------

from basketry.operators import clean, explore, features  # noqa: E402


def _cs(spark, sf_dir, columns=None, fill="stat"):
    return summaries.customer_summary(_in(spark, sf_dir), fill=fill, columns=columns)


def _os(spark, sf_dir, columns=None, fill="stat"):
    return summaries.order_summary(_in(spark, sf_dir), fill=fill, columns=columns)


# The fills only touch their listed columns: queries that read none of them
# take the unfilled summary.
def _os_unfilled(spark, sf_dir, columns):
    return _os(spark, sf_dir, columns, "none")


@query("clean_customers")
def q_clean_customers(spark, sf_dir):
    return clean.clean_customers(_cs(spark, sf_dir))


@query("clean_orders")
def q_clean_orders(spark, sf_dir):
    return clean.clean_orders(_os(spark, sf_dir))


@query("last_order_date")
def q_last_order_date(spark, sf_dir):
    return features.last_order_date(_in(spark, sf_dir)["orders_fact"])


@query("customer_ratio_features")
def q_ratio_features(spark, sf_dir):
    i = _in(spark, sf_dir)
    return features.customer_ratio_features(summaries.customer_summary(i), i["orders_fact"])


@query("ltv_buckets")
def q_ltv_buckets(spark, sf_dir):
    return features.ltv_buckets(_cs(spark, sf_dir, ["customer_id", "total_order_amount", "num_orders"]))


@query("ltv_bucket_box")
def q_ltv_bucket_box(spark, sf_dir):
    return features.ltv_bucket_box(_cs(spark, sf_dir, ["customer_id", "total_order_amount", "num_orders"]))


@query("order_kpis")
def q_order_kpis(spark, sf_dir):
    return explore.order_kpis(_os(spark, sf_dir, ["order_amount", "num_returns"]))


@query("customer_describe")
def q_customer_describe(spark, sf_dir):
    return explore.customer_describe(_cs(spark, sf_dir, ["num_orders", "total_order_amount"]))


@query("num_orders_histogram")
def q_num_orders_hist(spark, sf_dir):
    return explore.histogram(_cs(spark, sf_dir, ["num_orders"]), "num_orders")


@query("order_amount_histogram")
def q_order_amount_hist(spark, sf_dir):
    return explore.histogram(_cs(spark, sf_dir, ["total_order_amount"]), "total_order_amount")


@query("order_status_counts")
def q_order_status_counts(spark, sf_dir):
    return explore.value_counts(_os_unfilled(spark, sf_dir, ["order_status"]), "order_status")


@query("cohort_counts")
def q_cohort_counts(spark, sf_dir):
    return explore.value_counts(_cs(spark, sf_dir, ["cohort"]), "cohort")


@query("cohort_sizes")
def q_cohort_sizes(spark, sf_dir):
    return explore.cohort_sizes(_in(spark, sf_dir)["customers_dim"])


@query("revenue_by_day")
def q_revenue_by_day(spark, sf_dir):
    return explore.revenue_by_period(_os_unfilled(spark, sf_dir, ["order_date", "order_amount"]), "D")


@query("revenue_by_week")
def q_revenue_by_week(spark, sf_dir):
    return explore.revenue_by_period(_os_unfilled(spark, sf_dir, ["order_date", "order_amount"]), "W")


@query("revenue_by_month")
def q_revenue_by_month(spark, sf_dir):
    return explore.revenue_by_period(_os_unfilled(spark, sf_dir, ["order_date", "order_amount"]), "M")


@query("orders_by_day")
def q_orders_by_day(spark, sf_dir):
    return explore.orders_by_period(_os_unfilled(spark, sf_dir, ["order_date"]), "D")


@query("top_categories")
def q_top_categories(spark, sf_dir):
    return explore.top_categories(_os_unfilled(spark, sf_dir, ["categories", "order_amount"]), n=20)


@query("returns_by_reason")
def q_returns_by_reason(spark, sf_dir):
    return explore.returns_by_reason(_os(spark, sf_dir, ["return_reasons"]), n=15)


@query("returns_by_reason_corrected")
def q_returns_by_reason_corrected(spark, sf_dir):
    return explore.returns_by_reason(_os(spark, sf_dir, ["return_reasons"]), n=15, sep=",", mode="corrected")


# --- churn -------------------------------------------------------------------------

from basketry.operators import churn  # noqa: E402


#: order summary columns the churn features read (num_returns is filled)
CHURN_ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "order_amount",
                       "num_returns", "total_quantity"]


CHURN_CUSTOMER_COLUMNS = ["customer_id", "age_group", *churn.ONE_HOT, "num_interactions", "num_campaigns",
                          "total_spend", "total_impressions", "total_clicks"]


def _churn_inputs(spark, sf_dir, leaky=False):
    i = _in(spark, sf_dir)
    columns = CHURN_CUSTOMER_COLUMNS + (churn.LEAKY if leaky else [])
    return (summaries.customer_summary(i, columns=columns),
            summaries.order_summary(i, columns=CHURN_ORDER_COLUMNS))


def _training(spark, sf_dir, leaky=False, wide=True):
    cs, os_ = _churn_inputs(spark, sf_dir, leaky)
    return churn.churn_training_set(cs, os_, leaky=leaky, wide=wide)


def _labelled(spark, sf_dir):
    """Labels and recency only: no filled or categorical column is built."""
    i = _in(spark, sf_dir)
    cs = summaries.customer_summary(i, fill="none", columns=["customer_id"])
    return churn.churn_training_set(cs, summaries.order_summary(i, fill="none", columns=CHURN_ORDER_COLUMNS), wide=False)


@query("churn_labels")
def q_churn_labels(spark, sf_dir):
    # reads customer_id and order_date only: none is filled
    return churn.churn_labels(_os_unfilled(spark, sf_dir, ["customer_id", "order_date"]))


@query("churn_features")
def q_churn_features(spark, sf_dir):
    return churn.churn_features(*_churn_inputs(spark, sf_dir))


@query("churn_features_leaky")
def q_churn_features_leaky(spark, sf_dir):
    return churn.churn_features(*_churn_inputs(spark, sf_dir, True), leaky=True)


@query("churn_training_set")
def q_churn_training_set(spark, sf_dir):
    return _training(spark, sf_dir)


@query("churn_split")
def q_churn_split(spark, sf_dir):
    return churn.churn_split(_labelled(spark, sf_dir)).select(
        "customer_id", churn.LABEL, "is_validation")


@query("auc_from_scores")
def q_auc(spark, sf_dir):
    return churn.auc(churn.rule_scores(_labelled(spark, sf_dir)))


@query("confusion_matrix")
def q_confusion(spark, sf_dir):
    return churn.confusion_matrix(churn.rule_scores(_labelled(spark, sf_dir)))


@query("classification_report")
def q_report(spark, sf_dir):
    return churn.classification_report(churn.rule_scores(_labelled(spark, sf_dir)))


from basketry.operators import calibration  # noqa: E402
from basketry.session import materialise, scratch_folder  # noqa: E402


def _split_training(spark, sf_dir):
    """Written once: training, scoring and the metrics read it."""
    return materialise(churn.churn_split(_training(spark, sf_dir, wide=False)), "split")


def _scores(model, data):
    """Scores that several jobs read, written once."""
    return materialise(churn.churn_scores(model, data), "scores")


@query("churn_calibration")
def q_churn_calibration(spark, sf_dir):
    labelled = churn.churn_split(_labelled(spark, sf_dir))
    return calibration.churn_calibration(churn.rule_scores(labelled.where(F.col("is_validation"))))


@query("churn_scores")
def q_churn_scores(spark, sf_dir):
    data = _split_training(spark, sf_dir)
    model = churn.train_churn(data)
    return churn.churn_scores(model, data.where(F.col("is_validation")))


@query("churn_metrics")
def q_churn_metrics(spark, sf_dir):
    data = _split_training(spark, sf_dir)
    model = churn.train_churn(data)
    return churn.training_metrics(_scores(model, data), churn.auc_curve(model, data))


@query("churn_logreg")
def q_churn_logreg(spark, sf_dir):
    data = _split_training(spark, sf_dir)
    model = churn.train_churn(data, model="logreg")
    return churn.churn_scores(model, data.where(F.col("is_validation")))


@query("churn_risk_bands")
def q_churn_risk_bands(spark, sf_dir):
    data = _split_training(spark, sf_dir)
    model = churn.train_churn(data)
    scores = _scores(model, data)
    model = calibration.fit_calibration(scores.where(F.col("is_validation")))
    return churn.churn_risk_bands(calibration.calibrated(model, scores), _in(spark, sf_dir)["customers_dim"], score="calibrated")


# --- lifetime value ----------------------------------------------------------------

from basketry.operators import clv  # noqa: E402

#: fixed model parameters for the checkable scoring queries (time in days)
BGNBD_FIXED = {"r": 0.8, "alpha": 40.0, "a": 0.9, "b": 2.5}
GG_FIXED = {"p": 6.0, "q": 4.0, "v": 150000.0}


PURCHASE_COLUMNS = ["customer_id", "order_date", "order_amount"]


def _purchase_summary(spark, sf_dir):
    # reads customer_id, order_date and order_amount only: none is filled
    return clv.purchase_summary(_os_unfilled(spark, sf_dir, PURCHASE_COLUMNS))


@query("purchase_summary")
def q_purchase_summary(spark, sf_dir):
    return _purchase_summary(spark, sf_dir)


@query("clv_fit_input")
def q_clv_fit_input(spark, sf_dir):
    return clv.clv_fit_input(_purchase_summary(spark, sf_dir))


@query("bgnbd_fit")
def q_bgnbd_fit(spark, sf_dir):
    return clv.fit_bgnbd(clv.clv_fit_input(_purchase_summary(spark, sf_dir)), ridge=1.0)


@query("gamma_gamma_fit")
def q_gamma_gamma_fit(spark, sf_dir):
    return clv.fit_gamma_gamma(clv.clv_fit_input(_purchase_summary(spark, sf_dir)), ridge=0.01)


@query("value_models_fit")
def q_value_models_fit(spark, sf_dir):
    return clv.fit_value_models(clv.clv_fit_input(_purchase_summary(spark, sf_dir)))


@query("bgnbd_likelihood")
def q_bgnbd_likelihood(spark, sf_dir):
    return clv.bgnbd_likelihood(_purchase_summary(spark, sf_dir), **BGNBD_FIXED)


@query("gamma_gamma_likelihood")
def q_gamma_gamma_likelihood(spark, sf_dir):
    return clv.gamma_gamma_likelihood(_purchase_summary(spark, sf_dir), **GG_FIXED)


@query("p_alive")
def q_p_alive(spark, sf_dir):
    return clv.p_alive(_purchase_summary(spark, sf_dir), **BGNBD_FIXED)


@query("expected_spend")
def q_expected_spend(spark, sf_dir):
    return clv.expected_spend(_purchase_summary(spark, sf_dir), **GG_FIXED)


@query("expected_purchases")
def q_expected_purchases(spark, sf_dir):
    return clv.expected_purchases(_purchase_summary(spark, sf_dir), 365.0, **BGNBD_FIXED)


@query("clv_by_cohort")
def q_clv_by_cohort(spark, sf_dir):
    i = _in(spark, sf_dir)
    summary = clv.purchase_summary(summaries.order_summary(i, fill="none", columns=PURCHASE_COLUMNS))
    scores = clv.clv_scores(summary, BGNBD_FIXED, GG_FIXED)
    return clv.clv_by_cohort(scores, i["customers_dim"])


@query("clv_holdout")
def q_clv_holdout(spark, sf_dir):
    return clv.clv_holdout(_in(spark, sf_dir)["orders_fact"], 180, **BGNBD_FIXED)


# --- statistics ---------------------------------------------------------------------

from basketry.operators import inference, rules, stats, survival  # noqa: E402


@query("welch_t")
def q_welch_t(spark, sf_dir):
    return stats.welch_t(_cs(spark, sf_dir, ["gender", "total_order_amount"]), "total_order_amount", "gender", "F", "M")


@query("chi_square")
def q_chi_square(spark, sf_dir):
    return stats.chi_square(_in(spark, sf_dir)["orders_fact"], "order_status", "payment_method")


@query("ab_two_proportion")
def q_ab(spark, sf_dir):
    # zero fill: with the median fill every customer has returns (D8)
    cs = _cs(spark, sf_dir, ["gender", "total_returns"], "zero")
    return stats.ab_two_proportion(cs, "gender", F.col("total_returns") > 0, "F", "M")


@query("stratified_effect")
def q_stratified_effect(spark, sf_dir):
    return stats.stratified_effect(_cs(spark, sf_dir, ["total_order_amount", "loyalty_status", "age_group"]), "total_order_amount",
                                   F.col("loyalty_status").isNotNull(), "age_group")


EFFECT_COLUMNS = ["customer_id", "total_order_amount", "loyalty_status", "age_group", "gender", "acquisition_channel"]


@query("bootstrap_effect")
def q_bootstrap_effect(spark, sf_dir):
    return inference.bootstrap_difference(_cs(spark, sf_dir, EFFECT_COLUMNS), "customer_id", "total_order_amount",
                                          F.col("loyalty_status").isNotNull())


@query("causal_effect")
def q_causal_effect(spark, sf_dir):
    return inference.causal_effect(_cs(spark, sf_dir, EFFECT_COLUMNS), "customer_id", "total_order_amount",
                                   F.col("loyalty_status").isNotNull(), ["age_group", "gender", "acquisition_channel"])


@query("retention_survival")
def q_retention_survival(spark, sf_dir):
    return survival.retention_survival(_in(spark, sf_dir)["orders_fact"])


@query("retention_log_rank")
def q_retention_log_rank(spark, sf_dir):
    i = _in(spark, sf_dir)
    lives = survival.lifetimes(i["orders_fact"]).join(i["customers_dim"].select("customer_id", "gender"), "customer_id")
    return survival.log_rank(lives, "gender", "F", "M")


@query("return_rules")
def q_return_rules(spark, sf_dir):
    i = _in(spark, sf_dir)
    return rules.return_rules(rules.order_baskets(i["orders_fact"], i["order_items"], i["products_dim"], i["returns_refunds"]))


@query("cohort_retention")
def q_cohort_retention(spark, sf_dir):
    return stats.cohort_retention(_in(spark, sf_dir)["orders_fact"])


@query("channel_performance")
def q_channel_performance(spark, sf_dir):
    i = _in(spark, sf_dir)
    return stats.channel_performance(i["customers_dim"], i["orders_fact"], i["marketing_spend"])


@query("return_drivers")
def q_return_drivers(spark, sf_dir):
    i = _in(spark, sf_dir)
    return stats.return_drivers(i["orders_fact"], i["order_items"], i["products_dim"], i["returns_refunds"])


@query("revenue_pivot")
def q_revenue_pivot(spark, sf_dir):
    return stats.revenue_pivot(
        _os_unfilled(spark, sf_dir, ["acquisition_channel", "order_status", "order_amount"]),
        ["Cancelled", "Delivered", "Shipped"])


# --- sources and sinks ----------------------------------------------------------------

from basketry.sources import readers, sinks  # noqa: E402


@query("typed_csv_scan")
def q_typed_csv_scan(spark, sf_dir):
    """IO-02 / IO-04: orders written as CSV with a header, read back with the
    fixed schema (typed timestamps and money)."""
    folder = scratch_folder(spark, "orders-csv")
    sinks.write_csv(_in(spark, sf_dir)["orders_fact"], folder)
    back = readers.read_input(spark, "orders_fact", folder)
    # money as double, like every other query result
    return back.withColumns({c: F.col(c).cast("double") for c in ("order_amount", "discount_amount")})


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf_dir):
    """IO-05: cleaned customers stored as Parquet and read back."""
    folder = scratch_folder(spark, "customers-clean")
    sinks.write_parquet(clean.clean_customers(_cs(spark, sf_dir)), folder)
    return spark.read.parquet(folder)
