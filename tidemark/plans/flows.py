"""Whole jobs: what a scheduled run of a layer does."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.durable import durable
from tidemark.operators import drift, features, quality, sales, scoring, stability, suites, synth
from tidemark.operators import training as tr
from tidemark.operators.categories import register, registered, with_all_indicators
from tidemark.operators.cleaning import clean, drop_duplicate_keys
from tidemark.sources import keyed, readers, writers


# The tables of the sales source.
SALES_TABLES = (
    "income_band", "warehouse", "ship_mode", "reason", "call_center", "store", "web_page",
    "web_site", "promotion", "household_demographics", "catalog_page", "item", "time_dim",
    "customer_address", "web_returns", "date_dim", "customer", "catalog_returns",
    "store_returns", "customer_demographics", "web_sales", "inventory", "catalog_sales",
    "store_sales",
)


def sales_source(spark: SparkSession, url: str, tables: Sequence[str] = SALES_TABLES, *,
                 split: Mapping[str, str] | None = None, partitions: int = 1,
                 options: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The source tables; those with a column in ``split`` over several connections."""
    frames = {}
    for name in tables:
        column = (split or {}).get(name)
        if column is None:
            frames[name] = readers.read_jdbc(spark, url, name, options=options)
        else:
            bounds = readers.jdbc_bounds(spark, url, name, column, options=options)
            frames[name] = readers.read_jdbc(
                spark, url, name, split_column=column, bounds=bounds, partitions=partitions,
                options=options)
    return frames


def sales_raw(tables: Mapping[str, DataFrame], root: str, run_date=None,
              database: str | None = None) -> None:
    """Ingest source tables (``read_jdbc`` or files) into the raw layer."""
    writers.ingest_tables(tables, root, run_date=run_date, database=database)


def sales_enriched(spark: SparkSession, raw_root: str, enriched_root: str,
                   tables: Sequence[str], database: str | None = None) -> None:
    """Clean every raw table into the enriched layer."""
    for name in tables:
        cleaned = clean(readers.read_table(spark, f"{raw_root}/{name}"))
        writers.write_table(cleaned, f"{enriched_root}/{name}",
                            table=f"{database}.{name}" if database else None)


def sales_curated(spark: SparkSession, enriched_root: str, path: str,
                  table: str | None = None) -> DataFrame:
    """Build the sales cube and check it; the check results are returned."""
    star = {
        name: readers.read_table(spark, f"{enriched_root}/{name}")
        for name in ("store_sales", "web_sales", "date_dim", "item", "store", "web_site")
    }
    writers.write_table(sales.sales_cube(**star), path, table=table)
    cube = readers.read_table(spark, path)
    return quality.run_suite(cube, suites.curated_suite(), suite="curated", table="sales")


def sales_checks(spark: SparkSession, root: str, tables: Sequence[str], suite: str,
                 results_path: str, run_date=None, gate: bool = False) -> None:
    """Run the shipped suites on a layer and record their results.

    Failures are on record only, unless ``gate`` is set: then the first table
    with a failed rule stops the job.
    """
    for name in tables:
        checked = durable(quality.run_suite(
            readers.read_table(spark, f"{root}/{name}"), suites.SALES_SUITES[name],
            suite=suite, table=name))
        quality.record_results(checked, results_path, run_date)
        if gate:
            quality.require_passed(checked)


def house_raw(spark: SparkSession, historical: DataFrame, path: str, start, end=None, *,
              rows_per_day: int = synth.ROWS_PER_DAY, seed: int = 0,
              id_col: str = "house_id", day_col: str = "Date") -> list[dt.date]:
    """Generate the days of the range that are missing; one day without ``end``."""
    profile = synth.profile_table(historical, exclude=[id_col, day_col])

    def make_rows(days):
        return synth.synth_rows(spark, profile, days, rows_per_day=rows_per_day, seed=seed,
                                id_col=id_col, day_col=day_col)

    return writers.backfill_days(spark, start, start if end is None else end, path, make_rows,
                                 day_col=day_col)


def house_enriched(spark: SparkSession, raw_path: str, path: str, keys: Sequence[str],
                   day=None, day_col: str = "Date") -> DataFrame:
    """Clean one day and append it once, or clean everything and rebuild.

    Cleaning drops the columns that are empty on that day. One that has values later is
    added to the layer then, with null in the days before. Returns the check results of the layer.
    """
    raw = tr.in_date_range(readers.read_table(spark, raw_path), day_col, day=day)
    if day is None:
        writers.rebuild_table(clean(raw), path, partition_by=day_col, rebalance=True)
    elif not writers.holds_day(spark, path, day, day_col):
        # Cleaning looks at the data to find empty columns: not done in vain.
        writers.append_new_days(clean(raw), path, day_col=day_col, day=day, widen=True)
    layer = readers.read_table(spark, path)
    return quality.run_suite(layer, suites.house_suite(layer.columns, keys, day_col),
                             suite="enriched", table="house_price")


def build_features(spark: SparkSession, historical: DataFrame, daily: DataFrame,
                   features_path: str, store_path: str, keys: Sequence[str], category: str,
                   target: str, day_col: str = "Date",
                   categories: Sequence | None = None, *, registry_path: str | None = None,
                   mode: str = "all", day=None) -> None:
    """Features of the days not built yet, gated, appended and merged by key.

    A key includes its day, and only new days are built, so checking the new
    rows checks the table. Mode ``all`` takes both tables, ``today`` the rows of ``day`` in the
    daily one. The indicator columns are those of the registry (beside the features unless a path is
    given), which the new rows may add to: every increment has all columns known so far, and
    both tables widen by new ones. Read them with ``read_features``. The store comes
    first, so a run that stops in between is made good by the next. A re-run adds nothing.
    """
    if mode not in ("all", "today"):
        raise ValueError(f"mode must be all or today, not {mode}")
    if mode == "today":
        rows = tr.in_date_range(daily, day_col, day=day)
    else:
        rows = features.combine_by_name(historical, daily)
    existing = readers.read_if_exists(spark, features_path)
    fresh = durable(features.new_days_only(rows, existing, day_col))
    if fresh.isEmpty() and existing is not None:
        return
    if categories is None:
        categories = register(fresh, category, registry_path or registry_of(features_path))
    encoded = features.one_hot(fresh, category, target, categories)
    built = durable(drop_duplicate_keys(encoded, list(keys)))
    quality.require_passed(quality.run_suite(
        built, suites.feature_suite(built.columns, keys, day_col),
        suite="features", table="features"))
    keyed.upsert_table(spark, store_path, built, keys, partition_by=day_col)
    writers.append_new_days(built, features_path, day_col=day_col, rebalance=True, widen=True)


def registry_of(features_path: str) -> str:
    """Where the categories of a feature table are registered unless a path is given."""
    return f"{features_path.rstrip('/')}_categories"


def read_features(spark: SparkSession, path: str, registry_path: str, category: str) -> DataFrame:
    """A feature table with an indicator for every category registered so far, 0 in rows built before it was."""
    return with_all_indicators(readers.read_table(spark, path), registered(spark, registry_path, category))


def training_table(historical: DataFrame, daily: DataFrame | None, path: str,
                   keys: Sequence[str], id_col: str, target: str, *, mode: str = "all",
                   day_col: str = "Date", start=None, end=None) -> None:
    """Assemble the labels to train on and overwrite the training table."""
    labels = tr.training_labels(historical, daily, keys, id_col, target, mode=mode,
                                day_col=day_col, start=start, end=end)
    writers.write_table(labels, path, partition_by=day_col, rebalance=True)


def train(spark: SparkSession, labels: DataFrame, store: DataFrame, keys: Sequence[str],
          target: str, registry_path: str, name: str,
          limit: float = 2500.0) -> tuple[int, DataFrame]:
    """Fit on the training part, evaluate on the rest, register a new version.

    Returns the version and its evaluation. Labels without (complete) features
    cannot be fitted; their number is kept with the version.
    """
    looked_up = durable(features.lookup_features(labels, store, keys, keep_keys=True))
    rows = looked_up.na.drop()
    columns = [c for c in store.columns if c not in keys]
    fit_rows, test_rows = tr.train_test_split(rows, keys)
    model = tr.fit_linear(fit_rows, columns, target)
    evaluation = durable(tr.errors(scoring.score(test_rows, model), target, limit=limit))
    row = evaluation.first()
    metrics = {m: row[m] for m in ("mse", "rmse") if row[m] is not None}
    metrics["incomplete_rows"] = float(looked_up.count() - rows.count())
    return tr.register_model(spark, registry_path, name, model, metrics), evaluation


def validate_latest(spark: SparkSession, rows: DataFrame, target: str, registry_path: str,
                    stages_path: str, name: str, limit: float = 2500.0) -> DataFrame:
    """Score ``rows`` with the newest version registered, and accept it if its error is below ``limit``.

    One row: version, mse, rmse, stage. Without a row to score, nothing is decided.
    """
    version = tr.next_version(spark, registry_path, name) - 1
    model = tr.load_version(spark, registry_path, name, version)
    found = tr.errors(scoring.score(rows, model), target, limit=limit).first()
    if found["rmse"] is None:
        raise ValueError("no complete rows to validate with")
    stage = tr.decide_stage(spark, stages_path, name, version, found["accepted"], found["rmse"])
    return spark.createDataFrame([(version, found["mse"], found["rmse"], stage)],
                                 "version int, mse double, rmse double, stage string")


def score_and_append(spark: SparkSession, store: DataFrame, registry_path: str, name: str,
                     path: str, day_col: str = "Date", *, day=None, start=None,
                     end=None, stages_path: str | None = None) -> None:
    """Score a day or a range with the latest model, or the latest one accepted if a table of stages is given; append it once."""
    model = (tr.load_accepted(spark, registry_path, stages_path, name) if stages_path
             else tr.load_latest(spark, registry_path, name))
    scored = scoring.score_days(store, model, day_col, day=day, start=start, end=end)
    writers.append_new_days(scored, path, day_col=day_col, rebalance=day is None, day=day)


def monitor_drift(store: DataFrame, training_keys: DataFrame, keys: Sequence[str],
                  indicators: Sequence[str], day, day_col: str = "Date",
                  p_val: float = 0.5) -> DataFrame:
    """Verdict: does the given day differ from the rows trained on?"""
    # Several passes follow; the join is done for all of them.
    reference = durable(drift.reference_rows(store, training_keys, keys))
    today = tr.in_date_range(store, day_col, day=day)
    numeric = [c for c in store.columns if c not in (*keys, *indicators)]
    tests = drift.ks_drift(reference, today, numeric).select("feature", "p_value")
    if indicators:
        tests = tests.unionByName(
            drift.chi_square_drift(reference, today, indicators).select("feature", "p_value"))
    return drift.drift_verdict(tests, p_val)


def monitor_model(spark: SparkSession, labels: DataFrame, store: DataFrame, scored: DataFrame,
                  keys: Sequence[str], target: str, registry_path: str, name: str) -> DataFrame:
    """Do the coefficients keep their signs once scored rows are trained on as well?"""
    registered = tr.load_latest(spark, registry_path, name)
    trained = features.lookup_features(labels, store, keys, keep_keys=True)
    rows = durable(stability.refit_rows(trained, scored, target))
    fit_rows, _ = tr.train_test_split(rows, keys)
    refit = tr.fit_linear(fit_rows, registered.features, target)
    return stability.is_stable(stability.compare_signs(spark, registered, refit))
