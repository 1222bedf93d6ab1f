"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.fixed import CSV_FORMAT, CURATED_INPUT, PARTITION, REQUIRED_FIELDS, Rules
from cartorio.functions.columns import count_where, registry_id
from cartorio.functions.predicates import names_month, names_snapshot
from cartorio.operators import checks, ids, lookup, measures, partials, profiles, report, stability
from cartorio.operators.conform import active_only, curated, stamped
from cartorio.plans import monthly
from cartorio.plans.packing import pack_files
from cartorio.plans.registry import (
    accented,
    cities,
    delivery_names,
    opened_by,
    opening_months,
    registry,
    write_broken_extract,
    write_extract,
)
from cartorio.sources.archives import check_archives, expand_archives, require_expanded
from cartorio.sources.delimited import misfit_files, read_lookup, stage_extract
from cartorio.sources.layers import has_month, read_month, write_month
from cartorio.sources.layouts import GOLD, PARTIALS, RAW, RAW_NAMES, describe, pick
from cartorio.sources.manifest import (
    doubled_files,
    expected_files,
    landed_files,
    missing_files,
)
from cartorio.sources.scratch import fresh_folder, remove_folder
from cartorio.sources.versions import current

Query = Callable[[SparkSession, str], DataFrame]

PREVIOUS, CURRENT = "2000-12", "2001-08"
LAST_DAY = {PREVIOUS: "20001231", CURRENT: "20010831"}
CITY_NAME, UNLISTED_NAME = "NATION_7", "NATION_3"
ASKED_NAME = " NACAO   7"
SOME_CITIES = ("7101", "7107", "7119")
LOADED_AT = "2026-01-15 03:04:05"

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry(spark, sf_dir).select(*RAW_NAMES)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated(registry(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.type_status_counts(silver(spark, sf_dir))


def gold_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of two snapshots from one pass over the curated rows."""
    keys = [F.col(key) for key in measures.GROUP_KEYS]
    months = silver(spark, sf_dir).groupBy(*keys).agg(*[
        count_where(opened_by(day)).alias(month) for month, day in LAST_DAY.items()
    ])
    return months.unpivot(
        keys, [F.col(f"`{month}`") for month in LAST_DAY], PARTITION, "count"
    ).filter("count > 0")


def gold_of(spark: SparkSession, sf_dir: str, month: str) -> DataFrame:
    return gold_snapshots(spark, sf_dir).filter(F.col(PARTITION) == month)


# --- curated rows ---------------------------------------------------------------------------------


@_query
def gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(spark, sf_dir)


@_query
def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir)


@_query
def silver_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick(registry(spark, sf_dir), [*CURATED_INPUT, "not_a_field"])


# --- counts and measures --------------------------------------------------------------------------


@_query
def active_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_only(gold(spark, sf_dir))


@_query
def gold_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.grand_total(gold(spark, sf_dir))


@_query
def type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.count_by(silver(spark, sf_dir), "establishment_type")


@_query
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.count_by(silver(spark, sf_dir), "registration_status")


@_query
def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.distinct_labels(silver(spark, sf_dir))


@_query
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.quality_metrics(silver(spark, sf_dir))


@_query
def quality_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.quality_distributions(silver(spark, sf_dir))


@_query
def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.null_rates(raw(spark, sf_dir))


@_query
def schema_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(raw(spark, sf_dir))


#: Columns whose profile is compared with exact counts.
PROFILED = ("cnpj_basico", "nome_fantasia", "situacao_cadastral", "municipio", "cep", "telefone_2", "fax")


def exact_counts(rows: DataFrame) -> DataFrame:
    """Of each column its distinct values (``exact``), and between what the median may lie (``low``, ``high``).

    Two aggregates: beside distinct counts, percentiles would be kept for every single value and sorted.
    """
    # A value is a row of its own column: rows of all columns, one filled, would take several times the memory.
    cells = rows.select(F.inline(F.array(*[
        F.struct(F.lit(at).alias("at"), F.col(name).cast("string").alias("value")) for at, name in enumerate(rows.columns)
    ])))
    distinct = cells.filter("value is not null").distinct().groupBy("at").agg(F.count(F.lit(1)).alias("exact"))
    shares = [0.5 - profiles.RANK_ERROR, 0.5 + profiles.RANK_ERROR]
    spans = rows.agg(*[
        F.struct(
            F.lit(at).alias("at"), F.lit(name).alias("of"),
            F.percentile(profiles.measure_of(rows, name), F.array(*map(F.lit, shares))).alias("span"),
        ).alias(name) for at, name in enumerate(rows.columns)
    ]).select(F.inline(F.array(*rows.columns)))
    # A column without a value has none to count.
    return spans.join(distinct, "at", "left").select(
        "of", F.coalesce("exact", F.lit(0)).alias("exact"), F.col("span")[0].alias("low"), F.col("span")[1].alias("high")
    )


@_query
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of two halves of the registry merged; whether their estimates keep to the stated errors is
    judged by exact counts over the rows."""
    rows = raw(spark, sf_dir).select(*PROFILED)
    first = F.col("cnpj_basico") < "00030000"
    halves = [profiles.column_profile(rows.filter(half)) for half in (first, ~first)]
    found = profiles.described(profiles.merged(reduce(DataFrame.unionAll, halves)))
    exact = exact_counts(rows)
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= profiles.DISTINCT_ERROR * F.col("exact")
    within = F.coalesce(F.col("median").between(F.floor("low"), F.ceil("high")), F.col("filled") == 0)
    return found.join(exact, F.col("column") == F.col("of")).select(
        "column", "rows", "filled", "null_rate", F.col("exact").alias("n_distinct"),
        near.alias("distinct_within"), within.alias("median_within"),
    )


# --- report and comparison ------------------------------------------------------------------------


@_query
def summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.summary(gold(spark, sf_dir))


@_query
def summary_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.lit(LOADED_AT).cast("timestamp")
    stamped_gold = stamped(gold(spark, sf_dir), CURRENT, "ts_aggregation", moment)
    return report.printable(stamped_gold)


@_query
def compare_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.compare(gold_snapshots(spark, sf_dir), CURRENT, PREVIOUS)


# --- checks ---------------------------------------------------------------------------------------


@_query
def input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.input_checks(raw(spark, sf_dir))


@_query
def input_checks_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.input_checks(raw(spark, sf_dir), columns=REQUIRED_FIELDS)


@_query
def input_checks_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required column isn't there."""
    return checks.input_checks(raw(spark, sf_dir).drop("municipio"), columns=REQUIRED_FIELDS)


@_query
def id_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.id_checks(raw(spark, sf_dir))


@_query
def business_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.business_checks(silver(spark, sf_dir))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the curated rows for all bundles: both snapshots and all rows."""
    months = {month: opened_by(day) for month, day in LAST_DAY.items()}
    return checks.cells(silver(spark, sf_dir), {**months, "all": F.lit(True)})


@_query
def output_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.output_from(_cells(spark, sf_dir), CURRENT, PREVIOUS)


@_query
def output_checks_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.output_from(_cells(spark, sf_dir), "all")


@_query
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.reconcile_from(_cells(spark, sf_dir), "all")


@_query
def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.gate_from(_cells(spark, sf_dir), CURRENT, PREVIOUS)


@_query
def id_digit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check digits of all ids; two of three are given the ones that belong to them."""
    stem = F.concat("cnpj_basico", "cnpj_ordem")
    digits = F.when(F.col("record_no") % 3 == 0, F.col("cnpj_dv")).otherwise(ids.check_digits(stem))
    rows = registry(spark, sf_dir).select(F.concat(stem, digits).alias("cnpj_completo"))
    return ids.id_digit_checks(rows)


@_query
def doubled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month in which every fiftieth row was delivered again."""
    rows = registry(spark, sf_dir).select("record_no", registry_id().alias("cnpj_completo"))
    return ids.doubled_ids(rows.unionAll(rows.filter("record_no % 50 = 0")))


@_query
def stability_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The establishments opened in each month, beside the twelve months before."""
    month = F.concat_ws("-", F.substring("data_inicio_atividade", 1, 4), F.substring("data_inicio_atividade", 5, 2))
    rows = curated(registry(spark, sf_dir), None).withColumn(PARTITION, month)
    return stability.stability_history(measures.count_by(rows, PARTITION, *measures.GROUP_KEYS))


# --- city lookup ----------------------------------------------------------------------------------


@_query
def city_lookup_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = registry(spark, sf_dir).select(*CURATED_INPUT)
    return lookup.in_named_city(rows, cities(spark, sf_dir), CITY_NAME)


def _without_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup with one city unlisted."""
    return cities(spark, sf_dir).filter(F.col("name") != UNLISTED_NAME)


@_query
def city_lookup_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = registry(spark, sf_dir).select(*CURATED_INPUT)
    return lookup.with_city_name(rows, _without_one(spark, sf_dir))


@_query
def city_lookup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookup.in_named_city(registry(spark, sf_dir), cities(spark, sf_dir), CITY_NAME)
    return measures.type_status_counts(curated(rows, None))


@_query
def city_lookup_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city asked for in capitals without accents, listed with both and with blanks."""
    rows = registry(spark, sf_dir).select(*CURATED_INPUT)
    return lookup.in_city_named_like(rows, accented(cities(spark, sf_dir)), ASKED_NAME)


@_query
def unknown_city_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.unlisted_cities(registry(spark, sf_dir), _without_one(spark, sf_dir))


# --- files and layers -----------------------------------------------------------------------------


@_query
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expected_files(opening_months(spark, sf_dir))


@_query
def manifest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = opening_months(spark, sf_dir)
    return missing_files(expected_files(landed), landed)


@_query
def manifest_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order stands for a landed file, so most expected files are there several times."""
    landed = opening_months(spark, sf_dir)
    return doubled_files(expected_files(landed), landed)


@_query
def snapshot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the names that orders could have been delivered under name a snapshot, or a month."""
    names = delivery_names(spark, sf_dir)
    return names.groupBy(
        names_snapshot("name").alias("is_snapshot"), names_month("name").alias("is_month")
    ).agg(F.count(F.lit(1)).alias("count"))


@_query
def month_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which months of counts have rows: one written, one written without any, one never written."""
    layers = _fresh_layers(spark)
    counts = stamped(gold(spark, sf_dir), CURRENT, "ts_aggregation")
    write_month(counts, layers.gold, CURRENT, GOLD, files="one")
    write_month(counts.filter("count < 0"), layers.gold, PREVIOUS, GOLD, files="one")
    found = [(month, has_month(spark, layers.gold, month, GOLD)) for month in (PREVIOUS, CURRENT, "1999-01")]
    return spark.createDataFrame(found, "month string, has_rows boolean")


@_query
def layout_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract beside files of the city lookup's layout: what doesn't fit, by folder."""
    folder = fresh_folder(spark, "layouts")
    write_extract(registry(spark, sf_dir), f"{folder}/extract")
    lookup_rows = registry(spark, sf_dir).select("municipio", "uf")
    lookup_rows.write.options(**CSV_FORMAT, quoteAll="true").csv(f"{folder}/cities")
    staged = stage_extract(spark, folder, fresh_folder(spark, "staged"))
    remove_folder(spark, folder)
    misfits = misfit_files(staged, SMALL.max_misfit_share)
    return misfits.groupBy(F.element_at(F.split("source_file", "/"), -2).alias("folder")).agg(
        F.sum("lines").alias("lines"), F.min("misfit_share").alias("least_share")
    )


@contextmanager
def _extract(
    spark: SparkSession, rows: DataFrame, write: Callable[[DataFrame, str], None] = write_extract
) -> Iterator[str]:
    """Rows as text files, which are gone when they have been loaded."""
    folder = fresh_folder(spark, "extract")
    try:
        write(rows, folder)
        yield folder
    finally:
        remove_folder(spark, folder)


def _fresh_layers(spark: SparkSession) -> monthly.Layers:
    return monthly.Layers(fresh_folder(spark, "layers"))


#: The tables are far smaller than a month; a twentieth of the rows has no status.
SMALL = Rules(min_bronze_rows=0, min_silver_rows=0, max_null_rate=0.1, stability=0.5)


@_query
def corrupt_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _extract(spark, registry(spark, sf_dir)) as text:
        return measures.corrupt_rate(stage_extract(spark, text, fresh_folder(spark, "staged")))


@_query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _extract(spark, registry(spark, sf_dir)) as text:
        bronze = monthly.load_bronze(spark, text, _fresh_layers(spark), CURRENT, SMALL)
    return bronze.drop("ts_ingestion")


@_query
def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract with line breaks inside quotes, loaded as a month."""
    with _extract(spark, registry(spark, sf_dir), write_broken_extract) as text:
        bronze = monthly.load_bronze(spark, text, _fresh_layers(spark), CURRENT, SMALL, multiline=True)
    return bronze.drop("ts_ingestion")


@_query
def arrivals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract landing in three deliveries, each taken as it comes; the month after the last."""
    layers, landing = _fresh_layers(spark), fresh_folder(spark, "landing")
    rows = registry(spark, sf_dir)
    for turn in range(3):
        write_extract(rows.filter(F.col("record_no") % 3 == turn), f"{landing}/delivery{turn}")
        bronze = monthly.load_arrivals(spark, landing, layers, CURRENT, SMALL)
    remove_folder(spark, landing)
    return bronze.drop("ts_ingestion")


@_query
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _fresh_layers(spark)
    with _extract(spark, registry(spark, sf_dir)) as text:
        monthly.load_bronze(spark, text, layers, CURRENT, SMALL)
    return monthly.read_quarantine(spark, layers, CURRENT).drop("source_file")


@_query
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both snapshots through all layers, the first of them twice; the joins behind the registry are
    made once."""
    layers, folder = _fresh_layers(spark), fresh_folder(spark, "registry")
    raw(spark, sf_dir).write.parquet(folder)
    rows = spark.read.schema(RAW).parquet(folder)
    for month in (PREVIOUS, CURRENT, PREVIOUS):
        monthly.publish_bronze(rows.filter(opened_by(LAST_DAY[month])), layers, month)
        monthly.build_silver(spark, layers, month)
        monthly.build_gold(spark, layers, month)
    remove_folder(spark, folder)
    return monthly.read_gold(spark, layers, [PREVIOUS, CURRENT]).drop("ts_aggregation")


@_query
def month_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month written three times, its current and its previous version read back side by side."""
    layers = _fresh_layers(spark)
    rows = silver(spark, sf_dir)
    for held in (opened_by(LAST_DAY[PREVIOUS]), opened_by(LAST_DAY[CURRENT]), F.lit(True)):
        counts = stamped(measures.type_status_counts(rows.filter(held)), CURRENT, "ts_aggregation")
        write_month(counts, layers.gold, CURRENT, GOLD, files="one")
    newest = current(spark, layers.gold, CURRENT).version
    return reduce(DataFrame.unionAll, [
        read_month(spark, layers.gold, CURRENT, GOLD, version=number).drop("ts_aggregation").withColumn(
            "version", F.lit(number)
        ) for number in (newest, newest - 1)
    ])


@_query
def clustered_city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated rows of the target city, from a bronze month ordered by city."""
    layers = _fresh_layers(spark)
    monthly.publish_bronze(raw(spark, sf_dir), layers, CURRENT)
    bronze = monthly.cluster_bronze(spark, layers, CURRENT, replace(SMALL, file_bytes=4 << 20), 1 << 20)
    return curated(bronze)


@_query
def gold_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of some cities from a month counted by file, one of whose ten files was delivered again with
    half its rows."""
    layers = _fresh_layers(spark)
    file = F.concat(F.lit("part/Estabelecimentos"), F.col("record_no") % 10)
    rows = registry(spark, sf_dir).withColumn("source_file", file)
    again = partials.partial_counts(rows.filter("record_no % 20 = 3"))
    for counts in (
        lambda: partials.partial_counts(rows),
        lambda: partials.renewed(
            read_month(spark, layers.partials, CURRENT, PARTIALS).drop(PARTITION), again, ["Estabelecimentos3"]
        ),
    ):
        write_month(counts().withColumn(PARTITION, F.lit(CURRENT)), layers.partials, CURRENT, PARTIALS)
    return partials.counts_of(read_month(spark, layers.partials, CURRENT, PARTIALS), SOME_CITIES)


@_query
def layer_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months of counts, written and compared."""
    layers = _fresh_layers(spark)
    for month in LAST_DAY:
        rows = stamped(gold_of(spark, sf_dir, month), month, "ts_aggregation")
        write_month(rows, layers.gold, month, GOLD, files="one")
    return monthly.compare_months(spark, layers, CURRENT, PREVIOUS)


@_query
def monthly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files to verdict: the three layers by job name, then the gate of the written month."""
    layers = _fresh_layers(spark)
    with _extract(spark, registry(spark, sf_dir)) as text:
        for job in ("extract", "transform", "aggregate"):
            monthly.run(spark, layers.root, CURRENT, text, job=job, rules=SMALL)
    return checks.business_checks(monthly.read_silver(spark, layers, CURRENT), SMALL)


@_query
def monthly_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from text, the city by its name from a lookup read from text as well: gate, gold
    total and headline figures of the published month."""
    layers, listed = _fresh_layers(spark), fresh_folder(spark, "lookup")
    cities(spark, sf_dir).write.options(**CSV_FORMAT, quoteAll="true").csv(listed)
    names = read_lookup(spark, listed)
    with _extract(spark, registry(spark, sf_dir)) as text:
        # One status in twenty is unknown to the registry and fails the gate, so it is judged after.
        for job in ("extract", "transform", "aggregate"):
            monthly.run(spark, layers.root, CURRENT, text, job=job, rules=SMALL, city_name=CITY_NAME, lookup=names)
    gate = monthly.validate(spark, layers, CURRENT, None, SMALL, monthly.named_cities(names, CITY_NAME))
    counts = monthly.read_gold(spark, layers, CURRENT)
    return measures.side_by_side(gate, measures.grand_total(counts), report.summary(counts, SMALL))


@_query
def monthly_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month loaded again with other rows, its later stages as jobs of their own."""
    layers = _fresh_layers(spark)
    rows = registry(spark, sf_dir)
    with _extract(spark, rows.filter(opened_by(LAST_DAY[PREVIOUS]))) as text:
        for job in ("extract", "transform", "aggregate"):
            monthly.run(spark, layers.root, CURRENT, text, job=job, rules=SMALL)
    with _extract(spark, rows) as text:
        monthly.run(spark, layers.root, CURRENT, text, job="bronze_only", rules=SMALL, force=True)
    for job in ("silver_only", "gold_only"):
        monthly.run(spark, layers.root, CURRENT, job=job, rules=SMALL)
    return monthly.read_gold(spark, layers, CURRENT).drop("ts_aggregation")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract, every file of it packed into an archive of its own."""
    with _extract(spark, registry(spark, sf_dir)) as text:
        return pack_files(
            landed_files(spark, text, "*.csv"), fresh_folder(spark, "archives"),
            fresh_folder(spark, "manifest"),
        )


@_query
def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict over all archives, and the bytes of text that came out of them."""
    archives = _packed(spark, sf_dir)
    verdicts = check_archives(archives).agg(
        F.bool_and("file_exists").alias("all_exist"),
        F.bool_and("is_valid_zip").alias("all_valid"),
        F.bool_and("has_content").alias("all_filled"),
        F.bool_and("all_checks_passed").alias("all_passed"),
    )
    manifest = expand_archives(archives, fresh_folder(spark, "expanded"))
    expanded = manifest.agg(
        F.sum("bytes").alias("bytes"), F.count("problem").alias("problems")
    )
    return measures.side_by_side(verdicts, expanded)


@_query
def archive_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives expanded, loaded as a month, and counted by city."""
    target = fresh_folder(spark, "expanded")
    require_expanded(expand_archives(_packed(spark, sf_dir), target))
    bronze = monthly.load_bronze(spark, target, _fresh_layers(spark), CURRENT, SMALL)
    remove_folder(spark, target)
    return measures.count_by(bronze, "municipio")


def registered() -> dict[str, Query]:
    return dict(_QUERIES)
