"""A month from files to report: ingest, conform, count, check, report."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.fixed import CORRUPT_FIELD, CURATED_INPUT, PARTITION, REQUIRED_FIELDS, Rules
from cartorio.functions.predicates import check_month, check_snapshot
from cartorio.operators import checks
from cartorio.operators.conform import curated, stamped
from cartorio.operators.lookup import cities_named, cities_named_like, codes_listed_twice
from cartorio.operators.measures import corrupt_rate, type_status_counts
from cartorio.operators.partials import counts_of, file_name, partial_counts, renewed
from cartorio.operators.profiles import PROFILE, column_profile, described, merged
from cartorio.operators.report import compare, console_text, summary
from cartorio.sources.archives import expand_archives, require_expanded
from cartorio.sources.arrivals import arrived, take_arrivals
from cartorio.sources.clustering import folder_bytes, write_clustered
from cartorio.sources.delimited import misfit_files, read_lookup, stage_extract
from cartorio.sources.layers import (
    EmptyMonth,
    month_path,
    read_folders,
    read_month,
    require_rows,
    stage_rows,
    write_month,
)
from cartorio.sources.layouts import BRONZE, GOLD, PARTIALS, QUARANTINE, RAW_NAMES, SILVER
from cartorio.sources.manifest import (
    classified,
    doubled_files,
    expected_of,
    landed_files,
    missing_files,
)
from cartorio.sources.scratch import fresh_folder, remove_folder
from cartorio.sources.versions import Record, current, expire, history, months, pending

log = logging.getLogger(__name__)

STAGES = ("bronze", "silver", "gold", "validate", "report")
# Names under which the stages can be asked for.
JOBS = {
    "full": STAGES,
    "bronze_only": ("bronze",),
    "silver_only": ("silver",),
    "gold_only": ("gold",),
    "validate_only": ("validate",),
    "extract": ("bronze",),
    "transform": ("silver",),
    "aggregate": ("gold",),
    "validate": ("validate",),
}


SCHEMAS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}


class StaleMonth(checks.CheckFailed):
    """A layer wasn't built from what the layer below holds now."""


@dataclass(frozen=True)
class Layers:
    """One root for all tables, local or on an object store."""

    root: str

    def __post_init__(self) -> None:
        object.__setattr__(self, "root", self.root.rstrip("/"))

    def of(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    @property
    def bronze(self) -> str:
        return self.of("bronze")

    @property
    def silver(self) -> str:
        return self.of("silver")

    @property
    def gold(self) -> str:
        return self.of("gold")

    @property
    def arrivals(self) -> str:
        """Rows of files as they arrived, staged once each."""
        return self.of("_arrivals")

    @property
    def partials(self) -> str:
        return self.of("partials")

    @property
    def quarantine(self) -> str:
        return self.of("quarantine")

    @property
    def refused(self) -> str:
        """Damaged lines of months that were not published, by month and run."""
        return self.of("refused")


@contextmanager
def _staging(spark: SparkSession, layers: Layers) -> Iterator[str]:
    """A folder of one run under the layers' root; gone when the run has published or failed."""
    folder = f"{layers.root}/_staging/{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        remove_folder(spark, folder)


# --- what a month was built from ------------------------------------------------------------------


def _record(spark: SparkSession, layers: Layers, layer: str, month: str) -> Record | None:
    return current(spark, layers.of(layer), check_snapshot(month))


def scope_of(rules: Rules, cities: DataFrame | None = None) -> str:
    """What rows the curated layer was asked for, as text that is the same for the same cities."""
    if cities is None:
        return "codes " + ",".join(sorted(rules.cities))
    mark = cities.agg(F.count("*").alias("n"), F.sum(F.xxhash64("municipio") % (1 << 40)).alias("mark")).first()
    return f"lookup {mark.n} {mark.mark}"


def _stale(
    spark: SparkSession, layers: Layers, layer: str, month: str, scope: str | None = None
) -> str | None:
    """Why a layer's month must be built (again); None if it rests on what the layer below holds."""
    record = _record(spark, layers, layer, month)
    if record is None:
        return f"{layer} {month} is not published"
    if layer == "bronze":
        return None
    below = {"silver": "bronze", "gold": "silver"}[layer]
    if reason := _stale(spark, layers, below, month, scope):
        return reason
    source = _record(spark, layers, below, month)
    if record.source != source.run:
        return f"{layer} {month} was built from another {below}"
    if scope is not None and record.rules != scope:
        return f"{layer} {month} holds {record.rules}, asked for are {scope}"
    return None


def require_fresh(
    spark: SparkSession, layers: Layers, month: str, scope: str | None = None
) -> None:
    """Refuses a month of which some layer is missing or doesn't rest on the one below."""
    if reason := _stale(spark, layers, "gold", month, scope):
        raise StaleMonth(reason)


def latest_before(spark: SparkSession, layers: Layers, month: str) -> str | None:
    """The last month before this one with published counts."""
    return max((m for m in months(spark, layers.gold) if m < month), default=None)


# --- stages ---------------------------------------------------------------------------------------


def unpack(
    spark: SparkSession, landing: str, month: str, kind: str, folder: str | None = None
) -> str:
    """The month's archives of one file type, under ``landing/<month>``, expanded into one folder.

    Exactly the expected files are expanded. Refused when one of them has not arrived, has arrived
    twice, or cannot be expanded whole.
    """
    place = f"{landing.rstrip('/')}/{check_snapshot(month)}"
    try:
        landed = classified(landed_files(spark, place))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"not landed for {month}: {place}") from error
        raise
    expected = expected_of(spark, month, [kind])
    gap = missing_files(expected, landed).first()
    if gap:
        raise FileNotFoundError(f"not landed for {month}: {gap.file_name}")
    twice = doubled_files(expected, landed).first()
    if twice:
        raise ValueError(f"landed {twice.copies} times for {month}: {twice.file_name}")
    folder = folder or fresh_folder(spark, f"{month}-{kind}")
    archives = landed.join(expected.drop("file_type"), [PARTITION, "file_name"], "left_semi")
    require_expanded(expand_archives(archives.select(F.col("path").alias("archive")), folder))
    return folder


def _set_aside(staged: DataFrame, folder: str) -> None:
    """The damaged lines of a staged extract. Few lines out of many files: rebalanced, or each file
    would leave one of its own."""
    (
        staged.filter("damaged").select(F.col(CORRUPT_FIELD).alias("raw_line"), "source_file")
        .hint("rebalance").write.mode("overwrite").parquet(folder)
    )


def _judge_extract(staged: DataFrame, good: DataFrame, month: str, rules: Rules, check_input: bool) -> None:
    verdict = corrupt_rate(staged, rules).first()
    if verdict.total == verdict.corrupt:
        raise EmptyMonth(f"no usable rows for {month}: {verdict.asDict()}")
    misfit = misfit_files(staged, rules.max_misfit_share).first()
    if misfit:
        raise checks.CheckFailed(f"schema mismatch for {month}: {misfit.asDict()}")
    if not verdict.acceptable:
        raise checks.CheckFailed(f"too many damaged lines for {month}: {verdict.asDict()}")
    if check_input:
        # On the required fields: others are empty by nature (fax, second telephone).
        checks.require(checks.input_checks(good, rules, REQUIRED_FIELDS), f"bronze {month}")
        checks.require(checks.id_checks(good), f"bronze {month}")
    log.info("bronze %s: %s", month, verdict.asDict())


def load_bronze(
    spark: SparkSession,
    paths: str | Sequence[str],
    layers: Layers,
    month: str,
    rules: Rules = Rules(),
    check_input: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Raw files into a new version of one bronze month; damaged lines into quarantine; too much damage:
    nothing.

    The text is parsed and written once, to the folder that becomes the version. The verdicts are plain
    aggregates over what lies there, exact whatever tasks were rerun; if they hold, one record makes it
    current, and with it the quarantine of the same run. The damaged lines of a month that is refused are
    kept too, under the run's own name.
    """
    with pending(spark, layers.bronze, month) as version:
        staged = stage_extract(spark, paths, version.path, "ts_ingestion", multiline)
        good = staged.filter("NOT damaged").drop(CORRUPT_FIELD, "source_file", "damaged", "ts_ingestion")
        run = f"run={version.run}"
        try:
            _judge_extract(staged, good, month, rules, check_input)
        except (checks.CheckFailed, EmptyMonth):
            _set_aside(staged, f"{month_path(layers.refused, month)}/{run}")
            raise
        _set_aside(staged, f"{month_path(layers.quarantine, month)}/{run}")
        _publish(version, Record(version.run), "/damaged=false")
    return read_bronze(spark, layers, month)


def load_arrivals(
    spark: SparkSession, landing: str, layers: Layers, month: str, rules: Rules = Rules(), check_input: bool = True
) -> DataFrame:
    """What has landed for a month so far, as its new version. Files staged by an earlier call aren't read
    again; the verdict is on all of them. Text is parsed once in a file's life, so what a call costs is the
    new text and one copy of the month's rows."""
    folder = f"{layers.arrivals}/{PARTITION}={check_snapshot(month)}"
    take_arrivals(spark, landing, folder)
    staged = arrived(spark, folder)
    with pending(spark, layers.bronze, month) as version:
        good = staged.filter("NOT damaged")
        _judge_extract(
            staged, good.drop(CORRUPT_FIELD, "source_file", "damaged", "ts_ingestion"), month, rules, check_input
        )
        stored = T.StructType([*(f for f in BRONZE if f.name != PARTITION), T.StructField("source_file", T.StringType())])
        stage_rows(good, version.path, stored, rules.file_bytes, "as read")
        _set_aside(staged, f"{month_path(layers.quarantine, month)}/run={version.run}")
        _publish(version, Record(version.run))
    return read_bronze(spark, layers, month)


def profile_bronze(spark: SparkSession, layers: Layers, month: str, rules: Rules = Rules()) -> DataFrame:
    """The profile of a bronze month's raw fields, kept beside it; ``profiles`` merges those of months."""
    record = _record(spark, layers, "bronze", month)
    if record is None:
        raise StaleMonth(f"bronze {month} is not published")
    rows = read_bronze(spark, layers, month, RAW_NAMES, record.version)
    made = column_profile(rows).withColumn(PARTITION, F.lit(month))
    return write_month(made, layers.of("profiles"), month, PROFILE, "one", rules.file_bytes, Record(uuid.uuid4().hex, record.run))


def profiles(spark: SparkSession, layers: Layers, months_: Sequence[str]) -> DataFrame:
    """The columns of some months together, from their profiles alone."""
    return described(merged(read_month(spark, layers.of("profiles"), months_, PROFILE)))


def _publish(version, record: Record, within: str = "") -> None:
    log.info("published %s", version.commit(record, within))


def publish_bronze(
    rows: DataFrame, layers: Layers, month: str, rules: Rules = Rules(), run: str | None = None
) -> DataFrame:
    """Raw rows, already judged, as one bronze month."""
    record = Record(run or uuid.uuid4().hex)
    rows = stamped(rows, month, "ts_ingestion")
    return write_month(rows, layers.bronze, month, BRONZE, "as read", rules.file_bytes, record)


def cluster_bronze(
    spark: SparkSession, layers: Layers, month: str, rules: Rules = Rules(), group_bytes: int = 32 << 20
) -> DataFrame:
    """The rows of a bronze month as a new version, ordered by city: later stages of one city read a few
    row groups. The rows stay those of their run, so nothing built from them grows stale, and a run that
    publishes meanwhile wins."""
    record = _record(spark, layers, "bronze", month)
    if record is None:
        raise StaleMonth(f"bronze {month} is not published")
    rows = read_bronze(spark, layers, month, version=record.version)
    ranges = -(-folder_bytes(spark, f"{layers.bronze}/{record.folder}") // rules.file_bytes)
    with pending(spark, layers.bronze, month, record.version) as version:
        write_clustered(rows, version.path, BRONZE, ranges, group_bytes)
        _publish(version, replace(record, rules="clustered"))
    return read_bronze(spark, layers, month)


def _with_files(spark: SparkSession, layers: Layers, record: Record) -> DataFrame:
    """The raw rows of a version with the file each came from (null where that isn't known)."""
    schema = T.StructType([*BRONZE, T.StructField("source_file", T.StringType())])
    return read_folders(spark, layers.bronze, [f"{layers.bronze}/{record.folder}"], schema)


def build_partials(spark: SparkSession, layers: Layers, month: str, rules: Rules = Rules()) -> DataFrame:
    """Counts of a bronze month by city, type, status and file, from one scan of four columns."""
    record = _record(spark, layers, "bronze", month)
    if record is None:
        raise StaleMonth(f"bronze {month} is not published")
    counts = partial_counts(_with_files(spark, layers, record))
    return _publish_partials(counts, layers, month, record.run, rules)


def _publish_partials(
    counts: DataFrame, layers: Layers, month: str, source: str, rules: Rules, base: int | None = None
) -> DataFrame:
    record = Record(uuid.uuid4().hex, source)
    rows = counts.withColumn(PARTITION, F.lit(month))
    return write_month(rows, layers.partials, month, PARTIALS, "rebalanced", rules.file_bytes, record, base)


def gold_from_partials(
    spark: SparkSession, layers: Layers, month: str, cities: Sequence[str] | None
) -> DataFrame:
    """Counts of any cities without a scan of bronze; refused if bronze has changed since it was counted."""
    bronze, counted = _record(spark, layers, "bronze", month), _record(spark, layers, "partials", month)
    if counted is None or bronze is None or counted.source != bronze.run:
        raise StaleMonth(f"bronze {month} isn't counted as it is now")
    rows = read_month(spark, layers.partials, month, PARTIALS, version=counted.version)
    return counts_of(rows, cities)


def replace_files(
    spark: SparkSession, paths: str | Sequence[str], layers: Layers, month: str, rules: Rules = Rules(),
    check_input: bool = True, multiline: bool = False,
) -> DataFrame:
    """Some files of a month loaded again: their rows take the place of those that files of the same names
    brought, as a new version. Only these files are parsed, judged and counted; the counts of the others
    are kept."""
    record = _record(spark, layers, "bronze", month)
    if record is None:
        raise StaleMonth(f"bronze {month} is not published")
    counted = _record(spark, layers, "partials", month)
    with pending(spark, layers.bronze, month, record.version) as version:
        staged = stage_extract(spark, paths, version.path, "ts_ingestion", multiline)
        good = staged.filter("NOT damaged")
        fields = good.drop(CORRUPT_FIELD, "source_file", "damaged", "ts_ingestion")
        _judge_extract(staged, fields, month, rules, check_input)
        # A name for each file of the delivery, with or without sound rows.
        names = [row[0] for row in staged.select(file_name().alias("name")).distinct().collect()]
        old = _with_files(spark, layers, record).drop(PARTITION)
        others = old.filter(F.col("source_file").isNull() | ~file_name().isin(names))
        others.write.mode("append").parquet(f"{version.path}/damaged=false")
        _set_aside(staged, f"{month_path(layers.quarantine, month)}/run={version.run}")
        counts = None
        if counted is not None and counted.source == record.run:
            kept = read_month(spark, layers.partials, month, PARTIALS, version=counted.version).drop(PARTITION)
            counts = renewed(kept, partial_counts(good), names)
        _publish(version, Record(version.run), "/damaged=false")
        if counts is not None:
            _publish_partials(counts, layers, month, version.run, rules, counted.version)
    return read_bronze(spark, layers, month)


def read_quarantine(spark: SparkSession, layers: Layers, month: str) -> DataFrame:
    """The damaged lines of the run that the month holds now."""
    record = _record(spark, layers, "bronze", month)
    path = f"{month_path(layers.quarantine, month)}/run={record.run if record else 'none'}"
    return read_folders(spark, layers.quarantine, [path], QUARANTINE)


def read_refused(spark: SparkSession, layers: Layers, month: str) -> DataFrame:
    """Damaged lines of refused runs of the month, with the run."""
    schema = T.StructType([*QUARANTINE, T.StructField("run", T.StringType())])
    return read_folders(spark, layers.refused, [month_path(layers.refused, month)], schema)


def read_bronze(
    spark: SparkSession, layers: Layers, month: str, columns: Sequence[str] | None = None,
    version: int | None = None,
) -> DataFrame:
    return read_month(spark, layers.bronze, month, BRONZE, columns, version)


def read_silver(spark: SparkSession, layers: Layers, month: str) -> DataFrame:
    return read_month(spark, layers.silver, month, SILVER)


def read_gold(spark: SparkSession, layers: Layers, months: str | Sequence[str]) -> DataFrame:
    return read_month(spark, layers.gold, months, GOLD)


def build_silver(
    spark: SparkSession,
    layers: Layers,
    month: str,
    rules: Rules = Rules(),
    show_plan: bool = False,
    cities: DataFrame | None = None,
) -> DataFrame:
    """One curated month from the ten columns it needs; of ``cities`` or else of the rules' codes.

    The city filter keeps a few rows of each file, so the result is rebalanced when it is written: the
    shuffle moves those rows only, and saves thousands of tiny files. Whether there are any is read off
    the written files before they become the month, so bronze is scanned once.
    """
    source = _record(spark, layers, "bronze", month)
    if source is None:
        raise StaleMonth(f"bronze {month} is not published")
    bronze = read_bronze(spark, layers, month, CURATED_INPUT, source.version)
    if cities is None:
        rows = curated(bronze, rules.cities)
    else:
        rows = curated(bronze.join(cities.select("municipio"), "municipio", "left_semi"), None)
    rows = stamped(rows, month, "ts_transform")
    if show_plan:
        rows.explain("formatted")
    scope = scope_of(rules, cities)
    with pending(spark, layers.silver, month) as version:
        stage_rows(rows, version.path, SILVER, rules.file_bytes)
        count = spark.read.schema(SILVER).parquet(version.path).count()
        if not count:
            require_rows(bronze, f"bronze {month}")
            raise EmptyMonth(f"no rows of {month} for {scope}")
        _publish(version, Record(version.run, source.run, scope, count))
    return read_silver(spark, layers, month)


def build_gold(spark: SparkSession, layers: Layers, month: str, rules: Rules = Rules()) -> DataFrame:
    """Counts of one month, published only if they add up to the curated rows.

    The counts are written, judged as they lie there against the rows of silver (counted from the file
    footers), and those counts become the month: silver is aggregated once.
    """
    reason = _stale(spark, layers, "silver", month)
    if reason:
        raise StaleMonth(reason)
    source = _record(spark, layers, "silver", month)
    silver = read_month(spark, layers.silver, month, SILVER, version=source.version)
    with pending(spark, layers.gold, month) as version:
        stage_rows(stamped(type_status_counts(silver), month, "ts_aggregation"), version.path, GOLD, rules.file_bytes, "one")
        sums = checks.reconcile(silver, spark.read.schema(GOLD).parquet(version.path)).first()
        if not sums.silver_rows:
            raise EmptyMonth(f"no rows: silver {month}")
        if not sums.matches:
            raise checks.CheckFailed(f"gold {month} does not add up: {sums.asDict()}")
        log.info("gold %s: %s", month, sums.asDict())
        _publish(version, Record(version.run, source.run, source.rules, sums.gold_sum))
    return read_gold(spark, layers, month)


def expire_versions(spark: SparkSession, layers: Layers, month: str, keep: int = 2) -> list[str]:
    """Removes all but the last ``keep`` versions of a month from every layer; returns the folders."""
    gone = []
    for layer in SCHEMAS:
        gone += expire(spark, layers.of(layer), month, keep)
    # A version laid out anew keeps the run, and with it the quarantine, of the one it was made from.
    left = {f"run={record.run}" for record in history(spark, layers.bronze, month)}
    for folder in gone:
        name = folder.rsplit("/", 1)[1]
        if folder.startswith(f"{layers.bronze}/") and name not in left:
            remove_folder(spark, f"{month_path(layers.quarantine, month)}/{name}")
    return gone


def validate(
    spark: SparkSession,
    layers: Layers,
    month: str,
    previous: str | None = None,
    rules: Rules = Rules(),
    cities: DataFrame | None = None,
) -> DataFrame:
    """Business and output checks of a written month as one row; compares with a previous month.

    A month whose layers don't rest on each other is refused before anything is judged.
    """
    require_fresh(spark, layers, month)
    silver, gold = read_silver(spark, layers, month), read_gold(spark, layers, month)
    before = read_gold(spark, layers, previous) if previous else None
    return checks.run_gate(
        checks.business_checks(silver, rules, cities),
        checks.output_checks(silver, gold, before, rules),
    )


def report(
    spark: SparkSession, layers: Layers, month: str, rules: Rules = Rules()
) -> Row:
    require_fresh(spark, layers, month)
    figures = summary(read_gold(spark, layers, month), rules).first()
    if not figures.ratio_expected:
        log.warning("branches per headquarters unusual: %s", figures.ratio_filial_matriz)
    return figures


def compare_months(
    spark: SparkSession, layers: Layers, current: str, previous: str, rules: Rules = Rules()
) -> DataFrame:
    return compare(read_gold(spark, layers, [current, previous]), current, previous, rules)


def named_cities(lookup: DataFrame, name: str) -> DataFrame:
    """The codes of a city name; refuses a lookup that lists a code twice or not the name.

    A name that isn't listed as it is written stands for the one that differs by accents, case or blanks;
    if there are several such names, none is taken for it.
    """
    twice = codes_listed_twice(lookup).first()
    if twice:
        raise ValueError(f"city code listed {twice['count']} times: {twice.code}")
    cities = cities_named(lookup, name)
    if not cities.isEmpty():
        return cities
    alike = cities_named_like(lookup, name)
    names = [row.name for row in alike.select("name").distinct().limit(2).collect()]
    if not names:
        raise ValueError(f"no city named {name!r} in the lookup")
    if len(names) > 1:
        raise ValueError(f"no city named {name!r} in the lookup, but {names[0]!r} and {names[1]!r}")
    return alike.select("municipio")


def run(
    spark: SparkSession,
    root: str,
    month: str,
    paths: str | Sequence[str] | None = None,
    landing: str | None = None,
    job: str = "full",
    skip_ingest: bool = False,
    force: bool = False,
    previous: str | None = None,
    city_name: str | None = None,
    lookup: DataFrame | None = None,
    check_input: bool = True,
    check_stability: bool = True,
    rules: Rules = Rules(),
    show_plan: bool = False,
    multiline: bool = False,
) -> Row | None:
    """The stages a job name stands for, in order; returns the report row if it was asked for.

    Text comes from ``paths`` or from the archives in ``landing``, where the city lookup lies too. A
    layer is built when the month isn't published in it, when it was built from something else than
    the layer below holds now, when other cities are asked for, or when ``force`` is set; whatever
    jobs were run before, and wherever they broke off. The month is compared with ``previous``, or
    else with the last month before it that has counts.
    """
    check_month(month)
    stages, layers = JOBS[job], Layers(root)
    if city_name and lookup is None and not landing:
        raise ValueError("a city name needs the city lookup, or a landing folder with it")
    with _staging(spark, layers) as folder:
        cities = None
        if city_name:
            if lookup is None:
                text = unpack(spark, landing, month, "municipios", f"{folder}/municipios")
                lookup = read_lookup(spark, text)
            cities = named_cities(lookup, city_name)
        scope = scope_of(rules, cities)
        if "bronze" in stages and not skip_ingest and (force or _stale(spark, layers, "bronze", month)):
            source = paths or []
            if landing:
                source = unpack(spark, landing, month, "estabelecimentos", f"{folder}/extract")
            load_bronze(spark, source, layers, month, rules, check_input, multiline)
        if "silver" in stages and (force or _stale(spark, layers, "silver", month, scope)):
            build_silver(spark, layers, month, rules, show_plan, cities)
        if "gold" in stages and (force or _stale(spark, layers, "gold", month, scope)):
            build_gold(spark, layers, month, rules)
        if "validate" in stages:
            require_fresh(spark, layers, month, scope)
            if previous is None and check_stability:
                previous = latest_before(spark, layers, month)
            verdict = validate(spark, layers, month, previous, rules, cities)
            checks.require(verdict, f"month {month}", "all_passed")
        if "report" not in stages:
            return None
        require_fresh(spark, layers, month, scope)
        figures = report(spark, layers, month, rules)
        print(console_text(month, figures))
        return figures
