"""Every registered query: one function of (spark, folder) each.

All of them read the whole test tables. The item queries run on the feed of
:mod:`panelyard.plans.star`, the ingestion ones on ``events`` and ``documents``.
"""

from __future__ import annotations

import dataclasses
from datetime import date, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.functions import scalars
from panelyard.functions.calendar import chunk_grid
from panelyard.operators import checks, chunks, features, folds, items, panel, reports, transform
from panelyard.plans.collect import collect, rejected_pages, summarize
from panelyard.plans.prepare import load_items, run_stages
from panelyard.plans.star import (FEED_ORDER, ROLE_INPUTS, SPEC, by_role, kept_layer, lines_first, raw_feed, table,
                                  typed_items, unique_items, with_dimensions, with_roles)
from panelyard.session import delete, make_marker, scratch_path, scratch_run, shuffles_freed, staged
from panelyard.sources import csv_items, landing, manifest, pages
from panelyard.sources.known_items import KnownItems
from panelyard.spec import CollectSpec, Layers
from panelyard.streaming import feed

ROLES = SPEC.columns
CHUNK_DAYS = 7
FOLDS = 5
PAGE_SIZE = 200

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def for_freq(freq: str):
    return dataclasses.replace(SPEC, freq=freq)


# --- items --------------------------------------------------------------------

@query
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, the first of its copies."""
    return items.first_per_key(table(spark, folder, "lineitem"),
                               ["l_orderkey", "l_linenumber"], FEED_ORDER)


@query
def dedup_last(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, the last of its copies."""
    return items.first_per_key(table(spark, folder, "lineitem"),
                               ["l_orderkey", "l_linenumber"], FEED_ORDER, keep="last")


@query
def typed_item_table(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplicated, typed items in the wanted status, dead columns dropped."""
    return items.drop_dead_columns(typed_items(spark, folder))


@query
def text_coercion(spark: SparkSession, folder: str) -> DataFrame:
    """The feed written as text with its usual damage, then typed again."""
    lines = table(spark, folder, "lineitem")
    damage = F.pmod("l_orderkey", F.lit(7))
    price = F.col("l_extendedprice").cast("string")
    text = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.when(damage == 0, "NA").when(damage == 1, "abc").when(damage == 2, "")
        .when(damage == 3, F.concat(price, F.lit("d"))).when(damage == 4, F.concat(F.lit(" "), price))
        .otherwise(price).alias(ROLES.awarded),
        F.concat(F.col("l_partkey").cast("string"), F.lit(".0")).alias(ROLES.class_code),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias(ROLES.included_at))
    clean = text.withColumn(ROLES.awarded, scalars.missing_to_null(F.col(ROLES.awarded)))
    result = items.typed(clean, SPEC)
    return result.withColumns({
        "texto": scalars.short_text(F.concat_ws(" ", ROLES.class_code, ROLES.awarded), 9),
        "numero": scalars.brazilian_number(F.col(ROLES.awarded).cast("decimal(18,2)"), 2)})


@query
def source_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Equality filters, the unset one left out, over a window of days."""
    narrowed = items.matching(raw_feed(spark, folder),
                              {ROLES.kind: "F", ROLES.status: "O", ROLES.class_code: None})
    recent = items.since(narrowed, ROLES.included_at, F.lit(date(1995, 6, 30)), 365)
    return items.select_present(recent, [
        ROLES.item_id, ROLES.included_at, ROLES.kind, ROLES.status, ROLES.estimated, "absent"])


@query
def kept_items(spark: SparkSession, folder: str) -> DataFrame:
    """Items that pass the plausibility ceiling; never-awarded ones do."""
    return items.split_suspects(typed_items(spark, folder), SPEC)[0]


@query
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Items above the ceiling, with the reason."""
    return items.split_suspects(typed_items(spark, folder), SPEC)[1]


@query
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicates, off-status rows and quarantine of one run."""
    raw = table(spark, folder, "lineitem").agg(F.count(F.lit(1)))
    return reports.stage_metrics(unique_items(spark, folder), raw, SPEC)


# --- classes and panel ----------------------------------------------------------

@query
def class_totals(spark: SparkSession, folder: str) -> DataFrame:
    return panel.class_totals(kept_items(spark, folder), SPEC)


@query
def top_classes(spark: SparkSession, folder: str) -> DataFrame:
    return panel.top_classes(kept_items(spark, folder), SPEC)


@query
def reduced_class(spark: SparkSession, folder: str) -> DataFrame:
    """Every kept item with its class bucket."""
    layer = kept_layer(spark, folder, ROLES.item_id, ROLES.class_code, ROLES.awarded)
    return panel.with_reduced_class(layer, SPEC).select(ROLES.item_id, ROLES.class_code, panel.CLASS)


def _panel_items(spark, folder) -> DataFrame:
    return kept_layer(spark, folder, *panel.item_columns(SPEC))


@query
def panel_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells with purchases, before the rectangle is completed."""
    return panel.panel_cells(_panel_items(spark, folder), SPEC)


def _panel(spark, folder, freq: str) -> DataFrame:
    return panel.to_panel(_panel_items(spark, folder), for_freq(freq))


@query
def panel_weekly(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(spark, folder, "W")


@query
def panel_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(spark, folder, "M")


@query
def panel_quarterly(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(spark, folder, "Q")


@query
def panel_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(spark, folder, "D")


@query
def panel_ranked_medians(spark: SparkSession, folder: str) -> DataFrame:
    """The medians of the daily cells, taken by distributed rank as all of them are."""
    cells = panel.panel_cells(_panel_items(spark, folder), for_freq("D"))
    return cells.select(*panel.panel_key(SPEC), "n_itens", "qtd_mediana", "preco_unitario_mediano")


@query
def panel_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, periods, pairs and total of the panel next to the kept total."""
    layer = _panel_items(spark, folder)
    facts = checks.panel_facts(panel.to_panel(layer, SPEC), SPEC)
    expected = layer.agg(scalars.money_sum(F.col(ROLES.awarded), SPEC.sum_scale)).scalar()
    return facts.select("n_rows", "n_periods", "n_combos", F.round("total", 2).alias("total"),
                        F.round(expected, 2).alias("expected"))


# --- features -------------------------------------------------------------------

def _features(spark, folder, freq: str) -> DataFrame:
    spec = for_freq(freq)
    rows = features.build_features(_panel(spark, folder, freq), spec)
    # Adding zero turns -0.0 into 0.0.
    waves = {c: F.round(c, 6) + F.lit(0.0) for c in ("sazonal_sen", "sazonal_cos")}
    return rows.withColumns(waves)


@query
def features_weekly(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder, "W")


@query
def features_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder, "M")


@query
def features_quarterly(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder, "Q")


@query
def features_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder, "D")


@query
def annual_lag_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows of the weekly panel have a value for each lag, and which
    annual lags have none."""
    rows = staged(features_weekly(spark, folder), "features")
    empty = ",".join(features.empty_annual_lags(rows, SPEC))
    names = [n for n in features.numeric_features(SPEC) if "_lag_" in n]
    return rows.agg(*[F.count(n).alias(n) for n in names],
                    F.count_distinct(panel.PERIOD).alias("n_periodos"),
                    F.lit(empty).alias("empty_lags"))


# --- rankings and report tables -----------------------------------------------

@query
def rank_kind(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ranking(raw_feed(spark, folder), ROLES.kind, SPEC)


@query
def rank_category(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ranking(raw_feed(spark, folder), ROLES.category, SPEC, 20)


@query
def rank_description(spark: SparkSession, folder: str) -> DataFrame:
    return reports.with_label(reports.ranking(raw_feed(spark, folder), ROLES.description, SPEC, 20))


@query
def rank_over_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking by category of a raw table that grows by three runs, with a summary after
    each: totals of finished runs are kept, so the last reads the last run only."""
    path = scratch_path(spark, "raw")
    rows = raw_feed(spark, folder).withColumn("run", F.pmod(F.xxhash64(ROLES.item_id), F.lit(3)).cast("int") + 1)
    for run in (1, 2, 3):
        rows.where(F.col("run") == run).write.mode("append").parquet(path)
        make_marker(spark, f"{path}.runs/finished/{run}")
        summary = summarize(spark, path, SPEC)
    return summary[ROLES.category]


@query
def rank_estimated(spark: SparkSession, folder: str) -> DataFrame:
    """Without an awarded column the ranking falls back to the estimate."""
    return reports.ranking(raw_feed(spark, folder).drop(ROLES.awarded), ROLES.supplier, SPEC, 20)


@query
def weekly_raw_vs_kept(spark: SparkSession, folder: str) -> DataFrame:
    typed = staged(typed_items(spark, folder).select(ROLES.included_at, ROLES.awarded), "typed")
    return reports.weekly_before_after(typed, SPEC)


@query
def composition_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return reports.composition(panel_weekly(spark, folder), SPEC)


@query
def log_histogram(spark: SparkSession, folder: str) -> DataFrame:
    bins = reports.log_histogram(kept_layer(spark, folder, ROLES.awarded), SPEC)
    return bins.withColumns({"de": F.round("de", 4), "ate": F.round("ate", 4)})


@query
def median_value(spark: SparkSession, folder: str) -> DataFrame:
    return reports.median_value(kept_layer(spark, folder, ROLES.awarded), SPEC)


@query
def median_value_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The median over all items before the plausibility split, one group."""
    return reports.median_value(staged(typed_items(spark, folder).select(ROLES.awarded), "awarded"), SPEC)


@query
def quarantine_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    return reports.quarantine_by_reason(quarantine(spark, folder), SPEC)


# --- chunks, pages, landing -----------------------------------------------------

def _event_window(spark, folder) -> DataFrame:
    events = table(spark, folder, "events")
    return events.agg(F.min("ts").cast("date").alias("first"),
                      F.date_add(F.max("ts").cast("date"), 1).alias("last"))


@query
def date_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The grid that covers the events."""
    return chunk_grid(_event_window(spark, folder), "first", "last", CHUNK_DAYS)


@query
def chunk_assignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every event with the chunk it belongs to."""
    return (chunks.with_chunk(table(spark, folder, "events"), "ts", CHUNK_DAYS)
            .select("event_id", "chunk_start", "chunk_end", "chunk_key"))


@query
def pending_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks left to read once the closed ones are in the manifest."""
    path = scratch_path(spark, "manifest")
    manifest.mark_chunks(closed_chunks(spark, folder), path)
    return chunks.pending_chunks(date_chunks(spark, folder), manifest.load_manifest(spark, path))


@query
def closed_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks that are over at the time of the last event."""
    latest = _event_window(spark, folder).select(F.date_sub("last", 1)).scalar()
    return chunks.closed_chunks(date_chunks(spark, folder), latest)


def _landed_pages(spark, folder) -> DataFrame:
    """The events as landed pages: a chunk's events in blocks of event ids."""
    record = F.struct("event_id", "user_id", "event_type", "value")
    events = chunks.with_chunk(table(spark, folder, "events"), "ts", CHUNK_DAYS)
    block = F.expr(f"event_id div {PAGE_SIZE}")
    paged = (events.groupBy("chunk_start", block.alias("block"))
             .agg(F.array_sort(F.collect_list(record)).alias(pages.RECORDS)))
    ends = (paged.groupBy("chunk_start")
            .agg(F.min("block").alias("first"), F.max("block").alias("last")))
    body = F.to_json(F.struct(
        pages.RECORDS, (F.col("last") - F.col("block")).cast("int").alias(pages.REMAINING)))
    # One row per chunk: bounded by the calendar.
    return paged.join(F.broadcast(ends), "chunk_start").select(
        "chunk_start", (F.col("block") - F.col("first") + 1).cast("int").alias("page"),
        body.alias("payload"))


def _one_json_page_a_line(landed: DataFrame) -> DataFrame:
    """Page texts with the page number put inside the object."""
    inside = F.concat(F.lit('{"page":'), F.col("page"), F.lit(","), F.expr("substring(payload, 2)"))
    return landed.select("chunk_start", inside.alias("value"))


_EVENT_RECORD = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


@query
def page_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all landed pages."""
    parsed = pages.parse_pages(_landed_pages(spark, folder), "payload", _EVENT_RECORD)
    return pages.page_rows(pages.served_pages(parsed))


@query
def page_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """State of every chunk's landed pages."""
    landed = _landed_pages(spark, folder)
    states = pages.page_completeness(pages.parse_pages(landed, "payload", _EVENT_RECORD))
    return states.drop("n_broken")


def _cut_off(landed: DataFrame) -> DataFrame:
    """Every third page loses the second half of its text."""
    half = F.expr("substring(payload, 1, length(payload) div 2)")
    return landed.withColumn("payload", F.when(F.col("page") % 3 == 2, half).otherwise(F.col("payload")))


@query
def broken_pages(spark: SparkSession, folder: str) -> DataFrame:
    """State of every page when some are cut off and some never came, and how many records
    each chunk serves then."""
    landed = _cut_off(_landed_pages(spark, folder)).where("page % 5 <> 4")
    parsed = pages.parse_pages(landed, "payload", _EVENT_RECORD)
    facts = pages.page_completeness(parsed).select("chunk_start", "n_records", "n_broken", "complete")
    return pages.page_states(parsed).join(facts, "chunk_start")


@query
def collected_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and distinct events per chunk of the table two runs leave behind: the
    second one reads only the chunk that was still open, once more."""
    root = scratch_path(spark, "collect")
    landed = _one_json_page_a_line(_landed_pages(spark, folder))
    landed.write.partitionBy("chunk_start").text(f"{root}/pages")
    window = _event_window(spark, folder).first()
    spec = CollectSpec(end_date=window["last"], window_days=(window["last"] - window["first"]).days,
                       chunk_days=CHUNK_DAYS, columns=("event_id", "event_type", "value"))
    for _ in range(2):
        collect(spark, spec, f"{root}/pages", pages.text_record(_EVENT_RECORD.names),
                f"{root}/table", f"{root}/manifest", window["last"] - timedelta(days=1),
                one_per_file=False)
    return (spark.read.parquet(f"{root}/table").groupBy("chunk_start")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_events")))


@query
def collected_after_repair(spark: SparkSession, folder: str) -> DataFrame:
    """The collector meets broken pages, leaves their chunks open, and closes them in the run
    after whole copies have landed: events and rejected pages per chunk, and its state."""
    root = scratch_path(spark, "repair")
    landed = _landed_pages(spark, folder)
    window = _event_window(spark, folder).first()
    spec = CollectSpec(end_date=window["last"], window_days=(window["last"] - window["first"]).days,
                       chunk_days=CHUNK_DAYS, columns=("event_id", "event_type", "value"))
    states = []
    for part in (_cut_off(landed), landed.where("page % 3 = 2")):
        _one_json_page_a_line(part).write.mode("append").partitionBy("chunk_start").text(f"{root}/pages")
        states.append(collect(spark, spec, f"{root}/pages", pages.text_record(_EVENT_RECORD.names),
                              f"{root}/table", f"{root}/manifest", window["last"] + timedelta(days=CHUNK_DAYS),
                              one_per_file=False))
    events = spark.read.parquet(f"{root}/table").groupBy("chunk_start").agg(
        F.count_distinct("event_id").alias("n_events"))
    rejected = spark.read.parquet(rejected_pages(f"{root}/table")).groupBy("chunk_start").agg(
        F.count(F.lit(1)).alias("n_rejected"))
    first = states[0].select("chunk_start", F.col("closed").alias("closed_at_once"))
    done = manifest.load_manifest(spark, f"{root}/manifest").select("chunk_start", F.lit(True).alias("closed"))
    return (events.join(rejected, "chunk_start", "left").join(first, "chunk_start").join(done, "chunk_start", "left")
            .select("chunk_start", "n_events", F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"),
                    "closed_at_once", F.coalesce("closed", F.lit(False)).alias("closed")))


@query
def landing_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends to one table: the first pins the columns for the second."""
    path = scratch_path(spark, "landing")
    lines = table(spark, folder, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    landing.append_landing(lines.where(returned), path, columns)
    landing.append_landing(lines.where(~returned), path, [*columns, "l_tax"])
    return spark.read.parquet(path)


@query
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents through a CSV landing table and the tolerant scan."""
    path = scratch_path(spark, "csv")
    texts = table(spark, folder, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    landing.append_landing(texts, path, fmt="csv")
    rows = csv_items.scan_csv(spark, path, tokens=None).rows
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        F.col("doc_id").cast("long"), "lang", "source", F.md5(text).alias("text_md5"),
        F.length(text).alias("length"), F.col("n_chars").cast("long"))


_LINES_PER_FILE = 75_000


def _text_files(lines: DataFrame, header: str, path: str, files: int = 8) -> None:
    """(place, value) rows as ``files`` text files, or more for long tables, that all begin with
    the header line. A task sorts a few files, and equal remainders of places do not meet in one."""
    files = max(files, -(-lines.count() // _LINES_PER_FILE))
    dealt = lines.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(files)))
    headers = lines.sparkSession.range(files).select(
        F.lit(-1).cast("long").alias("place"), F.lit(header).alias("value"), F.col("id").alias("part"))
    (dealt.unionByName(headers).repartition(files, "part").sortWithinPartitions("part", "place")
     .select("value", "part").write.mode("append").partitionBy("part").text(path))


def _unfinished_file(spark: SparkSession, path: str, text: str, mode: str = "append") -> None:
    """A file with exactly this text. The writer ends every row with a separator: here
    the last character."""
    row = spark.range(1).select(F.lit(text[:-1]).alias("value")).coalesce(1)
    row.write.mode(mode).option("lineSep", text[-1]).text(path)


@query
def csv_stray_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as CSV with single quotes inside unquoted fields, text behind closing
    quotes, and line breaks inside quotes in every third one."""
    path = scratch_path(spark, "stray")
    number = F.col("doc_id") % 3
    text = (F.when(number == 0, F.concat(F.lit('"two\n'), "lang", F.lit(', ""lines"""')))
            .when(number == 1, F.concat(F.lit('pipe 5" '), "lang"))
            .otherwise(F.concat(F.lit('"quoted"'), "lang")))
    lines = table(spark, folder, "documents").select(
        F.col("doc_id").alias("place"),
        F.concat_ws(",", F.col("doc_id").cast("string"), text, "source").alias("value"))
    _text_files(lines, "id,text,source", path)
    rows = csv_items.scan_csv(spark, path, tokens=None).rows
    return rows.select(F.col("id").cast("long").alias("doc_id"), "text", "source")


@query
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as CSV, some with a field too many, some with one too few, and some
    far wider than any parser's limit."""
    path = scratch_path(spark, "rejects")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    kind = F.pmod(key, F.lit(5))
    extra = F.when((kind == 1) & (key % 1000 == 1), F.repeat(F.lit(","), 25_000)) \
        .when(kind == 1, F.lit(",more")).otherwise("")
    body = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    last = F.when(kind == 2, "").otherwise(F.concat(F.lit(","), F.col("l_quantity").cast("string")))
    # Every copy of an order line is one record: the feed repeats some.
    lines = table(spark, folder, "lineitem").select(key.alias("place"), F.concat(body, last, extra).alias("value"))
    _text_files(lines, "order,line,quantity", path)
    raw = csv_items.scan_csv(spark, path)
    good = raw.rows.select("order", "line", "quantity", F.lit(False).alias("rejected"))
    parts = F.split("record", ",", 4)
    bad = raw.rejects.select(parts[0].alias("order"), parts[1].alias("line"), parts[2].alias("quantity"),
                             F.lit(True).alias("rejected"))
    return good.unionByName(bad).select(
        F.col("order").cast("long"), F.col("line").cast("long"), F.col("quantity").cast("double"), "rejected")


def _damaged(spark: SparkSession, folder: str, rest: str) -> str:
    """All document ids as CSV, and a file that ends in ``rest``."""
    path = scratch_path(spark, "damaged")
    lines = table(spark, folder, "documents").select(
        F.col("doc_id").alias("place"), F.concat_ws(",", F.col("doc_id").cast("string"), "lang").alias("value"))
    _text_files(lines, "id,lang", path)
    _unfinished_file(spark, f"{path}/part=99", f"id,lang\n{rest}")
    return path


@query
def csv_torn_tail(spark: SparkSession, folder: str) -> DataFrame:
    """A file that ends in half a row loses that row, and only that."""
    raw = csv_items.scan_csv(spark, _damaged(spark, folder, "-5,en\n-7,e"))
    return raw.rows.select(F.col("id").cast("long").alias("doc_id"), "lang",
                           F.lit(raw.notes["torn_files"]).cast("long").alias("torn_files"))


@query
def csv_open_quote(spark: SparkSession, folder: str) -> DataFrame:
    """A file that ends inside quotes is an error."""
    path = _damaged(spark, folder, '-7,"e\n')
    try:
        csv_items.scan_csv(spark, path)
        state = "read"
    except csv_items.OpenQuoteError:
        state = "open quote"
    return table(spark, folder, "documents").agg(
        F.lit(state).alias("state"), F.count(F.lit(1)).alias("n_documents"))


@query
def csv_changed_while_read(spark: SparkSession, folder: str) -> DataFrame:
    """Of two files that end in half a row one is written on during the read: its row is
    kept, the other's is dropped, and both are noted."""
    path = _damaged(spark, folder, "-7,e")
    _unfinished_file(spark, f"{path}/part=98", "id,lang\n-8,e")
    looks = []

    def look(*args) -> DataFrame:
        found = csv_items.listing(*args)
        if not looks:
            _unfinished_file(spark, f"{path}/part=99", "id,lang\n-7,en\n-9,d", "overwrite")
        looks.append(1)
        return found

    raw = csv_items.scan_csv(spark, path, listing=look)
    return raw.rows.select(F.col("id").cast("long").alias("doc_id"), "lang",
                           F.lit(raw.notes["changed"]).alias("changed"),
                           F.lit(raw.notes["torn_files"]).cast("long").alias("torn_files"))


@query
def dedup_first_across_appends(spark: SparkSession, folder: str) -> DataFrame:
    """The copy of the first append is kept: half of the lines come in both."""
    path = scratch_path(spark, "appends")
    lines = dedup_first(spark, folder).select("l_orderkey", "l_linenumber")
    for run, part in ((1, lines.where("l_orderkey % 2 = 0")), (2, lines)):
        landing.append_landing(part.withColumn("run", F.lit(run)).repartition(3), path, fmt="csv")
    rows = csv_items.scan_csv(spark, path).rows
    first = items.first_per_key(rows, ["l_orderkey", "l_linenumber"], [csv_items.ORDER])
    return first.select(*[F.col(c).cast("long") for c in ("l_orderkey", "l_linenumber", "run")])


@query
def dedup_against_index(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines that come in three runs, each deduplicated against the ids that are known."""
    lines = table(spark, folder, "lineitem")
    item = F.concat_ws("-", "l_orderkey", "l_linenumber")
    known = KnownItems(spark, scratch_path(spark, "known_lines"), "item")
    year = F.year("l_shipdate")
    runs = F.when(year < 1997, 1).when(year < 2000, 2).otherwise(3)
    for run in (1, 2, 3):
        known.add(lines.where(runs == run).withColumn("item", item), FEED_ORDER, run)
    return known.rows().drop("item")


@query
def prepared_from_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to panel: the collector reads all chunks, later the open ones once more with
    changed copies, and the first copy of an item counts."""
    target = scratch_path(spark, "kept")
    with scratch_run(spark), shuffles_freed(spark):  # pages, and what is made of them, go when the items are written
        loaded = _loaded_from_pages(spark, folder, scratch_path(spark, "pages_to_panel"))
        kept, _ = items.split_suspects(loaded, SPEC)
        kept = landing.write_layer(kept.select(*panel.item_columns(SPEC)), target)
    return panel.to_panel(kept, SPEC)


def _loaded_from_pages(spark: SparkSession, folder: str, root: str) -> DataFrame:
    joined = with_dimensions(lines_first(spark, folder), spark, folder).select(*ROLE_INPUTS)
    names = by_role(joined).columns
    # Written: the span and both landings read it. Columns by role are wider, and are worked out behind the
    # last shuffle.
    dated = staged(chunks.with_chunk(joined, "l_shipdate", 91).drop("chunk_end", "chunk_key"), "dated")
    span = dated.agg(F.min("chunk_start"), F.date_add(F.max("chunk_start"), 91)).first()
    middle = span[0] + (span[1] - span[0]) / 2
    spec = CollectSpec(end_date=span[1], window_days=(span[1] - span[0]).days, chunk_days=91, columns=tuple(names))

    def land(rows: DataFrame, place: str, **changes: Column) -> str:
        rows = rows.withColumn("block", F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(50)))
        nth = F.row_number().over(Window.partitionBy("chunk_start").orderBy("block"))
        of = F.count(F.lit(1)).over(Window.partitionBy("chunk_start"))
        # Pages are numbered without their records: those are shuffled once, to their page.
        numbers = staged(rows.select("chunk_start", "block").distinct().select(
            "chunk_start", "block", nth.alias("page"), (of - nth).cast("int").alias(pages.REMAINING)), "numbers")
        records = by_role(rows.repartition("chunk_start", "block"), "chunk_start", "block").withColumns(changes)
        text = [F.col(n).cast("string").alias(n) for n in names]
        paged = (records.select("chunk_start", "block", F.struct(*text).alias("record"))
                 .groupBy("chunk_start", "block").agg(F.collect_list("record").alias(pages.RECORDS)))
        same = paged["chunk_start"].eqNullSafe(numbers["chunk_start"]) & (paged["block"] == numbers["block"])
        page = paged.join(F.broadcast(numbers), same).select(paged["chunk_start"], F.to_json(F.struct(
            "page", pages.RECORDS, pages.REMAINING)).alias("value"))
        # As JSON a record is many times as long as in a table, for the most part names.
        page.write.partitionBy("chunk_start").option("compression", "gzip").text(f"{root}/{place}")
        return f"{root}/{place}"

    first = land(dated, "first")
    record = pages.text_record(names)
    collect(spark, spec, first, record, f"{root}/table", f"{root}/manifest", middle, one_per_file=False)
    delete(spark, first)
    second = land(dated.where(F.col("chunk_start") >= F.lit(middle)), "second", **{ROLES.status: F.lit("changed")})
    collect(spark, spec, second, record, f"{root}/table", f"{root}/manifest", span[1], one_per_file=False)
    loaded, _, _ = load_items(spark, f"{root}/table", SPEC, collected=True, columns=panel.item_columns(SPEC))
    return loaded


@query
def staged_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table a whole run leaves in its layers, read back."""
    layers = Layers(scratch_path(spark, "layers"))
    landing.append_landing(with_roles(lines_first(spark, folder), spark, folder), layers.raw, fmt="csv")
    run_stages(spark, layers, SPEC)
    stored = {"kept": layers.kept, "quarantine": layers.quarantine, "panel": layers.panel,
              "features": layers.features, "weekly": layers.report("weekly"),
              "composition": layers.report("composition")}
    return landing.union_slices([
        spark.read.parquet(path).agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("n_rows"))
        for name, path in stored.items()])


@query
def panel_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly panel's keys with their place in the canonical order."""
    rows = panel.in_panel_order(_panel(spark, folder, "M"), SPEC).select(*panel.panel_key(SPEC))
    path = scratch_path(spark, "ordered")
    rows.write.parquet(path)
    # Written files keep the order: by file, then by row.
    back = spark.read.parquet(path)
    place = F.row_number().over(Window.orderBy("_metadata.file_name", "_metadata.row_index"))
    return back.select(*panel.panel_key(SPEC), place.alias("place"))


@query
def union_of_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by language under each other; a column that a slice lacks is null."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    return landing.union_slices([docs.where(english), docs.where(~english).drop("source")])


@query
def prepared_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way: the feed as CSV files in feed order, scanned, typed,
    deduplicated by file order, split, and aggregated to the weekly panel."""
    target = scratch_path(spark, "kept")
    with scratch_run(spark), shuffles_freed(spark):  # the feed, and what is made of it, go when the items are written
        path = scratch_path(spark, "feed")
        with scratch_run(spark):
            joined = with_dimensions(table(spark, folder, "lineitem"), spark, folder)
            # Written: the shuffles of the joins are gone when the feed is ordered and written.
            joined = staged(joined.select(*FEED_ORDER[1:], *ROLE_INPUTS), "joined", "zstd")
            # Ordered before columns are derived from others: the shuffle is narrower.
            landing.append_landing(by_role(joined.orderBy(*FEED_ORDER)), path, fmt="csv")
        loaded, _, _ = load_items(spark, path, SPEC, columns=panel.item_columns(SPEC))
        kept, _ = items.split_suspects(loaded, SPEC)
        kept = landing.write_layer(kept.select(*panel.item_columns(SPEC)), target)
    return panel.to_panel(kept, SPEC)


@query
def weekly_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk totals of the events, computed as a stream that ran to its end."""
    schema = table(spark, folder, "events").schema
    stream = (feed.stream_parquet(spark, folder, schema, "events.parquet")
              .withColumn("ts", F.col("ts").cast("timestamp")))
    unique = feed.unique_within_watermark(stream, "event_id", "ts", "40 days")
    totals = feed.chunk_totals(unique, "ts", "event_type", "value", CHUNK_DAYS, SPEC.sum_scale)
    target = scratch_path(spark, "stream")
    feed.write_changes(totals, f"{target}/table", f"{target}/checkpoint").awaitTermination()
    return feed.current_totals(spark, f"{target}/table")


def _delivered(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as events; the table itself holds some of them more than once."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"), "l_orderkey", "l_linenumber",
        F.lit("2024-01-10").cast("timestamp").alias("ts"), F.col("l_returnflag").alias("kind"),
        F.lit(1.0).alias("value"))


def _in_turn(parts: list[DataFrame], path: str, run) -> None:
    """Lands the parts one after the other and runs the stream on each."""
    for n, part in enumerate(parts):
        part.write.parquet(f"{path}/{n}")
        run()


def _unique_totals(spark: SparkSession, path: str, target: str, schema, lateness: str, after=None) -> None:
    stream = feed.stream_parquet(spark, f"{path}/*", schema)
    unique = feed.unique_within_watermark(stream, "event_id", "ts", lateness)
    totals = feed.chunk_totals(unique, "ts", "kind", "value", CHUNK_DAYS, SPEC.sum_scale)
    feed.write_changes(totals, f"{target}/table", f"{target}/checkpoint", after).awaitTermination()


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines delivered twice: each is counted once."""
    lines = _delivered(spark, folder).withColumn("kind", F.lit("line"))
    path, target = scratch_path(spark, "line_stream"), scratch_path(spark, "stream")
    _in_turn([lines, lines], path, lambda: _unique_totals(spark, path, target, lines.schema, "40 days"))
    return feed.current_totals(spark, f"{target}/table")


def _late_parts(spark: SparkSession, folder: str) -> tuple[list[DataFrame], T.StructType]:
    """Lines of January, then of March, then again of January."""
    lines = _delivered(spark, folder).dropDuplicates(["event_id"]).withColumn("kind", F.lit("line"))
    later = lines.where("l_orderkey % 4 = 1").withColumn("ts", F.lit("2024-03-05").cast("timestamp"))
    # A row is late by the watermark that the batch before the last one had reached.
    return [lines.where("l_orderkey % 2 = 0"), later.where("l_linenumber <= 3"),
            later.where("l_linenumber > 3"), lines.where("l_orderkey % 4 = 3")], lines.schema


@query
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that come weeks behind the watermark do not change a window that is closed."""
    parts, schema = _late_parts(spark, folder)
    path, target = scratch_path(spark, "line_stream"), scratch_path(spark, "stream")
    _in_turn(parts, path, lambda: _unique_totals(spark, path, target, schema, "7 days"))
    return feed.current_totals(spark, f"{target}/table")


@query
def stream_late_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines where late ones are counted, and are also in a table of their own."""
    parts, schema = _late_parts(spark, folder)
    path, target = scratch_path(spark, "line_stream"), scratch_path(spark, "stream")

    def run() -> None:
        stream = feed.stream_parquet(spark, f"{path}/*", schema)
        feed.write_counted(stream, "ts", "kind", "value", f"{target}/table", f"{target}/checkpoint",
                           timedelta(days=7), CHUNK_DAYS, SPEC.sum_scale).awaitTermination()
        feed.compact_counted(spark, f"{target}/table")

    _in_turn(parts, path, run)
    side = feed.late_rows(spark, f"{target}/table").groupBy(F.col("kind").alias("tipo")).agg(
        F.count_distinct("event_id").alias("n_late_ids"))
    return feed.counted_totals(spark, f"{target}/table").join(side, "tipo")


@query
def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that dies in its second batch, after writing and before committing it, and whose
    table is compacted then and after each other batch, goes on where it was."""
    lines = _delivered(spark, folder).dropDuplicates(["event_id"]).withColumn("kind", F.lit("line"))
    path, target = scratch_path(spark, "line_stream"), scratch_path(spark, "stream")
    deaths = [False, True, False]

    def die(epoch: int) -> None:
        raise RuntimeError("stopped inside a batch")

    def run() -> None:
        if deaths.pop(0):
            try:
                _unique_totals(spark, path, target, lines.schema, "40 days", die)
            except StreamingQueryException:
                feed.compact(spark, f"{target}/table")
        _unique_totals(spark, path, target, lines.schema, "40 days")
        feed.compact(spark, f"{target}/table")

    _in_turn([lines.where(F.pmod("l_orderkey", F.lit(3)) == n) for n in range(3)], path, run)
    return feed.current_totals(spark, f"{target}/table")


@query
def stream_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a stream in which first copies come last, years behind the others: what
    is kept equals the batch dedup."""
    lines = table(spark, folder, "lineitem")
    path, target = scratch_path(spark, "line_stream"), scratch_path(spark, "stream")
    keys = ["l_orderkey", "l_linenumber"]

    def run() -> None:
        first = feed.first_copies(feed.stream_parquet(spark, f"{path}/*", lines.schema), keys, FEED_ORDER)
        feed.write_changes(first, f"{target}/table", f"{target}/checkpoint").awaitTermination()
        feed.compact(spark, f"{target}/table", keys)

    year = F.year("l_shipdate")
    _in_turn([lines.where(year >= 2000), lines.where((year >= 1997) & (year < 2000)),
              lines.where(F.coalesce(year < 1997, F.lit(True)))], path, run)
    return feed.current_rows(spark, f"{target}/table", keys)


# --- folds and model-facing features ---------------------------------------------

@query
def temporal_folds(spark: SparkSession, folder: str) -> DataFrame:
    """The panel's keys once per fold they are in, as train or test."""
    rows = staged(panel_weekly(spark, folder), "panel")
    return folds.temporal_folds(rows, FOLDS, panel.panel_key(SPEC))


MODEL_FOLDS = 3


def _by_fold(rows: DataFrame, n_splits: int, work) -> DataFrame:
    """``work(train, test)`` for every fold, under each other with its number."""
    parts = [work(train, test).withColumn("fold", F.lit(fold))
             for fold, (train, test) in enumerate(folds.fold_parts(rows, n_splits))]
    return landing.union_slices(parts)


@query
def impute_scale_train_only(spark: SparkSession, folder: str) -> DataFrame:
    """Every fold: missing values filled and scaled by what its train rows say."""
    spec = for_freq("M")
    names = ["valor_lag_1", "qtd_mediana", "taxa_desconto", "itens_media_4"]
    rows = staged(features.build_features(_panel(spark, folder, "M"), spec), "features")

    def scaled(train: DataFrame, test: DataFrame) -> DataFrame:
        model = transform.ImputeAndScale(inputCols=names, outputCol="numeric").fit(train)
        both = train.withColumn("role", F.lit("train")).unionByName(test.withColumn("role", F.lit("test")))
        values = vector_to_array("numeric")
        return model.transform(both).select(
            "role", *panel.panel_key(spec),
            *[F.round(values[i], 6).alias(n) for i, n in enumerate(model.getInputCols())])

    return _by_fold(rows, MODEL_FOLDS, scaled)


@query
def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The whole transformer, fitted on the train rows of every fold: width of the
    vector, sum of its scaled numbers, and how many categories are set."""
    spec = for_freq("M")
    rows = staged(features.build_features(_panel(spark, folder, "M"), spec), "features")

    def measured(train: DataFrame, test: DataFrame) -> DataFrame:
        model = transform.build_transformer(spec).fit(train)
        # Columns without any value are left out of the numbers.
        width = len(model.stages[0].getInputCols())
        vector = vector_to_array("features")
        total = lambda part: F.aggregate(part, F.lit(0.0), lambda a, b: a + b)
        return model.transform(test).select(
            *panel.panel_key(spec), F.size(vector).alias("width"),
            F.round(total(F.slice(vector, 1, width)), 4).alias("numeric_sum"),
            total(F.slice(vector, F.lit(width + 1), F.size(vector) - width)).cast("int").alias("n_set"))

    return _by_fold(rows, MODEL_FOLDS, measured)


@query
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Categories of every fold's train rows, applied to its test rows: a category
    that only comes later is all zeros."""
    rows = staged(panel_weekly(spark, folder), "panel")
    columns = features.categorical_features(SPEC)

    def slots(train: DataFrame, test: DataFrame) -> DataFrame:
        stages, encoded = transform.one_hot_stages(columns)
        model = Pipeline(stages=stages).fit(train.where("n_itens > 0"))
        wide = model.transform(test).select(
            *panel.panel_key(SPEC), *[vector_to_array(c).alias(c) for c in encoded])
        return wide.select(*panel.panel_key(SPEC),
                           *[F.array_position(c, F.lit(1.0)).cast("int").alias(f"{c}_slot") for c in encoded],
                           *[F.size(c).alias(f"{c}_size") for c in encoded])

    return _by_fold(rows, MODEL_FOLDS, slots)
