"""The registered queries: each operator, run over the whole feed.

Queries that write files use fresh folders in the cluster's shared folder. What the result
does not read is removed before the query returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .feed import flawed_feed, raw_envelopes, raw_feed
from .files import matches, remove_folder
from .functions import (
    business_time,
    cleaned_price,
    currency_of,
    day_key,
    lake_keys,
    short_title,
    to_double,
    to_long,
)
from .operators import (
    LOSSES,
    category_status,
    distinct_drops,
    files_behind,
    listings_of,
    lost_values,
    parsed,
    rejected,
    status_lines,
    typed_listings,
    warehouse_losses,
    warehouse_rows,
    with_violations,
)
from .plans import ingest, load_changed_days, load_day, organize
from .schema import FILE_PREFIX, LAKE_SCHEMA, LISTING_FIELDS, SNAPSHOT_DAY, WAREHOUSE_SCHEMA
from .session import passing_path, work_path
from .sinks import write_flat, write_organized, write_partitioned
from .sinks.warehouse import Warehouse
from .sources import (
    close_days,
    compact_manifest,
    read_day,
    read_envelopes,
    read_flat,
    read_lake,
    read_organized,
    register_lake,
)
from .sources.flat import scan_flat, with_lineage
from .streaming import load_new_files, organize_new_drops

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SECOND_DAY = date(2024, 1, 2)
DAYS = (date(2024, 1, 1), SECOND_DAY, date(2024, 1, 3))

# 03:00 UTC on new year's day still belongs to the old year's business day.
NEW_YEAR = datetime(2024, 1, 1, 3, 0)


def registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Results are compared as UTC wall-clock times.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def _typed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_listings(raw_feed(spark, sf_dir))


def _new_lake(spark: SparkSession, listings: DataFrame) -> str:
    root = work_path(spark, "lake")
    write_partitioned(listings, root)
    return root


def _new_flat_lake(spark: SparkSession, listings: DataFrame) -> str:
    root = work_path(spark, "flat")
    write_flat(listings, root)
    return root


@contextmanager
def _passing_lake(spark: SparkSession, listings: DataFrame) -> Iterator[str]:
    with passing_path(spark, "lake") as root:
        write_partitioned(listings, root)
        yield root


@contextmanager
def _passing_flat_lake(spark: SparkSession, listings: DataFrame) -> Iterator[str]:
    with passing_path(spark, "flat") as root:
        write_flat(listings, root)
        yield root


def _new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(f"listings_{uuid.uuid4().hex}", work_path(spark, "warehouse"))


def _on(listings: DataFrame, *days: date) -> DataFrame:
    return listings.where(F.col("fetch_timestamp").cast("date").isin(*days))


def _with_price(listings: DataFrame, price: str) -> DataFrame:
    return listings.withColumn("product_price", F.lit(price))


def _as_utc(rows: DataFrame) -> DataFrame:
    return rows.withColumn("fetch_timestamp", F.col("fetch_timestamp").cast("timestamp"))


# --- responses ---------------------------------------------------------------


@registered
def envelope_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse responses and explode their listings."""
    return listings_of(parsed(raw_envelopes(spark, sf_dir)))


@registered
def envelope_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each category, as columns and as JSON."""
    status = category_status(parsed(raw_envelopes(spark, sf_dir)))
    return status.withColumn("status", F.to_json(F.struct(*status.columns)))


@registered
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status lines of an ingest run that also asks for a category nobody answered."""
    asked = ["large", "small", "absent"]
    with passing_path(spark, "lake") as root:
        status = ingest(raw_envelopes(spark, sf_dir), root, as_of=NEW_YEAR, categories=asked)
    return status_lines(status)


@registered
def ingest_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses through the whole ingest job, read back from the lake."""
    root = work_path(spark, "lake")
    with passing_path(spark, "responses") as responses:
        raw_envelopes(spark, sf_dir).write.partitionBy("category").text(responses)
        ingest(read_envelopes(spark, responses, whole_files=False), root, as_of=NEW_YEAR)
    return _as_utc(read_day(spark, root, as_of=NEW_YEAR))


@registered
def ingest_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job into the flat layout."""
    root = work_path(spark, "flat")
    ingest(raw_envelopes(spark, sf_dir), root, as_of=NEW_YEAR, write=write_flat)
    return _as_utc(read_flat(spark, root).drop("file_uri", "file_path", "filename"))


# --- typed listings ----------------------------------------------------------


@registered
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_feed(spark, sf_dir).select(
        "asin",
        "snap",
        to_long(F.col("rank")).alias("rank"),
        to_long(F.col("product_num_ratings")).alias("product_num_ratings"),
        to_double(F.col("product_star_rating")).alias("product_star_rating"),
    )


@registered
def lake_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_utc(_typed_feed(spark, sf_dir))


@registered
def stamped_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh fetch: one business time for all rows."""
    listings = listings_of(parsed(raw_envelopes(spark, sf_dir)))
    return _as_utc(typed_listings(listings, business_time(NEW_YEAR)))


@registered
def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake and flat keys of fetch times spread around the clock, in business time."""
    feed = raw_feed(spark, sf_dir)
    hours = F.coalesce(to_long(F.col("product_num_ratings")), F.lit(0)) % 24
    local = F.col("fetch_timestamp") + F.make_dt_interval(hours=hours.cast("int") - 5)
    keys = lake_keys(F.col("local_time"))
    return (
        feed.withColumn("local_time", local)
        .withColumns(keys)
        .select(
            "asin",
            "snap",
            *keys,
            F.concat(
                *(
                    part
                    for name in ("category", *keys)
                    for part in (F.lit(f"{name}="), F.col(name), F.lit("/"))
                )
            ).alias("lake_key"),
            F.concat_ws("_", F.lit(FILE_PREFIX), "category", day_key(F.col("local_time"))).alias(
                "flat_key"
            ),
        )
    )


# --- lake --------------------------------------------------------------------


@registered
def lake_roundtrip_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_utc(read_lake(spark, _new_lake(spark, _typed_feed(spark, sf_dir))))


@registered
def lake_overwrite_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing the second day again, with other prices, replaces that day alone."""
    listings = _typed_feed(spark, sf_dir)
    root = _new_lake(spark, listings)
    write_partitioned(_with_price(_on(listings, SECOND_DAY), "$1"), root)
    return _as_utc(read_lake(spark, root))


@registered
def lake_roundtrip_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_flat(spark, _new_flat_lake(spark, _typed_feed(spark, sf_dir)))
    return _as_utc(rows.drop("file_uri", "file_path", "filename"))


@registered
def lake_scan_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _new_lake(spark, _typed_feed(spark, sf_dir))
    return _as_utc(read_day(spark, root, day=SECOND_DAY))


@registered
def lake_sql_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the lake as a catalog table."""
    root = _new_lake(spark, _typed_feed(spark, sf_dir))
    table = f"lake_{uuid.uuid4().hex}"
    register_lake(spark, table, root)
    return spark.sql(
        f"""
        SELECT category, year, month, day, asin, rank, product_price
        FROM {table}
        WHERE category IN ('economy', 'small') AND month = '01' AND day = '03'
        """
    )


@registered
def lake_sql_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over what two writes have put into the lake, registered by the writes themselves."""
    listings = _typed_feed(spark, sf_dir)
    root, table = work_path(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    register_lake(spark, table, root, find=False)
    write_partitioned(_on(listings, *DAYS[:2]), root, table=table)
    write_partitioned(_on(listings, *DAYS[1:]), root, table=table)
    return spark.sql(f"SELECT category, year, month, day, count(*) AS n_rows FROM {table} GROUP BY ALL")


@registered
def day_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _new_lake(spark, _typed_feed(spark, sf_dir))
    return read_day(spark, root, day=SECOND_DAY).agg(F.count("*").alias("total_rows"))


# --- warehouse ---------------------------------------------------------------


@registered
def derive_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_feed(spark, sf_dir).select(
        "asin", "snap", "product_price", currency_of(F.col("product_price")).alias("currency")
    )


@registered
def normalize_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaned_price(F.col("product_price"))
    return raw_feed(spark, sf_dir).select(
        "asin",
        "snap",
        cleaned.alias("cleaned_price"),
        cleaned.try_cast("decimal(10,2)").alias("product_price"),
    )


@registered
def derive_short_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_feed(spark, sf_dir).select(
        "asin", "snap", "product_title", short_title(F.col("product_title")).alias("short_title")
    )


@registered
def lost_values_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of values that the casts from text to the table's types have lost."""
    typed = typed_listings(raw_feed(spark, sf_dir), losses=True)
    bits = F.col(LOSSES).bitwiseOR(warehouse_losses()).alias(LOSSES)
    rows = warehouse_rows(typed, day_key(F.col("fetch_timestamp")).alias(SNAPSHOT_DAY), bits)
    return lost_values(rows, SNAPSHOT_DAY, "category")


@registered
def etl_warehouse_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake, one day's scan and the whole cleaning transform."""
    root = _new_lake(spark, _typed_feed(spark, sf_dir))
    return warehouse_rows(read_day(spark, root, day=SECOND_DAY))


@registered
def etl_warehouse_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning transform over every day."""
    return warehouse_rows(_typed_feed(spark, sf_dir))


@registered
def constraint_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warehouse_rows(typed_listings(flawed_feed(spark, sf_dir)))
    return rejected(with_violations(rows))


def _table(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return spark.table(warehouse.table).select(*WAREHOUSE_SCHEMA.names, SNAPSHOT_DAY)


@registered
def warehouse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading every day twice stores every row twice."""
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, _typed_feed(spark, sf_dir)) as root:
        for day in DAYS + DAYS:
            load_day(spark, root, warehouse, day=day)
    return _table(spark, warehouse)


@registered
def warehouse_replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing a day, also after its prices have changed, stores every row once."""
    listings = _typed_feed(spark, sf_dir)
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, listings) as root:
        for day in DAYS:
            load_day(spark, root, warehouse, day=day)
        write_partitioned(_with_price(_on(listings, SECOND_DAY), "£7.50"), root)
        load_day(spark, root, warehouse, day=SECOND_DAY, mode="replace_day")
    return _table(spark, warehouse)


@registered
def warehouse_replace_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing two categories of a day, after all prices have changed, leaves the others as they were."""
    listings = _typed_feed(spark, sf_dir)
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, listings) as root:
        for day in DAYS:
            load_day(spark, root, warehouse, day=day)
        write_partitioned(_with_price(_on(listings, SECOND_DAY), "£7.50"), root)
        load_day(
            spark, root, warehouse, day=SECOND_DAY, categories=["large", "small"], mode="replace_day"
        )
    return _table(spark, warehouse)


@registered
def warehouse_replace_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing a day by one with rejected rows only leaves that day empty."""
    listings = _typed_feed(spark, sf_dir)
    nameless = _on(listings, SECOND_DAY).withColumn("asin", F.lit(None).cast("string"))
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, listings) as root:
        for day in DAYS:
            load_day(spark, root, warehouse, day=day)
        write_partitioned(nameless, root)
        load_day(spark, root, warehouse, day=SECOND_DAY, mode="replace_day")
    return _table(spark, warehouse)


@registered
def warehouse_vanished_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing a day that has vanished from the lake leaves it empty."""
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, _typed_feed(spark, sf_dir)) as root:
        for day in DAYS:
            load_day(spark, root, warehouse, day=day)
    with _passing_lake(spark, _on(_typed_feed(spark, sf_dir), DAYS[0], DAYS[2])) as root:
        load_day(spark, root, warehouse, day=SECOND_DAY, mode="replace_day")
    return _table(spark, warehouse)


@registered
def warehouse_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of three loads: each continues where the one before it ended."""
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, _typed_feed(spark, sf_dir)) as root:
        for day in DAYS:
            load_day(spark, root, warehouse, day=day)
    return spark.table(warehouse.table).select(SNAPSHOT_DAY, "unique_id")


@registered
def warehouse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load leaves beside the table."""
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, typed_listings(flawed_feed(spark, sf_dir))) as root:
        for day in DAYS:
            load_day(spark, root, warehouse, day=day)
    stored = spark.read.parquet(warehouse.rejects)
    return stored.withColumns({n: F.col(n).cast("string") for n in (SNAPSHOT_DAY, "category")})


@registered
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load reports: the counts taken while its rows pass, and a day without any."""
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, typed_listings(flawed_feed(spark, sf_dir))) as root:
        results = [load_day(spark, root, warehouse, day=day) for day in (*DAYS, date(2024, 1, 4))]
    return spark.createDataFrame(
        [(f"{r.day:%Y%m%d}", r.rows_read, r.rows_loaded, r.rows_rejected) for r in results],
        "snapshot_day string, rows_read bigint, rows_loaded bigint, rows_rejected bigint",
    )


@registered
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: two days, nothing new, the third day."""
    listings = _typed_feed(spark, sf_dir)
    warehouse = _new_warehouse(spark)
    with (
        _passing_lake(spark, _on(listings, *DAYS[:2])) as root,
        passing_path(spark, "checkpoint") as checkpoint,
    ):
        load_new_files(spark, root, warehouse, checkpoint).awaitTermination()
        load_new_files(spark, root, warehouse, checkpoint).awaitTermination()
        write_partitioned(_on(listings, DAYS[2]), root)
        load_new_files(spark, root, warehouse, checkpoint).awaitTermination()
    return _table(spark, warehouse)


@registered
def incremental_rewritten_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs. Before the second one a day was written again, with other prices: each row is there once."""
    listings = _typed_feed(spark, sf_dir)
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, listings) as root, passing_path(spark, "checkpoint") as checkpoint:
        load_new_files(spark, root, warehouse, checkpoint).awaitTermination()
        write_partitioned(_with_price(_on(listings, SECOND_DAY), "£7.50"), root)
        load_new_files(spark, root, warehouse, checkpoint).awaitTermination()
    return _table(spark, warehouse)


@registered
def changed_days_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the load by ledger. Before the second one a day came, and another was written again."""
    listings = _typed_feed(spark, sf_dir)
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, _on(listings, *DAYS[:2])) as root, passing_path(spark, "ledger") as ledger:
        load_changed_days(spark, root, warehouse, ledger)
        write_partitioned(_with_price(_on(listings, SECOND_DAY), "£7.50"), root)
        write_partitioned(_on(listings, DAYS[2]), root)
        load_changed_days(spark, root, warehouse, ledger)
    return _table(spark, warehouse)


@registered
def changed_days_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What four runs report: two days, nothing new, a day written again and a new one, a day that vanished."""
    listings = typed_listings(flawed_feed(spark, sf_dir))
    warehouse = _new_warehouse(spark)
    with _passing_lake(spark, _on(listings, *DAYS[:2])) as root, passing_path(spark, "ledger") as ledger:

        def run():
            return load_changed_days(spark, root, warehouse, ledger, remove_vanished=True)

        runs = [run(), run()]
        write_partitioned(_on(listings, *DAYS[1:]), root)
        runs.append(run())
        for folder in matches(spark, f"{root}/category=*/year=2024/month=01/day=01"):
            remove_folder(spark, folder)
        runs.append(run())
    left = spark.table(warehouse.table).count()
    return spark.createDataFrame(
        [(n, r.category_days, r.rows_read, r.rows_loaded, r.rows_rejected, left) for n, r in enumerate(runs, 1)],
        "run bigint, category_days bigint, rows_read bigint, rows_loaded bigint, rows_rejected bigint, rows_left bigint",
    )


# --- organizer ---------------------------------------------------------------


@registered
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with the drop it came from."""
    rows = read_flat(spark, _new_flat_lake(spark, _typed_feed(spark, sf_dir)))
    return rows.select(
        "asin", "file_key", "category", F.concat_ws("/", "category", "file_key").alias("destination")
    )


@registered
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineage of files under all kinds of names, as Spark reports them: encoded."""
    feed = raw_feed(spark, sf_dir)
    day = day_key(F.col("fetch_timestamp"))
    name = F.concat_ws("_", F.lit(FILE_PREFIX), F.concat("category", F.lit(" +é")), day)
    encoded = F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))
    # A column of its own: inside the array it would be made for each form.
    feed = feed.select("asin", "snap", encoded.alias("encoded"))
    forms = F.array(
        F.concat(F.lit("file:/drops/"), "encoded", F.lit(".parquet")),
        F.concat(F.lit("file:/drops/"), "encoded", F.lit(".parquet/part-0.parquet")),
        F.concat(F.lit("file:/drops/snapshot_key="), "encoded", F.lit("/part-0.parquet")),
        F.lit(f"file:/drops/{FILE_PREFIX}.parquet"),
    )
    files = feed.select("asin", "snap", F.posexplode(forms).alias("form", "file_uri"))
    return with_lineage(files).select(
        "asin", "snap", "form", "file_path", "filename", "file_key", F.col("category").alias("found")
    )


@registered
def distinct_file_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _new_flat_lake(spark, _typed_feed(spark, sf_dir))
    return distinct_drops(files_behind(scan_flat(spark, root)))


def _organized_rows(spark: SparkSession, root: str) -> DataFrame:
    return read_organized(spark, root).select(*LISTING_FIELDS, "category", "file_key")


@registered
def organize_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day's drops are there already, with other prices, and stay as they are."""
    listings = _typed_feed(spark, sf_dir)
    target = work_path(spark, "organized")
    with _passing_flat_lake(spark, _with_price(_on(listings, DAYS[0]), "$1")) as earlier:
        write_organized(read_flat(spark, earlier), target)
    with _passing_flat_lake(spark, listings) as flat:
        organize(spark, flat, target)
    return _organized_rows(spark, target)


@registered
def organize_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops whose name has no category are kept apart, by drop."""
    listings = _typed_feed(spark, sf_dir)
    nameless = listings.withColumn(
        "category", F.when(F.col("category") != "promo", F.col("category")).otherwise("")
    )
    target, rejects = work_path(spark, "organized"), work_path(spark, "rejects")
    with _passing_flat_lake(spark, nameless) as flat:
        organize(spark, flat, target, rejects_root=rejects)
    kept = spark.read.parquet(rejects).select(
        "asin", "product_url", "file_key", F.lit("rejects").alias("place")
    )
    return kept.unionByName(
        read_organized(spark, target).select(
            "asin", "product_url", "file_key", F.lit("organized").alias("place")
        )
    )


@registered
def organize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs report: two days, nothing new, the third day."""
    listings = _typed_feed(spark, sf_dir)
    with (
        _passing_flat_lake(spark, _on(listings, *DAYS[:2])) as flat,
        passing_path(spark, "organized") as target,
    ):
        runs = [organize(spark, flat, target), organize(spark, flat, target)]
        write_flat(_on(listings, DAYS[2]), flat)
        runs.append(organize(spark, flat, target))
    return spark.createDataFrame(
        [(n, r.organized, r.skipped, r.unmatched) for n, r in enumerate(runs, 1)],
        "run bigint, organized bigint, skipped bigint, unmatched bigint",
    )


@registered
def organize_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What four runs report. After the first one its first day is closed and the manifest compacted; before the
    third one the third day has come, and the last one is asked for all days.
    """
    listings = _typed_feed(spark, sf_dir)
    with (
        _passing_flat_lake(spark, _on(listings, *DAYS[:2])) as flat,
        passing_path(spark, "organized") as target,
    ):
        runs = [organize(spark, flat, target)]
        close_days(spark, target, before=SECOND_DAY)
        compact_manifest(spark, target)
        runs.append(organize(spark, flat, target))
        write_flat(_on(listings, DAYS[2]), flat)
        runs += [organize(spark, flat, target), organize(spark, flat, target, all_days=True)]
    return spark.createDataFrame(
        [(n, r.organized, r.skipped, r.unmatched) for n, r in enumerate(runs, 1)],
        "run bigint, organized bigint, skipped bigint, unmatched bigint",
    )


@registered
def organize_empty_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs report when a drop has no rows: it is organized once."""
    listings = _typed_feed(spark, sf_dir)
    empty = f"{FILE_PREFIX}_empty_20240101.parquet"
    with (
        _passing_flat_lake(spark, _on(listings, DAYS[0])) as flat,
        passing_path(spark, "organized") as target,
    ):
        listings.select(*LAKE_SCHEMA.names).limit(0).coalesce(1).write.parquet(f"{flat}/{empty}")
        runs = [organize(spark, flat, target), organize(spark, flat, target)]
    return spark.createDataFrame(
        [(n, r.organized, r.skipped, r.unmatched) for n, r in enumerate(runs, 1)],
        "run bigint, organized bigint, skipped bigint, unmatched bigint",
    )


@registered
def organize_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs. The second finds the third day and a changed copy of the first one."""
    listings = _typed_feed(spark, sf_dir)
    target, rejects = work_path(spark, "organized"), work_path(spark, "rejects")
    with (
        _passing_flat_lake(spark, _on(listings, *DAYS[:2])) as flat,
        passing_path(spark, "checkpoint") as checkpoint,
        passing_path(spark, "archive") as archive,
    ):

        def run() -> None:
            organize_new_drops(
                spark,
                flat,
                target,
                checkpoint,
                rejects_root=rejects,
                clean_source="archive",
                archive_root=archive,
            ).awaitTermination()

        run()
        write_flat(_with_price(_on(listings, DAYS[0]), "$1"), flat)
        write_flat(_on(listings, DAYS[2]), flat)
        run()
    stored = _organized_rows(spark, target).withColumn("place", F.lit("organized"))
    kept = spark.read.parquet(rejects)
    return stored.unionByName(
        kept.select(*LISTING_FIELDS, "category", "file_key", F.col("reason").alias("place"))
    )
