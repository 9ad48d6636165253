"""Jobs that read a lake, and publish its tables' new content. Each may be repeated."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions.dates import Moment, resolved
from venuelake.plans import graph, warehouse
from venuelake.session import drop_scratch, own_scratch, written
from venuelake.sources import arrivals, buckets
from venuelake.sources.lake import publish

UPDATED = ["restaurants", "cuisines", "meals", "rating"]
#: Bucket keys of the lake's tables: the restaurant everywhere, so a restaurant touches one bucket of each.
KEYS = {"restaurants": "key", **schemas.RESTAURANT_CHILDREN}


def _tidy(job: Callable[..., None]) -> Callable[..., None]:
    """The scratch tables of a job go when it ends: what it leaves are the lake's tables."""

    @wraps(job)
    def run(spark: SparkSession, *args: object, **options: object) -> None:
        with own_scratch(spark) as folder:
            try:
                job(spark, *args, **options)
            finally:
                drop_scratch(spark, folder)

    return run


def table(lake: str, name: str) -> buckets.Table:
    return buckets.Table(lake, name, (KEYS[name],))


def read_table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return buckets.read(spark, table(lake, name))


@_tidy
def load_warehouse(spark: SparkSession, lake: str, venues_a: DataFrame, venues_b: DataFrame, as_of: Moment = None) -> None:
    """The first load of restaurants, their values and ratings."""
    matched = warehouse.match_venues(venues_a, venues_b, columns=warehouse.MATCHED)
    loaded = {
        "restaurants": warehouse.build_restaurants(matched), "cuisines": warehouse.build_cuisines(matched),
        "meals": warehouse.build_meals(matched), "rating": warehouse.build_ratings(matched, resolved(as_of)),
    }
    for name, rows in loaded.items():
        buckets.lay_out(rows, table(lake, name))


@_tidy
def update_warehouse(spark: SparkSession, lake: str, venues_a: DataFrame, venues_b: DataFrame, as_of: Moment = None) -> None:
    """A later load of both sources: only buckets whose rows differ are written.

    The tables follow each other, so a job that stops between them is to be run again; a
    repeat writes what is missing.
    """
    tables = {name: read_table(spark, lake, name) for name in UPDATED}
    updated = warehouse.update_warehouse(tables, venues_a, venues_b, as_of)
    for name in UPDATED:
        # Content of all tables follows from the old ones, so none is replaced before all are known.
        updated[name] = buckets.typed(table(lake, name), updated[name])
    for name in UPDATED:
        buckets.replace_changed(table(lake, name), updated[name], fixed=True)


@_tidy
def add_details(spark: SparkSession, lake: str, reviews: DataFrame, periods: DataFrame) -> None:
    """Parsed reviews are appended, those known already are not; hours of the venues in ``periods`` are replaced."""
    restaurants = read_table(spark, lake, "restaurants")
    fresh = warehouse.build_reviews(reviews, restaurants)
    hours = warehouse.build_opening_hours(periods, restaurants).drop("open_day").distinct()
    _append(spark, fresh, lake, "long_review", "review_key")
    known = table(lake, "opening_hours")
    if buckets.exists(spark, known):
        buckets.replace_groups(known, hours)
    else:
        buckets.lay_out(hours, known)


def load_details(spark: SparkSession, lake: str, details: DataFrame) -> None:
    """Record-list texts of venues: parsed, added, and what cannot be read written apart."""
    reviews, periods, rejects = warehouse.parse_details(details)
    add_details(spark, lake, reviews, periods)
    publish(rejects, lake, "details_rejects")


def land_details(
    spark: SparkSession, lake: str, landing: str, key_pattern: str = arrivals.KEY_PATTERN, files_per_batch: int | None = None
) -> int:
    """Add the detail files that came to ``landing`` since the last call; returns the batches.

    Files read before are not opened. Reviews are appended by key and hours replaced by venue, so a
    batch that comes again after a failure changes nothing. Rejects are kept per batch.
    """

    def add(details: DataFrame, batch: int) -> None:
        known = written(details.where(F.col("reviews").isNotNull() | F.col("opening_periods").isNotNull()), "details")
        reviews, periods, rejects = warehouse.parse_details(known)
        add_details(spark, lake, reviews, periods)
        rejects.write.mode("overwrite").parquet(f"{lake}/details_rejects/batch={batch}")

    return arrivals.read_arrivals(
        spark, landing, f"{lake}/_arrivals/details", "reviews string, opening_periods string", add,
        schemas.DETAILS_NESTED, "google_key", key_pattern, files_per_batch,
    )


@_tidy
def add_images(spark: SparkSession, lake: str, catalog: DataFrame) -> None:
    """Images of a catalogue by restaurant; those known already are not added again."""
    images = warehouse.build_external_images(catalog, read_table(spark, lake, "restaurants"))
    _append(spark, images, lake, "images_external", "image_id")


def _append(spark: SparkSession, rows: DataFrame, lake: str, name: str, key: str) -> None:
    known = table(lake, name)
    if buckets.exists(spark, known):
        buckets.append_new(known, rows, key)
    else:
        buckets.lay_out(rows.dropDuplicates([key]), known)


@_tidy
def delete_closed(spark: SparkSession, lake: str) -> None:
    """Closed restaurants and what hangs on them go from all tables the lake has, bucket by bucket."""
    children = [table(lake, name) for name in schemas.RESTAURANT_CHILDREN]
    there = [child for child in children if buckets.exists(spark, child)]
    buckets.cascade_delete(spark, table(lake, "restaurants"), F.col("closed") == 1, there)


def write_graph(spark: SparkSession, lake: str, tables: dict[str, DataFrame]) -> None:
    """Nodes, their properties by label, and edges with all properties."""
    nodes, edges = graph.build_graph(tables)
    publish(nodes, lake, "graph_nodes")
    publish(graph.edge_view(edges), lake, "graph_edges")
    for label, parts in graph.node_tables(tables).items():
        for number, rows in enumerate(parts):
            publish(rows, lake, f"graph_{label}" + f"_{number}" * (len(parts) > 1))
