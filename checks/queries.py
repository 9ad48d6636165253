"""One registered query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as s
from venuelake import schemas
from venuelake.functions import dates, text
from venuelake.operators import globe, mutate, spatial
from venuelake.operators.neighbors import nearest
from venuelake.operators.normalize import explode_values, keyed_values, normalize
from venuelake.operators.propagate import embed
from venuelake.plans import app_data, graph, increments, jobs, marts, recommend, serving, warehouse
from venuelake.session import durable, scratch_path
from venuelake.sources import arrivals, buckets, pixel_files
from venuelake.sources import images as image_files
from venuelake.sources import tables as sources
from venuelake.sources.lake import publish, read_current

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def day_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


# Marts


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return marts.daily_stats(s.swipes(spark, folder), s.images(spark, folder))


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_stats(_daily(spark, folder), s.restaurants(spark, folder))


def _monthly_images(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_images(s.history(spark, folder), s.images(spark, folder), s.dishes(spark, folder))


def _visitors(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_visitors(s.history(spark, folder), s.images(spark, folder), s.users(spark, folder))


@query
def daily_stats(spark: SparkSession, folder: str) -> DataFrame:
    return day_text(_daily(spark, folder), "date")


@query
def monthly_stats_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_monthly(spark, folder), *serving.AVERAGES)


@query
def monthly_history_ranked(spark: SparkSession, folder: str) -> DataFrame:
    daily = marts.daily_stats(s.history(spark, folder), s.images(spark, folder))
    return rounded(marts.monthly_stats(daily, s.restaurants(spark, folder)), *serving.AVERAGES)


@query
def top_bottom_items(spark: SparkSession, folder: str) -> DataFrame:
    return _monthly_images(spark, folder)


@query
def visitor_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _visitors(spark, folder)


def _written_marts(spark: SparkSession, folder: str) -> str:
    """A warehouse written to a scratch folder, and all marts built from it there."""
    path = scratch_path(spark, "marts")
    warehouse_tables = {
        "swipes": s.history, "images": s.images, "users": s.users, "restaurants": s.restaurants, "dishes": s.dishes
    }
    for name, build in warehouse_tables.items():
        sources.write_table(build(spark, folder), f"{path}/warehouse", name)
    marts.build_marts(spark, f"{path}/warehouse", f"{path}/marts")
    return f"{path}/marts"


@query
def marts_written(spark: SparkSession, folder: str) -> DataFrame:
    monthly = sources.read_table(spark, _written_marts(spark, folder), "monthly_resto")
    return rounded(monthly, *serving.AVERAGES)


def _incremented(spark: SparkSession, folder: str) -> str:
    """Marts of all days but the latest ones and of a day without its right-hand swipes, then of all days."""
    path = scratch_path(spark, "states")
    swipes, images, restaurants = s.history(spark, folder), s.images(spark, folder), s.restaurants(spark, folder)
    last = swipes.agg(F.max("timestamp").alias("t")).scalar()
    day, late = F.to_date("timestamp"), F.to_date(last - F.expr("INTERVAL 400 DAY"))
    new = day > F.to_date(last - F.expr("INTERVAL 45 DAY"))
    increments.add_days(spark, path, swipes.where(~new & ((day != late) | (F.col("swipeLeft") == 1))), images, restaurants)
    for _ in range(2):
        increments.add_days(spark, path, swipes.where(new | (day == late)), images, restaurants)
    return path


@query
def marts_incremented_days(spark: SparkSession, folder: str) -> DataFrame:
    states = increments.month_states(spark, _incremented(spark, folder))
    return day_text(increments.daily_from_states(states), "date")


@query
def marts_incremented_months(spark: SparkSession, folder: str) -> DataFrame:
    monthly = sources.read_table(spark, _incremented(spark, folder), increments.MONTHLY)
    return rounded(monthly.drop("state_month"), *serving.AVERAGES)


@query
def marts_incremented_visitors(spark: SparkSession, folder: str) -> DataFrame:
    return sources.read_table(spark, _incremented(spark, folder), increments.VISITORS).drop("state_month")


@query
def marts_written_view(spark: SparkSession, folder: str) -> DataFrame:
    """Peer averages of one restaurant from the written marts."""
    path = _written_marts(spark, folder)
    daily, monthly, shown, visitors = (
        sources.read_table(spark, path, name)
        for name in ("daily_resto", "monthly_resto", "monthly_resto_images", "monthly_resto_users")
    )
    view = serving.restaurant_view(3, monthly, daily, shown, visitors, s.cuisines(spark, folder))
    return rounded(view.per_cuisine, *serving.AVERAGES, "days_active")


# Serving


def _peers(spark: SparkSession, folder: str) -> DataFrame:
    return serving.peers(_monthly(spark, folder), s.cuisines(spark, folder))


@query
def peer_rank(spark: SparkSession, folder: str) -> DataFrame:
    ranks = serving.peer_ranks(_peers(spark, folder))
    return ranks.select("restaurantId", "month", "cuisine", "rank", "crank")


@query
def peer_averages(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(serving.peer_averages(_peers(spark, folder)), *serving.AVERAGES, "days_active")


@query
def peer_cards(spark: SparkSession, folder: str) -> DataFrame:
    rows = durable(_peers(spark, folder))
    return serving.peer_cards(serving.peer_ranks(rows), serving.peer_averages(rows))


def _view(spark: SparkSession, folder: str) -> serving.RestaurantView:
    daily = durable(_daily(spark, folder))
    monthly = durable(marts.monthly_stats(daily, s.restaurants(spark, folder)))
    swiped = (s.swipes(spark, folder), s.images(spark, folder))
    return serving.restaurant_view(
        3, monthly, daily,
        marts.monthly_images(*swiped, s.dishes(spark, folder)),
        marts.monthly_visitors(*swiped, s.users(spark, folder)),
        s.cuisines(spark, folder),
    )


@query
def restaurant_cuisine_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder).cuisine_ranking


@query
def restaurant_months(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder).months


@query
def restaurant_month_slice(spark: SparkSession, folder: str) -> DataFrame:
    return day_text(_view(spark, folder).of_month("2024-01")["daily"], "date")


@query
def available_months(spark: SparkSession, folder: str) -> DataFrame:
    return serving.available_months(_monthly(spark, folder))


@query
def date_range_slice(spark: SparkSession, folder: str) -> DataFrame:
    return day_text(serving.between_days(_daily(spark, folder), "2024-01-05", "2024-01-12"), "date")


@query
def series_mean_position(spark: SparkSession, folder: str) -> DataFrame:
    means = serving.reference_mean(_daily(spark, folder), "impressions")
    return day_text(rounded(means, "mean", "position"), "first_date", "last_date")


@query
def compact_number(spark: SparkSession, folder: str) -> DataFrame:
    return s.given(spark, folder, "orders").select(
        "o_orderkey", text.compact_number(F.col("o_totalprice")).alias("shown")
    )


@query
def bottom_not_top(spark: SparkSession, folder: str) -> DataFrame:
    return serving.bottom_not_top(_monthly_images(spark, folder))


@query
def visitors_by_city(spark: SparkSession, folder: str) -> DataFrame:
    return serving.visitors_by_city(_visitors(spark, folder))


@query
def visitors_by_age(spark: SparkSession, folder: str) -> DataFrame:
    return serving.visitors_by_age(_visitors(spark, folder))


# Cleaning and normalising


@query
def explode_rank_keys(spark: SparkSession, folder: str) -> DataFrame:
    parts = s.given(spark, folder, "part")
    rows = explode_values(parts, text.split_values(F.col("p_name"), " "), ["p_partkey"], "word")
    return keyed_values(rows, "word", "word_key")


def _normalized(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    documents = s.given(spark, folder, "documents")
    words = documents.select(F.col("doc_id").alias("id"), "lang", F.split("text", r"\s+").alias("tags"))
    return normalize(words, "tags", "tag", "image")


@query
def normalize_parent(spark: SparkSession, folder: str) -> DataFrame:
    return _normalized(spark, folder)[0]


@query
def normalize_values(spark: SparkSession, folder: str) -> DataFrame:
    return _normalized(spark, folder)[1]


@query
def normalize_bridge(spark: SparkSession, folder: str) -> DataFrame:
    return _normalized(spark, folder)[2]


@query
def image_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    plain = s.images(spark, folder).select("id", "file", "dishId")
    return app_data.image_restaurants(plain, s.dishes(spark, folder))


@query
def rating_union(spark: SparkSession, folder: str) -> DataFrame:
    customers = s.given(spark, folder, "customer")
    nan = F.lit(float("nan"))
    rated = customers.select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_acctbal") < 0, nan).otherwise(F.col("c_acctbal")).alias("rating"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("double")).alias("ta_rating"),
    )
    return warehouse.build_ratings(rated, F.lit("2024-03-05").cast("date"))


@query
def award_parse(spark: SparkSession, folder: str) -> DataFrame:
    orders = s.given(spark, folder, "orders")
    award = F.when(F.col("o_orderstatus") == "P", "Bib Gourmand").otherwise(F.col("o_orderpriority"))
    award = F.when(F.col("o_orderstatus") == "O", F.regexp_extract("o_orderpriority", "[A-Z ]+", 0)).otherwise(award)
    return orders.select("o_orderkey", text.award_stars(award).alias("stars"))


@query
def price_level(spark: SparkSession, folder: str) -> DataFrame:
    venues = s.venues_b(spark, folder)
    return venues.select("ta_url", text.price_level(F.col("ta_price")).alias("level"))


@query
def key_from_url(spark: SparkSession, folder: str) -> DataFrame:
    pages = s.given(spark, folder, "pages")
    url = F.when(
        F.col("page_id") % 3 != 0, F.concat("url", F.lit("/R-g187497-d"), F.col("page_id"), F.lit("-n"))
    ).otherwise(F.col("url"))
    return pages.select("page_id", text.key_from_url(url).alias("key"))


def _quoted(value: F.Column) -> F.Column:
    """A value as a literal in single quotes."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), escaped, F.lit("'"))


@query
def parse_record_text(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a list of records, one per line of its text, parsed back."""
    documents = s.given(spark, folder, "documents")
    record = lambda line, at: F.concat(
        F.lit("{'author': None, 'rating': "), (at % 5 + 1).cast("string"), F.lit(", 'text': "), _quoted(line),
        F.lit(", 'time': "), (at + 1_600_000_000).cast("string"), F.lit(", 'translated': False}"),
    )
    written = F.concat(
        F.lit("["), F.array_join(F.transform(F.split("text", "\n"), record), "\n "), F.lit("]")
    )
    details = documents.select(
        F.concat(F.lit("g_"), F.col("doc_id")).alias("google_key"), written.alias("reviews"),
        F.lit(None).cast("string").alias("opening_periods"),
    )
    return warehouse.parse_details(details)[0]


@query
def parse_nested_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Each part's opening periods as text, the second one without a closing time, parsed back."""
    number = F.col("p_partkey")
    hour = lambda start: F.format_string("%02d30", (number % 12 + start).cast("int"))
    day = (F.col("p_size") % 7).cast("string")
    written = F.concat(
        F.lit("[{'close': {'day': "), day, F.lit(", 'time': '"), hour(12), F.lit("'}, 'open': {'day': "), day,
        F.lit(", 'time': '"), hour(8), F.lit("'}}\n {'open': {'day': 0, 'time': '0000'}}]"),
    )
    details = s.given(spark, folder, "part").select(
        F.concat(F.lit("g_"), number).alias("google_key"), F.lit(None).cast("string").alias("reviews"),
        F.when(F.col("p_size") % 10 == 0, F.lit("[{'close': ")).otherwise(written).alias("opening_periods"),
    )
    return warehouse.parse_details(details)[1]


@query
def parse_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Documents taken as record lists: none is one, so all are rejects."""
    details = s.given(spark, folder, "documents").select(
        F.concat(F.lit("g_"), F.col("doc_id")).alias("google_key"), F.col("text").alias("reviews"),
        F.lit(None).cast("string").alias("opening_periods"),
    )
    return warehouse.parse_details(details)[2]


def _app_users(spark: SparkSession, folder: str) -> DataFrame:
    customers = s.given(spark, folder, "customer")
    key = F.col("c_custkey")
    address = F.concat(F.lit("Street "), key, F.lit("\nCity "), F.col("c_nationkey"), F.lit(", 08"), key % 100)
    return customers.select(
        key.alias("id"),
        F.concat(F.lit("user"), key).alias("username"),
        F.col("c_name").alias("name"),
        F.when(key % 11 == 0, F.lit("Street")).otherwise(address).alias("address"),
        F.concat(key, F.lit("@mail.example")).alias("mail"),
        F.when(key % 13 == 0, F.lit("unknown"))
        .otherwise(F.concat(1940 + key % 60, F.lit("-"), key % 12 + 1, F.lit("-"), key % 28 + 1)).alias("birthdate"),
        F.concat(F.lit("+34 "), key).alias("phone"),
        (41.3 + key % 100 * 0.001).alias("homeLat"),
        (2.1 + key % 90 * 0.001).alias("homeLng"),
        F.col("c_mktsegment").alias("sex"),
        F.lit("2024-01-01").alias("createDate"),
        F.lit(None).cast("array<string>").alias("interestedCuisines"),
        F.col("c_nationkey").cast("string").alias("nationality"),
        F.col("c_mktsegment").alias("occupation"),
    )


@query
def pii_split_users(spark: SparkSession, folder: str) -> DataFrame:
    _, rest = app_data.split_users(_app_users(spark, folder), F.lit("2024-03-05").cast("date"))
    return rest.select("id", "sex", "nationality", "occupation", "city", "zipcode", "age")


@query
def pii_split_personal(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(app_data.split_users(_app_users(spark, folder))[0], "homeLat", "homeLng")


@query
def column_label(spark: SparkSession, folder: str) -> DataFrame:
    return s.given(spark, folder, "orders").select(
        "o_orderkey", text.column_name(F.col("o_orderpriority")).alias("label")
    )


# Landing files and image paths


@query
def multi_file_unify(spark: SparkSession, folder: str) -> DataFrame:
    """Venues written as differing files, read back as one table with one row per place."""
    venues = s.venues_a(spark, folder).withColumnsRenamed(
        {new: raw for raw, new in schemas.VENUE_A_NESTED.items()}
    )
    path = scratch_path(spark, "landing")
    venues.where("user_ratings_total < 15").write.parquet(f"{path}/places1")
    venues.where("user_ratings_total >= 10").drop("price_level").select(
        *[f"`{c}`" for c in sorted(venues.columns, reverse=True) if c != "price_level"]
    ).write.parquet(f"{path}/places2")
    return rounded(sources.read_venue_a(spark, path), "latitude", "longitude")


@query
def details_unify(spark: SparkSession, folder: str) -> DataFrame:
    """Details files of differing columns; the key comes from the path."""
    parts = s.given(spark, folder, "part")
    path = scratch_path(spark, "details")
    both = parts.select(F.col("p_name").alias("reviews"), F.col("p_brand").alias("opening_hours.periods"))
    both.write.parquet(f"{path}/g_both")
    both.select("reviews").write.parquet(f"{path}/g_reviews")
    both.select("`opening_hours.periods`").write.parquet(f"{path}/g_hours")
    parts.select("p_type").write.parquet(f"{path}/g_neither")
    return sources.read_venue_details(spark, path)


@query
def landed_details(spark: SparkSession, folder: str) -> DataFrame:
    """Detail files that land in two steps: each is read once, with the number of the batch that read it."""
    parts = s.given(spark, folder, "part")
    path = scratch_path(spark, "arrivals")
    columns = [F.col("p_name").alias("reviews"), F.col("p_brand").alias("opening_hours.periods"), F.col("p_type").alias("kind")]
    landing, landed = f"{path}/landing", f"{path}/landed"
    for step in (parts.where("p_size <= 25"), parts.where("p_size > 25"), parts.limit(0)):
        files = step.select(F.concat(F.lit("g_"), F.col("p_size")).alias("place"), *columns)
        for number, kept in enumerate((["reviews", "`opening_hours.periods`"], ["reviews"])):
            own = files.where((F.length("reviews") % 2) == number).select("place", *kept)
            own.write.mode("append").partitionBy("place").parquet(f"{landing}/{number}")
        arrivals.read_arrivals(
            spark, landing, f"{path}/record", "reviews string, opening_periods string",
            lambda rows, batch: rows.withColumn("batch", F.lit(batch)).write.mode("append").parquet(landed),
            schemas.DETAILS_NESTED, "google_key", key_pattern="place=(g_[0-9]+)",
        )
    return spark.read.parquet(landed)


@query
def table_names(spark: SparkSession, folder: str) -> DataFrame:
    """Tables written to a folder, then listed; only those the target lacks are copied."""
    path = scratch_path(spark, "tables")
    for name in ("nation", "region", "customer"):
        sources.write_table(s.given(spark, folder, name), f"{path}/landing", name)
    sources.write_table(s.given(spark, folder, "nation"), f"{path}/warehouse", "nation")
    copied = sources.copy_missing(spark, f"{path}/landing", f"{path}/warehouse")
    found = sources.list_tables(spark, f"{path}/warehouse")
    rows = sources.read_table(spark, f"{path}/warehouse", "customer").select(F.count(F.lit(1)).alias("customers"))
    return found.select("name", F.col("name").isin(copied).alias("copied"), rows.scalar().alias("customers"))


@query
def append_rows(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "append")
    orders = s.given(spark, folder, "orders")
    sources.write_table(orders.where("o_orderstatus = 'F'"), path, "orders")
    sources.write_table(orders.where("o_orderstatus <> 'F'"), path, "orders", mode="append")
    return sources.read_table(spark, path, "orders")


def _image_paths(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    name = F.when(key % 9 == 0, F.concat(F.lit("g_"), key, F.lit(".jpg"))).otherwise(
        F.concat(F.lit("g_go"), key % 40, F.lit("_"), F.col("p_size"), F.lit(".jpg"))
    )
    return s.given(spark, folder, "part").select(F.concat(F.lit("/images/"), name).alias("path"))


@query
def image_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return image_files.image_catalog(_image_paths(spark, folder))


@query
def external_images(spark: SparkSession, folder: str) -> DataFrame:
    built = warehouse.build_external_images(
        image_files.image_catalog(_image_paths(spark, folder)), s.restaurants(spark, folder)
    )
    return built


# Mutation


def _order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Item totals per order, for a shifted range of keys: some known, some new."""
    items = s.given(spark, folder, "lineitem")
    return items.groupBy((F.col("l_orderkey") * 2).alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("o_custkey"),
        F.max("l_returnflag").alias("o_orderstatus"),
        F.round(F.sum("l_extendedprice"), 2).alias("o_totalprice"),
        F.max("l_shipdate").alias("o_orderdate"),
        F.lit("changed").alias("o_orderpriority"),
    )


@query
def image_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector written as a grey image file of one line, and sizes and pixels read from the files."""
    grey = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(
        F.lit(255), F.floor((x.cast("double") + 1) * 127.5))))
    code = F.transform(grey, lambda x: F.lpad(F.hex(x), 2, "0"))
    pixels = F.unhex(F.array_join(code, ""))
    path = scratch_path(spark, "pixels")
    rows = s.given(spark, folder, "embeddings").where("size(embedding) > 0").select(
        F.col("vec_id").cast("string").alias("name"), F.size("embedding").alias("width"), F.lit(1).alias("height"),
        F.lit(1).alias("channels"), pixels.alias("pixels"),
    )
    pixel_files.write_images(rows, path)
    terms = F.transform("pixels", lambda x, at: x.cast("long") * (at + 1))
    return image_files.image_vectors(spark, path).select(
        F.regexp_extract("origin", r"(\d+)\.png$", 1).cast("long").alias("vec_id"),
        "width", "height", F.col("nChannels").alias("channels"),
        F.aggregate(terms, F.lit(0).cast("long"), lambda total, x: total + x).alias("checksum"),
    )


@query
def upsert_all(spark: SparkSession, folder: str) -> DataFrame:
    return mutate.upsert(s.given(spark, folder, "orders"), _order_changes(spark, folder), ["o_orderkey"])


@query
def upsert_partial(spark: SparkSession, folder: str) -> DataFrame:
    return mutate.upsert(
        s.given(spark, folder, "orders"), _order_changes(spark, folder), ["o_orderkey"],
        ["o_totalprice", "o_orderpriority"],
    )


def _first_words(spark: SparkSession, folder: str) -> DataFrame:
    """A dictionary of the words that part names begin with."""
    first = s.given(spark, folder, "part").select(F.substring_index("p_name", " ", 1).alias("word"))
    return keyed_values(first, "word", "word_key").select("word", "word_key")


@query
def upsert_default_key(spark: SparkSession, folder: str) -> DataFrame:
    """Words of part names against the dictionary of first words; unknown ones get -1."""
    words = explode_values(
        s.given(spark, folder, "part"), text.split_values(F.col("p_name"), " "), ["p_partkey"], "word"
    )
    known = _first_words(spark, folder)
    return mutate.lookup_key(words, known, "word", "word_key")


@query
def append_new_keys(spark: SparkSession, folder: str) -> DataFrame:
    words = explode_values(
        s.given(spark, folder, "part"), text.split_values(F.col("p_name"), " "), ["p_partkey"], "word"
    )
    known = _first_words(spark, folder)
    return mutate.append_new_keys(known, words, "word", "word_key")


@query
def replace_value_sets(spark: SparkSession, folder: str) -> DataFrame:
    target = s.cuisines(spark, folder)
    rows = s.given(spark, folder, "part").where("p_type = 'PROMO'").select(
        s.brand_number().alias("restaurant_key"), F.upper("p_type").alias("cuisine")
    )
    return warehouse.update_values(target, rows.distinct(), "cuisine", "cuisine_key")


def _ratings(orders: DataFrame) -> DataFrame:
    return orders.groupBy(
        F.col("o_custkey").alias("ra_key"), F.lit("google").alias("source"),
        dates.day_epoch(F.to_date("o_orderdate")).alias("timestamp"),
    ).agg(F.max("o_totalprice").alias("rating"))


@query
def rating_history(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings by day, those of finished orders loaded again with other values: none appears twice."""
    orders = s.given(spark, folder, "orders")
    again = _ratings(orders.where("o_orderstatus = 'F'")).withColumn("rating", F.col("rating") + 1)
    return warehouse.update_ratings(_ratings(orders), again)


@query
def opening_hours_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The venues that open on the first weekday loaded again, with several periods a day and one that never closes, twice."""
    hours = s.opening_hours(spark, folder)
    again = hours.join(hours.where("day_key = 0").select("ra_key").distinct(), "ra_key", "left_semi")
    always = again.select(
        "ra_key", F.lit(None).cast("int").alias("day_key"), F.lit(0).alias("open_time"),
        F.lit(None).cast("int").alias("close_time"),
    )
    later = again.withColumn("close_time", F.col("close_time") + 100).unionByName(always)
    return warehouse.update_opening_hours(warehouse.update_opening_hours(hours, later), later)


@query
def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    users = s.users(spark, folder)
    return mutate.delete_where(users, F.col("age") < 50)


@query
def cascade_delete(spark: SparkSession, folder: str) -> DataFrame:
    customers = s.given(spark, folder, "customer")
    kept, rest = mutate.cascade_delete(
        customers, "c_custkey", F.col("c_acctbal") < 0,
        {
            "orders": (s.given(spark, folder, "orders"), "o_custkey"),
            "events": (s.given(spark, folder, "events"), "user_id"),
        },
    )
    named = lambda name, df, key, owner: df.select(
        F.lit(name).alias("table_name"), F.col(key).alias("id"), F.col(owner).alias("owner")
    )
    return (
        named("customer", kept, "c_custkey", "c_custkey")
        .unionByName(named("orders", rest["orders"], "o_orderkey", "o_custkey"))
        .unionByName(named("events", rest["events"], "event_id", "user_id"))
    )


@query
def mark_closed(spark: SparkSession, folder: str) -> DataFrame:
    closed = s.given(spark, folder, "events").where("event_type = 'error'").select(
        F.concat(F.lit("go"), F.get_json_object("props", "$.k")).alias("place_id")
    )
    flagged = mutate.mark_closed(s.restaurants(spark, folder), closed, F.lit("2024-03-05 10:20:30").cast("timestamp"))
    time = F.date_format("closed_time", "yyyy-MM-dd HH:mm:ss").alias("closed_time")
    return flagged.select("key", "go_key", "closed", time)


@query
def assign_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = s.given(spark, folder, "customer").select("c_name", "c_nationkey")
    existing = s.given(spark, folder, "customer").where("c_acctbal >= 0").select(
        "c_name", (F.col("c_custkey") * 2).alias("key")
    )
    return mutate.assign_keys(rows, existing, ["c_name"], ["c_name"])


# Spatial join and the warehouse it feeds


@query
def spatial_inner(spark: SparkSession, folder: str) -> DataFrame:
    pairs = spatial.within_radius(s.venues_a(spark, folder), s.venues_b(spark, folder))
    return pairs.select("place_id", "ta_id", F.round("distance_m", 3).alias("distance_m"))


@query
def spatial_left(spark: SparkSession, folder: str) -> DataFrame:
    pairs = spatial.within_radius_left(s.venues_a(spark, folder), s.venues_b(spark, folder), "place_id")
    return pairs.select("place_id", "ta_id", F.round("distance_m", 3).alias("distance_m"))


@query
def spatial_other_zone(spark: SparkSession, folder: str) -> DataFrame:
    """The same join on the map of a zone further east, where a map metre is less than one on the ground."""
    pairs = spatial.within_radius(s.venues_a(spark, folder), s.venues_b(spark, folder), zone=33)
    return pairs.select("place_id", "ta_id", F.round("distance_m", 3).alias("distance_m"))


@query
def globe_within_distance(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers less than 100 km apart, all over the globe."""
    pairs = globe.within_distance(s.globe_points(spark, folder, "orders", "o_orderkey", ""),
                                  s.globe_points(spark, folder, "customer", "c_custkey", "ta_"), 100_000.0)
    return pairs.select("o_orderkey", "c_custkey", F.round("distance_m", 3).alias("distance_m"))


@query
def globe_nearest_places(spark: SparkSession, folder: str) -> DataFrame:
    """The three suppliers nearest to every customer, wherever they are."""
    near = globe.nearest_places(s.globe_points(spark, folder, "customer", "c_custkey", ""),
                                s.globe_points(spark, folder, "supplier", "s_suppkey", "ta_"),
                                3, "c_custkey", "s_suppkey", start=200_000.0)
    return near.select("c_custkey", F.col("rank").alias("place"), "s_suppkey", F.round("distance_m", 3).alias("distance_m"))


def _matched(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.match_venues(s.venues_a(spark, folder), s.venues_b(spark, folder))


@query
def build_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    built = warehouse.build_restaurants(_matched(spark, folder))
    return rounded(built.drop("closed_time"), "latitude", "longitude")


@query
def build_cuisines(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.build_cuisines(_matched(spark, folder))


@query
def build_meals(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.build_meals(_matched(spark, folder))


@query
def build_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.build_ratings(_matched(spark, folder), F.lit("2024-03-05").cast("date"))


@query
def build_long_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as reviews of the venue whose number is the conversation's."""
    conv = F.col("conv_id")
    reviews = s.given(spark, folder, "conversations").select(
        F.concat(conv, F.lit("-"), "turn").alias("_c0"),
        F.concat(F.lit("http://venues.example/Review-g187497-d"), conv, F.lit("-Place")).alias("url_restaurant"),
        F.when(F.col("turn") % 4 == 3, "yesterday").otherwise(
            F.concat(F.lit("January "), F.col("turn") % 28 + 1, F.lit(", 2020"))
        ).alias("date"),
        F.col("role").alias("rating_review"), F.lit("sample").alias("sample"), F.col("role").alias("title_review"),
        F.col("text").alias("review_full"),
    )
    return warehouse.build_long_reviews(_matched(spark, folder), reviews)


@query
def build_michelin(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as award list: it names the venue of the same customer."""
    key = F.col("c_custkey")
    awards = s.given(spark, folder, "customer").select(
        F.col("c_name").alias("Name"),
        F.when(key % 2 == 0, "Barcelona").otherwise("Madrid").alias("Location"),
        F.when(key % 3 == 0, "Bib Gourmand").when(key % 3 == 1, F.concat(key % 4, F.lit(" MICHELIN Star")))
        .otherwise("Green").alias("Award"),
    )
    return warehouse.build_michelin(_matched(spark, folder), awards, "Barcelona").drop("year")


def _parsed_periods(spark: SparkSession, folder: str) -> DataFrame:
    return s.given(spark, folder, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey")).alias("google_key"), (F.col("p_size") % 7).alias("day"),
        F.lit(900).alias("open_time"), F.lit(2100).alias("close_time"), (F.col("p_size") % 7).alias("open_day"),
    )


@query
def build_opening_hours(spark: SparkSession, folder: str) -> DataFrame:
    restaurants = warehouse.build_restaurants(_matched(spark, folder))
    return warehouse.build_opening_hours(_parsed_periods(spark, folder), restaurants)


def _parsed_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return s.given(spark, folder, "documents").select(
        (F.col("n_chars") % 5 + 1).cast("int").alias("google_rating"), "text", F.col("n_chars").alias("time"),
        F.concat(F.lit(" p"), F.col("doc_id") * 3, F.lit(" ")).alias("google_key"),
    )


@query
def build_reviews(spark: SparkSession, folder: str) -> DataFrame:
    restaurants = warehouse.build_restaurants(_matched(spark, folder))
    return warehouse.build_reviews(_parsed_reviews(spark, folder), restaurants)


def _updated(spark: SparkSession, folder: str, later: str = "true") -> dict[str, DataFrame]:
    """A warehouse built from some venues of the second source, then updated with others."""
    first = durable(
        warehouse.match_venues(s.venues_a(spark, folder), s.venues_b(spark, folder).where("ta_rating < 950"))
    )
    day = F.lit("2024-03-05").cast("timestamp_ntz")
    tables = {
        "restaurants": warehouse.build_restaurants(first), "cuisines": warehouse.build_cuisines(first),
        "meals": warehouse.build_meals(first), "rating": warehouse.build_ratings(first, day),
    }
    next_day = F.lit("2024-03-06").cast("timestamp_ntz")
    partners = s.venues_b(spark, folder).where(later)
    return warehouse.update_warehouse(tables, s.venues_a(spark, folder), partners, next_day)


def _restaurant_rows(restaurants: DataFrame) -> DataFrame:
    return restaurants.withColumn("closed_time", F.date_format("closed_time", "yyyy-MM-dd HH:mm:ss"))


@query
def update_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    return _restaurant_rows(_updated(spark, folder)["restaurants"])


@query
def update_partners(spark: SparkSession, folder: str) -> DataFrame:
    """Known venues that gain partners, lose some or lose all."""
    return _restaurant_rows(_updated(spark, folder, "ta_rating >= 300")["restaurants"])


@query
def update_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return _updated(spark, folder)["rating"]


@query
def update_meals(spark: SparkSession, folder: str) -> DataFrame:
    return _updated(spark, folder)["meals"]


@query
def update_partner_meals(spark: SparkSession, folder: str) -> DataFrame:
    return _updated(spark, folder, "ta_rating >= 300")["meals"]


@query
def delete_closed(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of the restaurants and all tables built with them, one row per row there."""
    matched = durable(_matched(spark, folder))
    restaurants = warehouse.build_restaurants(matched)
    closed = s.venues_a(spark, folder).where("business_status = 'CLOSED_PERMANENTLY'").select("place_id")
    tables = {
        "restaurants": mutate.mark_closed(restaurants, closed), "cuisines": warehouse.build_cuisines(matched),
        "meals": warehouse.build_meals(matched), "rating": warehouse.build_ratings(matched),
    }
    kept = warehouse.delete_closed(tables)
    shown = {
        "restaurants": ("key", "go_key", F.lit(None)), "cuisines": ("restaurant_key", "cuisine", F.lit(None)),
        "meals": ("restaurant_key", "meals", F.lit(None)), "rating": ("ra_key", "source", F.col("rating")),
    }
    return reduce(DataFrame.union, [
        kept[name].select(
            F.lit(name).alias("kind"), F.col(key).alias("restaurant_key"), F.col(value).alias("value"),
            rating.cast("double").alias("rating"),
        )
        for name, (key, value, rating) in shown.items()
    ])


# Changes that touch only buckets


def _late_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders of the last week, with the totals of their items, under new keys every other one."""
    orders = s.given(spark, folder, "orders")
    last = orders.agg(F.max("o_orderdate").alias("d")).scalar()
    late = orders.where(F.col("o_orderdate") >= last - F.expr("INTERVAL 7 DAY"))
    totals = s.given(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total")
    )
    key = F.col("o_orderkey")
    return late.join(totals, "o_orderkey").select(
        F.when(key % 2 == 0, key).otherwise(-key).alias("o_orderkey"), "o_custkey", "o_orderstatus",
        F.col("total").alias("o_totalprice"), "o_orderdate", F.lit("changed").alias("o_orderpriority"),
    )


def _laid_out(spark: SparkSession, folder: str, path: str, name: str, key: str) -> buckets.Table:
    table = buckets.Table(path, name, (key,))
    buckets.lay_out(s.given(spark, folder, name), table, 64)
    return table


@query
def bucket_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All orders after an upsert of late ones, twice, in the buckets they fall into."""
    orders = _laid_out(spark, folder, scratch_path(spark, "buckets"), "orders", "o_orderkey")
    for _ in range(2):
        buckets.upsert(orders, _late_orders(spark, folder))
    return buckets.read(spark, orders)


@query
def bucket_upsert_partial(spark: SparkSession, folder: str) -> DataFrame:
    orders = _laid_out(spark, folder, scratch_path(spark, "buckets"), "orders", "o_orderkey")
    buckets.upsert(orders, _late_orders(spark, folder), update_columns=["o_totalprice", "o_orderpriority"])
    return buckets.read(spark, orders)


@query
def bucket_cascade_delete(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of customers, orders and events after the most indebted customers went, twice."""
    path = scratch_path(spark, "buckets")
    keys = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}
    parent, *children = [_laid_out(spark, folder, path, name, key) for name, key in keys.items()]
    for _ in range(2):
        buckets.cascade_delete(spark, parent, F.col("c_acctbal") < -900, children)
    ids = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id"}
    left = [
        buckets.read(spark, table).select(
            F.lit(table.name).alias("table_name"), F.col(ids[table.name]).alias("id"), F.col(table.keys[0]).alias("owner")
        )
        for table in (parent, *children)
    ]
    return reduce(DataFrame.unionAll, left)


@query
def bucket_replace_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Items of orders that were shipped after the order's day, at least one of them, replaced by one row with their sums, by order."""
    items = _laid_out(spark, folder, scratch_path(spark, "buckets"), "lineitem", "l_orderkey")
    rows = s.given(spark, folder, "lineitem")
    late = rows.join(s.given(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).where(
        F.col("l_shipdate") > F.col("o_orderdate")
    ).select("l_orderkey").distinct()
    sums = rows.join(late, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(
        F.lit(0).alias("l_linenumber"), F.round(F.sum("l_quantity"), 2).alias("l_quantity")
    )
    full = sums.select(*[F.col(c) if c in sums.columns else F.lit(None).alias(c) for c in rows.columns])
    buckets.replace_groups(items, full)
    return buckets.read(spark, items).select("l_orderkey", "l_linenumber", "l_quantity")


@query
def bucket_append_new(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders, then all orders added: those known stay as they are."""
    orders = s.given(spark, folder, "orders")
    table = buckets.Table(scratch_path(spark, "buckets"), "orders", ("o_custkey",))
    buckets.lay_out(orders.where("o_orderstatus = 'F'"), table, 64)
    for _ in range(2):
        buckets.append_new(table, orders.withColumn("o_orderpriority", F.lit("again")), "o_orderkey")
    return buckets.read(spark, table)


# Jobs that write, each run twice


def _loaded(spark: SparkSession, folder: str) -> str:
    lake = scratch_path(spark, "lake")
    day = F.lit("2024-03-05").cast("timestamp_ntz")
    jobs.load_warehouse(spark, lake, s.venues_a(spark, folder), s.venues_b(spark, folder).where("ta_rating < 950"), day)
    return lake


def _update_twice(spark: SparkSession, folder: str) -> str:
    lake = _loaded(spark, folder)
    for _ in range(2):
        next_day = F.lit("2024-03-06").cast("timestamp_ntz")
        jobs.update_warehouse(spark, lake, s.venues_a(spark, folder), s.venues_b(spark, folder), next_day)
    return lake


@query
def job_update_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    return _restaurant_rows(jobs.read_table(spark, _update_twice(spark, folder), "restaurants"))


@query
def job_update_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.read_table(spark, _update_twice(spark, folder), "rating")


def _details_twice(spark: SparkSession, folder: str) -> str:
    lake = scratch_path(spark, "lake")
    jobs.load_warehouse(spark, lake, s.venues_a(spark, folder), s.venues_b(spark, folder))
    for _ in range(2):
        jobs.add_details(spark, lake, _parsed_reviews(spark, folder), _parsed_periods(spark, folder))
    return lake


@query
def job_details_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.read_table(spark, _details_twice(spark, folder), "long_review")


@query
def job_details_hours(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.read_table(spark, _details_twice(spark, folder), "opening_hours")


@query
def job_landed_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Opening hours of venues whose detail files land in two steps, the job run after each and once more."""
    lake = scratch_path(spark, "lake")
    jobs.load_warehouse(spark, lake, s.venues_a(spark, folder), s.venues_b(spark, folder))
    day = (F.col("p_partkey") % 7).cast("string")
    periods = F.concat(
        F.lit("[{'close': {'day': "), day, F.lit(", 'time': '2100'}, 'open': {'day': "), day, F.lit(", 'time': '0900'}}]")
    )
    parts = s.given(spark, folder, "part")
    details = parts.select(
        "p_size", F.concat(F.lit("g_p"), "p_size").alias("place"), F.lit(None).cast("string").alias("reviews"),
        periods.alias("opening_hours.periods"),
    )
    for step in ("p_size <= 25", "p_size > 25", "false"):
        details.where(step).drop("p_size").write.mode("append").partitionBy("place").parquet(f"{lake}/_landing")
        jobs.land_details(spark, lake, f"{lake}/_landing", "place=(g_[^/]+)")
    return jobs.read_table(spark, lake, "opening_hours")


@query
def job_images(spark: SparkSession, folder: str) -> DataFrame:
    lake = scratch_path(spark, "lake")
    named = s.restaurants(spark, folder).withColumn("go_key", F.concat(F.lit("go"), "key"))
    buckets.lay_out(named, jobs.table(lake, "restaurants"))
    for _ in range(2):
        jobs.add_images(spark, lake, image_files.image_catalog(_image_paths(spark, folder)))
    return jobs.read_table(spark, lake, "images_external")


@query
def job_delete(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of restaurants, cuisines, meals and ratings after closed venues were deleted twice."""
    lake = _update_twice(spark, folder)
    for _ in range(2):
        jobs.delete_closed(spark, lake)
    keys = {"restaurants": "key", "cuisines": "restaurant_key", "meals": "restaurant_key", "rating": "ra_key"}
    parts = [
        jobs.read_table(spark, lake, name).select(F.lit(name).alias("table_name"), F.col(key).alias("key"))
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionAll, parts).groupBy("table_name", "key").agg(F.count(F.lit(1)).alias("rows"))


# Graph


def _graph_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Warehouse tables of the graph: some ends of edges have no node of their own."""
    parts = s.given(spark, folder, "part")
    key = F.col("p_partkey")
    customers = s.given(spark, folder, "customer")
    return {
        "restaurants": s.restaurants(spark, folder).where("closed = 0"),
        "images": s.images(spark, folder),
        "users": customers.where("c_mktsegment <> 'FURNITURE'").select(
            F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("sex"), F.lit("2024").alias("createDate"),
            F.col("c_nationkey").alias("nationality"), F.col("c_mktsegment").alias("occupation"),
        ),
        "cuisines": s.cuisines(spark, folder),
        "meals": parts.select(
            s.brand_number().alias("restaurant_key"), F.concat(F.lit("size "), "p_size").alias("meals"),
            F.col("p_size").alias("meal_key"),
        ),
        "weekday": warehouse.weekdays(spark).where("weekday <> 'Tuesday'"),
        "opening_hours": s.opening_hours(spark, folder),
        "michelin": parts.select(
            s.brand_number().alias("ra_key"), (F.col("p_size") % 4).alias("number_of_stars"),
            F.lit(None).cast("int").alias("year"),
        ),
        "dishes": s.dishes(spark, folder),
        "images_external": parts.select(
            key.alias("image_id"), s.brand_number().alias("ra_key"), F.col("p_name").alias("image_file"),
            F.lit("google").alias("source"),
        ),
        "swipes": s.swipes(spark, folder),
    }


def _graph(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    return graph.build_graph(_graph_tables(spark, folder))


@query
def graph_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return _graph(spark, folder)[0]


@query
def graph_node_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return graph.node_lookup(_graph(spark, folder)[0], "User", 8)


@query
def graph_node_properties(spark: SparkSession, folder: str) -> DataFrame:
    return graph.node_tables(_graph_tables(spark, folder))["Cuisines"][0]


@query
def graph_written(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes read back from the graph that a job wrote twice."""
    lake = scratch_path(spark, "graph")
    for _ in range(2):
        jobs.write_graph(spark, lake, _graph_tables(spark, folder))
    return read_current(spark, lake, "graph_nodes")


@query
def graph_edges_written(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of all kinds read back from the graph that a job wrote twice."""
    lake = scratch_path(spark, "graph")
    for _ in range(2):
        jobs.write_graph(spark, lake, _graph_tables(spark, folder))
    edges = read_current(spark, lake, "graph_edges")
    return edges.groupBy(
        "type", "src_label", "src", "dst_label", "dst", "swipeLeft", "open_time", "close_time", "number_of_stars"
    ).agg(F.count(F.lit(1)).alias("edges"))


@query
def graph_edges_bag(spark: SparkSession, folder: str) -> DataFrame:
    _, edges = _graph(spark, folder)
    view = graph.edge_view({name: edges[name] for name in edges if graph.EDGES[name].kind == graph.BAG})
    return view.groupBy("type", "src_label", "src", "dst_label", "dst", "swipeLeft").agg(
        F.count(F.lit(1)).alias("edges")
    )


@query
def graph_edges_set(spark: SparkSession, folder: str) -> DataFrame:
    _, edges = _graph(spark, folder)
    view = graph.edge_view({name: edges[name] for name in edges if graph.EDGES[name].kind == graph.SET})
    return view.drop("year")


def _projection(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    nodes, edges = _graph(spark, folder)
    view = graph.edge_view({name: edges[name] for name in graph.PROJECTED_TYPES})
    return graph.projection_nodes(nodes), graph.projection(view)


@query
def graph_projection(spark: SparkSession, folder: str) -> DataFrame:
    edges = _projection(spark, folder)[1]
    return edges.groupBy("type", "src", "dst").agg(F.sum("weight").alias("weight"), F.sum("swipeLeft").alias("left"))


@query
def graph_likes(spark: SparkSession, folder: str) -> DataFrame:
    return graph.likes_only(_projection(spark, folder)[1]).drop("swipeLeft")


@query
def graph_likes_every_type(spark: SparkSession, folder: str) -> DataFrame:
    return graph.likes_only(_projection(spark, folder)[1], every_type=True).drop("swipeLeft")


@query
def fastrp(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _projection(spark, folder)
    vectors = embed(nodes, graph.likes_only(edges))
    shown = F.transform("embedding", lambda x: F.round(x.cast("double"), 4))
    return vectors.select("node", F.posexplode(shown).alias("dimension", "value")).where("value <> 0")


@query
def knn_exact(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(s.given(spark, folder, "embeddings"), 10, "vec_id")


@query
def knn_many_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same with small tiles, so that cells are ruled out."""
    return nearest(s.given(spark, folder, "embeddings"), 10, "vec_id", tile_rows=50, max_pivots=20)


@query
def similar_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _graph(spark, folder)
    view = graph.edge_view({name: edges[name] for name in graph.PROJECTED_TYPES})
    return recommend.similar_restaurants(nodes, view).select("src", "dst", F.round("score", 4).alias("score"))


# Recommendation


def _similar(spark: SparkSession, folder: str) -> DataFrame:
    """Restaurants linked by the brand and size of a part, scored by the part's number."""
    rows = s.given(spark, folder, "part").select(
        s.brand_number().alias("src"), (F.col("p_size") % 25 + 1).cast("bigint").alias("dst"), "p_partkey"
    )
    return rows.where("src <> dst").groupBy("src", "dst").agg(
        F.round(F.max(F.col("p_partkey") % 997) / 997, 6).alias("score")
    )


AT = "2024-01-17 12:15:00"


@query
def recent_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    recent = recommend.recent_restaurants(s.swipes(spark, folder), s.images(spark, folder))
    return recent.groupBy("userId", "restaurantId").agg(F.count(F.lit(1)).alias("likes"))


@query
def open_places(spark: SparkSession, folder: str) -> DataFrame:
    at = F.lit(AT).cast("timestamp_ntz")
    places = recommend.open_places(
        s.restaurants(spark, folder), s.opening_hours(spark, folder), warehouse.weekdays(spark), at
    )
    return rounded(places, "latitude", "longitude")


def _recommendation_inputs(
    spark: SparkSession, folder: str, user: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    at = F.lit(AT).cast("timestamp_ntz")
    return (
        recommend.recent_restaurants(s.swipes(spark, folder), s.images(spark, folder), user=user),
        _similar(spark, folder),
        recommend.open_places(
            s.restaurants(spark, folder), s.opening_hours(spark, folder), warehouse.weekdays(spark), at
        ),
    )


@query
def recommend_batch(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    locations = s.given(spark, folder, "customer").select(
        key.alias("userId"), (41.3 + key % 80 * 0.001).alias("latitude"), (2.1 + key % 70 * 0.001).alias("longitude")
    )
    chosen = recommend.recommend(*_recommendation_inputs(spark, folder), locations)
    return chosen.withColumn("distance", F.round("distance", 2))


@query
def recommend_single(spark: SparkSession, folder: str) -> DataFrame:
    chosen = recommend.recommend_for(7, 41.35, 2.15, *_recommendation_inputs(spark, folder, 7))
    return chosen.withColumn("distance", F.round("distance", 2))


@query
def recommend_from_any(spark: SparkSession, folder: str) -> DataFrame:
    chosen = recommend.recommend_for(7, 41.35, 2.15, *_recommendation_inputs(spark, folder, 7), from_any=True)
    return chosen.withColumn("distance", F.round("distance", 2))


@query
def liked_images(spark: SparkSession, folder: str) -> DataFrame:
    liked = recommend.liked_images(s.history(spark, folder), s.images(spark, folder))
    return liked.select("restaurantId", "imageId", "swipes", "likes", F.round("ratio", 6).alias("ratio"), "place")


@query
def image_pick(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.pick_image(s.history(spark, folder), s.images(spark, folder))
