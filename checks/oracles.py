"""The same results in SQL, written apart from the library, for a check in DuckDB."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# The domain's tables as common table expressions.
BASE = {
    "swipes": """
        SELECT event_id AS id, user_id AS userId, CAST(json_extract_string(props, '$.k') AS BIGINT) AS imageId,
               ts AS "timestamp", CASE WHEN event_type IN ('error', 'view') THEN 1 ELSE 0 END AS swipeLeft
        FROM events""",
    "history": """
        SELECT l_orderkey AS id, o_custkey AS userId, l_partkey AS imageId, l_shipdate AS "timestamp",
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS swipeLeft
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "images": """
        SELECT p_partkey AS id, 'img_' || p_partkey || '.jpg' AS file, p_partkey AS dishId,
               CAST(p_size AS BIGINT) AS uploaderId, CAST(substr(p_brand, 7) AS BIGINT) AS restaurantId
        FROM part""",
    "restaurants": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS key, p_brand AS restaurant_name,
               41.3::DOUBLE + CAST(substr(p_brand, 7) AS BIGINT) * 0.003::DOUBLE AS latitude,
               2.1::DOUBLE + (CAST(substr(p_brand, 7) AS BIGINT) * 7 % 25) * 0.004::DOUBLE AS longitude
        FROM part""",
    "cuisines": """
        SELECT restaurant_key, cuisine,
               CAST(dense_rank() OVER (ORDER BY cuisine) - 1 AS BIGINT) AS cuisine_key
        FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS restaurant_key, p_type AS cuisine FROM part)""",
    "users": """
        SELECT c_custkey AS id, n_name AS city,
               CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) % 125 END AS age
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}


def stats(fact: str, name: str = "") -> dict[str, str]:
    """Daily and monthly marts of a fact."""
    return {
        f"daily{name}": f"""
            SELECT restaurantId, CAST("timestamp" AS DATE) AS "date", count(DISTINCT userId) AS users,
                   count(swipeLeft) AS impressions, CAST(sum(swipeLeft) AS BIGINT) AS left_swipes
            FROM {fact} s JOIN images i ON s.imageId = i.id GROUP BY ALL""",
        f"averages{name}": f"""
            SELECT strftime("date", '%Y-%m') AS "month", restaurantId, avg(users) AS dly_avg_users,
                   avg(impressions) AS dly_avg_impressions, avg(left_swipes) AS dly_avg_left_swipes,
                   count(DISTINCT "date") AS days_active
            FROM daily{name} GROUP BY ALL""",
        f"monthly{name}": f"""
            SELECT a.*, restaurant_name,
                   dense_rank() OVER (PARTITION BY "month" ORDER BY dly_avg_impressions DESC) AS "rank"
            FROM averages{name} a JOIN restaurants r ON a.restaurantId = r.key""",
    }


PARTS = BASE | stats("swipes") | stats("history", "_history") | {
    "image_month": """
        SELECT restaurantId, strftime("timestamp", '%Y-%m') AS "month", imageId, dishId, file,
               count(swipeLeft) AS impressions, CAST(sum(swipeLeft) AS BIGINT) AS left_swipes
        FROM history s JOIN images i ON s.imageId = i.id GROUP BY ALL""",
    "image_places": """
        SELECT *, row_number() OVER (PARTITION BY restaurantId, "month" ORDER BY impressions DESC, imageId) AS toprow,
               row_number() OVER (PARTITION BY restaurantId, "month" ORDER BY impressions, imageId) AS botrow
        FROM image_month""",
    "monthly_images": """
        SELECT restaurantId, "month", impressions, left_swipes, p_name AS "name",
               CASE WHEN toprow < botrow THEN 'top-' || toprow ELSE 'bot-' || botrow END AS "rank", file
        FROM image_places JOIN part ON dishId = p_partkey WHERE toprow < 4 OR botrow < 4""",
    "visitors": """
        SELECT restaurantId, "month", city,
               CASE WHEN age IS NOT NULL THEN CAST(least(19, age // 5) AS INTEGER) END AS age_bucket,
               count(*) AS users
        FROM (SELECT DISTINCT userId, restaurantId, strftime("timestamp", '%Y-%m') AS "month"
              FROM history s JOIN images i ON s.imageId = i.id) v
        JOIN users u ON v.userId = u.id GROUP BY ALL""",
    "peers": """
        SELECT c.restaurant_key AS restaurantId, "month", cuisine, "rank", dly_avg_users, dly_avg_impressions,
               dly_avg_left_swipes, days_active
        FROM monthly m RIGHT JOIN cuisines c ON m.restaurantId = c.restaurant_key""",
    "peer_ranks": """
        SELECT *, row_number() OVER (PARTITION BY cuisine, "month"
                                     ORDER BY dly_avg_impressions DESC NULLS LAST, restaurantId) AS crank
        FROM peers""",
    "peer_means": """
        SELECT cuisine, "month", avg(dly_avg_users) AS dly_avg_users, avg(dly_avg_impressions) AS dly_avg_impressions,
               avg(dly_avg_left_swipes) AS dly_avg_left_swipes, avg(days_active) AS days_active,
               count(DISTINCT restaurantId) AS restos
        FROM peers GROUP BY ALL""",
}


def with_parts(select: str, extra: dict[str, str] | None = None) -> str:
    """The select with the parts it needs, directly or through others, in front of it."""
    parts = PARTS | (extra or {})
    words = lambda sql: set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split())
    needed: set[str] = set()

    def add(sql: str) -> None:
        for name in words(sql) & parts.keys():
            if name not in needed:
                needed.add(name)
                add(parts[name])

    add(select)
    listed = ", ".join(f"{name} AS ({sql})" for name, sql in parts.items() if name in needed)
    return f"WITH {listed} {select}" if listed else select


def oracle(name: str, select: str, extra: dict[str, str] | None = None) -> None:
    ORACLES[name] = with_parts(select, extra)


ROUNDED = (
    "round(dly_avg_users, 6) AS dly_avg_users, round(dly_avg_impressions, 6) AS dly_avg_impressions, "
    "round(dly_avg_left_swipes, 6) AS dly_avg_left_swipes"
)
DAILY = """restaurantId, strftime("date", '%Y-%m-%d') AS "date", users, impressions, left_swipes"""

oracle("daily_stats", f"SELECT {DAILY} FROM daily")
for suffix, query_name in (("", "monthly_stats_ranked"), ("_history", "monthly_history_ranked")):
    oracle(
        query_name,
        f'SELECT restaurantId, "month", {ROUNDED}, days_active, restaurant_name, "rank" FROM monthly{suffix}',
    )
ORACLES["marts_written"] = ORACLES["monthly_history_ranked"]
oracle(
    "marts_written_view",
    f"""SELECT cuisine, "month", {ROUNDED}, round(days_active, 6) AS days_active, restos FROM (
        SELECT cuisine, "month", avg(dly_avg_users) AS dly_avg_users, avg(dly_avg_impressions) AS dly_avg_impressions,
            avg(dly_avg_left_swipes) AS dly_avg_left_swipes, avg(days_active) AS days_active,
            count(DISTINCT c.restaurant_key) AS restos
        FROM monthly_history m RIGHT JOIN cuisines c ON m.restaurantId = c.restaurant_key
        WHERE cuisine IN (SELECT cuisine FROM cuisines WHERE restaurant_key = 3) GROUP BY ALL)""",
)
oracle("marts_incremented_days", f"SELECT {DAILY} FROM daily_history")
ORACLES["marts_incremented_months"] = ORACLES["monthly_history_ranked"]
oracle(
    "marts_incremented_visitors",
    """SELECT restaurantId, strftime("timestamp", '%Y-%m') AS "month", count(DISTINCT userId) AS visitors
    FROM history s JOIN images i ON s.imageId = i.id GROUP BY ALL""",
)
oracle(
    "landed_details",
    """SELECT 'g_' || p_size AS google_key, p_name AS reviews,
        CASE WHEN len(p_name) % 2 = 0 THEN p_brand END AS opening_periods, (p_size > 25)::INT AS batch FROM part""",
)
oracle("top_bottom_items", "SELECT * FROM monthly_images")
oracle("visitor_profile", "SELECT * FROM visitors")
oracle("peer_rank", 'SELECT restaurantId, "month", cuisine, "rank", crank FROM peer_ranks')
oracle(
    "peer_averages",
    f'SELECT cuisine, "month", {ROUNDED}, round(days_active, 6) AS days_active, restos FROM peer_means',
)


def compact(value: str) -> str:
    """Compact number text; rounds half to even."""
    return f"""CASE WHEN {value} < 1000 THEN CAST(round_even({value}, 0) AS BIGINT) || ''
        WHEN {value} < 1000000 THEN CAST(round_even({value} / 1e3, 0) AS BIGINT) || ' K'
        ELSE CAST(round_even({value} / 1e6, 0) AS BIGINT) || ' M' END"""


oracle(
    "peer_cards",
    f"""SELECT r.restaurantId, r.cuisine, r."month", crank, restos,
        {compact('m.dly_avg_users')} AS dly_avg_users, {compact('m.dly_avg_impressions')} AS dly_avg_impressions,
        {compact('m.dly_avg_left_swipes')} AS dly_avg_left_swipes
    FROM peer_ranks r JOIN peer_means m ON r.cuisine = m.cuisine AND r."month" = m."month" """,
)
oracle(
    "restaurant_cuisine_ranking",
    'SELECT "month", cuisine, "rank", crank FROM peer_ranks WHERE restaurantId = 3',
)
oracle("restaurant_months", 'SELECT DISTINCT "month" FROM monthly WHERE restaurantId = 3')
oracle(
    "restaurant_month_slice",
    """SELECT strftime("date", '%Y-%m-%d') AS "date", users, impressions, left_swipes
    FROM daily WHERE restaurantId = 3 AND strftime("date", '%Y-%m') = '2024-01'""",
)
oracle("available_months", 'SELECT DISTINCT restaurantId, "month" FROM monthly')
oracle("date_range_slice", f"SELECT {DAILY} FROM daily d WHERE d.\"date\" BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
oracle(
    "series_mean_position",
    f"""SELECT restaurantId, "month", round(mean, 6) AS mean, low, high, first_date, last_date,
        round(CASE WHEN high <> low THEN 1 - (high - mean) / (high - low) END, 6) AS position,
        {compact('mean')} AS label
    FROM (SELECT restaurantId, strftime("date", '%Y-%m') AS "month", avg(impressions) AS mean,
          min(impressions) AS low, max(impressions) AS high, strftime(min("date"), '%Y-%m-%d') AS first_date,
          strftime(max("date"), '%Y-%m-%d') AS last_date FROM daily GROUP BY 1, 2)""",
)
oracle("compact_number", f"SELECT o_orderkey, {compact('o_totalprice')} AS shown FROM orders")
oracle(
    "bottom_not_top",
    """SELECT b.* FROM monthly_images b WHERE b."rank" LIKE 'bot-%' AND NOT EXISTS (
        SELECT 1 FROM monthly_images t WHERE t."rank" LIKE 'top-%' AND t.file = b.file
        AND t.restaurantId = b.restaurantId AND t."month" = b."month")""",
)
oracle(
    "visitors_by_city",
    'SELECT restaurantId, "month", city, CAST(sum(users) AS BIGINT) AS users FROM visitors GROUP BY ALL',
)
oracle(
    "visitors_by_age",
    """SELECT restaurantId, "month", age_bucket, age_bucket * 5 AS first_age, CAST(sum(users) AS BIGINT) AS users
    FROM visitors GROUP BY ALL""",
)

# Cleaning and normalising

WORDS = {
    "words": "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
    "doc_words": r"SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS tag FROM documents",
    "tag_ids": """SELECT tag, CAST(row_number() OVER (ORDER BY encode(tag)) AS BIGINT) AS id
        FROM (SELECT DISTINCT tag FROM doc_words)""",
    "known_words": """SELECT word, CAST(row_number() OVER (ORDER BY word) - 1 AS BIGINT) AS word_key
        FROM (SELECT DISTINCT string_split(p_name, ' ')[1] AS word FROM part)""",
}
oracle(
    "explode_rank_keys",
    "SELECT p_partkey, word, CAST(dense_rank() OVER (ORDER BY word) - 1 AS BIGINT) AS word_key FROM words", WORDS,
)
oracle("normalize_parent", "SELECT doc_id AS id, lang FROM documents")
oracle("normalize_values", "SELECT tag, id FROM tag_ids", WORDS)
oracle(
    "normalize_bridge",
    "SELECT DISTINCT doc_id AS imageId, id AS tagId FROM doc_words w JOIN tag_ids t ON w.tag = t.tag", WORDS,
)
oracle("image_restaurants", "SELECT id, file, dishId, restaurantId FROM images")
oracle(
    "rating_union",
    """SELECT c_custkey AS ra_key, c_acctbal AS rating, 'google' AS source, 1709596800::BIGINT AS "timestamp"
    FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey, CAST(c_nationkey AS DOUBLE), 'tripadvisor', 1709596800 FROM customer WHERE c_nationkey <> 3""",
)
oracle(
    "award_parse",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN -1 WHEN 'F' THEN CAST(left(o_orderpriority, 1) AS INTEGER)
    END AS stars FROM orders""",
)
oracle(
    "price_level",
    """SELECT 'http://venues.example/Review-g187497-d' || p_partkey || '-Place' AS ta_url,
    CASE p_size % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 END AS level FROM part""",
)
oracle(
    "key_from_url",
    "SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 'g187497-d' || page_id ELSE '' END AS key FROM pages",
)
oracle(
    "parse_record_text",
    """SELECT CAST((n - 1) % 5 + 1 AS INTEGER) AS google_rating, lines[n] AS text,
        CAST(n - 1 + 1600000000 AS BIGINT) AS time, CAST(doc_id AS VARCHAR) AS google_key
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS n
          FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
)
oracle(
    "parse_nested_hours",
    """SELECT p_size % 7 AS "day", CAST((p_partkey % 12 + 8) * 100 + 30 AS INTEGER) AS open_time,
        CAST((p_partkey % 12 + 12) * 100 + 30 AS INTEGER) AS close_time, p_size % 7 AS open_day,
        CAST(p_partkey AS VARCHAR) AS google_key
    FROM part WHERE p_size % 10 <> 0
    UNION ALL SELECT NULL, 0, NULL, 0, CAST(p_partkey AS VARCHAR) FROM part WHERE p_size % 10 <> 0""",
)
oracle(
    "parse_rejects",
    """SELECT CAST(doc_id AS VARCHAR) AS google_key, 'reviews' AS "column", text FROM documents""",
)
oracle(
    "pii_split_users",
    """SELECT c_custkey AS id, c_mktsegment AS sex, CAST(c_nationkey AS VARCHAR) AS nationality,
        c_mktsegment AS occupation,
        CASE WHEN c_custkey % 11 <> 0 THEN 'City ' || c_nationkey END AS city,
        CASE WHEN c_custkey % 11 <> 0 THEN '08' || (c_custkey % 100) END AS zipcode,
        CASE WHEN c_custkey % 13 <> 0 THEN CAST(floor(date_diff('day',
            make_date(1940 + c_custkey % 60, c_custkey % 12 + 1, c_custkey % 28 + 1), DATE '2024-03-05') / 365.25)
            AS BIGINT) END AS age
    FROM customer""",
)
oracle(
    "pii_split_personal",
    """SELECT c_custkey AS id, 'user' || c_custkey AS username, c_name AS "name",
        CASE WHEN c_custkey % 11 = 0 THEN 'Street' ELSE 'Street ' || c_custkey || chr(10) || 'City ' || c_nationkey
            || ', 08' || (c_custkey % 100) END AS address,
        c_custkey || '@mail.example' AS mail,
        CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE (1940 + c_custkey % 60) || '-' || (c_custkey % 12 + 1)
            || '-' || (c_custkey % 28 + 1) END AS birthdate,
        '+34 ' || c_custkey AS phone,
        round(41.3 + c_custkey % 100 * 0.001::DOUBLE, 6) AS homeLat,
        round(2.1 + c_custkey % 90 * 0.001::DOUBLE, 6) AS homeLng
    FROM customer""",
)
oracle("column_label", "SELECT o_orderkey, replace(lower(o_orderpriority), ' ', '_') AS label FROM orders")

# Landing files and image paths

VENUES = {
    "venues_a": """
        SELECT c_name AS "name", 'p' || c_custkey AS place_id,
            CASE WHEN c_custkey % 10 = 0 THEN 'CLOSED_PERMANENTLY' WHEN c_custkey % 17 <> 0 THEN 'OPERATIONAL' END
                AS business_status,
            CASE c_custkey % 3 WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN CAST(c_custkey % 4 + 1 AS DOUBLE) END AS price_level,
            CASE WHEN c_acctbal < 0 THEN 'NaN'::DOUBLE ELSE c_acctbal END AS rating,
            c_nationkey AS user_ratings_total, 'Street ' || c_custkey AS vicinity,
            41.3::DOUBLE + (c_custkey % 401) * 0.0005::DOUBLE AS latitude,
            2.0::DOUBLE + (c_custkey % 499) * 0.0005::DOUBLE AS longitude
        FROM customer""",
    "venues_b": """
        SELECT 'g187497-d' || p_partkey AS ta_id, 'http://venues.example/Review-g187497-d' || p_partkey || '-Place'
                AS ta_url, p_retailprice AS ta_rating, p_name, p_partkey,
            CASE WHEN p_size % 5 <> 0 THEN p_type || ', ' || p_brand END AS ta_meals,
            CASE p_size % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 END AS ta_level,
            41.3::DOUBLE + (p_partkey % 401) * 0.0005::DOUBLE + ((p_partkey * 37) % 21 - 10) * 0.00001::DOUBLE AS lat,
            2.0::DOUBLE + (p_partkey % 499) * 0.0005::DOUBLE + ((p_partkey * 53) % 21 - 10) * 0.00001::DOUBLE AS lon
        FROM part""",
}


def utm_sql(lat: str, lon: str, source: str, columns: str, meridian: int = 3) -> str:
    """UTM by Krüger's series, to the fourth order of the third flattening."""
    return f"""SELECT {columns},
            500000 + 0.9996 * a * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta)
                + a3 * cos(6 * xi) * sinh(6 * eta) + a4 * cos(8 * xi) * sinh(8 * eta)) AS x,
            0.9996 * a * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta)
                + a3 * sin(6 * xi) * cosh(6 * eta) + a4 * sin(8 * xi) * cosh(8 * eta)) AS y
        FROM (SELECT *, atan2(t, cos(l)) AS xi, atanh(sin(l) / sqrt(1 + t * t)) AS eta,
                6378137.0::DOUBLE / (1 + n) * (1 + n**2 / 4 + n**4 / 64) AS a,
                n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 AS a1,
                13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 AS a2,
                61 * n**3 / 240 - 103 * n**4 / 140 AS a3, 49561 * n**4 / 161280 AS a4
            FROM (SELECT *, sinh(atanh(sin(radians({lat}))) - e * atanh(e * sin(radians({lat})))) AS t,
                    radians({lon} - {meridian}) AS l
                FROM (SELECT *, f / (2 - f) AS n, sqrt(2 * f - f * f) AS e
                    FROM (SELECT *, 1 / 298.257223563::DOUBLE AS f FROM {source}))))"""


VENUES |= {
    "points_a": utm_sql("latitude", "longitude", "venues_a", "place_id"),
    "points_b": utm_sql("lat", "lon", "venues_b", "ta_id"),
    "near": """SELECT place_id, ta_id, sqrt((a.x - b.x)**2 + (a.y - b.y)**2) AS distance
        FROM points_a a JOIN points_b b ON abs(a.x - b.x) < 7 AND (a.x - b.x)**2 + (a.y - b.y)**2 < 49""",
    "matched": """SELECT CAST(row_number() OVER (ORDER BY place_id, ta_id, distance) - 1 AS BIGINT) AS key,
            a.*, b.*, distance FROM near n JOIN venues_a a USING (place_id) JOIN venues_b b USING (ta_id)""",
    "meal_rows": """SELECT key AS restaurant_key, trim(unnest(string_split(ta_meals, ','))) AS meals FROM matched""",
    "cuisine_rows": """SELECT key AS restaurant_key, unnest(string_split(p_name, ' ')) AS cuisine FROM matched""",
    "price_of": """SELECT key, CASE WHEN NOT isnan(price_level) THEN price_level ELSE CAST(ta_level AS DOUBLE) END
        AS price FROM matched""",
}

oracle(
    "multi_file_unify",
    """SELECT "name", place_id, business_status,
        CASE WHEN user_ratings_total < 15 THEN price_level END AS price_level, rating, user_ratings_total, vicinity,
        round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
    FROM venues_a""",
    VENUES,
)
oracle(
    "details_unify",
    """SELECT 'g_both' AS google_key, p_name AS reviews, p_brand AS opening_periods FROM part
    UNION ALL SELECT 'g_reviews', p_name, NULL FROM part UNION ALL SELECT 'g_hours', NULL, p_brand FROM part""",
)
oracle(
    "table_names",
    """SELECT "name", "name" <> 'nation' AS copied, (SELECT count(*) FROM customer) AS customers
    FROM (VALUES ('nation'), ('region'), ('customer')) t("name")""",
)
oracle("append_rows", "SELECT * FROM orders")
CATALOG = {
    "paths": """SELECT '/images/' || CASE WHEN p_partkey % 9 = 0 THEN 'g_' || p_partkey || '.jpg'
        ELSE 'g_go' || (p_partkey % 40) || '_' || p_size || '.jpg' END AS image_file FROM part""",
    "catalog": r"""SELECT substr(regexp_extract(string_split(image_file, '/')[-1], '(.+)_\d+\.jpg', 1), 3) AS google_key,
        image_file, 'google' AS source FROM paths""",
}
oracle("image_catalog", "SELECT * FROM catalog", CATALOG)
oracle(
    "external_images",
    """SELECT sha256(image_file || chr(31) || key) AS image_id, key AS ra_key, image_file, source
    FROM catalog JOIN restaurants ON google_key = 'go' || key""", CATALOG,
)

# Mutation

CHANGES = {
    "changes": """SELECT l_orderkey * 2 AS o_orderkey, count(*) AS o_custkey, max(l_returnflag) AS o_orderstatus,
        round(sum(l_extendedprice), 2) AS o_totalprice, max(l_shipdate) AS o_orderdate, 'changed' AS o_orderpriority
        FROM lineitem GROUP BY 1""",
    "ratings": """SELECT o_custkey AS ra_key, 'google' AS source,
        CAST(epoch(o_orderdate) AS BIGINT) AS "timestamp", max(o_totalprice) AS rating FROM orders GROUP BY ALL""",
    "hours": """SELECT CAST(substr(p_brand, 7) AS BIGINT) AS ra_key, p_size % 7 AS day_key,
        CAST((8 + p_partkey % 12) * 100 AS INTEGER) AS open_time,
        CAST(max((12 + p_partkey % 12) * 100 + 30) AS INTEGER) AS close_time FROM part GROUP BY ALL""",
}
oracle(
    "upsert_all",
    """SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)
    UNION ALL SELECT * FROM changes""",
    CHANGES,
)
oracle(
    "upsert_partial",
    """SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey,
        CASE WHEN o.o_orderkey IS NULL THEN c.o_custkey ELSE o.o_custkey END AS o_custkey,
        coalesce(o.o_orderstatus, c.o_orderstatus) AS o_orderstatus,
        coalesce(c.o_totalprice, o.o_totalprice) AS o_totalprice,
        coalesce(o.o_orderdate, c.o_orderdate) AS o_orderdate,
        coalesce(c.o_orderpriority, o.o_orderpriority) AS o_orderpriority
    FROM orders o FULL JOIN changes c ON o.o_orderkey = c.o_orderkey""",
    CHANGES,
)
oracle(
    "upsert_default_key",
    "SELECT w.word, p_partkey, coalesce(word_key, -1) AS word_key FROM words w LEFT JOIN known_words k ON w.word = k.word",
    WORDS,
)
oracle(
    "append_new_keys",
    """SELECT word, word_key FROM known_words UNION ALL
    SELECT word, row_number() OVER (ORDER BY word) + (SELECT max(word_key) FROM known_words)
    FROM (SELECT DISTINCT word FROM words WHERE word NOT IN (SELECT word FROM known_words))""",
    WORDS,
)
oracle(
    "replace_value_sets",
    """SELECT * FROM cuisines WHERE restaurant_key NOT IN (SELECT restaurant_key FROM fresh)
    UNION ALL SELECT restaurant_key, f.cuisine, coalesce(k.cuisine_key, -1) FROM fresh f
    LEFT JOIN (SELECT DISTINCT cuisine, cuisine_key FROM cuisines) k ON f.cuisine = k.cuisine""",
    {
        "fresh": """SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS restaurant_key, upper(p_type) AS cuisine
        FROM part WHERE p_type = 'PROMO'"""
    },
)
oracle(
    "rating_history",
    """SELECT o_custkey AS ra_key, 'google' AS source, CAST(epoch(o_orderdate) AS BIGINT) AS "timestamp",
        coalesce(max(o_totalprice) FILTER (o_orderstatus = 'F') + 1, max(o_totalprice)) AS rating
    FROM orders GROUP BY ALL""",
)
oracle(
    "opening_hours_upsert",
    """SELECT * FROM all_hours WHERE ra_key NOT IN (SELECT ra_key FROM again) UNION ALL SELECT * FROM (
        SELECT DISTINCT ra_key, day_key, open_time, close_time + 100 AS close_time FROM all_hours SEMI JOIN again USING (ra_key)
        UNION SELECT ra_key, NULL, 0, NULL FROM again)""",
    {
        "all_hours": """SELECT CAST(substr(p_brand, 7) AS BIGINT) AS ra_key, CAST(p_size % 7 AS INTEGER) AS day_key,
        CAST((8 + p_partkey % 12) * 100 AS INTEGER) AS open_time,
        CAST((12 + p_partkey % 12) * 100 + 30 AS INTEGER) AS close_time FROM part""",
        "again": "SELECT DISTINCT ra_key FROM all_hours WHERE day_key = 0",
    },
)
oracle("delete_where", "SELECT * FROM users WHERE age >= 50 OR age IS NULL")
oracle(
    "cascade_delete",
    """SELECT 'customer' AS table_name, c_custkey AS id, c_custkey AS owner FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT 'orders', o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT 'events', event_id, user_id FROM events
        WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
LATE_ORDERS = """late AS (
    SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
        round(sum(l_extendedprice), 2) AS o_totalprice, o_orderdate, 'changed' AS o_orderpriority
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 7 DAY
    GROUP BY ALL
)"""
oracle(
    "bucket_upsert",
    f"""WITH {LATE_ORDERS}
    SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM late) UNION ALL SELECT * FROM late""",
)
oracle(
    "bucket_upsert_partial",
    f"""WITH {LATE_ORDERS}
    SELECT o.* REPLACE (coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice,
        coalesce(n.o_orderpriority, o.o_orderpriority) AS o_orderpriority)
    FROM orders o LEFT JOIN late n USING (o_orderkey)
    UNION ALL SELECT * FROM late WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
oracle(
    "bucket_cascade_delete",
    """SELECT 'customer' AS table_name, c_custkey AS id, c_custkey AS owner FROM customer WHERE c_acctbal >= -900
    UNION ALL SELECT 'orders', o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)
    UNION ALL SELECT 'events', event_id, user_id FROM events
        WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)""",
)
oracle(
    "bucket_replace_groups",
    """WITH late AS (
        SELECT DISTINCT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_shipdate > o_orderdate
    )
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ANTI JOIN late USING (l_orderkey)
    UNION ALL SELECT l_orderkey, 0, round(sum(l_quantity), 2) FROM lineitem SEMI JOIN late USING (l_orderkey) GROUP BY l_orderkey""",
)
oracle(
    "bucket_append_new",
    """SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'again' END AS o_orderpriority) FROM orders""",
)
oracle(
    "mark_closed",
    """SELECT key, 'go' || key AS go_key, CASE WHEN k IS NULL THEN 0 ELSE 1 END AS closed,
        CASE WHEN k IS NOT NULL THEN '2024-03-05 10:20:30' END AS closed_time
    FROM restaurants LEFT JOIN (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events WHERE event_type = 'error') ON key = k""",
)
oracle(
    "assign_keys",
    """SELECT c_name, c_nationkey, c_custkey * 2 AS key FROM customer WHERE c_acctbal >= 0 UNION ALL
    SELECT c_name, c_nationkey, row_number() OVER (ORDER BY c_name)
        + (SELECT max(c_custkey * 2) FROM customer WHERE c_acctbal >= 0)
    FROM customer WHERE c_acctbal < 0""",
)

# Spatial join and the warehouse it feeds

oracle("spatial_inner", "SELECT place_id, ta_id, round(distance, 3) AS distance_m FROM near", VENUES)
oracle(
    "spatial_left",
    """SELECT v.place_id, ta_id, round(distance, 3) AS distance_m
    FROM venues_a v LEFT JOIN near n ON v.place_id = n.place_id""",
    VENUES,
)
oracle(
    "spatial_other_zone",
    "SELECT place_id, ta_id, round(distance, 3) AS distance_m FROM near",
    VENUES
    | {
        "points_a": utm_sql("latitude", "longitude", "venues_a", "place_id", 15),
        "points_b": utm_sql("lat", "lon", "venues_b", "ta_id", 15),
    },
)
oracle(
    "image_round_trip",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width, 1 AS height, 1 AS channels,
        CAST(list_sum(list_transform(embedding, lambda x, i:
            CAST(greatest(0, least(255, floor((x::DOUBLE + 1) * 127.5))) AS BIGINT) * i)) AS BIGINT) AS checksum
    FROM embeddings WHERE len(embedding) > 0""",
)
GLOBE = {
    f"globe_{table}": f"""
        SELECT {key}, degrees(asin(least(({key} * 7919 % 20011) / 10005.0::DOUBLE - 1, 1.0))) AS lat,
               ({key} * 104729 % 36007) / 100.0::DOUBLE - 180 AS lon FROM {table}"""
    for table, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"))
}
GREAT_CIRCLE = """2 * 6378140.0::DOUBLE * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"""
oracle(
    "globe_within_distance",
    f"""SELECT o_orderkey, c_custkey, round(d, 3) AS distance_m
    FROM (SELECT o_orderkey, c_custkey, {GREAT_CIRCLE} AS d FROM globe_orders a, globe_customer b) WHERE d < 100000""",
    GLOBE,
)
oracle(
    "globe_nearest_places",
    f"""SELECT c_custkey, place, s_suppkey, round(d, 3) AS distance_m FROM (
        SELECT c_custkey, s_suppkey, d, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS place
        FROM (SELECT c_custkey, s_suppkey, {GREAT_CIRCLE} AS d FROM globe_customer a, globe_supplier b))
    WHERE place <= 3""",
    GLOBE,
)
oracle(
    "build_restaurants",
    """SELECT key, place_id AS go_key, ta_id AS ta_key, "name" AS restaurant_name, vicinity AS address,
        round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, 'www.' || p_partkey AS website,
        p_partkey || '@mail.example' AS email, '+34 ' || p_partkey AS telephone, price, 0 AS closed
    FROM matched JOIN price_of USING (key)""",
    VENUES,
)
oracle(
    "build_cuisines",
    "SELECT restaurant_key, cuisine, CAST(dense_rank() OVER (ORDER BY cuisine) - 1 AS BIGINT) AS cuisine_key FROM cuisine_rows",
    VENUES,
)
oracle(
    "build_meals",
    "SELECT restaurant_key, meals, CAST(dense_rank() OVER (ORDER BY meals) - 1 AS BIGINT) AS meal_key FROM meal_rows",
    VENUES,
)
oracle(
    "build_ratings",
    """SELECT key AS ra_key, rating, 'google' AS source, 1709596800::BIGINT AS "timestamp" FROM matched
    WHERE NOT isnan(rating) UNION ALL SELECT key, ta_rating, 'tripadvisor', 1709596800 FROM matched""",
    VENUES,
)
oracle(
    "build_long_reviews",
    """SELECT key AS ra_key, 't_' || conv_id || '-' || turn AS review_key,
        CASE WHEN turn % 4 <> 3 THEN CAST(epoch(make_date(2020, 1, CAST(turn % 28 + 1 AS BIGINT))) AS BIGINT) END AS time,
        role AS rating, 'sample' AS sample, text, 'tripadvisor' AS source
    FROM conversations JOIN matched ON conv_id = p_partkey""",
    VENUES,
)
oracle(
    "build_michelin",
    """SELECT key AS ra_key, CASE c_custkey % 3 WHEN 0 THEN -1 WHEN 1 THEN CAST(c_custkey % 4 AS INTEGER) END AS number_of_stars
    FROM matched JOIN customer ON "name" = c_name WHERE c_custkey % 2 = 0""",
    VENUES,
)
oracle(
    "build_opening_hours",
    """SELECT key AS ra_key, p.p_size % 7 AS day_key, 900 AS open_time, 2100 AS close_time, p.p_size % 7 AS open_day
    FROM matched m JOIN part p ON m.place_id = 'p' || p.p_partkey""",
    VENUES,
)
oracle(
    "build_reviews",
    """SELECT key AS ra_key, n_chars AS time, CAST(n_chars % 5 + 1 AS VARCHAR) AS rating, NULL AS sample, text,
        'google' AS source,
        'g_' || sha256(concat_ws(chr(31), key, n_chars, n_chars % 5 + 1, text)) AS review_key
    FROM documents JOIN matched ON place_id = 'p' || (doc_id * 3)""",
    VENUES,
)


def _venues_update(first: str, later: str) -> dict[str, str]:
    """Venues built where ``first`` holds of the second source, then updated where ``later`` does."""
    return VENUES | {
        "old": f"""SELECT CAST(row_number() OVER (ORDER BY place_id, ta_id, distance) - 1 AS BIGINT) AS key,
            a.*, b.*, distance FROM near n JOIN venues_a a USING (place_id) JOIN venues_b b USING (ta_id)
            WHERE {first}""",
        "later_b": f"SELECT n.place_id AS near_place, n.distance, b.* FROM near n JOIN venues_b b USING (ta_id) WHERE {later}",
        "open_rows": """SELECT *, row_number() OVER (ORDER BY place_id, distance IS NULL, distance, ta_id) AS rn FROM (
            SELECT a.*, l.* EXCLUDE (near_place) FROM venues_a a LEFT JOIN later_b l ON a.place_id = l.near_place
            WHERE business_status <> 'CLOSED_PERMANENTLY')""",
        "stayed": """SELECT r.rn, o.key FROM open_rows r JOIN old o ON r.place_id = o.place_id AND r.ta_id = o.ta_id""",
        "free_keys": """SELECT place_id, key, row_number() OVER (PARTITION BY place_id ORDER BY key) AS nth
            FROM old WHERE key NOT IN (SELECT key FROM stayed)""",
        "open_pairs": """SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY rn) AS nth
            FROM open_rows WHERE rn NOT IN (SELECT rn FROM stayed)""",
        "moved": "SELECT o.rn, f.key FROM open_pairs o LEFT JOIN free_keys f ON o.place_id = f.place_id AND o.nth = f.nth",
        "row_keys": """SELECT rn, key FROM stayed UNION ALL SELECT rn, key FROM moved WHERE key IS NOT NULL UNION ALL
            SELECT rn, CAST(row_number() OVER (ORDER BY rn) + (SELECT max(key) FROM old) AS BIGINT) FROM moved WHERE key IS NULL""",
        "update_rows": "SELECT k.key, r.* EXCLUDE (rn) FROM open_rows r JOIN row_keys k ON r.rn = k.rn",
        "left_rows": """SELECT * FROM old WHERE key NOT IN (SELECT key FROM update_rows)
            AND place_id NOT IN (SELECT place_id FROM open_rows)""",
        "old_meals": """SELECT *, CAST(dense_rank() OVER (ORDER BY meals) - 1 AS BIGINT) AS meal_key FROM
            (SELECT key AS restaurant_key, trim(unnest(string_split(ta_meals, ','))) AS meals FROM old)""",
    }


VENUES_UPDATE = _venues_update("ta_rating < 950", "true")
VENUES_PARTNERS = _venues_update("ta_rating < 950", "ta_rating >= 300")
RESTAURANT = """key, place_id AS go_key, ta_id AS ta_key, "name" AS restaurant_name, vicinity AS address, latitude, longitude,
    'www.' || p_partkey AS website, p_partkey || '@mail.example' AS email, '+34 ' || p_partkey AS telephone,
    CASE WHEN NOT isnan(price_level) THEN price_level ELSE CAST(ta_level AS DOUBLE) END AS price"""
UPDATED_RESTAURANTS = f"""SELECT {RESTAURANT}, 0 AS closed, CAST(NULL AS VARCHAR) AS closed_time FROM update_rows
    UNION ALL SELECT {RESTAURANT}, CASE WHEN business_status = 'CLOSED_PERMANENTLY' THEN 1 ELSE 0 END,
        CASE WHEN business_status = 'CLOSED_PERMANENTLY' THEN '2024-03-06 00:00:00' END FROM left_rows"""
UPDATED_MEALS = """SELECT restaurant_key, meals, meal_key FROM old_meals
        WHERE restaurant_key IN (SELECT key FROM left_rows)
    UNION ALL SELECT n.restaurant_key, n.meals, coalesce(k.meal_key, -1)
    FROM (SELECT key AS restaurant_key, trim(unnest(string_split(ta_meals, ','))) AS meals FROM update_rows) n
    LEFT JOIN (SELECT DISTINCT meals, meal_key FROM old_meals) k ON n.meals = k.meals"""
oracle("update_restaurants", UPDATED_RESTAURANTS, VENUES_UPDATE)
oracle("update_partners", UPDATED_RESTAURANTS, VENUES_PARTNERS)
oracle(
    "update_ratings",
    """SELECT key AS ra_key, rating, 'google' AS source, 1709596800::BIGINT AS "timestamp" FROM old WHERE NOT isnan(rating)
    UNION ALL SELECT key, ta_rating, 'tripadvisor', 1709596800 FROM old
    UNION ALL SELECT key, rating, 'google', 1709683200 FROM update_rows WHERE NOT isnan(rating)
    UNION ALL SELECT key, ta_rating, 'tripadvisor', 1709683200 FROM update_rows WHERE ta_rating IS NOT NULL""",
    VENUES_UPDATE,
)
oracle("update_meals", UPDATED_MEALS, VENUES_UPDATE)
oracle("update_partner_meals", UPDATED_MEALS, VENUES_PARTNERS)
oracle("job_update_restaurants", UPDATED_RESTAURANTS, VENUES_UPDATE)
oracle(
    "job_update_ratings",
    """SELECT key AS ra_key, rating, 'google' AS source, 1709596800::BIGINT AS "timestamp" FROM old WHERE NOT isnan(rating)
    UNION ALL SELECT key, ta_rating, 'tripadvisor', 1709596800 FROM old
    UNION ALL SELECT key, rating, 'google', 1709683200 FROM update_rows WHERE NOT isnan(rating)
    UNION ALL SELECT key, ta_rating, 'tripadvisor', 1709683200 FROM update_rows WHERE ta_rating IS NOT NULL""",
    VENUES_UPDATE,
)
oracle(
    "job_details_reviews",
    """SELECT DISTINCT key AS ra_key, n_chars AS time, CAST(n_chars % 5 + 1 AS VARCHAR) AS rating, NULL AS sample, text,
        'google' AS source,
        'g_' || sha256(concat_ws(chr(31), key, n_chars, n_chars % 5 + 1, text)) AS review_key
    FROM documents JOIN matched ON place_id = 'p' || (doc_id * 3)""",
    VENUES,
)
oracle(
    "job_details_hours",
    """SELECT DISTINCT key AS ra_key, p.p_size % 7 AS day_key, 900 AS open_time, 2100 AS close_time
    FROM matched m JOIN part p ON m.place_id = 'p' || p.p_partkey""",
    VENUES,
)
oracle(
    "job_landed_hours",
    """SELECT DISTINCT key AS ra_key, p.p_partkey % 7 AS day_key, 900 AS open_time, 2100 AS close_time
    FROM matched m JOIN part p ON m.place_id = 'p' || p.p_size""",
    VENUES,
)
oracle(
    "job_images",
    """SELECT DISTINCT sha256(image_file || chr(31) || key) AS image_id, key AS ra_key, image_file, source
    FROM catalog JOIN restaurants ON google_key = 'go' || key""",
    CATALOG,
)
oracle(
    "job_delete",
    """SELECT table_name, key, count(*)::BIGINT AS "rows" FROM (
        SELECT 'restaurants' AS table_name, key FROM live
        UNION ALL SELECT 'meals', restaurant_key FROM (SELECT restaurant_key FROM old_meals WHERE restaurant_key IN (SELECT key FROM left_rows)
            UNION ALL SELECT key, FROM (SELECT key, unnest(string_split(ta_meals, ',')) FROM update_rows)) WHERE restaurant_key IN (SELECT key FROM live)
        UNION ALL SELECT 'cuisines', key FROM (SELECT key, unnest(string_split(p_name, ' ')) FROM update_rows
            UNION ALL SELECT key, unnest(string_split(p_name, ' ')) FROM left_rows) WHERE key IN (SELECT key FROM live)
        UNION ALL SELECT 'rating', key FROM (SELECT key FROM old WHERE NOT isnan(rating) UNION ALL SELECT key FROM old
            UNION ALL SELECT key FROM update_rows WHERE NOT isnan(rating)
            UNION ALL SELECT key FROM update_rows WHERE ta_rating IS NOT NULL) WHERE key IN (SELECT key FROM live)
    ) GROUP BY ALL""",
    VENUES_UPDATE
    | {
        "live": """SELECT key FROM update_rows UNION ALL
            SELECT key FROM left_rows WHERE business_status IS DISTINCT FROM 'CLOSED_PERMANENTLY'"""
    },
)
oracle(
    "delete_closed",
    """SELECT 'restaurants' AS kind, key AS restaurant_key, place_id AS "value", NULL::DOUBLE AS rating FROM open_now
    UNION ALL SELECT 'cuisines', restaurant_key, cuisine, NULL FROM cuisine_rows JOIN open_now ON key = restaurant_key
    UNION ALL SELECT 'meals', restaurant_key, meals, NULL FROM meal_rows JOIN open_now ON key = restaurant_key
    UNION ALL SELECT 'rating', key, 'google', rating FROM open_now WHERE NOT isnan(rating)
    UNION ALL SELECT 'rating', key, 'tripadvisor', ta_rating FROM open_now""",
    VENUES | {"open_now": "SELECT * FROM matched WHERE business_status IS DISTINCT FROM 'CLOSED_PERMANENTLY'"},
)

# Graph

BRAND = "CAST(substr(p_brand, 7) AS BIGINT)"
GRAPH = {
    "restaurant_ids": "SELECT key FROM restaurants WHERE key % 7 <> 0",
    "user_ids": "SELECT c_custkey AS id FROM customer WHERE c_mktsegment <> 'FURNITURE'",
    "edges": f"""
        SELECT 'UPLOADED' AS type, 'User' AS src_label, p_size::VARCHAR AS src, 'Images' AS dst_label,
            p_partkey::VARCHAR AS dst, NULL::INTEGER AS swipeLeft FROM part
        UNION ALL SELECT 'HAS_IMAGE', 'Restaurant', {BRAND}::VARCHAR, 'Images', p_partkey::VARCHAR, NULL
            FROM part WHERE {BRAND} IN (SELECT key FROM restaurant_ids)
        UNION ALL SELECT 'EX_BELONGS_TO', 'Images_ex', p_partkey::VARCHAR, 'Restaurant', {BRAND}::VARCHAR, NULL
            FROM part WHERE {BRAND} IN (SELECT key FROM restaurant_ids)
        UNION ALL SELECT 'ON_MENU', 'Dishes', p_partkey::VARCHAR, 'Restaurant', {BRAND}::VARCHAR, NULL FROM part
        UNION ALL SELECT 'HAS_CUISINES', 'Restaurant', restaurant_key::VARCHAR, 'Cuisines', cuisine_key::VARCHAR, NULL
            FROM cuisines
        UNION ALL SELECT 'OFFERS_MEALS', 'Restaurant', {BRAND}::VARCHAR, 'Meals', p_size::VARCHAR, NULL FROM part
        UNION ALL SELECT 'SWIPED', 'User', userId::VARCHAR, 'Images', imageId::VARCHAR, swipeLeft FROM swipes""",
    "projected": """
        SELECT type, src_label || ':' || src AS src, dst_label || ':' || dst AS dst, swipeLeft FROM edges
            WHERE type IN ('HAS_CUISINES', 'SWIPED', 'HAS_IMAGE')
        UNION ALL SELECT type, dst_label || ':' || dst, src_label || ':' || src, swipeLeft FROM edges
            WHERE type IN ('HAS_CUISINES', 'SWIPED', 'HAS_IMAGE')""",
    "liked": "SELECT * FROM projected WHERE type <> 'SWIPED' OR swipeLeft = 0",
    "graph_node": f"""
        SELECT 'Restaurant' AS label, key::VARCHAR AS id FROM restaurants
        UNION SELECT 'Images', p_partkey::VARCHAR FROM part UNION SELECT 'Images_ex', p_partkey::VARCHAR FROM part
        UNION SELECT 'Images', imageId::VARCHAR FROM swipes
        UNION SELECT 'Dishes', p_partkey::VARCHAR FROM part
        UNION SELECT 'User', id::VARCHAR FROM user_ids UNION SELECT 'User', p_size::VARCHAR FROM part
        UNION SELECT 'User', userId::VARCHAR FROM swipes
        UNION SELECT 'Cuisines', cuisine_key::VARCHAR FROM cuisines UNION SELECT 'Meals', p_size::VARCHAR FROM part
        UNION SELECT 'Michelin', {BRAND}::VARCHAR FROM part
        UNION SELECT 'Weekday', d::VARCHAR FROM range(7) t(d) WHERE d <> 2
        UNION SELECT 'Opening_hours', {BRAND} || ':' || (p_size % 7) FROM part""",
}
oracle("graph_nodes", "SELECT label, id FROM graph_node", GRAPH)
oracle("graph_written", "SELECT label, id FROM graph_node", GRAPH)
oracle("graph_node_lookup", "SELECT label, id FROM graph_node WHERE label = 'User' AND id = '8'", GRAPH)
oracle(
    "graph_node_properties",
    """SELECT cuisine_key::VARCHAR AS id, cuisine_key, max(restaurant_key) AS restaurant_key, any_value(cuisine) AS cuisine
    FROM cuisines GROUP BY cuisine_key""",
)
oracle(
    "graph_edges_bag",
    "SELECT type, src_label, src, dst_label, dst, swipeLeft, count(*) AS edges FROM edges GROUP BY ALL", GRAPH,
)
SET_EDGES = f"""SELECT 'OPENING_HOURS' AS type, 'Restaurant' AS src_label, ra_key::VARCHAR AS src, 'Weekday' AS dst_label,
        day_key::VARCHAR AS dst, open_time, close_time, NULL::INTEGER AS number_of_stars
    FROM (SELECT {BRAND} AS ra_key, p_size % 7 AS day_key, CAST((8 + p_partkey % 12) * 100 AS INTEGER) AS open_time,
            CAST((12 + p_partkey % 12) * 100 + 30 AS INTEGER) AS close_time,
            row_number() OVER (PARTITION BY p_brand, p_size % 7 ORDER BY p_partkey % 12 DESC) AS n FROM part)
    WHERE n = 1 AND day_key <> 2
    UNION ALL SELECT 'HAS_MICHELIN', 'Restaurant', {BRAND}::VARCHAR, 'Restaurant', {BRAND}::VARCHAR, NULL, NULL,
        max(p_size % 4) FROM part GROUP BY p_brand"""
oracle(
    "graph_edges_written",
    f"""SELECT type, src_label, src, dst_label, dst, swipeLeft, NULL::INTEGER AS open_time, NULL::INTEGER AS close_time,
        NULL::INTEGER AS number_of_stars, count(*) AS edges FROM edges GROUP BY ALL
    UNION ALL SELECT type, src_label, src, dst_label, dst, NULL, open_time, close_time, number_of_stars, 1 FROM ({SET_EDGES})""",
    GRAPH,
)
oracle(
    "graph_edges_set",
    SET_EDGES,
    GRAPH,
)
oracle(
    "graph_projection",
    """SELECT type, src, dst, CAST(count(*) AS DOUBLE) AS weight, CAST(sum(swipeLeft) AS BIGINT) AS "left"
    FROM projected GROUP BY ALL""",
    GRAPH,
)
oracle("graph_likes", "SELECT type, src, dst, 1.0::DOUBLE AS weight FROM liked", GRAPH)
oracle(
    "graph_likes_every_type", "SELECT type, src, dst, 1.0::DOUBLE AS weight FROM projected WHERE swipeLeft = 0", GRAPH
)


def embedding_parts(dimensions: int = 256, rounds: tuple[float, ...] = (0.0, 1.0, 1.0), seed: int = 42) -> dict[str, str]:
    """Random rows from digests, then weighted neighbour means, as one row per node and dimension."""
    parts = GRAPH | {
        "members": """SELECT label || ':' || id AS node FROM graph_node
            WHERE label IN ('User', 'Images', 'Restaurant', 'Cuisines')""",
        "links": "SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight FROM liked GROUP BY ALL",
        "digests": f"""SELECT node, block, md5(node || ':' || block || ':{seed}') AS digest
            FROM members, range({dimensions // 16}) t(block)""",
        "bytes": """SELECT node, block * 16 + i AS d, ('0x' || substr(digest, 2 * i + 1, 2))::INTEGER AS b
            FROM digests, range(16) t(i)""",
        "round0": """SELECT node, d, CASE WHEN b < 43 THEN 1.0::DOUBLE WHEN b >= 213 THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END
            AS v FROM bytes""",
    }
    for n, _ in enumerate(rounds, start=1):
        parts[f"round{n}"] = f"""SELECT dst AS node, d, sum(weight * v) / sum(weight) AS v
            FROM links JOIN round{n - 1} r ON src = r.node GROUP BY dst, d"""
        parts[f"unit{n}"] = f"""SELECT node, d, v / nullif(sqrt(sum(v * v) OVER (PARTITION BY node)), 0) AS v
            FROM round{n}"""
    weighted = [f"SELECT node, d, {w} * v AS v FROM unit{n}" for n, w in enumerate(rounds, start=1) if w]
    parts["vectors"] = f"SELECT node, d, sum(v) AS v FROM ({' UNION ALL '.join(weighted)}) GROUP BY node, d"
    return parts


EMBEDDING = embedding_parts()
oracle(
    "fastrp",
    """SELECT node, CAST(d AS INTEGER) AS dimension, round(v::FLOAT::DOUBLE, 4) AS value FROM vectors
    WHERE round(v::FLOAT::DOUBLE, 4) <> 0""",
    EMBEDDING,
)
KNN = """SELECT id, neighbor, cosine FROM (SELECT a.vec_id AS id, b.vec_id AS neighbor,
            round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine,
            row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.embedding::DOUBLE[],
                b.embedding::DOUBLE[]), 6) DESC, b.vec_id) AS n
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE n <= 10"""
oracle("knn_exact", KNN)
oracle("knn_many_cells", KNN)
oracle(
    "similar_restaurants",
    """SELECT src, dst, round((1 + cosine) / 2, 4) AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY src ORDER BY cosine DESC, dst) AS n FROM (
            SELECT substr(a.node, 12) AS src, substr(b.node, 12) AS dst,
                round(sum(a.v * b.v) / sqrt(sum(a.v * a.v) * sum(b.v * b.v)), 6) AS cosine
            FROM vectors a JOIN vectors b ON a.d = b.d AND a.node <> b.node
            WHERE a.node LIKE 'Restaurant:%' AND b.node LIKE 'Restaurant:%' GROUP BY ALL)) WHERE n <= 10""",
    EMBEDDING,
)

# Recommendation

RECOMMEND = {
    "placed": """SELECT userId, restaurantId, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, s.id DESC) AS n
        FROM swipes s JOIN images i ON s.imageId = i.id WHERE swipeLeft = 0""",
    "recent": "SELECT userId, restaurantId FROM placed WHERE n <= 5",
    "alike": f"""SELECT src, dst, round(max(p_partkey % 997) / 997, 6) AS score
        FROM (SELECT {BRAND} AS src, CAST(p_size % 25 + 1 AS BIGINT) AS dst, p_partkey FROM part)
        WHERE src <> dst GROUP BY src, dst""",
    "open_now": f"""SELECT DISTINCT key AS restaurantId, latitude, longitude FROM restaurants
        JOIN part ON key = {BRAND} AND p_size % 7 = 3
            AND (8 + p_partkey % 12) * 100 <= 1215 AND (12 + p_partkey % 12) * 100 + 30 >= 1215""",
    "places_of": """SELECT c_custkey AS userId, 41.3::DOUBLE + c_custkey % 80 * 0.001::DOUBLE AS lat,
        2.1::DOUBLE + c_custkey % 70 * 0.001::DOUBLE AS lon FROM customer""",
    "reached": """SELECT r.userId, dst AS restaurantId, score
        FROM (SELECT DISTINCT userId, restaurantId FROM recent) r JOIN alike ON r.restaurantId = src
        WHERE NOT EXISTS (SELECT 1 FROM recent x WHERE x.userId = r.userId AND x.restaurantId = dst)""",
}


def choice(candidates: str, places: str) -> str:
    metres = """2 * 6378140.0::DOUBLE * asin(least(1.0, sqrt(pow(sin(radians(lat - latitude) / 2), 2)
        + cos(radians(latitude)) * cos(radians(lat)) * pow(sin(radians(lon - longitude) / 2), 2))))"""
    return f"""SELECT userId, restaurantId, score, round(distance, 2) AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, distance, restaurantId) AS m FROM (
            SELECT *, row_number() OVER (PARTITION BY userId ORDER BY distance, score DESC, restaurantId) AS n FROM (
                SELECT c.userId, c.restaurantId, score, {metres} AS distance
                FROM ({candidates}) c JOIN open_now o ON c.restaurantId = o.restaurantId
                JOIN ({places}) p ON c.userId = p.userId)) WHERE n <= 3) WHERE m = 1"""


ONE_PLACE = "SELECT 7 AS userId, 41.35::DOUBLE AS lat, 2.15::DOUBLE AS lon"
oracle("recent_restaurants", "SELECT userId, restaurantId, count(*) AS likes FROM recent GROUP BY ALL", RECOMMEND)
oracle(
    "open_places",
    "SELECT restaurantId, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM open_now", RECOMMEND,
)
oracle("recommend_batch", choice("SELECT * FROM reached", "SELECT * FROM places_of"), RECOMMEND)
oracle("recommend_single", choice("SELECT * FROM reached WHERE userId = 7", ONE_PLACE), RECOMMEND)
oracle(
    "recommend_from_any",
    choice(
        """SELECT 7 AS userId, dst AS restaurantId, score FROM alike
        WHERE dst NOT IN (SELECT restaurantId FROM recent WHERE userId = 7)""",
        ONE_PLACE,
    ),
    RECOMMEND,
)
LIKED = {
    "shares": """SELECT restaurantId, imageId, count(*) AS swipes, count(*) FILTER (swipeLeft = 0) AS likes,
        count(*) FILTER (swipeLeft = 0) / count(*) AS ratio FROM history s JOIN images i ON s.imageId = i.id GROUP BY 1, 2""",
    "best": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY restaurantId ORDER BY ratio DESC, imageId) AS place
        FROM shares WHERE likes > 0) WHERE place <= 5""",
}
oracle("liked_images", "SELECT restaurantId, imageId, swipes, likes, round(ratio, 6) AS ratio, place FROM best", LIKED)
oracle(
    "image_pick",
    """SELECT restaurantId, imageId FROM (SELECT *, row_number() OVER (PARTITION BY restaurantId
        ORDER BY md5(imageId || ':42'), imageId) AS n FROM best) WHERE n = 1""",
    LIKED,
)
