"""Column lists and fixed values of the data model."""

from __future__ import annotations

# The data model shared with existing warehouses.
SOURCE_A = "google"
SOURCE_B = "tripadvisor"
SOURCE_B_PREFIX = "ta_"
CLOSED_STATUS = "CLOSED_PERMANENTLY"
UNKNOWN_KEY = -1
MATCH_RADIUS_M = 7.0
SOURCE_B_KEY_PATTERN = r"g(\d+)-d(\d+)"
IMAGE_NAME_PATTERN = r"(.+)_\d+\.jpg"
FILE_KEY_PREFIX_LENGTH = 2
PRICE_LEVELS = {"$": 2, "$$ - $$$": 3, "$$$$": 4}
AWARD_WITHOUT_STAR = "Bib Gourmand"
AWARD_WITHOUT_STAR_VALUE = -1
REVIEW_DATE_FORMAT = "MMMM d, yyyy"
BIRTHDATE_FORMAT = "yyyy-M-d"
MONTH_FORMAT = "yyyy-MM"
AGE_BUCKET_YEARS = 5
LAST_AGE_BUCKET = 19
NUMBER_SUFFIXES = ["", " K", " M", " B", " T"]
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
EMBEDDING_DIMENSIONS = 256
EMBEDDING_SEED = 42

VENUE_A_DDL = (
    "name string, place_id string, business_status string, price_level double, rating double, "
    "user_ratings_total int, vicinity string, latitude double, longitude double"
)
VENUE_A_NESTED = {"geometry.location.lat": "latitude", "geometry.location.lng": "longitude"}

DETAILS_DDL = "google_key string, reviews string, opening_periods string"
DETAILS_NESTED = {"opening_hours.periods": "opening_periods"}

REVIEW_RECORDS_DDL = "array<struct<rating:int,text:string,time:bigint>>"
HOURS_RECORDS_DDL = (
    "array<struct<close:struct<day:int,time:string>,open:struct<day:int,time:string>>>"
)

RESTAURANT_COLUMNS = [
    "key", "go_key", "ta_key", "restaurant_name", "address", "latitude", "longitude",
    "website", "email", "telephone", "price", "closed", "closed_time",
]
REVIEW_COLUMNS = ["ra_key", "review_key", "time", "rating", "sample", "text", "source"]
PERSONAL_COLUMNS = [
    "id", "username", "name", "address", "mail", "birthdate", "phone", "homeLat", "homeLng",
]
USER_COLUMNS = [
    "id", "sex", "createDate", "interestedCuisines", "nationality", "occupation",
    "city", "zipcode", "age",
]

# Tables that hang on a restaurant, with the column holding its key.
RESTAURANT_CHILDREN = {
    "cuisines": "restaurant_key",
    "meals": "restaurant_key",
    "long_review": "ra_key",
    "opening_hours": "ra_key",
    "images_external": "ra_key",
    "michelin": "ra_key",
    "rating": "ra_key",
}

# Array columns to normalise: table -> (array column, bridge table).
ARRAY_COLUMNS = {
    "dishes": ("ingredients", "ingredients_in_dish"),
    "images": ("tags", "image_tags"),
    "users": ("interestedCuisines", "user_cuisines"),
}
SINGULAR = {
    "dishes": "dish",
    "images": "image",
    "users": "user",
    "ingredients": "ingredient",
    "tags": "tag",
    "interestedCuisines": "interestedCuisine",
}
