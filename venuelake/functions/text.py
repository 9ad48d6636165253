"""Text cleaning: keys in text, price and award levels, record lists, compact numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuelake import schemas

JSON_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowUnquotedControlChars": "true",
}

# Character codes of such literals that JSON writes differently. The second
# are the tag characters of flag symbols, the only usual ones beyond four digits.
_LITERAL_CODES = [
    (r"\\x", "([0-9a-f]{2})", r"\\u00$2"),
    (r"\\U000e00", "([0-9a-f]{2})", r"\\udb40\\udc$2"),
]

# A whole quoted string, either quote, with backslash escapes.
_STRINGS = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""


def replace_outside_quotes(text: Column, first: str, token: str, replacement: str) -> Column:
    """Replace a token outside quoted strings; ``first`` lists the characters it may start with.

    Each match starts where the last one ended and steps over whole strings, so the
    cost is one pass over the text and values are never touched. Text whose quotes do
    not pair up is left as it is.
    """
    pattern = rf"(?s)\G((?:[^'\"{first}]++|{_STRINGS}|(?!{token})[{first}])*+){token}"
    return F.regexp_replace(text, pattern, "$1" + replacement)


def repair_records(text: Column) -> Column:
    """Record-list text (``None``/``True``/``False``, line breaks between records) to JSON.

    All three words become null: no column that is read from such text is a boolean.
    """
    for code, digits, json_code in _LITERAL_CODES:
        found = F.regexp_replace(text, rf"(?<!\\)((?:\\\\)*){code}{digits}", "$1" + json_code)
        text = F.when(text.rlike(code), found).otherwise(text)
    text = replace_outside_quotes(text, "NTF", r"(?:None|True|False)\b", "null")
    return replace_outside_quotes(text, r"\}", r"\}\s*\n\s*(?=\{)", "},")


def parse_records(text: Column, ddl: str) -> Column:
    """Record-list text to an array of structs; null when it cannot be read."""
    return F.from_json(repair_records(text), ddl, JSON_OPTIONS)


def parse_unescaped_reviews(text: Column) -> Column:
    """Review records whose text holds the quote that delimits it.

    Such text is no literal any more, but rating, time and the text (up to the quote
    before the next key or the end of its record) can still be told apart. Null unless
    every record yields all three.
    """
    body = F.regexp_replace(F.trim(text), r"^\[|\]$", "")
    records = F.split(body, r"(?<=\})\s*,?\s*\n\s*(?=\{)")

    def fields(record: Column) -> Column:
        rating = F.regexp_extract(record, r"""['"]rating['"]\s*:\s*(\d+)""", 1)
        time = F.regexp_extract(record, r"""['"]time['"]\s*:\s*(\d+)""", 1)
        value = F.regexp_extract(
            record, r"""(?s)['"]text['"]\s*:\s*(['"])(.*?)\1\s*(?:,\s*['"]\w+['"]\s*:|\}\s*$)""", 2
        )
        return F.when(
            record.rlike(r"(?s)^\s*\{.*\}\s*$") & (rating != "") & (time != "") & (value != ""),
            F.struct(
                rating.try_cast("int").alias("rating"),
                value.alias("text"),
                time.try_cast("bigint").alias("time"),
            ),
        )

    parsed = F.transform(records, fields)
    return F.when(F.forall(parsed, lambda r: r.isNotNull()), parsed)


def parse_reviews(text: Column) -> Column:
    """Reviews text to ``array<struct<rating,text,time>>``; null for null or broken text."""
    return F.coalesce(
        parse_records(text, schemas.REVIEW_RECORDS_DDL), parse_unescaped_reviews(text)
    )


def parse_hours(text: Column) -> Column:
    """Opening-periods text to an array of close/open structs; null for null or broken text."""
    return parse_records(text, schemas.HOURS_RECORDS_DDL)


def split_values(text: Column, separator: str = ",") -> Column:
    """Separated list in text to an array of trimmed values."""
    return F.transform(F.split(text, separator), lambda value: F.trim(value))


def price_level(text: Column) -> Column:
    """Price text to a level; null for any other text."""
    level = F.lit(None).cast("int")
    for symbol, value in schemas.PRICE_LEVELS.items():
        level = F.when(text == symbol, value).otherwise(level)
    return level


def award_stars(text: Column) -> Column:
    """Award text to a number of stars; null when it names none."""
    digits = F.regexp_extract(text, r"(\d+)", 1).try_cast("int")
    return F.when(
        text == schemas.AWARD_WITHOUT_STAR, schemas.AWARD_WITHOUT_STAR_VALUE
    ).otherwise(digits)


def key_from_url(url: Column, pattern: str = schemas.SOURCE_B_KEY_PATTERN) -> Column:
    """The part of a URL that matches the key pattern, or an empty string."""
    return F.regexp_extract(url, pattern, 0)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def key_from_image_name(path: Column) -> Column:
    """``<prefix><key>_<n>.jpg`` to key; null for a name of another form."""
    found = F.regexp_extract(file_name(path), schemas.IMAGE_NAME_PATTERN, 1)
    return F.when(found != "", strip_prefix(found))


def strip_prefix(text: Column, length: int = schemas.FILE_KEY_PREFIX_LENGTH) -> Column:
    return F.substr(text, F.lit(length + 1))


def address_part(address: Column, part: int) -> Column:
    """City (part 0) or postcode (part 1) from the second line of an address, else null."""
    line = F.get(F.split(address, "\n"), F.lit(1))
    return F.get(F.split(line, ", "), F.lit(part))


def column_name(label: Column) -> Column:
    """A display label as a column name."""
    return F.replace(F.lower(label), F.lit(" "), F.lit("_"))


def compact_number(value: Column) -> Column:
    """``12 K`` style text without decimals, rounded half to even; NaN gives empty text."""
    value = value.cast("double")
    last = len(schemas.NUMBER_SUFFIXES) - 1
    power = F.when(value == 0, 0.0).otherwise(F.floor(F.log10(F.abs(value)) / 3))
    index = F.greatest(F.lit(0), F.least(F.lit(last), power.cast("int")))
    scaled = value / F.pow(F.lit(10.0), F.lit(3) * index)
    suffix = reduce(
        lambda rest, i: F.when(index == i, schemas.NUMBER_SUFFIXES[i]).otherwise(rest),
        range(last, -1, -1),
        F.lit(""),
    )
    digits = F.format_string("%.0f", F.bround(F.abs(scaled), 0))
    sign = F.when(value < 0, "-").otherwise("")
    return F.when(F.isnan(value), "").when(value.isNotNull(), F.concat(sign, digits, suffix))
