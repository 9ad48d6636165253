"""The property graph as node and edge tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.operators.skew import skew_join

BAG, SET = "bag", "set"

# Label -> [(table, key columns, property columns)].
NODES: dict[str, list[tuple[str, list[str], list[str]]]] = {
    "Michelin": [("michelin", ["ra_key"], ["number_of_stars", "year"])],
    "Restaurant": [
        ("restaurants", ["key"], [
            "restaurant_name", "address", "latitude", "longitude", "website", "email",
            "telephone", "ta_key", "go_key", "closed",
        ])
    ],
    "Images": [("images", ["id"], ["file", "dishId", "uploaderId", "uploadDt"])],
    "Images_ex": [("images_external", ["image_id"], ["ra_key", "image_file", "source"])],
    "Cuisines": [("cuisines", ["cuisine_key"], ["restaurant_key", "cuisine"])],
    "Review": [
        ("long_review", ["review_key"], ["time", "rating", "ra_key", "sample", "text", "source"]),
        ("reviews", ["id"], ["userId", "dishId", "rating", "timestamp", "text"]),
    ],
    "User": [("users", ["id"], ["sex", "createDate", "nationality", "occupation"])],
    "Weekday": [("weekday", ["day_key"], ["weekday"])],
    "Dishes": [("dishes", ["id"], ["name", "description", "restaurantId"])],
    "Ingredients": [("ingredients", ["id"], ["ingredient"])],
    "Tags": [("tags", ["id"], ["tag"])],
    "Opening_hours": [("opening_hours", ["ra_key", "day_key"], ["open_time", "close_time"])],
    "interestedCuisines": [("interestedCuisines", ["id"], ["interestedCuisine"])],
    "Meals": [("meals", ["meal_key"], ["restaurant_key", "meals"])],
}


@dataclass(frozen=True)
class EdgeType:
    """Where the edges of a type come from, and which of their ends must already exist."""

    table: str
    source: tuple[str, str]
    target: tuple[str, str]
    properties: list[str] = field(default_factory=list)
    kind: str = BAG
    source_must_exist: bool = False
    target_must_exist: bool = False


# Fixed values, in load order: an end created by one type exists for the next.
EDGES: dict[str, EdgeType] = {
    "INTERESTED_IN": EdgeType("user_cuisines", ("User", "userId"), ("interestedCuisines", "interestedCuisineId")),
    "UPLOADED": EdgeType("images", ("User", "uploaderId"), ("Images", "id")),
    "IS_LOCATED": EdgeType("locations", ("User", "userId"), ("Locations", "id")),
    "HAS_IMAGE": EdgeType("images", ("Restaurant", "restaurantId"), ("Images", "id"), source_must_exist=True),
    "EX_BELONGS_TO": EdgeType(
        "images_external", ("Images_ex", "image_id"), ("Restaurant", "ra_key"), target_must_exist=True
    ),
    "HAS_TAG": EdgeType("image_tags", ("Images", "imageId"), ("Tags", "tagId")),
    "WROTE": EdgeType("reviews", ("User", "userId"), ("Review", "id")),
    "ON_MENU": EdgeType("dishes", ("Dishes", "id"), ("Restaurant", "restaurantId")),
    "MADE_OF": EdgeType("ingredients_in_dish", ("Dishes", "dishId"), ("Ingredients", "ingredientId")),
    "HAS_CUISINES": EdgeType("cuisines", ("Restaurant", "restaurant_key"), ("Cuisines", "cuisine_key")),
    "OFFERS_MEALS": EdgeType(
        "meals", ("Restaurant", "restaurant_key"), ("Meals", "meal_key"), target_must_exist=True
    ),
    "OPENING_HOURS": EdgeType(
        "opening_hours", ("Restaurant", "ra_key"), ("Weekday", "day_key"), ["open_time", "close_time"],
        SET, True, True,
    ),
    "HAS_MICHELIN": EdgeType(
        "michelin", ("Restaurant", "ra_key"), ("Restaurant", "ra_key"), ["number_of_stars", "year"],
        SET, True, True,
    ),
    "SWIPED": EdgeType("swipes", ("User", "userId"), ("Images", "imageId"), ["timestamp", "swipeLeft"]),
}

PROJECTED_LABELS = ["User", "Images", "Restaurant", "Cuisines"]
PROJECTED_TYPES = ["HAS_CUISINES", "SWIPED", "HAS_IMAGE"]


def node_id(*keys: str | Column) -> Column:
    return F.concat_ws(":", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])


def node_rows(df: DataFrame, keys: list[str], properties: list[str]) -> DataFrame:
    """One row per key with the properties of one row of ``df``: the largest ones.

    Loading row by row lets the last row win; tables have no last row, so the winner is
    the row that sorts last by its properties. Rows with a null in the key make no node.
    """
    whole = df.dropna(subset=keys)
    return (
        whole.groupBy(*keys).agg(F.max(F.struct(*properties)).alias("_row"))
        .select(*keys, *[F.col("_row").getField(p).alias(p) for p in properties])
    )


def node_tables(tables: dict[str, DataFrame]) -> dict[str, list[DataFrame]]:
    """The node tables of each label whose source tables are given; first column ``id``."""
    out: dict[str, list[DataFrame]] = {}
    for label, sources in NODES.items():
        for name, keys, properties in sources:
            if name in tables:
                rows = node_rows(tables[name], keys, properties)
                drop = ["id"] if keys == ["id"] else []
                out.setdefault(label, []).append(
                    rows.select(node_id(*keys).alias("id"), *[c for c in rows.columns if c not in drop])
                )
    return out


def node_lookup(nodes: DataFrame, label: str, key: int | str) -> DataFrame:
    """The node of a label with a key."""
    return nodes.where((F.col("label") == label) & (F.col("id") == str(key)))


def edge_rows(df: DataFrame, edge: EdgeType) -> DataFrame:
    """``(src, dst, properties…)``; a set keeps one row per pair, the largest properties."""
    rows = df.select(
        node_id(edge.source[1]).alias("src"), node_id(edge.target[1]).alias("dst"), *edge.properties
    ).where(F.col(edge.source[1]).isNotNull() & F.col(edge.target[1]).isNotNull())
    if edge.kind == BAG:
        return rows
    return (
        rows.groupBy("src", "dst").agg(F.max(F.struct(*edge.properties)).alias("_row"))
        .select("src", "dst", *[F.col("_row").getField(p).alias(p) for p in edge.properties])
    )


def build_graph(tables: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``(nodes (label, id), edges by type)`` with the existence rules of each edge type.

    Ends that need not exist become nodes without properties.
    """
    known = {
        label: _union([part.select("id") for part in parts]) for label, parts in node_tables(tables).items()
    }
    edges: dict[str, DataFrame] = {}
    for name, edge in EDGES.items():
        if edge.table not in tables:
            continue
        rows = edge_rows(tables[edge.table], edge)
        for (label, _), column, required in (
            (edge.source, "src", edge.source_must_exist),
            (edge.target, "dst", edge.target_must_exist),
        ):
            if required:
                ids = known[label].distinct().withColumnRenamed("id", column)
                # A set has few rows per end by now; a bag may have very many.
                join = skew_join if edge.kind == BAG else DataFrame.join
                rows = join(rows, ids, [column], "left_semi")
        edges[name] = rows.select("src", "dst", *edge.properties)
        for (label, _), column, required in (
            (edge.source, "src", edge.source_must_exist),
            (edge.target, "dst", edge.target_must_exist),
        ):
            if not required:
                ends = rows.select(F.col(column).alias("id")).distinct()
                known[label] = known[label].unionByName(ends) if label in known else ends
    nodes = _union([ids.distinct().select(F.lit(label).alias("label"), "id") for label, ids in known.items()])
    return nodes, edges


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def edge_view(edges: dict[str, DataFrame]) -> DataFrame:
    """All edges in one table; properties a type lacks are null."""
    out = None
    for name, df in edges.items():
        edge = EDGES[name]
        rows = df.select(
            F.lit(name).alias("type"), F.lit(edge.source[0]).alias("src_label"), "src",
            F.lit(edge.target[0]).alias("dst_label"), "dst", *edge.properties,
        )
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def projection_nodes(nodes: DataFrame, labels: list[str] = PROJECTED_LABELS) -> DataFrame:
    return nodes.where(F.col("label").isin(labels)).select("label", node_id("label", "id").alias("node"))


def projection(edges: DataFrame, types: list[str] = PROJECTED_TYPES, weight: float = 1.0) -> DataFrame:
    """Undirected weighted edges: each once in either direction, ``(type, src, dst, weight, swipeLeft)``."""
    has_weight = "weight" in edges.columns
    value = F.coalesce(F.col("weight"), F.lit(weight)) if has_weight else F.lit(weight)
    a, b = node_id("src_label", "src"), node_id("dst_label", "dst")
    ends = F.array(
        F.struct(a.alias("src"), b.alias("dst")), F.struct(b.alias("src"), a.alias("dst"))
    )
    return edges.where(F.col("type").isin(types)).select(
        "type", F.inline(ends), value.alias("weight"), "swipeLeft"
    )


def likes_only(projected: DataFrame, every_type: bool = False) -> DataFrame:
    """The projection without left swipes.

    ``every_type`` asks ``swipeLeft = 0`` of all edges, which leaves swipes only.
    """
    liked = F.col("swipeLeft") == 0
    return projected.where(liked if every_type else (F.col("type") != "SWIPED") | liked)
