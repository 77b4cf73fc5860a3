"""Entity resolution: raw names and ids -> canonical items, version groups and the item catalog."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.functions.text import clean_name, normalize_title, standardize_text
from crossfade.sources.tables import materialize

ITEM_IDS = ["track_id", "artist_id", "album_id", "genre_id"]
NO_ARTIST = 0  # scope of an entity without a known artist


def explode_tracks(tracks: DataFrame) -> DataFrame:
    """One row per track x album x artist x genre; an empty list gives one null."""
    return (
        tracks.select("track_id", F.explode_outer("albums").alias("album_id"), "artists", "genres")
        .select("track_id", "album_id", F.explode_outer("artists").alias("artist_id"), "genres")
        .select("track_id", "album_id", "artist_id", F.explode_outer("genres").alias("genre_id"))
    )


def standard_names(names: DataFrame) -> DataFrame:
    """The name table with ``name_std``."""
    return names.select("id", "type", "name", standardize_text("name").alias("name_std"))


def build_entity_catalog(names: DataFrame, entity: str) -> DataFrame:
    """Ids, names and standard names of one entity kind, from the raw or the standard name table."""
    if "name_std" not in names.columns:
        names = standard_names(names)
    return names.filter(F.col("type") == entity).select(
        F.col("id").alias(f"{entity}_id"),
        F.col("name").alias(f"{entity}_name"),
        F.col("name_std").alias(f"{entity}_name_std"),
    )


def dedup_entities(catalog: DataFrame, entity: str) -> DataFrame:
    """One row per standard name: ``canonical_id`` = lowest id, and the clean name."""
    std = f"{entity}_name_std"
    return (
        catalog.groupBy(std)
        .agg(F.min(f"{entity}_id").alias("canonical_id"))
        .withColumn("clean_name", clean_name(std))
    )


def id_map(catalog: DataFrame, dedup: DataFrame, entity: str) -> DataFrame:
    """Raw id -> canonical id, one row per raw id (the lowest canonical id wins)."""
    std = f"{entity}_name_std"
    return (
        catalog.select(f"{entity}_id", std)
        .join(dedup.select(std, "canonical_id"), std)
        .groupBy(f"{entity}_id")
        .agg(F.min("canonical_id").alias(f"{entity}_id_canonical"))
    )


def artists_of(exploded: DataFrame, artist_map: DataFrame, entity: str) -> DataFrame:
    """Distinct (entity id, canonical artist) pairs."""
    return (
        exploded.select(f"{entity}_id", "artist_id")
        .distinct()
        .join(artist_map, "artist_id")
        .select(f"{entity}_id", "artist_id_canonical")
        .distinct()
    )


def scope_by_artist(catalog: DataFrame, entity_artists: DataFrame, entity: str) -> DataFrame:
    """Entity catalog with one row per canonical artist of the entity."""
    return catalog.join(entity_artists, f"{entity}_id", "left").withColumn(
        "artist_id_canonical", F.coalesce("artist_id_canonical", F.lit(NO_ARTIST).cast("long"))
    )


def dedup_entities_scoped(scoped: DataFrame, entity: str) -> DataFrame:
    """Like ``dedup_entities`` but equal names of different artists stay apart."""
    std = f"{entity}_name_std"
    return (
        scoped.groupBy(std, "artist_id_canonical")
        .agg(F.min(f"{entity}_id").alias("canonical_id"))
        .withColumn("clean_name", clean_name(std))
    )


def id_map_scoped(scoped: DataFrame, dedup: DataFrame, entity: str) -> DataFrame:
    keys = [f"{entity}_name_std", "artist_id_canonical"]
    return (
        scoped.select(f"{entity}_id", *keys)
        .join(dedup.select(*keys, "canonical_id"), keys)
        .groupBy(f"{entity}_id")
        .agg(F.min("canonical_id").alias(f"{entity}_id_canonical"))
    )


def group_versions(tracks_dedup: DataFrame) -> DataFrame:
    """Add ``title_normalized`` and ``track_group_id``, the lowest canonical id of all versions."""
    titled = tracks_dedup.withColumn("title_normalized", normalize_title("track_name_std"))
    keys = ["title_normalized", "artist_id_canonical"]
    groups = titled.groupBy(*keys).agg(F.min("canonical_id").alias("track_group_id"))
    return titled.join(groups, keys, "left")


@dataclass(frozen=True)
class Entities:
    """Resolved entities: per kind the dedup table and the raw id -> canonical id map."""

    exploded: DataFrame
    dedup: dict[str, DataFrame]
    maps: dict[str, DataFrame]


def resolve_entities(tracks: DataFrame, names: DataFrame) -> Entities:
    """Resolve all four kinds. The standard names (the only Python pass) and the artist map are
    read many times below, so they are written to the shared folder first."""
    names = materialize(standard_names(names))
    exploded = explode_tracks(tracks)
    dedup, maps = {}, {}
    for entity in ("artist", "genre"):
        catalog = build_entity_catalog(names, entity)
        dedup[entity] = dedup_entities(catalog, entity)
        maps[entity] = id_map(catalog, dedup[entity], entity)
    maps["artist"] = materialize(maps["artist"])
    for entity in ("album", "track"):
        catalog = build_entity_catalog(names, entity)
        scoped = scope_by_artist(catalog, artists_of(exploded, maps["artist"], entity), entity)
        dedup[entity] = dedup_entities_scoped(scoped, entity)
        maps[entity] = id_map_scoped(scoped, dedup[entity], entity)
    dedup["track"] = group_versions(dedup["track"])
    return Entities(exploded, dedup, maps)


def _lookup(entities: Entities, entity: str) -> DataFrame:
    """Raw id -> canonical id with its name (and group), so that ``items`` needs one join per kind.

    An id that is canonical under several artists has several names; the lowest row is kept.
    """
    extra = ["track_group_id"] if entity == "track" else []
    names = (
        entities.dedup[entity]
        .groupBy(F.col("canonical_id").alias(f"{entity}_id_canonical"))
        .agg(F.min(F.struct(*extra, "clean_name")).alias("_name"))
    )
    return (
        entities.maps[entity]
        .join(names, f"{entity}_id_canonical", "left")
        .select(
            f"{entity}_id",
            f"{entity}_id_canonical",
            F.col("_name.clean_name").alias(f"{entity}_clean"),
            *(F.col(f"_name.{c}").alias(c) for c in extra),
        )
    )


def build_items(entities: Entities) -> DataFrame:
    """Distinct canonical (track, artist, album, genre) rows with clean names and version group.

    Rows with an id that maps to nothing drop out in the inner joins. Tracks come last: if the
    joins are sort-merge, the final grouping then works on the partitioning of the finest key.
    """
    rows = entities.exploded
    for entity in ("genre", "artist", "album", "track"):
        rows = (
            rows.join(_lookup(entities, entity), f"{entity}_id")
            .drop(f"{entity}_id")
            .withColumnRenamed(f"{entity}_id_canonical", f"{entity}_id")
        )
    cleaned = [
        F.coalesce(f"{entity}_clean", F.lit("Unknown")).alias(f"{entity}_clean")
        for entity in ("artist", "album", "genre")
    ]
    return rows.select(
        *ITEM_IDS,
        F.coalesce("track_clean", F.lit("Unknown")).alias("track_clean"),
        F.coalesce("track_group_id", "track_id").alias("track_group_id"),
        *cleaned,
    ).distinct()


def build_item_catalog(items: DataFrame) -> DataFrame:
    """One row per track: the one with the lowest (artist, album, genre)."""
    first = F.min(
        F.struct("artist_id", "album_id", "genre_id", "track_clean", "track_group_id")
    ).alias("_first")
    return (
        items.groupBy("track_id")
        .agg(first)
        .select(
            "track_id",
            "_first.track_clean",
            "_first.track_group_id",
            "_first.artist_id",
            "_first.album_id",
            "_first.genre_id",
        )
    )
