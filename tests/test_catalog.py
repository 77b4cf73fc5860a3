import pytest

from crossfade.operators import catalog as C

NAMES = [
    (1, "artist", "Beyoncé"), (2, "artist", "BEYONCE"), (3, "artist", "Other"),
    (10, "album", "Best Of"), (11, "album", "best of!"), (12, "album", "Best of"), (13, "album", "Alone"),
    (20, "genre", "Pop"), (21, "genre", "POP"),
    (100, "track", "Halo"), (101, "track", "halo"), (102, "track", "Halo (Live)"),
    (103, "track", "Halo"), (104, "track", "Halo cover"), (105, "track", "No genre"),
]
TRACKS = [
    (100, [10], [1], [20]), (101, [11], [2], [21]), (102, [10, 13], [1], [20]),
    (103, [12], [3], [20]), (104, [10], [1, 3], [20]), (105, [10], [1], []),
    (106, [10], [1], [20]),  # not in the name table
    (107, [99], [1], [20]),
]


@pytest.fixture(scope="module")
def entities(spark):
    tracks = spark.createDataFrame(
        TRACKS, "track_id long, albums array<long>, artists array<long>, genres array<long>"
    )
    return C.resolve_entities(tracks, spark.createDataFrame(NAMES, "id long, type string, name string"))


def ids(df, entity):
    return {r[f"{entity}_id"]: r[f"{entity}_id_canonical"] for r in df.collect()}


def test_empty_list_gives_one_null(entities):
    rows = [r for r in entities.exploded.collect() if r.track_id == 105]
    assert [(r.album_id, r.artist_id, r.genre_id) for r in rows] == [(10, 1, None)]
    assert entities.exploded.count() == 10


def test_equal_names_share_the_lowest_id(entities):
    assert ids(entities.maps["artist"], "artist") == {1: 1, 2: 1, 3: 3}
    assert ids(entities.maps["genre"], "genre") == {20: 20, 21: 20}


def test_scope_keeps_artists_apart(entities):
    # album 12 is by artist 3 only; 10 is by artists 1 and 3, and its lowest canonical id wins
    assert ids(entities.maps["album"], "album") == {10: 10, 11: 10, 12: 10, 13: 13}
    assert ids(entities.maps["track"], "track") == {
        100: 100, 101: 100, 102: 102, 103: 103, 104: 104, 105: 105,
    }


def test_maps_are_idempotent_and_never_raise_an_id(entities):
    for entity, df in entities.maps.items():
        mapping = ids(df, entity)
        assert all(canonical <= raw for raw, canonical in mapping.items())
        assert all(mapping[canonical] == canonical for canonical in mapping.values())


def test_versions_are_grouped_per_artist(entities):
    rows = {(r.canonical_id, r.artist_id_canonical): r for r in entities.dedup["track"].collect()}
    assert rows[(102, 1)].track_group_id == 100  # live version
    assert rows[(104, 1)].track_group_id == 100  # cover
    assert rows[(103, 3)].track_group_id == 103
    assert rows[(104, 3)].track_group_id == 103
    assert rows[(102, 1)].clean_name == "Halo"


def test_items_and_catalog(entities):
    items = C.build_items(entities)
    rows = {(r.track_id, r.artist_id, r.album_id, r.genre_id): r for r in items.collect()}
    assert set(rows) == {
        (100, 1, 10, 20), (102, 1, 10, 20), (102, 1, 13, 20), (103, 3, 10, 20),
        (104, 1, 10, 20), (104, 3, 10, 20),
    }
    assert rows[(104, 3, 10, 20)].track_group_id == 100  # the lowest group of the canonical track
    assert rows[(100, 1, 10, 20)].artist_clean == "Beyonce"
    catalog = {r.track_id: r for r in C.build_item_catalog(items).collect()}
    assert (catalog[102].artist_id, catalog[102].album_id) == (1, 10)
    assert (catalog[104].artist_id, catalog[104].album_id) == (1, 10)
    assert sorted(catalog) == [100, 102, 103, 104]
