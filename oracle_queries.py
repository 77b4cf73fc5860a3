"""DuckDB SQL for the named queries, written from the definitions and independent of the Spark code.

``_TABLES`` builds every prepared table as a common table expression; each query selects from them.
"""

import re

# --- text, as SQL expressions --------------------------------------------------------------

# DuckDB's regex classes are ASCII, so word and space characters are spelled out.
_NOT_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\s\p{Z}]"
_SPACE = r"[\s\p{Z}\x{0b}\x{85}]+"


def _tidy(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '{_NOT_WORD}', ' ', 'g'), '{_SPACE}', ' ', 'g'))"


def _std(x: str) -> str:
    return _tidy(f"lower(strip_accents(coalesce({x}, '')))")


def _no_versions(x: str) -> str:
    """Standard text has single spaces only: double them, so that each word owns both its ends."""
    padded = f"' ' || replace({x}, ' ', '  ') || ' '"
    cut = f"regexp_replace({padded}, ' (feat|ft|featuring) .*', ' ')"
    words = "live|remix|extended|radio  edit|acoustic|remastered(  [0-9]{4})?"
    return f"regexp_replace({cut}, ' ({words}) ', ' ', 'g')"


def _title(x: str) -> str:
    marked = rf"regexp_replace({x}, '([^\p{{L}}\p{{N}} ])', '\1' || chr(1) || ' ', 'g')"
    words = f"list_transform(str_split({marked}, ' '), lambda w: replace(replace(upper(w[1]), 'ß', 'SS'), 'ẞ', 'SS') || w[2:])"
    return f"replace(array_to_string({words}, ' '), chr(1) || ' ', '')"


def _clean(x: str) -> str:
    return _title(_tidy(_no_versions(x)))


def _norm(x: str) -> str:
    return _tidy(f"regexp_replace({_no_versions(x)}, ' cover(ed)? .*', ' ')")


def _nearest(table: str, col: str, q: float) -> str:
    """Value at row round((n - 1) * q) of the sorted column."""
    return f"""(SELECT v FROM (SELECT {col} AS v, row_number() OVER (ORDER BY {col}) - 1 AS i,
        count(*) OVER () AS n FROM {table} WHERE {col} IS NOT NULL) WHERE i = round((n - 1) * {q}))"""


# --- prepared tables -----------------------------------------------------------------------

_NAME = """CASE p_partkey % 7 WHEN 1 THEN p_name || ' (Live)' WHEN 2 THEN p_name || ' - Remastered 2011'
    WHEN 3 THEN p_name || ' feat. Someone' WHEN 4 THEN upper(p_name) WHEN 5 THEN p_name || ' cover'
    WHEN 6 THEN replace(p_name, 'e', 'é') ELSE p_name END"""


def _dedup(entity: str) -> str:
    return f"""SELECT name_std AS {entity}_name_std, min(id) AS canonical_id,
        {_clean('name_std')} AS clean_name FROM names_std WHERE type = '{entity}' GROUP BY name_std"""


def _map(entity: str) -> str:
    return f"""SELECT n.id, min(d.canonical_id) AS canonical_id FROM names_std n
        JOIN {entity}_dedup d ON n.name_std = d.{entity}_name_std
        WHERE n.type = '{entity}' GROUP BY n.id"""


def _scoped(entity: str) -> str:
    return f"""SELECT n.id, n.name_std, coalesce(a.artist, 0) AS artist FROM names_std n
        LEFT JOIN (SELECT DISTINCT e.{entity}_id AS id, m.canonical_id AS artist
            FROM exploded e JOIN artist_map m ON e.artist_id = m.id) a ON n.id = a.id
        WHERE n.type = '{entity}'"""


def _dedup_scoped(entity: str) -> str:
    return f"""SELECT name_std, artist, min(id) AS canonical_id, {_clean('name_std')} AS clean_name
        FROM {entity}_scoped GROUP BY name_std, artist"""


def _map_scoped(entity: str) -> str:
    return f"""SELECT s.id, min(d.canonical_id) AS canonical_id FROM {entity}_scoped s
        JOIN {entity}_dedup d USING (name_std, artist) GROUP BY s.id"""


def _names(entity: str) -> str:
    return f"SELECT canonical_id, min(clean_name) AS clean_name FROM {entity}_dedup GROUP BY 1"


_RERANK_BASE = """SELECT p.user_id, p.track_id, c.genre_id,
    p.score * 0.4 + 0.3 + 0.1 * coalesce(s.popularity_score, 0) / (SELECT max(popularity_score) FROM pop)
        + 0.2 AS base
    FROM personal_50 p LEFT JOIN pop s USING (track_id) LEFT JOIN cat c USING (track_id)
    WHERE NOT EXISTS (SELECT 1 FROM train_ev h WHERE h.user_id = p.user_id AND h.track_id = p.track_id)"""


def _personal(k: int) -> str:
    return f"""SELECT * FROM (SELECT user_id, track_id, score,
        row_number() OVER (PARTITION BY user_id ORDER BY score DESC, track_id) AS rank FROM scores)
        WHERE rank <= {k}"""


def _offline(k: int) -> str:
    return f"""SELECT user_id, track_id, rank, 'personal' AS source FROM personal_lists WHERE rank <= {k}
        UNION ALL SELECT u.user_id, t.track_id, t.place, 'default'
        FROM (SELECT user_id FROM ev UNION SELECT user_id FROM feed) u CROSS JOIN top100 t
        WHERE t.place <= {k} AND u.user_id NOT IN (SELECT user_id FROM personal_lists)"""


def _online(k: int) -> str:
    return f"""SELECT * FROM (SELECT user_id, track_id, score,
        row_number() OVER (PARTITION BY user_id ORDER BY score DESC, track_id) AS rank
        FROM (SELECT h.user_id, s.similar_track_id AS track_id, max(s.similarity_score) AS score
            FROM recent h JOIN similarities s USING (track_id)
            WHERE h.position < 3 AND s.rank <= {k} GROUP BY 1, 2)) WHERE rank <= {k}"""


_BLENDED = """SELECT user_id, track_id, row_number() OVER (PARTITION BY user_id ORDER BY place) AS rank
    FROM (SELECT user_id, track_id, min(place) AS place FROM (
        SELECT o.user_id, o.track_id, 2 * o.rank AS place FROM online_50 o
            JOIN (SELECT user_id, count(*) AS n FROM offline_50 GROUP BY 1) f USING (user_id)
            WHERE o.rank <= f.n
        UNION ALL
        SELECT f.user_id, f.track_id, 2 * f.rank + 1 FROM offline_50 f
            JOIN (SELECT user_id, count(*) AS n FROM online_50 GROUP BY 1) o USING (user_id)
            WHERE f.rank <= o.n
        UNION ALL
        SELECT user_id, track_id, 2 * rank FROM offline_50
            WHERE user_id NOT IN (SELECT user_id FROM online_50)
    ) GROUP BY user_id, track_id)"""

_TABLES = {
    "parts": """SELECT p_partkey, p_name, p_type, p_size, CAST(p_size AS BIGINT) AS size,
        CAST(substr(p_brand, 7) AS BIGINT) AS brand,
        CAST(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type)
            AS BIGINT) AS genre FROM part""",
    "tracks": """SELECT p_partkey AS track_id, [size] AS albums,
        CASE WHEN p_size % 5 = 0 THEN [brand, brand % 25 + 1] WHEN p_size % 3 = 0 THEN [brand + 100]
            ELSE [brand] END AS artists,
        CASE WHEN p_partkey % 97 = 96 THEN CAST([] AS BIGINT[]) ELSE [genre] END AS genres FROM parts""",
    "catalog_names": f"""SELECT p_partkey AS id, 'track' AS type, {_NAME} AS name FROM parts
        UNION ALL SELECT DISTINCT brand, 'artist', 'Brand#' || brand FROM parts
        UNION ALL SELECT DISTINCT brand + 100, 'artist', 'BRAND ' || brand FROM parts
        UNION ALL SELECT DISTINCT size, 'album', 'Album ' || (size % 20) FROM parts
        UNION ALL SELECT DISTINCT genre, 'genre', p_type FROM parts""",
    "interactions": """SELECT o_custkey AS user_id, l_partkey AS track_id,
        CAST(trunc(l_quantity) AS BIGINT) AS track_seq, l_shipdate AS started_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "exploded": """SELECT t.track_id, a.album_id, r.artist_id, g.genre_id FROM tracks t
        LEFT JOIN LATERAL (SELECT unnest(t.albums) AS album_id) a ON true
        LEFT JOIN LATERAL (SELECT unnest(t.artists) AS artist_id) r ON true
        LEFT JOIN LATERAL (SELECT unnest(t.genres) AS genre_id) g ON true""",
    "names_std": f"SELECT id, type, name, {_std('name')} AS name_std FROM catalog_names",
    "artist_dedup": _dedup("artist"),
    "genre_dedup": _dedup("genre"),
    "artist_map": _map("artist"),
    "genre_map": _map("genre"),
    "album_scoped": _scoped("album"),
    "track_scoped": _scoped("track"),
    "album_dedup": _dedup_scoped("album"),
    "track_dedup": f"""SELECT *, min(canonical_id) OVER (PARTITION BY title, artist) AS group_id
        FROM (SELECT *, {_norm('name_std')} AS title FROM ({_dedup_scoped('track')}))""",
    "album_map": _map_scoped("album"),
    "track_map": _map_scoped("track"),
    "items": f"""SELECT DISTINCT tm.canonical_id AS track_id, rm.canonical_id AS artist_id,
        am.canonical_id AS album_id, gm.canonical_id AS genre_id, tn.clean_name AS track_clean,
        tn.group_id AS track_group_id, rn.clean_name AS artist_clean, an.clean_name AS album_clean,
        gn.clean_name AS genre_clean
        FROM exploded e JOIN track_map tm ON e.track_id = tm.id JOIN artist_map rm ON e.artist_id = rm.id
        JOIN album_map am ON e.album_id = am.id JOIN genre_map gm ON e.genre_id = gm.id
        JOIN (SELECT canonical_id, min(group_id) AS group_id, min(clean_name) AS clean_name
            FROM track_dedup GROUP BY 1) tn ON tn.canonical_id = tm.canonical_id
        JOIN ({_names('artist')}) rn ON rn.canonical_id = rm.canonical_id
        JOIN ({_names('album')}) an ON an.canonical_id = am.canonical_id
        JOIN ({_names('genre')}) gn ON gn.canonical_id = gm.canonical_id""",
    "cat": """SELECT track_id, track_clean, track_group_id, artist_id, album_id, genre_id FROM (SELECT *,
        row_number() OVER (PARTITION BY track_id ORDER BY artist_id, album_id, genre_id) AS r FROM items)
        WHERE r = 1""",
    "kept": f"""SELECT user_id, track_id, CAST(started_at AS DATE) AS day FROM interactions
        WHERE track_seq <= {_nearest('interactions', 'track_seq', 0.95)}""",
    "ev": """SELECT user_id, track_id, count(*) AS listen_count, max(day) AS last_listen
        FROM kept WHERE track_id IN (SELECT track_id FROM cat) GROUP BY 1, 2""",
    "user_enc": """SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx
        FROM (SELECT DISTINCT user_id FROM ev)""",
    "item_enc": """SELECT track_id, row_number() OVER (ORDER BY track_id) - 1 AS item_idx
        FROM (SELECT DISTINCT track_id FROM ev)""",
    "split_day": f"SELECT {_nearest('ev', 'last_listen', 0.8)} AS day",
    "train_ev": "SELECT * FROM ev WHERE last_listen <= (SELECT day FROM split_day)",
    "test_ev": "SELECT * FROM ev WHERE last_listen > (SELECT day FROM split_day)",
    "pop": "SELECT track_id, CAST(sum(listen_count) AS BIGINT) AS popularity_score FROM ev GROUP BY 1",
    "top100": """SELECT track_id, popularity_score, place FROM (SELECT *,
        row_number() OVER (ORDER BY popularity_score DESC, track_id) AS place FROM pop) WHERE place <= 100""",
    "pop_recs": """SELECT * FROM (SELECT u.user_id, t.track_id, t.popularity_score,
        row_number() OVER (PARTITION BY u.user_id ORDER BY t.place) AS rank
        FROM (SELECT DISTINCT user_id FROM test_ev) u CROSS JOIN top100 t
        WHERE NOT EXISTS (SELECT 1 FROM train_ev h
            WHERE h.user_id = u.user_id AND h.track_id = t.track_id)) WHERE rank <= 10""",
    "scores": """SELECT o_custkey AS user_id, l_partkey AS track_id, max(l_extendedprice) / 99991 AS score
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "personal": _personal(10),
    "personal_50": _personal(50),
    "pop_cands": """SELECT u.user_id, t.track_id,
        t.popularity_score / (SELECT max(popularity_score) FROM top100)::DOUBLE AS popularity_score
        FROM (SELECT DISTINCT user_id FROM personal) u CROSS JOIN top100 t""",
    "merged": """SELECT coalesce(a.user_id, p.user_id) AS user_id, coalesce(a.track_id, p.track_id) AS track_id,
        coalesce(a.score, 0.0) AS als_score, coalesce(p.popularity_score, 0.0) AS popularity_score
        FROM personal a FULL JOIN pop_cands p ON a.user_id = p.user_id AND a.track_id = p.track_id""",
    "labelled": """SELECT m.*, CAST(CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS target
        FROM merged m LEFT JOIN test_ev t ON m.user_id = t.user_id AND m.track_id = t.track_id""",
    "features": """SELECT c.track_id,
        coalesce(g.listens / (SELECT max(listens) FROM genre_listens)::DOUBLE, 0) AS genre_popularity,
        coalesce(a.listens / (SELECT max(listens) FROM artist_listens)::DOUBLE, 0) AS artist_popularity,
        coalesce(s.n / (SELECT max(n) FROM group_sizes)::DOUBLE, 0) AS track_group_size
        FROM cat c LEFT JOIN genre_listens g USING (genre_id) LEFT JOIN artist_listens a USING (artist_id)
        LEFT JOIN group_sizes s USING (track_group_id)""",
    "personal_lists": "SELECT user_id, track_id, rank FROM personal",
    "feed": """SELECT user_id, event_id % (SELECT count(*) FROM embeddings) AS track_id, event_id, ts FROM events""",
    "recent": """SELECT user_id, track_id, position FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS position FROM feed)
        WHERE position <= 10""",
    "vectors": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "similarities": """SELECT * FROM (SELECT track_id, similar_track_id, similarity_score, row_number() OVER (
        PARTITION BY track_id ORDER BY similarity_score DESC, similar_track_id) AS rank
        FROM (SELECT a.vec_id AS track_id, b.vec_id AS similar_track_id,
            list_cosine_similarity(a.v, b.v) AS similarity_score
            FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id)) WHERE rank <= 10""",
    "offline_50": _offline(50),
    "online_50": _online(50),
    "blended": _BLENDED,
}
_order = list(_TABLES)
for _name, _key in (("genre_listens", "genre_id"), ("artist_listens", "artist_id")):
    _TABLES[_name] = f"SELECT {_key}, sum(listen_count) AS listens FROM train_ev LEFT JOIN cat USING (track_id) GROUP BY 1"
_TABLES["group_sizes"] = "SELECT track_group_id, count(track_id) AS n FROM cat GROUP BY 1"
_at = _order.index("features")
_order[_at:_at] = ["genre_listens", "artist_listens", "group_sizes"]

# built once per statement, since many later tables read them
_MATERIALIZED = {"names_std", "items", "cat", "ev", "pop", "top100", "pop_recs", "merged", "similarities", "personal", "labelled", "test_ev"}


def _with(select: str, extra: dict[str, str] | None = None) -> str:
    """Put the prepared tables the statement needs, directly or not, in front of it."""
    entries = [f"{name} AS MATERIALIZED ({sql})" for name, sql in (extra or {}).items()]
    text = " ".join([*entries, select])
    for name in reversed(_order):
        if re.search(rf"\b{name}\b", text):
            kind = "MATERIALIZED " if name in _MATERIALIZED else ""
            entries.insert(0, f"{name} AS {kind}({_TABLES[name]})")
            text += " " + _TABLES[name]
    return ("WITH " + ",\n".join(entries) + "\n" if entries else "") + select


def _r(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


def _metric_rows(recs: str, k: int) -> str:
    """Per evaluated user with relevant tracks: hits, gain and number of relevant tracks."""
    return f"""SELECT u.user_id, r.n_relevant,
        (SELECT count(*) FROM {recs} x JOIN test_ev t USING (user_id, track_id)
            WHERE x.user_id = u.user_id AND x.rank <= {k}) AS hits,
        (SELECT coalesce(sum(1 / log2(x.rank + 1)), 0) FROM {recs} x JOIN test_ev t USING (user_id, track_id)
            WHERE x.user_id = u.user_id AND x.rank <= {k}) AS gain,
        (SELECT sum(1 / log2(i + 1)) FROM range(1, {k} + 1) q(i) WHERE i <= r.n_relevant) AS ideal
        FROM (SELECT DISTINCT user_id FROM {recs}) u
        JOIN (SELECT user_id, count(*) AS n_relevant FROM test_ev GROUP BY 1) r USING (user_id)"""


def _precision(recs: str, k: int) -> str:
    return f"(SELECT avg(hits / {k}.0) FROM ({_metric_rows(recs, k)}))"


def _recall(recs: str, k: int) -> str:
    return f"(SELECT avg(hits / n_relevant::DOUBLE) FROM ({_metric_rows(recs, k)}))"


def _ndcg(recs: str, k: int) -> str:
    return f"(SELECT avg(gain / ideal) FROM ({_metric_rows(recs, k)}))"


def _novelty(recs: str, k: int) -> str:
    return f"""(SELECT avg(-log2(coalesce(p.popularity_score, 1) /
        (SELECT max(popularity_score) FROM pop)::DOUBLE + 1e-10))
        FROM {recs} r LEFT JOIN pop p USING (track_id) WHERE r.rank <= {k})"""


def _diversity(recs: str, k: int) -> str:
    return f"""(SELECT avg(share) FROM (SELECT r.user_id,
        count(DISTINCT coalesce(c.track_group_id, r.track_id)) / count(*)::DOUBLE AS share
        FROM {recs} r LEFT JOIN cat c USING (track_id) WHERE r.rank <= {k} GROUP BY 1))"""


def _metrics(recs: str, k: int) -> str:
    functions = {
        "precision_at_k": _precision,
        "recall_at_k": _recall,
        "ndcg_at_k": _ndcg,
        "novelty_at_k": _novelty,
        "diversity_at_k": _diversity,
    }
    return ", ".join(_r(function(recs, k), name) for name, function in functions.items())


def _rerank(n: int = 10, weight: float = 0.3) -> str:
    """The greedy loop written out: round by round the best open row of each user."""
    extra = {"base": _RERANK_BASE}
    picked = "SELECT NULL::BIGINT user_id, NULL::BIGINT track_id, NULL::BIGINT genre_id, 0.0 score, 0 r WHERE false"
    for r in range(1, n + 1):
        extra[f"picked{r - 1}"] = picked
        extra[f"best{r}"] = f"""SELECT user_id, track_id, genre_id, score, {r} AS r FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, track_id) AS place FROM (
                SELECT b.user_id, b.track_id, b.genre_id,
                    b.base + {weight} * coalesce(f.first_round, {r}) AS score
                FROM base b LEFT JOIN (SELECT user_id, genre_id, min(r) AS first_round
                    FROM picked{r - 1} WHERE genre_id IS NOT NULL GROUP BY 1, 2) f
                    ON b.user_id = f.user_id AND b.genre_id = f.genre_id
                WHERE NOT EXISTS (SELECT 1 FROM picked{r - 1} p
                    WHERE p.user_id = b.user_id AND p.track_id = b.track_id))) WHERE place = 1"""
        picked = f"SELECT * FROM picked{r - 1} UNION ALL SELECT * FROM best{r}"
    return _with(
        f"SELECT user_id, track_id, {_r('score', 'score')}, CAST(r AS BIGINT) AS rank FROM ({picked})", extra
    )


def _describe() -> str:
    rows = []
    for col in ("user_id", "track_id", "listen_count"):
        quartiles = ", ".join(
            _r(_nearest("ev", col, q), name) for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
        )
        rows.append(
            f"""SELECT '{col}' AS column_name, count({col}) AS n, count(*) - count({col}) AS n_null,
            {_r(f'avg({col})', 'mean')}, {_r(f'stddev_samp({col})', 'std')}, {_r(f'min({col})', '"min"')},
            {quartiles}, {_r(f'max({col})', '"max"')} FROM ev"""
        )
    return " UNION ALL ".join(rows)


def _profile() -> str:
    ids = ["track_id", "artist_id", "album_id", "genre_id", "track_group_id"]
    names = ["track_clean", "artist_clean", "album_clean", "genre_clean"]
    return " UNION ALL ".join(
        f"""SELECT '{col}' AS column_name, '{'bigint' if col in ids else 'string'}' AS column_type,
        count(*) AS n_rows, count(*) - count({col}) AS n_null, count(DISTINCT {col}) AS n_distinct FROM items"""
        for col in ids + names
    )


_MATRIX = """SELECT u.user_idx, i.item_idx, CAST(e.listen_count AS DOUBLE) AS weight
    FROM {side} e JOIN user_enc u USING (user_id) JOIN item_enc i USING (track_id)"""

_QUERIES = {
    "raw_bundle": """SELECT 'tracks' AS table_name, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM tracks
        UNION ALL SELECT 'catalog_names', count(*), 3 FROM catalog_names
        UNION ALL SELECT 'interactions', count(*), 4 FROM interactions""",
    "projected_read": "SELECT DISTINCT user_id FROM ev",
    "step_report": """SELECT 'items' AS table_name, count(*) AS n_rows, CAST(9 AS BIGINT) AS n_columns FROM items
        UNION ALL SELECT 'tracks_catalog_clean', count(*), 6 FROM cat
        UNION ALL SELECT 'events', count(*), 4 FROM ev""",
    "publish_roundtrip": """SELECT t.track_id, t.popularity_score, c.track_clean, c.artist_id, c.track_group_id
        FROM top100 t LEFT JOIN cat c USING (track_id)""",
    "bucketed_write": f"SELECT user_id, track_id, {_r('popularity_score', 'popularity_score')}, rank FROM pop_recs",
    "standardize_text": f"SELECT doc_id, {_std('text')} AS text FROM documents",
    "clean_name": f"SELECT doc_id, {_clean('std')} AS text FROM (SELECT doc_id, {_std('text')} AS std FROM documents)",
    "normalize_title": f"SELECT doc_id, {_norm('std')} AS text FROM (SELECT doc_id, {_std('text')} AS std FROM documents)",
    "cleaned_catalog_names": f"""SELECT id, type, name_std, {_clean('name_std')} AS clean,
        {_norm('name_std')} AS title FROM names_std""",
    "explode_items": "SELECT track_id, album_id, artist_id, genre_id FROM exploded",
    "dedup_artists": "SELECT * FROM artist_dedup",
    "dedup_genres": "SELECT * FROM genre_dedup",
    "dedup_albums_scoped": """SELECT name_std AS album_name_std, artist AS artist_id_canonical, canonical_id,
        clean_name FROM album_dedup""",
    "dedup_items_scoped": """SELECT name_std AS track_name_std, artist AS artist_id_canonical, canonical_id,
        clean_name FROM track_dedup""",
    "id_map": " UNION ALL ".join(
        f"SELECT id AS raw_id, canonical_id, '{entity}' AS entity FROM {entity}_map"
        for entity in ("artist", "genre", "album", "track")
    ),
    "version_groups": """SELECT name_std AS track_name_std, artist AS artist_id_canonical,
        title AS title_normalized, group_id AS track_group_id FROM track_dedup""",
    "items": "SELECT * FROM items",
    "item_catalog": "SELECT * FROM cat",
    "quantile_threshold": f"SELECT CAST({_nearest('interactions', 'track_seq', 0.95)} AS DOUBLE) AS threshold",
    "events": "SELECT * FROM ev",
    "events_remapped": """SELECT k.user_id, m.canonical_id AS track_id, count(*) AS listen_count,
        max(k.day) AS last_listen FROM kept k JOIN track_map m ON k.track_id = m.id
        WHERE m.canonical_id IN (SELECT track_id FROM cat) GROUP BY 1, 2""",
    "user_encoder": "SELECT * FROM user_enc",
    "item_encoder": "SELECT * FROM item_enc",
    "date_threshold": "SELECT day AS threshold FROM split_day",
    "date_threshold_given": """SELECT 'given' AS threshold, count(*) AS train_rows FROM ev
        WHERE last_listen <= DATE '1998-12-16'
        UNION ALL SELECT 'fallback', count(*) FROM train_ev""",
    "recommendations": """SELECT user_id, least(10, (SELECT count(*) FROM top100)) AS n_rows
        FROM (SELECT DISTINCT user_id FROM train_ev)""",
    "train_events": "SELECT * FROM train_ev",
    "test_events": "SELECT * FROM test_ev",
    "split_stats": """SELECT CASE WHEN last_listen <= (SELECT day FROM split_day) THEN 'train' ELSE 'test' END AS side,
        count(*) AS interactions, count(DISTINCT user_id) AS users, count(DISTINCT track_id) AS tracks
        FROM ev GROUP BY 1""",
    "interaction_matrix": _MATRIX.format(side="train_ev"),
    "interaction_matrix_test": _MATRIX.format(side="test_ev"),
    "confidence_weights": "SELECT user_id, track_id, CAST(1 + 2.0 * listen_count AS DOUBLE) AS confidence FROM train_ev",
    "data_summary": f"""SELECT u AS n_users, t AS n_tracks, n AS n_interactions, lo AS min_listens, hi AS max_listens,
        {_r('mean', 'avg_listens')}, total AS total_listens, {_r('100 * (1 - n / (u::DOUBLE * t))', 'sparsity')},
        u AS matrix_rows, t AS matrix_columns, 'float32' AS matrix_dtype
        FROM (SELECT count(*) AS n, CAST(min(listen_count) AS DOUBLE) AS lo, CAST(max(listen_count) AS DOUBLE) AS hi,
            avg(listen_count) AS mean, (SELECT count(*) FROM user_enc) AS u, (SELECT count(*) FROM item_enc) AS t,
            (SELECT CAST(sum(listen_count) AS BIGINT) FROM ev) AS total FROM train_ev)""",
    "pop_listen_count": "SELECT * FROM pop",
    "pop_user_count": "SELECT track_id, count(DISTINCT user_id) AS popularity_score FROM ev GROUP BY 1",
    "pop_avg_listens": f"""SELECT track_id, {_r('sum(listen_count) / count(DISTINCT user_id)', 'popularity_score')}
        FROM ev GROUP BY 1""",
    "top_popular": """SELECT t.track_id, t.popularity_score, c.track_clean, c.artist_id, c.track_group_id
        FROM top100 t LEFT JOIN cat c USING (track_id)""",
    "recommend_popular": f"SELECT user_id, track_id, {_r('popularity_score', 'popularity_score')}, rank FROM pop_recs",
    "track_features": f"""SELECT track_id, {_r('genre_popularity', 'genre_popularity')},
        {_r('artist_popularity', 'artist_popularity')}, {_r('track_group_size', 'track_group_size')} FROM features""",
    "popular_candidates": f"""SELECT u.user_id, t.track_id,
        {_r('t.popularity_score / (SELECT max(popularity_score) FROM top100)::DOUBLE', 'popularity_score')}
        FROM (SELECT DISTINCT user_id FROM test_ev) u CROSS JOIN top100 t""",
    "als_candidates": f"SELECT user_id, track_id, {_r('score', 'als_score')} FROM personal",
    "merge_candidates": f"""SELECT user_id, track_id, {_r('als_score', 'als_score')},
        {_r('popularity_score', 'popularity_score')} FROM merged""",
    "candidate_features": f"""SELECT p.user_id, p.track_id, {_r('p.score', 'als_score')},
        {_r('coalesce(genre_popularity, 0)', 'genre_popularity')},
        {_r('coalesce(artist_popularity, 0)', 'artist_popularity')},
        {_r('coalesce(track_group_size, 0)', 'track_group_size')}
        FROM personal p LEFT JOIN features f USING (track_id)""",
    "labels": f"""SELECT user_id, track_id, {_r('als_score', 'als_score')},
        {_r('popularity_score', 'popularity_score')}, target FROM labelled""",
    "users_with_positive": f"""SELECT user_id, track_id, {_r('als_score', 'als_score')},
        {_r('popularity_score', 'popularity_score')}, target FROM labelled
        WHERE user_id IN (SELECT user_id FROM labelled WHERE target = 1)""",
    "sample_negatives": f"""SELECT user_id, track_id, {_r('als_score', 'als_score')},
        {_r('popularity_score', 'popularity_score')}, target FROM (
            SELECT *, sum(target) OVER (PARTITION BY user_id) AS positives,
                row_number() OVER (PARTITION BY user_id, target
                    ORDER BY md5(concat_ws(':', user_id, track_id, '42')), track_id) AS place FROM labelled)
        WHERE target = 1 OR place <= 4 * positives""",
    "sample_keys": """SELECT user_id FROM (SELECT DISTINCT user_id FROM ev)
        ORDER BY md5(concat_ws(':', user_id, '42')), user_id LIMIT 500""",
    "minmax_scale": f"""SELECT user_id, track_id,
        {_r('CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE score END', 'als_score')}
        FROM personal, (SELECT min(score) AS lo, max(score) AS hi FROM personal)""",
    "max_scale": f"""SELECT track_id,
        {_r('popularity_score / (SELECT max(popularity_score) FROM pop)::DOUBLE', 'popularity_score')} FROM pop""",
    "rank_by_score": f"""SELECT user_id, track_id, {_r('als_score + popularity_score', 'score')},
        row_number() OVER (PARTITION BY user_id ORDER BY als_score + popularity_score DESC, track_id) AS rank
        FROM merged""",
    "top_k_per_user": f"""SELECT user_id, track_id, {_r('als_score', 'als_score')},
        {_r('popularity_score', 'popularity_score')}, rank FROM (SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY popularity_score DESC, track_id) AS rank FROM merged) WHERE rank <= 10""",
    "precision_at_k": f"SELECT {_r(_precision('pop_recs', 5), 'precision_at_k')}",
    "recall_at_k": f"SELECT {_r(_recall('pop_recs', 5), 'recall_at_k')}",
    "ndcg_at_k": f"SELECT {_r(_ndcg('pop_recs', 5), 'ndcg_at_k')}",
    "novelty_at_k": f"SELECT {_r(_novelty('pop_recs', 5), 'novelty_at_k')}",
    "diversity_at_k": f"SELECT {_r(_diversity('pop_recs', 5), 'diversity_at_k')}",
    "all_metrics": f"SELECT {_metrics('personal', 10)}",
    "evaluate_popularity": f"""SELECT {_metrics('pop_recs', 10)},
        (SELECT count(DISTINCT user_id) FROM ev) AS total_users,
        (SELECT count(DISTINCT user_id) FROM test_ev) AS evaluated_users""",
    "compare_models": f"""SELECT 'popularity' AS model, 'k=10' AS k, {_metrics('pop_recs', 10)}
        UNION ALL SELECT 'als', 'k=10', {_metrics('personal', 10)}""",
    "offline_recs": _offline(10),
    "request_stats": f"SELECT source, count(DISTINCT user_id) AS request_count FROM ({_offline(10)}) GROUP BY 1",
    "similar_cosine": f"SELECT track_id, similar_track_id, {_r('similarity_score', 'similarity_score')}, rank FROM similarities",
    "vector_recs": f"""SELECT query_id, item_id, {_r('score', 'score')}, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
            SELECT a.vec_id AS query_id, b.vec_id AS item_id,
                list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
            FROM embeddings a, embeddings b ANTI JOIN (
                SELECT DISTINCT user_id % (SELECT count(*) FROM embeddings) AS u,
                    event_id % (SELECT count(*) FROM embeddings) AS t FROM events) h ON a.vec_id = h.u AND b.vec_id = h.t))
        WHERE rank <= 10""",
    "similar_lookup": f"""SELECT similar_track_id, {_r('similarity_score', 'similarity_score')} FROM similarities
        WHERE track_id = (SELECT track_id FROM pop JOIN (SELECT DISTINCT vec_id AS track_id FROM embeddings)
            USING (track_id) ORDER BY popularity_score DESC, track_id LIMIT 1)""",
    "recent_events": "SELECT * FROM recent",
    "recent_events_stream": "SELECT * FROM recent",
    "latest_events": "SELECT * FROM recent WHERE position < 5",
    "online_recs": f"SELECT user_id, track_id, {_r('score', 'score')}, rank FROM ({_online(5)})",
    "blend": "SELECT * FROM blended WHERE rank <= 50",
    "blend_stream": """SELECT user_id, track_id, rank FROM (SELECT b.* FROM blended b
        WHERE user_id IN (SELECT user_id FROM feed)) WHERE rank <= 50""",
    "rec_lists": "SELECT user_id, track_id, rank FROM pop_recs WHERE rank <= 5",
    "top_items": """SELECT t.track_id, t.popularity_score AS total_listen_count, c.track_clean
        FROM top100 t LEFT JOIN cat c USING (track_id) WHERE t.place <= 10""",
    "top_genres": """SELECT genre_clean, CAST(sum(popularity_score) AS BIGINT) AS total_listen_count
        FROM pop LEFT JOIN (SELECT DISTINCT track_id, genre_clean FROM items) USING (track_id)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "unheard_items": """SELECT track_id, track_clean, artist_clean, album_clean, genre_clean FROM (SELECT *,
        row_number() OVER (PARTITION BY track_id ORDER BY artist_id, album_id, genre_id) AS r FROM items
        WHERE track_id NOT IN (SELECT track_id FROM ev)) WHERE r = 1""",
    "unheard_count": """SELECT count(*) AS n_tracks, count(*) FILTER (track_id NOT IN (SELECT track_id FROM ev)) AS n_unheard
        FROM (SELECT DISTINCT track_id FROM items)""",
    "null_counts": """SELECT count(*) - count(track_id) AS track_id, count(*) - count(album_id) AS album_id,
        count(*) - count(artist_id) AS artist_id, count(*) - count(genre_id) AS genre_id FROM exploded""",
    "value_counts": "SELECT track_seq, count(*) AS n FROM interactions GROUP BY 1",
    "value_counts_all": " UNION ALL ".join(
        f"SELECT '{col}' AS column_name, CAST({col} AS VARCHAR) AS value, count(*) AS n FROM interactions GROUP BY ALL"
        for col in ("user_id", "track_id", "track_seq", "started_at")
    ),
    "describe_events": _describe(),
    "table_profile": _profile(),
}


_KEPT_RULES = "CAST(0 AS BIGINT)"
_FULL_LIST = """{n} AS n_rows, {n} AS n_items, CAST(1 AS BIGINT) AS first_rank, {n} AS last_rank,
    {zero} AS n_rising"""


def _full_list(n: str) -> str:
    """The audit of a list of n rows that breaks no rule of order."""
    return _FULL_LIST.format(n=f"CAST({n} AS BIGINT)", zero=_KEPT_RULES)


# Learnt results: what holds whatever was learnt.
_QUERIES |= {
    "factor_indexes": """SELECT DISTINCT 'user' AS side, user_idx AS idx, 64 AS n_factors FROM train_ev JOIN user_enc USING (user_id)
        UNION ALL SELECT DISTINCT 'item', item_idx, 64 FROM train_ev JOIN item_enc USING (track_id)""",
    "saved_factors": f"""SELECT count(DISTINCT user_id) AS n_users, {_KEPT_RULES} AS n_changed, 64 AS factors,
        CAST(0.01 AS DOUBLE) AS regularization, 15 AS iterations, CAST(1 AS DOUBLE) AS alpha, 42 AS seed FROM train_ev""",
    "als_recs_audit": f"""SELECT user_id, {_full_list("least(10, tracks - heard)")}, {_KEPT_RULES} AS n_refused,
        {_KEPT_RULES} AS n_wrong FROM (SELECT user_id, count(*) AS heard FROM train_ev GROUP BY 1),
            (SELECT count(DISTINCT track_id) AS tracks FROM train_ev) WHERE tracks > heard""",
    "als_similar_audit": f"""SELECT DISTINCT track_id, {_full_list("least(10, tracks - 1)")}, {_KEPT_RULES} AS n_refused,
        {_KEPT_RULES} AS n_wrong FROM train_ev, (SELECT count(DISTINCT track_id) AS tracks FROM train_ev) WHERE tracks > 1""",
    "training_rows": f"""SELECT user_id, track_id, als_score, popularity_score, target,
        {", ".join(_r(f"coalesce({name}, 0)", name) for name in ("genre_popularity", "artist_popularity", "track_group_size"))}
        FROM ({_QUERIES["sample_negatives"]}) LEFT JOIN features USING (track_id)""",
    "recommendations_audit": f"""SELECT DISTINCT user_id, {_full_list("least(10, (SELECT count(*) FROM top100))")},
        {_KEPT_RULES} AS n_foreign, {_KEPT_RULES} AS n_wrong_targets, {_KEPT_RULES} AS n_no_probability FROM train_ev""",
    "rank_with_model_audit": f"""SELECT DISTINCT user_id, {_full_list("10")}, {_KEPT_RULES} AS n_foreign
        FROM train_ev JOIN (SELECT DISTINCT user_id FROM pop_recs) USING (user_id)""",
    "importance_audit": """SELECT unnest(['als_score', 'popularity_score', 'genre_popularity', 'artist_popularity',
        'track_group_size']) AS feature, true AS in_range, CAST(100 AS DOUBLE) AS total""",
    "evaluation_users": """SELECT model, (SELECT count(DISTINCT user_id) FROM ev) AS total_users,
        (SELECT count(DISTINCT user_id) FROM test_ev) AS evaluated_users, true AS possible
        FROM (SELECT unnest(['popularity', 'als', 'ranked']) AS model)""",
}
_QUERIES["packed_matrix"] = _QUERIES["interaction_matrix"]
_QUERIES["packed_matrix_slice"] = f"SELECT * FROM ({_QUERIES['interaction_matrix']}) WHERE user_idx BETWEEN 100 AND 199"
_QUERIES["similar_lookup_sorted"] = _QUERIES["similar_lookup"]
_QUERIES["sample_negatives_of_rows"] = _QUERIES["sample_negatives"]


def all_sql() -> dict[str, str]:
    sql = {name: _with(select) for name, select in _QUERIES.items()}
    sql["rerank_multi_objective"] = _rerank()
    return sql
