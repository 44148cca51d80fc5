"""The same queries as SQL, to check results against another engine.

What makes it a check of its own: every query starts from the given tables, not from anything
Spark has written, so pages, month folders, marts and their re-reading have no part in it; lists
are worked out by range arithmetic here and cut from a fixed round there; and counts, distinct
counts and shares are asked for directly, where the Spark plans group in steps.
"""

_GAMES = """
WITH games AS (
    SELECT
        o_orderkey AS id,
        'Édition №' || o_orderkey AS name,
        strftime(o_orderdate, '%Y-%m-%d') AS released,
        NULLIF(o_custkey % 101, 0) AS metacritic,
        CASE WHEN o_orderkey % 53 <> 0 THEN list_transform(
            range(o_custkey % 69, o_custkey % 69 + o_orderkey % 6),
            lambda p: CASE WHEN p % 13 <> 6 THEN struct_pack(
                platform := struct_pack(name := 'Console ' || (p * 2 // 3 * 7 % 23))) END)
        END AS platforms,
        CASE WHEN o_orderkey % 59 <> 0 THEN list_transform(
            range(o_orderkey % 7, o_orderkey % 7 + o_custkey % 4),
            lambda p: struct_pack(name := 'Genre ' || (p % 7)))
        END AS genres,
        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
            THEN struct_pack(name := o_orderpriority) END AS esrb_rating,
        strftime(o_orderdate, '%Y-%m') AS date
    FROM orders
),
silver AS (
    SELECT
        date,
        name AS game_name,
        released::DATE AS release_date,
        metacritic::INT AS metacritic_score,
        id::VARCHAR AS game_id,
        [entry.platform.name FOR entry IN platforms] AS console_names,
        [entry.name FOR entry IN genres] AS genre_names,
        esrb_rating.name AS esrb_rating
    FROM games
),
mapping AS (
    SELECT 'Console ' || n_nationkey AS console_name, r_name AS brand,
           n_nationkey % 2 = 0 AS is_handheld
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> 'ASIA'
),
listed AS (
    SELECT game_id, metacritic_score, unnest(console_names) AS console_name FROM silver
),
gbc AS (
    SELECT game_id, metacritic_score, console_name, brand, is_handheld
    FROM listed JOIN mapping USING (console_name)
),
deduped AS (SELECT DISTINCT game_id, metacritic_score, brand FROM gbc)"""

_LINES = """
WITH deduped AS (
    SELECT DISTINCT o_orderkey::VARCHAR AS game_id,
           NULLIF(o_custkey % 101, 0)::INT AS metacritic_score, r_name AS brand
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> 'ASIA'
)"""

_RELOADED_GAMES = _GAMES.replace(
    "FROM orders",
    """FROM orders WHERE year(o_orderdate) <> 1997
       OR (o_custkey % 101 >= 80 AND strftime(o_orderdate, '%Y-%m') <> '1997-05')""",
)
_SCORED_GAMES = _GAMES.replace("FROM orders", "FROM orders WHERE o_custkey % 101 <> 0")


def _joined(names: str) -> str:
    return f"array_to_string(list_transform({names}, lambda n: COALESCE(n, '(none)')), ';')"


_FLAT_SILVER = f"""
SELECT date, game_name, release_date, metacritic_score, game_id,
       {_joined("console_names")} AS console_names,
       {_joined("genre_names")} AS genre_names, esrb_rating
FROM silver"""

_FLAT_GAMES = f"""
SELECT date, id, name, released, metacritic,
       {_joined("[entry.platform.name FOR entry IN platforms]")} AS platforms,
       {_joined("[entry.name FOR entry IN genres]")} AS genres,
       esrb_rating.name AS rating,
       epoch_us(TIMESTAMP '2026-01-02 03:04:05.678901') AS downloaded_micros
FROM games"""


def _with_share(counts: str) -> str:
    return f"""
SELECT *, ROUND(100.0 * number_of_highly_rated_games / number_of_games, 2)
    AS percentage_of_highly_rated_games
FROM ({counts})"""


def _brands(threshold: int = 80) -> str:
    return _with_share(
        f"""
SELECT brand, ROUND(AVG(metacritic_score), 2) AS avg_metacritic_score,
       COUNT(game_id) AS number_of_games,
       COUNT(game_id) FILTER (WHERE metacritic_score >= {threshold})
           AS number_of_highly_rated_games
FROM deduped GROUP BY brand"""
    )


_CONSOLES = _with_share(
    """
SELECT brand, console_name, is_handheld,
       ROUND(AVG(metacritic_score), 2) AS avg_metacritic_score,
       COUNT(DISTINCT game_id) AS number_of_games,
       COUNT(DISTINCT game_id) FILTER (WHERE metacritic_score >= 80)
           AS number_of_highly_rated_games
FROM gbc GROUP BY ALL"""
)

_RANK = "CASE brand WHEN 'EUROPE' THEN 1 WHEN 'AMERICA' THEN 2 WHEN 'AFRICA' THEN 3 END"
_KNOWN = "CASE WHEN brand IN ('EUROPE', 'AMERICA', 'AFRICA') THEN brand END"
_COLOR = """CASE brand WHEN 'EUROPE' THEN '#003791' WHEN 'AMERICA' THEN '#107C10'
            WHEN 'AFRICA' THEN '#E60012' END"""
_LABEL = "number_of_highly_rated_games || ' out of ' || number_of_games"

_MONTHS = """
SELECT strftime(unnest(generate_series(
    date_trunc('month', MIN(o_orderdate)) - INTERVAL 1 MONTH,
    date_trunc('month', MAX(o_orderdate)) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)), '%Y-%m') AS month
FROM orders"""


def _not_null(table: str, name: str, column: str) -> str:
    return f"SELECT 'not_null', '{name}', '{column}', COUNT(*) FROM {table} WHERE {column} IS NULL"


def _unique(table: str, name: str, column: str) -> str:
    return f"""SELECT 'unique', '{name}', '{column}', COUNT(*) FROM (
        SELECT {column} FROM {table} WHERE {column} IS NOT NULL
        GROUP BY {column} HAVING COUNT(*) > 1)"""


_UNSEEN = """
SELECT console_name FROM mapping
WHERE NOT EXISTS (SELECT 1 FROM listed WHERE listed.console_name = mapping.console_name)"""

_SUMMARY = " UNION ALL ".join(
    [
        _not_null("mapping", "console_mapping", "console_name"),
        _unique("mapping", "console_mapping", "console_name"),
        _not_null("mapping", "console_mapping", "brand"),
        """SELECT 'accepted_values', 'console_mapping', 'brand', COUNT(DISTINCT brand)
           FROM mapping WHERE brand NOT IN ('EUROPE', 'AMERICA', 'AFRICA')""",
        _not_null("silver", "silver_games", "game_id"),
        _unique("silver", "silver_games", "game_id"),
        _not_null("silver", "silver_games", "metacritic_score"),
        f"SELECT 'coverage', 'console_mapping', 'console_name', COUNT(*) FROM ({_UNSEEN})",
        _not_null("brands", "agg_brands", "brand"),
        _unique("brands", "agg_brands", "brand"),
        _not_null("consoles", "agg_consoles", "console_name"),
        _unique("consoles", "agg_consoles", "console_name"),
    ]
)

_SLICE = """
SELECT game_id, game_name, release_date, metacritic_score FROM silver
WHERE release_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  AND metacritic_score BETWEEN 1 AND 100
ORDER BY release_date, game_id"""

# What the checks of a build ask of scored games and of consoles 0 to 22.
_PASSING = f"""
(SELECT COUNT(*) = COUNT(DISTINCT game_id) FROM silver)
AND (SELECT COUNT(*) = 0 FROM ({_UNSEEN}) AS unseen
     WHERE console_name NOT IN ('Console 23', 'Console 24'))"""

ORACLE = {
    "json_page_scan": _GAMES + _FLAT_GAMES,
    "partition_column_scan": _GAMES + " SELECT date, COUNT(*) AS games FROM games GROUP BY date",
    "bronze_scan": _GAMES + _FLAT_GAMES,
    "gold_scan": _GAMES + _CONSOLES,
    "seed_scan": _GAMES
    + """
SELECT console_name, brand, is_handheld, COUNT(listed.game_id) AS listings
FROM mapping LEFT JOIN listed USING (console_name) GROUP BY ALL""",
    "source_slice": _GAMES + _SLICE,
    "ordered_slice": _GAMES + _SLICE,
    "partitioned_write": _GAMES
    + """
SELECT date, COUNT(*) AS games, SUM(metacritic)::BIGINT AS score_sum
FROM games GROUP BY date""",
    "partition_replace": _GAMES
    + """
SELECT date, id, metacritic FROM games
WHERE date NOT LIKE '1997-%' OR (metacritic >= 80 AND date <> '1997-05')""",
    "snapshot_read": _GAMES
    + """
SELECT reader, date, COUNT(*) AS games, SUM(metacritic)::BIGINT AS score_sum
FROM games, (VALUES ('before'), ('after')) AS readers(reader)
WHERE reader = 'before' OR date NOT LIKE '1997-%' OR (metacritic >= 80 AND date <> '1997-05')
GROUP BY reader, date""",
    "silver_write": _GAMES + _FLAT_SILVER,
    "full_refresh": _SCORED_GAMES + _FLAT_SILVER + f" WHERE {_PASSING}",
    "json_page_sink": _GAMES
    + """
SELECT date, COUNT(*) AS games, COUNT(*) - COUNT(metacritic) AS null_scores,
       COUNT(name) AS accented_names
FROM games GROUP BY date""",
    "backfill_report": _GAMES
    + f"""
SELECT month,
       CASE WHEN month IN ('1996-06', '1998-03', '2000-02') AND landed.date IS NOT NULL THEN 'failed'
            WHEN landed.date IS NOT NULL THEN 'loaded' ELSE 'empty' END AS status
FROM ({_MONTHS}) AS calendar
LEFT JOIN (SELECT DISTINCT date FROM games
           WHERE date NOT IN ('1995-02', '1999-07')) AS landed ON month = landed.date""",
    "quarantined_files": _GAMES
    + """
SELECT date AS month, date IN ('1996-06', '2000-02') AS has_bad, date = '1998-03' AS has_unreadable,
       COUNT(*) AS sound_games
FROM games WHERE date NOT IN ('1995-02', '1999-07') GROUP BY date""",
    "silver_games": _GAMES + _FLAT_SILVER,
    "struct_field_nullsafe": _GAMES + " SELECT game_id, esrb_rating FROM silver",
    "cast_date": """
SELECT o_orderkey::VARCHAR AS game_id, CAST(CASE o_orderkey % 5
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN 2 THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
    WHEN 3 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
    ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 10:11:12' END AS DATE) AS release_date
FROM orders""",
    "fractional_scores": _GAMES
    + """
SELECT game_id, CAST((metacritic_score % 83) / 2.0::DOUBLE AS INT) AS metacritic_score
FROM silver""",
    "cast_int": """
SELECT o_orderkey::VARCHAR AS game_id, o_custkey::INT AS from_whole,
       ((o_custkey % 203) / 2.0::DOUBLE)::INT AS from_half, o_totalprice::INT AS from_price
FROM orders""",
    "nested_list_names": _GAMES
    + f" SELECT game_id, {_joined('console_names')} AS console_names FROM silver",
    "list_names": _GAMES
    + f" SELECT game_id, {_joined('genre_names')} AS genre_names FROM silver",
    "conditional_value": _GAMES
    + """
SELECT game_id, CASE WHEN metacritic_score >= 80 THEN game_id END AS highly_rated_id
FROM silver""",
    "threshold_param": _GAMES + _brands(50),
    "percentage": _GAMES
    + """
SELECT date, ROUND(100.0 * COUNT(*) FILTER (WHERE metacritic_score >= 80)
                   / NULLIF(COUNT(metacritic_score), 0), 2) AS share
FROM silver GROUP BY date""",
    "round_half": """
SELECT o_orderkey AS id,
       ROUND(((o_orderkey % 1000) * 10 + 5) / 1000.0::DOUBLE, 2) AS rounded_tie,
       ROUND(o_totalprice / 7, 2) AS rounded_price
FROM orders""",
    "bar_label": _GAMES + f" SELECT console_name, {_LABEL} AS bar_label FROM ({_CONSOLES})",
    "ordered_category": _GAMES
    + f"""
SELECT * REPLACE ({_KNOWN} AS brand), {_RANK} AS display_order
FROM ({_brands()}) ORDER BY display_order NULLS LAST""",
    "month_key": _GAMES
    + " SELECT game_id, strftime(release_date, '%Y-%m') AS month FROM silver",
    "month_bounds": _GAMES
    + """
SELECT game_id, date_trunc('month', release_date)::DATE AS first_day,
       last_day(release_date) AS last_day
FROM silver""",
    "month_calendar": """
SELECT strftime(unnest(generate_series(date_trunc('month', MIN(o_orderdate)),
                                       date_trunc('month', MAX(o_orderdate)),
                                       INTERVAL 1 MONTH)), '%Y-%m') AS month
FROM orders""",
    "unnest_select": _GAMES + f" SELECT date, id, downloaded_micros FROM ({_FLAT_GAMES})",
    "lateral_unnest": _GAMES
    + " SELECT game_id, console_name FROM listed",
    "games_by_console": _GAMES + " SELECT * FROM gbc",
    "distinct_rows": _GAMES + " SELECT * FROM deduped",
    "distinct_names": _GAMES
    + " SELECT DISTINCT console_name FROM listed",
    "agg_brands": _GAMES + _brands(),
    "agg_brands_lines": _LINES + _brands(),
    "agg_consoles": _GAMES + _CONSOLES,
    "brands_of_unique_games": _GAMES + _brands(),
    "consoles_of_unique_games": _GAMES + _CONSOLES,
    "dq_not_null": _GAMES
    + " SELECT game_id, game_name FROM silver WHERE metacritic_score IS NULL",
    "dq_unique": _GAMES
    + """
SELECT game_id AS value, COUNT(*) AS records FROM gbc
WHERE game_id IS NOT NULL GROUP BY game_id HAVING COUNT(*) > 1""",
    "dq_accepted_values": _GAMES
    + """
SELECT brand AS value, COUNT(*) AS records FROM gbc
WHERE brand NOT IN ('EUROPE', 'AMERICA', 'AFRICA') GROUP BY brand""",
    "dq_coverage": _GAMES + _UNSEEN,
    "dq_summary": _GAMES
    + f""",
brands AS ({_brands()}),
consoles AS ({_CONSOLES}),
counts("check", "table", "column", failures) AS ({_SUMMARY})
SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM counts""",
    "brands_by_change": _RELOADED_GAMES + _brands(),
    "consoles_by_change": _RELOADED_GAMES + _CONSOLES,
    "dq_unique_by_month": _GAMES
    + """,
placed AS (
    SELECT id, metacritic, date FROM games
    UNION ALL
    SELECT id, metacritic, month FROM games, (VALUES ('1996-01'), ('1997-03')) AS months(month)
    WHERE id % 11 = 0
)
SELECT id::VARCHAR AS value, COUNT(*) AS records FROM placed
WHERE date NOT LIKE '1997-%' OR (metacritic >= 80 AND date <> '1997-05')
GROUP BY id HAVING COUNT(*) > 1""",
    "bronze_games": _GAMES + f" SELECT *, 'tag ' || id AS tag FROM ({_FLAT_GAMES})",
    "documents_as_written": """
SELECT strftime(o_orderdate, '%Y-%m') AS date, o_orderkey AS id, 'É №' AS name,
       '{"odd": 81.50,  "released": "' || strftime(o_orderdate, '%Y-%m-%d')
       || '", "again": 1, "id":' || o_orderkey
       || ', "again": 1.0e3, "long": 12345678901234567890123456789012345678901234567890'
       || ', "name": "\\u00c9 №"}' AS document
FROM orders""",
    "land_and_load": _GAMES
    + " SELECT date, id, metacritic FROM games WHERE metacritic BETWEEN 1 AND 100",
    "brand_metrics": _GAMES
    + f"""
SELECT {_KNOWN} AS brand, avg_metacritic_score, {_RANK} AS display_order
FROM ({_brands()}) ORDER BY display_order NULLS LAST LIMIT 3""",
    "brand_chart": _GAMES
    + f"""
SELECT {_KNOWN} AS brand, percentage_of_highly_rated_games, {_LABEL} AS bar_label,
       {_COLOR} AS color, {_RANK} AS display_order
FROM ({_brands()}) ORDER BY display_order NULLS LAST""",
    "console_chart": _GAMES
    + f"""
SELECT console_name, brand, number_of_highly_rated_games, percentage_of_highly_rated_games,
       number_of_games, {_COLOR} AS color
FROM ({_CONSOLES})""",
    "publish_by_table": _SCORED_GAMES
    + f"""
SELECT tables.name AS "table", tables.name = 'agg_consoles' AND EXISTS (SELECT 1 FROM gbc) AS failed,
       tables.name IN ('silver_games', 'agg_brands') AND {_PASSING} AS published
FROM (VALUES ('console_mapping'), ('silver_games'), ('agg_brands'), ('agg_consoles')) AS tables(name)
WHERE {_PASSING}""",
    "end_to_end_load": _SCORED_GAMES + f" SELECT * FROM ({_brands()}) WHERE {_PASSING}",
}
