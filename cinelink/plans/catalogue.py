"""Five film catalogues derived from the `part` table, every row of it used once.

The source of a row, its identifiers, the spelling of its title and its gaps follow
from the part key, so that copies inside a source, shared identifiers, near titles,
unknown years and missing titles all occur. The expressions read the same in Spark
SQL and DuckDB.
"""

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import text
from cinelink.runtime import spread

FILM_COLUMNS = [
    """CASE p_partkey % 5 WHEN 0 THEN 'tmdb' WHEN 1 THEN 'rotten_tomatoes' WHEN 2 THEN 'kaggle'
       WHEN 3 THEN 'imdb' ELSE 'spark' END AS source""",
    "p_partkey AS k",
    """CASE WHEN p_partkey % 5 = 0 OR (p_partkey % 5 = 2 AND p_partkey % 3 <> 0)
              OR (p_partkey % 5 = 4 AND p_partkey % 7 = 0)
       THEN CAST(floor(p_partkey / 10) AS BIGINT) END AS tmdb_id""",
    """CASE WHEN p_partkey % 5 = 3 OR (p_partkey % 5 = 2 AND p_partkey % 4 <> 1)
       THEN concat('tt', CAST(floor(p_partkey / 15) AS BIGINT)) END AS imdb_id""",
    """CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 101 = 0 THEN '!!!'
       ELSE CASE p_partkey % 7
         WHEN 0 THEN p_name
         WHEN 1 THEN upper(p_name)
         WHEN 2 THEN concat(p_name, '!')
         WHEN 3 THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1))
         WHEN 4 THEN concat(substr(p_name, 1, 2), substr(p_name, 4))
         WHEN 5 THEN concat('<b>', p_name, '</b>')
         ELSE concat('  ', replace(p_name, ' ', '   '), ' ') END END AS title""",
    "upper(p_name) AS original_title",
    """CASE WHEN p_partkey % 6 = 0 THEN NULL
       ELSE concat('<p>', p_brand, ' &amp;  ', p_type, '</p>') END AS overview""",
    """CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN concat(1950 + p_size, '-06-15')
       WHEN p_partkey % 3 = 1 THEN concat('06/15/', 1950 + p_size)
       ELSE concat(1950 + p_size, '') END AS release_date""",
    """CASE WHEN p_partkey % 8 = 3 THEN NULL
       ELSE CAST(p_partkey % 130 AS DOUBLE) / 10 END AS vote_average""",
    "CASE WHEN p_partkey % 9 = 4 THEN NULL ELSE p_partkey % 1000 END AS vote_count",
    """CASE WHEN p_partkey % 5 IN (0, 4) THEN p_retailprice / 8 END AS popularity""",
    "CASE WHEN p_partkey % 3 = 1 THEN concat('/', p_brand, '.jpg') END AS poster_path",
    """CASE WHEN p_partkey % 5 = 1 THEN CAST(p_partkey % 120 AS DOUBLE) END AS tomatometer_score""",
    """CASE WHEN p_partkey % 5 = 1 THEN CAST(p_partkey % 101 AS DOUBLE) END AS audience_score""",
    """CASE WHEN p_partkey % 5 = 1 THEN concat('<i>', p_brand, '</i> agreed') END AS critics_consensus""",
    "CASE WHEN p_partkey % 5 = 2 THEN p_partkey * 100 END AS budget",
    "CASE WHEN p_partkey % 5 = 2 THEN p_partkey * 300 END AS revenue",
    "CASE WHEN p_partkey % 4 = 1 THEN NULL ELSE 60 + p_partkey % 90 END AS runtime_minutes",
    """CASE p_type WHEN 'PROMO' THEN 'Horror|Drama' WHEN 'SMALL' THEN 'horror, Comedy'
       WHEN 'LARGE' THEN '[{"name": "Horror"}, {"name": "Thriller"}]' WHEN 'MEDIUM' THEN 'Comedy'
       WHEN 'ECONOMY' THEN '' END AS genre_text""",
]

FILMS = "SELECT " + ", ".join(FILM_COLUMNS) + " FROM part"


def films(t):
    """The derived films as plain columns, with `k` as their order."""
    return spread(t.part, "p_partkey").selectExpr(*FILM_COLUMNS)


def raw_films(t):
    """The derived films as records of the five readers."""
    return films(t).withColumns({
        "seq": S.seq_key(F.col("k")), "genres": text.parse_genres(F.col("genre_text")),
    }).transform(S.conform, S.RAW)
