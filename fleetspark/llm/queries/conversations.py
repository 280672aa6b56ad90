"""op11: prefix trie of rebuilt conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.llm.prefix_trie import prefix_trie, turn_lists
from fleetspark.llm.registry import query, table

#: Conversations of one family share the first turns of its first one, up to ``SHARED`` - 1 of them.
FAMILY, SHARED = 5, 9


def rebuilt(lists: DataFrame) -> DataFrame:
    """Each conversation with the first h turns of its family's first one, h by its id, then its own after h."""
    first = lists.select(F.col("conv_id").alias("family"), F.slice("turns", 1, SHARED - 1).alias("opening"))
    c = F.col("conv_id")
    own = lists.select("conv_id", "turns", (c - c % FAMILY).alias("family"), (F.crc32(c.cast("string")) % SHARED).cast("int").alias("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    opening = F.slice(F.coalesce("opening", F.slice("turns", 1, 0)), 1, F.col("h"))
    return own.join(first, "family", "left").select("conv_id", F.concat(opening, rest).alias("turns"))


#: The trie again from its definition: every prefix of every rebuilt conversation as a list, grouped.
SQL = f"""
WITH bits AS (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END) AS v
    FROM range(256) r(i)
),
remainders AS (SELECT list(v ORDER BY i) AS t FROM bits),
own AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
sized AS (
    SELECT conv_id, turns, conv_id - conv_id % {FAMILY} AS family,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
            lambda c, b: xor(t[((xor(c, b) & 255) + 1)::BIGINT], c >> 8)), 4294967295::BIGINT) % {SHARED} AS h
    FROM own, remainders
),
whole AS (
    SELECT s.conv_id, list_concat(coalesce(o.turns, [])[1:s.h], s.turns[s.h + 1:]) AS turns
    FROM sized s LEFT JOIN own o ON o.conv_id = s.family
),
cut AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM whole),
keyed AS (SELECT conv_id, n, depth, turns[1:depth] AS path, CASE WHEN depth > 0 THEN turns[1:depth - 1] END AS up FROM cut),
node AS (
    SELECT depth, path, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
    FROM keyed GROUP BY depth, path
),
child AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1, 2),
described AS (
    SELECT node.*, coalesce(child.n, 0) AS n_children,
        (n_convs - 1) * CASE WHEN node.depth > 0 THEN strlen(path[-1].t) ELSE 0 END AS saved
    FROM node LEFT JOIN child USING (depth, path)
),
above AS (SELECT unnest(range(depth + 1)) AS top, path, n_children, saved FROM described),
summed AS (
    SELECT top AS depth, path[1:top] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM above GROUP BY 1, 2
)
SELECT d.conv_id, d.depth, p.conv_id AS parent_conv_id, d.n_convs, d.n_children, s.n_leaves, s.saved_tokens, sha256(d.ends) AS ends_sha256
FROM described d JOIN summed s ON s.depth = d.depth AND s.path = d.path
LEFT JOIN node p ON p.depth = d.depth - 1 AND p.path = d.up
"""


@query("op11_prefix_trie", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = stage(turn_lists(table(spark, sf_dir, "conversations")), "turn-lists")
    return prefix_trie(rebuilt(lists))
